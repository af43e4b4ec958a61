"""All queries over the model tables, by name, with their SQL."""

from __future__ import annotations

from ledgerflow.plans import oracle_analytics, oracle_facts, oracle_reports, queries_analytics, queries_facts, reports

QUERIES: dict = {**queries_facts.QUERIES, **queries_analytics.QUERIES, **reports.QUERIES}
ORACLE_SQL: dict[str, str] = {**oracle_facts.ORACLE_SQL, **oracle_analytics.ORACLE_SQL, **oracle_reports.ORACLE_SQL}
