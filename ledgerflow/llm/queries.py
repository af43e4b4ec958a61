"""One query for each operator, over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ledgerflow.llm import decontaminate, infill, language, licenses, lines, mixing, prefixes, quality, simhash, tokens, topk, toxicity, urlfilter
from ledgerflow.llm.common import fold, read

#: Name of the vocabulary file; its folder is the public_tokenizers package.
VOCABULARY = "byte_bpe_50k.json"


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents")
    return tokens.count_tokens(docs, str(public_tokenizers.path(VOCABULARY)), keep=["doc_id"])


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")
    return decontaminate.contract(decontaminate.decontaminate(docs, items, keep=["doc_id"]))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = quality.score(docs, quality.train(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    named = language.identify(docs, language.train(docs), keep=["doc_id"])
    return named.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score", "rejected")


def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.contract(licenses.scan_licenses(read(spark, sf_dir, "documents"), keep=["doc_id"]))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.filter("vec_id % 50 = 0"), k=5)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), keep=["doc_id"])
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.filter_urls(pages, urlfilter.rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.contract(simhash.near_duplicates(read(spark, sf_dir, "documents"), keep=["doc_id"]))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    scored = toxicity.score(docs, toxicity.train(docs, labels), keep=["doc_id"])
    return scored.select("doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "score", "predicted")


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.contract(infill.fill_in_middle(read(spark, sf_dir, "documents"), keep=["doc_id"], texts=False))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.contract(read(spark, sf_dir, "conversations"))


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.contract(lines.dedup_lines(read(spark, sf_dir, "documents"), keep=["doc_id"]))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_decontaminate, op3_quality, op4_language, op5_licenses, op6_exact_top_k, op7_mix_sources, op8_url_filter, op9_simhash, op10_toxicity, op11_fill_in_middle, op12_prefix_trie, op13_line_dedup)}

_CUT = r"regexp_extract_all(translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"

_TEMPLATES = ", ".join(f"('{name}', '{label}', {base}, {size}, {pos}, {k}, '{' '.join(gram)}')" for name, label, base, size, pos, k, gram in licenses.template_rows())

ORACLE_SQL = {
    "op5_licenses": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_CUT.format("text")} AS w FROM documents),
t(template, label, base, t_size, t_pos, k, gram) AS (VALUES {_TEMPLATES}),
places AS (SELECT rid, w, unnest(range(1, len(w) + 1)) AS i FROM d),
g AS (SELECT rid, i - 1 AS pos, k, array_to_string(w[i:i + k - 1], ' ') AS gram FROM places, (VALUES (2), (5)) ks(k) WHERE i + k - 1 <= len(w)),
m AS (SELECT rid, template, label, base, t_size, pos - t_pos AS diagonal, pos, t_pos FROM g JOIN t USING (k, gram)),
v AS (SELECT rid, template, label, base, t_size, diagonal, list(DISTINCT t_pos) AS votes, min(pos) AS first FROM m GROUP BY ALL),
o AS (SELECT *, CASE WHEN base OR diagonal - lag(diagonal) OVER q > 3 THEN 1 ELSE 0 END AS opens FROM v WINDOW q AS (PARTITION BY rid, template ORDER BY diagonal)),
n AS (SELECT *, sum(opens) OVER (PARTITION BY rid, template ORDER BY diagonal) AS grp FROM o),
s AS (SELECT rid, template, label, base, t_size, grp, CAST(len(list_distinct(flatten(list(votes)))) AS DOUBLE) / t_size AS coverage, min(first) AS first FROM n GROUP BY rid, template, label, base, t_size, grp),
c AS (SELECT *, CASE WHEN base THEN coverage = 1 ELSE coverage >= 0.8 END AS ok FROM s)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, count(*) FILTER (ok AND base) AS n_base, min(first) FILTER (ok AND base) AS first_word, max(first) FILTER (ok AND base) AS last_word,
  coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (ok AND base), '') AS base_labels, coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (ok), '') AS labels, coalesce(max(coverage), 0) AS score
FROM d LEFT JOIN c USING (rid) GROUP BY rid, doc_id, w""",
    "op2_decontaminate": f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, {_CUT.format("text")} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, {_CUT.format("text")} AS w FROM benchmark),
grams AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS gram
          FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM grams),
places AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
hits AS (SELECT p.rid, p.i, p.n, g.item_id FROM (SELECT rid, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram FROM places) p JOIN grams g ON g.n = p.n AND g.gram = p.gram),
covered AS (SELECT rid, count(DISTINCT x) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS x FROM hits) GROUP BY rid),
items AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT rid, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, CAST(coalesce(c.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(i.names, '')) AS items_sha256, coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered c USING (rid) LEFT JOIN items i USING (rid)""",
    "op6_exact_top_k": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
           FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
    "op8_url_filter": """
WITH r(verdict, host, path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
u AS (SELECT page_id, row_number() OVER () AS rid, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, rid, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT p.rid, r.host || r.path AS rule, r.verdict, row_number() OVER (PARTITION BY p.rid ORDER BY length(r.host || r.path) DESC) AS k
      FROM p JOIN r ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path))
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM p LEFT JOIN m ON p.rid = m.rid AND m.k = 1""",
    "op11_fill_in_middle": """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT doc_id, t, u, CAST(len(u) AS BIGINT) AS n, CAST('0x' || x[1:8] AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || x[9:16] AS BIGINT) % (len(u) + 1) AS c2, CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM d),
f AS (SELECT *, CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form,
        array_to_string(u[1:least(c1, c2)], '') AS p, array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], '') AS m, array_to_string(u[greatest(c1, c2) + 1:], '') AS s FROM h),
o AS (SELECT *, CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END AS output FROM f),
r AS (SELECT *, CASE form WHEN 'plain' THEN output
  WHEN 'psm' THEN substr(output, 4, strpos(output, '<S>') - 4) || substr(output, strpos(output, '<M>') + 3) || substr(output, strpos(output, '<S>') + 3, strpos(output, '<M>') - strpos(output, '<S>') - 3)
  ELSE substr(output, strpos(output, '<P>') + 3, strpos(output, '<M>') - strpos(output, '<P>') - 3) || substr(output, strpos(output, '<M>') + 3) || substr(output, 4, strpos(output, '<P>') - 4) END AS restored FROM o)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars, sha256(output) AS output_sha256, sha256(restored) AS restored_sha256 FROM r""",
    "op12_prefix_trie": """
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS place FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT conv_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) % 9 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT i.conv_id, 0 AS part, place, role, text FROM i JOIN t ON t.conv_id = i.conv_id - i.conv_id % 5 AND place <= h UNION ALL SELECT i.conv_id, 1, place, role, text FROM i JOIN t USING (conv_id) WHERE place > h),
s AS (SELECT i.conv_id, coalesce(list({'role': role, 'text': text} ORDER BY part, place) FILTER (role IS NOT NULL), []) AS turns FROM i LEFT JOIN r USING (conv_id) GROUP BY i.conv_id),
m AS (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS depth FROM s),
k AS (SELECT conv_id, depth, len(turns) = depth AS ends, turns[1:depth] AS path, CASE WHEN depth > 0 THEN strlen(turns[depth].text) ELSE 0 END AS size, min(conv_id) OVER (PARTITION BY depth, turns[1:depth]) AS low FROM m),
n AS (SELECT low, depth, count(*) AS n_convs, any_value(size) AS size, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '') AS ended FROM k GROUP BY low, depth),
p AS (SELECT n.*, u.low AS parent FROM n LEFT JOIN k u ON u.conv_id = n.low AND u.depth = n.depth - 1),
c AS (SELECT parent AS low, depth - 1 AS depth, count(*) AS n_children FROM p WHERE depth > 0 GROUP BY parent, depth),
g AS (SELECT p.*, coalesce(c.n_children, 0) AS n_children FROM p LEFT JOIN c USING (low, depth)),
b AS (SELECT a.low, a.depth, sum(CASE WHEN w.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((w.n_convs - 1) * w.size) AS saved FROM g w JOIN k a ON a.conv_id = w.low AND a.depth <= w.depth GROUP BY a.low, a.depth)
SELECT low AS conv_id, CAST(depth AS BIGINT) AS depth, parent AS parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(ended) AS ends_sha256 FROM g JOIN b USING (low, depth)""",
    "op13_line_dedup": """
WITH d AS (SELECT doc_id, row_number() OVER () AS rid, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
l AS (SELECT rid, doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 5),
j AS (SELECT k.*, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.keeper AS gone FROM k LEFT JOIN c USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT gone), '')) AS kept_sha256 FROM j GROUP BY rid, doc_id""",
}
