"""Infilling, the prefix trie and line deduplication against brute force on small hand-made tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import infill, lines, prefixes

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
LONG = " ".join(f"word{i % 977}é" for i in range(40_000)) + "x" * 200_000
ODD = [None, "", " ", "\x00", "a", "İ ſ K é", "😀😀a😀", "has <P> mark", "<S>", "x<M", "ends with <", "<P", "ab", "\n\n", LONG, "y" * 70_000]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None, "s", 7) for i, t in rows], SCHEMA)


def infilled(doc_id, text):
    """The contract, unit by unit."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize("piece_bytes", [infill.PIECE_BYTES, 64])
def test_fill_in_middle(spark, piece_bytes):
    rng = np.random.default_rng(4)
    alphabet = list("abcXYZ  \n.,<>PSM1é😀")
    rows = list(enumerate(ODD if piece_bytes > 1000 else [t for t in ODD if t is None or len(t) < 1000]))
    rows += [(100 + i, "".join(rng.choice(alphabet, size=int(rng.integers(1, 300))))) for i in range(300)]
    # rows that repeat id and text, and one id with two texts
    rows += [rows[4], rows[4], (4, "another text of the same id"), (None, "a text without an id"), (None, None)]
    table = docs(spark, rows).repartition(5).withColumn("form", F.lit("clash"))
    got = infill.fill_in_middle(table, piece_bytes=piece_bytes).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.text) for r in got) == Counter(rows)
    forms = Counter()
    for r in got:
        n, form, prefix, middle, output = infilled(r.doc_id, r.text)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, prefix, middle)
        assert r.output == output and r.output_sha256 == sha(output)
        assert r.restored == (r.text or "") and r.restored_sha256 == sha(r.text or "")
        forms[form] += 1
    assert min(forms["plain"], forms["psm"], forms["spm"]) > 10
    lean = infill.contract(infill.fill_in_middle(table, keep=["doc_id"], texts=False, piece_bytes=piece_bytes))
    assert Counter((r.doc_id, r.output_sha256, r.restored_sha256) for r in lean.collect()) == Counter((r.doc_id, r.output_sha256, r.restored_sha256) for r in got)


def test_fill_in_middle_of_nothing(spark):
    out = infill.fill_in_middle(docs(spark, []))
    assert out.count() == 0 and {"output", "restored", "lang"} <= set(out.columns)


def test_restoration_reads_the_output_only():
    for form, text in (("psm", "<P>ab<S>e<<S<M>cd"), ("spm", "<S>e<<S<P>ab<M>cd")):
        for size in range(1, 8):
            r = infill.Restorer(form)
            parts = defaultdict(bytes)
            data = text.encode()
            found = [x for i in range(0, len(data), size) for x in r.feed(data[i : i + size])] + list(r.end())
            for part, piece in found:
                parts[part] += piece
            assert parts[0] + parts[1] + parts[2] == b"abcde<<S"
    with pytest.raises(ValueError, match="lacks"):
        list(infill.Restorer("psm").end())


def test_a_lost_piece_changes_the_digest(spark):
    """The digest of the restored text comes from the pieces that were sent, not from the text beside them."""
    table = docs(spark, [(2, "one two three four five six seven eight nine ten " * 9)])
    sent = infill.pieces(table, piece_bytes=8)
    whole = infill.restored_digests(infill.output_digests(sent)).first()
    without_mark = sent.filter("place >= 0 AND NOT startswith(decode(piece, 'UTF-8'), '<')").agg(F.max("place")).first()[0]
    cut = sent.filter(F.col("place") != without_mark).sortWithinPartitions("r1", "r2", "place")
    less = infill.restored_digests(infill.output_digests(cut)).first()
    assert whole.restored_sha256 == sha(table.first().text) != less.restored_sha256


def trie(rows):
    """Nodes by comparing all prefixes."""
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            turns[c].append((turn is not None, turn or 0, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, t) for _, _, r, _, t in sorted(v)] for c, v in turns.items()}
    built = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        base = c - int(np.fmod(c, 5))
        built[c] = own.get(base, [])[:h] + own[c][h:]
    return nodes_of(built)


def nodes_of(built):
    members = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            members[tuple(built[c][:d])].append(c)
    out = []
    for path, convs in members.items():
        below = [p for p in members if p[: len(path)] == path]
        childless = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(str(c) for c in convs if len(built[c]) == len(path))
        out.append((convs[0], len(path), members[path[:-1]][0] if path else None, len(convs), sum(len(p) == len(path) + 1 for p in below), len(childless), saved, sha(ends)))
    return sorted(out, key=str)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "old") for r in rows], "conv_id long, turn long, role string, text string, depth string")


def some_conversations():
    rng = np.random.default_rng(12)
    rows = []
    for c in list(range(-12, 90)) + [10**15 + i for i in range(7)] + [(1 << 63) - 1, -(1 << 63)]:
        if c % 7 == 3:
            continue  # absent ones, openers of their group among them
        for turn in range(int(rng.integers(1, 12))):
            rows.append((c, turn, ["user", "assistant", None][int(rng.integers(3))] if turn > 1 else "user", ["hello", "é ü", "", None, f"t{int(rng.integers(3))}"][int(rng.integers(5))]))
    for c in range(200, 260):
        rows += [(c, 0, "user", "same first"), (c, 1, "assistant", "same answer")]
    rows += [(300, t, "user", f"turn {t} of many") for t in range(150)]
    rows += [(7, None, "system", "before all"), (7, 2, "user", "a tie"), (7, 2, "user", "a tie"), (7, 2, "assistant", "a tie"), (None, 1, "user", "nobody's"), (61, 0, None, "x" * 30_000)]
    return rows


@pytest.mark.parametrize("convs,turns", [(1024, 1 << 18), (3, 1 << 18), (1024, 8)])
def test_prefix_trie(spark, convs, turns):
    rows = some_conversations()
    table = conversations(spark, rows).repartition(3)
    rebuilt = prefixes.rebuilt(prefixes.numbered(table).cache())
    got = sorted((tuple(r[c] for c in COLUMNS) for r in prefixes.prefix_trie(rebuilt, shard_convs=convs, shard_turns=turns).collect()), key=str)
    assert got == trie(rows)


def test_prefix_trie_of_whole_conversations_and_of_none(spark):
    rows = [(c, t, "user", f"{t if c % 3 else 0}{'x' if c > 8 and t > 2 else ''}") for c in range(12) for t in range(5)]
    table = conversations(spark, rows)
    built = defaultdict(list)
    for c, _, role, text in rows:
        built[c].append((role, text))
    got = prefixes.prefix_trie(prefixes.whole(prefixes.numbered(table)), shard_convs=4)
    assert sorted((tuple(r[c] for c in COLUMNS) for r in got.collect()), key=str) == nodes_of(built)
    assert prefixes.contract(conversations(spark, [])).count() == 0
    assert prefixes.contract(conversations(spark, [(None, 1, "user", "x")])).count() == 0


def test_one_walk_intersects_bitsets():
    """Members of a node are those whose turns agree at every position so far, and ends are in order."""
    conv, part = [1, 1, 2, 2, 2, 3], [-1, 1, -1, 1, 1, -1]
    found = prefixes.walk(np.array(conv), np.array(part), np.array([0, 7, 0, 7, 8, 0]), np.array([0, 7, 0, 7, 8, 0]), np.array([0, 3, 0, 3, 4, 0]))
    by = sorted(zip(found["depth"], found["n"], found["conv_id"], found["ends"], found["size"], found["childless"], strict=True))
    assert by == [(0, 3, 1, [3], 0, False), (1, 2, 1, [1], 3, False), (2, 1, 2, [2], 4, True)]
    assert found["last"][0] == len(found["pre"]) - 1


def test_shards_end_between_conversations():
    conv = np.repeat([1, 2, 3, 4, 5, 6], [3, 1, 9, 2, 2, 1])
    done = list(prefixes._cuts(conv, True, 2, 5))
    assert [i for a, b in done for i in range(a, b)] == list(range(len(conv)))
    assert all(a == 0 or conv[a] != conv[a - 1] for a, _ in done)
    open_ = list(prefixes._cuts(conv, False, 2, 5))
    assert open_ == done[: len(open_)] and conv[open_[-1][1]] != conv[open_[-1][1] - 1]
    assert list(prefixes._cuts(np.empty(0, np.int64), True, 2, 5)) == []


def deduped(rows, min_chars=40, min_docs=5):
    space = " \t\n\x0b\x0c\r"
    key = lambda line: line.strip(space).translate(LOWER)
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= min_chars:
                holders[key(line)].add(i)
    order = lambda i: (i is not None, i or 0)
    keeper = {k: max(v, key=order) for k, v in holders.items() if len(v) >= min_docs}
    out = []
    for i, t in rows:
        parts = (t or "").split("\n")
        left = [x for x in parts if key(x) not in keeper or keeper[key(x)] == i]
        out.append((i, t, len(parts), len(parts) - len(left), "\n".join(left)))
    return Counter(out)


def test_line_dedup(spark):
    rng = np.random.default_rng(5)
    shared = [f"This shared line number {i} goes on for long ENOUGH é to count" for i in range(6)]
    short = "short shared line"
    rows = []
    for i in range(120):
        parts = [f"own line {i} {j} " + "z" * int(rng.integers(0, 60)) for j in range(int(rng.integers(0, 6)))]
        for k, line in enumerate(shared):
            if i % (k + 2) == 0:
                parts.insert(int(rng.integers(0, len(parts) + 1)), ["\t" + line.upper().replace("É", "é") + " \r", line, line + "\x0b"][i % 3])
        if i % 2:
            parts.insert(0, short)
        rows.append((i, "\n".join(parts)))
    edge = "e" * 40
    rows += [(1000 + i, edge) for i in range(5)] + [(1100 + i, "f" * 39) for i in range(9)] + [(1200 + i, "g" * 45) for i in range(4)]
    # É is no A-Z letter, so that these lines differ from the shared ones in four documents only
    rows += [(1300 + i, shared[0].upper()) for i in range(4)]
    # one document in several rows counts once; rows that repeat id and text; lines twice in a text
    rows += [(2000, "h" * 50), (2000, "h" * 50), (2000, "h" * 50 + "\nmore"), (2001, "h" * 50), (2002, "h" * 50 + "\n" + "h" * 50)]
    rows += [(2100 + i, "k" * 50 + "\n\n" + "k" * 50) for i in range(6)] + [(None, "k" * 50), (None, "k" * 50), (None, None), (3000, None), (3001, ""), (3002, "\n\n")]
    rows += [(4000 + i, "m" * 50 + " ") for i in range(6)] + [(4100 + i, "\n".join(f"a line that is repeated everywhere number {j % 400}" for j in range(5000))) for i in range(5)]
    table = docs(spark, rows).repartition(4).withColumn("n_lines", F.lit("clash"))
    got = lines.dedup_lines(table)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped, r.kept_text) for r in got.collect()) == deduped(rows)
    assert set(lines.contract(got).columns) == {"doc_id", "n_lines", "n_dropped", "kept_sha256"}
    few = lines.dedup_lines(docs(spark, rows[:40]), min_chars=10, min_docs=2)
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped, r.kept_text) for r in few.collect()) == deduped(rows[:40], 10, 2)
    assert lines.dedup_lines(docs(spark, [])).count() == 0


def test_line_dedup_has_no_python(spark):
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        lines.contract(lines.dedup_lines(spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a").alias("text")))).explain("formatted")
    assert not re.search("Python|Pandas|InArrow", out.getvalue())
