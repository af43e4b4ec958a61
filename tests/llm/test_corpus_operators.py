"""Each operator against a brute-force version on small hand-made tables with awkward rows."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ledgerflow.llm import components, decontaminate, language, licenses, mixing, quality, queries, simhash, tokens, topk, toxicity, urlfilter

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977}" for i in range(60_000))
ODD = [None, "", " ", "\x00", "a", "İ ſ K é", "one\u00a0two \u2003 three", "<|endoftext|> x <|endoftext|>", "emoji 😀😀 done", LONG, "x" * 5000]


def words(t):
    return WORD.findall((t or "").translate(LOWER))


def docs(spark, texts, **more):
    return spark.createDataFrame([(i, t, more.get("lang"), None if i % 5 == 0 else f"s{i % 3}", 7) for i, t in enumerate(texts)], SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def tokenizer():
    P = pytest.importorskip("public_tokenizers")
    return str(P.path("byte_bpe_50k.json"))


def test_token_counts(spark, tokenizer):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    texts = [*ODD, "It's  a\ttest,\n\n  isn't it?   ", "tail \u0085 \x1c space ", "a b" * 3, " \n x", ODD[5]]
    got = {r.doc_id: r for r in tokens.count_tokens(docs(spark, texts).withColumn("n_tokens", F.lit("clash")), tokenizer).collect()}
    for i, x in enumerate(texts):
        n = len(t.encode(x or "", add_special_tokens=False))
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (n, len((x or "").encode()), n > 512)
    assert tokens.count_tokens(empty(spark), tokenizer).count() == 0


def hits(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for item_id, t in items:
        v = words(t)
        if v:
            n = min(window, len(v))
            grams = {tuple(v[i : i + n]) for i in range(len(v) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in grams:
                    hit.update(range(i, i + n))
                    if item_id is not None:
                        found.add(str(item_id))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("group_bytes", [1 << 20, 200])
def test_decontaminate(spark, group_bytes):
    passage = " ".join(f"tok{i}" for i in range(25))
    items = [(1, passage), (2, "short item"), (3, "a"), (4, None), (5, ""), (None, "nameless test item words"), (2, "short item"), (11, "Tok3, TOK4 - tok5 tok6 tok7 tok8 tok9 tok10 tok11 tok12")]
    texts = [*ODD, passage, passage[20:120] + " end", "x SHORT, item y", "nameless\ntest item words", "tok3 tok4 tok5 tok6 tok7 tok8 tok9 tok10 tok11", f"start {passage} mid {passage.upper()}", "shorter short items", "b a b", "tok3"]
    table = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.decontaminate(docs(spark, texts).withColumn("n_hit", F.lit(-1)), table, group_bytes=group_bytes)
    for r in decontaminate.contract(out).collect():
        n, h, found = hits(texts[r.doc_id], items)
        assert (r.n_words, r.n_hit, r.n_items, r.contaminated) == (n, h, len(found), h > 0), texts[r.doc_id][:60]
        assert r.items_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
    none = table.filter("false")
    assert {r.n_hit for r in decontaminate.decontaminate(docs(spark, texts), none).collect()} == {0}
    assert decontaminate.decontaminate(empty(spark), table).count() == 0


def test_url_filter(spark):
    urls = [None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://A.Example.COM/en/x?y=/z", "https://www.example.com/en/", "https://x.www.example.com/en/q#f", "http://example.com/EN/", "http://notexample.com/en/", "ftp://b.net/es/1", "http://net/fr/", "http://n.net/de/", "a://b://c.com/", "http://example.com?/en/", "http://é.com/é", "http://example.com/en/" + "p/" * 500]
    urls += urls[6:8]
    urls += ["http://" + "a." * 100_000 + "www.example.com/en/", "http://" + "b." * 100_000 + "net", "http://." + "/fr/" * 3, "http://net./fr/"]
    rules = list(urlfilter.RULES)

    def judge(u):
        rest = u.split("://", 1)[1] if u and "://" in u else ""
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0] if rest[len(host) : len(host) + 1] == "/" else ""
        host = host.translate(LOWER)
        fit = [(len(h + p), h + p, v) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fit, default=(0, None, "allow"))
        return host, path, best[1], best[2]

    pages = spark.createDataFrame([(i, u, "html", "old") for i, u in enumerate(urls)], "page_id long, url string, html string, host string").withColumn("r_rule", F.lit("own")).withColumn("r_key", F.lit("own"))
    table = urlfilter.rule_table(spark)
    for limit in (1000, 0):
        got = sorted((r.page_id, (r.host, r.path, r.rule, r.verdict)) for r in urlfilter.filter_urls(pages, table, broadcast_rules=limit).collect())
        assert got == [(i, judge(u)) for i, u in enumerate(urls)]
    assert {r.verdict for r in urlfilter.filter_urls(pages, table.filter("false")).collect()} == {"allow"}
    assert urlfilter.filter_urls(pages.filter("false"), table).count() == 0


def aims(rows, weights=(3, 1, 2), share=1.5):
    size = Counter()
    for s, n in rows:
        size[s] += n
    order = sorted((s for s in size if s is not None), key=lambda s: s.encode()) + [None] * (None in size)
    w = {s: weights[i % 3] for i, s in enumerate(order)}
    goal, open_, target = share * sum(size.values()), set(order), {}
    while open_:
        level = (goal - sum(target.values())) / sum(w[s] for s in open_)
        over = {s for s in open_ if level * w[s] > 2 * size[s]}
        if not over:
            target |= {s: level * w[s] for s in open_}
            break
        target |= {s: 2 * size[s] for s in over}
        open_ -= over
    return size, target


def test_mixing(spark):
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(["w"] * int(rng.integers(0, 60))), "de", [None, "a", "b", "é", "hot", "hot", "hot"][int(rng.integers(7))], 1) for i in range(900)]
    rows += [(5000, None, None, "void", 0), (5001, "\u00a0 x\x0by", None, "b", 0), (1, rows[1][1], None, rows[1][3], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("taken", F.lit("clash"))
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    size, target = aims([(r[3], count(r[1])) for r in rows])
    out = mixing.mix(df).collect()
    taken = Counter()
    for r in out:
        assert r["size"] == count(r.text) and r.source_size == size[r.source]
        assert r.target == pytest.approx(target[r.source], rel=1e-9)
        assert r.taken == r.copies * r["size"] and 0 <= r.copies <= 2
        taken[r.source] += r.taken
    assert len(out) == len(rows)
    for s in size:
        assert abs(taken[s] - target[s]) <= 60
    again = mixing.mix(df.repartition(3)).collect()
    assert Counter((r.doc_id, r.taken) for r in out) == Counter((r.doc_id, r.taken) for r in again)
    assert mixing.mix(empty(spark)).count() == 0


def solved_rates(sizes, target, most=2.0):
    """NumPy: bisection for the lambda at which capped exponential tilts meet the target."""
    x = np.array(sizes, float)
    mean = x[x > 0].mean()
    rate = lambda a: np.where(x > 0, np.minimum(most, np.exp(np.minimum(a * x / mean, 1))), 0)
    if target >= most * x.sum() * (1 - 1e-12):
        return np.where(x > 0, most, 0)
    lo, hi = -1e4, 1e4
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (x * rate(mid)).sum() < target else (lo, mid)
    return rate(lo)


def test_mixing_rates_are_tilts_that_meet_the_targets(spark):
    rng = np.random.default_rng(13)
    rows = [(i, " ".join(["w"] * int(rng.geometric(0.02))), "de", f"s{int(rng.integers(7)) % 5}", 1) for i in range(1500)]
    rows.append((9000, LONG, None, "s1", 0))
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA).drop("n_chars").withColumn("lambda", F.lit(1)).withColumn("mean", F.lit("x"))).collect()
    by = defaultdict(list)
    for r in out:
        by[r.source].append(r)
    for mine in by.values():
        want = solved_rates([r["size"] for r in mine], mine[0].target)
        assert np.allclose([r.rate for r in mine], want, rtol=1e-5, atol=1e-6)
        assert sum(r["size"] * r.rate for r in mine) == pytest.approx(mine[0].target, rel=1e-6)
        assert all(r.taken <= 2 * r["size"] and abs(r.copies - r.rate) < 1 for r in mine)
    assert any(len({round(r.rate, 6) for r in mine}) > 10 for mine in by.values())


def test_mixing_deals_equal_rows_out(spark):
    """A third of the rows repeat id and text: as many of them get a copy as their source's target needs."""
    rows = [(i, "a b c d e", "de", "x", 1) for i in range(400)] + [(-1, "p q r s t", "de", "x", 1)] * 400 + [(-2, "p q", "de", "y", 1)] * 400
    out = mixing.mix(spark.createDataFrame(rows, SCHEMA), weights=(1, 1), share=1.2).collect()
    for source in "xy":
        mine = [r for r in out if r.source == source]
        assert abs(sum(r.taken for r in mine) / mine[0].target - 1) < 0.05


def test_licenses(spark):
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    texts = [*ODD, "All rights reserved. CC BY cc-by 4.0 all RIGHTS, reserved", "GNU General Public License general public", notice, notice.replace("free of", "free of any").replace("copy of this", "copy this"), "Permission is hereby granted", "licensed under \u212aind cc by", "cc\u00e9 by cc  by", "Released under the MIT License."]
    texts.append(texts[-1])
    odd = docs(spark, texts).withColumn("spans", F.lit(1)).withColumns({c: F.lit(f"own {c}") for c in ("label", "base", "template", "pos", "k", "gram", "t_pos", "t_size", "votes", "first", "last", "diagonal", "best")})
    scanned = licenses.scan_licenses(odd)
    assert {(r.label, r.pos, r.votes) for r in scanned.collect()} == {("own label", "own pos", "own votes")}
    got = licenses.contract(scanned).collect()
    listless = {r.doc_id: r for r in licenses.contract(licenses.scan_licenses(odd, listed=0, broadcast_rows=0)).collect()}
    assert all(listless[r.doc_id] == r for r in got)
    assert len(got) == len(texts)
    for r in got:
        w, base = words(texts[r.doc_id]), []
        for label, phrase in licenses.PHRASES:
            p = phrase.split()
            base += [(i, label) for i in range(len(w)) if w[i : i + len(p)] == p]
        places = sorted(i for i, _ in base)
        assert (r.n_words, r.n_base) == (len(w), len(base))
        assert (r.first_word, r.last_word) == ((places[0], places[-1]) if places else (None, None))
        assert r.base_labels == ",".join(sorted({x for _, x in base}))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1
    by = {r.doc_id: r for r in got}
    n = len(ODD)
    assert "mit-text" in by[n + 2].labels and by[n + 2].score == 1
    assert "mit-text" not in by[n + 4].labels
    assert by[n + 7].labels == "mit" == by[n + 8].labels
    assert licenses.scan_licenses(empty(spark)).count() == 0


def test_top_k(spark):
    rng = np.random.default_rng(5)
    vecs = [(i, [float(x) for x in rng.normal(size=8).astype(np.float32)]) for i in range(700)]
    vecs += [(1000 + i, vecs[50][1]) for i in range(40)] + [(2000, None), (2050, [1.0, None]), (2100, [float("nan")]), (2150, [float("inf")]), (2200, [1.0, 2.0]), (2250, [])]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<float>").withColumn("score", F.lit(0))
    ok = [(i, [math.floor(256 * x) for x in v]) for i, v in vecs if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for block, blocks, chunk in ((256, 64, 1024), (16, 4, 5)):
        got = topk.top_k(df, df.filter("vec_id % 50 = 0"), block=block, slice_blocks=blocks, chunk=chunk).collect()
        found = defaultdict(list)
        for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
            found[r.query_id].append((r.vec_id, r.score))
        for q, v in ok:
            if q % 50 == 0:
                best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in ok if i != q)[:5]
                assert found[q] == [(i, -s) for s, i in best], q
    few = df.filter("vec_id < 3")
    assert topk.top_k(few, few, k=5).count() == 6
    assert topk.top_k(df.filter("false"), df.filter("false")).count() == 0


def test_top_k_moves_few_blocks(spark):
    rng = np.random.default_rng(8)
    # 20 directions in turn over the ids, 100 neighbours each: a query needs the blocks of its own direction
    axes = np.eye(20) * 3
    vecs = [(i, [float(x) for x in axes[i // 100] + rng.normal(size=20) * 0.05]) for i in range(2000)]
    df = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    moved = []
    got = topk.top_k(df, df.filter("vec_id % 50 = 0"), block=25, slice_blocks=4, chunk=8, moved=moved).collect()
    m = np.floor(256 * np.array([v for _, v in vecs]))
    found = defaultdict(list)
    for r in sorted(got, key=lambda r: (r.query_id, r["rank"])):
        found[r.query_id].append((r.vec_id, r.score))
    for q in range(0, 2000, 50):
        s = m @ m[q]
        assert found[q] == [(i, s[i]) for i in sorted((i for i in range(2000) if i != q), key=lambda i: (-s[i], i))[:5]]
    going = moved[0].filter("query_row is not null").count()
    held = moved[0].filter("block is not null").count()
    # 40 queries and 80 blocks: the full grid of 20 slices and 5 chunks would move 800 queries and 400 blocks
    assert going <= 200 and held <= 200
    # of pages of 8 blocks each query goes to those of its direction
    moved = []
    topk.top_k(df, df.filter("vec_id % 50 = 0"), block=25, slice_blocks=4, chunk=8, page_slices=2, moved=moved).collect()
    assert moved[1].count() <= 40 * 3


def test_block_pruning_skips_blocks():
    rng = np.random.default_rng(1)
    far = [(np.arange(i * 50, i * 50 + 50), np.floor(rng.normal(size=(50, 4))) + (100 if i == 3 else 0)) for i in range(6)]
    q = np.full((2, 4), 10.0)
    best, scored = topk.search(q, np.array([-1, -2]), far, 5)
    assert scored == 2 and set(best.id[0]) <= set(range(150, 200))


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, size=(220, 2))] + [(i, i + 1) for i in range(1000, 1040)] + [(7, 7), (2000, 2001), (2001, 2000)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    groups = defaultdict(set)
    for x in parent:
        groups[find(x)].add(x)
    for members in groups.values():
        if len(members) > 1:
            roots = {got[m] for m in members}
            assert len(roots) == 1 and roots <= members
    assert components.connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def brute_fp(text):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if x]
    if not w:
        return 0
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


@pytest.mark.parametrize("max_tree,many", [(8192, 1000), (3, 1)])
def test_simhash(spark, monkeypatch, max_tree, many):
    monkeypatch.setattr(simhash, "MANY", many)
    rng = np.random.default_rng(4)
    base = [[f"w{int(x)}" for x in rng.integers(0, 5000, size=120)] for _ in range(20)]
    texts = list(ODD)
    for b in base:
        texts.append(" ".join(b))
        for _ in range(6):
            c = list(b)
            c[int(rng.integers(120))] = "changed"
            texts.append("\n".join(c))
    texts += [texts[20], "a b c", "A b\tc", "a\u00a0b c"]
    got = {r.doc_id: r for r in simhash.contract(simhash.near_duplicates(docs(spark, texts).withColumn("group", F.lit(1)), max_tree=max_tree)).collect()}
    fps = [brute_fp(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 4:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    for i in range(len(texts)):
        assert got[i].fingerprint == f"{fps[i]:016x}"
        assert got[i].component_id == find(i)
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_bk_forest_finds_all_within_radius():
    rng = np.random.default_rng(8)
    fp = rng.integers(0, 2**63, size=400, dtype=np.uint64)
    fp[200:] = fp[:200] ^ (np.uint64(1) << rng.integers(0, 63, size=200).astype(np.uint64))
    forest = simhash.Forest(fp, np.zeros(400, np.int64))
    found = {(int(a), int(b)) for q, n in forest.near(fp, np.zeros(400, np.int64), 4) for a, b in zip(q, n)}
    assert found == {(i, j) for i in range(400) for j in range(400) if bin(int(fp[i] ^ fp[j])).count("1") <= 4}


def labelled(spark, n=400):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    for i in range(n):
        w = [f"w{int(x)}" for x in rng.integers(0, 400, size=40)]
        toxic, low = i % 7 == 0, i % 5 == 1
        if toxic:
            w[int(rng.integers(40))] = "vileword"
        text = " ".join(x.upper() + "!!" for x in w[:12] * 3) if low else " ".join(w).capitalize() + "."
        rows.append((i, text, None, "s", 1))
        labels.append((i, int(not low), int(toxic)))
    rows += [(n, None, None, None, 0), (n + 1, "", None, None, 0), (n + 2, LONG, None, None, 0)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("module,label,parts,held", [(toxicity, "toxic", 3, 1), (quality, "quality", 5, 0)])
def test_classifiers(spark, module, label, parts, held):
    d, labels = labelled(spark)
    y = {r.doc_id: r[label] for r in labels.collect()}
    out = module.score(d.withColumn("score", F.lit("clash")), module.train(d, labels)).collect()
    assert len(out) == 403 and all(0 <= r.score <= 1 for r in out)
    test = [(y[r.doc_id], r.predicted) for r in out if r.doc_id in y and zlib.crc32(str(r.doc_id).encode()) % parts == held]
    assert sum(a == b for a, b in test) / len(test) > 0.95
    # labels of the held-out fold have no influence
    flipped = labels.withColumn(label, F.when(F.crc32(F.col("doc_id").cast("string")) % parts == held, 1 - F.col(label)).otherwise(F.col(label)))
    again = {r.doc_id: r.score for r in module.score(d, module.train(d, flipped)).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score, abs=1e-9) for r in out)
    nothing = module.score(d, module.train(d, labels.filter("false"))).collect()
    assert {r.score for r in nothing} == {0.5}
    assert module.score(empty(spark), module.train(d, labels)).count() == 0


def test_language_rejects_unlearned_texts_but_no_clean_short_ones(spark):
    rng = np.random.default_rng(23)
    parts = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["sch", "ung", "ber", "ei"]}
    word = lambda lang: "".join(rng.choice(parts[lang], size=3))
    rows = [(i, " ".join(word("xx" if i % 2 else "yy") for _ in range(10 + i % 80)), "xx" if i % 2 else "yy") for i in range(600)]
    # one odd row of each length class and language must not set the limit
    rows += [(5000 + 2 * k + e, " ".join(["qzwv"] * (10 * 2**k) + [word(lang)]), lang) for k in range(4) for e, lang in enumerate(parts)]
    model = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), held=-1)
    blob = lambda n: "".join(rng.choice(list("bcdfghjknpqrstvwxz"), size=n))
    alien = [(i, " ".join([blob(7) for _ in range(12 + i % 60)] + [word("xx")])) for i in range(40)]
    short = [(100 + i, word("xx" if i % 2 else "yy")) for i in range(40)] + [(200, "A."), (201, "Ka.")]
    got = {r.doc_id: r.rejected for r in language.identify(spark.createDataFrame(alien + short, "doc_id long, text string"), model).collect()}
    assert all(got[i] for i, _ in alien)
    assert not any(got[i] for i, _ in short)


def test_language(spark):
    rng = np.random.default_rng(9)
    syllables = {"xx": ["ka", "lo", "mi"], "yy": ["sch", "ung", "ber"], "zz": ["ção", "ém", "ló"]}
    rows = []
    for i in range(300):
        lang = "xyz"[i % 3] * 2
        text = " ".join("".join(rng.choice(syllables[lang], size=3)) for _ in range(30))
        rows.append((i, text, lang if i % 10 else None, lang, 1))
    odd = [None, "", "123 !?", "１２", "漢字漢字漢字漢字", "KALOMI KALO"]
    rows += [(1000 + i, t, None, None, 0) for i, t in enumerate(odd)]
    d = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in language.identify(d.withColumn("rejected", F.lit(1)), language.train(d)).collect()}
    assert len(got) == len(rows)
    for i in range(300):
        assert got[i].lang_pred == "xyz"[i % 3] * 2 and not got[i].rejected and 0 < got[i].score <= 1
    for i in (1000, 1001, 1002, 1003):
        assert (got[i].lang_pred, got[i].score, got[i].rejected) == ("und", 0.0, True)
    assert got[1004].rejected and got[1004].lang_pred in syllables
    assert got[1005].lang_pred == "xx"
    assert {r.lang_pred for r in language.identify(d, language.train(d.withColumn("lang", F.lit(None).cast("string")))).collect()} == {"und"}
    assert language.identify(empty(spark), language.train(d)).count() == 0


def plain_ftrl(rows, epochs, alpha, beta, l1, l2):
    """FTRL-proximal with dictionaries, one weight at a time, in the operator's order of examples."""
    z, n, bz, bn = defaultdict(float), defaultdict(float), 0.0, 0.0
    weight = lambda i: 0.0 if abs(z[i]) <= l1 else -(z[i] - math.copysign(l1, z[i])) / ((beta + math.sqrt(n[i])) / alpha + l2)
    rng = np.random.default_rng(7)
    for _ in range(epochs):
        for e in rng.permutation(len(rows)):
            ids, y = rows[e]
            w = {i: weight(i) for i in ids}
            b = -bz / ((beta + math.sqrt(bn)) / alpha)
            g = 1 / (1 + math.exp(-max(-35, min(35, sum(w.values()) + b)))) - y
            for i in ids:
                z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / alpha * w[i]
                n[i] += g * g
            bz += g - (math.sqrt(bn + g * g) - math.sqrt(bn)) / alpha * b
            bn += g * g
    return {i: weight(i) for i in list(z) if weight(i)}, -bz / ((beta + math.sqrt(bn)) / alpha)


def test_ftrl_against_dictionaries(spark):
    rng = np.random.default_rng(31)
    rows = [(np.unique(rng.integers(0, 300, size=25)).astype("<i4"), int(i % 3 == 0)) for i in range(150)]
    rows = [(np.union1d(ids, [301]).astype("<i4") if y else ids, y) for ids, y in rows]
    used, w, bias = toxicity.fit(rows)
    want, want_bias = plain_ftrl([(ids.tolist(), y) for ids, y in rows], toxicity.EPOCHS, toxicity.ALPHA, toxicity.BETA, toxicity.L1, toxicity.L2)
    assert dict(zip(used.tolist(), w.tolist())) == pytest.approx(want) and bias == pytest.approx(want_bias)
    # scores are the sums of the weights of a text's distinct features
    d, labels = labelled(spark, 120)
    model = toxicity.train(d, labels)
    known = dict(zip(model[0].tolist(), model[1].tolist()))
    import pyarrow as pa

    for r in toxicity.score(d, model).collect():
        _, ids, _ = toxicity.features(pa.array([r.text or ""]))
        assert r.score == pytest.approx(1 / (1 + math.exp(-(model[2] + sum(known.get(i, 0.0) for i in set(ids.tolist()))))))


def test_quality_votes_against_all_pairs(spark):
    """Every document against every labelled vector by plain cosines and sorted neighbours."""
    import pyarrow as pa

    d, labels = labelled(spark, 120)
    idf, basis, known, y = model = quality.train(d, labels)
    for r in quality.score(d, model).collect():
        v = [math.log1p(c) * w for c, w in zip(quality.describe(pa.array([r.text or ""]))[0].tolist(), idf.tolist())]
        x = [sum(a * b for a, b in zip(v, basis[:, j].tolist()) if a) for j in range(basis.shape[1])]
        norm = math.sqrt(sum(a * a for a in x))
        cos = sorted(((max(sum(a * b for a, b in zip(x, k)) / norm, 0) if norm else 0, label) for k, label in zip(known.tolist(), y.tolist())), reverse=True)
        near = [(c**quality.POWER, label) for c, label in cos if c >= cos[quality.NEIGHBOURS - 1][0] - 1e-7]
        total = sum(c for c, _ in near)
        want = sum(c * label for c, label in near) / total if total else float(y.mean())
        assert r.score == pytest.approx(want, abs=2e-3), r.doc_id


def test_language_against_dictionaries(spark):
    rng = np.random.default_rng(17)
    parts = {"xx": ["ka", "lo", "mi", "tu"], "yy": ["sch", "ung", "ber", "ei"]}
    rows = [(i, " ".join("".join(rng.choice(parts["xx" if i % 2 else "yy"], size=3)) for _ in range(20)), "xx" if i % 2 else "yy", None, 1) for i in range(120)]
    rows += [(500, "Ka\u00e9 lo-MI", None, None, 0), (501, "a", None, None, 0)]
    d = spark.createDataFrame(rows, SCHEMA)
    languages, centres, owner, idf, _ = model = language.train(d)

    def place(g):
        h = (g[0] << 16 | g[1] << 8 | g[2]) * 0x9E3779B1 & 0xFFFFFFFF
        return h >> 20

    for r in language.identify(d, model).collect():
        c = [b if 0x61 <= b <= 0x7A or b >= 0x80 else 32 for b in r.text.lower().encode()]
        grams = Counter(place(c[i : i + 3]) for i in range(len(c) - 2) if c[i : i + 2] != [32, 32] and c[i + 1 : i + 3] != [32, 32])
        v = {k: math.log1p(n) * float(idf[k]) for k, n in grams.items()}
        norm = math.sqrt(sum(x * x for x in v.values())) or 1
        cos = [min(1, max(0, sum(x * float(m[k]) for k, x in v.items()) / norm)) for m in centres]
        assert r.score == pytest.approx(max(cos), abs=1e-5)
        assert r.lang_pred in {languages[owner[i]] for i, x in enumerate(cos) if x >= max(cos) - 1e-6}


def test_long_texts_are_described_block_by_block(monkeypatch):
    import pyarrow as pa

    from ledgerflow.llm import common

    texts = pa.array([LONG, None, "", "ab", "abc\n" * 700, "x" * 3000, "\u00e9\u00e9 a"])
    whole = quality.describe(texts), language.counts(texts), toxicity.features(texts)[1]
    for module in (quality, language):
        monkeypatch.setattr(module, "blocks_of", lambda n: common.blocks_of(n, 997))
    monkeypatch.setattr(common, "SLICE_BYTES", 1024)
    parts = quality.describe(texts), language.counts(texts), toxicity.features(texts)[1]
    assert all(np.array_equal(a, b) for a, b in zip(whole, parts))


def test_training_rows_are_bounded_after_the_join(spark):
    texts = spark.range(300).select(F.lit(7).cast("long").alias("doc_id"), F.concat(F.lit("w"), F.col("id") % 50).alias("text"))
    labels = spark.createDataFrame([(7, 1), (7, 1)], "doc_id long, toxic int")
    rows = toxicity.training_rows(texts, labels, "doc_id", "text", "toxic", 3, -1, 10).withColumn("text", F.encode("text", "utf-8"))
    assert rows.count() == 300
    assert len(toxicity.bounded(rows, "text", 20)) == 20
    assert len(toxicity.bounded(rows, "text", 1000)) == 50
    assert len(toxicity.bounded(rows, "text", 1000, most_bytes=10)) < 10


def test_across_parts_against_all_pairs(spark, monkeypatch):
    """Members of components that a forest left in parts: the same components as by all pairs, whatever the size of blocks."""
    rng = np.random.default_rng(3)
    rows = []
    for c in range(3):
        base = rng.integers(0, 1 << 40, size=60)
        for m in range(25):
            s = base.copy()
            s[rng.choice(60, size=int(rng.integers(0, 14)), replace=False)] = rng.integers(0, 1 << 40)
            rows.append((c, 100 * c + m, 100 * c + m, [0, 0, 0, 0], sorted({int(x) for x in s})))
    df = spark.createDataFrame(rows, "whole long, label long, id long, full array<long>, runs array<long>")
    want = list(range(len(rows)))

    def find(x):
        while want[x] != x:
            x = want[x]
        return x

    for i, a in enumerate(rows):
        for j, b in enumerate(rows[:i]):
            u, v = set(a[4]), set(b[4])
            if a[0] == b[0] and len(u & v) / len(u | v) >= 0.8:
                want[find(i)] = find(j)
    at = {r[2]: i for i, r in enumerate(rows)}
    for block in (512, 7):
        got = components.connected_components(simhash.across_parts(df, 0.8, 256, rows=block))
        groups = defaultdict(set)
        for r in got.collect():
            groups[r.root].add(find(at[r.node]))
        assert all(len(g) == 1 for g in groups.values())
        linked = {i for i in range(len(rows)) if sum(find(j) == find(i) for j in range(len(rows))) > 1}
        assert {at[r.node] for r in got.collect()} == linked
        roots = {at[r.node]: r.root for r in got.collect()}
        assert all(roots[i] == roots[j] for i in linked for j in linked if find(i) == find(j))


def test_confirmed_pairs_of_a_hub_against_sets(spark):
    """A class in most pairs, on either side, meets copies of its set: the same pairs as by plain sets, none twice."""
    rng = np.random.default_rng(9)
    base = list(range(60))
    sets = {c: sorted({*base[int(rng.integers(0, 9)) :], *(1000 * c + np.arange(rng.integers(0, 9))).tolist()}) for c in range(120)}
    sets[119] = []
    pairs = [(5, c) for c in range(6, 120)] + [(c, 110) for c in range(5)] + [(c, 119) for c in range(6, 60)]
    df, held = spark.createDataFrame(pairs, "src long, dst long"), spark.createDataFrame(list(sets.items()), "__class long, runs array<long>")
    want = sorted((a, b) for a, b in pairs if len({*sets[a]} & {*sets[b]}) >= 0.8 * len({*sets[a]} | {*sets[b]}))
    for most in (7, 256):
        assert sorted(map(tuple, simhash.confirmed(df, held, 0.8, most=most).collect())) == want
    assert 0 < len(want) < len(pairs)
    assert simhash.confirmed(df.filter("false"), held, 0.8).count() == 0


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_cover_their_tables(spark, name):
    sf = "/root/testdata/sf0.001"
    table = {"op6_exact_top_k": None, "op8_url_filter": "pages"}.get(name, "documents")
    out = queries.QUERIES[name](spark, sf)
    if name == "op12_prefix_trie":
        assert out.filter("depth = 0").first().n_convs == spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id").distinct().count()
    elif table:
        assert out.count() == spark.read.parquet(f"{sf}/{table}.parquet").count()
    else:
        assert out.count() == 5 * spark.read.parquet(f"{sf}/embeddings.parquet").filter("vec_id % 50 = 0").count()


def test_token_counts_without_white_space(spark, tokenizer):
    """Long texts without white space are cut where letters, digits and other characters meet, and nowhere else."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenizer)
    rng = np.random.default_rng(31)
    alphabet = list("abZéß漢字語，。١٢3'’.-_<|>😀́") + ["'s", "'ll", "''", "<|endoftext|>"]
    made = ["".join(rng.choice(alphabet, size=n)) for n in (1500, 3000, 3000, 6000)]
    # with a special string inside, and none
    texts = [*made, *(x.replace("<|endoftext|>", "") for x in made), "漢字，" * 3000, "x" * 5000 + "'s" * 2000, "a1" * 4000]
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(docs(spark, texts), tokenizer).collect()}
    assert got == {i: len(t.encode(x, add_special_tokens=False)) for i, x in enumerate(texts)}
    assert max(map(len, tokens.pieces("漢字，" * 3000))) < 10
    assert tokens.pieces("don't" * 1000)[:3] == ["don", "'tdon", "'tdon"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_of_other_kinds_of_files(spark, name):
    """Files that rewrite white space have their texts encoded whole."""
    P = pytest.importorskip("public_tokenizers")
    path = str(P.path(name))
    texts = ["It's  A\tTest,\n\n  isn't it?   ", "Ünïcödé  漢字 é", *ODD[:9]]
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        library = SentencePieceProcessor(model_file=path)
        want = [len(library.encode(x or "")) for x in texts]
    else:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        library.no_truncation()
        want = [len(library.encode(x or "", add_special_tokens=False)) for x in texts]
    got = {r.doc_id: r.n_tokens for r in tokens.count_tokens(docs(spark, texts), path).collect()}
    assert got == dict(enumerate(want))


def test_top_k_leaves_vectors_out_that_overflow(spark):
    rows = [(i, [float(i % 7), 1.0]) for i in range(120)] + [(200, [1e307, 0.0]), (201, [1.0, -1e18]), (202, [float("inf"), 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.filter("vec_id % 50 = 0"), k=3).collect()
    assert {r.query_id for r in got} == {0, 50, 100} and {r.vec_id for r in got} <= set(range(120))


def test_licenses_lower_templates_as_texts(spark):
    templates = licenses.template_table(spark, phrases=(), notices=(("é", "Écrit Par Élise Sous Licence Ouverte Étendue"),))
    out = licenses.scan_licenses(docs(spark, ["x écrit par élise sous licence ouverte étendue", "ÉCRIT PAR ÉLISE SOUS LICENCE OUVERTE ÉTENDUE", "par élise"]), templates).collect()
    assert [r.labels for r in sorted(out, key=lambda r: r.doc_id)] == [["é"], ["é"], []]


def test_rows_are_numbered_where_their_order_is_fixed(spark, tmp_path):
    from ledgerflow.llm.common import stable

    path = str(tmp_path / "t")
    spark.range(1000).write.parquet(path)
    scan = spark.read.parquet(path).filter("id > 3")
    assert stable(scan) is scan
    dealt = stable(scan.repartition(7))
    assert "Exchange" not in dealt._jdf.queryExecution().executedPlan().toString()
    number = lambda df: {r.id: r.n for r in df.select("id", F.monotonically_increasing_id().alias("n")).collect()}
    assert number(dealt) == number(dealt) and len(number(dealt)) == 996


def test_languages_are_bounded(spark):
    rows = [(i, "kalomi tulomi kami " * 5, f"l{i % 30}" if i % 3 else "main") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert len(language.train(df, held=-1)[0]) == 31 - 10 and language.train(df, held=-1, max_langs=1)[0] == ["main"]


def test_mixing_of_long_tied_and_clashing_rows(spark):
    rows = [(i, "same words here", "s", 1) for i in range(40)] + [(99, LONG, "s", 1), (100, None, None, 1), (101, "", None, 1), (102, "one", None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, copies int").withColumn("size", F.lit("mine")).withColumn("target", F.lit(-1))
    out = mixing.mix(df)
    assert len(out.columns) == len(set(out.columns)) and out.count() == len(rows)
    got = out.collect()
    for source in ("s", None):
        mine = [r for r in got if r.source == source]
        assert {r["size"] for r in mine} <= {3, 60_000, 0, 1} and abs(sum(r.taken for r in mine) - mine[0].target) <= max(r["size"] for r in mine)


def test_toxicity_features_stay_off_the_driver(spark, monkeypatch):
    """The driver gets keys, sizes and the few weights; the features of the training rows are many times as large."""
    import pyarrow as pa

    d, labels = labelled(spark)
    frame, met = type(d), []
    plain = frame.collect

    def watched(self):
        got = plain(self)
        met.extend(len(v) for row in got for v in row if isinstance(v, (bytes, bytearray)))
        return got

    monkeypatch.setattr(frame, "collect", watched)
    used, weight, bias = toxicity.train(d, labels)
    assert 0 < len(used) == len(weight)
    monkeypatch.undo()
    # what the fit sees: distinct features of four bytes of each labelled text outside the fold
    chosen = toxicity.training_rows(d, labels, "doc_id", "text", "toxic", 3, 1, toxicity.MAX_TRAIN).collect()
    chosen.sort(key=lambda r: (str(r["__id"]), r.label))
    rows = []
    for r in chosen:
        _, ids, _ = toxicity.features(pa.array([r.text]))
        rows.append((np.unique(ids).astype("<i4"), r.label))
    assert sum(met) < sum(ids.nbytes for ids, _ in rows) / 10
    want = toxicity.fit(rows)
    assert np.array_equal(used, want[0]) and np.array_equal(weight, want[1]) and bias == want[2]
