"""SimHash near-duplicates: BK-trees over shards of the distinct fingerprints.

Texts are lowered A-Z and cut at ASCII white space; the XXH64 (seed 42) of every run of
``words`` consecutive words, repeats included, votes on 64 bits (a shorter text is one run,
a text without words has fingerprint 0). Equal fingerprints are one class.

Fingerprints that differ in at most ``radius`` of 64 bits agree on at least ``agree`` of
``blocks`` bit blocks when radius <= blocks - agree, so every choice of ``agree`` blocks gives
a shard key: no such pair is missed. (A larger radius is searched within the same shards, and
then finds what shares a shard.) Each shard has a BK-tree whose children are keyed by their
integer Hamming distance to the parent; a search follows only edges within the radius. All
shards of a batch form one forest, built and searched level by level in vectorised steps.

The set of all fingerprints has no size bound, so shard trees reach their queries by a shuffle
on the shard key and are not broadcast. A shard of more than ``max_tree`` fingerprints is split
into trees of about that many; every member of the shard asks each of these trees.

Within a shard links are reduced to a forest over the same components, so that a group of
copies gives about as many edges as members. Components come from ``components``.

With ``probes`` over 1 further words of the fingerprint are searched in the same way, each in its
own shards: a link found by any of them counts.

``confirm_bits`` more bits, from further hashes of the same runs, may confirm a link: of all
64 + confirm_bits bits at most ``wide`` may differ. With ``distinct`` each run votes once, which
brings the share of differing bits close to the angle between sets of runs.

With ``exact`` the bits only propose: a pair counts if the Jaccard similarity of the two texts' sets
of runs is at least ``exact``. ``confirmed_links`` says in which order proposed pairs are looked at,
so that a group of many near copies does not carry its sets once for each pair.

A null text counts as one without words. Null ids never name a component that has another
id. Repeated rows are in one component. Empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import Scratch, map_texts, mix, text_bytes
from ledgerflow.llm.components import connected_components

MAX_TREE = 8192
#: Copies of one fingerprint above which its rows are not dealt by fingerprint.
MANY = 1000
#: Pairs that one step of a search looks at.
STEP_PAIRS = 1 << 20
#: Pairs held before a forest of them is taken.
HELD_PAIRS = 1 << 21
#: Members and bytes of run hashes of a block in which parts of a component meet.
CELL_ROWS, CELL_BYTES = 512, 8 << 20
#: Pairs of one class that meet one copy of its set, about.
HUB_PAIRS = 256
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def run_hashes(text: bytes, words: int) -> np.ndarray:
    """XXH64 of every run of words."""
    cut = text.translate(_LOWER).split()
    if not cut:
        return np.empty(0, np.uint64)
    if len(cut) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(cut), 42)], np.uint64)
    joined = b" ".join(cut)
    ends = np.cumsum([len(w) + 1 for w in cut]).tolist()
    starts = [0, *ends[: len(cut) - words]]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s : e - 1], 42) for s, e in zip(starts, ends[words - 1 :], strict=True)], np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The 64 bits that are set in over half the hashes."""
    if not len(hashes):
        return 0
    votes = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 4096):
        bits = np.unpackbits(hashes[start : start + 4096].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, text_col: str = "text", words: int = 4, confirm_bits: int = 0, distinct: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with fp (the 64 bits as a long) and more (confirming bits, longs)."""
    new = [("fp", T.LongType()), ("more", T.ArrayType(T.LongType()))]

    def make():
        def work(texts: pa.Array) -> list[pa.Array]:
            raw, offsets = text_bytes(texts)
            raw = raw.tobytes()
            fp, more = [], []
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                h = run_hashes(raw[a:b], words)
                if distinct:
                    h = np.unique(h)
                fp.append(majority(h))
                extra = []
                for _ in range(confirm_bits // 64):
                    h = mix(h)
                    extra.append(majority(h))
                more.append(np.array(extra, np.uint64).view(np.int64))
            return [pa.array(np.array(fp, np.uint64).view(np.int64)), pa.array(more, pa.list_(pa.int64()))]

        return work

    return map_texts(docs, text_col, new, make, keep)


def shard_keys(fp: Column, blocks: int, agree: int, probe: int) -> Column:
    """(key, probe) for each choice of ``agree`` bit blocks; the key is made of the choice and its bits."""
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges[:-1], edges[1:], strict=True)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), agree)):
        keys.append(F.xxhash64(F.lit(probe), F.lit(number), fp.bitwiseAND(F.lit(signed(sum(masks[c] for c in chosen))).cast("long"))))
    return F.transform(F.array(*keys), lambda k: F.struct(k.alias("key"), fp.alias("probe")))


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


class Forest:
    """BK-trees of many shards at once; child[node, d] is the child at distance d, or -1."""

    def __init__(self, fp: np.ndarray, shard: np.ndarray):
        """``shard`` numbers the trees from 0 and is sorted; fingerprints of a tree are distinct."""
        self.fp = fp
        roots = np.flatnonzero(np.diff(shard, prepend=-1))
        self.root = roots
        self.child = np.full((len(fp), 65), -1, np.int32)
        item = np.setdiff1d(np.arange(len(fp)), roots, assume_unique=True)
        node = roots[shard[item]]
        while len(item):
            d = distance(fp[item], fp[node])
            taken = self.child[node, d]
            free = taken < 0
            # of the items that meet a free place the first one becomes the child
            _, first = np.unique(node[free] * 65 + d[free], return_index=True)
            chosen = item[free][first]
            self.child[node[free][first], d[free][first]] = chosen
            down = self.child[node, d]
            rest = down != item
            item, node = item[rest], down[rest]

    def near(self, asks: np.ndarray, tree: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(number of the asking fingerprint, node) of all nodes within the radius."""
        per = max(1, STEP_PAIRS // 256)
        for start in range(0, len(asks), per):
            todo = [(np.arange(start, min(start + per, len(asks))), self.root[tree[start : start + per]])]
            while todo:
                q, node = todo.pop()
                if len(q) > STEP_PAIRS // (2 * radius + 1):
                    half = len(q) // 2
                    todo += [(q[:half], node[:half]), (q[half:], node[half:])]
                    continue
                d = distance(asks[q], self.fp[node])
                found = d <= radius
                if found.any():
                    yield q[found], node[found]
                edge = d[:, None] + np.arange(-radius, radius + 1)
                kids = np.where((edge >= 0) & (edge <= 64), self.child[node[:, None], np.clip(edge, 0, 64)], -1)
                row, column = np.nonzero(kids >= 0)
                if len(row):
                    todo.append((q[row], kids[row, column].astype(np.int64)))


class Union:
    """Components of numbered things, merged by pairs."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def merge(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            x, y = self.label[a], self.label[b]
            apart = x != y
            if not apart.any():
                return
            low, high = np.minimum(x, y)[apart], np.maximum(x, y)[apart]
            np.minimum.at(self.label, high, low)
            while True:
                up = self.label[self.label]
                if np.array_equal(up, self.label):
                    break
                self.label = up


def _search(probe: np.ndarray, shard: np.ndarray, member: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(asking row, tree member) of all probes within the radius."""
    own = np.flatnonzero(member)
    if not len(own):
        return
    tree_shards, tree = np.unique(shard[own], return_inverse=True)
    forest = Forest(probe[own], tree)
    place = np.minimum(np.searchsorted(tree_shards, shard), len(tree_shards) - 1)
    asks = np.flatnonzero(tree_shards[place] == shard)
    for q, node in forest.near(probe[asks], place[asks], radius):
        yield asks[q], own[node]


def _near(full: np.ndarray, a: np.ndarray, b: np.ndarray, wide: int) -> tuple[np.ndarray, np.ndarray]:
    if wide >= 0 and len(a):
        near = np.bitwise_count(full[a] ^ full[b]).sum(axis=1, dtype=np.int64) <= wide
        a, b = a[near], b[near]
    return a, b


def _links(probe: np.ndarray, full: np.ndarray, shard: np.ndarray, member: np.ndarray, radius: int, wide: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that join the same fingerprints as all links between asking rows and tree members."""
    union = Union(len(probe))
    for a, b in _search(probe, shard, member, radius):
        apart = union.label[a] != union.label[b]
        union.merge(*_near(full, a[apart], b[apart], wide))
    moved = np.flatnonzero(union.label != np.arange(len(probe)))
    return moved, union.label[moved]


def _forest(union: Union, a: np.ndarray, b: np.ndarray, d: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs that make a spanning forest of least distances over what the union holds apart (Boruvka's rounds)."""
    order = np.lexsort((b, a, d))
    a, b = a[order], b[order]
    while True:
        x, y = union.label[a], union.label[b]
        apart = x != y
        if not apart.any():
            return
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        # the first, and so nearest, pair of each component
        _, first = np.unique(np.stack([x, y], axis=1).ravel(), return_index=True)
        chosen = np.unique(first // 2)
        yield a[chosen], b[chosen]
        union.merge(a[chosen], b[chosen])


def _proposals(probe: np.ndarray, full: np.ndarray, shard: np.ndarray, member: np.ndarray, radius: int, wide: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """A spanning forest, by least distances, of the pairs within the radius and ``wide`` bits."""
    union = Union(len(probe))
    held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    count = 0
    for a, b in _search(probe, shard, member, radius):
        apart = union.label[a] != union.label[b]
        # members of one tree find each other twice
        a, b = a[apart & ((a < b) | ~member[a])], b[apart & ((a < b) | ~member[a])]
        d = np.bitwise_count(full[a] ^ full[b]).sum(axis=1, dtype=np.int64)
        near = d <= wide
        held.append((a[near], b[near], d[near]))
        count += int(near.sum())
        if count > HELD_PAIRS:
            yield from _forest(union, *map(np.concatenate, zip(*held, strict=True)))
            held, count = [], 0
    if count:
        yield from _forest(union, *map(np.concatenate, zip(*held, strict=True)))


def link_classes(classes: DataFrame, radius: int, blocks: int, agree: int, wide: int = -1, probes: int = 1, max_tree: int = MAX_TREE, propose: bool = False, scratch: Scratch | None = None) -> DataFrame:
    """Edges (src, dst) between class numbers ``id`` of rows (id, fp, more).

    Each of the first ``probes`` words of a fingerprint is searched in shards of its own. ``propose`` gives real pairs, the smaller number first, which may come repeatedly: of each tree's pairs those
    of a spanning forest by least distances.
    """
    full = F.concat(F.array("fp"), "more")
    keys = F.concat(*[shard_keys(F.get(full, F.lit(p)), blocks, agree, p) for p in range(probes)])
    carried = [full.alias("full")] if wide >= 0 else []
    extra = ["full"] if carried else []
    keyed = classes.select("id", *carried, F.explode(keys).alias("k")).select("id", *extra, "k.key", "k.probe")
    # shards that need more than one tree; written first, so that Spark knows their number before it plans the join
    large = (scratch or Scratch()).written(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > max_tree).select("key", F.ceil(F.col("n") / max_tree).cast("int").alias("trees")))
    split = keyed.join(large, "key", "left").withColumn("trees", F.coalesce("trees", F.lit(1)))
    own = F.pmod(F.xxhash64("id"), F.col("trees")).cast("int")
    asking = split.withColumn("own", own).withColumn("tree", F.explode(F.sequence(F.lit(0), F.col("trees") - 1)))
    rows = asking.select("key", "tree", (F.col("tree") == F.col("own")).alias("member"), "id", "probe", *extra)
    ordered = rows.repartition("key", "tree").sortWithinPartitions("key", "tree", F.desc("member"))
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: pa.Table | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch]) if rest is None else pa.concat_tables([rest, pa.Table.from_batches([batch])])
            key, tree = table["key"].to_numpy(), table["tree"].to_numpy()
            last = np.flatnonzero((key == key[-1]) & (tree == tree[-1]))[0]
            done, rest = table.slice(0, last), table.slice(last)
            yield from _solve(done, radius, wide, schema, propose)
            if rest.num_rows > 8 * max_tree:
                # a tree that many ask: answer those here, keep the tree's members, which come first
                members = int(np.count_nonzero(rest["member"].to_numpy()))
                if members < rest.num_rows:
                    yield from _solve(rest, radius, wide, schema, propose)
                    rest = rest.slice(0, members)
        if rest is not None:
            yield from _solve(rest, radius, wide, schema, propose)

    return ordered.mapInArrow(run, "src long, dst long")


def _solve(table: pa.Table, radius: int, wide: int, schema: pa.Schema, propose: bool) -> Iterator[pa.RecordBatch]:
    """Edges of the complete shards of a sorted table; fingerprints alone in their shard go at once."""
    if not table.num_rows:
        return
    key, tree = table["key"].to_numpy(), table["tree"].to_numpy()
    shard = np.cumsum((np.diff(key, prepend=key[0]) != 0) | (np.diff(tree, prepend=tree[0]) != 0))
    some = np.bincount(shard)[shard] > 1
    if not some.any():
        return
    if not some.all():
        table, shard = table.filter(pa.array(some)), shard[some]
    table = table.combine_chunks()
    probe = table["probe"].to_numpy().view(np.uint64)
    full = table["full"].chunk(0).flatten().to_numpy().view(np.uint64).reshape(len(probe), -1) if wide >= 0 else probe[:, None]
    member, ids = table["member"].to_numpy().astype(bool), table["id"].to_numpy()
    if propose:
        for a, b in _proposals(probe, full, shard, member, radius, wide):
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(ids[a], ids[b])), pa.array(np.maximum(ids[a], ids[b]))], schema=schema)
        return
    a, b = _links(probe, full, shard, member, radius, wide)
    if len(a):
        yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], schema=schema)


def run_sets(docs: DataFrame, text_col: str, words: int, keep: list[str]) -> DataFrame:
    """``keep`` with runs, the distinct hashes of the text's runs of words."""

    def make():
        def work(texts: pa.Array) -> list[pa.Array]:
            raw, offsets = text_bytes(texts)
            raw = raw.tobytes()
            sets = [np.unique(run_hashes(raw[a:b], words)).view(np.int64) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)]
            return [pa.array(sets, pa.list_(pa.int64()))]

        return work

    return map_texts(docs, text_col, [("runs", T.ArrayType(T.LongType()))], make, keep)


def dealt(pairs: DataFrame, side: str, scratch: Scratch, most: int) -> DataFrame:
    """(``side``, copies) of the classes that more than ``most`` pairs name on this side.

    Written first, so that Spark finds the few of them small and joins the pairs to them without a shuffle.
    """
    named = pairs.groupBy(side).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > most)
    return scratch.written(named.select(side, F.ceil(F.col("n") / most).cast("int").alias("copies")))


def confirmed(pairs: DataFrame, sets: DataFrame, least: float, scratch: Scratch | None = None, most: int = HUB_PAIRS) -> DataFrame:
    """The pairs (src, dst) of classes whose sets have a Jaccard similarity of at least ``least``.

    The hub of a forest may be in a third of all pairs: its pairs are dealt by their other end over
    copies of its set, one copy for about ``most`` pairs.
    """
    scratch = scratch or Scratch()
    salted, own = pairs, {}
    for side, other in (("src", "dst"), ("dst", "src")):
        hubs = dealt(pairs, side, scratch, most)
        salted = salted.join(hubs, side, "left").withColumn(f"{side}_copy", F.coalesce(F.pmod(F.xxhash64(other), F.col("copies")), F.lit(0)).cast("int")).drop("copies")
        copies = F.explode(F.sequence(F.lit(0), F.coalesce("copies", F.lit(1)) - 1)).alias(f"{side}_copy")
        own[side] = sets.select(F.col("__class").alias(side), F.col("runs").alias(f"{side}_runs")).join(hubs, side, "left").select(side, f"{side}_runs", copies)
    met = salted.join(own["src"], ["src", "src_copy"]).join(own["dst"], ["dst", "dst_copy"])
    a, b = F.col("src_runs"), F.col("dst_runs")
    # sets whose sizes alone rule the similarity out are not intersected
    sized = met.filter(F.least(F.size(a), F.size(b)) >= F.greatest(F.size(a), F.size(b)) * F.lit(least - 1e-9))
    both = sized.select("src", "dst", F.size(F.array_intersect(a, b)).alias("common"), (F.size(a) + F.size(b)).alias("total"))
    return both.filter(F.try_divide(F.col("common"), F.col("total") - F.col("common")) >= least).select("src", "dst")


def across_parts(members: DataFrame, least: float, wide: int, rows: int = CELL_ROWS, size: int = CELL_BYTES) -> DataFrame:
    """Edges (src, dst) between parts of one component: all pairs of different ``label`` within ``wide`` bits and of at least
    ``least`` similarity, less those that join parts which a cell has joined already.

    ``members`` has whole, label, id, full and runs. A component is cut into blocks of about ``rows``
    members and ``size`` bytes, each of one large part or of several small ones; each two of its blocks that
    can hold two parts meet in one bounded group, so that sets are sent once for each block and not once for
    each pair. A large part of n members beside s others so costs about n rows for each ``rows`` of s.
    """
    blocks_of = lambda: F.greatest(F.ceil(F.col("n") / rows), F.ceil(F.col("bytes") / size)).cast("int")
    parts = members.groupBy("whole", "label").agg(F.count(F.lit(1)).alias("n"), F.sum(F.size("runs") * 8).alias("bytes")).withColumn("blocks", blocks_of())
    # small parts share blocks
    pooled = parts.filter("blocks = 1").groupBy("whole").agg(F.sum("n").alias("n"), F.sum("bytes").alias("bytes")).select("whole", F.lit(None).cast("long").alias("part"), blocks_of().alias("blocks"))
    cut = pooled.unionByName(parts.filter("blocks > 1").select("whole", F.col("label").alias("part"), "blocks"))
    number = lambda part, k: F.xxhash64(F.coalesce(part, F.lit(0)), part.isNull(), k)
    listed = cut.withColumn("k", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("whole", "part", number(F.col("part"), F.col("k")).alias("own"))
    every = listed.groupBy("whole").agg(F.collect_list(F.struct("own", "part")).alias("every"))
    # blocks of one large part do not meet each other
    meets = F.filter("every", lambda x: F.col("part").isNull() | x["part"].isNull() | (x["part"] != F.col("part")))
    partners = listed.join(every, "whole").select("whole", "own", F.explode(F.transform(meets, lambda x: x["own"])).alias("other"))
    large = parts.filter("blocks > 1").select("whole", "label", F.col("label").alias("part"), "blocks")
    small_ = parts.filter("blocks = 1").select("whole", "label").join(pooled, "whole").select("whole", "label", "part", "blocks")
    placed = members.join(large.unionByName(small_), ["whole", "label"]).withColumn("own", number(F.col("part"), F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))).drop("part", "blocks")
    sent = placed.join(partners, ["whole", "own"])
    cells = sent.select("whole", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "id", "label", "full", "runs")
    schema = pa.schema([("src", pa.int64()), ("dst", pa.int64())])

    def meet(cell: pa.Table) -> pa.Table:
        cell = cell.sort_by([("own", "ascending"), ("id", "ascending")]).combine_chunks()
        ids, own_ = cell["id"].to_numpy(), cell["own"].to_numpy()
        bits = cell["full"].chunk(0).flatten().to_numpy().view(np.uint64).reshape(len(ids), -1)
        sets = cell["runs"].chunk(0)
        bounds = sets.offsets.to_numpy().astype(np.int64)
        flat = sets.values.to_numpy()
        length = np.diff(bounds)
        _, first, place = np.unique(cell["label"].to_numpy(), return_index=True, return_inverse=True)
        union = Union(len(ids))
        union.label = first[place]
        last = int(np.searchsorted(own_, own_[-1]))  # members of the second block, or all of one block
        src, dst = [], []
        for x in range(last if own_[0] != own_[-1] else len(ids)):
            others = np.arange(last if own_[0] != own_[-1] else x + 1, len(ids))
            near = others[union.label[others] != union.label[x]]
            shorter, longer = np.minimum(length[near], length[x]), np.maximum(length[near], length[x])
            near = near[(shorter >= longer * (least - 1e-9)) & (np.bitwise_count(bits[near] ^ bits[x]).sum(axis=1, dtype=np.int64) <= wide)]
            mine = flat[bounds[x] : bounds[x + 1]]
            for y in near.tolist():
                if union.label[x] == union.label[y]:
                    continue
                theirs = flat[bounds[y] : bounds[y + 1]]
                common = len(np.intersect1d(mine, theirs, assume_unique=True))
                if common and common / (len(mine) + len(theirs) - common) >= least:
                    src.append(min(ids[x], ids[y]))
                    dst.append(max(ids[x], ids[y]))
                    union.merge(np.array([x]), np.array([y]))
        return pa.table([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], schema=schema)

    return cells.groupBy("whole", "i", "j").applyInArrow(meet, "src long, dst long")


def confirmed_links(classes: DataFrame, texts: DataFrame, words: int, least: float, scratch: Scratch, **search) -> DataFrame:
    """Edges of the same components as all proposed pairs of classes that are confirmed by their texts; ``texts`` has __class and __read.

    First a nearest forest of the proposed pairs is confirmed, which joins a group of near copies by
    about as many pairs as members. Where that leaves a forest's component in parts, all its members
    of different parts meet in ``across_parts``.
    """
    pairs = scratch.written(link_classes(classes, propose=True, scratch=scratch, **search).distinct())
    asked = scratch.written(pairs.select(F.col("src").alias("__class")).unionByName(pairs.select(F.col("dst").alias("__class"))).distinct())
    one = texts.join(asked, "__class").groupBy("__class").agg(F.min_by("__read", F.xxhash64("__read")).alias("__read"))
    sets = scratch.written(run_sets(one, "__read", words, ["__class"]))
    first = scratch.written(confirmed(pairs, sets, least, scratch))
    whole = connected_components(pairs, scratch).withColumnRenamed("root", "whole")
    part = connected_components(first, scratch).withColumnRenamed("root", "part")
    parts = whole.join(part, "node", "left").select(F.col("node").alias("id"), "whole", F.coalesce("part", "node").alias("label"))
    # components of several parts that are more than one refused pair
    several = parts.groupBy("whole").agg((F.min("label") < F.max("label")).alias("several"), F.count(F.lit(1)).alias("n")).filter("several AND n > 2").select("whole")
    members = parts.join(several, "whole").join(classes.select("id", F.concat(F.array("fp"), "more").alias("full")), "id").join(sets.withColumnRenamed("__class", "id"), "id")
    return first.unionByName(scratch.written(across_parts(scratch.written(members), least, search["wide"])))


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    radius: int = 4,
    blocks: int = 6,
    agree: int = 2,
    confirm_bits: int = 0,
    wide: int = -1,
    distinct: bool = False,
    probes: int = 1,
    max_tree: int = MAX_TREE,
    keep: list[str] | None = None,
    exact: float = 0.0,
) -> DataFrame:
    """``docs`` with fp, group (a number of the component) and component_id (its smallest id).

    Columns of these names, and one named more, are dropped. ``exact`` needs the text among the kept columns.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("fp", "more", "group", "component_id")]
    cols = [F.col(f"`{c}`") for c in kept]
    # a text that is kept travels and is written once
    read = text_col if text_col in kept and exact > 0 else "__read"
    carried = docs.select(*cols, F.col(f"`{id_col}`").alias("__id"), *([F.col(f"`{text_col}`").alias("__read")] if read == "__read" else []))
    scratch, lasting = Scratch(), Scratch()
    marked = lasting.written(fingerprints(carried, read, words, confirm_bits, distinct, [*kept, "__id"]))
    number = F.xxhash64("fp", "more") if confirm_bits else F.col("fp")
    marked = marked.withColumn("__class", number)
    classes = scratch.written(marked.groupBy("__class", "fp", "more").agg(F.min("__id").alias("low"), F.count(F.lit(1)).alias("rows")))
    numbered, search = classes.withColumnRenamed("__class", "id"), {"radius": radius, "blocks": blocks, "agree": agree, "wide": wide, "probes": probes, "max_tree": max_tree}
    if exact > 0:
        if text_col not in kept:
            raise ValueError("exact similarity needs the text column among the kept ones")
        edges = confirmed_links(numbered, marked.select("__class", F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("__read")), words, exact, scratch, **search)
    else:
        edges = link_classes(numbered, **search, scratch=scratch)
    found = connected_components(edges, scratch)
    lowest = found.join(classes, F.col("node") == F.col("__class")).groupBy("root").agg(F.min("low").alias("root_low"))
    joined = found.join(lowest, "root").select(F.col("node").alias("__class"), "root", "root_low")
    named = classes.join(joined, "__class", "left").select("__class", "rows", F.coalesce("root", "__class").alias("group"), F.when(F.col("root").isNotNull(), F.col("root_low")).otherwise(F.col("low")).alias("component_id"))
    # classes of many copies are few: written first, Spark finds them small and joins them without dealing their rows by class
    named = lasting.written(named)
    scratch.drop()
    many, few = lasting.written(named.filter(F.col("rows") > MANY)), named.filter(F.col("rows") <= MANY)
    common = marked.join(many.drop("rows"), "__class")
    rest = marked.join(many.select("__class"), "__class", "left_anti").join(few.drop("rows"), "__class")
    return common.unionByName(rest).select(*cols, "fp", "group", "component_id")


def contract(linked: DataFrame) -> DataFrame:
    """The digest columns of a linked ``documents`` table."""
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
