"""Prefix trie of conversations from vertical bitmaps.

Each distinct sequence of the first d turns of a conversation, a turn being (role, text), is a node
of depth d; the conversations that start with it are its members.

Conversations are sorted by id over ranges, and each range is cut into shards of at most
``shard_convs`` conversations and about ``shard_turns`` turns (a longer conversation is a shard of
its own). A shard indexes (position, turn) to a bitset of its conversations, and the bitsets of
those that end at each position. A depth-first walk intersects a parent's bitset with the postings
of its members' next turns: each intersection is a child, its population count the members, and
what it shares with the ends of its depth the end list.

Every shard gives partial nodes, at most one for each of its turns. A node is known everywhere by
128 bits over its turns. Partial nodes meet by a grouped aggregation with partial sums: smallest
member, members, and whether any shard knows a child. These go back to the shards, where a node
counts in the shard of its smallest member alone, so that sums over the subtree, which is a run of
the walk's order, add up over shards. Last, the partial nodes of each node are sorted by their
smallest member, as shards are ranges of ids, and streamed, so that the ids that end there are digested in order and never collected.
A node in many shards, like the root, costs a row for each shard and not one for each member.

Turns are ordered by number, null first; ties by role, then by the SHA-256 of the text, then any
way. A null role or text is empty. Rows without a conversation id take no part. Texts are reduced
to two 64-bit hashes and their size before anything is shuffled; a task holds those of one shard,
so one conversation's turns (24 bytes each) are the least that it holds. No rows give no nodes.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ledgerflow.llm.common import Scratch

SHARD_CONVS, SHARD_TURNS = 1024, 1 << 18
#: Conversations that share their first turns, and the bound of how many turns they share.
GROUP, HEADS = 5, 9
_MASK, _M1, _M2 = (1 << 64) - 1, 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_PARTIAL = "shard long, pre int, up int, last int, p1 long, p2 long, depth int, conv_id long, n long, size long, childless boolean, ends array<long>"


def numbered(conversations: DataFrame) -> DataFrame:
    """(conv_id, place from 1, t1, t2, size) of all turns: two hashes of role and text, and the text's UTF-8 bytes."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), F.sha2(text, 256).alias("tie"), F.xxhash64(role, text).alias("t1"), F.xxhash64(F.lit(1), role, text).alias("t2"), F.octet_length(text).cast("long").alias("size")
    )
    order = W.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "tie")
    return turns.select("conv_id", F.row_number().over(order).alias("place"), "t1", "t2", "size")


def heads(conv_id: Column, most: int = HEADS) -> Column:
    """The number of first turns that a conversation has from its group's first."""
    return (F.crc32(conv_id.cast("string")) % most).cast("int")


def rebuilt(turns: DataFrame, group: int = GROUP, most: int = HEADS) -> DataFrame:
    """(conv_id, part, place, t1, t2, size): the first h turns of the conversation that opens the group, then one's own after its first h.

    Every conversation has a row of part -1 as well, also one without turns.
    """
    ids = turns.filter("place = 1").select("conv_id")
    own = turns.filter(F.col("place") > heads(F.col("conv_id"), most)).withColumn("part", F.lit(1))
    first = turns.filter((F.col("conv_id") % group == 0) & (F.col("place") < most))
    # only ids within the group's reach can take turns from it; the bounds keep the sequence in 64 bits
    low, high = F.greatest("conv_id", F.lit(-(1 << 63) + group)) - (group - 1), F.least("conv_id", F.lit((1 << 63) - 1 - group)) + (group - 1)
    lent = first.withColumn("to", F.explode(F.sequence(low, high))).filter((F.col("to") - F.col("to") % group == F.col("conv_id")) & (F.col("place") <= heads(F.col("to"), most)))
    taken = lent.drop("conv_id").withColumnRenamed("to", "conv_id").join(ids, "conv_id", "left_semi").withColumn("part", F.lit(0))
    nothing = F.lit(0).cast("long")
    present = ids.select("conv_id", F.lit(-1).alias("part"), F.lit(0).alias("place"), nothing.alias("t1"), nothing.alias("t2"), nothing.alias("size"))
    names = present.columns
    return present.unionByName(own.select(*names)).unionByName(taken.select(*names))


def whole(turns: DataFrame) -> DataFrame:
    """All conversations as they are, in the form of ``rebuilt``."""
    return rebuilt(turns, 1, 1)


def walk(conv: np.ndarray, part: np.ndarray, t1: np.ndarray, t2: np.ndarray, size: np.ndarray) -> dict[str, list]:
    """Nodes of the trie of one shard in depth-first order; rows are sorted by conversation and place."""
    ids: list[int] = []
    turn_of: list[list[int]] = []
    number: dict[tuple[int, int, int], int] = {}
    posting: list[int] = []
    facts: list[tuple[int, int, int]] = []
    for c, p, a, b, s in zip(conv.tolist(), part.tolist(), t1.tolist(), t2.tolist(), size.tolist(), strict=True):
        if p < 0:
            ids.append(c)
            turn_of.append([])
            continue
        own = turn_of[-1]
        k = number.setdefault((len(own), a, b), len(posting))
        if k == len(posting):
            posting.append(0)
            facts.append((a & _MASK, b & _MASK, s))
        posting[k] |= 1 << (len(ids) - 1)
        own.append(k)
    ending: dict[int, int] = {}
    for i, own in enumerate(turn_of):
        ending[len(own)] = ending.get(len(own), 0) | 1 << i
    out: dict[str, list] = {n: [] for n in ("pre", "up", "last", "p1", "p2", "depth", "conv_id", "n", "size", "childless", "ends")}
    stack = [((1 << len(ids)) - 1, 0, 0, 0, 0, -1)]
    while stack:
        members, depth, p1, p2, bytes_, up = stack.pop()
        pre = len(out["pre"])
        done = members & ending.get(depth, 0)
        rest = members & ~done
        out["childless"].append(not rest)
        ends = []
        while done:
            low = done & -done
            ends.append(ids[low.bit_length() - 1])
            done ^= low
        for name, value in (("pre", pre), ("up", up), ("p1", p1), ("p2", p2), ("depth", depth), ("conv_id", ids[(members & -members).bit_length() - 1]), ("n", members.bit_count()), ("size", bytes_), ("ends", ends)):
            out[name].append(value)
        while rest:
            k = turn_of[(rest & -rest).bit_length() - 1][depth]
            child = members & posting[k]
            a, b, s = facts[k]
            stack.append((child, depth + 1, (p1 * _M1 + a + 1) & _MASK, (p2 * _M2 + b + 1) & _MASK, s, pre))
            rest &= ~child
    last = list(out["pre"])
    for v in range(len(last) - 1, 0, -1):
        u = out["up"][v]
        last[u] = max(last[u], last[v])
    out["last"] = last
    return out


def _signed(values: list[int]) -> np.ndarray:
    return np.array(values, np.uint64).view(np.int64)


def _cuts(conv: np.ndarray, ended: bool, convs: int, turns: int) -> Iterator[tuple[int, int]]:
    """(start, end) of the shards that are complete; without ``ended`` the last conversation may go on."""
    firsts = np.flatnonzero(np.diff(conv, prepend=conv[0] - 1 if len(conv) else 0)) if len(conv) else np.empty(0, np.int64)
    bounds = np.append(firsts, len(conv)) if ended else firsts
    i = 0
    while i < len(bounds) - 1:
        by_turns = int(np.searchsorted(bounds, bounds[i] + turns, side="right")) - 1
        j = min(i + convs, max(by_turns, i + 1))
        if j > len(bounds) - 1:
            if not ended:
                return
            j = len(bounds) - 1
        elif j == len(bounds) - 1 and not ended and j < i + convs and bounds[j] - bounds[i] < turns:
            return
        yield int(bounds[i]), int(bounds[j])
        i = j


def partial_nodes(rows: DataFrame, shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of each shard of rows in the form of ``rebuilt``."""
    ordered = rows.repartitionByRange("conv_id").sortWithinPartitions("conv_id", "part", "place").select("conv_id", "part", "t1", "t2", "size")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId() << 32

        def nodes(held: list[np.ndarray]) -> pa.RecordBatch:
            nonlocal shard
            found = walk(*held)
            arrays = {n: pa.array(found[n], kind) for n, kind in (("pre", pa.int32()), ("up", pa.int32()), ("last", pa.int32()), ("depth", pa.int32()), ("conv_id", pa.int64()), ("n", pa.int64()), ("size", pa.int64()), ("childless", pa.bool_()), ("ends", pa.list_(pa.int64())))}
            arrays |= {n: pa.array(_signed(found[n])) for n in ("p1", "p2")} | {"shard": pa.array(np.full(len(found["pre"]), shard, np.int64))}
            shard += 1
            names = ["shard", "pre", "up", "last", "p1", "p2", "depth", "conv_id", "n", "size", "childless", "ends"]
            return pa.RecordBatch.from_arrays([arrays[n] for n in names], names=names)

        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            held = new if held is None else [np.concatenate(x) for x in zip(held, new, strict=True)]
            end = 0
            for start, end in _cuts(held[0], False, shard_convs, shard_turns):
                yield nodes([x[start:end] for x in held])
            held = [x[end:] for x in held]
        if held is not None:
            for start, end in _cuts(held[0], True, shard_convs, shard_turns):
                yield nodes([x[start:end] for x in held])

    return ordered.mapInArrow(run, _PARTIAL)


def _groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Stretches of whole groups of a sorted stream."""
    rest: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        values = table[key].to_numpy()
        last = int(np.searchsorted(values, values[-1]))
        if last:
            yield table.slice(0, last)
        rest = table.slice(last)
    if rest is not None:
        yield rest


_SUMS = "p1 long, p2 long, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, low long, ends array<long>"


def subtree_sums(nodes: DataFrame, merged: DataFrame) -> DataFrame:
    """Each shard's part of children, leaves and saved bytes of its nodes."""
    known = nodes.join(merged, ["p1", "p2"])
    wanted = ["shard", "pre", "up", "last", "p1", "p2", "depth", "conv_id", "size", "ends", "low_conv", "n_convs", "leaf"]
    ordered = known.select(*wanted).repartition("shard").sortWithinPartitions("shard", "pre")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _groups(batches, "shard"):
            column = {n: table[n].to_numpy() for n in wanted if n != "ends"}
            # places of all shards of the table, one after another
            base = np.flatnonzero(np.diff(column["shard"], prepend=column["shard"][0] - 1))
            base = np.repeat(base, np.diff(np.append(base, len(table))))
            pre, last = column["pre"] + base, column["last"] + base
            top = column["up"] < 0
            up = np.where(top, 0, column["up"] + base)
            mine = column["conv_id"] == column["low_conv"]

            def below(values: np.ndarray) -> np.ndarray:
                sums = np.concatenate([[0], np.cumsum(values)])
                return sums[last + 1] - sums[pre]

            children = np.bincount(up[mine & ~top], minlength=len(table)).astype(np.int64)
            leaves = below(np.where(mine & column["leaf"].astype(bool), 1, 0))
            saved = below(np.where(mine, (column["n_convs"] - 1) * column["size"], 0))
            parent = pa.array(column["low_conv"][up], mask=top)
            arrays = [column["p1"], column["p2"], column["low_conv"], column["depth"].astype(np.int64), parent, column["n_convs"], children, leaves, saved, column["conv_id"]]
            found = pa.Table.from_arrays([*(x if isinstance(x, pa.Array) else pa.array(x) for x in arrays), table["ends"]], names=["p1", "p2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "low", "ends"])
            yield from found.to_batches(max_chunksize=8192)

    return ordered.mapInArrow(run, _SUMS)


_NODES = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"


def finished(sums: DataFrame) -> DataFrame:
    """One row for each node: sums over its shards, and the digest of the ids that end there, in order."""
    ordered = sums.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "low")
    names = [x.split()[0] for x in _NODES.split(", ")]
    kinds = [pa.int64()] * (len(names) - 1) + [pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, node, added, digest, comma, rows = None, (), [0, 0, 0], hashlib.sha256(), "", []
        for batch in batches:
            fields = [batch.column(n).to_pylist() for n in ("p1", "p2", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends")]
            for p1, p2, conv, depth, parent, n, children, leaves, saved, ends in zip(*fields, strict=True):
                if (p1, p2) != key:
                    if key is not None:
                        rows.append((*node, *added, digest.hexdigest()))
                    key, node, added, digest, comma = (p1, p2), (conv, depth, parent, n), [0, 0, 0], hashlib.sha256(), ""
                added = [added[0] + children, added[1] + leaves, added[2] + saved]
                if ends:
                    digest.update((comma + ",".join(map(str, ends))).encode())
                    comma = ","
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
                rows = []
        if key is not None:
            rows.append((*node, *added, digest.hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return ordered.mapInArrow(run, _NODES)


def prefix_trie(rows: DataFrame, scratch: Scratch | None = None, shard_convs: int = SHARD_CONVS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """One row for each node of the trie of rows in the form of ``rebuilt``.

    conv_id is the smallest member, parent_conv_id the parent's; saved_tokens sums, over the subtree, what
    storing each node's last text once saves, in bytes.
    """
    nodes = (scratch or Scratch()).written(partial_nodes(rows, shard_convs, shard_turns))
    merged = nodes.groupBy("p1", "p2").agg(F.min("conv_id").alias("low_conv"), F.sum("n").alias("n_convs"), F.min("childless").alias("leaf"))
    return finished(subtree_sums(nodes, merged))


def contract(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return prefix_trie(rebuilt(Scratch().written(numbered(conversations))))

