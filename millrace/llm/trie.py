"""The prefix trie of conversations, from a Cartesian tree over the sorted conversations' common prefixes.

A turn is a cell of fixed width (digest of role and text, bytes of the text), a conversation the string of its cells,
so sorting those strings puts the members of every prefix side by side. The Cartesian tree over the lengths of the
neighbours' common prefixes has an interval of conversations for every branching prefix; an interval ends where the
nearest smaller length lies to either side. Every block (a task's range of the order) finds them with a stack of its
own; a prefix that reaches over a block's edge belongs to the nearest earlier block whose minimum is smaller, so all
blocks name it alike without meeting. Intervals of equal length are one on the stack, the depths between an interval
and the one around it are expanded, and what is told of a node comes from running sums at its interval's ends.

Defined results: a null role or text is empty; rows without conv_id are left out; turns of equal number are ordered by
their digests; repeated rows are turns of their own; texts of any length are taken whole, but go no further than their
digests; extra columns are left out; no conversations, no nodes. A conversation is a row of CELL bytes a turn. Nodes
come in no order. The numbers of the conversations that end at a node go through one hash, so those of a node are
streamed in portions through one task, which holds one portion at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import pinned, stash

#: Bytes of a turn: 16 of its digest, 4 of its text's size.
CELL = 20
#: Conversation numbers in one portion of a list, and rows in a batch of results.
PORTION, BATCH = 4096, 20_000
OPEN = -1  # the place of a node that began in an earlier block

SORTED = "block int, conv_id long, depth int, shared int, sizes array<int>, edge binary, last boolean"
FOUND = "part boolean, bottom boolean, block int, place long, depth int, conv_id long, n_convs long, n_children long, n_leaves long, saved long, up_block int, up_place long, parent long, ends string, at int, portion long"


def sequences(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text -> a row for each conversation: conv_id, cells (hexadecimal, in order)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    cell = F.concat(digest, F.lpad(F.hex(F.octet_length(text)), 8, "0"))
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.struct("turn", cell.alias("cell")).alias("said"))
    return rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("said"))["cell"].alias("cells"))


def grafted(seqs: DataFrame, every: int = 5, most: int = 9) -> DataFrame:
    """Each conversation c with its first h turns replaced by those of c - c % every, h = crc32 of c's decimal % most."""
    seqs = stash(seqs, "sequences")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    own = seqs.select("conv_id", "cells", h.cast("int").alias("h"), (F.col("conv_id") - F.col("conv_id") % every).alias("base"))
    heads = seqs.select(F.col("conv_id").alias("base"), F.slice("cells", 1, most - 1).alias("head"))
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), F.col("h"))
    tail = F.slice("cells", F.col("h") + 1, F.greatest(F.size("cells") - F.col("h"), F.lit(0)))
    return own.join(heads, "base", "left").select("conv_id", F.concat(head, tail).alias("cells"))


def shared(a: bytes, b: bytes) -> int:
    """The number of cells that two keys begin with alike."""
    low, high = 0, min(len(a), len(b)) // CELL
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if a[: middle * CELL] == b[: middle * CELL] else (low, middle - 1)
    return low


def _sorted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block of the order: what each conversation shares with the one before it, and the sizes of its other texts."""
    block, before = TaskContext.get().partitionId(), None
    schema = pa.schema([("block", pa.int32()), ("conv_id", pa.int64()), ("depth", pa.int32()), ("shared", pa.int32()), ("sizes", pa.list_(pa.int32())), ("edge", pa.binary()), ("last", pa.bool_())])
    for batch in batches:
        rows = []
        for conv_id, key in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            same = None if before is None else shared(before, key)
            sizes = np.frombuffer(key[(same or 0) * CELL :], ">i4").reshape(-1, CELL // 4)[:, -1]
            rows.append((block, conv_id, len(key) // CELL, same, sizes.astype(np.int32), key if same is None else None, False))
            before = key
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
    if before is not None:
        yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip((block, None, None, None, None, before, True), schema)], schema=schema)


def _edges(rows: DataFrame) -> list[tuple[int, int, int]]:
    """(block, cells shared across its left edge, its minimum), a row for each task that sorted."""
    edge = lambda last: F.max(F.when(F.col("last") == last, F.col("edge")))
    blocks = rows.groupBy("block").agg(F.min("shared").alias("least"), edge(False).alias("first"), edge(True).alias("final"))
    pairs = blocks.select("block", "least", "first", F.lag("final").over(Window.orderBy("block")).alias("before"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            across = [-1 if b is None else shared(a, b) for a, b in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            least = [x if m is None else min(x, m) for x, m in zip(across, batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(across, pa.int32()), pa.array(least, pa.int32())], names=["block", "across", "least"])

    return sorted(tuple(r) for r in pairs.mapInArrow(run, "block int, across int, least int").collect())


class Interval:
    """A prefix of depth d on the stack: where it began, and the running sums there."""

    __slots__ = ("base", "children", "d", "ends", "leaves", "least", "new", "place", "spent")

    def __init__(self, d: int, place: int, spent: int = 0, new: int = 0, base: int = 0, leaves: int = 0, least: int | None = None, children: int = 0):
        self.d, self.place, self.spent, self.new, self.base, self.leaves, self.least, self.children = d, place, spent, new, base, leaves, least, children
        self.ends: list[int] = []

    def take(self, conv_id: int | None) -> None:
        if conv_id is not None and (self.least is None or conv_id < self.least):
            self.least = conv_id


class Block:
    """Nearest smaller values inside a block by a stack, and the nodes of the intervals that they bound."""

    def __init__(self, block: int, across: int, earlier: np.ndarray, earlier_least: np.ndarray):
        self.block, self.earlier, self.earlier_least = block, earlier, earlier_least
        self.path = [0]  # bytes of the first 0, 1, 2, ... turns of the conversation at hand
        self.place = self.spent = self.new = self.leaves = 0  # running: rows, bytes of all turns, of new turns, leaves
        self.depth = -1
        self.stack = [Interval(across, OPEN)]
        self.owners: dict[int, int] = {}
        self.out: list[tuple] = []

    def owner(self, depth: int) -> int:
        """The block where the node of this depth that reaches over the left edge begins."""
        if depth not in self.owners:
            self.owners[depth] = int(self.earlier[np.flatnonzero(self.earlier_least < depth)[-1]])
        return self.owners[depth]

    def add(self, conv_id: int, depth: int, same: int, sizes: list[int]) -> None:
        self.close(same)
        del self.path[max(same, 0) + 1 :]
        base = self.path[-1]
        for size in sizes:
            self.path.append(self.path[-1] + size)
        top, total = self.stack[-1], self.path[-1]
        if depth > same:
            top.children += 1
            top = Interval(depth, self.place, self.spent, self.new, base, self.leaves)
            self.stack.append(top)
        top.take(conv_id)
        top.ends.append(conv_id)
        self.place, self.spent, self.new, self.depth = self.place + 1, self.spent + total, self.new + total - base, depth

    def close(self, same: int) -> None:
        """End every interval deeper than what the next conversation shares."""
        self.leaves += same < self.depth
        while self.stack[-1].d > same:
            e = self.stack.pop()
            if self.stack and self.stack[-1].d >= same:
                up = self.stack[-1]
            else:  # the interval goes on at the smaller depth
                up = Interval(same, e.place, e.spent, e.new, e.base, e.leaves, None, int(e.place != OPEN))
                self.stack.append(up)
            up.take(e.least)
            self.tell(e, up, e.place == OPEN)

    def finish(self, same: int) -> None:
        """The end of the block; the next one's first conversation shares `same` turns with its last."""
        self.close(same)
        below = Interval(-1, OPEN)
        for e, up in zip(self.stack[::-1], [*self.stack[-2::-1], below]):
            up.take(e.least)
            self.tell(e, up, True)

    def tell(self, e: Interval, up: Interval, part: bool) -> None:
        """The nodes of an interval, one for each depth down to the interval around it; parts of those that cross an edge."""
        own, n = e.place != OPEN, self.place - max(e.place, 0)
        for d in range(e.d, up.d, -1):
            bottom, before = d == e.d, self.path[d - 1] if d else 0
            saved = self.spent - e.spent - n * before - (self.new - e.new + (e.base - before if own else 0))
            at = self.block if own else self.owner(d)
            up_block = up_place = parent = None
            if d and own and d - 1 > up.d:
                up_block, up_place, parent = (self.block, e.place, None) if part else (None, None, e.least)
            elif d and own:
                up_block, up_place = (self.block if up.place != OPEN else self.owner(up.d)), up.place
            ends = None if part else hashlib.sha256(",".join(map(str, e.ends if bottom else [])).encode()).hexdigest()
            children = e.children if bottom else int(own)
            self.out.append((part, bottom, at, e.place, d, e.least, n, children, self.leaves - e.leaves, saved, up_block, up_place, parent, ends, None, None))
            if part and bottom:
                for k in range(0, len(e.ends), PORTION):
                    self.out.append((True, None, at, None, d, None, 0, 0, 0, 0, None, None, None, ",".join(map(str, e.ends[k : k + PORTION])), self.block, k))


def _found(blocks: list[tuple[int, int, int]]):
    number, across, least = (np.array([b[k] for b in blocks], np.int64) for k in range(3))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.bool_(), pa.bool_(), pa.int32(), pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.int32(), pa.int64()]
        names = [c.split()[0] for c in FOUND.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        walk = None
        for batch in batches:
            block, conv_ids, depths, same, sizes, _, last = (c.to_pylist() for c in batch.columns)
            for k in range(batch.num_rows):
                if walk is None:
                    at = int(np.searchsorted(number, block[k]))
                    first = int(across[at])
                    walk = Block(block[k], first, number[:at], least[:at])
                    walk.path += np.cumsum(sizes[k][: max(first, 0)], dtype=np.int64).tolist()
                    walk.add(conv_ids[k], depths[k], first, sizes[k][max(first, 0) :])
                elif last[k]:
                    walk.finish(int(across[at + 1]) if at + 1 < len(number) else -1)
                else:
                    walk.add(conv_ids[k], depths[k], same[k], sizes[k])
                if len(walk.out) >= BATCH:
                    yield batch_of(walk.out)
                    walk.out = []
        if walk is not None and walk.out:
            yield batch_of(walk.out)

    return run


def _ends(portions: DataFrame) -> DataFrame:
    """The hash of the numbers that end at each node, taken portion by portion."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = digest = None
        done: list[tuple] = []
        for batch in batches:
            for block, depth, ids in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if key == (block, depth):
                    digest.update(b"," + ids.encode())
                    continue
                done += [] if key is None else [(*key, digest.hexdigest())]
                key, digest = (block, depth), hashlib.sha256(ids.encode())
        done += [] if key is None else [(*key, digest.hexdigest())]
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), (pa.int32(), pa.int32(), pa.string()))], names=["block", "depth", "hash"])

    keyed = portions.repartition("block", "depth").sortWithinPartitions("block", "depth", "at", "portion")
    return keyed.select("block", "depth", "ends").mapInArrow(run, "block int, depth int, hash string")


def nodes(seqs: DataFrame) -> DataFrame:
    """conv_id, cells -> a row for each node: the smallest member's conv_id and the depth name it.

    The text of a node is its smallest member's turns up to the depth. saved_tokens counts the bytes of the subtree's
    turns beyond their first member; n_leaves the childless nodes of the subtree; ends_sha256 is the hash of the members
    that end at the node, in ascending order, comma-joined. `_edges` collects a row for each sorting task, no more.
    """
    keys = seqs.select("conv_id", F.unhex(F.array_join("cells", "")).alias("key"))
    keys = keys.repartitionByRange(int(seqs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "key", "conv_id").sortWithinPartitions("key", "conv_id")
    rows = pinned(keys.mapInArrow(_sorted, SORTED))
    found = stash(rows.mapInArrow(_found(_edges(rows)), FOUND), "found")

    whole, parts = found.filter("NOT part"), found.filter("part AND portion IS NULL")
    total = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved")]
    crossing = parts.groupBy("block", "depth").agg(F.min("conv_id").alias("conv_id"), *total, *(F.max(c).alias(c) for c in ("place", "up_block", "up_place")))
    crossing = crossing.join(_ends(found.filter("portion IS NOT NULL")), ["block", "depth"], "left")
    crossing = stash(crossing.select("*", F.coalesce("hash", F.sha2(F.lit(""), 256)).alias("ends"), F.lit(None).cast("long").alias("parent")).drop("hash"), "crossing")

    columns = ["conv_id", "depth", "up_block", "up_place", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends"]
    every = whole.select(*columns).unionByName(crossing.select(*columns))
    # a crossing node is met as its owner's place, or from later blocks as the one that is open
    name = lambda place: [F.col("block").alias("up_block"), place.alias("up_place"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above")]
    lookup = whole.filter("bottom").select(*name(F.col("place"))).unionByName(crossing.select(*name(F.col("place")))).unionByName(crossing.select(*name(F.lit(OPEN).cast("long"))))
    known, asked = every.filter("up_block IS NULL").withColumn("above", F.col("parent")), every.filter("up_block IS NOT NULL")
    told = asked.join(lookup, ["up_block", "up_place", "depth"]).select(*known.columns).unionByName(known)
    return told.select(
        "conv_id", F.col("depth").cast("long").alias("depth"), F.col("above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"),
    )
