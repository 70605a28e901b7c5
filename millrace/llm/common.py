"""Helpers shared by the training-data operators: scratch folders, batches, files, word hashing."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import scratch, ship
from millrace.sources.files import filesystem

__all__ = ["AtomicFile", "filesystem", "pinned", "scratch", "ship", "slices", "stash", "table", "texts"]

#: The characters that part words, as a Spark regular expression: space and U+0009 to U+000D.
WORD = r"[^\x20\x09-\x0D]+"


def stash(df: DataFrame, tag: str) -> DataFrame:
    """Write df to the shared folder and read it back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pinned(df: DataFrame) -> DataFrame:
    """Checkpoint df reliably: its partitions, and their rows' order, are the same each time it is read."""
    context, path = df.sparkSession.sparkContext, scratch(df.sparkSession, "pinned")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(path)
    return df.checkpoint()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


class AtomicFile:
    """A file that appears under its name only when it is closed without an error.

    A task attempt writes to a name of its own, so retries and speculative attempts don't collide.
    """

    def __init__(self, uri: str):
        self.fs, self.path = filesystem(uri)
        self.fs.create_dir(posixpath.dirname(self.path), recursive=True)
        self.partial = f"{self.path}.{uuid.uuid4().hex}.partial"

    def __enter__(self):
        self.out = self.fs.open_output_stream(self.partial)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.fs.move(self.partial, self.path)
        else:
            self.fs.delete_file(self.partial)


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds about `most` bytes of a text column, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        col = batch.column(batch.schema.get_field_index(column))
        sizes = np.nan_to_num(pa.compute.binary_length(col).to_numpy(zero_copy_only=False).astype(float))
        yield from portions(batch, sizes, most)


def portions(batch: pa.RecordBatch, sizes: np.ndarray, most: float) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each portion's rows are of about `most` in size together, or a single row."""
    group = (np.cumsum(sizes) // most).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """A text column as strings; null counts as empty."""
    return [s or "" for s in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def with_columns(batch: pa.RecordBatch, drop: tuple[str, ...] = (), **new: pa.Array) -> pa.RecordBatch:
    """The batch without some columns and with new ones at the end; a new one replaces its namesake."""
    names = [n for n in batch.schema.names if n not in drop and n not in new]
    arrays = [batch.column(batch.schema.get_field_index(n)) for n in names]
    return pa.RecordBatch.from_arrays([*arrays, *new.values()], names=[*names, *new])


def spread(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Positions start..start+len of every range, one range after the other."""
    ends = np.cumsum(lens)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lens), lens)


def list_array(values: np.ndarray, lens: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), pa.array(values))


def groups_of(batches: Iterator[pa.RecordBatch], keys: list[str], most: int = 20_000) -> Iterator[pa.Table]:
    """The groups of rows that agree in keys, of batches sorted by them. Groups must be of bounded size."""
    held: list[pa.RecordBatch] = []

    def cut(last: bool) -> Iterator[pa.Table]:
        rows = pa.Table.from_batches(held)
        new = np.zeros(rows.num_rows, bool)
        new[0] = True
        for k in keys:
            c = rows.column(k).to_numpy()
            new[1:] |= c[1:] != c[:-1]
        ends = [*np.flatnonzero(new).tolist(), rows.num_rows]
        if not last:
            ends.pop()
        held[:] = rows.slice(ends[-1]).to_batches()
        for a, b in zip(ends, ends[1:]):
            yield rows.slice(a, b - a)

    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            if sum(b.num_rows for b in held) > most or sum(b.nbytes for b in held) > 32_000_000:
                yield from cut(False)
    if held:
        yield from cut(True)


def local_roots(ids: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of some ids the smallest one reachable over links between positions i and j."""
    order = np.argsort(ids, kind="stable")
    at = np.argsort(order)
    i, j = at[i], at[j]
    root = np.arange(len(ids))
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return ids[order[root[at]]]
        root = new


# ---- hashing of words, for whole batches at once

_P = np.uint64(0x9E3779B97F4A7C55)  # odd, so that its powers have inverses modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (xor-shift and multiply rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


_INV = pow(int(_P), -1, 2**64)
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def hash_words(strings: list[str], fold: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of every string: (hash, document number, first byte, byte after the last), in order.

    Words are `[^\\x20\\x09-\\x0D]+` on the UTF-8 bytes, A-Z lower-cased if fold. A hash depends on
    the word's bytes alone. Prefix sums of a polynomial modulo 2**64 give all hashes in a few passes.
    """
    raw = [s.encode("utf-8", "surrogatepass") for s in strings]
    lens = np.fromiter((len(r) + 1 for r in raw), np.int64, len(raw))
    data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8) if raw else np.zeros(0, np.uint8)
    space = _SPACE[data]
    inside = np.diff(np.concatenate([[0], (~space).astype(np.int8)]))
    start, end = np.flatnonzero(inside == 1), np.flatnonzero(inside == -1)
    values = (_FOLD[data] if fold else data).astype(np.uint64) + np.uint64(1)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), start, end
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * _powers(n, int(_P)), dtype=np.uint64)])
    word = (sums[end] - sums[start]) * _powers(n, _INV)[start]
    word = mix(word ^ (end - start).astype(np.uint64) * np.uint64(0xA0761D6478BD642F))
    doc = np.searchsorted(np.cumsum(lens), start, side="right")
    return word, doc, start, end


def uid(*columns: str | Column) -> Column:
    """A pseudo-random, non-negative long of the columns' values; the same in every run."""
    return F.xxhash64(*columns).bitwiseAND(F.lit(2**63 - 1))
