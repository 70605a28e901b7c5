"""Near-duplicate embeddings by Euclidean p-stable hashing.

Vectors are scaled to length 1; equal ones are taken together. In each of several tables a vector falls
into the bucket that its quantised projections on random normal directions name. Two unit vectors at
cosine `least` are `sqrt(2 - 2 least)` apart, which gives the chance that one projection, and so a
table, brings them together; the number of tables makes the chance that all miss at most `miss`. The
number of projections grows with the logarithm of the number of vectors, so that unrelated vectors
share a bucket with a bounded number of others. Vectors of a bucket meet as blocks of an exact matrix
product in double precision; large buckets are cut into pieces whose pairs are separate groups. A pair
is counted in the first table that brings it together, so nothing has to be deduplicated; a bucket whose
vectors all met in the first table's bucket is left out before any vector is sent, and a group whose
vectors met in one of the next few before it is multiplied out.

Defined results: vectors that are null, empty or zero or hold null or non-finite components link with
nothing, nor does a row without an id; vectors of different length link with nothing; repeated rows with
one id count as one vector, the smallest (by components, in order); a component is named by its smallest
id, so ties don't arise; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import groups_of, local_roots, mix, spread, stash
from millrace.llm.components import components

WIDTH = 1.5
#: Vectors of a bucket that meet in one group: two pieces at most.
PIECE = 512
#: Earlier tables that may settle a whole group before it is multiplied out.
EARLY = 4


def collision(distance: float, width: float = WIDTH) -> float:
    """The chance that a projection puts two vectors at this distance into one cell."""
    t = width / distance
    return math.erf(t / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * t) * (1 - math.exp(-t * t / 2))


def plan(n: int, least: float, miss: float, crowd: int = 200) -> tuple[int, int]:
    """Projections a table and tables, for n vectors."""
    far, near = collision(math.sqrt(2)), collision(math.sqrt(2 - 2 * least))
    k = max(2, math.ceil(math.log(max(n, 2) / crowd) / -math.log(far)))
    return k, math.ceil(math.log(miss) / math.log(1 - near**k))


class Hasher:
    """Bucket names of unit vectors; the same directions for the same length of vectors."""

    def __init__(self, k: int, tables: int, seed: int):
        self.k, self.tables, self.seed = k, tables, seed
        self.known: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __call__(self, unit: np.ndarray, tables: int | None = None) -> np.ndarray:
        """(vectors, tables) of 64-bit names, for all tables or the first few."""
        tables, dim = self.tables if tables is None else tables, unit.shape[1]
        if dim not in self.known:
            rng = np.random.default_rng([self.seed, dim])
            self.known[dim] = rng.standard_normal((dim, self.k * self.tables)), rng.random(self.k * self.tables) * WIDTH
        direction, shift = (x[..., : self.k * tables] for x in self.known[dim])
        cells = np.floor((unit @ direction + shift) / WIDTH).astype(np.int64).view(np.uint64).reshape(len(unit), tables, self.k)
        name = mix(np.full(cells.shape[:2], dim, np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(tables, dtype=np.uint64))
        for c in range(self.k):
            name = mix(name ^ cells[:, :, c])
        return name


def _unit(lists: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """By length: row numbers and unit vectors, in double precision, of the rows that have a direction."""
    out = {}
    lens = pa.compute.list_value_length(lists).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    flat, start = lists.flatten().to_numpy(zero_copy_only=False).astype(float), np.cumsum(lens) - lens
    for dim in np.unique(lens[lens > 0]):
        rows = np.flatnonzero(lens == dim)
        x = flat[spread(start[rows], lens[rows])].reshape(-1, dim)
        with np.errstate(over="ignore", invalid="ignore", divide="ignore"):
            x = x / np.abs(x).max(axis=1, keepdims=True)
            x = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
        good = np.isfinite(x).all(axis=1)
        out[int(dim)] = rows[good], x[good]
    return out


def links(df: DataFrame, key: str, column: str, least: float = 0.95, miss: float = 1e-5, seed: int = 7) -> DataFrame:
    """key -> vec_id, n_links, component_id, kept for every vector."""
    # single precision is sent as such; whatever is computed is computed in double precision
    kind = "array<float>" if df.schema[column].dataType.simpleString() == "array<float>" else "array<double>"
    vectors = df.select(F.col(key).cast("long").alias("id"), F.col(column).cast(kind).alias("v")).groupBy("id").agg(F.min("v").alias("v"))
    # equal vectors: one stands for all, with their number
    usable = F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    alone = vectors.filter(~F.coalesce(usable, F.lit(False))).select("id")
    vectors = vectors.filter(usable)
    classes = stash(vectors.groupBy("v").agg(F.min("id").alias("rep"), F.count("*").alias("copies")), "vectors")
    n = classes.count()
    k, tables = plan(n, least, miss)
    hasher = Hasher(k, tables, seed)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 2000):
                batch = whole.slice(a, 2000)
                reps = batch.column(1).to_numpy()
                for rows, unit in _unit(batch.column(0)).values():
                    if len(rows):
                        names = hasher(unit).view(np.int64)
                        columns = (names.T.ravel(), np.tile(reps[rows], tables), np.repeat(np.arange(tables, dtype=np.int32), len(rows)), np.tile(names[:, 0], tables))
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "rep", "t", "before"])

    named = stash(classes.mapInArrow(name, "bucket long, rep long, t int, before long"), "buckets")
    sizes = named.groupBy("bucket").agg(F.count("*").alias("n"), F.min("t").alias("in"), F.min("before").alias("low"), F.max("before").alias("high"))
    sizes = sizes.filter("n > 1 AND (`in` = 0 OR low < high)").select("bucket", F.ceil(F.col("n") / PIECE).cast("int").alias("pieces"))
    # a vector's piece meets every piece of its bucket, itself included
    piece = F.pmod(F.xxhash64("rep"), F.col("pieces")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda p: F.struct(F.least(p, F.col("piece")).alias("low"), F.greatest(p, F.col("piece")).alias("high")))
    met = named.drop("before").join(stash(sizes, "sizes"), "bucket").withColumn("piece", piece).select("bucket", "t", "rep", "piece", F.explode(others).alias("m")).select("bucket", "t", "rep", "piece", "m.low", "m.high")
    groups = met.join(classes, "rep").select("bucket", "low", "high", "t", "piece", "rep", "copies", "v")
    groups = groups.repartition("bucket", "low", "high").sortWithinPartitions("bucket", "low", "high")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups_of(batches, ["bucket", "low", "high"]):
            if rows.num_rows < 2:
                continue
            columns = {c: rows.column(c).to_numpy() for c in ("t", "low", "high", "piece", "rep", "copies")}
            place, unit = next(iter(_unit(rows.column("v").combine_chunks()).values()))
            t = int(columns["t"][0])
            early = hasher(unit, min(t, EARLY))
            if (early == early[:1]).all(axis=0).any():
                continue  # an earlier table brought all of them together
            reps, copies, side = columns["rep"][place], columns["copies"][place], columns["piece"][place]
            near = unit @ unit.T >= least
            if columns["low"][0] != columns["high"][0]:
                near &= side[:, None] != side[None, :]
            i, j = np.nonzero(np.triu(near, 1))
            if not i.size:
                continue
            who, at = np.unique(np.concatenate([i, j]), return_inverse=True)
            names = hasher(unit[who], t)
            x, y = at[: len(i)], at[len(i) :]
            for c in range(t):  # table by table, as most pairs go with the first ones
                new = names[x, c] != names[y, c]
                i, j, x, y = i[new], j[new], x[new], y[new]
            count = np.bincount(i, copies[j], len(unit)) + np.bincount(j, copies[i], len(unit))
            hit = np.flatnonzero(count > 0)
            yield pa.RecordBatch.from_arrays([pa.array(reps[hit]), pa.array(count[hit].astype(np.int64)), pa.array(local_roots(reps, i, j)[hit])], names=["rep", "n", "root"])

    found = stash(groups.mapInArrow(compare, "rep long, n long, root long"), "links")
    counts = found.groupBy(F.col("rep").alias("r")).agg(F.sum("n").alias("n"))
    roots = components(found.filter("rep <> root").select(F.col("rep").alias("a"), F.col("root").alias("b")))
    judged = classes.join(counts, F.col("rep") == F.col("r"), "left").join(roots, F.col("rep") == F.col("id"), "left")
    judged = judged.select(F.col("v").alias("w"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "rep").alias("component_id"))
    linked = vectors.join(judged, F.col("v") == F.col("w")).select("id", "n_links", "component_id")
    every = linked.unionByName(alone.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id")))
    return every.select(F.col("id").alias("vec_id"), "n_links", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
