"""Connected components of a graph that no one machine holds, by large and small stars.

Each round hangs every node's larger neighbours onto its smallest one and then its smaller ones onto
the smallest, until the edges form stars. A round is a pre-aggregated minimum and a join that Spark
can split at hot nodes; its edges are written to the shared folder, so lineage stays short. What is left
of at most SMALL edges is settled in one task.

Defined results: edges with a null end are left out, as are loops; repeated edges count once; a node
without an edge to another isn't in the result; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import local_roots, stash

#: Edges that one task settles by itself; a fixed number, whatever the graph's size.
SMALL = 2_000


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """Edges (a, b) with m, from least (u, m) by u = a.

    The key is changed alike on both sides, so that the join has exchanges of its own on either side:
    only then can Spark split a node with very many edges among tasks.
    """
    key = lambda c: F.col(c).bitwiseXOR(F.lit(1))
    return edges.withColumn("k", key("a")).join(least.select(key("u").alias("uk"), "m"), F.col("k") == F.col("uk"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m")).withColumn("m", F.least("u", "m"))
    return _with_least(both, least).filter("b > a AND b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges run from the larger to the smaller node."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    hung = _with_least(down, least).filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b"))).distinct()


def _settled(edges: DataFrame) -> DataFrame:
    """(id, root) of a small graph, by one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        a, b = (np.concatenate([x.column(c).to_numpy() for x in held]) for c in (0, 1))
        ids, at = np.unique(np.concatenate([a, b]), return_inverse=True)
        root = local_roots(ids, at[: len(a)], at[len(a) :])
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(root)], names=["id", "root"])

    return edges.select("a", "b").coalesce(1).mapInArrow(run, "id long, root long")


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (id, root): the smallest node reachable, for every node with a link to another."""
    now = stash(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    while True:
        # in stars, every node hangs on one node that hangs on none
        size = now.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x"), F.sum(F.xxhash64("b", "a") % 1000003).alias("s")).first()
        if size.n == 0 or tuple(size) == before:
            return now.select(F.col("a").alias("id"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
        if size.n <= SMALL:
            return stash(_settled(now), "roots")
        before = tuple(size)
        now = stash(_small_star(_large_star(now)), "edges")
