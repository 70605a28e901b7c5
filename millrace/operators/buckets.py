"""Keyed tables in which a change costs the buckets that it meets, not the table.

A table is Parquet partitioned by `_bucket`, a hash of its key, so a batch of keys names the partitions that can hold
them: the rest isn't read (the filter prunes partitions when the plan is made) and isn't written (only the partitions of
the result are overwritten). The next rows of the touched buckets are written beside the table first, then put in
place; if that is interrupted, the next change puts them in place again before it looks at anything. One writer
at a time, as under a lease.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators import merge
from millrace.sources.files import filesystem

BUCKET = "_bucket"
#: Folders that readers of the table skip.
PENDING, SHAPE = "_pending", "_shape"


def bucket_of(keys: list[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


class BucketedTable:
    """keys: the columns that name a bucket (a key, or the group that is replaced as a whole). n: how many buckets there are.

    A bucket should hold some hundred MB: choose n for the table as it will be. Which buckets a batch meets is known on
    the driver, at most n numbers.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], n: int):
        self.spark, self.path, self.keys, self.n = spark, path.rstrip("/"), keys, n

    def _keyed(self, df: DataFrame) -> DataFrame:
        return df.withColumn(BUCKET, bucket_of(self.keys, self.n))

    def _put(self, df: DataFrame, path: str, **options: str) -> None:
        """Buckets together in a task where they are small, split where one is large; sorted by key, so row groups tell keys apart."""
        dealt = df.hint("rebalance", BUCKET).sortWithinPartitions(BUCKET, *self.keys)
        dealt.write.mode("overwrite").options(**options).partitionBy(BUCKET).parquet(path)

    def create(self, df: DataFrame) -> None:
        self._put(self._keyed(df), self.path)
        # a table without rows has no file that tells its columns
        df.limit(0).coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{SHAPE}")

    def exists(self) -> bool:
        fs, path = filesystem(f"{self.path}/{SHAPE}/_SUCCESS")
        return fs.get_file_info(path).is_file

    def read(self, buckets: list[int] | None = None) -> DataFrame:
        """The table, or some of its buckets."""
        self.recover()
        df = self._load(self.path)
        return (df if buckets is None else df.filter(F.col(BUCKET).isin(buckets))).drop(BUCKET)

    def _load(self, path: str) -> DataFrame:
        columns = self.spark.read.parquet(f"{self.path}/{SHAPE}").schema
        return self.spark.read.schema(T.StructType([*columns.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(path)

    def lookup(self, keys: DataFrame) -> DataFrame:
        """The rows of some keys, read from their buckets only."""
        return self.read(self.touched(keys)).join(keys.select(*self.keys).distinct(), self.keys, "left_semi")

    def touched(self, batch: DataFrame) -> list[int]:
        return sorted(r[0] for r in batch.select(bucket_of(self.keys, self.n).alias("b")).distinct().collect())

    def change(self, batch: DataFrame, how: Callable[[DataFrame, DataFrame], DataFrame]) -> list[int]:
        """Make the rows of the buckets that batch meets what `how(their rows, batch)` says; returns the buckets written.

        A bucket whose rows come out as they were is left alone. batch is evaluated more than once: write it if that is dear.
        """
        met = self.touched(batch)
        if not met:
            return []
        before = self.read(met)
        staged = f"{self.path}/{PENDING}/{uuid.uuid4().hex}"
        self._put(self._keyed(how(before, batch).select(*before.columns)), f"{staged}/rows")
        changed = self._differing(self._keyed(before), self._load(f"{staged}/rows"))
        if changed:
            # from here on the change can be finished by anyone
            self.spark.createDataFrame([(b,) for b in changed], "bucket int").coalesce(1).write.parquet(f"{staged}/ready")
            self._finish(staged)
        self._drop(staged)
        return changed

    def _differing(self, before: DataFrame, after: DataFrame) -> list[int]:
        """Buckets whose rows, counted and summed by hash, are not the same."""
        columns = [c for c in before.columns if c != BUCKET]
        mark = lambda name: [F.count("*").alias(f"{name}_n"), F.sum(F.xxhash64(*columns).cast("decimal(38,0)")).alias(f"{name}_h")]
        both = before.groupBy(BUCKET).agg(*mark("a")).join(after.groupBy(BUCKET).agg(*mark("b")), BUCKET, "full")
        same = F.col("a_n").eqNullSafe(F.col("b_n")) & F.col("a_h").eqNullSafe(F.col("b_h"))
        return sorted(r[0] for r in both.filter(~same).select(BUCKET).collect())

    def _finish(self, staged: str) -> None:
        buckets = [r[0] for r in self.spark.read.schema("bucket int").parquet(f"{staged}/ready").collect()]
        rows = self._load(f"{staged}/rows").filter(F.col(BUCKET).isin(buckets))
        self._put(rows, self.path, partitionOverwriteMode="dynamic")
        # a bucket that lost all its rows has no partition in the result
        kept = {r[0] for r in rows.select(BUCKET).distinct().collect()}
        for b in set(buckets) - kept:
            self._drop(f"{self.path}/{BUCKET}={b}")

    def recover(self) -> None:
        """Finish changes that were interrupted while they were put in place, and forget those that weren't ready."""
        from pyarrow.fs import FileSelector

        fs, path = filesystem(f"{self.path}/{PENDING}")
        for found in fs.get_file_info(FileSelector(path, allow_not_found=True)):
            staged = f"{self.path}/{PENDING}/{found.base_name}"
            if fs.get_file_info(f"{path}/{found.base_name}/ready/_SUCCESS").is_file:
                self._finish(staged)
            self._drop(staged)

    def _drop(self, folder: str) -> None:
        fs, path = filesystem(folder)
        if fs.get_file_info(path).type.name == "Directory":
            fs.delete_dir(path)

    # ---- the merges of millrace.operators.merge, bucket by bucket

    def upsert(self, batch: DataFrame, rules: dict[str, str], insert: bool = True, update: bool = True) -> list[int]:
        return self.change(batch, lambda old, new: merge.merge(old, new, self.keys, rules, insert, update))

    def insert_missing(self, batch: DataFrame) -> list[int]:
        return self.change(batch, lambda old, new: merge.insert_missing(old, new, self.keys))

    def replace_groups(self, batch: DataFrame) -> list[int]:
        return self.change(batch, lambda old, new: merge.replace_groups(old, new.select(*old.columns), self.keys))

    def delete(self, keys: DataFrame) -> list[int]:
        return self.change(keys, lambda old, gone: old.join(gone.select(*self.keys).distinct(), self.keys, "left_anti"))
