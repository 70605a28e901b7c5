"""Exact deduplication of a growing folder of documents by a stream with keyed state.

Two streams share a home folder, each with its own checkpoint, so a run that is stopped goes on where it was and new files cost
no more than themselves:

* `prints` reads new files and appends a small row for each document: digest of the normalised text, number, size, and the
  content locator, which is the file and the row in it. Texts go no further.
* `state` reads those rows. Its state in RocksDB, on the executors' disks and in the checkpoint, never expires: for each digest
  how many rows had it and which of them is best, with its number and locator. Rows are combined before they are sent, so a
  text that a third of all documents share is one row of each task. Changed keys are written batch by batch.

`resolve` then checks hits: every row whose digest has others is compared byte by byte with the text at the kept locator. Rows
that only share the digest are told apart by their whole texts. The result holds for any digest, however weak (`bits`).

Defined results: a null text is empty; texts without other characters than white space are equal to each other; texts of any
length are read whole; of equal texts the row with the most characters stays, then the smallest number (null last), then
the first locator, so of repeated rows one stays; numbers are integers; an empty table gives an empty result; extra columns are left out.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import stash

#: What is deleted before texts are compared.
BLANKS = " \t\n\x0b\x0c\r"
#: State on disk with a bound on its memory for all stores of an executor.
STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "256",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # many small stores: don't reserve megabytes of log for each
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}

PRINTS = "digest string, doc_id long, size int, file string, row long"
CHANGES = "digest string, n long, best struct<size: int, order: long, file: string, row: long, doc_id: long>"


def normalised(text: str) -> Column:
    return F.translate(F.coalesce(F.col(text), F.lit("")), BLANKS, "")


def _read(reader, path: str, schema, number: str, text: str, bits: int) -> DataFrame:
    """doc_id, size, norm, digest and locator of every document of a (streaming or plain) reader."""
    rows = reader.schema(schema).parquet(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    rows = rows.select(F.col(number).cast("long").alias("doc_id"), F.length(F.coalesce(F.col(text), F.lit(""))).alias("size"), normalised(text).alias("norm"), *place)
    return rows.withColumn("hash", F.sha2("norm", 256)).withColumn("digest", F.substring("hash", 1, bits // 4))


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]):
    before = {k: spark.conf.get(k, None) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def better() -> Column:
    """Orders rows of equal text: greater stays. ~x turns the order of numbers round; null is least."""
    return F.struct("size", F.bitwise_not("doc_id").alias("order"), F.col("file"), F.bitwise_not("row").alias("row"), "doc_id")


def ingest(spark: SparkSession, path: str, schema, home: str, number: str = "doc_id", text: str = "text", bits: int = 256) -> None:
    """Take in what has been added to path since the last call with this home. schema: of path's files."""
    # a stream takes a folder, or whatever a pattern finds; the pattern that finds just this path does for one file as well
    just = f"{path[:-1]}[{path[-1]}]"
    small = _read(spark.readStream, just, schema, number, text, bits).select("digest", "doc_id", "size", "file", "row")
    prints = small.writeStream.format("parquet").option("path", f"{home}/prints").option("checkpointLocation", f"{home}/prints-checkpoint")
    prints.trigger(availableNow=True).start().awaitTermination()

    with _settings(spark, STATE):
        rows = spark.readStream.schema(PRINTS).parquet(f"{home}/prints")
        kept = rows.groupBy("digest").agg(F.count("*").alias("n"), F.max(better()).alias("best"))
        state = kept.writeStream.outputMode("update").option("checkpointLocation", f"{home}/state-checkpoint")
        # a batch that is run again replaces what it wrote
        state = state.foreachBatch(lambda batch, k: batch.write.mode("overwrite").parquet(f"{home}/changes/batch={k}"))
        state.trigger(availableNow=True).start().awaitTermination()


def current(spark: SparkSession, home: str) -> DataFrame:
    """digest, n, best: the state as of the last batch."""
    changes = spark.read.schema(f"{CHANGES}, batch long").parquet(f"{home}/changes")
    last = changes.groupBy("digest").agg(F.max_by(F.struct("n", "best"), "batch").alias("now"))
    return last.select("digest", "now.n", "now.best")


def mismatches(spark: SparkSession, path: str, schema, state: DataFrame, number: str = "doc_id", text: str = "text", bits: int = 256) -> DataFrame:
    """The digests under which some row's bytes differ from the kept one's. state: current(), written."""
    hits = state.filter("n > 1").select("digest", F.col("best.file").alias("kept_file"), F.bitwise_not("best.row").alias("kept_row"))
    texts = _read(spark.read, path, schema, number, text, bits).select("digest", "norm", "file", "row")
    is_kept = (F.col("file") == F.col("kept_file")) & (F.col("row") == F.col("kept_row"))
    # written, as both sides of the comparison need it and plain exchanges let hot digests be split
    found = stash(texts.join(hits, "digest").select("digest", "norm", is_kept.alias("is_kept")), "hits")
    kept = found.filter("is_kept").select("digest", F.col("norm").alias("kept"))
    # a kept row that isn't where its locator says counts as different
    return found.filter("NOT is_kept").join(kept, "digest", "left").filter("kept IS NULL OR norm <> kept").select("digest")


def resolve(spark: SparkSession, path: str, schema, home: str, number: str = "doc_id", text: str = "text", bits: int = 256) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, file, row of every document taken in."""
    state = stash(current(spark, home), "state")
    torn = stash(mismatches(spark, path, schema, state, number, text, bits), "torn")
    prints = spark.read.schema(PRINTS).parquet(f"{home}/prints")
    place = F.struct("file", F.bitwise_not("row").alias("row"))

    def told(rows: DataFrame, groups: DataFrame, key: str, sha: Column) -> DataFrame:
        best = F.col("best")
        return rows.join(groups, key).select("doc_id", best["doc_id"].alias("keep_id"), F.col("n").alias("group_size"), (place == F.struct(best["file"].alias("file"), best["row"].alias("row"))).alias("kept"), sha.alias("text_sha256"), "file", "row")

    if torn.isEmpty() and bits == 256:
        return told(prints, state, "digest", F.col("digest"))
    # digests that different texts share: all their rows again, told apart by the texts themselves
    whole = _read(spark.read, path, schema, number, text, bits)
    apart = whole.join(torn, "digest", "left_semi")
    groups = stash(apart.groupBy("norm").agg(F.count("*").alias("n"), F.max(better()).alias("best")), "groups")
    hashes = whole.select("file", "row", "hash")
    alike = told(prints.join(torn, "digest", "left_anti").join(hashes, ["file", "row"]), state, "digest", F.col("hash"))
    return alike.unionByName(told(apart, groups, "norm", F.col("hash")))
