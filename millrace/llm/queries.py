"""The training-data operators as queries on whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, chat, exact, idfile, lsh, media, mixing, ngram, oracles, pii, quality, repair, reputation, trie
from millrace.llm.common import scratch, stash, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), "doc_id", "text", "source", [1, 2, 3])
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "rate", "copies", "residual")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_BPE)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")
    plain = F.filter("spans", lambda s: s["plain"])
    count = lambda kind: F.size(F.filter(plain, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    n_added = (F.size("spans") - F.size(plain)).cast("long").alias("n_added")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2(pii.listed(plain), 256).alias("base_sha256"), pii.listed(F.col("spans")).alias("spans"), n_added)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.train(docs, quality.learnable(labels), "doc_id", "text")
    scores = quality.scored(docs, model, keep_text=False)
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    return scores.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh.links(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", says), (-7, 1, "assistant", says)], "conv_id long, turn long, role string, text string")
    chats = stash(chat.format_chats(turns.unionByName(own), BYTE_BPE), "chats")
    back = chat.read_back(chats, BYTE_BPE)
    said = F.array_join(F.zip_with("roles", "texts", lambda r, t: F.concat(r, F.lit("\n"), t, F.lit("\n"))), "")
    loss = F.array_join("loss_texts", "")
    return back.select(
        "conv_id",
        F.size("roles").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = media.metadata(media.store(table(spark, sf_dir, "documents"), "doc_id", "text"))
    return media.features(index).select("doc_id", "n_bytes", *media.NEW, "digest")


def op8_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.join(table(spark, sf_dir, "documents"), "doc_id", "text")


def op9_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = idfile.write_ids(table(spark, sf_dir, "documents"), "doc_id", "text", WORD_BPE, idfile.folder(spark), 1)
    return idfile.read_ids(files, with_ids=False)


def op10_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    number = F.expr(r"try_cast(nullif(regexp_extract(url, '://[^?#]*/([0-9]+)(\\.html|/)?([?#]|$)', 1), '') AS bigint)")
    labels = table(spark, sf_dir, "labels")
    # an address ends in the number of the document whose text the page carries, so a page is bad if that
    # document is labelled toxic or of low quality
    bad = labels.select(F.col("doc_id").alias("_doc"), ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad")).filter("bad IS NOT NULL")
    outcomes = pages.withColumn("_k", number).join(bad, F.col("_k") == F.col("_doc")).select("url", "bad")
    return reputation.judge(pages, "url", outcomes, RULES).select("page_id", "host", "path", "rule", "verdict")


def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.nodes(trie.grafted(trie.sequences(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))))


def op12_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema, path, home = table(spark, sf_dir, "documents").schema, f"{sf_dir}/documents.parquet", scratch(spark, "exact")
    exact.ingest(spark, path, schema, home)
    return exact.resolve(spark, path, schema, home).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair.repaired_digests(repair.damaged(turns), turns)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_mix, op2_bpe, op3_pii, op4_quality, op5_embeddings, op6_chat, op7_media, op8_ngrams, op9_ids, op10_urls, op11_trie, op12_exact, op13_repair)}


def oracle_sql() -> dict[str, str]:
    return dict(oracles.SQL)
