"""From raw documents to training tokens, in five stages of the training-data operators.

Every stage takes (spark, docs, sf_dir), works on all that the one before kept, and returns a DataFrame;
all but the last return the columns of documents.

Defined results, throughout: null texts count as empty, texts of any length are read whole, empty tables give
empty results, and columns beside doc_id, text and source pass through the first four stages, whatever their
names. Rows that share a doc_id are one document: they stay, go or are taken as often together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import bpe, mixing, ngram, pii, quality
from millrace.llm.common import ship, stash, table
from millrace.llm.queries import BYTE_BPE

#: A document stays if its quality score reaches this.
ACCEPT = 0.5
WEIGHTS = [1, 2, 3]


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the positive-unlabelled classifier accepts; a score of ACCEPT itself is enough.

    Equal texts have equal scores, so repeated rows fare alike; without a single label of a good text all stay.
    """
    ship(spark)
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality.train(docs, quality.learnable(labels), "doc_id", "text")
    return quality.scored(docs, model, out="_quality").filter(F.col("_quality") >= ACCEPT).drop("_quality")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest number of each group linked by five-word shingles at Jaccard 0.8.

    Documents without words are in no group and all stay, as do rows without a number.
    """
    ship(spark)
    gone = ngram.join(docs, "doc_id", "text", n=5, similarity=80, sampled=True).filter("doc_id <> component_id").select("doc_id")
    return ngram.without(docs, "doc_id", stash(gone, "gone"))


def redact_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with personal data replaced by its kind; a null text stays null. n_chars, if there, follows the text."""
    ship(spark)
    clean = pii.redact(docs)
    return clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else clean


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them; those without words once. Ties of size go by a hash of doc_id."""
    ship(spark)
    mixed = mixing.mix(docs, "doc_id", "text", "source", WEIGHTS)
    return mixing.expand(docs, mixed, "doc_id").select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens and ids of every row, and whether the ids decode to its text."""
    ship(spark)
    coded = bpe.encode_and_decode(docs.select("doc_id", "source", "text"), BYTE_BPE)
    exact = F.col("decoded") == F.coalesce("text", F.lit(""))
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", exact.alias("exact"))


STAGES = [("quality", keep_quality), ("near_copies", drop_near_copies), ("pii", redact_pii), ("mix", mix_sources), ("tokens", encode_tokens)]

#: The first stage learns a classifier, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the table of documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
