"""The training-data pipeline: five stages, each of which reads what the one before it wrote.

A stage takes (spark, docs, sf_dir) and returns the columns of ``docs``, but for the last one,
which returns what encoding gives. Rows with a null text go in the first stage; rows with the
same doc_id stay rows of their own until one of a group of near copies is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.bpe import round_trip
from tidemark.llm.decontaminate import contamination
from tidemark.llm.jaccard import link_documents
from tidemark.llm.language import identify, learn
from tidemark.llm.queries import table, vocabulary
from tidemark.llm.secrets import redact_secrets
from tidemark.llm.shared import workspace

SHINGLE, PERCENT = 5, 80

ROW = "_pipeline_row"
# Up to so many row numbers (some 50 MB) are sent to all tasks, so that the texts stay where they
# are; more are joined by shuffle.
BROADCAST_ROWS = 1_000_000


def _numbered(docs: DataFrame) -> DataFrame:
    """Rows of a table, told apart by their place in its files."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    few = dropped.count() <= BROADCAST_ROWS
    return docs.join(F.broadcast(dropped) if few else dropped, ROW, "left_anti").drop(ROW)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents in one or two learned languages, with the language found.

    The score does not decide: the better of two languages has half of the chances at least,
    however little a text is like either.
    """
    model = learn(docs.select(F.col("doc_id").alias("id"), "lang", "text"))
    found = identify(docs, model, evidence=True).filter((F.col("lang_pred") != "und") & F.col("known"))
    return found.withColumn("lang", F.col("lang_pred")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document of the smallest id of each group of near copies."""
    rows = _numbered(docs)
    with workspace(spark) as work:
        linked = link_documents(rows.select(ROW, "doc_id", "text"), work, SHINGLE, PERCENT)
        dropped = linked.filter(~F.col("first")).select(ROW).checkpoint()
    return _without(rows, dropped)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a window of a benchmark item."""
    rows, items = _numbered(docs), table(spark, sf_dir, "benchmark")
    with workspace(spark) as work:
        found = contamination(rows.select(ROW, "text"), items, work)
        dropped = found.filter("contaminated").select(ROW).checkpoint()
    return _without(rows, dropped)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put a mark in place of each secret."""
    clean = redact_secrets(docs)
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode: number of tokens, digests of the ids and of the decoded text."""
    return round_trip(docs.select("doc_id", "text"), vocabulary())


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("secret_scan", secret_scan),
    ("bpe_round_trip", bpe_round_trip),
]

# Learned machines and byte-pair merges are beyond SQL; the tests hold each stage against a
# plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    with workspace(spark) as work:
        for name, stage in STAGES:
            docs = work.write(stage(spark, docs, sf_dir), name)
        return docs.checkpoint()
