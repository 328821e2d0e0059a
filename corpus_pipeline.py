"""The training-corpus pipeline: STAGES over ``documents``, each written as
Parquet and read again as the next one's input."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from carelake.llm.decontaminate import contamination
from carelake.llm.near_dup import near_duplicates
from carelake.llm.pii import pseudonymise
from carelake.llm.queries import PII_KEY, held_out, sentencepiece_model
from carelake.llm.sentencepiece_codec import encoding_digest
from carelake.llm.toxicity import toxicity_scores
from carelake.operators.keys import dense_keys
from carelake.session import ensure_checkpoint_dir

#: Internal name of a row's own id.
ROW = "__row"


def by_row(docs: DataFrame) -> DataFrame:
    """``docs`` with a column ROW that is unique and never null, ascending with
    doc_id (null last), so stages judge rows, not ids. That is the doc_id itself
    where the table has each once; else rows are numbered and written out."""
    if not docs.groupBy("doc_id").count().where("doc_id IS NULL OR count > 1").limit(1).count():
        return docs.withColumn(ROW, F.col("doc_id").cast("long"))
    return dense_keys(docs, ["doc_id", *[c for c in docs.columns if c != "doc_id"]], ROW)


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose ROW is not in ``gone``, without that column."""
    return rows.join(gone.select(ROW), ROW, "left_anti").drop(ROW)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text scores below 0.3 for toxicity, those without an id included."""
    rows = by_row(docs)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    toxic = toxicity_scores(rows, labels, held_out(4, 2), carry=(ROW,)).where("predicted = 1")
    return without(rows, toxic).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near duplicates (five-word shingles, similarity 0.8
    or more): the one with the smallest id, one without an id only where no row of
    the group has one. Rows without words all stay."""
    rows = by_row(docs)
    gone = near_duplicates(rows, id_col=ROW, shingle_words=5).where("NOT kept").select(F.col("doc_id").alias(ROW))
    return without(rows, gone).select(*docs.columns)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark passage, with or without an id."""
    rows = by_row(docs)
    leaks = contamination(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), id_col=ROW)
    return without(rows, leaks.select(F.col("doc_id").alias(ROW)).distinct()).select(*docs.columns)


def pseudonymise_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by pseudonyms; n_chars follows the text."""
    out = pseudonymise(docs, PII_KEY, counts=False)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text")).cast(
            docs.schema["n_chars"].dataType))
    return out


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_crc32, round_trip of every document."""
    return encoding_digest(docs, sentencepiece_model())


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("pii", pseudonymise_pii),
    ("sentencepiece", encode_documents),
]

#: Learned scores, pseudonyms and tokenization have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = f"{ensure_checkpoint_dir(spark).rstrip('/')}/corpus-pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
