"""The corpus pipeline: documents -> toxicity -> line dedup -> SimHash
near-dedup -> benchmark decontamination -> sampled SentencePiece ids.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all that the
one before has kept; its result is written as Parquet in the shared scratch
folder and read again as the next one's ``docs``.  All but the last return
the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marisnow.llm import decontam, linededup, simhash, spiece, toxicity
from marisnow.llm.common import table, written
from marisnow.session import ensure_checkpoint_dir, ship_package


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model accepts; it is fitted on the labels
    of rows outside its held-out fold."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.score(docs, model).filter("predicted = 0").select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the lines it keeps; ``n_chars`` follows the text
    of documents that lost lines."""
    out = linededup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
                             .otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group, that of the smallest id."""
    return simhash.one_per_group(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, ids, n_ids, lossless``: each text's sampled piece ids, and
    whether decoding gives the text again."""
    out = spiece.encode(docs.select("doc_id", "text"), F.col("doc_id"), check="lossless")
    return out.select("doc_id", "ids", F.size("ids").cast("long").alias("n_ids"), "lossless")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", dedup_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding", encode),
]

#: fingerprints, learned scores and sampled pieces have no SQL; tests/llm holds the brute-force versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over the whole ``documents`` table."""
    ship_package(spark)
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "pipeline")
    return STAGES[-1][1](spark, docs, sf_dir)
