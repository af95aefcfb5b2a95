"""Incremental metadata collection with Structured Streaming.

New per-profile metadata files landing under a folder are picked up by the
file source; each micro-batch keeps the first row per image path (file,
row order) and appends only paths the particle table does not hold yet.
Writes are idempotent per batch id (the batch's own folder is overwritten on
a retry and excluded from the "already known" set), so a restarted query
with the same checkpoint location neither loses nor duplicates rows."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marisnow.functions import paths as PF
from marisnow.operators.rows import dedup_first
from marisnow.sources.runs import path_missing


def metadata_stream(spark: SparkSession, folder: str, columns: list[str], sep: str = ",",
                    pattern: str = "*.csv", max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame over metadata files (all columns text)."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    r = (spark.readStream.schema(schema).option("header", "true").option("sep", sep)
         .option("pathGlobFilter", pattern).option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.csv(folder)
    return df.select("*", F.regexp_replace(F.col("_metadata.file_path"), r"^file:/*", "/").alias("_source_file"),
                     F.col("_metadata.file_block_start").alias("_block"))


def _known_paths(spark: SparkSession, table: str, path_col: str, batch_id: int) -> DataFrame | None:
    try:
        t = spark.read.parquet(table)
    except AnalysisException as e:
        if not path_missing(e):  # anything but a table not created yet
            raise
        return None
    return t.filter(F.col("batch_id") != batch_id).select(path_col).distinct()


def ingest_batch(batch: DataFrame, batch_id: int, table: str, path_col: str = "full_path",
                 rewrite: bool = True) -> None:
    spark = batch.sparkSession
    # row order inside a file: the micro-batch is a static DataFrame here
    b = batch.withColumn("_row", F.monotonically_increasing_id()).filter(PF.valid_path(path_col))
    b = dedup_first(b, [path_col], ["_source_file", "_block", "_row"])
    if rewrite:  # two paths of a batch may become one
        b = b.withColumn(path_col, PF.rewrite_crops(path_col))
        b = dedup_first(b, [path_col], ["_source_file", "_block", "_row"])
    known = _known_paths(spark, table, path_col, batch_id)
    if known is not None:
        b = b.join(known, path_col, "left_anti")
    # the batch folder is a partition of the table (batch_id=<id>): a retry overwrites only it
    b.drop("_row", "_block").write.mode("overwrite").parquet(f"{table}/batch_id={batch_id}")


def start_ingest(spark: SparkSession, folder: str, table: str, checkpoint: str, columns: list[str],
                 path_col: str = "full_path", trigger_once: bool = False, **opts) -> StreamingQuery:
    stream = metadata_stream(spark, folder, columns, **opts)
    w = (stream.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: ingest_batch(df, bid, table, path_col)))
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
