"""Parquet table access and the ``particles`` view derived from the driver's
TPC-H-like tables (see FIXTURES.md): orders become particles, the customer's
nation becomes the cruise, and the order key shapes path, class and time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def particles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Particle metadata in the raw (per-profile CSV) naming.

    Columns: object_id, full_path, top1, area, esd, cruise, date, time,
    ``depth [m]``, lat, lon.  Joins are left joins on small dimension tables
    (customer, nation); Catalyst prunes every unused column at the scan."""
    o = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    c = load(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_acctbal")
    n = load(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = (o.join(c, o.o_custkey == c.c_custkey, "left")
          .join(n, F.col("c_nationkey") == n.n_nationkey, "left"))
    k = F.col("o_orderkey")
    folder = (F.when(k % 3 == 0, "Deconv_crops").when(k % 3 == 1, "Crops").otherwise("other"))
    top1 = (F.when(k % 8 == 0, "non_living")
             .when(k % 8 == 1, "Non-Living  fiber")
             .when(k % 8 == 2, "detritus")
             .when(k % 8 == 3, "copepod")
             .when(k % 8 == 4, "not_living")
             .when(k % 8 == 5, F.lit(None).cast("string"))
             .when(k % 8 == 6, "radiolaria")
             .otherwise("NON_LIVING__bubble"))
    return j.select(
        k.cast("string").alias("object_id"),
        F.concat(F.lit("/data/"), F.col("n_name"), F.lit("/"), F.col("n_name"), F.lit("_Results/"),
                 folder, F.lit("/"), F.expr("o_orderkey div 2").cast("string"), F.lit(".png")).alias("full_path"),
        top1.alias("top1"),
        F.col("o_totalprice").alias("area"),
        (F.col("o_totalprice") / 1000).alias("esd"),
        F.col("n_name").alias("cruise"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        ((k * 37) % 10000000).alias("time"),
        ((k % 200) * 1.5).alias("depth [m]"),
        (F.col("n_regionkey") * 10.0 + 0.25).alias("lat"),
        (F.col("c_acctbal") / 100).alias("lon"),
    )


def embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature vectors: object_id (string), features array<float>, planted label."""
    e = load(spark, sf_dir, "embeddings")
    return e.select(F.col("vec_id").cast("string").alias("object_id"),
                    F.col("vec_id"),
                    F.col("embedding").alias("features"),
                    F.col("label"))
