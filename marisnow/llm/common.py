"""Small helpers shared by the operators of this package."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marisnow.session import ensure_checkpoint_dir, scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: white space of the line and word rules: [\x20\x09-\x0D]
BLANKS = " \t\n\u000b\u000c\r"


def lower_ascii(col: Column) -> Column:
    """Lower-case A-Z only; every other letter keeps its case."""
    plain = F.octet_length(col) == F.length(col)  # all ASCII: the built-in function is the same and faster
    return F.when(plain, F.lower(col)).otherwise(F.translate(col, UPPER, UPPER.lower()))


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared scratch folder: cuts lineage,
    survives lost executors and is computed once for several readers."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = scratch_path(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def discard(df: DataFrame) -> None:
    """Delete the scratch table behind ``written``'s result, once nothing
    reads it any more."""
    path = getattr(df, "_scratch", None)
    if path:
        spark = df.sparkSession
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


def whole_vectors(df: DataFrame, vec_col: str, scale: int, new: str = "_v") -> DataFrame:
    """Rows whose vector is there and holds finite components only, plus
    ``new``: floor(scale * component) as longs."""
    good = F.col(vec_col).isNotNull() & F.forall(vec_col, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return df.filter(F.coalesce(good, F.lit(False))).withColumn(
        new, F.transform(vec_col, lambda c: F.floor(c.cast("double") * scale).cast("long")))


def free_name(name: str, taken) -> str:
    """``name``, or the first of name_1, name_2, ... that no column of
    ``taken`` has, in any case."""
    low = {c.lower() for c in taken}
    out, i = name, 0
    while out.lower() in low:
        i += 1
        out = f"{name}_{i}"
    return out


def as_text(col: Column) -> Column:
    """UTF-8 bytes of a text column for Arrow kernels; null becomes empty."""
    return F.coalesce(col, F.lit("")).cast("binary")


def with_kernel(df: DataFrame, text_col: str, kernel, new: str) -> DataFrame:
    """``df`` plus the columns of ``new`` (DDL), which ``kernel`` makes from a
    batch's texts (a list of str): a list of Arrow arrays in order.  Columns
    of ``df`` named like new ones are replaced; the rest pass through."""
    import pyarrow as pa
    from pyspark.sql.types import StructType

    add = StructType.fromDDL(new)
    taken = {f.name.lower() for f in add}
    keep = [c for c in df.columns if c.lower() not in taken or c == text_col]
    src = df.select(*keep, as_text(F.col(text_col)).alias(free_name("utf8", keep)))

    def run(batches):
        for b in batches:
            texts = [t.decode("utf-8", "replace") for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), *kernel(texts)],
                                             [*keep, *(f.name for f in add)])

    return src.mapInArrow(run, StructType([*(src.schema[c] for c in keep), *add.fields]))
