"""Session helpers: a tuned local session for tests/bench, and reliable scratch
storage for lineage cuts (``checkpoint``) and materialised intermediates.

On a cluster the shared folder is whatever ``spark.checkpoint.dir`` names; we
read it from the session and only set our own when it is unset (tests, bench).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def get_session(master: str | None = None, shuffle_partitions: int = 8,
                app: str = "marisnow") -> SparkSession:
    builder = (
        SparkSession.builder.master(master or os.environ.get("MARISNOW_MASTER", "local[*]"))
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("MARISNOW_DRIVER_MEMORY", "16g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


_SHIPPED: set[int] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``marisnow`` importable in every Python worker: zip the package
    once per driver process and register it with ``addPyFile`` (the
    cluster-wide distribution mechanism; a no-op after the first call)."""
    sc = spark.sparkContext
    if id(sc) in _SHIPPED:
        return
    import zipfile
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    zpath = os.path.join(tempfile.mkdtemp(prefix="marisnow-py-"), "marisnow.zip")
    with zipfile.ZipFile(zpath, "w", zipfile.ZIP_DEFLATED) as zf:
        for d, _dirs, files in os.walk(pkg):
            if "__pycache__" in d:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(zpath)
    _SHIPPED.add(id(sc))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.  Where none is configured a
    local session (tests) gets its own; on a cluster that raises, because
    executors would not see each other's files."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        if not re.match(r"local(\[[^-]*\])?$", sc.master):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="marisnow-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return sc.getCheckpointDir() or current


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder (``file:``
    URIs are returned as plain paths so Python tasks can write there too)."""
    base = ensure_checkpoint_dir(spark)
    if base.startswith("file:"):
        base = "/" + base[len("file:"):].lstrip("/")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df, spark: SparkSession | None = None, name: str = "stage", fmt: str = "parquet"):
    """Cut lineage by writing ``df`` to the shared scratch folder and reading
    it back.  Survives executor loss (unlike caching) and gives the next
    stage exact statistics for AQE."""
    spark = spark or df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").format(fmt).save(path)
    return spark.read.schema(df.schema).format(fmt).load(path)  # the schema is known: no job to infer it
