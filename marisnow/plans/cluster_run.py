"""End-to-end clustering run: collect -> non-living mask (+ class
augmentation) -> exact seeded sample -> features -> size channel -> reduce
-> HDBSCAN -> merge -> noise assignment / fallback -> labels -> artefacts
-> optional bundles.  Every stage is a Spark job; stage outputs are written
to the run folder (the same points the upstream tool persists), which also
cuts lineage."""

from __future__ import annotations

import logging
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marisnow.functions import paths as PF
from marisnow.operators.cluster import final_labels
from marisnow.operators.graph import _cut
from marisnow.operators.hdbscan import hdbscan
from marisnow.operators.reduce import pca_reduce
from marisnow.operators.rows import augmented_non_living, random_sample
from marisnow.operators.vectors import append_log_area, merge_clusters
from marisnow.schemas import DEFAULT_NON_LIVING_CLASSES, SAVED_KEYS
from marisnow.sources.runs import ASSIGN_SCHEMA

log = logging.getLogger(__name__)


@dataclass
class RunConfig:
    """Run settings (the saved run-config keys plus the source/output)."""
    source_root: str = ""
    output_dir: str = ""
    metadata_choice: str = "auto"
    crop_path_token: str | None = "Deconv_crops"
    n_samples: int = 100_000
    seed: int = 42
    ssl_aug_profile: str = "default"
    ssl_size_aware_canvas: bool = False
    ssl_canvas_size: int = 512
    umap_dims: int = 20
    umap_n_neighbors: int = 30
    umap_min_dist: float = 0.0
    min_cluster_size: int = 100
    hdbscan_min_samples: int | None = None
    hdbscan_cluster_selection_epsilon: float = 0.0
    hdbscan_cluster_selection_method: str = "eom"
    size_feature_mode: str = "off"
    size_feature_weight: float = 0.0
    fallback_kmeans_k: int | None = None
    max_clusters: int | None = None
    keep_noise_as_noise: bool = False
    fallback_on_all_noise: bool = True
    non_living_classes: tuple = field(default_factory=lambda: tuple(DEFAULT_NON_LIVING_CLASSES))
    max_zip_mb: float = 500.0

    def to_dict(self) -> dict:
        d = asdict(self)
        return {k: d[k] for k in SAVED_KEYS}


def cluster_features(features: DataFrame, id_col: str, vec_col: str, cfg: RunConfig) -> tuple[DataFrame, dict]:
    """(id, embedding, cluster_raw) and stats {clusters, noise, noise_pct, all_noise}.

    Reduction: PCA to ``umap_dims`` (deterministic stand-in for the
    neighbour-graph layout), then HDBSCAN on the embedding, then merging."""
    red = _cut(pca_reduce(features.select(F.col(id_col).alias("id"), F.col(vec_col).alias("_f")), "_f",
                          cfg.umap_dims, "embedding").select("id", "embedding"))
    labels = hdbscan(red, "id", "embedding", cfg.min_cluster_size, cfg.hdbscan_min_samples,
                     cfg.hdbscan_cluster_selection_epsilon, cfg.hdbscan_cluster_selection_method)
    out = _cut(red.join(labels, "id"))
    stats = out.agg(F.count_distinct(F.when(F.col("cluster_raw") != -1, F.col("cluster_raw"))).alias("clusters"),
                    F.sum((F.col("cluster_raw") == -1).cast("int")).alias("noise"),
                    F.count(F.lit(1)).alias("n")).first()
    info = {"clusters": int(stats["clusters"]), "noise": int(stats["noise"] or 0),
            "noise_pct": 100.0 * (stats["noise"] or 0) / max(int(stats["n"]), 1),
            "all_noise": int(stats["clusters"]) == 0}
    if cfg.max_clusters is not None and info["clusters"] > cfg.max_clusters:
        out = merge_clusters(out, "cluster_raw", "embedding", cfg.max_clusters)
    return out, info


def cluster_run(spark: SparkSession, particles: DataFrame, features: DataFrame, cfg: RunConfig,
                category_col: str = "top1", path_col: str = "full_path") -> dict:
    """Run on an already collected particle table and a feature table
    (object_id, image_path, features); returns the artefact DataFrames."""
    classes = tuple(cfg.non_living_classes)
    flagged = augmented_non_living(particles, category_col, classes, "_nl")
    sample = _cut(random_sample(flagged, cfg.n_samples, cfg.seed))
    nl = sample.filter(F.col("_nl"))
    if nl.isEmpty():  # nothing to cluster: the sample alone goes on to the export
        log.warning("no non-living particle in the sample; clustering skipped")
        none = spark.createDataFrame([], ASSIGN_SCHEMA)
        return {"sample": sample.drop("_nl"), "assignments": none, "stats": {"clusters": 0, "noise": 0, "noise_pct": 0.0, "all_noise": True},
                "embedding": spark.createDataFrame([], "id long, embedding array<double>")}
    feats = _cut(features.join(nl.select(F.col("object_id").cast("string").alias("object_id"),
                                         *([F.col("area")] if "area" in nl.columns else [])), "object_id"))
    if cfg.size_feature_mode != "off" and "area" in feats.columns:
        feats = append_log_area(feats, "area", "features", cfg.size_feature_mode, cfg.size_feature_weight)
    f2 = _cut(feats.withColumn("_id", F.xxhash64("object_id")))
    clustered, info = cluster_features(f2, "_id", "features", cfg)
    lab = final_labels(clustered.withColumnRenamed("cluster_raw", "cluster_raw"), "embedding",
                       keep_noise=cfg.keep_noise_as_noise, fallback_on_all_noise=cfg.fallback_on_all_noise,
                       fallback_k=cfg.fallback_kmeans_k, seed=cfg.seed)
    assign = (lab.join(f2.select("_id", "object_id", "image_path"), F.col("id") == F.col("_id"))
              .select("object_id", PF.rewrite_crops("image_path").alias("image_path"), "cluster_raw",
                      "cluster_final", "cluster_label"))
    return {"sample": sample.drop("_nl"), "assignments": assign, "stats": info,
            "embedding": lab.select("id", "embedding")}

