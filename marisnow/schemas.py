"""Fixed names of the particle data model.

FIXED VALUES — these must equal the upstream tool's names for the exported
tables to be readable by the same consumers (EcoTaxa-style TSV).  They are
stated here plainly, in their natural order.
"""

from __future__ import annotations

# --- FIXED VALUES: export column order -------------------------------------
EXPORT_COLUMNS = [
    "img_file_name",
    "object_id",
    "object_annotation_category",
    "object_annotation_status",
    "object_lat",
    "object_lon",
    "object_date",
    "object_time",
    "object_depth_min",
    "object_depth_max",
    "object_area",
    "object_esd",
    "object_width",
    "object_height",
    "object_major_axis_len",
    "object_minor_axis_len",
    "object_circularity",
    "object_eccentricity",
    "object_solidity",
    "object_mean_intensity",
    "object_prob_1",
    "object_pressure",
    "object_interpolated_t",
    "object_interpolated_s",
    "object_interpolated_o",
    "object_interpolated_chl",
    "sample_cruise",
    "sample_id",
]

# --- FIXED VALUES: raw metadata name -> export name ------------------------
RAW_TO_EXPORT = {
    "full_path": "object_full_path",
    "filename": "img_file_name",
    "pressure [dbar]": "object_pressure",
    "depth [m]": "object_depth_min",
    "date": "object_date",
    "time": "object_time",
    "lat": "object_lat",
    "lon": "object_lon",
    "area": "object_area",
    "esd": "object_esd",
    "w": "object_width",
    "h": "object_height",
    "top1": "object_annotation_category",
    "prob1": "object_prob_1",
    "cruise": "sample_cruise",
    "interpolated_t": "object_interpolated_t",
    "interpolated_s": "object_interpolated_s",
    "interpolated_o": "object_interpolated_o",
    "interpolated_chl2_raw": "object_interpolated_chl",
}

# --- FIXED VALUES: column candidates, first present wins -------------------
PATH_CANDIDATES = ["full_path", "object_full_path", "img_path"]
CATEGORY_CANDIDATES = ["top1", "object_annotation_category"]

# --- FIXED VALUES: default class tokens and label texts --------------------
DEFAULT_NON_LIVING_CLASSES = ("non_living", "detritus")
NOT_LIVING_VARIANT = "not living"
NOISE_LABEL = "non_living/noise"
CLUSTER_LABEL_FORMAT = "non_living/cluster_%02d"

# --- FIXED VALUES: metadata file names and default patterns ----------------
CROPS_METADATA_SUFFIX = "_crops_metadata.csv"
ECOTAXA_SUFFIX = "_ecotaxa.tsv"
ECOTAXA_METADATA_NAME = "ecotaxa_metadata.tsv"
DEFAULT_METADATA_PATTERNS = (
    "*_crops_metadata.csv",
    "*_metadata.csv",
    "ecotaxa_metadata.tsv",
    "*_ecotaxa.tsv",
)

# --- FIXED VALUES: tokens that disable the path filter ---------------------
PATH_TOKEN_OFF = ("off", "none", "no")

# --- FIXED VALUES: run directory artefacts ---------------------------------
SAMPLE_INDEX = "sample_index.csv"
ASSIGNMENTS = "cluster_assignments.csv"
VIEW2D = "umap_2d.csv"
FEATURES = "features_nonliving.h5"
RUN_TIMESTAMP_ARTEFACTS = [SAMPLE_INDEX, ASSIGNMENTS, VIEW2D, FEATURES]

# --- FIXED VALUES: cache sidecar keys --------------------------------------
CACHE_KEYS = [
    "source_root",
    "metadata_patterns",
    "metadata_choice",
    "crop_path_token",
    "crop_filter_strict",
    "rewrite_crops_to_deconv",
]

# --- FIXED VALUES: mask folder names ----------------------------------------
MASK_DIR_NAMES = ["Masks", "masks", "Mask", "mask"]

# Strings the metadata readers treat as missing (pandas' default NA tokens).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

ASSIGNMENT_COLUMNS = ["object_id", "image_path", "cluster_raw", "cluster_final", "cluster_label"]
VIEW2D_COLUMNS = ["object_id", "umap_x", "umap_y", "cluster_raw", "cluster_final", "cluster_label"]

# The keys of a saved run configuration.
SAVED_KEYS = (
    "metadata_choice", "crop_path_token", "n_samples", "seed", "ssl_aug_profile",
    "ssl_size_aware_canvas", "ssl_canvas_size", "umap_dims", "umap_n_neighbors", "umap_min_dist",
    "min_cluster_size", "hdbscan_min_samples", "hdbscan_cluster_selection_epsilon",
    "hdbscan_cluster_selection_method", "size_feature_mode", "size_feature_weight",
    "fallback_kmeans_k", "max_clusters", "keep_noise_as_noise",
)
