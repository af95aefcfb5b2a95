"""Path expressions: validity, Crops -> Deconv_crops rewrite, token match."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# FIXED VALUES: the folder rewrite (case-sensitive, separator kept).
CROPS_RE = r"([/\\])Crops([/\\])"
CROPS_REPLACEMENT = r"$1Deconv_crops$2"
DECONV_TOKEN = "deconv_crops"
CROPS_ANY_RE = r"(?:^|[\\/])crops(?:[\\/])"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def valid_path(c) -> Column:
    col = _col(c)
    return col.isNotNull() & (col.cast("string") != "")


def rewrite_crops(c) -> Column:
    return F.regexp_replace(_col(c).cast("string"), CROPS_RE, CROPS_REPLACEMENT)


def path_contains(c, pattern: str) -> Column:
    """Case-insensitive regex containment on the lower-cased path."""
    return F.coalesce(F.lower(_col(c).cast("string")).rlike(pattern), F.lit(False))


def parent_dir(c) -> Column:
    return F.regexp_extract(_col(c), r"^(.*)/[^/]*$", 1)


def path_segment(c, idx_from_end: int) -> Column:
    """Segment counted from the end (1 = last)."""
    return F.element_at(F.split(_col(c), "/"), -idx_from_end)
