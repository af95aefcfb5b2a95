"""Registered image queries.  Images are derived from the embeddings table:
each 64-d vector is rendered as an 8 x 8 gray PNG (pixel = clip(floor(
(v + 0.5) * 255 + 0.5))), written to the shared scratch folder by the
executors and read back through Spark's image source."""

from __future__ import annotations

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from marisnow.operators import imageprep as IP
from marisnow.plans.registry import register
from marisnow.session import scratch_path
from marisnow.sources.images import png_bytes, read_images
from marisnow.sources.tables import load

THRESHOLD = 100


def _pixels(v: np.ndarray) -> np.ndarray:
    return np.clip(np.floor((np.asarray(v, dtype=np.float64) + 0.5) * 255 + 0.5), 0, 255).astype(np.uint8)


def materialize_embedding_images(spark, d):
    """Write one PNG per embedding row; returns (object_id, image_path)."""
    out = scratch_path(spark, "img")

    def write(batches):
        os.makedirs(out, exist_ok=True)
        for pdf in batches:
            paths = []
            for vid, emb in zip(pdf["vec_id"], pdf["embedding"]):
                g = _pixels(emb).reshape(8, 8)
                p = f"{out}/{int(vid)}.png"
                with open(p, "wb") as fh:
                    fh.write(png_bytes(np.repeat(g[:, :, None], 3, axis=2)))
                paths.append(p)
            yield pd.DataFrame({"object_id": pdf["vec_id"].astype(str).to_numpy(), "image_path": paths})
    e = load(spark, d, "embeddings").select("vec_id", "embedding")
    written = e.mapInPandas(write, "object_id string, image_path string")
    written.write.mode("overwrite").parquet(out + "_index")
    return spark.read.parquet(out + "_index"), out


def _images(spark, d):
    idx, out = materialize_embedding_images(spark, d)
    imgs = read_images(spark, out)
    return idx.join(imgs, "image_path")


def render_particles(particles):
    """(object_id, image_path, image): one 8 x 8 grey picture per particle,
    six rows of pixels by its category and two by its id."""
    category = F.coalesce("top1", F.lit("nan"))
    rows = [F.md5(F.concat(F.lit(f"{i}:"), category)) for i in range(3)] + [F.md5(F.col("object_id"))]
    image = F.struct(F.lit(8).alias("height"), F.lit(8).alias("width"), F.lit(1).alias("nChannels"),
                     F.unhex(F.concat(*rows)).alias("data"))
    return particles.select("object_id", F.col("full_path").alias("image_path"), image.alias("image"))


BBOX_SQL = f"""
with px as (select vec_id, generate_subscripts(embedding, 1) - 1 as i,
              least(greatest(floor((cast(unnest(embedding) as double) + 0.5) * 255 + 0.5), 0), 255) as p
            from embeddings),
fg as (select vec_id, i % 8 as x, i // 8 as y from px where p < {THRESHOLD}),
b as (select vec_id, count(*) as n, min(x) as x0, max(x) as x1, min(y) as y0, max(y) as y1 from fg group by vec_id),
bb as (select vec_id, greatest(0, x0 - pad) as x0, greatest(0, y0 - pad) as y0,
         least(7, x1 + pad) as x1, least(7, y1 + pad) as y1
       from (select *, greatest(2, cast(floor(0.1 * greatest(x1 - x0 + 1, y1 - y0 + 1)) as int)) as pad
             from b where n >= 8) q),
ok as (select * from bb where x1 > x0 and y1 > y0)
select cast(e.vec_id as varchar) as object_id, cast(ok.x0 as int) as x0, cast(ok.y0 as int) as y0,
  cast(ok.x1 + 1 as int) as x1, cast(ok.y1 + 1 as int) as y1
from embeddings e left join ok using (vec_id)"""


@register("foreground_bbox", BBOX_SQL)
def q_foreground_bbox(spark, d):
    return IP.bbox_column(_images(spark, d), "object_id", THRESHOLD, 8)


@register("read_images")
def q_read_images(spark, d):
    """Decoded size and mean pixel value per rendered image (rows-only)."""
    imgs = _images(spark, d)
    return imgs.select("object_id", F.col("image.height").alias("height"), F.col("image.width").alias("width"),
                       F.col("image.nChannels").alias("channels"))


@register("extract_features")
def q_extract_features(spark, d):
    """Default descriptor encoder over the rendered images (rows-only;
    unit norm and determinism are tested)."""
    f = IP.extract_features(_images(spark, d), "object_id", input_size=32, foreground_crop=True,
                            threshold=THRESHOLD, size_aware_canvas=True, canvas_size=16)
    return f.select("object_id", F.size("features").alias("dims"))


CROP_SQL = BBOX_SQL.replace(
    "select cast(e.vec_id as varchar) as object_id, cast(ok.x0 as int) as x0, cast(ok.y0 as int) as y0,\n"
    "  cast(ok.x1 + 1 as int) as x1, cast(ok.y1 + 1 as int) as y1",
    "select cast(e.vec_id as varchar) as object_id, cast(coalesce(ok.y1 + 1 - ok.y0, 8) as int) as height,\n"
    "  cast(coalesce(ok.x1 + 1 - ok.x0, 8) as int) as width")


@register("foreground_crop", CROP_SQL)
def q_foreground_crop(spark, d):
    return IP.prepared_shapes(_images(spark, d), "object_id", True, THRESHOLD, 8)


@register("size_canvas", f"""select object_id, greatest(6, height, width) as height, greatest(6, height, width) as width
from ({CROP_SQL}) c""")
def q_size_canvas(spark, d):
    return IP.prepared_shapes(_images(spark, d), "object_id", True, THRESHOLD, 8, True, 6)


@register("inference_transform")
def q_inference_transform(spark, d):
    """Tensor shape and mean per rendered image (rows-only)."""
    return IP.transformed_stats(_images(spark, d), "object_id", 16)


@register("bundle_export")
def q_bundle_export(spark, d):
    """ZIP bundles of the rendered images, split living / non-living, 20 KB
    per part (rows-only; ZIP contents are re-read in tests)."""
    from marisnow.operators.bundles import bundle_export
    from marisnow.operators.export import build_export_table
    from marisnow.sources.images import read_image_bytes
    idx, out = materialize_embedding_images(spark, d)
    e = load(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("object_id"), "label")
    parts = idx.join(e, "object_id").select(
        "object_id", F.col("image_path").alias("full_path"),
        F.when(F.col("label") % 2 == 1, "non_living").otherwise("copepod").alias("top1"),
        F.col("label").cast("double").alias("esd"))
    et = build_export_table(parts, keep_source=True)
    res = bundle_export(et, read_image_bytes(spark, out), scratch_path(spark, "zips"), max_mb=20 / 1024,
                        split_mode="living_non_living")
    return res.select("group", "part", "rows", "images")
