"""Foreground boxes drawn by mask pictures that a mask folder holds."""

from __future__ import annotations

import numpy as np

from marisnow.operators import imageprep as IP
from marisnow.sources import listing as LS
from marisnow.sources.images import png_bytes, read_images


def test_masks_from_a_folder(spark, tmp_path):
    (tmp_path / "crops").mkdir()
    (tmp_path / "masks").mkdir()
    dark = np.full((40, 60, 3), 255, np.uint8)
    dark[30:36, 40:50] = 0  # what the threshold sees
    for name in ("a", "b", "c"):
        (tmp_path / "crops" / f"{name}.png").write_bytes(png_bytes(dark))
    mask = np.zeros((40, 60, 3), np.uint8)
    mask[5:15, 10:30] = 1
    (tmp_path / "masks" / "a_m.png").write_bytes(png_bytes(mask))
    (tmp_path / "masks" / "b_m.png").write_bytes(b"no picture")
    files = LS.file_listing(spark, str(tmp_path))
    images = read_images(spark, str(tmp_path / "crops")).selectExpr("image_path", "image", "regexp_extract(image_path, '([^/]*)[.]png$', 1) as object_id")
    images = LS.resolve_mask_path(images, files, str(tmp_path / "masks"), suffix="_m")
    masked = IP.with_masks(images, read_images(spark, str(tmp_path / "masks")))
    box = {r.object_id: (r.x0, r.y0, r.x1, r.y1) for r in IP.bbox_column(masked).collect()}
    assert box == {"a": (8, 3, 32, 17), "b": (38, 28, 52, 38), "c": (38, 28, 52, 38)}
    size = {r.object_id: (r.height, r.width) for r in IP.prepared_shapes(masked).collect()}
    assert size == {"a": (14, 24), "b": (10, 14), "c": (10, 14)}
    plain = {r.object_id: (r.height, r.width) for r in IP.prepared_shapes(images).collect()}
    assert plain["a"] == (10, 14)
    vec = {r.object_id: r.features for r in IP.extract_features(masked, input_size=16, foreground_crop=True).collect()}
    assert vec["b"] == vec["c"] != vec["a"]
