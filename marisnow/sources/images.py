"""Image source: Spark's built-in ``image`` data source (decodes PNG/JPEG on
executors; undecodable files give height -1 with ``dropInvalid=false``) and
the ``binaryFile`` source for raw bytes (bundles).  Plus a tiny PNG encoder
(zlib only) used to materialise table-derived images."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

IMAGE_STRUCT = "origin string, height int, width int, nChannels int, mode int, data binary"


def read_images(spark: SparkSession, paths: str | Sequence[str], recursive: bool = False) -> DataFrame:
    """(image_path, image) for every file; failed decodes keep height -1."""
    r = spark.read.format("image").option("dropInvalid", "false")
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    df = r.load(paths if isinstance(paths, str) else list(paths))
    return df.select(F.regexp_replace("image.origin", r"^file:/*", "/").alias("image_path"), "image")


def read_image_bytes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    df = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return df.select(F.regexp_replace("path", r"^file:/*", "/").alias("path"), "length", "content")


def to_rgb(height: int, width: int, n_channels: int, data: bytes | None) -> np.ndarray:
    """Image-source struct -> uint8 RGB (H, W, 3).  The source stores BGR(A);
    an undecodable image (height -1) becomes a 64 x 64 black image."""
    if data is None or height is None or height <= 0 or width <= 0:
        return np.zeros((64, 64, 3), dtype=np.uint8)
    arr = np.frombuffer(bytes(data), dtype=np.uint8).reshape(height, width, n_channels)
    if n_channels == 1:
        return np.repeat(arr, 3, axis=2)
    return arr[:, :, [2, 1, 0]].copy()


def png_bytes(rgb: np.ndarray) -> bytes:
    """Minimal PNG (8-bit RGB, no filter) with stdlib zlib."""
    h, w, _ = rgb.shape
    raw = b"".join(b"\x00" + rgb[y].astype(np.uint8).tobytes() for y in range(h))

    def chunk(tag: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + tag + body + struct.pack(">I", zlib.crc32(tag + body) & 0xFFFFFFFF)
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(raw, 6)) + chunk(b"IEND", b""))
