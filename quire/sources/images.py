"""Decoding and encoding of image bytes without an image library: PNG and JPEG here, whole files by the JVM's reader."""

from __future__ import annotations

import struct
import zlib

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .jpeg import decode_jpeg, encode_jpeg

_MARK = b"\x89PNG\r\n\x1a\n"


def decode_png(data: bytes, alpha: bool = False) -> np.ndarray:
    """A PNG that is not interlaced as (height, width) or (height, width, 3); with ``alpha`` also (.., 2) and (.., 4)."""
    if data[:8] != _MARK:
        raise ValueError("not a PNG")
    width, height, depth, kind, _, _, lace = struct.unpack(">IIBBBBB", data[16:29])
    if lace:
        raise ValueError("interlaced")
    at, body, palette = 8, b"", None
    while at < len(data):
        n, name = struct.unpack(">I4s", data[at : at + 8])
        if name == b"IDAT":
            body += data[at + 8 : at + 8 + n]
        elif name == b"PLTE":
            palette = np.frombuffer(data[at + 8 : at + 8 + n], np.uint8).reshape(-1, 3)
        at += 12 + n
    c = {0: 1, 2: 3, 3: 1, 4: 2, 6: 4}[kind]
    size, step = (width * c * depth + 7) // 8, max(1, c * depth // 8)
    raw = np.frombuffer(zlib.decompress(body), np.uint8).reshape(height, 1 + size)
    out = np.zeros((height, size), np.uint8)
    up = np.zeros(size, np.int64)
    for y in range(height):
        f, line = raw[y, 0], raw[y, 1:].astype(np.int64)
        if f == 2:
            line = (line + up) & 255
        elif f == 1:
            pad = np.pad(line, (0, -len(line) % step)).reshape(-1, step)
            line = (np.cumsum(pad, 0) & 255).ravel()[: len(line)]
        elif f in (3, 4):
            line, above = line.tolist(), up.tolist()
            for i in range(len(line)):
                a, b, d = (line[i - step] if i >= step else 0), above[i], (above[i - step] if i >= step else 0)
                p = a + b - d
                near = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - d), 2, d))[2]
                line[i] = (line[i] + ((a + b) // 2 if f == 3 else near)) & 255
            line = np.array(line)
        out[y], up = line, line
    if depth < 8:
        shifts = np.arange(8 - depth, -1, -depth)
        px = (out[:, :, None] >> shifts & ((1 << depth) - 1)).reshape(height, -1)[:, :width, None]
        if kind != 3:
            px = px * (255 // ((1 << depth) - 1))
    else:
        px = out.reshape(height, width, c, depth // 8)[..., 0]
    px = px.astype(np.uint8)
    if kind == 3:
        return palette[px[..., 0]]
    if c == 1:
        return px[..., 0]
    if c in (2, 4) and not alpha:
        return px[..., 0] if c == 2 else px[..., :3]
    return px


def encode_png(px: np.ndarray) -> bytes:
    """(height, width) or with 2 (gray, alpha), 3 or 4 channels, 8 bits."""
    px = px[..., None] if px.ndim == 2 else px
    height, width, c = px.shape
    chunk = lambda name, body: struct.pack(">I", len(body)) + name + body + struct.pack(">I", zlib.crc32(name + body))
    lines = np.zeros((height, 1 + width * c), np.uint8)
    lines[:, 1:] = px.reshape(height, -1)
    head = struct.pack(">IIBBBBB", width, height, 8, {1: 0, 2: 4, 3: 2, 4: 6}[c], 0, 0, 0)
    return _MARK + chunk(b"IHDR", head) + chunk(b"IDAT", zlib.compress(lines.tobytes())) + chunk(b"IEND", b"")


def decode(data: bytes, alpha: bool = False) -> np.ndarray:
    """PNG or baseline JPEG; anything else raises, and is reported as ``decode_failed`` where it is used."""
    return decode_jpeg(data) if data[:2] == b"\xff\xd8" else decode_png(data, alpha)


def mode(data: bytes) -> str:
    """L, LA, RGB, RGBA or P, by the header."""
    if data[:8] == _MARK:
        return {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}[data[25]]
    return "P" if data[:4] == b"GIF8" else "RGB"


def jpeg_bytes(data: bytes, quality: int = 90) -> bytes:
    """An image's bytes as JPEG, transparency dropped."""
    return encode_jpeg(decode(data), quality)


def payload(data: bytes, limit: tuple[int, int] = (2048, 2048)) -> tuple[bytes, str]:
    """What a model is sent: shrunk to the limit, PNG if transparency or a palette is there, else JPEG; and its media type."""
    from ..operators.raster import resize

    px = decode(data, alpha=True)
    height, width = px.shape[:2]
    scale = min(1.0, limit[0] / width, limit[1] / height)
    if scale < 1:
        px = resize(px, max(1, int(width * scale + 0.5)), max(1, int(height * scale + 0.5)))  # as functions.text.thumbnail_size
    if mode(data) in ("RGBA", "LA", "P"):
        return encode_png(px), "image/png"
    return encode_jpeg(px, 85), "image/jpeg"


def read(spark: SparkSession, path: str) -> DataFrame:
    """Image files decoded by Spark's own source; invalid ones go. Its bytes are in blue, green, red order."""
    return spark.read.format("image").option("dropInvalid", True).load(path).select(F.col("image.origin").alias("path"), "image.width", "image.height", "image.nChannels", F.col("image.data").alias("bgr"))


def rgb(bgr: bytes, height: int, width: int, channels: int) -> np.ndarray:
    px = np.frombuffer(bgr, np.uint8).reshape(height, width, channels)
    return px[..., 0] if channels == 1 else px[..., 2::-1]
