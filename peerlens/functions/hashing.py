"""Content hashes and perceptual hashes."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def content_key(text: Column) -> Column:
    """A stored hash in lower case without surrounding white space."""
    return F.lower(F.regexp_replace(text, r"^\s+|\s+$", ""))


def content_hash(content: Column) -> Column:
    """SHA-256 of bytes, in hex."""
    return F.sha2(content, 256)


def longs(bits: Column) -> list[Column]:
    """32 bytes as four signed 64-bit numbers."""
    return [F.conv(F.hex(F.substring(bits, 8 * i + 1, 8)), 16, -10).cast("long") for i in range(4)]


def hamming(a: Column, b: Column) -> Column:
    """Differing bits of two 32-byte hashes; null if either is null."""
    return sum((F.bit_count(x.bitwiseXOR(y)) for x, y in zip(longs(a), longs(b))), F.lit(0))


def resized(pixels: np.ndarray, height: int, width: int) -> np.ndarray:
    """A gray image at another size by area-weighted triangles, which is bilinear when enlarging."""
    def weights(old: int, new: int) -> np.ndarray:
        scale = max(1.0, old / new)
        centre = (np.arange(new) + 0.5) * old / new - 0.5
        w = np.maximum(0.0, 1 - np.abs(np.arange(old)[None, :] - centre[:, None]) / scale)
        return w / w.sum(1, keepdims=True)

    return weights(pixels.shape[0], height) @ pixels @ weights(pixels.shape[1], width).T


def gray(bgr: np.ndarray) -> np.ndarray:
    """Luma of an image in BGR order (rows, columns, 3), or of a gray one."""
    if bgr.shape[2] == 1:
        return bgr[:, :, 0].astype(np.float64)
    return bgr[:, :, :3].astype(np.float64) @ np.array([0.114, 0.587, 0.299])


def turned(pixels: np.ndarray, orientation: int) -> np.ndarray:
    """The image as it is to be seen: mirrored and transposed as its orientation (1 to 8) says."""
    if orientation >= 5:
        pixels = pixels.T
    if orientation in (3, 4, 7, 8):
        pixels = pixels[::-1]
    return pixels[:, ::-1] if orientation in (2, 3, 6, 7) else pixels


def dhash(pixels: np.ndarray, size: int = 16, orientation: int = 1) -> bytes:
    """Whether each pixel is brighter than its left neighbour, of the turned image at (size + 1) x size; row by row, high bit first."""
    shape = (size + 1, size) if orientation >= 5 else (size, size + 1)
    small = turned(np.rint(resized(pixels, *shape)), orientation)
    return np.packbits(small[:, 1:] > small[:, :-1]).tobytes()


def phash(pixels: np.ndarray, orientation: int = 1) -> np.ndarray:
    """64 values of ±1/8: whether each low-frequency cosine coefficient of the 32 x 32 image is above their median.

    The cosine of two such vectors is 1 - 2 * (differing bits) / 64.
    """
    n = 32
    k = np.arange(n)
    basis = np.sqrt(np.where(k == 0, 1, 2) / n)[:, None] * np.cos(np.pi * (2 * k[None, :] + 1) * k[:, None] / (2 * n))
    low = (basis @ turned(resized(pixels, n, n), orientation) @ basis.T)[:8, :8].ravel()
    return np.where(low > np.median(low), 0.125, -0.125)
