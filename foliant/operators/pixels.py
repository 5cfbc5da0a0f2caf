"""Grey-level arithmetic on decoded scans: contrast, denoising, sharpening, crops and column profiles.

Images are numpy arrays (rows, columns[, blue-green-red]) of bytes. Codecs are not part of this package:
``enhancer`` takes them, for ``foliant.sources.remote.converted``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.operators.profile import OVERLAP

#: Tiles a side and clip of the local contrast, width and spread of the denoising.
TILES, CLIP, REACH, SPREAD = 16, 1.5, 2, 50.0
# Weights of blue, green and red in a pixel's brightness; the sharpening kernel.
BRIGHTNESS = np.array([0.114, 0.587, 0.299])
SHARPEN = np.array([[0, -0.5, 0], [-0.5, 3, -0.5], [0, -0.5, 0]])


def grey(image: np.ndarray) -> np.ndarray:
    return image.copy() if image.ndim == 2 else np.rint(image[..., :3] @ BRIGHTNESS).astype(np.uint8)


def equalised(image: np.ndarray, tiles: int = TILES, clip: float = CLIP) -> np.ndarray:
    """Local contrast: each tile's clipped histogram equalised, tables blended between the four tiles around a pixel."""
    h, w = image.shape
    if not h or not w:
        return image.copy()
    th, tw = -(-h // tiles), -(-w // tiles)
    full = np.pad(image, ((0, th * tiles - h), (0, tw * tiles - w)), mode="edge")
    blocks = full.reshape(tiles, th, tiles, tw).transpose(0, 2, 1, 3).reshape(tiles * tiles, th * tw)
    counts = np.stack([np.bincount(b, minlength=256) for b in blocks]).astype(float)
    most = max(1.0, clip * th * tw / 256)
    excess = np.maximum(counts - most, 0).sum(1, keepdims=True)
    table = np.cumsum(np.minimum(counts, most) + excess / 256, axis=1) * 255 / (th * tw)
    table = table.reshape(tiles, tiles, 256)
    y, x = (np.arange(h) + 0.5) / th - 0.5, (np.arange(w) + 0.5) / tw - 0.5
    y0, x0 = np.clip(np.floor(y).astype(int), 0, tiles - 1), np.clip(np.floor(x).astype(int), 0, tiles - 1)
    y1, x1 = np.minimum(y0 + 1, tiles - 1), np.minimum(x0 + 1, tiles - 1)
    fy, fx = np.clip(y - y0, 0, 1)[:, None], np.clip(x - x0, 0, 1)[None, :]
    at = lambda a, b: table[a[:, None], b[None, :], image]
    top, low = at(y0, x0) * (1 - fx) + at(y0, x1) * fx, at(y1, x0) * (1 - fx) + at(y1, x1) * fx
    return np.clip(np.rint(top * (1 - fy) + low * fy), 0, 255).astype(np.uint8)


def smoothed(image: np.ndarray, reach: int = REACH, spread: float = SPREAD) -> np.ndarray:
    """Bilateral filter: neighbours within ``reach`` weigh by distance and by likeness, so that edges stay."""
    around = np.pad(image.astype(float), reach, mode="reflect" if min(image.shape) > reach else "edge")
    h, w = image.shape
    total, weight = np.zeros((h, w)), np.zeros((h, w))
    for dy in range(-reach, reach + 1):
        for dx in range(-reach, reach + 1):
            if dy * dy + dx * dx > reach * reach:
                continue
            part = around[reach + dy : reach + dy + h, reach + dx : reach + dx + w]
            k = np.exp(-(dy * dy + dx * dx) / (2 * spread**2) - (part - image) ** 2 / (2 * spread**2))
            total += k * part
            weight += k
    return np.rint(total / weight).astype(np.uint8) if h and w else image.copy()


def sharpened(image: np.ndarray) -> np.ndarray:
    around = np.pad(image.astype(float), 1, mode="reflect" if min(image.shape, default=0) > 1 else "edge")
    h, w = image.shape
    made = sum(SHARPEN[a, b] * around[a : a + h, b : b + w] for a in range(3) for b in range(3))
    return np.clip(np.rint(made), 0, 255).astype(np.uint8)


def enhanced(image: np.ndarray) -> np.ndarray:
    """A scan prepared for recognition: grey, locally equalised, denoised, slightly sharpened."""
    return sharpened(smoothed(equalised(grey(image))))


def halves_of(image: np.ndarray, split: int, overlap: int = OVERLAP) -> tuple[np.ndarray, np.ndarray]:
    """The left and right page of a scan, overlapping at the split."""
    return image[:, : split + overlap], image[:, max(0, split - overlap) :]


def enhancer(decode: Callable[[bytes], np.ndarray], encode: Callable[[np.ndarray], bytes]) -> Callable[[bytes], bytes]:
    """A filter for ``remote.converted``, with the codecs given."""
    return lambda content: encode(enhanced(decode(content)))


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def pixel_means(pixels: pd.Series, width: pd.Series) -> pd.Series:
    """Mean brightness of each column of grey images given as their bytes, row by row; null for none."""
    return pd.Series([None if b is None or not w or len(b) % int(w) else np.frombuffer(b, np.uint8).reshape(-1, int(w)).mean(0).tolist() if len(b) else None for b, w in zip(pixels, width, strict=True)], dtype=object)
