"""Seeded variations of images, for training sets that are too small. Every random number is a function of (seed, image, copy, step, place): the same pixels come in any
partitioning, order or retry."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgrid.functions import imaging as I

#: Ranges of the variations: degrees, share of the size, blur radius, sharpening radius, percent and threshold, noise, brightness, contrast, saturation, hue. Fixed values.
DEGREES, SHIFT, BLUR, SHARPEN, NOISE, JITTER, HUE = 5.0, 0.02, (0.1, 1.0), ((1, 3), (120, 180), (1, 3)), 0.05, 0.2, 0.1
_MULTIPLY = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_GOLD = 0x9E3779B97F4A7C15
#: Numbers of the steps whose random numbers are drawn.
TURN, ACROSS, DOWN, RADIUS, SHARP, GRAIN, LIGHT, CONTRAST, COLOUR, TINT = range(10)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MULTIPLY[0]
    x = (x ^ (x >> np.uint64(27))) * _MULTIPLY[1]
    return x ^ (x >> np.uint64(31))


def uniform(seed: int, image: int, copy: int, step: int, n: int = 1) -> np.ndarray:
    """n numbers from 0 up to 1, by counters: the i-th depends on its place only."""
    with np.errstate(over="ignore"):
        key = np.uint64(0)
        for part in (seed, image, copy, step):
            key = _mix(key + np.uint64(_GOLD) + np.uint64(part & 0xFFFFFFFFFFFFFFFF))
        return (_mix(key + np.arange(n, dtype=np.uint64) * np.uint64(_GOLD)) >> np.uint64(11)) / float(1 << 53)


def normal(seed: int, image: int, copy: int, step: int, n: int) -> np.ndarray:
    """n standard normal numbers, from two uniform ones each."""
    u = uniform(seed, image, copy, step, 2 * n)
    return np.sqrt(-2 * np.log(1 - u[:n])) * np.cos(2 * np.pi * u[n:])


def affine(img: np.ndarray, matrix: np.ndarray, fill: int = I.WHITE) -> np.ndarray:
    """out[y, x] = img at matrix @ (x, y, 1), between pixels bilinear; beyond the image `fill`."""
    h, w = img.shape[:2]
    y, x = np.mgrid[:h, :w].astype(float)
    sx, sy = (matrix[k, 0] * x + matrix[k, 1] * y + matrix[k, 2] for k in (0, 1))
    x0, y0 = np.floor(sx).astype(int), np.floor(sy).astype(int)
    fx, fy = sx - x0, sy - y0
    if img.ndim == 3:
        fx, fy = fx[..., None], fy[..., None]
    padded = np.pad(img.astype(float), ((1, 1), (1, 1), *((0, 0),) * (img.ndim - 2)), constant_values=fill)
    at = lambda yy, xx: padded[np.clip(yy + 1, 0, h + 1), np.clip(xx + 1, 0, w + 1)]
    top, low = at(y0, x0) * (1 - fx) + at(y0, x0 + 1) * fx, at(y0 + 1, x0) * (1 - fx) + at(y0 + 1, x0 + 1) * fx
    return top * (1 - fy) + low * fy


def turn_and_shift(shape: Sequence[int], degrees: float, across: float, down: float) -> np.ndarray:
    """The matrix of affine() that turns about the middle and then moves by pixels."""
    h, w = shape[:2]
    a, cx, cy = np.deg2rad(degrees), (w - 1) / 2, (h - 1) / 2
    c, s = np.cos(a), np.sin(a)
    return np.array([[c, s, cx - c * (cx + across) - s * (cy + down)], [-s, c, cy + s * (cx + across) - c * (cy + down)]])


def blur(img: np.ndarray, radius: float) -> np.ndarray:
    """Gaussian, edges repeated; `radius` is the deviation."""
    reach = max(1, int(np.ceil(3 * radius)))
    k = np.exp(-0.5 * (np.arange(-reach, reach + 1) / radius) ** 2)
    k /= k.sum()
    out = img.astype(float)
    for axis in (0, 1):
        p = np.pad(out, [(reach, reach) if i == axis else (0, 0) for i in range(out.ndim)], mode="edge")
        n = out.shape[axis]
        out = sum(w * np.take(p, np.arange(i, i + n), axis) for i, w in enumerate(k))
    return out


def sharpen(img: np.ndarray, radius: float, percent: float, threshold: float) -> np.ndarray:
    """Adds `percent` of the difference to the blurred image, where it is at least `threshold`."""
    d = img - blur(img, radius)
    return np.clip(img + np.where(np.abs(d) >= threshold, d * percent / 100, 0), 0, 255)


def colours(img: np.ndarray, light: float, contrast: float, saturation: float, hue: float) -> np.ndarray:
    """Brightness, contrast about the mean grey, and (three channels, blue first) saturation and a turn of the hue, by factors; hue in turns."""
    x = np.clip(img * light, 0, 255)
    grey = x if x.ndim == 2 else x[..., :3] @ I.LUMA
    x = np.clip(grey.mean() + (x - grey.mean()) * contrast, 0, 255)
    if x.ndim == 2:
        return x
    grey = (x[..., :3] @ I.LUMA)[..., None]
    x = np.clip(grey + (x - grey) * saturation, 0, 255)
    # a turn about the grey axis
    a = 2 * np.pi * hue
    c, s = np.cos(a), np.sin(a) / np.sqrt(3)
    turn = c * np.eye(3) + (1 - c) / 3 + s * np.array([[0, -1, 1], [1, 0, -1], [-1, 1, 0]])
    return np.clip(x @ turn.T, 0, 255)


def variation(img: np.ndarray, seed: int, image: int, copy: int) -> np.ndarray:
    """The copy-th variation of an image (0: itself): doubled, turned and moved, blurred, sharpened, with noise and other colours, and brought back to size."""
    if copy == 0:
        return img
    h, w = img.shape[:2]
    draw = lambda step, low, high: low + (high - low) * float(uniform(seed, image, copy, step)[0])
    x = I.resize(img, w * 2, h * 2)
    x = affine(x, turn_and_shift(x.shape, draw(TURN, -DEGREES, DEGREES), round(draw(ACROSS, -SHIFT, SHIFT) * w * 2), round(draw(DOWN, -SHIFT, SHIFT) * h * 2)))
    x = blur(x, draw(RADIUS, *BLUR))
    u = uniform(seed, image, copy, SHARP, 3)
    x = sharpen(x, *(int(low + (high - low) * v) for (low, high), v in zip(SHARPEN, u)))
    x = np.clip(x + 255 * NOISE * normal(seed, image, copy, GRAIN, x.size).reshape(x.shape), 0, 255)
    x = colours(x, draw(LIGHT, 1 - JITTER, 1 + JITTER), draw(CONTRAST, 1 - JITTER, 1 + JITTER), draw(COLOUR, 1 - JITTER, 1 + JITTER), draw(TINT, -HUE, HUE))
    return I.resize(np.rint(x).astype(np.uint8), w, h)


def copies_needed(images: Column, wanted: int, most: Column) -> Column:
    """How many images to make of each (itself among them) when there are `images`: as many as it takes, `most` at most; one when there are enough."""
    return F.when(images >= wanted, 1).otherwise(F.greatest(F.lit(1), F.least(F.floor(F.lit(wanted) / images), most))).cast("int")


def augment(images: DataFrame, key: str, group: str, wanted: int = 200, most: dict | int = 3, seed: int = 123, policy: str = "default", have: DataFrame | None = None) -> DataFrame:
    """key, group, copy and the columns of imaging.IMAGE: each group's images and as many variations as bring it near `wanted`.

    most: copies of one image at most, or a map of them by group. policy `default`: only groups with fewer than `wanted` images in `have` (group, n) are done; `always`: all;
    `skip`: none. Variations are numbered rows before any pixel is touched, so a large group is many tasks.
    """
    if policy not in ("default", "always", "skip"):
        raise ValueError(f"unknown policy {policy}")
    counts = images.groupBy(group).agg(F.count("*").alias("_n"))
    if policy == "skip":
        counts = counts.where("false")
    elif policy == "default" and have is not None:
        counts = counts.join(have.where(F.col("n") >= wanted), group, "left_anti")
    limit = F.lit(most) if isinstance(most, int) else F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in most.items() for x in kv)), F.col(group)), F.lit(3))
    # one row per group
    todo = counts.withColumn("_copies", copies_needed(F.col("_n"), wanted, limit))
    rows = images.join(todo.select(group, "_copies"), group).withColumn("copy", F.explode(F.sequence(F.lit(0), F.greatest(F.col("_copies") - 1, F.lit(0)))))
    kinds = {k: images.schema[k].dataType.simpleString() for k in (key, group)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for k, g, c, *image in zip(b["_k"], b[group], b["copy"], b["height"], b["width"], b["channels"], b["data"]):
                img = variation(I.to_array(*image), seed, int(k), int(c))
                out.append((g, c, img.shape[0], img.shape[1], 1 if img.ndim == 2 else img.shape[2], img.tobytes()))
            made = pd.DataFrame(out, columns=[group, "copy", "height", "width", "channels", "data"])
            yield pd.concat([b[[key]].reset_index(drop=True), made], axis=1)

    numbered = rows.withColumn("_k", F.xxhash64(key)).select(key, "_k", group, "copy", "height", "width", "channels", "data")
    return numbered.mapInPandas(run, f"`{key}` {kinds[key]}, `{group}` {kinds[group]}, copy int, {I.IMAGE}")
