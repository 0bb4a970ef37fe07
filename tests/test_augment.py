"""Seeded variations: the same pixels whatever the partitioning, and plain versions of each step."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgrid.functions import augment as A
from quillgrid.functions import imaging as I


def page(channels=1, h=18, w=24):
    rng = np.random.default_rng(4)
    img = rng.integers(0, 256, (h, w, 3)).astype(np.uint8)
    return img[..., 0] if channels == 1 else img


def test_numbers_depend_on_their_place_only():
    u = A.uniform(1, 2, 3, 4, 1000)
    assert (u[:10] == A.uniform(1, 2, 3, 4, 10)).all() and 0 <= u.min() and u.max() < 1 and abs(u.mean() - 0.5) < 0.05
    assert len({float(A.uniform(*k)[0]) for k in ((1, 2, 3, 4), (2, 1, 3, 4), (1, 3, 2, 4), (1, 2, 4, 3), (-1, 2, 3, 4))}) == 5
    n = A.normal(1, 2, 3, 4, 4000)
    assert abs(n.mean()) < 0.1 and abs(n.std() - 1) < 0.1


@pytest.mark.parametrize("channels", [1, 3])
def test_warp_against_a_plain_loop(channels):
    img = page(channels)
    m = A.turn_and_shift(img.shape, 4.0, 2, -1)
    h, w = img.shape[:2]
    pixel = lambda y, x: img[y, x].astype(float) if 0 <= y < h and 0 <= x < w else np.full(img.shape[2:], 255.0)
    want = np.empty(img.shape)
    for y in range(h):
        for x in range(w):
            sx, sy = m @ (x, y, 1)
            x0, y0 = int(np.floor(sx)), int(np.floor(sy))
            fx, fy = sx - x0, sy - y0
            want[y, x] = (pixel(y0, x0) * (1 - fx) + pixel(y0, x0 + 1) * fx) * (1 - fy) + (pixel(y0 + 1, x0) * (1 - fx) + pixel(y0 + 1, x0 + 1) * fx) * fy
    assert np.allclose(A.affine(img, m), want)
    assert np.allclose(A.affine(img, A.turn_and_shift(img.shape, 0, 0, 0)), img)
    moved = A.affine(img, A.turn_and_shift(img.shape, 0, 3, 2))
    assert np.allclose(moved[2:, 3:], img[:-2, :-3]) and (moved[:2] == 255).all()


def test_blur_and_sharpen():
    img = page().astype(float)
    k = np.exp(-0.5 * (np.arange(-2, 3) / 0.6) ** 2)
    k /= k.sum()
    p = np.pad(img, 2, mode="edge")
    want = np.array([[(p[y : y + 5, x : x + 5] * np.outer(k, k)).sum() for x in range(img.shape[1])] for y in range(img.shape[0])])
    assert np.allclose(A.blur(img, 0.6), want)
    d = img - want
    assert np.allclose(A.sharpen(img, 0.6, 150, 3), np.clip(img + np.where(abs(d) >= 3, 1.5 * d, 0), 0, 255))


def test_colours():
    img = page(3).astype(float)
    assert np.allclose(A.colours(img, 1, 1, 1, 0), img) and np.allclose(A.colours(img, 1, 1, 1, 1 / 3)[..., [1, 2, 0]], img) or np.allclose(A.colours(img, 1, 1, 1, 1 / 3)[..., [2, 0, 1]], img)
    grey = A.colours(img, 1, 1, 0, 0)
    assert np.allclose(grey[..., 0], grey[..., 2]) and np.allclose(A.colours(img, 1, 0, 1, 0), (img @ I.LUMA).mean())


def test_copies(spark):
    n = spark.createDataFrame([(250,), (200,), (150,), (60,), (1,)], "n int")
    assert [r[0] for r in n.select(A.copies_needed(F.col("n"), 200, F.lit(3))).collect()] == [1, 1, 1, 3, 3]


def test_the_same_pixels_in_any_partitioning(spark):
    rows = [(f"img{i}", i % 2 == 0, 18, 24, 3 if i % 3 else 1, bytearray(np.roll(page(3 if i % 3 else 1), i).tobytes())) for i in range(7)]
    df = spark.createDataFrame(rows, f"path string, y boolean, {I.IMAGE}")
    one = A.augment(df.coalesce(1), "path", "y", 9, {True: 9, False: 2}).collect()
    two = A.augment(df.repartition(5), "path", "y", 9, {True: 9, False: 2}).collect()
    key = lambda r: (r["path"], r["copy"])
    assert sorted(map(tuple, one), key=lambda r: (r[0], r[2])) == sorted(map(tuple, two), key=lambda r: (r[0], r[2]))
    assert sorted(map(key, one)) == sorted((f"img{i}", c) for i in range(7) for c in range(2))  # four true images: 9 // 4; three false: 2 at most
    got = {key(r): r for r in one}
    assert all(bytes(got[r[0], 0]["data"]) == bytes(r[5]) and bytes(got[r[0], 1]["data"]) != bytes(r[5]) for r in rows)
    assert A.augment(df, "path", "y", policy="skip").count() == 0
    have = spark.createDataFrame([(True, 200), (False, 3)], "y boolean, n int")
    assert {r["y"] for r in A.augment(df, "path", "y", have=have).collect()} == {False}
    with pytest.raises(ValueError, match="unknown policy"):
        A.augment(df, "path", "y", policy="x")
