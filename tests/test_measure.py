"""Measuring pages, against plain loops and drawn angles."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillgrid.functions import imaging as I
from quillgrid.functions import measure as M


def drawn(angle, size=240, thick=1.5):
    """Lines that rise to the right by `angle` degrees, seen with y upwards."""
    y, x = np.mgrid[:size, :size] - size / 2
    a = np.deg2rad(angle)
    img = np.full((size, size), 255, np.uint8)
    away = x * np.sin(a) + y * np.cos(a)
    along = x * np.cos(a) - y * np.sin(a)
    for at in (-60, -15, 40):
        img[(np.abs(away - at) < thick) & (np.abs(along) < size * 0.42)] = 0
    return img


def tilted(angle, size=240, w=150, h=90):
    y, x = np.mgrid[:size, :size] - size / 2
    a = np.deg2rad(angle)
    along, away = x * np.cos(a) - y * np.sin(a), x * np.sin(a) + y * np.cos(a)
    img = np.full((size, size), 255, np.uint8)
    img[(np.abs(along) < w / 2) & (np.abs(away) < h / 2)] = 0
    return img


def plain_canny(img, low, high):
    h, w = img.shape
    p = np.pad(img.astype(int), 1, mode="edge")
    dx, dy = np.zeros((h, w), int), np.zeros((h, w), int)
    for i in range(h):
        for j in range(w):
            q = p[i : i + 3, j : j + 3]
            dx[i, j] = q[0, 2] + 2 * q[1, 2] + q[2, 2] - q[0, 0] - 2 * q[1, 0] - q[2, 0]
            dy[i, j] = q[2, 0] + 2 * q[2, 1] + q[2, 2] - q[0, 0] - 2 * q[0, 1] - q[0, 2]
    m = np.pad(abs(dx) + abs(dy), 1)
    mark = np.zeros((h, w), int)
    for i in range(h):
        for j in range(w):
            v, x, y = m[i + 1, j + 1], abs(dx[i, j]), abs(dy[i, j])
            if v <= low:
                continue
            if y < x * np.tan(np.pi / 8):
                top = v > m[i + 1, j] and v >= m[i + 1, j + 2]
            elif y > x * np.tan(3 * np.pi / 8):
                top = v > m[i, j + 1] and v >= m[i + 2, j + 1]
            else:
                s = -1 if (dx[i, j] < 0) != (dy[i, j] < 0) else 1
                top = v > m[i, j + 1 - s] and v > m[i + 2, j + 1 + s]
            mark[i, j] = (2 if v > high else 1) if top else 0
    todo = [tuple(t) for t in np.argwhere(mark == 2)]
    while todo:
        i, j = todo.pop()
        for y in range(max(i - 1, 0), min(i + 2, h)):
            for x in range(max(j - 1, 0), min(j + 2, w)):
                if mark[y, x] == 1:
                    mark[y, x] = 2
                    todo.append((y, x))
    return np.where(mark == 2, 255, 0).astype(np.uint8)


@pytest.mark.parametrize("seed", range(4))
def test_canny(seed):
    rng = np.random.default_rng(seed)
    img = I.resize(rng.integers(0, 256, (8, 9)).astype(np.uint8), 40, 33)
    assert (M.canny(img) == plain_canny(img, 30, 100)).all() and (M.canny(img, 100, 300) == plain_canny(img, 100, 300)).all()
    assert (M.canny(np.stack([img] * 3, -1)) == M.canny(img)).all() and not M.canny(np.full((5, 5), 9, np.uint8)).any()


def test_votes():
    rng = np.random.default_rng(1)
    edges = (rng.random((14, 17)) < 0.2).astype(np.uint8)
    votes, angles = M.hough_votes(edges, 3.0)
    want = np.zeros_like(votes)
    for y, x in np.argwhere(edges):
        for k, a in enumerate(np.deg2rad(angles)):
            want[k, int(np.rint(x * np.cos(a) + y * np.sin(a))) + votes.shape[1] // 2] += 1
    assert (votes == want).all()


@pytest.mark.parametrize("angle", [-40, -33.25, -10, -3.5, 0, 1.25, 7, 22.5, 40])
def test_angles_of_drawn_lines(angle):
    found = M.hough_lines(M.canny(drawn(angle), 50, 150), 100, 0.25)
    turn = M.turn_to_axis(M.dominant_angle([a for _, a, _ in found], 0.25))
    assert abs(turn + angle) <= 0.25, (turn, angle)  # lines that rise by an angle are straightened by turning clockwise


def test_dominant_angle():
    assert M.dominant_angle([89, 91, 90.4, 10], 2) == 88 and M.dominant_angle([10, 89.5, 90.4], 2) == 90 and M.dominant_angle([1, 5, 1, 5], 1) == 1
    assert M.turn_to_axis(93) == 3 and M.turn_to_axis(3) == 3 and M.turn_to_axis(178) == -2 and M.turn_to_axis(87) == -3
    assert M.line_skew(np.full((50, 50), 255, np.uint8)) == 0


def test_small_skews_are_straightened():
    for angle in (-3.0, -1.0, 2.0, 4.0):
        img = drawn(angle, thick=4)
        found = M.line_skew(img, share=0.1, least=100, step=0.5)
        assert abs(found + angle) <= 1 and abs(M.stroke_skew(img) + angle) <= 1 and abs(I.skew(img) + angle) <= 0.5
        assert abs(I.skew(I.rotate(img, found))) <= 1


@pytest.mark.parametrize("angle", [-40, -20.5, -5, 0, 3.25, 17, 40])
def test_turned_tables(angle):
    img = tilted(angle)
    img[2:6, 2:9] = 0  # a smaller thing
    _, found, share = M.smallest_rectangle(M.outer_hull(I.threshold(img, inverse=True)))
    assert abs(found + angle) <= 0.6 and share > 0.95
    assert abs(M.table_skew(img) + angle) <= 0.6


def test_things_without_four_corners_are_not_turned():
    y, x = np.mgrid[:100, :100] - 50
    round_thing = np.where(x**2 + y**2 < 900, 0, 255).astype(np.uint8)
    assert M.table_skew(round_thing) == 0 and M.table_skew(np.full((9, 9), 255, np.uint8)) == 0
    assert M.smallest_rectangle(np.array([[0, 0], [4, 0]])) == (0.0, 0.0, 0.0)


def test_hull_and_rectangle_against_all_directions():
    rng = np.random.default_rng(5)
    for _ in range(10):
        mask = np.zeros((40, 50), np.uint8)
        mask[rng.integers(0, 40, 60), rng.integers(0, 50, 60)] = 1
        mask = I.dilate(mask * 255, 9, 9)
        hull = M.outer_hull(mask)
        area = M.smallest_rectangle(hull)[0]
        for a in np.deg2rad(np.arange(0, 90, 0.5)):
            u = hull @ np.array([[np.cos(a), -np.sin(a)], [np.sin(a), np.cos(a)]])
            assert area <= np.prod(np.ptp(u, axis=0)) + 1e-6


def test_paddings():
    img = np.full((200, 300), 255, np.uint8)
    img[40:42, 60:240] = img[160:162, 60:240] = img[40:162, 60:62] = img[40:162, 238:240] = 0
    rows, cols = (39, 162), (59, 240)  # strokes are one pixel wider each way
    tall, wide = rows[1] + 1 - rows[0], cols[1] + 1 - cols[0]
    got = M.paddings(img)
    assert np.allclose(got, (rows[0] / tall, (200 - rows[1] - 1) / tall, cols[0] / wide, (300 - cols[1] - 1) / wide), atol=0.03) and all(round(g, 4) == g for g in got)
    assert M.paddings(np.full((20, 30), 255, np.uint8)) == (0.0, round(-1 / 21, 4), 0.0, round(-1 / 31, 4))


def eroded(ink, h, w):
    p = np.pad(ink, ((h // 2, h - 1 - h // 2), (w // 2, w - 1 - w // 2)), constant_values=True)
    return np.lib.stride_tricks.sliding_window_view(p, (h, w)).all(axis=(2, 3))


def test_run_scores_are_what_erosions_leave():
    rng = np.random.default_rng(2)
    for share in (0.5, 0.9):
        ink = rng.random((23, 31)) < share
        assert M.run_score(ink, (3, 8)) == sum(int(eroded(ink, n, 1).sum() + eroded(ink, 1, n).sum()) for n in (3, 8))


def test_search_for_long_strokes_equals_a_plain_one():
    for angle in (-3.0, -1.25, 0.0, 2.5, 4.75):
        img = drawn(angle, 120, 2)
        dark, scores = I.erode(img), []
        angles = np.arange(-5, 5.25, 0.25)
        for a in angles:
            g = I.rotate(dark, float(a))
            ink = g <= I.otsu(g)
            scores.append(sum(int(eroded(ink, n, 1).sum() + eroded(ink, 1, n).sum()) for n in (12, 48)))
        want = float(angles[int(np.argmax(scores))]) if max(scores) > 120 * 0.05 * 120 * 0.05 else 0.0
        assert M.stroke_skew(img, iterations=1) == want


def test_like_patches():
    rng = np.random.default_rng(3)
    for shape in ((12, 10), (9, 11, 3)):
        img = np.clip(np.round(128 + 20 * (np.mgrid[: shape[0], : shape[1]][1] > 4)[..., None] + rng.normal(0, 3, (*shape[:2], 3 if len(shape) == 3 else 1))), 0, 255).astype(np.uint8).reshape(shape)
        x = img.reshape(*shape[:2], -1).astype(float)
        half, reach = 1, 2
        p = np.pad(x, ((3, 3), (3, 3), (0, 0)), mode="reflect")
        want = np.empty_like(x)
        for i in range(shape[0]):
            for j in range(shape[1]):
                own, total, weights = p[i + 2 : i + 5, j + 2 : j + 5], 0, 0
                for dy in range(-reach, reach + 1):
                    for dx in range(-reach, reach + 1):
                        other = p[i + 2 + dy : i + 5 + dy, j + 2 + dx : j + 5 + dx]
                        w = np.exp(-((own - other) ** 2).mean() / 25)
                        w = 0 if w < 0.001 else w
                        weights, total = weights + w, total + w * p[i + 3 + dy, j + 3 + dx]
                want[i, j] = total / weights
        got = M.like_patches(img, 5, 3, 5)
        assert np.abs(got.reshape(x.shape) - want).max() <= 0.5 + 1e-9
        before = M.ROWS_AT_ONCE
        try:
            M.ROWS_AT_ONCE = 1
            assert (M.like_patches(img, 5, 3, 5) == got).all()
        finally:
            M.ROWS_AT_ONCE = before


def test_steps_that_measure(spark):
    img = drawn(2.0, 160, 3)
    df = spark.createDataFrame([(1, 160, 160, 1, bytearray(img.tobytes()))], f"id int, {I.IMAGE}")
    steps = [("denoising2", {}), ("calc_angle_set4", {"angle_key": "a", "iter_save": True}), ("calc_padding_set2", {}), ("canny", {})]
    r = I.apply_steps(df, steps, ["id"], measured=True).first()
    assert abs(abs(r["measured"]["angle_a"]) - 2) <= 0.5 and set(r["measured"]) == {"angle_a", "_pad_top", "_pad_bottom", "_pad_left", "_pad_right"}
    turned = I.apply_steps(df, [("calc_angle_set2", {"angle_key": "a"}), ("rotate", {"angle_keys": ["a", "none"]})], ["id"], measured=True).select("id", F.map_keys("measured").alias("k")).first()
    assert turned["k"] == ["angle_a"]
