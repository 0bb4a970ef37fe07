"""What can be measured on a page: edges, lines and their angle, the turn of a table, paddings; and denoising by like patches. Numpy kernels."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from quillgrid.functions import imaging as I

#: Votes counted at once: edge pixels times angles.
VOTES_AT_ONCE = 1 << 22
#: Pixels whose patches are compared at once.
ROWS_AT_ONCE = 1 << 20


def sobel(img: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Derivatives along x and y over 3 x 3 neighbourhoods, edges repeated."""
    p = np.pad(img.astype(np.int32), 1, mode="edge")
    across, down = p[:, 2:] - p[:, :-2], p[2:] - p[:-2]
    return across[:-2] + 2 * across[1:-1] + across[2:], down[:, :-2] + 2 * down[:, 1:-1] + down[:, 2:]


def canny(img: np.ndarray, low: int = 30, high: int = 100) -> np.ndarray:
    """Edges: pixels whose gradient is greatest along its direction (in steps of 45 degrees), above `high`, or above `low` and joined to one above `high`.

    The gradient's size is |dx| + |dy|; of several channels the one with the greatest counts.
    """
    parts = [sobel(img)] if img.ndim == 2 else [sobel(img[..., c]) for c in range(img.shape[2])]
    sizes = np.stack([np.abs(x) + np.abs(y) for x, y in parts])
    best = sizes.argmax(0)[None]
    pick = lambda k: np.take_along_axis(np.stack([p[k] for p in parts]), best, 0)[0]
    dx, dy, size = pick(0), pick(1), sizes.max(0)
    m = np.pad(size, 1)
    near = lambda y, x: m[1 + y : m.shape[0] - 1 + y, 1 + x : m.shape[1] - 1 + x]
    ax, ay = np.abs(dx), np.abs(dy)
    flat, steep = ay < ax * np.tan(np.pi / 8), ay > ax * np.tan(3 * np.pi / 8)
    falling = (dx < 0) != (dy < 0)
    ridge = np.where(flat, (size > near(0, -1)) & (size >= near(0, 1)), np.where(steep, (size > near(-1, 0)) & (size >= near(1, 0)), False))
    ridge |= ~flat & ~steep & np.where(falling, (size > near(-1, 1)) & (size > near(1, -1)), (size > near(-1, -1)) & (size > near(1, 1)))
    weak = np.pad(ridge & (size > low), 1)
    edges = np.pad(ridge & (size > high), 1)
    front = np.flatnonzero(edges)
    w = edges.shape[1]
    around = np.array([-w - 1, -w, -w + 1, -1, 1, w - 1, w, w + 1])
    flat_edges, flat_weak = edges.ravel(), weak.ravel()
    while front.size:
        front = np.unique((front[:, None] + around).ravel())
        front = front[flat_weak[front] & ~flat_edges[front]]
        flat_edges[front] = True
    return (edges[1:-1, 1:-1] * 255).astype(np.uint8)


def hough_votes(edges: np.ndarray, step: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """(votes by angle and distance, the angles in degrees): each edge pixel votes for the lines x cos(a) + y sin(a) = r through it, r rounded."""
    h, w = edges.shape
    angles = np.arange(round(180 / step)) * step
    cos, sin = np.cos(np.deg2rad(angles)), np.sin(np.deg2rad(angles))
    reach = (w + h) + 1
    ys, xs = np.nonzero(edges)
    width = 2 * reach + 1
    votes = np.zeros(angles.size * width, np.int64)
    base = np.arange(angles.size) * width + reach
    some = max(1, VOTES_AT_ONCE // angles.size)
    for at in range(0, xs.size, some):
        r = np.rint(xs[at : at + some, None] * cos + ys[at : at + some, None] * sin).astype(np.int64)
        votes += np.bincount((r + base).ravel(), minlength=votes.size)
    return votes.reshape(angles.size, width), angles


def hough_lines(edges: np.ndarray, least: int = 150, step: float = 1.0) -> list[tuple[float, float, int]]:
    """(distance, angle in degrees, votes) of lines with more than `least` votes that no neighbour in angle or distance beats; most votes first."""
    votes, angles = hough_votes(edges, step)
    p = np.pad(votes, 1)
    peak = (votes > least) & (votes > p[1:-1, :-2]) & (votes >= p[1:-1, 2:]) & (votes > p[:-2, 1:-1]) & (votes >= p[2:, 1:-1])
    a, r = np.nonzero(peak)
    order = np.argsort(-votes[a, r], kind="stable")
    return [(float(r[i] - votes.shape[1] // 2), float(angles[a[i]]), int(votes[a[i], r[i]])) for i in order]


def dominant_angle(angles: Sequence[float], tolerance: float) -> float:
    """The commonest angle when rounded to the tolerance (half to even); of equally common ones the first."""
    return Counter(round(a / tolerance) * tolerance for a in angles).most_common(1)[0][0]


def turn_to_axis(angle: float) -> float:
    """The least turn (counter-clockwise) that brings a line with this normal angle (0 to 180, y downwards) upright or level."""
    return angle - min((90.0, 0.0, 180.0), key=lambda c: abs(angle - c))


def fitted_angle(edges: np.ndarray, lines: Sequence[tuple[float, float]], near: float = 1.5, rounds: int = 2) -> float:
    """The normal angle (degrees, 0 to 180) that fits the edge pixels within `near` of parallel lines (distance, angle in degrees) best: least squares over
    all of them together, each about its own middle. Votes alone tell angles apart only to about a pixel over a line's length."""
    ys, xs = np.nonzero(edges)
    lines = list(lines)
    for _ in range(rounds):
        sxx = syy = sxy = 0.0
        middles = []
        for r, a in lines:
            a = np.deg2rad(a)
            mine = np.abs(xs * np.cos(a) + ys * np.sin(a) - r) <= near
            if mine.sum() < 2:
                continue
            x, y = xs[mine], ys[mine]
            middles.append((x.mean(), y.mean()))
            x, y = x - x.mean(), y - y.mean()
            sxx, syy, sxy = sxx + (x * x).sum(), syy + (y * y).sum(), sxy + (x * y).sum()
        if not middles:
            break
        angle = float((np.rad2deg(np.arctan2(2 * sxy, sxx - syy) / 2) + 90) % 180)
        cos, sin = np.cos(np.deg2rad(angle)), np.sin(np.deg2rad(angle))
        lines = [(x * cos + y * sin, angle) for x, y in middles]
    return lines[0][1]


def line_skew(img: np.ndarray, iterations: int = 3, least: int = 150, step: float = 1.0, share: float | None = 0.2) -> float:
    """The sum of turns that straighten the commonest line, measured again after each turn with half the tolerance.

    Strokes shorter than `share` of the page's shorter side along an axis are left out first; without a share, nothing is. No line found: no further turn.
    """
    total, tolerance = 0.0, 2 * step
    kernel = int(min(img.shape[:2]) * share) if share else 0
    for _ in range(iterations):
        ink = I.threshold(img, I.otsu(img), inverse=True)
        if kernel > 1:
            ink = np.minimum(I.opening(ink, 1, kernel).astype(int) + I.opening(ink, kernel, 1), 255).astype(np.uint8)
        found = [a for _, a, _ in hough_lines(canny(255 - ink, 50, 150), least, step)]
        if not found:
            break
        turn = turn_to_axis(dominant_angle(found, tolerance))
        tolerance /= 2
        if not turn:
            break
        total += turn
        img = I.rotate(img, turn)
    return total


def outer_hull(mask: np.ndarray) -> np.ndarray:
    """Corners (x, y), in order, of the convex hull of the component whose box is largest; empty without ink."""
    found = I.components(mask, corners=True)
    if not found:
        return np.empty((0, 2), np.int64)
    x, y, w, h, _ = max(found, key=lambda c: c[2] * c[3])
    part = component_at(mask[y : y + h, x : x + w] > 0, (w, h))
    # the first and last pixel of each row hold all corners
    rows = np.nonzero(part.any(1))[0]
    points = np.unique(np.concatenate([np.stack([part[rows].argmax(1), rows], 1), np.stack([part.shape[1] - 1 - part[rows][:, ::-1].argmax(1), rows], 1)]), axis=0)

    def chain(points):
        out = []
        for p in points:
            while len(out) > 1 and (out[-1][0] - out[-2][0]) * (p[1] - out[-2][1]) - (out[-1][1] - out[-2][1]) * (p[0] - out[-2][0]) <= 0:
                out.pop()
            out.append(p)
        return out[:-1]

    points = points.tolist()
    corners = chain(points) + chain(points[::-1]) if len(points) > 1 else points
    return np.array(corners, np.int64) + (x, y)


def component_at(mask: np.ndarray, size: tuple[int, int]) -> np.ndarray:
    """The 8-connected component of a box that fills the box, without what else is in it."""
    want, left = size, mask.copy()
    while left.any():
        seed = np.zeros_like(left)
        seed.ravel()[np.flatnonzero(left)[0]] = True
        front = np.flatnonzero(seed)
        p, w = np.pad(left, 1), left.shape[1] + 2
        flat = p.ravel()
        own = np.zeros(flat.size, bool)
        front = (front // left.shape[1] + 1) * w + front % left.shape[1] + 1
        around = np.array([-w - 1, -w, -w + 1, -1, 1, w - 1, w, w + 1])
        own[front] = True
        while front.size:
            front = np.unique((front[:, None] + around).ravel())
            front = front[flat[front] & ~own[front]]
            own[front] = True
        found = own.reshape(p.shape)[1:-1, 1:-1]
        ys, xs = np.nonzero(found.any(1))[0], np.nonzero(found.any(0))[0]
        if (xs[-1] - xs[0] + 1, ys[-1] - ys[0] + 1) == tuple(want):
            return found
        left &= ~found
    return mask


def smallest_rectangle(hull: np.ndarray) -> tuple[float, float, float]:
    """(area, angle of its flattest side in degrees above -45 up to 45, share of it that the hull fills) of the smallest rectangle around a hull: one side lies on a side of it."""
    if len(hull) < 3:
        return 0.0, 0.0, 0.0
    sides = np.roll(hull, -1, 0) - hull
    angle = np.arctan2(sides[:, 1], sides[:, 0])
    u, v = np.stack([np.cos(angle), np.sin(angle)], 1), np.stack([-np.sin(angle), np.cos(angle)], 1)
    along, away = u @ hull.T, v @ hull.T
    areas = np.ptp(along, axis=1) * np.ptp(away, axis=1)
    best = int(areas.argmin())
    x, y = hull[:, 0], hull[:, 1]
    own = abs(float((x * np.roll(y, -1) - y * np.roll(x, -1)).sum())) / 2
    degrees = float(np.rad2deg(angle[best]) % 90)
    return float(areas[best]), degrees - 90 if degrees > 45 else degrees, own / float(areas[best]) if areas[best] else 0.0


def table_skew(img: np.ndarray, iterations: int = 3, least: float = 0.1, filled: float = 0.9) -> float:
    """The sum of turns that straighten the largest outline, measured again after each turn until it is below `least` degrees.

    An outline that fills less than `filled` of the smallest rectangle around it has no four corners: no turn. A side that falls to the right by some degrees asks for a
    turn counter-clockwise by as many.
    """
    total = 0.0
    for _ in range(iterations):
        _, angle, share = smallest_rectangle(outer_hull(I.threshold(img, I.otsu(img), inverse=True)))
        if share < filled or abs(angle) < least:
            break
        total += angle
        img = I.rotate(img, angle)
    return total


def long_lines(img: np.ndarray, line_ratios: Sequence[float] = (0.05, 0.05)) -> np.ndarray:
    """Mask of strokes at least so long, by shares of width and height, of the ink widened by one pixel."""
    ink = I.dilate(I.threshold(img, I.otsu(img), inverse=True))
    h, w = ink.shape
    found = np.zeros_like(ink)
    for kh, kw in ((1, int(w * line_ratios[0])), (int(h * line_ratios[1]), 1)):
        if max(kh, kw) >= 2:
            found |= I.dilate(I.dilate(I.erode(I.erode(ink, kh, kw), kh, kw), kh, kw), kh, kw)
    return found


def paddings(img: np.ndarray, line_ratios: Sequence[float] = (0.05, 0.05)) -> tuple[float, float, float, float]:
    """Space above, below, left and right of the long lines, as shares of their extent, to 4 places. Without a line the extent is the page and a pixel more."""
    h, w = img.shape[:2]
    ys, xs = np.nonzero(long_lines(img, line_ratios))
    y0, y1, x0, x1 = (int(ys.min()), int(ys.max()), int(xs.min()), int(xs.max())) if ys.size else (0, h, 0, w)
    tall, wide = y1 + 1 - y0, x1 + 1 - x0
    return round(y0 / tall, 4), round((h - y1 - 1) / tall, 4), round(x0 / wide, 4), round((w - x1 - 1) / wide, 4)


def run_score(ink: np.ndarray, lengths: Sequence[int]) -> int:
    """For each length, along rows and along columns, the places where so many neighbours are all ink (outside the page counts as ink): what erosions by those
    strokes would leave, from one pass over the runs."""
    total = 0
    for lines in (ink, ink.T):
        for n in lengths:
            if n < 1:
                continue
            p = np.pad(lines, ((0, 0), (n // 2, n - 1 - n // 2)), constant_values=True)
            edge = np.diff(np.pad(p, ((0, 0), (1, 1))).astype(np.int8), axis=1)
            size = np.nonzero(edge == -1)[1] - np.nonzero(edge == 1)[1]
            total += int(np.maximum(size - n + 1, 0).sum())
    return total


def stroke_skew(img: np.ndarray, delta: float = 0.25, limit: float = 5, iterations: int = 3) -> float:
    """The sum of turns with the most long strokes along the axes; of equal ones the first. A score up to 0.05 of the width times 0.05 of the height counts as none."""
    total = 0.0
    for _ in range(iterations):
        dark = I.erode(img) if img.ndim == 2 else np.stack([I.erode(img[..., c]) for c in range(img.shape[2])], -1)
        h, w = img.shape[:2]
        lengths = (int(min(w, h) * 0.1), int(min(w, h) * 0.4))
        best, angle = -1, 0.0
        for a in np.arange(-limit, limit + delta, delta):
            g = I.gray(I.rotate(dark, float(a)))
            score = run_score(g <= I.otsu(g), lengths)
            if score > best:
                best, angle = score, float(a)
        if best <= w * 0.05 * h * 0.05 or angle == 0:
            break
        total += angle
        img = I.rotate(img, angle)
    return total


def like_patches(img: np.ndarray, strength: float = 3, patch: int = 7, search: int = 21, least: float = 0.001) -> np.ndarray:
    """Each pixel as the mean of those in the search window, weighed by exp(-d / strength^2), d the mean squared difference of the patches around both.

    Weights below `least` are none. Beyond the page it is mirrored. All channels count together. Blocks of rows bound the memory; differences of a shift are
    summed once for all patches.
    """
    x = img.astype(np.float64).reshape(*img.shape[:2], -1)
    h, w, c = x.shape
    reach, half = search // 2, patch // 2
    out = np.empty_like(x)
    rows = max(1, ROWS_AT_ONCE // ((w + 2 * (reach + half)) * c))
    p = np.pad(x, ((reach + half,) * 2, (reach + half,) * 2, (0, 0)), mode="reflect") if min(h, w) > reach + half else np.pad(x, ((reach + half,) * 2, (reach + half,) * 2, (0, 0)), mode="symmetric")
    for at in range(0, h, rows):
        n = min(rows, h - at)
        own = p[at + reach : at + reach + n + 2 * half, reach : reach + w + 2 * half]
        weights, sums = np.zeros((n, w)), np.zeros((n, w, c))
        for dy in range(search):
            for dx in range(search):
                other = p[at + dy : at + dy + n + 2 * half, dx : dx + w + 2 * half]
                d = ((own - other) ** 2).sum(2) / c
                s = np.pad(d.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
                mean = (s[patch:, patch:] - s[:-patch, patch:] - s[patch:, :-patch] + s[:-patch, :-patch]) / (patch * patch)
                weight = np.exp(-np.maximum(mean, 0) / strength**2)
                weight[weight < least] = 0
                weights += weight
                sums += weight[..., None] * other[half : half + n, half : half + w]
        out[at : at + n] = sums / weights[..., None]
    return np.clip(np.rint(out), 0, 255).astype(np.uint8).reshape(img.shape)


#: Steps that measure: they give numbers under a key, and the page turned by what was measured.
MEASURES = {
    "calc_angle_set1": table_skew, "calc_angle_set2": stroke_skew, "calc_angle_set3": line_skew,
    "calc_angle_set4": lambda img, delta=0.25, limit=5, iterations=1: I.skew(img, limit, delta),
}


def skews(pages: DataFrame, keep: Sequence[str], least: int = 150, step: float = 0.25) -> DataFrame:
    """keep and turn: what straightens the commonest lines of each page row (columns of imaging.IMAGE), found from edges and votes at steps of `step` degrees, then
    fitted to the edges along them; null without a line."""
    schema = ", ".join([*(f"`{k}` {pages.schema[k].dataType.simpleString()}" for k in keep), "turn double"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            turns = []
            for h, w, c, data in zip(b["height"], b["width"], b["channels"], b["data"]):
                edges = canny(I.to_array(h, w, c, data), 50, 150)
                found = [(r, a) for r, a, _ in hough_lines(edges, least, step)]
                if not found:
                    turns.append(None)
                    continue
                common = dominant_angle([a for _, a in found], step)
                turns.append(turn_to_axis(fitted_angle(edges, [(r, a) for r, a in found if round(a / step) * step == common])))
            yield b[list(keep)].assign(turn=pd.Series(turns, index=b.index, dtype="float64"))

    return pages.select(*keep, "height", "width", "channels", "data").mapInPandas(run, schema)
