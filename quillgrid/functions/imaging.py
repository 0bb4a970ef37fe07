"""Page images: numpy kernels, and their use on image columns by Arrow batches.

An image is a struct (height, width, channels, data). Kernels take and give arrays; what needs an outside engine (OCR, PDF rendering) is passed in.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from quillgrid.functions.params import typed

WHITE = 255
#: Luma weights for blue, green, red. Fixed values.
LUMA = np.array([0.114, 0.587, 0.299])


def gray(img: np.ndarray) -> np.ndarray:
    return img if img.ndim == 2 else np.rint(img[..., :3] @ LUMA).astype(np.uint8)


def threshold(img: np.ndarray, at: int = 127, inverse: bool = False) -> np.ndarray:
    return np.where((gray(img) > at) ^ inverse, 255, 0).astype(np.uint8)


def otsu(img: np.ndarray) -> int:
    """The level that splits the histogram with the largest variance between the sides."""
    h = np.bincount(gray(img).ravel(), minlength=256).astype(float)
    w, m = np.cumsum(h), np.cumsum(h * np.arange(256))
    with np.errstate(divide="ignore", invalid="ignore"):
        between = (m[-1] * w / w[-1] - m) ** 2 / (w * (w[-1] - w))
    return int(np.nanargmax(np.where(np.isfinite(between), between, -1)))


def box_mean(img: np.ndarray, k: int) -> np.ndarray:
    """Mean over k x k neighbourhoods, edges repeated."""
    p = np.pad(img.astype(float), k // 2, mode="edge")
    s = np.pad(p.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    return (s[k:, k:] - s[:-k, k:] - s[k:, :-k] + s[:-k, :-k])[: img.shape[0], : img.shape[1]] / (k * k)


def adaptive_threshold(img: np.ndarray, block: int = 11, c: float = 2) -> np.ndarray:
    g = gray(img)
    return np.where(g > box_mean(g, block | 1) - c, 255, 0).astype(np.uint8)


def median3(img: np.ndarray) -> np.ndarray:
    p = np.pad(gray(img), 1, mode="edge")
    return np.median(np.lib.stride_tricks.sliding_window_view(p, (3, 3)), axis=(2, 3)).astype(np.uint8)


def _slide(img: np.ndarray, h: int, w: int, pick, edge: int) -> np.ndarray:
    p = np.pad(img, ((h // 2, h - 1 - h // 2), (w // 2, w - 1 - w // 2)), constant_values=edge)
    rows = pick(np.lib.stride_tricks.sliding_window_view(p, h, axis=0), axis=-1)
    return pick(np.lib.stride_tricks.sliding_window_view(rows, w, axis=1), axis=-1)


def dilate(img: np.ndarray, h: int = 3, w: int = 3) -> np.ndarray:
    return _slide(gray(img), h, w, np.max, 0)


def erode(img: np.ndarray, h: int = 3, w: int = 3) -> np.ndarray:
    return _slide(gray(img), h, w, np.min, 255)


def opening(img: np.ndarray, h: int = 3, w: int = 3) -> np.ndarray:
    return dilate(erode(img, h, w), h, w)


def closing(img: np.ndarray, h: int = 3, w: int = 3) -> np.ndarray:
    return erode(dilate(img, h, w), h, w)


def resize(img: np.ndarray, width: int, height: int) -> np.ndarray:
    """Bilinear, pixel centres aligned."""
    def axis(n, m):
        x = np.clip((np.arange(m) + 0.5) * n / m - 0.5, 0, n - 1)
        lo = np.floor(x).astype(int)
        return lo, np.minimum(lo + 1, n - 1), x - lo

    (y0, y1, fy), (x0, x1, fx) = axis(img.shape[0], height), axis(img.shape[1], width)
    shape = (-1, 1) + (1,) * (img.ndim - 2)
    fy, fx = fy.reshape(shape), fx.reshape((1,) + shape[:1] + (1,) * (img.ndim - 2))
    f = img.astype(float)
    top, low = f[y0][:, x0] * (1 - fx) + f[y0][:, x1] * fx, f[y1][:, x0] * (1 - fx) + f[y1][:, x1] * fx
    return np.rint(top * (1 - fy) + low * fy).astype(np.uint8)


def letterbox(img: np.ndarray, width: int, height: int) -> np.ndarray:
    """Scaled to fit, in the middle of a white page."""
    r = min(width / img.shape[1], height / img.shape[0])
    w, h = max(1, round(img.shape[1] * r)), max(1, round(img.shape[0] * r))
    page = np.full((height, width) + img.shape[2:], WHITE, np.uint8)
    y, x = (height - h) // 2, (width - w) // 2
    page[y : y + h, x : x + w] = resize(img, w, h)
    return page


def fit(img: np.ndarray, side: str = "width", length: int = 1024) -> np.ndarray:
    """One side (long, short, width, height) scaled to a length."""
    h, w = img.shape[:2]
    now = {"width": w, "height": h, "long": max(h, w), "short": min(h, w)}[side]
    return resize(img, max(1, round(w * length / now)), max(1, round(h * length / now)))


def trim_blank(img: np.ndarray, padding: int = 5, at: int = 127) -> np.ndarray:
    """Cropped to the ink with padding; a blank page stays."""
    ink = gray(img) <= at
    ys, xs = np.nonzero(ink.any(1))[0], np.nonzero(ink.any(0))[0]
    if not ys.size:
        return img
    return img[max(ys[0] - padding, 0) : ys[-1] + padding + 1, max(xs[0] - padding, 0) : xs[-1] + padding + 1]


def border_color(img: np.ndarray) -> np.ndarray:
    """The commonest colour of the outermost pixels; ties: the least."""
    edge = np.concatenate([img[0], img[-1], img[:, 0], img[:, -1]]).reshape(-1, 1 if img.ndim == 2 else img.shape[2])
    colors, n = np.unique(edge, axis=0, return_counts=True)
    return colors[n.argmax()]


def rotate(img: np.ndarray, angle: float) -> np.ndarray:
    """Counter-clockwise; quarter turns lose nothing, others keep the size and fill with the border's colour."""
    if angle % 90 == 0:
        return np.rot90(img, int(angle // 90) % 4)
    h, w = img.shape[:2]
    a = np.deg2rad(angle)
    y, x = np.mgrid[:h, :w]
    y, x = y - (h - 1) / 2, x - (w - 1) / 2
    sx, sy = np.rint(x * np.cos(a) - y * np.sin(a) + (w - 1) / 2).astype(int), np.rint(x * np.sin(a) + y * np.cos(a) + (h - 1) / 2).astype(int)
    good = (sx >= 0) & (sx < w) & (sy >= 0) & (sy < h)
    color = border_color(img)
    out = np.empty_like(img)
    out[...] = color if img.ndim == 3 else color[0]
    out[good] = img[sy[good], sx[good]]
    return out


def skew(img: np.ndarray, limit: float = 5, delta: float = 0.25) -> float:
    """The turn that makes the rows' ink profile sharpest; the first of equals."""
    ink = np.where(gray(img) <= 127, 0, 255).astype(np.uint8)
    best, angle = -1.0, 0.0
    for a in sorted(np.arange(-limit, limit + delta / 2, delta), key=abs):
        profile = (255 - rotate(ink, float(a)).astype(float)).sum(axis=1)
        score = float((np.diff(profile) ** 2).sum())
        if score > best * (1 + 1e-12):
            best, angle = score, float(a)
    return angle


def lines(img: np.ndarray, share: float = 0.05, horizontal: bool = True) -> np.ndarray:
    """Mask of strokes at least `share` of the page long."""
    ink = threshold(img, inverse=True)
    n = max(3, int(ink.shape[1 if horizontal else 0] * share))
    return opening(ink, 1, n) if horizontal else opening(ink, n, 1)


def components(mask: np.ndarray, least: int = 1, corners: bool = False) -> list[tuple[int, int, int, int, int]]:
    """x, y, w, h, area of 4-connected (with `corners` 8-connected) components with at least `least` pixels, from the top left, by runs of each row."""
    parent: list[int] = []

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    runs, before = [], []
    for y, row in enumerate(mask > 0):
        edge = np.diff(np.concatenate([[0], row.view(np.int8), [0]]))
        now = []
        for a, b in zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist()):
            i = len(parent)
            parent.append(i)
            for c, d, j in before:
                if c < b + corners and a < d + corners:
                    x, z = sorted((find(i), find(j)))
                    parent[z] = x
            now.append((a, b, i))
            runs.append((y, a, b, i))
        before = now
    out: dict[int, list[int]] = {}
    for y, a, b, i in runs:
        r = out.setdefault(find(i), [a, y, b, y + 1, 0])
        r[:] = [min(r[0], a), min(r[1], y), max(r[2], b), max(r[3], y + 1), r[4] + b - a]
    return [(x, y, r - x, b - y, n) for x, y, r, b, n in sorted(out.values(), key=lambda v: (v[1], v[0])) if n >= least]


def line_components(img: np.ndarray, least: int = 51) -> list[tuple[int, int, int, int, int]]:
    """x, y, w, h, area of the 8-connected ruled lines (strokes of a thirtieth of the page) of at least `least` pixels."""
    ink = threshold(img, otsu(img), inverse=True)
    across, down = max(1, ink.shape[1] // 30), max(1, ink.shape[0] // 30)
    return components(np.maximum(opening(ink, 1, across), opening(ink, down, 1)), least, corners=True)


def area_box(shape: Sequence[int], area_type: str = "top_left", offset: Sequence[int] | None = None, width: int | None = None, height: int | None = None) -> tuple[int, int, int, int]:
    """x0, y0, x1, y1 of a box at one of nine anchors; -1 reaches to the edge. Without a size, or where nothing is left, the whole."""
    h, w = shape[:2]
    if width is None or height is None:
        return 0, 0, w, h
    y0, x0 = {"top": (0, 0), "center": (h // 2, 0), "bottom": (h, 0)}.get(area_type.split("_")[0], (0, 0))
    x0 = {"left": 0, "center": w // 2, "right": w}.get(area_type.split("_")[-1], 0)
    if area_type not in {f"{v}_{k}" for v in ("top", "center", "bottom") for k in ("left", "center", "right")} - {"center_center"} | {"center"}:
        y0, x0 = 0, 0
    x0, y0 = x0 + (offset or (0, 0))[0], y0 + (offset or (0, 0))[1]
    x1, y1 = w if width == -1 else min(w, x0 + width), h if height == -1 else min(h, y0 + height)
    x0, y0 = max(0, x0), max(0, y0)
    return (0, 0, w, h) if x0 >= x1 or y0 >= y1 else (x0, y0, x1, y1)


def separate_area(img: np.ndarray, area_type: str = "top_left", offset: Sequence[int] | None = None, width: int | None = None, height: int | None = None) -> np.ndarray:
    """The image cropped to area_box()."""
    x0, y0, x1, y1 = area_box(img.shape, area_type, offset, width, height)
    return img if (x0, y0, x1, y1) == (0, 0, img.shape[1], img.shape[0]) else img[y0:y1, x0:x1]


def trim_to_lines(img: np.ndarray, line_ratios: Sequence[float] = (0.05, 0.05), padding_ratios: Sequence[float] = (0.01, 0.01, 0.01, 0.01)) -> np.ndarray:
    """Cropped to the long lines, with padding (top, bottom, left, right) by the content's size, filled with the border's colour where it leaves the page."""
    from quillgrid.functions.measure import long_lines

    h, w = img.shape[:2]
    found = long_lines(img, line_ratios)
    ys, xs = np.nonzero(found)
    # without a line the reference takes one row and one column more than there are
    y0, y1, x0, x1 = (ys.min(), ys.max() + 1, xs.min(), xs.max() + 1) if ys.size else (0, h + 1, 0, w + 1)
    top, bottom, left, right = (int(n * r) for n, r in zip((y1 - y0, y1 - y0, x1 - x0, x1 - x0), padding_ratios))
    y0, y1, x0, x1 = y0 - top, y1 + bottom, x0 - left, x1 + right
    if y1 <= y0 or x1 <= x0:
        return img
    edge = np.concatenate([img[0], img[-1], img[1:-1, 0], img[1:-1, -1]]).reshape(-1, 1 if img.ndim == 2 else img.shape[2])
    colors, n = np.unique(edge, axis=0, return_counts=True)
    out = np.empty((y1 - y0, x1 - x0) + img.shape[2:], np.uint8)
    out[...] = colors[n.argmax()] if img.ndim == 3 else colors[n.argmax()][0]
    part = img[max(0, y0) : min(h, y1), max(0, x0) : min(w, x1)]
    out[max(0, -y0) : max(0, -y0) + part.shape[0], max(0, -x0) : max(0, -x0) + part.shape[1]] = part
    return out


def keep_under_mask(img: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """White but where the mask (black on white), centred on the page and widened by an 11 x 11 square, is not white."""
    new = np.zeros(img.shape[:2], np.uint8)
    cut, put = [], []
    for have, want in zip(mask.shape, new.shape):
        at, to = max(have - want, 0) // 2, max(want - have, 0) // 2
        cut.append(slice(at, at + min(have, want)))
        put.append(slice(to, to + min(have, want)))
    new[tuple(put)] = 255 - gray(mask)[tuple(cut)]
    out = img.copy()
    out[dilate(new, 11, 11) == 0] = WHITE
    return out


def union_mask(images: Sequence[np.ndarray], least: float = 0.0025) -> np.ndarray | None:
    """Line masks of a layout's samples, centred on the largest size and joined; None where lines cover less than `least` of the page."""
    h, w = max(i.shape[0] for i in images), max(i.shape[1] for i in images)
    page = np.zeros((h, w), np.uint8)
    for i in images:
        m = np.maximum(lines(i), lines(i, horizontal=False))
        y, x = (h - m.shape[0]) // 2, (w - m.shape[1]) // 2
        page[y : y + m.shape[0], x : x + m.shape[1]] |= m
    return page if (page > 0).mean() >= least else None


STEPS: dict[str, Callable[..., np.ndarray]] = {
    "gray": gray, "threshold": threshold, "adaptive_threshold": adaptive_threshold, "denoising2": median3, "morphology1": opening, "closing": closing, "thinner": erode,
    "scale": letterbox, "scale1": letterbox, "scale2": fit, "del_blank_set1": trim_blank,
    "del_blank_set2": trim_to_lines, "separate_areas_set1": separate_area, "rotate": rotate, "line_tracking": lines,
    "deskew": lambda img, **p: rotate(img, skew(img, **p)),
}
IMAGE = "height int, width int, channels int, data binary"


def to_array(height: int, width: int, channels: int, data: bytes) -> np.ndarray:
    a = np.frombuffer(data, np.uint8)
    return a.reshape(height, width) if channels == 1 else a.reshape(height, width, channels)


def step(img: np.ndarray, name: str, params: dict, found: dict[str, float]) -> np.ndarray:
    """One step. Steps that measure put what they find into `found`: angles under angle_<angle_key>, paddings under <result_key>_top, _bottom, _left, _right; `rotate` with
    angle_keys turns by the sum of those angles."""
    from quillgrid.functions import measure

    if name in measure.MEASURES:
        params = {k: v for k, v in params.items() if k != "iter_save"}
        key = params.pop("angle_key")
        angle = measure.MEASURES[name](img, **typed(measure.MEASURES[name], params))
        found[f"angle_{key}"] = float(angle)
        return rotate(img, angle) if angle else img
    if name == "calc_padding_set2":
        key = params.get("result_key", "_pad")
        for side, share in zip(("top", "bottom", "left", "right"), measure.paddings(img, params.get("line_ratios", (0.05, 0.05)))):
            found[f"{key}_{side}"] = share
        return img
    if name == "rotate" and "angle_keys" in params:
        return rotate(img, sum(found.get(f"angle_{k}", 0.0) for k in params["angle_keys"]))
    own = {"canny": measure.canny, "denoising": measure.like_patches, "denoising1": measure.like_patches}
    f = own[name] if name in own else STEPS[name]
    return f(img, **typed(f, params))


#: Steps of functions.measure.
MEASURING = ("calc_angle_set1", "calc_angle_set2", "calc_angle_set3", "calc_angle_set4", "calc_padding_set2", "canny", "denoising", "denoising1")


def apply_steps(df: DataFrame, steps: Sequence[tuple[str, dict]], keep: Sequence[str] = (), measured: bool = False) -> DataFrame:
    """Runs named steps on every image row (columns of IMAGE), in one pass over Arrow batches. Unknown names are skipped with a warning. With `measured`, what steps
    measured comes along as a map."""
    known = [(n, p) for n, p in steps if n in STEPS or n in MEASURING]
    for n, _ in steps:
        if n not in STEPS and n not in MEASURING:
            warnings.warn(f"unknown step {n}", stacklevel=2)
    schema = ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep), IMAGE, *(["measured map<string,double>"] if measured else [])])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for h, w, c, data in zip(b["height"], b["width"], b["channels"], b["data"]):
                img, found = to_array(h, w, c, data), {}
                for n, p in known:
                    img = step(img, n, p, found)
                out.append((img.shape[0], img.shape[1], 1 if img.ndim == 2 else img.shape[2], np.ascontiguousarray(img).tobytes(), found))
            made = pd.DataFrame(out, columns=["height", "width", "channels", "data", "measured"])
            yield pd.concat([b[list(keep)].reset_index(drop=True), made if measured else made.drop(columns="measured")], axis=1)

    return df.select(*keep, "height", "width", "channels", "data").mapInPandas(run, schema)
