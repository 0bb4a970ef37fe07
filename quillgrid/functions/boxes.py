"""Geometry of boxes [x, y, w, h], as Column arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Anchor names: where along x and y the reference point lies (0 start, 1 middle, 2 end). Fixed values.
ANCHORS = {
    "top_left": (0, 0), "top_center": (1, 0), "top_right": (2, 0),
    "center_left": (0, 1), "center": (1, 1), "center_right": (2, 1),
    "bottom_left": (0, 2), "bottom_center": (1, 2), "bottom_right": (2, 2),
}


def normalize(value: Column, extent: Column) -> Column:
    """A coordinate on a 0 to 1000 grid, truncated."""
    return F.floor(F.lit(1000) * value / extent).cast("int")


def reorient(x: Column, y: Column, w: Column, h: Column, outer_x: Column, outer_y: Column, outer_w: Column, outer_h: Column, angle: Column) -> Column:
    """A box found in a turned crop, in the coordinates of the page as the pipeline takes them: half a turn keeps x, three quarters swap x and y."""
    turn = F.pmod(F.lit(360) + angle, F.lit(360))
    box = lambda a, b, c, d: F.array(*(v.cast("double") for v in (a, b, c, d)))
    return (
        F.when(turn == 90, box(outer_w - y - h + outer_x, x + outer_y, h, w))
        .when(turn == 180, box(outer_x + x, outer_h - h + outer_y - y, w, h))
        .when(turn == 270, box(y + outer_x, x + outer_y, h, w))
        .otherwise(box(x + outer_x, y + outer_y, w, h))
    )


def anchored_crop(anchor: str, page_w: Column, page_h: Column, x: Column, y: Column, w: Column, h: Column) -> Column:
    """[x, y, w, h] of a crop that starts at an anchor of the page, moved by (x, y); width or height -1 runs to the edge; clamped to the page.

    An unknown anchor is top_left. Where nothing is left, the crop is the whole page.
    """
    ax, ay = ANCHORS.get(anchor, (0, 0))
    at = lambda extent, k: (F.lit(0), F.floor(extent / 2), extent)[k]
    left, top = (at(page_w, ax) + x).cast("int"), (at(page_h, ay) + y).cast("int")
    right, bottom = left + F.when(w == -1, page_w - left).otherwise(w), top + F.when(h == -1, page_h - top).otherwise(h)
    l, t = F.greatest(F.lit(0), left), F.greatest(F.lit(0), top)
    r, b = F.least(page_w, right), F.least(page_h, bottom)
    whole = F.array(F.lit(0), F.lit(0), page_w.cast("int"), page_h.cast("int"))
    return F.when((l < r) & (t < b), F.array(*(v.cast("int") for v in (l, t, r - l, b - t)))).otherwise(whole)


def ratio_crop(anchor: str, page_w: Column, page_h: Column, x: float, y: float, w: float, h: float) -> Column:
    """anchored_crop() with shares of the page, cut to whole pixels towards 0; -1 for width or height stays."""
    px = lambda extent, share, edge: F.lit(-1) if edge and share == -1 else (extent * F.lit(float(share))).cast("int")
    return anchored_crop(anchor, page_w, page_h, px(page_w, x, False), px(page_h, y, False), px(page_w, w, True), px(page_h, h, True))


def blend(ai: Column, text: Column, share: float = 0.9) -> Column:
    """Model confidence and text confidence, weighed; without a text score the model's alone."""
    return F.coalesce(share * ai + (1 - share) * text, ai)


def to_pixels(value: Column, offset: Column, ratio: Column) -> Column:
    """A canvas coordinate in image pixels, to two places, half to even."""
    return F.bround((value - offset) * ratio, 2)


def split_points(edges: Column, extent: Column, min_gap: int) -> Column:
    """Segments (start, length, number) between sorted distinct edges and the borders, of at least min_gap."""
    sorted_points = F.array_sort(F.array_distinct(F.concat(edges, F.array(F.lit(0), extent))))
    # neighbours by zipping the points with themselves, one place on: sorted once, not anew for each pair
    pairs = F.transform(
        F.array(sorted_points), lambda p: F.zip_with(F.slice(p, F.lit(1), F.size(p) - 1), F.slice(p, F.lit(2), F.size(p) - 1), lambda a, b: F.struct(a.alias("start"), (b - a).alias("length")))
    )
    return F.filter(F.get(pairs, F.lit(0)), lambda s: s["length"] >= min_gap)
