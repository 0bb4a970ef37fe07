"""Areas of a page cut into blocks: rows with a box, the number of children and the pixels, parents before their children."""

from __future__ import annotations

import warnings
from collections import deque
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from quillgrid.functions import imaging as I
from quillgrid.functions.params import typed

BLOCK = "block_id string, x int, y int, w int, h int, child int, height int, width int, channels int, data binary"
#: Turns of the line search (a queue's end counts as one); what is left then stays as it is.
MOST_TURNS = 300


@dataclass
class Block:
    name: str
    box: tuple[int, int, int, int]
    img: np.ndarray
    child: int = 0


def turned_box(outer: Sequence[int], box: Sequence[int], angle: float) -> tuple[int, int, int, int]:
    """functions.boxes.reorient() for one box."""
    (ox, oy, ow, oh), (x, y, w, h) = outer, box
    forms = {90: (ow - y - h + ox, x + oy, h, w), 180: (ox + x, oh - h + oy - y, w, h), 270: (y + ox, x + oy, h, w)}
    return forms.get((360 + angle) % 360, (x + ox, y + oy, w, h))


def _ink(img: np.ndarray) -> np.ndarray:
    return I.threshold(I.gray(img), I.otsu(I.gray(img)), inverse=True)


def line_spans(img: np.ndarray, share: float, gap: int) -> list[tuple[int, int]]:
    """Heights between horizontal lines of at least `share` of the width, those of at least `gap`; none without a line, or on a dark image."""
    ink = _ink(img)
    reach = int(ink.shape[1] * share)
    if reach < 5 or (ink > 0).mean() > 0.6:
        return []
    thick = I.dilate(I.closing(ink, 1, 5))
    long = I.dilate(I.dilate(I.erode(I.erode(thick, 1, reach), 1, reach), 1, reach), 1, reach)
    edges = {e for _, y, _, h, _ in I.components(long, corners=True) for e in (y, y + h)}
    if not edges:
        return []
    cuts = sorted({0, ink.shape[0], *edges})
    return [(a, b) for a, b in zip(cuts, cuts[1:]) if b - a >= gap]


def _by_lines(block: Block, share: float, gap: int, down: bool) -> list[Block]:
    """Children between horizontal lines, or (down) vertical ones: those are found in the image turned clockwise."""
    img = I.rotate(block.img, -90) if down else block.img
    out = []
    for n, (a, b) in enumerate(line_spans(img, share, gap), 1):
        box = turned_box(block.box, (0, a, img.shape[1], b - a), -90 if down else 0)
        out.append(Block(f"{block.name}_{'v' if down else 'h'}{n}", box, I.rotate(img[a:b], 90) if down else img[a:b]))
    return out


def separate_block_by_line(block: Block, horizontal_first: bool = True, horizontal_line_ratio: float = 0.7, horizontal_min_gap: int = 15, vertical_line_ratio: float = 0.7, vertical_min_gap: int = 15) -> list[Block]:
    """The block and all its parts: cut at horizontal and at vertical lines in turns until neither cuts. Where the first direction finds nothing, the other begins."""
    rules = {False: (horizontal_line_ratio, horizontal_min_gap), True: (vertical_line_ratio, vertical_min_gap)}
    down, turns, out = not horizontal_first, 0, []
    todo: dict[bool, deque[Block]] = {False: deque(), True: deque()}
    todo[down].append(block)
    while (todo[False] or todo[True]) and turns <= MOST_TURNS:
        turns += 1
        if not todo[down]:
            down = not down
            continue
        now = todo[down].popleft()
        parts = _by_lines(now, *rules[down], down)
        if turns == 1 and not parts:
            down = not down
            todo[down].append(now)
            continue
        todo[not down].extend(parts)
        now.child = len(parts)
        out.append(now)
    return out + list(todo[False]) + list(todo[True])


def _halves(block: Block, img: np.ndarray, cut: int, angle: float, mark: str) -> list[Block]:
    block.child = 2
    h, w = img.shape[:2]
    spans = ((0, cut), (cut, w))
    return [block, *(Block(f"{block.name}_{mark}{n}", turned_box(block.box, (a, 0, b - a, h), angle), I.rotate(img[:, a:b], -angle)) for n, (a, b) in enumerate(spans, 1))]


def split_image_by_left_ratio(block: Block, split_ratio: float = 0.5, angle: int = 0) -> list[Block]:
    """The block and its two parts, _r1 and _r2, cut at a share of its width."""
    img = I.rotate(block.img, angle)
    return _halves(block, img, int(img.shape[1] * max(0, min(split_ratio, 1))), angle, "r")


def split_image_by_vertical_gaps(
    block: Block, min_start_point: int | None = None, min_gap_width: int | None = None, min_start_ratio: float | None = None, min_gap_ratio: float | None = None, angle: int = 0
) -> list[Block]:
    """The block and its parts, _g1 and _g2, cut in the first blank run of so many columns; whole without one, or where it begins at the first column looked at."""
    img = I.rotate(block.img, angle)
    h, w = img.shape[:2]
    start = min_start_point if min_start_point is not None else 10 if min_start_ratio is None else int(min_start_ratio * w)
    gap = min_gap_width if min_gap_width is not None else 20 if min_gap_ratio is None else int(min_gap_ratio * w)
    ink = _ink(img)
    ink = I.erode(I.erode(I.dilate(I.dilate(ink, 5, 5), 5, 5), 5, 5), 5, 5)
    blank = ~(ink[2 : h - 2] > 0).any(axis=0)
    blank[:start] = False
    edge = np.diff(np.concatenate([[0], blank.view(np.int8), [0]]))
    runs = [(a, b) for a, b in zip(np.nonzero(edge == 1)[0].tolist(), np.nonzero(edge == -1)[0].tolist()) if b - a >= gap]
    if not runs or runs[0][0] == start:
        return [block]
    return _halves(block, img, runs[0][0] + gap // 2, angle, "g")


def one_block(block: Block) -> list[Block]:
    block.child = 0
    return [block]


STEPS: dict[str, Callable[..., list[Block]]] = {
    f.__name__: f for f in (one_block, separate_block_by_line, split_image_by_left_ratio, split_image_by_vertical_gaps)
}


def cut(block: Block, steps: Sequence[tuple[str, dict]]) -> list[Block]:
    """The steps on one block: what has children stays as it is, every leaf goes on to the next step. Unknown steps are skipped."""
    for i, (name, params) in enumerate(steps):
        if name in STEPS:
            made = STEPS[name](block, **typed(STEPS[name], params))
            if len(made) > 1:
                return [x for b in made for x in ([b] if b.child else cut(b, steps[i + 1 :]))]
    return [block]


def separate(df: DataFrame, steps: Sequence[tuple[str, dict]], keep: Sequence[str]) -> DataFrame:
    """Rows of BLOCK with the columns `keep` for each image row (block_id, x, y and the columns of imaging.IMAGE). Unknown steps are skipped with a warning."""
    for n, _ in steps:
        if n not in STEPS:
            warnings.warn(f"unknown step {n}", stacklevel=2)
    names = [c.split()[0] for c in BLOCK.split(", ")]
    schema = ", ".join([*(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keep), BLOCK])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for row in b.to_dict("records"):
                img = I.to_array(row["height"], row["width"], row["channels"], row["data"])
                done = cut(Block(row["block_id"], (row["x"], row["y"], img.shape[1], img.shape[0]), img), steps)
                out = [(x.name, *map(int, x.box), x.child, x.img.shape[0], x.img.shape[1], row["channels"], np.ascontiguousarray(x.img).tobytes()) for x in done]
                yield pd.DataFrame(out, columns=names).assign(**{k: row[k] for k in keep})[[*keep, *names]]

    return df.select(*keep, "block_id", "x", "y", "height", "width", "channels", "data").mapInPandas(run, schema)
