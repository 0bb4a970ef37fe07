"""text.contain_score() of every text against every key, by arrays over a block of keys.

A substring's name is made of the names of its halves, and what no key holds has the name 0. Which occurrences of a substring count (no two overlap, from
the left) depends on the text alone, so they are found once for all keys. What a place weighs for several keys lies in one 64-bit number, so that one
running sum serves them all.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Keys per block, each block broadcast and one pass over the texts; cells of the tables; rows per batch that leaves; characters that are weighed at once.
KEYS, CELLS, ROWS, TILE = 512, 4_000_000, 50_000, 65_536
#: Codes that are looked up in a table of all codes; bits of a table that tells most other codes that no key holds.
CODES, SIEVE = 1 << 22, 20
#: Products in a piece of a matrix product.
PIECE = 1 << 17


def _chars(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)


def _shifts(lanes: int, bits: int) -> np.ndarray:
    return np.uint64(64) - np.uint64(bits) * np.arange(1, lanes + 1, dtype=np.uint64)


def _packed(values: np.ndarray, lanes: int, bits: int) -> np.ndarray:
    """Of rows with a column for each key: a row for each `lanes` keys, the first one in the number's highest bits."""
    wide = np.zeros((-(-values.shape[1] // lanes) * lanes, values.shape[0]), np.uint64)
    wide[: values.shape[1]] = values.T
    wide <<= np.tile(_shifts(lanes, bits), wide.shape[0] // lanes)[:, None]
    return wide.reshape(-1, lanes, values.shape[0]).sum(axis=1, dtype=np.uint64)


def _overlapping(name: np.ndarray, at: np.ndarray, size: int) -> np.ndarray:
    """Positions of named substrings that overlap an earlier one of the same name that counts; `at`: where names are."""
    if size == 1 or at.size < 2:
        return at[:0]
    if size <= 4:
        same = [(i := np.flatnonzero((name[:-d] == name[d:]) & (name[d:] > 0)), i + d) for d in range(1, size)]
        met = np.unique(np.concatenate([i for pair in same for i in pair]))
    else:
        by = at[np.argsort(name[at], kind="stable")]
        close = (name[by[1:]] == name[by[:-1]]) & (np.diff(by) < size)
        met = np.unique(np.concatenate([by[1:][close], by[:-1][close]]))
    met = met[np.argsort(name[met], kind="stable")]
    drop, last, before = [], -size, 0
    for i, n in zip(met.tolist(), name[met].tolist()):
        if n != before or last + size <= i:
            last, before = i, n
        else:
            drop.append(i)
    return np.sort(np.array(drop, np.int64))


def _product(many: np.ndarray, held: np.ndarray) -> np.ndarray:
    """Counts times a table of 0 and 1, in pieces so small that BLAS doesn't divide them among threads: these wait for each other at full CPU."""
    kind = np.float32 if many.sum(axis=1).max(initial=0) < 1 << 24 else np.float64
    out, many, held = np.zeros((many.shape[0], held.shape[1]), np.int64), many.astype(kind), held.astype(kind, copy=False)
    for d in range(0, many.shape[0], 64):
        rows = many[d : d + 64]
        step = max(1, PIECE // (rows.shape[0] * held.shape[1]))
        for w in range(0, held.shape[0], step):
            out[d : d + 64] += (rows[:, w : w + step] @ held[w : w + step]).astype(np.int64)
    return out


class _Level:
    """The substrings of one size that keys hold: their codes, which keys hold each (as lists and, where it fits, as a table), and how codes are looked up."""

    def __init__(self, size: int, halves: int, codes: Sequence[np.ndarray]):
        n = len(codes)
        self.size, self.halves = size, halves
        self.codes, name = np.unique(np.concatenate(codes), return_inverse=True)
        self.names = np.split(name + 1, np.cumsum([k.size for k in codes])[:-1])
        word, self.key = np.divmod(np.unique((name + 1) * n + np.repeat(np.arange(n), [k.size for k in codes])), n)
        self.first = np.searchsorted(word, np.arange(self.codes.size + 2))
        self.held = None
        if (self.codes.size + 1) * n <= CELLS:
            self.held = np.zeros((self.codes.size + 1, n), np.uint8)
            self.held[word, self.key] = 1
        self.table = self.sieve = None
        if self.codes[-1] < CODES:
            self.table = np.zeros(int(self.codes[-1]) + 2, np.int32)
            self.table[self.codes] = np.arange(1, self.codes.size + 1)
        else:
            self.sieve = np.zeros(1 << SIEVE, bool)
            self.sieve[self._hash(self.codes)] = True

    @staticmethod
    def _hash(codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SIEVE)).astype(np.int64)

    def named(self, codes: np.ndarray) -> np.ndarray:
        if self.table is not None:
            return self.table.take(codes, mode="clip")
        maybe = np.flatnonzero(self.sieve[self._hash(codes)])
        i = np.minimum(np.searchsorted(self.codes, codes[maybe]), self.codes.size - 1)
        out = np.zeros(codes.size, np.int32)
        out[maybe] = np.where(self.codes[i] == codes[maybe], i + 1, 0)
        return out

    def pairs(self, name: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the names, and a key that holds it."""
        many = self.first[name + 1] - self.first[name]
        end = np.cumsum(many)
        return np.repeat(np.arange(name.size), many), self.key[np.arange(many.sum()) + np.repeat(self.first[name] - end + many, many)]

    def holds(self, name: np.ndarray, n: int) -> np.ndarray:
        if self.held is not None:
            return self.held.take(name, 0)
        out = np.zeros((name.size, n), np.uint8)
        out[self.pairs(name)] = 1
        return out


class Keys:
    def __init__(self, keys: Sequence[str | None]):
        full = [_chars((k or "").replace(" ", "")) for k in keys]
        self.n = np.array([k.size for k in full], np.int64)
        self.p = np.array([max(int(n) - 1, 0).bit_length() for n in self.n], np.int64)
        self.top = self.p * (self.p + 1) / 2
        self.scale = self.n * self.top - (self.top - self.p - 1) * (self.p - 1)
        #: What lies in a window is below 1 << bits, so sums of several keys lie side by side; those of windows are whole whatever ran over before.
        self.bits = max(int((self.n * self.top).max(initial=0)).bit_length(), 1)
        self.lanes = max(64 // self.bits, 1)
        self.levels: list[_Level] = []
        names, size, halves = full, 1, 0
        while any(k.size for k in names):
            codes = names if size == 1 else [k[: -size // 2] * halves + k[size // 2 :] for k in names]
            self.levels.append(level := _Level(size, halves, codes))
            halves, size = level.codes.size + 1, size * 2
            names = [k if k.size > size // 2 else k[:0] for k in level.names]
        #: The first levels' substrings with all that begins at the same place: what they weigh for each key.
        chain, last, nodes = [np.zeros((1, len(full)), np.int64)], None, 1
        self.nodes: list[int] = []
        for j, level in enumerate(self.levels):
            if level.held is None or (nodes + level.codes.size) * len(full) > CELLS:
                break
            rows = level.held[1:] * (self.p - j)
            if j:
                rows += last[level.codes // level.halves - 1]
            chain.append(rows)
            self.nodes.append(nodes - 1)
            nodes, last = nodes + level.codes.size, rows
        self.chain = _packed(np.concatenate(chain), self.lanes, self.bits)
        self.thin = [level.held.astype(np.float32) if level.codes.size < 2048 else None for level in self.levels[: len(self.nodes)]]

    def scores(self, text: str | None) -> np.ndarray:
        return self.many([text])[0]

    def many(self, texts: Sequence[str | None]) -> np.ndarray:
        """A row of scores for each text."""
        bare = [(t or "").replace(" ", "") for t in texts]
        length = np.array([len(t) for t in bare], np.int64)
        start = np.cumsum(length + 1) - length - 1
        chars = _chars(" ".join(bare))  # no key holds the space between two texts
        most, d, k = len(self.levels), len(bare), self.n.size
        found, size = [], 1
        for level in self.levels:
            if size == 1:
                name = level.named(chars)
                if level.table is not None:
                    name[chars >= level.table.size] = 0
            else:
                whole = np.zeros(chars.size, np.int32)
                if chars.size >= size:
                    left, right = name[: -size // 2][: chars.size - size + 1], name[size // 2 :][: chars.size - size + 1]
                    both = np.flatnonzero((left > 0) & (right > 0))
                    whole[both] = level.named(left[both] * np.int64(level.halves) + right[both])
                name = whole
            at = np.flatnonzero(name)
            if not at.size:
                break
            found.append((name, at, _overlapping(name, at, size)))
            size *= 2
        odd = np.unique(np.concatenate([drop for *_, drop in found])) if found else np.zeros(0, np.int64)
        for j, (name, at, drop) in enumerate(found):
            counted = name[odd]
            counted[np.isin(odd, drop, assume_unique=True)] = 0
            name = name.copy()
            name[odd] = 0
            found[j] = (name, at[name[at] > 0], counted)
        node = np.zeros(chars.size, np.int64)
        for (name, at, _), base in zip(found, self.nodes):
            node[at] = name[at] + base
        #: Places with at least so many substrings, but for odd ones, and odd ones with just so many; the best windows.
        least, odds = np.zeros((most + 2, d, k), np.int64), np.zeros((most + 1, d, k), np.int64)
        best = np.zeros((k, d), np.uint64)
        wide = max(TILE, 2 * int(self.n.max(initial=0)))
        for a in range(0, chars.size if found else 0, wide):
            z = min(a + wide, chars.size)
            x, y = np.searchsorted(start, a, "right") - 1, np.searchsorted(start, z)
            owner = np.repeat(np.arange(y - x), np.diff(np.clip(np.append(start[x:y], z), a, z)))
            self._count(found, odd, owner, a, z, least[:, x:y], odds[:, x:y])
            self._weigh(found, odd, node, start[x:y], length[x:y], a, z, best[:, x:y])
        return self._score(least[1:] - np.concatenate([least[2:], least[:1]]), odds, best.T, length)

    def _count(self, found: list, odd: np.ndarray, owner: np.ndarray, a: int, z: int, least: np.ndarray, odds: np.ndarray) -> None:
        d, k = least.shape[1:]
        for j, ((name, at, _), level) in enumerate(zip(found, self.levels)):
            words = level.codes.size + 1
            if j < len(self.nodes) and d * words <= 8 * (z - a):
                many = np.bincount(owner * words + name[a:z], minlength=d * words).reshape(d, words)
                if self.thin[j] is not None:
                    least[j + 1] += _product(many, self.thin[j])
                else:
                    some = np.flatnonzero(many.any(axis=0))
                    least[j + 1] += _product(many[:, some], level.held.take(some, 0))
            else:
                at = at[np.searchsorted(at, a) : np.searchsorted(at, z)]
                for b in range(0, at.size, step := max(1, CELLS // k)):
                    i, key = level.pairs(name[at[b : b + step]])
                    least[j + 1] += np.bincount(owner[at[b + i] - a] * k + key, minlength=d * k).reshape(d, k)
        lo, hi = np.searchsorted(odd, [a, z])
        for b in range(lo, hi, step := max(1, CELLS // k)):
            e = min(b + step, hi)
            seen = np.zeros((e - b, k), np.uint8)
            for (*_, counted), level in zip(found, self.levels):
                seen += level.holds(counted[b:e], k)
            whose, first = np.unique(owner[odd[b:e] - a], return_index=True)
            for g in range(1, int(seen.max()) + 1):
                odds[g][whose] += np.add.reduceat(seen == g, first, axis=0, dtype=np.int64)

    def _weigh(self, found: list, odd: np.ndarray, node: np.ndarray, start: np.ndarray, length: np.ndarray, a: int, z: int, best: np.ndarray) -> None:
        """The best windows that begin in a to z."""
        k, bits, lanes = self.n.size, self.bits, self.lanes
        e = min(z + int(self.n.max()), node.size)
        shift = _shifts(lanes, bits)
        listed = [(name, at[np.searchsorted(at, a) : np.searchsorted(at, e)], j) for j, (name, at, _) in enumerate(found) if j >= len(self.nodes)]
        many = sum(int((self.levels[j].first[name[at] + 1] - self.levels[j].first[name[at]]).sum()) for name, at, j in listed)
        group = -(-self.chain.shape[0] // max(1, -(-many // CELLS)))
        lo, hi = np.searchsorted(odd, [a, e])
        odd, step = odd[lo:hi] - a, max(1, CELLS // max(hi - lo, 1) // lanes)
        begin = np.clip(start, a, z) - a
        close = np.clip(start + length + 1 - self.n[:, None], begin + a, z) - a
        bounds = np.empty((k, 2 * start.size), np.int64)
        bounds[:, ::2], bounds[:, 1::2] = begin, close
        node = node[a:e]
        weight, run, window = np.empty(e - a, np.uint64), np.zeros(e - a + 1, np.uint64), np.empty(e - a + 2, np.uint64)
        for pack in range(self.chain.shape[0]):
            self.chain[pack].take(node, out=weight, mode="clip")
            if odd.size:
                if pack % step == 0:
                    x, y = pack * lanes, (pack + step) * lanes
                    heavy = np.zeros((odd.size, min(y, k) - x), np.int64)
                    for j, ((*_, counted), level) in enumerate(zip(found, self.levels)):
                        heavy += level.holds(counted[lo:hi], k)[:, x:y] * (self.p[x:y] - j)
                    heavy = _packed(heavy, lanes, bits)
                weight[odd] = heavy[pack % step]
            if listed:
                if pack % group == 0:
                    where, sums, cut = self._listed(listed, a, e - a, pack, pack + group, shift)
                some = slice(cut[pack % group], cut[pack % group + 1])
                weight[where[some]] += sums[some]
            np.cumsum(weight, out=run[1:])
            for key in range(pack * lanes, min((pack + 1) * lanes, k)):
                n = int(self.n[key])
                if n < 2 or n > e - a:
                    continue
                part = window[: e - a + 2 - n]
                np.subtract(run[n:], run[:-n], out=part[:-1])
                if up := 64 - bits - int(shift[key % lanes]):
                    np.left_shift(part[:-1], np.uint64(up), out=part[:-1])
                part[-1] = 0
                top = np.maximum.reduceat(part, np.minimum(bounds[key], part.size - 1))[::2] >> np.uint64(64 - bits)
                best[key] = np.maximum(best[key], np.where(close[key] > begin, top, 0))

    def _listed(self, listed: list, a: int, wide: int, x: int, y: int, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What substrings that are held as lists weigh for the packs from x to y: places, in order of packs, their weights, and where each pack begins."""
        cells, weights = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        for name, at, j in listed:
            for b in range(0, at.size, step := max(1, CELLS // self.n.size)):
                i, key = self.levels[j].pairs(name[at[b : b + step]])
                inside = (key >= x * self.lanes) & (key < y * self.lanes)
                i, key = i[inside], key[inside]
                cells.append((key // self.lanes - x) * wide + at[b + i] - a)
                weights.append((self.p[key] - j).astype(np.uint64) << shift[key % self.lanes])
        cells, weights = np.concatenate(cells), np.concatenate(weights)
        order = np.argsort(cells, kind="stable")
        cell, first = np.unique(cells[order], return_index=True)
        sums = np.add.reduceat(weights[order], first) if cell.size else weights
        return cell % wide, sums, np.searchsorted(cell, np.arange(y - x + 1) * wide)

    def _score(self, many: np.ndarray, odds: np.ndarray, best: np.ndarray, length: np.ndarray) -> np.ndarray:
        good = self.n >= 2
        match, density = np.zeros(best.shape), np.zeros(best.shape)
        for g in range(1, odds.shape[0]):
            count = many[g - 1] + odds[g]
            i, k = np.nonzero((count > 0) & good)
            match[i, k] += np.minimum(g * (1 - (1 - g / self.p[k]) ** (count[i, k] + 1)), g) / self.top[k]
        fits = good & (self.n <= length[:, None]) & (self.scale != 0)
        np.divide(best, self.scale, out=density, where=fits)
        both = 0.6 * match + 0.6 * density
        return np.where(good, np.where(both > 1, np.minimum(0.6 * match + 0.4 * density, 1.0), both), 0.0)


def _score(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, keys = block.value
        keys, most, ids = Keys(keys), max(1, ROWS // len(ids)), pa.array(ids, pa.int64())
        for batch in batches:
            texts, at = batch.column(1).to_pylist(), 0
            while at < len(texts):
                end, chars = at + 1, len(texts[at] or "")
                while end < len(texts) and end - at < most and (chars := chars + len(texts[end] or "")) <= TILE:
                    end += 1
                score, rows = keys.many(texts[at:end]), np.arange(at, end)
                doc = batch.column(0).take(pa.array(np.repeat(rows, len(ids))))
                item = ids.take(pa.array(np.tile(np.arange(len(ids)), rows.size)))
                yield pa.RecordBatch.from_arrays([doc, item, pa.array(score.ravel())], names=["doc_id", "item_id", "score"])
                at = end

    return run


def all_scores(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """doc_id, item_id and score of every row of docs (doc_id, text) with every row of keys (item_id, key); rows with null or repeated ids too.

    The keys are the stated set: the driver reads them one by one and broadcasts KEYS of them at a time; the texts aren't shuffled.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema, blocks, block = "doc_id bigint, item_id bigint, score double", [], []

    def close() -> None:
        held = spark.sparkContext.broadcast(([i for i, _ in block], [k for _, k in block]))
        blocks.append(docs.mapInArrow(_score(held), schema))
        block.clear()

    for r in keys.select(F.col("item_id").cast("bigint"), F.col("key").cast("string")).toLocalIterator():
        block.append((r[0], r[1]))
        if len(block) == KEYS:
            close()
    if block:
        close()
    out = blocks[0] if blocks else spark.createDataFrame([], schema)
    for b in blocks[1:]:
        out = out.unionByName(b)
    return out
