"""SentencePiece BPE encoding by vectorised merge rounds, and decoding with the library.

A batch's texts are one array of bytes, cut where no piece can cross: before a run of spaces, and around line feeds where the vocabulary has none.
The words between the cuts are told apart by 64-bit hashes; those that a worker hasn't met lately are encoded together: their symbols lie
in one flat array, each round finds the best pair of every word (segmented minimum), merges its leftmost, non-overlapping occurrences at once,
looks up only the pairs beside a merge anew, and drops words without a pair left.

One at a time, in the library's order, would give the same: a round merges several places of a word only if they make the
same piece and no pair that comes into being beside one of them is as good or better. Otherwise that word merges its leftmost place only.
In a long word the best pair is sought within REACH symbols of each place instead: what could take a symbol of a pair away is a piece beside it that is
made of better pairs, and no piece is longer than that. So such a word takes rounds by its depth, not by its length.

Decoding gives a text back as it was. Where it doesn't (two words with one hash), the text is encoded again without hashes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm.common import small_batches
from quillgrid.llm.scan import mix, parts

SPACE = "▁"
_MARK = SPACE.encode()
#: A worker keeps the ids of so many words, and so many ids; beyond, it starts anew.
CACHE_WORDS, CACHE_IDS = 400_000, 4_000_000
#: Words of more symbols are merged by local minima; bytes that are encoded at once, unless a word is longer.
LONG, SLICE = 96, 2_000_000
NONE = np.iinfo(np.int32).max
SCHEMA = "doc_id bigint, ids array<int>, decoded string"
_CODES = np.random.Generator(np.random.PCG64(20240502)).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0xD1342543DE82EF95)


def ranges(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Indices starts[0], starts[0] + 1, ... for lens[0] of them, and so on."""
    ends = np.cumsum(lens)
    return np.arange(int(ends[-1]) if ends.size else 0) + np.repeat(starts - (ends - lens), lens)


def around(rank: np.ndarray, reach: int) -> tuple[np.ndarray, np.ndarray]:
    """The least of the `reach` places before each place, and of all within `reach` of it."""
    low = np.full(rank.size + 2 * reach, NONE, np.int32)
    low[reach : reach + rank.size] = rank
    span = 1
    while span < reach:
        step = min(span, reach - span)
        low = np.minimum(low[:-step], low[step:])
        span += step
    before = low[: rank.size]
    return before, np.minimum(np.minimum(before, low[reach + 1 : reach + 1 + rank.size]), rank)


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.size = n = sp.get_piece_size()
        plain = {}
        self.byte_ids = np.zeros(256, np.int32)
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
            elif not (sp.is_unknown(i) or sp.is_control(i)):
                plain[piece] = i
        scores = np.array([sp.get_score(i) for i in range(n)])
        self.rank = np.append(np.unique(-scores, return_inverse=True)[1].astype(np.int32), NONE)  # the last for no piece (-1)
        self.reach = max(map(len, plain), default=1)
        self.chars = np.arange(n, n + 0x110000, dtype=np.int32)  # a character without a piece is a symbol of its own
        for piece, i in plain.items():
            if len(piece) == 1:
                self.chars[ord(piece)] = i
        pairs = {(plain[p[:k]], plain[p[k:]]): i for p, i in plain.items() for k in range(1, len(p)) if p[:k] in plain and p[k:] in plain}
        self._table(pairs)
        if any(re.search(f"[^{SPACE}]{SPACE}", p) for p in plain):
            raise ValueError("pieces of this model cross from a word into the next space")
        self.lines = not any("\n" in p for p in plain)
        self._forget()

    def _table(self, pairs: dict[tuple[int, int], int]) -> None:
        """Open addressing over pair keys, read by whole arrays."""
        self.shift = np.uint64(64 - max(16, int(np.ceil(np.log2(max(len(pairs), 1) * 6)))))
        slots = 1 << (64 - int(self.shift))
        self.keys, self.values = np.full(slots, -1, np.int64), np.full(slots, -1, np.int32)
        self.mask = slots - 1
        left, right = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 2
        keys, slot = self._slot(left, right)
        for key, at, value in zip(keys.tolist(), slot.tolist(), pairs.values()):
            while self.keys[at] != -1:
                at = (at + 1) & self.mask
            self.keys[at], self.values[at] = key, value

    def _slot(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys = left.astype(np.int64) << 22 | right
        return keys, ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def pair(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair of symbols makes, -1 for none."""
        keys, slot = self._slot(left, right)
        there = self.keys[slot]
        hit = there == keys
        out = np.where(hit, self.values[slot], np.int32(-1))
        todo = np.nonzero(~hit & (there != -1))[0]
        while todo.size:
            slot[todo] = (slot[todo] + 1) & self.mask
            there = self.keys[slot[todo]]
            hit = there == keys[todo]
            out[todo[hit]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (there != -1)]
        return out

    def merge(self, chars: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Final ids of the words that `chars` (code points, spaces already marked) holds one after the other, and how many each has."""
        sym, names = self.chars[chars], np.arange(lens.size)
        there, long = lens > 0, lens > LONG
        if long.any():
            of = np.repeat(long, lens)
            ended = self._rounds(sym[~of], lens[there & ~long], names[there & ~long], False) + self._rounds(sym[of], lens[long], names[long], True)
        else:
            ended = self._rounds(sym, lens[there], names[there], False)
        if not ended:
            return np.zeros(0, np.int32), np.zeros(lens.size, np.int64)
        names, counts, flat = (np.concatenate(x) for x in zip(*ended))
        n = np.zeros(lens.size, np.int64)
        n[names] = counts
        starts = np.zeros(lens.size, np.int64)
        starts[names] = np.cumsum(counts) - counts
        flat = flat[ranges(starts, n)]
        odd = flat >= self.size
        return self._bytes(flat, n, odd) if odd.any() else (flat, n)

    def _rounds(self, sym: np.ndarray, lens: np.ndarray, names: np.ndarray, local: bool) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(names, number of symbols, symbols) of the words that end in each round."""
        ended = []
        word = np.repeat(np.arange(names.size, dtype=np.int32), lens)
        made = np.full(sym.size, -1, np.int32)
        inside = np.nonzero(word[1:] == word[:-1])[0]
        made[inside] = self.pair(sym[inside], sym[inside + 1])
        rank = self.rank[made]
        while names.size:
            best = np.minimum.reduceat(rank, np.cumsum(lens) - lens)
            over = best == NONE
            keep = ~over[word]
            if over.any():
                ended.append((names[over], lens[over], sym[~keep]))
            earlier, least = around(rank, self.reach) if local else (None, best[word])
            at = np.nonzero((rank == least) & (rank != NONE))[0]
            if at.size:
                at = self._together(sym, word, made, rank, at, earlier)
                sym[at] = made[at]
                keep[at + 1] = False
                lens = lens - np.bincount(word[at], minlength=lens.size)
            new = np.cumsum(keep) - 1
            at, sym, made, rank, word = new[at], sym[keep], made[keep], rank[keep], word[keep]
            if over.any():
                word = (np.cumsum(~over) - 1).astype(np.int32)[word]
                names, lens = names[~over], lens[~over]
            # only the pairs beside a merge are new
            beside = np.concatenate([at, at[at > 0] - 1])
            follows = np.minimum(beside + 1, max(sym.size - 1, 0))
            both = (follows > beside) & (word[follows] == word[beside])
            made[beside] = -1
            beside = beside[both]
            made[beside] = self.pair(sym[beside], sym[beside + 1])
            changed = np.concatenate([at, at[at > 0] - 1])
            rank[changed] = self.rank[made[changed]]
        return ended

    def _together(self, sym: np.ndarray, word: np.ndarray, made: np.ndarray, rank: np.ndarray, at: np.ndarray, earlier: np.ndarray | None) -> np.ndarray:
        """Those of the places `at` that this round may merge. Places of one word form a chain; with `earlier`, only those no more than the reach apart.

        A chain whose first place has an equal pair within reach before it (one that waits for a better pair) waits, too.
        """
        number = np.arange(at.size)
        run = np.ones(at.size, bool)  # neighbouring places overlap: every other one, from the left
        run[1:] = np.diff(at) != 1
        at = at[(number - np.maximum.accumulate(np.where(run, number, 0))) % 2 == 0]
        first = np.ones(at.size, bool)
        first[1:] = word[at[1:]] != word[at[:-1]]
        if earlier is not None:
            first[1:] |= np.diff(at) > self.reach
            ready = (earlier[at] > rank[at])[first][np.cumsum(first) - 1]
            at, first = at[ready], first[ready]
        if first.all():
            return at
        chain = np.cumsum(first) - 1
        lead = np.nonzero(first)[0][chain]
        shared = np.bincount(chain)[chain] > 1
        at_all, at, chain, lead = at, at[shared], chain[shared], at[lead[shared]]
        piece, mine = made[at], word[at]
        bad = piece != made[lead]
        before, after = np.maximum(at - 1, 0), np.minimum(at + 2, sym.size - 1)
        left, right = (at > 0) & (word[before] == mine), (at + 2 < sym.size) & (word[after] == mine)
        now = rank[at]
        bad |= left & (self.rank[self.pair(sym[before], piece)] <= now)
        bad |= right & (self.rank[self.pair(piece, sym[after])] <= now)
        bad |= self.rank[self.pair(piece, piece)] <= now
        single = np.zeros(int(first.sum()), bool)
        single[chain[bad]] = True
        return at_all[first | ~single[np.cumsum(first) - 1]]

    def _bytes(self, flat: np.ndarray, n: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """A character without a piece becomes the ids of its bytes."""
        value, at = np.unique(flat[odd], return_inverse=True)
        coded = [np.frombuffer(chr(c).encode(), np.uint8) for c in (value - self.size).tolist()]
        width = np.array([c.size for c in coded])
        times = np.ones(flat.size, np.int64)
        times[odd] = width[at]
        out = np.repeat(flat, times)
        of = np.repeat(odd, times)
        out[of] = self.byte_ids[np.concatenate(coded)][ranges((np.cumsum(width) - width)[at], width[at])]
        word = np.repeat(np.arange(n.size), n)
        return out, np.bincount(word, weights=times, minlength=n.size).astype(np.int64)

    def _forget(self) -> None:
        self.known, self.start, self.count, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int32)

    def _chars(self, data: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Code points of the words at `starts`, and how many each has."""
        raw = data[ranges(starts, lens)]
        heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
        ends = np.cumsum(lens)
        chars = np.frombuffer(raw.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        return np.where(chars == 32, np.uint32(ord(SPACE)), chars), heads[ends] - heads[ends - lens]

    def _cut(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All bytes, where words start, and the first word of each text (and the number of words)."""
        data = np.frombuffer(b"".join(texts), np.uint8)
        space = data == 32
        start = space.copy()
        start[1:] &= ~space[:-1]
        if self.lines:
            line = data == 10
            start |= line
            start[1:] |= line[:-1]
        begin = np.cumsum([0, *map(len, texts)])
        start[begin[:-1][np.diff(begin) > 0]] = True
        starts = np.nonzero(start)[0]
        return data, starts, np.searchsorted(starts, begin)

    def _encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and how many each has. The texts are marked already."""
        data, starts, first = self._cut(texts)
        if not starts.size:
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        lens = np.diff(np.append(starts, data.size))
        # a byte counts by its code times a power of its place in its word
        steps = np.full(int(lens.max()), _BASE, np.uint64)
        steps[0] = 1
        value = _CODES[data]
        value *= np.cumprod(steps)[np.arange(data.size) - np.repeat(starts, lens)]
        hashes = mix(np.add.reduceat(value, starts) + lens.astype(np.uint64))
        words, one, of = np.unique(hashes, return_index=True, return_inverse=True)
        if self.known.size > CACHE_WORDS or self.ids.size > CACHE_IDS:
            self._forget()
        at = np.minimum(np.searchsorted(self.known, words), max(self.known.size - 1, 0))
        new = self.known[at] != words if self.known.size else np.ones(words.size, bool)
        if new.any():
            ids, n = self.merge(*self._chars(data, starts[one[new]], lens[one[new]]))
            known = np.concatenate([self.known, words[new]])
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.start = np.concatenate([self.start, self.ids.size + np.cumsum(n) - n])[order]
            self.count = np.concatenate([self.count, n])[order]
            self.ids = np.concatenate([self.ids, ids])
            at = np.searchsorted(self.known, words)
        at = at[of]
        counts = self.count[at]
        upto = np.concatenate([[0], np.cumsum(counts)])
        return self.ids[ranges(self.start[at], counts)], upto[first[1:]] - upto[first[:-1]]

    def _plainly(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Like _encode() for one text, every word for itself."""
        data, starts, _ = self._cut([text])
        ids, n = self.merge(*self._chars(data, starts, np.diff(np.append(starts, data.size))))
        return ids, n.sum(keepdims=True)

    def _slices(self, text: bytes) -> Iterator[bytes]:
        """text in pieces of about SLICE bytes, cut where words are."""
        while len(text) > SLICE:
            cut = text.rfind(b"\n", 1, SLICE) if self.lines else -1
            if cut < 1:
                cut = text.rfind(b" ", 1, SLICE)
                while cut > 0 and text[cut - 1] == 32:
                    cut -= 1
            if cut < 1:
                break
            yield text[:cut]
            text = text[cut:]
        yield text

    def encode_batch(self, texts: list[bytes], plainly: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts (UTF-8), one after the other, and how many each has."""
        marked = [b" " + (t.replace(_MARK, b" ") if _MARK in t else t) if t else b"" for t in texts]
        run = (lambda ts: self._plainly(ts[0])) if plainly else self._encode
        if len(marked) > 1 or not marked or len(marked[0]) <= SLICE:
            return run(marked)
        done = [run([part]) for part in self._slices(marked[0])]
        return np.concatenate([d[0] for d in done]), np.array([sum(int(d[1][0]) for d in done)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        ids, n = self.encode_batch([t.encode() for t in texts])
        return [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] if texts else []

    def round_trip(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[str]]:
        """Ids, how many each text has, and what the library decodes them to."""
        ids, n = self.encode_batch(texts)
        decoded = [self.sp.decode(x.tolist()) if x.size else "" for x in np.split(ids, np.cumsum(n)[:-1])]
        wrong = [i for i, (t, d) in enumerate(zip(texts, decoded)) if t.replace(_MARK, b" ") != d.encode()]
        if wrong:
            split = np.split(ids, np.cumsum(n)[:-1])
            for i in wrong:
                split[i], n[i : i + 1] = self.encode_batch([texts[i]], plainly=True)
                decoded[i] = self.sp.decode(split[i].tolist())
            ids = np.concatenate(split)
        return ids, n, decoded


_MODELS: dict[str, PieceModel] = {}


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def _round_trip(path: str, decode: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(path)
        for part, texts in parts(batches, size=SLICE):
            if decode:
                ids, n, decoded = m.round_trip(texts)
            else:
                (ids, n), decoded = m.encode_batch(texts), [None] * len(texts)
            offsets = np.concatenate([[0], np.cumsum(n)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)), pa.array(decoded, pa.string())], names=["doc_id", "ids", "decoded"])

    return run


def default_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def sentencepiece_round_trip(docs: DataFrame, model_path: str | None = None, key: str = "doc_id", text: str = "text", decode: bool = True) -> DataFrame:
    """doc_id, ids (without begin or end ids) and decoded (the library's decode(ids); null with decode=False) of every whole text.

    Null and empty texts have no ids and decode to the empty text. Very long texts are encoded in slices cut between words; a single word may have any length.
    Rows are independent of each other: repeated rows, ties and null ids are kept, an empty table gives an empty result, other columns are ignored, whatever
    their names. With decode=False words are told apart by 64-bit hashes only. model_path must exist on every worker.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_round_trip(model_path or default_model_path(), decode), SCHEMA)


def round_trip_digest(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of each row of sentencepiece_round_trip(); rows are independent, an empty table gives an empty result."""
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
