"""Passages of WINDOW bytes that come in a document with a smaller id too, found by suffix orders and cut out.

Documents are packed into chunks (a table). In every text each window of WINDOW bytes has an anchor: its ANCHOR bytes with the smallest hash, the leftmost of equals, so
equal windows have equal anchors at the same place. A run of windows with one anchor is a piece. What travels are pieces, and only those whose anchor comes
more than once:

1. Each chunk sends the hashes of its anchors, each with a few bits of its piece, to buckets of hashes; a bucket answers with those that come in several documents.
2. Each chunk sends its different pieces with such an anchor, with their smallest document, to buckets; equal windows meet, as their anchors are equal. A bucket lays
   the different pieces of an anchor end to end and orders their suffixes; neighbours whose first WINDOW bytes are equal form a run, and each window gets the smallest
   document of its run. The chunk gets those documents back.
3. Each chunk marks the windows that a smaller document has and cuts out what they cover.

Hot anchors: copies of a passage are one piece of a chunk and one of a bucket. An anchor with very many different pieces is cut into single windows, dealt to buckets
by all their bytes. In a bucket, anchors with more than GROUP different pieces are cut into bins of windows that share nearly all their bytes, then into
single windows, until each text to be ordered is short.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillgrid.llm.common import small_batches, table
from quillgrid.llm.scan import mix
from quillgrid.llm.suffixes import _ranges, suffix_orders

WINDOW = 50
ANCHOR = 20
#: Windows that may share an anchor.
SPAN = WINDOW - ANCHOR + 1
#: Bytes of text of a chunk (one document at least), and of the corpus for each bucket.
CHUNK = 4 << 20
BUCKET = 128 << 20
#: Different pieces of an anchor (by 16 bits of their hash) beyond which it is cut up before it travels.
HOT = 4096
#: Different pieces of an anchor that are ordered as one text, and bytes of texts ordered at once.
GROUP = 16
AT_ONCE = 1 << 19
#: Pieces of a bucket that are looked at together.
PART = 1 << 16
#: Windows of a bin: those whose anchor lies at one of so many neighbouring places.
BIN = 5
_WORDS = (WINDOW + SPAN - 1 + 7) // 8
_MASKS = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_FACTORS = np.random.Generator(np.random.PCG64(11)).integers(1, 1 << 63, 2 * _WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
#: Where the further eights of an anchor's bytes begin.
_INNER = (*range(8, ANCHOR - 8, 8), ANCHOR - 8)
_NO_ID = np.iinfo(np.int64).max
_LOW32 = np.uint64(0xFFFFFFFF)

CHUNKS = "chunk bigint, ids binary, lens binary, runs binary, offs binary, data binary"


def _pack(a: np.ndarray | bytes) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(a if isinstance(a, bytes) else np.ascontiguousarray(a).tobytes())


def _unpack(raw: bytes, kind: str) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), kind)


def _view(data: np.ndarray, kind: str = "<u8", behind: int = 0) -> np.ndarray:
    """The number that begins `behind` each byte. data has 8 * _WORDS bytes more at its end than are asked for."""
    return np.ndarray((data.size - 8 * _WORDS,), kind, data.data, behind, (1,))


def padded(data: bytes) -> np.ndarray:
    return np.frombuffer(data + bytes(8 * _WORDS), np.uint8)


def windows_of(lens: np.ndarray) -> np.ndarray:
    """Where the windows of texts laid end to end begin."""
    fit = np.maximum(lens - WINDOW + 1, 0)
    return _ranges(np.cumsum(lens) - lens, fit)


def anchor_runs(data: np.ndarray, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of windows that share an anchor: how many windows, and how far the anchor lies behind the first window's beginning."""
    starts = windows_of(lens)
    if not starts.size:
        return np.empty(0, np.uint8), np.empty(0, np.uint8)
    size = int(lens.sum())
    low = _view(data)[:size] * _FACTORS[0]
    for k, behind in enumerate(_INNER, 1):
        low += _view(data, "<u8", behind)[:size] * _FACTORS[k]
    low ^= low >> np.uint64(31)
    low *= _FACTORS[-1]
    low &= ~_LOW32
    low |= np.arange(size, dtype=np.uint64)
    reach = 1
    while reach * 2 <= SPAN:
        np.minimum(low[:-reach], low[reach:], out=low[:-reach])
        reach *= 2
    at = np.minimum(low[starts], low[starts + (SPAN - reach)])
    at &= _LOW32
    at = at.astype(np.int64)
    first = np.nonzero(np.concatenate([[True], at[1:] != at[:-1]]))[0]
    return np.diff(np.append(first, starts.size)).astype(np.uint8), (at[first] - starts[first]).astype(np.uint8)


def pack_chunks(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """docs in chunks of about CHUNK bytes, as a table: ids, lengths, bytes, and the runs of windows. Null ids are put last, null texts are empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, ids, texts, size, n = TaskContext.get().partitionId() << 32, [], [], 0, 0

        def flush() -> pa.RecordBatch:
            lens, data = np.array([len(t) for t in texts], np.int64), padded(b"".join(texts))
            runs, offs = anchor_runs(data, lens)
            cells = [base + n, _pack(np.array(ids, np.int64)), _pack(lens), _pack(runs), _pack(offs), _pack(data[: data.size - 8 * _WORDS])]
            return pa.RecordBatch.from_arrays([pa.array([c]) for c in cells], names=["chunk", "ids", "lens", "runs", "offs", "data"])

        for batch in batches:
            for i, t in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                t = t or b""
                if texts and size + len(t) > CHUNK:
                    yield flush()
                    ids, texts, size, n = [], [], 0, n + 1
                ids.append(_NO_ID if i is None else i)
                texts.append(t)
                size += len(t)
        if texts:
            yield flush()

    small_batches(docs.sparkSession)
    return table(docs.select(docs[f"`{key}`"].cast("bigint").alias("k"), docs[f"`{text}`"].cast("string").alias("t")).mapInArrow(run, CHUNKS))


class Chunk:
    """A chunk read back: ids and lens of its documents, its bytes, and per run its first window, number of windows, anchor, document and anchor hash."""

    def __init__(self, row: dict):
        self.ids, self.lens = _unpack(row["ids"], "<i8"), _unpack(row["lens"], "<i8")
        self.data = padded(zstandard.ZstdDecompressor().decompress(row["data"]))
        self.n, self.off = _unpack(row["runs"], "u1").astype(np.int64), _unpack(row["offs"], "u1").astype(np.int64)
        self.start = windows_of(self.lens)[np.cumsum(self.n) - self.n]
        self.doc = np.searchsorted(np.cumsum(self.lens), self.start, "right")
        self.key = anchor_keys(self.data, self.start + self.off)


def anchor_keys(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Hashes of 47 bits of the anchors at `at`."""
    key = mix(_view(data)[at] + _FACTORS[0])
    for behind in _INNER:
        key = mix(key + _view(data, "<u8", behind)[at])
    return key >> np.uint64(17)


def piece_words(data: np.ndarray, start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """The bytes of pieces as _WORDS numbers each, zero behind their end."""
    view, size = _view(data), n + WINDOW - 1
    out = np.empty((start.size, _WORDS), np.uint64)
    for k in range(_WORDS):
        out[:, k] = view[np.minimum(start + 8 * k, view.size - 1)] & _MASKS[np.clip(size - 8 * k, 0, 8)]
    return out


def word_hash(words: np.ndarray, n: np.ndarray) -> np.ndarray:
    h = n.astype(np.uint64)
    for k in range(_WORDS):
        h = mix(h + words[:, k] * _FACTORS[5 + k])
    return h


def different(words: np.ndarray, n: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(one row of each different piece, its smallest id, the number of each row's piece). Equal by all bytes; hashes only bring them together."""
    h = word_hash(words, n)
    by = np.argsort(h, kind="stable")
    w, m = words[by], n[by]
    new = np.concatenate([[True], (w[1:] != w[:-1]).any(1) | (m[1:] != m[:-1])]) if by.size else np.empty(0, bool)
    first = np.nonzero(new)[0]
    number = np.empty(by.size, np.int64)
    number[by] = np.cumsum(new) - 1
    return by[first], np.minimum.reduceat(ids[by], first) if first.size else ids[:0], number


# 1. anchors that come in several documents


def _send_anchors(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                c = Chunk(row)
                if not c.key.size:
                    continue
                some = (word_hash(piece_words(c.data, c.start, c.n), c.n) >> np.uint64(48)).astype(np.uint64)
                sent = (c.key << np.uint64(17)) | (some << np.uint64(1))
                by = np.argsort(sent, kind="stable")
                sent, key, ids = sent[by], c.key[by], c.ids[c.doc[by]]
                first = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
                several = np.minimum.reduceat(ids, first) < np.maximum.reduceat(ids, first)
                sent |= np.repeat(several, np.diff(np.append(first, key.size))).astype(np.uint64)
                sent = sent[np.concatenate([[True], sent[1:] != sent[:-1]])]
                yield _dealt(row["chunk"], (sent >> np.uint64(17)) % np.uint64(buckets), lambda i, sent=sent: [sent[i].tobytes()])

    return run


def _dealt(chunk: int, bucket: np.ndarray, cells, columns: tuple[str, ...] = ("sent",)) -> pa.RecordBatch:
    """One row for each bucket that something goes to: bucket, chunk and what cells(places) gives."""
    by = np.argsort(bucket, kind="stable")
    first = np.nonzero(np.concatenate([[True], bucket[by][1:] != bucket[by][:-1]]))[0] if by.size else np.empty(0, int)
    parts = np.split(by, first[1:]) if by.size else []
    rows = [cells(i) for i in parts]
    return pa.RecordBatch.from_arrays(
        [pa.array([int(bucket[i[0]]) for i in parts], pa.int64()), pa.array([chunk] * len(parts), pa.int64()), *(pa.array([r[k] for r in rows], pa.binary()) for k in range(len(columns)))],
        names=["bucket", "chunk", *columns],
    )


def _answer_anchors(bucket: pa.Table) -> pa.Table:
    """For each chunk those of its anchors that come in several documents; hot: those with very many different pieces."""
    sent = [np.frombuffer(b, "<u8") for b in bucket["sent"].to_pylist()]
    rows, every = np.repeat(np.arange(len(sent)), [s.size for s in sent]), np.concatenate(sent)
    by = np.argsort(every, kind="stable")
    every, rows = every[by], rows[by]
    key = every >> np.uint64(17)
    first = np.nonzero(np.concatenate([[True], key[1:] != key[:-1]]))[0]
    count = np.diff(np.append(first, key.size))
    piece = every >> np.uint64(1)
    kinds = np.add.reduceat(np.concatenate([[True], piece[1:] != piece[:-1]]).astype(np.int64), first)
    shared = (np.maximum.reduceat(every & np.uint64(1), first) > 0) | (np.minimum.reduceat(rows, first) < np.maximum.reduceat(rows, first))
    keep = np.repeat(shared, count)
    key, rows, hot = key[keep], rows[keep], np.repeat(kinds > HOT, count)[keep]
    by = np.argsort(rows, kind="stable")
    key, rows, hot = key[by], rows[by], hot[by]
    edges = np.searchsorted(rows, np.arange(len(sent) + 1))
    out = [(key[a:b], hot[a:b]) for a, b in zip(edges[:-1], edges[1:])]
    keys = [np.unique(k) for k, _ in out]
    return pa.table({"chunk": bucket["chunk"], "shared": pa.array([_pack(k) for k in keys], pa.binary()), "hot": pa.array([_pack(np.unique(k[h])) for k, h in out], pa.binary())})


# 2. pieces to buckets, smallest documents back


class Pieces:
    """The different pieces of a chunk that travel, and for each occurrence its piece, first window and document."""

    def __init__(self, c: Chunk, answers: list[dict], buckets: int):
        joined = lambda name: np.unique(np.concatenate([np.empty(0, np.uint64), *(_unpack(a[name], "<u8") for a in answers)]))
        shared, hot = joined("shared"), joined("hot")
        take = np.nonzero(_among(c.key, shared))[0]
        start, n, off, doc = c.start[take], c.n[take], c.off[take], c.doc[take]
        if hot.size:
            single = _among(c.key[take], hot)
            some = np.nonzero(single)[0]
            begin, rest = _ranges(start[some], n[some]), np.nonzero(~single)[0]
            gone = begin - np.repeat(start[some], n[some])
            start, off = np.concatenate([start[rest], begin]), np.concatenate([off[rest], np.repeat(off[some], n[some]) - gone])
            doc, n = np.concatenate([doc[rest], np.repeat(doc[some], n[some])]), np.concatenate([n[rest], np.ones(begin.size, np.int64)])
        # single windows of a hot anchor are dealt by all their bytes
        cut = _among(anchor_keys(c.data, start + off), hot)
        words = piece_words(c.data, start, n)
        self.start, self.doc = start, doc
        one, self.ids, self.piece = different(words, n, c.ids[doc])
        self.words, self.n, self.off, cut = words[one], n[one], off[one], cut[one]
        by = np.where(cut, word_hash(self.words, self.n), anchor_keys(c.data, start[one] + self.off))
        self.bucket = ((mix(by) >> np.uint64(1)) % np.uint64(buckets)).astype(np.int64)
        self.cut = cut


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in the sorted `known`."""
    if not known.size:
        return np.zeros(values.size, bool)
    return known[np.minimum(np.searchsorted(known, values), known.size - 1)] == values


def _send_pieces(buckets: int):
    def run(key: tuple, chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows or not answers.num_rows:
            return pa.table({"bucket": pa.array([], pa.int64()), "chunk": pa.array([], pa.int64()), "sent": pa.array([], pa.binary())})
        row = chunk.to_pylist()[0]
        p = Pieces(Chunk(row), answers.to_pylist(), buckets)

        def cells(i):
            size = p.n[i] + WINDOW - 1
            data = p.words[i].view(np.uint8).reshape(i.size, -1)
            head = np.concatenate([p.n[i].astype(np.uint8), p.off[i].astype(np.uint8), p.cut[i].astype(np.uint8)]).tobytes()
            return [_pack(np.array([i.size], "<i8").tobytes() + head + p.ids[i].tobytes() + data[np.arange(data.shape[1]) < size[:, None]].tobytes())]

        return pa.Table.from_batches([_dealt(row["chunk"], p.bucket, cells)])

    return run


def _read_pieces(raw: bytes) -> tuple[np.ndarray, ...]:
    raw = zstandard.ZstdDecompressor().decompress(raw)
    size = int(np.frombuffer(raw, "<i8", 1)[0])
    n, off, cut = np.frombuffer(raw, "u1", 3 * size, 8).reshape(3, size)
    ids = np.frombuffer(raw, "<i8", size, 8 + 3 * size)
    data = padded(raw[8 + 11 * size :])
    n = n.astype(np.int64)
    ends = np.cumsum(n + WINDOW - 1)
    return piece_words(data, ends - (n + WINDOW - 1), n), n, off.astype(np.int64), cut.astype(bool), ids


def smallest_ids(words: np.ndarray, n: np.ndarray, off: np.ndarray, cut: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For each window of each of these different pieces, in order, the smallest id that any piece with an equal window has."""
    out = np.repeat(ids, n)
    data = padded(words.tobytes())
    start = np.arange(n.size) * 8 * _WORDS
    key = np.where(cut, word_hash(words, n), anchor_keys(data, start + off))
    # pieces as: first byte, windows, place of the anchor, id, where their windows stand in out
    level, todo, equal = SPAN, (start, n, off, ids, np.cumsum(n) - n, key), []
    while True:
        start, n, off, ids, into, key = todo
        by = np.argsort(key, kind="stable")
        edge = np.nonzero(np.concatenate([[True], key[by][1:] != key[by][:-1]]))[0] if by.size else np.empty(0, int)
        many = np.diff(np.append(edge, by.size))
        short = np.repeat((many <= GROUP) | (level == 1), many)
        _settle(data, start, n, into, ids, by[short], key, out)
        rest = by[~short]
        if not rest.size:
            break
        level = BIN if level == SPAN else 1
        todo = _binned(data, start[rest], n[rest], off[rest], ids[rest], into[rest], level, out, equal)
    for into, source, size in reversed(equal):
        out[_ranges(into, size)] = out[_ranges(source, size)]
    return out


def _binned(data, start, n, off, ids, into, level: int, out: np.ndarray, equal: list):
    """Pieces cut so that the anchor of a part's windows lies in one bin of `level` places. Of equal parts one goes on, with the smallest id; `equal` tells where the
    others find what it gets."""
    place = np.repeat(off, n) - _ranges(np.zeros(n.size, np.int64), n)
    owner = np.repeat(np.arange(n.size), n)
    bins = place // level
    edge = np.nonzero(np.concatenate([[True], (owner[1:] != owner[:-1]) | (bins[1:] != bins[:-1])]))[0]
    size = np.diff(np.append(edge, owner.size))
    owner, gone = owner[edge], off[owner[edge]] - place[edge]
    start, off, ids, into = start[owner] + gone, place[edge], ids[owner], into[owner] + gone
    one, least, number = different(piece_words(data, start, size), size, ids)
    equal.append((into, into[one][number], size))
    start, size, off, ids, into = start[one], size[one], off[one], least, into[one]
    out[_ranges(into, size)] = np.repeat(ids, size)
    # the bytes that every window of the bin has: from the beginning of the one with the lowest place to the end of the one with the highest
    low = off // level * level
    common, inner = mix(low.astype(np.uint64) + _FACTORS[0]), WINDOW - level + 1
    for k in (*range(0, inner - 8, 8), inner - 8):
        common = mix(common + _view(data)[start + off - low + k])
    return start, size, off, ids, into, common


def _settle(data, start, n, into, ids, which, key, out) -> None:
    """Orders the suffixes of the pieces `which` (sorted by their key), key by key, and puts the smallest ids into out.

    A piece that is alone with its key needs no order: equal windows have equal anchors at the same place, so no two windows of one piece are equal."""
    first = np.concatenate([[True], key[which][1:] != key[which][:-1]])[: which.size]
    which = which[~(first & np.append(first[1:], True)[: which.size])]
    if not which.size:
        return
    size = n[which] + WINDOW - 1
    groups = key[which]
    edge = np.nonzero(np.concatenate([[True], groups[1:] != groups[:-1]]))[0]
    length = np.add.reduceat(size + 1, edge)
    # short texts first, so that texts of like length are ordered together
    rank = np.argsort(length, kind="stable")
    total, at = np.cumsum(length[rank]), 0
    count = np.diff(np.append(edge, which.size))
    while at < rank.size:
        end = max(at + 1, int(np.searchsorted(total, (total[at - 1] if at else 0) + AT_ONCE, "right")))
        some = rank[at:end]
        _order(data, start, n, into, ids, which[_ranges(edge[some], count[some])], count[some], length[some], out)
        at = end


def _order(data, start, n, into, ids, pieces, count, length, out) -> None:
    size = n[pieces] + WINDOW - 1
    ends = np.cumsum(size + 1)
    begin = ends - size - 1
    codes = np.zeros(ends[-1], np.uint16)  # 0 stands behind every piece
    inside = np.ones(ends[-1], bool)
    inside[ends - 1] = False
    source = _ranges(start[pieces], size)
    codes[inside] = data[source].astype(np.uint16) + 1
    order = suffix_orders(codes, length)
    # suffixes that begin a window
    piece = np.repeat(np.arange(pieces.size), size + 1)
    offset = np.arange(ends[-1]) - begin[piece]
    order = order[offset[order] < n[pieces][piece[order]]]
    text = np.repeat(np.arange(count.size), count)[piece[order]]
    at = start[pieces][piece[order]] + offset[order]
    view = _view(data)
    same = text[1:] == text[:-1]
    for k in (*range(0, WINDOW - 8, 8), WINDOW - 8):
        word = view[at + k]
        same &= word[1:] == word[:-1]
    first = np.nonzero(np.concatenate([[True], ~same]))[0]
    least = np.minimum.reduceat(ids[pieces][piece[order]], first)
    where = into[pieces][piece[order]] + offset[order]
    np.minimum.at(out, where, np.repeat(least, np.diff(np.append(first, order.size))))


def _answer_pieces(bucket: pa.Table) -> pa.Table:
    """For each chunk the smallest document of every window of the pieces that it sent, as runs. Equal anchors lie in one part of the bucket; parts come in turn."""
    sent = [_read_pieces(b) for b in bucket["sent"].to_pylist()]
    words, n, off, cut, ids = (np.concatenate([s[k] for s in sent]) for k in range(5))
    chunk_of = np.repeat(np.arange(len(sent)), [s[1].size for s in sent])
    del sent
    key = np.empty(n.size, np.uint64)
    for at in range(0, n.size, PART):
        part = slice(at, at + PART)
        w = words[part]
        key[part] = mix(np.where(cut[part], word_hash(w, n[part]), anchor_keys(padded(w.tobytes()), np.arange(len(w)) * 8 * _WORDS + off[part])))
    by = np.argsort(key, kind="stable")
    many, found = max(1, n.size // PART), []
    for of in np.split(by, np.searchsorted(key[by], np.arange(1, many, dtype=np.uint64) * np.uint64(((1 << 64) - 1) // many))) if n.size else []:
        if not of.size:
            continue
        of = np.sort(of)
        w, m = words[of], n[of]
        one, least, number = different(w, m, ids[of])
        small = smallest_ids(w[one], m[one], off[of][one], cut[of][one], least)
        # runs of equal documents, none beyond a piece
        first = np.cumsum(m[one]) - m[one]
        new = np.ones(small.size, bool)
        new[1:] = small[1:] != small[:-1]
        new[first] = True
        edge = np.nonzero(new)[0]
        size, head = np.diff(np.append(edge, small.size)), np.searchsorted(edge, first)
        runs = np.diff(np.append(head, edge.size))[number]
        pick = _ranges(head[number], runs)
        found.append((np.repeat(of, runs), size[pick].astype(np.uint8), small[edge][pick]))
    piece, size, docs = (np.concatenate([f[k] for f in found]) for k in range(3))
    by = np.argsort(piece, kind="stable")
    piece, size, docs = piece[by], size[by], docs[by]
    cuts = np.searchsorted(chunk_of[piece], np.arange(bucket.num_rows + 1))
    rows = [_pack(np.array([b - a], "<i8").tobytes() + size[a:b].tobytes() + docs[a:b].tobytes()) for a, b in zip(cuts[:-1], cuts[1:])]
    return pa.table({"chunk": bucket["chunk"], "bucket": bucket["bucket"], "least": pa.array(rows, pa.binary())})


# 3. what is covered goes


def _cut_out(buckets: int):
    schema = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64())), ("kept", pa.binary())])

    def run(key: tuple, chunk: pa.Table, answers: pa.Table) -> pa.Table:
        if not chunk.num_rows:
            return schema.empty_table()
        c = Chunk(chunk.to_pylist()[0])
        begin = np.cumsum(c.lens) - c.lens
        change = np.zeros(int(c.lens.sum()) + 1, np.int32)
        answers = answers.to_pylist()
        if any(a["least"] is not None for a in answers):
            p = Pieces(c, [a for a in answers if a["shared"] is not None], buckets)
            least = np.empty(int(p.n.sum()), np.int64)
            first = np.cumsum(p.n) - p.n
            for a in answers:
                if a["least"] is not None:
                    raw = zstandard.ZstdDecompressor().decompress(a["least"])
                    size = int(np.frombuffer(raw, "<i8", 1)[0])
                    mine = np.nonzero(p.bucket == a["bucket"])[0]
                    least[_ranges(first[mine], p.n[mine])] = np.repeat(np.frombuffer(raw, "<i8", size, 8 + size), np.frombuffer(raw, "u1", size, 8))
            n = p.n[p.piece]
            gone = least[_ranges(first[p.piece], n)] < np.repeat(c.ids[p.doc], n)
            at = _ranges(p.start, n)[gone]
            np.add.at(change, at, 1)
            np.add.at(change, at + WINDOW, -1)
        covered = np.cumsum(change[:-1]) > 0
        # runs of covered bytes, none beyond a document
        joint = covered.copy()
        joint[1:] &= ~covered[:-1]
        heads = begin[c.lens > 0]
        joint[heads] = covered[heads]
        starts = np.nonzero(joint)[0]
        stop = covered.copy()
        stop[:-1] &= ~covered[1:]
        tails = heads + c.lens[c.lens > 0] - 1
        stop[tails] = covered[tails]
        ends = np.nonzero(stop)[0] + 1
        of = np.searchsorted(begin + c.lens, starts, "right")
        edges = np.searchsorted(of, np.arange(c.lens.size + 1)).astype(np.int32)
        data = c.data[: covered.size]
        kept = data[~covered].tobytes()
        left = np.concatenate([[0], np.cumsum(~covered)])[np.append(begin, covered.size)].astype(np.int32)
        lists = lambda v: pa.ListArray.from_arrays(pa.array(edges), pa.array(v - begin[of]))
        binary = pa.Array.from_buffers(pa.binary(), c.lens.size, [None, pa.py_buffer(left), pa.py_buffer(kept)])
        ids = pa.array(c.ids, mask=c.ids == _NO_ID)
        return pa.Table.from_arrays([ids, pa.array(c.lens), lists(starts), lists(ends), binary], schema=schema)

    return run


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_bytes, starts, ends and kept of every row: the byte ranges covered by windows of WINDOW bytes that come in a row with a smaller id, and what remains.

    A null text is empty, and texts shorter than a window lose nothing. A row without an id comes after all others (the largest bigint counts as none). Rows with the
    same id take nothing from each other. Ties of anchors go to the leftmost. Long texts are taken whole and are chunks of their own. An empty table gives an
    empty result; other columns are ignored, whatever their names. What is kept is bytes: a cut may fall inside a character.
    """
    spark = docs.sparkSession
    total = docs.agg(F.sum(F.octet_length(docs[f"`{text}`"].cast("string")))).first()[0] or 0
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // BUCKET))
    chunks = pack_chunks(docs, key, text)
    sent = chunks.mapInArrow(_send_anchors(buckets), "bucket bigint, chunk bigint, sent binary")
    shared = table(sent.groupBy("bucket").applyInArrow(_answer_anchors, "chunk bigint, shared binary, hot binary"))
    pieces = chunks.groupBy("chunk").cogroup(shared.groupBy("chunk")).applyInArrow(_send_pieces(buckets), "bucket bigint, chunk bigint, sent binary")
    least = pieces.groupBy("bucket").applyInArrow(_answer_pieces, "chunk bigint, bucket bigint, least binary")
    none = lambda *names: [F.lit(None).cast("binary" if n != "bucket" else "bigint").alias(n) for n in names]
    answers = table(shared.select("chunk", *none("bucket"), "shared", "hot", *none("least")).unionByName(least.select("chunk", "bucket", *none("shared", "hot"), "least")))
    return chunks.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_cut_out(buckets), "doc_id bigint, n_bytes bigint, starts array<bigint>, ends array<bigint>, kept binary")


def repeats_digest(kept: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of without_repeats()."""
    removed = F.col("n_bytes") - F.octet_length("kept")
    return kept.select("doc_id", "n_bytes", removed.cast("bigint").alias("n_removed"), F.size("starts").cast("bigint").alias("n_spans"), F.sha2(F.col("kept"), 256).alias("kept_sha256"))
