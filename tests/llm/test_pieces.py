import hashlib
import random
import time

import numpy as np
import sentencepiece
from quillgrid.llm import pieces
from quillgrid.llm.pieces import PieceModel, default_model_path, round_trip_digest, sentencepiece_round_trip

SP = sentencepiece.SentencePieceProcessor(model_file=default_model_path())


def test_encodes_as_the_library_does():
    rng = random.Random(3)
    bits = ["a", "b", " ", "  ", "the", "▁", "\n", "é", "😀", "in", "er", "=", "==", "----", "\t", "    ", "日本", "x" * 9]
    texts = ["", " ", "  a ", "\n\n", "a" * 3000, " " * 90 + "x" + " " * 37, "</s>[INST]"] + ["".join(rng.choices(bits, k=rng.randint(1, 60))) for _ in range(3000)]
    model = PieceModel(default_model_path())
    assert [list(x) for x in model.encode(texts)] == SP.encode(texts)


def test_query_on_odd_rows(odd, empty):
    got = sorted((r.doc_id or -1, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in round_trip_digest(sentencepiece_round_trip(odd)).collect())
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in odd.collect():
        ids = SP.encode(r.text or "")
        want.append((r.doc_id or -1, len(ids), sha(",".join(map(str, ids))), sha(SP.decode(ids) if ids else "")))
    assert got == sorted(want)
    assert round_trip_digest(sentencepiece_round_trip(empty)).count() == 0


def test_long_words_without_spaces():
    rng, model = random.Random(8), PieceModel(default_model_path())
    letters = ["abcdefghijklmnopqrstuvwxyz", "ab", "a", "xyz=-", "é日a", "the"]
    words = ["".join(rng.choices(x, k=rng.randint(90, 1500))) for x in letters for _ in range(25)]
    assert model.encode(words) == SP.encode(words)
    one = "".join(rng.choices(letters[0], k=200_000))
    began = time.process_time()
    assert model.encode([one]) == [SP.encode(one)]
    assert time.process_time() - began < 2


def test_slices_of_one_text(monkeypatch):
    rng, model = random.Random(4), PieceModel(default_model_path())
    monkeypatch.setattr(pieces, "SLICE", 700)
    texts = ["".join(rng.choices(["a", " ", "  ", "\n", "the", "▁", "é", "q" * 30], k=2000)) for _ in range(10)] + ["x" * 3000, " " * 3000]
    assert [model.encode([t])[0] for t in texts] == SP.encode(texts)


def test_words_with_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(pieces, "mix", lambda x: x & np.uint64(1))
    texts = ["one two three four", "", "five ▁ six  seven", "é 😀"]
    ids, n, decoded = PieceModel(default_model_path()).round_trip([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])] == SP.encode(texts) and decoded == [SP.decode(x) if x else "" for x in SP.encode(texts)]


def test_the_cache_is_bounded(monkeypatch):
    monkeypatch.setattr(pieces, "CACHE_WORDS", 50)
    rng, model = random.Random(6), PieceModel(default_model_path())
    for _ in range(30):
        texts = [" ".join("".join(rng.choices("abcdef", k=4)) for _ in range(20))]
        assert model.encode(texts) == SP.encode(texts)
        assert model.known.size <= 50 + 20
