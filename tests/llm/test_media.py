import hashlib
import zlib

import numpy as np
from quillgrid.llm.media import BANDS, fingerprint, from_wav, media_columns, media_digest, to_wav


def test_round_trip_and_digest(odd, empty):
    want = []
    for r in odd.collect():
        data = (r.text or "").encode()
        payload = data + b"\xff" * (-len(data) % 576 if data else 576)
        media = to_wav(data)
        assert from_wav(media) == payload
        want.append((r.doc_id or -1, len(data), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:]), len(media), hashlib.sha256(media).hexdigest()))
    rows = media_digest(odd).collect()
    assert sorted((r.doc_id or -1, *r[1:7]) for r in rows) == sorted(want)
    by_text = {}
    for r in rows:
        by_text.setdefault(r.payload_sha256, set()).add(r.feature)
    assert all(len(v) == 1 for v in by_text.values())
    assert media_digest(empty).count() == 0


def test_fingerprint_is_local_in_time():
    """A passage that moves by whole frames keeps its hash codes, at later times."""
    passage = bytes((i * i * 7 + i) % 251 for i in range(576 * 4))
    t0, c0 = fingerprint(b"\xff" * 576 * 2 + passage + b"\xff" * 576 * 2)
    t1, c1 = fingerprint(b"\xff" * 576 * 6 + passage + b"\xff" * 576 * 2)
    assert len(c0) > 10 and set(zip(t0 + 8, c0)) & set(zip(t1, c1))


def test_media_columns_has_the_stored_bytes(odd):
    r = media_columns(odd.where("doc_id = 5")).first()
    assert from_wav(bytes(r.media))[:7] == b"one two" and len(r.fp_time) == len(r.fp_code)


def test_feature_against_a_plain_transform():
    """Peaks and pairs found frame by frame, with a Fourier sum written out."""
    rng = np.random.Generator(np.random.PCG64(2))
    samples = bytes(rng.integers(97, 123, 576 * 3).astype(np.uint8)) + b"\xff" * 576
    k = np.outer(np.arange(289), np.arange(576))
    angle = 2 * np.pi * k / 576
    window = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(576) / 575)
    frames = [(np.frombuffer(samples[at : at + 576], np.uint8).astype(float) - 128) * window for at in range(0, len(samples) - 575, 288)]
    power = [(np.cos(angle) @ f) ** 2 + (np.sin(angle) @ f) ** 2 for f in frames]
    peaks = []
    for t, p in enumerate(power):
        for lo, hi in zip(BANDS, BANDS[1:]):
            top = lambda i, lo=lo, hi=hi: power[i][lo:hi].max() if 0 <= i < len(power) else -1.0
            if top(t) >= top(t - 1) and top(t) > top(t + 1):
                peaks.append((t, lo + int(p[lo:hi].argmax())))
    pairs = sorted((t, f << 15 | g << 6 | u - t) for i, (t, f) in enumerate(peaks) for u, g in peaks[i + 1 : i + 4] if u - t <= 63)
    times, codes = fingerprint(samples)
    assert len(pairs) > 20 and list(zip(times.tolist(), codes.tolist())) == pairs
