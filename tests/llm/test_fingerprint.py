import hashlib
import random

import numpy as np

from tessera.llm import fingerprint as fp


def test_hash_is_a_rolling_gear():
    raw = bytes(random.Random(1).randrange(256) for _ in range(300))
    h, want = 0, []
    for i in range(len(raw)):
        h = 0
        for j in range(min(i + 1, 32)):
            h = (h + (int(fp.GEAR[raw[i - j]]) << j)) & 0xFFFFFFFF
        want.append(h)
    assert fp._hashes(np.frombuffer(raw, np.uint8)).tolist() == want


def test_chunks_cover_and_resist_shifts():
    rng = random.Random(2)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randrange(2, 9))) for _ in range(2000))
    raw = text.encode()
    ends = fp.chunk_ends(raw)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(raw) and sizes.max() <= fp.MOST and sizes[:-1].min() >= fp.LEAST
    assert 40 < sizes.mean() < 100
    a, b = fp.fingerprint(text), fp.fingerprint("shifted " + text)
    assert fp.containment(a, b) > 0.97
    assert fp.containment(a, fp.fingerprint(text[: len(text) * 3 // 4])) > 0.7


def test_step_does_not_change_candidates(monkeypatch):
    raw = bytes(random.Random(4).randrange(97, 105) for _ in range(5000))
    want = fp.candidates(raw)
    monkeypatch.setattr(fp, "_STEP", 700)
    assert fp.candidates(raw) == want


def test_documents_against_brute_force(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(50)]
    rows = [(i * 7 % 101, " ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 30, 400])))) for i in range(60)]
    rows += [(3000, None), (3001, ""), (9, "é" * 1000), (9, "copy"), (None, "no id"), (None, "a second")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as bucket", "0 as guest").repartition(7)
    rows += [(None, f"nobody {i}") for i in range(40)] + [(77, f"one id {i % 30}") for i in range(60)] + [(None, "nobody 3")] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as bucket", "0 as guest").repartition(7)
    hashed = {r.t: r.h for r in spark.createDataFrame([(t or "",) for _, t in rows], "t string").selectExpr("t", "xxhash64(t) AS h").collect()}
    for buckets in (1, 5, 64):
        got = fp.fingerprints(docs, buckets).collect()
        order = sorted(((i is not None, i or 0, hashed[t or ""], t or "") for i, t in rows))
        want = []
        for k, (has, i, _, t) in enumerate(order):
            nxt = order[(k + 1) % len(order)][3]
            new = t[: len(t) - len(t) // 4] + nxt[: len(t) // 4]
            a = fp.fingerprint(t)
            want.append((i if has else None, len(t), hashlib.sha256(new.encode()).hexdigest(), fp.as_string(a), fp.as_string(fp.fingerprint(new)), fp.containment(a, fp.fingerprint(new)), fp.containment(a, fp.fingerprint(nxt))))
        key = lambda r: tuple(str(x) for x in r)
        assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert fp.fingerprints(docs.limit(0)).count() == 0


def test_short_texts_keep_what_is_unchanged():
    rng = random.Random(6)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(500)]
    for n, floor, least in ((5, 0.95, 0.5), (8, 0.99, 0.6), (14, 1.0, 0.65), (25, 1.0, 0.65)):
        near, far = [], []
        for _ in range(300):
            a, b = (" ".join(rng.choice(words) for _ in range(n)) for _ in range(2))
            fa = fp.fingerprint(a)
            near.append(fp.containment(fa, fp.fingerprint(fp.edited(a, b))))
            far.append(fp.containment(fa, fp.fingerprint(b)))
        assert np.mean(np.array(near) > 0) >= floor and np.mean(near) > least and np.mean(far) < 0.1, (n, np.mean(np.array(near) > 0), np.mean(near), np.mean(far))


def test_fine_chunks_below_the_bound_only():
    rng = random.Random(7)
    for n in (1, 40, fp.FINE_BELOW - 1, fp.FINE_BELOW, 3000):
        text = "".join(rng.choice("abcdefghij ") for _ in range(n))
        got = fp.fingerprint(text)
        fine = [k for k in got if k.startswith("~")]
        assert bool(fine) == (n < fp.FINE_BELOW)
        ends = fp.chunk_ends(text.encode(), *fp.FINE, fp.FINE_WINDOW)
        assert ends[-1] == n and np.diff([0, *ends]).max() <= fp.FINE[2]
        assert fp.containment(got, got) == 1 and fp.containment(got, fp.fingerprint("")) == 0 and fp.containment(fp.fingerprint(""), got) == 0
    long = fp.fingerprint("".join(rng.choice("abcdefghij ") for _ in range(3000)))
    assert fp.containment(fp.fingerprint("abc"), long) == 0


def plain_chunks(raw, least, normal, most, window):
    """Normalised gear chunking byte by byte."""
    bits, ends, start = normal.bit_length() - 1, [], 0
    while start < len(raw):
        end = min(start + most, len(raw))
        for i in range(start + least - 1, end):
            h = sum(int(fp.GEAR[raw[i - j]]) << j for j in range(min(window, i + 1))) & 0xFFFFFFFF
            if window < 32:
                h = h << (32 - window) & 0xFFFFFFFF
            size = i + 1 - start
            if h >> 32 - bits - 1 == 0 if size < normal else h >> 32 - bits + 1 == 0:
                end = i + 1
                break
        ends.append(end)
        start = end
    return ends


def test_chunks_against_a_byte_loop():
    rng = random.Random(9)
    for n in (0, 1, 15, 16, 17, 300, 1500):
        raw = bytes(rng.choice(b"abcdefgh ij") for _ in range(n))
        assert fp.chunk_ends(raw) == plain_chunks(raw, fp.LEAST, fp.NORMAL, fp.MOST, fp.WINDOW)
        assert fp.chunk_ends(raw, *fp.FINE, fp.FINE_WINDOW) == plain_chunks(raw, *fp.FINE, fp.FINE_WINDOW)
