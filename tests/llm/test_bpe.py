import hashlib
import random

from tessera.llm import bpe


def _enc():
    path, pattern = bpe.multi_50k()
    return bpe.encoder(bpe.read_ranks(path), pattern)


def test_chunks_equal_whole_encoding():
    enc, rx = _enc()
    rng = random.Random(3)
    alphabet = ["a", "Zé", " ", "  ", "\n", "\t \n", "'s", "'ll", "12", "?!", "ß", "漢", " ", " ", "🙂", "."]
    for n in (0, 1, 30, 400):
        for _ in range(40):
            text = "".join(rng.choice(alphabet) for _ in range(n))
            got = bpe.encode(text, enc, rx, size=16, overlap=8)
            assert got == enc.encode_ordinary(text)
            assert enc.decode_bytes(got) == text.encode()


def test_no_stitch_in_overlap():
    enc, rx = _enc()
    for text in ("x" * 500, " " * 500, "ab " + "y" * 300 + " cd" * 50, "\n" * 99 + "z"):
        assert bpe.encode(text, enc, rx, size=16, overlap=8) == enc.encode_ordinary(text)


def test_documents(spark):
    enc, _ = _enc()
    long = "lorem ipsum  dolor\n\n" * 40 + "q" * 200 + " end"
    rows = [(1, "Hello world's end"), (2, None), (3, ""), (4, long), (4, long), (None, "x y"), (5, "w" * 600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'a' as ids", "1 as uid")
    got = sorted((r.doc_id or 0, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(docs, *bpe.multi_50k(), size=64, overlap=16, long_chars=100).collect())
    want = []
    for i, t in rows:
        ids = enc.encode_ordinary(t or "")
        want.append((i or 0, len(ids), hashlib.sha256(bpe.id_bytes(ids)).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe.digests(docs.limit(0), *bpe.multi_50k()).count() == 0


def plain_ids(text, ranks, rx):
    """Rank merges one pair at a time, pre-token by pre-token."""
    out = []
    for m in rx.finditer(text):
        parts = [bytes([b]) for b in m[0].encode()]
        while len(parts) > 1:
            ranked = [(ranks.get(a + b, 1 << 40), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
            rank, i = min(ranked)
            if rank == 1 << 40:
                break
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        out += [ranks[p] for p in parts]
    return out


def test_encoding_against_plain_rank_merges():
    import base64

    path, pattern = bpe.multi_50k()
    enc, rx = _enc()
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in bpe.read_ranks(path).splitlines() if x)}
    back = {v: k for k, v in ranks.items()}
    rng = random.Random(8)
    words = ["the", " Straße", " l'été", "  ", "\n\n", " 漢字かな", "12345", " don't", "?!...", "🙂", "\t", " antidisestablishmentarianism", "ZZZ", "a\u0301"]
    for n in (0, 1, 6, 40, 300):
        for _ in range(12):
            text = "".join(rng.choice(words) for _ in range(n))
            got = bpe.encode(text, enc, rx, size=64, overlap=32)
            assert got == plain_ids(text, ranks, rx)
            assert bpe.decode(bpe.id_bytes(got), enc) == b"".join(back[i] for i in got) == text.encode()


def merged(data: bytes, ranks) -> list[int]:
    """Rank merges of one long pre-token, lowest rank and leftmost first, by a heap over neighbours."""
    import heapq

    part, before, after = [data[i : i + 1] for i in range(len(data))], list(range(-1, len(data) - 1)), [*range(1, len(data)), -1]
    heap = [(ranks[p], i, 2) for i in range(len(data) - 1) if (p := data[i : i + 2]) in ranks]
    heapq.heapify(heap)
    while heap:
        _, i, size = heapq.heappop(heap)
        j = after[i] if part[i] else -1
        if j < 0 or len(part[i]) + len(part[j]) != size:
            continue
        part[i], part[j] = part[i] + part[j], b""
        after[i] = after[j]
        if after[j] >= 0:
            before[after[j]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] >= 0 and (p := part[k] + part[after[k]]) in ranks:
                heapq.heappush(heap, (ranks[p], k, len(p)))
    return [ranks[p] for p in part if p]


def test_long_runs(spark):
    """Runs that nothing splits, beyond what the encoder's own splitter bears."""
    import base64

    path, pattern = bpe.multi_50k()
    enc, rx = _enc()
    ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in bpe.read_ranks(path).splitlines() if x)}
    n = 1_200_000
    texts = [c * n for c in (" ", "\t", "\n", "a", "7", "!")] + ["words and" + " " * n + "more words", "x" + "\u3000" * (n // 3) + "\n" + " " * 70_000 + "y", " a" * 40_000 + "b" * n, "ab" * (n // 2)]
    rows = list(enumerate(texts)) + [(100 + i, c * 5_000_000) for i, c in enumerate(" \ta1")]
    got = {r.doc_id: r for r in bpe.with_digests(bpe.encode_documents(spark.createDataFrame(rows, "doc_id long, text string"), path, pattern)).collect()}
    for i, text in rows:
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest(), i
    for i, text in enumerate(texts):
        want = [t for m in rx.finditer(text) for t in merged(m[0].encode(), ranks)]
        assert bytes(got[i].ids) == bpe.id_bytes(want), i
        assert bpe.encode(text, enc, rx) == want, i
