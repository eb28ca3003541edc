import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tessera.llm import token_align as ta

TEXTS = [
    None, "", " ", "  ", "a", " a", "a ", "a  ", "Hello world", "  two  spaces\n\n and\ttabs \n", "naïve café — 漢字かな 🙂🙂 Straße", "under▁score", "x" * 3000, " " * 3000, "\n" * 500 + "z", "<s> </s> <unk> <0x41> <|endoftext|>",
    "12345 6,789.00 it's don't WE'LL", "\x00 nul \x1c\x1d sep", " nbsp  em space \u0085next", "é é ﬁ ①", "tail　 ", "a\r\n b\r\n", "Hello world",
]


@pytest.fixture(scope="module")
def both():
    byte_level, pieces = ta.public_pair()
    with open(byte_level, encoding="utf-8") as f, open(pieces, "rb") as g:
        return ta.Tokenizers(f.read(), g.read())


def plain(both, text):
    """(a ids, b ids, groups, links) of a whole text, token by token; None without tokens."""
    if not text:
        return None
    a = both.a.encode(f" {text}", add_special_tokens=False).ids
    b = both.b.encode(text)
    want = f" {text}".encode()
    if b"".join(both.bytes_a[i] for i in a) != want or b"".join(both.bytes_b[i] for i in b) != want:
        return None
    spans = []
    for ids, table in ((a, both.bytes_a), (b, both.bytes_b)):
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(table[i])))
            at += len(table[i])
        spans.append(out)
    cuts = {e for _, e in spans[0]} & {e for _, e in spans[1]}
    groups, i, j = [], 0, 0
    for cut in sorted(cuts):
        x, y = [], []
        while i < len(a) and spans[0][i][1] <= cut:
            x.append(a[i])
            i += 1
        while j < len(b) and spans[1][j][1] <= cut:
            y.append(b[j])
            j += 1
        groups.append((x, y))
    links = [(p, q) for p, (s, e) in zip(a, spans[0]) for q, (u, v) in zip(b, spans[1]) if s < v and u < e] if len(a) * len(b) < 10**7 else None
    return a, b, groups, links


def shown(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def random_texts(n, seed=5):
    rng = random.Random(seed)
    bits = ["the", "antidisestablishment", " ", "  ", "\n", "\t \n", "é", "漢字", "🙂", "'s", "12", ",", ".", "ZZ", " ", "re-use", "▁" if seed == 6 else "_", " a", "b ", "<s>"]
    return ["".join(rng.choice(bits) for _ in range(rng.randrange(40))) for _ in range(n)]


def test_units_encode_as_whole_texts(both):
    for t in TEXTS + random_texts(300) + random_texts(60, 6):
        want = plain(both, t)
        got = both.texts([t])[0]
        if want is None:
            assert got[:5] == (0, 0, 0, 0, "") and len(got[5]) == 0, t
            continue
        a, b, groups, links = want
        assert " ".join(ta.units_of(t)) == t
        assert got[:3] == (len(a), len(b), len(groups)), t
        assert got[4] == hashlib.sha256(shown(groups).encode()).hexdigest(), t
        if links is not None:
            assert got[3] == len(links)
            assert dict(zip(got[5].tolist(), got[6].tolist())) == Counter(p << 32 | q for p, q in links), t


def test_long_text_goes_in_steps(both, monkeypatch):
    texts = [" ".join(random_texts(200, 9)), "x" * 500 + " ", None, "a b c d e f g h ", " " * 90]
    once = both.texts(texts)
    monkeypatch.setattr(ta, "STEP", 7)
    monkeypatch.setattr(ta, "REMEMBERED", 5)
    monkeypatch.setattr(ta, "LONG_UNIT", 3)
    both.forget()
    for x, y in zip(once, both.texts(texts)):
        assert x[:5] == y[:5] and np.array_equal(x[5], y[5]) and np.array_equal(x[6], y[6])
    assert max(map(len, both.number)) <= 3


def test_components_are_minimal_groups():
    rng = random.Random(2)
    for _ in range(50):
        n = rng.randrange(1, 60)
        ends = [np.array(sorted({*rng.sample(range(1, n + 1), rng.randrange(n + 1)), n})) for _ in range(2)]
        x, y = ta.links(*ends)
        a, b = ta.components(len(ends[0]), len(ends[1]), x, y)
        cuts = np.intersect1d(*ends)
        assert len(set(a.tolist())) == len(cuts) == len(set(b.tolist()))
        for ids, end in ((a, ends[0]), (b, ends[1])):
            assert np.array_equal(np.unique(ids, return_inverse=True)[1], np.searchsorted(cuts, end))


@pytest.mark.parametrize("bound", [ta.BROADCAST_PAIRS, 0])
def test_documents(spark, both, bound):
    texts = TEXTS + random_texts(40)
    rows = [(i if i != 3 else None, t) for i, t in enumerate(texts)] + [(0, texts[9]), (9, texts[9])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as a", "2 as row", "'x' as pair", "3 as n").repartition(3)
    done = [plain(both, t) for _, t in rows]
    counts = Counter(p for d in done if d for p in set(d[3]))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    want = []
    for (i, _), d in zip(rows, done):
        a, b, groups, links = d or ([], [], [], [])
        sha = hashlib.sha256(shown(groups).encode()).hexdigest() if d else ""
        want.append((i, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[0]] for p in links), sum(counts[p] for p in links), sha))
    got = [tuple(r) for r in ta.align(docs, *ta.public_pair(), broadcast_pairs=bound).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, r)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert ta.align(docs.limit(0), *ta.public_pair()).count() == 0
