import random
import re
import time
from collections import defaultdict

import numpy as np
import pytest

from tessera.llm import ngram_join as nj


def shingles(t):
    t = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    return set() if not w else {tuple(w)} if len(w) < 5 else set(zip(w, w[1:], w[2:], w[3:], w[4:]))


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    lab = list(range(len(rows)))
    inv = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            inv[x].append(i)
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for x in s:
            for j in inv[x]:
                common[j] += 1
        for j, c in common.items():
            if 100 * c >= 80 * (len(s) + len(sets[j]) - c) and lab[i] != lab[j]:
                a, b = lab[i], lab[j]
                lab = [a if v == b else v for v in lab]
    least = {}
    for (d, _), v in zip(rows, lab):
        if d is not None:
            least[v] = min(d, least.get(v, d))
    return sorted((str(d), len(s), str(least.get(v))) for (d, _), s, v in zip(rows, sets, lab))


def corpus(seed, n):
    rng = random.Random(seed)
    words = [f"W{i}" for i in range(400)]
    passages = [[rng.choice(words) for _ in range(60)] for _ in range(4)]
    bases = [[rng.choice(words) for _ in range(rng.choice([3, 5, 12, 60, 150]))] for _ in range(n // 6)]
    out = []
    for _ in range(n):
        b = list(rng.choice(bases))
        for _ in range(rng.choice([0, 0, 1, 2, 3])):
            b[rng.randrange(len(b))] = rng.choice(words).lower()
        if rng.random() < 0.3:
            p = rng.choice(passages)
            b = b + p if rng.random() < 0.7 else p + b
        out.append(rng.choice([" ", "  ", "\n"]).join(b))
    return out


@pytest.mark.parametrize("tile", [512, 16])
def test_against_brute_force(spark, tile):
    texts = corpus(1, 240) + [None, "", " \n", "a b", "A  b", "x", "x"]
    rows = [(i * 3 + 1, t) for i, t in enumerate(texts)] + [(None, "a b"), (None, "nobody else"), (4, texts[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as id", "2 as n").repartition(5)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in nj.near_duplicates(docs, tile=tile).collect())
    assert got == brute(rows)


def test_tasks_that_forget_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(nj, "_SEEN", 3)
    monkeypatch.setattr(nj, "_TIED", 40)
    texts = corpus(2, 150)
    rows = [(i, t) for i, t in enumerate(texts + texts[:40])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(2)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in nj.near_duplicates(docs).collect()) == brute(rows)


@pytest.mark.parametrize("wide", [16, 0])
def test_large_block_of_near_copies(spark, monkeypatch, wide):
    monkeypatch.setattr(nj, "WIDE", wide)
    rng = random.Random(3)
    base = [f"v{i}" for i in range(80)]
    rows = []
    for i in range(150):
        b = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            b[rng.randrange(80)] = f"z{rng.randrange(30)}"
        rows.append((i, " ".join(b)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in nj.near_duplicates(docs, tile=12).collect())
    assert got == brute(rows)


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert nj.near_duplicates(docs).count() == 0
    assert nj.near_duplicates(spark.createDataFrame([(1, "only one text here now")], "doc_id long, text string")).collect()[0].component_id == 1


def test_prefix_length():
    assert [nj.prefix_length(n) for n in (0, 1, 4, 5, 10, 500)] == [0, 1, 1, 2, 3, 101]


@pytest.mark.parametrize("local", [10**6, 0])
def test_components(spark, local):
    from tessera.llm.components import components

    rng = random.Random(6)
    for edges in ([(i, i + 1) for i in range(60)], [(rng.randrange(200), rng.randrange(200)) for _ in range(120)], [(0, i) for i in range(1, 50)] + [(7, 7), (None, 3)], []):
        up = {}

        def top(x):
            while up.get(x, x) != x:
                x = up[x]
            return x

        for u, v in edges:
            if u is not None and u != v:
                a, b = sorted((top(u), top(v)))
                up[b] = a
        want = {x: top(x) for e in edges if e[0] is not None and e[0] != e[1] for x in e}
        df = spark.createDataFrame(edges, "u long, v long").repartition(5)
        got = {r.id: r.component for r in components(df, local_edges=local).collect()}
        assert got == want


def template_built(n, passages, each, seed, hot="the same five words everywhere indeed"):
    """Documents put together from shared passages behind one shingle that all of them have."""
    rng = random.Random(seed)
    pool = [" ".join(f"p{k}w{rng.randrange(3000)}" for _ in range(40)) for k in range(passages)]
    return [" ".join([hot, *rng.sample(pool, each)]) for _ in range(n)]


@pytest.mark.parametrize("group, wide", [(2048, 16), (2048, 0), (24, 0), (6, 0)])
def test_template_built_documents(spark, monkeypatch, group, wide):
    """One block of all sets with hardly a link; small groups go through the second order and tiles."""
    monkeypatch.setattr(nj, "GROUP", group)
    monkeypatch.setattr(nj, "WIDE", wide)
    texts = template_built(160, 12, 4, 8)
    texts += [t + " and an end" for t in texts[:20]] + [" ".join(reversed(t.split())) for t in texts[:5]]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in nj.near_duplicates(docs, tile=16).collect())
    assert got == brute(rows)


def test_time_of_one_large_block(spark, tmp_path):
    """Twice the template-built documents take clearly less than the fourfold time of all pairs."""
    took = {}
    for n in (3000, 12_000, 24_000):
        path = f"{tmp_path}/{n}"
        spark.createDataFrame(list(enumerate(template_built(n, 200, 6, 5))), "doc_id long, text string").repartition(16).write.parquet(path)
        start = time.time()
        assert nj.near_duplicates(spark.read.parquet(path)).where("component_id = doc_id").count() == n
        took[n] = time.time() - start
    assert took[24_000] < 2.3 * took[12_000], took


@pytest.mark.parametrize("orders", [1, 2, 3])
def test_no_filter_loses_a_link(orders):
    rng = np.random.default_rng(4)
    for _ in range(20):
        base = [rng.integers(0, 2**63, int(rng.integers(1, 400))).astype(np.uint64) for _ in range(4)]
        sets = []
        for _ in range(40):
            b = base[int(rng.integers(4))]
            kept = b[rng.random(len(b)) > rng.choice([0, 0.02, 0.1, 0.3])]
            sets.append(np.unique(np.concatenate([kept, rng.integers(0, 2**63, int(rng.integers(0, 12))).astype(np.uint64)])))
        token, count = np.unique(np.concatenate(sets), return_counts=True)
        often = [np.minimum(count[np.searchsorted(token, s)], 65535).astype(np.uint16) for s in sets]
        shared = [s[f > 1] for s, f in zip(sets, often)]
        often = [f[f > 1] for f in often]
        n = np.array([len(s) for s in sets])
        prefixes = [[nj.prefix(t, f, int(k), o, 80) for t, f, k in zip(shared, often, n)] for o in range(1, orders)]
        group, query = np.arange(40), rng.random(40) < 0.7
        pairs = nj.plausible_links(n, np.array([len(s) for s in shared]), [nj.signature(s, int(k)) for s, k in zip(shared, n)], prefixes, group, query)
        tied = list(range(40))
        for i, j in pairs:
            tied = [tied[i] if v == tied[j] else v for v in tied]
        for i in range(40):
            for j in range(i):
                common = len(np.intersect1d(sets[i], sets[j]))
                if common and 100 * common >= 80 * (n[i] + n[j] - common) and (query[i] or query[j]):
                    assert tied[i] == tied[j]
                    assert all(len(np.intersect1d(nj.prefix(shared[i], often[i], int(n[i]), o, 80), nj.prefix(shared[j], often[j], int(n[j]), o, 80))) for o in range(orders))


def test_shingles_keep_all_their_bits():
    assert [nj.bucket_bits(t) for t in (0, 1, 1 << 18, 1 << 19, 10**13)] == [1, 1, 1, 2, 26]
    for bits in (1, 8, 9, 26, 40):
        x = np.array([2**64 - 1, 2**63 + 5, 77], np.uint64)
        back = nj._from_low(nj._low_bytes(x, nj._width(bits)), nj._width(bits)) & np.uint64(2 ** (64 - bits) - 1)
        assert (back | (x >> np.uint64(64 - bits) << np.uint64(64 - bits)) == x).all()


def test_words_and_texts_of_any_length():
    from tessera.llm import shingles as sh

    long_word = "Ab" * 700_000
    many = " ".join(f"w{i % 977}" for i in range(400_000))
    for t in (many, f"x {long_word} y z v w", f"{long_word}", f"{many}\n{long_word} {many}"):
        assert len(t) > 1 << 20
        assert len(sh.sets_of([t])[0]) == len(shingles(t))
    parts = sh.sets_of(["a b c d e f", many, "", "a b c d e g"])
    assert [len(p) for p in parts] == [2, len(shingles(many)), 0, 2] and parts[0][0] in parts[3] or parts[0][1] in parts[3]
