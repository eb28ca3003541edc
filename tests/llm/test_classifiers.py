import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import langmix, rule_ensemble as re_
from tessera.llm.textstats import NAMES, stats


def test_held_out_quality(spark, sf_dir):
    got = re_.op5_rule_quality(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert np.mean([r.predicted == r.quality for r in held]) >= 0.9
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got)


def test_compiled_rules_equal_the_model(spark):
    rng = random.Random(1)
    texts = [" ".join(rng.choice(["ab", "Cd.", "x$$", "EE!!", "12"]) for _ in range(rng.randrange(80))) for _ in range(300)] + ["", "word"]
    x = np.array([stats(t) for t in texts])
    y = (x[:, NAMES.index("symbol_share")] < 0.08).astype(float)
    m = re_.fit(x, y)
    assert m.rules and np.mean((m.predict(x) >= 0.5) == y) > 0.97
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_chars", F.lit(7)).withColumn("score", F.lit(9))
    got = {r.doc_id: r.score for r in re_.score(docs, m).collect()}
    assert np.allclose([got[i] for i in range(len(texts))], m.predict(x), atol=1e-9)
    assert re_.score(docs, m).columns == ["doc_id", "text", "n_chars", "score"]


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (3, "y " * 40_000), (3, "y " * 40_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 0), (1, 0, 0), (None, 1, 0), (9, 1, 0), (2, None, 0)], "doc_id long, quality int, toxic int")
    got = re_.classify(docs, labels).collect()
    assert len(got) == 5 and all(r.score is not None for r in got)
    assert re_.classify(docs.limit(0), labels.limit(0)).count() == 0
    assert {r.score for r in re_.classify(docs, labels.limit(0)).collect()} == {0.5}


def test_lasso_selects():
    rng = np.random.default_rng(0)
    z = rng.normal(size=(600, 20))
    y = (z[:, 3] - z[:, 7] + 0.1 * rng.normal(size=600) > 0).astype(float)
    _, w = re_.lasso_logistic(z, y, 0.05)
    assert set(np.flatnonzero(w)) == {3, 7} and w[3] > 0 > w[7]


def test_held_out_language(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    got = langmix.op7_language_mixture(spark, sf_dir).join(docs, "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2}
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.95


def as_document(text, m):
    words = langmix.words_of(text)
    return langmix.word_logp(list(words), m), np.array(list(words.values()))


def model_of(texts):
    counts = {}
    for k, t in texts.items():
        words = langmix.words_of(t)
        counts[k] = sum(n * np.bincount(langmix.grams([w])[0], minlength=langmix.BUCKETS) for w, n in words.items())
    return langmix.LangModel.of(counts)


A, B, C = "the quick fox was running over there with them", "der schnelle fuchs lief über die straße nicht", "los perros corren con ellos sobre aquella calle"


def test_mixture_proportions():
    m = model_of({"en": A * 20, "de": B * 20, "es": C * 20})
    (p, s), (q, _), (one, _) = langmix.infer([as_document(t, m) for t in ((A + " ") * 6 + (B + " ") * 3, (C + " ") * 5, "fuchs")])
    assert m.langs == ("de", "en", "es") and 0.5 < p[1] < 0.8 and 0.2 < p[0] < 0.45 and p[2] < 0.05 and 0 < s < 1
    assert q[2] == 1.0 and one.argmax() == 0


def plain_mixture(words, k):
    """EM and choice of the set word by word, in plain Python, over (likelihoods, number) of distinct words."""
    import math

    size = sum(n for _, n in words)
    rel = [([max(math.exp(v - max(lp)), 1e-12) for v in lp], n) for lp, n in words]

    def em(pi):
        for _ in range(langmix.STEPS):
            new = [0.0] * k
            for r, n in rel:
                z = sum(a * b for a, b in zip(r, pi))
                for j in range(k):
                    new[j] += n * r[j] * pi[j] / z
            new = [v / size for v in new]
            moved, pi = max(abs(a - b) for a, b in zip(new, pi)), new
            if moved <= langmix.SETTLED:
                break
        return pi, sum(n * math.log(sum(a * b for a, b in zip(r, pi))) for r, n in rel)

    single = [sum(n * (lp[j] - max(lp)) for lp, n in words) for j in range(k)]
    best = max(range(k), key=lambda j: (single[j], -j))
    chosen, value = [float(j == best) for j in range(k)], single[best]
    pi, _ = em([1 / k] * k)
    rank = sorted(range(k), key=lambda j: -pi[j])
    for m in range(2, k + 1):
        start = [max(pi[j], 1e-6) if j in rank[:m] else 0.0 for j in range(k)]
        got, ll = em([v / sum(start) for v in start])
        if ll - langmix.PENALTY * (m - 1) * math.log(size + 1) > value + 1e-9:
            chosen, value = got, ll - langmix.PENALTY * (m - 1) * math.log(size + 1)
    return chosen


def test_inference_against_a_plain_loop():
    rng = np.random.default_rng(8)
    docs = []
    for _ in range(40):
        k = 5
        own = rng.choice(k, int(rng.integers(1, k + 1)), replace=False)
        n = int(rng.integers(1, 60))
        lp = -rng.uniform(4, 9, (n, k))
        lp[np.arange(n), rng.choice(own, n)] += rng.uniform(0, 6, n)
        docs.append((lp.astype(np.float32), rng.integers(1, 6, n)))
    for (lp, often), (pi, score) in zip(docs, langmix.infer(docs)):
        want = plain_mixture([([float(v) for v in row], int(c)) for row, c in zip(lp, often)], lp.shape[1])
        assert np.allclose(pi, want, atol=2e-3) and 0 <= score <= 1


def test_words_and_their_numbers():
    import re

    text = "Über die Straße, l'été 12 x2y Ⅳ ½ ǅ  ÉTÉ\n日本語 a\u0301b\x00c"
    want = re.findall("[a-z]+", "")
    word = ""
    for ch in text.lower() + " ":
        if ch.isalpha():
            word += ch
        elif word:
            want.append(word)
            word = ""
    got = langmix.words_of(text)
    assert sorted(got.elements()) == sorted(want)


def test_languages_are_bounded(spark):
    docs = spark.createDataFrame([(i, "some words", f"l{i}") for i in range(12)], "doc_id long, text string, lang string")
    assert len(langmix.train(docs, max_langs=12).langs) == 12
    with pytest.raises(ValueError, match="languages"):
        langmix.train(docs, max_langs=11)


def test_language_edge_cases(spark):
    rows = [(i, "hello there world", "en") for i in range(12)] + [(100 + i, "guten tag welt", "de") for i in range(12)] + [(50, None, "en"), (51, "", None), (52, "123 !!", "de"), (None, "hello", "en"), (53, "hello " * 30_000, None), (53, "漢字", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit(1))
    got = langmix.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r.lang_pred for r in got if r.doc_id in (0, 50, 51, 52, 100)}
    assert by == {0: "en", 50: "und", 51: "und", 52: "und", 100: "de"} and all(0 <= r.score <= 1 for r in got)
    assert langmix.identify(docs.limit(0)).count() == 0
    assert {r.lang_pred for r in langmix.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}


def test_long_texts_in_slices(monkeypatch):
    m = langmix.LangModel.of({"a": np.arange(langmix.BUCKETS)})
    text = "Über die Straße, l'été 12 " * 50
    want = langmix.words_of(text)
    lp = langmix.word_logp(list(want), m)
    monkeypatch.setattr(langmix, "_SLICE", 37)
    assert langmix.words_of(text) == want and np.array_equal(langmix.word_logp(list(want), m), lp)


def test_a_document_may_mix_every_language():
    rng = np.random.default_rng(3)
    for k in (4, 6):
        lp = np.full((400 * k, k), -40.0, np.float32)
        lp[np.arange(400 * k), rng.permutation(np.repeat(np.arange(k), 400))] = -10.0
        ((pi, score),) = langmix.infer([(lp, np.ones(400 * k))])
        assert np.allclose(pi, 1 / k, atol=0.01) and abs(score - 1 / k) < 0.01


def test_rules_and_weights_against_plain_loops():
    """Every rule as a chain of comparisons, and the optimum conditions of the lasso."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, len(NAMES)))
    y = ((x[:, 2] > 0) & (x[:, 5] < 0.4) | (x[:, 9] > 1.2)).astype(float)
    m = re_.fit(x, y)
    for row, got in zip(x[:60], m.predict(x[:60])):
        z = m.bias
        for path, w in m.rules:
            z += w * all(row[f] <= c if side == "le" else row[f] > c for f, side, c in path)
        for f, low, high, centre, scale, w in m.linear:
            z += w * (min(max(row[f], low), high) - centre) / scale
        assert abs(1 / (1 + np.exp(-z)) - got) < 1e-12
    z, lam = rng.normal(size=(300, 12)), 0.02
    t = (z[:, 0] - z[:, 4] + 0.3 * rng.normal(size=300) > 0).astype(float)
    b, w = re_.lasso_logistic(z, t, lam, steps=4000)
    slope = z.T @ (1 / (1 + np.exp(-(z @ w + b))) - t) / 300
    assert np.all(np.abs(slope) <= lam + 1e-4) and np.allclose(slope[w != 0], -lam * np.sign(w[w != 0]), atol=1e-4)


def test_repeated_labelled_ids_learn_one_row(spark):
    rows = [(i, f"text {'good' if i % 2 else '###'} {i} " * 5) for i in range(60)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    once = spark.createDataFrame(rows, "doc_id long, text string")
    many = spark.createDataFrame(rows * 7 + [(i, t + " and a longer one") for i, t in rows] * 3, "doc_id long, text string").repartition(5)
    assert re_.train(once, labels) == re_.train(many, labels)
