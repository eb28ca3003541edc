import hashlib

import pytest

from tests.llm.test_ngram_join import brute as components

pipeline = pytest.importorskip("corpus_pipeline")


def test_stages_on_their_own_inputs(spark, sf_dir):
    from tessera.llm import bpe, rule_ensemble
    from tessera.staging import stage
    from tests.llm.test_exact_dedup import brute as copies

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["quality", "exact", "near", "mix", "encode"] and pipeline.ORACLE_SQL is None
    columns, seen = docs.columns, {}
    for name, step in pipeline.STAGES:
        seen[name] = (docs, out := stage(step(spark, docs, sf_dir), name))
        docs = out
        assert name == "encode" or out.columns == columns
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    before, after = seen["quality"]
    scored = rule_ensemble.classify(before, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert ids(after) == ids(scored.where("predicted = 1"))
    before, after = seen["exact"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert ids(after) == sorted(int(d) for d, k, *_ in copies(rows) if d == k)
    before, after = seen["near"]
    rows = [(r.doc_id, r.text) for r in before.collect()]
    assert ids(after) == sorted(int(d) for d, _, c in components(rows) if d == c)
    before, after = seen["mix"]
    assert set(ids(after)) <= set(ids(before)) and 1.3 < after.count() / before.count() < 1.7
    before, after = seen["encode"]
    enc, _ = bpe.encoder(bpe.read_ranks(bpe.multi_50k()[0]), bpe.multi_50k()[1])
    texts = {r.doc_id: r.text for r in before.collect()}
    for r in after.collect():
        want = enc.encode_ordinary(texts[r.doc_id])
        assert bytes(r.ids) == bpe.id_bytes(want) and r.n_tokens == len(want)
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run_on_an_empty_table(spark, sf_dir, tmp_path):
    for t in ("documents", "labels"):
        spark.read.parquet(f"{sf_dir}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    assert pipeline.run(spark, str(tmp_path)).count() == 0


def test_columns_of_any_name_come_through(spark, sf_dir):
    from pyspark.sql import functions as F

    names = "__stats __this __id __sha __s __whole __below __copies __copy __lost ___sha score keep_id component_id".split()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    wide = docs.select("*", *[F.lit(n).alias(n) for n in names])
    for name, step in pipeline.STAGES[:-1]:
        plain, out = step(spark, docs, sf_dir), step(spark, wide, sf_dir)
        assert out.columns == wide.columns, name
        rows = out.select("doc_id", *names).collect()
        assert sorted(r.doc_id for r in rows) == sorted(r.doc_id for r in plain.collect()), name
        assert all(r[n] == n for r in rows for n in names), name


@pytest.mark.parametrize("most", [200_000, 0])
def test_near_decides_by_row(spark, sf_dir, monkeypatch, most):
    monkeypatch.setattr(pipeline, "MOST_SENT", most)
    base = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcdefg"]
    close = [b + " more" for b in base]
    rows = [
        (1, base[0]), (2, close[0]), (2, base[1]),  # id 2: a near copy of 1, and a text of its own
        (3, base[2]), (3, close[2]),  # near copies that share the smallest id
        (4, base[3]), (None, close[3]),  # a near copy without id
        (None, base[4]), (None, close[4]),  # no id in the component
        (5, base[5]), (5, base[6]), (6, close[6]),  # two components of the same smallest id
        (7, None), (7, ""), (None, " "), (1, base[0]),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = [(r.doc_id, r.text) for r in pipeline.near(spark, docs, sf_dir).collect()]
    sha = lambda t: hashlib.sha256(t.encode()).digest()
    want = [(1, base[0]), (2, base[1]), (3, min(base[2], close[2], key=sha)), (4, base[3]), (None, min(base[4], close[4], key=sha)), (5, base[5]), (5, base[6]), (7, None), (7, ""), (None, " ")]
    assert sorted(got, key=str) == sorted(want, key=str)


def odd_rows():
    """Nulls in every column, empty, white and very long texts, ties and repeated rows."""
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    rows = [(1, "a b c d e f.", "en", "s1", 12), (1, "a b c d e f.", "en", "s1", 12), (2, None, None, None, None), (None, None, None, None, None), (None, "x y z", "en", None, 5), (None, "x y z", "en", None, 5)]
    return rows + [(3, "", "en", "s1", 0), (4, " \n\t", None, "s2", 3), (5, long, "de", "s2", len(long)), (6, long + " end", "de", None, len(long) + 4), (7, "one", "fr", "s1", 3), (7, "two", "fr", "s1", 3)]


def odd_docs(spark, sf_dir):
    columns = "doc_id long, text string, lang string, source string, n_chars long"
    return spark.createDataFrame(odd_rows(), columns).select(*spark.read.parquet(f"{sf_dir}/documents.parquet").columns).repartition(3)


def test_every_stage_takes_odd_rows(spark, sf_dir):
    docs = odd_docs(spark, sf_dir)
    out = {name: step(spark, docs, sf_dir).collect() for name, step in pipeline.STAGES}
    given = sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    for name in ("quality", "exact", "near"):
        kept = sorted((str(r.doc_id), r.text or "") for r in out[name])
        assert all(kept.count(r) <= given.count(r) for r in kept), name
    texts = ["".join((r.text or "").split()) for r in out["exact"]]
    assert sorted(texts) == sorted([*{"".join((t or "").split()) for _, t in given}, "xyz"])  # both rows of a text that no id has
    assert sum((r.text or "").startswith("w0 w1") for r in out["near"]) == 1 and sum(not (r.text or "").strip() for r in out["near"]) == 4
    assert len(out["encode"]) == len(given) and sum(r.n_tokens == 0 for r in out["encode"]) == 3


def test_quality_and_mix_against_plain_rules(spark, sf_dir):
    """Scores rule by rule, and the mixture row by row from sorted hashes."""
    import math

    from tessera.llm import mixing, rule_ensemble
    from tessera.llm.textstats import stats

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = rule_ensemble.train(docs, labels.where(~rule_ensemble.in_split(labels["doc_id"], 3, 1)))

    def accepted(text):
        x = stats(text)
        z = model.bias + sum(w for path, w in model.rules if all(x[f] <= c if side == "le" else x[f] > c for f, side, c in path))
        z += sum(w * (min(max(x[f], low), high) - centre) / scale for f, low, high, centre, scale, w in model.linear)
        return 1 / (1 + math.exp(-z)) >= 0.5

    assert sorted(r.doc_id for r in pipeline.quality(spark, docs, sf_dir).collect()) == sorted(r.doc_id for r in docs.collect() if accepted(r.text or ""))
    hashed = docs.withColumn("h", mixing._bits(docs["doc_id"], mixing.utf8_crc32(docs["text"]))).collect()
    size = {r.doc_id: len((r.text or "").split()) for r in hashed}
    sources = sorted({r.source for r in hashed}, key=lambda s: (s is None, s or ""))
    total = {s: sum(size[r.doc_id] for r in hashed if r.source == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    want, capped = {}, set()
    while True:  # shares by weight, the capped ones fixed at twice their size
        left = 1.5 * sum(total.values()) - sum(2 * total[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in sources if x not in capped) for s in sources if s not in capped}
        over = {s for s, v in share.items() if v > 2 * total[s]}
        if not over:
            break
        capped |= over
    for s in sources:
        target = 2.0 * total[s] if s in capped else share[s]
        times, need = divmod(target, total[s])
        run, best = 0, (need, 0)
        ranked = sorted((r for r in hashed if r.source == s), key=lambda r: r.h)
        for k, r in enumerate(ranked, 1):
            run += size[r.doc_id]
            best = min(best, (abs(need - run), k))
        want |= {r.doc_id: int(times) + (k < best[1]) for k, r in enumerate(ranked)}
    got = dict.fromkeys(want, 0)
    for r in pipeline.mix(spark, docs, sf_dir).collect():
        got[r.doc_id] += 1
    assert got == want


def test_very_long_texts_in_every_stage(spark, sf_dir):
    """Each stage takes texts of megabytes whole: a run of white space, one word, many words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    words = " ".join(f"w{i % 997} and" for i in range(200_000))
    odd = [(900_001, " " * 1_500_000 + "end."), (900_002, "x" * 1_000_000), (900_003, words), (900_004, words + " more"), (900_005, words.replace("and", "or"))]
    more = spark.createDataFrame([(i, t, "en", "long", len(t)) for i, t in odd], docs.schema)
    rows = docs.unionByName(more)
    kept = {}
    for name, step in pipeline.STAGES:
        kept[name] = {r.doc_id for r in step(spark, rows, sf_dir).select("doc_id").collect()}
    assert {i for i, _ in odd} <= kept["exact"] & kept["encode"]
    assert kept["near"] & {i for i, _ in odd} == {900_001, 900_002, 900_003, 900_005}  # one of the two that differ in a word
    assert kept["mix"] & {i for i, _ in odd}
