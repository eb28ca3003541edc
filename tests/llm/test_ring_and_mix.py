import random
import zlib
from collections import defaultdict

import pytest

from pyspark.sql import functions as F

from tessera.llm import mixing, ring_shards


def docs_of(spark, n=1500, seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join("wé"[: rng.randrange(1, 3)] for _ in range(rng.choice([0, 1, 5, 40, 90]))), rng.choice(["a", "b", "b", "b", None, "ü", "z"])) for i in range(n)]
    rows += [(None, "no id", "a"), (5, "again", "b"), (5, "again", "b"), (n, None, "a"), (n + 1, "x" * 900, "b"), (n + 2, "q", "tiny")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, source string").selectExpr("*", "1 as size", "2 as h", "3 as cell", "4 as target").repartition(6)


def test_shards_are_balanced_and_gapless(spark):
    rows, docs = docs_of(spark)
    got = ring_shards.shard(docs, 10).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    assert sorted((str(r.doc_id), r.size, r.text_crc32) for r in got) == sorted((str(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t, _ in rows)
    load, slots = defaultdict(int), defaultdict(list)
    for r in got:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    mean = sum(load.values()) / 10
    assert set(load) == set(range(10)) and max(load.values()) - min(load.values()) <= max(0.02 * mean, 1000)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    again = {(r.doc_id, r.text_crc32, r.shard) for r in ring_shards.shard(docs.repartition(3), 10).collect()}
    assert again == {(r.doc_id, r.text_crc32, r.shard) for r in got}
    assert ring_shards.shard(docs.limit(0), 10).count() == 0


def test_overflow_goes_clockwise_and_moves_little():
    sizes = {(c, 0): 10 for c in range(0, 60_000, 7)}
    a, b = ring_shards.assign_cells(sizes, 10, slack=0.25), ring_shards.assign_cells(sizes, 11, slack=0.25)
    moved = sum(a[c] != b[c] for c in sizes) / len(sizes)
    assert moved < 0.35  # a fresh modulo would move about 0.91
    at, owner = ring_shards.ring(10)
    home = {c: int(owner[int(at.searchsorted(c[0])) % len(at)]) for c in sizes}
    assert sum(home[c] == a[c] for c in sizes) / len(sizes) > 0.8


def plain_walk(sizes, shards, slack):
    """The ring as a sorted list of points, one step at a time."""
    points = sorted((ring_shards._point(f"{s}/{v}") * ring_shards.CELLS >> 64, s, v) for s in range(shards) for v in range(ring_shards.VNODES))
    room = [-(-int(sum(sizes.values()) * (1 + slack)) // shards)] * shards  # no cell is as large as a shard
    out = {}
    for cell in sorted(sizes, key=lambda c: (-sizes[c], c)):
        place = ring_shards.place(*cell)
        turn = [p for p in points if p[0] >= place] + [p for p in points if p[0] < place]
        fits = [s for _, s, _ in turn if room[s] >= sizes[cell]]
        most = max(room)
        out[cell] = fits[0] if fits else next(s for _, s, _ in turn if room[s] == most)
        room[out[cell]] -= sizes[cell]
    return out


def test_ring_against_a_plain_walk_at_the_slack_of_the_query():
    rng = random.Random(12)
    sizes = {(c, p): int(rng.lognormvariate(7, 1)) for c in rng.sample(range(ring_shards.CELLS), 1200) for p in range(rng.choice([1, 1, 2]))}
    got = ring_shards.assign_cells(sizes, 8)
    assert got == plain_walk(sizes, 8, ring_shards.SLACK)
    load = defaultdict(int)
    for c, s in got.items():
        load[s] += sizes[c]
    assert max(load.values()) - min(load.values()) <= max(sizes.values())


def test_one_more_shard_moves_little_at_the_slack_of_the_query():
    rng = random.Random(13)
    sizes = {(c, 0): int(rng.lognormvariate(9, 0.5)) for c in range(ring_shards.CELLS)}
    a, b = ring_shards.assign_cells(sizes, 40), ring_shards.assign_cells(sizes, 41)
    assert sum(n for c, n in sizes.items() if a[c] != b[c]) / sum(sizes.values()) < 0.08  # 0.024 is the least


def test_repeated_keys_do_not_make_a_shard_heavy(spark):
    rng = random.Random(14)
    rows = [(i, "x" * rng.randrange(40)) for i in range(4000)] + [(None, "")] * 4000 + [(7, "same")] * 3000 + [(8, f"t{i}") for i in range(1000)] + [(9, "y" * 100_000)]
    got = ring_shards.shard(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), 8).collect()
    assert sorted((str(r.doc_id), r.size) for r in got) == sorted((str(d), len(t) + 16) for d, t in rows)
    load, slots = defaultdict(int), defaultdict(list)
    for r in got:
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    rest = sorted(load.values())[:-1]  # one text holds a shard of its own
    assert len(load) == 8 and max(rest) <= 1.01 * min(rest)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_targets_fill_like_water():
    t = mixing.targets({"a": 100, "b": 10, "c": 50, None: 0}, {"a": 3, "b": 1, "c": 2, None: 3}, 240, 2.0)
    assert t["b"] == 20 and t["c"] == pytest.approx(88) and t["a"] == pytest.approx(132) and t[None] == 0
    assert sum(mixing.targets({"a": 1, "b": 1}, {"a": 3, "b": 1}, 9, 2.0).values()) == 4


def test_mixture_meets_its_targets(spark):
    rows, docs = docs_of(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.size * r.copies
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert {r.source: r.source_size for r in got} == dict(sizes)
    want = mixing.targets(dict(sizes), dict(zip(sorted(sizes, key=lambda s: (s is None, s or "")), [3, 1, 2] * 3)), 1.5 * sum(sizes.values()))
    for s in sizes:
        assert target[s] == pytest.approx(want[s])
        assert abs(taken[s] - target[s]) <= 90, s  # half of the longest document of 180 words at most
    again = sorted((str(r.doc_id), r.taken) for r in mixing.mix(docs.repartition(2)).collect())
    assert again == sorted((str(r.doc_id), r.taken) for r in got)
    assert mixing.mixed_rows(docs).count() == sum(r.copies for r in got) and mixing.mixed_rows(docs).columns == docs.columns
    assert mixing.mix(docs.limit(0)).count() == 0


def test_budgets_are_nested(spark):
    _, docs = docs_of(spark)
    small = {r.doc_id: r.copies for r in mixing.mix(docs, share=0.5).collect()}
    large = {r.doc_id: r.copies for r in mixing.mix(docs, share=0.9).collect()}
    assert all(large[d] >= c for d, c in small.items())


def test_too_many_sources(spark):
    _, docs = docs_of(spark, 30)
    with pytest.raises(ValueError, match="sources"):
        mixing.mix(docs, max_sources=2)


def test_many_copies_of_a_row_are_made_by_several_tasks(spark):
    rows = spark.createDataFrame([(1, 16, 0, 250_001), (2, 17, 5, 3), (3, 17, 5, 100_000)], "doc_id long, size long, text_crc32 long, copies long")
    made = ring_shards._each_copy(rows, 10_000)
    got = {r.doc_id: (r.n, r.least, r.most, r.d) for r in made.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("copy").alias("least"), F.max("copy").alias("most"), F.count_distinct("copy").alias("d")).collect()}
    assert got == {1: (250_001, 1, 250_001, 250_001), 2: (3, 1, 3, 3), 3: (100_000, 1, 100_000, 100_000)}
    parts = made.where("doc_id = 1").groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) > 1 and max(r["count"] for r in parts) < 200_000


def test_very_long_texts(spark):
    long = "word " * 400_000
    docs = spark.createDataFrame([(1, long, "a"), (2, "x y", "a"), (3, long + "z", "b"), (4, None, None)], "doc_id long, text string, source string")
    got = {r.doc_id: r for r in mixing.mix(docs).collect()}
    assert {d: r.size for d, r in got.items()} == {1: 400_000, 2: 2, 3: 400_001, 4: 0}
    assert all(r.taken <= 2 * r.size for r in got.values())
    got = {r.doc_id: r for r in ring_shards.shard(docs, 3).collect()}
    assert {d: r["size"] for d, r in got.items()} == {1: 2_000_016, 2: 19, 3: 2_000_017, 4: 16} and got[1].shard != got[3].shard
    assert got[1].text_crc32 == zlib.crc32(long.encode())
