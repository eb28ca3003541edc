import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tessera.llm import exact_dedup as ed

ROWS = [(3, "a b"), (1, "ab "), (2, " a  b "), (4, None), (5, ""), (6, " \n\t"), (7, "x" * 50_000), (8, "é\x0bé"), (9, "éé"), (9, "éé"), (None, "lone"), (None, "ab"), (10, "a b"), (11, "A B")]


def brute(rows):
    norm = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = defaultdict(list)
    for d, t in rows:
        groups[norm(t)].append((-len(t or ""), d is None, d or 0, d))
    out = []
    for d, t in rows:
        g = groups[norm(t)]
        keep = min(g)[3]
        out.append((str(d), str(keep), len(g), d == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((str(r.doc_id), str(r.keep_id), r.group_size, r.kept, r.text_sha256) for r in df.collect())


def test_brute_force_and_clashing_columns(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").selectExpr("*", "1 as norm", "'q' as sha", "2 as rank").repartition(3)
    want = brute(ROWS)
    # (None, 'ab') has fewer code points than ' a  b ' and does not stay
    assert result(ed.exact_dedup(docs)) == want
    assert result(ed.exact_dedup(docs.limit(0))) == []


def test_collisions_are_told_apart_by_bytes(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string")
    weak = lambda norm: F.unhex(F.lpad(F.hex(F.length(norm) % 2), 2, "0"))
    assert result(ed.exact_dedup(docs, weak)) == brute(ROWS)


def test_extreme_ids(spark):
    rows = [(2**63 - 1, "t"), (-(2**63), "t"), (0, "t ")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.keep_id for r in ed.exact_dedup(docs).collect()} == {0}
    docs = spark.createDataFrame(rows[:2], "doc_id long, text string")
    assert {r.keep_id for r in ed.exact_dedup(docs).collect()} == {-(2**63)}


def test_drop_duplicates(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string").withColumn("lang", F.lit("en"))
    got = sorted((str(r.doc_id), r.text or "") for r in ed.drop_duplicates(docs).collect())
    assert got == sorted([("2", " a  b "), ("6", " \n\t"), ("7", "x" * 50_000), ("8", "é\x0bé"), ("None", "lone"), ("10", "a b"), ("11", "A B")])
    assert ed.drop_duplicates(docs).columns == ["doc_id", "text", "lang"]


def test_of_rows_alike_the_least_stays(spark):
    rows = [(1, "same text", "b", {"k": 2}, None), (1, "same  text", "a", {"k": 1}, 4), (1, "same  text", "a", {"k": 1}, 3), (2, "x", None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, more map<string,int>, n int")
    for order in (docs, docs.orderBy(F.desc("source")), docs.repartition(3)):
        got = sorted(tuple(r) for r in ed.drop_duplicates(order).collect())
        assert got == [(1, "same  text", "a", {"k": 1}, 3), (2, "x", None, None, None)]


def test_very_long_texts(spark):
    long = "ab \n" * 1_000_000
    docs = spark.createDataFrame([(1, long), (2, long.replace(" ", "\t ")), (3, long + "c")], "doc_id long, text string")
    got = {r.doc_id: (r.keep_id, r.group_size) for r in ed.exact_dedup(docs).collect()}
    assert got == {1: (2, 2), 2: (2, 2), 3: (3, 1)}
