import random
from collections import defaultdict

from tessera.llm import line_dedup as ld

WS = " \t\n\x0b\x0c\r"


def key_of(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(WS))


def brute(rows, documents, least):
    holders = defaultdict(set)
    for no, (doc, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            holders[key_of(line)].add(("row", no) if doc is None else doc)
    gone = {k for k, v in holders.items() if len(v) >= documents and len(k) >= least}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if key_of(x) not in gone]
        out.append((doc, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def check(spark, rows, documents=3, least=1):
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as key", "'x' as text_id", "2 as at", "3 as lost").repartition(4)
    got = [tuple(r) for r in ld.dedup_lines(docs, documents, least).collect()]
    order = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted(got, key=order) == sorted(brute(rows, documents, least), key=order)
    return got


def test_odd_rows(spark):
    rows = [
        (1, None), (2, ""), (3, "\n\n"), (4, "Share this\nbody é\n  SHARE THIS\t"), (5, "share this\r\nÉcole\nécole"), (6, "x\nshare THIS \n\x0b\x0c"), (7, "nbsp share this"), (8, "école École"),
        (9, "École"), (9, "École"), (9, "ÉCOLE\nécole"), (None, "École\nq"), (None, "École\nq"), (None, "École"), (10, "q"), (11, "q\n" * 3 + "a"), (12, "İ\nI\ni"), (13, "i"), (14, " I "), (15, "\x85i\x1c"),
    ]
    check(spark, rows)
    check(spark, rows, documents=2, least=2)
    check(spark, rows, documents=1, least=1)
    check(spark, rows, documents=1, least=6)
    assert check(spark, []) == []


def test_random_and_long(spark):
    rng = random.Random(4)
    lines = ["Cookie notice", "cookie notice ", "Footer", "", "  ", *(f"line {i}" for i in range(60))]
    rows = [(i % 150, "\n".join(rng.choice(lines) for _ in range(rng.randrange(12)))) for i in range(200)]
    rows += [(1000 + i, "\n".join(["Footer", *(f"long {i} {j}" for j in range(40_000)), "FOOTER"])) for i in range(3)]
    check(spark, rows)
    check(spark, rows, documents=10)


def test_copies_are_gathered_once(spark):
    rows = [(i, "same\ntext\nsame") for i in range(400)] + [(1000, "other\nsame")]
    got = check(spark, rows, documents=10)
    assert {r[1:] for r in got} == {(3, 3, ""), (2, 1, "other")}
    places = ld.key_places(spark.createDataFrame(rows, "doc_id long, text string"))
    lost = {len(r.lost) for r in ld.lost_lines(places, 10).collect()}
    assert lost == {3, 1}
