"""Count trails, constraints, page-bounded lists and the serving layout."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import brands, checks, sinks
from tessera.operators.trail import CountTrail
from tessera.plans import publishing


def _jobs(spark, run):
    spark.sparkContext.setJobGroup("counted", "")
    before = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted"))
    out = run()
    n = len(spark.sparkContext.statusTracker().getJobIdsForGroup("counted")) - before
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return n, out


def test_counts_come_from_the_run_that_writes(spark, tmp_path):
    def plan(mark):
        rows = mark(spark.range(0, 5000, 1, 4).withColumn("g", F.col("id") % 7), "read")
        rows = mark(rows.where("id % 2 = 0"), "even")
        rows = mark(rows.join(spark.range(3000).withColumnRenamed("id", "other"), F.col("id") == F.col("other")), "known")
        rows = mark(rows.select("g", F.explode(F.array("id", "other")).alias("x")), "twice")
        return mark(rows.groupBy("g").count(), "groups")

    separate = []
    plan(lambda rows, step: separate.append((step, rows.count())) or rows)
    trail = CountTrail()
    rows = plan(trail.mark)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # so that a job is an action
    try:
        n, _ = _jobs(spark, lambda: rows.write.parquet(str(tmp_path / "out")))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert trail.counts() == separate and n <= 2  # the write, and a broadcast if there is one
    table = [tuple(r) for r in trail.table(spark).orderBy("place").collect()]
    assert table[1] == (1, "even", 2500, 50.0) and table[0][3] is None
    # of nothing
    trail = CountTrail()
    trail.mark(spark.range(0), "none", odd=F.col("id") % 2 == 1).collect()
    assert trail.counts() == [("none", 0), ("none.odd", 0)]


def test_constraints(spark):
    rows = spark.createDataFrame(
        [(1, "a", 5, "x"), (2, "b", None, "x"), (3, None, -1, "y"), (4, "c", 7, None), (4, "c", 7, None), (5, "q", 1, "z")], "id long, code string, n int, other string"
    ).selectExpr("*", "1 as rule", "2 as example", "3 as __0")
    codes = spark.createDataFrame([("a",), ("b",), ("c",)], "code string")
    rules = [
        checks.NotNull("n"), checks.NotNull("id"), checks.Holds("n at least 0", F.col("n") >= 0), checks.Within("other", ("x", "y")), checks.Unique(("id",)), checks.Unique(("code", "n")),
        checks.Refers(("code",), codes, ("code",), "codes"), checks.Holds("true", F.lit(True)),
    ]
    got = {r.rule: (r.n, r.examples) for r in checks.violations(rows, ["id"], rules).collect()}
    assert got == {
        "n not null": (1, ["2"]), "n at least 0": (1, ["3"]), "other in its domain": (1, ["5"]), "id unique": (2, ["4"]), "code, n unique": (2, ["c/7"]), "code in codes": (1, ["q"]),
    }
    with pytest.raises(ValueError, match="rows: code in codes: 1 rows, such as q"):
        checks.require(rows, ["id"], rules[-2:], "rows")
    checks.require(rows, ["id"], [checks.NotNull("id")], "rows")
    assert checks.violations(rows.limit(0), ["id"], rules).count() == 0
    many = spark.range(5000).withColumn("n", F.lit(None).cast("int"))
    (r,) = checks.violations(many, ["id"], [checks.NotNull("n")], examples=2).collect()
    assert (r.n, r.examples) == (5000, ["0", "1"])


def test_constraints_neither_sort_nor_merge_partitions(spark):
    from collections import Counter

    # one value with a third of the rows, others that few rows have; keys that several rows share
    rows = spark.range(0, 6000, 1, 5).selectExpr("if(id % 3 = 0, -1, id % 1700) as a", "id % 4 as b", "id % 2500 as k", "if(id % 11 = 0, null, id % 50) as q")
    known = spark.range(0, 800).withColumnRenamed("id", "known")
    rules = [checks.Unique(("a", "b")), checks.Unique(("k",)), checks.Holds("q small", F.col("q") < 45), checks.NotNull("q"), checks.Refers(("a",), known, ("known",), "known")]
    found = checks.violations(rows, ["k", "b"], rules)
    got = {r.rule: (r.n, r.examples) for r in found.collect()}
    plain = rows.collect()
    times = lambda of: {v: n for v, n in Counter(of).items() if n > 1}
    broken = {
        "a, b unique": times(f"{r.a}/{r.b}" for r in plain), "k unique": times(str(r.k) for r in plain), "q small": Counter(f"{r.k}/{r.b}" for r in plain if r.q is not None and r.q >= 45),
        "q not null": Counter(f"{r.k}/{r.b}" for r in plain if r.q is None), "a in known": Counter(str(r.a) for r in plain if not 0 <= r.a < 800),
    }
    assert got == {rule: (sum(of.values()), sorted(of)[:3]) for rule, of in broken.items()}
    plan = checks.violations(rows, ["k", "b"], rules[:4])
    plan.collect()
    plan = plan._jdf.queryExecution().executedPlan().toString()
    # examples are kept as rows pass, not sorted; values are counted in a given number of tasks: by value and split, then by value
    assert "Window" not in plan and "Sort" not in plan and plan.count("REPARTITION_BY_NUM") >= 4


def test_no_brand_is_one_row_of_all_its_shops(spark):
    rows = spark.range(1005).selectExpr("'big' as marca", "'SP' as uf", "if(id % 5 = 0, null, 'c' || id % 11) as municipio_slug", "if(id % 5 = 0, null, 'C' || id % 11) as municipio", "'L' || id as nome", "'p' || id as posto_id")
    rows = rows.unionByName(rows.limit(40)).unionByName(spark.createDataFrame([("one", "RJ", None, None, "A & \"B\"", "p1")], rows.schema))
    got = brands.nested(rows, 100).orderBy("marca", "pagina").collect()
    big = [r for r in got if r.marca == "big"]
    assert len(big) == 11 and [len(r.postos) for r in big] == [100] * 10 + [5] and {(r.n, r.n_cidades, r.paginas) for r in big} == {(1005, 11, 11)}
    order = [(x.uf, x.lugar, x.nome, x.posto_id) for r in big for x in r.postos]
    assert order == sorted(order) and len(set(order)) == 1005 and [x[1] for x in order].index("￿") == 804
    marca = spark.createDataFrame([("big", "Big"), ("one", "One")], "marca string, marca_nome string")
    body = {(r.marca, r.pagina): r for r in brands.pages(rows, marca, "https://x.test").collect()}
    one = body["one", 1]
    assert one.corpo == "<ul><li>A &amp; &quot;B&quot; — RJ</li></ul>" and one.titulo == "One: 1 oficina em 0 cidades"
    ld = json.loads(body["big", 3].lista)
    assert ld["numberOfItems"] == 1005 and [x["position"] for x in ld["itemListElement"]] == list(range(201, 301))
    assert json.loads(one.lista)["itemListElement"][0]["item"]["address"] == {"@type": "PostalAddress", "addressRegion": "RJ"}
    assert "item" not in json.loads(one.trilha)[-1]
    assert '<b>3</b>' in body["big", 3].corpo and '<a href="/marcas/big/">1</a>' in body["big", 3].corpo and '<a href="/marcas/big/11/">11</a>' in body["big", 3].corpo


def test_titles_of_brand_pages_have_plain_numbers_as_in_the_sql(spark, monkeypatch):
    rows = spark.range(1005).selectExpr("'alfa' as marca", "'SP' as uf", "'c' || id % 1002 as municipio_slug", "'C' || id % 1002 as municipio", "'L' || id as nome", "'p' || id as posto_id")
    monkeypatch.setattr(publishing.Q, "_brand_rows", lambda spark, sf: rows)
    got = publishing.q66_brand_pages(spark, "").select("titulo").distinct().collect()
    assert [r.titulo for r in got] == ["Alfa: 1005 oficinas em 1002 cidades"]
    marca = spark.createDataFrame([("alfa", "Alfa")], "marca string, marca_nome string")
    assert brands.pages(rows, marca, "https://x.test").first().titulo == "Alfa: 1.005 oficinas em 1.002 cidades"


def test_a_lookup_reads_one_row_group(spark, tmp_path):
    rows = spark.range(60_000).selectExpr("sha2(cast(id as string), 256) as id", "'v' || id % 3 as vertical", "'u' || id % 7 as uf", "'c' || id % 50 as city", "id as n")
    path = str(tmp_path / "serving")
    sinks.write_lookup(rows, path, "id", ["vertical", "uf", "city"], group_rows=2_000, file_rows=30_000)

    def read(**equal):
        found = sinks.lookup(spark, path, **equal)
        got = found.collect()
        leaf = found._jdf.queryExecution().executedPlan().collectLeaves().head()
        return got, leaf.metrics().apply("numOutputRows").value()

    for i in (0, 31_234, 59_999):
        got, scanned = read(id=rows.where(f"n = {i}").first().id)
        assert [r.n for r in got] == [i] and scanned <= 4_000  # the one that has it, and rarely one that only seems to
    assert read(id="no such id")[1] <= 2_000
    got, scanned = read(vertical="v1", uf="u3", city="c10")
    assert {r.n % 3 for r in got} == {1} and scanned <= 4_000 and len(got) == rows.where("vertical = 'v1' and uf = 'u3' and city = 'c10'").count() > 0


def test_a_representative_of_each_source(spark):
    rows = spark.createDataFrame([("a", "Beta", "f", 5), ("b", "alfa", "f", 5), ("c", "C", "f", 1), ("d", "D", "g", 2), ("e", "E", "g", 9)], "marca string, marca_nome string, fonte string, total long")
    pick = lambda wish, day=0: {r.fonte: r.marca for r in brands.representative(rows, wish, day).collect()}
    assert pick([]) == {"f": "b", "g": "e"} and pick([], 1) == {"f": "a", "g": "d"} and pick([], 5) == {"f": "c", "g": "d"}
    assert pick(["zz", "c", "a"]) == {"f": "c", "g": "e"} and pick(["d", "a"], 2) == {"f": "a", "g": "d"}
    assert [r.marca for r in brands.of_source(rows, "f").collect()] == ["b", "a", "c"]
