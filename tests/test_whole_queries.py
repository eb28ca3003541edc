"""Queries over whole tables against brute force in Python."""

import re
from collections import Counter

from tessera.functions.text import PARTICLES
from tessera.plans.queries import QUERIES


def rows_of(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet").collect()


def test_every_order_has_its_page_window(spark, sf_dir):
    want = {}
    for r in rows_of(spark, sf_dir, "orders"):
        p = r.o_orderkey % 40 + 1
        want[r.o_orderkey] = ",".join(str(x) for x in range(1, 41) if x in (1, 40) or abs(x - p) <= 2)
    got = QUERIES["q44_presentation"][0](spark, sf_dir).collect()
    assert len(got) == len(want) and {r.o_orderkey: r.janela for r in got} == want


def test_no_task_of_the_star_join_sorts_its_lines_and_none_meets_customers_under_null(spark, sf_dir):
    got = QUERIES["q16_star_join"][0](spark, sf_dir)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # customers (keyed by o_custkey), orders and parts are hashed whatever their size; the lines come after the customers
    assert plan.count("ShuffledHashJoin") == 3 and "SortMergeJoin" not in plan and plan.index("ShuffledHashJoin [o_custkey") > plan.index("ShuffledHashJoin [l_orderkey")
    of = {t: rows_of(spark, sf_dir, t) for t in ("lineitem", "orders", "customer", "nation", "region", "part")}
    orders, parts = {r.o_orderkey: r for r in of["orders"] if r.o_orderstatus == "F"}, {r.p_partkey: r.p_brand for r in of["part"] if r.p_size > 10}
    customers, nations, regions = ({r[0]: r for r in of[t]} for t in ("customer", "nation", "region"))
    want = []
    for r in of["lineitem"]:
        o = orders.get(r.l_orderkey)
        c = o and customers.get(o.o_custkey)
        n = c and nations.get(c.c_nationkey)
        g = n and regions.get(n.n_regionkey)
        want.append((r.l_orderkey, r.l_linenumber, r.l_partkey, o and o.o_custkey, c and c.c_name, n and n.n_name, parts.get(r.l_partkey), g and g.r_name, o and o.o_orderpriority))
    assert Counter(tuple(r) for r in got.collect()) == Counter(want)


def test_every_phone_and_address(spark, sf_dir):
    docs = rows_of(spark, sf_dir, "documents")
    phones = [(r.doc_id, i + 1, "9" + n.replace("-", "")) for r in docs for i, (_, n) in enumerate(re.findall(r"[(]([0-9]{3})[)] ([0-9]{3}-[0-9]{4})", r.text))]
    mails = []
    for r in docs:
        for i, m in enumerate(re.findall(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+", r.text) or [""]):
            d = re.search(r"@([a-z0-9.-]+\.[a-z]{2,})\Z", m.lower())
            mails.append((r.doc_id, i + 1, d and d[1]))
    assert len(phones) > len({k for k, *_ in phones})
    text = lambda name, *cols: sorted((tuple(r[c] for c in cols) for r in QUERIES[name][0](spark, sf_dir).where("k between 0 and 9999999").collect()), key=str)
    assert text("q01_phone_e164", "k", "pos", "digitos") == sorted(phones, key=str)
    assert text("q02_phone_display", "k", "pos") == sorted((p[:2] for p in phones), key=str)
    assert text("q04_mail_domain", "k", "pos", "dominio") == sorted(mails, key=str)


def test_slugs_of_every_line(spark, sf_dir):
    import unicodedata

    counts = Counter()
    for r in rows_of(spark, sf_dir, "documents"):
        for line in r.text.split("\n"):
            plain = "".join(c for c in unicodedata.normalize("NFD", line) if not unicodedata.combining(c)).lower()
            counts[r.lang, re.sub("[^a-z0-9]+", "-", plain).strip("-") or None] += 1
    want = []
    for lang in {k for k, _ in counts}:
        top = sorted(((n, s) for (k, s), n in counts.items() if k == lang), key=lambda x: (-x[0], x[1] is None, x[1] or ""))[:100]
        want += [(lang, s, n, i + 1) for i, (n, s) in enumerate(top)]
    got = [(r.lang, r.slug, r.n, r.pos) for r in QUERIES["q03_slug_top"][0](spark, sf_dir).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_case_of_whole_texts(spark, sf_dir):
    def title(t):
        return " ".join(w if w in PARTICLES else w[:1].upper() + w[1:] for w in t.strip(" ").lower().split(" ")) or None

    def natural(t):
        return None if not t.strip(" ") else t.strip(" ") if re.search("[a-zà-ÿ]", t) else title(t)

    want = {r.doc_id: (title(t := r.text.replace("ß", "ss")), natural(t.upper()), natural(t)) for r in rows_of(spark, sf_dir, "documents")}
    got = {r.doc_id: (r.titulo, r.gritado, r.natural_) for r in QUERIES["q05_title_case"][0](spark, sf_dir).collect()}
    assert got == want


def test_cross_tab_counts_every_event(spark, sf_dir, tmp_path):
    from datetime import datetime

    def brute(events):
        n = Counter((r.event_type, r.ts and f"{r.ts:%Y-%m-%d}") for r in events)
        return {(e, d): n[e, d] for e in {e for e, _ in n} for d in {d for _, d in n}}

    odd = [("a", datetime(2024, 1, 31, 23)), ("b", datetime(2025, 2, 1)), ("b", None), (None, datetime(2024, 1, 31))]
    spark.createDataFrame(odd, "event_type string, ts timestamp").write.parquet(f"{tmp_path}/events.parquet")
    for d in (sf_dir, str(tmp_path)):
        events = rows_of(spark, d, "events")
        got = {(r.event_type, r.dia): r.n for r in QUERIES["q23_crosstab"][0](spark, d).collect()}
        assert got == brute(events) and sum(got.values()) == len(events)


def test_pages_of_a_hot_group_are_spread(spark):
    from pyspark.sql import functions as F
    from tessera.operators.sinks import numbered

    keys = [("hot", i) for i in range(5000)] + [(h, i) for h in ("a", "z", None) for i in range(7)] + [("one", None)]
    rows = spark.createDataFrame([(h, i, f"{h}{i}") for h, i in keys], "host string, i int, page_id string").repartition(8)
    size = Counter(h for h, _ in keys)
    for whole in (0, 5000):  # dealt by ranges, in one task a group
        found = numbered(rows, ["host"], [F.col("i").desc()], 10, whole=whole)
        got = {(r.host, r.i): (r.page, r.pages) for r in found.collect()}
        assert found.columns == ["host", "i", "page_id", "page", "pages"] and len(got) == len(keys)
        assert got == {(h, i): (1 if i is None else (size[h] - 1 - i) // 10 + 1, -(-size[h] // 10)) for h, i in keys}
        assert numbered(rows.limit(0), ["host"], [F.col("i")], 10, whole=whole).count() == 0


def test_city_pages(spark):
    from tessera.operators.sinks import city_pages

    keys = [("v", "SP", "x", 250), ("v", "RJ", "y", 100), ("w", "SP", "x", 1)]
    rows = [(v, uf, c.upper(), c, "principal" if i % 3 == 0 else "secundario" if i % 3 == 1 else None) for v, uf, c, n in keys for i in range(n)]
    rows = spark.createDataFrame(rows, "vertical string, uf string, municipio string, municipio_slug string, origem_cnae string")
    marcas = spark.createDataFrame([("SP", "x", [("m", 2)]), ("BA", "z", [("m", 1)])], "uf string, municipio_slug string, marcas array<struct<marca string, total long>>")
    got = sorted((r.caminho, r.total, r.principais, r.paginas, r.pagina, r.na_pagina, len(r.marcas)) for r in city_pages(rows, marcas, "v").collect())
    assert got == [
        ("/v/rj/y/", 100, 34, 1, 1, 100, 0), ("/v/sp/x/", 250, 84, 3, 1, 100, 1), ("/v/sp/x/2/", 250, 84, 3, 2, 100, 1), ("/v/sp/x/3/", 250, 84, 3, 3, 50, 1),
        ("/w/sp/x/", 1, 1, 1, 1, 1, 0),
    ]
    assert city_pages(rows.limit(0), marcas, "v").count() == 0


def test_sitemap_files(spark):
    from tessera.operators.sinks import sitemap

    paths = [f"/a&b/{i}/" for i in range(250)]
    rows = spark.createDataFrame([(p,) for p in paths], "caminho string").repartition(5)
    got = {r.caminho: (r.arquivo, r.arquivos, r.entrada) for r in sitemap(rows, "https://s.test", "2026-08-01", 100).collect()}
    assert {p: (i // 100 + 1, 3) for i, p in enumerate(sorted(paths))} == {p: g[:2] for p, g in got.items()}
    assert got["/a&b/7/"][2] == "<url><loc>https://s.test/a&amp;b/7/</loc><lastmod>2026-08-01</lastmod><changefreq>monthly</changefreq></url>"
    assert sitemap(rows.limit(0), "https://s.test", "2026-08-01").count() == 0
