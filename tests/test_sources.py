import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import brands, crosswalk, reports, resolve, sinks
from tessera.sources import catalog, registry, shops


def _docs(spark, text, hint=""):
    return spark.createDataFrame([(text, hint)], "text string, hint string")


def test_delimited_files(spark, tmp_path):
    (tmp_path / "K1.CNAECSV").write_bytes('"01";"Cria\xe7\xe3o\x00"\n"02";""\n'.encode("latin-1"))
    (tmp_path / "other.txt").write_text("no")
    got = registry.read_relation(spark, str(tmp_path), "cnaes", raw=True).orderBy("codigo").collect()
    assert [tuple(r) for r in got] == [("01", "Criação"), ("02", None)]
    (tmp_path / "K2.MOTICSV").write_text('"1";"a";"extra"\n')
    with pytest.raises(Exception):
        registry.read_relation(spark, str(tmp_path), "motivos").collect()


def test_stray_bytes_go_before_records_are_parsed(spark, tmp_path):
    stray = [b"\x00", b"\x1a", b"\x7f", b"\x8f", b""]
    want, out = [], []
    for i in range(400):
        s = lambda k: stray[(i + k) % 5]
        name = f"Manuten\u00e7\u00e3o; n\u00ba {i}" if i % 3 else f'diz "oi" {i}'
        raw = name.replace('"', '""').encode("latin-1")
        out.append(s(0) + b'"' + s(1) + str(i).encode() + b'"' + s(2) + b";" + s(3) + b'"' + raw[:2] + s(4) + raw[2:] + b'"' + s(0) + (b"\r" if i % 2 else b"") + (s(1) if i % 2 else b"") + b"\n")
        want.append((str(i), name))
    (tmp_path / "K3.CNAECSV").write_bytes(b"".join(out))
    whole = registry.read_relation(spark, str(tmp_path), "cnaes", raw=True)
    assert whole.rdd.getNumPartitions() == 1 and [tuple(r) for r in whole.collect()] == want
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in ("97", "1000"):  # ranges that begin and end inside records, and inside quotes
            spark.conf.set(key, size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1")
            cut = registry.read_relation(spark, str(tmp_path), "cnaes", raw=True)
            assert cut.rdd.getNumPartitions() > 10 and sorted(map(tuple, cut.collect())) == sorted(want)
    finally:
        spark.conf.set(key, before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    (tmp_path / "K4.CNAECSV").write_bytes(b'"1";"a";"\x1aextra"\n')
    with pytest.raises(Exception):
        registry.read_relation(spark, str(tmp_path), "cnaes", raw=True).collect()


def test_each_file_has_its_own_dialect(spark, tmp_path):
    (tmp_path / "a.csv").write_text("C\u00f3digo IBGE;Nome do Munic\u00edpio;UF\n3500001;S\u00e3o Tom\u00e9;SP\n3500002;\"A; B\";SP\n")
    (tmp_path / "b.csv").write_text('\ufeffsigla,extra,id,municipio\nRJ,"x, y",33,Niter\u00f3i\n\nRJ,,34,"P""q"\n')
    (tmp_path / "c.csv").write_text("UF|codigo|nome\n")
    got = sorted((r.codigo_ibge, r.nome, r.uf, r.nome_slug) for r in registry.read_ibge(spark, str(tmp_path)).collect())
    assert got == [("33", "Niter\u00f3i", "RJ", "niteroi"), ("34", 'P"q', "RJ", "p-q"), ("3500001", "S\u00e3o Tom\u00e9", "SP", "sao-tome"), ("3500002", "A; B", "SP", "a-b")]
    (tmp_path / "d.csv").write_text("codigo;nome\n1;a\n")
    with pytest.raises(ValueError, match="uf in codigo, nome"):
        registry.read_ibge(spark, str(tmp_path))


def test_header_discovery(spark, tmp_path):
    (tmp_path / "i.csv").write_text("Codigo_IBGE;Nome do Município;UF\n3500001;São Tomé;SP\n")
    r = registry.read_ibge(spark, str(tmp_path / "i.csv")).first()
    assert (r.codigo_ibge, r.nome, r.uf, r.nome_slug) == ("3500001", "São Tomé", "SP", "sao-tome")
    with pytest.raises(ValueError, match="uf"):
        registry.find_columns(["codigo", "nome"], registry.IBGE_KEYS)
    (tmp_path / "i.json").write_text(json.dumps([{"municipio-id": 1, "municipio-nome": "A", "UF-sigla": "SP"}]))
    assert tuple(registry.read_ibge_json(spark, str(tmp_path / "i.json")).first()) == ("1", "A", "SP")


def test_byte_audit(spark, tmp_path):
    (tmp_path / "x.bin").write_bytes(b"ab\x1a\tc\n\x8f\x8fd\n")
    got = {r.byte: r.n for r in registry.suspect_bytes(spark, str(tmp_path)).collect()}
    assert got == {"1a": 1, "8f": 2}
    (tmp_path / "x.bin").write_bytes(b"a\x01b\x01\x1a\"c\x00\n\x9f\r\n")
    assert {r.byte: r.n for r in registry.suspect_bytes(spark, str(tmp_path)).collect()} == {"01": 2, "1a": 1, "00": 1, "9f": 1}


def test_json_shops(spark):
    y = [{"name": " Som  e Luz ", "address": "RUA A, 1 - NATAL, RN 59000-000", "telephoneNumber": "(84) 3222-0000", "emailAddress": "A@B.C", "contractCode": ["PI", "ZZ"]}, {"name": ""}]
    r = shops.yamaha(_docs(spark, json.dumps(y))).collect()
    assert len(r) == 1 and (r[0].nome, r[0].cep, r[0].telefones, r[0].email, r[0].segmento) == ("Som e Luz", "59000-000", "8432220000", "a@b.c", "Pianos acústicos, ZZ")
    c = {"data": [{"store_name": "X", "address": "Rua B, 2<br>Centro", "search1": "SP", "search2": " Campinas ", "tel": "(19) 3222-0000", "opening_hours": "8h  as 18h"}]}
    r = shops.casio(_docs(spark, json.dumps(c))).first()
    assert (r.uf_fonte, r.cidade_fonte, r.endereco, r.horario) == ("SP", "Campinas", "Rua B, 2 Centro", "8h as 18h")
    r = shops.proshows(_docs(spark, json.dumps([{"assistance": "P", "zip": "01310100", "email": "x@y.com"}]), "BA")).first()
    assert (r.nome, r.uf_fonte, r.cep, r.email) == ("P", "BA", "01310-100", "x@y.com")


def test_html_shops(spark):
    page = "<p>x</p><span style='font-weight: bold'>Campinas</span><h5>Luz &amp; Som</h5>Rua A, 1<br>CEP: 13070-000<br>Tel: (19) 3222-0000<br>a@b.com<h5></h5><span style='font-weight: bold'>Santos</span><h5>Mar</h5>Av B, 2"
    r = shops.roland(_docs(spark, page, "São Paulo")).orderBy("nome").collect()
    assert [(x.nome, x.cidade_fonte, x.uf_fonte, x.endereco, x.cep, x.telefones, x.email) for x in r] == [("Luz & Som", "Campinas", "SP", "Rua A, 1", "13070-000", "1932220000", "a@b.com"), ("Mar", "Santos", "SP", "Av B, 2", "", "", "")]
    page = '<div class="x unidade" data-estado="RJ" data-cidade="Niter&oacute;i"><p class="sub-title b">Um</p><p><b>Endereço:</b> Rua C, 3</p><p><b>CEP:</b> 24000-000</p><p><b>Telefone:</b> (21) 2222-0000</p></div>'
    r = shops.tectronica(_docs(spark, page)).first()
    assert (r.nome, r.uf_fonte, r.cidade_fonte, r.endereco, r.cep, r.telefones) == ("Um", "RJ", "Niterói", "Rua C, 3", "24000-000", "2122220000")
    page = 'Lista de Assistências<div class="col-span-12 lg:col-span-4"><h5>Dois</h5><p class="mb-1">Endereço: Rua D, 4, Bairro: Centro</p><p class="mb-1">Recife / PE</p><p class="mb-1">Telefone: (81) 3222-0000</p><p class="mb-1">Contato: Ana</p></div><a href="https://rodape.example">x</a>'
    r = shops.tagima(_docs(spark, page, "PE")).first()
    assert (r.nome, r.uf_fonte, r.cidade_fonte, r.bairro, r.endereco, r.telefones, r.contato, r.site) == ("Dois", "PE", "Recife", "Centro", "Rua D, 4", "8132220000", "Ana", "")
    page = '<div class="selects CE"><div class="item"><h5>Fortaleza</h5><div class="infos"><span>Tres</span><br>Rua E, 5<br>(85) 3222-0000 / <br>c@d.com</div></div></div><div class="selects XX"><div class="item"><h5>n</h5><span>n</span></div></div>'
    r = shops.sonotec(_docs(spark, page)).collect()
    assert [(x.nome, x.uf_fonte, x.cidade_fonte, x.endereco, x.telefones, x.email) for x in r] == [("Tres", "CE", "Fortaleza", "Rua E, 5", "8532220000", "c@d.com")]
    rows = [("sonotec", "s", "", page), ("yamaha", "y", "", "[]")]
    all_ = shops.collect(spark, spark.createDataFrame(rows, "fonte string, document string, hint string, text string"), "2026-01-02")
    assert all_.shops.columns == registry.POSTO and all_.shops.first().posto_id.startswith("sonotec-") and all_.quarantine.count() == 0


def test_catalogue(spark):
    sources = {"a": {"titular": "A"}, "b": {"titular": "B", "bloqueada": "login"}}
    m = catalog.brands(spark, {"x": {"nome": "X", "fonte": "a"}, "y": {"nome": "Y", "fonte": "b"}}, sources)
    assert [r.marca for r in m.collect()] == ["x"]
    assert catalog.networks(spark, sources).count() == 2
    with pytest.raises(ValueError):
        catalog.brands(spark, {"x": {"nome": "X", "fonte": "zz"}}, sources)


def test_city_rules(spark):
    places = spark.createDataFrame([("AL", "maceio", "Maceió", "1"), ("PR", "marechal-candido-rondon", "Marechal", "2"), ("SP", "jau", "Jaú", "3"), ("SP", "sao-paulo", "São Paulo", "4"), ("SP", "campinas", "Campinas", "5"), ("DF", "brasilia", "Brasília", "6"), ("BA", "alagoinhas", "Alagoinhas", "7")], "uf string, municipio_slug string, municipio string, ibge string")
    rows = [("1", "AL", "MACEIO", ""), ("2", "PR", "", "AV X - MARECHAL CANDIDO RONDON - PR"), ("3", "SP", "", "AV Y - JAU, SP"), ("4", "SP", "", "RUA JAU 10 - CENTRO"), ("5", "SP", "", "RUA SAO PAULO, 45 - CENTRO - CAMPINAS, SP"), ("6", "DF", "Taguatinga", "QD 1"), ("7", "BA", "Alagoinha", "RUA Z"), ("8", "SP", None, None)]
    posts = spark.createDataFrame(rows, "posto_id string, uf_fonte string, cidade_fonte string, endereco string").withColumn("fonte", F.lit("f")).withColumn("nome", F.lit("n"))
    found = crosswalk.city_of_posts(posts, places)
    assert {r.posto_id: r.municipio_slug for r in found.collect()} == {"1": "maceio", "2": "marechal-candido-rondon", "3": "jau", "5": "campinas", "6": "brasilia"}
    assert sorted(r.posto_id for r in crosswalk.posts_without_city(posts, found).collect()) == ["4", "7", "8"]


def test_checks_and_sinks(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "a", None), (3, "b", "z")], "id long, g string, t string")
    with pytest.raises(ValueError):
        reports.require_unique(rows, ["g"], "g")
    with pytest.raises(ValueError):
        reports.require_rows(rows.limit(0), "rows")
    reports.require_unique(rows, ["id"], "id")
    assert sinks.write_sqlite(rows, str(tmp_path / "s.db"), "t", {"ix": ["g"]}) == 3
    with pytest.raises(ValueError):
        sinks.write_sqlite(rows.limit(0), str(tmp_path / "e.db"), "t")
    sinks.write_parquet(rows, str(tmp_path / "p"), ["g"], ["id"])
    assert spark.read.parquet(str(tmp_path / "p")).where("g = 'a'").count() == 2
    sinks.write_csv(rows, str(tmp_path / "c"), ["id"], one_file=True)
    assert spark.read.option("header", True).csv(str(tmp_path / "c")).count() == 3
    assert "| 2 | a | — |" in sinks.markdown(rows.orderBy("id"))
    r = rows.where("id = 2").select(sinks.json_ld("Thing", name=F.col("g"), note=F.col("t")).alias("j"), sinks.breadcrumbs((F.lit("Home"), F.lit("/")), (F.col("g"), None)).alias("b"), sinks.percentual(F.lit(1), F.lit(8)).alias("p"), sinks.without_scheme(F.lit("https://a.b/c")).alias("u"), sinks.content_name(F.lit("x")).alias("n")).first()
    assert json.loads(r.j) == {"@context": "https://schema.org", "@type": "Thing", "name": "a"} and "item" not in json.loads(r.b)[1] and (r.p, r.u, len(r.n)) == ("12,5 %", "a.b/c", 10)


def test_shares_have_no_points_between_thousands(spark):
    rows = spark.createDataFrame([(43, 3), (49, 2), (1, 400), (12345678, 1), (7, 0), (7, None), (None, 7), (None, None)], "p int, t int")
    got = [r.s for r in rows.select(sinks.percentual(F.col("p"), F.col("t")).alias("s")).collect()]
    assert got == ["1433,3 %", "2450,0 %", "0,2 %", "1234567800,0 %", "—", "—", None, "—"]


def test_brand_helpers(spark):
    rows = spark.createDataFrame([("m1", "Beta", "f", "SP", "s", "n", "p1"), ("m1", "Beta", "f", "SP", None, "n", "p2"), ("m2", "alfa", "f", "SP", "s", "n", "p1")], "marca string, marca_nome string, fonte string, uf string, municipio_slug string, nome string, posto_id string").withColumn("coletado_em", F.to_date(F.lit("2024-01-02")))
    top = brands.ranked(rows)
    assert [r.marca for r in top.collect()] == ["m1", "m2"]
    assert brands.one_per_source(top.withColumn("destaque", F.col("marca") == "m2"), "destaque").first().marca == "m2"
    with_city = rows.withColumn("municipio", F.upper("municipio_slug"))
    assert [x.posto_id for x in brands.nested(with_city).where("marca = 'm1'").first().postos] == ["p1", "p2"]
    old = spark.createDataFrame([("a", 1), ("b", 2)], "fonte string, v int")
    assert sorted(map(tuple, resolve.refresh(old, spark.createDataFrame([("b", 3)], "fonte string, v int")).collect())) == [("a", 1), ("b", 3)]


def test_one_bad_page_costs_one_page(spark):
    good = '<div class="x unidade" data-estado="RJ" data-cidade="B"><p class="sub-title b">Loja {}</p><p><b>Endereço:</b> Rua C, {}</p></div>'
    rows = [("tectronica", f"p{i}", "", good.format(i, i) if i != 37 else "<html>moved</html>") for i in range(100)]
    rows += [("yamaha", "cut.json", "", '[{"name": "A", "addr'), ("yamaha", "ok.json", "", '[{"name": "A"}, {"name": " "}]'), ("casio", "list.json", "", "[]"), ("nobody", "n", "", "x"), ("roland", "e", "SP", " "), ("sonotec", "z", None, None), (None, "q", "", "x")]
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("shops"))
    spark.sparkContext.setJobGroup("shops", "reading")
    got = shops.collect(spark, spark.createDataFrame(rows, "fonte string, document string, hint string, text string"), "2026-01-02")
    assert jobs() == 1  # all sources and the quarantine
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    found = got.shops.collect()
    assert sorted(r.nome for r in found) == sorted(["A", *(f"Loja {i}" for i in range(100) if i != 37)])
    assert {(r.fonte, r.document, r.reason) for r in got.quarantine.collect()} == {
        ("tectronica", "p37", "no record on the page"), ("yamaha", "cut.json", "not the JSON that was expected"), ("casio", "list.json", "not the JSON that was expected"),
        ("nobody", "n", "no parser for this source"), ("roland", "e", "no text"), ("sonotec", "z", "no text"), (None, "q", "no parser for this source"),
    }


def test_checks_of_codes(spark):
    codes = spark.createDataFrame([("1", "a")], "codigo string, descricao string")
    reports.require_valid_codes(spark.createDataFrame([("v", "1")], "vertical string, cnae string"), codes)
    with pytest.raises(ValueError, match="'9'"):
        reports.require_valid_codes(spark.createDataFrame([("v", "1"), ("v", "9")], "vertical string, cnae string"), codes)


def test_hot_values_and_meta_of_sinks(spark, tmp_path):
    import sqlite3

    rows = spark.range(4000).selectExpr("id", "CASE WHEN id % 10 < 8 THEN 'hot' ELSE concat('v', id % 10) END AS g")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # small files are put together otherwise
    try:
        sinks.write_parquet(rows, str(tmp_path / "p"), ["g"], ["id"])
    finally:
        spark.conf.unset(key)
    back = spark.read.parquet(str(tmp_path / "p"))
    assert back.count() == 4000 and len(back.where("g = 'hot'").selectExpr("input_file_name() AS f").distinct().collect()) > 1
    sinks.write_sqlite(rows.limit(5), str(tmp_path / "m.db"), "t", meta={"safra": "2026-08"})
    with sqlite3.connect(tmp_path / "m.db") as con:
        assert dict(con.execute("SELECT chave, valor FROM meta")) == {"linhas": "5", "safra": "2026-08"}


def test_staged_tables_are_removed(spark):
    from tessera import staging

    with staging.temporary_tables(spark):
        kept = staging.stage(spark.range(3).toDF("a"), "x")
        files = kept.inputFiles()
        assert kept.count() == 3 and files
    import os

    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)


def _staged(spark):
    import os

    from tessera import staging

    top = staging.shared_dir(spark).removeprefix("file://") + "/tessera"
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_queries_own_what_they_stage(spark, sf_dir, tmp_path):
    from tessera import staging
    from tessera.plans import publishing  # noqa: F401
    from tessera.plans.queries import QUERIES

    before = _staged(spark)
    for name in ("q42_csv_round_trip", "q45_target_rows", "q58_posts_round_trip", "q61_quarantine", "q63_versioned_refresh", "q64_observed_counts"):
        result = QUERIES[name][0](spark, sf_dir)
        result.write.parquet(str(tmp_path / name))
        assert _staged(spark) > before, name
        staging.release(result)
        assert _staged(spark) == before, name
        staging.release(result)  # again, for nothing

    @staging.owned
    def fails(spark):
        staging.stage(spark.range(3), "x")
        raise ValueError

    with pytest.raises(ValueError):
        fails(spark)
    with staging.temporary_tables(spark):  # a scope takes what queries inside it leave
        QUERIES["q58_posts_round_trip"][0](spark, sf_dir).count()
    assert _staged(spark) == before


def test_scopes_of_two_threads(spark):
    import threading

    from tessera import staging

    before, made, go = _staged(spark), threading.Barrier(2), threading.Barrier(2)
    failed = []

    def work(first):
        try:
            with staging.temporary_tables(spark):
                kept = staging.stage(spark.range(5), "thread")
                made.wait(60)
                if first:
                    return
                go.wait(60)  # the other scope has ended
                assert kept.count() == 5
        except BaseException as error:
            failed.append(error)

    one, two = threading.Thread(target=work, args=(True,)), threading.Thread(target=work, args=(False,))
    one.start(), two.start()
    one.join()
    go.wait(60)
    two.join()
    assert not failed and _staged(spark) == before


def test_documents_are_read_whole(spark, tmp_path):
    (tmp_path / "a.html").write_text("<p>um</p>\n\n<p>dois</p>\n")
    (tmp_path / "b.json").write_text("[]")
    got = {r.path.rsplit("/", 1)[1]: r.text for r in registry.read_documents(spark, str(tmp_path)).collect()}
    assert got == {"a.html": "<p>um</p>\n\n<p>dois</p>\n", "b.json": "[]"}
