"""The query registry: name -> (Spark function, equivalent SQL or None)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import address as A
from ..functions import extract as X
from ..functions import phones as P
from ..functions import text as T
from ..operators import brands, classify, crosswalk, reports, resolve, target
from ..sources import registry as src
from ..sources import shops
from ..staging import new_path, owned, stage
from ..tables import table
from . import oracle as O
from . import sample_registry as R

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = (owned(fn), sql)
        return fn

    return add


def _rows(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


# ---------------------------------------------------------------- scalar library

_PHONES = [(1, "21", "3344-5566"), (2, "(31)", "912345678"), (3, "20", "33445566"), (4, "21", "3344556"), (5, "21", "77777777"), (6, None, "33445566"), (7, "21", None), (8, "21", "83445566")]


def _made_phones(spark, sf):
    made = table(spark, sf, "customer").selectExpr("c_custkey + 10000000 as k", "lpad(cast(c_custkey % 100 as string), 2, '0') as ddd", "cast(c_custkey * 7919 % 1000000000 as string) as num")
    fixed = _rows(spark, [(-i, d, n) for i, d, n in _PHONES], "k long, ddd string, num string")
    return made.unionByName(fixed)


def _all_phone_inputs(spark, sf):
    """Every phone of every text, numbered from 1 in ``pos``."""
    rx = F.lit(r"[(]([0-9]{3})[)] ([0-9]{3}-[0-9]{4})")
    both = F.arrays_zip(F.regexp_extract_all("text", rx, F.lit(1)).alias("ddd"), F.regexp_extract_all("text", rx, F.lit(2)).alias("num"))
    found = table(spark, sf, "documents").select(F.col("doc_id").alias("k"), F.posexplode(both).alias("i", "m"))
    found = found.select("k", (F.col("i") + 1).alias("pos"), F.substring("m.ddd", 1, 2).alias("ddd"), F.concat(F.lit("9"), "m.num").alias("num"))
    return found.unionByName(_made_phones(spark, sf).withColumn("pos", F.lit(1)))


_PHONE_RX = "[(]([0-9]{3})[)] ([0-9]{3}-[0-9]{4})"
_ALL_PHONES_CTE = (
    f"f AS (SELECT doc_id AS k, unnest(regexp_extract_all(text, '{_PHONE_RX}', 1)) AS a, unnest(regexp_extract_all(text, '{_PHONE_RX}', 2)) AS n, "
    f"generate_subscripts(regexp_extract_all(text, '{_PHONE_RX}'), 1) AS pos FROM documents), "
    "p AS (SELECT k, pos, a[1:2] AS ddd, '9' || n AS num FROM f UNION ALL SELECT c_custkey + 10000000, 1, lpad(CAST(c_custkey % 100 AS STRING), 2, '0'), CAST(c_custkey * "
    "7919 % 1000000000 AS STRING) FROM customer "
    "UNION ALL SELECT k, 1, ddd, num FROM " + O.values([(-i, d, n) for i, d, n in _PHONES], "k, ddd, num") + ")"
)


@query(
    f"WITH {_ALL_PHONES_CTE} SELECT k, pos, {O.digits('num')} AS digitos, coalesce({O.digits('ddd')} IN ({', '.join(O.quote(d) for d in P.DDDS)}), false) AS ddd_ok, "
    f"{O.e164('ddd', 'num')} AS e164 FROM p"
)
def q01_phone_e164(spark, sf):
    return _all_phone_inputs(spark, sf).select("k", "pos", T.so_digitos("num").alias("digitos"), F.coalesce(P.ddd_valido(T.so_digitos("ddd")), F.lit(False)).alias("ddd_ok"), P.telefone_e164("ddd", "num").alias("e164"))


@query(
    f"WITH {_ALL_PHONES_CTE}, e AS (SELECT k, pos, {O.e164('ddd', 'num')} AS e FROM p) SELECT k, pos, {O.phone_type('e')} AS tipo, {O.ninth('e')} AS nono, {O.shown('e')} AS "
    f"exibicao, {O.phone_line('e')} AS linha, {O.phone_key('e')} AS chave FROM e"
)
def q02_phone_display(spark, sf):
    e = _all_phone_inputs(spark, sf).select("k", "pos", P.telefone_e164("ddd", "num").alias("e"))
    return e.select("k", "pos", P.tipo_telefone("e").alias("tipo"), P.telefone_com_nono_digito("e").alias("nono"), P.telefone_exibicao("e").alias("exibicao"), P.linha_telefone("e").alias("linha"), P.fone_chave("e").alias("chave"))


@query(
    f"WITH l AS (SELECT lang, unnest(str_split(coalesce(text, ''), chr(10))) AS line FROM documents), s AS (SELECT lang, {O.slug('line')} AS slug, count(*) AS n FROM l GROUP BY 1, 2), "
    "r AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY n DESC, slug NULLS LAST) AS pos FROM s) SELECT lang, slug, n, pos FROM r WHERE pos <= 100"
)
def q03_slug_top(spark, sf):
    """Slug of every line of every document, counted, the hundred most frequent by language."""
    lines = table(spark, sf, "documents").select("lang", F.explode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line")).select("lang", T.slug("line").alias("slug"))
    return reports.top_per_group(lines.groupBy("lang", "slug").agg(F.count(F.lit(1)).alias("n")), ["lang"], [F.desc("n"), F.asc_nulls_last("slug")], 100)


_MAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+"
_MAILS = [(-1, "Oficina@SOM-e-luz.com.br "), (-2, "x@y"), (-3, "sem arroba"), (-4, None), (-5, "a@gmail.com"), (-6, "b@www.terra.com.br")]


@query(
    f"WITH x AS (SELECT doc_id AS k, regexp_extract_all(text, '{_MAIL}') AS l FROM documents), m AS (SELECT k, unnest(CASE WHEN len(l) > 0 THEN l ELSE [NULL] END) AS mail, "
    f"unnest(range(1, greatest(1, coalesce(len(l), 0)) + 1)) AS pos FROM x UNION ALL SELECT k, mail, 1 FROM {O.values(_MAILS, 'k, mail')}), "
    f"d AS (SELECT k, pos, {O.mail_domain('mail')} AS dominio FROM m) SELECT k, pos, dominio, {O.provider('dominio')} AS provedor, {O.own_site('dominio')} AS site FROM d"
)
def q04_mail_domain(spark, sf):
    """Every address of every text, numbered from 1 in ``pos``; a text without one keeps one row."""
    found = table(spark, sf, "documents").select(F.col("doc_id").alias("k"), F.posexplode_outer(F.regexp_extract_all("text", F.lit(_MAIL), F.lit(0))).alias("i", "mail"))
    m = found.select("k", (F.coalesce("i", F.lit(0)) + 1).alias("pos"), "mail").unionByName(_rows(spark, _MAILS, "k long, mail string").withColumn("pos", F.lit(1)))
    d = m.select("k", "pos", A.dominio_email("mail").alias("dominio"))
    return d.select("k", "pos", "dominio", A.dominio_provedor("dominio").alias("provedor"), A.site_candidato(F.col("dominio")).alias("site"))


@query(
    f"WITH w AS (SELECT doc_id, replace(text, 'ß', 'ss') AS t FROM documents) SELECT doc_id, {O.title('t')} AS titulo, {O.natural('upper(t)')} AS gritado, {O.natural('t')} "
    "AS natural_ FROM w"
)
def q05_title_case(spark, sf):
    w = table(spark, sf, "documents").select("doc_id", F.replace("text", F.lit("ß"), F.lit("ss")).alias("t"))
    return w.select("doc_id", T.titulo_caso("t").alias("titulo"), T.caso_natural(F.upper("t")).alias("gritado"), T.caso_natural("t").alias("natural_"))


_STREETS = [(1, "RUA", "RUA A", "12345678", "FULANO DE TAL 00000000000"), (2, "rua", "RUA", "12.345-678", "12.345.678 FULANO"), (3, "", "A", "1234", "CASA 2020"), (4, "RUA", None, None, None), (5, None, None, "", "1234")]


@query(
    f"WITH s AS (SELECT * FROM {O.values(_STREETS, 'k, tipo, nome, cep, dono')} UNION ALL SELECT c_custkey + 100, 'AVENIDA', c_name, CAST(c_custkey * 12345 % 1000000000 AS "
    "STRING), c_name || lpad(CAST(c_custkey AS STRING), 11, '0') FROM customer) "
    f"SELECT k, {O.street('tipo', 'nome')} AS rua, {O.short_street(O.title(O.street('tipo', 'nome')))} AS curta, {O.postal('cep')} AS cep_fmt, {O.clean_name('dono')} AS "
    f"publico, {O.shown_name('dono')} AS mostrado, "
    f"{O.cnpj('''lpad(CAST(k AS STRING), 14, '0')''')} AS cnpj, coalesce(regexp_matches({O.clean_name('dono')}, '[0-9]{{11}}$'), false) AS vaza FROM s"
)
def q06_addresses_and_names(spark, sf):
    fixed = _rows(spark, _STREETS, "k long, tipo string, nome string, cep string, dono string")
    made = table(spark, sf, "customer").selectExpr("c_custkey + 100 as k", "'AVENIDA' as tipo", "c_name as nome", "cast(c_custkey * 12345 % 1000000000 as string) as cep", "c_name || lpad(cast(c_custkey as string), 11, '0') as dono")
    s = fixed.unionByName(made)
    rua = A.logradouro_completo("tipo", "nome")
    return s.select("k", rua.alias("rua"), A.abreviar_logradouro(T.titulo_caso(rua)).alias("curta"), A.cep_formatado("cep").alias("cep_fmt"), T.nome_publicavel("dono").alias("publico"), T.texto_nome("dono").alias("mostrado"),
                    T.cnpj_formatado(F.lpad(F.col("k").cast("string"), 14, "0")).alias("cnpj"), F.coalesce(T.nome_publicavel("dono").rlike(r"[0-9]{11}\z"), F.lit(False)).alias("vaza"))


@query(
    "SELECT c_custkey, concat_ws(chr(10), c_name, CASE WHEN c_acctbal > 0 THEN 'Saldo: ' || CAST(CAST(c_acctbal AS BIGINT) AS STRING) END, n_name || '-' || r_name, CASE "
    "WHEN c_custkey % 2 = 0 THEN 'par' END) AS ficha, "
    "CASE c_mktsegment WHEN 'BUILDING' THEN 'obra' WHEN 'MACHINERY' THEN 'máquina' END AS ramo, coalesce(n_name = 'NATION_2', false) AS local_, CAST(NULL AS DOUBLE) AS "
    "lat, '2026-08' AS safra "
    "FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey AND r_name <> 'ASIA'"
)
def q07_record_card(spark, sf):
    """Parts that are null leave no line; a null inside a part drops the part."""
    c, n, r = (table(spark, sf, t) for t in ("customer", "nation", "region"))
    rows = c.join(n, F.col("n_nationkey") == F.col("c_nationkey"), "left").join(r.where("r_name <> 'ASIA'"), F.col("r_regionkey") == F.col("n_regionkey"), "left")
    saldo = F.when(F.col("c_acctbal") > 0, F.concat(F.lit("Saldo: "), F.rint("c_acctbal").cast("long").cast("string")))
    card = target.record_card("c_name", saldo, F.concat("n_name", F.lit("-"), "r_name"), F.when(F.col("c_custkey") % 2 == 0, "par"))
    ramo = F.when(F.col("c_mktsegment") == "BUILDING", "obra").when(F.col("c_mktsegment") == "MACHINERY", "máquina")
    return rows.select("c_custkey", card.alias("ficha"), ramo.alias("ramo"), F.coalesce(F.col("n_name") == "NATION_2", F.lit(False)).alias("local_"), F.lit(None).cast("double").alias("lat"), F.lit("2026-08").alias("safra"))


_DATES = [(-1, "20240229", "2024-02-29"), (-2, "20240231", "2024-13-01"), (-3, "2024", "x"), (-4, None, None), (-5, "", "")]


@query(
    "WITH d AS (SELECT o_orderkey AS k, strftime(o_orderdate, '%Y%m%d') AS a, CASE WHEN o_orderkey % 3 = 0 THEN 'n/d' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS b FROM "
    f"orders UNION ALL SELECT * FROM {O.values(_DATES, 'k, a, b')}) "
    "SELECT k, CAST(try_strptime(a, '%Y%m%d') AS DATE) AS compacta, try_cast(b AS DATE) AS iso, try_cast(b AS BIGINT) AS numero FROM d"
)
def q08_safe_parse(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "yyyyMMdd").alias("a"), F.when(F.col("o_orderkey") % 3 == 0, "n/d").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("b"))
    d = o.unionByName(_rows(spark, _DATES, "k long, a string, b string"))
    compact = F.when(F.length("a") == 8, F.try_to_date("a", "yyyyMMdd"))
    return d.select("k", compact.alias("compacta"), F.try_to_date("b").alias("iso"), F.col("b").try_cast("bigint").alias("numero"))


@query("SELECT doc_id, lang FROM documents WHERE regexp_matches(lower(strip_accents(text)), 'eaux|ieren|schon|cion')")
def q09_accent_free_search(spark, sf):
    return table(spark, sf, "documents").where(F.lower(T.strip_accents(F.col("text"))).rlike("eaux|ieren|schon|cion")).select("doc_id", "lang")


# ---------------------------------------------------------------- classification

_TARGET = """alvo AS (
  SELECT cnpj_basico, cnpj_ordem, cnpj_dv, cnae_fiscal_principal AS cnae, 'principal' AS origem FROM estabelecimentos
  WHERE situacao_cadastral = '02' AND cnae_fiscal_principal IN (SELECT cnae FROM vertical_cnae)
  UNION ALL
  SELECT cnpj_basico, cnpj_ordem, cnpj_dv, trim(x), 'secundario' FROM estabelecimentos, unnest(str_split(cnae_fiscal_secundaria, ',')) AS u(x)
  WHERE situacao_cadastral = '02' AND cnae_fiscal_secundaria <> '' AND trim(x) IN (SELECT cnae FROM vertical_cnae)),
verticais AS (
  SELECT cnpj_basico || cnpj_ordem || cnpj_dv AS id, vertical, rotulo, CASE WHEN bool_or(origem = 'principal') THEN 'principal' ELSE 'secundario' END AS origem_cnae,
         string_agg(DISTINCT a.cnae, ',' ORDER BY a.cnae) AS cnaes_da_vertical
  FROM alvo a JOIN vertical_cnae v ON v.cnae = a.cnae GROUP BY 1, 2, 3)"""
_COUNTS = """contagem AS (
  SELECT c.codigo, c.descricao, coalesce(p.n, 0) AS n_principal, coalesce(s.n, 0) AS n_secundario FROM cnaes c
  LEFT JOIN (SELECT cnae_fiscal_principal AS codigo, count(*) AS n FROM estabelecimentos WHERE situacao_cadastral = '02' GROUP BY 1) p ON p.codigo = c.codigo
  LEFT JOIN (SELECT trim(x) AS codigo, count(*) AS n FROM estabelecimentos, unnest(str_split(cnae_fiscal_secundaria, ',')) AS u(x) WHERE situacao_cadastral = '02' AND trim(x) <> '' GROUP BY 1) s ON s.codigo = c.codigo)"""


def _target(r) -> DataFrame:
    return classify.target_codes(r["estabelecimentos"], r["vertical_cnae"])


@query(f"WITH {R.CTE}, {_COUNTS} SELECT * FROM contagem")
def q10_code_counts(spark, sf):
    r = R.relations(spark, sf)
    return classify.code_counts(r["estabelecimentos"], r["cnaes"])


@query(f"WITH {R.CTE}, {_TARGET} SELECT * FROM verticais")
def q11_classification(spark, sf):
    r = R.relations(spark, sf)
    return classify.verticals_of(_target(r), r["vertical_cnae"])


@query(
    "WITH p AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2), r AS (SELECT *, CAST(sum(n) OVER (PARTITION BY o_custkey) AS BIGINT) AS n_total, "
    "row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority) AS pos FROM p) SELECT o_custkey, o_orderpriority, n, n_total, n <> n_total AS ambiguous FROM r WHERE pos = 1"
)
def q12_mode_with_ties(spark, sf):
    return crosswalk.mode_with_ties(table(spark, sf, "orders"), "o_custkey", "o_orderpriority")


_CROSS = f"""municipio_uf AS (
  SELECT codigo_rfb, uf, n, n_total, n <> n_total AS uf_ambigua FROM (
    SELECT *, row_number() OVER (PARTITION BY codigo_rfb ORDER BY n DESC, uf) AS pos, CAST(sum(n) OVER (PARTITION BY codigo_rfb) AS BIGINT) AS n_total
    FROM (SELECT municipio AS codigo_rfb, uf, count(*) AS n FROM estabelecimentos WHERE municipio <> '' AND length(uf) = 2 GROUP BY 1, 2)) WHERE pos = 1),
municipios AS (
  SELECT m.codigo_rfb, coalesce(i.nome, m.nome_rfb) AS municipio, m.nome_rfb AS municipio_rfb, u.uf, {O.slug('m.nome_rfb')} AS municipio_slug, i.codigo_ibge AS ibge, u.uf_ambigua, u.n_total AS estabelecimentos_no_municipio
  FROM municipios_rfb m LEFT JOIN municipio_uf u ON u.codigo_rfb = m.codigo_rfb
  LEFT JOIN ibge_municipios i ON i.uf = u.uf AND {O.slug('i.nome')} = {O.slug('m.nome_rfb')})"""


def _municipios(r) -> DataFrame:
    return crosswalk.municipalities(r["municipios_rfb"], crosswalk.state_of_codes(r["estabelecimentos"]), r["ibge_municipios"])


@query(f"WITH {R.CTE}, {_CROSS} SELECT * FROM municipios")
def q13_crosswalk(spark, sf):
    return _municipios(R.relations(spark, sf))


@query(
    f"WITH {R.CTE}, {_CROSS} SELECT codigo_rfb, municipio, municipio_slug, uf, estabelecimentos_no_municipio, CASE WHEN uf IS NULL THEN 'sem UF: nenhum estabelecimento usa este código' "
    "WHEN ibge IS NULL THEN 'sem correspondência IBGE por nome+UF' END AS motivo FROM municipios WHERE ibge IS NULL OR uf IS NULL"
)
def q14_unmatched(spark, sf):
    return crosswalk.unmatched(_municipios(R.relations(spark, sf)))


@query(
    f"WITH d AS (SELECT CAST(p_partkey AS STRING) AS codigo_rfb, p_name AS municipio, {O.slug('p_name')} AS municipio_slug, p_brand AS uf FROM part) "
    "SELECT uf, municipio_slug, count(*) AS n, string_agg(codigo_rfb || '=' || municipio, ' | ' ORDER BY codigo_rfb || '=' || municipio) AS colisoes FROM d WHERE "
    "municipio_slug IS NOT NULL AND uf IS NOT NULL GROUP BY 1, 2 HAVING count(*) > 1"
)
def q14b_duplicate_slugs(spark, sf):
    p = table(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("codigo_rfb"), F.col("p_name").alias("municipio"), T.slug("p_name").alias("municipio_slug"), F.col("p_brand").alias("uf"))
    return crosswalk.duplicate_slugs(p)


@query(f"WITH {R.CTE} SELECT vertical, v.cnae FROM vertical_cnae v LEFT JOIN cnaes c ON c.codigo = v.cnae WHERE c.codigo IS NULL")
def q15_invalid_codes(spark, sf):
    r = R.relations(spark, sf)
    return reports.invalid_codes(r["vertical_cnae"], r["cnaes"])


@query(
    "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, c_name, n_name, p_brand, r_name, o_orderpriority FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND "
    "o_orderstatus = 'F' "
    "LEFT JOIN customer ON c_custkey = o_custkey LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey LEFT JOIN part ON p_partkey = "
    "l_partkey AND p_size > 10"
)
def q16_star_join(spark, sf):
    """Lines with what is known of their order, customer, place and part.

    Customers meet orders before lines do: the lines of open orders, half of all, would meet them under
    one key, null.  The looked-up sides are keyed uniquely and hashed, so that no task sorts its lines.
    """
    li, o, c, n, r, p = (table(spark, sf, t) for t in ("lineitem", "orders", "customer", "nation", "region", "part"))
    closed = o.where("o_orderstatus = 'F'").select("o_orderkey", "o_custkey", "o_orderpriority")
    closed = closed.join(c.select("c_custkey", "c_name", "c_nationkey").hint("shuffle_hash"), F.col("c_custkey") == F.col("o_custkey"), "left")
    place = n.join(r, F.col("r_regionkey") == F.col("n_regionkey"), "left").select("n_nationkey", "n_name", "r_name")
    return (
        li.select("l_orderkey", "l_linenumber", "l_partkey")
        .join(closed.hint("shuffle_hash"), F.col("o_orderkey") == F.col("l_orderkey"), "left")
        .join(p.where("p_size > 10").select("p_partkey", "p_brand").hint("shuffle_hash"), F.col("p_partkey") == F.col("l_partkey"), "left")
        .join(place, F.col("n_nationkey") == F.col("c_nationkey"), "left")
        .select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey", "c_name", "n_name", "p_brand", "r_name", "o_orderpriority")
    )


@query(
    "SELECT event_type, count(*) AS total, count(CASE WHEN value > 50 THEN value END) AS com_valor, count(*) FILTER (WHERE value > 100) AS altos, count(*) FILTER (WHERE "
    "user_id % 2 = 0) AS pares, bool_or(value > 150) AS algum, min(value) AS menor, max(value) AS maior FROM events "
    "WHERE event_type <> 'error' AND value IS NOT NULL GROUP BY event_type"
)
def q17_counts(spark, sf):
    v = F.col("value")
    return table(spark, sf, "events").where((F.col("event_type") != "error") & v.isNotNull()).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("total"), F.count(F.when(v > 50, v)).alias("com_valor"), F.count_if(v > 100).alias("altos"), F.expr("count(*) FILTER (WHERE user_id % 2 = 0)").alias("pares"),
        F.bool_or(v > 150).alias("algum"), F.min(v).alias("menor"), F.max(v).alias("maior"))


@query(
    "SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, count(DISTINCT CAST(ts AS DATE)) AS days, count(DISTINCT CAST(user_id AS STRING) || '/' || "
    "strftime(ts, '%Y-%m-%d')) AS user_days FROM events GROUP BY 1"
)
def q18_distinct_counts(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"), F.count_distinct(F.to_date("ts")).alias("days"),
        F.count_distinct(F.concat(F.col("user_id").cast("string"), F.lit("/"), F.date_format("ts", "yyyy-MM-dd"))).alias("user_days"))


# ---------------------------------------------------------------- the wide target and its reports


def _phone_sql(c: str) -> str:
    return f"{O.phone_type(c)} AS {c}_tipo, {O.shown(c)} AS {c}_formatado, {O.ninth(c)} AS {c}_9, {O.shown(O.ninth(c))} AS {c}_9_formatado"


_RUA = "concat_ws(' - ', concat_ws(', ', logradouro, numero), bairro)"
_WIDE = f"""base AS (
  SELECT e.cnpj_basico || e.cnpj_ordem || e.cnpj_dv AS id, {O.shown_name('e.nome_fantasia')} AS nome_fantasia, trim(emp.razao_social) AS razao_social, {O.shown_name('emp.razao_social')} AS razao_social_publicavel,
    {O.short_street(O.title(O.street('e.tipo_logradouro', 'e.logradouro')))} AS logradouro, nullif(upper(trim(e.numero)), '') AS numero, {O.title('e.complemento')} AS complemento, {O.title('e.bairro')} AS bairro,
    nullif({O.digits('e.cep')}, '') AS cep, {O.postal('e.cep')} AS cep_formatado, m.municipio, m.municipio_slug, m.ibge, e.uf, m.municipio || '-' || e.uf AS cidade_uf,
    {O.e164('e.ddd_1', 'e.telefone_1')} AS telefone, {O.e164('e.ddd_2', 'e.telefone_2')} AS telefone_2, lower(nullif(trim(e.correio_eletronico), '')) AS email, {O.mail_domain('e.correio_eletronico')} AS dominio_email,
    e.cnae_fiscal_principal AS cnae_principal, c.descricao AS cnae_principal_desc, nullif(e.cnae_fiscal_secundaria, '') AS cnaes_secundarios,
    CASE WHEN length(e.data_inicio_atividade) = 8 THEN CAST(try_strptime(e.data_inicio_atividade, '%Y%m%d') AS DATE) END AS data_abertura, emp.porte AS porte_codigo, {O.company_size('emp.porte')} AS porte,
    coalesce(s.opcao_mei = 'S', false) AS mei, e.identificador_matriz_filial = '1' AS matriz
  FROM estabelecimentos e SEMI JOIN alvo a ON a.cnpj_basico = e.cnpj_basico AND a.cnpj_ordem = e.cnpj_ordem AND a.cnpj_dv = e.cnpj_dv
  LEFT JOIN empresas emp ON emp.cnpj_basico = e.cnpj_basico LEFT JOIN simples s ON s.cnpj_basico = e.cnpj_basico
  LEFT JOIN municipios m ON m.codigo_rfb = e.municipio LEFT JOIN cnaes c ON c.codigo = e.cnae_fiscal_principal),
nomes AS (SELECT *, {O.cnpj('id')} AS cnpj_formatado, coalesce(nome_fantasia, razao_social_publicavel, 'CNPJ ' || {O.cnpj('id')}) AS nome, {_phone_sql('telefone')}, {_phone_sql('telefone_2')},
  {O.provider('dominio_email')} AS dominio_provedor, {O.own_site('dominio_email')} AS site_candidato, {_RUA} AS endereco,
  concat_ws(' - ', concat_ws(', ', logradouro, numero, complemento), bairro) AS endereco_com_complemento,
  concat_ws(chr(10), nome_fantasia, razao_social_publicavel, {_RUA}, cidade_uf, 'CEP: ' || cep_formatado, {O.phone_line('telefone')}, {O.phone_line('telefone_2')}, email) AS ficha FROM base),
chaves AS (SELECT id, uf, municipio_slug, cep, {O.slug('logradouro')} AS lg, upper(coalesce(numero, '')) AS num, {O.slug('nome')} AS nm FROM nomes WHERE nome IS NOT NULL AND cep IS NOT NULL AND logradouro IS NOT NULL),
gemeas AS (SELECT DISTINCT a.id FROM (SELECT DISTINCT * FROM chaves) a JOIN (SELECT uf, municipio_slug, cep, lg, num, nm, min(id) AS lo, max(id) AS hi FROM chaves GROUP BY ALL) b
  ON a.uf = b.uf AND a.municipio_slug = b.municipio_slug AND a.cep = b.cep AND a.lg = b.lg AND a.num = b.num AND (a.nm <> b.nm OR b.lo <> b.hi) AND jaro_winkler_similarity(a.nm, b.nm) >= 0.9),
wide AS (SELECT *, id IN (SELECT id FROM gemeas) AS suspeita_duplicata FROM nomes)"""
_EXPORT = f"{R.CTE},\n{_TARGET},\n{_CROSS},\n{_WIDE},\nexportacao AS (SELECT w.*, v.vertical, v.rotulo AS vertical_rotulo, v.origem_cnae FROM wide w JOIN verticais v ON v.id = w.id)"
_WIDE_COLUMNS = (
    "id cnpj_formatado nome nome_fantasia razao_social razao_social_publicavel logradouro numero complemento bairro endereco endereco_com_complemento cep cep_formatado "
    "municipio municipio_slug ibge uf cidade_uf "
    "telefone telefone_tipo telefone_formatado telefone_9 telefone_9_formatado telefone_2 telefone_2_tipo telefone_2_formatado telefone_2_9 telefone_2_9_formatado email "
    "dominio_email dominio_provedor site_candidato "
    "cnae_principal cnae_principal_desc cnaes_secundarios data_abertura porte_codigo porte mei matriz suspeita_duplicata ficha"
).split()


def _wide(r, flagged: bool = True) -> DataFrame:
    return target.establishments(r["estabelecimentos"], _target(r), r["empresas"], r["simples"], _municipios(r), r["cnaes"], "2026-08", flagged)


def _phones_of_target(spark, sf) -> DataFrame:
    r = R.relations(spark, sf)
    return target.phones(r["estabelecimentos"], _target(r))


def _export(spark, sf, flagged: bool = True) -> DataFrame:
    r = R.relations(spark, sf)
    return target.export(_wide(r, flagged), classify.verticals_of(_target(r), r["vertical_cnae"]))


@query(f"WITH {_EXPORT} SELECT {', '.join(_WIDE_COLUMNS)} FROM wide")
def q45_target_rows(spark, sf):
    return _wide(R.relations(spark, sf)).select(*_WIDE_COLUMNS)


_PUBLISHED = "id vertical uf municipio municipio_slug ibge nome_fantasia endereco cidade_uf telefone telefone_formatado email site_candidato cnpj_formatado mei suspeita_duplicata origem_cnae cnae_principal ficha".split()


@query(f"WITH {_EXPORT} SELECT {', '.join(_PUBLISHED)}, razao_social_publicavel AS razao_social, cep_formatado AS cep FROM exportacao WHERE uf <> 'EX' AND municipio_slug IS NOT NULL")
def q46_publication(spark, sf):
    return target.publication(_export(spark, sf)).select(*_PUBLISHED, "razao_social", "cep")


_BY_CITY = (
    "cidades AS (SELECT vertical, uf, municipio, municipio_slug, ibge, count(*) AS total, count(telefone) AS com_telefone, count(*) FILTER (WHERE telefone_tipo = 'fixo') "
    "AS com_fixo, count(*) FILTER (WHERE telefone_tipo = 'movel') AS com_movel, "
    "count(email) AS com_email, count(site_candidato) AS com_site_candidato FROM exportacao GROUP BY ALL)"
)


@query(
    f"WITH {_EXPORT}, {_BY_CITY} SELECT *, row_number() OVER (PARTITION BY vertical ORDER BY total DESC, uf NULLS LAST, municipio NULLS LAST, municipio_slug NULLS LAST) AS pos "
    "FROM cidades QUALIFY pos <= 100"
)
def q19_top_cities(spark, sf):
    return reports.top_cities(reports.by_city(_export(spark, sf, flagged=False)))


@query(
    "WITH t AS (SELECT o_custkey, count(*) AS total FROM orders GROUP BY 1), f AS (SELECT c_mktsegment, CASE WHEN total = 1 THEN '1' WHEN total = 2 THEN '2' WHEN total "
    "BETWEEN 3 AND 5 THEN '3-5' WHEN total BETWEEN 6 AND 10 THEN '6-10' ELSE '11+' END AS faixa, total "
    "FROM t JOIN customer ON c_custkey = o_custkey) SELECT c_mktsegment, faixa, count(*) AS cidades, CAST(sum(total) AS BIGINT) AS estabelecimentos FROM f GROUP BY 1, 2"
)
def q20_size_bands(spark, sf):
    t = table(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("total"))
    c = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return reports.size_bands(t.join(c, F.col("c_custkey") == F.col("o_custkey")), "c_mktsegment")


@query(
    f"WITH {_EXPORT}, p AS (SELECT vertical, a.cnae, count(*) AS n FROM alvo a JOIN vertical_cnae v ON v.cnae = a.cnae GROUP BY 1, 2) SELECT vertical, p.cnae, descricao, n, "
    "round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY vertical), 1) AS pct_da_vertical FROM p JOIN cnaes c ON c.codigo = p.cnae"
)
def q21_composition(spark, sf):
    r = R.relations(spark, sf)
    # every mapped code is in the dictionary here but one, whose share still counts in its group
    return reports.composition(_target(r), r["vertical_cnae"], r["cnaes"])


@query(
    f"WITH {_EXPORT} SELECT vertical, count(*) AS total, count(DISTINCT municipio_slug || '/' || uf) AS cidades, count(telefone) AS com_telefone, count(*) FILTER (WHERE "
    "telefone_tipo = 'fixo') AS com_fixo, count(*) FILTER (WHERE telefone_tipo = 'movel') AS com_movel, "
    "count(telefone_2) AS com_segundo_telefone, count(nome_fantasia) AS com_nome_fantasia, count(email) AS com_email, count(site_candidato) AS com_site_candidato, "
    "count(endereco) AS com_endereco, count(cep_formatado) AS com_cep, "
    "count(*) FILTER (WHERE origem_cnae = 'principal') AS via_cnae_principal, count(*) FILTER (WHERE origem_cnae = 'secundario') AS via_cnae_secundario, count(*) FILTER "
    "(WHERE mei) AS mei, count(*) FILTER (WHERE matriz) AS matriz, count(*) FILTER (WHERE suspeita_duplicata) AS suspeita_duplicata, count(*) FILTER (WHERE ibge IS NULL) "
    "AS sem_ibge FROM exportacao GROUP BY 1"
)
def q22_fill_rates(spark, sf):
    return reports.fill_rates(_export(spark, sf))


@query(
    "WITH e AS (SELECT event_type, strftime(ts, '%Y-%m-%d') AS dia FROM events), n AS (SELECT event_type, dia, count(*) AS n FROM e GROUP BY 1, 2), g AS (SELECT * FROM "
    "(SELECT DISTINCT event_type FROM e) CROSS JOIN (SELECT DISTINCT dia FROM e)) "
    "SELECT g.event_type, g.dia, coalesce(n.n, 0) AS n FROM g LEFT JOIN n ON n.event_type IS NOT DISTINCT FROM g.event_type AND n.dia IS NOT DISTINCT FROM g.dia"
)
def q23_crosstab(spark, sf):
    """The cross-tab over all days present, a row for each cell, empty ones 0."""
    n = stage(table(spark, sf, "events").groupBy("event_type", F.date_format("ts", "yyyy-MM-dd").alias("dia")).agg(F.count(F.lit(1)).alias("n")), "cells")
    grid = n.select("event_type").distinct().crossJoin(n.select("dia").distinct())
    return grid.unionByName(n, allowMissingColumns=True).groupBy("event_type", "dia").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))


@query("SELECT d.doc_id, source, quality FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id ORDER BY quality DESC NULLS LAST, source, d.doc_id LIMIT 40")
def q24_top_k(spark, sf):
    d, q = table(spark, sf, "documents").select("doc_id", "source"), table(spark, sf, "labels").select("doc_id", "quality")
    return d.join(q, "doc_id", "left").orderBy(F.desc_nulls_last("quality"), "source", "doc_id").limit(40)


@query(
    f"WITH {_EXPORT} SELECT w.id, cnpj_formatado, nome, razao_social, uf, municipio, telefone_formatado, telefone_9_formatado, email, string_agg(DISTINCT v.vertical, ',' "
    "ORDER BY v.vertical) AS verticais "
    "FROM wide w JOIN verticais v ON v.id = w.id WHERE mei GROUP BY ALL"
)
def q25_sole_traders(spark, sf):
    r = R.relations(spark, sf)
    return reports.sole_traders(_wide(r, flagged=False), classify.verticals_of(_target(r), r["vertical_cnae"]))


@query("SELECT c_custkey, c_name, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS urgente FROM customer")
def q26_flag_by_membership(spark, sf):
    ids = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))
    return resolve.flag(table(spark, sf, "customer").select("c_custkey", "c_name"), ids, "c_custkey", "urgente")


# ---------------------------------------------------------------- shops of brand networks

_POSTS = {
    "fonte": "CASE s_suppkey % 4 WHEN 0 THEN 'norte' WHEN 1 THEN 'sul' WHEN 2 THEN 'leste' ELSE 'fechada' END", "coletado_em": "'2024-01-15'", "posto_id": "'p' || lpad(CAST(s_suppkey AS STRING), 6, '0')", "nome": "s_name",
    "uf_fonte": "CASE s_suppkey % 7 WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'BA' WHEN 3 THEN 'DF' WHEN 4 THEN '' WHEN 5 THEN 'SP' ELSE 'EX' END",
    "cidade_fonte": "CASE s_suppkey % 3 WHEN 0 THEN n_name WHEN 1 THEN '' ELSE 'Nenhuma' END",
    "bairro": "CASE s_suppkey % 2 WHEN 0 THEN 'CENTRO' ELSE 'Vila Dr. Sá' END",
    "endereco": "CASE s_suppkey % 5 WHEN 0 THEN 'RUA NATION_2, 45 - ' || n_name || ', ' || 'SP' WHEN 1 THEN 'AV. ' || n_name || ' 10 - NATION_1' WHEN 2 THEN 'Rua A, 1' WHEN 3 THEN n_name || ' - NATION_5' ELSE NULL END",
    "cep": "CASE s_suppkey % 3 WHEN 0 THEN '01310-100' WHEN 1 THEN '123' ELSE NULL END",
    "telefones": "CASE s_suppkey % 6 WHEN 0 THEN '1130000' || lpad(CAST(s_suppkey % 400 AS STRING), 3, '0') || '|11988887777' WHEN 1 THEN '99|2133445566|2133445566|11977776666|7130000001' WHEN 2 THEN '' WHEN 3 THEN NULL WHEN 4 THEN '7130000' || lpad(CAST(s_suppkey % 400 AS STRING), 3, '0') ELSE '1111111111|4133445566' END",
    "email": "CASE s_suppkey % 2 WHEN 0 THEN ' Loja@Som.com.br ' ELSE '' END", "site": "CASE s_suppkey % 3 WHEN 0 THEN 'https://loja.example' ELSE ' ' END",
    "contato": "''", "horario": "'8h'", "segmento": "CAST(NULL AS STRING)",
}
_MARCA = [("alfa", "Alfa", "norte"), ("beta", "beta", "norte"), ("gama", "Gama", "sul"), ("delta", "Delta", "leste")]
_POSTS_CTE = f"postos AS ({R._select(_POSTS, 'FROM supplier LEFT JOIN nation ON n_nationkey = s_nationkey')}), marca AS (SELECT * FROM {O.values(_MARCA, 'marca, marca_nome, fonte')})"
_ALVO_CTE = f"alvos AS (SELECT CASE n_nationkey % 5 WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'BA' WHEN 3 THEN 'DF' ELSE 'SP' END AS uf, {O.slug('n_name')} AS municipio_slug, n_name AS municipio, CAST(n_nationkey AS STRING) AS ibge FROM nation WHERE n_nationkey % 5 <> 3 OR n_name = 'NATION_3')"


def _posts(spark, sf) -> DataFrame:
    s = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("s_nationkey"), "left")
    return s.selectExpr(*[f"{e} AS {c}" for c, e in _POSTS.items()])


def _places(spark, sf) -> DataFrame:
    n = table(spark, sf, "nation").where("n_nationkey % 5 <> 3 OR n_name = 'NATION_3'")
    uf = F.expr("CASE n_nationkey % 5 WHEN 0 THEN 'SP' WHEN 1 THEN 'RJ' WHEN 2 THEN 'BA' WHEN 3 THEN 'DF' ELSE 'SP' END")
    return crosswalk.targets(n.select(uf.alias("uf"), T.slug("n_name").alias("municipio_slug"), F.col("n_name").alias("municipio"), F.col("n_nationkey").cast("string").alias("ibge")))


_PARTS = f"partes AS (SELECT posto_id, i, {O.e164('d[1:2]', 'd[3:]')} AS e FROM (SELECT posto_id, i, {O.digits('raw')} AS d FROM (SELECT posto_id, unnest(str_split(telefones, '|')) AS raw, generate_subscripts(str_split(telefones, '|'), 1) AS i FROM postos WHERE coalesce(telefones, '') <> '')) WHERE i <= 10)"
_FONES = (
    f"{_PARTS}, fones AS (SELECT posto_id, max(CASE WHEN pos = 1 THEN e END) AS telefone, max(CASE WHEN pos = 2 THEN e END) AS telefone_2 FROM (SELECT posto_id, e, "
    "row_number() OVER (PARTITION BY posto_id ORDER BY i, e) AS pos "
    "FROM (SELECT posto_id, e, min(i) AS i FROM partes WHERE e IS NOT NULL GROUP BY 1, 2)) WHERE pos <= 2 GROUP BY 1)"
)


@query(f"WITH {_POSTS_CTE}, {_FONES} SELECT * FROM fones")
def q27_first_two_phones(spark, sf):
    return resolve.phones_of_posts(_posts(spark, sf))


_FRAME = f"instr('-' || {O.slug('p.endereco')} || '-', '-' || m.municipio_slug || '-')"
_CITY = f"""direto AS (SELECT posto_id, municipio, municipio_slug, ibge, '{crosswalk.PUBLISHED}' AS municipio_origem FROM postos p JOIN alvos m ON m.uf = p.uf_fonte AND m.municipio_slug = {O.slug('p.cidade_fonte')} WHERE coalesce(cidade_fonte, '') <> ''),
achado AS (SELECT * FROM (SELECT posto_id, municipio, municipio_slug, ibge, '{crosswalk.IN_ADDRESS}' AS municipio_origem, row_number() OVER (PARTITION BY posto_id ORDER BY {_FRAME} DESC, length(m.municipio_slug) DESC, m.municipio_slug) AS pos
  FROM postos p JOIN alvos m ON m.uf = p.uf_fonte WHERE posto_id NOT IN (SELECT posto_id FROM direto) AND {_FRAME} > 0 AND (length(m.municipio_slug) >= 4 OR ends_with({O.slug('p.endereco')}, '-' || m.municipio_slug)
  OR ends_with({O.slug('p.endereco')}, '-' || m.municipio_slug || '-' || lower(p.uf_fonte)))) WHERE pos = 1),
cidade AS (SELECT * FROM direto UNION ALL SELECT posto_id, municipio, municipio_slug, ibge, municipio_origem FROM achado UNION ALL
  SELECT posto_id, municipio, municipio_slug, ibge, '{crosswalk.FEDERAL}' FROM postos p JOIN alvos m ON m.uf = 'DF' WHERE p.uf_fonte = 'DF' AND posto_id NOT IN (SELECT posto_id FROM direto) AND posto_id NOT IN (SELECT posto_id FROM achado))"""


@query(f"WITH {_POSTS_CTE}, {_ALVO_CTE}, {_CITY} SELECT * FROM cidade")
def q28_city_in_text(spark, sf):
    return crosswalk.city_of_posts(_posts(spark, sf), _places(spark, sf))


@query(f"WITH {_POSTS_CTE}, {_ALVO_CTE}, {_CITY} SELECT fonte, posto_id, nome, uf_fonte, cidade_fonte, endereco FROM postos WHERE posto_id NOT IN (SELECT posto_id FROM cidade)")
def q28b_posts_without_city(spark, sf):
    p = _posts(spark, sf)
    return crosswalk.posts_without_city(p, crosswalk.city_of_posts(p, _places(spark, sf)))


def _keys_sql(name: str, key: str) -> str:
    return f"(SELECT {key}, {O.phone_key('telefone')} AS chave FROM {name} WHERE telefone IS NOT NULL UNION SELECT {key}, {O.phone_key('telefone_2')} FROM {name} WHERE telefone_2 IS NOT NULL)"


_MATCH = (
    f"kp AS {_keys_sql('fones', 'posto_id')}, ke AS {_keys_sql('wide', 'id')}, casa AS (SELECT posto_id, min(r.id) AS id FROM kp JOIN ke r ON r.chave = kp.chave WHERE "
    "r.chave IN (SELECT chave FROM ke GROUP BY 1 HAVING count(DISTINCT id) = 1) "
    "GROUP BY 1 HAVING count(DISTINCT r.id) = 1)"
)


@query(f"WITH {_EXPORT}, {_POSTS_CTE}, {_FONES}, {_MATCH} SELECT * FROM casa")
def q29_unique_key_match(spark, sf):
    return resolve.company_of_posts(resolve.phones_of_posts(_posts(spark, sf)), _phones_of_target(spark, sf))


@query(
    "SELECT DISTINCT a.p_partkey FROM part a JOIN part b ON a.p_brand = b.p_brand AND a.p_type = b.p_type AND a.p_partkey <> b.p_partkey AND jaro_winkler_similarity(a.p_name, "
    "b.p_name) >= 0.9"
)
def q30_similar_in_block(spark, sf):
    return resolve.similar_in_block(table(spark, sf, "part"), ["p_brand", "p_type"], "p_partkey", "p_name")


def _posts_ready(spark, sf) -> DataFrame:
    p = _posts(spark, sf).withColumn("coletado_em", F.try_to_date("coletado_em"))
    phones = resolve.phones_of_posts(p)
    companies = resolve.company_of_posts(phones, _phones_of_target(spark, sf))
    return brands.publishable_posts(p, crosswalk.city_of_posts(p, _places(spark, sf)), phones, companies)


_READY = f"""{_EXPORT}, {_POSTS_CTE}, {_ALVO_CTE}, {_CITY}, {_FONES}, {_MATCH},
pronto AS (SELECT p.posto_id, p.fonte, CAST(p.coletado_em AS DATE) AS coletado_em, p.nome, p.uf_fonte AS uf, c.municipio, c.municipio_slug, c.ibge, c.municipio_origem, nullif(trim(concat_ws(' - ', {O.natural('p.endereco')}, {O.natural('p.bairro')})), '') AS endereco,
  {O.postal('p.cep')} AS cep, c.municipio || '-' || p.uf_fonte AS cidade_uf, telefone, {O.phone_type('telefone')} AS telefone_tipo, {O.shown('telefone')} AS telefone_formatado, {O.ninth('telefone')} AS telefone_9, {O.shown(O.ninth('telefone'))} AS telefone_9_formatado,
  telefone_2, {O.phone_type('telefone_2')} AS telefone_2_tipo, {O.shown('telefone_2')} AS telefone_2_formatado, {O.ninth('telefone_2')} AS telefone_2_9, {O.shown(O.ninth('telefone_2'))} AS telefone_2_9_formatado, nullif(lower(trim(p.email)), '') AS email,
  nullif(trim(p.site), '') AS site, nullif(trim(p.contato), '') AS contato, nullif(trim(p.horario), '') AS horario, nullif(trim(p.segmento), '') AS segmento, k.id AS cnpj, {O.cnpj('k.id')} AS cnpj_formatado
  FROM postos p LEFT JOIN cidade c ON c.posto_id = p.posto_id LEFT JOIN fones f ON f.posto_id = p.posto_id LEFT JOIN casa k ON k.posto_id = p.posto_id WHERE p.uf_fonte <> ''),
publicacao_marca AS (SELECT ma.marca, ma.marca_nome, p.* FROM pronto p JOIN marca ma ON ma.fonte = p.fonte)"""


def _brand_rows(spark, sf) -> DataFrame:
    return brands.brand_posts(_posts_ready(spark, sf), _rows(spark, _MARCA, "marca string, marca_nome string, fonte string"))


@query(f"WITH {_READY} SELECT * FROM publicacao_marca")
def q47_brand_posts(spark, sf):
    return _brand_rows(spark, sf)


@query(f"WITH {_READY} SELECT marca, uf, count(*) AS total, count(DISTINCT municipio_slug) AS cidades FROM publicacao_marca GROUP BY 1, 2")
def q48_brands_by_state(spark, sf):
    return brands.by_state(_brand_rows(spark, sf))


@query(
    f"WITH {_READY} SELECT fonte, count(*) AS oficinas, count(municipio_slug) AS com_municipio, count(*) FILTER (WHERE municipio_origem = '{crosswalk.IN_ADDRESS}') AS "
    "municipio_pelo_endereco, count(telefone) AS com_telefone, count(email) AS com_email, count(cnpj) AS casadas_com_cnpj, count(DISTINCT uf) AS estados, count(DISTINCT uf || "
    "'/' || coalesce(municipio_slug, '?')) AS cidades FROM pronto GROUP BY 1"
)
def q49_brand_coverage(spark, sf):
    return brands.coverage(_posts_ready(spark, sf))


_BCITY = "bc AS (SELECT marca, uf, municipio, municipio_slug, ibge, count(*) AS total FROM publicacao_marca WHERE municipio_slug IS NOT NULL GROUP BY ALL)"


@query(
    f"WITH {_READY}, {_BCITY} SELECT a.marca, a.uf, a.municipio_slug, b.marca AS vizinha, b.total FROM bc a JOIN bc b ON a.uf = b.uf AND a.municipio_slug = b.municipio_slug "
    "AND a.marca <> b.marca"
)
def q43_neighbours(spark, sf):
    return brands.neighbours(brands.by_city(_brand_rows(spark, sf))).select("marca", "uf", "municipio_slug", "vizinha", "total")


@query(f"WITH {_READY} SELECT a.marca, b.marca AS irma FROM marca a JOIN marca b ON a.fonte = b.fonte AND a.marca <> b.marca WHERE a.fonte IN (SELECT fonte FROM pronto)")
def q43b_siblings(spark, sf):
    return brands.siblings(_rows(spark, _MARCA, "marca string, marca_nome string, fonte string"), _posts_ready(spark, sf))


@query(
    f"WITH {_READY}, t AS (SELECT marca, marca_nome, fonte, count(*) AS total, max(coletado_em) AS coletado_em FROM publicacao_marca GROUP BY 1, 2, 3) SELECT * FROM t "
    "QUALIFY row_number() OVER (PARTITION BY fonte ORDER BY total DESC, lower(marca_nome), marca) = 1"
)
def q43c_one_per_source(spark, sf):
    return brands.one_per_source(brands.ranked(_brand_rows(spark, sf)))


@query(f"WITH {_READY}, {_BCITY} SELECT uf, municipio_slug, string_agg(marca || ':' || total, ',' ORDER BY marca) AS marcas FROM bc GROUP BY 1, 2")
def q43d_brands_by_city(spark, sf):
    b = brands.brands_by_city(brands.by_city(_brand_rows(spark, sf)))
    return b.select("uf", "municipio_slug", F.array_join(F.transform("marcas", lambda m: F.concat_ws(":", m["marca"], m["total"].cast("string"))), ",").alias("marcas"))


@query(
    f"WITH {R.CTE}, {_COUNTS} SELECT v.vertical, v.cnae, c.descricao, n_principal, n_secundario, n_principal + n_secundario AS n_total_ocorrencias FROM vertical_cnae v JOIN "
    "cnaes c ON c.codigo = v.cnae LEFT JOIN contagem k ON k.codigo = v.cnae"
)
def q50_code_report(spark, sf):
    r = R.relations(spark, sf)
    return reports.code_report(r["vertical_cnae"], r["cnaes"], classify.code_counts(r["estabelecimentos"], r["cnaes"]))


@query(f"WITH {_EXPORT} SELECT vertical, uf, count(*) AS total FROM exportacao GROUP BY 1, 2")
def q51_by_state(spark, sf):
    return reports.by_state(_export(spark, sf, flagged=False))


@query(f"WITH {_EXPORT} SELECT vertical, count(*) AS total FROM exportacao WHERE uf = 'EX' GROUP BY 1")
def q52_abroad(spark, sf):
    return reports.abroad(_export(spark, sf, flagged=False))


# ---------------------------------------------------------------- text, HTML, JSON

_TAGS = r"regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>', ' ', 'g'), '(?is)<style.*?</style>', ' ', 'g'), '(?i)<br\s*/?>|</p>|</div>|</li>|</h\d>', chr(10), 'g'), '(?s)<[^>]+>', ' ', 'g')"
_DECODED = _TAGS  # the references that the pages hold; HTML lets these names go without their semicolon
for _name, _char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("nbsp", " "), ("amp", "&")):
    _DECODED = f"regexp_replace({_DECODED}, '&{_name};?', '{_char}', 'g')"
_LINES = f"list_transform(str_split({_DECODED}, chr(10)), lambda x: regexp_replace(regexp_replace(x, '[ \\t]+', ' ', 'g'), '^\\s+|\\s+$', '', 'g'))"


@query(f"SELECT page_id, array_to_string({_LINES}, chr(10)) AS texto, len(list_filter({_LINES}, lambda x: x <> '')) AS linhas FROM pages")
def q31_html_to_text(spark, sf):
    p = table(spark, sf, "pages").select("page_id", X.texto_de("html").alias("texto"))
    return p.select("page_id", "texto", F.size(F.filter(F.split("texto", "\n"), lambda x: x != "")).cast("long").alias("linhas"))


_FOUND = "list_filter(list_transform(regexp_extract_all(text, '\\(?\\d{2}\\)?[\\s.-]?9?\\d{4}[\\s.-]?\\d{4}'), lambda x: regexp_replace(x, '[^0-9]', '', 'g')), lambda x: length(x) IN (10, 11))"


@query(f"SELECT doc_id, coalesce(array_to_string(list_filter({_FOUND}, lambda x, i: list_position({_FOUND}, x) = i), '|'), '') AS telefones FROM documents")
def q32_phones_in_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.telefones("text").alias("telefones"))


@query(
    "SELECT page_id, b, trim(regexp_replace(replace(x, '</p>', ''), '<[^>]+>', ' ', 'g')) AS bloco FROM (SELECT page_id, unnest(str_split(html, '<p>')[2:]) AS x, "
    "generate_subscripts(str_split(html, '<p>')[2:], 1) AS b FROM pages)"
)
def q33_block_split(spark, sf):
    blocks = table(spark, sf, "pages").select("page_id", F.posexplode(F.slice(F.split("html", "(?=<p>)"), 2, 2**30)).alias("i", "x"))
    clean = F.trim(F.regexp_replace(F.replace(F.substring("x", 4, 2**31 - 1), F.lit("</p>"), F.lit("")), "<[^>]+>", " "))
    return blocks.select("page_id", (F.col("i") + 1).cast("long").alias("b"), clean.alias("bloco"))


@query("SELECT event_id, CAST(regexp_extract(props, '\"k\": ?([0-9]+)', 1) AS BIGINT) AS k, regexp_matches(props, '^\\{') AS objeto FROM events")
def q34_json_fields(spark, sf):
    e = table(spark, sf, "events")
    return e.select("event_id", F.from_json("props", "k long")["k"].alias("k"), F.col("props").rlike(r"^\{").alias("objeto"))


@query(f"SELECT c_custkey, 'x-' || sha256({O.plain('c_name')} || '|' || {O.plain('c_mktsegment')} || '|' || {O.plain('NULL')})[1:10] AS posto_id FROM customer")
def q35_stable_id(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", X.identificar(F.lit("x"), "c_name", "c_mktsegment", F.lit(None).cast("string")).alias("posto_id"))


_STATES = [(1, "São Paulo", "RUA A - NATAL - RN", "(47) 3435-0000"), (2, "", "RUA A - NATAL, RN", "(47) 3435-0000"), (3, "", "RUA A", "(47) 3435-0000"), (4, None, None, None), (5, "Nárnia", "x", "11987650000")]


@query(
    f"SELECT k, coalesce(nullif({O.state('nome')}, ''), nullif({O.state('''regexp_extract(trim(coalesce(fim, '')), '[,\\-–]\\s*([A-Za-z]{2})\\s*\\.?\\s*$', 1)''')}, ''), "
    f"{O.state_of_ddd('''regexp_replace(coalesce(fone, ''), '[^0-9]', '', 'g')[1:2]''')}, '') AS uf "
    f"FROM (SELECT * FROM {O.values(_STATES, 'k, nome, fim, fone')} UNION ALL SELECT 100 + c_custkey, '', 'RUA ' || c_name, '(' || lpad(CAST(c_custkey % 100 AS STRING), 2, "
    "'0') || ') 3435-0000' FROM customer)"
)
def q36_state_fallback(spark, sf):
    made = table(spark, sf, "customer").selectExpr("100 + c_custkey as k", "'' as nome", "'RUA ' || c_name as fim", "'(' || lpad(cast(c_custkey % 100 as string), 2, '0') || ') 3435-0000' as fone")
    s = _rows(spark, _STATES, "k long, nome string, fim string, fone string").unionByName(made)
    return s.select("k", A.uf_resolvida(A.uf_de("nome"), "fim", "fone").alias("uf"))


_HOST = "regexp_extract(url, 'https?://([^/]+)', 1)"


@query(
    f"SELECT page_id, {_HOST} AS host, CAST(floor((row_number() OVER (PARTITION BY {_HOST} ORDER BY url, page_id) - 1) / 10) + 1 AS BIGINT) AS page, CAST(ceil(count(*) "
    f"OVER (PARTITION BY {_HOST}) / 10) AS BIGINT) AS pages FROM pages"
)
def q37_paging(spark, sf):
    from ..operators import sinks

    p = table(spark, sf, "pages").select("page_id", "url", F.regexp_extract("url", "https?://([^/]+)", 1).alias("host"))
    return sinks.numbered(p, ["host"], [F.col("url"), F.col("page_id")], 10).select("page_id", "host", "page", "pages")


@query(
    "WITH c AS (SELECT n_name, c_name, c_custkey, row_number() OVER (PARTITION BY n_name ORDER BY c_name, c_custkey) AS i, count(*) OVER (PARTITION BY n_name) AS n FROM customer JOIN nation ON n_nationkey = c_nationkey) "
    "SELECT n_name, CAST(floor((i - 1) / 100) + 1 AS BIGINT) AS pagina, any_value(n) AS n, string_agg(c_name, '; ' ORDER BY i) AS clientes FROM c GROUP BY 1, 2"
)
def q38_nested_lists(spark, sf):
    """Lists by nation, at most 100 names a row: pages are numbered before anything is nested."""
    from ..operators import sinks

    rows = table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")).select("n_name", "c_name", "c_custkey")
    paged = sinks.numbered(rows, ["n_name"], [F.col("c_name"), F.col("c_custkey")], 100, "pagina")
    listed = F.array_sort(F.collect_list(F.struct("c_name", "c_custkey")))
    pages = paged.groupBy("n_name", "pagina").agg(F.array_join(F.transform(listed, lambda x: x["c_name"]), "; ").alias("clientes"))
    n = rows.groupBy("n_name").agg(F.count(F.lit(1)).alias("n"))
    return pages.join(n, "n_name").select("n_name", "pagina", "n", "clientes")


@query("SELECT c AS caractere, count(*) AS n, count(DISTINCT doc_id) AS documentos FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^\\x00-\\x7F]')) AS c FROM documents) GROUP BY 1")
def q39_character_audit(spark, sf):
    c = table(spark, sf, "documents").select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(r"[^\x00-\x7F]"), F.lit(0))).alias("caractere"))
    return c.groupBy("caractere").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("documentos"))


@query(
    "SELECT doc_id, source AS fonte, lang FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE doc_id % 3 = 0 AND source < 'src15') UNION ALL SELECT doc_id, "
    "source, upper(lang) FROM documents WHERE doc_id % 3 = 0 AND source < 'src15'"
)
def q40_refresh_by_source(spark, sf):
    old = table(spark, sf, "documents").select("doc_id", F.col("source").alias("fonte"), "lang")
    new = old.where((F.col("doc_id") % 3 == 0) & (F.col("fonte") < "src15")).withColumn("lang", F.upper("lang"))
    return resolve.refresh(old, new)


@query(
    "SELECT 'rows' AS stage, count(*) AS n FROM orders UNION ALL SELECT 'fechados', count(*) FILTER (WHERE o_orderstatus = 'F') FROM orders UNION ALL SELECT 'caros', "
    "count(*) FILTER (WHERE o_totalprice > 100000) FROM orders"
)
def q41_count_trail(spark, sf):
    return reports.count_trail(table(spark, sf, "orders"), fechados=F.col("o_orderstatus") == "F", caros=F.col("o_totalprice") > 100000)


@query("SELECT CAST(n_nationkey AS STRING) AS codigo, CASE WHEN n_nationkey % 5 = 0 THEN NULL ELSE n_name || ';\"x\"' END AS descricao FROM nation")
def q42_csv_round_trip(spark, sf):
    """Quotes, separators and empty fields survive a file; an empty quoted field reads as null."""
    rows = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("codigo"), F.when(F.col("n_nationkey") % 5 == 0, "").otherwise(F.concat("n_name", F.lit(';"x"'))).alias("descricao"))
    path = new_path(spark, "csv")
    rows.write.options(sep=";", quote='"', escape='"', header=False, quoteAll=True).csv(path)
    return src.read_delimited(spark, path, src.CODIGO)


@query(
    "SELECT o_orderkey, replace(format('{:,}', o_orderkey * 1000), ',', '.') AS numero, strftime(o_orderdate, '%d/%m/%Y') AS data, replace(replace(replace(o_orderpriority "
    "|| ' <b> & \"x\"', '&', '&amp;'), '<', '&lt;'), '\"', '&quot;') AS seguro, "
    "CASE WHEN o_orderkey % 7 = 1 THEN 'loja' ELSE 'lojas' END AS plural_, array_to_string(list_sort(list_distinct(list_concat([1, 40], range(greatest(1, o_orderkey % 40 "
    "- 1), least(40, o_orderkey % 40 + 3) + 1)))), ',') AS janela FROM orders"
)
def q44_presentation(spark, sf):
    """Every order, the first and the last pages of the link window included."""
    return _presented(table(spark, sf, "orders"))


def _presented(o: DataFrame) -> DataFrame:
    from ..operators import sinks

    safe = F.replace(sinks.escape_html(F.concat("o_orderpriority", F.lit(' <b> & "x"'))), F.lit("&gt;"), F.lit(">"))
    links = F.array_join(F.transform(sinks.page_window(F.col("o_orderkey") % 40 + 1, F.lit(40).cast("long")), lambda x: x.cast("string")), ",")
    return o.select("o_orderkey", sinks.numero(F.col("o_orderkey") * 1000).alias("numero"), sinks.data_br(F.col("o_orderdate")).alias("data"), safe.alias("seguro"), sinks.plural(F.col("o_orderkey") % 7, "loja", "lojas").alias("plural_"), links.alias("janela"))


# ---------------------------------------------------------------- extractors, parsers, checks over data with known answers

#: A fragment per supplier, put together from parts that the SQL knows beforehand.
_FRAGMENT = {
    "phone": "'(11) 3' || lpad(CAST(s_suppkey % 1000 AS STRING), 3, '0') || '-' || lpad(CAST(s_suppkey * 7 % 10000 AS STRING), 4, '0')",
    "postal": "'01310-' || lpad(CAST(s_suppkey % 1000 AS STRING), 3, '0')",
    "street": "'Rua ' || CAST(s_suppkey AS STRING) || ', 5'",
    "mail": "CASE s_suppkey % 3 WHEN 0 THEN '<a href=\"mailto:Loja' || CAST(s_suppkey AS STRING) || '@Som.com.br\">m</a>' WHEN 1 THEN '<i data-cfemail=\"2041426058490e494f\">x</i>' ELSE '<p>escreva a c.d@e' || CAST(s_suppkey AS STRING) || '.com.</p>' END",
    "link": "CASE s_suppkey % 2 WHEN 0 THEN '<a href=\"https://www.facebook.com/x\">f</a><a href=\"https://loja' || CAST(s_suppkey AS STRING) || '.example/p\">s</a>' ELSE '<b>visite www.som' || CAST(s_suppkey AS STRING) || '.com.br</b>' END",
}


@query(
    f"WITH f AS (SELECT s_suppkey, {_FRAGMENT['phone']} AS phone, {_FRAGMENT['postal']} AS postal, {_FRAGMENT['street']} AS street FROM supplier) "
    "SELECT s_suppkey, CASE s_suppkey % 3 WHEN 0 THEN 'loja' || CAST(s_suppkey AS STRING) || '@som.com.br' WHEN 1 THEN 'ab@xi.io' ELSE 'c.d@e' || CAST(s_suppkey AS "
    "STRING) || '.com' END AS email, "
    "postal AS cep, replace(replace(replace(replace(phone, '(', ''), ') ', ''), '-', ''), ' ', '') AS telefones, street AS endereco, "
    "CASE s_suppkey % 2 WHEN 0 THEN 'https://loja' || CAST(s_suppkey AS STRING) || '.example/p' ELSE 'https://www.som' || CAST(s_suppkey AS STRING) || '.com.br' END AS site FROM f"
)
def q53_extractors(spark, sf):
    """Mail, postal code, phones, address and site of fragments whose parts are known."""
    f = table(spark, sf, "supplier").selectExpr("s_suppkey", *[f"{e} AS {c}" for c, e in _FRAGMENT.items()])
    line = F.concat("street", F.lit(" "), "phone", F.lit(" - CEP: "), "postal")
    page = F.concat(F.lit("<div>"), "mail", F.lit("<br>"), line, F.lit("</div>"), "link")
    f = f.select("s_suppkey", line.alias("line"), page.alias("page"))
    return f.select(
        "s_suppkey", X.emails("page").alias("email"), X.cep(X.texto_de("page")).alias("cep"), X.telefones(X.texto_de("page")).alias("telefones"),
        X.limpar_endereco("line").alias("endereco"), X.site("page").alias("site"),
    )


#: A document per supplier in the form of one of the seven sources, put together from parts that the SQL knows; every 50th is broken.
_SHOP = {
    "nome": "'Loja ' || CAST(s_suppkey AS STRING)",
    "rua": "'Rua ' || CAST(s_suppkey AS STRING) || ', ' || CAST(s_suppkey % 90 AS STRING)",
    "cep": "'13' || lpad(CAST(s_suppkey % 1000 AS STRING), 3, '0') || '-' || lpad(CAST(s_suppkey * 3 % 1000 AS STRING), 3, '0')",
    "a": "'3' || lpad(CAST(s_suppkey % 1000 AS STRING), 3, '0')",
    "b": "lpad(CAST(s_suppkey * 7 % 10000 AS STRING), 4, '0')",
    "mail": "'loja' || CAST(s_suppkey AS STRING) || '@som.com.br'",
}
_SOURCES = ("roland", "yamaha", "casio", "tectronica", "proshows", "tagima", "sonotec")
#: Of each source: hint, document (parts in braces), and the state, city, address, postal code, area code, mail and district to be found.
_SHOP_FORMS = {
    "roland": (
        "São Paulo", "<p>x</p><span style='font-weight: bold'>Campinas</span><h5>{nome} &amp; Som&hellip;</h5>{rua}<br>CEP: {cep}<br>Tel: (19) {a}-{b}<br>{mail}<h5></h5>",
        ("SP", "Campinas", "{rua}", "{cep}", "19", "{mail}", ""), "{nome} & Som…",
    ),
    "yamaha": (
        "", '[{"name": " {nome}  & Som ", "address": "{rua} - NATAL, RN {cep}", "telephoneNumber": "(84) {a}-{b}", "emailAddress": "{mail}", "contractCode": ["PI", "ZZ"]}, {"name": ""}]',
        ("RN", "", "{rua} - NATAL, RN", "{cep}", "84", "{mail}", ""), "{nome} & Som",
    ),
    "casio": (
        "", '{"data": [{"store_name": "{nome}", "address": "{rua}<br>Centro", "search1": "SP", "search2": " Campinas ", "tel": "(19) {a}-{b}", "opening_hours": "8h  as 18h"}]}',
        ("SP", "Campinas", "{rua} Centro", "", "19", "", ""), "{nome}",
    ),
    "tectronica": (
        "", '<div class="x unidade" data-estado="RJ" data-cidade="Niter&oacute;i"><p class="sub-title b">{nome}</p><p><b>Endereço:</b> {rua}</p><p><b>CEP:</b> {cep}</p>'
        '<p><b>Telefone:</b> (21) {a}-{b}</p><p><b>E-mail:</b> <a href="mailto:{mail}">x</a></p></div>',
        ("RJ", "Niterói", "{rua}", "{cep}", "21", "{mail}", ""), "{nome}",
    ),
    "proshows": (
        "BA", '[{"assistance": "{nome}", "zip": "{cep}", "address": "{rua}", "city": " Salvador", "neighborhood": "Barra ", "telephone": "71 {a} {b}", "email": "{mail}"}]',
        ("BA", "Salvador", "{rua}", "{cep}", "71", "{mail}", "Barra"), "{nome}",
    ),
    "tagima": (
        "PE", 'Lista de Assistências<div class="col-span-12 lg:col-span-4"><h5>{nome}</h5><p class="mb-1">Endereço: {rua}, Bairro: Centro</p><p class="mb-1">Recife / PE</p>'
        '<p class="mb-1">CEP: {cep}</p><p class="mb-1">Telefone: (81) {a}-{b}</p><p class="mb-1">Contato: Ana</p></div><a href="https://rodape.example">x</a>',
        ("PE", "Recife", "{rua}", "{cep}", "81", "", "Centro"), "{nome}",
    ),
    "sonotec": (
        "", '<div class="selects CE"><div class="item"><h5>Fortaleza</h5><div class="infos"><span>{nome}</span><br>{rua}<br>(85) {a}-{b} / <br>{mail}</div></div></div>'
        '<div class="selects XX"><div class="item"><h5>n</h5><span>n</span></div></div>',
        ("CE", "Fortaleza", "{rua}", "", "85", "{mail}", ""), "{nome}",
    ),
}


def _filled(form: str) -> str:
    """An SQL expression of a text with parts in braces."""
    text = "'" + form.replace("'", "''") + "'"
    for part in _SHOP:
        text = text.replace("{" + part + "}", f"' || {part} || '")
    return text


def _by_source(of) -> str:
    return "CASE fonte " + " ".join(f"WHEN '{f}' THEN {of(f)}" for f in _SOURCES) + " END"


_SHOP_PARTS = "SELECT s_suppkey, CASE s_suppkey % 7 " + " ".join(f"WHEN {i} THEN '{f}'" for i, f in enumerate(_SOURCES)) + " END AS fonte, " + ", ".join(f"{e} AS {c}" for c, e in _SHOP.items())
_SHOP_FOUND = [
    (name, _by_source(lambda f, i=i: _filled(_SHOP_FORMS[f][2][i]))) for i, name in enumerate(("uf_fonte", "cidade_fonte", "endereco", "cep", None, "email", "bairro")) if name
]


def _shop_documents(spark, sf) -> DataFrame:
    """The documents of ``_SHOP_FORMS`` over all suppliers; a broken one lacks what its source needs."""
    parts = spark.sql(f"{_SHOP_PARTS} FROM {{supplier}}", supplier=table(spark, sf, "supplier"))
    text = f"CASE WHEN s_suppkey % 50 = 0 THEN CASE s_suppkey % 3 WHEN 0 THEN '<p>moved</p>' WHEN 1 THEN '' ELSE '[{{\"name\": ' END ELSE {_by_source(lambda f: _filled(_SHOP_FORMS[f][1]))} END"
    hint = _by_source(lambda f: _filled(_SHOP_FORMS[f][0]))
    return parts.selectExpr("fonte", "CAST(s_suppkey AS STRING) AS document", f"{hint} AS hint", f"{text} AS text")


@query(
    f"WITH f AS ({_SHOP_PARTS} FROM supplier) SELECT fonte, {_by_source(lambda f: _filled(_SHOP_FORMS[f][3]))} AS nome, {', '.join(f'{e} AS {c}' for c, e in _SHOP_FOUND)}, "
    f"{_by_source(lambda f: _filled(_SHOP_FORMS[f][2][4]))} || a || b AS telefones FROM f WHERE s_suppkey % 50 <> 0"
)
def q54_shop_parsers(spark, sf):
    """The seven sources' parsers over a document per supplier; broken documents cost themselves only."""
    found = shops.collect(spark, _shop_documents(spark, sf), "2026-01-02").shops
    return found.select("fonte", "nome", "uf_fonte", "cidade_fonte", "endereco", "cep", "email", "bairro", "telefones")


@query(
    f"WITH f AS ({_SHOP_PARTS} FROM supplier WHERE s_suppkey % 50 = 0) SELECT fonte, CAST(s_suppkey AS STRING) AS document, CASE WHEN s_suppkey % 3 = 1 THEN 'no text' "
    "WHEN fonte IN ('yamaha', 'casio', 'proshows') THEN 'not the JSON that was expected' ELSE 'no record on the page' END AS reason FROM f"
)
def q61_quarantine(spark, sf):
    """Documents that could not be read, with the reason, from the same pass as q54's shops."""
    return shops.collect(spark, _shop_documents(spark, sf), "2026-01-02").quarantine


_TWICE = "duas AS (SELECT * FROM postos UNION ALL SELECT * REPLACE (upper(nome) AS nome, 'X' AS bairro) FROM postos)"


@query(
    f"WITH {_POSTS_CTE}, {_TWICE} SELECT {', '.join(src.POSTO)} FROM duas QUALIFY row_number() OVER (PARTITION BY fonte, posto_id ORDER BY "
    f"{', '.join(c + ' NULLS LAST' for c in src.POSTO)}) = 1"
)
def q55_stable_posts(spark, sf):
    """Shops once each, the first of its versions, in a stable order."""
    p = _posts(spark, sf).select(*src.POSTO)
    return resolve.stable_posts(p.unionByName(p.withColumn("nome", F.upper("nome")).withColumn("bairro", F.lit("X"))))


@query(
    "SELECT * FROM (SELECT o_orderstatus, o_orderpriority, n, round(100.0 * CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY o_orderstatus), 1) AS pct FROM (SELECT "
    "o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY 1, 2)) "
    "WHERE pct >= 20 AND regexp_matches(o_orderpriority, '^[1-4]')"
)
def q56_dominant_labels(spark, sf):
    n = table(spark, sf, "orders").groupBy("o_orderstatus", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return reports.dominant(n, "o_orderstatus", "n", "o_orderpriority", "^[1-4]", 20.0)


@query(
    "SELECT c_custkey, nome FROM (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name || ' ' || lpad(CAST(c_custkey AS STRING), 11, '0') WHEN c_custkey % 3 = 1 THEN "
    "c_name || ' ' || lpad(CAST(c_custkey AS STRING), 10, '0') ELSE c_name END AS nome FROM customer) "
    "WHERE regexp_matches(nome, '[0-9]{11}$')"
)
def q57_personal_numbers(spark, sf):
    nome = "CASE WHEN c_custkey % 3 = 0 THEN c_name || ' ' || lpad(CAST(c_custkey AS STRING), 11, '0') WHEN c_custkey % 3 = 1 THEN c_name || ' ' || lpad(CAST(c_custkey AS STRING), 10, '0') ELSE c_name END"
    return reports.leaks(table(spark, sf, "customer").selectExpr("c_custkey", f"{nome} AS nome"), "nome")


@query(
    f"WITH {_POSTS_CTE} SELECT fonte, TRY_CAST(coletado_em AS DATE) AS coletado_em, posto_id, nullif(nome, '') AS nome, nullif(endereco, '') AS endereco FROM postos WHERE "
    "fonte IN (SELECT fonte FROM marca)"
)
def q58_posts_round_trip(spark, sf):
    """The collector's CSV, written and read again: sources with a brand only, dates that are none are null."""
    path = new_path(spark, "postos")
    _posts(spark, sf).select(*src.POSTO).write.options(header=True, quote='"', escape='"').csv(path)
    rows = src.read_posts(spark, path, _rows(spark, _MARCA, "marca string, marca_nome string, fonte string"))
    return rows.select("fonte", "coletado_em", "posto_id", T.blank_to_null(F.col("nome")).alias("nome"), T.blank_to_null(F.col("endereco")).alias("endereco"))


@query(
    f"WITH l AS (SELECT vertical, uf, municipio, municipio_slug, count(*) AS total, count(*) FILTER (WHERE origem_cnae = 'principal') AS principais FROM (WITH {_EXPORT} "
    "SELECT * FROM exportacao) "
    "WHERE uf <> 'EX' AND municipio_slug IS NOT NULL GROUP BY ALL), "
    f"m AS (SELECT 'assistencia-tecnica' AS vertical, uf, municipio_slug, string_agg(marca || ':' || total, ',' ORDER BY marca) AS marcas FROM (WITH {_READY}, {_BCITY} "
    "SELECT * FROM bc) GROUP BY ALL), "
    "p AS (SELECT *, CAST(ceil(total / 100) AS BIGINT) AS paginas, unnest(range(1, CAST(ceil(total / 100) AS BIGINT) + 1)) AS pagina FROM l) "
    "SELECT vertical, uf, municipio, municipio_slug, total, principais, paginas, pagina, coalesce(marcas, '') AS marcas, least(100, total - 100 * (pagina - 1)) AS na_pagina, "
    "'/' || vertical || '/' || lower(uf) || '/' || municipio_slug || '/' || CASE WHEN pagina > 1 THEN CAST(pagina AS STRING) || '/' ELSE '' END AS caminho FROM p LEFT "
    "JOIN m USING (vertical, uf, municipio_slug)"
)
def q59_city_pages(spark, sf):
    """Pages of every city of every vertical; only one vertical shows brands."""
    from ..operators import sinks

    rows = _export(spark, sf, flagged=False).where("uf <> 'EX' and municipio_slug is not null")
    pages = sinks.city_pages(rows, brands.brands_by_city(brands.by_city(_brand_rows(spark, sf))), "assistencia-tecnica")
    shown = F.array_join(F.transform("marcas", lambda m: F.concat_ws(":", m["marca"], m["total"].cast("string"))), ",")
    return pages.withColumn("marcas", shown)


@query(
    "WITH c AS (SELECT '/pedido/' || CAST(l_orderkey AS STRING) || '/' || CAST(l_linenumber AS STRING) || '/' AS caminho FROM lineitem) "
    "SELECT caminho, CAST(floor((row_number() OVER (ORDER BY caminho) - 1) / 45000) + 1 AS BIGINT) AS arquivo, CAST(ceil(count(*) OVER () / 45000) AS BIGINT) AS arquivos, "
    "'<url><loc>https://exemplo.test' || caminho || '</loc><lastmod>2026-08-01</lastmod><changefreq>monthly</changefreq></url>' AS entrada FROM c"
)
def q60_sitemap(spark, sf):
    """A page for every order line, in sitemap files of 45,000."""
    from ..operators import sinks

    lines = table(spark, sf, "lineitem").selectExpr("'/pedido/' || cast(l_orderkey as string) || '/' || cast(l_linenumber as string) || '/' AS caminho")
    return sinks.sitemap(lines, "https://exemplo.test", "2026-08-01")
