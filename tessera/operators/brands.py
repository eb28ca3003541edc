"""Brand networks: publishable shops, brand x shop and its rollups, neighbours and rankings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import address as A
from ..functions import text as T
from ..functions.phones import with_phone_columns
from .crosswalk import IN_ADDRESS
from .reports import top_per_group
from .sinks import PAGE, breadcrumbs, escape_html, json_ld, numbered, numero, page_window, plural


def publishable_posts(posts: DataFrame, cities: DataFrame, phones: DataFrame, companies: DataFrame) -> DataFrame:
    """One row per shop with a state, enriched by its city, phones and company (each at most one)."""
    trimmed = lambda c: T.blank_to_null(F.trim(c)).alias(c)
    p = posts.where("uf_fonte is not null and uf_fonte <> ''")
    rows = p.join(cities, "posto_id", "left").join(phones, "posto_id", "left").join(companies.withColumnRenamed("id", "cnpj"), "posto_id", "left")
    rows = rows.select("*", T.caso_natural("endereco").alias("__rua"), T.caso_natural("bairro").alias("__bairro"))
    made = rows.select(
        "posto_id", "fonte", "coletado_em", "nome", F.col("uf_fonte").alias("uf"), "municipio", "municipio_slug", "ibge", "municipio_origem",
        T.blank_to_null(F.trim(F.concat_ws(" - ", "__rua", "__bairro"))).alias("endereco"), A.cep_formatado("cep").alias("cep"), F.concat("municipio", F.lit("-"), "uf_fonte").alias("cidade_uf"),
        "telefone", "telefone_2", T.blank_to_null(F.lower(F.trim("email"))).alias("email"), *[trimmed(c) for c in ("site", "contato", "horario", "segmento")], "cnpj", T.cnpj_formatado(F.col("cnpj")).alias("cnpj_formatado"),
    )
    return with_phone_columns(made, "telefone", "telefone_2")


def brand_posts(posts: DataFrame, marca: DataFrame) -> DataFrame:
    return marca.join(posts, "fonte")


def by_state(rows: DataFrame) -> DataFrame:
    return rows.groupBy("marca", "uf").agg(F.count(F.lit(1)).alias("total"), F.count_distinct("municipio_slug").alias("cidades"))


def by_city(rows: DataFrame) -> DataFrame:
    return rows.where("municipio_slug is not null").groupBy("marca", "uf", "municipio", "municipio_slug", "ibge").agg(F.count(F.lit(1)).alias("total"))


def top_cities(cities: DataFrame, n: int = 24) -> DataFrame:
    """The ``n`` cities of each brand with most shops; of equal ones by state, then slug."""
    return top_per_group(cities, ["marca"], [F.desc("total"), F.asc_nulls_last("uf"), F.asc("municipio_slug"), F.asc_nulls_last("municipio"), F.asc_nulls_last("ibge")], n)


def coverage(posts: DataFrame) -> DataFrame:
    return posts.groupBy("fonte").agg(
        F.count(F.lit(1)).alias("oficinas"), F.count("municipio_slug").alias("com_municipio"), F.count_if(F.col("municipio_origem") == IN_ADDRESS).alias("municipio_pelo_endereco"),
        F.count("telefone").alias("com_telefone"), F.count("email").alias("com_email"), F.count("cnpj").alias("casadas_com_cnpj"), F.count_distinct("uf").alias("estados"),
        F.count_distinct(F.concat("uf", F.lit("/"), F.coalesce("municipio_slug", F.lit("?")))).alias("cidades"),
    )


def siblings(marca: DataFrame, posts: DataFrame) -> DataFrame:
    """marca, irma: other brands of the same source that has shops."""
    live = marca.join(posts.select("fonte").distinct(), "fonte", "left_semi")
    other = live.select("fonte", F.col("marca").alias("irma"))
    return live.join(other, "fonte").where("marca <> irma").select("marca", "irma")


def neighbours(cities: DataFrame) -> DataFrame:
    """marca, uf, municipio_slug, vizinha, total: other brands in the same city."""
    other = cities.select("uf", "municipio_slug", F.col("marca").alias("vizinha"), "total")
    return cities.select("marca", "uf", "municipio_slug").join(other, ["uf", "municipio_slug"]).where("marca <> vizinha")


def ranked(rows: DataFrame) -> DataFrame:
    """Brands by falling number of shops, then name."""
    per = rows.groupBy("marca", "marca_nome", "fonte").agg(F.count(F.lit(1)).alias("total"), F.max("coletado_em").alias("coletado_em"))
    return per.orderBy(F.desc("total"), F.lower("marca_nome"), "marca")


def of_source(marca: DataFrame, fonte: str) -> DataFrame:
    """Brands of a source in alphabetical order, whatever their case; equal names by their code."""
    return marca.where(F.col("fonte") == fonte).orderBy(F.lower("marca_nome"), "marca")


def representative(rows: DataFrame, preferred: list[str], day: int = 0) -> DataFrame:
    """One brand of each source to show: the first of ``preferred`` that it has, else the brands of the source in turn.

    ``rows`` are ``ranked``; without a preferred one the brand at place ``day`` modulo their number stands for the source.
    """
    wish = F.array_position(F.array(*[F.lit(p) for p in preferred]).cast("array<string>"), F.col("marca"))
    of_fonte = Window.partitionBy("fonte")  # brands of one source: a catalogue
    order = of_fonte.orderBy(F.desc("total"), F.lower("marca_nome"), "marca")
    placed = rows.withColumn("_w", F.nullif(wish, F.lit(0))).withColumn("_i", F.row_number().over(order) - 1).withColumn("_n", F.count(F.lit(1)).over(of_fonte))
    placed = placed.withColumn("_best", F.min("_w").over(of_fonte))
    shown = F.when(F.col("_best").isNotNull(), F.col("_w").eqNullSafe(F.col("_best"))).otherwise(F.col("_i") == F.pmod(F.lit(day), F.col("_n")))
    return placed.where(shown).drop("_w", "_i", "_n", "_best")


def one_per_source(rows: DataFrame, preferred: str | None = None) -> DataFrame:
    """One brand per source: a preferred one if there is any, then by shops and name."""
    first = [F.desc(F.coalesce(F.col(preferred), F.lit(False)))] if preferred else []
    w = Window.partitionBy("fonte").orderBy(*first, F.desc("total"), F.lower("marca_nome"), "marca")
    return rows.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def nested(rows: DataFrame, size: int = PAGE) -> DataFrame:
    """The shops of each brand in page order, one row a page: marca, pagina, paginas, n, n_cidades, postos.

    Shops are in order of state, city (those without one last), name and id; ``postos`` holds at
    most ``size`` of them, so that no brand is one row of all its shops.  A shop listed twice for
    a brand is one; ``n`` and ``n_cidades`` (shops and cities of the whole brand) stand on each page.
    """
    last = F.lit("\uffff")
    shops = rows.select("marca", "uf", "municipio_slug", "municipio", "nome", "posto_id").dropDuplicates(["marca", "posto_id"]).withColumn("lugar", F.coalesce("municipio_slug", last))
    order = [F.col(c) for c in ("uf", "lugar", "nome", "posto_id")]
    paged = numbered(shops, ["marca"], order, size, "pagina")
    pages = paged.groupBy("marca", "pagina", "paginas").agg(F.array_sort(F.collect_list(F.struct("uf", "lugar", "nome", "posto_id", "municipio"))).alias("postos"))
    whole = shops.groupBy("marca").agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.when(F.col("lugar") != last, F.concat_ws("/", "uf", "lugar"))).alias("n_cidades"))
    return pages.join(whole, "marca").select("marca", "pagina", "paginas", "n", "n_cidades", "postos")


def pages(rows: DataFrame, marca: DataFrame, site: str, size: int = PAGE, shown: Callable[[Column], Column] = numero) -> DataFrame:
    """The page bodies of each brand: path, title, links to other pages, breadcrumbs, and a JSON-LD list of its shops.

    marca, pagina, caminho, titulo, trilha (JSON), lista (JSON-LD), corpo (HTML of at most ``size`` shops).
    ``shown`` writes the numbers of the title.
    """
    made = nested(rows, size).join(marca.select("marca", "marca_nome"), "marca")
    path = lambda n: F.concat(F.lit("/marcas/"), "marca", F.lit("/"), F.when(n > 1, F.concat(n.cast("string"), F.lit("/"))).otherwise(""))
    made = made.withColumn("caminho", path(F.col("pagina"))).withColumn("links", page_window(F.col("pagina"), F.col("paginas")))
    place = lambda p: F.concat_ws("-", p["municipio"], p["uf"])
    first = (F.col("pagina") - 1) * size
    items = F.transform("postos", lambda p, i: F.struct(
        F.lit("ListItem").alias("@type"), (first + i + 1).alias("position"),
        F.struct(F.lit("LocalBusiness").alias("@type"), p["nome"].alias("name"), F.struct(F.lit("PostalAddress").alias("@type"), p["municipio"].alias("addressLocality"), p["uf"].alias("addressRegion")).alias("address")).alias("item"),
    ))
    entry = lambda p: F.concat(F.lit("<li>"), escape_html(p["nome"]), F.lit(" \u2014 "), escape_html(place(p)), F.lit("</li>"))
    link = lambda n: F.when(n == F.col("pagina"), F.concat(F.lit("<b>"), n.cast("string"), F.lit("</b>"))).otherwise(F.concat(F.lit('<a href="'), path(n), F.lit('">'), n.cast("string"), F.lit("</a>")))
    corpo = F.concat(F.lit("<ul>"), F.array_join(F.transform("postos", entry), ""), F.lit("</ul>"), F.when(F.col("paginas") > 1, F.concat(F.lit("<nav>"), F.array_join(F.transform("links", link), " "), F.lit("</nav>"))).otherwise(""))
    count = F.concat(shown(F.col("n")), F.lit(" "), plural(F.col("n"), "oficina", "oficinas"), F.lit(" em "), shown(F.col("n_cidades")), F.lit(" "), plural(F.col("n_cidades"), "cidade", "cidades"))
    return made.select(
        "marca", "pagina", "paginas", "caminho", F.concat("marca_nome", F.lit(": "), count).alias("titulo"),
        breadcrumbs((F.lit("In\u00edcio"), F.lit(f"{site}/")), (F.lit("Marcas"), F.lit(f"{site}/marcas/")), (F.col("marca_nome"), None)).alias("trilha"),
        json_ld("ItemList", numberOfItems=F.col("n"), itemListElement=items).alias("lista"), corpo.alias("corpo"),
    )


def brands_by_city(cities: DataFrame) -> DataFrame:
    """(uf, municipio_slug) -> its brands with their counts."""
    return cities.groupBy("uf", "municipio_slug").agg(F.array_sort(F.collect_list(F.struct("marca", "total"))).alias("marcas"))
