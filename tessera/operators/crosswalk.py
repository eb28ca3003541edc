"""Municipalities: the state of a code by majority, names matched by slug, and cities found in text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import _text, let, slug


def mode_with_ties(rows: DataFrame, key: str, value: str) -> DataFrame:
    """key, the most frequent value (smallest on ties), its count n, n_total, and whether others occur."""
    pairs = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(key)
    ranked = pairs.withColumn("n_total", F.sum("n").over(w)).withColumn("pos", F.row_number().over(w.orderBy(F.desc("n"), F.asc(value))))
    return ranked.where("pos = 1").select(key, value, "n", "n_total", (F.col("n") != F.col("n_total")).alias("ambiguous"))


def state_of_codes(estabelecimentos: DataFrame) -> DataFrame:
    rows = estabelecimentos.where("municipio is not null and municipio <> '' and uf is not null and length(uf) = 2").select(F.col("municipio").alias("codigo_rfb"), "uf")
    return mode_with_ties(rows, "codigo_rfb", "uf").select("codigo_rfb", "uf", F.col("n").alias("n_na_uf_vencedora"), "n_total", F.col("ambiguous").alias("uf_ambigua"))


def municipalities(municipios_rfb: DataFrame, state: DataFrame, ibge: DataFrame) -> DataFrame:
    """The crosswalk: official names where state and slug agree, the registry's otherwise."""
    m = municipios_rfb.withColumn("municipio_slug", slug("nome_rfb")).join(state, "codigo_rfb", "left")
    i = ibge.select(F.col("uf").alias("i_uf"), "nome_slug", "nome", "codigo_ibge")
    return m.join(i, (F.col("i_uf") == F.col("uf")) & (F.col("nome_slug") == F.col("municipio_slug")), "left").select(
        "codigo_rfb", F.coalesce("nome", "nome_rfb").alias("municipio"), F.col("nome_rfb").alias("municipio_rfb"), "uf", "municipio_slug",
        F.col("codigo_ibge").alias("ibge"), "uf_ambigua", F.col("n_total").alias("estabelecimentos_no_municipio"),
    )


def duplicate_slugs(municipios: DataFrame) -> DataFrame:
    named = F.concat_ws("=", "codigo_rfb", "municipio")
    return (
        municipios.where("municipio_slug is not null and uf is not null").groupBy("uf", "municipio_slug")
        .agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list(named)), " | ").alias("colisoes")).where("n > 1")
    )


def unmatched(municipios: DataFrame) -> DataFrame:
    why = F.when(F.col("uf").isNull(), WITHOUT_STATE).when(F.col("ibge").isNull(), WITHOUT_NAME)
    return (
        municipios.where("ibge is null or uf is null").select("codigo_rfb", "municipio", "municipio_slug", "uf", "estabelecimentos_no_municipio", why.alias("motivo"))
        .orderBy(F.desc_nulls_last("estabelecimentos_no_municipio"), "codigo_rfb")
    )


def targets(municipios: DataFrame) -> DataFrame:
    """One row per (uf, slug); of colliding names the first in order."""
    return municipios.where("uf is not null and municipio_slug is not null").groupBy("uf", "municipio_slug").agg(F.min("municipio").alias("municipio"), F.min("ibge").alias("ibge"))


# How a shop's municipality was found, and why a code has none.
WITHOUT_STATE, WITHOUT_NAME = "sem UF: nenhum estabelecimento usa este código", "sem correspondência IBGE por nome+UF"
PUBLISHED = "cidade publicada pela fonte"
IN_ADDRESS = "nome do município no endereço"
FEDERAL = "município único do Distrito Federal"


def word_spans(address: Column, most: Column) -> Column:
    """Runs of up to ``most`` words of a hyphenated text, with the place of their first letter: array of (at, span)."""
    words = F.split(address, "-")
    from_word = lambda ws, i: F.transform(
        F.sequence(F.lit(1), F.least(most, F.size(ws) - i)),
        lambda k: F.struct((F.length(F.array_join(F.slice(ws, 1, i), "-")) + F.when(i > 0, 1).otherwise(0)).alias("at"), F.array_join(F.slice(ws, i + 1, k), "-").alias("span")),
    )
    return let(words, lambda ws: F.flatten(F.transform(F.sequence(F.lit(0), F.size(ws) - 1), lambda i: from_word(ws, i))))


def city_of_posts(posts: DataFrame, targets: DataFrame) -> DataFrame:
    """posto_id -> municipality by three routes: published city, whole word in the address, the federal district.

    A name stands in an address as a run of its words.  Runs as long as the longest name of
    their state are looked up by (uf, name) in a hash join, so that no shop is compared with all
    cities of its state.  Of several names the rightmost wins (by where a name is first), then the
    longest, then by slug; names of under four letters count only at the end of the address.
    """
    p = posts.select("posto_id", "uf_fonte", F.when(_text("cidade_fonte") != "", slug("cidade_fonte")).alias("city"), slug("endereco").alias("address"))
    t = targets.select(F.col("uf").alias("t_uf"), "municipio_slug", "municipio", "ibge")
    out = lambda df, how: df.select("posto_id", "municipio", "municipio_slug", "ibge", F.lit(how).alias("municipio_origem"))
    direct = p.join(t, (F.col("t_uf") == F.col("uf_fonte")) & (F.col("municipio_slug") == F.col("city")))
    left = p.join(direct.select("posto_id"), "posto_id", "left_anti")
    longest = t.groupBy("t_uf").agg(F.max(F.size(F.split("municipio_slug", "-"))).alias("most"))  # a row a state
    runs = left.where("address is not null").join(longest, F.col("t_uf") == F.col("uf_fonte")).drop("t_uf")
    runs = runs.select("posto_id", "uf_fonte", "address", F.explode(word_spans(F.col("address"), F.col("most"))).alias("w")).groupBy("posto_id", "uf_fonte", "address", "w.span").agg(F.min("w.at").alias("at"))
    s = F.col("span")
    closes = F.endswith("address", F.concat(F.lit("-"), s)) | F.endswith("address", F.concat(F.lit("-"), s, F.lit("-"), F.lower("uf_fonte")))
    found = runs.where((F.length(s) >= 4) | closes).join(t, (F.col("t_uf") == F.col("uf_fonte")) & (F.col("municipio_slug") == s))
    order = Window.partitionBy("posto_id").orderBy(F.desc("at"), F.desc(F.length("municipio_slug")), "municipio_slug")
    best = found.withColumn("pos", F.row_number().over(order)).where("pos = 1")
    rest = left.where("uf_fonte = 'DF'").join(best.select("posto_id"), "posto_id", "left_anti").join(t.where("t_uf = 'DF'"), F.col("t_uf") == F.col("uf_fonte"))
    return out(direct, PUBLISHED).unionByName(out(best, IN_ADDRESS)).unionByName(out(rest, FEDERAL))


def posts_without_city(posts: DataFrame, matched: DataFrame) -> DataFrame:
    return posts.join(matched.select("posto_id"), "posto_id", "left_anti").select("fonte", "posto_id", "nome", "uf_fonte", "cidade_fonte", "endereco").orderBy("fonte", "uf_fonte", "nome", "posto_id")
