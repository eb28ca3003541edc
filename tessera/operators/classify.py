"""Many-to-many classification of establishments by activity codes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ID = ["cnpj_basico", "cnpj_ordem", "cnpj_dv"]


def active(estabelecimentos: DataFrame) -> DataFrame:
    return estabelecimentos.where(F.col("situacao_cadastral") == "02")


def secondary_codes(rows: DataFrame) -> DataFrame:
    """One row per code of the comma list ``cnae_fiscal_secundaria``, trimmed, blanks dropped."""
    listed = rows.where(F.col("cnae_fiscal_secundaria").isNotNull() & (F.col("cnae_fiscal_secundaria") != ""))
    return listed.withColumn("cnae", F.explode(F.split("cnae_fiscal_secundaria", ","))).withColumn("cnae", F.trim("cnae")).where("cnae <> ''")


def target_codes(estabelecimentos: DataFrame, vertical_cnae: DataFrame) -> DataFrame:
    """(id parts, cnae, origem) of every active establishment's mapped codes, repeats kept."""
    codes = vertical_cnae.select("cnae").distinct()
    rows = active(estabelecimentos).select(*ID, "cnae_fiscal_principal", "cnae_fiscal_secundaria")
    first = rows.withColumn("cnae", F.col("cnae_fiscal_principal")).join(codes, "cnae", "left_semi").select(*ID, "cnae", F.lit("principal").alias("origem"))
    others = secondary_codes(rows).join(codes, "cnae", "left_semi").select(*ID, "cnae", F.lit("secundario").alias("origem"))
    return first.unionByName(others)


def verticals_of(target: DataFrame, vertical_cnae: DataFrame) -> DataFrame:
    """id x vertical with its origin and the sorted list of codes."""
    return (
        target.join(vertical_cnae, "cnae")
        .groupBy(F.concat(*ID).alias("id"), "vertical", "rotulo")
        .agg(
            F.when(F.bool_or(F.col("origem") == "principal"), "principal").otherwise("secundario").alias("origem_cnae"),
            F.array_join(F.array_sort(F.collect_set("cnae")), ",").alias("cnaes_da_vertical"),
        )
    )


def code_counts(estabelecimentos: DataFrame, cnaes: DataFrame) -> DataFrame:
    """codigo, descricao and how many active establishments have it as first and as further code."""
    rows = active(estabelecimentos)
    first = rows.groupBy(F.col("cnae_fiscal_principal").alias("codigo")).agg(F.count(F.lit(1)).alias("p"))
    other = secondary_codes(rows).groupBy(F.col("cnae").alias("codigo")).agg(F.count(F.lit(1)).alias("s"))
    zero = F.lit(0).cast("long")
    return cnaes.join(first, "codigo", "left").join(other, "codigo", "left").select("codigo", "descricao", F.coalesce("p", zero).alias("n_principal"), F.coalesce("s", zero).alias("n_secundario"))


def search(cnaes: DataFrame, pattern: str) -> DataFrame:
    """Codes whose accent-free description matches."""
    from ..functions.text import strip_accents

    return cnaes.where(F.lower(strip_accents(F.col("descricao"))).rlike(pattern)).select("codigo", "descricao").orderBy("codigo")
