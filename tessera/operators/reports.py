"""Reports over the canonical export, data-quality checks and count trails."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def by_state(exported: DataFrame) -> DataFrame:
    return exported.groupBy("vertical", "uf").agg(F.count(F.lit(1)).alias("total")).orderBy("vertical", F.desc("total"), "uf")


def by_city(exported: DataFrame) -> DataFrame:
    return exported.groupBy("vertical", "uf", "municipio", "municipio_slug", "ibge").agg(
        F.count(F.lit(1)).alias("total"), F.count("telefone").alias("com_telefone"), F.count_if(F.col("telefone_tipo") == "fixo").alias("com_fixo"),
        F.count_if(F.col("telefone_tipo") == "movel").alias("com_movel"), F.count("email").alias("com_email"), F.count("site_candidato").alias("com_site_candidato"),
    )


def top_per_group(rows: DataFrame, group: list[str], order: list[Column], n: int, name: str = "pos") -> DataFrame:
    """The first ``n`` rows of each group in a total order."""
    return rows.withColumn(name, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(name) <= n)


def top_cities(cities: DataFrame, n: int = 100) -> DataFrame:
    return top_per_group(cities, ["vertical"], [F.desc("total"), F.asc_nulls_last("uf"), F.asc_nulls_last("municipio"), F.asc_nulls_last("municipio_slug")], n)


def size_band(total: Column) -> Column:
    return F.when(total == 1, "1").when(total == 2, "2").when(total.between(3, 5), "3-5").when(total.between(6, 10), "6-10").otherwise("11+")


def size_bands(rows: DataFrame, group: str, total: str = "total") -> DataFrame:
    """group, faixa: how many rows fall into each band of ``total``, and their sum."""
    return rows.groupBy(group, size_band(F.col(total)).alias("faixa")).agg(F.count(F.lit(1)).alias("cidades"), F.sum(total).alias("estabelecimentos"))


def share_of_group(rows: DataFrame, group: str, n: str, name: str = "pct") -> DataFrame:
    total = F.sum(n).over(Window.partitionBy(group))
    return rows.withColumn(name, F.round(F.lit(100.0) * F.col(n).cast("double") / total, 1))


def composition(target: DataFrame, vertical_cnae: DataFrame, cnaes: DataFrame) -> DataFrame:
    pairs = target.join(vertical_cnae.select("vertical", "cnae"), "cnae").groupBy("vertical", "cnae").agg(F.count(F.lit(1)).alias("n"))
    return share_of_group(pairs, "vertical", "n", "pct_da_vertical").join(cnaes.withColumnRenamed("codigo", "cnae"), "cnae").select("vertical", "cnae", "descricao", "n", "pct_da_vertical")


def code_report(vertical_cnae: DataFrame, cnaes: DataFrame, counts: DataFrame) -> DataFrame:
    known = vertical_cnae.join(cnaes.withColumnRenamed("codigo", "cnae"), "cnae")
    rows = known.join(counts.select(F.col("codigo").alias("cnae"), "n_principal", "n_secundario"), "cnae", "left")
    return rows.select("vertical", "cnae", "descricao", "n_principal", "n_secundario", (F.col("n_principal") + F.col("n_secundario")).alias("n_total_ocorrencias"))


def fill_rates(exported: DataFrame) -> DataFrame:
    """Seventeen counts by vertical."""
    c = F.count_if
    return exported.groupBy("vertical").agg(
        F.count(F.lit(1)).alias("total"), F.count_distinct(F.concat("municipio_slug", F.lit("/"), "uf")).alias("cidades"), F.count("telefone").alias("com_telefone"),
        c(F.col("telefone_tipo") == "fixo").alias("com_fixo"), c(F.col("telefone_tipo") == "movel").alias("com_movel"), F.count("telefone_2").alias("com_segundo_telefone"),
        F.count("nome_fantasia").alias("com_nome_fantasia"), F.count("email").alias("com_email"), F.count("site_candidato").alias("com_site_candidato"),
        F.count("endereco").alias("com_endereco"), F.count("cep_formatado").alias("com_cep"), c(F.col("origem_cnae") == "principal").alias("via_cnae_principal"),
        c(F.col("origem_cnae") == "secundario").alias("via_cnae_secundario"), c("mei").alias("mei"), c("matriz").alias("matriz"),
        c("suspeita_duplicata").alias("suspeita_duplicata"), c(F.col("ibge").isNull()).alias("sem_ibge"),
    )


def abroad(exported: DataFrame) -> DataFrame:
    return exported.where("uf = 'EX'").groupBy("vertical").agg(F.count(F.lit(1)).alias("total")).orderBy(F.desc("total"), "vertical")


def sole_traders(target: DataFrame, verticals: DataFrame) -> DataFrame:
    """The opt-out list: rows of sole traders with the verticals they are in."""
    keys = ["id", "cnpj_formatado", "nome", "razao_social", "uf", "municipio", "telefone_formatado", "telefone_9_formatado", "email"]
    lists = verticals.groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("vertical")), ",").alias("verticais"))
    return target.where("mei").select(*keys).join(lists, "id").orderBy(F.asc_nulls_last("uf"), F.asc_nulls_last("municipio"), "nome", "id")


def crosstab(rows: DataFrame, group: str, column: str, values: list, total: Column) -> DataFrame:
    """One column per value; missing cells are 0."""
    return rows.groupBy(group).pivot(column, values).agg(total).fillna(0)


def invalid_codes(vertical_cnae: DataFrame, cnaes: DataFrame) -> DataFrame:
    return vertical_cnae.join(cnaes, vertical_cnae["cnae"] == cnaes["codigo"], "left_anti").select("vertical", "cnae")


def require_valid_codes(vertical_cnae: DataFrame, cnaes: DataFrame) -> None:
    bad = invalid_codes(vertical_cnae, cnaes).limit(20).collect()
    if bad:
        raise ValueError(f"codes of the map that the dictionary lacks: {[tuple(r) for r in bad]}")


def count_trail(rows: DataFrame, **conditions: Column) -> DataFrame:
    """All stage counts of one relation in a single aggregate: stage, n."""
    named = {"rows": F.lit(True)} | conditions
    wide = rows.agg(*[F.count_if(c).alias(n) for n, c in named.items()])
    return wide.select(F.explode(F.array(*[F.struct(F.lit(n).alias("stage"), F.col(n).alias("n")) for n in named])).alias("x")).select("x.*")


def require_unique(rows: DataFrame, key: list[str], what: str) -> None:
    bad = rows.groupBy(*key).count().where("count > 1").limit(1).collect()
    if bad:
        raise ValueError(f"{what}: repeated key {bad[0]}")


def require_rows(rows: DataFrame, what: str) -> None:
    if rows.isEmpty():
        raise ValueError(f"{what} is empty")


def dominant(rows: DataFrame, group: str, n: str, label: str, pattern: str, least: float = 60.0) -> DataFrame:
    """Entries that hold ``least`` percent of their group under a generic label."""
    return share_of_group(rows, group, n).where((F.col("pct") >= least) & F.col(label).rlike(pattern))


def leaks(rows: DataFrame, column: str) -> DataFrame:
    """Rows of ``column`` that end in an 11-digit personal number."""
    return rows.where(F.col(column).rlike(r"[0-9]{11}\z"))
