"""Sinks and page shaping: deterministic CSV and Parquet, one pass per partition value, paging, JSON-LD, SQLite."""

from __future__ import annotations

import os
import sqlite3
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage

PAGE = 100
SITEMAP = 45_000
BATCH = 50_000
#: Rows of a group that one task numbers.
WHOLE = 200_000


def write_csv(rows: DataFrame, path: str, order: list, sep: str = ",", one_file: bool = False) -> None:
    """CSV with a header in a total order; ``one_file`` is for reports of a bounded size."""
    out = rows.orderBy(*order)
    (out.coalesce(1) if one_file else out).write.mode("overwrite").options(header=True, sep=sep, quote='"', escape='"').csv(path)


def write_parquet(rows: DataFrame, path: str, by: list[str] | None = None, order: list | None = None, tasks: int = 8) -> None:
    """Zstandard Parquet; with ``by`` one folder per value in a single pass, sorted inside each file.

    A value is dealt over up to ``tasks`` tasks, so that a value with most of the rows does not
    end in one.
    """
    out = rows
    if by:
        hashed = [c for c, kind in rows.dtypes if not kind.startswith(("map", "variant"))]
        deal = F.pmod(F.xxhash64(*hashed), F.lit(tasks))
        out = rows.repartition(*by, deal).sortWithinPartitions(*by, *(order or []))
    writer = out.write.mode("overwrite").option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_lookup(rows: DataFrame, path: str, key: str, order: list[str], group_rows: int = 100_000, file_rows: int = 5_000_000) -> None:
    """A serving copy for lookups: Parquet in ranges of ``order``, sorted, in row groups of ``group_rows``.

    A filter on the columns of ``order`` reads the row groups whose statistics allow it; one on
    ``key``, which is scattered over the files, those whose bloom filter does.
    """
    n = rows.count()
    ranged = rows.repartitionByRange(max(1, -(-n // file_rows)), *order, key).sortWithinPartitions(*order, key)
    options = {
        "compression": "zstd", "parquet.block.row.count.limit": group_rows, f"parquet.bloom.filter.enabled#{key}": True, f"parquet.bloom.filter.expected.ndv#{key}": group_rows,
        # a column that is a dictionary would be pruned by that, and gets no bloom filter
        f"parquet.enable.dictionary#{key}": False,
    }
    ranged.write.mode("overwrite").options(**options).parquet(path)


def lookup(spark, path: str, **equal) -> DataFrame:
    """Rows of a serving copy by the values of some columns."""
    rows = spark.read.parquet(path)
    return rows.where(reduce(and_, [F.col(c) == F.lit(v).cast(rows.schema[c].dataType) for c, v in equal.items()]))


def numbered(rows: DataFrame, group: list[str], order: list[Column], size: int = PAGE, name: str = "page", whole: int = WHOLE) -> DataFrame:
    """1-based page (or shard) of each row in its group's total order, and the group's page count.

    Where no group has more than ``whole`` rows, a count beforehand says, a group is numbered in one
    task.  Otherwise rows are dealt by ranges of group and order, so that a group with most of the rows is spread;
    a row's number is its place in its range after the rows of the group's ranges before, whose
    counts are one small row per group and range. Without ``group`` all rows are one. Null is a group; rows that tie in ``order``
    are numbered in any order among themselves.
    """
    part, before, total = "_range", "_before", "_total"
    sizes = rows.groupBy(*group).agg(F.count(F.lit(1)).alias("n"))
    if (sizes.agg(F.max("n")).first()[0] or 0) <= whole:
        of_group = Window.partitionBy(*[F.col(c) for c in group]) if group else Window.partitionBy(F.lit(0))
        place, count = F.row_number().over(of_group.orderBy(*order)), F.count(F.lit(1)).over(of_group)
        return rows.select("*", (F.floor((place - 1) / size) + 1).cast("long").alias(name), F.ceil(count / size).cast("long").alias(f"{name}s"))
    ranged = stage(rows.repartitionByRange(*group, *order).withColumn(part, F.spark_partition_id()), "numbered")
    of_group = Window.partitionBy(*group)
    counts = ranged.groupBy(*group, part).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col(part).alias("_at"), F.sum("_n").over(of_group).alias(total),
        (F.sum("_n").over(of_group.orderBy(part).rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias(before),
    )
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_g{i}")) for i, c in enumerate(group)], F.col(part) == F.col("_at"))
    place = F.row_number().over(Window.partitionBy(*group, part).orderBy(*order)) + F.col(before)
    return ranged.join(counts, same).select(
        *rows.columns, (F.floor((place - 1) / size) + 1).cast("long").alias(name), F.ceil(F.col(total) / size).cast("long").alias(f"{name}s"),
    )


def page_window(page: Column, pages: Column) -> Column:
    """Page links shown: the first, the last, and two on each side, ascending."""
    near = F.sequence(F.greatest(F.lit(1).cast("long"), page - 2), F.least(pages, page + 2))
    return F.array_sort(F.array_distinct(F.concat(F.array(F.lit(1).cast("long")), near, F.array(pages))))


def city_pages(rows: DataFrame, brands: DataFrame, brand_vertical: str, size: int = PAGE) -> DataFrame:
    """One row for each page of each city of each vertical, with its path and how many of the city's rows it shows.

    ``rows`` are published rows (a row of a city without rows does not exist); ``principais`` counts those
    that are there by their main activity.  ``brands`` (uf, municipio_slug, marcas) is shown by one
    vertical only: everywhere else, and in cities without any, ``marcas`` is empty and not null.
    """
    per = rows.groupBy("vertical", "uf", "municipio", "municipio_slug").agg(
        F.count(F.lit(1)).alias("total"), F.count_if(F.col("origem_cnae") == "principal").alias("principais")
    )
    per = per.join(brands.withColumn("vertical", F.lit(brand_vertical)), ["vertical", "uf", "municipio_slug"], "left")
    per = per.withColumn("marcas", F.coalesce("marcas", F.array().cast(brands.schema["marcas"].dataType)))
    per = per.withColumn("paginas", F.ceil(F.col("total") / size).cast("long"))
    pages = per.withColumn("pagina", F.explode(F.sequence(F.lit(1).cast("long"), "paginas")))
    number = F.when(F.col("pagina") > 1, F.concat(F.col("pagina").cast("string"), F.lit("/"))).otherwise("")
    path = F.concat(F.lit("/"), "vertical", F.lit("/"), F.lower("uf"), F.lit("/"), "municipio_slug", F.lit("/"), number)
    return pages.withColumn("caminho", path).withColumn("na_pagina", F.least(F.lit(size).cast("long"), F.col("total") - size * (F.col("pagina") - 1)))


def sitemap(paths: DataFrame, site: str, day: str, size: int = SITEMAP) -> DataFrame:
    """``paths`` (caminho) in order of their path, dealt to numbered sitemap files, with their entries."""
    found = numbered(paths.select("caminho"), [], [F.col("caminho")], size, "arquivo")
    address = escape_html(F.concat(F.lit(site), "caminho"))
    end = F.lit(f"</loc><lastmod>{day}</lastmod><changefreq>monthly</changefreq></url>")
    return found.withColumn("entrada", F.concat(F.lit("<url><loc>"), address, end))


def json_ld(kind: str, **fields: Column) -> Column:
    """A JSON-LD object; null fields are left out."""
    return F.to_json(F.struct(F.lit("https://schema.org").alias("@context"), F.lit(kind).alias("@type"), *[c.alias(k) for k, c in fields.items()]))


def breadcrumbs(*steps: tuple[Column, Column | None]) -> Column:
    """A breadcrumb list as JSON; a step without a link has no item."""
    items = [F.struct(F.lit("ListItem").alias("@type"), F.lit(i).alias("position"), name.alias("name"), (F.lit(None).cast("string") if link is None else link).alias("item")) for i, (name, link) in enumerate(steps, 1)]
    return F.to_json(F.array(*items))


def escape_html(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def numero(c: Column) -> Column:
    """1.234.567; a dash for null."""
    return F.coalesce(F.replace(F.format_number(c, 0), F.lit(","), F.lit(".")), F.lit("—"))


def percentual(part: Column, total: Column) -> Column:
    """1234,5 %, without points between thousands; a dash where there is no total, null where only the part is missing."""
    share = F.translate(F.format_number(F.lit(100.0) * part / F.nullif(total, F.lit(0)), 1), ".,", ",")
    return F.when(total.isNull() | (total == 0), F.lit("—")).otherwise(F.concat(share, F.lit(" %")))


def data_br(c: Column) -> Column:
    return F.date_format(c, "dd/MM/yyyy")


def plural(n: Column, one: str, many: str) -> Column:
    return F.when(n == 1, one).otherwise(many)


def without_scheme(c: Column) -> Column:
    return F.regexp_replace(c, r"\Ahttps?://", "")


def content_name(c: Column) -> Column:
    """Ten hash digits, for file names that change with their content."""
    return F.substring(F.sha2(c.cast("binary"), 256), 1, 10)


def markdown(rows: DataFrame, limit: int = 10_000) -> str:
    """A small result as a Markdown table; for reports only, so more than ``limit`` rows are an error."""
    got = rows.limit(limit + 1).collect()
    if len(got) > limit:
        raise ValueError(f"more than {limit} rows in a report table")
    lines = ["| " + " | ".join(rows.columns) + " |", "|" + "|".join(["---"] * len(rows.columns)) + "|"]
    return "\n".join(lines + ["| " + " | ".join("—" if v is None else str(v) for v in r) + " |" for r in got])


def write_sqlite(rows: DataFrame, path: str, name: str, indexes: dict[str, list[str]] | None = None, meta: dict | None = None) -> int:
    """A serving copy on the driver's disk, streamed in batches, indexed, and put in place at the end.

    A table ``meta`` has the number of rows and what the caller adds.
    """
    part, n = f"{path}.part", 0
    if os.path.exists(part):
        os.remove(part)
    with sqlite3.connect(part) as con:
        kinds = {"bigint": "INTEGER", "int": "INTEGER", "boolean": "INTEGER", "double": "REAL"}
        con.execute(f"CREATE TABLE {name} (" + ", ".join(f'"{c}" {kinds.get(t, "TEXT")}' for c, t in rows.dtypes) + ")")
        insert, held = f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows.columns))})", []
        for r in rows.toLocalIterator():
            held.append(tuple(v if isinstance(v, (int, float, str, type(None))) else str(v) for v in r))
            if len(held) == BATCH:
                con.executemany(insert, held)
                n, held = n + len(held), []
        con.executemany(insert, held)
        n += len(held)
        for index, columns in (indexes or {}).items():
            con.execute(f"CREATE INDEX {index} ON {name} ({', '.join(columns)})")
        con.execute("CREATE TABLE meta (chave TEXT PRIMARY KEY, valor TEXT)")
        con.executemany("INSERT INTO meta VALUES (?, ?)", [("linhas", str(n)), *((k, str(v)) for k, v in (meta or {}).items())])
        con.execute("ANALYZE")
    con.execute("VACUUM")
    con.close()
    if not n:
        os.remove(part)
        raise ValueError(f"{name}: nothing to publish")
    os.replace(part, path)
    return n
