"""Exact deduplication by 128-bit content hash, with a byte comparison inside groups.

Texts are equal when they are identical after all white space is deleted.  Rows are grouped
by the MD5 of the normalised text *and by its bytes*: the hash aggregate compares the bytes
of all rows that share a hash, so a collision cannot merge two texts.  The aggregate runs
map-side first: a group of copies sends one row per task, however many rows it has.
Each document then finds its group by a narrow join on MD5 and SHA-256, 384 bits that stand
for the compared bytes on the way back; AQE can split its skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .textcols import free_prefix, whole, without_ws

# (code points, id) packed into one decimal, so that the choice of the survivor is a plain
# max with a fixed-width buffer and the aggregate stays a hash aggregate.
_SPAN = 2**65
_HALF = 2**63


def _rank(n_chars: Column, doc_id: Column) -> Column:
    low = F.lit(str(_SPAN - 1 - _HALF)).cast("decimal(21,0)") - F.coalesce(doc_id.cast("decimal(20,0)"), F.lit(str(_HALF)).cast("decimal(20,0)"))
    return (n_chars.cast("decimal(11,0)") * F.lit(str(_SPAN)).cast("decimal(20,0)") + low).cast("decimal(38,0)")


def _ranked_id(rank: Column) -> Column:
    doc = F.lit(str(_SPAN - 1 - _HALF)).cast("decimal(21,0)") - F.pmod(rank, F.lit(str(_SPAN)).cast("decimal(38,0)"))
    return F.when(doc < F.lit(str(_HALF)).cast("decimal(21,0)"), doc.cast("long"))


def default_hash(norm: Column) -> Column:
    return F.unhex(F.md5(norm.cast("binary")))


def groups_of(docs: DataFrame, hash128=default_hash) -> DataFrame:
    """One row per distinct normalised text: hash128, sha, keep_id, group_size."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.length(whole(docs["text"])).alias("n"), without_ws(whole(docs["text"])).alias("norm"))
    rows = rows.select(hash128(F.col("norm")).alias("hash128"), "norm", _rank(F.col("n"), F.col("id")).alias("rank"))
    return (
        rows.groupBy("hash128", "norm")
        .agg(F.max("rank").alias("rank"), F.count(F.lit(1)).alias("group_size"))
        .select("hash128", F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"), _ranked_id(F.col("rank")).alias("keep_id"), "group_size")
    )


def exact_dedup(docs: DataFrame, hash128=default_hash) -> DataFrame:
    """Decide for every row of ``docs(doc_id, text, ...)`` whether it stays.

    Returns one row per input row: doc_id, keep_id, group_size, kept, text_sha256.
    Of equal texts the row with the most code points stays, then the smallest doc_id.

    * null text counts as empty; empty texts are one group;
    * a null doc_id stays only if its whole group has no id (keep_id is then null and every
      row of that group is kept);
    * rows repeated with the same doc_id and an equal text are all kept if their id is;
    * texts of any length are hashed and compared whole, each in the task that holds it;
    * other columns are ignored; an empty table gives an empty result.
    """
    norm = without_ws(whole(docs["text"]))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), norm.alias("norm"))
    rows = rows.select("doc_id", hash128(F.col("norm")).alias("hash128"), F.unhex(F.sha2(F.col("norm").cast("binary"), 256)).alias("sha"))
    groups = groups_of(docs, hash128)
    return (
        rows.join(groups, ["hash128", "sha"], "left")
        .select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))
    )


def least_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """One row of each value of ``keys``: the least by all other columns in order of their names (as JSON where they have no order)."""
    rest = sorted(set(rows.columns) - set(keys))
    if not rest:
        return rows.dropDuplicates(keys)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    orderless = [c for c in rest if "map<" in kinds[c] or "variant" in kinds[c]]
    row = F.struct(*rest)
    if orderless:
        order = F.struct(*[F.to_json(F.struct(c)).alias(c) if c in orderless else F.col(c) for c in rest])
        least = F.min_by(row, order)
    else:  # the row is its own order: texts are moved once
        least = F.min(row)
    found = rows.groupBy(*keys).agg(least.alias("__row"))
    return found.select(*[F.col(c) if c in keys else F.col("__row")[c].alias(c) for c in rows.columns])


def drop_duplicates(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that another row of equal text replaces, all columns as they were.

    Of rows that share a doc_id and an equal text the least by their other columns stays.  Rows without doc_id stay only
    where no row of their text has one, all of them.
    """
    decided, this = stage(exact_dedup(docs), "exact"), f"{free_prefix(docs)}sha"
    lost = decided.where(~F.col("kept") & F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("__id"), F.unhex("text_sha256").alias("__sha")).distinct()
    sha = F.unhex(F.sha2(without_ws(whole(docs["text"])).cast("binary"), 256))
    known = docs.where(F.col("doc_id").isNotNull()).withColumn(this, sha)
    stay = known.join(lost, (known["doc_id"] == lost["__id"]) & (known[this] == lost["__sha"]), "left_anti")
    stay = least_rows(stay, ["doc_id", this]).drop(this)
    nameless = docs.where(F.col("doc_id").isNull())
    alone = decided.where(F.col("kept") & F.col("doc_id").isNull()).select(F.unhex("text_sha256").alias("__sha")).distinct()
    return stay.unionByName(nameless.join(alone, sha == alone["__sha"], "left_semi"))


def op2_exact_dedup(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    return exact_dedup(table(spark, sf_dir, "documents"))


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents),
g AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
         first_value(doc_id) OVER (PARTITION BY norm ORDER BY n DESC, doc_id) AS keep_id
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM g
"""
