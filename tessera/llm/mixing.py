"""Mixing sources to target weights by hash-threshold histograms.

A document is taken floor(target / source size) times, and once more if its hash lies below
a threshold of its source.  The threshold is found without sorting: sum tokens by source and
hash bucket, find the bucket in which the budget ends, and refine only that bucket.  Budgets
are nested: a larger one keeps every document a smaller one takes.

What reaches the driver is one row per source, for the totals and for each of at most six
refinements; ``max_sources`` states the bound and is checked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .textcols import free_prefix, n_words, utf8_crc32

BITS, LEVELS = 10, 6  # 60 hash bits, 1,024 buckets a level
MAX_SOURCES = 100_000


def targets(sizes: dict, weights: dict, budget: float, most: float = 2.0) -> dict:
    """Water-filling: shares by weight, none above ``most`` times its size, the excess shared again."""
    out = {s: 0.0 for s in sizes}
    open_ = {s for s in sizes if sizes[s] > 0 and weights[s] > 0}
    left = float(budget)
    while open_:
        unit = left / sum(weights[s] for s in open_)
        full = {s for s in open_ if unit * weights[s] > most * sizes[s]}
        if not full:
            for s in open_:
                out[s] = unit * weights[s]
            break
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def _bits(doc_id: Column, crc: Column) -> Column:
    return F.shiftrightunsigned(F.xxhash64(F.coalesce(doc_id.cast("long"), crc)), 64 - BITS * LEVELS)


def thresholds(rows: DataFrame, need: dict) -> dict:
    """Hash below which rows of each source add up closest to ``need`` (source -> tokens).

    ``rows`` has source, size, h.  Rows at the boundary are in or out, whichever is nearer.
    """
    spark = rows.sparkSession
    out = {s: 0 for s in need}
    prefix = {s: 0 for s, n in need.items() if n > 0}
    for level in range(LEVELS):
        if not prefix:
            break
        state = spark.createDataFrame([(s, p, float(need[s])) for s, p in prefix.items()], "s string, prefix long, need double")
        below = BITS * (LEVELS - level - 1)
        inside = rows.join(F.broadcast(state), rows["source"].eqNullSafe(state["s"]) & (F.shiftright("h", below + BITS) == F.col("prefix")))
        buckets = inside.groupBy("s", "need", F.shiftright("h", below).alias("b")).agg(F.sum("size").alias("t"), F.count(F.lit(1)).alias("n"))
        running = F.sum("t").over(Window.partitionBy("s").orderBy("b"))  # at most 1,024 rows a source
        ends = buckets.withColumn("upto", running).where(F.col("upto") >= F.col("need"))
        for r in ends.groupBy("s").agg(F.min(F.struct("b", "t", "n", "upto")).alias("x")).select("s", "x.*").collect():
            s = r["s"]
            need[s] -= r["upto"] - r["t"]
            prefix[s] = r["b"]
            if r["n"] == 1 or level == LEVELS - 1:
                out[s] = (r["b"] + (need[s] * 2 >= r["t"])) << below
                del prefix[s]
    return out


_PLAN = "s string, source_size long, target double, whole int, below long"


def plan(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0, max_sources: int = MAX_SOURCES) -> DataFrame:
    """One row per source: its size, its target, whole copies of each document, and the hash below which one more."""
    spark = docs.sparkSession
    rows = stage(docs.select(docs["source"].cast("string").alias("source"), n_words(docs["text"]).alias("size"), _bits(docs["doc_id"], utf8_crc32(docs["text"])).alias("h")), "mix")
    sizes = {r["source"]: r["t"] for r in rows.groupBy("source").agg(F.sum("size").alias("t")).limit(max_sources + 1).collect()}
    if len(sizes) > max_sources:
        raise ValueError(f"more than {max_sources} sources: merge the small ones first")
    ordered = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(ordered)}
    target = targets(sizes, weight, share * sum(sizes.values()), most)
    whole_copies = {s: int(target[s] // sizes[s]) if sizes[s] else 0 for s in ordered}
    below = thresholds(rows, {s: target[s] - whole_copies[s] * sizes[s] for s in ordered})
    return spark.createDataFrame([(s, sizes[s], target[s], whole_copies[s], below[s]) for s in ordered], _PLAN)


def with_copies(docs: DataFrame, chosen: DataFrame, prefix: str) -> DataFrame:
    """``docs`` and its source's row of the plan and the number of copies, their names after ``prefix``; documents are read once and not moved."""
    chosen = chosen.withColumnsRenamed({c: prefix + c for c in chosen.columns})
    joined = docs.join(F.broadcast(chosen), docs["source"].cast("string").eqNullSafe(chosen[f"{prefix}s"]))  # at most ``max_sources`` rows
    more = F.when(_bits(docs["doc_id"], utf8_crc32(docs["text"])) < F.col(f"{prefix}below"), 1).otherwise(0)
    return joined.withColumn(f"{prefix}copies", F.col(f"{prefix}whole") + more)


def mix(docs: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0, max_sources: int = MAX_SOURCES) -> DataFrame:
    """How often each row of ``docs(doc_id, source, text, ...)`` is taken.

    Returns doc_id, source, size (words), source_size, target (its source's words), copies,
    taken (size * copies).  Sources by code point, null last, weigh ``weights`` in turn and
    share ``share`` times all words; none gets more than ``most`` times its size.

    Null text has size 0; a null source is a source; repeated rows of one doc_id share a hash
    and are taken alike; words of texts of any length are all counted; an empty table gives an
    empty result; other columns are ignored.
    """
    docs = docs.select("doc_id", "source", "text")
    out = with_copies(docs, plan(docs, weights, share, most, max_sources), "__").withColumn("__size", n_words(F.col("text")))
    return out.select(
        "doc_id", "source", F.col("__size").alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"),
        F.col("__copies").alias("copies"), (F.col("__size") * F.col("__copies")).alias("taken"),
    )


def mixed_rows(docs: DataFrame, **how) -> DataFrame:
    """The mixture itself: each row of ``docs`` as often as ``mix`` takes it, with the same columns."""
    prefix = free_prefix(docs)
    copies = F.col(f"{prefix}copies")
    rows = with_copies(docs, plan(docs, **how), prefix).where(copies > 0)
    return rows.withColumn(f"{prefix}copy", F.explode(F.sequence(F.lit(1), copies))).select(*[rows[c] for c in docs.columns])


def op9_mix_sources(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")
