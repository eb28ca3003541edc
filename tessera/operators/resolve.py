"""Entity resolution: phones of shops, matches through unique keys, look-alike records, merges by source."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.phones import fone_chave, telefone_e164
from ..functions.similarity import jaro_winkler_similarity, letter_sketch, may_reach
from ..functions.text import comparable, slug, so_digitos
from ..staging import stage


def first_two(rows: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """key with its first two distinct values by first position, as columns first and second."""
    kept = rows.where(F.col(value).isNotNull()).groupBy(key, value).agg(F.min(order).alias(order))
    ranked = kept.withColumn("pos", F.row_number().over(Window.partitionBy(key).orderBy(order, value))).where("pos <= 2")
    return ranked.groupBy(key).agg(F.max(F.when(F.col("pos") == 1, F.col(value))).alias("first"), F.max(F.when(F.col("pos") == 2, F.col(value))).alias("second"))


def phones_of_posts(posts: DataFrame) -> DataFrame:
    """The first two valid phones of each shop's '|' list (its first ten entries)."""
    parts = posts.where(F.coalesce("telefones", F.lit("")) != "").select("posto_id", F.posexplode(F.split("telefones", "[|]")).alias("i", "raw")).where("i < 10")
    d = so_digitos("raw")
    rows = parts.select("posto_id", "i", telefone_e164(F.substring(d, 1, 2), F.substring(d, 3, 100)).alias("e164"))
    return first_two(rows, "posto_id", "i", "e164").select("posto_id", F.col("first").alias("telefone"), F.col("second").alias("telefone_2"))


def phone_keys(rows: DataFrame, key: str) -> DataFrame:
    """Distinct (key, chave) of both phone columns, in the form with the ninth digit."""
    both = F.explode(F.array("telefone", "telefone_2"))
    return rows.select(key, both.alias("fone")).where("fone is not null").select(key, fone_chave("fone").alias("chave")).distinct()


def match_unique(left: DataFrame, right: DataFrame, left_id: str, right_id: str, key: str) -> DataFrame:
    """left_id -> right_id where a key belongs to exactly one right id and all of the left's keys agree on it."""
    owner = right.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(right_id).alias(right_id), F.count_distinct(right_id).alias("n")).where("n = 1").drop("n")
    hits = left.join(owner, key)
    return hits.groupBy(left_id).agg(F.min(right_id).alias(right_id), F.count_distinct(right_id).alias("n")).where("n = 1").drop("n")


def company_of_posts(post_phones: DataFrame, target: DataFrame) -> DataFrame:
    return match_unique(phone_keys(post_phones, "posto_id"), phone_keys(target, "id"), "posto_id", "id", "chave")


#: Distinct texts of one block that meet in one task.
TILE = 4_096


def similar_in_block(rows: DataFrame, block: list[str], id_col: str, text: str, least: float = 0.9, tile: int = TILE) -> DataFrame:
    """Ids with a look-alike of Jaro-Winkler ``least`` or more inside the same block.

    Equal texts need no comparison: they are similar as they are, so a block's copies count
    once, by distinct text.  A block of more than ``tile`` texts is cut into parts that meet two by
    two, each pair of parts in a task of its own.  Pairs pass lossless bounds over whole numbers
    (``may_reach``) before the vectorised measure sees them, each pair once.
    """
    base = rows.select(id_col, text, *block).where(" and ".join(f"`{c}` is not null" for c in (text, *block)))
    texts = base.groupBy(*block, text).agg(F.count_distinct(id_col).alias("ids"))
    sketched = stage(texts.withColumn("_s", letter_sketch(text)), "sketches")
    sizes = sketched.groupBy(*block).agg(F.count(F.lit(1)).alias("_n"))
    if (sizes.agg(F.max("_n")).first()[0] or 0) <= tile:
        side, keys = sketched, block
        once = F.col(f"a.{text}") < F.col(f"b.{text}")
    else:
        cut = sketched.join(sizes.select(*block, F.ceil(F.col("_n") / tile).cast("int").alias("_parts")), block)
        cut = cut.withColumn("_i", F.pmod(F.xxhash64(text), F.col("_parts")).cast("int"))
        # part i meets itself and every other: (i, j) with i <= j
        dealt = cut.withColumn("_j", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
        side, keys = dealt.select("*", F.least("_i", "_j").alias("_lo"), F.greatest("_i", "_j").alias("_hi")), [*block, "_lo", "_hi"]
        # inside a part by the order of the texts, between two parts from the lower to the higher
        once = F.when(F.col("a._lo") == F.col("a._hi"), F.col(f"a.{text}") < F.col(f"b.{text}")).otherwise(F.col("a._i") < F.col("b._i"))
    a, b = side.alias("a"), side.alias("b")
    met = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in keys]
    pairs = a.join(b, reduce(and_, [*met, may_reach(F.col("a._s"), F.col("b._s"), least), once]))
    pairs = pairs.select(*[F.col(f"a.{c}") for c in block], F.col(f"a.{text}").alias("x"), F.col(f"b.{text}").alias("y"))
    close = pairs.where(jaro_winkler_similarity("x", "y") >= least)
    alike = close.select(*block, F.explode(F.array("x", "y")).alias(text)).unionByName(sketched.where(f"ids > 1 and `{text}` <> ''").select(*block, text)).distinct()
    return base.join(alike, [*block, text], "left_semi").select(id_col).distinct()


def look_alike_keys(target: DataFrame) -> DataFrame:
    """What the look-alike search needs of the wide rows: id, exact address, comparable name."""
    return target.where("nome is not null and cep is not null and logradouro is not null").select(
        "id", "uf", "municipio_slug", "cep", slug("logradouro").alias("lg"), F.upper(F.coalesce("numero", F.lit(""))).alias("num"), slug("nome").alias("nm")
    )


def suspected_duplicates(keys: DataFrame, least: float = 0.9) -> DataFrame:
    """Ids at one exact address with a look-alike name, of ``look_alike_keys``."""
    return similar_in_block(keys, ["uf", "municipio_slug", "cep", "lg", "num"], "id", "nm", least)


def flag(rows: DataFrame, ids: DataFrame, id_col: str, name: str) -> DataFrame:
    """A boolean column: is the row's id among ``ids``?"""
    marked = ids.select(F.col(id_col).alias("__id")).distinct().withColumn("__hit", F.lit(True))
    return rows.join(marked, rows[id_col] == marked["__id"], "left").withColumn(name, F.coalesce("__hit", F.lit(False))).drop("__id", "__hit")


def refresh(old: DataFrame, new: DataFrame, source: str = "fonte") -> DataFrame:
    """``new`` replaces its own sources' rows; other sources keep theirs."""
    return old.join(new.select(source).distinct(), source, "left_anti").select(*new.columns).unionByName(new)


def stable_posts(posts: DataFrame) -> DataFrame:
    """First row by (fonte, posto_id), sorted by source, state, comparable city and name, id."""
    w = Window.partitionBy("fonte", "posto_id").orderBy(*[F.asc_nulls_last(c) for c in posts.columns])
    one = posts.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")
    return one.orderBy("fonte", "uf_fonte", comparable("cidade_fonte"), comparable("nome"), "posto_id")
