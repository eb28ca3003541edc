"""A corpus pipeline of five operators: classify, deduplicate, deduplicate nearly, mix, encode.

Each stage is a function of (spark, docs, sf_dir).  All but the last return the columns of
``documents``; the runner writes each result as Parquet and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, exact_dedup, mixing, ngram_join, rule_ensemble
from tessera.llm.textcols import free_prefix, whole
from tessera.staging import new_path, remove, stage, temporary_tables
from tessera.tables import table

#: Keys of rows to drop that are broadcast at most: 200,000 of about 100 bytes.
MOST_SENT = 200_000


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts (score of 0.5 or more).

    Null and empty texts are scored by the statistics of an empty text, texts of any length
    are read whole; a score of exactly 0.5 stays; repeated rows are decided alike; rows
    without doc_id are scored, but never learned from; without labels every row stays; an
    empty table stays empty; other columns of any name come through.
    """
    labels = table(spark, sf_dir, "labels").where(~rule_ensemble.in_split(F.col("doc_id"), 3, 1))
    model = rule_ensemble.train(docs, labels)
    name = f"{free_prefix(docs)}stats"
    return rule_ensemble.with_stats(docs, name).where(model.column_of(name) >= 0.5).drop(name)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, white space aside.

    Null counts as empty, so that one of all null, empty and white texts stays; the text with
    most code points stays, of ties the smallest doc_id; of repeated rows with an id the least
    by their other columns stays; rows without doc_id stay only where no row of their text has one, then all of them;
    texts of any length are compared whole; an empty table stays empty; other columns of any
    name come through.
    """
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row, that of the smallest id, of each component of near copies.

    Rows are told apart by doc_id and text: of texts that share the smallest id one stays, and
    of its repeated rows the least by their other columns.  A row without doc_id stays only in a component without any id.
    Rows without a shingle (null, empty and white texts) all stay.  Texts of any length are
    compared whole; an empty table stays empty; other columns of any name come through.
    """
    found = ngram_join.near_survivors(docs)
    # rows of a key that are to go, or all but one of them
    keys = found.groupBy(F.col("doc_id").alias("__lost"), F.col("sha").alias("__sha")).agg(F.min("kept").alias("__stays"), F.count(F.lit(1)).alias("__rows"))
    keys = stage(keys.where("not __stays or __rows > 1").drop("__rows"), "lost")
    # so few keys go to the texts; with more of them both sides are dealt by key
    sent = F.broadcast if keys.count() <= MOST_SENT else lambda some: some
    this = f"{free_prefix(docs)}sha"
    rows = docs.withColumn(this, F.unhex(F.sha2(whole(docs["text"]).cast("binary"), 256)))
    same = lambda some: rows["doc_id"].cast("long").eqNullSafe(some["__lost"]) & (rows[this] == some["__sha"])
    repeated = keys.where("__stays")
    once = exact_dedup.least_rows(rows.join(sent(repeated), same(repeated), "left_semi"), ["doc_id", this])
    return rows.join(sent(keys), same(keys), "left_anti").unionByName(once).drop(this)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's target asks for: not at all, once or twice.

    A null source is a source; a null or empty text has no words and goes with its hash; rows
    without doc_id are hashed by their text's checksum; repeated rows are taken alike; texts of
    any length are counted whole; an empty table stays empty; other columns of any name come
    through.
    """
    return mixing.mixed_rows(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (little-endian unsigned 32-bit), and digests of them and of what they decode to.

    Null and empty texts have no ids; a null doc_id stays null; repeated rows give a row each;
    texts of any length are encoded whole; an empty table gives an empty result.
    """
    return bpe.with_digests(bpe.encode_documents(docs, *bpe.multi_50k()))


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("encode", encode)]

#: The classifier, the mixture's hashes and the encoder are beyond SQL; tests hold each stage to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage has staged for itself, and its input, are removed once its result is written.

    The last stage is lazy: its input goes with the scope that ``run`` is called in, or with
    ``staging.release`` of the registered query's result.
    """
    docs, before = table(spark, sf_dir, "documents"), None
    for name, step in STAGES[:-1]:
        path = new_path(spark, name)
        with temporary_tables(spark):
            step(spark, docs, sf_dir).write.parquet(path)
        if before:
            remove(spark, before)
        docs, before = spark.read.schema(docs.schema).parquet(path), path
    return STAGES[-1][1](spark, docs, sf_dir)
