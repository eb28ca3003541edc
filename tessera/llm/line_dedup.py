"""Line dedup: lines whose key many documents have are dropped everywhere.

Texts are exploded into the distinct keys of their lines, each with the places where it
stands; a key is then its 128-bit hash.  Spark counts distinct documents by key and keeps the
frequent keys.  Which places a text loses depends on the text alone, so the hits of a text
are gathered once by its hash, however many copies it has, joined to the documents, and the
other lines are put together again in order.

Texts are moved once, for that join; everything before it is narrow.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .arrowio import bounded_batches, pieces
from .textcols import whole

_WS = b" \t\n\x0b\x0c\r"


def line_keys(text: str) -> list[bytes]:
    """The key of every line: white space of the ASCII kinds stripped, A-Z in lower case."""
    return [line.strip(_WS) for line in text.encode().lower().split(b"\n")]  # bytes.lower changes A-Z only


def _places(text: str, least: int) -> dict[bytes, list[int]]:
    places: dict[bytes, list[int]] = {}
    for i, key in enumerate(line_keys(text)):
        places.setdefault(key, []).append(i)
    # a key's code points are its bytes that do not continue one
    return {k: v for k, v in places.items() if len(k) >= least and sum(b & 0xC0 != 0x80 for b in k[: 4 * least]) >= least}


def key_places(docs: DataFrame, least: int = 1) -> DataFrame:
    """One row per document and distinct key of at least ``least`` code points: doc_id, text_id, key (128-bit hashes), at (its lines)."""
    rows = docs.select(docs["doc_id"], whole(docs["text"]).alias("text"))

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 1):
                row, texts, keys, at, n = [], [], [], [], []
                for i, text in enumerate(part.column(1).to_pylist()):
                    text_id = hashlib.md5(text.encode()).digest()
                    for key, places in _places(text, least).items():
                        row.append(i)
                        texts.append(text_id)
                        keys.append(hashlib.md5(key).digest())
                        at.extend(places)
                        n.append(len(places))
                starts = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
                ids = part.column(0).take(pa.array(row, pa.int64()))
                lists = pa.ListArray.from_arrays(starts, pa.array(at, pa.int32()))
                yield pa.RecordBatch.from_arrays([ids, pa.array(texts, pa.binary()), pa.array(keys, pa.binary()), lists], ["doc_id", "text_id", "key", "at"])

    return bounded_batches(rows).mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text_id binary, key binary, at array<int>")


def frequent_keys(places: DataFrame, documents: int) -> DataFrame:
    """Keys that at least so many documents have; rows without doc_id are a document each."""
    named = places.where(F.col("doc_id").isNotNull()).select("key", "doc_id").distinct().select("key")
    nameless = places.where(F.col("doc_id").isNull()).select("key")
    return named.unionAll(nameless).groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= documents).select("key")


def lost_lines(places: DataFrame, documents: int) -> DataFrame:
    """text_id and the sorted lines it loses, for texts that lose any."""
    hits = places.groupBy("text_id", "key").agg(F.first("at").alias("at"))  # copies of a text have the same places
    hits = hits.join(frequent_keys(places, documents), "key", "left_semi")
    return hits.groupBy("text_id").agg(F.array_sort(F.flatten(F.collect_list("at"))).alias("lost"))  # no more than the text has lines


def dedup_lines(docs: DataFrame, documents: int = 10, least: int = 1) -> DataFrame:
    """``docs(doc_id, text, ...)`` without the lines whose key at least ``documents`` documents have.

    Returns one row per input row: doc_id, n_lines (before), n_dropped, kept (the other lines,
    joined by a line feed).  Lines end at a line feed only.  A key is the line without white
    space at its ends and with A-Z in lower case; keys of fewer than ``least`` code points stay.

    * Null text counts as empty; an empty text has one empty line.
    * Documents are told apart by doc_id: rows that share one count once for a key.  Rows
      without doc_id are a document each.  All rows of a dropped key lose it, repeated ones too.
    * A key exactly at the threshold is dropped; a text that loses all lines is kept as ''.
    * A text of any length is done whole, by the task that holds its row.  An empty table
      gives an empty result; other columns are ignored.
    """
    rows = docs.select(docs["doc_id"], whole(docs["text"]).alias("text"))
    lost = lost_lines(stage(key_places(rows, least), "lines"), documents)
    joined = rows.withColumn("text_id", F.unhex(F.md5(F.col("text").cast("binary")))).join(lost, "text_id", "left").select("doc_id", "text", "lost")

    def run(batches):
        for batch in batches:
            for part in pieces(batch, 1):
                total, dropped, kept = [], [], []
                for text, gone in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    total.append(text.count("\n") + 1)
                    dropped.append(len(gone or ()))
                    if gone:
                        stays = np.ones(total[-1], bool)
                        stays[gone] = False
                        lines = text.split("\n")
                        text = "\n".join([lines[i] for i in np.flatnonzero(stays)])
                    kept.append(text)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(total, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_lines", "n_dropped", "kept"])

    return bounded_batches(joined).mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, n_lines long, n_dropped long, kept string")


def op12_line_dedup(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    out = dedup_lines(table(spark, sf_dir, "documents"), documents=10, least=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT rid, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS no FROM d),
k AS (
  SELECT rid, doc_id, line, no,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'row ' || rid)) >= 10),
m AS (SELECT k.*, f.key IS NOT NULL AS gone FROM k LEFT JOIN f ON f.key = k.key)
SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY rid
"""
