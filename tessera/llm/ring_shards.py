"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Keys hash to ``cells`` equal arcs of the ring.  One pass sums bytes and rows by cell, so the
state that the ring walk needs has a fixed size however many documents there are.  A cell
goes to the first virtual node clockwise whose shard still has room below
``(1 + slack) * mean``; cells that meet a full shard continue clockwise.  Large cells arrive
first, so small ones even out what is left and every shard ends close to the mean.

Rows of one key (repeated ids, or no id and one text) fall into one cell.  They are counted
before anything else, and a cell of more than SPLIT times the mean is split by row: its parts
have places of their own on the ring, so that no key makes a shard heavy.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .textcols import utf8_crc32, whole

CELLS = 65_536
VNODES = 64
SLACK = 0.0001
SPLIT = 4
#: Equal rows that one task makes at most.
COPIES = 100_000


def _point(label: str) -> int:
    return int.from_bytes(hashlib.blake2b(label.encode(), digest_size=8).digest(), "big")


def ring(shards: int, vnodes: int = VNODES, cells: int = CELLS) -> tuple[np.ndarray, np.ndarray]:
    """(first cell of each virtual node's position, its shard), clockwise."""
    points = sorted((_point(f"{s}/{v}") * cells >> 64, s, v) for s in range(shards) for v in range(vnodes))
    return np.array([p[0] for p in points]), np.array([p[1] for p in points])


def place(cell: int, part: int, cells: int = CELLS) -> int:
    """Where a part of a cell is on the ring; the first is where the cell is."""
    return cell if part == 0 else _point(f"{cell}.{part}") * cells >> 64


def capacity(sizes, shards: int, slack: float = SLACK) -> int:
    """Bytes a shard may hold: a bit above the mean, without cells so large that each fills a shard of its own."""
    left, n = sum(sizes), shards
    for size in sorted(sizes, reverse=True)[: shards - 1]:
        if size * n <= left:
            break
        left, n = left - size, n - 1
    return -(-int(left * (1 + slack)) // n)


def assign_cells(cell_bytes: dict[tuple[int, int], int], shards: int, vnodes: int = VNODES, cells: int = CELLS, slack: float = SLACK) -> dict[tuple[int, int], int]:
    """Shard of each (cell, part).  Deterministic: largest first, then by number."""
    at, owner = ring(shards, vnodes, cells)
    room = np.full(shards, capacity(cell_bytes.values(), shards, slack), dtype=np.int64)
    out = {}
    for cell, size in sorted(cell_bytes.items(), key=lambda x: (-x[1], x[0])):
        home = int(np.searchsorted(at, place(*cell, cells))) % len(at)
        shard = int(owner[home])
        if room[shard] < size:
            walk = np.roll(owner, -home)
            fits = room[walk] >= size
            # where no shard has room for a whole cell, the emptiest takes it
            shard = int(walk[np.argmax(fits)]) if fits.any() else int(walk[np.argmax(room[walk])])
        room[shard] -= size
        out[cell] = shard
    return out


def _each_copy(counted: DataFrame, most: int = COPIES) -> DataFrame:
    """A row, numbered from 1 as ``copy``, for each of ``copies``; more than ``most`` of one row are made by several tasks."""
    few = counted.where(F.col("copies") <= most).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    runs = counted.where(F.col("copies") > most).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("copies") - 1) / most))))
    tasks = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # stated, as so few rows would else be put together
    runs = runs.repartition(tasks, "doc_id", "text_crc32", "size", "run")
    many = runs.withColumn("copy", F.explode(F.sequence(F.col("run") * most + 1, F.least("copies", (F.col("run") + 1) * most))))
    return few.unionByName(many.drop("run"))


def shard(docs: DataFrame, shards: int, vnodes: int = VNODES, cells: int = CELLS, slack: float = SLACK) -> DataFrame:
    """Shard and slot of every row of ``docs(doc_id, text, ...)``.

    Returns doc_id, size (UTF-8 bytes + 16), text_crc32, law ('bytes'), shard, slot,
    grown_shard (null: this law does not promise it).  Slots are gapless from 0 in a shard.

    Null text has size 16; a null doc_id is placed by its text's checksum; repeated rows are
    counted, dealt over the parts of their cell and get slots of their own; a text of any
    length is one row and never split; an empty table gives an empty result; other columns
    are ignored.  Shards differ by less than ``slack``, the largest row or SPLIT mean cells,
    whichever is more.
    """
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"], (F.octet_length(whole(docs["text"])) + 16).cast("long").alias("size"), utf8_crc32(docs["text"]).alias("text_crc32"))
    counted = stage(rows.groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("copies")), "ring")
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("long"), F.col("text_crc32")))
    counted = counted.withColumn("cell", F.pmod(key, F.lit(cells)).cast("int"))
    loads = counted.groupBy("cell").agg(F.sum(F.col("size") * F.col("copies")).alias("b"))
    mean = (loads.agg(F.sum("b")).first()[0] or 0) / cells
    heavy = loads.select("cell", F.ceil(F.col("b") / F.lit(SPLIT * mean or 1.0)).cast("int").alias("parts")).where("parts > 1")
    heavy = stage(heavy, "heavy")  # at most cells / SPLIT rows
    each = _each_copy(counted.join(F.broadcast(heavy), "cell", "left"))
    part = F.pmod(F.xxhash64("doc_id", "text_crc32", "size", "copy"), F.coalesce("parts", F.lit(1))).cast("int")
    placed = each.select("doc_id", "size", "text_crc32", "copy", "cell", part.alias("part"))
    sums = placed.groupBy("cell", "part").agg(F.sum("size").alias("b"), F.count(F.lit(1)).alias("n")).collect()  # at most (1 + 1 / SPLIT) * cells rows
    to = assign_cells({(r["cell"], r["part"]): r["b"] for r in sums}, shards, vnodes, cells, slack)
    first, where = [0] * shards, []
    for r in sorted(sums, key=lambda r: (r["cell"], r["part"])):
        s = to[r["cell"], r["part"]]
        where.append((r["cell"], r["part"], s, first[s]))
        first[s] += r["n"]
    where = spark.createDataFrame(where, "cell int, part int, shard int, first long")
    in_part = F.row_number().over(Window.partitionBy("cell", "part").orderBy("doc_id", "text_crc32", "size", "copy")) - 1
    return (
        placed.withColumn("k", in_part)
        .join(F.broadcast(where), ["cell", "part"])  # as many rows, of 20 bytes
        .select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("first") + F.col("k")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    )


def op4_ring_shards(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    return shard(table(spark, sf_dir, "documents"), 40)
