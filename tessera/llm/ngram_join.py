"""Exact n-gram Jaccard join by multiple-global-order prefix filtering.

Two sets of word shingles link when 100 * |A & B| >= 80 * |A | B|.  The steps:

1. Every document becomes a set (``shingles``); documents with equal sets are one class,
   named by a 64-bit digest and the set's size, so groups of copies cost one set a task.
2. Shingles are dealt by their leading bits, into buckets whose number grows with the data,
   and counted over the whole corpus.  A shingle of one set only can link nothing: all others
   go back to their sets, with their frequency.  As a shared shingle is never of one set only,
   these reduced sets still hold every intersection.
3. Several global orders: by frequency, rarest first, ties broken by a different hash each.
   In each order the first |A| - ceil(0.8 |A|) + 1 shingles of two linked sets share one.
   Common passages come last in all of them; which of the rarer passages come first differs.
4. Sets that share a prefix shingle of the first order are tied together into blocks (one tie
   to another holder of the shingle, never all pairs).  Every link lies within a block.
5. In a tile of sets a candidate must share a prefix shingle in *every* order and fit in
   length; then its intersection is counted.  Sets already known to be connected are not
   compared again.  Small blocks share tiles.  A large block is cut into tiles whose leaders
   meet in further rounds, which connects near copies.  Then what is outside the largest
   component meets the rest: tile by tile in blocks of a few tiles, in wider ones by a join on
   the prefix shingles of the first order, those with many holders together with the second's;
   what passes the filters of all orders is tied into smaller blocks that are verified.
6. Links become components; a component's name is its smallest doc_id.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .arrowio import bounded_batches, pieces
from .components import Forest, components, edge_batches
from .shingles import mix, sets_of
from .textcols import whole

PERCENT = 80
ORDERS = 2
TILE = 512
LEADERS = 8
GROUP = 2048
WIDE = 16  # tiles a side up to which a large block goes tile by tile
_FLUSH = 1 << 19  # shingles that a task holds before it sends them
_SEEN, _TIED = 1 << 19, 1 << 20  # sets that a task remembers to have sent, shingles that it ties before it sends them
_BUCKET, _PARTITION = 1 << 18, 1 << 20  # shingles of a bucket, and of a partition of buckets
_MASS = 1 << 21  # shingles of a tile or group
_SALT = [np.uint64(0x9E3779B97F4A7C15 * (2 * k + 1) & (2**64 - 1)) for k in range(8)]


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Shingles of a set of n of which any set that links with it has one."""
    return n - -(-percent * n // 100) + 1 if n else 0


def set_key(s: np.ndarray) -> int:
    return int.from_bytes(xxhash.xxh3_64_digest(s.tobytes()), "big", signed=True)


# ---------------------------------------------------------------- sets and frequencies


def classes(docs: DataFrame, digests: bool = False) -> DataFrame:
    """doc_id, n_shingles, id (name of its set), if asked sha (of the text) of every row of ``docs(doc_id, text, ...)``; an empty set has no name."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole(docs["text"]).alias("text"))

    def run(batches):
        for batch in batches:
            for b in pieces(batch, 1, 1 << 20):
                texts = b.column(1).to_pylist()
                sets = sets_of(texts)
                columns = {"doc_id": b.column(0), "n_shingles": pa.array([len(s) for s in sets], pa.int64()), "id": pa.array([set_id(set_key(s), len(s)) if len(s) else None for s in sets], pa.binary())}
                if digests:
                    columns["sha"] = pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest() for t in texts], pa.binary())
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))

    return bounded_batches(rows).mapInArrow(run, "doc_id long, n_shingles long, id binary" + (", sha binary" if digests else ""))


_SETS = 60_000  # sets of one flush: their numbers fit in 16 bits
_HOT = 8  # holders in a flush beyond which a shingle's holders stay with the flush


def _low_bytes(x: np.ndarray, n: int) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n]).tobytes()


def _from_low(raw: bytes, n: int) -> np.ndarray:
    out = np.zeros((len(raw) // n, 8), np.uint8)
    out[:, :n] = np.frombuffer(raw, np.uint8).reshape(-1, n)
    return out.view("<u8").ravel()


def _u8(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8)


def bucket_bits(tokens: int) -> int:
    """Leading bits of a shingle that name its bucket: about _BUCKET shingles each, however many there are."""
    return max(1, (tokens // _BUCKET).bit_length())


def _width(bits: int) -> int:
    """Bytes that hold the rest of a shingle: bucket and rest are all of its 64 bits."""
    return -(-(64 - bits) // 8)


_CELL = ["bucket", "flush", "tokens", "held", "sets", "many", "often", "keys", "sizes"]
_CELL_KINDS = [pa.int32(), pa.int64(), *[pa.binary()] * 7]
_PACKED = "bucket int, flush long, tokens binary, held binary, sets binary, many binary, often binary, keys binary, sizes binary"


def _cells(rows: list[dict]) -> list[pa.Array]:
    return [pa.array([r.get(c) for r in rows], k) for c, k in zip(_CELL, _CELL_KINDS)]


def _packed_tokens(docs: DataFrame, bits: int) -> DataFrame:
    """All shingles of all sets, packed: a row for each bucket and flush of a task.

    A task sends a set once for as many as it remembers (_SEEN).  A row has the flush's distinct shingles of a bucket, how many
    sets hold each (``held``) and which (``sets``, numbers within the flush).  Of a shingle
    with more than _HOT holders only their number goes (held is 0, ``many`` has it), so that
    a passage of all documents costs one entry a flush; its holders, like the keys and sizes
    of the sets, wait in the flush's own row.
    """
    rows = docs.select(whole(docs["text"]).alias("text"))
    width, shift = _width(bits), np.uint64(64 - bits)

    def flushed(sets, keys, no):
        token = np.concatenate(sets)
        owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets]).astype("<u2")
        order = np.argsort(token, kind="stable")
        token, owner = token[order], owner[order]
        first = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        count = np.diff(np.append(first, len(token)))
        one, hot = token[first], count > _HOT
        key, size = np.array(keys, "<i8").tobytes(), np.array([len(s) for s in sets], "<u4").tobytes()
        flush = int.from_bytes(xxhash.xxh3_64_digest(key + size + repr(no).encode()), "big", signed=True)
        mine = np.repeat(hot, count)
        out = [{"bucket": flush & ((1 << bits) - 1), "flush": flush, "keys": key, "sizes": size,
                "tokens": one[hot].tobytes(), "many": count[hot].astype("<u4").tobytes(), "sets": owner[mine].tobytes()}]
        held, sent = np.where(hot, 0, count).astype(np.uint8), owner[~mine]
        upto, many = np.concatenate([[0], np.cumsum(held, dtype=np.int64)]), count.astype("<u4")
        bucket = (one >> shift).astype(np.int64)
        starts = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(one)).tolist()):
            out.append({"bucket": int(bucket[a]), "flush": flush, "tokens": _low_bytes(one[a:b], width), "held": held[a:b].tobytes(),
                        "sets": sent[upto[a] : upto[b]].tobytes(), "many": many[a:b][hot[a:b]].tobytes()})
        return pa.RecordBatch.from_arrays(_cells(out), _CELL)

    def run(batches):
        task, seen, sets, keys, held, no = TaskContext.get().partitionId(), set(), [], [], 0, 0
        for batch in batches:
            for b in pieces(batch, 0, 1 << 20):
                for s in sets_of(b.column(0).to_pylist()):
                    if len(s) and (k := (set_key(s), len(s))) not in seen:
                        if len(seen) >= _SEEN:  # a set sent twice is as one that two tasks have
                            seen.clear()
                        seen.add(k)
                        sets.append(s)
                        keys.append(k[0])
                        held += len(s)
                        if held >= _FLUSH or len(sets) >= _SETS:
                            yield flushed(sets, keys, (task, no))
                            sets, keys, held, no = [], [], 0, no + 1
        if sets:
            yield flushed(sets, keys, (task, no))

    return bounded_batches(rows).mapInArrow(run, _PACKED)


def _shared_tokens(packed: DataFrame, bits: int) -> DataFrame:
    """Of each bucket the shingles of two sets or more, with their frequency, packed by flush."""
    width = _width(bits)

    def run(table: pa.Table) -> pa.Table:
        is_name = np.asarray(table.column("keys").is_valid())
        names = table.filter(pa.array(is_name))
        cells = table.filter(pa.array(~is_name)).select(["flush", "tokens", "held", "sets", "many"]).to_pylist()
        out: list[dict] = []
        if cells:
            bucket = table.column("bucket")[0].as_py()
            tokens = [_from_low(c["tokens"], width) for c in cells]
            held = [_u8(c["held"]) for c in cells]
            counts = []
            for h, c in zip(held, cells):
                n = h.astype(np.int64)
                n[h == 0] = np.frombuffer(c["many"], "<u4")
                counts.append(n)
            every = np.concatenate(tokens)
            order = np.argsort(every, kind="stable")
            ts = every[order]
            first = np.flatnonzero(np.concatenate([[True], ts[1:] != ts[:-1]]))
            total = np.add.reduceat(np.concatenate(counts)[order], first)
            often = np.empty(len(every), np.int64)
            often[order] = np.repeat(total, np.diff(np.append(first, len(ts))))
            at = 0
            for c, t, h in zip(cells, tokens, held):
                f = often[at : at + len(t)]
                at += len(t)
                keep = f > 1
                if keep.any():
                    sets = np.frombuffer(c["sets"], "<u2")[np.repeat(keep, h)]
                    out.append({"bucket": bucket, "flush": c["flush"], "tokens": _low_bytes(t[keep], width), "held": h[keep].tobytes(),
                                "sets": sets.tobytes(), "often": np.minimum(f[keep], 65535).astype("<u2").tobytes()})
        made = pa.Table.from_arrays(_cells(out), names=_CELL)
        return pa.concat_tables([made, names.select(_CELL).cast(made.schema)])

    return packed.groupBy("bucket").applyInArrow(run, _PACKED)


REDUCED = "id binary, n int, tokens binary, often binary, prefix_1 array<long>"


def set_id(key: int, n: int) -> bytes:
    """Name of a set: its digest and its size."""
    return key.to_bytes(8, "big", signed=True) + n.to_bytes(4, "big")


def _order(token: np.ndarray, often: np.ndarray, k: int) -> np.ndarray:
    """Positions of the shingles in global order k: rarest first, ties by the order's own hash.

    Orders after the first take frequencies by powers of two and deal each exact frequency its
    own place among them: the shingles of a passage, which are equally frequent, stay together,
    and another passage comes first than in the first order.
    """
    if k == 0:
        return np.lexsort((mix(token ^ _SALT[0]), often))
    return np.lexsort((mix(token ^ _SALT[k]), mix(often.astype(np.uint64) ^ _SALT[k]), np.frexp(often.astype(np.float64))[1]))


def prefix(token: np.ndarray, often: np.ndarray, n: int, k: int, percent: int) -> np.ndarray:
    """The shared shingles among the first of a set of n in order k; those of this set alone come before all."""
    take = prefix_length(n, percent) - (n - len(token))
    return token[_order(token, often, k)[: max(take, 0)]]


def reduced_sets(docs: DataFrame, tokens: int, percent: int = PERCENT) -> DataFrame:
    """A row per set (and flush that has it) with a shared shingle in its first prefix: its shared shingles and frequencies.

    ``tokens`` is the number of shingles of all rows: buckets and partitions keep their size,
    and their number grows with it.
    """
    bits, conf = bucket_bits(tokens), int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts, width = max(conf, -(-tokens // _PARTITION)), _width(bits)
    shared = _shared_tokens(_packed_tokens(docs, bits).repartition(parts, "bucket"), bits)

    def gather(table: pa.Table) -> pa.Table:  # one flush
        is_name = np.asarray(table.column("keys").is_valid())
        name = table.filter(pa.array(is_name)).to_pylist()[0]
        keys, sizes = np.frombuffer(name["keys"], "<i8"), np.frombuffer(name["sizes"], "<u4")
        hot, many = np.frombuffer(name["tokens"], np.uint64), np.frombuffer(name["many"], "<u4").astype(np.int64)
        upto, holders = np.concatenate([[0], np.cumsum(many)]), np.frombuffer(name["sets"], "<u2")
        owners, tokens, often = [], [], []
        for c in table.filter(pa.array(~is_name)).select(["bucket", "tokens", "held", "sets", "often"]).to_pylist():
            t = _from_low(c["tokens"], width) | (np.uint64(c["bucket"]) << np.uint64(64 - bits))
            h, f = _u8(c["held"]), np.frombuffer(c["often"], "<u2")
            owners.append(np.frombuffer(c["sets"], "<u2"))
            tokens.append(np.repeat(t, h))
            often.append(np.repeat(f, h))
            for one, freq in zip(t[h == 0], f[h == 0]):
                i = int(np.searchsorted(hot, one))
                owners.append(holders[upto[i] : upto[i + 1]])
                tokens.append(np.full(many[i], one))
                often.append(np.full(many[i], freq))
        out = {c: [] for c in ("id", "n", "tokens", "often", "prefix_1")}
        if owners:
            owner = np.concatenate(owners)
            order = np.argsort(owner, kind="stable")
            token, count = np.concatenate(tokens)[order], np.concatenate(often)[order]
            who, first = np.unique(owner[order], return_index=True)
            for i, a, b in zip(who.tolist(), first, np.append(first[1:], len(order))):
                n = int(sizes[i])
                t, f = token[a:b], count[a:b]
                p = prefix(t, f, n, 0, percent)
                if len(p):
                    for c, v in (("id", set_id(int(keys[i]), n)), ("n", n), ("tokens", t.tobytes()), ("often", f.astype("<u2").tobytes()), ("prefix_1", p.view(np.int64))):
                        out[c].append(v)
        kinds = [pa.binary(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int64())]
        return pa.table([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    return shared.repartition(parts, "flush").groupBy("flush").applyInArrow(gather, REDUCED)


def blocks_of(sets: DataFrame) -> DataFrame:
    """(id, component, size) of the sets that a shared first-prefix shingle ties to another, directly or not.

    A task first ties its own sets, up to _TIED shingles at a time; of each shingle only one of
    them goes on, so a common shingle sends few rows a task.  Then equal shingles meet and are
    tied in one ordered pass.
    """
    rows = sets.select("id", "prefix_1")

    def mine(batches):
        forest, holder = Forest(), {}
        for b in batches:
            for i, tokens in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for t in tokens:
                    if (other := holder.setdefault(t, i)) != i:
                        forest.join(other, i)
                if len(holder) >= _TIED:
                    yield from sent(forest, holder)
                    forest, holder = Forest(), {}
        yield from sent(forest, holder)

    def sent(forest, holder):
        pairs = list(holder.items())
        for u, v in forest.edges():  # a tie goes on as a shingle of its own
            t = int.from_bytes(xxhash.xxh3_64_digest(u + v + b"tie"), "big", signed=True)
            pairs += [(t, u), (t, v)]
        for a in range(0, len(pairs), 1 << 16):
            t, i = zip(*pairs[a : a + (1 << 16)])
            yield pa.RecordBatch.from_arrays([pa.array(t, pa.int64()), pa.array(i, pa.binary())], ["token", "id"])

    def tie(batches):
        forest, last, at = Forest(), None, None
        for b in batches:
            for t, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if t == last and i != at:
                    forest.join(at, i)
                last, at = t, i
        yield from edge_batches(forest.edges(), pa.binary())

    return components(rows.mapInArrow(mine, "token long, id binary").repartition("token").sortWithinPartitions("token").mapInArrow(tie, "u binary, v binary"))


# ---------------------------------------------------------------- tiles


class _Lists:
    """Inverted lists over the sets of a tile; counts how many of a query's shingles each set has."""

    def __init__(self, sets: list[np.ndarray]):
        self.m = len(sets)
        token = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
        owner = np.repeat(np.arange(self.m), [len(s) for s in sets])
        order = np.argsort(token, kind="stable")
        self.token, self.owner = token[order], owner[order]

    def count(self, query: np.ndarray) -> np.ndarray:
        a, b = np.searchsorted(self.token, query, "left"), np.searchsorted(self.token, query, "right")
        n = b - a
        total = int(n.sum())
        if not total:
            return np.zeros(self.m, np.int64)
        at = np.repeat(a - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(total)
        return np.bincount(self.owner[at], minlength=self.m)


def spanning_links(n: np.ndarray, tokens: list[np.ndarray], often: list[np.ndarray], group: np.ndarray, query: np.ndarray, percent: int = PERCENT, orders: int = ORDERS) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Links between sets of different groups that join all groups that any link joins.

    ``query`` marks the sets that are compared with all others.  Returns the links (positions)
    and the group of each set afterwards.
    """
    prefixes = [[prefix(t, f, int(k), o, percent) for t, f, k in zip(tokens, often, n)] for o in range(orders)]
    lists, full, links = [_Lists(p) for p in prefixes], _Lists(tokens), []
    group = group.copy()
    for x in np.flatnonzero(query):
        may = group != group[x]
        if not may.any():
            continue
        may &= (100 * np.minimum(n, n[x]) >= percent * np.maximum(n, n[x])) & (~query | (np.arange(len(n)) > x))
        for ls, p in zip(lists, prefixes):
            if not may.any():
                break
            may &= ls.count(p[x]) > 0
        if not may.any():
            continue
        common = full.count(tokens[x])
        for y in np.flatnonzero(may & (100 * common >= percent * (n + n[x] - common))):
            if group[y] != group[x]:
                links.append((int(x), int(y)))
                group[group == group[y]] = group[x]
    return links, group


_EDGE = "u binary, v binary"
_MEMBER = ["block", "id", "n", "tokens", "often"]


def _tile(table: pa.Table, percent: int, orders: int) -> tuple[list[tuple[int, int]], np.ndarray]:
    n = table.column("n").to_numpy().astype(np.int64)
    tokens = [np.frombuffer(x, np.uint64) for x in table.column("tokens").to_pylist()]
    often = [np.frombuffer(x, np.uint16) for x in table.column("often").to_pylist()]
    group, query = np.arange(len(n)), np.ones(len(n), bool)
    if "component" in table.column_names:
        group = _numbered(table.column("component"))
    if "query" in table.column_names:
        query = table.column("query").to_numpy(zero_copy_only=False)
    return spanning_links(n, tokens, often, group, query, percent, orders)


def _numbered(column) -> np.ndarray:
    return column.combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)


def _edges(table: pa.Table, links) -> pa.Table:
    ids = table.column("id").to_pylist()
    return pa.table([pa.array([ids[e[i]] for e in links], pa.binary()) for i in (0, 1)], names=["u", "v"])


def _small(members: DataFrame, bins: int, percent: int, orders: int) -> DataFrame:
    """Links within blocks that a tile can hold: whole blocks share bins."""

    def run(table: pa.Table) -> pa.Table:
        return _edges(table, _tile(table, percent, orders)[0])

    return members.withColumn("bin", F.pmod(F.xxhash64("block"), F.lit(bins))).drop("block").groupBy("bin").applyInArrow(run, _EDGE)


def _large(members: DataFrame, sizes: DataFrame, tile: int, percent: int, orders: int) -> DataFrame:
    """Links within blocks that exceed a tile; ``sizes`` has each block's sets and shingles.

    First near copies find each other: chunks of a block are joined, and a few leaders of what
    hangs together meet in further rounds, while these become fewer.  What then belongs to
    several components of a block goes through the prefix join of ``_across``.
    """

    def meet(table: pa.Table) -> pa.Table:
        links, group = _tile(table, percent, orders)
        order = np.argsort(group, kind="stable")
        g = group[order]
        rank = np.arange(len(g)) - np.searchsorted(g, g, side="left")
        lead = np.zeros(len(g), bool)
        lead[order] = rank < LEADERS
        e, rows = _edges(table, links), table.select(_MEMBER).filter(pa.array(lead))
        none = lambda t, like: [pa.nulls(len(t), f.type) for f in like.schema]
        return pa.concat_tables([pa.table([*e.columns, *none(e, rows)], names=["u", "v", *_MEMBER]), pa.table([*none(rows, e), *rows.columns], names=["u", "v", *_MEMBER])])

    links, level = None, members.join(sizes, "block")
    had = sizes.agg(F.sum("size")).first()[0]
    while True:
        chunks = F.ceil(F.greatest(F.col("size") / tile, F.col("mass") / _MASS))
        chunked = level.withColumn("chunk", F.pmod(F.xxhash64("id"), chunks))
        met = stage(chunked.groupBy("block", "chunk").applyInArrow(meet, _EDGE + ", block binary, id binary, n int, tokens binary, often binary"), "tiles")
        found = met.where("u is not null").select("u", "v")
        links = found if links is None else links.unionByName(found)
        leaders = met.where("u is null").select(*_MEMBER)
        sizes = stage(leaders.groupBy("block").agg(*_sizes()), "sizes")
        now, most = sizes.agg(F.sum("size"), F.max("size")).first()
        if most <= LEADERS or now > 0.7 * had:
            break  # one group a block, or leaders that no longer become fewer
        level, had = leaders.join(sizes, "block"), now
    part = components(links)
    known = members.join(part.select("id", "component"), "id", "left").select(*_MEMBER, F.coalesce("component", "id").alias("component"))
    known = stage(known, "known")
    parted = known.groupBy("block", "component").agg(*_sizes())
    blocks = parted.groupBy("block").agg(F.max(F.struct("size", "mass", "component")).alias("top"), F.sum("size").alias("all"), F.sum("mass").alias("all_mass"), F.count(F.lit(1)).alias("parts"))
    blocks = stage(blocks.where("parts > 1").select("block", F.col("top.component").alias("main"), *_tiles_a_side(tile)), "parts")
    narrow, wide = (blocks.where(x).count() for x in (F.col("b") <= WIDE, F.col("b") > WIDE))
    if narrow:
        links = links.unionByName(_outside(known.join(blocks.where(F.col("b") <= WIDE), "block"), percent, orders))
    if wide:
        links = links.unionByName(_across(known.join(blocks.where(F.col("b") > WIDE).select("block"), "block", "left_semi"), tile, percent, orders))
    return links


def _tiles_a_side(tile: int):
    """Tiles for what is outside the largest component (``a``) and for all (``b``), of the columns top, all and all_mass."""
    tiles = lambda size, mass: F.ceil(F.greatest(size / (tile // 2), mass / (_MASS // 2)))
    return tiles(F.col("all") - F.col("top.size"), F.col("all_mass") - F.col("top.mass")).alias("a"), tiles(F.col("all"), F.col("all_mass")).alias("b")


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows`` (id, component, main, a, b, ...) by tile (i, j), so that each set outside the main component meets every other."""
    rows = rows.withColumn("query", F.col("component") != F.col("main"))
    upto = lambda c: F.explode(F.sequence(F.lit(0).cast("long"), F.col(c) - 1))
    mine = rows.where("query").withColumn("i", F.pmod(F.xxhash64("id"), F.col("a"))).withColumn("j", upto("b"))
    # a query is also among the sets that other queries are compared with
    other = rows.withColumn("j", F.pmod(F.xxhash64("id", F.lit(1)), F.col("b"))).withColumn("i", upto("a")).withColumn("query", F.lit(False))
    return mine.unionByName(other).drop("main", "a", "b")


def _outside(rows: DataFrame, percent: int, orders: int) -> DataFrame:
    """Links of the sets outside their block's largest component, tile by tile."""

    def verify(table: pa.Table) -> pa.Table:
        return _edges(table, _tile(table, percent, orders)[0])

    return _dealt(rows).groupBy("block", "i", "j").applyInArrow(verify, _EDGE)


def _sizes():
    return F.count(F.lit(1)).alias("size"), F.sum("n").alias("mass")


# ---------------------------------------------------------------- across the components of a large block


def signature(tokens: np.ndarray, n: int) -> np.ndarray:
    """Parity of the number of shingles by hash, in about n bits: a power of two of 64-bit words."""
    words = 1 << min(11, max(2, int(n - 1).bit_length() - 6))
    at = (mix(tokens ^ _SALT[7]) & np.uint64(64 * words - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=64 * words) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8")


def _folded(sig: np.ndarray, words: int) -> np.ndarray:
    while len(sig) > words:
        sig = sig[: len(sig) // 2] ^ sig[len(sig) // 2 :]
    return sig


def plausible_links(n: np.ndarray, reduced: np.ndarray, sigs: list[np.ndarray], prefixes: list[list[np.ndarray]], group: np.ndarray, query: np.ndarray, percent: int = PERCENT) -> list[tuple[int, int]]:
    """Pairs that no filter rules out, enough of them to join all groups that any such pair joins.

    Of two sets the lengths must fit, the bits in which the signatures differ (each stands for
    a shingle that only one has) must leave enough shingles in common, and the prefixes must
    share a shingle in each of the given orders.
    """
    out, group = [], group.copy()
    words = np.array([len(x) for x in sigs])
    for w in np.unique(words):
        wide = np.flatnonzero(words >= w)
        m = np.stack([_folded(sigs[i], int(w)) for i in wide])
        nw, rw, qw, longer = n[wide], reduced[wide], query[wide], words[wide] > w
        for k in np.flatnonzero(~longer):
            x = int(wide[k])
            may = (group[wide] != group[x]) & (qw | qw[k]) & (longer | (np.arange(len(wide)) > k)) & (100 * np.minimum(nw, nw[k]) >= percent * np.maximum(nw, nw[k]))
            ys = np.flatnonzero(may)
            if not len(ys):
                continue
            apart = np.bitwise_count(m[ys] ^ m[k]).sum(1, dtype=np.int64)
            most = (rw[ys] + rw[k] - apart) // 2
            for y in wide[ys[100 * most >= percent * (nw[ys] + nw[k] - most)]].tolist():
                if group[x] != group[y] and all(len(np.intersect1d(p[x], p[y])) for p in prefixes):
                    out.append((x, y))
                    group[group == group[y]] = group[x]
    return out


_NARROW = "id binary, component binary, n int, reduced int, sig binary, first array<long>, second array<long>, others array<binary>"


def _narrowed(rows: DataFrame, percent: int, orders: int) -> DataFrame:
    """Of each set its prefixes and its signature."""

    def run(batches):
        for b in batches:
            out = []
            for i, c, n, t, f in zip(*(b.column(k).to_pylist() for k in ("id", "component", "n", "tokens", "often"))):
                t, f = np.frombuffer(t, np.uint64), np.frombuffer(f, np.uint16)
                p = [prefix(t, f, n, o, percent) for o in range(max(orders, 2))]
                out.append((i, c, n, len(t), signature(t, n).tobytes(), p[0].view(np.int64), p[1].view(np.int64), [x.tobytes() for x in p[2:]]))
            kinds = [pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)] if out else [pa.array([], k) for k in kinds], [x.split()[0] for x in _NARROW.split(", ")])

    return bounded_batches(rows.select("id", "component", "n", "tokens", "often")).mapInArrow(run, _NARROW)


def _meeting(rows: DataFrame) -> DataFrame:
    """(key, size, mass): shingles (or pairs of them) held by several components; of those with the same holders one."""
    held = rows.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), *_sizes(), F.bit_xor(F.xxhash64("id")).alias("d1"), F.bit_xor(F.xxhash64("id", F.lit(1))).alias("d2"))
    return held.where("lo < hi").groupBy("d1", "d2", "size", "mass").agg(F.min("key").alias("key")).select("key", "size", "mass")


def _across(rows: DataFrame, tile: int, percent: int, orders: int) -> DataFrame:
    """Links between the components of blocks that are too wide for tiles, by a join on prefix shingles.

    Sets meet by a shared prefix shingle of the first order; one with too many holders is
    split by the shingles of the second order; what is still too large is cut into tiles.
    There only prefixes and signatures meet.  The pairs that pass the filters of all orders
    tie sets together into far smaller blocks, and these are verified.
    """
    narrow = stage(_narrowed(rows, percent, orders), "narrow")
    fits = (F.col("size") <= GROUP) & (F.col("mass") <= _MASS)
    ties = narrow.select("id", "component", "n", F.explode("first").alias("t")).withColumn("key", F.array("t")).drop("t")
    met = ties.join(stage(_meeting(ties), "meeting"), "key")
    group = lambda met: met.where(fits).select(F.col("key").alias("gid"), "id", F.lit(True).alias("query"))
    hot = met.where(~fits).select("key", "id").join(narrow.select("id", "component", "n", "second"), "id")
    pairs = hot.select("id", "component", "n", F.explode("second").alias("t2"), "key").withColumn("key", F.concat("key", F.array("t2"))).drop("t2")
    split = stage(pairs.join(stage(_meeting(pairs), "meeting"), "key"), "split")
    parted = split.where(~fits).groupBy("key", "component").agg(*_sizes())
    top = parted.groupBy("key").agg(F.max(F.struct("size", "mass", "component")).alias("top"), F.sum("size").alias("all"), F.sum("mass").alias("all_mass"))
    top = stage(top.select("key", F.col("top.component").alias("main"), *_tiles_a_side(GROUP)), "tops")
    cut = _dealt(split.select("key", "id", "component").join(top, "key"))
    cut = cut.select(F.concat("key", F.array("i", "j")).alias("gid"), "id", "query").groupBy("gid", "id").agg(F.bool_or("query").alias("query"))
    groups = group(met).unionByName(group(split)).unionByName(cut)

    def meet(table: pa.Table) -> pa.Table:
        cols = {c: table.column(c).to_pylist() for c in ("sig", "second", "others")}
        prefixes = [[np.array(x, np.int64) for x in cols["second"]]] if orders > 1 else []
        prefixes += [[np.frombuffer(x[o], np.uint64) for x in cols["others"]] for o in range(orders - 2)]
        n, reduced = (table.column(c).to_numpy().astype(np.int64) for c in ("n", "reduced"))
        query = table.column("query").to_numpy(zero_copy_only=False)
        return _edges(table, plausible_links(n, reduced, [np.frombuffer(x, "<u8") for x in cols["sig"]], prefixes, _numbered(table.column("component")), query, percent))

    plausible = components(groups.join(narrow.drop("first"), "id").groupBy("gid").applyInArrow(meet, _EDGE))
    # a plausible pair stands for its components: all their sets are in the new block
    mine = rows.select("id", "component").join(plausible.select("id", F.col("component").alias("tied")), "id")
    named = components(mine.select(F.col("component").alias("u"), F.col("tied").alias("v")).unionByName(mine.select(F.col("component").alias("u"), F.col("id").alias("v"))))
    named = named.select(F.col("id").alias("component"), F.col("component").alias("block"))
    found = rows.drop("block").join(named, "component")
    return _within(stage(found.select(*_MEMBER, "component"), "found"), tile, percent, orders)


def _within(rows: DataFrame, tile: int, percent: int, orders: int) -> DataFrame:
    """Links between the components of each block of ``rows``: several small blocks a tile, large blocks tile by tile."""
    parted = rows.groupBy("block", "component").agg(*_sizes())
    blocks = parted.groupBy("block").agg(F.max(F.struct("size", "mass", "component")).alias("top"), F.sum("size").alias("all"), F.sum("mass").alias("all_mass"))
    blocks = stage(blocks.select("block", F.col("top.component").alias("main"), *_tiles_a_side(tile), "all", "all_mass"), "blocks")
    fits = (F.col("all") <= tile) & (F.col("all_mass") <= _MASS)
    total, mass = blocks.where(fits).agg(F.sum("all"), F.sum("all_mass")).first()
    bins = max(1, (total or 0) // tile, (mass or 0) // _BUCKET)
    found = _small(rows.join(blocks.where(fits).select("block"), "block", "left_semi"), bins, percent, orders)
    return found.unionByName(_outside(rows.join(blocks.where(~fits).drop("all", "all_mass"), "block"), percent, orders))


# ---------------------------------------------------------------- the join


def links_of(docs: DataFrame, tokens: int, percent: int = PERCENT, orders: int = ORDERS, tile: int = TILE) -> DataFrame:
    """Links (u, v) of distinct sets by name: enough of them to connect all that any links connect.

    ``tokens`` is the number of shingles of all rows.
    """
    sets = stage(reduced_sets(docs, tokens, percent), "sets")
    named = blocks_of(sets).select("id", F.col("component").alias("block"))
    # a set that several tasks sent is one member
    members = stage(sets.drop("prefix_1").join(named, "id").dropDuplicates(["id"]).select(*_MEMBER), "members")
    sizes = stage(members.groupBy("block").agg(*_sizes()), "sizes")
    fits = (F.col("size") <= tile) & (F.col("mass") <= _MASS)
    total, mass, large = sizes.agg(F.sum("size"), F.sum("mass"), F.count_if(~fits)).first()
    bins = max(1, (total or 0) // tile, (mass or 0) // _BUCKET)
    if not large:
        return _small(members, bins, percent, orders)
    large = sizes.where(~fits)
    found = _small(members.join(large, "block", "left_anti"), bins, percent, orders)
    return found.unionByName(_large(members, large, tile, percent, orders))


def near_duplicates(docs: DataFrame, percent: int = PERCENT, orders: int = ORDERS, tile: int = TILE) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs(doc_id, text, ...)``.

    Documents whose sets of 5-word shingles have a Jaccard similarity of ``percent`` or more
    are linked; a component's id is the smallest doc_id reachable.  Fewer than five words are
    one shingle.  Null, empty and white texts have no shingle, link with nothing and keep
    their own id; so do rows without doc_id, unless a text like theirs has one; repeated rows
    give a row each; texts of any length are shingled whole; an empty table gives an empty
    result; other columns are ignored.
    """
    rows = stage(classes(docs), "classes")
    return _with_least(rows, F.col("doc_id"), docs, percent, orders, tile).select("doc_id", "n_shingles", F.coalesce("least", "doc_id").alias("component_id"))


def near_survivors(docs: DataFrame) -> DataFrame:
    """doc_id, sha (of the text), kept of every row of ``docs(doc_id, text, ...)`` that has a shingle.

    One (doc_id, text) of each component is kept: the smallest doc_id, null after all others,
    then the smallest SHA-256.  Components are those of ``near_duplicates``, told apart by their
    sets and not by a doc_id, which texts of two components may share.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole(docs["text"]).alias("text"))
    rows = stage(classes(rows, digests=True), "classes")
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "sha")
    found = _with_least(rows, rank, docs, PERCENT, ORDERS, TILE).where("id is not null")
    return found.select("doc_id", "sha", (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("sha") == F.col("least.sha"))).alias("kept"))


def _with_least(rows: DataFrame, rank, docs: DataFrame, percent: int, orders: int, tile: int) -> DataFrame:
    """Staged ``rows`` of ``classes(docs)`` with the least ``rank`` of their component."""
    reps = rows.where("id is not null").groupBy("id").agg(F.min(rank).alias("rep"))
    tokens = rows.agg(F.sum("n_shingles")).first()[0] or 0
    parts = components(links_of(docs, tokens, percent, orders, tile))
    least = reps.join(parts, "id").groupBy("component").agg(F.min("rep").alias("least"))
    linked = parts.join(least, "component").select("id", "least")
    # staged, so that both sides of the last join are plain exchanges and AQE can split the copies of one set
    named = stage(reps.join(linked, "id", "left").select(F.col("id").alias("set"), F.coalesce("least", "rep").alias("least")), "named")
    return rows.join(named, rows["id"] == named["set"], "left")


def op10_ngram_join(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    return near_duplicates(table(spark, sf_dir, "documents"))
