"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes proposes boundaries; a strict mask below the normal chunk
size and a loose one above it keep sizes close to normal.  A fingerprint is the set of chunk
digests with their lengths; the share of a document's bytes whose chunks another one has too
measures containment, and a shift moves no boundary but those next to it.

Such chunks are too coarse for short texts, so a text below FINE_BELOW bytes has a second set
of fine chunks, which are cut by a hash over 8 bytes and marked ``~``.  Containment compares
fine chunks where both texts have them, else the coarse ones that every text has.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowio import bounded_batches, pieces
from .textcols import whole

LEAST, NORMAL, MOST = 16, 64, 256
WINDOW = 32
FINE_BELOW, FINE, FINE_WINDOW = 1024, (4, 8, 24), 8
_STEP = 1 << 20
GEAR = np.array([int.from_bytes(hashlib.blake2b(bytes([b]), digest_size=4, person=b"gear").digest(), "big") for b in range(256)], dtype=np.uint32)


def _hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = sum of GEAR[data[i - j]] << j over the last 32 bytes, by doubling the span five times."""
    h = GEAR[data]
    span = 1
    while span < WINDOW:
        h[span:] += h[:-span] << np.uint32(span)
        span *= 2
    return h


def candidates(raw: bytes, normal: int = NORMAL, window: int = WINDOW) -> tuple[list[int], list[int]]:
    """Chunk ends proposed by the strict and by the loose mask, ascending; long texts in steps.

    Bit b of the hash depends on the last b + 1 bytes only: a window below 32 reads lower bits.
    """
    bits = normal.bit_length() - 1
    strict, loose = np.uint32(0xFFFFFFFF << (32 - bits - 1) & 0xFFFFFFFF), np.uint32(0xFFFFFFFF << (32 - bits + 1) & 0xFFFFFFFF)
    data, s, o = np.frombuffer(raw, dtype=np.uint8), [], []
    for at in range(0, len(data), _STEP):
        first = max(0, at - WINDOW + 1)
        h = _hashes(data[first : at + _STEP])[at - first :] << np.uint32(WINDOW - window)
        hit = np.flatnonzero((h & loose) == 0)
        ends = hit + (at + 1)
        o += ends.tolist()
        s += ends[(h[hit] & strict) == 0].tolist()
    return s, o


def chunk_ends(raw: bytes, least: int = LEAST, normal: int = NORMAL, most: int = MOST, window: int = WINDOW) -> list[int]:
    strict, loose = candidates(raw, normal, window)
    n, at, ends, i, k = len(raw), 0, [], 0, 0
    ns, nl = len(strict), len(loose)
    while at < n:
        low, mid, high = at + least, at + normal, min(at + most, n)
        while i < ns and strict[i] < low:
            i += 1
        if i < ns and strict[i] < mid and strict[i] <= high:
            at = strict[i]
        else:
            while k < nl and loose[k] < mid:
                k += 1
            at = loose[k] if k < nl and loose[k] <= high else high
        ends.append(at)
    return ends


def fingerprint(text: str) -> dict[str, int]:
    """digest -> bytes of the chunk, in text order, fine chunks of a short text last; empty for an empty text."""
    raw = text.encode("utf-8")
    out: dict[str, int] = {}
    levels = [("", chunk_ends(raw))]
    if len(raw) < FINE_BELOW:
        levels.append(("~", chunk_ends(raw, *FINE, FINE_WINDOW)))
    for mark, ends in levels:
        at = 0
        for end in ends:
            out[mark + xxhash.xxh3_64_hexdigest(raw[at:end])] = end - at
            at = end
    return out


def as_string(fp: dict[str, int]) -> str:
    return ",".join(f"{d}:{n}" for d, n in fp.items())


def containment(a: dict[str, int], b: dict[str, int]) -> float:
    """Share of ``a``'s chunk bytes that ``b`` has too; of nothing in nothing 1, of nothing in something 0."""
    if not a:
        return float(not b)
    fine = _is_fine(a) and _is_fine(b)
    level = {d: n for d, n in a.items() if d.startswith("~") == fine}
    return sum(n for d, n in level.items() if d in b) / sum(level.values())


def _is_fine(fp: dict[str, int]) -> bool:
    return next(reversed(fp), "").startswith("~")


def edited(text: str, following: str) -> str:
    """``text`` with its last quarter replaced by as many first code points of ``following``."""
    k = len(text) // 4
    return text[: len(text) - k] + following[:k]


def _cuts(rows: DataFrame, buckets: int) -> list[tuple]:
    """Ascending (doc_id, least hash) at which ranges begin, null first: about equal shares of the rows.

    An id that holds several shares (or all rows without one) is cut by the hash of the text.
    """
    at = [i / buckets for i in range(1, buckets)] or [0.5]
    stat = rows.agg(F.count(F.lit(1)).alias("n"), F.count("doc_id").alias("named"), F.min("doc_id").alias("low"), F.percentile_approx("doc_id", at, 100 * buckets).alias("cuts")).first()  # ``buckets`` values
    ids = sorted([stat["low"], *stat["cuts"]]) if stat["cuts"] else []
    shares = {i: ids.count(i) for i in dict.fromkeys(ids)}
    out = []
    nameless = stat["n"] - stat["named"]
    if nameless:
        shares = {None: -(-buckets * nameless // stat["n"])} | shares
    for i, k in shares.items():
        k = k - 1 if i is not None else k  # a light id may begin a range by chance twice
        out += [(i, -(2**63) + 2**64 * j // k) for j in range(k)] if k > 1 else [(i, -(2**63))]
    return out


def with_next(docs: DataFrame, fn, schema: str, buckets: int) -> DataFrame:
    """``fn(doc_id, text, next_text) -> tuple`` for each row in ascending doc_id, the first following the last.

    Rows that share a doc_id, or have none, follow one another by a hash of the text, then by
    text.  Rows are dealt into ranges of that order (``_cuts``) and each range is read in
    order, one row ahead.  A range needs one row of the next: the first row of a range is sent
    to both.  Texts move once; no task sees more than its ranges, which it reads as a stream.
    """
    spark = docs.sparkSession
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), whole(docs["text"]).alias("text"))
    cuts = _cuts(rows, buckets)
    rows = rows.select("doc_id", F.xxhash64("text").alias("h"), "text")
    ids = np.array([i for i, _ in cuts if i is not None], np.int64)
    own: dict = {}  # id (or none) of several ranges -> number of the first, least hashes
    for no, (i, h) in enumerate(cuts):
        own.setdefault(i, (no, []))[1].append(h)
    nameless = len(cuts) - len(ids)
    begins = {(i, None): no for i, (no, h) in own.items() if i is not None and len(h) == 1}
    own = {i: (no, np.array(h, np.int64)) for i, (no, h) in own.items() if i is None or len(h) > 1}

    def range_of(value, null, h):
        out = np.searchsorted(ids, value, side="right") - 1 + nameless
        for i, (no, low) in own.items():
            mine = null if i is None else ~null & (value == i)
            out[mine] = no + np.searchsorted(low, h[mine], side="right") - 1
        return out

    if own:  # where ranges of one id begin: a narrow pass, a row a range
        named = F.col("doc_id").isin([i for i in own if i is not None])
        some = rows.where(F.col("doc_id").isNull() | named).select("doc_id", "h")

        def numbered(batches):
            for b in batches:
                null, value = np.asarray(b.column(0).is_null()), b.column(0).fill_null(0).to_numpy()
                at = pa.array(range_of(value, null, b.column(1).to_numpy()).astype(np.int32))
                yield pa.RecordBatch.from_arrays([at, b.column(0), b.column(1)], ["bucket", "doc_id", "h"])

        found = some.mapInArrow(numbered, "bucket int, doc_id long, h long").groupBy("bucket").agg(F.min(F.struct("doc_id", "h")).alias("m")).collect()
        begins |= {(r["m"]["doc_id"], r["m"]["h"]): r["bucket"] for r in found}
    # ids behind one of several ranges are in its last: the last that has rows of that id
    held = np.arange(max(len(cuts), 1))
    for i, (no, low) in own.items():
        held[no + len(low) - 1] = max(k for (doc, _), k in begins.items() if doc == i)
    order = sorted(begins.values())
    before = {k: order[i - 1] for i, k in enumerate(order)}  # the range that ends where another begins

    def deal(batches):
        sent = set()
        for batch in batches:
            for b in pieces(batch, 2):
                null, value, h = np.asarray(b.column(0).is_null()), b.column(0).fill_null(0).to_numpy(), b.column(1).to_numpy()
                at = held[range_of(value, null, h)]
                guests, to = [], []
                for i in np.flatnonzero(null | np.isin(value, ids)).tolist():
                    doc = None if null[i] else int(value[i])
                    k = begins.get((doc, int(h[i]) if doc in own else None))
                    if k is not None and (k, h[i]) not in sent:
                        sent.add((k, h[i]))
                        guests.append(i)
                        to.append(before[k])
                picked = pa.array(np.concatenate([np.arange(len(at)), np.array(guests, np.int64)]))
                where = pa.array(np.concatenate([at, np.array(to, np.int64)]).astype(np.int32))
                guest = pa.array(np.arange(len(picked)) >= len(at))
                yield pa.RecordBatch.from_arrays([where, guest, *(c.take(picked) for c in b.columns)], ["bucket", "guest", "doc_id", "h", "text"])

    def walk(batches):
        held = None  # (bucket, doc_id, text) that waits for its follower
        done = []
        for batch in batches:
            for b in pieces(batch, 4, 1 << 20):
                for bucket, guest, doc, text in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4))):
                    if held is not None and held[0] == bucket:
                        done.append(fn(held[1], held[2], text))
                    held = None if guest else (bucket, doc, text)
                if done:
                    yield _batch(done, schema)
                    done = []

    dealt = bounded_batches(rows).mapInArrow(deal, "bucket int, guest boolean, doc_id long, h long, text string")
    return dealt.repartition("bucket").sortWithinPartitions("bucket", "guest", "doc_id", "h", "text").mapInArrow(walk, schema)


_TYPES = {"long": pa.int64(), "string": pa.string(), "double": pa.float64()}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(",")))
    return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[k]) for c, k in zip(zip(*rows), kinds)], list(names))


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def fingerprints(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprint of every whole text of ``docs(doc_id, text, ...)`` and of its edited text.

    The edited text has the last floor(n/4) code points replaced by the first as many of the
    next document in ascending doc_id (after the last: the first).  near_edited and near_next
    are the containment of the document's chunks in the edited and in the next text.

    Null text counts as empty and has an empty fingerprint; rows without doc_id come first;
    they, and rows that share a doc_id, follow one another by the hash of the text, then by
    text; a lone row follows itself; texts of any length are read whole; an empty table gives
    an empty result; other columns are ignored.
    """
    buckets = buckets or max(64, 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    memo: dict = {}

    def one(doc, text, following):
        mine = memo.get("fp") if memo.get("text") == text else None
        mine = fingerprint(text) if mine is None else mine
        other = mine if following == text else fingerprint(following)
        memo.update(text=following, fp=other)
        new = edited(text, following)
        changed = mine if new == text else fingerprint(new)
        return doc, len(text), hashlib.sha256(new.encode()).hexdigest(), as_string(mine), as_string(changed), containment(mine, changed), containment(mine, other)

    return with_next(docs, one, SCHEMA, buckets)


def op8_cdc_fingerprints(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    return fingerprints(table(spark, sf_dir, "documents"))
