"""Byte-level BPE encoding and decoding with overlapping chunks.

Pre-tokenisation looks only forward: once two scans share a boundary they agree from there
on.  A text is cut into overlapping chunks; each is pre-tokenised on its own from its first
character, right or wrong, and two neighbours are stitched at the first boundary in their
overlap that both scans have and that lies between a non-space and a space.  No pre-token
holds a space behind a non-space, so every scan has a boundary there and each chunk finds
its two stitches by itself; and as a piece then ends in a non-space, the look-ahead of the
pattern's space rule never crosses a stitch.  The pieces between stitches are encoded.

Texts of up to ``long_chars`` are done where they are read.  The chunks of longer ones become
rows of their own, dealt over the cluster; only their ids meet again.  Chunks without a
stitch in their overlap (say one run of letters longer than it) are joined.  What is joined to
more than ``SPLIT`` characters is encoded pre-token by pre-token: the encoder's own splitter
needs stack for every character of a run of white space.

Decoding concatenates the raw bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowio import bounded_batches, pieces
from .textcols import whole

CHUNK, OVERLAP, LONG, SPLIT = 32_768, 512, 65_536, 65_536
_CACHE: dict = {}


def read_ranks(path: str) -> bytes:
    """The rank file, read on the driver; its size is that of a vocabulary (about 1 MB)."""
    with open(path, "rb") as f:
        return f.read()


def encoder(rank_file: bytes, pattern: str):
    """(encoding, compiled pattern), built once per process; the encoding's ``pieces`` has no splitter."""
    import regex
    import tiktoken

    key = hashlib.sha256(rank_file + pattern.encode()).digest()
    if key not in _CACHE:
        ranks = {base64.b64decode(a): int(b) for a, b in (x.split() for x in rank_file.splitlines() if x)}
        made = [tiktoken.Encoding("ranks", pat_str=p, mergeable_ranks=ranks, special_tokens={}) for p in (pattern, r"[\s\S]+")]
        made[0].pieces = made[1]
        _CACHE[key] = made[0], regex.compile(pattern)
    return _CACHE[key]


def encode_piece(text: str, enc, rx) -> list[int]:
    """Ids of a text that is one piece between stitches, however long."""
    if len(text) <= SPLIT:
        return enc.encode_ordinary(text)
    return [i for m in rx.finditer(text) for i in enc.pieces.encode_ordinary(m[0])]


def boundaries(chunk: str, rx) -> set[int]:
    """Starts of the pre-tokens of a chunk scanned on its own."""
    return {m.start() for m in rx.finditer(chunk)}


def first_stitch(chunk: str, found: set[int], a: int, b: int) -> int:
    """First boundary p with a < p < b that lies between a non-space and a space; -1 if none."""
    return next((p for p in range(a + 1, min(b, len(chunk))) if chunk[p] in " \t\n\r" and not chunk[p - 1].isspace() and p in found), -1)


def chunks_of(text: str, size: int, overlap: int):
    """(number, chunk with its overlap, is it the last)."""
    starts = range(0, max(len(text), 1), size)
    for i, s in enumerate(starts):
        yield i, text[s : s + size + overlap], i == len(starts) - 1


def piece_of(no: int, chunk: str, last: bool, rx, size: int, overlap: int) -> tuple[bool, bool, str]:
    """What one chunk finds alone: stitched before, stitched behind, the text of its piece.

    The piece runs from its own stitch (or start) to the stitch (or start) of the next chunk.
    """
    found = boundaries(chunk, rx)
    head = 0 if no == 0 else first_stitch(chunk, found, 0, overlap)
    tail = len(chunk) if last else first_stitch(chunk, found, size, size + overlap)
    return head >= 0, tail >= 0, chunk[max(head, 0) : tail if tail >= 0 else size]


def join_pieces(parts, enc, rx) -> list[int]:
    """Ids of a text from its (stitched before, stitched behind, piece) in order; unstitched ones are joined first."""
    out: list[int] = []
    held: list[str] = []
    for _, behind, piece in parts:
        held.append(piece)
        if behind:
            out += encode_piece("".join(held), enc, rx)
            held = []
    return out + encode_piece("".join(held), enc, rx) if held else out


def encode(text: str, enc, rx, size: int = CHUNK, overlap: int = OVERLAP) -> list[int]:
    """Token ids of one whole text, as ``enc.encode_ordinary(text)`` gives them."""
    if len(text) <= size:
        return enc.encode_ordinary(text)
    return join_pieces((piece_of(i, c, last, rx, size, overlap) for i, c, last in chunks_of(text, size, overlap)), enc, rx)


def id_bytes(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def decode(raw: bytes, enc) -> bytes:
    """The bytes that little-endian unsigned 32-bit ids stand for."""
    return enc.decode_bytes(np.frombuffer(raw, dtype="<u4").tolist())


def encode_documents(docs: DataFrame, rank_path: str, pattern: str, size: int = CHUNK, overlap: int = OVERLAP, long_chars: int = LONG) -> DataFrame:
    """Token ids of every whole text of ``docs(doc_id, text, ...)`` and the bytes they decode to.

    Returns doc_id, ids (binary, little-endian unsigned 32-bit) and decoded (binary, decoded
    from ids alone, in the same worker).  Null text counts as empty and has no ids; repeated
    rows give a row each; an empty table gives an empty result; other columns are ignored.
    Texts of any length are done whole, also where nothing splits them (a run of one letter,
    or of white space): such a run is one pre-token and is merged in one task.
    """
    ranks = docs.sparkSession.sparkContext.broadcast(read_ranks(rank_path))  # a vocabulary: its size is fixed
    rows = docs.select(docs["doc_id"], whole(docs["text"]).alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    made = f"doc_id {kind}, ids binary, decoded binary"

    def here(batches):
        enc, rx = encoder(ranks.value, pattern)
        for batch in batches:
            for b in pieces(batch, 1):
                raw = [id_bytes(encode(t, enc, rx, size, overlap)) for t in b.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(raw, pa.binary()), pa.array([decode(x, enc) for x in raw], pa.binary())], ["doc_id", "ids", "decoded"])

    def cut(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                doc, text, uid = (batch.column(i)[row] for i in range(3))
                for no, chunk, last in chunks_of(text.as_py(), size, overlap):
                    yield pa.RecordBatch.from_arrays([pa.array([doc.as_py()], batch.schema.field(0).type), pa.array([uid.as_py()]), pa.array([no], pa.int32()), pa.array([last]), pa.array([chunk])], ["doc_id", "uid", "no", "last", "chunk"])

    def alone(batches):
        enc, rx = encoder(ranks.value, pattern)
        for batch in batches:
            for b in pieces(batch, 4):
                done = {"before": [], "behind": [], "ids": [], "piece": []}
                for no, last, chunk in zip(*(b.column(i).to_pylist() for i in (2, 3, 4))):
                    before, behind, piece = piece_of(no, chunk, last, rx, size, overlap)
                    whole_piece = before and behind
                    for k, v in (("before", before), ("behind", behind), ("ids", id_bytes(enc.encode_ordinary(piece)) if whole_piece else b""), ("piece", "" if whole_piece else piece)):
                        done[k].append(v)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), b.column(2), pa.array(done["before"], pa.bool_()), pa.array(done["behind"], pa.bool_()), pa.array(done["ids"], pa.binary()), pa.array(done["piece"], pa.string())],
                    ["doc_id", "uid", "no", "before", "behind", "ids", "piece"],
                )

    def together(table: pa.Table) -> pa.Table:  # one document
        enc, rx = encoder(ranks.value, pattern)
        out, held = [], []
        for before, behind, ids, piece in zip(*(table.sort_by("no").column(c).to_pylist() for c in ("before", "behind", "ids", "piece"))):
            held.append(piece)
            if behind:
                out.append(ids or id_bytes(encode_piece("".join(held), enc, rx)))
                held = []
        raw = b"".join(out)
        return pa.table({"doc_id": table.column("doc_id")[:1], "ids": pa.array([raw], pa.binary()), "decoded": pa.array([decode(raw, enc)], pa.binary())})

    long_rows = rows.where(F.length("text") > long_chars).withColumn("uid", F.monotonically_increasing_id())
    dealt = bounded_batches(long_rows).mapInArrow(cut, f"doc_id {kind}, uid long, no int, last boolean, chunk string").repartition("uid", "no")
    encoded = dealt.mapInArrow(alone, f"doc_id {kind}, uid long, no int, before boolean, behind boolean, ids binary, piece string")
    return rows.where(F.length("text") <= long_chars).mapInArrow(here, made).unionByName(encoded.groupBy("uid").applyInArrow(together, made))


def with_digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256, decoded_sha256 of ``encode_documents``."""
    return encoded.select("doc_id", F.shiftright(F.octet_length("ids"), 2).cast("long").alias("n_tokens"), "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def digests(docs: DataFrame, rank_path: str, pattern: str, **how) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every text: encoded, then decoded from its ids."""
    return with_digests(encode_documents(docs, rank_path, pattern, **how)).drop("ids")


def multi_50k() -> tuple[str, str]:
    """(rank file, pattern) of the public vocabulary for many languages."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN


def op6_byte_bpe(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    return digests(table(spark, sf_dir, "documents"), *multi_50k())
