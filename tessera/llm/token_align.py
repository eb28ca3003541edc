"""Alignment of two tokenizers: minimal groups of tokens with equal bytes, and links between their tokens.

A text with a space before it is cut into units before every space that follows a character
that is not white space.  Neither tokenizer has a token across such a place (checked when the
vocabularies are read), so both have a boundary there and a text's groups are those of its
units.  Units repeat a lot; each worker encodes and aligns a unit once while it remembers it.

The tokens of the units are the nodes of a bipartite graph; tokens whose byte ranges overlap
are linked.  Union-find over the links gives the connected components, which are exactly the
minimal groups: a place where both tokenizers cut has no link across it, and any other place
inside a token is crossed by one.

How many documents hold a pair of ids is counted by Spark over the distinct pairs of each
document, and joined back to them.  The counts are broadcast up to ``BROADCAST_PAIRS`` rows and
joined by a shuffle beyond.
"""

from __future__ import annotations

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..staging import stage
from .arrowio import bounded_batches, pieces
from .textcols import whole

BROADCAST_PAIRS = 1_000_000
#: Units a worker remembers, characters of one step of a long text, and characters above which a unit is not remembered.
REMEMBERED, STEP, LONG_UNIT = 200_000, 1 << 19, 48
_ODD = re.compile(r"(?:\A|\s) | \Z")
_CUT = re.compile(r"(?<=\S) ")
_CACHE: dict = {}


def units_of(text: str) -> list[str]:
    """The units of ``" " + text``, each without the space that it begins with; together, joined by spaces, the text."""
    if not _ODD.search(text):
        return text.split(" ")
    units = _CUT.split(text)
    if len(units) > 1 and not units[-1]:
        units[-2:] = [units[-2] + " "]
    return units


def steps(text: str, size: int):
    """A long text in parts of about ``size`` characters, cut where units begin (the space between two parts is left out)."""
    at = 0
    while len(text) - at > 2 * size:
        cut = _CUT.search(text, at + size, len(text) - 1)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.end()
    yield text[at:]


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in a byte-level vocabulary: printable Latin-1 for itself, the rest from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(rest)}


def _sizes(tokens: list[bytes]) -> np.ndarray:
    return np.array([len(t) for t in tokens], np.int64)


def _shown(n: int) -> np.ndarray:
    """Decimal ids followed by nothing, a comma, a bar and a semicolon, as fixed-width bytes: row 4 * id + which."""
    width = len(str(n)) + 1
    return np.array([f"{i}{end}".encode() for i in range(n) for end in ("", ",", "|", ";")], f"S{width}")


class Tokenizers:
    """Both tokenizers in one worker, with the bytes of their tokens and the units met so far."""

    def __init__(self, byte_level: str, piece_model: bytes):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_str(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        letters = _byte_letters()
        vocab = json.loads(byte_level)
        names = vocab["model"]["vocab"] | {t["content"]: t["id"] for t in vocab.get("added_tokens", ())}
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.bytes_a[i] = bytes(letters[c] for c in name) if all(c in letters for c in name) else name.encode()
        shown = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(re.search("[^▁]▁", p) for p in shown):
            raise ValueError("a piece goes on over a space: texts cannot be cut at spaces")
        self.bytes_b = [bytes([int(p[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", p) else p.replace("▁", " ").encode() for p in shown]
        self.size_a, self.size_b = _sizes(self.bytes_a), _sizes(self.bytes_b)
        self.shown = np.concatenate([_shown(len(self.bytes_a)), _shown(len(self.bytes_b))])
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.groups: list[bytes] = []
        self.facts = _Rows(5)  # n_a, n_b, n_groups, n_links, bad
        self.start = _Rows(1)
        self.pairs = _Rows(1)
        self.start.add(np.zeros((1, 1), np.int64))

    def _encode(self, units: list[str]):
        """(flat A ids, flat B ids, their numbers by unit, good) of units; those with other bytes than theirs have no ids."""
        wanted = [f" {u}".encode() for u in units]
        # units meet again where they would in a text: behind white space no unit begins
        if len(units) > 1 and not any(u[-1:].isspace() for u in units):
            text = " ".join(units)
            flat = [self.a.encode(f" {text}", add_special_tokens=False).ids, self.b.encode(text)]
            want = b"".join(wanted)
            if all(b"".join([table[i] for i in ids]) == want for table, ids in zip((self.bytes_a, self.bytes_b), flat)):
                last = np.cumsum([len(w) for w in wanted])
                flat = [np.array(ids, np.int64) for ids in flat]
                ends = [np.searchsorted(np.cumsum(size[ids]), last) + 1 for size, ids in zip((self.size_a, self.size_b), flat)]
                return (*flat, *(np.diff(e, prepend=0) for e in ends), np.ones(len(units), bool))
        if len(units) > 64:  # find the odd ones
            parts = [self._encode(units[i : i + len(units) // 8 + 1]) for i in range(0, len(units), len(units) // 8 + 1)]
            return tuple(np.concatenate(x) for x in zip(*parts))
        ids_a = [self.a.encode(f" {u}", add_special_tokens=False).ids for u in units]
        ids_b = self.b.encode(units, num_threads=1)
        good = [b"".join([self.bytes_a[i] for i in x]) == w == b"".join([self.bytes_b[i] for i in y]) for x, y, w in zip(ids_a, ids_b, wanted)]
        flat = [np.array([i for x, ok in zip(ids, good) if ok for i in x], np.int64) for ids in (ids_a, ids_b)]
        counts = [np.array([len(x) if ok else 0 for x, ok in zip(ids, good)], np.int64) for ids in (ids_a, ids_b)]
        return (*flat, *counts, np.array(good, bool))

    def learn(self, units: list[str]) -> None:
        """Encode and align units not met before; they get the next numbers in order."""
        flat_a, flat_b, n_a, n_b, good = self._encode(units)
        of_a = np.repeat(np.arange(len(units)), n_a)
        link_a, link_b = links(np.cumsum(self.size_a[flat_a]), np.cumsum(self.size_b[flat_b]))
        comp_a, comp_b = components(len(flat_a), len(flat_b), link_a, link_b)
        n_groups = np.bincount(of_a[comp_a == np.arange(len(comp_a))], minlength=len(units))
        n_links = np.bincount(of_a[link_a], minlength=len(units))
        self.number.update(zip(units, range(len(self.groups), len(self.groups) + len(units))))
        self.facts.add(np.stack([n_a, n_b, n_groups, n_links, ~good], axis=1).astype(np.int64))
        self.groups += self._shown_groups(flat_a, flat_b, comp_a, comp_b, of_a, n_a + n_b)
        self.start.add((self.start.all()[-1] + np.cumsum(n_links))[:, None])
        self.pairs.add((flat_a[link_a] << 32 | flat_b[link_b])[:, None])

    def _shown_groups(self, flat_a, flat_b, comp_a, comp_b, of_a, n_tokens) -> list[bytes]:
        comp, side = np.concatenate([comp_a, comp_b]), np.repeat([0, 1], [len(flat_a), len(flat_b)])
        order = np.argsort(comp * 2 + side, kind="stable")  # a component is named by its first A token: components in order of place
        comp, side = comp[order], side[order]
        unit = of_a[comp] if len(comp) else comp
        end = np.zeros(len(comp), np.int64)
        if len(comp):
            end[:-1] = np.where(unit[1:] != unit[:-1], 0, np.where(comp[1:] != comp[:-1], 3, np.where(side[1:] != side[:-1], 2, 1)))
        row = np.concatenate([flat_a, flat_b + len(self.bytes_a)])[order] * 4 + end
        shown = self.shown[row]
        size = np.char.str_len(shown)
        data = shown.tobytes().replace(b"\0", b"")
        last = np.cumsum(n_tokens)
        at = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], last])].tolist()
        return [data[x:y] for x, y in zip(at, at[1:])]

    def texts(self, texts: list[str | None]) -> list[tuple]:
        """Of each text (n_a, n_b, n_groups, n_links, sha256 of the groups, distinct pairs, how often each).

        ``texts`` are about a MB together; a longer one goes step by step.
        """
        cut = [[] if not t else list(steps(t, STEP)) for t in texts]
        short = iter(self._parts([p[0] for p in cut if len(p) == 1]))
        return [_whole([next(short)] if len(p) == 1 else (self._parts([x])[0] for x in p)) for p in cut]

    def _parts(self, texts: list[str]) -> list[tuple]:
        """Of each part of a text: facts, its groups shown, its distinct pairs, how often each."""
        units = [units_of(t) for t in texts]
        if len(self.groups) > REMEMBERED:
            self.forget()
        new = list(set().union(*units).difference(self.number))
        for i in range(0, len(new), 10_000):
            self.learn(new[i : i + 10_000])
        facts, start, pairs = self.facts.all(), self.start.all()[:, 0], self.pairs.all()[:, 0]
        out = []
        for mine in units:
            n = np.fromiter(map(self.number.__getitem__, mine), np.int64, len(mine))
            size = start[n + 1] - start[n]
            where = np.repeat(start[n] - np.cumsum(size) + size, size) + np.arange(size.sum())
            distinct, times = np.unique(pairs[where], return_counts=True)
            out.append((facts[n].sum(axis=0), b";".join([self.groups[k] for k in n.tolist()]), distinct, times))
        for u in new:
            if len(u) > LONG_UNIT:
                del self.number[u]
        return out


_NONE = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


def _whole(parts) -> tuple:
    """One text from its parts in order."""
    total, sha, distinct, times = np.zeros(5, np.int64), hashlib.sha256(), None, None
    for facts, groups, pairs, often in parts:
        total += facts
        sha.update(groups if distinct is None else b";" + groups)
        if distinct is None:
            distinct, times = pairs, often
        else:
            distinct, inverse = np.unique(np.concatenate([distinct, pairs]), return_inverse=True)
            times = np.bincount(inverse, weights=np.concatenate([times, often])).astype(np.int64)
    return _NONE if distinct is None or total[4] else (*total[:4].tolist(), sha.hexdigest(), distinct, times)


class _Rows:
    """A table of integers that grows at its end."""

    def __init__(self, width: int):
        self.data, self.n = np.zeros((1024, width), np.int64), 0

    def add(self, rows: np.ndarray) -> None:
        if self.n + len(rows) > len(self.data):
            self.data = np.concatenate([self.data[: self.n], np.zeros((max(self.n, len(rows)), self.data.shape[1]), np.int64)])
        self.data[self.n : self.n + len(rows)] = rows
        self.n += len(rows)

    def all(self) -> np.ndarray:
        return self.data[: self.n]


def links(end_a: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of overlapping tokens in order of place, from the offsets where tokens end (the last ends are equal).

    Each stretch between two neighbouring ends lies in one token of either side, and two
    tokens overlap in one stretch.
    """
    ends = np.union1d(end_a, end_b)
    return np.searchsorted(end_a, ends), np.searchsorted(end_b, ends)


def components(n_a: int, n_b: int, link_a: np.ndarray, link_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union-find: the component of every A and every B token, named by its first A token.

    Roots of linked tokens are hooked, the later below the earlier, and paths are halved until
    they are short, for all links at once, until no link joins two roots.
    """
    parent = np.arange(n_a + n_b)
    x, y = link_a, link_b + n_a
    while len(x):
        root_x, root_y = parent[x], parent[y]
        apart = root_x != root_y
        x, y = x[apart], y[apart]
        np.minimum.at(parent, np.maximum(root_x, root_y)[apart], np.minimum(root_x, root_y)[apart])
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up
    return parent[:n_a], parent[n_a:]


def _tokenizers(byte_level: str, piece_model: bytes) -> Tokenizers:
    key = hashlib.sha256(byte_level.encode() + piece_model).digest()
    if key not in _CACHE:
        _CACHE[key] = Tokenizers(byte_level, piece_model)
    return _CACHE[key]


def aligned(docs: DataFrame, byte_level_path: str, piece_path: str) -> DataFrame:
    """One row per row of ``docs(doc_id, text, ...)``: doc_id, n_a, n_b, n_groups, n_links, groups_sha256, and its distinct pairs.

    ``a``, ``b``, ``times`` are arrays of equal length: the ids of each distinct linked pair
    and how many links of the document have them.
    """
    context = docs.sparkSession.sparkContext
    with open(byte_level_path, encoding="utf-8") as f, open(piece_path, "rb") as g:
        files = context.broadcast((f.read(), g.read()))  # two vocabularies: their size is fixed
    rows = docs.select(docs["doc_id"], whole(docs["text"]).alias("text"))
    names = ["n_a", "n_b", "n_groups", "n_links"]
    kind = f"doc_id {dict(rows.dtypes)['doc_id']}, {', '.join(f'{n} long' for n in names)}, groups_sha256 string, a array<int>, b array<int>, times array<int>"

    def run(batches):
        both = _tokenizers(*files.value)
        for batch in batches:
            for part in pieces(batch, 1, 1 << 20):
                done = both.texts(part.column(1).to_pylist())
                at = pa.array(np.concatenate([[0], np.cumsum([len(d[5]) for d in done])]).astype(np.int32))
                pair, times = (np.concatenate([np.zeros(0, np.int64), *(d[i] for d in done)]) for i in (5, 6))
                lists = [pa.ListArray.from_arrays(at, pa.array(v.astype(np.int32))) for v in (pair >> 32, pair & 0xFFFFFFFF, times)]
                facts = [pa.array([d[i] for d in done], pa.int64()) for i in range(4)]
                yield pa.RecordBatch.from_arrays([part.column(0), *facts, pa.array([d[4] for d in done], pa.string()), *lists], ["doc_id", *names, "groups_sha256", "a", "b", "times"])

    return bounded_batches(rows).mapInArrow(run, kind)


def pair_counts(rows: DataFrame) -> DataFrame:
    """Of every linked pair of ids: pair (A id * 2^32 + B id), n (rows of ``aligned`` that hold it), best (none of its A id has more)."""
    each = rows.select(F.explode(F.arrays_zip("a", "b")).alias("p")).select("p.a", "p.b")
    counts = each.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"))  # map-side first: a task sends a pair once
    most = F.max("n").over(Window.partitionBy("a"))  # at most as many rows as B has pieces
    return counts.select(_pair("a", "b").alias("pair"), "n", (F.col("n") == most).alias("best"))


def _pair(a, b):
    return F.shiftleft(F.col(a).cast("long"), 32).bitwiseOR(F.col(b).cast("long"))


def align(docs: DataFrame, byte_level_path: str, piece_path: str, broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """Token counts, groups, links and corpus-wide pair counts of every row of ``docs(doc_id, text, ...)``.

    Returns doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum (long), groups_sha256.

    * A null or empty text, and one whose token bytes differ from the text with a space
      before it, has no tokens: zeros and an empty groups_sha256.
    * Every row is a document: repeated rows, also of one doc_id, are each counted.
    * A text of any length is done whole, in steps of STEP characters; memory grows with its
      distinct pairs and its longest unit only.  An empty table gives an empty result; other
      columns are ignored; ties for the highest count are all best.
    """
    rows = stage(aligned(docs, byte_level_path, piece_path), "aligned")
    counts = stage(pair_counts(rows), "pairs")
    # beyond the bound the exploded pairs are dealt by pair; AQE splits the partitions of frequent ones
    counts = F.broadcast(counts) if counts.count() <= broadcast_pairs else counts
    facts = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    each = rows.withColumn("row", F.monotonically_increasing_id()).select("row", *facts, F.explode_outer(F.arrays_zip("a", "b", "times")).alias("p"))
    held = each.select("row", *facts, _pair("p.a", "p.b").alias("pair"), F.col("p.times").cast("long").alias("times")).join(counts, "pair", "left")
    sums = held.groupBy("row").agg(
        *[F.first(c).alias(c) for c in facts],
        F.coalesce(F.sum(F.when(F.col("best"), F.col("times"))), F.lit(0)).alias("n_best"),
        F.coalesce(F.sum(F.col("times") * F.col("n")), F.lit(0)).alias("count_sum"),
    )
    return sums.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def public_pair() -> tuple[str, str]:
    """Paths of the public byte-level vocabulary and the public piece model."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def op13_token_alignment(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    return align(table(spark, sf_dir, "documents"), *public_pair())
