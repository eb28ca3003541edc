"""Repair of conversation structure by a forward Viterbi search over a small grammar.

A repaired conversation is empty or an optional system turn and user-assistant pairs, by the
initials of its roles ``(s?(ua)+)?``.  Rows are read in order of turn; for each of four states
(nothing yet, after s, after u, after a) the search carries the minimum (cost, audit string).
A layer is closed by at most two insertions before the next row is taken: two lead from every
state to every state that any can lead to.

Per row the audit grows by one word of I's and an edit; no such word begins another, and from
a given state an audit determines the states it passes.  So of two prefixes that reach one
state after the same rows the smaller (cost, audit) stays the smaller whatever follows.

Conversations within ``most_rows`` and ``most_bytes`` are searched where their rows meet.  Longer ones are
cut into segments by ranges of their order.  A segment's search from each state gives a 4 x 4
table of costs and of ranks among its audits; tables multiply (least cost, then lesser rank of
the left part), FAN at a time, level by level; from the root the states at every cut follow
downwards, and each segment writes its own part of the repair.  Copies of a row are one row
with a count.  Only the hash of a long conversation, which is sequential, reads its parts in
one task, one after another.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..staging import stage
from .arrowio import bounded_batches
from .textcols import WS

MOST_ROWS, MOST_BYTES, FAN = 2_048, 8 << 20, 256
INSERT, DELETE, REROLE, TRUNCATED = 5, 2, 1, 5
_STATES, _NEVER = range(4), 1 << 60
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (3, "u"): 2, (2, "a"): 3}
#: What a state asks for where the role is free: its initial is the only one that a user or assistant turn can have there.
_FREE = {0: "user", 1: "user", 2: "assistant", 3: "user"}
_CLOSE = {0: "", 1: "II", 2: "I", 3: ""}
_REPAIRED = "array<struct<role:string,text:string>>"


def _after(state: int, role: str) -> int | None:
    return _NEXT.get((state, role[:1]))


def _edits(initial: str, fault: str):
    """For each state the (state after, cost, word) that one row allows, the least of each state after."""
    table = []
    for before in _STATES:
        best = {before: (DELETE, "D")}  # an insertion before a deleted row may as well follow it, and D < I
        if fault not in ("blank", "duplicate"):
            state, extra = before, TRUNCATED * (fault == "truncated")
            for k in range(3):
                for cost, word, role in ((0, "K", initial), (REROLE, "R", _FREE[state])):
                    to, found = _after(state, role), (INSERT * k + cost + extra, "I" * k + word)
                    if to is not None and found < best.get(to, (_NEVER, "")):
                        best[to] = found
                state = _after(state, _FREE[state])
        table.append([(to, cost, word) for to, (cost, word) in best.items()])
    return table


_TABLE = {(i, f): _edits(i, f) for i in ("s", "u", "a", "") for f in ("", "blank", "duplicate", "truncated")}


def search(rows, start: int) -> dict[int, tuple[int, str]]:
    """Least (cost, audit) of each reachable state after ``rows`` of (initial of the role, fault, copies), from ``start``."""
    best = {start: (0, "")}
    for initial, fault, copies in rows:
        layer: dict[int, tuple[int, str]] = {}
        table = _TABLE[initial if initial in ("s", "u", "a") else "", fault]
        for before, (cost, audit) in best.items():
            for to, more, word in table[before]:
                found = (cost + more, audit + word)
                if to not in layer or found < layer[to]:
                    layer[to] = found
        if copies > 1:  # the others are duplicates at least
            layer = {s: (c + DELETE * (copies - 1), a + "D" * (copies - 1)) for s, (c, a) in layer.items()}
        best = layer
    return best


def close(best: dict[int, tuple[int, str]]) -> tuple[int, int, str]:
    """(state, cost, audit) of the cheapest complete repair."""
    return min(((s, c + INSERT * len(_CLOSE[s]), a + _CLOSE[s]) for s, (c, a) in best.items()), key=lambda x: x[1:])


def apply(audit: str, rows, state: int) -> list[tuple[str, str]]:
    """The (role, text) that an audit leaves of ``rows`` of (role, text, copies), from ``state``."""
    out, left = [], iter([r for r in rows])
    row, copies = None, 0
    for edit in audit:
        if edit == "I":
            role, text = _FREE[state], ""
        else:
            if not copies:
                *row, copies = next(left)
            copies -= 1
            if edit == "D":
                continue
            role, text = (_FREE[state] if edit == "R" else row[0]), row[1]
        out.append((role, text))
        state = _after(state, role)
    return out


def fault_of(role: str, text: str, seen: set) -> str:
    """First fault of a row: blank, duplicate (role and text are in ``seen``), truncated, or ''."""
    shown = text.rstrip(WS)
    fault = "blank" if not shown else "duplicate" if (role, text) in seen else "" if shown[-1] in ".!?" else "truncated"
    seen.add((role, text))
    return fault


def illegal_pairs(initials) -> int:
    return sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))


def _one(rows) -> tuple:
    """Everything about one conversation of (turn, role, text) in order."""
    seen: set = set()
    faults = [fault_of(role, text, seen) for _, role, text in rows]
    turns = {t for t, _, _ in rows if t is not None}
    _, cost, audit = close(search([(role[:1], f, 1) for (_, role, _), f in zip(rows, faults)], 0))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, *counts, illegal_pairs([r[:1] for _, r, _ in rows]), cost, audit, apply(audit, [(r, t, 1) for _, r, t in rows], 0)


_FACTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _kind(df: DataFrame, name: str) -> str:
    return dict(df.dtypes)[name]


def _batch(columns: dict, kinds: dict) -> pa.RecordBatch:
    repaired = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))
    as_dicts = [None if r is None else [{"role": a, "text": b} for a, b in r] for r in columns.pop("repaired")]
    arrays = {c: pa.array(v, kinds[c]) for c, v in columns.items()} | {"repaired": pa.array(as_dicts, repaired)}
    return pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))


def _short(rows: DataFrame) -> DataFrame:
    """Conversations within the bounds, whole: their rows meet in one task, one conversation in memory."""
    names = ["conv_id", *_FACTS, "audit", "repaired"]

    def run(batches):
        def stream():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(5)))

        kinds = {c: pa.int64() for c in _FACTS} | {"audit": pa.string(), "conv_id": conv_type}
        held, size = {c: [] for c in names}, 0
        for conv, group in groupby(stream(), key=lambda r: r[0]):
            done = _one([r[1:4] for r in group if not r[4]])
            for c, v in zip(names, (conv, *done)):
                held[c].append(v)
            size += 64 + sum(len(r) + len(t) for r, t in done[-1])
            if size > 1 << 20:
                yield _batch(held, kinds)
                held, size = {c: [] for c in names}, 0
        if held["conv_id"]:
            yield _batch(held, kinds)

    conv_type = _arrow_type(rows, "conv_id")
    dealt = rows.select("conv_id", "turn", "role", "text", "gone").repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text")
    return bounded_batches(dealt).mapInArrow(run, f"conv_id {_kind(rows, 'conv_id')}, {', '.join(f'{c} long' for c in _FACTS)}, audit string, repaired {_REPAIRED}")


def _arrow_type(df: DataFrame, name: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[name].dataType)


# ---- long conversations: tables of segments and their product


def table_of(rows) -> tuple[list[int], list[int]]:
    """Costs and ranks of a segment from each state (4 * from + to); ranks order the audits, equal ones share one."""
    found = {(s, t): x for s in _STATES for t, x in search(rows, s).items()}
    order = {a: i for i, a in enumerate(sorted({a for _, a in found.values()}))}
    costs, ranks = [_NEVER] * 16, [0] * 16
    for (s, t), (c, a) in found.items():
        costs[4 * s + t], ranks[4 * s + t] = c, order[a]
    return costs, ranks


_START = ([0 if s == t else _NEVER for s in _STATES for t in _STATES], [0] * 16)


def times(left, right):
    """The table of two neighbouring parts, and the state between them for each pair of outer states."""
    (c1, r1), (c2, r2) = left, right
    costs, keys, between = [_NEVER] * 16, [None] * 16, [0] * 16
    for s in _STATES:
        for t in _STATES:
            ways = [(c1[4 * s + m] + c2[4 * m + t], r1[4 * s + m], r2[4 * m + t], m) for m in _STATES if c1[4 * s + m] < _NEVER and c2[4 * m + t] < _NEVER]
            if ways:
                cost, a, b, between[4 * s + t] = min(ways)
                costs[4 * s + t], keys[4 * s + t] = cost, (a, b)
    order = {k: i for i, k in enumerate(sorted({k for k in keys if k}))}
    return (costs, [order.get(k, 0) for k in keys]), between


def fold(tables):
    total = _START
    for t in tables:
        total, _ = times(total, t)
    return total


def states_between(tables, start: int, end: int) -> list[tuple[int, int]]:
    """(state before, state after) of each part on the best way from ``start`` to ``end``."""
    total, back = _START, []
    for t in tables:
        total, between = times(total, t)
        back.append(between)
    out = []
    for between in reversed(back):
        before = between[4 * start + end]
        out.append((before, end))
        end = before
    return out[::-1]


_NODE = "costs array<long>, ranks array<int>, first string, last string, blank long, duplicate long, truncated long, illegal long"


def _node_row(conv, no: int, table, first: str, last: str, counts) -> dict:
    return {"conv_id": conv, "no": no, "costs": table[0], "ranks": table[1], "first": first, "last": last} | dict(zip(("blank", "duplicate", "truncated", "illegal"), counts))


def _grouped(df: DataFrame, by: list[str], fn, kind: str) -> DataFrame:
    """``fn(rows as dicts in order of "no") -> dicts`` on each group; groups are of bounded size."""
    def run(table: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(list(fn(table.sort_by("no").to_pylist())), schema)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    schema = to_arrow_schema(StructType.fromDDL(kind))
    return df.groupBy(*by).applyInArrow(run, kind)


def _segments(rows: DataFrame, n: int) -> DataFrame:
    """Rows of long conversations with their copies, fault, segment and place, dealt by ranges of their order."""
    once = stage(rows.where(~F.col("gone")).groupBy("conv_id", "turn", "role", "text").agg(F.count(F.lit(1)).alias("copies")), "turns")
    keyed = once.withColumn("text_id", F.sha2(F.col("text").cast("binary"), 256)).withColumn("place", F.struct(F.col("turn").isNotNull().alias("has"), "turn"))
    first = keyed.groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_id").alias("i")).agg(F.min("place").alias("first"))
    shown = F.rtrim("text", F.lit(WS))
    fault = (
        F.when(shown == "", "blank").when(F.col("first") != F.col("place"), "duplicate")
        .when(F.substring(shown, -1, 1).isin(".", "!", "?"), "").otherwise("truncated")
    )
    flagged = keyed.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text_id") == F.col("i")))
    flagged = flagged.select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))
    order = ["conv_id", "turn", "role", "text"]
    cut = flagged.repartitionByRange(n, *order).sortWithinPartitions(*order)
    return stage(cut.withColumn("seg", F.spark_partition_id()).withColumn("no", F.monotonically_increasing_id()), "segments")


def _long(rows: DataFrame, n: int) -> DataFrame:
    """Conversations beyond the bounds, in pieces."""
    conv = f"conv_id {_kind(rows, 'conv_id')}"
    cut = _segments(rows, n)

    def leaf(group):
        r = [(x["initial"], x["fault"], x["copies"]) for x in group]
        counts = [sum(c for _, f, c in r if f == "blank")]
        extra = sum(c - 1 for _, f, c in r if f != "blank")  # copies of a row that is not blank are duplicates
        counts += [extra + sum(f == "duplicate" for _, f, _ in r), sum(f == "truncated" for _, f, _ in r)]
        counts += [illegal_pairs([i for i, _, _ in r]) + sum(c - 1 for _, _, c in r)]
        yield _node_row(group[0]["conv_id"], group[0]["seg"], table_of(r), r[0][0], r[-1][0], counts)

    def inner(group):
        counts = [sum(x[c] for x in group) for c in ("blank", "duplicate", "truncated", "illegal")]
        counts[3] += sum(x["last"] + y["first"] not in ("su", "ua", "au") for x, y in zip(group, group[1:]))
        yield _node_row(group[0]["conv_id"], group[0]["no"] // FAN, fold([(x["costs"], x["ranks"]) for x in group]), group[0]["first"], group[-1]["last"], counts)

    narrow = cut.select("conv_id", "seg", "no", F.substring("role", 1, 1).alias("initial"), "fault", "copies")
    kind = f"{conv}, no long, {_NODE}"
    levels, width = [stage(_grouped(narrow, ["conv_id", "seg"], leaf, kind), "tables")], n
    while width > 1 or len(levels) == 1:
        levels.append(stage(_grouped(levels[-1].withColumn("up", F.floor(F.col("no") / FAN)), ["conv_id", "up"], inner, kind), "tables"))
        width = -(-width // FAN)

    def root(group):
        (x,) = group
        best = {t: (x["costs"][t], x["ranks"][t]) for t in _STATES if x["costs"][t] < _NEVER}
        end = min(best, key=lambda t: (best[t][0] + INSERT * len(_CLOSE[t]), best[t][1]))
        facts = {c: x[c] for c in ("blank", "duplicate", "truncated", "illegal")}
        yield facts | {"conv_id": x["conv_id"], "no": 0, "cost": best[end][0] + INSERT * len(_CLOSE[end]), "start": 0, "end": end, "final": True}

    facts = stage(_grouped(levels[-1], ["conv_id", "no"], root, f"{conv}, no long, blank long, duplicate long, truncated long, illegal long, cost long, start int, end int, final boolean"), "roots")
    ways = facts.select("conv_id", "no", "start", "end", "final")

    def down(group):
        x = group[0]
        for i, (y, (a, b)) in enumerate(zip(group, states_between([(y["costs"], y["ranks"]) for y in group], x["start"], x["end"]))):
            yield {"conv_id": y["conv_id"], "no": y["no"], "start": a, "end": b, "final": x["final"] and i == len(group) - 1}

    for level in reversed(levels[:-1]):
        above = ways.select(F.col("conv_id").alias("c"), F.col("no").alias("up"), "start", "end", "final")
        parts = level.withColumn("up", F.floor(F.col("no") / FAN)).alias("x").join(above.alias("y"), F.col("x.conv_id").eqNullSafe(F.col("y.c")) & (F.col("x.up") == F.col("y.up"))).select("x.*", "start", "end", "final")
        ways = stage(_grouped(parts, ["conv_id", "up"], down, f"{conv}, no long, start int, end int, final boolean"), "ways")

    def write(group):
        x = group[0]
        audit = search([(y["role"][:1], y["fault"], y["copies"]) for y in group], x["start"])[x["end"]][1]
        audit += _CLOSE[x["end"]] if x["final"] else ""
        repaired = apply(audit, [(y["role"], y["text"], y["copies"]) for y in group], x["start"])
        yield {"conv_id": x["conv_id"], "piece": x["seg"], "audit": audit, "repaired": [{"role": r, "text": t} for r, t in repaired]}

    ways = ways.select(F.col("conv_id").alias("c"), F.col("no").alias("s"), "start", "end", "final")
    told = cut.join(ways, cut["conv_id"].eqNullSafe(ways["c"]) & (cut["seg"] == ways["s"])).drop("c", "s")
    pieces = _grouped(told, ["conv_id", "seg"], write, f"{conv}, piece long, audit string, repaired {_REPAIRED}")
    turns = cut.select("conv_id", "turn").distinct().groupBy("conv_id").agg(F.coalesce((F.max("turn") - F.min("turn") + 1 - F.count("turn")).cast("long"), F.lit(0)).alias("gaps"))
    per_conv = facts.alias("f").join(turns.alias("t"), F.col("f.conv_id").eqNullSafe(F.col("t.conv_id"))).select(F.col("f.conv_id").alias("c"), *_FACTS)
    return pieces.join(per_conv, pieces["conv_id"].eqNullSafe(F.col("c"))).select(pieces["conv_id"], *_FACTS, "audit", "repaired", "piece", F.lit(False).alias("whole"))


def repair(rows: DataFrame, most_rows: int = MOST_ROWS, most_bytes: int = MOST_BYTES) -> DataFrame:
    """Cheapest repair of every conversation of ``rows(conv_id, turn, role, text, ...)``.

    Returns conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired (array of
    role and text), piece, whole: one row per conversation, or for one beyond ``most_rows`` or
    ``most_bytes`` several (``whole`` is false), in order of ``piece``, that share its numbers and
    have their part of audit and repaired each.

    * Rows are taken by turn, nulls first; rows of one turn by role, then text.  Null role and
      text count as one space.  A null conv_id is a conversation.
    * A row with a true ``gone`` (if there is such a boolean column) only names its conversation:
      one without other rows has zeros and an empty repair.
    * Edits: keep 0, rerole to user or assistant 1, delete 2 (blank and duplicate rows must be),
      insert an empty user or assistant 5; truncated rows that stay add 5.  Ties go to the least
      audit.  Repeated rows are duplicates.  An empty table gives an empty result; texts of any
      length and other columns are fine.
    """
    gone = rows["gone"] if dict(rows.dtypes).get("gone") == "boolean" else F.lit(False)
    rows = rows.select("conv_id", "turn", *[F.coalesce(rows[c].cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")], F.coalesce(gone, F.lit(False)).alias("gone"))
    sizes = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("role") + F.octet_length("text")).alias("bytes"))
    beyond = stage(sizes.where((F.col("n") > most_rows) | (F.col("bytes") > most_bytes)).withColumnRenamed("conv_id", "c"), "long")
    n, size = beyond.agg(F.sum("n"), F.sum("bytes")).first()
    one = {"piece": F.lit(0).cast("long"), "whole": F.lit(True)}
    if not n:
        return _short(rows).withColumns(one)
    mine = rows["conv_id"].eqNullSafe(beyond["c"])
    short = _short(rows.join(beyond, mine, "left_anti")).withColumns(one)
    long_rows = rows.join(beyond, mine, "left_semi")
    cut = _long(long_rows, 1 + n // most_rows + size // most_bytes)
    empty = long_rows.groupBy("conv_id").agg(F.min("gone").alias("all_gone")).where("all_gone")  # many rows, none left
    empty = empty.select("conv_id", *[F.lit(0).cast("long").alias(c) for c in _FACTS], F.lit("").alias("audit"), F.array().cast(_REPAIRED).alias("repaired"), *[v.alias(c) for c, v in one.items()])
    return short.unionByName(cut).unionByName(empty)


def digests(repaired: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``: conv_id, its numbers, the whole audit, and repaired_sha256 of the ``role:text`` lines.

    Pieces of a long conversation are hashed one after another, in order, without being held.
    """
    lines = F.array_join(F.transform("repaired", lambda x: F.concat(x["role"], F.lit(":"), x["text"])), "\n")
    rows = repaired.select("conv_id", *_FACTS, "audit", lines.alias("lines"), (F.size("repaired") > 0).alias("some"), "piece", "whole")
    short = rows.where("whole").select("conv_id", *_FACTS, "audit", F.sha2(F.col("lines").cast("binary"), 256).alias("repaired_sha256"))

    def run(batches):
        def stream():
            for batch in batches:
                yield from zip(*(batch.column(i).to_pylist() for i in range(len(_FACTS) + 4)))

        for conv, group in groupby(stream(), key=lambda r: r[0]):
            sha, audit, begun = hashlib.sha256(), [], False
            for row in group:
                *facts, part, text, some = row[1:]
                audit.append(part)
                if some:
                    sha.update((b"\n" if begun else b"") + text.encode())
                    begun = True
            columns = [pa.array([conv], conv_type), *(pa.array([f], pa.int64()) for f in facts), pa.array(["".join(audit)]), pa.array([sha.hexdigest()])]
            yield pa.RecordBatch.from_arrays(columns, ["conv_id", *_FACTS, "audit", "repaired_sha256"])

    conv_type = _arrow_type(repaired, "conv_id")
    pieces = rows.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "piece").drop("piece", "whole")
    return short.unionByName(bounded_batches(pieces).mapInArrow(run, short.schema))


def damage(conversations: DataFrame) -> DataFrame:
    """Rows of ``conversations(conv_id, turn, role, text)`` after the damage that crc32(conv_id:turn) % 20 deals.

    0 drops the row (kept with a true ``gone``), 1 empties its text, 2 removes ``.``, ``!`` and ``?``, 3
    repeats it, 4 makes its role user.  Nulls count as one space, for the checksum too.
    """
    c = conversations
    key = F.concat_ws(":", *[F.coalesce(c[x].cast("string"), F.lit(" ")) for x in ("conv_id", "turn")])
    rows = c.select("conv_id", "turn", *[F.coalesce(c[x].cast("string"), F.lit(" ")).alias(x) for x in ("role", "text")], (F.crc32(key.cast("binary")) % 20).alias("kind"))
    kind, text = F.col("kind"), F.col("text")
    bare = F.replace(F.replace(F.replace(text, F.lit("."), F.lit("")), F.lit("!"), F.lit("")), F.lit("?"), F.lit(""))
    rows = rows.withColumn("copy", F.explode(F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return rows.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(kind == 1, "").when(kind == 2, bare).otherwise(text).alias("text"), (kind == 0).alias("gone"),
    )


def op11_conversation_repair(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    return digests(repair(damage(table(spark, sf_dir, "conversations"))))


OP11_SQL = r"""
WITH RECURSIVE
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS bytes
  FROM conversations),
c AS (  -- CRC-32 bit by bit
  SELECT conv_id, turn, role, text,
         xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), bytes), lambda h, b:
           list_reduce(list_prepend(xor(h, b), CAST([1, 2, 3, 4, 5, 6, 7, 8] AS BIGINT[])), lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END))) % 20 AS kind
  FROM k),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM c WHERE kind <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS rn FROM d),
f AS (
  SELECT conv_id, turn, role, text, rn, left(role, 1) AS initial,
         lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY rn) || left(role, 1) AS pair,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY rn) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault
  FROM o),
ins(m, n, m2, added) AS (VALUES  -- insertions from a state, and the state after them
  (0, 0, 0, CAST([] AS VARCHAR[])), (1, 0, 1, []), (2, 0, 2, []), (3, 0, 3, []), (0, 1, 2, ['user:']), (1, 1, 2, ['user:']), (3, 1, 2, ['user:']), (2, 1, 3, ['assistant:']),
  (0, 2, 3, ['user:', 'assistant:']), (1, 2, 3, ['user:', 'assistant:']), (3, 2, 3, ['user:', 'assistant:']), (2, 2, 2, ['assistant:', 'user:'])),
step(m, initial, t) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (3, 'u', 2), (2, 'a', 3)),
e AS (  -- every edit of every row from every state
  SELECT conv_id, rn, m, m2 AS t, 5 * n + 2 AS cost, repeat('I', n) || 'D' AS word, added AS lines FROM f, ins
  UNION ALL
  SELECT conv_id, rn, i.m, s.t, 5 * n + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, repeat('I', n) || 'K', list_append(added, role || ':' || text)
  FROM f JOIN step s ON s.initial = f.initial JOIN ins i ON i.m2 = s.m WHERE fault IN ('', 'truncated')
  UNION ALL
  SELECT conv_id, rn, i.m, s.t, 5 * n + 1 + CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END, repeat('I', n) || 'R', list_append(added, CASE s.initial WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text)
  FROM f, step s JOIN ins i ON i.m2 = s.m WHERE fault IN ('', 'truncated') AND s.initial <> 's'),
best AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS rn, 0 AS t, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} AS x FROM f
  UNION ALL
  SELECT b.conv_id, b.rn + 1, e.t, min({'cost': CAST(b.x.cost + e.cost AS BIGINT), 'audit': b.x.audit || e.word, 'lines': list_concat(b.x.lines, e.lines)})
  FROM best b JOIN e ON e.conv_id IS NOT DISTINCT FROM b.conv_id AND e.rn = b.rn + 1 AND e.m = b.t GROUP BY b.conv_id, b.rn, e.t),
n AS (
  SELECT conv_id, max(rn) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank,
         count(*) FILTER (WHERE fault = 'duplicate') AS duplicate, count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM f GROUP BY conv_id),
r AS (
  SELECT n.conv_id, any_value(gaps) AS gaps, any_value(blank) AS blank, any_value(duplicate) AS duplicate, any_value(truncated) AS truncated, any_value(illegal) AS illegal,
         min({'cost': x.cost + 5 * i.n, 'audit': x.audit || repeat('I', i.n), 'lines': list_concat(x.lines, i.added)}) AS x
  FROM n JOIN best b ON b.conv_id IS NOT DISTINCT FROM n.conv_id AND b.rn = n.rows JOIN ins i ON i.m = b.t AND (i.m2 = 3 OR i.m2 = 0) GROUP BY n.conv_id)
SELECT a.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(x.cost, 0) AS cost, coalesce(x.audit, '') AS audit, sha256(coalesce(array_to_string(x.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM a.conv_id
"""
