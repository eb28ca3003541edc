"""Secret scans over an incremental blob ledger.

Every version of every text is addressed by its SHA-256.  A blob is scanned once per rule
version: pairs that the ledger already holds are left out, and the findings of a blob are
joined back to all paths (rows) that carry it.  Everything is DataFrame code.

The ledger holds one row per (blob_id, rule, version) with its spans, also for blobs without
a finding, so that the next run knows they were scanned.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..staging import stage
from .textcols import whole


@dataclass(frozen=True)
class Rule:
    """``group``'s match must have ``least`` characters; failing matches still consume text."""

    name: str
    version: int
    pattern: str
    group: int
    least: int


#: The base kinds, in their order.  Their letters are ASCII in either case
#: where the kind says so, hence explicit classes instead of a case-folding flag.
_KEYWORD = "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
BASE_RULES = (
    Rule("assign", 1, rf"({_KEYWORD})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 6),
    Rule("access", 1, r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", 1, r"[0-9a-f]{24,}", 0, 24),
)

#: Ids of new blobs that are broadcast at most, about 100 bytes each.
BROADCAST_BLOBS = 500_000
LEDGER_SCHEMA = "blob_id binary, rule string, version int, spans array<struct<start:long,end:long>>"


def _matches(rule: Rule):
    """All matches of one rule as array<struct<lead,len,ok>>: text before it, its length, kept or not."""
    text, rx = F.col("text"), F.lit(rule.pattern)
    lead = F.transform(F.split(text, rule.pattern, -1), F.length)
    size = F.transform(F.regexp_extract_all(text, rx, F.lit(0)), F.length)
    kept = size if rule.group == 0 else F.transform(F.regexp_extract_all(text, rx, F.lit(rule.group)), F.length)
    found = F.transform(
        F.filter(F.arrays_zip(lead.alias("lead"), size.alias("len"), kept.alias("part")), lambda x: x["len"].isNotNull()),
        lambda x: F.struct(x["lead"].alias("lead"), x["len"].alias("len"), (x["part"] >= rule.least).alias("ok")),
    )
    return F.when(F.col("text").rlike(rule.pattern), found)


def _blob_id(text):
    return F.unhex(F.sha2(text.cast("binary"), 256))


def pairs_to_scan(versions: DataFrame, ledger: DataFrame, rules) -> DataFrame:
    """Blobs of ``versions(text)`` with pairs that the ledger lacks, without their texts: blob_id, todo."""
    every = F.array(*[F.lit(f"{r.name}@{r.version}") for r in rules])
    ids = versions.select(_blob_id(F.col("text")).alias("blob_id")).distinct()
    done = ledger.groupBy("blob_id").agg(F.collect_set(F.concat_ws("@", "rule", F.col("version").cast("string"))).alias("done"))
    todo = F.array_except(every, F.coalesce("done", F.array().cast("array<string>")))
    return ids.join(done, "blob_id", "left").select("blob_id", todo.alias("todo")).where(F.size("todo") > 0)


def new_blobs(versions: DataFrame, ledger: DataFrame | None, rules, broadcast_blobs: int = BROADCAST_BLOBS) -> DataFrame:
    """Distinct texts of ``versions(text)`` with the rules still to run: blob_id, text, todo.

    Which pairs are new is decided on ids.  Up to ``broadcast_blobs`` of them are sent to the
    texts, so that only texts to be scanned are moved; with more of them texts and ids are
    dealt by blob_id, as they are without a ledger.
    """
    rows = versions.select(_blob_id(F.col("text")).alias("blob_id"), "text")
    if ledger is None:
        todo = F.array(*[F.lit(f"{r.name}@{r.version}") for r in rules])
        # the map side of this aggregate leaves one row per task of a text with many copies
        return rows.groupBy("blob_id", "text").agg(F.lit(1).alias("__one")).select("blob_id", "text", todo.alias("todo"))
    new = stage(pairs_to_scan(versions, ledger, rules), "unseen")
    new = F.broadcast(new) if new.count() <= broadcast_blobs else new
    return rows.join(new, "blob_id").groupBy("blob_id", "text", "todo").agg(F.lit(1).alias("__one")).select("blob_id", "text", "todo")


def _positions(blobs: DataFrame, rules) -> DataFrame:
    """All matches of the blobs by blob_id: todo, kind_no, start, end, ok; a blob without a match has one row of nulls.

    Texts end here: what follows is narrow and dealt by blob_id once.
    """
    def numbered(no: int, rule: Rule):
        rows = F.transform(_matches(rule), lambda m, k: F.struct(F.lit(no).alias("kind_no"), k.alias("k"), m["lead"].alias("lead"), m["len"].alias("len"), m["ok"].alias("ok")))
        return F.when(F.array_contains("todo", f"{rule.name}@{rule.version}"), rows)

    empty = F.array().cast("array<struct<kind_no:int,k:int,lead:int,len:int,ok:boolean>>")
    every = F.concat(*[F.coalesce(numbered(i, r), empty) for i, r in enumerate(rules)])
    rows = blobs.select("blob_id", "todo", F.explode_outer(every).alias("m")).select("blob_id", "todo", "m.*").repartition("blob_id")
    # the pieces between matches add up to positions; the sum runs over one rule of one text
    end = F.sum((F.col("lead") + F.col("len")).cast("long")).over(Window.partitionBy("blob_id", "kind_no").orderBy("k"))
    return rows.withColumn("end", end).select("blob_id", "todo", "kind_no", (F.col("end") - F.col("len")).alias("start"), "end", "ok")


def scan_blobs(blobs: DataFrame, rules=BASE_RULES) -> DataFrame:
    """Findings of blobs that have any: blob_id, rule, kind_no, start, end (code points, end exclusive)."""
    names = F.array(*[F.lit(r.name) for r in rules])
    return _positions(blobs, rules).where("ok").select("blob_id", F.get(names, F.col("kind_no")).alias("rule"), "kind_no", "start", "end")


def update_ledger(versions: DataFrame, ledger: DataFrame | None = None, rules=BASE_RULES) -> DataFrame:
    """Ledger rows of the pairs that ``ledger`` lacks, to be appended to it.

    ``versions`` has any columns and ``text``; null texts count as empty, repeated texts are
    one blob, texts of any length are scanned whole.  A text is read and moved once.
    """
    rows = versions.select(whole(versions["text"]).alias("text"))
    found = _positions(new_blobs(rows, ledger, rules), rules)
    hit = F.when(F.col("ok"), F.struct("kind_no", "start", "end"))
    blobs = found.groupBy("blob_id", "todo").agg(F.collect_list(hit).alias("hits"))
    names = F.array(*[F.lit(f"{r.name}@{r.version}") for r in rules])
    pairs = blobs.select("blob_id", "hits", F.explode("todo").alias("pair")).withColumn("no", F.array_position(names, F.col("pair")) - 1)
    mine = F.transform(F.filter("hits", lambda h: h["kind_no"] == F.col("no")), lambda h: F.struct(h["start"].alias("start"), h["end"].alias("end")))
    return pairs.select("blob_id", F.substring_index("pair", "@", 1).alias("rule"), F.substring_index("pair", "@", -1).cast("int").alias("version"), F.array_sort(mine).alias("spans"))


def paths_with_spans(versions: DataFrame, ledger: DataFrame, rules=BASE_RULES) -> DataFrame:
    """Findings of a ledger joined back to all rows of ``versions``: its columns plus rule, start, end."""
    live = reduce(lambda a, b: a | b, [(F.col("rule") == r.name) & (F.col("version") == r.version) for r in rules])
    hits = ledger.where(live & (F.size("spans") > 0)).select("blob_id", "rule", F.explode("spans").alias("s")).select("blob_id", "rule", "s.start", "s.end")
    addressed = versions.withColumn("blob_id", _blob_id(whole(versions["text"])))
    return addressed.join(hits, "blob_id").drop("blob_id")


def deliveries(docs: DataFrame) -> list[DataFrame]:
    """``docs(doc_id, text)`` as a history of two versions of the corpus: ids up to the middle of their range, then all rows."""
    first, last = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return [docs] if first is None or first == last else [docs.where(F.col("doc_id") <= first + (last - first) // 2), docs]


def ledger_of(history, rules=BASE_RULES) -> DataFrame:
    """The stored ledger of several versions of a corpus, each scanned only for what the ones before have not shown."""
    stored = None
    for versions in history:
        more = stage(update_ledger(versions, stored, rules), "ledger")
        stored = more if stored is None else stored.unionByName(more)
    return stored


def scan(docs: DataFrame, rules=BASE_RULES) -> DataFrame:
    """Spans of every row of ``docs(doc_id, text, ...)``, read from the ledger of its ``deliveries``.

    Returns doc_id, n_<rule> per rule, base_sha256, spans.  Null or empty text has no span;
    repeated rows each get their spans; texts of any length are scanned whole; an empty table
    gives an empty result; other columns are ignored.  doc_id is a whole number.
    """
    docs = docs.select("doc_id", whole(docs["text"]).alias("text"))
    ledger = ledger_of(deliveries(docs), rules)
    counts = [F.sum(F.when(F.col("rule") == r.name, F.size("spans")).otherwise(0)).alias(f"n_{r.name}") for r in rules]
    kind = F.array_position(F.array(*[F.lit(r.name) for r in rules]), F.col("rule"))
    named = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), F.col("kind_no"), s["end"].alias("end"), F.col("rule")))
    listed = F.array_sort(F.flatten(F.collect_list(named)))
    blobs = ledger.where(F.size("spans") > 0).withColumn("kind_no", kind).groupBy("blob_id").agg(*counts, listed.alias("l")).withColumn(
        "spans", F.array_join(F.transform("l", lambda x: F.concat_ws(":", x["rule"], x["start"].cast("string"), x["end"].cast("string"))), ",")
    ).drop("l")
    rows = docs.select("doc_id", _blob_id(F.col("text")).alias("blob_id"))
    spans = F.coalesce("spans", F.lit(""))
    return rows.join(blobs, "blob_id", "left").select(
        "doc_id", *[F.coalesce(f"n_{r.name}", F.lit(0)).cast("long").alias(f"n_{r.name}") for r in rules],
        F.sha2(spans.cast("binary"), 256).alias("base_sha256"), spans.alias("spans"),
    )


def op3_secret_scan(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    return scan(table(spark, sf_dir, "documents"))


def _kind_sql(rule: Rule, no: int) -> str:
    rx = rule.pattern.replace("'", "''")
    return f"""
  SELECT doc_id, {no} AS kind_no, '{rule.name}' AS kind, p AS len, q AS part,
         sum(lead + p) OVER (PARTITION BY rid ORDER BY k) AS e
  FROM (SELECT rid, doc_id, unnest(list_transform(regexp_extract_all(text, '{rx}'), lambda x: length(x))) AS p,
               unnest(list_transform(regexp_extract_all(text, '{rx}', {rule.group}), lambda x: length(x))) AS q,
               unnest(list_transform(string_split_regex(text, '{rx}')[:-2], lambda x: length(x))) AS lead,
               generate_subscripts(regexp_extract_all(text, '{rx}'), 1) AS k
        FROM d WHERE regexp_matches(text, '{rx}'))
  QUALIFY q >= {rule.least}"""


OP3_SQL = (
    "WITH d AS (SELECT doc_id, row_number() OVER () AS rid, coalesce(text, '') AS text FROM documents),\nm AS ("
    + "\nUNION ALL".join(_kind_sql(r, i) for i, r in enumerate(BASE_RULES))
    + """),
s AS (
  SELECT doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access,
         count(*) FILTER (WHERE kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(e - len AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY e - len, kind_no) AS spans
  FROM m GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN s ON s.doc_id = d.doc_id
"""
)
