"""Data-quality constraints of a table, all checked in one job.

Violations of every kind meet in one relation (rule, what broke it) and one aggregate, with a
bounded number of examples per rule: the smallest, so that reruns show the same.  A task keeps
those of its rows as they pass; values are counted in as many tasks as the session has shuffle partitions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class NotNull:
    column: str

    @property
    def name(self) -> str:
        return f"{self.column} not null"


@dataclass(frozen=True)
class Holds:
    """A condition that every row must meet; null counts as met, as in SQL."""

    name: str
    condition: Column


@dataclass(frozen=True)
class Within:
    """Values that a column may have, null included."""

    column: str
    values: tuple

    @property
    def name(self) -> str:
        return f"{self.column} in its domain"


@dataclass(frozen=True)
class Unique:
    """Columns that no two rows share; rows with a null in them share nothing."""

    columns: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"{', '.join(self.columns)} unique"


@dataclass(frozen=True)
class Refers:
    """Columns whose values, unless one is null, are in ``other``."""

    columns: tuple[str, ...]
    other: DataFrame
    keys: tuple[str, ...]
    label: str = "its reference"

    @property
    def name(self) -> str:
        return f"{', '.join(self.columns)} in {self.label}"


def _shown(rows: DataFrame, columns) -> Column:
    return F.concat_ws("/", *[F.coalesce(rows[c].cast("string"), F.lit("null")) for c in columns])


def _values(rows: DataFrame, columns) -> tuple[DataFrame, list[str]]:
    """The columns under names of our own, where none is null."""
    names = [f"value_{i}" for i in range(len(columns))]
    return rows.select(*[rows[c].alias(n) for c, n in zip(columns, names)]).where(" and ".join(f"{n} is not null" for n in names)), names


def _counted(values: DataFrame, names: list[str]) -> DataFrame:
    """The values and ``n``, how many rows have each.

    Nearly every value may be its own: a map of those of a whole split or of a merged partition is large.  So
    rows are dealt over a fixed number of tasks, twice: by value and split, where a value with most of the rows
    becomes one row a task, then by value.  The number given keeps partitions from being merged.
    """
    tasks = int(values.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = values.withColumn("split", F.spark_partition_id()).repartition(tasks, *names, "split")
    some = dealt.groupBy(*names, "split").agg(F.count(F.lit(1)).alias("n"))
    return some.select(*names, "n").repartition(tasks, *names).groupBy(*names).agg(F.sum("n").alias("n"))


def _broken(rows: DataFrame, key: list[str], rules) -> DataFrame:
    """rule (its place in ``rules``), example, n: a row for each violation, or for each repeated or lost value."""
    out, by_row, counts = [], [], {}
    for i, r in enumerate(rules):
        if isinstance(r, NotNull):
            by_row.append((i, rows[r.column].isNull()))
        elif isinstance(r, Holds):
            by_row.append((i, ~r.condition))
        elif isinstance(r, Within):
            by_row.append((i, ~rows[r.column].isin(*r.values)))
        elif r.columns not in counts:
            values, names = _values(rows, r.columns)
            counts[r.columns] = _counted(values, names), names
    if by_row:  # one pass for all of them
        marks = F.array_compact(F.array(*[F.when(bad, F.lit(i)) for i, bad in by_row]))
        out.append(rows.select(marks.alias("rules"), _shown(rows, key).alias("example")).select(F.explode("rules").alias("rule"), "example", F.lit(1).cast("long").alias("n")))
    for i, r in enumerate(rules):
        if isinstance(r, Unique):
            used, names = counts[r.columns]
            bad = used.where("n > 1")
        elif isinstance(r, Refers):
            used, names = counts[r.columns]  # a value is looked up once, however many rows have it
            there = r.other.select(*[F.col(k).alias(f"there_{j}") for j, k in enumerate(r.keys)])
            bad = used.join(there, reduce(lambda a, b: a & b, [F.col(c) == F.col(f"there_{j}") for j, c in enumerate(names)]), "left_anti")
        else:
            continue
        out.append(bad.select(F.lit(i).alias("rule"), _shown(bad, names).alias("example"), "n"))
    return reduce(DataFrame.unionByName, out)


def _smallest(examples: int):
    """For mapInArrow: of each rule the sum of ``n`` and the smallest different examples of a task, which holds no more than these."""

    def run(batches):
        n, least = {}, {}
        for batch in batches:
            for rule in batch["rule"].unique().to_pylist():
                of = batch.filter(pc.equal(batch["rule"], rule))
                n[rule] = n.get(rule, 0) + pc.sum(of["n"]).as_py()
                had, seen = least.get(rule, []), of["example"]
                if had and len(had) == examples:
                    seen = seen.filter(pc.less(seen, had[-1]))
                seen = seen.unique()
                least[rule] = sorted({*had, *seen.take(pc.array_sort_indices(seen)[:examples]).to_pylist()})[:examples]
        yield pa.RecordBatch.from_pydict(
            {"rule": pa.array(n.keys(), pa.int32()), "n": pa.array(n.values(), pa.int64()), "examples": pa.array([least[r] for r in n], pa.list_(pa.string()))}
        )

    return run


def violations(rows: DataFrame, key: list[str], rules, examples: int = 3) -> DataFrame:
    """A row for each rule that is broken: rule, n (rows that break it), examples (the smallest, at most so many).

    Examples of rules on single rows are keys, of the others the values.  Repeated rows count
    as many; an empty table breaks nothing; without rules that are broken the result is empty.
    """
    few = _broken(rows, key, rules).mapInArrow(_smallest(examples), "rule int, n long, examples array<string>")  # a row for each rule and task
    few = few.withColumn("rule", F.get(F.array(*[F.lit(r.name) for r in rules]), F.col("rule")))
    least = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("examples")))), 1, examples)
    return few.groupBy("rule").agg(F.sum("n").alias("n"), least.alias("examples"))


def require(rows: DataFrame, key: list[str], rules, what: str) -> None:
    """Raises a ValueError that lists the broken rules, if any are."""
    bad = violations(rows, key, rules).orderBy("rule").limit(50).collect()
    if bad:
        raise ValueError(f"{what}: " + "; ".join(f"{r.rule}: {r.n} rows, such as {', '.join(r.examples)}" for r in bad))
