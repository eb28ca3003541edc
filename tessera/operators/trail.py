"""Row counts along a plan, taken by the run that writes its result."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class CountTrail:
    """Counts at named steps of a plan.

    ``mark`` passes rows through and counts them as they go by: no job, no exchange and no
    second reading.  The counts are there once an action has run the plan to its end, and are
    those of that run.  A step that an action leaves out (a limit that stops early, a branch
    that is pruned) has counted what went by.
    """

    def __init__(self):
        self._steps: list[tuple[str, Observation]] = []

    def mark(self, rows: DataFrame, step: str, **conditions: Column) -> DataFrame:
        """``rows``, counted under ``step``, and under ``step.name`` those that meet each condition."""
        seen = Observation(f"{len(self._steps)} {step}")
        self._steps.append((step, seen))
        return rows.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in conditions.items()])

    def counts(self) -> list[tuple[str, int]]:
        """(step, rows) in the order of the marks; waits for the action that runs the plan."""
        out = []
        for step, seen in self._steps:
            for name, n in seen.get.items():
                out.append((step if name == "rows" else f"{step}.{name}", n))
        return out

    def table(self, spark: SparkSession) -> DataFrame:
        """The counts as rows: place, step, n, and the percent of the step before that is left."""
        rows, before = [], None
        for i, (step, n) in enumerate(self.counts()):
            kept = None if before in (None, 0) or "." in step else round(100.0 * n / before, 1)
            rows.append((i, step, n, kept))
            before = n if "." not in step else before
        return spark.createDataFrame(rows, "place int, step string, n long, kept double")
