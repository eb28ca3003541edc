"""Quality classifier: a sparse rule ensemble.

Boosted trees over text statistics propose conjunctive rules, one for each path from a root
to a node; lasso logistic regression keeps a few of them (and a few linear terms) with
weights; the kept rules are compiled into one Spark column expression.  The model is fitted
on the driver from at most ``max_rows`` labelled rows, drawn by hash; scoring covers every
row where it is read and shuffles nothing.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrowio import bounded_batches, pieces
from .textcols import free_prefix, whole
from .textstats import NAMES, stats

MAX_ROWS = 20_000


# ---------------------------------------------------------------- trees


def _split(x: np.ndarray, g: np.ndarray, h: np.ndarray, bins: list[np.ndarray], lam: float, least: int):
    """Best (gain, feature, cut) of one node by binned second-order gain."""
    best = (1e-9, -1, 0.0)
    total_g, total_h, n = g.sum(), h.sum(), len(g)
    base = total_g**2 / (total_h + lam)
    for f, cuts in enumerate(bins):
        if not len(cuts):
            continue
        at = np.searchsorted(cuts, x[:, f], side="left")
        gs, hs, ns = (np.cumsum(np.bincount(at, weights=w, minlength=len(cuts) + 1))[:-1] for w in (g, h, np.ones(n)))
        gain = gs**2 / (hs + lam) + (total_g - gs) ** 2 / (total_h - hs + lam) - base
        gain[(ns < least) | (n - ns < least)] = 0
        k = int(np.argmax(gain))
        if gain[k] > best[0]:
            best = (float(gain[k]), f, float(cuts[k]))
    return best


def boosted_paths(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 3, rate: float = 0.2, least: int = 8, share: float = 0.6, seed: int = 7, weight: np.ndarray | None = None):
    """Paths of gradient-boosted trees: tuples of (feature, 'le' or 'gt', cut)."""
    rng = np.random.default_rng(seed)
    w = np.ones(len(y)) if weight is None else weight
    bins = [np.unique(np.quantile(c, np.linspace(0.02, 0.98, 33))) for c in x.T]
    score, paths = np.zeros(len(y)), {}

    def grow(rows, all_rows, path, left):
        if path:
            paths[path] = None
        p = 1 / (1 + np.exp(-score[rows]))
        g, h = w[rows] * (p - y[rows]), w[rows] * p * (1 - p)
        gain, f, cut = _split(x[rows], g, h, bins, 1.0, least) if left and len(rows) >= 2 * least else (0, -1, 0)
        if f < 0:
            step[all_rows] -= rate * g.sum() / (h.sum() + 1.0)
            return
        for side in ("le", "gt"):
            keep = (lambda r: x[r, f] <= cut) if side == "le" else (lambda r: x[r, f] > cut)
            grow(rows[keep(rows)], all_rows[keep(all_rows)], (*path, (f, side, cut)), left - 1)

    for _ in range(trees):
        step = np.zeros(len(y))
        grow(np.flatnonzero(rng.random(len(y)) < share), np.arange(len(y)), (), depth)
        score += step
    return list(paths)


def holds(x: np.ndarray, path) -> np.ndarray:
    return reduce(np.logical_and, ((x[:, f] <= c) if side == "le" else (x[:, f] > c) for f, side, c in path))


# ---------------------------------------------------------------- lasso


def lasso_logistic(z: np.ndarray, y: np.ndarray, lam: float, steps: int = 400, weight: np.ndarray | None = None) -> tuple[float, np.ndarray]:
    """(intercept, weights) by accelerated proximal gradient; the intercept is not penalised."""
    n, k = z.shape
    s = (np.ones(n) if weight is None else weight) / n
    a = np.hstack([np.ones((n, 1)), z])
    v = np.ones(k + 1)
    for _ in range(20):  # largest eigenvalue, for the step size
        v = a.T @ (s * (a @ v))
        v /= np.linalg.norm(v)
    lip = 0.25 * float(v @ (a.T @ (s * (a @ v)))) * 1.05 + 1e-12
    w = u = np.zeros(k + 1)
    t = 1.0
    for _ in range(steps):
        new = u - a.T @ (s * (1 / (1 + np.exp(-(a @ u))) - y)) / lip
        new[1:] = np.sign(new[1:]) * np.maximum(np.abs(new[1:]) - lam / lip, 0)
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        u = new + (t - 1) / t2 * (new - w)
        w, t = new, t2
    return float(w[0]), w[1:]


# ---------------------------------------------------------------- model


@dataclass(frozen=True)
class RuleModel:
    """score = sigmoid(bias + sum of weights of the rules that hold + linear terms)."""

    bias: float
    rules: tuple  # (path, weight)
    linear: tuple  # (feature, low, high, centre, scale, weight)

    def predict(self, x: np.ndarray) -> np.ndarray:
        z = np.full(len(x), self.bias)
        for path, w in self.rules:
            z += w * holds(x, path)
        for f, low, high, centre, scale, w in self.linear:
            z += w * (np.clip(x[:, f], low, high) - centre) / scale
        return 1 / (1 + np.exp(-z))

    def column_of(self, name: str) -> Column:
        """The same as an expression over the fields of the struct column ``name``."""
        return self._compiled([F.col(name)[n] for n in NAMES])

    def _compiled(self, stat: list[Column]) -> Column:
        z = F.lit(self.bias)
        for path, w in self.rules:
            tests = [(stat[f] <= c) if side == "le" else (stat[f] > c) for f, side, c in path]
            z = z + F.when(reduce(lambda a, b: a & b, tests), F.lit(w)).otherwise(F.lit(0.0))
        for f, low, high, centre, scale, w in self.linear:
            z = z + (F.greatest(F.lit(low), F.least(F.lit(high), stat[f])) - F.lit(centre)) * F.lit(w / scale)
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def fit(x: np.ndarray, y: np.ndarray, lam: float = 0.002) -> RuleModel:
    """Rule ensemble of statistics ``x`` (columns NAMES) and labels ``y`` (0 or 1).

    With one class only, or no rows, the score is the smoothed share of label 1 everywhere.
    """
    n, ones = len(y), float(y.sum())
    if n < 20 or ones in (0.0, float(n)):
        p = (ones + 1) / (n + 2)
        return RuleModel(float(np.log(p / (1 - p))), (), ())
    paths, z, seen = boosted_paths(x, y), [], set()
    kept = []
    for path in paths:
        col = holds(x, path)
        key = col.tobytes()
        if 0.003 * n < col.sum() < 0.997 * n and key not in seen:
            seen.add(key)
            kept.append(path)
            z.append(col.astype(float))
    low, high = np.quantile(x, 0.025, axis=0), np.quantile(x, 0.975, axis=0)
    wins = np.clip(x, low, high)
    centre, scale = wins.mean(0), np.maximum(wins.std(0), 1e-9) / 0.4
    flat = wins.std(0) <= 1e-9
    a = np.hstack([np.array(z).T.reshape(n, len(z)), np.where(flat, 0, (wins - centre) / scale)])
    bias, w = lasso_logistic(a, y, lam)
    rules = tuple((p, float(v)) for p, v in zip(kept, w) if abs(v) > 1e-6)
    linear = tuple((f, float(low[f]), float(high[f]), float(centre[f]), float(scale[f]), float(v)) for f, v in enumerate(w[len(kept) :]) if abs(v) > 1e-6)
    return RuleModel(bias, rules, linear)


# ---------------------------------------------------------------- Spark


def with_stats(docs: DataFrame, name: str = "__stats") -> DataFrame:
    """``docs`` and a struct column of the statistics of ``text`` (null: empty), all else as it was."""
    place = docs.columns.index("text")
    fields = pa.struct([(n, pa.float64()) for n in NAMES])

    def add(batches):
        for batch in batches:
            for b in pieces(batch, place):
                x = np.array([stats(t or "") for t in b.column(place).to_pylist()], dtype=np.float64).reshape(-1, len(NAMES))
                st = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(x[:, i])) for i in range(len(NAMES))], fields=list(fields))
                yield pa.RecordBatch.from_arrays([*b.columns, st], [*b.schema.names, name])

    kind = T.StructType([T.StructField(n, T.DoubleType()) for n in NAMES])
    return bounded_batches(docs).mapInArrow(add, T.StructType([*docs.schema.fields, T.StructField(name, kind)]))


def train(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> RuleModel:
    """Fit on at most ``max_rows`` rows of ``labels(doc_id, quality)``, those of smallest hash.

    Rows without an id, a label, or a document are left out; of contradicting labels of one
    id the smaller counts, and of texts that share an id the shortest, then the first by code
    point, so that there is one row of each id and reruns learn the same.
    """
    drawn = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy("doc_id").agg(F.min("quality").cast("int").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_rows)
    )
    rows = docs.select("doc_id", whole(docs["text"]).alias("text")).join(F.broadcast(drawn), "doc_id")  # at most ``max_rows`` rows of 12 bytes
    rows = rows.groupBy("doc_id", "quality").agg(F.min(F.struct(F.length("text"), "text")).alias("t")).select("doc_id", "quality", F.col("t.text").alias("text"))
    got = with_stats(rows, "st").select("doc_id", "quality", "st").collect()  # one row of each drawn id
    got.sort(key=lambda r: r["doc_id"])
    x = np.array([tuple(r["st"]) for r in got], dtype=float).reshape(-1, len(NAMES))
    return fit(x, np.array([r["quality"] for r in got], dtype=float))


def score(docs: DataFrame, model: RuleModel) -> DataFrame:
    """``docs`` with a column ``score`` in place of any it had: 0 to 1, higher means label 1 likelier."""
    name = f"{free_prefix(docs)}stats"
    return with_stats(docs.drop("score"), name).withColumn("score", model.column_of(name)).drop(name)


def in_split(doc_id: Column, mod: int, remainder: int) -> Column:
    """Is crc32 of the id as text in this class?  A null id is in none."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % mod == remainder, F.lit(False))


def classify(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of ``docs(doc_id, text, ...)``.

    Only labels of rows that are not held out (crc32 of the id mod 3 is 1) are learned from.
    Null and empty texts are scored by the statistics of an empty text; repeated rows alike;
    a text of any length is read whole; a score of exactly 0.5 is predicted 1; without usable
    labels the score is 0.5; an empty table gives an empty result; other columns are never read.
    """
    rows = docs.select("doc_id", "text")
    model = train(rows, labels.where(~in_split(F.col("doc_id"), 3, 1)), max_rows)
    out = score(rows, model)
    return out.select("doc_id", in_split(F.col("doc_id"), 3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op5_rule_quality(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
