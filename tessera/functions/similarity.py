"""Jaro-Winkler similarity, computed over arrays of pairs, and the lossless bounds that spare most pairs the measure."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StructField, StructType


def jaro(a: str, b: str) -> float:
    if not a or not b:
        return 0.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used, hits = [False] * len(b), []
    for i, ch in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == ch:
                used[j] = True
                hits.append(ch)
                break
    m = len(hits)
    if not m:
        return 0.0
    swaps = sum(x != y for x, y in zip(hits, (b[j] for j in range(len(b)) if used[j]))) // 2
    return (m / len(a) + m / len(b) + (m - swaps) / m) / 3


def jaro_winkler(a: str, b: str) -> float:
    """Jaro, raised by a tenth of the rest for each of up to four common first letters if it is over 0.7."""
    s = jaro(a, b)
    if s <= 0.7:
        return s
    common = 0
    for x, y in zip(a[:4], b[:4]):
        if x != y:
            break
        common += 1
    return s + 0.1 * common * (1 - s)


def _codes(texts: list[str], pad: int) -> np.ndarray:
    """Code points of the texts, one a row, padded on the right."""
    wide = max(map(len, texts), default=0)
    return np.frombuffer("".join(t.ljust(wide, chr(pad)) for t in texts).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(texts), wide)


def jaro_winkler_pairs(a: list[str], b: list[str]) -> np.ndarray:
    """``jaro_winkler`` of each pair, all pairs at once: one step for each position of the longest text."""
    la, lb = np.array([len(x) for x in a]), np.array([len(x) for x in b])
    x, y = _codes(a, 0xFFFFE), _codes(b, 0xFFFFF)  # noncharacters: they equal nothing
    reach = np.maximum(np.maximum(la, lb) // 2 - 1, 0)[:, None]
    place, row = np.arange(y.shape[1]), np.arange(len(a))
    used, hit = np.zeros(y.shape, bool), np.zeros(x.shape, bool)
    for i in range(x.shape[1]):
        ok = (y == x[:, i : i + 1]) & ~used & (np.abs(place - i) <= reach)
        hit[:, i] = ok.any(1)
        used[row, ok.argmax(1) if y.shape[1] else 0] |= hit[:, i]
    m = hit.sum(1)
    width = min(x.shape[1], y.shape[1])
    first = lambda codes, on: np.take_along_axis(codes, np.argsort(~on, axis=1, kind="stable"), 1)[:, :width]
    swaps = ((first(x, hit) != first(y, used)) & (np.arange(width) < m[:, None])).sum(1) // 2
    with np.errstate(divide="ignore", invalid="ignore"):
        s = np.where(m > 0, (m / la + m / lb + (m - swaps) / m) / 3, 0.0)
    head = min(4, width)
    common = np.cumprod(x[:, :head] == y[:, :head], axis=1).sum(1)
    return np.where(s > 0.7, s + 0.1 * common * (1 - s), s)


@F.pandas_udf(DoubleType())
def jaro_winkler_similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    out = np.full(len(a), np.nan)
    size = (a.str.len() + b.str.len()).to_numpy(float)
    order = np.argsort(size, kind="stable")[: np.count_nonzero(~np.isnan(size))]  # alike long ones share a block; nulls stay null
    at = 0
    while at < len(order):
        many = max(1, int(1_000_000 // max(1.0, size[order[min(len(order) - 1, at + 4096)]])))
        some = order[at : at + many]
        out[some] = jaro_winkler_pairs(a.iloc[some].tolist(), b.iloc[some].tolist())
        at += many
    return pd.Series(out).astype("Float64").where(~np.isnan(out), None) if np.isnan(out).any() else pd.Series(out)


#: Classes of letters and how often one is counted: 3 x 42 bits, in two whole numbers.
_CLASSES, _TIMES = 42, 3
_SKETCH = StructType([StructField(n, LongType() if n in ("lo", "hi") else IntegerType()) for n in ("size", "lo", "hi", "more", "h0", "h1", "h2", "h3")])


@F.pandas_udf(_SKETCH)
def letter_sketch(texts: pd.Series) -> pd.DataFrame:
    """What the bounds need of a text: its length, its letters by class (those beyond ``_TIMES`` counted apart), its first four."""
    size = texts.str.len().fillna(0).to_numpy(np.int64)
    n = len(size)
    codes = np.frombuffer("".join(texts.fillna("")).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    row = np.repeat(np.arange(n), size)
    counts = np.bincount(row * _CLASSES + codes % _CLASSES, minlength=n * _CLASSES).reshape(n, _CLASSES)
    bits = (counts[:, :, None] > np.arange(_TIMES)).reshape(n, 2, -1)
    value = 1 << np.arange(bits.shape[2], dtype=np.int64)
    out = {"size": size, "lo": bits[:, 0] @ value, "hi": bits[:, 1] @ value, "more": np.maximum(counts - _TIMES, 0).sum(1)}
    start = np.cumsum(size) - size
    for i in range(4):
        has = size > i
        out[f"h{i}"] = np.where(has, codes[np.where(has, start + i, 0)] if len(codes) else 0, -1)
    return pd.DataFrame(out).astype({"size": "int32", "more": "int32", **{f"h{i}": "int32" for i in range(4)}})


def may_reach(a: Column, b: Column, least: float = 0.9) -> Column:
    """False only where sketches of two texts alone keep their similarity under ``least``; nothing but whole numbers is compared.

    With p common first letters a similarity of s needs jaro j with j + 0.1 p (1 - j) >= s.  Jaro is
    at most (m / |a| + m / |b| + 1) / 3 for m matching letters, of which there are at most as many as
    the texts have in common, class by class.
    """
    common = F.bit_count(a["lo"].bitwiseAND(b["lo"])) + F.bit_count(a["hi"].bitwiseAND(b["hi"])) + F.least(a["more"], b["more"])
    total, product = a["size"] + b["size"], a["size"] * b["size"]
    need = [3 * max((least - 0.1 * p) / (1 - 0.1 * p), 0.0) - 1 - 1e-9 for p in range(5)]
    same = [(a[f"h{i}"] == b[f"h{i}"]) & (a[f"h{i}"] >= 0) for i in range(4)]
    bound = F.lit(need[4])
    for p in reversed(range(4)):
        bound = F.when(same[p], bound).otherwise(F.lit(need[p]))
    # the loosest bound first: it is one product, and most pairs fail it
    return (common * total >= F.lit(need[4]) * product) & (common * total >= bound * product)
