"""Language identification by multilingual mixture inference.

A document's words are draws from a mixture of languages.  Letter-trigram models give the
likelihood of each word in each language; expectation-maximisation estimates the proportions
of the languages in the document; and the set of languages is the one whose likelihood less
a penalty for its size is best.  The prediction is the largest proportion in that set.

A text is reduced to its distinct words and how often each occurs, so that neither time nor
memory of the inference grows with repetition; the words of a batch are scored once.

The models are counted from at most ``per_lang`` labelled documents of each language (drawn
by hash, whole texts).  Counts are summed where they are, and at most BUCKETS numbers of each
language reach the driver; ``max_langs`` bounds the languages and is checked.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrowio import bounded_batches, pieces
from .rule_ensemble import in_split
from .textcols import whole

PER_LANG = 4_000
MAX_LANGS = 200
BUCKETS = 1 << 17
SMOOTH = 0.5
PENALTY = 3.0
STEPS, SETTLED = 200, 1e-5  # EM ends when no proportion moves by more, or after so many steps
_SLICE = 1 << 20
_ALPHA: list = []


def _alpha() -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000))
    return _ALPHA[0]


def _slices(text: str):
    """Pieces of a text that begin and end between words."""
    at = 0
    while at < len(text):
        end = min(len(text), at + _SLICE)
        while end < len(text) and text[end].isalpha():
            end += 1
        yield text[at:end]
        at = end


def words_of(text: str) -> Counter:
    """Distinct words (maximal runs of letters, lower case) of a text and their numbers."""
    out: Counter = Counter()
    for part in _slices(text):
        code = np.frombuffer(part.lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        out.update(np.where(_alpha()[code], code, np.uint32(32)).tobytes().decode("utf-32-le").split(" "))
    del out[""]
    return out


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(bucket of the trigram around each letter, start of each word among the letters) of words in lower case."""
    code = np.frombuffer(f" {' '.join(words)} ".encode("utf-32-le"), dtype=np.uint32)
    code = np.where(code == 32, np.uint32(0), code)
    mid = np.flatnonzero(code)
    left, right = code[mid - 1], code[mid + 1]
    mixed = left * np.uint32(0x9E3779B1) + code[mid] * np.uint32(0x85EBCA77) + right * np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0x2C1B3C6D)
    return (mixed >> np.uint32(15)).astype(np.int64), np.flatnonzero(left == 0)


@dataclass(frozen=True)
class LangModel:
    langs: tuple
    logp: np.ndarray  # BUCKETS x languages, float32

    @staticmethod
    def of(counts: dict) -> "LangModel":
        """Smoothed models of ``counts``: language -> number of each bucket."""
        langs = tuple(sorted(counts))
        c = np.array([counts[x] for x in langs], dtype=np.float64).reshape(len(langs), BUCKETS)
        used = max(1, int((c.sum(0) > 0).sum()))
        p = (c + SMOOTH) / (c.sum(1, keepdims=True) + SMOOTH * used + SMOOTH)
        return LangModel(langs, np.ascontiguousarray(np.log(p).T.astype(np.float32)))


def word_logp(words: list[str], model: LangModel) -> np.ndarray:
    """Log-likelihood of each word in each language."""
    out, at, held = [np.zeros((0, len(model.langs)), np.float32)], 0, 0
    for i, w in enumerate(words):
        held += len(w)
        if held >= _SLICE // 4 or i == len(words) - 1:
            bucket, starts = grams(words[at : i + 1])
            out.append(np.add.reduceat(model.logp[bucket], starts, axis=0))
            at, held = i + 1, 0
    return np.concatenate(out)


def _em(rel: np.ndarray, often: np.ndarray, first: np.ndarray, pi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Settled proportions and the (relative) log-likelihood of each document; documents that settle are left alone."""
    size = np.add.reduceat(often, first)
    ends = np.append(first[1:], len(rel))
    pi, moving = pi.copy(), np.arange(len(first))
    rows, starts = rel, first
    weight = often
    for _ in range(STEPS):
        doc = np.repeat(np.arange(len(moving)), np.diff(np.append(starts, len(rows))))
        r = rows * pi[moving][doc]
        r *= (weight / r.sum(1))[:, None]
        new = np.add.reduceat(r, starts, axis=0) / size[moving][:, None]
        far = np.abs(new - pi[moving]).max(1) > SETTLED
        pi[moving] = new
        if not far.any():
            break
        if far.mean() < 0.7:
            moving = moving[far]
            keep = np.concatenate([np.arange(first[d], ends[d]) for d in moving])
            rows, weight = rel[keep], often[keep]
            starts = np.concatenate([[0], np.cumsum((ends - first)[moving])[:-1]])
    doc = np.repeat(np.arange(len(first)), ends - first)
    return pi, np.add.reduceat(often * np.log((rel * pi[doc]).sum(1)), first)


def infer(docs: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, float]]:
    """(proportions over the chosen set, score) of documents (word likelihoods, numbers of the words); none may be empty.

    Language sets are nested: the languages of a document are ranked by their proportions when
    all take part, and the set of the first m is tried for every m.  Ties go to the language
    that is first by name, and to the smaller set.  The score is the largest proportion of the
    set, of a single language its posterior probability among single languages.
    """
    length = np.array([len(w) for w, _ in docs])
    lp = np.concatenate([w for w, _ in docs]).astype(np.float64)
    often = np.concatenate([c for _, c in docs]).astype(np.float64)
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    size = np.add.reduceat(often, first)
    top = lp.max(1, keepdims=True)
    rel = np.maximum(np.exp(lp - top), 1e-12)
    n, k = len(docs), lp.shape[1]
    single = np.add.reduceat((lp - top) * often[:, None], first, axis=0)  # log-likelihood of each language alone
    best = single.argmax(1)
    shift = np.exp(np.maximum(single - single.max(1, keepdims=True), -700))
    posterior = shift / shift.sum(1, keepdims=True)
    chosen = np.eye(k)[best]
    value = single[np.arange(n), best].copy()
    score = posterior[np.arange(n), best]
    if k > 1:
        pi, _ = _em(rel, often, first, np.full((n, k), 1.0 / k))
        rank = np.argsort(-pi, axis=1, kind="stable")
        # more languages than have a noticeable share cannot make up for their penalty
        most = np.maximum(2, (pi * size[:, None] > 1e-3).sum(1))
        for m in range(2, int(most.max()) + 1):
            some = np.flatnonzero(most >= m)
            rows = np.concatenate([np.arange(first[d], first[d] + length[d]) for d in some])
            starts = np.concatenate([[0], np.cumsum(length[some])[:-1]])
            mask = np.zeros((len(some), k))
            np.put_along_axis(mask, rank[some, :m], 1.0, axis=1)
            start = np.where(mask > 0, np.maximum(pi[some], 1e-6), 0)
            got, ll = _em(rel[rows], often[rows], starts, start / start.sum(1, keepdims=True))
            worth = ll - PENALTY * (m - 1) * np.log(size[some] + 1.0)
            better = worth > value[some] + 1e-9
            at = some[better]
            chosen[at], value[at] = got[better], worth[better]
            score[at] = got[better].max(1)
    return [(chosen[i], float(min(1.0, max(0.0, score[i])))) for i in range(n)]


def train(docs: DataFrame, per_lang: int = PER_LANG, max_langs: int = MAX_LANGS) -> LangModel:
    """Trigram models of the languages of ``docs(doc_id, text, lang)``; rows without lang or id are left out.

    More than ``max_langs`` languages are an error.
    """
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    found = rows.groupBy("lang").count().limit(max_langs + 1).collect()
    if len(found) > max_langs:
        raise ValueError(f"more than {max_langs} languages to learn: clean the labels, or raise max_langs")
    if not found:
        return LangModel((), np.zeros((BUCKETS, 0), np.float32))
    langs = sorted(r["lang"] for r in found)
    share = {r["lang"]: min(1.0, per_lang / r["count"]) for r in found}
    spark = docs.sparkSession
    limits = spark.createDataFrame([(k, i, int(share[k] * 1_000_000)) for i, k in enumerate(langs)], "lang string, no int, below int")
    near = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < F.col("below")
    drawn = rows.join(F.broadcast(limits), "lang").where(near).select("no", whole(F.col("text")).alias("text"))  # a row a language

    def count(batches):
        held: dict = {}
        for batch in batches:
            for b in pieces(batch, 1):
                for no, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                    words = words_of(text)
                    if words:
                        bucket, starts = grams(list(words))
                        times = np.repeat(np.fromiter(words.values(), np.int64, len(words)), np.diff(np.append(starts, len(bucket))))
                        got = np.bincount(bucket, times, BUCKETS).astype(np.int64)
                        held[no] = held[no] + got if no in held else got
        for no, all_ in held.items():
            at = np.flatnonzero(all_)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), no, np.int32)), pa.array(at.astype(np.int32)), pa.array(all_[at])], ["no", "bucket", "times"])

    counted = bounded_batches(drawn).mapInArrow(count, "no int, bucket int, times long").groupBy("no", "bucket").agg(F.sum("times").alias("times"))
    got = counted.toArrow()  # at most BUCKETS rows of 16 bytes a language
    counts = np.zeros((len(langs), BUCKETS), np.int64)
    counts[got.column("no").to_numpy(), got.column("bucket").to_numpy()] = got.column("times").to_numpy()
    return LangModel.of(dict(zip(langs, counts)))


def predict(docs: DataFrame, model: LangModel) -> DataFrame:
    """doc_id, lang_pred, score, mixture of every row of ``docs(doc_id, text, ...)``.

    ``mixture`` maps the languages of the chosen set to their proportions.  ``und`` with score
    0 and an empty mixture if the text is null or has no letter, or nothing was learned.  Ties
    between languages go to the first by name.  Texts of any length are read whole; repeated
    rows are predicted alike; an empty table gives an empty result; other columns are ignored.
    """
    rows = docs.select("doc_id", "text")
    shared = docs.sparkSession.sparkContext.broadcast(model)  # half a MB per language, of ``max_langs`` at most

    def run(batches):
        m = shared.value
        for batch in batches:
            for b in pieces(batch, 1, 1 << 20):
                each = [words_of(t or "") if m.langs else Counter() for t in b.column(1).to_pylist()]
                number: dict = {}
                at = [np.fromiter((number.setdefault(w, len(number)) for w in c), np.int64, len(c)) for c in each]
                lp = word_logp(list(number), m)
                full = [i for i, c in enumerate(each) if c]
                lang, score, mixture = ["und"] * len(each), [0.0] * len(each), [[]] * len(each)
                asked = [(lp[at[i]], np.fromiter(each[i].values(), np.float64, len(each[i]))) for i in full]
                for i, (pi, s) in zip(full, infer(asked) if full else ()):
                    lang[i], score[i] = m.langs[int(pi.argmax())], s
                    mixture[i] = [(m.langs[j], float(pi[j])) for j in np.flatnonzero(pi).tolist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(mixture, pa.map_(pa.string(), pa.float64()))], ["doc_id", "lang_pred", "score", "mixture"]
                )

    return bounded_batches(rows).mapInArrow(run, f"doc_id {dict(rows.dtypes)['doc_id']}, lang_pred string, score double, mixture map<string,double>")


def identify(docs: DataFrame, per_lang: int = PER_LANG) -> DataFrame:
    """doc_id, held_out, lang_pred, score, mixture; learned only from rows that are not held out (crc32 of the id mod 4 is 2)."""
    model = train(docs.select("doc_id", "text", "lang").where(~in_split(F.col("doc_id"), 4, 2)), per_lang)
    return predict(docs, model).select("doc_id", in_split(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score", "mixture")


def op7_language_mixture(spark, sf_dir: str) -> DataFrame:
    from ..tables import table

    found = identify(table(spark, sf_dir, "documents"))
    # sorted text instead of a map, which has no order to compare by
    shares = F.transform(F.array_sort(F.map_entries("mixture")), lambda e: F.concat(e["key"], F.lit(":"), F.format_string("%.4f", e["value"])))
    return found.withColumn("mixture", F.array_join(shares, ","))
