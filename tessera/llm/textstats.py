"""Statistics of a text that quality rules are made of.

Word lists, labels, languages and sources play no part; one pass over the bytes gives the
character classes, one over the words the rest.
"""

from __future__ import annotations

import numpy as np

#: Order of the columns that ``stats`` fills.
NAMES = (
    "n_chars", "n_words", "n_lines", "mean_word", "max_word", "upper_share", "digit_share", "symbol_share", "sentence_share",
    "bang_per_word", "bar_per_word", "space_share", "foreign_share", "unique_share", "top_share", "repeat_share", "line_repeat_share",
    "short_word_share", "symbol_word_share", "caps_word_share", "entropy", "pair_unique_share", "words_per_line", "end_share", "stutter_share",
)


def _mask(chars: str) -> np.ndarray:
    m = np.zeros(256, bool)
    m[[ord(c) for c in chars]] = True
    return m


_UPPER, _LOWER = _mask("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _mask("abcdefghijklmnopqrstuvwxyz")
_DIGIT, _SYMBOL = _mask("0123456789"), _mask("#$%&*+<=>@[\\]^_`{|}~/\"")
_STOP, _SPACE = _mask(".,;:?!"), _mask(" \t\n\x0b\x0c\r")
_SYMBOLS = frozenset("#$%&*+<=>@[\\]^_`{|}~")


def stats(text: str) -> tuple[float, ...]:
    """All of NAMES for one text; shares of nothing are 0."""
    raw = text.encode()
    hist = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = max(len(raw), 1)
    words = text.split()
    n = len(words)
    per = max(n, 1)
    lengths = np.fromiter(map(len, words), np.int64, n)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    stutter = sum(map(str.__eq__, words, words[1:]))
    pairs = len(set(zip(words, words[1:])))
    lines = [x for x in text.split("\n") if x.strip()]
    upper, lower = int(hist[_UPPER].sum()), int(hist[_LOWER].sum())
    p = hist[hist > 0] / size
    return (
        float(len(text)), float(n), float(len(lines)), float(lengths.mean()) if n else 0.0, float(lengths.max()) if n else 0.0,
        upper / max(upper + lower, 1), int(hist[_DIGIT].sum()) / size, int(hist[_SYMBOL].sum()) / size, int(hist[_STOP].sum()) / per,
        int(hist[33]) / per, int(hist[124]) / per, int(hist[_SPACE].sum()) / size, int(hist[128:].sum()) / size,
        len(counts) / per, max(counts.values(), default=0) / per, 1 - pairs / max(n - 1, 1) if n > 1 else 0.0, 1 - len(set(lines)) / max(len(lines), 1) if lines else 0.0,
        float((lengths <= 3).mean()) if n else 0.0, sum(not _SYMBOLS.isdisjoint(w) for w in words) / per, sum(map(str.isupper, words)) / per,
        float(-(p * np.log2(p)).sum()) if raw else 0.0, pairs / max(n - 1, 1), n / max(len(lines), 1), sum(w[-1] in ".!?" for w in words) / per, stutter / max(n - 1, 1),
    )
