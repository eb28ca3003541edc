"""Word shingles as sorted arrays of 64-bit hashes, many texts at a time.

Words are maximal runs without white space, A-Z in lower case.  A word's hash is a polynomial
over its bytes taken from a running sum, a shingle's a weighted sum of its words' hashes, so
both come from a few passes over arrays and no text is held twice.
"""

from __future__ import annotations

import hashlib

import numpy as np

K = 5
_SEGMENT = 1 << 20


def _random(label: str, n: int) -> np.ndarray:
    return np.frombuffer(b"".join(hashlib.blake2b(f"{label}/{i}".encode(), digest_size=8).digest() for i in range(n)), "<u8").copy()


_BYTE = _random("byte", 256)
_BYTE[65:91] = _BYTE[97:123]  # A-Z counts as a-z
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = int(_random("base", 1)[0]) | 1
_PLACE = _random("place", K) | np.uint64(1)
_SHORT = _random("short", K)
_POW: list = []


def _powers() -> tuple[np.ndarray, np.ndarray]:
    if not _POW:
        for b in (_BASE, pow(_BASE, -1, 2**64)):
            p = np.full(_SEGMENT + 1, np.uint64(b))
            p[0] = 1
            _POW.append(np.multiply.accumulate(p))
    return _POW[0], _POW[1]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hash, start) of the words of at most _SEGMENT bytes."""
    power, back = _powers()
    edge = np.diff(np.concatenate([[True], _SPACE[data], [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_BYTE[data] * power[: len(data)], dtype=np.uint64)])
    return mix((run[ends] - run[starts]) * back[starts] + (ends - starts).astype(np.uint64)), starts


def word_hashes(texts: list[str]) -> list[np.ndarray]:
    """Hashes of the words of each text, in order."""
    out: list[np.ndarray] = []
    held: list[bytes] = []

    def many():
        if held:
            sizes = np.array([len(r) + 1 for r in held])
            h, at = _words(np.frombuffer(b" ".join(held), np.uint8))
            cut = np.searchsorted(at, np.cumsum(sizes)[:-1])
            out.extend(np.split(h, cut))
            held.clear()

    size = 0
    for t in texts:
        raw = t.encode("utf-8", "surrogatepass")
        if size + len(raw) + 1 > _SEGMENT:
            many()
            size = 0
        if len(raw) < _SEGMENT:
            held.append(raw)
            size += len(raw) + 1
            continue
        parts, at = [], 0  # a text of many segments, cut at white space
        data = np.frombuffer(raw, np.uint8)
        while at < len(raw):
            end = min(len(raw), at + _SEGMENT)
            if end < len(raw):
                gap = np.flatnonzero(_SPACE[data[at:end]])
                if not len(gap):  # one word longer than a segment: found by its digest
                    while end < len(raw) and not _SPACE[data[end]]:
                        end += 1
                    if end - at <= _SEGMENT:
                        parts.append(_words(data[at:end])[0])
                        at = end
                        continue
                    word = bytes(data[at:end]).translate(bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256)))
                    parts.append(np.frombuffer(hashlib.blake2b(word, digest_size=8).digest(), "<u8"))
                    at = end
                    continue
                end = at + int(gap[-1]) + 1
            parts.append(_words(data[at:end])[0])
            at = end
        out.append(np.concatenate(parts))
    many()
    return out


def shingle_set(words: np.ndarray) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; fewer than K words make one, no word none."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    if n < K:
        return mix((words * _PLACE[:n]).sum(dtype=np.uint64, keepdims=True) + _SHORT[n])
    h = words[: n - K + 1] * _PLACE[0]
    for j in range(1, K):
        h = h + words[j : n - K + 1 + j] * _PLACE[j]
    return np.unique(mix(h))


def sets_of(texts: list[str]) -> list[np.ndarray]:
    return [shingle_set(w) for w in word_hashes(texts)]
