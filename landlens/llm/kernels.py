"""Vectorised byte kernels (numpy) that run inside Spark tasks."""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit (the splitmix64 finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_LETTER = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    if n:
        out[0] = 1
        np.multiply.accumulate(out, out=out)
    return out


def _words(raws: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of several texts, in order, and the text each word stands in. A word is a run without white
    space, A-Z lower-cased."""
    data = np.frombuffer(b" ".join(raws), np.uint8)
    inside = ~_SPACE[data]
    edge = np.diff(inside.view(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    lengths = ends - starts
    letters = _LETTER[_FOLD[data[inside]]]
    firsts = np.cumsum(lengths) - lengths
    at = np.arange(len(letters)) - np.repeat(firsts, lengths)
    letters *= powers(0x100000001B3, int(lengths.max()))[at]
    begins = np.cumsum([0] + [len(r) + 1 for r in raws[:-1]])
    return mix(np.add.reduceat(letters, firsts) + lengths.astype(np.uint64) * _ODD), np.searchsorted(begins, starts, side="right") - 1


def shingle_sets(raws: list[bytes], size: int) -> list[np.ndarray]:
    """For each text the sorted distinct hashes of its runs of ``size`` words; of fewer words, the whole sequence as
    one; without words, nothing."""
    words, owner = _words(raws)
    bounds = np.searchsorted(owner, np.arange(len(raws) + 1))
    out = []
    run = _runs(words, size)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= size:
            own = run[a:b - size + 1].copy()
            own.sort()
            keep = np.ones(len(own), bool)
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            out.append(own[keep])
        else:
            out.append(_runs(words[a:b], b - a) + np.uint64(b - a) if b > a else words[:0])
    return out


def _runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of k words (also across texts; the caller takes those within one)."""
    n = max(0, len(words) - k + 1)
    run = np.zeros(n, np.uint64)
    for i in range(k if n else 0):
        run = mix(run * np.uint64(0xD6E8FEB86659FD93) + words[i:n + i] + np.array(i + 1, np.uint64) * _ODD)
    return run


def in_slices(items, weight, limit: int = 1 << 18):
    """Consecutive items in lists whose weights add up to about ``limit``."""
    now, size = [], 0
    for x in items:
        now.append(x)
        size += weight(x)
        if size >= limit:
            yield now
            now, size = [], 0
    if now:
        yield now
