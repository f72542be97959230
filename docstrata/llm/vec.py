"""Whole-batch text primitives on numpy arrays, used inside Arrow mappers.

A batch of strings is laid out as one array of code points; words, their hashes, n-grams
and windows are then computed for the whole batch at once, with no loop over rows or words.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

import numpy as np
import pyarrow as pa

MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLD = np.uint64(0x9E3779B97F4A7C15)
BASE = 0x2545F4914F6CDD1D | 1
INVERSE = pow(BASE, -1, 1 << 64)
LETTER, NUMBER, SPACE, OTHER = 1, 2, 4, 8


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64: a bijection of 64-bit words."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * MIX1
        x = (x ^ (x >> np.uint64(27))) * MIX2
        return x ^ (x >> np.uint64(31))


@cache
def tables() -> tuple[np.ndarray, np.ndarray]:
    """By code point: the class (letter, number, space, other) and the lower-case form.
    Letters whose lower case is more than one character keep their own form."""
    n = sys.maxunicode + 1
    kind, low = np.full(n, OTHER, np.uint8), np.arange(n, dtype=np.uint32)
    for c in range(n):
        if 0xD800 <= c < 0xE000 or 0x30000 <= c < 0xE0000:
            continue
        s = chr(c)
        cat = unicodedata.category(s)
        if cat[0] == "L":
            kind[c] = LETTER
        elif cat[0] == "N":
            kind[c] = NUMBER
        if s.isspace():
            kind[c] = SPACE
        lo = s.lower()
        if len(lo) == 1:
            low[c] = ord(lo)
    kind[0x1C:0x20] = OTHER  # white space in Python, not in Unicode's property
    return kind, low


def codepoints(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, each followed by a line feed that belongs to none, and the
    start of each text (with one more at the end). Null counts as empty."""
    values = texts.to_pylist()
    joined = "\n".join(["" if v is None else v for v in values]) + "\n" if values else ""
    cp = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    lengths = np.fromiter((0 if v is None else len(v) for v in values), np.int64, len(values))
    return cp, np.concatenate([[0], np.cumsum(lengths + 1)])


@cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        b = np.full(n, BASE, np.uint64)
        b[0] = 1
        i = np.full(n, INVERSE, np.uint64)
        i[0] = 1
        return np.cumprod(b, dtype=np.uint64), np.cumprod(i, dtype=np.uint64)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = 1 << max(16, int(n).bit_length())
    return _powers(size)


def span_hashes(cp: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the code points of each span, the same wherever the span stands."""
    with np.errstate(over="ignore"):
        b, inv = powers(len(cp) + 1)
        terms = mix(cp.astype(np.uint64) * GOLD + GOLD) * b[: len(cp)]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
        return mix((total[end] - total[start]) * inv[start] + (end - start).astype(np.uint64))


def runs(flag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of true."""
    d = np.diff(np.concatenate([[0], flag.astype(np.int8), [0]]))
    return np.flatnonzero(d == 1), np.flatnonzero(d == -1)


def words(cp: np.ndarray, starts: np.ndarray, commands: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of letters and digits, lower-cased: hash, text index, start, end. commands:
    leave out typesetting commands, a backslash and the ASCII letters after it."""
    kind, low = tables()
    k = kind[cp]
    inside = (k & (LETTER | NUMBER)) > 0
    if commands:
        ascii_letter = ((cp >= 65) & (cp <= 90)) | ((cp >= 97) & (cp <= 122))
        s, e = runs(ascii_letter)
        after = s[(s > 0) & (cp[np.maximum(s - 1, 0)] == 92)]
        gone = np.zeros(len(cp) + 1, np.int32)
        np.add.at(gone, after, 1)
        np.add.at(gone, e[np.searchsorted(s, after)], -1)
        inside &= np.cumsum(gone)[:-1] == 0
    s, e = runs(inside)
    return span_hashes(low[cp], s, e), np.searchsorted(starts, s, "right") - 1, s, e


def ngrams(h: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every n consecutive words of one text, and the index of its first word."""
    if len(h) < n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    with np.errstate(over="ignore"):
        g = h[: len(h) - n + 1].copy()
        for i in range(1, n):
            g = mix(g * GOLD + h[i : len(h) - n + 1 + i])
    at = np.flatnonzero(row[: len(h) - n + 1] == row[n - 1 :])
    return g[at], at


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
