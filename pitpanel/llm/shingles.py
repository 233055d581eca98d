"""Word and shingle hashes of many UTF-8 texts at once, with numpy, inside tasks.

A word is a run of ASCII letters, digits and non-ASCII characters; A-Z are folded to
a-z, everything else separates. (Bytes >= 0x80 belong to non-ASCII characters, so
words can be cut on the UTF-8 bytes.) Word hashes are polynomials mod 2**64 over
random byte values, finished with a mixer; a shingle hash mixes ``k`` word hashes.
A text of 1 to k-1 words has one shingle, its whole word sequence; a text without a
word has none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 21          # texts are taken together up to this size; a longer text goes alone

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(U, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> U(30)
        x *= U(0xBF58476D1CE4E5B9)
        x ^= x >> U(27)
        x *= U(0x94D049BB133111EB)
        x ^= x >> U(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    with np.errstate(over="ignore"):
        return mix((np.arange(n, dtype=U) + U(1)) * U(0x9E3779B97F4A7C15) + U(seed))


_BYTE = np.arange(256)
_FOLD = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE)
_IS_WORD = ((_FOLD >= 97) & (_FOLD <= 122)) | ((_BYTE >= 48) & (_BYTE <= 57)) | (_BYTE >= 128)
_VALUE = np.where(_IS_WORD, stream(256, 11)[_FOLD] | U(1), U(0))
_BASE = U(0x9E3779B97F4A7C15 | 1)
_POWERS = np.ones(1, dtype=U)


def _powers(n: int) -> np.ndarray:
    global _POWERS
    if len(_POWERS) < n:
        with np.errstate(over="ignore"):
            _POWERS = np.cumprod(np.concatenate([np.ones(1, U), np.full(max(n, 1024) - 1, _BASE)]))
    return _POWERS[:n]


def utf8(col) -> tuple:
    """(bytes, offsets) of an Arrow string column without NULLs."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = col.cast(pa.large_string())
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64)[col.offset:col.offset + len(col) + 1]
    data = col.buffers()[2]
    return (np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)), offs


def chunks(offs: np.ndarray, limit: int = CHUNK_BYTES):
    """(first, last) ranges of texts of at most ``limit`` bytes together."""
    i, n = 0, len(offs) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offs, offs[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def words(data: np.ndarray, offs: np.ndarray, prefixes: tuple = ()) -> tuple:
    """(hash per word, text index per word) of the texts between ``offs``; with ``prefixes`` a list of
    hashes comes first: of the whole words, then of their first so many bytes."""
    buf = data[offs[0]:offs[-1]]
    begin = offs[:-1] - offs[0]
    none = np.zeros(0, U)
    if len(buf) == 0:
        return ([none] * (1 + len(prefixes)) if prefixes else none), np.zeros(0, np.int64)
    is_word = _IS_WORD[buf]
    first = is_word.copy()
    first[1:] &= ~is_word[:-1]
    at = begin[begin < len(buf)]
    first[at] = is_word[at]
    starts = np.flatnonzero(first)
    if len(starts) == 0:
        return ([none] * (1 + len(prefixes)) if prefixes else none), np.zeros(0, np.int64)
    pos = _positions(starts, len(buf))
    pos[~is_word] = 0
    with np.errstate(over="ignore"):
        value = _VALUE[buf] * _powers(int(pos.max()) + 1)[pos]
        h = mix(np.add.reduceat(value, starts))
        if prefixes:
            h = [h] + [mix(np.add.reduceat(np.where(pos < n, value, U(0)), starts) + U(n)) for n in prefixes]
    return h, np.searchsorted(begin, starts, "right") - 1


def _positions(starts: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(n, dtype=np.int64)
    out[starts[0]:] = np.arange(starts[0], n) - np.repeat(starts, np.diff(np.append(starts, n)))
    return out


def grams(h: np.ndarray, text: np.ndarray, k: int) -> tuple:
    """(hash, text index, first word's index) of every run of ``k`` words within a text."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64)
    keep = np.flatnonzero(text[:n] == text[k - 1:])
    salt = stream(k, 23) | U(1)
    with np.errstate(over="ignore"):
        s = np.zeros(len(keep), U)
        for j in range(k):
            s += h[keep + j] * salt[j]
    return mix(s), text[keep], keep


def shingle_sets(h: np.ndarray, text: np.ndarray, n_texts: int, k: int) -> tuple:
    """(distinct shingle hash, text index, occurrences), ordered by text; see the module."""
    g, t, _ = grams(h, text, k)
    counts = np.bincount(text, minlength=n_texts)
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        start = np.cumsum(counts) - counts
        salt = stream(k, 29) | U(1)
        with np.errstate(over="ignore"):
            s = counts[short].astype(U)
            for j in range(k - 1):
                has = counts[short] > j
                s[has] += h[start[short[has]] + j] * salt[j]
        g, t = np.concatenate([g, mix(s)]), np.concatenate([t, short])
    if len(g) == 0:
        return g, t, np.zeros(0, np.int64)
    order = np.lexsort((g, t))
    g, t = g[order], t[order]
    new = np.ones(len(g), bool)
    new[1:] = (g[1:] != g[:-1]) | (t[1:] != t[:-1])
    at = np.flatnonzero(new)
    return g[at], t[at], np.diff(np.append(at, len(g)))
