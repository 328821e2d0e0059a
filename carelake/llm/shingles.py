"""Word and shingle hashing on raw UTF-8 bytes (numpy, used inside tasks).

A word is a run of bytes other than space, tab, LF, VT, FF and CR; A-Z count
as a-z. All separators are ASCII, so working on bytes never cuts a character.
Hashes have 64 bits. Texts are hashed in bounded chunks cut at separators, so
a very long text needs 8 bytes per word, not per byte.
"""

from __future__ import annotations

import numpy as np

CHUNK = 1 << 19
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)

_sep = np.zeros(256, dtype=bool)
_sep[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_fold = np.arange(256, dtype=np.uint64)
_fold[65:91] += _U(32)
_fold += _U(1)  # no byte counts as zero

_powers: dict[str, np.ndarray] = {}


def _pow(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 14)
        row = np.full(size, base, dtype=np.uint64)
        row[0] = 1
        have = _powers[name] = np.cumprod(row, dtype=np.uint64)
    return have[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (bijective), element by element."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _chunk_words(raw: np.ndarray) -> np.ndarray:
    sep = _sep[raw]
    edge = np.flatnonzero(sep[1:] != sep[:-1]) + 1
    bounds = np.concatenate(([0] if not sep[0] else [], edge, [len(raw)] if not sep[-1] else [])).astype(np.int64)
    if not len(bounds):
        return np.empty(0, dtype=np.uint64)
    start, end = bounds[0::2], bounds[1::2]
    run = np.zeros(len(raw) + 1, dtype=np.uint64)
    np.cumsum(_fold[raw] * _pow("b", _BASE, len(raw)), out=run[1:])
    poly = (run[end] - run[start]) * _pow("i", _INV, len(raw))[start]
    return mix(poly + (end - start).astype(np.uint64) * _U(0xD6E8FEB86659FD93))


def word_hashes(text: bytes | None) -> np.ndarray:
    """64-bit hash of each word of ``text``, in order (none for null)."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    raw = np.frombuffer(text, dtype=np.uint8)
    if len(raw) <= CHUNK:
        return _chunk_words(raw)
    parts, at = [], 0
    while at < len(raw):
        to = min(at + CHUNK, len(raw))
        while to < len(raw):  # extend to the next separator
            stop = np.flatnonzero(_sep[raw[to:to + 4096]])
            if len(stop):
                to += int(stop[0])
                break
            to = min(to + 4096, len(raw))
        parts.append(_chunk_words(raw[at:to]))
        at = to
    return np.concatenate(parts)


def shingle_set(words: np.ndarray, k: int) -> np.ndarray:
    """Sorted distinct hashes of the k-word shingles; a shorter non-empty
    sequence counts as one shingle."""
    n = len(words)
    if not n:
        return words
    width = min(k, n)
    with np.errstate(over="ignore"):
        out = np.full(n - width + 1, width * 0x2545F4914F6CDD1D & (1 << 64) - 1, dtype=np.uint64)
        for j in range(width):
            out = mix(out * _U(0x9FB21C651E98DF25) + words[j:j + len(out)])
    return np.unique(out)
