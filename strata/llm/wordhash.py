"""Hashes of all words and word shingles of a batch of texts, by numpy over the Arrow buffer.

A word's hash is a polynomial over its bytes (A-Z lower-cased) modulo 2**64, taken from one running sum of the whole
batch, then mixed. Words are runs of bytes other than 0x20 and 0x09-0x0D.
"""

from __future__ import annotations

import numpy as np

_U = np.uint64
_rng = np.random.default_rng(20240229)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_SPACE = np.isin(np.arange(256), [32, *range(9, 14)])
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BYTE_LOWER = _BYTE[_LOWER]
_P = 0x9E3779B97F4A7C15
_P_INV = pow(_P, -1, 2**64)
_COEF = _rng.integers(1, 2**63, 64, dtype=np.uint64) * _U(2) + _U(1)
_powers = {"p": np.ones(1, np.uint64), "inv": np.ones(1, np.uint64)}


def mix(x: np.ndarray, salt: int = 0) -> np.ndarray:
    x = x + _U(salt * 0x9E3779B97F4A7C15 % 2**64)
    x = (x ^ (x >> _U(33))) * _U(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U(33))) * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def _power(name: str, base: int, n: int) -> np.ndarray:
    if len(_powers[name]) < n:
        a = np.full(n, base, np.uint64)
        a[0] = 1
        _powers[name] = np.multiply.accumulate(a)
    return _powers[name][:n]


def text_bytes(texts) -> tuple[np.ndarray, np.ndarray]:
    """(bytes of all texts, where each begins and the last ends); null is no text."""
    import pyarrow as pa
    import pyarrow.compute as pc

    a = pc.fill_null(texts, "").cast(pa.large_string())
    if isinstance(a, pa.ChunkedArray):
        a = a.combine_chunks()
    ends = np.frombuffer(a.buffers()[1], np.int64)[a.offset : a.offset + len(a) + 1]
    data = np.frombuffer(a.buffers()[2], np.uint8)[ends[0] : ends[-1]] if a.buffers()[2] and ends[-1] > ends[0] else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def spans(texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bytes of all texts, first byte of each word, byte after its last) of an Arrow array of strings."""
    data, ends = text_bytes(texts)
    inside = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[ends] = True
    start = np.flatnonzero(inside & (~np.concatenate([[False], inside[:-1]]) | edge[:-1]))
    end = np.flatnonzero(inside & (~np.concatenate([inside[1:], [False]]) | edge[1:])) + 1
    return data, start, end


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of each span's bytes as they are."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _power("p", _P, len(data)), out=total[1:])
    return mix((total[end] - total[start]) * _power("inv", _P_INV, len(data))[start], 41)


def words(texts) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, the number of words before each text and after the last) of an Arrow array of strings; null is no text."""
    data, ends = text_bytes(texts)
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(ends), np.int64)
    _, start, end = spans(texts)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_LOWER[data] * _power("p", _P, n), out=total[1:])
    h = mix((total[end] - total[start]) * _power("inv", _P_INV, n)[start])
    return h, np.searchsorted(start, ends)


def shingles(h: np.ndarray, at: np.ndarray, k: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of the k-word shingles of each text; with fewer words, of all words as one; without words, none."""
    n = max(0, len(h) - k + 1)
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += h[j : j + n] * _COEF[j]
    total = mix(total)
    out = []
    for s, e in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if e - s >= k:
            out.append(np.unique(total[s : e - k + 1]))
        elif e > s:
            out.append(mix(np.array([(h[s:e] * _COEF[: e - s]).sum()], np.uint64), e - s))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def signature(s: np.ndarray) -> int:
    """A 64-bit hash of a set, as a signed integer."""
    return int(mix(np.array([mix(s, 7).sum() + _U(len(s))], np.uint64)).view(np.int64)[0])
