"""Sets of word shingles of whole Arrow batches, in numpy.

Words are runs of bytes other than ASCII white space, A-Z in lower case. A set
holds the 64-bit hashes of the distinct five-word shingles of a text, ascending; a
text of one to four words has one shingle of all its words.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa

SIZE = 5
#: Bytes of text hashed at a time.
CHUNK = 1 << 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_VALUE = np.random.default_rng(20240101).integers(1, 1 << 63, 256, dtype=np.uint64)[_LOWER]
_BASE = 0x9E3779B97F4A7C15 | 1
_BACK = pow(_BASE, -1, 1 << 64)


@functools.cache
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for 2^bits places."""
    out = []
    for base in (_BASE, _BACK):
        p = np.ones(1, np.uint64)
        for k in range(bits):
            p = np.concatenate([p, p * np.uint64(pow(base, 1 << k, 1 << 64))])
        out.append(p)
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def sets(texts: pa.Array) -> list[np.ndarray]:
    """The shingle set of each text; empty for null, empty and blank ones."""
    texts = texts.cast(pa.large_string()).fill_null("")
    at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    out: list[np.ndarray] = []
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(at, at[first] + CHUNK, "right")) - 1)
        out += _chunk(data[at[first] : at[last]], at[first : last + 1] - at[first])
        first = last
    return out


def _chunk(data: np.ndarray, at: np.ndarray) -> list[np.ndarray]:
    none = np.empty(0, np.uint64)
    if not len(data):
        return [none] * (len(at) - 1)
    inside = ~_SPACE[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    heads = at[:-1][at[:-1] < at[1:]]
    starts[heads] = inside[heads]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    tails = heads[1:] - 1
    ends[tails] = inside[tails]
    begin, end = np.flatnonzero(starts), np.flatnonzero(ends)
    power, back = _powers(max(20, int(len(data)).bit_length()))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_VALUE[data] * power[: len(data)], out=total[1:])
    word = mix((total[end + 1] - total[begin]) * back[begin] + (end - begin).astype(np.uint64))
    first = np.searchsorted(begin, at)  # of each text, and the end
    h = np.full(max(0, len(word) - SIZE + 1), SIZE, np.uint64)
    for k in range(SIZE if len(h) else 0):
        h = mix(h ^ word[k : k + len(h)])
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= SIZE:
            s = np.sort(h[a : b - SIZE + 1])
            out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
        elif b > a:
            x = np.full(1, b - a, np.uint64)
            for w in word[a:b]:
                x = mix(x ^ w)
            out.append(x)
        else:
            out.append(none)
    return out


def name(s: np.ndarray) -> tuple[int, int]:
    """Two signed 64-bit hashes of a set."""
    with np.errstate(over="ignore"):
        a = mix(np.uint64([len(s)]) + np.add.reduce(mix(s ^ np.uint64(0x1234567))))
        b = mix(np.uint64([len(s)]) ^ np.bitwise_xor.reduce(mix(s + np.uint64(0x89ABCDEF))))
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])
