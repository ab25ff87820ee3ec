"""Byte-level words and their 64-bit hashes, vectorised over batches of texts.

Helpers that run inside Spark tasks. Texts are UTF-8 bytes; a word is a run of bytes of one class, so that a million
words cost a few numpy passes and no Python object each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

SPACE_SPLIT = np.ones(256, bool)
SPACE_SPLIT[[0x20, *range(0x09, 0x0E)]] = False
# letters, digits and every byte of a character beyond ASCII
ALNUM = np.zeros(256, bool)
ALNUM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
        return x ^ (x >> U(31))


BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
BASE = 0xD6E8FEB86659FD93
PIECE = 1 << 17
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> list[np.ndarray]:
    """Powers of the odd ``BASE`` and of its inverse modulo 2^64, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = max(n, 2 * PIECE)
        with np.errstate(over="ignore"):
            for i, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
                _powers[i] = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size - 1, base, np.uint64))))
    return _powers


def prefix_sums(buf: np.ndarray) -> np.ndarray:
    """``sums`` such that (sums[e] - sums[s]) * inverse power s is the same for equal byte strings [s, e)."""
    sums = np.zeros(len(buf) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(BYTE_VALUE[buf] * powers(len(buf) + 1)[0][:len(buf)], out=sums[1:])
    return sums


def word_spans(buf: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of word bytes."""
    inside = np.zeros(len(buf) + 2, np.int8)
    inside[1:-1] = word[buf]
    edges = np.flatnonzero(np.diff(inside))
    return edges[0::2], edges[1::2]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span's bytes, A-Z lower-cased; spans are disjoint and ascend. Works piece by piece, so that its
    arrays stay small however long the text is."""
    out = np.zeros(len(starts), np.uint64)
    first = 0
    while first < len(starts):
        base = int(starts[first])
        last = max(first + 1, int(np.searchsorted(ends, base + PIECE, side="right")))
        s, e = starts[first:last] - base, ends[first:last] - base
        sums = prefix_sums(LOWER[buf[base:base + int(e[-1])]])
        with np.errstate(over="ignore"):
            out[first:last] = mix((sums[e] - sums[s]) * powers(int(e[-1]) + 1)[1][s] + (e - s).astype(np.uint64))
        first = last
    return out


def word_hashes(texts: list[bytes], word: np.ndarray = SPACE_SPLIT) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased (A-Z) words of the texts in order, and where each text's words begin (one more entry
    at the end)."""
    joined = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    starts, ends = word_spans(joined, word)
    lens = np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts))
    bounds = np.searchsorted(starts, np.concatenate((np.zeros(1, np.int64), np.cumsum(lens))))
    return span_hashes(joined, starts, ends), bounds


def combine(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of ``n`` consecutive words."""
    m = len(hashes) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for i in range(n):
            out = mix(out * U(3) + hashes[i:i + m] + U(i + 1))
    return out


def hash_word(word: str) -> np.uint64:
    data = np.frombuffer(word.encode(), np.uint8)
    return span_hashes(data, np.zeros(1, np.int64), np.full(1, len(data)))[0]


def text_column(batch, name: str = "text") -> list[bytes]:
    """The texts of an Arrow batch as UTF-8 bytes; null is empty."""
    import pyarrow as pa

    return [t or b"" for t in batch.column(name).cast(pa.binary()).to_pylist()]


def chunks(items: Iterable, size, limit: int = 1_000_000) -> Iterator[list]:
    """Lists of consecutive items of about ``limit`` bytes together; a larger item comes alone."""
    held, total = [], 0
    for item in items:
        n = size(item)
        if held and total + n > limit:
            yield held
            held, total = [], 0
        held.append(item)
        total += n
    if held:
        yield held
