"""Words of whole Arrow columns as 64-bit hashes, computed on the UTF-8 bytes at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes that part words: white space alone, or everything in ASCII but letters and digits.
SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
PUNCT = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
#: Bytes that are hashed at a time.
_SEGMENT = 1 << 20
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, _SEGMENT + 1), base, np.uint64)
        have[0] = 1
        have = _powers[base] = np.multiply.accumulate(have)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values evenly (a bijection)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a column, and where each text begins (one more than rows). Nulls are empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0]:offsets[-1]] if len(texts) else data[:0], offsets - offsets[0]


def _cut(data: np.ndarray, lo: int, offsets: np.ndarray, sep: np.ndarray) -> int:
    """An end after lo, about a segment away, that parts no word."""
    size = _SEGMENT
    while lo + size < len(data):
        hi = lo + size
        start = offsets[np.searchsorted(offsets, hi, "right") - 1]
        if start > lo:
            return int(start)
        gaps = np.flatnonzero(sep[data[lo:hi]])
        if len(gaps):
            return lo + int(gaps[-1]) + 1
        size *= 2
    return len(data)


def _spans(inside: np.ndarray, firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of bytes inside words; texts begin at `firsts`."""
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    begin[firsts] = inside[firsts]
    starts = np.flatnonzero(begin)
    if not len(starts):
        return starts, starts
    stop = ~inside
    stop[firsts] = True
    stops = np.append(np.flatnonzero(stop), len(inside))
    return starts, stops[np.searchsorted(stops, starts, "right")]


def word_spans(texts: pa.Array, sep: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words that `word_hashes` counts, and the bytes they lie in."""
    data, offsets = utf8(texts)
    starts, ends = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    at = 0
    while at < len(data):
        end = _cut(data, at, offsets, sep)
        firsts = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end)] - at
        a, b = _spans(~sep[data[at:end]], firsts)
        starts.append(a + at)
        ends.append(b + at)
        at = end
    return np.concatenate(starts), np.concatenate(ends), data


def word_hashes(texts: pa.Array, sep: np.ndarray = SPACE, lower: np.ndarray | None = None,
                classes: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Hashes of all words of a column in order, and the number of words of each text.

    The hash of a word is the value of its bytes as a polynomial modulo 2**64, spread evenly. With `classes`, a byte's
    class bits (0 for separators), also the union of the bits of each word's bytes.
    """
    data, offsets = utf8(texts)
    hashes, starts_all, bits = [], [], []
    at = 0
    while at < len(data):
        end = _cut(data, at, offsets, sep)
        part = data[at:end] if lower is None else lower[data[at:end]]
        starts, ends = _spans(~sep[part], offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, end)] - at)
        if len(starts):
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum((part.astype(np.uint64) + np.uint64(1)) * _power(_BASE, len(part)), out=total[1:])
            hashes.append(mix64((total[ends] - total[starts]) * _power(_INVERSE, len(part) + 1)[starts]
                                + (ends - starts).astype(np.uint64)))
            starts_all.append(starts + at)
            if classes is not None:
                bits.append(np.bitwise_or.reduceat(classes[data[at:end]], starts))
        at = end
    if not hashes:
        found = np.empty(0, np.uint64), np.zeros(len(offsets) - 1, np.int64)
        return found if classes is None else (*found, np.empty(0, np.uint8))
    counts = np.diff(np.searchsorted(np.concatenate(starts_all), offsets))
    found = np.concatenate(hashes), counts
    return found if classes is None else (*found, np.concatenate(bits))


def shingles(words: np.ndarray, counts: np.ndarray, n: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words inside each text, in order, and their number per text.

    A text of 1 to n - 1 words has one shingle, all its words; a text without words has none.
    """
    total = len(words)
    short = (counts > 0) & (counts < n)
    sizes = np.where(short, 1, np.maximum(counts - n + 1, 0))
    if not total:
        return np.empty(0, np.uint64), sizes
    ends = np.cumsum(counts)
    at = np.arange(total)
    left = np.repeat(ends, counts) - at  # words to the end of the text, this one included
    acc = np.zeros(total, np.uint64)
    for k in range(n):
        nxt = np.zeros(total, np.uint64)
        nxt[:total - k] = words[k:] if k else words
        acc = acc * np.uint64(0xD6E8FEB86659FD93) + np.where(left > k, nxt, np.uint64(0))
    keep = left >= n
    keep[(ends - counts)[short]] = True
    return mix64(acc[keep]), sizes


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of about `most` bytes of text at the most; a longer text is a piece of its own."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            limit = (sizes[at - 1] if at else 0) + most
            end = max(at + 1, int(np.searchsorted(sizes, limit, "right")))
            yield batch.slice(at, end - at)
            at = end
