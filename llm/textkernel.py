"""Vectorised word and shingle hashing over Arrow string columns.

Texts are walked as UTF-8 bytes in segments of about one megabyte, so the working
memory does not depend on the batch or on the longest text's neighbours.  Words are
``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a word's hash is a polynomial over its
bytes modulo 2**64 passed through a 64-bit finaliser.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SEGMENT = 1 << 20
SHINGLE = 5
_BASE = 0x9E3779B97F4A7C15 | 1
_LOWER = np.arange(256, dtype=np.uint64) + 1
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
#: Everything in ASCII but letters and digits, for words without their punctuation.
PLAIN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])
_COEF = np.array([pow(0xD1342543DE82EF95, k + 1, 1 << 64) | 1 for k in range(64)], dtype=np.uint64)
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = _POWERS.get("up")
    if have is None or len(have) < n:
        size = max(n, SEGMENT + 4096)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _segment_words(buf: np.ndarray, begins: np.ndarray, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and start bytes of the words of ``buf``; no word spans a position in ``begins``."""
    space = gaps[buf]
    cut = np.zeros(len(buf) + 1, dtype=bool)
    cut[begins] = True
    cut[-1] = True
    word = ~space
    first = word.copy()
    first[1:] &= space[:-1] | cut[1:-1]
    last = word
    last[:-1] &= space[1:] | cut[1:-1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    up, down = _powers(len(buf))
    total = np.empty(len(buf) + 1, dtype=np.uint64)
    total[0] = 0
    np.cumsum(_LOWER[buf] * up[: len(buf)], out=total[1:])
    return mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64)), s


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, bytes) of a string column; nulls have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    if not len(column):
        return np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.uint8)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    return off, raw


def word_hashes(column: pa.Array, gaps: np.ndarray = _SPACE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, hashes, words per row) for runs of rows that cover the column in order.

    gaps: which bytes separate words.
    """
    off, raw = text_buffers(column)
    n, i = len(off) - 1, 0
    while i < n:
        if off[i + 1] - off[i] > SEGMENT:
            hashes = np.concatenate(list(_long_text(raw[off[i] : off[i + 1]], gaps)))
            yield i, i + 1, hashes, np.array([len(hashes)])
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(off, off[i] + SEGMENT, side="right")) - 1)
        buf, begins = raw[off[i] : off[j]], off[i : j + 1] - off[i]
        if not len(buf):
            yield i, j, np.zeros(0, dtype=np.uint64), np.zeros(j - i, dtype=np.int64)
        else:
            hashes, starts = _segment_words(buf, begins, gaps)
            yield i, j, hashes, np.diff(np.searchsorted(starts, begins))
        i = j


def _long_text(buf: np.ndarray, gaps: np.ndarray) -> Iterator[np.ndarray]:
    at = 0
    while at < len(buf):
        end = min(at + SEGMENT, len(buf))
        if end < len(buf):
            found = np.flatnonzero(gaps[buf[at:end]])
            if len(found):
                end = at + int(found[-1]) + 1
            else:  # one word longer than a segment
                more = np.flatnonzero(gaps[buf[end:]])
                end = end + int(more[0]) + 1 if len(more) else len(buf)
        yield _segment_words(buf[at:end], np.array([0]), gaps)[0]
        at = end


def shingle_sets(column: pa.Array, size: int = SHINGLE) -> Iterator[np.ndarray]:
    """Each row's sorted distinct shingle hashes; shorter texts are one shingle, wordless ones none."""
    for _, _, hashes, counts in word_hashes(column):
        m = len(hashes) - size + 1
        if m > 0:
            rolled = hashes[:m] * _COEF[0]
            for k in range(1, size):
                rolled += hashes[k : k + m] * _COEF[k]
            rolled = mix(rolled)
        at = 0
        for c in counts.tolist():
            if c >= size:
                yield np.unique(rolled[at : at + c - size + 1])
            elif c:
                yield mix(np.array([(hashes[at : at + c] * _COEF[:c]).sum(dtype=np.uint64) + np.uint64(c)], dtype=np.uint64))
            else:
                yield np.zeros(0, dtype=np.uint64)
            at += c
