"""Whole-text kernels over Arrow buffers: bytes, words and word shingles as numpy arrays.

All of them work on slices of a few megabytes of text, so that their memory is
bounded whatever the size of a batch; a single longer text is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MIX_1, MIX_2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def parts(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``rows``, so that Python objects of a few texts live at a time."""
    for batch in batches:
        for start in range(0, len(batch), rows):
            yield batch.slice(start, rows)


def text_slices(batch: pa.RecordBatch, column: str, max_bytes: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Yield (first row, end row, bytes, offsets) of consecutive rows; null texts are empty here."""
    texts = batch.column(batch.schema.get_field_index(column))
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return
    _, offset_buffer, data = texts.buffers()
    offsets = np.frombuffer(offset_buffer, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    start = 0
    while start < len(texts):
        end = int(np.searchsorted(offsets, offsets[start] + max_bytes, side="right")) - 1
        end = min(max(end, start + 1), len(texts))
        yield start, end, raw[offsets[start] : offsets[end]], offsets[start : end + 1] - offsets[start]
        start = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit hashes."""
    x = x ^ (x >> np.uint64(30))
    x = x * MIX_1
    x = x ^ (x >> np.uint64(27))
    x = x * MIX_2
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of word bytes; words never cross rows."""
    if not len(data):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    inside = is_word_byte[data]
    before = np.empty(len(data), bool)
    before[0] = False
    before[1:] = inside[:-1]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    before[inner] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty(len(data), bool)
    after[-1] = False
    after[:-1] = inside[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    rows = np.searchsorted(offsets, starts, side="right") - 1
    return starts, ends, rows


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    size = 1 << max(10, (n + 1).bit_length())
    if size in _POWERS:
        return _POWERS[size]
    if size > 1 << 22:  # a single very long text: its powers are not kept
        size = n + 1
    else:
        _POWERS.clear()
    inverse = np.uint64(pow(int(WORD_BASE), -1, 1 << 64))
    up, down = np.ones(size, np.uint64), np.ones(size, np.uint64)
    up[1:], down[1:] = WORD_BASE, inverse
    found = np.multiply.accumulate(up), np.multiply.accumulate(down)
    if size <= 1 << 22:
        _POWERS[size] = found
    return found


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit polynomial hash of each word, from prefix sums over all bytes."""
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_hashes(words: np.ndarray, rows: np.ndarray, n_rows: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each run of ``width`` words; a row of fewer words, but not none, is one shingle."""
    counts = np.bincount(rows, minlength=n_rows)
    if len(words) >= width:
        last = len(words) - width + 1
        h = np.zeros(last, np.uint64)
        for k in range(width):
            h = h * WORD_BASE + words[k : k + last]
        whole = rows[:last] == rows[width - 1 :]
        hashes, owners = mix(h[whole]), rows[:last][whole]
    else:
        hashes, owners = np.zeros(0, np.uint64), np.zeros(0, np.int64)
    short = np.flatnonzero((counts > 0) & (counts < width))
    if len(short):
        first = np.concatenate([[0], np.cumsum(counts)])
        extra = np.zeros(len(short), np.uint64)
        for i, r in enumerate(short):
            h = np.uint64(counts[r])
            for w in words[first[r] : first[r + 1]]:
                h = np.uint64((int(h) * int(WORD_BASE) + int(w)) & 0xFFFFFFFFFFFFFFFF)
            extra[i] = h
        hashes, owners = np.concatenate([hashes, mix(extra)]), np.concatenate([owners, short])
        order = np.argsort(owners, kind="stable")
        hashes, owners = hashes[order], owners[order]
    return hashes, owners


#: Word bytes where words are runs of anything but white space (space, tab to carriage return).
NOT_SPACE = np.ones(256, bool)
NOT_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False
