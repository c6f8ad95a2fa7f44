"""Words and shingles of whole texts, as 64-bit numbers.

Texts are split and hashed over the bytes of a whole Arrow batch at once. The
lower-casing of A-Z and both word classes are byte rules: all bytes above 0x7F
belong to words. A word's number is made by tabulation: each place of a block
of 32 bytes has a table of random numbers by byte, whose sum is mixed with the
place of the block, and the blocks of a word are added up and mixed again.
Equal words always get equal numbers; two different words of one comparison get
the same number with a chance of about 2**-64, whatever they look like, as no
place shares its table with another and no step between blocks is linear.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Bytes between words: white space only, or all of ASCII but letters and digits.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
NOT_ALNUM = bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
#: Texts are handled in runs of about so many bytes, cut between words.
RUN = 1 << 20
_BLOCK = 32
_STEP = np.uint64(0x9E3779B97F4A7C15)


def lower_ascii(column: Column) -> Column:
    """A-Z to a-z and nothing else, as the byte rules do it."""
    return F.translate(column, UPPER, UPPER.lower())


_tables: dict[bytes, tuple[np.ndarray, np.ndarray]] = {}


def _values(separators: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Random numbers by place in a block and byte, A-Z as a-z; and which bytes are of words."""
    if separators not in _tables:
        rng = np.random.Generator(np.random.PCG64(20_250_101))
        values = rng.integers(0, 1 << 63, (_BLOCK, 256), dtype=np.uint64) * np.uint64(2) + rng.integers(0, 2, (_BLOCK, 256), dtype=np.uint64)
        upper = np.frombuffer(UPPER.encode(), np.uint8)
        values[:, upper] = values[:, upper + 32]
        inside = np.ones(256, bool)
        inside[[b for b in separators if not 65 <= b <= 90]] = False
        _tables[separators] = values.ravel(), inside
    return _tables[separators]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads close numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each text; null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], column: int, size: int = RUN) -> Iterator[pa.RecordBatch]:
    """The rows in pieces of about ``size`` bytes of text, or one longer text, which bounds what hashing holds."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        piece = np.cumsum(lengths, dtype=np.int64) // size
        starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]]) if len(piece) else piece
        for start, end in zip(starts, [*starts[1:], len(piece)]):
            yield batch.slice(start, end - start)


def word_numbers(column: pa.Array, separators: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The number of every word of all texts, and where each text's words begin."""
    data, offsets = text_bytes(column)
    (values, of_word), size = _values(separators), len(data)
    edges = np.zeros(size + 1, bool)
    edges[offsets] = True
    found, starts = [], []
    at = 0
    while at < size:
        end = min(at + RUN, size)
        if end < size:
            inner = np.flatnonzero(~of_word[data[at:end]] | edges[at + 1 : end + 1])
            if len(inner):
                end = at + int(inner[-1]) + 1
            else:  # one word longer than a run
                rest = np.flatnonzero(~of_word[data[end:]] | edges[end + 1 :])
                end = end + int(rest[0]) + 1
        part = data[at:end]
        inside = of_word[part]
        before = np.empty_like(inside)
        before[0], before[1:] = False, inside[:-1]
        begins = inside & (~before | edges[at:end])
        first = np.flatnonzero(begins)
        after = np.empty_like(inside)
        after[-1], after[:-1] = False, inside[1:]
        last = np.flatnonzero(inside & (~after | edges[at + 1 : end + 1]))
        spots = np.arange(end - at)
        place = spots - np.maximum.accumulate(np.where(begins, spots, 0))
        value = values[(place % _BLOCK) * 256 + part]
        value[~inside] = 0
        total = np.cumsum(value, dtype=np.uint64)
        block = np.flatnonzero(inside & (place % _BLOCK == 0))
        of = np.searchsorted(first, block, "right") - 1
        until = np.minimum(block + _BLOCK - 1, last[of])
        low = np.where(block > 0, total[block - 1], np.uint64(0))
        mixed = np.cumsum(mix(total[until] - low + _STEP * (place[block] // _BLOCK + 1).astype(np.uint64)), dtype=np.uint64)
        ends = np.searchsorted(of, np.arange(len(first)), "right") - 1
        sums = np.diff(mixed[ends], prepend=np.uint64(0)) if len(ends) else np.zeros(0, np.uint64)
        found.append(mix(sums + (last - first).astype(np.uint64)))
        starts.append(first + at)
        at = end
    if not found:
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    return np.concatenate(found), np.searchsorted(np.concatenate(starts), offsets)


def shingle_sets(column: pa.Array, width: int) -> list[np.ndarray]:
    """Per text the sorted distinct numbers of its ``width``-word shingles.

    A text of fewer words, but not none, has one: its whole sequence.
    """
    words, bounds = word_numbers(column, SPACES)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    whole = max(0, len(words) - width + 1)
    sums = np.zeros(whole, np.uint64)
    for k in range(width):
        sums += words[k : k + whole] * factors[k]
    numbers, sets = mix(sums), []
    for start, end in zip(bounds[:-1], bounds[1:]):
        if end - start >= width:
            sets.append(np.unique(numbers[start : end - width + 1]))
        elif end > start:
            short = np.sum(words[start:end] * factors[: end - start], dtype=np.uint64)
            sets.append(mix(np.array([short + np.uint64(end - start)], np.uint64)))
        else:
            sets.append(np.empty(0, np.uint64))
    return sets
