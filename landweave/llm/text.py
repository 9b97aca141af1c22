"""Words and hashes of whole Arrow batches of texts with numpy.

Texts are handled as UTF-8 bytes. Every separator used here is ASCII, so bytes of longer characters never split a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
ODD = U64(0x9E3779B97F4A7C15)
BASE = U64(0xD6E8FEB86659FD93)

#: Separators of `[^\x20\x09-\x0D]+`.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True

#: A-Z to a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers in place (a finaliser of shifts and odd multipliers)."""
    x ^= x >> U64(33)
    x *= U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def chunks(batches: Iterator[pa.RecordBatch], most: int = 1 << 19, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``most`` bytes of text each; one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, offsets = raw(batch.column(batch.schema.get_field_index(column)))
        at = 0
        while at < batch.num_rows:
            to = int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1
            to = min(max(to, at + 1), batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def raw(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; a null is an empty text."""
    if array.null_count:
        array = array.fill_null("" if pa.types.is_string(array.type) or pa.types.is_large_string(array.type) else b"")
    wide = np.int64 if pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type) else np.int32
    _, offsets, data = array.buffers()
    if offsets is None or not len(array):
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    offsets = np.frombuffer(offsets, wide)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, offsets - offsets[0]


class Words:
    """The words of some texts: byte places ``starts`` and ``ends``, and ``first``, where the words of each text begin (one more than texts)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SPACES):
        self.data, self.offsets = data, offsets
        separate = separators[data]
        edge = np.empty(len(data) + 1, bool)
        edge[0] = edge[-1] = True
        edge[1:-1] = separate[:-1]
        edge[offsets[:-1]] = True
        edge[-1] = True
        self.starts = np.flatnonzero(~separate & edge[:-1])
        edge[:-1] = separate
        edge[offsets] = True
        self.ends = np.flatnonzero(~separate & edge[1:]) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self) -> np.ndarray:
        """64 bits of each word."""
        return hash_ranges(self.data, self.starts, self.ends)


def hash_ranges(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """64 bits of each range of bytes, none empty, in ascending order; in blocks of ranges and bytes, so that memory is bounded by the block."""
    out = np.empty(len(starts), U64)
    sizes, at = np.cumsum(ends - starts), 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + 4 * block, "right")))
        begin, lengths = starts[at:to], ends[at:to] - starts[at:to]
        edges = np.cumsum(lengths) - lengths
        inside = np.arange(int(lengths.sum())) - np.repeat(edges, lengths)
        letters = data[np.repeat(begin, lengths) + inside].astype(U64) + U64(1)
        power = np.full(int(lengths.max()), BASE)
        power[0] = 1
        letters *= np.multiply.accumulate(power)[inside]
        out[at:to] = mix(np.add.reduceat(letters, edges) + lengths.astype(U64) * ODD)
        at = to
    return out


def shingles(hashes: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every ``k`` consecutive words of each text and the text of each. A shorter text with words gives one, of all its words."""
    counts = np.diff(first)
    each = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    text = np.repeat(np.arange(len(counts)), each)
    start = first[:-1][text] + np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    size = np.minimum(counts, k)[text]
    out = size.astype(U64)
    for j in range(k):
        there = np.minimum(start + j, len(hashes) - 1)
        out = np.where(j < size, out * BASE + hashes[there], out) if len(hashes) else out
    return mix(out), text


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), pa.array(values, kind))
