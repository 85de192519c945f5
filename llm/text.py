"""Vectorised tokenising and hashing of Arrow text columns inside tasks."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: Bytes that separate words: space and \\t \\n \\v \\f \\r.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_ODD = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def _lower_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 32
    return table


LOWER = _lower_table()
IS_SPACED_WORD = np.ones(256, dtype=bool)
IS_SPACED_WORD[list(SPACES)] = False
#: Bytes of `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]` after lower-casing, as UTF-8: digits, a-z, and all above 127.
IS_ALNUM_WORD = np.zeros(256, dtype=bool)
IS_ALNUM_WORD[0x30:0x3A] = True
IS_ALNUM_WORD[0x61:0x7B] = True
IS_ALNUM_WORD[0x80:] = True


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on all others."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


#: Blocks of eight bytes, or spans, that `span_hashes` reads at a time, and blocks of a span that counts as short.
_STRETCH = 1 << 18
_SHORT = 8
#: The low `k` bytes of a block.
_LOW_BYTES = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each span data[start:end]; two seeds give two independent hashes.

    A span's blocks of eight bytes are each mixed with their number before they are added up, so no
    pattern in the data makes two spans agree; only chance does.
    """
    width = data.dtype.itemsize
    raw = np.concatenate([np.ascontiguousarray(data).view(np.uint8), np.zeros(8, np.uint8)])
    eights = np.ndarray(len(raw) - 7, np.dtype("<u8"), buffer=raw, strides=(1,))
    begin = np.asarray(starts, np.int64) * width
    size = np.asarray(ends, np.int64) * width - begin
    out = np.zeros(len(begin), np.uint64)
    for i in range(0, len(begin), _STRETCH):
        out[i : i + _STRETCH] = _first_blocks(eights, begin[i : i + _STRETCH], size[i : i + _STRETCH], seed)
    long = np.flatnonzero(size > 8 * _SHORT)
    if len(long):
        out[long] = _all_blocks(eights, begin[long], size[long], seed)
    return mix(out + size.astype(np.uint64) * np.uint64(_ODD))


def _salt(number: np.ndarray, seed: int) -> np.ndarray:
    """What the blocks with these numbers are mixed with."""
    return mix(number.astype(np.uint64) * np.uint64(_ODD) + np.uint64((seed * _ODD + 1) & _ALL))


def _first_blocks(eights: np.ndarray, begin: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Sum of the mixed blocks of each span, up to `_SHORT` of them: block by block over all spans that reach so far."""
    salts = _salt(np.arange(_SHORT), seed)
    out = np.zeros(len(begin), np.uint64)
    some = np.flatnonzero(size > 0)
    for k in range(_SHORT):
        if not len(some):
            break
        left = size[some] - 8 * k
        out[some] += mix(eights[begin[some] + 8 * k] & _LOW_BYTES[np.minimum(left, 8)] ^ salts[k])
        some = some[left > 8]
    return out


def _all_blocks(eights: np.ndarray, begin: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """Sum of the mixed blocks of each span, of any length."""
    blocks = (size + 7) >> 3
    until = np.cumsum(blocks)
    out = np.zeros(len(begin), np.uint64)
    i = 0
    while i < len(begin):
        done = int(until[i - 1]) if i else 0
        j = max(i + 1, int(np.searchsorted(until, done + _STRETCH, side="right")))
        for k in range(0, int(blocks[i]), _STRETCH) if j == i + 1 else (0,):
            count = np.minimum(blocks[i:j] - k, _STRETCH) if j == i + 1 else blocks[i:j]
            first = np.cumsum(count) - count
            number = k + np.arange(int(count.sum())) - np.repeat(first, count)
            left = np.repeat(size[i:j], count) - 8 * number
            block = eights[np.repeat(begin[i:j], count) + 8 * number] & _LOW_BYTES[np.minimum(left, 8)]
            block = mix(block ^ _salt(number, seed))
            some = np.flatnonzero(count)
            if len(some):
                out[i + some] += np.add.reduceat(block, first[some])
        i = j
    return out


@dataclass
class Words:
    """The words of a batch of texts: byte spans in `data`, and where each text's words begin."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  #: words of text i are first[i]:first[i + 1]

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends)

    def text_of(self) -> np.ndarray:
        """Number of the text of each word."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def word(self, i: int) -> str:
        return bytes(self.data[self.starts[i] : self.ends[i]]).decode("utf-8", "replace")


def string_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true bytes; no run crosses a text's border."""
    n = len(inside)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    border = np.zeros(n + 1, bool)
    border[offsets] = True
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | border[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | border[1:n]
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


def words(column: pa.Array, inside: np.ndarray = IS_SPACED_WORD) -> Words:
    """Lower-cased (A-Z) words of each text, as runs of the bytes that `inside` marks."""
    data, offsets = string_buffers(column)
    data = data | ((data - np.uint8(0x41) < 26).view(np.uint8) << 5)
    marked = np.frombuffer(data.tobytes().translate(inside.tobytes()), bool)
    starts, ends = spans(marked, offsets)
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def weigh(batches, column: str, limit: int):
    """Regroup Arrow batches so that each holds at most `limit` bytes of text, or a single row."""
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        total, begin = 0, 0
        for i, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(begin, i - begin)
                total, begin = 0, i
            total += size
        if begin < batch.num_rows:
            yield batch.slice(begin)
