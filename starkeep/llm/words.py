"""Vectorised words and hashes over the UTF-8 bytes of a column of texts.

Everything here works on a chunk of rows at a time, inside a task: a chunk holds some megabytes of
text or one long document, so memory does not depend on the size of a partition.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
MIX = np.uint64(0xD6E8FEB86659FD93)
CHUNK_BYTES = 1 << 20

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: True for bytes that stand in words cut at [\x20\x09-\x0D].
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[9, 10, 11, 12, 13, 32]] = False
#: True for ASCII letters and digits and all bytes of other characters.
ALNUM = np.zeros(256, bool)
ALNUM[48:58] = ALNUM[65:91] = ALNUM[97:123] = ALNUM[128:] = True

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int):
    """Powers of the base and of its inverse modulo 2**64, at least n of each."""
    if len(_powers[0]) < n:
        n = max(n, 2 * CHUNK_BYTES)
        for k, step in enumerate((BASE, np.uint64(pow(int(BASE), -1, 1 << 64)))):
            row = np.full(n, step)
            row[0] = 1
            _powers[k] = np.multiply.accumulate(row)
    return _powers


class Chunk:
    """Rows first..first+rows of a column; data holds their bytes, offsets their bounds."""

    def __init__(self, first: int, data: np.ndarray, offsets: np.ndarray):
        self.first, self.data, self.offsets = first, data, offsets
        self.rows = len(offsets) - 1

    def spans(self, member: np.ndarray):
        """Byte starts, byte ends and row numbers of the runs of bytes in `member`."""
        n = len(self.data)
        inside = member[self.data]
        before = np.zeros(n, bool)
        before[1:] = inside[:-1]
        after = np.zeros(n, bool)
        after[:-1] = inside[1:]
        bounds = self.offsets[(self.offsets > 0) & (self.offsets < n)]
        before[bounds] = False
        after[bounds - 1] = False
        starts = np.flatnonzero(inside & ~before)
        ends = np.flatnonzero(inside & ~after) + 1
        return starts, ends, np.searchsorted(self.offsets[1:], starts, side="right")

    def prefix(self) -> np.ndarray:
        """Sums of the weighted bytes before each place."""
        sums = np.zeros(len(self.data) + 1, np.uint64)
        weights = powers(len(self.data) + 1)[0]
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * weights[: len(self.data)], out=sums[1:])
        return sums


def unspaced(data: np.ndarray) -> np.ndarray:
    """True at the first byte of each character of a script written without spaces (Thai to Khmer, kana, Han)."""
    after = np.append(data[1:], 0)
    return (
        ((data == 0xE0) & (after >= 0xB8) & (after <= 0xBB))
        | ((data == 0xE1) & ((after <= 0x82) | ((after >= 0x9E) & (after <= 0x9F))))
        | ((data == 0xE2) & (after >= 0xBA))
        | ((data >= 0xE3) & (data <= 0xE9))
        | ((data == 0xEF) & (after >= 0xA4) & (after <= 0xAB))
        | ((data == 0xF0) & (after >= 0xA0))
    )


def characters_apart(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, rows: np.ndarray):
    """The spans, but each character of a script without spaces a span of its own."""
    if not len(starts) or data.max() < 0xE0:
        return starts, ends, rows
    first = np.flatnonzero(unspaced(data))
    cuts = np.unique(np.concatenate((first, first + np.where(data[first] >= 0xF0, 4, 3))))
    span = np.searchsorted(starts, cuts, side="right") - 1
    inside = (span >= 0) & (cuts > starts[span]) & (cuts < ends[span])
    begins = np.sort(np.concatenate((starts, cuts[inside])))
    span = np.searchsorted(starts, begins, side="right") - 1
    return begins, np.minimum(np.append(begins[1:], len(data)), ends[span]), rows[span]


def span_hashes(prefix: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """One 64-bit hash for the bytes of each span; equal bytes, equal hashes, wherever they stand."""
    return mixed((prefix[ends] - prefix[starts]) * powers(len(prefix))[1][starts])


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them over all bits."""
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(29))) * MIX
    return h ^ (h >> np.uint64(32))


def runs(hashes: np.ndarray, length: int) -> np.ndarray:
    """A hash for each run of `length` consecutive hashes (no regard to rows)."""
    n = len(hashes) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(hashes) + 1, np.uint64)
    up, down = powers(len(hashes) + 1)
    np.cumsum(hashes * up[: len(hashes)], out=sums[1:])
    return mixed((sums[length:] - sums[:-length]) * down[:n])


def chunks(column, limit: int = CHUNK_BYTES, lower: bool = False):
    """Pieces of a string column of about `limit` bytes; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, bounds, data = column.buffers()
    offsets = np.frombuffer(bounds, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), len(column))
        piece = data[offsets[first] : offsets[last]]
        yield Chunk(first, LOWER[piece] if lower else piece, offsets[first : last + 1] - offsets[first])
        first = last
