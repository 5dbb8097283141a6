"""A compressed FM-index over sequences of words, for matches of bounded length."""

import numpy as np


class Bits:
    """A bit vector with ranks: 64-bit words and the ones before each of them."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        packed = np.append(packed, np.zeros(8 - len(packed) % 8 + 8, np.uint8))
        self.words = packed[: len(packed) // 8 * 8].view("<u8")
        counts = np.bitwise_count(self.words).astype(np.int32)
        self.before = np.concatenate(([0], np.cumsum(counts, dtype=np.int32)))

    def rank(self, i: np.ndarray) -> np.ndarray:
        """Ones before each place."""
        word = i >> 6
        low = (np.uint64(1) << (i & 63).astype(np.uint64)) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.words[word] & low)


class WaveletMatrix:
    """Ranks of symbols in a sequence, one bit vector for each bit of a symbol."""

    def __init__(self, sequence: np.ndarray, symbols: int):
        self.levels = []
        for bit in range(max(1, (symbols - 1).bit_length()) - 1, -1, -1):
            ones = (sequence >> bit) & 1 == 1
            zeros = int(len(sequence) - ones.sum())
            self.levels.append((bit, zeros, Bits(ones)))
            sequence = np.concatenate((sequence[~ones], sequence[ones]))
        every = np.arange(symbols)
        self.origin = self._path(every, np.zeros(symbols, np.int64))

    def _path(self, symbol, i):
        for bit, zeros, bits in self.levels:
            ones = bits.rank(i)
            i = np.where((symbol >> bit) & 1 == 1, zeros + ones, i - ones)
        return i

    def rank(self, symbol: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        return self._path(symbol, i) - self.origin[symbol]


def _joined(a: np.ndarray, b: np.ndarray, ahead: int) -> np.ndarray:
    """Ranks of prefixes from ranks of their two parts, the second `ahead` words on (past the end: lowest)."""
    later = np.zeros(len(b), np.int64)
    later[: max(0, len(b) - ahead)] = b[ahead:] + 1
    return np.unique(a.astype(np.int64) * (len(b) + 2) + later, return_inverse=True)[1]


class FMIndex:
    """The index of a sequence of symbols (0 separates texts), exact for patterns of up to `longest`.

    Suffixes are sorted by their first `longest` symbols. Intervals of patterns up to that
    length come out as from a full sort, since a backward step looks at one symbol less.
    """

    def __init__(self, sequence: np.ndarray, symbols: int, longest: int):
        self.longest = longest
        ranks, width = {1: np.unique(sequence, return_inverse=True)[1]}, 1
        while 2 * width <= longest:
            ranks[2 * width] = _joined(ranks[width], ranks[width], width)
            width *= 2
        shorter, full = (self._ranks(ranks, n) for n in (longest - 1, longest))
        self.places = np.argsort(full, kind="stable")
        self.group = full[self.places]
        n = len(sequence)
        self.group_starts = np.flatnonzero(np.r_[True, np.diff(self.group) > 0])
        starts = np.flatnonzero(np.r_[True, np.diff(shorter[self.places]) > 0])
        self.low = np.repeat(starts, np.diff(np.r_[starts, n]))
        self.high = np.repeat(np.r_[starts[1:], n], np.diff(np.r_[starts, n]))
        self.first = np.concatenate(([0], np.cumsum(np.bincount(sequence, minlength=symbols))))
        self.bwt = WaveletMatrix(sequence[self.places - 1], symbols)

    @staticmethod
    def _ranks(ranks, n):
        """Ranks by the first n symbols, put together from powers of two."""
        out, done = None, 0
        for width in sorted(ranks, reverse=True):
            while n - done >= width:
                out = ranks[width] if out is None else _joined(out, ranks[width], done)
                done += width
        return out

    def start(self, symbol):
        return self.first[symbol], self.first[symbol + 1]

    def shorten(self, low, high):
        """Intervals of patterns of the full length without their last symbol."""
        return self.low[low], self.high[high - 1]

    def extend(self, symbol, low, high):
        """Intervals of patterns with one more symbol in front."""
        base = self.first[symbol]
        return base + self.bwt.rank(symbol, low), base + self.bwt.rank(symbol, high)

    def matches(self, sequence, begins, lengths):
        """Matching statistics of texts read from their ends, all texts in step.

        Yields (texts, place in the sequence, low, high) for every place at which `longest` symbols
        match; texts hold no separator and are in the index, so matches never fail.
        """
        order = np.argsort(-lengths, kind="stable")
        begins, lengths = begins[order], lengths[order]
        low = high = np.zeros(0, np.int64)
        for step in range(int(lengths[0]) if len(lengths) else 0):
            n = int(np.searchsorted(-lengths, -step, side="left"))
            place = begins[:n] + lengths[:n] - 1 - step
            symbol = sequence[place]
            if step == 0:
                low, high = self.start(symbol)
            else:
                low, high = low[:n], high[:n]
                if step >= self.longest:
                    low, high = self.shorten(low, high)
                low, high = self.extend(symbol, low, high)
            if step >= self.longest - 1:
                yield order[:n], place, low, high
