"""Two Bloom filters over a stream of 64-bit hashes: seen once, and seen twice or more.

Each task fills a pair of its own. Pairs merge by ``once = a | b`` and
``twice = a.twice | b.twice | (a.once & b.once)``, so what two tasks have seen once each counts as seen
twice. A hash seen twice is never missed; one seen once may be taken for a repeat.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

PROBES = 2
#: Bytes of one piece in which tasks hand on their filters.
PIECE = 1 << 16


def _places(hashes: np.ndarray, bits: int):
    h = hashes.view(np.uint64)
    for k in range(PROBES):
        yield (h >> np.uint64(32 * k)).astype(np.int64) & (bits - 1)


def _set(filter_: np.ndarray, places: np.ndarray) -> None:
    places = np.unique(places)
    if len(places):
        at = places >> 3
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        filter_[at[first]] |= np.bitwise_or.reduceat((1 << (places & 7)).astype(np.uint8), first)


def _get(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (filter_[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def contains(filter_: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bits = 8 * len(filter_)
    found = np.ones(len(hashes), bool)
    for places in _places(hashes, bits):
        found &= _get(filter_, places)
    return found


class Pair:
    def __init__(self, bits: int):
        self.once = np.zeros(bits // 8, np.uint8)
        self.twice = np.zeros(bits // 8, np.uint8)

    def add(self, hashes: np.ndarray) -> None:
        values, counts = np.unique(hashes, return_counts=True)
        for places in _places(values, 8 * len(self.once)):
            _set(self.twice, places[_get(self.once, places) | (counts > 1)])
        for places in _places(values, 8 * len(self.once)):
            _set(self.once, places)


def bits_for(count: int, most: int) -> int:
    """Sixteen bits a hash, as a power of two between 2**20 and ``most``."""
    return min(most, 1 << max(20, (16 * count - 1).bit_length()))


def twice_filter(hashes: DataFrame, bits: int) -> np.ndarray:
    """The filter of what stands at least twice in the only column (long, no nulls).

    The driver receives ``bits / 8`` bytes at most.
    """
    spark = hashes.sparkSession
    kind = "piece long, once binary, twice binary"

    def fill(batches):
        pair = Pair(bits)
        for batch in batches:
            pair.add(batch.column(0).to_numpy(zero_copy_only=False))
        for k in range(0, bits // 8, PIECE):
            once, twice = pair.once[k : k + PIECE], pair.twice[k : k + PIECE]
            if once.any():
                yield pa.RecordBatch.from_pydict(
                    {
                        "piece": [k],
                        "once": [zlib.compress(once.tobytes(), 1)],
                        "twice": [zlib.compress(twice.tobytes(), 1)],
                    }
                )

    def merge(batches):
        merged = {}
        for batch in batches:
            for row in batch.to_pylist():
                once, twice = (np.frombuffer(zlib.decompress(row[c]), np.uint8) for c in ("once", "twice"))
                if row["piece"] in merged:
                    old = merged[row["piece"]]
                    merged[row["piece"]] = (old[0] | once, old[1] | twice | (old[0] & once))
                else:
                    merged[row["piece"]] = (once, twice)
        for piece, (once, twice) in merged.items():
            if twice.any():
                yield pa.RecordBatch.from_pydict(
                    {"piece": [piece], "twice": [zlib.compress(twice.tobytes(), 1)]}
                )

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = hashes.mapInArrow(fill, kind).repartition(parts, "piece").mapInArrow(merge, "piece long, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for row in merged.toLocalIterator():
        piece = np.frombuffer(zlib.decompress(bytes(row["twice"])), np.uint8)
        out[row["piece"] : row["piece"] + len(piece)] = piece
    return out
