"""Benchmark items inside documents, by CGK embedding and bit-sampling LSH.

A document holds an item of n words if some n consecutive words of it (all of them, if it has fewer) are within a
word edit distance of n/5, that is, similar to 0.8 or more. Every such window is embedded
by the CGK random walk, which turns edit distance into Hamming distance: at each step it writes the word it
stands on, and moves on or stays by a random bit of step and word. Each of ``walks(n)`` walks with its
own bits samples PICKS of the first 2n symbols written (the mean length until the end) to one key; windows and items that share a key of
equal length are compared exactly by edit distance.

Two bounded bit tables keep the work off windows that cannot match. By the q-gram lemma a window
within distance k has at least n-2-3k of the item's runs of three words; windows with
fewer are not embedded. Keys that no item has are not shuffled.
"""

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkeep.llm.words import ALNUM, Chunk, characters_apart, chunks, mixed, runs, span_hashes
from starkeep.sources.files import materialize

MIN_WORDS = 5
#: Least number of walks, and walks for each word of an item: longer walks drift apart, so more are needed for a recall of 0.98.
REPEATS = 16
WALKS_A_WORD = 0.4
PICKS = 2
SEED = 20240601
#: Bits of each table: 4 MB of bytes in packed form; more items fill them up and only cost time.
TABLE_BITS = 1 << 25


def allowed(n: int) -> int:
    """Edits allowed to an item of n words: n/5, and few enough to leave three words in a row."""
    return min(n // 5, (n - 3) // 3)


def walks(n: int) -> int:
    """Walks for items of n words: in proportion to n, and faster above 200."""
    return max(REPEATS, math.ceil(WALKS_A_WORD * n * max(1.0, n / 200) ** 0.5))


def _words(chunk):
    starts, ends, rows = characters_apart(chunk.data, *chunk.spans(ALNUM))
    return starts, ends, rows, span_hashes(chunk.prefix(), starts, ends)


@lru_cache(4096)
def _picks(n: int) -> np.ndarray:
    """The steps each walk over n words samples, sorted; one row for each repeat."""
    rng = np.random.default_rng([SEED, n])
    return np.sort(np.array([rng.choice(2 * n, PICKS, replace=False) for _ in range(walks(n))]), axis=1)


def embed_keys(hashes: np.ndarray, starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Keys (one column for each repeat) of the windows of ``width`` words at ``starts``, as of n words."""
    picks = _picks(n)
    steps = int(picks.max()) + 1
    low, high = int(starts.min()), int(starts.max()) + width
    local = np.append(hashes[low:high], np.uint64(0))
    repeats = walks(n)
    salts = mixed(np.arange(repeats * (steps // 64 + 1), dtype=np.uint64) + np.uint64(SEED)).reshape(repeats, -1)
    repeat = np.arange(repeats) * len(local)
    place = np.zeros((len(starts), repeats), np.int64)
    origin = (starts - low)[:, None]
    keys = np.broadcast_to(mixed(np.arange(repeats, dtype=np.uint64) * np.uint64(1 << 20) + np.uint64(n)), place.shape).copy()
    taken = np.zeros(repeats, np.int64)
    for step in range(steps):
        if step & 63 == 0:
            coins = mixed(salts[:, step >> 6, None] ^ local).reshape(-1)
        at = np.where(place < width, origin + place, len(local) - 1)
        sampled = taken < PICKS
        sampled[sampled] = picks[sampled, taken[sampled]] == step
        if sampled.any():
            keys[:, sampled] = mixed(keys[:, sampled] * np.uint64(31) + local[at[:, sampled]])
            taken[sampled] += 1
        bits = np.take(coins, at + repeat) >> np.uint64(step & 63)
        place += (bits & np.uint64(1)).view(np.int64)
    return keys


def _marks(grams: np.ndarray, n: int) -> np.ndarray:
    """Places of runs of three words in the table for items of n words (0: of any)."""
    return (mixed(grams + np.uint64(n)) & np.uint64(TABLE_BITS - 1)).astype(np.int64)


def _in(table: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (table[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def _packed(places: DataFrame) -> np.ndarray:
    """A bit table from distinct places; TABLE_BITS / 8 bytes reach the driver at most."""
    rows = places.groupBy(F.shiftright("place", 3).alias("byte")).agg(
        F.expr("bit_or(shiftleft(1, cast(place % 8 AS int)))").alias("bits")
    )
    found = rows.toArrow()
    table = np.zeros(TABLE_BITS // 8, np.uint8)
    table[found.column("byte").to_numpy()] = found.column("bits").to_numpy().astype(np.uint8)
    return table


def item_keys(items: DataFrame) -> DataFrame:
    """``(item_id, item, n, grams, keys)``: normalised text, words, table places and LSH keys of each item.

    Items of under MIN_WORDS words, null texts among them, are left out.
    """

    def per_batch(batches):
        for batch in batches:
            out = []
            for chunk in chunks(batch.column(1), lower=True):
                starts, ends, rows, hashes = _words(chunk)
                bounds = np.searchsorted(rows, np.arange(chunk.rows + 1))
                for row in range(chunk.rows):
                    a, b = int(bounds[row]), int(bounds[row + 1])
                    n = b - a
                    if n < MIN_WORDS:
                        continue
                    grams = runs(hashes[a:b], 3)
                    keys = embed_keys(hashes[a:b], np.zeros(1, np.int64), n, n)[0]
                    out.append(
                        {
                            "item_id": batch.column(0)[chunk.first + row].as_py(),
                            "item": chunk.data[starts[a] : ends[b - 1]].tobytes(),
                            "n": n,
                            "grams": np.r_[_marks(grams, 0), _marks(grams, n)].tolist(),
                            "keys": keys.view(np.int64).tolist(),
                        }
                    )
            if out:
                yield pa.RecordBatch.from_pylist(out, SCHEMA)

    SCHEMA = pa.schema(
        [
            ("item_id", pa.int64()),
            ("item", pa.binary()),
            ("n", pa.int64()),
            ("grams", pa.list_(pa.int64())),
            ("keys", pa.list_(pa.int64())),
        ]
    )
    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(
        per_batch, "item_id long, item binary, n long, grams array<bigint>, keys array<bigint>"
    )


class Search:
    """The windows of texts whose keys some item may have."""

    def __init__(self, lengths, grams, keys):
        self.lengths, self.grams, self.keys = lengths, grams, keys
        self.least = min(n - 2 - 3 * allowed(n) for n in lengths)
        self.longest = max(lengths)

    def rows_with_marks(self, hashes, rows):
        """Rows in which some stretch of the longest item's length has enough marks."""
        if len(hashes) < 3:
            return []
        seen = _in(self.grams, _marks(runs(hashes, 3), 0))
        seen &= rows[2:] == rows[:-2]
        marks = np.flatnonzero(seen)
        k = self.least - 1
        if len(marks) <= k:
            return []
        close = (marks[k:] - marks[: len(marks) - k] < self.longest) & (rows[marks[k:]] == rows[marks[: len(marks) - k]])
        return np.unique(rows[marks[k:][close]]).tolist()

    def windows(self, hashes):
        """(start, width, n, keys) of one text's windows that have enough marks and a known key."""
        grams, m = runs(hashes, 3), len(hashes)
        for n in self.lengths:
            k = allowed(n)
            width = min(n, m)
            if width < n - k:
                continue
            seen = np.concatenate(([0], np.cumsum(_in(self.grams, _marks(grams, n)))))
            starts = np.flatnonzero(seen[width - 2 :] - seen[: len(seen) - width + 2] >= n - 2 - 3 * k)
            for part in np.array_split(starts, 1 + len(starts) * walks(n) // (4096 * REPEATS)):
                if len(part):
                    keys = embed_keys(hashes, part, width, n)
                    known = _in(self.keys, (keys & np.uint64(TABLE_BITS - 1)).astype(np.int64))
                    for i in np.flatnonzero(known.any(axis=1)).tolist():
                        yield int(part[i]), width, n, keys[i][known[i]].view(np.int64).tolist()


def edit_distance(a: list, b: list) -> int:
    """Word edit distance by Myers' bit vectors."""
    if not a:
        return len(b)
    where = {}
    for i, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << i
    full, last = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = full, 0, len(a)
    for y in b:
        eq = where.get(y, 0)
        vertical = eq | down
        diagonal = (((eq & up) + up) ^ up) | eq
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        score += bool(plus & last) - bool(minus & last)
        plus = (plus << 1 | 1) & full
        up = (minus << 1 | ~(vertical | plus)) & full
        down = plus & vertical
    return score


def find_items(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``(doc_id, item_id, first_word, distance)``: each pair of a document and an item it holds, with the best window.

    Words are runs of ASCII letters and digits and of other non-ASCII characters, A-Z as a-z; each character of
    a script without spaces is one. Null and
    empty texts hold nothing; items of under MIN_WORDS words are not sought. Ties go to the
    first window. Rows that repeat an id count as one document, also those with a null id. Other columns are not read.
    """
    spark = docs.sparkSession
    known = materialize(item_keys(items), "items")
    lengths = sorted(r["n"] for r in known.select("n").distinct().collect())
    schema = "doc_id long, start long, n long, window binary, keys array<bigint>"
    if not lengths:
        return spark.createDataFrame([], "doc_id long, item_id long, first_word long, distance long")
    keys = known.select(F.explode("keys").alias("key"), "n", "item_id", "item")
    place = F.col("key").bitwiseAND(F.lit(TABLE_BITS - 1)).alias("place")
    search = spark.sparkContext.broadcast(
        Search(
            lengths,
            _packed(known.select(F.explode("grams").alias("place")).distinct()),
            _packed(keys.select(place).distinct()),
        )
    )

    def per_batch(batches):
        find = search.value
        for batch in batches:
            out = []
            for chunk in chunks(batch.column(1), lower=True):
                starts, ends, rows, hashes = _words(chunk)
                for row in find.rows_with_marks(hashes, rows):
                    a, b = np.searchsorted(rows, [row, row + 1]).tolist()
                    doc_id = batch.column(0)[chunk.first + row].as_py()
                    for start, width, n, hits in find.windows(hashes[a:b]):
                        window = chunk.data[starts[a + start] : ends[a + start + width - 1]].tobytes()
                        out.append({"doc_id": doc_id, "start": start, "n": n, "window": window, "keys": hits})
            if out:
                yield pa.RecordBatch.from_pylist(out, WINDOWS)

    WINDOWS = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("start", pa.int64()),
            ("n", pa.int64()),
            ("window", pa.binary()),
            ("keys", pa.list_(pa.int64())),
        ]
    )

    def verify(batches):
        for batch in batches:
            distances = []
            for window, item in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                distances.append(edit_distance(split_words(window), split_words(item)))
            distances = np.array(distances, np.int64)
            limits = np.array([allowed(n) for n in batch.column(4).to_pylist()], np.int64)
            ids = batch.select([0, 1, 5]).columns
            columns = [ids[0], ids[1], ids[2], pa.array(distances)]
            kept = pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "item_id", "distance"])
            yield kept.filter(pa.array(distances <= limits))

    windows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(per_batch, schema)
    pairs = (
        windows.select("doc_id", "start", "n", "window", F.explode("keys").alias("key"))
        .join(keys.hint("merge"), ["key", "n"])
        .select("doc_id", "start", "window", "item", "n", "item_id")
        .distinct()
    )
    found = pairs.mapInArrow(verify, "doc_id long, start long, item_id long, distance long")
    return (
        found.groupBy("doc_id", "item_id")
        .agg(F.min(F.struct("distance", "start")).alias("best"))
        .select("doc_id", "item_id", F.col("best.start").alias("first_word"), "best.distance")
    )


def split_words(text: bytes) -> list:
    data = np.frombuffer(text, np.uint8)
    starts, ends, _ = characters_apart(data, *Chunk(0, data, np.array([0, len(data)])).spans(ALNUM))
    return [text[a:b] for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item; all columns stay. A null id matches a null id."""
    found = find_items(docs, items).select(F.col("doc_id").alias("held")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["held"]), "left_anti")
