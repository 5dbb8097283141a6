"""Periodic runs of words, and texts with each run cut to its first period.

A document's words become the symbols of an enhanced suffix array (``suffixes``): for each interval of common
prefixes, suffixes of the smaller children are tested for a neighbour one depth further or before,
by rank; the squares found so are turned to the left and merged into runs. Documents are independent:
nothing is shuffled, and a task holds some megabytes of texts, or one long text, at a time.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starkeep.llm.suffixes import periodic_stretches
from starkeep.llm.words import NOT_BLANK, chunks

#: A run has at least so many words, and so many times its period.
LEAST_WORDS = 6
LEAST_PERIODS = 4
RUN = "struct<start:long,length:long,period:long>"


def _codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word; equal words, and no others, have equal numbers."""
    bounds = np.empty(2 * len(starts), np.int64)
    bounds[::2], bounds[1::2] = starts, ends
    buffers = [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))]
    spans = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers)
    return spans.dictionary_encode().indices.to_numpy()[::2].astype(np.int64)


def _per_chunk(chunk) -> tuple[list, list]:
    """Runs and collapsed text of each row."""
    starts, ends, rows = chunk.spans(NOT_BLANK)
    bounds = np.searchsorted(rows, np.arange(chunk.rows + 1))
    runs = [[] for _ in range(chunk.rows)]
    kept = np.ones(len(starts), bool)
    if len(starts):
        codes = _codes(chunk.data, starts, ends)
        symbols = rows * (int(codes.max()) + 1) + codes
        found = periodic_stretches(symbols, bounds[rows], bounds[rows + 1], LEAST_PERIODS, LEAST_WORDS)
        for start, length, period in zip(*(c.tolist() for c in found), strict=True):
            row = int(rows[start])
            runs[row].append((start - int(bounds[row]), length, period))
            kept[start + period : start + length] = False
    data, offsets = chunk.data.tobytes(), chunk.offsets
    texts = []
    for row in range(chunk.rows):
        words = data[offsets[row] : offsets[row + 1]].split()
        if runs[row]:
            words = [words[k] for k in np.flatnonzero(kept[bounds[row] : bounds[row + 1]])]
        texts.append(b" ".join(words))
    return runs, texts


def collapse_runs(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(<key>, runs, text)``, one row a document.

    Words are ``[^\\x20\\x09-\\x0D]+`` of ``text``. A run is a stretch of words with smallest period
    q, at least 6 words and 4q long, that cannot be extended. ``runs`` lists ``(start, length, period)``
    by start, then period, counting words from 0. ``text`` has the words that no run contains after its
    first q, joined by one space. A null or empty text has no runs and an empty text; repeated rows and null
    keys stay rows of their own; other columns are not read; an empty table gives no rows.
    """
    kind = pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))

    def per_batch(batches):
        for batch in batches:
            for chunk in chunks(batch.column(1)):
                runs, texts = _per_chunk(chunk)
                rows = [[dict(zip(("start", "length", "period"), r, strict=True)) for r in of] for of in runs]
                columns = [
                    batch.column(0).slice(chunk.first, chunk.rows),
                    pa.array(rows, kind),
                    pa.array(texts, pa.binary()).cast(pa.string()),
                ]
                yield pa.RecordBatch.from_arrays(columns, [key, "runs", "text"])

    name = docs.select(key).dtypes[0][1]
    return docs.select(key, "text").mapInArrow(per_batch, f"`{key}` {name}, runs array<{RUN}>, text string")


def strongest(runs: Column) -> Column:
    """The run with the greatest length for its period (ties: first start, then period); null without runs."""

    def better(best, run):
        one, other = run["length"] * best["period"], best["length"] * run["period"]
        return F.when(best.isNull() | (one > other), run).otherwise(best)

    return F.aggregate(runs, F.lit(None).cast(RUN), better)


def with_periodic_tail(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``; in each tenth document, by the checksum of its id, the words repeat from some place on.

    With h = crc32 of the decimal id and g = h div 10: if h is a multiple of 10 and there are n > 0
    words, each word i >= a = g mod n becomes word a + (i - a) mod p, p = 1 + (n - a) div (3 + g mod 8). Documents
    without an id keep their texts.
    """
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    g, n = F.floor(h / 10), F.size("_words").cast("long")
    start = g % n
    period = F.lit(1) + F.floor((n - start) / (F.lit(3) + g % 8))
    place = lambda i: F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p"))
    tail = F.transform(
        F.sequence(F.lit(0).cast("long"), F.size("_words").cast("long") - 1),
        lambda i: F.get("_words", place(i).cast("int")),
    )
    chosen = F.coalesce((h % 10) == 0, F.lit(False))
    rows = docs.select("doc_id", "text", F.when(chosen, words).alias("_words"))
    filled = F.col("_words").isNotNull() & (F.size("_words") > 0)
    rows = rows.select("*", F.when(filled, start).alias("_a"), F.when(filled, period).alias("_p"))
    return rows.select("doc_id", F.when(filled, F.array_join(tail, " ")).otherwise(F.col("text")).alias("text"))
