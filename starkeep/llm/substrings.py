"""Passages that repeat word by word are removed but where they first stand.

A window is WINDOW consecutive words. The index is sharded by content, so that equal windows meet in one shard and
no document is held against all shards. A window's anchor is the least hash of its runs of GRAM words, and
neighbouring windows with the same anchor form a segment. Only segments whose anchor stands in several places go on.
Equal segments are counted as one, with the place where they first stand. Each
shard builds an FM-index of its segments and streams them through it by backward search; the
interval of each window's match holds all its occurrences, the first among them. Windows of an
anchor with very many places are sharded each by its own hash, so no shard grows with a common passage.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkeep.llm.fmindex import FMIndex
from starkeep.llm.scratch import settled
from starkeep.llm.words import NOT_BLANK, chunks, runs, span_hashes
from starkeep.sources.files import delete, scratch_path

WINDOW = 20
GRAM = 6
#: Windows of a segment at most; a longer run of one anchor is cut.
MOST_WINDOWS = WINDOW - GRAM + 1
#: Places of an anchor from which its windows are sharded one by one; segments of a shard.
COMMON = 2000
SHARD = 16384


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` consecutive values."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def _words(chunk):
    starts, ends, rows = chunk.spans(NOT_BLANK)
    return starts, ends, rows, span_hashes(chunk.prefix(), starts, ends)


def _segments(hashes, rows):
    """Segments of a chunk: first word, windows, anchor, and whether the anchor stands there twice."""
    if len(hashes) < WINDOW:
        none = np.zeros(0, np.int64)
        return none, none, none.view(np.uint64), none.astype(bool)
    grams = runs(hashes, GRAM)
    anchor = _window_minima(grams, MOST_WINDOWS)
    valid = rows[WINDOW - 1 :] == rows[: len(rows) - WINDOW + 1]
    fresh = np.r_[True, (anchor[1:] != anchor[:-1]) | (rows[1 : len(anchor)] != rows[: len(anchor) - 1])]
    places = np.flatnonzero(valid)
    run_start = np.maximum.accumulate(np.where(fresh, np.arange(len(anchor)), 0))
    first = places[(places - run_start[places]) % MOST_WINDOWS == 0]
    ends = np.searchsorted(places, first)
    count = np.diff(np.r_[ends, len(places)])
    twice = np.zeros(len(first), np.int64)
    for k in range(2 * MOST_WINDOWS - 1):
        at = np.minimum(first + k, len(grams) - 1)
        twice += (grams[at] == anchor[first]) & (k < count + MOST_WINDOWS - 1)
    return first, count, anchor[first], twice > 1


ANCHOR = "anchor long, key long, start long, windows int, weight int"


def anchors(docs: DataFrame) -> DataFrame:
    """``(anchor, key, start, windows, weight)`` of the segments of ``docs (key, text)``."""

    def per_batch(batches):
        for batch in batches:
            keys = batch.column(0).to_numpy()
            for chunk in chunks(batch.column(1)):
                _, _, rows, hashes = _words(chunk)
                first, count, anchor, twice = _segments(hashes, rows)
                row = rows[first]
                origin = np.searchsorted(rows, np.arange(chunk.rows))
                columns = [
                    pa.array(anchor.view(np.int64)),
                    pa.array(keys[chunk.first + row]),
                    pa.array((first - origin[row]).astype(np.int64)),
                    pa.array(count.astype(np.int32)),
                    pa.array((1 + twice).astype(np.int32)),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["anchor", "key", "start", "windows", "weight"])

    return docs.select("key", "text").mapInArrow(per_batch, ANCHOR)


def _suspects(docs: DataFrame) -> DataFrame:
    """``(key, segments)``: for each text its segments whose anchors repeat.

    The table of all anchors and its shuffle files are deleted as soon as the result is written.
    """
    spark = docs.sparkSession
    path = scratch_path(spark, "anchors")
    anchors(docs).write.parquet(path)
    found = spark.read.schema(ANCHOR).parquet(path)
    repeated = found.groupBy("anchor").agg(F.sum("weight").alias("total")).filter("total > 1")
    common = (F.col("total") > COMMON).alias("common")
    suspects = (
        found.join(repeated, "anchor")
        .groupBy("key")
        .agg(F.collect_list(F.struct("start", "windows", common, "anchor")).alias("segments"))
    )
    suspects = settled(suspects, "suspects")
    delete(spark, path)
    return suspects


SEGMENT = "route long, key long, doc_id long, start long, text binary"


def _cut(batches):
    """Texts with their suspected segments to segments; those of common anchors window by window."""
    for batch in (b.slice(k, 500) for b in batches for k in range(0, b.num_rows, 500)):
        out = {name: [] for name in ("route", "key", "doc_id", "start", "text")}

        def add(route, key, doc_id, start, words, out=out):
            for name, value in zip(out, (route, key, doc_id, start, b" ".join(words)), strict=True):
                out[name].append(value)

        for key, doc_id, text, segments in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            words = (text or "").encode("utf-8", "replace").split()
            for s in segments:
                start, windows = s["start"], s["windows"]
                if s["common"]:
                    for i in range(start, start + windows):
                        window = words[i : i + WINDOW]
                        digest = hashlib.blake2b(b" ".join(window), digest_size=8).digest()
                        add(int.from_bytes(digest, "little", signed=True), key, doc_id, i, window)
                else:
                    add(s["anchor"], key, doc_id, start, words[start : start + windows + WINDOW - 1])
        kinds = [pa.int64()] * 4 + [pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds, strict=True)], list(out))


CLEAR = pa.schema([("key", pa.int64()), ("clear", pa.list_(pa.int64()))])


def _first_windows(table: pa.Table) -> pa.Table:
    """One shard: the windows of its segments that stand nowhere earlier, by the text they belong to."""
    ids, sequence, begins, lengths = {}, [], [], []
    for text in table.column("text").to_pylist():
        words = text.split(b" ")
        begins.append(len(sequence))
        lengths.append(len(words))
        sequence += [ids.setdefault(w, len(ids) + 1) for w in words]
        sequence.append(0)
    sequence = np.array(sequence, np.int64)
    begins, lengths = np.array(begins, np.int64), np.array(lengths, np.int64)
    doc = table.column("doc_id").fill_null(-(1 << 63)).to_numpy()
    doc = np.unique(doc, return_inverse=True)[1].astype(np.int64)
    start = table.column("start").to_numpy()
    index = FMIndex(sequence, len(ids) + 1, WINDOW)
    # where each word of the sequence stands in the corpus, as one number that sorts by document and place
    owner = np.repeat(np.arange(len(begins)), lengths + 1)
    order = (doc[owner] << 36) + start[owner] + np.arange(len(sequence)) - begins[owner]
    earliest = np.minimum.reduceat(order[index.places], index.group_starts)
    clear = [[] for _ in begins]
    for texts, place, low, _ in index.matches(sequence, begins, lengths):
        new = earliest[index.group[low]] == order[place]
        for t, p in zip(texts[new].tolist(), (start[texts[new]] + place[new] - begins[texts[new]]).tolist(), strict=True):
            clear[t].append(p)
    rows = [(k, c) for k, c in zip(table.column("key").to_pylist(), clear, strict=True) if c]
    return pa.Table.from_arrays([pa.array([k for k, _ in rows], pa.int64()), pa.array([c for _, c in rows], CLEAR[1].type)], schema=CLEAR)


def _kept(words, segments, clear):
    """Words outside of all windows that stand earlier elsewhere."""
    repeated = np.zeros(len(words) + 1, bool)
    for s in segments:
        repeated[s["start"] : s["start"] + s["windows"]] = True
    for row in clear or ():
        repeated[row] = False
    places = np.flatnonzero(repeated)
    edges = np.zeros(len(words) + WINDOW + 1, np.int64)
    np.add.at(edges, places, 1)
    np.add.at(edges, places + WINDOW, -1)
    gone = np.cumsum(edges)[: len(words)] > 0
    return [w for w, g in zip(words, gone.tolist(), strict=True) if not g], int(gone.sum())


def drop_repeated_passages(docs: DataFrame) -> DataFrame:
    """``docs`` without the words of repeated windows, with ``n_words`` and ``n_removed``.

    Words are cut at [\\x20\\x09-\\x0D]. A word goes if a window that covers it stands earlier too: in
    a smaller ``doc_id``, or earlier in the same. Windows are judged on the texts as given. The
    text becomes the kept words with one space between, also where nothing is removed; null
    becomes empty. A null id comes before all others. Rows that repeat an id and a text
    stand at the same place, so none is earlier. Columns named ``n_words`` or ``n_removed`` are replaced.
    """
    docs = docs.drop("n_words", "n_removed", "_key")
    names, at = docs.columns, docs.columns.index("text")
    keyed = docs.withColumn("_key", F.xxhash64("doc_id", "text"))
    suspects = _suspects(keyed.select(F.col("_key").alias("key"), "text"))
    count = suspects.agg(F.sum(F.size("segments"))).first()[0] or 0
    shards = -(-count // SHARD) or 1
    cut = (
        keyed.join(suspects, keyed["_key"] == suspects["key"])
        .select("key", F.col("doc_id").cast("long"), "text", "segments")
        .mapInArrow(_cut, SEGMENT)
    )
    first = F.min(F.struct("doc_id", "start", "key")).alias("first")
    distinct = cut.groupBy("route", "text").agg(first).select("route", "text", "first.*")
    clear = (
        distinct.withColumn("shard", F.pmod("route", F.lit(shards)))
        .groupBy("shard")
        .applyInArrow(_first_windows, "key long, clear array<bigint>")
        .groupBy("key")
        .agg(F.collect_list("clear").alias("clear"))
    )
    joined = (
        keyed.join(suspects.withColumnRenamed("key", "_key"), "_key", "left")
        .join(clear.withColumnRenamed("key", "_key"), "_key", "left")
        .select(*(keyed[c] for c in names), "segments", "clear")
    )

    def per_batch(batches):
        for batch in batches:
            texts, counts, removed = [], [], []
            columns = (batch.column(at), batch.column(len(names)), batch.column(len(names) + 1))
            for text, segments, clear in zip(*columns, strict=True):
                words = (text.as_py() or "").encode("utf-8", "replace").split()
                counts.append(len(words))
                gone = 0
                if segments.is_valid:
                    words, gone = _kept(words, segments.as_py(), clear.as_py())
                removed.append(gone)
                texts.append(b" ".join(words).decode())
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(texts, columns[at].type)
            columns += [pa.array(counts, pa.int64()), pa.array(removed, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_words", "n_removed"])

    return joined.mapInArrow(per_batch, docs.schema.add("n_words", "long").add("n_removed", "long"))
