"""Shards of nearly equal bytes by sampled splitters.

Records are ordered by the digest of their text, then by id, so equal texts lie side by side and the order
says nothing of source or age. Keys are drawn with a probability that grows with their record's size; the
quantiles of the draw cut the order into many more ranges than there are shards. The ranges' true
bytes and rows are then summed, and ranges that turned out overfull are drawn from again and subdivided: between
texts first, within one text of many copies by ids, and where even these repeat by a number the rows got. Whole
ranges are dealt to the shards: heavy ones to the least filled shard, the rest in their order up to one level.

Only drawn keys and one row a range reach the driver, both bounded by parameters.
"""

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starkeep.llm.scratch import settled

SHARDS = 24
#: Ranges aimed at for each shard, keys drawn for each range, rounds of subdividing at most.
PIECES, DRAWS, ROUNDS = 256, 16, 20
#: Bytes a record has besides its text.
OVERHEAD = 8
#: Ranges above this part of a shard are dealt by weight, not by order; equal texts above this part are spread.
HEAVY, WHOLE = 1 / 128, 1 / 8
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1
SCALE = 1 << 53


def _key_bytes(digest, doc, tie, after) -> np.ndarray:
    """Keys as byte strings that compare as the keys do."""
    out = np.empty((len(digest), 25), np.uint8)
    for k, column in enumerate((digest, doc, tie)):
        lifted = column.astype(np.int64).view(np.uint64) ^ np.uint64(1 << 63)
        out[:, 8 * k : 8 * k + 8] = lifted.astype(">u8").view(np.uint8).reshape(-1, 8)
    out[:, 24] = after
    return out.reshape(-1).view("S25")


class Splitters:
    """Sorted keys ``(digest, doc, tie, after)``; a range holds the records from one of them up to the next."""

    def __init__(self, keys):
        self.keys = sorted(set(keys))
        columns = np.array(self.keys, dtype=object).reshape(-1, 4).T
        self.digests = columns[0].astype(np.int64)
        self.bytes = _key_bytes(*(c.astype(np.int64) for c in columns))

    def range_of(self, digest, doc, tie) -> np.ndarray:
        found = np.searchsorted(self.digests, digest, side="left")
        close = np.flatnonzero(np.searchsorted(self.digests, digest, side="right") > found)
        if len(close):
            keys = _key_bytes(digest[close], doc[close], tie[close], np.zeros(len(close), np.uint8))
            found[close] = np.searchsorted(self.bytes, keys, side="right")
        return found.astype(np.int32)


def _keyed(docs: DataFrame, carry: bool) -> DataFrame:
    """Sizes, checksums and keys, written once: ``tie`` numbers the rows, so no two rows have one key."""
    record = [F.struct(*docs.columns).alias("record")] if carry else []
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64("text").alias("digest"),
        F.xxhash64(F.monotonically_increasing_id()).alias("tie"),
        *record,
    )
    return settled(rows, "sharding").withColumn("doc", F.coalesce("doc_id", F.lit(LOWEST)))


def _ranged(keyed: DataFrame, splitters: Splitters, columns: list[str]) -> DataFrame:
    """The columns and the number of each row's range."""
    shared = keyed.sparkSession.sparkContext.broadcast(splitters)
    rows = keyed.select("digest", "doc", "tie", *columns)

    def per_batch(batches):
        for batch in batches:
            key = [batch.column(k).to_numpy() for k in range(3)]
            found = pa.array(shared.value.range_of(*key), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, found], [*batch.schema.names, "range"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields]
    return rows.mapInArrow(per_batch, ", ".join([*fields, "range int"]))


def _draw(rows: DataFrame, names: list[str], weight, rate: float, seed: int):
    """Keys of records drawn with probability ``weight * rate``, with the weight they stand for, in order."""
    dice = F.pmod(F.xxhash64(F.lit(seed), "digest", "doc"), F.lit(SCALE)) / SCALE
    drawn = rows.filter(dice < weight * rate).groupBy(*names)
    drawn = drawn.agg(F.sum(F.greatest(weight, F.lit(1 / rate))).alias("weight")).toArrow()
    drawn = drawn.sort_by([(n, "ascending") for n in names])
    return zip(*(drawn[n].to_pylist() for n in (*names, "weight")), strict=True)


def _cuts(drawn, limit: float):
    """Splitters at the quantiles of the drawn weight; a key that fills a range by itself gets its own."""
    seen, bucket = 0.0, 0
    for *key, weight in drawn:
        rest = 3 - len(key)
        if weight > limit or int(seen / limit) > bucket:
            yield (*key, *[LOWEST] * rest, 0)
        if weight > limit:
            yield (*key, *[HIGHEST] * rest, 1)
        bucket = max(bucket, int(seen / limit))
        seen += weight


def _subdivided(keyed: DataFrame, shards: int, pieces: int):
    """Splitters, and ``(range, bytes, rows)`` of the ranges between them.

    A record weighs its size and the average size, so neither bytes nor rows of a range get out of hand.
    """
    spark = keyed.sparkSession
    total, rows = keyed.agg(F.sum("size"), F.count("*")).first()
    mean = total / rows
    weight = F.col("size") + mean
    limit = 2 * total / (shards * pieces)
    whole = 2 * total / shards * WHOLE
    splitters = Splitters(_cuts(_draw(keyed, ["digest"], weight, DRAWS / limit, 0), limit))
    for seed in range(1, ROUNDS + 1):
        ranged = _ranged(keyed, splitters, ["size"])
        ends = [f(c).alias(f"{n} {c}") for n, f in (("low", F.min), ("high", F.max)) for c in ("digest", "doc")]
        held = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), *ends).collect()
        several, of_one_text, more = [], [], []
        for r in held:
            heft = r["bytes"] + mean * r["rows"]
            one_text, one_id = (r[f"low {c}"] == r[f"high {c}"] for c in ("digest", "doc"))
            if r["rows"] == 1 or heft <= (whole if one_text else 2 * limit):
                continue
            if one_text and one_id:
                parts = -int(-heft // limit)
                more += [(r["low digest"], r["low doc"], LOWEST + (k << 64) // parts, 0) for k in range(1, parts)]
            else:
                (of_one_text if one_text else several).append((r["range"],))
        for chosen, names in ((several, ["digest"]), (of_one_text, ["digest", "doc"])):
            if chosen:
                inside = ranged.join(F.broadcast(spark.createDataFrame(chosen, "range int")), "range")
                more += _cuts(_draw(inside, names, weight, DRAWS / limit * seed, seed), limit)
        finer = Splitters([*splitters.keys, *more])
        if seed == ROUNDS or len(finer.keys) == len(splitters.keys):
            return splitters, [(r["range"], r["bytes"], r["rows"]) for r in held]
        splitters = finer


def _dealt(held, shards: int):
    """``(range, shard, first slot)``: shards of nearly equal bytes, slots in the order of the ranges."""
    held = sorted(held)
    fair = sum(b for _, b, _ in held) / shards
    heavy = sorted((h for h in held if h[1] > fair * HEAVY), key=lambda h: (-h[1], h[0]))
    load = [(0, s) for s in range(shards)]
    shard_of = {}
    for number, size, _ in heavy:
        filled, shard = heapq.heappop(load)
        shard_of[number] = shard
        heapq.heappush(load, (filled + size, shard))
    filled = np.zeros(shards)
    for size, shard in load:
        filled[shard] = size
    light = [h for h in held if h[0] not in shard_of]
    rest = sum(b for _, b, _ in light)
    # one level up to which the rest fills the shards that lie below it
    levels = np.sort(filled)
    level = next((rest + levels[:k].sum()) / k for k in range(shards, 0, -1) if (rest + levels[:k].sum()) / k >= levels[k - 1])
    ends = np.cumsum(np.maximum(level - filled, 0))
    before = 0
    for number, size, _ in light:
        shard_of[number] = min(int(np.searchsorted(ends, before + size / 2, side="left")), shards - 1)
        before += size
    first, out = [0] * shards, []
    for number, _, rows in held:
        shard = shard_of[number]
        out.append((number, shard, first[shard]))
        first[shard] += rows
    return out


def place(docs: DataFrame, shards: int = SHARDS, pieces: int = PIECES, carry: bool = False) -> DataFrame:
    """``(doc_id, size, text_crc32, shard, slot)``, one row a document, and its ``record`` with ``carry``.

    ``size`` is the text's bytes and 8. The shards' bytes are nearly equal: they differ by a few parts in a thousand,
    or by what one document larger than that forces. Equal texts lie in one shard unless they make
    more than an eighth of one; then they are spread. ``slot`` counts a shard's rows from 0 without gaps. Null and
    empty texts are records of 8 bytes; null ids and repeated rows are placed like any other (rows that are equal throughout
    are interchangeable); with few or no rows some or all shards are empty. Of ``docs`` only ``doc_id`` and ``text``
    are read, unless ``carry`` puts whole rows into a struct, where names cannot clash.
    """
    spark = docs.sparkSession
    keyed = _keyed(docs, carry)
    extra = ["record"] if carry else []
    columns = ["doc_id", "size", "text_crc32", "shard", "slot", *extra]
    if keyed.isEmpty():
        none = keyed.withColumns({"shard": F.lit(0), "slot": F.lit(0).cast("long")})
        return none.select(*columns)
    splitters, held = _subdivided(keyed, shards, pieces)
    # one row a range
    plan = spark.createDataFrame(_dealt(held, shards), "range int, shard int, first long")
    rows = _ranged(keyed, splitters, ["doc_id", "size", "text_crc32", *extra]).join(F.broadcast(plan), "range")
    order = Window.partitionBy("range").orderBy("digest", "doc", "tie")
    slot = F.col("first") + F.row_number().over(order) - 1
    return rows.withColumn("slot", slot).select(*columns)


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS) -> None:
    """The documents as ``folder/shard=<n>/``, each row with its ``slot`` beside the whole ``record``."""
    placed = place(docs, shards, carry=True).select("shard", "slot", "record")
    placed.write.mode("overwrite").partitionBy("shard").parquet(folder)
