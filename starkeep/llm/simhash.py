"""Near-duplicate documents by SimHash fingerprints.

Fingerprints are made from word shingles inside the tasks that read the texts. From then on only
distinct fingerprints matter, so exact copies, however many, are one row. The 64 bits are split into five blocks.
Two fingerprints with at most two different bits agree in at least three blocks, so each
fingerprint is filed under its ten choices of three blocks and those alone under all ten keys are
set aside. The others are verified without forming pairs: two fingerprints differ in at most two
bits exactly if some 64-bit number differs from each of them in at most one bit. Each number has at
most 65 fingerprints around it, so no group is ever larger, whatever the data are like.
"""

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkeep.llm.graph import connected_components
from starkeep.sources.files import materialize

SEED = 42
SHINGLE = 3
LINK_BITS = 2
BLOCKS = (13, 13, 13, 13, 12)


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Bit i is one if it is set in more than half of the shingles' hashes; no words give zero."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    places = zip(starts.tolist(), ends[width - 1 :].tolist(), strict=False)
    hashes = np.array([digest(line[i:j], SEED) for i, j in places], dtype="<u8")
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):
        piece = hashes[k : k + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(piece, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return sum(1 << i for i in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``(doc_id, print)``, one row a document; the fingerprint's 64 bits as a long."""

    def per_batch(batches):
        for batch in batches:
            prints = [_signed(fingerprint(t.as_py(), shingle)) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], ["doc_id", "print"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(per_batch, "doc_id long, print long")


def _block_masks(blocks=BLOCKS, bits: int = LINK_BITS) -> list[int]:
    """A mask for each choice of blocks of which all must agree."""
    masks, low = [], 0
    for width in blocks:
        masks.append(((1 << width) - 1) << low)
        low += width
    return [_signed(sum(chosen)) for chosen in combinations(masks, len(blocks) - bits)]


def block_keys(value: Column, blocks=BLOCKS, bits: int = LINK_BITS) -> Column:
    """An array of ``(t, key)``, one for each choice of blocks; fingerprints at most ``bits`` apart have one in common."""
    masks = enumerate(_block_masks(blocks, bits))
    return F.array(*(F.struct(F.lit(k).alias("t"), value.bitwiseAND(F.lit(m)).alias("key")) for k, m in masks))


def distance(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def links(prints: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints, at most two bits apart, that hold together
    all that are linked. ``prints`` has distinct values in column ``print``."""
    value = F.col("print")
    filed = prints.select(value, F.explode(block_keys(value)).alias("k")).select("print", "k.t", "k.key")
    shared = (
        filed.groupBy("t", "key")
        .agg(F.min("print").alias("low"), F.max("print").alias("high"))
        .filter("low != high")
        .select("t", "key")
    )
    near = filed.join(shared, ["t", "key"], "left_semi").select("print").distinct()
    around = F.array(value, *(value.bitwiseXOR(F.lit(_signed(1 << i))) for i in range(64)))
    hub = F.min("print").over(Window.partitionBy("middle"))
    return (
        near.select(value, F.explode(around).alias("middle"))
        .withColumn("hub", hub)
        .filter((value != F.col("hub")) & (distance(value, F.col("hub")) <= LINK_BITS))
        .select(value.alias("a"), F.col("hub").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` among the documents that links lead to, the
    document itself included. Null and empty texts have fingerprint zero and link like any
    other. Rows with a null id keep it; it never is a component's id unless the component has no other. Rows
    that repeat an id are fingerprinted each for itself. Other columns of ``docs`` are not read.
    """
    prints = materialize(fingerprints(docs), "simhash")
    least = prints.groupBy("print").agg(F.min("doc_id").alias("first"))
    parts = connected_components(links(least.select("print")), "simhash-links")
    merged = least.join(parts, least["print"] == parts["node"], "left").select(
        "print", "first", F.coalesce("component", "print").alias("root")
    )
    smallest = merged.groupBy("root").agg(F.min("first").alias("component_id"))
    named = merged.join(smallest, "root").select("print", "component_id")
    return prints.join(named, "print").select(
        "doc_id",
        F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is their component's: one document of each group.

    Rows with a null id are kept, since nothing tells them apart.
    """
    kept = near_duplicates(docs).filter("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.filter("doc_id IS NULL"))
