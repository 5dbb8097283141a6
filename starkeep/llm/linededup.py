"""Lines that stand in many documents stay in one of them.

Two Bloom filters tell which lines may stand in more than one document; only those
are shuffled, to be counted exactly. A filter has a bounded size: where a corpus has
more lines than it can tell apart, the lines' hashes are dealt into slices, and each
slice has its own filters. The lines' hashes are written once, by slice, so every slice reads its own rows only.
"""

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkeep.llm.bloom import bits_for, contains, twice_filter
from starkeep.sources.files import scratch_path

MIN_CHARS = 20
MIN_DOCS = 3
#: Bits of a filter: 32 MB; a slice has 1/16 as many lines.
MOST_BITS = 1 << 28


def line_key(line: bytes) -> bytes:
    """A line without [\\x20\\x09-\\x0D] at its ends, A-Z as a-z."""
    return line.strip().lower()


def _digests(text: str | None, min_chars: int):
    """Lines of a text with the 16-byte digest of their key; None for short keys."""
    for line in (text or "").encode("utf-8", "replace").split(b"\n"):
        key = line_key(line)
        long_enough = len(key) >= min_chars and (
            len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars
        )
        yield line, hashlib.blake2b(key, digest_size=16).digest() if long_enough else None


def long_lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """``(doc_id, digest, h)``: the distinct long keys of each row."""

    def per_batch(batches):
        for batch in batches:
            ids, digests = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                found = {d for _, d in _digests(text.as_py(), min_chars)} - {None}
                ids += [doc_id] * len(found)
                digests += found
            hashes = [int.from_bytes(d[:8], "little", signed=True) for d in digests]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(hashes, pa.int64())],
                ["doc_id", "digest", "h"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        per_batch, "doc_id long, digest binary, h long"
    )


def _suspects(lines: DataFrame, bits: int) -> DataFrame:
    """Rows of lines whose hash may stand in two rows."""
    shared = lines.sparkSession.sparkContext.broadcast(twice_filter(lines.select("h"), bits))

    def per_batch(batches):
        for batch in batches:
            found = contains(shared.value, batch.column(2).to_numpy(zero_copy_only=False))
            yield batch.select([0, 1]).filter(pa.array(found))

    return lines.select("doc_id", "digest", "h").mapInArrow(per_batch, "doc_id long, digest binary")


def repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, most_bits: int = MOST_BITS) -> DataFrame:
    """``(doc_id, digest)``: for each document the keys whose lines it must lose."""
    spark = docs.sparkSession
    path = scratch_path(spark, "lines")
    sizes = docs.agg(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)).first()
    count = int(sizes[0] or 0)
    slices = -(-count * 16 // most_bits) or 1
    keys = long_lines(docs, min_chars).withColumn("slice", F.pmod(F.shiftright("h", 40), F.lit(slices)))
    keys.write.partitionBy("slice").parquet(path)
    table = spark.read.schema("doc_id long, digest binary, h long, slice int").parquet(path)
    bits = bits_for(-(-count // slices), most_bits)
    parts = [_suspects(table.filter(F.col("slice") == k), bits) for k in range(slices)]
    suspects = reduce(DataFrame.union, parts)
    repeated = (
        suspects.distinct()
        .groupBy("digest")
        .agg(F.count("doc_id").alias("n"), F.max("doc_id").alias("keep"))
        .filter(F.col("n") >= min_docs)
    )
    return (
        suspects.distinct()
        .join(repeated, "digest")
        .filter(~F.col("doc_id").eqNullSafe(F.col("keep")))
        .select("doc_id", "digest")
    )


def drop_repeated_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, most_bits: int = MOST_BITS) -> DataFrame:
    """``docs`` with repeated lines taken out of ``text``, and with ``n_lines`` and ``n_dropped``.

    A text is cut at line feeds; null or empty, it is one empty line. A key of at least
    ``min_chars`` code points found in at least ``min_docs`` documents loses all its lines but
    those of the largest ``doc_id`` that holds it. A text that loses nothing stays as it is, null
    included. Rows with the same id are one document with several texts; rows with a null id are
    not counted as documents, and lose the lines that others repeat. Columns of ``docs`` named
    ``n_lines`` or ``n_dropped`` are replaced. A key is known by its 128-bit digest.
    """
    docs = docs.drop("n_lines", "n_dropped")
    drops = (
        repeated_lines(docs, min_chars, min_docs, most_bits)
        .groupBy("doc_id")
        .agg(F.collect_set("digest").alias("digests"))
        .select(F.col("doc_id").alias("drop_id"), "digests")
    )
    names = docs.columns
    joined = docs.join(drops, docs["doc_id"].cast("long").eqNullSafe(drops["drop_id"]), "left")
    joined = joined.select(*(docs[c] for c in names), drops["digests"])
    at = names.index("text")

    def per_batch(batches):
        for batch in batches:
            texts, lines, dropped = [], [], []
            for text, drop in zip(batch.column(at), batch.column(len(names)), strict=True):
                text = text.as_py()
                lines.append((text or "").count("\n") + 1)
                if drop.is_valid:
                    gone = set(drop.as_py())
                    kept = [line for line, d in _digests(text, min_chars) if d not in gone]
                    dropped.append(lines[-1] - len(kept))
                    text = b"\n".join(kept).decode() if dropped[-1] else text
                else:
                    dropped.append(0)
                texts.append(text)
            columns = batch.columns[: len(names)]
            columns[at] = pa.array(texts, columns[at].type)
            columns += [pa.array(lines, pa.int64()), pa.array(dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "n_lines", "n_dropped"])

    schema = docs.schema.add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(per_batch, schema)
