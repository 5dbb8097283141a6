"""Near-copies of documents: five-word shingles at a Jaccard similarity of 0.8, verified exactly.

Texts with equal shingle sets are one row from the start. Each gets the SimHash fingerprint of its five-word shingles, which
is filed under its 35 choices of three of seven blocks: fingerprints at most LINK_BITS apart share one of them at least. Pairs of a block
join that are so near are candidates, verified on their whole sets of shingle hashes.

At a similarity of 0.8 about ten of 64 bits differ, too many for blocks that must agree. Texts are therefore also filed
under BANDS MinHash keys of ROWS minima each, which add the links beyond LINK_BITS. Two texts of similarity s share such a key with
probability 1 - (1 - s**ROWS)**BANDS, 0.9996 at 0.8.

Keys of up to SMALL texts are compared in all pairs. Larger groups are dealt into parts of about SMALL texts, where each
text is compared with the part's first. Texts of keys whose texts that leaves in several components are then joined exactly, by prefix filter: two
sets similar to SIMILAR share one of the first 20 % of their shingles, in an order that puts rarer ones first. Shingles of up to SMALL of these
texts are compared in all pairs of different components. Two texts whose first common shingle is more frequent have no rare one in common; so
texts with equal frequent shingles need only be compared with the shortest of them, and those with other ones with the
shortest of each such class. A pair goes on only if its sets' parities allow it: each shingle turns one of PARITY bits, so two sets
differ in at least as many shingles as bits, and sets similar to SIMILAR differ in at most a ninth of both their shingles. Texts that are
alike but not near copies, however many, thus leave few pairs. A link is lost in no group, however large; only a pair that shares no key at all is.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkeep.llm.decontamination import TABLE_BITS, _in, _packed
from starkeep.llm.graph import connected_components
from starkeep.llm.scratch import settled
from starkeep.llm.simhash import _signed, block_keys, fingerprint
from starkeep.llm.words import NOT_BLANK, chunks, mixed, runs, span_hashes

SHINGLE = 5
SIMILAR = 0.8
LINK_BITS = 4
BLOCKS = (10, 9, 9, 9, 9, 9, 9)
BANDS, ROWS = 20, 5
SMALL = 16
PLACES = 1 << 22
PARITY = 512
ODD = [f"p{k}" for k in range(PARITY // 64)]
SEED = 20240602

_salts = mixed(np.arange(2 * BANDS * ROWS, dtype=np.uint64) + np.uint64(SEED)).reshape(2, -1)
_salts[1] |= np.uint64(1)


def shingle_sets(column):
    """The sorted distinct shingle hashes of each text, in order; of under five words, one shingle of all."""
    for chunk in chunks(column, lower=True):
        starts, ends, rows = chunk.spans(NOT_BLANK)
        hashes = span_hashes(chunk.prefix(), starts, ends)
        grams = runs(hashes, SHINGLE)
        bounds = np.searchsorted(rows, np.arange(chunk.rows + 1)).tolist()
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            yield np.unique(grams[a : b - SHINGLE + 1] if b - a >= SHINGLE else runs(hashes[a:b], max(1, b - a)))


def print_of(shingles: np.ndarray) -> int:
    """A number for the set; equal sets, equal numbers."""
    return int(np.array(xxhash.xxh64_intdigest(shingles.tobytes(), SEED), np.uint64).view(np.int64))


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """One key for each band; none for the empty set, which has no near copies but itself."""
    if not len(shingles):
        return np.zeros(0, np.int64)
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), 1 << 12):
        piece = (shingles[k : k + (1 << 12), None] ^ _salts[0]) * _salts[1]
        np.minimum(least, piece.min(axis=0), out=least)
    keys = np.arange(BANDS, dtype=np.uint64)
    for row in mixed(least).reshape(BANDS, ROWS).T:
        keys = mixed(keys * np.uint64(31) + row)
    return keys.view(np.int64)


def _sketches(docs: DataFrame) -> DataFrame:
    def per_batch(batches):
        for batch in batches:
            prints, keys = [], []
            for shingles in shingle_sets(batch.column(1)):
                prints.append(print_of(shingles))
                keys.append(band_keys(shingles))
            bits = [_signed(fingerprint(t.as_py(), SHINGLE)) for t in batch.column(1)]
            columns = [batch.column(0), pa.array(prints, pa.int64()), pa.array(bits, pa.int64()), pa.array(keys, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "print", "bits", "keys"])

    schema = "doc_id long, print long, bits long, keys array<bigint>"
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(per_batch, schema)


def _blocked(texts: DataFrame) -> DataFrame:
    """``(print, key, bits)``: texts under their fingerprint's choices of blocks."""
    filed = texts.select("print", "bits", F.explode(block_keys(F.col("bits"), BLOCKS, LINK_BITS)).alias("k"))
    return filed.select("print", F.xxhash64("k.t", "k.key").alias("key"), "bits")


def _banded(texts: DataFrame) -> DataFrame:
    """``(print, key, bits)``: texts under their MinHash keys, without bits."""
    return texts.select("print", F.explode("keys").alias("key"), F.lit(None).cast("long").alias("bits"))


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``(print, shingles)`` of the ``wanted`` prints, one row each. A bit table of bounded size keeps the others from being shuffled."""
    place = F.col("print").bitwiseAND(F.lit(TABLE_BITS - 1)).alias("place")
    table = docs.sparkSession.sparkContext.broadcast(_packed(wanted.select(place).distinct()))

    def per_batch(batches):
        for batch in batches:
            prints, sets = [], []
            for shingles in shingle_sets(batch.column(0)):
                number = print_of(shingles)
                if _in(table.value, np.array([number & (TABLE_BITS - 1)]))[0]:
                    prints.append(number)
                    sets.append(shingles.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(prints, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], ["print", "shingles"])

    found = docs.select("text").mapInArrow(per_batch, "print long, shingles array<bigint>")
    return found.join(wanted, "print", "left_semi").groupBy("print").agg(F.first("shingles").alias("shingles"))


def _verified(docs: DataFrame, pairs: DataFrame) -> DataFrame:
    """The ``pairs (a, b)`` whose shingle sets are similar to SIMILAR or more."""
    sets = settled(_sets(docs, pairs.select(F.col("a").alias("print")).union(pairs.select("b")).distinct()), "shingles")

    def per_batch(batches):
        for batch in batches:
            near = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = x.values.to_numpy(), y.values.to_numpy()
                both = len(np.intersect1d(x, y, assume_unique=True))
                near.append(both >= SIMILAR * (len(x) + len(y) - both) - 1e-9)
            yield batch.select([0, 1]).filter(pa.array(near, pa.bool_()))

    left = sets.select(F.col("print").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("print").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(per_batch, "a long, b long")


def _parts(rows: DataFrame, turn: int) -> DataFrame:
    """``rows (print, key, n, ...)`` of keys that n texts share, dealt into parts ``(key, part)`` of about SMALL."""
    part = F.when(F.col("n") > SMALL, F.pmod(F.xxhash64("print", "key", F.lit(turn)), F.ceil(F.col("n") / SMALL)))
    return rows.withColumn("part", F.coalesce(part, F.lit(0)))


def _sized(rows: DataFrame, *same) -> DataFrame:
    """``rows (print, key)`` with the number ``n`` of texts at the key, where it is over one."""
    counts = rows.groupBy("key").agg(F.count("*").alias("n"), *same).filter("n > 1")
    return rows.join(counts, "key")


def links(docs: DataFrame, filed: DataFrame) -> DataFrame:
    """``(node, component)`` of the prints that near copies hold together.

    ``filed (print, key, bits)`` has their keys. Where ``bits`` is not null, pairs more than LINK_BITS apart are left out.
    """
    bands = settled(_sized(filed), "bands")
    near = f"coalesce(bit_count(x.bits ^ y.bits) <= {LINK_BITS}, true)"
    pair = "struct(x.print AS a, y.print AS b)"
    every = F.expr(f"flatten(transform(m, x -> transform(filter(m, y -> y.print < x.print AND {near}), y -> {pair})))")
    first = F.expr(
        f"flatten(transform(array(array_min(m)), y -> transform(filter(m, x -> x.print > y.print AND {near}), x -> {pair})))"
    )
    grouped = _parts(bands, 0).groupBy("key", "part", "n").agg(F.collect_set(F.struct("print", "bits")).alias("m"))
    pairs = grouped.select(F.explode(F.when(F.col("n") <= SMALL, every).otherwise(first)).alias("p"))
    edges = settled(_verified(docs, settled(pairs.select("p.*").distinct(), "pairs")), "near")
    nodes = connected_components(edges, "near-components")
    large = bands.filter(F.col("n") > SMALL).select("print", "key")
    if large.isEmpty():
        return nodes

    known = nodes.select(F.col("node").alias("print"), "component")
    labelled = large.join(known, "print", "left").withColumn("component", F.coalesce("component", "print"))
    ends = labelled.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    split = labelled.join(ends.filter("low != high").select("key"), "key", "left_semi").select("print", "component").distinct()
    crossing = settled(_crossing(docs, settled(split, "split")), "pairs")
    new = settled(_verified(docs, crossing), "near")
    return nodes if new.isEmpty() else connected_components(edges.union(new), "near-components")


def _levels(sets: DataFrame) -> np.ndarray:
    """How frequent shingles are, by their places: 0 for one text, k for up to 2**k. Of shingles at one place the most frequent counts.

    At most PLACES rows reach the driver.
    """

    def per_batch(batches):
        for batch in batches:
            tokens, texts = np.unique(batch.column(0).flatten().to_numpy(), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(texts)], ["token", "df"])

    counts = sets.select("shingles").mapInArrow(per_batch, "token long, df long").groupBy("token").agg(F.sum("df").alias("df"))
    level = F.length(F.bin(F.col("df") - 1)).cast("tinyint")
    place = F.col("token").bitwiseAND(F.lit(PLACES - 1)).cast("int")
    found = counts.filter("df > 1").groupBy(place.alias("place")).agg(F.max(level).alias("level")).toArrow()
    table = np.zeros(PLACES, np.uint8)
    table[found.column("place").to_numpy()] = found.column("level").to_numpy()
    return table


def _prefixes(sets: DataFrame) -> DataFrame:
    """The sets' first shingles in the order of ``_levels``, of which ``rare`` many are in up to SMALL texts.

    ``class`` is a digest of all frequent shingles, null unless one is among the first. The bits ``p0, p1, ...``
    tell at how many of PARITY places the set has an odd number of shingles.
    """
    table = sets.sparkSession.sparkContext.broadcast(_levels(sets))
    most = (SMALL - 1).bit_length()

    def per_batch(batches):
        for batch in batches:
            classes, rare, first, parity = [], [], [], []
            for shingles in batch.column(3):
                shingles = shingles.values.to_numpy()
                level = table.value[shingles & (PLACES - 1)]
                n = len(shingles)
                order = np.lexsort((shingles, level))[: n - int(np.ceil(n * SIMILAR - 1e-9)) + 1]
                first.append(shingles[order])
                rare.append(int((level[order] <= most).sum()))
                frequent = shingles[level > most]
                classes.append(xxhash.xxh3_128_hexdigest(frequent.tobytes()) if rare[-1] < len(order) else None)
                odd = np.bincount(shingles >> 40 & (PARITY - 1), minlength=PARITY).astype(np.uint8) & 1
                parity.append(np.packbits(odd).view(np.int64))
            columns = [*batch.columns[:3], pa.array(classes, pa.string()), pa.array(rare, pa.int32())]
            columns += [pa.array(first, pa.list_(pa.int64())), *(pa.array(p) for p in np.array(parity, np.int64).reshape(-1, len(ODD)).T.copy())]
            yield pa.RecordBatch.from_arrays(columns, ["print", "component", "n", "class", "rare", "first", *ODD])

    schema = "print long, component long, n int, class string, rare int, first array<bigint>, " + ", ".join(f"{p} long" for p in ODD)
    return sets.select("print", "component", F.size("shingles").alias("n"), "shingles").mapInArrow(per_batch, schema)


def _alike(x: str, y: str) -> str:
    """Whether two sets can be similar: their sizes and the places where one is odd and one even, no more than shingles of one alone."""
    apart = " + ".join(f"bit_count({x}.{p} ^ {y}.{p})" for p in ODD)
    most = f"({x}.n + {y}.n) * {1 - 2 * SIMILAR / (1 + SIMILAR)}D + 1e-6D"
    return f"({x}.component != {y}.component AND abs({x}.n - {y}.n) <= {most} AND {apart} <= {most})"


def _crossing(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of ``texts (print, component)`` that join all that are similar in different components; some are not similar."""
    sets = settled(_sets(docs, texts.select("print")).join(texts, "print"), "shingles")
    ranked = settled(_prefixes(sets), "ranked")
    marked = ranked.select("print", "component", "n", *ODD, "rare", F.posexplode("first").alias("at", "token"))

    members = F.sort_array(F.collect_set(F.struct("print", "component", "n", *ODD)))
    rare = marked.filter("at < rare").groupBy("token").agg(members.alias("m")).filter(F.size("m") > 1)
    unlike = F.expr(
        f"flatten(transform(m, x -> transform(filter(m, y -> y.print < x.print AND {_alike('x', 'y')}), y -> struct(x.print AS a, y.print AS b))))"
    )
    near = rare.select(F.explode(unlike).alias("p")).select("p.*")

    classed = ranked.filter("class IS NOT NULL").select("class", "print", "component", "n", *ODD)
    heads = classed.groupBy("class").agg(F.min(F.struct("n", "print", "component", *ODD)).alias("head")).select("class", "head.*")
    heads = settled(heads, "heads")
    within = classed.alias("x").join(heads.alias("y"), "class").filter(_alike("x", "y")).select(F.col("x.print").alias("a"), F.col("y.print").alias("b"))

    # across classes: the first common shingle's places bound what can be common
    left = marked.filter("at >= rare")
    right = left.join(heads.select("print"), "print", "left_semi").hint("shuffle_hash")
    both = f"least(x.n - x.at, y.n - y.at) >= (x.n + y.n) * {SIMILAR / (1 + SIMILAR)}D - 1e-6D"
    met = F.expr(f"x.token = y.token AND {both} AND {_alike('x', 'y')}")
    across = left.alias("x").join(right.alias("y"), met).select(F.col("x.print").alias("a"), F.col("y.print").alias("b"))
    return near.union(within).union(across).distinct()


def near_copies(docs: DataFrame) -> DataFrame:
    """``(doc_id, component_id)``, one row per row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` among the documents that chains of near copies lead to. Words are cut
    at white space, A-Z as a-z. Texts without words are copies of each other. Rows with a null id keep it; it never is a
    component's id unless the component has no other.
    """
    sketches = settled(_sketches(docs), "sketches")
    same = F.min("doc_id").alias("first"), F.min("bits").alias("bits"), F.first("keys").alias("keys")
    least = settled(sketches.groupBy("print").agg(*same), "sketches")
    parts = links(docs, _blocked(least).union(_banded(least)))
    rooted = least.join(parts, least["print"] == parts["node"], "left").select(
        "print", "first", F.coalesce("component", "print").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = rooted.join(smallest, "root").select("print", "component_id")
    return sketches.join(named, "print").select("doc_id", "component_id")


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose id is their component's: one document of each group.

    Rows with a null id are kept, since nothing tells them apart.
    """
    kept = near_copies(docs).filter("doc_id = component_id").select("doc_id").distinct()
    return docs.join(kept, "doc_id", "left_semi").unionByName(docs.filter("doc_id IS NULL"))
