"""Mixing sources to target weights.

The words of each source, laid end to end, are cut into blocks of fixed length. A mix is a set of slots: each source has
as many as its target asks for, and each slot draws its output shard, so the
counts of sources in a shard are multinomial, given that the sources' totals are met. The k-th slot of a source
takes the k-th block of a pseudorandom permutation of the source's block numbers, one round after another;
so no block is taken three times before all are taken twice. Slots and blocks meet in a join by
source and block number. Everything is a DataFrame expression, and nothing depends on how rows are dealt
out: the same documents give the same mix.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starkeep.sources.files import materialize

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MOST = 2.0
BLOCK_WORDS = 128
SHARD_SLOTS = 1024
ROUNDS = 16
SEED = 7
WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one source whose places are counted together, and slots made from one row and in one task.
BUCKET = 4096
TASK_SLOTS = 1 << 16


def sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size)``: words of each row's text; null has none."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select("doc_id", "source", size.alias("size"))


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(sid, source, source_size, weight, target)``, one row a source.

    Sources are numbered by code point, null last, and weigh ``weights`` over and over. They share
    ``share`` times all words by weight; a target stops at ``most`` times its source's size and
    the excess is shared by weight among the others. Ordered by cap over weight, the capped
    sources come first, so one pass finds the level at which all is given out.
    """
    every = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_level = Window.orderBy(F.col("cap") / F.col("weight"), "sid")
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    table = (
        sized.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(by_name) - 1)
        .withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.col("sid") % len(weights) + 1))
        .withColumn("cap", most * F.col("source_size"))
    )
    given = F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weighed = F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (share * F.sum("source_size").over(every) - given) / (F.sum("weight").over(every) - weighed)
    table = table.withColumn("level", level)
    free = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.struct(F.row_number().over(by_level), "level"))
    table = table.withColumn("free", free)
    reached = F.min("free").over(every).getField("level")
    target = F.least("cap", F.coalesce(reached * F.col("weight"), "cap"))
    return table.select("sid", "source", "source_size", "weight", target.alias("target"))


def laid_out(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """``(doc_id, sid, size, start)``: where the words of each non-empty row begin in its source.

    Rows of a source are dealt into buckets by a hash of the id; sums over the few buckets and places within
    a bucket give each start, so no task holds a source.
    """
    buckets = max(1, sized.count() // BUCKET)
    rows = (
        sized.filter("size > 0")
        .join(targets.select("sid", F.col("source").alias("name")), F.col("source").eqNullSafe(F.col("name")))
        .select("doc_id", "sid", "size", F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).alias("bucket"))
    )
    earlier = Window.partitionBy("sid").orderBy("bucket")
    bases = (
        rows.groupBy("sid", "bucket")
        .agg(F.sum("size").alias("words"))
        .select("sid", "bucket", (F.sum("words").over(earlier) - F.col("words")).alias("base"))
    )
    place = Window.partitionBy("sid", "bucket").orderBy("doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumn("within", F.sum("size").over(place) - F.col("size"))
        .join(bases, ["sid", "bucket"])
        .select("doc_id", "sid", "size", (F.col("base") + F.col("within")).alias("start"))
    )


def pieces(laid: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``laid`` for each block a row has words in: ``block``, ``first`` (its first word there) and ``words``."""
    start, end, block = F.col("start"), F.col("start") + F.col("size"), F.col("block")
    blocks = F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(start + size - 1) div {block_words}"))
    low, high = F.greatest(start, block * block_words), F.least(end, (block + 1) * block_words)
    return (
        laid.withColumn("block", F.explode(blocks))
        .withColumn("first", low - start)
        .withColumn("words", high - low)
    )


def permuted(index: Column, size: Column, source: Column, seed: int = SEED) -> Column:
    """A pseudorandom permutation of 0..size-1 for each source: the swap-or-not shuffle."""

    def swap(x, turn):
        partner = F.pmod(F.pmod(F.xxhash64(F.lit(seed), source, turn), size) - x, size)
        coin = F.xxhash64(F.lit(seed), source, turn, F.greatest(x, partner)).bitwiseAND(F.lit(1))
        return F.when(coin == 1, partner).otherwise(x)

    return F.aggregate(F.array(*map(F.lit, range(ROUNDS))), index, swap)


def slots(targets: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> DataFrame:
    """``(shard, sid, slot, block)``: the slots of every source, the shard each drew, and its block."""
    blocks = F.ceil(F.col("source_size") / block_words)
    wanted = F.round(F.col("target") * blocks / F.col("source_size")).cast("long")
    plan = targets.filter("source_size > 0").select("sid", blocks.alias("blocks"), wanted.alias("slots"))
    plan = plan.withColumn("shards", F.ceil(F.sum("slots").over(Window.partitionBy()) / shard_slots))
    plan = plan.filter("slots > 0")
    run = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(slots - 1) div {BUCKET}")))
    last = F.least(F.col("slots"), (F.col("run") + 1) * BUCKET) - 1
    tasks = 1 + (plan.agg(F.sum("slots")).first()[0] or 0) // TASK_SLOTS
    made = (
        plan.withColumn("run", run)
        .repartition(tasks, "sid", "run")
        .withColumn("slot", F.explode(F.sequence(F.col("run") * BUCKET, last)))
    )
    return made.select(
        F.pmod(F.xxhash64(F.lit(seed), F.lit("shard"), "sid", "slot"), F.col("shards")).alias("shard"),
        "sid",
        "slot",
        permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.col("sid"), seed).alias("block"),
    )


def mix(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, shards)``, one row per row of ``docs``.

    The slots of all output shards meet the blocks by index, and what each row has there is counted: ``taken`` are its
    words in slots, repeats included, at most twice the size, and ``shards`` the output shards they stand in. Null and empty texts have no words and take no part, nor do sources
    without words (their target is 0). A null source is a source of its own. Rows that repeat an id
    are laid out and taken each for itself. Other columns are not read.
    """
    sized = materialize(sizes(docs), "sizes")
    targets = materialize(source_targets(sized), "targets")
    known = targets.select("sid", "source", "source_size", "target")
    # the planner can't know how many slots come of a few sources, and would broadcast them
    drawn = slots(targets, block_words, shard_slots).select("shard", "sid", "block").hint("merge")
    stands = F.when(F.col("shard").isNotNull(), F.col("words")).otherwise(0)
    taken = (
        pieces(laid_out(sized, targets), block_words)
        .join(drawn, ["sid", "block"], "left")
        .groupBy("doc_id", "sid", "start", "size")
        .agg(F.sum(stands).alias("taken"), F.size(F.collect_set("shard")).cast("long").alias("shards"))
        .join(known, "sid")
    )
    columns = ["doc_id", "source", "size", "source_size", "target", "taken", "shards"]
    empty = (
        sized.filter("size = 0")
        .join(known.withColumnRenamed("source", "name"), F.col("source").eqNullSafe(F.col("name")))
        .withColumns({"taken": F.lit(0).cast("long"), "shards": F.lit(0).cast("long")})
    )
    return taken.select(*columns).unionByName(empty.select(*columns))


def mixed_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """The mix itself: ``(shard, source, slot, block, text)``, the words of each slot's block, one space between.

    ``doc_id`` must tell the rows apart.
    """
    sized = materialize(sizes(docs), "sizes")
    targets = materialize(source_targets(sized), "targets")
    laid = laid_out(sized, targets)
    words = F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))
    piece = F.array_join(F.slice("all", F.col("first") + 1, F.col("words")), " ")
    parts = (
        pieces(laid.join(docs.select("doc_id", words.alias("all")), "doc_id"), block_words)
        .groupBy("sid", "block")
        .agg(F.array_sort(F.collect_list(F.struct("start", piece.alias("text")))).alias("parts"))
        .select("sid", "block", F.array_join(F.col("parts.text"), " ").alias("text"))
    )
    return (
        slots(targets, block_words, shard_slots)
        .hint("merge")
        .join(parts, ["sid", "block"])
        .join(targets.select("sid", "source"), "sid")
        .select("shard", "source", "slot", "block", "text")
    )
