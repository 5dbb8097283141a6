"""Hard negatives by a vertical scan with branch and bound over dimensions.

A block of rows lies in columns, one a dimension. For an anchor the columns are read in descending
magnitude of its components, a few at a time. After each the rest can add no less and no more than the
block's smallest and largest values allow, so every row has a lower and an upper score, and rows that
can no longer enter the result leave the candidates; those that remain are scored exactly, in whole numbers.
The first pass finds each anchor's positives, the second, for each positive, the first rows
of other labels in a window below its score. What a task has found so far bounds its next blocks too.

Anchors are taken in chunks of bounded size, all rows pass each chunk in blocks; a task hands on a few
rows an anchor, never scores of pairs.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starkeep.llm.scratch import settled
from starkeep.sources.files import scratch_path

ANCHOR_STEP = 100
#: Components become floor(SCALE * x).
SCALE = 256
POSITIVES, NEGATIVES = 5, 5
#: A negative's score lies between these percentages of its positive's.
WINDOW = (80, 100)
#: Columns read between two looks at the bounds; bytes of the anchors of one chunk.
STRIDE, CHUNK_BYTES = 8, 8 << 20
ROW = "uid long, vec_id long, label long, parts array<long>"


def usable(vectors: DataFrame) -> DataFrame:
    """``ROW`` of the rows that take part; ``uid`` tells repeated rows apart."""
    values = F.col("embedding").cast("array<double>")
    # so far an inner product of two such vectors fits 64 bits
    most = F.sqrt(F.lit(2.0**62) / F.greatest(F.size("embedding"), F.lit(1)))
    fine = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x * SCALE) + 1 <= most))
    rows = vectors.select(
        F.monotonically_increasing_id().alias("uid"),
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        F.when(fine, F.transform(values, lambda x: F.floor(x * SCALE).cast("long"))).alias("parts"),
    )
    return rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND parts IS NOT NULL")


class Block:
    """Rows of one vector length in columns."""

    def __init__(self, uids, ids, labels, matrix: np.ndarray):
        self.uids, self.ids, self.labels = uids, ids, labels
        self.columns = np.ascontiguousarray(matrix.T)
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)


def blocks(batch: pa.RecordBatch) -> dict[int, Block]:
    """A block for each vector length in the batch."""
    uids, ids, labels = (batch.column(n).to_numpy() for n in ("uid", "vec_id", "label"))
    lists = batch.column("parts")
    bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    lengths = np.diff(bounds)
    out = {}
    for n in np.unique(lengths).tolist():
        rows = np.flatnonzero(lengths == n)
        matrix = values[bounds[rows][:, None] + np.arange(n)]
        out[n] = Block(uids[rows], ids[rows], labels[rows], matrix)
    return out


class Windows:
    """Score windows, each to be filled with its ``size`` best rows; higher scores first, then smaller ids."""

    def __init__(self, lows, highs, size: int):
        self.lows, self.highs, self.size = lows, highs, size
        none = np.zeros(0, np.int64)
        self.found = [(none, none, none) for _ in lows]

    def least(self, k: int) -> int:
        """A row below this score cannot enter window k any more."""
        scores = self.found[k][0]
        return max(int(scores[-1]), self.lows[k]) if len(scores) == self.size else self.lows[k]

    def possible(self, lower: np.ndarray, upper: np.ndarray) -> np.ndarray:
        """Rows with a score in [lower, upper] that may still enter one of the windows."""
        alive = np.zeros(len(lower), bool)
        for k, high in enumerate(self.highs):
            least = self.least(k)
            sure = lower[(lower >= least) & (upper <= high)]
            if len(sure) >= self.size:
                least = max(least, int(np.partition(sure, -self.size)[-self.size]))
            alive |= (upper >= least) & (lower <= high)
        return alive

    def add(self, scores, ids, uids) -> None:
        for k, (low, high) in enumerate(zip(self.lows, self.highs, strict=True)):
            inside = (scores >= low) & (scores <= high)
            if inside.any():
                now = zip(self.found[k], (scores[inside], ids[inside], uids[inside]), strict=True)
                merged = [np.concatenate(c) for c in now]
                first = np.lexsort((merged[2], merged[1], -merged[0]))[: self.size]
                self.found[k] = tuple(c[first] for c in merged)


def scan(block: Block, anchor: np.ndarray, alive: np.ndarray, windows: Windows) -> None:
    """Add the rows of the block that are ``alive`` (a bitmap) to the windows they enter."""
    order = np.argsort(-np.abs(anchor), kind="stable")
    weights = anchor[order]
    ends = weights * block.low[order], weights * block.high[order]
    least, most = (np.append(np.cumsum(f(*ends)[::-1])[::-1], 0) for f in (np.minimum, np.maximum))
    rows = np.flatnonzero(alive)
    scores = np.zeros(len(rows), np.int64)
    for at in range(0, len(order), STRIDE):
        keep = windows.possible(scores + least[at], scores + most[at])
        rows, scores = rows[keep], scores[keep]
        if not len(rows):
            return
        for k in range(at, min(at + STRIDE, len(order))):
            scores += weights[k] * block.columns[order[k]][rows]
    windows.add(scores, block.ids[rows], block.uids[rows])


def _found(rows: DataFrame, anchors: pa.Table, windows_of, same_label: bool) -> DataFrame:
    """``(anchor, window, score, vec_id, uid)``: what each task's windows hold at its end.

    ``windows_of[k]`` lists the bounds and the size of the windows of anchor k, if it has any.
    """
    lists = anchors["parts"].combine_chunks()
    bounds, values = lists.offsets.to_numpy(), lists.values.to_numpy()
    uids, labels = anchors["uid"].to_numpy(), anchors["label"].to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast((uids, labels, bounds, values, windows_of))

    def per_partition(batches):
        uids, labels, bounds, values, windows_of = shared.value
        windows = {k: Windows(*w) for k, w in windows_of.items()}
        for batch in batches:
            for length, block in blocks(batch).items():
                for k, mine in windows.items():
                    if bounds[k + 1] - bounds[k] == length:
                        alive = (block.labels == labels[k]) == same_label
                        alive &= block.uids != uids[k]
                        scan(block, values[bounds[k] : bounds[k + 1]], alive, mine)
        for k, mine in windows.items():
            for w, (scores, ids, found) in enumerate(mine.found):
                if len(scores):
                    same = [np.full(len(scores), v, np.int64) for v in (uids[k], w)]
                    columns = [pa.array(c) for c in (*same, scores, ids, found)]
                    yield pa.RecordBatch.from_arrays(columns, ["anchor", "window", "score", "vec_id", "uid"])

    names = "anchor long, window long, score long, vec_id long, uid long"
    found = rows.mapInArrow(per_partition, names)
    order = Window.partitionBy("anchor", "window").orderBy(F.desc("score"), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(order))


def mine(vectors: DataFrame, step: int = ANCHOR_STEP, positives: int = POSITIVES, negatives: int = NEGATIVES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``vectors`` has ``vec_id``, ``label`` and ``embedding``; other columns are not read. Components count as
    floor(256 x); scores are integer inner products. Rows whose id ``step`` divides are anchors. Of an anchor's rows of
    its own label (itself left out) the ``positives`` with the highest scores, ties to the smaller id, are its
    positives; for each the first ``negatives`` rows of other labels with 80 % to 100 % of its score are returned.
    So a positive with a negative score, or one whose window is empty, has no row.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part, nor do those whose
    components are so large (over 2**31 / sqrt(length) after scaling) that a score may not fit 64 bits. Only vectors of one length are
    compared. Repeated rows are rows of their own. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = settled(usable(vectors).repartition(width, "uid"), "vectors")
    asking = rows.filter(F.col("vec_id") % step == 0)
    size = asking.agg(F.coalesce(F.sum(8 * (F.size("parts") + 3)), F.lit(0))).first()[0]
    chunks = -(-size // CHUNK_BYTES)
    kind = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not chunks:
        return spark.createDataFrame([], kind)
    folder = scratch_path(spark, "negatives")
    for number in range(chunks):
        mine_only = F.pmod(F.xxhash64("uid"), F.lit(chunks)) == number
        anchors = asking.filter(mine_only).toArrow()
        every = {k: ([-(1 << 63)], [(1 << 63) - 1], positives) for k in range(anchors.num_rows)}
        best = _found(rows, anchors, every, True).filter(F.col("rank") <= positives)
        # a few rows for each anchor of the chunk
        best = best.sort("anchor", "rank").toArrow()
        place = {uid: k for k, uid in enumerate(anchors["uid"].to_pylist())}
        windows_of, pairs = {}, []
        for uid, score, vec_id in zip(*(best[n].to_pylist() for n in ("anchor", "score", "vec_id")), strict=True):
            if score < 0:
                continue
            k = place[uid]
            lows, highs, _ = windows_of.setdefault(k, ([], [], negatives))
            pairs.append((uid, len(lows), anchors["vec_id"][k].as_py(), vec_id, score))
            lows.append(-(-WINDOW[0] * score // 100))
            highs.append(WINDOW[1] * score // 100)
        known = spark.createDataFrame(pairs, "anchor long, window long, anchor_id long, positive_id long, positive_score long")
        found = _found(rows, anchors, windows_of, False).filter(F.col("rank") <= negatives)
        found = found.join(F.broadcast(known), ["anchor", "window"])
        found = found.select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("vec_id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
        found.write.mode("append").parquet(folder)
    return spark.read.schema(kind).parquet(folder)
