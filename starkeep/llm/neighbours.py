"""Approximate nearest neighbours by inner product, with an inverted multi-index.

Vectors are cut in halves and each half is quantised by a codebook of its own, so a cell is a pair
of centroids. For a query the pairs are visited in order of the sum of the two centroids' inner
products with its halves, by a heap over the two sorted lists, until the cells hold enough
entries. How many are enough is measured on the sample the codebooks are fitted on: the share of all entries
within which RECALL of the true neighbours lie. Cells are packed into parts of bounded size (a
larger cell into several), and a query goes once to each part, with the cells it visits there. Entries of
those cells alone are reranked, exactly.
"""

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starkeep.sources.files import materialize

TOP = 20
QUERY_STEP = 20
#: Centroids of each half, and vectors they are fitted on (those whose ids hash lowest).
CENTROIDS = 48
SAMPLE = 20_000
ROUNDS = 12
SEED = 11
#: Share of true neighbours aimed at, queries of the sample it is measured on, and entries any query visits.
RECALL = 0.95
TRIALS = 200
LEAST_VISITED = 1000
#: Entries and queries of one part.
PART_ENTRIES, PART_QUERIES = 4096, 4096


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, embedding)`` with doubles; no null, zero or non-finite vectors and no null ids."""
    values = F.col("embedding").cast("array<double>")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    some = F.exists("embedding", lambda x: x != 0)
    ids = F.col("vec_id").cast("long").alias("vec_id")
    rows = vectors.select(ids, values.alias("embedding")).filter("vec_id IS NOT NULL AND embedding IS NOT NULL")
    return rows.filter(F.coalesce(fine & some, F.lit(False)))


def _kmeans(points: np.ndarray, k: int) -> np.ndarray:
    """Centroids by Lloyd's rounds from distinct points spread by greedy sampling."""
    rng = np.random.default_rng(SEED)
    distinct = np.unique(points, axis=0)
    centres = distinct[rng.integers(len(distinct))][None]
    gap = ((distinct - centres[0]) ** 2).sum(axis=1)
    while len(centres) < min(k, len(distinct)):
        pick = rng.choice(len(distinct), p=gap / gap.sum())
        centres = np.vstack((centres, distinct[pick]))
        gap = np.minimum(gap, ((distinct - distinct[pick]) ** 2).sum(axis=1))
    for _ in range(ROUNDS):
        near = _nearest(points, centres)
        counts = np.bincount(near, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


def _nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1) - 2 * points @ centres.T).argmin(axis=1)


class Codebooks:
    """Centroids of the first and the second half of vectors of one length."""

    def __init__(self, sample: np.ndarray, k: int = CENTROIDS):
        self.length = sample.shape[1]
        self.cut = (self.length + 1) // 2
        self.halves = [_kmeans(half, k) if half.shape[1] else np.zeros((1, 0)) for half in self._split(sample)]
        self.width = len(self.halves[1])
        self.cells = len(self.halves[0]) * self.width

    def _split(self, vectors):
        return vectors[:, : self.cut], vectors[:, self.cut :]

    def cells_of(self, vectors: np.ndarray) -> np.ndarray:
        a, b = (_nearest(half, c) for half, c in zip(self._split(vectors), self.halves, strict=True))
        return a * self.width + b

    def visit(self, query: np.ndarray, counts: np.ndarray, enough: int) -> list[int]:
        """Non-empty cells in order of the centroids' summed inner products, until `enough` entries."""
        first, second = (c @ h[0] for h, c in zip(self._split(query[None]), self.halves, strict=True))
        order = [np.argsort(-first, kind="stable").tolist(), np.argsort(-second, kind="stable").tolist()]
        heap, cells, total = [(-(first[order[0][0]] + second[order[1][0]]), 0, 0)], [], 0
        while heap and total < enough:
            _, i, j = heapq.heappop(heap)
            cell = order[0][i] * self.width + order[1][j]
            if counts[cell]:
                cells.append(cell)
                total += int(counts[cell])
            # a pair is reached from the left only, and from above only in the first column
            if j + 1 < len(order[1]):
                heapq.heappush(heap, (-(first[order[0][i]] + second[order[1][j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(order[0]):
                heapq.heappush(heap, (-(first[order[0][i + 1]] + second[order[1][0]]), i + 1, 0))
        return cells


def _matrix(column) -> np.ndarray:
    """Rows of a list column of equal lengths without nulls."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def visited_share(books: Codebooks, sample: np.ndarray, top: int = TOP) -> float:
    """The share of entries to visit for RECALL, from the sample's own neighbours."""
    cells = books.cells_of(sample)
    counts = np.bincount(cells, minlength=books.cells)
    needed = []
    for k in range(min(TRIALS, len(sample))):
        scores = sample @ sample[k]
        scores[k] = -np.inf
        best = np.argpartition(-scores, min(top, len(scores)) - 1)[:top]
        first, second = (c @ h[0] for h, c in zip(books._split(sample[k][None]), books.halves, strict=True))
        order = np.argsort(-(first[:, None] + second).ravel(), kind="stable")
        reached = np.empty(books.cells)
        reached[order] = np.cumsum(counts[order])
        needed.append(reached[cells[best[best != k]]])
    needed = np.concatenate(needed)
    return float(np.quantile(needed, RECALL)) / len(sample) if len(needed) else 1.0


def _parts(counts: np.ndarray):
    """For each cell its first part and how many parts it has; neighbouring small cells share a part."""
    first, pieces = np.zeros(len(counts), np.int32), np.ones(len(counts), np.int32)
    part, filled = 0, 0
    for cell, n in enumerate(counts.tolist()):
        if n > PART_ENTRIES:
            part += filled > 0
            first[cell], pieces[cell] = part, -(-n // PART_ENTRIES)
            part, filled = part + int(pieces[cell]), 0
            continue
        if filled + n > PART_ENTRIES:
            part, filled = part + 1, 0
        first[cell] = part
        filled += n
    return first, pieces


def _best(top: int, entries: pa.Table, queries: pa.Table) -> pa.Table:
    """The first ``top`` entries of one part for each query of one part, among the cells the query visits."""
    kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])
    if not entries.num_rows or not queries.num_rows:
        return kind.empty_table()
    entries = entries.sort_by("vec_id")
    ids, cells, vectors = entries["vec_id"].to_numpy(), entries["cell"].to_numpy(), _matrix(entries["embedding"])
    here, cell = np.unique(cells, return_inverse=True)
    members = [np.flatnonzero(cell == k) for k in range(len(here))]
    out = []
    for at in range(0, queries.num_rows, 256):
        asked = queries.slice(at, 256)
        query_ids, points = asked["query_id"].to_numpy(), _matrix(asked["embedding"])
        visits = asked["cells"].combine_chunks()
        row = np.repeat(np.arange(len(visits)), np.diff(visits.offsets.to_numpy()))
        column = np.searchsorted(here, visits.flatten().to_numpy())
        visited = np.zeros((len(visits), len(here)), bool)
        visited[row, column] = True
        scores = np.full((len(visits), len(ids)), -np.inf)
        for k, entry in enumerate(members):
            rows = np.flatnonzero(visited[:, k])
            # each score is a sum in the order of the components, so equal vectors get equal scores
            scores[np.ix_(rows, entry)] = np.einsum("ij,kj->ik", points[rows], vectors[entry])
        scores[query_ids[:, None] == ids[None, :]] = -np.inf
        most = min(top, len(ids))
        least = -np.partition(-scores, most - 1, axis=1)[:, most - 1]
        for r in range(len(visits)):
            maybe = np.flatnonzero((scores[r] >= least[r]) & (scores[r] > -np.inf))
            maybe = maybe[np.argsort(-scores[r, maybe], kind="stable")][:most]
            out.append((np.full(len(maybe), query_ids[r]), ids[maybe], scores[r, maybe]))
    columns = [pa.array(np.concatenate(c)) for c in zip(*out, strict=True)]
    return pa.Table.from_arrays(columns, schema=kind)


def nearest(vectors: DataFrame, step: int = QUERY_STEP, top: int = TOP) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose id ``step`` divides, its nearest others.

    Nearness is the inner product in double precision, ties going to the smaller id. Vectors that
    are null, zero, or have null or non-finite components take no part, nor do null ids. Vectors of each length have an
    index of their own, since an inner product needs two of one length. All entries of its length but the query's own id are
    candidates; a query with fewer
    gets them all. Repeated rows of an id count as one if equal. Other columns are not read.
    """
    rows = usable(vectors)
    schema = "query_id long, rank int, vec_id long, score double"
    lengths = [r["n"] for r in rows.select(F.size("embedding").alias("n")).distinct().orderBy("n").collect()]
    found = [_nearest_of_length(rows.filter(F.size("embedding") == n), step, top) for n in lengths]
    return reduce(DataFrame.unionByName, found) if found else vectors.sparkSession.createDataFrame([], schema)


def _nearest_of_length(rows: DataFrame, step: int, top: int) -> DataFrame:
    """As ``nearest``, for usable vectors of one length."""
    spark = rows.sparkSession
    rows = rows.distinct()
    chosen = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow()
    sample = _matrix(chosen.column(0))
    books = Codebooks(sample)
    shared = spark.sparkContext.broadcast(books)

    def assign(batches):
        for batch in batches:
            cells = shared.value.cells_of(_matrix(batch.column(1)))
            columns = [*batch.columns, pa.array(cells, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "embedding", "cell"])

    entries = materialize(rows.mapInArrow(assign, "vec_id long, embedding array<double>, cell int"), "entries")
    held = {r["cell"]: r["count"] for r in entries.groupBy("cell").count().collect()}
    counts = np.zeros(books.cells, np.int64)
    counts[list(held)] = list(held.values())
    enough = max(LEAST_VISITED, int(visited_share(books, sample, top) * counts.sum()))
    first, pieces = _parts(counts)
    sizes = spark.sparkContext.broadcast((counts, first, pieces))

    def visit(batches):
        """A query once for each part it goes to, with its cells there."""
        counts, first, pieces = sizes.value
        for batch in batches:
            ids, vectors, parts, cells = [], [], [], []
            for query_id, vector in zip(batch.column(0).to_pylist(), _matrix(batch.column(1)), strict=True):
                by_part = {}
                for cell in shared.value.visit(vector, counts, enough):
                    for part in range(first[cell], first[cell] + pieces[cell]):
                        by_part.setdefault(int(part), []).append(cell)
                ids += [query_id] * len(by_part)
                vectors += [vector] * len(by_part)
                parts += by_part
                cells += by_part.values()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array(vectors, pa.list_(pa.float64())),
                    pa.array(parts, pa.int32()),
                    pa.array(cells, pa.list_(pa.int32())),
                ],
                ["query_id", "embedding", "part", "cells"],
            )

    # one row a cell, CENTROIDS squared at most
    plan = spark.createDataFrame(list(zip(range(books.cells), first.tolist(), pieces.tolist(), strict=True)), "cell int, first int, pieces int")
    asking = entries.filter(F.col("vec_id") % step == 0).select(F.col("vec_id").alias("query_id"), "embedding")
    rounds = max(1, -(-asking.count() // PART_QUERIES))
    asking = asking.mapInArrow(visit, "query_id long, embedding array<double>, part int, cells array<int>")
    asking = asking.withColumn("round", F.pmod(F.xxhash64("query_id"), F.lit(rounds)))
    offered = (
        entries.join(F.broadcast(plan), "cell")
        .withColumn("part", F.col("first") + F.pmod(F.xxhash64("vec_id"), F.col("pieces")).cast("int"))
        .withColumn("round", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(rounds - 1).cast("long"))))
        .select("part", "round", "vec_id", "cell", "embedding")
    )
    best = (
        offered.groupBy("part", "round")
        .cogroup(asking.groupBy("part", "round"))
        .applyInArrow(lambda key, e, q: _best(top, e, q), "query_id long, vec_id long, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    return ranked.select("query_id", "rank", "vec_id", "score")
