"""Hard negatives, shards and periodic runs against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from compare import differences
from starkeep.llm import negatives, sharding
from starkeep.llm.negatives import Windows, mine, scan
from starkeep.llm.periodic import collapse_runs
from starkeep.llm.queries import ORACLE, QUERIES
from starkeep.llm.sharding import place, write_shards
from starkeep.llm.suffixes import SuffixArray, periodic_stretches, previous_smaller

FOLDER = "/root/testdata/sf0.001"
BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def words(text):
    return re.findall(f"[^{BLANK}]+", text or "")


# Periodic runs.


def runs_of(w, least=6, copies=4):
    """Every stretch that keeps a period and cannot be extended, under its smallest period."""
    found = {}
    for q in range(1, len(w) // copies + 1):
        i = 0
        while i + q < len(w):
            start = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            length = i + q - start
            if i > start and length >= max(least, copies * q):
                found.setdefault((start, length), q)
            i += i == start
    return sorted((s, n, q) for (s, n), q in found.items())


def periodic_docs(rng, number):
    docs = []
    for _ in range(number):
        n, k = rng.randrange(60), rng.randrange(1, 4)
        w = [rng.randrange(k) for _ in range(n)]
        if n > 8 and rng.random() < 0.5:
            a, p = rng.randrange(n), rng.randrange(1, 8)
            w = [w[i if i < a else min(n - 1, a + (i - a) % p)] for i in range(n)]
        docs.append(w)
    return docs


def laid(docs):
    lengths = [len(w) for w in docs]
    bounds = np.append(0, np.cumsum(lengths))
    rows = np.repeat(np.arange(len(docs)), lengths)
    symbols = np.array([10 * d + x for d, w in enumerate(docs) for x in w], np.int64)
    return symbols, bounds[rows], bounds[rows + 1], rows


def test_enhanced_suffix_array():
    docs = periodic_docs(random.Random(1), 20)
    symbols, starts, stops, _ = laid(docs)
    found = SuffixArray(symbols, starts, stops)
    suffixes = [tuple(symbols[i : stops[i]]) for i in range(len(symbols))]
    assert found.order.tolist() == sorted(range(len(symbols)), key=lambda i: suffixes[i])
    assert (found.order[found.rank] == np.arange(len(symbols))).all()
    for p in range(1, len(symbols)):
        a, b = suffixes[found.order[p - 1]], suffixes[found.order[p]]
        shared = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        assert found.lcp[p] == shared
    values = np.append(0, np.random.default_rng(1).integers(1, 6, 300))
    want = [max(q for q in range(p) if values[q] < values[p]) for p in range(1, 301)]
    assert previous_smaller(values, np.arange(1, 301)).tolist() == want


@pytest.mark.parametrize("copies, least", [(4, 6), (2, 2), (3, 5)])
def test_periodic_stretches(copies, least):
    rng = random.Random(2)
    for _ in range(150):
        docs = periodic_docs(rng, rng.randrange(1, 5))
        symbols, starts, stops, rows = laid(docs)
        got = [[] for _ in docs]
        for s, n, q in zip(*periodic_stretches(symbols, starts, stops, copies, least), strict=True):
            got[rows[s]].append((int(s - starts[s]), int(n), int(q)))
        assert got == [runs_of(w, least, copies) for w in docs]


def collapsed(w, runs):
    gone = {k for s, n, q in runs for k in range(s + q, s + n)}
    return " ".join(x for k, x in enumerate(w) if k not in gone)


def test_collapse_runs(spark, nothing):
    long = " ".join(f"w{k % 700}" for k in range(30_000))
    texts = ["a b " * 5, "x\ty\n" + "é " * 9 + "y", "a a a a a", "a a a a a a", None, "", " \n", long, "a b c " * 4]
    rows = [(i, t, "clash", 1, "c") for i, t in enumerate(texts)] + [(0, texts[0], "", 2, ""), (None, "z " * 7, "", 3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, start long, period string")
    got = Counter((r["doc_id"], tuple(map(tuple, r["runs"])), r["text"]) for r in collapse_runs(docs).collect())
    want = Counter()
    for i, t, *_ in rows:
        w = words(t)
        found = [(0, 30_000, 700)] if t is long else runs_of(w)
        want[i, tuple(found), collapsed(w, found)] += 1
    assert got == want
    assert collapse_runs(nothing).collect() == []


def test_periodic_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    want, tails = {}, 0
    for i, text in docs:
        w = words(text)
        h = zlib.crc32(str(i).encode())
        if h % 10 == 0 and w:
            g, n = h // 10, len(w)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[k if k < a else a + (k - a) % p] for k in range(n)]
            tails += 1
        found = runs_of(w) if len(w) < 3000 else None
        if found is None:
            continue
        top = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        exponent = 1000 * top[1] // top[2] if found else None
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in found)
        texts = (hashlib.sha256(t.encode()).hexdigest() for t in (lines, collapsed(w, found)))
        want[i] = (i, len(found), *top, exponent, *texts)
    got = {r["doc_id"]: tuple(r) for r in QUERIES["op13_periodic_runs"](spark, FOLDER).collect()}
    assert len(got) == len(docs) and tails > 10 and sum(r[1] for r in want.values()) > 10
    assert {i: got[i] for i in want} == want


# Shards.


def shards_of(placed):
    out = defaultdict(list)
    for r in placed.collect():
        out[r["shard"]].append(r)
    for found in out.values():
        assert sorted(r["slot"] for r in found) == list(range(len(found)))
    return out


@pytest.fixture(scope="module")
def hot_docs(spark):
    """A third of the rows are one text without ids, a third empty ones, some long; columns that clash."""
    rng = random.Random(4)
    texts = [" ".join(rng.choice("abcdefg") * rng.randrange(1, 9) for _ in range(rng.randrange(300))) for _ in range(2000)]
    rows = [(i, t, 0, "s") for i, t in enumerate(texts)]
    rows += [(None, "copy " * 100, 1, "s")] * 2000 + [(i, "" if i % 2 else None, 2, None) for i in range(2000)]
    rows += [(9000 + i, "x" * 40_000, 3, "s") for i in range(3)] + [rows[5]] * 4
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, text string, shard int, slot string").repartition(5)


def test_shards_are_nearly_equal(hot_docs):
    docs = hot_docs.collect()
    shards = shards_of(place(hot_docs, 8))
    key = lambda i, t: (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))
    assert Counter(key(r["doc_id"], r["text"]) for r in docs) == Counter(tuple(r)[:3] for s in shards.values() for r in s)
    sizes = [sum(r["size"] for r in s) for s in shards.values()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) < 0.01 * sum(sizes) / 8
    where = defaultdict(set)
    for shard, found in shards.items():
        for r in found:
            where[r["text_crc32"]].add(shard)
    assert len(where[zlib.crc32(b"copy " * 100)]) > 1
    repeated = next(r["text"] for r in docs if r["doc_id"] == 5 and r["text"])
    assert len(where[zlib.crc32(repeated.encode())]) == 1


def test_overfull_ranges_are_subdivided(hot_docs):
    keyed = sharding._keyed(hot_docs.select("doc_id", "text"), False)
    splitters, held = sharding._subdivided(keyed, 8, 16)
    total, rows = sum(b for _, b, _ in held), sum(n for *_, n in held)
    limit = 2 * total / (8 * 16)
    assert rows == hot_docs.count() and len(held) >= 64
    for _, size, n in held:
        assert n == 1 or size + n * total / rows <= max(2 * limit, 2 * total / 8 * sharding.WHOLE)
    drawn = list(zip(range(100), [1.0] * 50 + [100.0] + [1.0] * 49, strict=True))
    cuts = list(sharding._cuts(drawn, 10))
    assert (50, sharding.LOWEST, sharding.LOWEST, 0) in cuts and (50, sharding.HIGHEST, sharding.HIGHEST, 1) in cuts


def test_shards_of_little(spark, nothing, tmp_path):
    assert place(nothing).collect() == []
    assert place(nothing).columns == ["doc_id", "size", "text_crc32", "shard", "slot"]
    one = spark.createDataFrame([(None, None, "r")], "doc_id long, text string, record string")
    assert [tuple(r)[:3] for r in place(one).collect()] == [(None, 8, 0)]
    few = spark.createDataFrame([(i, "t" * i, "r") for i in range(9)], "doc_id long, text string, record string")
    write_shards(few, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(tuple(r) for r in back.select("record.*").collect()) == sorted(tuple(r) for r in few.collect())
    assert back.select("shard", "slot").distinct().count() == 9


def test_sharding_query(spark):
    found = QUERIES["op12_sharding"](spark, FOLDER)
    assert found.filter("law <> 'bytes' OR grown_shard IS NOT NULL OR shard NOT BETWEEN 0 AND 23").isEmpty()
    sizes = [sum(r["size"] for r in s) for s in shards_of(found).values()]
    assert len(sizes) == 24 and max(sizes) < 1.02 * min(sizes)
    again = QUERIES["op12_sharding"](spark, FOLDER)
    assert found.exceptAll(again).isEmpty() and found.count() == again.count() == 200


# Hard negatives.


def first_rows(rows, k):
    return sorted(rows, key=lambda r: (-r[0], r[1]))[:k]


def mined(rows, step):
    """By all scores of all anchors."""
    used = []
    for i, (vec_id, label, v, *_) in enumerate(rows):
        if None in (vec_id, label, v) or any(x is None or not np.isfinite(x) for x in v):
            continue
        limit = 2.0**31 / max(1, len(v)) ** 0.5
        if all(abs(256 * x) + 1 <= limit for x in v):
            used.append((i, vec_id, label, [int(np.floor(256 * x)) for x in v]))
    out = Counter()
    for i, anchor, label, a in used:
        if anchor % step:
            continue
        scores = [(sum(map(int.__mul__, a, b)), o, lab) for j, o, lab, b in used if j != i and len(b) == len(a)]
        for score, positive, _ in first_rows([s for s in scores if s[2] == label], 5):
            near = [s for s in scores if s[2] != label and 80 * score <= 100 * s[0] <= 100 * score]
            for rank, (n, o, _) in enumerate(first_rows(near, 5), 1):
                out[anchor, positive, rank, o, score, n] += 1
    return out


def vector_rows(rng):
    rows = []
    for i in range(400):
        n = 5 if i % 9 == 0 else 12
        rows.append((i, i % 3, [float(x) for x in rng.normal(0.4, 0.3, n)], "clash", i))
    rows += [rows[20], rows[20], rows[41]]
    rows += [(400 + i, 1, [0.5] * 12, "tie", 0) for i in range(12)]
    rows += [(None, 1, [0.5] * 12, "", 0), (500, None, [0.5] * 12, "", 0), (520, 1, None, "", 0)]
    rows += [(540, 1, [None] * 12, "", 0), (560, 1, [float("nan")] * 12, "", 0), (580, 1, [float("inf")] * 12, "", 0)]
    rows += [(600, 1, [], "", 0), (601, 1, [], "", 0), (602, 2, [], "", 0), (620, 1, [3e38] * 12, "", 0)]
    rows += [(640, 1, [-0.5] * 12, "", 0), (660, 2, [0.0] * 12, "", 0)]
    return rows


VECTORS = "vec_id long, label int, embedding array<float>, uid string, rank int"


@pytest.mark.parametrize("chunk", [negatives.CHUNK_BYTES, 700])
def test_mined_negatives(spark, monkeypatch, chunk):
    monkeypatch.setattr(negatives, "CHUNK_BYTES", chunk)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    try:
        rows = vector_rows(np.random.default_rng(3))
        table = spark.createDataFrame(rows, VECTORS)
        read = [tuple(r) for r in table.collect()]
        got = Counter(tuple(r) for r in mine(table, 20).collect())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = mined(read, 20)
    assert got == want and len(want) > 200
    assert (600, 601, 1, 602, 0, 0) in want


def test_scan_leaves_rows_out_early():
    rng = np.random.default_rng(5)
    matrix = rng.integers(-300, 300, (2000, 32))
    block = negatives.Block(np.arange(2000), np.arange(2000), np.zeros(2000, int), matrix)
    anchor = (1000 / (1 + np.arange(32)) ** 2).astype(np.int64)
    scores = matrix @ anchor
    seen = []

    class Watched(Windows):
        def possible(self, lower, upper):
            assert (lower <= upper).all()
            seen.append(len(lower))
            return super().possible(lower, upper)

    windows = Watched([-(1 << 63)], [(1 << 63) - 1], 5)
    scan(block, anchor, np.ones(2000, bool), windows)
    assert windows.found[0][2].tolist() == np.lexsort((np.arange(2000), -scores))[:5].tolist()
    assert seen[:2] == [2000, 2000] and max(seen[2:]) < 500


def test_few_vectors(spark):
    none = spark.createDataFrame([], VECTORS)
    assert mine(none).collect() == []
    alone = spark.createDataFrame([(100, 1, [1.0], "", 0), (1, 2, [1.0], "", 0)], VECTORS)
    assert mine(alone).collect() == []


def test_negatives_query(spark):
    found = QUERIES["op11_hard_negatives"](spark, FOLDER)
    assert differences(found, ORACLE["op11_hard_negatives"], FOLDER) == []
    assert found.filter(F.col("positive_id") == F.col("anchor_id")).isEmpty()
