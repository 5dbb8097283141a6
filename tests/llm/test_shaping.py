import json
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from starkeep.llm import chats, mixing, neighbours


def size_of(text):
    return len(re.findall("[^\x20\x09-\x0d]+", text or ""))


def shared_out(sizes, weights=(3, 1, 2)):
    """Targets round by round: whoever is above twice its size stops there."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, target = 1.5 * sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / total > 2 * sizes[s]]
        if not over:
            return target | {s: left * weight[s] / total for s in free}
        for s in over:
            target[s] = 2.0 * sizes[s]
            free.discard(s)
        left -= sum(target[s] for s in over)
    return target


def test_mix(corpus, corpus_rows):
    rows = mixing.mix(corpus, block_words=16).collect()
    assert Counter((r["doc_id"], r["source"], r["size"]) for r in rows) == Counter((r[0], r[3], size_of(r[1])) for r in corpus_rows)
    sizes, taken = Counter(), Counter()
    for r in rows:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    want = shared_out(sizes)
    for r in rows:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == pytest.approx(want[r["source"]])
    assert all(abs(taken[s] - want[s]) <= 16 for s in sizes)
    again = mixing.mix(corpus.repartition(7), block_words=16).collect()
    assert Counter(map(tuple, again)) == Counter(map(tuple, rows))


def test_taken_is_what_the_blocks_hold(spark):
    """Counted anew from the texts of the mixed blocks: every document has words of its own."""
    rng = random.Random(12)
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(rng.randrange(120))), "abc"[i % 3]) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    words, shards = Counter(), defaultdict(set)
    for b in mixing.mixed_blocks(docs, 16, 32).collect():
        for w in b["text"].split():
            words[int(w[1 : w.index("w")])] += 1
            shards[int(w[1 : w.index("w")])].add(b["shard"])
    found = mixing.mix(docs, 16, 32).collect()
    assert {r["doc_id"]: (r["taken"], r["shards"]) for r in found} == {i: (words[i], len(shards[i])) for i, *_ in rows}
    assert max(r["shards"] for r in found) > 1


def test_mix_of_little(corpus, nothing):
    assert mixing.mix(nothing).count() == 0
    assert {r["taken"] for r in mixing.mix(corpus.filter("text IS NULL")).collect()} == {0}


def test_permutation(spark):
    for n in (1, 2, 7, 100):
        df = spark.range(n).select(mixing.permuted(F.col("id"), F.lit(n), F.lit(3)).alias("p"), "id")
        found = [r["p"] for r in df.orderBy("id").collect()]
        assert sorted(found) == list(range(n)) and (n < 100 or found != sorted(found))


def test_blocks_hold_the_words(corpus):
    docs = corpus.filter("doc_id < 60").dropDuplicates(["doc_id"])
    blocks = mixing.mixed_blocks(docs, 16).collect()
    taken = sum(r["taken"] for r in mixing.mix(docs, 16).collect())
    assert sum(len(b["text"].split()) for b in blocks) == taken
    words = defaultdict(Counter)
    for r in docs.collect():
        words[r["source"]].update((r["text"] or "").split())
    assert all(set(b["text"].split()) <= set(words[b["source"]]) for b in blocks)
    assert {len(b["text"].split()) for b in blocks} <= set(range(1, 17))
    shards = Counter(b["shard"] for b in blocks)
    assert len(shards) == -(-len(blocks) // mixing.SHARD_SLOTS)


def tool(i, name, arguments, needs=()):
    return {"id": i, "name": name, "arguments": arguments, "needs": list(needs)}


def test_tools_are_linked_and_ordered(spark):
    calls = [
        tool("b", "f", '{"b": 1.5, "a": 2}', ["a", "elsewhere"]),
        tool("a", "f", '{"a":"x","z":[1, {"k": 2, "j": null}]}'),
        tool("q", "g", "nope", ["r"]),
        tool("r", "f", "[1]", ["q"]),
        tool("c", "f", '{"a": 1}', ["b", "a"]),
        tool("a", "f", '{"a": 7}'),
        tool(None, "f", "{}"),
    ]
    rows = [
        (1, 0, "assistant", json.dumps({"content": "so", "tool_calls": calls})),
        (1, 2, "tool", json.dumps({"tool_call_id": "a", "content": "é\n"})),
        (1, 3, "tool", json.dumps({"tool_call_id": "zz", "content": "lost"})),
        (2, 5, "system", None),
        (2, 6, "user", "a \"question\""),
        (2, 7, "assistant", ""),
        (2, 8, "user", "next"),
        (None, None, None, None),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    schemas = spark.sql(
        """SELECT 'f' AS tool, array(named_struct('name', 'a', 'type', 'integer', 'required', true),
             named_struct('name', 'b', 'type', 'number', 'required', false)) AS fields
           UNION ALL SELECT 'reply', array(named_struct('name', 'prompt', 'type', 'string', 'required', true),
             named_struct('name', 'turn', 'type', 'integer', 'required', true))"""
    )
    found = chats.format_chats(chats.messages_of(turns), schemas).collect()
    of = {(r["conv_id"], r["kind"], r["id"], r["line"]): r for r in found}
    assert len(of) == len(found) == 13
    level = {(r["kind"], r["id"]): r["level"] for r in found if r["conv_id"] == 1}
    assert level["call", "a"] == 0 and level["result", "a"] == 1
    assert level["call", "b"] == 2 and level["call", "c"] == 4
    assert level["call", "q"] is None and level["call", "r"] is None and level["result", "zz"] is None
    faults = {r["line"]: r["faults"] for r in found if r["kind"] == "call"}
    assert faults['{"arguments":{"a":"x","z":[1,{"j":null,"k":2}]},"id":"a","name":"f","turn":0}'] == ["a", "z"]
    assert faults['{"arguments":{"a":2,"b":1.5},"id":"b","name":"f","turn":0}'] == []
    assert faults['{"arguments":{"raw":"nope"},"id":"q","name":"g","turn":0}'] == ["tool", "cycle"]
    assert faults['{"arguments":[1],"id":"r","name":"f","turn":0}'] == ["*", "cycle"]
    linked = {(r["kind"], r["id"]): r["linked"] for r in found if r["conv_id"] == 1}
    assert linked["result", "a"] and not linked["result", "zz"] and not linked["call", "b"]
    plain = [r for r in found if r["conv_id"] == 2]
    assert {(r["kind"], r["id"]): (r["level"], r["linked"]) for r in plain} == {
        ("message", None): (-1, None),
        ("call", "6"): (0, True),
        ("result", "6"): (1, True),
        ("call", "8"): (2, False),
    }
    for r in found:
        assert r["line"] == json.dumps(json.loads(r["line"]), ensure_ascii=False, sort_keys=True, separators=(",", ":"))


def test_whole_chats_keep_content_and_nameless_calls(spark):
    nested = {"id": "n", "function": {"name": "f", "arguments": '{"a": 1}'}}
    rows = [
        (1, 0, "assistant", json.dumps({"content": "so", "tool_calls": [nested, tool(None, "f", '{"a": 2}', ["n"])]})),
        (1, 1, "assistant", json.dumps({"content": None, "tool_calls": []})),
        (1, 2, "assistant", json.dumps({"content": "both", "tool_calls": []})),
        (1, 3, "assistant", json.dumps({"tool_calls": [tool("m", "f", '{"a": 3}')]})),
        (2, None, "user", "when?"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    schemas = spark.sql("SELECT 'f' AS tool, array(named_struct('name', 'a', 'type', 'integer', 'required', true)) AS fields")
    found = chats.format_chats(chats.messages_of(turns), schemas, whole=True).collect()
    lines = {r["line"]: (r["conv_id"], r["kind"], r["level"], r["linked"]) for r in found}
    assert lines.pop([r["line"] for r in found if r["conv_id"] == 2][0]) == (2, "call", 0, False)
    assert any("when?" in r["line"] for r in found)
    assert lines == {
        '{"content":"so","role":"assistant","turn":0}': (1, "message", -1, None),
        '{"arguments":{"a":1},"id":"n","name":"f","turn":0}': (1, "call", 0, False),
        '{"arguments":{"a":2},"id":null,"name":"f","turn":0}': (1, "call", 2, False),
        '{"content":null,"role":"assistant","turn":1}': (1, "message", -1, None),
        '{"content":"both","role":"assistant","turn":2}': (1, "message", -1, None),
        '{"arguments":{"a":3},"id":"m","name":"f","turn":3}': (1, "call", 0, False),
    }
    assert len(found) == 7


def test_text_that_looks_like_json_is_kept(spark):
    """Neither calls nor a result: the text is written whole; calls without a conversation are in no cycle."""
    answer, system = '{"content":"x","foo":1}', '{"content":"keep","other":"lost"}'
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", answer), (1, 2, "system", system), (1, 3, "system", "{not json")]
    rows += [(None, 0, "user", "who?"), (None, 2, "user", "me")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    schemas = spark.sql(
        "SELECT 'reply' AS tool, array(named_struct('name', 'prompt', 'type', 'string', 'required', true), "
        "named_struct('name', 'turn', 'type', 'integer', 'required', true)) AS fields"
    )
    found = chats.format_chats(chats.messages_of(turns), schemas, whole=True).collect()
    contents = {json.loads(r["line"]).get("content") for r in found}
    assert {answer, system, "{not json"} <= contents
    lost = [r for r in found if r["conv_id"] is None]
    assert [(r["level"], r["linked"], r["faults"]) for r in lost] == [(0, False, [])] * 2 and len(found) == 6


def test_levels_of_chains_and_diamonds(spark):
    """A long chain, calls of several needs on top of it, and a cycle with what hangs on it."""
    needs = {f"c{i}": [f"c{i - 1}"] if i else [] for i in range(70)}
    needs |= {"d": ["c69", "c3"], "e": ["d", "c0", "f"], "f": ["d"], "g": ["e"], "h": [None, "nowhere"]}
    needs |= {"x": ["y"], "y": ["z"], "z": ["x"], "u": ["z"], "v": ["u", "c1"], "w": ["v"]}
    df = spark.createDataFrame([(1, k, v) for k, v in needs.items()] + [(2, "c1", ["c0"])], "conv_id int, id string, needs array<string>")
    got = {(r["conv_id"], r["id"]): r["level"] for r in chats.levels(df).collect()}
    want = {(1, f"c{i}"): i for i in range(70)}
    want |= {(1, "d"): 70, (1, "f"): 71, (1, "e"): 72, (1, "g"): 73, (1, "h"): 0, (2, "c1"): 0}
    assert got == want


def test_chats_of_nothing(spark):
    turns = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    schemas = spark.sql("SELECT 'f' AS tool, array(named_struct('name', 'a', 'type', 'null', 'required', true)) AS fields")
    assert chats.format_chats(chats.messages_of(turns), schemas).count() == 0


@pytest.fixture(scope="module")
def vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(30, 16))
    points = centres[rng.integers(30, size=1500)] + 0.3 * rng.normal(size=(1500, 16))
    points /= np.linalg.norm(points, axis=1, keepdims=True)
    points[100:700] = points[100]
    rows = [(i, p.tolist(), i) for i, p in enumerate(points.astype(np.float32).astype(float))]
    odd = [(2000, None, 1), (2020, [0.0] * 16, 1), (2040, [None] + [1.0] * 15, 1), (2060, [float("nan")] * 16, 1)]
    odd += [(2080, [float("inf")] * 16, 1), (2100, [1.0, 2.0], 1), (None, [1.0] * 16, 1), (0, rows[0][1], 1)]
    return spark.createDataFrame(rows + odd, "vec_id long, embedding array<float>, score int"), np.array([r[1] for r in rows])


def test_neighbours(vectors, monkeypatch):
    df, points = vectors
    monkeypatch.setattr(neighbours, "LEAST_VISITED", 1)
    monkeypatch.setattr(neighbours, "PART_ENTRIES", 200)
    monkeypatch.setattr(neighbours, "PART_QUERIES", 30)
    found = defaultdict(list)
    for r in neighbours.nearest(df).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    assert sorted(found) == list(range(0, 1500, 20))
    scores = np.einsum("ij,kj->ik", points[::20], points)
    hits = 0
    for q, row in zip(found, scores, strict=True):
        row[q] = -np.inf
        best = np.lexsort((np.arange(1500), -row))[:20]
        hits += len(set(best.tolist()) & {v for _, v, _ in found[q]})
        assert [r for r, _, _ in found[q]] == list(range(1, 21))
        assert all(s == pytest.approx(row[v], abs=1e-12) for _, v, s in found[q])
        assert [(-s, v) for _, v, s in found[q]] == sorted((-s, v) for _, v, s in found[q])
    assert hits >= 0.9 * 20 * len(found)
    assert [v for _, v, _ in found[300]] == [v for v in range(100, 121) if v != 300][:20]


def test_lengths_and_tops(spark):
    """Vectors of every length are searched among their own; any number of neighbours is found."""
    rng = np.random.default_rng(9)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(0, 600, 10)] + [(1000 + 20 * i, rng.normal(size=6).tolist()) for i in range(5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = defaultdict(list)
    for r in neighbours.nearest(df, top=40).orderBy("query_id", "rank").collect():
        found[r["query_id"]].append(r["vec_id"])
    assert len(found) == 30 + 5
    for q, got in found.items():
        mine = dict(rows)[q]
        scores = {i: float(np.dot(mine, v)) for i, v in rows if i != q and len(v) == len(mine)}
        assert got == sorted(scores, key=lambda i: (-scores[i], i))[:40]


def test_few_vectors(spark, vectors):
    df, _ = vectors
    assert neighbours.nearest(df.limit(0)).count() == 0
    assert neighbours.nearest(df.filter("vec_id = 2020")).count() == 0
    few = neighbours.nearest(df.filter("vec_id IN (20, 41, 62)")).collect()
    assert sorted(r["vec_id"] for r in few) == [41, 62] and {r["query_id"] for r in few} == {20}


def test_pairs_are_visited_in_order():
    rng = np.random.default_rng(5)
    books = neighbours.Codebooks(rng.normal(size=(300, 7)), 9)
    counts = rng.integers(0, 3, books.cells)
    query = rng.normal(size=7)
    a, b = books.halves[0] @ query[:4], books.halves[1] @ query[4:]
    sums = (a[:, None] + b).ravel()
    cells = books.visit(query, counts, counts.sum())
    assert len(cells) == (counts > 0).sum()
    assert np.all(np.diff(sums[cells]) <= 1e-12)


def test_pipeline_keeps_columns_and_decides(spark, tmp_path, corpus_rows):
    from .conftest import SCHEMA

    columns = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.createDataFrame(corpus_rows, SCHEMA).select(*columns)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, int(i % 6 == 0)) for i in range(60)]
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    item = corpus_rows[9][1].split("\n")[0]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    seen = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, str(tmp_path))
        assert seen.columns == columns
    mixed = corpus_pipeline.run(spark, str(tmp_path))
    sizes = {r["doc_id"]: r["size"] for r in mixed.collect()}
    assert 9 not in sizes and len(sizes) > 40
    # of copies the last keeps its lines, and of the texts this empties one stays
    assert [i for i in (3, 60, 61, 62) if sizes.get(i)] == [62]
    assert sum(n == 0 for i, n in sizes.items() if i is not None) == 1
