import hashlib
import random
import re
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from starkeep.llm import linededup, neardup, substrings
from starkeep.llm.bloom import Pair, contains
from starkeep.llm.fmindex import FMIndex, WaveletMatrix
from starkeep.llm.graph import connected_components
from starkeep.llm.linededup import drop_repeated_lines
from starkeep.llm.simhash import fingerprint, keep_one, links, near_duplicates
from starkeep.llm.substrings import drop_repeated_passages

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def ascii_lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def words(text):
    return re.findall(f"[^{BLANK}]+", text or "")


def print_of(text):
    w = words(ascii_lower(text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_near_duplicates(corpus, corpus_rows):
    prints = [print_of(r[1]) for r in corpus_rows]
    group = {p: {p} for p in prints}
    for a, b in combinations(sorted(group), 2):
        if (a ^ b).bit_count() <= 2 and group[a] is not group[b]:
            group[a] |= group[b]
            for p in group[a]:
                group[p] = group[a]
    least = defaultdict(list)
    for r, p in zip(corpus_rows, prints, strict=True):
        if r[0] is not None:
            least[p].append(r[0])
    want = Counter(
        (r[0], f"{p:016x}", min((i for q in group[p] for i in least[q]), default=None))
        for r, p in zip(corpus_rows, prints, strict=True)
    )
    got = Counter(tuple(r) for r in near_duplicates(corpus).collect())
    assert got == want
    assert max(Counter(c for _, _, c in got.elements()).values()) > 3


def test_keep_one(corpus):
    kept = [r["doc_id"] for r in keep_one(corpus).collect()]
    assert 3 in kept and not {60, 61, 62} & set(kept)
    assert keep_one(corpus).columns == corpus.columns


def test_pairs_in_a_large_family(spark):
    """Texts with much text in common, below the threshold; every planted pair is found, and the pairs keep apart."""
    rng = random.Random(5)
    draw = lambda n: [f"w{rng.randrange(10**7)}" for _ in range(n)]
    frame, rows = draw(120), []
    for i in range(1500):
        w = frame + draw(40)
        at = rng.randrange(30, 70)
        rows += [(2 * i, " ".join(w)), (2 * i + 1, " ".join(w[:at] + draw(1) + w[at + 1 : at + 8] + draw(1) + w[at + 9 :]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_copies(docs).collect()}
    assert got == {i: i - i % 2 for i, _ in rows}


def test_near_copies_by_fingerprint(spark):
    """The block join of five-word fingerprints alone: every two texts at most four bits apart and similar to 0.8 are held together."""
    rng, texts = random.Random(11), []
    for i in range(250):
        w = [f"w{rng.randrange(10**6)}" for _ in range(150 + i)]
        texts.append(" ".join(w))
        for k in range(4):
            w = [*w, f"x{i}y{k}"] if k % 2 else [*w[:40], f"x{i}y{k}", *w[41:]]
            texts.append(" ".join(w))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [frozenset(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    bits = [fingerprint(t, 5) for t in texts]
    family = lambda i: range(i + 1, i - i % 5 + 5)
    near = [(i, j) for i in range(len(texts)) for j in family(i) if (bits[i] ^ bits[j]).bit_count() <= 4]
    assert len(near) > 500 and any((bits[i] ^ bits[j]).bit_count() == 4 for i, j in near)
    assert all(5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) for i, j in near)
    sketches = neardup._sketches(docs)
    prints = {r["doc_id"]: r["print"] for r in sketches.collect()}
    parts = {r["node"]: r["component"] for r in neardup.links(docs, neardup._blocked(sketches)).collect()}
    component = {p: p for p in prints.values()}
    for i, j in near * 5:
        least = min(component[prints[i]], component[prints[j]])
        component[prints[i]] = component[prints[j]] = least
    assert {p: parts.get(p, p) for p in component} == component


def test_crossing_pairs_join_all(spark):
    """Against brute force, where shingles are few and frequent: chains of texts over a common stock."""
    rng = random.Random(6)
    blocks = [[f"b{k}w{j}" for j in range(30)] for k in range(14)]
    texts = []
    for _ in range(160):
        chosen = [b for b in blocks if rng.random() < 0.75]
        texts.append(" ".join(sum(chosen, []) + [f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(3, 60))]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    sets = [frozenset(zip(*(t.split()[k:] for k in range(5)))) for t in texts]
    prints = {r["doc_id"]: r["print"] for r in neardup._sketches(docs).collect()}
    alone = docs.sparkSession.createDataFrame([(p, p) for p in prints.values()], "print long, component long")
    pairs = neardup._crossing(docs, alone)
    found = {tuple(sorted(r)) for r in neardup._verified(docs, pairs).collect()}
    want = {
        tuple(sorted((prints[i], prints[j]))) for i, j in combinations(range(len(texts)), 2) if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])
    }
    assert found <= want and len(want) > 30

    def groups(edges):
        root = {p: p for p in prints.values()}

        def of(p):
            while root[p] != p:
                p = root[p]
            return p

        for a, b in edges:
            root[of(a)] = of(b)
        return {frozenset(p for p in root if of(p) == r) for r in map(of, root)}

    assert groups(found) == groups(want)


def test_crossing_pairs_of_large_families(spark):
    """Texts alike but no near copies leave hardly any pairs: their number does not grow with the square of a family."""
    rng = random.Random(12)
    frame = [f"f{k}" for k in range(150)]
    rows = []
    for i in range(600):
        w = list(frame)
        for k in rng.sample(range(2, 148), 4):
            w[k] = f"x{rng.randrange(10**7)}"
        rows.append((i, " ".join(w)))
    rows += [(600 + i, " ".join([*t.split(), "end"])) for i, t in rows[:50]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [frozenset(zip(*(t.split()[k:] for k in range(5)))) for _, t in rows]
    prints = {r["doc_id"]: r["print"] for r in neardup._sketches(docs).collect()}
    alone = spark.createDataFrame([(p, p) for p in prints.values()], "print long, component long")
    pairs = {tuple(sorted(r)) for r in neardup._crossing(docs, alone).collect()}
    similar = sum(5 * len(a & b) >= 4 * len(a | b) for a, b in combinations(sets, 2))
    assert {tuple(sorted((prints[i], prints[600 + i]))) for i in range(50)} <= pairs
    assert len(pairs) <= 2 * similar + len(rows) < len(rows) ** 2 // 20


def test_near_copies(spark, corpus, corpus_rows):
    """Texts edited down to a similarity of 0.8, pairs inside a large family of texts half alike, and a large group of copies."""
    rng, texts = random.Random(8), []
    draw = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]

    def changed(w, edits):
        w = list(w)
        for k in rng.sample(range(len(w)), edits):
            w[k] = draw(1)[0]
        return w

    for i in range(60):
        w = draw(200)
        texts += [w, changed(w, 1 + i % 5)]
    frame, tight = draw(150), draw(300)
    for _ in range(150):
        w = frame + draw(50)
        texts += [w, w[:160] + draw(1) + w[161:]]
    texts += [changed(tight, rng.randrange(1, 7)) for _ in range(150)]
    rows = [(1000 + i, " ".join(w)) for i, w in enumerate(texts)] + [(r[0], r[1]) for r in corpus_rows]
    sets = {}
    for doc_id, text in rows:
        w = words(ascii_lower(text or ""))
        found = frozenset(" ".join(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()
        sets.setdefault(found, set()).add(doc_id)
    group = {s: s for s in sets}

    def root(s):
        while group[s] != s:
            s = group[s]
        return s

    for a, b in combinations(sets, 2):
        if a and b and 5 * len(a & b) >= 4 * len(a | b):
            group[root(a)] = root(b)
    least = defaultdict(list)
    for s, ids in sets.items():
        least[root(s)] += [i for i in ids if i is not None]
    want = {i: min(least[root(s)]) for s, ids in sets.items() for i in ids if i is not None}
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_copies(docs).collect()}
    assert {i: got[i] for i in want} == want
    assert sum(i != c for i, c in want.items()) > 300
    kept = [r["doc_id"] for r in neardup.keep_one(docs).collect()]
    assert {i for i in kept if i is not None} == set(want.values())


def test_links_in_dense_groups(spark):
    """Fingerprints that fill a block: every two at most two bits apart end in one component."""
    values = sorted({(1 << a) ^ (1 << b) ^ (7 << 50) for a in range(13) for b in range(13)})
    values += [v ^ 0xFFFF << 16 for v in values[:5]]
    df = spark.createDataFrame([(v,) for v in values], "print long")
    parts = {r["node"]: r["component"] for r in connected_components(links(df)).collect()}
    want = {v: {v} for v in values}
    for a, b in combinations(values, 2):
        if (a ^ b).bit_count() <= 2 and want[a] is not want[b]:
            want[a] |= want[b]
            for v in want[a]:
                want[v] = want[a]
    assert {v: parts.get(v, v) for v in values} == {v: min(want[v]) for v in values}


def test_components_of_paths_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (None, 3)]
    found = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in found} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 102: 100}
    assert len(found) == 44


def lines_by_hand(rows):
    docs = defaultdict(set)
    for r in rows:
        for line in (r[1] or "").split("\n"):
            key = ascii_lower(line.strip(BLANK))
            if len(key) >= 20:
                docs[key].add(r[0])
    keep = {k: max(i for i in v if i is not None) for k, v in docs.items() if len(v - {None}) >= 3}
    out = Counter()
    for r in rows:
        lines = (r[1] or "").split("\n")
        kept = [x for x in lines if keep.get(ascii_lower(x.strip(BLANK)), r[0]) == r[0]]
        out[r[0], len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    return out


@pytest.mark.parametrize("most_bits", [1 << 28, 1 << 11])
def test_line_dedup(corpus, corpus_rows, most_bits):
    """Also with filters so small that there are several slices and nearly every line is suspected."""
    kept = drop_repeated_lines(corpus, most_bits=most_bits)
    got = Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in kept.collect())
    assert got == lines_by_hand(corpus_rows)
    assert kept.columns == [*corpus.columns, "n_lines", "n_dropped"]


def test_line_keys_count_code_points():
    found = [d is not None for _, d in linededup._digests("é" * 19 + "\n" + "é" * 20 + "\n" + "a" * 20, 20)]
    assert found == [False, True, True]


def test_filters_miss_nothing():
    rng = np.random.default_rng(1)
    seen = rng.integers(-(2**63), 2**63, 3000)
    pair = Pair(1 << 18)
    pair.add(seen)
    pair.add(seen[:700])
    pair.add(np.repeat(seen[-5:], 2))
    assert contains(pair.twice, seen[:700]).all() and contains(pair.twice, seen[-5:]).all()
    assert contains(pair.twice, seen[700:-5]).mean() < 0.05


def passages_by_hand(rows):
    where = {}
    for r in rows:
        w = words(r[1])
        for k in range(len(w) - 19):
            at = (-1 if r[0] is None else r[0], k)
            where[tuple(w[k : k + 20])] = min(at, where.get(tuple(w[k : k + 20]), at))
    out = Counter()
    for r in rows:
        w = words(r[1])
        gone = set()
        for k in range(len(w) - 19):
            if where[tuple(w[k : k + 20])] != (-1 if r[0] is None else r[0], k):
                gone |= set(range(k, k + 20))
        out[r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)] += 1
    return out


@pytest.mark.parametrize("common", [2000, 1])
def test_passages(corpus, corpus_rows, common, monkeypatch):
    monkeypatch.setattr(substrings, "COMMON", common)
    kept = drop_repeated_passages(corpus)
    got = Counter((r["doc_id"], r["n_words"], r["n_removed"], r["text"]) for r in kept.collect())
    assert got == passages_by_hand(corpus_rows)
    assert sum(n for _, _, n, _ in got) > 500


def test_index_finds_all_places():
    rng = np.random.default_rng(2)
    texts = [rng.integers(1, 4, rng.integers(5, 40)).tolist() for _ in range(20)]
    sequence, begins = [], []
    for t in texts:
        begins.append(len(sequence))
        sequence += [*t, 0]
    sequence = np.array(sequence)
    lengths = np.array([len(t) for t in texts])
    index = FMIndex(sequence, 4, 5)
    places = Counter(tuple(t[k : k + 5]) for t in texts for k in range(len(t) - 4))
    seen = 0
    for _, at, low, high in index.matches(sequence, np.array(begins), lengths):
        for p, a, b in zip(at.tolist(), low.tolist(), high.tolist(), strict=True):
            assert b - a == places[tuple(sequence[p : p + 5])]
            assert p in index.places[a:b]
            seen += 1
    assert seen == sum(places.values())


def test_wavelet_ranks():
    rng = np.random.default_rng(3)
    sequence = rng.integers(0, 37, 1000)
    tree = WaveletMatrix(sequence, 37)
    symbol, place = rng.integers(0, 37, 200), rng.integers(0, 1001, 200)
    assert tree.rank(symbol, place).tolist() == [int((sequence[:p] == s).sum()) for s, p in zip(symbol, place, strict=True)]


def test_empty_tables(nothing):
    assert near_duplicates(nothing).count() == 0
    assert drop_repeated_lines(nothing).count() == 0
    assert drop_repeated_passages(nothing).count() == 0


def test_digest_of_empty_text(corpus):
    row = drop_repeated_passages(corpus.filter("text IS NULL AND doc_id IS NOT NULL")).first()
    assert hashlib.sha256(row["text"].encode()).hexdigest() == hashlib.sha256(b"").hexdigest()
