import random
import time
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from starkeep.llm import decontamination, langid, toxicity
from starkeep.llm.decontamination import allowed, drop_contaminated, edit_distance, embed_keys, find_items, split_words
from starkeep.llm.licenses import BUCKET, TEMPLATES, document_frequencies, rarest, scan

from .conftest import WORDS, sentence


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(3)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(12))] for _ in range(2))
        assert edit_distance(a, b) == plain_distance(a, b)


def edited(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(len(words))
        words[k : k + rng.randrange(2)] = [rng.choice(WORDS) + "q"] * rng.randrange(2)
    return words


def test_recall_of_keys():
    """Windows at the largest allowed distance share a key with their item nearly always."""
    rng, hits, tries = random.Random(4), 0, 0
    for n in (8, 15, 25, 40, 60):
        for _ in range(60):
            item = [rng.getrandbits(60) for _ in range(n)]
            window = item[:]
            for _ in range(allowed(n)):
                window[rng.randrange(n)] = rng.getrandbits(60)
            a, b = (embed_keys(np.array(x, np.uint64), np.zeros(1, np.int64), n, n)[0] for x in (item, window))
            hits, tries = hits + bool((a == b).any()), tries + 1
    assert hits / tries > 0.98


@pytest.mark.parametrize("n", [50, 100, 200, 300, 500])
@pytest.mark.parametrize("kind", ["replaced", "deleted"])
def test_recall_of_keys_by_length(n, kind):
    """Also of long items: with n/5 words replaced, or n/10 deleted and as many after the end."""
    rng, hits = random.Random(n), 0
    for _ in range(60):
        item = [rng.getrandbits(60) for _ in range(n)]
        gone = set(rng.sample(range(n), allowed(n) // (1 if kind == "replaced" else 2)))
        fresh = [rng.getrandbits(60) for _ in range(n)]
        if kind == "replaced":
            window = [fresh[i] if i in gone else x for i, x in enumerate(item)]
        else:
            window = [x for i, x in enumerate(item) if i not in gone] + fresh[: len(gone)]
        a, b = (embed_keys(np.array(x, np.uint64), np.zeros(1, np.int64), n, n)[0] for x in (item, window))
        hits += bool((a == b).any())
    assert hits / 60 >= 0.95


@pytest.fixture(scope="module")
def items(spark):
    rng = random.Random(8)
    texts = [sentence(rng, n) for n in (6, 9, 14, 25, 40, 70)] + ["too short", None, "", sentence(rng, 5)]
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "item_id long, text string, keys string")


def test_contamination(spark, corpus, corpus_rows, items):
    rng, rows = random.Random(9), []
    for i, item in enumerate(items.filter("length(text) > 10").collect()):
        words = item["text"].split()
        for edits in (0, 1, allowed(len(words)), allowed(len(words)) + 3):
            inside = " ".join(edited(rng, words, edits)).upper() + "!"
            rows.append((1000 + 10 * i + edits, sentence(rng, 30) + ".\n" + inside + " " + sentence(rng, 20)))
        rows.append((2000 + i, " ".join(words[: len(words) - allowed(len(words))])))
    docs = corpus.select("doc_id", "text").union(spark.createDataFrame(rows, "doc_id long, text string"))
    known = [(r["item_id"], split_words((r["text"] or "").lower().encode())) for r in items.collect()]
    want = {}
    for doc_id, text in [(r[0], r[1]) for r in corpus_rows] + rows:
        w = split_words((text or "").lower().encode())
        for item_id, item in known:
            n = len(item)
            if n < 5 or not w or not set(w) & set(item):
                continue
            width = min(n, len(w))
            best = min((edit_distance(w[k : k + width], item), k) for k in range(len(w) - width + 1))
            if best[0] <= allowed(n):
                want[doc_id, item_id] = best
    got = {(r["doc_id"], r["item_id"]): (r["distance"], r["first_word"]) for r in find_items(docs, items).collect()}
    assert set(got) <= set(want) and len(got) >= 0.95 * len(want) > 15
    assert all(got[k][0] <= allowed(len(dict(known)[k[1]])) for k in got)
    assert all(got[k] == want[k] for k in got if want[k][0] == 0)
    kept = {r["doc_id"] for r in drop_contaminated(docs, items).collect()}
    assert kept == {r["doc_id"] for r in docs.collect()} - {d for d, _ in got}


def test_contamination_of_nothing(corpus, nothing, items):
    assert find_items(nothing, items).count() == 0
    assert find_items(corpus, items.filter("item_id < 0")).count() == 0
    assert drop_contaminated(corpus, items.filter("item_id < 0")).count() == corpus.count()


def license_words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def places_of(words, phrase):
    return [k for k in range(len(words) - len(phrase) + 1) if tuple(words[k : k + len(phrase)]) == phrase]


def own_share(words, t, indexed):
    """Over all windows of beginnings in which the phrase stands: the largest share of indexed places that begin there."""
    begins = [(i - at, at) for at in indexed for i, w in enumerate(words) if w == t.words[at]]
    best = 0.0
    for b in range(-20, len(words) // BUCKET + 2):
        window = range(b * BUCKET, (b + 2) * BUCKET)
        votes = len({at for d, at in begins if d in window})
        if votes >= t.need and any(k - t.at in window for k in places_of(words, t.phrase)):
            best = max(best, votes / t.postings)
    return best


def test_licenses(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    deal = " (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify,"
    rest = " merge, publish, distribute, sublicense, and/or sell copies of the Software"
    texts = [
        "Released under the MIT License.",
        "mit mit license, MIT-license; x\nthe Apache\tLICENSE licenses",
        "GNU Lesser General Public License",
        "Licensed under CC BY-NC 4.0. cc by",
        "mit",
        "license mit",
        "",
        None,
        "Kit license mİt license mité license",
        "word " * 5000 + "general public license",
        "word " * 3001 + mit + " of Example Corp and others" + deal + rest + " word" * 40,
        mit + rest,
        "to deal in the software without restriction " * 3,
        (mit + deal + rest + " ") * 300,
        deal + rest,
        "Released under the BSD license, or: under the terms of the Eclipse Public License",
        "bsd license " + "filler " * 60 + "released under the",
    ]
    documents = [license_words(t) for t in texts]
    frequency = Counter(w for d in documents for w in set(d))
    found = {}
    for i, w in enumerate(documents):
        hits, best = [], 0
        for x in TEMPLATES:
            if not x.base:
                share = own_share(w, x, rarest(x, frequency))
                hits += [(x.label, False, None)] * (share > 0)
                best = max(best, share)
                continue
            for k in places_of(w, x.phrase):
                o = k - x.at
                same = sum(0 <= o + j < len(w) and w[o + j] == y for j, y in enumerate(x.words))
                hits.append((x.label, True, k))
                best = max(best, same / len(x.words))
        base = [k for _, b, k in hits if b]
        found[i] = (
            len(w),
            len(base),
            min(base, default=None),
            max(base, default=None),
            ",".join(sorted({x for x, b, _ in hits if b})),
            ",".join(sorted({x for x, _, _ in hits})),
            best,
        )
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string").withColumn("score", F.lit("clash"))
    names = "n_words n_base first_word last_word base_labels labels score".split()
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in scan(df).collect()}
    assert got == found
    assert found[1][1] == 3 and found[3][5] == "cc-by-nc" and found[8][1] == 0
    # a notice with words put in and without its short name is found, phrases alone and notices without their phrase are not
    assert found[10][5] == found[13][5] == "mit" and found[11][5] == found[12][5] == found[16][5] == ""
    assert found[15][5] == "bsd,epl"
    assert scan(df.limit(0)).count() == 0


def test_license_statistics(spark):
    """Which words are indexed follows all texts; words that no text holds count as rarest."""
    own = next(t for t in TEMPLATES if not t.base)
    df = spark.createDataFrame([(k, " ".join(own.words[: k % len(own.words)])) for k in range(90)], "doc_id int, text string")
    frequency = document_frequencies(df)
    assert frequency == Counter(w for r in df.collect() for w in set(r["text"].split()))
    assert set(rarest(own, frequency)) <= set(own.beside) and len(rarest(own, frequency)) == own.postings
    assert len(own.words) - 1 in rarest(own, frequency) or frequency[own.words[-1]] > 0


def all_segmentations(model, word, k):
    """Sum over all ways to cut a space and a word into pieces, tried one by one."""
    chance = {}
    for h, p in zip(model.vocabulary.hashes.tolist(), model.chances[:, k].tolist(), strict=False):
        chance[h] = p
    start = int(langid.START)

    def of(piece, first):
        if first and not piece:
            return model.chances[model.vocabulary.space, k]
        return chance.get((langid._raw_hash(piece) + start * first) % (1 << 64), 0.0)

    def rest(at):
        if at == len(word):
            return 1.0
        return sum(of(word[at:end], False) * rest(end) for end in range(at + 1, len(word) + 1))

    return sum(of(word[:end], True) * rest(end) for end in range(len(word) + 1))


@pytest.fixture(scope="module")
def spoken(spark):
    rng, parts = random.Random(6), {"aa": ["tion", "the", "ing", "er"], "bb": ["eux", "que", "ré", "ou"]}
    rows = []
    for i in range(120):
        lang = "aa" if i % 2 else "bb"
        text = " ".join("".join(rng.choices(parts[lang], k=rng.randrange(1, 4))) for _ in range(40))
        rows.append((i, text, lang if i % 5 else None))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


def test_language(spark, spoken):
    model = langid.fit(spoken)
    assert model.langs == ["aa", "bb"]
    for word in ("the", "tionque", "réing", "z"):
        chunk = next(langid.chunks(langid._lowered(pa.array([word]))))
        got = model.word_logs(langid._chunk_words(chunk)[0])[0]
        want = [np.log(all_segmentations(model, word.encode(), k)) for k in range(2)]
        assert np.allclose(got, want)
    odd = spark.createDataFrame(
        [(1, None), (2, ""), (3, "12 — !"), (4, "THETION " * 9000), (5, "réque" * 400), (6, "q"), (6, "q"), (None, "ouré")],
        "doc_id long, text string",
    ).withColumn("score", F.lit("clash"))
    got = Counter((r["doc_id"], r["lang_pred"]) for r in langid.identify(odd, model).filter("doc_id < 6 OR doc_id IS NULL").collect())
    assert got == Counter([(1, "und"), (2, "und"), (3, "und"), (4, "aa"), (5, "bb"), (None, "bb")])
    assert langid.identify(odd.limit(0), model).count() == 0
    rows = langid.identify(spoken.drop("lang"), model).collect()
    assert all(r["lang_pred"] == ("aa" if r["doc_id"] % 2 else "bb") and 0.5 < r["score"] <= 1 for r in rows)


def test_items_of_unspaced_scripts(spark):
    """A character is a word: a sentence is found verbatim and with a changed character, inside a run without spaces."""
    rng = random.Random(13)
    signs = [chr(c) for c in range(0x4E00, 0x4F00)]
    sentence = "".join(rng.choices(signs, k=30))
    around = lambda: "".join(rng.choices(signs, k=400))
    changed = sentence[:15] + "好" + sentence[16:]
    texts = [around() + sentence + around(), around() + changed + "。" + around(), around(), "abc " + sentence]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    items = spark.createDataFrame([(7, sentence), (8, "ab")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): (r["first_word"], r["distance"]) for r in find_items(docs, items).collect()}
    assert got == {(0, 7): (400, 0), (1, 7): (400, 1), (3, 7): (1, 0)}
    assert split_words("ab好吗cd é1 กข".encode()) == [w.encode() for w in ("ab", "好", "吗", "cd", "é1", "ก", "ข")]


def test_language_of_unspaced_scripts(spark):
    """Runs without a space are learned from and read whole, however long."""
    rng = random.Random(8)
    kinds = {"ja": "のにはをたがでてとしれさあいうかき", "th": "กขคงจชซดตถทนบปผพฟมยรลวสหอ", "zh": "的一是不了人我在有他这中大来上国个到说们"}
    texts = {lang: ["".join(rng.choices(signs, k=3000)) for _ in range(4)] for lang, signs in kinds.items()}
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, of in texts.items() for t in of[:2])]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    for k in range(3):
        assert model.chances[:, k].max() > 100 * model.chances[:, k].min()
    other = [t for of in texts.values() for t in of[2:]]
    assert model.predict(pa.array(other))[0] == [lang for lang in texts for _ in range(2)]
    begun = time.perf_counter()
    assert model.predict(pa.array([texts["zh"][3] * 7, "x" * 200_000, texts["th"][2] * 7]))[0][::2] == ["zh", "th"]
    assert time.perf_counter() - begun < 20
    chunk = next(langid.chunks(pa.array(["ab " + "é" * 25 + " c"])))
    starts, ends, _ = langid.word_spans(chunk)
    assert [bytes(chunk.data[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == ["ab", "é" * 10, "é" * 10, "é" * 5, "c"]


def test_language_without_labels(nothing, spoken):
    assert langid.fit(nothing) is None
    assert {r["lang_pred"] for r in langid.identify(spoken, None).collect()} == {"und"}


@pytest.fixture(scope="module")
def rude(spark):
    rng, rows, labels = random.Random(7), [], []
    for i in range(300):
        words = sentence(rng, rng.randrange(20, 80)).split()
        toxic = i % 4 == 0
        if toxic:
            for _ in range(2):
                words.insert(rng.randrange(len(words)), rng.choice(["Rotter", "blightest", "blighted"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark, rude):
    docs, labels = rude
    model = toxicity.fit(docs, labels.filter("doc_id < 200"))
    rows = toxicity.score(docs, model).filter("doc_id >= 200").collect()
    assert sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in rows) >= 0.97 * len(rows)
    odd = [(1, None), (2, ""), (3, "é Rotter bá"), (4, "ba " * 30000 + "blighted"), (4, "ba"), (None, "rotter rotter")]
    odd = spark.createDataFrame(odd, "doc_id long, text string").withColumn("score", F.lit("clash"))
    got = toxicity.score(odd, model).collect()
    by = {r["doc_id"]: r for r in got}
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert by[1]["score"] == by[2]["score"] < 0.3 and by[1]["spans"] == []
    assert [tuple(s) for s in by[3]["spans"]] == [(2, 8)] and by[None]["predicted"] == 1
    assert toxicity.score(odd.limit(0), model).count() == 0


def test_jumps_equal_single_steps():
    """Marginals of a chain with jumps over neutral words are those of all its words."""
    model = toxicity.Model(np.array([1], np.uint64), np.array([5.0]), -3.0, np.array([[0.2, -1.0], [0.1, 0.7]]), np.zeros(4))
    scores = {3: 4.0, 5: -1.0, 90: 6.0}
    step, n = np.exp(model.chain), 120
    emit = np.array([[1, np.exp(model.bias + scores.get(t, 0.0))] for t in range(n)])
    ahead, back = np.zeros((n, 2)), np.ones((n, 2))
    state = np.array([1.0, 0.0])
    for t in range(n):
        state = (state @ step) * emit[t]
        state /= state.sum()
        ahead[t] = state
    for t in range(n - 2, -1, -1):
        back[t] = step @ (emit[t + 1] * back[t + 1])
        back[t] /= back[t].max()
    both = ahead * back
    want = (both[:, 1] / both.sum(axis=1))[list(scores)]
    assert np.allclose(model.marginals(np.array(list(scores)), list(scores.values()), n), want)


def test_every_marked_word_is_learned_from():
    """Words of one line that lie far apart are all in its sequences; gaps of any length are jumped."""
    line = " ".join("bad" if i in (3, 70, 71, 400) else f"w{i}" for i in range(500))
    column = pa.array([line, "bad\nfine bad"])
    chunk = next(toxicity.chunks(toxicity._lowered(column)))
    starts, ends, _, kinds = toxicity._features(chunk)
    hashes = np.unique(kinds[0][[bytes(chunk.data[a:b]) == b"bad" for a, b in zip(starts, ends, strict=True)]])
    sequences = list(toxicity._sequences(column, hashes, np.array([True]), True))
    assert sum(int(y.sum()) for _, y in sequences) == 6 and max(len(y) for _, y in sequences) <= toxicity.LINE
    model = toxicity.Model(hashes, np.array([1.0]), -2.0, np.array([[0.1, -1.0], [-0.5, 0.4]]), np.zeros(4))
    step = np.exp(model.chain) * np.array([1.0, np.exp(model.bias)])
    for n in (0, 1, 64, 65, 1000):
        want = np.linalg.matrix_power(step / np.abs(np.linalg.eigvals(step)).max(), n)
        got = model.jump(n)
        assert np.allclose(got / got.max(), want / want.max())



def test_toxicity_without_labels(rude, nothing):
    docs, labels = rude
    assert toxicity.fit(docs, labels.filter("toxic = 1")) is None
    assert toxicity.fit(nothing, labels) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}


def test_least_marks_are_lossless():
    """Any window within the allowed distance keeps as many runs of three words as are asked for."""
    assert all(n - 2 - 3 * allowed(n) >= 1 for n in range(decontamination.MIN_WORDS, 400))
