"""Language identification by unigram pieces, summed over all segmentations.

The pieces are those of a public byte-level vocabulary. Each language has a probability for each
piece. A word (a run of letters, with a space before it) may be cut into pieces in many ways; the
forward algorithm sums the probabilities of all of them, byte by byte. A text's likelihood
is the product over its words, so a chunk of texts costs as much as its distinct words. Scripts
without spaces have runs of any length: a long run is read in stretches of ten characters, when fitting and when
scoring, and sums run over the segmentations within each. The
probabilities are fitted by expectation maximisation over the same sums.
"""

import base64
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starkeep.llm.words import BASE, chunks, powers, span_hashes

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Bounds of the labelled sample: documents of each language, and characters of one of them.
PER_LANG = 200
MOST_CHARS = 20_000
#: A run of letters of more bytes, as unspaced scripts have, is read in stretches of so many code points, each a word.
LONG_BYTES, STRETCH = 40, 10
ROUNDS = 4
SMOOTH = 0.01
CHUNK = 4 << 20
BITS = 22

LETTERS = np.zeros(256, bool)
LETTERS[65:91] = LETTERS[97:123] = LETTERS[128:] = True
#: Tells pieces at the start of a word from others.
START = np.uint64(0xA24BAED4963EE407)


def _raw_hash(piece: bytes) -> int:
    return sum((b + 1) * pow(int(BASE), i, 1 << 64) for i, b in enumerate(piece)) % (1 << 64)


class Vocabulary:
    """Pieces of lower-case letters, by hash; all single bytes and the bare space among them."""

    def __init__(self, path: str):
        pieces = {bytes([b]) for b in range(256)}
        with open(path, "rb") as lines:
            for line in lines:
                piece = base64.b64decode(line.split()[0]).lower()
                body = np.frombuffer(piece.removeprefix(b" "), np.uint8)
                if 0 < len(body) and LETTERS[body].all():
                    pieces.add(piece)
        found = {}
        for piece in pieces:
            if piece != b" ":
                start = piece.startswith(b" ")
                found[(_raw_hash(piece[start:]) + int(START) * start) % (1 << 64)] = piece
        self.hashes = np.array(sorted(found), np.uint64)
        #: Bytes of the longest piece, the space before a word included.
        self.longest = max(map(len, pieces))
        self.space = len(self.hashes)
        self.size = self.space + 1
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[(self.hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray):
        """Indexes of the hashes that are pieces, and which pieces."""
        maybe = np.flatnonzero(self.seen[(hashes >> np.uint64(64 - BITS)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        right = self.hashes[at] == hashes[maybe]
        return maybe[right], at[right]


class Words:
    """Distinct words of a chunk, longest first; nodes of a word are 0 (before the space) to its length + 1."""

    def __init__(self, prefix, starts, ends):
        order = np.argsort(starts - ends, kind="stable")
        self.order, self.prefix = order, prefix
        self.starts, self.lengths = starts[order], (ends - starts)[order]
        self.longest = int(self.lengths[0]) if len(order) else 0

    def reaching(self, node: int) -> int:
        """How many words have the node."""
        return int(np.searchsorted(-self.lengths, -(node - 1), side="right"))

    def pieces(self, vocabulary: Vocabulary, node: int):
        """(length, words, pieces) of all pieces that end at the node."""
        n = self.reaching(node)
        ends = self.starts[:n] + (node - 1)
        inverse = powers(len(self.prefix))[1]
        for length in range(1, min(vocabulary.longest, node) + 1):
            if length == node == 1:
                yield length, np.arange(n), np.full(n, vocabulary.space)
                continue
            begins = self.starts[:n] if length == node else ends - length
            hashes = (self.prefix[ends] - self.prefix[begins]) * inverse[begins]
            yield length, *vocabulary.find(hashes + START if length == node else hashes)


def word_spans(chunk):
    """Starts, ends and rows of the words: runs of letters, long ones in stretches of STRETCH code points."""
    starts, ends, rows = chunk.spans(LETTERS)
    long = ends - starts > LONG_BYTES
    if not long.any():
        return starts, ends, rows
    parts = [(starts[~long], ends[~long], rows[~long])]
    for a, b, row in zip(starts[long].tolist(), ends[long].tolist(), rows[long].tolist(), strict=True):
        points = a + np.flatnonzero((chunk.data[a:b] & 0xC0) != 0x80)
        first = points[::STRETCH]
        parts.append((first, np.append(first[1:], b), np.full(len(first), row)))
    starts, ends, rows = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.argsort(starts)
    return starts[order], ends[order], rows[order]


def _chunk_words(chunk):
    """Distinct words of a chunk, and for each occurrence its word and its row."""
    starts, ends, rows = word_spans(chunk)
    prefix = chunk.prefix()
    _, first, word = np.unique(span_hashes(prefix, starts, ends), return_index=True, return_inverse=True)
    return Words(prefix, starts[first], ends[first]), word, rows


def _lowered(column):
    return pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))


@dataclass
class Model:
    """Languages and a probability for each piece (rows) and language (columns)."""

    vocabulary: Vocabulary
    langs: list[str]
    chances: np.ndarray

    def word_logs(self, words: Words) -> np.ndarray:
        """Log probability of each distinct word in each language, in the words' first order."""
        n, k = len(words.starts), len(self.langs)
        ring = np.zeros((min(self.vocabulary.longest, words.longest + 1) + 1, n, k))
        ring[0] = 1.0
        scale, out = np.zeros((n, k)), np.zeros((n, k))
        for node in range(1, words.longest + 2):
            active = words.reaching(node)
            total = np.zeros((active, k))
            for length, rows, pieces in words.pieces(self.vocabulary, node):
                total[rows] += ring[(node - length) % len(ring), rows] * self.chances[pieces]
            ring[node % len(ring), :active] = total
            done = words.reaching(node + 1)
            out[done:active] = np.log(total[done:]) + scale[done:active]
            if node % 8 == 0:
                top = total[:done]
                ring[:, :done] /= top
                scale[:done] += np.log(top)
        back = np.empty_like(out)
        back[words.order] = out
        return back

    def predict(self, column):
        """The likeliest language of each text and its share of the likelihood; None without letters."""
        logs = np.zeros((len(column), len(self.langs)))
        for chunk in chunks(_lowered(column), CHUNK):
            words, word, rows = _chunk_words(chunk)
            if not len(word):
                continue
            known = self.word_logs(words)
            for k in range(len(self.langs)):
                sums = np.bincount(rows, known[word, k], minlength=chunk.rows)
                logs[chunk.first : chunk.first + chunk.rows, k] = sums
        lettered = pc.fill_null(pc.match_substring_regex(column, r"\pL"), False).to_numpy(zero_copy_only=False)
        best = logs.argmax(axis=1)
        share = 1 / np.exp(logs - logs.max(axis=1, keepdims=True)).sum(axis=1)
        return [self.langs[b] if there else None for b, there in zip(best.tolist(), lettered.tolist(), strict=True)], share


def _fitted(vocabulary: Vocabulary, column) -> np.ndarray:
    """Piece probabilities of one language by expectation maximisation over its sample's words."""
    chance = np.full(vocabulary.size, 1.0 / vocabulary.size)
    batches = []
    for chunk in chunks(_lowered(column), CHUNK):
        starts, ends, _ = word_spans(chunk)
        prefix = chunk.prefix()
        _, first, times = np.unique(span_hashes(prefix, starts, ends), return_index=True, return_counts=True)
        words = Words(prefix, starts[first], ends[first])
        edges = [(node, *edge) for node in range(1, words.longest + 2) for edge in words.pieces(vocabulary, node)]
        batches.append((words, times[words.order], edges))
    for _ in range(ROUNDS):
        counts = np.zeros(vocabulary.size)
        for words, times, edges in batches:
            n = len(times)
            if not n:
                continue
            ahead, back = np.zeros((words.longest + 2, n)), np.zeros((words.longest + 2, n))
            ahead[0] = 1.0
            for node, length, rows, pieces in edges:
                ahead[node, rows] += ahead[node - length, rows] * chance[pieces]
            last = words.lengths + 1
            back[last, np.arange(n)] = 1.0
            total = ahead[last, np.arange(n)]
            for node, length, rows, pieces in reversed(edges):
                flow = chance[pieces] * back[node, rows]
                back[node - length, rows] += flow
                share = times[rows] * ahead[node - length, rows] * flow / total[rows]
                counts += np.bincount(pieces, share, minlength=vocabulary.size)
        chance = (counts + SMOOTH) / (counts.sum() + SMOOTH * vocabulary.size)
    return chance


def fit(docs: DataFrame, path: str = VOCABULARY, per_lang: int = PER_LANG, most_chars: int = MOST_CHARS) -> Model | None:
    """A model from the rows of ``docs`` that have an id, a text and a ``lang``; None without any.

    The sample has ``per_lang`` documents of each language, those whose ids hash lowest among texts of
    1 to ``most_chars`` characters, so the driver receives that many texts for each language there is.
    """
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    usable = docs.filter("doc_id IS NOT NULL AND lang IS NOT NULL").filter(F.length("text").between(1, most_chars))
    chosen = usable.select("doc_id", "lang").withColumn("n", F.row_number().over(order)).filter(F.col("n") <= per_lang)
    texts = usable.join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"])
    rows = texts.select("doc_id", "lang", "text").toArrow().sort_by([("doc_id", "ascending"), ("text", "ascending")])
    langs = sorted(set(rows.column("lang").to_pylist()))
    if not langs:
        return None
    vocabulary = Vocabulary(path)
    parts = [rows.filter(pc.equal(rows.column("lang"), lang)).column("text").combine_chunks() for lang in langs]
    return Model(vocabulary, langs, np.column_stack([_fitted(vocabulary, part) for part in parts]))


def identify(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (0 to 1).

    ``lang_pred`` is one of the model's languages, ties going to the first by name; it is ``und``, with score 0, for
    null texts, texts without a letter, and without a model. Columns of these names are replaced; no other column plays a part.
    """
    docs = docs.drop("lang_pred", "score")
    names, at = docs.columns, docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def per_batch(batches):
        model = shared.value
        for batch in batches:
            langs, share = [None] * batch.num_rows, np.zeros(batch.num_rows)
            if model is not None:
                langs, share = model.predict(batch.column(at))
            score = [float(s) if lang else 0.0 for s, lang in zip(share, langs, strict=True)]
            columns = [*batch.columns, pa.array([x or "und" for x in langs], pa.string()), pa.array(score, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*names, "lang_pred", "score"])

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema]
    return docs.mapInArrow(per_batch, ", ".join([*fields, "lang_pred string, score double"]))
