"""Toxic spans by a linear-chain conditional random field.

Labels are given for whole documents, so tokens are labelled from them first: a token of a toxic document is toxic if one of
its features (the word, or a prefix of it) is far more frequent in toxic documents than in clean
ones. Occurrences between the same neighbours count once, so copies of a document add nothing.
On lines labelled so, a chain of two states is fitted: a weight for each feature, a bias, and
transitions. A document is one chain. Words without a weighted feature all weigh the same, so the
chain jumps over them by powers of one matrix, and only the few other words cost time. Marginals of the toxic state give
the offending spans; their sum and maximum, calibrated on the labelled sample, give the document's score.
"""

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starkeep.llm.words import ALNUM, chunks, mixed, span_hashes

#: Bounds of the labelled sample: documents of each class, and characters of one of them.
PER_CLASS = 2000
MOST_CHARS = 20_000
PREFIX_BYTES = (4, 5, 6, 7, 8, 9)
LEAST_CONTEXTS = 4
KEEP_RATIO, LABEL_RATIO = 4.0, 10.0
CUT = 0.3
SPAN_CUT = 0.5
LINE = 64
BLOCK = 1024
#: Powers of the neutral step that are kept ready.
GAPS = 64
BITS = 20


def _features(chunk):
    """Words of a chunk: starts, ends, rows, and one row of hashes for each kind of feature (0: none)."""
    starts, ends, rows = chunk.spans(ALNUM)
    prefix = chunk.prefix()
    kinds = [span_hashes(prefix, starts, ends)]
    for k in PREFIX_BYTES:
        cut = np.minimum(ends, starts + k)
        h = mixed(span_hashes(prefix, starts, cut) + np.uint64(k))
        kinds.append(np.where(ends - starts >= k, h, np.uint64(0)))
    return starts, ends, rows, np.array(kinds)


def _lowered(column):
    return pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))


@dataclass
class Model:
    """Sorted feature hashes with weights, the chain's parameters, and the calibration."""

    hashes: np.ndarray
    weights: np.ndarray
    bias: float
    chain: np.ndarray
    calibration: np.ndarray

    def __post_init__(self):
        self.seen = np.zeros(1 << BITS, bool)
        self.seen[(self.hashes >> np.uint64(64 - BITS)).astype(np.int64)] = True
        step = np.exp(self.chain) * np.array([1.0, np.exp(self.bias)])
        self.jumps = [np.eye(2)]
        for _ in range(GAPS):
            jump = self.jumps[-1] @ step
            self.jumps.append(jump / jump.max())
        self.squares = [step]
        for _ in range(40):
            square = self.squares[-1] @ self.squares[-1]
            self.squares.append(square / square.max())

    def emissions(self, kinds):
        """Indexes of the words that have weighted features, and the sums of their weights."""
        at = (kinds >> np.uint64(64 - BITS)).astype(np.int64)
        words = np.flatnonzero(self.seen[at].any(axis=0))
        total, any_ = np.zeros(len(words)), np.zeros(len(words), bool)
        if len(self.hashes):
            for h in kinds[:, words]:
                k = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
                found = self.hashes[k] == h
                total += np.where(found, self.weights[k], 0.0)
                any_ |= found
        return words[any_], total[any_]

    def jump(self, n: int):
        """The n-th power of the neutral step, up to a factor; longer ones from squares."""
        if n <= GAPS:
            return self.jumps[n]
        out = np.eye(2)
        for k in range(n.bit_length()):
            if n >> k & 1:
                out = out @ self.squares[k]
                out = out / out.max()
        return out

    def marginals(self, places, scores, length):
        """Probabilities of the toxic state at ``places`` of a chain of ``length`` words."""
        step = np.exp(self.chain)
        hits = [np.array([1.0, np.exp(min(self.bias + s, 50.0))]) for s in scores]
        gaps = np.diff(places, prepend=-1, append=length) - 1
        jump = [self.jump(g) for g in gaps.tolist()]
        # forward: the chain starts as if a neutral word stood before it
        ahead, state = [], np.array([1.0, 0.0])
        for k, hit in enumerate(hits):
            state = (state @ jump[k] @ step) * hit
            state = state / state.sum()
            ahead.append(state)
        out, back = np.zeros(len(hits)), jump[-1].sum(axis=1)
        for k in range(len(hits) - 1, -1, -1):
            both = ahead[k] * back
            out[k] = both[1] / both.sum()
            back = jump[k] @ (step @ (hits[k] * back))
            back = back / back.max()
        return out

    def read(self, column):
        """Words, sum and maximum of the marginals, and spans (in code points) of each text of a column."""
        words_of = np.zeros(len(column), np.int64)
        sums, peaks = np.zeros(len(column)), np.zeros(len(column))
        spans = [[] for _ in range(len(column))]
        for chunk in chunks(_lowered(column)):
            starts, ends, rows, kinds = _features(chunk)
            counts = np.bincount(rows, minlength=chunk.rows)
            words_of[chunk.first : chunk.first + chunk.rows] = counts
            words, scores = self.emissions(kinds)
            if not len(words):
                continue
            before = np.concatenate(([0], np.cumsum(counts)))
            points = np.concatenate(([0], np.cumsum((chunk.data & 0xC0) != 0x80)))
            cuts = np.flatnonzero(np.r_[True, np.diff(rows[words]) > 0, True])
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                row = int(rows[words[a]])
                m = self.marginals(words[a:b] - before[row], scores[a:b], int(counts[row]))
                sums[chunk.first + row], peaks[chunk.first + row] = m.sum(), m.max()
                origin = points[chunk.offsets[row]]
                for w in words[a:b][m >= SPAN_CUT].tolist():
                    spans[chunk.first + row].append((int(points[starts[w]] - origin), int(points[ends[w]] - origin)))
        return words_of, sums, peaks, spans

    def scores(self, words, sums, peaks):
        return 1 / (1 + np.exp(-(_summary(words, sums, peaks) @ self.calibration)))


def _summary(words, sums, peaks):
    rate = np.log1p(1000 * sums / np.maximum(words, 1))
    return np.column_stack((np.ones(len(sums)), np.log1p(sums), peaks, rate))


def _context_counts(column):
    """Features and in how many distinct contexts each stands, and the number of contexts."""
    seen, parts = np.zeros(0, np.uint64), []
    for chunk in chunks(_lowered(column)):
        kinds = _features(chunk)[3]
        h = np.concatenate((kinds[0][-1:], kinds[0], kinds[0][:1]))
        place = mixed(h[:-2] * np.uint64(3) + mixed(h[1:-1]) * np.uint64(5) + mixed(mixed(h[2:])))
        place, first = np.unique(place, return_index=True)
        fresh = ~np.isin(place, seen, assume_unique=True)
        seen = np.concatenate((seen, place[fresh]))
        kinds = kinds[:, first[fresh]]
        parts.append(np.unique(kinds[kinds != 0], return_counts=True))
    if not parts:
        return seen, np.zeros(0), 0
    values, at = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
    return values, np.bincount(at, np.concatenate([c for _, c in parts]), minlength=len(values)), len(seen)


def _chosen(toxic, clean):
    """Features that lean to toxic documents: hashes, and whether they label a token."""
    values, t, dark = toxic
    others, c, light = clean
    k = np.minimum(np.searchsorted(others, values), max(len(others) - 1, 0))
    both = np.where(others[k] == values, c[k], 0) if len(others) else np.zeros(len(values))
    ratio = ((t + 0.5) / (dark + 1)) / ((both + 0.5) / (light + 1))
    keep = (t >= LEAST_CONTEXTS) & (ratio >= KEEP_RATIO)
    return values[keep], ratio[keep] >= LABEL_RATIO


def _sequences(column, hashes, labels, toxic: bool):
    """Feature indexes and token labels of lines that hold a chosen feature, as sequences of at most LINE words.

    Together a line's sequences hold every word of it that has one; what lies between them is neutral.
    """
    for chunk in chunks(_lowered(column)):
        starts, _, rows, kinds = _features(chunk)
        line = np.cumsum(chunk.data == 10)[starts] + rows if len(starts) else starts
        k = np.minimum(np.searchsorted(hashes, kinds), len(hashes) - 1)
        found = hashes[k] == kinds
        lit = found.any(axis=0)
        for value in np.unique(line[lit]).tolist():
            a, end = np.searchsorted(line, [value, value + 1])
            marked = a + np.flatnonzero(lit[a:end])
            while len(marked):
                a = max(a, int(marked[0]) - LINE // 2)
                b = min(end, a + LINE)
                ids = np.where(found[:, a:b], k[:, a:b], len(hashes))
                y = toxic & (found[:, a:b] & labels[k[:, a:b]]).any(axis=0)
                yield ids.astype(np.int32), y
                a, marked = b, marked[np.searchsorted(marked, b) :]


def _padded(sequences, size):
    """Sequences as arrays of one length: feature indexes (``size``: none), labels, and what is filled."""
    n, longest = len(sequences), max(y.size for _, y in sequences)
    ids = np.full((n, longest, sequences[0][0].shape[0]), size, np.int32)
    gold, mask = np.zeros((n, longest), bool), np.zeros((n, longest), bool)
    for i, (x, y) in enumerate(sequences):
        ids[i, : y.size], gold[i, : y.size], mask[i, : y.size] = x.T, y, True
    return ids, gold, mask


def _gradient(theta, size, ids, gold, mask):
    """The gradient of the labels' log likelihood, from forward and backward sums."""
    n, longest = gold.shape
    step = np.exp(theta[size + 2 :].reshape(2, 2))
    score = np.append(theta[:size], 0.0)[ids].sum(axis=2) + theta[size]
    emit = np.stack((np.ones_like(score), np.exp(np.minimum(score, 50.0))), axis=2)
    emit[~mask] = 1.0
    ahead, back = np.zeros((longest, n, 2)), np.ones((longest, n, 2))
    ahead[0] = emit[:, 0] / emit[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, longest):
        go = (ahead[t - 1] @ step) * emit[:, t]
        go = np.where(mask[:, t, None], go, ahead[t - 1])
        ahead[t] = go / go.sum(axis=1, keepdims=True)
    for t in range(longest - 2, -1, -1):
        go = (emit[:, t + 1] * back[t + 1]) @ step.T
        go = np.where(mask[:, t + 1, None], go, 1.0)
        back[t] = go / go.max(axis=1, keepdims=True)
    p = ahead * back
    p = (p[:, :, 1] / p.sum(axis=2)).T
    short = np.where(mask, gold - p, 0.0)
    out = np.zeros_like(theta)
    shares = np.repeat(short.ravel(), ids.shape[2])
    out[:size] = np.bincount(ids.ravel(), shares, minlength=size + 1)[:size]
    out[size] = short.sum()
    between = ahead[:-1, :, :, None] * step * (emit[:, 1:].transpose(1, 0, 2) * back[1:])[:, :, None, :]
    between /= between.sum(axis=(2, 3), keepdims=True)
    follow = mask[:, 1:]
    pairs = [((gold[:, :-1] == a) & (gold[:, 1:] == b) & follow).sum() for a in (0, 1) for b in (0, 1)]
    out[size + 2 :] = pairs - (between * follow.T[:, :, None, None]).sum(axis=(0, 1)).ravel()
    return out


def _fit_chain(sequences, size, rounds=80, decay=1e-3):
    """Weights, bias and transitions that maximise the likelihood of the labels (Adam on the gradient).

    Sequences are padded and summed a block at a time, shorter ones first.
    """
    sequences = sorted(sequences, key=lambda s: s[1].size)
    blocks = [_padded(sequences[k : k + BLOCK], size) for k in range(0, len(sequences), BLOCK)]
    theta = np.zeros(size + 2 + 4)
    theta[size] = -4.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, rounds + 1):
        gradient = sum(_gradient(theta, size, *block) for block in blocks)
        gradient = gradient / len(sequences) - decay * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.99 * v + 0.01 * gradient**2
        theta += 0.3 * (m / (1 - 0.9**turn)) / (np.sqrt(v / (1 - 0.99**turn)) + 1e-8)
    return theta[:size], float(theta[size]), theta[size + 2 :].reshape(2, 2)


def _calibrated(x, y, weight, rounds=50):
    """Logistic regression by Newton's method, with a small ridge."""
    beta, ridge = np.zeros(x.shape[1]), np.diag([1e-6] + [1e-2] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (weight * (y - p)) - ridge @ beta
        bend = (x.T * (weight * p * (1 - p))) @ x + ridge
        step = np.linalg.solve(bend, slope)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, most_chars: int = MOST_CHARS) -> Model | None:
    """A model from ``labels (doc_id, toxic)`` and the texts of ``docs``; None if a class is missing.

    The sample has ``per_class`` documents of each class at most, those whose ids hash lowest,
    and takes no text of over ``most_chars`` characters. Of several labels of a document the largest counts; null labels and
    ids are left out.
    """
    known = labels.filter("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg((F.max("toxic") > 0).alias("y"))
    # a top list of each class: every task passes on per_class rows at most
    sides = [known.filter(F.col("y") == side).orderBy(F.xxhash64("doc_id"), "doc_id") for side in (True, False)]
    sample = sides[0].limit(per_class).union(sides[1].limit(per_class))
    share = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if len(share) < 2:
        return None
    texts = docs.select("doc_id", "text").filter(F.length("text").between(1, most_chars))
    rows = texts.join(F.broadcast(sample), "doc_id").select("doc_id", "y", "text").toArrow()
    rows = rows.sort_by([("doc_id", "ascending")])
    y = rows.column("y").to_numpy().astype(bool)
    if not y.any() or y.all():
        return None
    parts = [rows.filter(pa.array(y == side)).column("text").combine_chunks() for side in (True, False)]
    hashes, labelling = _chosen(*map(_context_counts, parts))
    weights, bias, chain = np.zeros(len(hashes)), -4.0, np.zeros((2, 2))
    if len(hashes):
        sequences = [s for part, side in zip(parts, (True, False), strict=True) for s in _sequences(part, hashes, labelling, side)]
        if sequences:
            weights, bias, chain = _fit_chain(sequences, len(hashes))
    model = Model(hashes, weights, bias, chain, np.zeros(4))
    words, sums, peaks, _ = model.read(rows.column("text").combine_chunks())
    weight = np.where(y, share[True] / y.sum(), share[False] / (~y).sum())
    model.calibration = _calibrated(_summary(words, sums, peaks), y, weight / weight.sum() * len(y))
    return model


def score(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``score`` (0 to 1), ``predicted`` (1 from CUT up) and ``spans`` (array of start and end in code points).

    Null and empty texts have no words and get the score of a text without toxic words. Without a
    model every score is zero. Columns of ``docs`` with these names are replaced; ids play no part.
    """
    docs = docs.drop("score", "predicted", "spans")
    at, names = docs.columns.index("text"), docs.columns
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def per_batch(batches):
        for batch in batches:
            n = batch.num_rows
            marks, spans = np.zeros(n), [[]] * n
            if model is not None:
                *summary, spans = model.read(batch.column(at))
                marks = model.scores(*summary)
            spans = [[{"start": a, "end": b} for a, b in row] for row in spans]
            columns = [
                *batch.columns,
                pa.array(marks, pa.float64()),
                pa.array((marks >= CUT).astype(np.int32), pa.int32()),
                pa.array(spans, kind),
            ]
            yield pa.RecordBatch.from_arrays(columns, [*names, "score", "predicted", "spans"])

    more = "score double, predicted int, spans array<struct<start:bigint,end:bigint>>"
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema), more])
    return docs.mapInArrow(per_batch, schema)
