"""Toxicity by classifier chains.

Categories are predicted one after the other by linear (logistic) models.  The
model of a category sees the features of a text and the probabilities of all
earlier categories.  For training, those probabilities are out-of-fold: models
fitted on the other folds predict a fold's rows, so a later model learns from the kind of
probability it will meet, not from fitted ones.

The last category is the given label ``toxic``.  The earlier ones refine it and
come from the labelled rows themselves: toxic rows are dealt into groups by the features that
occur together in them (spherical k-means over the features more frequent in
toxic rows, weighted by their log-odds).  A fold's models are trained on groups refined
on the other folds' rows alone.

Features are whole words, of any length, and word beginnings of 3 to 8 bytes (toxic roots of
inflecting languages show in beginnings), by presence in the whole text.
Fitting uses a bounded sample: the ``sample`` labelled rows with the smallest
hash of doc_id, whatever the size of the corpus.  Chosen are the ``features``
features that tell the labels apart best (chi-square, in at least ``min_rows``
rows), of related ones (one begins the other) only the best; an L1 penalty then
keeps few of them.  Scoring is one narrow map over all documents and their
whole texts; it carries the few features with a weight and no shuffle.

The decision threshold maximises F1 over the out-of-fold probabilities of the
last category.

Defined cases: null and empty texts score as texts without words; a doc_id
labelled more than once counts as toxic if any label says so, null labels say
nothing; without rows of both classes nothing is learnt, probabilities are 0 and
nothing is toxic; repeated rows score alike; other columns are ignored (unchanged by
:func:`drop_toxic`).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelhouse.llm.common import claim, columns, keep, tuned
from reelhouse.llm.words import LOWER, buffers, byte_table, mix64, split_words

SAMPLE, FEATURES, MIN_ROWS, FOLDS = 6000, 300, 5, 3
PENALTY = 0.0003
#: Categories that refine the label, in chain order.
GROUPS = ("group1", "group2", "group3")
#: Words of the features: runs of letters, lower-cased (bytes above 0x7F are letters).
LETTERS = byte_table(b for b in range(128) if not (65 <= b <= 90 or 97 <= b <= 122))
LENGTHS = range(3, 9)


def _heads(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """First eight (lower-cased) bytes of each word as one 64-bit number."""
    out = np.zeros(len(start), np.uint64)
    for k in range(8):
        at = start + k
        byte = LOWER[data[np.minimum(at, max(0, len(data) - 1))]].astype(np.uint64)
        out |= np.where(at < end, byte, 0).astype(np.uint64) << np.uint64(8 * k)
    return out


def _keys(words, heads: np.ndarray, size: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Feature keys, and the words that have one: beginnings of ``length``
    bytes, or for length 0 the whole words (by their hash)."""
    if not length:
        return words.hashes[0], np.arange(len(size))
    own = np.flatnonzero(size >= length)
    cut = heads[own] & np.uint64((1 << 8 * length) - 1)
    with np.errstate(over="ignore"):
        return mix64(cut + np.uint64(length + 1) * np.uint64(0x9E3779B97F4A7C15)), own


def _words(data, offsets):
    """Words with their hashes, first bytes and sizes."""
    words = split_words(data, offsets, LETTERS, LOWER, salts=(41,))
    return words, _heads(data, words.start, words.end), words.end - words.start


def feature_key(feature: bytes) -> int:
    raw = np.frombuffer(feature[1:], np.uint8)
    words, heads, size = _words(raw, np.array([0, len(raw)]))
    return int(_keys(words, heads, size, 0 if feature[:1] == b"=" else len(raw))[0][0])


class Chain:
    """Weights of a fitted chain over features."""

    def __init__(self, names, words, weights, bias, earlier, threshold):
        self.names, self.words, self.threshold = names, words, threshold
        self.weights, self.bias, self.earlier = weights, bias, earlier
        hashes = np.array([feature_key(w) for w in words], np.uint64)
        self.order = np.argsort(hashes)
        self.hashes = hashes[self.order]
        self.lengths = sorted({0 if w[:1] == b"=" else len(w) - 1 for w in words})

    def probabilities(self, data, offsets) -> np.ndarray:
        """(texts, categories)."""
        n = len(offsets) - 1
        out = np.zeros((n, len(self.names)))
        if not self.names:
            return out
        score = np.tile(np.array(self.bias, float), (n, 1))
        if len(self.hashes):
            words, heads, size = _words(data, offsets)
            seen = []
            for length in self.lengths:
                keys, own = _keys(words, heads, size, length)
                at = np.minimum(np.searchsorted(self.hashes, keys), len(self.hashes) - 1)
                hit = np.flatnonzero(self.hashes[at] == keys)
                seen.append((np.searchsorted(words.first, own[hit], "right") - 1) * len(self.hashes) + at[hit])
            seen = np.unique(np.concatenate(seen))
            np.add.at(score, seen // len(self.hashes), self.weights[self.order[seen % len(self.hashes)]])
        for k in range(len(self.names)):
            out[:, k] = 1 / (1 + np.exp(-(score[:, k] + out[:, :k] @ np.array(self.earlier[k], float))))
        return out


NOTHING = Chain([], [], np.zeros((0, 0)), [], [], 2.0)


def _features_of_sample(docs: DataFrame) -> DataFrame:
    """doc_id, label, distinct features."""

    def run(batches):
        claim("toxicity")
        for batch in batches:
            ids, label, text = columns(batch, "doc_id", "label", "text")
            data, offsets = buffers(text)
            words = split_words(data, offsets, LETTERS, LOWER, salts=())
            folded, rows = LOWER[data].tobytes(), []
            spans = list(zip(words.start.tolist(), words.end.tolist()))
            for a, b in zip(words.first[:-1], words.first[1:]):
                own = {folded[s:e] for s, e in spans[a:b]}
                rows.append(sorted({b"=" + w for w in own} | {b"^" + w[:n] for w in own for n in LENGTHS if n <= len(w)}))
            yield pa.RecordBatch.from_arrays([ids, label, pa.array(rows, pa.list_(pa.binary()))], ["doc_id", "label", "words"])

    return docs.mapInArrow(run, "doc_id long, label int, words array<binary>")


def logistic(x: np.ndarray, y: np.ndarray, free: int, penalty: float, rounds: int = 500) -> tuple[np.ndarray, float]:
    """L1-penalised logistic regression by accelerated proximal gradient; the
    last ``free`` columns carry no penalty."""
    n, m = x.shape
    shrink = np.full(m, penalty, np.float32)
    if free:
        shrink[m - free:] = 0
    step = 4 * n / max(1e-9, _largest_eigenvalue(x))
    w, bias = np.zeros(m, np.float32), 0.0
    v, c, t = w, bias, 1.0
    for _ in range(rounds):
        error = 1 / (1 + np.exp(-(x @ v + np.float32(c)))) - y
        nw = v - step * (x.T @ error) / n
        nw = np.sign(nw) * np.maximum(np.abs(nw) - step * shrink, 0)
        nb = c - step * float(error.mean())
        nt = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = nw + np.float32((t - 1) / nt) * (nw - w), nb + (t - 1) / nt * (nb - bias)
        w, bias, t = nw, nb, nt
    return w, float(bias)


def _largest_eigenvalue(x: np.ndarray, rounds: int = 30) -> float:
    """Of x'x with a constant column, by power iteration (with a margin)."""
    v, b, size = np.ones(x.shape[1], np.float32), 1.0, 1.0
    for _ in range(rounds):
        u = x @ v + np.float32(b)
        v, b = x.T @ u, float(u.sum())
        size = float(np.sqrt((v.astype(float) ** 2).sum() + b * b)) or 1.0
        v, b = v / np.float32(size), b / size
    return 1.1 * size


def centres(rows: np.ndarray, weight: np.ndarray, k: int, start: np.ndarray | None = None, rounds: int = 25) -> np.ndarray:
    """Centres of ``k`` groups of rows (spherical k-means): from ``start``, or
    from rows far apart, the first being the one with the most weight."""
    v = _directions(rows, weight)
    if start is None:
        start = v[[int(np.argmax(rows @ weight))]]
        while len(start) < k:
            near = (v @ start.T).max(1)
            if near.min() > 1 - 1e-6:
                break
            start = np.vstack([start, v[int(np.argmin(near))]])
    for _ in range(rounds):
        own = np.argmax(v @ start.T, 1)
        sums = np.stack([v[own == g].sum(0) for g in range(len(start))])
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        moved = np.where(size > 0, sums / np.maximum(size, 1e-12), start)
        if np.allclose(moved, start, atol=1e-9):
            break
        start = moved
    return start


def _directions(rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
    v = rows * weight
    return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)


def group_targets(x: np.ndarray, label: np.ndarray, k: int, folds: np.ndarray, count: int):
    """0/1 targets of the groups: of all rows, and as each fold's training
    sees them (centres refined without the fold)."""
    bad = label > 0
    inside, outside = x[bad].mean(0), x[~bad].mean(0)
    weight = np.maximum(0, np.log((inside + 1 / len(x)) / (outside + 1 / len(x))))

    def targets(at):
        own = np.argmax(_directions(x, weight) @ at.T, 1)
        return [(label * (own == g)).astype(np.float32) for g in range(len(at))]

    whole = centres(x[bad], weight, k)
    return targets(whole), [targets(centres(x[bad & (folds != f)], weight, k, whole)) if (bad & (folds != f)).any() else targets(whole)
                            for f in range(count)]


def fit_chain(x: np.ndarray, label: np.ndarray, fold: np.ndarray, folds: int, groups: tuple = GROUPS, penalty: float = PENALTY):
    """(names, weights per category, biases, weights of earlier
    probabilities, out-of-fold probabilities) of a chain over 0/1 features."""
    n = len(label)
    whole, per = group_targets(x, label, len(groups), fold, folds) if groups and x.shape[1] else ([], [[]] * folds)
    target = {**dict(zip(groups, whole)), "toxic": label}
    names = [c for c in target if 0 < target[c].sum() < n]
    weights, bias, earlier, held = [], [], [], np.zeros((n, 0), np.float32)
    for k, name in enumerate(names):
        full = np.hstack([x, held])
        w, b = logistic(full, target[name], k, penalty)
        out = np.zeros((n, 1), np.float32)
        for f in range(folds):
            own = label if name == "toxic" else per[f][groups.index(name)] if groups.index(name) < len(per[f]) else target[name]
            fw, fb = logistic(full[fold != f], own[fold != f], k, penalty)
            out[fold == f, 0] = 1 / (1 + np.exp(-(full[fold == f] @ fw + fb)))
        held = np.hstack([held, out])
        weights.append(w[:x.shape[1]])
        bias.append(b)
        earlier.append(w[x.shape[1]:].tolist())
    return names, weights, bias, earlier, held


def fit(docs: DataFrame, labels: DataFrame, groups: tuple = GROUPS, sample: int = SAMPLE, features: int = FEATURES,
        min_rows: int = MIN_ROWS, folds: int = FOLDS, penalty: float = PENALTY) -> Chain:
    """Fit the chain on a bounded sample of labelled documents.

    Words are counted and chosen by Spark; the driver then holds one bounded
    matrix of ``sample`` rows by ``features`` words."""
    tuned(docs.sparkSession)
    chosen = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # At most ``sample`` rows of two numbers: a proven bound for the broadcast.
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
    rows = keep(_features_of_sample(rows).dropDuplicates(["doc_id"]), "toxicity-sample")
    literal = lambda features: F.array(*(F.lit(bytearray(x)) for x in features))
    y = rows.select("doc_id", "label").orderBy("doc_id").toArrow()
    label = y["label"].to_numpy().astype(np.float32)
    n, good = len(label), float(label.sum())
    if not n or not 0 < good < n:
        return NOTHING
    df, hit = F.count("*").alias("df"), F.sum("label").alias("hit")
    # squared deviation of the feature's toxic rows from their expectation (chi-square)
    chi = F.pow(F.col("hit") - F.col("df") * F.lit(good / n), 2) / (F.col("df") * (F.lit(n + 1) - F.col("df")))
    ranked = rows.select("label", F.explode("words").alias("word")).groupBy("word").agg(df, hit).where(F.col("df") >= min(min_rows, int(good))) \
        .orderBy(chi.desc(), F.length("word"), "word").select("word").toArrow()["word"].to_pylist()
    words = _unrelated(ranked, features)
    at = {w: k for k, w in enumerate(words)}
    own = F.array_intersect("words", literal(words)) if words else F.array().cast("array<binary>")
    x = np.zeros((n, len(words)), np.float32)
    for i, found in enumerate(rows.select("doc_id", own.alias("own")).orderBy("doc_id").toArrow()["own"].to_pylist()):
        x[i, [at[w] for w in found]] = 1
    fold = (mix64(y["doc_id"].to_numpy().astype(np.uint64)) % np.uint64(folds)).astype(int)
    names, weights, bias, earlier, held = fit_chain(x, label, fold, folds, tuple(groups), penalty)
    used = np.flatnonzero(np.abs(np.stack(weights, 1)).max(1) > 0)
    return Chain(names, [words[i] for i in used], np.stack(weights, 1)[used].astype(float), bias, earlier, best_threshold(label, held[:, -1]))


def _unrelated(ranked: list[bytes], most: int) -> list[bytes]:
    """Best features of which none begins another."""
    chosen: list[bytes] = []
    beginnings: set[bytes] = set()
    taken: set[bytes] = set()
    for f in ranked:
        word = f[1:]
        if word in beginnings or any(word[:k] in taken for k in range(1, len(word) + 1)):
            continue
        chosen.append(f)
        taken.add(word)
        beginnings.update(word[:k] for k in range(1, len(word)))
        if len(chosen) == most:
            break
    return chosen


def best_threshold(truth: np.ndarray, p: np.ndarray) -> float:
    """Middle of the gap above the cut with the best F1 (ties: the cut that
    keeps the widest gap)."""
    order = np.argsort(-p, kind="stable")
    p, truth = p[order], truth[order]
    found = np.cumsum(truth)
    f1 = 2 * found / (np.arange(1, len(p) + 1) + truth.sum())
    below = np.append(p[1:], 0.0)
    f1[p == below] = -1
    best = np.flatnonzero(f1 >= f1.max() - 1e-12)
    k = best[np.argmax(p[best] - below[best])]
    return float((p[k] + below[k]) / 2)


def scores(docs: DataFrame, chain: Chain) -> DataFrame:
    """One row per document row: doc_id, p_<category>..., toxic."""
    spark = tuned(docs.sparkSession)
    shared = spark.sparkContext.broadcast(chain)  # at most ``features`` words
    names = [*GROUPS, "toxic"]

    def run(batches):
        claim("toxicity")
        chain = shared.value
        for batch in batches:
            ids, text = columns(batch, "doc_id", "text")
            p = chain.probabilities(*buffers(text))
            col = {c: p[:, k] for k, c in enumerate(chain.names)}
            zero = np.zeros(len(ids))
            yield pa.RecordBatch.from_arrays(
                [ids.cast(pa.int64()), *(pa.array(col.get(c, zero)) for c in names), pa.array(col.get("toxic", zero) >= chain.threshold)],
                ["doc_id", *(f"p_{c}" for c in names), "toxic"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, " + ", ".join(f"p_{c} double" for c in names) + ", toxic boolean")


def drop_toxic(docs: DataFrame, chain: Chain) -> DataFrame:
    """The rows of ``docs`` not found toxic, all columns unchanged."""
    shared = tuned(docs.sparkSession).sparkContext.broadcast(chain)

    def run(batches):
        claim("toxicity")
        chain = shared.value
        for batch in batches:
            p = chain.probabilities(*buffers(columns(batch, "text")[0]))
            bad = p[:, -1] >= chain.threshold if p.shape[1] else np.zeros(len(p), bool)
            yield batch.filter(pa.array(~bad))

    return docs.mapInArrow(run, docs.schema)
