"""Toxicity severity by cumulative-link ordinal regression.

Sparse features of the whole text are its lower-cased words and their first
four and five bytes (so inflected forms share evidence), each with
``log2(1 + count)`` over a power of the norm of those the sample has (one half
or 1; in units of the training texts' median norm), so that many weak features
of a long text need not add up to a strong one.  Every feature of the training
sample has a weight, however rare it is; a quadratic penalty holds
the weights small, the less the more the classes differ in the feature: its
scale is its smoothed log odds, shrunk (never to nothing) where chance alone
reaches its chi-square among so many features.  The power of the norm is
chosen by the log likelihood of training rows left out in turn.  Grades run
from 0 to 3: label 0 is grade 0, and toxic training documents are graded by their margin in
the two-class model that has not seen them, cut at the terciles.  The weights
are fitted on all rows, both classes alike; their common slope and the
thresholds on the margins of rows left out, so that ``p_toxic`` holds at the
class shares of the sample.  One weight
vector is shared by the three ordered thresholds,

    P(grade > k) = sigmoid(w.x - theta_k),   theta_0 < theta_1 < theta_2,

and the severity is the expected grade, the sum of these probabilities.

Defined cases: null and empty texts have no features and get the grade
probabilities at w.x = 0; null labels are ignored and conflicting ones
averaged (one half or more is toxic); without labelled rows of both classes
every document gets the grade of the class there is (0 if none); if the sample
has no feature at all, nothing tells the classes apart and every document gets
grade 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytes_ import LOWER, U64, mix, prefix_hash, slices, span_hash, text_view, tokens

GRADES = 4
_TABLE_BITS = 20

#: Letters and the bytes of multi-byte characters make words.
LETTER = np.array([chr(b).isalpha() if b < 128 else True for b in range(256)])


def word_features(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(feature hashes, row of each) over all words of all rows, with repeats."""
    raw, offs = text_view(column)
    raw = LOWER[raw]
    starts, ends, counts = tokens(raw, offs, LETTER)
    prefix = prefix_hash(raw)
    owner = np.repeat(np.arange(len(counts)), counts)
    out, rows = [mix(span_hash(prefix, starts, ends), 1)], [owner]
    for n in (4, 5):
        long = ends - starts > n
        out.append(mix(span_hash(prefix, starts[long], starts[long] + n), n))
        rows.append(owner[long])
    return np.concatenate(out), np.concatenate(rows)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def _norm(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    return np.sqrt(np.maximum(np.bincount(row, value * value, n), 1))


@dataclass
class ToxicityModel:
    keys: np.ndarray                      # sorted feature hashes
    weights: np.ndarray
    thresholds: np.ndarray                # theta_0 .. theta_{GRADES-2}, increasing
    power: float = 0.0                    # of the norm that divides the features of a text,
    usual: float = 1.0                    # taken as a multiple of the median norm of the training texts
    hint: np.ndarray = field(init=False)  # low bits that any key has: most words stop here

    def __post_init__(self) -> None:
        self.hint = np.zeros(1 << _TABLE_BITS, bool)
        self.hint[(self.keys & U64((1 << _TABLE_BITS) - 1)).astype(np.int64)] = True

    def margins(self, column: pa.Array) -> np.ndarray:
        n = len(column)
        h, rows = word_features(column)
        near = self.hint[(h & U64((1 << _TABLE_BITS) - 1)).astype(np.int64)]
        h, rows = h[near], rows[near]
        if not len(h) or not len(self.keys):
            return np.zeros(n)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        hit = self.keys[at] == h
        pair, tf = np.unique(rows[hit] * len(self.keys) + at[hit], return_counts=True)
        row, value = pair // len(self.keys), np.log2(1 + tf)
        return np.bincount(row, value * self.weights[pair % len(self.keys)], n) / (_norm(row, value, n) / self.usual) ** self.power

    def exceed(self, column: pa.Array) -> np.ndarray:
        """P(grade > k) for every row, (rows, GRADES - 1)."""
        return _sigmoid(self.margins(column)[:, None] - self.thresholds[None, :])


@dataclass
class Sample:
    """Feature counts of the training rows as (row, column, value) triples."""

    row: np.ndarray
    col: np.ndarray
    value: np.ndarray
    shape: tuple[int, int]

    def dot(self, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, self.value * w[self.col], self.shape[0])

    def back(self, r: np.ndarray) -> np.ndarray:
        return np.bincount(self.col, self.value * r[self.row], self.shape[1])

    def scale(self, y: np.ndarray, used: np.ndarray) -> np.ndarray:
        """Smoothed log odds of every feature among the ``used`` rows, shrunk where its chi-square is small."""
        n1, n0 = (used & (y == 1)).sum(), (used & (y == 0)).sum()
        d1, d0 = (np.bincount(self.col[(used & (y == k))[self.row]], minlength=self.shape[1]) for k in (1, 0))
        both = (d1 + d0) / (n1 + n0)
        odds = np.log((d1 + n1 / (n1 + n0)) / (n1 + 1)) - np.log((d0 + n0 / (n1 + n0)) / (n0 + 1))
        firm = (d1 / n1 - d0 / n0) ** 2 / np.maximum(both * (1 - both) * (1 / n1 + 1 / n0), 1e-12)
        chance = 2 * np.log(max(self.shape[1], 2))  # about what the best of so many chance features reaches
        return 3 * odds * firm / (firm + chance)


def _minimise(f, at: np.ndarray, *, rounds: int, memory: int = 8) -> np.ndarray:
    """L-BFGS with backtracking; ``f`` gives (value, gradient)."""
    value, grad = f(at)
    pairs: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(rounds):
        step, kept = -grad, []
        for s, d, rho in reversed(pairs):
            kept.append(rho * (s @ step))
            step = step - kept[-1] * d
        if pairs:
            s, d, rho = pairs[-1]
            step = step / (rho * (d @ d))
        for (s, d, rho), a in zip(pairs, reversed(kept)):
            step = step + (a - rho * (d @ step)) * s
        slope, size = grad @ step, 1.0 if pairs else min(1.0, 1 / max(np.linalg.norm(grad), 1e-12))
        while True:
            new, new_grad = f(at + size * step)
            if new <= value + 1e-4 * size * slope or size < 1e-8:
                break
            size /= 2
        if new > value or value - new <= 1e-4 * abs(value):
            return at + size * step if new < value else at
        s, d = size * step, new_grad - grad
        if s @ d > 1e-12:
            pairs = [*pairs[-memory + 1:], (s, d, 1 / (s @ d))]
        at, value, grad = at + s, new, new_grad
    return at


def fit_ordinal(x: Sample, scale: np.ndarray, y: np.ndarray, weight: np.ndarray, *, grades: int = GRADES,
                l2: float = 0.001, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of the proportional-odds model on the scaled features, by the penalised likelihood."""
    m, k = x.shape[1], grades - 1
    weight = weight / weight.sum()

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:  # weights, first threshold, log gaps
        w, gaps = theta[:m], np.exp(theta[m + 1:])
        cuts = np.concatenate([[-np.inf], theta[m] + np.concatenate([[0.0], np.cumsum(gaps)]), [np.inf]])
        eta = x.dot(w * scale)
        upper, lower = _sigmoid(cuts[y + 1] - eta), _sigmoid(cuts[y] - eta)
        p = np.maximum(upper - lower, 1e-12)
        du, dl = upper * (1 - upper) / p * weight, lower * (1 - lower) / p * weight
        grad_cut = np.bincount(y, du, grades)[:k] - np.bincount(y, dl, grades)[1:]
        tail = np.cumsum(grad_cut[::-1])[::-1]
        grad = np.concatenate([x.back(du - dl) * scale + l2 * w, [-tail[0]], -(tail[1:] * gaps)])
        return 0.5 * l2 * (w @ w) - weight @ np.log(p), grad

    theta = _minimise(loss, np.concatenate([np.zeros(m), [1.0], np.zeros(k - 1)]), rounds=rounds)
    return theta[:m] * scale, theta[m] + np.concatenate([[0.0], np.cumsum(np.exp(theta[m + 1:]))])


def _class_weight(y: np.ndarray, used: np.ndarray) -> np.ndarray:
    return np.where(used, np.where(y == 1, 0.5 / max((used & (y == 1)).sum(), 1), 0.5 / max((used & (y == 0)).sum(), 1)), 0.0)


def _left_out(x: Sample, y: np.ndarray, grade: np.ndarray, folds: int) -> np.ndarray:
    """Margins of every row by the model that has not seen it; ``folds`` of 1 leaves none out."""
    part = np.zeros(len(y), np.int64)
    for label in (0, 1):
        part[y == label] = np.arange((y == label).sum()) % folds
    margin = np.zeros(len(y))
    for fold in range(folds):
        used = (part != fold) | (folds == 1)
        w, _ = fit_ordinal(x, x.scale(y, used), grade, _class_weight(y, used), grades=int(grade.max()) + 1)
        margin[part == fold] = x.dot(w)[part == fold]
    return margin


def _on_margins(margin: np.ndarray, grade: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray, float]:
    """(slope, thresholds, mean loss of the toxic threshold) of the ordinal model whose one feature is the margin."""
    unit = max(float(margin.std()), 1e-12)
    one = Sample(np.arange(len(margin)), np.zeros(len(margin), np.int64), margin / unit, (len(margin), 1))
    w, cuts = fit_ordinal(one, np.ones(1), grade, weight, grades=int(grade.max()) + 1, l2=1e-4, rounds=200)
    z = margin / unit * w[0] - cuts[0]
    return float(w[0] / unit), cuts, float(weight @ np.logaddexp(0, np.where(grade > 0, -z, z)))


def fit_toxicity(docs: DataFrame, labels: DataFrame, *, per_class: int = 1500,
                 powers: tuple[float, ...] = (0.5, 1.0), folds: int = 5,
                 train: str = "crc32(cast(doc_id as string)) % 3 <> 1") -> ToxicityModel:
    """Fit on at most ``per_class`` labelled documents of each class, the first by a hash of their id."""
    known = (labels.where("doc_id is not null and toxic is not null").where(train)
             .groupBy("doc_id").agg((F.avg("toxic") >= 0.5).cast("int").alias("_y")))
    picks = [known.where(f"_y = {y}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    ids = F.broadcast(picks[0].union(picks[1]))  # at most 2 * per_class rows of two numbers

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            h, rows = word_features(part.column("text"))
            keys, tfs = [], []
            for i in range(part.num_rows):
                key, tf = np.unique(h[rows == i], return_counts=True)
                keys.append(key.tobytes())
                tfs.append(np.minimum(tf, 65535).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("_y"), pa.array(keys, pa.binary()),
                                              pa.array(tfs, pa.binary())], names=["doc_id", "_y", "key", "tf"])

    rows = (docs.select("doc_id", "text").join(ids, "doc_id").select("doc_id", "_y", "text")
            .mapInArrow(sparse, "doc_id long, _y int, key binary, tf binary").collect())
    rows.sort(key=lambda r: (r.doc_id, bytes(r.key)))
    y = np.array([r["_y"] for r in rows], np.int64)
    if len(set(y.tolist())) < 2:
        high = np.full(GRADES - 1, -30.0 if len(y) and y[0] else 30.0)
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), high)
    keys = [np.frombuffer(r["key"], np.uint64) for r in rows]
    tfs = [np.frombuffer(r["tf"], np.uint16) for r in rows]
    vocabulary = np.unique(np.concatenate(keys))
    if not len(vocabulary):
        return ToxicityModel(np.zeros(0, np.uint64), np.zeros(0), np.full(GRADES - 1, 30.0))
    row = np.repeat(np.arange(len(y)), [len(k) for k in keys])
    value = np.log2(1 + np.concatenate(tfs).astype(np.float64))
    norms = _norm(row, value, len(y))
    usual = float(np.median(norms))
    norm = (norms / usual)[row]
    col = np.concatenate([np.searchsorted(vocabulary, k) for k in keys])
    every = np.ones(len(y), bool)
    weight = _class_weight(y, every)
    folds = max(1, min(folds, int(y.sum()), int(len(y) - y.sum())))  # a single row of a class cannot be left out
    tried = []
    for power in powers[:1] if folds == 1 else powers:
        x = Sample(row, col, value / norm ** power, (len(y), len(vocabulary)))
        margin = _left_out(x, y, y, folds)
        tried.append((_on_margins(margin, y, weight)[2], power, margin))
    _, power, margin = min(tried, key=lambda t: t[:2])
    x = Sample(row, col, value / norm ** power, (len(y), len(vocabulary)))
    grade = y * (1 + np.searchsorted(np.quantile(margin[y == 1], [1 / 3, 2 / 3]), margin))
    w, thresholds = fit_ordinal(x, x.scale(y, every), grade, weight)
    if folds > 1 and grade.max() == GRADES - 1:
        slope, cut, _ = _on_margins(_left_out(x, y, grade, folds), y, np.ones(len(y)) / len(y))
        if slope > 0:  # otherwise the left-out margins say nothing and the fit's own thresholds stay
            w, thresholds = w * slope, cut[0] + slope * (thresholds - thresholds[0])
    return ToxicityModel(vocabulary, w, thresholds, power, usual)


def score_toxicity(docs: DataFrame, model: ToxicityModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row with ``severity`` (0 to 3), ``p_toxic``, ``grade`` and ``predicted``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(text_col).alias("_text"), *keep)
    schema = (docs.select(*keep).schema.add("severity", "double").add("p_toxic", "double")
              .add("grade", "integer").add("predicted", "integer"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            p = shared.value.exceed(part.column(0))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(p.sum(1)), pa.array(p[:, 0]),
                 pa.array((p >= 0.5).sum(1).astype(np.int32)), pa.array((p[:, 0] >= 0.5).astype(np.int32))],
                names=schema.names)

    return rows.mapInArrow(score, schema)
