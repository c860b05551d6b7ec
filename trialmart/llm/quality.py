"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

A document is the vector of its character-class bigram rates (64 classes, so
4,096 terms over the *whole* text) and a few surface terms (repeated words,
line starts, length), square-rooted, weighted by inverse document frequency and
projected on the leading right singular vectors of the labelled sample.  The
labelled vectors are broadcast (their number is a parameter, see ``per_class``)
and every document is compared with all of them by blocked cosine products; the
``k`` nearest vote with their similarity.

Labels, language, source and ids are no inputs.  Defined cases: null and empty
texts have no direction and get the mean label of the training rows; null or
conflicting labels: rows of one document are averaged, a mean of one half or
more counts as 1; null ids are scored like any other row; without labelled rows
of both classes every document gets the constant that is left (1.0 if none).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bytes_ import NOT_SPACE, prefix_hash, slices, span_hash, text_view, tokens


def _classes() -> np.ndarray:
    """64 classes of bytes: 26 letters, capitals, digits, blanks, line ends, controls, each sign, 2 of UTF-8."""
    table = np.zeros(256, np.uint8)
    signs = [b for b in range(0x21, 0x7F) if not chr(b).isalnum()]
    for b in range(256):
        ch = chr(b)
        if b >= 0x80:
            table[b] = 31 if b >= 0xC0 else 30
        elif ch.islower():
            table[b] = b - ord("a")
        elif ch.isupper():
            table[b] = 26
        elif ch.isdigit():
            table[b] = 27
        elif b in (0x0A, 0x0D):
            table[b] = 28
        elif b in signs:
            table[b] = 32 + signs.index(b)
        else:
            table[b] = 29
    return table


CLASS = _classes()
BIGRAMS = 64 * 64
SURFACE = 8
TERMS = BIGRAMS + SURFACE
#: Weight of the mean label in a vote: it decides only where no neighbour is similar.
PRIOR = 0.5


def features(column: pa.Array) -> np.ndarray:
    """Term rates of every text, (rows, TERMS) float32, square-rooted."""
    raw, offs = text_view(column)
    n = len(offs) - 1
    size = np.diff(offs)
    out = np.zeros((n, TERMS), np.float32)
    if len(raw) > 1:
        code = CLASS[raw].astype(np.int32)
        pair = code[:-1] * 64 + code[1:]
        for i in range(n):  # one histogram a text
            a, b = offs[i], offs[i + 1] - 1
            if b > a:
                out[i, :BIGRAMS] = np.bincount(pair[a:b], minlength=BIGRAMS)
        out[:, :BIGRAMS] /= np.maximum(size - 1, 1)[:, None]
    starts, ends, words = tokens(raw, offs, NOT_SPACE)
    if len(starts):
        h = span_hash(prefix_hash(raw), starts, ends)
        owner = np.repeat(np.arange(n), words)
        repeat = np.zeros(len(h), bool)
        repeat[1:] = (h[1:] == h[:-1]) & (owner[1:] == owner[:-1])
        per = 1 / (words + 8)  # a few words give no firm rate
        count = lambda mask: np.bincount(owner[mask], minlength=n) * per
        first, last = raw[starts], raw[ends - 1]
        out[:, BIGRAMS] = count(repeat)
        out[:, BIGRAMS + 1] = count(ends - starts == 1)
        out[:, BIGRAMS + 2] = count((CLASS[first] == 26) & (CLASS[last] != 26))
        second = raw[np.minimum(starts + 1, ends - 1)]  # of the word itself, never of the next text
        out[:, BIGRAMS + 3] = count((CLASS[first] == 26) & (ends - starts > 1) & (CLASS[second] == 26))
        out[:, BIGRAMS + 4] = count(CLASS[last] >= 32)
        out[:, BIGRAMS + 5] = count(CLASS[first] >= 32)
        out[:, BIGRAMS + 6] = count(CLASS[first] == 27)
        order = np.lexsort((h, owner))
        fresh = np.ones(len(h), bool)
        fresh[1:] = (h[order][1:] != h[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        distinct = np.bincount(owner[order][fresh], minlength=n)
        out[:, BIGRAMS + 7] = (words - distinct) * per
    return np.sqrt(out)


@dataclass
class QualityModel:
    idf: np.ndarray          # TERMS
    axes: np.ndarray         # TERMS x dims
    vectors: np.ndarray      # labelled vectors, unit length
    labels: np.ndarray       # 0/1
    base: float              # mean label of the training rows
    k: int

    def embed(self, x: np.ndarray) -> np.ndarray:
        v = (x * self.idf) @ self.axes
        norm = np.sqrt((v * v).sum(1, keepdims=True))
        return np.divide(v, norm, out=np.zeros_like(v), where=norm > 0)

    def vote(self, x: np.ndarray, block: int = 512) -> np.ndarray:
        """Similarity-weighted label mean of the k nearest labelled vectors, for rows of features."""
        out = np.full(len(x), self.base)
        if not len(self.vectors):
            return out
        v, k = self.embed(x), min(self.k, len(self.vectors))
        for at in range(0, len(v), block):
            cos = v[at: at + block] @ self.vectors.T
            near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(cos, near, 1), 0).astype(np.float64) ** 8
            out[at: at + block] = (((weight * self.labels[near]).sum(1) + PRIOR * self.base)
                                   / (weight.sum(1) + PRIOR))
        return np.clip(out, 0, 1)


def fit_quality(docs: DataFrame, labels: DataFrame, *, per_class: int = 1500, dims: int = 48, k: int = 15,
                train: str = "crc32(cast(doc_id as string)) % 3 <> 1", seed: int = 7) -> QualityModel:
    """Fit on at most ``per_class`` labelled documents of each class, the first by a hash of their id.

    ``train`` selects the label rows that may be learned from.
    """
    known = (labels.where("doc_id is not null and quality is not null").where(train)
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("_y")))
    base = known.agg(F.avg("_y")).first()[0]
    none = QualityModel(np.ones(TERMS, np.float32), np.zeros((TERMS, 1), np.float32),
                        np.zeros((0, 1), np.float32), np.zeros(0), 1.0 if base is None else float(base), k)
    picks = [known.where(f"_y = {y}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for y in (0, 1)]
    ids = F.broadcast(picks[0].union(picks[1]))  # at most 2 * per_class rows of two numbers

    def sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text"):
            x = features(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("_y"), part.column("doc_id"), pa.array([np.flatnonzero(r).astype(np.int16).tobytes() for r in x], pa.binary()),
                 pa.array([r[r != 0].astype(np.float16).tobytes() for r in x], pa.binary())],
                names=["_y", "doc_id", "at", "rate"])

    rows = (docs.select("doc_id", "text").join(ids, "doc_id").select("_y", "doc_id", "text")
            .mapInArrow(sparse, "_y int, doc_id long, at binary, rate binary").collect())
    rows.sort(key=lambda r: (r.doc_id, bytes(r.at), bytes(r.rate)))
    x, y = np.zeros((len(rows), TERMS), np.float32), np.array([r["_y"] for r in rows], np.int64)
    for i, r in enumerate(rows):
        x[i, np.frombuffer(r["at"], np.int16)] = np.frombuffer(r["rate"], np.float16)
    full = x.any(1)
    x, y = x[full], y[full]
    if len(set(y.tolist())) < 2:
        return none
    idf = (1 + np.log(len(x) / (1 + (x > 0).sum(0)))).astype(np.float32)
    x *= idf
    rng = np.random.default_rng(seed)
    dims = min(dims, len(x))
    q = rng.standard_normal((TERMS, dims + 8)).astype(np.float32)
    for _ in range(4):  # subspace iteration towards the leading right singular vectors
        q, _ = np.linalg.qr(x.T @ (x @ q))
    _, _, vt = np.linalg.svd(x @ q, full_matrices=False)
    model = QualityModel(idf, np.ascontiguousarray((q @ vt.T)[:, :dims]), none.vectors, none.labels, float(base), k)
    model.vectors, model.labels = model.embed(x / idf), y.astype(np.float64)
    return model


def score_quality(docs: DataFrame, model: QualityModel, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row with ``score`` (0 to 1) and ``predicted`` (score >= 0.5)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(text_col).alias("_text"), *keep)
    schema = docs.select(*keep).schema.add("score", "double").add("predicted", "integer")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "_text"):
            s = shared.value.vote(features(part.column(0)))
            yield pa.RecordBatch.from_arrays(
                [*part.columns[1:], pa.array(s, pa.float64()), pa.array((s >= 0.5).astype(np.int32))],
                names=schema.names)

    return rows.mapInArrow(score, schema)
