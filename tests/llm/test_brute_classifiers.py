"""The two classifiers against plain Python: features from the text, every neighbour, every word, the fit's optimum."""

import math
import re
from collections import Counter
from functools import cache

import numpy as np
import pyarrow as pa

from trialmart.llm.quality import PRIOR, features, fit_quality, score_quality
from trialmart.llm.toxicity import Sample, fit_ordinal, fit_toxicity, score_toxicity, word_features

from .conftest import SF, table

SF2 = "/root/testdata/sf0.01"


# -- quality: nearest neighbours by a full sort -----------------------------------
def byte_class(b):
    ch = chr(b)
    if b >= 0x80:
        return 31 if b >= 0xC0 else 30
    if ch.islower():
        return b - 97
    if ch.isupper() or ch.isdigit():
        return 26 if ch.isupper() else 27
    if ch in "\n\r":
        return 28
    signs = [c for c in map(chr, range(33, 127)) if not c.isalnum()]
    return 32 + signs.index(ch) if ch in signs else 29


CLASS = [byte_class(b) for b in range(256)]


def brute_features(text):
    data = (text or "").encode()
    out = np.zeros(64 * 64 + 8)
    for a, b in zip(data, data[1:]):
        out[CLASS[a] * 64 + CLASS[b]] += 1 / (len(data) - 1)
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if words:
        per = 1 / (len(words) + 8)
        tests = [lambda i, w: i > 0 and words[i - 1] == w, lambda i, w: len(w) == 1,
                 lambda i, w: CLASS[w[0]] == 26 != CLASS[w[-1]], lambda i, w: len(w) > 1 and CLASS[w[0]] == 26 == CLASS[w[1]],
                 lambda i, w: CLASS[w[-1]] >= 32,
                 lambda i, w: CLASS[w[0]] >= 32, lambda i, w: CLASS[w[0]] == 27]
        for t, test in enumerate(tests):
            out[4096 + t] = per * sum(test(i, w) for i, w in enumerate(words))
        out[4103] = (len(words) - len(set(words))) * per
    return np.sqrt(out)


def votes(model, x, slack=1e-5):
    """(lowest, highest) score: neighbours whose cosines differ by less than ``slack`` may come in any order."""
    v = (x * model.idf.astype(float)) @ model.axes.astype(float)
    if not np.sqrt(v @ v):
        return model.base, model.base
    cos = model.vectors.astype(float) @ (v / np.sqrt(v @ v))
    order = np.argsort(-cos, kind="stable")
    k = min(model.k, len(order))
    last = cos[order[k - 1]]
    sure = [i for i in order if cos[i] > last + slack]
    tied = sorted((i for i in order if abs(cos[i] - last) <= slack), key=lambda i: model.labels[i])
    out = []
    for some in (tied[:k - len(sure)], tied[len(tied) - (k - len(sure)):]):
        weight = [max(cos[i], 0) ** 8 for i in [*sure, *some]]
        total = sum(w * model.labels[i] for w, i in zip(weight, [*sure, *some]))
        out.append((total + PRIOR * model.base) / (sum(weight) + PRIOR))
    return min(out), max(out)


def test_quality_votes_brute(spark, hard_docs, hard_rows):
    model = fit_quality(table(spark, "documents", SF2), table(spark, "labels", SF2))
    docs = table(spark, "documents").select("doc_id", "text").union(hard_docs.select("doc_id", "text"))
    got = score_quality(docs, model, ["text"]).collect()
    assert len(got) == table(spark, "documents").count() + len(hard_rows)
    off = 0
    for r in got:
        low, high = votes(model, brute_features(r.text))
        off += not low - 2e-3 <= r.score <= high + 2e-3
        assert r.predicted == int(r.score >= 0.5)
    assert off == 0


def test_features_do_not_depend_on_the_batch():
    texts = ["x A", "Bx", "", None, "A", "ABC", "B", "a A", "A b"]
    together = features(pa.array(texts))
    assert all((together[i] == features(pa.array([t], pa.string()))[0]).all() for i, t in enumerate(texts))


# -- toxicity: word by word ---------------------------------------------------------
@cache
def hashes(word):
    """Hashes of a word alone in its text: the word, its first 4 and its first 5 bytes."""
    return [int(h) for h in word_features(pa.array([word.decode()]))[0]]


def brute_exceed(model, text):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode())
    seen, spelled = Counter(), {}
    for word in re.findall(rb"[a-z\x80-\xff]+", lower):
        spellings = [word] + [word[:n] + bytes([n]) for n in (4, 5) if len(word) > n]
        assert len(spellings) == len(hashes(word))
        for h, spelling in zip(hashes(word), spellings):
            assert spelled.setdefault(h, spelling) == spelling  # no two features of a text share a hash
            seen[h] += 1
    weights = dict(zip(map(int, model.keys), model.weights))
    hit = {h: math.log2(1 + n) for h, n in seen.items() if h in weights}
    norm = math.sqrt(max(sum(v * v for v in hit.values()), 1)) / model.usual
    margin = sum(v * weights[h] for h, v in hit.items()) / norm ** model.power if hit else 0.0
    return [1 / (1 + math.exp(min(max(cut - margin, -700), 700))) for cut in model.thresholds]


def test_toxicity_scores_brute(spark, hard_docs, hard_rows):
    model = fit_toxicity(table(spark, "documents", SF2), table(spark, "labels", SF2))
    docs = table(spark, "documents", SF).select("doc_id", "text").union(hard_docs.select("doc_id", "text"))
    got = score_toxicity(docs, model, ["text"]).collect()
    assert len(got) == table(spark, "documents").count() + len(hard_rows) and {r.predicted for r in got} == {0, 1}
    for r in got:
        p = brute_exceed(model, r.text)
        assert abs(r.severity - sum(p)) < 1e-6 and abs(r.p_toxic - p[0]) < 1e-6
        if min(abs(q - 0.5) for q in p) > 1e-6:
            assert (r.grade, r.predicted) == (sum(q >= 0.5 for q in p), int(p[0] >= 0.5))


def test_ordinal_fit_is_the_optimum():
    """No step away from the fitted weights and thresholds lowers the penalised likelihood, written out row by row."""
    rng = np.random.default_rng(2)
    dense = np.round(rng.random((120, 6)) * (rng.random((120, 6)) < 0.6), 2)
    eta = dense @ np.array([3.0, -2, 1, 0, 0.5, 2]) + rng.logistic(size=120)
    grade = np.searchsorted([0.5, 1.5, 3.0], eta)
    row, col = np.nonzero(dense)
    weight, scale = rng.random(120) + 0.5, np.array([1.0, 2, 1, 1, 0.5, 1])
    w, cuts = fit_ordinal(Sample(row, col, dense[row, col], dense.shape), scale, grade, weight, grades=4, l2=0.01, rounds=500)

    def loss(w, cuts):
        total = 0.0
        for x, g, share in zip(dense, grade, weight / weight.sum()):
            at_least = lambda k: 1.0 if k == 0 else 0.0 if k == 4 else 1 / (1 + math.exp(cuts[k - 1] - x @ w))
            total -= share * math.log(at_least(g) - at_least(g + 1))
        return total + 0.005 * ((w / scale) ** 2).sum()

    best = loss(w, cuts)
    assert (np.diff(cuts) > 0).all()
    for size in (0.3, 0.03):
        for _ in range(60):
            step = rng.standard_normal(9)
            step *= size / np.linalg.norm(step)
            if (np.diff(cuts + step[6:]) > 0).all():
                assert loss(w + step[:6], cuts + step[6:]) > best - 1e-4 * size
