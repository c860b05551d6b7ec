import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from trialmart.llm import queries
from trialmart.llm.periodic import WaveletTree, find_runs, periodic_runs

from .conftest import SF, table


def brute(words):
    """[(start, length, period)] by comparing all words with all distances."""
    _, w = np.unique(np.array(words, object), return_inverse=True) if words else (None, np.zeros(0, int))
    n, runs = len(w), []
    for q in range(1, n // 4 + 1):
        same = np.concatenate([[0], (w[q:] == w[:-q]).astype(int), [0]])
        edge = np.flatnonzero(np.diff(same))
        for a, b in zip(edge[::2].tolist(), edge[1::2].tolist()):
            length = b - a + q
            if length >= max(6, 4 * q) and not any((w[a:a + length - r] == w[a + r:a + length]).all() for r in range(1, q)):
                runs.append((a, length, q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def cut(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def planted(i, words):
    n = len(words)
    h = zlib.crc32(str(i).encode())
    if i is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[k if k < a else a + (k - a) % p] for k in range(n)]


def test_wavelet_tree():
    rng = random.Random(2)
    for n, top in [(0, 1), (1, 1), (1, 5), (40, 7), (300, 64), (257, 1000)]:
        values = [rng.randrange(top) for _ in range(n)]
        tree = WaveletTree(np.array(values, np.int64))
        asked = [(*sorted((rng.randrange(n + 1), rng.randrange(n + 1))), rng.randrange(-1, top + 3)) for _ in range(200)]
        low, high, after = np.array(asked).T
        want = [min((v for v in values[a:b] if v > x), default=-1) for a, b, x in asked]
        assert tree.successor(low, high, after).tolist() == want


@pytest.mark.parametrize("letters", [1, 2, 3, 9])
def test_runs_brute(letters):
    rng = random.Random(letters)
    texts = [[], [0], [0] * 5, [0] * 6, [0, 1] * 4, [0, 1] * 4 + [0], [0, 0, 1] * 4, [0, 0, 1] * 4 + [0, 0, 2] * 4, [2, 0] * 3 + [2]]
    for _ in range(150):
        t = []
        while rng.random() < 0.8 and len(t) < 400:
            root = [rng.randrange(letters) for _ in range(rng.randrange(1, 40))]
            if rng.random() < 0.3:
                root *= 4  # runs of runs
            many = rng.choice([1, 1, 3, 4, 5, 9])
            t += (root * many)[: rng.randrange(1, len(root) * many + 1)]
        texts.append(t)
    owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
    first = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    start, length, period = find_runs(np.array([w for t in texts for w in t], np.int64), owner)
    got = [(owner[s], s - first[owner[s]], n, q) for s, n, q in zip(start.tolist(), length.tolist(), period.tolist())]
    want = [(k, *r) for k, t in enumerate(texts) for r in brute(t)]
    assert got == want and len(want) > 20
    # numbers too large for one sort key take the other way
    big = find_runs(np.array([w for t in texts for w in t], np.int64) * (1 << 40), owner)
    assert all((x == y).all() for x, y in zip(big, (start, length, period)))


def test_long_texts():
    rng = random.Random(4)
    root = [rng.randrange(50) for _ in range(1700)]
    for t in ([7] * 30_000, [1, 2, 3] * 5000, root * 7, root + [3] * 4000 + root * 4 + root[:800] + [51] + root):
        got = [tuple(map(int, r)) for r in zip(*find_runs(np.array(t), np.zeros(len(t), np.int64)))]
        assert got == brute(t) and got


def test_hard_rows(spark, hard_docs, hard_rows, no_docs):
    runs = [(900 + k, t, None, None, None, 0.5, "o", 7) for k, t in enumerate(
        ["a b\tc\n" * 4, " é\u00a0x y" * 9, "a a a a a a", "a a a a a", "x " + "a b " * 4 + "a b c " * 4 + "c", "\x1c\x1c \x1c\x1c " * 8])]
    docs = hard_docs.unionByName(spark.createDataFrame(runs, hard_docs.schema))
    out = periodic_runs(docs, ["doc_id", "_text", "_row", "n_chars"])
    assert out.columns == ["doc_id", "_text", "_row", "n_chars", "n_words", "runs", "collapsed_text"]
    got = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed_text) for r in out.collect()), key=str)
    want = []
    for i, t, *_ in [*hard_rows, *runs]:
        found = brute(cut(t))
        want.append((i, len(cut(t)), found, collapsed(cut(t), found)))
    assert got == sorted(want, key=str)
    assert periodic_runs(no_docs, ["doc_id"]).collect() == []


def digests(i, text):
    words = planted(i, cut(text))
    runs = brute(words)
    best = None
    for r in runs:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (i, len(runs), *((*best, 1000 * best[1] // best[2]) if best else (None,) * 4),
            sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(collapsed(words, runs)))


def test_query(spark):
    rows = [tuple(r) for r in table(spark, "documents").select("doc_id", "text").collect()]
    got = queries.op11_periodic_runs(spark, SF)
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    want = sorted(digests(*r) for r in rows)
    assert sorted(map(tuple, got.collect())) == want
    assert sum(r[1] > 0 for r in want) > 10


def test_query_hard_rows(spark, hard_rows, tmp_path):
    rows = [(k, r[1]) for k, r in enumerate(hard_rows * 12)] + [(None, "a b " * 5), (None, None)]
    rows = [r for r in rows if len(r[1] or "") < 30_000]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = sorted(map(tuple, queries.op11_periodic_runs(spark, str(tmp_path)).collect()), key=str)
    assert got == sorted((digests(*r) for r in rows), key=str)
