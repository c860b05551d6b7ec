import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from trialmart.llm import queries
from trialmart.llm.crc import crc32_spans, joined
from trialmart.llm.importance import bucket_gains, draw, resample

from .conftest import SF, table


def features(text):
    low = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    return len(w), [" ".join(w[i:i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10_000


def brute(rows, target):
    """{(doc_id, n_features, weight, score, rank): rows} one n-gram at a time."""
    found = [(i, *features(t)) for i, t in rows]
    s = Counter(bucket(f) for _, _, fs in found for f in fs)
    t = Counter(bucket(f) for text in target for f in features(text)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    out = []
    for i, n, fs in found:
        weight, score = sum(gain(bucket(f)) for f in fs), None
        if i is not None:
            h = int(hashlib.sha256(f"42:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(fs), weight, score, None, n])
    able = sorted((r for r in out if r[0] is not None and r[5] >= 20), key=lambda r: (-r[3], r[0]))
    for k, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_crc():
    rng = random.Random(3)
    parts = [bytes(rng.randrange(256) for _ in range(n)) for n in [0, 1, 2, 3, 7, 47, 48, 49, 50, 300, 5000, 1, 0]]
    raw, sizes = np.frombuffer(b"".join(parts), np.uint8), np.array([len(p) for p in parts])
    ends = np.cumsum(sizes)
    got = crc32_spans(raw, ends - sizes, ends)
    assert got.tolist() == [zlib.crc32(p) for p in parts]
    assert joined(got[:-1], got[1:], sizes[1:]).tolist() == [zlib.crc32(a + b) for a, b in zip(parts, parts[1:])]
    none = np.zeros(0, np.int64)
    assert crc32_spans(raw, none, none).tolist() == []


def test_generated(spark):
    docs, target = table(spark, "documents"), table(spark, "benchmark")
    want = brute([tuple(r) for r in docs.select("doc_id", "text").collect()], [r.text for r in target.collect()])
    assert found(queries.op12_importance(spark, SF)) == want
    assert sum(r[4] is not None for r in want) > 5


@pytest.mark.parametrize("targets", [["The w1 W2 w3", None, "", "w1 w2 w3 w4"], []])
def test_hard_rows(spark, hard_docs, hard_rows, no_docs, targets):
    target = spark.createDataFrame([(k, t) for k, t in enumerate(targets)], "item_id long, text string")
    more = [(1000 + k, f"w{k} " * 10 + "end w1 w2, w3 ", "en", "s", 1, 0.5, "o", 7) for k in range(60)]
    docs = hard_docs.unionByName(spark.createDataFrame(more, hard_docs.schema))
    got = resample(docs, target, ["doc_id", "score", "_row", "lang"])
    want = brute([r[:2] for r in [*hard_rows, *more]], targets)
    assert found(got) == want
    assert resample(no_docs, target).collect() == []
    assert sorted(r["rank"] for r in got.collect() if r["rank"]) == list(range(1, 1 + sum(r[4] is not None for r in want)))


def test_ties_and_repeats(spark):
    weighed = spark.createDataFrame([(7, 30, 0)] * 50 + [(None, 30, 10 ** 9), (8, 19, 10 ** 9), (9, 20, -(10 ** 9))], "doc_id long, n_words long, weight long")
    got = draw(weighed.repartition(4), percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 26))
    assert {r.doc_id for r in got if r["rank"]} == {7}
    assert len({r["score"] for r in got if r.doc_id == 7}) == 1
    assert draw(weighed.where("doc_id = 8")).collect()[0]["rank"] is None
    gains = bucket_gains(weighed.selectExpr("'a' AS text").limit(0), weighed.selectExpr("'a' AS text").limit(0))
    assert set(gains.tolist()) == {0}
