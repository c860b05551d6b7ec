import random
import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline as cp
from trialmart.llm import queries
from trialmart.llm.spark_ import stored

from .conftest import SF, table, words
from .test_pairs import brute_jaccard
from .test_repeats import W

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def cut_repeats(rows):
    least = {}
    data = {i: (t or "").encode() for i, t in rows}
    for i in sorted(data):
        for k in range(len(data[i]) - W + 1):
            least.setdefault(data[i][k:k + W], i)
    out = {}
    for i, d in data.items():
        gone = bytearray(len(d))
        for k in range(len(d) - W + 1):
            if least[d[k:k + W]] < i:
                gone[k:k + W] = b"\1" * W
        out[i] = bytes(x for x, g in zip(d, gone) if not g).decode("utf-8", "ignore")
    return out


def test_stages(spark):
    docs = table(spark, "documents")
    items = [r.text for r in table(spark, "benchmark").collect()]
    for name, stage in cp.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        after = stored(stage(spark, docs, SF))
        rows = {r.doc_id: r for r in after.collect()}
        assert len(rows) == after.count() and set(rows) <= set(before)
        if name == "quality":
            model = cp.fit_quality(docs, table(spark, "labels"))
            want = {r.doc_id for r in cp.score_quality(docs, model, ["doc_id"]).where("score >= 0.5").collect()}
            assert set(rows) == want
        elif name == "near_duplicates":
            assert set(rows) == {i for i, c, _ in brute_jaccard(list(before.items())) if i == c}
        elif name == "repeated_passages":
            assert {i: r.text for i, r in rows.items()} == cut_repeats(list(before.items()))
            assert all(r.n_chars == len(r.text) for r in rows.values())
        elif name == "contaminated":
            plain = lambda t: " ".join(re.findall(r"\w+", t.lower()))
            assert not any(plain(t) in plain(r.text) for r in rows.values() for t in items)
            gone = set(before) - set(rows)
            assert all(any(w in plain(before[i]) for t in items for w in [" ".join(plain(t).split()[k:k + 5]) for k in range(9)])
                       for i in gone)
        else:
            assert all(r.round_trip and r.text == before[i] and len(r.token_ids) == r.n_tokens for i, r in rows.items())
        if name != "tokens":
            assert after.columns == COLUMNS
        docs = after


def test_hard_rows(spark, hard_docs, hard_rows, no_docs):
    for start in (hard_docs, no_docs):
        docs = start
        for name, stage in cp.STAGES:
            docs = stored(stage(spark, docs, SF))
            if name != "tokens":
                assert docs.columns == start.columns


def test_near_duplicates_repeated_ids(spark, hard_docs, hard_rows):
    """Every row is a document of its own, also where ids repeat; brute force over rows."""
    rng = random.Random(8)
    article = words(rng, 80)
    more = [(5000, None, "en", "s", 1), (5000, article, "en", "s", 1), (5000, words(rng, 50), "en", "s", 1),
            (4999, article.replace(" ", "\n"), "en", "s", 1), (5001, article + " x", "en", "s", 1), (5001, "", "en", "s", 1)]
    rows = hard_rows + [(*r, 0.5, "o", 7) for r in more]
    docs = hard_docs.unionByName(spark.createDataFrame(rows[len(hard_rows):], hard_docs.schema))
    named = [r for r in rows if r[0] is not None]
    class_of = {k: c for k, c, _ in brute_jaccard([(k, r[1]) for k, r in enumerate(named)])}
    best = {}
    for k, r in enumerate(named):
        best[class_of[k]] = min(best.get(class_of[k], r[0]), r[0])
    got = Counter((r.doc_id, r.text) for r in cp.near_duplicates(spark, docs, SF).collect())
    assert Counter(i for i, _ in got.elements() if i is not None) == Counter(best.values())
    assert set(got) <= {r[:2] for r in rows} and got[5000, None] == 1 and got[5001, ""] == 1 and got[4999, article.replace(" ", "\n")] == 1
    assert {i for i, t in got if t == article or t == article + " x"} == set()
    assert len([1 for i, t in got if i == 13]) == 2  # one id, two unlike texts
    assert sum(n for (i, _), n in got.items() if i is None) == 2


def test_run(spark):
    out = cp.run(spark, SF)
    assert out.where(~F.col("round_trip")).count() == 0
    assert set(queries.ORACLES) <= set(queries.QUERIES) and [n for n, _ in cp.STAGES][0] == "quality"
