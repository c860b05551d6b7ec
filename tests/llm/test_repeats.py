import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from trialmart.llm import queries, repeats
from trialmart.llm.suffix_array import PERIOD, COVER, byte_classes, difference_cover, remove_repeated_bytes
from trialmart.llm.word_windows import remove_repeated_words, word_classes

from ..compare import compare, duck_connection
from .conftest import SF, table, words

W = 50


def brute(rows, split, join):
    """[(id, units, removed, spans, digest)] by comparing all windows."""
    least = {}
    units = [(i, split(t)) for i, t in rows]
    for i, u in units:
        if i is not None:
            for k in range(len(u) - W + 1):
                key = tuple(u[k:k + W])
                least[key] = min(i, least.get(key, i))
    out = []
    for i, u in units:
        gone = [False] * len(u)
        if i is not None:
            for k in range(len(u) - W + 1):
                if least[tuple(u[k:k + W])] < i:
                    gone[k:k + W] = [True] * W
        spans = sum(g and (k == 0 or not gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(u), sum(gone), spans, hashlib.sha256(join([x for x, g in zip(u, gone) if not g])).hexdigest()))
    return sorted(out, key=str)


def split_words(t):
    return re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode())


def bytes_of(t):
    return list((t or "").encode())


def test_words_brute(hard_docs, hard_rows):
    got = remove_repeated_words(hard_docs, ["doc_id"]).collect()
    want = brute([r[:2] for r in hard_rows], split_words, b" ".join)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == \
        sorted(((i, n, g, d) for i, n, g, _, d in want), key=str)
    assert sum(g for _, _, g, _, _ in want) > 300


def test_bytes_brute(hard_docs, hard_rows):
    rows = [r for r in hard_rows if len(r[1] or "") < 30_000]
    docs = hard_docs.where("coalesce(length(text), 0) < 30000")
    got = remove_repeated_bytes(docs, ["doc_id"]).collect()
    want = brute([r[:2] for r in rows], bytes_of, bytes)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got), key=str) == want


@pytest.mark.parametrize("remove, split, join", [(remove_repeated_bytes, bytes_of, bytes), (remove_repeated_words, split_words, b" ".join)])
def test_generated(spark, remove, split, join):
    docs = table(spark, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    want = {i: (n, g, d) for i, n, g, _, d in brute(rows, split, join)}
    got = {r[0]: (r[1], r.n_removed, r.kept_sha256) for r in remove(docs, ["doc_id"]).collect()}
    assert got == want


def test_oracle(spark):
    n, problems = compare(queries.op6_suffix_array(spark, SF), duck_connection(SF), queries.ORACLES["op6_suffix_array"])
    assert n > 0 and not problems


@pytest.mark.parametrize("remove, split, join", [(remove_repeated_bytes, bytes_of, bytes), (remove_repeated_words, split_words, b" ".join)])
def test_null_and_repeated_ids(spark, monkeypatch, remove, split, join):
    """A third of the rows without an id, a third under one id (some of them repeated whole): no worker gets them together."""
    rng = random.Random(12)
    passage = words(rng, 60)
    text = lambda: " ".join([words(rng, rng.randrange(5, 60)), *([passage] if rng.random() < 0.4 else []), words(rng, rng.randrange(5, 60))])
    rows = [(None, text()) for _ in range(60)] + [(7, text()) for _ in range(40)] + [(k, text()) for k in range(60)]
    rows += [rows[70]] * 20 + [rows[5]] * 3 + [(7, None), (7, None), (None, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    monkeypatch.setattr(repeats, "GROUP_BYTES", 2000)
    got = sorted(((r.doc_id, r[1], r.n_removed, r.kept_sha256) for r in remove(docs, ["doc_id"]).collect()), key=str)
    want = sorted(((i, n, g, d) for i, n, g, _, d in brute(rows, split, join)), key=str)
    assert got == want and sum(g > 0 for _, _, g, _ in want) > 20
    # what a worker is dealt is bounded by bytes, whatever the ids
    dealt = repeats.deal_groups(docs.where("doc_id is not null").dropDuplicates(), "doc_id", "text")
    sizes = [r.n for r in dealt.groupBy("_dp").agg(F.sum(F.octet_length("text")).alias("n")).collect()]
    assert len(sizes) > 10 and max(sizes) < 6 * 2000


def test_empty_and_text(no_docs, spark):
    assert remove_repeated_words(no_docs, ["doc_id"]).collect() == []
    assert remove_repeated_bytes(no_docs, ["doc_id"]).collect() == []
    text = "é" * 40  # 80 bytes
    docs = spark.createDataFrame([(1, text), (2, "ab" + text + "c")], "doc_id long, text string")
    got = {r.doc_id: r for r in remove_repeated_bytes(docs, ["doc_id"], with_text=True).collect()}
    assert got[1].kept_text == text and got[1].n_removed == 0
    assert got[2].kept_text == "abc" and (got[2].n_removed, got[2].n_spans) == (80, 1)


def test_difference_cover():
    assert COVER == difference_cover(PERIOD)
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


@pytest.mark.parametrize("letters", [1, 2, 3, 26])
def test_classes(letters):
    rng = random.Random(letters)
    base = [rng.randrange(97, 97 + letters) for _ in range(300)]
    strings = set()
    for _ in range(150):
        a = rng.randrange(200)
        s = base[a:a + rng.randrange(50, 100)]
        if rng.random() < 0.5:
            s[rng.randrange(len(s))] = 97
        strings.add(bytes(s))
    strings = sorted(strings)
    windows, classes = byte_classes(np.frombuffer(b"".join(strings), np.uint8), np.array([len(s) for s in strings]))
    content = [s[k:k + W] for s in strings for k in range(len(s) - W + 1)]
    assert windows.tolist() == [len(s) - W + 1 for s in strings]
    assert len(set(zip(content, classes.tolist()))) == len(set(content)) == len(set(classes.tolist()))
    spaced = [" ".join(map(chr, s)).encode() for s in strings]
    windows, classes = word_classes(np.frombuffer(b"".join(s + b" " for s in spaced), np.uint8), np.array([len(s) + 1 for s in spaced]))
    assert len(set(zip(content, classes.tolist()))) == len(set(content)) == len(set(classes.tolist()))
