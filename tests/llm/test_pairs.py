import random
import re

import numpy as np
import pyarrow as pa

from trialmart.llm import queries
from trialmart.llm.grid_order import near_duplicate_vectors
from trialmart.llm.ngram_join import banding, jaccard_join
from trialmart.llm.spark_ import components

from ..compare import compare, duck_connection
from .conftest import SF, words


def classes(vertices, edges):
    root = {v: v for v in vertices}

    def find(v):
        while root[v] != v:
            root[v] = root[root[v]]
            v = root[v]
        return v
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {v: find(v) for v in vertices}


def test_components(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 100 + i) for i in range(1, 50)] + \
        [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    got = dict(components(spark.createDataFrame([*edges, (None, 4), (500, 500)], "a long, b long")).collect())
    want = classes({v for e in edges for v in e} | {500}, edges)
    assert got == want


def test_components_take_few_rounds_and_plans_of_bounded_size(spark, monkeypatch):
    """A chain of 120 in random order: rounds by its logarithm, sizes that Spark estimates are not multiplied from round to round."""
    ids = random.Random(5).sample(range(1000), 120)
    rounds = []
    monkeypatch.setattr(type(spark.range(1)), "isEmpty", lambda df, f=type(spark.range(1)).isEmpty: rounds.append(1) or f(df))
    found = components(spark.createDataFrame([*zip(ids, ids[1:])], "a long, b long"))
    size = found._jdf.queryExecution().optimizedPlan().stats().sizeInBytes().bit_length()
    assert dict(found.collect()) == {i: min(ids) for i in ids}
    assert len(rounds) <= 12 and size < 64


def grams(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_jaccard(rows):
    sets = [(i, grams(t)) for i, t in rows]
    links, edges = [0] * len(rows), []
    for a in range(len(rows)):
        for b in range(len(rows)):
            (i, x), (j, y) = sets[a], sets[b]
            if a != b and i is not None and j is not None and x and y and 5 * len(x & y) >= 4 * len(x | y):
                links[a] += 1
                edges.append((i, j))
    root = classes({i for i, _ in rows if i is not None}, edges)
    return sorted(((i, root.get(i), n) for (i, _), n in zip(rows, links)), key=str)


def test_banding():
    bands, rows = banding(0.8, 0.9995)
    assert 1 - (1 - 0.8 ** rows) ** bands >= 0.9995 and bands * rows <= 128


def test_jaccard_hard(hard_docs, hard_rows, no_docs):
    rows = [r[:2] for r in hard_rows if r[0] != 13]  # one id with two texts: see below
    got = jaccard_join(hard_docs.where("doc_id <> 13 or doc_id is null")).collect()
    assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == brute_jaccard(rows)
    assert jaccard_join(no_docs).collect() == []
    assert jaccard_join(hard_docs).count() == len(hard_rows)


def test_jaccard_blocks(spark):
    """A group of near copies that is dealt over many units; results don't depend on the block size."""
    rng = random.Random(9)
    base = words(rng, 60).split()
    rows = []
    for i in range(120):
        w = list(base)
        for _ in range(rng.randrange(0, 3)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(99)}"
        rows.append((i, " ".join(w)))
    rows += [(1000 + i, words(rng, 30)) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = brute_jaccard(rows)
    for block_rows in (1000, 17):
        got = jaccard_join(docs, block_rows=block_rows).collect()
        assert sorted(((r.doc_id, r.class_id, r.n_links) for r in got), key=str) == want


def test_vectors_hard(spark):
    rng = np.random.default_rng(4)
    base = rng.standard_normal((20, 16))
    rows = []
    for i in range(300):
        v = base[i % 20] + rng.standard_normal(16) * (0.02 + 0.05 * (i % 3))
        rows.append((i, [float(x) for x in v.astype(np.float32)], i % 2))
    rows += [(400, rows[5][1], 1), (401, rows[5][1], 1), (402, rows[5][1], 0), (403, [x * 2 for x in rows[5][1]], 1), (5, rows[5][1], 1),
             (404, None, 1), (405, [0.0] * 16, 1), (406, [float("nan")] + [1.0] * 15, 1), (407, [float("inf")] + [1.0] * 15, 1),
             (408, [None] + [1.0] * 15, 1), (409, rows[5][1], None), (410, [1.0], 1), (411, [], 1), (None, rows[5][1], 1)]
    # tiny and huge components, and vectors of other lengths beside them
    rows += [(420, [1e-170] * 16, 1), (421, [3e-170] * 15 + [2e-170], 1), (422, [5e-324] * 16, 1), (423, [1.0] * 16, 1), (424, [1e200] * 16, 1),
             (425, [-1e308] * 16, 1), (426, [x * 1e-200 for x in rows[5][1]], 1), (430, [1.0, 2.0], 1), (431, [1.0, 2.0], 1),
             (432, [2.0, 4.01], 1), (433, [1.0, 2.0], 0), (434, [2.0], 1), (435, [-1.0], 1)]
    rows += [(500 + i, [float(x) for x in rng.standard_normal(9) * 0.02 + (i % 3 == np.arange(9))], 1) for i in range(40)]
    ok = lambda i, v, y: i is not None and y is not None and v and None not in v and np.isfinite(v).all() and any(v)
    links, edges = [0] * len(rows), []
    for a, (i, u, x) in enumerate(rows):
        for b, (j, v, y) in enumerate(rows):
            if a != b and ok(i, u, x) and ok(j, v, y) and x == y and len(u) == len(v):
                p, q = (np.array(t) / np.abs(t).max() for t in (u, v))
                if p @ q / (np.sqrt(p @ p) * np.sqrt(q @ q)) >= 0.98:
                    links[a] += 1
                    edges.append((i, j))
    root = classes({i for i, _, _ in rows if i is not None}, edges)
    want = sorted(((i, n, root.get(i), i is None or root[i] == i) for (i, _, _), n in zip(rows, links)), key=str)
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, label int, _id int, _x string")
    for block in (1024, 16):
        got = near_duplicate_vectors(df, block=block).collect()
        assert sorted(map(tuple, got), key=str) == want
    assert max(links) > 10
    assert near_duplicate_vectors(df.limit(0)).collect() == []
    assert near_duplicate_vectors(df.where("vec_id in (404, 405)")).count() == 2


def test_oracles(spark):
    con = duck_connection(SF)
    for name in ("op4_ngram_jaccard", "op8_grid_order", "op9_word_windows"):
        n, problems = compare(queries.QUERIES[name](spark, SF), con, queries.ORACLES[name])
        assert n > 0 and not problems, (name, problems)
