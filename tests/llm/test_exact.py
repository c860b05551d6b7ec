import hashlib
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from trialmart.llm import queries
from trialmart.llm.exact import exact_dedup, frequent, tracked_items

from ..compare import compare, duck_connection
from .conftest import SF


def brute(rows):
    """Multiset of result rows by comparing normalised texts."""
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = Counter()
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        out.update((i, ids[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()) for k, i in enumerate(ids))
    return out


def found(df):
    return Counter(tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect())


def test_oracle(spark):
    n, problems = compare(queries.op13_exact_dedup(spark, SF), duck_connection(SF), queries.ORACLES["op13_exact_dedup"])
    assert n > 0 and not problems


@pytest.mark.parametrize("least", [1, 3, 10 ** 9])  # every group a winner, some, none
def test_hard_rows(hard_docs, hard_rows, no_docs, least):
    rows = [r[:2] for r in hard_rows]
    spaced = [(r[0] + 500 if r[0] else None, (r[1] or "").replace(" ", "\t\r\n ")) for r in hard_rows]
    docs = hard_docs.unionByName(hard_docs.select(
        (F.col("doc_id") + 500).alias("doc_id"), F.replace(F.coalesce("text", F.lit("")), F.lit(" "), F.lit("\t\r\n ")).alias("text"),
        *hard_docs.columns[2:]))
    got = exact_dedup(docs, ["lang", "score", "_row"], least_copies=least)
    assert found(got) == brute(rows + spaced)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256", "lang", "score", "_row"]
    assert got.where("kept").count() == got.select("text_sha256").distinct().count()
    assert exact_dedup(no_docs, least_copies=least).collect() == []


def test_hot_groups_do_not_shuffle(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot  text' WHEN id % 50 = 1 THEN 'warm' WHEN id % 7 = 0 THEN NULL ELSE 't' || (id div 2) END AS text")
    rows = [tuple(r) for r in docs.collect()]
    assert found(exact_dedup(docs)) == brute(rows)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"))
    named = {r.text for r in frequent(texts, "text", 64).collect()}
    assert {"hot  text", ""} <= named and len(named) <= 64
    # more different texts than counters: the winners are still those above 7 / tracked of the rows
    assert found(exact_dedup(docs, tracked=64)) == brute(rows)
    assert tracked_items(8) == 4096 and tracked_items(200) == 16384 and tracked_items(10 ** 6) == 2 ** 19


def test_ids_of_any_kind(spark):
    docs = spark.createDataFrame([("b", "x y"), ("a", "x  y"), (None, "x\ny"), ("a", "x y"), (None, " x y")], "name string, body string")
    got = exact_dedup(docs, id_col="name", text_col="body", least_copies=1)
    assert sorted(map(str, ((r.name, r.keep_id, r.group_size, r.kept) for r in got.collect()))) == sorted(map(str, [
        ("b", "a", 4, False), ("a", "a", 4, True), ("a", "a", 4, False), (None, "a", 4, False), (None, None, 1, True)]))
