"""Queries opN_* of the subpackage and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import decontaminate
from .exact import exact_dedup
from .grid_order import near_duplicate_vectors
from .html_text import extract_main_text
from .importance import resample
from .ngram_join import jaccard_join
from .periodic import periodic_runs, strongest
from .pieces import Pieces, encode
from .quality import fit_quality, score_quality
from .suffix_array import remove_repeated_bytes
from .toxicity import fit_toxicity, score_toxicity
from .url_filter import url_filter
from .word_windows import remove_repeated_words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The rules of the url contract (fixed values).
URL_RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block")]


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "rule string, verdict string")
    return url_filter(table(spark, sf_dir, "pages"), rules)


ORACLES["op1_url_filter"] = r"""
WITH rules(rule, verdict, rhost, rpath) AS (VALUES
    ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
    ('www.example.com/en/', 'allow', 'www.example.com', '/en/'),
    ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')),
cut AS (SELECT page_id, CASE WHEN url IS NULL OR instr(url, '://') = 0 THEN ''
                             ELSE substr(url, instr(url, '://') + 3) END AS rest FROM pages),
parts AS (SELECT page_id,
                 translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
fits AS (SELECT page_id, max_by({'r': rule, 'v': verdict}, length(rule)) AS best
         FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
         GROUP BY page_id)
SELECT page_id, host, path, best.r AS rule, coalesce(best.v, 'allow') AS verdict
FROM parts LEFT JOIN fits USING (page_id)
"""


@query
def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = fit_quality(docs, labels)
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return score_quality(docs.select("doc_id", "text", held.alias("held_out")), model, ["doc_id", "held_out"])


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    return score_toxicity(docs.select("doc_id", "text", held.alias("held_out")),
                          fit_toxicity(docs, labels), ["doc_id", "held_out"])


@query
def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"])


#: Vocabulary file of the token queries; any SentencePiece model with byte pieces will do.
PIECES_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@query
def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents"), Pieces(PIECES_MODEL), ["doc_id"], with_ids=False)


@query
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


@query
def op8_grid_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


ORACLES["op8_grid_order"] = """
WITH RECURSIVE good AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
      AND isfinite(list_sum(embedding::DOUBLE[])) AND (list_max(embedding) > 0 OR list_min(embedding) < 0)),
links AS (
    SELECT a.vec_id AS u, b.vec_id AS v FROM good a JOIN good b ON a.label = b.label AND a.vec_id <> b.vec_id
    WHERE list_dot_product(a.x, b.x) / (sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x))) >= 0.98),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
root AS (SELECT u, min(v) AS r FROM reach GROUP BY u),
degree AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(r, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(r, vec_id)) AS kept
FROM embeddings LEFT JOIN root ON root.u = vec_id LEFT JOIN degree ON degree.u = vec_id
"""


@query
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


ORACLES["op4_ngram_jaccard"] = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM documents),
grams AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM words)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS common
    FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
    SELECT u, v FROM pairs JOIN sizes x ON x.doc_id = u JOIN sizes y ON y.doc_id = v
    WHERE 5 * common >= 4 * (x.n + y.n - common)),
reach(u, v) AS (SELECT u, v FROM links UNION SELECT reach.u, links.v FROM reach JOIN links ON reach.v = links.u),
root AS (SELECT u, min(v) AS r FROM reach GROUP BY u),
degree AS (SELECT u, count(*) AS n FROM links GROUP BY u)
SELECT doc_id, least(doc_id, coalesce(r, doc_id)) AS class_id, coalesce(n, 0)::BIGINT AS n_links
FROM documents LEFT JOIN root ON root.u = doc_id LEFT JOIN degree ON degree.u = doc_id
"""


@query
def op9_word_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_words(table(spark, sf_dir, "documents"), ["doc_id"])


ORACLES["op9_word_windows"] = r"""
WITH words AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
    SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM words)),
first AS (SELECT s, min(doc_id) AS d FROM windows GROUP BY s),
gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
    FROM windows JOIN first USING (s) WHERE d < doc_id),
single AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM words),
kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n
    FROM single ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
"""


@query
def op6_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeated_bytes(table(spark, sf_dir, "documents"), ["doc_id"])


ORACLES["op6_suffix_array"] = """
WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
    SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s
    FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM bytes)),
first AS (SELECT s, min(doc_id) AS d FROM windows GROUP BY s),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM windows JOIN first USING (s) WHERE d < doc_id),
spans AS (
    SELECT doc_id, count(*) AS n_removed, count(*) FILTER (before IS NULL OR before <> p - 1) AS n_spans
    FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM gone) GROUP BY doc_id),
single AS (
    SELECT doc_id, p, substr(h, 2 * p + 1, 2) AS b FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS p FROM bytes)),
kept AS (SELECT doc_id, string_agg(b, '' ORDER BY p) AS k FROM single ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(k, ''))) AS kept_sha256
FROM bytes LEFT JOIN spans USING (doc_id) LEFT JOIN kept USING (doc_id)
"""


@query
def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLES["op13_exact_dedup"] = r"""
WITH digests AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents),
groups AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM digests GROUP BY text_sha256)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM digests JOIN groups USING (text_sha256)
"""


@query
def op12_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def _with_planted_runs(docs: DataFrame) -> DataFrame:
    """The documents of the runs contract: a tenth of them repeats its words from word a on with period p."""
    h = F.crc32(F.col("doc_id").cast("string"))
    g = F.floor(h / 10)

    def planted(words):
        n = F.size(words)
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        source = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.get(words, source(i))), " ")

    # The array of one element binds the words, so that the inner function reads them and does not cut the text again.
    words = F.array(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), 0))
    text = F.when((h % 10 == 0) & F.rlike("text", F.lit(r"[^\x20\x09-\x0D]")), F.get(F.transform(words, planted), F.lit(0)))
    return docs.withColumn("text", F.coalesce(text, "text"))


@query
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_with_planted_runs(table(spark, sf_dir, "documents").select("doc_id", "text")), ["doc_id"])
    best = found.withColumn("best", strongest(F.col("runs")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.floor(F.lit(1000) * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
