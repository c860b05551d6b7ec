"""Corpus pipeline: from raw documents to tokens.

``STAGES`` are (name, function) pairs; each function takes (spark, docs,
sf_dir), works on all that its predecessor kept, and returns a DataFrame that
is written as Parquet and read again as the next one's ``docs``.  All but the
last return the columns of ``documents``.

1. quality: rows that the neighbour vote scores below 0.5 go.
2. near_duplicates: of every group of rows whose texts are linked by a word
   5-gram Jaccard similarity of 0.8 or more, one row with the smallest id stays;
   rows that share an id but no similar text, texts without words and rows
   without an id stay as they are.
3. repeated_passages: bytes of 50-byte strings that an earlier document has go
   from the text (``n_chars`` follows; a character cut apart goes whole).
4. contaminated: rows that cover half of a benchmark item or more go.
5. tokens: every row gets its SentencePiece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trialmart.llm.decontaminate import decontaminate
from trialmart.llm.ngram_join import jaccard_join
from trialmart.llm.pieces import Pieces, encode
from trialmart.llm.quality import fit_quality, score_quality
from trialmart.llm.queries import PIECES_MODEL, table
from trialmart.llm.spark_ import stored
from trialmart.llm.suffix_array import remove_repeated_bytes


def _carried(docs: DataFrame) -> DataFrame:
    """id, text and the whole row, whatever its columns are called."""
    return docs.select("doc_id", "text", F.struct("*").alias("_row"))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(_carried(docs), model, ["_row"]).where("predicted = 1").select("_row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = _carried(docs).withColumn("_key", F.col("doc_id"))
    if not rows.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty():
        # Rows that share an id are rows of their own: numbered, and written once, so that each keeps its number.
        rows = stored(_carried(docs).withColumn("_key", F.monotonically_increasing_id()))
    named = rows.where("doc_id is not null")
    classes = jaccard_join(named.select("_key", "text"), id_col="_key").select("_key", "class_id")
    first = (named.select("_key", "doc_id").join(classes, "_key")
             .groupBy("class_id").agg(F.min(F.struct("doc_id", "_key"))["_key"].alias("_key")))
    return (named.join(first, "_key", "left_semi").unionByName(rows.where("doc_id is null")).select("_row.*"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    new = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast(docs.schema["n_chars"].dataType)}
    done = remove_repeated_bytes(_carried(docs), ["_row"], with_text=True)
    return done.select(*(new.get(c, F.col("_row").getField(c)).alias(c) for c in docs.columns))


def contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = decontaminate(_carried(docs), table(spark, sf_dir, "benchmark"), ["_row"])
    return found.where("contaminated = 0").select("_row.*")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encode(_carried(docs), Pieces(PIECES_MODEL), ["_row"]).select(
        "_row.*", "n_tokens", "token_ids", "ids_sha256", "round_trip")


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("repeated_passages", repeated_passages),
          ("contaminated", contaminated), ("tokens", tokens)]

#: The quality, tiling and token stages have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
