"""Column helpers on the edge rows of FIXTURES.md section 3."""

from pyspark.sql import functions as F

from trialmart import functions as fn


def _one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_to_unsigned(spark):
    rows = [("12 ",), ("10,20",), ("",), ("abc",), (None,), ("  7x",)]
    assert _one(spark, rows, "t string", fn.to_unsigned("t")) == [12, 10, 0, 0, None, 7]


def test_cycle_label(spark):
    rows = [(1, 8, 0), (1, 0, 0), (0, 8, 1), (0, 0, 0), (None, 1, 0), (2, 1, None)]
    got = _one(spark, rows, "c int, d int, l int", fn.cycle_label("c", "d", "l"))
    assert got == ["C1 / D8", "C1 /", "D8 Delayed", "", None, "C2 / D1 Delayed"]


def test_clip_and_cut(spark):
    rows = [("abc   def  ",), (None,)]
    assert _one(spark, rows, "t string", fn.clip("t", 6)) == ["abc", None]
    assert _one(spark, rows, "t string", fn.cut("t", 6)) == ["abc   ", None]


def test_names(spark):
    schema = "f string, m string, l string"
    rows = [("Ann", "B", "Lee"), ("Ann", None, "Lee"), ("Ann", "", "Lee"), (None, "B", "Lee"),
            (None, None, None)]
    assert _one(spark, rows, schema, fn.full_name("f", "l")) == [
        "Ann Lee", "Ann Lee", "Ann Lee", None, None]
    assert _one(spark, rows, schema, fn.name_collapse("f", "m", "l")) == [
        "Ann B Lee", "Ann Lee", "Ann Lee", " B Lee", " "]
    assert _one(spark, rows, schema, fn.name_upper("l", "f", "m")) == [
        "LEE, ANN B.", "LEE, ANN ", "LEE, ANN ", "LEE, B.", ", "]
    assert _one(spark, rows, schema, fn.last_initial("l", "f")) == [
        "Lee A", "Lee A", "Lee A", None, None]


def test_flags_and_maps(spark):
    rows = [(1,), (0,), (None,)]
    assert _one(spark, rows, "v int", fn.flag("v")) == ["Y", "N", "N"]
    assert _one(spark, rows, "v int", fn.code_map("v", {0: "Revoked"}, default="")) == ["", "Revoked", ""]
    assert _one(spark, rows, "v int", fn.code_map("v", {0: "Revoked"}, default=None)) == [None, "Revoked", None]


def test_fallback_and_predicates(spark):
    rows = [("Other", "x"), (None, "y"), ("NCI", "z")]
    assert _one(spark, rows, "a string, b string", fn.fallback("a", "b")) == ["x", "y", "NCI"]
    blanks = [("",), (" ",), (None,), ("a",)]
    assert _one(spark, blanks, "t string", fn.not_blank("t")) == [False, False, None, True]
    codes = [("123",), ("-7",), ("A1",), ("",)]
    assert _one(spark, codes, "t string", fn.is_signed_integer("t")) == [True, True, False, False]


def test_date_key_and_stamp(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2019-12-01 10:00:00' AS ts")
    assert df.select(fn.date_key("ts")).first()[0] == "20191201"
    assert df.select(fn.on_or_after("ts", "2019-12-01")).first()[0] is True
    stamp = df.select(fn.run_stamp("2024-02-01 06:00:00").alias("r"))
    assert dict(stamp.dtypes)["r"] == "timestamp_ntz"
