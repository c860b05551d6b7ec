"""Column helpers for the marts (all JVM-side built-ins, no Python UDFs).

Each helper returns a ``Column`` so it stays inside whole-stage codegen.
NULL behaviour follows the source procedures: ``concat`` with a NULL part
is NULL, a CASE whose condition is NULL takes the ELSE branch.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- text shaping ---------------------------------------------------------

def clip(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters, trailing spaces removed (F-01)."""
    return F.rtrim(F.substring(_c(c), 1, n))


def cut(c: ColumnOrName, n: int) -> Column:
    """First ``n`` characters, no trimming (F-02)."""
    return F.substring(_c(c), 1, n)


def initial(c: ColumnOrName) -> Column:
    """First character (F-04); NULL stays NULL."""
    return F.substring(_c(c), 1, 1)


def to_unsigned(c: ColumnOrName, wide: bool = False) -> Column:
    """Number from text the lenient way (F-06).

    Leading blanks are skipped and the leading run of digits is the value;
    text without leading digits gives 0; NULL stays NULL.  ANSI ``cast``
    would raise on ``'12 '`` or ``'abc'``, so the digits are extracted first.
    A number beyond the type gives its largest value: 2^63 - 1, or with
    ``wide`` (decimal(20,0)) the largest unsigned 64-bit number, 2^64 - 1.
    """
    col = _c(c).cast("string")
    digits = F.regexp_extract(col, r"^\s*([0-9]+)", 1)
    kind, largest = ("decimal(20,0)", 2 ** 64 - 1) if wide else ("bigint", 2 ** 63 - 1)
    top = F.lit(str(largest)).cast(kind)
    value = F.coalesce(digits.try_cast(kind), top)
    return (F.when(col.isNull(), F.lit(None).cast(kind)).when(digits == "", F.lit(0).cast(kind))
            .otherwise(F.least(value, top)))


def date_key(c: ColumnOrName) -> Column:
    """Date as ``yyyyMMdd`` text (F-05)."""
    return F.date_format(_c(c), "yyyyMMdd")


# --- names ----------------------------------------------------------------

def full_name(first: ColumnOrName, last: ColumnOrName) -> Column:
    """``first last``; NULL when either part is NULL (F-07)."""
    return F.concat(_c(first), F.lit(" "), _c(last))


def last_first(last: ColumnOrName, first: ColumnOrName) -> Column:
    """``last, first`` (F-08)."""
    return F.concat(_c(last), F.lit(", "), _c(first))


def last_initial(last: ColumnOrName, first: ColumnOrName) -> Column:
    """``last F`` (F-09)."""
    return F.concat(_c(last), F.lit(" "), initial(first))


def name_collapse(first: ColumnOrName, middle: ColumnOrName, last: ColumnOrName) -> Column:
    """Null-safe ``first middle last`` with one pass of double-space collapse (F-10)."""
    joined = F.concat(F.coalesce(_c(first), F.lit("")), F.lit(" "),
                      F.coalesce(_c(middle), F.lit("")), F.lit(" "),
                      F.coalesce(_c(last), F.lit("")))
    return F.replace(joined, F.lit("  "), F.lit(" "))


def name_upper(last: ColumnOrName, first: ColumnOrName, middle: ColumnOrName) -> Column:
    """``LAST, FIRST M.`` in upper case; the middle part only when non-empty (F-11)."""
    mid = F.when(F.length(_c(middle)) > 0, F.concat(_c(middle), F.lit("."))).otherwise(F.lit(""))
    joined = F.concat(F.coalesce(_c(last), F.lit("")), F.lit(", "),
                      F.coalesce(_c(first), F.lit("")), F.lit(" "), mid)
    return F.upper(F.replace(joined, F.lit("  "), F.lit(" ")))


def cycle_label(cycle: ColumnOrName, day: ColumnOrName, delayed: ColumnOrName) -> Column:
    """``C<n> / D<d> Delayed`` with zero parts left out (F-12).

    A NULL cycle or day makes the label NULL; a NULL delay flag counts as
    delayed (the condition is unknown, so the ELSE branch is taken).
    """
    c_part = F.when(_c(cycle) == 0, F.lit("")).otherwise(
        F.concat(F.lit("C"), _c(cycle).cast("string"), F.lit(" / ")))
    d_part = F.when(_c(day) == 0, F.lit("")).otherwise(
        F.concat(F.lit("D"), _c(day).cast("string")))
    l_part = F.when(_c(delayed) == 0, F.lit("")).otherwise(F.lit(" Delayed"))
    return F.trim(F.concat(c_part, d_part, l_part))


# --- CASE shapes ----------------------------------------------------------

def flag(c: ColumnOrName, value=1) -> Column:
    """``'Y'`` when the column equals ``value``, else (also NULL) ``'N'`` (F-19)."""
    return F.when(_c(c) == F.lit(value), F.lit("Y")).otherwise(F.lit("N"))


def label(cond: Column, yes: str, no: str) -> Column:
    """Two-way label; a NULL condition gives ``no`` (F-20)."""
    return F.when(cond, F.lit(yes)).otherwise(F.lit(no))


def code_map(c: ColumnOrName, mapping: Mapping, default: str | None = "") -> Column:
    """Map codes to labels; unmapped (and NULL) codes give ``default`` (F-21/F-22)."""
    expr = None
    for k, v in mapping.items():
        expr = (F.when(_c(c) == F.lit(k), F.lit(v)) if expr is None
                else expr.when(_c(c) == F.lit(k), F.lit(v)))
    if default is not None:
        expr = expr.otherwise(F.lit(default))
    return expr


def fallback(primary: ColumnOrName, other: ColumnOrName, other_marker: str = "Other") -> Column:
    """Dropdown value unless it is ``'Other'`` or NULL, then the free text (F-24)."""
    p = _c(primary)
    return F.when(p.isNull() | (p == F.lit(other_marker)), _c(other)).otherwise(p)


# --- predicates -----------------------------------------------------------

def not_blank(c: ColumnOrName) -> Column:
    """True for text that is neither NULL, empty nor only spaces (FLT-03)."""
    return F.rtrim(_c(c)) != F.lit("")


def is_signed_integer(c: ColumnOrName) -> Column:
    """Whole text is an optionally signed integer (FLT-07)."""
    return _c(c).rlike(r"^-?[0-9]+$")


def on_or_after(c: ColumnOrName, day: str) -> Column:
    """``c >= date(day)`` compared at midnight, type kept (FLT-06)."""
    return _c(c) >= F.to_timestamp_ntz(F.lit(day + " 00:00:00"))


# --- run stamp ------------------------------------------------------------

def run_stamp(run_ts: _dt.datetime | str | None = None) -> Column:
    """One job-level run timestamp (F-17), seconds precision.

    Taken once on the driver so every mart row of a run carries the same
    value; pass a fixed value for reproducible output.
    """
    if run_ts is None:
        run_ts = _dt.datetime.now().replace(microsecond=0)
    if isinstance(run_ts, str):
        run_ts = _dt.datetime.fromisoformat(run_ts)
    return F.lit(run_ts).cast("timestamp_ntz")


def study_category(kind: Column, study_type: Column, interventional: Sequence, treatment: str) -> Column:
    """Interventional treatment / other interventional / non-interventional; '' without a kind (F-23)."""
    inside = kind.isin(list(interventional))
    return (F.when(inside & (study_type == treatment), F.lit("Interventional Treatment"))
            .when(inside & (study_type != treatment), F.lit("Interventional Non-Treatment"))
            .when(~inside, F.lit("Non-Interventional"))
            .when(kind.isNull(), F.lit("")))
