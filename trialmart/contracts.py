"""Declared table contracts: column names and types, checked when a table is read or published."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType


_TYPES = {"bigint": "long", "int": "integer"}


def declared(columns: str) -> StructType:
    """Schema from ``name type, name type, ...`` (simple types only; needs no session)."""
    out = StructType()
    for column in columns.split(","):
        name, kind = column.split()
        out = out.add(name, _TYPES.get(kind, kind))
    return out


def conform(df: DataFrame, contract: StructType, name: str) -> DataFrame:
    """The contract's columns by name, in its order; raise if one is missing or has another type.

    Names are compared without case, further columns are left out, and
    nullability is not part of a contract.
    """
    shape = lambda schema: [(f.name, f.dataType.simpleString()) for f in schema]
    if shape(df.schema) == shape(contract):
        return df
    have = {f.name.lower(): f for f in df.schema}
    missing = [f.name for f in contract if f.name.lower() not in have]
    if missing:
        raise ValueError(f"{name}: columns {missing} are missing")
    other = {f.name: (have[f.name.lower()].dataType.simpleString(), f.dataType.simpleString()) for f in contract
             if have[f.name.lower()].dataType.simpleString() != f.dataType.simpleString()}
    if other:
        raise ValueError(f"{name}: types differ from the contract (found, declared): {other}")
    return df.select(*[df[have[f.name.lower()].name].alias(f.name) for f in contract])
