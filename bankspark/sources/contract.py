"""Schema contracts at the scan (A4).

A table is read with its declared schema, and only after the schema that its files state has been held against it: a missing or
retyped column raises before any row is read, instead of turning into NULLs; columns beyond the contract are named in a
warning and not read.
"""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


class ContractError(ValueError):
    """The columns of a table are not those that were declared."""


def differences(found: StructType, declared: StructType, optional: tuple[str, ...] = ()) -> tuple[list[str], list[str]]:
    """(faults, names of further columns); names are compared as Spark resolves them, without case."""
    have = {f.name.lower(): f for f in found.fields}
    faults = []
    for f in declared.fields:
        own = have.pop(f.name.lower(), None)
        if own is None:
            if f.name not in optional:
                faults.append(f"{f.name} is missing")
        elif own.dataType != f.dataType:
            faults.append(f"{f.name} is {own.dataType.simpleString()}, not {f.dataType.simpleString()}")
    return faults, [f.name for f in have.values()]


def _held(found: StructType, declared: StructType, optional: tuple[str, ...], what: str) -> None:
    faults, more = differences(found, declared, optional)
    if faults:
        raise ContractError(f"{what}: " + "; ".join(faults))
    if more:
        warnings.warn(f"{what}: columns beyond the contract: {', '.join(more)}", stacklevel=3)


def scan(spark: SparkSession, path: str, declared: StructType, optional: tuple[str, ...] = ()) -> DataFrame:
    """The table at ``path`` under its contract; optional columns that it lacks are NULL."""
    _held(spark.read.parquet(path).schema, declared, optional, path)
    return spark.read.schema(declared).parquet(path).select(declared.names)


def conform(df: DataFrame, declared: StructType, optional: tuple[str, ...] = (), what: str = "table") -> DataFrame:
    """The declared columns of a frame, after the same checks; optional columns that it lacks stay out."""
    _held(df.schema, declared, optional, what)
    have = {c.lower() for c in df.columns}
    return df.select([n for n in declared.names if n.lower() in have])
