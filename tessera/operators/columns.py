"""Column-level projections.

These run on ``df.columns`` (driver-side metadata) and produce one Catalyst
projection; no data passes through the driver.
"""
from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contracts import ColumnSpec, TableContract

log = logging.getLogger(__name__)


def normalize_names(df: DataFrame) -> DataFrame:
    """Trim and lower-case column names; a clash after that is an error."""
    new = [c.strip().lower() for c in df.columns]
    clash = sorted({c for c in new if new.count(c) > 1})
    if clash:
        raise ValueError(f"Columns clash after normalising names: {clash}")
    return df.toDF(*new)


def known_columns(df: DataFrame, target: TableContract) -> list[str]:
    """Contract columns present in the input, alphabetical.  Others are
    logged and left out; an input without any contract column is an error."""
    load = sorted(c for c in target.column_names if c in df.columns)
    if not load:
        raise ValueError(f"none of {df.columns} is a column of {target.name} ({', '.join(target.column_names)})")
    if extra := [c for c in df.columns if c not in load]:
        log.warning("%s: input columns without a place in the table: %s", target.name, ", ".join(extra))
    return load


def require_columns(columns, required, why: str = "") -> None:
    """Required key columns must be present."""
    missing = [c for c in required if c not in columns]
    if missing:
        raise ValueError(f"missing required column(s) {missing}{': ' + why if why else ''}")


def is_empty(df: DataFrame) -> bool:
    """Stops after the first row is found."""
    return df.isEmpty()


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """P5: tag rows with their source."""
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))


def default_value(spec: ColumnSpec) -> Column:
    if spec.default == "true":
        v = F.lit(True)
    elif spec.default == "now":
        v = F.localtimestamp()
    elif spec.default == "0":
        v = F.lit(0)
    elif spec.default == "{}":
        v = F.parse_json(F.lit("{}"))
    else:
        v = F.lit(None)
    return v.cast(spec.spark_type)


def fill_defaults(df: DataFrame, target: TableContract) -> DataFrame:
    """Columns the input lacks take their declared default (or NULL), and
    the result has the contract's column order and types."""
    have = set(df.columns)
    return df.select(*[
        (F.col(f"`{c.name}`").cast(c.spark_type) if c.name in have else default_value(c)).alias(c.name)
        for c in target.columns])


def conform(df: DataFrame, target: TableContract) -> DataFrame:
    """Select the contract columns of an already typed frame in contract order."""
    return fill_defaults(df.select(*[f"`{c}`" for c in df.columns if c in set(target.column_names)]),
                         target)
