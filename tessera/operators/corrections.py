"""Value ranges and corrections by field.

A red row says that one field of one record holds a value outside its range:
the record's key, ``field_name``, ``original_value`` and ``original_error``,
and, once somebody has looked at it, ``new_value``, ``new_error`` and
``status``.  Values are text, as a red table holds those of any field.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import navigate


def _q(c: str):
    return F.col(f"`{c}`")


def field_ranges(registry: DataFrame, field: str = "source_field_name", rule: str = "source_field_range") -> DataFrame:
    """(field_name, low, high) from a registry's JSON rules such as
    ``{"min": 0, "max": 10}`` (VARIANT or text); a missing bound is NULL, and a
    rule that is no object, or a bound that is no number, is an error."""
    value = _q(rule) if dict(registry.dtypes)[rule] == "variant" else F.parse_json(rule)
    rules = registry.where(_q(field).isNotNull() & _q(rule).isNotNull()).select(_q(field).alias("field_name"), value.alias("_rule"))
    whole = F.when(F.schema_of_variant("_rule").startswith("OBJECT"), F.col("_rule")).otherwise(
        F.raise_error(F.concat(F.lit("range rule of "), F.col("field_name"), F.lit(" is no object: "), F.to_json("_rule"))))
    return rules.select("field_name", F.variant_get(whole, "$.min", "double").alias("low"),
                        F.variant_get(whole, "$.max", "double").alias("high"))


def red_rows(df: DataFrame, keys, fields, ranges: DataFrame) -> DataFrame:
    """The red rows of a table: one per record and field whose value lies
    outside the field's range (bounds belong to it).  The rules are a join on
    the field's name, not code; fields without a rule have no red rows."""
    keys, fields = list(keys), list(fields)
    long = df.select(*[_q(k) for k in keys], *[_q(c).cast("string").alias(c) for c in fields]).unpivot(
        keys, fields, "field_name", "original_value")
    ruled = navigate.many_to_one(long.where("original_value IS NOT NULL"), ranges, "field_name", "field_name", ["low", "high"])
    value = F.col("original_value").cast("double")
    error = F.when(value < F.col("low"), F.concat(F.lit("below "), F.col("low").cast("string"))) \
        .when(value > F.col("high"), F.concat(F.lit("above "), F.col("high").cast("string")))
    return ruled.withColumn("original_error", error).where("original_error IS NOT NULL").select(
        *[_q(k) for k in keys], "field_name", "original_value", "original_error")


def overlay_fields(df: DataFrame, red: DataFrame, keys, fields, statuses=None, stamp: str | None = None,
                   error_suffix: str = "_error", status_suffix: str = "_status") -> DataFrame:
    """``df`` with corrections applied field by field.

    Where a record has a red row for a field, the field becomes ``new_value``,
    or ``original_value`` where there is none; ``<field>_error`` is the error
    that still stands (``new_error`` of a corrected value, ``original_error``
    of any other) and ``<field>_status`` the row's status.  Only rows whose
    status is in ``statuses`` (default: any) are applied.  Of several red rows
    for a field the one with the greatest ``stamp`` column counts, else the
    one with the greatest status.  A red row for a field that the table lacks,
    and a value that does not fit the field's type, are errors.

    The red rows of a record become one row with an entry per field before
    they meet the table, so the table is joined once, on its key.
    """
    keys, fields, types = list(keys), list(fields), dict(df.dtypes)
    have = set(red.columns)
    status = F.col("status") if "status" in have else F.lit(None).cast("int")
    entry = F.struct(F.coalesce("new_value", "original_value").alias("value"),
                     F.when(F.col("new_value").isNotNull(), F.col("new_error") if "new_error" in have else F.lit(None).cast("string"))
                     .otherwise(F.col("original_error") if "original_error" in have else F.lit(None).cast("string")).alias("error"),
                     status.alias("status"))
    fixes = red if statuses is None else red.where(status.isin(*statuses))
    field = F.coalesce("field_name", F.lit("NULL"))
    last = F.struct(_q(stamp) if stamp else F.lit(0), status, entry)
    per_record = fixes.groupBy(*[_q(k) for k in keys]).agg(*[
        F.max_by(F.when(field == f, entry), F.when(field == f, last)).alias(f"__fix_{f}") for f in fields],
        F.max(F.when(~field.isin(*df.columns), field)).alias("__fix"))
    out = navigate.many_to_one(df, per_record, keys, keys, [*[f"__fix_{f}" for f in fields], "__fix"])
    # raised where a value is shown: as a filter it could be moved to rows that are no corrections
    unknown = F.raise_error(F.concat(F.lit("correction of an unknown field: "), "__fix"))
    for f in fields:
        fix = F.col(f"`__fix_{f}`")
        out = (out.withColumn(f, F.when(F.col("__fix").isNotNull(), unknown).when(fix.isNotNull(), fix["value"].cast(types[f])).otherwise(_q(f)))
               .withColumn(f + error_suffix, fix["error"]).withColumn(f + status_suffix, fix["status"]))
    return out.drop("__fix", *[f"__fix_{f}" for f in fields])


def unknown_fields(red: DataFrame, tables: dict[str, list[str]], table_col: str = "table") -> DataFrame:
    """Red rows whose field is no column of the table they name."""
    known = reduce(lambda a, b: a | b, [(_q(table_col) == t) & F.col("field_name").isin(*cols) for t, cols in tables.items()], F.lit(False))
    return red.where(~F.coalesce(known, F.lit(False)))
