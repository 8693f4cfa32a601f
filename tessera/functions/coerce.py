"""Typed coercion of text cells as Column expressions (F1-F8).

Every coercer returns ``(value, error)``: the typed value, and a message that
is NULL when the cell is fine.  Loaders decide whether an error fails the job
(``strict``) or becomes a violation row.  All of it is JVM-side Catalyst
expressions, so it stays inside whole-stage codegen.

Two dialects exist because the reference types text in two places:

* ``python`` - the local-concept loader: blank -> NULL, then per-type
  coercers that mirror Python's ``int(float(s.strip()))`` and a fixed
  true/false token table.
* ``copy`` - the vocabulary bulk load, typed by the database on COPY: ANSI
  casts, two date spellings, VARCHAR length limits.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..contracts import ColumnSpec

# Tokens of the reference's boolean coercer (after strip + lower).
TRUE_TOKENS = ["true", "1", "yes", "t"]
FALSE_TOKENS = ["false", "0", "no", "f"]

# Cells read as NULL from delimited local-concept files.
NULL_TOKENS = ["", "NULL", "null", "None"]

_INT_RANGES = {f"{t}": (-(1 << b - 1), (1 << b - 1) - 1) for t, b in (("tinyint", 8), ("smallint", 16), ("int", 32), ("bigint", 64))}

# Characters Python's str.strip() removes: exactly those with str.isspace().
_PY_SPACE = "".join(chr(i) for i in range(0x110000) if chr(i).isspace())
# What float() accepts, minus inf/nan: sign, digits with single underscores
# between them, optional fraction, optional exponent, at least one digit.
_PY_FLOAT = r"^[+-]?(?=[.]?[0-9])([0-9](_?[0-9])*)?([.]([0-9](_?[0-9])*)?)?([eE][+-]?[0-9](_?[0-9])*)?$"


def py_strip(c: Column) -> Column:
    """``str.strip()``: a character-set trim, no regular expression."""
    return F.btrim(c, F.lit(_PY_SPACE))


def empty_to_null(c: Column) -> Column:
    """``None`` or ``''`` become NULL; whitespace-only text is kept."""
    return F.nullif(c, F.lit(""))


def null_tokens(c: Column, tokens=NULL_TOKENS) -> Column:
    """exact-match NULL tokens, untrimmed."""
    return F.when(c.isin(*tokens), F.lit(None).cast("string")).otherwise(c)


def _err(cond: Column, raw: Column, target: str) -> Column:
    return F.when(cond, F.concat(F.lit(f"not a valid {target}: "), F.coalesce(raw, F.lit("NULL"))))


def to_bool(c: Column) -> tuple[Column, Column]:
    """strip + lower, then the fixed token table; anything else is an error."""
    s = F.lower(py_strip(c))
    value = (F.when(s.isin(*TRUE_TOKENS), F.lit(True))
              .when(s.isin(*FALSE_TOKENS), F.lit(False)))
    return value, _err(c.isNotNull() & value.isNull(), c, "bool")


def to_int(c: Column, spark_type: str = "int") -> tuple[Column, Column]:
    """``int(float(s.strip()))`` - truncates toward zero, accepts exponents
    and digit underscores, rejects inf/nan and Java's ``1d``/``1f`` suffixes.
    Values outside the target type are errors like any other."""
    s = py_strip(c)
    # Cheap screen first: only characters a decimal float literal can hold
    # (this rules out Java's d/f suffixes, hex, Infinity and NaN), then the
    # cast itself.  The underscore placement rule needs the full pattern,
    # which only runs for the rare values that contain one.
    plain = F.translate(s, "0123456789eE.+-_", "") == F.lit("")
    has_us = s.contains("_")
    digits = F.when(has_us, F.replace(s, F.lit("_"), F.lit(""))).otherwise(s)
    as_double = digits.try_cast("double")
    ok = plain & as_double.isNotNull() & F.when(has_us, s.rlike(_PY_FLOAT)).otherwise(F.lit(True))
    low, high = _INT_RANGES[spark_type]
    fits = (as_double > F.lit(float(low) - 1)) & (as_double < F.lit(float(high) + 1)) if spark_type != "bigint" else \
        (as_double >= F.lit(float(low))) & (as_double < F.lit(float(high) + 1))
    ok = F.coalesce(ok & fits, F.lit(False))
    value = F.when(ok, as_double.try_cast(spark_type))
    return value, _err(c.isNotNull() & ~ok, c, "int")


def to_json_value(c: Column) -> tuple[Column, Column]:
    """F5 for JSON columns: valid JSON text is parsed, other text is kept as a
    JSON string scalar, NULL stays NULL."""
    parsed = F.try_parse_json(c)
    scalar = F.variant_get(F.parse_json(F.to_json(F.array(c))), "$[0]", "variant")
    value = F.when(c.isNull(), F.lit(None)).otherwise(F.coalesce(parsed, scalar))
    return value, F.lit(None).cast("string")


def copy_cast(c: Column, spec: ColumnSpec) -> tuple[Column, Column]:
    """the database's typing of COPY text.

    Dates take ``yyyyMMdd`` and ISO; integers and numerics take surrounding
    blanks; VARCHAR(n) rejects longer text unless the excess is spaces, which
    is cut.  Each failure yields an error message, never a silent NULL.
    """
    kind = spec.kind
    if kind == "date":
        s = F.trim(c)
        value = F.coalesce(
            F.when(s.rlike(r"^[0-9]{8}$"), F.try_to_timestamp(s, F.lit("yyyyMMdd")).cast("date")),
            F.when(s.rlike(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"), s.try_cast("date")))  # the cast alone takes 1970 or trailing text
        return value, _err(c.isNotNull() & value.isNull(), c, "date")
    if kind == "vc":
        n = spec.length
        too_long = F.length(F.rtrim(c)) > n
        value = F.when(F.length(c) > n, F.substring(c, 1, n)).otherwise(c)
        return value, F.when(too_long, F.concat(F.lit(f"over {n} characters (first 40): "),
                                                 F.substring(c, 1, 40)))
    if kind == "text":
        return c, F.lit(None).cast("string")
    if kind == "json":
        return to_json_value(c)
    if kind == "bool":
        # Postgres boolean input: t/f/true/false/yes/no/on/off/1/0 and prefixes.
        s = F.lower(F.trim(c))
        value = (F.when(s.isin("t", "true", "y", "yes", "on", "1", "tr", "tru", "ye"), F.lit(True))
                  .when(s.isin("f", "false", "n", "no", "off", "0", "fa", "fal", "fals", "of"),
                        F.lit(False)))
        return value, _err(c.isNotNull() & value.isNull(), c, "bool")
    target = spec.spark_type.simpleString()
    value = F.trim(c).try_cast(target)
    return value, _err(c.isNotNull() & value.isNull(), c, target)


def python_cast(c: Column, spec: ColumnSpec) -> tuple[Column, Column]:
    """The local-concept loader's per-column coercion (F3 then F1/F2/F5)."""
    c = empty_to_null(c)
    if spec.kind == "bool":
        return to_bool(c)
    if spec.is_integral:
        return to_int(c, spec.spark_type.simpleString())
    if spec.kind == "json":
        return to_json_value(c)
    if spec.kind in ("text", "vc"):
        return c, F.lit(None).cast("string")
    # Other types reach the database as text and are typed there.
    return copy_cast(c, spec)


def strict(value: Column, error: Column) -> Column:
    """Fail the task with the message when the cell is bad."""
    return F.when(error.isNotNull(), F.raise_error(error)).otherwise(value)


def now() -> Column:
    """zone-less current timestamp (``NOW()`` on a timestamp column)."""
    return F.localtimestamp()


def today() -> Column:
    """F8: current date."""
    return F.current_date()
