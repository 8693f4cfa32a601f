"""Semi-structured access on VARIANT values (F9, F10), and their canonical text."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def json_items(v: Column, path: str) -> Column:
    """the array at ``path`` as ``array<variant>``; a missing key gives an
    empty array (no rows after explode), like ``doc.get(key, [])``."""
    return F.coalesce(F.try_variant_get(v, path, "array<variant>"),
                      F.array().cast("array<variant>"))


def json_field(v: Column, path: str, type_: str = "string", required: bool = False) -> Column:
    """typed field access; ``required`` makes a missing field an error."""
    got = F.variant_get(v, path, type_)
    if not required:
        return got
    return F.when(got.isNull(), F.raise_error(F.lit(f"missing required field {path}"))).otherwise(got)


#: stand-ins for an escaped backslash and an escaped quote, which JSON text cannot hold unescaped
_BACKSLASH, _QUOTE = "\u0001", "\u0002"


def canonical_json(v: Column, is_text: bool = True) -> Column:
    """One text for all spellings of a JSON value: keys sorted, no blanks,
    escapes as ``to_json`` writes them, and numbers without trailing zeros
    (``1``, ``1.0``, ``1e0`` and ``-0.0`` as ``1`` and ``0``; numbers that need
    an exponent keep it).  ``v`` is text or, with ``is_text`` false, VARIANT.
    Text that is no JSON, or has an object with a repeated key, becomes a JSON
    string of itself; NULL stays NULL."""
    parsed = F.try_parse_json(v) if is_text else v
    text = F.to_json(parsed)
    plain = F.replace(F.replace(text, F.lit("\\\\"), F.lit(_BACKSLASH)), F.lit('\\"'), F.lit(_QUOTE))
    # a string, kept as it is, or the zeros of a whole number written as a double
    plain = F.regexp_replace(plain, r'("[^"]*+")|(?<=[0-9])\.0(?![0-9eE])', "$1")
    text = F.replace(F.replace(plain, F.lit(_QUOTE), F.lit('\\"')), F.lit(_BACKSLASH), F.lit("\\\\"))
    if not is_text:
        return text
    return F.when(v.isNull(), F.lit(None)).when(parsed.isNull(), F.to_json(v.cast("variant"))).otherwise(text)
