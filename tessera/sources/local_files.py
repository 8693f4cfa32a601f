"""Local-concept style files: delimited text with NULL tokens, or any typed
frame (the spreadsheet path) turned into text first (S4-S6)."""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.coerce import NULL_TOKENS, null_tokens
from . import fs


_CORRUPT = "_corrupt_record"


def _quotes(line: Column) -> Column:
    return F.char_length(line) - F.char_length(F.replace(line, F.lit('"'), F.lit("")))


def _spans_lines(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field goes on over a line end.  Within a file quotes
    come in pairs; a file with an odd number has an unclosed one, which is an
    error.  One pass over the lines, added up per file."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), (_quotes(F.col("value")) % 2).alias("odd"))
    files = lines.groupBy("file").agg(F.sum("odd").alias("odd"))
    open_, some, spans = files.agg(F.count_if(F.col("odd") % 2 == 1), F.min(F.when(F.col("odd") % 2 == 1, F.col("file"))),
                                   F.coalesce(F.max("odd") > 0, F.lit(False))).first()
    if open_:
        raise ValueError(f"{open_} of the files at {path} have an unclosed quote, {some} among them")
    return spans


def read_delimited(spark: SparkSession, path: str, tokens=NULL_TOKENS, sep: str = ",") -> DataFrame:
    """Every column text; the NULL tokens become NULL (exact match).  Rows
    with too few fields are filled with NULLs; a row with more fields than the
    header, and a quote that is never closed, are errors.

    Files are split among tasks unless a quoted field spans lines."""
    spans = _spans_lines(spark, path)
    reader = (spark.read
              .option("header", "true")
              .option("sep", sep)
              .option("inferSchema", "false")
              .option("quote", '"')
              .option("escape", '"')  # RFC 4180: a quote inside quotes is doubled
              .option("multiLine", str(spans).lower())
              .option("ignoreLeadingWhiteSpace", "false")
              .option("ignoreTrailingWhiteSpace", "false")
              .option("nullValue", "\u0000never\u0000")
              .option("emptyValue", ""))
    names = reader.csv(path).columns
    kind = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField(_CORRUPT, T.StringType())])
    # without pruning, which would only look at the fields that are asked for
    raw = (reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", _CORRUPT).option("columnPruning", "false")
           .schema(kind).csv(path))
    # a record that is not as wide as the header: its fields are the separators outside of quotes, and one
    s = re.escape(sep)
    bare = F.regexp_replace(_CORRUPT, f'(^|{s})"[^"]*+(?:""[^"]*+)*+"', "$1")
    long = F.char_length(F.regexp_replace(bare, f"[^{s}]", "")) + 1 > len(names)
    stop = F.raise_error(F.concat(F.lit(f"{path}: a row has more fields than the header ({len(names)}): "), F.substring(_CORRUPT, 1, 80)))
    # one check a row, whatever columns are asked for
    fields = F.struct(*[null_tokens(F.col(f"c{i}"), tokens).alias(f"c{i}") for i in range(len(names))])
    return raw.select(F.when(F.coalesce(long, F.lit(False)), stop).otherwise(fields).alias("f")).select(
        *[F.col(f"f.c{i}").alias(c) for i, c in enumerate(names)])


def from_typed(df: DataFrame) -> DataFrame:
    """A typed frame (e.g. parsed from a spreadsheet) cast to text.  The
    NULL tokens are not applied on this path."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def read_input(spark: SparkSession, path: str, typed: DataFrame | None = None) -> DataFrame:
    """Dispatch on the file suffix; a missing file or other suffix raises.
    Spreadsheet bytes are not parsed here: pass the parsed frame as ``typed``."""
    suffix = path.rsplit(".", 1)[-1].lower() if "." in path else ""
    if typed is not None:
        return from_typed(typed)
    if not fs.exists(spark, path):
        raise FileNotFoundError(f"no input at {path}")
    if suffix == "csv":
        return read_delimited(spark, path)
    if suffix in ("xlsx", "xls"):
        raise ValueError("spreadsheet input: parse it to a DataFrame and pass it as `typed`")
    raise ValueError(f"{path}: neither delimited text (csv) nor a spreadsheet (xlsx, xls)")
