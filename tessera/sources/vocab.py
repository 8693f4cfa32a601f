"""Vocabulary file scan (S1-S3, typed by F6).

The vocabulary export is tab-delimited text with a header, UTF-8, and uses
backspace as its quote character so embedded ``"`` survive.  Columns bind by
header name (lower-cased), not by position; columns missing from a file take
their default or NULL; an unknown header is an error.  Malformed rows (too
many or too few fields) fail the load.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contracts import VOCAB_FILES, TableContract, contract
from ..functions.coerce import copy_cast, strict
from ..operators.columns import fill_defaults
from . import fs

_CORRUPT = "_corrupt_record"


def check_manifest(spark: SparkSession, folder: str, files=VOCAB_FILES) -> None:
    """S3: every expected file must exist; one error lists all missing names."""
    missing = [name for name, _ in files if not fs.exists(spark, f"{folder.rstrip('/')}/{name}")]
    if missing:
        raise FileNotFoundError(f"{folder} lacks {len(missing)} of {len(files)} vocabulary files: {', '.join(missing)}")


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Header names of a delimited file, lower-cased (one small read)."""
    first = (spark.read.option("lineSep", "\n").text(path).limit(1).collect())
    if not first:
        return []
    line = first[0][0].rstrip("\r")
    return [c.lower() for c in line.split("\t")]


def scan_raw(spark: SparkSession, path: str, header: list[str]) -> DataFrame:
    """All-string scan with the vocabulary dialect.  A row whose field
    count differs from the header lands in ``_corrupt_record``."""
    schema = ", ".join(f"`c{i}` string" for i in range(len(header))) + f", `{_CORRUPT}` string"
    df = (spark.read
          .option("sep", "\t")
          .option("quote", "\b")
          .option("escape", "\b")
          .option("header", "true")
          .option("encoding", "UTF-8")
          .option("ignoreLeadingWhiteSpace", "false")
          .option("ignoreTrailingWhiteSpace", "false")
          .option("nullValue", "")
          .option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", _CORRUPT)
          .option("columnPruning", "false")  # a row's width counts whatever columns are asked for
          .option("enforceSchema", "true")
          .schema(schema)
          .csv(path))
    return df.toDF(*header, _CORRUPT)


def bind(df: DataFrame, header: list[str], target: TableContract, strict_mode: bool = True) -> DataFrame:
    """S2 + F6: bind by name, type every column, fail on bad cells or rows."""
    known = set(target.column_names)
    unknown = [h for h in header if h not in known]
    if unknown:
        raise ValueError(f"{target.name}: columns not in table: {unknown}")
    dupes = sorted({h for h in header if header.count(h) > 1})
    if dupes:
        raise ValueError(f"{target.name}: repeated columns: {dupes}")
    row_ok = F.col(_CORRUPT).isNull()
    bad_row = F.concat(F.lit(f"{target.name}: malformed row (first 80 characters): "), F.substring(F.col(_CORRUPT), 1, 80))
    cols = []
    for spec in target.columns:
        if spec.name not in header:
            continue
        value, error = copy_cast(F.col(f"`{spec.name}`"), spec)
        if not spec.nullable:
            error = F.coalesce(error, F.when(value.isNull(), F.lit(
                f"{target.name}.{spec.name}: NULL in NOT NULL column")))
        error = F.when(~row_ok, bad_row).otherwise(error)
        cols.append((strict(value, error) if strict_mode else value).alias(spec.name))
    typed = df.select(*cols)
    return fill_defaults(typed, target)


def read_vocab_file(spark: SparkSession, path: str, target: TableContract,
                    strict_mode: bool = True) -> DataFrame:
    header = read_header(spark, path)
    if not header:
        return spark.createDataFrame([], target.spark_schema)
    return bind(scan_raw(spark, path, header), header, target, strict_mode)


def read_vocabulary(spark: SparkSession, folder: str, layer: str = "bronze",
                    strict_mode: bool = True) -> dict[str, DataFrame]:
    """All nine vocabulary tables as typed, lazily evaluated DataFrames."""
    check_manifest(spark, folder)
    out = {}
    for filename, table in VOCAB_FILES:
        out[table] = read_vocab_file(spark, f"{folder.rstrip('/')}/{filename}",
                                     contract(table, "shared", layer), strict_mode)
    return out
