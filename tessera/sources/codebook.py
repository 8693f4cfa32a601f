"""Codebook documents (S7): one JSON file per book, read in one distributed
scan; each file becomes one VARIANT document tagged with its book name."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fs

# The codebooks the reference merges, in its order.
CODEBOOKS = ["Clinical", "BBC", "AFT", "AUDIO", "COGNITO", "APOE", "GAIT", "MRI", "OCT",
             "Socio", "SPIRO", "Balance", "Alamar", "Simoa"]


def codebook_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/Codebook_{name}.json"


def read_codebooks(spark: SparkSession, folder: str, names=CODEBOOKS) -> DataFrame:
    """Returns (codebook string, doc variant).  A missing file raises before
    any read; malformed JSON raises when the documents are evaluated."""
    missing = [n for n in names if not fs.exists(spark, codebook_path(folder, n))]
    if missing:
        raise FileNotFoundError(f"{folder} has no codebook file for: {', '.join(missing)}")
    paths = [codebook_path(folder, n) for n in names]
    raw = spark.read.text(paths, wholetext=True)
    # the name is in the file's path: a book may be a folder of part files
    book = F.regexp_extract(F.col("_metadata.file_path"), r"/Codebook_([^/]*)\.json(/[^/]*)?$", 1)
    doc = F.when(F.try_parse_json("value").isNull(),
                 F.raise_error(F.concat(book, F.lit(": the codebook file is not JSON"))))\
        .otherwise(F.parse_json("value"))
    return raw.select(book.alias("codebook"), doc.alias("doc"))
