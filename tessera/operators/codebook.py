"""Codebook merge.

Every book is one row, questions are exploded in parallel, and duplicates are
found with one grouped count; a merge that fails leaves a report of all of them.
"""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.variant import json_items
from ..session import scratch_path


def questions(books: DataFrame) -> DataFrame:
    """F9 + F10 + P5: (name, codebook, question) rows from (codebook, doc).
    A book without ``questions`` contributes no rows; a question without a
    ``name`` fails the job."""
    q = books.select("codebook", F.explode(json_items(F.col("doc"), "$.questions")).alias("question"))
    name = F.try_variant_get("question", "$.name", "string")
    return q.select(
        F.when(name.isNull(), F.raise_error(F.concat(F.col("codebook"),
                                                     F.lit(": a question has no name"))))
         .otherwise(name).alias("name"),
        "codebook", "question")


def duplicate_names(items: DataFrame, name_col: str = "name", book_col: str = "codebook") -> DataFrame:
    """A2: names that occur more than once, with their count and the sorted,
    distinct list of books they occur in.

    Rows are reduced to (name, book, count) map-side first; the per-name list
    then holds at most one entry per book, so its size is bounded by the
    number of books, not by the number of rows.
    """
    per_book = items.groupBy(F.col(name_col).alias("name"), F.col(book_col).alias("book")) \
                    .agg(F.count(F.lit(1)).alias("c"))
    return (per_book.groupBy("name")
                    .agg(F.sum("c").alias("n"),
                         F.array_join(F.array_sort(F.collect_list("book")), ",").alias("books"))
                    .where("n > 1"))


class RepeatedNames(ValueError):
    """Question names that occur more than once: ``total`` of them, a row each
    (name, n, books) at ``path``."""

    def __init__(self, total: int, path: str):
        self.total, self.path = total, path
        super().__init__(f"question names used more than once: {total} (report: {path})")


def merge(books: DataFrame, report_path: str | None = None) -> DataFrame:
    """A3: all questions of all books keyed by name, tagged with their book.
    Names that repeat are an error; they are written as a report
    (``duplicate_names``) under ``report_path``, by default in the shared
    folder, and only their number reaches the driver."""
    items = questions(books)
    path = report_path or scratch_path(books.sparkSession, "repeated-names")
    seen = Observation(f"repeated_{uuid.uuid4().hex[:8]}")
    duplicate_names(items).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(path)
    if seen.get["n"]:
        raise RepeatedNames(seen.get["n"], path)
    return items


def unregistered(items: DataFrame, local_concept: DataFrame) -> DataFrame:
    """Question names with no ``local_concept.source_field_name``."""
    known = local_concept.select(F.col("source_field_name").alias("name")).where("name IS NOT NULL")
    return items.join(known, "name", "left_anti")
