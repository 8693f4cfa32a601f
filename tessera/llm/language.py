"""Language identification: words first, then shorter and shorter n-grams.

A word that the model knows gets its log frequency in every language.  One
that it does not know is padded with spaces and read as character n-grams of
the greatest size of which at least one is known, and gets their mean.  A text
gets the mean over its words; the language with the highest mean is predicted.

The model is fitted on a sample of labelled rows that is bounded in bytes per
language, and holds a bounded number of words and n-grams per language, so
its size does not grow with the corpus.
"""
from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, without

#: bytes of text per language to be drawn for the fit (rows are drawn by a hash
#: of id and length, so this is the expected number; rows are drawn whole)
SAMPLE_BYTES = 8 << 20
#: n-gram sizes, from the one tried first
SIZES = (6, 5, 4, 3, 2, 1)
#: words, and n-grams of each size, kept per language; fewer where there are many
#: languages, as every feature has a value for every language
MOST_WORDS, MOST_GRAMS, MOST_CELLS, MOST_LANGUAGES = 30_000, 10_000, 20_000_000, 500
#: letters of the longest word looked up as a word
LONGEST = 40
#: characters of a text split into words at a time, and words a worker remembers
PIECE, REMEMBERED = 1 << 20, 200_000
UNKNOWN = "und"

_ASCII = re.compile("[a-z]+")
_LETTERS = regex.compile(r"\p{L}[\p{L}\p{M}]*")
_INNER = regex.compile(r"[\p{L}\p{M}]")


def words(text: str):
    """Lists of the lower-cased words (runs of letters and their marks) of the
    pieces of a text.  A piece ends between words, or after PIECE characters
    of a word that is longer."""
    at = 0
    while at < len(text):
        end = at + PIECE
        if end < len(text):
            k = end
            while k > at and _INNER.match(text[k]):
                k -= 1
            end = k if k > at else end
        piece = text[at:end].lower()
        yield _ASCII.findall(piece) if piece.isascii() else _LETTERS.findall(piece)
        at = end


def grams(word: str, size: int) -> list[str]:
    padded = f" {word} "
    return [padded[i:i + size] for i in range(len(padded) - size + 1)]


# ---- fitting ------------------------------------------------------------

def _count_words(batches):
    for batch in batches:
        counts: dict[str, Counter] = {}
        for lang, text in zip(*[c.to_pylist() for c in batch.columns]):
            for found in words(text):
                counts.setdefault(lang, Counter()).update(found)
        for lang, c in counts.items():
            c = Counter({w: n for w, n in c.items() if len(w) <= LONGEST})
            if c:
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(c), "item": list(c), "n": pa.array(c.values(), pa.int64())})


def _count_grams(batches):
    for batch in batches:
        counts: dict[tuple[str, int], Counter] = {}
        for lang, word, n in zip(*[c.to_pylist() for c in batch.columns]):
            for size in SIZES:
                c = counts.setdefault((lang, size), Counter())
                for g in grams(word, size):
                    c[g] += n
        for (lang, size), c in counts.items():
            if c:
                yield pa.RecordBatch.from_pydict({"lang": [lang] * len(c), "size": pa.array([size] * len(c), pa.int32()),
                                                  "item": list(c), "n": pa.array(c.values(), pa.int64())})


class Model:
    """Languages in order of preference among equals, and for words (size 0)
    and n-grams the row of their values per language."""

    def __init__(self, languages: list[str], rows: dict[int, dict[str, int]], values: np.ndarray):
        self.languages, self.rows, self.values = languages, rows, values


def fit(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang",
        sample_bytes: int = SAMPLE_BYTES) -> Model:
    """The model of the labelled rows of ``labelled`` (null labels and texts
    are left out)."""
    rows = labelled.select(F.col(key).cast("string").alias("key"), F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"))
    rows = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    top = sizes.orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
    top = top.withColumn("share", F.least(F.lit(1.0), F.lit(float(sample_bytes)) / F.greatest("bytes", F.lit(1))))
    languages = [r["lang"] for r in top.select("lang", "n").orderBy(F.desc("n"), "lang").collect()]
    if not languages:
        return Model([], {}, np.zeros((0, 0), np.float32))
    draw = F.pmod(F.xxhash64(F.coalesce("key", F.lit("")), F.octet_length("text"), F.lit(12)), F.lit(1 << 20)) / float(1 << 20)
    sample = rows.join(top.select("lang", "share"), "lang").where(draw < F.col("share")).select("lang", "text")
    counts = stored(sample.mapInArrow(_count_words, "lang string, item string, n long")
                    .groupBy("lang", "item").agg(F.sum("n").alias("n")), "words")
    pieces = (counts.select("lang", "item", "n").mapInArrow(_count_grams, "lang string, size int, item string, n long")
              .groupBy("lang", "size", "item").agg(F.sum("n").alias("n")))
    features = counts.select("lang", F.lit(0).alias("size"), "item", "n").unionByName(pieces)
    # the totals take in what is cut off below
    totals = features.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    most = max(1, min(MOST_WORDS, MOST_CELLS // len(languages) ** 2))
    place = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "item"))
    limit = F.when(F.col("size") == 0, most).otherwise(max(1, most * MOST_GRAMS // MOST_WORDS))
    kept = (features.withColumn("place", place).where(F.col("place") <= limit).join(totals, ["lang", "size"])
            .select("lang", "size", "item", F.log10(F.col("n") / F.col("total")).cast("float").alias("value")))
    return _model(languages, kept.toArrow())


def _model(languages: list[str], t: pa.Table) -> Model:
    number = {x: i for i, x in enumerate(languages)}
    lang, size, item = ([x for x in t.column(c).to_pylist()] for c in ("lang", "size", "item"))
    value = t.column("value").to_numpy()
    rows: dict[int, dict[str, int]] = {}
    n = 0
    at = np.empty(len(item), np.int64)
    for i, (s, x) in enumerate(zip(size, item)):
        known = rows.setdefault(s, {})
        if x not in known:
            known[x] = n
            n += 1
        at[i] = known[x]
    # what a language lacks costs it a tenth of the rarest feature of any, the same for all
    values = np.full((n, len(languages)), (float(value.min()) if len(value) else 0.0) - 1.0, np.float32)
    values[at, [number[x] for x in lang]] = value
    return Model(languages, rows, values)


# ---- prediction ---------------------------------------------------------

class Scorer:
    """Values of words per language, remembered within a worker."""

    def __init__(self, model: Model):
        self.model = model
        self.known, self.places, self.used = model.rows.get(0, {}), {}, 0
        self.extra = np.zeros((1024, len(model.languages)), np.float32)

    def backed_off(self, word: str) -> np.ndarray | None:
        """Mean over the known n-grams of the greatest size that has any."""
        for size in SIZES:
            rows = self.model.rows.get(size)
            if rows:
                at = [r for r in map(rows.get, grams(word, size)) if r is not None]
                if at:
                    return self.model.values[at].mean(axis=0)
        return None

    def place(self, word: str) -> int:
        """Row of a word: of the model's values, or behind them; -1 if nothing of it is known."""
        if len(word) <= LONGEST and (at := self.known.get(word)) is not None:
            return at
        at = self.places.get(word)
        if at is None:
            value = self.backed_off(word)
            if value is None:
                at = -1
            else:
                if self.used == len(self.extra):
                    self.extra = np.concatenate([self.extra, np.zeros_like(self.extra)])
                self.extra[self.used] = value
                at = len(self.model.values) + self.used
                self.used += 1
            self.places[word] = at
        return at

    def predict(self, text: str | None) -> tuple[str, float]:
        model = self.model
        if text is None or not model.languages:
            return UNKNOWN, 0.0
        total, weight, letters = np.zeros(len(model.languages)), 0, False
        for found in words(text):
            letters = letters or bool(found)
            counts = Counter(found)
            if len(self.places) > REMEMBERED:
                self.places, self.used = {}, 0
            at = np.fromiter(map(self.place, counts), np.int64, len(counts))
            n = np.fromiter(counts.values(), np.int64, len(counts))
            at, n = at[at >= 0], n[at >= 0]
            old = at < len(model.values)
            total += n[old] @ model.values[at[old]].astype(np.float64)
            total += n[~old] @ self.extra[at[~old] - len(model.values)].astype(np.float64)
            weight += int(n.sum())
        if not letters:
            return UNKNOWN, 0.0
        mean = total / max(weight, 1)
        best = int(mean.argmax())  # of equals the first, which has more rows
        return model.languages[best], float(1 / np.sum(10.0 ** (mean - mean[best])))


def predicted(model: Model, spark) -> callable:
    """Column function: text -> struct of language and score."""
    shared = spark.sparkContext.broadcast(model)
    held = {}
    kind = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])

    @F.arrow_udf(kind)
    def predict(text: pa.Array) -> pa.Array:
        scorer = held.get("scorer")
        if scorer is None:
            scorer = held["scorer"] = Scorer(shared.value)
        found = [scorer.predict(t.as_py()) for t in text]
        return pa.StructArray.from_arrays([pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())],
                                          kind.names)
    return predict


def fold(key: str = "doc_id", folds: int = 4) -> Column:
    """CRC-32 of the key as text, modulo the number of folds; a null key counts as an empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % folds


def identify(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", held_out: int = 2,
             folds: int = 4, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """``docs`` without the text and with ``held_out`` (rows of this fold are
    not learned from), ``lang_pred`` and ``score`` (0 to 1: how far the means
    of the languages are apart).

    Whole texts are read.  A text that is null or has no letter gets ``und``
    and 0, as does every text where there is nothing to learn from.  Of
    languages with equal means the one with more labelled rows is taken, then
    the first by name; a text of letters the model has never seen goes there
    too.  Input columns named as the added ones are replaced.
    """
    kept_out = fold(key, folds) == held_out
    model = fit(docs.where(~kept_out), key, text, lang, sample_bytes)
    rest = without(docs.drop(text), ["held_out", "lang_pred", "score"])
    keep = [F.col(f"`{c}`") for c in rest.columns]
    out = docs.select(*keep, kept_out.alias("held_out"), predicted(model, docs.sparkSession)(F.col(text)).alias("__t_found"))
    return out.select(*keep, "held_out", "__t_found.*")
