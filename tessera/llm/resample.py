"""Target-distribution importance resampling over hashed word runs.

Every run of one to three words falls into one of BUCKETS buckets by its
CRC-32.  A bucket's gain is the log ratio of its share in the target texts to
its share in the documents, a document's weight the sum of the gains of its
runs, and weight plus Gumbel noise drawn from its id is its score: taking the
highest scores draws without replacement in proportion to the weights.

Words and checksums are arrays over the bytes of many texts: the checksum of
a run follows from those of its words, as appending bytes is linear.  The
lowest score drawn is found by weighted median-of-medians selection: every
partition reports the median of its keys that are still in question and how
many there are, the median of these medians weighted by their sizes has at
least a quarter of the keys on either side, and the side without the cutoff
goes, until the cutoff is the pivot itself.  Only the winners are sorted.
"""
from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.sequence import assign_ids
from .common import stored, without
from .infill import _buffer

BUCKETS, RUN = 10_000, 3
#: percent of the documents with LEAST_WORDS words or more that are drawn
DRAWN, LEAST_WORDS, SEED = 5, 20, 42
#: bytes of text held as word arrays at a time
WINDOW = 1 << 21
#: words up to this length go through the checksum's table together
SHORT = 64
ADDED = ("n_words", "n_features", "weight", "score", "rank")

# ---- checksums of runs of words -----------------------------------------

_WORD = np.zeros(256, bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x41:0x5B] = _WORD[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


@lru_cache(maxsize=1)
def _tables():
    """(table of one byte; tables that append 0 to SHORT + 1 zero bytes; those
    that append 1, 2, 4 ... of them), each as four tables by byte of the sum."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, np.uint32(0xEDB88320) ^ (table >> np.uint32(1)), table >> np.uint32(1))
    step = [np.arange(256, dtype=np.uint32) << np.uint32(8 * j) for j in range(4)]
    step = [np.stack(step)]
    for _ in range(SHORT + 1):
        step.append(table[step[-1] & 255] ^ (step[-1] >> np.uint32(8)))
    powers = [step[1]]
    for _ in range(31):
        powers.append(_apply(powers[-1], powers[-1]))
    return table, np.stack(step), powers


def _apply(t: np.ndarray, c: np.ndarray) -> np.ndarray:
    return t[0][c & 255] ^ t[1][(c >> 8) & 255] ^ t[2][(c >> 16) & 255] ^ t[3][c >> 24]


def appended(c: np.ndarray, zeros: np.ndarray) -> np.ndarray:
    """The part that checksum ``c`` has in one with ``zeros`` more bytes."""
    _, step, powers = _tables()
    flat, at = step.reshape(-1), np.minimum(zeros, SHORT + 1) * 1024
    out = (flat[at + (c & 255)] ^ flat[at + 256 + ((c >> 8) & 255)] ^ flat[at + 512 + ((c >> 16) & 255)]
           ^ flat[at + 768 + (c >> 24)])
    for i in np.flatnonzero(zeros > SHORT + 1):
        x, n = c[i:i + 1], int(zeros[i])
        for k in range(n.bit_length()):
            if n >> k & 1:
                x = _apply(powers[k], x)
        out[i] = x[0]
    return out


def checksums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """CRC-32 of each run of bytes."""
    table = _tables()[0]
    order = np.argsort(-np.minimum(sizes, SHORT + 1), kind="stable")
    order = order[np.searchsorted(-sizes[order].clip(max=SHORT + 1), -SHORT, "left"):]  # the short ones, longest first
    at, live = starts[order], sizes[order]
    c = np.full(len(order), 0xFFFFFFFF, np.uint32)
    n = len(order)
    for i in range(int(live[0]) if n else 0):
        n = int(np.searchsorted(-live, -i, "left"))
        c[:n] = table[(c[:n] ^ data[at[:n] + i]) & 255] ^ (c[:n] >> np.uint32(8))
    out = np.empty(len(starts), np.uint32)
    out[order] = ~c
    for i in np.flatnonzero(sizes > SHORT):
        out[i] = zlib.crc32(data[starts[i]:starts[i] + sizes[i]])
    return out


def _words(data: np.ndarray, ends: np.ndarray):
    """(starts, sizes, text) of the words of consecutive windows of a buffer
    of texts; a word is never cut."""
    size, lo = len(data), 0
    first = np.zeros(size + 1, bool)
    first[ends] = True
    while lo < size:
        hi = min(size, lo + WINDOW)
        while hi < size:  # back to a place between words, or else on to one
            between = np.flatnonzero(~_WORD[data[lo:hi]] | first[lo + 1:hi + 1])
            if len(between):
                hi = lo + int(between[-1]) + 1
                break
            hi = min(size, hi + WINDOW)
        word, edge = _WORD[data[lo:hi]], first[lo:hi]
        begins = word & (np.concatenate([[True], ~word[:-1]]) | edge)
        closes = word & (np.concatenate([~word[1:], [True]]) | np.concatenate([edge[1:], [True]]))
        starts = np.flatnonzero(begins)
        yield starts + lo, np.flatnonzero(closes) + 1 - starts, np.searchsorted(ends, starts + lo, "right") - 1
        lo = hi


def runs(data: np.ndarray, ends: np.ndarray):
    """(number of words of every text in the window, buckets, texts) of the
    runs of one to RUN words, window by window; a run belongs to the window of
    its last word.  ``data`` is in lower case."""
    no = np.zeros(0, np.int64)
    c, space, sizes, text = np.zeros(0, np.uint32), np.zeros(0, np.uint32), no, no
    n = len(ends) - 1
    for starts, new_sizes, new_text in _words(data, ends):
        kept = min(RUN - 1, len(c))
        new = checksums(data, starts, new_sizes)
        one = np.full(len(new), zlib.crc32(b" "), np.uint32)
        c = np.concatenate([c[len(c) - kept:], new])
        space = np.concatenate([space[len(space) - kept:], new ^ appended(one, new_sizes)])
        sizes = np.concatenate([sizes[len(sizes) - kept:], new_sizes])
        text = np.concatenate([text[len(text) - kept:], new_text])
        last = np.arange(kept, len(c))
        sums, buckets, owners = c, [c[kept:] % BUCKETS], [new_text]
        for k in range(1, RUN):
            # sums[i]: of the k words that end with word i
            longer = appended(sums[:-1], sizes[1:] + 1) ^ space[1:]
            sums = np.concatenate([np.zeros(min(1, len(sums)), np.uint32), longer])
            inside = last[last >= k]
            inside = inside[text[inside] == text[inside - k]]
            buckets.append(sums[inside] % BUCKETS)
            owners.append(text[inside])
        yield np.bincount(new_text, minlength=n), np.concatenate(buckets).astype(np.int64), np.concatenate(owners)


# ---- counts, gains, weights ---------------------------------------------

def _count(batches):
    counts = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        data, ends = _buffer(batch.column(0))
        for _, buckets, _ in runs(_LOWER[data], ends):
            counts += np.bincount(buckets, minlength=BUCKETS)
    at = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(counts[at])], names=["bucket", "n"])


def bucket_counts(texts: DataFrame, text: str = "text") -> DataFrame:
    """(bucket, n) over the runs of all texts: every task adds up its own."""
    part = texts.select(F.col(text)).mapInArrow(_count, "bucket long, n long")
    return part.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, text: str = "text") -> np.ndarray:
    """The gain of each bucket: thousandths of the natural log of its smoothed
    share in the target over that in the documents, rounded down."""
    both = bucket_counts(docs, text).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t")).unionByName(
        bucket_counts(target, text).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
    rows = both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")).collect()  # BUCKETS rows at most
    s, t = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for r in rows:
        s[r.bucket], t[r.bucket] = r.s, r.t
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def _weigh(gain: np.ndarray):
    kind = T.StructType([T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight")])

    @F.arrow_udf(kind)
    def weigh(text: pa.Array) -> pa.Array:
        data, ends = _buffer(text)
        n = len(text)
        words, features, weight = (np.zeros(n, np.int64) for _ in range(3))
        for found, buckets, owners in runs(_LOWER[data], ends):
            words += found
            features += np.bincount(owners, minlength=n)
            weight += np.bincount(owners, gain[buckets], n).astype(np.int64)  # whole numbers, exact in doubles
        return pa.StructArray.from_arrays([pa.array(x) for x in (words, features, weight)], kind.names)
    return weigh


def scored(docs: DataFrame, gain: np.ndarray, key: str = "doc_id", text: str = "text", seed: int = SEED,
           keep_text: bool = False) -> DataFrame:
    """``docs`` with n_words, n_features, weight and score, without the text
    unless asked for."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))
    rest = without(docs if keep_text else docs.drop(text), ADDED)
    found = docs.select(*[F.col(f"`{c}`") for c in rest.columns], noise.alias("__t_noise"),
                        _weigh(gain)(F.col(text)).alias("__t_w"))
    return found.select(*[F.col(f"`{c}`") for c in rest.columns], "__t_w.*",
                        (F.col("__t_w.weight") + F.col("__t_noise")).alias("score"))


# ---- selection ----------------------------------------------------------

#: a key: smaller means drawn earlier; nulls follow ids, and rows that are
#: alike in both follow their place in the scored table
KEY = ("low", "none", "id", "row")


def _medians(pivot: tuple | None):
    """Per partition and side of the pivot (0: up to it): number of keys and median."""
    def run(batches):
        cols = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches if batch.num_rows]
        if not cols:
            return
        keys = [np.concatenate(c) for c in zip(*cols)]
        order = np.lexsort(keys[::-1])
        keys = [k[order] for k in keys]
        cut = 0
        if pivot is not None:  # keys up to the pivot, narrowed column by column
            lo, hi = 0, len(order)
            for k, p in zip(keys, pivot):
                lo, hi = lo + int(np.searchsorted(k[lo:hi], p, "left")), lo + int(np.searchsorted(k[lo:hi], p, "right"))
            cut = hi
        for side, a, b in ((0, 0, cut), (1, cut, len(order))):
            if b > a:
                yield pa.RecordBatch.from_pydict({"side": pa.array([side], pa.int32()), "n": pa.array([b - a], pa.int64()),
                                                  **{c: pa.array([int(k[(a + b - 1) // 2])], pa.int64()) for c, k in zip(KEY, keys)}})
    return run


def _least(key: tuple) -> Column:
    return F.struct(*[F.lit(x).cast("long").alias(c) for c, x in zip(KEY, key)])


def cutoff(keys: DataFrame, k: int) -> tuple | None:
    """The ``k``-th smallest of the distinct KEY rows of a stored table, or
    None for ``k`` < 1.  A round reads the keys between two known bounds once;
    when a sixteenth of what was last written is left, that is written anew."""
    if k < 1:
        return None
    mine, low, high = F.struct(*KEY), None, None  # in question: low < key <= high
    pivot, written = None, None

    def in_question():
        left = keys
        if low is not None:
            left = left.where((F.col("low") >= low[0]) & (mine > _least(low)))
        if high is not None:
            left = left.where((F.col("low") <= high[0]) & (mine <= _least(high)))
        return left
    while True:
        found = in_question().mapInArrow(_medians(pivot), "side int, n long, " + ", ".join(f"{c} long" for c in KEY)).collect()
        below = sum(r.n for r in found if r.side == 0)
        if pivot is not None and k == below:
            return pivot
        if pivot is not None and k < below:
            high, found = pivot, [r for r in found if r.side == 0]
        elif pivot is not None:
            k, low, found = k - below, pivot, [r for r in found if r.side == 1]
        size, seen = sum(r.n for r in found), 0
        if size < k:
            raise ValueError("fewer keys than asked for")
        for pivot, n in sorted((tuple(r[c] for c in KEY), r.n) for r in found):
            seen += n
            if 2 * seen >= size:
                break
        written = written or size
        if size * 16 < written:
            keys, written = stored(in_question(), "keys"), size


def draw(table: DataFrame, key: str = "doc_id", percent: int = DRAWN, least_words: int = LEAST_WORDS) -> DataFrame:
    """``table`` (of ``scored``) with ``rank``: 1, 2, 3 ... for the ``percent``
    of the rows with ``least_words`` words or more that have the highest
    scores, ties to smaller keys, null keys last; null for all others."""
    table = stored(table.withColumn("__t_row", F.monotonically_increasing_id()), "scored")
    parts = (-F.col("score"), F.col(key).isNull().cast("long"), F.coalesce(F.col(key).cast("long"), F.lit(0).cast("long")), F.col("__t_row"))
    of_row = F.struct(*[p.cast("long").alias(c) for c, p in zip(KEY, parts)])
    fit = table.where(F.col("n_words") >= least_words)
    last = cutoff(fit.select(of_row.alias("k")).select("k.*"), percent * fit.count() // 100)
    if last is None:
        return table.drop("__t_row").withColumn("rank", F.lit(None).cast("long"))
    drawn = (F.col("n_words") >= least_words) & (of_row <= _least(last))
    winners = stored(table.where(drawn).withColumn("__t_key", of_row), "winners")
    ranked = assign_ids(winners, [f"__t_key.{c}" for c in KEY], "rank", id_type="long").drop("__t_key")
    others = table.where(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return others.unionByName(ranked.select(*others.columns)).drop("__t_row")


def resample(docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", percent: int = DRAWN,
             least_words: int = LEAST_WORDS, seed: int = SEED, keep_text: bool = False) -> DataFrame:
    """Every row of ``docs``, without the text unless asked for, with
    ``n_words``, ``n_features``, ``weight``, ``score`` and ``rank`` (null where
    not drawn): a draw of ``percent`` of the documents by how much likelier
    their word runs are in ``target``.

    Null, empty and blank texts have no runs, weight 0, and are not drawn as
    they have fewer than ``least_words`` words.  Rows with equal keys get the
    same noise; equal rows tie and take ranks in the order they are read.
    Empty tables on either side are allowed.  Input columns named as the added
    ones are replaced.
    """
    return draw(scored(docs, gains(docs, target, text), key, text, seed, keep_text), key, percent, least_words)
