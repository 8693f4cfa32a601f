"""Fill-in-middle transformation by displacement scatter.

The bytes of a batch of texts lie one after the other.  Scanning the code
points gives the bytes at which a text is cut; its parts and where each goes
give one shift per part.  The changes of the shift, written into a difference
array and summed up, are the output shift of every byte, and one numpy
scatter writes the batch.  The way back finds the marks in the output, builds
the shifts of the inverse in the same manner, and gathers.  Both go through a
batch in windows of bytes, so that index arrays stay small beside long texts.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import without

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: of 100 documents, how many are cut, and how many of those give the suffix first
RATE, SUFFIX_FIRST = 90, 20
FORMS = ("plain", "psm", "spm")
#: bytes that are moved at a time, and per count of code points
WINDOW, BLOCK = 1 << 20, 4096
_MARK = len(PREFIX)
MADE = T.StructType([T.StructField("output", T.StringType()), *[
    T.StructField(c, T.LongType()) for c in ("n_chars", "prefix_chars", "middle_chars")]])


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and where each begins and ends; nulls are empty."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return data, ends - ends[0]


def _texts(data: np.ndarray, ends: np.ndarray, absent: np.ndarray | None = None) -> pa.Array:
    valid = None if absent is None else pa.py_buffer(np.packbits(~absent, bitorder="little"))
    out = pa.LargeStringArray.from_buffers(len(ends) - 1, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data), valid)
    return out.cast(pa.string())


class CodePoints:
    """Code points before a byte, and the byte of a code point, by counts per block."""

    def __init__(self, data: np.ndarray):
        self.first = (data & 0xC0) != 0x80
        edges = np.arange(0, len(data), BLOCK)
        self.before = np.concatenate([[0], np.cumsum(np.add.reduceat(self.first, edges, dtype=np.int64) if len(edges) else [])]).astype(np.int64)

    def rank(self, at: int) -> int:
        lo = at // BLOCK * BLOCK
        return int(self.before[at // BLOCK]) + int(np.count_nonzero(self.first[lo:at]))

    def byte(self, k: int) -> int:
        """The byte at which code point ``k`` of the buffer begins (its end for the last and one)."""
        if k >= self.before[-1]:
            return len(self.first)
        block = int(np.searchsorted(self.before, k, "right")) - 1
        lo = block * BLOCK
        return lo + int(np.flatnonzero(self.first[lo:lo + BLOCK])[k - self.before[block]])


def _displacements(starts: np.ndarray, shifts: np.ndarray, size: int):
    """(lo, hi, shift of every byte of that window).  ``starts`` ascend; a part
    keeps its shift up to the next start, and of parts that begin together the
    last one holds, as the changes add up."""
    change, carry = np.diff(shifts, prepend=0), 0
    for lo in range(0, size, WINDOW):
        hi = min(size, lo + WINDOW)
        a, b = np.searchsorted(starts, [lo, hi])
        difference = np.zeros(hi - lo, np.int64)
        np.add.at(difference, starts[a:b] - lo, change[a:b])
        difference[0] += carry
        shift = np.cumsum(difference)
        carry = int(shift[-1])
        yield lo, hi, shift


def _lay(first: np.ndarray, sizes: list[np.ndarray]) -> list[np.ndarray]:
    """Begin of each of several runs laid one after the other from ``first``."""
    out = [first]
    for s in sizes[:-1]:
        out.append(out[-1] + s)
    return out


def rearrange(texts: pa.Array, form: np.ndarray, one: np.ndarray, other: np.ndarray):
    """The outputs of a batch; ``form`` indexes FORMS, and ``one`` and
    ``other`` are reduced modulo code points + 1 to the two cuts.  Returns
    (outputs, code points, of the prefix, of the middle)."""
    data, ends = _buffer(texts)
    n, points = len(texts), CodePoints(data)
    ranks = np.array([points.rank(int(e)) for e in ends], np.int64)
    chars = np.diff(ranks)
    a, b = one % (chars + 1), other % (chars + 1)
    a, b = np.minimum(a, b), np.maximum(a, b)
    cut = form > 0
    p, m = ends[:-1].copy(), ends[:-1].copy()
    for i in np.flatnonzero(cut):
        p[i], m[i] = points.byte(int(ranks[i] + a[i])), points.byte(int(ranks[i] + b[i]))
    sizes = np.stack([p - ends[:-1], m - p, ends[1:] - m])
    out_ends = np.concatenate([[0], np.cumsum(np.diff(ends) + 3 * _MARK * cut)])
    begin = out_ends[:-1]
    to = np.stack([begin, begin, begin])  # of a plain text all bytes are its suffix
    marks = []
    for kind, order in ((1, (0, 2, 1)), (2, (2, 0, 1))):
        at = np.flatnonzero(form == kind)
        places = _lay(begin[at] + _MARK, [sizes[part][at] + _MARK for part in order])
        for part, place in zip(order, places):
            to[part][at] = place
            marks.append((place - _MARK, (PREFIX, MIDDLE, SUFFIX)[part]))
    starts = np.stack([ends[:-1], p, m], axis=1).ravel()
    shifts = to.T.ravel() - starts
    out = np.empty(int(out_ends[-1]), np.uint8)
    for lo, hi, shift in _displacements(starts, shifts, len(data)):
        out[np.arange(lo, hi) + shift] = data[lo:hi]
    for places, mark in marks:
        out[places[:, None] + np.arange(_MARK)] = np.frombuffer(mark.encode(), np.uint8)
    return _texts(out, out_ends), chars, a, b - a


def restore_batch(outputs: pa.Array, form: np.ndarray) -> pa.Array:
    """The texts that the outputs were made of, from the marks in them; null
    where an output is not of its form."""
    data, ends = _buffer(outputs)
    raw, n = data.tobytes(), len(outputs)
    begin = ends[:-1]
    source, sizes = np.stack([begin, begin, begin]), np.zeros((3, n), np.int64)
    sizes[2] = np.diff(ends)
    broken = (form < 0) | np.array(pc.is_null(outputs))
    for kind, (first, second) in ((1, (0, 2)), (2, (2, 0))):
        opens, then = ((PREFIX, SUFFIX), (SUFFIX, PREFIX))[kind - 1]
        for i in np.flatnonzero(form == kind):
            lo, hi = int(ends[i]), int(ends[i + 1])
            x = raw.find(then.encode(), lo + _MARK, hi)
            y = raw.find(MIDDLE.encode(), x + _MARK, hi) if x >= 0 else -1
            if y < 0 or not raw.startswith(opens.encode(), lo, hi):
                broken[i] = True
                continue
            source[first, i], sizes[first, i] = lo + _MARK, x - lo - _MARK
            source[second, i], sizes[second, i] = x + _MARK, y - x - _MARK
            source[1, i], sizes[1, i] = y + _MARK, hi - y - _MARK
    sizes[:, broken] = 0
    out_ends = np.concatenate([[0], np.cumsum(sizes.sum(axis=0))])
    starts = np.stack(_lay(out_ends[:-1], list(sizes)), axis=1).ravel()
    out = np.empty(int(out_ends[-1]), np.uint8)
    for lo, hi, shift in _displacements(starts, source.T.ravel() - starts, len(out)):
        out[lo:hi] = data[np.arange(lo, hi) + shift]
    return _texts(out, out_ends, broken if broken.any() else None)


@F.arrow_udf(MADE)
def _rearranged(text: pa.Array, form: pa.Array, one: pa.Array, other: pa.Array) -> pa.Array:
    kind = form.to_numpy(zero_copy_only=False)
    out, chars, prefix, middle = rearrange(text, kind, one.to_numpy(zero_copy_only=False), other.to_numpy(zero_copy_only=False))
    return pa.StructArray.from_arrays(
        [out, pa.array(chars), pa.array(prefix, mask=kind == 0), pa.array(middle, mask=kind == 0)],
        ["output", "n_chars", "prefix_chars", "middle_chars"])


@F.arrow_udf(T.StringType())
def _restored(output: pa.Array, form: pa.Array) -> pa.Array:
    kinds = pc.fill_null(pc.index_in(form, pa.array(FORMS)), -1)
    return restore_batch(output, kinds.to_numpy(zero_copy_only=False))


def _group(digest: Column, k: int) -> Column:
    return F.conv(F.substring(digest, 8 * k - 7, 8), 16, 10).cast("long")


def infill(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: int = 1, rate: int = RATE,
           suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """``docs`` without the text column and with ``form`` (plain, psm or spm),
    ``output``, ``n_chars``, and ``prefix_chars`` and ``middle_chars`` (null
    where the form is plain).

    The key and the seed decide form and cuts, so a run that is repeated gives
    the same rows; a null key counts as an empty one, and equal rows come out
    equal.  Null texts are empty.  Empty texts and those that contain a mark
    are plain.  Cuts lie between code points.  Input columns named as the added
    ones are replaced; a text must stay under 2 GB with its marks.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    body = F.coalesce(F.col(text), F.lit(""))
    marked = body.contains(PREFIX) | body.contains(SUFFIX) | body.contains(MIDDLE)
    form = F.when((body == "") | marked | (_group(digest, 3) % 100 >= rate), 0).when(_group(digest, 4) % 100 < suffix_first, 2).otherwise(1)
    added = ("form", "output", "n_chars", "prefix_chars", "middle_chars")
    keep = [F.col(f"`{c}`") for c in without(docs.drop(text), added).columns]
    made = docs.select(*keep, form.alias("__t_form"), _rearranged(body, form, _group(digest, 1), _group(digest, 2)).alias("__t_made"))
    return made.select(*keep, F.element_at(F.array(*map(F.lit, FORMS)), F.col("__t_form") + 1).alias("form"), "__t_made.*")


def restore(made: DataFrame, output: str = "output", form: str = "form", out: str = "restored") -> DataFrame:
    """``made`` with ``out``: the whole text rebuilt from output and form, null
    where the output lacks the marks of its form or either is null."""
    return without(made, [out]).withColumn(out, _restored(F.col(output), F.col(form)))
