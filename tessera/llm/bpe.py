"""BPE encoding and decoding with the public ``tokenizers`` files.

Ordinary text falls apart at spaces and between kinds of characters, so words
or pieces are encoded (once while a worker remembers them) and their ids
strung together.  Long unsplit text, which has
no such places, is encoded by tree concatenation: halves are encoded apart,
and at each join a window around it is encoded again and grown until it
agrees with both halves, that is until it shares a token (same id, same
span) with the left half and one with the right.  Since every pair of
neighbouring tokens of a BPE encoding is one that BPE itself would leave
alone, and a sequence of such pairs is the encoding of its text, the result
equals the encoding of the whole.

Texts above ``leaf_chars`` are cut into leaves that Spark spreads over the
cluster; their joins are resolved the same way.
"""
from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import small_batches, without

#: a word of more characters than this is encoded by tree concatenation
UNSPLIT = 4096
#: characters of a tree leaf, and of the first window on each side of a join
TREE_LEAF, WINDOW = 2048, 64
#: characters at a join that a shared token keeps away from: the longest
#: contraction that the pre-tokenizer knows, and one more
MARGIN = 4
#: distinct words that a Python worker keeps (twice as many in passing), and
#: characters of texts encoded together
CACHED_WORDS, TOGETHER = 100_000, 500_000


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    return t


def cut_near(text: str, at: int, end: int) -> int:
    """The first place from ``at`` on where normalisation can't reach across:
    before a character that is no mark, no joining jamo and no control.
    ``end`` if there is none."""
    while at < end:
        c = text[at]
        if unicodedata.category(c)[0] not in "MC" and not "ᄀ" <= c <= "ᇿ":
            return at
        at += 1
    return end


class Tokens:
    """Ids of a stretch of text with their spans, counted from the text's start."""
    __slots__ = ("ids", "starts", "ends", "lo", "hi")

    def __init__(self, ids, starts, ends, lo, hi):
        self.ids, self.starts, self.ends, self.lo, self.hi = ids, starts, ends, lo, hi

    def clean(self, i: int) -> bool:
        """Whether a character ends with token i (several tokens can share one)."""
        return i + 1 == len(self.ids) or self.starts[i + 1] >= self.ends[i]


def encode_spans(t, text: str, spans: list[tuple[int, int]]) -> list[Tokens]:
    out = []
    for (lo, hi), e in zip(spans, t.encode_batch([text[lo:hi] for lo, hi in spans], add_special_tokens=False)):
        offsets = np.array(e.offsets, dtype=np.int64).reshape(-1, 2) + lo
        out.append(Tokens(np.array(e.ids, dtype=np.int32), offsets[:, 0], offsets[:, 1], lo, hi))
    return out


def _shared(side: Tokens, window: Tokens, lo: int, hi: int, last: bool) -> tuple[int, int] | None:
    """(token of the side, token of the window) that are the same and lie in
    lo..hi; the last or the first such."""
    a, b = np.searchsorted(side.starts, lo), np.searchsorted(side.ends, hi, "right")
    at = {(int(side.starts[i]), int(side.ends[i]), int(side.ids[i])): i for i in range(a, b) if side.clean(i)}
    order = range(len(window.ids))
    for j in reversed(order) if last else order:
        if window.starts[j] >= lo and window.ends[j] <= hi and window.clean(j):
            i = at.get((int(window.starts[j]), int(window.ends[j]), int(window.ids[j])))
            if i is not None:
                return i, j
    return None


def join(t, text: str, left: Tokens, right: Tokens) -> Tokens:
    """The encoding of two neighbouring stretches from those of each."""
    at, w = left.hi, WINDOW
    while True:
        lo = left.lo if at - w <= left.lo else cut_near(text, at - w, at)
        hi = right.hi if at + w >= right.hi else cut_near(text, at + w, right.hi)
        if lo == at and at - w > left.lo:  # no place to cut on the left: take more
            w *= 2
            continue
        window, = encode_spans(t, text, [(lo, hi)])
        first = (-1, -1) if lo == left.lo else _shared(left, window, lo, at - MARGIN, True)
        last = ((len(right.ids) - 1, len(window.ids) - 1) if hi == right.hi
                else _shared(right, window, at + MARGIN, hi, False))
        if first and last and first[1] <= last[1]:
            break
        w *= 2
    a, b, c, d = first[0] + 1, first[1] + 1, last[1] + 1, last[0] + 1
    return Tokens(*[np.concatenate([getattr(left, x)[:a], getattr(window, x)[b:c], getattr(right, x)[d:]])
                    for x in ("ids", "starts", "ends")], left.lo, right.hi)


def join_tree(t, text: str, nodes: list[Tokens]) -> Tokens:
    while len(nodes) > 1:
        nodes = [join(t, text, *nodes[i:i + 2]) if i + 1 < len(nodes) else nodes[i] for i in range(0, len(nodes), 2)]
    return nodes[0]


def leaves(text: str, size: int) -> list[tuple[int, int]]:
    cuts, n = [0], len(text)
    while n - cuts[-1] > size:
        cuts.append(cut_near(text, cuts[-1] + size, n))
    return list(zip(cuts, [*cuts[1:], n])) if cuts[-1] < n else list(zip(cuts, cuts[1:])) or [(0, 0)]


def encode_tree(t, text: str, leaf: int = TREE_LEAF) -> Tokens:
    return join_tree(t, text, encode_spans(t, text, leaves(text, leaf)))


#: texts of these characters alone (Latin-1 without controls, and common
#: spaces) are cut into pieces here, as the tokenizer's own rules cut them:
#: they are in normal form, and lower case maps each character to one
PLAIN = re.compile(r"[!-~À-ÖØ-öø-ÿ \t\r\n]*")
PIECE = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[!-/:-`{-~]+")


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of texts, put together from those of their words or pieces."""

    def __init__(self, path: str):
        self.t, self.known, self.older = tokenizer(path), {"": b""}, {}
        self.pieces, self.old_pieces = {}, {}
        self.letters = _byte_letters()
        # the pieces above hold for the rules of this file
        from tokenizers.models import BPE
        self.plain = isinstance(self.t.model, BPE) and [
            x.ids for x in self.t.encode_batch(["It's 42, É! ", "we'll"], add_special_tokens=False)] == [
            np.frombuffer(b"".join(map(self._piece, PIECE.findall(x.lower()))), np.int32).tolist() for x in ("It's 42, É! ", "we'll")]

    def __call__(self, texts: list[str]) -> list[bytes]:
        out, part, size = [], [], 0
        for x in texts:  # a few texts at a time, as their words take many times their room
            part.append(x)
            size += len(x)
            if size > TOGETHER:
                out += self._encode(part)
                part, size = [], 0
        return out + self._encode(part)

    def _encode(self, texts: list[str]) -> list[bytes]:
        out = [self._plain(x) for x in texts]
        rest = [i for i, x in enumerate(out) if x is None]
        for i, ids in zip(rest, self._by_words([texts[i] for i in rest])):
            out[i] = ids
        return out

    def _piece(self, piece: str) -> bytes:
        spelled = "".join(map(self.letters.__getitem__, piece.encode()))
        return np.array([x.id for x in self.t.model.tokenize(spelled)], dtype=np.int32).tobytes()

    def _plain(self, text: str) -> bytes | None:
        """None if the text is not plain, or has long unsplit pieces."""
        if not self.plain or not PLAIN.fullmatch(text) or "<|" in text:
            return None
        pieces = PIECE.findall(text.lower())
        if len(text) > UNSPLIT and max(map(len, pieces), default=0) > UNSPLIT:
            return None
        if len(self.pieces) > CACHED_WORDS:  # pieces met since stay known, and those before until the next turn
            self.pieces, self.old_pieces = {}, self.pieces
        known, older = self.pieces, self.old_pieces
        for p in set(pieces).difference(known):
            known[p] = older[p] if p in older else self._piece(p)
        return b"".join(map(known.__getitem__, pieces))

    def _by_words(self, texts: list[str]) -> list[bytes]:
        split = [x.replace("\n", " ").split(" ") for x in texts]
        if len(self.known) > CACHED_WORDS:
            self.known, self.older = {"": b""}, self.known
        known, older = self.known, self.older
        new = set().union(*split).difference(known)
        back = new.intersection(older)
        known.update((w, older[w]) for w in back)
        new -= back
        short = [w for w in new if len(w) <= UNSPLIT]
        for w, e in zip(short, self.t.encode_batch(short, add_special_tokens=False) if short else ()):
            known[w] = np.array(e.ids, dtype=np.int32).tobytes()
        long = [w for w in new if len(w) > UNSPLIT]
        for w in long:
            known[w] = encode_tree(self.t, w).ids.tobytes()
        out = [b"".join(map(known.__getitem__, words)) for words in split]
        for w in long:
            del known[w]
        return out


@lru_cache(maxsize=4)
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def _id_lists(parts: list[bytes]) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), dtype=np.int32)))


def encode_column(path: str):
    """Arrow function: text -> ids; null encodes as ''."""
    @F.arrow_udf("array<int>")
    def encode_(texts: pa.Array) -> pa.Array:
        return _id_lists(word_encoder(path)([x or "" for x in texts.to_pylist()]))
    return encode_


@lru_cache(maxsize=4)
def _names(path: str) -> pa.Array | None:
    """Token texts by id, for files whose decoding is joining them by spaces."""
    t = tokenizer(path)
    return pa.array([t.id_to_token(i) for i in range(t.get_vocab_size())]) if t.decoder is None else None


def _decode(path: str, ids: pa.ListArray) -> pa.Array:
    names, t = _names(path), tokenizer(path)
    if names is None:
        return pa.array([t.decode(x or [], skip_special_tokens=False) for x in ids.to_pylist()], pa.string())
    ids = pc.fill_null(ids, pa.scalar([], ids.type))
    start = ids.offsets[0].as_py()
    values = names.take(ids.values.slice(start, ids.offsets[-1].as_py() - start))
    return pc.binary_join(pa.ListArray.from_arrays(pc.subtract(ids.offsets, start), values), " ")


def decode_column(path: str):
    """Arrow function: ids -> text, special tokens kept; null ids decode as ''."""
    @F.arrow_udf("string")
    def decode_(ids: pa.Array) -> pa.Array:
        return pa.concat_arrays([_decode(path, ids.slice(lo, 500)) for lo in range(0, len(ids), 500)]
                                or [pa.array([], pa.string())])
    return decode_


def _cut(size: int):
    def cut(batches):
        for batch in batches:
            for key, text in zip(*[c.to_pylist() for c in batch.columns]):
                spans = leaves(text, size)
                for i in range(0, len(spans), 64):
                    part = spans[i:i + 64]
                    yield pa.RecordBatch.from_pydict({
                        "_key": [key] * len(part), "_leaf": pa.array(range(i, i + len(part)), pa.int32()),
                        "_lo": pa.array([lo for lo, _ in part], pa.int64()),
                        "_text": [text[lo:hi] for lo, hi in part]})
    return cut


def _encode_leaves(path: str):
    def run(batches):
        t = tokenizer(path)
        for batch in batches:
            for row in range(batch.num_rows):
                key, leaf, lo, text = [c[row].as_py() for c in batch.columns]
                n = encode_tree(t, text)
                yield pa.RecordBatch.from_pydict({
                    "_key": [key], "_leaf": pa.array([leaf], pa.int32()), "_text": [text],
                    "_ids": [n.ids.tobytes()], "_starts": [(n.starts + lo).tobytes()], "_ends": [(n.ends + lo).tobytes()]})
    return run


def _join_leaves(path: str):
    def done(t, key, parts):
        text, nodes, lo = "".join(p[0] for p in parts), [], 0
        for part, ids, starts, ends in parts:
            nodes.append(Tokens(np.frombuffer(ids, np.int32), np.frombuffer(starts, np.int64),
                                np.frombuffer(ends, np.int64), lo, lo + len(part)))
            lo += len(part)
        return pa.RecordBatch.from_arrays([pa.array([key]), _id_lists([join_tree(t, text, nodes).ids.tobytes()])],
                                          names=["_key", "_found"])

    def run(batches):
        t, key, parts = tokenizer(path), None, []
        for batch in batches:
            for row in range(batch.num_rows):
                k, _, *part = [c[row].as_py() for c in batch.columns]
                if parts and k != key:
                    yield done(t, key, parts)
                    parts = []
                key = k
                parts.append(part)
        if parts:
            yield done(t, key, parts)
    return run


def encode(docs: DataFrame, path: str | None = None, text: str = "text", out: str = "ids",
           leaf_chars: int = 65_536) -> DataFrame:
    """``docs`` without the text column and with ``out``: the ids the
    tokenizers library gives the whole text, no special tokens added.

    A null text is encoded as an empty one.  Rows are encoded where they lie;
    only leaves of texts over ``leaf_chars`` are shuffled, each distinct long
    text once, and their ids joined back by the text's digest.  An input
    column named ``out`` is replaced.
    """
    path = path or default_path()
    small_batches(docs)
    docs = without(docs, [out])
    keep = [F.col(f"`{c}`") for c in docs.columns if c != text]
    size = F.coalesce(F.char_length(text), F.lit(0))
    short = docs.filter(size <= leaf_chars).select(*keep, encode_column(path)(F.col(text)).alias(out))
    long = docs.filter(size > leaf_chars).withColumn("__t_key", F.sha2(text, 256))
    cut = long.select(F.col("__t_key").alias("_key"), text).mapInArrow(_cut(leaf_chars), "_key string, _leaf int, _lo long, _text string")
    coded = (cut.dropDuplicates(["_key", "_leaf"]).select("_key", "_leaf", "_lo", "_text")
             .mapInArrow(_encode_leaves(path), "_key string, _leaf int, _text string, _ids binary, _starts binary, _ends binary"))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = (coded.repartition(parts, "_key").sortWithinPartitions("_key", "_leaf")
             .mapInArrow(_join_leaves(path), "_key string, _found array<int>"))
    whole = whole.select(F.col("_key").alias("__t_key"), F.col("_found").alias("__t_found"))
    long = long.drop(text).join(whole, "__t_key").select(*keep, F.col("__t_found").alias(out))
    return short.unionByName(long)


def decode(coded: DataFrame, path: str | None = None, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """``coded`` with ``out``: the text of its ids, special tokens kept."""
    return without(coded, [out]).withColumn(out, decode_column(path or default_path())(F.col(ids)))

