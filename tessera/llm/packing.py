"""Packing token ids into rows of equal length.

Texts become ids, texts longer than a row are split into pieces that fit
(and can be put together again), and pieces are packed into rows by best-fit
decreasing: longest first, each into the fullest row with room for it.  The
row is found in a segment tree over the free room left (how many open rows
have each amount of room), in a number of steps that grows with the
logarithm of the row length.  Packing runs in groups of bounded size that
pieces are dealt to by hash, so a source, however large, is never in one task.
"""
from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import without

#: ids per row, and the bytes of text that a packing group is meant to hold
#: (a document has no more ids than bytes, its end counted)
ROW, GROUP_BYTES = 2048, 8_000_000
#: documents that a task turns into ids at a time, and characters beyond which it starts anew
STEP_DOCS, STEP_CHARS = 256, 1_000_000
PACKED = ("pack_group int, pack_row int, n_ids int, ids binary, doc_ids array<long>, pieces array<int>, "
          "cu_seqlens array<int>, resets binary")


class Rooms:
    """Segment tree over the amounts of free room 0..size: which open row to
    take for a piece, in O(log size)."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows = [[] for _ in range(size + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        at = self.leaves + room
        while at:
            self.count[at] += 1
            at >>= 1

    def best(self, need: int) -> tuple[int, int] | None:
        """Remove and return (room, row) with the least room of ``need`` or more."""
        count, at = self.count, self.leaves + need
        if not count[at]:
            while at > 1 and (at & 1 or not count[at + 1]):  # up to a right neighbour that has rows
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.leaves:
                at = 2 * at if count[2 * at] else 2 * at + 1
        room = at - self.leaves
        row = self.rows[room].pop()
        while at:
            count[at] -= 1
            at >>= 1
        return room, row


def best_fit_decreasing(sizes: np.ndarray, row: int) -> tuple[np.ndarray, int]:
    """Row of each piece and number of rows; equal sizes keep their order."""
    rooms, out, rows = Rooms(row), np.zeros(len(sizes), np.int32), 0
    for i in np.argsort(-sizes, kind="stable"):
        size = int(sizes[i])
        found = rooms.best(size)
        if found is None:
            found, rows = (row, rows), rows + 1
        out[i] = found[1]
        if found[0] > size:
            rooms.add(found[0] - size, found[1])
    return out, rows


@lru_cache(maxsize=4)
def encoding(path: str):
    import base64

    import public_tokenizers
    import tiktoken
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def _pieces(path: str, row: int, end: int):
    """Batches of (doc_id, text) -> the pieces of each document's ids, ending
    with ``end``.  Ids are stored in two bytes each, low byte first."""
    def run(batches):
        enc = encoding(path)
        for part in (b.slice(lo, STEP_DOCS) for b in batches for lo in range(0, b.num_rows, STEP_DOCS)):
            docs, nos, sizes, ids, chars = [], [], [], [], 0

            def made():
                return pa.RecordBatch.from_arrays(
                    [pa.array(docs, pa.int64()), pa.array(nos, pa.int32()), pa.array(sizes, pa.int32()), pa.array(ids, pa.binary())],
                    names=["doc_id", "piece", "n_ids", "ids"])
            for doc, text in zip(*part.columns):
                text = text.as_py() or ""
                own = np.array([*enc.encode_ordinary(text), end], dtype="<u2")
                for no, lo in enumerate(range(0, len(own), row)):
                    piece = own[lo:lo + row]
                    docs.append(doc.as_py())
                    nos.append(no)
                    sizes.append(len(piece))
                    ids.append(piece.tobytes())
                chars += len(text)
                if chars > STEP_CHARS:
                    yield made()
                    docs, nos, sizes, ids, chars = [], [], [], [], 0
            if docs:
                yield made()
    return run


def token_pieces(docs: DataFrame, path: str | None = None, row: int = ROW, end: int = 50_256,
                 key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, piece, n_ids, ids): the ids of every whole text and ``end``,
    cut into pieces of at most ``row``.  A null text is an empty one."""
    return docs.select(F.col(key).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(
        _pieces(path or default_path(), row, end), "doc_id long, piece int, n_ids int, ids binary")


def _pack(row: int, pad: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("doc_id", "ascending"), ("piece", "ascending"), ("n_ids", "ascending"), ("ids", "ascending")])
        sizes = t.column("n_ids").to_numpy()
        ids, docs, nos = [t.column(c).to_pylist() for c in ("ids", "doc_id", "piece")]
        at, rows = best_fit_decreasing(sizes, row)
        order = np.argsort(at, kind="stable")
        cuts = np.searchsorted(at[order], np.arange(rows + 1))
        out = {c: [] for c in ("n_ids", "ids", "doc_ids", "pieces", "cu_seqlens", "resets")}
        for r in range(rows):
            own = order[cuts[r]:cuts[r + 1]]
            ends = np.cumsum(sizes[own])
            used = int(ends[-1])
            resets = np.zeros(row, bool)
            resets[np.concatenate([[0], ends[:-1]])] = True
            out["n_ids"].append(used)
            out["ids"].append(b"".join(ids[i] for i in own) + np.full(row - used, pad, "<u2").tobytes())
            out["doc_ids"].append([docs[i] for i in own])
            out["pieces"].append([nos[i] for i in own])
            out["cu_seqlens"].append([0, *ends.tolist()])
            out["resets"].append(np.packbits(resets, bitorder="little").tobytes())
        group = t.column("pack_group")[0].as_py()
        return pa.table({
            "pack_group": pa.array([group] * rows, pa.int32()), "pack_row": pa.array(range(rows), pa.int32()),
            "n_ids": pa.array(out["n_ids"], pa.int32()), "ids": pa.array(out["ids"], pa.binary()),
            "doc_ids": pa.array(out["doc_ids"], pa.list_(pa.int64())), "pieces": pa.array(out["pieces"], pa.list_(pa.int32())),
            "cu_seqlens": pa.array(out["cu_seqlens"], pa.list_(pa.int32())), "resets": pa.array(out["resets"], pa.binary())})
    return run


def pack(pieces: DataFrame, groups: int, row: int = ROW, pad: int = 50_256) -> DataFrame:
    """One row of ``row`` ids for each packed row: its ``ids`` (two bytes each,
    padded with ``pad``), the documents and pieces in it, ``cu_seqlens`` (the
    start of each piece and the end of the last) and ``resets`` (one bit per
    id, set where positions start from 0 again)."""
    # by the place in the input as well, so that equal rows are dealt out too
    spread = F.pmod(F.xxhash64("doc_id", "piece", "ids", F.monotonically_increasing_id()), F.lit(groups)).cast("int")
    return without(pieces, ["pack_group"]).withColumn("pack_group", spread).groupBy("pack_group").applyInArrow(_pack(row, pad), PACKED)


def pack_documents(docs: DataFrame, path: str | None = None, row: int = ROW, end: int = 50_256,
                   key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents as packed rows (see ``pack``), each followed by ``end``.

    Every document is in the result, as one piece or several; null and empty
    texts as ``end`` alone; rows with equal ids or texts each once; an empty
    table gives no rows.  The number of groups follows the bytes of text,
    summed beforehand.  Extra columns are ignored."""
    if end > 0xFFFF:
        raise ValueError("ids are stored in two bytes")
    size = docs.agg(F.sum(F.coalesce(F.octet_length(F.col(text).cast("string")), F.lit(0)).cast("long") + 1)).first()[0] or 0
    return pack(token_pieces(docs, path, row, end, key, text), max(1, -(-size // GROUP_BYTES)), row, end)


def unpack(packed: DataFrame) -> DataFrame:
    """The pieces of packed rows: (doc_id, piece, n_ids, ids)."""
    at = F.posexplode(F.arrays_zip("doc_ids", "pieces"))
    rows = packed.select(F.col("ids").alias("_ids"), "cu_seqlens", at.alias("_i", "_p"))
    lo, hi = F.get("cu_seqlens", F.col("_i")), F.get("cu_seqlens", F.col("_i") + 1)
    return rows.select(F.col("_p.doc_ids").alias("doc_id"), F.col("_p.pieces").alias("piece"), (hi - lo).alias("n_ids"),
                       F.expr("substring(_ids, 2 * cu_seqlens[_i] + 1, 2 * (cu_seqlens[_i + 1] - cu_seqlens[_i]))").alias("ids"))


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet: the id matrix a row per row, with its
    segment lengths and resets beside it."""
    packed.write.parquet(path)
