"""Scoring texts by online logistic context mixing.

A text is the sequence of its words (ASCII letters lower-cased) and one end.
Each is coded in its context, by the bits of its path in a tree of frequent
words (``contexts``): predictors hashed on the preceding words are mixed by
gated weights and refined.  A word that is not frequent ends at the leaf for
all others, and goes on with what does not depend on its place: whether it is
known at all, which of the known ones it is, and for a new word its spelling.

A new word is spelled by the bits of its bytes and of the space after it.
Several predictors give each bit a probability, each from the counts of the
bits seen after a context (position, the last 1 to 4 bytes, all bytes of the
word so far), kept in hashed tables that grow with the vocabulary.  They are
mixed and refined in the same way.

The learning words are counted over the corpus; each task then adds its words
to tables of its own, which are summed, learns weights of the spelling from
all its words, which are averaged, and sums refinements.  In learning, a word or
context does not see one occurrence of itself, so that the weights hold for
what was not met before.
"""
from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import contexts
from .common import stored

#: slots (powers of two) of the tables for position, 1, 2, 3, 4 bytes, all
#: bytes, for GROWN words or fewer; the last three double with the vocabulary
TABLE_BITS, GROWN, MOST_GROWTH = (16, 18, 18, 20, 21, 21), 4_000_000, 4
ORDERS = len(TABLE_BITS)
#: slots of a table that travel together
SEGMENT = 1 << 14
GATES, STEPS, REACH = 16 * 8 * 8, 33, 8.0
#: words that one task counts or learns from, words of an online step, learning rate
TASK_WORDS, BATCH_WORDS, RATE = 400_000, 4096, 0.05
#: words of a part of the joined vocabulary, tokens and documents of a chunk of texts
PART_WORDS, CHUNK_TOKENS, CHUNK_DOCS, PART_BYTES = 250_000, 500_000, 32_768, 64_000_000
#: bytes of text that are cut into words together, words that a task holds before it sends them on
PIECE_BYTES, HELD_WORDS = 4_000_000, 1_000_000
_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9)


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of all texts (bytes) one after another, and how many each text
    has: ASCII letters lower-cased, cut at [\x20\x09-\x0D]+."""
    wide = pa.types.is_large_binary(texts.type)
    low = pc.ascii_lower(texts.view(pa.large_string() if wide else pa.string()))
    cut = pc.ascii_split_whitespace(low)
    found = cut.flatten()
    real = pc.binary_length(found).to_numpy() > 0  # a text that begins or ends with a space has empty pieces
    before = np.concatenate([[0], np.cumsum(real)])
    ends = np.cumsum(pc.list_value_length(cut).to_numpy())
    return found.filter(pa.array(real)).view(pa.large_binary() if wide else pa.binary()).cast(pa.binary()), np.diff(before[ends], prepend=0)


def _some_texts(batch: pa.RecordBatch):
    """The batch in slices of about PIECE_BYTES of text."""
    ends = np.cumsum(pc.binary_length(batch.column("text")).to_numpy().astype(np.int64))
    at = 0
    while at < batch.num_rows:
        upto = int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PIECE_BYTES, "right"))
        upto = max(at + 1, upto)
        yield batch.slice(at, upto - at)
        at = upto


# ---------------------------------------------------------------- the model

class Bits:
    """The bytes of some words with the hashes of their contexts.  A byte after
    the same beginning of a word is there once (``of`` tells which byte of the
    words is which), as all contexts follow from the beginning."""

    def __init__(self, tokens: list[bytes]):
        flat = np.frombuffer(b" ".join(tokens) + b" ", np.uint8)
        sizes = np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1
        self.starts = np.cumsum(sizes) - sizes
        self.word = np.repeat(np.arange(len(tokens)), sizes)
        at = self.starts[self.word]
        pos = np.arange(len(flat)) - at
        wide = flat.astype(np.uint64)
        powers = np.full(len(flat) + 1, _A)
        powers[0] = 1
        powers = np.cumprod(powers)
        back = np.full(len(flat) + 1, np.uint64(pow(int(_A), -1, 1 << 64)))
        back[0] = 1
        back = np.cumprod(back)
        sums = np.concatenate([[np.uint64(0)], np.cumsum((wide + np.uint64(1)) * powers[:-1])])
        prefix = (sums[:-1] - sums[at]) * back[at]
        _, one, self.of = np.unique((prefix ^ (prefix >> np.uint64(31))) * _C + wide * _B, return_index=True, return_inverse=True)
        self.flat, self.pos = flat[one], pos[one]
        packed, contexts = np.zeros(len(one), np.uint64), [np.minimum(self.pos, 15).astype(np.uint64)]
        for k in range(4):
            last = np.where(self.pos > k, wide[one - k - 1], np.uint64(32))
            packed = packed | (last << np.uint64(8 * k))
            contexts.append(packed)
        contexts.append(prefix[one])
        self.hashes = []
        for k, c in enumerate(contexts):
            c = (c + np.uint64(k + 1)) * _B
            self.hashes.append(c ^ (c >> np.uint64(29)))

    def weights(self, counts: np.ndarray) -> np.ndarray:
        """Weight of each byte, from those of the words."""
        return np.bincount(self.of, counts.astype(np.float64)[self.word], len(self.flat))

    def plane(self, b: int):
        """(partial byte, bit) of bit b, the highest first."""
        byte = self.flat.astype(np.int64)
        return (1 << b) | (byte >> (8 - b)), (byte >> (7 - b)) & 1

    def slots(self, k: int, node: np.ndarray, table: np.ndarray) -> np.ndarray:
        x = (self.hashes[k] + node.astype(np.uint64) * _C) * _A
        return (x >> np.uint64(65 - len(table).bit_length())).astype(np.int64)


def empty_tables(words: int = 0) -> list[np.ndarray]:
    more = min(MOST_GROWTH, max(0, -(-words // GROWN) - 1).bit_length())
    return [np.zeros((1 << b + (more if k >= 3 else 0), 2), np.float32) for k, b in enumerate(TABLE_BITS)]


def count_into(tables: list[np.ndarray], tokens: list[bytes], counts: np.ndarray) -> None:
    bits = Bits(tokens)
    weight = np.tile(bits.weights(counts), 8)
    planes = [bits.plane(b) for b in range(8)]
    for k, table in enumerate(tables):
        at = np.concatenate([2 * bits.slots(k, node, table) + bit for node, bit in planes])
        table += np.bincount(at, weight, table.size).reshape(table.shape)


def _trust(total: np.ndarray, k: int) -> np.ndarray:
    """How often one of the two longest contexts was met, in a few steps."""
    scale, most = ((0.5, 7), (1, 15))[k - ORDERS + 2]
    return np.minimum(np.log2(total + np.float32(1)) * np.float32(scale), np.float32(most)).astype(np.uint8)


def _logit(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.log((n1 + np.float32(0.4)) / (n0 + np.float32(0.4)))


class Mixer:
    """Weights and refinement over frozen tables."""

    def __init__(self, tables, weights=None, refined=None):
        self.tables = tables
        self.weights = np.full((GATES, ORDERS + 1), 0.3, np.float32) if weights is None else weights.astype(np.float32)
        self.refined = np.zeros(512 * STEPS * 2) if refined is None else refined
        self.seen = np.full(self.weights.shape, 1e-2)
        self.frozen = None

    def _mix(self, bits: Bits, node: np.ndarray, b: int, inputs, trust):
        gate = trust[1].astype(np.int64) * 64 + trust[0].astype(np.int64) * 8 + b
        logit = 0.3 * self.weights[gate, ORDERS]
        for k, x in enumerate(inputs):
            logit += x * self.weights[gate, k]
        np.clip(logit, -12, 12, out=logit)
        step = np.rint((np.clip(logit, -REACH, REACH) + np.float32(REACH)) * np.float32((STEPS - 1) / (2 * REACH))).astype(np.int64)
        return gate, 1 / (1 + np.exp(-logit.astype(np.float64))), ((node + 256 * (bits.pos == 0)) * STEPS + step) * 2

    def learn(self, tokens: list[bytes], counts: np.ndarray) -> None:
        """One online step per bit position; a word weighs its count."""
        bits = Bits(tokens)
        weight = bits.weights(counts)
        for b in range(8):
            node, bit = bits.plane(b)
            itself, inputs, trust = np.stack([bit == 0, bit == 1], 1).astype(np.float32), [], []
            for k, table in enumerate(self.tables):
                # both counts of a slot as one value of 8 bytes
                n = table.view(np.int64).ravel()[bits.slots(k, node, table)].view(np.float32).reshape(-1, 2)
                n0, n1 = np.maximum(n - itself, 0).T  # without one occurrence
                inputs.append(_logit(n0, n1))
                if k >= ORDERS - 2:
                    trust.append(_trust(n0 + n1, k))
            gate, p, cell = self._mix(bits, node, b, inputs, trust)
            err, total = (bit - p) * weight, np.bincount(gate, weight, GATES)
            inputs.append(np.full(len(bit), 0.3))
            grad = np.stack([np.bincount(gate, err * x, GATES) for x in inputs], 1) / np.maximum(total, 1e-9)[:, None]
            self.seen += grad ** 2
            self.weights += (RATE * grad / np.sqrt(self.seen)).astype(np.float32)
            self.refined += np.bincount(cell + bit, weight, len(self.refined))

    def score(self, tokens: list[bytes]) -> np.ndarray:
        """log10 of the probability of each token, its space counted."""
        if self.frozen is None:
            self.frozen = ([_logit(t[:, 0], t[:, 1]) for t in self.tables],
                           [_trust(t.sum(axis=1), k) for k, t in enumerate(self.tables) if k >= ORDERS - 2])
        logits, trusts = self.frozen
        bits = Bits(tokens)
        total = np.zeros(len(bits.flat))
        for b in range(8):
            node, bit = bits.plane(b)
            slots = [bits.slots(k, node, t) for k, t in enumerate(self.tables)]
            _, p, cell = self._mix(bits, node, b, [x[i] for x, i in zip(logits, slots)],
                                   [x[i] for x, i in zip(trusts, slots[-2:])])
            n0, n1 = self.refined[cell], self.refined[cell + 1]
            p = (p + (n1 + 2 * p) / (n0 + n1 + 2)) / 2
            total += np.log10(np.where(bit == 1, p, 1 - p))
        return np.add.reduceat(total[bits.of], bits.starts)


# ----------------------------------------------------------- corpus counts

def _hash(tokens) -> np.ndarray:
    import xxhash
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens)).view(np.int64)


def _count_words(batches):
    """(token, n) of the texts of a task: n learning occurrences, 0 for words
    of held-out texts alone."""
    held, rows = [], 0

    def summed():
        t = pa.concat_tables(held).group_by("token", use_threads=False).aggregate([("n", "sum")])
        return pa.table([t.column("token"), t.column("n_sum")], names=["token", "n"])

    def sent(t):
        return t.combine_chunks().to_batches(50_000)
    for whole in batches:
        for batch in _some_texts(whole):
            for out in (False, True):
                texts = batch.column("text").filter(pc.equal(batch.column("held_out"), out))
                if not len(texts):
                    continue
                seen = words(texts)[0].value_counts()
                counts = np.append(seen.field("counts").to_numpy(), len(texts))  # and as many ends
                held.append(pa.table([pa.concat_arrays([seen.field("values"), pa.array([b""], pa.binary())]),
                                      pa.array(np.zeros_like(counts) if out else counts)], names=["token", "n"]))
                rows += len(counts)
            if rows > 2 * HELD_WORDS:
                held = [summed()]
                rows = len(held[0])
                if rows > HELD_WORDS:
                    yield from sent(held[0])
                    held, rows = [], 0
    if held:
        yield from sent(summed())


def vocabulary(texts: DataFrame) -> DataFrame:
    """(token, n) over all texts, in the shared folder; n counts learning texts."""
    counted = texts.select("held_out", F.col("_text").cast("binary").alias("text")).mapInArrow(_count_words, "token binary, n long")
    return stored(counted.groupBy("token").agg(F.sum("n").alias("n")), "vocabulary")


def _batched(batches, size: int):
    for batch in batches:
        for lo in range(0, batch.num_rows, size):
            part = batch.slice(lo, size)
            yield part.column("token").to_numpy(zero_copy_only=False).tolist(), part.column("n").to_numpy()


def _tables(words: int, groups: int):
    def run(batches):
        tables = empty_tables(words)
        for tokens, n in _batched(batches, 40_000):
            if (on := np.flatnonzero(n)).size:
                count_into(tables, [tokens[i] for i in on], n[on])
        task = TaskContext.get().partitionId() % groups
        for k, table in enumerate(tables):
            for s in range(0, len(table), SEGMENT):
                part = table[s:s + SEGMENT]
                if part.any():
                    yield pa.RecordBatch.from_pydict({"k": pa.array([k], pa.int32()), "segment": pa.array([s], pa.int32()),
                                                      "task": pa.array([task], pa.int32()), "counts": pa.array([part.tobytes()], pa.binary())})
    return run


def _sum_by_segment(key: tuple, t: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(x.as_buffer(), np.float32).astype(np.float64) for x in t.column("counts"))
    return pa.table({"k": pa.array([key[0].as_py()], pa.int32()), "segment": pa.array([key[1].as_py()], pa.int32()),
                     "task": pa.array([key[2].as_py() if len(key) > 2 else 0], pa.int32()), "counts": pa.array([total.astype(np.float32).tobytes()], pa.binary())})


def _learn(tables):
    def run(batches):
        mixer, total = Mixer(tables.value), 0
        for tokens, n in _batched(batches, BATCH_WORDS):
            if (on := np.flatnonzero(n)).size:
                mixer.learn([tokens[i] for i in on], n[on])
                total += len(on)
        values = np.concatenate([mixer.weights.ravel() * total, [total], mixer.refined])
        at = np.flatnonzero(values)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(values[at])], names=["at", "value"])
    return run


def learn(vocab: DataFrame, size: int):
    """Tables (broadcast), weights and refinement (broadcast together) of the
    spelling from the counted words."""
    spark = vocab.sparkSession
    known = vocab.where("n > 0").select("token", "n")
    tasks = max(1, -(-size // TASK_WORDS))
    split, groups = known.coalesce(tasks), -(-tasks // 64)
    kind = "k int, segment int, task int, counts binary"
    sums = split.sortWithinPartitions("token").mapInArrow(_tables(size, groups), kind).groupBy("k", "segment", "task").applyInArrow(_sum_by_segment, kind)
    if groups > 1:  # in two steps, so that no group has a piece from every task
        sums = sums.groupBy("k", "segment").applyInArrow(_sum_by_segment, kind)
    sums = sums.drop("task")
    tables = empty_tables(size)
    for k, at, counts in zip(*[c.to_pylist() for c in sums.toArrow().columns]):
        tables[k][at:at + SEGMENT] = np.frombuffer(counts, np.float32).reshape(-1, 2)
    shared = spark.sparkContext.broadcast(tables)
    n = GATES * (ORDERS + 1)
    values = np.zeros(n + 1 + 512 * STEPS * 2)
    found = (split.sortWithinPartitions("token").mapInArrow(_learn(shared), "at int, value double")
             .groupBy("at").agg(F.sum("value").alias("value")).toArrow())
    values[found.column("at").to_numpy()] = found.column("value").to_numpy()
    weights = values[:n] / values[n] if values[n] else np.full(n, 0.3)
    return shared, spark.sparkContext.broadcast((weights.reshape(GATES, ORDERS + 1), values[n + 1:]))


def frequent(vocab: DataFrame, n: int, share_bits: int = contexts.SHARE_BITS) -> contexts.Symbols:
    """The words with a 2^-share_bits share of the learning ones or more, and
    the end: 2^share_bits and one at most."""
    least = max(2, n >> share_bits)
    rows = vocab.where((F.col("n") >= least) | ((F.octet_length("token") == 0) & (F.col("n") > 0))).select("token", "n").toArrow()
    tokens, counts = rows.column("token").to_pylist(), rows.column("n").to_numpy().astype(np.int64)
    order = sorted(range(len(tokens)), key=lambda i: (-counts[i], tokens[i]))
    return contexts.Symbols(_hash([tokens[i] for i in order]).view(np.uint64), counts[order], n)


def _score_words(tables, learned, symbols, parts: int, rare: int, once: int):
    """(part, body): the words of a task by part of the vocabulary, as hashes,
    counts and the part of their score that does not depend on their place:
    none for frequent words; for others whether they are known (new words come
    as often as those met once), and their share of these or their spelling."""
    def run(batches):
        mixer, held = Mixer(tables.value, *learned.value), []
        new = (once + 0.5) / (rare + 1)

        def flush():
            h, n, score = [np.concatenate([x[i] for x in held]) for i in range(3)]
            part = _part(h, parts)
            for p in np.unique(part):
                on = part == p
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([p], pa.int32()),
                    "body": pa.array([h[on].tobytes() + n[on].tobytes() + score[on].tobytes()], pa.binary())})
            held.clear()
        for tokens, n in _batched(batches, 10_000):
            if tokens:
                n = n.astype(np.int64)
                h = _hash(tokens)
                other = symbols.value.of(h.view(np.uint64)) == contexts.OTHER
                score = np.where(other & (n > 0), np.log10(1 - new) + np.log10(np.maximum(n, 1) / max(rare, 1)), 0.0)
                unknown = np.flatnonzero(other & (n == 0))
                if len(unknown):
                    score[unknown] = np.log10(new) + mixer.score([tokens[i] for i in unknown])
                held.append((h, n, score))
            if len(held) == 100:
                yield from flush()
        if held:
            yield from flush()
    return run


def _part(h: np.ndarray, parts: int) -> np.ndarray:
    return (h.view(np.uint64) % np.uint64(parts)).astype(np.int64)


# ------------------------------------------------------ words to documents

def _in_context(symbols, h: np.ndarray, tok: np.ndarray, sizes: np.ndarray, places: int, place_tokens: int):
    """Place and key of every word of a chunk by the words before it (before a
    text there are none: hash 0)."""
    symbol = symbols.of(h)
    cuts = np.ones(len(h), np.int64)
    on = symbol > 0
    cuts[on] = np.maximum(1, -(-symbols.counts[symbol[on] - 1].astype(np.int64) // max(1, place_tokens // 2)))
    starts = np.cumsum(sizes) - sizes

    def before(values, none):
        out = np.empty_like(values)
        out[1:] = values[:-1]
        out[starts] = none
        return out
    one = before(h[tok], 0)
    two = before(one, 0)
    three, cuts, symbol = before(two, 0), before(cuts[tok], 1), symbol[tok]
    place, key = np.empty(len(tok), np.int64), np.empty(len(tok), np.uint64)
    for lo in range(0, len(tok), contexts.AT_ONCE):
        on = slice(lo, lo + contexts.AT_ONCE)
        place[on], key[on] = contexts.place_and_key(one[on], two[on], three[on], symbol[on], cuts[on], places)
    return place, key


def _chunks(parts: int, symbols, places: int, place_tokens: int):
    """Chunks of documents as one row per part of the vocabulary: the hashes
    of the chunk's words in that part, and for each the documents with it and
    how often they hold it; part 0 also lists the documents.  And one row per
    place: the chunk's words in context."""
    def chunk(number, docs, pieces, sizes):
        sizes = np.array(sizes)
        coded = pa.chunked_array(pieces, pa.binary()).dictionary_encode().chunks
        known = coded[0].dictionary  # the same for all
        tok = np.concatenate([x.indices.to_numpy() for x in coded]).astype(np.int64)
        lengths = np.concatenate([[0], np.cumsum(pc.binary_length(known).to_numpy()[tok], dtype=np.int64)])
        ends = np.cumsum(sizes)
        n_bytes = np.diff(lengths[ends], prepend=0)
        tok = np.insert(tok, ends, len(known))
        sizes = sizes + 1
        doc_of, held = np.repeat(np.arange(len(docs)), sizes), np.array([o for _, o in docs], bool)
        h = _hash([*known.to_numpy(zero_copy_only=False), b""])
        place, key = _in_context(symbols.value, h.view(np.uint64), tok, sizes, places, place_tokens)
        by = np.argsort(place.astype(np.uint16) if places <= 1 << 16 else place, kind="stable")
        ends = np.searchsorted(place[by], np.arange(places + 1))
        packed = [(p, contexts.pack(key[by[lo:hi]], doc_of[by[lo:hi]], held)) for p, (lo, hi) in enumerate(zip(ends, ends[1:])) if hi > lo]
        pair, times = np.unique(tok * len(docs) + doc_of, return_counts=True)
        part = _part(h, parts)
        order = np.argsort(part[pair // len(docs)].astype(np.uint16) if parts <= 1 << 16 else part[pair // len(docs)], kind="stable")
        pair, times = pair[order], times[order]
        of = part[pair // len(docs)]
        size = n_bytes + sizes
        cuts = np.searchsorted(of, np.arange(parts + 1))
        rows = []
        for p in range(parts):
            own, n = pair[cuts[p]:cuts[p + 1]], times[cuts[p]:cuts[p + 1]]
            which, counts = np.unique(own // len(docs), return_counts=True)
            rows.append(struct.pack("<qqq", len(docs), len(which), len(own)) + h[which].tobytes()
                        + counts.astype(np.int32).tobytes() + (own % len(docs)).astype(np.uint16).tobytes()
                        + n.astype(np.uint32).tobytes())
        listed = [None] * parts
        listed[0] = [{"doc_id": d, "held_out": o, "n_tokens": int(n), "n_bytes": int(b)} for (d, o), n, b in zip(docs, sizes, size)]
        rows += [body for _, body in packed]
        return pa.RecordBatch.from_arrays(
            [pa.array([*range(parts), *[-1 - p for p, _ in packed]], pa.int32()), pa.array([number] * len(rows), pa.int64()), pa.array(rows, pa.binary()),
             pa.array(listed + [None] * len(packed), _DOCS)], names=["part", "chunk", "body", "docs"])

    def run(batches):
        number, docs, pieces, sizes, held = TaskContext.get().partitionId() << 32, [], [], [], 0
        for whole in batches:
            for batch in _some_texts(whole):
                found, own = words(batch.column("text"))
                at = upto = 0
                for d, out, n in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "held_out")], own.tolist()):
                    docs.append((d, out))
                    sizes.append(n)
                    held, upto = held + n + 1, upto + n
                    if held >= CHUNK_TOKENS or len(docs) == CHUNK_DOCS:
                        yield chunk(number, docs, [*pieces, found[at:upto]], sizes)
                        number, docs, pieces, sizes, held, at = number + 1, [], [], [], 0, upto
                pieces.append(found[at:])
        if docs:
            yield chunk(number, docs, pieces, sizes)
    return run


_DOCS = pa.list_(pa.struct([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_bytes", pa.int64())]))


def _look_up(n: int, v: int, symbols, entries: int | None):
    """Rows sorted by (place, kind): first the words of a part of the
    vocabulary, then the chunks that ask for them; or all chunks that have
    words in contexts of a place (kind 2)."""
    least = np.log10(n + 0.1 * (v + 1))

    def answer(body, docs, chunk, h, known, base, score):
        total, k, m = struct.unpack_from("<qqq", body)
        at, out = 24, []
        for kind, size in ((np.int64, k), (np.int32, k), (np.uint16, m), (np.uint32, m)):
            out.append(np.frombuffer(body, kind, size, at))
            at += out[-1].nbytes
        ask, counts, doc, times = out
        i = np.searchsorted(h, ask)
        if k and (len(h) == 0 or (h[np.minimum(i, len(h) - 1)] != ask).any()):
            raise RuntimeError("a word of the texts is not in their vocabulary")
        i = np.repeat(i, counts)
        sums = [np.bincount(doc, x[i] * times, total) for x in (known, base, score)]
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int64()), *[pa.array([x.tobytes()], pa.binary()) for x in sums], pa.array([docs], _DOCS)],
            names=["chunk", "known", "base", "score", "docs"])

    def in_context(held):
        for chunk, sums in zip([c for c, _ in held], contexts.answer(symbols.value, [b for _, b in held], entries != 0)):
            none = np.zeros(len(sums)).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int64()), *[pa.array([x], pa.binary()) for x in (none, none, sums.tobytes())],
                                              pa.array([None], _DOCS)], names=["chunk", "known", "base", "score", "docs"])

    def run(batches):
        place, held, ready, waiting = None, [], None, []
        for batch in batches:
            places, kinds = batch.column("place").to_numpy(), batch.column("kind").to_numpy()
            mark = places.astype(np.int64) * 2 + kinds
            cuts = [0, *(np.flatnonzero(mark[1:] != mark[:-1]) + 1), len(mark)]
            for lo, hi in zip(cuts, cuts[1:]):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if places[lo] != place:
                    if waiting:
                        yield from in_context(waiting)
                    place, held, ready, waiting = places[lo], [], None, []
                if kinds[lo] == 2:
                    waiting += [(c.as_py(), b.as_py()) for c, b in zip(part.column("chunk"), part.column("body"))]
                    continue
                if kinds[lo] == 0:
                    held += [[np.frombuffer(x.as_buffer(), kind).reshape(3, -1) for kind in (np.int64, np.float64)]
                             for x in part.column("body")]
                    continue
                if ready is None:
                    whole, real = [np.concatenate([x[i] for x in held] or [np.zeros((3, 0), (np.int64, np.float64)[i])], 1) for i in (0, 1)]
                    order = np.argsort(whole[0])
                    h, c, s = whole[0][order], whole[1][order], real[2][order]
                    ready = h, (c > 0).astype(float), np.log10(c + 0.1) - least, s
                for body, docs, chunk in zip(*[part.column(x) for x in ("body", "docs", "chunk")]):
                    yield answer(body.as_buffer(), docs.as_py(), chunk.as_py(), *ready)
        if waiting:
            yield from in_context(waiting)
    return run


def _add_up(key: tuple, t: pa.Table) -> pa.Table:
    known, base, score = [sum(np.frombuffer(x.as_buffer()) for c in t.column(name).chunks for x in c) for name in ("known", "base", "score")]
    docs = next(d for d in t.column("docs").to_pylist() if d is not None)
    return pa.table({
        "doc_id": pa.array([d["doc_id"] for d in docs], pa.int64()), "held_out": pa.array([d["held_out"] for d in docs], pa.bool_()),
        "n_tokens": pa.array([d["n_tokens"] for d in docs], pa.int64()), "n_bytes": pa.array([d["n_bytes"] for d in docs], pa.int64()),
        "n_known": pa.array(np.rint(known).astype(np.int64)), "base_score": pa.array(base), "score": pa.array(score)})


def score_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", share_bits: int = contexts.SHARE_BITS,
                    place_tokens: int = contexts.PLACE_TOKENS, learn_entries: int | None = None) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out`` (crc32 of the id as text
    is a multiple of 10; a null id counts as ''), ``n_tokens``, ``n_known``
    (tokens among the learning ones), ``train_tokens``, ``base_score`` (log10,
    add-0.1 unigram), ``score`` (log10, the model) and ``bits_per_byte`` (of
    the model, over words and one byte after each).

    Null and empty texts are one end; repeated rows are scored each; an empty
    table gives no rows; extra columns are ignored.  Words are joined by
    64-bit hashes, contexts by hashes of 28 bits and the place.  The vocabulary
    is in the shared folder; texts travel as counts of hashes and as packed
    contexts; no part of the vocabulary is larger than PART_WORDS, and no place
    larger than ``place_tokens``, on average.  Weights are learned from all
    learning words and contexts (``learn_entries=0``: those of contexts not at all).
    """
    out = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit(""))) % 10 == 0
    texts = docs.select(F.col(key).cast("long").alias("doc_id"), out.alias("held_out"),
                        F.coalesce(F.col(text), F.lit("")).alias("_text"))
    vocab = vocabulary(texts)
    n, v, size, once, every = vocab.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if(F.col("n") > 0), F.count(F.lit(1)), F.count_if(F.col("n") == 1),
                                        F.coalesce(F.sum(F.greatest("n", F.lit(1))), F.lit(0))).first()
    context = docs.sparkSession.sparkContext
    tables, learned = learn(vocab, size)
    symbols = context.broadcast(frequent(vocab, n, share_bits))
    parts = max(4, -(-size // PART_WORDS))
    places = max(4, -(-int(1.2 * every) // place_tokens))
    rare = int(n - symbols.value.counts.sum())
    copies = max(1, -(-6 * n // (parts * PART_BYTES)))  # of each part, so that no task reads all chunks
    scored = (vocab.select("token", "n").sortWithinPartitions("token")  # common beginnings are scored once
              .mapInArrow(_score_words(tables, learned, symbols, parts, rare, once), "part int, body binary")
              .withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))))
    scored = scored.select((F.col("part") * copies + F.col("_copy")).cast("int").alias("place"), F.lit(0).alias("kind"), "body")
    listed = "docs array<struct<doc_id:bigint,held_out:boolean,n_tokens:bigint,n_bytes:bigint>>"
    chunks = texts.select("doc_id", "held_out", F.col("_text").cast("binary").alias("text")).mapInArrow(
        _chunks(parts, symbols, places, place_tokens), f"part int, chunk long, body binary, {listed}")
    in_context = F.col("part") < 0
    place = F.when(in_context, parts * copies - 1 - F.col("part")).otherwise(F.col("part") * copies + F.pmod(F.xxhash64("chunk"), F.lit(copies)))
    chunks = chunks.select(place.cast("int").alias("place"), F.when(in_context, 2).otherwise(1).alias("kind"), "chunk", "body", "docs")
    both = scored.unionByName(chunks, allowMissingColumns=True)
    asked = (both.repartition(parts * copies + places, "place").sortWithinPartitions("place", "kind")
             .mapInArrow(_look_up(n, v, symbols, learn_entries), f"chunk long, known binary, base binary, score binary, {listed}"))
    summed = asked.groupBy("chunk").applyInArrow(
        _add_up, "doc_id long, held_out boolean, n_tokens long, n_bytes long, n_known long, base_score double, score double")
    return summed.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), "base_score", "score",
                         (-F.col("score") * float(np.log2(10)) / F.col("n_bytes")).alias("bits_per_byte"))
