"""Similarity join on word 5-grams: MinHash candidates, Bayesian pruning,
exact verification.

Texts with the same set of shingles form a class; the join works on classes.
Classes that agree on a band of MinHash values meet in a bucket.  There, the
values of a pair are compared a few at a time, and the pair is dropped as
soon as the posterior probability that its similarity reaches the threshold
falls below ``TOLERANCE`` (uniform prior; with m of n values equal it is the
chance of at most m successes in n + 1 trials at the threshold).  What is
left is verified on the whole shingle sets.  A pair that meets in several
buckets is handled in the first.  Large buckets are cut into chunks, each
packed into one record, and each two chunks meet in a block of their own, so
no task holds a whole bucket and pairs never become rows.  The number of
chunks grows with the root of a bucket, and so do the copies of a text.
"""
from __future__ import annotations

import hashlib
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.checks import may_be_among
from .common import stored
from .components import components

WORDS, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
#: MinHash values, and values per band: a pair at the threshold shares no band
#: with probability (1 - 0.8^4)^24 = 3e-6
VALUES, BAND = 96, 4
BANDS = VALUES // BAND
#: values compared between two looks at the posterior
STEP = 16
#: classes and shingles that a bucket may hold before it is cut, and shingles
#: that a chunk is to stay under however large the bucket
CHUNK, CHUNK_SHINGLES, MOST_SHINGLES = 512, 1_600_000, 8_000_000
#: word hashes that a worker remembers
CACHED_WORDS = 100_000


class _Hashes(dict):
    def __missing__(self, word):
        if len(self) > CACHED_WORDS:
            self.clear()
        self[word] = h = int.from_bytes(hashlib.blake2b(word.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")
        return h


_hashes = _Hashes()


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word 5-grams of a text, lower-cased
    and split at white space; a text of one to four words is one shingle."""
    words = (text or "").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_hashes.__getitem__, words), np.uint64, len(words))
    n = min(WORDS, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k:len(h) - n + 1 + k]
    out ^= out >> np.uint64(31)
    return np.unique(out * np.uint64(0xBF58476D1CE4E5B9))


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20_240_501)
    return (rng.integers(0, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1),
            rng.integers(0, 1 << 32, VALUES, dtype=np.uint32))


def minhash(s: np.ndarray) -> np.ndarray:
    """16 bits of each of VALUES MinHash values of a shingle set."""
    a, b = _permutations()
    x, low = (s >> np.uint64(32)).astype(np.uint32), np.full(VALUES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 4096):
        low = np.minimum(low, (a[:, None] * x[None, i:i + 4096] + b[:, None]).min(axis=1))
    low = low * np.uint32(0x85EBCA6B)
    return (low >> np.uint32(16)).astype(np.uint16)


@lru_cache(maxsize=1)
def least_matches() -> list[int]:
    """Equal values needed after STEP, 2 STEP, ... to go on with a pair."""
    def posterior(m, n):
        return sum(comb(n + 1, k) * THRESHOLD ** k * (1 - THRESHOLD) ** (n + 1 - k) for k in range(m + 1))
    return [next(m for m in range(n + 1) if posterior(m, n) >= TOLERANCE) for n in range(STEP, VALUES + 1, STEP)]


def surviving_pairs(sig: np.ndarray, band: np.ndarray, group: np.ndarray, side: np.ndarray):
    """Arrays (i, j) of the rows of a sorted run of groups whose pairs have
    this band as their first common one and pass every look.  ``side`` is
    negative in groups within one chunk; else only rows of different sides pair."""
    left, right = [], []
    for step in range(1, len(sig)):
        i = np.flatnonzero(group[:-step] == group[step:])
        if not len(i):
            break
        i = i[(side[i] < 0) | (side[i] != side[i + step])]
        for at in range(0, len(i), 20_000):
            p = i[at:at + 20_000]
            same = np.zeros(len(p), np.int16)
            seen = np.zeros(len(p), bool)
            for look, need in enumerate(least_matches()):
                eq = sig[p, look * STEP:(look + 1) * STEP] == sig[p + step, look * STEP:(look + 1) * STEP]
                per = eq.reshape(len(p), -1, BAND).all(axis=2)
                bands = np.arange(look * STEP // BAND, (look + 1) * STEP // BAND)
                seen |= (per & (bands[None, :] < band[p][:, None])).any(axis=1)
                same += eq.sum(axis=1, dtype=np.int16)
                on = (same >= need) & ~seen
                p, same, seen = p[on], same[on], seen[on]
                if not len(p):
                    break
            left.append(p)
            right.append(p + step)
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(left), np.concatenate(right)


def _features(batches):
    for batch in batches:
        text = batch.column("_text").to_pylist()
        keys, sizes, sigs = [], [], []
        for t in text:
            s = shingles(t)
            sizes.append(len(s))
            keys.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
            sigs.append(minhash(s).tobytes() if len(s) else None)
        rest = batch.drop_columns(["_text"])
        yield pa.RecordBatch.from_arrays(
            [*rest.columns, pa.array(keys, pa.binary()), pa.array(sizes, pa.int32()), pa.array(sigs, pa.binary())],
            names=[*rest.schema.names, "_key", "n_shingles", "_sig"])


def _flat(batches):
    """One row per member of the chunk records."""
    for batch in batches:
        members = batch.column("_members")
        parent, flat = pc.list_parent_indices(members), members.flatten()
        rest = batch.drop_columns(["_members"]).take(parent)
        yield pa.RecordBatch.from_arrays([*rest.columns, *flat.flatten()], names=[*rest.schema.names, *[f.name for f in flat.type]])


def _runs(batches, rows: int):
    """Tables of whole blocks, whose rows lie together; a table is cut only
    between two blocks."""
    held, n = [], 0
    for batch in _flat(batches):
        held.append(batch)
        n += batch.num_rows
        if n < rows:
            continue
        t = pa.Table.from_batches(held)
        block = t.column("_block").to_numpy(zero_copy_only=False)
        others = np.flatnonzero(block != block[-1])
        if len(others):
            cut = int(others[-1]) + 1
            yield t.slice(0, cut)
            held, n = t.slice(cut).combine_chunks().to_batches(), t.num_rows - cut
    if n:
        yield pa.Table.from_batches(held)


def _matrix(t: pa.Table) -> np.ndarray:
    return np.frombuffer(b"".join(t.column("_sig").to_pylist()), np.uint16).reshape(t.num_rows, VALUES)


def _pairs(t: pa.Table):
    return surviving_pairs(_matrix(t), *[t.column(c).to_numpy(zero_copy_only=False) for c in ("_band", "_block", "_side")])


def _prune(batches):
    for t in _runs(batches, 4096):
        i, j = _pairs(t)
        if len(i):
            on = t.take(pa.array(np.unique(np.concatenate([i, j])))).select(["_bucket", "_chunk", "_key"])
            yield from on.combine_chunks().to_batches()


def _find(root: np.ndarray, b: int) -> int:
    while root[b] != b:
        root[b] = root[root[b]]
        b = root[b]
    return b


def _verify(count: bool):
    """Exact links of every block.  Without ``count``, pairs that links found
    before already join are passed over, and only ``_to`` is of use."""
    def exact(t: pa.Table):
        i, j = _pairs(t)
        if not len(i):
            return None
        sets = [shingles(x) for x in t.column("_text").to_pylist()]
        sizes = np.array([len(s) for s in sets])
        _, ids = np.unique(np.concatenate(sets), return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        mark = np.zeros(int(ids.max()) + 1, np.int64)
        weight, links = t.column("_copies").to_numpy(), np.zeros(t.num_rows, np.int64)
        root = np.arange(t.num_rows)
        order = np.argsort(i, kind="stable")
        i, j = i[order], j[order]
        for a, lo in zip(*np.unique(i, return_index=True)):
            js = j[lo:np.searchsorted(i, a, "right")]
            if not count:
                mine = _find(root, a)
                js = np.array([b for b in js if _find(root, b) != mine], np.int64)
            mark[ids[starts[a]:starts[a + 1]]] = 1
            shared = np.array([mark[ids[starts[b]:starts[b + 1]]].sum() for b in js], np.int64)
            mark[ids[starts[a]:starts[a + 1]]] = 0
            # shared / (both - shared) >= 4/5, in whole numbers
            js = js[9 * shared >= 4 * (sizes[a] + sizes[js])]
            if len(js):
                links[a] += weight[js].sum()
                links[js] += weight[a]
                for b in js:  # the forest of the block
                    x, y = sorted((_find(root, a), _find(root, b)))
                    root[y] = x
        on = np.flatnonzero(links)
        keys = t.column("_key").to_pylist()
        return pa.RecordBatch.from_pydict({
            "_key": [keys[k] for k in on], "_links": pa.array(links[on], pa.int64()),
            "_to": [keys[_find(root, k)] for k in on]}) if len(on) else None

    def run(batches):
        for t in _runs(batches, 256):
            block = t.column("_block").to_numpy()
            cuts = [0, *(np.flatnonzero(block[1:] != block[:-1]) + 1), t.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                out = exact(t.slice(lo, hi - lo))
                if out is not None:
                    yield out
    return run


def _row_digest(docs: DataFrame, key: str, text_digest: Column) -> Column:
    """The same for rows that are equal in every column, other columns by a 64-bit hash."""
    rest = [F.col(f"`{c}`") for c, t in docs.dtypes if not t.startswith(("map", "variant"))]
    return F.md5(F.concat_ws(":", text_digest, F.xxhash64(*rest).cast("string"), F.col(key).cast("string")))


def features(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document, written to the shared folder: its key, the digests
    of its text and of the whole row, its shingle class, number of shingles and
    signature."""
    digest = F.md5(F.coalesce(F.col(text), F.lit("")))
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), digest.alias("_digest"), _row_digest(docs, key, digest).alias("_whole"),
                       F.col(text).alias("_text"))
    return stored(rows.mapInArrow(_features, "doc_id long, _digest string, _whole string, _key binary, n_shingles int, _sig binary")
                  .withColumn("_row", F.monotonically_increasing_id()), "shingles")


_AT = ("_bucket", "_chunk", "_chunks", "_band")


def _blocks(members: DataFrame) -> DataFrame:
    """Chunk records dealt to their blocks, those of a block one after the
    other: of a bucket of one chunk the record itself, else one record per
    chunk and other chunk.  ``_side`` is -1 where a chunk meets itself."""
    parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = [c for c in members.columns if c not in _AT]
    packed = stored(members.groupBy(*_AT).agg(F.collect_list(F.struct(*rest)).alias("_members")), "chunks")
    lone = packed.where("_chunks = 1").withColumn("_other", F.lit(0))
    many = packed.where("_chunks > 1").withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_chunks") - 1)))
    block = F.xxhash64("_bucket", F.least("_chunk", "_other"), F.greatest("_chunk", "_other"))
    side = F.when(F.col("_chunk") == F.col("_other"), -1).otherwise((F.col("_chunk") > F.col("_other")).cast("int"))

    def placed(df):
        return df.select("_bucket", "_chunk", "_band", block.alias("_block"), side.alias("_side"), "_members")
    return placed(lone).unionByName(placed(many).repartition(parts, "_block").sortWithinPartitions("_block"))


def links(rows: DataFrame, docs: DataFrame, text: str = "text", count: bool = True) -> DataFrame:
    """(_key, _links, _to): per block, the classes with links, the number of
    documents linked there and a class of the block that links lead to."""
    classes = stored(rows.where("_key IS NOT NULL").groupBy("_key").agg(
        F.count(F.lit(1)).alias("_copies"), F.min("_digest").alias("_digest"),
        F.first("n_shingles").alias("_n"), F.first("_sig").alias("_sig")), "classes")
    bands = classes.select("_key", "_n", F.posexplode(F.array(*[
        F.substring("_sig", 2 * BAND * b + 1, 2 * BAND) for b in range(BANDS)])).alias("_band", "_value"))
    bands = bands.select("_key", "_n", "_band", F.xxhash64("_band", "_value").alias("_bucket"))
    large = F.greatest(F.col("_c") / CHUNK, F.col("_all") / CHUNK_SHINGLES)
    chunks = F.greatest(F.ceil(F.sqrt(large)), F.ceil(F.col("_all") / MOST_SHINGLES)).cast("int")
    # written, so that AQE can split a bucket with many members in the join
    shared = stored(bands.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_c"), F.sum("_n").alias("_all")).where("_c > 1")
                    .select("_bucket", chunks.alias("_chunks")), "buckets")
    # members of other buckets need not be shuffled
    bands = bands.where(may_be_among(F.col("_bucket"), shared, "_bucket", shared.count()))
    members = bands.join(shared, "_bucket").select(
        "_bucket", F.pmod(F.xxhash64("_key", "_bucket"), F.col("_chunks")).cast("int").alias("_chunk"), "_chunks", "_band", "_key")
    members = stored(members, "members")
    near = _blocks(members.join(classes.select("_key", "_sig"), "_key")).mapInArrow(_prune, "_bucket long, _chunk int, _key binary").distinct()
    near = stored(near.join(members, ["_bucket", "_chunk", "_key"])
                  .join(classes.select("_key", "_copies", "_digest", "_sig"), "_key"), "candidates")
    # few texts are wanted; copies of a text are put together before they are shuffled
    wanted = stored(near.select("_digest").distinct().withColumn("_h", F.xxhash64("_digest")), "wanted")
    texts = docs.select(F.md5(F.coalesce(F.col(text), F.lit(""))).alias("_digest"), F.col(text).alias("_text"))
    texts = texts.where(may_be_among(F.xxhash64("_digest"), wanted, "_h", wanted.count())).dropDuplicates(["_digest"])
    texts = texts.join(wanted.select("_digest"), "_digest", "left_semi")
    return stored(_blocks(near.join(texts, "_digest").drop("_digest"))
                  .mapInArrow(_verify(count), "_key binary, _links long, _to binary"), "links")


def join_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", count: bool = True) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``n_links`` (other
    documents at a similarity of 0.8 or more; without ``count``, which saves
    the pairs that links already join, only a lower bound), ``component_id``
    (smallest id reached by links, its own included) and ``kept`` (one document
    of each component: the one with the smallest id).

    Texts are compared as sets of word 5-grams.  Null, empty and blank texts
    have no shingles, link with nothing and are kept.  Documents without id
    follow those with one; of rows with the same id the one with the smallest
    digest of all its columns is kept, of equal rows one.  Extra columns have
    no other part in it.
    """
    rows = features(docs, key, text)
    found = links(rows, docs, text, count)
    roots = components(found.select(F.col("_key").alias("a"), F.col("_to").alias("b")))
    # nulls last, then the whole row, then the order of the rows as written
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_whole", "_row")
    classes = rows.where("_key IS NOT NULL").groupBy("_key").agg(
        F.count(F.lit(1)).alias("_copies"), F.min(first).alias("_first"))
    classes = (classes.join(found.groupBy("_key").agg(F.sum("_links").alias("_links")), "_key", "left")
               .join(roots.select(F.col("node").alias("_key"), F.col("root").alias("_root")), "_key", "left")
               .withColumn("_root", F.coalesce("_root", "_key")))
    classes = stored(classes, "joined")
    tops = classes.groupBy("_root").agg(F.min("_first").alias("_top"))
    classes = stored(classes.join(tops, "_root").select(
        "_key", "_top", (F.col("_copies") - 1 + F.coalesce("_links", F.lit(0))).alias("_n")), "tops")
    shown = ("doc_id", "n_shingles", "n_links", "component_id", "kept", "_digest", "_whole", "_row")
    linked = rows.drop("_sig").join(classes, "_key").withColumns({
        "n_links": F.col("_n"), "component_id": F.col("_top.doc_id"), "kept": F.col("_top._row") == F.col("_row")})
    blank = rows.where("_key IS NULL").withColumns({
        "n_links": F.lit(0).cast("long"), "component_id": F.col("doc_id"), "kept": F.lit(True)})
    return linked.select(*shown).unionByName(blank.select(*shown))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``join_documents`` keeps, all columns.  Rows
    equal in every column count as one, also where their text is blank."""
    kept = join_documents(docs, key, text, count=False).where("kept").select(F.col("_whole").alias("__t_whole")).distinct()
    digest = _row_digest(docs, key, F.md5(F.coalesce(F.col(text), F.lit(""))))
    # equal rows are put together before they are shuffled, then join where they lie
    rows = docs.withColumn("__t_whole", digest).dropDuplicates(["__t_whole"])
    return rows.join(kept, "__t_whole", "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
