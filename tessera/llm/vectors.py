"""Near-duplicate vectors by an inverted multi-index.

Each unit vector is split in two halves with a codebook each; the pairs of
codewords form a grid of cells, and every vector lies in one cell (of its
label).  To find a vector's neighbours its cells are visited in the order of
the distance from the vector to their codewords (multi-sequence traversal)
until the target recall is reached: the distance at which to stop is
calibrated on a bounded sample, as the quantile of the distances at which
neighbours exactly on the threshold, in random directions, are found.
Pairs met in a cell are verified in double precision.

Vectors of each length have an index of their own.  Work on a cell is cut into
blocks of bounded size, computed as matrix products; a block yields one row
per linked vector, never its pairs.
"""
from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components

THRESHOLD = 0.93
#: share of the farthest neighbours that count which the traversal is to meet
#: from one side alone; nearer ones, and pairs met from either side, do better
RECALL = 0.99
#: rows that the codebooks and the stop of all lengths are fitted on (up to
#: MOST_SAMPLE for large books), codewords per half, and vectors per cell that
#: their number aims at: up to 4e9 vectors of a length the grid grows with them
SAMPLE, MOST_SAMPLE, LEAST_WORDS, MOST_WORDS, CELL_ROWS = 8192, 65_536, 8, 4096, 256
#: lengths that get an index, those with most vectors; the vectors of any other
#: length (and label) lie in one cell and meet in its blocks
INDEXED = 16
#: residents and visitors of a block
RESIDENTS, VISITORS = 1024, 4096


def kmeans(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    rng = np.random.default_rng(7)
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        near = np.concatenate([_squares(x[i:i + 4096], centres).argmin(axis=1) for i in range(0, len(x), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0, None]
    return centres


def _squares(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x ** 2).sum(1)[:, None] - 2 * x @ centres.T + (centres ** 2).sum(1)[None], 0)


class OneCell:
    """The index of lengths that have none: everything in cell 0."""

    def visits(self, x):
        return [np.zeros(1, np.int32)] * len(x)

    def goes(self, x, cells):
        return np.ones((len(x), len(cells)), bool)


class MultiIndex:
    """Two codebooks and the distance at which a traversal may stop."""

    def __init__(self, sample: np.ndarray, words: int, threshold: float = THRESHOLD, recall: float = RECALL):
        self.half = sample.shape[1] // 2
        parts = sample[:, :self.half], sample[:, self.half:]
        self.books = [kmeans(p, words) for p in parts]
        rng = np.random.default_rng(11)
        aside = rng.normal(size=sample.shape)
        aside -= (aside * sample).sum(1, keepdims=True) * sample
        length = np.linalg.norm(aside, axis=1, keepdims=True)
        near = threshold * sample + np.sqrt(1 - threshold ** 2) * aside / np.where(length > 0, length, 1)
        over = [self.detours(sample[i:i + 4096], self.cells(near[i:i + 4096])) for i in range(0, len(sample), 4096)]
        self.stop = float(np.quantile(np.concatenate(over), recall)) if len(sample) else 0.0

    @property
    def width(self) -> int:
        return len(self.books[1])

    def distances(self, x):
        return _squares(x[:, :self.half], self.books[0]), _squares(x[:, self.half:], self.books[1])

    def cells(self, x: np.ndarray) -> np.ndarray:
        a, b = self.distances(x)
        return a.argmin(1) * self.width + b.argmin(1)

    def detours(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """How much farther than its own each vector's given cell is."""
        a, b = self.distances(x)
        i = np.arange(len(x))
        return a[i, cells // self.width] + b[i, cells % self.width] - a.min(1) - b.min(1)

    def goes(self, x: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """Whether each vector (rows) visits each cell (columns), as ``visits`` has it."""
        a, b = self.distances(x)
        d = a[:, cells // self.width] + b[:, cells % self.width]
        return d <= (a.min(1) + b.min(1))[:, None] + self.stop

    def visits(self, x: np.ndarray) -> list[np.ndarray]:
        """For each vector the cells to visit, nearest first; the first is its own."""
        out = []
        for i in range(0, len(x), 1024):
            for a, b in zip(*self.distances(x[i:i + 1024])):
                out.append(np.array(self._walk(a, b), dtype=np.int32))
        return out

    def _walk(self, a: np.ndarray, b: np.ndarray) -> list[int]:
        p, q = a.argsort(kind="stable"), b.argsort(kind="stable")
        a, b = a[p], b[q]
        limit, found, queue, done = a[0] + b[0] + self.stop, [], [(a[0] + b[0], 0, 0)], set()
        while queue:
            d, i, j = heapq.heappop(queue)
            if d > limit:
                break
            found.append(int(p[i]) * self.width + int(q[j]))
            done.add((i, j))
            # a cell is next when its neighbours nearer in both halves are done
            if i + 1 < len(a) and (j == 0 or (i + 1, j - 1) in done):
                heapq.heappush(queue, (a[i + 1] + b[j], i + 1, j))
            if j + 1 < len(b) and (i == 0 or (i - 1, j + 1) in done):
                heapq.heappush(queue, (a[i] + b[j + 1], i, j + 1))
        return found


def _vectors(column) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)  # so that no square overflows or vanishes
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _assign(shared):
    """Adds the cells that each vector visits; batches hold vectors of all lengths."""
    def run(batches):
        for batch in batches:
            vec = batch.column("_vec")
            widths = pc.list_value_length(vec).to_numpy(zero_copy_only=False)
            visits = [None] * batch.num_rows
            for w in np.unique(widths):
                at = np.flatnonzero(widths == w)
                index = shared.value.get(int(w), OneCell())
                for i, cells in zip(at, index.visits(_unit(_vectors(vec.take(pa.array(at)))))):
                    visits[i] = cells
            if batch.num_rows:
                offsets = np.concatenate([[0], np.cumsum([len(v) for v in visits])]).astype(np.int32)
                cells = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(visits)))
                yield pa.RecordBatch.from_arrays([*batch.columns, cells], names=[*batch.schema.names, "_visits"])
    return run


def link_block(own: dict, guests: dict, threshold: float, index):
    """Links between the residents of a cell and vectors that visit it, as
    (links of residents, links of visitors, forest).

    A visitor counts the residents it links with; a resident counts the
    visitor only where it does not itself visit the visitor's cell, as it
    counts it there otherwise."""
    near = own["vec"] @ guests["vec"].T >= threshold
    near &= own["id"][:, None] != guests["id"][None, :]
    homes, at = np.unique(guests["home"], return_inverse=True)
    goes = index.goes(own["vec"], homes)
    weights = near * guests["copies"][None, :]
    to_own = (weights * ~goes[:, at]).sum(axis=1)
    to_guests = (near * own["copies"][:, None]).sum(axis=0)
    return to_own, to_guests, _forest(near, own["id"], guests["id"])


def _forest(near: np.ndarray, own: np.ndarray, guests: np.ndarray) -> list[tuple[int, int]]:
    """(id, smallest id that links of the matrix lead to), where they differ."""
    far = np.iinfo(np.int64).max
    a, b = own.copy(), guests.copy()
    while True:
        # an id can be on both sides: it has one label
        a2 = np.minimum(a, np.where(near, b[None, :], far).min(axis=1))
        b2 = np.minimum(b, np.where(near, a2[:, None], far).min(axis=0))
        ids, at = np.unique(np.concatenate([own, guests]), return_inverse=True)
        low = np.full(len(ids), far)
        np.minimum.at(low, at, np.concatenate([a2, b2]))
        a2, b2 = low[at[:len(a)]], low[at[len(a):]]
        if (a2 == a).all() and (b2 == b).all():
            return [(int(i), int(r)) for i, r in zip(ids, low) if i != r]
        a, b = a2, b2


def _verify(threshold: float, shared):
    def run(t: pa.Table) -> pa.Table:
        vec = _unit(_vectors(t.column("_vec")))
        index = shared.value.get(vec.shape[1], OneCell())
        ids, copies = t.column("_id").to_numpy(), t.column("_copies").to_numpy()
        home = t.column("_home").to_numpy()
        guest = t.column("_guest").to_numpy(zero_copy_only=False).astype(bool)

        def side(on):
            return {"vec": vec[on], "id": ids[on], "copies": copies[on], "home": home[on]}
        own, guests = side(~guest), side(guest)
        links, edges = {}, []
        if len(own["id"]) and len(guests["id"]):
            to_own, to_guests, edges = link_block(own, guests, threshold, index)
            for who, n in ((own["id"], to_own), (guests["id"], to_guests)):
                for i in np.flatnonzero(n):
                    links[int(who[i])] = links.get(int(who[i]), 0) + int(n[i])
        to = dict(edges)
        rows = sorted({*links, *to})
        return pa.table({"_id": pa.array(rows, pa.int64()), "_links": pa.array([links.get(i, 0) for i in rows], pa.int64()),
                         "_to": pa.array([to.get(i, i) for i in rows], pa.int64())})
    return run


def fit(points: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> dict[int, MultiIndex]:
    """An index for each of the INDEXED lengths with most vectors, fitted on
    MOST_SAMPLE vectors in all at most."""
    width = F.size("_vec")
    sizes = points.groupBy(width.alias("w")).count().orderBy(F.desc("count"), "w").limit(INDEXED).collect()
    words = {r.w: int(np.clip(np.sqrt(r["count"] / CELL_ROWS), LEAST_WORDS, MOST_WORDS)) for r in sizes if r.w > 1}
    out = {}
    for w, k in words.items():
        n = min(max(SAMPLE, 16 * k), MOST_SAMPLE) // len(words)
        drawn = points.where(width == w).select("_vec").orderBy(F.xxhash64("_vec")).limit(n).toArrow().column("_vec")
        out[w] = MultiIndex(_unit(_vectors(drawn)), k, threshold, recall)
    return out


def near_duplicates(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                    threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id`` (smallest
    id reached by links, its own included) and ``kept`` (the smallest id of
    its component).

    Only vectors of equal labels and lengths link.  Null labels and ids, null
    or empty vectors, zeros, and null or non-finite components link with
    nothing.  Equal vectors of a label are one point with copies.  A repeated
    id keeps a row for each of its vectors, linked by what the vector links
    with; extra columns are ignored.
    """
    spark = table.sparkSession
    kind = "float" if dict(table.dtypes)[vector] == "array<float>" else "double"
    rows = table.select(F.col(key).cast("long").alias("_id"), F.col(label).alias("_label"),
                        F.transform(F.col(vector).cast(f"array<{kind}>"), lambda x: (x + F.lit(0.0).cast(kind)).cast(kind)).alias("_vec"))  # -0 is 0
    finite = F.forall("_vec", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x))
    fit_for = (F.col("_label").isNotNull() & F.coalesce(finite, F.lit(False))
               & F.coalesce(F.exists("_vec", lambda x: x != 0), F.lit(False)) & F.col("_id").isNotNull())
    valid = rows.where(fit_for)
    alone = rows.where(~fit_for).select(F.col("_id").alias(key), F.lit(0).cast("long").alias("n_links"),
                                        F.col("_id").alias("component_id"), F.lit(True).alias("kept"))
    # a point's own number, as ids may repeat; lengths are kept apart with the labels
    points = (valid.groupBy("_label", "_vec").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_copies"))
              .withColumn("_label", F.struct(F.col("_label").alias("label"), F.size("_vec").alias("width"))))
    points = stored(points.withColumn("_id", F.monotonically_increasing_id()), "points")
    indexes = fit(points, threshold, recall)
    shared = spark.sparkContext.broadcast(indexes)  # 2 * MOST_WORDS half vectors each, at most

    schema = f"_label {dict(points.dtypes)['_label']}, _vec array<{kind}>, _first long, _copies long, _id long, _visits array<int>"
    visited = stored(points.select("_label", "_vec", "_first", "_copies", "_id").repartition("_id")
                     .mapInArrow(_assign(shared), schema).withColumn("_home", F.get("_visits", F.lit(0))), "visits")
    visits = visited.select("_label", "_id", F.explode("_visits").alias("_cell"), "_home")
    # the blocks of each cell, from the counts of those who live there and visit
    cells = visits.groupBy("_label", "_cell").agg(
        F.sum((F.col("_cell") == F.col("_home")).cast("long")).alias("_own"), F.count(F.lit(1)).alias("_all"))
    # written, so that AQE can split a cell that very many visit in the join
    cells = stored(cells.where("_own > 0 AND _all > 1").select(
        "_label", "_cell", F.ceil(F.col("_own") / RESIDENTS).cast("int").alias("_r"),
        F.ceil(F.col("_all") / VISITORS).cast("int").alias("_v")), "cells")
    placed = visits.join(cells, ["_label", "_cell"])

    def spread(mine, others):
        """A row of the side cut into ``mine`` parts, once for each part of the other."""
        return (F.pmod(F.xxhash64("_id", "_cell"), F.col(mine)).cast("int"),
                F.explode(F.sequence(F.lit(0), F.col(others) - 1)))
    part, rest = spread("_v", "_r")
    guests = placed.select("_label", "_id", "_cell", part.alias("_vp"), rest.alias("_rp"), F.lit(True).alias("_guest"))
    part, rest = spread("_r", "_v")
    own = placed.where("_cell = _home").select("_label", "_id", "_cell", part.alias("_rp"), rest.alias("_vp"),
                                               F.lit(False).alias("_guest"))
    blocks = own.unionByName(guests).join(visited.select("_id", "_vec", "_copies", "_home"), "_id")
    found = stored(blocks.groupBy("_label", "_cell", "_rp", "_vp").applyInArrow(
        _verify(threshold, shared), "_id long, _links long, _to long"), "links")
    roots = components(found.select(F.col("_id").alias("a"), F.col("_to").alias("b")))
    near = (points.select("_id", "_copies", "_first").join(found.groupBy("_id").agg(F.sum("_links").alias("_links")), "_id", "left")
            .join(roots.select(F.col("node").alias("_id"), F.col("root").alias("_root")), "_id", "left")
            .withColumn("_root", F.coalesce("_root", "_id")))
    near = stored(near.withColumn("_n", F.col("_copies") - 1 + F.coalesce("_links", F.lit(0))), "joined")
    tops = near.groupBy("_root").agg(F.min("_first").alias("_top"))
    near = near.join(tops, "_root").select(F.col("_id").alias("_point"), "_n", "_top")
    # every vector to its point: by label and vector, through the digest of both; the points are written, so that
    # AQE can split a vector with very many copies
    digest = F.xxhash64("_label", "_vec")
    owner = stored(points.select(F.col("_label.label").alias("_pl"), F.col("_vec").alias("_pv"), F.col("_id").alias("_point"))
                   .withColumn("_h", F.xxhash64("_pl", "_pv")).join(near, "_point"), "owners")
    out = valid.join(owner, (digest == F.col("_h")) & (F.col("_label") == F.col("_pl")) & (F.col("_vec") == F.col("_pv")))
    out = out.select(F.col("_id").alias(key), F.col("_n").cast("long").alias("n_links"), F.col("_top").alias("component_id"),
                     (F.col("_top") == F.col("_id")).alias("kept"))
    return out.unionByName(alone)
