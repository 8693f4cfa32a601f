import random

import numpy as np
import pytest

from tessera.llm import packing


def slow_fit(sizes, row):
    """Best-fit decreasing by looking at every open row."""
    rooms, out = [], {}
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        fits = [r for r in rooms if r[0] >= sizes[i]]
        best = min(fits, key=lambda r: r[0]) if fits else None
        if best is None:
            rooms.append(best := [row, len(rooms)])
        out[i] = best[0]
        best[0] -= sizes[i]
    return out, sorted(r[0] for r in rooms)


@pytest.mark.parametrize("seed", range(20))
def test_best_fit_decreasing(seed):
    rng = random.Random(seed)
    row = rng.choice([1, 7, 64, 100, 2048])
    sizes = np.array([rng.randrange(1, row + 1) for _ in range(300)])
    at, rows = packing.best_fit_decreasing(sizes, row)
    room = np.full(rows, row)
    np.subtract.at(room, at, sizes)
    assert (room >= 0).all() and sorted(room.tolist()) == slow_fit(sizes.tolist(), row)[1]


def whole(docs):
    enc = packing.encoding(packing.default_path())
    return sorted((-1 if i is None else i, tuple([*enc.encode_ordinary(t or ""), 50256])) for i, t, *_ in docs)


def put_together(packed, row):
    """Documents out of packed rows, checking each row's lengths and resets."""
    pieces = []
    for r in packed.collect():
        ids = np.frombuffer(r.ids, "<u2")
        cu, resets = r.cu_seqlens, np.unpackbits(np.frombuffer(r.resets, np.uint8), bitorder="little")[:row]
        assert len(ids) == row and cu[0] == 0 and cu[-1] == r.n_ids and len(cu) == len(r.doc_ids) + 1
        assert np.flatnonzero(resets).tolist() == cu[:-1] and (ids[cu[-1]:] == 50256).all()
        pieces += [(d, p, tuple(ids[a:b].tolist())) for d, p, a, b in zip(r.doc_ids, r.pieces, cu, cu[1:])]
    return pieces


def test_round_trip(spark):
    rng = random.Random(2)
    docs = [(i, " ".join(rng.choice(["a", "thing", "über", "x9", "\n"]) for _ in range(rng.randrange(0, 300)))) for i in range(300)]
    docs += [(900, "word " * 3000), (901, None), (902, "")]
    df = spark.createDataFrame([(i, t, "s") for i, t in docs], "doc_id long, text string, ids string")
    packed = packing.pack(packing.token_pieces(df, row=64), 3, row=64)
    pieces = put_together(packed, 64)
    own = {}
    for d, p, ids in sorted(pieces):
        assert len(ids) <= 64 and p == len(own.setdefault(d, [])) // 64
        own[d] += ids
    assert sorted((d, tuple(x)) for d, x in own.items()) == whole(docs)
    assert len({r.pack_group for r in packed.collect()}) == 3
    back = packing.unpack(packed).collect()
    assert sorted((r.doc_id, r.piece, tuple(np.frombuffer(r.ids, "<u2").tolist())) for r in back) == sorted(pieces)


def test_repeated_rows_and_no_rows(spark):
    docs = [(1, "same text"), (1, "same text"), (None, "no id"), (2, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    pieces = put_together(packing.pack_documents(df), packing.ROW)
    assert sorted((-1 if d is None else d, ids) for d, _, ids in pieces) == whole(docs)
    assert packing.pack_documents(df.limit(0)).collect() == []


def test_query(spark):
    from tessera.llm.common import table
    from tessera.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    packed = QUERIES["op10_pack_ids"](spark, d)
    own = {}
    for i, _, ids in sorted(put_together(packed, packing.ROW)):
        own[i] = own.get(i, ()) + ids
    assert sorted(own.items()) == whole([(r.doc_id, r.text) for r in table(spark, d, "documents").collect()])
    used = sum(r.n_ids for r in packed.collect())
    assert used >= 0.97 * packing.ROW * (packed.count() - 1)


def test_equal_rows_go_to_all_groups(spark):
    from tessera.llm import packing
    df = spark.range(40_000).selectExpr("cast(null as long) AS doc_id", "cast(null as string) AS text").repartition(4)
    packed = packing.pack(packing.token_pieces(df), 8).collect()
    by = {}
    for r in packed:
        by[r.pack_group] = by.get(r.pack_group, 0) + len(r.doc_ids)
    assert sorted(by) == list(range(8)) and sum(by.values()) == 40_000 and max(by.values()) < 6000


def test_ids_are_made_a_few_documents_at_a_time():
    import pyarrow as pa
    docs = [(i, f"text {i} " * (i % 5)) for i in range(1000)] + [(1000, "long " * 4000), (1001, None), (None, "")]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array([i for i, _ in docs], pa.int64()), "text": pa.array([t for _, t in docs], pa.string())})
    made = list(packing._pieces(packing.default_path(), 64, 50256)(iter([batch])))
    assert max(len(set(b.column("doc_id").to_pylist())) for b in made) <= 256
    own = {}
    for b in made:
        for r in b.to_pylist():
            assert r["n_ids"] == len(r["ids"]) // 2 <= 64 and r["piece"] == own.setdefault(r["doc_id"], [0, ()])[0]
            own[r["doc_id"]] = [r["piece"] + 1, own[r["doc_id"]][1] + tuple(np.frombuffer(r["ids"], "<u2").tolist())]
    assert sorted((-1 if i is None else i, ids) for i, (_, ids) in own.items()) == whole(docs)
