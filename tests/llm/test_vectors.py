import numpy as np
import pytest

from tessera.llm import vectors


def brute(rows, threshold=0.93):
    """id -> (links, component) by all pairs of a label."""
    ids = [r[0] for r in rows]
    links, root = dict.fromkeys(ids, 0), {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ok = [r for r in rows if r[2] is not None and r[1] is not None and len(r[1]) and all(
        v is not None and np.isfinite(v) for v in r[1]) and any(r[1])]
    for label in {r[2] for r in ok}:
        own = [r for r in ok if r[2] == label]
        x = np.array([r[1] for r in own], dtype=np.float32).astype(float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        for i, j in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1))):
            a, b = own[i][0], own[j][0]
            links[a] += 1
            links[b] += 1
            a, b = sorted((find(a), find(b)))
            root[b] = a
    return {i: (links[i], find(i)) for i in ids}


def spread(rng, n, near, hot, dims=64):
    x = rng.normal(size=(n, dims))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    for i in rng.choice(n, near, replace=False):
        x[i] = x[rng.integers(n)] + rng.normal(size=dims) * rng.uniform(0, 0.05)
    x[n - hot:] = x[0] + rng.normal(size=(hot, dims)) * 0.01
    return x.astype(np.float32).tolist()


def recall(got, want):
    assert all(got[i][0] <= want[i][0] for i in want)  # no link below the threshold
    links = sum(w for w, _ in want.values())
    return sum(g for g, _ in got.values()) / links if links else 1.0


SCHEMA = "vec_id long, embedding array<float>, label int, _vec string"


@pytest.mark.parametrize("seed", [1, 2])
def test_recall_against_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(vectors, "RESIDENTS", 64)  # hot cells in several blocks
    monkeypatch.setattr(vectors, "VISITORS", 128)
    rng = np.random.default_rng(seed)
    x = spread(rng, 1500, 400, 300)
    rows = [(i, v, int(rng.integers(3)) if i < 1200 else 1, "x") for i, v in enumerate(x)]
    rows += [(2000 + i, x[i], rows[i][2], None) for i in range(40)]  # exact copies
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = brute(rows)
    assert got.keys() == want.keys() and recall(got, want) >= 0.97


def test_odd_vectors(spark):
    one = [1.0] + [0.0] * 63
    rows = [(1, one, 1, "a"), (2, one, 1, "b"), (3, one, 2, "c"), (4, one, None, "d"), (5, None, 1, "e"), (6, [0.0] * 64, 1, "f"),
            (7, [0.0] * 64, 1, "g"), (8, [float("nan")] + one[1:], 1, "h"), (9, [None] + one[1:], 1, "i"), (10, [], 1, "j"),
            (11, [float("inf")] + one[1:], 1, "k"), (12, [2.0] + [-0.0] * 63, 1, "l"), (13, [1.0, 0.0], 1, "m"), (14, [1.0, 0.0], 1, "m")]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(df).collect()}
    assert got.pop(1) == (2, 1, True) and got.pop(2) == (2, 1, False) and got.pop(12) == (2, 1, False)
    assert got.pop(13) == (1, 13, True) and got.pop(14) == (1, 13, False)  # of another length
    assert got == {i: (0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10, 11)}
    assert vectors.near_duplicates(df.limit(0)).collect() == []
    assert [tuple(r) for r in vectors.near_duplicates(df.where("vec_id = 6")).collect()] == [(6, 0, 6, True)]


def test_lengths_have_indexes_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(vectors, "INDEXED", 2)
    rng = np.random.default_rng(5)
    rows = [(1000 * k + i, v, 1, "x") for k, (dims, n) in enumerate([(64, 60), (32, 40), (16, 30), (1, 6), (7, 5)])
            for i, v in enumerate(spread(rng, n, n // 3, 3, dims))]
    rows += [(9000 + i, [0.5] * 48, 1, "odd") for i in range(5)]
    rows += [(3, rows[70][1], 1, "an id again")]
    got = [(r.vec_id, r.n_links, r.component_id) for r in vectors.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()]
    unique = [(i, v, (lab, len(v))) for i, v, lab, _ in rows[:-1]] + [(99_999, rows[-1][1], (1, 32))]
    want = brute(unique)
    assert len(got) == len(rows) and all((4, 9000) == (n, c) for i, n, c in got if i >= 9000)
    odd = {(i, n) for i, n, _ in got if i not in (3,)}
    assert odd == {(i, n) for i, (n, _) in want.items() if i not in (3, 99_999)}
    assert sorted(n for i, n, _ in got if i == 3) == sorted([want[3][0], want[99_999][0]])


def test_traversal_is_in_order():
    rng = np.random.default_rng(3)
    x = np.array(spread(rng, 400, 50, 20), dtype=float)
    x = vectors._unit(x)
    m = vectors.MultiIndex(x, 9)
    a, b = m.distances(x)
    for i, cells in enumerate(m.visits(x)):
        d = a[i][:, None] + b[i][None, :]
        got = d.ravel()[cells]
        assert cells[0] == m.cells(x[i:i + 1])[0] and (np.diff(got) >= 0).all()
        assert len(cells) == (d <= d.min() + m.stop).sum() and len(set(cells.tolist())) == len(cells)
        assert set(np.flatnonzero(m.goes(x[i:i + 1], np.arange(81))[0])) == set(cells.tolist())


def test_query(spark):
    from tessera.llm.common import table
    from tessera.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in table(spark, d, "embeddings").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op3_embedding_neardup"](spark, d).collect()}
    assert recall(got, brute(rows)) >= 0.97 and got.keys() == {r[0] for r in rows}
