import random

import pytest

from tessera.operators import chains

from .conftest import rows


def plain_follow(edges):
    """node -> (root, depth, cycle, on_cycle) by walking."""
    step = {}
    for a, b in edges:
        if a is not None:
            step[a] = b if step.get(a) is None else (step[a] if b is None else min(step[a], b))
    nodes = {a for a, _ in edges if a is not None} | {b for a, b in edges if a is not None and b is not None}
    out = {}
    for n in nodes:
        seen, at = [n], n
        while step.get(at) is not None and step[at] not in seen:
            at = step[at]
            seen.append(at)
        if step.get(at) is None:
            out[n] = (at, len(seen) - 1, None, False)
        else:
            loop = seen[seen.index(step[at]):]
            out[n] = (None, None, min(loop), n in loop)
    return out


@pytest.mark.parametrize("seed", range(3))
def test_follow_random_references(spark, seed):
    rng = random.Random(seed)
    edges = [(i, rng.choice([None, rng.randrange(300), max(0, i - 1), max(0, i - 1)])) for i in range(300)]
    edges += [(None, 5), (7, 3), (7, 250), (900, 901), (950, 950)]
    df = spark.createDataFrame(edges, "id long, ref long")
    got = {r.node: tuple(r)[1:] for r in chains.follow(df, "id", "ref").collect()}
    assert got == plain_follow(edges)


def test_long_chain_in_few_rounds(spark, monkeypatch):
    cuts = []
    real = chains.cut_lineage
    monkeypatch.setattr(chains, "cut_lineage", lambda df, label: (cuts.append(label), real(df, label))[1])
    n = 10_000
    df = spark.range(n).selectExpr("id", "case when id > 0 then id - 1 end AS ref")
    out = chains.follow(df, "id", "ref")
    assert len(cuts) < 20
    assert out.where("root <> 0 OR depth <> node OR cycle IS NOT NULL").count() == 0 and out.count() == n


def test_follow_star_strings_and_empty(spark):
    df = spark.createDataFrame([(f"s{i}", "hub") for i in range(500)] + [("hub", "top")], "a string, b string")
    got = chains.follow(df, "a", "b")
    assert got.groupBy("root", "depth").count().orderBy("depth").collect() == [("top", 0, 1), ("top", 1, 1), ("top", 2, 500)]
    assert chains.follow(df.limit(0), "a", "b").collect() == []


def plain_closure(edges):
    up, out = {}, {}
    for a, b in edges:
        up.setdefault(a, set()).add(b)

    def walk(n, at, k):
        for p in up.get(at, ()):
            lo, hi = out.get((p, n), (k, k))
            out[p, n] = (min(lo, k), max(hi, k))
            walk(n, p, k + 1)
    for n in up:
        walk(n, n, 1)
    for n in {x for e in edges for x in e}:
        out[n, n] = (0, 0)
    return out


def test_closure_of_a_hierarchy_with_short_cuts(spark):
    rng = random.Random(4)
    edges = [(i, rng.randrange(i + 1, i + 6)) for i in range(60) for _ in range(2)]
    df = spark.createDataFrame([*edges, (None, 3), (3, None)], "child int, parent int")
    got = {(a, d): (lo, hi) for a, d, lo, hi in rows(chains.closure(df, "child", "parent"))}
    assert got == plain_closure(edges)
    one = chains.closure(df, "child", "parent", itself=False, most_levels=1)
    assert {(d, a) for a, d, *_ in rows(one)} == set(edges)
    assert chains.closure(df.limit(0), "child", "parent").collect() == []


def test_closure_refuses_cycles(spark):
    df = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 1)], "child int, parent int")
    with pytest.raises(chains.CycleFound, match="3 levels"):
        chains.closure(df, "child", "parent")
