import itertools
import random

import numpy as np
import pytest

from pyspark.sql import functions as F

from tessera.llm import jaccard
from tessera.llm.components import components


def brute(rows):
    """doc_id -> (links, component) by comparing all pairs of word 5-gram sets."""
    def grams(text):
        w = (text or "").lower().split()
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = {i: grams(t) for i, t in rows}
    links, root = dict.fromkeys(sets, 0), {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if sets[a] and both and 5 * both >= 4 * (len(sets[a]) + len(sets[b]) - both):
            links[a] += 1
            links[b] += 1
            ra, rb = sorted((find(a), find(b)))
            root[rb] = ra
    return {i: (links[i], find(i)) for i in sets}


def corpus(seed, groups=25, hot=400):
    rng = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    def new(n):
        return [rng.choice(words) for _ in range(n)]
    def changed(t, k):
        t = list(t)
        for _ in range(k):
            t[rng.randrange(len(t))] = rng.choice(words)
        return t
    out, passage = [], new(60)
    for _ in range(groups):
        first = new(rng.randrange(30, 200))
        out += [changed(first, rng.randrange(0, 5)) for _ in range(rng.randrange(1, 7))]
    hot_text = new(150)
    out += [changed(hot_text, rng.randrange(0, 4)) for _ in range(hot)]
    out += [new(40) + passage + new(40) for _ in range(60)]
    out += [["one", "two"], ["one", "two"], ["One", "two"], ["x"]]
    texts = [" ".join(t) for t in out] + ["", None, "  \n"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rows = corpus(seed)
    got = jaccard.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute(rows)
    assert {r.doc_id: (r.n_links, r.component_id) for r in got} == want
    assert all(r.kept == (want[r.doc_id][1] == r.doc_id) for r in got) and len(got) == len(rows)


def test_keep_one(spark):
    rows = [(1, "a b c d e f g h", "x"), (2, "a b c d e f g h", "y"), (2, "a b c d e f g h", "y"), (None, "a b c d e f g h", "z"),
            (3, None, None), (4, "", "q"), (None, "p q r s t u v", "n"), (None, "p q r s t u v", "n"), (7, "k", "l")]
    df = spark.createDataFrame(rows, "doc_id long, text string, _key string")
    got = sorted(map(str, map(tuple, jaccard.keep_one(df).collect())))
    assert got == sorted(map(str, [rows[0], rows[4], rows[5], rows[6], rows[8]]))
    assert jaccard.keep_one(df.limit(0)).collect() == []
    assert jaccard.join_documents(df.limit(0)).collect() == []


def test_exactly_on_the_threshold(spark):
    base = ["t%d" % i for i in range(40)]           # 36 shingles
    near = base + ["u%d" % i for i in range(9)]     # 45 shingles, 36 shared: 0.8
    far = base + ["v%d" % i for i in range(10)]     # 46 shingles, 36 shared
    rows = [(i, " ".join(t)) for i, t in enumerate((base, near, far))]
    got = {r.doc_id: r.n_links for r in jaccard.join_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 1, 1: 1, 2: 0}


def test_posterior_bounds():
    need = jaccard.least_matches()
    assert need == sorted(need) and need[-1] < 0.8 * jaccard.VALUES


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for _ in range(60):
        a = rng.integers(0, 1 << 63, 800).astype(np.uint64)
        b = np.concatenate([a[:700], rng.integers(0, 1 << 63, 100).astype(np.uint64)])
        errors.append((jaccard.minhash(a) == jaccard.minhash(b)).mean() - 700 / 900)
    assert abs(np.mean(errors)) < 0.02


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1000 + i) for i in range(1, 300)]
    ring = [(5000 + i, 5000 + (i + 1) % 50) for i in range(50)]
    out = components(spark.createDataFrame(chain + star + ring + [(9, 9)], "a long, b long")).collect()
    roots = {r.node: r.root for r in out}
    assert len(out) == 201 + 300 + 50
    groups = {}
    for n, r in roots.items():
        groups.setdefault(r, set()).add(n)
    assert sorted(map(min, groups.values())) == [0, 1000, 5000] and sorted(map(len, groups.values())) == [50, 201, 300]
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_query(spark):
    from tessera.llm.common import table
    from tessera.llm.queries import QUERIES
    d = "/root/testdata/sf0.001"
    want = brute([(r.doc_id, r.text) for r in table(spark, d, "documents").collect()])
    got = QUERIES["op8_ngram_jaccard"](spark, d).collect()
    assert {r.doc_id: (r.n_links, r.class_id) for r in got} == want


def near_copies_of_one(n, seed=6):
    rng = random.Random(seed)
    first = ["w%d" % rng.randrange(4000) for _ in range(120)]
    out = []
    for i in range(n):
        t = list(first)
        t[rng.randrange(len(t))] = "x%d" % i
        out.append((i, " ".join(t)))
    return out


def test_rows_of_a_large_group_do_not_grow_with_its_square(spark, monkeypatch):
    """Rows and bytes that are dealt to blocks for 500, 1,000 and 2,000 near copies."""
    sizes = []
    real = jaccard._blocks

    def counted(members):
        blocks = real(members)
        rows, texts = blocks.agg(F.count(F.lit(1)), F.sum(F.size("_members"))).first()
        sizes[-1].append((rows, texts))
        return blocks
    monkeypatch.setattr(jaccard, "_blocks", counted)
    monkeypatch.setattr(jaccard, "CHUNK", 40)
    for n in (500, 1000, 2000):
        sizes.append([])
        df = spark.createDataFrame(near_copies_of_one(n), "doc_id long, text string")
        got = jaccard.join_documents(df).collect()
        # pruning drops a pair in some hundred thousand here, which is its tolerance
        assert all(r.n_links <= n - 1 and r.component_id == 0 for r in got) and sum(r.n_links for r in got) > 0.99999 * n * (n - 1)
    for phase in (0, 1):
        for small, large in zip(sizes, sizes[1:]):
            assert large[phase][0] < 2.5 * small[phase][0], sizes
            assert large[phase][1] < 3.2 * small[phase][1], sizes  # copies of members: by the root of the group


def test_keep_one_of_a_large_group_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CHUNK", 40)
    rows = near_copies_of_one(600) + [(1000 + i, t + " tail of its own here now and then " * 20) for i, t in near_copies_of_one(2)]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(5))
    want = {c for _, c in brute(rows).values()}
    assert {r.doc_id for r in kept.collect()} == want


def test_which_row_stays(spark):
    """Of rows that differ only in other columns the same one stays, whatever the order; columns named like inner ones stay."""
    text = "a b c d e f g h"
    rows = [(1, text, s, i) for i, s in enumerate("zyx")] + [(1, text, "z", 0)] * 400 + [(2, text + " i", "q", 9), (3, "  ", "blank", 1), (3, "  ", "blank", 1)]
    schema = "doc_id long, text string, source string, _row int"
    found = set()
    for seed in range(3):
        random.Random(seed).shuffle(rows)
        got = jaccard.keep_one(spark.createDataFrame(rows, schema).repartition(3)).collect()
        assert sorted(r.doc_id for r in got) == [1, 3] and got[0].asDict().keys() == {"doc_id", "text", "source", "_row"}
        found.add(next((r.source, r._row) for r in got if r.doc_id == 1))
    assert len(found) == 1 and found <= {("z", 0), ("y", 1), ("x", 2)}
