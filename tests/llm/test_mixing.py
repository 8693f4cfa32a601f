import math
import random

import pytest

from tessera.llm import mixing


def edf(ticks, resolution):
    """Slot by slot: the released block with the earliest deadline."""
    given, picks = [0] * len(ticks), []
    for t in range(resolution):
        ready = [(math.ceil((g + 1) * resolution / a), i) for i, (g, a) in enumerate(zip(given, ticks))
                 if g < a and g * resolution // a <= t]
        _, i = min(ready)
        given[i] += 1
        picks.append(i)
    return picks


def made(spark, sizes):
    rows = [(i, s, "t%d" % i, 1) for i, s in enumerate(s for s, n in sizes.items() for _ in range(n))]
    return spark.createDataFrame(rows, "doc_id long, source string, text string, slot int"), rows


def test_period_is_earliest_deadline_first(spark):
    rng = random.Random(1)
    df, _ = made(spark, {"s%d" % i: rng.randrange(1, 200) for i in range(12)})
    ticks = mixing.source_ticks(df, "source", 100)
    rows = sorted(mixing.period(ticks, 100).collect(), key=lambda r: r.source)
    assert sum(r.ticks for r in rows) == 100
    picks = edf([r.ticks for r in rows], 100)
    assert [list(r.slots) for r in rows] == [[t for t, p in enumerate(picks) if p == i] for i in range(len(rows))]


@pytest.mark.parametrize("how", [{}, {"weights": {"a": 1, "b": 5, "c": 2}}, {"smoothing": 2}])
def test_prefixes_are_within_one_block(spark, how):
    sizes = {"a": 300, "b": 57, "c": 8, None: 90}
    df, rows = made(spark, sizes)
    ticks = {r.source: r.ticks for r in mixing.source_ticks(df, "source", 50, how.get("weights"), how.get("smoothing", 4)).collect()}
    got = mixing.mix(df, block_rows=4, resolution=50, **how).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    by_slot = {}
    for r in got:
        by_slot.setdefault(r.slot, []).append(r)
    assert sorted(by_slot) == list(range(len(by_slot)))
    given = dict.fromkeys(sizes, 0)
    for t in range(len(by_slot)):
        block = by_slot[t]
        assert len({(r.source, r.block) for r in block}) == 1 and sorted(r.place for r in block) == [0, 1, 2, 3]
        given[block[0].source] += 1
        assert all(abs(given[s] - a * (t + 1) / 50) < 1 for s, a in ticks.items())
    for s, n in sizes.items():  # whole passes, one after the other
        own = sorted((r.block, r.place, r.epoch, r.doc_id) for r in got if r.source == s)
        assert [x[2] for x in own] == [i // n for i in range(len(own))]
        assert [x[3] for x in own] == [own[i % n][3] for i in range(len(own))]


def test_odd_tables(spark):
    df, _ = made(spark, {"a": 3})
    assert mixing.mix(df.limit(0)).collect() == [] and mixing.mixed_order(df.limit(0)).collect() == []
    twice = df.unionByName(df).withColumn("text", df.text.substr(0, 0))
    got = mixing.mix(twice, block_rows=1).collect()
    assert sorted(r.doc_id for r in got) == [0, 0, 1, 1, 2, 2] and set(got[0].asDict()) == {"doc_id", "source", "text", *mixing.ADDED}
    nulls = spark.createDataFrame([(None, None, None)] * 3, "doc_id long, source string, text string")
    assert len(mixing.mix(nulls, block_rows=1).collect()) == 3
    with pytest.raises(Exception, match="raise resolution"):
        mixing.mix(made(spark, {"a": 1, "b": 1, "c": 1})[0], resolution=2).collect()


def test_clashing_columns(spark):
    df, rows = made(spark, {"a": 5, "b": 3})
    names = ["_r", "_at", "_md5", "_n", "n", "ticks", "slots", "epoch", "_source", "bucket", "group"]
    wide = df.selectExpr("*", *[f"'x' AS {n}" for n in names])
    got = mixing.mix(wide, block_rows=1).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows} and all(r["_at"] == r["n"] == "x" and r.epoch != "x" for r in got)
    assert mixing.mixed_order(wide).columns == [c for c in wide.columns if c not in mixing.ADDED]


def test_mixed_order(spark):
    df, rows = made(spark, {"a": 40, "b": 40})
    out = mixing.mixed_order(df.drop("slot"), partitions=3, block_rows=2)
    got = [r.source for r in out.collect()]
    assert out.columns == ["doc_id", "source", "text"] and sorted(got) == sorted(r[1] for r in rows)
    assert all(abs(got[:k].count("a") - k / 2) <= 2 for k in range(len(got)))


def test_many_sources(spark):
    n = {"s%04d" % i: 1 for i in range(1200)}
    df, _ = made(spark, n)
    ticks = {r.source: r.ticks for r in mixing.source_ticks(df, "source").collect()}  # more than 1,000 sources
    assert set(ticks) == set(n) and set(ticks.values()) == {50}
    sizes = {"s%03d" % i: 1 for i in range(120)} | {"big": 60}
    df, rows = made(spark, sizes)
    ticks = {r.source: r.ticks for r in mixing.source_ticks(df, "source").collect()}
    m, all_rows, k = sum(ticks.values()), len(rows), len(sizes)
    assert m == 50 * k
    for s, c in sizes.items():  # three quarters of the share and a quarter of an equal share
        target = m * (3 * c / all_rows + 1 / k) / 4
        assert abs(ticks[s] - target) <= target / 50 + 2
    got = mixing.mix(df, block_rows=1).collect()
    assert {r.doc_id for r in got} == {r[0] for r in rows}
    slots = sorted(r.slot for r in got)
    assert slots == list(range(len(slots)))
    given = dict.fromkeys(sizes, 0)
    for t, r in enumerate(sorted(got, key=lambda r: r.slot)):
        given[r.source] += 1
        assert all(abs(given[s] - a * (t + 1) / m) < 1 for s, a in ticks.items())


def test_few_sources_have_a_period_of_1000(spark):
    df, _ = made(spark, {"s%d" % i: i + 1 for i in range(20)})
    both = [sorted(map(tuple, mixing.source_ticks(df, "source", r).collect())) for r in (None, 1000)]
    assert both[0] == both[1] and sum(x[2] for x in both[0]) == 1000
