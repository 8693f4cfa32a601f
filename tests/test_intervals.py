import datetime
import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import intervals, sequence

from .conftest import rows

DAY0 = datetime.date(2000, 1, 1)


def day(n):
    return DAY0 + datetime.timedelta(days=n)


def _events(n, seed):
    rng = random.Random(seed)
    codes = ["hot"] * 6 + ["a", "b", None]
    return [(i, rng.choice(codes), rng.choice([None, day(rng.randrange(-40, 800))]) if i % 20 == 0 else day(rng.randrange(800))) for i in range(n)]


def _windows(seed):
    rng = random.Random(seed)
    out = []
    for k in range(40):
        s = rng.randrange(-500, 900)
        out.append((rng.choice(["hot", "a", "c", None]), k, day(s), day(s + rng.choice([-3, 0, 5, 30, 400, 40_000]))))
    return out + [("a", 98, None, day(3)), ("a", 99, day(3), None)]


def test_window_join_against_all_pairs(spark):
    ev, win = _events(600, 1), _windows(2)
    e = spark.createDataFrame(ev, "id int, code string, day date")
    w = spark.createDataFrame(win, "source_code string, target int, s date, e date")
    for bucket in (1, 30, 5000):
        got = intervals.window_join(e, w, {"code": "source_code"}, F.col("day"), "s", "e", ["target"], bucket)
        assert got.columns == ["id", "code", "day", "target"]
        want = []
        for i, c, d in ev:
            hits = [t for sc, t, s, x in win if None not in (c, d, sc, s, x) and c == sc and s <= d <= x]
            want += [(i, t) for t in hits] or [(i, None)]
        key = lambda t: (t[0], -1 if t[1] is None else t[1])
        assert sorted(((r.id, r.target) for r in got.collect()), key=key) == sorted(want, key=key)


def test_a_hot_code_is_spread_over_its_dates(spark):
    """With broadcasts off, the largest share of the rows that one join key has."""
    ev = spark.range(20_000).selectExpr("id", "case when id % 2 = 0 then 'hot' else concat('c', id) end AS code", "date_add(date'2000-01-01', cast(id % 720 as int)) AS day")
    win = spark.createDataFrame([("hot", 1, day(0), day(90_000))], "source_code string, target int, s date, e date")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = intervals.window_join(ev, win, {"code": "source_code"}, F.col("day"), "s", "e", ["target"])
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "__bucket" in plan and "__w_bucket" in plan and got.where("target = 1").count() == 10_000
        keys = ev.groupBy("code", F.floor(F.datediff("day", F.lit(DAY0)) / 30)).count().agg(F.max("count")).first()[0]
        assert keys < 20_000 / 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_overlapping_windows(spark):
    win = [("a", 1, day(0), day(10)), ("a", 2, day(10), day(12)), ("a", 3, day(11), day(11)), ("a", 4, day(13), day(20)),
           ("b", 5, day(0), day(100)), ("b", 6, day(5), day(6)), ("b", 7, day(50), day(60)), ("b", 8, day(50), day(60)), (None, 9, day(1), day(2)),
           (None, 10, day(2), day(3))]
    df = spark.createDataFrame(win, "code string, target int, s date, e date")
    for parts in (1, 7):
        got = rows(intervals.overlapping(df, ["code"], "s", "e", parts), "target", "covered_until")
        assert got == [(2, day(10)), (3, day(12)), (6, day(100)), (7, day(100)), (8, day(100)), (10, day(2))]


@pytest.mark.parametrize("how", ["sum", "max"])
@pytest.mark.parametrize("before", [False, True])
def test_running(spark, how, before):
    rng = random.Random(3)
    data = [(rng.choice(["hot", "hot", "x", None]), i, rng.choice([None, *range(-5, 9)])) for i in range(500)]
    df = spark.createDataFrame(data, "g string, k int, v int").repartition(5)
    got = {r.k: r.out for r in sequence.running(df, ["g"], ["k"], "out", F.col("v"), how, before, partitions=9).collect()}
    for g in ("hot", "x", None):
        past = []
        for gg, k, v in data:
            if gg != g:
                continue
            if not before:
                past.append(v)
            have = [p for p in past if p is not None]
            assert got[k] == (None if not have else sum(have) if how == "sum" else max(have))
            if before:
                past.append(v)


def plain_eras(spans, gap):
    out = {}
    for g in {s[0] for s in spans}:
        own = sorted((s, max(s, e or s)) for gg, s, e in spans if gg == g and s is not None)
        eras = []
        for s, e in own:
            if eras and (s - eras[-1][1]).days <= gap:
                eras[-1][3] += max(0, (s - eras[-1][1]).days - 1)
                eras[-1][1] = max(eras[-1][1], e)
                eras[-1][2] += 1
            else:
                eras.append([s, e, 1, 0])
        out[g] = [tuple(e) for e in eras]
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_interval_eras(spark, seed):
    rng = random.Random(seed)
    spans = [(rng.choice([1, 1, 1, 2, 3, None]), day(s := rng.randrange(4000)), rng.choice([None, day(s - 2), day(s + rng.choice([0, 3, 30, 300]))]))
             for _ in range(400)]
    spans += spans[:30] + [(4, day(0), day(1000)), (4, day(5), day(6)), (4, day(1030), day(1031)), (4, day(1063), None), (5, None, day(3))]
    df = spark.createDataFrame(spans, "person int, s date, e date").repartition(4)
    got = sequence.interval_eras(df, ["person"], "s", "e", 30, gap_col="gap", partitions=11).collect()
    by = {}
    for r in got:
        by.setdefault(r.person, []).append((r.era_start, r.era_end, r.n, r.gap))
    want = plain_eras(spans, 30)
    assert {k: sorted(v) for k, v in by.items()} == {k: v for k, v in want.items() if v}
    assert by[4] == [(day(0), day(1031), 3, 29), (day(1063), day(1063), 1, 0)] or sorted(by[4]) == want[4]


def test_two_levels_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(sequence, "MOST_RANGES", 4)
    keys = [random.Random(5).randint(0, 10_000) for _ in range(1)] * 300 + random.Random(6).choices(range(10_000), k=3000)
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int").repartition(6)
    ranged = sequence._ranged(df, ["k", "i"], 16).groupBy("_range").count().collect()
    assert len(ranged) > 8 and max(r["count"] for r in ranged) < 0.25 * len(keys)
    got = sorted(sequence.assign_ids(df, ["k", "i"], "id", partitions=16).collect(), key=lambda r: r.id)
    assert [r.id for r in got] == list(range(1, len(keys) + 1))
    assert [(r.k, r.i) for r in got] == sorted((k, i) for i, k in enumerate(keys))
    prev = sequence.previous_in_order(df.withColumn("g", F.col("k") % 2), ["g"], ["k", "i"], {"p": "i"}, partitions=16)
    last = {}
    for r in sorted(prev.collect(), key=lambda r: (r.g, r.k, r.i)):
        assert r.p == last.get(r.g)
        last[r.g] = r.i
