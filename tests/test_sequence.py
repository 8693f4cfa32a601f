"""Order-dependent operators against brute force, with a hot group holding a
third of all rows and more partitions than groups."""
import datetime
import random

import pandas as pd

from tessera.operators import sequence

from .conftest import rows


def _events(n=3000, seed=3):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        user = 0 if i % 3 == 0 else rnd.randint(1, 40)
        ts = datetime.datetime(2024, 1, 1) + datetime.timedelta(minutes=rnd.randint(0, 60 * 24 * 60))
        out.append((i, user, ts, rnd.choice(["a", "b"])))
    return out


def test_previous_in_order_matches_lag(spark):
    data = _events()
    df = spark.createDataFrame(data, "event_id long, user_id long, ts timestamp_ntz, kind string")
    got = sequence.previous_in_order(df, ["user_id"], ["ts", "event_id"],
                                     {"prev_id": "event_id", "prev_kind": "kind"}, partitions=13)
    pdf = pd.DataFrame(data, columns=["event_id", "user_id", "ts", "kind"]).sort_values(["user_id", "ts", "event_id"])
    pdf["prev_id"] = pdf.groupby("user_id")["event_id"].shift(1)
    pdf["prev_kind"] = pdf.groupby("user_id")["kind"].shift(1)
    expected = sorted((int(r.event_id), None if pd.isna(r.prev_id) else int(r.prev_id),
                       None if pd.isna(r.prev_kind) else r.prev_kind) for r in pdf.itertuples())
    assert rows(got, "event_id", "prev_id", "prev_kind") == expected


def test_previous_in_order_null_groups_and_small_batches(spark):
    """NULL group values form one group (as in a window), and the lag carries
    across Arrow batches inside a partition."""
    data = [(i, None if i % 5 == 0 else i % 3, datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=i % 97),
             "k%d" % (i % 4)) for i in range(1500)]
    df = spark.createDataFrame(data, "event_id long, user_id long, ts timestamp_ntz, kind string")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        got = rows(sequence.previous_in_order(df, ["user_id"], ["ts", "event_id"],
                                              {"prev_id": "event_id"}, partitions=5),
                   "event_id", "prev_id")
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    ordered = sorted(data, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[0]))  # NULLS FIRST
    expected, prev = [], {}
    for eid, user, _, _ in ordered:
        expected.append((eid, prev.get(user)))
        prev[user] = eid
    assert got == sorted(expected, key=lambda t: (t[0],))


def test_boundaries_never_silently_wrong_without_exchange_reuse(spark):
    """Without exchange reuse the boundary branch samples its own range
    bounds; the result must then be right or the job must fail - never wrong
    rows.  Few output partitions over many rows, so the sampler draws a real
    subset and the two samples differ."""
    data = _events(6000, seed=11)
    df = spark.createDataFrame(data, "event_id long, user_id long, ts timestamp_ntz, kind string")
    pdf = pd.DataFrame(data, columns=["event_id", "user_id", "ts", "kind"]).sort_values(["user_id", "ts", "event_id"])
    pdf["prev_id"] = pdf.groupby("user_id")["event_id"].shift(1)
    expected = sorted((int(r.event_id), None if pd.isna(r.prev_id) else int(r.prev_id)) for r in pdf.itertuples())
    spark.conf.set("spark.sql.exchange.reuse", "false")
    try:
        got = sequence.previous_in_order(df, ["user_id"], ["ts", "event_id"], {"prev_id": "event_id"},
                                         partitions=3)
        try:
            result = rows(got, "event_id", "prev_id")
        except Exception as e:  # noqa: BLE001
            assert "range partitions differ" in str(e)
        else:
            assert result == expected
        ids = sequence.assign_ids(df, ["user_id", "ts"], "id", partitions=3)
        try:
            got_ids = sorted(r.id for r in ids.select("id").collect())
        except Exception as e:  # noqa: BLE001
            assert "range partitions differ" in str(e)
        else:
            assert got_ids == list(range(1, len(data) + 1))
    finally:
        spark.conf.unset("spark.sql.exchange.reuse")


def test_assign_ids_dense_in_order(spark):
    keys = [random.Random(5).randint(0, 10_000) for _ in range(2000)] + [42] * 1000
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k int, i int")
    got = sequence.assign_ids(df, ["k", "i"], "id", partitions=11).select("id", "k", "i").collect()
    ordered = sorted(got, key=lambda r: r.id)
    assert [r.id for r in ordered] == list(range(1, len(keys) + 1))
    assert [(r.k, r.i) for r in ordered] == sorted((k, i) for i, k in enumerate(keys))


def test_eras_match_brute_force(spark):
    data = _events(2000, seed=9)
    df = spark.createDataFrame(data, "event_id long, user_id long, ts timestamp_ntz, kind string")
    from pyspark.sql import functions as F
    got = rows(sequence.eras(df, ["user_id", "kind"], F.to_date("ts"), 2))
    expected = []
    groups = {}
    for _, u, ts, k in data:
        groups.setdefault((u, k), []).append(ts.date())
    for (u, k), days in groups.items():
        days.sort()
        start = prev = days[0]
        n = 1
        for d in days[1:]:
            if (d - prev).days <= 2:
                n += 1
            else:
                expected.append((u, k, start, prev, n))
                start, n = d, 1
            prev = d
        expected.append((u, k, start, prev, n))
    assert got == sorted(expected)


def test_sequence_ops_without_adaptive_execution(spark):
    """With AQE off the static planner's exchange reuse must give the same
    results (a range-sampled subset: many rows over few partitions)."""
    data = _events(6000, seed=13)
    df = spark.createDataFrame(data, "event_id long, user_id long, ts timestamp_ntz, kind string")
    exp, last = {}, {}
    for e, u, t, _ in sorted(data, key=lambda r: (r[1], r[2], r[0])):
        exp[e] = last.get(u)
        last[u] = e
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        got = {r.event_id: r.prev for r in sequence.previous_in_order(
            df, ["user_id"], ["ts", "event_id"], {"prev": "event_id"}, partitions=3).select("event_id", "prev").collect()}
        ids = sorted(r.id for r in sequence.assign_ids(df, ["user_id", "ts"], "id", partitions=3).select("id").collect())
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert got == exp
    assert ids == list(range(1, len(data) + 1))
