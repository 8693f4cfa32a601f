import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera import contracts
from tessera.operators import checks

from .conftest import rows


def test_duplicate_keys_narrow_and_wide(spark):
    data = [(1, "a"), (1, "a"), (2, "b"), (3, None), (3, None), (4, "a")]
    df = spark.createDataFrame(data, "k int, t string")
    assert rows(checks.duplicate_keys(df, ["k"])) == [(1, 2), (3, 2)]
    # text key: hash pre-filter then exact grouping; NULLs exempt with skip_nulls
    assert rows(checks.duplicate_keys(df, ["t"], skip_nulls=True)) == [("a", 3)]
    assert rows(checks.duplicate_keys(df, ["k", "t"], skip_nulls=True)) == [(1, "a", 2)]


def test_wide_key_hot_value_matches_brute_force(spark):
    rnd = random.Random(7)
    texts = ["hot " * 50] * 3000 + [f"t{rnd.randint(0, 4000)}" for _ in range(6000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string").repartition(8)
    expected = {}
    for t in texts:
        expected[t] = expected.get(t, 0) + 1
    expected = sorted((t, n) for t, n in expected.items() if n > 1)
    assert rows(checks.duplicate_keys(df, ["t"])) == expected


def test_pk_and_unique_reports(spark):
    t = contracts.ad_hoc("t", "id int!, name vc5, code vc3", pk="id", uniques=["name, code"])
    df = spark.createDataFrame([(1, "a", "x"), (1, "b", "y"), (None, "a", "x"), (3, "a", None)],
                               "id int, name string, code string")
    rep = checks.pk_report(df, t).unionByName(checks.unique_report(df, t, ["name", "code"]))
    got = rows(rep, "constraint_name", "key", "n")
    assert got == [("primary_key", '{"id":1}', 2), ("primary_key_null", None, 1),
                   ("unique", '{"name":"a","code":"x"}', 2)]


def test_fk_rows_ignore_null_keys(spark):
    child = spark.createDataFrame([(1, 10), (2, None), (3, 99)], "id int, p int")
    parent = spark.createDataFrame([(10,)], "pid int")
    assert rows(checks.fk_violation_rows(child, parent, ["p"], ["pid"]), "id") == [(3,)]


def test_stacked_fk_report(spark):
    concept = spark.createDataFrame([(1,), (2,)], "concept_id int")
    m = spark.createDataFrame([(1, 2, None), (5, 1, 1), (5, 6, 2)], "a int, b int, c int")
    rep = checks.fk_report({"m": m}, concept, "concept_id", {"m": ["a", "b", "c"]}, "concept")
    assert rows(rep, "columns", "key", "n") == [("a", "5", 2), ("b", "6", 1)]


def test_column_report_and_row_forms(spark):
    t = contracts.ad_hoc("t", "id int!, name vc3!, note text")
    df = spark.createDataFrame([(1, "abcd", None), (None, "ab", "x"), (3, None, "y")],
                               "id int, name string, note string")
    got = rows(checks.column_report(df, t), "constraint_name", "columns", "n")
    assert got == [("max_length_3", "name", 1), ("not_null", "id", 1), ("not_null", "name", 1)]
    assert rows(checks.length_violation_rows(df, "name", 3, ["id"])) == [(1, 4)]
    assert rows(checks.not_null_violation_rows(df, ["id"]), "name") == [("ab",)]


def test_clean_tables_have_no_violations(spark):
    conc = contracts.contract("concept")
    dom = contracts.contract("domain")
    concept = spark.createDataFrame([(1, "Drug", "Drug", "V", "C", "1", None, None, None, None)],
                                    "concept_id int, concept_name string, domain_id string, vocabulary_id string, "
                                    "concept_class_id string, concept_code string, valid_start_date date, "
                                    "valid_end_date date, standard_concept string, invalid_reason string") \
        .withColumn("valid_start_date", F.current_date()).withColumn("valid_end_date", F.current_date())
    domain = spark.createDataFrame([("Drug", "Drug", 1)], "domain_id string, domain_name string, domain_concept_id int")
    others = {"vocabulary": spark.createDataFrame([("V",)], "vocabulary_id string"),
              "concept_class": spark.createDataFrame([("C",)], "concept_class_id string")}
    frames, both = {"concept": concept, "domain": domain}, {"concept": conc, "domain": dom}
    assert checks.validate_tables(frames, both, others).count() == 0
    with pytest.raises(KeyError, match="vocabulary"):  # a parent that nobody gives is an error, not a clean table
        checks.validate_tables(frames, both, {"concept_class": others["concept_class"]})


def test_validate_tables_against_brute_force(spark):
    """Keys, missing values, lengths and keys to several parents, counted."""
    rnd = random.Random(3)
    parent = contracts.ad_hoc("p", "id int!, name vc3", pk="id")
    child = contracts.ad_hoc("c", "id int!, a int, b bigint!, t vc4", pk="id", fks=["a -> x.p.id", "b -> x.q.k"])
    p = [(i, "abcd"[:rnd.randrange(5)]) for i in range(20)] + [(3, "x")]
    c = [(rnd.randrange(60), rnd.choice([None, *range(25)]), rnd.choice([None, *range(8)]), "x" * rnd.randrange(7)) for _ in range(80)]
    frames = {"p": spark.createDataFrame(p, "id int, name string"), "c": spark.createDataFrame(c, "id int, a int, b bigint, t string")}
    q = spark.createDataFrame([(i,) for i in range(5)] + [(None,)], "k bigint")
    got = rows(checks.validate_tables(frames, {"p": parent, "c": child}, {"q": q}))
    want = Counter()
    for name, data in (("p", p), ("c", c)):
        for k, n in Counter(r[0] for r in data).items():
            if n > 1:
                want[(name, "primary_key", "id", '{"id":%d}' % k)] = n
    for i, name in p:
        want[("p", "max_length_3", "name", None)] += len(name) > 3
    for _, a, b, t in c:
        want[("c", "max_length_4", "t", None)] += len(t) > 4
        want[("c", "not_null", "b", None)] += b is None
        if a is not None and a > 19:
            want[("c", "foreign_key:p.id", "a", str(a))] += 1
        if b is not None and b > 4:
            want[("c", "foreign_key:q.k", "b", str(b))] += 1
    assert sorted(map(str, got)) == sorted(str((*k, n)) for k, n in want.items() if n)


def test_appended_rows_are_checked_against_published_keys(spark):
    t = contracts.ad_hoc("t", "id int!, code vc9", pk="id", uniques=["code"])
    old = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b2")], "id int, code string")
    new = spark.createDataFrame([(3, "c"), (1, "b")], "id int, code string")
    got = rows(checks.validate_tables({"t": old.unionByName(new)}, {"t": t}, new_rows={"t": new}), "constraint_name", "key", "n")
    # the repeated 2 was published before and is not among the new keys
    assert got == [("primary_key", '{"id":1}', 2), ("unique", '{"code":"b"}', 2)]


def test_repeated_texts_by_bitmap_and_by_join(spark, monkeypatch):
    texts = [f"t{i % 700}" if i < 1400 else f"u{i}" for i in range(4000)] + [None] * 5
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = sorted((f"t{i}", 2) for i in range(700))
    assert sorted(map(tuple, checks.duplicate_keys(df, ["t"], skip_nulls=True).collect())) == want
    monkeypatch.setattr(checks, "MOST_REPEATED", 10)
    assert sorted(map(tuple, checks.duplicate_keys(df, ["t"], skip_nulls=True).collect())) == want
    assert checks.duplicate_keys(df.distinct(), ["t"]).collect() == []


def test_bitmap_grows_with_the_repeated_values(spark):
    """Of texts that do not repeat few reach the exact grouping, however many others do."""
    h = spark.range(60_000).selectExpr("xxhash64(concat('r', id)) AS _h")
    bits = checks.BITS_PER_VALUE * 60_000 // 64 * 64
    other = spark.range(60_000).selectExpr("xxhash64(concat('o', id)) AS h")
    word, bit = checks._bit_place(F.col("h"), bits)
    passed = other.where(F.get(checks._bitmap(h, "_h", bits), word).bitwiseAND(bit) != 0).count()
    assert passed < 60_000 / 12
