"""Property tests (few examples each: every example runs Spark jobs)."""
import datetime
import os
import tempfile

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tessera.operators import checks, sequence
from tessera.plans import jobs
from tessera.sinks import Warehouse, upsert_frames

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))

keyed_rows = st.lists(st.tuples(st.integers(0, 40), st.text("abc", max_size=3)), max_size=30,
                      unique_by=lambda r: r[0])


@SETTINGS
@given(target=keyed_rows, source=keyed_rows)
def test_upsert_is_idempotent_and_matches_dict_semantics(spark, target, source):
    t = spark.createDataFrame(target, "k int, v string")
    s = spark.createDataFrame(source, "k int, v string")
    once = upsert_frames(t, s, "k", ["v"], preserve=(), touch=None)
    twice = upsert_frames(once, s, "k", ["v"], preserve=(), touch=None)
    expected = dict(target)
    expected.update(dict(source))
    got1 = sorted(map(tuple, once.collect()))
    assert got1 == sorted(expected.items())
    assert sorted(map(tuple, twice.collect())) == got1


@SETTINGS
@given(values=st.lists(st.integers(-5, 5), max_size=60), parts=st.integers(1, 9))
def test_assign_ids_is_a_dense_order_preserving_numbering(spark, values, parts):
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], "v int, i int")
    got = sorted(map(tuple, sequence.assign_ids(df, ["v", "i"], "id", partitions=parts)
                 .select("id", "v", "i").collect()))
    assert [g[0] for g in got] == list(range(1, len(values) + 1))
    assert [(g[1], g[2]) for g in got] == sorted((v, i) for i, v in enumerate(values))


@SETTINGS
@given(keys=st.lists(st.one_of(st.none(), st.integers(0, 6)), max_size=40))
def test_duplicate_keys_match_counting(spark, keys):
    df = spark.createDataFrame([(k,) for k in keys], "k int")
    got = sorted(map(tuple, checks.duplicate_keys(df, ["k"], skip_nulls=True).collect()))
    counts = {}
    for k in keys:
        if k is not None:
            counts[k] = counts.get(k, 0) + 1
    assert got == sorted((k, n) for k, n in counts.items() if n > 1)


def test_replace_twice_equals_once(spark):
    root = tempfile.mkdtemp(prefix="tessera-prop-")
    path = os.path.join(root, "lc.csv")
    with open(path, "w") as f:
        f.write("source_field_name,cohort\n" + "".join(f"f{i},{i % 3}\n" for i in range(30)))
    wh = Warehouse(spark, os.path.join(root, "wh"))
    jobs.setup_layer(wh)
    jobs.load_local_concepts(wh, path)
    first = sorted((r.id, r.source_field_name, r.cohort) for r in wh.read("shared", "local_concept").collect())
    jobs.load_local_concepts(wh, path)
    second = sorted((r.id, r.source_field_name, r.cohort) for r in wh.read("shared", "local_concept").collect())
    assert first == second


def test_cohort_checks_stack_concept_keys_across_tables(spark):
    root = tempfile.mkdtemp(prefix="tessera-prop-")
    wh = Warehouse(spark, os.path.join(root, "wh"))
    jobs.setup_layer(wh, cohorts=["cohort_101"])
    d = datetime.date(2020, 1, 1)
    concept = spark.createDataFrame(
        [(c, f"c{c}", "D", "V", "C", str(c), d, d, None, None) for c in (1, 2, 3)],
        wh.contracts("shared")["concept"].spark_schema)
    wh.replace("shared", {"concept": concept}, check=False)
    person = spark.createDataFrame([(1, 1, 1970, 2, 3), (2, 9, 1980, 2, 3)],
                                   "person_id int, gender_concept_id int, year_of_birth int, "
                                   "race_concept_id int, ethnicity_concept_id int")
    visit = spark.createDataFrame([(5, 1, 8, d, d, 1), (6, 2, 8, d, d, 1)],
                                  "visit_occurrence_id int, person_id int, visit_concept_id int, "
                                  "visit_start_date date, visit_end_date date, visit_type_concept_id int")
    wh.replace("cohort_101", {"person": person, "visit_occurrence": visit}, check=False)
    rep = jobs.validate_schema(wh, "cohort_101")
    got = sorted((r.table_name, r.columns, r.key, r.n) for r in rep.collect())
    assert got == [("person", "gender_concept_id", "9", 1), ("visit_occurrence", "visit_concept_id", "8", 2)]
