import datetime

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.operators import derive

from .conftest import rows


def test_union_cohorts_requires_same_columns(spark):
    a = spark.createDataFrame([(1,)], "person_id int")
    b = spark.createDataFrame([(2,)], "person_id int")
    got = derive.union_cohorts({"cohort_101": a, "cohort_102": b})
    assert rows(got) == [("cohort_101", 1), ("cohort_102", 2)]
    c = spark.createDataFrame([(3, 1)], "person_id int, extra int")
    with pytest.raises(PySparkException):
        derive.union_cohorts({"x": a, "y": c}).collect()


def test_enrich_concepts_names_each_column(spark):
    concept = spark.createDataFrame([(1, "Male"), (2, "Asian"), (3, "unused")], "concept_id int, concept_name string")
    person = spark.createDataFrame([(10, 1, 2), (11, 1, None)], "person_id int, gender_concept_id int, race_concept_id int")
    got = derive.enrich_concepts(person, concept, ["gender_concept_id", "race_concept_id"])
    assert rows(got, "person_id", "gender_concept_id__concept_name", "race_concept_id__concept_name") == \
        [(10, "Male", "Asian"), (11, "Male", None)]


def test_map_source_codes_with_validity(spark):
    d = datetime.date
    mapping = spark.createDataFrame(
        [("A", 1, d(2020, 1, 1), d(2020, 12, 31), None), ("A", 2, d(2021, 1, 1), d(2099, 12, 31), None),
         ("B", 3, d(2000, 1, 1), d(2099, 12, 31), "D")],
        "source_code string, target_concept_id int, valid_start_date date, valid_end_date date, invalid_reason string")
    ev = spark.createDataFrame([(1, "A", d(2020, 6, 1)), (2, "A", d(2022, 1, 1)), (3, "B", d(2022, 1, 1)),
                                (4, "C", d(2022, 1, 1))], "id int, code string, day date")
    got = derive.map_source_codes(ev, mapping, "code", "day")
    assert rows(got, "id", "target_concept_id") == [(1, 1), (2, 2), (3, None), (4, None)]


def test_route_fields(spark):
    wide = spark.createDataFrame([(1, "70", "M")], "person_id int, weight string, sex string")
    lc = spark.createDataFrame([(101, "weight", 2000000001, "measurement", True),
                                (101, "sex", 2000000002, "person", True),
                                (102, "weight", 2000000009, "measurement", True)],
                               "cohort int, source_field_name string, concept_id int, table string, is_active boolean")
    got = derive.route_fields(wide, lc, ["person_id"], 101)
    assert rows(got, "source_field_name", "value", "concept_id", "target_table") == \
        [("sex", "M", 2000000002, "person"), ("weight", "70", 2000000001, "measurement")]


def test_rollup_counts_per_ancestor(spark):
    events = spark.createDataFrame([(1,), (1,), (2,), (3,)], "concept_id int")
    anc = spark.createDataFrame([(10, 1, 1), (10, 2, 1), (20, 1, 2), (1, 1, 0)],
                                "ancestor_concept_id int, descendant_concept_id int, min_levels_of_separation int")
    got = derive.rollup(events, "concept_id", anc, "descendant_concept_id", "ancestor_concept_id")
    assert rows(got) == [(1, 2), (10, 3), (20, 2)]
    got = derive.rollup(events, "concept_id", anc, "descendant_concept_id", "ancestor_concept_id", max_levels=1)
    assert rows(got) == [(1, 2), (10, 3)]


def test_attribute_and_counts_follow_join_multiplicity(spark):
    recs = spark.createDataFrame([("b1",), ("b2",), ("b3",)], "barcode string")
    parts = spark.createDataFrame([("b1", "s1"), ("b1", "s2"), ("b2", "s3")], "barcode string, subject_id string")
    att = derive.attribute(recs, parts, "barcode")
    assert rows(att, "barcode", "dest") == [("b1", "cohort"), ("b2", "cohort"), ("b3", "orphan")]
    assert rows(derive.route_counts(att)) == [("cohort", 2), ("orphan", 1)]  # records, not matches


def test_three_way_routing(spark):
    recs = spark.createDataFrame([("b1", 1), ("b1", 2), ("b2", 3), ("b3", 4), (None, 5), (None, 6)], "barcode string, v int")
    parts = spark.createDataFrame([("b1", "s1"), ("b1", "s2")], "barcode string, subject_id string")
    errors = spark.createDataFrame([("b3",), ("b3",), ("b1",)], "barcode string")
    att = derive.attribute(recs, parts, "barcode", errors)
    assert rows(derive.route_counts(att)) == [("cohort", 2), ("identifier_errors", 3), ("orphan", 1)]
    routed = derive.route(att)
    assert {k: sorted(r.v for r in df.collect()) for k, df in routed.items()} == {
        "cohort": [1, 2], "identifier_errors": [4, 5, 6], "orphan": [3]}
    assert routed["orphan"].columns == recs.columns


def test_checksum_dedupe_and_red_flags(spark):
    df = spark.createDataFrame([(3, "x"), (1, "x"), (2, "y")], "id int, payload string")
    got = rows(derive.dedupe_by_checksum(df, "payload", "id"), "id")
    assert got == [(1,), (2,)]
    m = spark.createDataFrame([(1, 50.0), (2, -1.0), (3, 250.0)], "measurement_id int, value double")
    flagged = derive.red_flags(m, "value", 0, 200)
    assert rows(flagged, "measurement_id", "value", "is_red") == [(1, 50.0, False), (2, None, True), (3, None, True)]
    red = spark.createDataFrame([(2, "-1", "1.5"), (3, "250", None)],
                                "measurement_id int, original_value string, new_value string")
    fixed = derive.overlay_corrections(m, red, "measurement_id", "value")
    assert rows(fixed, "measurement_id", "value") == [(1, 50.0), (2, 1.5), (3, 250.0)]


def test_link_facts(spark):
    fr = spark.createDataFrame([(8, 1, 21, 100, 44), (8, 2, 13, 200, 44)],
                               "domain_concept_id_1 int, fact_id_1 int, domain_concept_id_2 int, fact_id_2 int, "
                               "relationship_concept_id int")
    visits = spark.createDataFrame([(1, "v1"), (2, "v2")], "visit_id int, label string")
    meas = spark.createDataFrame([(100, 5.0)], "measurement_id int, value double")
    got = derive.link_facts(fr, visits, 8, "visit_id", meas, 21, "measurement_id")
    assert rows(got, "fact_id_1", "fact_id_2", "label", "value") == [(1, 100, "v1", 5.0)]


def test_source_lineage(spark):
    sl = spark.createDataFrame([(1, 5, None), (2, None, 7)], "id int, instrument_id int, endpoint_id int")
    inst = spark.createDataFrame([(5, 1, 1, 1, 1)], "id int, cohort_id int, assessment_id int, machine_id int, place_id int")
    ass = spark.createDataFrame([(1, "MoCA")], "id int, name string")
    mac = spark.createDataFrame([(1, "Scanner")], "id int, name string")
    pla = spark.createDataFrame([(1, "Pune", "MH")], "id int, city string, state string")
    ep = spark.createDataFrame([(7, 3, "/v1/x", "GET")], "id int, api_id int, path string, method string")
    api = spark.createDataFrame([(3, "Forms")], "id int, name string")
    got = derive.source_lineage(sl, inst, ep, api, ass, mac, pla)
    assert rows(got, "id", "assessment_name", "machine_name", "place_city", "path", "name") == \
        [(1, "MoCA", "Scanner", "Pune", None, None), (2, None, None, None, "/v1/x", "Forms")]


def test_synonyms(spark):
    concept = spark.createDataFrame([(1, "English"), (10, "Aspirin")], "concept_id int, concept_name string")
    syn = spark.createDataFrame([(10, "ASA", 1)], "concept_id int, concept_synonym_name string, language_concept_id int")
    got = derive.synonyms(concept, syn)
    assert rows(got, "concept_id", "concept_synonym_name", "language_concept_name") == \
        [(1, None, None), (10, "ASA", "English")]
    assert F is not None


def test_related_validity_and_reverse_lookup(spark):
    d = datetime.date
    cr = spark.createDataFrame(
        [(1, 10, "Maps to", d(2000, 1, 1), d(2099, 12, 31), None),
         (10, 1, "Mapped from", d(2000, 1, 1), d(2099, 12, 31), None),
         (2, 20, "Maps to", d(2000, 1, 1), d(2010, 12, 31), None),     # expired before as_of
         (3, 30, "Maps to", d(2000, 1, 1), d(2099, 12, 31), "D"),      # invalid
         (4, 40, "Is a", d(2000, 1, 1), d(2099, 12, 31), None)],
        "concept_id_1 int, concept_id_2 int, relationship_id string, valid_start_date date, "
        "valid_end_date date, invalid_reason string")
    rel = spark.createDataFrame([("Maps to", "Mapped from"), ("Mapped from", "Maps to"), ("Is a", "Subsumes")],
                                "relationship_id string, reverse_relationship_id string")
    as_of = F.lit(d(2020, 1, 1))
    assert rows(derive.related(cr, "Maps to", as_of)) == [(1, 10)]
    assert rows(derive.related(cr, "Maps to")) == [(1, 10), (2, 20)]
    # the reverse of 'Mapped from' is looked up in the relationship table
    assert rows(derive.reverse_of(rel, "Mapped from")) == [("Maps to",)]
    assert rows(derive.related(cr, derive.reverse_of(rel, "Mapped from"), as_of)) == [(1, 10)]
    assert rows(derive.related(cr, derive.reverse_of(rel, "Maps to"), as_of)) == [(10, 1)]
    # a relationship whose reverse has no edges yields nothing
    assert rows(derive.related(cr, derive.reverse_of(rel, "Is a"))) == []


def test_relationship_traversal_brute_force(spark):
    """The driver query against a pure-Python count over the same rows."""
    from collections import defaultdict

    from tessera.plans import queries as Q
    sf = "/root/testdata/sf0.001"
    li = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        "l_partkey", "l_suppkey", "l_shipdate", "l_returnflag").collect()
    want = defaultdict(set)
    for p, s, ship, flag in li:
        if flag != "R" and ship is not None and ship.date() <= Q.AS_OF <= Q.OPEN_END:
            want[p].add(s)
    got = rows(Q.relationship_traversal(spark, sf))
    assert got == sorted((p, len(s)) for p, s in want.items())


def test_canonical_checksums(spark):
    same = ['{"a":1,"b":[1.50, "x\\"1.0"]}', '{ "b" : [15e-1,"x\\"1.0"], "a":1.0 }', '{"b":[1.5,"x\\u00221.0"],"a":1e0}']
    other = ['{"a":1,"b":[1.5,"x\\"1"]}', '{"a":"1","b":[1.5,"x\\"1.0"]}', "not json", '"not json"', "null", '{"a":1,"a":2}', "\\\\1.0", "10.01", "10"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*same, *other, None, "-0.0", "0", "100.0", "1e2"])], "id int, payload string")
    got = rows(derive.dedupe_by_checksum(df, "payload", "id", canonical=True), "id")
    # text that is no JSON is the JSON string of itself; 0 and -0.0, 100.0 and 1e2 are one
    want = [0, 3, 4, 5, 7, 8, 9, 10, 11, 12, 13, 15]
    assert [i for i, in got] == want
    variant = df.where("id < 3").withColumn("payload", F.parse_json("payload"))
    assert rows(derive.dedupe_by_checksum(variant, "payload", "id", canonical=True), "id") == [(0,)]


def test_episode_events_of_many_tables(spark):
    visits = spark.createDataFrame([(1, "v1"), (2, "v2")], "visit_id int, label string")
    meas = spark.createDataFrame([(1, "m1"), (100, "m2")], "measurement_id long, name string")
    links = spark.createDataFrame([(7, 1, 10), (7, 1, 20), (8, 100, 20), (8, 55, 10), (8, 1, 30), (9, None, 10)],
                                  "episode_id long, event_id long, episode_event_field_concept_id int")
    directory = derive.event_directory({10: ("visit", visits, "visit_id", {"what": "label"}), 20: ("measurement", meas, "measurement_id", {"what": "name"})})
    episode = spark.createDataFrame([(7, "cancer"), (8, "flu")], "episode_id long, kind string")
    got = derive.link_episode_events(links, directory, episode)
    assert rows(got, "episode_id", "event_id", "event_table", "what", "kind") == [
        (7, 1, "measurement", "m1", "cancer"), (7, 1, "visit", "v1", "cancer"), (8, 1, None, None, "flu"), (8, 55, None, None, "flu"),
        (8, 100, "measurement", "m2", "flu"), (9, None, None, None, None)]
