import pytest

from tessera.operators import navigate

from .conftest import rows


@pytest.fixture()
def cdm(spark):
    person = spark.createDataFrame([(1, 10), (2, None), (3, 10)], "person_id int, care_site_id int")
    care_site = spark.createDataFrame([(10, "North", 100)], "care_site_id int, care_site_name string, location_id int")
    location = spark.createDataFrame([(100, "Pune")], "location_id int, city string")
    visit = spark.createDataFrame([(7, 1, None), (8, 1, 7), (9, 2, None), (10, 99, 8)],
                                  "visit_occurrence_id int, person_id int, preceding_visit_occurrence_id int")
    return {"person": person, "care_site": care_site, "location": location, "visit_occurrence": visit}


def test_many_to_one_from_contract(cdm):
    got = navigate.navigate(cdm, "visit_occurrence", "person", take=["care_site_id"])
    assert rows(got, "visit_occurrence_id", "person__care_site_id") == [(7, 10), (8, 10), (9, None), (10, None)]


def test_one_to_many_from_contract(cdm):
    got = navigate.navigate(cdm, "person", "visit_occurrence", take=["visit_occurrence_id"])
    assert rows(got, "person_id", "visit_occurrence__visit_occurrence_id") == \
        [(1, 7), (1, 8), (2, 9), (3, None)]


def test_self_references(cdm):
    v = cdm["visit_occurrence"]
    fwd = navigate.navigate(cdm, "visit_occurrence", "preceding_visit_occurrence", take=["person_id"])
    assert rows(fwd, "visit_occurrence_id", "preceding_visit_occurrence__person_id") == \
        [(7, None), (8, 1), (9, None), (10, 1)]
    rev = navigate.self_one_to_many(v, "preceding_visit_occurrence_id", "visit_occurrence_id",
                                    ["visit_occurrence_id"], "next_")
    assert rows(rev, "visit_occurrence_id", "next_visit_occurrence_id") == [(7, 8), (8, 10), (9, None), (10, None)]


def test_self_reference_on_a_derived_frame_reads_the_stored_table(cdm):
    """A derived frame (here a filtered one) navigates to the stored table:
    references to rows outside the derived frame still resolve."""
    from pyspark.sql import functions as F
    v = cdm["visit_occurrence"]
    later = v.where(F.col("visit_occurrence_id") >= 8)
    own = navigate.self_many_to_one(later, "preceding_visit_occurrence_id", "visit_occurrence_id",
                                    ["person_id"], "preceding_")
    stored = navigate.self_many_to_one(later, "preceding_visit_occurrence_id", "visit_occurrence_id",
                                       ["person_id"], "preceding_", parent=v)
    assert rows(own, "visit_occurrence_id", "preceding_person_id") == [(8, None), (9, None), (10, 1)]
    assert rows(stored, "visit_occurrence_id", "preceding_person_id") == [(8, 1), (9, None), (10, 1)]
    rev = navigate.self_one_to_many(later, "preceding_visit_occurrence_id", "visit_occurrence_id",
                                    ["visit_occurrence_id"], "next_", parent=v)
    assert rows(rev, "visit_occurrence_id", "next_visit_occurrence_id") == [(8, 10), (9, None), (10, None)]


def test_path_equals_chained_left_joins(cdm):
    got = navigate.path(cdm["visit_occurrence"], [
        (cdm["person"], "person_id", "person_id", ["care_site_id"]),
        (cdm["care_site"], "care_site_id", "care_site_id", ["location_id"]),
        (cdm["location"], "location_id", "location_id", ["city"]),
    ])
    assert rows(got, "visit_occurrence_id", "care_site_id", "city") == \
        [(7, 10, "Pune"), (8, 10, "Pune"), (9, None, None), (10, None, None)]


def test_child_counts_and_cascade(cdm):
    counts = navigate.child_counts(cdm["person"], cdm["visit_occurrence"], "person_id", "person_id", "n")
    assert rows(counts, "person_id", "n") == [(1, 2), (2, 1), (3, 0)]
    deleted = cdm["person"].where("person_id = 1")
    left = navigate.cascade_survivors(cdm["visit_occurrence"], deleted, "person_id", "person_id")
    assert rows(left, "visit_occurrence_id") == [(9,), (10,)]
    follow = navigate.following_rows(cdm["visit_occurrence"], deleted, "person_id", "person_id")
    assert rows(follow, "visit_occurrence_id") == [(7,), (8,)]
