import os

import pytest
from pyspark.errors import PySparkException

from tessera.plans import jobs
from tessera.sinks import ViolationsFound, Warehouse
from tessera.sources.vocab import read_vocabulary

from .vocab_fixture import CLEAN, write_vocab


def _wh(spark, workdir):
    wh = Warehouse(spark, os.path.join(workdir, "wh"), "bronze")
    jobs.setup_layer(wh)
    return wh


def test_clean_load_keeps_text_exactly(spark, workdir):
    wh = _wh(spark, workdir)
    counts = jobs.load_vocabulary(wh, write_vocab(os.path.join(workdir, "v")))
    assert counts["concept"] == 9 and counts["drug_strength"] == 1
    names = {r.concept_id: r.concept_name for r in wh.read("shared", "concept").collect()}
    assert names[10] == 'Aspirin "brand" name'
    assert names[11] == 'He said "hi'
    assert names[12] == "back\\slash"
    assert names[13] == "  padded  "
    c1 = wh.read("shared", "concept").where("concept_id = 1").first()
    assert c1.standard_concept is None and str(c1.valid_start_date) == "1970-01-01"
    c2 = wh.read("shared", "concept").where("concept_id = 2").first()
    assert str(c2.valid_end_date) == "2099-12-31"
    ds = wh.read("shared", "drug_strength").first()
    assert float(ds.amount_value) == 5.5 and ds.numerator_unit_concept_id is None
    assert jobs.validate_schema(wh, "shared").count() == 0


def test_reordered_and_uppercase_headers_bind_by_name(spark, workdir):
    frames = read_vocabulary(spark, write_vocab(os.path.join(workdir, "v")))
    v = frames["vocabulary"].first()
    assert v.vocabulary_id == "Vocabulary" and v.vocabulary_concept_id == 2 and v.vocabulary_version == "v5"
    assert frames["domain"].count() == 2


def test_missing_files_are_all_listed(spark, workdir):
    folder = write_vocab(os.path.join(workdir, "v"), drop=("CONCEPT.csv", "DRUG_STRENGTH.csv"))
    with pytest.raises(FileNotFoundError) as e:
        read_vocabulary(spark, folder)
    assert "CONCEPT.csv" in str(e.value) and "DRUG_STRENGTH.csv" in str(e.value)


@pytest.mark.parametrize("bad_line", [
    "30\tBad date\tDrug\tVocabulary\tIngredient\t\tB1\t19701301\t20991231\t",
    "31\t" + "x" * 256 + "\tDrug\tVocabulary\tIngredient\t\tB2\t19700101\t20991231\t",
    "32\tShort row\tDrug",
    "33\tLong row\tDrug\tVocabulary\tIngredient\t\tB3\t19700101\t20991231\t\textra",
    "34\t\tDrug\tVocabulary\tIngredient\t\tB4\t19700101\t20991231\t",
])
def test_bad_rows_fail_and_publish_nothing(spark, workdir, bad_line):
    wh = _wh(spark, workdir)
    folder = write_vocab(os.path.join(workdir, "v"), {"CONCEPT.csv": CLEAN["CONCEPT.csv"] + [bad_line]})
    with pytest.raises((PySparkException, ValueError)):
        jobs.load_vocabulary(wh, folder)
    assert wh.read("shared", "concept").count() == 0
    assert wh.read("shared", "domain").count() == 0


def test_unknown_column_is_an_error(spark, workdir):
    folder = write_vocab(os.path.join(workdir, "v"),
                         {"DOMAIN.csv": ["domain_id\tdomain_name\tdomain_concept_id\tcolour", "Drug\tDrug\t1\tred"]})
    with pytest.raises(ValueError, match="colour"):
        read_vocabulary(spark, folder)


def test_key_violations_block_publish(spark, workdir):
    wh = _wh(spark, workdir)
    lines = CLEAN["CONCEPT.csv"] + [
        "10\tDuplicate id\tDrug\tVocabulary\tIngredient\t\tA9\t19700101\t20991231\t",
        "40\tOrphan domain\tNoSuchDomain\tVocabulary\tIngredient\t\tA8\t19700101\t20991231\t"]
    folder = write_vocab(os.path.join(workdir, "v"), {"CONCEPT.csv": lines})
    with pytest.raises(ViolationsFound) as e:
        jobs.load_vocabulary(wh, folder)
    kinds = {(r["constraint_name"], r["columns"]) for r in e.value.totals}
    assert ("primary_key", "concept_id") in kinds
    assert ("foreign_key:domain.domain_id", "domain_id") in kinds
    assert wh.read("shared", "concept").count() == 0


def test_append_twice_is_reported_as_duplicate_keys(spark, workdir):
    wh = _wh(spark, workdir)
    folder = write_vocab(os.path.join(workdir, "v"))
    jobs.load_vocabulary(wh, folder)
    with pytest.raises(ViolationsFound):
        jobs.load_vocabulary(wh, folder)
    assert wh.read("shared", "concept").count() == 9
