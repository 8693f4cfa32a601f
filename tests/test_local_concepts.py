import os
import time

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tessera.plans import jobs
from tessera.sinks import ViolationsFound, Warehouse
from tessera.sources.local_files import read_delimited


def _csv(workdir, name, lines):
    path = os.path.join(workdir, name)
    with open(path, "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def _wh(spark, workdir):
    wh = Warehouse(spark, os.path.join(workdir, "wh"), "bronze")
    jobs.setup_layer(wh)
    return wh


HEADER = " ID ,Cohort,source_field_name,Is_Active,source_field_range,concept_id,table,colour"


def test_replace_coerces_and_defaults(spark, workdir):
    wh = _wh(spark, workdir)
    path = _csv(workdir, "lc.csv", [
        HEADER,
        '1,101,age,TRUE,"{""min"": 0}",2000000001,person,red',
        '2, 7 ,sex, yes ,NULL,2000000002,person,blue',
        '3,7.9,bmi,f,not json,,measurement,',
        '4,1e3,ht,0,,None,measurement,x',
    ])
    res = jobs.load_local_concepts(wh, path, mode="replace")
    assert res == {"mode": "replace", "inserted": 4}
    got = {r.id: r for r in wh.read("shared", "local_concept").collect()}
    assert got[1].cohort == 101 and got[2].cohort == 7 and got[3].cohort == 7 and got[4].cohort == 1000
    assert [got[i].is_active for i in (1, 2, 3, 4)] == [True, True, False, False]
    assert got[3].concept_id is None and got[4].concept_id is None
    assert got[1].created_at is not None and got[1].updated_at is not None
    lc = wh.read("shared", "local_concept")
    js = {r.id: r.j for r in lc.select("id", F.to_json("source_field_range").alias("j")).collect()}
    assert js == {1: '{"min":0}', 2: None, 3: '"not json"', 4: None}


def test_replace_without_ids_restarts_identity_in_file_order(spark, workdir):
    wh = _wh(spark, workdir)
    path = _csv(workdir, "lc.csv", ["source_field_name,cohort"] + [f"f{i},1" for i in range(50)])
    jobs.load_local_concepts(wh, path)
    got = sorted((r.id, r.source_field_name) for r in wh.read("shared", "local_concept").collect())
    assert got == [(i + 1, f"f{i}") for i in range(50)]
    # replace again: ids restart at 1, old rows gone
    path2 = _csv(workdir, "lc2.csv", ["source_field_name,cohort", "g0,1", "g1,1"])
    jobs.load_local_concepts(wh, path2)
    got = sorted((r.id, r.source_field_name) for r in wh.read("shared", "local_concept").collect())
    assert got == [(1, "g0"), (2, "g1")]


def test_bad_cell_fails_and_keeps_target(spark, workdir):
    wh = _wh(spark, workdir)
    jobs.load_local_concepts(wh, _csv(workdir, "ok.csv", ["id,is_active", "1,true"]))
    with pytest.raises(PySparkException, match="not a valid bool"):
        jobs.load_local_concepts(wh, _csv(workdir, "bad.csv", ["id,is_active", "1,y"]))
    assert wh.read("shared", "local_concept").count() == 1


def test_header_only_file_leaves_target(spark, workdir):
    wh = _wh(spark, workdir)
    jobs.load_local_concepts(wh, _csv(workdir, "ok.csv", ["id,is_active", "1,true"]))
    res = jobs.load_local_concepts(wh, _csv(workdir, "empty.csv", ["id,is_active"]))
    assert res == {"mode": "replace", "rows": 0}
    assert wh.read("shared", "local_concept").count() == 1


def test_no_known_column_and_bad_suffix(spark, workdir):
    wh = _wh(spark, workdir)
    with pytest.raises(ValueError, match="is a column of local_concept"):
        jobs.load_local_concepts(wh, _csv(workdir, "x.csv", ["colour", "red"]))
    with pytest.raises(ValueError, match="neither delimited text"):
        jobs.load_local_concepts(wh, _csv(workdir, "x.txt", ["id", "1"]))
    with pytest.raises(FileNotFoundError):
        jobs.load_local_concepts(wh, os.path.join(workdir, "missing.csv"))


def test_dry_run_writes_nothing(spark, workdir):
    wh = _wh(spark, workdir)
    res = jobs.load_local_concepts(wh, _csv(workdir, "a.csv", ["id,cohort", "1,2", "2,3"]), dry_run=True)
    assert res == {"mode": "replace", "rows": 2, "dry_run": True}
    assert wh.read("shared", "local_concept").count() == 0


def test_upsert(spark, workdir):
    wh = _wh(spark, workdir)
    jobs.load_local_concepts(wh, _csv(workdir, "a.csv", [
        "id,cohort,source_field_name,dataset", "1,1,a,d1", "2,1,b,d2"]))
    before = {r.id: r for r in wh.read("shared", "local_concept").collect()}
    time.sleep(0.05)
    res = jobs.load_local_concepts(wh, _csv(workdir, "b.csv", ["id,source_field_name", "2,B", "3,c"]),
                                   mode="upsert")
    assert res["rows"] == 2 and res["rowcount"] == 2
    after = {r.id: r for r in wh.read("shared", "local_concept").collect()}
    assert sorted(after) == [1, 2, 3]
    assert after[1] == before[1]
    assert after[2].source_field_name == "B" and after[2].dataset == "d2"  # other columns unchanged
    assert after[2].created_at == before[2].created_at
    assert after[2].updated_at > before[2].updated_at
    assert after[3].is_active is True and after[3].cohort is None
    # idempotent: the same upsert again changes only the refresh stamp
    jobs.load_local_concepts(wh, _csv(workdir, "b2.csv", ["id,source_field_name", "2,B", "3,c"]),
                             mode="upsert")
    again = {r.id: r for r in wh.read("shared", "local_concept").collect()}
    strip = lambda r: {k: v for k, v in r.asDict().items() if k != "updated_at"}
    assert {k: strip(v) for k, v in again.items()} == {k: strip(v) for k, v in after.items()}


@pytest.mark.parametrize("lines", [["id,dataset", "1,a", "1,b"], ["id,dataset", ",a"]])
def test_upsert_rejects_repeated_or_null_ids(spark, workdir, lines):
    wh = _wh(spark, workdir)
    with pytest.raises(ViolationsFound, match="primary_key"):
        jobs.load_local_concepts(wh, _csv(workdir, "u.csv", lines), mode="upsert")


def test_upsert_requires_id_column(spark, workdir):
    wh = _wh(spark, workdir)
    with pytest.raises(ValueError, match="missing required column"):
        jobs.load_local_concepts(wh, _csv(workdir, "u.csv", ["dataset", "a"]), mode="upsert")


def test_typed_frame_input(spark, workdir):
    wh = _wh(spark, workdir)
    typed = spark.createDataFrame([(1, 3.0, True)], "ID int, Cohort double, is_active boolean")
    jobs.load_local_concepts(wh, "sheet.xlsx", typed=typed)
    r = wh.read("shared", "local_concept").first()
    assert (r.id, r.cohort, r.is_active) == (1, 3, True)


def test_dry_run_still_coerces_every_cell(spark, workdir):
    wh = _wh(spark, workdir)
    with pytest.raises(PySparkException, match="not a valid bool"):
        jobs.load_local_concepts(wh, _csv(workdir, "bad.csv", ["id,is_active", "1,y"]), dry_run=True)


def test_rows_wider_than_the_header_are_errors(spark, workdir):
    for n, row in enumerate(["2,b,EXTRA,MORE", "2,b,x", '2,"b,c",x', '2,b,', '2,"a ""q"", b",c,']):
        path = _csv(workdir, f"long{n}.csv", ["id,dataset", "1,a", row])
        with pytest.raises(PySparkException, match="more fields than the header"):
            read_delimited(spark, path).select("id").collect()
    wh = _wh(spark, workdir)
    with pytest.raises(PySparkException, match="more fields"):
        jobs.load_local_concepts(wh, path)
    assert wh.read("shared", "local_concept").count() == 0


def test_short_rows_are_filled(spark, workdir):
    path = _csv(workdir, "short.csv", ["a,b,c", "1", '2,"x,""y"""', "3,x,z", '"4, 5"'])
    assert [tuple(r) for r in read_delimited(spark, path).collect()] == [
        ("1", None, None), ("2", 'x,"y"', None), ("3", "x", "z"), ("4, 5", None, None)]
    assert read_delimited(spark, _csv(workdir, "one.csv", ["a", "1", "2"])).collect() == [("1",), ("2",)]


def test_unclosed_quotes_are_errors(spark, workdir):
    path = _csv(workdir, "open.csv", ["id,dataset", '4,"unclosed', "5,c"])
    with pytest.raises(ValueError, match="unclosed quote"):
        read_delimited(spark, path)
    # of several files one
    folder = os.path.join(workdir, "many.csv")
    os.makedirs(folder)
    for n, line in enumerate(['1,"a"', '2,"b']):
        _csv(folder, f"p{n}.csv", ["id,dataset", line])
    with pytest.raises(ValueError, match="1 of the files.*p1.csv"):
        read_delimited(spark, folder)


def test_fields_over_several_lines(spark, workdir):
    path = _csv(workdir, "lines.csv", ["id,dataset", '1,"a', 'b, ""q""', 'c"', "2,d"])
    assert [tuple(r) for r in read_delimited(spark, path).collect()] == [("1", 'a\nb, "q"\nc'), ("2", "d")]
    bad = _csv(workdir, "lines2.csv", ["id,dataset", '1,"a', 'b",c', "2,d"])
    with pytest.raises(PySparkException, match="more fields"):
        read_delimited(spark, bad).collect()
