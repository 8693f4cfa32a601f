import json
import os

import pytest
from pyspark.errors import PySparkException

from tessera.operators import codebook
from tessera.sources.codebook import read_codebooks


def _books(folder, docs, raw=None):
    os.makedirs(folder, exist_ok=True)
    for name, doc in docs.items():
        with open(os.path.join(folder, f"Codebook_{name}.json"), "w") as f:
            f.write(raw[name] if raw and name in raw else json.dumps(doc))
    return folder


def test_merge_tags_each_question(spark, workdir):
    folder = _books(workdir, {"A": {"questions": [{"name": "q1", "type": "int"}, {"name": "q2"}]},
                              "B": {"questions": [{"name": "q3"}]}, "C": {"title": "no questions"}})
    items = codebook.merge(read_codebooks(spark, folder, ["A", "B", "C"]))
    got = sorted((r.name, r.codebook) for r in items.collect())
    assert got == [("q1", "A"), ("q2", "A"), ("q3", "B")]


def test_duplicates_across_and_within_books(spark, workdir):
    folder = _books(workdir, {"A": {"questions": [{"name": "q1"}, {"name": "q1"}]},
                              "B": {"questions": [{"name": "q1"}, {"name": "q9"}]}})
    books = read_codebooks(spark, folder, ["A", "B"])
    dups = codebook.duplicate_names(codebook.questions(books)).collect()
    assert [(r.name, r.n, r.books) for r in dups] == [("q1", 3, "A,B")]
    with pytest.raises(codebook.RepeatedNames, match="more than once: 1 ") as e:
        codebook.merge(books)
    assert [tuple(r) for r in spark.read.parquet(e.value.path).collect()] == [("q1", 3, "A,B")]


def test_merge_lists_every_duplicate(spark, workdir):
    names = [{"name": f"q{i}"} for i in range(70)]
    folder = _books(workdir, {"A": {"questions": names}, "B": {"questions": names}})
    path = os.path.join(workdir, "report")
    with pytest.raises(codebook.RepeatedNames) as e:
        codebook.merge(read_codebooks(spark, folder, ["A", "B"]), path)
    assert e.value.total == 70 and e.value.path == path and path in str(e.value)
    assert {tuple(r) for r in spark.read.parquet(path).collect()} == {(f"q{i}", 2, "A,B") for i in range(70)}


def test_missing_file_and_malformed_json(spark, workdir):
    folder = _books(workdir, {"A": {"questions": []}})
    with pytest.raises(FileNotFoundError, match="B"):
        read_codebooks(spark, folder, ["A", "B"])
    folder = _books(os.path.join(workdir, "m"), {"A": {}}, raw={"A": "{not json"})
    with pytest.raises(PySparkException, match="A: the codebook file is not JSON"):
        read_codebooks(spark, folder, ["A"]).collect()


def test_question_without_name_fails(spark, workdir):
    folder = _books(workdir, {"A": {"questions": [{"label": "x"}]}})
    with pytest.raises(PySparkException, match="a question has no name"):
        codebook.questions(read_codebooks(spark, folder, ["A"])).collect()


def test_documents_over_several_lines(spark, workdir):
    text = json.dumps({"questions": [{"name": "q1"}, {"name": "q2"}]}, indent=1)
    folder = _books(workdir, {"A": {}}, raw={"A": text})
    os.makedirs(os.path.join(folder, "Codebook_B.json"))  # a book may be a folder of part files
    with open(os.path.join(folder, "Codebook_B.json", "part-0"), "w") as f:
        f.write(text.replace("q1", "p1").replace("q2", "p2"))
    items = codebook.merge(read_codebooks(spark, folder, ["A", "B"]))
    assert sorted((r.name, r.codebook) for r in items.collect()) == [("p1", "B"), ("p2", "B"), ("q1", "A"), ("q2", "A")]


def test_unregistered_questions(spark, workdir):
    folder = _books(workdir, {"A": {"questions": [{"name": "q1"}, {"name": "q2"}]}})
    items = codebook.merge(read_codebooks(spark, folder, ["A"]))
    lc = spark.createDataFrame([("q1",), (None,)], "source_field_name string")
    assert [r.name for r in codebook.unregistered(items, lc).collect()] == ["q2"]
