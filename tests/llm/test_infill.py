import hashlib
import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm import infill


def plain_version(doc_id, text, seed=1):
    """(n, form, prefix chars, middle chars, output) by string slices."""
    text = text or ""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    if h[3] % 100 < 20:
        return n, "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}"


ALPHABET = ["a", "b", "<", ">", "P", "S", "M", "é", "漢", "😀", "\n", " ", "\x00", "é"]


def documents(n=1500, seed=4):
    rng = random.Random(seed)
    rows = [(i, "".join(rng.choices(ALPHABET, k=rng.choice([0, 1, 2, 5, 40])))) for i in range(n)]
    rows += [(n, None), (None, "no id"), (None, None), (n + 1, "x" * 3_000_000 + "é漢" * 200_000), (n + 2, "é" * 5000),
             (7, rows[7][1]), (7, rows[7][1]), (n + 3, "a <P> b"), (n + 4, "<<P"), (n + 5, "<S>")]
    return rows


def test_equals_plain_version_and_comes_back(spark):
    rows = documents()
    df = spark.createDataFrame([(i, t, "old", 1) for i, t in rows], "doc_id long, text string, output string, __t_x int")
    got = infill.restore(infill.infill(df)).collect()
    assert len(got) == len(rows)
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r.doc_id, r.n_chars, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=key) == \
        sorted(((i, *plain_version(i, t)) for i, t in rows), key=key)
    assert sorted(((r.doc_id, r.restored) for r in got), key=key) == sorted(((i, t or "") for i, t in rows), key=key)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_windows_smaller_than_texts(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choices(ALPHABET[7:], k=rng.choice([0, 3, 90]))) for _ in range(60)]
    form = np.array([rng.randrange(3) if t else 0 for t in texts])
    one, other = (np.array([rng.randrange(1 << 32) for _ in texts]) for _ in range(2))
    whole = infill.rearrange(pa.array(texts), form, one, other)
    monkeypatch.setattr(infill, "WINDOW", 7)
    monkeypatch.setattr(infill, "BLOCK", 5)
    small = infill.rearrange(pa.array(texts), form, one, other)
    assert whole[0] == small[0] and all((x == y).all() for x, y in zip(whole[1:], small[1:]))
    assert infill.restore_batch(small[0], form).to_pylist() == texts
    # a slice of an array that begins elsewhere
    assert infill.restore_batch(small[0].slice(11, 20), form[11:31]).to_pylist() == texts[11:31]


def test_outputs_that_are_not_of_their_form(spark):
    df = spark.createDataFrame([("<P>a<S>b", "psm"), ("a", "spm"), (None, "plain"), ("x", None), ("<S>c<P>a<M>b", "spm"), ("y", "plain")],
                               "output string, form string")
    assert [r.restored for r in infill.restore(df).collect()] == [None, None, None, None, "abc", "y"]


def test_empty_table_and_rates(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert infill.restore(infill.infill(empty)).collect() == []
    df = spark.range(200).withColumnRenamed("id", "doc_id").withColumn("text", F.lit("some text"))
    assert {r.form for r in infill.infill(df, rate=0).collect()} == {"plain"}
    assert {r.form for r in infill.infill(df, rate=100, suffix_first=100).collect()} == {"spm"}
    assert infill.infill(df, seed=2).collect() != infill.infill(df).collect()
