import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import infill, resample

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_buckets(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i:i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), Counter(zlib.crc32(r.encode()) % 10000 for r in runs)


def plain_version(docs, target):
    """Rows (doc_id, n_features, weight, score, rank) of equal rows' digest, by loops."""
    found = [plain_buckets(t) for _, t in docs]
    s, t = Counter(), Counter()
    for _, c in found:
        s.update(c)
    for x in target:
        t.update(plain_buckets(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)]
    rows = []
    for (i, _), (n, c) in zip(docs, found):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] * k for b, k in c.items())
        rows.append([i, sum(c.values()), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    fit = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(fit[:5 * len(fit) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


def documents(n=900, seed=3):
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "é", "ÀB", "x1", "漢字", "a" * 70, "q" * 300, "I", "😀"] + [f"w{i}" for i in range(300)]
    def text(k):
        return "".join(rng.choice(vocabulary) + rng.choice([" ", "\n", ", ", "-", "\x7f"]) for _ in range(k))
    rows = [(i, text(rng.choice([0, 1, 2, 19, 20, 21, 60]))) for i in range(n)]
    rows += [(n, None), (n + 1, "   "), (None, text(40)), (None, text(50)), (n + 2, text(3000)), (n + 3, "z" * 100_000 + " z")]
    rows += [rows[40]] * 3 + [rows[41]] * 60
    return rows, [text(30) for _ in range(20)] + [None, ""]


def key(r):
    return tuple((x is None, x) for x in r)


def test_equals_plain_version(spark):
    rows, target = documents()
    df = spark.createDataFrame([(i, t, 5, "old", 3) for i, t in rows], "doc_id long, text string, rank int, row string, low int")
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resample(df.repartition(7), bench)
    assert got.columns == ["doc_id", "row", "low", "n_words", "n_features", "weight", "score", "rank"]
    got = [(r.doc_id, r.n_features, r.weight, r.score, r["rank"]) for r in got.collect()]
    assert sorted(got, key=key) == sorted(plain_version(rows, target), key=key)


def test_runs_over_small_windows(monkeypatch):
    rows, _ = documents(200)
    texts = [t for _, t in rows]
    monkeypatch.setattr(resample, "WINDOW", 50)
    data, ends = infill._buffer(pa.array(texts, pa.string()))
    got = [Counter() for _ in texts]
    words = np.zeros(len(texts), np.int64)
    for n, buckets, owners in resample.runs(resample._LOWER[data], ends):
        words += n
        for b, o in zip(buckets, owners):
            got[o][int(b)] += 1
    assert [(int(n), c) for n, c in zip(words, got)] == [plain_buckets(t) for t in texts]


@pytest.mark.parametrize("k", [1, 2, 37, 500, 999, 1000])
def test_cutoff(spark, k):
    rng = random.Random(k)
    keys = [(rng.randrange(-9, 9), rng.randrange(2), rng.randrange(5), i) for i in range(1000)]
    df = spark.createDataFrame(keys, "low long, none long, id long, row long").repartition(9)
    assert resample.cutoff(df, k) == sorted(keys)[k - 1]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    one = spark.createDataFrame([(1, "a b c " * 20)], "doc_id long, text string")
    assert resample.resample(none, one).collect() == []
    assert [tuple(r) for r in resample.resample(one, none, percent=100).select("doc_id", "n_words", "rank").collect()] == [(1, 60, 1)]
    assert [r["rank"] for r in resample.resample(one, one).collect()] == [None]
    kept = resample.resample(one, one, keep_text=True)
    assert kept.columns == ["doc_id", "text", "n_words", "n_features", "weight", "score", "rank"]
