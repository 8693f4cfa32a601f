import random
from collections import Counter

import pytest

from tessera.llm import quality


def brute(text):
    t = text or ""
    words, word = [], ""
    for c in t + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {k for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1 for k in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))


def texts(rng):
    words = ["the", "a", "été", "#x", "*", "word", "b\x85c", "ﬀ", "long" * 5]
    seps = [" ", " ", "  ", "\n", "\t", "\r\n", "\x0b"]
    out = ["".join(rng.choice(words) + rng.choice(seps) for _ in range(rng.randrange(0, 120))) for _ in range(150)]
    return out + [None, "", " ", "one", "one two", "a a a", "a a a a", "x y z x y z", "l\nl\nl\n\n", "w " * 40_000]


def test_measures(spark):
    rows = [(i, t, "s", 5) for i, t in enumerate(texts(random.Random(0)))]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")
    out = quality.judge(df)
    assert out.columns.count("n_words") == 1
    got = {r.doc_id: tuple(r[m] for m in quality.MEASURES) for r in out.collect()}
    assert got == {i: brute(t) for i, t, *_ in rows}
    for r in out.collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def clean(rng):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(80))


def shrunk(hosts):
    """host -> rate, from host -> (failures, rows)."""
    rates = [f / n for f, n in hosts.values()]
    m = sum(rates) / len(rates)
    v = sum((r - m) ** 2 for r in rates) / len(rates)
    s = m * (1 - m) / v - 1 if v > 0 and m * (1 - m) / v > 1 else sum(n for _, n in hosts.values()) / len(hosts)
    return {h: (f + m * s) / (n + s) for h, (f, n) in hosts.items()}


def test_host_verdicts(spark):
    rng = random.Random(3)
    rows = []
    for host, n, bad in (("good", 60, 1), ("bad", 60, 40), (None, 40, 0), ("tiny", 1, 1)):
        for i in range(n):
            rows.append((len(rows), clean(rng) + (" # * $ %" * 5 if i < bad else ""), host))
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    rates = {r["__t_host"]: r.rate_symbols for r in quality.host_rates(quality.measure(df), "source").collect()}
    want = shrunk({"good": (1, 60), "bad": (40, 60), None: (0, 40), "tiny": (1, 1)})
    assert rates.keys() == want.keys() and all(abs(rates[h] - want[h]) < 1e-9 for h in want)
    assert want["tiny"] < 1  # shrunk
    for r in quality.judge(df).collect():
        failed = "#" in r.text
        assert r.n_failed == failed and r.host_rejects == (failed and want[r.source] >= quality.HOST_LIMIT)
        assert r.kept == (not r.host_rejects)  # clean documents stay, whatever their host


def test_clashing_columns(spark):
    names = ["_w", "_l", "_host", "_strict_symbols", "n", "kept", "N_LINES", "h", "i"]
    df = spark.createDataFrame([(1, "some text", "s")], "doc_id long, text string, source string").selectExpr(
        "*", *[f"'x' AS {n}" for n in names])
    r, = quality.judge(df).collect()
    assert r["_w"] == r["_host"] == r["n"] == "x" and r.kept is False and r.n_words == 2 and r.n_lines == 1


def test_no_rows_and_one_host(spark):
    df = spark.createDataFrame([(1, None, None), (1, None, None)], "doc_id long, text string, source string")
    assert [(r.n_words, r.kept) for r in quality.judge(df).collect()] == [(0, False)] * 2
    assert quality.judge(df.limit(0)).collect() == []


@pytest.mark.parametrize("name", ["op2_mix_sources", "op4_license_scan", "op7_quality_hosts"])
def test_queries_with_sql_match_it(spark, name):
    from tests.oracle_compare import compare
    assert compare(spark, "/root/testdata/sf0.001", [name], verbose=False)[name][0] is True
