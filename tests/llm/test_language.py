import math
import random
import zlib
from collections import Counter, defaultdict

import pytest

from tessera.llm import language

WORDS = {"en": "the of and house winter green lying thorough ship water", "de": "der und das haus winter grün straße wörter schiff wasser",
         "fr": "le la et maison hiver vert été naïve bateau eau", "ru": "и дом зима зелёный корабль вода над под лес река"}


def documents(n=1200, seed=2):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        lang = rng.choices(list(WORDS), [6, 2, 1, 1])[0]
        stem = WORDS[lang].split()
        text = " ".join(rng.choice(stem) + ("" if rng.random() < .6 else rng.choice(stem)) for _ in range(rng.randrange(1, 40)))
        rows.append((i, text.upper() if i % 5 == 0 else text, None if i % 11 == 0 else lang))
    rows += [(n, None, "en"), (n + 1, "", "de"), (n + 2, "123 !?", "fr"), (None, "the house of water", "en"), (n + 3, "漢字 漢字", None),
             (n + 4, "winter " * 300_000, "en"), (n + 5, "ab" * 600_000, None), rows[3], rows[3]]
    return rows


def learned(i, lang, text):
    return lang is not None and text is not None and zlib.crc32(("" if i is None else str(i)).encode()) % 4 != 2


def plain_version(rows):
    """Predictions by a model of all labelled rows, worked out one word at a time."""
    n_rows, counts = Counter(), defaultdict(Counter)
    for i, text, lang in rows:
        if learned(i, lang, text):
            n_rows[lang] += 1
            for w in [w for part in language.words(text) for w in part if len(w) <= language.LONGEST]:
                counts[lang, 0][w] += 1
                for k in language.SIZES:
                    padded = f" {w} "
                    for j in range(len(padded) - k + 1):
                        counts[lang, k][padded[j:j + k]] += 1
    languages = sorted(n_rows, key=lambda x: (-n_rows[x], x))
    logs = {key: {x: math.log10(c / sum(found.values())) for x, c in found.items()} for key, found in counts.items()}
    lack = min(v for x in logs.values() for v in x.values()) - 1

    def values(size, item):
        got = [logs.get((x, size), {}).get(item) for x in languages]
        return None if all(v is None for v in got) else [lack if v is None else v for v in got]

    def word_values(w):
        if len(w) <= language.LONGEST and (v := values(0, w)):
            return v
        for k in language.SIZES:
            padded = f" {w} "
            found = [v for j in range(len(padded) - k + 1) if (v := values(k, padded[j:j + k]))]
            if found:
                return [sum(c) / len(found) for c in zip(*found)]
    out = []
    for i, text, _ in rows:
        found = Counter(w for part in language.words(text or "") for w in part)
        if not found:
            out.append((i, "und", 0.0))
            continue
        got = [(v, n) for w, n in found.items() if (v := word_values(w))]
        n = sum(n for _, n in got)
        mean = [sum(v[k] * n for v, n in got) / n if n else 0.0 for k in range(len(languages))]
        best = max(range(len(languages)), key=lambda k: (round(mean[k], 6), -k))
        out.append((i, languages[best], 1 / sum(10 ** (m - mean[best]) for m in mean)))
    return out


def test_equals_plain_version(spark):
    rows = documents()
    df = spark.createDataFrame([(*r, "old") for r in rows], "doc_id long, text string, lang string, score string")
    got = language.identify(df.repartition(5)).collect()
    key = lambda r: (r[0] is None, r[0] or 0)
    got = sorted(((r.doc_id, r.lang_pred, r.score, r.held_out) for r in got), key=key)
    want = sorted(plain_version(rows), key=key)
    assert [g[:2] for g in got] == [w[:2] for w in want]
    assert [g[2] for g in got] == pytest.approx([w[2] for w in want], abs=1e-4)
    assert all(g[3] == (zlib.crc32(("" if g[0] is None else str(g[0])).encode()) % 4 == 2) for g in got)


def test_held_out_accuracy_and_what_predictions_use(spark):
    rows = documents()
    out = {r.doc_id: r for r in language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    right = [out[i].lang_pred == lang for i, t, lang in rows if lang and i is not None and i < 1200 and out[i].held_out]
    assert len(right) > 200 and sum(right) / len(right) > 0.95
    # the label of a held-out row has no part in anything
    other = [(i, t, "xx" if i is not None and out[i].held_out else lang) for i, t, lang in rows]
    again = {r.doc_id: r for r in language.identify(spark.createDataFrame(other, "doc_id long, text string, lang string")).collect()}
    assert all(again[i].lang_pred == out[i].lang_pred for i in out)


def test_nothing_to_learn_from(spark):
    df = spark.createDataFrame([(1, "a text", None), (2, None, None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify(df).collect()] == [("und", 0.0)] * 2
    assert language.identify(df.limit(0)).collect() == []


def test_fit_is_bounded(spark, monkeypatch):
    rows = documents()
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    small = language.fit(df, sample_bytes=2_000)
    assert sorted(small.languages) == sorted(WORDS)
    monkeypatch.setattr(language, "MOST_CELLS", 160)
    tiny = language.fit(df)
    assert len(tiny.rows[0]) <= 4 * 10 and all(len(tiny.rows[k]) <= 4 * 3 for k in language.SIZES)


def test_pieces_end_between_words(monkeypatch):
    monkeypatch.setattr(language, "PIECE", 10)
    text = "été straße १२३ हिन्दी भाषा the end of it"
    assert [w for part in language.words(text) for w in part] == ["été", "straße", "हिन्दी", "भाषा", "the", "end", "of", "it"]
    assert [w for part in language.words("a" * 25) for w in part] == ["a" * 10, "a" * 10, "a" * 5]
