import math
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import contexts, lm


def brute(rows):
    """The contract's counts and base score, text by text."""
    def tokens(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        out, word = [], ""
        for c in low:
            if c in " \t\n\x0b\x0c\r":
                out += [word] if word else []
                word = ""
            else:
                word += c
        return out + ([word] if word else []) + [None]

    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    seen = Counter(t for i, text in rows if not held(i) for t in tokens(text))
    n, v = sum(seen.values()), len(seen)
    return [(i, held(i), len(t := tokens(text)), sum(seen[x] > 0 for x in t), n,
             sum(math.log10((seen[x] + 0.1) / (n + 0.1 * (v + 1))) for x in t)) for i, text in rows]


def same(got, want):
    def key(r):
        return (r[0] is None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9, atol=1e-9)


def made(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, h string")


def test_counts_and_base_score(spark):
    rng = random.Random(1)
    vocab = ["The", "the", "ÉTÉ", "été", "a\x85b", "x y", "word%", "longer-word", "9"]
    rows = [(i, rng.choice([" ", "\n", "\x0b "]).join(rng.choice(vocab) for _ in range(rng.randrange(30)))) for i in range(300)]
    rows += [(400, None), (401, ""), (402, " \n "), (None, "no id here"), (7, rows[7][1]), (500, "tail " * 50_000)]
    got = lm.score_documents(made(spark, [(*r, "x") for r in rows])).collect()
    same([tuple(r) for r in got], brute(rows))
    by_text = {}
    for r in got:
        assert r.score < 0 and math.isfinite(r.score) and r.bits_per_byte > 0
        by_text.setdefault(r.doc_id, []).append(r.score)
    assert len(by_text[7]) == 2 and np.allclose(by_text[7], by_text[7][0], rtol=1e-12)
    assert np.allclose([by_text[400], by_text[401]], by_text[402], rtol=1e-12)


@pytest.mark.parametrize("limit", [0, 1])
def test_few_rows(spark, limit):
    rows = [(i, "some words", "x") for i in range(20) if zlib.crc32(str(i).encode()) % 10 == 0][:limit]
    got = lm.score_documents(made(spark, rows)).collect()
    assert len(got) == limit and all(r.n_known == 0 and r.train_tokens == 0 and r.held_out and r.base_score == 0 for r in got)


def plain_scores(rows, symbols):
    """Scores with the weights that nothing was learned for, one token at a
    time: the tree of ``symbols``, all counts in dictionaries.  All words of
    the rows must be known."""
    def held(i):
        return zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
    texts = [(i, [*(text or "").lower().split(), ""]) for i, text in rows]
    counts = Counter(w for i, t in texts if not held(i) for w in t)
    n = sum(counts.values())
    h = dict(zip(counts, lm._hash([w.encode() for w in counts]).view(np.uint64)))
    symbol = {w: int(s) for w, s in zip(counts, symbols.of(np.array(list(h.values()), np.uint64)))}
    rare = sum(c for w, c in counts.items() if symbol[w] == 0)
    new = (sum(c == 1 for c in counts.values()) + 0.5) / (rare + 1)
    mass = {0: rare + 1} | {symbol[w]: c + 0.5 for w, c in counts.items() if symbol[w]}
    bits = {s: format(int(symbols.path[s]), "040b")[:int(symbols.depth[s])] for s in mass}
    tables = [Counter(), Counter(), Counter()]  # own masses, after one word, after two: (context, node) -> sum below it

    def contexts_of(t, k):
        return (), (t[k - 1] if k else None,), (t[k - 1] if k else None, t[k - 2] if k > 1 else None)
    for s, m in mass.items():
        for d in range(len(bits[s]) + 1):
            tables[0][(), bits[s][:d]] += m
    for i, t in texts:
        if not held(i):
            for k, w in enumerate(t):
                for table, c in list(zip(tables, contexts_of(t, k)))[1:]:
                    for d in range(len(bits[symbol[w]]) + 1):
                        table[c, bits[symbol[w]][:d]] += 1
    out = []
    for i, t in texts:
        total = 0.0
        for k, w in enumerate(t):
            code = bits[symbol[w]]
            for d in range(len(code)):
                def share(table, c, prior=None):
                    ones, all_ = table[c, code[:d] + "1"], table[c, code[:d]]
                    return ones / all_ if prior is None else (ones + prior) / (all_ + 1)
                c = contexts_of(t, k)
                own = share(tables[0], c[0])
                one = share(tables[1], c[1], own)
                two = share(tables[2], c[2], one)
                logit = sum(weight * math.log(p / (1 - p)) for weight, p in zip((0.1, 0.2, 0.7), (own, one, two)))
                p = 1 / (1 + math.exp(-max(-12, min(12, logit))))
                total += math.log10(p if code[d] == "1" else 1 - p)
            if symbol[w] == 0:
                total += math.log10(1 - new) + math.log10(counts[w] / rare)
        out.append((i, total))
    return out


def repetitive(n, seed=5):
    """Texts of phrases, whose words follow each other, every word known."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcde") for _ in range(rng.randrange(2, 6))) for _ in range(120)]
    phrases = [[rng.choice(words) for _ in range(5)] for _ in range(60)]
    rows = [(i, " ".join(w for _ in range(8) for w in rng.choice(phrases))) for i in range(n)]
    known = {w for i, t in rows if zlib.crc32(str(i).encode()) % 10 for w in t.split()}
    return [(i, " ".join(w for w in t.split() if w in known)) for i, t in rows]


@pytest.mark.parametrize("place_tokens", [1_000_000, 300])
def test_scores_equal_a_plain_version(spark, place_tokens):
    rows = [*repetitive(250), (900, None), (901, ""), (3, repetitive(250)[3][1])]
    held = {i for i, _ in rows if zlib.crc32(str(i).encode()) % 10 == 0}
    counts = Counter(w.encode() for i, t in rows if i not in held for w in [*(t or "").split(), ""])
    n = sum(counts.values())
    frequent = sorted((w for w in counts if counts[w] >= max(2, n >> 8) or not w), key=lambda w: (-counts[w], w))
    assert 20 < len(frequent) < len(counts)
    symbols = contexts.Symbols(lm._hash(frequent).view(np.uint64), np.array([counts[w] for w in frequent]), n)
    got = sorted((r.doc_id, r.score) for r in lm.score_documents(
        made(spark, [(*r, "x") for r in rows]), share_bits=8, place_tokens=place_tokens, learn_entries=0).collect())
    if place_tokens > 1000:
        want = sorted(plain_scores(rows, symbols))
        assert [g[0] for g in got] == [w[0] for w in want]
        assert np.allclose([g[1] for g in got], [w[1] for w in want], rtol=1e-9)
    else:  # contexts of frequent words are dealt to many places: other counts, all texts scored
        assert len(got) == len(rows) and all(math.isfinite(s) and s < 0 for _, s in got)


def test_order_of_words_counts(spark):
    rows = repetitive(400)
    rng = random.Random(1)
    shuffled = {}
    for i, t in rows[:60]:
        own = t.split()
        rng.shuffle(own)
        shuffled[10 * i + 10_000_000] = (i, " ".join(own))
    # the shuffled texts are held out
    moved = {}
    for k, (i, t) in shuffled.items():
        k = next(x for x in range(k * 100, k * 100 + 100) if zlib.crc32(str(x).encode()) % 10 == 0)
        moved[k] = (i, t)
    fresh = [(next(x for x in range(10**12 + 1000 * i, 10**12 + 1000 * i + 100) if zlib.crc32(str(x).encode()) % 10 == 0), t) for i, t in rows[:60]]
    got = {r.doc_id: r for r in lm.score_documents(made(spark, [(*r, "x") for r in [*rows, *((k, t) for k, (_, t) in moved.items()), *fresh]])).collect()}
    straight = {i: got[k].score for (i, _), (k, _) in zip(rows[:60], fresh)}
    assert sum(got[k].score < straight[i] for k, (i, _) in moved.items()) >= 58
    # words that follow each other cost far less than their shares
    assert all(got[k].score > 0.7 * got[k].base_score for k, _ in fresh)


def test_tree_and_packing():
    rng = np.random.default_rng(2)
    counts = np.sort(rng.zipf(1.3, 3000).clip(max=10**6))[::-1]
    hashes = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    s = contexts.Symbols(hashes, counts, int(counts.sum()) + 500)
    assert (s.of(hashes) == np.arange(1, 3001)).all() and s.of(np.array([5], np.uint64)).tolist() == [contexts.OTHER]
    assert math.isclose((0.5 ** s.depth.astype(float)).sum(), 1) and (np.diff(s.path.astype(np.int64)) > 0).all()
    spent = (s.mass * s.depth).sum() / s.mass.sum()
    entropy = -(s.mass / s.mass.sum() * np.log2(s.mass / s.mass.sum())).sum()
    assert entropy <= spent < entropy + 1
    key, doc = rng.integers(0, 1 << 62, 500).astype(np.uint64)[rng.integers(0, 500, 4000)], rng.integers(0, 40, 4000)
    held = rng.random(40) < 0.3
    n, keys, times, docs, out = contexts.unpack(contexts.pack(key, doc, held))
    assert n == 40 and (out == held).all() and (keys == np.unique(key)).all()
    assert sorted(zip(np.repeat(keys, times).tolist(), docs.tolist())) == sorted(zip(key.tolist(), doc.tolist()))


def test_weights_learned_in_a_place_help():
    """Bits that the counts after the word before tell, told by noisy ones after two words."""
    rng = np.random.default_rng(3)
    symbols = contexts.Symbols(np.arange(1, 65, dtype=np.uint64), np.full(64, 100), 6500)
    one = rng.integers(0, 40, 60_000)
    word = np.where(rng.random(60_000) < 0.8, one % 64 + 1, rng.integers(1, 65, 60_000))
    key = (one.astype(np.uint64) << np.uint64(36)) | (rng.integers(0, 1 << 17, 60_000).astype(np.uint64) << np.uint64(19)) | word.astype(np.uint64)
    key, n = np.unique(key, return_counts=True)
    seen = rng.random(len(key)) < 0.8
    learned, fresh = contexts.Mixer(), contexts.Mixer()
    learned.learn(symbols, key[seen], n[seen].astype(float))
    counts = np.where(seen, n, 0).astype(float)
    a, b = learned.score(symbols, key, counts)[~seen].mean(), fresh.score(symbols, key, counts)[~seen].mean()
    assert a > b + 0.005


def test_weights_learn_from_every_entry_of_a_place():
    rng = np.random.default_rng(4)
    symbols = contexts.Symbols(np.arange(1, 65, dtype=np.uint64), np.full(64, 100), 6500)
    key, n = np.unique((rng.integers(0, 1 << 27, 150_000).astype(np.uint64) << np.uint64(36)) | rng.integers(1, 65, 150_000).astype(np.uint64),
                       return_counts=True)
    n[::7] = 0  # held out
    mixer = contexts.Mixer()
    both = mixer.learn_and_score(symbols, key, n.astype(float))
    depth = symbols.depth[(key & np.uint64((1 << contexts.SYM_BITS) - 1)).astype(np.int64)]
    assert mixer.refined.sum() == (n * depth).sum()
    assert (both < 0).all() and both[n == 0].mean() > 2 * math.log10(1 / 64)


def plain_learned_scores(symbols, key, n):
    """What a place learns and scores, one entry at a time."""
    bits = [format(int(p), "040b")[:int(d)] for p, d in zip(symbols.path, symbols.depth)]
    rows = [(int(k) >> 36, int(k) >> 19, int(k) & (1 << 19) - 1, float(c)) for k, c in zip(key, n)]
    tables = Counter()
    for one, two, s, c in rows:
        for d in range(len(bits[s]) + 1):
            tables[1, one, bits[s][:d]] += c
            tables[2, two, bits[s][:d]] += c
    weights = {}
    seen_grad, refined, out = {}, Counter(), np.zeros(len(rows))

    def predicted(d, one, two, s, without):
        code, bit = bits[s], bits[s][d] == "1"
        p, x, met = symbols.own(d)[s], [], []
        x.append(math.log(p / (1 - p)))
        for kind, c in ((1, one), (2, two)):
            n0, n1 = [max(tables[kind, c, code[:d] + side] - (without and side == code[d]), 0) for side in "01"]
            p = (n1 + p) / (n0 + n1 + 1)
            x.append(math.log(p / (1 - p)))
            met.append(min(int(math.log2(n0 + n1 + 1)), 7))
        gate = min(d, 15), *met
        x.append(0.3)
        logit = max(-12, min(12, sum(a * b for a, b in zip(x, weights.get(gate, [0.1, 0.2, 0.7, 0.0])))))
        return bit, x, gate, 1 / (1 + math.exp(-logit)), (d, round((max(-10, min(10, logit)) + 10) * 1.6))
    for d in range(max(map(len, bits))):
        on = [i for i, r in enumerate(rows) if len(bits[r[2]]) > d]
        for block in np.array_split([i for i in on if rows[i][3]], contexts.BLOCKS):
            grad, total = {}, Counter()
            for i in block:
                *entry, w = rows[i]
                bit, x, gate, p, cell = predicted(d, *entry, True)
                grad[gate] = grad.get(gate, 0) + (bit - p) * w * np.array(x)
                total[gate] += w
                refined[cell, bit] += w
            for gate, g in grad.items():
                g = g / total[gate]
                seen_grad[gate] = seen_grad.get(gate, np.full(4, 1e-2)) + g ** 2
                weights[gate] = weights.get(gate, np.array([0.1, 0.2, 0.7, 0.0])) + contexts.RATE * g / np.sqrt(seen_grad[gate])
        for i in on:
            bit, _, _, p, cell = predicted(d, *rows[i][:3], False)
            n0, n1 = refined[cell, False], refined[cell, True]
            p = (p + (n1 + 20 * p) / (n0 + n1 + 20)) / 2
            out[i] += math.log10(p if bit else 1 - p)
    return out


def some_entries(contexts_, of_each, seed=6):
    rng = np.random.default_rng(seed)
    symbols = contexts.Symbols(np.arange(1, 65, dtype=np.uint64), rng.integers(1, 300, 64), 20_000)
    one = rng.integers(0, contexts_, contexts_ * of_each).astype(np.uint64)
    key, n = np.unique(one << np.uint64(36) | rng.integers(0, 3, len(one)).astype(np.uint64) << np.uint64(19)
                       | np.minimum(rng.zipf(1.4, len(one)), 64).astype(np.uint64), return_counts=True)
    n[rng.random(len(n)) < 0.2] = 0  # held out
    return symbols, key, n.astype(float)


def test_learned_scores_equal_a_plain_version():
    symbols, key, n = some_entries(12, 60)
    assert np.allclose(contexts.Mixer().learn_and_score(symbols, key, n), plain_learned_scores(symbols, key, n), rtol=1e-9)


def test_entries_with_the_same_beginning_are_worked_out_once(monkeypatch):
    symbols, key, n = some_entries(300, 600)
    sym, done = (key & np.uint64((1 << 19) - 1)).astype(np.int64), []
    runs = sum(len({(c, p >> (contexts.DEEP - 1 - d)) for c, p, deep in zip((key >> np.uint64(19)).tolist(), symbols.path[sym].tolist(), symbols.depth[sym]) if deep > d})
               for d in range(contexts.DEEP))

    class Spy:
        def __getattr__(self, name):
            return getattr(np, name)

        def exp(self, x):
            done.append(len(x))
            return np.exp(x)
    monkeypatch.setattr(contexts, "np", Spy())
    contexts.Mixer().learn_and_score(symbols, key, n)
    # learned from and scored; a run may lie in two of the blocks of a depth
    assert runs < 0.7 * symbols.depth[sym].sum() and sum(done) <= 2 * runs + contexts.BLOCKS * contexts.DEEP


def test_words_of_odd_texts(monkeypatch):
    texts = [b"", b"  ", b" a  b\x1c\x1dc\x85 \xff\xfeQ\x0bz\x0cY\r\n", "ÉTÉ \xa0x\u2028Y\x00 \U0001f600A".encode(), b"x" * 300, b"End"] * 3
    want = [t.lower().split() for t in texts]
    for kind in (pa.binary(), pa.large_binary()):
        for lo in (0, 2):  # a slice, too
            got, sizes = lm.words(pa.array(texts, kind)[lo:])
            assert got.to_pylist() == [w for t in want[lo:] for w in t] and sizes.tolist() == [len(t) for t in want[lo:]]
    monkeypatch.setattr(lm, "PIECE_BYTES", 50)
    batch = pa.RecordBatch.from_arrays([pa.array([i % 4 == 3 for i in range(len(texts))]), pa.array(texts, pa.binary())], names=["held_out", "text"])
    counts = Counter(w for i, t in enumerate(want) if i % 4 != 3 for w in [*t, b""])
    for most in (3, 1000):
        monkeypatch.setattr(lm, "HELD_WORDS", most)
        got = Counter()
        for out in lm._count_words([batch, batch.slice(0, 0)]):
            for w, k in zip(out.column("token").to_pylist(), out.column("n").to_pylist()):
                got[w] += k
        assert dict(got) == {w: counts[w] for t in [*want, [b""]] for w in t}


def test_spelling_learns_from_every_known_word(spark, monkeypatch):
    monkeypatch.setattr(lm, "LEARN_WORDS", 50, raising=False)
    words = [(f"w{i * 7919}".encode(), i % 3) for i in range(400)]
    _, learned = lm.learn(spark.createDataFrame(words, "token binary, n long"), len(words))
    assert learned.value[1].sum() == 8 * sum(n * (len(w) + 1) for w, n in words)


def test_probabilities_of_all_bytes_sum_to_one():
    tokens = [b"the", b"then", b"them", b"", b"other"]
    tables = lm.empty_tables()
    lm.count_into(tables, tokens, np.array([50, 9, 8, 20, 4]))
    mixer = lm.Mixer(tables)
    mixer.learn(tokens, np.array([50, 9, 8, 20, 4]))
    # all bytes after "the": the space, which ends it, or one more byte
    total = 0.0
    for byte in range(256):
        bits = lm.Bits([b"the" + bytes([byte])]) if byte != 32 else lm.Bits([b"the"])
        p = 1.0
        for b in range(8):
            node, bit = bits.plane(b)
            inputs = [lm._logit(*mixer.tables[k][bits.slots(k, node, mixer.tables[k])].T) for k in range(lm.ORDERS)]
            trust = [lm._trust(mixer.tables[k][bits.slots(k, node, mixer.tables[k])].sum(axis=1), k) for k in range(lm.ORDERS - 2, lm.ORDERS)]
            at = bits.of[3]
            q = mixer._mix(bits, node, b, inputs, trust)[1][at]
            p *= q if bit[at] else 1 - q
        total += p
    assert math.isclose(total, 1, rel_tol=1e-6)


def test_held_out_words_cost_fewer_bits_with_learning():
    rng = random.Random(8)
    parts = ["tion", "ing", "the", "re", "ed", "an", "or", "st", "ly"]

    def new(k):
        return list({"".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))).encode() for _ in range(k)})
    learned, fresh = new(3000), [w for w in new(1500)]
    fresh = [w for w in fresh if w not in set(learned)]
    counts = np.array([rng.randrange(1, 5) for _ in learned])
    tables = lm.empty_tables()
    lm.count_into(tables, learned, counts)
    mixer = lm.Mixer(tables)
    for lo in range(0, len(learned), 256):
        mixer.learn(learned[lo:lo + 256], counts[lo:lo + 256])
    def bits_per_byte(m):
        return -m.score(fresh).sum() * math.log2(10) / sum(len(w) + 1 for w in fresh)
    longest_alone = lm.Mixer(tables, np.eye(1, lm.ORDERS + 1, lm.ORDERS - 1).repeat(lm.GATES, 0))
    assert bits_per_byte(mixer) < 1.5 < bits_per_byte(longest_alone)


def test_query(spark):
    from tessera.llm.common import table
    from tessera.llm.queries import QUERIES
    d = "/root/testdata/sf0.01"
    got = QUERIES["op9_context_mixing"](spark, d).collect()
    same([tuple(r) for r in got], brute([(r.doc_id, r.text) for r in table(spark, d, "documents").collect()]))
    # a proper model of the bytes does better on held-out texts than the word counts, which have one type for all new words
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)
