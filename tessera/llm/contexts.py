"""Words in their context: bit predictors hashed on the preceding words.

The frequent words, and one sign for all others, are the leaves of a binary
tree that is cut where both sides have nearly the same mass, so a word is
about as many bits as its information.  Three predictors give every bit a
probability: the words' own counts, the counts after the preceding word, and
those after the two preceding words.  Their logits are mixed by weights that
a gate picks (the bit's depth and how often either context was met); the
weights are learned online, and an adaptive map refines the result.

Occurrences are dealt by a hash of the preceding word; one that is very
frequent has a part of its contexts, told apart by the words before it, in
each of several places.  A place holds all counts of its contexts, so tables
grow with the corpus and are never in one task.
"""
from __future__ import annotations

import struct

import numpy as np

#: a word is frequent from this share of the learning words on (2^-18), so there are 2^18 at most
SHARE_BITS = 18
#: occurrences that a place is to hold, and online steps in which its weights learn a depth
PLACE_TOKENS, BLOCKS, RATE = 1_000_000, 16, 0.02
#: occurrences or runs that are worked on together, few enough for a processor's cache
AT_ONCE = 1 << 15
OTHER = 0
DEEP, GATES, STEPS, REACH = 40, 16 * 8 * 8, 33, 10.0
SYM_BITS, TWO_BITS, ONE_BITS = 19, 17, 28
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _mix(h: np.ndarray, k: int) -> np.ndarray:
    h = (h + np.uint64(k)) * _A
    h = (h ^ (h >> np.uint64(29))) * _B
    return h ^ (h >> np.uint64(32))


class Symbols:
    """The frequent words by hash, and the tree over them and OTHER."""

    def __init__(self, hashes: np.ndarray, counts: np.ndarray, n: int):
        order = np.argsort(-counts, kind="stable")
        self.counts = counts[order].astype(np.float64)
        by_hash = np.argsort(hashes[order])
        self.hashes, self.symbol = hashes[order][by_hash], by_hash + 1
        #: mass of OTHER, then of the words, none of them 0
        self.mass = np.concatenate([[max(n - self.counts.sum(), 0) + 1], self.counts + 0.5])
        self.path, self.depth = self._tree()
        self._p = {}

    def _tree(self):
        total = np.concatenate([[0.0], np.cumsum(self.mass)])
        path, depth = np.zeros(len(self.mass), np.uint64), np.zeros(len(self.mass), np.int64)
        open_ = [(0, len(self.mass), 0, 0)]
        while open_:
            lo, hi, bits, d = open_.pop()
            if hi - lo == 1:
                path[lo], depth[lo] = bits << (DEEP - d), d
                continue
            half = (total[lo] + total[hi]) / 2
            at = min(max(int(np.searchsorted(total, half)), lo + 1), hi - 1)
            if at - 1 > lo and half - total[at - 1] < total[at] - half:
                at -= 1
            if d >= DEEP - 22:  # never reached with masses of their own; keeps paths within DEEP bits
                at = (lo + hi) // 2
            open_ += [(lo, at, 2 * bits, d + 1), (at, hi, 2 * bits + 1, d + 1)]
        return path, depth

    def of(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words by hash, OTHER for those that are not frequent."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.symbol[at], OTHER)

    def own(self, d: int) -> np.ndarray:
        """Probability of a 1 at depth ``d`` by the symbols' own masses."""
        if d not in self._p:
            node = self.path >> np.uint64(DEEP - d)
            new = np.concatenate([[True], node[1:] != node[:-1]])
            starts, g = np.flatnonzero(new), np.cumsum(new) - 1
            bit = (self.path >> np.uint64(DEEP - 1 - d) & np.uint64(1)).astype(np.float64)
            self._p[d] = (np.add.reduceat(self.mass * bit, starts) / np.add.reduceat(self.mass, starts))[g]
        return self._p[d]


# ------------------------------------------------- chunks of texts to places

def place_and_key(one: np.ndarray, two: np.ndarray, three: np.ndarray, symbol: np.ndarray, cuts: np.ndarray, places: int):
    """Place of each occurrence and its packed (context, word): ``one``,
    ``two``, ``three`` are the hashes of the words before it, nearest first,
    ``cuts`` the number of places that the contexts of ``one`` are dealt to."""
    bucket, on = np.zeros(len(one), np.uint64), np.flatnonzero(cuts > 1)
    few = np.minimum(cuts[on], 64).astype(np.uint64)
    many = (-(-cuts[on] // 64)).astype(np.uint64)
    bucket[on] = _mix(two[on], 1) % few + np.uint64(64) * (_mix(three[on], 2) % many)
    context = _mix(one ^ _mix(bucket, 3), 4)
    place = (context >> np.uint64(36)) % np.uint64(places)
    key = ((context & np.uint64((1 << ONE_BITS) - 1)) << np.uint64(SYM_BITS + TWO_BITS)
           | (_mix(two, 5) & np.uint64((1 << TWO_BITS) - 1)) << np.uint64(SYM_BITS) | symbol.astype(np.uint64))
    return place.astype(np.int64), key


def pack(key: np.ndarray, doc: np.ndarray, held: np.ndarray) -> bytes:
    """Entries of a chunk for one place: distinct keys in order, as the bytes
    of their differences plane by plane (mostly zeros, which compress), how
    often each occurs, the documents of the occurrences, and which of the
    chunk's documents are held out."""
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
    kept = key[starts]
    steps = np.diff(kept, prepend=np.uint64(0))
    counts = np.diff(np.append(starts, len(key))).astype(np.uint32)
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    thin = np.ascontiguousarray(counts.view(np.uint8).reshape(-1, 4).T)
    return (struct.pack("<qqq", len(held), len(kept), len(key)) + planes.tobytes() + thin.tobytes()
            + doc.astype(np.uint16).tobytes() + np.packbits(held).tobytes())


def unpack(body):
    docs, k, m = struct.unpack_from("<qqq", body)
    planes = np.frombuffer(body, np.uint8, 8 * k, 24).reshape(8, k)
    key = np.cumsum(np.ascontiguousarray(planes.T).view(np.uint64).ravel(), dtype=np.uint64)
    thin = np.frombuffer(body, np.uint8, 4 * k, 24 + 8 * k).reshape(4, k)
    counts = np.ascontiguousarray(thin.T).view(np.uint32).ravel()
    doc = np.frombuffer(body, np.uint16, m, 24 + 12 * k)
    held = np.unpackbits(np.frombuffer(body, np.uint8, -1, 24 + 12 * k + 2 * m), count=docs).astype(bool)
    return docs, key, counts, doc, held


# ------------------------------------------------------- the model of a place

class Runs:
    """Entries in the order of their contexts and words.  As symbols are in the
    order of their paths, those of a context that begin with the same bits lie
    together: what depends on no more than these is worked out once a run."""

    def __init__(self, symbols: Symbols, group: np.ndarray, sym: np.ndarray, n: np.ndarray):
        path = symbols.path[sym]
        #: bits that an entry has in common with the one before, -1 in another context
        self.common = np.full(len(sym), -1, np.int8)
        self.common[1:] = np.where(group[1:] == group[:-1], DEEP - np.frexp((path[1:] ^ path[:-1]).astype(np.float64))[1], -1)
        self.depth = symbols.depth[sym].astype(np.int8)
        self.before = np.concatenate([[0.0], np.cumsum(n)])

    def at(self, d: int):
        """The runs with ``d`` + 1 bits in common: first entry, the entry behind
        the last, whether it is the second of its node, its count and that of
        the other bit."""
        starts = np.flatnonzero(self.common <= d)
        ends = np.append(starts[1:], len(self.common))
        live = self.depth[starts] > d
        starts, ends = starts[live], ends[live]
        second = self.common[starts] == d
        count = self.before[ends] - self.before[starts]
        other, k = np.zeros(len(starts)), np.flatnonzero(second)
        other[k], other[k - 1] = count[k - 1], count[k]
        return starts, ends, second, count, other


#: step of a gate, by how often a context was met
_MET = np.minimum(np.log2(np.arange(128) + 1), 7).astype(np.int64)


def _met(total: np.ndarray) -> np.ndarray:
    return _MET[np.minimum(total, 127).astype(np.int64)]


class Mixer:
    """Gated weights and the refinement of a place, learned from its entries.

    Probabilities are those of the bit that an entry has; ``sign`` turns their
    logits into those of a 1."""

    def __init__(self):
        self.weights = np.tile(np.array([0.1, 0.2, 0.7, 0.0]), (GATES, 1))
        self.seen = np.full(self.weights.shape, 1e-2)
        self.refined = np.zeros((DEEP * STEPS, 2))

    def learn(self, symbols: Symbols, key: np.ndarray, n: np.ndarray) -> None:
        """Learns from all entries (those with n > 0), depth by depth."""
        self._run(symbols, key, n, True, False)

    def learn_and_score(self, symbols: Symbols, key: np.ndarray, n: np.ndarray) -> np.ndarray:
        """``learn``, then ``score``, over the same counts."""
        return self._run(symbols, key, n, True, True)

    def score(self, symbols: Symbols, key: np.ndarray, n: np.ndarray) -> np.ndarray:
        """log10 of the probability of each entry's word in its context."""
        return self._run(symbols, key, n, False, True)

    def _run(self, symbols: Symbols, key: np.ndarray, n: np.ndarray, learn: bool, score: bool) -> np.ndarray:
        sym = (key & np.uint64((1 << SYM_BITS) - 1)).astype(np.int64)
        one = key >> np.uint64(SYM_BITS + TWO_BITS)
        single, of = np.unique(one << np.uint64(SYM_BITS) | sym.astype(np.uint64), return_inverse=True)
        s_sym = (single & np.uint64((1 << SYM_BITS) - 1)).astype(np.int64)
        after_one = Runs(symbols, single >> np.uint64(SYM_BITS), s_sym, np.bincount(of, n, len(single)))
        after_two = Runs(symbols, key >> np.uint64(SYM_BITS), sym, n)
        out = np.ones(len(key))  # at the first entry of a run the probability of its bits; 40 of 3e-6 or more
        for d in range(DEEP):
            starts, ends, second, count, other = after_two.at(d)
            if not len(starts):
                break
            s, _, _, s_count, s_other = after_one.at(d)
            run = np.zeros(len(single), np.int64)
            run[s] = 1
            run = (np.cumsum(run) - 1)[of[starts]]
            one_bit = symbols.path[s_sym[s]] >> np.uint64(DEEP - 1 - d) & np.uint64(1) == 1
            own = symbols.own(d)[s_sym[s]]
            sign, own = np.where(one_bit, 1.0, -1.0), np.where(one_bit, own, 1 - own)
            of_own = sign, sign * np.log(own / (1 - own))
            if learn:
                of_one = *of_own, *self._after_one(sign, own, np.maximum(s_count - 1, 0), s_other)
                seen = np.flatnonzero((after_two.depth > d) & (n > 0))
                firsts = [x[0] for x in np.array_split(seen, BLOCKS) if len(x)]
                for lo, hi in zip(firsts, [*firsts[1:], len(key)]):
                    i, j = np.searchsorted(starts, lo, "right") - 1, np.searchsorted(starts, hi)
                    weight = count[i:j].copy()  # a run may begin or end in another block
                    for k in {i, j - 1}:
                        weight[k - i] = after_two.before[min(ends[k], hi)] - after_two.before[max(starts[k], lo)]
                    self._learn(d, weight, *self._inputs(run[i:j], of_one, np.maximum(count[i:j] - 1, 0), other[i:j]))
            if score:
                of_one = *of_own, *self._after_one(sign, own, s_count, s_other)
                parent = starts.copy()
                parent[second] = starts[np.flatnonzero(second) - 1]
                so_far = out[parent]
                for lo in range(0, len(starts), AT_ONCE):
                    on = slice(lo, lo + AT_ONCE)
                    so_far[on] *= self._score(d, *self._inputs(run[on], of_one, count[on], other[on]))
                out[starts] = so_far
        return np.log10(out)

    @staticmethod
    def _after_one(sign, own, count, other):
        """Probability after the preceding word, its logit and its part of the gate."""
        total = count + other
        return (count + own) / (total + 1), sign * np.log((count + own) / (other + (1 - own))), 8 * _met(total)

    @staticmethod
    def _inputs(run, of_one, count, other):
        """Sign, logits of the predictors and the gate of a depth."""
        sign, own, p, one, gate = [x[run] for x in of_one]
        return sign, (own, one, sign * np.log((count + p) / (other + (1 - p)))), gate + _met(count + other)

    def _mix(self, d, x, gate):
        weights = np.ascontiguousarray(self.weights[min(d, 15) * 64:min(d, 15) * 64 + 64].T)
        logit = 0.3 * weights[3][gate]
        for w, v in zip(weights, x):
            logit += w[gate] * v
        np.clip(logit, -12, 12, out=logit)
        step = np.rint((np.clip(logit, -REACH, REACH) + REACH) * ((STEPS - 1) / (2 * REACH))).astype(np.int64)
        return 1 / (1 + np.exp(-logit)), step

    def _learn(self, d: int, weight, sign, x, gate) -> None:
        """One online step per block of a depth's entries; an entry weighs its count."""
        p, step = self._mix(d, x, gate)
        bit, on = sign > 0, slice(min(d, 15) * 64, min(d, 15) * 64 + 64)
        err, total = (bit - p) * weight, np.bincount(gate, weight, 64)
        grad = np.stack([*(np.bincount(gate, err * v, 64) for v in x), 0.3 * np.bincount(gate, err, 64)], 1) / np.maximum(total, 1e-9)[:, None]
        self.seen[on] += grad ** 2
        self.weights[on] += RATE * grad / np.sqrt(self.seen[on])
        self.refined[d * STEPS:(d + 1) * STEPS] += np.bincount(2 * step + bit, weight, 2 * STEPS).reshape(STEPS, 2)

    def _score(self, d: int, sign, x, gate) -> np.ndarray:
        p, step = self._mix(d, x, gate)
        n0, n1 = self.refined[d * STEPS:(d + 1) * STEPS].T
        # as far as the map has seen bits like these, towards what they were
        p = p * (0.5 + 10 / (n0 + n1 + 20))[step] + (0.5 * n1 / (n0 + n1 + 20))[step]
        return np.where(sign > 0, p, 1 - p)


def answer(symbols: Symbols, bodies: list, learn: bool = True) -> list[np.ndarray]:
    """For the packed entries of each chunk (all that there are of a place):
    the sums of the scores per document of the chunk.  The place's weights are
    learned from all its learning entries, or stay as they begin."""
    asked = [unpack(b) for b in bodies]
    key, of = np.unique(np.concatenate([a[1] for a in asked]), return_inverse=True)
    if not len(key):
        return [np.zeros(a[0]) for a in asked]
    own = []
    for _, k, counts, doc, held in asked:
        ends = np.cumsum(counts.astype(np.int64))
        seen = np.concatenate([[0], np.cumsum(~held[doc])])
        own.append(seen[ends] - seen[ends - counts])
    n = np.bincount(of, np.concatenate(own).astype(np.float64), len(key))
    score = (Mixer().learn_and_score if learn else Mixer().score)(symbols, key, n)
    out, at = [], 0
    for docs, k, counts, doc, _ in asked:
        own = score[of[at:at + len(k)]]
        at += len(k)
        out.append(np.bincount(doc, np.repeat(own, counts), docs))
    return out
