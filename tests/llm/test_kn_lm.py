import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm_rules import spaced
from rawfold.llm.common import crc_mod, crc_mod_col
from rawfold.llm.kn_lm import build, score


class Brute:
    """Interpolated modified Kneser-Ney from dictionaries."""

    def __init__(self, texts, order):
        self.order, self.counts = order, [Counter() for _ in range(order + 1)]
        for t in texts:
            w = ["<s>"] * (order - 1) + spaced(t) + ["</s>"]
            for k in range(1, order + 1):
                for i in range(order - 1, len(w)):
                    self.counts[k][tuple(w[i - k + 1:i + 1])] += 1
        self.v, self.n = len(self.counts[1]), sum(self.counts[1].values())
        self.adj = list(self.counts)
        for k in range(order - 1, 0, -1):
            c = Counter()
            for g in self.counts[k + 1]:
                c[g[1:]] += 1
            self.adj[k] = c
        self.d, self.ctx = {}, {}
        for k in range(1, order + 1):
            n = [0] + [sum(v == i for v in self.adj[k].values()) for i in (1, 2, 3, 4)]
            y = n[1] / (n[1] + 2 * n[2]) if n[1] else 0
            d = [0, 1 - 2 * y * n[2] / n[1] if n[1] else 0, 2 - 3 * y * n[3] / n[2] if n[2] else 0, 3 - 4 * y * n[4] / n[3] if n[3] else 0]
            d = [min(max(x, 0), i) for i, x in enumerate(d)]
            if not n[2]:
                d[2] = d[1]
            if not n[3]:
                d[3] = d[2]
            self.d[k] = d
            c = defaultdict(lambda: [0, 0.0])
            for g, v in self.adj[k].items():
                c[g[:-1]][0] += v
                c[g[:-1]][1] += d[min(v, 3)]
            self.ctx[k] = c

    def p(self, gram):
        k = len(gram)
        if k == 0:
            return 1 / (self.v + 1)
        low = self.p(gram[1:])
        if gram[:-1] not in self.ctx[k]:
            return low
        total, weight = self.ctx[k][gram[:-1]]
        v = self.adj[k][gram]
        return max(v - self.d[k][min(v, 3)], 0) / total + weight / total * low

    def text(self, t):
        w = ["<s>"] * (self.order - 1) + spaced(t) + ["</s>"]
        own = range(self.order - 1, len(w))
        c = [self.counts[1][(w[i],)] for i in own]
        base = sum(math.log10((x + 0.5) / (self.n + 0.5 * (self.v + 1))) for x in c)
        return len(c), sum(x > 0 for x in c), base, sum(math.log10(self.p(tuple(w[i - self.order + 1:i + 1]))) for i in own)


@pytest.fixture(scope="module")
def rows(words):
    return ([(i, " ".join(words(n, i % 37).split()[:n])) for i, n in enumerate([1, 3, 9, 40, 150] * 24)]
            + [(500, None), (501, ""), (502, "UNSEEN words Only"), (503, words(30, 1)), (503, words(30, 1)), (None, words(5, 2)), (504, "a " * 20_000)])


@pytest.mark.parametrize("order,shard_bytes", [(2, 1 << 20), (2, 3000), (3, 4000), (4, 9000)])
def test_equals_brute_force(make_docs, rows, order, shard_bytes):
    held = crc_mod_col("doc_id", 5) == 1
    d = make_docs(rows).selectExpr("*", "1 as row", "2 as shard", "3 as score", "4 as n_tokens")
    store = build(d, ~held, order=order, shard_bytes=shard_bytes)
    want = Brute([t for i, t in rows if crc_mod(i, 5) != 1], order)
    assert store.orders[1].total == want.n and store.orders[1].size == want.v
    got = sorted(score(d, store).collect(), key=lambda r: (str(r["doc_id"]), r["score"]))
    for r, (_, t) in zip(got, sorted(rows, key=lambda r: (str(r[0]), want.text(r[1])[3]))):
        n, known, base, own = want.text(t)
        assert (r["n_tokens"], r["n_known"]) == (n, known)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] == pytest.approx(own, rel=1e-5)
        assert r["perplexity"] == pytest.approx(10 ** (-own / n), rel=1e-4)


def test_probabilities_of_all_words_sum_to_one(make_docs, rows):
    import numpy as np

    from rawfold.llm.common import WordHashes
    from rawfold.llm.kn_lm import score_texts
    store = build(make_docs(rows), F.lit(True), order=2)
    vocab = {w for _, t in rows for w in spaced(t)}
    context = spaced(rows[4][1])[0]
    h = WordHashes()
    first = score_texts(store, [context], h)[3][0] - 0  # context and end
    pairs = score_texts(store, [f"{context} {w}" for w in sorted(vocab)] + [f"{context} never-seen-word"], h)[3]
    end = score_texts(store, [w for w in sorted(vocab)] + ["never-seen-word"], h)[3]
    begin = score_texts(store, sorted(vocab) + ["never-seen-word"], h)
    assert len(pairs) == len(end) == len(begin[0])
    brute = Brute([t for _, t in rows], 2)
    mass = sum(brute.p((context, w)) for w in vocab) + brute.p((context, "</s>")) + brute.p((context, "never-seen-word"))
    assert mass == pytest.approx(1, abs=1e-9) and np.isfinite(first)


def test_beats_the_base_on_held_out_text(make_docs, words):
    chain = [(i, " ".join(f"{a}-x {a}-y" for a in words(60, i).split())) for i in range(150)]
    held = crc_mod_col("doc_id", 5) == 1
    d = make_docs(chain)
    out = score(d, build(d, ~held)).filter(held).agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > 0.7 * out[1]


def test_nothing_to_learn_from_and_empty_table(make_docs):
    d = make_docs([(1, "a b"), (2, None)])
    for r in score(d, build(d, F.lit(False))).collect():
        assert r["n_known"] == 0 and r["score"] == 0 and r["base_score"] == 0
    e = make_docs([])
    assert score(e, build(e, F.lit(True))).count() == 0
    with pytest.raises(ValueError):
        build(d, F.lit(True), order=1)
    with pytest.raises(ValueError):
        build(d, F.lit(True), path="s3://bucket/x")


def test_counts_and_sums_beyond_32_bits_are_exact(tmp_path):
    import numpy as np

    from rawfold.llm.common import WordHashes
    from rawfold.llm.kn_lm import _END, Order, Store, _context_sums, _emit, _sum_equal, _write_counts, pack, score_texts, unpack
    keys, wide = np.array([3, 9], np.uint64), np.array([[5, 2**33 + 1], [2**40, 7]], np.uint64)
    for values in (wide, wide % 1000):
        p = pack(keys, values)
        k, v = unpack(p["n"], p["item"], p["keys"], p["vals"], 2)
        assert (k == keys).all() and (v == values).all()

    # a word of 5e9 tokens: its count, its context's sum and its score
    h = WordHashes()
    tokens = sorted((h[b"a"], h[_END]))
    counts = {h[b"a"]: 5_000_000_000, h[_END]: 10}
    store = Store(str(tmp_path), {1: Order((2,), (0, 0, 0, 0), 5_000_000_010), 2: Order((2,))}, 2)
    np.array(tokens, np.uint64).tofile(tmp_path / "o1-00000.keys")
    _write_counts(f"{tmp_path}/o1-00000.counts", np.array([counts[t] for t in tokens], np.uint64))
    a = tokens.index(h[b"a"])
    grams = np.array(sorted(a * 3 + i for i in (0, 1)), np.uint64)
    grams.tofile(tmp_path / "o2-00000.keys")
    _write_counts(f"{tmp_path}/o2-00000.counts", np.array([3_000_000_000, 3_000_000_000], np.uint64))
    assert store.find(1, np.array(tokens, np.uint64))[1].tolist() == [counts[t] for t in tokens]
    assert store.find(2, grams)[1].tolist() == [3_000_000_000] * 2
    ids, sums = _sum_equal(*_context_sums(2)(store, 0))
    batch, = _emit(ids.astype(np.uint64), sums, np.zeros(1, np.int64))
    r = batch.to_pylist()[0]
    assert unpack(r["n"], r["item"], r["keys"], r["vals"], 4)[1].tolist() == [[6_000_000_000, 0, 0, 2]]
    one = Store(str(tmp_path), {0: Order((2,)), 1: store.orders[1]}, 1)
    base = score_texts(one, ["a"], h)[2][0]
    assert base == pytest.approx(sum(math.log10((c + 0.5) / (5_000_000_010 + 1.5)) for c in counts.values()), rel=1e-12)
