import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from rawfold.llm.common import crc_mod, crc_mod_col
from rawfold.llm.toxicity import _PIECE, Words, best_threshold, fit, pooled, score, train, word_rows

BAD = {"aa": ["vilo", "skum", "trek"], "bb": ["grßb", "dreck", "mis"]}
SYL = {"aa": ["ka", "lo", "mi", "tu", "re"], "bb": ["ßo", "ert", "sch", "ung", "öl"]}


def case(n=500, seed=0):
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        lang = r.choice(list(SYL))
        w = ["".join(r.choices(SYL[lang], k=r.randint(1, 4))) for _ in range(r.choice((3, 20, 150)))]
        toxic = int(r.random() < 0.25)
        if toxic:
            for _ in range(r.randint(1, 3)):
                w.insert(r.randrange(len(w)), r.choice(BAD[lang]))
        docs.append((i, " ".join(w), lang))
        labels.append((i, 1, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def data(spark):
    docs, labels = case()
    return docs, {i: y for i, _, y in labels}, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(make_docs, data):
    docs, truth, labels = data
    d = make_docs(docs)
    held = crc_mod_col("doc_id", 5) == 0
    out = score(d, fit(d, labels, ~held)).collect()
    own = [r for r in out if crc_mod(r["doc_id"], 5) == 0]
    pos, neg = ([r["score"] for r in own if truth[r["doc_id"]] == y] for y in (1, 0))
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    assert len(out) == len(docs) and auc > 0.97
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in own]) > 0.93
    assert all(r["predicted"] == int(r["score"] >= 0.5) and 0 <= r["score"] <= 1 for r in out)


def test_score_reads_the_text_alone(make_docs, data):
    docs, _, labels = data
    d = make_docs(docs)
    held = crc_mod_col("doc_id", 5) == 0
    m = fit(d, labels, ~held)
    other = d.withColumns({"lang": F.lit("zz"), "source": F.lit("q"), "doc_id": F.lit(1).cast("long")})
    assert sorted(r["score"] for r in score(d, m).collect()) == sorted(r["score"] for r in score(other, m).collect())
    # labels of held-out rows change nothing
    wrong = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert sorted(map(tuple, score(d, fit(d, wrong, ~held)).collect())) == sorted(map(tuple, score(d, m).collect()))


def test_nulls_empty_long_texts_and_missing_labels(spark, make_docs, data):
    docs, _, labels = data
    m = fit(make_docs(docs), labels, F.lit(True))
    odd = make_docs([(1, None), (2, ""), (3, "?!"), (4, "kalo " * 150_000 + "skum skum"), (None, "kalo")]).selectExpr(
        "*", "1 as row", "2 as score", "3 as predicted")
    got = {r["doc_id"]: r for r in score(odd, m).collect()}
    assert got[1]["score"] == got[2]["score"] == got[3]["score"] < 0.5 and len(got) == 5
    assert got[4]["score"] > 0.5 > got[None]["score"]
    assert score(make_docs([]), m).count() == 0
    none = spark.createDataFrame([(1, 1, None), (2, 1, 1)], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in score(odd, fit(make_docs(docs), none, F.lit(True))).collect()} == {0.0}


def test_pieces_of_long_texts_pool_to_the_same(data):
    from rawfold.llm import langid
    docs, truth, _ = data
    m = train([(t, truth[i]) for i, t, _ in docs[:200]], langid.train([(t, lang) for _, t, lang in docs[:50]]), {0: 1.0, 1: 1.0}, epochs=2)
    h = Words()
    words = [w.encode() for _, t, _ in docs for w in t.split()] * 5
    long = word_rows((words * (1 + 2 * _PIECE // len(words)))[:2 * _PIECE + 17], h, (len(m.emb) - 1) // 3)
    from rawfold.llm import toxicity
    whole, toxicity._PIECE = toxicity._PIECE, 10**9
    try:
        one = pooled([long, long[:5], long[:0]], m)
    finally:
        toxicity._PIECE = whole
    assert np.allclose(one, pooled([long, long[:5], long[:0]], m), atol=1e-5)


def test_threshold_is_the_least_weighted_error():
    z, y = np.array([0.0, 1, 2, 3]), np.array([0, 0, 1, 1])
    assert 1 < best_threshold(z, y, np.ones(4)) < 2
    assert best_threshold(z, 1 - y, np.array([9.0, 9, 1, 1])) < 0


def test_logits_equal_a_plain_forward_pass():
    from rawfold.llm import langid
    from rawfold.llm.common import alnum_words
    from rawfold.llm.toxicity import WIDTHS, logits
    docs, labels = case(120, 3)
    m = train([(d[1], y) for d, (_, _, y) in zip(docs, labels)], langid.train([]), {0: 1.0, 1: 1.0}, buckets=1 << 8, epochs=2, steps=40)
    hashes, per = Words(), len(m.bias) // len(WIDTHS)
    texts = [d[1] for d in docs[:25]] + ["", "one", "one two"]
    x = [word_rows(alnum_words(t), hashes, (len(m.emb) - 1) // 3) for t in texts]
    for rows, got in zip(x, logits(x, m)):
        vec = [m.emb[a].astype(float) + m.emb[b] + m.emb[c] for a, b, c in rows]
        z = m.out_bias
        at = 0
        for i, width in enumerate(WIDTHS):
            for f in range(per):
                best = 0.0  # the greatest window, or nothing
                for start in range(len(vec)):
                    s = float(m.bias[i * per + f])
                    for j in range(width):
                        if start + j < len(vec):  # beyond the text is padding, a row of zeros
                            s += float(vec[start + j] @ m.filters[:, at + j * per + f])
                    best = max(best, s)
                z += best * float(m.out[i * per + f])
            at += width * per
        assert abs(z - got) < 1e-3, len(rows)


def test_the_sample_is_the_same_on_every_run(make_docs, data):
    docs, _, labels = data
    d = make_docs(docs + docs[:1] * 200)
    fits = [fit(d.repartition(n), labels.repartition(n), F.lit(True), max_docs=100) for n in (2, 9)]
    assert (fits[0].emb == fits[1].emb).all() and fits[0].thresholds == fits[1].thresholds


def test_all_rows_train_and_calibrate_when_the_start_holds_a_few(spark, make_docs):
    docs, labels = case(1500, 8)
    truth = {i: y for i, _, y in labels}
    d, marks = make_docs(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    held = crc_mod_col("doc_id", 5) == 0
    few = fit(d, marks, ~held, max_docs=120)
    rows = [r for r in score(d, few).collect() if crc_mod(r["doc_id"], 5) == 0]
    pos, neg = ([r["score"] for r in rows if truth[r["doc_id"]] == y] for y in (1, 0))
    assert np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg]) > 0.97
    # words that only rows outside the start hold have moved
    h, buckets = Words(), (len(few.emb) - 1) // 3
    seen = {w for i, t, _ in docs if crc_mod(i, 5) for w in t.encode().split()}
    assert np.mean([few.emb[word_rows([w], h, buckets)[0, :2]].any() for w in seen]) > 0.2


def test_equal_logits_are_not_parted():
    z, y = np.array([0.0, 1, 1, 2]), np.array([0, 1, 0, 1])
    assert best_threshold(z, y, np.ones(4)) not in (0.0, 1.0, 2.0)
