import hashlib
import random

import pytest
from pyspark.sql import functions as F

from llm_rules import spaced
from rawfold.llm.fingerprints import add_sketch, containment, fingerprint_report, hashes_of, likeness, merge

KEY = lambda doc, t: hashlib.md5((f"={doc}" if doc is not None else "").encode() + b"\n" + (t or "").encode()).digest()


def shingles(text, k=5):
    w = spaced(text)
    return {hashlib.md5(" ".join(w[i:i + k]).encode()).hexdigest()[:16] for i in range(max(1, len(w) - k + 1))} if w else set()


def sketch(text, scale=8, k=5):
    every = shingles(text, k)
    low = {h for h in every if int(h, 16) < 2**64 // scale}
    return low or set(sorted(every)[:1])


def brute(rows):
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), KEY(*r)))
    out = []
    for i, (doc, t) in enumerate(rows):
        t, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        m = len(t) // 3
        edited = t[:len(t) - m] + nxt[:m]
        a, b, c = sketch(t), sketch(edited), sketch(nxt)
        like = lambda x, y: len(x & y) / len(x | y) if x | y else 1.0
        out.append((doc, len(t), hashlib.sha256(edited.encode()).hexdigest(), "".join(sorted(a)), "".join(sorted(b)),
                    like(a, b), like(a, c)))
    return sorted(out, key=str)


def test_equals_brute_force(make_docs, words):
    rng = random.Random(4)
    rows = [(i * 7 % 211, words(rng.choice((1, 3, 4, 5, 6, 40, 300)), i)) for i in range(200)]
    rows += [(500, None), (501, ""), (502, " \t\n"), (503, "One  TWO\tthree é \U0001F600"), (504, "x" * 20_000), (505, rows[0][1])]
    got = [tuple(r) for r in fingerprint_report(make_docs(rows)).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_null_and_repeated_ids_and_repeated_rows(make_docs, words):
    rows = [(None, words(30, i)) for i in range(20)] + [(3, "same text here")] * 7 + [(3, "other text")] * 2 + [(9, "a"), (None, None), (None, None)]
    got = [tuple(r) for r in fingerprint_report(make_docs(rows)).collect()]
    assert sorted(got, key=str) == brute(rows)


@pytest.mark.parametrize("rows", [[], [(1, "alone in the table with some words")], [(1, "one"), (2, "two")]])
def test_small_tables_and_clashing_columns(make_docs, rows):
    d = make_docs(rows).selectExpr("*", "1 as id", "2 as k", "3 as sketch", "4 as next", "5 as head", "6 as pid")
    assert sorted((tuple(r) for r in fingerprint_report(d).collect()), key=str) == brute(rows)


def test_merged_sketches_are_those_of_the_union(spark, words):
    texts = [words(n, n) for n in (1, 3, 6, 50, 400)] + [""]
    rows = [(a, b) for a in texts for b in texts]
    d = spark.createDataFrame(rows, "a string, b string")
    d = add_sketch(add_sketch(d, "a", "x"), "b", "y")
    got = d.select("a", "b", merge(hashes_of(F.col("x")), hashes_of(F.col("y"))).alias("m")).collect()
    for r in got:
        every = shingles(r["a"]) | shingles(r["b"])
        low = {h for h in every if int(h, 16) < 2**61}
        assert r["m"] == sorted(low or sorted(every)[:1])


def test_containment_finds_a_short_text_in_a_long_one(spark, words):
    long = words(20_000, 1)
    part = " ".join(long.split()[5000:5600])
    d = add_sketch(add_sketch(spark.createDataFrame([(part, long)], "a string, b string"), "a", "x"), "b", "y")
    r = d.select(containment(hashes_of(F.col("x")), hashes_of(F.col("y"))).alias("c"),
                 likeness(hashes_of(F.col("x")), hashes_of(F.col("y"))).alias("j")).first()
    assert r["c"] == 1.0 and r["j"] < 0.1


def test_likeness_is_near_that_of_the_full_sets(make_docs, words):
    rows = [(i, words(600, i)) for i in range(30)]
    got = {r["doc_id"]: r for r in fingerprint_report(make_docs(rows)).collect()}
    off = [abs(r["near_edited"] - 0.5) for r in got.values()]
    assert sum(off) / len(off) < 0.08 and all(r["near_next"] < 0.1 for r in got.values())


def test_one_shuffle_of_the_texts_and_no_python(spark, make_docs, words):
    out = fingerprint_report(make_docs([(i, words(9, i)) for i in range(50)]))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString()
    plan = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    assert "Arrow" not in plan and "Python" not in plan and plan.count("ReusedExchange") == 1
