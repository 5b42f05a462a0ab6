import hashlib

import pytest
from pyspark.sql import functions as F

from rawfold.llm.exact_dedup import content_hash, exact_dedup


def brute(rows, pick):
    from llm_rules import ascii_lower
    groups = {}
    for i, t in rows:
        groups.setdefault(ascii_lower(t), []).append(i)
    out = []
    for i, t in rows:
        ids = groups[ascii_lower(t)]
        known = [x for x in ids if x is not None]
        keep = pick(known) if known else None
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(ascii_lower(t).encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = [(1, "Same TEXT"), (2, "same text"), (3, "same texT"), (4, "É x"), (5, "é x"), (6, None), (7, ""), (8, "alone"),
        (8, "alone"), (None, "SAME text"), (None, "null id"), (9, "İ K"), (10, "x" * 200_000), (11, "X" * 200_000)]


@pytest.mark.parametrize("stays,pick", [("smallest", min), ("largest", max)])
def test_equals_brute_force(make_docs, stays, pick):
    got = [tuple(r) for r in exact_dedup(make_docs(ROWS), stays=stays).collect()]
    assert sorted(got, key=str) == brute(ROWS, pick)


@pytest.mark.parametrize("hash_fn", [lambda c: F.lit(b"one"), lambda c: F.substring(content_hash(c), 1, 1)])
def test_collisions_of_the_hash_are_told_apart_by_bytes(make_docs, hash_fn):
    rows = ROWS + [(100 + i, f"text {i % 7}") for i in range(60)]
    got = [tuple(r) for r in exact_dedup(make_docs(rows), hash_fn=hash_fn, salt_rows=4).collect()]
    assert sorted(got, key=str) == brute(rows, min)


def test_hot_group_over_many_salts(make_docs):
    rows = [(i, "Copy") for i in range(300)] + [(1000 + i, f"t{i}") for i in range(300)]
    got = exact_dedup(make_docs(rows), stays="largest", salt_rows=8)
    assert got.filter("keep_id = 299 and group_size = 300").count() == 300
    assert got.filter("kept").count() == 301


def test_empty_table_clashing_columns_and_unknown_option(make_docs):
    assert exact_dedup(make_docs([])).count() == 0
    d = make_docs([(1, "a"), (2, "a")]).selectExpr("*", "1 as h", "2 as n", "3 as keep", "4 as norm", "5 as id", "6 as salt")
    assert exact_dedup(d).filter("kept").count() == 1
    with pytest.raises(ValueError):
        exact_dedup(d, stays="newest")
