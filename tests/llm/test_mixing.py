import random

import pytest

from rawfold.llm.mixing import mix_documents, mix_sources


def targets(sizes, weights=(5, 2, 1), cap=3):
    """Shares by weight, capped and shared again until none is above. sizes: source -> words."""
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, open_, out = sum(sizes.values()), set(order), {}
    while open_:
        left = total - sum(out.values())
        level = left / sum(w[s] for s in open_)
        over = [s for s in open_ if level * w[s] > cap * sizes[s]]
        if not over:
            return out | {s: level * w[s] for s in open_}
        out |= {s: float(cap * sizes[s]) for s in over}
        open_ -= set(over)
    return out


def rows_of(n, sources, seed=1):
    rng = random.Random(seed)
    return [(i, " ".join("w" for _ in range(rng.choice((0, 1, 5, 40, 41, 300)))), "en", rng.choice(sources)) for i in range(n)]


@pytest.mark.parametrize("sources", [["a", "b", "c", "d"], ["b", None, "é", "Z", "a"], ["only"]])
def test_targets_and_words_taken(make_docs, sources):
    rows = rows_of(400, sources)
    # a small source far below its weight's share meets the cap
    rows += [(1000 + i, "x y z", "en", "tiny" if None not in sources else None) for i in range(3)]
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(t.split())
    want = targets(sizes)
    got = mix_sources(make_docs(rows)).collect()
    assert len(got) == len(rows)
    for s in sizes:
        own = [r for r in got if r["source"] == s]
        assert own[0]["target"] == pytest.approx(want[s]) and own[0]["source_size"] == sizes[s]
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max(150, 0.02 * want[s])
    assert all(r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] for r in got)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))


def test_rates_are_the_tilt_that_meets_the_target(make_docs):
    rows = rows_of(300, ["a", "b"])
    got = [r for r in mix_sources(make_docs(rows)).collect() if r["source"] == "b"]
    assert sum(r["rate"] * r["size"] for r in got) == pytest.approx(got[0]["target"], rel=1e-6)
    import math
    tilt = {round(math.log(r["rate"]) / r["size"], 9) for r in got if r["size"] and r["rate"] < 3}
    assert max(tilt) - min(tilt) < 1e-6  # log rate is linear in size


def test_reruns_agree_whatever_the_partitions(make_docs):
    d = make_docs(rows_of(300, ["a", "b", None]))
    one = sorted(map(tuple, mix_sources(d.repartition(7)).select("doc_id", "copies").collect()))
    two = sorted(map(tuple, mix_sources(d.coalesce(1)).select("doc_id", "copies").collect()))
    assert one == two


def test_hot_cell_is_dealt_over_buckets(make_docs):
    rows = [(i, "same size text", "en", "a") for i in range(500)] + [(i, "w " * 30, "en", "b") for i in range(500, 600)]
    got = mix_sources(make_docs(rows), bucket_rows=16).collect()
    own = [r for r in got if r["source"] == "a"]
    assert {r["copies"] for r in own} <= {0, 1, 2, 3}
    assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= 30


def test_nulls_repeats_empty_and_clashing_columns(make_docs):
    rows = [(1, None, None, None), (1, None, None, None), (2, "", "en", "a"), (None, "a b", "en", "a"), (3, "a b", "en", "a"),
            (3, "a b", "en", "a")]
    d = make_docs(rows).selectExpr("*", "1 as sid", "2 as size", "3 as n", "4 as rate", "5 as copies", "6 as id", "7 as bucket")
    got = mix_sources(d).collect()
    assert len(got) == 6 and sum(r["taken"] for r in got if r["source"] == "a") == 6
    assert all(r["target"] == 0 for r in got if r["source"] is None)
    assert mix_sources(make_docs([])).count() == 0
    with pytest.raises(ValueError):
        mix_sources(d, weights=())


def test_mix_documents_repeats_rows_and_keeps_columns(make_docs):
    rows = rows_of(120, ["a", "b"]) + [(500, "one two", "en", "a")] * 3
    d = make_docs(rows)
    taken = sum(r["taken"] for r in mix_sources(d).collect())
    out = mix_documents(d)
    assert out.columns == d.columns
    words = sum(len((r["text"] or "").split()) for r in out.collect())
    assert abs(words - taken) <= 6
    assert {tuple(r) for r in out.collect()} <= {tuple(r) for r in d.collect()}
