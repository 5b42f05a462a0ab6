import random

import numpy as np
import pytest

from llm_rules import spaced
from rawfold.llm.common import WordHashes
from rawfold.llm.minhash import drop_near_dups, fast_similarity_sketch, near_dup, shingle_set


def brute(rows, k, percent=80):
    """rows: (id, text) -> sorted (id, set size, smallest id reachable)."""
    sets = []
    for _, t in rows:
        w = spaced(t)
        sets.append(frozenset(tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))) if w else frozenset())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(i) and rows[j][0] is not None]
        out.append((doc, len(sets[i]), min(ids) if sets[i] and ids else doc))
    return sorted(out, key=str)


def families(words, seed=0):
    rng = random.Random(seed)
    rows, i = [], 0
    for f in range(25):
        base = words(rng.randint(3, 160), seed * 1000 + f).split()
        for _ in range(rng.randint(1, 6)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 12))):
                w[rng.randrange(len(w))] = rng.choice(("new", "word", "here"))
            rows.append((i, " ".join(w)))
            i += 1
            base = w if rng.random() < 0.5 else base  # chains: ends that are not similar themselves
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("k", [4, 5])
def test_components_equal_brute_force(make_docs, words, k):
    rows = families(words, k) + [(900, None), (901, ""), (902, "one two"), (903, "One  TWO"), (904, "one"), (905, " \t ")]
    got = near_dup(make_docs(rows), k=k).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows, k)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_weak_bands_still_find_links_across_components_of_a_bucket(make_docs, words):
    """One coordinate a band: nearly all classes meet in buckets, so most pairs are settled by the second pass."""
    rows = families(words, 9)
    got = near_dup(make_docs(rows), k=4, bands=40, rows=1).collect()
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=str) == brute(rows, 4)


def test_hot_group_of_near_copies(make_docs, words):
    base = words(120, 5).split()
    rows = [(i, " ".join(base[:60] + [f"u{i}"] + base[60:])) for i in range(300)]
    rows += [(1000 + i, " ".join(base)) for i in range(100)]
    got = near_dup(make_docs(rows), k=4)
    assert got.filter("component_id = 0").count() == 400 and got.filter("kept").count() == 1


def test_repeated_ids_nulls_empty_table_and_clashing_columns(make_docs, words):
    a, b = words(40, 1), words(40, 2)
    rows = [(5, a), (5, b), (5, a), (7, b), (None, a), (None, "x y z"), (None, None)]
    d = make_docs(rows).selectExpr("*", "1 as id", "2 as node", "3 as digest", "4 as th", "5 as n")
    got = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in near_dup(d, k=5).collect()), key=str)
    assert got == sorted([(5, 36, 5)] * 3 + [(7, 36, 5), (None, 36, 5), (None, 1, None), (None, 0, None)], key=str)
    assert near_dup(make_docs([])).count() == 0


def test_drop_near_dups_keeps_one_row_of_each_group(make_docs, words):
    a, b = words(50, 1), words(50, 2)
    rows = [(3, a), (3, a), (4, a + " tail"), (5, b), (6, None), (7, ""), (3, b)]
    out = drop_near_dups(make_docs(rows))
    assert sorted((r["doc_id"], r["text"]) for r in out.collect() if r["text"]) == sorted([(3, a), (3, b)])
    assert out.filter("coalesce(text, '') = ''").count() == 2
    assert drop_near_dups(make_docs([])).count() == 0


def test_every_coordinate_fills_and_agreement_estimates_similarity():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 60, 3000):
        s = rng.integers(0, 2**63, n).astype(np.uint64)
        assert (fast_similarity_sketch(np.unique(s), 512) != np.uint64(2**64 - 1)).all()
    both, a, b = (rng.integers(0, 2**63, n).astype(np.uint64) for n in (800, 100, 100))
    x, y = (fast_similarity_sketch(np.unique(np.concatenate([both, z])), 4096) for z in (a, b))
    assert abs((x == y).mean() - 0.8) < 0.03


def test_sketch_does_not_depend_on_how_rounds_are_grouped():
    """A subset of one shingle more: small and large sets use other group sizes but the same rounds."""
    s = np.unique(np.random.default_rng(2).integers(0, 2**63, 4097).astype(np.uint64))
    x, y = fast_similarity_sketch(s, 256), fast_similarity_sketch(s[:-1], 256)
    assert (x == y).mean() > 0.98


def test_long_text_and_short_memory(words):
    h = WordHashes(limit=10)
    t = words(50_000, 3)
    assert len(shingle_set(t, 4, h)) == len({tuple(t.split()[i:i + 4]) for i in range(50_000 - 3)})
