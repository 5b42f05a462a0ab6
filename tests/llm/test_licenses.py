import itertools
import random
import time
import re

import pytest

from llm_rules import alnum
from rawfold.llm.licenses import BASE, Detection, Scanner, rules, scan, suppress

TEXTS = [None, "", "no terms here", "Licensed under CC BY-NC 4.0.", "CC\nBY, cc  by; cc-by", "The MIT License (MIT)\nmit license",
         "GNU General Public License, version 3 or (at your option) any later version", "the apache license", "Apache\tLicense apache license",
         "SPDX-License-Identifier: LGPL-2.1-or-later", "All rights reserved. © 2020", "gnu general public gnu general public license license",
         "summit license", "mit licensed", "admit license mit  LICENSE", "Tous droits réservés", "cc cc by by", "x " * 100_000 + "MIT License"]


def base(text):
    w = alnum(text)
    found = [(i, label) for p, label in BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split()]
    at = [i for i, _ in found]
    return len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in found}))


def test_base_places_equal_brute_force(make_docs):
    rows = list(enumerate(TEXTS)) + [(3, TEXTS[3]), (None, TEXTS[5])]
    d = make_docs(rows).selectExpr("*", "1 as row", "2 as labels", "3 as n_words", "4 as detections")
    got = scan(d).collect()
    assert sorted([(r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in got], key=str) == \
        sorted([(i, *base(t)) for i, t in rows], key=str)
    for r in got:
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert r["labels"].split(",") == sorted(set(r["labels"].split(","))) and 0 <= r["score"] <= 1
        assert bool(r["score"]) == bool(r["labels"])
    assert scan(make_docs([])).count() == 0


@pytest.mark.parametrize("text,label", [
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"), ("Creative Commons Attribution-ShareAlike 3.0 Unported", "cc-by-sa-3.0"),
    ("GNU General Public License version 2 or (at your option) any later version", "gpl-2.0-or-later"), ("GPLv3", "gpl-3.0"),
    ("SPDX-License-Identifier: Apache-2.0", "apache-2.0"), ("Permission is hereby granted, free of charge, to any person obtaining a copy of "
                                                           "this software and associated documentation files", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("alle Rechte vorbehalten", "all-rights-reserved"), ("This is free and unencumbered software released into the public domain.", "unlicense")])
def test_signatures(text, label):
    _, hits = Scanner().detect([w.encode() for w in alnum(text)])
    assert label in {h.label for h in hits}


def test_contained_detections_of_lower_rank_are_suppressed():
    a, b, c = Detection(0, 30, "long", 4, 1), Detection(5, 10, "inside", 3, 0), Detection(25, 40, "overlaps", 1, 2)
    assert suppress([b, c, a]) == [a, c]
    assert suppress([Detection(0, 9, "first", 2, 1), Detection(0, 9, "second", 2, 5)]) == [Detection(0, 9, "first", 2, 1)]
    # a higher priority inside a longer, lower one: both stay
    assert len(suppress([Detection(0, 30, "name", 1, 0), Detection(5, 10, "grant", 4, 1)])) == 2


def test_hundreds_of_rules_each_behind_its_keyword():
    all_rules = rules()
    assert len(all_rules) > 300
    s = Scanner()
    for r in all_rules:
        plain = re.sub(r"\(\?<!\\S\)|\(\?!\\S\)", "", r.pattern.pattern)
        assert r.keyword and plain
    # the prefilter never hides a detection: unfiltered patterns find the same in every signature text
    for t in TEXTS[1:]:
        w = [x.encode() for x in alnum(t)[:200]]
        joined = b" ".join(w).decode()
        every = suppress([Detection(*m.span(), r.label, r.priority, i) for i, r in enumerate(all_rules) for m in r.pattern.finditer(joined)])
        assert s.detect(w)[1] == every


def matching(parsed):
    """A text for every choice of alternatives, optional parts and letters of a parsed pattern."""
    parts = []
    for op, arg in parsed:
        kind = str(op)
        if kind == "LITERAL":
            parts.append([chr(arg)])
        elif kind == "IN":
            parts.append(["7" if str(o) == "CATEGORY" and "DIGIT" in str(a) else "q" if str(o) == "CATEGORY" else chr(a) for o, a in arg])
        elif kind == "SUBPATTERN":
            parts.append(matching(arg[-1]))
        elif kind == "BRANCH":
            parts.append([t for branch in arg[1] for t in matching(branch)])
        elif kind == "MAX_REPEAT":
            low, high, what = arg
            parts.append([t * n for n in range(low, min(high, low + 1) + 1) for t in matching(what)])
        else:
            assert kind in ("ASSERT", "ASSERT_NOT"), kind
    return ["".join(p) for p in itertools.product(*parts)]


def unfiltered(all_rules, joined):
    return suppress([Detection(*m.span(), r.label, r.priority, i) for i, r in enumerate(all_rules) for m in r.pattern.finditer(joined)])


def test_the_prefilter_hides_no_match_of_any_alternative_of_any_rule():
    all_rules, s, n = rules(), Scanner(), 0
    for r in all_rules:
        for text in matching(re._parser.parse(r.pattern.pattern)):
            assert r.pattern.fullmatch(text), (r, text)
            assert f" {r.keyword} " in f" {text} ", (r, text)
            assert s.detect(text.encode().split())[1] == unfiltered(all_rules, text) != [], (r, text)
            n += 1
    assert n > 2000


@pytest.mark.parametrize("text,label", [
    ("SPDX-License-Identifier: BSL-1.0", "boost-1.0"), ("FreeBSD License", "bsd-2-clause"), ("Berkeley Software Distribution License", "bsd"),
    ("PSF License", "python-2.0"), ("PSF-2.0", "python-2.0"), ("X Consortium License", "x11"), ("under the same terms as Perl itself", "artistic"),
    ("CreativeML Open RAIL-M", "openrail-m"), ("Llama community licence", "llama-community"), ("SPDX-License-Identifier: MPL-1.1", "mpl-1.1"),
    ("the\u00a0WTFPL", "wtfpl"), ("\u3000ISC licence", "isc")])
def test_signatures_without_their_familys_name(text, label):
    w = [x.encode() for x in alnum(text)]
    hits = Scanner().detect(w)[1]
    assert label in {h.label for h in hits} and hits == unfiltered(rules(), b" ".join(w).decode())


def plain_suppress(found):
    kept = []
    for d in sorted(found, key=lambda d: (-d.priority, -(d.end - d.start), d.order, d.start)):
        if not any(k.start <= d.start and d.end <= k.end for k in kept):
            kept.append(d)
    return sorted(kept)


def test_the_sweep_equals_testing_each_detection_against_all_kept_ones():
    r = random.Random(3)
    for case in range(3000):
        found = []
        for _ in range(r.randint(0, 25)):
            a = r.randint(0, 12)
            found.append(Detection(a, a + r.randint(1, 8), r.choice("xyz"), r.randint(1, 4), r.randint(0, 6)))
        assert suppress(found) == plain_suppress(found), (case, found)


def test_a_hundred_thousand_mentions_in_one_text_take_seconds():
    began = time.perf_counter()
    words = b"see mit license or apache license version 2 0 here".split() * 100_000
    hits = Scanner().detect(words)[1]
    assert len(hits) >= 200_000 and time.perf_counter() - began < 60
