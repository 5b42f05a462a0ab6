import hashlib
import random
import zlib

import numpy as np
import pytest

from rawfold.llm import conversations as c
from rawfold.llm.conversations import damage, repair, repair_digest

SCHEMA = "conv_id long, turn long, role string, text string"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def cheapest(rows):
    """rows: (role, text, must go, truncated) -> (cost, initials, lines); every state's least (cost, initials), row by row."""
    def with_inserts(best):
        for _ in range(3):
            for q, (cost, audit, lines) in list(best.items()):
                for name in ("user", "assistant"):
                    to = NEXT.get((q, name[0]))
                    new = (cost + 3, audit + "I", [*lines, name + ":"])
                    if to and (to not in best or new < best[to]):
                        best[to] = new
        return best

    best = with_inserts({"": (0, "", [])})
    for role, text, gone, cut in rows:
        after = {}
        for q, (cost, audit, lines) in best.items():
            ways = [(q, 4, "D", None)]
            if not gone:
                ways += [(NEXT.get((q, role[:1] or "?")), 3 * cut, "K", role)]
                ways += [(NEXT.get((q, n[0])), 3 * cut + 3, "R", n) for n in ("user", "assistant")]
            for to, more, letter, name in ways:
                new = (cost + more, audit + letter, lines + ([f"{name}:{text}"] if name is not None else []))
                if to is not None and (to not in after or new < after[to]):
                    after[to] = new
        best = with_inserts(after)
    return min(best[q] for q in ("", "a") if q in best)


def brute(rows, damaged=False):
    """rows of conversations -> {conv_id: the query's row}."""
    space = " \t\n\v\f\r"
    out = {}
    for conv in {r[0] for r in rows}:
        after = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            role, text = " " if role is None else role, " " if text is None else text
            kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
            text = "" if kind == 1 else "".join(x for x in text if x not in ".!?") if kind == 2 else text
            after += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, said, counts = set(), [], [0, 0, 0]
        for _, role, text in after:
            end = text.rstrip(space)[-1:]
            blank, twice, cut = not end, bool(end) and (role, text) in seen, False
            seen.add((role, text))
            if not blank and not twice:
                cut = end not in ".!?"
            for i, fault in enumerate((blank, twice, cut)):
                counts[i] += fault
            said.append((role, text, blank or twice, cut))
        turns = {r[0] for r in after if r[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        cost, audit, lines = cheapest(said) if said else (0, "", [])
        out[conv] = (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def found(spark, rows, damaged=False, **options):
    turns = spark.createDataFrame(rows, SCHEMA)
    got = repair_digest(repair(damage(turns) if damaged else turns, **options), turns).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def some_rows(seed, convs, most):
    rng = random.Random(seed)
    texts = ["yes.", "no", "why?", "", " \t", None, "so it is!  ", "a.b", "end", "ok. ", "né.", "x" * 5000 + "."]
    roles = ["user", "assistant", "system", "tool", "", None, "User"]
    return [(conv, rng.choice([t, t, t, t + 3, None]), rng.choice(roles[:3] * 3 + roles), rng.choice(texts))
            for conv in range(convs) for t in range(rng.randint(0, most))]


@pytest.mark.parametrize("chunk_rows", [1, 3, 4096])
def test_equals_brute_force_however_rows_are_chunked(spark, chunk_rows):
    rows = some_rows(chunk_rows, 40, 14) + [(None, 0, "user", "hi."), (None, 1, "assistant", "ho."), (None, None, "system", "be.")]
    assert found(spark, rows, chunk_rows=chunk_rows) == brute(rows)


def test_damaged_rows_equal_brute_force(spark):
    rows = some_rows(5, 60, 9) + [(-7, None, None, None)]
    got, want = found(spark, rows, damaged=True), brute(rows, damaged=True)
    assert got == want and any(v[6] == "" for v in want.values())


def test_long_conversation_over_many_chunks_and_repeated_rows(spark):
    rng = random.Random(2)
    rows = [(1, i, rng.choice(("user", "assistant")), f"t{rng.randrange(300)}" + rng.choice(("", "."))) for i in range(1500)]
    rows += [(2, 5, "user", "same.")] * 400
    got = found(spark, rows, chunk_rows=64)
    assert got == brute(rows)
    assert got[2][:7] == (0, 0, 399, 0, 399, 1599, "K" + "D" * 399 + "I")


@pytest.mark.parametrize("n", range(1, 14))
def test_block_tables_equal_single_steps(n):
    rng = np.random.default_rng(n)
    t = c.tables()
    for _ in range(60):
        s = rng.integers(0, c.SYMBOLS, n)
        v, cost = 0, 0
        for x in s[::-1]:
            cost += int(t.cost[v, x])
            v = int(t.step[v, x])
        assert c.walk_back(s, 0)[:2] == (v, cost)


def test_edits_are_rows_of_their_own(spark):
    turns = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "assistant", "")], SCHEMA)
    r = repair(turns)
    got = [tuple(x) for x in r.edits.orderBy("at", "k").select("edit", "role", "text").collect()]
    assert got == [("K", "user", "a."), ("R", "assistant", "b."), ("D", None, None)] and r.figures.first()["cost"] == 7


def test_empty_table_and_clashing_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair_digest(repair(damage(empty)), empty).count() == 0
    d = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], SCHEMA).selectExpr(
        "*", "1 as conv", "2 as at", "3 as chunk", "4 as same", "5 as first", "6 as kind", "7 as copy")
    got = repair_digest(repair(d), d).collect()
    assert [tuple(r)[1:7] for r in got] == [(0, 0, 0, 0, 0, 0)] and got[0]["audit"] == "KK"
