import hashlib
import random
import re

from rawfold.llm.fim import fill_in_middle, fim_digest, unit_ends


def brute(doc, text, seed=1):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"{seed}:{'' if doc is None else doc}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return (doc, n, "plain", None, None, sha(text), sha(text))
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < 20
    out = f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"
    return (doc, n, "spm" if spm else "psm", len(p), len(m), sha(out), sha(text))


ODD = [None, "", "a", "<", "<P", "P>x<P", "<S><", "a<P>b", "x <M> y", "naïve — 日本語 \U0001F600 end", "\r\n\t \x00 a\x0bb", "<<S<M P>S>", "a" * 3000]


def test_equals_brute_force(spark, make_docs):
    rng = random.Random(1)
    rows = [(i, "".join(rng.choices("ab <>PSM.\né", k=rng.randint(0, 60)))) for i in range(400)]
    rows += [(1000 + 50 * k + i, t) for k in range(12) for i, t in enumerate(ODD)] + [(None, "some text"), (7, "twice"), (7, "twice")]
    got = [tuple(r) for r in fim_digest(fill_in_middle(make_docs(rows))).collect()]
    assert sorted(got, key=str) == sorted((brute(*r) for r in rows), key=str)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}


def test_long_text_and_other_rates(spark, make_docs):
    rng = random.Random(2)
    long = "".join(rng.choices("abc  .\n", k=1_000_000))
    assert len(unit_ends(long)) == len(re.findall(r"[A-Za-z]+|[^A-Za-z]", long))
    rows = [(i, "one two three") for i in range(60)] + [(99, long)]
    got = fill_in_middle(make_docs(rows), seed=3, fim_percent=100, spm_percent=100)
    assert {r["form"] for r in got.select("form").collect()} == {"spm"}
    back = fim_digest(got).filter("doc_id = 99").first()
    assert back["restored_sha256"] == hashlib.sha256(long.encode()).hexdigest()


def test_empty_table_and_clashing_columns(make_docs):
    assert fill_in_middle(make_docs([])).count() == 0
    d = make_docs([(1, "a b c")]).selectExpr("*", "1 as id", "2 as h1", "3 as n", "'x' as form", "5 as output")
    assert tuple(fim_digest(fill_in_middle(d)).first()) == brute(1, "a b c")
