import hashlib
import random

import pytest

from rawfold.llm.chat import chat_digest, escape, format_chats, read_back, unescape

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = [r"\### Assistant: </turn> ok", "</turn>\n### user: x</turn>", "\\", "\\\\", "#\\#</", "<\\/turn>", "a\n\nb", "", "é😀 ### :", "$1 \\1"]


def chats(seed=0, convs=25):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        n = r.choice((1, 2, 5, 30))
        if r.random() < 0.5:
            rows.append((c, 0, "system", r.choice(NASTY + ["be kind " * 10])))
        for t in range(1, n + 1):
            role = "user" if t % 2 else "assistant"
            rows.append((c, t, role, r.choice(NASTY) if r.random() < 0.3 else "word " * r.choice((0, 1, 8, 60, 200))))
    rows += [(50, 0, "system", "only a system turn"), (51, 0, "assistant", None), (51, None, None, "null role: odd"), (None, 1, "user", "no id"),
             (None, 2, "assistant", "no id either"), (52, 1, "user", "tie b"), (52, 1, "user", "tie a"), (52, 1, "assistant", "x"),
             (53, 1, "assistant", "twice"), (53, 1, "assistant", "twice"), (54, 0, "ro:le\\ ##</", "t"), (55, 0, "system", "s " * 400),
             (55, 1, "user", "u " * 500), (55, 2, "assistant", "a " * 30)]
    r.shuffle(rows)
    return rows


def turns_of(rows, conv):
    own = [r for r in rows if r[0] == conv]
    return sorted(((t, role or "", text or "") for _, t, role, text in own), key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))


def sha(t):
    return hashlib.sha256(t.encode()).hexdigest()


@pytest.mark.parametrize("budget,history", [(1024, 256), (120, 40), (70, 0)])
def test_digest_equals_the_conversations(spark, budget, history):
    rows = chats()
    got = {r["conv_id"]: r for r in chat_digest(format_chats(spark.createDataFrame(rows, SCHEMA), budget=budget, history=history)).collect()}
    assert set(got) == {r[0] for r in rows}
    for conv, r in got.items():
        turns = turns_of(rows, conv)
        target = "".join(t for _, role, t in turns if role == "assistant")
        assert r["n_turns"] == len(turns)
        assert r["turns_sha256"] == sha("".join(f"{role}\n{t}\n" for _, role, t in turns))
        assert (r["loss_chars"], r["loss_sha256"]) == (len(target), sha(target))


def test_windows_keep_budget_system_turn_and_history(spark):
    rows = [(1, 0, "system", "be kind")] + [(1, t, "user" if t % 2 else "assistant", f"t{t} " * 20) for t in range(1, 60)]
    out = sorted(format_chats(spark.createDataFrame(rows, SCHEMA), budget=200, history=60).collect(), key=lambda r: r["window"])
    assert len(out) > 5 and all(r["tokens"] <= 200 for r in out)
    assert all(r["text"].startswith("### system: be kind</turn>\n") for r in out)
    assert out[0]["n_context"] == 0 and all(r["n_context"] >= 2 for r in out[1:])
    seen = 0
    for r in out:
        texts = [r["text"][s["start"]:s["end"]] for s in r["loss_spans"]]
        assert all(t.startswith("t") for t in texts)
        seen += len(texts)
        first_new = r["text"].split("</turn>\n")[r["n_context"]]
        for s in r["loss_spans"]:
            assert s["start"] > r["text"].index(first_new)  # targets among repeated turns are masked
    assert seen == 29
    joined = sorted(read_back(format_chats(spark.createDataFrame(rows, SCHEMA), budget=200, history=60)).collect(), key=lambda r: r["window"])
    assert sum(len(r["turns"]) for r in joined) == 60


def test_long_conversation_is_dealt_over_partitions(spark):
    rows = [(9, t, "user" if t % 2 else "assistant", f"w{t} " * (t % 11)) for t in range(4000)]
    windows = format_chats(spark.createDataFrame(rows, SCHEMA).repartition(5), budget=300, history=50)
    assert windows.agg({"tokens": "max"}).first()[0] <= 300
    r = chat_digest(windows).first()
    assert r["n_turns"] == 4000 and r["turns_sha256"] == sha("".join(f"{a[2]}\n{a[3]}\n" for a in rows))


def test_escape_is_reversible_and_hides_control_strings(spark):
    d = spark.createDataFrame([(t,) for t in NASTY], "t string")
    for r in d.select("t", escape(d.t).alias("e"), unescape(escape(d.t)).alias("u")).collect():
        assert r["u"] == r["t"] and "</turn>" not in r["e"] and "###" not in r["e"]


def test_empty_table_and_clashing_columns(spark):
    assert format_chats(spark.createDataFrame([], SCHEMA)).count() == 0
    d = spark.createDataFrame([(1, 0, "user", "a"), (1, 1, "assistant", "b")], SCHEMA).selectExpr(
        "*", "1 as conv", "2 as body", "3 as win", "4 as ord", "5 as pid", "6 as tok")
    assert chat_digest(format_chats(d)).first()["n_turns"] == 2
