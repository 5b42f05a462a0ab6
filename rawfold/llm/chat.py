r"""Chat formatting in budgeted windows. Only DataFrame functions.

A turn is written ``### role: text</turn>`` and a newline. In texts and roles ``\``, ``#`` and the ``/`` of ``</`` get a
``\`` before them (in roles ``:`` too), so no text holds a control string and one left-to-right pass undoes it.

A conversation is cut at turns by prefix sums of turn tokens (words, plus ``turn_tokens`` for the markers):
with a stride of ``budget - history - system tokens`` a turn belongs to the cell its first token falls into, and a turn
that runs over the cell's end is a window of its own. So the new turns of a window stay within the stride unless a
single turn is longer. Every window begins with the system turn (the conversation's first, if its role is system),
then repeats the last turns before it that fit into ``history`` tokens, then has its new turns. Loss spans (code points,
end exclusive) cover the assistant texts among the new turns only: repeated targets are masked.

Prefix sums are taken over range partitions (conversation, turn, role, text), so a conversation of any length is
dealt over tasks; a window is bounded by the budget, or by one turn.

Defined results: null role or text counts as empty; null is a conversation of its own; rows are in order of turn (null
first), ties by role, then text; repeated rows are turns of their own; an empty table gives no window; other columns
are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawfold.llm.common import SPACE_WORD, materialize

END = "</turn>\n"


def escape(c: Column) -> Column:
    c = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    return F.replace(F.replace(c, F.lit("#"), F.lit("\\#")), F.lit("</"), F.lit("<\\/"))


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def _segment(role: Column, text: Column) -> Column:
    return F.concat(F.lit("### "), F.replace(escape(role), F.lit(":"), F.lit("\\:")), F.lit(": "), escape(text), F.lit(END))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def format_chats(turns: DataFrame, *, budget: int = 1024, history: int = 256, turn_tokens: int = 4,
                 conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per window: ``conv_id, window, text, n_context, n_turns, tokens, loss_spans``.

    ``n_context`` leading turns are repeated ones; ``n_turns`` counts all turns of the window."""
    spark = turns.sparkSession
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
                        F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")).alias("role"),
                        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("body"))
    rows = rows.withColumn("tok", F.regexp_count("body", F.lit(SPACE_WORD)).cast("long") + turn_tokens)
    order = ["turn", "role", "body"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = materialize(rows.repartitionByRange(parts, "conv", *order).withColumn("pid", F.spark_partition_id()),
                         "chat-turns")

    # the first turn of a conversation, and in which part each conversation's tokens begin
    head = ranged.groupBy("conv").agg(F.min(F.struct(*order, "tok")).alias("first"))
    head = head.select(F.col("conv").alias("c"), (F.col("first.role") == "system").alias("has_system"),
                       F.col("first.tok").alias("first_tok"))
    head = head.withColumn("system_tok", F.when(F.col("has_system"), F.col("first_tok")).otherwise(F.lit(0))).withColumn(
        "stride", F.greatest(F.lit(budget - history) - F.col("system_tok"), F.lit(64)).cast("long"))
    by_part = Window.partitionBy("conv").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy("conv", "pid").agg(F.sum("tok").alias("t"), F.count(F.lit(1)).alias("k"))
    sums = (sums.withColumns({"t0": F.coalesce(F.sum("t").over(by_part), F.lit(0)),
                              "k0": F.coalesce(F.sum("k").over(by_part), F.lit(0))})
            .join(head, _same(F.col("conv"), F.col("c")))
            .select(F.col("conv").alias("c"), F.col("pid").alias("p"), "t0", "k0", "has_system", "system_tok", "stride"))
    sums = materialize(sums, "chat-sums")

    inside = Window.partitionBy("conv", "pid").orderBy(*order)
    placed = (ranged.withColumns({"run": F.sum("tok").over(inside.rowsBetween(Window.unboundedPreceding, -1)),
                                  "pos": F.row_number().over(inside)})
              .join(sums, _same(F.col("conv"), F.col("c")) & (F.col("pid") == F.col("p")))
              .withColumn("ord", F.col("k0") + F.col("pos") - 1)
              .withColumn("is_system", F.col("has_system") & (F.col("ord") == 0))
              .withColumn("start", F.col("t0") + F.coalesce("run", F.lit(0)) - F.col("system_tok"))
              .withColumn("cell", F.floor(F.col("start") / F.col("stride")))
              .withColumn("win", F.when(F.col("is_system"), F.lit(None).cast("long")).otherwise(
                  2 * F.col("cell") + (F.col("start") + F.col("tok") > (F.col("cell") + 1) * F.col("stride")).cast("long")))
              .withColumn("seg", _segment(F.col("role"), F.col("body")))
              .withColumn("is_target", F.col("role") == "assistant")
              .withColumn("mark", F.char_length("seg") - F.char_length(escape(F.col("body"))) - len(END))
              .select("conv", "ord", "is_system", "is_target", "tok", "start", "stride", "win", "seg", "mark"))
    placed = materialize(placed, "chat-placed")
    system, said = placed.filter("is_system"), placed.filter("not is_system")

    # windows; a conversation of nothing but a system turn has one too
    windows = said.groupBy("conv", "win").agg(F.min("start").alias("first"))
    alone = system.select("conv").join(windows.select(F.col("conv").alias("c")).distinct(),
                                       _same(F.col("conv"), F.col("c")), "left_anti")
    windows = windows.unionByName(alone.select("conv", F.lit(0).cast("long").alias("win"), F.lit(0).cast("long").alias("first")))
    windows = materialize(windows, "chat-windows")
    lead = windows.groupBy("conv").agg(F.min("win").alias("lead")).withColumnRenamed("conv", "c")

    item = ["ord", "is_target", "tok", "seg", "mark"]
    new = said.select("conv", "win", *item, F.lit(False).alias("repeated"))
    cells = F.sequence(F.floor((F.col("start") + F.col("tok")) / F.col("stride")),
                       F.greatest(F.floor((F.col("start") + F.col("tok")) / F.col("stride")),
                                  F.floor((F.col("start") + F.lit(history)) / F.col("stride"))))
    again = (said.filter(F.col("tok") <= history).withColumn("cell", F.explode(cells))
             .withColumn("w", F.explode(F.array(2 * F.col("cell"), 2 * F.col("cell") + 1))).filter("w != win")
             .join(windows.toDF("c", "w2", "first"), _same(F.col("conv"), F.col("c")) & (F.col("w") == F.col("w2"))
                   & (F.col("start") < F.col("first")) & (F.col("start") >= F.col("first") - F.lit(history)))
             .select("conv", F.col("w").alias("win"), *item, F.lit(True).alias("repeated")))
    kept = (windows.join(system.select(F.col("conv").alias("sc"), *item), _same(F.col("conv"), F.col("sc")))
            .join(lead, _same(F.col("conv"), F.col("c")))
            .select("conv", "win", *item, (F.col("win") != F.col("lead")).alias("repeated")))
    pieces = new.unionByName(again).unionByName(kept).repartition(parts, "conv", "win")

    before = Window.partitionBy("conv", "win").orderBy("ord").rowsBetween(Window.unboundedPreceding, -1)
    begin = F.coalesce(F.sum(F.char_length("seg")).over(before), F.lit(0)) + F.col("mark")
    pieces = pieces.withColumn("begin", begin).withColumn(
        "span", F.when(F.col("is_target") & ~F.col("repeated"), F.struct(
            F.col("begin").cast("long").alias("start"),
            (F.col("begin") + F.char_length("seg") - F.col("mark") - len(END)).cast("long").alias("end"))))
    grouped = pieces.groupBy("conv", "win").agg(
        F.array_sort(F.collect_list(F.struct("ord", "seg", "span"))).alias("all"),
        F.sum(F.col("repeated").cast("long")).alias("n_context"), F.sum("tok").alias("tokens"))
    spans = F.transform(F.filter("all", lambda x: x["span"].isNotNull()), lambda x: x["span"])
    return grouped.select(F.col("conv").alias(conv_col), F.col("win").alias("window"),
                          F.array_join(F.transform("all", lambda x: x["seg"]), "").alias("text"), "n_context",
                          F.size("all").cast("long").alias("n_turns"), "tokens", spans.alias("loss_spans"))


def read_back(windows: DataFrame, *, conv_col: str = "conv_id") -> DataFrame:
    """Windows parsed again: per window the new turns ``(role, text)`` and the unescaped texts under the mask."""
    turns = F.filter(F.split("text", "</turn>\n"), lambda s: s != "")
    head = r"(?s)^### ((?:[^\\:]|\\.)*): (.*)$"
    parsed = F.transform(turns, lambda s: F.struct(unescape(F.regexp_extract(s, head, 1)).alias("role"),
                                                   unescape(F.regexp_extract(s, head, 2)).alias("text")))
    start = F.col("n_context").cast("int")
    new = F.slice(parsed, start + 1, F.greatest(F.size(turns) - start, F.lit(0)))
    said = F.transform("loss_spans", lambda p: unescape(F.substring(
        F.col("text"), (p["start"] + 1).cast("int"), (p["end"] - p["start"]).cast("int"))))
    return windows.select(conv_col, "window", F.char_length("text").cast("long").alias("chars"), new.alias("turns"),
                          said.alias("targets"))


def chat_digest(windows: DataFrame, *, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, read back from the windows: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    n_windows. A digest of a whole conversation needs its text in one row; the windows themselves do not."""
    back = read_back(windows, conv_col=conv_col).select(
        conv_col, "window", "chars", F.size("turns").cast("long").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        F.array_join("targets", "").alias("targets"))
    one = back.groupBy(conv_col).agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "targets"))).alias("all"), F.sum("n").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"), F.count(F.lit(1)).alias("n_windows"))
    joined = lambda name: F.array_join(F.transform("all", lambda x: x[name]), "")
    return one.select(conv_col, "n_turns", F.sha2(joined("turns"), 256).alias("turns_sha256"),
                      F.char_length(joined("targets")).cast("long").alias("loss_chars"),
                      F.sha2(joined("targets"), 256).alias("loss_sha256"), "formatted_chars", "n_windows")
