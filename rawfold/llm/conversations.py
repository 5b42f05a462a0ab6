"""Conversation structure repair: the cheapest edits that make the turns read ``(system? (user assistant)+)?``.

A row is kept (0), given the role user or assistant (3) or deleted (4; blank and duplicate rows must be), and empty user or
assistant turns are inserted anywhere (3 each); a truncated row that stays adds 3. Of all cheapest edits the
one whose initials (D, I, K, R) are least in ASCII order is chosen.

Method: Four-Russians block tables. A row is one of nine symbols (role s, u, a or other, each clean or truncated; or
"must go"). For every place between rows there is a cost vector: the least cost of repairing what follows, from each of the four
states (start, after s, after u, after a). Less its minimum such a vector is one of a few dozen, so the step over any
block of ``BLOCK`` symbols is a table entry (vector, block) -> (vector, cost added), computed beforehand for all blocks. A chunk of
rows is walked from its end by lookups, a block at a time; then each block is expanded backward into the vectors of its
rows, and the edits are read off forward, in each state the least letter that lies on a cheapest path (a letter fixes
the next state, so this is the least string).

Conversations are dealt out as chunks of at most ``chunk_rows`` rows, so no task holds a long one: a chunk's costs between any two
states compose, only these go by conversation, and edits go back to the rows by position. ``edits`` has a row for each edit.

Defined results: null role or text is one space; rows are in order of turn (null first), then role, text; turns are whole
numbers or null; null is a conversation of its own; a role's symbol is its first character, an empty role or any other
character is a role that cannot be kept; repeated rows are duplicates; an empty table gives no edit and no figure; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.llm.common import bounded_batches, materialize

BLOCK, CHUNK = 4, 4096
SYMBOLS, MUST_GO = 9, 8  # role + 4 * truncated, or MUST_GO
START, AFTER_S, AFTER_U, AFTER_A = range(4)
INF = 1 << 20
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
ROLES = "sua"
#: state after a turn of a role (s, u, a, other) from each state; None: not allowed there
_NEXT = ((AFTER_S, AFTER_U, None, None), (None, AFTER_U, None, None), (None, None, AFTER_A, None), (None, AFTER_U, None, None))
#: the one role (number) that can be put in from each state: every state allows either u or a
_PUT = (1, 1, 2, 1)
BLANKS = "\t\n\x0b\x0c\r "


def _inserted(v: list[int]) -> tuple[int, ...]:
    """Cost vector when turns may be inserted first."""
    for _ in range(3):
        v = [min(v[q], INSERT + v[_NEXT[q][_PUT[q]]]) for q in range(4)]
    return tuple(min(x, INF) for x in v)


def _options(after: tuple[int, ...], symbol: int, q: int) -> list[tuple[str, int, int, int | None]]:
    """(letter, cost with what follows, next state, role put) of the edits of one row in state q."""
    out = [("D", DELETE + after[q], q, None)]
    if symbol != MUST_GO:
        role, more = symbol % 4, TRUNCATED * (symbol // 4)
        if _NEXT[q][role] is not None:
            out.append(("K", KEEP + more + after[_NEXT[q][role]], _NEXT[q][role], role))
        out.append(("R", REROLE + more + after[_NEXT[q][_PUT[q]]], _NEXT[q][_PUT[q]], _PUT[q]))
    return out


def _before(after: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    return _inserted([min(o[1] for o in _options(after, symbol, q)) for q in range(4)])


#: cost of ending in any whole conversation, and of ending in one given state
ACCEPT = _inserted([0, INF, INF, 0])
_TARGETS = [_inserted([0 if p == q else INF for p in range(4)]) for q in range(4)]


def _normal(v: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    low = min(v)
    return tuple(min(x - low, INF) if x < INF else INF for x in v), low


@dataclass(frozen=True)
class Tables:
    """``step[v, x]``, ``cost[v, x]``: vector before symbol x and v, and cost added; ``block_*`` the same for blocks.

    ``edits[v][x][q]``: initials, roles put and next state of what is done in state q with x before v."""

    vectors: list
    ids: dict
    step: np.ndarray
    cost: np.ndarray
    block_step: np.ndarray
    block_cost: np.ndarray
    edits: list


@lru_cache(maxsize=1)
def tables() -> Tables:
    """All reachable vectors, their single steps, and by composing these the steps over every block of ``BLOCK`` symbols."""
    vectors, ids, step, cost = [], {}, [], []

    def number(v: tuple[int, ...]) -> int:
        if v not in ids:
            ids[v] = len(vectors)
            vectors.append(v)
        return ids[v]

    for v in [ACCEPT, *_TARGETS]:
        number(_normal(v)[0])
    for v in vectors:  # grows while it is walked
        found = [_normal(_before(v, x)) for x in range(SYMBOLS)]
        step.append([number(f[0]) for f in found])
        cost.append([f[1] for f in found])
    step, cost = np.array(step), np.array(cost)
    block_step, block_cost = step, cost
    for _ in range(BLOCK - 1):  # one more symbol in front: its number is the lowest digit
        block_cost = (block_cost[:, :, None] + cost[block_step]).reshape(len(vectors), -1)
        block_step = step[block_step].reshape(len(vectors), -1)
    edits = [[[_decide(vectors, step, cost, v, x, q) for q in range(4)] for x in range(SYMBOLS)] for v in range(len(vectors))]
    return Tables(vectors, ids, step, cost, block_step, block_cost, edits)


def _decide(vectors, step, cost, v: int, x: int, q: int) -> tuple[str, str, int]:
    """The least letters on a cheapest path from state q over symbol x: inserts, then one edit of the row."""
    here, after, base = vectors[step[v][x]], vectors[v], int(cost[v][x])
    letters, put = "", ""
    while here[q] < INF:
        best = min((o for o in _options(after, x, q) if o[1] == base + here[q]), default=None)  # least letter
        inserting = INSERT + here[_NEXT[q][_PUT[q]]] == here[q]
        if best and not (inserting and best[0] > "I"):
            return letters + best[0], put + ("-" if best[3] is None else ROLES[best[3]]), best[2]
        letters, put, q = letters + "I", put + ROLES[_PUT[q]], _NEXT[q][_PUT[q]]
    return letters, put, q  # cannot be reached


def _tail(q: int) -> tuple[str, str]:
    put = ""
    while q not in (START, AFTER_A):
        put, q = put + ROLES[_PUT[q]], _NEXT[q][_PUT[q]]
    return "I" * len(put), put


def walk_back(symbols: np.ndarray, v: int) -> tuple[int, int, list[int]]:
    """Vector before the symbols, cost added, and the vectors after each block (last first), starting from vector v after
    them. What does not fill a block at the end goes by single steps."""
    t, total, after = tables(), 0, [v]
    full = len(symbols) // BLOCK * BLOCK
    for x in symbols[full:][::-1]:
        total += int(t.cost[v, x])
        v = int(t.step[v, x])
    after.append(v)
    weights = SYMBOLS ** np.arange(BLOCK - 1, -1, -1)
    # a block's number has its last symbol as the highest digit, its first as the lowest
    codes = symbols[:full].reshape(-1, BLOCK)[:, ::-1] @ weights
    for code in codes[::-1]:
        total += int(t.block_cost[v, code])
        v = int(t.block_step[v, code])
        after.append(v)
    return v, total, after


def read_forward(symbols: np.ndarray, v: int, q: int) -> tuple[list[str], list[str], int]:
    """Per symbol the edits' initials and the roles put, and the state after the last, from state q before the first and vector v
    after the last: every block is expanded backward from the vector after it."""
    t = tables()
    _, _, after = walk_back(symbols, v)
    full = len(symbols) // BLOCK * BLOCK
    starts = [*range(0, full, BLOCK), *([full] if full < len(symbols) else [])]
    ends = [*after[1:][::-1][1:], *([v] if full < len(symbols) else [])]  # vectors after each of these runs
    letters, put = [], []
    for start, end in zip(starts, ends):
        run = symbols[start:start + BLOCK] if start < full else symbols[full:]
        inner = [end]
        for x in run[::-1]:
            inner.append(int(t.step[inner[-1], x]))
        for x, w in zip(run, inner[::-1][1:]):
            e, p, q = t.edits[w][x][q]
            letters.append(e)
            put.append(p)
    return letters, put, q


# --- Spark ----------------------------------------------------------------------------------------

def _code(role: Column, text: Column) -> Column:
    """Role's number + 4 * (1 truncated, 2 blank)."""
    first = F.substring(role, 1, 1)
    number = F.when(first == "s", 0).when(first == "u", 1).when(first == "a", 2).otherwise(3)
    end = F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))
    return (number + F.when(end == "", 8).when(end.isin(".", "!", "?"), 0).otherwise(4)).cast("int")


_FIGURES = ("n", "blank", "duplicate", "truncated", "illegal", "head", "tail")


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, entries of (at, code); code -1 marks a position as the first of its role and text) -> figures, symbols and
    the costs between any two states."""
    t = tables()
    targets = [t.ids[_normal(v)[0]] for v in _TARGETS]
    for b in batches:
        out = []
        for entries in b.column("entries"):
            flat = entries.values
            at, code = flat.field("at").to_numpy(zero_copy_only=False), flat.field("code").to_numpy(zero_copy_only=False)
            firsts, rows = at[code < 0], code >= 0
            at, code = at[rows], code[rows]
            order = np.argsort(at)
            at, code = at[order], code[order]
            blank = code >= 8
            twice = ~blank & ~np.isin(at, firsts)
            gone = blank | twice
            symbols = np.where(gone, MUST_GO, code).astype(np.int64)
            role = code % 4
            illegal = int((~_legal(role[:-1], role[1:])).sum())
            costs = []
            for target in targets:
                v, total, _ = walk_back(symbols, target)
                costs += [min(int(x) + total, INF) for x in t.vectors[v]]
            out.append((int(at[0]), len(at), int(blank.sum()), int(twice.sum()), int((~gone & (code >= 4)).sum()), illegal,
                        int(role[0]), int(role[-1]), symbols.astype(np.uint8).tobytes(), costs))
        names = ["first", *_FIGURES, "symbols", "costs"]
        types = [pa.int64()] * 8 + [pa.binary(), pa.list_(pa.int64())]
        columns = zip(*out) if out else [()] * len(names)
        yield pa.RecordBatch.from_arrays([b.column("conv"), *[pa.array(c, y) for c, y in zip(columns, types)]], ["conv", *names])


def _legal(a, b):
    """Adjacent roles su, ua or au."""
    return ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, chunks without their symbols) -> per chunk the vector after it; the conversation's figures on its first chunk."""
    t = tables()
    for b in batches:
        convs, out = [], []
        for i, chunks in enumerate(b.column("chunks")):
            chunks = sorted(chunks.as_py(), key=lambda c: c["first"])
            v, afters = 0, []  # 0 is ACCEPT
            cost = 0
            for c in chunks[::-1]:
                afters.append(v)
                after = t.vectors[v]
                before = tuple(min(c["costs"][4 * q + p] + after[q] for q in range(4)) for p in range(4))
                v, more = _normal(tuple(min(x, INF) for x in before))
                cost += more
                v = t.ids[v]
            cost += t.vectors[v][START]
            sums = [sum(c[k] for c in chunks) for k in _FIGURES[1:4]]
            illegal = sum(c["illegal"] for c in chunks) + sum(
                not _legal(a["tail"], c["head"]) for a, c in zip(chunks, chunks[1:]))
            for j, (c, after) in enumerate(zip(chunks, afters[::-1])):
                figures = [*sums, illegal, cost] if j == 0 else [None] * 5
                out.append((c["first"], after, j == len(chunks) - 1, len(chunks), *figures))
                convs.append(i)
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int64()] + [pa.int64()] * 5
        columns = zip(*out) if out else [()] * len(types)
        yield pa.RecordBatch.from_arrays([b.column("conv").take(pa.array(convs, pa.int64())),
                                          *[pa.array(c, y) for c, y in zip(columns, types)]],
                                         ["conv", "first", "after", "last", "pieces", "blank", "duplicate", "truncated", "illegal", "cost"])


def _moves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(conv, first, symbols, after) -> the state after a chunk from each state before it."""
    for b in batches:
        moves = [[read_forward(np.frombuffer(s.as_py(), np.uint8).astype(np.int64), v.as_py(), q)[2] for q in range(4)]
                 for s, v in zip(b.column("symbols"), b.column("after"))]
        yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("first"), pa.array(moves, pa.list_(pa.int64()))],
                                         ["conv", "first", "moves"])


def _edits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(first, symbols, after, last, state) -> per row its position, edits' initials and roles put."""
    for b in batches:
        at, edits, roles = [], [], []
        for first, s, v, last, q in zip(*(b.column(c) for c in ("first", "symbols", "after", "last", "state"))):
            letters, put, end = read_forward(np.frombuffer(s.as_py(), np.uint8).astype(np.int64), v.as_py(), q.as_py())
            if last.as_py():
                more = _tail(end)
                letters[-1], put[-1] = letters[-1] + more[0], put[-1] + more[1]
            at.extend(range(first.as_py(), first.as_py() + len(letters)))
            edits.extend(letters)
            roles.extend(put)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(edits, pa.string()), pa.array(roles, pa.string())],
                                         ["at", "edits", "roles"])


@dataclass(frozen=True)
class Repair:
    """``edits``: conv, at, k, edit, role, text in order of (at, k), role and text of what is in the repaired conversation
    (null for D). ``figures``: conv, gaps, blank, duplicate, truncated, illegal, cost."""

    edits: DataFrame
    figures: DataFrame


def repair(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", chunk_rows: int = CHUNK) -> Repair:
    spark = turns.sparkSession
    bounded_batches(spark)
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                        text(role_col).alias("role"), text(text_col).alias("text"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "same"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # equal rows are dealt out too; a conversation's rows are neighbours, and positions grow with its turns
    ranged = materialize(rows.withColumn("same", F.monotonically_increasing_id()).repartitionByRange(parts, *order)
                         .sortWithinPartitions(*order).drop("same")
                         .withColumn("at", F.monotonically_increasing_id()), "conversation-rows")

    # rows and the first position of every (role, text) meet in chunks of bounded size
    chunk = F.floor(F.col("at") / chunk_rows)
    entry = lambda code: F.struct("at", code.alias("code"))
    code = _code(F.col("role"), F.col("text"))
    said = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"), 256)
    firsts = ranged.groupBy("conv", F.unhex(said).alias("said")).agg(F.min("at").alias("at"))
    entries = (ranged.select("conv", chunk.alias("chunk"), entry(code).alias("e"))
               .unionByName(firsts.select("conv", chunk.alias("chunk"), entry(F.lit(-1)).alias("e"))))
    conv = ranged.schema["conv"]
    schema = T.StructType([conv, T.StructField("first", T.LongType()), *[T.StructField(c, T.LongType()) for c in _FIGURES],
                           T.StructField("symbols", T.BinaryType()), T.StructField("costs", T.ArrayType(T.LongType()))])
    chunks = materialize(entries.groupBy("conv", "chunk").agg(F.collect_list("e").alias("entries")).select("conv", "entries")
                         .mapInArrow(_chunks, schema), "conversation-chunks")

    # by conversation: one row of costs for every chunk of its rows
    named = ["first", "after", "last", "pieces", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([conv, *[T.StructField(c, T.BooleanType() if c == "last" else T.LongType()) for c in named]])
    ends = materialize(chunks.groupBy("conv").agg(F.collect_list(F.struct("first", *_FIGURES, "costs")).alias("chunks"))
                       .mapInArrow(_ends, schema), "conversation-ends")
    traced = chunks.select("first", "symbols").join(ends.select("conv", "first", "after", "last", "pieces"), "first")
    schema = T.StructType([conv, T.StructField("first", T.LongType()), T.StructField("moves", T.ArrayType(T.LongType()))])
    moves = traced.filter("pieces > 1").select("conv", "first", "symbols", "after").mapInArrow(_moves, schema)
    # state before each chunk: the moves of the chunks before it, one after the other
    path = moves.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("first", "moves"))).alias("all"))
    step = lambda acc, x: F.concat(acc, F.array(F.get(x["moves"], F.element_at(acc, -1).cast("int"))))
    path = path.withColumn("states", F.aggregate("all", F.array(F.lit(START).cast("long")), step))
    states = path.select(F.posexplode("all").alias("i", "c"), "states").select(
        F.col("c.first").alias("first"), F.get("states", F.col("i")).alias("state"))
    done = (traced.join(states, "first", "left").select("first", "symbols", "after", "last", F.coalesce("state", F.lit(START)).alias("state"))
            .mapInArrow(_edits, "at long, edits string, roles string"))

    each = ranged.drop("turn").join(done, "at").withColumn("k", F.explode(F.sequence(F.lit(1), F.length("edits"))))
    edit, put = F.substr("edits", F.col("k"), F.lit(1)), F.substr("roles", F.col("k"), F.lit(1))
    name = F.when(put == "u", "user").when(put == "a", "assistant")
    each = each.select(F.col("conv").alias(conv_col), "at", "k", edit.alias("edit"),
                       F.when(edit == "K", F.col("role")).otherwise(name).alias("role"),
                       F.when(edit.isin("K", "R"), F.col("text")).when(edit == "I", F.lit("")).alias("text"))
    spread = ranged.groupBy("conv", "turn").agg(F.lit(1).alias("one")).groupBy(F.col("conv").alias("c")).agg(
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).alias("gaps"))
    figures = ends.filter("cost is not null").join(spread, F.col("conv").eqNullSafe(F.col("c"))).select(
        F.col("conv").alias(conv_col), "gaps", *named[4:])
    return Repair(each, figures)


def damage(turns: DataFrame, *, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """Faults put into rows by crc32 of ``conv:turn`` modulo 20 (nulls are one space): 0 drops the row, 1 empties its text, 2 removes
    its ``[.!?]``, 3 repeats it, 4 sets the role user."""
    space = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space(conv_col), F.lit(":"), space(turn_col)).cast("binary")) % 20
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv"), F.col(f"`{turn_col}`").alias("turn"), space(role_col).alias("role"),
                        space(text_col).alias("text"), kind.alias("kind")).filter("kind != 0")
    rows = rows.withColumn("copy", F.explode(F.array_repeat(F.lit(0), F.when(F.col("kind") == 3, 2).otherwise(1))))
    body = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return rows.select(F.col("conv").alias(conv_col), F.col("turn").alias(turn_col),
                       F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias(role_col), body.alias(text_col))


def repair_digest(r: Repair, conversations: DataFrame, *, conv_col: str = "conv_id") -> DataFrame:
    """One row per conversation of ``conversations``: figures, the edits' initials and the digest of the repaired turns. A digest of
    a whole conversation needs its text in one row; the edits themselves do not."""
    line = F.when(F.col("edit") != "D", F.concat("role", F.lit(":"), "text"))
    whole = r.edits.groupBy(conv_col).agg(F.array_sort(F.collect_list(F.struct("at", "k", "edit", line.alias("line")))).alias("all"))
    whole = whole.select(F.col(conv_col).alias("wc"), F.array_join(F.transform("all", lambda x: x["edit"]), "").alias("audit"),
                         F.array_join(F.transform("all", lambda x: x["line"]), "\n").alias("lines"))
    ids = conversations.select(F.col(f"`{conv_col}`").alias("id")).distinct()
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    out = (ids.join(r.figures.withColumnRenamed(conv_col, "fc"), F.col("id").eqNullSafe(F.col("fc")), "left")
           .join(whole, F.col("id").eqNullSafe(F.col("wc")), "left"))
    return out.select(F.col("id").alias(conv_col), *[zero(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                      F.coalesce("audit", F.lit("")).alias("audit"),
                      F.sha2(F.coalesce("lines", F.lit("")), 256).alias("repaired_sha256"))
