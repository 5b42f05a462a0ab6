"""Keep the newest version of every business key (top-1 per group) and sequence numbers.

Two semantics exist in the staging recipe:

* ``ties=True``  - ``dense_rank() ... = 1``: every row of the newest batch of a key survives.
* ``ties=False`` - ``row_number() ... = 1``: exactly one row per key; tie-breaker columns, then a hash of all
  columns, make the choice repeatable.

Plans that survive a hot key (one key holding a large share of all rows):

* ties=True: ``max(order)`` per key is a partial (map-side) aggregate, so a hot key ships one row
  per map task; the rows then meet their key's maximum in an INNER join on (key, order). Maxima are
  unique per key, so rows cannot multiply, and unlike a semi-join the optimizer does not copy it into every arm
  of the union below: N relations are scanned 2N times. AQE broadcasts small maxima and splits
  skewed partitions, so no task ever needs all rows of one key.
* ties=False: ``row_number`` in a window; Catalyst puts a ``WindowGroupLimit`` before the shuffle, so a hot key
  ships one row per map task.

``strategy="window"`` gives the textbook ``dense_rank`` window + filter plan for ``ties=True`` too, for comparison.

``strategy="split"`` (``ties=True``) is for wide rows: the join above shuffles every version of a key with all its columns, the window only
those that are newest in their map task, but it holds the newest rows of a key in one task. So rows are counted per (key, order)
first, by partial aggregates over those columns; keys with more than ``large`` rows in one batch, if any, go through the join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _orderable(dt: T.DataType) -> bool:
    if isinstance(dt, T.MapType):
        return False
    if isinstance(dt, T.StructType):
        return all(_orderable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _orderable(dt.elementType)
    return True


#: columns that differ between runs over the same rows, and the merge's own
_VOLATILE = ("_last_updated", "_run_id")


def remaining_order(df: DataFrame) -> list[Column]:
    """Every lasting column that can be ordered: the last tie-break, so that equal rows alone are interchangeable."""
    return [F.col(f"`{f.name}`") for f in df.schema.fields
            if _orderable(f.dataType) and f.name not in _VOLATILE and not f.name.startswith("__")]


def row_hash(df: DataFrame) -> Column:
    """64-bit hash of the same columns: a last tie-break that can be stored."""
    return F.xxhash64(*remaining_order(df))


def keep_latest(df: DataFrame, keys: Sequence, order: Sequence, *, ties: bool = True,
                tiebreak: Sequence = (), strategy: str = "auto", large: int = 1_000_000) -> DataFrame:
    """Rows ranked first per ``keys`` by ``order`` (all descending, NULLs last).

    ``keys`` and ``order`` are column names or Column expressions (``coalesce(id, 0)``).
    NULL keys form one group, as in a window ``PARTITION BY``. Tie-breakers also rank descending.
    ``strategy="split"`` counts rows here, so it runs a job; ``large`` is its bound on rows of one key and batch.
    """
    keys, order, tiebreak = list(keys), list(order), list(tiebreak)
    if not order:
        raise ValueError("keep_latest needs at least one order column")
    if strategy == "window" or not ties:
        return _window(df, keys, order, ties, tiebreak)
    if strategy == "split":
        return _split(df, keys, order, large)

    cols = df.columns
    kn = [f"__lk{i}" for i in range(len(keys))]
    on = [f"__lo{i}" for i in range(len(order))]
    d = df.withColumns({**{n: _col(k) for n, k in zip(kn, keys)}, **{n: _col(o) for n, o in zip(on, order)}})
    ostruct = F.struct(*on) if len(on) > 1 else F.col(on[0])
    maxes = (d.groupBy(*kn).agg(F.max(ostruct).alias("__lmax"))
             .select(*[F.col(n).alias(n + "m") for n in kn], "__lmax"))
    probe = F.struct(*[d[o] for o in on]) if len(on) > 1 else d[on[0]]
    nullable = {f.name: f.nullable for f in d.schema.fields}

    def same(left, right, name):  # NULL keys form one group; plain equality when none can occur
        return left.eqNullSafe(right) if nullable.get(name, True) else left == right

    cond = [same(d[n], maxes[n + "m"], n) for n in kn]
    cond.append(same(probe, maxes["__lmax"], on[0] if len(on) == 1 else "__struct"))
    return d.join(maxes, cond, "inner").select(*[F.col(f"`{c}`") for c in cols])


def _window(df: DataFrame, keys, order, ties, tiebreak) -> DataFrame:
    by = [_col(o) for o in order] + ([] if ties else [*[_col(t) for t in tiebreak], row_hash(df)])
    w = Window.partitionBy(*[_col(k) for k in keys]).orderBy(*[c.desc_nulls_last() for c in by])
    fn = F.dense_rank() if ties else F.row_number()
    return df.withColumn("__lrank", fn.over(w)).filter(F.col("__lrank") == 1).drop("__lrank")


def _split(df: DataFrame, keys, order, large: int) -> DataFrame:
    """The window for all keys but those with more than ``large`` rows of one order, which go through the join."""
    from rawfold.session import scratch_path, shuffles_released
    spark = df.sparkSession
    kn, on = [f"__hk{i}" for i in range(len(keys))], [f"__ho{i}" for i in range(len(order))]
    d = df.withColumns({n: _col(c) for n, c in zip(kn + on, keys + order)})
    path = scratch_path(spark, "hot")
    with shuffles_released(spark):
        hot = (d.groupBy(*kn, *on).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > large)
               .select(*[F.col(n).alias(n + "b") for n in kn]).distinct())
        hot.write.parquet(path)
    hot = spark.read.schema(hot.schema).parquet(path)
    if hot.isEmpty():
        return _window(df, keys, order, True, [])
    cond = [d[n].eqNullSafe(hot[n + "b"]) for n in kn]
    small, rest = (d.join(hot, cond, how).select(*[F.col(f"`{c}`") for c in d.columns]) for how in ("left_anti", "left_semi"))
    return _window(small, kn, on, True, []).unionByName(keep_latest(rest, kn, on)).drop(*kn, *on)


def seq_id(df: DataFrame, keys: Sequence, order: Sequence, tiebreak: Sequence = (), name: str = "_seq_id",
           strategy: str = "split", large: int = 1_000_000) -> DataFrame:
    """``row_number() over (partition by keys order by order desc, tiebreak asc, every other column)`` as ``name``.

    After keep-latest every row of a parent shares one batch, so the order column alone does not decide the
    numbering; ordering by all remaining columns last makes it repeatable (only equal rows are interchangeable).

    ``strategy="split"`` uses the ordinary window for every parent of at most ``large`` rows, and gives the rows of a
    larger one out over range partitions (see ``_ranged``), so that no task holds it alone. The plan below is computed once: its rows
    are written to the shared folder, parents are counted from the key columns read back, and the numbering reads the written rows.
    ``"counted"`` is the same for rows that are stored already, without writing them again. All ways give the same
    numbers; ``"window"`` and ``"ranged"`` force one of them.
    """
    if strategy not in ("split", "counted", "window", "ranged"):
        raise ValueError(f"unknown seq_id strategy {strategy!r}")
    if strategy == "window":
        return _numbered(df, keys, order, tiebreak, name)
    if strategy == "ranged":
        return _ranged(df, keys, order, tiebreak, name)
    from rawfold.session import scratch_path, shared_dir, shuffles_released
    shared_dir(df.sparkSession)
    kn = [f"__sk{i}" for i in range(len(keys))]
    d = df.withColumns({n: _col(k) for n, k in zip(kn, keys)})
    if strategy == "split":
        path = scratch_path(df.sparkSession, "unnumbered")
        with shuffles_released(df.sparkSession):  # else they stay beside the rows written and those shuffled to be numbered
            d.write.parquet(path)
        d = df.sparkSession.read.schema(d.schema).parquet(path)
    big = (d.groupBy(*kn).agg(F.count(F.lit(1)).alias("__n")).filter(F.col("__n") > large)
           .select(*[F.col(n).alias(n + "b") for n in kn])).checkpoint(eager=True)
    if big.isEmpty():
        return _numbered(d, kn, order, tiebreak, name).drop(*kn)
    cond = [d[n].eqNullSafe(big[n + "b"]) for n in kn]
    small, rest = (d.join(big, cond, how).select(*[F.col(f"`{c}`") for c in d.columns]) for how in ("left_anti", "left_semi"))
    return _numbered(small, kn, order, tiebreak, name).unionByName(_ranged(rest, kn, order, tiebreak, name)).drop(*kn)


def _sort_columns(df: DataFrame, keys, order, tiebreak) -> list[Column]:
    return ([_col(o).desc_nulls_last() for o in order] + [_col(t).asc_nulls_first() for t in tiebreak]
            + [c.asc_nulls_first() for c in remaining_order(df)])


def _numbered(df: DataFrame, keys, order, tiebreak, name) -> DataFrame:
    w = Window.partitionBy(*[_col(k) for k in keys]).orderBy(*_sort_columns(df, keys, order, tiebreak))
    return df.withColumn(name, F.row_number().over(w))


def _ranged(df: DataFrame, keys, order, tiebreak, name) -> DataFrame:
    """The same numbers without putting a parent's rows into one task.

    Rows are range-partitioned on (keys, order, tiebreak, all other columns) (sampled bounds split a large parent over
    several tasks), sorted, and checkpointed to the shared folder so that partition ids and positions are fixed. A row's
    number is its position in its own partition plus its parent's rows in earlier ones."""
    from rawfold.session import shared_dir
    shared_dir(df.sparkSession)
    cols = df.columns
    kn = [f"__pk{i}" for i in range(len(keys))]
    d = df.withColumns({n: _col(k) for n, k in zip(kn, keys)})
    sort = [F.col(k).asc_nulls_first() for k in kn] + _sort_columns(df, keys, order, tiebreak)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    r = (d.repartitionByRange(parts, *sort).sortWithinPartitions(*sort)
         .withColumns({"__spid": F.spark_partition_id(), "__spos": F.monotonically_increasing_id()})
         .withColumn("__skey", F.struct(*kn)).drop(*kn).checkpoint(eager=True))
    firsts = r.groupBy("__skey", "__spid").agg(F.min("__spos").alias("__sfirst"), F.count(F.lit(1)).alias("__scnt"))
    before = Window.partitionBy("__skey").orderBy("__spid").rowsBetween(Window.unboundedPreceding, -1)
    offs = firsts.withColumn("__soff", F.coalesce(F.sum("__scnt").over(before), F.lit(0))).drop("__scnt")
    out = r.join(offs, ["__skey", "__spid"])
    return out.select(*[F.col(f"`{c}`") for c in cols],
                      (F.col("__soff") + (F.col("__spos") - F.col("__sfirst")) + 1).alias(name))
