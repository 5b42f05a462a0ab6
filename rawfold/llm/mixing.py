"""Mixing sources to target weights by entropy balancing. Only DataFrame functions.

Targets: a source's share of all words goes by its weight, at most ``cap`` times its own words; what is
above is shared again by weight until none is above (one water level over the sources).

Rates: for each source the rates nearest to 1 in relative entropy, at most ``cap``, whose words sum to
the target: ``rate = min(cap, exp(lambda * size / scale))``. ``lambda`` solves the convex dual; each
Newton step is one aggregation over the (source, size, documents) histogram, kept in a bracket so that
it cannot diverge. Documents of one source and size share their rate, so the histogram is all the
iterations read: it is built by one partial aggregate and holds no document.

Copies: rates are rounded systematically in order of size: a (source, size) cell gets
``floor(C_end + u) - floor(C_start + u)`` copies, C being the running sum of rates. Errors of neighbours cancel,
so the words taken miss the target by half the longest document at most; of ``offsets`` values of u
the one nearest to the target is taken, and one copy more or less in one cell closes most of the rest. Inside a cell the copies go round by a hash of the id; a cell
of many documents is dealt over buckets, so no task ranks a hot cell alone.

Defined results: a null text has 0 words; null is a source of its own, last in order; documents of 0
words take 1 copy of 0 words; a source without words has target 0; rows that repeat an id are ranked as
separate documents of equal standing; an empty table gives an empty result; other columns are ignored
(``mix_documents`` keeps them).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rawfold.llm.common import SPACE_WORD, materialize


def water_level(sources: DataFrame, cap: float) -> DataFrame:
    """Adds ``target`` to (sid, size_sum, weight). One row per source, so the windows are small.

    With sources in order of cap/weight, the level is the largest of (words left) / (weight left)."""
    total = F.sum("size_sum").over(Window.partitionBy())
    by = Window.partitionBy().orderBy(F.col("__cap") / F.col("weight"), "sid")
    before = F.coalesce(F.sum("__cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    after = F.sum("weight").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    return (sources.withColumn("__cap", F.col("size_sum") * F.lit(float(cap)))
            .withColumn("__mu", (total - before) / after)
            .withColumn("__mu", F.max("__mu").over(Window.partitionBy()))
            .withColumn("target", F.least("__cap", F.col("__mu") * F.col("weight")))
            .drop("__cap", "__mu"))


def _rate(cap: float):
    return (F.when(F.col("full") & (F.col("size") > 0), F.lit(float(cap)))
            .otherwise(F.exp(F.least(F.col("lam") * F.col("z"), F.lit(math.log(cap))))))


def solve_dual(hist: DataFrame, sources: DataFrame, cap: float, *, tol: float = 1e-9,
               max_iter: int = 80) -> DataFrame:
    """sources (sid, size_sum, target) -> with ``lam`` and ``full`` (every document at the cap).

    Distributed Newton steps: gradient and curvature of all sources in one aggregation each."""
    full = (F.col("target") >= F.col("size_sum") * cap * (1 - 1e-12)) & (F.col("size_sum") > 0)
    state = sources.withColumns({
        "full": full, "done": full | (F.col("target") <= 0),
        "lam": F.when(full | (F.col("target") <= 0), F.lit(0.0)).otherwise(F.log(F.col("target") / F.col("size_sum"))),
        "lo": F.lit(float("-inf")), "hi": F.lit(float("inf"))})
    state = materialize(state, "mix-state")
    for _ in range(max_iter):
        if state.filter("not done").isEmpty():
            break
        r = _rate(cap)
        words = F.col("n") * F.col("size")
        sums = (hist.join(state.filter("not done").select("sid", "lam", "full"), "sid")
                .groupBy("sid").agg(F.sum(words * r).alias("got"),
                                    F.sum(F.when(r < cap, words * F.col("z") * r).otherwise(0.0)).alias("curve")))
        g = F.col("got") - F.col("target")
        lo = F.when(g < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(g < 0, F.col("hi")).otherwise(F.col("lam"))
        step = F.col("lam") - g / F.col("curve")
        inside = (F.col("curve") > 0) & (step > F.col("lo2")) & (step < F.col("hi2"))
        spread = F.greatest(F.abs("lam"), F.lit(1.0))
        halved = (F.when(F.col("hi2") == float("inf"), F.col("lam") + spread)
                  .when(F.col("lo2") == float("-inf"), F.col("lam") - spread)
                  .otherwise((F.col("lo2") + F.col("hi2")) / 2))
        done = (F.abs(g) <= F.col("target") * tol) | (F.col("hi2") - F.col("lo2") <= F.abs("lam") * 1e-15)
        state = materialize(
            state.join(sums, "sid", "left").withColumns({"lo2": lo, "hi2": hi})
            .withColumn("stop", F.col("done") | done)
            .withColumn("lam", F.when(F.col("stop"), F.col("lam")).when(inside, step).otherwise(halved))
            .select("sid", "source", "size_sum", "weight", "target", "full", F.col("stop").alias("done"), "lam",
                    F.when(F.col("done"), F.col("lo")).otherwise(F.col("lo2")).alias("lo"),
                    F.when(F.col("done"), F.col("hi")).otherwise(F.col("hi2")).alias("hi")), "mix-state")
    return state


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                weights: Sequence[float] = (5, 2, 1), cap: int = 3, offsets: int = 32,
                bucket_rows: int = 256) -> DataFrame:
    """One row per document: ``doc_id, source, size, source_size, target, rate, copies, taken``.

    ``weights`` go to the sources in code point order (null last), repeating. ``cap`` is a whole number.
    """
    if cap != int(cap) or cap < 1 or not weights or min(weights) <= 0:
        raise ValueError("cap must be a whole number of at least 1 and weights positive")
    spark = docs.sparkSession
    slim = materialize(docs.select(
        F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(f"`{text_col}`"), F.lit(SPACE_WORD)), F.lit(0)).cast("long").alias("size")),
        "mix-sizes")
    cells = slim.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))

    sources = cells.groupBy("source").agg(
        F.sum(F.col("n") * F.col("size")).alias("size_sum"),
        F.sum(F.col("n") * F.col("size").cast("double") * F.col("size")).alias("squares"))
    order = Window.partitionBy().orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    sources = (sources.withColumn("sid", F.row_number().over(order) - 1)
               .withColumn("weight", F.get(cycle, F.col("sid") % len(weights)))
               .withColumn("scale", F.when(F.col("size_sum") > 0, F.col("squares") / F.col("size_sum"))
                           .otherwise(F.lit(1.0))).drop("squares"))
    sources = materialize(water_level(sources, cap), "mix-sources")

    hist = materialize(
        cells.join(sources.select("sid", F.col("source").alias("s2"), "scale"), F.col("source").eqNullSafe(F.col("s2")))
        .select("sid", "source", "size", "n", (F.col("size") / F.col("scale")).alias("z")), "mix-cells")
    state = solve_dual(hist, sources.drop("scale"), cap)

    # systematic rounding in order of size
    by_size = Window.partitionBy("sid").orderBy("size")
    run = (hist.join(state.select("sid", "lam", "full", "target", "size_sum"), "sid").withColumn("rate", _rate(cap))
           .withColumn("end", F.sum(F.col("n") * F.col("rate")).over(
               by_size.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
           .withColumn("start", F.coalesce(F.lag("end").over(by_size), F.lit(0.0))))

    def cell_copies(u):
        return F.least((F.floor(F.col("end") + u) - F.floor(F.col("start") + u)).cast("long"), F.col("n") * int(cap))

    us = [(j + 0.5) / offsets for j in range(offsets)]
    misses = run.groupBy("sid", "target").agg(*[F.sum(F.col("size") * cell_copies(F.lit(u))).alias(f"t{j}")
                                                for j, u in enumerate(us)])
    nearest = misses.select("sid", F.array_min(F.array(*[
        F.struct(F.abs(F.col(f"t{j}") - F.col("target")), F.lit(u).alias("u")) for j, u in enumerate(us)]))["u"].alias("u"))
    rounded = materialize(run.join(nearest, "sid").withColumn("total", cell_copies(F.col("u")))
                          .select("sid", "source", "size", "n", "rate", "target", "size_sum", "total"), "mix-rounded")

    # what is still missing (or too much) is met best by one copy more (or less) in the cell of the nearest size
    off = rounded.groupBy("sid").agg((F.sum(F.col("size") * F.col("total")) - F.first("target")).alias("off"))
    one = F.when(F.col("off") > 0, -1).otherwise(1)
    free = F.when(F.col("off") > 0, F.col("total") > 0).otherwise(F.col("total") < F.col("n") * int(cap))
    fix = (rounded.join(off, "sid").filter(free)
           .withColumn("left", F.abs(F.col("off") + one * F.col("size")))
           .filter(F.col("left") < F.abs("off")).groupBy("sid")
           .agg(F.min(F.struct("left", "size", one.alias("one"))).alias("best"))
           .select("sid", F.col("best.size").alias("fix_size"), F.col("best.one").alias("one")))
    total = F.col("total") + F.when(F.col("size") == F.col("fix_size"), F.col("one")).otherwise(0)
    plan = materialize(
        rounded.join(fix, "sid", "left").withColumn("total", total)
        .select("sid", F.col("source").alias("s2"), F.col("size").alias("size2"), "n", "rate", "target",
                F.col("size_sum").alias("source_size"), F.floor(F.col("total") / F.col("n")).cast("long").alias("base"),
                (F.col("total") % F.col("n")).alias("rest"),
                F.ceil(F.col("n") / bucket_rows).cast("int").alias("buckets")), "mix-plan")

    rows = (slim.join(plan, F.col("source").eqNullSafe(F.col("s2")) & (F.col("size") == F.col("size2")))
            .drop("s2", "size2")
            .withColumn("bucket", F.pmod(F.xxhash64("id"), F.col("buckets")).cast("int")))
    rows = materialize(rows, "mix-rows")

    # documents of a cell that take one copy more: by rank inside a bucket
    ranked = rows.filter("rest > 0")
    cell = ["sid", "size"]
    in_cell = Window.partitionBy(*cell).orderBy("bucket")
    share = (ranked.groupBy(*cell, "bucket", "n", "rest").agg(F.count(F.lit(1)).alias("m"))
             .withColumn("upto", F.sum("m").over(in_cell.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
             .withColumn("a", F.floor(F.col("rest") * (F.col("upto") / F.col("n"))).cast("long"))
             .withColumn("extra", F.col("a") - F.coalesce(F.lag("a").over(in_cell), F.lit(0)))
             .select(*cell, "bucket", "extra"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*cell, "bucket"]
    by_hash = Window.partitionBy(*keys).orderBy(F.xxhash64(F.lit(1), "id"), "id")
    ranked = (ranked.repartition(parts, *keys).withColumn("rank", F.row_number().over(by_hash))
              .join(share.repartition(parts, *keys), keys)
              .withColumn("copies", F.col("base") + (F.col("rank") <= F.col("extra")).cast("long")))
    out = [F.col("id").alias(id_col), F.col("source"), F.col("size"), F.col("source_size"), F.col("target"),
           F.col("rate"), F.col("copies"), (F.col("copies") * F.col("size")).alias("taken")]
    even = rows.filter("rest = 0").withColumn("copies", F.col("base"))
    return even.select(*out).unionByName(ranked.select(*out))


def mix_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  **options) -> DataFrame:
    """The mix itself: the rows of ``docs``, each as often as its copies say (0 drops it).

    Rows are told apart by id and a hash of all their columns; rows equal in both are one row that is
    repeated as often as all of them together."""
    names = docs.columns
    keyed = docs.withColumn("__row", F.xxhash64(*[F.col(f"`{c}`") for c in names]))
    slim = keyed.select(F.struct(F.col(f"`{id_col}`").alias("id"), "__row").alias("__key"),
                        F.col(f"`{text_col}`").alias("text"), F.col(f"`{source_col}`").alias("source"))
    mixed = mix_sources(slim, id_col="__key", **options)
    copies = mixed.groupBy(F.col("__key.__row").alias("r2"), F.col("__key.id").alias("id2")).agg(
        F.sum("copies").alias("__copies")).filter("__copies > 0")
    once = keyed.dropDuplicates(["__row", id_col])
    return (once.join(copies, (F.col("__row") == F.col("r2")) & F.col(f"`{id_col}`").eqNullSafe(F.col("id2")))
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in names]))
