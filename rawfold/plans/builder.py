"""Turn a ``DatasetSpec`` into one DataFrame plan.

    union (per-arm watermark) -> [keep-latest on parents] -> unnest chain -> WHERE
    -> [keep-latest on rows] -> projection (tz, typed defaults, struct stars, picks)
    -> [keep-latest on outputs] -> FX left join -> [row_number after join]
    -> brand / lineage / audit columns -> [_seq_id]

Keep-latest runs on parent rows whenever the spec allows it: the parents (with their nested
arrays) are fewer than the exploded rows, so less data is shuffled for the same result.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.config import (
    BATCH_ID, BATCH_RUNTIME, LAST_UPDATED, RUN_ID, SOURCE_RELATION, USER_ID, Settings,
)
from rawfold.functions.convert import NUMERIC, to_wallclock, typed_default
from rawfold.functions.lineage import brand as brand_expr
from rawfold.functions.lineage import lineage_columns
from rawfold.operators.fx import FX_CURRENCY, FX_RATE, fx_left_join
from rawfold.operators.latest import keep_latest, row_hash, seq_id
from rawfold.operators.nested import drop_nested_fields, prefixed, resolve_type, struct_star, unnest_chain
from rawfold.plans.spec import Col, DatasetSpec, Key, Pick, SStar, Star, Tz
from rawfold.sources.incremental import RANK_KEY, RANK_ORDER, relation_filter
from rawfold.sources.relations import union_relations

DATON = (USER_ID, BATCH_RUNTIME, BATCH_ID)
HIDDEN_FX_DATE, HIDDEN_FX_CUR = "__on_fx_date", "__on_fx_currency"


_NUMERIC_CAST = re.compile(r"\bas\s+numeric\b", re.IGNORECASE)


def _expr(s: str) -> Column:
    """Spark SQL snippet; ``CAST(x AS numeric)`` means decimal(38, 9) as in the source warehouse."""
    return F.expr(_NUMERIC_CAST.sub("AS decimal(38,9)", s))


def projection(f: DataFrame, spec: DatasetSpec, union_cols: Sequence[str],
               settings: Settings) -> list[tuple[str, Column]]:
    """Output ``(name, column)`` pairs of the spec, in order, over the unnested frame ``f``."""
    out: list[tuple[str, Column]] = []
    taken: set[str] = set()

    def add(n: str, c: Column):
        out.append((n, c))
        taken.add(n.lower())

    lineage = {SOURCE_RELATION.lower(), *[d.lower() for d in DATON]}

    def key_source(item: Key) -> Column:
        e = _expr(item.expr)
        return e.cast(NUMERIC if item.cast == "numeric" else item.cast) if item.cast else e

    # one analysis resolves the type of every converted or defaulted source column
    typed = [(i, _expr(it.src) if isinstance(it, Tz) else key_source(it))
             for i, it in enumerate(spec.columns) if isinstance(it, (Tz, Key))]
    types = {}
    if typed:
        schema = f.select(*[c.alias(f"__t{i}") for i, c in typed]).schema
        types = {i: schema[f"__t{i}"].dataType for i, _ in typed}

    for idx, item in enumerate(spec.columns):
        if isinstance(item, Col):
            add(item.name, _expr(item.expr))
        elif isinstance(item, Tz):
            add(item.name, to_wallclock(_expr(item.src), settings, types[idx]))
        elif isinstance(item, Key):
            add(item.name, typed_default(key_source(item), item.default, types[idx]))
        elif isinstance(item, Star):
            skip = {x.lower() for x in item.exclude} | lineage
            for c in union_cols:
                if c.lower() not in skip and c.lower() not in taken:
                    add(c, F.col(f"`{c}`"))
        elif isinstance(item, SStar):
            drops = [e.split(".", 1)[1] for e in spec.nested_excludes
                     if e.split(".")[0].lower() == item.col.lower()]
            for n, c in struct_star(f, item.col, tuple(item.exclude) + tuple(drops), taken=taken):
                add(n, c)
        elif isinstance(item, Pick):
            for n, c in prefixed(f, item.col, item.fields, item.prefix):
                add(n, c)
        else:
            raise TypeError(f"unknown projection item {item!r}")
    return out


def tiebreak_of(spec: DatasetSpec) -> tuple[str, ...]:
    """row_number picks one row: without a spec tie-breaker, batch id then relation make it repeatable."""
    lt = spec.latest
    return lt.tiebreak if (lt is None or lt.ties or lt.tiebreak) else (BATCH_ID, SOURCE_RELATION)


def rank_columns(df: DataFrame, keys: Sequence[str], order: Sequence[str], tiebreak: Sequence[str], ties: bool) -> dict[str, Column]:
    """Rank key (JSON text of its values) and rank order of every row, for later merges."""
    key = F.to_json(F.struct(*[_expr(k).cast("string").alias(f"k{i}") for i, k in enumerate(keys)]))
    by = [_expr(o).alias(f"o{i}") for i, o in enumerate(order)]
    if not ties:
        by += [_expr(t).alias(f"t{i}") for i, t in enumerate(tiebreak)] + [row_hash(df).alias("h")]
    return {RANK_KEY: key, RANK_ORDER: F.struct(*by)}


def parents(spec: DatasetSpec, relations, settings: Settings, *, watermark: int | dict | None = None,
            lookback_ms: int = 0) -> DataFrame:
    """Union of the relations, reduced to the newest parents where the spec ranks parents (all raw columns)."""
    where = relation_filter(watermark, lookback_ms)
    a = union_relations(relations, where=where)
    return _latest(a, spec, settings) if spec.latest and spec.latest.stage == "parent" else a


def rank_keys(spec: DatasetSpec, settings: Settings) -> tuple[str, ...]:
    return tuple(spec.latest.keys) + ((SOURCE_RELATION,) if settings.scope_by_source else ())


def _latest(df: DataFrame, spec: DatasetSpec, settings: Settings, strategy: str = "auto") -> DataFrame:
    lt = spec.latest
    return keep_latest(df, [_expr(k) for k in rank_keys(spec, settings)], [_expr(o) for o in lt.order], ties=lt.ties,
                       tiebreak=[_expr(t) for t in tiebreak_of(spec)], strategy=strategy, large=settings.seq_large)


def unread_fields(df: DataFrame, spec: DatasetSpec, column: str) -> list[str]:
    """Fields of the unnested ``column`` that no part of the spec names; none where it is named as a whole, and one field always stays."""
    name = column.lower()
    exprs = [getattr(c, a) for c in spec.columns for a in ("expr", "src") if hasattr(c, a)]
    exprs += [c.expr for c in spec.extra.get("post_columns", ())]
    steps = [s for s in (*spec.unnest, *spec.extra.get("post_unnest", ())) if s != column]
    exprs += [".".join(s) if isinstance(s, tuple) else s for s in steps]
    exprs += [x for x in (spec.where, *((spec.fx.date, spec.fx.currency) if spec.fx else ())) if x]
    exprs += [*spec.latest.keys, *spec.latest.order, *spec.latest.tiebreak] if spec.latest else []
    for c in spec.columns:
        if isinstance(c, Pick):
            exprs += [f"{c.col}.{f}" for f in c.fields]
        elif isinstance(c, SStar):
            exprs.append(c.col)
        elif isinstance(c, Star) and name not in {e.lower() for e in c.exclude}:
            exprs.append(column)
    named = re.compile(rf"(?<![\w.]){re.escape(name)}\b(?:\.(\w+))?")
    read = {m.group(1) for e in exprs for m in named.finditer(e.lower().replace("`", ""))}
    kind = resolve_type(df, column)
    kind = kind.elementType if isinstance(kind, T.ArrayType) else kind
    if None in read or not isinstance(kind, T.StructType):
        return []
    fields = kind.fieldNames()
    kept = [f for f in fields if f.lower() in read] or fields[:1]
    return [f for f in fields if f not in kept]


def _narrowed(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Without the fields of unnested columns that the dataset does not read, so that they are not shuffled with the parents."""
    for c in spec.unnest:
        if isinstance(c, str) and "." not in c:
            df = drop_nested_fields(df, c, unread_fields(df, spec, c))
    return df


def build(spec: DatasetSpec, relations, settings: Settings, *, fx: DataFrame | None = None,
          watermark: int | dict | None = None, lookback_ms: int = 0, include_audit: bool = True,
          latest_strategy: str = "auto", seq_strategy: str | None = None, carry_rank: bool = False,
          staged: DataFrame | None = None) -> DataFrame:
    """Plan of one dataset over its raw relations (full load when ``watermark`` is None; a mapping has one for each relation).

    ``carry_rank`` adds the rank key and order of every row (hidden columns for later merges). ``staged`` is the result of
    ``parents`` for the same relations and rank, written once for several datasets. A dataset that numbers its rows
    with ``seq_strategy`` "split" is computed and written here, its parents counted, and before that the versions of each key and
    batch where it ranks parents; nothing else runs a job.
    """
    if spec.kind == "per_arm_rates":
        return build_rates(spec, relations, settings, watermark=watermark, lookback_ms=lookback_ms,
                           include_audit=include_audit, carry_rank=carry_rank)
    where = relation_filter(watermark, lookback_ms)
    lt = spec.latest
    if staged is None:
        a = union_relations(relations, exclude=spec.union_exclude, where=where)
    else:
        drop = {e.lower() for e in spec.union_exclude if "." not in e}
        a = staged.select(*[F.col(f"`{c}`") for c in staged.columns if c.lower() not in drop])
    union_cols = a.columns

    def ranked(df: DataFrame, done: bool = False) -> DataFrame:
        out = df if done else _latest(df, spec, settings, latest_strategy)
        if carry_rank:
            out = out.withColumns(rank_columns(df, rank_keys(spec, settings), lt.order, tiebreak_of(spec), lt.ties))
        return out

    numbers_now = bool(spec.seq_by) and (seq_strategy or settings.seq_strategy) == "split"
    if numbers_now and lt and lt.ties and lt.stage == "parent" and staged is None:
        a = _narrowed(a, spec)
        latest_strategy = "split" if latest_strategy == "auto" else latest_strategy
    if lt and lt.stage == "parent":
        a = ranked(a, done=staged is not None)
    f = unnest_chain(a, spec.unnest)
    if spec.where:
        f = f.filter(_expr(spec.where))
    if lt and lt.stage == "rows":
        f = ranked(f)

    cols = projection(f, spec, union_cols, settings)
    taken = {n.lower() for n, _ in cols}
    hidden: list[Column] = [F.col(c) for c in (RANK_KEY, RANK_ORDER) if c in f.columns]
    if spec.fx is not None and spec.fx.on == "raw":
        hidden += [_expr(spec.fx.date).alias(HIDDEN_FX_DATE), _expr(spec.fx.currency).alias(HIDDEN_FX_CUR)]
    carry = [F.col(c) for c in (SOURCE_RELATION, *DATON) if c in f.columns and c.lower() not in taken]
    out = f.select(*[c.alias(n) for n, c in cols], *hidden, *carry)
    for d in DATON:
        if d not in out.columns:
            out = out.withColumn(d, F.lit(None).cast("long" if d != USER_ID else "string"))

    if lt and lt.stage == "output" and not lt.after_fx:
        out = ranked(out)
    out = _post(out, spec)
    if spec.fx is not None:
        if spec.fx.on == "output":
            out = out.withColumns({HIDDEN_FX_DATE: _expr(spec.fx.date), HIDDEN_FX_CUR: _expr(spec.fx.currency)})
        joined = fx_left_join(out, fx, HIDDEN_FX_DATE, HIDDEN_FX_CUR, settings)
        if not spec.fx.columns:
            joined = joined.drop(FX_RATE, FX_CURRENCY)
        out = joined.drop(HIDDEN_FX_DATE, HIDDEN_FX_CUR)
    if lt and lt.stage == "output" and lt.after_fx:
        out = ranked(out)

    front = [brand_expr().alias("brand")] if spec.brand else []
    own = (SOURCE_RELATION, *DATON, FX_RATE, FX_CURRENCY, RANK_KEY, RANK_ORDER)
    body = [c for c in out.columns if c not in own]
    fxc = [c for c in (FX_RATE, FX_CURRENCY) if c in out.columns]
    tail = [F.col(SOURCE_RELATION), *[F.col(d) for d in DATON]]
    lin = [v.alias(k) for k, v in lineage_columns(spec.lineage).items()]
    rank = [F.col(c) for c in (RANK_KEY, RANK_ORDER) if c in out.columns]
    res = out.select(*front, *[F.col(f"`{c}`") for c in body], *[F.col(c) for c in fxc], *tail, *lin, *rank)
    if spec.constant_row_num:
        res = res.withColumn("row_num", F.lit(1))
    if include_audit:
        res = res.withColumns({LAST_UPDATED: F.current_timestamp(), RUN_ID: F.lit(settings.run_id)})
    if spec.seq_by and seq_strategy != "later":
        res = number(res, spec, settings, seq_strategy)
    return res


def number(df: DataFrame, spec: DatasetSpec, settings: Settings, strategy: str | None = None) -> DataFrame:
    """``_seq_id`` of the spec over output rows."""
    return seq_id(df, [spec.seq_by], [BATCH_RUNTIME], tiebreak=spec.seq_tiebreak,
                  strategy=strategy or settings.seq_strategy, large=settings.seq_large)


def _post(out: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Steps written outside the ranked derived table: a second unnest and re-keyed columns."""
    steps = spec.extra.get("post_unnest", ())
    post = spec.extra.get("post_columns", ())
    if not steps and not post:
        return out
    out = unnest_chain(out, steps)
    for item in post:
        if isinstance(item, Key):
            t = out.select(_expr(item.expr).alias("k")).schema["k"].dataType
            out = out.withColumn(item.name, typed_default(_expr(item.expr), item.default, t))
        else:
            out = out.withColumn(item.name, _expr(item.expr))
    return out.drop(*spec.extra.get("post_drop", ()))


def build_rates(spec: DatasetSpec, relations, settings: Settings, *, watermark: int | dict | None = None,
                lookback_ms: int = 0, include_audit: bool = True, carry_rank: bool = False) -> DataFrame:
    """Exchange rates: per relation, keep the newest row per (date, from, to); then UNION ALL.

    The dedup is inside each arm, so the same key from two relations survives twice (``Settings.rates_policy`` decides
    what a run makes of that). Their rank key holds the relation unless the newest load of all relations wins.
    """
    keys = ("date", "from_currency_code", "to_currency_code")
    arms = []
    for r in relations:
        name, df = (r.name, r.load()) if hasattr(r, "load") else r
        cond = relation_filter(watermark, lookback_ms)(name)
        if cond is not None:
            df = df.filter(cond)
        cols = {c.lower() for c in df.columns}
        value = F.col("value")
        if "value_bn" in cols:
            value = F.coalesce(F.col("value"), F.col("value_bn").cast(NUMERIC))
        arm = df.select(F.col("date"), F.col("from_currency_code"), F.col("to_currency_code"),
                        value.alias("value"), *[F.col(d) for d in DATON])
        arm = keep_latest(arm, list(keys), [BATCH_RUNTIME], ties=False, tiebreak=[BATCH_ID])
        if carry_rank:
            own = () if settings.rates_policy == "newest" else (f"'{name}'",)
            arm = arm.withColumns(rank_columns(arm, (*keys, *own), (BATCH_RUNTIME,), (BATCH_ID,), ties=False))
        arms.append(arm)
    out = arms[0]
    for a in arms[1:]:
        out = out.unionByName(a)
    if carry_rank and settings.rates_policy == "newest":
        out = keep_latest(out, [RANK_KEY], [RANK_ORDER], ties=False)
    if include_audit:
        out = out.withColumns({LAST_UPDATED: F.current_timestamp(), RUN_ID: F.lit(settings.run_id)})
    return out
