"""Every dataset spec builds and runs on a raw table synthesized from the paths it references."""

import datetime as dt
import re

import pytest
from pyspark.sql import types as T

from rawfold.config import Settings
from rawfold.plans.builder import build
from rawfold.plans.spec import Col, Key, Pick, SStar, Tz
from rawfold.plans.specs import SPECS, is_enabled

IDENT = re.compile(r"[A-Za-z_][A-Za-z0-9_]*(?:\.[A-Za-z_][A-Za-z0-9_]*)*")
WORDS = {"coalesce", "cast", "as", "string", "numeric", "is", "not", "null", "decimal", "and", "or"}
CONTRACT = {"_dbt_source_relation", "_daton_user_id", "_daton_batch_runtime", "_daton_batch_id", "_last_updated",
            "_run_id"}


# fields the rate join (on output columns) reads out of a struct star
STAR_FIELDS = {"ShopifyRefundsTransactions": ("transactions.created_at", "transactions.currency", "transactions.amount"),
               "ShopifyRefundsOrderAdjustments": ("order_adjustments.id",)}


def _idents(exprs):
    out = []
    for e in exprs:
        e = re.sub(r"'[^']*'", "", e)
        out += [m for m in IDENT.findall(e) if m.lower() not in WORDS and not m[0].isdigit()]
    return out


def _inner_paths(spec):
    exprs = []
    for c in spec.columns:
        if isinstance(c, (Col, Key)):
            exprs.append(c.expr)
        elif isinstance(c, Tz):
            exprs.append(c.src)
        elif isinstance(c, Pick):
            exprs += [f"{c.col}.{f}" for f in c.fields]
        elif isinstance(c, SStar):
            exprs.append(f"{c.col}.extra_{c.col.lower()}")
    if spec.latest and spec.latest.stage != "output":
        exprs += list(spec.latest.keys) + list(spec.latest.order) + list(spec.latest.tiebreak)
    if spec.fx and spec.fx.on == "raw":
        exprs += [spec.fx.date, spec.fx.currency]
    if spec.where:
        exprs.append(spec.where)
    return _idents(exprs) + list(STAR_FIELDS.get(spec.name, ()))


def _aliases(steps, base=None):
    alias = dict(base or {})
    for s in steps:
        path, name = (s, s) if isinstance(s, str) else (f"{s[0]}.{s[1]}", s[1])
        segs = path.lower().split(".")
        alias[name.lower()] = alias.get(segs[0], [segs[0]]) + segs[1:]
    return alias


def _raw_schema(spec):
    """Nested schema: unnest sources become arrays of structs, leaves are typed by name."""
    inner = _aliases(spec.unnest)
    arrays = {tuple(v) for v in inner.values()}
    tree: dict = {}
    daton = {"_daton_user_id", "_daton_batch_runtime", "_daton_batch_id"}

    def add(segs):
        node = tree
        for x in segs:
            node = node.setdefault(x, {})

    for p in _inner_paths(spec) + ["id", "created_at", "updated_at", "currency", "extra_col"]:
        if p.lower() in daton:
            continue
        segs = p.lower().split(".")
        add(inner.get(segs[0], [segs[0]]) + segs[1:])
    # steps after the ranked derived table read fields of the struct star's source
    star = next((c.col.lower() for c in spec.columns if isinstance(c, SStar)), None)
    if star:
        post = _aliases(spec.extra.get("post_unnest", ()), {k: inner.get(star, [star]) + [k]
                                                           for k in ("tax_amount_set", "order_id")})
        post_arrays = {tuple(v) for k, v in post.items() if k not in ("order_id",)}
        arrays |= post_arrays
        for c in spec.extra.get("post_columns", ()):
            for p in _idents([c.expr]):
                segs = p.lower().split(".")
                add(post.get(segs[0], [segs[0]]) + segs[1:])
    for a in arrays:  # make sure every unnest source exists
        add(list(a))

    def typ(name, sub, path):
        if sub:
            st = T.StructType([T.StructField(k, typ(k, v, path + (k,))) for k, v in sorted(sub.items())])
            return T.ArrayType(st) if path in arrays else st
        if path in arrays:
            return T.ArrayType(T.StructType([T.StructField("extra_" + name, T.StringType())]))
        if name.endswith("_at") or name in ("evidence_due_by", "evidence_sent_on", "finalized_on"):
            return T.TimestampNTZType()
        if name == "date":
            return T.DateType()
        if name in ("amount", "price", "rate") or name.endswith("_amount"):
            return T.DoubleType()
        if name == "id" or name.endswith("_id") or name in ("quantity", "discount_application_index"):
            return T.LongType()
        return T.StringType()

    fields = [T.StructField(k, typ(k, v, (k,))) for k, v in sorted(tree.items())]
    fields += [T.StructField("_daton_user_id", T.StringType()), T.StructField("_daton_batch_runtime", T.LongType()),
               T.StructField("_daton_batch_id", T.LongType())]
    return T.StructType(fields)


def _value(t, i):
    if isinstance(t, T.StructType):
        return tuple(_value(f.dataType, i) for f in t.fields)
    if isinstance(t, T.ArrayType):
        return [] if i == 2 else [_value(t.elementType, i), _value(t.elementType, i + 10)]
    if isinstance(t, T.TimestampNTZType):
        return dt.datetime(2024, 3, 10, 6 + i)
    if isinstance(t, T.DateType):
        return dt.date(2024, 3, 10)
    if isinstance(t, T.DoubleType):
        return 1.5 + i
    if isinstance(t, T.LongType):
        return None if i == 3 else i % 3
    return f"C{i % 2}"


@pytest.fixture(scope="module")
def fx(spark):
    return spark.createDataFrame([(dt.date(2024, 3, 10), "USD", "C1", 2.0)],
                                 "date date, from_currency_code string, to_currency_code string, value double")


@pytest.mark.parametrize("spec", [s for s in SPECS if s.kind == "standard"], ids=lambda s: s.name)
def test_spec_builds_with_contract_columns(spark, spec, fx):
    schema = _raw_schema(spec)
    rows = []
    for i in range(4):
        r = list(_value(f.dataType, i) for f in schema.fields[:-3])
        rows.append(tuple(r) + (f"u{i}", 1000 + (i % 2), i))
    raw = spark.createDataFrame(rows, schema)
    rel = "`lake`.`raw`.`Acme_us_shopify_1_" + spec.pattern.strip("%").split("%")[-1] + "`"
    out = build(spec, [(rel, raw)], Settings(), fx=fx if spec.fx else None)
    cols = [c.lower() for c in out.columns]
    assert len(cols) == len(set(cols)), f"duplicate output columns in {spec.name}"
    assert CONTRACT <= set(cols)
    if spec.brand:
        assert "brand" in cols and "_daton_sourceversion_integration_id" in cols
    res = out.collect()
    assert len(res) > 0
    assert all(r["brand"] == "Acme" for r in res)


def test_enable_switches():
    on = [s.name for s in SPECS if is_enabled(s, Settings())]
    assert len(on) == 26 and "ShopifyProducts" in on and "ShopifyPayouts" not in on
    assert not any(is_enabled(s, Settings(shopify_v2=False)) for s in SPECS if s.platform_flag == "shopify_v2")
    assert is_enabled(next(s for s in SPECS if s.name == "ShopifySmartCollections"),
                      Settings(enabled={"ShopifySmartCollectionsTest": True}))
