"""Declarative description of one staging dataset.

A spec says *what* a dataset is (which raw tables, which nested paths, which output columns,
which key and order decide the newest version, how rates are joined); ``builder.build`` turns it
into one DataFrame plan. Output expressions are Spark SQL snippets evaluated with ``F.expr``
against the unnested frame, so Catalyst sees one plain projection.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from rawfold.config import BATCH_RUNTIME


@dataclass(frozen=True)
class Col:
    """``expr AS name``."""

    name: str
    expr: str


@dataclass(frozen=True)
class Tz:
    """UTC -> configured wall-clock zone: ``timezone_conversion(src) AS name``."""

    name: str
    src: str


@dataclass(frozen=True)
class Key:
    """``coalesce(CAST(expr AS cast), default) AS name`` with the default typed like the key."""

    name: str
    expr: str
    default: object
    cast: str | None = None


@dataclass(frozen=True)
class Star:
    """``a.* EXCEPT(exclude)`` over the union table's own columns (lineage columns always excluded)."""

    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class SStar:
    """``col.* EXCEPT(exclude)``: fields of an unnested struct as top-level columns.

    ``drop_nested`` lists dotted excludes of the union (``shipping_lines.tax_lines``) that apply
    to this struct's output.
    """

    col: str
    exclude: tuple[str, ...] = ()


@dataclass(frozen=True)
class Pick:
    """``col.f AS <prefix>f`` for each field; prefix defaults to ``<col>_``."""

    col: str
    fields: tuple[str, ...]
    prefix: str | None = None


@dataclass(frozen=True)
class Latest:
    """Keep-latest rule.

    ``keys``/``order`` are SQL expressions. ``stage``:
      * ``parent`` - before unnesting (valid when keys are parent-level and no WHERE precedes);
      * ``rows``   - after unnesting and WHERE, before the projection;
      * ``output`` - on output columns (keys are output names), before the FX join unless
        ``after_fx`` (a ``row_number`` written after the join collapses rate fan-out rows).
    """

    keys: tuple[str, ...]
    order: tuple[str, ...] = (BATCH_RUNTIME,)
    ties: bool = True
    stage: str = "parent"
    after_fx: bool = False
    tiebreak: tuple[str, ...] = ()


@dataclass(frozen=True)
class Fx:
    """Rate join on ``date(date) = fx.date AND currency = fx.to_currency_code``.

    ``date``/``currency`` are SQL over the unnested frame when ``on="raw"`` (the join reads the
    unconverted column) or output column names when ``on="output"`` (it reads converted ones).
    ``columns=False`` joins for the row effect only and adds no rate columns.
    """

    date: str
    currency: str
    on: str = "raw"
    columns: bool = True


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    pattern: str
    exclude_pattern: str = ""
    default_on: bool = True
    switch: str | None = None
    union_exclude: tuple[str, ...] = ()
    unnest: tuple = ()
    where: str | None = None
    columns: tuple = ()
    latest: Latest | None = None
    fx: Fx | None = None
    seq_by: str | None = None
    seq_tiebreak: tuple[str, ...] = ()
    lineage: str = "shopify"
    brand: bool = True
    constant_row_num: bool = False
    platform_flag: str = "shopify_v2"
    kind: str = "standard"
    merge_keys: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    partition_by: str | None = None
    notes: str = ""
    extra: dict = field(default_factory=dict)

    @property
    def nested_excludes(self) -> tuple[str, ...]:
        return tuple(e for e in self.union_exclude if "." in e)
