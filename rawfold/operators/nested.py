"""Nested data: outer unnesting of arrays (one level, chains, siblings) and struct flattening.

``unnest`` is a LEFT JOIN UNNEST: a row whose array is NULL or empty survives once with a NULL
element. A single-object nested field may arrive as a struct or as an array of one struct; both
are accepted (struct -> field access, array -> ``explode_outer``). Exploding is a narrow Generate
operator: no shuffle, rows stay in their partition.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def resolve_type(df: DataFrame, path: str) -> T.DataType | None:
    """Data type of a (dotted, case-insensitive) path, or None when it does not exist."""
    dt: T.DataType = df.schema
    for part in path.split("."):
        while isinstance(dt, T.ArrayType):
            dt = dt.elementType
        if not isinstance(dt, T.StructType):
            return None
        hit = next((f for f in dt.fields if f.name.lower() == part.lower()), None)
        if hit is None:
            return None
        dt = hit.dataType
    return dt


def _existing(df: DataFrame, name: str) -> str:
    return next((c for c in df.columns if c.lower() == name.lower()), name)


def unnest(df: DataFrame, path: str, alias: str | None = None) -> DataFrame:
    """Outer-unnest ``path`` into column ``alias`` (default: last path segment).

    ``unnest(df, "line_items")`` replaces the array column by its element;
    ``unnest(df, "line_items.tax_lines", "tax_lines")`` adds the child element next to its parent.
    A missing path yields a NULL column, as an empty array would.
    """
    alias = _existing(df, alias or path.split(".")[-1])
    dt = resolve_type(df, path)
    if dt is None:
        return df.withColumn(alias, F.lit(None).cast(T.StringType()))
    c = F.col(path)
    if isinstance(dt, T.ArrayType):
        return df.withColumn(alias, F.explode_outer(c))
    return df.withColumn(alias, c)


def unnest_chain(df: DataFrame, steps: Sequence[str | tuple[str, str]]) -> DataFrame:
    """Apply ``unnest`` steps in order: ``"line_items"`` or ``("line_items", "tax_lines")``.

    A tuple ``(parent, child)`` unnests ``parent.child`` as ``child``. Two steps on the same parent
    (siblings) multiply rows per parent, as two lateral joins do.
    """
    for s in steps:
        df = unnest(df, s) if isinstance(s, str) else unnest(df, f"{s[0]}.{s[1]}", s[1])
    return df


def struct_fields(df: DataFrame, col: str) -> list[str]:
    dt = resolve_type(df, col)
    while isinstance(dt, T.ArrayType):
        dt = dt.elementType
    return [f.name for f in dt.fields] if isinstance(dt, T.StructType) else []


def struct_star(df: DataFrame, col: str, exclude: Iterable[str] = (), prefix: str = "",
                taken: Iterable[str] = ()) -> list[tuple[str, Column]]:
    """``col.* EXCEPT(exclude)`` as top-level columns.

    A field whose name is already ``taken`` is prefixed with ``<col>_`` instead of colliding
    (duplicate names cannot be written).
    """
    drop = {e.lower() for e in exclude}
    taken_l = {t.lower() for t in taken}
    out = []
    for f in struct_fields(df, col):
        if f.lower() in drop:
            continue
        name = prefix + f
        if name.lower() in taken_l:
            name = f"{col.split('.')[-1]}_{f}"
        taken_l.add(name.lower())
        out.append((name, F.col(f"{col}.`{f}`")))
    return out


def prefixed(df: DataFrame, col: str, fields: Sequence[str], prefix: str | None = None) -> list[tuple[str, Column]]:
    """``col.f AS col_f`` for each field; a field the raw schema lacks becomes a NULL string."""
    p = f"{col.split('.')[-1]}_" if prefix is None else prefix
    return [(p + f, F.col(f"{col}.`{f}`") if resolve_type(df, f"{col}.{f}") is not None
             else F.lit(None).cast(T.StringType())) for f in fields]


def drop_nested_fields(df: DataFrame, column: str, fields: Iterable[str]) -> DataFrame:
    """Drop fields of a struct column, or of every element of an array-of-struct column."""
    dt = resolve_type(df, column)
    present = [f for f in fields if resolve_type(df, f"{column}.{f}") is not None]
    if dt is None or not present:
        return df
    name = _existing(df, column) if "." not in column else column
    if isinstance(dt, T.ArrayType):
        return df.withColumn(name, F.transform(F.col(column), lambda x: x.dropFields(*present)))
    return df.withColumn(name, F.col(column).dropFields(*present))
