"""Relation discovery and union-by-name (the raw side of every staging dataset).

Raw tables are never declared: one table exists per (brand, integration, entity) and they are found
by a LIKE pattern on the table name, minus an exclude pattern. All tables of an entity are then
stacked by column name into one superset schema, each row tagged with the relation it came from.
The union is a narrow operation (no shuffle); per-arm filters stay in each arm, so a watermark
literal reaches every parquet scan as a pushed filter.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawfold.config import SOURCE_RELATION
from rawfold.sources.types import common_type, convert


def like_regex(pattern: str) -> re.Pattern:
    """SQL LIKE pattern -> case-insensitive regex (``%`` any run, ``_`` any one character)."""
    out = []
    for ch in pattern:
        out.append(".*" if ch == "%" else "." if ch == "_" else re.escape(ch))
    return re.compile("^" + "".join(out) + "$", re.IGNORECASE | re.DOTALL)


def ilike(name: str, pattern: str) -> bool:
    return bool(like_regex(pattern).match(name))


def matches(name: str, pattern: str, exclude: str = "") -> bool:
    """True when ``name ILIKE pattern`` and not ``name ILIKE exclude`` (empty exclude = none)."""
    return ilike(name, pattern) and not (exclude and ilike(name, exclude))


def match_relations(names: DataFrame, pattern: str, exclude: str = "", column: str = "table_name", *,
                    schema_pattern: str = "", schema_column: str = "table_schema") -> DataFrame:
    """Filter a DataFrame of relation/table names with the same LIKE semantics, on executors; with a schema pattern also by schema."""
    cond = F.col(column).ilike(pattern)
    if exclude:
        cond = cond & ~F.col(column).ilike(exclude)
    if schema_pattern:
        cond = cond & F.col(schema_column).ilike(schema_pattern)
    return names.filter(cond)


def relation_name(database: str, schema: str, table: str) -> str:
    return f"`{database}`.`{schema}`.`{table}`"


@dataclass(frozen=True)
class Relation:
    """A raw relation: its full name and how to scan it."""

    name: str
    table: str
    load: Callable[[], DataFrame]


class CatalogSource:
    """Raw tables registered in the Spark catalog under the schemas (databases) that match a LIKE pattern.

    ``schema`` may be a plain name. A table is then known as ``<schema>.<table>``; patterns look at the table's own name."""

    def __init__(self, spark: SparkSession, schema: str, database: str | None = None):
        self.spark, self.schema, self.database = spark, schema, database or "spark_catalog"

    def schemas(self) -> list[str]:
        if "%" not in self.schema:
            return [self.schema]
        return sorted(d.name for d in self.spark.catalog.listDatabases() if ilike(d.name, self.schema))

    def tables(self) -> list[str]:
        # views of the session belong to no schema and would come once for each
        return [f"{s}.{t.name}" for s in self.schemas() for t in self.spark.catalog.listTables(s) if not t.isTemporary]

    def relation(self, table: str) -> Relation:
        schema, name = table.split(".", 1) if "." in table else (self.schema, table)
        return Relation(relation_name(self.database, schema, name), name, lambda: self.spark.table(f"`{schema}`.`{name}`"))


class MappingSource:
    """Raw tables given as ``{table_name: DataFrame | parquet path}``."""

    def __init__(self, spark: SparkSession, tables: Mapping[str, object], database: str = "raw",
                 schema: str = "raw"):
        self.spark, self._tables, self.database, self.schema = spark, dict(tables), database, schema

    def tables(self) -> list[str]:
        return list(self._tables)

    def relation(self, table: str) -> Relation:
        src = self._tables[table]
        load = (lambda: self.spark.read.parquet(src)) if isinstance(src, str) else (lambda: src)
        return Relation(relation_name(self.database, self.schema, table), table, load)


def discover(source, pattern: str, exclude: str = "") -> list[Relation]:
    """Relations of ``source`` whose table name matches ``pattern`` and not ``exclude``; sorted by name."""
    return [source.relation(t) for t in sorted(source.tables()) if matches(t.rsplit(".", 1)[-1], pattern, exclude)]


def union_relations(relations: Sequence[tuple[str, DataFrame]] | Sequence[Relation],
                    exclude: Iterable[str] = (), where: Column | str | Callable[[str], Column | None] | None = None,
                    source_column: str = SOURCE_RELATION) -> DataFrame:
    """UNION ALL by name over a superset schema; missing columns become NULL, differing types their common one (``types``).

    * ``exclude``: top-level column names dropped from every arm (case-insensitive). Dotted names
      (``"shipping_lines.tax_lines"``) are not applied here; the builder drops them from the output.
    * ``where``: filter applied to each arm before the union (incremental watermark); a function gives each relation its own.
    * ``source_column``: the relation name of each row.
    """
    arms = [(r.name, r.load()) if isinstance(r, Relation) else r for r in relations]
    if not arms:
        raise ValueError("union_relations: no relations matched")
    drop = {e.lower() for e in exclude if "." not in e}
    cleaned = []
    for name, df in arms:
        keep = [c for c in df.columns if c.lower() not in drop and c.lower() != source_column.lower()]
        df = df.select(*[F.col(f"`{c}`") for c in keep])
        cond = F.expr(where) if isinstance(where, str) else where(name) if callable(where) and not isinstance(where, Column) else where
        if cond is not None:
            df = df.filter(cond)
        cleaned.append((name, df))

    # one type a column for all arms, also inside arrays and structs; null columns where an arm has none
    seen: dict[str, tuple[str, list[T.DataType]]] = {}
    for _, df in cleaned:
        for f in df.schema.fields:
            seen.setdefault(f.name.lower(), (f.name, []))[1].append(f.dataType)
    types = {k: common_type(v) for k, (_, v) in seen.items()}

    tagged = []
    for name, df in cleaned:
        cols = [F.lit(name).alias(source_column)]
        for f in df.schema.fields:
            cols.append(convert(F.col(f"`{f.name}`"), f.dataType, types[f.name.lower()]).alias(f.name))
        tagged.append(df.select(*cols))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
