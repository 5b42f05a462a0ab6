"""Lineage columns derived from the source relation name.

A relation name looks like ```db`.`schema`.`Acme_us_shopify_1_orders```: the third dotted part is the
table, its first ``_`` token is the brand, and the text before ``_shopify`` plus every digit of the
table name is the integration id. ``split`` in Spark takes a regex, so the dot is escaped; ``get``
returns NULL (instead of failing) when a name has fewer parts than expected.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rawfold.config import INTEGRATION_ID, SOURCE_RELATION


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def source_table(relation=SOURCE_RELATION) -> Column:
    """Third dotted part of the relation name with backticks removed."""
    return F.replace(F.get(F.split(_c(relation), r"\."), 2), F.lit("`"), F.lit(""))


def brand(relation=SOURCE_RELATION) -> Column:
    """First ``_`` token of the table name (backticks removed)."""
    raw_table = F.get(F.split(_c(relation), r"\."), 2)
    return F.replace(F.get(F.split(raw_table, "_"), 0), F.lit("`"), F.lit(""))


def integration_id(relation=SOURCE_RELATION, platform: str = "shopify") -> Column:
    """``<lower(table) before _<platform>>_<all digits of table>``."""
    t = source_table(relation)
    head = F.get(F.split(F.lower(t), f"_{platform}"), 0)
    return F.concat(head, F.lit("_"), F.regexp_replace(t, "[^0-9]", ""))


def integration_id_tokens(relation=SOURCE_RELATION) -> Column:
    """Two-token variant: first two ``_`` tokens of the lower-cased table name."""
    parts = F.split(F.lower(source_table(relation)), "_")
    return F.concat(F.get(parts, 0), F.lit("_"), F.get(parts, 1))


def store_token(relation=SOURCE_RELATION, position: int = 3) -> Column:
    """Token ``position`` counted from the end of the ``_``-split name; NULL when too short."""
    return F.get(F.reverse(F.split(_c(relation), "_")), position)


def lineage_columns(style: str = "shopify") -> dict[str, Column]:
    """Integration-id column for a dataset (``shopify`` = prefix + digits, ``tokens`` = two tokens)."""
    if style == "tokens":
        return {INTEGRATION_ID: integration_id_tokens()}
    if style == "none":
        return {}
    return {INTEGRATION_ID: integration_id(platform=style)}
