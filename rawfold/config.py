"""Run settings: the project-level switches of the staging recipe."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass, field, replace

# Project defaults and column names that staged data must keep.
DEFAULT_TO_TIMEZONE = "America/Chicago"
DEFAULT_FX_LOOKBACK_MS = 2_592_000_000  # 30 days in milliseconds
DEFAULT_RUN_ID = "manual"
BATCH_RUNTIME = "_daton_batch_runtime"
BATCH_ID = "_daton_batch_id"
USER_ID = "_daton_user_id"
SOURCE_RELATION = "_dbt_source_relation"
INTEGRATION_ID = "_daton_sourceversion_integration_id"
LAST_UPDATED = "_last_updated"
RUN_ID = "_run_id"

RATES_POLICIES = ("newest", "fail", "keep")
WATERMARKS = ("global", "relation")


@dataclass(frozen=True)
class Settings:
    """Knobs a user sets per run.

    ``enabled`` overrides the per-dataset default switch (``{"ShopifyProducts": False}``), ``patterns`` its
    relation patterns (``{"ShopifyOrders": ("%orders_v2", "%draft%")}``: pattern, exclude pattern), ``lookback_ms``
    how far its incremental loads reach back (rates: ``fx_lookback_ms`` unless named here) and ``partition_by`` the
    timestamp or date column its target is partitioned by, by day (otherwise by a hash of the rank key into
    ``target_parts`` parts, fixed when the table is created). Days become months, months years, once a table would have more
    than ``max_parts`` parts by time; it is laid out anew then.
    ``interleave`` names datasets whose folders are clustered by several columns alike, along a Z curve, instead of sorted by their
    keys: ``{"ShopifyOrders": ("customer_id", "created_at")}``.
    ``watermark`` is "global" (one maximum of the target, as in the source project: a store whose batch arrives after a newer one of
    another store is not loaded) or "relation" (one for each relation, kept in the manifest). A load that meets another
    writer's commit is merged again up to ``commit_attempts`` times. Folders of a part are rewritten once ``compact_fan`` of them are of
    one size (counted from ``compact_smallest`` bytes). ``recency`` names datasets whose newest value of a column must be at most some
    days older than ``as_of`` (default: now), by group: ``{"ShopifyOrders": ("updated_at", 2, ("brand",))}``.
    ``rates_policy`` says what a run does with a rate key that two relations hold: "newest" load wins, "fail", or
    "keep" both (each then doubles the fact rows it meets).
    ``seq_strategy`` numbers ``_seq_id`` with ``"split"`` (a window; parents of more than ``seq_large`` rows over
    ranges), ``"window"`` or ``"ranged"`` alone.
    ``scope_by_source`` ranks versions per (key, source relation): equal ids from two stores no longer
    compete (by default they do, as in the source project).
    """

    timezone_conversion: bool = True
    to_timezone: str = DEFAULT_TO_TIMEZONE
    currency_conversion: bool = True
    shopify_v2: bool = True
    fx_lookback_ms: int = DEFAULT_FX_LOOKBACK_MS
    run_id: str = field(default_factory=lambda: os.environ.get("RAWFOLD_RUN_ID", DEFAULT_RUN_ID))
    enabled: dict = field(default_factory=dict)
    patterns: dict = field(default_factory=dict)
    lookback_ms: dict = field(default_factory=dict)
    partition_by: dict = field(default_factory=dict)
    interleave: dict = field(default_factory=dict)
    target_parts: int = 32
    max_parts: int = 4_000  # fixed value: the most parts that a partitioned warehouse table may have
    retain_versions: int = 2
    watermark: str = "global"
    commit_attempts: int = 5
    compact_fan: int = 4
    compact_smallest: int = 16 << 20
    recency: dict = field(default_factory=dict)
    as_of: dt.datetime | None = None
    rates_policy: str = "newest"
    full_refresh: bool = False
    seq_strategy: str = "split"
    seq_large: int = 1_000_000
    scope_by_source: bool = False

    def __post_init__(self):
        if self.rates_policy not in RATES_POLICIES:
            raise ValueError(f"rates_policy is one of {RATES_POLICIES}, not {self.rates_policy!r}")
        if self.watermark not in WATERMARKS:
            raise ValueError(f"watermark is one of {WATERMARKS}, not {self.watermark!r}")

        if self.max_parts < 2:
            raise ValueError("max_parts is 2 or more")

    def with_(self, **kw) -> "Settings":
        return replace(self, **kw)
