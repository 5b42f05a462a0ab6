"""DataFrame -> DataFrame operators of the staging recipe."""

from rawfold.operators.fx import MissingRates, fx_left_join
from rawfold.operators.latest import keep_latest, seq_id
from rawfold.operators.nested import drop_nested_fields, prefixed, struct_star, unnest, unnest_chain
from rawfold.operators.quality import check_not_null, check_recency, check_unique, run_record, store_failures

__all__ = [
    "MissingRates", "check_not_null", "check_recency", "check_unique", "drop_nested_fields",
    "fx_left_join", "keep_latest", "prefixed", "run_record", "seq_id", "store_failures", "struct_star",
    "unnest", "unnest_chain",
]
