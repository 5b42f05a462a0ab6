"""Column expressions used by the staging recipe. All are built-in Spark functions (JVM side)."""

from rawfold.functions.convert import (
    extract_nested, millis_to_ts, to_numeric, to_wallclock, typed_default,
)
from rawfold.functions.lineage import (
    brand, integration_id, integration_id_tokens, lineage_columns, source_table,
    store_token,
)

__all__ = [
    "brand", "extract_nested", "integration_id", "integration_id_tokens",
    "lineage_columns", "millis_to_ts", "source_table", "store_token", "to_numeric", "to_wallclock",
    "typed_default",
]
