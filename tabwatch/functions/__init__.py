"""Column-expression helpers (all built-in Spark expressions, no Python UDFs)."""

from tabwatch.functions.binning import bin_closed, bin_open
from tabwatch.functions.hashing import key_bucket, key_hash_order
from tabwatch.functions.levels import quantile_levels
from tabwatch.functions.scalars import collapse_category, mem_to_mb, null_if_token
from tabwatch.functions.search import count_le_sql
from tabwatch.functions.timeparts import ntz_as_instant, ntz_epoch_micros, ntz_epoch_millis, ntz_epoch_seconds

__all__ = [
    "bin_closed", "bin_open", "key_bucket", "key_hash_order",
    "quantile_levels", "collapse_category", "mem_to_mb", "null_if_token", "count_le_sql",
    "ntz_as_instant", "ntz_epoch_micros", "ntz_epoch_millis", "ntz_epoch_seconds",
]
