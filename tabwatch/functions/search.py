"""Binary-search bucket expressions over literal cut points.

``count_le_sql(v, cuts)`` is the number of cuts <= v for a non-decreasing
list of cuts, written as a balanced tree of comparisons: log2(len) compares
per row, fully inside whole-stage codegen (unlike a lambda over an array).
The cut list is configuration-sized (a profile or a sketch), never data.
"""

from __future__ import annotations

import math
from collections.abc import Sequence


def sql_double(x: float) -> str:
    if math.isnan(x):
        return "CAST('NaN' AS DOUBLE)"
    if math.isinf(x):
        return "CAST('Infinity' AS DOUBLE)" if x > 0 else "CAST('-Infinity' AS DOUBLE)"
    return repr(float(x)) + "D"


def count_le_sql(value_sql: str, cuts: Sequence[float]) -> str:
    """SQL text: number of elements of ``cuts`` (non-decreasing) that are <= value."""
    cuts = [float(c) for c in cuts]

    def tree(lo: int, hi: int) -> str:
        if lo == hi:
            return str(lo)
        mid = (lo + hi) // 2
        return (f"CASE WHEN {value_sql} < {sql_double(cuts[mid])} "
                f"THEN {tree(lo, mid)} ELSE {tree(mid + 1, hi)} END")

    return tree(0, len(cuts))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_text(value: str) -> str:
    """A string literal of Spark SQL."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
