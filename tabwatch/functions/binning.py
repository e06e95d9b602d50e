"""Bin-index expressions over an array of cut points (no Bucketizer).

Bucketizer refuses fewer than three splits and fails on out-of-range
values; these expressions handle the single open bin and closed ranges.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_open(value: Column, cuts: Column) -> Column:
    """Bin of ``value`` for open-ended edges [-inf, c1..ck, +inf].

    Bins are [lo, hi): a value equal to an inner edge goes right.  The
    answer is the number of inner cuts <= value (0..k).
    """
    return F.size(F.filter(cuts, lambda c: c <= value))


def bin_closed(value: Column, edges: Column) -> Column:
    """Bin of ``value`` for closed-range edges e0..eB, or null if outside.

    Bins are [e_i, e_i+1) except the last, which is [e_B-1, e_B].  Equal
    neighbouring edges give empty bins (the later bin wins a tie).
    """
    n = F.size(edges)
    inside = (value >= F.element_at(edges, 1)) & (value <= F.element_at(edges, n))
    lower = F.slice(edges, 1, n - 1)
    idx = F.size(F.filter(lower, lambda c: c <= value)) - 1
    return F.when(inside, idx)
