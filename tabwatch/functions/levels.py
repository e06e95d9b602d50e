"""Quantile level grids.

The three spellings differ only in float noise, but with tied values on an
edge the noise moves rows between bins, so the spelling is a parameter and
the same doubles must be handed to every engine that is compared.
"""

from __future__ import annotations


def quantile_levels(n_bins: int, mode: str = "exact") -> list[float]:
    """n_bins+1 levels from 0 to 1.

    exact:    k / n
    linspace: k * (1 / n), last level exactly 1.0 (evenly spaced grid)
    percent:  (k * (100 / n)) / 100 (percent grid divided back to fractions)
    """
    if n_bins < 1:
        raise ValueError("n_bins must be >= 1")
    if mode == "exact":
        return [k / n_bins for k in range(n_bins + 1)]
    if mode == "linspace":
        step = 1.0 / n_bins
        out = [k * step for k in range(n_bins + 1)]
        out[-1] = 1.0
        return out
    if mode == "percent":
        step = 100.0 / n_bins
        pct = [k * step for k in range(n_bins + 1)]
        pct[-1] = 100.0
        return [p / 100.0 for p in pct]
    raise ValueError(f"unknown level mode {mode!r}")
