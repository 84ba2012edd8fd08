"""Operators: ``cohort`` (R1-R16), ``series`` (X1-X10), ``rolling``
(X11-X17), ``growth`` (X18-X26) and ``skew`` (hot-key splitting)."""

from cadence.operators import cohort, growth, rolling, series, skew

__all__ = ["cohort", "growth", "rolling", "series", "skew"]
