"""Null handling: one missing-value concept (SQL NULL), safe division, null-safe keys."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(n, d) -> Column:
    """MTH-01: n / d with x/0 -> NULL (ANSI-safe; no +-inf can appear)."""
    return F.try_divide(col_(n).cast("double"), col_(d).cast("double"))


# Half up. Means often end exactly on a half at the next digit, and the order of summation moves them by an ulp or
# so either way; the boundary lies a ten-thousandth of a unit of the last digit below the half, where they agree.
ROUND_OFFSET = 0.50012345679


def rnd(c, scale: int) -> Column:
    """Half-up rounding that sums in any order agree on; the oracle SQL rounds by the same rule."""
    k = float(10 ** scale)
    return F.floor(col_(c) * F.lit(k) + F.lit(ROUND_OFFSET)) / F.lit(k)


def rnd_sql(expr: str, scale: int) -> str:
    return f"(FLOOR(({expr}) * 1e{scale} + {ROUND_OFFSET}) / 1e{scale})"
