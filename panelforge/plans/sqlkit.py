"""Small helpers for writing the DuckDB oracle SQL next to each query."""
from panelforge.functions.nulls import rnd_sql as R  # noqa: F401
from panelforge.plans.views import LINES_SQL, SALES_SQL, with_sql

# Month ordinal of the sales date, as the library computes it from YYYYMM.
SALES_T = "CAST(year(saleDate) * 12 + month(saleDate) - 1 AS BIGINT)"


def sales_with(*extra: str) -> str:
    return with_sql(SALES_SQL, *extra)


def lines_with(*extra: str) -> str:
    return with_sql(LINES_SQL, *extra)
