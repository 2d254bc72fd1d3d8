"""MTH-02 / MTH-03: ratio features on a table, with the optional row drop, and the price-per-area preset."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelforge.functions.arith import ratio


def ratio_feature(df: DataFrame, numerator: str, denominator: str, output: str, clip_min: float | None = None,
                  clip_max: float | None = None, numerator_offset: float = 0.0, denominator_offset: float = 0.0,
                  denominator_min: float | None = None, drop_na: bool = False) -> DataFrame:
    """``output`` = numerator / denominator; out-of-range ratios are NULL; with ``drop_na`` rows without one go."""
    value = ratio(F.col(numerator).try_cast("double"), F.col(denominator).try_cast("double"), numerator_offset or 0.0,
                  denominator_offset or 0.0, denominator_min, clip_min, clip_max)
    out = df.withColumn(output, value)
    return out.where(F.col(output).isNotNull()) if drop_na else out


def price_per_area(df: DataFrame, area_col: str, output: str, price_col: str = "salePrice", **options) -> DataFrame:
    """MTH-03: the ratio of a price to an area column."""
    return ratio_feature(df, price_col, area_col, output, **options)
