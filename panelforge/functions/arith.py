"""Math helpers (EXP-03, MTH-*)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelforge.functions.nulls import col_, safe_div

# Default reference point (city centre) and Earth radius in km.
CBD_LAT = -37.814
CBD_LON = 144.963
EARTH_RADIUS_KM = 6371.0


def clip(x, lo=None, hi=None) -> Column:
    """EXP-03: clamp with open sides; NULL stays NULL."""
    c = col_(x)
    if lo is not None:
        c = F.when(c.isNotNull() & (c < F.lit(lo)), F.lit(lo)).otherwise(c)
    if hi is not None:
        c = F.when(c.isNotNull() & (c > F.lit(hi)), F.lit(hi)).otherwise(c)
    return c


def haversine_km(lat1, lon1, lat2=CBD_LAT, lon2=CBD_LON) -> Column:
    """MTH-04: great-circle distance in km."""
    la1, lo1 = col_(lat1).cast("double"), col_(lon1).cast("double")
    la2 = col_(lat2) if isinstance(lat2, (str, Column)) else F.lit(float(lat2))
    lo2 = col_(lon2) if isinstance(lon2, (str, Column)) else F.lit(float(lon2))
    dlat = F.radians(la2 - la1)
    dlon = F.radians(lo2 - lo1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(la1)) * F.cos(F.radians(la2)) * F.pow(F.sin(dlon / 2), 2)
    return F.lit(EARTH_RADIUS_KM) * 2 * F.atan2(F.sqrt(a), F.sqrt(1 - a))


def ratio(num, den, num_offset: float = 0.0, den_offset: float = 0.0, den_min: float | None = None,
          clip_min: float | None = None, clip_max: float | None = None) -> Column:
    """MTH-02: offsets, minimum |denominator|, out-of-range -> NULL (not clamped)."""
    n = col_(num).cast("double") + F.lit(float(num_offset))
    d = col_(den).cast("double") + F.lit(float(den_offset))
    if den_min is not None:
        d = F.when(F.abs(d) >= float(den_min), d)
    r = safe_div(n, d)
    if clip_min is not None:
        r = F.when(r >= float(clip_min), r)
    if clip_max is not None:
        r = F.when(r <= float(clip_max), r)
    return r
