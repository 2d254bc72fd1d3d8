"""Date and time column functions (DAT-*). Months are YYYYMM ints or ordinals y*12+m-1."""
from __future__ import annotations

import math
from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from panelforge.functions.nulls import col_

# Date formats tried, in order, by the tolerant parser.
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyyMMdd", "yyyy/M/d", "dd-MMM-yyyy", "d MMM yyyy", "d MMMM yyyy",
                "MMM d, yyyy", "MMMM d, yyyy"]
MONTH_FIRST = ["M/d/yyyy", "M-d-yyyy", "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm"]
DAY_FIRST = ["d/M/yyyy", "d-M-yyyy", "d/M/yyyy H:mm:ss", "d/M/yyyy H:mm"]
#: Date and time with T or a space, fractional seconds and a zone as they may be.
ISO_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?\s*(Z|[+-]\d{2}:?\d{2})?$"


def parse_date(c, formats: Sequence[str] = DATE_FORMATS, day_first: bool = False) -> Column:
    """DAT-01: the first form that parses; unparsable -> NULL.

    Of 3/4/2020 the first number is the month, with ``day_first`` the day; a form that can only be read the other
    way round (25/4/2020) is. Timestamps may carry fractional seconds and a zone; they become the instant.
    """
    s = F.trim(col_(c).cast("string"))
    numeric = DAY_FIRST + MONTH_FIRST if day_first else MONTH_FIRST + DAY_FIRST
    instant = F.when(s.rlike(ISO_TIMESTAMP), s.try_cast("timestamp"))
    return F.coalesce(instant, *[F.try_to_timestamp(s, F.lit(f)) for f in [*formats, *numeric]])


def year_month(c) -> Column:
    """DAT-02: YYYYMM integer from a timestamp/date."""
    d = col_(c)
    return (F.year(d) * 100 + F.month(d)).cast("int")


def date_parts(c) -> dict[str, Column]:
    """DAT-02: year, month, YYYYMM (callers skip when the source is entirely NULL)."""
    d = col_(c)
    return {"year": F.year(d).cast("int"), "month": F.month(d).cast("int"), "year_month": year_month(d)}


def month_ordinal(ym) -> Column:
    """DAT-03: YYYYMM (or YYYYMMDD) integer -> y*12 + m - 1; values <= 1000 pass through."""
    v = col_(ym).cast("bigint")
    ymv = F.when(v >= 10000000, F.floor(v / 100)).otherwise(v)
    return F.when(v > 1000, F.floor(ymv / 100) * 12 + F.pmod(ymv, F.lit(100)) - 1).otherwise(v).cast("bigint")


def month_ordinal_from_text(c) -> Column:
    """DAT-03 for text months: 'YYYYMM...', 'YYYY-MM', or any parsable date."""
    s = F.trim(col_(c).cast("string"))
    digits = F.when(s.rlike(r"^\d{6,}$"), F.substring(s, 1, 4).cast("int") * 12 + F.substring(s, 5, 2).cast("int") - 1)
    per = F.try_to_timestamp(s, F.lit("yyyy-MM"))
    anyd = parse_date(s)
    d = F.coalesce(per, anyd)
    return F.coalesce(digits, (F.year(d) * 12 + F.month(d) - 1)).cast("bigint")


def ordinal_to_year_month(o) -> Column:
    o = col_(o)
    return (F.floor(o / 12) * 100 + F.pmod(o, F.lit(12)) + 1).cast("int")


def month_label(c) -> Column:
    """DAT-04: YYYYMM / YYYYMMDD / 'YYYY/MM' -> 'YYYY-MM'."""
    s = F.regexp_replace(F.trim(col_(c).cast("string")), "/", "-")
    digits = F.when(s.rlike(r"^\d{6,8}$"), F.concat(F.substring(s, 1, 4), F.lit("-"), F.substring(s, 5, 2)))
    dashed = F.when(s.rlike(r"^\d{4}-\d{1,2}"),
                    F.concat(F.substring(s, 1, 4), F.lit("-"), F.lpad(F.regexp_extract(s, r"^\d{4}-(\d{1,2})", 1), 2, "0")))
    return F.coalesce(digits, dashed)


def quarter_label(ym) -> Column:
    """DAT-08: YYYYMM -> 'YYYY-Qn'."""
    v = col_(ym).cast("int")
    return F.concat(F.floor(v / 100).cast("string"), F.lit("-Q"),
                    (F.floor((F.pmod(v, F.lit(100)) - 1) / 3) + 1).cast("string"))


def first_of_month(ym) -> Column:
    """DAT-09: YYYYMM -> first day of that month; invalid -> NULL."""
    return F.to_date(F.try_to_timestamp(F.concat(col_(ym).cast("string"), F.lit("01")), F.lit("yyyyMMdd")))


def split_year_month(ym) -> dict[str, Column]:
    """DAT-10: YYYYMM -> year, month."""
    v = col_(ym).cast("int")
    return {"year": F.floor(v / 100).cast("int"), "month": F.pmod(v, F.lit(100)).cast("int")}


def cyclical(month, period: int = 12) -> dict[str, Column]:
    """DAT-06: sin/cos of 2*pi*(m mod period)/period."""
    rad = F.lit(2 * math.pi) * F.pmod(col_(month).cast("double"), F.lit(float(period))) / F.lit(float(period))
    return {"sin": F.sin(rad), "cos": F.cos(rad)}


def age_at(event_year, built_year, min_age: float | None = None, max_age: float | None = None) -> Column:
    """DAT-07: event year - built year; outside [min_age, max_age] -> NULL."""
    age = col_(event_year).cast("double") - col_(built_year).cast("double")
    if min_age is not None:
        age = F.when(age >= float(min_age), age)
    if max_age is not None:
        age = F.when(age <= float(max_age), age)
    return age
