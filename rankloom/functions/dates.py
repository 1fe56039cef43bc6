"""Date and timestamp expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

TS_FORMAT = "yyyy-MM-dd HH:mm:ss"


def parse_seconds(col: Column | str) -> Column:
    """Parse ``yyyy-MM-dd HH:mm:ss[.fraction]``, cutting the fraction.

    The result carries no time zone, so it does not depend on the session's.
    """
    return F.to_timestamp_ntz(F.substring_index(col, ".", 1), F.lit(TS_FORMAT))


def shift_date(col: Column | str, days: int) -> Column:
    """``date + days`` on text; '' passes through and ``a:b`` uses ``b``."""
    text = F.col(col) if isinstance(col, str) else col
    last = F.substring_index(text, ":", -1)
    shifted = F.date_format(F.date_add(F.to_date(F.nullif(last, F.lit("")), "yyyy-MM-dd"), days), "yyyy-MM-dd")
    return F.when(text == "", text).otherwise(shifted)


def day_range(start: Column, end: Column) -> Column:
    """Inclusive list of days, empty when the range is reversed."""
    forward = F.sequence(start, F.greatest(start, end))
    return F.when(start <= end, forward).otherwise(F.array().cast("array<date>"))


def shift_day(text: str, days: int) -> str:
    """Driver-side counterpart of :func:`shift_date` for job arguments."""
    if text == "":
        return text
    day = dt.date.fromisoformat(text.split(":")[-1])
    return (day + dt.timedelta(days=days)).isoformat()
