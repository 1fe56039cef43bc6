"""String expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _literal(delim: str) -> str:
    return r"\Q" + delim + r"\E"


def split_on(col: Column | str, delim: str) -> Column:
    """Split on a literal delimiter, keeping trailing empty fields."""
    return F.split(col, _literal(delim), -1)


def split_pick(col: Column | str, delim: str, index: int) -> Column:
    """The ``index``-th field (0-based); NULL when the line is too short."""
    return F.get(split_on(col, delim), F.lit(index))


def token_list(col: Column | str, delim: str = ",") -> Column:
    """Split a list field and remove empty tokens."""
    return F.filter(split_on(col, delim), lambda t: t != F.lit(""))


def strip_spaces(col: Column | str) -> Column:
    return F.replace(F.col(col) if isinstance(col, str) else col, F.lit(" "), F.lit(""))


def is_nonblank(col: Column | str) -> Column:
    """True when something other than spaces is left."""
    return strip_spaces(col) != F.lit("")


def drop_first_char(col: Column) -> Column:
    return F.substring(col, 2, 2147483647)


def drop_last_char(col: Column) -> Column:
    return F.left(col, F.greatest(F.length(col) - 1, F.lit(0)))


def strip_brackets(col: Column) -> Column:
    """Remove one character at each end."""
    return drop_last_char(drop_first_char(col))


def pair_token(target: Column, item: Column) -> Column:
    """``target,item`` cross token."""
    return F.concat(target, F.lit(","), item)


def field_token(field: str, token: Column) -> Column:
    """``field_token`` serving key."""
    return F.concat(F.lit(field + "_"), token)


def list_text(arr: Column, sep: str = ", ") -> Column:
    """List without brackets: ``1, 2, 3``."""
    return F.array_join(F.transform(arr, lambda x: x.cast("string")), sep)


def trim_decimal(col: Column, digits: int = 6) -> Column:
    """Fixed decimals, then no trailing zeros and no bare dot."""
    return F.regexp_replace(F.format_string(f"%.{digits}f", col.cast("double")), r"\.?0+$", "")


def blank_to_null(col: Column | str) -> Column:
    return F.nullif(F.col(col) if isinstance(col, str) else col, F.lit(""))


def to_double(col: Column | str, missing: float | None = None) -> Column:
    """Text to double, blank counts as missing.

    A text that is neither blank nor a number raises, as a typo in the data
    must not turn silently into a missing value.
    """
    value = blank_to_null(col).cast("double")
    return value if missing is None else F.coalesce(value, F.lit(missing))
