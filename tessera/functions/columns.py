"""Column expressions (all JVM-side, inside whole-stage codegen)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_SECOND = 1_000_000
SECONDS_PER_DAY = 86_400


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def member_array(col: str | Column, sep: str = ",") -> Column:
    """H1: split a delimited list, trim every item, drop empty items (order kept)."""
    items = F.transform(F.split(_c(col), sep), lambda x: F.trim(x))
    return F.filter(items, lambda x: x != F.lit(""))


def normalise_list(col: str | Column, sep: str = ",") -> Column:
    """H1: canonical text of a list: sorted items joined by ``sep``."""
    return F.array_join(F.array_sort(member_array(col, sep)), sep)


def pad2(col: str | Column) -> Column:
    """H2: two-character key from a number (``lpad`` truncates longer values)."""
    return F.lpad(_c(col).cast("string"), 2, "0")


def prefix2(col: str | Column) -> Column:
    """H2: first two characters of a code."""
    return F.substring(_c(col), 1, 2)


def clean_code(col: str | Column) -> Column:
    """H3: null → 'None', drop double quotes, strip all surrounding whitespace."""
    text = F.coalesce(_c(col).cast("string"), F.lit("None"))
    return F.regexp_replace(F.regexp_replace(text, '"', ""), r"^\s+|\s+$", "")


def from_epoch_us(col: str | Column) -> Column:
    """H5: epoch microseconds → timestamp (UTC session)."""
    return F.timestamp_micros(_c(col))


def epoch_us_text(col: str | Column, fmt: str = "dd/MM/yyyy") -> Column:
    """H5: epoch microseconds → formatted date text."""
    return F.date_format(F.timestamp_micros(_c(col)), fmt)


def years_to(col_us: str | Column, as_of_us: int, year_days: float = 365.0) -> Column:
    """H6: years from ``as_of`` to an epoch-µs date (negative = past)."""
    seconds = (_c(col_us) - F.lit(as_of_us)) / F.lit(float(MICROS_PER_SECOND))
    return seconds / F.lit(year_days * SECONDS_PER_DAY)


def outcome(perc: str | Column, threshold: str | Column) -> Column:
    """``OK`` when perc <= threshold; null perc or threshold → ``KO``."""
    return F.when(_c(perc) <= _c(threshold), F.lit("OK")).otherwise(F.lit("KO"))


def int_div(num: Column, den: Column) -> Column:
    """Exact division of integers, null where ``den`` is 0 (``div`` on decimal(38,0), so nothing overflows or rounds)."""
    wide = "decimal(38,0)"
    return F.call_function("div", num.cast(wide), F.nullif(den, F.lit(0)).cast(wide))


def percent_half_up(part: str | Column, whole: str | Column) -> Column:
    """round(100 * part / whole, 2), half-up, computed exactly in integers.

    Null when ``whole <= 0``. ``floor((20000 * p + w) / (2 * w))`` is the exact
    half-up rounding of ``10000 * p / w`` for non-negative integers, so no
    intermediate decimal or double rounding can move a .005 edge.
    """
    p = _c(part).cast("bigint").cast("decimal(20,0)")
    w = _c(whole).cast("bigint").cast("decimal(20,0)")
    hundredths = int_div(p * F.lit(20000) + w, w * F.lit(2))
    return F.when(w > 0, hundredths / F.lit(100.0))


def to_long_or_zero(col: str | Column) -> Column:
    """Numeric text → bigint; anything non-numeric (or null) → 0."""
    text = _c(col)
    return F.coalesce(text.try_cast("bigint"), text.try_cast("decimal(38,6)").try_cast("bigint"),
                      text.try_cast("double").try_cast("bigint"), F.lit(0).cast("bigint"))


def origin_code(col: str | Column) -> Column:
    """Part after the first ``_``, upper-cased; '' and 'CL' count as missing."""
    code = F.upper(F.element_at(F.split(_c(col), "_", 2), -1))
    return F.when(code.isin("", "CL"), F.lit(None).cast("string")).otherwise(code)
