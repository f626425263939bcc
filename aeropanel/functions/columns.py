"""Column -> Column helpers; all are plain Catalyst expressions."""

from __future__ import annotations

from functools import reduce
from itertools import pairwise

from pyspark.sql import Column
from pyspark.sql import functions as F

from aeropanel.schema import (
    CATEGORIES,
    CATEGORY_NAMES,
    CONCENTRATION_EDGES,
    INDEX_EDGES,
    INDEX_POLLUTANTS,
    MIN_POLLUTANTS,
    NO_INDEX,
    SEASON_MONTHS,
    display_name,
)


def mean(col: Column | str, digits: int) -> Column:
    return F.round(F.avg(col), digits)


def mean_where(cond: Column, col: str, digits: int) -> Column:
    return F.round(F.avg(F.when(cond, F.col(col))), digits)


def count_where(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def between_dates(window: tuple[str, str], col: str = "Date") -> Column:
    """Both ends inclusive; the bounds are cast once so the filter reaches the scan."""
    return F.col(col).between(*(F.lit(d).cast("date") for d in window))


def reading(col: str) -> Column:
    """A usable reading: negative values, NaN and text that is no number become null."""
    value = f"TRY_CAST(`{col}` AS DOUBLE)"
    return F.expr(f"CASE WHEN {value} >= 0 AND NOT isnan({value}) THEN {value} END")


def season(month: Column | str = "Month") -> Column:
    month = F.col(month) if isinstance(month, str) else month
    named = reduce(lambda cases, s: cases.when(month.isin(*s[1]), F.lit(s[0])), SEASON_MONTHS.items(), F)
    return named.otherwise(F.lit("Post-Monsoon"))


def nice_date(col: Column | str) -> Column:
    return F.date_format(col, "d MMM yyyy")


def category(col: str) -> Column:
    """Name of the band the value falls in; null stays null."""
    bands = " ".join(f"WHEN `{col}` <= {hi} THEN '{name}'" for _, name, hi, _ in CATEGORIES if hi is not None)
    return F.expr(f"CASE {bands} WHEN `{col}` IS NOT NULL THEN '{CATEGORY_NAMES[-1]}' END")


def category_or_none(col: str) -> Column:
    return F.coalesce(category(col), F.lit(NO_INDEX))


def sub_index(col: str, pollutant: str) -> Column:
    """Straight line inside the band that holds the value, which must not be null.

    Upper edges belong to their band; the last band has no upper end, so its line goes on.
    """
    def line(c_lo: int, i_lo: int, c_hi: int, i_hi: int) -> str:
        rise = f"{f'(`{col}` - {c_lo})' if c_lo else f'`{col}`'} * {i_hi - i_lo} / {c_hi - c_lo}"
        return f"{i_lo}D + {rise}" if i_lo else rise

    corners = pairwise(zip(CONCENTRATION_EDGES[pollutant], INDEX_EDGES, strict=True))
    *closed, (_, top) = [(hi[0], line(*lo, *hi)) for lo, hi in corners]
    bands = " ".join(f"WHEN `{col}` <= {c_hi} THEN {text}" for c_hi, text in closed)
    return F.expr(f"CASE {bands} ELSE {top} END")


def is_valid_index() -> Column:
    """Enough pollutants were measured, and one of them is a particulate."""
    measured = sum((F.col(p).isNotNull().cast("int") for p in INDEX_POLLUTANTS), F.lit(0))
    return (measured >= MIN_POLLUTANTS) & (F.col("PM25").isNotNull() | F.col("PM10").isNotNull())


def whole(value: Column) -> Column:
    """Nearest whole number, halves up; `F.round` goes through decimals for every row."""
    return F.floor(value + 0.5).cast("double")


def round_rows(value: str, digits: int) -> Column:
    """`round` for a column or SQL expression that is rounded row by row; equal to it for every value.

    `round` goes through decimals, which costs more than the index itself. Away from a tie plain arithmetic
    finds the same nearest number, so only values near a tie, or too large to tell, take the slow way.
    """
    scaled = f"(({value}) * 1e{digits}D)"
    plain = f"abs({scaled}) < 1e7D AND abs({scaled} - floor({scaled}) - 0.5D) > 1e-6D"
    return F.expr(f"CASE WHEN {plain} THEN floor({scaled} + 0.5D) / 1e{digits}D ELSE round({value}, {digits}) END")


def index_value(rounded: Column) -> Column:
    """Largest sub-index as a whole number; rounding keeps order, so it may come first."""
    return F.when(is_valid_index(), F.array_max(rounded))


def dominant(rounded: Column, index: Column) -> Column:
    """First pollutant, in table order, whose rounded sub-index equals the index.

    This is not the largest sub-index: 49.5 and 50.4 both round to 50 and the earlier name wins.
    """
    names = F.array(*(F.lit(display_name(p)) for p in INDEX_POLLUTANTS))
    return F.get(names, F.array_position(rounded, index).cast("int") - 1)


def pct_change(before: Column, after: Column, digits: int = 0) -> Column:
    """Change in percent of `before`; null when either is missing or `before` is zero."""
    return F.round((after - before) / F.nullif(before, F.lit(0.0)) * 100, digits)


def local_hour(col: Column | str, tz: str) -> Column:
    """UTC instant -> start of its hour on the clock of `tz`."""
    return F.date_trunc("hour", F.from_utc_timestamp(col, tz))
