"""Rendering of numbers, as Python's and DuckDB's format show them: money and shares to the nearest of the exact double, with
halves to even. Where the shown decimal is rounded before it is formatted (`away`), its halves go away from zero; so do
those of percents. Digits that a double beyond 2^53 has after its shortest form are zeros."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NONE = "—"


def rounded(val: Column) -> Column:
    """To a whole number, halves away from zero. What becomes zero keeps its sign, which Spark's round drops."""
    return F.when(F.abs(val) < 0.5, val * 0.0).otherwise(F.round(val))


def plain(val: Column, places: int = 0) -> Column:
    """'1,234' or '1,234.5', 'nan', 'inf'; null for null."""
    return F.replace(F.replace(F.format_number(val, places), F.lit("NaN"), F.lit("nan")), F.lit("∞"), F.lit("inf"))


def _tenths(val: Column, away: bool) -> Column:
    """With one decimal. Scaled first, then rounded: a decimal rounding of the value itself takes other doubles for halves."""
    return plain(rounded(val * 10) / 10 if away else val, 1)


def money(val: Column, away: bool = False) -> Column:
    """'$1.2B', '$35M', '1,234', or a dash for null; `away`: half a tenth of a billion goes away from zero, not to even."""
    size = F.abs(val)
    billions = F.concat(F.lit("$"), _tenths(val / 1e9, away), F.lit("B"))
    millions = F.concat(F.lit("$"), plain(val / 1e6), F.lit("M"))
    return F.when(val.isNull(), NONE).when(size >= 1e9, billions).when(size >= 1e6, millions).otherwise(plain(val))


def percent(val: Column, signed: bool = False) -> Column:
    return F.when(val.isNull(), NONE).otherwise(F.format_string("%+.1f%%" if signed else "%.1f%%", val))


def shares(val: Column, away: bool = False) -> Column:
    """'1.2M', '1,234', or a dash for null; `away`: half a tenth of a million goes away from zero, not to even."""
    return F.when(val.isNull(), NONE).when(F.abs(val) >= 1e6, F.concat(_tenths(val / 1e6, away), F.lit("M"))).otherwise(plain(val))
