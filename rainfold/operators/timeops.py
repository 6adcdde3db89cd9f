"""Seasonal windows and year labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def mmdd(date: Column | str) -> Column:
    return F.month(date) * 100 + F.dayofmonth(date)


def code(day: str) -> int:
    return int(day.replace("-", ""))


def in_season(date: Column | str, start: str, end: str) -> Column:
    """Whether the day lies in the MM-DD window, which may cross the year's end."""
    d, a, b = mmdd(date), code(start), code(end)
    return (d >= a) & (d <= b) if a <= b else (d >= a) | (d <= b)


def season_year(date: Column | str, start: str, end: str, label: str = "start") -> Column:
    """Year of a window that crosses the year's end: that of its ``start`` or its ``end``."""
    crosses = code(end) < code(start)
    if not crosses:
        return F.year(date)
    return F.when(mmdd(date) <= code(end), F.year(date) - 1).otherwise(F.year(date)) if label == "start" else F.when(mmdd(date) >= code(start), F.year(date) + 1).otherwise(F.year(date))


def with_windows(df: DataFrame, date: str, windows: dict[int, tuple[str, str]]) -> DataFrame:
    """A row for each window that holds the day, with ``window``, ``window_year``, ``start_date`` and ``end_date``; one pass for all windows."""
    entries = []
    for w, (a, b) in windows.items():
        crosses = int(code(b) < code(a))
        year = season_year(date, a, b)
        entries.append(F.when(in_season(date, a, b), F.struct(
            F.lit(w).alias("window"), year.alias("window_year"),
            F.to_date(F.concat(year.cast("string"), F.lit(f"-{a}"))).alias("start_date"), F.to_date(F.concat((year + crosses).cast("string"), F.lit(f"-{b}"))).alias("end_date"))))
    return df.select("*", F.inline(F.array_compact(F.array(*entries))))


def levels(date: Column | str, fixed_days: int = 10) -> dict[str, Column]:
    """Time levels, as longs."""
    parts = {"dayofyear": F.dayofyear(date), "week": F.weekofyear(date), "month": F.month(date), "day": F.dayofmonth(date), "year": F.year(date), "fixed_days": F.floor((F.dayofyear(date) - 1) / fixed_days)}
    return {k: v.cast("long") for k, v in parts.items()}


def around_gap(df: DataFrame, a: str, b: str, gap: tuple[str, str]) -> DataFrame:
    """Date ranges with the part before the gap and the part after it."""
    before, after = F.date_sub(F.lit(gap[0]).cast("date"), 1), F.date_add(F.lit(gap[1]).cast("date"), 1)
    one = F.struct(F.lit(0).alias("part"), F.col(a).alias("from_date"), F.least(F.col(b), before).alias("to_date"))
    two = F.struct(F.lit(1).alias("part"), F.greatest(F.col(a), after).alias("from_date"), F.col(b).alias("to_date"))
    return df.select("*", F.inline(F.array(one, two))).where("from_date <= to_date")


def five_year_period(year: int, length: int = 30) -> tuple[int, int]:
    """The latest period of ``length`` years whose end is a multiple of five and lies before ``year``."""
    end = (year - 1) // 5 * 5
    return end - length, end
