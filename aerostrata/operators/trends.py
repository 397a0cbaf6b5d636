"""Day-over-day change per city."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Growth in percent beyond which a day counts as changed, and the status names.
CHANGE_PERCENT = 10
WORSENING, IMPROVING, STABLE = "WORSENING", "IMPROVING", "STABLE"


def with_previous_day(daily: DataFrame) -> DataFrame:
    """Add the average of the city's previous existing day, whatever the gap.

    The window holds one row per day and city, so even a century of one city fits one task.
    """
    by_date = Window.partitionBy("city").orderBy("date")
    return daily.withColumn("prev_day_pm25", F.lag("pm25_avg", 1).over(by_date))


def growth_percent(now: Column, before: Column) -> Column:
    """Change in percent, null without a previous value or if that value is zero."""
    return F.round(F.try_divide(now - before, before) * 100, 2)


def trend_status(growth: Column) -> Column:
    """Status of a change; null growth is stable."""
    return (
        F.when(growth > CHANGE_PERCENT, WORSENING)
        .when(growth < -CHANGE_PERCENT, IMPROVING)
        .otherwise(STABLE)
    )


def with_trend(daily: DataFrame) -> DataFrame:
    """Daily rows with ``growth_pct`` and ``trend_status``."""
    growth = growth_percent(F.col("pm25_avg"), F.col("prev_day_pm25"))
    return (
        with_previous_day(daily)
        .withColumn("growth_pct", growth)
        .withColumn("trend_status", trend_status(F.col("growth_pct")))
        .drop("prev_day_pm25")
    )


def in_period(df: DataFrame, year: int, month: int, day: int | None = None) -> DataFrame:
    """Rows of one month or day. Apply after ``with_trend``: the first day needs its predecessor."""
    test = (F.col("year") == year) & (F.col("month") == month)
    if day is not None:
        test = test & (F.col("day") == day)
    return df.filter(test)
