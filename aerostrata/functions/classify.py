"""Air-quality bands as native expressions, for DataFrame code and for SQL."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Inclusive upper bound, category and risk score of each band; the last is open.
BANDS = (
    (50, "Good", 0.1),
    (100, "Moderate", 0.3),
    (150, "Unhealthy", 0.6),
    (200, "Very Unhealthy", 0.8),
)
ABOVE_BANDS = ("Hazardous", 1.0)

CATEGORIES = (*(name for _, name, _ in BANDS), ABOVE_BANDS[0])


def _banded(aqi: Column, values: list, above: object) -> Column:
    """The value of the first band whose bound is not exceeded."""
    bounds = [bound for bound, _, _ in BANDS]
    return reduce(
        lambda rest, band: F.when(aqi <= band[0], F.lit(band[1])).otherwise(rest),
        list(zip(bounds, values))[::-1],
        F.lit(above),
    )


def aqi_category(aqi: Column) -> Column:
    """Category name; a null index falls through to the open band."""
    return _banded(aqi, [name for _, name, _ in BANDS], ABOVE_BANDS[0])


def aqi_risk_score(aqi: Column) -> Column:
    """Risk between 0 and 1; null for a null index."""
    score = _banded(aqi, [risk for _, _, risk in BANDS], ABOVE_BANDS[1])
    return F.when(aqi.isNotNull(), score)


def register_sql_functions(spark: SparkSession) -> None:
    """Make ``aqi_category(n)`` and ``aqi_risk_score(n)`` callable from SQL.

    SQL-defined functions are inlined by the optimizer, so they cost no more than the text.
    """
    names = " ".join(f"WHEN aqi <= {bound} THEN '{name}'" for bound, name, _ in BANDS)
    risks = " ".join(f"WHEN aqi <= {bound} THEN {risk}D" for bound, _, risk in BANDS)
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION aqi_category(aqi INT) RETURNS STRING "
        f"RETURN CASE {names} ELSE '{ABOVE_BANDS[0]}' END"
    )
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION aqi_risk_score(aqi INT) RETURNS DOUBLE "
        f"RETURN CASE WHEN aqi IS NULL THEN NULL {risks} ELSE {ABOVE_BANDS[1]}D END"
    )
