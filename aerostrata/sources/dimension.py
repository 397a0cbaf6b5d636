"""The city dimension."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aerostrata.schemas import DIMENSION


def city_dimension(
    spark: SparkSession, rows: Iterable[tuple[str, float, float, str]]
) -> DataFrame:
    """A dimension from literal (city, lat, lon, country) rows, upper-case city."""
    return spark.createDataFrame(list(rows), DIMENSION)


def unique_cities(dimension: DataFrame) -> DataFrame:
    """One row per city, so that enriching never multiplies rows."""
    others = [c for c in dimension.columns if c != "city"]
    return dimension.groupBy("city").agg(*[F.max(c).alias(c) for c in others])
