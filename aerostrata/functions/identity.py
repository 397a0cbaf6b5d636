"""Deterministic document ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator, digest length and the suffix of each document family.
SEPARATOR = "_"
DIGEST_BITS = 256
PIVOT = "pivot"
HOURLY = "hourly"
PM25 = "pm25"
WEATHER_PAIRS = "corr"


def document_id(city: Column, moment: Column, family: str | None = None) -> Column:
    """SHA-256 over city, time text and family, so that a re-run addresses the same document.

    The time text is the session's, hence UTC. The city must not be null: null parts are skipped.
    """
    parts = [city, moment.cast("string")]
    if family is not None:
        parts.append(F.lit(family))
    return F.sha2(F.concat_ws(SEPARATOR, *parts), DIGEST_BITS)
