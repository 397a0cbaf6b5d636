"""Raw JSON lines by kind and arrival hour."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerostrata.schemas import Kind
from aerostrata.sources.tables import absent_as_none

CORRUPT = "_corrupt_record"


@dataclass(frozen=True)
class HourScope:
    """One arrival hour; ``None`` in its place means everything that has landed."""

    year: int
    month: int
    day: int
    hour: int

    @classmethod
    def of(cls, year=None, month=None, day=None, hour=None) -> HourScope | None:
        """The hour if all four parts are given, no scope if none is."""
        parts = (year, month, day, hour)
        if all(p is None for p in parts):
            return None
        if any(p is None for p in parts):
            raise ValueError("give year, month, day and hour together, or none of them")
        return cls(*(int(p) for p in parts))


def raw_path(root: str, kind: Kind, scope: HourScope | None = None) -> str:
    """Glob over ``<root>/<folder>/YYYY/MM/DD/HH``, plain or in ``year=YYYY/...`` form."""
    levels = ["*"] * 4
    if scope is not None:
        texts = (f"{scope.year:04d}", f"{scope.month:02d}", f"{scope.day:02d}", f"{scope.hour:02d}")
        names = ("year", "month", "day", "hour")
        levels = [f"{{{text},{name}={text}}}" for name, text in zip(names, texts)]
    return "/".join([root.rstrip("/"), kind.folder, *levels])


def read_lines(
    spark: SparkSession, root: str, kind: Kind, scope: HourScope | None = None
) -> DataFrame | None:
    """Text lines of one kind in ``value``, blank lines left out; None if nothing has landed."""
    lines = absent_as_none(lambda: spark.read.text(raw_path(root, kind, scope)))
    return None if lines is None else lines.filter(F.trim("value") != "")


def arriving_lines(spark: SparkSession, root: str, kind: Kind, max_files: int | None = None) -> DataFrame:
    """A stream of the text lines of one kind in ``value``; its checkpoint knows the files it has read.

    Files of any age count, so that one landed late is read, too.
    """
    reader = spark.readStream.option("maxFileAge", "36500d")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(raw_path(root, kind)).select("value").filter(F.trim("value") != "")


def parsed_record(value: Column, schema: T.StructType) -> Column:
    """The record of a JSON text; text that does not fit the schema is kept in the corrupt field."""
    extended = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    return F.from_json(value, extended, options)


def record_texts(lines: DataFrame) -> DataFrame:
    """The text of each record: a line is one, or a JSON array of several; a broken array is one broken record."""
    value = F.col("value")
    several = F.coalesce(F.from_json(value, "array<string>"), F.array(value))
    return lines.select(F.explode(F.when(F.ltrim(value).startswith("["), several).otherwise(F.array(value))).alias("value"))


def parse_lines(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema plus the corrupt text, one row per record.

    Going through ``inline`` parses each line once. Selecting the fields of ``from_json`` directly
    would let filters on them be pushed below the projection and repeat the parsing there.
    """
    return record_texts(lines).select(F.inline(F.array(parsed_record(F.col("value"), schema))))


def well_formed(lines: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of the schema for the records that fit it.

    Every field is checked whatever the query selects, so a count and a projection agree.
    """
    record = parsed_record(F.col("value"), schema)
    fitting = F.filter(F.array(record), lambda r: r.isNotNull() & r[CORRUPT].isNull())
    return record_texts(lines).select(F.inline(fitting)).drop(CORRUPT)


def read_raw(
    spark: SparkSession, root: str, kind: Kind, scope: HourScope | None = None
) -> DataFrame | None:
    """Well-formed records of one kind; None if nothing has landed in the scope."""
    lines = read_lines(spark, root, kind, scope)
    return None if lines is None else well_formed(lines, kind.schema)
