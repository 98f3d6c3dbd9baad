"""Small reference tables kept with the code."""

from __future__ import annotations

from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ampflow.session import local_table

CITY_MAP = "city_name_raw string, city_name_standardized string"
DATA = Path(__file__).resolve().parent.parent / "data"

# Own table of places: name, the city that a place counts towards, and approximate public coordinates.
PLACES = [
    ("Zurich", "Zurich", 47.37, 8.54),
    ("Dübendorf", "Zurich", 47.40, 8.62),
    ("Schlieren", "Zurich", 47.40, 8.45),
    ("Winterthur", "Winterthur", 47.50, 8.72),
    ("Basel", "Basel", 47.56, 7.59),
    ("Riehen", "Basel", 47.58, 7.65),
    ("Bern", "Bern", 46.95, 7.45),
    ("Ostermundigen", "Bern", 46.96, 7.49),
    ("Geneva", "Geneva", 46.20, 6.15),
    ("Carouge", "Geneva", 46.18, 6.14),
    ("Lausanne", "Lausanne", 46.52, 6.63),
    ("Renens", "Lausanne", 46.54, 6.59),
    ("Lucerne", "Lucerne", 47.05, 8.31),
    ("Emmen", "Lucerne", 47.08, 8.30),
    ("Lugano", "Lugano", 46.00, 8.95),
    ("Paradiso", "Lugano", 45.99, 8.94),
    ("St. Gallen", "St. Gallen", 47.42, 9.37),
    ("Gossau", "St. Gallen", 47.42, 9.25),
]


def _by_column(spark: SparkSession, names: tuple[str, ...], rows: list[tuple]) -> DataFrame:
    return local_table(spark, dict(zip(names, zip(*rows))))


def read_seed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV with declared column types; lines starting with ``#`` are comments."""
    return spark.read.schema(schema).option("header", True).option("comment", "#").csv(path)


def typed_lines(spark: SparkSession, lines: Sequence[str], schema: str) -> DataFrame:
    """As :func:`read_seed` for the lines of a file that only the driver has: parsed by Spark, as a local relation.

    A header that does not name the declared columns, or a line that does not fit them, is an error.
    """
    told = [line for line in lines if line.strip() and not line.startswith("#")]
    names = [part.split()[0] for part in schema.split(",")]
    if not told or told[0].strip().split(",") != names:
        raise ValueError(f"the header is {told[:1]}, the declared columns are {names}")
    rows = local_table(spark, {"line": [line.rstrip("\r\n") for line in told[1:]]})
    return rows.select(F.from_csv("line", schema, {"mode": "FAILFAST"}).alias("row")).select("row.*")


def city_map(spark: SparkSession) -> DataFrame:
    """The packaged spelling table; executors need no copy of the file."""
    return typed_lines(spark, (DATA / "city_name_mapping.csv").read_text(encoding="utf-8").splitlines(), CITY_MAP)


def places(spark: SparkSession) -> DataFrame:
    return _by_column(spark, ("place", "lat", "lon"), [(place, lat, lon) for place, _, lat, lon in PLACES])


def place_cities(spark: SparkSession) -> DataFrame:
    """Places that count towards a city of another name."""
    return _by_column(spark, ("place", "city"), [(place, city) for place, city, *_ in PLACES if place != city])
