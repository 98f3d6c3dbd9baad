"""Nearest place by great-circle distance: a descent through nested cells that hold places."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ampflow.functions.measures import haversine_km

EARTH_KM = 6371.0
# Cell sizes in degrees; every cell is split into 4 x 4 cells of the next size. The first make up 18 cells.
CELL_DEGREES = (60.0, 15.0, 3.75, 0.9375, 0.234375, 0.05859375, 0.0146484375)
SPLIT = 4


def _cell(lat: Column, lon: Column, size: float) -> tuple[Column, Column]:
    """Row and column of a coordinate; the pole and the date line belong to the last cells."""
    rows, columns = int(round(180 / size)), int(round(360 / size))
    row = F.least(F.floor((lat + 90) / size), F.lit(rows - 1))
    return row, F.least(F.floor((lon + 180) / size), F.lit(columns - 1))


def _occupied(places: DataFrame, size: float) -> DataFrame:
    """Cells that hold places, each with one of them as a witness of how far the nearest can be."""
    row, column = _cell(F.col("lat"), F.col("lon"), size)
    cells = places.select(row.alias("_row"), column.alias("_column"), "lat", "lon").groupBy("_row", "_column")
    witness = F.min_by("lon", "lat").alias("_lon_in")  # any longitude of those with the least latitude
    return cells.agg(F.min("lat").alias("_lat_in"), witness)


def _at_least_km(lat: Column, lon: Column, row: Column, column: Column, size: float) -> Column:
    """No point of the cell is closer: neither by latitude, nor across the cell's nearer meridian."""
    south, west = row * size - 90, column * size - 180
    by_latitude = F.radians(F.greatest(south - lat, lat - south - size, F.lit(0.0)))
    # Degrees east of the western edge; beyond the cell, the nearer of the two edges counts, at most a quarter turn.
    east = F.pmod(lon - west, F.lit(360.0))
    aside = F.when(east <= size, 0.0).otherwise(F.least(east - size, 360.0 - east, F.lit(90.0)))
    across = F.asin(F.cos(F.radians(lat)) * F.sin(F.radians(aside)))
    return F.lit(EARTH_KM * (1 - 1e-9)) * F.greatest(by_latitude, across) - F.lit(1e-6)


def nearest_place(points: DataFrame, places: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """``points`` with the nearest ``place`` and its ``distance_km``; both NULL for missing coordinates.

    ``places`` has columns place, lat, lon. Only distinct coordinates are searched. At every level a point keeps the
    occupied cells that could hold a place nearer than the nearest place it has met so far, and meets the occupied
    cells inside those at the next level. So a point far from everything follows a few cells down, as a near one does,
    and meets the places of the last cells only; the result is exact for all coordinates on the globe. Ties go to the
    alphabetically first place.
    """
    coordinates = (
        points.select(F.col(lat).alias("_lat"), F.col(lon).alias("_lon"))
        .where(F.col("_lat").isNotNull() & F.col("_lon").isNotNull())
        .distinct()
    )
    placed = places.groupBy("lat", "lon").agg(F.min("place").alias("place"))
    first = CELL_DEGREES[0]
    rows, columns = int(round(180 / first)), int(round(360 / first))
    start = [F.struct(F.lit(r).cast("long").alias("r"), F.lit(c).cast("long").alias("c")) for r in range(rows) for c in range(columns)]
    found = coordinates.withColumn("_cell", F.explode(F.array(*start)))
    found = found.select("_lat", "_lon", F.col("_cell.r").alias("_up_row"), F.col("_cell.c").alias("_up_column"))
    point = Window.partitionBy("_lat", "_lon")
    for i, size in enumerate(CELL_DEGREES):
        parents = SPLIT if i else 1
        cells = _occupied(placed, size).select(
            F.floor(F.col("_row") / parents).alias("_up_row"),
            F.floor(F.col("_column") / parents).alias("_up_column"),
            "*",
        )
        met = found.join(cells, ["_up_row", "_up_column"])
        reached = haversine_km(F.col("_lat"), F.col("_lon"), F.col("_lat_in"), F.col("_lon_in"))
        nearest = met.withColumn("_reached", F.min(reached).over(point))
        possible = _at_least_km(F.col("_lat"), F.col("_lon"), F.col("_row"), F.col("_column"), size)
        found = nearest.where(possible <= F.col("_reached")).select(
            "_lat", "_lon", F.col("_row").alias("_up_row"), F.col("_column").alias("_up_column")
        )
    row, column = _cell(F.col("lat"), F.col("lon"), CELL_DEGREES[-1])
    last = placed.select("place", "lat", "lon", row.alias("_up_row"), column.alias("_up_column"))
    distance = haversine_km(F.col("_lat"), F.col("_lon"), F.col("lat"), F.col("lon"))
    answers = (
        found.join(last, ["_up_row", "_up_column"])
        .withColumn("_km", distance)
        .groupBy("_lat", "_lon")
        .agg(F.min_by("place", F.struct("_km", "place")).alias("place"), F.min("_km").alias("distance_km"))
    )
    return points.join(
        answers, (F.col(lat) == F.col("_lat")) & (F.col(lon) == F.col("_lon")), "left"
    ).drop("_lat", "_lon")
