"""Which regions a grid cell lies in, by equal tiles in place of a comparison of all pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from frostline.session import Stage, materialise

TILE_DEGREES = 1.0


def region_tiles(regions: DataFrame, tile: float = TILE_DEGREES) -> DataFrame:
    """Tiles that each region's box touches: region, the box's bounds, tile_lat and tile_lon.

    ``regions`` has region, lat_min, lat_max, lon_min and lon_max, bounds included. A box whose western
    bound is the larger crosses the date line and is taken as its two sides.
    """
    bounds = lambda west, east: F.struct(west.alias("west"), east.alias("east"))
    west, east = F.col("lon_min").cast("double"), F.col("lon_max").cast("double")
    sides = F.when(west <= east, F.array(bounds(west, east))).otherwise(F.array(bounds(west, F.lit(180.0)), bounds(F.lit(-180.0), east)))
    boxes = regions.select("region", F.col("lat_min").cast("double").alias("south"), F.col("lat_max").cast("double").alias("north"), F.explode(sides).alias("side"))
    boxes = boxes.select("region", "south", "north", "side.west", "side.east")
    tiles = lambda low, high: F.explode(F.sequence(F.floor(F.col(low) / tile), F.floor(F.col(high) / tile)))
    return boxes.where("south <= north").withColumn("tile_lat", tiles("south", "north")).withColumn("tile_lon", tiles("west", "east"))


def assign_regions(cells: DataFrame, regions: DataFrame, lat: str = "lat", lon: str = "lon", tile: float = TILE_DEGREES,
                   stage: Stage = materialise) -> DataFrame:
    """Rows of ``cells`` once for every region that holds them, with ``region`` added; rows outside all regions go.

    A cell lies in one tile, so it meets a box once; the exact bounds decide after the equi-join. The tile
    table is staged: while it is small, cells are not moved.
    """
    tiles = stage(region_tiles(regions, tile), "region-tiles")
    placed = cells.withColumn("tile_lat", F.floor(F.col(lat) / tile)).withColumn("tile_lon", F.floor(F.col(lon) / tile))
    inside = F.col(lat).between(F.col("south"), F.col("north")) & F.col(lon).between(F.col("west"), F.col("east"))
    found = placed.join(tiles, ["tile_lat", "tile_lon"]).where(inside).drop("tile_lat", "tile_lon", "south", "north", "west", "east")
    # the two sides of a box meet at a cell on the date line itself only if it is written in both ways
    return found
