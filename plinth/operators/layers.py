"""Map layers as tables: hexagons, districts, landmarks, zones."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.geometry import equirectangular, project_point

#: Places of reference (degrees), heights and radii (metres).
DISTRICTS = (
    ("Приморский", 60.00, 30.25),
    ("Василеостровский", 59.94, 30.27),
    ("Центральный", 59.93, 30.35),
    ("Адмиралтейский", 59.92, 30.30),
    ("Выборгский", 60.03, 30.35),
    ("Московский", 59.85, 30.32),
    ("Петроградский", 59.96, 30.30),
    ("Калининский", 60.03, 30.40),
    ("Красногвардейский", 59.95, 30.48),
    ("Невский", 59.88, 30.45),
    ("Кировский", 59.85, 30.25),
    ("Фрунзенский", 59.87, 30.39),
)
LANDMARKS = (
    ("Лахта Центр", 59.9871, 30.1777, 462.0),
    ("Исаакиевский собор", 59.9340, 30.3063, 101.5),
    ("Петропавловский собор", 59.9503, 30.3164, 122.5),
    ("Казанский собор", 59.9343, 30.3245, 71.6),
    ("Адмиралтейство", 59.9375, 30.3086, 72.5),
    ("Смольный собор", 59.9486, 30.3956, 93.7),
    ("Телебашня", 59.9856, 30.3153, 326.0),
)
ZONES = (
    ("Высотная застройка", 60.00, 30.25, 3000.0),
    ("Высотная застройка", 60.03, 30.35, 2500.0),
    ("Историческая застройка", 59.935, 30.32, 2000.0),
    ("Промзоны", 59.88, 30.48, 2000.0),
    ("Промзоны", 59.85, 30.25, 2000.0),
)
#: Metres from a hexagon's centre to a corner: the area of 0.737 square kilometres that cells of eighth resolution have.
HEX_SIZE = 532.6
CAP_HEX, CAP_DISTRICT = 50.0, 40.0


def hexagon(x: Column, y: Column, size: float = HEX_SIZE) -> Column:
    """`q` and `r`, the axial coordinates of the pointed-top hexagon of a plane grid that holds a point in metres.

    These aren't the cells of a global index, which isn't at hand here; their areas are alike.
    """
    q, r = (math.sqrt(3) / 3 * x - y / 3) / size, 2 * y / (3 * size)
    s = -q - r
    rq, rr, rs = F.rint(q), F.rint(r), F.rint(s)
    dq, dr, ds = F.abs(rq - q), F.abs(rr - r), F.abs(rs - s)
    return F.struct(F.when((dq > dr) & (dq > ds), -rr - rs).otherwise(rq).cast("long").alias("q"), F.when(~((dq > dr) & (dq > ds)) & (dr > ds), -rq - rs).otherwise(rr).cast("long").alias("r"))


def hexagon_centre(q: Column, r: Column, size: float = HEX_SIZE) -> Column:
    return F.struct((size * math.sqrt(3) * (q + r / 2)).alias("x"), (size * 1.5 * r).alias("y"))


def hex_layer(buildings: DataFrame, size: float = HEX_SIZE) -> DataFrame:
    """Per hexagon of known heights: mean, median, largest, count, and the mean capped for the colour scale."""
    cell = hexagon(F.col("cx"), F.col("cy"), size)
    rows = buildings.where("height_final is not null and cx is not null").select(cell.alias("cell"), "height_final").select("cell.q", "cell.r", "height_final")
    h = F.col("height_final")
    return rows.groupBy("q", "r").agg(F.avg(h).alias("mean_height"), F.median(h).alias("median_height"), F.max(h).alias("max_height"), F.count("*").alias("n")).withColumn("colour", F.least("mean_height", F.lit(CAP_DISTRICT)))


def heat_points(buildings: DataFrame) -> DataFrame:
    """`lat`, `lon` and the capped height of positive heights."""
    return buildings.where("height_final > 0").select("lat", "lon", F.least("height_final", F.lit(CAP_HEX)).alias("weight"))


def district(buildings: DataFrame, lat: float, lon: float, radius: float) -> DataFrame:
    """Buildings whose centre lies at most `radius` metres from a place in degrees, with the capped height as `colour`."""
    centre = project_point(F.lit(lon), F.lit(lat))
    dx, dy = F.col("cx") - centre["x"], F.col("cy") - centre["y"]
    return buildings.where(F.sqrt(dx * dx + dy * dy) <= radius).withColumn("colour", F.least("height_final", F.lit(CAP_HEX)))


def district_stats(rows: DataFrame) -> DataFrame:
    """One row: count, mean, median, largest height and drawn polygon parts."""
    h = F.col("height_final")
    return rows.agg(F.count("*").alias("n"), F.bround(F.avg(h), 1).alias("mean"), F.bround(F.median(h), 1).alias("median"), F.bround(F.max(h), 1).alias("max"), F.coalesce(F.sum("n_parts"), F.lit(0)).alias("n_parts"))


def near(points: DataFrame, lat: float, lon: float, radius: float | None) -> DataFrame:
    """Points (`lat`, `lon` in degrees) with known places at most `radius` metres away; all of them without a radius."""
    known = points.where("lat is not null and lon is not null")
    return known if radius is None else known.where(equirectangular(F.col("lat"), F.col("lon"), lat, lon) <= radius)


def districts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(DISTRICTS), "name string, lat double, lon double")


def landmarks(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LANDMARKS), "name string, lat double, lon double, height double")


def zones(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(ZONES), "name string, lat double, lon double, radius double")
