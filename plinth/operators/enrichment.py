"""A third source of heights: map buildings, their nearest match, and their vote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.geometry import area, centroid, project
from plinth.functions.kernels import valid_udf
from plinth.operators.spatial_join import radius_join
from plinth.sources.overpass import way_points

#: Metres of a level, of the search and of an agreement, and the largest ratio of areas.
LEVEL_HEIGHT, RADIUS, AGREED, RATIO = 3.0, 20.0, 3.0, 3.0
MOST_LEVELS = 100.0

_NUMBER = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"


def as_number(text: Column) -> Column:
    """Plain decimal text as a double, all else null."""
    return F.when(text.rlike(_NUMBER), F.trim(text).try_cast("double"))


def map_buildings(elements: DataFrame) -> DataFrame:
    """`osm_id`, `osm_levels`, `osm_height_est`, `osm_building_type`, `geom` (degrees) of ways with levels in (0, 100], or levels that read `nan`.

    A way needs four known points, is closed if it isn't, and must be a valid polygon with an area.
    """
    text = F.col("tags")["building:levels"]
    levels = as_number(text)
    not_a_number = F.lower(F.trim(text)).isin("nan", "+nan", "-nan")
    ways = elements.where(F.col("type") == "way").where(not_a_number | (levels > 0) & (levels <= MOST_LEVELS))
    ways = ways.select(F.col("id").alias("osm_id"), levels.alias("osm_levels"), (levels * LEVEL_HEIGHT).alias("osm_height_est"), F.coalesce(F.col("tags")["building"], F.lit("yes")).alias("osm_building_type"))
    rings = way_points(elements).groupBy("id").agg(F.sort_array(F.collect_list(F.struct("pos", F.col("lon").alias("x"), F.col("lat").alias("y")))).alias("p")).where(F.size("p") >= 4)
    ring = F.transform("p", lambda q: F.struct(q["x"].alias("x"), q["y"].alias("y")))
    rings = rings.select("id", ring.alias("r"))
    closed = F.when(F.element_at("r", 1) == F.element_at("r", -1), F.col("r")).otherwise(F.concat("r", F.array(F.element_at("r", 1))))
    shaped = ways.join(rings.select(F.col("id").alias("osm_id"), F.array(F.array(closed)).alias("geom")), "osm_id")
    return shaped.where((area(F.col("geom")) > 0) & valid_udf("geom"))


def measured(shapes: DataFrame) -> DataFrame:
    """Map buildings with `cx`, `cy` and `area` in metres."""
    made = shapes.withColumn("_g", project(F.col("geom")))
    return made.withColumn("_c", centroid(F.col("_g"))).select(*shapes.columns, F.col("_c.x").alias("cx"), F.col("_c.y").alias("cy"), area(F.col("_g")).alias("area"))


def nearest_map_building(buildings: DataFrame, shapes: DataFrame) -> DataFrame:
    """`buildings` (`component_id`, `cx`, `cy`, `area`) with `osm_id`, `osm_levels`, `osm_height_est` of the nearest of a like area within the radius; the smaller id of two as near. A building without area has none."""
    near = radius_join(buildings.select("component_id", "cx", "cy", "area"), shapes.select("osm_id", "osm_levels", "osm_height_est", "cx", "cy", "area"), RADIUS)
    like = (F.col("b_area") <= 0) | (F.greatest("a_area", "b_area") <= RATIO * F.least("a_area", "b_area"))
    near = near.where((F.col("a_area") > 0) & like)
    best = near.groupBy(F.col("a_component_id").alias("component_id")).agg(F.min_by(F.struct("b_osm_id", "b_osm_levels", "b_osm_height_est"), F.struct("distance", "b_osm_id")).alias("m"))
    best = best.select("component_id", F.col("m.b_osm_id").alias("osm_id"), F.col("m.b_osm_levels").alias("osm_levels"), F.col("m.b_osm_height_est").alias("osm_height_est"))
    return buildings.join(best, "component_id", "left")


def third_vote(buildings: DataFrame) -> DataFrame:
    """Near agreement confirms a confidence; where estimates conflict and nothing confirms them, the map's height is taken."""
    known = F.col("osm_height_est").isNotNull() & F.col("height_final").isNotNull()
    agreed = known & (F.abs(F.col("height_final") - F.col("osm_height_est")) < AGREED)
    rows = buildings.withColumn("height_confidence", F.when(agreed, F.concat("height_confidence", F.lit("_osm_confirmed"))).otherwise(F.col("height_confidence")))
    taken = (F.col("height_confidence") == "low_conflicting") & F.col("osm_height_est").isNotNull()
    rows = rows.withColumn("_taken", F.coalesce(taken, F.lit(False)))
    return rows.withColumns({
        "height_final": F.when(F.col("_taken"), F.col("osm_height_est")).otherwise(F.col("height_final")),
        "height_source": F.when(F.col("_taken"), "resolved_by_osm").otherwise(F.col("height_source")),
        "height_confidence": F.when(F.col("_taken"), "resolved_by_osm").otherwise(F.col("height_confidence")),
    }).drop("_taken")


def map_agreement(buildings: DataFrame) -> DataFrame:
    """One row: compared buildings, those less than 3 and 6 metres apart with their shares, mean and median difference."""
    rows = buildings.where("osm_height_est is not null and height_final is not null").select(F.abs(F.col("height_final") - F.col("osm_height_est")).alias("d"))
    n = F.count("*")
    below = [x for m in (3, 6) for k in [F.count(F.when(F.col("d") < m, 1))] for x in (k.alias(f"n_below_{m}"), F.bround(k * 100.0 / n, 1).alias(f"pct_below_{m}"))]
    return rows.agg(n.alias("n"), *below, F.bround(F.avg("d"), 2).alias("mean_diff"), F.bround(F.median("d"), 2).alias("median_diff"))
