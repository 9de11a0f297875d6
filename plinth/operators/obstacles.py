"""Obstacles to radio waves from map elements: towers, monuments, bridges, and their heights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.operators.enrichment import as_number
from plinth.sources.overpass import way_points

#: Kinds by tag, and heights of kinds without one.
STRUCTURES = ("tower", "mast", "chimney", "communications_tower", "crane")
MONUMENTS = ("monument", "memorial", "column")
HEIGHT_TAGS = ("height", "ele", "building:height")
DEFAULT_HEIGHTS = {"tower": 30.0, "communications_tower": 50.0, "mast": 40.0, "chimney": 60.0, "crane": 40.0, "power_tower": 35.0, "monument": 15.0, "memorial": 5.0, "column": 20.0, "bridge": 15.0}
MOST_HEIGHT = 1000.0
TALL = 30.0


def obstacle_type(tags: Column) -> Column:
    """`type` and `category` by the first tag that tells; null for all else."""
    kind = lambda t, c: F.struct(t.alias("type"), F.lit(c).alias("category"))
    return (
        F.when(tags["man_made"].isin(*STRUCTURES), kind(tags["man_made"], "infrastructure"))
        .when(tags["historic"].isin(*MONUMENTS), kind(tags["historic"], "monument"))
        .when(tags["bridge"] == "yes", kind(F.lit("bridge"), "bridge"))
        .when(tags["power"] == "tower", kind(F.lit("power_tower"), "infrastructure"))
    )


def tagged_height(tags: Column) -> Column:
    """The last of the height tags that can be read, null if that is out of range. Metres may be marked, the comma is a point."""
    height = F.lit(None).cast("double")
    for tag in HEIGHT_TAGS:
        read = as_number(F.translate(F.replace(F.replace(tags[tag], F.lit("m"), F.lit("")), F.lit(" "), F.lit("")), ",", "."))
        height = F.when(read.isNotNull(), F.when((read > 0) & (read <= MOST_HEIGHT), read)).otherwise(height)
    return height


def obstacles(elements: DataFrame, strict: bool = True) -> DataFrame:
    """`osm_id`, `name`, `type`, `category`, `height`, `height_source`, `height_source_fixed`, `lat`, `lon`.

    A way stands at the mean of its known points, each as often as the way names it. `height_source` is `osm_tag` only if the last height tag is there, whatever tag gave the
    height; `height_source_fixed` says what did. With `strict` off, the former says so too.
    """
    centres = way_points(elements).groupBy(F.col("id").alias("_way")).agg(F.avg("lat").alias("_lat"), F.avg("lon").alias("_lon"))
    rows = elements.where(F.size("tags") > 0).withColumn("_kind", obstacle_type(F.col("tags"))).where("_kind is not null")
    rows = rows.join(centres, (F.col("id") == F.col("_way")) & (F.col("type") == "way"), "left")
    lat, lon = (F.when(F.col("type") == "node", F.col(c)).when(F.col("type") == "way", F.col(f"_{c}")) for c in ("lat", "lon"))
    table = F.create_map(*[F.lit(x) for pair in DEFAULT_HEIGHTS.items() for x in pair])
    tags = F.col("tags")
    tagged = tagged_height(tags)
    leaked = F.when(tags[HEIGHT_TAGS[-1]].isNotNull(), "osm_tag").otherwise("estimated")
    fixed = F.when(tagged.isNotNull(), "osm_tag").otherwise("estimated")
    return rows.select(
        F.col("id").alias("osm_id"),
        F.coalesce(tags["name"], tags["name:ru"], F.col("_kind.type")).alias("name"),
        F.col("_kind.type").alias("type"),
        F.col("_kind.category").alias("category"),
        F.coalesce(tagged, table[F.col("_kind.type")]).alias("height"),
        (leaked if strict else fixed).alias("height_source"),
        fixed.alias("height_source_fixed"),
        lat.alias("lat"),
        lon.alias("lon"),
    ).where("lat is not null and lon is not null")


def by_category(rows: DataFrame) -> DataFrame:
    """Per category: count, mean and largest height."""
    return rows.groupBy("category").agg(F.count("*").alias("n"), F.bround(F.avg("height"), 1).alias("mean_height"), F.bround(F.max("height"), 1).alias("max_height"))


def by_type(rows: DataFrame) -> DataFrame:
    return rows.groupBy("type").agg(F.count("*").alias("n"))


def obstacle_counts(rows: DataFrame) -> DataFrame:
    """One row: all, those above 30 metres, bridges."""
    return rows.agg(F.count("*").alias("n"), F.count(F.when(F.col("height") > TALL, 1)).alias("n_tall"), F.count(F.when(F.col("type") == "bridge", 1)).alias("n_bridges"))


def tallest(rows: DataFrame, n: int = 10) -> DataFrame:
    """The `n` highest, the smaller id first of two as high."""
    return rows.orderBy(F.desc("height"), "osm_id").limit(n)
