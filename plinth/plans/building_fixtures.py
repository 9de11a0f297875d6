"""Fused buildings, map elements and obstacles derived from the `part` table, in SQL that Spark and DuckDB both run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BUILDINGS_SQL = """
SELECT p_partkey AS component_id,
 CASE WHEN p_partkey % 17 = 0 THEN NULL ELSE CAST(2 + p_partkey*31 % 601 AS DOUBLE) / CAST(8 AS DOUBLE) END AS height_final,
 CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(3 + p_partkey % 40 AS DOUBLE) END AS height_b,
 CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(1 + p_partkey % 12 AS DOUBLE) END AS stairs_b,
 CASE WHEN p_partkey % 2 = 0 THEN CAST(0 AS DOUBLE) WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(3 AS DOUBLE) END AS avg_floor_height,
 CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(1 + p_partkey % 9 + p_partkey % 4 AS DOUBLE) END AS gkh_floor_max,
 CASE WHEN p_partkey % 10 < 4 THEN NULL ELSE CAST(1 + p_partkey % 9 AS DOUBLE) END AS gkh_floor_min,
 CASE p_partkey % 7 WHEN 0 THEN 'Жилое здание' WHEN 1 THEN 'Производственное здание' WHEN 2 THEN 'Нежилое здание (склад)' WHEN 3 THEN ' ' WHEN 4 THEN 'Склад' WHEN 5 THEN 'музей' ELSE NULL END AS purpose,
 CAST(20 + p_size*7 AS DOUBLE) AS area_a, CAST(20 + p_partkey % 400 AS DOUBLE) AS area_b, CAST(20 + p_partkey*3 % 500 AS DOUBLE) AS area_m2,
 CASE p_partkey % 6 WHEN 0 THEN 'high' WHEN 1 THEN 'low' WHEN 2 THEN 'low_conflicting' WHEN 3 THEN 'medium' WHEN 4 THEN 'predicted' ELSE 'high_validated' END AS height_confidence,
 CASE p_partkey % 4 WHEN 0 THEN 'B_height' WHEN 1 THEN 'voting_3est' ELSE 'wavg_B_height+A_gkh_max' END AS height_source,
 CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE CAST(10 + p_partkey*29 % 611 AS DOUBLE) / CAST(16 AS DOUBLE) END AS avg_height_neighbors_100m,
 CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE CAST(3 * (1 + p_partkey % 15) AS DOUBLE) END AS osm_height_est,
 CAST(350000 + (p_partkey*37 % 199)*16 AS DOUBLE) AS cx, CAST(6640000 + (p_partkey*53 % 101)*16 AS DOUBLE) AS cy,
 CAST(1 + p_partkey % 3 AS BIGINT) AS n_parts
 FROM part"""

#: A way of four points for each third part, its tags by the part's key; and a tagged node for each.
WAYS_SQL = """
SELECT p_partkey AS id, CAST(59.8 + (p_partkey % 50) * 0.004 AS DOUBLE) AS lat0, CAST(30.1 + (p_partkey*7 % 60) * 0.005 AS DOUBLE) AS lon0,
 CAST(0.0001 * (1 + p_partkey % 5) AS DOUBLE) AS d,
 CASE p_partkey % 9 WHEN 0 THEN '5' WHEN 1 THEN ' 12 ' WHEN 2 THEN '5;6' WHEN 3 THEN '0' WHEN 4 THEN '101' WHEN 5 THEN '2.5' WHEN 6 THEN NULL WHEN 7 THEN '1e1' ELSE 'x' END AS levels,
 CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 'apartments' END AS building
 FROM part WHERE p_partkey % 3 = 0"""

OBSTACLES_SQL = """
SELECT p_partkey AS id, CAST(59.8 + (p_partkey % 50) * 0.004 AS DOUBLE) AS lat, CAST(30.1 + (p_partkey*7 % 60) * 0.005 AS DOUBLE) AS lon,
 CASE p_partkey % 8 WHEN 0 THEN 'tower' WHEN 1 THEN 'mast' WHEN 2 THEN 'pier' END AS man_made,
 CASE p_partkey % 8 WHEN 2 THEN 'monument' WHEN 3 THEN 'column' END AS historic,
 CASE p_partkey % 8 WHEN 4 THEN 'yes' WHEN 5 THEN 'no' END AS bridge,
 CASE p_partkey % 8 WHEN 5 THEN 'tower' END AS power,
 CASE p_partkey % 5 WHEN 0 THEN '30 m' WHEN 1 THEN '12,5' WHEN 2 THEN 'tall' END AS height,
 CASE p_partkey % 7 WHEN 0 THEN '45' WHEN 1 THEN '-3' WHEN 2 THEN 'n/a' END AS ele,
 CASE p_partkey % 13 WHEN 0 THEN '21.5m' WHEN 1 THEN '2000' END AS building_height,
 CASE WHEN p_partkey % 3 = 0 THEN concat('name ', CAST(p_partkey AS VARCHAR(20))) END AS name
 FROM part"""


def _run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size")
    return spark.sql(sql.replace("FROM part", "FROM {part}"), part=part)


def buildings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, BUILDINGS_SQL)


def _tags(**columns: str):
    """A map of the tags that are there."""
    pairs = F.array(*[F.struct(F.lit(tag).alias("key"), F.col(c).alias("value")) for c, tag in columns.items()])
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def way_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes and ways as map files have them; every way names a node that there isn't, and isn't closed."""
    ways = _run(spark, sf_dir, WAYS_SQL)
    corner = lambda k, dy, dx: F.struct((F.col("id") * 10 + k).alias("id"), (F.col("lat0") + dy * F.col("d")).alias("lat"), (F.col("lon0") + dx * F.col("d")).alias("lon"))
    nodes = ways.select(F.explode(F.array(corner(1, 0, 0), corner(2, 0, 2), corner(3, 1, 2), corner(4, 1, 0))).alias("n")).select("n.*")
    none = lambda kind: F.lit(None).cast(kind)
    nodes = nodes.select(F.lit("node").alias("type"), "id", "lat", "lon", none("array<bigint>").alias("nodes"), none("map<string,string>").alias("tags"))
    listed = F.array(*[F.col("id") * 10 + k for k in (1, 2, 9, 3, 4)])
    return nodes.union(ways.select(F.lit("way"), "id", none("double"), none("double"), listed, _tags(levels="building:levels", building="building")))


def obstacle_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _run(spark, sf_dir, OBSTACLES_SQL)
    tags = _tags(man_made="man_made", historic="historic", bridge="bridge", power="power", height="height", ele="ele", building_height="building:height", name="name")
    return rows.select(F.lit("node").alias("type"), "id", "lat", "lon", F.lit(None).cast("array<bigint>").alias("nodes"), tags.alias("tags"))
