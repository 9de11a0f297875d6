"""Footprints of two sources derived from the `part` table, so that every overlap has a closed form."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.geometry import from_rectangle, parse_wkt, with_measures
from plinth.session import checkpointed

A_SQL = """
SELECT p_partkey AS gid, CAST(350000 + (p_partkey*37 % 199)*16 AS DOUBLE) AS x0, CAST(6640000 + (p_partkey*53 % 101)*16 AS DOUBLE) AS y0,
 CAST(4 + (p_size % 37) AS DOUBLE) AS w, CAST(4 + (p_partkey % 29) AS DOUBLE) AS h,
 CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE CAST(1 + p_partkey % 9 AS DOUBLE) END AS gkh_floor_count_min,
 CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE CAST(1 + p_partkey % 9 + p_partkey % 4 AS DOUBLE) END AS gkh_floor_count_max,
 CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE concat('г. Санкт-Петербург, ул. Тестовая', CAST(p_partkey % 97 AS VARCHAR(20)), ', д. ', CAST(p_partkey AS VARCHAR(20))) END AS gkh_address
 FROM part"""

B_SQL = """
SELECT p_partkey AS gid, CAST(350000 + (p_partkey*37 % 199)*16 + (p_partkey % 11) AS DOUBLE) AS x0, CAST(6640000 + (p_partkey*53 % 101)*16 + (p_partkey % 7) AS DOUBLE) AS y0,
 CAST(4 + (p_size % 37) + (p_partkey % 3) AS DOUBLE) AS w, CAST(4 + (p_partkey % 29) AS DOUBLE) AS h,
 CASE WHEN p_partkey % 7 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN CAST(4.5 AS DOUBLE) ELSE CAST(3 + p_partkey % 40 AS DOUBLE) END AS height,
 CASE WHEN p_partkey % 4 = 0 THEN NULL WHEN p_partkey % 13 = 0 THEN CAST(1 AS DOUBLE) ELSE CAST(1 + p_partkey % 12 AS DOUBLE) END AS stairs,
 CASE WHEN p_partkey % 2 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(3 AS DOUBLE) END AS avg_floor_height,
 CASE p_partkey % 4 WHEN 0 THEN 'Жилое здание' WHEN 1 THEN 'Производственное здание' WHEN 2 THEN 'Нежилое здание (склад)' ELSE NULL END AS purpose_of_building,
 concat('Тестовая', CAST(p_partkey % 97 AS VARCHAR(20))) AS name_street, CAST(p_partkey AS VARCHAR(20)) AS number
 FROM part WHERE p_partkey % 10 < 8"""


def _source(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    # a table of few bytes is one split of its file, but outlines and measures of its rows are work for all tasks
    part = spark.read.parquet(f"{sf_dir}/part.parquet").select("p_partkey", "p_size").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    return spark.sql(sql.replace("FROM part", "FROM {part}"), part=part)


def raw_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source A as it is read from a file: `original_index`, `wkt`, floors, address."""
    return _raw(_source(spark, sf_dir, A_SQL))


def mixed_shapes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the boxes of source A, by the key's remainder of 6: bow-ties, L-shapes, rectangles with a hole, flat rings, triangles, and nothing."""
    rows = _source(spark, sf_dir, A_SQL).select("gid", "x0", "y0", "w", "h")
    at = lambda dx, dy: F.concat_ws(" ", F.col("x0") + dx * F.col("w"), F.col("y0") + dy * F.col("h"))
    ring = lambda *places: F.concat(F.lit("("), F.concat_ws(", ", *(at(*p) for p in (*places, places[0]))), F.lit(")"))
    polygon = lambda *rings: F.concat(F.lit("POLYGON ("), F.concat_ws(", ", *rings), F.lit(")"))
    kinds = [
        polygon(ring((0, 0), (1, 1), (1, 0), (0, 1))),
        polygon(ring((0, 0), (1, 0), (1, 0.5), (0.5, 0.5), (0.5, 1), (0, 1))),
        polygon(ring((0, 0), (1, 0), (1, 1), (0, 1)), ring((0.25, 0.25), (0.25, 0.75), (0.75, 0.75), (0.75, 0.25))),
        polygon(ring((0, 0), (1, 0), (0.5, 0))),
        polygon(ring((0, 0), (1, 0), (0, 1))),
    ]
    wkt = F.lit(None).cast("string")
    for k, made in enumerate(kinds):
        wkt = F.when(F.col("gid") % 6 == k, made).otherwise(wkt)
    return shaped(rows.select(F.col("gid").alias("original_index"), wkt.alias("wkt"), "x0", "y0", "w", "h"))


def raw_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source B as it is read from a file, without a `letter`."""
    return _raw(_source(spark, sf_dir, B_SQL)).withColumn("letter", F.lit(None).cast("string"))


def _raw(rows: DataFrame) -> DataFrame:
    wkt = from_rectangle(F.col("x0"), F.col("y0"), F.col("w"), F.col("h"))
    return rows.withColumn("wkt", wkt).withColumnRenamed("gid", "original_index").drop("x0", "y0", "w", "h")


def shaped(rows: DataFrame) -> DataFrame:
    """`rows` with `geom` read from `wkt`."""
    return rows.withColumn("geom", parse_wkt(F.col("wkt"))).drop("wkt")


def measured_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source A with measures, written out once."""
    return checkpointed(with_measures(shaped(raw_a(spark, sf_dir))))


def measured_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source B with measures, written out once."""
    return checkpointed(with_measures(shaped(raw_b(spark, sf_dir))))
