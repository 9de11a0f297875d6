"""Map elements (nodes and ways with tags) from files of the usual JSON form. Files only: nothing is fetched from a network."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ELEMENT = "struct<type:string,id:bigint,lat:double,lon:double,nodes:array<bigint>,tags:map<string,string>>"


def read_elements(spark: SparkSession, path: str) -> DataFrame:
    """One row per element: `type`, `id`, `lat`, `lon`, `nodes`, `tags`."""
    return spark.read.schema(f"elements array<{ELEMENT}>").json(path, multiLine=True).select(F.explode("elements").alias("e")).select("e.*")


def way_points(elements: DataFrame) -> DataFrame:
    """`id`, `pos`, `lat`, `lon` for every node of a way whose place is known."""
    nodes = elements.where("type = 'node' and lat is not null").groupBy("id").agg(F.max(F.struct("lat", "lon")).alias("p"))
    used = elements.where("type = 'way'").select("id", F.posexplode("nodes").alias("pos", "node"))
    return used.join(nodes.withColumnRenamed("id", "node"), "node").select("id", "pos", F.col("p.lat").alias("lat"), F.col("p.lon").alias("lon"))
