"""Tables and reports as files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.functions.geometry import to_wkt


def with_wkt(rows: DataFrame) -> DataFrame:
    """`rows` with `geometry_wkt` in place of `geom`, fit for a CSV."""
    return rows.withColumn("geometry_wkt", to_wkt(F.col("geom"))).drop("geom")


def write_csv(rows: DataFrame, path: str) -> None:
    """A CSV with a header; a geometry is written as text."""
    (with_wkt(rows) if "geom" in rows.columns else rows).write.mode("overwrite").csv(path, header=True, escape='"')


def report(**frames: DataFrame) -> str:
    """Small statistics as one JSON object; a frame of one row is an object, one of more rows a list."""
    found = {}
    for name, frame in frames.items():
        rows = [r.asDict(recursive=True) for r in frame.collect()]
        found[name] = rows[0] if len(rows) == 1 else rows
    return json.dumps(found, ensure_ascii=False, default=str, sort_keys=True)


def features(rows: DataFrame, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """One column, `feature`: each row as a point in GeoJSON with its other columns as properties."""
    rest = F.to_json(F.struct(*[c for c in rows.columns if c not in (lon, lat)]))
    return rows.select(F.concat(F.lit('{"type":"Feature","geometry":{"type":"Point","coordinates":['), F.col(lon), F.lit(","), F.col(lat), F.lit(']},"properties":'), rest, F.lit("}")).alias("feature"))
