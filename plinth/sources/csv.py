"""Footprint files whose encoding, separator and geometry column aren't known."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions.geometry import is_degrees, parse_wkt, project
from plinth.operators.graph import numbered
from plinth.session import checkpointed

#: What is tried, in this order.
ENCODINGS = ("UTF-8", "windows-1251", "ISO-8859-1")
SEPARATORS = (",", ";", "\t")
GEOMETRY_NAMES = ("geometry", "wkt", "geom", "WKT", "GEOMETRY")
CLEAN_NAMES = ("geometry_wkt", "geometry", "wkt")


#: What a line of windows-1251 looks like when read as ISO-8859-1, and what it is. One byte has no meaning there.
_BYTES = [b for b in range(128, 256) if b != 0x98]
_SEEN, _MEANT = "".join(map(chr, _BYTES)), bytes(_BYTES).decode("windows-1251")


def encoding_of(spark: SparkSession, path: str) -> str:
    """The first encoding in which every line can be read. One pass over the lines for each that fails; nothing but the verdict leaves the executors."""
    if not spark.read.text(path).where(~F.expr("is_valid_utf8(value)")).limit(1).count():
        return ENCODINGS[0]
    return ENCODINGS[2] if _lines(spark, path, ENCODINGS[2]).where(F.col("line").contains("\x98")).limit(1).count() else ENCODINGS[1]


def _lines(spark: SparkSession, path: str, encoding: str) -> DataFrame:
    return spark.read.csv(path, encoding=encoding, sep="\u0001", quote="", schema="line string")


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with the first separator that gives more than two columns; if none does, the one that the header has most of."""
    encoding = encoding_of(spark, path)
    single = encoding == ENCODINGS[1]  # not among the reader's own, so read byte by byte

    def read(sep: str) -> DataFrame:
        rows = spark.read.csv(path, header=True, sep=sep, encoding=ENCODINGS[2] if single else encoding, multiLine=True, escape='"')
        named = lambda c: c.translate(str.maketrans(_SEEN, _MEANT))
        return rows.select(*[F.translate(F.col(f"`{c}`"), _SEEN, _MEANT).alias(named(c)) for c in rows.columns]) if single else rows

    for sep in SEPARATORS:
        rows = read(sep)
        if len(rows.columns) > 2:
            return rows
    head = _lines(spark, path, ENCODINGS[2] if single else encoding).first()
    return read(max((*SEPARATORS, "|"), key=lambda c: ((head.line or "") if head else "").count(c)))


def geometry_column(rows: DataFrame, names: tuple[str, ...] = GEOMETRY_NAMES) -> str:
    """The first of the usual names whose first known value looks like a shape, else the first column with a polygon. One aggregation."""
    first = rows.agg(*[F.first(F.col(f"`{c}`").cast("string"), ignorenulls=True).alias(c) for c in rows.columns]).first()
    for c in names:
        if c in rows.columns and first[c] and ("POLYGON" in first[c].upper() or "POINT" in first[c].upper()):
            return c
    for c in rows.columns:
        if first[c] and "POLYGON" in first[c].upper():
            return c
    raise ValueError("no column holds geometries")


@dataclass(frozen=True)
class Loaded:
    rows: DataFrame
    degrees: bool
    failures: int


def load_source(spark: SparkSession, path: str, numbers: tuple[str, ...] = ()) -> Loaded:
    """A footprint file as rows with `geom` in metres and `original_index`, the place among rows whose geometry can be read.

    `numbers` names columns to be read as doubles; what isn't a number is null. The first geometry tells for the whole file whether it is in degrees; if so it is projected.
    `failures` counts geometries that are given but can't be read.
    """
    raw = read_csv(spark, path)
    column = geometry_column(raw)
    rows = raw.withColumn("_row", F.monotonically_increasing_id()).withColumn("geom", parse_wkt(F.col(f"`{column}`")))
    number = r"^\s*[-+]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][-+]?[0-9]+)?\s*$"
    rows = checkpointed(rows.withColumns({c: F.when(F.col(c).rlike(number), F.expr(f"try_cast(trim(`{c}`) as double)")) for c in numbers if c in rows.columns}))
    failures = rows.where(F.col(f"`{column}`").isNotNull() & F.col("geom").isNull()).count()
    known = rows.where(F.size("geom") > 0)
    head = known.orderBy("_row").select(is_degrees(F.col("geom")).alias("degrees")).first()
    degrees = bool(head and head.degrees)
    shaped = known.withColumn("geom", project(F.col("geom"))) if degrees else known
    drop = ["_row"] + ([column] if column != "geom" else [])
    return Loaded(numbered(shaped, "_row", name="original_index").drop(*drop), degrees, failures)


def load_clean(spark: SparkSession, path: str) -> DataFrame:
    """A cleaned file written by `plinth.sources.sinks`, with `geom` read from the first of the usual columns; rows without one go."""
    rows = read_csv(spark, path)
    column = next(c for c in CLEAN_NAMES if c in rows.columns)
    return rows.withColumn("geom", parse_wkt(F.col(column))).where(F.size("geom") > 0)


def first_existing(spark: SparkSession, *paths: str) -> DataFrame:
    """The Parquet table at the first path that there is."""
    jvm = spark._jvm
    for path in paths:
        where = jvm.org.apache.hadoop.fs.Path(path)
        if where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
            return spark.read.parquet(path)
    raise FileNotFoundError(", ".join(paths))
