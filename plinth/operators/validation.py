"""Whether heights are plausible: distributions, agreement of sources and neighbours, errors, insights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Right-closed height classes and their names, and those of error groups.
HEIGHT_CLASSES = (
    (0, 5, "одноэтажная (до 5м)"),
    (5, 12, "малоэтажная (5-12м)"),
    (12, 25, "среднеэтажная (12-25м)"),
    (25, 50, "высотная (25-50м)"),
    (50, 500, "небоскребы (50м+)"),
)
ERROR_BOUNDS = ((0, 5), (5, 10), (10, 20), (20, 50), (50, 500))
LOW_CONFIDENCE = ("low", "low_conflicting", "predicted")
FLOOR = 3.0


def _share(part: Column, whole: Column) -> Column:
    return F.bround(part * 100.0 / whole, 1)


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, 1))


def height_class(height: Column, classes=HEIGHT_CLASSES) -> Column:
    """The name of the class (low, high] that holds a height; null outside all."""
    out = F.lit(None).cast("string")
    for low, high, name in classes:
        out = F.when((height > low) & (height <= high), name).otherwise(out)
    return out


def describe_heights(buildings: DataFrame) -> DataFrame:
    """One row of order statistics, mean and sample deviation, rounded half to even to tenths."""
    h = F.col("height_final")
    one = lambda c, name: F.bround(c, 1).alias(name)
    parts = [one(F.percentile(h, F.lit(p / 100)), f"p{p}") for p in (5, 25, 75, 95)]
    return buildings.where(h.isNotNull()).agg(F.count("*").alias("n"), one(F.min(h), "min"), one(F.max(h), "max"), one(F.median(h), "median"), one(F.avg(h), "mean"), one(F.stddev_samp(h), "std"), *parts)


def plausibility(buildings: DataFrame) -> DataFrame:
    """One row: heights above 100 and below 3 metres with verdicts, and whether the median is a town's."""
    h = F.col("height_final")
    n, tall, low = F.count("*"), count_if(h > 100), count_if(h < 3)
    return buildings.where(h.isNotNull()).agg(n.alias("n"), tall.alias("n_above_100"), (tall < 100).alias("above_ok"), low.alias("n_below_3"), _share(low, n).alias("pct_below_3"), (low * 100.0 / n < 5).alias("below_ok"), F.median(h).between(5, 20).alias("median_ok"))


def floor_histogram(buildings: DataFrame, n: int = 15) -> DataFrame:
    """Buildings by floors, a half rounded to even; the `n` lowest floors."""
    floors = F.rint(F.col("height_final") / FLOOR).cast("int")
    return buildings.where("height_final is not null").groupBy(floors.alias("floors")).agg(F.count("*").alias("n")).orderBy("floors").limit(n)


def source_agreement(buildings: DataFrame) -> DataFrame:
    """One row: how far measured heights are from three metres a floor."""
    d = F.abs(F.col("height_b") - FLOOR * F.col("gkh_floor_max"))
    rows = buildings.where("height_b > 0 and gkh_floor_max > 0").select(d.alias("d"))
    n = F.count("*")
    below = [x for m in (3, 6, 9) for k in [count_if(F.col("d") < m)] for x in (k.alias(f"n_below_{m}"), _share(k, n).alias(f"pct_below_{m}"))]
    far = count_if(F.col("d") > 15)
    return rows.agg(n.alias("n"), *below, far.alias("n_above_15"), _share(far, n).alias("pct_above_15"), F.bround(F.avg("d"), 2).alias("mean_diff"), F.bround(F.median("d"), 2).alias("median_diff"))


def heights_by_purpose(buildings: DataFrame, least: int = 50, n: int = 15, source_b: DataFrame | None = None) -> DataFrame:
    """Purposes of at least `least` buildings whose `height_b` is known, the `n` with the highest mean. None if `source_b` is given and has no column `district`."""
    h = F.col("height_final")
    if source_b is not None and "district" not in source_b.columns:
        buildings = buildings.limit(0)
    rows = buildings.where("height_b is not null and height_final is not null and purpose is not null").groupBy("purpose").agg(F.bround(F.avg(h), 1).alias("mean"), F.bround(F.median(h), 1).alias("median"), F.count("*").alias("n"), F.avg(h).alias("_m"))
    return rows.where(F.col("n") >= least).orderBy(F.desc("_m"), "purpose").limit(n).drop("_m")


def neighbour_correlation(buildings: DataFrame, least: int = 100) -> DataFrame:
    """One row: Pearson's correlation of heights with the neighbours' mean and its verdict; null below `least` rows."""
    rows = buildings.where("height_final is not null and avg_height_neighbors_100m is not null")
    made = rows.agg(F.count("*").alias("n"), F.corr("height_final", "avg_height_neighbors_100m").alias("c"))
    c = F.when(F.col("n") >= least, F.col("c"))
    verdict = F.when(c > 0.8, "excellent").when(c > 0.6, "good").when(c > 0.4, "moderate").when(c.isNotNull(), "weak")
    return made.select("n", F.bround(c, 4).alias("correlation"), verdict.alias("verdict"))


def value_counts(buildings: DataFrame, column: str) -> DataFrame:
    return buildings.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).where("value is not null")


def low_confidence(buildings: DataFrame) -> DataFrame:
    """One row: buildings whose height is little sure, their share, mean area and median height."""
    low = F.col("height_confidence").isin(*LOW_CONFIDENCE)
    k = count_if(low)
    return buildings.agg(k.alias("n"), _share(k, F.count("*")).alias("pct"), F.bround(F.avg(F.when(low, F.col("area_m2"))), 1).alias("mean_area"), F.bround(F.median(F.when(low, F.col("height_final"))), 1).alias("median_height"))


def final_verdict(buildings: DataFrame, mean_error: float | None, least_rows: int = 160_000) -> DataFrame:
    """One row: four checks and what they come to."""
    near = neighbour_correlation(buildings).select(F.col("correlation").alias("c"))
    rows = buildings.agg(F.median("height_final").alias("m"), F.count("*").alias("n")).join(near, F.lit(True))
    checks = {
        "median_ok": F.coalesce(F.col("m").between(5, 20), F.lit(False)),
        "error_ok": F.coalesce(F.lit(mean_error).cast("double") < 3, F.lit(False)),
        "correlation_ok": F.coalesce(F.col("c") > 0.6, F.lit(False)),
        "rows_ok": F.col("n") > least_rows,
    }
    passed = sum((c.cast("int") for c in checks.values()), F.lit(0))
    return rows.select(*[c.alias(k) for k, c in checks.items()], passed.alias("passed"), F.when(passed == 4, "valid").when(passed == 3, "mostly").otherwise("rework").alias("verdict"))


def height_classes(buildings: DataFrame) -> DataFrame:
    """Every class with its count and share of all known heights, empty ones too."""
    names = F.array(*[F.lit(name) for *_, name in HEIGHT_CLASSES])
    every = buildings.sparkSession.range(1).select(F.explode(names).alias("height_class"))
    valid = buildings.where("height_final is not null").select("height_final")
    total = valid.agg(F.count("*").alias("total"))
    counted = valid.groupBy(height_class(F.col("height_final")).alias("height_class")).agg(F.count("*").alias("n"))
    return every.join(counted, "height_class", "left").join(total, F.lit(True)).select("height_class", F.coalesce("n", F.lit(0)).alias("n"), _share(F.coalesce("n", F.lit(0)), F.col("total")).alias("pct"))


def tall_and_low(buildings: DataFrame) -> DataFrame:
    """One row: heights above 25 and up to 5 metres with their shares."""
    h, n = F.col("height_final"), F.count("*")
    tall, low = count_if(h > 25), count_if(h <= 5)
    return buildings.where(h.isNotNull()).agg(tall.alias("n_tall"), _share(tall, n).alias("pct_tall"), low.alias("n_low"), _share(low, n).alias("pct_low"))


def priority_purposes(buildings: DataFrame, n: int = 5) -> DataFrame:
    """The `n` purposes with most floors in all."""
    h = F.col("height_final")
    rows = buildings.where("height_final is not null and purpose is not null")
    return rows.groupBy("purpose").agg(F.count("*").alias("n"), F.avg(h).alias("mean_h"), F.sum(h / FLOOR).alias("total_floors")).orderBy(F.desc("total_floors"), "purpose").limit(n)


def error_metrics(rows: DataFrame, truth: str = "truth", guess: str = "guess") -> DataFrame:
    """One row: MAE, RMSE, R2, MAPE, and shares of errors below 3 and 6 metres."""
    t, e = F.col(truth), F.col(guess) - F.col(truth)
    n = F.count("*")
    return rows.agg(n.alias("n"), F.avg(F.abs(e)).alias("mae"), F.sqrt(F.avg(e * e)).alias("rmse"), (1 - F.sum(e * e) / F.nullif(F.var_pop(t) * n, F.lit(0.0))).alias("r2"), (F.avg(F.abs(e) / F.greatest(F.abs(t), F.lit(1e-10))) * 100).alias("mape"), _share(count_if(F.abs(e) < 3), n).alias("pct_below_3"), _share(count_if(F.abs(e) < 6), n).alias("pct_below_6"))


def error_by_height(rows: DataFrame, truth: str = "truth", guess: str = "guess") -> DataFrame:
    """Per class of true heights: count and MAE."""
    group = height_class(F.col(truth), [(a, b, f"{a}-{b}") for a, b in ERROR_BOUNDS])
    return rows.groupBy(group.alias("height_group")).agg(F.count("*").alias("n"), F.avg(F.abs(F.col(guess) - F.col(truth))).alias("mae")).where("height_group is not null")
