"""Connected components on an edge DataFrame."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from plinth.session import checkpointed


#: Distinct edges that one task takes in as arrays, which it holds whole; beyond it the rounds below do the same in many.
SMALL = 1 << 20


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, small: int = SMALL) -> DataFrame:
    """One row (`node`, `component`) for each node with an edge; `component` is the smallest node reachable from it.

    Up to `small` distinct edges, which are counted first, go to one task. More take rounds over all tasks: alternating large-star and small-star rounds (Kiveris et al., 2014): each round links a node's neighbours to the
    smallest of them, so a chain of n nodes needs O(log n) rounds. A round is two aggregations that combine before they
    shuffle; no neighbour list is ever held in one row. Nulls and self-loops are ignored. An edge list without edges gives no rows.
    """
    now = checkpointed(
        edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    before = _sum_of(now)
    if before[0] <= small:
        return _in_one_task(now)
    for _ in range(max_rounds):
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least.hint("merge"), "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        kept = least.where("m < u").select("u", F.col("m").alias("v"))
        star = large.union(kept).distinct()
        low = star.groupBy("u").agg(F.min("v").alias("m"))
        small = star.join(low.hint("merge"), "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = checkpointed(small.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        if (total := _sum_of(now)) == before:
            break
        before = total
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = now.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)


def _in_one_task(edges: DataFrame) -> DataFrame:
    kind = edges.schema["u"].dataType
    schema = T.StructType([T.StructField("node", kind), T.StructField("component", kind)])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [[b.column(0), b.column(1)] for b in batches]
        if not parts:
            return
        u, v = (pa.chunked_array(c).to_numpy() for c in zip(*parts, strict=True))
        nodes, ends = np.unique(np.concatenate([u, v]), return_inverse=True)
        top = np.arange(len(nodes))  # the smallest node known to be reached, by place
        u, v = ends[: len(u)], ends[len(u) :]
        while True:
            while not np.array_equal(higher := top[top], top):
                top = higher
            a, b = top[u], top[v]
            open_ = a != b
            if not open_.any():
                break
            u, v, a, b = u[open_], v[open_], a[open_], b[open_]
            np.minimum.at(top, np.maximum(a, b), np.minimum(a, b))
        yield pa.RecordBatch.from_arrays([pa.array(nodes, arrow[0].type), pa.array(nodes[top], arrow[1].type)], schema=arrow)

    return edges.coalesce(1).mapInArrow(run, schema)


def _sum_of(edges: DataFrame) -> Row:
    """What tells two edge lists apart."""
    return edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()


def merged_components(known: DataFrame, edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """`known` components (`node`, `component`) after more `edges`. Only components that these touch are looked at again."""
    if not edges.limit(1).count():
        return known
    own = lambda end: known.select(F.col("node").alias(end), F.col("component").alias(f"_{end}"))
    named = edges.join(own(src).hint("merge"), src, "left").join(own(dst).hint("merge"), dst, "left").select(F.coalesce(f"_{src}", src).alias("u"), F.coalesce(f"_{dst}", dst).alias("v"))
    top = checkpointed(connected_components(named, "u", "v"))
    moved = known.join(top.select(F.col("node").alias("component"), F.col("component").alias("_top")).hint("merge"), "component", "left").select("node", F.coalesce("_top", "component").alias("component"))
    return checkpointed(moved.union(top.join(known.select("node").hint("merge"), "node", "left_anti").select("node", "component")))


def numbered(rows: DataFrame, *order: str, name: str = "number") -> DataFrame:
    """`rows` with consecutive numbers from 0 in the given order, which must be total.

    Rows are dealt to ranges of the order and numbered in each; a range starts after the rows of those before it. The only window over all holds
    a row per range.
    """
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = checkpointed(rows.repartitionByRange(parts, *order).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy("_range").agg(F.count("*").alias("_n")).select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    return dealt.withColumn("_own", own).join(starts, "_range").withColumn(name, F.col("_start") + F.col("_own") - 1).drop("_range", "_own", "_start")


def greedy_matching(pairs: DataFrame, left: str = "i", right: str = "j") -> DataFrame:
    """One-to-one pairs that a walk through `pairs` in ascending (`left`, `right`) would take: each left takes its first right that is still free.

    A pair that comes first for both its ends is taken whatever comes before it. So each round takes all such pairs and drops
    those that share an end with them, until none is left; the result is the walk's.
    """
    rest, taken = checkpointed(pairs), None
    while rest.limit(1).count():
        first_right = rest.groupBy(left).agg(F.min(right).alias("_r"))
        first_left = rest.groupBy(right).agg(F.min(left).alias("_l"))
        now = checkpointed(rest.join(first_right.hint("merge"), left).join(first_left.hint("merge"), right).where((F.col(right) == F.col("_r")) & (F.col(left) == F.col("_l"))).drop("_r", "_l").select(*pairs.columns))
        taken = now if taken is None else taken.union(now)
        rest = checkpointed(rest.join(now.select(left).hint("merge"), left, "left_anti").join(now.select(right).hint("merge"), right, "left_anti").select(*pairs.columns))
    return pairs.limit(0) if taken is None else taken
