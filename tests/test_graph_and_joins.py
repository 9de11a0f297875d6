import math
import random

import pytest
from pyspark.sql import functions as F

from plinth.functions.geometry import from_rectangle, parse_wkt, with_measures
from plinth.operators.graph import connected_components, greedy_matching, merged_components, numbered
from plinth.operators.spatial_join import box_join, radius_join, with_overlap
from plinth.plans import queries
from plinth.session import checkpointed


def test_components_of_random_graphs(spark):
    random.seed(1)
    for n, m in ((40, 25), (200, 150), (80, 79)):
        edges = [(i, i + 1) for i in range(79)] if m == 79 else [(random.randrange(n), random.randrange(n)) for _ in range(m)]
        top = list(range(n))

        def root(x, top=top):
            while top[x] != x:
                x = top[x]
            return x

        for a, b in edges:
            a, b = root(a), root(b)
            top[max(a, b)] = min(a, b)
        for small in (0, 1000):
            got = {r.node: r.component for r in connected_components(spark.createDataFrame([*edges, (None, 3)], "src long, dst long"), small=small).collect()}
            assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}
    assert connected_components(spark.createDataFrame([], "src long, dst long")).count() == 0


def test_whole_part_graph_takes_all_rows(spark, tmp_path):
    keys = [*range(0, 60), *range(1000, 1040), None]
    spark.createDataFrame([(k,) for k in keys], "p_partkey long").write.parquet(f"{tmp_path}/part.parquet")
    near = {}
    for k in keys:
        if k is not None and k != k * 7 % 1009:
            near.setdefault(k, set()).add(k * 7 % 1009)
            near.setdefault(k * 7 % 1009, set()).add(k)
    want = {}
    for k in sorted(near):
        todo = [] if k in want else [k]
        while todo:
            x = todo.pop()
            if x not in want:
                want[x] = k
                todo += near[x]
    got = queries.r1_part_graph(spark, str(tmp_path))
    assert sorted(map(tuple, got.collect())) == sorted(want.items())
    assert {k for k in keys if k} <= set(want)


def test_more_edges_merge_components(spark):
    random.seed(4)
    edges = [(random.randrange(120), random.randrange(120)) for _ in range(90)]
    frame = lambda e: spark.createDataFrame(e, "src long, dst long")
    rows = lambda df: sorted(map(tuple, df.collect()))
    first = connected_components(frame(edges[:60]))
    assert rows(merged_components(first, frame(edges[60:]))) == rows(connected_components(frame(edges)))
    assert rows(merged_components(first, frame([]))) == rows(first)


def test_greedy_matching_is_the_walk(spark):
    random.seed(2)
    for _ in range(4):
        pairs = sorted({(random.randrange(15), random.randrange(15)) for _ in range(40)})
        used_i, used_j, want = set(), set(), []
        for i, j in pairs:
            if i not in used_i and j not in used_j:
                used_i.add(i)
                used_j.add(j)
                want.append((i, j))
        assert sorted(map(tuple, greedy_matching(spark.createDataFrame(pairs, "i long, j long")).collect())) == want


def test_numbered(spark):
    rows = spark.createDataFrame([(i * 7 % 101,) for i in range(101)], "k long").repartition(5)
    assert sorted(map(tuple, numbered(rows, "k").collect())) == [(i, i) for i in range(101)]


@pytest.fixture(scope="module")
def boxes(spark):
    random.seed(3)
    rows = [(i, random.uniform(0, 900), random.uniform(0, 900), random.uniform(1, 60), random.uniform(1, 60)) for i in range(150)] + [(150, -5000.0, 400.0, 9000.0, 3.0)]
    made = spark.createDataFrame(rows, "id long, x double, y double, w double, h double")
    shaped = made.withColumn("geom", parse_wkt(from_rectangle(F.col("x"), F.col("y"), F.col("w"), F.col("h")))).select("id", "geom")
    return rows, checkpointed(with_measures(shaped))


@pytest.mark.parametrize("cell,margin", [(50.0, 0.0), (7.0, 0.0), (50.0, 15.0)])
def test_box_join_is_all_pairs_once(boxes, cell, margin):
    rows, df = boxes
    got = sorted((r.a_id, r.b_id) for r in box_join(df, df, cell, margin).select("a_id", "b_id").collect())
    want = sorted((i, j) for i, x, y, w, h in rows for j, u, v, p, q in rows if x - margin <= u + p and u <= x + w + margin and y - margin <= v + q and v <= y + h + margin)
    assert got == want


def test_radius_join_bounds(spark):
    points = [(0, 0.0, 0.0), (1, 100.0, 0.0), (2, 100.01, 0.0), (3, -60.0, 80.0), (4, 5000.0, 5000.0)]
    df = spark.createDataFrame(points, "id long, cx double, cy double")
    got = sorted((r.a_id, r.b_id) for r in radius_join(df, df, 100.0).collect())
    assert got == sorted((i, j) for i, x, y in points for j, u, v in points if math.hypot(x - u, y - v) <= 100)


def test_overlap_kernel_and_closed_form_agree(spark):
    squares = [(0, "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))"), (1, "POLYGON ((2 2, 6 2, 6 6, 2 6, 2 2))"), (2, "POLYGON ((2 0, 4 2, 2 4, 0 2, 2 0))"), (3, "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 1, 0 0)), ((3 3, 5 3, 5 5, 3 5, 3 3)))")]
    df = checkpointed(with_measures(spark.createDataFrame(squares, "id long, w string").withColumn("geom", parse_wkt(F.col("w")))))
    got = {(r.a_id, r.b_id): r.inter for r in with_overlap(box_join(df, df)).collect()}
    assert got[0, 1] == 4.0 and got[0, 2] == pytest.approx(8.0) and got[0, 3] == pytest.approx(2.0) and got[1, 3] == pytest.approx(4.0)
    assert all(got[i, j] == pytest.approx(got[j, i]) for i, j in got)


def test_overlap_of_shapes_is_not_broadcast(spark, tmp_path):
    spark.createDataFrame([(k, k % 50) for k in range(60)], "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    made = queries.g15_overlap(spark, str(tmp_path))
    assert "Broadcast" not in made._jdf.queryExecution().executedPlan().toString() and made.count() == 40
