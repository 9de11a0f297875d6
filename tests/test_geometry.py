import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from plinth.functions import geometry as G
from plinth.functions import kernels as K

BOW = "POLYGON ((0 0, 2 2, 2 0, 0 2, 0 0))"


@pytest.fixture(scope="module")
def jts(spark):
    pkg = spark._jvm.org.locationtech.jts
    return pkg, pkg.io.WKTReader()


def star(n, cx=0.0, cy=0.0, r=10.0, rng=random):
    angles = sorted(rng.random() * 2 * math.pi for _ in range(n))
    points = [(cx + r * rng.uniform(0.3, 1) * math.cos(a), cy + r * rng.uniform(0.3, 1) * math.sin(a)) for a in angles]
    return points + points[:1]


def wkt(*rings):
    return "POLYGON (" + ", ".join("(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")" for r in rings) + ")"


def shape(*rings):
    return [[np.array(r, dtype=float) for r in rings]]


def test_wkt(spark):
    rows = [
        ("POLYGON ((0 0, 4 0, 4 3, 0 3, 0 0))", 1),
        (" multipolygon(((0 0,1 0,1 1,0 0)),((5 5,7 5,7 7,5 5),(5.5 5.2,6 5.2,6 5.4,5.5 5.2)))", 2),
        ("GEOMETRYCOLLECTION (POINT (1 2), LINESTRING (0 0, 1 1), POLYGON ((0 0, -1.5e1 0, 0 +2., 0 0)))", 1),
        ("POLYGON Z ((0 0 1, 4 0 1, 4 3 1, 0 0 1))", 1),
        ("POLYGON EMPTY", 0),
        ("POINT (1 2)", None),
        ("POLYGON ((0 0, 1 1, x 2, 0 0))", None),
        ("POLYGON ((0 0, 1 0, 1 1, 0 1))", None),
        ("POLYGON ((0 0, 1 0, 1 1, 0 0)", None),
        ("MULTILINESTRING ((0 0, 1 1), (2 2, 3 3))", None),
        ("junk", None),
        (None, None),
    ]
    got = spark.createDataFrame(rows, "w string, n int").select("w", "n", G.parse_wkt(F.col("w")).alias("g")).collect()
    for r in got:
        assert (None if r.g is None else len(r.g)) == r.n, r.w
    assert got[2].g[0][0][1].x == -15.0 and got[2].g[0][0][2].y == 2.0
    again = spark.createDataFrame(rows[:4], "w string, n int").select(G.parse_wkt(F.col("w")).alias("g"))
    assert again.select((G.parse_wkt(G.to_wkt(F.col("g"))) == F.col("g")).alias("same")).where("not same").count() == 0


def test_measures_match_jts(spark, jts):
    pkg, reader = jts
    random.seed(1)
    texts = [wkt(star(random.randint(4, 12), 350000, 6640000)) for _ in range(40)]
    texts += [wkt([(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], [(1, 1), (1, 3), (4, 3), (4, 1), (1, 1)]), "MULTIPOLYGON (((0 0, 2 0, 2 2, 0 0)), ((5 5, 9 5, 9 9, 5 5)))"]
    df = G.with_measures(spark.createDataFrame([(t,) for t in texts], "w string").withColumn("geom", G.parse_wkt(F.col("w"))))
    for r in df.collect():
        g = reader.read(r.w)
        c, e = g.getCentroid(), g.getEnvelopeInternal()
        assert r.area == pytest.approx(g.getArea(), abs=1e-6) and r.perimeter == pytest.approx(g.getLength(), rel=1e-12)
        assert (r.cx, r.cy) == pytest.approx((c.getX(), c.getY()), abs=1e-6)
        assert (r.xmin, r.ymin, r.xmax, r.ymax) == (e.getMinX(), e.getMinY(), e.getMaxX(), e.getMaxY())


def test_overlap_and_hausdorff_match_jts(jts):
    pkg, reader = jts
    random.seed(2)
    for k in range(60):
        grid = k % 2
        p, q = (star(random.randint(4, 10), random.uniform(-4, 4), random.uniform(-4, 4)) for _ in range(2))
        if grid:
            p, q = ([(round(x), round(y)) for x, y in s] for s in (p, q))
        a, b = reader.read(wkt(p)), reader.read(wkt(q))
        if not (a.isValid() and b.isValid()) or a.getArea() == 0 or b.getArea() == 0:
            continue
        assert K.overlap_area(shape(p), shape(q)) == pytest.approx(a.intersection(b).getArea(), abs=1e-9)
        far = pkg.algorithm.distance.DiscreteHausdorffDistance.distance(a, b)
        assert K.hausdorff(shape(p), shape(q)) == pytest.approx(far, abs=1e-9)


def test_validity_matches_jts(jts):
    pkg, reader = jts
    random.seed(3)
    cases = [
        [[(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], [(1, 1), (1, 3), (4, 3), (4, 1), (1, 1)]],
        [[(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], [(8, 8), (8, 12), (12, 12), (12, 8), (8, 8)]],
        [[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]],
        [[(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], [(0, 4), (3, 2), (3, 6), (0, 4)]],
        [[(0, 0), (4, 0), (4, 4), (8, 4), (4, 4), (0, 4), (0, 0)]],
        [[(0, 0), (9, 0), (9, 9), (0, 9), (0, 0)], [(20, 20), (20, 21), (21, 21), (20, 20)]],
    ]
    cases += [[[(random.random() * 9, random.random() * 9) for _ in range(random.randint(4, 7))]] for _ in range(150)]
    for rings in cases:
        rings = [r if r[0] == r[-1] else r + r[:1] for r in rings]
        assert K.is_valid(shape(*rings)) == reader.read(wkt(*rings)).isValid(), rings


def test_repair(jts):
    pkg, reader = jts
    bow = [(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]
    made = K.repair(shape(bow))
    assert sum(abs(K._area(p[0])) for p in made) == pytest.approx(2.0) and K.is_valid(made)
    assert K.repair(shape([(0, 0), (1, 1), (2, 2), (0, 0)])) is None
    random.seed(4)
    for _ in range(80):
        ring = [(random.random() * 9, random.random() * 9) for _ in range(random.randint(4, 8))]
        ring += ring[:1]
        made = K.repair(shape(ring))
        total = sum(abs(K._area(r)) * (1 if i == 0 else -1) for p in made for i, r in enumerate(p))
        assert K.is_valid(made)
        everything = shape([(-99, -99), (99, -99), (99, 99), (-99, 99), (-99, -99)])
        assert total == pytest.approx(K.overlap_area(shape(ring), everything), abs=1e-7)
    square = [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]
    turned = [(2, 1), (2, 2), (1, 2), (1, 1), (1, 1), (2, 1)]
    assert K.plain(K.repair(shape(square))) == K.plain(K.normalise(shape(turned)))


def test_projection(spark):
    rows = spark.createDataFrame([(33.0, 0.0), (33.0, 60.0), (30.3, 59.9), (36.0, 59.9)], "lon double, lat double")
    got = [r.p for r in rows.select(G.project_point(F.col("lon"), F.col("lat")).alias("p")).collect()]
    assert (got[0].x, got[0].y) == (500000.0, 0.0) and got[1].x == 500000.0
    assert got[1].y == pytest.approx(0.9996 * 6654072.8194, abs=0.01)  # the meridian arc from the equator to 60 degrees
    assert got[2].x == pytest.approx(500000 - 151_000, abs=500) and got[2].x + got[3].x == pytest.approx(1_000_000, abs=17_000)
