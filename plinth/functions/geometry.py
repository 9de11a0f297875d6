"""Polygon measures as Column expressions.

A geometry is an array of parts, a part an array of rings (the first is the shell), a ring an array of points (`x`, `y`) that ends where it
starts. All that is measured here stays in the JVM.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

POINT = "struct<x:double,y:double>"
GEOMETRY = f"array<array<array<{POINT}>>>"

_POLYGON = r"\(\s*\([^()]*\)(?:\s*,\s*\([^()]*\))*\s*\)"
_NUMBER = r"[-+]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?"

_PLAIN_NUMBER = r"-?[0-9]+(?:\.[0-9]+)?(?:E-?[0-9]+)?"
_PLAIN = rf"^POLYGON ?\(\({_PLAIN_NUMBER} {_PLAIN_NUMBER}(?:, ?{_PLAIN_NUMBER} {_PLAIN_NUMBER})*\)\)$"


def parse_wkt(wkt: Column) -> Column:
    """POLYGON, MULTIPOLYGON or the polygonal members of a GEOMETRYCOLLECTION as a geometry; null for all else, and for text that can't be read.

    A polygon of one ring, by far the most common, is split at its commas and spaces. Other text becomes JSON by replacing its punctuation, and is parsed as such. A third and later coordinate is dropped.
    """
    text = F.upper(F.trim(wkt))
    typed = text.rlike(r"^(?:SRID=[0-9]+;)?\s*(?:MULTI)?POLYGON\b|^(?:SRID=[0-9]+;)?\s*GEOMETRYCOLLECTION\b")
    areal = F.regexp_replace(text, r"MULTI(?:POINT|LINESTRING)\s*Z?M?\s*\((?:[^()]|\([^()]*\))*\)", "")
    shaped = F.regexp_extract_all(areal, F.lit(_POLYGON), F.lit(0))
    joined = F.regexp_replace(F.regexp_replace(F.array_join(shaped, ","), r"(?<![0-9])\.", "0."), r"\.(?![0-9])", ".0")
    pairs = F.regexp_replace(joined, rf"({_NUMBER})\s+({_NUMBER})(?:\s+{_NUMBER})*", '{"x":$1,"y":$2}')
    plain = F.regexp_replace(pairs, r'([:])\+', "$1")
    json = F.concat(F.lit("["), F.translate(plain, "()", "[]"), F.lit("]"))
    balanced = F.length(F.regexp_replace(text, r"[^(]", "")) == F.length(F.regexp_replace(text, r"[^)]", ""))
    parsed = F.when(typed & balanced, F.from_json(json, GEOMETRY, {"mode": "PERMISSIVE", "allowNonNumericNumbers": "false"}))
    pairs = F.split(F.substring_index(F.substring_index(text, "((", -1), "))", 1), ", ?")
    point = lambda p: F.struct(F.substring_index(p, " ", 1).cast("double").alias("x"), F.substring_index(p, " ", -1).cast("double").alias("y"))
    made = F.when(text.rlike(_PLAIN), F.array(F.array(F.transform(pairs, point)))).otherwise(parsed)

    def whole(geom: Column) -> Column:
        lacking = F.exists(geom, lambda p: p.isNull() | F.exists(p, lambda r: r.isNull() | (F.size(r) < 4) | F.exists(r, lambda q: q.isNull() | q["x"].isNull() | q["y"].isNull())))
        ends = lambda r: (F.element_at(r, 1), F.element_at(r, -1))
        opened = F.exists(geom, lambda p: F.exists(p, lambda r: (ends(r)[0]["x"] != ends(r)[1]["x"]) | (ends(r)[0]["y"] != ends(r)[1]["y"])))
        return geom.isNotNull() & ~lacking & ~opened

    return F.get(F.filter(F.array(made), whole), F.lit(0))  # named once, so that it is worked out once


def to_wkt(geom: Column) -> Column:
    """POLYGON for one part, MULTIPOLYGON for more, null for none."""
    ring = lambda r: F.concat(F.lit("("), F.array_join(F.transform(r, lambda p: F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string"))), ", "), F.lit(")"))
    parts = F.transform(geom, lambda p: F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")")))
    return F.when(F.size(geom) == 1, F.concat(F.lit("POLYGON "), F.element_at(parts, 1))).when(F.size(geom) > 1, F.concat(F.lit("MULTIPOLYGON ("), F.array_join(parts, ", "), F.lit(")")))


def from_rectangle(x: Column, y: Column, w: Column, h: Column) -> Column:
    """The WKT of an axis-aligned rectangle."""
    corner = lambda a, b: F.concat_ws(" ", a.cast("string"), b.cast("string"))
    corners = [corner(x, y), corner(x + w, y), corner(x + w, y + h), corner(x, y + h), corner(x, y)]
    return F.concat(F.lit("POLYGON (("), F.concat_ws(", ", *corners), F.lit("))"))


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)


def _edges(ring: Column, f) -> Column:
    """`f` of each pair of neighbouring points of a ring, as an array."""
    n = F.size(ring) - 1
    return F.zip_with(F.slice(ring, F.lit(1), n), F.slice(ring, F.lit(2), n), f)


def _signed(ring: Column) -> Column:
    """Twice the signed area, taken from the first point, which keeps digits far from the origin."""
    o = F.element_at(ring, 1)
    return _sum(_edges(ring, lambda a, b: (a["x"] - o["x"]) * (b["y"] - o["y"]) - (b["x"] - o["x"]) * (a["y"] - o["y"])))


def ring_area(ring: Column) -> Column:
    return F.abs(_signed(ring)) / 2


def area(geom: Column) -> Column:
    """Shells less holes."""
    part = lambda p: ring_area(F.element_at(p, 1)) - _sum(F.transform(F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))), ring_area))
    return _sum(F.transform(geom, part))


def perimeter(geom: Column) -> Column:
    """Lengths of all rings, holes included."""
    length = lambda r: _sum(_edges(r, lambda a, b: F.sqrt((a["x"] - b["x"]) * (a["x"] - b["x"]) + (a["y"] - b["y"]) * (a["y"] - b["y"]))))
    return _sum(F.transform(F.flatten(geom), length))


def n_vertices(geom: Column) -> Column:
    """Points of the shells, the closing ones included."""
    return F.aggregate(geom, F.lit(0), lambda s, p: s + F.size(F.element_at(p, 1)))


def compactness(area: Column, perimeter: Column) -> Column:
    return F.lit(4 * math.pi) * area / (perimeter * perimeter + F.lit(1e-10))


def bounds(geom: Column) -> Column:
    """`xmin`, `ymin`, `xmax`, `ymax`."""
    points = F.flatten(F.flatten(geom))
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def centroid(geom: Column) -> Column:
    """Area-weighted `x`, `y`; null where the area is 0."""
    fields = ("c", "mx", "my")

    def moments(ring: Column, o: Column, sign: Column) -> Column:
        """Of the area and its first moments about `o`, counted as `sign` says whatever way the ring turns. One walk: the state holds the last point."""
        def step(s: Column, p: Column) -> Column:
            cross = (s["x"] - o["x"]) * (p["y"] - o["y"]) - (p["x"] - o["x"]) * (s["y"] - o["y"])
            mx, my = (s["x"] + p["x"] - 2 * o["x"]) * cross, (s["y"] + p["y"] - 2 * o["y"]) * cross
            return F.struct(p["x"].alias("x"), p["y"].alias("y"), (s["c"] + cross).alias("c"), (s["mx"] + mx).alias("mx"), (s["my"] + my).alias("my"))

        first = F.element_at(ring, 1)
        start = F.struct(first["x"].alias("x"), first["y"].alias("y"), *(F.lit(0.0).alias(f) for f in fields))
        return F.aggregate(ring, start, step, lambda s: F.struct(*((s[f] * sign * F.signum(s["c"])).alias(f) for f in fields)))

    def centre(g: Column) -> Column:
        o = F.element_at(F.element_at(F.element_at(g, 1), 1), 1)
        rings = F.flatten(F.transform(g, lambda p: F.transform(p, lambda r, i: moments(r, o, F.when(i == 0, 1.0).otherwise(-1.0)))))
        zero = F.struct(*(F.lit(0.0).alias(f) for f in fields))
        made = lambda s: F.when(s["c"] != 0, F.struct((o["x"] + s["mx"] / (3 * s["c"])).alias("x"), (o["y"] + s["my"] / (3 * s["c"])).alias("y")))
        return F.aggregate(rings, zero, lambda s, m: F.struct(*((s[f] + m[f]).alias(f) for f in fields)), made)

    return F.when(F.size(geom) > 0, F.element_at(F.transform(F.array(geom), centre), 1))


def with_measures(df, geom: str = "geom"):
    """`df` with `area`, `perimeter`, `n_vertices`, `compactness`, `cx`, `cy`, `xmin`, `ymin`, `xmax`, `ymax`."""
    g = F.col(geom)
    made = df.withColumns({"area": area(g), "perimeter": perimeter(g), "n_vertices": n_vertices(g), "_c": centroid(g), "_b": bounds(g)})
    flat = {"compactness": compactness(F.col("area"), F.col("perimeter")), "cx": F.col("_c.x"), "cy": F.col("_c.y")}
    return made.withColumns(flat | {b: F.col(f"_b.{b}") for b in ("xmin", "ymin", "xmax", "ymax")}).drop("_c", "_b")


# Transverse Mercator, zone 36 north, by Krueger's series to the sixth order in the third flattening (Karney, 2011).
_F, _A, _K0, _E0, _LON0 = 1 / 298.257223563, 6378137.0, 0.9996, 500000.0, 33.0
_N = _F / (2 - _F)
_RADIUS = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
_ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180 - 127 * _N**5 / 288 + 7891 * _N**6 / 37800,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440 + 281 * _N**5 / 630 - 1983433 * _N**6 / 1935360,
    61 * _N**3 / 240 - 103 * _N**4 / 140 + 15061 * _N**5 / 26880 + 167603 * _N**6 / 181440,
    49561 * _N**4 / 161280 - 179 * _N**5 / 168 + 6601661 * _N**6 / 7257600,
    34729 * _N**5 / 80640 - 3418889 * _N**6 / 1995840,
    212378941 * _N**6 / 319334400,
)


def project_point(lon: Column, lat: Column) -> Column:
    """Degrees to metres of zone 36 north."""
    e = math.sqrt(_F * (2 - _F))
    sin = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sin) - e * F.atanh(e * sin))
    dlon = F.radians(lon - _LON0)
    xi, eta = F.atan2(t, F.cos(dlon)), F.atanh(F.sin(dlon) / F.sqrt(1 + t * t))
    north, east = xi, eta
    for k, a in enumerate(_ALPHA, 1):
        north = north + a * F.sin(2 * k * xi) * F.cosh(2 * k * eta)
        east = east + a * F.cos(2 * k * xi) * F.sinh(2 * k * eta)
    return F.struct((_E0 + _K0 * _RADIUS * east).alias("x"), (_K0 * _RADIUS * north).alias("y"))


def project(geom: Column) -> Column:
    """A geometry in degrees in metres of zone 36 north."""
    return F.transform(geom, lambda p: F.transform(p, lambda r: F.transform(r, lambda q: project_point(q["x"], q["y"]))))


def is_degrees(geom: Column) -> Column:
    """Whether a geometry's centre could be one in degrees."""
    c = centroid(geom)
    return c["x"].between(-180, 180) & c["y"].between(-90, 90)


def equirectangular(lat: Column, lon: Column, lat0: Column | float, lon0: Column | float) -> Column:
    """Metres between two points in degrees that lie near each other."""
    lat0, lon0 = (v if isinstance(v, Column) else F.lit(float(v)) for v in (lat0, lon0))
    dy, dx = (lat - lat0) * 111320.0, (lon - lon0) * 111320.0 * F.cos(F.radians(lat0))
    return F.sqrt(dx * dx + dy * dy)
