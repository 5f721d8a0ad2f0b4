"""WKB headers and cells, transformations, validity, repair, layers."""

import math
import struct

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from strata.functions import crs, wkb
from strata.operators import features, geometry
from strata.session import ship
from workload import inputs

NAN = float("nan")


def ring_bytes(ring, e):
    return struct.pack(e + "I", len(ring)) + np.asarray(ring, e + "f8").tobytes()


def geom(kind, body, e="<", flags=0, srid=None):
    head = bytes([e == "<"]) + struct.pack(e + "I", kind | flags)
    return head + (struct.pack(e + "i", srid) if srid is not None else b"") + body


def polygon(*rings, e="<"):
    return geom(3, struct.pack(e + "I", len(rings)) + b"".join(ring_bytes(r, e) for r in rings), e)


def point(*xy, kind=1, e="<", flags=0, srid=None):
    return geom(kind, np.asarray(xy, e + "f8").tobytes(), e, flags, srid)


def line(*pts, e="<"):
    return geom(2, ring_bytes(pts, e), e)


def multi(kind, *members):
    return geom(kind, struct.pack("<I", len(members)) + b"".join(members))


SQUARE = [(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]
BOX = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]
BOX_HOLE = [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]
FAR = [(x + 5, y + 5) for x, y in SQUARE]


def frame(spark, cells):
    ship(spark)
    rows = [(i, bytearray(c) if c is not None else None) for i, c in enumerate(cells)]
    return spark.createDataFrame(rows, "fid long, geometry binary")


@pytest.mark.parametrize("cell,name,z,m,parts,empty", [
    (point(1, 2), "POINT", False, False, 1, False),
    (point(1, 2, e=">"), "POINT", False, False, 1, False),
    (point(1, 2, 3, kind=1001), "POINT", True, False, 1, False),
    (point(1, 2, 3, flags=0x80000000), "POINT", True, False, 1, False),
    (point(1, 2, 3, 4, kind=3001), "POINT", True, True, 1, False),
    (point(1, 2, 9, flags=0x40000000), "POINT", False, True, 1, False),
    (point(1, 2, flags=0x20000000, srid=4674), "POINT", False, False, 1, False),
    (point(NAN, NAN), "POINT", False, False, 1, True),
    (point(NAN, NAN, flags=0x20000000, srid=4674), "POINT", False, False, 1, True),
    (line(), "LINESTRING", False, False, 1, True),
    (line((0, 0), (1, 1)), "LINESTRING", False, False, 1, False),
    (line((0, 0), (1, 1), e=">"), "LINESTRING", False, False, 1, False),
    (b"\x01\x63\x00\x00\x00", "UNKNOWN", False, False, 1, None),
    (polygon(), "POLYGON", False, False, 1, True),
    (polygon([]), "POLYGON", False, False, 1, True),
    (polygon(SQUARE), "POLYGON", False, False, 1, False),
    (polygon(SQUARE, e=">"), "POLYGON", False, False, 1, False),
    (multi(6, polygon(SQUARE), polygon(FAR)), "MULTIPOLYGON", False, False, 2, False),
    (multi(6, polygon(), polygon()), "MULTIPOLYGON", False, False, 2, True),
    (multi(6), "MULTIPOLYGON", False, False, 0, True),
    (multi(7, point(1, 1), line((0, 0), (1, 1))), "GEOMETRYCOLLECTION", False, False, 2, False),
])
def test_header(spark, cell, name, z, m, parts, empty):
    g = F.col("geometry")
    row = frame(spark, [cell]).select(
        wkb.type_name(g), wkb.has_z(g), wkb.has_m(g), wkb.num_parts(g), wkb.is_empty(g)).first()
    assert tuple(row) == (name, z, m, parts, empty)


def test_vertices_of_mixed_cells(spark):
    cells = [point(1, 2, e=">"), point(1, 2, 3, kind=1001), point(1, 2, 9, flags=0x40000000), None, point(NAN, NAN),
             multi(6, polygon(SQUARE, e=">"), polygon(FAR)), line((0, 0), (2, 3)),
             point(7, 8, flags=0x20000000, srid=4674)]
    rows = geometry.vertices(frame(spark, cells)).orderBy("fid", "part", "ring", "seq").collect()
    assert [(r.fid, r.x, r.y, r.z, r.m) for r in rows if r.kind == 1] == [
        (0, 1.0, 2.0, None, None), (1, 1.0, 2.0, 3.0, None), (2, 1.0, 2.0, None, 9.0), (7, 7.0, 8.0, None, None)]
    assert [(r.part, r.x, r.y) for r in rows if r.fid == 5] == \
        [(0, *map(float, p)) for p in SQUARE] + [(1, *map(float, p)) for p in FAR]
    assert [(r.seq, r.x) for r in rows if r.fid == 6] == [(0, 0.0), (1, 2.0)]


def test_large_geometry_leaves_in_bounded_batches(spark):
    n = 3 * geometry.ROWS_PER_BATCH + 17
    angle = np.linspace(0, 2 * np.pi, n)
    ring = np.column_stack([np.cos(angle), np.sin(angle)])
    df = frame(spark, [polygon(ring), point(1, 1)])
    assert geometry.vertices(df).where("fid = 0").count() == n
    assert geometry.vertices(df).agg(F.max("seq")).first()[0] == n - 1


VALIDITY = {
    "bow-tie": (polygon([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]), False, "Self-intersection"),
    "square": (polygon(SQUARE), True, "Valid Geometry"),
    "big-endian square": (polygon(SQUARE, e=">"), True, "Valid Geometry"),
    "not closed": (polygon(SQUARE[:-1]), False, "Ring not closed"),
    "too few": (polygon([(0, 0), (1, 0), (0, 0)]), False, "Too few points in geometry component"),
    "repeated point": (polygon([(0, 0)] + SQUARE), True, "Valid Geometry"),
    "empty": (polygon(), True, "Valid Geometry"),
    "bad coordinate": (polygon([(NAN, 0), (1, 0), (1, 1), (0, 1), (NAN, 0)]), False, "Invalid Coordinate"),
    "infinite": (polygon([(math.inf, 0), (1, 0), (1, 1), (0, 1), (math.inf, 0)]), False, "Invalid Coordinate"),
    "flat": (polygon([(0, 0), (1, 0), (2, 0), (0, 0)]), False, "Self-intersection"),
    "spike": (polygon([(0, 0), (2, 0), (2, 2), (2, 0), (0, 2), (0, 0)]), False, "Self-intersection"),
    "touch at vertex": (polygon([(0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4), (0, 0)]), False, "Self-intersection"),
    "touch at side": (polygon([(0, 0), (4, 0), (4, 4), (2, 0), (0, 4), (0, 0)]), False, "Self-intersection"),
    "hole": (polygon(BOX, BOX_HOLE), True, "Valid Geometry"),
    "hole outside": (polygon(SQUARE, FAR), False, "Hole lies outside shell"),
    "hole around shell": (polygon(BOX_HOLE, BOX), False, "Hole lies outside shell"),
    "nested holes": (polygon([(-1, -1), (9, -1), (9, 9), (-1, 9), (-1, -1)], BOX, BOX_HOLE), False, "Holes are nested"),
    "two holes": (polygon([(-1, -1), (9, -1), (9, 9), (-1, 9), (-1, -1)], BOX, FAR), True, "Valid Geometry"),
    "touching hole": (polygon(BOX, [(0, 2), (2, 1), (2, 3), (0, 2)]), True, "Valid Geometry"),
    "hole from side to side": (polygon(BOX, [(0, 2), (2, 1), (4, 2), (2, 3), (0, 2)]), False, "Interior is disconnected"),
    "hole between corners": (polygon(BOX, [(0, 0), (3, 1), (4, 4), (1, 3), (0, 0)]), False, "Interior is disconnected"),
    "through a vertex": (polygon([(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)], [(1, 1), (3, 3), (3, -1), (1, 1)]), False, "Self-intersection"),
    "touching from outside": (polygon(BOX, [(4, 2), (6, 1), (6, 3), (4, 2)]), False, "Hole lies outside shell"),
    "holes that touch": (polygon([(-1, -1), (9, -1), (9, 9), (-1, 9), (-1, -1)], [(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)],
                                 [(2, 2), (4, 2), (4, 4), (2, 4), (2, 2)]), True, "Valid Geometry"),
    "holes that touch twice": (polygon([(-1, -1), (9, -1), (9, 9), (-1, 9), (-1, -1)], [(0, 0), (4, 0), (2, 1), (0, 0)],
                                       [(0, 0), (2, 3), (4, 0), (4, 5), (0, 5), (0, 0)]), False, "Interior is disconnected"),
    "three holes in a circle": (polygon([(0, 0), (5, 0), (5, 5), (0, 5), (0, 0)], [(1, 2), (3, 1), (3, 2), (1, 2)],
                                        [(3, 2), (4, 4), (2, 4), (3, 2)], [(1, 2), (2, 4), (1, 4), (1, 2)]),
                                False, "Interior is disconnected"),
    "three holes in a point": (polygon([(0, 0), (6, 0), (6, 6), (0, 6), (0, 0)], [(3, 3), (1, 1), (1, 3), (3, 3)],
                                       [(3, 3), (3, 1), (5, 1), (3, 3)], [(3, 3), (5, 5), (3, 5), (3, 3)]), True, "Valid Geometry"),
    "parts that touch in a corner": (multi(6, polygon(SQUARE), polygon([(x + 1, y + 1) for x, y in SQUARE])), True, "Valid Geometry"),
    "island touching its lake twice": (multi(6, polygon([(-1, -1), (9, -1), (9, 9), (-1, 9), (-1, -1)], BOX),
                                             polygon([(0, 2), (2, 1), (4, 2), (2, 3), (0, 2)])), True, "Valid Geometry"),
    "two parts": (multi(6, polygon(SQUARE), polygon(FAR)), True, "Valid Geometry"),
    "nested shells": (multi(6, polygon(BOX), polygon(BOX_HOLE)), False, "Nested shells"),
    "island in a lake": (multi(6, polygon([(-1, -1), (9, -1), (9, 9), (-1, 9), (-1, -1)], BOX), polygon(BOX_HOLE)),
                         True, "Valid Geometry"),
    "overlapping members": (multi(7, polygon(BOX), polygon([(x + 1, y + 1) for x, y in BOX]), polygon(BOX_HOLE)),
                            True, "Valid Geometry"),
    "bad member": (multi(7, multi(6, polygon(SQUARE), polygon(FAR)), multi(6, polygon(BOX), polygon(BOX_HOLE))),
                   False, "Nested shells"),
    "crossing hole": (polygon([(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)], [(1, 1), (4, 1), (4, 3), (1, 1)]),
                      False, "Self-intersection"),
    "crossing parts": (multi(6, polygon(SQUARE), polygon([(x + .5, y + .5) for x, y in SQUARE])),
                       False, "Self-intersection"),
    "collection": (multi(7, point(1, 1), polygon([(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)])), False, "Self-intersection"),
    "missing": (None, False, None),
    "point": (point(1, 1), True, "Valid Geometry"),
    "bad point": (point(NAN, 1), False, "Invalid Coordinate"),
    "line": (line((0, 0), (1, 1)), True, "Valid Geometry"),
    "crossing line": (line((0, 0), (2, 2), (2, 0), (0, 2)), True, "Valid Geometry"),
    "short line": (line((1, 1), (1, 1)), False, "Too few points in geometry component"),
    "huge": (polygon([(0, 0), (1e308, 0), (1e308, 1e308), (0, 1e308), (0, 0)]), True, "Valid Geometry"),
}


def test_validity(spark):
    names = list(VALIDITY)
    df = frame(spark, [VALIDITY[n][0] for n in names])
    got = {names[r.fid]: (r.valid, r.reason) for r in geometry.validity(df).collect()}
    assert got == {n: v[1:] for n, v in VALIDITY.items()}


def test_repair(spark):
    cells = [polygon(SQUARE[:-1]), polygon([(0, 0)] + SQUARE), polygon([(0, 0), (1, 0), (0, 0)]), polygon(SQUARE, e=">"),
             None, point(1, 1), line((0, 0), (0, 0), (1, 1)), multi(6, polygon(SQUARE[:-1]), polygon(FAR))]
    df = geometry.with_srid(frame(spark, cells), "geometry", 4674)
    out = geometry.repair_simple(df)
    assert geometry.srid_of(out, "geometry") == 4674
    got = [bytes(r.geometry) if r.geometry else None for r in out.orderBy("fid").collect()]
    assert got == [polygon(SQUARE), polygon(SQUARE), polygon(), polygon(SQUARE, e=">"), None, point(1, 1),
                   line((0, 0), (1, 1)), multi(6, polygon(SQUARE), polygon(FAR))]


def test_promote_to_multi(spark):
    cells = [polygon(SQUARE), multi(6, polygon(SQUARE)), point(1, 2), None]
    out = geometry.promote_to_multi(frame(spark, cells), "geometry", "MULTIPOLYGON").orderBy("fid").collect()
    assert [bytes(r.geometry) if r.geometry else None for r in out] == [
        multi(6, polygon(SQUARE)), multi(6, polygon(SQUARE)), multi(4, point(1, 2)), None]


@pytest.mark.parametrize("cells,expected", [
    ([polygon(SQUARE), polygon(FAR)], ("POLYGON", 2)),
    ([polygon(SQUARE), multi(6, polygon(SQUARE), polygon(FAR))], ("MULTIPOLYGON", 2)),
    ([polygon(SQUARE), point(1, 1)], ("GEOMETRYCOLLECTION", 2)),
    ([point(1, 2, 3, 4, kind=3001)], ("POINTZM", 4)),
    ([point(1, 2), None], ("GEOMETRYCOLLECTION", 2)),
])
def test_profile(spark, cells, expected):
    row = geometry.geometry_profile(frame(spark, cells), srid=4674).first()
    assert (row.geometry_type, row.dimension) == expected
    assert (row.num_rows, row.srid) == (len(cells), 4674)


def test_profile_of_nothing_and_of_mixed_srid(spark):
    df = frame(spark, [point(1, 1), point(2, 2)])
    assert geometry.geometry_profile(df.where("false"), srid=4674).first() is None
    with pytest.raises(Exception, match="more than one SRID"):
        geometry.geometry_profile(df.withColumn("srid", F.col("fid") + 1), srid="srid").first()


def snyder_forward(lon, lat, lon0, a, f):
    """Transverse Mercator by the older power series (an independent formula)."""
    e2 = f * (2 - f)
    ep2 = e2 / (1 - e2)
    phi, lam = math.radians(lat), math.radians(lon - lon0)
    n = a / math.sqrt(1 - e2 * math.sin(phi) ** 2)
    t, c, aa = math.tan(phi) ** 2, ep2 * math.cos(phi) ** 2, lam * math.cos(phi)
    m = a * ((1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256) * phi
             - (3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024) * math.sin(2 * phi)
             + (15 * e2**2 / 256 + 45 * e2**3 / 1024) * math.sin(4 * phi) - 35 * e2**3 / 3072 * math.sin(6 * phi))
    k0 = 0.9996
    x = k0 * n * (aa + (1 - t + c) * aa**3 / 6 + (5 - 18 * t + t * t + 72 * c - 58 * ep2) * aa**5 / 120)
    y = k0 * (m + n * math.tan(phi) * (aa**2 / 2 + (5 - t + 9 * c + 4 * c * c) * aa**4 / 24
                                       + (61 - 58 * t + t * t + 600 * c - 330 * ep2) * aa**6 / 720))
    return x + 500000, y + (1e7 if lat < 0 else 0)


@pytest.mark.parametrize("srid,lon0,south", [(31983, -45, True), (31977, -81, True), (31974, -63, False), (32723, -45, True)])
def test_utm_against_independent_series(srid, lon0, south):
    a, rf, _ = crs.DATUMS[crs.crs(srid).datum]
    lon = np.linspace(lon0 - 2.9, lon0 + 2.9, 41)
    lat = np.linspace(-33, -0.5, 41) if south else np.linspace(0.5, 6, 41)
    x, y = crs.transform_arrays(lon, lat, crs.steps(4674, srid))
    want = np.array([snyder_forward(p, q, lon0, a, 1 / rf) for p, q in zip(lon, lat)])
    assert np.abs(np.column_stack([x, y]) - want).max() < 0.01
    back = crs.transform_arrays(x, y, crs.steps(srid, 4674))
    assert np.abs(np.column_stack(back) - np.column_stack([lon, lat])).max() < 1e-9


def test_datum_shift_and_unknown_system():
    x, y = crs.transform_arrays(np.array([-50.0]), np.array([-15.0]), crs.steps(4618, 4674))
    # the published shift moves points of the country by some 60 metres to the south-west
    assert -0.0007 < x[0] + 50 < -0.0003 and -0.0006 < y[0] + 15 < -0.0002
    bx, by = crs.transform_arrays(x, y, crs.steps(4674, 4618))
    assert abs(bx[0] + 50) < 1e-8 and abs(by[0] + 15) < 1e-8
    assert crs.steps(4326, 4674) == []
    with pytest.raises(ValueError, match="unknown SRID"):
        crs.steps(1234, 4674)


def test_reproject_cells_and_columns_agree(spark):
    pts = [(300000.0, 8000000.0), (650000.0, 9500000.0)]
    df = geometry.with_srid(frame(spark, [point(*p) for p in pts] + [None, point(*pts[0], e=">")]), "geometry", 31983)
    cells = geometry.vertices(geometry.reproject(df, "geometry", 4674)).orderBy("fid").collect()
    flat = spark.createDataFrame([(i, *p) for i, p in enumerate(pts)], "fid long, x double, y double")
    cols = geometry.reproject_points(flat, "x", "y", 31983, 4674).orderBy("fid").collect()
    for c, f in zip(cells, cols):
        assert abs(c.x - f.x) < 1e-11 and abs(c.y - f.y) < 1e-11
    assert (cells[2].x, cells[2].y) == (cells[0].x, cells[0].y)


def test_report_ors_over_all_text_columns(spark):
    ship(spark)
    df = spark.createDataFrame(
        [(1, "a\x00b", "ok", bytearray(polygon(SQUARE))), (1, "c", "ok", bytearray(polygon()))],
        "fid long, first string, last string, geometry binary")
    df = geometry.with_srid(df, "geometry", 4326)
    row = features.feature_report(df, geometry.validity(df), 4674).first()
    assert row.null_byte_columns == ["first"] and row.has_null_byte_str
    assert row.fid_is_duplicated and row.crs_is_different and row.has_empty_geometry
    assert not row.has_invalid_geometry


def test_slices_are_bounded_and_whole():
    import pyarrow as pa
    cells = [b"x" * n if n is not None else None for n in (5, None, 3, 20, 0, 4, 4, None)]
    slices = list(geometry._slices(pa.array(cells, pa.binary()), 8))
    assert [c for _, part in slices for c in part.to_pylist()] == cells
    assert [first for first, _ in slices] == [0, *np.cumsum([len(p) for _, p in slices])[:-1].tolist()]
    assert all(sum(len(c or b"") for c in part.to_pylist()) <= 8 or len(part) == 1 for _, part in slices)
    assert list(geometry._slices(pa.array([], pa.binary()))) == []


def test_single_parts_with_srid_join_the_multi_type(spark):
    import struct
    for order, mark in (("<", 1), (">", 0)):
        body = struct.pack(order + "2d", 1.0, 2.0)
        cell = bytes([mark]) + struct.pack(order + "II", 0x20000001, 4674) + body
        want = bytes([mark]) + struct.pack(order + "III", 0x20000004, 4674, 1) + bytes([mark]) + struct.pack(order + "I", 1) + body
        df = spark.createDataFrame([(bytearray(cell),)], "g binary")
        assert bytes(df.select(wkb.to_multi(F.col("g"))).first()[0]) == want


def test_only_cells_that_repair_changes_are_rewritten():
    """One vectorised look names exactly the cells that a rewrite changes; the others keep their bytes."""
    short = [(0, 0), (1, 0), (0, 0)]
    cells = [
        polygon(SQUARE), polygon(SQUARE[:-1]), polygon(short), polygon(), polygon([]), polygon([(0, 0), *SQUARE]),
        polygon(BOX, BOX_HOLE), polygon(BOX, BOX_HOLE[:-1]), polygon(BOX, short), polygon([(NAN, 0), *SQUARE[1:-1], (NAN, 0)]),
        polygon(SQUARE, e=">"), polygon(SQUARE[:-1], e=">"), point(1, 2), point(NAN, NAN), line((0, 0), (1, 2)),
        line((0, 0), (0, 0), (1, 2)), line(), line((1, 1)), multi(6, polygon(SQUARE), polygon(FAR[:-1])), multi(6),
        multi(7, point(1, 1), line((0, 0), (0, 0), (1, 1)), polygon(SQUARE)), multi(4, point(0, 0), point(0, 0)), None,
    ]
    found = geometry._unrepaired(pa.array(cells, pa.binary())).tolist()
    changed = [c is not None and geometry.rewrite(c, geometry._repair_block)[0] != c for c in cells]
    assert found == changed


def test_derived_cells_are_those_of_the_sql(spark, sf_dir):
    spark.read.parquet(f"{sf_dir}/orders.parquet").createOrReplaceTempView("orders")
    base = spark.sql("SELECT " + ", ".join(f"{e} AS {n}" for n, e in inputs.FEATURE_BASE.items()) + " FROM orders")
    made = inputs.with_cells(base).select("fid", "shape", "bx", "byy", "nome", F.hex("geometry").alias("wkb"))
    spelled = spark.sql(inputs.features_sql())
    assert made.count() == spelled.count() > 0
    assert made.exceptAll(spelled).count() == 0
