"""Source, sink, geometry and feature-class queries."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from strata.functions import crs, wkb
from strata.operators import columns, features as feature_ops, geometry, quality
from strata.plans import jobs
from strata.sources import scan, sinks
from strata.spec import FeatureSpec, feature_specs

from .inputs import CHEM_SPEC, SHAPES, double_hex, features, features_sql, select_text, swap8, table, vertices_sql
from .lab import SURVEY_SQL, chem, sql_chem
from .registry import query
from .scratch import new_run_dir

_FEATS = f"feats AS ({features_sql()})"
_VERTS = f"verts AS ({vertices_sql()})"
SPEC = FeatureSpec(source="features", target="layers.features", pk="objectid", geometry="shape", srid=4326)


def fresh(spark, name):
    return new_run_dir(spark, name)


def new_table(name):
    from uuid import uuid4
    return f"{name}_{uuid4().hex[:12]}"


def wkb_features(spark, d):
    """fid, nome, geometry with SRID metadata."""
    df = features(spark, d).select("fid", "nome", "geometry")
    return geometry.with_srid(df, "geometry", 4326)


def hexed(df, *more):
    return df.select("fid", F.hex("geometry").alias("wkb"), *more)


# sources ------------------------------------------------------------------

_ORDERS = "SELECT * FROM orders"


@query("s1_scan_table", _ORDERS)
def _(spark, d):
    return scan.scan_table(spark, f"{d}/orders.parquet", "o_orderkey")


@query("s2_scan_features", f"WITH {_FEATS} SELECT fid, wkb, 4674 AS srid FROM feats")
def _(spark, d):
    path = fresh(spark, "s2")
    features(spark, d).selectExpr("nome", "fid as objectid", "geometry as shape").write.parquet(path)
    df = scan.scan_features(spark, path, "objectid", "shape", 4674)
    return hexed(df, F.lit(geometry.srid_of(df, "geometry")).alias("srid"))


@query("s3_scan_sql", "SELECT o_orderkey AS id, o_totalprice AS preco FROM orders")
def _(spark, d):
    return scan.scan_sql(spark, "SELECT o_orderkey AS id, o_totalprice AS preco FROM {src}", src=table(spark, d, "orders"))


@query("s4_read_layer_parquet", _ORDERS)
def _(spark, d):
    path = sinks.write_layer(table(spark, d, "orders"), fresh(spark, "s4"), "job/bronze", "orders.parquet")
    return scan.read_layer_parquet(spark, path)


@query("s5_scan_dir", _ORDERS)
def _(spark, d):
    return scan.scan_dir(spark, d, "order")


@query("s5_scan_dir_mixed",
       "SELECT o_orderkey AS fid, o_custkey AS only_a, CAST(NULL AS DOUBLE) AS only_b FROM orders UNION ALL "
       "SELECT c_custkey AS fid, NULL AS only_a, c_acctbal AS only_b FROM customer")
def _(spark, d):
    """Files of different columns in one directory: no column is lost."""
    path = fresh(spark, "s5")
    table(spark, d, "orders").selectExpr("o_orderkey as fid", "o_custkey as only_a").write.mode("append").parquet(path)
    table(spark, d, "customer").selectExpr("c_custkey as fid", "c_acctbal as only_b").write.mode("append").parquet(path)
    return scan.scan_dir(spark, path, "part").select("fid", "only_a", "only_b")


@query("s6_read_named_layer", "SELECT c_custkey AS id, c_mktsegment AS nome FROM customer")
def _(spark, d):
    path = sinks.write_layers({
        "valid": table(spark, d, "customer").selectExpr("c_custkey as id", "c_mktsegment as nome"),
        "invalid": table(spark, d, "orders").selectExpr("o_orderkey as id", "o_custkey as reason"),
    }, fresh(spark, "s6"))
    return scan.read_named_layer(spark, path, "valid").drop("reason")


@query("s8_preview", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 10")
def _(spark, d):
    return scan.preview(table(spark, d, "orders").select("o_orderkey", "o_totalprice"), "o_orderkey")


# sinks --------------------------------------------------------------------

@query("k1_write_layer", f"WITH {sql_chem()} SELECT amostra, analito, unidade, qualificador, valor FROM assay")
def _(spark, d):
    path = sinks.write_layer(
        jobs.chem_assay_frame(chem(spark, d), CHEM_SPEC), fresh(spark, "k1"), "chem/silver", "assay.parquet",
        gates={"bad_value": F.col("valor").isNull()})
    return scan.read_layer_parquet(spark, path)


@query("k2_write_features", f"WITH {_FEATS} SELECT fid, wkb, 4326 AS srid FROM feats")
def _(spark, d):
    df = scan.read_layer_parquet(spark, sinks.write_features(wkb_features(spark, d), fresh(spark, "k2")))
    return hexed(df, F.lit(geometry.srid_of(df, "geometry")).alias("srid"))


@query("k3_write_layers",
       "SELECT 'clientes' AS layer, c_custkey AS id, c_mktsegment AS nome, NULL AS preco FROM customer UNION ALL "
       "SELECT 'pedidos' AS layer, o_orderkey AS id, NULL AS nome, o_totalprice AS preco FROM orders")
def _(spark, d):
    path = sinks.write_layers({
        "clientes": table(spark, d, "customer").selectExpr("c_custkey as id", "c_mktsegment as nome"),
        "pedidos": table(spark, d, "orders").selectExpr("o_orderkey as id", "o_totalprice as preco"),
    }, fresh(spark, "k3"))
    return spark.read.parquet(path)


@query("k4_replace_rows", "SELECT o_orderkey AS id, CAST(o_custkey AS DOUBLE) AS v FROM orders")
def _(spark, d):
    name = new_table("k4")
    old = table(spark, d, "customer").selectExpr("c_custkey as id", "c_acctbal as v")
    sinks.replace_table(old, name, fresh(spark, "k4"))
    sinks.replace_rows(table(spark, d, "orders").selectExpr("o_custkey as v", "o_orderkey as id"), name)
    return spark.table(name)


@query("k5_replace_survey_and_assay",
       f"WITH {sql_chem()} SELECT assay.amostra, analito, unidade, valor, survey.duplicata FROM assay "
       f"JOIN ({SURVEY_SQL}) survey ON survey.objectid = assay.amostra")
def _(spark, d):
    bronze, root = chem(spark, d), fresh(spark, "k5")
    survey, assay = jobs.survey_frame(bronze, CHEM_SPEC), jobs.chem_assay_frame(bronze, CHEM_SPEC)
    sinks.replace_survey_and_assay(survey.where("duplicata"), assay.where("valor > 1"), root)
    sinks.replace_survey_and_assay(survey, assay, root)
    survey, assay = sinks.published(spark, root)
    return assay.join(survey.selectExpr("objectid as amostra", "duplicata"), "amostra") \
        .select("amostra", "analito", "unidade", "valor", "duplicata")


@query("k6_replace_table", "SELECT c_custkey AS fid, c_mktsegment AS nome FROM customer")
def _(spark, d):
    name, path = new_table("k6"), fresh(spark, "k6")
    sinks.replace_table(table(spark, d, "orders").selectExpr("o_orderkey as id"), name, path)
    sinks.replace_table(table(spark, d, "customer").selectExpr("c_custkey as fid", "c_mktsegment as nome"), name, path)
    return spark.table(name)


@query("k7_analyze_table", "SELECT 'lineitem' AS table_name, count(*) AS num_rows FROM lineitem")
def _(spark, d):
    name = new_table("k7")
    sinks.replace_table(table(spark, d, "lineitem"), name, fresh(spark, "k7"))
    sinks.analyze_table(spark, name)
    return sinks.table_statistics(spark, name).withColumn("table_name", F.lit("lineitem"))


@query("k8_refresh_views",
       f"WITH {sql_chem()} SELECT 'views' AS esquema, 'analises' AS nome, amostra, valor FROM assay UNION ALL "
       "SELECT 'public' AS esquema, 'amostras' AS nome, objectid AS amostra, longitude AS valor FROM bronze")
def _(spark, d):
    bronze, root = chem(spark, d), fresh(spark, "k8")
    paths = sinks.refresh_views(root, {
        "views.analises": jobs.chem_assay_frame(bronze, CHEM_SPEC),
        "amostras": jobs.survey_frame(bronze, CHEM_SPEC),
    })

    def part(item, key, value):
        schema, name = sinks.view_name(item)
        return spark.read.parquet(paths[item]).select(
            F.lit(schema).alias("esquema"), F.lit(name).alias("nome"),
            F.col(key).alias("amostra"), F.col(value).alias("valor"))

    return part("views.analises", "amostra", "valor").unionByName(part("amostras", "objectid", "longitude"))


@query("k9_load_audit",
       "SELECT 'gold.pedidos' AS target, count(*) AS rows_inserted FROM orders UNION ALL "
       "SELECT 'gold.itens' AS target, count(*) AS rows_inserted FROM lineitem")
def _(spark, d):
    root = fresh(spark, "k9")
    sinks.load_audit(table(spark, d, "orders"), f"{root}/a", "gold.pedidos", f"{root}/audit")
    return sinks.load_audit(table(spark, d, "lineitem"), f"{root}/b", "gold.itens", f"{root}/audit") \
        .select("target", "rows_inserted")


@query("k10_clone_schema", f"WITH {_FEATS} SELECT fid, nome, wkb FROM feats")
def _(spark, d):
    """Clone the structure with renamed key and geometry, then load through it."""
    name, source = new_table("k10"), features(spark, d).selectExpr("fid as objectid", "nome", "geometry as shape")
    renames = {"objectid": "fid", "shape": "geometry"}
    sinks.clone_schema(source, name, renames, fresh(spark, "k10"))
    sinks.clone_schema(source.drop("nome"), name, renames)
    sinks.replace_rows(columns.rename(source, renames), name)
    return hexed(spark.table(name), "nome")


# headers ------------------------------------------------------------------

_NAMES = {1: "POINT", 2: "LINESTRING", 3: "POLYGON", 4: "MULTIPOINT", 6: "MULTIPOLYGON"}


def _shapes(test) -> str:
    """The numbers of the shapes whose type code and parts pass the test."""
    return ", ".join(str(i) for i, s in SHAPES.items() if s and test(*s))


_KIND = "CASE " + " ".join(f"WHEN shape IN ({_shapes(lambda c, _: c % 1000 == k)}) THEN '{n}'" for k, n in _NAMES.items()) + " END"
_PARTS = f"CASE WHEN shape IN ({_shapes(lambda c, parts: len(parts) == 2)}) THEN 2 WHEN shape <> 11 THEN 1 END"
_EMPTY = "CASE WHEN shape = 11 THEN NULL ELSE shape IN (5, 18) END"


@query("g3_wkb_header",
       f"SELECT fid, {_KIND} AS kind, CASE WHEN shape <> 11 THEN shape = 15 END AS z, "
       f"CASE WHEN shape <> 11 THEN false END AS m, CAST({_PARTS} AS BIGINT) AS parts FROM ({features_sql()}) f")
def _(spark, d):
    g = F.col("geometry")
    return features(spark, d).select(
        "fid", wkb.type_name(g).alias("kind"), wkb.has_z(g).alias("z"), wkb.has_m(g).alias("m"),
        wkb.num_parts(g).alias("parts"))


@query("g4_geometry_profile",
       "SELECT count(*) AS num_rows, CAST(4326 AS BIGINT) AS srid, 'GEOMETRYCOLLECTIONZ' AS geometry_type, 3 AS dimension FROM orders")
def _(spark, d):
    return geometry.geometry_profile(wkb_features(spark, d))


@query("g4_geometry_profile_multi",
       f"SELECT count(*) AS num_rows, CAST(4674 AS BIGINT) AS srid, 'MULTIPOLYGON' AS geometry_type, 2 AS dimension "
       f"FROM ({features_sql()}) f WHERE {_KIND} IN ('POLYGON', 'MULTIPOLYGON')")
def _(spark, d):
    df = features(spark, d).where(wkb.base_type(F.col("geometry")).isin(3, 6)).withColumn("srid", F.lit(4674))
    return geometry.geometry_profile(df, srid="srid")


@query("g5_promote_to_multi",
       f"WITH {_FEATS} SELECT fid, CASE WHEN {_KIND} = 'POLYGON' THEN '010600000001000000' || wkb "
       f"WHEN {_KIND} = 'POINT' AND shape <> 15 THEN '010400000001000000' || wkb WHEN shape = 15 THEN '01EC03000001000000' || wkb "
       f"WHEN {_KIND} = 'LINESTRING' THEN '010500000001000000' || wkb ELSE wkb END AS wkb FROM feats")
def _(spark, d):
    return hexed(geometry.promote_to_multi(wkb_features(spark, d), "geometry", "MULTIPOLYGON"))


@query("g5_promote_srid_headers",
       f"WITH {_FEATS} SELECT fid, CASE WHEN {_KIND} = 'POLYGON' "
       "THEN '0106000020E6100000010000000103000000' || substr(wkb, 11) ELSE wkb END AS wkb FROM feats")
def _(spark, d):
    """Polygons with the SRID in their header: it moves to the multi wrapper."""
    g = F.hex("geometry")
    with_srid = F.unhex(F.concat(F.lit("0103000020E6100000"), F.substring(g, F.lit(11), F.length(g))))
    polygon = wkb.base_type(F.col("geometry")) == wkb.POLYGON
    df = wkb_features(spark, d).withColumn("geometry", F.when(polygon, with_srid).otherwise(F.col("geometry")))
    return hexed(df.withColumn("geometry", F.when(polygon, wkb.to_multi(F.col("geometry"))).otherwise(F.col("geometry"))))


@query("g6_crs_differs",
       "SELECT fid, true AS crs_is_different, false AS same_crs FROM (SELECT o_orderkey AS fid FROM orders) f")
def _(spark, d):
    df = wkb_features(spark, d)
    return df.select("fid", F.lit(geometry.crs_differs(df, "geometry", 4674)).alias("crs_is_different"),
                     F.lit(geometry.crs_differs(df, "geometry", 4326)).alias("same_crs"))


@query("g8_is_empty", f"SELECT fid, shape = 11 AS missing, {_EMPTY} AS empty FROM ({features_sql()}) f")
def _(spark, d):
    g = F.col("geometry")
    return features(spark, d).select("fid", g.isNull().alias("missing"), wkb.is_empty(g).alias("empty"))


@query("g8_geometry_present",
       f"SELECT count(*) FILTER (WHERE shape = 11) AS n_null, count(*) FILTER (WHERE {_EMPTY}) AS n_empty FROM ({features_sql()}) f")
def _(spark, d):
    g = F.col("geometry")
    return quality.geometry_present(features(spark, d), g.isNull(), wkb.is_empty(g))


@query("a8_geometry_types",
       f"SELECT string_agg(DISTINCT {_KIND}, ',' ORDER BY {_KIND}) AS types FROM ({features_sql()}) f")
def _(spark, d):
    return features(spark, d).agg(geometry.geometry_types(features(spark, d), "geometry").alias("types"))


# vertices -----------------------------------------------------------------

@query("g2_vertices", f"WITH {_VERTS} SELECT fid, part, kind, ring, seq, x, y, z FROM verts")
def _(spark, d):
    return geometry.vertices(features(spark, d)).drop("m")


# transformations ----------------------------------------------------------

UTM_ZONE_23S = 31983
_UTM = {"fid": "o_orderkey", "x": "200000 + (o_orderkey * 7919) % 600000", "y": "1000000 + (o_custkey * 6007) % 8900000"}


def sql_from_utm(x: str, y: str, source: str, datum: str = "sirgas2000", zone: int = 23) -> str:
    """The published series written out as SQL: fid, lon, lat."""
    a, rf, _ = crs.DATUMS[datum]
    f = 1 / rf
    n = f / (2 - f)
    radius = a / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    beta = [n / 2 - 2 * n**2 / 3 + 37 * n**3 / 96 - n**4 / 360, n**2 / 48 + n**3 / 15 - 437 * n**4 / 1440,
            17 * n**3 / 480 - 37 * n**4 / 840, 4397 * n**4 / 161280]
    delta = [2 * n - 2 * n**2 / 3 - 2 * n**3 + 116 * n**4 / 45, 7 * n**2 / 3 - 8 * n**3 / 5 - 227 * n**4 / 45,
             56 * n**3 / 15 - 136 * n**4 / 35, 4279 * n**4 / 630]

    def num(v):
        return f"CAST({v!r} AS DOUBLE)"

    size = 0.9996 * radius
    xp = "xi - (" + " + ".join(f"{num(b)} * sin({2 * j} * xi) * cosh({2 * j} * eta)" for j, b in enumerate(beta, 1)) + ")"
    ep = "eta - (" + " + ".join(f"{num(b)} * cos({2 * j} * xi) * sinh({2 * j} * eta)" for j, b in enumerate(beta, 1)) + ")"
    lat = "chi + " + " + ".join(f"{num(c)} * sin({2 * j} * chi)" for j, c in enumerate(delta, 1))
    return (
        f"SELECT fid, degrees(lam) + {zone * 6 - 183} AS lon, degrees({lat}) AS lat FROM ("
        f"SELECT fid, asin(sin(xp) / cosh(ep)) AS chi, atan2(sinh(ep), cos(xp)) AS lam FROM ("
        f"SELECT fid, {xp} AS xp, {ep} AS ep FROM (SELECT fid, (({y}) - 10000000) / {num(size)} AS xi, "
        f"(({x}) - 500000) / {num(size)} AS eta FROM {source}) a) b) c"
    )


def micro(c: str) -> str:
    return f"CAST(floor({c} * 1e6 + 0.5) AS BIGINT)"


_LONLAT = sql_from_utm("x", "y", f"({select_text(_UTM, 'orders')}) u")


@query("g7_reproject_points", f"SELECT fid, {micro('lon')} AS x, {micro('lat')} AS y FROM ({_LONLAT}) q")
def _(spark, d):
    pts = table(spark, d, "orders").selectExpr(*[f"cast({e} as {'bigint' if n == 'fid' else 'double'}) as {n}" for n, e in _UTM.items()])
    out = geometry.reproject_points(pts, "x", "y", UTM_ZONE_23S, 4674)
    return out.selectExpr("fid", f"{micro('x')} as x", f"{micro('y')} as y")


def _utm_wkb(source: str) -> str:
    h = ", ".join(f"{double_hex(f'({c})')} AS h{c}" for c in "xy")
    return (f"SELECT fid, '0101000000' || {swap8('hx')} || {swap8('hy')} AS wkb FROM "
            f"(SELECT fid, {h} FROM ({select_text(_UTM, source)}) u0) u1")


@query("g7_reproject", f"SELECT fid, 0 AS seq, {micro('lon')} AS x, {micro('lat')} AS y, 4674 AS srid FROM ({_LONLAT}) q")
def _(spark, d):
    src = spark.sql(_utm_wkb("{orders}"), orders=table(spark, d, "orders")).selectExpr("fid", "unhex(wkb) as geometry")
    df = geometry.reproject(geometry.with_srid(src, "geometry", UTM_ZONE_23S), "geometry", 4674)
    return geometry.vertices(df).selectExpr(
        "fid", "seq", f"{micro('x')} as x", f"{micro('y')} as y", f"{geometry.srid_of(df, 'geometry')} as srid")


@query("g7_reproject_identity", f"WITH {_FEATS} SELECT fid, wkb FROM feats")
def _(spark, d):
    return hexed(geometry.reproject(wkb_features(spark, d), "geometry", 4674))


# validity -----------------------------------------------------------------

# Brute force over the small rings of the fixture shapes: every pair of sides of a
# feature, by solving for the intersection parameters.
_SIDES = (
    "sides AS (SELECT a.fid, a.part, a.ring, a.seq, a.x AS x1, a.y AS y1, b.x - a.x AS dx, b.y - a.y AS dy "
    "FROM verts a JOIN verts b ON a.fid = b.fid AND a.part = b.part AND a.ring = b.ring AND b.seq = a.seq + 1 "
    "WHERE a.kind = 3 AND isfinite(a.x) AND isfinite(b.x) AND (a.x <> b.x OR a.y <> b.y)), "
    "pairs AS (SELECT a.fid, a.part = b.part AND a.ring = b.ring AS same, a.dx * b.dy - a.dy * b.dx AS det, "
    "(b.x1 - a.x1) * b.dy - (b.y1 - a.y1) * b.dx AS tn, (b.x1 - a.x1) * a.dy - (b.y1 - a.y1) * a.dx AS un, "
    "((b.x1 - a.x1) * a.dx + (b.y1 - a.y1) * a.dy) / (a.dx * a.dx + a.dy * a.dy) AS p0, "
    "((b.x1 + b.dx - a.x1) * a.dx + (b.y1 + b.dy - a.y1) * a.dy) / (a.dx * a.dx + a.dy * a.dy) AS p1 "
    "FROM sides a JOIN sides b ON a.fid = b.fid AND (a.part < b.part OR (a.part = b.part AND (a.ring < b.ring OR "
    "(a.ring = b.ring AND a.seq < b.seq))))), "
    "crossed AS (SELECT DISTINCT fid FROM pairs WHERE "
    "(det <> 0 AND tn / det > 0 AND tn / det < 1 AND un / det > 0 AND un / det < 1) "
    "OR (det = 0 AND un = 0 AND least(greatest(p0, p1), 1) > greatest(least(p0, p1), 0)) "
    "OR (same AND det = 0 AND un = 0 AND least(greatest(p0, p1), 1) >= greatest(least(p0, p1), 0) AND p0 <> 1 AND p1 <> 0) "
    "OR (same AND det <> 0 AND tn / det BETWEEN 0 AND 1 AND un / det BETWEEN 0 AND 1 "
    "AND NOT (tn / det = 1 AND un / det = 0) AND NOT (tn / det = 0 AND un / det = 1))), "
    # directions of each ring around every point where rings meet; two rings cross there if one has a single direction between the other's
    "spots AS (SELECT DISTINCT fid, x1 AS px, y1 AS py FROM sides), "
    "passes AS (SELECT s.*, px, py FROM sides s JOIN spots p ON s.fid = p.fid AND dx * (py - y1) = dy * (px - x1) "
    "AND (px - x1) * dx + (py - y1) * dy BETWEEN 0 AND dx * dx + dy * dy), "
    "ways AS (SELECT fid, px, py, part, ring, atan2(y1 + dy - py, x1 + dx - px) AS w FROM passes WHERE x1 + dx <> px OR y1 + dy <> py "
    "UNION ALL SELECT fid, px, py, part, ring, atan2(y1 - py, x1 - px) FROM passes WHERE x1 <> px OR y1 <> py), "
    "wedges AS (SELECT fid, px, py, part, ring, min(w) AS lo, max(w) AS hi FROM ways GROUP BY ALL), "
    "through AS (SELECT DISTINCT a.fid FROM wedges a JOIN wedges b ON a.fid = b.fid AND a.px = b.px AND a.py = b.py "
    "AND (a.part <> b.part OR a.ring <> b.ring) WHERE (b.lo > a.lo AND b.lo < a.hi) <> (b.hi > a.lo AND b.hi < a.hi)), "
    # rings and contacts of a part as a graph: more edges than a forest has
    "meets AS (SELECT * FROM wedges QUALIFY count(*) OVER (PARTITION BY fid, part, px, py) > 1), "
    "links AS (SELECT DISTINCT a.fid, a.part, a.ring AS a, b.ring AS b FROM meets a JOIN meets b USING (fid, part, px, py)), "
    "reach AS (SELECT * FROM links UNION SELECT r.fid, r.part, r.a, l.b FROM reach r JOIN links l ON r.fid = l.fid AND r.part = l.part AND r.b = l.a), "
    "trees AS (SELECT fid, part, count(DISTINCT first) AS n FROM (SELECT fid, part, a, min(b) AS first FROM reach GROUP BY ALL) GROUP BY ALL), "
    "cut AS (SELECT m.fid FROM meets m JOIN trees t ON m.fid = t.fid AND m.part = t.part GROUP BY m.fid, m.part, t.n "
    "HAVING count(*) > count(DISTINCT ring) + count(DISTINCT (px, py)) - t.n), "
    "samples AS (SELECT fid, part, ring, arg_min(x1 + 0.4142 * dx, seq) AS px, arg_min(y1 + 0.4142 * dy, seq) AS py FROM sides GROUP BY ALL), "
    "hits AS (SELECT r.fid, r.part, r.ring, s.part AS op, s.ring AS o_ring FROM samples r JOIN sides s ON r.fid = s.fid "
    "AND (r.part <> s.part OR r.ring <> s.ring) AND ((s.x1 <= px AND px < s.x1 + s.dx) OR (s.x1 + s.dx <= px AND px < s.x1)) "
    "AND s.y1 + s.dy * (px - s.x1) / s.dx > py GROUP BY ALL HAVING count(*) % 2 = 1), "
    "nests AS (SELECT fid, 5 AS code FROM samples r WHERE ring > 0 AND NOT EXISTS (SELECT 1 FROM hits h WHERE h.fid = r.fid "
    "AND h.part = r.part AND h.ring = r.ring AND h.op = r.part AND h.o_ring = 0) "
    "UNION ALL SELECT fid, 6 FROM hits WHERE ring > 0 AND op = part AND o_ring > 0 "
    "UNION ALL SELECT fid, 7 FROM hits h WHERE ring = 0 AND op <> part AND o_ring = 0 AND NOT EXISTS (SELECT 1 FROM hits g "
    "WHERE g.fid = h.fid AND g.part = h.part AND g.ring = 0 AND g.op = h.op AND g.o_ring > 0)), "
)
_AUDIT = (
    f"{_FEATS}, {_VERTS}, {_SIDES}"
    "firsts AS (SELECT fid, part, ring, arg_min(x, seq) AS fx, arg_min(y, seq) AS fy, arg_max(x, seq) AS lx, "
    "arg_max(y, seq) AS ly, count(*) AS n, bool_or(isnan(x) OR isnan(y)) AS bad FROM verts WHERE kind = 3 GROUP BY ALL), "
    "side_counts AS (SELECT fid, part, ring, count(*) AS n FROM sides GROUP BY ALL), "
    "rings AS (SELECT f.fid, CASE WHEN bad THEN 0 WHEN fx <> lx OR fy <> ly THEN 1 WHEN coalesce(s.n, 0) < 3 THEN 2 END AS code "
    "FROM firsts f LEFT JOIN side_counts s ON f.fid = s.fid AND f.part = s.part AND f.ring = s.ring), "
    "still AS (SELECT fid, 2 AS code FROM verts WHERE kind = 2 GROUP BY fid, part HAVING count(DISTINCT (x, y)) < 2), "
    "codes AS (SELECT fid, code FROM rings UNION ALL SELECT fid, code FROM still UNION ALL SELECT fid, 3 FROM crossed "
    "UNION ALL SELECT fid, 3 FROM through UNION ALL SELECT fid, 8 FROM cut UNION ALL SELECT fid, code FROM nests), "
    "worst AS (SELECT fid, min(code) AS code FROM codes GROUP BY fid), "
    "audit AS (SELECT f.fid, f.shape, f.nome, f.wkb, CASE WHEN f.shape = 11 THEN false ELSE w.code IS NULL END AS valid, "
    "CASE WHEN f.shape = 11 THEN NULL ELSE CASE w.code WHEN 0 THEN 'Invalid Coordinate' WHEN 1 THEN 'Ring not closed' "
    "WHEN 2 THEN 'Too few points in geometry component' WHEN 3 THEN 'Self-intersection' "
    "WHEN 5 THEN 'Hole lies outside shell' WHEN 6 THEN 'Holes are nested' WHEN 7 THEN 'Nested shells' "
    "WHEN 8 THEN 'Interior is disconnected' "
    "ELSE 'Valid Geometry' END END AS reason FROM feats f LEFT JOIN worst w ON f.fid = w.fid) "
)


@query("g9_validity", f"WITH RECURSIVE {_AUDIT} SELECT fid, valid, reason FROM audit")
def _(spark, d):
    return geometry.validity(features(spark, d))


@query("a5_value_counts_validity", f"WITH RECURSIVE {_AUDIT} SELECT reason, count(*) AS n FROM audit GROUP BY reason")
def _(spark, d):
    return quality.value_counts(geometry.validity(features(spark, d)), "reason")


# repaired vertices: repeats dropped by comparing neighbours, rings closed, short rings dropped
_REPAIRED = (
    f"{_VERTS}, marked AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py, lag(seq) OVER w AS ps FROM verts "
    "WINDOW w AS (PARTITION BY fid, part, ring ORDER BY seq)), "
    "moved AS (SELECT fid, part, kind, ring, seq, x, y FROM marked WHERE ps IS NULL OR x <> px OR y <> py OR isnan(x) "
    f"OR (kind = 2 AND fid % {len(SHAPES)} = 13)), "
    "ends AS (SELECT fid, part, ring, arg_min(x, seq) AS fx, arg_min(y, seq) AS fy, arg_max(x, seq) AS lx, arg_max(y, seq) AS ly, "
    "max(seq) AS last FROM moved WHERE kind = 3 GROUP BY ALL), "
    "closed AS (SELECT * FROM moved UNION ALL SELECT fid, part, 3, ring, last + 1, fx, fy FROM ends "
    "WHERE fx <> lx OR fy <> ly OR isnan(fx)), "
    "sized AS (SELECT *, count(*) OVER (PARTITION BY fid, part, ring) AS n FROM closed) "
)


@query("g10_repair_simple",
       f"WITH {_REPAIRED} SELECT fid, part, kind, ring, x, y, "
       "CAST(row_number() OVER (PARTITION BY fid, part, ring ORDER BY seq) - 1 AS INTEGER) AS seq FROM sized WHERE kind <> 3 OR n >= 4")
def _(spark, d):
    repaired = geometry.repair_simple(wkb_features(spark, d))
    return geometry.vertices(repaired).drop("z", "m")


@query("g11_split_layers",
       f"WITH RECURSIVE {_AUDIT} SELECT 'invalid' AS layer, fid, reason AS invalid_reason FROM audit WHERE NOT valid UNION ALL "
       "SELECT 'invalid_after_autorepair' AS layer, fid, reason AS invalid_reason FROM audit WHERE NOT valid AND shape NOT IN (2, 3) "
       "UNION ALL SELECT 'valid' AS layer, fid, NULL AS invalid_reason FROM audit")
def _(spark, d):
    df = wkb_features(spark, d)
    root = fresh(spark, "g11")

    def stored(part, frame):
        """Used more than once: written, so that neither audit nor repair runs again for each use."""
        return scan.read_layer_parquet(spark, sinks.write_checked(frame, f"{root}/{part}"))

    faults = stored("faults", feature_ops.faults_of(geometry.validity(df)))
    repaired = stored("repaired", geometry.repair_simple(df.join(faults, "fid", "left_semi")))
    left = feature_ops.faults_of(geometry.validity(repaired))
    path = sinks.write_layers(feature_ops.split_layers(df, faults, repaired, left), root)
    return spark.read.parquet(path).select("layer", "fid", "invalid_reason")


_NUL_NOME = "if(fid % 50 = 0, concat(nome, chr(0)), nome)"


@query("q8_feature_report",
       f"WITH RECURSIVE {_AUDIT} SELECT 'LINESTRING,MULTIPOINT,MULTIPOLYGON,POINT,POLYGON' AS geometry_types, true AS crs_is_different, "
       "bool_or(shape IN (5, 18)) AS has_empty_geometry, 'nome' AS null_byte_columns, count(*) <> count(DISTINCT fid) AS fid_is_duplicated, "
       "bool_or(valid = false) AS has_invalid_geometry, bool_or(valid IS NULL) AS has_unchecked_geometry, true AS has_null_byte_str FROM audit")
def _(spark, d):
    df = features(spark, d).selectExpr("fid", f"{_NUL_NOME} as nome", "string(shape) as forma", "geometry")
    df = geometry.with_srid(df, "geometry", 4326)
    report = feature_ops.feature_report(df, geometry.validity(df), 4674)
    return report.withColumn("null_byte_columns", F.array_join("null_byte_columns", ","))


# jobs ---------------------------------------------------------------------

def _source(spark, d):
    return features(spark, d).selectExpr("fid as objectid", f"{_NUL_NOME} as nome", "geometry as shape")


@query("j7_feature_class",
       f"WITH RECURSIVE {_AUDIT} "
       "SELECT fid, nome, shape = 11 AS missing, CASE WHEN shape = 11 THEN NULL ELSE shape IN (5, 3, 18) END AS empty FROM audit")
def _(spark, d):
    """Whole run; the loaded table holds every feature, short rings gone after repair."""
    paths = jobs.run_features(_source(spark, d), SPEC, fresh(spark, "j7"))
    g = F.col("geometry")
    return spark.read.parquet(paths["gold"]).select(
        "fid", "nome", g.isNull().alias("missing"), wkb.is_empty(g).alias("empty"))


@query("j7_load_audit", "SELECT 'layers.features' AS target, count(*) AS rows_inserted FROM orders")
def _(spark, d):
    paths = jobs.run_features(_source(spark, d), SPEC, fresh(spark, "j7"))
    return spark.read.parquet(paths["audit"]).select("target", "rows_inserted")


@query("j8_migrate_layer", f"WITH {_FEATS} SELECT fid, CAST(byy AS BIGINT) AS cota, nome, wkb FROM feats")
def _(spark, d):
    source = features(spark, d).selectExpr("fid as objectid", "cast(byy as string) as cota", "nome", "geometry as shape")
    out = jobs.migrate_layer(source, SPEC, fresh(spark, "j8"), new_table("j8"))
    return hexed(out["layer"], "cota", "nome")


@query("j8_migrate_profile",
       f"WITH {_FEATS} SELECT 'fid' AS column_name, count(fid) AS non_null, 'bigint' AS data_type FROM feats UNION ALL "
       "SELECT 'nome', count(nome), 'string' FROM feats UNION ALL SELECT 'geometry', count(wkb), 'binary' FROM feats")
def _(spark, d):
    source = features(spark, d).selectExpr("fid as objectid", "nome", "geometry as shape")
    return jobs.migrate_layer(source, SPEC, fresh(spark, "j8"), new_table("j8"))["profile"]


@query("j9_reload_dir", "SELECT 'orders' AS table_name, count(*) AS rows, CAST(NULL AS BIGINT) AS valid, "
                        "CAST(NULL AS BIGINT) AS invalid, CAST(NULL AS BIGINT) AS unchecked FROM orders")
def _(spark, d):
    return jobs.reload_dir(spark, d, "order", fresh(spark, "j9"))


_COUNTED = "count(*) AS rows, count_if(valid) AS valid, count_if(NOT valid) AS invalid, count_if(valid IS NULL) AS unchecked"


@query("j9_reload_layers",
       f"WITH RECURSIVE {_AUDIT} SELECT {_COUNTED} FROM audit UNION ALL SELECT {_COUNTED} FROM audit WHERE shape IN (0, 1, 5, 11)")
def _(spark, d):
    """Two layers of different columns in one directory: a table and its validity counts for each."""
    path, df = fresh(spark, "j9-files"), features(spark, d)
    df.select("fid", "nome", "geometry").write.parquet(f"{path}/part-all.parquet")
    df.where("shape in (0, 1, 5, 11)").select("fid", "bx", "geometry").write.parquet(f"{path}/part-some.parquet")
    return jobs.reload_dir(spark, path, "part", fresh(spark, "j9")).drop("table_name")


@query("j7_target_table", "SELECT 'features' AS table_name, count(*) AS num_rows FROM orders")
def _(spark, d):
    """The load replaces the rows of the target and computes its statistics."""
    name = new_table("j7")
    jobs.run_features(_source(spark, d), dataclasses.replace(SPEC, target=name), fresh(spark, "j7"), load=True)
    return sinks.table_statistics(spark, name).withColumn("table_name", F.lit("features"))


_LAYERS = {"geo.outcrop": "shape in (0, 1, 5, 11)", "geo.contact": "shape in (9, 13)", "geo.station": "shape in (8, 15, 18)"}


@query("j11_all_features", " UNION ALL ".join(
    f"SELECT '{layer}' AS layer, 'gold.{layer.replace('.', '_')}' AS target, count(*) AS rows_inserted FROM ({features_sql()}) f WHERE {where}"
    for layer, where in _LAYERS.items()))
def _(spark, d):
    specs = feature_specs(list(_LAYERS), "gold", srid=4326)
    sources = {layer: _shaped(spark, d).where(where.replace("shape", "forma")).drop("forma") for layer, where in _LAYERS.items()}
    root = fresh(spark, "j11")
    jobs.run_all_features(sources, specs, root)
    layer = F.create_map(*[F.lit(x) for s in specs.values() for x in (s.target, s.source)])[F.col("target")]
    return spark.read.parquet(f"{root}/load_audit").select(layer.alias("layer"), "target", "rows_inserted")


def _shaped(spark, d):
    return features(spark, d).selectExpr("fid as objectid", f"{_NUL_NOME} as nome", "geometry as shape", "shape as forma")
