"""Geometry as WKB cells and as relations over their points.

A geometry stays one BINARY cell next to its attributes. Where coordinates are
needed, Arrow batches of cells are opened inside the tasks: either rewritten in
place (reprojection, repair: no shuffle at all) or spread into rows of vertices
or segments, on which everything else is joins and grouping.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import crs, wkb
from . import quality, reshape

ROWS_PER_BATCH = 1 << 16

VERTEX_FIELDS = "part int, kind int, ring int, seq int, x double, y double, z double, m double"
SEGMENT_FIELDS = "part int, kind int, ring int, seq int, closes boolean, x1 double, y1 double, x2 double, y2 double"
PLACED_FIELDS = "body int, part int, ring int, seq int, rings int, x1 double, y1 double, x2 double, y2 double, " \
    "level int, cx bigint, cy bigint"
COLUMN_FIELDS = "body int, part int, ring int, sample boolean, x1 double, y1 double, x2 double, y2 double, cx bigint, " \
    "level int, cy bigint"


# point structs ------------------------------------------------------------

def point(x: Column, y: Column, srid: int) -> Column:
    """Point struct, NULL when either coordinate is missing."""
    x, y = x.cast("double"), y.cast("double")
    return F.when(
        x.isNotNull() & y.isNotNull(),
        F.struct(x.alias("x"), y.alias("y"), F.lit(srid).alias("srid")),
    )


def points_from_xy(df: DataFrame, x: str, y: str, srid: int, name: str = "geometry") -> DataFrame:
    return df.withColumn(name, point(F.col(x), F.col(y), srid))


# SRID in field metadata ---------------------------------------------------

def with_srid(df: DataFrame, geom: str, srid: int, **more) -> DataFrame:
    return df.withColumn(geom, F.col(geom).alias(geom, metadata={"srid": srid, **more}))


def srid_of(df: DataFrame, geom: str) -> int | None:
    return df.schema[geom].metadata.get("srid")


def crs_differs(df: DataFrame, geom: str, target: int) -> bool:
    """Schema metadata only: no data is read."""
    return srid_of(df, geom) != target


# Bytes of geometry cells that are taken apart at a time.
BYTES_AT_ONCE = 16 << 20


# WKB walking --------------------------------------------------------------

def blocks(buf, pos: int = 0, parts: list[int] | None = None, body: int = 0) -> Iterator[tuple]:
    """Coordinate blocks of one WKB value: (body, part, kind, ring, view, has_z).

    ``part`` numbers the points, lines and polygons of the value; ``body`` the members of a
    collection, between which no rule of validity holds. The view is an (n, dimensions)
    array over the buffer itself. The generator returns the position behind the value.
    """
    parts = [0] if parts is None else parts
    order = "<" if buf[pos] else ">"
    code, = struct.unpack_from(order + "I", buf, pos + 1)
    iso, kind = divmod(code & wkb.TYPE_BITS, 1000)
    z = bool(code & wkb.FLAG_Z) or iso in (1, 3)
    dims = 2 + z + (bool(code & wkb.FLAG_M) or iso in (2, 3))
    pos += 9 if code & wkb.FLAG_SRID else 5
    count = 1
    if kind != wkb.POINT:
        count, = struct.unpack_from(order + "I", buf, pos)
        pos += 4
    if kind > wkb.POLYGON:
        for i in range(count):
            pos = yield from blocks(buf, pos, parts, i if kind == wkb.COLLECTION else body)
        return pos
    part = parts[0]
    parts[0] += 1
    for ring in range(count if kind == wkb.POLYGON else 1):
        n = count
        if kind == wkb.POLYGON:
            n, = struct.unpack_from(order + "I", buf, pos)
            pos += 4
        yield body, part, kind, ring, np.frombuffer(buf, order + "f8", n * dims, pos).reshape(n, dims), z
        pos += 8 * dims * n
    return pos


def rewrite(buf: bytes, edit: Callable[[int, np.ndarray], np.ndarray | None], pos: int = 0) -> tuple[bytes, int]:
    """The same geometry with every coordinate block passed through ``edit``.

    ``edit`` may return fewer or more points, or None to drop a ring.
    """
    order = "<" if buf[pos] else ">"
    code, = struct.unpack_from(order + "I", buf, pos + 1)
    iso, kind = divmod(code & wkb.TYPE_BITS, 1000)
    dims = 2 + (bool(code & wkb.FLAG_Z) or iso in (1, 3)) + (bool(code & wkb.FLAG_M) or iso in (2, 3))
    body = pos + (9 if code & wkb.FLAG_SRID else 5)
    head = bytes(buf[pos:body])
    if kind == wkb.POINT:
        return head + bytes(buf[body:body + 8 * dims]), body + 8 * dims
    count, = struct.unpack_from(order + "I", buf, body)
    at, out = body + 4, []
    if kind in (wkb.LINESTRING, wkb.POLYGON):
        for _ in range(count if kind == wkb.POLYGON else 1):
            n = count
            if kind == wkb.POLYGON:
                n, = struct.unpack_from(order + "I", buf, at)
                at += 4
            edited = edit(kind, np.frombuffer(buf, order + "f8", n * dims, at).reshape(n, dims))
            at += 8 * dims * n
            if edited is not None:
                out.append(struct.pack(order + "I", len(edited)) + edited.astype(order + "f8").tobytes())
        if kind == wkb.LINESTRING:
            return head + out[0], at
    else:
        for _ in range(count):
            member, at = rewrite(buf, edit, at)
            out.append(member)
    return head + struct.pack(order + "I", len(out)) + b"".join(out), at


# vertices and segments ----------------------------------------------------

@dataclass
class Group:
    """Coordinate blocks of some whole geometries: one entry per block."""

    row: np.ndarray
    body: np.ndarray
    part: np.ndarray
    kind: np.ndarray
    ring: np.ndarray
    has_z: np.ndarray
    views: list[np.ndarray]
    n: np.ndarray
    xy: np.ndarray

    @classmethod
    def of(cls, row: list[int], body: list[int], part: list[int], kind: list[int], ring: list[int], has_z: list[bool],
           views: list[np.ndarray]) -> Group:
        flat = np.concatenate([v[:, :2] for v in views]) if views else np.empty((0, 2))
        return cls(*[np.array(c, np.int32) for c in (row, body, part, kind, ring)], np.array(has_z, bool), views,
                   np.array([len(v) for v in views], np.int64), flat.astype(np.float64, copy=False))

    def only(self, keep: Callable[[np.ndarray, np.ndarray], np.ndarray]) -> Group:
        """The blocks whose (kind, number of points) pass."""
        there = keep(self.kind, self.n)
        if there.all():
            return self
        views = [self.views[i] for i in np.flatnonzero(there).tolist()]
        return Group(*[c[there] for c in (self.row, self.body, self.part, self.kind, self.ring, self.has_z)], views,
                     self.n[there], self.xy[np.repeat(there, self.n)])

    def each(self, values: np.ndarray) -> np.ndarray:
        """A value of the blocks, repeated for their points."""
        return np.repeat(values, self.n)

    def seq(self) -> np.ndarray:
        n = self.n
        return (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)).astype(np.int32)


def _slices(cells: pa.Array, limit: int = BYTES_AT_ONCE) -> Iterator[tuple[int, pa.Array]]:
    """(first cell, cells) of consecutive slices of a batch, bounded in bytes; a larger cell stands alone."""
    total = np.cumsum(pc.fill_null(pc.binary_length(cells), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(cells):
        before = total[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + limit, side="right")))
        yield start, cells.slice(start, stop - start)
        start = stop


def _bytes(cells: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A writable copy of the bytes of all cells, and where each begins and the last one ends."""
    cells = cells.cast(pa.binary())
    _, ends, data = cells.buffers()
    at = np.frombuffer(ends, np.int32)[cells.offset:cells.offset + len(cells) + 1].astype(np.int64)
    held = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return held[at[0]:at[-1]].copy(), at - at[0]


def same_layouts(data: np.ndarray, at: np.ndarray, cells: np.ndarray, least: int = 8) -> tuple[list[tuple], np.ndarray]:
    """Cells of a single coordinate block that agree in length and in all bytes before it (points above all), read at once.

    (first byte of each block, (points, dimensions) array of a copy of all blocks) of each layout found, and the other
    cells. Lengths that fewer than ``least`` cells have are not looked at.
    """
    size, found, rest = np.diff(at)[cells], [], [np.zeros(0, np.int64)]
    order = np.argsort(size, kind="stable")
    todo = np.split(cells[order], np.flatnonzero(np.diff(size[order])) + 1)
    while todo:
        alike = todo.pop()
        own = list(blocks(memoryview(data), int(at[alike[0]]))) if len(alike) >= least else []
        view = own[0][4] if len(own) == 1 and own[0][4].size else None
        head = 0 if view is None else view.ctypes.data - data.ctypes.data - int(at[alike[0]])
        if view is None or head + view.nbytes != at[alike[0] + 1] - at[alike[0]]:  # something follows the block
            rest.append(alike)
            continue
        heads = np.lib.stride_tricks.sliding_window_view(data, head)[at[alike]]
        same = (heads == heads[0]).all(1)
        start = at[alike[same]] + head
        block = np.lib.stride_tricks.sliding_window_view(data, view.nbytes)[start]
        found.append((start, block.view(view.dtype).reshape(-1, view.shape[1])))
        # others of that length are looked at again, unless layouts are so many that each has a few cells only
        (todo if same.sum() >= least else rest).append(alike[~same])
    return found, np.concatenate(rest)


def _groups(cells: pa.Array) -> Iterator[Group]:
    """Blocks of a batch of WKB cells, handed on whenever enough points are together."""
    columns: tuple[list, ...] = ([], [], [], [], [], [], [])
    rows, bodies, parts, kinds, rings, with_z, views = columns
    points = 0
    for i, cell in ((first + k, cell) for first, part in _slices(cells) for k, cell in enumerate(part.to_pylist())):
        if cell is None:
            continue
        for body, part, kind, ring, view, has_z in blocks(cell):
            rows.append(i)
            bodies.append(body)
            parts.append(part)
            kinds.append(kind)
            rings.append(ring)
            with_z.append(has_z)
            views.append(view)
            points += len(view)
        if points >= ROWS_PER_BATCH:
            yield Group.of(*map(list, columns))
            points = 0
            for c in columns:
                c.clear()
    if rows:
        yield Group.of(*columns)


def _spread(df: DataFrame, fid: str, geom: str, fields: str, expand) -> DataFrame:
    """Spread geometry cells into rows.

    ``expand`` turns a group of blocks into (number of the cell per row, columns). The
    work is vectorised over all geometries of a group, and output batches are bounded.
    """
    key = df.schema[fid]
    # only z and m can be missing; the rest free of NULL checks in generated code
    schema = T.StructType([T.StructField(fid, key.dataType, key.nullable)] + [
        T.StructField(f.name, f.dataType, f.name in ("z", "m")) for f in T._parse_datatype_string(fields).fields
    ])
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group in _groups(batch.column(1)):
                row, columns = expand(group)
                if not len(row):
                    continue
                arrays = [pa.array(c, from_pandas=n in ("z", "m")) for n, c in zip(names[1:], columns)]
                out = pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(row)), *arrays], names)
                for at in range(0, len(row), ROWS_PER_BATCH):
                    yield out.slice(at, ROWS_PER_BATCH)

    return df.select(fid, geom).mapInArrow(run, schema)


NOTHING = np.empty(0, np.int32), []


def _vertex_rows(group: Group) -> tuple[np.ndarray, list[np.ndarray]]:
    g = group.only(lambda kind, n: n > 0)
    if not len(g.row):
        return NOTHING
    x, y = g.xy.T
    z, m = (np.full(len(x), np.nan) for _ in "zm")
    if any(v.shape[1] > 2 for v in g.views):
        z = np.concatenate([v[:, 2] if has else np.full(len(v), np.nan) for v, has in zip(g.views, g.has_z)])
        m = np.concatenate([v[:, -1] if v.shape[1] > 2 + has else np.full(len(v), np.nan)
                            for v, has in zip(g.views, g.has_z)])
    kind = g.each(g.kind)
    # an empty point is a point of two missing coordinates
    there = (kind != wkb.POINT) | ~(np.isnan(x) & np.isnan(y))
    columns = [g.each(g.part), kind, g.each(g.ring), g.seq(), x, y, z, m]
    return g.each(g.row)[there], [c[there] for c in columns]


def vertices(df: DataFrame, fid: str = "fid", geom: str = "geometry") -> DataFrame:
    """One row per vertex; empty and NULL geometries have none."""
    return _spread(df, fid, geom, VERTEX_FIELDS, _vertex_rows)


def _segment_rows(group: Group) -> tuple[np.ndarray, list[np.ndarray]]:
    g = group.only(lambda kind, n: n > 0)
    if not len(g.row):
        return NOTHING
    (x, y), n = g.xy.T, g.n
    last = np.cumsum(n) - 1
    after = np.arange(1, len(x) + 1)
    # the last vertex starts no segment: it is kept as a row that only closes
    after[last] = last - n + 1
    closes = np.zeros(len(x), bool)
    closes[last] = True
    kind = g.each(g.kind)
    there = (kind != wkb.POINT) | ~(np.isnan(x) & np.isnan(y))
    columns = [g.each(g.part), kind, g.each(g.ring), g.seq(), closes, x, y, x[after], y[after]]
    return g.each(g.row)[there], [c[there] for c in columns]


def segments(df: DataFrame, fid: str = "fid", geom: str = "geometry") -> DataFrame:
    """One row per vertex with the next vertex beside it.

    ``closes`` marks the last vertex of a ring or line, whose next is the first one:
    a ring is closed when both are equal.
    """
    return _spread(df, fid, geom, SEGMENT_FIELDS, _segment_rows)


# header profile -----------------------------------------------------------

def geometry_types(df: DataFrame, geom: str) -> Column:
    """Aggregate: sorted comma list of type names (at most one per known type)."""
    return F.array_join(F.array_sort(F.collect_set(wkb.type_name(F.col(geom)))), ",")


def geometry_profile(df: DataFrame, geom: str = "geometry", srid: int | str | None = None) -> DataFrame:
    """Type, dimension and SRID of a geometry column, found from its data in one pass.

    ``srid`` is a constant, or the name of a column (different values in one table
    are an error). No row for an empty table.
    """
    g = F.col(geom)
    base = wkb.type_name(g)
    if isinstance(srid, str):
        low, high = F.min(srid), F.max(srid)
        code = F.when(low.eqNullSafe(high), low).otherwise(F.raise_error(F.lit("more than one SRID")).cast("bigint"))
    else:
        code = F.lit(srid if srid is not None else srid_of(df, geom)).cast("bigint")
    single = wkb_base_name(base)
    seen = df.agg(
        F.count(F.lit(1)).alias("num_rows"),
        F.min(single).alias("_low"), F.max(single).alias("_high"),
        F.count_if(g.isNull()).alias("_nulls"),
        F.max(wkb.num_parts(g)).alias("_parts"),
        quality.any_true(wkb.has_z(g)).alias("is_3d"),
        quality.any_true(wkb.has_m(g)).alias("is_measured"),
        code.cast("bigint").alias("srid") if isinstance(srid, str) else F.first(code).alias("srid"),
    ).where("num_rows > 0")
    # a NULL geometry counts as one more type
    one = F.when((F.col("_low") == F.col("_high")) & (F.col("_nulls") == 0), F.col("_low")).otherwise(
        "GEOMETRYCOLLECTION")
    multi = (one != "GEOMETRYCOLLECTION") & (F.col("_parts") > 1)
    return seen.select(
        "num_rows", "srid",
        F.concat(
            F.when(multi, "MULTI").otherwise(""), one,
            F.when(F.col("is_3d"), "Z").otherwise(""), F.when(F.col("is_measured"), "M").otherwise(""),
        ).alias("geometry_type"),
        (F.lit(2) + F.col("is_3d").cast("int") + F.col("is_measured").cast("int")).alias("dimension"),
    )


def wkb_base_name(name: Column) -> Column:
    """Type name without its multi prefix."""
    return F.replace(name, F.lit("MULTI"), F.lit(""))


def promote_to_multi(df: DataFrame, geom: str, geometry_type: str) -> DataFrame:
    """Wrap single parts when the column as a whole is a multi type."""
    if "MULTI" not in geometry_type.upper():
        return df
    field = df.schema[geom]
    return df.withColumn(geom, wkb.to_multi(F.col(geom)).alias(geom, metadata=field.metadata))


# in-place rewriting -------------------------------------------------------

def _rewritten(df: DataFrame, geom: str, change: Callable[[pa.Array], pa.Array]) -> DataFrame:
    """Replace the geometry cells slice by slice of each batch; the other columns stay in the JVM."""
    @F.arrow_udf("binary")
    def run(cells: pa.Array) -> pa.Array:
        done = [change(part) for _, part in _slices(cells)]
        return pa.concat_arrays(done) if done else pa.array([], pa.binary())

    field = df.schema[geom]
    return df.withColumn(geom, run(F.col(geom)).alias(geom, metadata=field.metadata))


def reproject(df: DataFrame, geom: str, dst: int, src: int | None = None) -> DataFrame:
    """Transform all coordinates to ``dst``; an unknown system is an error.

    The coordinates of a slice are transformed in one vectorised call and written over one copy of its bytes.
    """
    src = srid_of(df, geom) if src is None else src
    chain = crs.steps(src, dst)
    if not chain:
        return with_srid(df, geom, dst)

    def change(cells: pa.Array) -> pa.Array:
        data, at = _bytes(cells)
        layouts, rest = same_layouts(data, at, np.flatnonzero(cells.is_valid().to_numpy(zero_copy_only=False)))
        views = [block for _, block in layouts] + [b[4] for i in rest.tolist() for b in blocks(memoryview(data), int(at[i]))]
        if views:
            x = np.concatenate([v[:, 0] for v in views]).astype(np.float64)
            y = np.concatenate([v[:, 1] for v in views]).astype(np.float64)
            x, y = crs.transform_arrays(x, y, chain)
            ends = np.cumsum([len(v) for v in views])
            for v, k in zip(views, ends.tolist(), strict=True):
                v[:, 0], v[:, 1] = x[k - len(v):k], y[k - len(v):k]
            for start, block in layouts:
                raw = block.view(np.uint8).reshape(len(start), -1)
                np.lib.stride_tricks.sliding_window_view(data, raw.shape[1], writeable=True)[start] = raw
        done = pa.Array.from_buffers(pa.binary(), len(cells), [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(data)])
        return pc.if_else(cells.is_valid(), done, pa.scalar(None, pa.binary())) if cells.null_count else done

    return with_srid(_rewritten(df, geom, change), geom, dst)


def reproject_points(df: DataFrame, x: str, y: str, src: int, dst: int) -> DataFrame:
    """Transform two number columns; stays in the JVM."""
    return crs.transform_columns(df, x, y, crs.steps(src, dst))


def _repair_block(kind: int, points: np.ndarray) -> np.ndarray | None:
    if len(points) > 1:
        moved = np.r_[True, (points[1:, :2] != points[:-1, :2]).any(axis=1)]
        if kind != wkb.LINESTRING or moved.sum() > 1:
            points = points[moved]
    if kind == wkb.POLYGON:
        if len(points) and (points[0, :2] != points[-1, :2]).any():
            points = np.vstack([points, points[:1]])
        if len(points) < 4:
            return None
    return points


def _unrepaired(cells: pa.Array) -> np.ndarray:
    """Which cells have a repeated point or a ring that is open or short, so that ``_repair_block`` has work to do."""
    found = np.zeros(len(cells), bool)
    for group in _groups(cells):
        g = group.only(lambda kind, n: kind != wkb.POINT)
        area = g.kind == wkb.POLYGON
        found[g.row[area & (g.n < 4)]] = True
        g = g.only(lambda kind, n: n > 0)
        if not len(g.row):
            continue
        last = np.cumsum(g.n) - 1
        first = last - g.n + 1
        repeated = np.r_[False, (g.xy[1:] == g.xy[:-1]).all(axis=1)]
        repeated[first] = False
        open_ = (g.kind == wkb.POLYGON) & (g.xy[first] != g.xy[last]).any(axis=1)
        found[g.row[np.logical_or.reduceat(repeated, first) | open_]] = True
    return found


def repair_simple(df: DataFrame, geom: str = "geometry") -> DataFrame:
    """Drop repeated points, close rings, drop rings of fewer than four points.

    Anything else is left as it is, for ``validity`` to flag again.
    """
    def change(cells: pa.Array) -> pa.Array:
        cells = cells.cast(pa.binary())
        work = pa.array(_unrepaired(cells))
        done = [rewrite(c, _repair_block)[0] for c in cells.filter(work).to_pylist()]
        return pc.replace_with_mask(cells, work, pa.array(done, pa.binary()))

    return _rewritten(df, geom, change)


# validity -----------------------------------------------------------------

# Reason texts, in order of precedence.
REASONS = ("Invalid Coordinate", "Ring not closed", "Too few points in geometry component",
           "Self-intersection", "Unchecked: rings touch", "Hole lies outside shell", "Holes are nested",
           "Nested shells", "Interior is disconnected")
VALID_TEXT = "Valid Geometry"
BAD_COORDINATE, NOT_CLOSED, TOO_FEW, CROSSING, UNCHECKED, HOLE_OUTSIDE, NESTED_HOLES, NESTED_SHELLS, DISCONNECTED = range(9)

# Squares with more segments are divided again, DIVISION times per axis and level.
CROWDED, DIVISION, LEVELS = 32, 4, 8
FINEST = 1e-15
# Boxes of a strip grow by this factor from level to level.
BOX_GROWTH, BOX_LEVELS = 8, 8
# Cells of at most so many bytes are judged whole in their task; larger ones are spread over tasks.
JUDGED_WHOLE = 256 << 10
# Their codes before any fault is found, and with nothing but an open question.
FAULTLESS, OPEN = 99, 98
# Sides or points that are compared at a time.
PAIRS_AT_ONCE = 1 << 20
# Where on its first segment a ring is sampled: no vertex, and no fraction that other rings are likely to touch at.
SAMPLE_AT = 0.41421356237309503


def _expand(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, value) for every whole number from first to last of each row."""
    n = np.maximum(last - first + 1, 0)
    row = np.repeat(np.arange(len(n)), n)
    return row, first[row] + (np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n))


def _squares(s: np.ndarray, side: np.ndarray, inside: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """(row, cx, cy): the squares each segment of ``s`` (x1, y1, x2, y2) passes through.

    Column by column, only the squares between the segment's entry and exit are taken,
    so a long diagonal costs its length and not its bounding box. ``inside`` restricts
    each row to one coarser square; the margin of one keeps rounding harmless.
    """
    x1, y1, x2, y2 = s.T
    left, right, low, high = np.minimum(x1, x2), np.maximum(x1, x2), np.minimum(y1, y2), np.maximum(y1, y2)

    def span(a, b, axis, row):
        first = np.floor(a / side[row]).astype(np.int64)
        last = np.floor(b / side[row]).astype(np.int64)
        if inside is not None:
            start = inside[row, axis] * DIVISION
            first, last = np.maximum(first, start - 1), np.minimum(last, start + DIVISION)
        return _expand(first, last)

    row, cx = span(left, right, 0, np.arange(len(s)))
    with np.errstate(all="ignore"):
        slope = np.where(x1 == x2, 0.0, (y2 - y1) / (x2 - x1))[row]
        enter = y1[row] + slope * (np.maximum(left[row], cx * side[row]) - x1[row])
        leave = y1[row] + slope * (np.minimum(right[row], (cx + 1) * side[row]) - x1[row])
        # rounding of entry and exit
        slack = side[row] * 1e-6 + np.abs(s[row]).max(axis=1) * (1 + np.abs(slope)) * 1e-15
        unsure = (x1 == x2)[row] | ~np.isfinite(enter) | ~np.isfinite(leave) | ~np.isfinite(slack)
        first = np.where(unsure, low[row], np.maximum(np.minimum(enter, leave) - slack, low[row]))
        last = np.where(unsure, high[row], np.minimum(np.maximum(enter, leave) + slack, high[row]))
    at, cy = span(np.minimum(first, last), np.maximum(first, last), 1, row)
    return row[at], cx[at], cy


def _numbered(*keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of each row's keys in their order, the last key first; first row of each number)."""
    order = np.lexsort(keys)
    starts = np.ones(len(order), bool)
    starts[1:] = np.any([k[order][1:] != k[order][:-1] for k in keys], axis=0)
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(starts) - 1
    return number, order[starts]


def _company(*keys: np.ndarray) -> np.ndarray:
    """How many rows share the keys of each row."""
    number, _ = _numbered(*keys)
    return np.bincount(number)[number]


def _pairs(a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of a, rows of b) that have the same number, so many at a time."""
    order = np.argsort(b, kind="stable")
    first, last = (np.searchsorted(b[order], a, side) for side in ("left", "right"))
    ends, start = np.cumsum(last - first), 0
    while start < len(a):
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + PAIRS_AT_ONCE, side="right")))
        row, at = _expand(first[start:stop], last[start:stop] - 1)
        yield start + row, order[at]
        start = stop


def _sides(group: Group) -> tuple | None:
    """The ring segments of a group that have a length.

    (owner, [body, part, ring, seq, rings of the owner], coordinates, square side, finest side)
    """
    g = group.only(lambda kind, n: (kind == wkb.POLYGON) & (n > 0))
    owner, columns = _segment_rows(g)
    if not len(owner):
        return None
    part, _, ring, seq, closes = columns[:5]
    s = np.column_stack(columns[5:])
    keep = ~closes & np.isfinite(s).all(axis=1) & (s[:, :2] != s[:, 2:]).any(axis=1)
    if not keep.any():
        return None
    rings = np.bincount(g.row).astype(np.int32)[owner]
    keys = [k[keep] for k in (g.each(g.body), part, ring, seq, rings)]
    owner, s = owner[keep], s[keep]
    _, starts, of = np.unique(owner, return_index=True, return_inverse=True)
    with np.errstate(over="ignore"):
        mean = np.add.reduceat(np.hypot(s[:, 2] - s[:, 0], s[:, 3] - s[:, 1]), starts) / np.bincount(of)
    finest = np.maximum.reduceat(np.abs(s).max(axis=1), starts) * FINEST
    side = np.clip(mean, np.maximum(finest, np.finfo(np.float64).tiny), np.finfo(np.float64).max)
    return owner, keys, s, side[of], finest[of]


def _placed_rows(group: Group) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ring segments of a group with the squares they pass through.

    A feature's first side is its mean segment length, so all its segments together
    enter at most a small multiple of their own number of squares. A crowded square is
    divided when that leaves at most half of the comparisons.
    """
    found = _sides(group)
    return NOTHING if found is None else _place(*found)


def _place(owner, keys, s, side, finest) -> tuple[np.ndarray, list[np.ndarray]]:
    out = []
    row, cx, cy = _squares(s, side)
    for level in range(LEVELS + 1):
        n = _company(cy, cx, owner[row])
        divide = (n > CROWDED) & (side[row] / DIVISION > finest[row]) & (level < LEVELS)
        if divide.any():
            at = np.flatnonzero(divide)
            seg = row[at]
            sub, fx, fy = _squares(s[seg], side[seg] / DIVISION, np.column_stack([cx[at], cy[at]]))
            # comparisons after dividing, per coarse square, against before
            parent = at[sub]
            after = _company(fy, fx, cy[parent], cx[parent], owner[row[parent]])
            order = np.lexsort((cy[at], cx[at], owner[seg]))
            first = np.ones(len(at), bool)
            first[1:] = np.any([k[order][1:] != k[order][:-1] for k in (cy[at], cx[at], owner[seg])], axis=0)
            number = np.empty(len(at), np.int64)
            number[order] = np.cumsum(first) - 1
            cost = np.bincount(number[sub], weights=after, minlength=number.max() + 1)
            worth = cost[number] <= n[at].astype(np.float64) ** 2 / 2
            divide[at] = worth
            chosen = worth[sub]
            finer = np.unique(np.column_stack([row[parent[chosen]], fx[chosen], fy[chosen]]), axis=0)
        keep = ~divide
        out.append((row[keep], np.full(keep.sum(), level, np.int32), cx[keep], cy[keep]))
        if not divide.any():
            break
        row, cx, cy = finer.T
        side = side / DIVISION
    row, level, cx, cy = (np.concatenate(c) for c in zip(*out))
    return owner[row], [*(k[row] for k in keys), *s[row].T, level, cx, cy]


def _column_rows(group: Group) -> tuple[np.ndarray, list[np.ndarray]]:
    """Segments of geometries with several rings, per vertical strip, and one sample point of each ring.

    Strips are cut into boxes: a segment stands in those that its ring's height spans, on the level whose boxes are at
    least as high as the ring, so in two at most; a sample stands in its box of every level.
    """
    found = _sides(group)
    return NOTHING if found is None else _columns(*found)


def _columns(owner, keys, s, side, _) -> tuple[np.ndarray, list[np.ndarray]]:
    body, part, ring, _, rings = keys
    several = rings > 1
    left, right = np.minimum(s[:, 0], s[:, 2]), np.maximum(s[:, 0], s[:, 2])
    first, last = (np.floor(v / side).astype(np.int64) for v in (left, right))
    # rows of a ring are consecutive: its first row is its sample
    starts = np.ones(len(owner), bool)
    starts[1:] = np.any([k[1:] != k[:-1] for k in (owner, part, ring)], axis=0)
    of = np.cumsum(starts) - 1
    low = np.minimum.reduceat(s[:, [1, 3]].min(axis=1), np.flatnonzero(starts))
    high = np.maximum.reduceat(s[:, [1, 3]].max(axis=1), np.flatnonzero(starts))
    with np.errstate(divide="ignore", over="ignore"):
        level = np.ceil(np.log((high - low) / side[starts]) / np.log(BOX_GROWTH))
    level = np.clip(np.nan_to_num(level, nan=0.0, posinf=BOX_LEVELS, neginf=0.0), 0, BOX_LEVELS).astype(np.int32)
    box = side[starts] * float(BOX_GROWTH) ** level
    at = np.flatnonzero(several)
    row, cx = _expand(first[at], last[at])
    row = at[row]
    number = of[row]
    again, cy = _expand(np.floor(low[number] / box[number]).astype(np.int64), np.floor(high[number] / box[number]).astype(np.int64))
    row, cx, wall_level = row[again], cx[again], level[number[again]]
    sample = np.repeat(np.flatnonzero(starts & several), BOX_LEVELS + 1)
    levels = np.tile(np.arange(BOX_LEVELS + 1, dtype=np.int32), len(sample) // (BOX_LEVELS + 1))
    n_walls = len(row)
    row = np.concatenate([row, sample])
    at = s[sample, :2] * (1 - SAMPLE_AT) + s[sample, 2:] * SAMPLE_AT
    cx = np.concatenate([cx, np.floor(at[:, 0] / side[sample]).astype(np.int64)])
    cy = np.concatenate([cy, np.floor(at[:, 1] / (side[sample] * float(BOX_GROWTH) ** levels)).astype(np.int64)])
    is_sample = np.arange(len(row)) >= n_walls
    ends = s[row]
    ends[n_walls:, :2] = at
    return owner[row], [body[row], part[row], ring[row], is_sample, *ends.T, cx, np.concatenate([wall_level, levels]), cy]


def placed_segments(df: DataFrame, fid: str = "fid", geom: str = "geometry") -> DataFrame:
    """Ring segments, one row per search square (level, cx, cy)."""
    return _spread(df, fid, geom, PLACED_FIELDS, _placed_rows)


def _side_of(px: Column, py: Column, s: str) -> Column:
    """Sign of the point against the line through segment ``s``."""
    x1, y1, x2, y2 = (F.col(f"{s}.{n}") for n in ("x1", "y1", "x2", "y2"))
    return F.signum((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1))


def _meeting(touch: bool) -> Column:
    """Do segments ``a`` and ``b`` meet?

    With ``touch`` false: in a way a valid polygon forbids. Any pair: a proper crossing, or a
    shared stretch. Same ring: also any contact other than the joint of neighbours, and the
    same start vertex twice. With ``touch`` true: at all, being of different rings.
    """
    a = {n: F.col(f"a.{n}") for n in ("x1", "y1", "x2", "y2")}
    b = {n: F.col(f"b.{n}") for n in ("x1", "y1", "x2", "y2")}
    b1, b2 = _side_of(b["x1"], b["y1"], "a"), _side_of(b["x2"], b["y2"], "a")
    a1, a2 = _side_of(a["x1"], a["y1"], "b"), _side_of(a["x2"], a["y2"], "b")
    apart, overlap = F.lit(False), F.lit(False)
    for p, q in (("x1", "x2"), ("y1", "y2")):
        first = F.greatest(F.least(a[p], a[q]), F.least(b[p], b[q]))
        last = F.least(F.greatest(a[p], a[q]), F.greatest(b[p], b[q]))
        apart, overlap = apart | (first > last), overlap | (first < last)

    def joint(p: str, q: str) -> Column:
        return (a[f"x{p}"] == b[f"x{q}"]) & (a[f"y{p}"] == b[f"y{q}"])

    same_ring = (F.col("a.part") == F.col("b.part")) & (F.col("a.ring") == F.col("b.ring"))
    across, along = b1 * b2, a1 * a2
    # cases and no conjunction: evaluated in this order, cheapest first, and short
    # enough for the join to stay in compiled code
    if touch:
        return F.when(same_ring | apart, False).when(across > 0, False).otherwise(along <= 0)
    neighbours = joint("1", "2") | joint("2", "1")
    contact = same_ring & (joint("1", "1") | joint("2", "2") | ~neighbours)
    return (
        F.when(same_ring & (F.col("a.seq") == F.col("b.seq")), False)
        .when(apart, False)
        .when(across > 0, False)
        .when(along > 0, False)
        .when(contact, True)
        .when(across < 0, along < 0)
        .otherwise((b1 == 0) & (b2 == 0) & overlap)
    )


def _meeting_rows(placed: DataFrame, fid: str, touch: bool) -> DataFrame:
    # the planner cannot see how far cells expand into segments, so its size estimate
    # must not choose a broadcast here
    a, b = placed.alias("a"), placed.hint("merge").alias("b")
    on = _meeting(touch)
    for k in (fid, "body", "level", "cx", "cy"):
        on = on & (F.col(f"a.{k}") == F.col(f"b.{k}"))
    return a.join(b, on, "left_semi")


def crossings(df: DataFrame, fid: str = "fid", geom: str = "geometry") -> DataFrame:
    """Key of the feature, once per ring segment that crosses or overlaps another
    one, or touches another one of its own ring.

    Segments meet only when they pass through a common square, so the join key is
    (feature, square) and a ring of any size spreads over as many keys as it has
    squares. The semi-join stops at a segment's first conflict: pairs are never
    written out.
    """
    return _meeting_rows(placed_segments(df, fid, geom), fid, touch=False).select(fid)


def touching_rings(df: DataFrame, fid: str = "fid", geom: str = "geometry") -> DataFrame:
    """The placed segments that meet a segment of another ring."""
    return _meeting_rows(placed_segments(df, fid, geom).where("rings > 1"), fid, touch=True)


def _points_on_sides(s: np.ndarray, *square: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(side, point): the ends of sides that lie strictly within another side of the same square."""
    number, _ = _numbered(*square)
    ends, of = np.concatenate([s[:, :2], s[:, 2:]]), np.concatenate([number, number])
    _, first = _numbered(ends[:, 1], ends[:, 0], of)
    ends, of = ends[first], of[first]
    sides, points = [np.zeros(0, np.int64)], [np.zeros((0, 2))]
    for end, side in _pairs(of, number):
        (px, py), (x1, y1, x2, y2) = ends[end].T, s[side].T
        on = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1) == 0
        on &= (np.minimum(x1, x2) <= px) & (px <= np.maximum(x1, x2))
        on &= (np.minimum(y1, y2) <= py) & (py <= np.maximum(y1, y2))
        on &= ((px != x1) | (py != y1)) & ((px != x2) | (py != y2))
        sides.append(side[on])
        points.append(ends[end[on]])
    return np.concatenate(sides), np.concatenate(points)


def _closing(points: np.ndarray, rings: np.ndarray) -> list[int]:
    """The edges that close a cycle in the graph that joins contact points to the rings that pass there."""
    parent: dict[tuple[str, int], tuple[str, int]] = {}

    def root(node: tuple[str, int]) -> tuple[str, int]:
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = parent[up]
            node = up
        return node

    closing = []
    for i, (p, r) in enumerate(zip(points.tolist(), rings.tolist(), strict=True)):
        a, b = root(("point", p)), root(("ring", r))
        if a == b:
            closing.append(i)
        parent[a] = b
    return closing


def _cross_at(rings: list[int], angles: list[float]) -> bool | None:
    """Do rings cross at a point, given their directions there in order of angle? None: not to be told.

    Rings that only touch nest like brackets: read around the point, each one closes before what it opened in closes.
    """
    if any(a == b and r != q for a, b, r, q in zip(angles, angles[1:], rings, rings[1:])):
        return None
    open_rings: list[int] = []
    for r in rings:
        if open_rings and open_rings[-1] == r:
            open_rings.pop()
        else:
            open_rings.append(r)
    return bool(open_rings)


def _contact_codes(cell, part, ring, seq, x1, y1, x2, y2, level, cx, cy) -> tuple[np.ndarray, np.ndarray]:
    """(cell, fault code) of the contacts between the rings of each cell; at most one code a cell."""
    s = np.column_stack([x1, y1, x2, y2]) + 0.0  # no negative zeros
    side, point = _points_on_sides(s, cy, cx, level, cell)
    number, once = _numbered(seq, ring, part, cell)
    _, inner = _numbered(point[:, 1], point[:, 0], number[side])
    side, point = side[inner], point[inner]
    # a ring leaves a point in two directions: along the two sides that meet there, or both ways along one
    owner = np.concatenate([once, once, side, side])
    at = np.concatenate([s[once, :2], s[once, 2:], point, point])
    to = np.concatenate([s[once, 2:], s[once, :2], s[side, :2], s[side, 2:]]) - at
    angle = np.arctan2(to[:, 1], to[:, 0])
    place, _ = _numbered(at[:, 1], at[:, 0], cell[owner])
    number, first = _numbered(ring, part, cell)
    number = number[owner]

    of_pass, passes = _numbered(number, place)
    n, of_cell, of_part = np.bincount(of_pass), cell[owner[passes]], part[owner[passes]]
    at_place, ring_there = place[passes], number[passes]
    shared = np.bincount(at_place)[at_place] > 1
    code = {c: UNCHECKED for c in of_cell[shared & (n != 2)].tolist()}
    order = np.lexsort((angle, place))
    order = order[np.isin(place[order], at_place[shared])]
    cuts = np.flatnonzero(np.diff(place[order])) + 1
    rings, angles, cells = number[order].tolist(), angle[order].tolist(), cell[owner[order]].tolist()
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(order)]) if len(order) else ():
        if cells[a] in code and code[cells[a]] == CROSSING:
            continue
        crosses = _cross_at(rings[a:b], angles[a:b])
        if crosses and cells[a] not in code:
            code[cells[a]] = CROSSING
        elif crosses is None:
            code[cells[a]] = UNCHECKED
    # rings of one part that touch in a circle cut its interior in two
    meeting, _ = _numbered(of_part, at_place)
    joint = np.flatnonzero(np.bincount(meeting)[meeting] > 1)
    for c in of_cell[joint[_closing(meeting[joint], ring_there[joint])]].tolist():
        if code.get(c) != CROSSING:
            code[c] = DISCONNECTED
    return np.array(list(code), np.int64), np.array(list(code.values()), np.int64)


def contact_faults(touching: DataFrame, fid: str = "fid") -> DataFrame:
    """(feature, fault code) of rings that touch, from ``touching_rings``.

    Around each contact the directions of the rings, in order of angle, tell whether rings cross there. Where they only
    touch, rings and contact points form a graph, and a cycle among the rings of one part cuts its interior. The few sides
    that touch come together by geometry: never more than the squares of one cell. A contact whose directions cannot be
    told apart in double precision stays ``UNCHECKED``.
    """
    names = ["part", "ring", "seq", "x1", "y1", "x2", "y2", "level", "cx", "cy"]

    @F.pandas_udf("int")
    def code(cells: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
        for columns in cells:
            found = []
            for part, *row in zip(*columns, strict=True):
                _, code = _contact_codes(np.zeros(len(part), np.int64), part, *row)
                found.append(code[0] if len(code) else None)
            yield pd.Series(found, dtype="Int32")

    one = touching.groupBy(fid, "body").agg(F.collect_list(F.struct(*names)).alias("sides"))
    return one.select(fid, code(*[F.col(f"sides.{n}") for n in names]).alias("code")).where("code is not null")


def nesting_faults(df: DataFrame, fid: str = "fid", geom: str = "geometry") -> DataFrame:
    """(feature, fault code) of rings that lie wrongly inside or outside others.

    A ring lies inside another one when a ray up from its sample point crosses that ring an
    odd number of times; only segments in the sample's own strip can be crossed, and only those of a ring
    whose height spans the sample matter.
    """
    strips = _spread(df, fid, geom, COLUMN_FIELDS, _column_rows)
    samples = strips.where("sample").selectExpr(fid, "body", "part", "ring", "x1 as px", "y1 as py", "cx", "level", "cy")
    walls = strips.where("not sample").selectExpr(
        fid, "body", "cx", "level", "cy", "part as other", "ring as other_ring", "x1", "y1", "x2", "y2")
    x, y = F.col("px"), F.col("py")
    spans = (F.least("x1", "x2") <= x) & (x < F.greatest("x1", "x2"))
    at = F.col("y1") + (F.col("y2") - F.col("y1")) * ((x - F.col("x1")) / (F.col("x2") - F.col("x1")))
    foreign = (F.col("part") != F.col("other")) | (F.col("ring") != F.col("other_ring"))
    same = F.lit(True)
    for k in (fid, "body", "cx", "level", "cy"):
        same = same & (F.col(f"r.{k}") == F.col(f"w.{k}"))
    crossed = F.when(foreign & spans, at > y).otherwise(False)
    # a sample that meets nothing stays, with other NULL
    met = samples.alias("r").join(walls.hint("merge").alias("w"), same & crossed, "left")
    ring = [F.col(f"r.{fid}").alias(fid), "part", "ring"]
    # The holes of a part are counted together: inside one of them is odd, and holes inside
    # holes are a fault of their own that the middle one shows.
    inside = met.groupBy(*ring, "other").agg(
        (F.count_if(F.col("other_ring") == 0) % 2 == 1).alias("in_shell"),
        (F.count_if(F.col("other_ring") > 0) % 2 == 1).alias("in_hole"),
    )
    own = F.coalesce(F.col("other") == F.col("part"), F.lit(False))
    place = inside.groupBy(fid, "part", "ring").agg(
        F.max(own & F.col("in_shell")).alias("in_own_shell"),
        F.max(own & F.col("in_hole")).alias("in_own_hole"),
        F.max(~own & F.col("in_shell") & ~F.col("in_hole")).alias("in_other"),
    )
    hole = F.col("ring") > 0
    code = (
        F.when(hole & ~F.col("in_own_shell"), HOLE_OUTSIDE).when(hole & F.col("in_own_hole"), NESTED_HOLES)
        .when(~hole & F.col("in_other"), NESTED_SHELLS)
    )
    return place.select(fid, code.alias("code")).where("code is not null")


def block_faults(segs: DataFrame, fid: str = "fid") -> DataFrame:
    """(feature, fault code or NULL) per point, line and ring, in one pass.

    The rows of a block leave the tasks already combined to one.
    """
    bad = F.lit(False)
    for c in ("x1", "y1"):
        bad = bad | F.isnan(c) | (F.abs(c) == float("inf"))
    differs = (F.col("x1") != F.col("x2")) | (F.col("y1") != F.col("y2"))
    found = segs.groupBy(fid, "part", "kind", "ring").agg(
        F.max(bad).alias("bad"),
        F.max(F.col("closes") & differs).alias("open"),
        F.count_if(~F.col("closes") & differs).alias("sides"),
    )
    area = F.col("kind") == wkb.POLYGON
    code = (
        F.when(F.col("bad"), BAD_COORDINATE).when(area & F.col("open"), NOT_CLOSED)
        .when(area & (F.col("sides") < 3), TOO_FEW)
        .when((F.col("kind") == wkb.LINESTRING) & (F.col("sides") < 1), TOO_FEW)
    )
    return found.select(fid, code.alias("code")).where("code is not null")


def _block_codes(group: Group) -> tuple[np.ndarray, np.ndarray]:
    """(row, fault code) per faulty point, line and ring: ``block_faults`` of whole cells."""
    row, columns = _segment_rows(group)
    if not len(row):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    _, kind, _, _, closes, x1, y1, x2, y2 = columns
    starts = np.flatnonzero(np.r_[True, closes[:-1]])
    differs = (x1 != x2) | (y1 != y2)
    bad = np.logical_or.reduceat(~(np.isfinite(x1) & np.isfinite(y1)), starts)
    sides = np.add.reduceat((~closes & differs).astype(np.int64), starts)
    area, line = kind[starts] == wkb.POLYGON, kind[starts] == wkb.LINESTRING
    code = np.select([bad, area & differs[closes], (area & (sides < 3)) | (line & (sides < 1))],
                     [BAD_COORDINATE, NOT_CLOSED, TOO_FEW], -1)
    return row[starts][code >= 0], code[code >= 0]


def _meet(s: np.ndarray, ring: np.ndarray, seq: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``_meeting`` of pairs of sides: the i that meet their j in a forbidden way, and those that meet another ring at all."""
    low, high = np.minimum(s[:, :2], s[:, 2:]), np.maximum(s[:, :2], s[:, 2:])
    near = (np.maximum(low[i], low[j]) <= np.minimum(high[i], high[j])).all(axis=1)
    near &= (ring[i] != ring[j]) | (seq[i] != seq[j])
    i, j = i[near], j[near]

    def side_of(px, py, at):
        x1, y1, x2, y2 = s[at].T
        return np.sign((x2 - x1) * (py - y1) - (y2 - y1) * (px - x1))

    def joint(p, q):
        return (s[i, p:p + 2] == s[j, q:q + 2]).all(axis=1)

    with np.errstate(all="ignore"):
        b1, b2 = side_of(s[j, 0], s[j, 1], i), side_of(s[j, 2], s[j, 3], i)
        across, along = b1 * b2, side_of(s[i, 0], s[i, 1], j) * side_of(s[i, 2], s[i, 3], j)
    meet = (across <= 0) & (along <= 0)
    same = ring[i] == ring[j]
    contact = same & (joint(0, 0) | joint(2, 2) | ~(joint(0, 2) | joint(2, 0)))
    overlap = (np.maximum(low[i], low[j]) < np.minimum(high[i], high[j])).any(axis=1)
    forbidden = contact | np.where(across < 0, along < 0, (b1 == 0) & (b2 == 0) & overlap)
    return i[meet & forbidden], i[meet & ~same]


def _nesting_codes(owner, body, part, ring, is_sample, x1, y1, x2, y2, cx, level, cy) -> tuple[np.ndarray, np.ndarray]:
    """(owner, fault code) of rings that lie wrongly inside or outside others: ``nesting_faults`` of whole cells."""
    box, _ = _numbered(cx, cy, level, body, owner)
    sample, wall = np.flatnonzero(is_sample), np.flatnonzero(~is_sample)
    number, first = _numbered(ring[sample], part[sample], owner[sample])
    own, hole = part[sample][first], ring[sample][first] > 0
    # walls that a ray up from a ring's sample meets: ring, part of the wall, is it a hole's
    hits = [(np.zeros(0, np.int64),) * 3]
    for i, j in _pairs(box[sample], box[wall]):
        r, w = sample[i], wall[j]
        x, y = x1[r], y1[r]
        hit = (part[r] != part[w]) | (ring[r] != ring[w])
        hit &= (np.minimum(x1[w], x2[w]) <= x) & (x < np.maximum(x1[w], x2[w]))
        i, r, w, x, y = i[hit], r[hit], w[hit], x[hit], y[hit]
        with np.errstate(all="ignore"):
            met = ~(y1[w] + (y2[w] - y1[w]) * ((x - x1[w]) / (x2[w] - x1[w])) <= y)
        hits.append((number[i[met]], part[w[met]], ring[w[met]] > 0))
    at, other, of_hole = (np.concatenate(c) for c in zip(*hits))
    group, lead = _numbered(other, at)
    holes = np.bincount(group, of_hole, len(lead))
    in_hole, in_shell = holes % 2 == 1, (np.bincount(group, minlength=len(lead)) - holes) % 2 == 1
    at = at[lead]
    mine = other[lead] == own[at]

    def rings_of(which):
        return np.bincount(at[which], minlength=len(first)) > 0

    code = np.select([hole & ~rings_of(mine & in_shell), hole & rings_of(mine & in_hole), ~hole & rings_of(~mine & in_shell & ~in_hole)],
                     [HOLE_OUTSIDE, NESTED_HOLES, NESTED_SHELLS], -1)
    return owner[sample][first][code >= 0], code[code >= 0]


def _cell_codes(group: Group, areal: np.ndarray, worst: np.ndarray) -> None:
    """Lower ``worst`` (by row of the batch) to the fault code of the group's cells, judged by the rules of the joins.

    A cell that has a fault which outranks all that a step can find takes no part in it.
    """
    def lower(row, code):
        certain = code != UNCHECKED
        np.minimum.at(worst, row[certain], code[certain])
        at = row[~certain]
        worst[at[worst[at] == FAULTLESS]] = OPEN

    lower(*_block_codes(group.only(lambda kind, n: n > 0)))
    found = _sides(group)
    if found is None:
        return

    def left(owner, keys, s, side, finest, several=True):
        keep = areal[owner] & (worst[owner] > CROSSING)
        if several:
            keep &= keys[4] > 1
        return owner[keep], [k[keep] for k in keys], s[keep], side[keep], finest[keep]

    def in_squares(found, spread, few):
        """Sides with squares; those of a cell with few sides share a single one."""
        owner, keys, s, *sides = found
        many = np.bincount(owner)[owner] > CROWDED
        out = [few(owner[~many], [k[~many] for k in keys], s[~many])] if not many.all() else []
        if many.any():
            row, columns = spread(owner[many], [k[many] for k in keys], s[many], *(v[many] for v in sides))
            out.append((row, *columns))
        return [np.concatenate(c) for c in zip(*out)]

    def one_square(owner, keys, s):
        return owner, *keys, *s.T, *(np.zeros(len(owner), np.int64) for _ in range(3))

    found = left(*found, several=False)
    if not len(found[0]):
        return
    owner, body, part, ring, seq, _, *ends, level, cx, cy = in_squares(found, _place, one_square)
    square, _ = _numbered(cx, cy, level, body, owner)
    number, _ = _numbered(ring, part, owner)
    s, touching = np.column_stack(ends), np.zeros(len(owner), bool)
    for i, j in _pairs(square, square):
        forbidden, touch = _meet(s, number, seq, i, j)
        lower(owner[forbidden], np.full(len(forbidden), CROSSING))
        touching[touch] = True
    at = np.flatnonzero(touching & (worst[owner] > CROSSING))
    if len(at):
        cell, first = _numbered(body[at], owner[at])
        one, code = _contact_codes(cell, part[at], ring[at], seq[at], *(e[at] for e in ends), level[at], cx[at], cy[at])
        lower(owner[at][first][one], code)

    def one_box(owner, keys, s):
        body, part, ring = keys[:3]
        _, at = _numbered(ring, part, owner)  # the first side of each ring
        row, ends = np.concatenate([np.arange(len(owner)), at]), np.concatenate([s, s[at]])
        ends[len(owner):, :2] = s[at, :2] * (1 - SAMPLE_AT) + s[at, 2:] * SAMPLE_AT
        none = np.zeros(len(row), np.int64)
        return owner[row], body[row], part[row], ring[row], np.arange(len(row)) >= len(owner), *ends.T, none, none, none

    found = left(*found)
    if len(found[0]):
        lower(*_nesting_codes(*in_squares(found, _columns, one_box)))


def cell_faults(df: DataFrame, fid: str = "fid", geom: str = "geometry") -> DataFrame:
    """(feature, its decisive fault code or NULL, present) of cells judged whole, in one pass and without a shuffle."""
    key = df.schema[fid]
    schema = T.StructType([T.StructField(fid, key.dataType, key.nullable), T.StructField("code", T.IntegerType()),
                           T.StructField("present", T.BooleanType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells, worst = batch.column(1), np.full(batch.num_rows, FAULTLESS)
            areal = pc.fill_null(batch.column(2), False).to_numpy(zero_copy_only=False)
            for group in _groups(cells):
                _cell_codes(group, areal, worst)
            code = pa.array(np.where(worst == OPEN, UNCHECKED, worst).astype(np.int32), mask=worst == FAULTLESS)
            yield pa.RecordBatch.from_arrays([batch.column(0), code, cells.is_valid()], schema.fieldNames())

    return df.select(fid, geom, _is_areal(geom).alias("areal")).mapInArrow(run, schema)


def _is_areal(geom: str) -> Column:
    return wkb.base_type(F.col(geom)).isin(3, 6, wkb.COLLECTION)


def validity(df: DataFrame, fid: str = "fid", geom: str = "geometry") -> DataFrame:
    """(fid, valid, reason) for every feature.

    ``valid`` is NULL, with a reason that says so, only where rings touch in directions that double
    precision cannot tell apart and no other fault is found. A NULL geometry is not valid and has no reason.
    """
    # a cell that one task can judge needs no shuffle of its sides; the sides of the others meet by joins
    whole = F.coalesce(F.octet_length(geom) <= JUDGED_WHOLE, F.lit(True))
    judged = cell_faults(df.where(whole), fid, geom)
    df = df.where(~whole)
    areas = df.where(_is_areal(geom))
    # by header: a polygon of one ring has no nesting to look at
    several = areas.where((wkb.base_type(F.col(geom)) > wkb.POLYGON) | (wkb.element_count(F.col(geom)) > 1))
    rows = df.select(fid, F.lit(None).cast("int").alias("code"), F.col(geom).isNotNull().alias("present"))

    def coded(keys: DataFrame, code: int) -> DataFrame:
        return keys.select(fid, F.lit(code).alias("code"))

    found = reshape.concat_parts([
        judged, rows, block_faults(segments(df, fid, geom), fid), coded(crossings(areas, fid, geom), CROSSING),
        contact_faults(touching_rings(several, fid, geom), fid), nesting_faults(several, fid, geom),
    ])
    # one aggregation instead of joins: every feature brings a row of its own; a certain fault outranks an open question
    certain = F.min(F.when(F.col("code") != UNCHECKED, F.col("code")))
    worst = found.groupBy(fid).agg(F.coalesce(certain, F.min("code")).alias("code"), F.max("present").alias("present"))
    reasons = F.array(*[F.lit(r) for r in REASONS])
    return worst.select(
        fid,
        F.when(~F.col("present"), F.lit(False)).when(F.col("code") == UNCHECKED, None)
        .otherwise(F.col("code").isNull()).alias("valid"),
        F.when(F.col("present"), F.coalesce(F.get(reasons, F.col("code")), F.lit(VALID_TEXT))).alias("reason"),
    )
