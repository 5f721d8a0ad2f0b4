"""Crossing search against brute force on random rings."""

import struct

import numpy as np
import pyarrow as pa
import pytest

from strata.operators import geometry
from strata.session import ship


def polygon(*rings):
    out = struct.pack("<BII", 1, 3, len(rings))
    for ring in rings:
        out += struct.pack("<I", len(ring)) + np.asarray(ring, "<f8").tobytes()
    return out


def brute_force(ring):
    """Any forbidden contact between two sides, by comparing every pair."""
    s = [(a, b) for a, b in zip(ring[:-1], ring[1:]) if tuple(a) != tuple(b)]

    def turn(p, q, r):
        return np.sign((q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0]))

    def within(p, q, r):
        return min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])

    for i, (a, b) in enumerate(s):
        for j in range(i + 1, len(s)):
            c, d = s[j]
            next_to = j == i + 1 or (i == 0 and j == len(s) - 1)
            t1, t2, t3, t4 = turn(a, b, c), turn(a, b, d), turn(c, d, a), turn(c, d, b)
            if t1 * t2 < 0 and t3 * t4 < 0:
                return True
            touches = [p for t, p, e in ((t1, c, (a, b)), (t2, d, (a, b)), (t3, a, (c, d)), (t4, b, (c, d)))
                       if t == 0 and within(*e, p)]
            allowed = {tuple(b)} if j == i + 1 else {tuple(a)} if next_to else set()
            if any(tuple(p) not in allowed for p in touches):
                return True
    return False


def star(rng, n, wobble):
    """Simple by construction when wobble is 0: points around a centre by angle."""
    angle = np.sort(rng.uniform(0, 2 * np.pi, n)) + rng.normal(0, wobble, n)
    radius = rng.uniform(0.5, 1.0, n)
    pts = np.column_stack([radius * np.cos(angle), radius * np.sin(angle)]) * 100 + 500
    return np.vstack([pts, pts[:1]])


def uneven(rng, n):
    """A long box with one very detailed side: squares around the detail are crowded."""
    y = np.linspace(0, 1, n)
    jag = np.column_stack([rng.uniform(0, 0.01, n), y])
    pts = np.vstack([[[1e4, 0], [1e4, 1]], jag[::-1]])
    return np.vstack([pts, pts[:1]])


def cases():
    rng = np.random.default_rng(7)
    rings = [star(rng, int(n), w) for n in (5, 12, 40, 90) for w in (0.0, 0.02, 0.2) for _ in range(6)]
    rings += [uneven(rng, n) for n in (50, 300)]
    rings += [np.round(star(rng, 14, 0.3) / 10) for _ in range(30)]
    return rings


def test_crossings_match_brute_force(spark):
    ship(spark)
    rings = cases()
    df = spark.createDataFrame([(i, bytearray(polygon(r))) for i, r in enumerate(rings)], "fid long, geometry binary")
    found = {r.fid for r in geometry.crossings(df.repartition(4)).distinct().collect()}
    expected = {i for i, r in enumerate(rings) if brute_force(r)}
    assert 10 < len(expected) < len(rings)
    assert found == expected


@pytest.mark.parametrize("n", [20_000])
def test_large_ring_is_spread_over_many_small_squares(n):
    rng = np.random.default_rng(3)
    # one detailed side; and the hard case of n long needles lying next to each other
    for ring, bound in ((uneven(rng, n), 100 * n), (star(rng, n, 0.0), n * n / 10)):
        group = next(geometry._groups(pa.array([polygon(ring)])))
        owner, columns = geometry._placed_rows(group)
        level, cx, cy = columns[-3:]
        share = geometry._company(cy, cx, level)
        assert len(owner) < 8 * n
        assert share.sum() < bound


def test_overlapping_copies_of_one_segment(spark):
    """A ring that runs the same two sides thousands of times is one crowded square."""
    ship(spark)
    ring = [(0, 0), (1, 0), (1, 1)] * 3000 + [(0, 0)]
    df = spark.createDataFrame([(1, bytearray(polygon(ring)))], "fid long, geometry binary")
    assert geometry.crossings(df).distinct().count() == 1


def box(rng):
    (x1, x2), (y1, y2) = np.sort(rng.uniform(0, 10, 2)), np.sort(rng.uniform(0, 10, 2))
    return x1, y1, x2, y2


def outline(b, steps):
    """The box with extra points on its sides, so that rings spread over several strips."""
    x1, y1, x2, y2 = b
    t = np.linspace(0, 1, steps, endpoint=False)
    pts = np.concatenate([np.column_stack([x1 + (x2 - x1) * t, np.full(steps, y1)]),
                          np.column_stack([np.full(steps, x2), y1 + (y2 - y1) * t]),
                          np.column_stack([x2 - (x2 - x1) * t, np.full(steps, y2)]),
                          np.column_stack([np.full(steps, x1), y2 - (y2 - y1) * t])])
    return np.vstack([pts, pts[:1]])


def within(a, b):
    return b[0] < a[0] and b[1] < a[1] and a[2] < b[2] and a[3] < b[3]


def separate(a, b):
    return a[2] < b[0] or b[2] < a[0] or a[3] < b[1] or b[3] < a[1]


def expected_reason(parts):
    rings = [(p, r, b) for p, bs in enumerate(parts) for r, b in enumerate(bs)]
    for i, (_, _, a) in enumerate(rings):
        for _, _, b in rings[i + 1:]:
            if not (within(a, b) or within(b, a) or separate(a, b)):
                return "Self-intersection"
    if any(not within(h, bs[0]) for bs in parts for h in bs[1:]):
        return "Hole lies outside shell"
    if any(within(g, h) for bs in parts for g in bs[1:] for h in bs[1:] if g is not h):
        return "Holes are nested"
    for p, bs in enumerate(parts):
        for q, other in enumerate(parts):
            if p != q and within(bs[0], other[0]) and not any(within(bs[0], h) for h in other[1:]):
                return "Nested shells"
    return "Valid Geometry"


def test_nesting_matches_boxes(spark):
    ship(spark)
    rng = np.random.default_rng(11)
    cells, expected = [], []
    for i in range(900):
        boxes = sorted((box(rng) for _ in range(3)), key=lambda b: -(b[2] - b[0]) * (b[3] - b[1]))
        if i % 3 == 0:
            boxes = boxes[:2]
        parts = [boxes] if i % 2 else ([[boxes[0]], *[[b] for b in boxes[1:]]] if i % 4 else [boxes[:2], boxes[2:]])
        parts = [p for p in parts if p]
        members = [polygon(*[outline(b, 1 + i % 5) for b in p]) for p in parts]
        cells.append(members[0] if len(members) == 1 else struct.pack("<BII", 1, 6, len(members)) + b"".join(members))
        expected.append(expected_reason(parts))
    assert {"Self-intersection", "Hole lies outside shell", "Holes are nested", "Nested shells",
            "Valid Geometry"} <= set(expected)
    df = spark.createDataFrame([(i, bytearray(c)) for i, c in enumerate(cells)], "fid long, geometry binary")
    got = {r.fid: r.reason for r in geometry.validity(df.repartition(4)).collect()}
    assert got == dict(enumerate(expected))


def test_holes_in_a_column_meet_few_walls(spark):
    """The pairs of samples and walls grow with the holes and not with their square."""
    from pyspark.sql import functions as F

    from strata.operators.geometry import COLUMN_FIELDS, _column_rows, _spread

    def column(n):
        holes = [[(1, 3 * k + 1), (2, 3 * k + 1), (2, 3 * k + 2), (1, 3 * k + 2), (1, 3 * k + 1)] for k in range(n)]
        shell = [(0, 0), (3, 0), (3, 3 * n + 1), (0, 3 * n + 1), (0, 0)]
        return polygon(shell, *holes)

    def pairs(n):
        df = spark.createDataFrame([(1, bytearray(column(n)))], "fid long, geometry binary")
        strips = _spread(df, "fid", "geometry", COLUMN_FIELDS, _column_rows)
        keys = ["fid", "body", "cx", "level", "cy"]
        a = strips.where("sample").groupBy(*keys).agg(F.count("*").alias("a"))
        b = strips.where("not sample").groupBy(*keys).agg(F.count("*").alias("b"))
        return a.join(b, keys).agg(F.sum(F.col("a") * F.col("b"))).first()[0]

    assert pairs(4000) < 6 * pairs(1000)


def turn(p, q, r):
    return (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])


def on_side(p, q, r):
    return turn(p, q, r) == 0 and min(p[0], q[0]) <= r[0] <= max(p[0], q[0]) and min(p[1], q[1]) <= r[1] <= max(p[1], q[1])


def side_of_ring(ring, p):
    """1 strictly inside a convex anticlockwise ring, 0 on it, -1 outside."""
    turns = [turn(a, b, p) for a, b in zip(ring[:-1], ring[1:])]
    return -1 if min(turns) < 0 else 0 if min(turns) == 0 else 1


def valid_with_convex_holes(shell, holes):
    """Holes of a convex shell, all within it: interiors apart, and no circle of rings that touch."""
    rings = [shell, *holes]
    for i, a in enumerate(holes):
        for b in holes[i + 1:]:
            # two convex rings are apart if a side of one has the other one behind it
            if not any(max(turn(p, q, r) for r in other) <= 0 for ring, other in ((a, b), (b, a)) for p, q in zip(ring[:-1], ring[1:])):
                return False
    sides = [[(p, q) for p, q in zip(r[:-1], r[1:])] for r in rings]
    for i in range(len(rings)):
        for j in range(i):
            for a in sides[i]:
                for b in sides[j]:
                    if turn(*a, b[0]) == turn(*a, b[1]) == 0:
                        k = 0 if a[0][0] != a[1][0] else 1
                        (a1, a2), (b1, b2) = sorted((a[0][k], a[1][k])), sorted((b[0][k], b[1][k]))
                        if max(a1, b1) < min(a2, b2):
                            return False
    points = {p for r in rings for p in r}
    edges = {(p, k) for p in points for k, s in enumerate(sides) if any(on_side(*side, p) for side in s)}
    # take away what hangs on a single edge until nothing does: what is left goes in a circle
    while True:
        ends = [n for e in edges for n in (("p", e[0]), ("r", e[1]))]
        left = {e for e in edges if ends.count(("p", e[0])) > 1 and ends.count(("r", e[1])) > 1}
        if left == edges:
            return not edges
        edges = left


def test_touching_holes_match_brute_force(spark):
    ship(spark)
    rng = np.random.default_rng(5)
    shell = [(0, 0), (6, 0), (6, 6), (0, 6), (0, 0)]
    shapes = []
    while len(shapes) < 1500:
        holes = []
        for _ in range(int(rng.integers(1, 5))):
            a = tuple(int(v) for v in rng.integers(0, 7, 2))
            b, c = (tuple(int(v) for v in np.clip(np.array(a) + rng.integers(-2, 3, 2), 0, 6)) for _ in range(2))
            if turn(a, b, c):
                holes.append([a, b, c, a] if turn(a, b, c) > 0 else [a, c, b, a])
        if holes:
            shapes.append(holes)
    expected = {i: valid_with_convex_holes(shell, h) for i, h in enumerate(shapes)}
    cells = [(i, bytearray(polygon(shell, *h))) for i, h in enumerate(shapes)]
    got = {r.fid: (r.valid, r.reason) for r in geometry.validity(spark.createDataFrame(cells, "fid long, geometry binary").repartition(4)).collect()}
    assert {i: v for i, (v, _) in got.items()} == expected
    reasons = [r for _, r in got.values()]
    assert min(reasons.count(r) for r in ("Valid Geometry", "Self-intersection", "Interior is disconnected")) > 20


def test_many_wedges_in_a_point(spark):
    """Wedges that share one vertex touch there and are valid; one that is turned into its neighbour is not."""
    ship(spark)

    def wedges(n, turned=0.0):
        shell = [(-2, -2), (2, -2), (2, 2), (-2, 2), (-2, -2)]
        holes = []
        for k in range(n):
            a, b = 2 * np.pi * (k + (turned if k == 1 else 0.0)) / n, 2 * np.pi * (k + 0.5) / n
            holes.append([(0, 0), (np.cos(a), np.sin(a)), (np.cos(b), np.sin(b)), (0, 0)])
        return polygon(shell, *holes)

    df = spark.createDataFrame([(1, bytearray(wedges(300))), (2, bytearray(wedges(300, -0.7)))], "fid long, geometry binary")
    assert {r.fid: r.valid for r in geometry.validity(df).collect()} == {1: True, 2: False}


def jagged_cells(rng, n):
    """Multipolygons and collections of boxes, stars and triangles on a coarse grid, so that rings often touch, cross and nest."""
    def ring():
        x, y, w = rng.integers(0, 7), rng.integers(0, 7), rng.integers(1, 5)
        if rng.random() < 0.5:
            return [(x, y), (x + w, y), (x + w, y + w), (x, y + w), (x, y)]
        p = [tuple(q) for q in rng.integers(0, 9, (int(rng.integers(3, 6)), 2)).tolist()]
        return [*p, p[0]] if rng.random() < 0.95 else p

    def member():
        if rng.random() < 0.05:
            return polygon(star(rng, 60, float(rng.choice([0, 0.1]))), *[ring() for _ in range(rng.integers(0, 2))])
        box = [[(0, 0), (8, 0), (8, 8), (0, 8), (0, 0)]] if rng.random() < 0.5 else []
        return polygon(*box, *[ring() for _ in range(rng.integers(1, 4))])

    def box(a, b):
        return [(a, a), (b, a), (b, b), (a, b), (a, a)]

    nested = [polygon(box(0, 9), box(1, 8), box(2, 7)), struct.pack("<BII", 1, 6, 2) + polygon(box(0, 9)) + polygon(box(1, 2))]
    cells = list(enumerate(nested))
    for i in range(len(nested), n):
        k = int(rng.integers(0, 4))
        parts = [member() for _ in range(rng.integers(1, 4))]
        cells.append((i, parts[0] if k < 2 else struct.pack("<BII", 1, 6 if k == 2 else 7, len(parts)) + b"".join(parts)))
    point = struct.pack("<BI", 1, 1)
    return cells + [(n, None), (n + 1, point + struct.pack("<2d", 1, 2)), (n + 2, point + struct.pack("<2d", np.nan, 2)),
                    (n + 3, struct.pack("<BII", 1, 2, 2) + struct.pack("<4d", 1, 1, 1, 1)), (n + 4, struct.pack("<BII", 1, 6, 0))]


@pytest.mark.parametrize("pairs", [None, 50])
def test_cells_judged_whole_agree_with_the_joins(spark, monkeypatch, pairs):
    ship(spark)
    cells = jagged_cells(np.random.default_rng(5), 1500)
    df = spark.createDataFrame(cells, "fid long, geometry binary").repartition(4)
    if pairs:  # many small chunks of pairs, in this process: the workers hold their own module
        monkeypatch.setattr(geometry, "PAIRS_AT_ONCE", pairs)
        monkeypatch.setattr(geometry, "CROWDED", 6)
        worst = np.full(len(cells), geometry.FAULTLESS)
        areal = np.array([i < 1500 or i == 1504 for i, _ in cells])
        for group in geometry._groups(pa.array([c for _, c in cells], pa.binary())):
            geometry._cell_codes(group, areal, worst)
        reason = [geometry.VALID_TEXT if w == geometry.FAULTLESS else
                  geometry.REASONS[geometry.UNCHECKED if w == geometry.OPEN else w] for w in worst.tolist()]
        whole = {i: reason[i] if c is not None else None for i, c in cells}
    else:
        whole = {r.fid: r.reason for r in geometry.validity(df).collect()}
    monkeypatch.setattr(geometry, "JUDGED_WHOLE", 0)
    joined = {r.fid: r.reason for r in geometry.validity(df).collect()}
    assert whole == joined
    assert set(joined.values()) >= {geometry.VALID_TEXT, None, *(geometry.REASONS[i] for i in (1, 2, 3, 5, 6, 7, 8))}


def test_small_cells_are_judged_without_a_shuffle_of_their_sides(spark):
    ship(spark)
    df = spark.createDataFrame(jagged_cells(np.random.default_rng(6), 50), "fid long, geometry binary")
    assert "Exchange" not in geometry.cell_faults(df)._jdf.queryExecution().executedPlan().toString()
    rows = spark.createDataFrame([(1, bytearray(polygon(star(np.random.default_rng(7), 20_000, 0))))], "fid long, geometry binary")
    assert rows.where(f"octet_length(geometry) > {geometry.JUDGED_WHOLE}").count() == 1
    assert [tuple(r) for r in geometry.validity(rows).collect()] == [(1, True, geometry.VALID_TEXT)]
