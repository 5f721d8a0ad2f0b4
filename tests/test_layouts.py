"""Cells of equal layout read at once, and key ranges of equal numbers of rows."""

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from strata.functions import crs, wkb
from strata.operators import geometry
from strata.sources import scan


def cell(order, kind, body, code=0, srid=None):
    head = struct.pack(order + "BI", order == "<", kind | code | (wkb.FLAG_SRID if srid else 0))
    return head + (struct.pack(order + "I", srid) if srid else b"") + body


def numbers(order, values):
    return np.asarray(values, order + "f8").tobytes()


def count(order, n):
    return struct.pack(order + "I", n)


def cells(rng):
    def xy(n, dims=2):
        return np.column_stack([rng.uniform(-60, -40, n), rng.uniform(-30, -5, n), *[rng.uniform(0, 9, n)] * (dims - 2)])

    out = [None, cell("<", 2, count("<", 0)), cell("<", 5, count("<", 0))]
    for order in "<>":
        out += [cell(order, 1, numbers(order, xy(1))) for _ in range(40)]
        out += [cell(order, 1, numbers(order, xy(1)), srid=s) for s in (4326, 4674) for _ in range(9)]
        out += [cell(order, 1, numbers(order, xy(1, 3)), wkb.FLAG_Z) for _ in range(20)]
        out += [cell(order, 2, count(order, 3) + numbers(order, xy(3))) for _ in range(12)]
        out += [cell(order, 3, count(order, 1) + count(order, 4) + numbers(order, xy(4))) for _ in range(12)]
        # one block, then an empty line: nothing like the others of that length
        out += [cell(order, 5, count(order, 2) + cell(order, 2, count(order, 2) + numbers(order, xy(2))) + cell(order, 2, count(order, 0)))
                for _ in range(10)]
        out += [cell(order, 4, count(order, 2) + b"".join(cell(order, 1, numbers(order, xy(1))) for _ in "ab")) for _ in range(10)]
    return [out[i] for i in rng.permutation(len(out))]


def slow(value, chain):
    if value is None:
        return None
    copy = bytearray(value)
    for block in geometry.blocks(copy):
        x, y = crs.transform_arrays(block[4][:, 0].astype(float), block[4][:, 1].astype(float), chain)
        block[4][:, 0], block[4][:, 1] = x, y
    return bytes(copy)


def test_reproject_of_mixed_layouts(spark):
    data = list(enumerate(cells(np.random.default_rng(4))))
    df = spark.createDataFrame(data, "fid long, geometry binary").repartition(2)
    out = {r.fid: r.geometry for r in geometry.reproject(df, "geometry", 31982, 4326).collect()}
    chain = crs.steps(4326, 31982)
    assert len(out) == len(data)
    for fid, value in data:
        want, got = slow(value, chain), out[fid]
        if want is None or got is None:
            assert got is want
            continue
        assert len(got) == len(want)
        for a, b in zip(geometry.blocks(bytes(got)), geometry.blocks(want), strict=True):
            assert a[:4] == b[:4] and np.allclose(a[4], b[4], rtol=1e-13, atol=0)


def test_layouts_take_every_cell_once():
    values = cells(np.random.default_rng(9))
    data, at = geometry._bytes(pa.array([b"left out", *values], pa.binary()).slice(1))
    there = np.array([i for i, v in enumerate(values) if v is not None])
    layouts, rest = geometry.same_layouts(data, at, there)
    owner = [np.searchsorted(at, start, "right") - 1 for start, _ in layouts]
    assert sorted(np.concatenate([*owner, rest]).tolist()) == there.tolist() and len(rest) < len(there) / 2
    for own, (_, block) in zip(owner, layouts, strict=True):
        want = np.concatenate([b[4] for i in own.tolist() for b in geometry.blocks(values[i])])
        assert (block == want).all()


def test_key_ranges_follow_the_rows(spark):
    # nine in ten keys lie in a thousandth of the span
    keys = spark.range(90_000).select(F.col("id").alias("k")).union(spark.range(10_000).select((F.col("id") * 10_000 + 90_000).alias("k")))
    keys = keys.union(spark.createDataFrame([(None,)], "k long"))
    ranges = scan.key_predicates(keys, "k", 20)
    assert len(ranges) == 20
    sizes = [keys.where(r).count() for r in ranges]
    assert sum(sizes) == 100_001 and max(sizes) < 1.1 * 5_000 and min(sizes) > 0.9 * 5_000
    assert keys.where("k IS NULL").where(ranges[0]).count() == 1
    assert scan.key_predicates(keys, "k", 1) == scan.key_predicates(keys.where("false"), "k", 8) == ["1 = 1"]
    few = spark.createDataFrame([(7,)] * 50 + [(8,)], "k long")
    assert [few.where(r).count() for r in scan.key_predicates(few, "k", 8)] == [50, 1]
