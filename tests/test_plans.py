"""What the plans read, shuffle and broadcast; and what a hot key does to them."""

import re

import pytest
from pyspark.sql import functions as F

from strata.operators import geometry, joins, quality, reshape
from strata.plans import jobs
from strata.session import ship
from test_geometry import SQUARE, polygon
from workload import inputs, lab
from workload.registry import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffles(df):
    return len(re.findall(r"Exchange (?:hash|range|single|round)", plan(df)))


def test_assay_needs_no_shuffle_and_reads_only_its_columns(spark, sf_dir):
    df = jobs.chem_assay_frame(lab.chem(spark, sf_dir), inputs.CHEM_SPEC)
    assert shuffles(df) == 0
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan(df)
    assert "Python" not in plan(df) and "InArrow" not in plan(df)


def test_fewer_analytes_mean_fewer_columns_read(spark, tmp_path):
    spark.createDataFrame([(1, "1", "2", "x")], "objectid long, a_x string, b_y string, c_z string") \
        .write.parquet(str(tmp_path / "b"))
    bronze = spark.read.parquet(str(tmp_path / "b"))
    df = jobs.chem_assay_frame(bronze, inputs.CHEM_SPEC, ["b_y"])
    assert "ReadSchema: struct<objectid:bigint,b_y:string>" in plan(df)


def test_pivot_is_one_shuffle_with_partial_sums(spark, sf_dir):
    assay = jobs.chem_assay_frame(lab.chem(spark, sf_dir), inputs.CHEM_SPEC)
    df = reshape.pivot_assays(assay, inputs.CHEM_ANALYTES, unit="unidade")
    assert shuffles(df) == 1
    assert "partial_max" in plan(df) and "SortAggregate" not in plan(df)


def test_direct_pivot_needs_no_shuffle(spark, sf_dir):
    assert shuffles(jobs.survey_pivot_frame(lab.chem(spark, sf_dir), inputs.CHEM_SPEC)) == 0


def test_filters_reach_the_scan(spark, sf_dir):
    df = quality.unique_key(inputs.table(spark, sf_dir, "lineitem").where("l_quantity > 40"), ["l_orderkey"])
    assert re.search(r"PushedFilters: \[IsNotNull\(l_quantity\), GreaterThan\(l_quantity,40", plan(df))
    assert "partial_count" in plan(df)


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith(("j1_", "j6_", "j7_", "j8_", "j9_", "k", "g11"))))
def test_no_cross_or_nested_loop_join(spark, sf_dir, name):
    text = plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in text and "NestedLoop" not in text


def test_crossing_search_shuffles_once_by_square(spark):
    ship(spark)
    df = spark.createDataFrame([(i, bytearray(polygon(SQUARE))) for i in range(50)], "fid long, geometry binary")
    found = geometry.crossings(df)
    assert "SortMergeJoin" in plan(found) and "LeftSemi" in plan(found)
    assert "Broadcast" not in plan(found)
    found.collect()
    assert "ReusedExchange" in plan(found)


@pytest.fixture
def small_skew_limits(spark):
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def hot(spark, n=90_000):
    """A third of the rows share one key."""
    return spark.range(0, n, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("amostra"),
        F.md5(F.col("id").cast("string")).alias("v"))


@pytest.mark.parametrize("op", ["orphans", "aligned", "quarantine", "style"])
def test_hot_key_is_split(spark, small_skew_limits, op):
    left = hot(spark)
    right = spark.range(0, 90_000, 2, 8).toDF("objectid")
    df = {
        "orphans": lambda: joins.orphan_assays(right, left),
        "aligned": lambda: joins.join_aligned(left, right.selectExpr("objectid as amostra", "objectid * 2 as w"), ["amostra"]),
        "quarantine": lambda: joins.quarantine_rows(
            left.withColumnRenamed("amostra", "objectid"), right.withColumnRenamed("objectid", "k"), "objectid", "k"),
        "style": lambda: joins.style_features(
            left.withColumnRenamed("amostra", "sigla"), right.selectExpr("objectid as sigla", "'#FFFFFF' as fill")),
    }[op]()
    rows = df.collect()
    assert "skew=true" in plan(df)
    keys = {r.objectid for r in right.collect()}
    source = [r.amostra for r in left.collect()]
    expected = {"orphans": sum(k not in keys for k in source), "aligned": len(source),
                "quarantine": sum(k in keys for k in source), "style": len(source)}[op]
    assert len(rows) == expected


def test_hot_key_groups_are_combined_before_the_shuffle(spark):
    df = quality.unique_key(hot(spark), ["amostra"])
    assert plan(df).count("HashAggregate") == 2 and "partial_count" in plan(df)
    assert {(r.amostra, r.n) for r in df.collect()} == {(7, 30_001)}
