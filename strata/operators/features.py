"""Quality report and layers of a feature class."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import wkb
from . import geometry, quality, reshape


def feature_report(df: DataFrame, audit: DataFrame, target_srid: int, fid: str = "fid",
                   geom: str = "geometry") -> DataFrame:
    """One row: duplicate keys, types, CRS difference, empty, invalid, null bytes.

    ``audit`` is the result of ``validity`` on the same features. The partial
    reports have one row each and are merged by a union, not a join.
    """
    g = F.col(geom)
    differs = geometry.crs_differs(df, geom, target_srid)
    scan = df.agg(
        geometry.geometry_types(df, geom).alias("geometry_types"),
        F.lit(differs).alias("crs_is_different"),
        quality.any_true(wkb.is_empty(g)).alias("has_empty_geometry"),
        quality.null_byte_columns(df).alias("null_byte_columns"),
    )
    keys = quality.unique_key(df, [fid]).agg((F.count(F.lit(1)) > 0).alias("fid_is_duplicated"))
    shapes = audit.agg(
        quality.any_true(F.col("valid") == F.lit(False)).alias("has_invalid_geometry"),
        quality.any_true(F.col("valid").isNull()).alias("has_unchecked_geometry"),
    )
    merged = reshape.concat_parts([scan, keys, shapes])
    out = merged.agg(*[F.max(c).alias(c) for c in merged.columns])
    return out.withColumn("has_null_byte_str", F.size("null_byte_columns") > 0)


def split_layers(df: DataFrame, faults: DataFrame, repaired: DataFrame | None = None,
                 repaired_faults: DataFrame | None = None, fid: str = "fid",
                 geom: str = "geometry") -> dict[str, DataFrame]:
    """Layers ``invalid``, ``invalid_after_autorepair`` and ``valid``.

    ``faults`` are (fid, reason) of the invalid features; ``repaired`` has just those
    features. ``valid`` holds all features, the repaired ones with their new geometry.
    """
    layers = {"invalid": faults}
    everything = df
    if repaired is not None:
        layers["invalid_after_autorepair"] = repaired_faults
        metadata = df.schema[geom].metadata
        fixed = repaired.select(F.col(fid), F.col(geom).alias("_fixed"), F.lit(True).alias("_is_fixed"))
        everything = df.join(fixed, fid, "left").withColumn(
            geom, F.when(F.col("_is_fixed"), F.col("_fixed")).otherwise(F.col(geom)).alias(geom, metadata=metadata)
        ).drop("_fixed", "_is_fixed")
    layers["valid"] = everything
    return layers


def faults_of(audit: DataFrame, fid: str = "fid") -> DataFrame:
    """(fid, invalid_reason) of the features an audit found invalid."""
    return audit.where(~F.col("valid")).select(fid, F.col("reason").alias("invalid_reason"))


def unchecked_of(audit: DataFrame, fid: str = "fid") -> DataFrame:
    """(fid, invalid_reason) of the features an audit could not decide."""
    return audit.where(F.col("valid").isNull()).select(fid, F.col("reason").alias("invalid_reason"))
