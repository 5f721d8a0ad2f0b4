"""Equi-joins on sample keys.

No strategy is forced. Spark broadcasts a side only when its size, known or
measured at run time, is below the broadcast threshold; otherwise it sorts and
merges, and adaptive execution splits the partitions of a hot key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_aligned(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on a shared key; a NULL key part matches NULL, as index alignment does."""
    on = [left[k].eqNullSafe(right[k]) for k in keys]
    return left.join(right, on, "left").select(
        left["*"], *[right[c] for c in right.columns if c not in keys]
    )


def survey_pivot_join(survey: DataFrame, pivoted: DataFrame, pk: str = "objectid",
                      key: str = "amostra") -> DataFrame:
    return survey.join(pivoted, survey[pk] == pivoted[key], "left").drop(key)


def orphan_assays(survey: DataFrame, assay: DataFrame, pk: str = "objectid",
                  key: str = "amostra") -> DataFrame:
    """Assay rows whose sample is not in the survey table."""
    return assay.join(survey.select(F.col(pk).alias(key)), key, "left_anti")


def quarantine_rows(df: DataFrame, bad_keys: DataFrame, pk: str, key: str) -> DataFrame:
    """Whole source rows having at least one bad value; keys are reduced first."""
    keys = bad_keys.select(F.col(key).alias(pk)).distinct()
    return df.join(keys, pk, "left_semi")


def quarantine_dates(df: DataFrame, raw: str, parsed: str) -> DataFrame:
    return df.where(F.col(raw).isNotNull() & F.col(parsed).isNull())


def style_features(features: DataFrame, rules: DataFrame, on: str = "sigla") -> DataFrame:
    """Attach the drawing rule of each feature's unit."""
    return features.join(rules, on, "left")
