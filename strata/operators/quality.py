"""Aggregates, profiles and gates.

A gate returns its violations as a DataFrame; only ``enforce`` runs anything.
Grouping gates combine map-side, so a key that owns a third of the rows reaches
the shuffle as one row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean


class GateError(Exception):
    """A quality gate found violations."""


# aggregates ---------------------------------------------------------------

def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def max_of(df: DataFrame, column: str) -> DataFrame:
    return df.agg(F.max(column).alias(f"max_{column}"))


def any_true(c: Column) -> Column:
    """Aggregate: false, not NULL, when there is nothing to look at."""
    return F.coalesce(F.bool_or(c), F.lit(False))


def all_true(c: Column) -> Column:
    return F.coalesce(F.bool_and(c), F.lit(True))


def value_counts(df: DataFrame, column: str) -> DataFrame:
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), F.col(column))


def frame_profile(df: DataFrame) -> DataFrame:
    """Non-NULL count and type per column, from one aggregation."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    types = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    return counts.unpivot([], [F.col(f"`{c}`") for c in df.columns], "column_name", "non_null").select(
        "column_name", "non_null", types[F.col("column_name")].alias("data_type")
    )


def distinct_keys(df: DataFrame, key: str) -> DataFrame:
    return df.select(key).distinct()


def violation_sample(df: DataFrame, keys: list[str], n: int = 5) -> DataFrame:
    """The first offending rows by key (a top-n, no full sort)."""
    return df.orderBy(*keys).limit(n)


def drop_missing(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNotNull())


def drop_any_null(df: DataFrame, subset: list[str]) -> DataFrame:
    return df.na.drop("any", subset=subset)


def keep_valid(df: DataFrame, condition: Column) -> DataFrame:
    return df.where(condition)


def keep_invalid(df: DataFrame, condition: Column) -> DataFrame:
    """Rows where the condition is not true; undecided (NULL) counts as invalid."""
    return df.where(~F.coalesce(condition, F.lit(False)))


# gates --------------------------------------------------------------------

def not_empty(df: DataFrame) -> DataFrame:
    """One row when the table has no rows."""
    return df.limit(1).agg(F.count(F.lit(1)).alias("n")).where("n = 0")


def unique_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated keys and how often each occurs."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def chem_grammar(df: DataFrame, value: str = "valor") -> DataFrame:
    return keep_invalid(df, clean.chem_valid(F.col(value)))


def integer_grammar(df: DataFrame, value: str) -> DataFrame:
    return keep_invalid(df, F.col(value).rlike(clean.INTEGER))


def castable_number(df: DataFrame, value: str) -> DataFrame:
    return df.where(clean.to_number_try(F.col(value)).isNull())


def geometry_present(df: DataFrame, is_null: Column, is_empty: Column) -> DataFrame:
    """Counts of NULL and empty geometries; no row when there is neither."""
    return df.agg(
        F.count_if(is_null).alias("n_null"),
        F.count_if(F.coalesce(is_empty, F.lit(False))).alias("n_empty"),
    ).where("n_null + n_empty > 0")


def null_byte_columns(df: DataFrame) -> Column:
    """Aggregate: names of the text columns in which any NUL character occurs."""
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not texts:
        return F.array().cast("array<string>")
    return F.array_compact(F.array(*[
        F.when(any_true(clean.contains_null_byte(F.col(f"`{c}`"))), F.lit(c)) for c in texts
    ]))


def enforce(violations: DataFrame, name: str, keys: list[str] | None = None, n: int = 5) -> None:
    """Stop when the gate has rows. The message holds the count and the first few."""
    count = violations.agg(F.count(F.lit(1))).first()[0]
    if count:
        first = violation_sample(violations, keys or violations.columns, n).collect()
        raise GateError(f"{name}: {count} violations, first {[tuple(r) for r in first]}")
