"""Colour rules of map units, as rows instead of a style document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import clean
from . import quality


def style_rules(units: DataFrame, name: str = "sigla") -> DataFrame:
    """One rule per unit that has a complete colour."""
    coloured = quality.drop_any_null(units, ["r", "g", "b"])
    return coloured.select(
        F.col(name),
        F.concat(F.lit("Unidade "), F.col(name)).alias("title"),
        clean.rgb_to_hex(F.col("r"), F.col("g"), F.col("b")).alias("fill"),
        F.lit("#FFFFFF").alias("stroke"),
        F.lit(0).alias("stroke_width"),
    )
