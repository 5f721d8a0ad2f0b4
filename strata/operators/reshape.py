"""Wide <-> long, and the value grammar applied to a long table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean


def unpivot_assays(df: DataFrame, pk: str, columns: list[str], key: str = "amostra",
                   var: str = "analito", val: str = "valor") -> DataFrame:
    """One row per non-NULL cell. Only ``pk`` and ``columns`` are read from the scan.

    Pass fewer ``columns`` to prune: a filter on ``var`` afterwards would not
    reach below the expansion.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    cells = df.select(
        F.col(f"`{pk}`").alias(key),
        *[clean.plain_text(F.col(f"`{c}`"), types[c]).alias(c) for c in columns],
    )
    long = cells.unpivot([key], [F.col(f"`{c}`") for c in columns], var, val)
    return long.where(F.col(val).isNotNull())


def analyte_name(c: Column) -> Column:
    unit = analyte_unit(c)
    return F.when(unit.isNull(), c).otherwise(F.left(c, F.length(c) - F.length(unit) - 1))


def analyte_unit(c: Column) -> Column:
    return F.when(F.instr(c, "_") > 0, F.substring_index(c, "_", -1))


def split_analyte_unit(df: DataFrame, analyte: str = "analito", unit: str = "unidade",
                       units: list[str] | None = None) -> DataFrame:
    """Split at the last ``_``; without one the unit is NULL.

    ``units`` optionally lists compound units (``ug_l``) that win over the last ``_``.
    """
    c = F.col(analyte)
    name, found = analyte_name(c), analyte_unit(c)
    for u in sorted(units or [], key=len):
        hit = c.endswith(f"_{u}")
        name = F.when(hit, F.left(c, F.length(c) - len(u) - 1)).otherwise(name)
        found = F.when(hit, F.lit(u)).otherwise(found)
    at = df.columns.index(analyte)
    cols = [F.col(n) for n in df.columns if n != unit]
    cols[at:at + 1] = [name.alias(analyte), found.alias(unit)]
    return df.select(*cols)


def chem_qualifier(c: Column) -> Column:
    """Leading ``<``, ``>``, ``I`` or ``N`` of a cleaned chemical value."""
    first = F.left(c, F.lit(1))
    return F.when(clean.chem_class(c).isNotNull() & first.isin(*clean.QUALIFIERS), first)


def chem_number(c: Column) -> Column:
    """Number of a cleaned chemical value; 0 for ``I`` and ``N``; NULL outside the grammar."""
    kind = clean.chem_class(c)
    return (
        F.when(kind == "number", F.ltrim(c, F.lit("<>")).try_cast("double"))
        .when(kind.isNotNull(), F.lit(0.0))
    )


def whole_number(c: Column) -> Column:
    return F.when(c.rlike(clean.INTEGER), c.try_cast("bigint"))


def decompose_value(df: DataFrame, value: str = "valor", qualifier: str = "qualificador",
                    number: str = "valor") -> DataFrame:
    """Cleaned chemical text -> (qualifier, number).

    A value outside the grammar gets two NULLs, so a gate can count it in the same pass.
    """
    c = F.col(value)
    kept = [n for n in df.columns if n not in (value, qualifier, number)]
    return df.select(*kept, chem_qualifier(c).alias(qualifier), chem_number(c).alias(number))


def concat_parts(parts: list[DataFrame]) -> DataFrame:
    """Vertical concatenation by column name; a missing column is NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def pivot_assays(assay: DataFrame, analytes: list[str], key: str = "amostra", var: str = "analito",
                 val: str = "valor", unit: str | None = None) -> DataFrame:
    """One row per sample, one column per label in ``analytes``.

    Conditional maxima over fixed-width numbers: map-side combined, one shuffle on
    the sample key, and no second aggregation as with ``pivot``. With the unique
    (sample, analyte) key the maximum is the single value.
    """
    label = F.col(var) if unit is None else F.concat_ws("_", F.col(var), F.col(unit))
    slim = assay.select(F.col(key), label.alias("_label"), F.col(val).alias("_value"))
    return slim.groupBy(key).agg(*[
        F.max(F.when(F.col("_label") == a, F.col("_value"))).alias(a) for a in analytes
    ])


def survey_view(survey: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return survey.select(*(columns or survey.columns))


def assay_view(assay: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return assay.select(*(columns or assay.columns))
