"""Naming, selecting and typing columns. Only schema metadata is touched on the driver."""

from __future__ import annotations

import html
import re
import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clean

# Characters that ASCII folding by decomposition would lose.
FOLDS = {"µ": "u", "ß": "ss", "ø": "o", "Ø": "O", "æ": "ae", "Æ": "AE", "œ": "oe",
         "đ": "d", "ł": "l", "Ł": "L", "°": "deg"}


def _fold(ch: str, name: str) -> str:
    """One character in ASCII; a Greek letter by its name, and no letter is lost unseen."""
    if ch in FOLDS:
        return FOLDS[ch]
    plain = unicodedata.normalize("NFKD", ch)
    ascii_only = plain.encode("ascii", "ignore").decode("ascii")
    if ascii_only or not any(c.isalpha() for c in plain):
        return ascii_only if ascii_only or ch.isascii() else "" if unicodedata.category(ch).startswith("M") else " "
    words = unicodedata.name(plain[0], "").split()
    if words[:1] == ["GREEK"] and "LETTER" in words:
        return words[words.index("LETTER") + 1].lower()
    raise ValueError(f"the letter {ch!r} of the column name {name!r} has no ASCII form")


def slug(name: str, sep: str = "_") -> str:
    """ASCII-fold, lower-case, every other run becomes one separator, ends trimmed.

    A comma between two digits is a decimal mark and disappears (``0,5`` -> ``05``).
    """
    text = html.unescape(name)
    text = "".join(_fold(ch, name) for ch in text).lower()
    text = re.sub(r"(?<=[0-9]),(?=[0-9])", "", text)
    folded = re.sub(r"[^a-z0-9]+", sep, text).strip(sep)
    if not folded:
        raise ValueError(f"nothing is left of the column name {name!r}")
    return folded


def slug_map(names: list[str], sep: str = "_") -> dict[str, str]:
    mapped = {n: slug(n, sep) for n in names}
    groups: dict[str, list[str]] = {}
    for name, target in mapped.items():
        groups.setdefault(target, []).append(name)
    clashes = {t: ns for t, ns in groups.items() if len(ns) > 1}
    if clashes or len(set(names)) != len(names):
        raise ValueError(f"column names collide after folding: {clashes or names}")
    return mapped


def slugify_columns(df: DataFrame, sep: str = "_", keep: tuple[str, ...] = ()) -> DataFrame:
    """Rename every column to its slug; names in ``keep`` (the key) stay as they are."""
    mapped = slug_map([c for c in df.columns if c not in keep], sep)
    targets = [mapped.get(c, c) for c in df.columns]
    if len(set(targets)) != len(targets):
        raise ValueError(f"column names collide with the key after folding: {targets}")
    return df.toDF(*targets)


def select_existing(df: DataFrame, columns: list[str] | tuple[str, ...]) -> DataFrame:
    """The listed columns that exist, in list order."""
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])


def split_columns(source: list[str], survey: list[str], excluded, pk: str) -> tuple[list[str], list[str]]:
    """Survey columns come from the target table; what is left and not excluded is an analyte."""
    known = {*survey, *excluded, pk}
    return [c for c in survey if c in source], [c for c in source if c not in known]


def split_survey_assay(df: DataFrame, survey_columns, excluded, pk: str) -> tuple[DataFrame, DataFrame]:
    survey, assay = split_columns(df.columns, list(survey_columns), excluded, pk)
    return (
        select_existing(df, [pk, *[c for c in survey if c != pk]]),
        select_existing(df, [pk, *assay]),
    )


def target_columns(spark, table: str) -> list[str]:
    """Column names of a target table in ordinal order."""
    return spark.table(table).columns


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)


def humanize(df: DataFrame, labels: dict[str, str]) -> DataFrame:
    """Replace folded column names by their display labels (before the unpivot)."""
    return df.withColumnsRenamed({k: v for k, v in labels.items() if k in df.columns})


def generic_type(data_type: T.DataType) -> T.DataType:
    """Vendor-flavoured types to the generic one; a wide integer decimal stays exact."""
    if isinstance(data_type, T.DecimalType) and data_type.scale == 0 and data_type.precision <= 18:
        return T.LongType()
    if isinstance(data_type, (T.CharType, T.VarcharType)):
        return T.StringType()
    if isinstance(data_type, (T.DateType, T.TimestampType)):
        return T.TimestampNTZType()
    return data_type


def generalize_types(df: DataFrame) -> DataFrame:
    return df.select(*[
        F.col(f"`{f.name}`").cast(generic_type(f.dataType)).alias(f.name, metadata=f.metadata)
        for f in df.schema.fields
    ])


# Plain decimal text only: a bare cast would also take "1d" or "Infinity".
_LONG_TEXT = r"^-?[0-9]{1,18}$"
_DOUBLE_TEXT = r"^-?[0-9]+([.][0-9]+)?$"


def _back(c: Column, number: str) -> Column:
    """Is the text one that the number prints as? A code (007), a lost digit and an infinity are not."""
    value = c.try_cast(number)
    if number == "bigint":
        return c.rlike(_LONG_TEXT) & (value.cast("string") == c)
    text = clean.plain_text(value, T.DoubleType())
    return c.rlike(_DOUBLE_TEXT) & ((text == c) | (text == F.concat(c, F.lit(".0"))))


def infer_types(df: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Best type per text column (of ``names``, or all), found in one aggregation over all of them.

    A column becomes a number only if every text of it comes back the same from that number; else it
    stays text. Two counts per column travel to the driver, whatever the size of the table.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType) and (names is None or f.name in names)]
    if not texts:
        return df
    metrics = []
    for i, name in enumerate(texts):
        c = F.col(f"`{name}`")
        metrics += [F.count(c).alias(f"n{i}"), F.count_if(_back(c, "bigint")).alias(f"l{i}"),
                    F.count_if(_back(c, "double")).alias(f"d{i}")]
    row = df.agg(*metrics).first()
    casts = {}
    for i, name in enumerate(texts):
        n = row[f"n{i}"]
        if n and row[f"l{i}"] == n:
            casts[name] = "bigint"
        elif n and row[f"d{i}"] == n:
            casts[name] = "double"
    return df.withColumns({n: F.col(f"`{n}`").cast(t) for n, t in casts.items()})


def table_name(prefix: str = "", suffix: str = ".parquet") -> Column:
    """Table name of the file a row was read from."""
    pattern = f"^{re.escape(prefix)}|{re.escape(suffix)}$"
    # the metadata column holds the name URI-encoded, where "+" is a plain character
    name = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(name, pattern, "")


def with_table_name(df: DataFrame, prefix: str = "", suffix: str = ".parquet", name: str = "table_name") -> DataFrame:
    return df.withColumn(name, table_name(prefix, suffix))


def assign(df: DataFrame, **columns: Column) -> DataFrame:
    return df.withColumns(columns)


def drop(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def key_columns(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Key columns first, in the given order, then the others as they stand."""
    return df.select(*keys, *[c for c in df.columns if c not in keys])
