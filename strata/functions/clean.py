"""Text, flag, date and number cleaning. Everything here is Column -> Column.

All expressions are Spark built-ins, so a chain of them stays inside one
whole-stage-codegen span next to the scan.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tokens that mean "missing", compared exactly and only after
# every whitespace character has been removed.
MISSING_COMMON = (
    "", "#N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "NULL", "NaN", "None", "n/a", "nan", "null",
)
MISSING_TOKENS = {
    "chem": MISSING_COMMON,
    "count": MISSING_COMMON + ("<NA>", "N/A", "NA", "N.A.", "ND", "0"),
    "weight": MISSING_COMMON + ("<NA>", "N/A", "NA", "N.A.", "<Null>"),
}

# Ordered literal replacements applied after the missing test.
REPLACEMENTS = {
    "chem": ((",", "."), ("-", "<"), ("<.", "<0.")),
    "count": (),
    "weight": ((",", "."),),
}

# Patterns a cleaned value has to match.
CHEM_NUMBER = r"^[<>]?[0-9]+[.]?[0-9]*$"
CHEM_INSUFFICIENT = r"^I[.]?S[.]?$"
CHEM_NOT_ANALYSED = r"^N[.]?[AD][.]?$"
INTEGER = r"^[0-9]+$"
DECIMAL = (
    r"^[+-]?(([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?"
    r"|[iI][nN][fF]([iI][nN][iI][tT][yY])?)$"
)

# The qualifiers a chemical value can carry, in dictionary order.
QUALIFIERS = ("<", ">", "I", "N")

NULL_BYTE = "\x00"


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def empty_to_null_columns(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """``''`` becomes NULL in every text column (or in the listed ones)."""
    names = set(columns or df.columns)
    return df.select(*[
        empty_to_null(F.col(f"`{f.name}`")).alias(f.name)
        if f.name in names and isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def strip_spaces(c: Column) -> Column:
    """Remove all whitespace, the Unicode kinds (NBSP, thin space) included."""
    return F.regexp_replace(c, r"(?U)\s+", "")


def missing_to_null(c: Column, dialect: str, extra: tuple[str, ...] = ()) -> Column:
    return F.when(~c.isin(*MISSING_TOKENS[dialect], *extra), c)


def replace_chain(c: Column, ordered: tuple[tuple[str, str], ...]) -> Column:
    """Literal replacements, one after the other: order matters."""
    for old, new in ordered:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def yes_flag(c: Column) -> Column:
    """True when the text starts with ``sim`` or ``1`` in any case; NULL is false."""
    return F.coalesce(c, F.lit("não")).rlike("(?i)^(sim|1)")


# Date directives of a spec -> (Spark pattern letters, digits allowed).
DATE_DIRECTIVES = {
    "%d": ("d", "[0-9]{1,2}"),
    "%m": ("M", "[0-9]{1,2}"),
    "%Y": ("yyyy", "[0-9]{4}"),
    "%H": ("H", "[0-9]{1,2}"),
    "%M": ("m", "[0-9]{1,2}"),
    "%S": ("s", "[0-9]{1,2}"),
}


def date_pattern(fmt: str) -> tuple[str, str]:
    """Spark datetime pattern and guard regex for a ``%d/%m/%Y`` style format."""
    pattern, guard = "", "^"
    for token in re.findall(r"%.|[^%]", fmt):
        if token.startswith("%"):
            letters, digits = DATE_DIRECTIVES[token]
            pattern, guard = pattern + letters, guard + digits
        else:
            literal = f"'{token}'" if token.isalpha() else token
            pattern, guard = pattern + literal, guard + re.escape(token)
    return pattern, guard + "$"


def parse_date(c: Column, fmt: str = "%d/%m/%Y") -> Column:
    """Wall-clock timestamp without time zone, or NULL when the text does not fit.

    A format without hours goes through DATE, so a midnight that a session time
    zone skips (daylight saving) is never moved.
    """
    pattern, guard = date_pattern(fmt)
    fitting = F.when(c.rlike(guard), c)
    if any(t in fmt for t in ("%H", "%M", "%S")):
        parsed = F.try_to_timestamp(fitting, F.lit(pattern))
    else:
        parsed = F.try_to_date(fitting, pattern)
    return parsed.cast(T.TimestampNTZType())


def to_number_try(c: Column) -> Column:
    """Number or NULL. The guard rejects what a bare cast would take (``1d``, ``NaN``)."""
    return F.when(c.rlike(DECIMAL), c.try_cast("double"))


def to_number_strict(c: Column) -> Column:
    """NULL counts as 0; any other non-number stops the query, in ANSI mode or not."""
    filled = fill(c, "0")
    return F.coalesce(
        to_number_try(filled),
        F.raise_error(F.concat(F.lit("not a number: "), filled)).cast("double"),
    )


def fill(c: Column, value) -> Column:
    return F.coalesce(c, F.lit(value))


def strip_null_bytes(df: DataFrame) -> DataFrame:
    """Remove NUL characters from every text column, chosen by type."""
    return df.select(*[
        F.replace(F.col(f"`{f.name}`"), F.lit(NULL_BYTE), F.lit("")).alias(f.name, metadata=f.metadata)
        if isinstance(f.dataType, T.StringType) else F.col(f"`{f.name}`")
        for f in df.schema.fields
    ])


def contains_null_byte(c: Column) -> Column:
    return F.contains(c, F.lit(NULL_BYTE))


def rgb_to_hex(r: Column, g: Column, b: Column) -> Column:
    return F.format_string("#%02X%02X%02X", *[c.cast("int") for c in (r, g, b)])


def parse_bool_text(c: Column) -> Column:
    """``true`` / ``false`` in any case, with surrounding blanks; else NULL."""
    word = F.lower(F.trim(c))
    return F.when(word == "true", F.lit(True)).when(word == "false", F.lit(False))


def normalize_geom_type(c: Column) -> Column:
    return replace_chain(F.upper(c), (("ST_", ""), ("MULTI", "")))


def matches(c: Column, pattern: str) -> Column:
    return c.rlike(pattern if pattern.startswith("^") else f"^{pattern}")


def clean_value(c: Column, dialect: str, extra_missing: tuple[str, ...] = ()) -> Column:
    """strip -> missing -> replace, in this order.

    Replacing before the missing test would turn ``-NaN`` into ``<NaN``.
    """
    return replace_chain(missing_to_null(strip_spaces(c), dialect, extra_missing), REPLACEMENTS[dialect])


def chem_class(c: Column) -> Column:
    """``number``, ``insufficient``, ``not_analysed`` or NULL for a bad value."""
    return (
        F.when(c.rlike(CHEM_NUMBER), "number")
        .when(c.rlike(CHEM_INSUFFICIENT), "insufficient")
        .when(c.rlike(CHEM_NOT_ANALYSED), "not_analysed")
    )


def chem_valid(c: Column) -> Column:
    return c.rlike(CHEM_NUMBER) | c.rlike(CHEM_INSUFFICIENT) | c.rlike(CHEM_NOT_ANALYSED)


def _without_exponent(text: Column) -> Column:
    """``-1.25E-7`` -> ``-0.000000125``: the same digits with the point moved, nothing rounded."""
    mantissa, power = F.substring_index(text, "E", 1), F.substring_index(text, "E", -1).try_cast("int")
    sign = F.when(text.startswith("-"), "-").otherwise("")
    lead = F.ltrim(F.substring_index(mantissa, ".", 1), F.lit("-"))
    rest = F.rtrim(F.substring_index(mantissa, ".", -1), F.lit("0"))
    zeros = F.lit("0")
    small = F.concat(sign, F.lit("0."), F.repeat(zeros, -power - 1), lead, rest)
    whole = F.concat(sign, lead, rest, F.repeat(zeros, power - F.length(rest)))
    mixed = F.concat(sign, lead, F.left(rest, power), F.lit("."), F.substring(rest, power + 1, F.length(rest)))
    return F.when(power < 0, small).when(F.length(rest) <= power, whole).otherwise(mixed)


def plain_text(c: Column, data_type: T.DataType) -> Column:
    """Text of any cell; floating cells never in scientific notation and never rounded."""
    text = c.cast("string")
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        return F.when(text.contains("E"), _without_exponent(text)).otherwise(text)
    return text


def category_code(c: Column) -> Column:
    """Position in the qualifier dictionary. The dictionary is fixed, so no pass over
    the data is needed to find it; Parquet stores the text itself dictionary-encoded."""
    return F.coalesce(*[F.when(c == q, F.lit(i)) for i, q in enumerate(QUALIFIERS)])
