"""Laboratory-table queries: cleaning, reshaping, gates, joins, jobs."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from strata.functions import clean
from strata.operators import columns, joins, quality, reshape
from strata.plans import jobs
from strata.sources import scan, sinks
from strata.spec import CHEMICAL_MEDIA

from .inputs import (
    CHEM_ANALYTES, CHEM_SPEC, COUNT_ANALYTES, COUNT_SPEC, DATE_TEXT, FLAG_TEXT, SURVEY_COLUMNS, WEIGHT_ANALYTES,
    WEIGHT_SPEC, chem_columns, count_columns, derived, select_text, table, weight_columns,
)
from .registry import query
from .scratch import new_run_dir

# SQL side -----------------------------------------------------------------

_COMMON = "'', '#N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', 'NULL', 'NaN', 'None', " \
          "'n/a', 'nan', 'null'"
_MISSING = {
    "chem": _COMMON,
    "count": _COMMON + ", '<NA>', 'N/A', 'NA', 'N.A.', 'ND', '0'",
    "weight": _COMMON + ", '<NA>', 'N/A', 'NA', 'N.A.', '<Null>'",
}


def sql_strip(c: str) -> str:
    return f"regexp_replace(replace({c}, chr(160), ''), '\\s+', '', 'g')"


def sql_clean(c: str, kind: str) -> str:
    s = sql_strip(c)
    kept = f"CASE WHEN {s} IN ({_MISSING[kind]}) THEN NULL ELSE {s} END"
    return {
        "chem": f"replace(replace(replace({kept}, ',', '.'), '-', '<'), '<.', '<0.')",
        "count": kept,
        "weight": f"replace({kept}, ',', '.')",
    }[kind]


def sql_long(analytes: list[str], source: str = "bronze", labels: dict[str, str] | None = None) -> str:
    arms = [
        f"SELECT objectid AS amostra, '{(labels or {}).get(a, a)}' AS analito, {a} AS raw FROM {source}"
        for a in analytes
    ]
    return f"SELECT * FROM ({' UNION ALL '.join(arms)}) u WHERE raw IS NOT NULL"


def sql_cleaned(cols: dict[str, str], analytes: list[str], kind: str, labels=None, source: str = "orders") -> str:
    """CTEs bronze, long_rows and cleaned(amostra, analito, v)."""
    return (
        f"bronze AS ({select_text(cols, source)}), long_rows AS ({sql_long(analytes, labels=labels)}), "
        f"cleaned AS (SELECT * FROM (SELECT amostra, analito, {sql_clean('raw', kind)} AS v FROM long_rows) c "
        f"WHERE v IS NOT NULL)"
    )


_NAME = "CASE WHEN contains(analito, '_') THEN regexp_extract(analito, '^(.*)_([^_]*)$', 1) ELSE analito END"
_UNIT = "CASE WHEN contains(analito, '_') THEN regexp_extract(analito, '^(.*)_([^_]*)$', 2) ELSE NULL END"
_NUM = "regexp_matches(v, '^[<>]?[0-9]+[.]?[0-9]*$')"
_INS = "regexp_matches(v, '^I[.]?S[.]?$')"
_NOT = "regexp_matches(v, '^N[.]?[AD][.]?$')"
_GOOD = f"({_NUM} OR {_INS} OR {_NOT})"
_QUALIFIER = f"CASE WHEN {_INS} THEN 'I' WHEN {_NOT} THEN 'N' WHEN {_NUM} AND v LIKE '<%' THEN '<' " \
             f"WHEN {_NUM} AND v LIKE '>%' THEN '>' ELSE NULL END"
_VALUE = f"CASE WHEN {_INS} OR {_NOT} THEN 0.0::DOUBLE " \
         f"WHEN {_NUM} THEN CAST(replace(replace(v, '<', ''), '>', '') AS DOUBLE) ELSE NULL END"


def sql_chem(cols=None, source: str = "orders") -> str:
    """CTEs ending in assay(amostra, analito, unidade, qualificador, valor)."""
    return (
        sql_cleaned(cols or chem_columns(), CHEM_ANALYTES, "chem", source=source)
        + f", assay AS (SELECT amostra, {_NAME} AS analito, {_UNIT} AS unidade, {_QUALIFIER} AS qualificador, "
          f"{_VALUE} AS valor FROM cleaned)"
    )


_DATE_OK = "regexp_matches({c}, '^[0-9]{{1,2}}/[0-9]{{1,2}}/[0-9]{{4}}$')"


def sql_date(c: str) -> str:
    return f"CASE WHEN {_DATE_OK.format(c=c)} THEN try_strptime({c}, '%d/%m/%Y') ELSE NULL END"


def sql_flag(c: str) -> str:
    return f"(lower(coalesce(nullif({c}, ''), 'não')) LIKE 'sim%' OR coalesce(nullif({c}, ''), 'não') LIKE '1%')"


SURVEY_SQL = (
    f"SELECT objectid, nullif(municipio, '') AS municipio, {sql_flag('duplicata')} AS duplicata, "
    f"{sql_date('data_de_analise')} AS data_de_analise, longitude, latitude, "
    "CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN longitude END AS x, "
    "CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN latitude END AS y, "
    "CASE WHEN longitude IS NOT NULL AND latitude IS NOT NULL THEN 4674 END AS srid FROM bronze"
)


# Spark side ---------------------------------------------------------------

def chem(spark, d, dirty=False):
    return derived(spark, d, "orders", chem_columns(dirty=dirty))


def counts(spark, d, dirty=False):
    return derived(spark, d, "orders", count_columns(dirty=dirty))


def weights(spark, d, dirty=False):
    return derived(spark, d, "orders", weight_columns(dirty=dirty))


def chem_text(spark, d, dirty=True):
    """Long rows with raw text: amostra, analito, raw."""
    return reshape.unpivot_assays(chem(spark, d, dirty), "objectid", CHEM_ANALYTES, val="raw")


def flat_point(df, name="geometry"):
    return df.select("*", f"{name}.x", f"{name}.y", f"{name}.srid").drop(name)


_DIRTY = f"WITH bronze AS ({select_text(chem_columns(dirty=True), 'orders')}), long_rows AS ({sql_long(CHEM_ANALYTES)}) "

# columns ------------------------------------------------------------------

_ODD = {"objectid": "o_orderkey", "Região ": "o_orderstatus", "Au (ppb)": "o_custkey", "SiO2 %": "o_totalprice",
        "Data de Análise": "o_orderpriority", "Ouro 0,5 mm": "o_custkey + 1", "µg/L": "o_custkey + 2"}


@query("c1_slugify_columns",
       "SELECT o_orderkey AS objectid, o_orderstatus AS regiao, o_custkey AS au_ppb, o_totalprice AS sio2, "
       "o_orderpriority AS data_de_analise, o_custkey + 1 AS ouro_05_mm, o_custkey + 2 AS ug_l FROM orders")
def _(spark, d):
    return columns.slugify_columns(derived(spark, d, "orders", _ODD), keep=("objectid",))


@query("c2_select_existing", "SELECT o_totalprice, o_orderkey FROM orders")
def _(spark, d):
    return columns.select_existing(table(spark, d, "orders"), ["o_totalprice", "absent", "o_orderkey"])


@query("c3_split_survey_assay",
       f"WITH bronze AS ({select_text(chem_columns(), 'orders')}) SELECT objectid, {', '.join(CHEM_ANALYTES)} FROM bronze")
def _(spark, d):
    return columns.split_survey_assay(chem(spark, d), SURVEY_COLUMNS, CHEM_SPEC.excluded, "objectid")[1]


@query("c3_survey_side",
       f"WITH bronze AS ({select_text(chem_columns(), 'orders')}) "
       "SELECT objectid, municipio, duplicata, data_de_analise, longitude, latitude FROM bronze")
def _(spark, d):
    return columns.split_survey_assay(chem(spark, d), SURVEY_COLUMNS, CHEM_SPEC.excluded, "objectid")[0]


@query("c4_rename", "SELECT o_orderkey AS fid, o_custkey AS cliente, o_totalprice FROM orders")
def _(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return columns.rename(df, {"o_orderkey": "fid", "o_custkey": "cliente", "absent": "x"})


@query("c5_humanize",
       f"WITH bronze AS ({select_text(count_columns(), 'orders')}) SELECT objectid, ouro_0_5_mm AS \"ouro (<0,5mm)\", "
       "ouro_0_5_1_mm AS \"ouro (0,5 a 1mm)\", ouro_1_mm AS \"ouro (>1mm)\" FROM bronze")
def _(spark, d):
    return columns.humanize(counts(spark, d).select("objectid", *COUNT_ANALYTES), COUNT_SPEC.labels)


@query("c8_generalize_types",
       "SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, p_brand FROM part")
def _(spark, d):
    df = table(spark, d, "part").selectExpr(
        "p_partkey", "cast(p_size as decimal(5,0)) as p_size", "cast(p_brand as varchar(20)) as p_brand")
    return columns.generalize_types(df)


@query("c9_infer_types",
       "SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, value AS v, event_type FROM events")
def _(spark, d):
    texts = table(spark, d, "events").selectExpr(
        "cast(event_id as string) event_id", "regexp_extract(props, '([0-9]+)', 1) k",
        "cast(value as string) v", "event_type")
    return columns.infer_types(texts)


@query("c9_infer_keeps_codes",
       "SELECT lpad(CAST(o_orderkey AS VARCHAR), 12, '0') AS code, '1000' || lpad(CAST(o_orderkey AS VARCHAR), 16, '0') AS long_code, "
       "o_custkey AS n, '1e400' AS huge, o_orderkey / 8.0 AS x FROM orders")
def _(spark, d):
    """Codes with leading zeros, numbers too long for a double and infinities stay text."""
    return columns.infer_types(table(spark, d, "orders").selectExpr(
        "lpad(cast(o_orderkey as string), 12, '0') as code", "concat('1000', lpad(cast(o_orderkey as string), 16, '0')) as long_code",
        "cast(o_custkey as string) as n", "'1e400' as huge", "cast(o_orderkey / 8.0D as string) as x"))


@query("c10_with_table_name", "SELECT 'orders' AS table_name, count(*) AS n FROM orders")
def _(spark, d):
    named = columns.with_table_name(scan.scan_dir(spark, d, "order"))
    return quality.value_counts(named, "table_name")


@query("c11_assign_drop",
       "SELECT l_orderkey, l_linenumber, l_extendedprice * (1 - l_discount) AS net FROM lineitem")
def _(spark, d):
    df = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount")
    wide = columns.assign(df, net=F.col("l_extendedprice") * (1 - F.col("l_discount")))
    return columns.drop(wide, "l_extendedprice", "l_discount")


@query("c12_key_columns", "SELECT l_linenumber, l_orderkey, l_quantity FROM lineitem")
def _(spark, d):
    df = table(spark, d, "lineitem").select("l_quantity", "l_orderkey", "l_linenumber")
    return columns.key_columns(df, ["l_orderkey", "l_linenumber"])


# scalar functions ---------------------------------------------------------

@query("f1_empty_to_null",
       f"WITH bronze AS ({select_text(chem_columns(dirty=True), 'orders')}) "
       "SELECT objectid, nullif(municipio, '') AS municipio, nullif(au_ppb, '') AS au_ppb FROM bronze")
def _(spark, d):
    return clean.empty_to_null_columns(chem(spark, d, True).select("objectid", "municipio", "au_ppb"))


@query("f2_strip_spaces", _DIRTY + f"SELECT amostra, analito, {sql_strip('raw')} AS v FROM long_rows")
def _(spark, d):
    return chem_text(spark, d).select("amostra", "analito", clean.strip_spaces(F.col("raw")).alias("v"))


@query("f2_strip_spaces_documents",
       "SELECT doc_id, regexp_replace(replace(text, chr(160), ''), '\\s+', '', 'g') AS v FROM documents")
def _(spark, d):
    return table(spark, d, "documents").select("doc_id", clean.strip_spaces(F.col("text")).alias("v"))


def _missing_query(kind, cols, analytes, frame):
    sql = (f"WITH bronze AS ({select_text(cols, 'orders')}), long_rows AS ({sql_long(analytes)}) "
           f"SELECT amostra, analito, CASE WHEN {sql_strip('raw')} IN ({_MISSING[kind]}) THEN NULL "
           f"ELSE {sql_strip('raw')} END AS v FROM long_rows")

    @query(f"f3_missing_to_null_{kind}", sql)
    def _(spark, d):
        long = reshape.unpivot_assays(frame(spark, d, True), "objectid", analytes, val="raw")
        return long.select("amostra", "analito",
                           clean.missing_to_null(clean.strip_spaces(F.col("raw")), kind).alias("v"))


_missing_query("chem", chem_columns(dirty=True), CHEM_ANALYTES, chem)
_missing_query("count", count_columns(dirty=True), COUNT_ANALYTES, counts)
_missing_query("weight", weight_columns(dirty=True), WEIGHT_ANALYTES, weights)


@query("f4_replace_chain", _DIRTY + f"SELECT amostra, analito, {sql_clean('raw', 'chem')} AS v FROM long_rows")
def _(spark, d):
    return chem_text(spark, d).select("amostra", "analito", clean.clean_value(F.col("raw"), "chem").alias("v"))


@query("f5_yes_flag",
       f"SELECT o_orderkey, {sql_flag('t')} AS flag FROM (SELECT o_orderkey, {FLAG_TEXT.format(k='o_orderkey')} AS t "
       "FROM orders) q")
def _(spark, d):
    text = F.expr(FLAG_TEXT.format(k="o_orderkey"))
    return table(spark, d, "orders").select(
        "o_orderkey", clean.yes_flag(clean.empty_to_null(text)).alias("flag"))


@query("f6_parse_date",
       f"SELECT o_orderkey, {sql_date('t')} AS dia FROM (SELECT o_orderkey, {DATE_TEXT.format(k='o_orderkey')} AS t "
       "FROM orders) q")
def _(spark, d):
    text = F.expr(DATE_TEXT.format(k="o_orderkey"))
    return table(spark, d, "orders").select("o_orderkey", clean.parse_date(text, "%d/%m/%Y").alias("dia"))


@query("f7_to_number_strict",
       "SELECT o_orderkey, coalesce(CAST(o_custkey % 100 AS DOUBLE) / 8, 0) * "
       "CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE 1 END AS valor FROM orders")
def _(spark, d):
    text = F.expr("CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(CAST(o_custkey % 100 AS DOUBLE) / 8 AS STRING) END")
    return table(spark, d, "orders").select("o_orderkey", clean.to_number_strict(text).alias("valor"))


_DECIMAL_SQL = "regexp_matches({c}, '^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$')"


@query("f8_to_number_try",
       f"WITH {sql_cleaned(weight_columns(dirty=True), WEIGHT_ANALYTES, 'weight')} SELECT amostra, analito, "
       f"CASE WHEN {_DECIMAL_SQL.format(c='v')} THEN TRY_CAST(v AS DOUBLE) END AS valor FROM cleaned")
def _(spark, d):
    long = jobs.long_values(weights(spark, d, True), WEIGHT_SPEC)
    return long.select("amostra", "analito", clean.to_number_try(F.col("_text")).alias("valor"))


@query("f9_fill",
       f"SELECT o_orderkey, coalesce({FLAG_TEXT.format(k='o_orderkey')}, 'não') AS flag FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select(
        "o_orderkey", clean.fill(F.expr(FLAG_TEXT.format(k="o_orderkey")), "não").alias("flag"))


@query("f10_strip_null_bytes", "SELECT doc_id, text, lang, n_chars FROM documents")
def _(spark, d):
    dirty = table(spark, d, "documents").selectExpr(
        "doc_id", "concat(chr(0), text, if(doc_id % 2 = 0, chr(0), '')) as text",
        "concat(substring(lang, 1, 1), chr(0), substring(lang, 2)) as lang", "n_chars")
    return clean.strip_null_bytes(dirty)


@query("f11_rgb_to_hex",
       "SELECT l_orderkey, l_linenumber, '#' || lpad(hex(l_partkey % 256), 2, '0') || lpad(hex(l_suppkey % 256), 2, '0') "
       "|| lpad(hex(CAST(l_linenumber * 16 AS BIGINT)), 2, '0') AS fill FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber",
        clean.rgb_to_hex(F.col("l_partkey") % 256, F.col("l_suppkey") % 256, F.col("l_linenumber") * 16).alias("fill"))


_BOOL_TEXT = "CASE o_orderkey % 6 WHEN 0 THEN ' TRUE ' WHEN 1 THEN 'False' WHEN 2 THEN 'true' WHEN 3 THEN ' false' " \
             "WHEN 4 THEN 'maybe' ELSE NULL END"


@query("f12_parse_bool_text",
       f"SELECT o_orderkey, CASE lower(trim({_BOOL_TEXT})) WHEN 'true' THEN true WHEN 'false' THEN false END AS b FROM orders")
def _(spark, d):
    return table(spark, d, "orders").select("o_orderkey", clean.parse_bool_text(F.expr(_BOOL_TEXT)).alias("b"))


@query("f13_as_category",
       f"WITH {sql_chem()}, dim(q, code) AS (VALUES ('<', 0), ('>', 1), ('I', 2), ('N', 3)) "
       "SELECT a.amostra, a.analito, a.unidade, CAST(dim.code AS INTEGER) AS code FROM assay a "
       "LEFT JOIN dim ON a.qualificador = dim.q")
def _(spark, d):
    assay = jobs.chem_assay_frame(chem(spark, d), CHEM_SPEC)
    return assay.select("amostra", "analito", "unidade", clean.category_code(F.col("qualificador")).alias("code"))


_GEOM_NAME = "CASE l_linenumber % 4 WHEN 0 THEN 'ST_MULTIPOLYGON' WHEN 1 THEN 'st_point' WHEN 2 THEN 'MultiLineString' " \
             "ELSE 'POLYGON' END"


@query("f14_normalize_geom_type",
       f"SELECT l_orderkey, l_linenumber, regexp_replace(regexp_replace(upper({_GEOM_NAME}), 'ST_', ''), 'MULTI', '') AS t "
       "FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", clean.normalize_geom_type(F.expr(_GEOM_NAME)).alias("t"))


# predicates ---------------------------------------------------------------

@query("w1_drop_missing", f"WITH {sql_cleaned(chem_columns(), CHEM_ANALYTES, 'chem')} SELECT amostra, analito, v FROM cleaned")
def _(spark, d):
    texts = chem_text(spark, d, False).select("amostra", "analito", clean.clean_value(F.col("raw"), "chem").alias("v"))
    return quality.drop_missing(texts, "v")


_UNITS = {"id": "p_partkey", "sigla": "'U' || CAST(p_partkey AS STRING)",
          "r": "CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE p_partkey % 256 END", "g": "CAST(p_size * 5 AS BIGINT)",
          "b": "CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE p_partkey * 3 % 256 END"}


def units(spark, d):
    return derived(spark, d, "part", _UNITS)


@query("w2_drop_any_null",
       f"SELECT * FROM ({select_text(_UNITS, 'part')}) u WHERE r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL")
def _(spark, d):
    return quality.drop_any_null(units(spark, d), ["r", "g", "b"])


@query("w3_matches",
       f"WITH {sql_cleaned(chem_columns(dirty=True), CHEM_ANALYTES, 'chem')} "
       f"SELECT amostra, analito, v, {_NUM} AS is_number, {_INS} AS is_insufficient, {_NOT} AS is_not_analysed FROM cleaned")
def _(spark, d):
    v = F.col("_text")
    return jobs.long_values(chem(spark, d, True), CHEM_SPEC).select(
        "amostra", "analito", v.alias("v"),
        clean.matches(v, clean.CHEM_NUMBER).alias("is_number"),
        clean.matches(v, clean.CHEM_INSUFFICIENT).alias("is_insufficient"),
        clean.matches(v, clean.CHEM_NOT_ANALYSED).alias("is_not_analysed"))


@query("w4_contains_null_byte", "SELECT doc_id, doc_id % 3 = 0 AS hit FROM documents")
def _(spark, d):
    text = F.expr("if(doc_id % 3 = 0, concat(text, chr(0)), text)")
    return table(spark, d, "documents").select("doc_id", clean.contains_null_byte(text).alias("hit"))


@query("w5_keep_valid",
       f"WITH {sql_cleaned(chem_columns(dirty=True), CHEM_ANALYTES, 'chem')} SELECT amostra, analito, v FROM cleaned WHERE {_GOOD}")
def _(spark, d):
    long = jobs.long_values(chem(spark, d, True), CHEM_SPEC).withColumnRenamed("_text", "v")
    return quality.keep_valid(long, clean.chem_valid(F.col("v")))


@query("w5_keep_invalid",
       f"WITH {sql_cleaned(chem_columns(dirty=True), CHEM_ANALYTES, 'chem')} SELECT amostra, analito, v FROM cleaned WHERE NOT {_GOOD}")
def _(spark, d):
    long = jobs.long_values(chem(spark, d, True), CHEM_SPEC).withColumnRenamed("_text", "v")
    return quality.keep_invalid(long, clean.chem_valid(F.col("v")))


# reshape ------------------------------------------------------------------

@query("r1_unpivot_assays", _DIRTY + "SELECT amostra, analito, raw AS valor FROM long_rows")
def _(spark, d):
    return reshape.unpivot_assays(chem(spark, d, True), "objectid", CHEM_ANALYTES)


_SMALL = {"tiny_ppb": "o_totalprice / 1000000000", "small_ppm": "o_totalprice / 1000", "huge_pct": "o_totalprice * 100000000000000000000"}


@query("r1_unpivot_small_numbers", " UNION ALL ".join(
    f"SELECT o_orderkey AS amostra, '{n}' AS analito, o_totalprice {e.removeprefix('o_totalprice ')[0]} CAST({e.split()[-1]} AS DOUBLE) AS valor FROM orders"
    for n, e in _SMALL.items()))
def _(spark, d):
    """Floating cells of any size keep every digit on the way through text, without an exponent."""
    cells = table(spark, d, "orders").selectExpr(
        "o_orderkey as objectid", *[f"{e.rsplit(' ', 1)[0]} cast({e.split()[-1]} as double) as {n}" for n, e in _SMALL.items()])
    text = F.col("valor")
    plain = F.when(~text.contains("E"), clean.to_number_try(text))
    return reshape.unpivot_assays(cells, "objectid", list(_SMALL)).withColumn("valor", plain)


@query("r2_split_analyte_unit",
       f"WITH {sql_cleaned(chem_columns(), CHEM_ANALYTES, 'chem')} SELECT amostra, {_NAME} AS analito, {_UNIT} AS unidade, v FROM cleaned")
def _(spark, d):
    long = jobs.long_values(chem(spark, d), CHEM_SPEC).withColumnRenamed("_text", "v")
    return reshape.split_analyte_unit(long)


@query("r3_decompose_value",
       f"WITH {sql_cleaned(chem_columns(dirty=True), CHEM_ANALYTES, 'chem')} "
       f"SELECT amostra, analito, {_QUALIFIER} AS qualificador, {_VALUE} AS valor FROM cleaned")
def _(spark, d):
    return reshape.decompose_value(jobs.long_values(chem(spark, d, True), CHEM_SPEC), "_text")


_PIVOT = ", ".join(
    f"max(CASE WHEN concat_ws('_', analito, unidade) = '{a}' THEN valor END) AS {a}" for a in CHEM_ANALYTES)


@query("r5_pivot_assays", f"WITH {sql_chem()} SELECT amostra, {_PIVOT} FROM assay GROUP BY amostra")
def _(spark, d):
    assay = jobs.chem_assay_frame(chem(spark, d), CHEM_SPEC)
    return reshape.pivot_assays(assay, CHEM_ANALYTES, unit="unidade")


@query("r6_survey_view", f"WITH bronze AS ({select_text(chem_columns(), 'orders')}) {SURVEY_SQL}")
def _(spark, d):
    return flat_point(reshape.survey_view(jobs.survey_frame(chem(spark, d), CHEM_SPEC)))


@query("r6_assay_view", f"WITH {sql_chem()} SELECT amostra, analito, valor FROM assay")
def _(spark, d):
    return reshape.assay_view(jobs.chem_assay_frame(chem(spark, d), CHEM_SPEC), ["amostra", "analito", "valor"])


# joins --------------------------------------------------------------------

@query("e1_join_aligned",
       f"WITH {sql_cleaned(chem_columns(), CHEM_ANALYTES, 'chem')} SELECT amostra, analito, v, {_UNIT} AS unidade FROM cleaned")
def _(spark, d):
    long = jobs.long_values(chem(spark, d), CHEM_SPEC).withColumnRenamed("_text", "v")
    parts = long.select("amostra", "analito", reshape.analyte_unit(F.col("analito")).alias("unidade"))
    return joins.join_aligned(long, parts, ["amostra", "analito"])


@query("e2_join_extracted_parts",
       f"WITH {sql_cleaned(chem_columns(dirty=True), CHEM_ANALYTES, 'chem')} "
       f"SELECT amostra, analito, v, {_QUALIFIER} AS qualificador, {_VALUE} AS valor FROM cleaned")
def _(spark, d):
    long = jobs.long_values(chem(spark, d, True), CHEM_SPEC).withColumnRenamed("_text", "v")
    parts = reshape.decompose_value(quality.keep_valid(long, clean.chem_valid(F.col("v"))), "v")
    return joins.join_aligned(long, parts, ["amostra", "analito"])


_PIVOT_JOIN = (
    f"WITH {sql_chem()}, survey AS ({SURVEY_SQL}), pivoted AS (SELECT amostra, {_PIVOT} FROM assay GROUP BY amostra) "
    f"SELECT survey.*, {', '.join(CHEM_ANALYTES)} FROM survey LEFT JOIN pivoted ON survey.objectid = pivoted.amostra"
)


@query("e3_survey_pivot_join", _PIVOT_JOIN)
def _(spark, d):
    bronze = chem(spark, d)
    pivoted = reshape.pivot_assays(jobs.chem_assay_frame(bronze, CHEM_SPEC), CHEM_ANALYTES, unit="unidade")
    return flat_point(joins.survey_pivot_join(jobs.survey_frame(bronze, CHEM_SPEC), pivoted))


@query("e4_orphan_assays",
       "SELECT l_orderkey AS amostra, l_linenumber, l_quantity FROM lineitem "
       "WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'F')")
def _(spark, d):
    survey = table(spark, d, "orders").where("o_orderstatus <> 'F'").withColumnRenamed("o_orderkey", "objectid")
    assay = table(spark, d, "lineitem").selectExpr("l_orderkey as amostra", "l_linenumber", "l_quantity")
    return joins.orphan_assays(survey, assay)


@query("e5_quarantine_rows",
       f"WITH {sql_cleaned(chem_columns(dirty=True), CHEM_ANALYTES, 'chem')} "
       f"SELECT objectid, {', '.join(CHEM_ANALYTES)} FROM bronze WHERE objectid IN (SELECT amostra FROM cleaned WHERE NOT {_GOOD})")
def _(spark, d):
    bronze = chem(spark, d, True)
    return joins.quarantine_rows(bronze, jobs.bad_values(bronze, CHEM_SPEC), "objectid", "amostra") \
        .select("objectid", *CHEM_ANALYTES)


@query("e6_quarantine_dates",
       f"WITH bronze AS ({select_text(chem_columns(), 'orders')}) SELECT objectid, data_de_analise AS raw FROM bronze "
       f"WHERE data_de_analise <> '' AND ({sql_date('data_de_analise')}) IS NULL")
def _(spark, d):
    raw = clean.empty_to_null(F.col("data_de_analise"))
    df = chem(spark, d).select("objectid", raw.alias("raw"), clean.parse_date(raw).alias("parsed"))
    return joins.quarantine_dates(df, "raw", "parsed").drop("parsed")


# aggregates ---------------------------------------------------------------

@query("a1_count_rows", "SELECT count(*) AS n FROM lineitem")
def _(spark, d):
    return quality.count_rows(table(spark, d, "lineitem"))


@query("a2_distinct_values", "SELECT DISTINCT l_suppkey FROM lineitem")
def _(spark, d):
    return quality.distinct_values(table(spark, d, "lineitem"), "l_suppkey")


@query("a3_max_of", "SELECT max(l_linenumber) AS max_l_linenumber FROM lineitem")
def _(spark, d):
    return quality.max_of(table(spark, d, "lineitem"), "l_linenumber")


@query("a4_any_all_true",
       "SELECT coalesce(bool_or(l_quantity > 49), false) AS any_big, coalesce(bool_and(l_quantity > 0), true) AS all_positive "
       "FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").agg(
        quality.any_true(F.col("l_quantity") > 49).alias("any_big"),
        quality.all_true(F.col("l_quantity") > 0).alias("all_positive"))


@query("a5_value_counts", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def _(spark, d):
    return quality.value_counts(table(spark, d, "events"), "event_type")


_TYPES = {"objectid": "bigint", "longitude": "double", "latitude": "double"}


@query("a6_frame_profile",
       f"WITH bronze AS ({select_text(chem_columns(), 'orders')}) "
       + " UNION ALL ".join(
           f"SELECT '{c}' AS column_name, count({c}) AS non_null, '{_TYPES.get(c, 'string')}' AS data_type FROM bronze"
           for c in chem_columns()))
def _(spark, d):
    return quality.frame_profile(chem(spark, d))


@query("a7_distinct_keys",
       f"WITH {sql_cleaned(chem_columns(dirty=True), CHEM_ANALYTES, 'chem')} SELECT DISTINCT amostra FROM cleaned WHERE NOT {_GOOD}")
def _(spark, d):
    return quality.distinct_keys(jobs.bad_values(chem(spark, d, True), CHEM_SPEC), "amostra")


@query("u1_concat_parts",
       "SELECT o_orderkey AS k, o_custkey AS c, NULL AS s FROM orders UNION ALL "
       "SELECT c_custkey AS k, NULL AS c, c_mktsegment AS s FROM customer UNION ALL "
       "SELECT p_partkey AS k, NULL AS c, p_brand AS s FROM part")
def _(spark, d):
    return reshape.concat_parts([
        table(spark, d, "orders").selectExpr("o_orderkey as k", "o_custkey as c"),
        table(spark, d, "customer").selectExpr("c_custkey as k", "c_mktsegment as s"),
        table(spark, d, "part").selectExpr("p_brand as s", "p_partkey as k"),
    ])


@query("t2_violation_sample",
       f"WITH {sql_cleaned(chem_columns(dirty=True), CHEM_ANALYTES, 'chem')} SELECT amostra, analito, v AS value_text "
       f"FROM cleaned WHERE NOT {_GOOD} ORDER BY amostra, analito LIMIT 5")
def _(spark, d):
    return quality.violation_sample(jobs.bad_values(chem(spark, d, True), CHEM_SPEC), ["amostra", "analito"])


# gates --------------------------------------------------------------------

@query("q1_not_empty", "SELECT CAST(0 AS BIGINT) AS n FROM (SELECT count(*) AS c FROM lineitem WHERE l_quantity > 1000) q WHERE c = 0")
def _(spark, d):
    return quality.not_empty(table(spark, d, "lineitem").where("l_quantity > 1000"))


@query("q2_unique_key", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def _(spark, d):
    return quality.unique_key(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("q2_unique_assay_key",
       f"WITH {sql_chem()} SELECT amostra, analito, unidade, count(*) AS n FROM assay GROUP BY ALL HAVING count(*) > 1")
def _(spark, d):
    assay = jobs.chem_assay_frame(chem(spark, d), CHEM_SPEC)
    return quality.unique_key(assay, ["amostra", "analito", "unidade"])


@query("q3_chem_grammar",
       f"WITH {sql_cleaned(chem_columns(dirty=True), CHEM_ANALYTES, 'chem')} SELECT amostra, analito, v AS value_text FROM cleaned WHERE NOT {_GOOD}")
def _(spark, d):
    return jobs.bad_values(chem(spark, d, True), CHEM_SPEC)


@query("q4_integer_grammar",
       f"WITH {sql_cleaned(count_columns(dirty=True), COUNT_ANALYTES, 'count', COUNT_SPEC.labels)} "
       "SELECT amostra, analito, v AS value_text FROM cleaned WHERE NOT regexp_matches(v, '^[0-9]+$')")
def _(spark, d):
    return jobs.bad_values(counts(spark, d, True), COUNT_SPEC)


@query("q5_castable_number",
       f"WITH {sql_cleaned(weight_columns(dirty=True), WEIGHT_ANALYTES, 'weight')} "
       f"SELECT amostra, analito, v AS value_text FROM cleaned WHERE NOT {_DECIMAL_SQL.format(c='v')}")
def _(spark, d):
    return jobs.bad_values(weights(spark, d, True), WEIGHT_SPEC)


@query("q7_geometry_present",
       f"WITH bronze AS ({select_text(chem_columns(), 'orders')}), survey AS ({SURVEY_SQL}) "
       "SELECT count(*) FILTER (WHERE x IS NULL) AS n_null, CAST(0 AS BIGINT) AS n_empty FROM survey")
def _(spark, d):
    survey = jobs.survey_frame(chem(spark, d), CHEM_SPEC)
    return quality.geometry_present(survey, F.col("geometry").isNull(), F.lit(False))


# jobs ---------------------------------------------------------------------

@query("j1_bronze",
       f"WITH bronze AS ({select_text(chem_columns(), 'orders')}) SELECT * FROM bronze")
def _(spark, d):
    path = jobs.run_bronze(chem(spark, d), CHEM_SPEC, new_run_dir(spark, "bronze"))
    return scan.read_layer_parquet(spark, path)


@query("j2_survey", f"WITH bronze AS ({select_text(chem_columns(), 'orders')}) {SURVEY_SQL}")
def _(spark, d):
    return flat_point(jobs.survey_frame(chem(spark, d), CHEM_SPEC))


@query("g1_points_from_xy",
       f"WITH bronze AS ({select_text(chem_columns(), 'orders')}), survey AS ({SURVEY_SQL}) SELECT objectid, x, y, srid FROM survey")
def _(spark, d):
    from strata.operators import geometry
    df = chem(spark, d).select("objectid", "longitude", "latitude")
    return flat_point(geometry.points_from_xy(df, "longitude", "latitude", 4674)).drop("longitude", "latitude")


@query("j3_chem_assay", f"WITH {sql_chem()} SELECT amostra, analito, unidade, qualificador, valor FROM assay")
def _(spark, d):
    return jobs.chem_assay_frame(chem(spark, d), CHEM_SPEC)


@query("j4_count_assay",
       f"WITH {sql_cleaned(count_columns(), COUNT_ANALYTES, 'count', COUNT_SPEC.labels)} "
       "SELECT amostra, analito, CAST(v AS BIGINT) AS quantidade FROM cleaned")
def _(spark, d):
    return jobs.count_assay_frame(counts(spark, d), COUNT_SPEC)


@query("j5_weight_assay",
       f"WITH {sql_cleaned(weight_columns(), WEIGHT_ANALYTES, 'weight')} "
       "SELECT amostra, analito, CAST(v AS DOUBLE) AS valor FROM cleaned")
def _(spark, d):
    return jobs.weight_assay_frame(weights(spark, d), WEIGHT_SPEC)


@query("j6_publish_pivot_join", _PIVOT_JOIN)
def _(spark, d):
    """Whole run: bronze, survey, assay, publication, views; returns the last view."""
    paths = jobs.run_lab(chem(spark, d), CHEM_SPEC, new_run_dir(spark, "lab"))
    return flat_point(spark.read.parquet(paths["chem_pivot_join"]))


@query("j6_survey_pivot_frame", _PIVOT_JOIN)
def _(spark, d):
    return flat_point(jobs.survey_pivot_frame(chem(spark, d), CHEM_SPEC))


_MEDIA = {"solo": ("orders", "o_orderkey"), "rocha": ("customer", "c_custkey"), "agua": ("part", "p_partkey")}


@query("j11_all_assays", " UNION ALL ".join(
    f"SELECT *, '{m}' AS meio FROM (WITH {sql_chem(chem_columns(k), t)} SELECT * FROM assay) q"
    for m, (t, k) in _MEDIA.items()))
def _(spark, d):
    return jobs.all_assays({
        m: (derived(spark, d, t, chem_columns(k)), CHEM_SPEC) for m, (t, k) in _MEDIA.items()
    })


_ALL_MEDIA = {m: _MEDIA[("solo", "rocha", "agua")[k % 3]] for k, m in enumerate(CHEMICAL_MEDIA)}


@query("j11_all_media", " UNION ALL ".join(
    f"SELECT *, '{m}' AS meio FROM (WITH {sql_chem(chem_columns(k), t)} SELECT * FROM assay) q"
    for m, (t, k) in _ALL_MEDIA.items()))
def _(spark, d):
    """The assays of all seven media in one table on disk."""
    path = jobs.run_all_assays({
        m: (derived(spark, d, t, chem_columns(k)), CHEM_SPEC) for m, (t, k) in _ALL_MEDIA.items()
    }, new_run_dir(spark, "media"))
    return spark.read.parquet(path)


@query("c3_from_target_table", f"WITH bronze AS ({select_text(chem_columns(), 'orders')}) {SURVEY_SQL}")
def _(spark, d):
    """Survey columns read off the target table of a spec that names none."""
    from uuid import uuid4
    name = f"c3_{uuid4().hex[:12]}"
    bronze = chem(spark, d)
    sinks.clone_schema(jobs.survey_frame(bronze, CHEM_SPEC).drop("geometry"), name, path=new_run_dir(spark, "c3"))
    spec = jobs.with_target_columns(spark, dataclasses.replace(CHEM_SPEC, survey_columns=()), name)
    return flat_point(jobs.survey_frame(bronze, spec))


# styles -------------------------------------------------------------------

_RULES_SQL = (
    "SELECT sigla, 'Unidade ' || sigla AS title, '#' || lpad(hex(r), 2, '0') || lpad(hex(g), 2, '0') || "
    "lpad(hex(b), 2, '0') AS fill, '#FFFFFF' AS stroke, 0 AS stroke_width "
    f"FROM ({select_text(_UNITS, 'part')}) u WHERE r IS NOT NULL AND g IS NOT NULL AND b IS NOT NULL"
)


@query("g12_style_rules", _RULES_SQL)
def _(spark, d):
    from strata.operators import styles
    return styles.style_rules(scan.scan_sql(spark, "SELECT id, sigla, r, g, b FROM {units}", units=units(spark, d)))


def _feature_rows(spark, d):
    return table(spark, d, "lineitem").selectExpr(
        "l_orderkey", "l_linenumber", "'U' || cast(l_partkey as string) as sigla")


_STYLED = (
    f"WITH rules AS ({_RULES_SQL}), f AS (SELECT l_orderkey, l_linenumber, 'U' || CAST(l_partkey AS STRING) AS sigla FROM lineitem) "
    "SELECT f.l_orderkey, f.l_linenumber, f.sigla, title, fill, stroke, stroke_width FROM f LEFT JOIN rules ON f.sigla = rules.sigla"
)


@query("e7_style_features", _STYLED)
def _(spark, d):
    from strata.operators import styles
    return joins.style_features(_feature_rows(spark, d), styles.style_rules(units(spark, d)))


@query("j10_style_table", _STYLED)
def _(spark, d):
    rows = scan.scan_sql(spark, "SELECT id, sigla, r, g, b FROM {units}", units=units(spark, d))
    return jobs.style_table(rows, _feature_rows(spark, d))
