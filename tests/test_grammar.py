"""Value grammars, flags, dates and names: one row per case."""

import datetime

import pytest
from pyspark.sql import functions as F

from strata.functions import clean
from strata.operators import columns, reshape
from strata.plans import jobs
from strata.spec import LabSpec, lab_catalogue, feature_specs

NBSP = " "
DROPPED = "dropped"
INVALID = "invalid"

CHEM = {
    "5": (None, 5.0), " 5 ": (None, 5.0), "5.": (None, 5.0), "0": (None, 0.0), "5,3": (None, 5.3),
    "5 ,3": (None, 5.3), f"5{NBSP},3": (None, 5.3), "<0,5": ("<", 0.5), "<.5": ("<", 0.5), "-0.5": ("<", 0.5),
    "-,5": ("<", 0.5), ">10000": (">", 10000.0),
    **{v: ("I", 0.0) for v in ("IS", "I.S", "IS.", "I.S.", "I,S,")},
    **{v: ("N", 0.0) for v in ("NA", "N.A.", "ND", "N.D", "N,D,")},
    **{v: DROPPED for v in ("", "  ", "NULL", "null", "None", "NaN", "nan", "-NaN", "-nan", "n/a", "#N/A", "#NA",
                            "1.#IND", "1.#QNAN", "-1.#IND", "-1.#QNAN", None)},
    **{v: INVALID for v in (".5", "N/A", "<NA>", "<Null>", "#N/A N/A", "nd", "n.a.", "is", "1-2", "1e-05", "<<5",
                            "=5", "1.234,5", "abc", "٣")},
}
COUNT = {
    "3": 3, " 1 2 ": 12,
    **{v: DROPPED for v in ("0", "ND", "N.A.", "NA", "N/A", "<NA>", "", "NULL", "n/a", "-NaN", None)},
    **{v: INVALID for v in ("N.D.", "1,5", "<5", "-1", "IS")},
}
WEIGHT = {
    "1,5": 1.5, "1.5": 1.5, "-5": -5.0, "1e5": 100000.0, ".5": 0.5, "0": 0.0, "inf": float("inf"),
    **{v: DROPPED for v in ("N.A.", "<Null>", "<NA>", "NA", "N/A", "", "nan", "null", None)},
    **{v: INVALID for v in ("ND", "<5", "NAN", "1d", "5f", "abc")},
}


def run(spark, table, kind, spec):
    rows = list(enumerate(table))
    bronze = spark.createDataFrame(rows, "objectid long, au_ppb string")
    out = {r[0]: r for r in jobs.assay_frame(bronze, spec).collect()}
    bad = {r[0] for r in jobs.bad_values(bronze, spec).collect()}
    return {raw: (out.get(i), i in bad) for i, raw in rows}


def spec_of(kind):
    catalogue = lab_catalogue()
    return {"chem": catalogue["agua"], "count": catalogue["contagem_pintas_au"],
            "weight": catalogue["mineralometria"]}[kind]


@pytest.mark.parametrize("kind,table", [("chem", CHEM), ("count", COUNT), ("weight", WEIGHT)])
def test_value_grammar(spark, kind, table):
    results = run(spark, table, kind, spec_of(kind))
    for raw, expected in table.items():
        row, bad = results[raw]
        if expected is DROPPED:
            assert row is None and not bad, raw
        elif expected is INVALID:
            assert bad and row[-1] is None, raw
        elif kind == "chem":
            assert not bad and (row.qualificador, row.valor) == expected, raw
            assert (row.analito, row.unidade) == ("au", "ppb")
        else:
            assert not bad and row[-1] == expected, raw


def one(spark, value, expr, dtype="string"):
    return spark.createDataFrame([(value,)], f"v {dtype}").select(expr(F.col("v"))).first()[0]


def test_numbers_survive_the_unpivot(spark):
    df = spark.createDataFrame([(1, 2.5, 12345678.0, 0.00001)], "objectid long, a_x double, b_x double, c_x double")
    got = {r.analito: r.valor for r in jobs.chem_assay_frame(df, spec_of("chem")).collect()}
    assert got == {"a": 2.5, "b": 12345678.0, "c": 0.00001}


@pytest.mark.parametrize("raw,flag", [("Sim", True), ("SIM", True), ("1", True), ("10", True), ("simples", True),
                                      ("não", False), ("x1", False), (None, False), ("", False)])
def test_yes_flag(spark, raw, flag):
    assert one(spark, raw, lambda c: clean.yes_flag(clean.empty_to_null(c))) is flag


FIRST = datetime.datetime(2020, 2, 1)


@pytest.mark.parametrize("raw,day", [("01/02/2020", FIRST), ("1/2/2020", FIRST), ("31/02/2020", None),
                                     ("01/02/20", None), ("2020-01-02", None), (" 01/02/2020", None),
                                     ("01/02/2020 10:00", None), (None, None)])
def test_parse_date(spark, raw, day):
    assert one(spark, raw, clean.parse_date) == day


def test_parse_date_in_a_zone_that_skips_midnight(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        assert one(spark, "4/11/2018", clean.parse_date) == datetime.datetime(2018, 11, 4)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_parse_date_with_time(spark):
    got = one(spark, "2/3/2021 4:05", lambda c: clean.parse_date(c, "%d/%m/%Y %H:%M"))
    assert got == datetime.datetime(2021, 3, 2, 4, 5)


def test_to_number_strict_raises(spark):
    assert one(spark, None, clean.to_number_strict) == 0.0
    with pytest.raises(Exception, match="not a number"):
        one(spark, "abc", clean.to_number_strict)


@pytest.mark.parametrize("raw,value", [(" True ", True), ("FALSE", False), ("yes", None), (None, None)])
def test_parse_bool_text(spark, raw, value):
    assert one(spark, raw, clean.parse_bool_text) is value


def test_rgb_to_hex(spark):
    assert spark.range(1).select(clean.rgb_to_hex(F.lit(255), F.lit(10), F.lit(0))).first()[0] == "#FF0A00"


@pytest.mark.parametrize("raw,name", [("Região", "regiao"), ("Au (ppb)", "au_ppb"), ("SiO2 %", "sio2"),
                                      ("0,5 mm", "05_mm"), ("µg/L", "ug_l"), ("__a--b__", "a_b"),
                                      ("C'est déjà", "c_est_deja"), ("A&amp;B", "a_b")])
def test_slug(raw, name):
    assert columns.slug(raw) == name
    assert columns.slug(name) == name


def test_slug_collision_is_an_error(spark):
    df = spark.createDataFrame([(1, 2)], ["Região", "regiao"])
    with pytest.raises(ValueError, match="collide"):
        columns.slugify_columns(df)


@pytest.mark.parametrize("name,parts", [("au_ppb", ("au", "ppb")), ("au_ug_l", ("au_ug", "l")), ("sio2", ("sio2", None))])
def test_analyte_and_unit(spark, name, parts):
    df = spark.createDataFrame([(name,)], "analito string")
    assert tuple(reshape.split_analyte_unit(df).first()) == parts


def test_compound_unit(spark):
    df = spark.createDataFrame([("au_ug_l",), ("cu_l",)], "analito string")
    got = [tuple(r) for r in reshape.split_analyte_unit(df, units=["ug_l"]).collect()]
    assert got == [("au", "ug_l"), ("cu", "l")]


def test_unpivot_then_pivot_gives_the_numbers_back(spark):
    df = spark.createDataFrame([(1, "5", None), (2, None, "7,5"), (3, "1", "<2")], "objectid long, a_x string, b string")
    assay = jobs.chem_assay_frame(df, spec_of("chem"))
    wide = reshape.pivot_assays(assay, ["a_x", "b"], unit="unidade").orderBy("amostra").collect()
    assert [tuple(r) for r in wide] == [(1, 5.0, None), (2, None, 7.5), (3, 1.0, 2.0)]


def test_specs_check_their_arguments():
    with pytest.raises(ValueError, match="index columns"):
        LabSpec(name="x", kind="chem", source="s", survey_table="a", assay_table="b")
    with pytest.raises(ValueError, match="unknown kind"):
        LabSpec(name="x", kind="other", source="s", survey_table="a", assay_table="b")
    assert LabSpec(name="x", kind="weight", source="s", survey_table="a", assay_table="b",
                   value_columns="valor").value_columns == ("valor",)
    catalogue = lab_catalogue("bruto", "mapas", "lab_")
    assert len(catalogue) == 9
    assert catalogue["solo"].source == "bruto.resultados_analiticos_solo"
    assert catalogue["solo"].views == (
        "mapas.lab_solo_amostras", "mapas.lab_solo_analises_quimicas", "mapas.lab_solo_pivot_join")
    assert feature_specs(["a.b_layer"], "gold")["a.b_layer"].target == "gold.a_b_layer"
