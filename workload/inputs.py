"""Inputs derived from the given tables.

The derivations are text that Spark SQL and the checking SQL engine both read, so
the two sides start from the same rows. Every derivation keeps all rows of its table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from strata.spec import LabSpec

from .scratch import new_run_dir

NAN_HEX = "000000000000F87F"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def case(key: str, values: list[str]) -> str:
    """CASE over a key's remainder: every row gets one of the values."""
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {arms} END"


def _text(v: str) -> str:
    return f"CAST({v} AS STRING)"


def chem_values(k: str) -> list[str]:
    return [
        _text(f"{k} % 977"), f"' ' || {_text(f'{k} % 50')} || ' '",
        f"{_text(f'{k} % 31')} || ',' || {_text(f'{k} % 10')}", f"'<0,' || {_text(f'{k} % 10')}",
        f"'-' || {_text(f'{k} % 100')}", "'-,5'", f"'>' || {_text(f'({k} % 9) * 10000')}", "'<.5'", "'5.'", "'0'",
        "'IS'", "'I.S'", "'I,S,'", "'NA'", "'N.A.'", "'N.D'", "'N,D,'",
        "''", "'  '", "'NULL'", "'null'", "'None'", "'NaN'", "'-NaN'", "'n/a'", "'#N/A'", "'-1.#IND'",
        f"chr(160) || {_text(f'{k} % 7')} || chr(160) || ',5'", "NULL",
    ]


CHEM_BAD = ["'.5'", "'N/A'", "'<NA>'", "'nd'", "'1-2'", "'1e-05'", "'<<5'", "'abc'"]


def count_values(k: str) -> list[str]:
    return [_text(f"{k} % 40 + 1"), f"' ' || {_text(f'{k} % 9 + 1')} || ' 2 '", "'0'", "'ND'", "'N.A.'", "'NA'",
            "'N/A'", "'<NA>'", "''", "NULL", "'NaN'", _text(f"{k} % 300 + 7")]


COUNT_BAD = ["'N.D.'", "'1,5'", "'<5'", "'-1'", "'IS'"]


def weight_values(k: str) -> list[str]:
    return [f"{_text(f'{k} % 40')} || ',5'", f"{_text(f'{k} % 77')} || '.25'", "'-5'", "'1e5'", "'.5'", "'0'",
            "'N.A.'", "'<Null>'", "'<NA>'", "''", "NULL", "'nan'"]


WEIGHT_BAD = ["'ND'", "'<5'", "'NAN'", "'1d'", "'5f'", "'abc'"]

DATE_TEXT = (
    "CASE {k} % 7 WHEN 0 THEN '31/02/2020' WHEN 1 THEN '2020-01-02' WHEN 2 THEN ' 01/02/2020' "
    "WHEN 3 THEN '' WHEN 4 THEN '01/02/20' "
    "ELSE CAST({k} % 28 + 1 AS STRING) || '/' || CAST({k} % 12 + 1 AS STRING) || '/' || "
    "CAST(1990 + {k} % 30 AS STRING) END"
)
FLAG_TEXT = "CASE {k} % 9 WHEN 0 THEN 'Sim' WHEN 1 THEN 'SIM' WHEN 2 THEN '1' WHEN 3 THEN '10' " \
            "WHEN 4 THEN 'simples' WHEN 5 THEN 'não' WHEN 6 THEN 'x1' WHEN 7 THEN NULL ELSE '' END"


def bronze_columns(k: str, analytes: dict[str, str]) -> dict[str, str]:
    """A wide sample table keyed by ``k``: attributes, coordinates, analytes."""
    return {
        "objectid": k,
        "longitude": f"CASE WHEN {k} % 89 = 0 THEN NULL ELSE CAST(({k} * 37) % 2880 AS DOUBLE) / 16 - 90 END",
        "latitude": f"CASE WHEN {k} % 97 = 0 THEN NULL ELSE CAST(({k} * 53) % 1440 AS DOUBLE) / 16 - 45 END",
        "data_de_analise": DATE_TEXT.format(k=k),
        "duplicata": FLAG_TEXT.format(k=k),
        "municipio": f"CASE WHEN {k} % 5 = 0 THEN '' ELSE 'M' || CAST({k} % 50 AS STRING) END",
        "lote": f"'L' || CAST({k} % 11 AS STRING)",
        "metodo": "'ICP'",
        **analytes,
    }


CHEM_ANALYTES = ["au_ppb", "cu_ppm", "sio2_pct", "au_ug_l", "sio2"]
COUNT_ANALYTES = ["ouro_0_5_mm", "ouro_0_5_1_mm", "ouro_1_mm"]
WEIGHT_ANALYTES = ["magnetita", "ilmenita_g"]
SURVEY_COLUMNS = ("objectid", "municipio", "duplicata", "data_de_analise", "longitude", "latitude", "geometry")


def _analytes(names: list[str], k: str, values, bad: list[str] | None) -> dict[str, str]:
    out = {}
    for i, name in enumerate(names):
        kk = f"({k} * 7 + {i * 3})"
        out[name] = case(kk, values(k) + (bad or []))
    return out


def chem_columns(k: str = "o_orderkey", dirty: bool = False) -> dict[str, str]:
    return bronze_columns(k, _analytes(CHEM_ANALYTES, k, chem_values, CHEM_BAD if dirty else None))


def count_columns(k: str = "o_orderkey", dirty: bool = False) -> dict[str, str]:
    return bronze_columns(k, _analytes(COUNT_ANALYTES, k, count_values, COUNT_BAD if dirty else None))


def weight_columns(k: str = "o_orderkey", dirty: bool = False) -> dict[str, str]:
    return bronze_columns(k, _analytes(WEIGHT_ANALYTES, k, weight_values, WEIGHT_BAD if dirty else None))


def select_text(cols: dict[str, str], source: str) -> str:
    return f"SELECT {', '.join(f'{e} AS {n}' for n, e in cols.items())} FROM {source}"


def derived(spark: SparkSession, sf_dir: str, source: str, cols: dict[str, str]) -> DataFrame:
    return table(spark, sf_dir, source).selectExpr(*[f"{e} AS `{n}`" for n, e in cols.items()])


CHEM_SPEC = LabSpec(
    name="chem", kind="chem", source="orders", survey_table="chem_amostras", assay_table="chem_analises",
    survey_columns=SURVEY_COLUMNS, index_columns=("amostra", "analito", "unidade"),
    value_columns=("qualificador", "valor"),
    views=("views.chem_amostras", "views.chem_analises", "chem_pivot_join"),
)
COUNT_SPEC = LabSpec(
    name="count", kind="count", source="orders", survey_table="count_amostras", assay_table="count_analises",
    survey_columns=SURVEY_COLUMNS, value_columns="quantidade",
    labels={"ouro_0_5_mm": "ouro (<0,5mm)", "ouro_0_5_1_mm": "ouro (0,5 a 1mm)", "ouro_1_mm": "ouro (>1mm)"},
)
WEIGHT_SPEC = LabSpec(
    name="weight", kind="weight", source="orders", survey_table="weight_amostras", assay_table="weight_analises",
    survey_columns=SURVEY_COLUMNS,
)

# features -----------------------------------------------------------------

N = None  # a not-a-number coordinate
# shape number -> (WKB type code, parts); a part is a list of rings of (dx, dy[, dz])
SHAPES: dict[int, tuple | None] = {
    0: (3, [[[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]]),
    1: (3, [[[(0, 0), (2, 2), (2, 0), (0, 2), (0, 0)]]]),
    2: (3, [[[(0, 0), (1, 0), (1, 1), (0, 1)]]]),
    3: (3, [[[(0, 0), (1, 0), (0, 0)]]]),
    4: (3, [[[(0, 0), (0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]]]),
    5: (3, [[]]),
    6: (3, [[[(N, 0), (1, 0), (1, 1), (0, 1), (N, 0)]]]),
    7: (3, [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (1, 2), (2, 2), (2, 1), (1, 1)]]]),
    8: (1, [[[(0, 0)]]]),
    9: (2, [[[(0, 0), (1, 2), (3, 1)]]]),
    10: (6, [[[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]], [[(2, 2), (3, 2), (3, 3), (2, 3), (2, 2)]]]),
    11: None,
    12: (3, [[[(0, 0), (2, 0), (2, 2), (2, 0), (0, 2), (0, 0)]]]),
    13: (2, [[[(1, 1), (1, 1)]]]),
    14: (3, [[[(0, 0), (2, 2), (4, 0), (4, 4), (2, 2), (0, 4), (0, 0)]]]),
    15: (1001, [[[(0, 0, 3)]]]),
    16: (4, [[[(0, 0)]], [[(3, 4)]]]),
    17: (3, [[[(0, 0), (2, 0), (2, 2), (0, 2), (0, 0)], [(1, 1), (4, 1), (4, 3), (1, 1)]]]),
    18: (1, [[[(N, N)]]]),
    19: (3, [[[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)], [(2, 2), (3, 2), (3, 3), (2, 2)]]]),
    20: (6, [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)]], [[(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]]]),
    21: (3, [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(0, 2), (2, 1), (2, 3), (0, 2)]]]),
    22: (6, [[[(0, 0), (5, 0), (5, 5), (0, 5), (0, 0)], [(1, 1), (4, 1), (4, 4), (1, 4), (1, 1)]],
             [[(2, 2), (3, 2), (3, 3), (2, 3), (2, 2)]]]),
    23: (3, [[[(0, 0), (5, 0), (5, 5), (0, 5), (0, 0)], [(1, 1), (4, 1), (4, 4), (1, 4), (1, 1)],
              [(2, 2), (3, 2), (3, 3), (2, 3), (2, 2)]]]),
    24: (3, [[[(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(0, 2), (2, 1), (4, 2), (2, 3), (0, 2)]]]),
    25: (3, [[[(0, 0), (5, 0), (5, 5), (0, 5), (0, 0)], [(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)],
              [(2, 2), (3, 2), (3, 3), (2, 3), (2, 2)]]]),
    26: (3, [[[(0, 1), (2, 1), (2, 3), (0, 3), (0, 1)], [(1, 2), (3, 4), (3, 0), (1, 2)]]]),
    27: (6, [[[(0, 0), (1, 0), (1, 1), (0, 1), (0, 0)]], [[(1, 1), (2, 1), (2, 2), (1, 2), (1, 1)]]]),
    28: (3, [[[(0, 0), (5, 0), (5, 5), (0, 5), (0, 0)], [(1, 2), (3, 1), (3, 2), (1, 2)],
              [(3, 2), (4, 4), (2, 4), (3, 2)], [(1, 2), (2, 4), (1, 4), (1, 2)]]]),
}
FEATURE_BASE = {
    "fid": "o_orderkey", "shape": f"o_orderkey % {len(SHAPES)}",
    "bx": "o_custkey % 1000 + 16", "byy": "o_orderkey % 1009 + 16",
    "nome": "o_orderpriority",
}


def double_hex(v: str) -> str:
    """Little-endian hex of a positive whole number below 2^52 as an IEEE double."""
    e = f"(length(bin({v})) - 1)"
    frac = f"({v}) * CAST(power(2, 52 - {e}) AS BIGINT)"
    return f"lpad(hex((1022 + {e}) * CAST(power(2, 52) AS BIGINT) + {frac}), 16, '0')"


def swap8(h: str) -> str:
    return " || ".join(f"substr({h}, {i}, 2)" for i in range(15, 0, -2))


def _u32(n: int) -> str:
    return n.to_bytes(4, "little").hex().upper()


def _shape_hex(shape: tuple) -> str:
    """Concatenation of constants and coordinate names giving the shape's WKB hex."""
    code, parts = shape
    base = code % 1000
    pieces: list[str] = []

    def const(text: str):
        if pieces and pieces[-1].startswith("'"):
            pieces[-1] = pieces[-1][:-1] + text + "'"
        else:
            pieces.append(f"'{text}'")

    def points(ring):
        for p in ring:
            for axis, d in zip("xyz", p):
                if d is None:
                    const(NAN_HEX)
                elif axis == "z":
                    pieces.append(f"hx{d}")
                else:
                    pieces.append(f"h{axis}{d}")

    def member(kind: int, code: int, rings):
        const("01" + _u32(code))
        if kind == 3:
            const(_u32(len(rings)))
        for ring in rings:
            if kind != 1:
                const(_u32(len(ring)))
            points(ring)

    if base > 3:
        const("01" + _u32(code) + _u32(len(parts)))
        for rings in parts:
            member(base - 3, code - 3, rings)
    else:
        member(base, code, parts[0])
    return " || ".join(pieces)


def features_sql(orders: str = "orders") -> str:
    """fid, shape, bx, byy, nome and the WKB of the shape as hex text."""
    spans = {"x": "bx", "y": "byy"}
    raw = ", ".join(f"{double_hex(f'({c} + {d})')} AS r{a}{d}" for a, c in spans.items() for d in range(6))
    low = ", ".join(f"{swap8(f'r{a}{d}')} AS h{a}{d}" for a in spans for d in range(6))
    arms = " ".join(f"WHEN {i} THEN {_shape_hex(s)}" for i, s in SHAPES.items() if s)
    base = ", ".join(f"{e} AS {n}" for n, e in FEATURE_BASE.items())
    return (
        f"SELECT fid, shape, bx, byy, nome, CASE shape {arms} ELSE NULL END AS wkb FROM ("
        f"SELECT fid, shape, bx, byy, nome, {low} FROM ("
        f"SELECT fid, shape, bx, byy, nome, {raw} FROM (SELECT {base} FROM {orders}) f0) f1) f2"
    )


def _shape_cell(shape: tuple) -> tuple[bytes, list[tuple[int, str, int]]]:
    """WKB of a shape without its coordinates, and (first byte, axis, offset) of each of them."""
    cell, slots = b"", []
    for piece in _shape_hex(shape).split(" || "):
        if piece.startswith("'"):
            cell += bytes.fromhex(piece[1:-1])
        else:
            slots.append((len(cell), piece[1], int(piece[2:])))
            cell += bytes(8)
    return cell, slots


def with_cells(base: DataFrame) -> DataFrame:
    """The columns of ``FEATURE_BASE`` with ``geometry``, the bytes that ``features_sql`` spells as hex text."""
    cells = {i: _shape_cell(s) for i, s in SHAPES.items() if s}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shape = batch["shape"].fill_null(-1).to_numpy(zero_copy_only=False)
            axes = {a: batch[c].cast(pa.float64()).to_numpy(zero_copy_only=False) for a, c in (("x", "bx"), ("y", "byy"), ("z", "bx"))}
            missing = {a: batch[c].is_null().to_numpy(zero_copy_only=False) for a, c in (("x", "bx"), ("y", "byy"), ("z", "bx"))}
            known = [(np.flatnonzero(shape == i), *cell) for i, cell in cells.items()]
            size, null = np.zeros(batch.num_rows, np.int64), np.ones(batch.num_rows, bool)
            for at, cell, slots in known:
                null[at] = np.any([missing[a][at] for _, a, _ in slots], axis=0) if slots else False
                size[at] = len(cell)
            ends = np.concatenate([[0], np.cumsum(size)])
            data = np.zeros(ends[-1], np.uint8)
            for at, cell, slots in known:
                made = np.tile(np.frombuffer(cell, np.uint8), (len(at), 1))
                for start, axis, more in slots:
                    made[:, start:start + 8] = (axes[axis][at] + more).astype("<f8").view(np.uint8).reshape(-1, 8)
                data[ends[at][:, None] + np.arange(len(cell))] = made
            geometry = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(data)])
            geometry = pc.if_else(pa.array(null), pa.scalar(None, pa.binary()), geometry)
            yield pa.RecordBatch.from_arrays([*batch.columns, geometry], [*batch.schema.names, "geometry"])

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema.fields)
    return base.mapInArrow(run, f"{fields}, geometry binary")


_stored: dict[tuple[str, str], str] = {}


def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fid, shape, bx, byy, nome, geometry (WKB): a table derived once per application."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        # few small source files would leave all encoding to few tasks: the narrow rows are dealt before it
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
        orders = orders.repartition(spark.sparkContext.defaultParallelism)
        path = new_run_dir(spark, "features")
        with_cells(orders.selectExpr(*[f"{e} AS {n}" for n, e in FEATURE_BASE.items()])).write.parquet(path)
        _stored[key] = path
    return spark.read.parquet(_stored[key])


def vertices_sql() -> str:
    """The vertices of every feature, from the shape list and never from WKB."""
    rows = []
    for i, shape in SHAPES.items():
        if not shape:
            continue
        code, parts = shape
        kind = code % 1000 if code % 1000 <= 3 else code % 1000 - 3
        for p, rings in enumerate(parts):
            for r, ring in enumerate(rings):
                for s, xy in enumerate(ring):
                    if kind == 1 and xy[0] is None:
                        continue
                    dx, dy = ("NULL" if d is None else d for d in xy[:2])
                    dz = xy[2] if len(xy) > 2 else "NULL"
                    rows.append(f"({i}, {p}, {kind}, {r}, {s}, {dx}, {dy}, {dz})")
    values = ", ".join(rows)
    return (
        f"SELECT f.fid, s.part, s.kind, s.ring, s.seq, "
        f"CASE WHEN s.dx IS NULL THEN CAST('nan' AS DOUBLE) ELSE CAST(f.bx + s.dx AS DOUBLE) END AS x, "
        f"CASE WHEN s.dy IS NULL THEN CAST('nan' AS DOUBLE) ELSE CAST(f.byy + s.dy AS DOUBLE) END AS y, "
        f"CAST(f.bx + s.dz AS DOUBLE) AS z "
        f"FROM (SELECT {', '.join(f'{e} AS {n}' for n, e in FEATURE_BASE.items())} FROM orders) f "
        f"JOIN (VALUES {values}) s(shape, part, kind, ring, seq, dx, dy, dz) ON f.shape = s.shape"
    )
