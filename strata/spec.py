"""Job specs: plain values that drive the jobs, with their argument checks."""

from __future__ import annotations

from dataclasses import dataclass, field

# Names used by every laboratory job unless a spec overrides them.
EXCLUDED_COLUMNS = (
    "globalid", "lote", "ra", "metodo",
    "created_user", "created_date", "last_edited_user", "last_edited_date",
)
TARGET_SRID = 4674

# Sampled media with chemical assays.
CHEMICAL_MEDIA = (
    "agua", "concentrado_de_bateia", "mineral_minerio", "outros", "rocha",
    "sedimento_de_corrente", "solo",
)

# Display labels of the gold-grain size columns.
GRAIN_SIZE_LABELS = {
    "ouro_0_5_mm": "ouro (<0,5mm)",
    "ouro_0_5_1_mm": "ouro (0,5 a 1mm)",
    "ouro_1_mm": "ouro (>1mm)",
}

KINDS = {"chem": (3, 2), "count": (2, 1), "weight": (2, 1)}


@dataclass(frozen=True, kw_only=True)
class Coordinates:
    x: str = "longitude"
    y: str = "latitude"
    srid: int = TARGET_SRID


@dataclass(frozen=True, kw_only=True)
class DateColumn:
    name: str = "data_de_analise"
    format: str = "%d/%m/%Y"


@dataclass(frozen=True, kw_only=True)
class LabSpec:
    """One laboratory table: wide bronze in, survey and long assay tables out."""

    name: str
    kind: str
    source: str
    survey_table: str
    assay_table: str
    survey_columns: tuple[str, ...] = ()
    pk: str = "objectid"
    coordinates: Coordinates = Coordinates()
    dates: tuple[DateColumn, ...] = (DateColumn(),)
    flags: tuple[str, ...] = ("duplicata",)
    index_columns: tuple[str, ...] = ("amostra", "analito")
    value_columns: tuple[str, ...] = ("valor",)
    excluded: tuple[str, ...] = EXCLUDED_COLUMNS
    labels: dict[str, str] = field(default_factory=dict)
    views: tuple[str, ...] = ()

    def __post_init__(self):
        if self.kind not in KINDS:
            raise ValueError(f"unknown kind {self.kind!r}, expected one of {sorted(KINDS)}")
        n_index, n_value = KINDS[self.kind]
        # a YAML reader hands over lists, or a bare string for a single value column
        values = (self.value_columns,) if isinstance(self.value_columns, str) else tuple(self.value_columns)
        object.__setattr__(self, "value_columns", values)
        object.__setattr__(self, "index_columns", tuple(self.index_columns))
        if len(self.index_columns) != n_index:
            raise ValueError(f"{self.name}: {self.kind} needs {n_index} index columns, got {self.index_columns}")
        if len(values) != n_value:
            raise ValueError(f"{self.name}: {self.kind} needs {n_value} value columns, got {values}")


def _views(schema: str | None, prefix: str, survey: str, assay: str, stem: str) -> tuple[str, ...]:
    head = f"{schema}." if schema else ""
    return tuple(f"{head}{prefix}{n}" for n in (survey, assay, f"{stem}_pivot_join"))


def lab_catalogue(source_schema: str | None = None, view_schema: str | None = None,
                  view_prefix: str = "") -> dict[str, LabSpec]:
    """The nine laboratory jobs; a family differs in table names only."""
    head = f"{source_schema}." if source_schema else ""
    specs = {}
    for medium in CHEMICAL_MEDIA:
        survey, assay = f"{medium}_amostras", f"{medium}_analises_quimicas"
        specs[medium] = LabSpec(
            name=f"analise_quimica_{medium}", kind="chem",
            source=f"{head}resultados_analiticos_{medium}", survey_table=survey, assay_table=assay,
            index_columns=("amostra", "analito", "unidade"), value_columns=("qualificador", "valor"),
            views=_views(view_schema, view_prefix, survey, assay, medium),
        )
    for stem, kind, values, labels in (
        ("contagem_pintas_au", "count", ("quantidade",), GRAIN_SIZE_LABELS),
        ("mineralometria", "weight", ("valor",), {}),
    ):
        survey, assay = f"{stem}_amostras", f"{stem}_analises"
        specs[stem] = LabSpec(
            name=stem, kind=kind, source=f"{head}resultados_analiticos_{stem}",
            survey_table=survey, assay_table=assay, value_columns=values, labels=dict(labels),
            views=_views(view_schema, view_prefix, survey, assay, stem),
        )
    return specs


@dataclass(frozen=True, kw_only=True)
class FeatureSpec:
    """One feature class: source layer, its key and geometry, and the target table."""

    source: str
    target: str
    pk: str = "objectid"
    geometry: str = "shape"
    srid: int = TARGET_SRID
    target_srid: int = TARGET_SRID
    auto_repair: bool = True


def feature_specs(layers: list[str], target_schema: str | None = None, **common) -> dict[str, FeatureSpec]:
    """Specs for ``schema.table`` layers; the target is named ``schema_table``."""
    head = f"{target_schema}." if target_schema else ""
    return {
        layer: FeatureSpec(source=layer, target=f"{head}{layer.replace('.', '_')}", **common)
        for layer in layers
    }
