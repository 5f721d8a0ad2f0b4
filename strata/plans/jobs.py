"""The jobs: straight compositions of the operators.

``*_frame`` functions are lazy, DataFrame -> DataFrame. ``run_*`` functions write
their layers and enforce the gates.
"""

from __future__ import annotations

import dataclasses
import uuid
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import clean
from ..operators import columns, features, geometry, joins, quality, reshape, styles
from ..sources import scan, sinks
from ..spec import FeatureSpec, LabSpec


# bronze -------------------------------------------------------------------

def bronze_frame(source: DataFrame, spec: LabSpec) -> DataFrame:
    return columns.slugify_columns(columns.key_columns(source, [spec.pk]), keep=(spec.pk,))


def run_bronze(source: DataFrame, spec: LabSpec, root: str) -> str:
    """Bronze layer of a non-empty table with a unique key."""

    def check(stored: DataFrame) -> None:
        quality.enforce(quality.not_empty(stored), f"{spec.name}: empty table")
        quality.enforce(quality.unique_key(stored, [spec.pk]), f"{spec.name}: repeated key", [spec.pk])

    return sinks.write_layer(bronze_frame(source, spec), root, f"{spec.name}/bronze", f"{spec.source}.parquet",
                             gates={"null_key": F.col(spec.pk).isNull()}, check=check)


def assay_columns(bronze: DataFrame, spec: LabSpec) -> list[str]:
    return columns.split_columns(bronze.columns, list(spec.survey_columns), spec.excluded, spec.pk)[1]


# survey -------------------------------------------------------------------

def survey_frame(bronze: DataFrame, spec: LabSpec, also: list[str] | None = None) -> DataFrame:
    """Sample attributes with flags, dates and the sample point (``also``: more columns to keep)."""
    wanted = [spec.pk, *[c for c in spec.survey_columns if c != spec.pk]]
    at = geometry.point(F.col(spec.coordinates.x), F.col(spec.coordinates.y), spec.coordinates.srid)
    # the point comes from the bronze columns even when the survey does not keep them
    located = bronze.withColumn("geometry", at)
    df = columns.select_existing(located, [*[c for c in wanted if c != "geometry"], "geometry", *(also or [])])
    df = clean.empty_to_null_columns(df)
    df = columns.slugify_columns(df, keep=(spec.pk,))
    df = df.withColumns({c: clean.yes_flag(F.col(c)) for c in spec.flags if c in df.columns})
    return df.withColumns({
        d.name: clean.parse_date(F.col(d.name), d.format) for d in spec.dates if d.name in df.columns
    })


def run_survey(bronze: DataFrame, spec: LabSpec, root: str, require_geometry: bool = False) -> str:
    """The key of the bronze layer is unique, and no row is added here: no second check."""
    gates = {"missing_geometry": F.col("geometry").isNull()} if require_geometry else None
    return sinks.write_layer(
        survey_frame(bronze, spec), root, f"{spec.name}/silver", f"{spec.survey_table}.parquet", gates)


# assays -------------------------------------------------------------------

def long_values(bronze: DataFrame, spec: LabSpec, analytes: list[str] | None = None) -> DataFrame:
    """(sample, analyte, cleaned text): the part all three families share.

    The key of the result is unique because the bronze key is, and because two
    columns never share a name; so the uniqueness gate runs on the narrow, wide-table
    key and not on the unpivoted rows.
    """
    key, var = spec.index_columns[:2]
    wanted = analytes if analytes is not None else assay_columns(bronze, spec)
    df = columns.select_existing(bronze, [spec.pk, *wanted])
    df = columns.slugify_columns(df, keep=(spec.pk,))
    df = columns.humanize(df, spec.labels)
    cells = [c for c in df.columns if c != spec.pk]
    long = reshape.unpivot_assays(df, spec.pk, cells, key, var, "_text")
    # the missing test runs as a filter of its own, so that dropped cells cost no replacing
    # and kept ones are not tested again
    bare = clean.strip_spaces(F.col("_text"))
    kept = quality.keep_valid(long, clean.missing_to_null(bare, spec.kind).isNotNull())
    return kept.withColumn("_text", clean.replace_chain(bare, clean.REPLACEMENTS[spec.kind]))


def chem_assay_frame(bronze: DataFrame, spec: LabSpec, analytes: list[str] | None = None,
                     units: list[str] | None = None) -> DataFrame:
    """(sample, analyte, unit, qualifier, value); value is NULL where the grammar is broken."""
    _, var, unit = spec.index_columns
    qualifier, value = spec.value_columns
    split = reshape.split_analyte_unit(long_values(bronze, spec, analytes), var, unit, units)
    return reshape.decompose_value(split, "_text", qualifier, value)


def count_assay_frame(bronze: DataFrame, spec: LabSpec, analytes: list[str] | None = None) -> DataFrame:
    """(sample, analyte, count); count is NULL where the text is no integer."""
    number = reshape.whole_number(F.col("_text"))
    return long_values(bronze, spec, analytes).select(*spec.index_columns, number.alias(spec.value_columns[0]))


def weight_assay_frame(bronze: DataFrame, spec: LabSpec, analytes: list[str] | None = None) -> DataFrame:
    """(sample, analyte, weight); weight is NULL where the text is no number."""
    number = clean.to_number_try(F.col("_text"))
    return long_values(bronze, spec, analytes).select(*spec.index_columns, number.alias(spec.value_columns[0]))


ASSAY_FRAMES = {"chem": chem_assay_frame, "count": count_assay_frame, "weight": weight_assay_frame}


def assay_frame(bronze: DataFrame, spec: LabSpec, analytes: list[str] | None = None) -> DataFrame:
    return ASSAY_FRAMES[spec.kind](bronze, spec, analytes)


NUMBERS = {"chem": reshape.chem_number, "count": reshape.whole_number, "weight": clean.to_number_try}


def survey_pivot_frame(bronze: DataFrame, spec: LabSpec) -> DataFrame:
    """Survey with one number column per analyte, straight from the wide table.

    With a unique key this equals unpivoting, pivoting back and joining, but it is a
    projection: no row leaves its partition.
    """
    analytes = assay_columns(bronze, spec)
    types = dict(zip(bronze.columns, (f.dataType for f in bronze.schema.fields)))
    df = survey_frame(bronze, spec, analytes)
    names = columns.slug_map(analytes)
    numbers = {}
    for source, name in names.items():
        text = clean.plain_text(F.col(f"`{name}`"), types[source])
        numbers[name] = NUMBERS[spec.kind](clean.clean_value(text, spec.kind))
    return columns.humanize(df.withColumns(numbers), spec.labels)


def run_assay(bronze: DataFrame, spec: LabSpec, root: str) -> str:
    """Silver assay layer; a value outside the grammar stops the job before publication."""
    return sinks.write_layer(
        assay_frame(bronze, spec), root, f"{spec.name}/silver", f"{spec.assay_table}.parquet",
        gates={"bad_value": F.col(spec.value_columns[-1]).isNull()},
    )


def bad_values(bronze: DataFrame, spec: LabSpec) -> DataFrame:
    """Long rows outside the grammar, with their cleaned text."""
    long = long_values(bronze, spec)
    gate = {
        "chem": lambda: quality.chem_grammar(long, "_text"),
        "count": lambda: quality.integer_grammar(long, "_text"),
        "weight": lambda: quality.castable_number(long, "_text"),
    }[spec.kind]
    return gate().withColumnRenamed("_text", "value_text")


# publication --------------------------------------------------------------

def dependent_views(survey: DataFrame, assay: DataFrame, spec: LabSpec,
                    labels: list[str]) -> dict[str, DataFrame]:
    """The three derived tables of a job: samples, analyses, samples with pivoted values."""
    unit = spec.index_columns[2] if len(spec.index_columns) == 3 else None
    pivoted = reshape.pivot_assays(
        assay, labels, spec.index_columns[0], spec.index_columns[1], spec.value_columns[-1], unit)
    joined = joins.survey_pivot_join(survey, pivoted, spec.pk, spec.index_columns[0])
    return dict(zip(spec.views, (reshape.survey_view(survey), reshape.assay_view(assay), joined)))


def publish(spark: SparkSession, survey_path: str, assay_path: str, spec: LabSpec, labels: list[str], root: str,
            joined: DataFrame | None = None, schema: str | None = None) -> dict[str, str]:
    """Publish the pair of checked tables and the views computed from them as one version.

    The two identity views are the published folders themselves; only the pivoted one is data of its own, written
    before anything is handed over. ``joined`` is that view where the caller can compute it without a shuffle. With ``schema``
    the three become views of the catalog over tables with statistics.
    """
    if joined is None:
        survey, assay = (scan.read_layer_parquet(spark, p) for p in (survey_path, assay_path))
        joined = dependent_views(survey, assay, spec, labels)[spec.views[2]]
    paths = {spec.views[0]: survey_path, spec.views[1]: assay_path, **sinks.write_views(root, {spec.views[2]: joined})}
    sinks.publish_pair(spark, survey_path, assay_path, root, **paths)
    if schema:
        sinks.point_catalog(spark, root, schema, list(spec.views))
    return paths


def with_target_columns(spark: SparkSession, spec: LabSpec, target: str) -> LabSpec:
    """The spec with the survey columns that its target table has, in their order."""
    return dataclasses.replace(spec, survey_columns=tuple(columns.target_columns(spark, target)))


def run_lab(source: DataFrame, spec: LabSpec, root: str, target: str | None = None,
            schema: str | None = None) -> dict[str, str]:
    """Bronze -> survey and assay -> publication.

    ``target`` is the survey's target table, whose columns say what belongs to the survey; without it the spec must.
    """
    spark = source.sparkSession
    if target:
        spec = with_target_columns(spark, spec, target)
    if not spec.survey_columns:
        raise ValueError(f"{spec.name}: no survey columns; give the target table or name them in the spec")
    bronze = scan.read_layer_parquet(spark, run_bronze(source, spec, root))
    labels = [spec.labels.get(c, c) for c in assay_columns(bronze, spec)]
    # the two silver layers do not depend on each other: submit both, Spark shares the slots
    with ThreadPoolExecutor(2) as pool:
        survey, assay = (p.result() for p in [pool.submit(run, bronze, spec, root) for run in (run_survey, run_assay)])
    return publish(spark, survey, assay, spec, labels, f"{root}/{spec.name}/gold", survey_pivot_frame(bronze, spec), schema)


def run_catalogue(sources: dict[str, DataFrame], specs: dict[str, LabSpec], root: str,
                  targets: dict[str, str] | None = None) -> dict[str, dict[str, str]]:
    """Every laboratory job of a catalogue whose source is given."""
    return {name: run_lab(source, specs[name], root, (targets or {}).get(name)) for name, source in sources.items()}


def all_assays(bronzes: dict[str, tuple[DataFrame, LabSpec]]) -> DataFrame:
    """The assays of many specs of one family as one table tagged with the medium."""
    tagged = [
        assay_frame(bronze, spec).withColumn("meio", F.lit(medium))
        for medium, (bronze, spec) in bronzes.items()
    ]
    return reduce(DataFrame.unionByName, tagged)


def run_all_assays(bronzes: dict[str, tuple[DataFrame, LabSpec]], path: str) -> str:
    """The tagged table, one directory per medium; rows stay where they were read."""
    all_assays(bronzes).write.mode("overwrite").partitionBy("meio").parquet(path)
    return path


# feature classes ----------------------------------------------------------

def extract_features(source: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Key and geometry renamed, SRID attached."""
    df = columns.rename(source, {spec.pk: "fid", spec.geometry: "geometry"})
    return geometry.with_srid(columns.key_columns(df, ["fid"]), "geometry", spec.srid)


def typed_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """Profile attached to the geometry; single parts promoted when the column is multi."""
    # one row of metadata travels to the driver
    profile = geometry.geometry_profile(df).first()
    if profile is None:
        return df
    df = geometry.with_srid(df, "geometry", spec.srid, geometry_type=profile.geometry_type,
                            dimension=profile.dimension)
    return geometry.promote_to_multi(df, "geometry", profile.geometry_type)


def run_features(source: DataFrame, spec: FeatureSpec, root: str, load: bool = False) -> dict[str, str]:
    """Extract, report, clean, reproject, audit, repair, split into layers, gate, hand over, load.

    Everything is written to the folder of this run and becomes current by one manifest row (``current_features``) after
    the gates: no repeated fid, and as many features behind as before. A run that fails leaves all tables of the last good one. With ``load`` the good
    features then replace the rows of the catalog table ``spec.target``, whose schema stays (it is created where it is
    missing), and its statistics are computed anew.

    Each stage that is used more than once is a written table, so a lost executor
    costs a task of that stage and not the whole chain. The source itself, possibly a
    database, is read once.
    """
    spark = source.sparkSession
    name = spec.target.split(".")[-1]
    stage = f"{root}/{name}"
    run = f"{stage}/run-{uuid.uuid4().hex}"

    def write(part: str, df: DataFrame, **how) -> DataFrame:
        return scan.read_layer_parquet(spark, sinks.write_checked(df, f"{run}/{part}", **how))

    def one_row_each(stored: DataFrame) -> None:
        quality.enforce(quality.unique_key(stored, ["fid"]), f"{name}: repeated fid", ["fid"])

    bronze = write("bronze", sinks.require_srid(extract_features(source, spec)), check=one_row_each)
    bronze = typed_features(bronze, spec)
    cleaned = geometry.reproject(clean.strip_null_bytes(bronze), "geometry", spec.target_srid)
    silver = write("silver", sinks.require_srid(cleaned))
    audit = write("validity", geometry.validity(silver))
    write("report", features.feature_report(bronze, audit, spec.target_srid))

    # the few faulty keys and their repaired features are tables of known size, so the
    # joins below leave the large side where it is whenever that size allows it
    faults = write("faults", features.faults_of(audit))
    repaired = repaired_faults = None
    if spec.auto_repair:
        faulty = silver.select("fid", "geometry").join(faults, "fid", "left_semi")
        repaired = write("repaired", geometry.repair_simple(faulty))
        repaired_faults = features.faults_of(geometry.validity(repaired))
    layers = features.split_layers(silver, faults, repaired, repaired_faults)
    layers["unchecked"] = features.unchecked_of(audit)
    layers_path = sinks.write_checked(sinks.tagged_layers(layers), f"{run}/layers", partition_by=("layer",))
    valid = scan.read_named_layer(spark, layers_path, "valid").drop("invalid_reason")
    gold = write("gold", geometry.with_srid(valid, "geometry", spec.target_srid))
    before, rows = bronze.count(), gold.count()  # from the files' footers
    if before != rows:
        raise quality.GateError(f"{name}: {rows} features behind the repair, {before} before")

    paths = {part: f"{run}/{part}" for part in ("bronze", "silver", "validity", "report", "layers", "gold")}
    sinks.hand_over(spark, f"{stage}/manifest", paths)
    sinks.append_audit(spark, spec.target, rows, f"{root}/load_audit")
    if load:
        sinks.clone_schema(gold, spec.target)
        sinks.replace_rows(gold, spec.target)
        sinks.analyze_table(spark, spec.target)
    return {**paths, "audit": f"{root}/load_audit"}


def current_features(spark: SparkSession, root: str, target: str) -> dict[str, str]:
    """The folders of the last run of a feature job that passed its gates, all of one run."""
    return sinks.current_tables(spark, f"{root}/{target.split('.')[-1]}")


def run_all_features(sources: dict[str, DataFrame], specs: dict[str, FeatureSpec], root: str,
                     load: bool = False) -> dict[str, dict[str, str]]:
    """Every feature job whose source layer is given, by layer."""
    return {layer: run_features(source, specs[layer], root, load) for layer, source in sources.items()}


def migrate_layer(source: DataFrame, spec: FeatureSpec, root: str, table: str) -> dict[str, DataFrame]:
    """Copy one layer with its structure: profile, typed copy, empty target table."""
    spark = source.sparkSession
    df = geometry.with_srid(
        columns.rename(source, {spec.pk: "fid", spec.geometry: "geometry"}), "geometry", spec.srid)
    quality.enforce(quality.unique_key(df, ["fid"]), f"{table}: repeated fid", ["fid"])
    stored = scan.read_layer_parquet(spark, sinks.write_features(df, f"{root}/{table}.parquet"))
    layers = sinks.write_layers({table: columns.infer_types(stored)}, f"{root}/layers")
    sinks.clone_schema(columns.generalize_types(source), table, {spec.pk: "fid", spec.geometry: "geometry"},
                       f"{root}/target/{table}")
    return {"profile": quality.frame_profile(stored),
            "layer": scan.read_named_layer(spark, layers, table)}


def reload_dir(spark: SparkSession, directory: str, name_contains: str, root: str, prefix: str = "",
               geom: str = "geometry", fid: str = "fid") -> DataFrame:
    """Every matching file as a table of its own, replaced without null bytes: table_name, rows, and the features that
    are valid, invalid and unchecked (NULL for a table without geometry)."""
    reports = []
    for name, df in scan.dir_tables(spark, directory, name_contains, prefix).items():
        path = sinks.write_layer(clean.strip_null_bytes(df), root, "tables", name)
        stored = spark.read.parquet(path)
        counts = stored.agg(F.count(F.lit(1)).alias("rows"))
        if {geom, fid} <= set(stored.columns):
            shapes = geometry.validity(stored, fid, geom).agg(
                F.count_if(F.col("valid")).alias("valid"), F.count_if(~F.col("valid")).alias("invalid"),
                F.count_if(F.col("valid").isNull()).alias("unchecked"))
            counts = reshape.concat_parts([counts, shapes])
            counts = counts.agg(*[F.max(c).alias(c) for c in counts.columns])
        else:
            counts = counts.select("rows", *[F.lit(None).cast("bigint").alias(c) for c in ("valid", "invalid", "unchecked")])
        reports.append(counts.select(F.lit(name).alias("table_name"), "*"))
    if not reports:
        raise FileNotFoundError(f"no file of {directory} has {name_contains!r} in its name")
    return reshape.concat_parts(reports)


def style_table(units: DataFrame, feature_rows: DataFrame, on: str = "sigla") -> DataFrame:
    """Features with the drawing rule of their unit; a unit with two rules would double its features."""
    quality.enforce(quality.unique_key(units.where(F.col(on).isNotNull()), [on]), f"repeated {on} in the rules", [on])
    return joins.style_features(feature_rows, styles.style_rules(units, on), on)
