"""Sinks and table maintenance.

Layers are written to a directory of their own run, checked in the same pass,
and only then handed on; tables that belong together become visible through one
manifest row. Nothing is collected but counts.
"""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import columns, geometry, reshape
from ..operators.quality import GateError

# Rows per insert batch of the database sinks.
SURVEY_BATCH = 5_000
ASSAY_BATCH = 10_000


def write_checked(df: DataFrame, path: str, gates: dict[str, Column] | None = None,
                  check: Callable[[DataFrame], None] | None = None, partition_by: tuple[str, ...] = ()) -> str:
    """Write a folder that does not exist yet and check it; nothing is handed over.

    ``gates`` maps a gate name to the condition of a violation. They are counted while the rows are written, so
    checking costs no further pass; ``check`` looks at the written rows and raises.
    """
    seen = Observation()
    counted = df.observe(seen, F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(g) for g, c in gates.items()]) if gates else df
    writer = counted.write.mode("error")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    broken = {g: n for g, n in seen.get.items() if g != "rows" and n} if gates else {}
    if broken:
        first = {g: [tuple(r) for r in df.where(gates[g]).limit(5).collect()] for g in broken}
        raise GateError(f"{path}: {broken}, first {first}")
    if check:
        check(df.sparkSession.read.schema(df.schema).parquet(path))
    return path


def _write_run(df: DataFrame, home: str, *how) -> str:
    path = write_checked(df, f"{home}/run-{uuid.uuid4().hex}", *how)
    hand_over(df.sparkSession, f"{home}/manifest", {"path": path})
    return path


def write_layer(df: DataFrame, root: str, rel: str, name: str, gates: dict[str, Column] | None = None,
                check: Callable[[DataFrame], None] | None = None) -> str:
    """Write a new run of the layer ``<root>/<rel>/<name>``, check it, and only then hand it over; returns the run's path.

    A run that fails (see ``write_checked``) leaves the layer's last good run as the current one.
    """
    return _write_run(df, f"{root}/{rel}/{name}", gates, check)


def current_run(spark: SparkSession, home: str) -> str:
    """The folder of the last run under ``home`` that passed its gates."""
    return current_tables(spark, home)["path"]


def current_layer(spark: SparkSession, root: str, rel: str, name: str) -> DataFrame:
    """The last run of a layer that passed its gates."""
    return spark.read.parquet(current_run(spark, f"{root}/{rel}/{name}"))


def retire(spark: SparkSession, manifest: str, keep: int = 2, schema: str | None = None) -> list[str]:
    """Delete the folders of all but the last ``keep`` handed-over versions; returns their paths.

    With ``schema`` the catalog's tables of these versions go too.
    """
    newest = _read_manifest(spark, manifest).orderBy(F.desc("version"), "writer")
    old = newest.offset(keep).collect()
    alive = {p for r in newest.limit(keep).collect() for p in r.tables.values()}
    gone = {p for r in old for p in r.tables.values()} - alive
    if schema:
        for r in old:
            for name in r.tables:
                spark.sql(f"DROP TABLE IF EXISTS {_version_table(schema, name, r.version)}")
    jvm = spark.sparkContext._jvm
    for path in gone:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    return sorted(gone)


def write_features(df: DataFrame, home: str, geom: str = "geometry", gates: dict[str, Column] | None = None,
                   check: Callable[[DataFrame], None] | None = None) -> str:
    """Feature layer: WKB cells, SRID and type in the field metadata of the Parquet schema.

    A new run under ``home``, handed over after its gates as in ``write_layer``; returns the run's path.
    """
    require_srid(df, geom)
    return _write_run(df, home, gates, check)


def require_srid(df: DataFrame, geom: str = "geometry") -> DataFrame:
    if geometry.srid_of(df, geom) is None:
        raise ValueError(f"{geom} has no SRID in its metadata")
    return df


def tagged_layers(frames: dict[str, DataFrame]) -> DataFrame:
    """Several layers as one frame, told apart by the column ``layer``."""
    return reshape.concat_parts([df.withColumn("layer", F.lit(name)) for name, df in frames.items()])


def write_layers(frames: dict[str, DataFrame], home: str, gates: dict[str, Column] | None = None,
                 check: Callable[[DataFrame], None] | None = None) -> str:
    """Several layers in one dataset, one partition directory each: a new run under ``home``, returned after its gates."""
    return _write_run(tagged_layers(frames), home, gates, check, ("layer",))


def replace_rows(df: DataFrame, table: str) -> None:
    """Replace all rows of a table; its schema and column order stay."""
    target = df.sparkSession.table(table)
    df.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in target.schema.fields]) \
        .write.insertInto(table, overwrite=True)


def replace_rows_jdbc(df: DataFrame, url: str, table: str, batch: int = SURVEY_BATCH, **options: str) -> None:
    """The same in a database: truncate, then append in batches."""
    df.write.format("jdbc").mode("overwrite").options(**options).option("url", url) \
        .option("dbtable", table).option("truncate", "true").option("batchsize", batch).save()


def replace_table(df: DataFrame, table: str, path: str | None = None) -> None:
    """Drop and create from the frame's own schema."""
    writer = df.write.mode("overwrite").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def analyze_table(spark: SparkSession, table: str) -> None:
    spark.sql(f"ANALYZE TABLE {table} COMPUTE STATISTICS")


def _version_table(schema: str, name: str, version: int) -> str:
    return f"{schema}.{view_name(name)[1]}__v{version}"


def point_view(spark: SparkSession, view: str, table: str) -> None:
    """A catalog view over a table. An existing view is altered in one step, so readers always find it; a table of that
    name is refused and kept."""
    if not spark.catalog.tableExists(view):
        try:
            spark.sql(f"CREATE VIEW {view} AS SELECT * FROM {table}")
            return
        except AnalysisException as e:
            if e.getCondition() != "TABLE_OR_VIEW_ALREADY_EXISTS":
                raise
    if spark.catalog.getTable(view).tableType != "VIEW":
        raise ValueError(f"{view} is a table; it is not replaced by a view")
    spark.sql(f"ALTER VIEW {view} AS SELECT * FROM {table}")


def point_catalog(spark: SparkSession, root: str, schema: str, names: list[str]) -> int:
    """Let the catalog's views ``schema.<name>`` show the current version under ``root``; returns that version.

    Every version has external tables of its own, with statistics. A publisher that is overtaken points the views at the
    newer version too, so the last one to finish never turns them back.
    """
    while True:
        last = _last(spark, f"{root}/manifest")
        for name in names:
            table = _version_table(schema, name, last.version)
            if not spark.catalog.tableExists(table):
                spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{last.tables[name]}'")
                analyze_table(spark, table)
        for name in names:
            point_view(spark, f"{schema}.{view_name(name)[1]}", _version_table(schema, name, last.version))
        if _last(spark, f"{root}/manifest").version == last.version:
            return last.version


def table_statistics(spark: SparkSession, table: str) -> DataFrame:
    """(table_name, num_rows) as the catalog knows them after ``analyze_table``; for a view, those of the table it shows."""
    info = spark.sql(f"DESCRIBE TABLE EXTENDED {table}")
    shown = info.where("col_name = 'View Text'").first()
    if shown:
        info = spark.sql("DESCRIBE TABLE EXTENDED " + re.sub(r"^SELECT \* FROM ", "", shown.data_type))
    info = info.where("col_name = 'Statistics'")
    return info.select(
        F.lit(table.split(".")[-1]).alias("table_name"),
        F.regexp_extract("data_type", "([0-9]+) rows", 1).cast("bigint").alias("num_rows"),
    )


def clone_schema(df: DataFrame, table: str, renames: dict[str, str] | None = None,
                 path: str | None = None) -> None:
    """Create an empty table with the frame's structure, unless it exists."""
    empty = columns.rename(df.limit(0), renames or {})
    writer = empty.write.mode("ignore").format("parquet")
    (writer.option("path", path) if path else writer).saveAsTable(table)


def _write_all(frames: dict[str, DataFrame]) -> None:
    """Independent writes, submitted together so that they fill each other's gaps."""
    with ThreadPoolExecutor(len(frames)) as pool:
        jobs = [pool.submit(df.write.mode("overwrite").parquet, path) for path, df in frames.items()]
        for job in jobs:
            job.result()


# versions and manifests ---------------------------------------------------

MANIFEST_SCHEMA = "version bigint, writer string, tables map<string, string>"


def _read_manifest(spark: SparkSession, manifest: str) -> DataFrame:
    return (spark.read.schema(MANIFEST_SCHEMA).option("recursiveFileLookup", "true")
            .option("ignoreMissingFiles", "true").json(manifest))


def _last(spark: SparkSession, manifest: str):
    """The newest row."""
    try:
        return _read_manifest(spark, manifest).orderBy(F.desc("version"), "writer").first()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _claim(spark: SparkSession, place: str, writer: str) -> bool:
    """Create the file ``place`` unless it exists; was it this writer who created it?

    The store itself decides, in one step: no look before it could be outdated. Local folders create exclusively, HDFS does by its
    protocol, and object stores are asked for a conditional put. Whoever meets an error reads whose claim it is.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(place)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getUri().getScheme() == "file":
        local = path.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            with open(local, "x") as claim:
                claim.write(writer)
            return True
        except FileExistsError:
            return False
    try:
        out = fs.createFile(path).recursive().overwrite(False).opt("fs.option.create.conditional.overwrite", "true").build()
        out.write(bytearray(writer.encode()))
        out.close()
        return True
    except Py4JJavaError:
        try:
            held = fs.open(path)
        except Py4JJavaError:
            held = None
        if held is None:  # nobody holds it: the error was another one
            raise
        owner = jvm.org.apache.commons.io.IOUtils.toString(held, "UTF-8")
        held.close()
        return owner == writer


def hand_over(spark: SparkSession, manifest: str, tables: dict[str, str]) -> int:
    """Make a set of written and checked folders the current one, by one row under the next free version."""
    writer = uuid.uuid4().hex
    last = _last(spark, manifest)
    version = (last.version if last else 0) + 1
    while not _claim(spark, f"{manifest}-claims/{version}", writer):
        version += 1
    row = spark.range(1).select(
        F.lit(version).cast("bigint").alias("version"), F.lit(writer).alias("writer"),
        F.create_map(*[F.lit(x) for pair in tables.items() for x in pair]).alias("tables"))
    row.coalesce(1).write.json(f"{manifest}/{version}-{writer}")  # writers never share a folder
    return version


def current_tables(spark: SparkSession, root: str) -> dict[str, str]:
    """The folders of the last version handed over under ``root``, all of that version."""
    last = _last(spark, f"{root}/manifest")
    if last is None:
        raise FileNotFoundError(f"nothing has been handed over under {root}")
    return last.tables


def publish_pair(spark: SparkSession, survey_path: str, assay_path: str, root: str, **views: str) -> int:
    """Make two written and checked tables the current pair, with the views computed from them; nothing is copied."""
    return hand_over(spark, f"{root}/manifest", {"survey": survey_path, "assay": assay_path, **views})


def replace_survey_and_assay(survey: DataFrame, assay: DataFrame, root: str) -> int:
    """Write both tables to a folder of their own, then publish them together.

    Readers follow the manifest, so they see the old pair or the new pair. A run
    that dies earlier leaves an unreferenced directory and changes nothing.
    """
    home = f"{root}/pair-{uuid.uuid4().hex}"
    _write_all({f"{home}/survey": survey, f"{home}/assay": assay})
    return publish_pair(survey.sparkSession, f"{home}/survey", f"{home}/assay", root)


def published(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """The current pair of tables."""
    tables = current_tables(spark, root)
    return spark.read.parquet(tables["survey"]), spark.read.parquet(tables["assay"])


def view_name(item: str) -> tuple[str, str]:
    """``schema.name``; anything else lives in ``public``."""
    parts = item.split(".")
    return (parts[0], parts[1]) if len(parts) == 2 else ("public", item)


def write_views(root: str, views: dict[str, DataFrame]) -> dict[str, str]:
    """Dependent tables written to a folder of their own; returns their paths."""
    home = f"{root}/views-{uuid.uuid4().hex}"
    paths = {item: "/".join([home, *view_name(item)]) for item in views}
    _write_all({paths[item]: df for item, df in views.items()})
    return paths


def refresh_views(root: str, views: dict[str, DataFrame]) -> dict[str, str]:
    """Recompute dependent tables after a load and hand them over together; returns their paths."""
    paths = write_views(root, views)
    hand_over(next(iter(views.values())).sparkSession, f"{root}/manifest", paths)
    return paths


AUDIT_SCHEMA = T.StructType([
    T.StructField("target", T.StringType()), T.StructField("rows_inserted", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])


def load_audit(df: DataFrame, path: str, target: str, audit_path: str) -> DataFrame:
    """Write a load and append (target, rows_inserted, updated_at), counted while writing."""
    seen = Observation()
    df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("overwrite").parquet(path)
    return append_audit(df.sparkSession, target, seen.get["n"], audit_path)


def append_audit(spark: SparkSession, target: str, rows: int, audit_path: str) -> DataFrame:
    row = spark.range(1).select(
        F.lit(target).alias("target"), F.lit(rows).cast("bigint").alias("rows_inserted"),
        F.current_timestamp().alias("updated_at"),
    )
    row.coalesce(1).write.mode("append").parquet(audit_path)
    return spark.read.schema(AUDIT_SCHEMA).parquet(audit_path)
