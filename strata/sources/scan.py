"""Scans. All are lazy; column pruning and filters reach the files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import columns, geometry


def _read(spark: SparkSession, path_or_table: str) -> DataFrame:
    if "/" in path_or_table or path_or_table.endswith(".parquet"):
        return spark.read.parquet(path_or_table)
    return spark.table(path_or_table)


def scan_table(spark: SparkSession, path_or_table: str, pk: str) -> DataFrame:
    """Full scan with the key as first column. Emptiness and uniqueness are gates of the job."""
    return columns.key_columns(_read(spark, path_or_table), [pk])


def key_predicates(keys: DataFrame, pk: str, partitions: int) -> list[str]:
    """Conditions on a number key that each hold for about as many rows; every row meets exactly one, a NULL key the first.

    The cuts are approximate quantiles, so dense stretches of keys get as many ranges as their rows ask for. They are
    found in one pass with partial sketches; ``partitions`` - 1 numbers come to the driver.
    """
    shares = [k / partitions for k in range(1, partitions)]
    found = keys.select(F.percentile_approx(pk, shares, 100 * partitions).alias("cuts")).first().cuts if shares else None
    cuts = sorted(set(found or []))
    if not cuts:
        return ["1 = 1"]
    return [f"{pk} <= {cuts[0]} OR {pk} IS NULL", *[f"{pk} > {a} AND {pk} <= {b}" for a, b in zip(cuts, cuts[1:])], f"{pk} > {cuts[-1]}"]


def scan_jdbc(spark: SparkSession, url: str, table: str, pk: str, bounds: tuple[int, int],
              partitions: int, fetch_rows: int = 20_000, **options: str) -> DataFrame:
    """The same scan from a database, read by many tasks in key ranges of about equal numbers of rows.

    The keys alone are read first, in equal steps between ``bounds``, to find the ranges.
    """
    keys = (
        spark.read.format("jdbc").options(**options)
        .option("url", url).option("dbtable", table).option("fetchsize", fetch_rows)
        .option("partitionColumn", pk).option("lowerBound", bounds[0]).option("upperBound", bounds[1])
        .option("numPartitions", partitions).load().select(pk)
    )
    df = spark.read.jdbc(url, table, predicates=key_predicates(keys, pk, partitions), properties={**options, "fetchsize": str(fetch_rows)})
    return columns.key_columns(df, [pk])


def scan_features(spark: SparkSession, path_or_table: str, pk: str, geom: str, srid: int) -> DataFrame:
    """Spatial scan: key named ``fid``, WKB named ``geometry``, SRID in the field metadata."""
    df = columns.rename(_read(spark, path_or_table), {pk: "fid", geom: "geometry"})
    return geometry.with_srid(columns.key_columns(df, ["fid"]), "geometry", srid)


def spatial_query(table: str, names: list[str], geom: str, as_binary: str = "sde.st_asbinary") -> str:
    """SELECT that has the database hand over its geometry column as WKB."""
    items = [f"{as_binary}({n}) AS {n}" if n == geom else n for n in names]
    return f"(SELECT {', '.join(items)} FROM {table}) features"


def scan_features_jdbc(spark: SparkSession, url: str, table: str, names: list[str], pk: str, geom: str,
                       srid: int, bounds: tuple[int, int], partitions: int,
                       as_binary: str = "sde.st_asbinary", **options: str) -> DataFrame:
    """``scan_features`` from a spatial database, in key ranges."""
    query = spatial_query(table, names, geom, as_binary)
    df = scan_jdbc(spark, url, query, pk, bounds, partitions, **options)
    return geometry.with_srid(columns.rename(df, {pk: "fid", geom: "geometry"}), "geometry", srid)


def scan_sql(spark: SparkSession, query: str, **views: DataFrame) -> DataFrame:
    """A projection query; ``{name}`` in the text stands for the DataFrame given as ``name``."""
    return spark.sql(query, **views)


def read_layer_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _literal(name: str) -> str:
    return "".join(f"\\{ch}" if ch in "*?[]{}\\" else ch for ch in name)


def _glob(name_contains: str) -> str:
    return f"*{_literal(name_contains)}*.parquet"


def scan_dir(spark: SparkSession, directory: str, name_contains: str) -> DataFrame:
    """All Parquet files of a directory whose name contains a token, as one table.

    Columns of any file are kept and NULL for the others; columns of one name and different types
    are an error.
    """
    return spark.read.option("pathGlobFilter", _glob(name_contains)).option("mergeSchema", "true").parquet(directory)


def dir_tables(spark: SparkSession, directory: str, name_contains: str, prefix: str = "") -> dict[str, DataFrame]:
    """The same files as one table each, every one with its own schema; by table name.

    A folder of that name, as Spark writes it, is one table of many files. Names alone come to the driver.
    """
    pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{directory.rstrip('/')}/{_glob(name_contains)}")
    found = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(pattern) or []
    files = sorted(f for f in (s.getPath().getName() for s in found) if not f.startswith(("_", ".")))
    tables = {f.removesuffix(".parquet").removeprefix(prefix): f for f in files}
    if len(tables) != len(files):
        raise ValueError(f"files share a table name: {files}")
    return {name: spark.read.parquet(f"{directory.rstrip('/')}/{_literal(f)}") for name, f in tables.items()}


def read_named_layer(spark: SparkSession, path: str, layer: str) -> DataFrame:
    """One layer of a multi-layer dataset; the other partitions are not opened."""
    return spark.read.parquet(path).where(F.col("layer") == layer).drop("layer")


def preview(df: DataFrame, pk: str, n: int = 10) -> DataFrame:
    return df.orderBy(pk).limit(n)
