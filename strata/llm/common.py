"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What separates words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
#: Keys with more than one in so many of all rows are heavy; there are fewer than that, however many rows there are.
HEAVIEST = 10_000
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCAL_DIR = "spark.strata.llm.localDir"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir; a local session without it gets a temporary one."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_LOCAL_DIR, None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.conf.set(_LOCAL_DIR, "file://" + tempfile.mkdtemp(prefix="strata-llm-"))
    return spark.conf.get(_LOCAL_DIR)


def run_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows written to the shared folder and read again: later readers neither recompute them nor need this executor."""
    spark, path = df.sparkSession, run_dir(df.sparkSession, name)
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")  # what was shuffled for the table is of no use once it is written
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.parquet(path)


def forget(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    jvm, shared = df.sparkSession.sparkContext._jvm, shared_dir(df.sparkSession)
    for folder in {os.path.dirname(f) for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        if path.getParent().toUri().getPath() == jvm.org.apache.hadoop.fs.Path(shared).toUri().getPath():
            path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def with_counts(rows: DataFrame, counts: DataFrame, keys: list[str], n: str, total: int) -> DataFrame:
    """``rows`` with the columns of ``counts``, a stored table of one row a key whose column ``n`` adds up to ``total`` or less.

    A key that holds many of the rows would fill one task of a merge. Keys of more than one in ``HEAVIEST`` of the total
    are fewer than ``HEAVIEST``, so they are sent to all rows and their rows stay where they are; the others are merged.
    """
    heavy = F.col(n) * F.lit(HEAVIEST).cast("long") > F.lit(total)
    few = counts.where(heavy)
    rest = rows.join(F.broadcast(few.select(keys)), keys, "left_anti").join(counts.where(~heavy).hint("merge"), keys)
    return rows.join(F.broadcast(few), keys).unionByName(rest)


def word_count(text: Column) -> Column:
    """Number of words of a text, without Python; null counts as empty."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, SPACE_CLASS + "+"))).cast("long")


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of a stream that is sorted by ``keys``, one at a time; a group may span batches."""
    open_: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        rows = list(zip(*(batch.column(k).to_pylist() for k in keys), strict=True))
        start = 0
        for i, key in enumerate(rows):
            if last is not None and key != last:
                if i > start:
                    open_.append(batch.slice(start, i - start))
                yield pa.Table.from_batches(open_)
                open_, start = [], i
            last = key
        open_.append(batch.slice(start))
    if open_:
        yield pa.Table.from_batches(open_)
