"""Token counts of flat unindexed token files: a vectorised separator search by blocks, stitched by a prefix scan."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import run_dir, stored
from .tokens import encode

#: <|endoftext|> of the vocabulary ends every document in the files; ids fit 16 bits.
SEPARATOR = 50256


def _filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return pafs.FileSystem.from_uri(uri)


def write_flat(docs: DataFrame, folder: str, *, separator: int = SEPARATOR, ranks_path: str | None = None) -> DataFrame:
    """One flat file of 16-bit ids for each partition; returns ``file, ordinal, doc_id``, the order of the documents.

    A file's name holds the task attempt, and only what a successful attempt returned is read later: a lost or
    repeated attempt leaves a file that nobody names. An id of the separator within a text would end a document, so
    the separator's string in a text is encoded as ordinary text.
    """
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .tokens import END_TEXT, encoder
        fs, root = _filesystem(folder)
        fs.create_dir(root, recursive=True)
        task = TaskContext.get()
        name = f"tokens-{task.partitionId():06d}-{task.taskAttemptId()}.bin"
        ordinal = 0
        with fs.open_output_stream(f"{root}/{name}") as out:
            for batch in batches:
                for text in batch.column(1):
                    words = text.as_py()
                    if words and END_TEXT in words:
                        ids = np.array(encoder(ranks_path).encode_ordinary(words), np.uint32)
                    else:
                        ids = encode(words, ranks_path)
                    out.write(np.append(ids, np.uint32(separator)).astype("<u2").tobytes())
                n = batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(range(ordinal, ordinal + n), pa.int64()), batch.column(0)],
                    ["file", "ordinal", "doc_id"])
                ordinal += n

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        write, "file string, ordinal long, doc_id long")


def count_tokens(spark: SparkSession, folder: str, *, separator: int = SEPARATOR, width: int = 2,
                 block_tokens: int = 8_388_608) -> DataFrame:
    """``file, ordinal, start, n_tokens, ended`` of every document in the flat files of a folder.

    Every block is searched alone; the prefix scan over the blocks of a file gives each block the number of
    separators and the place of the last one before it. ``n_tokens`` leaves the separator out. Tokens behind the last
    separator are a document with ``ended`` false; bytes behind the last whole token are ignored. Empty files give no row.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.bin").load(folder).select(
        "path", F.floor(F.col("length") / width).alias("tokens"))
    blocks = files.where("tokens > 0").select(
        "path", "tokens", F.explode(F.sequence(F.lit(0), F.col("tokens") - 1, F.lit(block_tokens))).alias("first"))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, tokens, first in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                fs, place = _filesystem(path)
                with fs.open_input_file(place) as source:
                    source.seek(first * width)
                    data = source.read(min(block_tokens, tokens - first) * width)
                ids = np.frombuffer(data, f"<u{width}")
                ends = np.flatnonzero(ids == separator) + first
                rest = first + len(ids) == tokens and (not len(ends) or ends[-1] + 1 < tokens)
                if rest or not len(ends):  # a block without an end still says so, for the scan
                    ends = np.append(ends, -1)
                n = len(ends)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * n), pa.array([first] * n, pa.int64()), pa.array([tokens] * n, pa.int64()),
                     pa.array(range(n), pa.int64()), pa.array([None if e < 0 else e for e in ends.tolist()], pa.int64()),
                     pa.array([rest and e < 0 for e in ends.tolist()], pa.bool_())],
                    ["path", "first", "tokens", "i", "end", "tail"])

    found = stored(blocks.repartition("path", "first").mapInArrow(
        search, "path string, first long, tokens long, i long, end long, tail boolean"), "separators")
    scan = Window.partitionBy("path").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    summary = (
        found.groupBy("path", "first").agg(F.count("end").alias("ends"), F.max("end").alias("last_end"))
        .select("path", "first", F.coalesce(F.sum("ends").over(scan), F.lit(0)).alias("ends_before"),
                F.coalesce(F.max("last_end").over(scan) + 1, F.lit(0)).alias("begins"))
    )
    in_block = Window.partitionBy("path", "first").orderBy("i")
    near = found.withColumn("previous", F.lag("end").over(in_block) + 1)
    stop = F.when(F.col("tail"), F.col("tokens")).otherwise(F.col("end"))
    return (
        near.join(summary, ["path", "first"]).where("tail OR end IS NOT NULL")
        .withColumn("start", F.coalesce("previous", "begins"))
        .select(F.element_at(F.split("path", "/"), -1).alias("file"), (F.col("ends_before") + F.col("i")).alias("ordinal"),
                "start", (stop - F.col("start")).alias("n_tokens"), (~F.col("tail")).alias("ended"))
    )


def token_counts(docs: DataFrame, *, ranks_path: str | None = None, block_tokens: int = 8_388_608) -> DataFrame:
    """``doc_id, n_tokens, file, ordinal, start`` of every document, found again in flat files written from them.

    Null or empty text: 0 tokens. Repeated rows and null ids are counted each. Other columns are ignored.
    """
    spark = docs.sparkSession
    folder = run_dir(spark, "flat-tokens")
    order = stored(write_flat(docs, folder, ranks_path=ranks_path), "token-order")
    if order.isEmpty():
        return order.select("doc_id", F.lit(0).cast("long").alias("n_tokens"), "file", "ordinal",
                            F.lit(0).cast("long").alias("start"))
    counts = count_tokens(spark, folder, block_tokens=block_tokens)
    return order.join(counts, ["file", "ordinal"]).select("doc_id", "n_tokens", "file", "ordinal", "start")
