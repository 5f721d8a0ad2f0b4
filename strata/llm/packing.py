"""Packing by power-of-two decomposition: no sequence crosses documents and none needs padding."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import stored
from .tokens import encode

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def lengths(n: int, longest: int) -> list[int]:
    """Binary pieces of n tokens, longest first: whole sequences, then the powers of two of the rest."""
    rest = n % longest
    return [longest] * (n // longest) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(docs: DataFrame, *, longest: int = 2048, end_id: int = 1, ranks_path: str | None = None,
         with_ids: bool = False) -> DataFrame:
    """Rows of pieces: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, bucket, place (and ``ids`` if wanted).

    A document's ids, then ``end_id``, are cut into pieces whose lengths are powers of two up to ``longest`` (itself a
    power of two). Each piece is a sequence of its own in the bucket of its length. ``bucket`` is the logarithm of the
    length and ``place`` numbers a bucket's sequences without gaps, so any run of places is a batch without padding;
    sequence_id numbers the buckets one behind the other, the longest first.

    Documents are read and encoded once. A task numbers its own pieces of each length; the counts of all tasks, a row for
    each task and length, are summed up in order. A task that runs again gives the same numbers.

    Null or empty text: one piece, the end id. Repeated rows are packed each. Null ids are kept. Other columns are
    ignored; an empty table gives no rows.
    """
    if longest & (longest - 1):
        raise ValueError("the longest sequence must be a power of two")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, before = TaskContext.get().partitionId(), Counter()
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            out: list[list] = [[], [], [], [], []]
            kept: list[np.ndarray] = []
            for doc_id, text in zip(ids_of, batch.column(1), strict=True):
                ids = np.append(encode(text.as_py(), ranks_path), np.uint32(end_id)).astype("<u4")
                sizes = lengths(len(ids), longest)
                starts = np.cumsum([0, *sizes[:-1]]).tolist()
                view = memoryview(ids.tobytes())
                for values, more in zip(out, (
                        [doc_id] * len(sizes), starts, sizes,
                        [zlib.crc32(view[4 * s:4 * (s + n)]) for s, n in zip(starts, sizes, strict=True)],
                        [len(ids)] * len(sizes)), strict=True):
                    values.extend(more)
                if with_ids:
                    kept.extend(ids[s:s + n] for s, n in zip(starts, sizes, strict=True))
            nth = []
            for n in out[2]:
                nth.append(before[n])
                before[n] += 1
            arrays = [pa.array(v, pa.int64()) for v in (*out, [task] * len(nth), nth)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"]
            if with_ids:
                arrays.append(pa.array([k.astype(np.int64) for k in kept], pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    schema = PIECES + ", task long, nth long" + (", ids array<long>" if with_ids else "")
    pieces = stored(docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(cut, schema), "pieces")
    counts = stored(pieces.groupBy("length", "task").count(), "piece-counts")
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("length", "task", F.coalesce(F.sum("count").over(earlier), F.lit(0)).alias("first"))
    # a row for each length: at most as many as the longest has bits
    longer = Window.orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, -1)
    buckets = counts.groupBy("length").agg(F.sum("count").alias("n")).select(
        "length", F.coalesce(F.sum("n").over(longer), F.lit(0)).alias("base"))
    starts = stored(starts.join(buckets, "length"), "piece-starts")
    place = F.col("first") + F.col("nth")
    return pieces.join(starts, ["length", "task"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("base") + place).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
        F.log2("length").cast("int").alias("bucket"), place.alias("place"), *(["ids"] if with_ids else []))
