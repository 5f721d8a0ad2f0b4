"""All pairs within groups of any size, by pairs of blocks spread over the tasks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sorted_groups

Kernel = Callable[[pa.Table, pa.Table | None, int], "tuple[list, list, list]"]


def compare(rows: DataFrame, block: int, kernel: Kernel, visitors: bool = False) -> DataFrame:
    """``a, b, links``: what ``kernel`` returns for every pair of blocks of every group.

    ``rows`` has ``group`` and ``members`` (its number of rows), ``id``, and what the kernel reads. A group of m rows
    is dealt by the hash of the id into m / block blocks, and each row goes to the tasks of its block with every other
    block of the group: no task sees more than two blocks. ``kernel(A, B, group)`` gets B None for a block with itself.

    With ``visitors``, ``members`` counts the rows that are at ``home`` in the group and ``guests`` the others, which have
    blocks of their own and meet only the blocks of rows at home.
    """
    n = F.ceil(F.col("members") / block).cast("int")
    deal = F.xxhash64("id", F.lit(17))
    if visitors:
        more = F.ceil(F.col("guests") / block).cast("int")
        own = F.when(F.col("home"), F.pmod(deal, n)).otherwise(n + F.pmod(deal, F.greatest(more, F.lit(1))))
        last = F.when(F.col("home"), n + more - 1).otherwise(n - 1)
    else:
        own, last = F.pmod(deal, n), n - 1
    dealt = rows.withColumns({"own": own.cast("int"), "last": last})
    spread = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    spread = spread.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", "members", "guests", "last")
    keys = ["group", "low", "high"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple[list, list, list] = ([], [], [])
        for part in sorted_groups(batches, keys):
            low, high = part["low"][0].as_py(), part["high"][0].as_py()
            group = part["group"][0].as_py()
            if low == high:
                found = kernel(part, None, group)
            else:
                sides = pc.equal(part["own"], low)
                found = kernel(part.filter(sides), part.filter(pc.invert(sides)), group)
            for h, f in zip(held, found, strict=True):
                h.extend(f)
            if len(held[0]) > 20_000:
                yield _links(held)
                held = ([], [], [])
        if held[0]:
            yield _links(held)

    return spread.repartition(*keys).sortWithinPartitions(*keys, "id").mapInArrow(run, "a long, b long, links long")


def _links(held: tuple[list, list, list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()) for h in held], ["a", "b", "links"])
