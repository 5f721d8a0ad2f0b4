"""Approximate nearest neighbours by cross-polytope hashing.

A unit vector is turned by fast pseudo-rotations (random signs and a Hadamard transform, three times) and hashed to the signed axis
nearest to it. Several such hashes make a bucket, and several tables of buckets an index of every row. A query
probes in each table the buckets whose cost, the squared lead of its nearest axes over the probed ones, is below a reach. The
reach is fitted: for a bounded sample of queries the true neighbours are found among all rows, and it is the least cost at which the
wanted share of them lies in a probed bucket. Candidates are ranked by their exact distance where they lie, bucket by bucket.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import sorted_groups, stored

FOUND = "query_id long, query long, score double, vec_id long"


@dataclass
class Polytopes:
    """The hashes of one vector length: signs[table, hash, round, dimension] and the dimensions whose axes each hash uses."""
    dim: int
    signs: np.ndarray
    axes: list[int]

    @classmethod
    def make(cls, dim: int, rows: int, tables: int, per_bucket: int, seed: int) -> Polytopes:
        """As many hashes as give about ``per_bucket`` rows a bucket; the last one uses as many axes as are still needed."""
        wide = 1 << max(0, dim - 1).bit_length()
        axes, left = [], rows / per_bucket
        while not axes or left >= 4:
            axes.append(max(1, min(wide, 1 << int(np.log2(max(2, left))) - 1)))
            left /= 2 * axes[-1]
        rng = np.random.default_rng(seed)
        return cls(dim, rng.choice([-1.0, 1.0], (tables, len(axes), 3, wide)), axes)

    @property
    def tables(self) -> int:
        return len(self.signs)

    @property
    def buckets(self) -> int:
        return int(np.prod([2 * a for a in self.axes]))

    def turned(self, x: np.ndarray, table: int, k: int) -> np.ndarray:
        """Components of unit vectors along the axes of a hash, positive and negative axes by turns."""
        v = np.zeros((len(x), self.signs.shape[-1]))
        v[:, :self.dim] = x
        for signs in self.signs[table, k]:
            v = hadamard(v * signs)
        v = v[:, :self.axes[k]]
        return np.stack([v, -v], 2).reshape(len(x), -1)

    def bucket(self, x: np.ndarray, table: int) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for k, axes in enumerate(self.axes):
            out = out * 2 * axes + self.turned(x, table, k).argmax(1)
        return out

    def costs(self, x: np.ndarray, table: int) -> list[np.ndarray]:
        """Cost of each axis of each hash for unit queries; that of a bucket is the sum over its axes."""
        turned = [self.turned(x, table, k) for k in range(len(self.axes))]
        return [(t.max(1, keepdims=True) - t) ** 2 for t in turned]

    def cost_of(self, costs: list[np.ndarray], query: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        out = np.zeros(len(bucket))
        for c, axes in zip(reversed(costs), reversed(self.axes), strict=True):
            out, bucket = out + c[query, bucket % (2 * axes)], bucket // (2 * axes)
        return out


def hadamard(v: np.ndarray) -> np.ndarray:
    """The orthonormal Hadamard transform of each row, in n log n steps; the row length is a power of two."""
    rows, n = v.shape
    width = 1
    while width < n:
        w = v.reshape(rows, n // (2 * width), 2, width)
        v = np.stack([w[:, :, 0] + w[:, :, 1], w[:, :, 0] - w[:, :, 1]], 2)
        width *= 2
    return v.reshape(rows, n) / np.sqrt(n)


def probes(costs: list[np.ndarray], query: int, reach: float) -> np.ndarray:
    """All buckets of one query within the reach, ascending. Costs only grow hash by hash, so prefixes beyond it are left."""
    bucket, cost = np.zeros(1, np.int64), np.zeros(1)
    for c in costs:
        total = cost[:, None] + c[query]
        i, j = np.nonzero(total <= reach)
        bucket, cost = bucket[i] * c.shape[1] + j, total[i, j]
    return bucket


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _distance(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows, in double precision, each from its own two vectors alone."""
    return np.sqrt(((q - x) ** 2).sum(1))


def _read(cells: pa.Array | pa.ChunkedArray, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(cells.to_pylist()), kind).reshape(len(cells), -1).astype(np.float64)


class Best:
    """The k nearest rows of each query so far: offers are taken in bulk and cut back from time to time."""

    def __init__(self, queries: int, k: int):
        self.k, self.bound, self.held, self.size = k, np.full(queries, np.inf), [], 0

    def offer(self, query: np.ndarray, score: np.ndarray, vec_id: np.ndarray, extra: np.ndarray) -> None:
        near = score <= self.bound[query]
        self.held.append((query[near], score[near], vec_id[near], extra[near]))
        self.size += int(near.sum())
        if self.size > 200_000 + 4 * self.k * len(self.bound):
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        query, score, vec_id, extra = (np.concatenate(c) for c in zip(*self.held, strict=True)) if self.held else (np.zeros(0, np.int64),) * 4
        order = np.lexsort((vec_id, score, query))
        query, score, vec_id, extra = query[order], score[order], vec_id[order], extra[order]
        place = np.arange(len(query)) - np.searchsorted(query, query)
        keep = place < self.k
        full = place == self.k - 1
        self.bound[query[full]] = score[full]
        self.held = [(query[keep], score[keep], vec_id[keep], extra[keep])]
        self.size = int(keep.sum())
        return self.held[0]


def _candidates(q: np.ndarray, x: np.ndarray, bound: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that can be among the k nearest: squared distances as products, with a margin above their rounding."""
    size_q, size_x = (q * q).sum(1), (x * x).sum(1)
    with np.errstate(over="ignore", invalid="ignore"):
        far = size_q[:, None] + size_x - 2 * q @ x.T
    margin = 1e-12 * (size_q + size_x.max(initial=0))
    most = bound ** 2 * (1 + 1e-12) + margin
    if len(x) > k:
        most = np.minimum(most, np.partition(far, k, axis=1)[:, k] + 2 * margin)
    return np.nonzero(~(far > most[:, None]))  # what overflows is a candidate too


def nearest(vectors: DataFrame, *, k: int = 10, query_every: int = 100, tables: int = 4, recall: float = 0.98, sample: int = 64,
            per_bucket: int = 32, shard_values: int = 1 << 19, query_block: int = 2048, seed: int = 11, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of every row whose id is divisible by ``query_every``.

    Every row is indexed in each table. Neighbouring buckets lie in a shard of about ``shard_values`` numbers. A query is sent once
    to each shard it probes, with the buckets to look into; shards that hold more are cut in blocks of rows and of queries,
    and only the k nearest leave a block. Equal vectors are one point that carries its k + 1 smallest ids, as many as an answer can name.

    ``recall`` is the share of true neighbours of ``sample`` queries that lie in probed buckets (their neighbours are
    searched among all rows, so this grows with the table). Where neighbours are hardly nearer than other rows the reach, and the
    work, grow up to that of comparing all. Vectors of other lengths than the commonest have one bucket a length, all of which is compared.

    Vectors that are null, zero or hold null or non-finite components take no part, nor do rows without an id. Rows are told apart by
    id: none with the query's id is an answer, equal rows count once, and different vectors under one id are ranked each (as queries and as
    answers). Only vectors of a query's length can be its neighbours. An empty table gives no rows.
    """
    single = vectors.schema[vector_col].dataType.elementType == T.FloatType()
    kind = np.dtype(np.float32 if single else np.float64)
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("v"))
    usable = F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    valid = rows.where(F.coalesce(usable, F.lit(False))).distinct()
    # the limit is taken before the rows are dealt out, so a vector that a third of all rows repeat is a few rows a task
    first = Window.partitionBy("v").orderBy("id")
    firsts = valid.withColumn("place", F.row_number().over(first)).where(F.col("place") <= k + 1)
    points = stored(firsts.groupBy("v").agg(F.array_sort(F.collect_list("id")).alias("ids")), "points")
    asked = stored(valid.where(F.pmod("id", F.lit(query_every)) == 0).select("id", "v"), "queries")
    sizes = points.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    index = Polytopes.make(sizes.dim, sizes["count"], tables, per_bucket, seed)
    reach = fitted_reach(points, asked, index, k, recall, sample)
    shards = max(1, min(index.buckets, -(-sizes["count"] * index.dim // shard_values)))
    found = _search(_placed(points, index, kind, shards), _asked(asked, index, kind, shards, reach), kind, k,
                    max(1, shard_values * 2 // index.dim), query_block)
    order = Window.partitionBy("query_id", "query").orderBy("score", "vec_id")
    ranked = found.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def fitted_reach(points: DataFrame, asked: DataFrame, index: Polytopes, k: int, recall: float, sample: int) -> float:
    """The cost at which the wanted share of the true neighbours of some queries lies in a probed bucket of some table."""
    some = asked.where(F.size("v") == index.dim).orderBy(F.xxhash64("id", F.lit(3)), "id", "v").limit(sample).collect()
    if not some:
        return 0.0
    own = np.array([r.id for r in some])
    q = np.array([r.v for r in some], np.float64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(len(q), k)
        costs = [index.costs(_unit(q), t) for t in range(index.tables)]
        for b in batches:
            if not b.num_rows:
                continue
            x = np.array(b.column(0).to_pylist(), np.float64)
            i, j = _candidates(q, x, best.bound, k + 1)
            score = _distance(q[i], x[j])
            unit = _unit(x)
            cost = np.min([index.cost_of(costs[t], i, index.bucket(unit, t)[j]) for t in range(index.tables)], axis=0)
            _offer_ids(best, own, i, j, score, b.column(1), cost)
        query, score, vec_id, cost = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(score, pa.float64()), pa.array(vec_id), pa.array(cost, pa.float64())],
                                         ["query", "score", "vec_id", "cost"])

    near = points.where(F.size("v") == index.dim).select("v", "ids").mapInArrow(search, "query long, score double, vec_id long, cost double")
    place = F.row_number().over(Window.partitionBy("query").orderBy("score", "vec_id"))
    costs = sorted(r.cost for r in near.withColumn("place", place).where(F.col("place") <= k).select("cost").collect())  # sample * k
    return costs[min(len(costs), int(np.ceil(recall * len(costs)))) - 1] * (1 + 1e-9) + 1e-12 if costs else 0.0


def _offer_ids(best: Best, own: np.ndarray, i: np.ndarray, j: np.ndarray, score: np.ndarray, ids: pa.Array, extra: np.ndarray) -> None:
    """Offer each pair under every id of the point but the query's own."""
    flat, n = ids.flatten().to_numpy(), np.diff(ids.offsets.to_numpy())
    start = np.cumsum(n) - n
    times = n[j]
    inside = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
    vec_id, query = flat[np.repeat(start[j], times) + inside], np.repeat(i, times)
    other = vec_id != own[query]
    best.offer(query[other], np.repeat(score, times)[other], vec_id[other], np.repeat(extra, times)[other])


def _placed(points: DataFrame, index: Polytopes, kind: np.dtype, shards: int) -> DataFrame:
    """``shard, bucket, ids, vector``: every point once in each table; lengths without an index are shards of their own."""
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = [np.array(v, kind) for v in b.column(0).to_pylist()]
            main = np.array([i for i, v in enumerate(raw) if len(v) == index.dim], np.int64)
            rest = [i for i, v in enumerate(raw) if len(v) != index.dim]
            cells = pa.array([v.tobytes() for v in raw], pa.binary())
            if len(main):
                unit = _unit(np.stack([raw[i] for i in main]).astype(np.float64))
                for t in range(index.tables):
                    bucket = index.bucket(unit, t)
                    yield pa.RecordBatch.from_arrays([pa.array(t * shards + bucket * shards // index.buckets), pa.array(bucket), b.column(1).take(pa.array(main)),
                                                      cells.take(pa.array(main))], ["shard", "bucket", "ids", "vector"])
            if rest:
                at = pa.array(rest)
                yield pa.RecordBatch.from_arrays([pa.array([-len(raw[i]) for i in rest], pa.int64()), pa.array([0] * len(rest), pa.int64()),
                                                  b.column(1).take(at), cells.take(at)], ["shard", "bucket", "ids", "vector"])

    return points.select("v", "ids").mapInArrow(place, "shard long, bucket long, ids array<long>, vector binary")


def _asked(asked: DataFrame, index: Polytopes, kind: np.dtype, shards: int, reach: float) -> DataFrame:
    """``shard, query_id, query, vector, probes``: every query once for each shard it probes; ``query`` tells vectors of one id apart."""
    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for i, v, h in zip(*(c.to_pylist() for c in b.columns), strict=True):
                x = np.array(v, kind)
                visits = [(-len(x), np.zeros(1, np.int64))]
                if len(x) == index.dim:
                    visits = []
                    for t in range(index.tables):
                        bucket = probes(index.costs(_unit(x[None].astype(np.float64)), t), 0, reach)
                        of = bucket * shards // index.buckets
                        start = np.flatnonzero(np.diff(of, prepend=-1))
                        visits += zip((t * shards + of[start]).tolist(), np.split(bucket, start[1:]), strict=True)
                for shard, bucket in visits:
                    for o, value in zip(out, (shard, i, h, x.tobytes(), bucket.astype("<i8").tobytes()), strict=True):
                        o.append(value)
                if len(out[0]) > 5_000:
                    yield _batch(out)
                    out = ([], [], [], [], [])
            yield _batch(out)

    def _batch(out: tuple[list, ...]) -> pa.RecordBatch:
        kinds = (*[pa.int64()] * 3, pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds, strict=True)], ["shard", "query_id", "query", "vector", "probes"])

    return asked.select("id", "v", F.xxhash64("v")).mapInArrow(ask, "shard long, query_id long, query long, vector binary, probes binary")


def _search(placed: DataFrame, visits: DataFrame, kind: np.dtype, k: int, point_block: int, query_block: int) -> DataFrame:
    """``query_id, query, score, vec_id``: the k nearest of each visiting query in each block of its shard."""
    def blocks(n: Column, of: int) -> Column:
        return F.greatest(F.lit(1), F.ceil(n / of)).cast("int")

    placed, visits = stored(placed, "placed"), stored(visits, "visits")
    counts = placed.groupBy("shard").count().withColumnRenamed("count", "points").join(
        visits.groupBy("shard").count().withColumnRenamed("count", "guests"), "shard")  # shards that nobody probes go
    counts = counts.select("shard", blocks(F.col("points"), point_block).alias("across"), blocks(F.col("guests"), query_block).alias("down"))
    every = placed.join(counts, "shard").withColumns({
        "i": F.pmod(F.xxhash64("vector"), F.col("across")).cast("int"), "j": F.explode(F.sequence(F.lit(0), F.col("down") - 1))})
    guests = visits.join(counts, "shard").withColumns({
        "j": F.pmod(F.xxhash64("query_id", "query"), F.col("down")).cast("int"), "i": F.explode(F.sequence(F.lit(0), F.col("across") - 1))})
    both = every.drop("across", "down").unionByName(guests.drop("across", "down"), allowMissingColumns=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_groups(batches, ["shard", "i", "j"]):
            home = part["bucket"].is_valid()
            here, guest = part.filter(home), part.filter(pc.invert(home))
            if not here.num_rows or not guest.num_rows:
                continue
            x, q = _read(here["vector"], kind), _read(guest["vector"], kind)
            ids, own, bucket = here["ids"].combine_chunks(), np.array(guest["query_id"]), np.array(here["bucket"])
            wanted = [np.frombuffer(p, "<i8") for p in guest["probes"].to_pylist()]
            who = np.repeat(np.arange(len(wanted)), [len(w) for w in wanted])
            probed = np.concatenate(wanted)
            order = np.argsort(probed, kind="stable")
            who, probed = who[order], probed[order]
            best = Best(len(q), k)
            start = np.flatnonzero(np.diff(bucket, prepend=-1))  # rows come sorted by bucket
            for a, b in zip(start.tolist(), [*start[1:].tolist(), len(bucket)], strict=True):
                into = who[np.searchsorted(probed, bucket[a]):np.searchsorted(probed, bucket[a], "right")]
                for c in range(a, b, 4096):
                    for d in range(0, len(into), 1024):
                        some, near = into[d:d + 1024], x[c:min(b, c + 4096)]
                        i, j = _candidates(q[some], near, best.bound[some], k + 1)
                        i, j = some[i], j + c
                        _offer_ids(best, own, i, j, _distance(q[i], x[j]), ids, np.zeros(len(i)))
            query, score, vec_id, _ = best.cut()
            yield pa.RecordBatch.from_arrays([pa.array(own[query]), guest["query"].combine_chunks().take(pa.array(query)), pa.array(score, pa.float64()),
                                              pa.array(vec_id, pa.int64())], ["query_id", "query", "score", "vec_id"])

    keys = ["shard", "i", "j"]
    return both.repartition(*keys).sortWithinPartitions(*keys, "bucket").mapInArrow(run, FOUND)
