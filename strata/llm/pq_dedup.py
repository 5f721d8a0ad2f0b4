"""Embedding near-dedup by product quantisation.

Coarse inverted lists, residual subspace codes with the error of each code kept, code distances over the lists that can
hold a neighbour, and an exact cosine rerank. Every filter is a bound, so no link is lost whatever the vectors look like:
a list is probed if the bisecting hyperplane towards its centroid is within the full distance, and a code is a candidate
if its distance less its error is within reach. In many dimensions that probes most lists, so vectors are not sent to the
lists: they first meet shards of codes alone, and only the lists that hold a candidate get the vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks
from .common import sorted_groups, stored
from .components import components, spanning


@dataclass
class Index:
    """Centroids of the lists and of the subspaces; both of bounded number, so an index can be sent to every task."""
    coarse: np.ndarray
    books: np.ndarray  # subspace, code, dimension within the subspace

    @property
    def dim(self) -> int:
        return self.coarse.shape[1]


def _kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    k = max(1, min(k, len(x)))
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        near = (x @ c.T * -2 + (c * c).sum(1)).argmin(1)
        count = np.bincount(near, minlength=k)
        for d in range(x.shape[1]):
            c[:, d] = np.where(count > 0, np.bincount(near, x[:, d], k) / np.maximum(count, 1), c[:, d])
    return c


def fit(sample: np.ndarray, lists: int, subspaces: int = 16, codes: int = 256, seed: int = 3) -> Index:
    rng = np.random.default_rng(seed)
    dim = sample.shape[1]
    m = max(d for d in range(1, min(subspaces, dim) + 1) if dim % d == 0)
    coarse = _kmeans(sample, lists, rng)
    near = (sample @ coarse.T * -2 + (coarse * coarse).sum(1)).argmin(1)
    rest = (sample - coarse[near]).reshape(len(sample), m, dim // m)
    size = min(codes, len(sample))
    return Index(coarse, np.stack([_kmeans(rest[:, k], size, rng) for k in range(m)]))


def probed(index: Index, x: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray]:
    """Home list of unit vectors, and which lists of a smaller number can hold a vector within reach."""
    c = index.coarse
    d2 = np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1))
    home = d2.argmin(1)
    gap = (d2 - d2[np.arange(len(x)), home][:, None]) / 2
    between = np.sqrt(np.maximum(1e-30, (c * c).sum(1)[:, None] + (c * c).sum(1) - 2 * c @ c.T))
    return home, (gap <= reach * between[home] + 1e-9) & (np.arange(len(c)) < home[:, None])


def encode(index: Index, x: np.ndarray, home: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes and code errors of unit vectors."""
    rest = (x - index.coarse[home]).reshape(len(x), *index.books.shape[::2])
    codes = np.empty((len(x), len(index.books)), np.uint8)
    error = np.zeros(len(x))
    for k, book in enumerate(index.books):
        d = (rest[:, k] ** 2).sum(1)[:, None] - 2 * rest[:, k] @ book.T + (book * book).sum(1)
        codes[:, k] = d.argmin(1)
        error += ((rest[:, k] - book[codes[:, k]]) ** 2).sum(1)
    return codes, np.sqrt(error)


def _holds(index: Index, queries: np.ndarray, group: int, codes: np.ndarray, error: np.ndarray, reach: float) -> np.ndarray:
    """Which unit queries have a candidate among coded rows of one list: the sums of the lookup tables as one product."""
    coded = index.coarse[group] + np.concatenate([book[codes[:, k]] for k, book in enumerate(index.books)], axis=1)
    # |q - y| <= reach + error, solved for q . y; the margin covers single precision
    least = (1 + (coded * coded).sum(1) - (reach + error) ** 2) / 2 - 1e-4
    y, least = coded.astype(np.float32).T, least.astype(np.float32)
    return np.concatenate([(queries[k:k + 1024].astype(np.float32) @ y >= least).any(1) for k in range(0, len(queries), 1024)])


def _within(index: Index, queries: np.ndarray, centroid: np.ndarray, codes: np.ndarray, error: np.ndarray, reach: float) -> np.ndarray:
    """Which coded rows of one list may be within reach of each query: tables once for a query, then lookups."""
    rest = (queries - centroid).reshape(len(queries), *index.books.shape[::2])
    far = np.zeros((len(queries), len(codes)))
    for k, book in enumerate(index.books):
        table = (rest[:, k] ** 2).sum(1)[:, None] - 2 * rest[:, k] @ book.T + (book * book).sum(1)
        far += table[:, codes[:, k]]
    return np.sqrt(np.maximum(far, 0)) - error <= reach


def dedup(vectors: DataFrame, *, threshold: float = 0.9, sample_rows: int = 20_000, most_lists: int = 1024,
          block: int = 2048, shard: int = 65_536, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row.

    Equal vectors are one point with a multiplicity, so copies are never paired. The index is fitted on at most
    ``sample_rows`` points chosen by hash, and every point is indexed. ``shard`` is the number of codes that a vector
    meets at once. Links are counted block by block; only a spanning forest of each block pair is written.

    Vectors that are null, zero, or hold null or non-finite components link with nothing, as do rows with a null id;
    vectors link only with those of their own length. Lengths other than the commonest have no lists but one, so all
    their pairs are compared. Rows that repeat an id with another vector share their links. An empty table gives no rows.
    """
    reach = math.sqrt(2 - 2 * threshold) + 1e-6
    single = vectors.schema[vector_col].dataType.elementType == T.FloatType()
    kind = np.dtype(np.float32 if single else np.float64)
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<float>" if single else "array<double>").alias("v"))
    whole = F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall(
        "v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf")))) & F.exists("v", lambda x: x != 0)
    usable = F.coalesce(whole, F.lit(False))
    valid = rows.where(usable).withColumn("h", F.xxhash64("v"))
    points = stored(valid.groupBy("h", "v").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies")), "points")
    sizes = points.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), "dim").first()
    if sizes is None:
        return _alone(rows)
    chosen = points.where(F.size("v") == sizes.dim).orderBy(F.xxhash64("id", F.lit(5)), "id").limit(sample_rows).select("v").collect()
    sample = _unit(np.array([r.v for r in chosen]))
    index = fit(sample, max(1, min(most_lists, round(math.sqrt(sizes["count"]) / 2))))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            h, ids, copies = b.column(0), b.column(1), b.column(3)
            raw = [np.array(v, kind) for v in b.column(2).to_pylist()]
            group = np.array([-len(v) for v in raw], np.int64)
            codes, error = [b""] * len(raw), np.zeros(len(raw))
            main = np.array([k for k, v in enumerate(raw) if len(v) == index.dim], np.int64)
            if len(main):
                x = _unit(np.stack([raw[k] for k in main]))
                group[main] = probed(index, x, reach)[0]
                coded, error[main] = encode(index, x, group[main])
                for k, c in zip(main.tolist(), coded, strict=True):
                    codes[k] = c.tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array(group), h, ids, copies, pa.array(codes, pa.binary()), pa.array(error), pa.array([v.tobytes() for v in raw], pa.binary())],
                ["group", "h", "id", "copies", "codes", "error", "vector"])

    placed = stored(points.select("h", "id", "v", "copies").mapInArrow(
        assign, "group long, h long, id long, copies long, codes binary, error double, vector binary"), "lists")
    asked = _visits(placed.where("group >= 0"), index, kind, reach, shard)
    home = placed.withColumn("home", F.lit(True))
    # a key of its own for every point: ids can repeat
    away = placed.drop("group", "codes", "error").join(asked, ["id", "h"]).withColumns(
        {"home": F.lit(False), "codes": F.lit(b""), "error": F.lit(0.0)})
    listed = stored(home.unionByName(away).drop("h"), "visits")
    sizes = listed.groupBy("group").agg(F.count_if("home").alias("members"), F.count_if(~F.col("home")).alias("guests"))
    listed = listed.join(sizes.where("members > 0"), "group")

    def kernel(a: pa.Table, b: pa.Table | None, group: int):
        def read(t: pa.Table):
            return (np.array(t["id"]), np.array(t["copies"]), np.array(t["home"].to_pylist(), bool), t["codes"].to_pylist(),
                    np.array(t["error"]), _unit(np.frombuffer(b"".join(t["vector"].to_pylist()), kind).reshape(t.num_rows, -1)))

        parts = [read(a)] + ([read(b)] if b is not None else [])
        links: dict[int, int] = {}
        left, right = [], []

        def match(q, x, once: bool):
            q_ids, q_copies, _, _, _, q_unit = q
            stored_rows = np.flatnonzero(x[2])
            if not len(stored_rows) or not len(q_ids):
                return
            x_ids, x_copies, x_unit = x[0][stored_rows], x[1][stored_rows], x[5][stored_rows]
            if group >= 0:
                codes = np.frombuffer(b"".join(x[3][k] for k in stored_rows), np.uint8).reshape(len(stored_rows), -1)
                may = _within(index, q_unit, index.coarse[group], codes, x[4][stored_rows], reach)
            else:
                may = np.ones((len(q_ids), len(x_ids)), bool)
            if once:  # both at home in this block: each pair from one side
                may &= ~q[2][:, None] | (q_ids[:, None] > x_ids)
            i, j = np.nonzero(may)
            for k in range(0, len(i), 200_000):
                p, r = i[k:k + 200_000], j[k:k + 200_000]
                good = np.einsum("ij,ij->i", q_unit[p], x_unit[r]) >= threshold
                p, r = p[good], r[good]
                for ids, other in ((q_ids[p], x_copies[r]), (x_ids[r], q_copies[p])):
                    for node, n in zip(*_sums(ids, other), strict=True):
                        links[node] = links.get(node, 0) + n
                left.append(q_ids[p])
                right.append(x_ids[r])

        if b is None:
            match(parts[0], parts[0], True)
        else:
            match(parts[1], parts[0], False)
            away = ~parts[0][2]
            visiting = tuple(np.array(c, dtype=object)[away].tolist() if isinstance(c, list) else c[away] for c in parts[0])
            match(visiting, parts[1], False)
        nodes, roots = spanning(np.concatenate(left), np.concatenate(right)) if left else ([], [])
        return nodes + list(links), roots + [None] * len(links), [None] * len(nodes) + list(links.values())

    found = stored(blocks.compare(listed, block, kernel, visitors=True), "vector-links")
    degree = found.where("links IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    joined = components(found.where("b IS NOT NULL")).withColumnRenamed("node", "id")
    result = points.join(degree, "id", "left").join(joined, "id", "left").select(
        "h", "v", "copies", F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("component", "id").alias("component_id"))
    members = valid.join(result, ["h", "v"]).select(
        "vec_id", (F.col("links") + F.col("copies") - 1).alias("n_links"), "component_id",
        (F.col("vec_id") == F.col("component_id")).alias("kept"))
    return members.union(_alone(rows.where(~usable)))


def _visits(placed: DataFrame, index: Index, kind: np.dtype, reach: float, shard: int, most: int = 4096) -> DataFrame:
    """``id, group, h``: the lists away from home that hold a candidate of a point by the codes.

    Lists are put together to shards of about ``shard`` codes, long lists cut by hash. A point's vector goes once to each shard
    with a list it probes, in blocks of about ``most`` vectors; of the lists' side only packed codes and errors travel.
    """
    counts = {r["group"]: r["count"] for r in placed.groupBy("group").count().collect()}  # a row for each list
    first, parts, last, room = {}, {}, -1, 0
    for g in sorted(counts):
        parts[g] = -(-counts[g] // shard)
        if counts[g] > room:
            first[g], last = last + 1, last + parts[g]
            room = shard - counts[g] if parts[g] == 1 else 0
        else:
            first[g], room = last, room - counts[g]
    cells = np.zeros((len(index.coarse), last + 1), np.float32)
    for g in counts:
        cells[g, first[g]:first[g] + parts[g]] = 1

    def shards(b: pa.RecordBatch) -> np.ndarray:
        x = _unit(np.frombuffer(b"".join(b.column("vector").to_pylist()), kind).reshape(b.num_rows, -1))
        return probed(index, x, reach)[1].astype(np.float32) @ cells > 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([pa.array(range(last + 1), pa.int64()), pa.array(shards(b).sum(0), pa.int64())], ["shard", "n"])

    guests = placed.select("vector").mapInArrow(count, "shard long, n long").groupBy("shard").agg(F.sum("n").alias("n")).collect()
    blocks_of = {r["shard"]: -(-r["n"] // most) for r in guests}

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            out: tuple[list, ...] = ([], [], [], [], [], [], [])
            group, h, ids = np.array(b.column("group")), b.column("h").to_pylist(), b.column("id").to_pylist()
            codes, error, vectors = b.column("codes").to_pylist(), np.array(b.column("error")), b.column("vector").to_pylist()
            part = np.array([x // 7 % parts[g] for x, g in zip(h, group.tolist(), strict=True)], np.int64)
            for g, p in sorted(set(zip(group.tolist(), part.tolist(), strict=True))):
                rows = np.flatnonzero((group == g) & (part == p))
                packed = b"".join(codes[k] for k in rows)
                for q in range(blocks_of.get(first[g] + p, 0)):
                    for o, value in zip(out, (first[g] + p, q, g, None, None, packed, error[rows].tobytes()), strict=True):
                        o.append(value)
            for k, s in zip(*(x.tolist() for x in np.nonzero(shards(b))), strict=True):
                for o, value in zip(out, (s, h[k] % blocks_of[s], -1, ids[k], h[k], vectors[k], None), strict=True):
                    o.append(value)
            kinds = (*[pa.int64()] * 5, pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds, strict=True)],
                                             ["shard", "part", "list", "id", "h", "bytes", "error"])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in sorted_groups(batches, ["shard", "part"]):
            lists = np.array(t["list"])
            rows = np.flatnonzero(lists < 0)
            if not len(rows):
                continue
            raw, errors = t["bytes"].to_pylist(), t["error"].to_pylist()
            x = _unit(np.frombuffer(b"".join(raw[k] for k in rows), kind).reshape(len(rows), -1))
            near = probed(index, x, reach)[1]
            ids, h = np.array(t["id"].take(pa.array(rows))), np.array(t["h"].take(pa.array(rows)))
            out: tuple[list, ...] = ([], [], [])
            for g in np.unique(lists[lists >= 0]).tolist():
                held, who = np.flatnonzero(lists == g), np.flatnonzero(near[:, g])
                if not len(who):
                    continue
                codes = np.frombuffer(b"".join(raw[k] for k in held), np.uint8).reshape(-1, len(index.books))
                who = who[_holds(index, x[who], g, codes, np.frombuffer(b"".join(errors[k] for k in held)), reach)]
                for o, values in zip(out, (ids[who].tolist(), [g] * len(who), h[who].tolist()), strict=True):
                    o.extend(values)
            yield pa.RecordBatch.from_arrays([pa.array(o, pa.int64()) for o in out], ["id", "group", "h"])

    sent = placed.mapInArrow(send, "shard long, part long, list long, id long, h long, bytes binary, error binary")
    # a list cut over several shards is asked once
    return sent.repartition("shard", "part").sortWithinPartitions("shard", "part").mapInArrow(look, "id long, group long, h long").distinct()


def _alone(rows: DataFrame) -> DataFrame:
    return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))


def _unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one in double precision, without overflow on the way."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _sums(ids: np.ndarray, values: np.ndarray) -> tuple[list[int], list[int]]:
    nodes, at = np.unique(ids, return_inverse=True)
    return nodes.tolist(), np.bincount(at, values, len(nodes)).astype(np.int64).tolist()


DEDUP_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(e.vec_id, m.b) AS component_id,
       coalesce(e.vec_id = least(e.vec_id, m.b), true) AS kept
FROM embeddings e LEFT JOIN m ON m.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""
