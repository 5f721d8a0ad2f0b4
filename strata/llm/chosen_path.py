"""N-gram Jaccard join by chosen paths.

A set's path in a run is the sequence of tokens that a run's hash functions sample from it, level by level; two sets
agree on a level with a probability equal to their Jaccard similarity. A bucket of one path is split on the next
sampled token until it is small or the path ends, and is then compared by brute force, in blocks where it is large.
Runs are repeated until a pair at the threshold is met with the target recall even at the deepest level.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks
from .common import forget, stored
from .components import components, spanning
from .wordhash import BY_LETTER, chunks, mix, rolling, words

WIDTH = 5
LEVELS = 3


def runs_for(recall: float, similarity: float, levels: int) -> int:
    """Runs after which a pair shares the deepest bucket of one of them with probability ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - similarity**levels))


def shingles(texts: list[str | None], width: int = WIDTH):
    """Shingle hashes of each text one after the other, their offsets, and two hashes of each text's word sequence.

    Words are lower-cased runs of ASCII letters, ASCII digits and characters outside ASCII. A text of fewer words than
    ``width`` is one shingle; a text without words has none.
    """
    _, _, _, hashes, at = words(texts, BY_LETTER, lower=True)
    n = np.diff(at)
    rolled = mix(rolling(hashes, width) ^ np.uint64(0x5851F42D4C957F2D))
    size = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    offsets = np.concatenate(([0], np.cumsum(size)))
    out = np.empty(offsets[-1], np.uint64)
    inside = np.zeros(len(hashes), bool)
    position = np.arange(len(hashes)) - np.repeat(at[:-1], n)
    owner_n = np.repeat(n, n)
    inside = position <= owner_n - width
    firsts = np.repeat(n >= width, n)
    long_slots = np.repeat(n >= width, size)
    out[long_slots] = rolled[np.flatnonzero(inside & firsts)] if long_slots.any() else 0
    one, two = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
    if len(hashes):
        # a polynomial of the word hashes by two bases, so the order counts
        for target, base in ((one, 0x9E3779B97F4A7C15), (two, 0xD1342543DE82EF95)):
            power = np.full(int(n.max()), np.uint64(base), np.uint64)
            power = np.cumprod(power, dtype=np.uint64)
            terms = hashes * power[position]
            full = n > 0
            target[full] = np.add.reduceat(terms, at[:-1][full])
        out[~long_slots] = mix(one[(n > 0) & (n < width)])
    return out, offsets, mix(one) , mix(two ^ np.uint64(1))


def signatures(out: np.ndarray, offsets: np.ndarray, runs: int, levels: int) -> np.ndarray:
    """For each non-empty set, run and level the sampled token: the one that the level's hash function puts first."""
    rng = np.random.default_rng(11)
    keys = rng.integers(1, 2**63, (runs, levels), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    at = offsets[:-1][np.diff(offsets) > 0]
    result = np.empty((len(at), runs, levels), np.uint64)
    for r in range(runs):
        for k in range(levels):
            result[:, r, k] = np.minimum.reduceat(out * keys[r, k], at) if len(at) else 0
    return result


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64), pa.int64())


def classes_of(docs: DataFrame, runs: int, levels: int) -> DataFrame:
    """``doc_id, one, two, paths`` of every document: its word sequence's hashes and its paths, run by run."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rng = np.random.default_rng(13)
        salt = rng.integers(1, 2**63, runs, dtype=np.uint64)
        for b in batches:
            texts = b.column(1).to_pylist()
            for i, j in chunks(texts):
                out, offsets, one, two = shingles(texts[i:j])
                full = np.diff(offsets) > 0
                tokens = signatures(out, offsets, runs, levels)
                path, parts = np.broadcast_to(salt, tokens.shape[:2]), []
                for k in range(levels):
                    path = mix(path ^ mix(tokens[:, :, k]))
                    parts.append(path)
                flat = np.stack(parts, 2).reshape(len(tokens), -1) if len(tokens) else np.zeros((0, runs * levels), np.uint64)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.concatenate(([0], np.cumsum(np.where(full, runs * levels, 0)))), pa.int32()), _signed(flat.ravel()))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), _signed(one), _signed(two), lists],
                                                 ["doc_id", "one", "two", "paths"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        run, "doc_id long, one long, two long, paths array<long>")


def _bucketed(reps: DataFrame, runs: int, levels: int, small: int) -> DataFrame:
    """``id, group, members``: the buckets of two or more sets, split until small; equal buckets of several runs once."""
    at = F.explode(F.sequence(F.lit(0), F.lit(runs - 1)))
    rows = reps.select("id", "paths", at.alias("run"))
    rows = rows.select("id", *[F.get("paths", F.col("run") * levels + k).alias(f"p{k}") for k in range(levels)])
    parts, rest = [], rows
    for k in range(levels):
        counts = rest.groupBy(f"p{k}").agg(F.count("*").alias("n")).where("n > 1")
        here = stored(rest.join(counts, f"p{k}"), "buckets")
        last = k == levels - 1
        parts.append((here if last else here.where(F.col("n") <= small)).select("id", F.col(f"p{k}").alias("bucket")))
        if not last:
            rest = here.where(F.col("n") > small).drop("n")
    members = parts[0]
    for part in parts[1:]:
        members = members.union(part)
    members = members.distinct()
    content = members.groupBy("bucket").agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("id")).alias("x"),
                                            F.bit_xor(F.xxhash64("id", F.lit(1))).alias("y"))
    same = content.groupBy("members", "x", "y").agg(F.min("bucket").alias("bucket"))
    return members.join(same.select("bucket", "members"), "bucket").select("id", F.col("bucket").alias("group"), "members")


def _in_buckets(sets: DataFrame) -> DataFrame:
    """A row of each set for each of its buckets, which it brings along: sets are shuffled by bucket only."""
    each = sets.select("id", "copies", "tokens", "groups", F.explode("groups").alias("at"))
    return each.select("id", "copies", "tokens", F.col("groups.group").alias("groups"), "at.group", "at.members")


def join(docs: DataFrame, *, similarity: float = 0.8, recall: float = 0.9995, width: int = WIDTH, levels: int = LEVELS,
         small: int = 128, block: int = 256) -> DataFrame:
    """``doc_id, class_id, n_links, component_id, kept`` for every document.

    Documents of one word sequence are a class, named by its smallest doc_id; only classes are joined, under a key of
    their own. ``n_links`` counts the other documents at ``similarity`` or more, copies included. ``component_id`` is the smallest doc_id
    reachable by links, and kept says that the document is its own. A pair is counted in the first bucket it shares.

    Null texts, texts without words and null ids link with nothing (their class is their own id). Rows that repeat an id
    are copies of one another if their word sequence is equal, otherwise documents of their own, each with its own
    links. Other columns are ignored; an empty table gives no rows.
    """
    runs = runs_for(recall, similarity, levels)
    hashed = stored(classes_of(docs, runs, levels), "paths")
    usable = F.col("doc_id").isNotNull() & (F.size("paths") > 0)
    worded = hashed.where(usable)
    held = worded.groupBy("one", "two", "doc_id").agg(F.count("*").alias("n"))
    classes = held.groupBy("one", "two").agg(F.min(F.struct("doc_id", "n")).alias("first"), F.sum("n").alias("copies"))
    # the key is fixed when the table is written; several texts can have one doc_id
    classes = stored(classes.select("one", "two", F.col("first.doc_id").alias("first"), F.col("first.n").alias("rows"), "copies",
                                    F.monotonically_increasing_id().alias("id")), "classes")
    # a class is read from a row of its smallest document
    reps = worded.join(classes, ["one", "two"]).where(F.col("doc_id") == F.col("first")).select("id", "paths").dropDuplicates(["id"])
    buckets = stored(_bucketed(reps, runs, levels, small), "members")
    own = buckets.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("group", "members"))).alias("groups"))  # one for each run at most
    texts = docs.select(F.col("doc_id").cast("long").alias("first"), F.col("text").cast("string").alias("text"))
    chosen = texts.join(own.join(classes, "id"), "first").select("id", "copies", "groups", "text", "one", "two", "rows")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, same, texts = [], [], b.column(3).to_pylist()
            for i, j in chunks(texts):
                out, offsets, one, two = shingles(texts[i:j], width)
                held += [np.unique(out[s:e]).tobytes() for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
                same += [_signed(one), _signed(two)]
            # another text under the id of the class is not its text
            own_text = [pc.equal(b.column(4 + k), pa.concat_arrays(same[k::2])) for k in (0, 1)] if same else []
            made = pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(held, pa.binary()), b.column(6)],
                                              ["id", "copies", "groups", "tokens", "rows"])
            yield made.filter(pc.and_(*own_text)) if same else made

    made = stored(chosen.mapInArrow(sets, "id long, copies long, groups array<struct<group:long,members:long>>, tokens binary, rows long"), "sets")
    forget(buckets)
    # a document that is there several times gives its set once
    tokens = made.where("rows = 1").union(made.where("rows > 1").dropDuplicates(["id"])).drop("rows")
    kernel = _kernel(similarity)
    found = stored(blocks.compare(_in_buckets(tokens), block, kernel), "text-links")
    degree = found.where("links IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    linked = components(found.where("b IS NOT NULL")).withColumnRenamed("node", "id")
    least = linked.join(classes, "id").groupBy("component").agg(F.min("first").alias("least"))
    linked = linked.join(least, "component").select("id", "least")
    forget(made)
    result = classes.join(degree, "id", "left").join(linked, "id", "left").select(
        "one", "two", F.col("first").alias("class_id"), (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
        F.coalesce("least", "first").alias("component_id"))
    alone = hashed.where(~usable | usable.isNull()).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"),
        F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return worded.select("doc_id", "one", "two").join(result, ["one", "two"]).select(
        "doc_id", "class_id", "n_links", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept")).union(alone)


def _kernel(similarity: float):
    def read(t: pa.Table):
        raw = [np.frombuffer(x, np.uint64) for x in t["tokens"].to_pylist()]
        return np.array(t["id"]), np.array(t["copies"]), t["groups"].to_pylist(), raw

    def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
        """How many tokens each of a shares with each of b; tokens of one set only are left out first."""
        every = np.concatenate([*a, *b]) if b is not a else np.concatenate(a)
        sizes = [len(x) for x in a] + ([len(x) for x in b] if b is not a else [])
        _, column, count = np.unique(every, return_inverse=True, return_counts=True)
        row = np.repeat(np.arange(len(sizes)), sizes)
        often = count[column] > 1
        row, column = row[often], column[often]
        _, column = np.unique(column, return_inverse=True)
        wide = int(column.max()) + 1 if len(column) else 0
        total = np.zeros((len(a), len(b)), np.float32)
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        for s in range(0, wide, 4096):
            lo, hi = np.searchsorted(column, (s, s + 4096))
            dense = np.zeros((len(sizes), min(4096, wide - s)), np.float32)
            dense[row[lo:hi], column[lo:hi] - s] = 1
            total += dense[:len(a)] @ (dense if b is a else dense[len(a):]).T
        return total

    def kernel(a: pa.Table, b: pa.Table | None, group: int):
        a_ids, a_copies, a_groups, a_sets = read(a)
        b_ids, b_copies, b_groups, b_sets = read(b) if b is not None else (a_ids, a_copies, a_groups, a_sets)
        shared = overlaps(a_sets, b_sets)
        sizes = np.array([len(x) for x in a_sets], np.float32)[:, None] + np.array([len(x) for x in b_sets], np.float32)
        hit = shared >= similarity * (sizes - shared) - 1e-4
        if b is None:
            hit &= np.arange(len(a_ids))[:, None] < np.arange(len(b_ids))
        i, j = np.nonzero(hit)
        if len(i):
            # integers decide at the threshold, and the first common bucket counts the pair
            common, total = shared[i, j].astype(np.int64), sizes[i, j].astype(np.int64)
            good = common >= similarity * (total - common) - 1e-9
            width = max(map(len, [*a_groups, *b_groups]))
            padded = [np.array([[*g, *[-1] * (width - len(g))] for g in groups], np.int64) for groups in (a_groups, b_groups)]
            missing = [np.array([[False] * len(g) + [True] * (width - len(g)) for g in groups]) for groups in (a_groups, b_groups)]
            for s in range(0, len(i), 50_000):
                p, q = i[s:s + 50_000], j[s:s + 50_000]
                both = (padded[0][p][:, :, None] == padded[1][q][:, None, :]) & ~missing[0][p][:, :, None] & ~missing[1][q][:, None, :]
                first = np.where(both.any(2), padded[0][p], np.iinfo(np.int64).max).min(1)
                good[s:s + 50_000] &= first == group
            i, j = i[good], j[good]
        if not len(i):
            return [], [], []
        nodes, roots = spanning(a_ids[i], b_ids[j])
        ids, at = np.unique(np.concatenate([a_ids[i], b_ids[j]]), return_inverse=True)
        links = np.bincount(at, np.concatenate([b_copies[j], a_copies[i]]), len(ids)).astype(np.int64).tolist()
        return nodes + ids.tolist(), roots + [None] * len(ids), [None] * len(nodes) + links

    return kernel


JOIN_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[a-z0-9\x{80}-\x{10FFFF}]+') AS w FROM documents),
c AS (SELECT min(doc_id) AS class_id, count(*) AS copies, w FROM w WHERE len(w) > 0 AND doc_id IS NOT NULL GROUP BY w),
s AS (SELECT DISTINCT class_id, unnest(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM c),
z AS (SELECT class_id, count(*) AS n FROM s GROUP BY class_id),
p AS (SELECT a.class_id AS a, b.class_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.class_id <> b.class_id GROUP BY ALL),
l AS (SELECT p.a, p.b FROM p JOIN z x ON x.class_id = p.a JOIN z y ON y.class_id = p.b WHERE k >= 0.8 * (x.n + y.n - k)),
r AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
m AS (SELECT a, min(b) AS b FROM r GROUP BY a),
d AS (SELECT l.a, sum(c.copies) AS n FROM l JOIN c ON c.class_id = l.b GROUP BY l.a)
SELECT w.doc_id, coalesce(c.class_id, w.doc_id) AS class_id, coalesce(d.n + copies - 1, copies - 1, 0)::BIGINT AS n_links,
       least(coalesce(c.class_id, w.doc_id), m.b) AS component_id,
       coalesce(w.doc_id = least(coalesce(c.class_id, w.doc_id), m.b), true) AS kept
FROM w LEFT JOIN c ON c.w = w.w AND len(w.w) > 0 AND w.doc_id IS NOT NULL
LEFT JOIN m ON m.a = c.class_id LEFT JOIN d ON d.a = c.class_id
"""
