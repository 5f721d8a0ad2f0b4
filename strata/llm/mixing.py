"""Mixing sources to target weights: exact budgets by hash-random order and distributed prefix sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, stored, word_count


def _source_key(source: Column) -> Column:
    # sorts by code point, null last
    return F.when(source.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), source.cast("string")))


def targets(per_source: DataFrame, weights: tuple[int, ...], most: int) -> DataFrame:
    """``skey, source_size`` (a row for each source) -> also ``target``, by weight and at most ``most`` sizes.

    Filling by weight with ceilings has one level: target = min(ceiling, weight * level). With the sources in the
    order of ceiling / weight, the level is the largest of (what is left) / (weights left) over all prefixes.
    """
    ranked = per_source.withColumn("rank", F.row_number().over(Window.orderBy("skey")) - 1)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.pmod("rank", F.lit(len(weights))) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight.cast("long"))
    filled = Window.orderBy(F.col("source_size") * most / F.col("weight"), "skey")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    rest = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    left = F.sum("source_size").over(rest) - F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0))
    weights_left = F.sum("weight").over(rest) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    levels = ranked.withColumn("level", left.cast("double") / weights_left.cast("double"))
    levels = levels.withColumn("level", F.max("level").over(rest))
    target = F.least(F.col("source_size") * F.lit(float(most)), F.col("weight") * F.col("level"))
    return levels.select("skey", "source_size", target.alias("target"))


def mix(docs: DataFrame, carry: list[str], *, text: str = "text", source: str = "source", doc_id: str = "doc_id",
        weights: tuple[int, ...] = (5, 2, 1), most: int = 3, seed: str = "mix", digits: int = 3) -> DataFrame:
    """``row`` (struct of ``carry``), ``size``, ``source_size``, ``target``, ``taken`` for every document.

    Every document gets a random key, the hash of its id, and so one of 16**digits buckets of its source. Prefix
    sums run within a bucket and over the buckets' totals, so a source that holds most rows is spread over all tasks.
    A source's budget is its target rounded down; it takes whole epochs of the source and then documents in key order
    up to the budget, the last one in part.

    Null or empty text: size 0, takes nothing. Null source: a source of its own, last. Null id: an id of its own,
    equal for all such rows. Repeated rows count each; ties of the key go by size, so equal rows are interchangeable.
    An empty table gives no rows. Other columns of any name travel inside ``row``.
    """
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))).cast("binary"))
    sized = stored(
        docs.select(F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row"), word_count(F.col(text)).alias("size"),
                    _source_key(F.col(source)).alias("skey"), key.alias("key"))
        .withColumn("bucket", F.substring("key", 1, digits)), "mix-sized")
    in_bucket = sized.groupBy("skey", "bucket").agg(F.sum("size").alias("bucket_size"))
    goal = targets(in_bucket.groupBy("skey").agg(F.sum("bucket_size").alias("source_size")), weights, most)
    earlier = Window.partitionBy("skey").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    buckets = (
        in_bucket.withColumn("offset", F.coalesce(F.sum("bucket_size").over(earlier), F.lit(0)))
        .join(goal, "skey")
        .select("skey", "bucket", "offset", "source_size", "target", epochs.alias("epochs"),
                (budget - epochs * F.col("source_size")).alias("rest"))
    )
    within = Window.partitionBy("skey", "bucket").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = sized.withColumn("before", F.coalesce(F.sum("size").over(within), F.lit(0)))
    start = F.col("offset") + F.col("before")
    part = F.greatest(F.lit(0), F.least(F.col("size"), F.col("rest") - start))
    return placed.join(buckets, ["skey", "bucket"]).select(
        "row", "size", "source_size", "target", (F.col("epochs") * F.col("size") + part).alias("taken"))


def realise(mixed: DataFrame, text: str = "text") -> DataFrame:
    """The mixed documents as rows of their own columns: one copy for each whole epoch, the first words for a part."""
    row = mixed.schema["row"].dataType.fieldNames()
    words = F.split(F.btrim(F.col(f"row.{text}"), F.lit(" \t\n\x0b\x0c\r")), SPACE_CLASS + "+")
    copies = mixed.where("taken > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.ceil(F.col("taken") / F.col("size")).cast("long"))))
    left = F.col("taken") - (F.col("copy") - 1) * F.col("size")
    cut = F.when(left >= F.col("size"), F.col(f"row.{text}")).otherwise(
        F.array_join(F.slice(words, F.lit(1), left.cast("int")), " "))
    out = copies.select(*[cut.alias(c) if c == text else F.col(f"row.`{c}`").alias(c) for c in row])
    return out.withColumn("n_chars", F.length(text).cast(out.schema["n_chars"].dataType)) if "n_chars" in row else out


# DuckDB SQL of the query over all documents.
MIX_SQL = r"""
WITH d AS (
  SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, source,
         coalesce('0' || source, '1') AS skey, md5('mix' || coalesce(doc_id::VARCHAR, '')) AS k FROM documents),
s AS (SELECT skey, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY skey) - 1 AS rank FROM d GROUP BY skey),
w AS (SELECT *, [5, 2, 1][(rank % 3)::INT + 1]::BIGINT AS weight FROM s),
l AS (SELECT *, ((sum(source_size) OVER ())::BIGINT - coalesce(sum(source_size * 3) OVER b, 0)::BIGINT)::DOUBLE
                / ((sum(weight) OVER ())::BIGINT - coalesce(sum(weight) OVER b, 0)::BIGINT)::DOUBLE AS level FROM w
      WINDOW b AS (ORDER BY source_size * 3 / weight, skey ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT skey, source_size, least(source_size * 3.0::DOUBLE, weight * max(level) OVER ()) AS target FROM l),
e AS (SELECT *, floor(target)::BIGINT AS budget, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY skey ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM d)
SELECT p.doc_id, p.size, e.source_size, e.target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM p JOIN e ON p.skey = e.skey
"""
