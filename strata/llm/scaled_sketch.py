"""Document fingerprints: threshold-scaled sketches, which retain every shingle hash below a fixed fraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_CLASS, SPACES

SHINGLE = 5
FRACTION = 0.25


def sketch(text: Column, width: int = SHINGLE, fraction: float = FRACTION) -> Column:
    """The distinct retained hashes of a text's word shingles, ascending; a shorter text is one shingle.

    A hash is retained if it lies in the lowest ``fraction`` of all 64-bit integers, whatever the text's length. So
    sketches merge by union, and the share of one sketch in another estimates containment between very unequal texts.
    """
    limit = int(-(2**63) + fraction * 2**64)
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))

    def shingles(ws: Column) -> Column:
        n = F.size(ws)
        one = F.array(F.xxhash64(F.array_join(ws, " ")))
        each = F.transform(ws, lambda w, i: F.when(i <= n - width, F.xxhash64(w, *[F.get(ws, i + k) for k in range(1, width)])))
        return F.when(n < width, one).otherwise(each)

    # the array of one element binds the words once for the inner functions
    hashes = F.transform(F.array(F.split(bare, SPACE_CLASS + "+")), shingles)[0]
    return F.array_sort(F.array_distinct(F.filter(hashes, lambda h: h < limit)))


def as_text(hashes: Column) -> Column:
    """A printable fingerprint: the retained hashes in hexadecimal."""
    return F.array_join(F.transform(hashes, lambda h: F.hex(h)), "")


def merge(a: Column, b: Column) -> Column:
    return F.array_sort(F.array_union(a, b))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; null if a retained none."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches; two that retained nothing are equal, so 1."""
    shared = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - shared
    return F.when(either > 0, shared / either).otherwise(F.lit(1.0))


def _range_of(doc_id: Column, bounds: list[int], step: int = 32) -> Column:
    """How many of the ascending bounds lie below the id; a coarse search, then one among ``step`` bounds."""
    if not bounds:
        return F.lit(0)
    coarse = F.array(*[F.lit(b) for b in bounds[step - 1::step]]).cast("array<long>")
    fine = F.array(*[F.array(*[F.lit(b) for b in bounds[k:k + step]]).cast("array<long>")
                     for k in range(0, len(bounds), step)])
    block = F.size(F.filter(coarse, lambda b: b < doc_id))
    return block * step + F.coalesce(F.size(F.filter(F.get(fine, block), lambda b: b < doc_id)), F.lit(0))


def with_next(docs: DataFrame, kept: Column, spread: int | None = None) -> DataFrame:
    """``doc_id, text, kept, next_text, next_kept``: the next document by id, after the last the first.

    ``kept`` is computed once for each document and handed on. Documents are dealt into ``spread`` ranges of ids of
    about equal numbers; within a range a window finds the next document, and the last of a range takes the first of
    the following range: a row for each range. Null ids come first; repeated ids go by text.
    """
    spread = spread or max(1024, 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    cuts = rows.select(F.percentile_approx("doc_id", [k / spread for k in range(1, spread)], 100_000).alias("q")).first().q
    # fewer than ``spread`` numbers, so they can stand in the plan
    place = F.when(F.col("doc_id").isNull(), F.lit(0)).otherwise(_range_of(F.col("doc_id"), sorted(set(cuts or []))))
    dealt = rows.withColumn("part", place)
    full = dealt.withColumn("kept", kept)
    order = Window.partitionBy("part").orderBy(F.col("doc_id").asc_nulls_first(), "text")
    ranked = full.withColumn("next", F.lead(F.struct("text", "kept")).over(order))
    first = F.min(F.struct(F.coalesce("doc_id", F.lit(-(2**63))).alias("at"), "text")).alias("first")
    ranges = dealt.groupBy("part").agg(first).select("part", F.col("first.text").alias("text"))
    line = Window.orderBy("part")  # a row for each range
    whole = line.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = ranges.withColumn("kept", kept).withColumn("one", F.struct("text", "kept")).select(
        "part", F.coalesce(F.lead("one").over(line), F.first("one").over(whole)).alias("after"))
    return ranked.join(after, "part").withColumn("n", F.coalesce("next", "after")).select(
        "doc_id", "text", "kept", F.col("n.text").alias("next_text"), F.col("n.kept").alias("next_kept"))


def fingerprints(docs: DataFrame, *, width: int = SHINGLE, fraction: float = FRACTION) -> DataFrame:
    """A row for each document: its fingerprint, that of its edited text, and their likenesses.

    Likenesses are those of the fingerprints: a text of k shingles retains none of them with probability (1 - ``fraction``)^k, and
    texts that retained none have equal fingerprints, likeness 1, whatever they hold.

    Null text counts as empty, and an empty text has the one shingle of no words. A single document is its own next.
    Repeated rows have a row each; an empty table gives none; other columns are ignored.
    """
    near = with_next(docs, sketch(F.col("text"), width, fraction)).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = near.withColumn("edited", F.concat(
        F.substring(F.col("text"), F.lit(1), F.col("n_chars").cast("int") - cut), F.substring(F.col("next_text"), F.lit(1), cut)))
    made = edited.withColumn("other", sketch(F.col("edited"), width, fraction))
    return made.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        as_text(F.col("kept")).alias("fingerprint"), as_text(F.col("other")).alias("edited_fingerprint"),
        likeness(F.col("kept"), F.col("other")).alias("near_edited"), likeness(F.col("kept"), F.col("next_kept")).alias("near_next"))
