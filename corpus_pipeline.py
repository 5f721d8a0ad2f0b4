"""From raw documents to packed training sequences, stage by stage.

Each stage is a table in the folder all executors share, so a lost executor costs tasks of one stage.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.llm import chosen_path, mixing, packing, quality_fm, segment_edit
from strata.llm.common import SPACES, load, stored
from strata.session import ship

QUALITY_AT_LEAST = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorisation machine scores 0.7 or more; the others go."""
    machine = quality_fm.train(docs, load(ship(spark), sf_dir, "labels"))
    return quality_fm.score(docs, machine, docs.columns).where(F.col("quality_score") >= QUALITY_AT_LEAST).select("row.*")


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that occur before, or nearly so; a document of nothing but such lines goes."""
    others = [c for c in docs.columns if c not in ("doc_id", "text", "n_chars")]
    out = segment_edit.dedup(docs, carry=others)
    emptied = (F.btrim("text", F.lit(SPACES)) == "") & (F.col("n_repeated") + F.col("n_near") > 0)
    new = {"doc_id": F.col("doc_id"), "text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return out.where(~F.coalesce(emptied, F.lit(False))).select(
        *[new.get(c, F.col(f"row.`{c}`")).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of documents linked by near-equal five-word shingles; a missing id is no copy.

    Of rows that repeat an id with the same word sequence one stays: the first by text, then by the other columns in order.
    """
    stay = chosen_path.join(docs).where("kept AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("strata_rows"))
    # words are only taken apart where an id is repeated; such rows already meet in the join by id
    words = F.regexp_extract_all(F.lower("text"), F.lit(r"[a-z0-9\x{80}-\x{10FFFF}]+"), 0)
    sequence = F.when(F.col("strata_rows") > 1, F.xxhash64(words))
    order = Window.partitionBy("doc_id", sequence).orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    once = docs.join(stay, "doc_id").withColumn("strata_place", F.row_number().over(order)).where("strata_place = 1")
    return once.select(docs.columns).union(docs.where("doc_id IS NULL").select(docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources at their target weights: documents repeated by epochs, the last one of a source cut at its budget."""
    return mixing.realise(mixing.mix(docs, docs.columns)).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of power-of-two lengths."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality), ("line_dedup", line_dedup), ("ngram_join", ngram_join), ("mixture", mixture), ("packing", pack),
]

#: SQL can express neither the classifier nor the tokenizer; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(ship(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
