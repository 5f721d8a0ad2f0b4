"""The registered query of each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ship
from . import (
    alignment,
    chosen_path,
    cross_polytope,
    mixing,
    packing,
    permuterm,
    phrase_automata,
    pq_dedup,
    quality_fm,
    scaled_sketch,
    segment_edit,
    separator_scan,
    toxicity_wfst,
)
from .common import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(ship(spark), sf_dir)
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return add


@_query("op1_pq_dedup", pq_dedup.DEDUP_SQL)
def op1_pq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pq_dedup.dedup(load(spark, sf_dir, "embeddings"))


@_query("op2_chosen_path_join", chosen_path.JOIN_SQL)
def op2_chosen_path_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chosen_path.join(load(spark, sf_dir, "documents"))


@_query("op3_mix_sources", mixing.MIX_SQL)
def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(load(spark, sf_dir, "documents"), ["doc_id"])
    return mixed.select("row.doc_id", "size", "source_size", "target", "taken")


@_query("op4_token_counts")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return separator_scan.token_counts(load(spark, sf_dir, "documents"))


@_query("op5_phrase_automata", phrase_automata.DEDUP_SQL)
def op5_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_automata.dedup(load(spark, sf_dir, "documents"))


@_query("op6_scaled_sketch")
def op6_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaled_sketch.fingerprints(load(spark, sf_dir, "documents"))


@_query("op7_line_edit_dedup")
def op7_line_edit_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return segment_edit.dedup(load(spark, sf_dir, "documents"))


@_query("op8_quality_fm")
def op8_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_fm.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@_query("op9_toxicity_wfst")
def op9_toxicity_wfst(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_wfst.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@_query("op10_binary_packing")
def op10_binary_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(load(spark, sf_dir, "documents"))


@_query("op11_token_alignment")
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(load(spark, sf_dir, "documents"))


@_query("op12_spelling_variants", permuterm.VARIANTS_SQL)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permuterm.variants(load(spark, sf_dir, "documents"))


@_query("op13_cross_polytope")
def op13_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.nearest(load(spark, sf_dir, "embeddings"))
