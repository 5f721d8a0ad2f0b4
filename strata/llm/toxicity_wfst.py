"""Toxicity: a weighted finite-state grammar over clauses.

Words become symbols (insult, suspect, threat, target, negation, reported speech, other). Three transducers are composed
into one: negation marks what stands in its scope, reported speech marks what follows it in the clause, targets turn
what is left into abuse of someone. A clause yields patterns, not words: of its insults, of its threats and of its
suspects the best path alone, the highest on its ladder. A document's score weighs the patterns of its clauses. The
insults beyond the given seeds, and all weights, are learned from the labelled documents of the training folds: word
beginnings that hardly any clean document has are insults, those that toxic documents have several times as often are
suspects.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .quality_fm import labelled_sample, texts_of, with_text
from .wordhash import BY_LETTER, chunks, mix, rolling, words

# Word lists of the grammar.
SEEDS = ("idiot", "imbecile", "moron", "stupid", "loser", "scum", "pathetic", "worthless", "disgusting")
THREATS = ("kill", "murder", "strangle", "slaughter", "stab", "töten", "umbringen", "tuer", "matar")
TARGETS = ("you", "your", "he", "she", "they", "him", "her", "them", "du", "dich", "dir", "ihr", "sie", "tu", "te", "toi",
           "vous", "tú", "usted", "ustedes")
NEGATIONS = ("not", "no", "never", "nicht", "kein", "keine", "nie", "pas", "jamais", "nunca", "ni")
REPORTS = ("said", "says", "called", "quoted", "wrote", "sagte", "nannte", "dit", "disait", "dijo", "dice")

PATTERNS = ("insult", "directed_insult", "negated_insult", "reported_insult", "threat", "directed_threat", "excused_threat",
            "suspect", "excused_suspect")
# Patterns stand on ladders: a word that is only mentioned, one that is meant, one that is meant for someone. Weights are the
# steps, none below zero, so negation and report never raise a clause's score and a target never lowers it.
LADDERS = (
    ("insult", "directed_insult", "negated_insult", "reported_insult"), ("insult", "directed_insult"), ("directed_insult",),
    ("threat", "directed_threat", "excused_threat"), ("threat", "directed_threat"), ("directed_threat",),
    ("suspect", "excused_suspect"), ("suspect",),
)
_STEPS = np.array([[p in step for step in LADDERS] for p in PATTERNS], float)
_HEIGHT = dict(zip(PATTERNS, _STEPS.sum(axis=1).tolist(), strict=True))
# Where the weights start, and what they are drawn to: bias, then the steps.
PRIOR = np.array([-3.0, 1.0, 3.0, 0.5, 0.5, 0.5, 2.5, 0.2, 0.3])
LENGTHS = range(4, 10)
SCOPE = 2
_WORD = re.compile(r"\w+")
_LONG = re.compile(r"\w{4,}")
_CLAUSE_END = re.compile(r"[.!?;:,\n]")


def _negation(state: int, symbol: str) -> tuple[int, str]:
    if symbol == "N":
        return SCOPE, "N"
    if state and symbol in "ITW":
        return state - 1, symbol.lower()
    return max(0, state - 1), symbol


def _reported(state: int, symbol: str) -> tuple[int, str]:
    if symbol == "R":
        return 1, "R"
    return state, {"I": "q", "T": "t", "W": "w"}.get(symbol, symbol) if state else symbol


def _target(state: int, symbol: str) -> tuple[int, str]:
    return (1, "Y") if symbol == "Y" else (state, symbol)


def _compose() -> dict[tuple[tuple[int, int, int], str], tuple[tuple[int, int, int], str]]:
    """The arcs of the composed transducer: (state, symbol in) -> (state, symbol out)."""
    arcs, todo = {}, [(0, 0, 0)]
    while todo:
        state = todo.pop()
        for symbol in "ITWYNRO":
            n, out = _negation(state[0], symbol)
            r, out = _reported(state[1], out)
            t, out = _target(state[2], out)
            arcs[state, symbol] = ((n, r, t), out)
            if ((n, r, t), "O") not in arcs:
                todo.append((n, r, t))
    return arcs


ARCS = _compose()
#: What a clause's output symbols count as, by whether the clause names a target.
_FINAL = {"I": ("insult", "directed_insult"), "i": ("negated_insult",) * 2, "q": ("reported_insult",) * 2,
          "T": ("threat", "directed_threat"), "t": ("excused_threat",) * 2,
          "W": ("suspect",) * 2, "w": ("excused_suspect",) * 2}
_FIXED = {w: s for s, group in (("T", THREATS), ("Y", TARGETS), ("N", NEGATIONS), ("R", REPORTS)) for w in group}


class Grammar:
    """The transducer with its learned word beginnings and pattern weights."""

    def __init__(self, insults: list[str], weights: np.ndarray, suspects: list[str] = ()):
        self.insults, self.weights, self.suspects = sorted(insults), weights, sorted(suspects)
        self._starts = dict.fromkeys(self.suspects, "W") | dict.fromkeys(self.insults, "I")
        self._heads = {w[:4] for w in (*self._starts, *THREATS)}

    def _symbol(self, word: str) -> str:
        if word in _FIXED:
            return _FIXED[word]
        found = [self._starts[word[:k]] for k in LENGTHS if word[:k] in self._starts]
        return "O" if not found else "I" if "I" in found else "W"

    def clause(self, text: str) -> Counter:
        """The pattern of the best path for each kind of word, one at most."""
        state, out = (0, 0, 0), []
        for m in _WORD.finditer(text):
            state, symbol = ARCS[state, self._symbol(m[0])]
            if symbol in _FINAL:
                out.append(symbol)
        found = {_FINAL[s][state[2]] for s in out}
        best = {p.split("_")[-1]: p for p in sorted(found, key=lambda p: (_HEIGHT[p], p))}
        return Counter(best.values())

    def patterns(self, text: str | None) -> np.ndarray:
        """In how many clauses each pattern is the best path."""
        found: Counter = Counter()
        if text:
            low = text.lower()
            if not self._heads.isdisjoint({w[:4] for w in _LONG.findall(low)}):
                for part in _CLAUSE_END.split(low):
                    if part:
                        found += self.clause(part)
        return np.array([found[p] for p in PATTERNS], float)

    def score(self, counts: np.ndarray) -> np.ndarray:
        z = self.weights[0] + np.log1p(counts @ _STEPS) @ self.weights[1:] / math.log(2)
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _evidence(t: np.ndarray, c: np.ndarray, rate: float) -> np.ndarray:
    """Chernoff exponent of seeing t of t + c toxic documents or more by chance."""
    n = t + c
    p = np.clip(t / n, 1e-9, 1 - 1e-9)
    kl = p * np.log(p / rate) + (1 - p) * np.log((1 - p) / (1 - rate))
    return np.where(p > rate, n * kl, 0.0)


def learn(prefixes: list[tuple[str, int, int]], toxic: int, clean: int, purity: float = 0.98,
          ratio: float = 4.0) -> tuple[list[str], list[str]]:
    """Insults and suspects among prefixes (text, toxic documents, clean documents): both mark toxic documents beyond chance.

    Insults are the shortest prefixes of which ``purity`` of the documents are toxic. Suspects are, of prefixes that
    begin one another, those of the strongest evidence that occur ``ratio`` times as often in toxic documents.
    """
    if not toxic or not clean or not prefixes:
        return [], []
    rate = min(0.5, max(0.01, toxic / (toxic + clean)))
    t, c = (np.array([p[k] for p in prefixes], float) for k in (1, 2))
    evidence = _evidence(t, c, rate)
    strong = evidence >= math.log(len(prefixes)) + 3
    pure = strong & (t / (t + c) >= purity)
    kept: set[str] = set()
    for p in sorted((p[0] for p, s in zip(prefixes, pure, strict=True) if s), key=lambda x: (len(x), x)):
        if not any(p[:k] in kept for k in range(4, len(p))):
            kept.add(p)
    weak: list[str] = []
    likely = strong & ~pure & ((t + 0.5) / (toxic + 1) >= ratio * (c + 0.5) / (clean + 1))
    for _, p in sorted((-e, p[0]) for e, p, x in zip(evidence, prefixes, likely, strict=True) if x):
        if not any(p.startswith(q) or q.startswith(p) for q in weak):
            weak.append(p)
    return sorted(kept), sorted(weak)


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", folds: int = 5, held_out: int = 0,
          bound: int = 12_000) -> Grammar:
    """Learn from at most ``bound`` labelled documents outside the held-out fold.

    Near copies count once: documents with the same smallest five-word shingle are one family. What comes to the
    driver is the list of word prefixes that occur in three or more toxic families and twice as often there as elsewhere,
    and ten counts for each sampled document.
    """
    sample = labelled_sample(labels, label, folds, held_out, bound)
    chosen = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(sample), "doc_id")

    def family(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, out = b.column(2).to_pylist(), []
            for i, j in chunks(texts):
                _, _, _, hashes, at = words(texts[i:j], BY_LETTER, lower=True)
                rolled = mix(rolling(hashes, 5))
                for s, e in zip(at[:-1], at[1:], strict=True):
                    part = rolled[s:e - 4] if e - s >= 5 else hashes[s:e]
                    out.append(int(part.min() >> np.uint64(1)) if len(part) else 0)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.int64()), b.column(2)],
                                             ["doc_id", "label", "family", "text"])

    kept = chosen.select("doc_id", "label", "text").mapInArrow(
        family, "doc_id long, label int, family long, text string").persist()
    try:
        one = kept.groupBy("family").agg(F.min_by(F.struct("label", "text"), "doc_id").alias("d")).select("d.*")
        totals = {r.label: r["count"] for r in one.groupBy("label").count().collect()}
        toxic, clean = totals.get(1, 0), totals.get(0, 0)
        tokens = F.array_distinct(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"))
        cut = F.flatten(F.transform(tokens, lambda w: F.array(*[F.substring(w, 1, k) for k in LENGTHS])))
        marks = one.select("label", F.explode(F.array_distinct(cut)).alias("prefix")).where(F.length("prefix") >= LENGTHS[0])
        counted = marks.groupBy("prefix").agg(F.sum("label").alias("t"), F.sum(1 - F.col("label")).alias("c"))
        seen = counted.where((F.col("t") >= 3) & (F.col("t") * (clean + 1) >= 2 * F.col("c") * (toxic + 1))).collect()
        insults, suspects = learn([(r.prefix, r.t, r.c) for r in seen], toxic, clean)
        seeds = (s for s in SEEDS if not any(s.startswith(i) for i in insults))
        grammar = Grammar([*insults, *seeds], PRIOR, suspects)
        rows = patterns(kept, grammar, ["doc_id", "label"]).select("row.doc_id", "row.label", "counts").collect()
    finally:
        kept.unpersist()
    rows.sort(key=lambda r: (r.doc_id, r.label, list(r.counts)))
    if rows:
        grammar.weights = fit_weights(np.array([r.counts for r in rows]), np.array([r.label for r in rows], float))
    return grammar


def fit_weights(counts: np.ndarray, labels: np.ndarray, pull: float = 2.0, steps: int = 60) -> np.ndarray:
    """Newton steps on the logistic loss with the weights drawn to the prior; no step lowers a score."""
    x = np.column_stack([np.ones(len(counts)), np.log1p(counts @ _STEPS) / math.log(2)])
    w = PRIOR.copy()
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + pull * (w - PRIOR)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + pull * np.eye(len(w))
        w = w - np.linalg.solve(hessian, gradient)
        w[1:] = np.maximum(w[1:], 0.0)
    return w


def patterns(docs: DataFrame, grammar: Grammar, keep: list[str]) -> DataFrame:
    """``row`` (struct of ``keep``), ``counts`` of the grammar's patterns and ``score`` for every document."""
    chosen = with_text(docs, keep)
    schema = T.StructType([chosen.schema["row"], T.StructField("counts", T.ArrayType(T.DoubleType())), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            counts = np.array([grammar.patterns(t) for t in texts_of(b)]).reshape(-1, len(PATTERNS))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(list(counts), pa.list_(pa.float64())), pa.array(grammar.score(counts), pa.float64())],
                ["row", "counts", "score"])

    return chosen.mapInArrow(run, schema)


def classify(docs: DataFrame, labels: DataFrame, *, folds: int = 5, held_out: int = 0, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` and a column for each pattern's count. Null or empty text matches nothing
    and scores by the bias; repeated rows and null ids are scored each; other columns are ignored."""
    out = patterns(docs, train(docs, labels, folds=folds, held_out=held_out), ["doc_id"])
    fold = F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % folds
    return out.select("row.doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"),
                      *[F.col("counts")[k].alias(p) for k, p in enumerate(PATTERNS)])
