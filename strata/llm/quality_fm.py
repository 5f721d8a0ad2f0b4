"""Quality classifier: a factorisation machine over hashed words, structure statistics and length metadata."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .wordhash import BY_SPACE, chunks, words

BUCKETS = 1 << 14
# Upper bounds of the steps of a share; a share is 0 or lies in one of them.
STEPS = np.array([0.0, 0.0005, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.4, 0.7])
SHARES = ("upper", "symbol", "exclamation", "bar", "digit", "stop", "comma", "beyond_ascii", "line_feed", "other",
          "repeated", "shouted", "marked", "line_starts_again")
SIZES = ("characters", "words", "lines", "word_length")
WIDTH = BUCKETS + len(SHARES) * (len(STEPS) + 1) + len(SIZES) * 24


def _table(chars: str) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[[ord(c) for c in chars]] = 1
    return out


_CLASSES = {
    "upper": _table("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), "symbol": _table("%$*#&@^~_=+<>{}[]\\"), "exclamation": _table("!?"),
    "bar": _table("|"), "digit": _table("0123456789"), "stop": _table("."), "comma": _table(",;:"),
    "beyond_ascii": (np.arange(256) >= 0xC0).astype(np.int64), "line_feed": _table("\n"),
    "other": _table("'\"()/-`"),
}


def features(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature ids, values and where each text's features begin, in the order of the texts."""
    raw, starts, ends, hashes, at = words(texts, BY_SPACE)
    a = np.frombuffer(raw, np.uint8)
    n_docs = len(texts)
    n_words = np.diff(at)
    begin = np.zeros(n_docs + 1, np.int64)
    np.cumsum([len((t or "").encode("utf-8", "surrogatepass")) + 1 for t in texts], out=begin[1:])
    n_bytes = np.diff(begin) - 1

    def per_doc(flags: np.ndarray, edges: np.ndarray) -> np.ndarray:
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[edges[1:]] - total[edges[:-1]]

    letters = _CLASSES["upper"] + _table("abcdefghijklmnopqrstuvwxyz")
    counts = {name: per_doc(table[a], begin) for name, table in _CLASSES.items()}
    lines = counts["line_feed"] + 1
    again = np.zeros(len(hashes), np.int64)
    if len(hashes) > 1:
        again[1:] = hashes[1:] == hashes[:-1]
        again[at[:-1][(at[:-1] > 0) & (at[:-1] < len(hashes))]] = 0
    upper = np.concatenate(([0], np.cumsum(_CLASSES["upper"][a])))
    letter = np.concatenate(([0], np.cumsum(letters[a])))
    shouted = (upper[ends] - upper[starts] >= 2) & (upper[ends] - upper[starts] == letter[ends] - letter[starts])
    marked = (_CLASSES["symbol"] + _CLASSES["exclamation"] + _CLASSES["bar"])[a[ends - 1]] if len(ends) else np.zeros(0, np.int64)
    far = np.zeros(len(hashes), np.int64)
    if len(hashes) > 5:
        far[5:] = hashes[5:] == hashes[:-5]
        owner = np.repeat(np.arange(n_docs), n_words)
        far[5:] &= owner[5:] == owner[:-5]
    counts |= {"repeated": per_doc(again, at), "shouted": per_doc(shouted, at), "marked": per_doc(marked, at),
               "line_starts_again": per_doc(far, at)}

    dense = np.zeros((n_docs, len(SHARES) + len(SIZES)), np.int64)
    place = BUCKETS
    for k, name in enumerate(SHARES):
        by = n_words if name in ("repeated", "shouted", "marked", "line_starts_again") else n_bytes
        dense[:, k] = place + np.searchsorted(STEPS, counts[name] / np.maximum(by, 1))
        place += len(STEPS) + 1
    sizes = (n_bytes, n_words, lines, n_bytes / np.maximum(n_words, 1))
    for k, size in enumerate(sizes):
        dense[:, len(SHARES) + k] = place + np.minimum(23, np.log2(np.asarray(size, float) + 1) * (1 if k < 3 else 3)).astype(np.int64)
        place += 24
    # one feature a bucket, so that a word that is repeated makes no pair with itself
    held, times = np.unique(np.repeat(np.arange(n_docs), n_words) * BUCKETS + (hashes & np.uint64(BUCKETS - 1)).astype(np.int64),
                            return_counts=True)
    # words first, then the dense features of the same text
    width = dense.shape[1]
    offsets = np.searchsorted(held, np.arange(n_docs + 1) * BUCKETS) + np.arange(n_docs + 1) * width
    ids = np.empty(offsets[-1], np.int32)
    values = np.ones(offsets[-1], np.float32)
    is_dense = np.zeros(offsets[-1], bool)
    slots = (offsets[1:, None] - width + np.arange(width)[None, :]).ravel()
    is_dense[slots] = True
    ids[slots] = dense.ravel()
    ids[~is_dense] = (held % BUCKETS).astype(np.int32)
    values[~is_dense] = times / n_words[held // BUCKETS]
    values[is_dense] = 1.0 / np.sqrt(width)
    return ids, values, offsets


class Machine:
    """score = sigmoid(b + sum w x + half of sum over factors of (sum v x)^2 - sum (v x)^2), linear in the features."""

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.linear, self.factors = bias, linear, factors

    def raw(self, ids: np.ndarray, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        # every text has its dense features, so no range is empty
        at = offsets[:-1]
        out = np.full(len(at), self.bias, np.float64)
        out += np.add.reduceat(self.linear[ids] * values, at, dtype=np.float64)
        for f in range(self.factors.shape[1]):
            vx = self.factors[:, f][ids] * values
            out += 0.5 * (np.add.reduceat(vx, at, dtype=np.float64) ** 2 - np.add.reduceat(vx * vx, at, dtype=np.float64))
        return out

    def score(self, texts: list[str | None]) -> np.ndarray:
        out = [np.zeros(0)]
        for i, j in chunks(texts):
            out.append(1.0 / (1.0 + np.exp(-np.clip(self.raw(*features(texts[i:j])), -30, 30))))
        return np.concatenate(out)


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, *, factors: int = 8, epochs: int = 30,
        batch: int = 128, rate: float = 0.15, decay: float = 1e-4, seed: int = 7) -> Machine:
    """Adagrad on the logistic loss. Without rows of both labels the score is the share of label 1, or a half."""
    rng = np.random.default_rng(seed)
    w = np.zeros(WIDTH)
    v = rng.normal(0, 0.05, (WIDTH, factors))
    mean = float(np.clip((labels.sum() + 0.5) / (len(labels) + 1), 0.001, 0.999))
    bias = float(np.log(mean / (1 - mean)))
    if len(set(labels.tolist())) < 2:
        return Machine(bias, w.astype(np.float32), np.zeros((WIDTH, factors), np.float32))
    gw, gv, gb = np.full(WIDTH, 1e-6), np.full((WIDTH, factors), 1e-6), 1e-6
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for s in range(0, len(order), batch):
            chosen = order[s:s + batch]
            ids = np.concatenate([rows[k][0] for k in chosen])
            x = np.concatenate([rows[k][1] for k in chosen]).astype(np.float64)
            sizes = np.array([len(rows[k][0]) for k in chosen])
            at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            vx = v[ids] * x[:, None]
            sums = np.add.reduceat(vx, at)
            raw = bias + np.add.reduceat(w[ids] * x, at) + 0.5 * (sums**2 - np.add.reduceat(vx * vx, at)).sum(1)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - labels[chosen]) / len(chosen)
            e = np.repeat(error, sizes) * x
            used, where = np.unique(ids, return_inverse=True)
            dw = np.bincount(where, e, len(used)) + decay * w[used]
            gw[used] += dw * dw
            w[used] -= rate * dw / np.sqrt(gw[used])
            for f in range(factors):
                dv = np.bincount(where, e * (np.repeat(sums[:, f], sizes) - vx[:, f]), len(used)) + decay * v[used, f]
                gv[used, f] += dv * dv
                v[used, f] -= rate * dv / np.sqrt(gv[used, f])
            gb += error.sum() ** 2
            bias -= rate * error.sum() / np.sqrt(gb)
    return Machine(bias, w.astype(np.float32), v.astype(np.float32))


def labelled_sample(labels: DataFrame, label: str, folds: int, held_out: int, bound: int) -> DataFrame:
    """``doc_id, label`` of at most ``bound`` labelled documents outside the held-out fold, chosen by hash."""
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds
    return (
        labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & (fold != held_out))
        .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    )


def train(docs: DataFrame, labels: DataFrame, *, label: str = "quality", folds: int = 4, held_out: int = 2,
          bound: int = 12_000) -> Machine:
    """Fit on at most ``bound`` labelled documents; their features, not their texts, come to the driver.

    The sample is broadcast to the scan: it has at most ``bound`` rows of 12 bytes. Held-out labels are never read.
    """
    sample = labelled_sample(labels, label, folds, held_out, bound)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(2).to_pylist()
            ids_out, values_out = [], []
            for i, j in chunks(texts):
                ids, values, offsets = features(texts[i:j])
                ids_out += [ids[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
                values_out += [values[s:e].tobytes() for s, e in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids_out, pa.binary()), pa.array(values_out, pa.binary())],
                                             ["doc_id", "label", "ids", "values"])

    rows = (
        docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).join(F.broadcast(sample), "doc_id")
        .select("doc_id", "label", "text").mapInArrow(extract, "doc_id long, label int, ids binary, values binary").collect()
    )
    rows.sort(key=lambda r: (r.doc_id, r.label, bytes(r.ids)))
    return fit([(np.frombuffer(r.ids, np.int32), np.frombuffer(r["values"], np.float32)) for r in rows],
               np.array([r.label for r in rows], np.float64))


def score(docs: DataFrame, machine: Machine, keep: list[str]) -> DataFrame:
    """The columns ``keep`` (text among them or not) and ``quality_score`` of every document; nothing is shuffled."""
    chosen = with_text(docs, keep)
    schema = T.StructType([chosen.schema["row"], T.StructField("quality_score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(machine.score(texts_of(b)), pa.float64())],
                                             ["row", "quality_score"])

    return chosen.mapInArrow(run, schema)


def with_text(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``row`` (struct of ``keep``) and ``text``, null where the row holds the text itself."""
    held = "text" in keep and docs.schema["text"].dataType == T.StringType()
    text = F.lit(None).cast("string") if held else F.col("text").cast("string")
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), text.alias("text"), F.lit(held).alias("held"))


def texts_of(batch: pa.RecordBatch) -> list[str | None]:
    """The texts of a batch of ``with_text``."""
    if batch.num_rows and batch.column(2)[0].as_py():
        return batch.column(0).field("text").to_pylist()
    return batch.column(1).to_pylist()


def classify(docs: DataFrame, labels: DataFrame, *, folds: int = 4, held_out: int = 2, threshold: float = 0.7) -> DataFrame:
    """``doc_id, held_out, score, predicted``. Null or empty text scores by its structure alone; repeated rows and null
    ids are scored each (a null id is in no fold and has no label); other columns are ignored."""
    out = score(docs, train(docs, labels, folds=folds, held_out=held_out), ["doc_id"])
    fold = F.crc32(F.col("row.doc_id").cast("string").cast("binary")) % folds
    return out.select("row.doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"),
                      F.col("quality_score").alias("score"), (F.col("quality_score") >= threshold).cast("int").alias("predicted"))
