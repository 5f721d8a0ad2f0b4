"""Cross-tokenizer alignment: two tokenisations of a text cut into groups by divide and conquer at shared ends.

A document's tokens are spans of bytes under both tokenizers. An interval of bytes is halved at a common end near its
middle, found by bisecting one list of ends with the other's, until an interval holds no common end and is a group.
All open intervals of many documents are halved at once.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import sorted_groups, stored
from .tokens import encode
from .wordhash import chunks

#: An id pair is one number: 16 bits of the first vocabulary's id, 16 of the second's.
BITS = 16


@functools.cache
def _first_bytes(json_path: str | None) -> list[bytes]:
    """The bytes of each id of the byte-level vocabulary."""
    from .tokens import patient_encoder

    # a byte-level alphabet shows printable bytes as they are and moves the others, in order, behind 255
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(sorted(set(range(256)) - set(shown)))}
    vocab = patient_encoder(False, json_path).get_vocab(with_added_tokens=False)
    out = [b""] * (max(vocab.values()) + 1)
    for token, i in vocab.items():
        out[i] = bytes(letters[c] for c in token)
    return out


@functools.cache
def _pieces(model_path: str | None):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path or public_tokenizers.path("piece_bpe_32k.model"))
    out = []
    for i in range(model.vocab_size()):
        piece = model.id_to_piece(i)
        out.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return model, out


@dataclass
class Side:
    """Tokens of several documents: their ids, where each ends in the bytes of all, and each document's first token."""
    ids: np.ndarray
    ends: np.ndarray
    first: np.ndarray


@functools.cache
def _columns(side: str, path: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes, byte length and the written forms ``id,`` and ``id`` with the separator behind a group, of each id."""
    known = _first_bytes(path) if side == "a" else _pieces(path)[1]
    last = "|" if side == "a" else ";"
    written = np.array([f"{i}," for i in range(len(known))] + [f"{i}{last}" for i in range(len(known))], object)
    return np.array(known, object), np.array([len(k) for k in known], np.int64), written


def tokens(texts: list[str | None], paths: tuple[str | None, str | None, str | None]) -> tuple[Side, Side, np.ndarray]:
    """Both tokenisations of texts, and the bytes of each text so far; texts that one of them does not keep have no tokens."""
    ranks, json_path, model_path = paths
    known_a, size_a, _ = _columns("a", json_path)
    known_b, size_b, _ = _columns("b", model_path)
    model = _pieces(model_path)[0]
    left, right, sizes = [], [], []
    for text, b in zip(texts, model.encode([t or "" for t in texts], num_threads=1), strict=True):
        raw = b" " + text.encode() if text else b""
        a = encode(" " + text, ranks, special=False, json_path=json_path).astype(np.int64) if text else np.zeros(0, np.int64)
        b = np.array(b, np.int64)
        if not raw or b"".join(known_a[a]) != raw or b"".join(known_b[b]) != raw:
            a, b, raw = np.zeros(0, np.int64), np.zeros(0, np.int64), b""
        left.append(a)
        right.append(b)
        sizes.append(len(raw))

    def side(parts: list[np.ndarray], size: np.ndarray) -> Side:
        ids = np.concatenate([np.zeros(0, np.int64), *parts])
        return Side(ids, np.cumsum(size[ids]), np.cumsum([0, *map(len, parts)]))

    return side(left, size_a), side(right, size_b), np.cumsum([0, *sizes])


def _leap(x: np.ndarray, y: np.ndarray, at: np.ndarray, forward: bool) -> np.ndarray:
    """From ends ``at`` of ``x``: the nearest number in both ascending lists at or behind (or before) it, by turns of bisection."""
    side = "left" if forward else "right"
    found = at.copy()
    open_ = np.arange(len(at))
    while len(open_):
        there = _step(y, found[open_], side)
        back = _step(x, there, side)
        moved = back != found[open_]
        found[open_] = back
        open_ = open_[moved | (there != back)]
    return found


def _step(x: np.ndarray, values: np.ndarray, side: str) -> np.ndarray:
    at = np.searchsorted(x, values, side)
    return x[at] if side == "left" else x[at - 1]


def shared_cuts(a: np.ndarray, b: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """All numbers that the ascending lists ``a`` and ``b`` share, by divide and conquer within ``bounds``.

    The bounds, first and last number included, are shared themselves. Every interval between two shared numbers looks for
    one near its middle (by tokens of ``a``): first behind, then before it. Found, both halves go on; otherwise
    the interval is a leaf.
    """
    a, b = np.concatenate([bounds[:1], a]), np.concatenate([bounds[:1], b])
    low, high = bounds[:-1], bounds[1:]
    low, high = low[low < high], high[low < high]
    cuts = [np.unique(bounds)]
    while len(low):
        i, j = np.searchsorted(a, low), np.searchsorted(a, high)
        inner = j - i > 1
        low, high, middle = low[inner], high[inner], a[(i[inner] + j[inner]) // 2]
        cut = _leap(a, b, middle, True)
        past = np.flatnonzero(cut >= high)
        cut[past] = _leap(a, b, middle[past], False)
        split = cut > low
        low, high, cut = low[split], high[split], cut[split]
        cuts.append(cut)
        # in ascending order: bisecting many numbers is fast when they are sorted
        low, high = np.stack([low, cut], 1).ravel(), np.stack([cut, high], 1).ravel()
    return np.sort(np.concatenate(cuts))


def _group_sizes(side: Side, cuts: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(side.ends, cuts, "right"))


def _written(a: Side, b: Side, of_a: np.ndarray, of_b: np.ndarray, first_group: np.ndarray, paths) -> list[str]:
    """``a1,a2|b1;a3|b2,b3`` of each document."""
    before = np.cumsum(of_a + of_b) - of_a - of_b
    out = np.empty(len(a.ids) + len(b.ids), object)
    for name, side, sizes, path, start in (("a", a, of_a, paths[1], before), ("b", b, of_b, paths[2], before + of_a)):
        n = len(side.ids)
        first = np.cumsum(sizes) - sizes
        last = np.zeros(n, np.int64)
        last[np.cumsum(sizes) - 1] = 1
        written = _columns(name, path)[2]
        out[np.arange(n) + np.repeat(start - first, sizes)] = written[side.ids + last * (len(written) // 2)]
    place = np.concatenate([before, [len(out)]])[first_group]
    return ["".join(out[i:j])[:-1] for i, j in zip(place[:-1].tolist(), place[1:].tolist(), strict=True)]


def _pairs(a: Side, b: Side, of_a: np.ndarray, of_b: np.ndarray, doc: np.ndarray, slice_links: int = 4_000_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``document, pair, links``: the id pairs linked in each document, and how often.

    Small groups are written out link by link. In a large group equal ids are counted first, so its links are never written out.
    """
    found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def gather(d: np.ndarray, pair: np.ndarray, times: np.ndarray) -> None:
        order = np.lexsort((pair, d))
        d, pair, times = d[order], pair[order], times[order]
        start = np.flatnonzero(np.concatenate([np.ones(min(1, len(d)), bool), (d[1:] != d[:-1]) | (pair[1:] != pair[:-1])]))
        if len(start):
            found.append((d[start], pair[start], np.add.reduceat(times, start)))

    first_a, first_b = np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b
    links = of_a * of_b
    small = np.flatnonzero(links <= 4096)
    stops = np.searchsorted(np.cumsum(links[small]), np.arange(slice_links, links[small].sum() + slice_links, slice_links), "right") + 1
    for at, to in zip([0, *stops.tolist()], stops.tolist(), strict=False):
        g = small[at:to]
        n = links[g]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(of_b[g], n)
        left = a.ids[np.repeat(first_a[g], n) + inside // width]
        right = b.ids[np.repeat(first_b[g], n) + inside % width]
        both, times = np.unique(np.repeat(doc[g], n) << 2 * BITS | left << BITS | right, return_counts=True)
        found.append((both >> 2 * BITS, both & (1 << 2 * BITS) - 1, times))
    for g in np.flatnonzero(links > 4096).tolist():
        (x, n), (y, m) = (np.unique(s.ids[f[g]:f[g] + k[g]], return_counts=True) for s, f, k in ((a, first_a, of_a), (b, first_b, of_b)))
        for part in range(0, len(x), max(1, slice_links // len(y))):
            here = slice(part, part + max(1, slice_links // len(y)))
            pair = (x[here, None] << BITS | y).ravel()
            found.append((np.full(len(pair), doc[g]), pair, (n[here, None] * m).ravel()))
    parts, found = found, []
    if not parts:
        return (np.zeros(0, np.int64),) * 3
    if len(parts) == 1:
        return parts[0]
    gather(*(np.concatenate(c) for c in zip(*parts, strict=True)))
    return found[0]


def align(texts: list[str | None], paths: tuple[str | None, str | None, str | None] = (None, None, None)):
    """Of each text: tokens under both tokenizers, groups, links and the written groups; and the id pairs of all texts."""
    a, b, bounds = tokens(texts, paths)
    cuts = shared_cuts(a.ends, b.ends, bounds)
    of_a, of_b = _group_sizes(a, cuts), _group_sizes(b, cuts)
    first_group = np.searchsorted(cuts, bounds)
    total = np.concatenate([[0], np.cumsum(of_a * of_b)])
    doc = np.repeat(np.arange(len(texts)), np.diff(first_group))
    counts = [np.diff(a.first), np.diff(b.first), np.diff(first_group), np.diff(total[first_group])]
    return counts, _written(a, b, of_a, of_b, first_group, paths), _pairs(a, b, of_a, of_b, doc)


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, groups_sha256 string"
HELD = f"block long, kind int, {ALIGNED}, pairs binary, times binary"


def _held(docs: DataFrame, paths, block_chars: int, with_groups: bool) -> DataFrame:
    """A row of each document with its packed id pairs (kind 1) and a row of each block of documents with its pairs (kind 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for start, end in chunks(texts, block_chars):
                counts, groups, (doc, pair, times) = align(texts[start:end], paths)
                place = np.searchsorted(doc, np.arange(end - start + 1))
                pair32 = pair.astype("<u4")
                packed = [pair32[i:j].tobytes() for i, j in zip(place[:-1], place[1:], strict=True)]
                often = [times[i:j].astype("<i8").tobytes() for i, j in zip(place[:-1], place[1:], strict=True)]
                every, held_by = np.unique(pair32, return_counts=True)
                n = end - start
                columns = [
                    [task << 32 | done] * (n + 1), [0] + [1] * n, [None, *ids[start:end]], *[[None, *c.tolist()] for c in counts],
                    [None, *groups] if with_groups else [None] * (n + 1),
                    [None, *[hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]],
                    [every.tobytes(), *packed], [held_by.astype("<i8").tobytes(), *often]]
                kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string(), pa.string(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)],
                                                 [f.split()[0] for f in HELD.split(", ")])
                done += 1

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, HELD)


def _block_pairs(held: DataFrame) -> DataFrame:
    """``block, pair, n``: how many documents of each block hold an id pair linked."""
    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs, times in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                pair = np.frombuffer(pairs, "<u4").astype(np.int64)
                n = np.frombuffer(times, "<i8")
                for k in range(0, len(pair), 100_000):
                    part = pair[k:k + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), block)), pa.array(part), pa.array(n[k:k + 100_000])],
                                                     ["block", "pair", "n"])

    return held.where("kind = 0").select("block", "pairs", "times").mapInArrow(unpack, "block long, pair long, n long")


def align_documents(docs: DataFrame, *, block_chars: int = 2_000_000, with_groups: bool = False, ranks_path: str | None = None,
                    json_path: str | None = None, model_path: str | None = None) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` of every document (and ``groups``, the
    written groups, if wanted).

    Texts are encoded once. Of each block of documents only the distinct id pairs are counted, joined to the counts of
    the whole table and sent back to the block, so a pair that every document holds is one row a block.

    Null and empty texts, and texts that one of the tokenizers does not give back byte by byte, have no tokens: zeros and an empty
    ``groups_sha256``. Every row is a document of its own, so repeated rows and null ids count each. Special tokens' strings
    within texts are plain text. Other columns are ignored; an empty table gives no rows.
    """
    held = stored(_held(docs, (ranks_path, json_path, model_path), block_chars, with_groups), "aligned")
    each = _block_pairs(held)
    first = F.shiftright("pair", BITS)
    counts = stored(each.groupBy("pair").agg(F.sum("n").alias("count")), "pair-counts")
    highest = counts.groupBy(first.alias("first")).agg(F.max("count").alias("highest"))
    marked = counts.withColumn("first", first).join(highest, "first").select(
        "pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    back = each.select("block", "pair").join(marked, "pair").select(
        "block", F.lit(0).alias("kind"), "pair", (F.col("count") * 2 + F.col("best").cast("long")).alias("weight"))
    rows = held.where("kind = 1").unionByName(back, allowMissingColumns=True)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", *(["groups"] if with_groups else []), "groups_sha256"]

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sorted_groups(batches, ["block"]):
            kind = np.array(part["kind"])
            known = part.filter(pa.array(kind == 0))
            pair, weight = np.array(known["pair"]), np.array(known["weight"])
            of = part.filter(pa.array(kind == 1))
            best, sums = [], []
            for pairs, times in zip(of["pairs"].to_pylist(), of["times"].to_pylist(), strict=True):
                n = np.frombuffer(times, "<i8")
                w = weight[np.searchsorted(pair, np.frombuffer(pairs, "<u4").astype(np.int64))] if len(n) else n
                best.append(int(n[w & 1 == 1].sum()))
                sums.append(int((n * (w >> 1)).sum()))
            out = pa.table({c: of[c] for c in names} | {"n_best": pa.array(best, pa.int64()), "count_sum": pa.array(sums, pa.int64())})
            yield from out.to_batches()

    schema = ", ".join(f"{c} {'string' if c.startswith('groups') else 'long'}" for c in names) + ", n_best long, count_sum long"
    done = rows.repartition("block").sortWithinPartitions("block", "kind", "pair").mapInArrow(total, schema)
    return done.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", *(["groups"] if with_groups else []))
