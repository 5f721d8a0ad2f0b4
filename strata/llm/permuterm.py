"""Spelling variants by permuterm rotations.

A word is marked with a terminator and turned to each of its rotations. A rotation without its last character is the word
without that character, read round from behind it: words that differ only there share it as a prefix, and so does the whole
rotation of the word that lacks the character. Sorted, neighbours stand side by side.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .wordhash import mix

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(65, 91)}
END = "$"
#: Rotations of more characters are named by two hashes instead of being written out.
WRITTEN = 64


def changed(doc_id: int | None, run: str, every: int) -> str:
    """A run as it counts for a document: where the hash of both falls on a multiple, one code point is gone."""
    h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
    return run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]


def word_counts(docs: DataFrame, *, every: int = 97, least_chars: int = 5, least_n: int = 3, chunk: int = 200_000) -> DataFrame:
    """``word, n``: distinct words of ``least_chars`` code points or more that occur ``least_n`` times in all documents.

    Counted per document, then over some documents, then over all: a word that a third of all texts repeat is a row a chunk.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for run, n in Counter(RUN.findall((text.as_py() or "").translate(LOWER))).items():
                    word = changed(doc_id, run, every)
                    if len(word) >= least_chars:
                        held[word] += n
                if len(held) >= chunk:
                    yield _counted(held)
                    held = Counter()
        if held:
            yield _counted(held)

    each = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(count, "word string, n long")
    return each.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _counted(held: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])


_rng = np.random.default_rng(712)
_BASES = [int(b) * 8 + 5 for b in _rng.integers(2**57, 2**60, 2)]
_LETTERS = _rng.integers(1, 2**63, (2, 256), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base), np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _hashed(word: str, size: int) -> list[str]:
    """Names of the first ``size`` characters of every rotation of a long marked word, from two rolling hashes."""
    raw = np.frombuffer((word + END).encode("latin-1"), np.uint8)
    twice = np.concatenate([raw, raw])
    names = []
    for base, letters in zip(_BASES, _LETTERS, strict=True):
        up, down = _powers(base, len(twice) + 1), _powers(pow(base, -1, 2**64), len(raw))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters[twice] * up[:-1], dtype=np.uint64)])
        # brought down to one power, so that equal characters have equal sums wherever they stand
        names.append(mix((total[size:size + len(raw)] - total[:len(raw)]) * down))
    return [f"{END}{x:016x}{y:016x}{size}" for x, y in zip(*(n.tolist() for n in names), strict=True)]


def rotations(word: str) -> tuple[list[str], list[str]]:
    """Keys and last characters: every rotation but its last character with that character, and every whole rotation with none."""
    marked, n = word + END, len(word)
    places = range(1, n + 1)
    if n <= WRITTEN:
        skipping = [marked[j:] + marked[:j - 1] for j in places]
    else:
        at = _hashed(word, n)
        skipping = [at[j % (n + 1)] for j in places]
    whole = [marked[j:] + marked[:j] for j in range(n + 1)] if n + 1 <= WRITTEN else _hashed(word, n + 1)
    return skipping + whole, [*word] + [""] * (n + 1)


def _rotate(batches: Iterator[pa.RecordBatch], rows: int = 50_000) -> Iterator[pa.RecordBatch]:
    out: tuple[list, ...] = ([], [], [], [], [])

    def batch() -> pa.RecordBatch:
        kinds = (pa.string(), pa.string(), pa.bool_(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds, strict=True)], ["key", "last", "doubled", "id", "n"])

    for b in batches:
        for i, word, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
            keys, lasts = rotations(word)
            # of a run of equal letters the first stands for all: leaving out any of them gives the same word
            doubled = [False, *[x == y for x, y in zip(word, word[1:], strict=False)]] + [False] * (len(word) + 1)
            for o, values in zip(out, (keys, lasts, doubled, [i] * len(keys), [n] * len(keys)), strict=True):
                o.extend(values)
            if len(out[0]) >= rows:
                yield batch()
                out = ([], [], [], [], [])
    if out[0]:
        yield batch()


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours within sorted keys, in both directions. A key has a row for each letter at most, and one whole rotation."""
    def found(t: pa.Table) -> pa.RecordBatch:
        code = t["key"].combine_chunks().dictionary_encode().indices.to_numpy()
        whole = np.array(t["last"].combine_chunks().to_pylist()) == ""
        doubled, ids, n = (np.array(t[c]) for c in ("doubled", "id", "n"))
        left, right = [], []
        for step in range(1, len(code)):
            i = np.flatnonzero(code[:-step] == code[step:])
            if not len(i):
                break
            j = i + step
            i, j = i[(keep := ~(whole[i] & doubled[j] | whole[j] & doubled[i]))], j[keep]
            left += [i, j]
            right += [j, i]
        i, j = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (left, right))
        return pa.RecordBatch.from_arrays([pa.array(ids[i]), pa.array(ids[j]), pa.array(n[j])], ["id", "near", "near_n"])

    open_: list[pa.RecordBatch] = []
    for batch in batches:
        keys = batch.column(0)
        if batch.num_rows == 0:
            continue
        at = batch.num_rows  # the last key may go on in the next batch
        while at and keys[at - 1] == keys[batch.num_rows - 1]:
            at -= 1
        if at or (open_ and open_[-1].column(0)[-1] != keys[0]):
            yield found(pa.Table.from_batches([*open_, batch.slice(0, at)]))
            open_ = []
        open_.append(batch.slice(at))
    if open_:
        yield found(pa.Table.from_batches(open_))


def neighbours(words: DataFrame) -> DataFrame:
    """``id, near, near_n`` for all pairs of distinct words (``id, word, n``) one edit apart, in both directions, each once."""
    turned = words.select("id", "word", "n").mapInArrow(_rotate, "key string, last string, doubled boolean, id long, n long")
    return turned.repartition("key").sortWithinPartitions("key", "last").mapInArrow(_scan, "id long, near long, near_n long")


def variants(docs: DataFrame, *, every: int = 97, least_chars: int = 5, least_n: int = 3, times: int = 2) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of ``word_counts``.

    A word's form is its near word (one code point inserted, deleted or replaced) of largest n, ties to the smallest in
    code-point order, if that n is at least ``times`` * n; its root is where forms end. Counts at least double along the
    way, so roots are found by a number of doubling joins that is the logarithm of a logarithm of the largest count.

    Null and empty texts have no words; a null id is written as an empty one; repeated rows count each. Very long words are compared
    like others, by hashes of their rotations. Other columns are ignored; an empty table gives no rows.
    """
    counted = word_counts(docs, every=every, least_chars=least_chars, least_n=least_n)
    # numbered in code-point order, so the smaller number wins ties
    words = stored(counted.orderBy("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "words")
    near = neighbours(words).groupBy("id").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("first"))
    known = stored(words.join(near, "id", "left").select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(-F.col("first.less") >= times * F.col("n"), F.col("first.near")).alias("form")), "word-forms")
    largest = known.agg(F.max("n")).first()[0]
    links = known.where("form IS NOT NULL").select("id", F.col("form").alias("root"))
    longest = max(1, int(math.log(max(2, largest or 2), times))) if times > 1 else largest or 1
    for _ in range(math.ceil(math.log2(longest + 1))):
        onward = links.select(F.col("id").alias("root"), F.col("root").alias("onward"))
        links = stored(links.join(onward, "root", "left").select("id", F.coalesce("onward", "root").alias("root")), "word-roots")
    names = known.select("id", "word", "n")
    out = (
        known.join(links, "id", "left")
        .join(names.toDF("form", "form_word", "form_n"), "form", "left")
        .join(names.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root", "left")
    )
    return out.select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", "form_n")


# DuckDB SQL of the query over all documents: the checksum bit by bit, neighbours by the words that lack one character.
VARIANTS_SQL = r"""
WITH RECURSIVE t AS (
  SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(b))),
r AS (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                               '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
d AS (SELECT doc_id, run, count(*) AS n FROM r GROUP BY ALL),
u AS (SELECT doc_id, run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, [('0x' || x)::BIGINT for x in regexp_extract_all(hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), '..')]),
    lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]))) AS h FROM d, t),
e AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM u),
w AS (SELECT word, sum(n)::BIGINT AS n FROM e WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
l AS (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS less FROM w, range(1, length(word) + 1) s(i)),
p AS (SELECT a.word AS a, b.word AS b FROM l a JOIN l b ON a.less = b.less AND a.i = b.i AND a.word <> b.word
      UNION SELECT l.word, w.word FROM l JOIN w ON l.less = w.word UNION SELECT w.word, l.word FROM l JOIN w ON l.less = w.word),
f AS (SELECT w.word, w.n, count(o.word) AS n_near, first(o.word ORDER BY o.n DESC, encode(o.word)) AS f, max(o.n) AS f_n
      FROM w LEFT JOIN p ON p.a = w.word LEFT JOIN w o ON o.word = p.b GROUP BY ALL),
g AS (SELECT word, n, n_near, CASE WHEN f_n >= 2 * n THEN f END AS form, CASE WHEN f_n >= 2 * n THEN f_n END AS form_n FROM f),
o AS (SELECT word, coalesce(form, word) AS root, form IS NULL AS ended FROM g
      UNION ALL SELECT o.word, coalesce(g.form, g.word), g.form IS NULL FROM o JOIN g ON g.word = o.root WHERE NOT o.ended)
SELECT g.word, g.form, o.root, g.n, g.n_near::BIGINT AS n_near, g.form_n FROM g JOIN o ON o.word = g.word AND o.ended
"""
