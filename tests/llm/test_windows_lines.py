"""Substring dedup, line dedup and token files against plain versions."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
import xxhash
from fixtures import SCHEMA, documents, prose, rows, words

from pyspark.sql import functions as F

from strata.llm import common, packing, phrase_automata, segment_edit, separator_scan
from strata.llm.common import run_dir
from strata.llm.tokens import encode


def plain_windows(data, window):
    lists = [(d, words(t)) for d, t in data]
    seen = Counter(tuple(ws[i:i + window]) for _, ws in lists for i in range(len(ws) - window + 1))
    out = []
    for d, ws in lists:
        gone = set()
        for i in range(len(ws) - window + 1):
            if seen[tuple(ws[i:i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [w for i, w in enumerate(ws) if i not in gone]
        out.append((d, len(ws), len(ws) - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize("shard", [4, 1024])  # a small shard makes every repeated anchor a hot one
def test_substring_dedup(spark, shard):
    data = rows()
    assert got(phrase_automata.dedup(documents(spark), shard=shard)) == plain_windows([r[:2] for r in data], 35)


def test_substring_dedup_of_stitched_passages(spark):
    rng = random.Random(2)
    pieces = [prose(rng, n) for n in (34, 35, 36, 50, 80)]
    data = [(i, " ".join(rng.choice(pieces) for _ in range(rng.randint(1, 4))) + " " + prose(rng, 5)) for i in range(60)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert got(phrase_automata.dedup(df, shard=16)) == plain_windows(data, 35)


@pytest.mark.parametrize("heaviest", [1, 6, 10_000])  # all keys merged, the heavy ones sent, all of them sent
def test_heavy_keys_meet_where_they_are(spark, monkeypatch, heaviest):
    monkeypatch.setattr(common, "HEAVIEST", heaviest)
    rng = random.Random(9)
    phrase = prose(rng, 60)
    data = [(i, f"{prose(rng, rng.randint(0, 20))} {phrase} {prose(rng, rng.randint(0, 20))}") for i in range(30)]
    data += [(100 + i, prose(random.Random(i // 2), 50)) for i in range(12)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert got(phrase_automata.dedup(df, shard=4)) == plain_windows(data, 35)
    rows = spark.createDataFrame([(k, i) for k, n in (("a", 40), ("b", 3), ("c", 2), ("d", 1)) for i in range(n)], "k string, i long")
    counts = rows.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
    assert got(common.with_counts(rows, counts, ["k"], "n", 46)) == got(rows.join(counts, "k"))


def test_windows_of_copies_are_counted_once(spark, monkeypatch):
    sizes = []

    def noted(df, name):
        out = common.stored(df, name)
        if name == "hot-windows":
            sizes.append(out.count())
        return out

    monkeypatch.setattr(phrase_automata, "stored", noted)
    rng = random.Random(4)
    passages = [prose(rng, 60) for _ in range(6)]
    for copies in (6, 30):
        data = list(enumerate(passages * copies))
        df = spark.createDataFrame(data, "doc_id long, text string")
        assert got(phrase_automata.dedup(df, shard=4)) == plain_windows(data, 35)
    assert sizes[0] == sizes[1] <= 6 * 26


@pytest.mark.parametrize("shard", [1, 1024])
def test_phrases_repeated_without_end(spark, shard):
    rng = random.Random(6)
    data = []
    for period in (1, 2, 7, 11, 12, 13, 24, 34, 35, 36):
        phrase = prose(rng, period)
        data += [(len(data) + k, " ".join([prose(rng, k), *[phrase] * (times // period + 1), prose(rng, 4 - k)])) for k, times in enumerate((34, 36, 70, 150))]
        cut = phrase.split()[: period // 2]
        data.append((len(data), " ".join([phrase] * 3 + cut + [prose(rng, 40)] + cut + [phrase] * 5)))
    assert got(phrase_automata.dedup(spark.createDataFrame(data, "doc_id long, text string"), shard=shard)) == plain_windows(data, 35)


def test_substring_dedup_of_nothing(spark):
    assert phrase_automata.dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def distance(a, b):
    last = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(last[j] + 1, now[-1] + 1, last[j - 1] + (x != y)))
        last = now
    return last[-1]


def plain_lines(data, edits, least):
    """Documents are different (id, text); those of one id come in the order of 31 bits of the texts' hashes."""
    def order(doc):
        return doc[0], xxhash.xxh64(doc[1].encode(), seed=42).intdigest() % 2**31

    first = {}
    for d, t in sorted({(d, t) for d, t in data if d is not None and t is not None}, key=order):
        for i, line in enumerate(t.split("\n")):
            if s := line.strip(" \t\n\x0b\x0c\r"):
                first.setdefault(s, (*order((d, t)), i))
    near = {a for a in first for b in first if len(a) >= least and len(b) >= least and first[b] < first[a]
            and abs(len(a) - len(b)) <= edits and distance(a, b) <= edits}
    out = []
    for d, t in data:
        lines = t.split("\n") if t is not None else []
        if d is None or t is None:
            out.append((d, len(lines), 0, 0, t))
            continue
        cut = [x.strip(" \t\n\x0b\x0c\r") for x in lines]
        old = [bool(s) and first[s] != (*order((d, t)), i) for i, s in enumerate(cut)]
        close = [s in near and not o for s, o in zip(cut, old)]
        out.append((d, len(lines), sum(old), sum(close), "\n".join(x for x, o, c in zip(lines, old, close) if not o and not c)))
    return sorted(out, key=str)


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_line_dedup(spark, edits):
    rng = random.Random(edits)
    base = [prose(rng, rng.randint(4, 9)) for _ in range(40)]
    data = []
    for i in range(90):
        lines = []
        for _ in range(rng.randint(0, 4)):
            line = list(rng.choice(base))
            for _ in range(rng.randint(0, edits + 1)):
                k = rng.randrange(len(line))
                line[k:k + rng.randint(0, 1)] = rng.choice(["", "é", "x", " "])
            lines.append("".join(line))
        data.append((i, "\n".join(rng.choice([lines, lines + [""], lines + ["  "]]))))
    data += [(None, "a\na"), (200, None), (201, ""), (202, "\n\n"), (203, "aaaa " * 2000), (204, "b" * 24), (205, "b" * 25), data[0]]
    # different texts under one id, one of them twice
    data += [(300, "\n".join(rng.sample(base, 3) + [f"only in text {k} of three hundred"])) for k in (0, 1, 2, 2)] + [(-5, data[3][1])]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert got(segment_edit.dedup(df, edits=edits)) == plain_lines(data, edits, 24)


def test_texts_under_one_id_lose_no_line(spark):
    near = "a line that both texts have nearly alike"
    data = [(1, f"a\nb\n{near}"), (1, f"c\nd\nunique line of the second text\nlast\n{near}!"), (1, f"a\nb\n{near}")]
    out = segment_edit.dedup(spark.createDataFrame(data, "doc_id long, text string"))
    assert got(out) == plain_lines(data, 2, 24)
    rows = out.collect()
    assert all(r.n_repeated >= 0 and r.n_near >= 0 for r in rows)
    assert {x for r in rows for x in r.text.split("\n")} >= {"a", "b", "c", "d", "unique line of the second text", "last"}


@pytest.mark.parametrize("edits", [1, 2, 5])
def test_bit_parallel_distance(spark, edits):
    rng = random.Random(edits)
    pairs = []
    for _ in range(400):
        a = "".join(rng.choice("ab\nñ\U0001f600") for _ in range(rng.randint(6, 40)))
        b = list(a)
        for _ in range(rng.randint(0, edits + 2)):
            k = rng.randrange(len(b) + 1)
            b[k:k + rng.randint(0, 1)] = rng.choice(["", "a", "b", "é"])
        pairs.append((a, "".join(b)))
    df = spark.createDataFrame(pairs, "a string, b string").withColumn("near", segment_edit.within(F.col("a"), F.col("b"), edits))
    rows = df.collect()
    assert [r.near for r in rows] == [distance(r.a, r.b) <= edits for r in rows] and len({r.near for r in rows}) == 2


def test_line_dedup_of_awkward_rows(spark):
    data = [r[:2] for r in rows()]
    out = segment_edit.dedup(documents(spark), carry=["source", "row", "line"])
    assert out.select("row.row", "row.line").distinct().collect() == [("clash", "clash")]
    assert got(out.drop("row")) == plain_lines(data, 2, 24)
    assert segment_edit.dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def test_line_dedup_skips_no_length_in_silence(spark):
    df = spark.createDataFrame([(1, "a line of thirty characters ok"), (2, "a line of thirty characters no")], "doc_id long, text string")
    with pytest.raises(ValueError):
        segment_edit.dedup(df, edits=10)
    assert [r.n_near for r in segment_edit.dedup(df, edits=7).orderBy("doc_id").collect()] == [0, 1]


def test_line_dedup_runs_no_python(spark, capsys):
    segment_edit.dedup(documents(spark)).explain()
    assert "Python" not in (plan := capsys.readouterr().out) and "Arrow" not in plan


@pytest.mark.parametrize("block", [3, 64, 1 << 20])
def test_token_counts(spark, block):
    data = rows()
    out = separator_scan.token_counts(documents(spark), block_tokens=block if block > 3 else 3)
    if block == 3:  # blocks far smaller than documents: keep it short
        data = [r for r in data if not r[1] or len(r[1]) < 300]
        out = separator_scan.token_counts(documents(spark, data), block_tokens=3)
    assert sorted(((r.doc_id, r.n_tokens) for r in out.collect()), key=str) == sorted(
        ((r[0], len(encode(r[1]))) for r in data), key=str)


def test_token_files_of_others(spark):
    folder = run_dir(spark, "flat")
    place = folder.removeprefix("file:")
    import os
    os.makedirs(place)
    np.array([5, 9, 6, 9, 9, 7], "<u2").tofile(f"{place}/a.bin")
    np.array([9], "<u2").tofile(f"{place}/b.bin")
    np.array([], "<u2").tofile(f"{place}/c.bin")
    with open(f"{place}/d.bin", "wb") as f:
        f.write(np.array([1, 2, 9], "<u2").tobytes() + b"\x01")
    for block in (1, 2, 100):
        out = separator_scan.count_tokens(spark, folder, separator=9, block_tokens=block)
        assert got(out) == [("a.bin", 0, 0, 1, True), ("a.bin", 1, 2, 1, True), ("a.bin", 2, 4, 0, True), ("a.bin", 3, 5, 1, False),
                            ("b.bin", 0, 0, 0, True), ("d.bin", 0, 0, 2, True)]


def test_token_counts_of_nothing(spark):
    assert separator_scan.token_counts(spark.createDataFrame([], SCHEMA)).collect() == []


def test_packing_is_a_round_trip(spark):
    import zlib

    import public_tokenizers
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    data = rows() + [(900, "before <|endoftext|> after", *rows()[0][2:]), (901, "a  b\n\n\n c ​ \U0001f600'll 12345", *rows()[0][2:])]
    pieces = packing.pack(documents(spark, data), longest=256, with_ids=True).collect()
    assert all(p.length & (p.length - 1) == 0 and p.length <= 256 and p.offset == 0 for p in pieces)
    assert len({p.sequence_id for p in pieces}) == len(pieces)
    assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) for p in pieces)
    want = Counter()
    for r in data:
        ids = (*plain.encode(r[1] or "", add_special_tokens=False).ids, 1)
        sizes = packing.lengths(len(ids), 256)
        starts = np.cumsum([0, *sizes[:-1]]).tolist()
        assert sum(sizes) == len(ids)
        want.update((r[0], s, ids[s:s + n], len(ids)) for s, n in zip(starts, sizes, strict=True))
    assert Counter((p.doc_id, p.start, tuple(p.ids), p.doc_tokens) for p in pieces) == want


def test_buckets_are_numbered_without_gaps(spark):
    pieces = packing.pack(documents(spark), longest=256).collect()
    buckets = {}
    for p in pieces:
        assert p.length == 1 << p.bucket
        buckets.setdefault(p.bucket, []).append((p.place, p.sequence_id))
    first = 0
    for b in sorted(buckets, reverse=True):
        assert sorted(buckets[b]) == [(k, first + k) for k in range(len(buckets[b]))]
        first += len(buckets[b])
    assert packing.pack(spark.createDataFrame([], SCHEMA)).collect() == []


def test_binary_lengths():
    assert packing.lengths(5000, 2048) == [2048, 2048, 512, 256, 128, 8]
    assert all(sum(packing.lengths(n, 64)) == n for n in range(1, 300))
    assert packing.pack.__doc__


def test_keys_of_wide_and_narrow_lines_are_hashes_of_their_segments(spark):
    """Lines of one-byte characters are cut as bytes, others by characters: equal segments have equal keys."""
    lines = ["the quick brown fox jumps over it", "the quick brown fox jumps over ñ!", "ñandú 漢字 𝔘𝔫𝔦 and plain words behind it"]
    df = spark.createDataFrame([(i, 5, x, len(x)) for i, x in enumerate(lines)], "id long, letters long, line string, n int")
    for index in (True, False):
        want, spots = [], segment_edit.places(2, index)
        for i, x in enumerate(lines):
            for less, k, shift in spots:
                n = len(x) - less
                size, more = divmod(n, 3)
                at = size * k + max(0, k - 3 + more) + shift
                want.append((i, n, k, x[at:at + size + (k >= 3 - more)], less == shift == 0))
        hashed = spark.createDataFrame(want, "id long, n int, i int, piece string, indexed boolean").selectExpr(
            "id", "if(indexed, 5L | -9223372036854775808L, 5L) AS letters", "xxhash64(n, i, piece) AS key")
        assert sorted(segment_edit.keys(df, 2, index).collect()) == sorted(hashed.collect())


def test_stored_lines_are_trimmed_once(spark, monkeypatch):
    """What the join reads is the line itself, so that no reader trims it again."""
    held, stored = {}, segment_edit.stored
    monkeypatch.setattr(segment_edit, "stored", lambda df, name: held.setdefault(name, stored(df, name)))
    segment_edit.dedup(documents(spark, [(1, "  a line of thirty characters!!\t\nb", *[None] * 3, *["clash"] * (len(SCHEMA.split(",")) - 5))])).collect()
    assert {r.line for r in held["lines"].collect()} == {"a line of thirty characters!!", "b"}
