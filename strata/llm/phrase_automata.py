"""Substring dedup by repeated-phrase automata.

A window is ``WINDOW`` consecutive words. Each window has an anchor, the sub-phrase of ``ANCHOR`` words whose hash is the
smallest in it, so equal windows have equal anchors. Only text around anchors that occur more than once can repeat.
Those segments meet by anchor, in shards of bounded size: recurring windows are confirmed word by word, compiled into an
Aho-Corasick automaton, and every segment is streamed through it to locate all their occurrences.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import forget, sorted_groups, stored, with_counts
from .wordhash import BY_SPACE, chunks, mix, rolling, words

WINDOW, ANCHOR, CHUNK = 35, 12, 5
#: Occurrences of one anchor that a shard takes whole; more are dealt over several shards.
SHARD = 64
#: Segments of one automaton, unless a single anchor brings more.
BATCH = 1024


def anchors(hashes: np.ndarray, at: np.ndarray, window: int, anchor: int):
    """(text, first window, last window, anchor hash, weight) of the segments of several texts.

    A segment is a run of windows with one anchor hash. Word positions are within the text;
    ``hashes[at[i]:at[i + 1]]`` are the words of text i. The weight is 2 if the anchor occurs more than once in its own
    run, as in a text that repeats a phrase without end, and else 1.
    """
    none = tuple(np.zeros(0, np.int64) for _ in range(3)) + (np.zeros(0, np.uint64), np.zeros(0, np.int64))
    sub = mix(rolling(hashes, anchor))
    reach = window - anchor + 1
    if len(sub) < reach:
        return none
    best = np.lib.stride_tricks.sliding_window_view(sub, reach).argmin(1) + np.arange(len(sub) - reach + 1)
    n = np.diff(at)
    owner = np.repeat(np.arange(len(n)), n)
    start = np.arange(len(best))
    inside = owner[start] == owner[start + window - 1]
    start, best, owner = start[inside], best[inside], owner[start][inside]
    if not len(start):
        return none
    h = sub[best]
    new = np.ones(len(start), bool)
    new[1:] = (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    base = at[owner[first]]
    return owner[first], start[first] - base, start[last] - base, h[first], 1 + (best[last] != best[first])


def _texts(docs: DataFrame) -> DataFrame:
    """``doc, row, doc_id, text``: a document's row is named by its id and the hash of its row."""
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(2**63))).alias("doc"), F.xxhash64("doc_id", "text").alias("row"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _anchor_rows(texts: DataFrame, window: int, anchor: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, rows, cells = np.array(b.column(0)), np.array(b.column(1)), b.column(2).to_pylist()
            for i, j in chunks(cells):
                _, _, _, hashes, at = words(cells[i:j], BY_SPACE)
                owner, place, _, h, weight = anchors(hashes, at, window, anchor)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), pa.array(docs[i:j][owner]), pa.array(rows[i:j][owner]), pa.array(place.astype(np.int32)),
                     pa.array(weight.astype(np.int32))], ["h", "doc", "row", "p", "weight"])

    return texts.select("doc", "row", "text").mapInArrow(run, "h long, doc long, row long, p int, weight int")


def _finished(ws: list[bytes], removed: np.ndarray | None) -> tuple[int, int, str]:
    kept = ws if removed is None else [w for w, gone in zip(ws, removed.tolist(), strict=True) if not gone]
    return len(ws), len(ws) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def _split(texts: DataFrame) -> DataFrame:
    """Texts without a recurring anchor are finished here; the others go on with their text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, sha = [], []
            for text, spots in zip(b.column(3), b.column(4), strict=True):
                count, _, digest = _finished((text.as_py() or "").encode("utf-8", "surrogatepass").split(), None) if not spots.is_valid else (None, 0, None)
                n.append(count)
                sha.append(digest)
            suspect = pc.is_valid(b.column(4))
            text = pc.if_else(suspect, b.column(3), pa.scalar(None, pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), text, b.column(4), pa.array(n, pa.int64()), pa.array(sha, pa.string())],
                                             ["doc", "row", "doc_id", "text", "spots", "n_words", "sha"])

    return texts.mapInArrow(run, "doc long, row long, doc_id long, text string, spots array<struct<p:int,n:long>>, n_words long, sha string")


def _segments(suspects: DataFrame, window: int, anchor: int, shard: int, hot: bool) -> DataFrame:
    """``h, n, doc, row, first, text`` of the segments around recurring anchors, rare or hot ones."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, rows, cells, spots = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()
            for i, j in chunks(cells):
                raw, starts, ends, hashes, at = words(cells[i:j], BY_SPACE)
                out: tuple[list, ...] = ([], [], [], [], [], [])
                wanted = [{s["p"]: s["n"] for s in spots[k] if (s["n"] > shard) == hot} for k in range(i, j)]
                for k, first, last, h, _ in zip(*(x.tolist() for x in anchors(hashes, at, window, anchor)), strict=True):
                    if (n := wanted[k].get(first)) is None:
                        continue
                    lo, hi = at[k] + first, at[k] + last + window - 1
                    piece = b" ".join(raw[starts[lo]:ends[hi]].split()).decode("utf-8", "surrogatepass")
                    for o, value in zip(out, (h - 2**64 if h >= 2**63 else h, n, docs[i + k], rows[i + k], first, piece), strict=True):
                        o.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, kinds, strict=True)],
                                                 ["h", "n", "doc", "row", "first", "text"])

    return suspects.select("doc", "row", "text", "spots").mapInArrow(
        run, "h long, n long, doc long, row long, first int, text string")


def _hot_runs(hot: DataFrame, window: int, anchor: int) -> DataFrame:
    """Hot segments cut once more, at the runs of windows with one longer anchor.

    ``place`` is a run's first window in its segment. ``windows`` holds each different window of the run once: two hashes
    of its words, its first place in the run, and whether it occurs there once or more (1 or 2).
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            docs, rows, firsts, cells = np.array(b.column(0)), np.array(b.column(1)), np.array(b.column(2)), b.column(3).to_pylist()
            for i, j in chunks(cells):
                _, _, _, hashes, at = words(cells[i:j], BY_SPACE)
                owner, place, last, h, weight = anchors(hashes, at, window, anchor)
                size = last - place + 1
                of = np.repeat(np.arange(len(size)), size)
                w = np.arange(len(of)) - (np.cumsum(size) - size)[of]
                spot = (at[owner] + place)[of] + w
                one, two = rolling(hashes, window)[spot], rolling(mix(hashes ^ np.uint64(0x2545F4914F6CDD1D)), window)[spot]
                # only a run that holds its anchor more than once can hold a window more than once
                n, keep, again = np.ones(len(w), np.int32), np.ones(len(w), bool), np.flatnonzero(weight[of] > 1)
                order = again[np.lexsort((two[again], one[again], of[again]))]
                new = np.ones(len(order), bool)
                new[1:] = np.any([x[order][1:] != x[order][:-1] for x in (of, one, two)], axis=0)
                n[order[new]] = np.minimum(np.diff(np.append(np.flatnonzero(new), len(order))), 2)
                keep[order[~new]] = False
                of, w, one, two, n = of[keep], w[keep], one[keep], two[keep], n[keep]
                windows = pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(of, np.arange(len(size) + 1)).astype(np.int32)), pa.StructArray.from_arrays(
                        [pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), pa.array(w.astype(np.int32)), pa.array(n)], ["one", "two", "w", "n"]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(docs[i:j][owner]), pa.array(rows[i:j][owner]), pa.array(firsts[i:j][owner].astype(np.int32)),
                     pa.array(place.astype(np.int32)), pa.array(h.view(np.int64)), windows],
                    ["doc", "row", "first", "place", "a", "windows"])

    return hot.select("doc", "row", "first", "text").mapInArrow(
        run, "doc long, row long, first int, place int, a long, windows array<struct<one:long,two:long,w:int,n:int>>")


def _confirmed_hot(hot: DataFrame, window: int, anchor: int) -> DataFrame:
    """Hot segments with places of the windows that recur, one or more for each different window.

    Runs with equal windows are one kind, so the windows of a kind of several runs recur without being counted. Windows
    are counted, with partial sums and once a kind, where a longer anchor is that of several kinds; only those that occur
    once in a kind of one run meet the counts.
    """
    runs = stored(_hot_runs(hot, window, min(2 * anchor, window - 1)).withColumn("one", F.xxhash64("windows")).withColumn(
        "two", F.xxhash64(F.lit(1), "windows")), "hot-runs")
    kinds = stored(runs.groupBy("one", "two").agg(
        F.count("*").alias("runs"), F.first("a").alias("a"), F.first("windows").alias("windows")).select(
        F.struct("one", "two").alias("kind"), "runs", "a", "windows"), "hot-kinds")
    shared = stored(kinds.groupBy("a").agg(F.count("*").alias("kinds")).where("kinds > 1"), "hot-anchors")
    each = stored(with_counts(kinds, shared, ["a"], "kinds", kinds.count()).select("kind", "runs", F.inline("windows")), "hot-windows")
    many = stored(each.groupBy("one", "two").agg(F.sum(F.when(F.col("runs") > 1, 2).otherwise(F.col("n"))).alias("times")).where("times > 1"), "hot-counts")
    met = with_counts(each.where("runs = 1 AND n = 1"), many, ["one", "two"], "times", 2 * each.count()).groupBy("kind").agg(
        F.collect_list("w").alias("met"))
    own = F.expr("transform(filter(windows, x -> runs > 1 OR x.n > 1), x -> x.w)")
    marked = stored(kinds.join(met, "kind", "left").select(
        "kind.one", "kind.two", "runs", F.concat(own, F.coalesce("met", F.array().cast("array<int>"))).alias("found")).where("size(found) > 0"), "hot-marks")
    marks = with_counts(runs.drop("a", "windows"), marked, ["one", "two"], "runs", runs.count()).groupBy("doc", "row", "first").agg(
        F.flatten(F.collect_list(F.expr("transform(found, x -> x + place)"))).alias("marks"))
    return hot.join(marks, ["doc", "row", "first"])


def _met(texts: list[str], window: int) -> list[list[int]]:
    """Per text the windows whose hash occurs more than once in all of them; windows that are equal have equal hashes."""
    hashes, owners, places = [], [], []
    for i, j in chunks(texts):
        _, _, _, h, at = words(texts[i:j], BY_SPACE)
        h, n = rolling(h, window), np.diff(at)
        owner = np.repeat(np.arange(len(n)), n)[:len(h)]
        place = np.arange(len(h)) - at[owner]
        ok = place <= n[owner] - window
        hashes.append(h[ok])
        owners.append(owner[ok] + i)
        places.append(place[ok])
    _, which, times = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    more = times[which] > 1
    owner, place = np.concatenate(owners)[more], np.concatenate(places)[more].tolist()
    at = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
    return [place[i:j] for i, j in zip(at, at[1:], strict=False)]


def _locate(segments: DataFrame, window: int) -> DataFrame:
    """``doc, row, start, stop``: words covered by recurring windows, segment by segment.

    ``g`` deals segments to shards. Rare anchors come whole, so windows are confirmed by counting them in the shard;
    hot ones bring ``marks``. Letters of the automaton are five-word chunks, so a window is seven letters at one of five
    phases, and each segment is streamed once for each phase.
    """
    def search(batch: list[tuple[int, int, int, str, list[int] | None]]):
        import ahocorasick
        # equal segments are spelled and searched once
        members: dict[str, list[tuple[int, int, int]]] = {}
        marked: dict[str, list[int]] = {}
        for doc, row, first, text, marks in batch:
            members.setdefault(text, []).append((doc, row, first))
            if marks is not None:
                marked[text] = marks
        names: dict[tuple, int] = {}
        numbers: dict[str, int] = {}
        seen: Counter = Counter()
        known: set[tuple] = set()
        spelled = {}
        if not members:
            return
        for (text, places), met in zip(members.items(), _met(list(members), window), strict=True):
            if len(places) == 1 and not met and text not in marked:
                continue  # none of its windows occurs anywhere else
            ids = [numbers.setdefault(w, len(numbers)) for w in text.split(" ")]
            spelled[text] = letters = [names.setdefault(t, len(names)) for t in zip(*(ids[k:] for k in range(CHUNK)), strict=False)]
            if text in marked:
                known.update(tuple(letters[s:s + window:CHUNK]) for s in marked[text])
            elif len(places) > 1:
                known.update(tuple(letters[s:s + window:CHUNK]) for s in range(len(ids) - window + 1))
            else:
                seen.update(tuple(letters[s:s + window:CHUNK]) for s in met)
        known.update(t for t, n in seen.items() if n > 1)
        if not known:
            return
        depth = window // CHUNK
        automaton = ahocorasick.Automaton(ahocorasick.STORE_LENGTH, ahocorasick.KEY_SEQUENCE)
        for t in known:
            automaton.add_word(t)
        automaton.make_automaton()
        for text, letters in spelled.items():
            found = sorted(phase + CHUNK * (end - depth + 1) for phase in range(CHUNK)
                           for end, _ in automaton.iter(tuple(letters[phase::CHUNK])))
            spans, start, stop = [], -1, -1
            for s in found:
                if s > stop:
                    if stop > start:
                        spans.append((start, stop))
                    start = s
                stop = s + window
            if stop > start:
                spans.append((start, stop))
            for doc, row, first in members[text]:
                for start, stop in spans:
                    yield doc, row, first + start, first + stop

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def result():
            rows = list(search(held))
            cols = list(zip(*rows, strict=True)) if rows else [[], [], [], []]
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], ["doc", "row", "start", "stop"])

        for group in sorted_groups(batches, ["g"]):
            held.extend(zip(*(group[c].to_pylist() for c in ("doc", "row", "first", "text", "marks")), strict=True))
            if len(held) >= BATCH:
                yield result()
                held = []
        yield result()

    return segments.select("g", "doc", "row", "first", "text", "marks").repartition("g").sortWithinPartitions("g").mapInArrow(
        run, "doc long, row long, start int, stop int")


def dedup(docs: DataFrame, *, window: int = WINDOW, anchor: int = ANCHOR, shard: int = SHARD) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` of every document.

    A word goes if a window that covers it starts anywhere else too, in its own document or another. Words are runs of
    anything but space, tab, LF, VT, FF and CR, taken unchanged. Null text has no words. Rows that are equal in id and
    text are documents of their own, so they remove each other; null ids are kept apart by their texts. Other columns
    are ignored; an empty table gives no rows. ``window`` must be a multiple of five and longer than ``anchor``.
    """
    if window % CHUNK or window <= anchor:
        raise ValueError("the window must be a multiple of five words and longer than the anchor")
    texts = _texts(docs)
    found = stored(_anchor_rows(texts, window, anchor), "anchors")
    often = stored(found.groupBy("h").agg(F.sum("weight").alias("n")).where("n > 1"), "recurring-anchors")
    spots = with_counts(found, often, ["h"], "n", 2 * found.count()).groupBy("doc", "row").agg(F.collect_set(F.struct("p", "n")).alias("spots"))
    parted = stored(_split(texts.join(spots, ["doc", "row"], "left").select("doc", "row", "doc_id", "text", "spots")), "suspects")
    forget(found)
    forget(often)
    suspects = parted.where("spots IS NOT NULL")
    none = F.lit(None).cast("array<int>")
    rare = _segments(suspects, window, anchor, shard, False).select(F.col("h").alias("g"), "doc", "row", "first", "text", none.alias("marks"))
    hot = stored(_segments(suspects, window, anchor, shard, True), "hot-segments")
    dealt = F.xxhash64("h", F.pmod(F.xxhash64("doc", "row", "first"), F.ceil(F.col("n") / shard)))
    crowded = _confirmed_hot(hot, window, anchor).select(dealt.alias("g"), "doc", "row", "first", "text", "marks")
    covered = _locate(rare.union(crowded), window).groupBy("doc", "row").agg(
        F.collect_set(F.struct("start", "stop")).alias("covered"))

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: tuple[list, ...] = ([], [], [])
            for text, spans in zip(b.column(1), b.column(2).to_pylist(), strict=True):
                ws = (text.as_py() or "").encode("utf-8", "surrogatepass").split()
                gone = np.zeros(len(ws), bool)
                for s in spans or ():
                    gone[s["start"]:s["stop"]] = True
                for o, value in zip(out, _finished(ws, gone), strict=True):
                    o.append(value)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.string())],
                                             ["doc_id", "n_words", "n_removed", "kept_sha256"])

    changed = suspects.join(covered, ["doc", "row"], "left").select("doc_id", "text", "covered").mapInArrow(
        finish, "doc_id long, n_words long, n_removed long, kept_sha256 string")
    return parted.where("spots IS NULL").select(
        "doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), F.col("sha").alias("kept_sha256")).union(changed)


DEDUP_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT r, unnest(range(1, len(w) - 33)) AS p FROM d WHERE len(w) >= 35),
g AS (SELECT s.r, s.p, md5(array_to_string(d.w[s.p:s.p + 34], ' ')) AS k FROM s JOIN d USING (r)),
m AS (SELECT k FROM g GROUP BY k HAVING count(*) > 1),
c AS (SELECT DISTINCT g.r, unnest(range(g.p, g.p + 35)) AS i FROM g JOIN m USING (k)),
u AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
k AS (SELECT u.r, string_agg(u.x, ' ' ORDER BY u.i) AS t, count(*) AS n FROM u ANTI JOIN c USING (r, i) GROUP BY u.r)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, (len(d.w) - coalesce(k.n, 0))::BIGINT AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN k USING (r)
"""
