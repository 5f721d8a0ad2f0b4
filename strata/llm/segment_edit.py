"""Line dedup by a segment-partition edit join, in DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACES, stored

EDITS = 2
LEAST = 24
# Letters whose counts make up a line's sketch.
LETTERS = "entiaos"


def _segment(n: Column, i: Column, parts: int) -> tuple[Column, Column]:
    """Start (from 0) and length of segment i of a line of n characters; the last segments take the remainder."""
    more = n % parts
    size = ((n - more) / parts).cast("int")
    return size * i + F.greatest(F.lit(0), i - parts + more), size + (i >= parts - more).cast("int")


def places(edits: int, index: bool) -> list[tuple[int, int, int]]:
    """(characters fewer, segment, shift): where a segment of a line of equal or smaller length can lie in this one.

    A pair within the distance has a segment i without edits that has at most i edits before it and at most
    ``edits`` - i behind it, which bounds the shift from both ends. Unshifted segments of equal length are a line's
    index keys; the others are only probed.
    """
    out = [(less, i, shift) for less in range(edits + 1) for i in range(edits + 1)
           for shift in range(max(-i, less - (edits - i)), min(i, less + (edits - i)) + 1)]
    return [p for p in out if (p[0] == p[2] == 0) or not index]


def keys(lines: DataFrame, edits: int, index: bool) -> DataFrame:
    """``id, letters, key`` for every place of every line (``id, letters, line, n``).

    A character is found by counting from the start of the line; where all have one byte, places are cut out of its bytes.
    """
    spots = F.array(*[F.struct(*[F.lit(v).alias(k) for k, v in zip(("less", "i", "shift"), p, strict=True)]) for p in places(edits, index)])
    raw = F.when(F.octet_length("line") == F.col("n"), F.col("line").cast("binary"))
    each = lines.select("id", "letters", "line", "n", raw.alias("raw"), F.inline(spots))
    n = F.col("n") - F.col("less")
    at, size = _segment(n, F.col("i"), edits + 1)
    at = at + F.col("shift") + 1
    piece = F.when(F.col("raw").isNotNull(), F.substring("raw", at, size)).otherwise(F.substring("line", at, size).cast("binary"))
    # the sketch's free bit tells keys that are in the index too from those that are only probed
    mark = F.when((F.col("less") == 0) & (F.col("shift") == 0), F.col("letters").bitwiseOR(F.lit(-(2**63)))).otherwise(F.col("letters"))
    return each.select("id", mark.alias("letters"), F.xxhash64(n, F.col("i"), piece).alias("key"))


def with_letters(lines: DataFrame) -> DataFrame:
    """Adds ``letters``: counts of seven letters, a byte each, and the length in seven bits; the highest bit is free.

    Letter by letter is taken out of what the last one left, so each step reads less; the letters take a byte each.
    """
    out, total = lines.withColumn("strata_rest0", F.col("line")), F.shiftleft(F.pmod(F.length("line"), F.lit(128)).cast("long"), 8 * len(LETTERS))
    for k, c in enumerate(LETTERS):
        out = out.withColumn(f"strata_rest{k + 1}", F.replace(F.col(f"strata_rest{k}"), F.lit(c), F.lit("")))
        count = F.octet_length(f"strata_rest{k}") - F.octet_length(f"strata_rest{k + 1}")
        total = total.bitwiseOR(F.shiftleft(F.pmod(count, F.lit(256)).cast("long"), 8 * k))
    return out.select(*lines.columns, total.alias("letters"))


def _may_be_near(a: Column, b: Column, edits: int) -> Column:
    """Could lines of these counts be within the distance?

    A replaced character changes the counts of all letters, those of no letter listed taken together, by two at most, a
    character more or less by one. So their differences sum up to two an edit, less one for each character that one line has more.
    """
    def byte(x: Column, k: int) -> Column:
        return F.shiftrightunsigned(x, 8 * k).bitwiseAND(255).cast("int")

    def gap(x: Column, y: Column, around: int = 256) -> Column:
        d = F.abs(x - y)
        return F.least(d, around - d)

    total, rest_a, rest_b = F.lit(0), byte(a, len(LETTERS)).bitwiseAND(127), byte(b, len(LETTERS)).bitwiseAND(127)
    longer = gap(rest_a, rest_b, 128)
    for k in range(len(LETTERS)):
        total = total + gap(byte(a, k), byte(b, k))
        rest_a, rest_b = rest_a - byte(a, k), rest_b - byte(b, k)
    others = gap(F.pmod(rest_a, F.lit(128)), F.pmod(rest_b, F.lit(128)), 128)
    return total + others <= 2 * edits - longer


def within(a: Column, b: Column, edits: int) -> Column:
    """Are two texts within ``edits`` edits? A banded bit-parallel walk along the characters of ``b``.

    Behind j characters of ``b``, bit d of the e-th number says that the first j + d - edits characters of ``a`` become them
    with at most e edits: 2 * edits + 1 bits whatever the length. A character keeps the bits where both texts agree; an edit
    comes from the number before, on the same diagonal (replaced), the one above (inserted) or the one below (left out).
    """
    if 2 * edits + 1 > 63:
        raise ValueError("the band has to fit into one number: at most 31 edits")

    def number(x: int) -> Column:
        return F.lit(x).cast("long")

    def bits(left: Column, x: Column, j: Column) -> Column:
        out = number(0)
        for bit in range(2 * edits + 1):
            out = out.bitwiseOR(F.when(F.get(left, j + (bit - edits)) == x, number(1 << bit)).otherwise(number(0)))
        return out

    def step(held: Column, agree: Column) -> Column:
        out = [held["r0"].bitwiseAND(agree)]
        for e in range(1, edits + 1):
            before = held[f"r{e - 1}"]
            edited = before.bitwiseOR(F.shiftright(before, 1)).bitwiseOR(F.shiftleft(out[-1], 1))
            out.append(held[f"r{e}"].bitwiseAND(agree).bitwiseOR(edited).bitwiseAND(number((1 << 2 * edits + 1) - 1)))
        return F.struct(*[x.alias(f"r{e}") for e, x in enumerate(out)])

    start = F.struct(*[number((1 << e + 1) - 1 << edits).alias(f"r{e}") for e in range(edits + 1)])
    # characters as an argument of a lambda function are cut once a pair, and not once a character
    left, right = (F.when(x == "", F.array().cast("array<string>")).otherwise(F.split(x, F.lit(""))) for x in (a, b))
    texts = F.array(F.struct(left.alias("left"), right.alias("right")))
    same = F.transform(texts, lambda p: F.transform(p["right"], lambda x, j: bits(p["left"], x, j)))[0]
    last = F.aggregate(same, start, step)[f"r{edits}"]
    diagonal = F.length(a) - F.length(b) + edits
    bit = F.get(F.array(*[number(1 << d) for d in range(2 * edits + 1)]), diagonal)
    return F.when(diagonal.between(0, 2 * edits), last.bitwiseAND(bit) != 0).otherwise(False)


#: A place is one number, so that the first one is found by hashing: the id, 31 bits of the text's hash, the line number.
_DIGIT = 2**31


def _hash31(text: Column) -> Column:
    return F.pmod(F.xxhash64(text), F.lit(_DIGIT)).cast("long")


def _text_place(doc_id: Column, hash31: Column) -> Column:
    """The place of a text's line 0, computed once a text; a line's number is added to it."""
    low = (hash31 * _DIGIT).cast("decimal(19,0)")
    return (doc_id.cast("decimal(19,0)") * F.lit(_DIGIT * _DIGIT).cast("decimal(19,0)") + low).cast("decimal(38,0)")


def _unplaced(place: Column, doc_id: Column) -> dict[str, Column]:
    """The parts of a place whose id is known, so nothing is divided."""
    low = (place - _text_place(doc_id, F.lit(0).cast("long"))).cast("long")
    return {"doc_id": doc_id, "hash31": F.shiftright(low, 31), "line_no": low.bitwiseAND(F.lit(_DIGIT - 1)).cast("int")}


def _cut(text: Column) -> Column:
    return F.split(text, "\n")


def near_pairs(distinct: DataFrame, edits: int = EDITS, least: int = LEAST) -> DataFrame:
    """``a, b``: ids of different lines of ``least`` characters or more within ``edits`` edits; each pair once.

    ``distinct`` has ``id, line, letters``. Only ids, keys and sketches are shuffled; candidates whose letter counts are
    too far apart never leave the join. Texts are looked up for the others and compared bit-parallel.
    Segments need three characters, so ``least`` below 3 * (edits + 1) is an error.
    """
    if least < 3 * (edits + 1):
        raise ValueError(f"lines of {least} characters are too short for segments of {edits} edits: at least {3 * (edits + 1)}")
    base = distinct.withColumn("n", F.length("line")).where(F.col("n") >= least)
    left = keys(base, edits, True).toDF("a", "a_letters", "key")
    right = keys(base, edits, False).toDF("b", "b_letters", "key_b")
    near = _may_be_near(F.col("a_letters"), F.col("b_letters"), edits)
    # two index keys meet from both sides, so once is enough
    once = F.when(F.col("b_letters") < 0, F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b"))
    found = left.join(right, (F.col("key") == F.col("key_b")) & once & near)
    pairs = stored(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "line-candidates")
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    texts = stored(distinct.select("id", "line").join(wanted.hint("merge"), "id", "left_semi"), "candidate-lines")
    both = pairs.join(texts.toDF("a", "a_line"), "a").join(texts.toDF("b", "b_line"), "b")
    return both.where(within(F.col("a_line"), F.col("b_line"), edits)).select("a", "b")


def dedup(docs: DataFrame, *, edits: int = EDITS, least: int = LEAST, carry: list[str] | None = None) -> DataFrame:
    """``doc_id, n_lines, n_repeated, n_near, text`` of every document, the text without repeated lines
    (and ``row``, a struct of the columns ``carry``).

    A line is dropped if it, without outer white space, occurs earlier (smaller doc_id, then smaller line number), or if
    it has ``least`` characters or more and a line within ``edits`` edits occurs first earlier than it does. Blank
    lines stay. Where lines first occur is found without their texts, by one number for a place; a line that a third of all
    documents hold is one row after partial aggregation and is never joined back to its occurrences.

    Null text stays null and has no lines. Documents without an id are returned as they are and their lines do not
    count. Rows that repeat an id and its text are one document and all keep its lines; different texts under one id are documents
    of their own, the one of the smaller ``hash31`` before the other. A removed line is checked against its hash, so texts whose
    31 bits agree under one id lose nothing. Other columns are ignored; an empty table gives no rows.
    """
    known = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), _hash31(F.col("text")).alias("hash31"), F.col("text").cast("string").alias("text"))
    start = _text_place(F.col("doc_id"), F.col("hash31")).alias("start")
    rows = known.select("doc_id", start, F.posexplode(_cut(F.col("text"))).alias("line_no", "raw"))
    rows = rows.withColumn("line", F.btrim("raw", F.lit(SPACES))).where("line != ''")
    # two hashes name a line: equal lines meet without their texts as a key
    first = rows.groupBy(F.xxhash64("line").alias("id"), F.hash("line").alias("id2")).agg(
        F.min(F.col("start") + F.col("line_no")).cast("decimal(38,0)").alias("place"), F.min("doc_id").alias("doc_id"))
    spot = F.struct("line_no", "id")
    # the lines that first occur in a document; what meets here is a document's own
    firsts = stored(first.select("id", *[c.alias(k) for k, c in _unplaced(F.col("place"), F.col("doc_id")).items()])
                    .groupBy("doc_id", "hash31").agg(F.collect_list(spot).alias("firsts")), "line-firsts")
    # one row of each text, picked behind the join, so that texts are sorted once, by numbers, and not before they are shuffled
    order = Window.partitionBy("doc_id", "hash31").orderBy("text")
    met = known.join(firsts.hint("merge"), ["doc_id", "hash31"]).withColumn("copy", F.row_number().over(order)).where("copy = 1")
    # cut apart from the lookups: the window keeps it from being moved into the functions that look a line up
    once = met.select("doc_id", "hash31", "firsts", _cut(F.col("text")).alias("lines"))
    # numbers within the text only: a second text of the same 31 bits can be shorter
    inside = F.filter("firsts", lambda w: w["line_no"] < F.size("lines"))
    placed = once.select(
        "doc_id", "hash31", F.inline_outer(F.transform(inside, lambda w: F.struct(
            w["line_no"].alias("line_no"), w["id"].alias("id"), F.btrim(F.get(F.col("lines"), w["line_no"]), F.lit(SPACES)).alias("line"))))
    ).where(F.xxhash64("line") == F.col("id"))
    lines = stored(with_letters(placed), "lines")
    pairs = stored(near_pairs(lines.select("id", "line", "letters"), edits, least), "line-pairs")
    # both sides grow with the input: planned as merges at every size
    place = lines.select("id", F.struct("doc_id", "hash31", "line_no", "id").alias("at")).hint("merge")
    gone = (
        pairs.join(place.select(F.col("id").alias("a"), F.col("at").alias("a_at")), "a")
        .join(place.select(F.col("id").alias("b"), F.col("at").alias("b_at")), "b")
        .select(F.greatest("a_at", "b_at").alias("at")).distinct().select("at.*")
        .groupBy("doc_id", "hash31").agg(F.collect_list(spot).alias("gone"))
    )
    row = [F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")] if carry else []
    names = F.transform(F.transform("lines", lambda x: F.btrim(x, F.lit(SPACES))), lambda x: F.when(x != "", F.xxhash64(x)))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _hash31(F.col("text")).alias("hash31"), *row,
                      _cut(F.col("text").cast("string")).alias("lines")).withColumn("names", names)
    out = out.join(firsts.join(gone, ["doc_id", "hash31"], "left").hint("merge"), ["doc_id", "hash31"], "left")
    return _assembled(out, ["row"] if carry else [])


def _assembled(out: DataFrame, also: list[str]) -> DataFrame:
    """Texts put together from the numbers of their kept lines (``doc_id, lines, names, firsts, gone``; a blank line has no name)."""
    def own(spots: str) -> Column:
        # only if the line at the place is the one meant
        meant = F.filter(F.col(spots), lambda w: F.get(F.col("names"), w["line_no"]) == w["id"])
        return F.coalesce(F.transform(meant, lambda w: w["line_no"]), F.array().cast("array<int>"))

    blank = F.filter(F.transform("names", lambda x, i: F.when(x.isNull(), i)), lambda i: i.isNotNull())
    kept = F.array_sort(F.concat(blank, F.array_except(own("firsts"), own("gone"))))
    new = F.array_join(F.transform(kept, lambda i: F.get(F.col("lines"), i)), "\n")
    same = F.col("doc_id").isNull() | F.col("lines").isNull()
    n_lines = F.coalesce(F.size("lines"), F.lit(0))
    repeated = n_lines - F.size(blank) - F.size(own("firsts"))
    return out.select(
        "doc_id", n_lines.cast("long").alias("n_lines"), F.when(same, F.lit(0)).otherwise(repeated).cast("long").alias("n_repeated"),
        F.when(same, F.lit(0)).otherwise(F.size(own("gone"))).cast("long").alias("n_near"),
        F.when(same, F.array_join("lines", "\n")).otherwise(new).alias("text"), *also)
