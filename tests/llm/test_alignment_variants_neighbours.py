"""Token alignment, spelling variants and nearest neighbours against plain versions."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from fixtures import SCHEMA, documents, prose, rows

from strata.llm import alignment, cross_polytope, packing, permuterm, separator_scan
from strata.llm.queries import QUERIES
from strata.llm.tokens import END_TEXT, encode, patient_encoder


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- token alignment ---


def plain_sides(text):
    """Tokens of a text under both tokenizers with their ends, or none if a tokenizer does not give the text back."""
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer, decoders

    if not text:
        return [], []
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    a_ids = a.encode(" " + text, add_special_tokens=False).ids
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    b_ids = b.encode(text)
    table = {chr(c): c for r in ((33, 127), (161, 173), (174, 256)) for c in range(*r)}
    table |= {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in table.values())}
    assert decoders.ByteLevel().decode([a.id_to_token(i) for i in a_ids]) == " " + text
    a_bytes = [bytes(table[c] for c in a.id_to_token(i)) for i in a_ids]
    b_bytes = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in b_ids]
    out = []
    for ids, parts in ((a_ids, a_bytes), (b_ids, b_bytes)):
        if b"".join(parts) != (" " + text).encode():
            return [], []
        out.append(list(zip(ids, np.cumsum([len(p) for p in parts]).tolist(), strict=True)))
    return out


def plain_alignment(data):
    per_doc, count = [], Counter()
    for doc_id, text in data:
        a, b = plain_sides(text)
        groups, links, low = [], Counter(), 0
        for cut in sorted({e for _, e in a} & {e for _, e in b}):
            one, two = ([i for i, e in side if low < e <= cut] for side in (a, b))
            groups.append(",".join(map(str, one)) + "|" + ",".join(map(str, two)))
            links.update((x, y) for x in one for y in two)
            low = cut
        count.update(links.keys())
        per_doc.append((doc_id, len(a), len(b), groups, links))
    highest = Counter()
    for (x, _), n in count.items():
        highest[x] = max(highest[x], n)
    return sorted(((d, n_a, n_b, len(g), sum(links.values()), sum(n for p, n in links.items() if count[p] == highest[p[0]]),
                    sum(n * count[p] for p, n in links.items()), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
                   for d, n_a, n_b, g, links in per_doc), key=str)


@pytest.mark.parametrize("block", [300, 2_000_000])
def test_alignment(spark, block):
    data = [r for r in rows() if not r[1] or len(r[1]) < 5000]
    data += [(900 + i, t, *rows()[0][2:]) for i, t in enumerate([
        f"before {END_TEXT} after <s> </s>", "▁ kept?", "a ▁b", "x" * 700, "ab" * 400, "\n" * 50 + "  x", "é漢\U0001f600" * 40, "1234567890" * 30])]
    assert got(alignment.align_documents(documents(spark, data), block_chars=block)) == plain_alignment([r[:2] for r in data])


def test_alignment_gives_the_groups(spark):
    df = spark.createDataFrame([(1, "shared cuts, unlike tokens: überholtspur")], "doc_id long, text string")
    row = alignment.align_documents(df, with_groups=True).first()
    assert hashlib.sha256(row.groups.encode()).hexdigest() == row.groups_sha256
    a, b = ([int(i) for g in row.groups.split(";") for i in g.split("|")[k].split(",")] for k in (0, 1))
    assert (len(a), len(b)) == (row.n_a, row.n_b) and b == [i for i, _ in plain_sides("shared cuts, unlike tokens: überholtspur")[1]]


@pytest.mark.parametrize("seed", range(30))
def test_cuts_are_the_shared_numbers(seed):
    rng = np.random.default_rng(seed)
    a, b, bounds = [], [], [0]
    for _ in range(rng.integers(1, 6)):
        n = int(rng.integers(0, 200))
        for x in (a, b):
            x += (bounds[-1] + np.flatnonzero(rng.random(n) < rng.choice([0.02, 0.3, 0.9])) + 1).tolist() + ([bounds[-1] + n] if n else [])
        bounds.append(bounds[-1] + n)
    a, b = sorted(set(a)), sorted(set(b))
    cuts = alignment.shared_cuts(np.array(a, np.int64), np.array(b, np.int64), np.array(bounds))
    assert cuts.tolist() == sorted(set(a) & set(b) | set(bounds))


def test_large_groups_count_their_ids_first():
    ids = np.arange(300) % 7
    a = alignment.Side(ids, np.arange(1, 301), np.array([0, 300]))
    b = alignment.Side(ids[:200] + 3, np.arange(1, 201), np.array([0, 200]))
    doc, pair, times = alignment._pairs(a, b, np.array([300]), np.array([200]), np.array([5]))
    want = Counter((int(x) << 16) | int(y) for x in a.ids for y in b.ids)
    assert dict(zip(pair.tolist(), times.tolist(), strict=True)) == want and set(doc.tolist()) == {5}
    tiny = alignment._pairs(a, b, np.ones(200, int), np.ones(200, int), np.repeat([0, 1], 100), slice_links=7)
    want = Counter((i // 100, (int(x) << 16) | int(y)) for i, (x, y) in enumerate(zip(a.ids[:200], b.ids, strict=True)))
    assert Counter(dict(zip(zip(tiny[0].tolist(), tiny[1].tolist(), strict=True), tiny[2].tolist(), strict=True))) == want


def test_alignment_of_nothing(spark):
    assert alignment.align_documents(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("space", [" ", "\t", "\n", "\r\n", " ", " "])
def test_long_white_space_has_the_ids_of_the_tokenizer(space):
    text = "a" + space * (2_000_000 // len(space)) + f"b {END_TEXT} c"
    for special in (True, False):
        assert encode(text, special=special).tolist() == patient_encoder(special).encode(text, add_special_tokens=False).ids


# --- spelling variants ---


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain_variants(data, every=97, least=3):
    import re
    n = Counter()
    for doc_id, text in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % every == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 5 and c >= least}
    by_length = {}
    for w in n:
        by_length.setdefault(len(w), []).append(w)
    close = {w: [v for m in (len(w) - 1, len(w), len(w) + 1) for v in by_length.get(m, []) if near(w, v)] for w in n}
    form = {}
    for w, vs in close.items():
        best = min(vs, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(close[w]), n.get(form[w])))
    return sorted(out, key=str)


def test_variants(spark):
    rng = random.Random(4)
    base = ["".join(rng.choice("abAÉ×") for _ in range(rng.randint(4, 9))) for _ in range(30)]
    chains = ["variant"] * 40 + ["varian"] * 18 + ["vaian"] * 8 + ["vaan", "vaianx"] * 3 + ["aaaaa", "aaaaaa", "aaaaaaa"] * 4
    texts = [" ".join(rng.choice(base + chains) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    data = [(i, t, *rows()[0][2:]) for i, t in enumerate(texts)] + rows() + [(None, texts[0], *rows()[0][2:])]
    for every in (97, 3):
        assert got(permuterm.variants(documents(spark, data), every=every)) == plain_variants([r[:2] for r in data], every)


def test_variants_of_long_words(spark):
    rng = random.Random(8)
    data = []
    for n in (62, 63, 64, 65, 66, 400):  # around the length from which rotations are hashed
        word = "".join(rng.choice("abc") for _ in range(n))
        for k in (0, n // 2, n - 1):
            data += [word, word[:k] + "z" + word[k:], word[:k] + "y" + word[k + 1:], word[:k] + word[k + 1:], "w" + word[k + 1:]] * rng.randint(3, 9)
    data = [(7 * i, t) for i, t in enumerate(data)]
    df = spark.createDataFrame(data, "doc_id long, text string")
    assert got(permuterm.variants(df)) == plain_variants(data)


def test_variants_of_a_very_long_word(spark):
    word = "".join(random.Random(1).choice("abc") for _ in range(50_000))
    df = spark.createDataFrame([(1, word), (2, word), (3, word), (4, word + "z"), (5, word + "z"), (6, word + "z")], "doc_id long, text string")
    assert sorted((len(r.word), r.n, r.n_near) for r in permuterm.variants(df).collect()) == [(50_000, 3, 1), (50_001, 3, 1)]


def test_variants_of_nothing(spark):
    assert permuterm.variants(spark.createDataFrame([], SCHEMA)).collect() == []
    assert permuterm.variants(spark.createDataFrame([(1, "one two")], "doc_id long, text string")).collect() == []


# --- nearest neighbours ---


def plain_nearest(data, k, every):
    """Brute force over (id, vector) without repeats."""
    usable = {(i, tuple(v)) for i, v in data if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    out = {}
    for i, v in usable:
        if i % every == 0:
            found = sorted((float(np.sqrt(((np.array(v) - np.array(w)) ** 2).sum())), j) for j, w in usable if j != i and len(w) == len(v))
            out[i, v] = found[:k]
    return out


def vectors(rng, n, dim, spread):
    scale = np.arange(1, dim + 1) ** -spread
    centres = rng.standard_normal((8, dim)) * scale * 2
    return (centres[rng.integers(0, 8, n)] + rng.standard_normal((n, dim)) * scale).astype(np.float32).astype(float)


VECTORS = "vec_id long, embedding array<double>, label int, rank string, score string, shard string, ids string, v string"


def frame(spark, data):
    return spark.createDataFrame([(i, v, 0, *["clash"] * 5) for i, v in data], VECTORS).repartition(3)


@pytest.mark.parametrize("shard_values,query_block", [(1 << 19, 2048), (700, 2)])
def test_probing_everything_is_exact(spark, shard_values, query_block):
    rng = np.random.default_rng(3)
    x = vectors(rng, 300, 12, 0.5).tolist()
    data = list(enumerate(x)) + [(1000 + i, x[5]) for i in range(60)] + [(i, x[i]) for i in range(0, 30, 10)] + [
        (400, None), (401, []), (402, [0.0] * 12), (403, [1.0, None] + [0.0] * 10), (404, [float("nan")] * 12), (410, [float("inf")] * 12),
        (None, x[0]), (10, x[99]), (500, [1.0, 2.0]), (501, [1.0, 2.5]), (510, [3.0]), (520, x[7]), (530, [1e200] * 12), (531, [-1e200] * 12)]
    want = plain_nearest(data, 10, 10)
    df = frame(spark, data)
    found = cross_polytope.nearest(df, query_every=10, recall=1.0, sample=10_000, shard_values=shard_values, query_block=query_block).collect()
    assert sorted((r.query_id, r["rank"], r.score, r.vec_id) for r in found) == sorted(
        (i, n, s, j) for (i, _), answer in want.items() for n, (s, j) in enumerate(answer, 1))


@pytest.mark.parametrize("dim,spread,n", [(64, 0.0, 3000), (64, 1.0, 3000), (200, 0.5, 1500)])
def test_recall(spark, dim, spread, n):
    data = list(enumerate(vectors(np.random.default_rng(dim), n, dim, spread).tolist()))
    x = np.array([v for _, v in data])
    hits = total = 0
    by = {}
    for r in cross_polytope.nearest(frame(spark, data), query_every=10, sample=64).collect():
        by.setdefault(r.query_id, set()).add(r.vec_id)
    for i in range(0, n, 10):
        s = ((x - x[i]) ** 2).sum(1)
        want = set(np.argsort(s, kind="stable")[:11].tolist()) - {i}
        hits, total = hits + len(by[i] & want), total + 10
    assert hits / total >= 0.95


def test_rotations_keep_lengths_and_probes_are_all_buckets_within_reach():
    rng = np.random.default_rng(0)
    index = cross_polytope.Polytopes.make(24, 40_000, 2, 32, 5)
    x = cross_polytope._unit(rng.standard_normal((20, 24)))
    assert index.axes == [32, 8]
    full = np.linalg.norm(cross_polytope.hadamard(np.pad(x, ((0, 0), (0, 8)))), axis=1)
    assert np.allclose(full, 1)
    costs = index.costs(x, 1)
    every = np.arange(index.buckets)
    for i in range(20):
        cost = index.cost_of(costs, np.full(index.buckets, i), every)
        assert cost[index.bucket(x, 1)[i]] == 0
        reach = float(np.median(cost))
        assert cross_polytope.probes(costs, i, reach).tolist() == np.flatnonzero(cost <= reach).tolist()


def test_neighbours_of_nothing(spark):
    assert cross_polytope.nearest(frame(spark, [])).collect() == []
    assert cross_polytope.nearest(frame(spark, [(0, [1.0, 2.0])])).collect() == []


def test_new_queries_run(spark):
    for name, columns in {"op11_token_alignment": ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"],
                          "op13_cross_polytope": ["query_id", "rank", "vec_id", "score"]}.items():
        out = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert out.columns == columns and out.count() > 0
