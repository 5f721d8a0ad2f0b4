"""Mixing, fingerprints, the two classifiers, the queries and the pipeline."""

import hashlib
import itertools
import zlib

import numpy as np
import pytest
from compare import compare, connect
from fixtures import SCHEMA, documents, rows, words
from pyspark.sql import functions as F

import __spark_entry__ as contract
import corpus_pipeline
from strata.llm import mixing, quality_fm, queries, scaled_sketch, toxicity_wfst
from strata.llm.common import load, stored


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_query(spark, sf_dir, name):
    df = contract.queries()[name](spark, sf_dir)
    if name not in contract.oracle_sql():
        assert df.count() > 0
        return
    same, message, _ = compare(df, connect(sf_dir), contract.oracle_sql()[name])
    assert same, message


def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    target, left, open_ = {}, float(sum(sizes.values())), set(names)
    while open_:
        share = {s: left * weight[s] / sum(weight[t] for t in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 3 * sizes[s]}
        if not full:
            target |= share
            break
        for s in full:
            target[s] = 3.0 * sizes[s]
            left -= target[s]
        open_ -= full
    return target


def test_mixing(spark):
    data = rows()
    out = mixing.mix(documents(spark), ["doc_id", "source", "size"]).select("row.doc_id", "row.source", "size", "source_size", "target", "taken").collect()
    assert len(out) == len(data)
    sizes = {}
    for r in data:
        sizes[r[3]] = sizes.get(r[3], 0) + len(words(r[1]))
    target = plain_targets(sizes)
    taken = {}
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(target[r.source]) and 0 <= r.taken <= 3 * r.size
        taken[r.source] = taken.get(r.source, 0) + r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    again = mixing.mix(documents(spark).repartition(5), ["doc_id", "source", "size"]).select("row.doc_id", "row.source", "size", "source_size", "target", "taken")
    assert sorted(map(str, again.collect())) == sorted(map(str, out))
    assert mixing.mix(spark.createDataFrame([], SCHEMA), ["doc_id"]).collect() == []


def test_mixed_documents(spark):
    mixed = stored(mixing.mix(documents(spark), ["doc_id", "text", "n_chars", "row"]), "mixed")
    want = {}
    for r in mixed.collect():
        want[r.row.doc_id] = want.get(r.row.doc_id, 0) + r.taken
    have = {}
    for r in mixing.realise(mixed).collect():
        have[r.doc_id] = have.get(r.doc_id, 0) + len(words(r.text))
        assert r.n_chars == len(r.text)
    assert have == {d: n for d, n in want.items() if n}


def jaccard(a, b):
    a, b = ({tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4))} for ws in (words(a), words(b)))
    return len(a & b) / len(a | b)


def test_fingerprints(spark):
    data = rows()
    out = scaled_sketch.fingerprints(documents(spark)).collect()
    order = sorted(((r[0], r[1] or "") for r in data), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
    want = []
    for k, (d, t) in enumerate(order):
        cut = len(t) // 4
        edited = t[:len(t) - cut] + order[(k + 1) % len(order)][1][:cut]
        want.append((d, len(t), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in out), key=str) == sorted(want, key=str)
    text = {h: t for (_, _, h), (_, t) in zip(want, order)}
    by_text = {}
    for r in out:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        if len(words(text[r.edited_sha256])) >= 80 and r.n_chars < 4 * 60:
            continue
        by_text.setdefault(text[r.edited_sha256], set()).add(r.fingerprint)
    assert all(len(f) == 1 for f in by_text.values())
    texts = {h: t for (_, _, h), (_, t) in zip(want, order)}
    nexts = {h: order[(k + 1) % len(order)][1] for k, (_, _, h) in enumerate(want)}
    for r in out:
        own, after = texts[r.edited_sha256], nexts[r.edited_sha256]
        cut = len(own) // 4
        if len(words(own)) >= 190 and len(set(words(own))) > 50:
            assert abs(r.near_edited - jaccard(own, own[:len(own) - cut] + after[:cut])) < 0.15
            assert abs(r.near_next - jaccard(own, after)) < 0.15
    assert scaled_sketch.fingerprints(spark.createDataFrame([], SCHEMA)).collect() == []
    one = spark.createDataFrame([(1, "a b c d e f g h")], "doc_id long, text string")
    assert scaled_sketch.fingerprints(one).collect()[0].near_next == 1.0
    # short texts: whatever they retain, equal fingerprints are alike
    short = spark.createDataFrame([(k, f"{k} b c d e {k}") for k in range(40)], "doc_id long, text string")
    found = {r.doc_id: r for r in scaled_sketch.fingerprints(short).collect()}
    assert "" in {r.fingerprint for r in found.values()}
    for k, r in found.items():
        assert r.near_edited == 1.0 or r.fingerprint != r.edited_fingerprint
        assert r.near_next == 1.0 or r.fingerprint != found[(k + 1) % 40].fingerprint


def test_sketches_estimate_containment(spark):
    whole = " ".join(f"w{k}" for k in range(20_000))
    part = " ".join(f"w{k}" for k in range(5_000))
    df = spark.createDataFrame([(whole, part)], "a string, b string")
    s = df.select(scaled_sketch.sketch(F.col("a")).alias("a"), scaled_sketch.sketch(F.col("b")).alias("b"))
    r = s.select(scaled_sketch.containment(F.col("b"), F.col("a")).alias("up"), scaled_sketch.containment(F.col("a"), F.col("b")).alias("down"),
                 F.size(scaled_sketch.merge(F.col("a"), F.col("b"))).alias("both"), F.size("a").alias("a")).first()
    assert r.up == 1.0 and abs(r.down - 0.25) < 0.03 and r.both == r.a and abs(r.a / 20_000 - scaled_sketch.FRACTION) < 0.02


def test_native_operators_run_no_python(spark, capsys):
    mixing.mix(documents(spark), ["doc_id"]).explain()
    scaled_sketch.fingerprints(documents(spark)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan


def test_machine_equals_all_pairs():
    rng = np.random.default_rng(1)
    m = quality_fm.Machine(0.3, rng.normal(size=quality_fm.WIDTH).astype(np.float32), rng.normal(size=(quality_fm.WIDTH, 4)).astype(np.float32))
    ids, x = np.array([3, 9, 77, 4000]), np.array([0.5, 1.0, 0.25, 2.0], np.float32)
    want = 0.3 + (m.linear[ids] * x).sum() + sum(m.factors[ids[i]] @ m.factors[ids[j]] * x[i] * x[j] for i in range(4) for j in range(i))
    assert m.raw(ids, x, np.array([0, 4]))[0] == pytest.approx(want, rel=1e-5)


def test_repeated_words_are_one_feature():
    texts = ["a b a c a", None, "one two", "", "x " * 500 + "y"]
    ids, x, at = quality_fm.features(texts)
    dense = len(quality_fm.SHARES) + len(quality_fm.SIZES)
    for text, s, e in zip(texts, at[:-1], at[1:], strict=True):
        ws = words(text)
        own, value = ids[s:e - dense], x[s:e - dense]
        assert len(own) == len(set(own.tolist())) == len(set(ws)) and (ids[e - dense:e] >= quality_fm.BUCKETS).all()
        assert sorted(value.tolist()) == pytest.approx(sorted(ws.count(w) / len(ws) for w in set(ws)))


@pytest.mark.parametrize("op,label,folds,held", [("op8_quality_fm", "quality", 4, 2), ("op9_toxicity_wfst", "toxic", 5, 0)])
def test_held_out_accuracy(spark, op, label, folds, held):
    sf = "/root/testdata/sf0.1"
    out = {r.doc_id: r for r in contract.queries()[op](spark, sf).collect()}
    truth = {r.doc_id: r[label] for r in load(spark, sf, "labels").collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % folds == held) for d, r in out.items())
    unseen = [(out[d].predicted, y) for d, y in truth.items() if out[d].held_out]
    assert sum(p == y for p, y in unseen) / len(unseen) > 0.98
    for y in (0, 1):
        assert sum(p == y for p, t in unseen if t == y) / max(1, sum(t == y for _, t in unseen)) > 0.85


@pytest.mark.parametrize("operator,label", [(quality_fm, "quality"), (toxicity_wfst, "toxic")])
def test_classifiers_on_awkward_rows(spark, operator, label):
    labels = spark.createDataFrame([(r[0], k % 2) for k, r in enumerate(rows())] + [(None, 1), (10**6, 1), (1, None)], f"doc_id long, {label} int")
    out = operator.classify(documents(spark), labels).collect()
    assert len(out) == len(rows()) and all(0 <= r.score <= 1 for r in out)
    nothing = labels.limit(0)
    assert len(operator.classify(documents(spark), nothing).collect()) == len(rows())
    assert operator.classify(spark.createDataFrame([], SCHEMA), labels).collect() == []


def test_held_out_labels_are_never_read(spark):
    flipped = [(r[0], 1 if zlib.crc32(str(r[0]).encode()) % 4 == 2 else k % 2) for k, r in enumerate(rows()) if r[0] is not None]
    plain = [(r[0], 0 if zlib.crc32(str(r[0]).encode()) % 4 == 2 else k % 2) for k, r in enumerate(rows()) if r[0] is not None]
    a, b = (sorted((str(r.doc_id), r.score) for r in quality_fm.classify(documents(spark), spark.createDataFrame(x, "doc_id long, quality int")).collect())
            for x in (flipped, plain))
    assert a == b


def test_grammar_reads_clauses():
    g = toxicity_wfst.Grammar(["idiot", "lowei"], toxicity_wfst.PRIOR)

    def found(text):
        return {p: int(n) for p, n in zip(toxicity_wfst.PATTERNS, g.patterns(text)) if n}

    assert found("An idiot. You see") == {"insult": 1}
    assert found("You IDIOTS, all") == {"directed_insult": 1}
    assert found("you are not an idiot") == {"negated_insult": 1}
    assert found("he said idiot once; idiot") == {"reported_insult": 1, "insult": 1}
    assert found("I will kill you") == {"directed_threat": 1} and found("to kill time") == {"threat": 1}
    assert found("du loweiß") == {"directed_insult": 1} and found("video nidiot") == {} and found(None) == {} and found("") == {}
    assert found("idiot " * 5000) == {"insult": 1} and found("idiot. " * 5000) == {"insult": 5000}
    assert found("not an idiot, you idiot idiot") == {"negated_insult": 1, "directed_insult": 1}
    a = g.score(np.array([g.patterns("you idiot"), g.patterns("not an idiot"), g.patterns("hello")]))
    assert a[0] > 0.5 > a[1] > a[2]


SPOKEN = {"I": "idiot", "T": "kill", "W": "lowei", "Y": "you", "N": "not", "R": "said", "O": "house"}


def plain_paths(symbols):
    """The clause's patterns word by word: negation reaches two words on, report to the end, a target the whole clause."""
    families, directed = {"I": "insult", "T": "threat", "W": "suspect"}, "Y" in symbols
    marks = {"I": ("negated_insult", "reported_insult"), "T": ("excused_threat",) * 2, "W": ("excused_suspect",) * 2}
    heights = {"negated": 0, "reported": 0, "excused": 0, "directed": 2}
    best = {}
    for k, s in enumerate(symbols):
        if s in families:
            name = families[s]
            if "N" in symbols[max(0, k - toxicity_wfst.SCOPE):k]:
                pattern = marks[s][0]
            elif "R" in symbols[:k]:
                pattern = marks[s][1]
            else:
                pattern = f"directed_{name}" if directed and s != "W" else name
            best.setdefault(name, set()).add(pattern)
    return {max(sorted(found), key=lambda p: (heights.get(p.split("_")[0], 1), p)): 1 for found in best.values()}


def test_composed_machine_matches_every_path():
    g = toxicity_wfst.Grammar(["idiot"], toxicity_wfst.PRIOR, ["lowei"])
    for n in range(1, 6):
        for symbols in itertools.product(SPOKEN, repeat=n):
            assert dict(g.clause(" ".join(SPOKEN[s] for s in symbols))) == plain_paths(symbols), symbols


@pytest.mark.parametrize("part,text,toxic", [
    ("_target", "i will kill you", True),
    ("_negation", "you are not an idiot", False), ("_reported", "you said idiot", False),
])
def test_each_transducer_decides(monkeypatch, part, text, toxic):
    def predicted():
        g = toxicity_wfst.Grammar(["idiot"], toxicity_wfst.PRIOR)
        return bool(g.score(g.patterns(text)[None])[0] >= 0.5)

    assert predicted() is toxic
    monkeypatch.setattr(toxicity_wfst, part, lambda state, symbol: (0, symbol))
    monkeypatch.setattr(toxicity_wfst, "ARCS", toxicity_wfst._compose())
    assert predicted() is not toxic


def test_fitted_weights_keep_the_order_of_clauses(spark):
    sf = "/root/testdata/sf0.1"
    g = toxicity_wfst.train(load(spark, sf, "documents"), load(spark, sf, "labels"))

    def score(text):
        return g.score(g.patterns(text)[None])[0]

    assert score("you idiot") >= score("idiot") >= score("not an idiot") >= score("hello")
    assert score("he said idiot") <= score("idiot")
    assert score("I will kill you") >= score("to kill time") >= score("never kill time") >= score("hello")


def test_learned_prefixes_need_evidence():
    prefixes = [("idio", 40, 0), ("idiot", 40, 0), ("rare", 2, 0), ("word", 60, 300), ("lowe", 20, 1), ("lowei", 20, 0), ("achlich", 50, 60)]
    assert toxicity_wfst.learn(prefixes, 100, 900) == (["idio", "lowei"], ["achlich", "lowe"])
    assert toxicity_wfst.learn([], 0, 0) == ([], [])


def test_pipeline(spark, sf_dir):
    docs = load(spark, sf_dir, "documents")
    columns, before = docs.columns, None
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, sf_dir), name)
        if name != "packing":
            assert out.columns == columns and out.dtypes == docs.dtypes
        before, docs = docs, out
    assert {r.doc_id for r in docs.select("doc_id").collect()} == {r.doc_id for r in before.select("doc_id").collect()}
    assert contract.queries()["pipeline"](spark, sf_dir).count() == docs.count()


def test_stages_on_awkward_and_empty_tables(spark, sf_dir):
    for data in (rows(), []):
        docs = documents(spark, data)
        for name, stage in corpus_pipeline.STAGES:
            out = stored(stage(spark, docs, sf_dir), name)
            assert name == "packing" or out.columns == docs.columns
            if name != "quality":  # its verdict on random rows is not of interest here
                docs = out
