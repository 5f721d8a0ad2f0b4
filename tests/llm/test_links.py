"""The two joins against all pairs, and components of awkward graphs."""

import random

import numpy as np
import pytest
from fixtures import SCHEMA, components, documents, prose, rows

from strata.llm import blocks, chosen_path, pq_dedup
from strata.llm.components import components as spark_components


def shingles(text):
    import re
    ws = re.findall(r"[a-z0-9\x80-\U0010ffff]+", (text or "").lower())
    return tuple(ws), frozenset(tuple(ws[i:i + 5]) for i in range(len(ws) - 4)) or (frozenset([tuple(ws)]) if ws else frozenset())


def plain_join(data):
    ids = [(d, *shingles(t)) for d, t in data]
    usable = [k for k, (d, ws, _) in enumerate(ids) if d is not None and ws]
    links = [(a, b) for a in usable for b in usable if a != b
             and len(ids[a][2] & ids[b][2]) >= 0.8 * len(ids[a][2] | ids[b][2])]
    degree = dict.fromkeys(range(len(ids)), 0)
    for a, _ in links:
        degree[a] += 1
    up = components({ids[k][0] for k in usable}, [(ids[a][0], ids[b][0]) for a, b in links])
    return sorted(((d, degree[k], up.get(d, d)) for k, (d, _, _) in enumerate(ids)), key=str)


def result(df):
    return sorted(((r.doc_id, r.n_links, r.component_id) for r in df.collect()), key=str)


def test_ngram_join_of_awkward_rows(spark):
    out = chosen_path.join(documents(spark))
    assert all(r.kept == (r.doc_id == r.component_id) for r in out.collect())
    assert result(out) == plain_join([r[:2] for r in rows()])
    assert chosen_path.join(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("small,block", [(128, 256), (4, 8)])  # small limits split every bucket and every group
def test_ngram_join_of_near_copies(spark, small, block):
    rng = random.Random(9)
    data = []
    for family in range(12):
        base = prose(rng, rng.choice([8, 60, 150])).split()
        for _ in range(rng.choice([1, 2, 9, 25])):
            ws = list(base)
            for _ in range(rng.randint(0, 4)):
                ws[rng.randrange(len(ws))] = rng.choice(["new", "Word,", base[0].upper()])
            data.append((len(data) * 3, " ".join(ws)))
    df = spark.createDataFrame(data, "doc_id long, text string").repartition(4)
    assert result(chosen_path.join(df, small=small, block=block, recall=0.9999999)) == plain_join(data)


def test_ngram_join_of_two_texts_under_one_id(spark):
    rng = random.Random(3)
    a, b = prose(rng, 80), prose(rng, 80)
    data = [(7, a), (7, b), (7, b), (9, a + " more"), (11, b + " tail"), (3, b + " end"), (12, prose(rng, 20))]
    out = chosen_path.join(spark.createDataFrame(data, "doc_id long, text string").repartition(3))
    assert result(out) == [(11, 3, 3), (12, 0, 12), (3, 3, 3), (7, 1, 7), (7, 3, 3), (7, 3, 3), (9, 1, 7)]


def test_pipeline_keeps_one_row_of_a_repeated_document(spark):
    import corpus_pipeline

    rng = random.Random(8)
    a, b, c = prose(rng, 80), prose(rng, 80), prose(rng, 60)
    data = [(5, a, "x"), (5, a, "w"), (5, a.upper(), "v"), (8, a + " more", "x"), (6, b, "x"), (6, c, "x"), (6, c, "x"), (None, a, "x"), (None, a, "x")]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string").repartition(3)
    kept = [tuple(r) for r in corpus_pipeline.ngram_join(spark, docs, "").collect()]
    assert sorted(kept, key=str) == sorted([(5, a.upper(), "v"), (6, b, "x"), (6, c, "x"), (None, a, "x"), (None, a, "x")], key=str)


def test_runs_reach_the_recall():
    n = chosen_path.runs_for(0.9995, 0.8, 3)
    assert 1 - (1 - 0.8**3) ** n >= 0.9995 > 1 - (1 - 0.8**3) ** (n - 1)


def plain_vectors(data, threshold=0.9):
    ok = [k for k, (i, v) in enumerate(data) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    unit = {k: np.array(data[k][1], float) / np.linalg.norm(np.array(data[k][1], float)) for k in ok}
    links = [(a, b) for a in ok for b in ok if a != b and len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold]
    degree = dict.fromkeys(range(len(data)), 0)
    for a, _ in links:
        degree[a] += 1
    up = components({data[k][0] for k in ok}, [(data[a][0], data[b][0]) for a, b in links])
    return sorted(((i, degree[k], up.get(i, i)) for k, (i, v) in enumerate(data)), key=str)


@pytest.mark.parametrize("block,lists", [(1024, 1024), (8, 5)])
def test_embedding_links(spark, block, lists):
    rng = np.random.default_rng(4)
    centers = rng.normal(size=(30, 16))
    vectors = [c + rng.normal(size=16) * rng.choice([0, 0.05, 0.25, 0.4]) for c in centers for _ in range(10)]
    data = [(k * 2 + 1, v.astype(np.float32).tolist()) for k, v in enumerate(vectors)]
    data += [(1000, None), (1001, []), (1002, [0.0] * 16), (1003, [float("nan")] * 16), (1004, [None] + [1.0] * 15),
             (1005, data[0][1]), (1006, data[0][1]), (None, data[0][1]), (1007, [1.0, 2.0]), (1008, [2.0, 4.0]), (1009, [float("inf")] + [1.0] * 15),
             (1010, [1e30] * 16), (1011, [2e30] * 16)]
    df = spark.createDataFrame([(*r, "clash") for r in data], "vec_id long, embedding array<float>, id string").repartition(3)
    out = pq_dedup.dedup(df, block=block, most_lists=lists)
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in out.collect()), key=str) == plain_vectors(data)
    assert all(r.kept == (r.vec_id == r.component_id) for r in out.collect())


@pytest.mark.parametrize("dim,power,shard", [(64, 1.0, 65_536), (64, 1.5, 100), (768, 1.0, 300)])
def test_embedding_links_of_concentrated_vectors(spark, dim, power, shard):
    rng = np.random.default_rng(6)
    scale = np.arange(1, dim + 1) ** -power
    vectors = rng.normal(size=(1500, dim)) * scale
    vectors = np.concatenate([vectors, vectors[:500] + 0.3 * rng.normal(size=(500, dim)) * scale])
    data = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(vectors)]
    unit = np.array([v for _, v in data])
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    links = unit @ unit.T >= 0.9
    up = components(range(len(data)), [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(links, 1)))])
    out = pq_dedup.dedup(spark.createDataFrame(data, "vec_id long, embedding array<float>").repartition(3), shard=shard)
    found = {r.vec_id: (r.n_links, r.component_id) for r in out.collect()}
    assert found == {k: (int(n) - 1, up[k]) for k, n in enumerate(links.sum(1))}


def test_no_vectors(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pq_dedup.dedup(empty).collect() == []
    only_null = spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")
    assert pq_dedup.dedup(only_null).collect() == [(1, 0, 1, True)]


def test_components(spark):
    rng = random.Random(1)
    links = [(k, k + 1) for k in range(0, 400)] + [(500, 600 + k) for k in range(300)]
    links += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(250)]
    links = [(a, b) for a, b in links if a != b]
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long").repartition(7)
    nodes = {x for e in links for x in e}
    assert {r.node: r.component for r in spark_components(df).collect()} == components(nodes, links)
    assert spark_components(df.limit(0)).collect() == []


def test_sets_bring_their_buckets_along(spark, monkeypatch):
    """Sets are shuffled by bucket only, and not by id to meet their buckets first."""
    plans, compare = [], blocks.compare

    def seen(rows, *how):
        plans.append(rows._jdf.queryExecution().sparkPlan().toString())
        return compare(rows, *how)

    monkeypatch.setattr(blocks, "compare", seen)
    assert chosen_path.join(documents(spark)).count() == documents(spark).count()
    assert plans and not [p for p in plans if "Join" in p]
