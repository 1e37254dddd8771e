"""Near-duplicate groups against all pairs."""

import random
import re

import pytest
from helpers import WORD, corpus, documents, sentence

import corpus_pipeline
from adlens.llm import neardup
from adlens.llm.components import components


def near_corpus(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(500)]
    rows = corpus(seed)
    for _ in range(12):
        base = sentence(rng, rng.randint(40, 200), vocabulary).split()
        for _ in range(rng.randint(1, 8)):
            w = list(base)
            for _ in range(rng.randint(0, max(1, len(w) // 25))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            rows.append((1000 + len(rows), " ".join(w), None, None))
    rng.shuffle(rows)
    return rows


def brute(rows, num):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = []
    for _, t, *_ in rows:
        w = WORD.findall((t or "").translate(lower))
        sets.append(frozenset(tuple(w[k:k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= num * (len(sets[i]) + len(sets[j]) - common) or rows[i][0] == rows[j][0]:
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(least.get(root(i), r[0]), r[0])
    return sorted((r[0], len(sets[i]), least[root(i)], r[0] == least[root(i)]) for i, r in enumerate(rows))


@pytest.mark.parametrize("num", [85, 80])
def test_groups(spark, num):
    rows = near_corpus()
    rows.append(rows[7])
    got = neardup.near_duplicates(documents(spark, rows, extra=True), num, 100).select(
        "doc_id", "n_shingles", "component_id", "kept").collect()
    want = brute(rows, num)
    assert sorted(map(tuple, got)) == want
    assert any(not k for *_, k in want)


def test_links_inside_a_large_family(spark):
    """Members of a template at 0.80 of each other, and a few pairs at 0.86."""
    rng = random.Random(5)
    template, ids = [f"t{i}" for i in range(100)], rng.sample(range(100_000), 3040)
    tail = lambda i, n: [f"u{i}_{k}" for k in range(n)]
    rows = [(ids[i], " ".join([*template, *tail(i, 12)]), None, None) for i in range(3000)]
    rows += [(ids[3000 + i], " ".join([*template, *tail(i, 4), *tail(3000 + i, 8)]), None, None) for i in range(40)]
    got = neardup.near_duplicates(documents(spark, rows), 85, 100).collect()
    want = {i: i for i in ids} | {ids[k]: min(ids[i], ids[3000 + i]) for i in range(40) for k in (i, 3000 + i)}
    assert {r["doc_id"]: r["component_id"] for r in got} == want and len(got) == len(rows)


def test_null_ids_and_empty_table(spark):
    rows = [(None, "a b c d e f", None, None), (4, "A b c d e f", None, None), (5, None, None, None), (None, "", None, None)]
    got = neardup.near_duplicates(documents(spark, rows)).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"]) for r in got} == {(None, 4, False), (4, 4, True), (5, 5, True), (None, None, True)}
    assert neardup.near_duplicates(documents(spark, [])).count() == 0


@pytest.mark.parametrize("repeat", [False, True])
def test_pipeline_rows_without_an_id(spark, repeat):
    rows = [(None, "first clean text without an id", None, None), (None, "second quite other clean text here", None, None),
            (None, "a b c d e f", None, None), (None, "A b c d  e f", None, None), (4, "a b c d e f", None, None),
            (5, "some more words of a named text", None, None), (None, None, None, None)]
    docs = documents(spark, rows + rows[5:6] * repeat, extra=True)
    got = corpus_pipeline.near_duplicates(spark, docs, None)
    assert got.columns == docs.columns
    want = [rows[k][:2] for k in (0, 1, 4, 5, 6)]
    assert sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str) == sorted(want, key=str)


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1100)]
    edges += [(5000, 5000 + i) for i in range(1, 200)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(root(a), root(b))] = min(root(a), root(b))
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {x: root(x) for e in edges if e[0] != e[1] for x in e}
    assert got == want


def test_few_edges_are_not_shuffled_to_their_least(spark, monkeypatch):
    """A step over few edges shuffles once for the least and once for the distinct edges."""
    from adlens.llm import components as C
    plans, pin = [], C.pin
    monkeypatch.setattr(C, "pin", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or pin(df))
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame([(4, 3), (3, 2), (2, 1), (9, 8)], "a bigint, b bigint")).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8}
    assert len(plans) >= 5 and all("SortMergeJoin" not in p for p in plans[1:])
    assert all(p.count("Exchange hashpartitioning(u") <= 3 for p in plans[1:])
    monkeypatch.setattr(C, "BROADCAST_EDGES", 0)        # the way of many edges gives the same
    assert got == {r["node"]: r["component"] for r in components(spark.createDataFrame([(4, 3), (3, 2), (2, 1), (9, 8)], "a bigint, b bigint")).collect()}
