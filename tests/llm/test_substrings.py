"""Both substring operators against brute force."""

import hashlib
import random

import numpy as np
import pytest
from helpers import WORD, corpus, documents

from adlens.llm import debruijn, repeats, suffix_dedup

ROWS = corpus(3)
# repeated rows of one doc_id, and null ids
ODD = [*ROWS, ROWS[10], (None, ROWS[12][1], None, None), (None, "q" * 80, None, None), (None, "q" * 80, None, None)]


def by_bytes(rows):
    data = [(i, (t or "").encode()) for i, t, *_ in rows]
    key = lambda i: float("inf") if i is None else i
    first = {}
    for i, t in data:
        for p in range(len(t) - 49):
            first[t[p:p + 50]] = min(first.get(t[p:p + 50], float("inf")), key(i))
    out = []
    for i, t in data:
        gone = [False] * len(t)
        for p in range(len(t) - 49):
            if first[t[p:p + 50]] < key(i):
                gone[p:p + 50] = [True] * 50
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(bytes(b for b, g in zip(t, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def by_words(rows):
    data = [(i, WORD.findall(t or "")) for i, t, *_ in rows]
    seen = {}
    for _, w in data:
        for p in range(len(w) - 34):
            seen[tuple(w[p:p + 35])] = seen.get(tuple(w[p:p + 35]), 0) + 1
    out = []
    for i, w in data:
        gone = [False] * len(w)
        for p in range(len(w) - 34):
            if seen[tuple(w[p:p + 35])] > 1:
                gone[p:p + 35] = [True] * 35
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out.append((i, len(w), sum(gone), spans, hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("rows", [ROWS, ODD, ROWS[:1], []], ids=["corpus", "odd", "one", "empty"])
def test_suffix_dedup(spark, rows):
    got = suffix_dedup.remove_repeats(documents(spark, rows, extra=True)).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == by_bytes(rows)


@pytest.mark.parametrize("rows", [ROWS, ODD, []], ids=["corpus", "odd", "empty"])
def test_debruijn(spark, rows):
    got = debruijn.remove_repeats(documents(spark, rows, extra=True)).select(
        "doc_id", "n_words", "n_removed", "n_spans", "kept_sha256").collect()
    assert sorted(map(tuple, got), key=str) == by_words(rows)


def test_many_small_batches_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(repeats.write_batches, "__defaults__", (2000,))
    got = suffix_dedup.remove_repeats(documents(spark, ODD)).collect()
    assert sorted(map(tuple, got), key=str) == by_bytes(ODD)
    got = debruijn.remove_repeats(documents(spark, ODD)).drop("n_paths").collect()
    assert sorted(map(tuple, got), key=str) == by_words(ODD)


def test_suffix_order_sorts_like_bytes():
    rng = random.Random(5)
    text = np.frombuffer("".join(rng.choice("ab") for _ in range(900)).encode(), np.uint8)
    starts = np.array(rng.sample(range(800), 500))
    group = np.array([rng.randrange(3) for _ in starts])
    order = suffix_dedup.SuffixOrder(text, 50)
    got = order.sort(starts, group)
    raw = text.tobytes()
    keys = [(group[i], raw[starts[i]:starts[i] + 50]) for i in got]
    assert keys == sorted((g, raw[s:s + 50]) for g, s in zip(group, starts)) and sorted(got) == list(range(500))


def test_suffix_order_merges_equal_suffixes_once(monkeypatch):
    rng = random.Random(6)
    passages = ["same head " + "".join(rng.choice("abc") for _ in range(70)) for _ in range(6)]
    raw = "".join(passages * 100).encode()
    starts = np.arange(600) * 80
    group = np.repeat([1, 4], 300)
    compared, less = [], suffix_dedup.SuffixOrder.less
    monkeypatch.setattr(suffix_dedup.SuffixOrder, "less", lambda self, x, y, e: compared.append(len(x)) or less(self, x, y, e))
    order = suffix_dedup.SuffixOrder(np.frombuffer(raw, np.uint8), 50)
    got = order.sort(starts, group)
    assert [(group[i], raw[starts[i]:starts[i] + 50]) for i in got] == sorted((g, raw[s:s + 50]) for g, s in zip(group, starts))
    assert sorted(got) == list(range(600)) and 0 < sum(compared) < 200
    assert order.equal_neighbours(starts, got, group).sum() == 600 - 12


def test_runs_do_not_depend_on_the_step(monkeypatch):
    texts = [(t or "").encode() for _, t, *_ in ROWS]
    off, data = np.cumsum([0, *map(len, texts)]), np.frombuffer(b"".join(texts), np.uint8)
    whole = suffix_dedup.find_runs(off, data)
    monkeypatch.setattr(suffix_dedup, "RUN_STEP", 500)
    assert len(whole[0]) and all(np.array_equal(a, b) for a, b in zip(whole, suffix_dedup.find_runs(off, data)))


def test_extension_is_the_common_prefix():
    text = np.frombuffer(b"abcabcabdabcabcabx" + b"y" * 60, np.uint8)
    order = suffix_dedup.SuffixOrder(text, 20)
    assert order.extension(np.array([0, 0, 5]), np.array([3, 9, 5])).tolist() == [5, 8, 20]


def test_paths_hold_the_repeated_windows(spark):
    rng = random.Random(2)
    words = [f"w{rng.randrange(10 ** 6)}" for _ in range(1200)]
    rows = [(1, " ".join(words), None, None), (2, "x " + " ".join(words), None, None), (3, " ".join(words[100:900]), None, None)]
    text = debruijn.RepeatedText(documents(spark, rows))
    segments, paths = debruijn.compact(text.segments())
    found = paths.collect()
    text.batched.drop()
    assert all(r["verified"] for r in found if r["n_occurrences"] > 1)
    longest = max(found, key=lambda r: r["n_words"])
    assert longest["n_segments"] > 1 and longest["source"]["doc_id"] == 1


def test_only_the_results_stay(spark):
    import os

    from adlens.llm import neardup
    from adlens.session import ensure_checkpoint_dir
    shared = ensure_checkpoint_dir(spark).removeprefix("file:")
    for operator in (suffix_dedup.remove_repeats, debruijn.remove_repeats, neardup.near_duplicates):
        before = set(os.listdir(shared))
        out = operator(documents(spark, ROWS[:20]))
        assert len(set(os.listdir(shared)) - before) == 1 and out.count() == 20
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("batches_")]
