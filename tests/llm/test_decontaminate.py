"""Recall of edited benchmark items, without Spark."""

import random

import pyarrow as pa
import pytest

from adlens.llm.decontaminate import Benchmark


def make(rng, n):
    return [f"v{rng.randrange(5000)}" for _ in range(n)]


def build(items):
    return Benchmark(pa.array(range(len(items))).to_numpy(), pa.array([" ".join(x) for x in items]))


def edited(rng, item):
    word = [[w] for w in item]
    for place in rng.sample(range(len(item)), len(item) // 5):
        new = f"x{rng.randrange(10**6)}"
        word[place] = ([new], [], [*word[place], new])[rng.randrange(3)]
    return [w for x in word for w in x]


@pytest.mark.parametrize("size", [5, 8, 10, 15, 16, 17, 24, 31])
def test_short_items_beside_long_ones(size):
    rng = random.Random(size)
    items = [make(rng, size) for _ in range(20)] + [make(rng, rng.randint(30, 59)) for _ in range(180)]
    found = build(items).search(pa.array([" ".join(make(rng, 40) + edited(rng, items[k % 20]) + make(rng, 40)) for k in range(400)]))
    assert sum(k % 20 in x for k, x in enumerate(found)) >= 388


def test_a_target_out_of_reach_is_an_error(monkeypatch):
    monkeypatch.setattr("adlens.llm.decontaminate.MAX_REPEATS", 1)
    with pytest.raises(ValueError, match="16 words"):
        build([make(random.Random(1), 16)])


def test_copies_that_end_the_document():
    rng = random.Random(3)
    items = [make(rng, n) for n in (5, 6, 8, 16, 17, 30) for _ in range(40)]
    index = build(items)
    for before in (0, 30):
        cut = index.search(pa.array([" ".join(make(rng, before) + x[:-(len(x) // 5)]) for x in items]))
        assert sum(k in x for k, x in enumerate(cut)) >= 0.98 * len(items)
        other = index.search(pa.array([" ".join(make(rng, before) + edited(rng, x)) for x in items]))
        assert sum(k in x for k, x in enumerate(other)) >= 0.97 * len(items)
    # one word dropped, the copy alone
    eight = range(80, 120)
    dropped = [(k, d) for k in eight for d in range(8)]
    found = index.search(pa.array([" ".join(items[k][:d] + items[k][d + 1:]) for k, d in dropped]))
    assert all(k in x for (k, _), x in zip(dropped, found))
    assert index.search(pa.array(["", None, "v1"])) == [[], [], []]
