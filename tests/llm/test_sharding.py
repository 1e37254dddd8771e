"""Sharding against a plain version of the interleaving."""

import collections
import hashlib
import random

import pytest
from helpers import corpus, documents

from adlens.llm import sharding


def word(text):
    return (int(hashlib.md5(text.encode()).hexdigest()[:8], 16) + 0.5) / 2 ** 32


def plain(rows, shards, seed=0):
    """(doc_id, text, source) by (shard, slot), row by row."""
    key = lambda r: hashlib.md5(f"{seed}:{'' if r[0] is None else r[0]}:{r[1] or ''}".encode()).hexdigest()
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r[3]].append(r)
    order = []
    for source, own in by_source.items():
        draw = word(f"{seed}:" + ("n" if source is None else "s" + source))
        for rank, r in enumerate(sorted(own, key=key)):
            order.append(((rank + draw) / len(own), source is not None, source or "", key(r), r))
    order.sort(key=lambda x: x[:4])
    n = len(order)
    out, count = [], collections.Counter()
    for place, (*_, r) in enumerate(order):
        shard = place * shards // n
        out.append((r[0], r[1], r[3], shard, count[shard]))
        count[shard] += 1
    return out


def got(spark, rows, shards, seed=0, extra=False):
    placed = sharding.interleave(documents(spark, rows, extra), shards, seed)
    return [tuple(r) for r in placed.select("row.doc_id", "row.text", "source", "shard", "slot").collect()]


@pytest.mark.parametrize("shards,seed", [(8, 0), (3, 7), (1, 0), (500, 1)])
def test_equals_the_plain_version(spark, shards, seed):
    rows = corpus(4)
    assert collections.Counter(got(spark, rows, shards, seed)) == collections.Counter(plain(rows, shards, seed))


def test_every_shard_has_the_mixture(spark):
    rng = random.Random(2)
    rows = [(i, f"text {i}", None, rng.choice(["big"] * 12 + ["mid"] * 3 + [None] + [f"rare{i % 40}"])) for i in range(4000)]
    placed = sharding.interleave(documents(spark, rows), 8)
    cells = {(r["shard"], r["source"]): r["n"] for r in sharding.mixture(placed).collect()}
    per_shard = collections.Counter(r["shard"] for r in placed.select("shard").collect())
    assert sorted(per_shard) == list(range(8)) and max(per_shard.values()) - min(per_shard.values()) <= 1
    sizes = collections.Counter(r[3] for r in rows)
    for shard in range(8):
        for source, n in sizes.items():
            # one row for rounding, and as much again for what the other sources' rounding moves the cuts
            assert abs(cells.get((shard, source), 0) - n / 8) <= 2 + n / len(rows) * len(sizes) ** 0.5 * 2, (shard, source)


def test_odd_tables(spark):
    rows = [(None, None, None, None), (None, None, None, None), (None, "", None, "a"), (1, "x", None, "a"), (1, "x", None, "a"),
            (1, "y", None, None), (2, "z" * 200_000, None, "")]
    want = collections.Counter(plain(rows, 4))
    assert collections.Counter(got(spark, rows, 4)) == want == collections.Counter(got(spark, rows, 4, extra=True))
    # ids that repeat keep each their place
    same = [(7, "same", None, "s")] * 50
    assert sorted(r[3:] for r in got(spark, same, 8)) == sorted(r[3:] for r in plain(same, 8))
    assert got(spark, [], 8) == []
    with pytest.raises(ValueError):
        sharding.interleave(documents(spark, rows), 0)


def test_written_shards(spark, tmp_dir):
    rows = corpus(5)
    docs = documents(spark, rows, extra=True)
    sharding.write_shards(docs.withColumn("shard", docs["doc_id"]), f"{tmp_dir}/out", 8)
    back = spark.read.parquet(f"{tmp_dir}/out")
    assert set(back.columns) == {*docs.columns, "shard", "slot"}
    assert collections.Counter(tuple(r) for r in back.select("doc_id", "text", "source", "shard", "slot").collect()) == collections.Counter(plain(rows, 8))
    assert spark.read.parquet(f"{tmp_dir}/out/shard=3").columns[0] == "slot"
