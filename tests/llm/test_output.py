"""Mixing, token shards, WARC archives and top-k search."""

import hashlib
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import WORD, corpus, documents
from hypothesis import given, settings
from hypothesis import strategies as st

from adlens.llm import mixing, tokens_out, topk, warc
from adlens.llm.queries import tokenizer_file
from adlens.session import scratch_path

TOKENIZER = tokens_out.load_tokenizer(tokenizer_file())


# --- mixing -------------------------------------------------------------

def target_of(sizes, weights=(5, 2, 1), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    out, left, open_ = {}, sum(sizes.values()), set(names)
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            return out | {s: level * weight[s] for s in open_}
        for s in full:
            out[s] = most * sizes[s]
            left -= out[s]
        open_ -= full


@pytest.mark.parametrize("seed", [1, 2])
def test_mix(spark, seed):
    rng = random.Random(seed)
    names = ["b", "a", "ä", None, "B", "zz", "tiny"]
    rows = [(i, None if i % 17 == 0 else "w " * rng.choice([0, 1, 5, 30, rng.randint(1, 400)]), None,
             rng.choices(names, [30, 10, 5, 5, 20, 10, 1])[0]) for i in range(500)]
    size = {i: len(WORD.findall(t or "")) for i, t, *_ in rows}
    of = {i: s for i, _, _, s in rows}
    per = {}
    for i, s in of.items():
        per[s] = per.get(s, 0) + size[i]
    want = target_of(per)
    docs = documents(spark, rows, extra=True)
    got = mixing.allocation(docs).collect()
    assert len(got) == len(rows)
    taken = {}
    for r in got:
        s = of[r["doc_id"]]
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == per[s]
        assert math.isclose(r["target"], want[s], rel_tol=1e-9)
        assert r["taken"] <= 3 * r["size"] and (r["size"] == 0 or r["taken"] % r["size"] == 0)
        taken[s] = taken.get(s, 0) + r["taken"]
    for s in per:
        assert abs(taken[s] - want[s]) <= max(3, 0.01 * want[s]), s
    assert sorted(map(tuple, mixing.allocation(docs).collect())) == sorted(map(tuple, got))
    copies = {r["doc_id"]: r["taken"] // max(r["size"], 1) for r in got}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    counted = {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert counted == {i: c for i, c in copies.items() if c}


def test_mix_of_nothing(spark):
    assert mixing.allocation(documents(spark, [])).count() == 0
    blank = mixing.allocation(documents(spark, [(1, None, None, "a"), (2, " ", None, None)])).collect()
    assert [(r["target"], r["taken"]) for r in blank] == [(0.0, 0)] * 2


def test_one_source_keeps_all(spark):
    got = mixing.allocation(documents(spark, [(i, "a b c", None, "s") for i in range(10)])).collect()
    assert sum(r["taken"] for r in got) == 30


# --- token shards -------------------------------------------------------

def plain_ids(texts):
    from tokenizers import Tokenizer
    t = Tokenizer.from_str(TOKENIZER)
    return [[*t.encode(x or "", add_special_tokens=False).ids, 0] for x in texts]


ODD = [None, "", " ", " a", "a ", "  two  spaces ", "it's I'll 'tis", "<|endoftext|> a <|endoftext|>b", "\n\n a \t b", "¿ qué ? « a »",
       "日本 語 a", "a  b 　 c  d", "x\x1f y \x7f z", "é à ß ø x", "1 2 3 !! !!", "😀 😀 a"]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.text(alphabet="ab'1é 　! \n\tA日", max_size=40), max_size=8))
def test_pieces_encode_like_whole_texts(texts):
    from adlens.llm.spans import text_buffer
    ids, counts = tokens_out.PieceEncoder(TOKENIZER).encode(*text_buffer(pa.array(texts, pa.string())))
    want = plain_ids(texts)
    assert counts.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_shards_round_trip(spark):
    rows = [(i, t, None, None) for i, t in enumerate(ODD)] + [(100 + i, t, None, None) for i, t, *_ in corpus(6)] + [(None, "null id", None, None)]
    rows += [rows[-5], (rows[-5][0], "another text", None, None)]
    random.Random(1).shuffle(rows)
    path = scratch_path(spark, "t")
    tokens_out.write_shards(documents(spark, rows, extra=True), path, TOKENIZER, shard_tokens=3000)
    got = tokens_out.read_shards(spark, path).orderBy("start").collect()
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    start, want = 0, []
    for (i, *_), ids in zip(rows, plain_ids([r[1] for r in rows])):
        want.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert [tuple(r) for r in got] == want


def test_shard_of_one_document_and_pairs():
    rng = np.random.default_rng(3)
    ids = np.concatenate([np.append(rng.integers(1, 30, 2000), 0) for _ in range(5)])
    raw = tokens_out.shard_file(7, [3, None, 5, 6, 7], ids, np.full(5, 2001), 50257)
    shard = tokens_out.Shard(raw + b"\n")
    assert shard.number == 7 and shard.doc_ids == [3, None, 5, 6, 7] and len(shard.symbols) < len(ids) * 0.7
    for i in range(5):
        assert np.array_equal(shard.document(i), ids[2001 * i:2001 * (i + 1)])
    assert not (shard.rules == 0).any()


def test_no_documents(spark):
    path = scratch_path(spark, "t")
    tokens_out.write_shards(documents(spark, []), path, TOKENIZER)
    assert tokens_out.read_shards(spark, path).count() == 0


# --- WARC ---------------------------------------------------------------

def test_archives(spark):
    rng = random.Random(2)
    long_ = ["<p>" + "".join(rng.choice("abc é") for _ in range(1500)) + "</p>" for _ in range(4)]
    rows = [(i, f"http://x/{i} y" if i % 4 else None, rng.choice([None, "", "short", "x" * 999, "x" * 1000, *long_])) for i in range(60)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "1 as digest", "2 as head")
    path = scratch_path(spark, "t")
    warc.write_archives(warc.plan_records(pages), path, file_bytes=9000)
    got = sorted(map(tuple, warc.read_archives(spark, path).collect()))
    best = {}
    for i, _, h in rows:
        if h is not None and len(h.encode()) >= 1000:
            best[h] = max(best.get(h, -1), i)
    want = []
    for i, _, h in rows:
        raw, head = (h or "").encode(), best.get(h)
        again = head is not None and head != i
        want.append((i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", head if again else None))
    assert got == sorted(want)


def test_archive_frames():
    record = warc.page_record(5, None, b"x" * 2000, hashlib.sha1(b"x" * 2000).hexdigest(), None, "1970-01-01T00:00:00Z")
    raw = warc._archive([record], "1970-01-01T00:00:00Z") + b"\n"
    first, second = warc.records_of(raw)
    assert b"warcinfo" in first and second == record
    fields, block = warc.parse_record(second)
    assert block.endswith(b"x" * 2000) and "WARC-Target-URI" not in fields


def test_no_pages(spark):
    path = scratch_path(spark, "t")
    warc.write_archives(warc.plan_records(spark.createDataFrame([], "page_id bigint, url string, html string")), path)
    assert warc.read_archives(spark, path).count() == 0


# --- top-k --------------------------------------------------------------

@pytest.mark.parametrize("seed", [1, 2])
def test_topk(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(5, 40))
    v = np.round(centres[rng.integers(5, size=400)] + rng.normal(size=(400, 40)) * 0.3, 1)
    v[10:20] = v[10]
    rows = [(int(i), [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(400, None), (420, [float("nan")] * 40), (440, [None] * 40), (460, [float("inf")] * 40), (480, [])]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 as score", "2 as rank")
    vectors = topk.integer_vectors(table)
    got = topk.top_k(vectors.where("vec_id % 20 = 0"), vectors, 7, round_queries=9).collect()
    q = np.floor(64 * v.astype(np.float32).astype(np.float64)).astype(np.int64)
    want = []
    for i in range(0, 400, 20):
        s = q @ q[i]
        order = [j for j in np.lexsort((np.arange(400), -s)) if j != i][:7]
        want += [(i, k + 1, int(j), int(s[j])) for k, j in enumerate(order)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_topk_with_few_candidates(spark):
    make = lambda rows: topk.integer_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    few = make([(20, [1.0, 0.0]), (1, [0.5, 0.5])])
    assert [tuple(r) for r in topk.top_k(few.where("vec_id % 20 = 0"), few, 20).collect()] == [(20, 1, 1, 2048)]
    none = make([])
    assert topk.top_k(none, none, 3).count() == 0


def test_topk_of_odd_rows(spark):
    make = lambda rows: topk.integer_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<float>"))
    rows = [(20, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [4e7, 1.0]), (None, [9.0, 9.0]), (3, [1.0]), (40, [5.0]), (60, [0.0, 3.0]), (60, [0.0, 1.0]),
            (4, [3e38, -3e38]), (5, None), (6, []), (7, [float("nan"), 1.0])]
    vectors = make(rows)
    got = [tuple(r) for r in topk.top_k(vectors.where("vec_id % 20 = 0"), vectors, 20).collect()]
    most = 2 ** 53
    # the least of the two vectors 60 asks; 3, 40 have another length; 4 is bounded
    assert sorted(got) == [(20, 1, 4, 64 * most), (20, 2, 2, 64 * 64 * 40_000_000), (20, 3, 1, 64 * 128), (20, 4, 60, 0), (20, 5, 60, 0),
                           (60, 1, 2, 64 * 64), (60, 2, 1, 0), (60, 3, 20, 0), (60, 4, 4, -64 * most)]
