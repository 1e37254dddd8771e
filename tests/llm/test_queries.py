"""The registered queries and the pipeline on the small tables."""

import collections
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from helpers import WORD, documents

import __spark_entry__ as ent
import corpus_pipeline
from adlens.llm import queries, tokens_out

SF_SMALL = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op2_debruijn": "doc_id n_words n_removed n_spans n_paths kept_sha256",
    "op3_decontaminate": "doc_id contaminated item_ids",
    "op4_mixing": "doc_id size source_size target taken",
    "op5_tokens": "doc_id start n_tokens ids_crc32",
    "op6_warc": "page_id payload_bytes payload_digest record_type refers_to",
    "op7_topk": "query_id rank vec_id score",
    "op8_langid": "doc_id held_out lang_pred score",
    "op9_neardup": "doc_id n_shingles component_id kept",
    "op10_toxicity": "doc_id held_out score predicted",
    "op11_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op12_whitening": "vec_id component n deviation whitened explained identity_error",
    "op13_repair": "conv_id gaps blank duplicate truncated illegal cost audit repaired_sha256",
}


def test_all_registered():
    names = ent.queries()
    assert set(CONTRACT) | {"pipeline"} <= set(names)
    assert set(queries.oracle_sql()) <= set(queries.queries())


@pytest.mark.parametrize("name", sorted(CONTRACT))
def test_runs_over_the_whole_table(spark, name):
    got = ent.queries()[name](spark, SF_SMALL)
    assert got.columns == CONTRACT[name].split()
    rows = got.collect()
    table = {"op6_warc": "pages", "op7_topk": "embeddings", "op12_whitening": "embeddings", "op13_repair": "conversations"}.get(name, "documents")
    what = "distinct conv_id" if name == "op13_repair" else "*"
    n = duckdb.connect().execute(f"select count({what}) from '{SF_SMALL}/{table}.parquet'").fetchone()[0]
    assert len(rows) == (20 * -(-n // 20) if name == "op7_topk" else 32 * n if name == "op12_whitening" else n)


def plain_near(rows, num):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    sets = {}
    for i, t, *_ in rows:
        w = WORD.findall((t or "").translate(lower))
        sets[i] = {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    label = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            common = len(sets[i] & sets[j])
            if j < i and common and 100 * common >= num * (len(sets[i]) + len(sets[j]) - common):
                a, b = label[i], label[j]
                label = {k: min(a, b) if v in (a, b) else v for k, v in label.items()}
    return label


def test_pipeline_against_plain_stages(spark, tmp_dir):
    rng = random.Random(8)
    syllables = {"aa": "ba be bi bo bu la le".split(), "bb": "ka ke ki zé zè ô".split()}
    make = lambda lang, n: " ".join("".join(rng.choice(syllables[lang]) for _ in range(rng.randint(2, 5))) for _ in range(n))
    items = [make("aa", 20), make("bb", 15)]
    rows = []
    for i in range(120):
        lang = rng.choice(["aa", "bb"])
        t = make(lang, rng.randint(20, 90))
        if i % 10 == 3:
            t += " " + rng.choice(items)
        rows.append((i, t, lang, f"s{i % 4}"))
    rows += [(200 + k, rows[k][1] + " ba", rows[k][2], rows[k][3]) for k in range(0, 40, 4)]
    rows += [(300, None, "aa", "s1"), (301, "12 34", None, None), (302, rows[5][1], None, None)]
    documents(spark, rows).write.parquet(f"{tmp_dir}/documents.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    docs, kept = spark.read.parquet(f"{tmp_dir}/documents.parquet"), [r for r in rows if re.search(r"[a-z]", r[1] or "")]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    by_name = dict(corpus_pipeline.STAGES)
    for name in names[:4]:
        docs = by_name[name](spark, docs, tmp_dir)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        ids = collections.Counter(r["doc_id"] for r in docs.select("doc_id").collect())
        if name == "near_duplicates":
            label = plain_near(kept, corpus_pipeline.NEAR)
            kept = [r for r in kept if label[r[0]] == r[0]]
        if name == "benchmark":
            kept = [r for r in kept if not any(x in r[1] for x in items)]
        if name == "mix":
            assert set(ids) <= {r[0] for r in kept} and max(ids.values()) <= 3
        else:
            assert ids == collections.Counter(r[0] for r in kept), name
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_str(tokens_out.load_tokenizer(queries.tokenizer_file()))
    start, want = 0, []
    for r in docs.orderBy("doc_id").collect():
        ids = [*tokenizer.encode(r["text"], add_special_tokens=False).ids, 0]
        want.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, tmp_dir).collect())) == sorted(want)
    assert corpus_pipeline.ORACLE_SQL is None and "pipeline" not in ent.oracle_sql()


def test_pipeline_passes_texts_in_small_batches(spark):
    key, rows = "spark.sql.execution.arrow.maxRecordsPerBatch", [(i, "some words", "en", "s") for i in range(3000)]
    docs = documents(spark, rows).coalesce(1)
    try:
        for set_, most in ((None, 1000), ("700", 700)):
            spark.conf.unset(key)
            if set_:
                spark.conf.set(key, set_)
            corpus_pipeline.language(spark, docs, None)
            got = docs.mapInArrow(lambda parts: (pa.RecordBatch.from_pydict({"n": [p.num_rows]}) for p in parts), "n bigint")
            assert max(r.n for r in got.collect()) == most
    finally:
        spark.conf.unset(key)
