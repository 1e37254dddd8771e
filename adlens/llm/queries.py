"""The registered queries of this package and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from . import debruijn, decontaminate, langid, mixing, neardup, repair, sharding, suffix_dedup, tokens_out, topk, toxicity, warc, whitening


def _read(spark, sf_dir, table):
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _bucket(n):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(n))


def op1_suffix_dedup(spark, sf_dir):
    """Bytes of every document without strings of earlier ones; see ``suffix_dedup``."""
    return suffix_dedup.remove_repeats(_read(spark, sf_dir, "documents"))


def op2_debruijn(spark, sf_dir):
    """Words of every document without repeated 35-word windows; see ``debruijn``."""
    return debruijn.remove_repeats(_read(spark, sf_dir, "documents"))


def op3_decontaminate(spark, sf_dir):
    """The benchmark items that every document holds; see ``decontaminate``."""
    found = decontaminate.contaminated_items(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("item_ids") > 0).alias("contaminated"), "item_ids")


def op4_mixing(spark, sf_dir):
    """Copies of every document that bring its source to its target; see ``mixing``."""
    return mixing.allocation(_read(spark, sf_dir, "documents"))


def tokenizer_file():
    """The public byte-level BPE that the contract names."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op5_tokens(spark, sf_dir):
    """Ids of every document written to Re-Pair shards and read back; see ``tokens_out``."""
    path = scratch_path(spark, "tokens")
    tokens_out.write_shards(_read(spark, sf_dir, "documents"), path, tokens_out.load_tokenizer(tokenizer_file()))
    return tokens_out.read_shards(spark, path)


def op6_warc(spark, sf_dir):
    """Every page written to WARC archives and read back; see ``warc``."""
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.plan_records(_read(spark, sf_dir, "pages")), path)
    return warc.read_archives(spark, path)


def op7_topk(spark, sf_dir):
    """The 20 best inner products of every twentieth vector; see ``topk``."""
    vectors = topk.integer_vectors(_read(spark, sf_dir, "embeddings"))
    found = topk.top_k(vectors.where("vec_id % 20 = 0"), vectors, 20)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_langid(spark, sf_dir):
    """Word-first language ID of every document; see ``langid``."""
    docs = _read(spark, sf_dir, "documents")
    held_out = _bucket(4) == 2
    model = langid.fit(docs.where(~held_out))
    found = langid.identify(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_neardup(spark, sf_dir):
    """Near-duplicate groups of all documents at similarity 0.85; see ``neardup``."""
    return neardup.near_duplicates(_read(spark, sf_dir, "documents"), 85, 100)


def op10_toxicity(spark, sf_dir):
    """Calibrated toxicity score of every document; see ``toxicity``."""
    docs, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    held_out = _bucket(3) == 1
    taught = labels.select("doc_id", "toxic").where(~held_out)
    model = toxicity.fit(docs.select("doc_id", "text").where(~held_out).join(taught, "doc_id"))
    return toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op11_sharding(spark, sf_dir):
    """Every document's place in eight shards of equal mixture; see ``sharding``."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    digest = [F.col("doc_id"), (F.octet_length(text) + 1).cast("bigint").alias("size"), F.crc32(text).alias("text_crc32")]
    placed = sharding.interleave(_read(spark, sf_dir, "documents"), 8, keep=digest)
    return placed.select("row.doc_id", "row.size", "row.text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op12_whitening(spark, sf_dir):
    """Every vector on the 32 leading components, whitened; see ``whitening``."""
    return whitening.whiten(_read(spark, sf_dir, "embeddings"), 32)


def op13_repair(spark, sf_dir):
    """Damaged conversations and their cheapest repair; see ``repair``."""
    conversations = _read(spark, sf_dir, "conversations")
    return repair.repair(repair.damage(conversations), conversations.select("conv_id"))


QUERIES = {f.__name__: f for f in (op1_suffix_dedup, op2_debruijn, op3_decontaminate, op4_mixing, op5_tokens, op6_warc, op7_topk, op8_langid,
                                   op9_neardup, op10_toxicity, op11_sharding, op12_whitening, op13_repair)}
#: DuckDB: crc32 of the byte list ``b``, with the list ``k`` of the table CRC_TABLE.
CRC_TABLE = """crc AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, x: xor(c >> 1, 3988292384 * (c & 1))) ORDER BY i) AS k
                    FROM range(256) r(i))"""
CRC = "xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, k[(xor(c, x) & 255) + 1])), 4294967295)"


def _byte_list(text):
    return f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda p: ('0x' || p)::BIGINT)"


ORACLE = {
    "op1_suffix_dedup": """
        WITH d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) AS n, hex(encode(coalesce(text, ''))) AS h FROM documents),
             p AS (SELECT doc_id, n, h, unnest(range(0, n)) AS i FROM d),
             w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM p WHERE i + 50 <= n),
             f AS (SELECT s, min(doc_id) AS first_doc FROM w GROUP BY s),
             g AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM w JOIN f USING (s) WHERE first_doc < doc_id),
             b AS (SELECT p.doc_id, p.i, substr(p.h, 2 * p.i + 1, 2) AS x, g.i IS NOT NULL AS gone
                   FROM p LEFT JOIN g ON p.doc_id = g.doc_id AND p.i = g.i),
             r AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM b),
             k AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
                          string_agg(x, '' ORDER BY i) FILTER (NOT gone) AS kept FROM r GROUP BY doc_id)
        SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
               sha256(unhex(coalesce(kept, ''))) AS kept_sha256
        FROM d LEFT JOIN k USING (doc_id)""",
    "op9_neardup": r"""
        WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
             s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + greatest(least(len(w), 5), 1) - 1], ' ') AS x
                   FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i FROM d)),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS both_n FROM s a JOIN s b USING (x) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
             e AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
                   WHERE 100 * both_n >= 85 * (na.n + nb.n - both_n)),
             reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
             m AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, component_id = doc_id AS kept FROM m LEFT JOIN n USING (doc_id)""",
    "op6_warc": """
        WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
                   FROM pages),
             h AS (SELECT payload_digest, max(page_id) AS head FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN head IS NULL OR head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN head = page_id THEN NULL ELSE head END AS refers_to
        FROM p LEFT JOIN h USING (payload_digest)""",
    "op7_topk": """
        WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
                   WHERE embedding IS NOT NULL AND len(embedding) > 0
                     AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
                   FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 20""",
    "op11_sharding": f"""
        WITH {CRC_TABLE},
             d AS (SELECT doc_id, source, octet_length(encode(coalesce(text, ''))) + 1 AS size, {_byte_list("coalesce(text, '')")} AS b,
                          md5('0:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS key,
                          (('0x' || substr(md5('0:' || coalesce('s' || source, 'n')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE AS draw
                   FROM documents),
             c AS (SELECT * EXCLUDE (b), {CRC} AS text_crc32 FROM d, crc),
             r AS (SELECT *, ((row_number() OVER s - 1)::DOUBLE + draw) / (count(*) OVER (PARTITION BY source))::DOUBLE AS share FROM c
                   WINDOW s AS (PARTITION BY source ORDER BY key, size)),
             p AS (SELECT *, row_number() OVER (ORDER BY share, source NULLS FIRST, key, size) - 1 AS place, count(*) OVER () AS total FROM r),
             h AS (SELECT *, (place * 8) // total AS shard FROM p)
        SELECT doc_id, size::BIGINT AS size, text_crc32, 'rows' AS law, shard::INTEGER AS shard,
               (place - (shard * total + 7) // 8)::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM h""",
    "op13_repair": rf"""
        WITH RECURSIVE {CRC_TABLE},
             b AS (SELECT *, {_byte_list("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} AS b FROM conversations),
             d AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {CRC} % 20 AS fate FROM b, crc),
             r AS (SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
                          CASE fate WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                          unnest(range(CASE WHEN fate = 3 THEN 2 ELSE 1 END)) AS copy FROM d WHERE fate <> 0),
             o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
                          regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS body, substr(role, 1, 1) AS initial FROM r),
             f AS (SELECT *, CASE WHEN body = '' THEN 2 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 3
                                  WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault,
                          lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial AS pair FROM o),
             inserts(state, n, here, ahead) AS (VALUES (0, 0, 0, 2), (0, 1, 2, 3), (0, 2, 3, 2), (1, 0, 1, 2), (1, 1, 2, 3), (1, 2, 3, 2),
                                             (2, 0, 2, 3), (2, 1, 3, 2), (2, 2, 2, 3), (3, 0, 3, 2), (3, 1, 2, 3), (3, 2, 3, 2)),
             edits(edit) AS (VALUES ('D'), ('K'), ('S'), ('R')),
             best AS (SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0 AS cost, '' AS audit FROM f
                      UNION ALL
                      SELECT conv_id, i, state, min(step).cost AS cost, min(step).audit AS audit
                      FROM (SELECT f.conv_id, f.i, CASE edit WHEN 'D' THEN here WHEN 'S' THEN 1 ELSE ahead END AS state,
                                   {{'cost': cost + 2 * n + CASE edit WHEN 'D' THEN 3 WHEN 'R' THEN 2 ELSE 0 END
                                             + CASE WHEN edit <> 'D' AND fault = 1 THEN 1 ELSE 0 END,
                                     'audit': audit || repeat('I', n) || replace(edit, 'S', 'K')}} AS step
                            FROM best JOIN f ON f.conv_id IS NOT DISTINCT FROM best.conv_id AND f.i = best.i + 1
                            JOIN inserts ON inserts.state = best.state CROSS JOIN edits
                            WHERE edit = 'D' OR (fault < 2 AND (edit = 'R' OR (edit = 'K' AND initial = CASE ahead WHEN 2 THEN 'u' ELSE 'a' END)
                                                                OR (edit = 'S' AND initial = 's' AND here = 0))))
                      GROUP BY conv_id, i, state),
             s AS (SELECT conv_id, max(i) AS rows, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 2) AS blank,
                          count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
                          count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
             w AS (SELECT s.conv_id, min({{'cost': cost + CASE state WHEN 1 THEN 4 WHEN 2 THEN 2 ELSE 0 END,
                                           'audit': audit || CASE state WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}}) AS won
                   FROM best JOIN s ON s.conv_id IS NOT DISTINCT FROM best.conv_id AND s.rows = best.i GROUP BY s.conv_id),
             e AS (SELECT conv_id, pos, substr(won.audit, pos, 1) AS edit, len(replace(substr(won.audit, 1, pos), 'I', '')) AS i
                   FROM (SELECT conv_id, won, unnest(range(1, len(won.audit) + 1)) AS pos FROM w)),
             k AS (SELECT e.conv_id, e.pos, e.edit, f.role, f.text, f.initial,
                          row_number() OVER c - max(CASE WHEN e.edit = 'K' AND f.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS j
                   FROM e LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i AND e.edit <> 'I' WHERE e.edit <> 'D'
                   WINDOW c AS (PARTITION BY e.conv_id ORDER BY e.pos)),
             t AS (SELECT conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN j % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                                              || CASE WHEN edit = 'I' THEN '' ELSE text END, chr(10) ORDER BY pos) AS repaired
                   FROM k GROUP BY conv_id)
        SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(won.cost, 0)::BIGINT AS cost,
               coalesce(won.audit, '') AS audit, sha256(coalesce(repaired, '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN s ON s.conv_id IS NOT DISTINCT FROM c.conv_id
        LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN t ON t.conv_id IS NOT DISTINCT FROM c.conv_id""",
}


def queries():
    return dict(QUERIES)


def oracle_sql():
    return dict(ORACLE)
