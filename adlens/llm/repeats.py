"""Windows that occur more than once: the exchanges that the substring
operators share.

Documents are written once as batches of some megabytes, bucketed by batch
number, so that later passes join their findings to the text without moving
the text. Windows that hold the same least k-gram (their anchor) follow one
another in runs; equal windows have equal anchors. A batch sends each distinct
key once to the bucket of its value, the bucket answers one bit per key
("also elsewhere"), and the bits go back by batch number. A hot key therefore
costs one entry per batch, and nothing is gathered beyond a bucket, whose
share shrinks as their number grows with the text.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sizing import pin, spread
from ..session import scratch_path
from .spans import PrefixHash, batches, mix, text_buffer

BATCH_BYTES = 3 << 20
# Bytes of text per bucket of an exchange.
BUCKET_BYTES = 32 << 20
# Stands for a null doc_id: larger than any other, equal to itself.
NO_ID = np.iinfo(np.int64).max
BATCH_SCHEMA = "batch bigint, ids array<bigint>, nulls array<boolean>, lengths array<int>, text binary"


class Batches:
    """The written batches; ``buckets`` is the number of exchange buckets."""

    def __init__(self, spark: SparkSession, table: str, parts: int, buckets: int):
        self.spark, self.name, self.parts, self.buckets = spark, table, parts, buckets

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def with_answers(self, *answers: DataFrame) -> DataFrame:
        """The batches, each with one list per table of ``batch`` and other
        columns; the text is not shuffled."""
        out = self.table()
        for i, answer in enumerate(answers):
            rest = [c for c in answer.columns if c != "batch"]
            lists = answer.groupBy("batch").agg(F.collect_list(F.struct(*rest)).alias(f"found{i}"))
            out = out.join(lists.hint("shuffle_hash"), "batch", "left")
        return out

    def drop(self) -> None:
        """Forget the catalog's entry; its files lie in the shared folder."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")


def write_batches(docs: DataFrame, batch_bytes: int = BATCH_BYTES) -> Batches:
    """Write ``doc_id`` and ``text`` as batches of whole documents."""
    spark = docs.sparkSession

    def pack(parts):
        number, held, size = 0, [], 0

        def close():
            nonlocal number, held, size
            texts = pa.concat_arrays([t for _, t in held])
            data, off = text_buffer(texts)
            ids = pa.concat_arrays([i for i, _ in held])
            nulls = ids.is_null()
            row = [pa.array([(TaskContext.get().partitionId() << 32) + number], pa.int64()),
                   pa.array([ids.fill_null(0).to_numpy(zero_copy_only=False)], pa.list_(pa.int64())),
                   pa.array([nulls.to_numpy(zero_copy_only=False)], pa.list_(pa.bool_())),
                   pa.array([np.diff(off).astype(np.int32)], pa.list_(pa.int32())),
                   pa.array([data.tobytes()], pa.binary())]
            number, held, size = number + 1, [], 0
            return pa.RecordBatch.from_arrays(row, ["batch", "ids", "nulls", "lengths", "text"])

        for part in batches(parts):
            texts, ids = part.column("text"), part.column("doc_id").cast(pa.int64())
            _, off = text_buffer(texts)
            a = 0
            while a < len(texts):
                b = max(a + 1, int(np.searchsorted(off, off[a] + batch_bytes - size, side="right")) - 1)
                held.append((ids.slice(a, b - a), texts.slice(a, b - a)))
                size += int(off[b] - off[a])
                a = b
                if size >= batch_bytes or a < len(texts):
                    yield close()
        if held:
            yield close()

    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    packed = spread(docs.select("doc_id", "text")).mapInArrow(pack, BATCH_SCHEMA)
    name = f"batches_{uuid.uuid4().hex[:12]}"
    packed.write.bucketBy(parts, "batch").option("path", scratch_path(spark, "batches")).format("parquet").saveAsTable(name)
    n = spark.table(name).count()
    return Batches(spark, name, parts, max(parts, -(-n * batch_bytes // BUCKET_BYTES)))


def batch_rows(parts):
    """(row of the batch, documents' ids, offsets, text) of each batch."""
    for part in batches(parts):
        for i in range(part.num_rows):
            ids = part.column("ids")[i].values.to_numpy().copy()
            ids[part.column("nulls")[i].values.to_numpy(zero_copy_only=False)] = NO_ID
            lengths = part.column("lengths")[i].values.to_numpy()
            raw = part.column("text")[i].as_buffer()
            data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
            yield part.slice(i, 1), ids, np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)]), data


def window_ends(off: np.ndarray, n: int, length: int) -> np.ndarray:
    """For each possible window start whether the window ends in its row."""
    ends = np.repeat(off[1:], np.diff(off))[:max(n - length + 1, 0)]
    return np.arange(len(ends)) + length <= ends


def least(g: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    size, cur = 1, g
    while size * 2 <= width:
        cur = np.minimum(cur[:-size], cur[size:])
        size *= 2
    return np.minimum(cur[:len(cur) - (width - size)], cur[width - size:]) if width > size else cur


def runs(hashes: PrefixHash, off: np.ndarray, length: int, k: int):
    """Starts, ends (of window starts) and anchors of the runs of windows."""
    n = len(hashes.prefix) - 1
    if n < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    anchor = least(mix(hashes.windows(k)), length - k + 1)
    ok = window_ends(off, n, length)
    first = ok.copy()
    first[1:] &= ~ok[:-1] | (anchor[1:] != anchor[:-1])
    last = ok.copy()
    last[:-1] &= ~ok[1:] | (anchor[1:] != anchor[:-1])
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, anchor[starts]


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """A key's bucket; its lowest bit, which carries a flag, plays no part."""
    return (keys >> np.uint64(1)) % np.uint64(buckets)


def send_keys(batch: int, keys: np.ndarray, twice: np.ndarray, buckets: int, more: np.ndarray | None = None):
    """Rows of one batch's distinct keys by bucket. ``keys`` are sorted by
    (bucket, key); a key's lowest bit gives way to ``twice``."""
    bucket = bucket_of(keys, buckets)
    edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])) if len(keys) else np.zeros(0, np.int64)
    stop = np.append(edge[1:], len(keys))
    out = (keys & ~np.uint64(1)) | twice.astype(np.uint64)
    columns = [pa.array(bucket[edge].astype(np.int32)), pa.array(np.full(len(edge), batch)),
               pa.array([out[a:b].tobytes() for a, b in zip(edge, stop)], pa.binary()),
               pa.array([b"" if more is None else more[a:b].tobytes() for a, b in zip(edge, stop)], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["bucket", "batch", "keys", "more"])


KEYS_SCHEMA = "bucket int, batch bigint, keys binary, more binary"


def distinct_keys(keys: np.ndarray, buckets: int):
    """Distinct keys in the order of (bucket, key), and each key's place."""
    whole, place = np.unique(keys, return_inverse=True)
    bucket = bucket_of(whole, buckets)
    order = np.argsort(bucket.astype(np.uint16) if buckets < 1 << 16 else bucket, kind="stable")  # two bytes: a radix sort
    back = np.empty(len(order), np.int64)
    back[order] = np.arange(len(order))
    return whole[order], back[place]


def answer_keys(sent: DataFrame) -> DataFrame:
    """``batch``, ``bucket``, ``bits``: for every key sent whether its bit was
    set or another batch sent it too."""

    def judge(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("keys")]
        extra = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("more")]
        size = np.array([len(x) for x in lists])
        flat = np.concatenate(lists)
        key, flag = flat >> np.uint64(1), (flat & np.uint64(1)).astype(bool)
        if sum(len(x) for x in extra):  # a second hash belongs to the key
            order = np.lexsort((np.concatenate(extra), key))
            second = np.concatenate(extra)[order]
        else:
            order, second = np.argsort(key, kind="stable"), None
        same = key[order][1:] == key[order][:-1]
        if second is not None:
            same &= second[1:] == second[:-1]
        often = flag[order]
        often[1:] |= same
        often[:-1] |= same
        bits = np.empty(len(flat), bool)
        bits[order] = often
        stop = np.cumsum(size)
        packed = [np.packbits(bits[e - n:e]).tobytes() for e, n in zip(stop, size)]
        return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "bits": pa.array(packed, pa.binary())})

    return sent.groupBy("bucket").applyInArrow(judge, "batch bigint, bucket int, bits binary")


def read_bits(found, keys: np.ndarray, buckets: int) -> np.ndarray:
    """The answers for a batch's ``distinct_keys``, from its list of structs."""
    out = np.zeros(len(keys), bool)
    bucket = bucket_of(keys, buckets)
    for item in found or ():
        a, b = np.searchsorted(bucket, [item["bucket"], item["bucket"] + 1])
        out[a:b] = np.unpackbits(np.frombuffer(item["bits"], np.uint8), count=int(b - a)).astype(bool)
    return out


def repeated_keys(batched: Batches, keys_of, name: str) -> DataFrame:
    """Send ``keys_of(ids, off, data)`` = (keys, twice[, second hashes]) of
    every batch and pin the answers."""
    buckets = batched.buckets

    def send(parts):
        for row, ids, off, data in batch_rows(parts):
            out = send_keys(row.column("batch")[0].as_py(), *keys_of(ids, off, data)[:2], buckets)
            if out.num_rows:
                yield out

    return pin(answer_keys(batched.table().mapInArrow(send, KEYS_SCHEMA)))
