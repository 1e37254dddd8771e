"""Substring deduplication on a compacted De Bruijn graph of words.

Windows of ``LENGTH`` words are the edges of a De Bruijn graph; those that
occur more than once, same document included, are kept, and every word that
one of their occurrences covers is removed.

``repeats`` first finds the runs of windows whose anchor occurs again; only
the windows of these are counted, as pairs of independent 64-bit hashes. A
stretch of consecutive repeated windows of a document is a walk through the
graph. The batch cuts it at sampled windows (one in ``SAMPLE`` by hash, the
same ones everywhere) into segments, each with its ends, its length and a hash
of all its words. From there on Spark joins compact: two segments that meet in
a sampled window with one way in and one way out join the same path, and
connected components of these links are the nonbranching paths. Every
segment keeps its source coordinate (doc_id, first word); a segment that was
seen at several coordinates counts as verified, since it has one hash of its
whole word sequence at all of them.

Defined cases: a null text has no word; a null doc_id is reported as null;
texts below ``LENGTH`` words keep everything; repeated rows are separate
documents, so both lose what they share. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import pin
from ..session import scratch_scope
from .components import components
from .repeats import NO_ID, Batches, answer_keys, batch_rows, distinct_keys, least, read_bits, runs, send_keys, window_ends, write_batches, KEYS_SCHEMA
from .spans import BASE, PrefixHash, mix, ragged, word_hashes

LENGTH = 35
ANCHOR = 8
SAMPLE = 64


def _anchor_keys(chain: PrefixHash, off: np.ndarray, buckets: int):
    """Distinct anchors of a batch by place of occurrence: (keys, seen twice)."""
    n, width = len(chain.prefix) - 1, LENGTH - ANCHOR + 1
    if n < LENGTH:
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    g = mix(chain.windows(ANCHOR))
    low = least(g, width)
    low[~window_ends(off, n, LENGTH)] = 0
    # a place is an anchor if it is the least of some window around it
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    pad = np.zeros(width - 1, np.uint64)
    most = full - least(full - np.concatenate([pad, low, pad]), width)
    keys, place = distinct_keys(g[most >= g] & ~np.uint64(1), buckets)
    return keys, np.bincount(place, minlength=len(keys)) > 1


def _windows(chain: PrefixHash, codes: np.ndarray, off: np.ndarray, found, buckets: int):
    """Starts and both hashes of the windows whose anchor occurs again."""
    start, end, anchor = runs(chain, off, LENGTH, ANCHOR)
    keys, _ = _anchor_keys(chain, off, buckets)
    again = read_bits(found, keys, buckets)
    order = np.argsort(keys)
    at = np.searchsorted(keys[order], anchor & ~np.uint64(1))
    mine = again[order[at]] if len(anchor) else np.zeros(0, bool)
    start, end = start[mine], end[mine]
    at = ragged(end - start, start)
    second = PrefixHash(mix(codes ^ np.uint64(BASE)))
    return at, mix(chain.span(at, at + LENGTH)) & ~np.uint64(1), mix(second.span(at, at + LENGTH))


def _edges(first: np.ndarray, second: np.ndarray, buckets: int):
    """Distinct windows: keys, seen twice, second hashes; and places."""
    keys, place = distinct_keys(first, buckets)
    more = np.zeros(len(keys), np.uint64)
    more[place] = second
    return keys, np.bincount(place, minlength=len(keys)) > 1, more, place


def _walk(ids, off, data, anchors, edges, buckets):
    """Word spans, their codes, row offsets and for every window start
    whether the window occurs again."""
    starts, ends, codes, first = word_hashes(data, off)
    chain = PrefixHash(codes)
    at, one, two = _windows(chain, codes, first, anchors, buckets)
    keys, _, _, place = _edges(one, two, buckets)
    again = read_bits(edges, keys, buckets)[place]
    return starts, ends, codes, first, at[again], one[again]


def find_segments(ids, first, codes, at, key):
    """The segments of a batch's repeated stretches: ends, windows, hash of
    all words, doc_id, first word within the document."""
    if len(at) == 0:
        return [np.zeros(0, np.int64)] * 7
    row = np.searchsorted(first, at, side="right") - 1
    begins = np.append(True, (at[1:] != at[:-1] + 1) | (row[1:] != row[:-1]))
    sampled = (key >> np.uint64(1)) % np.uint64(SAMPLE) == 0
    cut = np.flatnonzero(begins | sampled)
    # a segment runs from a cut to the next one, or to the end of its stretch
    stop = np.append(cut[1:], len(at))
    ends_stretch = np.append(begins[stop[:-1]], True)
    last = np.where(ends_stretch, stop - 1, stop)
    whole = PrefixHash(mix(codes + np.uint64(BASE)))
    content = mix(whole.span(at[cut], at[last] + LENGTH))
    full = sampled[cut] & sampled[last] & (last > cut)
    doc = row[cut]
    return [key[cut].view(np.int64), key[last].view(np.int64), last - cut, content.view(np.int64), full,
            ids[doc], at[cut] - first[doc]]


SEGMENT_SCHEMA = "a bigint, b bigint, windows bigint, content bigint, full boolean, doc_id bigint, word bigint"
RESULT_SCHEMA = "doc_id bigint, n_words bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


class RepeatedText:
    """Batches with the answers of both exchanges, ready for the results."""

    def __init__(self, docs: DataFrame):
        self.batched = write_batches(docs)
        buckets = self.batched.buckets

        def send_anchors(parts):
            for row, ids, off, data in batch_rows(parts):
                _, _, codes, first = word_hashes(data, off)
                keys, twice = _anchor_keys(PrefixHash(codes), first, buckets)
                if len(keys):
                    yield send_keys(row.column("batch")[0].as_py(), keys, twice, buckets)

        self.anchors = pin(answer_keys(self.batched.table().mapInArrow(send_anchors, KEYS_SCHEMA)))

        def send_edges(parts):
            for row, ids, off, data in batch_rows(parts):
                _, _, codes, first = word_hashes(data, off)
                _, one, two = _windows(PrefixHash(codes), codes, first, row.column("found0")[0].as_py(), buckets)
                keys, twice, more, _ = _edges(one, two, buckets)
                if len(keys):
                    yield send_keys(row.column("batch")[0].as_py(), keys, twice, buckets, more)

        self.edges = pin(answer_keys(self.batched.with_answers(self.anchors).mapInArrow(send_edges, KEYS_SCHEMA)))

    def _answered(self) -> DataFrame:
        return self.batched.with_answers(self.anchors, self.edges)

    def segments(self) -> DataFrame:
        """Every occurrence of a segment with its source coordinate."""
        buckets = self.batched.buckets

        def run(parts):
            for row, ids, off, data in batch_rows(parts):
                found = [row.column(c)[0].as_py() for c in ("found0", "found1")]
                _, _, codes, first, at, key = _walk(ids, off, data, *found, buckets)
                out = find_segments(ids, first, codes, at, key)
                nulls = out[5] == NO_ID
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x) for x in out[:4]), pa.array(out[4], pa.bool_()), pa.array(out[5], pa.int64(), mask=nulls), pa.array(out[6])],
                    ["a", "b", "windows", "content", "full", "doc_id", "word"])

        return self._answered().mapInArrow(run, SEGMENT_SCHEMA)

    def kept(self) -> DataFrame:
        """``doc_id``, ``n_words``, ``n_removed``, ``n_spans``, ``kept_sha256``."""
        buckets = self.batched.buckets

        def run(parts):
            for row, ids, off, data in batch_rows(parts):
                found = [row.column(c)[0].as_py() for c in ("found0", "found1")]
                starts, ends, codes, first, at, _ = _walk(ids, off, data, *found, buckets)
                depth = np.zeros(len(codes) + 1, np.int32)
                depth[at] += 1
                np.subtract.at(depth, at + LENGTH, 1)
                gone = np.cumsum(depth[:-1]) > 0
                begin = gone.copy()
                begin[1:] &= ~gone[:-1]
                heads = first[:-1][first[1:] > first[:-1]]
                begin[heads] = gone[heads]
                total, spans = (np.concatenate([[0], np.cumsum(x)]) for x in (gone, begin))
                # kept words, each followed by one space
                stay = np.flatnonzero(~gone)
                size = ends[stay] - starts[stay] + 1
                joined = np.append(data, np.uint8(32))[ragged(size, starts[stay])]
                reach = np.concatenate([[0], np.cumsum(size)])
                joined[reach[1:] - 1] = 32
                edge = reach[np.searchsorted(stay, first)]
                raw = joined.tobytes()
                sums = [hashlib.sha256(raw[a:max(a, b - 1)]).hexdigest() for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(np.diff(first)), pa.array(np.diff(total[first])),
                     pa.array(np.diff(spans[first])), pa.array(sums, pa.string())],
                    ["doc_id", "n_words", "n_removed", "n_spans", "kept_sha256"])

        return self._answered().mapInArrow(run, RESULT_SCHEMA)


def compact(occurrences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(segments, paths): the distinct segments with their path, occurrences
    and first coordinate, and the nonbranching paths they add up to."""
    named = occurrences.groupBy("a", "b", "windows", "content", "full").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct(F.col("doc_id"), F.col("word"))).alias("source"))
    segments = pin(named.withColumn("segment", F.xxhash64("a", "b", "windows", "content")))
    full = segments.where("full")
    out = full.groupBy("a").agg(F.count(F.lit(1)).alias("ways")).select(F.col("a").alias("at"), F.col("ways").alias("out"))
    into = full.groupBy("b").agg(F.count(F.lit(1)).alias("ways")).select(F.col("b").alias("at"), F.col("ways").alias("into"))
    plain = out.join(into, "at").where("out = 1 and into = 1").select("at")
    meet = (segments.where("windows > 0").select(F.col("b").alias("at"), F.col("segment").alias("a")).join(plain, "at")
            .join(segments.where("windows > 0").select(F.col("a").alias("at"), F.col("segment").alias("b")), "at"))
    path = pin(components(pin(meet.select("a", "b").where("a <> b").distinct())))
    segments = pin(segments.join(path.withColumnRenamed("node", "segment").withColumnRenamed("component", "path"), "segment", "left")
                   .withColumn("path", F.coalesce("path", "segment")))
    paths = segments.groupBy("path").agg(
        F.count(F.lit(1)).alias("n_segments"), (F.sum("windows") + LENGTH).alias("n_words"), F.max("n").alias("n_occurrences"),
        (F.max("n") > 1).alias("verified"), F.min("source").alias("source"))
    return segments, paths


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``n_spans`` (maximal removed
    stretches), ``n_paths`` (compacted paths they run through) and
    ``kept_sha256`` (kept words joined by one space) of every row."""
    with scratch_scope(docs.sparkSession):  # only the result stays
        text = RepeatedText(docs)
        occurrences = pin(text.segments())
        kept = pin(text.kept())
        segments, _ = compact(occurrences)
        out = pin(_with_paths(kept, occurrences, segments), keep=True)
        text.batched.drop()
    return out


def _with_paths(kept: DataFrame, occurrences: DataFrame, segments: DataFrame) -> DataFrame:
    walked = (occurrences.join(segments.select("a", "b", "windows", "content", "path"), ["a", "b", "windows", "content"])
              .groupBy("doc_id").agg(F.count_distinct("path").alias("n_paths")))
    return kept.alias("k").join(walked.alias("w"), F.expr("k.doc_id <=> w.doc_id"), "left").select(
        "k.doc_id", "k.n_words", "k.n_removed", "k.n_spans", F.coalesce("w.n_paths", F.lit(0)).cast("bigint").alias("n_paths"), "k.kept_sha256")
