"""Suffix-array deduplication of substrings across documents.

Every byte covered by a ``LENGTH``-byte string that also starts in a document
with a smaller doc_id is removed; strings are judged on the input.

``repeats`` finds the runs of windows whose anchor occurs in another document.
Only those runs travel as text, each distinct one once per batch, to the
bucket of their anchor. There equal runs become one (bytes compared), an
anchor with a single run is settled, and the windows of all others are
suffix-sorted: prefix polynomial hashes and a binary search give the common
extension of two suffixes in a logarithmic number of steps, a bottom-up
mergesort over whole arrays orders the suffixes with that comparison, and
neighbours with an extension of ``LENGTH`` are compared byte by byte before
they count as equal. The smallest doc_id of each string goes back to the
batches, which mark the bytes.

Defined cases: a null text is empty; a null doc_id is larger than any other
and not smaller than itself, nor are rows that share a doc_id, so they remove
nothing from one another; texts shorter than ``LENGTH`` keep everything.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ..operators.sizing import pin
from ..session import scratch_scope
from .repeats import NO_ID, Batches, answer_keys, batch_rows, bucket_of, distinct_keys, read_bits, runs, send_keys, write_batches, KEYS_SCHEMA
from .spans import BYTE_CODE, PrefixHash, mix, power_tables, ragged, steps

LENGTH = 50
ANCHOR = 20
# Parts into which the runs' text is dealt, per bucket of anchors: their text
# is many times larger, and sorting takes many bytes of memory for each.
RUN_PARTS = 8
# Bytes taken per step of ``find_runs``: its arrays then stay in a core's cache.
RUN_STEP = 1 << 17


class SuffixOrder:
    """Suffixes of a byte array compared by hashed common extensions."""

    def __init__(self, text: np.ndarray, depth: int):
        self.text, self.depth = text, depth
        self.hashes = PrefixHash(BYTE_CODE[text])
        self.whole = self.hashes.windows(depth)  # of every suffix with ``depth`` bytes

    def extension(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Length of the common extension of two suffixes, up to ``depth``."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.depth)
        for _ in range(int(self.depth).bit_length()):
            middle = (low + high + 1) // 2
            same = self.hashes.span(x, x + middle) == self.hashes.span(y, y + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def less(self, x: np.ndarray, y: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether suffix x stands before suffix y (or beside it)."""
        out = self.whole[x] == self.whole[y]
        differ = np.flatnonzero(~out)
        x, y = x[differ], y[differ]
        n = np.minimum(self.extension(x, y), self.depth - 1)
        out &= or_equal
        out[differ] = self.text[x + n] < self.text[y + n]
        return out

    def heads(self, starts: np.ndarray) -> np.ndarray:
        """The first eight bytes of suffixes, as numbers that order alike."""
        head = np.zeros(len(starts), np.uint64)
        for i in range(8):
            head = (head << np.uint64(8)) | self.text[starts + i]
        return head

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes by group, then text: bottom-up mergesort in
        every class of one group and one eight-byte head. Suffixes of one
        group whose ``depth`` bytes hash alike go through it as one."""
        whole = self.whole[starts]
        alike = np.argsort(mix(whole ^ mix(group.astype(np.uint64))))
        new = np.ones(len(alike), bool)
        new[1:] = (whole[alike][1:] != whole[alike][:-1]) | (group[alike][1:] != group[alike][:-1])
        first = np.flatnonzero(new)
        copies = np.diff(np.append(first, len(alike)))
        order = self.sort_distinct(starts[alike[first]], group[alike[first]])
        return alike[ragged(copies[order], first[order])]

    def sort_distinct(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """The mergesort of ``sort``."""
        head = self.heads(starts)
        order = np.lexsort((head, group))
        new = np.ones(len(order), bool)
        new[1:] = (group[order][1:] != group[order][:-1]) | (head[order][1:] != head[order][:-1])
        begin = np.flatnonzero(new)
        size = np.diff(np.append(begin, len(order)))
        base, total = np.repeat(begin, size), np.repeat(size, size)
        place = np.arange(len(order)) - base
        width = 1
        while len(size) and width < size.max():
            at = np.flatnonzero(total > width)  # positions in ``order``
            run, mine = place[at] // width, starts[order[at]]
            other = (run ^ 1) * width
            count = np.clip(total[at] - other, 0, width)
            low, high = np.zeros(len(at), np.int64), count.copy()
            after = run % 2 == 1  # the right run's elements follow equal ones
            for _ in range(int(width).bit_length()):
                open_ = np.flatnonzero(low < high)
                if len(open_) == 0:
                    break
                middle = (low[open_] + high[open_]) // 2
                there = starts[order[base[at[open_]] + other[open_] + middle]]
                passes = self.less(there, mine[open_], after[open_])
                low[open_] = np.where(passes, middle + 1, low[open_])
                high[open_] = np.where(passes, high[open_], middle)
            to = base[at] + (run // 2) * 2 * width + place[at] % width + low
            order[to] = order[at].copy()
            width *= 2
        return order

    def equal_neighbours(self, starts: np.ndarray, order: np.ndarray, group: np.ndarray, chunk: int = 1 << 14) -> np.ndarray:
        """For each position of the order but the first whether its string of
        ``depth`` bytes equals the one before; every byte is compared."""
        x, y = starts[order[:-1]], starts[order[1:]]
        out = (group[order[:-1]] == group[order[1:]]) & (self.whole[x] == self.whole[y])
        at = np.flatnonzero(out)
        strings = np.lib.stride_tricks.sliding_window_view(self.text, self.depth) if len(at) else None
        for a in range(0, len(at), chunk):
            some = at[a:a + chunk]
            out[some] = (strings[x[some]] == strings[y[some]]).all(axis=1)
        return out


def find_runs(off: np.ndarray, data: np.ndarray):
    """Starts, window counts, anchors and documents of a batch's runs, and
    the hash of each run's bytes."""
    out, ranges = [], list(steps(off, RUN_STEP))
    tables = power_tables(max((int(off[b] - off[a]) for a, b in ranges), default=0))
    for a, b in ranges:
        hashes = PrefixHash(BYTE_CODE[data[off[a]:off[b]]], tables)
        starts, ends, anchor = runs(hashes, off[a:b + 1] - off[a], LENGTH, ANCHOR)
        whole = mix(hashes.span(starts, ends + LENGTH - 1)) ^ (ends - starts).astype(np.uint64)
        out.append((starts + off[a], ends - starts, anchor, whole))
    if not out:
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64))]
    starts, count, anchor, whole = (np.concatenate(x) for x in zip(*out))
    return starts, count, anchor & ~np.uint64(1), np.searchsorted(off, starts, side="right") - 1, whole


def _anchors(ids, anchor, doc, buckets):
    """Distinct anchors of a batch, whether two documents hold one, places."""
    keys, place = distinct_keys(anchor, buckets)
    low, high = np.full(len(keys), NO_ID), np.full(len(keys), np.iinfo(np.int64).min)
    np.minimum.at(low, place, ids[doc])
    np.maximum.at(high, place, ids[doc])
    return keys, low < high, place


def _candidates(ids, off, data, found, buckets, parts):
    """The batch's distinct runs with a repeated anchor, in the order of
    (part, anchor, bytes): representative, first and last doc_id, and for
    each occurrence its start, document and distinct run."""
    starts, count, anchor, doc, whole = find_runs(off, data)
    keys, place = distinct_keys(anchor, buckets)
    mine = np.flatnonzero(read_bits(found, keys, buckets)[place])
    order = mine[np.lexsort((whole[mine], count[mine], anchor[mine], bucket_of(anchor[mine], parts)))]
    new = np.ones(len(order), bool)
    new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (whole[order][1:] != whole[order][:-1]) | (count[order][1:] != count[order][:-1])
    run = np.cumsum(new) - 1
    first = order[new]
    # runs that agree in hash and length must agree in bytes
    again = np.flatnonzero(~new)
    for a in range(0, len(again), 1 << 13):
        x, y = order[again[a:a + (1 << 13)]], first[run[again[a:a + (1 << 13)]]]
        size = count[x] + LENGTH - 1
        if not np.array_equal(data[ragged(size, starts[x])], data[ragged(size, starts[y])]):
            raise ValueError("two runs of one hash differ")
    edge = np.flatnonzero(new)
    doc_ids = ids[doc[order]]
    low = np.minimum.reduceat(doc_ids, edge) if len(edge) else doc_ids
    high = np.maximum.reduceat(doc_ids, edge) if len(edge) else doc_ids
    return (starts[first], count[first], anchor[first], low, high), (starts[order], doc[order], run)


def _settle(table: pa.Table) -> pa.Table:
    """A bucket: the smallest doc_id of every string of its runs, as stretches
    (run of the batch, from, to, doc_id) for those that a later doc holds."""
    columns = {c: [np.frombuffer(x.as_buffer(), t) for x in table.column(c)] for c, t in
               (("anchors", np.uint64), ("counts", np.int64), ("low", np.int64), ("high", np.int64), ("text", np.uint8))}
    sizes = np.array([len(x) for x in columns["anchors"]])
    sender = np.repeat(np.arange(len(sizes)), sizes)
    number = np.concatenate([np.arange(n) for n in sizes])
    anchor, count, low, high, text = (np.concatenate(columns[c]) for c in ("anchors", "counts", "low", "high", "text"))
    size = count + LENGTH - 1
    start = np.cumsum(size) - size
    order_ = SuffixOrder(text, LENGTH)
    whole = order_.hashes.span(start, start + size)
    order = np.lexsort((whole, count, anchor))
    new = np.ones(len(order), bool)
    new[1:] = (anchor[order][1:] != anchor[order][:-1]) | (count[order][1:] != count[order][:-1]) | (whole[order][1:] != whole[order][:-1])
    kind_of = np.empty(len(order), np.int64)
    kind_of[order] = np.cumsum(new) - 1
    rep = order[new]
    again = order[~new]
    for a in range(0, len(again), 1 << 13):  # equal hashes, equal bytes
        x = again[a:a + (1 << 13)]
        y = rep[kind_of[x]]
        if not np.array_equal(text[ragged(size[x], start[x])], text[ragged(size[y], start[y])]):
            raise ValueError("two runs of one hash differ")
    kind_low = np.minimum.reduceat(low[order], np.flatnonzero(new)) if len(order) else low
    # anchors with several runs: sort the windows of these
    anchor_edge = np.ones(len(rep), bool)
    anchor_edge[1:] = anchor[rep][1:] != anchor[rep][:-1]
    group = np.cumsum(anchor_edge) - 1
    several = np.bincount(group)[group] > 1 if len(rep) else np.zeros(0, bool)
    many = np.flatnonzero(several)
    windows = count[rep[many]]
    at = ragged(windows, start[rep[many]])
    of_kind, of_group = np.repeat(many, windows), np.repeat(group[many], windows)
    least = kind_low[of_kind]
    if len(at):
        sorted_ = order_.sort(at, of_group)
        equal = order_.equal_neighbours(at, sorted_, of_group)
        cut = np.flatnonzero(np.append(True, ~equal))
        best = np.minimum.reduceat(least[sorted_], cut)
        least[sorted_] = np.repeat(best, np.diff(np.append(cut, len(sorted_))))
    # stretches of one doc_id within a distinct run
    edge = np.ones(len(at), bool)
    edge[1:] = (of_kind[1:] != of_kind[:-1]) | (least[1:] != least[:-1])
    cut = np.flatnonzero(edge)
    run_begin = np.cumsum(windows) - windows
    slot = np.full(len(rep), -1)
    slot[many] = np.arange(len(many))
    piece_kind = np.concatenate([np.flatnonzero(~several), of_kind[cut]])
    piece_from = np.concatenate([np.zeros(len(rep) - len(many), np.int64), cut - run_begin[slot[of_kind[cut]]]])
    length = np.concatenate([count[rep[~several]], np.diff(np.append(cut, len(at)))])
    piece_low = np.concatenate([kind_low[~several], least[cut]])
    by_kind = np.argsort(piece_kind, kind="stable")
    held = np.searchsorted(piece_kind[by_kind], np.arange(len(rep) + 1))
    n = np.diff(held)[kind_of]
    pick = by_kind[ragged(n, held[:-1][kind_of])]
    entry = np.repeat(np.arange(len(kind_of)), n)
    useful = piece_low[pick] < high[entry]
    pick, entry = pick[useful], entry[useful]
    stop = np.searchsorted(sender[entry], np.arange(len(sizes) + 1))
    pack = lambda values, t: pa.array([values[a:b].astype(t).tobytes() for a, b in zip(stop[:-1], stop[1:])], pa.binary())
    return pa.table({"batch": table.column("batch"), "bucket": table.column("bucket"), "run": pack(number[entry], np.int64),
                     "begin": pack(piece_from[pick], np.int64), "count": pack(length[pick], np.int64), "low": pack(piece_low[pick], np.int64)})


RUNS_SCHEMA = "bucket int, batch bigint, anchors binary, counts binary, low binary, high binary, text binary"
SETTLED_SCHEMA = "batch bigint, bucket int, run binary, begin binary, count binary, low binary"
RESULT_SCHEMA = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed
    runs) and ``kept_sha256`` of the remaining bytes, for every row."""
    with scratch_scope(docs.sparkSession):  # only the result stays
        return _remove_repeats(write_batches(docs))


def _remove_repeats(batched: Batches) -> DataFrame:
    buckets, n_parts = batched.buckets, batched.buckets * RUN_PARTS

    def send_anchors(parts):
        for row, ids, off, data in batch_rows(parts):
            _, _, anchor, doc, _ = find_runs(off, data)
            keys, twice, _ = _anchors(ids, anchor, doc, buckets)
            if len(keys):
                yield send_keys(row.column("batch")[0].as_py(), keys, twice, buckets)

    bits = pin(answer_keys(batched.table().mapInArrow(send_anchors, KEYS_SCHEMA)))

    def send_runs(parts):
        for row, ids, off, data in batch_rows(parts):
            (start, count, anchor, low, high), _ = _candidates(ids, off, data, row.column("found0")[0].as_py(), buckets, n_parts)
            if len(anchor) == 0:
                continue
            bucket = bucket_of(anchor, n_parts).astype(np.int32)
            edge = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            stop = np.append(edge[1:], len(bucket))
            size = count + LENGTH - 1
            text = data[ragged(size, start)]
            reach = np.concatenate([[0], np.cumsum(size)])
            cuts = list(zip(edge.tolist(), stop.tolist()))
            values = [pa.array([x[a:b].tobytes() for a, b in cuts], pa.binary()) for x in (anchor, count, low, high)]
            texts = pa.array([text[reach[a]:reach[b]].tobytes() for a, b in cuts], pa.binary())
            batch = pa.array(np.full(len(cuts), row.column("batch")[0].as_py()))
            yield pa.RecordBatch.from_arrays([pa.array(bucket[edge]), batch, *values, texts],
                                             ["bucket", "batch", "anchors", "counts", "low", "high", "text"])

    settled = pin(batched.with_answers(bits).mapInArrow(send_runs, RUNS_SCHEMA).groupBy("bucket").applyInArrow(_settle, SETTLED_SCHEMA))

    def mark(parts):
        for row, ids, off, data in batch_rows(parts):
            (_, _, anchor, _, _), (start, doc, run) = _candidates(ids, off, data, row.column("found0")[0].as_py(), buckets, n_parts)
            bucket = bucket_of(anchor, n_parts)
            run_begin, begin, count, low = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for item in row.column("found1")[0].as_py() or ():
                base = int(np.searchsorted(bucket, item["bucket"]))
                run_begin.append(np.frombuffer(item["run"], np.int64) + base)
                for to, name in ((begin, "begin"), (count, "count"), (low, "low")):
                    to.append(np.frombuffer(item[name], np.int64))
            of_run, begin, count, low = (np.concatenate(x) for x in (run_begin, begin, count, low))
            by_run = np.argsort(of_run, kind="stable")
            held = np.searchsorted(of_run[by_run], np.arange(len(anchor) + 1))
            n = np.diff(held)[run]
            pick, at = by_run[ragged(n, held[:-1][run])], np.repeat(np.arange(len(run)), n)
            hit = low[pick] < ids[doc[at]]
            pick, at = pick[hit], at[hit]
            depth = np.zeros(len(data) + 1, np.int32)
            np.add.at(depth, start[at] + begin[pick], 1)
            np.add.at(depth, start[at] + begin[pick] + count[pick] + LENGTH - 1, -1)
            gone = np.cumsum(depth[:-1]) > 0
            first = gone.copy()
            first[1:] &= ~gone[:-1]
            heads = off[:-1][off[1:] > off[:-1]]
            first[heads] = gone[heads]
            total = np.concatenate([[0], np.cumsum(gone)])
            spans = np.concatenate([[0], np.cumsum(first)])
            sums = [hashlib.sha256(data[a:b][~gone[a:b]].tobytes() if total[b] > total[a] else data[a:b].tobytes()).hexdigest()
                    for a, b in zip(off[:-1].tolist(), off[1:].tolist())]
            nulls = ids == NO_ID
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64(), mask=nulls), pa.array(np.diff(off)), pa.array(np.diff(total[off])),
                 pa.array(np.diff(spans[off])), pa.array(sums, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    out = pin(batched.with_answers(bits, settled).mapInArrow(mark, RESULT_SCHEMA), keep=True)
    batched.drop()
    return out
