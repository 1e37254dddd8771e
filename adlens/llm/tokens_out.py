"""Token ids in Re-Pair compressed shard files.

Documents are ranged and sorted by doc_id, encoded, closed by an end id, and
written in shards. In each shard frequent neighbouring id pairs are replaced
by new symbols, round after round over the shortened sequence; many pairs are
replaced at once in a round, where they overlap the more frequent first. The
end id is never part of a pair, so every document starts at a symbol.

A shard file holds, little-endian: ``MAGIC``, five unsigned 64-bit numbers
(shard number, documents, rules, symbols, first rule's symbol), the doc_ids
(int64), one byte per document that is 1 for a null doc_id, the symbol
offsets (int64, documents + 1), the ids per document (int64), the rules (two
unsigned 16-bit symbols each), the rules' expansion lengths (unsigned
32-bit), the symbols (unsigned 16-bit) and a line feed. ``Shard.document``
decodes one document without the others.

Encoding by distinct piece: a byte-level BPE never joins a word to the space
after it, to punctuation after it or to a single line feed between two other
characters, so texts are cut there and the pieces encode alone as they do in
the text. Each distinct piece is encoded once, many in one call, and ids are
told apart by the tokens' byte lengths. A Python worker remembers pieces from
one task to the next.

Defined cases: a null or empty text is the end id alone; a null doc_id sorts
first; rows of one doc_id are ordered by text; an empty table writes no
document. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
import sys
import types
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.sizing import bounded_broadcast, pin
from .spans import BYTE_CODE, PrefixHash, batches, lookup, mix, ragged, steps, text_buffer

MAGIC = b"IDPAIRS1"
END_ID = 0
SHARD_TOKENS = 1 << 20
ROUNDS = 4
MIN_COUNT = 8
SYMBOLS = 1 << 16
# Bytes encoded per step, texts of one library call, and pieces that a worker
# remembers before it starts anew.
ENCODE_BYTES = 1 << 20
CALL_BYTES, CALL_TEXTS = 1 << 15, 8
REMEMBERED = 1_500_000
# Bytes that a piece may end in or begin with. White space beyond ASCII has
# the lead bytes C2 and E1 to E3, so those are left out on both sides.
HARD = np.ones(256, bool)
HARD[:33] = HARD[127] = False
AFTER = HARD.copy()
AFTER[[0xC2, 0xE1, 0xE2, 0xE3]] = False
ASCII_HARD = HARD.copy()
ASCII_HARD[128:] = False
TWO_BYTE_LEAD = np.zeros(256, bool)
TWO_BYTE_LEAD[0xC3:0xE0] = True
ASCII_LETTER = np.zeros(256, bool)
ASCII_LETTER[65:91] = ASCII_LETTER[97:123] = True
# Punctuation after which a word ends for good: no apostrophe, which may begin
# a contraction, and no sign that the special token is spelled with.
MARK = np.zeros(256, bool)
MARK[[ord(c) for c in "!\"#$%&()*+,-./:;=?@[\\]^_`{}~"]] = True


def worker_memory(kind: str, key: str, make):
    """``make()`` once per Python worker process for each kind and key; the
    module that holds it lives as long as the process."""
    home = sys.modules.setdefault("adlens_worker_memory", types.ModuleType("adlens_worker_memory"))
    kept = home.__dict__.setdefault(kind, {})
    if key not in kept:
        kept[key] = make()
    return kept[key]


class Remembered:
    """Ids of pieces by hash: a large sorted part, and a small one of the
    latest pieces that joins it when it has grown."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.parts = [none, none]
        self.ids, self.off = np.zeros(0, np.uint16), np.zeros(1, np.int64)

    def find(self, codes: np.ndarray) -> np.ndarray:
        """Number of each remembered piece, -1 for the others."""
        out = np.full(len(codes), -1)
        for keys, numbers in self.parts:
            at = lookup(keys, codes)
            out[at >= 0] = numbers[at[at >= 0]]
        return out

    def add(self, codes: np.ndarray, ids: np.ndarray, off: np.ndarray) -> None:
        first = len(self.off) - 1
        self.ids = np.concatenate([self.ids, ids.astype(np.uint16)])
        self.off = np.concatenate([self.off, off[1:] + self.off[-1]])
        (old, old_numbers), (new, new_numbers) = self.parts
        keys, numbers = np.append(new, codes), np.append(new_numbers, first + np.arange(len(codes)))
        if 4 * len(keys) > len(old):
            keys, numbers = np.append(old, keys), np.append(old_numbers, numbers)
            old, old_numbers = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        order = np.argsort(keys)
        part = keys[order], numbers[order]
        self.parts = [(old, old_numbers), part] if len(old) else [part, (old, old_numbers)]


class PieceEncoder:
    """Ids of many texts, each distinct piece encoded once."""

    def __init__(self, tokenizer_json: str):
        from tokenizers import Tokenizer
        key = hashlib.sha1(tokenizer_json.encode()).hexdigest()
        self.tokenizer = worker_memory("tokenizers", key, lambda: Tokenizer.from_str(tokenizer_json))
        self.known = worker_memory("pieces", key, Remembered)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.size = max(vocab.values()) + 1
        self.length = np.zeros(self.size, np.int64)
        for token, i in vocab.items():
            self.length[i] = len(token)

    def encode(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, ``END_ID`` after each row, and the ids per row."""
        first, row_starts = self._pieces(data, off)
        ends = np.append(first[1:], len(data))
        codes = mix(PrefixHash(BYTE_CODE[data]).span(first, ends) + (ends - first).astype(np.uint64))
        distinct, at, which = np.unique(codes, return_index=True, return_inverse=True)
        if len(self.known.off) > REMEMBERED:
            self.known.clear()
        place = self.known.find(distinct)
        new = np.flatnonzero(place < 0)
        if len(new):
            place[new] = len(self.known.off) - 1 + np.arange(len(new))
            self.known.add(distinct[new], *self._distinct(data, first[at[new]], ends[at[new]]))
        # the end id is one more piece, after the last of each row
        id_off = np.append(self.known.off, len(self.known.ids) + 1)
        which = np.insert(place[which], row_starts[1:], len(id_off) - 2)
        size = id_off[which + 1] - id_off[which]
        out = np.append(self.known.ids, np.uint16(END_ID))[ragged(size, id_off[which])]
        bounds = np.concatenate([[0], np.cumsum(size)])[row_starts + np.arange(len(row_starts))]
        return out, np.diff(bounds)

    @staticmethod
    def _hard_end(data, last):
        """Whether the character that ends at ``last`` is surely no space."""
        return ASCII_HARD[data[last]] | ((data[last] >= 128) & TWO_BYTE_LEAD[data[np.maximum(last - 1, 0)]])

    def _pieces(self, data, off):
        """Start of each piece, and the index of each row's first piece."""
        cut = np.zeros(len(data) + 1, bool)
        for sign, after in ((32, False), (10, True)):
            at = np.flatnonzero(data == sign)
            at = at[(at > 0) & (at < len(data) - 1)]
            at = at[AFTER[data[at + 1]] & self._hard_end(data, at - 1)]
            cut[at] = True
            if after:
                cut[at + 1] = True
        if len(data):
            cut[1:-1] |= ASCII_LETTER[data[:-1]] & MARK[data[1:]]
        # a sign at the edge of a row has no neighbour there: only the row's own cut
        edge = np.concatenate([off[:-1], off[1:] - 1])
        cut[edge[(edge >= 0) & (edge < len(data))]] &= False
        edge = off[:-1][off[1:] > off[:-1]]
        inner = edge[off[1:][off[1:] > off[:-1]] - edge > 1] + 1
        cut[inner] &= ~np.isin(data[inner - 1], (32, 10))
        cut[off[:-1]] = True
        cut[len(data)] = False
        first = np.flatnonzero(cut)
        return first, np.searchsorted(first, off)

    def _distinct(self, data, starts, ends):
        """Ids of the spans, and n + 1 offsets."""
        n, size = len(starts), ends - starts
        spaced = (data[starts] == 32) & (size > 1)
        begin = np.where(spaced, np.minimum(starts + 1, len(data) - 1), starts)
        plain = AFTER[data[begin]] & self._hard_end(data, ends - 1) & (ends - begin > (data[ends - 1] >= 128))
        counts, parts, order = np.zeros(n, np.int64), [], []
        # pieces with a space in front follow one another, bare ones take a line feed between
        for members, gap in ((np.flatnonzero(plain & spaced), 0), (np.flatnonzero(plain & ~spaced), 1)):
            bound = np.concatenate([[0], np.cumsum(size[members] + gap)])
            groups = list(steps(bound, CALL_BYTES))
            for call in range(0, len(groups), CALL_TEXTS):
                some = groups[call:call + CALL_TEXTS]
                texts = [self._joined(data, starts[members[a:b]], size[members[a:b]], gap) for a, b in some]
                for (a, b), made in zip(some, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
                    ids = np.array(made.ids, np.int64)
                    reach = np.cumsum(self.length[ids])
                    goal = bound[a + 1:b + 1] - bound[a] - gap
                    stops = np.searchsorted(reach, goal)
                    if stops[-1] >= len(ids) or not np.array_equal(reach[stops], goal):
                        raise ValueError("a token crosses the end of a piece")
                    begins = np.concatenate([[0], stops[:-1] + 1 + gap])
                    counts[members[a:b]] = stops + 1 - begins
                    parts.append(ids[ragged(stops + 1 - begins, begins)])
            order.append(members)
        alone = np.flatnonzero(~plain)
        for call in range(0, len(alone), 256):
            some = alone[call:call + 256]
            singles = [data[starts[i]:ends[i]].tobytes().decode() for i in some]
            for i, made in zip(some, self.tokenizer.encode_batch_fast(singles, add_special_tokens=False)):
                parts.append(np.array(made.ids, np.int64))
                counts[i] = len(parts[-1])
        flat = np.concatenate([np.zeros(0, np.int64), *parts])
        order = np.concatenate([*order, alone])
        held = np.zeros(n, np.int64)
        held[order] = np.cumsum(counts[order]) - counts[order]
        return flat[ragged(counts, held)], np.concatenate([[0], np.cumsum(counts)])

    @staticmethod
    def _joined(data, starts, size, gap: int) -> str:
        raw = np.append(data, np.uint8(10))[ragged(size + gap, starts)]
        if gap:
            raw[np.cumsum(size + 1) - 1] = 10
            raw = raw[:-1]
        return raw.tobytes().decode()


def compress(ids: np.ndarray, vocab: int, rounds: int = ROUNDS, min_count: int = MIN_COUNT):
    """Symbols, rules (pairs) and expansion lengths of one shard."""
    seq = ids.astype(np.uint32)
    rules, room = [], SYMBOLS - vocab
    table = np.zeros(1 << 20, np.int32)
    for r in range(rounds):
        if len(seq) < 2 or room <= 0:
            break
        key = (seq[:-1] << np.uint32(16)) | seq[1:]
        open_ = (seq[:-1] != END_ID) & (seq[1:] != END_ID)
        ordered = np.sort(key[open_])
        edge = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1])) if len(ordered) else np.zeros(0, np.int64)
        count = np.diff(np.append(edge, len(ordered)))
        pairs = ordered[edge]
        often = np.flatnonzero(count >= min_count)
        take = often[np.lexsort((pairs[often], -count[often]))][:-(-room // (rounds - r))]
        if len(take) == 0:
            break
        chosen = pairs[take]
        slot = ((chosen * np.uint32(0x9E3779B1)) >> np.uint32(12)).astype(np.int64)
        _, free = np.unique(slot, return_index=True)  # the more frequent of two in one slot
        chosen, slot = chosen[np.sort(free)], slot[np.sort(free)]
        table[:] = 0
        table[slot] = np.arange(1, len(chosen) + 1)
        found = table[(key * np.uint32(0x9E3779B1)) >> np.uint32(12)]
        rank = np.where((found > 0) & (chosen[found - 1] == key), found, np.int32(len(chosen) + 1))
        # a pair is replaced where it is more frequent than both overlapping ones
        here = rank <= len(chosen)
        here[1:] &= rank[1:] < rank[:-1]
        here[:-1] &= rank[:-1] <= rank[1:]
        at = np.flatnonzero(here)
        seq[at] = vocab + len(rules) + rank[at] - 1
        stays = np.ones(len(seq), bool)
        stays[at + 1] = False
        seq = seq[stays]
        rules.extend(zip((chosen >> np.uint32(16)).tolist(), (chosen & np.uint32(0xFFFF)).tolist()))
        room = SYMBOLS - vocab - len(rules)
    pairs = np.array(rules, np.uint16).reshape(-1, 2)
    return seq.astype(np.uint16), pairs, _lengths(pairs, vocab)


def _lengths(pairs: np.ndarray, vocab: int) -> np.ndarray:
    length = np.ones(vocab + len(pairs), np.uint32)
    for i, (a, b) in enumerate(pairs.tolist()):
        length[vocab + i] = length[a] + length[b]
    return length[vocab:]


def shard_file(number: int, doc_ids, ids: np.ndarray, counts: np.ndarray, vocab: int) -> bytes:
    """One shard without its last byte. ``doc_ids`` may hold None."""
    seq, pairs, lengths = compress(ids, vocab)
    all_lengths = np.concatenate([np.ones(vocab, np.int64), lengths.astype(np.int64)])
    reach = np.concatenate([[0], np.cumsum(all_lengths[seq])])
    offsets = np.searchsorted(reach, np.concatenate([[0], np.cumsum(counts)]))
    null = np.array([d is None for d in doc_ids], np.uint8)
    return b"".join([MAGIC, struct.pack("<5Q", number, len(doc_ids), len(pairs), len(seq), vocab),
                     np.array([d or 0 for d in doc_ids], "<i8").tobytes(), null.tobytes(), offsets.astype("<i8").tobytes(),
                     counts.astype("<i8").tobytes(), pairs.astype("<u2").tobytes(), lengths.astype("<u4").tobytes(),
                     seq.astype("<u2").tobytes()])


class Shard:
    """A shard file's parts; documents decode one by one or all together."""

    def __init__(self, raw: bytes):
        if raw[:8] != MAGIC or raw[-1:] != b"\n":
            raise ValueError("not a shard file")
        self.number, n, n_rules, n_symbols, self.vocab = struct.unpack_from("<5Q", raw, 8)
        at = 48

        def part(kind, count):
            nonlocal at
            out = np.frombuffer(raw, kind, count, at)
            at += out.nbytes
            return out

        ids, null = part("<i8", n), part("u1", n)
        self.doc_ids = [None if z else d for d, z in zip(ids.tolist(), null.tolist())]
        self.offsets, self.counts = part("<i8", n + 1), part("<i8", n)
        self.rules = part("<u2", 2 * n_rules).reshape(-1, 2)
        self.lengths, self.symbols = part("<u4", n_rules).astype(np.int64), part("<u2", n_symbols)
        # every symbol's expansion, in one array
        size = np.concatenate([np.ones(self.vocab, np.int64), self.lengths])
        self.start = np.cumsum(size) - size
        self.size, self.flat = size, np.zeros(int(size.sum()), np.uint32)
        self.flat[:self.vocab] = np.arange(self.vocab)
        for i, (a, b) in enumerate(self.rules.tolist()):
            to, middle = self.start[self.vocab + i], self.start[self.vocab + i] + size[a]
            self.flat[to:middle] = self.flat[self.start[a]:self.start[a] + size[a]]
            self.flat[middle:middle + size[b]] = self.flat[self.start[b]:self.start[b] + size[b]]

    def expand(self, symbols: np.ndarray) -> np.ndarray:
        return self.flat[ragged(self.size[symbols], self.start[symbols])]

    def document(self, i: int) -> np.ndarray:
        return self.expand(self.symbols[self.offsets[i]:self.offsets[i + 1]])


def write_shards(docs: DataFrame, path: str, tokenizer_json: str, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode ``doc_id`` and ``text`` of every row and write the shard files."""

    def run(parts):
        encoder, made = PieceEncoder(tokenizer_json), 0
        held: list = []

        def close():
            nonlocal made, held
            number = (TaskContext.get().partitionId() << 24) + made
            file = shard_file(number, [d for h in held for d in h[0]], np.concatenate([h[1] for h in held]),
                              np.concatenate([h[2] for h in held]), encoder.size)
            held, made = [], made + 1
            return pa.RecordBatch.from_arrays([pa.array([file], pa.binary())], ["file"])

        for part in batches(parts):
            data, off = text_buffer(part.column("text"))
            doc_ids = part.column("doc_id").to_pylist()
            for a, b in steps(off, ENCODE_BYTES):
                ids, counts = encoder.encode(data[off[a]:off[b]], off[a:b + 1] - off[a])
                held.append((doc_ids[a:b], ids.astype(np.uint16), counts))
                if sum(len(h[1]) for h in held) >= shard_tokens:
                    yield close()
        if held:
            yield close()

    rows = docs.select("doc_id", "text")
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", "text").mapInArrow(run, "file binary")
    files.select(F.col("file").cast("string")).write.option("maxRecordsPerFile", 1).option("compression", "none").text(path)


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` of every document of
    the shard files; offsets across shards come from one row per shard."""

    def run(parts):
        for part in batches(parts):
            for file in part.column("content"):
                shard = Shard(file.as_py())
                ids = shard.expand(shard.symbols).astype("<u4")
                ends = np.cumsum(shard.counts)
                raw = memoryview(ids.view(np.uint8))
                sums = [zlib.crc32(raw[4 * (e - c):4 * e]) for e, c in zip(ends.tolist(), shard.counts.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shard.number] * len(sums), pa.int64()), pa.array(shard.doc_ids, pa.int64()),
                     pa.array(ends - shard.counts), pa.array(shard.counts), pa.array(sums, pa.int64())],
                    ["shard", "doc_id", "within", "n_tokens", "ids_crc32"])

    files = spark.read.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").load(path)
    rows = pin(files.select("content").mapInArrow(run, "shard bigint, doc_id bigint, within bigint, n_tokens bigint, ids_crc32 bigint"))
    per = rows.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.partitionBy().orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    starts = bounded_broadcast(pin(per.select("shard", F.coalesce(before, F.lit(0)).alias("before"))))
    return rows.join(starts, "shard").select("doc_id", (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def load_tokenizer(path: str) -> str:
    """The tokenizer file as one string, checked for its symbols to fit."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    json.loads(text)
    return text
