"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts become words (runs of letters and digits, lower case). The CGK random
walk reads a window of words: at each step it puts out the word it stands on
and moves on or stays, as a random bit of that word and step says. Windows at
small edit distance put out mostly equal words, so Hamming methods apply: one
repetition samples a few steps of the walk as its key, and the number of
repetitions is raised for each item length by itself until simulated edits of
the benchmark's own items of that length reach ``target``; if they never do,
it is an error. Windows are the largest power of two up to ``MAX_WINDOW`` that
fits into two thirds of the item, and slide over both sides, so that every
item that may be edited has several windows. Every word of a document starts
one: end marks follow its last word.

Documents' windows are walked in one pass, all positions at once, and dropped
as soon as the steps sampled so far match no item. What remains names an item
and a place, and is confirmed by the exact word edit distance of the whole
item to the best stretch of the document around that place: at most
``max_edits`` (a fifth) of the item's words may differ.

The benchmark goes to the tasks in rounds of at most ``round_items`` items.

Defined cases: null texts and items, and items without a word, match nothing;
an item shorter than five words must occur exactly; an empty benchmark leaves
every document clean; repeated rows are judged alike; a long text is
searched whole. Extra columns are kept by ``drop_contaminated`` and ignored by
``contaminated_items``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizing import spread
from .langid import LETTER
from .spans import BASE, BYTE_CODE, STEP, PrefixHash, lookup, mix, small_batches, steps, text_buffer, words

MAX_WINDOW = 16
# The word code of the end marks after every document.
END = np.uint64(0)
MAX_EDITS = 0.2
ROUND_ITEMS = 20_000
TARGET_RECALL = 0.99
# An item length that needs more repetitions than this is an error.
MAX_REPEATS = 256
TRIALS = 400
# Sampled steps per key, by window size.
SAMPLES = {1: 1, 2: 1, 4: 2, 8: 3, 16: 4}
WORD_BYTE = LETTER.copy()
WORD_BYTE[48:58] = True


def word_codes(column) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column, and n + 1 row offsets."""
    data, off = text_buffer(pc.utf8_lower(column))
    codes, counts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for a, b in steps(off, STEP):
        part = data[off[a]:off[b]]
        starts, ends, rows = words(part, off[a:b + 1] - off[a], WORD_BYTE)
        codes.append(mix(PrefixHash(BYTE_CODE[part]).span(starts, ends) + (ends - starts).astype(np.uint64)))
        counts.append(np.diff(rows))
    return np.concatenate(codes), np.cumsum(np.concatenate(counts))


def _fold(key: np.ndarray, code: np.ndarray) -> np.ndarray:
    return mix(key * np.uint64(BASE) + code)


class Repeat:
    """One walk with its sampled steps."""

    def __init__(self, window: int, number: int):
        rng = np.random.default_rng([window, number])
        self.seed = np.uint64(rng.integers(1 << 62))
        picked = SAMPLES[window]
        # the first sample early, so that windows are dropped early
        first = int(rng.integers(0, max(1, window // (2 * picked))))
        rest = first + 1 + rng.permutation(max(window - first - 1, 0))[:picked - 1]
        self.steps = sorted({first, *rest.tolist()})

    def keys(self, codes: np.ndarray, at: np.ndarray, accept=None):
        """Walk from the positions ``at``; (positions, keys) of those whose
        every key so far ``accept(i, key)`` lets pass."""
        bits = mix(codes ^ self.seed)
        here, key = at.copy(), np.zeros(len(at), np.uint64)
        for t in range(self.steps[-1] + 1):
            if t in self.steps:
                key = _fold(key, codes[here])
                if accept is not None:
                    ok = accept(self.steps.index(t), key)
                    at, here, key = at[ok], here[ok], key[ok]
            here = here + ((bits[here] >> np.uint64(t)) & np.uint64(1)).astype(np.int64)
        return at, key


class Benchmark:
    """Items of one round, with the keys of all their windows."""

    def __init__(self, ids: np.ndarray, column, target: float = TARGET_RECALL, max_edits: float = MAX_EDITS):
        codes, off = word_codes(column)
        size = np.diff(off)
        full = np.flatnonzero(size > 0)
        self.ids = ids[full]
        self.items = [codes[off[i]:off[i + 1]] for i in full]
        self.limit = np.array([int(max_edits * len(x)) for x in self.items])
        self.classes = []
        window_of = np.array([_window(len(x), e) for x, e in zip(self.items, self.limit)], np.int64)
        for window in sorted(set(window_of.tolist())):
            members = np.flatnonzero(window_of == window)
            flat, start = _flat([self.items[i] for i in members])
            at, item = _windows(start, window)
            need = self._repeats(window, members, target)[item]
            repeats = []
            for number in range(int(need.max())):
                mine, of = at[need > number], item[need > number]
                walk, levels = Repeat(window, number), []
                _, key = walk.keys(flat, mine, lambda i, k: levels.append(_Members(k)) or np.ones(len(k), bool))
                order = np.argsort(key, kind="stable")
                repeats.append((walk, levels, key[order], members[of[order]], (mine - start[of])[order], mine[order]))
            self.classes.append((window, flat, repeats))

    def _repeats(self, window: int, members: np.ndarray, target: float) -> np.ndarray:
        """For each member the repetitions that find ``target`` of simulated
        copies, with as many random edits as are allowed, of items of its
        length; long items take the number of the shortest of their octave."""
        size = np.array([len(self.items[i]) for i in members])
        octave = 1 << np.maximum(np.log2(size).astype(np.int64), 0)
        kind = np.where(size <= 4 * MAX_WINDOW, size, octave)
        out = np.ones(len(members), np.int64)
        for k in np.unique(kind):
            least = size[kind == k].min()
            if self.limit[members[size == least][0]]:
                out[kind == k] = self._needed(window, members[size == least], target)
        return out

    def _needed(self, window: int, members: np.ndarray, target: float) -> int:
        length = len(self.items[members[0]])
        rng = np.random.default_rng([window, length])
        items, copies = [], []
        for _ in range(TRIALS):
            i = members[rng.integers(len(members))]
            word = [[int(x)] for x in self.items[i]]
            for place in rng.permutation(len(word))[:self.limit[i]]:
                new = int(rng.integers(1 << 62))
                word[place] = ([new], [], [*word[place], new])[rng.integers(3)]
            items.append(self.items[i])
            copies.append(np.array([x for w in word for x in w] + [int(END)] * MAX_WINDOW, np.uint64))
        (flat, start), (other, begin) = _flat(items), _flat(copies)
        (at, of), (to, by) = _windows(start, window), _windows(begin, window)
        found = np.zeros(TRIALS, bool)
        label = mix(np.arange(TRIALS, dtype=np.uint64))
        for number in range(MAX_REPEATS):
            walk = Repeat(window, number)
            at, of, to, by = at[~found[of]], of[~found[of]], to[~found[by]], by[~found[by]]
            x, y = _fold(walk.keys(flat, at)[1], label[of]), _fold(walk.keys(other, to)[1], label[by])
            order = np.argsort(x, kind="stable")
            which, entry = _matches(x[order], y)
            entry = order[entry]
            good = _alike(other, to[which], flat, at[entry], window)
            found[of[entry[good]]] = True
            if found.mean() >= target:
                return number + 1
        raise ValueError(f"{MAX_REPEATS} repetitions find {found.mean():.3f} of the copies of items of {length} words, not {target}")

    def search(self, column) -> list[list[int]]:
        """For each text the sorted ids of the items it holds."""
        codes, off = word_codes(column)
        out: list[set] = [set() for _ in range(len(off) - 1)]
        for a, b in steps(off, 1 << 19):
            self._search(codes[off[a]:off[b]], off[a:b + 1] - off[a], out[a:b])
        return [sorted(x) for x in out]

    def _search(self, codes, off, out) -> None:
        rows, items, places = [], [], []
        row_of = np.repeat(np.arange(len(off) - 1), np.diff(off))
        at = np.arange(len(codes)) + MAX_WINDOW * row_of  # the words between end marks
        marked = np.full(len(codes) + MAX_WINDOW * (len(off) - 1), END)
        marked[at] = codes
        home = np.zeros(len(marked), np.int64)
        home[at] = row_of
        for window, flat, repeats in self.classes:
            for walk, levels, keys, item, offset, begin in repeats:
                place, key = walk.keys(marked, at, lambda i, k: levels[i].has(k))
                which, entry = _matches(keys, key)
                close = _alike(marked, place[which], flat, begin[entry], window)
                which, entry = which[close], entry[close]
                row = home[place[which]]
                rows.append(row)
                items.append(item[entry])
                places.append(place[which] - MAX_WINDOW * row - offset[entry])
        if not rows:
            return
        row, item, place = (np.concatenate(x) for x in (rows, items, places))
        # one candidate for the places that one alignment covers
        slot = place // np.maximum(self.limit[item], 1)
        span = int(slot.max() - slot.min()) + 1 if len(slot) else 1
        _, first = np.unique((row * len(self.items) + item) * span + slot - (slot.min() if len(slot) else 0), return_index=True)
        row, item, place = row[first], item[first], place[first]
        for i in np.unique(item):
            mine = np.flatnonzero(item == i)
            for a in range(0, len(mine), 4096):
                some = mine[a:a + 4096]
                good = self._confirm(i, codes, off, row[some], place[some])
                for r in np.unique(row[some][good]):
                    out[r].add(int(self.ids[i]))

    def _confirm(self, i: int, codes, off, row, place) -> np.ndarray:
        """Whether the item stands around the places with few enough edits."""
        item, limit = self.items[i], int(self.limit[i])
        left, width = place - 2 * limit, len(item) + 4 * limit
        where = left[:, None] + np.arange(width)
        inside = (where >= off[row][:, None]) & (where < off[row + 1][:, None])
        text = np.where(inside, codes[np.clip(where, 0, len(codes) - 1)], np.uint64(0))
        if limit == 0:
            return ((text == item) & inside).all(axis=1)
        # words in common, order aside, must reach the item's size less the edits
        kinds, need = np.unique(item, return_counts=True)
        kind = np.where(inside, lookup(kinds, text.ravel()).reshape(text.shape), -1)
        pair = (np.arange(len(row))[:, None] * len(kinds) + kind)[kind >= 0]
        common = np.bincount(pair, minlength=len(row) * len(kinds)).reshape(len(row), len(kinds))
        good = np.minimum(common, need).sum(axis=1) >= len(item) - limit
        good[good] = self._edits(item, np.where(inside, text, np.uint64(0))[good]) <= limit
        return good

    @staticmethod
    def _edits(item, text) -> np.ndarray:
        """Least edits between the item and any stretch of each row of words."""
        width = text.shape[1]
        cost = np.zeros((len(text), width + 1), np.int32)  # free start
        slope = np.arange(width + 1, dtype=np.int32)
        for n, code in enumerate(item, 1):
            step = np.empty_like(cost)
            step[:, 0] = n
            step[:, 1:] = np.minimum(cost[:, :-1] + (text != code), cost[:, 1:] + 1)
            cost = np.minimum.accumulate(step - slope, axis=1) + slope
        return cost.min(axis=1)


def _window(size: int, edits: int) -> int:
    """The window for items of ``size`` words; one that must occur exactly
    needs no second window."""
    return min(MAX_WINDOW, 1 << ((2 * size // 3 if edits else size).bit_length() - 1))


def _flat(parts: list) -> tuple[np.ndarray, np.ndarray]:
    """The arrays one after the other, and their n + 1 offsets."""
    return np.concatenate(parts), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


def _windows(start: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all windows that lie inside one part, and their parts."""
    at = np.concatenate([np.arange(a, b - window + 1) for a, b in zip(start[:-1], start[1:])])
    return at, np.searchsorted(start, at, side="right") - 1


def _matches(keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every pair of a wanted key and an equal one among the sorted keys."""
    lo, hi = np.searchsorted(keys, wanted), np.searchsorted(keys, wanted, side="right")
    count = hi - lo
    which = np.repeat(np.arange(len(wanted)), count)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(lo, count)


def _alike(codes, at, other, begin, window: int, chunk: int = 1 << 13) -> np.ndarray:
    """Whether more than half of a window's words stand in the other window;
    a candidate fails where most of its edits crowd, and passes elsewhere."""
    out = np.ones(len(at), bool)
    if window < 8:
        return out
    span = np.arange(window)
    for a in range(0, len(at), chunk):
        x, y = codes[at[a:a + chunk, None] + span], other[begin[a:a + chunk, None] + span]
        out[a:a + chunk] = (x[:, :, None] == y[:, None, :]).any(axis=2).sum(axis=1) > window // 2
    return out


class _Members:
    """A set of keys: a bitmap look-up first, then the sorted keys."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        size = max(12, min(24, int(len(self.keys)).bit_length() + 5))
        self.mask = np.uint64((1 << size) - 1)
        self.bitmap = np.zeros(1 << size, bool)
        self.bitmap[self.keys & self.mask] = True

    def has(self, keys: np.ndarray) -> np.ndarray:
        out = self.bitmap[keys & self.mask]
        maybe = np.flatnonzero(out)
        out[maybe] = lookup(self.keys, keys[maybe]) >= 0
        return out


def benchmark_rounds(items: DataFrame, round_items: int = ROUND_ITEMS):
    """Broadcast ``Benchmark`` parts of ``item_id`` and ``text``, one after
    the other; each holds about ``round_items`` items at most."""
    usable = items.select("item_id", "text").where("item_id is not null and text is not null")
    rounds = -(-usable.count() // round_items)
    place = F.pmod(F.xxhash64("item_id"), F.lit(max(rounds, 1)))
    for r in range(rounds):
        table = usable.where(place == r).orderBy("item_id").toArrow()
        if table.num_rows:
            part = Benchmark(table.column("item_id").to_numpy(), table.column("text").combine_chunks().cast(pa.string()))
            yield items.sparkSession.sparkContext.broadcast(part)


def contaminated_items(docs: DataFrame, items: DataFrame, round_items: int = ROUND_ITEMS) -> DataFrame:
    """``doc_id`` and ``item_ids`` (ascending, empty for clean rows)."""
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = spread(docs.select("doc_id", "text")).withColumn("item_ids", F.array().cast("array<bigint>"))

    def search(shared):
        def run(parts):
            for part in small_batches(parts):
                found = shared.value.search(part.column("text"))
                known = part.column("item_ids").to_pylist()
                merged = pa.array([sorted({*x, *y}) for x, y in zip(known, found)], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text"), merged], ["doc_id", "text", "item_ids"])
        return run

    for shared in benchmark_rounds(items, round_items):
        rows = rows.mapInArrow(search(shared), f"doc_id {id_type}, text string, item_ids array<bigint>")
    return rows.select("doc_id", "item_ids")


def drop_contaminated(docs: DataFrame, items: DataFrame, round_items: int = ROUND_ITEMS) -> DataFrame:
    """The rows of ``docs``, all columns, that hold no item."""

    def search(shared):
        def run(parts):
            for part in small_batches(parts):
                found = shared.value.search(part.column("text"))
                yield part.filter(pa.array([not x for x in found], pa.bool_()))
        return run

    rows = spread(docs)
    for shared in benchmark_rounds(items, round_items):
        rows = rows.mapInArrow(search(shared), docs.schema)
    return rows
