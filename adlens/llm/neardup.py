"""Near-duplicate groups by an LSH forest of MinHash signatures.

A document's set holds its distinct five-word shingles. Documents with equal
sets form one class, found by an aggregation on a fingerprint of the set, so
copies of any number cost one row per task. Each class representative has a
MinHash signature; a tree is one order of the signature's columns, by which its
rows are sorted. The rows with the same ``DEPTH`` leading columns are a region
of the tree.

First each row meets, in ``FIRST_TREES`` trees, only the row after it if that
is of its region: its neighbour by longest common prefix. So a family of near
copies of any size makes a few pairs per member, and once these are confirmed
and joined, most of it is one component. Then, in all trees, the rows of a
region meet that lie in different components: in a region of at most
``NEIGHBOURS`` rows, which is never cut between tasks, all of them; a larger
one is split over tasks in the order of its further columns, and each row meets
the ``HOT_NEIGHBOURS`` that follow it in every tree. Once these are confirmed and joined, the
large regions that still hold more
than one component are settled by a prefix-filtered join of the shingles: rare
shingles first, a pair that reaches the similarity shares a shingle among the
first few of both sets, at places that leave room for enough others. Only
pairs between components come out of that join, so a large family of near
copies adds none, nor does one whose members all lie under the similarity.

Candidates whose set sizes or sketches (two bits of each of ``SKETCHED``
minima) rule out the similarity are dropped at once; the others are confirmed
on full sets. Pairs inside a component add nothing to the result and are never
made, so a group of near copies costs about as many comparisons as it has
members, not pairs.

Each tree of ``DEPTH`` columns finds a pair of similarity s with probability
s^DEPTH; with 24 trees of 5 columns a pair at 0.85 meets in no tree once in a
million. Sets are compared by 64-bit hashes of their shingles.

Defined cases: null or blank texts have an empty set and no links; texts of
fewer than five words have their whole word sequence as the one shingle;
repeated rows of one doc_id are one document, all kept or none; rows with a
null doc_id take no part in links unless their set equals another's; an empty
table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.sizing import bounded_broadcast, pin, spread
from ..session import scratch_scope
from .components import components
from .spans import (BASE, BYTE_CODE, STEP, PrefixHash, batches, mix, small_batches, steps, text_buffer, words)

SHINGLE = 5
TREES, DEPTH, COLUMNS = 24, 5, 10
HASHES, SKETCHED = 128, 256
NEIGHBOURS = 32
# Followers a row meets in a larger region, in every tree.
HOT_NEIGHBOURS = 4
# Trees of the first round, in which a row meets its next neighbour only.
FIRST_TREES = 8
# Standard deviations below the expected agreement at which a sketch rules out.
SLACK = 4.0
BROADCAST_ROWS = 200_000
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# Zero pairs of bits of a byte.
EQUAL = np.array([sum(i >> k & 3 == 0 for k in (0, 2, 4, 6)) for i in range(256)], np.uint8)
_SEEDS = mix(np.arange(1, 2 * SKETCHED + 1, dtype=np.uint64) * np.uint64(BASE))
MULTIPLY, ADD = _SEEDS[:SKETCHED] | np.uint64(1), _SEEDS[SKETCHED:]


def shingle_sets(data: np.ndarray, off: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Row and hash of each row's distinct shingles, sorted by both."""
    rows_out, codes_out = [], []
    for a, b in steps(off, STEP):
        part = LOWER[data[off[a]:off[b]]]
        starts, ends, first = words(part, off[a:b + 1] - off[a])
        hashes = PrefixHash(BYTE_CODE[part])
        word = mix(hashes.span(starts, ends) + (ends - starts).astype(np.uint64))
        chain = PrefixHash(word)
        count = np.diff(first)
        begin = np.arange(len(word))
        row = np.repeat(np.arange(b - a), count)
        full = begin + size <= first[1:][row] if len(row) else np.zeros(0, bool)
        short = np.flatnonzero((count > 0) & (count < size))
        code = np.concatenate([mix(chain.span(begin[full], begin[full] + size)),
                               mix(chain.span(first[:-1][short], first[1:][short]) + count[short].astype(np.uint64) + np.uint64(1))])
        row = np.concatenate([row[full], short])
        order = np.lexsort((code, row))
        row, code = row[order], code[order]
        new = np.ones(len(row), bool)
        new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
        rows_out.append(row[new] + a)
        codes_out.append(code[new])
    if not rows_out:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return np.concatenate(rows_out), np.concatenate(codes_out)


def signatures(row: np.ndarray, code: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """``n`` rows of ``HASHES`` 16-bit minima (zeros for empty sets), and the
    packed sketches of all ``SKETCHED`` minima."""
    out, sketch = np.zeros((n, HASHES), np.uint16), np.zeros((n, SKETCHED // 4), np.uint8)
    if len(row) == 0:
        return out, sketch
    edge = np.flatnonzero(np.append(True, row[1:] != row[:-1]))
    present = row[edge]
    for a in range(0, len(edge), 512):  # rows whose hashes stay in the cache
        lo = edge[a]
        hi = edge[a + 512] if a + 512 < len(edge) else len(row)
        cuts, x = edge[a:a + 512] - lo, code[lo:hi]
        to = present[a:a + 512]
        for j in range(SKETCHED):
            low = mix(np.minimum.reduceat(x * MULTIPLY[j] + ADD[j], cuts))
            if j < HASHES:
                out[to, j] = (low >> np.uint64(48)).astype(np.uint16)
            sketch[to, j // 4] |= ((low & np.uint64(3)) << np.uint64(2 * (j % 4))).astype(np.uint8)
    return out, sketch


def documents_sets(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``n_shingles``, a 128-bit fingerprint of the set (``f1``,
    ``f2``), the packed signature and the sketch of every row."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def run(parts):
        for part in small_batches(parts):
            data, off = text_buffer(part.column("text"))
            n = len(off) - 1
            row, code = shingle_sets(data, off)
            count = np.bincount(row, minlength=n)
            total = lambda x: (lambda c: c[np.cumsum(count)] - c[np.cumsum(count) - count])(
                np.concatenate([[np.uint64(0)], np.cumsum(x, dtype=np.uint64)]))
            f1, f2 = total(mix(code)), total(mix(code ^ np.uint64(BASE)))
            least, sketch = signatures(row, code, n)
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), pa.array(count), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)),
                 _fixed(least.tobytes(), 2 * HASHES, n), _fixed(sketch.tobytes(), SKETCHED // 4, n)],
                ["doc_id", "n_shingles", "f1", "f2", "signature", "sketch"])

    return spread(docs.select("doc_id", "text")).mapInArrow(run, f"doc_id {id_type}, n_shingles bigint, f1 bigint, f2 bigint, signature binary, sketch binary")


def tree_columns(tree: int) -> np.ndarray:
    """The signature columns of a tree: its own ``DEPTH`` first, then others."""
    rest = np.random.default_rng(tree).permutation(HASHES)
    own = np.arange(tree * DEPTH, (tree + 1) * DEPTH)
    return np.concatenate([own, rest[~np.isin(rest, own)][:COLUMNS - DEPTH]])


def _signature(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(len(column), HASHES)


def _region(sig: np.ndarray, tree: int) -> np.ndarray:
    """One number for a tree and the leading columns of each signature."""
    out = np.full(len(sig), mix(np.array([tree + 1], np.uint64))[0])
    for k in tree_columns(tree)[:DEPTH]:
        out = mix(out * np.uint64(BASE) + sig[:, k].astype(np.uint64))
    return out.view(np.int64)


def regions(sets: DataFrame) -> DataFrame:
    """``region`` and ``doc_id``: a row for every document and tree."""

    def run(parts):
        for part in batches(parts):
            sig = _signature(part.column("signature"))
            for t in range(TREES):
                yield pa.RecordBatch.from_arrays([pa.array(_region(sig, t)), part.column("doc_id")], ["region", "doc_id"])

    return sets.select("doc_id", "signature").mapInArrow(run, "region bigint, doc_id bigint")


def _least_agreement(num: int, den: int) -> float:
    """The agreement of two sketches under which num / den is ruled out."""
    expected = num / den + (1 - num / den) / 4
    return SKETCHED * expected - SLACK * (SKETCHED * expected * (1 - expected)) ** 0.5


def candidate_pairs(sets: DataFrame, hot: DataFrame, num: int, den: int, label: DataFrame | None = None,
                    trees: int = TREES, neighbours: int = NEIGHBOURS) -> DataFrame:
    """Distinct ``a``, ``b`` of different components (``label``) that share a
    region of one of the ``trees`` and may reach similarity num / den, with the
    ``agreement`` of their sketches: each row with the ``neighbours`` rows that
    follow it in its region, so in regions of at most that many all pairs. In
    the ``hot`` regions, which are split over tasks, with ``HOT_NEIGHBOURS``."""
    least = _least_agreement(num, den)
    own = F.col("doc_id").alias("component")
    if label is not None:
        sets = sets.join(bounded_broadcast(label.select(F.col("node").alias("doc_id"), "component"), BROADCAST_ROWS), "doc_id", "left")
        own = F.coalesce("component", "doc_id").alias("component")

    def grow(parts):
        for part in batches(parts):
            n = part.num_rows
            sig = _signature(part.column("signature"))
            for t in range(trees):
                key = np.ascontiguousarray(sig[:, tree_columns(t)[DEPTH:]]).astype(">u2")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_region(sig, t)), _fixed(key.tobytes(), 2 * (COLUMNS - DEPTH), n), part.column("doc_id"),
                     part.column("n_shingles").cast(pa.int32()), part.column("sketch"), part.column("component")],
                    ["region", "key", "doc_id", "n", "sketch", "component"])

    def near(parts):
        held = None
        for part in batches(parts):
            n = part.num_rows
            now = (part.column("region").to_numpy(), part.column("doc_id").to_numpy(), part.column("n").to_numpy().astype(np.int64),
                   np.frombuffer(b"".join(part.column("sketch").to_pylist()), np.uint8).reshape(n, -1), part.column("component").to_numpy(),
                   part.column("hot").to_numpy(zero_copy_only=False))
            fresh = 0 if held is None else len(held[0])
            region, ids, size, sketch, group, crowd = now if held is None else tuple(np.concatenate(x) for x in zip(held, now))
            i_out, j_out, agree_out = [], [], []
            for step in range(1, min(neighbours, len(region) - 1) + 1):
                i = np.flatnonzero(region[step:] == region[:-step])
                if len(i) == 0:
                    break
                j = i + step
                i, j = i[j >= fresh], j[j >= fresh]
                if step > HOT_NEIGHBOURS:   # the rest of a hot region is for the shingle join
                    few = ~crowd[i]
                    i, j = i[few], j[few]
                ok = (group[i] != group[j]) & (np.minimum(size[i], size[j]) * den >= np.maximum(size[i], size[j]) * num)
                i, j = i[ok], j[ok]
                agree = EQUAL[sketch[i] ^ sketch[j]].sum(axis=1)
                ok = agree >= least
                i_out.append(i[ok])
                j_out.append(j[ok])
                agree_out.append(agree[ok])
            if i_out:  # one row for each document and its candidates
                i, j, agree = (np.concatenate(x) for x in (i_out, j_out, agree_out))
                order = np.argsort(i, kind="stable")
                i, j, agree = i[order], j[order], agree[order]
                edge = np.flatnonzero(np.append(True, i[1:] != i[:-1])) if len(i) else np.zeros(0, np.int64)
                off = pa.array(np.append(edge, len(i)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[i[edge]]), pa.ListArray.from_arrays(off, pa.array(ids[j])), pa.ListArray.from_arrays(off, pa.array(agree, pa.int32()))],
                    ["a", "b", "agreement"])
            held = tuple(x[-neighbours:] for x in (region, ids, size, sketch, group, crowd))

    parts = int(sets.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = sets.select("doc_id", "n_shingles", "signature", "sketch", own).mapInArrow(
        grow, "region bigint, key binary, doc_id bigint, n int, sketch binary, component bigint")
    # only a hot region's rows differ in the columns that cut the ranges
    marked = rows.join(bounded_broadcast(hot, BROADCAST_ROWS).withColumn("hot", F.lit(True)), "region", "left")
    ordered = marked.repartitionByRange(parts, "region", F.when(F.col("hot"), F.col("key")), F.when(F.col("hot"), F.col("doc_id"))).select(
        "region", "key", "doc_id", "n", "sketch", "component", F.coalesce("hot", F.lit(False)).alias("hot")).sortWithinPartitions("region", "key", "doc_id")
    lists = ordered.mapInArrow(near, "a bigint, b array<bigint>, agreement array<int>")
    per = lists.groupBy("a").agg(F.array_distinct(F.flatten(F.collect_list(F.arrays_zip("b", "agreement")))).alias("found"))
    pairs = per.select("a", F.explode("found").alias("x")).where("a <> x.b")
    return pairs.select(F.least("a", "x.b").alias("a"), F.greatest("a", "x.b").alias("b"), "x.agreement").distinct()


def _fixed(raw: bytes, width: int, n: int) -> pa.Array:
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(width), n, [None, pa.py_buffer(raw)]).cast(pa.binary())


def confirm(pairs: DataFrame, texts: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``a``, ``b`` whose full sets reach num / den; ``texts`` has
    one row per doc_id."""

    def run(parts):
        for part in small_batches(parts, ("text_a", "text_b")):
            n = part.num_rows
            (ra, ca), (rb, cb) = (shingle_sets(*text_buffer(part.column(c))) for c in ("text_a", "text_b"))
            row, code = np.concatenate([ra, rb]), np.concatenate([ca, cb])
            order = np.lexsort((code, row))
            row, code = row[order], code[order]
            twice = (row[1:] == row[:-1]) & (code[1:] == code[:-1])
            common = np.bincount(row[1:][twice], minlength=n)
            union = np.bincount(ra, minlength=n) + np.bincount(rb, minlength=n) - common
            yield part.select(["a", "b"]).filter(pa.array((common > 0) & (common * den >= union * num)))

    with_a = pairs.join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    both = with_a.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    return both.select("a", "text_a", "b", "text_b").mapInArrow(run, "a bigint, b bigint")


def unsettled(sets: DataFrame, hot: DataFrame, label: DataFrame) -> DataFrame:
    """``doc_id`` and ``component`` of the rows of those hot regions that hold
    more than one component."""
    inside = regions(sets).join(bounded_broadcast(hot, BROADCAST_ROWS), "region")
    named = pin(inside.join(label.withColumnRenamed("node", "doc_id"), "doc_id", "left")
                .select("region", "doc_id", F.coalesce("component", "doc_id").alias("component")))
    mixed = pin(named.groupBy("region").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("region"))
    return named.join(bounded_broadcast(mixed, BROADCAST_ROWS), "region", "left_semi").select("doc_id", "component").distinct()


def joined_pairs(open_rows: DataFrame, texts: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """``a``, ``b`` and ``agreement`` of every pair of ``open_rows`` in
    different components whose sets may reach num / den, from a join of the
    sets' rarest shingles (prefix and position filters); ``texts`` has one
    row per doc_id."""

    def explode(parts):
        for part in small_batches(parts):
            row, code = shingle_sets(*text_buffer(part.column("text")))
            count = np.bincount(row, minlength=part.num_rows).astype(np.int32)
            yield pa.RecordBatch.from_arrays([part.column("doc_id").take(pa.array(row)), pa.array(count[row]), pa.array(code.view(np.int64))],
                                             ["doc_id", "n", "code"])

    every = spread(texts.select("doc_id", "text")).mapInArrow(explode, "doc_id bigint, n int, code bigint")
    often = pin(every.groupBy("code").agg(F.count(F.lit(1)).alias("seen")).where(F.col("seen") > NEIGHBOURS))
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.coalesce("seen", F.lit(0)), "code"))
    # a set shares at least num / den of its shingles with one that reaches the
    # similarity, and 2 num / (num + den) of them with one of its size or more
    head = every.join(bounded_broadcast(often, BROADCAST_ROWS), "code", "left").withColumn("place", place).where(
        F.expr(f"place <= n - (n * {num}L + {den - 1}) div {den} + 1"))
    head = pin(head.join(open_rows, "doc_id").select("code", "doc_id", "n", "place", "component"))
    per = head.groupBy("code", "component").agg(F.count(F.lit(1)).alias("rows"))
    main = per.groupBy("code").agg(F.max_by("component", F.struct("rows", "component")).alias("main"), F.count(F.lit(1)).alias("kinds"))
    head = pin(head.join(main.where("kinds > 1").select("code", "main"), "code").withColumn("in_main", F.expr("component = main")).drop("main"))
    first = head.where(F.expr(f"place <= n - (2 * n * {num}L + {num + den - 1}) div {num + den} + 1"))
    # the rows of a shingle's largest component never meet each other
    together = f"(({num}L * (x.n + y.n) + {num + den - 1}) div {num + den})"
    meet = F.expr(f"""x.code = y.code and x.component <> y.component and (x.n < y.n or x.n = y.n and x.doc_id < y.doc_id)
                      and x.n - x.place + 1 >= {together} and y.n - y.place + 1 >= {together}""")
    found = [x.alias("x").join(y.alias("y"), meet).select(F.least("x.doc_id", "y.doc_id").alias("a"), F.greatest("x.doc_id", "y.doc_id").alias("b"))
             for x, y in ((first.where("not in_main"), head), (first.where("in_main"), head.where("not in_main")))]
    pairs = found[0].unionByName(found[1]).distinct()
    least = _least_agreement(num, den)

    def agree(parts):
        for part in batches(parts):
            a, b = (np.frombuffer(b"".join(part.column(c).to_pylist()), np.uint8).reshape(part.num_rows, -1) for c in ("sa", "sb"))
            same = EQUAL[a ^ b].sum(axis=1).astype(np.int32)
            out = pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(same)], ["a", "b", "agreement"])
            yield out.filter(pa.array(same >= least))

    both = pairs.join(sets.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sa")), "a").join(
        sets.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sb")), "b")
    return both.select("a", "b", "sa", "sb").mapInArrow(agree, "a bigint, b bigint, agreement int")


def connect(pairs: DataFrame, texts: DataFrame, num: int, den: int, label: DataFrame | None = None) -> DataFrame:
    """``node`` and ``component`` of every document with a confirmed link,
    from the pairs and the components in ``label``."""
    found = confirm(pairs.select("a", "b"), texts, num, den)
    if label is not None:
        found = label.select(F.col("node").alias("a"), F.col("component").alias("b")).unionByName(found)
    return pin(components(pin(found)))


def near_duplicates(docs: DataFrame, num: int = 85, den: int = 100, fingerprints: bool = False) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row,
    with ``f1`` and ``f2`` of its set if ``fingerprints`` are wanted."""
    with scratch_scope(docs.sparkSession):  # only the result stays
        found = _near_duplicates(docs, num, den)
        return pin(found if fingerprints else found.drop("f1", "f2"), keep=True)


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    return pin(docs.select("doc_id", "text").join(bounded_broadcast(pin(wanted), BROADCAST_ROWS), "doc_id", "left_semi")
               .dropDuplicates(["doc_id"]))


def _near_duplicates(docs: DataFrame, num: int, den: int) -> DataFrame:
    found = pin(documents_sets(docs))
    # a set of one row is its own class; the others go by their least doc_id
    classes = pin(found.where("n_shingles > 0").groupBy("n_shingles", "f1", "f2").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
                  .where("rows > 1").drop("rows"))
    rep = F.when(F.col("n_shingles") > 0, F.coalesce("least", "doc_id"))
    sets = pin(found.join(bounded_broadcast(classes, BROADCAST_ROWS), ["n_shingles", "f1", "f2"], "left").withColumn("rep", rep).select(
        "doc_id", "n_shingles", "f1", "f2", "rep", *[F.when(F.col("doc_id") == F.col("rep"), F.col(c)).alias(c) for c in ("signature", "sketch")]))
    reps = pin(sets.where("signature is not null").dropDuplicates(["doc_id"]))     # read by every round
    hot = pin(regions(reps).groupBy("region").count().where(F.col("count") > NEIGHBOURS).select("region"))
    label = None
    for trees, neighbours in ((FIRST_TREES, 1), (TREES, NEIGHBOURS)):
        pairs = pin(candidate_pairs(reps, hot, num, den, label, trees, neighbours))
        wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct()
        label = connect(pairs, _texts(docs, wanted), num, den, label)
    open_rows = pin(unsettled(reps, hot, label))
    if open_rows.limit(1).count():
        texts = _texts(docs, open_rows.select("doc_id"))
        label = connect(pin(joined_pairs(open_rows, texts, reps, num, den)), texts, num, den, label)
    named = sets.select("doc_id", "n_shingles", "f1", "f2", "rep").join(label.withColumnRenamed("node", "rep"), "rep", "left")
    component = F.coalesce("component", "rep", "doc_id")
    return named.select("doc_id", "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col("doc_id")).alias("kept"), "f1", "f2")
