"""Conversation structure repair: the cheapest edits that make the roles of a
conversation read (system)? (user assistant)+, or nothing at all, found by
Hirschberg's divide and conquer.

A row is kept (0), given the role the place needs (2) or deleted (3; a must
for blank rows and duplicates), an empty row of the needed role may be inserted
anywhere (2), and every truncated row that stays adds 1. Four states say what
a prefix has come to: nothing, after the system row, after a user row, after an
assistant row. A forward pass gives the least cost of the first half for each
state, a backward pass that of the second half from each state; where they
meet, the crossings of least total cost are kept, the first half is solved for
the audit-least way to one of them, and the second half from there. Only the
two vectors of four costs are held per level, never a table of rows by states.
Two different ways through the same rows first differ inside the first half or
cross in the same state, so the first half alone decides between crossings.

A conversation is cut into blocks of consecutive rows, and the top levels of
the recursion run over blocks in Spark: every block gives its costs from state
to state, a pass from the end gives the cost vector behind each block, every
block is solved on its own from each state it may begin in, and a pass from the
beginning picks the state. So one conversation may be longer than a task could
hold. The passes read a row per block; only the digest of a conversation's
repaired text has to see that text in order, and it is streamed.

Order and ties: rows are taken by turn, nulls first, then role, then the digest
of the text. Nulls count as one space in role and text; a null conv_id is a
conversation of its own. Repeated rows are duplicates like others. An empty
table gives no conversation, other columns are not used.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import DataType

from ..operators.ranking import range_partitions
from ..operators.sizing import pin

#: Rows of a block.
BLOCK = 1024
#: Characters of repaired text that are sent on as one piece.
PIECE = 1 << 20

# fixed values: states, the state that the next user or assistant row leads to,
# and what the audit gets at the end for each state
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
NEXT = (USER, USER, ASSISTANT, USER)
TAIL = ("", "II", "I", "")
INSERT, REROLE, DELETE, CUT = 2, 2, 3, 1
ROLE = {USER: "user", ASSISTANT: "assistant"}
# fixed values: a row's code is its initial plus four times its fault
INITIALS = "?sua"
FINE, TRUNCATED, BLANK, DUPLICATE = range(4)
LEGAL = ("su", "ua", "au")

FAR = 1 << 40
BLANKS = " \t\n\x0b\x0c\r"


def row_ways(code: int, state: int) -> list[tuple[int, int, str]]:
    """The ways over one row: (state after it, cost, audit), the cheapest and
    then audit-least one per state. Inserts come before the row."""
    initial, fault = INITIALS[code % 4], code // 4
    found: dict[int, tuple[int, str]] = {}

    def way(after, cost, audit):
        found[after] = min(found.get(after, (FAR, "")), (cost, audit))

    for inserts in range(3):
        cost, audit, to = INSERT * inserts, "I" * inserts, NEXT[state]
        way(state, cost + DELETE, audit + "D")
        if fault < BLANK:
            stays = cost + CUT * (fault == TRUNCATED)
            if initial == ROLE[to][0]:
                way(to, stays, audit + "K")
            if initial == "s" and state == NOTHING:
                way(SYSTEM, stays, audit + "K")
            way(to, stays + REROLE, audit + "R")
        state = to
    return [(after, *best) for after, best in sorted(found.items())]


class Costs:
    """Cost vectors over rows of codes. Vectors are kept relative to their
    least entry, so only a few differ and each step is looked up."""

    def __init__(self):
        self.ways = [[row_ways(code, state) for state in range(4)] for code in range(16)]
        self.ahead: dict = {}
        self.back: dict = {}
        self.end = tuple(INSERT * len(t) for t in TAIL)

    @staticmethod
    def _relative(v):
        least = min(v)
        return tuple(x - least if x < FAR else FAR for x in v), least

    def _walk(self, v, codes, known, step):
        v, total = self._relative(v)
        for code in codes:
            got = known.get((v, code))
            if got is None:
                got = known[v, code] = self._relative(step(v, code))
            v, more = got
            total += more
        return tuple(x + total if x < FAR else FAR for x in v)

    def _step(self, v, code):
        out = [FAR] * 4
        for state in range(4):
            if v[state] < FAR:
                for after, cost, _ in self.ways[code][state]:
                    out[after] = min(out[after], v[state] + cost)
        return out

    def _step_back(self, v, code):
        return [min([min(cost + v[after], FAR) for after, cost, _ in self.ways[code][state]]) for state in range(4)]

    def forward(self, state: int, codes: bytes):
        """Least cost of all rows from ``state`` to each state."""
        return self._walk(tuple(0 if s == state else FAR for s in range(4)), codes, self.ahead, self._step)

    def backward(self, v, codes: bytes):
        """Least cost of all rows from each state, ``v`` being the costs of
        what follows from each state."""
        return self._walk(tuple(v), codes[::-1], self.back, self._step_back)

    def solve(self, codes: bytes, state: int, v) -> tuple[int, str]:
        """The state after the rows and the audit of the cheapest, then
        audit-least way from ``state``, with ``v`` to come."""
        if len(codes) == 1:
            _, audit, after = min((cost + v[after], audit, after) for after, cost, audit in self.ways[codes[0]][state])
            return after, audit
        half = len(codes) // 2
        first, second = codes[:half], codes[half:]
        to, on = self.forward(state, first), self.backward(v, second)
        best = min(a + b for a, b in zip(to, on))
        crossings = tuple(b if a + b == best else FAR for a, b in zip(to, on))
        after, left = self.solve(first, state, crossings)
        after, right = self.solve(second, after, v)
        return after, left + right


def _tuples(batches, *columns):
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in columns))


def _batches(rows, schema: pa.Schema, size: int = 256, weight=None):
    """Record batches of at most ``size`` rows (or PIECE characters by ``weight``)."""
    held, heavy = [], 0
    for row in rows:
        held.append(row)
        heavy += weight(row) if weight else 0
        if len(held) == size or heavy >= PIECE:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, heavy = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


_L, _S, _LS = pa.int64(), pa.string(), pa.list_(pa.int64())


def ordered_rows(conversations: DataFrame) -> DataFrame:
    """All rows in order, written: (at, part, conv, turn, role, text, initial,
    fault, same); ``at`` rises with the order, ``part`` holds a stretch of it,
    ``same`` is equal for rows of equal role and text in one conversation."""
    spark = conversations.sparkSession
    role, text = F.coalesce(F.col("role").cast("string"), F.lit(" ")), F.coalesce(F.col("text").cast("string"), F.lit(" "))
    initial = F.position(F.substring("role", 1, 1), F.lit("sua"))
    last = F.right(F.rtrim(text, F.lit(BLANKS)), F.lit(1))
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(TRUNCATED)
    rows = conversations.select(F.col("conv_id").alias("conv"), F.col("turn").cast("bigint").alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("digest", F.md5("text")).withColumn("tie", F.monotonically_increasing_id())
    key = ["conv", "turn", "role", "digest", "tie"]
    rows = (rows.repartitionByRange(range_partitions(spark), *key).sortWithinPartitions(*key)
            .withColumn("at", F.monotonically_increasing_id()))
    same = F.md5(F.concat_ws(":", F.coalesce(F.col("conv").cast("string"), F.lit("")), F.col("conv").isNull().cast("string"),
                             F.md5("role"), "digest"))
    return pin(rows.select("at", F.shiftright("at", 33).alias("part"), "conv", "turn", "role", "text",
                           F.when(F.substring("role", 1, 1) == "", 0).otherwise(initial).cast("int").alias("initial"),
                           fault.cast("int").alias("fault"), same.alias("same")))


def later_copies(rows: DataFrame) -> DataFrame:
    """``at`` and ``part`` of the rows whose role and text an earlier row of
    the conversation has. Blank rows are left out: blank is their fault."""
    told = rows.where(F.col("fault") != BLANK).select("at", "part", "same")
    first = told.groupBy("same").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("same", "first")
    return told.join(first, "same").where("at > first").select("at", "part")


def blocks(rows: DataFrame, conv_type: str) -> DataFrame:
    """A row per block, written: its place, codes, costs from state to state,
    counts of faults, and what its neighbours need to know."""
    marks = later_copies(rows).select("at", "part", F.lit(0).alias("kind"), F.lit(None).cast(conv_type).alias("conv"),
                                      F.lit(None).cast("bigint").alias("turn"), F.lit(0).alias("code"))
    told = rows.select("at", "part", F.lit(1).alias("kind"), "conv", "turn", (F.col("initial") + 4 * F.col("fault")).alias("code"))

    def cut(batches):
        costs = Costs()

        def found():
            held, mark = None, None
            for at, part, kind, conv, turn, code in _tuples(batches, "at", "part", "kind", "conv", "turn", "code"):
                if kind == 0:
                    mark = at
                    continue
                if mark == at:
                    code = code % 4 + 4 * DUPLICATE
                if held is None or held[1:3] != [part, conv] or len(held[3]) == BLOCK:
                    if held:
                        yield held
                    held = [at, part, conv, bytearray(), None, None, 0]
                held[3].append(code)
                if turn is not None:
                    if held[4] is None:
                        held[4] = turn
                    held[6] += turn != held[5]
                    held[5] = turn
            if held:
                yield held

        def whole():
            for at, part, conv, codes, first, last, turns in found():
                yield at, part, conv, bytes(codes), [c for s in range(4) for c in costs.forward(s, bytes(codes))], first, last, turns

        yield from _batches(whole(), out)

    out = pa.schema([("at", _L), ("part", _L), ("conv", _arrow_type(conv_type)), ("codes", pa.binary()), ("costs", _LS),
                     ("first_turn", _L), ("last_turn", _L), ("turns", _L)])
    spark = rows.sparkSession
    dealt = marks.unionByName(told).repartition(range_partitions(spark), "part").sortWithinPartitions("at", "kind")
    return pin(dealt.mapInArrow(cut, f"at bigint, part bigint, conv {conv_type}, codes binary, costs array<bigint>, "
                                     "first_turn bigint, last_turn bigint, turns bigint"))


def _arrow_type(spark_type: str) -> pa.DataType:
    return to_arrow_type(DataType.fromDDL(spark_type))


def costs_behind(cut: DataFrame, conv_type: str) -> DataFrame:
    """For every block the costs of what follows it from each state, and
    whether it begins or ends its conversation: a pass over blocks from the
    end of each conversation."""
    def back(batches):
        def found():
            held, conv = None, None
            v = None
            for conv_, at, costs in _tuples(batches, "conv", "at", "costs"):
                if held is not None:
                    yield (*held, conv_ != conv)
                ends = held is None or conv_ != conv
                v = [INSERT * len(t) for t in TAIL] if ends else v
                held, conv = (at, list(v), ends), conv_
                v = [min(costs[4 * s + q] + v[q] for q in range(4)) for s in range(4)]
            if held is not None:
                yield (*held, True)

        yield from _batches(found(), pa.schema([("at", _L), ("behind", _LS), ("ends", pa.bool_()), ("begins", pa.bool_())]))

    spark = cut.sparkSession
    dealt = cut.select("conv", "at", "costs").repartition(range_partitions(spark), "conv").sortWithinPartitions("conv", F.desc("at"))
    return dealt.mapInArrow(back, "at bigint, behind array<bigint>, ends boolean, begins boolean")


def solved(cut: DataFrame, conv_type: str) -> DataFrame:
    """Every block solved from each state it may begin in: (conv, at, part,
    after, audits); a block that begins its conversation only from nothing."""
    def solve(batches):
        costs = Costs()

        def found():
            for at, part, conv, codes, v, ends, begins in _tuples(batches, "at", "part", "conv", "codes", "behind", "ends", "begins"):
                got = [costs.solve(codes, s, v) if s == NOTHING or not begins else (NOTHING, "") for s in range(4)]
                yield at, part, conv, [a for a, _ in got], [x + TAIL[a] * ends for a, x in got]

        yield from _batches(found(), out)

    out = pa.schema([("at", _L), ("part", _L), ("conv", _arrow_type(conv_type)), ("after", _LS), ("audits", pa.list_(_S))])
    return cut.join(costs_behind(cut, conv_type), "at").mapInArrow(
        solve, f"at bigint, part bigint, conv {conv_type}, after array<bigint>, audits array<string>")


def chosen(cut: DataFrame, conv_type: str) -> DataFrame:
    """The audit of every block and the state it begins in: a pass over blocks
    from the beginning of each conversation."""
    def pick(batches):
        def found():
            conv, state, begun = None, NOTHING, False
            for conv_, at, part, after, audits in _tuples(batches, "conv", "at", "part", "after", "audits"):
                if not begun or conv_ != conv:
                    conv, state, begun = conv_, NOTHING, True
                yield at, part, conv, state, audits[state]
                state = after[state]

        yield from _batches(found(), out)

    out = pa.schema([("at", _L), ("part", _L), ("conv", _arrow_type(conv_type)), ("state", _L), ("audit", _S)])
    spark = cut.sparkSession
    dealt = solved(cut, conv_type).repartition(range_partitions(spark), "conv").sortWithinPartitions("conv", "at")
    return dealt.mapInArrow(pick, f"at bigint, part bigint, conv {conv_type}, state bigint, audit string")


def _edited(rows: DataFrame, cut: DataFrame, conv_type: str) -> DataFrame:
    """Rows and the blocks' audits side by side, a stretch per task in order:
    (at, kind, conv, state, audit, role, text), the audit (kind 0) before the
    rows (kind 1) of its block."""
    audits = chosen(cut, conv_type).select("at", "part", F.lit(0).alias("kind"), "conv", "state", "audit",
                                           F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    told = rows.select("at", "part", F.lit(1).alias("kind"), "conv", F.lit(None).cast("bigint").alias("state"),
                       F.lit(None).cast("string").alias("audit"), "role", "text")
    return audits.unionByName(told).repartition(range_partitions(rows.sparkSession), "part").sortWithinPartitions("at", "kind")


def _edits(batches):
    """The edits in order: (conv, block, place in the block, edit, role, text);
    a deleted row keeps its role and text. A row with edit None opens a block
    and carries its audit as text."""
    def insert():
        nonlocal state, place, next_
        state = NEXT[state]
        place, next_ = place + 1, next_ + 1
        return conv, block, place, "I", ROLE[state], ""

    conv = block = audit = None
    state = place = next_ = 0
    for at, kind, conv_, state_, audit_, role, text in _tuples(batches, "at", "kind", "conv", "state", "audit", "role", "text"):
        if kind == 0:
            while audit and next_ < len(audit):
                yield insert()
            conv, block, state, audit, place, next_ = conv_, at, state_, audit_, 0, 0
            yield conv, block, 0, None, None, audit
            continue
        while audit[next_] == "I":
            yield insert()
        edit = audit[next_]
        place, next_ = place + 1, next_ + 1
        if edit != "D":
            state = SYSTEM if edit == "K" and role[0] == "s" else NEXT[state]
        yield conv, block, place, edit, ROLE[state] if edit == "R" else role, text
    while audit and next_ < len(audit):
        yield insert()


def repaired_rows(conversations: DataFrame) -> DataFrame:
    """The repaired conversations as rows, deleted rows among them: (conv_id,
    block, place, edit, role, text). Sorted by block and place they are in
    order; edit is K, R, D or I."""
    conv_type = conversations.schema["conv_id"].dataType.simpleString()
    rows = ordered_rows(conversations)
    cut = blocks(rows, conv_type)
    out = pa.schema([("conv_id", _arrow_type(conv_type)), ("block", _L), ("place", _L), ("edit", _S), ("role", _S), ("text", _S)])

    def edits(batches):
        told = (e for e in _edits(batches) if e[3] is not None)
        yield from _batches(told, out, 4096, lambda e: len(e[5]))

    return _edited(rows, cut, conv_type).mapInArrow(edits, f"conv_id {conv_type}, block bigint, place bigint, edit string, role string, text string")


SCHEMA = ("gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, "
          "repaired_sha256 string")


def repair(conversations: DataFrame, ids: DataFrame | None = None) -> DataFrame:
    """A row per conversation: conv_id, gaps, blank, duplicate, truncated,
    illegal, cost, audit, repaired_sha256. ``ids`` (conv_id) may name further
    conversations, which have no rows left."""
    conv_type = conversations.schema["conv_id"].dataType.simpleString()
    rows = ordered_rows(conversations)
    cut = blocks(rows, conv_type)

    def pieces(batches):
        def found():
            key, held, seq, long = None, [], 0, 0
            for conv, block, _, edit, role, text in _edits(batches):
                if edit is None or long >= PIECE:
                    if held:
                        yield (*key, seq, None, "\n".join(held))
                    held, long, seq = [], 0, seq + 1
                if edit is None:
                    key, seq = (conv, block, 1), 0
                    yield conv, block, 1, -1, text, None
                elif edit != "D":
                    held.append(f"{role}:{text}")
                    long += len(role) + len(text) + 2
            if held:
                yield (*key, seq, None, "\n".join(held))

        yield from _batches(found(), out, 4096, lambda e: len(e[5] or ""))

    out = pa.schema([("conv", _arrow_type(conv_type)), ("at", _L), ("kind", _L), ("seq", _L), ("audit", _S), ("text", _S)])
    told = _edited(rows, cut, conv_type).mapInArrow(pieces, f"conv {conv_type}, at bigint, kind bigint, seq bigint, audit string, text string")
    nothing = lambda *names: [F.lit(None).cast(t).alias(n) for n, t in names]
    facts = cut.select("conv", "at", F.lit(0).cast("bigint").alias("kind"), F.lit(0).cast("bigint").alias("seq"),
                       "codes", "first_turn", "last_turn", "turns", *nothing(("audit", "string"), ("text", "string")))
    told = told.select("conv", "at", "kind", "seq", *nothing(("codes", "binary"), ("first_turn", "bigint"), ("last_turn", "bigint"), ("turns", "bigint")),
                       "audit", "text")
    parts = facts.unionByName(told)
    if ids is not None:
        parts = parts.unionByName(ids.select(F.col("conv_id").cast(conv_type).alias("conv")).distinct().select(
            "conv", F.lit(-1).cast("bigint").alias("at"), F.lit(-1).cast("bigint").alias("kind"), F.lit(0).cast("bigint").alias("seq"),
            *nothing(("codes", "binary"), ("first_turn", "bigint"), ("last_turn", "bigint"), ("turns", "bigint"), ("audit", "string"), ("text", "string"))))
    final = pa.schema([("conv_id", _arrow_type(conv_type)), ("gaps", _L), ("blank", _L), ("duplicate", _L), ("truncated", _L), ("illegal", _L),
                       ("cost", _L), ("audit", _S), ("repaired_sha256", _S)])

    def whole(batches):
        def found():
            now = None
            for conv, _, kind, _, codes, first, last, turns, audit, text in _tuples(
                    batches, "conv", "at", "kind", "seq", "codes", "first_turn", "last_turn", "turns", "audit", "text"):
                if now is None or now.conv != conv:
                    if now:
                        yield now.row()
                    now = Summary(conv)
                if kind == 0:
                    now.block(codes, first, last, turns)
                elif audit is not None:
                    now.edits(audit)
                elif text is not None:
                    now.text(text)
            if now:
                yield now.row()

        yield from _batches(found(), final, 4096, lambda e: len(e[7]))

    dealt = parts.repartition(range_partitions(rows.sparkSession), "conv").sortWithinPartitions("conv", "at", "kind", "seq")
    return dealt.mapInArrow(whole, f"conv_id {conv_type}, {SCHEMA}")


class Summary:
    """What is told of one conversation, gathered block by block."""

    def __init__(self, conv):
        self.conv = conv
        self.faults = [0] * 4
        self.illegal = self.turns = self.cost = 0
        self.first = self.last = self.initial = self.codes = None
        self.audit: list[str] = []
        self.digest, self.any = hashlib.sha256(), False

    def block(self, codes, first, last, turns):
        initials = [INITIALS[c % 4] for c in codes]
        before = [] if self.initial is None else [self.initial]
        self.illegal += sum(a + b not in LEGAL for a, b in zip(before + initials, (before + initials)[1:]))
        self.initial = initials[-1]
        for c in codes:
            self.faults[c // 4] += 1
        if turns:
            self.turns += turns - (first == self.last)
            self.first = first if self.first is None else self.first
            self.last = last
        self.codes = codes

    def edits(self, audit):
        rows = iter(self.codes)
        for edit in audit:
            if edit == "I":
                self.cost += INSERT
                continue
            cut = CUT * (next(rows) // 4 == TRUNCATED)
            self.cost += DELETE if edit == "D" else cut + REROLE * (edit == "R")
        self.audit.append(audit)

    def text(self, text):
        self.digest.update((b"\n" if self.any else b"") + text.encode("utf-8", "surrogatepass"))
        self.any = True

    def row(self):
        gaps = self.last - self.first + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.faults[BLANK], self.faults[DUPLICATE], self.faults[TRUNCATED], self.illegal, self.cost,
                "".join(self.audit), self.digest.hexdigest())


def damage(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of ``conv_id:turn`` modulo 20: 0 drops
    the row, 1 empties its text, 2 removes its sentence marks, 3 repeats it, 4
    makes it the user's. Nulls count as one space."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fate = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", F.when(fate == 4, "user").otherwise(space("role")).alias("role"),
                                F.when(fate == 1, "").when(fate == 2, F.translate(space("text"), ".!?", "")).otherwise(space("text")).alias("text"),
                                fate.alias("fate"))
    times = F.when(F.col("fate") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.where("fate <> 0").withColumn("copy", F.explode(times)).drop("fate", "copy")
