"""Repair of conversations at the least cost, by Four-Russians block tables.

The rows of a conversation, in order of turn, become symbols: what must go (blank rows and repetitions), or the
role's initial with or without a broken-off end. Edits turn them into system? (user assistant)+, or nothing.
The cost still to come, by what the last kept row was (nothing, system, user, assistant), is a vector of four
numbers; less its least number it is one of 16 vectors. So for every block of up to BLOCK symbols and every
vector at its right end, a table tells the vector at its left end: a conversation is read from its end by one
lookup a block. The edits are then told from the start: a block is expanded backward from the vector at its right
end, and at each step the first edit in the alphabet that keeps the least cost is taken. As costs to come are
exact and each letter leads to one state only, equal costs give the first list of edits in the alphabet.

A long conversation is cut into segments of bounded rows and bytes. A segment is a function, from the vector at
its right end to that at its left, and from its first state to its last; functions compose, so segments are
chained in two bounded steps (within a partition, then partitions) and every segment is repaired by itself.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridlake.cluster import stage_table

BLOCK = 4
SEGMENT_ROWS, SEGMENT_BYTES = 4096, 4 << 20
BATCH_BYTES = 8 << 20

# Costs of edits, by initials: keep, give another role, delete, insert; a broken-off row that stays adds one.
KEEP, REROLE, DELETE, INSERT, BROKEN = 0, 2, 3, 2, 1

# States: nothing yet, after system, after user, after assistant. Where an initial leads, and the one role that can
# be given or inserted there.
START, SYSTEM, USER, ASSISTANT = range(4)
LEADS = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
FORCED = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
FINAL = (START, ASSISTANT)

# Symbols: 0 must go; then system, user, assistant and other roles, each whole or broken off.
INITIALS = "sua"
SYMBOLS = 9
NEVER = 1 << 30


def symbol(initial: str, broken: bool) -> int:
    kind = INITIALS.find(initial) if initial else -1
    return 1 + 2 * (kind if kind >= 0 else 3) + broken


def _moves(sym: int, state: int) -> Iterator[tuple[str, int, int]]:
    """(edit, cost, next state) of the edits that use up a row, in alphabetical order."""
    yield "D", DELETE, state
    if sym:
        kind, broken = divmod(sym - 1, 2)
        to = LEADS[INITIALS[kind]].get(state) if kind < 3 else None
        if to is not None:
            yield "K", KEEP + BROKEN * broken, to
        yield "R", REROLE + BROKEN * broken, FORCED[state]


def _with_inserts(costs: Iterable[int]) -> tuple[int, ...]:
    g = list(costs)
    for _ in range(3):
        g = [min(g[s], INSERT + g[FORCED[s]]) for s in range(4)]
    return tuple(g)


def _before(sym: int, after: tuple[int, ...]) -> tuple[int, ...]:
    """Costs to come before a row, from those after it."""
    return _with_inserts(min(cost + after[to] for _, cost, to in _moves(sym, s)) for s in range(4))


@functools.cache
def tables() -> tuple[list[tuple[int, ...]], dict[bytes, tuple[int, ...]]]:
    """(vectors, table): the normalised vectors, first that at a conversation's end; for each block of symbols the
    number of the vector at its left end, by that at its right."""
    normal = lambda v: tuple(x - min(v) for x in v)                                          # noqa: E731
    vectors = [normal(_with_inserts(0 if s in FINAL else NEVER for s in range(4)))]
    number = {vectors[0]: 0}
    single: list[list[int]] = []
    for v in vectors:                                                # grows while it is read
        single.append([])
        for sym in range(SYMBOLS):
            w = normal(_before(sym, v))
            if w not in number:
                number[w] = len(vectors)
                vectors.append(w)
            single[-1].append(number[w])
    table = {b"": tuple(range(len(vectors)))}
    for n in range(1, BLOCK + 1):
        for block in itertools.product(range(SYMBOLS), repeat=n):
            rest = table[bytes(block[1:])]
            table[bytes(block)] = tuple(single[v][block[0]] for v in rest)
    return vectors, table


@functools.lru_cache(maxsize=1 << 17)
def expand(block: bytes, right: int) -> tuple[tuple[str, int, int], ...]:
    """(edits, last state, cost) by the first state, of a block whose right end has vector ``right``."""
    vector = tables()[0][right]
    behind = [vector]
    for sym in reversed(block):
        behind.append(_before(sym, behind[-1]))
    behind.reverse()                                                 # behind[i]: costs to come before row i
    out = []
    for state in range(4):
        edits, spent = "", 0
        for i, sym in enumerate(block):
            while True:
                moves = list(_moves(sym, state))
                moves.insert(1, ("I", INSERT, FORCED[state]))
                edit, cost, to = next(m for m in moves if m[1] + behind[i + (m[0] != "I")][m[2]] == behind[i][state])
                edits, spent, state = edits + edit, spent + cost, to
                if edit != "I":
                    break
        out.append((edits, state, spent))
    return tuple(out)


def _blocks(symbols: bytes) -> list[bytes]:
    return [symbols[i:i + BLOCK] for i in range(0, len(symbols), BLOCK)]


def _vectors(blocks: list[bytes], right: int) -> list[int]:
    """The vector at the right end of each block, and before the first: by one lookup a block, from the right."""
    table = tables()[1]
    out = [right]
    for block in reversed(blocks):
        out.append(table[block][out[-1]])
    out.reverse()
    return out


def edits_of(symbols: bytes, right: int = 0, state: int = START, last: bool = True) -> tuple[str, int, int]:
    """(edits, last state, cost) of a segment; the conversation's last one also gets what must be inserted behind it."""
    blocks = _blocks(symbols)
    at, edits, spent = _vectors(blocks, right), [], 0
    for block, vector in zip(blocks, at[1:]):
        part, state, cost = expand(block, vector)[state]
        edits.append(part)
        spent += cost
    while last and state not in FINAL:
        edits.append("I")
        state, spent = FORCED[state], spent + INSERT
    return "".join(edits), state, spent


def apply_edits(edits: str, symbols: bytes, roles: list[str], texts: list[str], state: int) -> tuple[list[str], list[str]]:
    """Roles and texts of the repaired rows; ``roles`` and ``texts`` are those of the rows whose symbol is not 0."""
    rows = iter(zip(roles, texts))
    syms = iter(symbols)
    out_roles, out_texts = [], []
    for edit in edits:
        if edit == "I":
            state = FORCED[state]
            out_roles.append(ROLE[state])
            out_texts.append("")
            continue
        sym = next(syms)
        role, text = next(rows) if sym else ("", "")
        if edit == "D":
            continue
        state = FORCED[state] if edit == "R" else LEADS[INITIALS[(sym - 1) // 2]][state]
        out_roles.append(ROLE[state] if edit == "R" else role)
        out_texts.append(text)
    return out_roles, out_texts


# ---- segments as functions -----------------------------------------------------------------------------------

def _element(symbols: bytes) -> tuple[bytes, bytes]:
    """(vector before, last state) by the vector behind and the first state."""
    blocks, n = _blocks(symbols), len(tables()[0])
    to, ends = bytearray(), bytearray()
    for right in range(n):
        at = _vectors(blocks, right)
        to.append(at[0])
        states = list(range(4))
        for block, vector in zip(blocks, at[1:]):
            ways = expand(block, vector)
            states = [ways[s][1] for s in states]
        ends.extend(states)
    return bytes(to), bytes(ends)


def _join(a: tuple[bytes, bytes], b: tuple[bytes, bytes]) -> tuple[bytes, bytes]:
    """Segment a and then b as one."""
    to, ends = bytearray(), bytearray()
    for right, middle in enumerate(b[0]):
        to.append(a[0][middle])
        ends.extend(b[1][4 * right + a[1][4 * middle + s]] for s in range(4))
    return bytes(to), bytes(ends)


def _solve(parts: list[tuple[bytes, bytes]], right: int, state: int) -> tuple[list[int], list[int]]:
    """Vector behind and first state of each of the parts, given the vector behind the last and the first's state."""
    rights, states = [right], [state]
    for to, _ in reversed(parts[1:]):
        rights.append(to[rights[-1]])
    rights.reverse()
    for (_, ends), r in zip(parts[:-1], rights):
        states.append(ends[4 * r + states[-1]])
    return rights, states


ELEMENT = "conv_id {kind}, part int, seg int, to binary, ends binary"
PLACE = "conv_id {kind}, part int, seg int, behind int, state int, last boolean"


def _sorted_parts(t: pa.Table) -> tuple[list[int], list[tuple[bytes, bytes]]]:
    order = sorted(range(t.num_rows), key=list(zip(t["part"].to_pylist(), t["seg"].to_pylist())).__getitem__)
    to, ends = t["to"].to_pylist(), t["ends"].to_pylist()
    return order, [(to[i], ends[i]) for i in order]


def _as_one(t: pa.Table) -> pa.Table:
    _, parts = _sorted_parts(t)
    to, ends = functools.reduce(_join, parts)
    one = t.slice(0, 1)
    return pa.table({"conv_id": one["conv_id"], "part": one["part"], "seg": pa.array([0], pa.int32()),
                     "to": pa.array([to], pa.binary()), "ends": pa.array([ends], pa.binary())})


def _places(t: pa.Table) -> pa.Table:
    """Where each part stands, in a group whose ends are known (columns behind, state, last) or are the conversation's."""
    order, parts = _sorted_parts(t)
    known = "behind" in t.column_names
    right, state, last = (t[c][0].as_py() for c in ("behind", "state", "last")) if known else (0, START, True)
    rights, states = _solve(parts, right, state)
    t = t.take(pa.array(order))
    return pa.table({"conv_id": t["conv_id"], "part": t["part"], "seg": t["seg"], "behind": pa.array(rights, pa.int32()),
                     "state": pa.array(states, pa.int32()),
                     "last": pa.array([last and i == len(order) - 1 for i in range(len(order))], pa.bool_())})


def _split_places(segments: DataFrame) -> DataFrame:
    """(part, seg, behind, state, last) of the segments of conversations that have more than one."""
    kind = segments.schema["conv_id"].dataType.simpleString()
    narrow = segments.select("conv_id", "part", "seg", "symbols")
    several = narrow.groupBy("conv_id").count().filter("count > 1").select(F.col("conv_id").alias("c"))
    several = narrow.join(several, F.col("conv_id").eqNullSafe(F.col("c")), "left_semi")

    def elements(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = [_element(s.as_py()) for s in b.column(3)]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), b.column(2), pa.array([x[0] for x in made], pa.binary()),
                 pa.array([x[1] for x in made], pa.binary())], names=["conv_id", "part", "seg", "to", "ends"])

    parts = stage_table(several.mapInArrow(elements, ELEMENT.format(kind=kind)), "conversation-parts")
    # One row for each conversation and partition, then one group for each conversation: as many rows as partitions.
    wide = (parts.groupBy("conv_id", "part").applyInArrow(_as_one, ELEMENT.format(kind=kind))
            .groupBy("conv_id").applyInArrow(_places, PLACE.format(kind=kind))
            .select(F.col("conv_id").alias("c"), F.col("part").alias("p"), "behind", "state", "last"))
    placed = parts.join(wide, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("part") == F.col("p"))).drop("c", "p")
    return placed.groupBy("conv_id", "part").applyInArrow(_places, PLACE.format(kind=kind)).drop("conv_id")


# ---- rows to segments ----------------------------------------------------------------------------------------

SEGMENT = ("conv_id {kind}, part int, seg int, symbols binary, roles array<string>, texts array<string>, blank long, "
           "duplicate long, truncated long, illegal long, turns long, low long, high long, first_turn long, last_turn long, "
           "first_initial string, last_initial string")
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


class _Segment:
    """The rows of a segment as they come up."""

    def __init__(self):
        self.symbols, self.roles, self.texts, self.bytes = bytearray(), [], [], 0
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first_turn = self.last_turn = self.first_initial = self.last_initial = None

    def full(self, most: int) -> bool:
        return len(self.symbols) >= most or self.bytes >= SEGMENT_BYTES

    def row(self, turn: int | None, initial: str, sym: int, role: str, text: str) -> None:
        if self.symbols:
            self.illegal += (self.last_initial, initial) not in LEGAL
        else:
            self.first_turn, self.first_initial = turn, initial
        if turn is not None:
            self.turns += self.low is None or turn != self.last_turn
            self.low, self.high = turn if self.low is None else self.low, turn
        self.last_turn, self.last_initial = turn, initial
        self.symbols.append(sym)
        if sym:
            self.roles.append(role)
            self.texts.append(text)
            self.bytes += len(text) + len(role)

    def copies(self, times: int) -> None:
        """Further copies of the last row, which must go: as many as fit."""
        self.symbols.extend(bytes(times))
        self.illegal += times

    def values(self) -> tuple:
        return (bytes(self.symbols), self.roles, self.texts, self.blank, self.duplicate, self.truncated, self.illegal, self.turns,
                self.low, self.high, self.first_turn, self.last_turn, self.first_initial, self.last_initial)


def _flush(rows: list[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
        rows.clear()


def _segments(kind: str, id_type: pa.DataType, most: int):
    fields = [f.split() for f in SEGMENT.format(kind=kind).split(", ")]
    types = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "array<string>": pa.list_(pa.string())}
    schema = pa.schema([pa.field(name, id_type if name == "conv_id" else types[t]) for name, t in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seg, size, out = TaskContext.get().partitionId(), 0, 0, []
        now, owner = _Segment(), None

        def close(_seg: int) -> int:
            out.append((owner, part, _seg, *now.values()))
            return now.bytes + len(now.symbols) + 100

        for batch in batches:
            for conv, turn, role, text, copies, later, blank, broken in zip(*(c.to_pylist() for c in batch.columns)):
                if now.symbols and (conv != owner or now.full(most)):
                    size += close(seg)
                    seg, now = seg + 1, _Segment()
                owner = conv
                initial = role[:1]
                now.row(turn, initial, 0 if blank or later else symbol(initial, broken), role, text)
                now.blank += blank
                now.duplicate += later and not blank
                now.truncated += broken and not blank and not later
                copies -= 1
                while copies:
                    take = min(copies, max(0, most - len(now.symbols)))
                    now.copies(take)
                    if blank:
                        now.blank += take
                    else:
                        now.duplicate += take
                    copies -= take
                    if copies:
                        size += close(seg)
                        seg, now = seg + 1, _Segment()
                        now.row(turn, initial, 0, role, text)
                        now.blank += blank
                        now.duplicate += not blank
                        copies -= 1
                if size > BATCH_BYTES:
                    size = 0
                    yield from _flush(out, schema)
        if now.symbols:
            close(seg)
        yield from _flush(out, schema)

    return run


PIECE = ("conv_id {kind}, part int, seg int, whole boolean, edits string, cost long, roles array<string>, texts array<string>, "
         "blank long, duplicate long, truncated long, illegal long, turns long, low long, high long, first_turn long, "
         "last_turn long, first_initial string, last_initial string")
KEPT = ("blank", "duplicate", "truncated", "illegal", "turns", "low", "high", "first_turn", "last_turn", "first_initial", "last_initial")


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for i in range(0, whole.num_rows, 256):
            b = whole.slice(i, 256)
            at = {name: b.column(c) for c, name in enumerate(b.schema.names)}
            edits, costs, roles, texts = [], [], [], []
            for symbols, behind, state, last, r, t in zip(*(at[c].to_pylist() for c in (
                    "symbols", "behind", "state", "last", "roles", "texts"))):
                e, _, cost = edits_of(symbols, behind or 0, state or START, last is None or last)
                r, t = apply_edits(e, symbols, r, t, state or START)
                for values, v in ((edits, e), (costs, cost), (roles, r), (texts, t)):
                    values.append(v)
            yield pa.RecordBatch.from_arrays(
                [at["conv_id"], at["part"], at["seg"], at["behind"].is_null(), pa.array(edits, pa.string()), pa.array(costs, pa.int64()),
                 pa.array(roles, pa.list_(pa.string())), pa.array(texts, pa.list_(pa.string())), *(at[c] for c in KEPT)],
                names=["conv_id", "part", "seg", "whole", "edits", "cost", "roles", "texts", *KEPT])


def repair(rows: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
           segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """Repaired conversations in pieces: (conv_id, part, seg) in order, the piece's edits, cost, and its rows as two arrays.

    Rows are taken by turn, nulls first; those of one turn by role, then by the first 64 characters of the text, then
    by its digest. Null roles and texts are one space. A row without a character other than white space must go, as
    must one whose role and text its conversation has had before; rows of null conv_id are one conversation. A row
    is broken off if its last such character is not one of ``.!?``. A conversation whose rows all go has a piece
    without rows; empty tables give none. Other columns are not read, so they cannot clash. A conversation that
    fits into ``segment_rows`` rows and SEGMENT_BYTES bytes of text, and lies in one partition, is one piece (``whole``).
    """
    space = "\t\n\x0b\x0c\r "
    said = rows.select(F.col(conv_id).alias("conv_id"), F.col(turn).cast("long").alias("turn"),
                       F.coalesce(F.col(role), F.lit(" ")).alias("role"), F.coalesce(F.col(text), F.lit(" ")).alias("text"))
    # Equal rows of a turn are counted first, then those that other turns have said before are marked.
    said = said.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("copies"))
    said = said.withColumn("digest", F.sha2(F.concat("role", F.lit("\0"), "text"), 256))
    first = (said.groupBy("conv_id", "digest").agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("n")).filter("n > 1")
             .select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first"))
    said = said.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    bare = F.rtrim("text", F.lit(space))
    said = said.select(
        "conv_id", "turn", "role", "text", "copies",
        F.coalesce(F.struct("turn") > F.col("first"), F.lit(False)).alias("later"),
        (F.ltrim(bare, F.lit(space)) == "").alias("blank"), (~F.right(bare, F.lit(1)).isin(".", "!", "?")).alias("broken"),
        F.substring("text", 1, 64).alias("start"), "digest")
    keys = ["conv_id", "turn", "role", "start", "digest"]
    said = said.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("start", "digest")
    kind = said.schema["conv_id"].dataType.simpleString()
    id_type = pa.string() if kind == "string" else pa.int32() if kind == "int" else pa.int64()
    segments = stage_table(said.mapInArrow(_segments(kind, id_type, segment_rows), SEGMENT.format(kind=kind)), "conversation-segments")
    places = _split_places(segments)
    return stage_table(segments.join(places, ["part", "seg"], "left").mapInArrow(_repaired, PIECE.format(kind=kind)), "conversation-pieces")


def turns(pieces: DataFrame) -> DataFrame:
    """(conv_id, part, seg, place, role, text): the repaired rows, in that order."""
    both = F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "row")
    return pieces.select("conv_id", "part", "seg", both).select("conv_id", "part", "seg", "place", "row.roles", "row.texts").toDF(
        "conv_id", "part", "seg", "place", "role", "text")


REPORT = ("conv_id {kind}, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
          "repaired_sha256 string")


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation, of pieces in order: nothing but the audit is kept from piece to piece."""
    names = [f.split()[0] for f in REPORT.split(", ")]
    started, owner, audit, done = False, None, [], []
    for batch in batches:
        id_type = batch.schema.field(0).type

        def out() -> pa.RecordBatch:
            types = [id_type, *[pa.int64()] * 6, pa.string(), pa.string()]
            made = [pa.array(c, t) for c, t in zip(zip(*done), types)]
            done.clear()
            return pa.RecordBatch.from_arrays(made, names=names)

        def finish() -> None:
            gaps = high - low + 1 - sums["turns"] if low is not None else 0
            done.append((owner, gaps, *(sums[c] for c in ("blank", "duplicate", "truncated", "illegal", "cost")), "".join(audit), sha.hexdigest()))

        for row in batch.to_pylist():
            if not started or row["conv_id"] != owner:
                if started:
                    finish()
                started, owner, audit, sha, any_rows = True, row["conv_id"], [], hashlib.sha256(), False
                sums, low, high, before = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0), None, None, None
            for c in sums:
                sums[c] += row[c]
            if before is not None:
                sums["illegal"] += (before["last_initial"], row["first_initial"]) not in LEGAL
                sums["turns"] -= row["first_turn"] is not None and before["last_turn"] == row["first_turn"]
            before = {c: row[c] for c in ("last_initial", "last_turn")}
            low, high = row["low"] if low is None else low, row["high"] if row["high"] is not None else high
            audit.append(row["edits"])
            for r, t in zip(row["roles"], row["texts"]):
                sha.update((b"\n" if any_rows else b"") + f"{r}:{t}".encode())
                any_rows = True
            if len(done) >= 4096:
                yield out()
        if done:
            yield out()
    if started:
        finish()
        yield out()


def report(pieces: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256): one row a conversation.

    Whole conversations are reported where they lie. The pieces of others come together in order and stream through
    one hash, as SHA-256 of one text has no parts; what a task holds is a piece and the audit.
    """
    shape = REPORT.format(kind=pieces.schema["conv_id"].dataType.simpleString())
    split = pieces.filter(~F.col("whole")).repartition("conv_id").sortWithinPartitions("conv_id", "part", "seg")
    return pieces.filter("whole").mapInArrow(_report, shape).union(split.mapInArrow(_report, shape))


def repair_report(rows: DataFrame, conversations: DataFrame, segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """The report for every conv_id of ``conversations``, also for those without a row in ``rows``."""
    ids = conversations.select(F.col("conv_id").alias("c")).distinct()
    found = report(repair(rows, segment_rows=segment_rows))
    none = {"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()}
    columns = [f.split()[0] for f in REPORT.split(", ")[1:]]
    return ids.join(found, F.col("c").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("c").alias("conv_id"), *(F.coalesce(F.col(n), F.lit(none.get(n, 0))).alias(n) for n in columns))


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults, by crc32 of ``conv_id:turn`` modulo 20; nulls are one space.

    0 drops a row, 1 empties its text, 2 takes ``.!?`` out of it, 3 repeats the row, 4 makes its role user.
    """
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))                    # noqa: E731
    fault = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    return conversations.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), fault.alias("fault")).filter(
        "fault != 0").select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("fault") == 3, 2).otherwise(1))).alias("copy")).drop("copy")
