"""Repair of conversation structure with the fewest edits, by block tables over rows.

A conversation is a string of row symbols (what a row's role is, whether it must go, whether it is cut off). Its edit costs are a
vector over the states of the grammar ``(s?(ua)+)?``. Vectors differ from their least entry by a bounded amount, so there are few of
them, and the step over every block of :data:`BLOCK` symbols from every vector is a table made once. Blocks are processed by look-up;
then they are expanded from the last to the first to mark what lies on a cheapest path, and read forwards along the marks, so that of
equally cheap repairs the one whose audit comes first is found.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

#: Symbols of a block of the table.
BLOCK = 4
DELETE, REROLE, INSERT, CUT = 2, 1, 5, 5
#: Kinds of rows: 0 has to be deleted; others are a role class (system, user, assistant, other), twice, plus one if cut off.
KINDS = 9
#: States: nothing yet, after the system row, after a user row, after an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTING = 1 << START | 1 << ASSISTANT
#: From any state all that another can still reach costs at most this much more (two inserts and a deletion): dearer states are dropped.
SPREAD = 2 * INSERT + DELETE
INFINITE = 1 << 40
_BLANK = " \t\n\x0b\x0c\r"
REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")

#: What inserts can do: from a state to another.
_INSERTS = ((START, USER), (SYSTEM, USER), (ASSISTANT, USER), (USER, ASSISTANT))


def _moves(kind: int) -> list[tuple[str, int, int, int]]:
    """Edits of a row: initial, cost, from state, to state."""
    out = [("D", DELETE, x, x) for x in range(4)]
    if kind:
        role, cut = divmod(kind - 1, 2)
        keep = {0: ((START, SYSTEM),), 1: _INSERTS[:3], 2: _INSERTS[3:], 3: ()}[role]
        out += [("K", CUT * cut, x, y) for x, y in keep]
        out += [("R", REROLE + CUT * cut, x, y) for x, y in _INSERTS]
    return out


MOVES = [_moves(kind) for kind in range(KINDS)]


def _settle(costs: list[int]) -> list[int]:
    """Costs after inserts. Two in a row are all that can help."""
    for _ in range(2):
        for x, y in _INSERTS:
            costs[y] = min(costs[y], costs[x] + INSERT)
    return costs


def _step(costs: tuple[int, ...], kind: int) -> tuple[tuple[int, ...], int]:
    """The vector after a row, less its least entry, and that entry."""
    out = [INFINITE] * 4
    for _, cost, x, y in MOVES[kind]:
        out[y] = min(out[y], costs[x] + cost)
    _settle(out)
    least = min(out)
    return tuple(c - least if c - least <= SPREAD else INFINITE for c in out), least


@cache
def tables() -> tuple[list[tuple[int, ...]], np.ndarray, np.ndarray, list[np.ndarray], list[np.ndarray]]:
    """All vectors; next vector and cost by vector and symbol; the same by vector and number of a block of 1 .. BLOCK symbols.

    The number of a block reads its symbols as digits to the base :data:`KINDS`, the first one highest.
    """
    vectors = [tuple(_settle([0, INFINITE, INFINITE, INFINITE]))]
    number, nexts, costs = {vectors[0]: 0}, [], []
    for vector in vectors:
        steps = [_step(vector, kind) for kind in range(KINDS)]
        for after, _ in steps:
            if after not in number:
                number[after] = len(vectors)
                vectors.append(after)
        nexts.append([number[after] for after, _ in steps])
        costs.append([cost for _, cost in steps])
    one, price = np.array(nexts), np.array(costs)
    to, paid = [one], [price]
    for _ in range(BLOCK - 1):
        to.append(one[to[-1]].reshape(len(vectors), -1))
        paid.append((paid[-1][:, :, None] + price[to[-2]]).reshape(len(vectors), -1))
    return vectors, one, price, to, paid


def _ahead(costs: tuple[int, ...], alive: int) -> int:
    """States of a layer that are alive or reach a live one by inserts on a cheapest path."""
    for _ in range(2):
        for x, y in _INSERTS:
            if alive >> y & 1 and costs[x] + INSERT == costs[y] < INFINITE:
                alive |= 1 << x
    return alive


@lru_cache(1 << 16)
def _expand(vector: int, block: tuple[int, ...], alive: int) -> tuple[list[tuple[int, ...]], list[int]]:
    """Costs and live states of each layer of a block, given the vector before it and the live states after it."""
    vectors = tables()[0]
    costs, paid = [vectors[vector]], 0
    for kind in block:
        after, least = _step(tuple(c - paid if c < INFINITE else INFINITE for c in costs[-1]), kind)
        paid += least
        costs.append(tuple(c + paid if c < INFINITE else INFINITE for c in after))
    layers = [alive]
    for i in range(len(block) - 1, -1, -1):
        here, there = costs[i], costs[i + 1]
        live = 0
        for _, cost, x, y in MOVES[block[i]]:
            if layers[-1] >> y & 1 and here[x] + cost == there[y] < INFINITE:
                live |= 1 << x
        layers.append(_ahead(here, live))
    return costs, layers[::-1]


def _inserted(costs: tuple[int, ...], at: int, alive: int) -> int:
    return sum({1 << y for x, y in _INSERTS if at >> x & 1 and alive >> y & 1 and costs[x] + INSERT == costs[y] < INFINITE})


@lru_cache(1 << 18)
def _read(vector: int, block: tuple[int, ...], alive: int, at: int) -> tuple[str, int]:
    """The first audit of a block in byte order along live states from those in ``at``, and the states it leads to."""
    costs, layers = _expand(vector, block, alive)
    audit = ""
    for i, kind in enumerate(block):
        while True:
            reached: dict[str, int] = {}
            for initial, cost, x, y in MOVES[kind]:
                if at >> x & 1 and layers[i + 1] >> y & 1 and costs[i][x] + cost == costs[i + 1][y] < INFINITE:
                    reached[initial] = reached.get(initial, 0) | 1 << y
            into = _inserted(costs[i], at, layers[i])
            if into:
                reached["I"] = into
            initial = min(reached)
            audit, at = audit + initial, reached[initial]
            if initial != "I":
                break
    return audit, at


def edits(kinds: bytes) -> tuple[int, str]:
    """Cost of the cheapest repair of a conversation of these kinds of rows, and of its audits the first in byte order."""
    if not kinds:
        return 0, ""
    vectors, _, _, to, paid = tables()
    starts, cost, vector, blocks = [], 0, 0, []
    for i in range(0, len(kinds), BLOCK):
        block = tuple(kinds[i : i + BLOCK])
        number = 0
        for kind in block:
            number = number * KINDS + kind
        starts.append(vector)
        blocks.append(block)
        cost += int(paid[len(block) - 1][vector, number])
        vector = int(to[len(block) - 1][vector, number])
    last = vectors[vector]
    least = min(c for x, c in enumerate(last) if ACCEPTING >> x & 1)
    ends = sum(1 << x for x, c in enumerate(last) if ACCEPTING >> x & 1 and c == least)
    final = alive = _ahead(last, ends)
    after = []
    for vector, block in zip(reversed(starts), reversed(blocks), strict=True):
        after.append(alive)
        alive = _expand(vector, block, alive)[1][0]
    at, audit = 1 << START, []
    for vector, block, alive in zip(starts, blocks, reversed(after), strict=True):
        piece, at = _read(vector, block, alive, at)
        audit.append(piece)
    while not at & ends:
        at = _inserted(last, at, final)
        audit.append("I")
    return cost + least, "".join(audit)


def damage(rows: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, live`` of every conversation row, damaged by a checksum of its key; nulls are taken as one space.

    Of 20 remainders, 0 drops the row (it stays with ``live`` false), 1 empties its text, 2 takes its full stops, exclamation and
    question marks away, 3 repeats it, 4 makes it a user's.
    """
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    fault = (F.crc32(key.cast("binary")) % 20).cast("int")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    hurt = F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text)
    return rows.select("conv_id", "turn", F.when(fault == 4, "user").otherwise(role).alias("role"),
                       F.when(fault != 0, hurt).alias("text"), (fault != 0).alias("live"), fault.alias("fault")) \
        .withColumn("copy", F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))) \
        .select("conv_id", "turn", "role", "text", "live")


def _order() -> list[Column]:
    """Order of a conversation's rows: by turn, nulls first; ties by role and text, the text by its first characters and its hash."""
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("head"), F.col("hash")]


def _keyed(rows: DataFrame) -> DataFrame:
    return rows.withColumns({"head": F.substring("text", 1, 32), "hash": F.md5(F.col("text").cast("binary"))})


class _Tally:
    """Counts of one conversation, fed with its rows in order."""

    __slots__ = ("distinct", "first", "illegal", "kinds", "last", "live", "seen", "turn")

    def __init__(self) -> None:
        self.kinds, self.seen, self.illegal, self.live = bytearray(), [0, 0, 0, 0], 0, 0
        self.first = self.turn = None
        self.distinct, self.last = 0, -1

    def add(self, turn: int | None, role: int, fault: int) -> None:
        self.seen[fault] += 1
        self.kinds.append(0 if fault in (1, 2) else 1 + 2 * role + (fault == 3))
        if self.live and (self.last, role) not in ((0, 1), (1, 2), (2, 1)):
            self.illegal += 1
        self.last, self.live = role, 1
        if turn is not None:
            if self.first is None:
                self.first = turn
            if turn != self.turn:
                self.distinct, self.turn = self.distinct + 1, turn

    def report(self) -> tuple:
        gaps = 0 if self.first is None else self.turn - self.first + 1 - self.distinct
        cost, audit = edits(bytes(self.kinds))
        return gaps, self.seen[1], self.seen[2], self.seen[3], self.illegal, cost, audit


def reports(rows: DataFrame) -> DataFrame:
    """For every conversation of ``rows`` (columns of :func:`damage`): ``conv_id``, the counts of :data:`REPORT` and ``audit``.

    Rows are shuffled once, without their texts, and read in order. A task holds one byte a row of one conversation, no more than the
    audit that the result holds.
    """
    tail = F.rtrim("text", F.lit(_BLANK))
    initial = F.substring("role", 1, 1)
    narrow = _keyed(rows).select("conv_id", "turn", "role", "head", "hash", "live",
                                 F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("class"),
                                 (tail == "").alias("blank"), F.substring(tail, -1, 1).isin(".", "!", "?").alias("ended"))
    # Rows of a conversation are dealt once; both orders are sorts inside that partitioning.
    same = Window.partitionBy("conv_id", "live", "role", "head", "hash").orderBy(F.col("turn").asc_nulls_first())
    marked = narrow.repartition("conv_id").withColumn("again", F.row_number().over(same) > 1)
    fault = F.when(F.col("blank"), 1).when(F.col("again"), 2).when(~F.col("ended"), 3).otherwise(0)
    ordered = marked.sortWithinPartitions("conv_id", *_order(), "again") \
        .select("conv_id", "turn", F.col("class").cast("int"), F.when(F.col("live"), fault).cast("int").alias("fault"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, tally = None, None
        for batch in batches:
            out = []
            for conv, turn, role, fault in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if tally is None or conv != now:
                    if tally is not None:
                        out.append((now, *tally.report()))
                    now, tally = conv, _Tally()
                if fault is not None:
                    tally.add(turn, role, fault)
            yield pack(out)
        if tally is not None:
            yield pack([(now, *tally.report())])

    schema = rows.select("conv_id").schema
    for name in REPORT:
        schema = schema.add(name, "long")
    schema = schema.add("audit", "string")
    key_type = to_arrow_type(schema["conv_id"].dataType)
    names = schema.names

    def pack(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        types = [key_type, *[pa.int64()] * len(REPORT), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return ordered.mapInArrow(run, schema)


def repair_stream(rows: DataFrame) -> DataFrame:
    """Every conversation in one partition and in order: a row with its report (``place`` null), then its repaired rows.

    Columns ``conv_id, place, role, text, report``. The report travels with the rows and sorts first, so that no join is needed, and
    texts pass through one at a time.
    """
    told = reports(rows).select("conv_id", F.struct(*REPORT, "audit").alias("report"))
    parts = _keyed(rows.where("live")).unionByName(told, allowMissingColumns=True)
    ordered = parts.repartition("conv_id").sortWithinPartitions("conv_id", F.col("report").isNull(), *_order()) \
        .select("conv_id", "role", "text", "report")
    schema = rows.select("conv_id").schema.add("place", "long").add("role", "string").add("text", "string").add("report", told.schema["report"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, conv, step, place, first = "", None, 0, 0, 0

        def insert(out: list[tuple]) -> None:
            nonlocal step, place
            while step < len(audit) and audit[step] == "I":
                out.append((conv, place, ("user", "assistant")[(place - first) % 2], "", None))
                step, place = step + 1, place + 1

        for batch in batches:
            out: list[tuple] = []
            told = batch.column(3)
            size = 0
            for i, (key, role, text) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)):
                if told[i].is_valid:
                    insert(out)
                    report = told[i].as_py()
                    audit, conv, step, place = report["audit"], key, 0, 0
                    # An odd number of rows starts with the system's.
                    first = (len(audit) - audit.count("D")) % 2
                    out.append((conv, None, None, None, report))
                    continue
                insert(out)
                edit, step = audit[step], step + 1
                if edit != "D":
                    out.append((conv, place, role if edit == "K" else ("user", "assistant")[(place - first) % 2], text, None))
                    place += 1
                    size += len(text)
                    if size > 1 << 24:
                        yield pack(out)
                        out, size = [], 0
            yield pack(out)
        out = []
        insert(out)
        yield pack(out)

    names = schema.names
    key_type = to_arrow_type(schema["conv_id"].dataType)
    report_type = pa.struct([*((name, pa.int64()) for name in REPORT), ("audit", pa.string())])

    def pack(out: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        types = [key_type, pa.int64(), pa.string(), pa.string(), report_type]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    return ordered.mapInArrow(run, schema)


def repaired(rows: DataFrame) -> DataFrame:
    """``conv_id, place, role, text``: the rows of every conversation after the cheapest repair, places from 0."""
    return repair_stream(rows).where("place is not null").select("conv_id", "place", "role", "text")


def digests(stream: DataFrame) -> DataFrame:
    """A row for each conversation of a :func:`repair_stream`: its report and the SHA-256 of its repaired ``role:text`` lines."""
    schema = stream.select("conv_id", "report").schema.add("repaired_sha256", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, state = None, None
        for batch in batches:
            heads, hashes = [held] if held else [], []
            told = batch.column(4)
            for i, (place, role, text) in enumerate(zip(*(batch.column(k).to_pylist() for k in (1, 2, 3)), strict=True)):
                if place is None:
                    if state is not None:
                        hashes.append(state.hexdigest())
                    state = hashlib.sha256()
                    heads.append((batch.column(0)[i], told[i]))
                else:
                    state.update((b"\n" if place else b"") + f"{role}:{text}".encode())
            held = heads.pop() if heads else held
            yield pack(heads, hashes)
        if held is not None:
            yield pack([held], [state.hexdigest()])

    key_type = to_arrow_type(schema["conv_id"].dataType)
    report_type = pa.struct([*((name, pa.int64()) for name in REPORT), ("audit", pa.string())])

    def pack(heads: list[tuple], hashes: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([h[0].as_py() for h in heads], key_type),
                                           pa.array([h[1].as_py() for h in heads], report_type), pa.array(hashes, pa.string())],
                                          ["conv_id", "report", "repaired_sha256"])

    return stream.mapInArrow(run, schema).select("conv_id", "report.*", "repaired_sha256")


def repair_report(conversations: DataFrame) -> DataFrame:
    """Damage, faults, cheapest repair and digest of every conversation.

    Nulls in any column are one space (a null id is a conversation of its own, null turns come first and count in no gap). Empty and
    blank texts are blank rows; rows that repeat another are damaged alike and the later ones duplicates; ties of turn are ordered by
    role, then by the text's first 32 characters, then by its hash. A conversation whose rows are all dropped has zeros, an empty audit and the
    empty string's hash; an empty table gives an empty result. Other columns are not read, so their names cannot clash. A very long
    conversation passes through one task as a stream, since a hash of all its text has to be taken in order.
    """
    return digests(repair_stream(damage(conversations)))


def op11_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return repair_report(spark.read.parquet(f"{sf}/conversations.parquet"))
