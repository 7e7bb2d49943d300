"""Streaming order books.

Two modes. *Timed* (:func:`book_stream`) is one keyed state per instrument, moved on by messages and by timers. The state
machine is written once more here, message by message, beside the batch form of
:mod:`tickweave.operators.book`; both give the same rows. Silence needs no later message: an event-time timer
per instrument stands at the next moment at which a book turns stale, is given up, or a request has failed. An instrument
is one sequence in one task, and messages older than the watermark are lost. *Exact* (:class:`ExactBooks`) runs the batch
operators per micro-batch on what the one before left, so that a hot instrument is cut into chunks and no message is lost;
it needs micro-batches in log order, and silence is told when the next message comes or when it is asked for.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from datetime import datetime, timezone
from decimal import ROUND_HALF_UP, Decimal
from typing import Any

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from ..functions.keys import KEYS, POSITION
from ..operators import book
from ..operators.book import INVALID, LIVE, LOADING, RESET, RESYNCHRONISING, SNAPSHOT, STALE, UNINITIALISED, UPDATE, Limits
from ..schemas import BOOK_CURRENT, BOOK_EVENT, BOOK_RESYNC, DERIVED_BOOK_METRICS, INVALID_EVENTS

Level = tuple[Decimal, Decimal]
Text = Callable[[list[Level], list[Level]], str]

_DECIMAL = "decimal(38,18)"
OUTPUT = ("kind string, exchange string, instrument string, at timestamp, from_state string, to_state string, reason string, "
          "type string, event_time timestamp, ingestion_time timestamp, trace_id string, src_partition int, src_offset long, ordinal int, "
          "checksum_verified boolean, previous_state string, book_state string, fault string, "
          f"bid {_DECIMAL}, bid_quantity {_DECIMAL}, ask {_DECIMAL}, ask_quantity {_DECIMAL}, bid_depth {_DECIMAL}, ask_depth {_DECIMAL}, depth_levels int")
_NAMES = [part.split()[0] for part in OUTPUT.split(", ")]
MOVE, BOOK = "MOVE", "BOOK"


def _digits(value: Decimal, places: int) -> str:
    return f"{value.quantize(Decimal(1).scaleb(-places), ROUND_HALF_UP):f}".replace(".", "").lstrip("0")


@dataclass(frozen=True)
class PlainText:
    """Asks' levels, then bids', each a text of its own that is made when the level is set."""

    price_precision: int
    quantity_precision: int

    def level(self, price: Decimal, quantity: Decimal) -> str:
        return _digits(price, self.price_precision) + _digits(quantity, self.quantity_precision)

    def __call__(self, bids: list[Level], asks: list[Level]) -> str:
        return "".join(self.level(p, q) for side in (asks, bids) for p, q in side[:book.CHECKSUM_LEVELS])


def plain_text(price_precision: int, quantity_precision: int) -> PlainText:
    """:func:`tickweave.operators.book.plain_digits` for one book."""
    return PlainText(price_precision, quantity_precision)


def _millis(at: datetime) -> int:
    whole = at.replace(tzinfo=timezone.utc) if at.tzinfo is None else at
    return int(whole.timestamp()) * 1000 + at.microsecond // 1000


class Machine:
    """Trust in one book: levels by side, state, and where its requests stand."""

    def __init__(self, limits: Limits, text: Text, depth: int) -> None:
        self.limits, self.text, self.depth = limits, text, depth
        self.levels: dict[str, dict[Decimal, Decimal]] = {"BID": {}, "ASK": {}}
        self.state = UNINITIALISED
        self.clock_ms: int | None = None
        self.asked_ms: int | None = None
        self.failed = self.tries = 0
        self.sequence: int | None = None
        # Of each side its prices in order and, beside each, the level and its text.
        self.sorted: dict[str, tuple[list[Decimal], list[tuple[Level, str]]]] = {}
        # Of each side its best levels, their depth and text, until a message changes it.
        self.shown: dict[str, tuple[list[Level], Decimal, str]] = {}

    def deadline(self) -> int | None:
        """When silence next moves the book."""
        if self.state == LIVE:
            return self.clock_ms + self.limits.stale_ms
        if self.state == STALE:
            return self.clock_ms + self.limits.resync_ms
        if self.state == RESYNCHRONISING:
            return self.asked_ms + (self.failed + 1) * self.limits.answer_ms
        return None

    def silence(self, until_ms: int) -> Iterator[tuple[int, str, str, str]]:
        """Moves due before ``until_ms``."""
        while (due := self.deadline()) is not None and until_ms > due:
            if self.state == LIVE:
                yield self._move(due, STALE, "SILENT")
            elif self.state == STALE:
                self._ask(due)
                yield self._move(due, RESYNCHRONISING, "SILENT")
            else:
                self.failed += 1
                yield self._move(due, INVALID, "UNANSWERED")
                if self.failed < self.limits.requests:
                    yield self._move(due, RESYNCHRONISING, "UNANSWERED")

    def _move(self, at_ms: int, target: str, reason: str) -> tuple[int, str, str, str]:
        source, self.state = self.state, target
        return at_ms, source, target, reason

    def _ask(self, at_ms: int) -> None:
        self.asked_ms, self.failed = at_ms, 0

    def _level(self, price: Decimal, quantity: Decimal) -> tuple[Level, str]:
        return (price, quantity), self.text.level(price, quantity) if isinstance(self.text, PlainText) else ""

    def _ordered(self, side: str) -> tuple[list[Decimal], list[tuple[Level, str]]]:
        if side not in self.sorted:
            held = sorted(self.levels[side].items())
            self.sorted[side] = [price for price, _ in held], [self._level(*level) for level in held]
        return self.sorted[side]

    def _set(self, side: str, price: Decimal, quantity: Decimal) -> None:
        prices, levels = self._ordered(side)
        k = bisect_left(prices, price)
        held = k < len(prices) and prices[k] == price
        if quantity > 0:
            self.levels[side][price] = quantity
            if held:
                levels[k] = self._level(price, quantity)
            else:
                prices.insert(k, price)
                levels.insert(k, self._level(price, quantity))
        elif held:
            del self.levels[side][price], prices[k], levels[k]
        self.shown.pop(side, None)

    def best(self, side: str) -> tuple[list[Level], Decimal, str]:
        if side not in self.shown:
            levels = self._ordered(side)[1]
            best = levels[-self.depth:][::-1] if side == "BID" else levels[:self.depth]
            self.shown[side] = ([level for level, _ in best], sum([level[1] for level, _ in best], Decimal(0)),
                                "".join([text for _, text in best[:book.CHECKSUM_LEVELS]]))
        return self.shown[side]

    def message(self, row: Row) -> tuple[list[tuple[int, str, str, str]], dict[str, Any]]:
        """Moves that a message brings, those of the silence before it first, and the book it leaves."""
        was = self.state
        now = _millis(row.event_time)
        if self.clock_ms is not None:
            now = max(now, self.clock_ms)
        moves = list(self.silence(now))
        self.clock_ms = now
        if row.type in (SNAPSHOT, RESET):
            self.levels, self.sorted, self.shown = {"BID": {}, "ASK": {}}, {}, {}
        negative = False
        for side, changes in (("BID", row.bids), ("ASK", row.asks)):
            for level in changes or ():
                price, quantity = level["price"], level["quantity"]
                negative |= quantity < 0
                self._set(side, price, quantity)
        (bids, bid_depth, bid_text), (asks, ask_depth, ask_text) = self.best("BID"), self.best("ASK")
        verified = None
        if row.checksum is not None:
            text = ask_text + bid_text if isinstance(self.text, PlainText) else self.text(bids, asks)
            verified = zlib.crc32(text.encode()) == row.checksum
        skipped = (self.limits.use_sequence and row.type == UPDATE and None not in (row.sequence, self.sequence) and row.sequence > self.sequence + 1)
        if row.sequence is not None:
            self.sequence = row.sequence
        fault = None
        if negative or (bids and asks and bids[0][0] >= asks[0][0]):
            fault = "IMPOSSIBLE_STATE"
        elif skipped:
            fault = "SEQUENCE_GAP"
        elif not (self.limits.trust_unchecked if verified is None else verified):
            fault = "CHECKSUM_MISMATCH"
        told = None
        if row.type == RESET:
            if self.state != UNINITIALISED:
                moves.append(self._move(now, UNINITIALISED, RESET))
        elif row.type == SNAPSHOT:
            trusted = self.state in (LIVE, STALE) and fault is None
            if not trusted and self.state != LOADING:
                moves.append(self._move(now, LOADING, SNAPSHOT))
            elif self.state == LOADING and fault and self.tries + 1 < self.limits.snapshot_tries:
                moves.append(self._move(now, LOADING, fault))
            told = fault
            if fault is None:
                self.tries = 0
                if self.state != LIVE:
                    moves.append(self._move(now, LIVE, SNAPSHOT))
            else:
                self.tries += 1
                if self.tries >= self.limits.snapshot_tries:
                    moves.append(self._move(now, INVALID, fault))
        elif self.state in (LIVE, STALE):
            told = fault
            if fault:
                moves.append(self._move(now, INVALID, fault))
            elif self.state == STALE:
                moves.append(self._move(now, LIVE, UPDATE))
        shown = self.state
        if told and self.state == INVALID:
            self._ask(now)
            moves.append(self._move(now, RESYNCHRONISING, told))
        best = {f"{name}{part}": side[0][k] if side else None for name, side in (("bid", bids), ("ask", asks)) for k, part in enumerate(("", "_quantity"))}
        return moves, {"checksum_verified": verified, "previous_state": was, "book_state": shown, "fault": told, **best,
                       "bid_depth": bid_depth, "ask_depth": ask_depth, "depth_levels": self.depth}


class BookProcessor(StatefulProcessor):
    """Keeps a :class:`Machine` per instrument: levels as map state, the rest as one value, one timer at its deadline."""

    def __init__(self, text: Text, limits: Limits, depth: int) -> None:
        self.text, self.limits, self.depth = text, limits, depth

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("machine", "state string, clock_ms long, asked_ms long, failed int, tries int, sequence long, timer_ms long")
        self.book = handle.getMapState("levels", f"side string, price {_DECIMAL}", f"quantity {_DECIMAL}")

    def _load(self) -> tuple[Machine, int | None]:
        machine, timer = Machine(self.limits, self.text, self.depth), None
        if self.held.exists():
            state, clock, asked, failed, tries, sequence, timer = self.held.get()
            machine.state, machine.clock_ms, machine.asked_ms, machine.failed, machine.tries, machine.sequence = state, clock, asked, failed, tries, sequence
        return machine, timer

    def _save(self, machine: Machine, timer: int | None) -> None:
        due = machine.deadline()
        if timer != due:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)
        self.held.update((machine.state, machine.clock_ms, machine.asked_ms, machine.failed, machine.tries, machine.sequence, due))

    @staticmethod
    def _told(key: tuple, moves: list[tuple[int, str, str, str]]) -> Iterator[Row]:
        for at_ms, source, target, reason in moves:
            at = datetime.fromtimestamp(at_ms // 1000, timezone.utc).replace(microsecond=at_ms % 1000 * 1000)
            yield _row(kind=MOVE, exchange=key[0], instrument=key[1], at=at, from_state=source, to_state=target, reason=reason)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        machine, timer = self._load()
        before: dict[tuple[str, Decimal], Decimal] = {}
        for (side, price), (quantity,) in self.book.iterator():
            before[side, price] = machine.levels[side][price] = quantity
        # A batch's rows of one instrument come in no order; how many there are is bounded by what a batch admits.
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in POSITION)):
            moves, left = machine.message(row)
            yield from self._told(key, moves)
            yield _row(kind=BOOK, **{c: row[c] for c in (*KEYS, "type", "event_time", "ingestion_time", "trace_id", *POSITION)}, **left)
        after = {(side, price): quantity for side, held in machine.levels.items() for price, quantity in held.items()}
        for level in before.keys() - after.keys():
            self.book.removeKey(level)
        for level, quantity in after.items():
            if before.get(level) != quantity:
                self.book.updateValue(level, (quantity,))
        self._save(machine, timer)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        machine, _ = self._load()
        # A timer set now fires in a later batch only, which may never come: all that the watermark has passed is due.
        until = max(expiredTimerInfo.getExpiryTimeInMs() + 1, timerValues.getCurrentWatermarkInMs())
        yield from self._told(key, list(machine.silence(until)))
        self._save(machine, None)

    def close(self) -> None:
        pass


_output = Row(*_NAMES)


def _row(**values) -> Row:
    return _output(*[values.get(name) for name in _NAMES])


def book_stream(messages: DataFrame, text: Text, limits: Limits = Limits(), depth: int = book.CHECKSUM_LEVELS, delay: str = "0 seconds") -> DataFrame:
    """Moves and rebuilt books (``kind``) of a stream of canonical book messages; ``delay`` is how late messages may come."""
    return messages.select(*BOOK_EVENT.names).withWatermark("event_time", delay).groupBy(*KEYS).transformWithState(
        BookProcessor(text, limits, depth), OUTPUT, "Append", "EventTime")


def moves(stream: DataFrame) -> DataFrame:
    """Transitions, as :func:`tickweave.operators.book.transitions` gives them."""
    return stream.where(F.col("kind") == MOVE).select(*KEYS, "at", "from_state", "to_state", "reason")


def states(stream: DataFrame) -> DataFrame:
    """Books after each message, with the columns that metrics, quarantine and current books read."""
    def best(price: str, quantity: str):
        return F.when(F.col(price).isNotNull(), F.array(F.struct(F.col(price).alias("price"), F.col(quantity).alias("quantity"))))
    return stream.where(F.col("kind") == BOOK).withColumns({"book_bids": best("bid", "bid_quantity"), "book_asks": best("ask", "ask_quantity")}) \
        .drop("kind", "at", "from_state", "to_state", "reason", "bid", "bid_quantity", "ask", "ask_quantity")


def write_books(stream: DataFrame, batch_id: int, root: str, processor_version: str = "dev") -> None:
    """Outputs of one micro-batch, each in a folder of its own that a repeated batch overwrites."""
    held = f"{root}/book.states/batch={batch_id}"
    stream.write.mode("overwrite").parquet(held)
    stored = stream.sparkSession.read.schema(stream.schema).parquet(held)
    outputs = {
        DERIVED_BOOK_METRICS: book.book_metrics(states(stored)), BOOK_RESYNC: book.resync_requests(moves(stored)),
        INVALID_EVENTS: book.book_quarantine(states(stored), processor_version), BOOK_CURRENT: book.book_current(states(stored)),
    }
    for name, rows in outputs.items():
        rows.write.mode("overwrite").parquet(f"{root}/{name}/batch={batch_id}")


def start(stream: DataFrame, root: str, checkpoint: str, processor_version: str = "dev", **trigger) -> StreamingQuery:
    return (stream.writeStream.foreachBatch(lambda batch, batch_id: write_books(batch, batch_id, root, processor_version))
            .option("checkpointLocation", checkpoint).outputMode("append").trigger(**(trigger or {"processingTime": "2 seconds"})).start())


@dataclass
class ExactBooks:
    """Exact book job over micro-batches, which must come in log order.

    Below ``root``: ``moves/batch=N``, ``states/batch=N`` and two alternating state slots. Batch N reads the slot of N-1 and
    overwrites its own, so running a batch again gives the same files.
    """

    root: str
    text: Callable[[Column, Column], Column]
    limits: Limits = Limits()
    depth: int = book.CHECKSUM_LEVELS
    chunk_messages: int = book.CHUNK_MESSAGES

    def _slot(self, batch_id: int, part: str) -> str:
        return f"{self.root}/state/{batch_id % 2}/{part}"

    def process(self, batch: DataFrame, batch_id: int) -> None:
        """The ``foreachBatch`` body."""
        spark = batch.sparkSession
        carried = None
        if batch_id > 0:
            carried = book.Carried(*[spark.read.parquet(self._slot(batch_id - 1, part)) for part in ("ends", "levels")])
        numbered = book.number(batch, self.chunk_messages, f"{self.root}/work", carried)
        verified = book.verify(numbered, self.text, self.depth, f"{self.root}/work", carried)
        path = f"{self.root}/states/batch={batch_id}"
        judged = book.book_states(verified, self.limits, carried)
        judged.write.mode("overwrite").parquet(path)
        stored = spark.read.schema(judged.schema).parquet(path)
        book.transitions(stored, self.limits).write.mode("overwrite").parquet(f"{self.root}/moves/batch={batch_id}")
        book.closing_ends(stored, carried).write.mode("overwrite").parquet(self._slot(batch_id, "ends"))
        book.closing_levels(numbered, carried).write.mode("overwrite").parquet(self._slot(batch_id, "levels"))
        spark.createDataFrame([(batch_id,)], "batch long").write.mode("overwrite").parquet(f"{self.root}/state/newest")

    def start(self, messages: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return (messages.select(*BOOK_EVENT.names).writeStream.foreachBatch(self.process).option("checkpointLocation", checkpoint)
                .trigger(**(trigger or {"processingTime": "2 seconds"})).start())

    def states(self, spark: SparkSession) -> DataFrame:
        """Books after every message so far, with their ``batch``."""
        return spark.read.parquet(f"{self.root}/states")

    def moves(self, spark: SparkSession, as_of: Column | None = None) -> DataFrame:
        """Moves so far, with ``as_of`` those too that silence has brought since each instrument's last message."""
        told = spark.read.parquet(f"{self.root}/moves").drop("batch")
        if as_of is None:
            return told
        newest = spark.read.parquet(f"{self.root}/state/newest").first()[0]
        return told.unionByName(book.silence(spark.read.parquet(self._slot(newest, "ends")), as_of, self.limits))
