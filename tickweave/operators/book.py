"""Order books from snapshot and update messages.

A book is sequential per instrument, but only inside an *epoch* (from one snapshot to the
next), and an epoch can be cut into chunks of consecutive messages: the book at a chunk's
start is the last quantity of each price level before it, which is a plain aggregate. So
chunks are rebuilt in parallel, one bounded group per task, however hot the instrument.
Trust (the state machine) is then decided by running values over the rebuilt rows.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import ids, json
from ..functions.decimals import DECIMAL, exact_mul, safe_div, zero
from ..functions.keys import KEYS, POSITION, canonical_instrument, instrument_key
from ..functions.times import parse_exchange_time, resolve_event_time
from ..schemas import NORMALIZED_BOOK, SCHEMA_VERSION
from ..session import materialise
from .dedupe import first_per_key
from .prefix import CHUNK_ROWS, Running, offset_chunk, running

SNAPSHOT, UPDATE, RESET = "SNAPSHOT", "UPDATE", "RESET"
UNINITIALISED, LOADING, LIVE = "UNINITIALISED", "LOADING_SNAPSHOT", "LIVE"
INVALID, STALE, RESYNCHRONISING = "INVALID", "STALE", "RESYNCHRONISING"

#: Messages per rebuilt chunk.
CHUNK_MESSAGES = 4_096
# Wire words and the number of levels a checksum covers.
BOOK_CHANNEL = "book"
MESSAGE_TYPES = {"snapshot": SNAPSHOT, "update": UPDATE, "connection_reset": RESET}
CHECKSUM_LEVELS = 10

_SCOPE = [*KEYS, "epoch", "chunk"]
# Epochs that lie in one chunk are rebuilt together: a snapshot or reset clears the book.
_TASK = [*KEYS, "chunk"]
_OPENING = "OPENING"


# ---------------------------------------------------------------- messages

def parse_book(envelopes: DataFrame, exchange: str = "KRAKEN") -> DataFrame:
    """Book frames to canonical messages; ``route`` is book, invalid or dead as for trades.

    Quantities are levels, so zero is legal (it removes the level); a level that is not two
    numbers makes the whole message invalid.
    """
    root = F.col("root")
    framed = envelopes.withColumn("root", json.parse_object(json.payload_text(F.col("payload")))).select(
        "*", json.text(root, "channel").alias("wire_channel"), json.text(root, "type").alias("wire_type"),
        json.elements(root, "data").alias("items"), root.isNotNull().alias("is_object")).drop("root")
    kept = [c for c in framed.columns if c != "items"]
    rows = framed.select(*kept, (F.size("items") > 0).alias("has_data"), F.posexplode_outer("items").alias("ordinal", "item"))
    item = F.col("item")
    fields = json.pull(item, ["symbol", "checksum", "timestamp", "sequence"])
    parsed = rows.select(
        *[c for c in rows.columns if c not in ("item", "ordinal")], F.coalesce("ordinal", F.lit(0)).alias("ordinal"),
        canonical_instrument(json.text_of(fields["symbol"])).alias("parsed"),
        F.try_variant_get(fields["checksum"], "$", "bigint").alias("checksum"),
        F.try_variant_get(fields["sequence"], "$", "bigint").alias("sequence"),
        parse_exchange_time(json.text_of(fields["timestamp"])).alias("exchange_time"),
        _levels(item, "bids").alias("bids"), _levels(item, "asks").alias("asks"))
    kind = F.lit(None).cast("string")
    for word, label in MESSAGE_TYPES.items():
        kind = F.when(F.col("wire_type") == word, label).otherwise(kind)
    bad_level = F.exists(F.concat("bids", "asks"), lambda level: level["price"].isNull() | level["quantity"].isNull())
    reason = (
        F.when(F.col("wire_channel").isNull() | (F.col("wire_channel") != BOOK_CHANNEL), "UNKNOWN_TYPE")
        .when(kind.isNull() | ~F.coalesce("has_data", F.lit(False)) | F.col("parsed").isNull() | bad_level, "SCHEMA_INVALID"))
    resolved = resolve_event_time(F.col("exchange_time"), F.col("received_at"))
    routed = parsed.withColumns({"type": kind, "reason": F.when(F.col("is_object"), reason)})
    return routed.select(
        F.when(~F.col("is_object"), "dead").when(F.col("reason").isNotNull(), "invalid").otherwise("book").alias("route"),
        "reason", F.lit(exchange).alias("exchange"), F.col("parsed").alias("instrument"), "type",
        resolved["event_time"].alias("event_time"), F.col("received_at").alias("ingestion_time"), "bids", "asks",
        "checksum", "sequence", "trace_id", "src_partition", "src_offset", "ordinal", "payload", "record_key")


def _levels(item: Column, side: str) -> Column:
    raw = F.coalesce(F.try_variant_get(item, f"$.{side}", "array<variant>"), F.array().cast("array<variant>"))

    def number(level: Column, name: str) -> Column:
        value = F.try_variant_get(level, f"$.{name}", "variant")
        return json.number(value, json.kind(value)).try_cast(DECIMAL)
    return F.transform(raw, lambda level: F.struct(
        number(level, "price").alias("price"), number(level, "qty").alias("quantity")))


def book_messages(parsed: DataFrame) -> DataFrame:
    return parsed.where("route = 'book'").drop("route", "reason", "payload", "record_key")


def union_book_events(snapshots: DataFrame, updates: DataFrame) -> DataFrame:
    """Snapshots and updates on one canonical stream."""
    return snapshots.withColumn("type", F.lit(SNAPSHOT)).unionByName(
        updates.withColumn("type", F.lit(UPDATE)), allowMissingColumns=True)


def idempotent_updates(messages: DataFrame) -> DataFrame:
    """Drop messages whose ``sequence`` does not advance the instrument.

    Only for sources that number their updates; rows without a number pass.
    """
    numbered = running(messages, KEYS, offset_chunk(), POSITION, {"__seen": Running("max", "sequence", before=True)})
    fresh = F.col("sequence").isNull() | F.col("__seen").isNull() | (F.col("sequence") > F.col("__seen"))
    return numbered.where(fresh).drop("__seen")


# ---------------------------------------------------------------- rebuilding

@dataclass(frozen=True)
class Carried:
    """Where the messages before these left each instrument, so that a log can be worked on part by part.

    ``ends`` has a row per instrument, as :func:`closing_ends` gives them, ``levels`` its book's levels, as :func:`closing_levels` does.
    """

    ends: DataFrame
    levels: DataFrame


def number_messages(messages: DataFrame, chunk_messages: int = CHUNK_MESSAGES, carried: Carried | None = None) -> DataFrame:
    """Add ``epoch, snapshot_no, message_no, chunk, clock, previous_time, previous_sequence``.

    Epochs start at each snapshot or reset. ``clock`` is the latest event time so far, which never runs back;
    ``previous_time`` is what it was before the message.
    """
    flagged = messages.withColumns({
        "__start": F.col("type").isin(SNAPSHOT, RESET).cast("long"),
        "__snap": (F.col("type") == SNAPSHOT).cast("long"), "__one": F.lit(1).cast("long"),
        "__at": F.col("event_time"), "__sequence": F.col("sequence")})
    counted = running(flagged, KEYS, offset_chunk(), POSITION, {
        "epoch": Running("sum", "__start"), "snapshot_no": Running("sum", "__snap"), "message_no": Running("sum", "__one"),
        "clock": Running("max", "__at"), "previous_time": Running("max", "__at", before=True),
        "previous_sequence": Running("last", "__sequence", before=True)},
        # A chunk lies in one partition, so that offset and ordinal order it.
        within=F.expr(f"shiftleft(src_offset % {CHUNK_ROWS}, 32) + ordinal"),
        carried=carried and carried.ends.select(*KEYS, F.col("epoch").alias("__start"), F.col("snapshot_no").alias("__snap"), F.col("message_no").alias("__one"),
                                                F.col("clock").alias("__at"), F.col("sequence").alias("__sequence")))
    return counted.withColumn("chunk", F.expr(f"(message_no - 1) div {chunk_messages}")).drop(
        "__start", "__snap", "__one", "__at", "__sequence")


def level_changes(numbered: DataFrame) -> DataFrame:
    """One row per level a message sets: ``side, price, quantity`` and ``set_order``, which tells which came later."""
    def tagged(name: str, side: str) -> Column:
        return F.transform(F.coalesce(name, F.array().cast("array<struct<price:decimal(38,18),quantity:decimal(38,18)>>")),
                           lambda level: F.struct(F.lit(side).alias("side"), level["price"].alias("price"),
                                                  level["quantity"].alias("quantity")))
    both = F.concat(tagged("bids", "BID"), tagged("asks", "ASK"))
    # One number, which keeps the aggregates on it hashed; a row of Spark's cannot hold 2^26 levels.
    return numbered.select(*_SCOPE, "message_no", F.posexplode(both).alias("place", "level")).select(
        *_SCOPE, F.expr("shiftleft(message_no, 26) + place").alias("set_order"), "level.*")


def opening_levels(numbered: DataFrame, carried: Carried | None = None) -> DataFrame:
    """Levels alive when each chunk starts: the last quantity before it, if above zero."""
    spans = numbered.select(*KEYS, "epoch", "chunk")
    if carried is not None:
        # The book before the first message is one of a chunk before the first.
        firsts = numbered.groupBy(*KEYS).agg((F.min("chunk") - 1).alias("chunk"))
        held = carried.levels.join(firsts, list(KEYS)).select(*_SCOPE, "side", "price", "quantity")
        spans = spans.unionByName(held.select(*KEYS, "epoch", "chunk"))
    # Only epochs that go on in another chunk have levels to hand on.
    ends = spans.groupBy(*KEYS, "epoch").agg(F.max("chunk").alias("__end"), F.min("chunk").alias("__first")).where("__first < __end").drop("__first")
    going = numbered.join(ends.select(*KEYS, "epoch"), [*KEYS, "epoch"], "left_semi")
    last = level_changes(going).groupBy(*_SCOPE, "side", "price").agg(F.max_by("quantity", "set_order").alias("quantity"))
    if carried is not None:
        last = last.unionByName(held)
    level = Window.partitionBy(*KEYS, "epoch", "side", "price").orderBy("chunk")
    spans = last.withColumn("__next", F.lead("chunk").over(level)).join(ends, [*KEYS, "epoch"])
    until = F.coalesce("__next", "__end")
    alive = spans.where((F.col("quantity") > 0) & (until > F.col("chunk")))
    return alive.select(*KEYS, "epoch", "side", "price", "quantity",
                        F.explode(F.sequence(F.col("chunk") + 1, until)).alias("chunk"))


def _rebuilder(kept: list[str], position: tuple[str, ...], depth: int, digested: int | None = None) -> Callable:
    """The per-chunk rebuild. Its helpers live inside so that they travel to the workers by
    value: executors need pyarrow, not this package.

    Levels are numbers all along, their place among the chunk's levels and the rank of their price; prices and
    quantities are only looked up for the result. ``digested`` is how many levels' texts a checksum covers: then books
    leave as their best level, depth and checksum. A side that a message leaves alone is not looked at again.
    """
    import zlib

    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def unscaled(column):
        """Decimals as whole numbers."""
        halves = np.frombuffer(column.buffers()[1], np.int64)[2 * column.offset:2 * (column.offset + len(column))] if len(column) else np.empty(0, np.int64)
        return [(high << 64) + low for low, high in zip(halves[::2].view(np.uint64).tolist(), halves[1::2].tolist())]

    def scaled(numbers, kind):
        if any(abs(n) >= 10 ** kind.precision for n in set(numbers)):
            raise OverflowError(f"a depth does not fit {kind}")
        return pa.Array.from_buffers(kind, len(numbers), [None, pa.py_buffer(b"".join([n.to_bytes(16, "little", signed=True) for n in numbers]))])

    class Side:
        """The messages' levels of one side, and the book of it as ranks in price order."""

        def __init__(self, column, best_is_high):
            column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
            self.levels, self.best_is_high = column.flatten(), best_is_high
            counts = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False)
            self.starts = np.concatenate([[0], np.cumsum(counts)]).tolist()
            prices = self.levels.field("price").dictionary_encode()
            order = pc.array_sort_indices(prices.dictionary).to_numpy()
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            quantities = self.levels.field("quantity")
            self.ranks = rank[prices.indices.to_numpy()].tolist()
            self.held = pc.greater(quantities, pa.scalar(0, quantities.type)).to_pylist()
            self.below = np.concatenate([[0], np.cumsum(pc.less(quantities, pa.scalar(0, quantities.type)).to_numpy(zero_copy_only=False))])
            if digested is not None:
                self.amounts, self.amount_type = unscaled(quantities), quantities.type
                self.texts = [text or "" for text in self.levels.field("text").to_pylist()]
                self.total, self.text, self.totals = 0, "", []
            self.chosen, self.ends = [], [0]
            self.clear()

        def clear(self):
            self.at, self.order, self.best, self.changed = {}, [], [], True

        def apply(self, message):
            for k in range(self.starts[message], self.starts[message + 1]):
                rank, self.changed = self.ranks[k], True
                if self.held[k]:
                    if rank not in self.at:
                        insort(self.order, rank)
                    self.at[rank] = k
                elif self.at.pop(rank, None) is not None:
                    del self.order[bisect_left(self.order, rank)]

        def look(self):
            """Whether the side may be another than it was shown."""
            if not self.changed:
                return False
            best = self.order[-depth:][::-1] if self.best_is_high else self.order[:depth]
            self.best, self.changed = [self.at[rank] for rank in best], False
            if digested is not None:
                self.total = sum([self.amounts[k] for k in self.best])
                self.text = "".join([self.texts[k] for k in self.best[:digested]])
                del self.best[1:]
            return True

        def show(self):
            self.chosen += self.best
            self.ends.append(len(self.chosen))
            if digested is not None:
                self.totals.append(self.total)

        def negative(self):
            starts = np.array(self.starts)
            return self.below[starts[1:]] > self.below[starts[:-1]]

        def books(self, kind):
            levels = self.levels.take(pa.array(self.chosen, pa.int64()))
            plain = pa.StructArray.from_arrays([levels.field(name) for name in ("price", "quantity")], names=["price", "quantity"])
            return pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), plain).cast(kind)

    def rebuild(chunk: pa.Table) -> pa.Table:
        chunk = chunk.sort_by([(c, "ascending") for c in position])
        bids, asks = sides = Side(chunk["bids"], True), Side(chunk["asks"], False)
        kinds = chunk["type"].to_pylist()
        checksum, checksums = 0, []
        for message, kind in enumerate(kinds):
            for side in sides:
                if kind in (SNAPSHOT, RESET):
                    side.clear()
                side.apply(message)
            if kind != _OPENING:
                looked = [side.look() for side in sides]
                for side in sides:
                    side.show()
                if digested is not None:
                    if any(looked):
                        checksum = zlib.crc32((asks.text + bids.text).encode())
                    checksums.append(checksum)
        real = pa.array([kind != _OPENING for kind in kinds], pa.bool_())
        rows = chunk.filter(real)
        negative = pa.array(bids.negative() | asks.negative()).filter(real)
        level = chunk.schema.field("bids").type.value_type
        plain = pa.list_(pa.struct([level.field("price"), level.field("quantity")]))
        told = {**{c: rows[c] for c in kept}, "book_bids": bids.books(plain), "book_asks": asks.books(plain), "negative": negative}
        if digested is not None:
            told |= {"bid_depth": scaled(bids.totals, bids.amount_type), "ask_depth": scaled(asks.totals, asks.amount_type),
                     "computed_checksum": pa.array(checksums, pa.int64())}
        return pa.table(told)

    return rebuild


def closing_levels(numbered: DataFrame, carried: Carried | None = None) -> DataFrame:
    """Levels alive at the end of each instrument's last epoch."""
    epochs = numbered.select(*KEYS, "epoch")
    if carried is not None:
        epochs = epochs.unionByName(carried.ends.select(*KEYS, "epoch"))
    last = epochs.groupBy(*KEYS).agg(F.max("epoch").alias("epoch"))
    changes = level_changes(numbered.join(last, [*KEYS, "epoch"], "left_semi")).drop("chunk")
    if carried is not None:
        held = carried.levels.join(last, [*KEYS, "epoch"], "left_semi")
        changes = changes.unionByName(held.withColumn("set_order", F.lit(0).cast("long")))
    final = changes.groupBy(*KEYS, "epoch", "side", "price").agg(F.max_by("quantity", "set_order").alias("quantity"))
    return final.where(F.col("quantity") > 0)


def apply_deltas(numbered: DataFrame, depth: int = CHECKSUM_LEVELS, text: LevelText | None = None, carried: Carried | None = None) -> DataFrame:
    """Numbered messages with the book after each: replace ``bids`` and ``asks``
    by ``book_bids`` and ``book_asks``, the best levels.

    Also adds ``negative``: some quantity of the message is below zero (such a level is removed). With ``text`` the books
    are only their best level, beside ``bid_depth``, ``ask_depth`` and ``computed_checksum``.
    """
    kept = [c for c in numbered.columns if c not in ("bids", "asks")]
    fields = numbered.schema
    out = T.StructType([*[fields[c] for c in kept], T.StructField("book_bids", fields["bids"].dataType),
                        T.StructField("book_asks", fields["bids"].dataType), T.StructField("negative", T.BooleanType())])
    if text is not None:
        quantity = fields["bids"].dataType.elementType["quantity"].dataType
        out = out.add("bid_depth", quantity).add("ask_depth", quantity).add("computed_checksum", T.LongType())
    # A chunk's opening levels travel as one more message, ahead of the others.
    opening = opening_levels(numbered, carried).groupBy(*_SCOPE).agg(
        *[F.collect_list(F.when(F.col("side") == side, F.struct("price", "quantity"))).alias(name)
          for side, name in (("BID", "bids"), ("ASK", "asks"))]).select(
        "*", F.lit(_OPENING).alias("type"), *[F.lit(-1).cast(fields[c].dataType).alias(c) for c in POSITION])
    rows = numbered.unionByName(opening, allowMissingColumns=True)
    if text is not None:
        # Worked out once for each level that is set, not for each book it is part of.
        rows = rows.withColumns({side: F.transform(side, lambda level: F.struct(
            level["price"].alias("price"), level["quantity"].alias("quantity"), F.when(level["quantity"] > 0, text.level(level)).alias("text")))
            for side in ("bids", "asks")})
    return rows.groupBy(*_TASK).applyInArrow(_rebuilder(kept, POSITION, depth, None if text is None else CHECKSUM_LEVELS), out)


# ---------------------------------------------------------------- checksum

def digits(value: Column, precision: int) -> Column:
    """A number at fixed precision without its point and leading zeros."""
    fixed = value.cast(f"decimal(38,{precision})").cast("string")
    return F.ltrim(F.translate(fixed, ".", ""), F.lit("0"))


@dataclass(frozen=True)
class LevelText:
    """Checksum text made of a text for each level: asks then bids, best first."""

    level: Callable[[Column], Column]

    def __call__(self, bids: Column, asks: Column) -> Column:
        def side(levels: Column) -> Column:
            return F.array_join(F.transform(F.slice(levels, 1, CHECKSUM_LEVELS), lambda level: self.level(level)), "")
        return F.concat(side(asks), side(bids))


def plain_digits(price_precision: int, quantity_precision: int) -> LevelText:
    """Checksum text: asks then bids, best first, price digits then quantity digits.

    The exact text is exchange-specific; pass another :class:`LevelText`, or a function of both sides, where it differs.
    """
    return LevelText(lambda level: F.concat(digits(level["price"], price_precision), digits(level["quantity"], quantity_precision)))


def checksum_verify(rebuilt: DataFrame, text: Callable[[Column, Column], Column]) -> DataFrame:
    """Add ``computed_checksum`` of the rebuilt book and ``checksum_verified``: true or false, NULL when the message carries no checksum."""
    return _compared(rebuilt.withColumn("computed_checksum", F.crc32(text(F.col("book_bids"), F.col("book_asks")).cast("binary"))))


def _compared(rebuilt: DataFrame) -> DataFrame:
    return rebuilt.withColumn("checksum_verified", F.when(F.col("checksum").isNotNull(), F.col("checksum") == F.col("computed_checksum")))


# ---------------------------------------------------------------- trust

@dataclass(frozen=True)
class Limits:
    """When a book is no longer trusted.

    Above ``stale_ms`` without a message a live book is stale, above ``resync_ms`` a fresh snapshot is asked for. A request
    that is not met within ``answer_ms`` has failed; it is made ``requests`` times in all, then the book stays invalid.
    ``snapshot_tries`` failed snapshots in a row are given up. Messages without a checksum are not trusted unless
    ``trust_unchecked``; ``use_sequence`` is for sources that number their messages.
    """

    stale_ms: int = 10_000
    resync_ms: int = 60_000
    answer_ms: int = 30_000
    requests: int = 3
    snapshot_tries: int = 3
    use_sequence: bool = False
    trust_unchecked: bool = False


def _failed_requests(asked_ms: Column, now_ms: Column, limits: Limits) -> Column:
    """How many requests, the first at ``asked_ms``, have failed by ``now_ms``."""
    return F.greatest(F.lit(0), F.least(F.lit(limits.requests), F.ceil((now_ms - asked_ms) / limits.answer_ms) - 1)).cast("int")


def _marked(verified: DataFrame, limits: Limits) -> DataFrame:
    """Messages with their faults, and where they break a book or are a snapshot to trust."""
    kind = F.col("type")
    skipped = F.lit(limits.use_sequence) & (kind == UPDATE) & (F.col("sequence") > F.col("previous_sequence") + 1)
    fault = (
        F.when(F.col("negative") | F.col("crossed"), "IMPOSSIBLE_STATE")
        .when(F.coalesce(skipped, F.lit(False)), "SEQUENCE_GAP")
        .when(~F.coalesce("checksum_verified", F.lit(limits.trust_unchecked)), "CHECKSUM_MISMATCH"))
    now_ms, before_ms = F.unix_millis("clock"), F.unix_millis("previous_time")
    judged = verified.withColumns({"gap_ms": now_ms - before_ms, "__fault": F.when(kind != RESET, fault)})
    silent = (kind == UPDATE) & F.coalesce(F.col("gap_ms") > limits.resync_ms, F.lit(False))
    breaks = judged.withColumn("__as", (
        F.when(kind == RESET, RESET).when((kind == SNAPSHOT) & F.col("__fault").isNotNull(), SNAPSHOT)
        .when(silent, STALE).when(F.col("__fault").isNotNull(), INVALID)))
    # The highest of these is the first break of the latest broken epoch.
    return breaks.withColumns({
        "__break": F.when(F.col("__as").isNotNull(), F.struct(
            "epoch", (-F.col("message_no")).alias("nearness"), F.col("__as").alias("kind"),
            F.when(F.col("__as") == STALE, before_ms + limits.resync_ms).otherwise(now_ms).alias("at_ms"))),
        "__good": F.when((kind == SNAPSHOT) & F.col("__fault").isNull(), F.col("snapshot_no"))})


def closing_ends(states: DataFrame, carried: Carried | None = None) -> DataFrame:
    """Per instrument the running values after its last message, and the state that left it in."""
    ends = states.where("is_last").select(*KEYS, "epoch", "snapshot_no", "message_no", "clock", F.coalesce("sequence", "previous_sequence").alias("sequence"),
                                          F.struct("settled_state", "asked_ms").alias("left"), "broke", "last_good")
    # An instrument's newest row counts; most have one alone.
    rows = ends if carried is None else ends.unionByName(carried.ends)
    return first_per_key(rows, KEYS, F.desc("message_no"))


def book_states(verified: DataFrame, limits: Limits = Limits(), carried: Carried | None = None) -> DataFrame:
    """Add ``book_state``, ``previous_state``, ``settled_state``, ``fault``, ``asked_ms``, ``previous_asked_ms``, ``gap_ms``, ``is_last``,
    ``broke`` and ``last_good`` to each message.

    Inside an epoch only the first break counts: after it the book is not trusted until the
    next snapshot, so later rows need no faults of their own. So the state at a row follows
    from the latest break before it, one running value, and from the time since. A gap above
    ``stale_ms`` is STALE in between and recovers with the next verified update; above ``resync_ms``
    it is a break. ``settled_state`` is the state once the message took full effect: an INVALID
    book has already asked for a snapshot, at ``asked_ms``. ``previous_state`` and
    ``previous_asked_ms`` are the same of the message before. ``is_last`` marks an instrument's last message, ``broke`` and
    ``last_good`` are the latest break and trusted snapshot so far.
    """
    kind = F.col("type")
    now_ms, before_ms = F.unix_millis("clock"), F.unix_millis("previous_time")
    linked = running(_marked(verified, limits), KEYS, F.col("chunk"), ["message_no"], {
        "__before": Running("max", "__break", before=True), "__last_good": Running("max", "__good", before=True), "__no": Running("max", "message_no")},
        whole={"__end": "message_no"},
        carried=carried and carried.ends.select(*KEYS, F.col("broke").alias("__break"), F.col("last_good").alias("__good"), "message_no"))

    tries = F.col("snapshot_no") - F.coalesce("__last_good", F.lit(0))
    starts = kind.isin(SNAPSHOT, RESET)
    earlier_epoch = F.col("epoch") - starts.cast("long")
    earlier_tries = tries - (kind == SNAPSHOT).cast("long")
    before = F.col("__before")

    def asks(break_kind: Column, attempts: Column) -> Column:
        return (break_kind != RESET) & ((break_kind != SNAPSHOT) | (attempts >= limits.snapshot_tries))

    def settled(broke: Column, attempts: Column, at_ms: Column) -> Column:
        """State an epoch is left in by its first break, at a later time."""
        return (F.when(broke["kind"] == RESET, UNINITIALISED).when(~asks(broke["kind"], attempts), LOADING)
                .when(_failed_requests(broke["at_ms"], at_ms, limits) >= limits.requests, INVALID).otherwise(RESYNCHRONISING))

    own = F.col("__break")
    broken = F.coalesce(before["epoch"] == F.col("epoch"), F.lit(False))
    was_broken = F.coalesce(before["epoch"] == earlier_epoch, F.lit(False))
    first_break = ~broken & (F.col("epoch") > 0) & F.col("__as").isNotNull() & (F.col("__as") != RESET)
    arrives = F.when(F.col("__as").isin(INVALID, SNAPSHOT) & asks(own["kind"], tries), INVALID).otherwise(settled(own, tries, now_ms))
    untouched = F.col("epoch") == 0
    result = linked.withColumns({
        "book_state": F.when(untouched, UNINITIALISED).when(broken, settled(before, tries, now_ms))
                       .when(F.col("__as").isNull(), LIVE).otherwise(arrives),
        "settled_state": F.when(untouched, UNINITIALISED).when(broken, settled(before, tries, now_ms))
                          .when(F.col("__as").isNull(), LIVE).otherwise(settled(own, tries, now_ms)),
        "previous_state": F.when(earlier_epoch == 0, UNINITIALISED)
                           .when(was_broken, settled(before, earlier_tries, before_ms)).otherwise(LIVE),
        "asked_ms": F.when(untouched, None).when(broken & asks(before["kind"], tries), before["at_ms"])
                     .when(~broken & asks(own["kind"], tries), own["at_ms"]),
        "previous_asked_ms": F.when((earlier_epoch > 0) & was_broken & asks(before["kind"], earlier_tries), before["at_ms"]),
        "fault": F.when(first_break & (F.col("__as") != STALE), F.col("__fault")),
        "is_last": F.col("message_no") == F.col("__end"),
        # What later messages have to know of these.
        "broke": F.greatest("__before", "__break"), "last_good": F.greatest("__last_good", "__good"),
    })
    return result.drop(*[c for c in result.columns if c.startswith("__")])


def reconstruct(messages: DataFrame, text: Callable[[Column, Column], Column], depth: int = CHECKSUM_LEVELS,
                chunk_messages: int = CHUNK_MESSAGES, limits: Limits = Limits()) -> DataFrame:
    """Messages to rebuilt, verified and judged books."""
    return judge(number(messages, chunk_messages), text, depth, limits=limits)


def number(messages: DataFrame, chunk_messages: int = CHUNK_MESSAGES, folder: str | None = None, carried: Carried | None = None) -> DataFrame:
    """:func:`number_messages`, written out: the rebuild, its opening levels and their spans all read it."""
    return materialise(number_messages(messages, chunk_messages, carried), "book-numbered", folder)


def judge(numbered: DataFrame, text: Callable[[Column, Column], Column], depth: int = CHECKSUM_LEVELS,
          folder: str | None = None, limits: Limits = Limits()) -> DataFrame:
    """Books of numbered messages and their states."""
    return book_states(verify(numbered, text, depth, folder), limits)


def verify(numbered: DataFrame, text: Callable[[Column, Column], Column], depth: int = CHECKSUM_LEVELS,
           folder: str | None = None, carried: Carried | None = None) -> DataFrame:
    """Books of numbered messages, reduced to their best levels and depth before they are stored."""
    if isinstance(text, LevelText):
        narrow = _compared(apply_deltas(numbered, depth, text, carried)).withColumn("depth_levels", F.lit(depth))
    else:
        rebuilt = checksum_verify(apply_deltas(numbered, depth, carried=carried), text)
        bids, asks = F.col("book_bids"), F.col("book_asks")
        narrow = rebuilt.withColumns({
            "bid_depth": depth_of(bids, depth), "ask_depth": depth_of(asks, depth), "depth_levels": F.lit(depth),
            "book_bids": F.slice(bids, 1, 1), "book_asks": F.slice(asks, 1, 1)})
    # States need of the levels only whether they cross, and are spared reading them.
    bid, ask = F.get("book_bids", F.lit(0))["price"], F.get("book_asks", F.lit(0))["price"]
    narrow = narrow.withColumn("crossed", F.coalesce(bid >= ask, F.lit(False)))
    # The running values read the books twice; rebuilding them twice would cost more.
    return materialise(narrow, "book-rebuilt", folder)


_MOVE = "struct<at_ms: bigint, from_state: string, to_state: string, reason: string>"


def _move(condition: Column, at_ms: Column, source: Column | str, target: Column | str, reason: Column | str) -> Column:
    source, target, reason = (F.lit(x) if isinstance(x, str) else x for x in (source, target, reason))
    return F.when(condition, F.struct(at_ms.alias("at_ms"), source.alias("from_state"), target.alias("to_state"), reason.alias("reason")))


def _silence(state: Column, since_ms: Column, asked_ms: Column, until_ms: Column, limits: Limits) -> tuple[Column, Column]:
    """Moves of a book without messages from ``since_ms``, when it is in ``state``, to ``until_ms``; and the state it is then in."""
    gap = until_ms - since_ms
    stale = F.coalesce((state == LIVE) & (gap > limits.stale_ms), F.lit(False))
    gave_up = F.coalesce(stale & (gap > limits.resync_ms), F.lit(False))
    asked = F.when(gave_up, since_ms + limits.resync_ms).when(state == RESYNCHRONISING, asked_ms)
    first = F.when(gave_up, 0).otherwise(_failed_requests(asked, since_ms, limits)) + 1
    last = F.coalesce(_failed_requests(asked, until_ms, limits), F.lit(0))
    failed = F.when(asked.isNotNull() & (last >= first), F.sequence(first, last)).otherwise(F.array().cast("array<int>"))
    # A request that has failed is made again at once, until they are used up.
    unanswered = F.flatten(F.transform(failed, lambda k: F.array(
        F.struct((asked + k * limits.answer_ms).alias("at_ms"), F.lit(RESYNCHRONISING).alias("from_state"), F.lit(INVALID).alias("to_state"),
                 F.lit("UNANSWERED").alias("reason")),
        _move(k < limits.requests, asked + k * limits.answer_ms, INVALID, RESYNCHRONISING, "UNANSWERED"))))
    moves = F.concat(F.array(
        _move(stale, since_ms + limits.stale_ms, LIVE, STALE, "SILENT"),
        _move(gave_up, since_ms + limits.resync_ms, STALE, RESYNCHRONISING, "SILENT")), unanswered.cast(f"array<{_MOVE}>"))
    waiting = F.when(last >= limits.requests, INVALID).otherwise(RESYNCHRONISING)
    return moves, F.when(asked.isNotNull(), waiting).when(stale, STALE).otherwise(state)


def transitions(states: DataFrame, limits: Limits = Limits(), as_of: Column | None = None, every: bool = False) -> DataFrame:
    """Every change of state: ``exchange, instrument, at, from_state, to_state, reason``.

    Silence moves books too, between messages and, with ``as_of``, after an instrument's last one. ``every`` also gives the
    updates that leave a live book live. One pass.
    """
    kind, now = F.col("type"), F.col("book_state")
    now_ms = F.unix_millis("clock")
    silent, came = _silence(F.col("previous_state"), F.unix_millis("previous_time"), F.col("previous_asked_ms"), now_ms, limits)
    snapshot = kind == SNAPSHOT
    # A snapshot is loaded first, unless it replaces the book of a live or stale one.
    loads = snapshot & ~(came.isin(LIVE, STALE) & (now == LIVE)) & (came != LOADING)
    loading = snapshot & ~(came.isin(LIVE, STALE) & (now == LIVE))
    reason = F.coalesce("fault", kind)
    arriving = F.array(
        _move(loads, now_ms, came, LOADING, kind), _move(loading & (came == LOADING) & (now == LOADING), now_ms, LOADING, LOADING, reason),
        _move(loading & (now != LOADING), now_ms, LOADING, now, reason),
        _move(~loading & (came != now), now_ms, came, now, reason),
        _move((now == INVALID) & (F.col("settled_state") == RESYNCHRONISING), now_ms, INVALID, RESYNCHRONISING, reason),
        _move(F.lit(every) & (kind == UPDATE) & (came == LIVE) & (now == LIVE), now_ms, LIVE, LIVE, kind))
    moves = [silent, arriving.cast(f"array<{_MOVE}>")]
    if as_of is not None:
        after, _ = _silence(F.col("settled_state"), now_ms, F.col("asked_ms"), F.unix_millis(as_of), limits)
        moves.append(F.when(F.col("is_last"), after).otherwise(F.array().cast(f"array<{_MOVE}>")))
    # Most messages move nothing and are spared the arrays: none of these moves without one of the conditions.
    may_move = ((kind == SNAPSHOT) | (F.col("previous_state") != now) | now.isin(INVALID, RESYNCHRONISING) | (F.col("previous_state") == RESYNCHRONISING)
                | (now_ms - F.unix_millis("previous_time") > limits.stale_ms) | F.col("is_last") | F.lit(every))
    return _told(states.where(may_move), F.concat(*moves))


def silence(ends: DataFrame, as_of: Column, limits: Limits = Limits()) -> DataFrame:
    """Moves that silence has brought by ``as_of`` after each instrument's last message, from :func:`closing_ends`."""
    after, _ = _silence(F.col("left.settled_state"), F.unix_millis("clock"), F.col("left.asked_ms"), F.unix_millis(as_of), limits)
    return _told(ends, after)


def _told(rows: DataFrame, moves: Column) -> DataFrame:
    return rows.select(*KEYS, F.inline(F.filter(moves, lambda m: m.isNotNull()))).select(
        *KEYS, F.timestamp_millis("at_ms").alias("at"), "from_state", "to_state", "reason")


def resync_requests(moves: DataFrame) -> DataFrame:
    """Control rows asking for a fresh snapshot, one for each time a book of :func:`transitions` began to wait for one."""
    key = instrument_key(F.col("exchange"), F.col("instrument"))
    name = F.concat(F.lit("resync:"), key, F.lit(":"), F.unix_millis("at").cast("string"), F.lit(":"), F.col("from_state"))
    return moves.where(F.col("to_state") == RESYNCHRONISING).select(
        ids.uuid3(name).alias("event_id"), *KEYS, F.col("at").alias("requested_at"), F.col("from_state").alias("book_state"), "reason")


def book_quarantine(states: DataFrame, processor_version: str) -> DataFrame:
    """Messages that broke a book, as quarantine records."""
    key = instrument_key(F.col("exchange"), F.col("instrument"))
    place = F.concat(*[part for c in POSITION for part in (F.lit(":"), F.col(c).cast("string"))])
    return states.where(F.col("fault").isNotNull()).select(
        ids.uuid3(F.concat(F.lit("invalid-book:"), key, place)).alias("event_id"),
        F.col("ingestion_time").alias("occurred_at"), F.lit("BOOK_APPLY").alias("stage"), F.col("fault").alias("reason"),
        F.col("type").alias("error_class"), F.lit(NORMALIZED_BOOK).alias("original_topic"), key.alias("original_key"),
        F.lit(None).cast("binary").alias("original_payload"), "instrument", "trace_id",
        F.lit(processor_version).alias("processor_version"), F.lit(SCHEMA_VERSION).alias("schema_version"))


# ---------------------------------------------------------------- metrics

def depth_of(levels: Column, depth: int) -> Column:
    return F.aggregate(F.slice(levels, 1, depth), zero(), lambda total, level: (total + level["quantity"]).cast(DECIMAL))


def with_metrics(states: DataFrame) -> DataFrame:
    """Top-of-book and depth measures; NULL unless the book is LIVE."""
    live = F.col("book_state") == LIVE
    bid, ask = F.get("book_bids", F.lit(0)), F.get("book_asks", F.lit(0))
    tops = states.withColumns({
        "best_bid": F.when(live, bid["price"]), "best_ask": F.when(live, ask["price"]),
        "__bid_qty": bid["quantity"], "__ask_qty": ask["quantity"],
        "bid_depth": F.when(live, F.col("bid_depth")), "ask_depth": F.when(live, F.col("ask_depth")),
    })
    best_bid, best_ask = F.col("best_bid"), F.col("best_ask")
    two = F.lit(2).cast(DECIMAL)
    measured = tops.withColumns({
        "mid_price": F.when(best_bid.isNotNull() & best_ask.isNotNull(), safe_div((best_bid + best_ask).cast(DECIMAL), two)),
        "spread": (best_ask - best_bid).cast(DECIMAL),
        "__weighted": (exact_mul(best_bid, F.col("__ask_qty")) + exact_mul(best_ask, F.col("__bid_qty"))).cast(DECIMAL),
        "__top_qty": (F.col("__bid_qty") + F.col("__ask_qty")).cast(DECIMAL),
        "__depth": (F.col("bid_depth") + F.col("ask_depth")).cast(DECIMAL),
    })
    both = F.col("mid_price").isNotNull()
    return measured.withColumns({
        "spread_bps": F.when(both, safe_div((F.col("spread") * F.lit(10_000).cast("decimal(5,0)")).cast(DECIMAL), F.col("mid_price"))),
        # Each side's price weighted by the other side's size.
        "weighted_mid": F.when(both, safe_div(F.col("__weighted"), F.col("__top_qty"))),
        "imbalance": F.when(live, safe_div((F.col("bid_depth") - F.col("ask_depth")).cast(DECIMAL), F.col("__depth"))),
    }).drop("__bid_qty", "__ask_qty", "__weighted", "__top_qty", "__depth")


METRICS = ("best_bid", "best_ask", "mid_price", "spread", "spread_bps", "weighted_mid", "bid_depth", "ask_depth",
           "depth_levels", "imbalance")


def book_metrics(states: DataFrame) -> DataFrame:
    """Trusted metrics: one row per message that left the book LIVE."""
    return with_metrics(states.where(F.col("book_state") == LIVE)).select(
        *KEYS, "event_time", "trace_id", *POSITION, "book_state", *METRICS,
        F.coalesce("checksum_verified", F.lit(False)).alias("checksum_verified"))


def book_current(states: DataFrame, as_of: Column | None = None, limits: Limits = Limits()) -> DataFrame:
    """Latest state and measures per instrument; ``as_of`` a later time, silence has moved the state on."""
    latest = states.where("is_last") if "is_last" in states.columns else first_per_key(states, KEYS, *[F.desc(c) for c in POSITION])
    if as_of is not None:
        until = F.greatest(F.unix_millis(as_of), F.unix_millis("clock"))
        _, now = _silence(F.col("settled_state"), F.unix_millis("clock"), F.col("asked_ms"), until, limits)
        latest = latest.withColumn("book_state", now)
    return with_metrics(latest).select(*KEYS, "event_time", "book_state", *METRICS)


def with_levels(current: DataFrame, numbered: DataFrame) -> DataFrame:
    """Current books with all their levels, ``book_bids`` and ``book_asks``, best first."""
    levels = closing_levels(numbered).groupBy(*KEYS).agg(*[
        F.collect_list(F.when(F.col("side") == side, F.struct("price", "quantity"))).alias(name)
        for side, name in (("BID", "book_bids"), ("ASK", "book_asks"))])
    none = F.array().cast("array<struct<price:decimal(38,18),quantity:decimal(38,18)>>")
    # Prices are unique on a side, so that quantities never decide the order.
    return current.join(levels, list(KEYS), "left").withColumns({
        "book_bids": F.coalesce(F.reverse(F.array_sort("book_bids")), none), "book_asks": F.coalesce(F.array_sort("book_asks"), none)})
