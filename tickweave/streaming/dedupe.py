"""Streaming deduplication with a time to live that depends on the rows alone, not on how they fell into batches."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence
from datetime import timezone

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.keys import POSITION


#: Groups that keys are dealt to by a hash; each is one state, so that a micro-batch costs calls by group and not by key.
BUCKETS = 4_096
_BUCKET = "__bucket"


class FirstWithin(StatefulProcessor):
    """Keeps the arrival of the last row let through, by key; a timer forgets those of which no row that still comes can be a copy.

    Without ``keys`` all rows are of one key. With them the rows end with the number of their bucket, which the results leave out.
    """

    def __init__(self, horizon_ms: int, at: str, keys: Sequence[str] = ()) -> None:
        self.horizon_ms, self.at, self.keys = horizon_ms, at, tuple(keys)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("kept", "of array<string>, at_ms array<long>")

    def _load(self) -> dict[str, int]:
        return dict(zip(*self.held.get())) if self.held.exists() else {}

    def _due(self, held: dict[str, int]) -> int | None:
        """When the oldest can be forgotten."""
        return min(held.values()) + self.horizon_ms if held else None

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self._load()
        before = self._due(held)
        for row in sorted(rows, key=lambda r: tuple(r[c] for c in POSITION)):
            arrived = row[self.at]
            at_ms = int(arrived.replace(tzinfo=arrived.tzinfo or timezone.utc).timestamp()) * 1000 + arrived.microsecond // 1000
            of = json.dumps([row[k] for k in self.keys], default=str)
            if of not in held or at_ms > held[of] + self.horizon_ms:
                held[of] = at_ms
                yield Row(*row.__fields__[:-1])(*row[:-1]) if self.keys else row
        after = self._due(held)
        if after != before:
            if before is not None:
                self.handle.deleteTimer(before)
            self.handle.registerTimer(after)
        self.held.update((list(held), list(held.values())))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        passed = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held = {of: at_ms for of, at_ms in self._load().items() if at_ms + self.horizon_ms > passed}
        if held:
            self.handle.registerTimer(self._due(held))
            self.held.update((list(held), list(held.values())))
        else:
            self.held.clear()
        return iter(())

    def close(self) -> None:
        pass


def dedupe_stream(trades: DataFrame, horizon_ms: int, keys: Sequence[str] = ("exchange", "dedupe_key"), at: str = "ingestion_time",
                  delay: str = "0 seconds", buckets: int = BUCKETS) -> DataFrame:
    """:func:`tickweave.operators.dedupe.dedupe_within` of a stream; ``delay`` is how far arrival times may run back between batches.

    A micro-batch's rows of one of the ``buckets`` are held in one task, and so are the arrivals of its keys within the horizon.
    """
    dealt = trades.withWatermark(at, delay).withColumn(_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)))
    return dealt.groupBy(_BUCKET).transformWithState(FirstWithin(horizon_ms, at, keys), trades.schema, "Append", "EventTime")
