"""The driver contract, and registered queries against their SQL on the smallest tables.

``tools/check_queries.py`` runs every query; here a spread of them does (all with ``CHECK_ALL=1``).
"""

from __future__ import annotations

import os
import sys

import pytest
from conftest import SF

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as entry  # noqa: E402
import check_queries  # noqa: E402
from bench import HEADLINE  # noqa: E402
from tickweave.plans import catalog  # noqa: E402

SPREAD = ["normalize_frames", "build_invalid_event", "wrap_envelope", "candle_1m", "multi_window_candles", "ab_diff",
          "read_final", "rolling_volume", "rolling_volatility", "ingest_gaps", "volume_scores", "latency_percentiles",
          "book_transitions", "book_metrics", "range_aggregates", "instrument_key", "resolve_event_time", "alert_large_trade_percentile"]
NAMES = list(catalog.QUERIES) if os.environ.get("CHECK_ALL") else SPREAD


@pytest.fixture(scope="module")
def duck():
    return check_queries.connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_its_sql(spark, duck, name):
    outcome = check_queries.compare(spark, duck, SF, name)
    assert not outcome.startswith("FAIL"), outcome


def test_contract(spark):
    queries, checks = entry.queries(), entry.oracle_sql()
    assert set(checks) <= set(queries) and set(HEADLINE) <= set(queries)
    assert set(catalog.QUERIES) == set(catalog.ORACLES)
    flagship = entry.entry(spark)
    assert flagship.count() > 0 and flagship.columns == entry.entry(spark).columns


def test_final_candles_read_the_log_twice_and_join_nothing(spark):
    plan = entry.queries()["final_candles"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "Join" not in plan
    # The summary scan reads only what it summarises.
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in plan


def test_silence_of_books_needs_no_replay(spark):
    """The stale alert reads the log's times alone, and the messages are numbered on narrow rows."""
    plan = entry.queries()["alert_stale_book"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan
    narrow = catalog.views.book_messages(spark, SF)._jdf.queryExecution().executedPlan().toString()
    below = narrow[narrow.index("MapInArrow"):]
    assert "FlatMapGroups" not in narrow and "bids" not in below and "decimal" not in below


def test_event_clock_covers_tape_and_frames(spark, duck):
    """All events as trades of the tape, and all trades that their frames are normalised to."""
    outcome = check_queries.compare(spark, duck, SF, "event_time_extractor")
    trades = catalog.routed(spark, SF).where("route = 'trade'").count()
    assert trades and outcome.startswith(f"ok {catalog.views.table(spark, SF, 'events').count() + trades} "), outcome
