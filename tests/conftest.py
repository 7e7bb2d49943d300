import os
import sys
from datetime import datetime, timezone
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tickweave.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[4]", **{
        "spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.sql.streaming.stateStore.maintenanceInterval": "3600s"})
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def at(seconds: float) -> datetime:
    """An instant that many seconds after 2024-01-01 00:00 UTC."""
    return datetime.fromtimestamp(1_704_067_200 + seconds, timezone.utc).replace(tzinfo=None)


TRADE_SCHEMA = ("exchange string, instrument string, trade_id string, event_time timestamp, ingestion_time timestamp, "
                "event_time_source string, price decimal(38,18), quantity decimal(38,18), side string, "
                "dedupe_key string, trace_id string, src_partition int, src_offset long, ordinal int")


def make_trades(spark, rows):
    """Rows of ``(instrument, seconds, price, quantity, side[, trade_id[, partition]])`` in log order."""
    out = []
    for offset, row in enumerate(rows):
        instrument, seconds, price, quantity, side = row[:5]
        trade_id = row[5] if len(row) > 5 else f"t{offset}"
        out.append(("KRAKEN", instrument, trade_id, at(seconds), at(seconds + 0.05), "EXCHANGE", Decimal(str(price)),
                    Decimal(str(quantity)), side, f"{instrument}|{trade_id}", f"trace-{offset}",
                    row[6] if len(row) > 6 else 0, offset, 0))
    return spark.createDataFrame(out, TRADE_SCHEMA)
