from __future__ import annotations

import pytest
from conftest import SF, at, make_trades
from test_normalize import envelopes, frame, trade

from pyspark.sql import functions as F
from tickweave.operators import alerts, candles, compare, serving
from tickweave.plans import pipeline, replay, views
from tickweave.schemas import INSTRUMENT, PROCESSOR_VERSION
from tickweave.sources import logs, tables


def stored_trades(spark, rows):
    return make_trades(spark, rows).withColumn("event_id", F.col("trade_id"))


def test_verdicts(spark):
    good = candles.batch_candles(make_trades(spark, [("A", 10, 5, 1, "BUY"), ("A", 100, 5, 1, "BUY")])).withColumn(
        "processor_version", F.lit("v"))
    cases = [
        (good.where("is_final"), "store", None), (good.where("NOT is_final"), "skip", "provisional"),
        (good.where("is_final").withColumn("trade_count", F.lit(-1)), "reject", "a trade count is negative and the column is unsigned"),
        (good.where("is_final").withColumn("vwap", F.lit(None).cast("decimal(38,18)")), "reject", "a decimal does not fit Decimal(38,18)"),
        (good.where("is_final").withColumn("window_end", F.lit("2300-01-01").cast("timestamp")), "reject", "windowEnd is outside the DateTime64(3) range"),
    ]
    for rows, verdict, reason in cases:
        [r] = tables.validate_for_storage(rows, tables.CANDLES_TABLE).collect()
        assert (r.verdict, r.reason) == (verdict, reason)
    base = stored_trades(spark, [("A", 10, 5, 1, "BUY")])
    for rows, reason in [
        (base.withColumn("trade_id", F.lit("  ")), "tradeId is empty, and it is part of the dedupe key"),
        (base.withColumn("price", F.lit("123456789012345678901").cast("decimal(38,2)")), "price does not fit Decimal(38,18)"),
        (base.withColumn("ingestion_time", F.lit("1899-12-31").cast("timestamp")), "ingestionTime is outside the DateTime64(3) range"),
    ]:
        [r] = tables.validate_for_storage(rows, tables.TRADES_TABLE).collect()
        assert (r.verdict, r.reason) == ("reject", reason)


def test_redelivery_collapses_on_read(spark, tmp_path):
    rows = stored_trades(spark, [("A", 10, 5, 1, "BUY", "x"), ("A", 90_000, 6, 1, "BUY", "y")])
    root = str(tmp_path)
    tables.write_batch(rows, tables.TRADES_TABLE, root, 0, F.lit(at(0)).cast("timestamp"))
    tables.write_batch(rows.withColumn("side", F.lit("SELL")), tables.TRADES_TABLE, root, 1, F.lit(at(5)).cast("timestamp"))
    tables.write_batch(rows.withColumn("side", F.lit("SELL")), tables.TRADES_TABLE, root, 1, F.lit(at(5)).cast("timestamp"))
    stored = tables.read_table(spark, tables.TRADES_TABLE, root)
    assert stored.count() == 4
    final = tables.read_final(stored, tables.TRADES_TABLE.key)
    assert [(r.trade_id, r.side) for r in final.orderBy("trade_id").collect()] == [("x", "SELL"), ("y", "SELL")]
    [counts] = tables.count_final(stored, tables.TRADES_TABLE.key).collect()
    assert (counts.stored_rows, counts.final_rows) == (4, 2)


def test_day_filters_prune_files_below_the_final_read(spark, tmp_path):
    rows = stored_trades(spark, [("A", d * 86_400, 5, 1, "BUY") for d in range(3)])
    tables.write_batch(rows, tables.TRADES_TABLE, str(tmp_path), 0, rebalance=True)
    final = tables.read_final(tables.read_table(spark, tables.TRADES_TABLE, str(tmp_path)), tables.TRADES_TABLE.key)
    one_day = final.where("day = '2024-01-02' AND instrument = 'A'")
    plan = one_day._jdf.queryExecution().executedPlan().toString()
    scan = plan[plan.index("FileScan"):]
    assert "day#" in scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    assert "EqualTo(instrument,A)" in scan
    assert one_day.count() == 1


def test_retention_and_archive(spark, tmp_path):
    rows = stored_trades(spark, [("A", 0, 5, 1, "BUY"), ("A", 86_400 * 100, 5, 1, "BUY")])
    kept = tables.apply_retention(rows, tables.TRADES_TABLE, F.lit("2024-08-01").cast("timestamp"))
    assert kept.count() == 1
    assert tables.apply_retention(rows, tables.CANDLES_TABLE, F.lit("2034-08-01").cast("timestamp")).count() == 2
    tables.archive_raw(views.frames(spark, SF), str(tmp_path / "raw"))
    archive = spark.read.parquet(str(tmp_path / "raw"))
    some = logs.scan_offset_range(archive, 100, 199, F.lit(at(0)).cast("timestamp"), F.lit(at(86_400 * 40)).cast("timestamp"))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "received_date" in plan[plan.index("PartitionFilters"):plan.index("PushedFilters")]
    assert some.count() == views.frames(spark, SF).where("src_offset BETWEEN 100 AND 199").count()


def test_registry_and_versions(spark):
    def instrument(n, symbol, enabled):
        return (n, "KRAKEN", symbol, symbol, "X", "USD", None, None, 1, 8, 10, enabled, None, None)
    loose = INSTRUMENT.simpleString()
    registry = spark.createDataFrame([instrument(1, "ETH/USD", True), instrument(2, "BTC/USD", True), instrument(3, "OFF", False)], loose)
    assert [r.canonical_symbol for r in logs.scan_instruments(registry, "KRAKEN").collect()] == ["BTC/USD", "ETH/USD"]
    with pytest.raises(LookupError):
        logs.scan_instruments(registry, "OTHER")

    def versions(*retired):
        return spark.createDataFrame([(i, f"v{i}", 1, None, at(i), at(9) if r else None, None) for i, r in enumerate(retired)], PROCESSOR_VERSION)
    assert logs.live_processor_version(versions(True, False)) == "v1"
    for wrong in (versions(True), versions(False, False)):
        with pytest.raises(LookupError):
            logs.live_processor_version(wrong)


def test_recorded_frames(spark, tmp_path):
    lines = ["# note", "1704067200100\ta\tb", "", "1704067200200\tc", "  ", "#x", *[f"{1704067200300 + i}\tp{i}" for i in range(500)]]
    path = tmp_path / "frames.tsv"
    path.write_text("\n".join(lines))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    try:
        got = logs.scan_recorded_frames(spark, str(path), "c9", "BTC/USD").orderBy("ingest_sequence").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [r.ingest_sequence for r in got] == list(range(502))
    assert [bytes(r.payload).decode() for r in got] == ["a\tb", "c", *[f"p{i}" for i in range(500)]]
    assert (got[0].received_at, got[0].trace_id, got[0].record_key) == (at(0.1), "replay-0", "KRAKEN|BTC/USD")


def test_avro_needs_its_package(spark):
    rows = spark.createDataFrame([(bytearray(b"\x00\x00\x00\x00\x01\x06abc"),)], "value binary")
    with pytest.raises(Exception, match="(?i)avro"):
        logs.decode_event(rows, '"string"').collect()


def raw_log(spark):
    payloads = [frame(trade(trade_id=i, qty=1, price=100 + i, timestamp=f"2024-01-01T00:{i:02d}:01Z")) for i in range(8)]
    payloads.insert(3, payloads[1])  # a redelivered trade
    payloads.append("{")
    payloads.append(frame(trade(qty=0)))
    return envelopes(spark, payloads, received=430)


def test_pipeline(spark):
    outputs = pipeline.derive(raw_log(spark), "v1")
    assert {name: rows.count() for name, rows in outputs.streams.items()} == {
        "normalized.trades": 9, "invalid.events": 1, "dead-letter": 1, "derived.candles": 8}
    finals = outputs.candles.where("is_final").orderBy("window_start").collect()
    assert len(finals) < 8 and {r.input_trade_count for r in finals} == {1, 2}
    assert {r.trade_count for r in finals} == {1}


def test_replays_are_versioned_equal_and_audited(spark, tmp_path):
    raw, root = raw_log(spark), str(tmp_path)
    first = replay.replay_range(raw, root, 1, "v1", large_trade=105)
    second = replay.replay_range(raw, root, 2, "v1", large_trade=105)
    assert first["derived.candles"].endswith("derived.candles.v1")
    a, b = (spark.read.parquet(p["derived.candles"]) for p in (first, second))
    assert compare.replay_difference(a, b).count() == 0
    assert {r.status for r in replay.compare_versions(spark, root, "derived.candles", 1, 2).collect()} == {"same"}
    original = alerts.alert_large_trade(pipeline.derive(raw, "v1").trades, 105, "v1").collect()[0]
    assert replay.alert_refires(spark.read.parquet(second["alerts"]), original.alert_id)
    part = replay.replay_range(raw, root, 3, "v1", from_offset=0, to_offset=2)
    assert spark.read.parquet(part["normalized.trades"]).count() == 3
    with pytest.raises(Exception):
        replay.replay_range(raw, root, 1, "v1")
    with pytest.raises(ValueError):
        replay.versioned("derived.candles", 0)

    jobs = f"{root}/jobs"
    job = {"id": "j1", "application_id": "app", "source_topic": "raw", "target_topic": "derived.candles.v1",
           "processor_version": "v1", "requested_by": "me", "created_at": at(0)}
    with pytest.raises(ValueError):
        replay.record_status(spark, jobs, {**job, "status": "RUNNING"})
    for status in ("PENDING", "RUNNING", "COMPLETED"):
        replay.record_status(spark, jobs, {**job, "status": status})
    with pytest.raises(ValueError):
        replay.record_status(spark, jobs, {**job, "status": "RUNNING"})
    assert [(r.id, r.status) for r in replay.replay_jobs(spark, jobs).collect()] == [("j1", "COMPLETED")]


def test_of_two_moves_at_once_one_wins(spark, tmp_path, monkeypatch):
    jobs, job = f"{tmp_path}/jobs", {"id": "j/1", "created_at": at(0)}
    for status in ("PENDING", "RUNNING"):
        replay.record_status(spark, jobs, {**job, "status": status})
    # Both have read RUNNING before either writes.
    seen = replay._records(spark, jobs).collect()
    frozen = spark.createDataFrame(seen, replay._records(spark, jobs).schema)
    with monkeypatch.context() as patch:
        patch.setattr(replay, "_records", lambda *_: frozen)
        replay.record_status(spark, jobs, {**job, "status": "FAILED"})
        with pytest.raises(ValueError, match="another job"):
            replay.record_status(spark, jobs, {**job, "status": "COMPLETED"})
    assert [(r.id, r.status, r.step) for r in replay.replay_jobs(spark, jobs).collect()] == [("j/1", "FAILED", 2)]


def test_days_are_compacted_and_read_alone(spark, tmp_path):
    table, root = tables.TRADES_TABLE, str(tmp_path)
    day = 86_400
    rows = make_trades(spark, [("A", t * day, 1, 1, "BUY") for t in range(4)]).withColumn("event_id", F.col("trade_id"))
    for batch in (0, 1):
        tables.write_batch(rows, table, root, batch)
    stored = tables.read_table(spark, table, root)
    tables.compact_days(stored, table, root)
    before = {r.day: r.f for r in tables.read_days(spark, table, root).select("day", F.input_file_name().alias("f")).collect()}
    second = F.col("day") == F.lit("2024-01-02").cast("date")
    tables.compact_days(stored.where(second), table, root)
    days = tables.read_days(spark, table, root)
    after = {r.day: r.f for r in days.select("day", F.input_file_name().alias("f")).collect()}
    assert days.count() == 4 and [d for d in sorted(before) if before[d] != after[d]] == [sorted(before)[1]]
    assert "PartitionFilters: [isnotnull(day" in days.where(second)._jdf.queryExecution().executedPlan().toString()
    assert days.where(second).count() == 1


def test_trace_walk_and_alert_rules(spark):
    outputs = pipeline.derive(raw_log(spark), "v1")
    walked = serving.trace_walk("trace-2", trade=outputs.trades, candle=outputs.candles, raw=raw_log(spark))
    assert {r.stage for r in walked.collect()} == {"trade", "candle", "raw"}
    trades = make_trades(spark, [("A", i, 1, i + 1, "BUY") for i in range(100)])
    assert sorted(int(r.notional) for r in alerts.large_trades_percentile(trades, 0.95).collect()) == [96, 97, 98, 99, 100]
    spiky = make_trades(spark, [("A", 60 * i, 1, 50 if i == 9 else 5 + i % 2, "BUY") for i in range(10)])
    folded = candles.fold_candles(candles.assign_window(spiky))
    [spike] = alerts.alert_volume_spike(folded, 60_000, 3.0, "v").collect()
    assert (spike.triggered_at, spike.type, spike.window_ref) == (at(600), "VOLUME_SPIKE", f"M1:{1_704_067_200_000 + 540_000}")
    twice = alerts.alert_volume_spike(folded, 60_000, 3.0, "v").unionByName(alerts.alert_volume_spike(folded, 60_000, 3.0, "v"))
    assert alerts.dedupe_alerts(twice).count() == 1
    assert alerts.active_alerts(twice, F.lit(at(700)).cast("timestamp"), 200_000).count() == 1
    assert alerts.active_alerts(twice, F.lit(at(900)).cast("timestamp"), 200_000).count() == 0


def test_lineage_shows_orphans(spark):
    derived = spark.createDataFrame([("t1", "e1"), ("t2", "gone"), ("t3", None)], "trade_id string, source_event_id string")
    sources = spark.createDataFrame([("e1", "x1", "c0", 4)], "event_id string, trace_id string, source_connection_id string, ingest_sequence long")
    got = {r.trade_id: (r.source_trace_id, r.orphan) for r in serving.lineage(derived, sources).collect()}
    assert got == {"t1": ("x1", False), "t2": (None, True), "t3": (None, True)}


def test_intermediate_tables_take_a_codec(spark, tmp_path):
    import pyarrow.parquet as pq

    from tickweave.session import materialise
    materialise(spark.range(10), "small", str(tmp_path), codec="zstd")
    [file, *_] = (tmp_path / "small").glob("*.parquet")
    assert pq.ParquetFile(file).metadata.row_group(0).column(0).compression == "ZSTD"
