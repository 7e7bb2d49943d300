"""Streaming results against the batch operators on the same log."""

from __future__ import annotations

import random
from decimal import Decimal

import pytest
from conftest import SF, at, make_trades

from pyspark.sql import functions as F
from tickweave.operators import candles
from tickweave.plans import views
from tickweave.sources import tables
from tickweave.streaming import candles as stream
from tickweave.streaming import sinks

MINUTE = candles.DEFAULT_WINDOW
VALUES = ["instrument", "window_start", "open", "high", "low", "close", "volume", "quote_volume", "vwap", "buy_volume",
          "sell_volume", "trade_count", "trace_id"]


def rows_of(df, columns=VALUES):
    return sorted(repr(tuple(r)) for r in df.select(*columns).collect())


def random_log(n=400, seed=3):
    rng = random.Random(seed)
    clock, rows = 0.0, []
    for _ in range(n):
        clock += rng.random() * 6
        back = rng.choice([0, 0, 0, 20, 60, 150])
        rows.append((rng.choice("ABC"), max(0.0, clock - back), rng.randint(1, 999) / 100, rng.randint(1, 50),
                     rng.choice(["BUY", "SELL"])))
    return rows


def slices(spark, trades, folder, cuts):
    """The log as stream files, one per range of offsets, written in order."""
    for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
        trades.where(F.col("src_offset").between(low, high - 1)).coalesce(1).write.parquet(f"{folder}/{number:03d}")
    return spark.readStream.schema(trades.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*")


def run_exact(spark, trades, tmp_path, cuts, **options):
    job = stream.ExactCandles(str(tmp_path / "out"), **options)
    source = slices(spark, trades, str(tmp_path / "in"), cuts)
    query = job.start(source, str(tmp_path / "check"), availableNow=True)
    query.awaitTermination()
    return job


@pytest.mark.parametrize("scope", [("exchange", "instrument"), ("src_partition",)])
def test_exact_stream_equals_batch(spark, tmp_path, scope):
    trades = make_trades(spark, random_log())
    job = run_exact(spark, trades, tmp_path, [0, 70, 150, 151, 300, 400], scope=scope, chunk_rows=37)
    batch = candles.batch_candles(trades, MINUTE, scope)
    assert rows_of(job.finals(spark)) == rows_of(batch.where("is_final"))
    late = candles.mark_late(trades, MINUTE, scope).where("late")
    assert job.late(spark).count() == late.count() > 0
    # The last provisional row of each window that never closed is the batch's open candle.
    emitted = job.candles(spark)
    newest = emitted.groupBy("instrument", "window_start").agg(F.max_by("is_final", "batch").alias("f"), F.max("batch").alias("batch"))
    still_open = emitted.join(newest.where("NOT f").drop("f"), ["instrument", "window_start", "batch"])
    assert rows_of(still_open) == rows_of(batch.where("NOT is_final"))


def test_exact_stream_survives_a_repeated_batch(spark, tmp_path):
    trades = make_trades(spark, random_log(120))
    job = stream.ExactCandles(str(tmp_path / "out"))
    parts = [trades.where(F.col("src_offset").between(a, b - 1)) for a, b in [(0, 50), (50, 90), (90, 120)]]
    for number, part in enumerate(parts):
        job.process(part, number)
        job.process(part, number)
    assert rows_of(job.finals(spark)) == rows_of(candles.batch_candles(trades).where("is_final"))


def test_heartbeat_closes_a_silent_instrument(spark, tmp_path):
    trades = make_trades(spark, [("A", 10, 5, 1, "BUY")])
    job = stream.ExactCandles(str(tmp_path / "out"))
    job.process(trades, 0)
    assert job.finals(spark).count() == 0
    beat = trades.select("exchange", "instrument", F.lit(at(90)).alias("event_time"), "src_partition",
                         F.lit(1).cast("long").alias("src_offset"), "ordinal")
    job.process(stream.with_heartbeats(trades.where("false"), beat), 1)
    [final] = job.finals(spark).collect()
    assert (final.trade_count, final.close) == (1, Decimal(5))


def test_native_append_emits_only_closed_windows(spark, tmp_path):
    trades = make_trades(spark, [("A", 10, 10, 1, "BUY"), ("A", 20, 14, 1, "SELL"), ("A", 200, 9, 1, "BUY"), ("A", 400, 9, 1, "BUY")])
    source = slices(spark, trades, str(tmp_path / "in"), [0, 2, 3, 4])
    query = (stream.native_candles(source).writeStream.outputMode("append").format("memory").queryName("native_final")
             .option("checkpointLocation", str(tmp_path / "check")).start())
    query.processAllAvailable()
    query.stop()
    got = spark.table("native_final").orderBy("window_start").collect()
    assert [(r.window_start, r.trade_count, r.vwap) for r in got] == [(at(0), 2, Decimal(12)), (at(180), 1, Decimal(9))]


def test_native_update_reemits_open_windows(spark, tmp_path):
    trades = make_trades(spark, [("A", 10, 10, 1, "BUY"), ("A", 20, 14, 1, "SELL")])
    source = slices(spark, trades, str(tmp_path / "in"), [0, 1, 2])
    query = (stream.native_candles(source).writeStream.outputMode("update").format("memory").queryName("native_open")
             .option("checkpointLocation", str(tmp_path / "check")).start())
    query.processAllAvailable()
    query.stop()
    assert sorted(r.trade_count for r in spark.table("native_open").collect()) == [1, 2]


def test_stream_dedupe_keeps_first(spark, tmp_path):
    trades = make_trades(spark, [("A", 10, 10, 1, "BUY", "x"), ("A", 11, 11, 1, "BUY", "y"), ("A", 10, 99, 1, "BUY", "x")])
    source = slices(spark, trades, str(tmp_path / "in"), [0, 2, 3])
    query = (stream.dedupe_stream(source, "90 seconds").writeStream.format("memory").queryName("deduped")
             .option("checkpointLocation", str(tmp_path / "check")).start())
    query.processAllAvailable()
    query.stop()
    assert sorted((r.trade_id, int(r.price)) for r in spark.table("deduped").collect()) == [("x", 10), ("y", 11)]


def test_routed_stream_loses_nothing(spark, tmp_path):
    frames = views.frames(spark, SF)
    folder = str(tmp_path / "in")
    frames.write.parquet(folder)
    source = spark.readStream.schema(frames.schema).parquet(folder)
    query = sinks.start_normalizer(source, str(tmp_path / "out"), str(tmp_path / "check"), "v1", availableNow=True)
    query.awaitTermination()
    counts = {name: spark.read.parquet(f"{tmp_path}/out/{name}").count()
              for name in ("normalized.trades", "invalid.events", "dead-letter")}
    doubled = frames.where("src_offset % 50 = 21").count()
    assert sum(counts.values()) == frames.count() + doubled
    assert all(counts.values())


def test_failed_sink_batch_is_retried_whole(spark, tmp_path):
    trades = make_trades(spark, [("A", 10, 10, 1, "BUY", "x"), ("A", 70, 11, 1, "BUY", " "), ("A", 80, 11, 1, "BUY", "z")]
                         ).withColumn("event_id", F.col("trade_id"))
    folder, check, root = str(tmp_path / "in"), str(tmp_path / "check"), str(tmp_path / "store")
    trades.coalesce(1).write.parquet(folder)
    source = spark.readStream.schema(trades.schema).parquet(folder)

    def broken(batch, batch_id):
        tables.write_batch(batch, tables.TRADES_TABLE, root, batch_id)
        raise RuntimeError("store is down")

    failed = source.writeStream.foreachBatch(broken).option("checkpointLocation", check).trigger(availableNow=True).start()
    with pytest.raises(Exception):
        failed.awaitTermination()
    sinks.start_sink(source, tables.TRADES_TABLE, root, check, availableNow=True).awaitTermination()
    stored = tables.read_table(spark, tables.TRADES_TABLE, root)
    assert sorted(r.trade_id for r in stored.collect()) == ["x", "z"]
    log = {r.verdict: r["rows"] for r in spark.read.parquet(f"{root}/trades.log").collect()}
    assert log == {"store": 2, "reject": 1}


def test_dedupe_within_in_few_buckets(spark, tmp_path):
    """Keys that share a bucket keep to themselves; rows come back as they were; calls do not grow with the keys."""
    from tickweave.streaming import dedupe as within
    trades = make_trades(spark, [("AB"[i % 2], t, t + 0.125, 1, "BUY", f"x{i % 40}") for i, t in enumerate([*range(100), *range(130, 190)])])
    source = slices(spark, trades, str(tmp_path / "in"), [0, 100, 160])
    query = (within.dedupe_stream(source, 50_000, buckets=3).writeStream.format("memory").queryName("within")
             .option("checkpointLocation", str(tmp_path / "check")).start())
    query.processAllAvailable()
    query.stop()
    got = spark.table("within")
    assert got.schema == trades.schema
    want, held = [], {}
    for r in trades.orderBy("src_offset").collect():
        at_s = r.ingestion_time.timestamp()
        if r.dedupe_key not in held or at_s > held[r.dedupe_key] + 50:
            held[r.dedupe_key] = at_s
            want.append(r)
    assert sorted(got.collect(), key=lambda r: r.src_offset) == want and 40 < len(want) < 160
    # One value for each bucket and no more.
    state = spark.read.format("statestore").option("path", str(tmp_path / "check")).option("stateVarName", "kept").load()
    assert state.count() <= 3
