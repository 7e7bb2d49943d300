from __future__ import annotations

import random
from decimal import Decimal

import pytest
from conftest import at, make_trades
from test_streaming import random_log

from pyspark.sql import functions as F
from tickweave.operators import candles, compare, dedupe, quality, rolling, serving
from tickweave.operators.candles import WindowSpec

D = Decimal


def one_candle(spark, rows):
    [c] = candles.fold_candles(candles.assign_window(make_trades(spark, rows))).collect()
    return c


def replay(rows, size=60, grace=30, shared=False):
    """Record-by-record fold, as a single-threaded reader would do it."""
    clock, windows, late = {}, {}, 0
    for instrument, seconds, price, quantity, side, *_ in rows:
        ms = round(seconds * 1000)
        scope = 0 if shared else instrument
        clock[scope] = max(clock.get(scope, -1), ms)
        start = ms - ms % (size * 1000)
        if start + (size + grace) * 1000 <= clock[scope]:
            late += 1
            continue
        windows.setdefault((instrument, start), []).append((D(str(price)), D(str(quantity)), side))
    final = {k: v for k, v in windows.items() if k[1] + (size + grace) * 1000 <= clock[0 if shared else k[0]]}
    return windows, final, late


def test_ohlcv(spark):
    c = one_candle(spark, [("A", 1, 10, 1, "BUY"), ("A", 2, 14, 1, "SELL"), ("A", 3, 12, 2, "BUY")])
    assert (c.open, c.high, c.low, c.close, c.volume, c.quote_volume, c.vwap) == (10, 14, 10, 12, 4, 48, 12)
    assert (c.buy_volume, c.sell_volume, c.trade_count, c.input_trade_count) == (3, 1, 3, 3)
    assert (c.window, c.window_start, c.window_end, c.trace_id) == ("M1", at(0), at(60), "trace-2")


def test_open_and_close_follow_the_log(spark):
    c = one_candle(spark, [("A", 50, 10, 1, "BUY"), ("A", 5, 11, 1, "BUY")])
    assert (c.open, c.close) == (10, 11)


def test_sums_are_exact(spark):
    c = one_candle(spark, [("A", 1, 1, "0.1", "BUY"), ("A", 2, 1, "0.2", "BUY")])
    assert (c.volume, c.vwap) == (D("0.3"), 1)
    third = one_candle(spark, [("A", 1, "0.333333333333333333", 3, "BUY")])
    assert third.quote_volume == D("0.999999999999999999")
    assert one_candle(spark, [("A", 1, 1, 1, "BUY"), ("A", 2, "0.000000000000000001", 2, "BUY")]).vwap == D("0.333333333333333334")


def test_overflowing_sums_are_null_not_a_failed_job(spark):
    c = one_candle(spark, [("A", 1, "60000000000", "60000000000", "BUY")])
    assert c.quote_volume is None and c.volume == 60000000000


def test_empty_candle_is_all_zero(spark):
    [c] = candles.empty_fold(make_trades(spark, [("A", 1, 1, 1, "BUY")])).collect()
    assert (c.open, c.high, c.low, c.close, c.volume, c.vwap, c.trade_count, c.trace_id) == (0, 0, 0, 0, 0, 0, 0, "")


@pytest.mark.parametrize("times,late,finals", [
    ([10, 120, 30], [False, False, True], [(0, 1)]),
    ([10, 90, 20], [False, False, True], [(0, 1)]),
    ([10, 89.999, 20], [False, False, False], []),
    ([10, 70], [False, False], []),
])
def test_lateness_and_finality(spark, times, late, finals):
    trades = make_trades(spark, [("A", t, 1, 1, "BUY") for t in times])
    assert [r.late for r in candles.mark_late(trades).orderBy("src_offset").collect()] == late
    got = candles.batch_candles(trades).where("is_final").collect()
    assert [((r.window_start - at(0)).seconds, r.trade_count) for r in got] == finals


def test_scope_decides_whose_clock_counts(spark):
    trades = make_trades(spark, [("A", 10, 1, 1, "BUY"), ("B", 200, 1, 1, "BUY")])
    by_partition = candles.batch_candles(trades, scope=("src_partition",)).where("is_final").collect()
    assert [r.instrument for r in by_partition] == ["A"]
    assert candles.batch_candles(trades).where("is_final").count() == 0


@pytest.mark.parametrize("chunk_rows,shared", [(1, False), (13, True), (100_000, False)])
def test_batch_equals_record_by_record(spark, chunk_rows, shared):
    log = random_log(300, seed=chunk_rows)
    windows, final, late = replay(log, shared=shared)
    trades = make_trades(spark, log)
    scope = ("src_partition",) if shared else ("exchange", "instrument")
    got = {(r.instrument, round((r.window_start - at(0)).total_seconds() * 1000)): r
           for r in candles.batch_candles(trades, scope=scope, chunk_rows=chunk_rows).collect()}
    origin = {k: v for k, v in windows.items()}
    assert set(got) == set(origin)
    for key, rows in origin.items():
        c = got[key]
        prices = [p for p, _, _ in rows]
        assert (c.open, c.high, c.low, c.close) == (prices[0], max(prices), min(prices), prices[-1])
        assert c.quote_volume == sum(p * q for p, q, _ in rows)
        assert c.is_final == (key in final)
    assert candles.mark_late(trades, scope=scope, chunk_rows=chunk_rows).where("late").count() == late


def test_stream_time_across_partitions_of_one_instrument(spark):
    rows = [("A", 50, 1, 1, "BUY", "a", 1), ("A", 10, 1, 1, "BUY", "b", 0), ("A", 20, 1, 1, "BUY", "c", 2)]
    got = candles.with_stream_time(make_trades(spark, rows), chunk_rows=1).orderBy("src_partition").collect()
    assert [r.stream_time for r in got] == [at(10), at(50), at(50)]


def test_sharded_and_rolled_candles_agree(spark):
    log = make_trades(spark, random_log(200))
    plain = candles.fold_candles(candles.assign_window(log))
    sharded = candles.sharded_candles(candles.assign_window(log), shards=5)
    shared = [c for c in plain.columns]
    assert compare.replay_difference(plain, sharded.select(*shared)).count() == 0
    seconds = candles.fold_candles(candles.assign_window(log, WindowSpec(1_000, 0)))
    # Minutes made of seconds: the same trades, but open and close go by time, not by log.
    rolled = candles.roll_up(seconds, 60_000)
    same = ["high", "low", "volume", "quote_volume", "vwap", "buy_volume", "sell_volume", "trade_count"]
    key = ["exchange", "instrument", "window", "window_start"]
    assert compare.replay_difference(plain.select(*key, *same), rolled.select(*key, *same)).count() == 0


def test_multi_window_equals_each_window_alone(spark):
    log = make_trades(spark, random_log(200))
    together = candles.multi_window_candles(log, chunk_rows=29)
    assert {r.window for r in together.select("window").distinct().collect()} == {"S1", "S10", "M1"}
    for spec in candles.MULTI_WINDOWS:
        alone = candles.batch_candles(log, spec)
        part = together.where(F.col("window") == spec.name).select(*alone.columns)
        assert compare.replay_difference(alone, part).count() == 0


def test_dedupe_keeps_the_first_and_counts_the_rest(spark):
    trades = make_trades(spark, [("A", 1, 10, 1, "BUY", "x"), ("A", 2, 11, 1, "BUY", "y"), ("A", 1, 99, 1, "BUY", "x"),
                                 ("B", 1, 5, 1, "BUY", "x")])
    kept = dedupe.dedupe_trades(trades)
    assert sorted((r.instrument, r.trade_id, int(r.price), r.copies) for r in kept.collect()) == [
        ("A", "x", 10, 2), ("A", "y", 11, 1), ("B", "x", 5, 1)]
    folded = {r.instrument: r for r in candles.fold_candles(candles.assign_window(kept)).collect()}
    assert (folded["A"].trade_count, folded["A"].input_trade_count) == (2, 3)
    assert {r.instrument: r.duplicates for r in dedupe.duplicates_count(trades).collect()} == {"A": 1, "B": 0}


@pytest.mark.parametrize("horizon", [1, 5, 40, 10_000])
def test_dedupe_within_horizon_against_brute_force(spark, horizon):
    """Chains longer than the horizon, pauses, equal arrivals and single rows; batch and keyed state alike."""
    from tickweave.streaming.dedupe import FirstWithin
    rng = random.Random(horizon)
    log = sorted((rng.randint(0, 200), rng.choice("xyzuvw" if i % 3 else "x")) for i in range(150))
    trades = make_trades(spark, [("A", t, 1, i + 1, "BUY", name) for i, (t, name) in enumerate(log)])
    want, held = set(), {}
    for i, (t, name) in enumerate(log):
        if name not in held or t > held[name] + horizon:
            held[name] = t
            want.add(i)
    assert {r.src_offset for r in dedupe.dedupe_within(trades, horizon * 1000).collect()} == want

    class State:
        value = None

        def exists(self):
            return self.value is not None

        def get(self):
            return self.value

        def update(self, value):
            self.value = value

    class Timers:
        registerTimer = deleteTimer = staticmethod(lambda at: None)

    got, states = set(), {}
    rows = trades.orderBy("src_offset").collect()
    for low, high in ((0, 40), (40, 41), (41, 150)):
        for name in sorted({r.trade_id for r in rows[low:high]}):
            processor = FirstWithin(horizon * 1000, "ingestion_time")
            processor.handle, processor.held = Timers(), states.setdefault(name, State())
            got |= {r.src_offset for r in processor.handleInputRows((name,), iter([r for r in rows[low:high] if r.trade_id == name]), None)}
    assert got == want


def test_multi_windows_fold_trades_once(spark):
    """One aggregate over trades; sizes that do not nest are folded for themselves; late rows differ by size."""
    rng = random.Random(9)
    trades = make_trades(spark, [("AB"[i % 2], rng.randint(0, 400), rng.randint(1, 9), rng.randint(1, 9), "BUY") for i in range(300)])
    specs = [candles.WindowSpec(10_000, 5_000, "a"), candles.WindowSpec(60_000, 90_000, "b"), candles.WindowSpec(25_000, 0, "c")]
    got = candles.multi_window_candles(trades, specs)
    for spec in specs:
        alone = candles.batch_candles(trades, spec)
        same = ["instrument", "window_start", "window_end", "open", "high", "low", "close", "volume", "vwap", "trade_count", "is_final", "trace_id"]
        assert compare.replay_difference(got.where(F.col("window") == spec.name).select(*same), alone.select(*same)).count() == 0
    plan = candles.multi_window_candles(trades, specs[:2])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate") == 1 and "Generate inline" in plan


def test_stamping(spark):
    folded = candles.batch_candles(make_trades(spark, [("A", 1, 10, 1, "BUY"), ("A", 100, 10, 1, "BUY")]))
    stamped = candles.stamp_candles(folded, "v7", F.lit(at(500)).cast("timestamp"))
    rows = {r.is_final: r for r in stamped.collect()}
    assert rows[True].event_id != rows[False].event_id
    assert (rows[True].event_time, rows[True].processing_time, rows[True].processor_version) == (at(0), at(500), "v7")
    provisional = candles.stamp_candles(folded.where("is_final").withColumn("is_final", F.lit(False)), "v7", F.lit(None))
    assert provisional.collect()[0].event_id != rows[True].event_id
    assert candles.candle_events(stamped).select("header.instrument").distinct().collect()[0][0] == "A"


def test_late_sample_is_repeatable(spark):
    rows = [("A", 10, 1, 1, "BUY"), ("A", 500, 1, 1, "BUY")] + [("A", 20 + i, 1, 1, "BUY") for i in range(40)]
    marked = candles.mark_late(make_trades(spark, rows))
    whole = {r.event_id for r in candles.late_invalid_events(marked, "v").collect()}
    samples = [{r.event_id for r in candles.late_invalid_events(marked, "v", 30).collect()} for _ in range(2)]
    assert len(whole) == 40 and samples[0] == samples[1] and samples[0] < whole


def test_rolling_volume_against_brute_force(spark):
    rng = random.Random(5)
    log = [("A", rng.randint(0, 4000) / 10, 1, rng.randint(1, 9), "BUY") for _ in range(150)]
    got = rolling.rolling_volume(make_trades(spark, log), 20_000).collect()
    assert len(got) == len({t for _, t, *_ in log})
    for r in got:
        t = (r.at_ms - 1_704_067_200_000) / 1000
        inside = [q for _, s, _, q, _ in log if t - 20 <= s <= t]
        assert (r.rolling_volume, r.rolling_trades) == (sum(inside), len(inside))


def test_sliding_sums_across_chunks(spark):
    """Rows enter and leave at chunk ends, before 1970 too; gaps wider than the span."""
    from tickweave.operators.prefix import sliding_sums
    rng = random.Random(6)
    ticks = {(k, rng.randint(-3000, 3000)): rng.randint(1, 9) for k in "AB" for _ in range(200)}
    df = spark.createDataFrame([(k, t, q) for (k, t), q in ticks.items()], "k string, t long, q long")
    for span in (0, 1, 90, 2500):
        got = sliding_sums(df, ["k"], "t", span, {"s": "q"}, chunk_ms=100).collect()
        assert {(r.k, r.t): r.s for r in got} == {(k, t): sum(q for (x, u), q in ticks.items() if x == k and t - span <= u <= t) for k, t in ticks}


def test_gaps_across_chunks(spark):
    trades = make_trades(spark, [("A", t, 1, 1, "BUY") for t in (0, 1, 1, 50, 51, 200)])
    gaps = rolling.inter_trade_gaps(trades, 40_000, chunk_ms=7_000).orderBy("gap_to_ms").collect()
    assert [r.gap_ms for r in gaps] == [49_000, 149_000]
    envelopes = spark.createDataFrame([("c1", s) for s in (0, 1, 1, 4, 9)] + [("c2", 0), ("c2", 1)],
                                      "source_connection_id string, ingest_sequence long")
    missing = rolling.ingest_gaps(envelopes, chunk=2).orderBy("next_sequence").collect()
    assert [(r.source_connection_id, r.after_sequence, r.missing) for r in missing] == [("c1", 1, 2), ("c1", 4, 4)]


def test_comparison_reports(spark):
    log = random_log(100)
    a = candles.batch_candles(make_trades(spark, log))
    b = candles.batch_candles(make_trades(spark, [*log, ("Z", 1, 1, 1, "BUY")]))
    assert {r.status: r.candles for r in compare.diff_summary(compare.ab_diff(a, b)).collect()} == {"same": a.count(), "only_b": 1}
    assert compare.oracle_compare(b, a).where("NOT matched").count() == 1
    assert compare.oracle_compare(a, b).where("NOT matched OR size(differences) > 0").count() == 0
    assert [r.surplus for r in compare.replay_difference(a, b).collect()] == [-1]
    assert compare.finalised_twice(a.unionByName(a.limit(1))).count() == 1


def test_invariants_and_latency(spark):
    finals = candles.batch_candles(make_trades(spark, random_log(100))).where("is_final").withColumn("event_time", F.col("window_start"))
    assert quality.invariant_violations(finals).count() == 0
    broken = finals.withColumn("high", F.col("low") - 1)
    assert {r.violation for r in quality.invariant_violations(broken).collect()} >= {"high_below_low"}
    timed = spark.createDataFrame([(at(10), at(10 + s)) for s in (-5, 1, 2, 3)], "window_end timestamp, processing_time timestamp")
    [p] = quality.latency_percentiles(timed).collect()
    assert (p.p50_ms, p.observations) == (2000, 3)


def test_serving_reads(spark):
    trades = make_trades(spark, [("A", 100, 10, 1, "BUY"), ("A", 50, 11, 1, "BUY"), ("B", 5, 7, 1, "BUY")])
    assert {r.instrument: (int(r.price), r.as_of) for r in serving.latest_price(trades).collect()} == {"A": (11, at(50)), "B": (7, at(5))}
    finals = candles.batch_candles(make_trades(spark, random_log(300))).where("is_final")
    newest = serving.candle_history(finals, "A", 3).collect()
    starts = sorted((r.window_start for r in finals.where("instrument = 'A'").collect()), reverse=True)
    assert [r.window_start for r in newest] == starts[:3]
    assert serving.latest_n_per_instrument(finals, 2).count() == 6


def test_volatility_at_zero_closes(spark):
    closes = [1, 2, 0, 0, 3, 4, 5, 4]
    made = candles.fold_candles(candles.assign_window(make_trades(spark, [("A", 60 * i, p, 1, "BUY") for i, p in enumerate(closes)])))
    got = rolling.rolling_volatility(made, 120_000).orderBy("at_ms").collect()
    assert [r.returns for r in got] == [0, 1, 2, 3, 3, 3, 3, 3]
    assert [None if r.volatility is None else str(r.volatility)[:5] for r in got] == [None, None, "nan", "nan", "nan", "nan", "nan", "0.278"]
