"""Books against a brute-force replay, and the state machine step by step."""

from __future__ import annotations

import random
import zlib
from decimal import Decimal

import pytest
from conftest import at

from pyspark.sql import functions as F
from tickweave.operators import alerts, book, rolling
from tickweave.schemas import BOOK_EVENT, RAW_ENVELOPE

TEXT = (2, 3)


def checksum(bids, asks):
    """The formatter's text, worked out by hand from price -> quantity maps."""
    def digits(x, places):
        return f"{x:.{places}f}".replace(".", "").lstrip("0")
    parts = [digits(p, TEXT[0]) + digits(asks[p], TEXT[1]) for p in sorted(asks)[:10]]
    parts += [digits(p, TEXT[0]) + digits(bids[p], TEXT[1]) for p in sorted(bids, reverse=True)[:10]]
    return zlib.crc32("".join(parts).encode())


class Feed:
    """A message list that keeps the true book, so checksums are right unless broken on purpose."""

    def __init__(self, instrument="A"):
        self.instrument, self.rows, self.bids, self.asks = instrument, [], {}, {}

    def send(self, kind, seconds, bids=(), asks=(), broken=False, sequence=None):
        if kind != "UPDATE":
            self.bids, self.asks = {}, {}
        for side, changes in ((self.bids, bids), (self.asks, asks)):
            for price, quantity in changes:
                side[Decimal(str(price))] = Decimal(str(quantity))
                if quantity == 0:
                    del side[Decimal(str(price))]
        value = checksum(self.bids, self.asks) + (1 if broken else 0)
        self.rows.append((self.instrument, kind, seconds, bids, asks, None if kind == "RESET" else value, sequence,
                          dict(self.bids), dict(self.asks)))
        return self

    def snapshot(self, seconds, bids=((99, 1),), asks=((101, 1),), **kw):
        return self.send("SNAPSHOT", seconds, bids, asks, **kw)

    def update(self, seconds, bids=(), asks=(), **kw):
        return self.send("UPDATE", seconds, bids, asks, **kw)


def messages(spark, *feeds):
    rows = []
    for feed in feeds:
        for instrument, kind, seconds, bids, asks, value, sequence, *_ in feed.rows:
            levels = [[(Decimal(str(p)), Decimal(str(q))) for p, q in side] for side in (bids, asks)]
            rows.append(["KRAKEN", instrument, kind, at(seconds), at(seconds), *levels, value, sequence, "t", 0, len(rows), 0])
    return spark.createDataFrame([tuple(r) for r in rows], BOOK_EVENT)


def run(spark, *feeds, chunk_messages=2, **limits):
    return book.reconstruct(messages(spark, *feeds), book.plain_digits(*TEXT), chunk_messages=chunk_messages, limits=book.Limits(**limits))


def states(spark, feed, **limits):
    return [r.book_state for r in run(spark, feed, **limits).orderBy("src_offset").collect()]


def test_snapshot_update_removal_mismatch_snapshot(spark):
    feed = (Feed().snapshot(0).update(1, bids=[(99.5, 2)]).update(2, bids=[(99.5, 0)])
            .update(3, asks=[(102, 1)], broken=True).update(4, asks=[(103, 1)]).snapshot(5))
    assert states(spark, feed) == ["LIVE", "LIVE", "LIVE", "INVALID", "RESYNCHRONISING", "LIVE"]
    judged = run(spark, feed)
    assert [r.reason for r in book.book_quarantine(judged, "v").collect()] == ["CHECKSUM_MISMATCH"]
    assert [r.requested_at for r in book.resync_requests(book.transitions(judged)).collect()] == [at(3)]
    assert sorted(r.event_time for r in book.book_metrics(judged).collect()) == [at(0), at(1), at(2), at(5)]


def test_nothing_is_trusted_before_a_snapshot_or_after_a_reset(spark):
    feed = Feed().update(0, bids=[(99, 1)]).snapshot(1).update(2, bids=[(98, 1)])
    feed.send("RESET", 3)
    feed.update(4, bids=[(97, 1)]).snapshot(5)
    assert states(spark, feed) == ["UNINITIALISED", "LIVE", "LIVE", "UNINITIALISED", "UNINITIALISED", "LIVE"]


def test_bad_snapshots_are_retried_then_given_up(spark):
    feed = Feed()
    for second in range(3):
        feed.snapshot(second, broken=True)
    feed.update(3, bids=[(98, 1)]).snapshot(4)
    assert states(spark, feed, snapshot_tries=3) == ["LOADING_SNAPSHOT", "LOADING_SNAPSHOT", "INVALID", "RESYNCHRONISING", "LIVE"]


def test_crossed_and_negative_books_are_impossible(spark):
    crossed = Feed().snapshot(0).update(1, bids=[(101, 1)])
    negative = Feed().snapshot(0).update(1, bids=[(98, -1)])
    for feed in (crossed, negative):
        judged = run(spark, feed).orderBy("src_offset").collect()
        assert [(r.book_state, r.fault) for r in judged] == [("LIVE", None), ("INVALID", "IMPOSSIBLE_STATE")]


def test_silence(spark):
    feed = Feed().snapshot(0).update(30, bids=[(98, 1)]).update(130, bids=[(97, 1)]).update(131, bids=[(96, 1)]).snapshot(132)
    limits = book.Limits(stale_ms=10_000, resync_ms=60_000, answer_ms=30_000, requests=2)
    judged = book.reconstruct(messages(spark, feed), book.plain_digits(*TEXT), chunk_messages=2, limits=limits)
    assert [r.book_state for r in judged.orderBy("src_offset").collect()] == [
        "LIVE", "LIVE", "RESYNCHRONISING", "RESYNCHRONISING", "LIVE"]
    moves = {(r["at"], r.from_state, r.to_state) for r in book.transitions(judged, limits, F.lit(at(1000))).collect()}
    assert moves == {
        (at(0), "UNINITIALISED", "LOADING_SNAPSHOT"), (at(0), "LOADING_SNAPSHOT", "LIVE"), (at(10), "LIVE", "STALE"),
        (at(30), "STALE", "LIVE"), (at(40), "LIVE", "STALE"), (at(90), "STALE", "RESYNCHRONISING"),
        # Asked for at 90, failed at 120, asked for again and answered at 132.
        (at(120), "RESYNCHRONISING", "INVALID"), (at(120), "INVALID", "RESYNCHRONISING"),
        (at(132), "RESYNCHRONISING", "LOADING_SNAPSHOT"), (at(132), "LOADING_SNAPSHOT", "LIVE"),
        # Silent to the end of the log: stale, given up, asked for twice, invalid for good.
        (at(142), "LIVE", "STALE"), (at(192), "STALE", "RESYNCHRONISING"), (at(222), "RESYNCHRONISING", "INVALID"),
        (at(222), "INVALID", "RESYNCHRONISING"), (at(252), "RESYNCHRONISING", "INVALID")}
    now = {s: book.book_current(judged, F.lit(at(s)), limits).collect()[0].book_state for s in (133, 150, 200, 300)}
    assert now == {133: "LIVE", 150: "STALE", 200: "RESYNCHRONISING", 300: "INVALID"}


def test_messages_without_a_checksum_are_not_trusted(spark):
    feed = Feed().snapshot(0).update(1, bids=[(98, 1)])
    feed.rows[1] = (*feed.rows[1][:5], None, *feed.rows[1][6:])
    assert states(spark, feed) == ["LIVE", "INVALID"]
    assert states(spark, feed, trust_unchecked=True) == ["LIVE", "LIVE"]


def test_levels_below_the_depth_come_back(spark):
    """Twelve levels a side: the best ten are shown, all are held, and removing the best ones brings the others up."""
    feed = Feed().snapshot(0, [(99 - i, i + 1) for i in range(12)], [(101 + i, i + 1) for i in range(12)])
    feed.update(1, bids=[(99, 0), (98, 0), (97, 0)]).update(2, asks=[(120, 3)])
    numbered = book.number(messages(spark, feed), 2)
    shown = book.apply_deltas(numbered).orderBy("src_offset").collect()
    assert [[int(x.price) for x in r.book_bids] for r in shown] == [list(range(99, 89, -1)), list(range(96, 87, -1)), list(range(96, 87, -1))]
    [whole] = book.with_levels(book.book_current(run(spark, feed)), numbered).collect()
    assert {x.price: x.quantity for x in whole.book_bids} == feed.bids and {x.price: x.quantity for x in whole.book_asks} == feed.asks
    assert [x.price for x in whole.book_bids] == sorted(feed.bids, reverse=True) and [x.price for x in whole.book_asks] == sorted(feed.asks)


def test_sequences_when_a_source_has_them(spark):
    feed = (Feed().snapshot(0, sequence=1).update(1, bids=[(98, 1)], sequence=2).update(2, bids=[(98, 1)], sequence=2)
            .update(3, bids=[(97, 1)], sequence=4))
    kept = book.idempotent_updates(messages(spark, feed))
    assert [r.sequence for r in kept.orderBy("src_offset").collect()] == [1, 2, 4]
    judged = book.reconstruct(kept, book.plain_digits(*TEXT), limits=book.Limits(use_sequence=True)).orderBy("src_offset").collect()
    assert [(r.book_state, r.fault) for r in judged][-1] == ("INVALID", "SEQUENCE_GAP")


def test_metrics(spark):
    feed = Feed().snapshot(0, bids=[(99, 3), (98, 2)], asks=[(101, 1), (102, 4)])
    [m] = book.book_metrics(run(spark, feed)).collect()
    assert (m.best_bid, m.best_ask, m.mid_price, m.spread, m.spread_bps) == (99, 101, 100, 2, 200)
    assert (m.weighted_mid, m.bid_depth, m.ask_depth, m.imbalance) == (Decimal("100.5"), 5, 5, 0)
    assert m.checksum_verified
    [one_level] = book.book_metrics(book.judge(book.number(messages(spark, feed)), book.plain_digits(*TEXT), 1, limits=book.Limits(trust_unchecked=True))
                                    .withColumn("book_state", F.lit("LIVE"))).collect()
    assert (one_level.bid_depth, one_level.ask_depth, one_level.imbalance) == (3, 1, Decimal("0.5"))


@pytest.mark.parametrize("chunk_messages", [3, 1000])
def test_chunked_rebuild_equals_sequential_replay(spark, chunk_messages):
    rng = random.Random(chunk_messages)
    feeds = []
    for name in "AB":
        feed = Feed(name)
        feed.snapshot(0, [(90 + i, i + 1) for i in range(5)], [(110 + i, i + 1) for i in range(5)])
        for second in range(1, 60):
            if rng.random() < 0.05:
                feed.snapshot(second, [(95, 1)], [(105, 2)])
            else:
                side = rng.random() < 0.5
                price = rng.randint(80, 99) if side else rng.randint(101, 120)
                held = feed.bids if side else feed.asks
                quantity = 0 if Decimal(price) in held and rng.random() < 0.4 else rng.randint(1, 9)
                feed.update(second, [(price, quantity)] if side else (), () if side else [(price, quantity)])
        feeds.append(feed)
    rebuilt = book.checksum_verify(book.apply_deltas(book.number(messages(spark, *feeds), chunk_messages)), book.plain_digits(*TEXT))
    got = rebuilt.orderBy("src_offset").collect()
    assert {r.book_state for r in run(spark, *feeds, chunk_messages=chunk_messages).select("book_state").distinct().collect()} == {"LIVE"}
    want = [row for feed in feeds for row in feed.rows]
    assert len(got) == len(want)
    for r, (*_, bids, asks) in zip(got, want):
        assert {level.price: level.quantity for level in r.book_bids} == {p: bids[p] for p in sorted(bids, reverse=True)[:10]}
        assert [level.price for level in r.book_asks] == sorted(asks)[:10]
        assert r.checksum_verified


def test_parse_book(spark):
    payloads = [
        '{"channel":"book","type":"snapshot","data":[{"symbol":"btc/usd","bids":[{"price":99.5,"qty":1}],"asks":[{"price":"101","qty":2}],"checksum":4294967295,"timestamp":"2024-01-01T00:00:00.5Z"}]}',
        '{"channel":"book","type":"update","data":[{"symbol":"BTC/USD","bids":[],"asks":[{"price":101,"qty":0}],"checksum":1}]}',
        '{"channel":"book","type":"update","data":[{"symbol":"BTC/USD","bids":[{"price":"x","qty":0}],"asks":[]}]}',
        '{"channel":"book","type":"other","data":[{"symbol":"BTC/USD"}]}', '{"channel":"trade","type":"update"}', "{",
        '{"channel":"book","type":"connection_reset","data":[{"symbol":"BTC/USD"}]}']
    rows = [(f"e{i}", "KRAKEN", "book", None, at(0.4), "c", i, bytearray(p.encode()), "json", "t", 1, "K", 0, i) for i, p in enumerate(payloads)]
    parsed = book.parse_book(spark.createDataFrame(rows, RAW_ENVELOPE)).orderBy("src_offset")
    assert [(r.route, r.reason, r.type) for r in parsed.collect()] == [
        ("book", None, "SNAPSHOT"), ("book", None, "UPDATE"), ("invalid", "SCHEMA_INVALID", "UPDATE"),
        ("invalid", "SCHEMA_INVALID", None), ("invalid", "UNKNOWN_TYPE", "UPDATE"), ("dead", None, None), ("book", None, "RESET")]
    first = book.book_messages(parsed).collect()[0]
    assert (first.instrument, first.checksum, first.event_time) == ("BTC/USD", 4294967295, at(0.5))
    assert (first.bids[0].price, first.asks[0].quantity) == (Decimal("99.5"), 2)


def test_stale_book_and_liquidity_alerts(spark):
    feed = Feed().snapshot(0, [(99, 10)], [(101, 10)])
    for second in range(1, 6):
        feed.update(second, bids=[(99, 10 + second % 2)])
    feed.update(6, bids=[(99, 1)], asks=[(101, 1)]).update(40, bids=[(99, 2)])
    judged = run(spark, feed)
    [drop, _] = alerts.alert_liquidity_drop(book.book_metrics(judged), 5_000, 0.5, "v").orderBy("triggered_at").collect() + [None]
    assert drop.triggered_at == at(6) and drop.type == "LIQUIDITY_DROP"
    [stale] = alerts.alert_stale_book(rolling.inter_trade_gaps(judged, 10_000), 10_000, "v").collect()
    assert (stale.triggered_at, stale.severity) == (at(16), "CRITICAL")


def test_union_of_snapshots_and_updates(spark):
    both = messages(spark, Feed().snapshot(0).update(1, bids=[(98, 1)]))
    joined = book.union_book_events(both.where("type = 'SNAPSHOT'").drop("type", "sequence"), both.where("type = 'UPDATE'").drop("type"))
    assert sorted(r.type for r in joined.collect()) == ["SNAPSHOT", "UPDATE"]


def stream_feeds():
    feed = Feed().update(0, bids=[(98, 1)]).snapshot(1, broken=True).snapshot(2, broken=True).update(3, bids=[(98, 1)]).snapshot(4)
    feed.update(5, bids=[(98, 2)]).update(6, asks=[(103, 2)], broken=True).update(7, bids=[(97, 1)]).snapshot(8, broken=True)
    feed.snapshot(9, bids=[(99, 2), (98, 2)]).update(10, bids=[(99, 0)]).update(40, bids=[(97, 5)]).update(200, bids=[(96, 5)])
    feed.send("RESET", 201)
    feed.update(202, bids=[(95, 1)]).snapshot(203).update(204, asks=[(104, 4)]).update(205, asks=[(101, 0)])
    other = Feed("B").snapshot(206).update(207, bids=[(98, 3)]).update(208, bids=[(98, 0)])
    third = Feed("C").snapshot(300).update(301, bids=[(98, 3)]).update(700, bids=[(98, 4)], broken=True).update(2000, bids=[(97, 4)])
    return feed, other, third


def random_feeds(seed):
    """Books that break, fall silent and come back, in one time order over instruments."""
    rng, feeds, second = random.Random(seed), [Feed(name) for name in "ABC"], 0
    order = []
    for _ in range(160):
        second += rng.choice([0, 1, 1, 2, 5, 9, 30])
        feed = rng.choice(feeds)
        draw = rng.random()
        if draw < 0.2:
            feed.snapshot(second, [(95, 1), (94, 2)], [(105, 2)], broken=rng.random() < 0.4)
        elif draw < 0.25:
            feed.send("RESET", second)
        else:
            price = rng.choice([93, 94, 95, 96, 106])
            feed.update(second, [(price, rng.choice([1, 2, 3]))], broken=rng.random() < 0.08)
        order.append(feed.rows[-1])
    whole = Feed()
    whole.rows = order
    return (whole,)


@pytest.mark.parametrize("feeds", [stream_feeds(), random_feeds(1), random_feeds(2)], ids=["cases", "random-1", "random-2"])
def test_machine_equals_batch(spark, feeds):
    """The keyed state machine, message by message, and the batch form give the same books and moves."""
    from tickweave.streaming import book as stream
    limits = book.Limits(stale_ms=10_000, resync_ms=60_000, answer_ms=45_000, requests=2)
    log = messages(spark, *feeds)
    judged = book.reconstruct(log, book.plain_digits(*TEXT), chunk_messages=3, limits=limits)
    rows = sorted(log.collect(), key=lambda r: r.src_offset)
    end = max(r.event_time for r in rows)
    machines, states, moves = {}, [], []
    for r in rows:
        machine = machines.setdefault(r.instrument, stream.Machine(limits, stream.plain_text(*TEXT), 10))
        told, left = machine.message(r)
        moves += [(r.instrument, *m[:3]) for m in told]
        states.append((r.src_offset, left["book_state"], left["previous_state"], left["fault"], left["checksum_verified"], left["bid_depth"]))
    for name, machine in machines.items():
        moves += [(name, *m[:3]) for m in machine.silence(stream._millis(end))]
    columns = ["src_offset", "book_state", "previous_state", "fault", "checksum_verified", "bid_depth"]
    assert sorted(states) == sorted(map(tuple, judged.select(*columns).collect()))
    batch = book.transitions(judged, limits, F.lit(end)).select("instrument", F.unix_millis("at"), "from_state", "to_state").collect()
    assert sorted(moves) == sorted(map(tuple, batch))
    assert len({m[2:] for m in moves}) >= 9


def test_stream_with_timers_equals_batch(spark, tmp_path):
    from tickweave.schemas import BOOK_EVENT as event
    from tickweave.streaming import book as stream
    limits = book.Limits(stale_ms=10_000, resync_ms=60_000, answer_ms=45_000, requests=2)
    log = messages(spark, *stream_feeds())
    for number, (low, high) in enumerate([(0, 9), (9, 18), (18, 40)]):
        log.where(F.col("src_offset").between(low, high - 1)).write.parquet(str(tmp_path / "in" / str(number)))
        source = spark.readStream.schema(event).parquet(str(tmp_path / "in" / "*"))
        books = stream.book_stream(source, stream.plain_text(*TEXT), limits)
        stream.start(books, str(tmp_path / "out"), str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out" / "book.states"))
    judged = book.reconstruct(log, book.plain_digits(*TEXT), limits=limits)
    moved = ["instrument", "at", "from_state", "to_state"]
    want = book.transitions(judged, limits, F.lit(at(2000)))
    assert sorted(map(tuple, stream.moves(got).select(*moved).collect())) == sorted(map(tuple, want.select(*moved).collect()))
    shown = ["instrument", "src_offset", "best_bid", "best_ask", "bid_depth", "ask_depth", "imbalance"]
    assert (sorted(map(repr, spark.read.parquet(str(tmp_path / "out" / "derived.book.metrics")).select(*shown).collect()))
            == sorted(map(repr, book.book_metrics(judged).select(*shown).collect())))
    asked = spark.read.parquet(str(tmp_path / "out" / "control.book.resync"))
    assert {r.event_id for r in asked.collect()} == {r.event_id for r in book.resync_requests(want).collect()}


def test_digests_equal_books_shown_in_full(spark):
    """Checksums and depths worked out in the rebuild, over several epochs a chunk, equal those of the ten levels shown."""
    random.seed(5)
    feeds = [Feed("A"), Feed("B")]
    for second in range(60):
        feed = feeds[second % 2]
        if second % 14 < 2:
            feed.snapshot(second, [(99 - i, i + 0.125) for i in range(1, 13)], [(101 + i, i + 20) for i in range(12)])
        else:
            feed.update(second, bids=[(random.randint(80, 99), random.randint(1, 4))], asks=[(random.randint(101, 115), 10 ** random.randint(0, 15))])
    numbered, text = book.number(messages(spark, *feeds), 8), book.plain_digits(*TEXT)
    rebuilt = book.apply_deltas(numbered, text=text)
    full = book.checksum_verify(book.apply_deltas(numbered), text)
    shown = [F.slice(side, 1, 1).alias(side) for side in ("book_bids", "book_asks")]
    want = full.select("src_offset", "negative", "computed_checksum", *shown, book.depth_of(F.col("book_bids"), 10), book.depth_of(F.col("book_asks"), 10))
    got = rebuilt.select("src_offset", "negative", "computed_checksum", "book_bids", "book_asks", "bid_depth", "ask_depth")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 60


def test_machine_makes_a_text_once_for_each_level_set():
    """A message costs the levels it sets, not the twenty levels shown."""
    from pyspark.sql import Row
    from tickweave.streaming import book as stream
    made = []

    class Counted(stream.PlainText):
        def level(self, price, quantity):
            made.append(price)
            return super().level(price, quantity)
    feed = Feed().snapshot(0, [(99 - i, i + 1) for i in range(12)], [(101 + i, i + 1) for i in range(12)])
    for second in range(1, 50):
        feed.update(second, bids=[(99 - second % 13, second % 3)])
    machine, verified = stream.Machine(book.Limits(), Counted(*TEXT), 10), set()
    for n, (_, kind, seconds, bids, asks, value, sequence, *_) in enumerate(feed.rows):
        levels = [[Row(price=Decimal(str(p)), quantity=Decimal(str(q))) for p, q in side] for side in (bids, asks)]
        verified.add(machine.message(Row(type=kind, event_time=at(seconds), bids=levels[0], asks=levels[1], checksum=value, sequence=sequence))[1]["checksum_verified"])
    assert verified == {True} and len(made) == 24 + sum(second % 3 > 0 for second in range(1, 50))


def exact_parts(spark, root, log, cuts, limits):
    from tickweave.streaming import book as stream
    job = stream.ExactBooks(str(root), book.plain_digits(*TEXT), limits, chunk_messages=4)
    for number, (low, high) in enumerate(zip(cuts, cuts[1:])):
        job.process(log.where(F.col("src_offset").between(low, high - 1)), number)
    # A batch that is run again gives the same.
    job.process(log.where(F.col("src_offset").between(cuts[-2], cuts[-1] - 1)), len(cuts) - 2)
    return job


@pytest.mark.parametrize("seed", [None, 1])
def test_exact_stream_of_books_equals_batch(spark, tmp_path, seed):
    """Batches cut epochs, chunks, silences and waits for a snapshot; one brings no message of some instruments."""
    limits = book.Limits(stale_ms=10_000, resync_ms=60_000, answer_ms=45_000, requests=2, use_sequence=True)
    log = messages(spark, *(stream_feeds() if seed is None else random_feeds(seed)))
    log = log.withColumn("sequence", F.when(F.col("src_offset") % 5 != 0, F.col("src_offset") + F.col("src_offset").cast("int") % 3))
    job = exact_parts(spark, tmp_path, log, [0, 5, 6, 13, 19, 160], limits)
    judged = book.reconstruct(log, book.plain_digits(*TEXT), limits=limits)
    end = log.agg(F.max("event_time")).first()[0]
    moved = ["instrument", "at", "from_state", "to_state", "reason"]
    want = sorted(map(tuple, book.transitions(judged, limits, F.lit(end)).select(*moved).collect()))
    assert sorted(map(tuple, job.moves(spark, F.lit(end)).select(*moved).collect())) == want
    shown = ["src_offset", "epoch", "message_no", "clock", "book_state", "settled_state", "previous_state", "fault", "asked_ms", "book_bids", "book_asks", "bid_depth", "ask_depth"]
    assert sorted(map(repr, job.states(spark).select(*shown).collect())) == sorted(map(repr, judged.select(*shown).collect()))


def test_exact_stream_loses_no_message_where_times_run_back(spark, tmp_path):
    log = messages(spark, Feed().snapshot(1000).update(1001, bids=[(98, 1)]).update(1, bids=[(97, 1)]).update(2, bids=[(96, 1)]), Feed("B").snapshot(3).update(4, bids=[(98, 1)]))
    job = exact_parts(spark, tmp_path, log, [0, 2, 4, 6], book.Limits())
    assert sorted(r.src_offset for r in job.states(spark).where("book_state = 'LIVE'").collect()) == [0, 1, 2, 3, 4, 5]


def test_states_name_the_last_message(spark):
    states = run(spark, Feed().snapshot(0).update(1, bids=[(98, 1)]).update(2), Feed("B").snapshot(3))
    assert sorted((r.instrument, r.message_no) for r in states.where("is_last").collect()) == [("A", 3), ("B", 1)]
