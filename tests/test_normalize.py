from __future__ import annotations

from decimal import Decimal

from conftest import at

from pyspark.sql import functions as F
from tickweave.operators import frames, normalize
from tickweave.schemas import RAW_ENVELOPE


def envelopes(spark, payloads, received=0.0):
    rows = [(f"e{i}", "KRAKEN", "trade", None, at(received), "c1", i, bytearray(p if isinstance(p, bytes) else p.encode()),
             "json", f"trace-{i}", 1, "KRAKEN|IN", 0, i) for i, p in enumerate(payloads)]
    return spark.createDataFrame(rows, RAW_ENVELOPE)


def trade(**changes):
    import json
    fields = {"symbol": "BTC/USD", "side": "buy", "price": 60000.5, "qty": 0.25, "ord_type": "limit", "trade_id": 7,
              "timestamp": "2024-01-01T00:00:00.123456Z"}
    fields.update(changes)
    return json.dumps({k: v for k, v in fields.items() if v is not ...})


def frame(*trades):
    return '{"channel":"trade","type":"update","data":[' + ",".join(trades) + "]}"


def run(spark, *payloads, **options):
    routed = normalize.normalize_frames(envelopes(spark, payloads), "v1", **options)
    return routed.orderBy("src_offset", "ordinal").collect()


def test_canonical_trade(spark):
    routed = normalize.normalize_frames(envelopes(spark, [frame(trade())]), "v1")
    [t] = normalize.trades(routed).collect()
    assert (t.exchange, t.instrument, t.trade_id, t.side, t.dedupe_key) == ("KRAKEN", "BTC/USD", "7", "BUY", "BTC/USD|7")
    assert (t.price, t.quantity, t.event_time, t.event_time_source) == (Decimal("60000.5"), Decimal("0.25"), at(0.123), "EXCHANGE")
    assert t.processing_time is None and t.source_event_id == "e0" and t.schema_version == 1
    [nested] = normalize.trade_events(normalize.trades(routed)).collect()
    assert nested.header.instrument == "BTC/USD" and nested.trade_id == "7"


def test_frame_guards(spark):
    got = run(spark, "{", "[1]", "3", "", '{"channel":"ticker"}', '{"data":[]}', '{"channel":"trade"}',
              '{"channel":"trade","data":[]}', '{"channel":"trade","data":{"a":1}}')
    assert [r.route for r in got] == ["dead"] * 4 + ["invalid"] * 5
    assert [(r.reason, r.detail) for r in got[4:]] == [
        ("UNKNOWN_TYPE", "channel=ticker"), ("UNKNOWN_TYPE", "channel=null"),
        *[("SCHEMA_INVALID", "trade frame has no data array")] * 3]


def test_dead_letters_are_the_original_envelopes(spark):
    source = envelopes(spark, ["{", frame(trade())])
    routed = normalize.normalize_frames(source, "v1")
    assert normalize.dead_letters(routed, source.columns).collect() == source.where("src_offset = 0").collect()


def test_trade_guards_in_order(spark):
    got = run(spark, frame(trade(symbol=...)), frame(trade(symbol=7)), frame(trade(symbol=" ")), frame(trade(symbol="A|B")),
              frame(trade(side="hold", price="x")), frame(trade(price=...)), frame(trade(qty="abc")), frame(trade(price=True)),
              frame(trade(qty=0)), frame(trade(price=-1)), frame(trade(price=10**21)), frame("5"))
    assert [(r.reason, r.detail) for r in got] == [
        ("SCHEMA_INVALID", "trade at index 0 has no symbol")] * 3 + [
        ("SCHEMA_INVALID", "unusable symbol 'A|B': instrument must not contain '|': 'A|B'"),
        ("SCHEMA_INVALID", "unknown side 'hold'"), *[("SCHEMA_INVALID", "price or qty missing or not numeric")] * 3,
        ("IMPOSSIBLE_STATE", "non-positive price or quantity: 60000.5 @ 0"),
        ("IMPOSSIBLE_STATE", "non-positive price or quantity: -1 @ 0.25"),
        ("SCHEMA_INVALID", normalize.UNFIT), ("SCHEMA_INVALID", "trade at index 0 has no symbol")]
    assert [r.payload_instrument for r in got[:5]] == [None] * 4 + ["BTC/USD"]
    assert [r.output_key for r in got[3:5]] == ["KRAKEN|IN", "KRAKEN|BTC/USD"]


def test_one_row_per_trade_in_a_frame(spark):
    got = run(spark, frame(trade(trade_id=1), trade(symbol=...), trade(trade_id=3, side="S")))
    assert [(r.ordinal, r.route, r.trade_id, r.side) for r in got] == [
        (0, "trade", "1", "BUY"), (1, "invalid", None, None), (2, "trade", "3", "SELL")]
    assert got[1].detail == "trade at index 1 has no symbol"


def test_number_spellings_share_an_id(spark):
    got = run(spark, frame(trade(trade_id=..., price=60000), trade(trade_id=None, price="60000.00"), trade(trade_id=" ", price=60000.0)))
    stem = "c:BTC/USD:1704067200123:60000.000000000000000000:0.250000000000000000:BUY:"
    assert [r.trade_id for r in got] == [stem + "0", stem + "1", stem + "2"]


def test_sizes_below_the_scale_are_positive(spark):
    [r] = run(spark, frame(trade()).replace("0.25", "1e-20"))
    assert (r.route, r.quantity) == ("trade", 0)


def test_exact_decimals_and_large_ids(spark):
    [r] = run(spark, frame(trade()).replace("60000.5", "12345.678901234567890123").replace('"trade_id": 7', '"trade_id": 13834774380200032777'))
    assert (r.price, r.trade_id) == (Decimal("12345.678901234567890123"), "13834774380200032777")


def test_untrusted_times_fall_back(spark):
    got = run(spark, frame(trade(timestamp=...)), frame(trade(timestamp="2024-01-01")), frame(trade(timestamp="2024-01-01T00:01:00.001Z")),
              frame(trade(timestamp="2024-01-01T00:01:00Z")))
    assert [r.event_time_source for r in got] == ["INGESTION_FALLBACK"] * 3 + ["EXCHANGE"]
    assert [r.event_time for r in got] == [at(0)] * 3 + [at(60)]


def test_invalid_event_record(spark):
    routed = normalize.normalize_frames(envelopes(spark, [frame(trade(qty=0))]), "v9")
    first, again = (normalize.invalid_events(routed).collect()[0] for _ in range(2))
    assert first == again
    assert (first.stage, first.reason, first.original_topic, first.original_key, first.instrument, first.processor_version) == (
        "NORMALIZE", "IMPOSSIBLE_STATE", "raw.kraken.trade", "KRAKEN|IN", "BTC/USD", "v9")
    assert bytes(first.original_payload).decode() == frame(trade(qty=0))


def test_oversized_frames_are_quarantined_unparsed(spark):
    got = run(spark, frame(trade()), frame(trade()) + " " * 500, "x" * 600, max_bytes=300)
    assert [(r.route, r.detail) for r in got] == [("trade", None), *[("invalid", "frame exceeds the size limit")] * 2]


def test_frame_classes(spark):
    cases = [
        ('{"channel":"trade","data":[{"symbol":"BTC/USD"}]}', ("TRADE_DATA", "trade", "BTC/USD", None)),
        ('{"channel":"book","data":[{"symbol":"ETH/USD"}]}', ("BOOK_DATA", "book", "ETH/USD", None)),
        ('{"channel":"heartbeat"}', ("HEARTBEAT", "heartbeat", None, None)),
        ('{"channel":"status","data":[{"connection_id":13834774380200032777}]}', ("STATUS", "status", None, "13834774380200032777")),
        ('{"method":"subscribe","result":{"channel":"trade"},"channel":"trade"}', ("SUBSCRIBE_ACK", "subscribe", None, None)),
        ('{"method":null,"channel":"trade","data":[]}', ("TRADE_DATA", "trade", None, None)),
        ('{"channel":"ohlc","data":[{"symbol":"X"}]}', ("UNKNOWN", "ohlc", "X", None)),
        ('{"channel":5}', ("UNKNOWN", None, None, None)), ('{"a":1}', ("UNKNOWN", None, None, None)),
        ('{"channel":"trade","data":[{"symbol":5}]}', ("TRADE_DATA", "trade", None, None)),
        ("{", ("MALFORMED", None, None, None)), ("[]", ("MALFORMED", None, None, None)),
    ]
    got = frames.classify_frames(envelopes(spark, [c for c, _ in cases])).orderBy("src_offset").collect()
    assert [(r.frame_type, r.frame_channel, r.symbol, r.connection_id) for r in got] == [want for _, want in cases]


def test_raw_routing_and_wrapping(spark):
    registry = spark.createDataFrame([("KRAKEN", "BTC/USD", "XBT/USD", True), ("KRAKEN", "OFF/USD", "OFF/USD", False)],
                                     "exchange string, canonical_symbol string, exchange_symbol string, enabled boolean")
    payloads = ['{"channel":"trade","data":[{"symbol":"xbt/usd"}]}', '{"channel":"book","data":[{"symbol":"XBT/USD"}]}',
                '{"channel":"trade","data":[{"symbol":"OFF/USD"}]}', '{"channel":"trade","data":[]}', '{"channel":"heartbeat"}', "{"]
    routed = frames.route_raw(frames.classify_frames(envelopes(spark, payloads)), registry)
    assert [r.target for r in routed.orderBy("src_offset").collect()] == [
        "raw.kraken.trade", "raw.kraken.book", "dead-letter", "dead-letter", None, "dead-letter"]
    wrapped = frames.wrap_envelope(routed).orderBy("ingest_sequence").collect()
    assert [r.record_key for r in wrapped] == ["KRAKEN|BTC/USD", "KRAKEN|BTC/USD", None, None, None]
    assert bytes(wrapped[0].payload).decode() == payloads[0]
    assert [r.event_id for r in wrapped] == [r.event_id for r in frames.wrap_envelope(routed).orderBy("ingest_sequence").collect()]


def test_lookup_is_by_exchange_and_positions_are_shared_by_none(spark):
    registry = spark.createDataFrame([("KRAKEN", "BTC/USD", "XBT", True), ("ZETA", "ZZZ/USD", "xbt", True), ("ZETA", "ETH/USD", "ETH", True)],
                                     "exchange string, canonical_symbol string, exchange_symbol string, enabled boolean")
    rows = spark.createDataFrame([("KRAKEN", "xbt"), ("ZETA", "XBT"), ("KRAKEN", "ETH"), ("OTHER", "XBT")], "exchange string, symbol string")
    found = {(r.exchange, r.symbol): r.canonical_symbol for r in frames.symbol_lookup(rows, registry).collect()}
    assert found == {("KRAKEN", "xbt"): "BTC/USD", ("ZETA", "XBT"): "ZZZ/USD", ("KRAKEN", "ETH"): None, ("OTHER", "XBT"): None}
    assert sorted(r.exchange for r in frames.unknown_symbols(rows, registry).collect()) == ["KRAKEN", "OTHER"]

    from conftest import at
    sent = [(conn, n, at(second)) for conn, n, second in (("c1", 0, 0), ("c1", 1, 5), ("c2", 0, 3), ("c2", 1, 5), ("c3", 0, 4000))]
    routed = spark.createDataFrame([("KRAKEN", bytearray(b"{}"), t, c, n, "raw.kraken.trade", "BTC/USD", "trade") for c, n, t in sent],
                                   "exchange string, payload binary, received_at timestamp, source_connection_id string, ingest_sequence long, "
                                   "target string, canonical_symbol string, frame_channel string")
    wrapped = frames.wrap_envelope(routed, partitions=1).orderBy("src_offset").collect()
    assert [(r.src_offset, r.source_connection_id, r.ingest_sequence) for r in wrapped] == [
        (0, "c1", 0), (1, "c2", 0), (2, "c1", 1), (3, "c2", 1), (4, "c3", 0)]
