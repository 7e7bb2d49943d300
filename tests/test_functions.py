from __future__ import annotations

import uuid
from decimal import ROUND_HALF_UP, Decimal

from conftest import at
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F
from tickweave.functions import decimals, ids, json, keys, times

UNIT = Decimal(1).scaleb(-18)


def one(spark, **columns):
    return spark.range(1).select(*[c.alias(n) for n, c in columns.items()]).collect()[0]


def dec(text):
    return F.lit(text).cast(decimals.DECIMAL)


def test_products_are_exact(spark):
    r = one(spark, a=decimals.exact_mul(dec("1234.567890123456789012"), dec("0.5")),
            b=decimals.exact_mul(dec("60000.12345678"), dec("0.0000000001")),
            c=decimals.exact_mul(dec("-73748566943.440454213370114289"), dec("816031.700678054064387574")),
            d=decimals.exact_mul(dec("99999999999999999999"), dec("10")))
    assert r.a == Decimal("617.283945061728394506")
    assert r.b == Decimal("0.000006000012345678")
    assert r.c == Decimal("-60181168505425033.259267462298365481")
    assert r.d is None


digits = st.integers(min_value=-10**27, max_value=10**27)


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(digits, st.integers(min_value=1, max_value=10**25)), min_size=20, max_size=60))
def test_products_and_quotients_round_half_up(spark, pairs):
    import decimal
    with decimal.localcontext(prec=90):
        rows = [(Decimal(a).scaleb(-18), Decimal(b).scaleb(-18)) for a, b in pairs]
        df = spark.createDataFrame(rows, "a decimal(38,18), b decimal(38,18)")
        for r in df.select("a", "b", decimals.exact_mul(F.col("a"), F.col("b")).alias("m"),
                           decimals.safe_div(F.col("a"), F.col("b")).alias("q")).collect():
            for got, exact in ((r.m, r.a * r.b), (r.q, r.a / r.b)):
                if abs(exact) < Decimal(10) ** 20 - 1:
                    assert got == exact.quantize(UNIT, ROUND_HALF_UP)
                else:
                    assert got is None or abs(got) >= Decimal(10) ** 20 - 2


def test_division_and_parsing_edges(spark):
    r = one(spark, third=decimals.safe_div(dec("1"), dec("3")), zero=decimals.safe_div(dec("1"), dec("0")),
            null=decimals.safe_div(dec("1"), dec(None)), trimmed=decimals.parse_decimal(F.lit("\t 1.5 \n")),
            blank=decimals.parse_decimal(F.lit("  ")), word=decimals.parse_decimal(F.lit("abc")),
            half=decimals.canonical(F.lit("0.0000000000000000005")))
    assert r.third == Decimal("0.333333333333333333")
    assert (r.zero, r.null, r.blank, r.word) == (0, 0, None, None)
    assert (r.trimmed, r.half) == (Decimal("1.5"), UNIT)


def test_uuid3_matches_the_standard_library(spark):
    import hashlib
    names = ["trade:KRAKEN|BTC/USD|1", "", "ü", "candle:KRAKEN|A:M1:0:true"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select("n", ids.uuid3(F.col("n")).alias("u"))
    for r in df.collect():
        assert r.u == str(uuid.UUID(bytes=hashlib.md5(r.n.encode()).digest(), version=3))


def test_keys(spark):
    cases = ["KRAKEN|BTC/USD", " kraken | btc/usd ", "KRAKEN", "", "OTHER|X", "|X", "KRAKEN| ", "KRAKEN|A|B"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, k string")
    got = [r.k for r in df.orderBy("i").select(keys.parse_key(F.col("k")).alias("k")).collect()]
    assert [(g.exchange, g.instrument) for g in got[:2]] == [("KRAKEN", "BTC/USD")] * 2
    assert [g.error for g in got[2:]] == [
        "key has no separator", "key must not be blank", "unknown exchange: 'OTHER'", "exchange must not be blank",
        "instrument must not be blank", "instrument must not contain '|'"]


def test_log_order_sorts_like_its_parts(spark):
    rows = [(p, o, n) for p in (0, 1, 5) for o in (0, 7, 10**15, 9 * 10**18) for n in (0, 3, 999_999)]
    df = spark.createDataFrame(rows, "src_partition int, src_offset long, ordinal int").select("*", keys.log_order().alias("k"))
    assert [tuple(r)[:3] for r in sorted(df.collect(), key=lambda r: r.k)] == sorted(rows)


def test_event_time_trust_limits(spark):
    cases = [(60_000, "EXCHANGE"), (60_001, "INGESTION_FALLBACK"), (-86_400_000, "EXCHANGE"),
             (-86_400_001, "INGESTION_FALLBACK"), (None, "INGESTION_FALLBACK")]
    df = spark.createDataFrame([(at(0), None if ms is None else at(ms / 1000), s) for ms, s in cases],
                               "i timestamp, x timestamp, want string")
    for r in df.select("i", "x", "want", times.resolve_event_time(F.col("x"), F.col("i")).alias("t")).collect():
        assert r.t.source == r.want
        assert r.t.event_time == (r.x if r.want == "EXCHANGE" else r.i)


def test_exchange_time_is_cut_to_millis(spark):
    cases = {"2024-01-01T00:00:10.123999Z": at(10.123), "2024-01-01T00:00:10Z": at(10), "2024-01-01": None, " ": None,
             "2024-01-01T02:00:10+02:00": at(10), "2024-01-01T00:00:10": None, "2024-13-01T00:00:00Z": None, "x": None}
    df = spark.createDataFrame([(k,) for k in cases], "s string").select("s", times.parse_exchange_time(F.col("s")).alias("t"))
    assert {r.s: r.t for r in df.collect()} == cases


def test_window_start_before_the_epoch(spark):
    r = one(spark, w=F.unix_millis(times.window_start(F.timestamp_millis(F.lit(-1)), 60_000)))
    assert r.w == -60_000


def test_json_text_is_not_coerced(spark):
    root = json.parse_object(F.lit('{"a":"x","b":7,"c":null,"d":{"e":1},"f":13834774380200032777,"g":true}'))
    r = one(spark, a=json.text(root, "a"), b=json.text(root, "b"), any_b=json.as_text(root, "b"), c=json.as_text(root, "c"),
            d=json.as_text(root, "d"), f=json.as_text(root, "f"), g=json.as_text(root, "g"), z=json.as_text(root, "z"))
    assert tuple(r) == ("x", None, "7", None, "", "13834774380200032777", "true", None)


def test_bad_utf8_does_not_fail(spark):
    r = one(spark, t=json.payload_text(F.unhex(F.lit("7B22FF227D"))))
    assert r.t == '{"�"}'
