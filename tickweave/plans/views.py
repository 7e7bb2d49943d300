"""Market-data views over the shipped tables.

``tape`` is a trade log with late arrivals and duplicates, ``frames`` the same trades as
exchange JSON with every kind of fault, ``registry`` the instrument table, ``lineitem_trades``
a wider load.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.decimals import DECIMAL
from ..functions.ids import trade_event_id
from ..functions.keys import instrument_key
from ..operators.prefix import CHUNK_ROWS, Running, running

EXCHANGE = "KRAKEN"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def base(spark: SparkSession, sf: str) -> DataFrame:
    """One trade per event; every 7th arrives 400 positions late."""
    price, qty = F.col("value").cast("decimal(18,2)"), F.get_json_object("props", "$.k").cast("decimal(18,0)")
    event_time = F.col("ts").cast("timestamp")
    shifted = F.col("event_id") % 7 == 0
    named = table(spark, sf, "events").select(
        F.lit(EXCHANGE).alias("exchange"), F.col("event_type").alias("instrument"),
        F.col("event_id").cast("string").alias("trade_id"), event_time.alias("event_time"),
        (event_time + F.expr("INTERVAL 50 MILLISECONDS")).alias("ingestion_time"),
        F.lit("EXCHANGE").alias("event_time_source"), price.cast(DECIMAL).alias("price"),
        qty.cast(DECIMAL).alias("quantity"), F.when(F.col("user_id") % 2 == 0, "BUY").otherwise("SELL").alias("side"),
        F.concat_ws("|", "event_type", F.col("event_id").cast("string")).alias("dedupe_key"),
        F.concat(F.lit("t-"), F.col("event_id").cast("string")).alias("trace_id"),
        F.lit(0).alias("src_partition"),
        (F.col("event_id") + F.when(shifted, 400).otherwise(0)).alias("src_offset"),
        # At one offset the late arrival has the lower id.
        F.when(shifted, 0).otherwise(1).alias("ordinal"), F.lit(0).alias("dup"))
    key = instrument_key(F.col("exchange"), F.col("instrument"))
    return named.withColumn("event_id", trade_event_id(key, F.col("trade_id")))


def tape(spark: SparkSession, sf: str) -> DataFrame:
    """``base`` plus a second copy of every 11th trade, five positions later."""
    first = base(spark, sf)
    copies = first.where(F.col("trade_id").cast("long") % 11 == 0).withColumns({
        "src_offset": F.col("src_offset") + 5, "ordinal": F.col("ordinal") + 2, "dup": F.lit(1)})
    return first.unionByName(copies)


def lineitem_trades(spark: SparkSession, sf: str) -> DataFrame:
    """Line items as trades of their supplier, in order-key order."""
    price = (F.col("l_extendedprice").cast("decimal(18,2)") / F.col("l_quantity").cast("decimal(18,0)")).cast(DECIMAL)
    return table(spark, sf, "lineitem").select(
        F.lit(EXCHANGE).alias("exchange"), F.col("l_suppkey").cast("string").alias("instrument"),
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trade_id"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"), F.round(price, 2).cast(DECIMAL).alias("price"),
        F.col("l_quantity").cast("decimal(18,0)").cast(DECIMAL).alias("quantity"),
        F.when(F.col("l_linenumber") % 2 == 0, "BUY").otherwise("SELL").alias("side"),
        F.lit("").alias("trace_id"), F.lit(0).alias("src_partition"), F.col("l_orderkey").alias("src_offset"),
        F.col("l_linenumber").alias("ordinal"))


def registry(spark: SparkSession, sf: str) -> DataFrame:
    """One instrument per event type; ``error`` is missing on purpose and ``signup`` is disabled."""
    kinds = table(spark, sf, "events").select("event_type").where("event_type <> 'error'").distinct()
    return kinds.select(
        F.lit(EXCHANGE).alias("exchange"), F.concat(F.upper("event_type"), F.lit("/USD")).alias("canonical_symbol"),
        F.col("event_type").alias("exchange_symbol"), (F.col("event_type") != "signup").alias("enabled"))


#: A second exchange: the same wire symbols under other canonical names, ``view`` disabled.
OTHER = "ZETA"


def registries(spark: SparkSession, sf: str) -> DataFrame:
    """The instruments of both exchanges."""
    other = registry(spark, sf).select(F.lit(OTHER).alias("exchange"), F.concat(F.lit("ZZZ-"), F.upper("exchange_symbol")).alias("canonical_symbol"),
                                       "exchange_symbol", (F.col("exchange_symbol") != "view").alias("enabled"))
    return registry(spark, sf).unionByName(other)


def both_exchanges(rows: DataFrame, number: Column) -> DataFrame:
    """Every third row as the other exchange's."""
    return rows.withColumn("exchange", F.when(number % 3 == 0, OTHER).otherwise(F.col("exchange")))


def copies(spark: SparkSession, sf: str) -> DataFrame:
    """``base`` in order of arrival, with copies of every 11th trade 40 minutes later, every 22nd 80 minutes and every 33rd 5 hours later."""
    number = F.col("trade_id").cast("long")
    delay = F.array_compact(F.array(F.lit(0), F.when(number % 11 == 0, 40), F.when(number % 22 == 0, 80), F.when(number % 33 == 0, 300)))
    sent = base(spark, sf).drop("dup").withColumn("delay", F.explode(delay))
    arrival = F.timestamp_micros(F.unix_micros("ingestion_time") + F.col("delay").cast("long") * 60_000_000)
    return sent.withColumn("ingestion_time", arrival).withColumns({"src_offset": F.unix_micros("ingestion_time"), "ordinal": F.col("delay").cast("int")})


#: Field text of a frame's trade by ``event_id % 50``; other codes are plain trades.
FAULTS = {
    1: "cut off", 2: "ticker channel", 3: "empty data", 4: "no symbol", 5: "blank symbol", 6: "numeric symbol",
    7: "separator in symbol", 8: "unknown side", 9: "no side", 10: "no price", 11: "boolean price",
    12: "text quantity", 13: "price as text", 14: "no trade id", 15: "blank trade id", 16: "no timestamp",
    17: "date only", 18: "two minutes ahead", 19: "array root", 20: "object data", 21: "two trades",
    22: "one-letter side", 23: "negative price", 24: "size below the scale", 25: "padded lower-case symbol",
    26: "numeric channel",
}


def frames(spark: SparkSession, sf: str) -> DataFrame:
    """Raw envelopes, one per event."""
    code = F.col("event_id") % 50
    buy = F.col("user_id") % 2 == 0
    at = F.col("ts").cast("timestamp")
    sent = F.when(code == 18, at + F.expr("INTERVAL 2 MINUTES")).otherwise(at)
    stamp = F.date_format(sent, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")
    price = F.col("value").cast("decimal(18,2)").cast("string")
    qty = F.get_json_object("props", "$.k")
    event_id = F.col("event_id").cast("string")

    def pick(default: Column, **by_code) -> Column:
        out = default
        for name, value in by_code.items():
            out = F.when(code == int(name[1:]), value if isinstance(value, Column) else F.lit(value)).otherwise(out)
        return out

    def quoted(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":"'), value, F.lit('",'))

    def plain(name: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{name}":'), value, F.lit(","))

    symbol = pick(quoted("symbol", F.col("event_type")), c4="", c5='"symbol":"  ",', c6='"symbol":7,',
                  c7='"symbol":"A|B",', c25=quoted("symbol", F.concat(F.lit("  "), F.col("event_type"), F.lit(" "))))
    side = pick(quoted("side", F.when(buy, "buy").otherwise("sell")), c8='"side":"hold",', c9="",
                c22=quoted("side", F.when(buy, "B").otherwise("S")))
    other_side = quoted("side", F.when(buy, "sell").otherwise("buy"))
    price_text = pick(plain("price", price), c10="", c11='"price":true,',
                      c13=quoted("price", F.concat(F.lit(" "), price, F.lit(" "))),
                      c23=plain("price", F.concat(F.lit("-"), price)))
    qty_text = pick(plain("qty", qty), c12='"qty":"abc",', c24='"qty":1e-20,')
    id_text = pick(plain("trade_id", event_id), c14="", c15='"trade_id":" ",')
    time_text = pick(quoted("timestamp", stamp), c16="", c17=quoted("timestamp", F.date_format(at, "yyyy-MM-dd")))
    one = F.concat(F.lit("{"), symbol, side, price_text, qty_text, id_text, time_text, F.lit('"ord_type":"market"}'))
    second = F.concat(F.lit(",{"), symbol, other_side, price_text, qty_text, time_text, F.lit('"ord_type":"limit"}'))
    body = F.concat(F.lit('{"channel":"trade","type":"update","data":['), one,
                    F.when(code == 21, second).otherwise(F.lit("")), F.lit("]}"))
    payload = pick(body, c1='{"channel":"trade","data":[', c2='{"channel":"ticker","data":[]}',
                   c3='{"channel":"trade","data":[]}', c19="[1]", c20='{"channel":"trade","data":{"a":1}}',
                   c26='{"channel":7,"data":[]}')
    return table(spark, sf, "events").select(
        F.concat(F.lit("e-"), event_id).alias("event_id"), F.lit(EXCHANGE).alias("exchange"),
        F.lit("trade").alias("channel"), F.lit(None).cast("string").alias("instrument"),
        F.date_trunc("MILLISECOND", at + F.expr("INTERVAL 50 MILLISECONDS")).alias("received_at"),
        F.concat(F.lit("c"), F.expr("event_id div 1000")).alias("source_connection_id"),
        (F.col("event_id") % 1000).alias("ingest_sequence"), payload.cast("binary").alias("payload"),
        F.lit("json").alias("payload_encoding"), F.concat(F.lit("t-"), event_id).alias("trace_id"),
        F.lit(1).alias("schema_version"), F.lit("KRAKEN|IN").alias("record_key"), F.lit(0).alias("src_partition"),
        F.col("event_id").alias("src_offset"))


def all_frames(spark: SparkSession, sf: str) -> DataFrame:
    """Trade frames, book frames and, for each event, a heartbeat, a status or a subscription answer."""
    number = F.col("event_id")
    payload = (F.when(number % 3 == 0, '{"channel":"heartbeat"}')
               .when(number % 3 == 1, F.concat(F.lit('{"channel":"status","data":[{"connection_id":'), number.cast("string"), F.lit("}]}")))
               .otherwise('{"method":"subscribe","result":{"channel":"book"}}'))
    at = F.date_trunc("MILLISECOND", F.col("ts").cast("timestamp") + F.expr("INTERVAL 50 MILLISECONDS"))
    control = table(spark, sf, "events").select(
        F.concat(F.lit("x-"), number.cast("string")).alias("event_id"), F.lit(EXCHANGE).alias("exchange"), at.alias("received_at"),
        F.lit("x0").alias("source_connection_id"), number.alias("ingest_sequence"), payload.cast("binary").alias("payload"), number.alias("src_offset"))
    return frames(spark, sf).unionByName(book_frames(spark, sf)).unionByName(control, allowMissingColumns=True)


#: Levels of the book messages: the moving ones are these prices plus 0 to 13; crossed ones lie beyond the other side.
BOOK_SHIFTS = 14
BOOK_PRICES = {"BID": (50, 45, 200), "ASK": (110, 155, 10)}
#: From here on one instrument is silent, its messages are another's.
SILENT_FROM = "2024-01-28 00:00:00"


def book_log(spark: SparkSession, sf: str) -> DataFrame:
    """What the events say of each book message, without levels, numbers and checksums: one message per event.

    Every 211th is a snapshot, some are resets. Some messages are lost (a gap in the sequence), cross the book or carry a negative
    quantity. ``signup`` falls silent before the end.
    """
    event_id = F.col("event_id")
    at = F.col("ts").cast("timestamp")
    kind = F.when(event_id % 1999 == 7, "RESET").when(event_id % 211 == 0, "SNAPSHOT").otherwise("UPDATE")
    late = (F.col("event_type") == "signup") & (at >= F.lit(SILENT_FROM).cast("timestamp"))
    return table(spark, sf, "events").select(
        F.lit(EXCHANGE).alias("exchange"), F.when(late, "purchase").otherwise(F.col("event_type")).alias("instrument"), kind.alias("type"),
        at.alias("event_time"), event_id.alias("src_offset"), (F.col("user_id") % BOOK_SHIFTS).alias("shift"),
        F.get_json_object("props", "$.k").cast("int").alias("k"), (event_id % 953 == 11).alias("crosses"), (event_id % 877 == 5).alias("negative"))


def book_messages(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`book_log` with its levels and the checksum of the true book; some checksums are wrong or missing."""
    number = F.col("src_offset")
    none = F.array().cast("array<struct<price:decimal(38,18),quantity:decimal(38,18)>>")

    def level(price: Column, quantity: Column) -> Column:
        return F.struct(price.cast(DECIMAL).alias("price"), quantity.cast(DECIMAL).alias("quantity"))

    def side(name: str, own: Column) -> Column:
        base_price, deep_price, crossing = BOOK_PRICES[name]
        changed = (F.when(F.col("crosses"), level(F.lit(crossing), F.lit(5)))
                   .when(F.col("negative"), level(F.col("shift") + base_price, F.lit(-2))).otherwise(level(F.col("shift") + base_price, F.col("k") % 10)))
        return (F.when(F.col("type") == "SNAPSHOT", F.array(level(F.col("shift") + base_price, 1 + F.col("k") % 9), level(F.lit(deep_price), F.lit(3))))
                .when((F.col("type") == "UPDATE") & own, F.array(changed)).otherwise(none))
    buy = number % 2 == 0
    # Numbered without sorting an instrument in one task; levels and texts are made last, so that they are not moved.
    coded = book_log(spark, sf).withColumns({"step": 1 + (number % 1201 == 13).cast("long"), "starts": (F.col("type") != "UPDATE").cast("long")})
    numbered = running(coded, ["exchange", "instrument"], F.expr(f"src_offset div {CHUNK_ROWS}"), ["src_offset"], {
        "sequence": Running("sum", "step"), "epoch": Running("sum", "starts")}).drop("step", "starts")
    epoch = ["exchange", "instrument", "epoch"]
    told = T.StructType([*numbered.schema.fields, T.StructField("true_checksum", T.LongType())])
    # A fixed number of partitions: Spark joins small ones by their bytes, but these cost Python's time.
    true = numbered.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *epoch).sortWithinPartitions(*epoch, "src_offset").mapInArrow(_true_checksums, told)
    wrong, unchecked = (number % 401 == 0) | (number % 633 == 0), number % 769 == 3
    checksum = F.when(wrong, F.pmod(F.col("true_checksum") + 1, F.lit(1 << 32))).otherwise(F.col("true_checksum"))
    return true.select("exchange", "instrument", "type", "event_time", (F.col("event_time") + F.expr("INTERVAL 50 MILLISECONDS")).alias("ingestion_time"),
                       side("BID", buy).alias("bids"), side("ASK", ~buy).alias("asks"),
                       F.when(~unchecked & (F.col("type") != "RESET"), checksum).alias("checksum"),
                       "sequence", F.concat(F.lit("t-"), number.cast("string")).alias("trace_id"), F.lit(0).alias("src_partition"), "src_offset",
                       F.lit(0).alias("ordinal"))


def _true_checksums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Replay epochs, which lie whole and in order in a task, from the events' own numbers: what the exchange would send."""
    # All prices a side can have, best first, and the place of each: a book is the text of each place, empty without a level.
    prices = {name: sorted({*range(base_price, base_price + BOOK_SHIFTS), deep_price, crossing}, reverse=name == "BID")
              for name, (base_price, deep_price, crossing) in BOOK_PRICES.items()}
    places = {name: {price: k for k, price in enumerate(held)} for name, held in prices.items()}
    books: dict[str, list[str]] = {}
    # Of asks, then bids, the best levels first: two decimals of the price and three of the quantity, without points.
    texts: dict[str, str] = {}
    now = None

    def clear(name: str) -> None:
        books[name], texts[name] = [""] * len(prices[name]), ""

    def put(name: str, price: int, quantity: int) -> None:
        held = books[name]
        held[places[name][price]] = f"{price * 100}{quantity * 1000}" if quantity > 0 else ""
        texts[name] = "".join(held if len(held) - held.count("") <= 10 else [text for text in held if text][:10])

    def listed(column: pa.Array) -> list:
        if column.null_count:
            return column.to_pylist()
        if not pa.types.is_string(column.type):
            return column.to_numpy(zero_copy_only=False).tolist()
        coded = column.dictionary_encode()
        return list(map(coded.dictionary.to_pylist().__getitem__, coded.indices.to_numpy().tolist()))
    for batch in batches:
        sums = []
        for exchange, instrument, epoch, kind, n, shift, k, crosses, negative in zip(*(listed(batch.column(c)) for c in (
                "exchange", "instrument", "epoch", "type", "src_offset", "shift", "k", "crosses", "negative"))):
            if now != (exchange, instrument, epoch):
                now = exchange, instrument, epoch
                clear("BID")
                clear("ASK")
            if kind == "UPDATE":
                name = "BID" if n % 2 == 0 else "ASK"
                base_price, _, crossing = BOOK_PRICES[name]
                if crosses:
                    put(name, crossing, 5)
                else:
                    put(name, base_price + shift, -2 if negative else k % 10)
            else:
                for name, (base_price, deep_price, _) in BOOK_PRICES.items():
                    clear(name)
                    if kind == "SNAPSHOT":
                        put(name, base_price + shift, 1 + k % 9)
                        put(name, deep_price, 3)
            sums.append(zlib.crc32((texts["ASK"] + texts["BID"]).encode()))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sums, pa.int64())], names=[*batch.schema.names, "true_checksum"])


def book_frames(spark: SparkSession, sf: str) -> DataFrame:
    """``book_messages`` as raw exchange JSON, every 50th frame cut off and every 53rd without a symbol."""
    event_id = F.col("src_offset")
    data = F.to_json(F.struct(
        F.when(event_id % 53 != 0, F.col("instrument")).alias("symbol"), *[
            F.transform(name, lambda level: F.struct(level["price"].alias("price"), level["quantity"].alias("qty"))).alias(name)
            for name in ("bids", "asks")], "checksum",
        F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("timestamp")))
    wire = F.when(F.col("type") == "RESET", "connection_reset").otherwise(F.lower("type"))
    text = F.concat(F.lit('{"channel":"book","type":"'), wire, F.lit('","data":['), data, F.lit("]}"))
    cut = F.when(event_id % 50 == 0, F.substring(text, 1, 40)).otherwise(text)
    return book_messages(spark, sf).select(
        F.concat(F.lit("b-"), event_id.cast("string")).alias("event_id"), "exchange", F.lit("book").alias("channel"),
        F.lit(None).cast("string").alias("instrument"), F.date_trunc("MILLISECOND", "ingestion_time").alias("received_at"),
        F.lit("c0").alias("source_connection_id"), event_id.alias("ingest_sequence"), cut.cast("binary").alias("payload"),
        F.lit("json").alias("payload_encoding"), "trace_id", F.lit(1).alias("schema_version"),
        F.lit(None).cast("string").alias("record_key"), "src_partition", "src_offset")
