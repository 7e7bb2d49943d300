"""Reading raw logs, recorded frames and the small configuration tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ids import uuid3
from ..schemas import INSTRUMENT, PROCESSOR_VERSION, RAW_ENVELOPE, SCHEMA_VERSION, TRADES

def scan_raw_envelopes(spark: SparkSession, path: str, streaming: bool = False, **options) -> DataFrame:
    """Raw envelopes from Parquet; as a stream, files are taken in modification order."""
    reader = (spark.readStream if streaming else spark.read).schema(RAW_ENVELOPE).options(**options)
    return reader.parquet(path)


def scan_trades(spark: SparkSession, path: str, streaming: bool = False, grace: str | None = None,
                **options) -> DataFrame:
    """Normalised trades; streams get their event-time watermark here."""
    reader = (spark.readStream if streaming else spark.read).schema(TRADES).options(**options)
    trades = reader.parquet(path)
    return trades.withWatermark("event_time", grace) if streaming and grace else trades


def scan_kafka(spark: SparkSession, servers: str, topic: str, streaming: bool = True, **options) -> DataFrame:
    """Kafka records with their key and log position; needs the Kafka connector on the classpath."""
    reader = (spark.readStream if streaming else spark.read).format("kafka")
    records = reader.option("kafka.bootstrap.servers", servers).option("subscribe", topic).options(**options).load()
    return records.select(F.col("key").cast("string").alias("record_key"), "value",
                          F.col("partition").alias("src_partition"), F.col("offset").alias("src_offset"))


def decode_event(records: DataFrame, schema_json: str, value: str = "value") -> DataFrame:
    """Registry-framed Avro to columns: five header bytes precede the body.

    Needs the spark-avro package; a body that does not decode becomes a NULL ``event``.
    """
    from pyspark.sql.avro.functions import from_avro

    body = F.substring(F.col(value), F.lit(6), F.length(value))
    return records.withColumn("event", from_avro(body, schema_json, {"mode": "PERMISSIVE"}))


def encode_event(events: DataFrame, schema_json: str, schema_id: int, event: str = "event") -> DataFrame:
    from pyspark.sql.avro.functions import to_avro

    head = F.unhex(F.lit(f"{0:02X}{schema_id:08X}"))
    return events.withColumn("value", F.concat(head, to_avro(F.col(event), schema_json)))


def scan_offset_range(raw: DataFrame, from_offset: int | None = None, to_offset: int | None = None,
                      from_time: Column | None = None, to_time: Column | None = None) -> DataFrame:
    """A replay range: offsets and times are inclusive; a day column, when present, prunes files."""
    out = raw
    if from_offset is not None:
        out = out.where(F.col("src_offset") >= from_offset)
    if to_offset is not None:
        out = out.where(F.col("src_offset") <= to_offset)
    if from_time is not None:
        out = out.where(F.col("received_at") >= from_time)
        if "received_date" in raw.columns:
            out = out.where(F.col("received_date") >= F.to_date(from_time))
    if to_time is not None:
        out = out.where(F.col("received_at") <= to_time)
        if "received_date" in raw.columns:
            out = out.where(F.col("received_date") <= F.to_date(to_time))
    return out


def scan_recorded_frames(spark: SparkSession, path: str, connection: str, instrument: str | None = None,
                         exchange: str = "KRAKEN", channel: str = "trade") -> DataFrame:
    """A recorded ``receivedAtMillis<TAB>payload`` file as raw envelopes.

    Comment and blank lines are skipped. Sequence numbers are the kept lines' positions:
    each file split counts its rows, and a prefix sum over those counts numbers them all, so
    no task sees the whole file.
    """
    lines = spark.read.text(path).select("value", "_metadata.file_path", "_metadata.file_block_start")
    lines = lines.where(~F.col("value").startswith("#") & ~F.col("value").rlike(r"^\s*$"))
    placed = lines.withColumn("__id", F.monotonically_increasing_id())
    split = ["file_path", "file_block_start"]
    sizes = placed.groupBy(*split).agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    # One summary row per file split, in file order.
    earlier = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*split, "__first", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    sequence = F.col("__start") + F.col("__id") - F.col("__first")
    numbered = placed.join(starts, split).withColumn("seq", sequence)
    at = F.substring_index("value", "\t", 1).cast("long")
    payload = F.substring(F.col("value"), F.instr("value", "\t") + 1, F.length("value"))
    return numbered.select(
        uuid3(F.concat(F.lit("replay:"), F.col("seq").cast("string"))).alias("event_id"),
        F.lit(exchange).alias("exchange"), F.lit(channel).alias("channel"),
        F.lit(instrument).cast("string").alias("instrument"), F.timestamp_millis(at).alias("received_at"),
        F.lit(connection).alias("source_connection_id"), F.col("seq").alias("ingest_sequence"),
        payload.cast("binary").alias("payload"), F.lit("json").alias("payload_encoding"),
        F.concat(F.lit("replay-"), F.col("seq").cast("string")).alias("trace_id"),
        F.lit(SCHEMA_VERSION).alias("schema_version"),
        F.lit(None if instrument is None else f"{exchange}|{instrument}").cast("string").alias("record_key"),
        F.lit(0).alias("src_partition"), F.col("seq").alias("src_offset"))


def scan_instruments(registry: DataFrame, exchange: str, required: bool = True) -> DataFrame:
    """Enabled instruments of an exchange in symbol order; none at all is an error."""
    chosen = registry.where((F.col("exchange") == exchange) & F.col("enabled")).select(
        "canonical_symbol", "exchange_symbol").orderBy("canonical_symbol")
    if required and chosen.isEmpty():
        raise LookupError(f"no enabled instruments for {exchange}")
    return chosen


def live_processor_version(versions: DataFrame) -> str:
    """The one version not retired; none or several stop the job."""
    live = versions.where(F.col("retired_at").isNull()).select("processor_version").limit(2).collect()
    if not live:
        raise LookupError("no live row in processor_version")
    if len(live) > 1:
        raise LookupError("more than one live row in processor_version")
    return live[0]["processor_version"]


def read_registry(spark: SparkSession, path: str | None = None, schema: T.StructType = INSTRUMENT, **jdbc) -> DataFrame:
    """A configuration table from Parquet, or over JDBC when ``url`` and ``dbtable`` are given."""
    if path:
        return spark.read.schema(schema).parquet(path)
    return spark.read.format("jdbc").options(**jdbc).load()


def read_versions(spark: SparkSession, path: str | None = None, **jdbc) -> DataFrame:
    return read_registry(spark, path, PROCESSOR_VERSION, **jdbc)
