"""Two-pass external shuffle into shards, in DataFrame operations only.

Pass one scatters records uniformly over buckets of a bounded number of rows; the bucket is a seeded hash
of the record's content and of its place in its partition, so thousands of equal records spread like any
others. The scattered records are stored in the shared folder, which fixes the assignment: a task that is
run again reads the same bucket. Pass two permutes each bucket and deals the permuted buckets, one behind the
other, over the shards. A bucket is ordered by seeded hashes of its rows' stored places: Spark's own array shuffle, a Fisher-Yates
one, draws from a generator that also depends on the task and on the buckets before it, so a task that is run again
after its executor was lost could place rows anew while others have read the old places.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickweave.session import materialise

#: Bytes of text that a bucket holds on average; one task permutes a bucket in memory.
BUCKET_BYTES = 4 << 20


def row_size(text: Column) -> Column:
    """UTF-8 bytes of a text (null: none) plus one for its end."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def external_shuffle(docs: DataFrame, shards: int = 8, seed: int = 17, text: str = "text",
                     bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """All columns of ``docs`` and ``shard`` (0 to shards-1), ``slot`` (its place in the shard, from 0).

    Law ``rows``: shard counts differ by one at most; rows land independently of their content. Nulls,
    empty texts and repeated rows are rows like others; an empty table gives an empty result. Input
    columns named ``shard`` or ``slot`` are replaced. The order is fixed by the seed and the stored scatter, however
    many partitions or attempts there are.
    """
    own = [c for c in docs.columns if c.lower() not in ("shard", "slot")]
    size = docs.agg(F.sum(row_size(F.col(f"`{text}`")))).first()[0] or 0
    buckets = max(1, -(-size // bucket_bytes))
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(own)])
    scattered = materialise(
        docs.select(row.alias("row"), F.monotonically_increasing_id().alias("place"))
        .select("row", F.pmod(F.xxhash64(F.lit(seed), "place", F.hash("row")), F.lit(buckets)).alias("bucket"), "place"),
        "scatter")
    # One row per bucket: the running count says where the bucket starts.
    starts = scattered.groupBy("bucket").count().select(
        "bucket", (F.sum("count").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))).alias("start"))
    # Places are unique, so equal hashes are no tie.
    draw = F.xxhash64(F.lit(seed + 1), "bucket", "place").alias("draw")
    permuted = (
        scattered.groupBy("bucket").agg(F.sort_array(F.collect_list(F.struct(draw, "place", "row"))).alias("rows"))
        .join(starts, "bucket")
        .select(F.coalesce("start", F.lit(0)).alias("start"), F.posexplode("rows")))
    position = F.col("start") + F.col("pos")
    return permuted.select(
        *[F.col(f"col.row.c{i}").alias(c) for i, c in enumerate(own)],
        F.pmod(position, F.lit(shards)).cast("int").alias("shard"),
        F.floor(position / shards).cast("long").alias("slot"))


def write_shards(docs: DataFrame, folder: str, shards: int = 8, seed: int = 17) -> None:
    """Write the shuffled records, one folder per shard, in slot order inside a file."""
    external_shuffle(docs, shards, seed).repartition("shard", F.floor(F.col("slot") / 65_536)) \
        .sortWithinPartitions("shard", "slot").write.mode("overwrite").partitionBy("shard").parquet(folder)


def op8_sharding(spark, sf: str) -> DataFrame:
    """Digest of every sharded row of ``documents``; sizes and checksums are taken from the shuffled texts."""
    out = external_shuffle(spark.read.parquet(f"{sf}/documents.parquet"))
    text = F.coalesce(F.col("text"), F.lit(""))
    return out.select("doc_id", row_size(F.col("text")).alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
                      F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
