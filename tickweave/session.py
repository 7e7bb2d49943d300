"""Session settings the engine's exact results rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Runtime SQL settings. All can be changed on a live session.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # (38,18)/(38,18) keeps 18 decimals, rounded HALF_UP; the default keeps only 6.
    "spark.sql.decimalOperations.allowPrecisionLoss": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # HotSpot does not compile methods above 8000 bytecodes; past that, Spark's split projections
    # are faster than one interpreted whole-stage method (wide decimal and parsing stages).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # State larger than the heap has to live on disk, not in a JVM map.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`RUNTIME_CONF` to an existing session and return it."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app: str = "tickweave", master: str | None = None, **conf: str) -> SparkSession:
    """Session for applications and tests; a cluster's own submit settings win when no master is given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, for checkpoints and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``. Only a local-mode session without
    that setting gets a temporary folder, because there every task shares one disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def materialise(df: DataFrame, name: str, folder: str | None = None, codec: str | None = None) -> DataFrame:
    """Write an intermediate result used several times to the shared folder and read it back.

    Unlike a cache it survives lost executors, and unlike a checkpoint it keeps column pruning.
    Without ``folder`` a new one is taken, the caller's to expire as with Spark's own
    checkpoints; with it, ``folder/name`` is overwritten. ``codec`` is for results whose size on disk counts, as those with texts.
    """
    path = f"{folder}/{name}" if folder else f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    writer = df.write.mode("overwrite")
    (writer.option("compression", codec) if codec else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
