"""Replays: re-derive a raw range into versioned outputs, and keep a record of who did.

Production outputs have plain names; a replay only ever writes ``<name>.v<n>``.
"""

from __future__ import annotations

import json
from datetime import datetime, timezone
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import alerts, compare
from ..operators.candles import DEFAULT_WINDOW, WindowSpec
from ..operators.dedupe import first_per_key
from ..schemas import ALERTS, REPLAY_JOB, REPLAY_STATUSES
from ..sources.logs import scan_offset_range
from .pipeline import derive

#: Statuses a job may move to from each status.
NEXT_STATUS = {"PENDING": ("RUNNING", "CANCELLED"), "RUNNING": ("COMPLETED", "FAILED", "CANCELLED"),
               "COMPLETED": (), "FAILED": (), "CANCELLED": ()}


def versioned(name: str, version: int) -> str:
    if version < 1:
        raise ValueError("replay versions start at 1")
    return f"{name}.v{version}"


def replay_range(raw: DataFrame, root: str, version: int, processor_version: str, spec: WindowSpec = DEFAULT_WINDOW,
                 large_trade: float | None = None, **bounds) -> dict[str, str]:
    """Re-derive a raw range under ``root``; returns the written paths by stream name.

    ``bounds`` are those of :func:`tickweave.sources.logs.scan_offset_range`. Pass the version
    recorded on an alert to reproduce that alert, with its same id.
    """
    work = f"{root}/work.v{version}"
    outputs = derive(scan_offset_range(raw, **bounds), processor_version, spec, store=work)
    streams = dict(outputs.streams)
    if large_trade is not None:
        streams[ALERTS] = alerts.dedupe_alerts(alerts.alert_large_trade(outputs.trades, large_trade, processor_version))
    paths = {}
    for name, rows in streams.items():
        paths[name] = f"{root}/{versioned(name, version)}"
        rows.write.mode("errorifexists").parquet(paths[name])
    return paths


def compare_versions(spark: SparkSession, root: str, name: str, old: int, new: int, **options) -> DataFrame:
    """A/B diff of one replayed stream."""
    return compare.ab_diff(spark.read.parquet(f"{root}/{versioned(name, old)}"),
                           spark.read.parquet(f"{root}/{versioned(name, new)}"), **options)


def alert_refires(replayed: DataFrame, alert_id: str) -> bool:
    return not replayed.where(F.col("alert_id") == alert_id).isEmpty()


def record_status(spark: SparkSession, path: str, job: dict, at: datetime | None = None) -> None:
    """Record a job's new status; impossible moves are refused.

    ``job`` holds :data:`tickweave.schemas.REPLAY_JOB` fields; absent ones are NULL. A job's n-th record is a file of that
    number, and creating it fails if it is there: of two that move a job on at once, one wins, in a store that creates files exclusively.
    """
    status = job.get("status", "PENDING")
    if status not in REPLAY_STATUSES:
        raise ValueError(f"unknown status {status}")
    known = _records(spark, path).where(F.col("id") == job["id"]).select("step", "status").collect()
    latest = max(known, default=None)
    if latest is None and status != "PENDING" or latest is not None and status not in NEXT_STATUS[latest.status]:
        raise ValueError(f"job {job['id']} cannot go from {latest and latest.status} to {status}")
    row = {f.name: job.get(f.name) for f in REPLAY_JOB.fields} | {"status": status}
    line = json.dumps({**row, "recorded_at": at or datetime.now(timezone.utc), "step": len(known)}, default=lambda x: x.isoformat())
    _create(spark, f"{path}/job={quote(str(job['id']), safe='')}/{len(known):06d}.json", line)


def _create(spark: SparkSession, name: str, line: str) -> None:
    """Create a small file that is not there yet."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(name)
    try:
        out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, False)
    except Exception as error:
        if "FileAlreadyExists" in str(error) or "already exists" in str(error):
            raise ValueError(f"{name} was recorded by another job") from error
        raise
    out.write(bytearray(line.encode()))
    out.close()


def _records(spark: SparkSession, path: str) -> DataFrame:
    schema = T.StructType([*REPLAY_JOB.fields, T.StructField("recorded_at", T.TimestampType()), T.StructField("step", T.IntegerType())])
    try:
        return spark.read.schema(schema).json(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replay_jobs(spark: SparkSession, path: str) -> DataFrame:
    """Latest record of each job."""
    return first_per_key(_records(spark, path), ["id"], F.desc("step"))
