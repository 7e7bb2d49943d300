"""A stream over a growing folder of Parquet files whose micro-batches close by rows or by age.

Spark's own file source can bound a batch by files or bytes. Here a batch is admitted when ``maxRows`` rows wait, and holds no more; a
part-filled one is admitted once its oldest row has waited ``maxAgeMs``. A backlog of full batches can be taken up to ``maxBatches`` at a
time, as each of Spark's own batches costs some planning; ``batchColumn`` then tells the rows of one from those of the next.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import LongType, StructField, StructType

# Rows of a batch at most, and how long its first row may wait.
MAX_ROWS, MAX_AGE_MS = 10_000, 2_000
#: Rows of a task, about; a task holds whole batches, as far as they lie in one file.
TASK_ROWS = 65_536
NAME = "paced"


@dataclass
class Slice(InputPartition):
    """Rows ``start`` to ``end`` of one file, whose first row has the position ``first``; batches are counted from ``since``."""

    path: str
    start: int
    end: int
    first: int
    since: int


class PacedReader(DataSourceStreamReader):
    """Positions count rows over files in the order of their names; files are added whole, under names that rise, and never change.

    How far rows were admitted is kept in ``cursor``, a file of the stream's own, so that a restarted stream goes on where it was.
    """

    def __init__(self, options: dict[str, str]) -> None:
        self.rows, self.age_ms = int(options.get("maxrows", MAX_ROWS)), int(options.get("maxagems", MAX_AGE_MS))
        self.batches, self.batch_column = int(options.get("maxbatches", 1)), options.get("batchcolumn")
        if self.rows < 1 or self.age_ms < 0 or self.batches < 1:
            raise ValueError("maxRows and maxBatches must be positive and maxAgeMs not negative")
        self.fs, self.path = pafs.FileSystem.from_uri(options["path"] if ":/" in options["path"] else f"file://{options['path']}")
        self.cursor_fs, self.cursor = pafs.FileSystem.from_uri(options["cursor"] if ":/" in options["cursor"] else f"file://{options['cursor']}")
        self.files: list[tuple[str, int, float]] = []
        self.admitted, self.planned = self._load(), False

    def _load(self) -> int:
        if self.cursor_fs.get_file_info(self.cursor).type == pafs.FileType.NotFound:
            return 0
        with self.cursor_fs.open_input_stream(self.cursor) as held:
            return json.loads(held.read())["rows"]

    def _keep(self) -> None:
        with self.cursor_fs.open_output_stream(self.cursor) as held:
            held.write(json.dumps({"rows": self.admitted}).encode())

    def _look(self) -> None:
        """Row counts of files not seen before; only their footers are read."""
        known = {name for name, _, _ in self.files}
        found = [f for f in self.fs.get_file_info(pafs.FileSelector(self.path, recursive=True, allow_not_found=True))
                 if f.is_file and f.base_name.endswith(".parquet") and f.path not in known]
        for f in sorted(found, key=lambda f: f.path):
            if self.files and f.path < self.files[-1][0]:
                raise ValueError(f"{f.path} came after {self.files[-1][0]}, so rows that were read would move")
            with self.fs.open_input_file(f.path) as opened:
                self.files.append((f.path, pq.read_metadata(opened).num_rows, f.mtime_ns / 1e6))

    def initialOffset(self) -> dict:
        return {"rows": 0}

    def latestOffset(self) -> dict:
        # A position that is asked for again without having been planned is one that a stream before this one had finished.
        if self.admitted and not self.planned:
            self.planned = True
            return {"rows": self.admitted}
        self._look()
        waiting = sum(n for _, n, _ in self.files) - self.admitted
        if waiting >= self.rows or waiting and time.time() * 1000 - self._oldest() >= self.age_ms:
            self.admitted += min(waiting // self.rows, self.batches) * self.rows or waiting
            self._keep()
        return {"rows": self.admitted}

    def _oldest(self) -> float:
        """When the first row that waits arrived."""
        passed = 0
        for _, n, at in self.files:
            passed += n
            if passed > self.admitted:
                return at
        return time.time() * 1000

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        self._look()
        self.planned, self.admitted = True, max(self.admitted, end["rows"])
        out, first = [], 0
        for path, n, _ in self.files:
            low, high = max(start["rows"] - first, 0), min(end["rows"] - first, n)
            # Cut where a batch ends.
            step = max(TASK_ROWS // self.rows, 1) * self.rows
            while low < high:
                upto = min(low + step - (first + low - start["rows"]) % self.rows, high)
                out.append(Slice(path, low, upto, first, start["rows"]))
                low = upto
            first += n
        return out

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        with self.fs.open_input_file(partition.path) as opened:
            file = pq.ParquetFile(opened)
            # Only row groups that hold some of the rows.
            passed, groups, skipped = 0, [], 0
            for k in range(file.metadata.num_row_groups):
                n = file.metadata.row_group(k).num_rows
                if passed + n <= partition.start:
                    skipped = passed + n
                elif passed < partition.end:
                    groups.append(k)
                passed += n
            passed = skipped
            for batch in file.iter_batches(row_groups=groups):
                low, high = max(partition.start - passed, 0), min(partition.end - passed, len(batch))
                if low < high:
                    yield self._told(batch.slice(low, high - low), partition, passed + low)
                passed += len(batch)
                if passed >= partition.end:
                    return

    def _told(self, rows: pa.RecordBatch, partition: Slice, at: int) -> pa.RecordBatch:
        """With the position at which each row's batch starts."""
        if self.batch_column is None:
            return rows
        behind = np.arange(len(rows)) + (partition.first + at - partition.since)
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(partition.since + behind // self.rows * self.rows, pa.int64())],
                                          names=[*rows.schema.names, self.batch_column])


class PacedSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def streamReader(self, schema: StructType) -> PacedReader:
        return PacedReader({key.lower(): value for key, value in self.options.items()})


def scan_paced(spark: SparkSession, path: str, schema: StructType, cursor: str, max_rows: int = MAX_ROWS, max_age_ms: int = MAX_AGE_MS,
               max_batches: int = 1, batch_column: str | None = None) -> DataFrame:
    """Stream of the Parquet files under ``path`` in batches of at most ``max_rows`` rows; ``cursor`` is a file that belongs to the stream.

    Up to ``max_batches`` full batches come in one of Spark's; ``batch_column`` adds the position of the first row of each row's batch.
    """
    spark.dataSource.register(PacedSource)
    options = {"path": path, "cursor": cursor, "maxRows": max_rows, "maxAgeMs": max_age_ms, "maxBatches": max_batches}
    if batch_column:
        schema, options["batchColumn"] = StructType([*schema.fields, StructField(batch_column, LongType())]), batch_column
    return spark.readStream.format(NAME).schema(schema).options(**options).load()
