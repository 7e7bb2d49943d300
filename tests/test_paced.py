"""Micro-batches by rows or age: none above the limit, none lost or repeated, over restarts too."""

from __future__ import annotations

import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from tickweave.sources.paced import PacedReader, scan_paced


def write(folder, name, first, n):
    folder.mkdir(exist_ok=True)
    pq.write_table(pa.table({"n": pa.array(range(first, first + n), pa.int64())}), folder / name, row_group_size=4)


def reader(tmp_path, rows=10, age=60_000):
    return PacedReader({"path": str(tmp_path / "in"), "cursor": str(tmp_path / "cursor"), "maxrows": str(rows), "maxagems": str(age)})


def taken(source, start, end):
    return [n for part in source.partitions({"rows": start}, {"rows": end}) for batch in source.read(part) for n in batch.column(0).to_pylist()]


def test_full_batches_at_once_and_the_rest_by_age(tmp_path):
    for k in range(3):
        write(tmp_path / "in", f"{k}.parquet", 9 * k, 9)
    source, at, got = reader(tmp_path), 0, []
    for want in (10, 20, 20, 20):
        end = source.latestOffset()["rows"]
        assert end == want
        got += taken(source, at, end)
        at = end
    assert got == list(range(20))
    source.age_ms = 1
    time.sleep(0.01)
    assert source.latestOffset() == {"rows": 27}
    assert got + taken(source, 20, 27) == list(range(27))


def test_files_that_come_later_are_appended(tmp_path):
    write(tmp_path / "in", "0.parquet", 0, 5)
    source = reader(tmp_path)
    assert source.latestOffset() == {"rows": 0}
    write(tmp_path / "in", "1.parquet", 5, 30)
    assert source.latestOffset() == {"rows": 10} and taken(source, 0, 10) == list(range(10))
    write(tmp_path / "in", "00.parquet", 0, 1)
    with pytest.raises(ValueError, match="would move"):
        source.latestOffset()


def test_restart_goes_on_where_it_was(tmp_path):
    write(tmp_path / "in", "0.parquet", 0, 35)
    source = reader(tmp_path)
    taken(source, 0, source.latestOffset()["rows"])
    source.latestOffset()
    # Admitted but never planned: the next reader gives the same end first, so that the batch is no larger.
    again = reader(tmp_path)
    assert again.latestOffset() == {"rows": 20} and taken(again, 10, 20) == list(range(10, 20))
    assert again.latestOffset() == {"rows": 30}
    # Planned and finished before the stop: the end is asked for twice and then moves on.
    taken(again, 20, 30)
    last = reader(tmp_path, age=1)
    assert [last.latestOffset()["rows"] for _ in range(2)] == [30, 35]


def test_empty_folder_and_bad_limits(tmp_path):
    assert reader(tmp_path).latestOffset() == {"rows": 0}
    with pytest.raises(ValueError):
        reader(tmp_path, rows=0)


def test_stream_over_a_restart(spark, tmp_path):
    folder = tmp_path / "in"
    sizes, seen = [], []

    def run(expected):
        def keep(batch, number):
            rows = [r.n for r in batch.collect()]
            sizes.append(len(rows))
            seen.extend(rows)
        query = scan_paced(spark, str(folder), spark.createDataFrame([], "n long").schema, str(tmp_path / "cursor"), 10, 300) \
            .writeStream.foreachBatch(keep).option("checkpointLocation", str(tmp_path / "check")).trigger(processingTime="0 seconds").start()
        for _ in range(60):
            query.processAllAvailable()
            if len(seen) >= expected:
                break
            query.awaitTermination(1)
        query.stop()

    write(folder, "0.parquet", 0, 27)
    run(27)
    write(folder, "1.parquet", 27, 13)
    run(40)
    assert sorted(seen) == list(range(40)) and max(sizes) == 10 and [n for n in sizes if n] == [10, 10, 7, 10, 3]


def test_full_batches_that_wait_come_many_at_a_time(tmp_path):
    for k in range(3):
        write(tmp_path / "in", f"{k}.parquet", 15 * k, 15)
    source = PacedReader({"path": str(tmp_path / "in"), "cursor": str(tmp_path / "cursor"), "maxrows": "4", "maxagems": "0", "maxbatches": "6", "batchcolumn": "started"})
    ends = [0]
    for _ in range(3):
        ends.append(source.latestOffset()["rows"])
        at, end = ends[-2:]
        got = [r for part in source.partitions({"rows": at}, {"rows": end}) for batch in source.read(part) for r in batch.to_pylist()]
        assert got == [{"n": n, "started": n // 4 * 4} for n in range(at, end)]
    assert ends == [0, 24, 44, 45]
