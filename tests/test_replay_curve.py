"""Row-rate replay, run counters, and the one-file learning curve."""

import logging
import random
import time

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from driftline.session import fresh_folder, fresh_path
from driftline.sources.rows import ranges, stream_rows, table_files
from driftline.sources.sinks import callback, write_batch
from driftline.streaming.curves import StreamCurve, evaluation_stream
from driftline.streaming.progress import RunCounter, counted
from driftline.streaming.store import ModelStore

EVERY_TICK = {"processingTime": "0 seconds"}


def numbers(folder, sizes, groups=7):
    """Files of consecutive numbers with small row groups."""
    at = 0
    for i, n in enumerate(sizes):
        pq.write_table(pa.table({"k": range(at, at + n), "text": [f"t{j}" for j in range(at, at + n)]}), f"{folder}/part-{i:03}.parquet", row_group_size=groups)
        at += n


def test_ranges_cover_each_row_once():
    files = [("a", 5), ("b", 0), ("c", 12)]
    for limit in (1, 4, 100):
        for start in range(18):
            for end in range(start, 18):
                rows = [(r.file, i) for r in ranges(files, start, end, limit) for i in range(r.start, r.end)]
                assert rows == ([("a", i) for i in range(5)] + [("c", i) for i in range(12)])[start:end]


def drained(stream, path, name="rows", stop_after=None):
    """Batch numbers and rows of a run; with ``stop_after`` the run is killed by a failing micro-batch."""

    def receive(batch_id, part):
        if stop_after is not None and batch_id >= stop_after:
            raise RuntimeError("killed")
        write_batch(part, f"{path}/{name}", batch_id)

    query = callback(stream, receive, f"{path}/checkpoint", EVERY_TICK)
    try:
        query.processAllAvailable()
    except Exception as e:
        if "killed" not in str(e):
            raise
    finally:
        query.stop()


def test_replay_releases_rows_per_tick_and_a_restart_repeats_none(spark, tmp_path):
    (tmp_path / "in").mkdir()
    numbers(tmp_path / "in", [10, 23, 0, 12])
    assert [n for _, n in table_files(str(tmp_path / "in"))] == [10, 23, 0, 12]
    schema = spark.createDataFrame([], "k long").schema
    stream = lambda: stream_rows(spark, str(tmp_path / "in"), schema, 8, str(tmp_path / "position"))
    drained(stream(), str(tmp_path), stop_after=2)
    drained(stream(), str(tmp_path))
    numbers(tmp_path / "in", [10, 23, 0, 12, 5])  # rows that are appended arrive in a later run
    drained(stream(), str(tmp_path))
    rows = [(r.batch_id, r.k) for r in spark.read.parquet(f"{tmp_path}/rows").orderBy("k").collect()]
    assert [k for _, k in rows] == list(range(50))
    assert all(sum(b == batch for b, _ in rows) <= 8 for batch in {b for b, _ in rows})
    assert [b for b, _ in rows] == sorted(b for b, _ in rows) and sum(b == 0 for b, _ in rows) == 8
    with pytest.raises(ValueError):
        stream_rows(spark, str(tmp_path / "in"), schema, 0, str(tmp_path / "position"))


def test_counter_holds_every_micro_batch(spark, tmp_path):
    (tmp_path / "in").mkdir()
    numbers(tmp_path / "in", [115])
    schema = spark.createDataFrame([], "k long, text string").schema
    stream = stream_rows(spark, str(tmp_path / "in"), schema, 1, str(tmp_path / "position")).withColumn(
        "label", F.when(F.col("k") % 10 == 0, "?").otherwise("a")
    )
    counter = RunCounter()
    spark.streams.addListener(counter)
    try:
        query = counted(stream, "label").writeStream.format("noop").option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(**EVERY_TICK).start()
        query.processAllAvailable()
        query.stop()
        deadline = time.monotonic() + 20
        while counter.instances < 115 and time.monotonic() < deadline:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(counter)
    # Spark itself holds the last hundred reports only.
    assert (counter.instances, counter.asked, counter.batches) == (115, 12, 115)
    assert [n for _, n in counter.points] == list(range(1, 116)) and counter.seconds > 0


def test_curve_file_is_whole_after_a_kill(spark, caplog):
    rng = random.Random(1)
    rows = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(1, 96)]
    source, out = fresh_path(spark, "pairs"), fresh_path(spark, "curve")
    fresh_folder(spark, out)
    spark.createDataFrame(rows, "seq long, truth int, pred int").coalesce(1).write.parquet(source)
    schema = spark.read.parquet(source).schema

    def run(kill=None):
        curve = StreamCurve(spark, out, ModelStore(spark, f"{out}/model"), 2, 10)
        if kill is not None:
            once = curve.add

            def add(pairs, batch_id, prior):
                done = once(pairs, batch_id, prior)
                if batch_id == kill:
                    raise RuntimeError("killed")  # the lines are written, the commit is not
                return done

            curve.add = add
        query = evaluation_stream(stream_rows(spark, source, schema, 25, f"{out}/position"), curve, EVERY_TICK)
        try:
            query.processAllAvailable()
        except Exception as e:
            if "killed" not in str(e):
                raise
        finally:
            query.stop()
        return curve

    partial = open(run(kill=1).file().removeprefix("file:")).read().splitlines()
    with caplog.at_level(logging.INFO, logger="driftline.streaming.curves"):
        curve = run()
        curve.finish()
    lines = open(f"{out}/curve.csv".removeprefix("file:")).read().splitlines()
    assert "# COMPLETED" not in partial and lines[-1] == "# COMPLETED" and lines.count(lines[0]) == 1
    assert lines[: len(partial)] == partial
    points = [int(line.split(",")[0]) for line in lines[1:-1]]
    assert sorted(set(points)) == [10, 20, 30, 40, 50, 60, 70, 80, 90, 95] and points == sorted(points)
    assert len({points.count(p) for p in points}) == 1
    # One line of the log for every point, not one for every micro-batch.
    logged = [r for r in caplog.records if "measurement" in r.message]
    assert len(logged) >= 8
