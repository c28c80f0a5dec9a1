import os
import time

from pyspark.sql import functions as F

from ledgerloom.operators import blocks as B
from ledgerloom.plans.jobs import due_periods
from ledgerloom.session import scratch_path
from ledgerloom.sources import delimited, lake
from ledgerloom.streaming import control, jobs, segments
from ledgerloom.streaming.seen import SeenLogs
from ledgerloom.streaming.tables import BatchTable
from ledgerloom.streaming.tiers import TieredTable

SEGMENT = "block_number long, segment_index int, total_segments int, piece string"


def test_segments_over_batches(spark):
    path = scratch_path(spark, "segments")
    batches = [
        [(1, 0, 1, "whole"), (2, 1, 3, "b"), (2, 1, 3, "b"), (3, 0, 2, "x")],
        [(2, 2, 3, "c"), (4, 1, 2, "2"), (4, 0, 2, "1")],
        [(2, 0, 3, "a")],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, SEGMENT).coalesce(1).write.mode("append").parquet(f"{path}/in")
        stream = spark.readStream.schema(SEGMENT).parquet(f"{path}/in")
        out = segments.reassemble_segments(stream)
        control.run_to_end(out.writeStream.format("parquet").option("path", f"{path}/out").option(
            "checkpointLocation", f"{path}/checkpoint"), spark)
    got = sorted((r.block_number, r.value) for r in spark.read.parquet(f"{path}/out").filter("complete").collect())
    assert got == [(1, "whole"), (2, "abc"), (4, "12")]
    everything = spark.createDataFrame([r for b in batches for r in b], SEGMENT)
    batch = {r.block_number: (r.value, r.missing) for r in segments.reassemble_batch(everything).collect()}
    assert batch[2] == ("abc", []) and batch[3] == (None, [1])


def test_a_piece_that_comes_again_after_its_line(spark):
    """It begins no new line that would come out as incomplete; a line that never was whole still does."""
    path = scratch_path(spark, "again")
    batches = [[(2, 0, 2, "a"), (2, 1, 2, "b"), (3, 0, 2, "x")], [(2, 0, 2, "a")], [(9, 0, 1, "later")], [(10, 0, 1, "last")]]
    for rows in batches:
        if rows[0][0] >= 9:
            time.sleep(3)
        spark.createDataFrame(rows, SEGMENT).coalesce(1).write.mode("append").parquet(f"{path}/in")
        out = segments.reassemble_segments(spark.readStream.schema(SEGMENT).parquet(f"{path}/in"), ttl_seconds=2)
        control.run_to_end(out.writeStream.format("parquet").option("path", f"{path}/out").option(
            "checkpointLocation", f"{path}/checkpoint"), spark)
    got = sorted((r.block_number, r.value, r.missing) for r in spark.read.parquet(f"{path}/out").collect())
    assert got == [(2, "ab", []), (3, None, [1]), (9, "later", []), (10, "last", [])]


def test_batch_table_counts_a_repeated_batch_once(spark):
    table = BatchTable(scratch_path(spark, "table"))
    table.write(spark.range(3), 0)
    table.write(spark.range(10, 12), 1)
    table.write(spark.range(20, 24), 1)
    assert sorted(r.id for r in table.read(spark).collect()) == [0, 1, 2, 20, 21, 22, 23]
    assert table.read(spark, before=1).count() == 3
    assert table.read_or(spark, spark.range(0), before=0).count() == 0
    fold = lambda df: df.agg(F.sum("id").alias("id"))
    table.compact(spark, 1, fold)
    assert table.read(spark).first().id == 89
    for k in range(2, 6):
        table.write(spark.range(k, k + 1), k)
        assert table.read(spark, before=k).agg(F.sum("id")).first()[0] == 89 + sum(range(2, k))
        if k % 2:
            table.compact(spark, k - 1, fold)
    assert sorted(os.listdir(table.path.removeprefix("file:"))) == ["base=000000000002", "base=000000000004", "batch=000000000003",
                                                                     "batch=000000000004", "batch=000000000005"]
    assert table.read(spark).agg(F.sum("id")).first()[0] == 89 + 2 + 3 + 4 + 5


def test_late_floor():
    assert jobs.late_floor(100000, start=7, elapsed_seconds=10) == 7
    assert jobs.late_floor(100000, elapsed_seconds=30000) == 100000 - 43200


def test_queue_keeps_first_time(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "k string")
    queue = jobs.enqueue(keys.limit(0).withColumn("queued_at", F.lit(0).cast("bigint")), keys.filter("k = 'a'"), 10)
    queue = jobs.enqueue(queue, keys, 50)
    assert {r.k: r.queued_at for r in queue.collect()} == {"a": 10, "b": 50}
    ready = jobs.due(queue, now=60)
    assert [r.k for r in ready.collect()] == ["a"]
    assert [r.k for r in jobs.dequeue(queue, ready).collect()] == ["b"]


def test_throttle(spark):
    clock, ran = [0.0], []
    throttle = control.Throttle({"x": (100, lambda s: ran.append(clock[0]))}, clock=lambda: clock[0])
    for now in (0.0, 50.0, 100.0, 120.0, 250.0):
        clock[0] = now
        throttle(spark.range(1), 0)
    assert ran == [0.0, 100.0, 250.0]


def test_delay_listener():
    class Progress:
        name, id, batchId, numInputRows, batchDuration = "q", "i", 3, 10, 900

    class Event:
        progress = Progress

    seen = []
    listener = control.DelayListener(500, seen.append)
    listener.onQueryProgress(Event)
    listener.onQueryProgress(Event)
    assert len(seen) == 1 and "900 ms" in seen[0]
    quiet = control.DelayListener(5000, seen.append)
    quiet.onQueryProgress(Event)
    assert len(seen) == 1


def test_stop_by_marker(spark):
    path = scratch_path(spark, "marker")
    spark.range(5).write.parquet(f"{path}/in")
    query = spark.readStream.schema("id long").parquet(f"{path}/in").writeStream.format("noop").option(
        "checkpointLocation", f"{path}/checkpoint").start()
    control.place_marker(spark, f"{path}/running")
    query.processAllAvailable()
    assert control.offsets(query)
    os.remove(f"{path}/running")
    assert control.run_until_marker_gone(query, spark, f"{path}/running", poll_seconds=1) == "stopped"
    assert not query.isActive


def test_bulk_round_trip_with_odd_text(spark):
    path = scratch_path(spark, "bulk")
    rows = [(1, 'say "hi"', None), (2, "", "x"), (3, "back\\slash", "y"), (4, "NILS", "z")]
    df = spark.createDataFrame(rows, "id int, a string, b string")
    files = delimited.export_delimited(df.coalesce(1), path, 2)
    assert sorted(r.lines for r in files.collect()) == [2, 2]
    got = {r.id: (r.a, r.b) for r in delimited.load_delimited(spark, path, "id int, a string, b string").collect()}
    assert got[1] == ('say "hi"', None) and got[3] == ("back\\slash", "y") and got[4] == ("NILS", "z")


def test_ddl(spark):
    path = scratch_path(spark, "ddl")
    spark.sql("select 1L as n, array('a') as t, 5 as bnp").write.partitionBy("bnp").parquet(path)
    ddl = lake.create_table_ddl(spark, path, "things", "bnp int")
    assert ddl.startswith("CREATE TABLE things") and "`t` array<string>" in ddl and "PARTITIONED BY (bnp)" in ddl
    assert ddl.count("`bnp`") == 1


def test_periods():
    assert [p[0] for p in due_periods("20240101")] == ["daily", "weekly", "monthly"]
    assert due_periods("20240102") == [("daily", "20240102", "20240102")]


def test_replace_range_needs_borders(spark):
    import pytest

    with pytest.raises(ValueError):
        lake.replace_range(spark.range(1), "/nowhere", 5, 100000)


def test_day_windows(spark):
    df = spark.createDataFrame([(1, 86400 * 3 + 5), (2, 86400 * 5 + 1)], "number long, timestamp int")
    assert [r.date for r in B.day_windows(df).orderBy("date").collect()] == ["1970-01-04", "1970-01-05", "1970-01-06"]


def _size(path):
    return sum(os.path.getsize(os.path.join(at, f)) for at, _, files in os.walk(path.removeprefix("file:")) for f in files
               if f.endswith(".parquet"))


def test_tiers_write_with_the_logarithm_of_the_batches(spark):
    """200 batches: each row is written once a level, the runs stay few, and a range opens those that meet it."""
    table = TieredTable(scratch_path(spark, "tiers"), "id", fan_out=4)
    written, most_runs, most_folders = 0, 0, 0
    for k in range(201):
        table.write(spark.range(10 * k, 10 * k + 10, 1, 1), k)
        made = table.merge(spark, k)
        written += 10 + (made.rows if made else 0)
        if k % 20 == 0:
            most_runs = max(most_runs, len(table.runs(spark)))
            most_folders = max(most_folders, len(os.listdir(table.path.removeprefix("file:"))))
    assert written <= 2010 * 5 and most_runs <= 4 * 4 and most_folders <= 4 * 4 * 2
    assert sorted(r.id for r in table.read(spark).collect()) == list(range(2010))
    assert table.read(spark, before=77).count() <= 770       # a run that holds later batches is not read
    assert sorted(r.id for r in table.read(spark, between=(1995, 2003)).collect()) == list(range(1995, 2004))
    opened = table.read(spark, between=(1995, 2003)).inputFiles()
    assert len({f.split("run=")[1][:25] for f in opened}) == 2
    table.write(spark.range(5000, 5003, 1, 1), 200)           # the last batch runs again
    assert table.read(spark).count() == 2003


def test_tiers_fold_and_survive_a_cut_off_merge(spark):
    fold = lambda df: df.groupBy("k").agg(F.sum("n").alias("n"))
    table = TieredTable(scratch_path(spark, "tiers"), "k", fan_out=2, fold=fold)
    assert table.read_or(spark, spark.createDataFrame([], "k long, n long")).count() == 0
    for k in range(9):
        table.write(spark.createDataFrame([(1, 1), (k, 10)], "k long, n long") if k != 5 else
                    spark.createDataFrame([], "k long, n long"), k)
        if k == 4:      # a merge that left no manifest is no run
            spark.range(1).write.parquet(f"{table.path}/run=000000000000-000000000003")
        table.merge(spark, k)
    assert {r.k: r.n for r in table.totals(spark).collect()} == {1: 18, **{k: 10 for k in (0, 2, 3, 4, 6, 7, 8)}}
    assert [(r.first, r.last) for r in table.runs(spark)] == [(0, 7), (8, 8)]
    assert {r.k: r.n for r in fold(table.read(spark, between=(8, 9))).collect()} == {8: 10}


def test_seen_logs_over_many_batches(spark):
    """Sent twice, only once kept; folders and bytes stay bounded, since bitmaps behind the floor go."""
    path = scratch_path(spark, "seen")
    seen = SeenLogs(path, behind=20, fan_out=2)
    place = "block_number long, transaction_index int, log_index int, v string"
    sizes = []
    for k in range(17):
        rows = [(10 * k + j, t, l, "x") for j in range(10) for t in (0, 1) for l in (0, 63, 64, 200)]
        again = [(max(0, 10 * k - 10), 0, 63, "again"), (10 * k, 0, 0, "twice")]
        late = [(10 * k - 40, 0, 7, "late")] if k > 5 else []
        kept = seen(spark.createDataFrame(rows + again + late + [(None, 0, 0, "no place")], place).coalesce(1), k).persist()
        got = kept.groupBy("v").count().collect()
        assert {r["v"]: r["count"] for r in got if r["v"] not in ("twice", "again")} in (
            {"x": 80, "no place": 1}, {"x": 79, "no place": 1}), (k, got)
        assert sum(r["count"] for r in got) == 81, (k, got)
        seen.record(kept, k)
        kept.unpersist()
        if k in (8, 16):
            sizes.append((len(os.listdir(f"{path}/seen_logs".removeprefix("file:"))), _size(f"{path}/seen_logs")))
    assert sizes[1][0] <= sizes[0][0] + 4 and sizes[1][1] < 1.5 * sizes[0][1]
    assert seen.late.read(spark).agg(F.sum("late")).first()[0] == 11
    # The same batch again finds the same logs new.
    assert seen(spark.createDataFrame([(160, 0, 0, "x"), (120, 0, 5, "late")], place), 16).count() == 1
