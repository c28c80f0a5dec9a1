"""How the steps that streams and lookups over all event logs share are dealt out."""
import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerloom import constants as K
from ledgerloom.operators import decode, holders, quality
from ledgerloom.plans import adapters as A
from ledgerloom.session import scratch_path
from ledgerloom.streaming import control

LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, "
         "l_linestatus string")
PLACE = ("block_number", "transaction_index", "log_index")


@pytest.fixture
def folder(spark, tmp_path):
    rows = [(k, k % 13 + n, k % 5, n % 3 + 1, 2.0, "RAN"[(k + n) % 3], "FO"[k % 2]) for k in range(40) for n in range(5)]
    rows += rows[::7] + [(7, None, 3, 1, 1.0, "R", "F"), (7, 1, 1, None, 1.0, "R", "F"), (None, *rows[0][1:])]
    spark.createDataFrame(rows, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(k, k + 3, dt.datetime(1995, 1, 1) + dt.timedelta(days=k)) for k in (*range(30), 3, 99)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(
        f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_logs_alone_in_their_place(spark, folder):
    every = A.event_logs(spark, folder).select(*PLACE).collect()
    want = sorted(p for p, n in Counter(tuple(r) for r in every).items() if n == 1 and None not in p)
    assert sorted(tuple(r) for r in A.event_logs(spark, folder, alone=True).select(*PLACE).collect()) == want
    assert 0 < len(want) < len(every)


def test_logs_alone_are_found_where_line_items_lie(spark, folder):
    from ledgerloom.plans.catalog.streams import _unique_logs
    with control.settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = _unique_logs(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2         # line items and orders, both as they are stored


def test_approvals_are_dealt_by_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "LINES_PER_TASK", 10)
    kinds = ("click", "view", "purchase", "signup", "error")
    rows = [(k, dt.datetime(1995, 1, 1, k % 24), k % 9, kinds[k % 5], float(k)) for k in range(45)]
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double").coalesce(
        1).write.parquet(f"{tmp_path}/events.parquet")
    plain, dealt = A.approval_logs(spark, str(tmp_path)), A.approval_logs(spark, str(tmp_path), dealt=True)
    assert dealt.rdd.getNumPartitions() == 5
    assert plain.exceptAll(dealt).isEmpty() and dealt.exceptAll(plain).isEmpty()


def test_micro_batches_read_small_splits(spark):
    path, found = scratch_path(spark, "splits"), []
    spark.range(3).write.parquet(f"{path}/input")

    def look(batch, batch_id):
        found.append(batch.sparkSession.conf.get("spark.sql.files.maxPartitionBytes"))

    def run(k):
        stream = spark.readStream.schema("id long").parquet(f"{path}/input")
        control.run_to_end(stream.writeStream.foreachBatch(look).option("checkpointLocation", f"{path}/checkpoint{k}"), spark)

    run(0)
    with control.settings(spark, {"spark.sql.files.maxPartitionBytes": "1m"}):
        run(1)
    assert found == ["16m", "1m"] and spark.conf.get("spark.sql.files.maxPartitionBytes") == "134217728b"


def test_tasks_of_inventory_moves_are_not_joined_by_bytes(spark):
    one = F.lit("0x" + "1".rjust(64, "0"))
    rows = spark.range(400).select(
        F.concat(F.lit("c"), F.col("id") % 3).alias("contract_address"), F.lit(K.COLLECTION_TYPES[0]).alias("contract_type"), F.lit("a").alias("from_address"),
        F.concat(F.lit("h"), F.col("id")).alias("to_address"), one.alias("token_count"), F.col("id").cast("string").alias("token_id"),
        F.lit(5).alias("timestamp"), F.col("id").alias("block_number"))
    moves = holders.nft_inventory_moves(rows)
    assert moves.count() == 800 and moves.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def _words(*numbers):
    return "".join(format(n, "064x") for n in numbers)


def _batch_logs(spark, bodies):
    topics = [K.TOPIC_TRANSFER_BATCH] + ["0x" + format(n, "064x") for n in (1, 1, 2)]
    return spark.createDataFrame(
        [("0xc", topics, "0x" + body, 1, n, "0xh", 0, 0) for n, body in enumerate(bodies)],
        "address string, topics array<string>, data string, timestamp int, block_number long, transaction_hash string, "
        "transaction_index int, log_index int")


def test_batch_lists_that_do_not_fit(spark):
    bodies = [
        _words(64, 160, 2, 7, 8, 2, 1, 3),              # two pairs
        _words(64, 160, 2, 7, 8, 1, 1),                 # the shorter list tells how many
        _words(64, 160, 2, 7, 8, 3, 1, 3),              # a list that ends behind the data
        _words(64, 1 << 40, 2, 7, 8, 2, 1, 3),          # one that begins behind it
        _words(64, 160, 2, 7, 8, 1 << 200, 1, 3),       # a length beyond any size
        _words(64, 160, 2, 7, 8, 0), "", _words(64)]
    got = decode.nft_transfers(_batch_logs(spark, bodies))
    assert sorted((r.block_number, r.item_index, r.token_id, int(r.token_count, 16)) for r in got.collect()) == [
        (0, 0, "7", 1), (0, 1, "8", 3), (1, 0, "7", 1)]


def test_places_of_batch_lists_are_worked_out_once(spark):
    plan = decode.nft_transfers(_batch_logs(spark, [_words(64, 160, 0, 0)])).select("contract_address")
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("conv(") <= 4             # two places and two lengths


def test_rows_of_blocks_stay_where_they_are(spark):
    known = [0, 1, 7, 8, 32767, 32768, 32769, 65536, 70000, 70000, 5_000_000_000, -1, -40000, None]
    every = [n + d for n in known if n is not None for d in (-8, -1, 0, 1, 8)] * 2 + [None]
    rows = spark.createDataFrame([(n, "x") for n in every], "block long, v string")
    numbers = spark.createDataFrame([(n,) for n in known], "number long")
    for inside in (True, False):
        want = sorted(n for n in every if n is not None and (n in known) == inside)
        with control.settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
            got = quality.of_blocks(rows, numbers, "block", inside)
            plan = got._jdf.queryExecution().executedPlan().toString()
        found = [r.block for r in got.collect()]
        assert sorted(n for n in found if n is not None) == want and found.count(None) == (not inside)
        assert got.columns == rows.columns and "SortMergeJoin" not in plan
    assert quality.of_blocks(rows, numbers.limit(0), "block", inside=False).count() == len(every)


def test_restoring_shuffles_no_raw_blocks(spark):
    from ledgerloom import schemas
    from ledgerloom.operators import refine
    from ledgerloom.plans import jobs
    path = scratch_path(spark, "raw")
    spark.createDataFrame([], f"{schemas.BLOCK_LOG}").write.parquet(path)
    raw = spark.read.parquet(path)
    with control.settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        made = jobs.restore_missing(refine.refine_blocks(raw), refine.refine_transactions(raw), refine.refine_event_logs(raw), raw, 0, 9)
        plan = made["event_logs"]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning(blockNumber" not in plan


def test_a_refined_range_leaves_no_decoded_copy(spark, folder, monkeypatch, tmp_path):
    from ledgerloom.plans import jobs
    from ledgerloom.sources import logs as L
    made = []
    monkeypatch.setattr(jobs, "scratch_path", lambda spark, name: made.append(scratch_path(spark, name)) or made[-1])
    for topic in ("block", "trace"):
        lines = spark.createDataFrame([("0", "no json")], "bnp string, value string")
        L.write_raw_log(lines, f"{tmp_path}/log/topic={topic}")
    jobs.refine_range(spark, f"{tmp_path}/log", f"{tmp_path}/lake", 0, 1)
    assert len(made) == 1 and not os.path.exists(made[0].removeprefix("file:"))
