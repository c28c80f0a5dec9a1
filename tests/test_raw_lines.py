import json

import pytest

from ledgerloom.plans import adapters as A
from ledgerloom.streaming.control import settings

LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
         "l_discount double, l_tax double, l_returnflag string, l_linestatus string")
ORDERS = "o_orderkey long, o_custkey long, o_totalprice double, o_orderdate timestamp_ntz"


@pytest.fixture
def folder(spark, tmp_path):
    import datetime as dt
    rows = [(k, k % 13 + n, k % 5, n % 3 + 1, 2.0, 10.0 + n, 0.02 * n, 0.01 * n, "RAN"[(k + n) % 3], "FO"[k % 2])
            for k in range(40) for n in range(5)]
    rows += [(7, None, 3, 1, 1.0, 2.0, None, None, None, None), (7, 1, 1, None, 1.0, 1.0, 0.0, 0.0, "R", "F"), (None, *rows[0][1:])]
    spark.createDataFrame(rows, LINES).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(k, k + 3, 5.0, dt.datetime(1995, 1, 1) + dt.timedelta(days=k)) for k in (*range(30), 3, 99)]
    spark.createDataFrame(orders, ORDERS).write.parquet(f"{tmp_path}/orders.parquet")
    return str(tmp_path)


def test_line_items_are_dealt_out_once(spark, folder):
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = A.raw_block_lines(spark, folder)._jdf.queryExecution().executedPlan().toString()
    # line items, and orders for the customer of a line and for the block
    assert plan.count("Exchange hashpartitioning") == 3
    assert sum("FileScan" in line and "l_orderkey" in line for line in plan.splitlines()) == 1


def test_every_line_item_is_in_the_log(spark, folder):
    found = [json.loads(r.value)["result"] for r in A.raw_block_lines(spark, folder).collect()]
    blocks = {int(b["number"], 16): b for b in found}
    # a block of an order that comes twice comes twice; orders without lines and lines without a number are left out
    assert sorted(blocks) == list(range(30)) and len(found) == 31
    for k, b in blocks.items():
        txs = b["transactions"]
        assert [int(t["transactionIndex"], 16) for t in txs] == [1, 2, 3]
        assert sum(len(t["logs"]) for t in txs) == {3: 10, 7: 6}.get(k, 5)
        assert all(t["transactionHash"] == "0x" + format(k * 8 + int(t["transactionIndex"], 16), "064x") for t in txs)
        for t in txs:
            assert t["from"] == A_ADDRESS.format(k + 3) and {g["transactionHash"] for g in t["logs"]} == {t["transactionHash"]}
    lone = blocks[7]["transactions"][0]["logs"]
    assert sum("address" not in g for g in lone) == 1


A_ADDRESS = "0x{:040x}"


def test_tasks_are_told_by_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(A, "LINES_PER_TASK", 20, raising=False)
    assert A.lines(spark, folder).rdd.getNumPartitions() == 11


@pytest.mark.parametrize("files", [1, 3, 4, 8])
def test_streams_take_rows_as_they_are_laid(spark, files):
    from ledgerloom.plans.catalog import streams

    stream, path = streams._replayed_as_laid(spark, spark.range(0, 100, 1, files), "laid")
    counts = []
    streams.run_to_end(stream.writeStream.foreachBatch(lambda batch, _: counts.append(batch.count())).option(
        "checkpointLocation", f"{path}/checkpoint"), spark)
    assert sum(counts) == 100 and len(counts) == (4 if files == 4 else 3)
    assert len(spark.read.parquet(f"{path}/input").inputFiles()) == max(files, 3)
