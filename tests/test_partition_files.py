"""How many files a table by block partition is written into."""
import datetime as dt
import os

from ledgerloom.plans import adapters as A
from ledgerloom.plans.catalog import files

LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_returnflag string, "
         "l_linestatus string")


def test_a_task_does_not_write_into_every_partition(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(A, "LINES_PER_TASK", 50)
    keys = range(0, 20_000, 100)
    spark.createDataFrame([(k, k % 7, k % 5, n, 2.0, "RAN"[(k + n) % 3], "F") for k in keys for n in (1, 2)], LINES).write.parquet(
        f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(k, 3, dt.datetime(1995, 1, 1)) for k in keys], "o_orderkey long, o_custkey long, "
                          "o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(files, "scratch_path", lambda spark, name: f"{tmp_path}/{name}")
    got = {int(r.bnp): r.rows for r in files.replace_range(spark, str(tmp_path)).collect()}
    want = {}
    for k in keys:
        for n in (1, 2):
            if k * 50 >= 200_000 or "RAN"[(k + n) % 3] == "A":
                want[k * 50 // 100_000] = want.get(k * 50 // 100_000, 0) + 1
    assert got == want
    # Eight tasks of line items, ten partitions: not eighty files, but about one for each partition.
    assert sum(f.endswith(".parquet") for _, _, names in os.walk(f"{tmp_path}/replace") for f in names) <= 20
