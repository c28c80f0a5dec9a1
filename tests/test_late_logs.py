"""The whole of every sending of a stream with late logs."""
import datetime as dt
from collections import Counter

import duckdb

from ledgerloom.plans.catalog import ORACLES, QUERIES

LINES = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, "
         "l_tax double, l_returnflag string, l_linestatus string")


def test_every_log_is_sent_twice_and_late_each_time(spark, tmp_path):
    places = [(k, n + 1, k % 3 + n) for k in (*range(7, 22), *range(5001, 5012)) for n in range(2)]
    places += [places[0], places[-1], places[5], (8, 1, None), (5003, None, 2), (5005, 1, None)]
    rows = [(b, part, 3, line, 2.0, 1.0, 0.0, 0.0, "A", "F") for b, line, part in places]
    spark.createDataFrame(rows, LINES).coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(b, 4, dt.datetime(1995, 1, 1)) for b in sorted({p[0] for p in places})]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").coalesce(1).write.parquet(
        f"{tmp_path}/orders.parquet")

    kept, late, newest = set(), Counter(), None
    alone = Counter()
    for sent in ([p for p in places if p[0] % 5], [p for p in places if p[0] % 5 == 0], places):
        floor = None if newest is None else newest - 3000
        for place in sent:
            if floor is not None and place[0] < floor:
                late[place[0]] += 1
            elif None in place:
                alone[place[0]] += 1
            else:
                kept.add(place)
        newest = max(p[0] for p in kept)
    want = {("kept", b): n for b, n in (Counter(p[0] for p in kept) + alone).items()} | {("late", b): n for b, n in late.items()}
    assert late[8] == 3 and late[10] == 4       # on time at first, late when sent again; late both times

    got = {(r.part, r.block_number): r.logs for r in QUERIES["stream_late_logs"](spark, str(tmp_path)).collect()}
    assert got == want
    con = duckdb.connect()
    for name in ("lineitem", "orders"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{tmp_path}/{name}.parquet/*.parquet'")
    cur = con.execute(ORACLES["stream_late_logs"])
    columns = [c[0] for c in cur.description]
    found = [dict(zip(columns, r)) for r in cur.fetchall()]
    assert {(r["part"], r["block_number"]): r["logs"] for r in found} == want
