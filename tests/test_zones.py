import random

import pytest

from ledgerloom.operators import blocks as B, zones as Z
from ledgerloom.plans.catalog import chain
from ledgerloom.session import scratch_path

SCHEMA = "number long, timestamp int, transaction_count int, gas_used int, base_fee_per_gas string"


def _rows(numbers):
    return [(n, 1_000_000 + n * 7, n % 5, n % 1000, str(n * 3)) for n in numbers]


def _made(spark, numbers):
    blocks = spark.createDataFrame(_rows(numbers), SCHEMA)
    return (*Z.write_zones(blocks, scratch_path(spark, "zones")), blocks)


def _numbers(df):
    return sorted(r["number"] for r in df.select("number").collect())


CHAINS = {
    "dense": list(range(0, 2 * Z.ZONE + 100)),
    "gap at a border": [n for n in range(3 * Z.ZONE) if n != Z.ZONE],
    "last of a zone": [n for n in range(2 * Z.ZONE) if n != Z.ZONE - 1],
    "a whole zone": [n for n in range(3 * Z.ZONE) if not Z.ZONE <= n < 2 * Z.ZONE],
    "full to the end": list(range(2 * Z.ZONE)),
    "late start": list(range(Z.ZONE + 50, Z.ZONE + 500)),
    "random": sorted(random.Random(3).sample(range(4 * Z.ZONE), 70_000)),
    "repeats": [5, 5, 6, 7, 7, 9, 9],
    "empty": [],
}


@pytest.mark.parametrize("name", CHAINS)
def test_against_plain_answers(spark, name):
    numbers = CHAINS[name]
    zones, blocks, plain = _made(spark, numbers)
    there = set(numbers)
    for last in (-1, 4, Z.ZONE - 2, Z.ZONE - 1, Z.ZONE, Z.ZONE + 49):
        end = last
        while end + 1 in there:
            end += 1
        assert Z.gap_free_to(zones, last).first()[0] == end, last
    for lo, hi in ((0, 10), (3, 4 * Z.ZONE + 3), (Z.ZONE - 1, Z.ZONE)):
        assert _numbers(Z.missing_numbers(zones, lo, hi)) == [n for n in range(lo, hi + 1) if n not in there]
    got = {r["date"]: r["transactions"] for r in Z.daily_transactions(zones, blocks).collect()}
    assert got == {r["date"]: r["transactions"] for r in B.daily_tx_history(plain).collect()}


@pytest.mark.parametrize("n", [1, 50, 70_000, 90_000, Z.ZONE])
def test_newest_blocks(spark, n):
    numbers = CHAINS["gap at a border"]
    zones, blocks, _ = _made(spark, numbers)
    top = _rows(numbers[-n:])
    assert tuple(Z.newest(zones, blocks, n).first()) == (
        len(top), sum(r[2] for r in top), min(r[1] for r in top), max(r[1] for r in top))


def test_running_burn(spark):
    numbers = CHAINS["gap at a border"]
    zones, blocks, _ = _made(spark, numbers)
    lo, hi = Z.ZONE + 20, 2 * Z.ZONE + 7
    total, want = 11, {}
    for n, _, _, gas, fee in _rows(numbers):
        total += int(fee) * gas // 2
        want[n] = total
    got = {r["number"]: int(r["accumulate_fees"]) for r in Z.running_burn(zones, blocks, lo, hi, seed=11).collect()}
    assert got == {n: v for n, v in want.items() if lo <= n <= hi}


def test_blocks_are_read_by_range(spark):
    """The scan of a prefix and of the newest blocks is cut to a range, and missing numbers need no block."""
    zones, blocks, _ = _made(spark, CHAINS["dense"])
    assert "/blocks" not in Z.missing_numbers(zones, 0, 10)._jdf.queryExecution().optimizedPlan().toString()
    plan = Z.running_burn(zones, blocks, 10, 20)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(number,0)" in plan and "LessThanOrEqual(number,20)" in plan


def test_the_long_chain_reaches_beyond_int_times(spark, tmp_path):
    """Times of blocks that are not returned need not fit an int."""
    far = 60_000_000        # 40 blocks each, ten seconds apart
    rows = [(k, 3, 100.0) for k in (*range(200), far)]
    spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    got = chain.zone_contiguous_prefix(spark, str(tmp_path))
    assert dict(got.dtypes)["timestamp"] == "int"
    assert _numbers(got) == list(range(6, 200 * 40))
    prefix = chain.contiguous_prefix_long(spark, str(tmp_path))
    assert sorted(prefix.collect()) == sorted(got.collect())
    burnt = chain.cumulative_burn_from_rewards_long(spark, str(tmp_path))
    assert dict(burnt.dtypes)["timestamp"] == "int" and burnt.count() == got.count()


def test_rows_beyond_int_times_are_returned_whole(spark, tmp_path):
    """The newest blocks have times that no int holds; where all fit, int stays."""
    for name, far in (("near", 300), ("far", 60_000_000)):
        rows = [(k, 3, 100.0) for k in (*range(100), far)]
        spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_totalprice double").write.parquet(f"{tmp_path}/{name}/orders.parquet")
        kind = "int" if name == "near" else "bigint"
        times = {far * 40 + i: 800_000_000 + (far * 40 + i) * 10 for i in range(40)}
        burnt = chain.zone_cumulative_burn(spark, f"{tmp_path}/{name}")
        assert dict(burnt.dtypes)["timestamp"] == kind
        assert {r.number: r.timestamp for r in burnt.collect()} == times
        newest = chain.zone_newest_blocks(spark, f"{tmp_path}/{name}")
        assert [dict(newest.dtypes)[c] for c in ("first_ts", "last_ts")] == [kind] * 2
        assert newest.first()["last_ts"] == max(times.values()) and newest.first()["first_ts"] == 800_000_000
