"""Queries: block statistics, windows, and checks of the stored data."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom.operators import blocks as B, quality, zones as Z
from ledgerloom.plans import adapters as A
from ledgerloom.plans.catalog.base import BLOCKS, COUNTED, MOVES, TXS, h64, query, with_
from ledgerloom.session import scratch_path
from ledgerloom.sources import logs as L

_DAY = "strftime(make_timestamp(ts::BIGINT * 1000000), '%Y-%m-%d')"
_YMD = "strftime(make_timestamp(ts::BIGINT * 1000000), '%Y%m%d')::INT"


@query("block_date_map", with_(BLOCKS) + f"""
SELECT {_YMD} AS ymd, min(number) AS min_block_number, arg_min(ts, number) AS min_block_timestamp,
  max(number) AS max_block_number, arg_max(ts, number) AS max_block_timestamp FROM blocks GROUP BY 1""")
def block_date_map(spark, folder):
    return B.block_date_map(A.blocks(spark, folder))


@query("bnps_for_dates", with_(BLOCKS) + f"""
, days AS (SELECT {_YMD} AS ymd, min(number) AS lo, max(number) AS hi FROM blocks GROUP BY 1)
SELECT DISTINCT unnest([(lo * 100 // 100000)::VARCHAR, (hi * 100 // 100000)::VARCHAR]) AS bnp FROM days
WHERE ymd BETWEEN 19950101 AND 19961231""".replace("\n, days", ",\ndays"))
def bnps_for_dates(spark, folder):
    days = B.block_date_map(A.blocks(spark, folder))
    wide = days.withColumns({n: F.col(n) * 100 for n in ("min_block_number", "max_block_number")})
    return B.bnps_for_dates(wide, 19950101, 19961231)


@query("avg_block_time", with_(BLOCKS) + """
SELECT printf('%.1f', (max(ts) - min(ts)) / 86400.0) AS avg_block_time
FROM (SELECT ts FROM blocks ORDER BY number DESC LIMIT 1000)""")
def avg_block_time(spark, folder):
    return B.avg_block_time(A.blocks(spark, folder), 1000)


@query("avg_tx_per_block", with_(BLOCKS, COUNTED) + """
SELECT round(sum(tx_count) / 1000.0, 5)::DOUBLE AS avg_tx_per_block
FROM (SELECT tx_count FROM counted ORDER BY number DESC LIMIT 1000)""")
def avg_tx_per_block(spark, folder):
    return B.avg_tx_per_block(A.blocks(spark, folder, counted=True), 1000)


@query("daily_tx_history", with_(BLOCKS, COUNTED) + f"""
SELECT {_DAY} AS date, sum(tx_count)::BIGINT AS transactions FROM counted GROUP BY 1""")
def daily_tx_history(spark, folder):
    return B.daily_tx_history(A.blocks(spark, folder, counted=True))


@query("daily_tx_history_recent", with_(BLOCKS, COUNTED) + f"""
SELECT {_DAY} AS date, sum(tx_count)::BIGINT AS transactions FROM counted GROUP BY 1 ORDER BY 1 DESC LIMIT 30""")
def daily_tx_history_recent(spark, folder):
    return B.daily_tx_history(A.blocks(spark, folder, counted=True), days=30)


_BURN = """burn AS (
  SELECT number, ts, base_fee::HUGEINT * gas_used // 2 AS fee,
    sum(base_fee::HUGEINT * gas_used // 2) OVER (ORDER BY number) + 1000 AS total FROM blocks)"""


@query("cumulative_burn", with_(BLOCKS, _BURN) + f"""
SELECT number, {h64('fee')} AS fees, {h64('total::HUGEINT')} AS accumulate_fees,
  {h64('55::HUGEINT')} AS accumulate_balance, ts AS timestamp FROM burn""")
def cumulative_burn(spark, folder):
    return B.burns_as_hex(B.cumulative_burn(A.blocks(spark, folder), last=-1, seed=1000, balance=55))


@query("cumulative_burn_from_rewards", with_(BLOCKS) + """
, r AS (SELECT l_orderkey AS number, sum(l_partkey)::HUGEINT AS fee FROM lineitem GROUP BY 1),
gap AS (SELECT min(number) AS g FROM blocks WHERE number NOT IN (SELECT number FROM r))
SELECT number, fee::VARCHAR AS fees, sum(fee) OVER (ORDER BY number)::VARCHAR AS accumulate_fees, ts AS timestamp
FROM blocks JOIN r USING (number) WHERE number < (SELECT g FROM gap)""".replace("\n, r AS", ",\nr AS"))
def cumulative_burn_from_rewards(spark, folder):
    rewards = A.table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("number")).agg(
        F.concat(F.lit("0x"), A.hexed(F.sum("l_partkey"), 64)).alias("burnt_fee"))
    burnt = B.cumulative_burn_from_rewards(A.blocks(spark, folder), rewards)
    return burnt.select("number", F.col("fees").cast("string").alias("fees"),
                        F.col("accumulate_fees").cast("string").alias("accumulate_fees"), "timestamp")


@query("daily_burn_history", with_(BLOCKS, _BURN) + f"""
SELECT {_DAY} AS date, (arg_max(total, number) - arg_min(total, number))::VARCHAR AS burnt FROM burn GROUP BY 1""")
def daily_burn_history(spark, folder):
    burns = B.cumulative_burn(A.blocks(spark, folder), seed=1000)
    return B.daily_burn_history(burns).select("date", F.col("burnt").cast("string").alias("burnt"))


@query("contiguous_prefix", """
WITH s AS (SELECT DISTINCT l_orderkey AS number FROM lineitem),
gap AS (SELECT min(o_orderkey) AS g FROM orders WHERE o_orderkey > 5 AND o_orderkey NOT IN (SELECT number FROM s))
SELECT l_orderkey AS number, count(*) AS n FROM lineitem WHERE l_orderkey > 5 AND l_orderkey < (SELECT g FROM gap) GROUP BY 1""")
def contiguous_prefix(spark, folder):
    return B.contiguous_prefix(A.stored_blocks(spark, folder), 5).groupBy("number").agg(F.count("*").alias("n"))


# adapters.long_chain: several block partitions, gaps late.
_CHAIN = f"""chain AS (SELECT o_orderkey * {A.CHAIN_STRETCH} + i AS number, (800000000 + (o_orderkey * {A.CHAIN_STRETCH} + i) * 10)::INT AS ts,
    ((o_custkey + i) % 7)::INT AS tx_count, trunc(o_totalprice)::INT AS gas_used, o_custkey * 1000003 + 25000000000 + i AS base_fee
  FROM orders, range({A.CHAIN_STRETCH}) AS r(i) WHERE (o_orderkey + 1) % {A.CHAIN_GAP} <> 0)"""
_CHAIN_BURN = """burn AS (SELECT number, ts, base_fee::HUGEINT * gas_used // 2 AS fee,
    sum(base_fee::HUGEINT * gas_used // 2) OVER (ORDER BY number) AS total FROM chain)"""
# Everything before the first gap after block 5; the chain without a gap ends at its newest block.
_CHAIN_END = """fin AS (SELECT min(number) AS e FROM chain WHERE number > 5 AND number + 1 NOT IN (SELECT number FROM chain))"""


def _zoned(spark, folder):
    return Z.write_zones(A.long_chain(spark, folder), scratch_path(spark, "zones"))


def _times(rows, zones, *columns):
    """Times of rows that reach the newest block: int, as their SQL gives them, or all long where the newest one is beyond it."""
    newest = zones.agg(F.max("last_ts")).first()[0]
    kind = "int" if newest is None or newest < 1 << 31 else "bigint"
    return rows.withColumns({c: F.col(c).cast(kind) for c in columns})


@query("contiguous_prefix_long", with_(_CHAIN, _CHAIN_END) + "SELECT number, ts AS timestamp FROM chain, fin WHERE number > 5 AND number <= e")
def contiguous_prefix_long(spark, folder):
    """Whole block partitions lie before the first gap."""
    return B.contiguous_prefix(A.long_chain(spark, folder), 5).select("number", F.col("timestamp").cast("int").alias("timestamp"))


@query("cumulative_burn_from_rewards_long", with_(_CHAIN, _CHAIN_END) + """
SELECT number, gas_used::HUGEINT::VARCHAR AS fees, (sum(gas_used::HUGEINT) OVER (ORDER BY number))::VARCHAR AS accumulate_fees,
  ts AS timestamp FROM chain, fin WHERE number > 5 AND number <= e""")
def cumulative_burn_from_rewards_long(spark, folder):
    chain = A.long_chain(spark, folder)
    rewards = chain.select("number", F.concat(F.lit("0x"), A.hexed(F.col("gas_used"), 64)).alias("burnt_fee"))
    burnt = B.cumulative_burn_from_rewards(chain, rewards, last=5)
    return burnt.select("number", F.col("fees").cast("string").alias("fees"),
                        F.col("accumulate_fees").cast("string").alias("accumulate_fees"),
                        F.col("timestamp").cast("int").alias("timestamp"))


@query("zone_contiguous_prefix", with_(_CHAIN, _CHAIN_END) + "SELECT number, ts AS timestamp FROM chain, fin WHERE number > 5 AND number <= e")
def zone_contiguous_prefix(spark, folder):
    zones, blocks = _zoned(spark, folder)
    return Z.gap_free(zones, blocks, 5).select("number", F.col("timestamp").cast("int").alias("timestamp"))


@query("zone_missing_blocks", with_(_CHAIN) + """
SELECT number FROM range((SELECT max(number) + 4 FROM chain)) AS r(number) WHERE number NOT IN (SELECT number FROM chain)""")
def zone_missing_blocks(spark, folder):
    zones, _ = _zoned(spark, folder)
    newest = zones.agg(F.max("last")).first()[0]
    return Z.missing_numbers(zones, 0, newest + 3)


@query("zone_daily_tx_history", with_(_CHAIN) + f"SELECT {_DAY} AS date, sum(tx_count)::BIGINT AS transactions FROM chain GROUP BY 1")
def zone_daily_tx_history(spark, folder):
    return Z.daily_transactions(*_zoned(spark, folder))


@query("zone_newest_blocks", with_(_CHAIN) + """
SELECT 40000::BIGINT AS blocks, sum(tx_count)::BIGINT AS transactions, min(ts) AS first_ts, max(ts) AS last_ts
FROM (SELECT * FROM chain ORDER BY number DESC LIMIT 40000)""")
def zone_newest_blocks(spark, folder):
    zones, blocks = _zoned(spark, folder)
    return _times(Z.newest(zones, blocks, 40000), zones, "first_ts", "last_ts")


@query("zone_cumulative_burn", with_(_CHAIN, _CHAIN_BURN) + """
SELECT number, ts AS timestamp, fee::VARCHAR AS fees, (total + 1000)::VARCHAR AS accumulate_fees
FROM burn WHERE number > (SELECT max(number) // 2 FROM chain)""")
def zone_cumulative_burn(spark, folder):
    """The newer half of the chain, with totals over all of it."""
    zones, blocks = _zoned(spark, folder)
    newest = zones.agg(F.max("last")).first()[0]
    burnt = Z.running_burn(zones, blocks, newest // 2 + 1, newest, seed=1000)
    return _times(burnt.withColumns({c: F.col(c).cast("string") for c in ("fees", "accumulate_fees")}), zones, "timestamp")


@query("day_windows", """
SELECT strftime(d, '%Y-%m-%d') AS date, epoch(d)::BIGINT AS from_ts, epoch(d)::BIGINT + 86400 AS to_ts
FROM (SELECT unnest(range(min(o_orderdate), max(o_orderdate) + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS d FROM orders)""")
def day_windows(spark, folder):
    return B.day_windows(A.blocks(spark, folder))


@query("recent_blocks", with_(BLOCKS) + "SELECT number, ts AS timestamp FROM blocks ORDER BY number DESC LIMIT 50")
def recent_blocks(spark, folder):
    return B.recent(A.blocks(spark, folder), 50).select("number", "timestamp")


@query("page_after", "SELECT c_custkey, c_name FROM customer WHERE c_custkey > 70 ORDER BY c_custkey LIMIT 40")
def page_after(spark, folder):
    return B.page_after(A.table(spark, folder, "customer"), 70, 40, by="c_custkey").select("c_custkey", "c_name")


@query("id_window", "SELECT event_id, user_id FROM events WHERE event_id > 100 AND event_id <= 600")
def id_window(spark, folder):
    return B.id_window(A.table(spark, folder, "events"), 100, 500, by="event_id").select("event_id", "user_id")


@query("block_extremes", with_(BLOCKS) + """
SELECT max(number) AS max_number, arg_max(ts, number)::BIGINT * 1000 AS latest_ms,
  (SELECT min(l_orderkey) FROM lineitem) AS min_transfer_block,
  (SELECT max(ts) FROM (SELECT ts FROM blocks ORDER BY number DESC LIMIT 5)) AS newest_ts FROM blocks""")
def block_extremes(spark, folder):
    b = A.blocks(spark, folder)
    moved = A.table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("block_number"))
    return (
        B.max_block(b).select(F.col("number").alias("max_number"))
        .crossJoin(B.latest_block(b).select(F.col("timestamp_ms").alias("latest_ms")))
        .crossJoin(B.min_transfer_block(moved).select(F.col("block_number").alias("min_transfer_block")))
        .crossJoin(B.last_block_timestamp(b).select(F.col("timestamp").alias("newest_ts"))))


@query("missing_blocks", """
SELECT o_orderkey AS number FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)
UNION ALL SELECT unnest(range((SELECT max(o_orderkey) + 1 FROM orders), (SELECT max(o_orderkey) + 4 FROM orders)))""")
def missing_blocks(spark, folder):
    newest = A.table(spark, folder, "orders").agg(F.max("o_orderkey")).first()[0]
    return quality.missing_blocks(A.stored_blocks(spark, folder), 0, newest + 3)


@query("recent_missing_blocks", """
WITH s AS (SELECT DISTINCT l_orderkey AS number FROM lineitem ORDER BY 1 DESC LIMIT 2000),
k AS (SELECT number FROM s ORDER BY number LIMIT 1995)
SELECT o_orderkey AS number FROM orders WHERE o_orderkey BETWEEN (SELECT min(number) FROM k) AND (SELECT max(number) FROM k)
  AND o_orderkey NOT IN (SELECT number FROM k)""")
def recent_missing_blocks(spark, folder):
    return quality.recent_missing_blocks(A.stored_blocks(spark, folder).distinct(), 2000)


@query("mismatched_blocks", with_(BLOCKS, COUNTED) + """
SELECT number, tx_count AS transaction_count, coalesce(n, 0) AS stored FROM counted
LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1) ON number = l_orderkey
WHERE coalesce(n, 0) <> tx_count""")
def mismatched_blocks(spark, folder):
    stored = A.table(spark, folder, "lineitem").filter("l_returnflag <> 'R'").select(
        F.col("l_orderkey").alias("block_number"))
    return quality.mismatched_blocks(A.blocks(spark, folder, counted=True), stored)


@query("set_difference", """
SELECT c_custkey AS number FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""")
def set_difference(spark, folder):
    wanted = A.table(spark, folder, "customer").select(F.col("c_custkey").alias("number"))
    present = A.table(spark, folder, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("number"))
    return quality.set_difference(wanted, present)


@query("gas_price_exceptions", with_(MOVES, TXS) + """
SELECT h AS transaction_hash, price AS gas_price FROM txs WHERE price <> '25000000000'""")
def gas_price_exceptions(spark, folder):
    return quality.gas_price_exceptions(A.transactions(spark, folder)).select("transaction_hash", "gas_price")


@query("job_counters", with_(MOVES, TXS) + "SELECT count(*) AS indexed FROM txs WHERE price <> '25000000000'")
def job_counters(spark, folder):
    found, counter = quality.counted(quality.gas_price_exceptions(A.transactions(spark, folder)), "indexed")
    found.write.format("noop").mode("overwrite").save()
    return spark.range(1).select(F.lit(counter.get["rows"]).alias("indexed"))


@query("pipeline_lag", with_(BLOCKS) + """
, newest AS (SELECT max(ts) AS block_ts, max(number) AS block_number FROM (SELECT * FROM blocks ORDER BY number DESC LIMIT 10))
SELECT block_ts, block_number, burn_number, max_id, block_ts < 2000000000 - 10 AS blocks_late,
  block_number - burn_number > 60 AS burns_late, 1500 < max_id AS transfers_late
FROM newest, (SELECT max(o_orderkey) AS burn_number FROM orders WHERE o_orderstatus = 'F'),
  (SELECT max(event_id) AS max_id FROM events)""".replace("\n, newest", ",\nnewest"))
def pipeline_lag(spark, folder):
    b = A.blocks(spark, folder)
    burns = A.table(spark, folder, "orders").filter("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("number"))
    moved = A.table(spark, folder, "events").select(
        F.col("event_id").alias("id"), A.epoch(F.col("ts")).alias("timestamp"))
    return quality.pipeline_lag(b, burns, moved, watermark=1500, now=2000000000).drop("watermark_ts")


@query("dedup_log", """
WITH v AS (SELECT DISTINCT l_orderkey AS b, l_returnflag AS rf FROM lineitem),
n AS (SELECT b, count(*) AS n FROM v GROUP BY 1),
line AS (SELECT l_orderkey AS b, l_returnflag AS rf,
  '{"blockNumber":' || l_orderkey || ',"result":{"flag":"' || l_returnflag || '","time":"' || l_linenumber || 'ms"}}' AS s
  FROM lineitem)
SELECT '0' AS bnp, s AS value FROM (SELECT b, min(s) AS s FROM line JOIN n USING (b) WHERE n <= 2 GROUP BY b)
UNION ALL SELECT 'dup-0', '{"blockNumber":' || b || ',"result":{"flag":"' || rf || '",}}' FROM v JOIN n USING (b) WHERE n > 2
UNION ALL SELECT '0', 'broken ' || o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'""")
def dedup_log(spark, folder):
    return quality.dedup_log(A.log_copies(spark, folder), "0")


@query("word_count", r"""
WITH lines AS (SELECT unnest(regexp_split_to_array(text, '\r\n|\n|\r')) AS line FROM documents)
SELECT word, count(*) AS occurrences FROM (
  SELECT unnest(CASE WHEN rtrim(line, ' ') = '' AND line <> '' THEN [] ELSE string_split(rtrim(line, ' '), ' ') END) AS word
  FROM lines) GROUP BY 1""")
def word_count(spark, folder):
    return quality.word_count(A.documents(spark, folder))


@query("last_offset_before", """
SELECT user_id % 4 AS partition, arg_max(floor(epoch(ts) / 3600)::BIGINT, event_id) AS block_number, max(event_id) AS "offset"
FROM events WHERE floor(epoch(ts) / 3600) < 473800 GROUP BY 1""")
def last_offset_before(spark, folder):
    records = A.approval_logs(spark, folder).select("block_number", F.col("log_index").cast("bigint").alias("offset"))
    users = A.table(spark, folder, "events").select(
        F.col("event_id").alias("offset"), (F.col("user_id") % 4).alias("partition"))
    return L.last_offset_before(records.join(users, "offset"), 473800)


@query("block_rewards", """
SELECT o_orderkey AS number, '0x' || lpad(lower(to_hex(o_custkey)), 64, '0') AS minted,
  '{"' || o_orderstatus || '":"0x' || lpad(lower(to_hex(o_custkey)), 64, '0') || '"}' AS rewards FROM orders""")
def block_rewards(spark, folder):
    o = A.table(spark, folder, "orders")
    amount = F.concat(F.lit("0x"), F.lower(F.hex("o_custkey")))
    rows = o.select(F.col("o_orderkey").alias("number"), amount.alias("minted"),
                    F.create_map("o_orderstatus", amount).alias("rewards"))
    return B.block_rewards(rows)
