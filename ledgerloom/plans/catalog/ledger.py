"""Queries: transfers, holders, approvals, accounts, contracts, uris and names."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerloom import constants as K
from ledgerloom.functions import hexnum
from ledgerloom.operators import (
    accounts, approvals, contracts, decode, holders, joins, merges, names, nft_items, search, transfers, uris,
)
from ledgerloom.plans import adapters as A
from ledgerloom.plans.catalog.base import (
    BURNS, ITEMS, MOVES, NFTS, TXS, ZERO, ZERO_OR_DEAD, addr, con, ctype, h64, hx, legs, query, with_,
)
from ledgerloom.plans.catalog.refining import _CALLS, _calls
from ledgerloom.session import scratch_path
from ledgerloom.sources.bucketed import BucketedTable

# ---------------------------------------------------------------------------
# Transfers


@query("new_transfers", with_(MOVES) + """
SELECT d AS display_order, c AS contract_address FROM moves WHERE rf <> 'R'
  AND d NOT IN (SELECT d FROM moves WHERE rf = 'R')""")
def new_transfers(spark, folder):
    t = A.transfers(spark, folder).select("display_order", "contract_address", "flag")
    return transfers.new_transfers(t.filter("flag <> 'R'"), t.filter("flag = 'R'")).select(
        "display_order", "contract_address")


@query("transfer_counts", with_(MOVES) + """
SELECT c AS contract_address, count(*) AS transfers FROM moves GROUP BY 1""")
def transfer_counts(spark, folder):
    return transfers.transfer_counts(A.event_logs(spark, folder))


@query("stored_transfer_counts", with_(MOVES, NFTS) + """
SELECT c AS contract_address, count(*) AS transfers FROM (
  SELECT c FROM moves WHERE ct IN (0, 1, 127) UNION ALL SELECT c FROM nfts) GROUP BY 1""")
def stored_transfer_counts(spark, folder):
    logs = A.event_logs(spark, folder)
    return transfers.stored_transfer_counts(decode.token_transfers(logs), decode.nft_transfers(logs))


@query("tx_counts", """
SELECT count(*) AS transactions, """ + addr("o_custkey") + """ AS address
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
def tx_counts(spark, folder):
    return transfers.tx_counts(A.transactions(spark, folder))


def _typed_moves(spark, folder):
    return A.transfers(spark, folder).withColumn(
        "is_token", F.col("contract_type").isin(K.TYPE_ERC20, K.TYPE_KIP7, K.TYPE_CUSTOM))


@query("account_contracts", with_(MOVES) + """
SELECT a AS account_address, c AS contract_address, CASE WHEN ct IN (0, 1, 127) THEN 0 ELSE 1 END AS transfer_type,
  max(ts) AS timestamp
FROM (SELECT f AS a, c, ct, ts FROM moves UNION ALL SELECT t, c, ct, ts FROM moves) GROUP BY ALL""")
def account_contracts(spark, folder):
    return transfers.account_contracts(_typed_moves(spark, folder))


@query("merge_account_contracts", with_(MOVES) + f"""
, legs AS (SELECT f AS a, c, ct, ts, ls FROM moves UNION ALL SELECT t, c, ct, ts, ls FROM moves),
part AS (SELECT a, c, CASE WHEN any_value(ct) IN (0, 1, 127) THEN 0 ELSE 1 END AS kind,
  max(ts) FILTER (WHERE ls <> 'F') AS o, max(ts) FILTER (WHERE ls = 'F') AS n FROM legs WHERE a <> '{ZERO}' GROUP BY 1, 2)
SELECT a AS account_address, c AS contract_address, coalesce(o, n) AS created_at, greatest(o, n) AS updated_at,
  kind AS transfer_type FROM part""".replace("\n, legs AS", ",\nlegs AS"))
def merge_account_contracts(spark, folder):
    t = _typed_moves(spark, folder)
    first, second = (transfers.account_contracts(t.filter(c), typed=False, exclude=K.ZERO_ONLY)
                     for c in ("line_status <> 'F'", "line_status = 'F'"))   # most incoming rows are older
    stored = first.select(
        "account_address", "contract_address", "transfer_type",
        F.col("timestamp").alias("created_at"), F.col("timestamp").alias("updated_at"))
    return transfers.merge_account_contracts(stored, second)


@query("token_burns", with_(MOVES) + f"""
SELECT c AS contract_address, f AS from_address, t AS to_address, {h64('amt')} AS amount, d AS display_order
FROM moves WHERE ct IN (0, 1, 127) AND t IN ({BURNS})""")
def token_burns(spark, folder):
    return transfers.burns(decode.token_transfers(A.event_logs(spark, folder))).select(
        "contract_address", "from_address", "to_address", "amount", "display_order")


@query("nft_burns", with_(MOVES, NFTS) + f"""
SELECT c AS contract_address, t AS to_address, {h64('n')} AS token_count, tok::VARCHAR AS token_id,
  d AS display_order FROM nfts WHERE t IN ({BURNS})""")
def nft_burns(spark, folder):
    return transfers.burns(decode.nft_transfers(A.event_logs(spark, folder))).select(
        "contract_address", "to_address", "token_count", "token_id", "display_order")


@query("party_union", with_(MOVES) + "SELECT DISTINCT address FROM (SELECT f AS address FROM moves UNION ALL SELECT t FROM moves)")
def party_union(spark, folder):
    return joins.party_union(A.transfers(spark, folder))


# ---------------------------------------------------------------------------
# Holders


@query("token_balance_deltas", with_(MOVES, legs("moves", "amt")) + f"""
SELECT c AS contract_address, holder AS holder_address, {h64('sum(a)')} AS amount, max(ts) AS timestamp,
  max(b) AS block_number FROM legs WHERE holder <> '{ZERO}' GROUP BY 1, 2""")
def token_balance_deltas(spark, folder):
    return holders.token_balance_deltas(A.transfers(spark, folder))


@query("token_balance_deltas_continuous", with_(MOVES, legs("moves", "amt")) + f"""
SELECT c AS contract_address, holder AS holder_address, sum(a)::VARCHAR AS amount
FROM legs WHERE holder NOT IN ({ZERO_OR_DEAD}) GROUP BY 1, 2""")
def token_balance_deltas_continuous(spark, folder):
    deltas = holders.token_balance_deltas(A.transfers(spark, folder), K.ZERO_OR_DEAD)
    return deltas.select("contract_address", "holder_address",
                         hexnum.signed_hex_to_decimal_text("amount").alias("amount"))


# Of the token logs some hold 128 and some 1,000 digits of data: the amount, moved up. A sum is three sums of 128-bit
# numbers, one for each place, and SQL borrows between them where their signs differ.
_PLACES = (0, 64, 936)
_ALL_ONES = f"{(1 << 128) - 1}::UHUGEINT"


def _digits(number: str, width: int) -> str:
    """The lowest digits of a HUGEINT expression, of a negative one those of its complement."""
    return (f"CASE WHEN {number} >= 0 THEN lpad(lower(to_hex({number})), {width}, '0') ELSE repeat('f', {width - 32}) || "
            f"lpad(lower(to_hex({_ALL_ONES} - (-({number} + 1))::UHUGEINT)), 32, '0') END")


_LONG_SUMS = f"""places AS (
  SELECT c, holder, max(ts) AS ts, {", ".join(
      f"coalesce(sum(a) FILTER (WHERE {'b % 97 > 1' if k == 0 else f'b % 97 = {k - 1}'}), 0)::HUGEINT AS s{k}" for k in range(3))}
  FROM legs WHERE holder <> '{ZERO}' AND ct IN (0, 1, 127) GROUP BY 1, 2),
signed AS (SELECT *, CASE WHEN s2 <> 0 THEN sign(s2) WHEN s1 <> 0 THEN sign(s1) ELSE sign(s0) END::INT AS way FROM places),
turned AS (SELECT *, s0 * way AS t0, s1 * way - (s0 * way < 0)::INT AS t1, s2 * way AS t2 FROM signed),
texts AS (SELECT *, ltrim(lower(to_hex((t2 - (t1 < 0)::INT)::HUGEINT)) || {_digits('t1', _PLACES[2] - _PLACES[1])}
  || {_digits('t0', _PLACES[1])}, '0') AS digits FROM turned),
written AS (SELECT c, holder, ts, CASE WHEN way < 0 THEN '-' ELSE '' END || digits AS digits FROM texts)"""


def _long_transfers(spark, folder):
    """Token transfers decoded from logs, a few of which have longer data than any number of the chain."""
    logs, kind = A.event_logs(spark, folder), F.col("block_number") % 97
    token = (F.size("topics") == 3) & (F.get("topics", 0) == K.TOPIC_TRANSFER)
    data = F.when(token & (kind == 0), F.concat("data", F.lit("0" * _PLACES[1]))).when(
        token & (kind == 1), F.concat("data", F.lit("0" * _PLACES[2]))).otherwise(F.col("data"))
    return decode.token_transfers(logs.withColumn("data", data))


@query("long_balance_deltas", with_(MOVES, legs("moves", "amt", "ct"), _LONG_SUMS) + """
SELECT c AS contract_address, holder AS holder_address, '0x' || lpad(digits, greatest(64, length(digits))::INT, '0') AS amount,
  ts AS timestamp FROM written""")
def long_balance_deltas(spark, folder):
    """Balances of holders that got 128 and 1,000 digits in one log, next to all others."""
    return holders.token_balance_deltas(_long_transfers(spark, folder)).drop("block_number")


@query("long_holder_merge", with_(MOVES, legs("moves", "amt", "ct"), _LONG_SUMS) + """
SELECT c AS contract_address, holder AS holder_address, '0x' || lpad(digits, greatest(64, length(digits))::INT, '0') AS amount,
  CASE WHEN digits = '' OR digits[1] = '-' THEN 'delete' ELSE 'update' END AS action FROM written""")
def long_holder_merge(spark, folder):
    """The later half of the transfers merged into the balances of the earlier half."""
    t = _long_transfers(spark, folder)
    early = t.filter("block_number % 2 = 0")
    stored = holders.token_balance_deltas(early)
    # Every holder is stored: with nothing, if the earlier half did not reach it.
    none = transfers.explode_legs(t).filter(F.col("holder_address") != K.ZERO_ADDRESS).select(
        *holders.HOLDER_KEY).distinct().join(stored, list(holders.HOLDER_KEY), "left_anti").select(
        *holders.HOLDER_KEY, F.lit("0x" + "0" * 64).alias("amount"), F.lit(0).alias("timestamp"))
    every = stored.select(*none.columns).unionByName(none)
    deltas = holders.token_balance_deltas(t.filter("block_number % 2 = 1"))
    zero = every.join(deltas, list(holders.HOLDER_KEY), "left_anti").select(
        *holders.HOLDER_KEY, F.lit("0x" + "0" * 64).alias("amount"), F.lit(0).alias("timestamp"), F.lit(0).cast("bigint").alias("block_number"))
    return holders.holder_merge(every, deltas.unionByName(zero.select(*deltas.columns))).drop("timestamp", "block_number")


_NFT_DELTAS = """deltas AS (
  SELECT c, ct, holder, CASE WHEN ct IN (2, 4) THEN '-1' ELSE tok::VARCHAR END AS tid, sum(a) AS a,
    max(ts) AS ts, max(b) AS b FROM legs WHERE holder <> '""" + ZERO + """' GROUP BY ALL)"""


@query("nft_balance_deltas", with_(MOVES, ITEMS, legs("items", "n", "ct", "tok"), _NFT_DELTAS) + f"""
SELECT c AS contract_address, ct AS contract_type, holder AS holder_address, tid AS token_id,
  {h64('a')} AS token_count, ts AS timestamp, b AS block_number FROM deltas""")
def nft_balance_deltas(spark, folder):
    return holders.nft_balance_deltas(A.nft_rows(spark, folder))


@query("nft_inventory_moves", with_(MOVES, ITEMS, legs("items", "n", "ct", "tok")) + f"""
SELECT c AS contract_address, holder AS holder_address, tok::VARCHAR AS token_id, sum(a) < 0 AS is_send,
  max(ts) AS timestamp
FROM (SELECT c, holder, tok, b, sum(a) AS a, max(ts) AS ts FROM legs
      WHERE ct IN (2, 4) AND holder <> '{ZERO}' GROUP BY ALL HAVING sum(a) <> 0)
GROUP BY 1, 2, 3 HAVING sum(a) <> 0""")
def nft_inventory_moves(spark, folder):
    return holders.nft_inventory_moves(A.nft_rows(spark, folder))


# Holdings from finished lines are stored, the other lines are the batch to merge.
_STORED = f"""
old AS (SELECT c, holder, sum(a) AS a, max(ts) AS ts FROM legs WHERE ls = 'F' AND holder <> '{ZERO}'
  GROUP BY 1, 2 HAVING sum(a) > 0),
new AS (SELECT c, holder, sum(a) AS a, max(ts) AS ts FROM legs WHERE ls <> 'F' AND holder <> '{ZERO}' GROUP BY 1, 2),
merged AS (
  SELECT coalesce(old.c, new.c) AS c, coalesce(old.holder, new.holder) AS holder,
    old.a AS o, new.a AS n, coalesce(old.a, 0) + coalesce(new.a, 0) AS total,
    greatest(old.ts, new.ts) AS ts,
    CASE WHEN new.a IS NULL THEN 'keep'
      WHEN old.a IS NULL THEN CASE WHEN new.a > 0 THEN 'insert' ELSE 'ignore' END
      WHEN old.a + new.a > 0 THEN 'update' ELSE 'delete' END AS action
  FROM old FULL JOIN new ON old.c = new.c AND old.holder = new.holder)"""


def _stored_and_new(spark, folder):
    t = A.transfers(spark, folder)
    first = holders.token_balance_deltas(t.filter("line_status = 'F'"))
    stored = first.filter(hexnum.is_positive("amount")).select(
        "contract_address", "holder_address", "amount", "timestamp")
    return stored, holders.token_balance_deltas(t.filter("line_status <> 'F'"))


@query("holder_merge", with_(MOVES, legs("moves", "amt", "ls"), _STORED) + f"""
SELECT c AS contract_address, holder AS holder_address, {h64('total')} AS amount, ts AS timestamp, action
FROM merged""")
def holder_merge(spark, folder):
    return holders.holder_merge(*_stored_and_new(spark, folder)).drop("block_number")


def _bucketed(spark, rows, keys, name):
    return BucketedTable(spark, f"{name}_{uuid.uuid4().hex[:12]}", scratch_path(spark, name), keys, parts=16, buckets=4).create(rows)


@query("bucketed_holder_merge", with_(MOVES, legs("moves", "amt", "ls"), _STORED) + f"""
SELECT c AS contract_address, holder AS holder_address, {h64('total')} AS amount, ts AS timestamp
FROM merged WHERE action IN ('keep', 'insert', 'update')""")
def bucketed_holder_merge(spark, folder):
    """Holders stored by hash of their key; the deltas of each token kind are merged in one after the other."""
    stored, new = _stored_and_new(spark, folder)
    table = _bucketed(spark, stored, holders.HOLDER_KEY, "holders")
    third = F.pmod(F.xxhash64(*holders.HOLDER_KEY), F.lit(3))
    for k in range(3):
        table.merge(new.filter(third == k), lambda held, deltas: holders.apply_merge(holders.holder_merge(held, deltas)))
    return table.read()


@query("bucketed_upsert_newest", with_(MOVES) + """
SELECT c AS contract_address, max(ts) AS updated_at, max(b) AS block_number FROM (
  SELECT * FROM moves QUALIFY rank() OVER (PARTITION BY c ORDER BY ts DESC) = 1) GROUP BY 1""")
def bucketed_upsert_newest(spark, folder):
    """The newest time of every contract and the highest block of that time, merged in two batches, one of them twice."""
    newest = lambda rows: rows.groupBy("contract_address").agg(
        F.max(F.struct("timestamp", "block_number")).alias("v")).select(
        "contract_address", F.col("v.timestamp").alias("updated_at"), F.col("v.block_number").alias("block_number"))
    t = A.transfers(spark, folder)
    table = _bucketed(spark, newest(t.filter("block_number % 3 = 0")), ["contract_address"], "contracts")
    order = F.struct("updated_at", "block_number")
    for k in (1, 2, 1):
        table.merge(newest(t.filter(F.col("block_number") % 3 == k)).withColumn("at", order), lambda held, rows: merges.upsert_newest(
            held.withColumn("at", order), rows, ["contract_address"], "at").drop("at"))
    return table.read()


@query("holder_merge_with_balances", with_(MOVES, legs("moves", "amt", "ls"), _STORED) + f"""
SELECT c AS contract_address, holder AS holder_address, action,
  CASE WHEN action = 'update' AND total <= 0 THEN {h64('7::HUGEINT')} ELSE {h64('total')} END AS amount
FROM (SELECT * REPLACE (CASE WHEN action = 'delete' AND right(holder, 1) IN ('0', '2', '4', '6', '8')
        THEN 'update' ELSE action END AS action) FROM merged)
WHERE action NOT IN ('ignore', 'delete')""")
def holder_merge_with_balances(spark, folder):
    stored, new = _stored_and_new(spark, folder)
    even = F.substring("holder_address", -1, 1).isin("0", "2", "4", "6", "8")
    proof = new.filter(even).select(
        "contract_address", "holder_address", F.lit("0x7").alias("amount"))
    merged = holders.holder_merge(stored, new, proof)
    return merged.filter(~F.col("action").isin("ignore", "delete")).select(
        "contract_address", "holder_address", "action", "amount")


@query("holder_count_changes", with_(MOVES, legs("moves", "amt", "ls"), _STORED) + """
SELECT c AS contract_address, count(*) FILTER (action = 'insert') AS gained,
  count(*) FILTER (action = 'delete') AS lost,
  count(*) FILTER (action = 'insert') - count(*) FILTER (action = 'delete') AS change
FROM merged WHERE action IN ('insert', 'delete') GROUP BY 1""")
def holder_count_changes(spark, folder):
    return holders.holder_count_changes(holders.holder_merge(*_stored_and_new(spark, folder)))


_NFT_LEGS = legs("items", "n", "ct", "tok", "ls")


def _nft_merge_sql(types: str, token: str) -> str:
    key = "c, holder" + (", tok" if token else "")
    on = "old.c = new.c AND old.holder = new.holder" + (" AND old.tok = new.tok" if token else "")
    tok = "coalesce(old.tok, new.tok)::VARCHAR AS token_id, " if token else ""
    source = f"FROM legs WHERE ct IN ({types}) AND holder <> '{ZERO}'"
    return with_(MOVES, ITEMS, _NFT_LEGS, f"""
old AS (SELECT {key}, sum(a) AS a, max(ts) AS ts {source} AND ls = 'F' GROUP BY ALL HAVING sum(a) > 0),
new AS (SELECT {key}, sum(a) AS a, max(ts) AS ts {source} AND ls <> 'F' GROUP BY ALL)""") + f"""
SELECT coalesce(old.c, new.c) AS contract_address, coalesce(old.holder, new.holder) AS holder_address, {tok}
  {h64('(coalesce(old.a, 0) + coalesce(new.a, 0))')} AS token_count, greatest(old.ts, new.ts) AS timestamp
FROM old FULL JOIN new ON {on}
WHERE CASE WHEN old.a IS NULL THEN new.a > 0 ELSE old.a + coalesce(new.a, 0) > 0 END"""


def _nft_stored_and_new(spark, folder, types):
    rows = A.nft_rows(spark, folder).filter(F.col("contract_type").isin(*types))
    first = holders.nft_balance_deltas(rows.filter("line_status = 'F'"))
    return first.filter(hexnum.is_positive("token_count")), holders.nft_balance_deltas(
        rows.filter("line_status <> 'F'"))


@query("nft_holder_merge", _nft_merge_sql("2, 4", ""))
def nft_holder_merge(spark, folder):
    stored, new = _nft_stored_and_new(spark, folder, K.COLLECTION_TYPES)
    return holders.apply_merge(holders.nft_holder_merge(stored, new)).drop("block_number")


@query("multi_token_merge", _nft_merge_sql("3, 5", "tok"))
def multi_token_merge(spark, folder):
    stored, new = _nft_stored_and_new(spark, folder, K.MULTI_TOKEN_TYPES)
    return holders.apply_merge(holders.multi_token_merge(stored, new)).drop("block_number")


_MOVED = f"""
net AS (SELECT c, holder, tok, ls, sum(a) AS a, max(ts) AS ts FROM (
    SELECT c, holder, tok, ls, b, sum(a) AS a, max(ts) AS ts FROM legs
    WHERE ct IN (2, 4) AND holder <> '{ZERO}' GROUP BY ALL HAVING sum(a) <> 0) GROUP BY ALL HAVING sum(a) <> 0),
have AS (SELECT c, holder, tok, ts FROM net WHERE ls = 'F' AND a > 0),
got AS (SELECT c, holder, tok, ts FROM net WHERE ls <> 'F' AND a > 0),
sent AS (SELECT c, holder, tok FROM net WHERE ls <> 'F' AND a < 0),
inventory AS (SELECT c, holder, tok, ts FROM have UNION ALL
  SELECT c, holder, tok, ts FROM got ANTI JOIN have USING (c, holder, tok))"""


def _inventory(spark, folder):
    rows = A.nft_rows(spark, folder)
    have = holders.nft_inventory_moves(rows.filter("line_status = 'F'")).filter("not is_send")
    return have, holders.nft_inventory_moves(rows.filter("line_status <> 'F'"))


@query("inventory_apply", with_(MOVES, ITEMS, _NFT_LEGS, _MOVED) + """
SELECT c AS contract_address, holder AS holder_address, tok::VARCHAR AS token_id, ts AS timestamp
FROM inventory ANTI JOIN sent USING (c, holder, tok)""")
def inventory_apply(spark, folder):
    return holders.inventory_apply(*_inventory(spark, folder))


@query("holder_counts", with_(MOVES, ITEMS, _NFT_LEGS) + f"""
, held AS (SELECT c, ct, holder, CASE WHEN ct IN (2, 4) THEN 0 ELSE tok END AS tok, sum(a) AS a FROM legs
  WHERE holder <> '{ZERO}' GROUP BY ALL HAVING sum(a) > 0)
SELECT c AS contract_address, count(*) AS holder_count FROM held WHERE ct IN (2, 3, 4) GROUP BY 1""".replace("\n, held", ",\nheld"))
def holder_counts(spark, folder):
    held = holders.nft_balance_deltas(A.nft_rows(spark, folder)).filter(hexnum.is_positive("token_count"))
    plain = held.filter(F.col("contract_type").isin(*K.COLLECTION_TYPES))
    return holders.holder_counts(plain, held.filter(F.col("contract_type").isin(*K.MULTI_TOKEN_TYPES)))


@query("token_holder_counts", with_(MOVES, legs("moves", "amt")) + f"""
SELECT c AS contract_address, count(*) AS holder_count FROM (
  SELECT c, holder FROM legs WHERE holder <> '{ZERO}' GROUP BY 1, 2 HAVING sum(a) > 0) GROUP BY 1""")
def token_holder_counts(spark, folder):
    return holders.token_holder_counts(
        holders.token_balance_deltas(A.transfers(spark, folder)).filter(hexnum.is_positive("amount")))


_PAIR = with_(MOVES, legs("moves", "amt", "ls"), f"""
db AS (SELECT c, holder, sum(a) AS a FROM legs WHERE ls = 'F' AND holder <> '{ZERO}' GROUP BY 1, 2),
chain AS (SELECT c, holder, sum(a) AS a FROM legs WHERE holder <> '{ZERO}' GROUP BY 1, 2)""")


def _db_and_chain(spark, folder):
    t = A.transfers(spark, folder)
    return holders.token_balance_deltas(t.filter("line_status = 'F'")), holders.token_balance_deltas(t)


@query("balance_diff", _PAIR + f"""
SELECT c AS contract_address, holder AS holder_address, {h64('db.a')} AS db_amount, {h64('chain.a')} AS chain_amount
FROM db JOIN chain USING (c, holder) WHERE db.a <> chain.a""")
def balance_diff(spark, folder):
    return holders.balance_diff(*_db_and_chain(spark, folder))


@query("fix_nonpositive", _PAIR + f"""
SELECT c AS contract_address, holder AS holder_address, {h64('db.a')} AS db_amount,
  CASE WHEN chain.a <> 0 THEN {h64('chain.a')} END AS amount,
  CASE WHEN chain.a <> 0 THEN 'update' ELSE 'delete' END AS action
FROM db JOIN chain USING (c, holder) WHERE db.a <= 0""")
def fix_nonpositive(spark, folder):
    return holders.fix_nonpositive(*_db_and_chain(spark, folder))


@query("deposit_balance_fix", _PAIR + f"""
SELECT p.c AS contract_address, p.holder AS holder_address, {h64('coalesce(db.a, 0)')} AS db_amount,
  {h64('chain.a')} AS chain_amount,
  CASE WHEN coalesce(db.a, 0) = 0 THEN CAST(epoch(o_orderdate) AS INT) END AS timestamp,
  CASE WHEN coalesce(db.a, 0) = 0 THEN 'insert' ELSE 'update' END AS action
FROM (SELECT c, t AS holder, max(b) AS b FROM moves WHERE t <> '{ZERO}' GROUP BY 1, 2) p
LEFT JOIN db USING (c, holder) JOIN chain USING (c, holder) JOIN orders ON o_orderkey = p.b
WHERE coalesce(db.a, 0) <> chain.a""")
def deposit_balance_fix(spark, folder):
    pairs = A.transfers(spark, folder).filter(F.col("to_address") != ZERO).groupBy(
        "contract_address", F.col("to_address").alias("holder_address")).agg(
        F.max("block_number").alias("block_number"))
    db, chain = _db_and_chain(spark, folder)
    return holders.deposit_balance_fix(pairs, db, chain, A.blocks(spark, folder))


@query("txcount_diff", """
SELECT """ + addr("o_custkey") + """ AS address, count(*) FILTER (l_linestatus = 'F') AS db_count, count(*) AS chain_count
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1
HAVING count(*) FILTER (l_linestatus = 'F') > 0 AND count(*) FILTER (l_linestatus = 'F') <> count(*)""")
def txcount_diff(spark, folder):
    txs = A.transactions(spark, folder)
    return holders.txcount_diff(transfers.tx_counts(txs.filter("status")), transfers.tx_counts(txs))


@query("balance_at", """
WITH history AS (
  SELECT """ + con("l_suppkey") + """ AS c, l_orderkey AS b, max('v' || lpad(l_partkey::VARCHAR, 9, '0')) AS v
  FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1, 2),
asked AS (SELECT """ + con("l_suppkey") + """ AS c, l_orderkey AS b FROM lineitem WHERE l_linestatus <> 'F')
SELECT asked.c AS contract_address, asked.c AS holder_address, asked.b AS block_number, history.v AS amount
FROM asked ASOF LEFT JOIN history ON asked.c = history.c AND asked.b >= history.b""")
def balance_at(spark, folder):
    li = A.table(spark, folder, "lineitem")
    key = A.contract(F.col("l_suppkey"))
    rows = li.select(key.alias("contract_address"), key.alias("holder_address"),
                     F.col("l_orderkey").alias("block_number"), "l_partkey", "l_linestatus")
    history = rows.filter("l_linestatus = 'F'").groupBy(
        "contract_address", "holder_address", "block_number").agg(
        F.max(F.concat(F.lit("v"), F.lpad(F.col("l_partkey").cast("string"), 9, "0"))).alias("amount"))
    return holders.balance_at(rows.filter("l_linestatus <> 'F'"), history)


# ---------------------------------------------------------------------------
# Burn and item totals


@query("burn_totals", with_(MOVES) + f"""
SELECT c AS contract_address, {h64('sum(amt)')} AS burn_amount, count(*) AS total_burn
FROM moves WHERE t IN ({BURNS}) GROUP BY 1""")
def burn_totals(spark, folder):
    return nft_items.burn_totals(transfers.burns(A.transfers(spark, folder)))


@query("add_burn_totals", with_(MOVES) + f"""
, burnt AS (SELECT c, ls, sum(amt) AS a, count(*) AS n FROM moves WHERE t IN ({BURNS}) GROUP BY 1, 2)
SELECT o.c AS contract_address, {h64('(o.a + coalesce(x.a, 0))')} AS burn_amount, o.n + coalesce(x.n, 0) AS total_burn
FROM (SELECT * FROM burnt WHERE ls = 'F') o LEFT JOIN (SELECT * FROM burnt WHERE ls <> 'F') x ON o.c = x.c"""
       .replace("\n, burnt", ",\nburnt"))
def add_burn_totals(spark, folder):
    burnt = transfers.burns(A.transfers(spark, folder))
    stored, new = (nft_items.burn_totals(burnt.filter(c)) for c in ("line_status = 'F'", "line_status <> 'F'"))
    return nft_items.add_burns(stored, new, ["contract_address"])


@query("nft_item_burns", with_(MOVES, ITEMS) + f"""
SELECT c AS contract_address, ct AS contract_type, tok::VARCHAR AS token_id, {h64('sum(n)')} AS burn_amount,
  count(*) AS total_burn FROM items WHERE t IN ({BURNS}) GROUP BY 1, 2, 3""")
def nft_item_burns(spark, folder):
    return nft_items.nft_item_burns(transfers.burns(A.nft_rows(spark, folder)))


@query("nft_item_transfers", with_(MOVES, ITEMS) + """
, seen AS (SELECT c, ct, tok, ls, count(*) AS n FROM items GROUP BY ALL)
SELECT coalesce(o.c, x.c) AS contract_address, coalesce(o.ct, x.ct) AS contract_type,
  coalesce(o.tok, x.tok)::VARCHAR AS token_id,
  CASE WHEN o.n IS NOT NULL THEN o.n + coalesce(x.n, 0) WHEN x.ct IN (2, 4) THEN 0 ELSE x.n END AS total_transfer
FROM (SELECT * FROM seen WHERE ls = 'F') o FULL JOIN (SELECT * FROM seen WHERE ls <> 'F') x
  ON o.c = x.c AND o.tok = x.tok""".replace("\n, seen", ",\nseen"))
def nft_item_transfers(spark, folder):
    rows = A.nft_rows(spark, folder)
    stored, new = (nft_items.nft_item_transfers(rows.filter(c)) for c in ("line_status = 'F'", "line_status <> 'F'"))
    return nft_items.upsert_item_transfers(stored, new)


# ---------------------------------------------------------------------------
# Approvals

_APPROVED = f"""e AS (
  SELECT *, {addr('user_id')} AS owner, {addr('(user_id % 3)')} AS spender, {con('(user_id % 14)')} AS c,
    CASE WHEN user_id % 14 IN (SELECT p_partkey FROM part) THEN {ctype('(user_id % 14)')} ELSE -1 END AS ct,
    floor(value)::BIGINT AS cents, floor(epoch(ts) / 3600)::BIGINT AS b, event_id % 1000 AS ti,
    '0x' || {hx('event_id', 64)} AS h FROM events)"""
_LATEST = "ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY b DESC, ti, event_id) = 1"


@query("latest_token_approvals", with_(_APPROVED) + f"""
SELECT owner AS owner_address, spender AS spender_address, ct AS contract_type, c AS contract_address,
  b AS block_number, h AS transaction_hash, {h64('cents::HUGEINT')} AS amount, (b * 3600)::INT AS timestamp,
  CASE WHEN cents = 0 THEN 'skip' ELSE 'insert' END AS action
FROM e WHERE event_type IN ('click', 'view') QUALIFY {_LATEST.format(key='owner, spender, c')}""")
def latest_token_approvals(spark, folder):
    return approvals.latest_token_approvals(A.approval_logs(spark, folder), A.contracts(spark, folder))


@query("latest_nft_approvals", with_(_APPROVED) + f"""
SELECT owner AS owner_address, ct AS contract_type, c AS contract_address, (cents % 5)::VARCHAR AS token_id,
  b AS block_number, h AS transaction_hash, spender AS spender_address, (b * 3600)::INT AS timestamp,
  CASE WHEN spender IN ({ZERO_OR_DEAD}) THEN 'delete' ELSE 'insert' END AS action
FROM e WHERE event_type = 'purchase' QUALIFY {_LATEST.format(key='owner, c, cents % 5')}""")
def latest_nft_approvals(spark, folder):
    return approvals.latest_nft_approvals(A.approval_logs(spark, folder), A.contracts(spark, folder))


@query("latest_operator_approvals", with_(_APPROVED) + f"""
SELECT owner AS owner_address, ct AS contract_type, c AS contract_address, spender AS operator_address,
  b AS block_number, h AS transaction_hash, event_id % 2 = 1 AS approved, (b * 3600)::INT AS timestamp,
  CASE WHEN event_id % 2 = 1 THEN 'insert' ELSE 'delete' END AS action
FROM e WHERE event_type = 'signup' QUALIFY {_LATEST.format(key='owner, c, spender')}""")
def latest_operator_approvals(spark, folder):
    return approvals.latest_operator_approvals(A.approval_logs(spark, folder), A.contracts(spark, folder))


# ---------------------------------------------------------------------------
# Accounts and contracts

_ACCOUNTS = """made AS (
  SELECT created AS a, min(b * 10 + ti) AS first FROM txs WHERE creates GROUP BY 1),
seen AS (
  SELECT a, sum(sent)::BIGINT AS n FROM (
    SELECT sender AS a, 1 AS sent FROM txs UNION ALL SELECT receiver, 0 FROM txs UNION ALL SELECT created, 0 FROM txs
    UNION ALL SELECT f, 0 FROM moves WHERE ls = 'F' UNION ALL SELECT t, 0 FROM moves WHERE ls = 'F')
  WHERE a IS NOT NULL GROUP BY 1)"""


@query("classify_accounts", with_(MOVES, TXS, _ACCOUNTS) + """
SELECT a AS address, CASE WHEN first IS NULL THEN 0 ELSE 1 END AS account_type, n AS transactions
FROM seen LEFT JOIN made USING (a)""")
def classify_accounts(spark, folder):
    return accounts.classify_accounts(
        A.transactions(spark, folder), A.event_logs(spark, folder)).drop("creator")


@query("merge_accounts", with_(MOVES, TXS, _ACCOUNTS) + f"""
SELECT a AS address, CASE WHEN first IS NULL THEN 0 ELSE 1 END AS account_type, n AS transactions,
  CASE WHEN first IS NOT NULL THEN '0x' || {hx('(first // 10) * 8 + first % 10', 64)} END AS creator
FROM seen LEFT JOIN made USING (a)""")
def merge_accounts(spark, folder):
    txs, logs = A.transactions(spark, folder), A.event_logs(spark, folder)
    parts = [
        accounts.classify_accounts(txs.filter(F.col("status") == ok), logs.filter(F.col("transaction_status") == ok))
        for ok in (True, False)
    ]
    return accounts.merge_accounts(parts[0].unionByName(parts[1])).withColumn("creator", F.col("creator.transaction_hash"))


@query("account_created_at", with_(MOVES, TXS) + """
SELECT a AS address, min(ts) AS created_at
FROM (SELECT sender AS a, ts FROM txs UNION ALL SELECT receiver, ts FROM txs) WHERE a IS NOT NULL GROUP BY 1""")
def account_created_at(spark, folder):
    return accounts.account_created_at(A.transactions(spark, folder))


@query("consensus_nodes", f"""
SELECT DISTINCT {addr('o_custkey')} AS address, 0 AS account_type, 126 AS contract_type FROM orders
WHERE {addr('o_custkey')} NOT IN (SELECT {addr('s_suppkey')} FROM supplier)""")
def consensus_nodes(spark, folder):
    known = A.table(spark, folder, "supplier").select(A.address(F.col("s_suppkey")).alias("address"))
    return accounts.consensus_nodes(A.blocks(spark, folder), known)


@query("with_contract_type", f"""
SELECT coalesce(ct, 127) AS contract_type, count(*) AS n
FROM events LEFT JOIN (SELECT p_partkey, {ctype('p_partkey')} AS ct FROM part) ON p_partkey = user_id * 20 GROUP BY 1""")
def with_contract_type(spark, folder):
    e = A.table(spark, folder, "events").select(A.contract(F.col("user_id") * 20).alias("contract_address"))
    return contracts.with_contract_type(e, A.contracts(spark, folder)).groupBy("contract_type").agg(
        F.count("*").alias("n"))


@query("with_contract_type_of_many", with_(MOVES, NFTS) + f"""
, every AS (SELECT CASE WHEN l_partkey % 2 = 0 THEN {con('7')} ELSE c END AS c, ct, h, tok, d, f, t, n, item FROM nfts)
SELECT c AS contract_address, h AS transaction_hash, tok::VARCHAR AS token_id, f AS from_address,
  coalesce({ctype('p_partkey')}, 127) AS contract_type
FROM every LEFT JOIN part ON {con('p_partkey')} = c""".replace("\n, every", ",\nevery"))
def with_contract_type_of_many(spark, folder):
    """Every other collection transfer is one contract's."""
    moved = decode.nft_transfers(A.event_logs(spark, folder))
    key = F.conv(F.substring("contract_address", 4, 39), 16, 10).cast("bigint")
    skewed = moved.withColumn("contract_address", F.when(key % 2 == 0, A.contract(F.lit(7))).otherwise(F.col("contract_address")))
    typed = contracts.with_contract_type_of_many(skewed, A.contracts(spark, folder))
    return typed.select("contract_address", "transaction_hash", "token_id", "from_address", "contract_type")


@query("contracts_from_calls", with_(_CALLS, MOVES, TXS) + f"""
, one AS (SELECT b, any_value(h) AS h, any_value(ts) AS ts, any_value(sender) AS sender FROM txs GROUP BY b
  HAVING count(DISTINCT ti) > 0)
SELECT c.block_number, c.call_id, c.f AS creator_address, c.t AS contract_address, one.ts AS created_at,
  one.sender AS deployer_address, '0x' || lower(to_hex(c.turn)) AS input,
  CASE WHEN c.t IN (SELECT {addr('c_custkey')} FROM customer WHERE c_custkey < 4) THEN 'update' ELSE 'insert' END AS action
FROM calls c LEFT JOIN one ON one.b = c.block_number WHERE c.type = 'CREATE'""".replace("\n, one AS", ",\none AS"))
def contracts_from_calls(spark, folder):
    txs = A.transactions(spark, folder).withColumn("transaction_index", F.lit(0)).dropDuplicates(["block_number"])
    known = A.table(spark, folder, "customer").filter("c_custkey < 4").select(
        A.address(F.col("c_custkey")).alias("address"))
    return contracts.contracts_from_calls(_calls(spark, folder), txs, known).select(
        "block_number", "call_id", "creator_address", "contract_address", "created_at", "deployer_address",
        "input", "action")


@query("creator_increments", with_(_CALLS) + """
SELECT f AS address, count(*) AS transactions FROM calls WHERE type = 'CREATE' GROUP BY 1""")
def creator_increments(spark, folder):
    txs = A.transactions(spark, folder).withColumn("transaction_index", F.lit(0)).dropDuplicates(["block_number"])
    nobody = txs.select(F.col("from_address").alias("address")).limit(0)
    return contracts.creator_increments(contracts.contracts_from_calls(_calls(spark, folder), txs, nobody))


@query("contract_types", f"""
SELECT {con('p_partkey')} AS contract_address,
  CASE p_partkey % 7 WHEN 4 THEN 2 WHEN 6 THEN 127 ELSE p_partkey % 7 END::INT AS contract_type FROM part""")
def contract_types(spark, folder):
    return contracts.contract_types(A.bytecode(spark, folder))


@query("register_contracts", f"""
SELECT {con('p_partkey')} AS contract_address, left(p_brand, 50) AS symbol, left(p_name, 255) AS name,
  (p_retailprice * 100)::DECIMAL(18, 0)::VARCHAR AS total_supply, (p_size % 19)::INT AS decimals,
  128 + 2 AS width FROM part""")
def register_contracts(spark, folder):
    return contracts.register_contracts(A.contracts(spark, folder)).select(
        "contract_address", "symbol", "name", "total_supply", F.col("decimals").cast("int").alias("decimals"),
        F.length("total_supply_order").alias("width"))


# ---------------------------------------------------------------------------
# Token uris and names

_HELD = with_(MOVES, ITEMS, f"""
held AS (SELECT DISTINCT c, t AS holder, tok, ct FROM items),
uris AS (SELECT *, CASE WHEN tok % 3 = 0 THEN 'ipfs://' || tok::VARCHAR ELSE '-' END AS uri FROM held)""")


def _inventories(spark, folder):
    held = A.nft_rows(spark, folder).select(
        "contract_address", F.col("to_address").alias("holder_address"), "token_id", "contract_type").distinct()
    third = F.col("token_id").cast("decimal(38,0)") % 3 == 0
    return held.withColumn("token_uri", F.when(third, F.concat(F.lit("ipfs://"), "token_id")).otherwise("-"))


@query("token_uri", _HELD + """
, s AS (SELECT DISTINCT c, tok, uri FROM uris WHERE uri <> '-'),
p AS (SELECT DISTINCT c FROM items WHERE ct IN (3, 5))
SELECT k.c AS contract_address, k.tok::VARCHAR AS token_id,
  coalesce(s.uri, CASE WHEN p.c IS NOT NULL THEN 'https://uri/' || k.tok::VARCHAR || '.json' END, '-') AS token_uri
FROM (SELECT DISTINCT c, tok FROM items) k LEFT JOIN s USING (c, tok) LEFT JOIN p ON p.c = k.c"""
       .replace("\n, s AS", ",\ns AS"))
def token_uri(spark, folder):
    rows = A.nft_rows(spark, folder)
    stored = _inventories(spark, folder).filter("token_uri <> '-'").select(
        "contract_address", "token_id", "token_uri").distinct()
    patterns = rows.filter(F.col("contract_type").isin(*K.MULTI_TOKEN_TYPES)).select(
        "contract_address", F.lit("https://uri/{id}.json").alias("pattern")).distinct()
    return uris.token_uri(rows.select("contract_address", "token_id").distinct(), stored, patterns)


@query("tokens_missing_uri", _HELD + """
SELECT DISTINCT u.c AS contract_address, u.tok::VARCHAR AS token_id, u.ct AS contract_type
FROM uris u JOIN (SELECT c, tok, f AS holder FROM items WHERE rf = 'A' UNION SELECT c, tok, t FROM items WHERE rf = 'A')
  USING (c, tok, holder) WHERE uri = '-'""")
def tokens_missing_uri(spark, folder):
    moved = A.nft_rows(spark, folder).filter("flag = 'A'")
    return uris.tokens_missing_uri(moved, _inventories(spark, folder))


@query("backfill_uris", _HELD + """
, missing AS (SELECT DISTINCT u.c, u.tok FROM uris u JOIN (SELECT c, tok, f AS holder FROM items UNION SELECT c, tok, t FROM items)
  USING (c, tok, holder) WHERE uri = '-')
SELECT u.c AS contract_address, u.holder AS holder_address, u.tok::VARCHAR AS token_id, u.ct AS contract_type,
  CASE WHEN m.c IS NOT NULL AND u.ct IN (2, 4) THEN 'https://new/' || u.tok::VARCHAR ELSE uri END AS token_uri
FROM uris u LEFT JOIN missing m USING (c, tok)""".replace("\n, missing AS", ",\nmissing AS"))
def backfill_uris(spark, folder):
    rows, held = A.nft_rows(spark, folder), _inventories(spark, folder)
    answers = rows.select("contract_address", "token_id", "contract_type").distinct().withColumn(
        "token_uri", F.when(F.col("contract_type").isin(*K.COLLECTION_TYPES),
                            F.concat(F.lit("https://new/"), "token_id")).otherwise("-"))
    return uris.backfill_uris(held, uris.tokens_missing_uri(rows, held), answers)


@query("resolve_names", f"""
WITH n AS (SELECT *, lower(c_name) || '{A.NAME_SUFFIX}' AS own FROM customer),
prim AS (SELECT {addr('c_custkey')} AS address, CASE WHEN c_acctbal > 5000 THEN own END AS name FROM n)
SELECT DISTINCT * FROM (
  SELECT '0x' || {hx('c_custkey', 40)} AS address, CASE WHEN c_nationkey % 2 <> 0 THEN own END AS name, 'update' AS action
  FROM n WHERE c_mktsegment = 'HOUSEHOLD'
  UNION ALL
  SELECT r.address, CASE WHEN known THEN prim.name ELSE own END, CASE WHEN known THEN 'update' ELSE 'register' END
  FROM (SELECT {addr('(c_custkey + 5)')} AS address, c_acctbal > 0 AS known, own FROM n
        WHERE c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE')) r LEFT JOIN prim ON prim.address = r.address
  UNION ALL
  SELECT prim.address, prim.name, 'update' FROM n JOIN prim ON prim.address = {addr('c_custkey')}
  WHERE c_mktsegment = 'FURNITURE')""")
def resolve_names(spark, folder):
    snapshot, primary = A.name_snapshot(spark, folder)
    return names.resolve_names(A.name_logs(spark, folder), snapshot, primary, A.REGISTRY, A.NAME_SUFFIX)


# ---------------------------------------------------------------------------
# Search documents


@query("search_docs_tx", with_(MOVES, TXS) + f"""
SELECT h AS id, strftime(make_timestamp(ts::BIGINT * 1000000), '%Y%m') AS month,
  '{{"block_hash":"0x' || {hx('b', 64)} || '","block_number":' || b || ',"transaction_hash":"' || h
  || '","transaction_index":' || ti || ',"status":' || CASE WHEN ls = 'F' THEN 'true' ELSE 'false' END
  || ',"type_int":' || CASE WHEN rf = 'A' THEN 32 ELSE 8 END
  || ',"chain_id":"' || CASE WHEN ls = 'F' THEN '0x2019' ELSE '' END || '","contract_address":'
  || coalesce('"' || created || '"', 'null') || ',"fee_payer":"'
  || CASE WHEN l_tax > 0.04 THEN '' ELSE {addr('l_suppkey')} END || '","from":"' || sender || '","to":'
  || coalesce('"' || receiver || '"', 'null') || ',"sender_tx_hash":"0xs'
  || {hx('l_orderkey * 8 + l_linenumber', 63)} || '","timestamp":' || ts || '}}' AS doc FROM txs""")
def search_docs_tx(spark, folder):
    return search.to_search_docs_tx(A.transactions(spark, folder))


@query("search_docs_account", f"""
SELECT {addr('c_custkey')} AS id, '{{"address":"' || {addr('c_custkey')}
  || '","type":0,"balance":null,"contract_type":127,"contract_creator_address":null,"contract_creator_tx_hash":null,'
  || '"kns_domain":null,"address_label":"' || c_name || '","tags":["' || c_mktsegment || '"],"updated_at":'
  || c_custkey || '}}' AS doc FROM customer""")
def search_docs_account(spark, folder):
    rows = A.table(spark, folder, "customer").select(
        A.address(F.col("c_custkey")).alias("address"), F.lit(0).alias("account_type"),
        F.lit(K.TYPE_CUSTOM).alias("contract_type"), F.col("c_name").alias("address_label"),
        F.array("c_mktsegment").alias("tags"), F.col("c_custkey").alias("updated_at"))
    return search.to_search_docs_account(rows)


@query("search_docs_contract", f"""
SELECT {con('p_partkey')} AS id, '{{"contract_address":"' || {con('p_partkey')} || '","contract_type":'
  || {ctype('p_partkey')} || ',"name":"' || p_name || '","symbol":"' || p_brand || '","verified":'
  || CASE WHEN p_type = 'ECONOMY' THEN 'true' ELSE 'false' END
  || ',"created_at":null,"updated_at":null,"total_supply_order":null,"total_transfer":null}}' AS doc FROM part""")
def search_docs_contract(spark, folder):
    return search.to_search_docs_contract(A.contracts(spark, folder))


@query("ngram_index", f"""
WITH f AS (
  SELECT {con('p_partkey')} AS contract_address, 'name' AS field, lower(p_name) AS s FROM part
  UNION ALL SELECT {con('p_partkey')}, 'symbol', lower(p_brand) FROM part)
SELECT DISTINCT contract_address, field, substring(s, i::BIGINT, n::BIGINT) AS gram
FROM f, range(2, 11) AS l(n), range(1, 60) AS p(i) WHERE i + n - 1 <= length(s)""")
def ngram_index(spark, folder):
    return search.ngram_index(A.contracts(spark, folder), "contract_address", ["name", "symbol"])


def _posted(spark, folder):
    path = scratch_path(spark, "postings")
    return search.write_postings(A.table(spark, folder, "customer"), "c_custkey", ["c_name", "c_mktsegment"], path)


@query("posting_blocks", f"""
WITH f AS (
  SELECT {con('p_partkey')} AS contract_address, 'name' AS field, lower(p_name) AS s FROM part
  UNION ALL SELECT {con('p_partkey')}, 'symbol', lower(p_brand) FROM part)
SELECT DISTINCT contract_address, field, substring(s, i::BIGINT, n::BIGINT) AS gram
FROM f, range(2, 11) AS l(n), range(1, 60) AS p(i) WHERE i + n - 1 <= length(s)""")
def posting_blocks(spark, folder):
    """The written lists, read back as rows."""
    index = search.write_postings(A.contracts(spark, folder), "contract_address", ["name", "symbol"], scratch_path(spark, "postings"))
    return search.postings(index, "contract_address")


_POSTED = """WITH f AS (SELECT c_custkey, 'c_name' AS field, lower(c_name) AS s FROM customer
  UNION ALL SELECT c_custkey, 'c_mktsegment', lower(c_mktsegment) FROM customer),
g AS (SELECT DISTINCT c_custkey, field, substring(s, i::BIGINT, n::BIGINT) AS gram
  FROM f, range(2, 11) AS l(n), range(1, 60) AS p(i) WHERE i + n - 1 <= length(s)),
q AS (SELECT DISTINCT right(lower(s_name), 5) AS s FROM supplier UNION SELECT DISTINCT lower(c_mktsegment) FROM customer),
qg AS (SELECT DISTINCT s AS query, substring(s, i::BIGINT, n::BIGINT) AS gram
  FROM q, range(2, 11) AS l(n), range(1, 60) AS p(i) WHERE i + n - 1 <= length(s)),
m AS (SELECT query, count(*) AS m FROM qg GROUP BY 1)
SELECT query, field, c_custkey, count(*) AS shared FROM g JOIN qg USING (gram) JOIN m USING (query) GROUP BY ALL"""


def _posting_queries(spark, folder):
    return A.table(spark, folder, "supplier").select(F.substring(F.lower("s_name"), -5, 5).alias("query")).unionByName(
        A.table(spark, folder, "customer").select(F.lower("c_mktsegment").alias("query"))).distinct()


@query("posting_lookup", _POSTED + " HAVING count(*) >= 4")
def posting_lookup(spark, folder):
    return search.posting_lookup(_posted(spark, folder), _posting_queries(spark, folder), "c_custkey", least_shared=4)


@query("posting_lookup_all", _POSTED + " HAVING count(*) = any_value(m)")
def posting_lookup_all(spark, folder):
    """Texts that hold every gram of the query."""
    return search.posting_lookup(_posted(spark, folder), _posting_queries(spark, folder), "c_custkey")


@query("ngram_lookup", """
WITH f AS (SELECT c_custkey, lower(c_name) AS s FROM customer),
g AS (SELECT DISTINCT c_custkey, substring(s, i::BIGINT, n::BIGINT) AS gram
  FROM f, range(2, 11) AS l(n), range(1, 60) AS p(i) WHERE i + n - 1 <= length(s)),
q AS (SELECT s_suppkey, right(lower(s_name), 4) AS s FROM supplier),
qg AS (SELECT DISTINCT s AS query, substring(s, i::BIGINT, n::BIGINT) AS gram
  FROM q, range(2, 11) AS l(n), range(1, 60) AS p(i) WHERE i + n - 1 <= length(s))
SELECT query, 'c_name' AS field, c_custkey, count(*) AS shared FROM g JOIN qg USING (gram) GROUP BY ALL""")
def ngram_lookup(spark, folder):
    index = search.ngram_index(A.table(spark, folder, "customer"), "c_custkey", ["c_name"])
    wanted = A.table(spark, folder, "supplier").select(
        F.substring(F.lower("s_name"), -4, 4).alias("query")).distinct()
    return search.ngram_lookup(index, wanted, "c_custkey")


@query("ngram_lookup_close", """
WITH f AS (SELECT c_custkey, lower(c_name) AS s FROM customer),
g AS (SELECT DISTINCT c_custkey, substring(s, i::BIGINT, n::BIGINT) AS gram
  FROM f, range(2, 11) AS l(n), range(1, 60) AS p(i) WHERE i + n - 1 <= length(s)),
q AS (SELECT s_suppkey, right(lower(s_name), 4) AS s FROM supplier),
qg AS (SELECT DISTINCT s AS query, substring(s, i::BIGINT, n::BIGINT) AS gram
  FROM q, range(2, 11) AS l(n), range(1, 60) AS p(i) WHERE i + n - 1 <= length(s))
SELECT query, 'c_name' AS field, c_custkey, count(*) AS shared FROM g JOIN qg USING (gram) GROUP BY ALL HAVING count(*) >= 4""")
def ngram_lookup_close(spark, folder):
    index = search.ngram_index(A.table(spark, folder, "customer"), "c_custkey", ["c_name"])
    wanted = A.table(spark, folder, "supplier").select(
        F.substring(F.lower("s_name"), -4, 4).alias("query")).distinct()
    return search.ngram_lookup(index, wanted, "c_custkey", least_shared=4)


# ---------------------------------------------------------------------------
# Table merges


@query("insert_ignore", """
SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_returnflag <> 'R'
  AND (l_orderkey, l_linenumber) NOT IN (SELECT (l_orderkey, l_linenumber) FROM lineitem WHERE l_returnflag = 'R')
GROUP BY ALL""")
def insert_ignore(spark, folder):
    li = A.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    keys = ["l_orderkey", "l_linenumber"]
    return merges.insert_ignore(li.filter("l_returnflag = 'R'"), li.filter("l_returnflag <> 'R'"), keys).select(*keys)


@query("upsert_newest", """
WITH s AS (SELECT l_suppkey, l_linestatus, max(struct_pack(d := l_shipdate, p := l_partkey)) AS m FROM lineitem GROUP BY 1, 2),
o AS (SELECT * FROM s WHERE l_linestatus = 'F'), n AS (SELECT * FROM s WHERE l_linestatus <> 'F')
SELECT coalesce(o.l_suppkey, n.l_suppkey) AS l_suppkey,
  CAST(epoch(CASE WHEN o.m IS NULL OR n.m.d > o.m.d THEN n.m.d ELSE o.m.d END) AS INT) AS ts,
  CASE WHEN o.m IS NULL OR n.m.d > o.m.d THEN n.m.p ELSE o.m.p END AS p
FROM o FULL JOIN n ON o.l_suppkey = n.l_suppkey""")
def upsert_newest(spark, folder):
    li = A.table(spark, folder, "lineitem").select(
        "l_suppkey", "l_linestatus", A.epoch(F.col("l_shipdate")).alias("ts"), F.col("l_partkey").alias("p"))
    newest = li.groupBy("l_suppkey", "l_linestatus").agg(F.max(F.struct("ts", "p")).alias("m")).select(
        "l_suppkey", "l_linestatus", "m.*")
    old, new = (newest.filter(F.col("l_linestatus") == s if s == "F" else F.col("l_linestatus") != "F")
                .drop("l_linestatus") for s in ("F", "O"))
    return merges.upsert_newest(old, new, ["l_suppkey"], "ts")


@query("increment", f"""
SELECT {con('p_partkey')} AS contract_address, p_size + coalesce(n, 0) AS total_transfer
FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""")
def increment(spark, folder):
    stored = A.table(spark, folder, "part").select(
        A.contract(F.col("p_partkey")).alias("contract_address"),
        F.col("p_size").cast("bigint").alias("total_transfer"))
    deltas = A.table(spark, folder, "lineitem").select(
        A.contract(F.col("l_partkey")).alias("contract_address"), F.lit(1).cast("bigint").alias("total_transfer"))
    return merges.increment(stored, deltas, "contract_address", "total_transfer")


@query("update_by_query", """
SELECT p_partkey, CASE WHEN p_type = 'ECONOMY' AND p_brand = 'Brand#2' THEN 'changed' ELSE p_name END AS p_name,
  CASE WHEN p_type = 'ECONOMY' AND p_brand = 'Brand#2' THEN p_size + 3 ELSE p_size END AS p_size FROM part""")
def update_by_query(spark, folder):
    return merges.update_by_query(
        A.table(spark, folder, "part"), {"p_type": "ECONOMY", "p_brand": "Brand#2"},
        {"p_name": "changed"}, {"p_size": 3}).select("p_partkey", "p_name", "p_size")


@query("find_by_term", "SELECT c_custkey, c_name FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_nationkey = 3")
def find_by_term(spark, folder):
    return merges.find_by_term(A.table(spark, folder, "customer"), c_mktsegment="MACHINERY", c_nationkey=3).select(
        "c_custkey", "c_name")
