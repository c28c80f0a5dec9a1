"""Queries: raw lines, refined tables, events and their decoding."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import constants as K
from ledgerloom.functions import bytecode, dates, hexnum, jsonio, scalars
from ledgerloom.operators import calls, decode, events, joins, refine, transfers
from ledgerloom.plans import adapters as A
from ledgerloom.plans.catalog.base import (
    BLOCKS, COUNTED, MOVES, NFTS, TOKENS, TXS, addr, con, ctype, h64, hx, query, with_,
)
from ledgerloom.sources import logs as L

# Line items repeat (order, line) pairs; the raw log keeps one transaction of each, with the
# events of all of them.
_LOG = """one AS (SELECT b, ti, h, count(*) AS n_logs FROM moves GROUP BY b, ti, h)"""


_BLOCK_ROWS = f"""blocks_whole AS (
SELECT (number // 100000)::VARCHAR AS bnp, base_fee::VARCHAR AS base_fee_per_gas, 1 AS block_score, proposer AS committee,
  '0x' AS extra_data, gas_used, NULL::VARCHAR AS governance_data, '0x' || {hx('number', 64)} AS hash, '0x' AS logs_bloom,
  number, '0x' || {hx('number + 1', 64)} AS parent_hash, proposer, '0xr' AS receipts_root, proposer AS reward,
  1000 AS size, '0xs' AS state_root, ts AS timestamp, 0 AS timestamp_fos, 5 AS total_block_score,
  '0xt' AS transactions_root, '0x' AS vote_data, n_tx::INT AS transaction_count
FROM blocks JOIN (SELECT b, count(*) AS n_tx FROM one GROUP BY b) ON b = number)"""


@query("refine_blocks", with_(MOVES, BLOCKS, _LOG, _BLOCK_ROWS) + "SELECT * FROM blocks_whole")
def refine_blocks(spark, folder):
    raw = L.parse_blocks(A.raw_block_lines(spark, folder))
    return refine.refine_blocks(raw).withColumn("committee", F.array_join("committee", ","))


@query("refine_transactions", with_(MOVES, _LOG) + f"""
SELECT one.h AS transaction_hash, one.b AS block_number, one.ti AS transaction_index,
  any_value({addr('o_custkey')}) AS from_address, 21000::BIGINT AS gas, 21000 AS gas_used, 7::BIGINT AS nonce,
  any_value(ts) AS timestamp,
  count(*) FILTER (ct IN (0, 1, 127))::INT AS token_transfer_count,
  count(*) FILTER (ct IN (2, 3, 4, 5))::INT AS nft_transfer_count
FROM one JOIN moves USING (b, ti, h) GROUP BY ALL""")
def refine_transactions(spark, folder):
    raw = L.parse_blocks(A.raw_block_lines(spark, folder))
    return refine.refine_transactions(raw).select(
        "transaction_hash", "block_number", "transaction_index", "from_address", "gas", "gas_used",
        "nonce", "timestamp", "token_transfer_count", "nft_transfer_count")


_TRANSACTION_ROWS = f"""transactions_whole AS (
SELECT (b // 100000)::VARCHAR AS bnp, NULL::VARCHAR AS access_list, '0x' || {hx('b', 64)} AS block_hash, b AS block_number,
  created AS contract_address, CASE WHEN ls = 'F' THEN '0x2019' ELSE '' END AS chain_id, sender AS from_address,
  21000::BIGINT AS gas, price AS gas_price, 21000 AS gas_used, input, '0x' AS logs_bloom, NULL::VARCHAR AS max_fee_per_gas,
  NULL::VARCHAR AS max_priority_fee_per_gas, 7::BIGINT AS nonce, '0xs' || {hx('l_orderkey * 8 + l_linenumber', 63)} AS sender_tx_hash,
  '0x1 0x2 0x3' AS signatures, ls = 'F' AS status, receiver AS to_address, h AS transaction_hash, ti AS transaction_index,
  CASE WHEN rf = 'A' THEN 'TxTypeAccountUpdate' ELSE 'TxTypeValueTransfer' END AS type,
  CASE WHEN rf = 'A' THEN 32 ELSE 8 END AS type_int, round(l_extendedprice * 100)::BIGINT::VARCHAR AS value,
  NULL::VARCHAR AS code_format, NULL::VARCHAR AS fee_payer, NULL::VARCHAR AS fee_payer_signatures,
  NULL::VARCHAR AS fee_ratio, NULL::BOOLEAN AS human_readable,
  CASE WHEN rf = 'A' AND ls = 'F' THEN '0x04' || {hx('l_suppkey', 8)} END AS key, err AS tx_error,
  n_token AS token_transfer_count, n_nft AS nft_transfer_count, ts AS timestamp, NULL::VARCHAR AS effective_gas_price
FROM (SELECT *, (count(*) FILTER (ct IN (0, 1, 127)) OVER (PARTITION BY h))::INT AS n_token,
    (count(*) FILTER (ct IN (2, 3, 4, 5)) OVER (PARTITION BY h))::INT AS n_nft
  FROM txs QUALIFY row_number() OVER (PARTITION BY h ORDER BY coalesce(created, receiver) DESC, input DESC,
    round(l_extendedprice * 100)::BIGINT::VARCHAR DESC, price DESC, rf = 'A', ls = 'F' DESC, coalesce(err, 0) DESC) = 1))"""


@query("refine_transactions_whole", with_(MOVES, TXS, _TRANSACTION_ROWS) + "SELECT * FROM transactions_whole")
def refine_transactions_whole(spark, folder):
    """Every column of every transaction; of several line items of one hash the adapter takes the greatest."""
    refined = refine.refine_transactions(L.parse_blocks(A.raw_block_lines(spark, folder)))

    def signed(name):
        return F.array_join(F.transform(name, lambda s: F.concat_ws(" ", s["V"], s["R"], s["S"])), ",")

    return refined.withColumns({
        "signatures": signed("signatures"), "fee_payer_signatures": signed("fee_payer_signatures"),
        "access_list": F.array_join("access_list", ",")})


@query("refine_event_logs", with_(MOVES) + f"""
SELECT c AS address, b AS block_number, ti AS transaction_index, li::INT AS log_index, h AS transaction_hash,
  ts AS timestamp, (b // 100000)::VARCHAR AS bnp, '0x' || {hx('b', 64)} AS block_hash, false AS removed,
  CASE WHEN ct IN (0, 1, 127) THEN '{K.TOPIC_TRANSFER},0x' || wf || ',0x' || wt
    WHEN ct IN (2, 4) THEN CASE WHEN rf = 'R' THEN '{K.TOPIC_LEGACY_NFT_TRANSFER}' ELSE '{K.TOPIC_TRANSFER}' END
      || ',0x' || wf || ',0x' || wt || ',0x' || id
    WHEN rf = 'A' THEN '{K.TOPIC_TRANSFER_SINGLE},0x' || wf || ',0x' || wf || ',0x' || wt
    WHEN rf = 'N' THEN '{K.TOPIC_TRANSFER_BATCH},0x' || wf || ',0x' || wf || ',0x' || wt
    WHEN ls = 'F' THEN '{K.TOPIC_TRANSFER_SINGLE}' ELSE '{K.TOPIC_TRANSFER_BATCH}' END AS topics,
  CASE WHEN ct IN (0, 1, 127) THEN '0x' || n1 WHEN ct IN (2, 4) THEN '0x' WHEN rf = 'A' THEN '0x' || id || n1
    WHEN rf = 'N' THEN '0x' || {hx('64', 64)} || {hx('160', 64)} || {hx('2', 64)} || id || id2 || {hx('2', 64)} || n1 || n2
    WHEN ls = 'F' THEN '0x' || wf || wf || wt || id || n1
    ELSE '0x' || wf || wf || wt || {hx('160', 64)} || {hx('256', 64)} || {hx('2', 64)} || id || id2 || {hx('2', 64)} || n1 || n2
    END AS data
FROM (SELECT *, repeat('0', 24) || f[3:] AS wf, repeat('0', 24) || t[3:] AS wt, {h64('tok')}[3:] AS id,
  {h64('tok + 1')}[3:] AS id2, {h64('amt')}[3:] AS n1, {h64('amt + 1')}[3:] AS n2 FROM moves)""")
def refine_event_logs(spark, folder):
    raw = L.parse_blocks(A.raw_block_lines(spark, folder))
    # the status is that of the transaction, of which the raw log keeps any one of several line items
    return refine.refine_event_logs(raw).drop("transaction_status").withColumn("topics", F.array_join("topics", ","))


@query("transfer_counts_per_tx", with_(MOVES) + """
SELECT h AS transaction_hash, count(*) FILTER (ct IN (0, 1, 127))::INT AS token_transfer_count,
  count(*) FILTER (ct IN (2, 3, 4, 5))::INT AS nft_transfer_count
FROM moves GROUP BY h""")
def transfer_counts_per_tx(spark, folder):
    return refine.transfer_counts_per_tx(L.parse_blocks(A.raw_block_lines(spark, folder)))


@query("classify_events", with_(MOVES) + """
SELECT kind AS event_type, kind <> 'unknown' AS is_transfer, count(*) AS n FROM (
  SELECT CASE WHEN ct IN (0, 1, 127) THEN 'token_transfer' WHEN ct IN (2, 4) THEN 'nft_transfer'
    WHEN rf = 'A' OR (rf = 'R' AND ls = 'F') THEN 'transfer_single' ELSE 'transfer_batch' END AS kind
  FROM moves) GROUP BY ALL""")
def classify_events(spark, folder):
    return events.classify_events(A.event_logs(spark, folder)).groupBy("event_type", "is_transfer").agg(
        F.count("*").alias("n"))


def _topic_list(*topics):
    return ", ".join(f"'{t}'" for t in topics)


@query("every_event_kind", f"""
SELECT event_id, CASE WHEN t = '{K.TOPIC_TRANSFER}' AND n = 3 THEN 'token_transfer'
    WHEN t = '{K.TOPIC_TRANSFER}' AND n = 4 OR t = '{K.TOPIC_LEGACY_NFT_TRANSFER}' THEN 'nft_transfer'
    WHEN t = '{K.TOPIC_APPROVAL}' THEN 'approval' WHEN t = '{K.TOPIC_APPROVAL_FOR_ALL}' THEN 'approval_for_all'
    WHEN t = '{K.TOPIC_TRANSFER_SINGLE}' THEN 'transfer_single' WHEN t = '{K.TOPIC_TRANSFER_BATCH}' THEN 'transfer_batch'
    WHEN t = '{K.TOPIC_MINTER_ADDED}' THEN 'minter_added' WHEN t = '{K.TOPIC_ADDR_CHANGED}' THEN 'addr_changed'
    WHEN t = '{K.TOPIC_NEW_RESOLVER}' THEN 'new_resolver' WHEN t = '{K.TOPIC_NAME_CHANGED}' THEN 'name_changed'
    WHEN t = '{K.TOPIC_UPGRADED}' THEN 'upgraded' ELSE 'unknown' END AS event_type,
  token OR nft AS is_transfer, token AS is_token_transfer, nft AS is_nft_transfer,
  t IN ({_topic_list(K.TOPIC_APPROVAL, K.TOPIC_APPROVAL_FOR_ALL)}) AS is_approval,
  t IN ({_topic_list(K.TOPIC_MINT, K.TOPIC_BURN, K.TOPIC_BURN_PAIR)}) AS is_mint_or_burn,
  t = '{K.TOPIC_WITHDRAWAL}' AS is_withdrawal, t = '{K.TOPIC_DEPOSIT}' AS is_deposit, t = '{K.TOPIC_URI}' AS is_uri,
  t = '{K.TOPIC_SET_TOKEN_URI}' AS is_set_token_uri, t = '{K.TOPIC_UPGRADED}' AS is_upgraded,
  t = '{K.TOPIC_MINTER_ADDED}' AS is_minter_added
FROM (SELECT *, t = '{K.TOPIC_TRANSFER}' AND n = 3 AS token, t = '{K.TOPIC_TRANSFER}' AND n = 4
    OR t IN ({_topic_list(K.TOPIC_LEGACY_NFT_TRANSFER, K.TOPIC_TRANSFER_SINGLE, K.TOPIC_TRANSFER_BATCH)}) AS nft
  FROM (SELECT event_id, event_id % 5 AS n, CASE WHEN event_id % 5 = 0 THEN ''
    ELSE [{_topic_list(*A.EVERY_TOPIC)}][event_id % {len(A.EVERY_TOPIC)} + 1] END AS t FROM events))""")
def every_event_kind(spark, folder):
    return events.classify_events(A.every_kind(spark, folder)).drop("topics")


@query("event_predicates", """
SELECT count(*) FILTER (event_type IN ('click', 'view', 'purchase', 'signup')) AS is_approval,
  count(*) FILTER (event_type = 'error' AND event_id % 2 = 1) AS is_deposit,
  count(*) FILTER (event_type = 'error' AND event_id % 2 = 0) AS is_withdrawal,
  0::BIGINT AS is_mint_or_burn, 0::BIGINT AS is_token_transfer, 0::BIGINT AS is_nft_transfer, 0::BIGINT AS is_uri,
  0::BIGINT AS is_set_token_uri, 0::BIGINT AS is_upgraded, 0::BIGINT AS is_minter_added, 0::BIGINT AS is_transfer
FROM events""")
def event_predicates(spark, folder):
    logs = events.classify_events(A.approval_logs(spark, folder))
    return logs.agg(*[F.count(F.when(F.col(n), 1)).alias(n) for n in events.PREDICATES])


@query("token_transfers", with_(MOVES) + f"""
SELECT c AS contract_address, f AS from_address, t AS to_address, {h64('amt')} AS amount, ts AS timestamp,
  b AS block_number, h AS transaction_hash, d AS display_order
FROM moves WHERE ct IN (0, 1, 127)""")
def token_transfers(spark, folder):
    return decode.token_transfers(A.event_logs(spark, folder))


@query("nft_transfers", with_(MOVES, NFTS) + f"""
SELECT c AS contract_address, f AS from_address, t AS to_address, {h64('n')} AS token_count,
  tok::VARCHAR AS token_id, ts AS timestamp, b AS block_number, h AS transaction_hash, d AS display_order,
  item AS item_index FROM nfts""")
def nft_transfers(spark, folder):
    return decode.nft_transfers(A.event_logs(spark, folder))


@query("transfer_parties", with_(MOVES) + """
SELECT c AS contract_address, f AS from_address, t AS to_address, ct IN (0, 1, 127) AS is_token,
  count(*) AS n FROM moves GROUP BY ALL""")
def transfer_parties(spark, folder):
    parties = decode.transfer_parties(A.event_logs(spark, folder))
    return parties.groupBy("contract_address", "from_address", "to_address", "is_token").agg(
        F.count("*").alias("n"))


@query("explode_legs", with_(MOVES) + """
SELECT holder AS holder_address, sign, count(*) AS legs FROM (
  SELECT f AS holder, -1::BIGINT AS sign FROM moves UNION ALL SELECT t, 1 FROM moves) GROUP BY ALL""")
def explode_legs(spark, folder):
    return transfers.explode_legs(A.transfers(spark, folder)).groupBy("holder_address", "sign").agg(
        F.count("*").alias("legs"))


@query("create_transactions", with_(MOVES, TXS) + """
SELECT h AS transaction_hash, created AS contract_address,
  CASE WHEN l_partkey % 2 = 0 THEN 'CREATE' ELSE 'CREATE2' END AS method FROM txs WHERE creates""")
def create_transactions(spark, folder):
    return refine.create_transactions(A.transactions(spark, folder)).select(
        "transaction_hash", "contract_address", "method")


@query("address_flags", with_(MOVES) + f"""
SELECT t IN ('{K.ZERO_ADDRESS}', '{K.DEAD_ADDRESS}', '{K.THIRD_BURN_ADDRESS}') AS burn,
  f = '{K.ZERO_ADDRESS}' AS mint, t IN ('{K.ZERO_ADDRESS}', '{K.DEAD_ADDRESS}') AS zero_or_dead,
  count(*) AS n FROM moves GROUP BY ALL""")
def address_flags(spark, folder):
    return A.transfers(spark, folder).groupBy(
        scalars.is_burn("to_address").alias("burn"), scalars.is_mint("from_address").alias("mint"),
        scalars.is_zero_or_dead("to_address").alias("zero_or_dead")).agg(F.count("*").alias("n"))


@query("account_key_updates", with_(MOVES, TXS) + f"""
SELECT b AS block_number, h AS transaction_hash, sender AS account_address,
  '0x04' || {hx('l_suppkey', 8)} AS account_key FROM txs WHERE rf = 'A' AND ls = 'F'""")
def account_key_updates(spark, folder):
    return refine.account_key_updates(A.transactions(spark, folder))


@query("implementation_updates", f"""
SELECT {con('c_custkey')} AS contract_address, {con('c_custkey + 1')} AS implementation_address,
  c_custkey AS block_number FROM customer""")
def implementation_updates(spark, folder):
    return refine.implementation_updates(A.upgrade_logs(spark, folder)).select(
        "contract_address", "implementation_address", "block_number")


@query("clean_blank_to_null", with_(MOVES, TXS) + f"""
SELECT h AS transaction_hash, CASE WHEN l_tax > 0.04 THEN NULL ELSE {addr('l_suppkey')} END AS fee_payer,
  '{K.DEFAULT_CHAIN_ID}' AS chain_id, '[]' AS access_list FROM txs""")
def clean_blank_to_null(spark, folder):
    return refine.clean_blank_to_null(A.transactions(spark, folder)).select(
        "transaction_hash", "fee_payer", "chain_id", "access_list")


@query("supply_change_contracts", with_(MOVES) + f"""
SELECT DISTINCT c AS contract_address FROM moves
WHERE t IN ('{K.ZERO_ADDRESS}', '{K.DEAD_ADDRESS}', '{K.THIRD_BURN_ADDRESS}') OR f = '{K.ZERO_ADDRESS}'
  OR c IN (f, t)""")
def supply_change_contracts(spark, folder):
    return transfers.supply_change_contracts(A.event_logs(spark, folder))


@query("deposit_withdraw_holders", f"""
SELECT {con('user_id % 14')} AS contract_address, {addr('user_id')} AS holder_address,
  (epoch(ts)::BIGINT // 3600 * 3600)::INT AS timestamp, floor(epoch(ts) / 3600)::BIGINT AS block_number
FROM (SELECT *, floor(epoch(ts)) AS s FROM events)
WHERE event_type = 'error' AND {ctype('(user_id % 14)')} IN (0, 1) AND user_id % 14 IN (SELECT p_partkey FROM part)"""
       .replace("(epoch(ts)::BIGINT // 3600 * 3600)::INT", "(floor(epoch(ts) / 3600) * 3600)::INT"))
def deposit_withdraw_holders(spark, folder):
    return transfers.deposit_withdraw_holders(
        A.approval_logs(spark, folder), A.contracts(spark, folder)).select(
        "contract_address", "holder_address", "timestamp", "block_number")


@query("uri_change_events", f"""
SELECT {con('o_custkey')} AS contract_address, o_orderkey::VARCHAR AS token_id,
  CAST(epoch(o_orderdate) AS INT) AS timestamp, o_orderkey AS block_number
FROM orders WHERE o_orderstatus IN ('O', 'F')""")
def uri_change_events(spark, folder):
    return transfers.uri_change_events(A.uri_logs(spark, folder))


@query("events_with_tx", with_(MOVES) + """
, one AS (SELECT b, h, any_value(ls) AS ls, any_value(ts) AS ts, count(*) AS n FROM moves GROUP BY b, h)
SELECT m.c AS address, m.b AS block_number, m.li::INT AS log_index, m.h AS transaction_hash, one.ts AS timestamp
FROM moves m JOIN one ON m.h = one.h
WHERE m.b BETWEEN (SELECT max(o_orderkey) // 4 FROM orders) AND (SELECT max(o_orderkey) // 2 FROM orders)"""
       .replace("\n, one", ",\none"))
def events_with_tx(spark, folder):
    newest = A.table(spark, folder, "orders").agg(F.max("o_orderkey")).first()[0]
    txs = A.transactions(spark, folder).dropDuplicates(["transaction_hash"])
    return joins.events_with_tx(A.event_logs(spark, folder), txs, newest // 4, newest // 2).select(
        "address", "block_number", "log_index", "transaction_hash", "timestamp")


@query("assemble_blocks", with_(BLOCKS) + """
SELECT number, coalesce(n, 0)::INT AS transactions, coalesce(n, 0)::INT AS logs, coalesce(first, -1)::INT AS first_index
FROM blocks LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_linenumber) AS first FROM lineitem GROUP BY 1)
ON number = l_orderkey""")
def assemble_blocks(spark, folder):
    whole = joins.assemble_blocks(
        A.blocks(spark, folder), A.transactions(spark, folder).select(
            "block_number", "transaction_index", "transaction_hash", "from_address"),
        A.event_logs(spark, folder).select(
            "block_number", "transaction_index", "log_index", "address", "data"))
    return whole.select(
        "number", F.size("transactions").alias("transactions"), F.size("logs").alias("logs"),
        F.coalesce(F.get("transactions", 0)["transaction_index"], F.lit(-1)).alias("first_index"))


_CALLS = f"""turns AS (
  SELECT conv_id, turn::BIGINT AS turn, CASE WHEN turn = 0 THEN '' ELSE bin(turn::BIGINT) END AS path,
    CASE WHEN role = 'user' THEN 'CALL' ELSE 'CREATE' END AS kind, length(text) AS chars FROM conversations),
numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY path) - 1 AS id FROM turns),
calls AS (
  SELECT a.conv_id AS block_number, a.id::INT AS call_id,
    CASE WHEN a.turn > 0 THEN p.id END::INT AS parent_call_id, a.kind AS type,
    '0x' || {hx('a.conv_id', 40)} AS f, '0x' || {hx('a.turn', 40)} AS t,
    a.chars::VARCHAR AS value, (a.chars * 2)::BIGINT AS gas,
    CASE WHEN a.turn = 0 THEN '0ms' END AS time, a.turn
  FROM numbered a LEFT JOIN numbered p ON p.conv_id = a.conv_id AND p.turn = a.turn // 2)"""


def _calls(spark, folder):
    return calls.flatten_calls(L.parse_traces(A.trace_lines(spark, folder)))


@query("flatten_calls", with_(_CALLS) + """
SELECT block_number, 0 AS index, call_id, parent_call_id, type, f AS from_address, t AS to_address, value, gas, time
FROM calls""")
def flatten_calls(spark, folder):
    return _calls(spark, folder).select(
        "block_number", "index", "call_id", "parent_call_id", "type", "from_address", "to_address",
        "value", "gas", "time")


@query("flatten_deep_calls", f"""
WITH chain AS (
  SELECT conv_id // {A.DEEP_GROUP} AS b, conv_id, turn,
    row_number() OVER (PARTITION BY conv_id // {A.DEEP_GROUP} ORDER BY conv_id, turn, again) - 1 AS k,
    count(*) OVER (PARTITION BY conv_id // {A.DEEP_GROUP}) AS n
  FROM conversations, range({A.DEEP_TIMES}) r(again)),
calls AS (SELECT *, k AS id, CASE WHEN k > 0 THEN k - 1 END AS parent FROM chain
  UNION ALL SELECT *, n + k, n - 1 FROM chain)
SELECT b AS block_number, id::INT AS call_id, parent::INT AS parent_call_id, '0x' || {hx('conv_id', 40)} AS from_address,
  turn::BIGINT AS gas, (SELECT count(DISTINCT b) FROM chain) AS lines, 1::BIGINT AS undecoded FROM calls""")
def flatten_deep_calls(spark, folder):
    lines = A.deep_trace_lines(spark, folder)
    broken = lines.agg(F.expr("any_value(concat(value, ']'))").alias("value"))
    every = lines.select("value").unionByName(broken)
    traces = L.parse_traces(every)
    counts = L.decode_counts(every, traces).select((F.col("decoded")).alias("lines"), "undecoded")
    return calls.flatten_calls(traces).select(
        "block_number", "call_id", "parent_call_id", "from_address", "gas").crossJoin(counts)   # one row of counts


@query("index_calls_by_address", with_(_CALLS) + """
SELECT block_number || '_0_' || call_id AS internal_tx_id, a AS account_address, block_number,
  0 AS transaction_index, call_id
FROM (SELECT *, f AS a FROM calls UNION ALL SELECT *, t AS a FROM calls WHERE f <> t)""")
def index_calls_by_address(spark, folder):
    return calls.index_calls_by_address(_calls(spark, folder))


@query("shard_histogram", with_(MOVES) + """
, a AS (SELECT f AS x FROM moves UNION ALL SELECT t FROM moves)
SELECT (('0x' || right(x, s))::BIGINT % 10) || '_' || s AS shard, count(*) AS rows
FROM a, (VALUES (2), (3)) v(s) GROUP BY 1""".replace("\n, a AS", ",\na AS"))
def shard_histogram(spark, folder):
    return calls.shard_histogram(A.transfers(spark, folder))


@query("shard_distinct", with_(MOVES) + f"""
, a AS (SELECT DISTINCT x FROM (SELECT f AS x FROM moves UNION ALL SELECT t FROM moves)),
n AS (SELECT x, ('0x' || right(x, 2))::BIGINT % 10 AS k2, ('0x' || right(x, 3))::BIGINT % 10 AS k3,
  ('0x' || right(x, 15))::BIGINT % 10 AS k0 FROM a)
SELECT shard, count(*) AS addresses FROM (
  SELECT k2 || '_2' AS shard FROM n UNION ALL SELECT k3 || '_3' FROM n UNION ALL SELECT k0 || '_0' FROM n)
GROUP BY 1""".replace("\n, a AS", ",\na AS"))
def shard_distinct(spark, folder):
    return calls.shard_distinct(A.transfers(spark, folder))


@query("number_conversions", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  (l_quantity::HUGEINT * {1 << 80} + l_linenumber)::VARCHAR AS as_decimal,
  {h64('l_quantity::HUGEINT * ' + str(1 << 80) + ' + l_linenumber')} AS back_to_hex,
  l_linenumber::BIGINT AS low_long, l_linenumber::INT AS low_int,
  '0x' || lower(to_hex(l_quantity::HUGEINT * {1 << 80} + l_linenumber)) AS normalized,
  (l_extendedprice * 100)::DECIMAL(18, 0)::VARCHAR || '0000' AS scaled
FROM lineitem""")
def number_conversions(spark, folder):
    amount = F.concat(F.lit("0x"), A._amount_digits())
    price = F.col("l_extendedprice").cast("decimal(18,2)").cast("string")
    src = A.table(spark, folder, "lineitem").withColumns({"h": amount, "p": price})
    return src.withColumn("d", hexnum.hex_to_decimal_text("h")).select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.col("d").alias("as_decimal"),
        hexnum.decimal_text_to_hex("d", max_digits=81).alias("back_to_hex"),
        hexnum.hex_to_long("h").alias("low_long"),
        hexnum.hex_to_int("h").alias("low_int"),
        hexnum.normalize_hex("h", True).alias("normalized"),
        hexnum.hex_or_decimal("p", 6).alias("scaled"))


@query("chain_functions", f"""
SELECT l_orderkey, l_linenumber, l_partkey,
  {hx('l_orderkey', 12)} || {hx('l_linenumber', 5)} || {hx('l_partkey', 5)} AS display_order,
  (l_orderkey // 100000)::VARCHAR AS bnp, (l_orderkey % 7 + 1)::INT AS block_shard,
  (('0x' || right({addr('l_suppkey')}, 15))::BIGINT % 10 + 1)::INT AS address_shard,
  CASE WHEN l_orderkey * 10000 <= 87091199 THEN '25000000000' WHEN l_orderkey * 10000 <= 91324799
    THEN '750000000000' ELSE '250000000000' END AS gas_price
FROM lineitem""")
def chain_functions(spark, folder):
    return A.table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        scalars.display_order("l_orderkey", "l_linenumber", "l_partkey").alias("display_order"),
        scalars.block_partition("l_orderkey").alias("bnp"),
        scalars.shard_of_block("l_orderkey", 7).alias("block_shard"),
        scalars.shard_of_address(A.address(F.col("l_suppkey")), 10).alias("address_shard"),
        scalars.default_gas_price(F.col("l_orderkey") * 10000).alias("gas_price"))


@query("supply_functions", """
WITH raw AS (SELECT *, (p_retailprice * 100)::DECIMAL(18, 0) AS cents, (p_size % 19)::INT AS places FROM part),
padded AS (SELECT *, cents::VARCHAR AS digits,
  lpad(cents::VARCHAR, greatest(length(cents::VARCHAR), places + 1)::INT, '0') AS p FROM raw)
SELECT p_partkey,
  '0x' || lpad(lower(to_hex(cents::HUGEINT * 100000000000000000000::HUGEINT)), 128, '0') AS supply_order,
  CASE WHEN places = 0 THEN digits ELSE left(p, length(p) - places) || '.' || right(p, places) END AS supply,
  left(concat_ws(' ', p_name, p_name, p_name, p_name, p_name, p_name), 50) AS symbol
FROM padded""")
def supply_functions(spark, folder):
    raw = F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string")
    long_name = F.concat_ws(" ", *["p_name"] * 6)
    return A.table(spark, folder, "part").select(
        "p_partkey", scalars.supply_order(raw, F.lit(30)).alias("supply_order"),
        scalars.apply_decimals(raw, F.col("p_size") % 19).alias("supply"),
        scalars.truncate_symbol(long_name).alias("symbol"))


@query("date_functions", """
SELECT event_id, strftime(d, '%Y') AS year, strftime(d, '%m') AS month, strftime(d, '%d') AS day,
  strftime(d, '%Y%m%d') AS ymd, strftime(d, '%Y-%m-%d-%H') AS dh,
  epoch(date_trunc('day', d))::BIGINT AS day_start, epoch(date_trunc('week', d))::BIGINT AS week_start,
  epoch(date_trunc('month', d))::BIGINT AS month_start, dayofweek(d) = 1 AS monday, day(d) = 1 AS first_day,
  epoch(date_trunc('day', d))::BIGINT AS parsed, day(last_day(d))::INT AS month_days
FROM (SELECT event_id, date_trunc('second', ts) AS d FROM events)""")
def date_functions(spark, folder):
    e = A.table(spark, folder, "events").select("event_id", A.epoch(F.col("ts")).alias("s"))
    return e.select(
        "event_id", dates.year("s").alias("year"), dates.month("s").alias("month"), dates.day("s").alias("day"),
        dates.ymd("s").alias("ymd"), dates.date_hour("s").alias("dh"),
        dates.start_of("day", "s").alias("day_start"), dates.start_of("week", "s").alias("week_start"),
        dates.start_of("month", "s").alias("month_start"), dates.is_monday("s").alias("monday"),
        dates.is_first_of_month("s").alias("first_day"),
        dates.parse_utc(dates.ymd("s"), "yyyyMMdd").alias("parsed"),
        dates.last_day_of_month("s").alias("month_days"))


@query("json_functions", """
SELECT event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '","extra":null}' AS encoded,
  '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS compact,
  CAST(props->>'k' AS BIGINT) AS k, '{"k":"' || (props->>'k') || '"}' AS as_map
FROM events""")
def json_functions(spark, folder):
    e = A.table(spark, folder, "events").withColumn("extra", F.lit(None).cast("string"))
    doc = F.struct("event_id", "event_type", "extra")
    return e.select(
        "event_id", jsonio.encode(doc).alias("encoded"), jsonio.encode_compact(doc).alias("compact"),
        F.try_variant_get(jsonio.decode_any("props"), "$.k", "bigint").alias("k"),
        jsonio.encode_map(jsonio.decode_map("props")).alias("as_map"))


@query("reverse_names", f"""
SELECT c_custkey, CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN '0x' || {hx('c_custkey', 40)} END AS address,
  c_mktsegment <> 'HOUSEHOLD' AS has_suffix FROM customer""")
def reverse_names(spark, folder):
    c = A.table(spark, folder, "customer")
    name = F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(
        A.hexed(F.col("c_custkey"), 40), F.lit(K.REVERSE_SUFFIX))).otherwise(
        F.concat(F.lower("c_name"), F.lit(A.NAME_SUFFIX)))
    return c.select(
        "c_custkey", scalars.reverse_name_to_address(name).alias("address"),
        scalars.has_name_suffix(name, A.NAME_SUFFIX).alias("has_suffix"))


@query("function_selectors", f"""
WITH spaced AS (
  SELECT doc_id, regexp_replace(lower(hex(encode(text))), '(..)', '\\1 ', 'g') AS s FROM documents),
found AS (
  SELECT doc_id, unnest(regexp_extract_all(left(s, greatest(length(s) - 3, 0)), '63 (.. .. .. .. )', 1)) AS m FROM spaced)
SELECT DISTINCT {con('doc_id')} AS contract_address, '0x' || replace(m, ' ', '') AS selector FROM found""")
def function_selectors(spark, folder):
    code = A.text_bytecode(spark, folder)
    return code.select("contract_address", F.explode(bytecode.function_selectors("bytecode")).alias("selector"))
