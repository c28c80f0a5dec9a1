"""Queries: what the writers write, read back from the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import constants as K
from ledgerloom.operators import calls, refine
from ledgerloom.plans import adapters as A
from ledgerloom.plans.catalog.base import BLOCKS, MOVES, NFTS, TXS, con, ctype, query, with_
from ledgerloom.plans import jobs
from ledgerloom.plans.catalog.ledger import _ACCOUNTS
from ledgerloom.plans.catalog.refining import _BLOCK_ROWS, _CALLS, _LOG, _TRANSACTION_ROWS, _calls
from ledgerloom.session import scratch_path
from ledgerloom.sources import delimited, jdbc, lake, logs as L, manifested

_TS_PART = "strftime(make_timestamp(ts::BIGINT * 1000000), '{}')"

def _raw_log(spark, folder, name):
    """The block log written as gzip text, with a broken line per block partition."""
    path = scratch_path(spark, name)
    lines = A.raw_block_lines(spark, folder).select(
        F.call_function("div", F.col("block_number"), F.lit(K.BLOCKS_PER_PARTITION)).cast("string").alias("bnp"), "value")
    broken = lines.groupBy("bnp").agg(F.lit('{"blockNumber":1,"result":{"hash":').alias("value"))
    L.write_raw_log(lines.unionByName(broken), path)
    return path

@query("read_block_log", with_(MOVES, BLOCKS, _LOG) + """
SELECT number, ts AS timestamp, (SELECT 1) AS parts, n_tx::INT AS transaction_count
FROM blocks JOIN (SELECT b, count(*) AS n_tx FROM one GROUP BY b) ON b = number""".replace("(SELECT 1) AS parts, ", ""))
def read_block_log(spark, folder):
    raw = L.read_block_log(spark, _raw_log(spark, folder, "block-log"), (0, 1 << 40))
    return refine.refine_blocks(raw).select("number", "timestamp", "transaction_count")

@query("read_trace_log", with_(_CALLS) + "SELECT block_number, count(*) AS calls FROM calls GROUP BY 1")
def read_trace_log(spark, folder):
    path = scratch_path(spark, "trace-log")
    lines = A.trace_lines(spark, folder).select(F.lit("0").alias("bnp"), "value")
    bad = lines.limit(3).select("bnp", F.concat(F.lit("?"), "value").alias("value"))
    L.write_raw_log(lines.unionByName(bad), path)
    return calls.flatten_calls(L.read_trace_log(spark, path, 0)).groupBy("block_number").agg(
        F.count("*").alias("calls"))

@query("write_raw_log_hourly", with_(BLOCKS) + f"""
SELECT (number // 100000)::VARCHAR AS bnp, {_TS_PART.format('%Y-%m-%d-%H')} AS dh, count(*) AS lines
FROM blocks WHERE number IN (SELECT l_orderkey FROM lineitem) GROUP BY ALL""")
def write_raw_log_hourly(spark, folder):
    path = scratch_path(spark, "hourly")
    L.write_raw_log_hourly(A.raw_block_lines(spark, folder).select("value"), path)
    return spark.read.schema("value string, bnp string, dh string").text(path).groupBy("bnp", "dh").agg(
        F.count("*").alias("lines"))

@query("write_refined_by_bnp", with_(MOVES, TXS) + """
SELECT (b // 100000)::VARCHAR AS bnp, 'blocks' AS label, count(DISTINCT b) AS rows, sum(DISTINCT b)::BIGINT AS total
FROM moves GROUP BY 1
UNION ALL SELECT (b // 100000)::VARCHAR, 'transactions', count(*), sum(b)::BIGINT FROM moves GROUP BY 1
UNION ALL SELECT (b // 100000)::VARCHAR, 'event_logs', count(*), sum(b)::BIGINT FROM moves GROUP BY 1""")
def write_refined_by_bnp(spark, folder):
    path = scratch_path(spark, "by-bnp")
    bnp = lambda c: F.call_function("div", F.col(c), F.lit(K.BLOCKS_PER_PARTITION)).cast("string")
    have = A.stored_blocks(spark, folder).distinct()
    blocks = A.blocks(spark, folder).join(have, "number", "left_semi").withColumn("bnp", bnp("number"))
    txs = A.transactions(spark, folder).withColumns(
        {"bnp": bnp("block_number"), "token_transfer_count": F.lit(0), "nft_transfer_count": F.lit(0)})
    logs = A.event_logs(spark, folder).withColumn("bnp", bnp("block_number"))
    lake.write_refined_by_bnp(blocks, txs, logs, path)
    out = None
    for label, name, key in ((lake.BLOCKS, "blocks", "number"), (lake.TRANSACTIONS, "transactions", "block_number"),
                             (lake.LOGS, "event_logs", "block_number")):
        part = spark.read.parquet(f"{path}/{label}").groupBy(
            F.col("bnp").cast("string").alias("bnp"), F.lit(name).alias("label")).agg(
            F.count("*").alias("rows"), F.sum(key).alias("total"))
        out = part if out is None else out.unionByName(part)
    return out

@query("write_refined_by_date", with_(BLOCKS, MOVES, TXS) + f"""
SELECT label, {_TS_PART.format('%Y')}::INT AS year, {_TS_PART.format('%m')}::INT AS month, {_TS_PART.format('%d')}::INT AS day,
  count(*) AS rows FROM (
  SELECT 'blocks' AS label, ts FROM blocks UNION ALL SELECT 'transactions', ts FROM txs
  UNION ALL SELECT 'event_logs', ts FROM moves) GROUP BY ALL""")
def write_refined_by_date(spark, folder):
    path = scratch_path(spark, "by-date")
    lake.write_refined_by_date(
        A.blocks(spark, folder), A.transactions(spark, folder), A.event_logs(spark, folder), path)
    out = None
    for label, name in ((lake.BLOCKS, "blocks"), (lake.TRANSACTIONS, "transactions"), (lake.LOGS, "event_logs")):
        part = spark.read.parquet(f"{path}/{label}_dt").groupBy(
            F.lit(name).alias("label"), "year", "month", "day").agg(F.count("*").alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out

@query("write_transfers_by_date", with_(MOVES, NFTS) + f"""
SELECT kind, {_TS_PART.format('%Y')}::INT AS year, {_TS_PART.format('%m')}::INT AS month, {_TS_PART.format('%d')}::INT AS day,
  count(*) AS rows, sum(amount)::VARCHAR AS amount FROM (
  SELECT 'token' AS kind, ts, amt AS amount FROM moves WHERE ct IN (0, 1, 127)
  UNION ALL SELECT 'nft', ts, n FROM nfts) GROUP BY ALL""")
def write_transfers_by_date(spark, folder):
    path = scratch_path(spark, "transfers")
    lake.write_transfers_by_date(A.event_logs(spark, folder), path)
    day = ["year", "month", "day"]
    tokens = spark.read.parquet(f"{path}/{lake.TOKEN_TRANSFERS}").select(
        F.lit("token").alias("kind"), *day, F.col("amount_bigint").alias("amount"))
    nfts = spark.read.parquet(f"{path}/{lake.NFT_TRANSFERS}").select(
        F.lit("nft").alias("kind"), *day, F.col("token_count_bigint").alias("amount"))
    return tokens.unionByName(nfts).groupBy("kind", *day).agg(
        F.count("*").alias("rows"),
        F.sum(F.col("amount").cast("decimal(38,0)")).cast("string").alias("amount"))

@query("write_internal_tx", with_(_CALLS) + "SELECT 0 AS bnp, type, count(*) AS rows FROM calls GROUP BY ALL")
def write_internal_tx(spark, folder):
    path = scratch_path(spark, "calls")
    lake.write_internal_tx(_calls(spark, folder), path)
    return spark.read.parquet(f"{path}/{lake.CALLS}").groupBy("bnp", "type").agg(F.count("*").alias("rows"))

@query("relayout_internal_tx", with_(_CALLS) + """
SELECT 're_bnp' AS layout, (block_number // 1000)::VARCHAR AS part, count(*) AS rows FROM calls GROUP BY ALL
UNION ALL SELECT 're_fp', substring(f, 39, 3), count(*) FROM calls GROUP BY ALL
UNION ALL SELECT 're_tp', substring(t, 39, 3), count(*) FROM calls GROUP BY ALL""")
def relayout_internal_tx(spark, folder):
    path = scratch_path(spark, "layouts")
    lake.relayout_internal_tx(_calls(spark, folder), path)
    out = None
    for name, key in (("re_bnp", "bnp"), ("re_fp", "fp"), ("re_tp", "tp")):

        found = spark.read.option("basePath", f"{path}/{lake.CALLS}_{name}").schema(
            f"block_number bigint, {key} string").parquet(f"{path}/{lake.CALLS}_{name}")
        part = found.groupBy(F.lit(name).alias("layout"), F.col(key).alias("part")).agg(F.count("*").alias("rows"))
        out = part if out is None else out.unionByName(part)

    return out

@query("export_delimited", with_(MOVES) + """
SELECT count(*) AS lines, TRUE AS bounded, TRUE AS several FROM moves""")
def export_delimited(spark, folder):
    path = scratch_path(spark, "export")
    rows = A.event_logs(spark, folder)
    files = delimited.export_delimited(
        delimited.event_log_lines(rows), path, delimited.ROWS_PER_FILE["event_logs"])
    return files.agg(
        F.sum("lines").alias("lines"),
        (F.max("lines") <= delimited.ROWS_PER_FILE["event_logs"]).alias("bounded"),
        (F.count("*") > 1).alias("several"))

@query("load_delimited", with_(_CALLS) + """
SELECT block_number, call_id, f AS from_address, gas, parent_call_id, time, t AS to_address, type, value,
  block_number || '_0_' || call_id AS internal_tx_id FROM calls""")
def load_delimited(spark, folder):
    path = scratch_path(spark, "calls-tsv")
    delimited.export_delimited(
        delimited.call_lines(_calls(spark, folder)), path, delimited.ROWS_PER_FILE["calls"])
    loaded = delimited.load_delimited(spark, path, (
        "block_number bigint, call_id int, error string, from_address string, gas bigint, gas_used int, "
        "transaction_index int, input string, output string, parent_call_id int, reverted string, time string, "
        "to_address string, type string, value string, internal_tx_id string"))
    return loaded.select("block_number", "call_id", "from_address", "gas", "parent_call_id", "time",
                         "to_address", "type", "value", "internal_tx_id")

_BLOCK_LINE = (
    "block_score int, extra_data string, gas_used int, governance_data string, hash string, logs_bloom string, number bigint, "
    "parent_hash string, proposer string, receipts_root string, reward string, size int, state_root string, timestamp int, "
    "timestamp_fos int, total_block_score int, transaction_count int, transactions_root string, vote_data string, date string, "
    "base_fee_per_gas string")


@query("block_lines", with_(MOVES, BLOCKS, _LOG, _BLOCK_ROWS) + """
SELECT * EXCLUDE (bnp, committee), strftime(make_timestamp((timestamp::BIGINT + 9 * 3600) * 1000000), '%Y%m') AS date FROM blocks_whole""")
def block_lines(spark, folder):
    path = scratch_path(spark, "block-lines")
    blocks = refine.refine_blocks(L.parse_blocks(A.raw_block_lines(spark, folder)))
    manifested.export_manifested(delimited.block_lines(blocks), path, 1000)
    return delimited.load_delimited(spark, path, _BLOCK_LINE)


@query("transaction_lines", with_(MOVES, TXS, _TRANSACTION_ROWS) + """
SELECT block_hash, block_number, code_format, contract_address, fee_payer, fee_payer_signatures, fee_ratio, from_address, gas, gas_price,
  gas_used, human_readable::INT::VARCHAR AS human_readable, input, key, logs_bloom, nft_transfer_count, nonce, sender_tx_hash,
  '[{"V":"0x1","R":"0x2","S":"0x3"}]' AS signatures, status::INT::VARCHAR AS status, timestamp, to_address, token_transfer_count,
  transaction_hash, transaction_index, tx_error, type, type_int, value, access_list, nullif(chain_id, '') AS chain_id, max_fee_per_gas,
  max_priority_fee_per_gas, effective_gas_price FROM transactions_whole""")
def transaction_lines(spark, folder):
    """Empty text comes back as null, as bulk files tell no difference."""
    path = scratch_path(spark, "transaction-lines")
    txs = refine.refine_transactions(L.parse_blocks(A.raw_block_lines(spark, folder)))
    manifested.export_manifested(delimited.transaction_lines(txs), path, delimited.ROWS_PER_FILE["transactions"])
    return delimited.load_delimited(spark, path, (
        "block_hash string, block_number bigint, code_format string, contract_address string, fee_payer string, "
        "fee_payer_signatures string, fee_ratio string, from_address string, gas bigint, gas_price string, gas_used int, "
        "human_readable string, input string, key string, logs_bloom string, nft_transfer_count int, nonce bigint, "
        "sender_tx_hash string, signatures string, status string, timestamp int, to_address string, token_transfer_count int, "
        "transaction_hash string, transaction_index int, tx_error int, type string, type_int int, value string, "
        "access_list string, chain_id string, max_fee_per_gas string, max_priority_fee_per_gas string, effective_gas_price string"))


@query("export_manifested", "SELECT sum(n)::BIGINT AS lines, count(*) AS told, TRUE AS bounded FROM (SELECT count(*) AS n FROM lineitem)")
def export_manifested(spark, folder):
    """The manifest of the writing tasks next to what the files hold: ``told`` is 1 if they agree on every file."""
    path = scratch_path(spark, "manifested")
    told = manifested.export_manifested(delimited.event_log_lines(A.event_logs(spark, folder)), path, 5000)
    real = delimited.manifest(spark, path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("lines").alias("found"))
    both = told.withColumn("name", F.element_at(F.split("path", "/"), -1)).join(real, "name", "full")
    return both.agg(F.sum("found").alias("lines"), F.max(F.when(F.col("lines") == F.col("found"), 1).otherwise(0)).cast(
        "bigint").alias("told"), F.min(F.coalesce(F.col("lines"), F.lit(0)) == F.col("found")).alias("_all"),
        (F.max("found") <= 5000).alias("bounded")).select("lines", F.when(F.col("_all"), F.col("told")).otherwise(0).alias("told"), "bounded")


@query("write_accounts", with_(MOVES, TXS, _ACCOUNTS) + """
, kinds AS (SELECT a, first IS NOT NULL AS sca FROM seen LEFT JOIN made USING (a)),
failed AS (SELECT created AS a, arg_min(coalesce(err, 0), b * 10 + ti) AS err FROM txs WHERE creates GROUP BY 1)
SELECT 'eoa' AS name, a AS address, 127 AS contract_type FROM kinds WHERE NOT sca
UNION ALL SELECT n, a, CASE WHEN err = 0 THEN CASE k WHEN 4 THEN 2 WHEN 6 THEN 127 ELSE k END ELSE 127 END
  FROM failed JOIN (SELECT DISTINCT c, l_partkey % 7 AS k FROM moves) ON c = a, (VALUES ('sca'), ('contracts')) v(n)""".replace("\n, kinds", ",\nkinds"))
def write_accounts(spark, folder):
    """The three bulk files of the account job, read back."""
    path = scratch_path(spark, "accounts")
    made = jobs.make_accounts(A.transactions(spark, folder), A.event_logs(spark, folder), A.bytecode(spark, folder))
    jobs.write_accounts(made, path)
    rest = {"eoa": "address string, account_type int, total int, contract_type int",
            "sca": "address string, account_type int, total int, contract_type int, creator string, hash string",
            "contracts": "address string, contract_type int, name string, symbol string, decimals int, supply string"}
    out = None
    for name, schema in rest.items():
        part = delimited.load_delimited(spark, f"{path}/{name}", schema).select(F.lit(name).alias("name"), "address", "contract_type")
        out = part if out is None else out.unionByName(part)
    return out


@query("compact_files", "SELECT count(*) AS lines, 1::BIGINT AS files FROM customer")
def compact_files(spark, folder):
    path = scratch_path(spark, "small")
    rows = A.table(spark, folder, "customer").select("c_custkey", "c_name")
    delimited.export_delimited(rows, f"{path}/many", 100)
    delimited.compact_files(spark, f"{path}/many", f"{path}/one")
    return delimited.manifest(spark, f"{path}/one").agg(F.sum("lines").alias("lines"), F.count("*").alias("files"))

@query("rewrite_log", "SELECT count(*) AS lines, 3::BIGINT AS files FROM orders")
def rewrite_log(spark, folder):
    path = scratch_path(spark, "rewrite")
    A.table(spark, folder, "orders").select(
        F.to_json(F.struct(F.col("o_orderkey").alias("blockNumber"))).alias("value")).write.text(f"{path}/a")
    L.rewrite_log(spark, f"{path}/a", f"{path}/b", 3)
    return delimited.manifest(spark, f"{path}/b").agg(F.sum("lines").alias("lines"), F.count("*").alias("files"))

@query("dump_account_contracts", with_(MOVES) + """
SELECT substring(t, 1, 3) AS account_prefix, count(*) AS rows FROM moves GROUP BY 1""")
def dump_account_contracts(spark, folder):
    path = scratch_path(spark, "pairs")
    pairs = A.transfers(spark, folder).select(
        F.col("to_address").alias("account_address"), "contract_address", F.lit(0).alias("transfer_type"))
    jdbc.dump_account_contracts(pairs, path)
    return spark.read.schema("account_address string, account_prefix string").parquet(path).groupBy(
        "account_prefix").agg(F.count("*").alias("rows"))

@query("dump_contracts", f"""
SELECT {con('p_partkey')} AS contract_address, {ctype('p_partkey')} AS contract_type, p_name AS name
FROM part WHERE p_partkey > 50""")
def dump_contracts(spark, folder):
    path = scratch_path(spark, "contracts")
    jdbc.dump_contracts(A.contracts(spark, folder), path, since_id=50)
    return spark.read.parquet(path).select("contract_address", "contract_type", "name")

@query("dump_signatures", """
SELECT 'event_signatures' AS label, count(*) AS rows FROM (SELECT DISTINCT event_type FROM events)
UNION ALL SELECT 'function_signatures', count(*) FROM (SELECT DISTINCT p_name FROM part)""")
def dump_signatures(spark, folder):
    path = scratch_path(spark, "signatures")
    jdbc.dump_signatures(
        A.table(spark, folder, "events").select(F.col("event_type").alias("text_signature")).distinct(),
        A.table(spark, folder, "part").select(F.col("p_name").alias("text_signature")).distinct(), path)
    return spark.read.parquet(path).groupBy("label").agg(F.count("*").alias("rows"))

@query("replay_event_logs", with_(MOVES, NFTS) + """
SELECT 'events' AS kind, count(*) AS rows FROM moves
UNION ALL SELECT 'tokens', count(*) FROM moves WHERE ct IN (0, 1, 127) UNION ALL SELECT 'nfts', count(*) FROM nfts""")
def replay_event_logs(spark, folder):
    path = scratch_path(spark, "event-logs")
    A.event_logs(spark, folder).write.parquet(path)
    parts = lake.replay_event_logs(spark, path)
    out = None
    for kind, df in zip(("events", "tokens", "nfts"), parts):
        one = df.agg(F.lit(kind).alias("kind"), F.count("*").alias("rows"))
        out = one if out is None else out.unionByName(one)
    return out

@query("create_table_ddl", "SELECT o_orderstatus, count(*) AS rows, min(o_custkey) AS first FROM orders GROUP BY 1")
def create_table_ddl(spark, folder):
    path = scratch_path(spark, "table")
    A.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").write.partitionBy(
        "o_orderstatus").parquet(path)
    name = "t_" + path.rsplit("-", 1)[1]
    # a view over the same statement's columns: the metastore is the cluster's, not the query's
    ddl = lake.create_table_ddl(spark, path, name, "o_orderstatus string")
    columns = ddl[ddl.index("(") + 1:ddl.index(")\nUSING")]
    return spark.read.schema(columns).parquet(path).groupBy("o_orderstatus").agg(
        F.count("*").alias("rows"), F.min("o_custkey").alias("first"))

@query("write_transfers_tsv", with_(MOVES, NFTS) + f"""
SELECT 'token' AS kind, (b // 100000)::VARCHAR AS bnp, count(*) AS rows, max(d) AS last FROM moves WHERE ct IN (0, 1, 127) GROUP BY ALL
UNION ALL SELECT 'nft', (b // 100000)::VARCHAR, count(*), max(d) FROM nfts GROUP BY ALL""")
def write_transfers_tsv(spark, folder):
    path = scratch_path(spark, "tsv")
    lake.write_transfers_tsv(A.event_logs(spark, folder), path)
    heads = {
        "token": ("token_transfers", "contract_address string, from_address string, to_address string, amount string, "
                  "timestamp int, block_number bigint, transaction_hash string, display_order string, bnp string"),
        "nft": ("nft_transfers", "contract_address string, from_address string, to_address string, token_count string, "
                "token_id string, timestamp int, block_number bigint, transaction_hash string, display_order string, bnp string"),
    }
    out = None
    for kind, (name, schema) in heads.items():
        part = delimited.load_delimited(spark, f"{path}/{name}", schema).groupBy(
            F.lit(kind).alias("kind"), "bnp").agg(F.count("*").alias("rows"), F.max("display_order").alias("last"))
        out = part if out is None else out.unionByName(part)
    return out

@query("replace_range", with_(MOVES) + """
SELECT (b * 50 // 100000)::INT AS bnp, count(*) AS rows FROM moves WHERE b * 50 < 200000 AND rf = 'A' GROUP BY 1
UNION ALL SELECT (b * 50 // 100000)::INT, count(*) FROM moves WHERE b * 50 >= 200000 GROUP BY 1""")
def replace_range(spark, folder):
    path = scratch_path(spark, "replace")
    rows = A.transfers(spark, folder).select(
        (F.col("block_number") * 50).alias("block_number"), "display_order", "flag")
    bnp = F.call_function("div", F.col("block_number"), F.lit(K.BLOCKS_PER_PARTITION)).cast("string")
    # Line items are dealt by a hash of their order: without the hint each task would write a file into every partition.
    rows.withColumn("bnp", bnp).hint("rebalance", "bnp").write.partitionBy("bnp").parquet(path)
    lake.replace_range(rows.filter("flag = 'A'"), path, 0, 200000)
    return spark.read.parquet(path).groupBy("bnp").agg(F.count("*").alias("rows"))

@query("stream_records", """
SELECT doc_id AS block_number, count(*) AS pieces, max(total)::INT AS total_segments, sum(len)::BIGINT AS chars FROM (
  SELECT doc_id, i, greatest(1, ceil(length(text) / 300.0))::INT AS total,
    length(substring(text, (i * 300 + 1)::BIGINT, 300)) AS len
  FROM documents, range(0, 1000) AS r(i) WHERE i < greatest(1, ceil(length(text) / 300.0))) GROUP BY 1""")
def stream_records(spark, folder):
    def eight_bytes(value):
        return F.unhex(F.lpad(F.hex(value.cast("bigint")), 16, "0"))

    def header(key, value):
        return F.struct(F.lit(key).alias("key"), eight_bytes(value).alias("value"))

    records = A.segments(spark, folder).select(
        F.encode(F.col("block_number").cast("string"), "UTF-8").alias("key"),
        F.encode("piece", "UTF-8").alias("value"),
        F.array(header("segmentIdx", F.col("segment_index")),
                header("totalSegments", F.col("total_segments"))).alias("headers"))
    return L.segments_of(records).groupBy("block_number").agg(
        F.count("*").alias("pieces"), F.max("total_segments").alias("total_segments"),
        F.sum(F.length("piece")).cast("bigint").alias("chars"))
