"""Raw block lines to flat blocks, transactions and event logs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import constants as K
from ledgerloom.functions.hexnum import (
    hex_to_decimal_text, hex_to_int, hex_to_long, to_address,
)
from ledgerloom.functions.scalars import block_partition, create_method, default_gas_price
from ledgerloom.operators.events import event_type, is_nft_transfer, is_token_transfer


def _number_or_default(price: Column, block: Column, network: str) -> Column:
    return F.when(price.isNotNull(), hex_to_decimal_text(price)).otherwise(default_gas_price(block, network))


def refine_blocks(raw: DataFrame) -> DataFrame:
    """One row per block: hex fields as numbers, the base fee as decimal text."""
    r = F.col("result")
    return raw.select(
        block_partition("blockNumber").alias("bnp"),
        hex_to_decimal_text(r["baseFeePerGas"]).alias("base_fee_per_gas"),
        hex_to_int(r["blockscore"]).alias("block_score"),
        r["committee"].alias("committee"),
        r["extraData"].alias("extra_data"),
        hex_to_int(r["gasUsed"]).alias("gas_used"),
        r["governanceData"].alias("governance_data"),
        r["hash"].alias("hash"),
        r["logsBloom"].alias("logs_bloom"),
        F.col("blockNumber").alias("number"),
        r["parentHash"].alias("parent_hash"),
        r["proposer"].alias("proposer"),
        r["receiptsRoot"].alias("receipts_root"),
        r["reward"].alias("reward"),
        hex_to_int(r["size"]).alias("size"),
        r["stateRoot"].alias("state_root"),
        hex_to_int(r["timestamp"]).alias("timestamp"),
        hex_to_int(r["timestampFoS"]).alias("timestamp_fos"),
        hex_to_int(r["totalBlockScore"]).alias("total_block_score"),
        r["transactionsRoot"].alias("transactions_root"),
        r["voteData"].alias("vote_data"),
        F.size(r["transactions"]).alias("transaction_count"),
    )


def _exploded(raw: DataFrame) -> DataFrame:
    return raw.select(
        block_partition("blockNumber").alias("bnp"),
        hex_to_int(F.col("result.timestamp")).alias("timestamp"),
        F.explode("result.transactions").alias("tx"),
    )


def refine_transactions(raw: DataFrame, network: str = "mainnet") -> DataFrame:
    """One row per transaction, with its token and NFT transfer counts."""
    t = F.col("tx")
    block = hex_to_long(t["blockNumber"])
    return _exploded(raw).select(
        "bnp",
        t["accessList"].alias("access_list"),
        t["blockHash"].alias("block_hash"),
        block.alias("block_number"),
        t["contractAddress"].alias("contract_address"),
        t["chainId"].alias("chain_id"),
        t["from"].alias("from_address"),
        hex_to_long(t["gas"]).alias("gas"),
        _number_or_default(t["gasPrice"], block, network).alias("gas_price"),
        hex_to_int(t["gasUsed"]).alias("gas_used"),
        t["input"].alias("input"),
        t["logsBloom"].alias("logs_bloom"),
        hex_to_decimal_text(t["maxFeePerGas"]).alias("max_fee_per_gas"),
        hex_to_decimal_text(t["maxPriorityFeePerGas"]).alias("max_priority_fee_per_gas"),
        hex_to_long(t["nonce"]).alias("nonce"),
        t["senderTxHash"].alias("sender_tx_hash"),
        t["signatures"].alias("signatures"),
        (t["status"] == "0x1").alias("status"),
        t["to"].alias("to_address"),
        t["transactionHash"].alias("transaction_hash"),
        hex_to_int(t["transactionIndex"]).alias("transaction_index"),
        t["type"].alias("type"),
        t["typeInt"].alias("type_int"),
        hex_to_decimal_text(t["value"]).alias("value"),
        t["codeFormat"].alias("code_format"),
        t["feePayer"].alias("fee_payer"),
        t["feePayerSignatures"].alias("fee_payer_signatures"),
        t["feeRatio"].alias("fee_ratio"),
        t["humanReadable"].alias("human_readable"),
        t["key"].alias("key"),
        hex_to_int(t["txError"]).alias("tx_error"),
        count_token_transfers(t["logs"]).alias("token_transfer_count"),
        count_nft_transfers(t["logs"]).alias("nft_transfer_count"),
        "timestamp",
        hex_to_decimal_text(t["effectiveGasPrice"]).alias("effective_gas_price"),
    )


def count_token_transfers(logs: Column) -> Column:
    return F.size(F.filter(logs, lambda log: F.coalesce(is_token_transfer(log["topics"]), F.lit(False))))


def count_nft_transfers(logs: Column) -> Column:
    return F.size(F.filter(logs, lambda log: F.coalesce(is_nft_transfer(log["topics"]), F.lit(False))))


def transfer_counts_per_tx(raw: DataFrame) -> DataFrame:
    """Token and NFT transfer events per transaction, straight from the raw lines."""
    t = F.col("tx")
    return _exploded(raw).select(
        t["transactionHash"].alias("transaction_hash"),
        count_token_transfers(t["logs"]).alias("token_transfer_count"),
        count_nft_transfers(t["logs"]).alias("nft_transfer_count"),
    )


def refine_event_logs(raw: DataFrame) -> DataFrame:
    """One row per event log, with the status of its transaction and the block time."""
    exploded = _exploded(raw).select(
        "bnp", "timestamp",
        (F.col("tx.status") == "0x1").alias("transaction_status"),
        F.explode("tx.logs").alias("log"),
    )
    g = F.col("log")
    return exploded.select(
        "bnp",
        g["blockHash"].alias("block_hash"),
        hex_to_long(g["blockNumber"]).alias("block_number"),
        g["transactionHash"].alias("transaction_hash"),
        hex_to_int(g["transactionIndex"]).alias("transaction_index"),
        "transaction_status",
        g["address"].alias("address"),
        g["topics"].alias("topics"),
        g["data"].alias("data"),
        hex_to_int(g["logIndex"]).alias("log_index"),
        "timestamp",
        g["removed"].alias("removed"),
    )


def account_key_updates(transactions: DataFrame) -> DataFrame:
    """Transactions that set a new account key; the key stays in its encoded form."""
    return transactions.filter(
        F.col("type").isin(*K.ACCOUNT_UPDATE_TYPES) & F.col("key").isNotNull()
    ).select("block_number", "transaction_hash",
             F.col("from_address").alias("account_address"), F.col("key").alias("account_key"))


def implementation_updates(logs: DataFrame) -> DataFrame:
    """Proxy contracts and the implementation that an Upgraded event names."""
    word = F.when(F.size("topics") == 2, F.get("topics", 1)).otherwise(F.col("data"))
    return logs.filter(event_type("topics") == "upgraded").select(
        F.col("address").alias("contract_address"),
        to_address(word).alias("implementation_address"),
        "block_number", "transaction_index", "log_index",
    )


BLANK_TO_NULL = (
    "code_format", "contract_address", "fee_payer_signatures", "fee_payer", "fee_ratio",
    "max_fee_per_gas", "max_priority_fee_per_gas", "value", "to_address", "key",
)


def clean_blank_to_null(transactions: DataFrame, chain_id: str = K.DEFAULT_CHAIN_ID) -> DataFrame:
    """Blank text to null on ten columns; blank access lists and chain ids to their defaults."""
    changes = {c: F.nullif(F.col(c), F.lit("")) for c in BLANK_TO_NULL if c in transactions.columns}
    for name, default in (("access_list", "[]"), ("chain_id", chain_id)):
        if name in transactions.columns:
            changes[name] = F.when(F.col(name) == "", default).otherwise(F.col(name))
    return transactions.withColumns(changes)


def create_transactions(transactions: DataFrame) -> DataFrame:
    """Transactions whose input starts a contract creation, with the method."""
    return transactions.withColumn("method", create_method("input")).filter(F.col("method").isNotNull())
