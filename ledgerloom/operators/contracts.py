"""Contract lookups, creations found in call traces, and types from byte code."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom import constants as K
from ledgerloom.functions.bytecode import contract_type_of, function_selectors
from ledgerloom.functions.scalars import supply_order, truncate_name, truncate_symbol
from ledgerloom.operators.heavy import lookup


def with_contract_type(df: DataFrame, contracts: DataFrame, default: int = K.TYPE_CUSTOM) -> DataFrame:
    """Add the type of ``contract_address``.

    No broadcast hint: contract tables grow with the chain, so the size check is
    left to the planner.
    """
    types = contracts.select("contract_address", F.col("contract_type").alias("_type"))
    joined = df.drop("contract_type").join(types, "contract_address", "left")
    return joined.withColumn(
        "contract_type", F.coalesce("_type", F.lit(default)).cast("int")).drop("_type")


def with_contract_type_of_many(df: DataFrame, contracts: DataFrame, default: int = K.TYPE_CUSTOM) -> DataFrame:
    """As ``with_contract_type``, for tables in which a few contracts hold a large part of the rows.

    For whole tables of transfers: it reads ``df`` twice, which a micro-batch is too small to repay.
    """
    typed = lookup(df, contracts.select("contract_address", "contract_type"), "contract_address")
    return typed.withColumn("contract_type", F.coalesce("contract_type", F.lit(default)).cast("int"))


def contracts_from_calls(calls: DataFrame, transactions: DataFrame, accounts: DataFrame) -> DataFrame:
    """Contracts created inside call traces, with their creating transaction.

    ``action`` is insert for unknown accounts and update for known ones.
    """
    made = calls.filter(
        F.lower("type").startswith("create")
        & F.col("to_address").startswith("0x") & F.col("from_address").startswith("0x")
    ).select(
        "block_number", F.col("index").alias("transaction_index"), "call_id",
        F.col("from_address").alias("creator_address"),
        F.col("to_address").alias("contract_address"), F.col("input"))
    txs = transactions.select(
        "block_number", "transaction_index", "transaction_hash",
        F.col("timestamp").alias("created_at"), F.coalesce("tx_error", F.lit(0)).alias("tx_error"),
        F.col("from_address").alias("deployer_address"))
    known = accounts.select(F.col("address").alias("contract_address"), F.lit(True).alias("_known")).distinct()
    joined = made.join(txs, ["block_number", "transaction_index"], "left").join(
        known, "contract_address", "left")
    return joined.withColumns({
        "tx_error": F.coalesce("tx_error", F.lit(0)),
        "action": F.when(F.col("_known"), "update").otherwise("insert"),
    }).drop("_known")


def creator_increments(found: DataFrame) -> DataFrame:
    """Transactions to add to the creators of ``contracts_from_calls``: one for each contract found."""
    return found.groupBy(F.col("creator_address").alias("address")).agg(F.count("*").alias("transactions"))


def contract_selectors(code: DataFrame) -> DataFrame:
    """One row per contract and function selector in its ``bytecode``."""
    return code.select("contract_address", F.explode(function_selectors("bytecode")).alias("selector"))


def contract_types(code: DataFrame, default: int = K.TYPE_CUSTOM) -> DataFrame:
    """Contract type by the selectors in its ``bytecode``."""
    found = code.select("contract_address", function_selectors("bytecode").alias("selectors"))
    return found.select(
        "contract_address",
        F.coalesce(contract_type_of("selectors"), F.lit(default)).alias("contract_type"))


def register_contracts(contracts: DataFrame) -> DataFrame:
    """Contract rows as stored: text cut to its limits, supply with its sortable form."""
    decimals = F.coalesce("decimals", F.lit(0))
    supply = F.coalesce("total_supply", F.lit("0"))
    return contracts.withColumns({
        "symbol": truncate_symbol("symbol"),
        "name": truncate_name("name"),
        "total_supply": supply,
        "total_supply_order": supply_order(supply, decimals),
        "decimals": decimals,
    })
