"""Joins of blocks, transactions and logs with each other."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def events_with_tx(logs: DataFrame, transactions: DataFrame, lo: int, hi: int) -> DataFrame:
    """Event logs with the status and time of their transaction, for blocks lo to hi.

    The block range goes to both sides, so it prunes both scans.
    """
    txs = transactions.filter(F.col("block_number").between(lo, hi)).select(
        "transaction_hash", F.col("status").alias("transaction_status"), "timestamp")
    found = logs.filter(F.col("block_number").between(lo, hi)).drop("transaction_status", "timestamp")
    return found.join(txs, "transaction_hash", "inner")


def assemble_blocks(blocks: DataFrame, transactions: DataFrame, logs: DataFrame) -> DataFrame:
    """Blocks with their transactions and logs nested, empty lists where there are none."""
    def nested(df: DataFrame, name: str, order: list[str]) -> DataFrame:
        rest = [c for c in df.columns if c != "block_number" and c not in order]
        return df.groupBy(F.col("block_number").alias("number")).agg(
            F.array_sort(F.collect_list(F.struct(*order, *rest))).alias(name))

    txs = nested(transactions, "transactions", ["transaction_index"])
    events = nested(logs, "logs", ["transaction_index", "log_index"])
    joined = blocks.join(txs, "number", "left").join(events, "number", "left")
    return joined.withColumns({
        "transactions": F.coalesce("transactions", F.array().cast(txs.schema["transactions"].dataType)),
        "logs": F.coalesce("logs", F.array().cast(events.schema["logs"].dataType)),
    })


def party_union(transfers: DataFrame) -> DataFrame:
    """Distinct addresses on either side, from one scan."""
    return transfers.select(F.explode(F.array("from_address", "to_address")).alias("address")).distinct()
