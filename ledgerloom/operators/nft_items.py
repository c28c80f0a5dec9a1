"""Burn totals per contract and transfer and burn totals per NFT item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerloom import constants as K
from ledgerloom.functions.hexnum import add_hex, sum_hex

ITEM = ("contract_address", "contract_type", "token_id")


def burn_totals(burns: DataFrame, amount: str = "amount") -> DataFrame:
    """Burnt amount and number of burns per contract."""
    return sum_hex(burns.select("contract_address", amount), ["contract_address"], "burn_amount",
                   amount, F.count("*").alias("total_burn"))


def nft_item_burns(burns: DataFrame) -> DataFrame:
    """Burnt amount and number of burns per NFT item."""
    return sum_hex(burns.select(*ITEM, "token_count"), list(ITEM), "burn_amount", "token_count",
                   F.count("*").alias("total_burn"))


def nft_item_transfers(transfers: DataFrame) -> DataFrame:
    """Number of transfers per NFT item."""
    return transfers.groupBy(*ITEM).agg(F.count("*").alias("total_transfer"))


def add_burns(stored: DataFrame, totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored burn totals plus new ones; rows without new burns stay as they are."""
    new = totals.select(*keys, F.col("burn_amount").alias("_amount"), F.col("total_burn").alias("_count"))
    joined = stored.join(new, list(keys), "left")
    summed = add_hex(joined, "_sum", "burn_amount", "_amount")
    return summed.withColumns({
        "burn_amount": F.when(F.col("_amount").isNotNull(), F.col("_sum")).otherwise(F.col("burn_amount")),
        "total_burn": F.coalesce("total_burn", F.lit(0)) + F.coalesce("_count", F.lit(0)),
    }).drop("_sum", "_amount", "_count")


def upsert_item_transfers(stored: DataFrame, totals: DataFrame,
                          new_collections_count: bool = False) -> DataFrame:
    """Add transfer counts to stored items and insert unknown ones.

    A new item of a collection starts with no counted transfers, a multi-token item
    with those seen; ``new_collections_count`` counts them for both.
    """
    keys = list(ITEM)
    new = totals.select(*keys, F.col("total_transfer").alias("_seen"))
    seen = F.col("_seen")
    first = seen if new_collections_count else F.when(
        F.col("contract_type").isin(*K.COLLECTION_TYPES), 0).otherwise(seen)
    known = F.col("total_transfer").isNotNull()
    return stored.select(*keys, "total_transfer").join(new, keys, "full_outer").select(
        *keys,
        F.when(known, F.col("total_transfer") + F.coalesce(seen, F.lit(0))).otherwise(first)
        .cast("bigint").alias("total_transfer"))
