"""Operators over decoded transfers and over logs that change holdings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import constants as K
from ledgerloom.functions.hexnum import hex_to_decimal_text, to_address
from ledgerloom.functions.scalars import is_burn, is_mint
from ledgerloom.operators.decode import data_address, transfer_parties
from ledgerloom.operators.events import (
    is_deposit, is_mint_or_burn, is_nft_transfer, is_set_token_uri, is_token_transfer, is_uri,
    is_withdrawal,
)


def explode_legs(transfers: DataFrame) -> DataFrame:
    """Each transfer as two legs: the sender with sign -1, the receiver with +1."""
    legs = F.array(
        F.struct(F.col("from_address").alias("holder_address"), F.lit(-1).cast("bigint").alias("sign")),
        F.struct(F.col("to_address").alias("holder_address"), F.lit(1).cast("bigint").alias("sign")),
    )
    rest = [c for c in transfers.columns if c not in ("from_address", "to_address")]
    return transfers.select(*rest, F.explode(legs).alias("leg")).select(
        *rest, F.col("leg.holder_address").alias("holder_address"), F.col("leg.sign").alias("sign"))


def burns(transfers: DataFrame) -> DataFrame:
    """Transfers (of either kind) whose receiver is a burn address."""
    return transfers.filter(is_burn("to_address"))


def new_transfers(incoming: DataFrame, existing: DataFrame, key: str = "display_order",
                  stored: Column | None = None) -> DataFrame:
    """Incoming rows whose display order is not stored yet (tokens, NFTs and burns alike).

    ``stored`` is a condition on the stored side, such as the partitions of the batch's blocks,
    that prunes its scan; it has to hold for every stored row with a key of the batch.
    """
    seen = existing if stored is None else existing.filter(stored)
    return incoming.join(seen.select(key), key, "left_anti")


def transfer_counts(logs: DataFrame) -> DataFrame:
    """Transfer events per contract."""
    return logs.filter(is_token_transfer("topics") | is_nft_transfer("topics")).groupBy(
        F.col("address").alias("contract_address")).agg(F.count("*").alias("transfers"))


def stored_transfer_counts(token_transfers: DataFrame, nft_transfers: DataFrame) -> DataFrame:
    """Stored transfer rows per contract; a contract in both tables keeps its NFT count."""
    both = token_transfers.select("contract_address", F.lit(0).alias("nft")).unionAll(
        nft_transfers.select("contract_address", F.lit(1).alias("nft")))
    counted = both.groupBy("contract_address").agg(
        F.count("*").alias("rows"), F.sum("nft").alias("nft"))
    return counted.select(
        "contract_address", F.when(F.col("nft") > 0, F.col("nft")).otherwise(F.col("rows")).alias("transfers"))


def tx_counts(transactions: DataFrame) -> DataFrame:
    """Transactions per sender."""
    return transactions.groupBy(F.col("from_address").alias("address")).agg(
        F.count("*").alias("transactions"))


def account_contracts(transfers: DataFrame, typed: bool = True, exclude: tuple = (), within: tuple = ()) -> DataFrame:
    """Latest time at which an account moved a contract's tokens, apart for each value of the columns ``within``.

    ``transfers`` has ``is_token``. The batch form keys by transfer type as well;
    with ``typed=False`` the latest transfer decides the type, as the continuous
    form does (which also leaves out the zero address).
    """
    account = F.explode(F.array_distinct(F.array("from_address", "to_address"))).alias("account_address")
    kind = F.when(F.col("is_token"), K.TRANSFER_TOKEN).otherwise(K.TRANSFER_NFT).alias("transfer_type")
    legs = transfers.select(account, "contract_address", kind, "timestamp", *within)
    legs = legs.filter(F.col("account_address").isNotNull())
    if exclude:
        legs = legs.filter(~F.col("account_address").isin(*exclude))
    if typed:
        return legs.groupBy("account_address", "contract_address", "transfer_type", *within).agg(
            F.max("timestamp").alias("timestamp"))
    # time and type in one number, which a hash aggregate takes
    latest = F.max(F.col("timestamp").cast("bigint") * 2 + F.col("transfer_type")).alias("latest")
    return legs.groupBy("account_address", "contract_address", *within).agg(latest).select(
        "account_address", "contract_address", *within, F.col("latest").bitwiseAND(F.lit(1)).cast("int").alias("transfer_type"),
        F.shiftright("latest", 1).cast("int").alias("timestamp"))


def follow_windows(pairs: DataFrame, window: str = "window") -> DataFrame:
    """Account contracts of many windows as ``merge_account_contracts`` would leave them, window after window.

    The first window with a time gives ``created_at``, the newest time (of equal ones that of the last window) the type.
    """
    # time, window and type in one number, which a hash aggregate takes; pairs without a contract never meet
    newest = F.max((F.col("timestamp").cast("bigint") * (1 << 20) + F.col(window)) * 2 + F.col("transfer_type"))
    first = F.min_by("timestamp", F.when(F.col("timestamp").isNotNull(), F.col(window)))
    alone = F.when(F.col("contract_address").isNull(), F.col(window)).alias("_alone")
    return pairs.groupBy("account_address", "contract_address", alone).agg(
        newest.alias("_newest"), first.alias("created_at")).select(
        "account_address", "contract_address", F.col("_newest").bitwiseAND(F.lit(1)).cast("int").alias("transfer_type"),
        F.shiftright("_newest", 21).cast("int").alias("timestamp"), "created_at")


def merge_account_contracts(current: DataFrame, incoming: DataFrame) -> DataFrame:
    """Add new pairs; on known ones keep ``created_at`` and the type and time of the newer side.

    An incoming row that is older than the stored one changes nothing, so a batch that is read
    again, or late, does not turn ``updated_at`` back. Incoming rows of several windows
    (``follow_windows``) have a ``created_at`` of their own.
    """
    keys = ["account_address", "contract_address"]
    first = "created_at" if "created_at" in incoming.columns else "timestamp"
    new = incoming.select(
        *keys, F.col("transfer_type").alias("new_type"), F.col("timestamp").alias("new_ts"), F.col(first).alias("new_first"))
    newer = F.coalesce(F.col("new_ts") >= F.col("updated_at"), F.col("new_ts").isNotNull())
    return current.join(new, keys, "full_outer").select(
        *keys,
        F.coalesce("created_at", "new_first").alias("created_at"),
        F.greatest("new_ts", "updated_at").alias("updated_at"),
        F.when(newer, F.col("new_type")).otherwise(F.col("transfer_type")).alias("transfer_type"),
    )


def supply_change_contracts(logs: DataFrame) -> DataFrame:
    """Contracts whose supply may have changed.

    Mint and burn events, transfers from zero or to a burn address, and transfers
    with the contract itself as a party (pool shares).
    """
    parties = transfer_parties(logs).filter(
        is_burn("to_address") | is_mint("from_address")
        | (F.col("to_address") == F.col("contract_address"))
        | (F.col("from_address") == F.col("contract_address"))
    ).select("contract_address")
    direct = logs.filter(is_mint_or_burn("topics")).select(F.col("address").alias("contract_address"))
    return parties.unionAll(direct).distinct()


def deposit_withdraw_holders(logs: DataFrame, contracts: DataFrame) -> DataFrame:
    """Holders touched by deposit and withdrawal events of fungible contracts."""
    size = F.size("topics")
    holder = F.when(size == 1, data_address("data")).when(size.isin(2, 3), to_address(F.get("topics", 1)))
    fungible = contracts.filter(F.col("contract_type").isin(*K.FUNGIBLE_TYPES)).select("contract_address")
    return logs.filter(is_withdrawal("topics") | is_deposit("topics")).select(
        F.col("address").alias("contract_address"), holder.alias("holder_address"),
        "timestamp", "block_number",
    ).filter(F.col("holder_address").isNotNull()).join(fungible, "contract_address", "left_semi")


def uri_change_events(logs: DataFrame) -> DataFrame:
    """Tokens whose metadata address changed."""
    return logs.filter((is_uri("topics") | is_set_token_uri("topics")) & (F.size("topics") > 1)).select(
        F.col("address").alias("contract_address"),
        hex_to_decimal_text(F.get("topics", 1)).alias("token_id"),
        "timestamp", "block_number",
    )
