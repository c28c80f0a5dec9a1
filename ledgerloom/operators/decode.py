"""Transfer events to flat transfers: the ABI layouts as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions.hexnum import (
    as_col, computed_once, hex_body, hex_to_decimal_text, to_address,
)
from ledgerloom.functions.scalars import display_order
from ledgerloom.operators.events import event_type, is_nft_transfer, is_token_transfer

_ONE = "0x" + "1".rjust(64, "0")
_WORD = 64
_ITEMS = "array<struct<id: string, amount: string>>"


def _topic_address(position: int) -> Column:
    return F.concat(F.lit("0x"), F.substring(F.get("topics", position), 27, 40))


def word(body: Column, index: int) -> Column:
    """The n-th 32-byte word of a data field without prefix."""
    return F.substring(body, _WORD * index + 1, _WORD)


def data_address(data: Column | str, index: int = 0) -> Column:
    """The address held in the n-th word of a data field."""
    return F.concat(F.lit("0x"), F.substring(word(hex_body(data), index), 25, 40))


def word_to_size(text: Column) -> Column:
    """A word as a number, or null when it is too big to be a position or a length."""
    fits = text.startswith("0" * 50) & (F.length(text) == _WORD)
    return F.when(fits, F.conv(F.substring(text, 51, 14), 16, 10).cast("bigint"))


def token_transfers(logs: DataFrame) -> DataFrame:
    """Fungible transfers: both parties from the topics, the amount as logged."""
    return logs.filter(is_token_transfer("topics")).select(
        F.col("address").alias("contract_address"),
        _topic_address(1).alias("from_address"),
        _topic_address(2).alias("to_address"),
        F.col("data").alias("amount"),
        "timestamp", "block_number", "transaction_hash",
        display_order("block_number", "transaction_index", "log_index").alias("display_order"),
    )


def nft_transfers(logs: DataFrame) -> DataFrame:
    """NFT and multi-token transfers, one row per token id.

    Five layouts: the single-token form, and the single and batch multi-token
    forms with their parties either in the topics or in the data. Data that does
    not fit its layout gives no rows. Where the two lists of a batch begin and how many words they hold are columns
    that build on each other: as one expression they are worked out again for each use, also for each word.
    """
    topics, kind = F.size("topics"), F.col("kind")
    body, size = F.col("body"), F.length("body")
    staged = logs.filter(is_nft_transfer("topics")).withColumns(
        {"kind": event_type("topics"), "body": hex_body("data")})

    five_words = F.call_function("div", F.length(body) + (_WORD - 1), F.lit(_WORD)) == 5
    indexed = topics >= 4
    single, batch = kind == "transfer_single", kind == "transfer_batch"

    def one(token_id: Column, amount: Column) -> Column:
        return F.array(F.struct(token_id.alias("id"), amount.alias("amount"))).cast(_ITEMS)

    def start(head: Column) -> Column:
        return F.when(batch, word_to_size(F.substring(body, head * _WORD + 1, F.lit(_WORD))) * 2)

    def count(at: str) -> Column:
        return F.when(F.col(at) < size, word_to_size(F.substring(body, (F.col(at) + 1).cast("int"), F.lit(_WORD))))

    def fits(at: str, n: str) -> Column:
        return (F.col(at) + _WORD + F.col(n) * _WORD) <= size

    def nth(at: str, i: Column) -> Column:
        return F.substring(body, (F.col(at) + (i + 1) * _WORD + 1).cast("int"), F.lit(_WORD))

    head = F.when(indexed, 0).otherwise(3)
    staged = staged.withColumns({"_ids": start(head), "_amounts": start(head + 1)}).withColumns(
        {"_ids_n": count("_ids"), "_amounts_n": count("_amounts")}).withColumn(
        "_pairs", F.when(fits("_ids", "_ids_n") & fits("_amounts", "_amounts_n"), F.least("_ids_n", "_amounts_n")))
    pairs = F.transform(F.sequence(F.lit(0), (F.col("_pairs") - 1).cast("int")), lambda i: F.struct(
        nth("_ids", i).alias("id"), F.concat(F.lit("0x"), nth("_amounts", i)).alias("amount")))

    items = (
        F.when((kind == "nft_transfer") & indexed, one(hex_body(F.get("topics", 3)), F.lit(_ONE)))
        .when(single & indexed, one(word(body, 0), F.concat(F.lit("0x"), word(body, 1))))
        .when(single & five_words, one(word(body, 3), F.concat(F.lit("0x"), word(body, 4))))
        .when(batch & (F.col("_pairs") > 0), pairs.cast(_ITEMS))
    )

    def party(topic: int, data_word: int) -> Column:
        return (
            F.when(kind == "nft_transfer", _topic_address(topic - 1))
            .when(indexed, _topic_address(topic))
            .otherwise(to_address(word(body, data_word)))
        )

    return staged.select(
        F.col("address").alias("contract_address"),
        party(2, 1).alias("from_address"),
        party(3, 2).alias("to_address"),
        F.posexplode(items).alias("item_index", "item"),
        "timestamp", "block_number", "transaction_hash",
        display_order("block_number", "transaction_index", "log_index").alias("display_order"),
    ).select(
        "contract_address", "from_address", "to_address",
        F.col("item.amount").alias("token_count"),
        hex_to_decimal_text(F.concat(F.lit("0x"), F.col("item.id"))).alias("token_id"),
        "timestamp", "block_number", "transaction_hash", "display_order", "item_index",
    )


def party_columns() -> tuple[Column, Column]:
    """Sender and receiver of a transfer event; null for other or undecodable events."""
    kind = event_type("topics")
    body = hex_body("data")
    words = F.call_function("div", F.length(body) + (_WORD - 1), F.lit(_WORD))
    indexed = F.size("topics") >= 4
    by_data = ((kind == "transfer_single") & (words == 5)) | ((kind == "transfer_batch") & (words >= 5))

    def party(topic: int, data_word: int) -> Column:
        return (
            F.when(kind.isin("token_transfer", "nft_transfer"), _topic_address(topic - 1))
            .when(kind.isin("transfer_single", "transfer_batch") & indexed, _topic_address(topic))
            .when(by_data, to_address(word(body, data_word)))
        )

    return party(2, 1), party(3, 2)


def transfer_parties(logs: DataFrame) -> DataFrame:
    """Contract and both parties of every transfer event, one row per event."""
    sender, receiver = party_columns()
    kept = logs.filter(is_token_transfer("topics") | is_nft_transfer("topics")).select(
        F.col("address").alias("contract_address"), "topics", "data",
        "timestamp", "block_number", "transaction_index", "log_index", "transaction_status",
        "transaction_hash")
    rest = [c for c in kept.columns if c not in ("topics", "data")]
    return computed_once(kept, rest, {
        "from_address": sender, "to_address": receiver, "is_token": is_token_transfer("topics")})
