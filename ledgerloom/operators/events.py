"""Event classification by topics, as boolean and text columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom import constants as K
from ledgerloom.functions.hexnum import as_col

TRANSFER_TYPES = ("token_transfer", "nft_transfer", "transfer_single", "transfer_batch")
NFT_TRANSFER_TYPES = TRANSFER_TYPES[1:]

_BY_TOPIC = (
    (K.TOPIC_LEGACY_NFT_TRANSFER, "nft_transfer"),
    (K.TOPIC_APPROVAL, "approval"),
    (K.TOPIC_APPROVAL_FOR_ALL, "approval_for_all"),
    (K.TOPIC_TRANSFER_SINGLE, "transfer_single"),
    (K.TOPIC_TRANSFER_BATCH, "transfer_batch"),
    (K.TOPIC_MINTER_ADDED, "minter_added"),
    (K.TOPIC_ADDR_CHANGED, "addr_changed"),
    (K.TOPIC_NEW_RESOLVER, "new_resolver"),
    (K.TOPIC_NAME_CHANGED, "name_changed"),
    (K.TOPIC_UPGRADED, "upgraded"),
)


def signature(topics: Column | str) -> Column:
    """Topic 0, or empty text for an event without topics."""
    return F.coalesce(F.get(as_col(topics), 0), F.lit(""))


def event_type(topics: Column | str) -> Column:
    """The kind of event. Three topics make a Transfer a token transfer, four an NFT one."""
    first, count = F.get(as_col(topics), 0), F.size(as_col(topics))
    result = F.when((first == K.TOPIC_TRANSFER) & (count == 3), "token_transfer")
    result = result.when((first == K.TOPIC_TRANSFER) & (count == 4), "nft_transfer")
    for topic, name in _BY_TOPIC:
        result = result.when(first == topic, name)
    return result.otherwise("unknown")


def is_token_transfer(topics: Column | str) -> Column:
    return (signature(topics) == K.TOPIC_TRANSFER) & (F.size(as_col(topics)) == 3)


def is_nft_transfer(topics: Column | str) -> Column:
    first, count = signature(topics), F.size(as_col(topics))
    return ((first == K.TOPIC_TRANSFER) & (count == 4)) | first.isin(
        K.TOPIC_LEGACY_NFT_TRANSFER, K.TOPIC_TRANSFER_SINGLE, K.TOPIC_TRANSFER_BATCH)


def is_transfer(topics: Column | str) -> Column:
    return is_token_transfer(topics) | is_nft_transfer(topics)


def is_approval(topics: Column | str) -> Column:
    return signature(topics).isin(K.TOPIC_APPROVAL, K.TOPIC_APPROVAL_FOR_ALL)


def is_mint_or_burn(topics: Column | str) -> Column:
    return signature(topics).isin(*K.MINT_BURN_TOPICS)


def is_withdrawal(topics: Column | str) -> Column:
    return signature(topics) == K.TOPIC_WITHDRAWAL


def is_deposit(topics: Column | str) -> Column:
    return signature(topics) == K.TOPIC_DEPOSIT


def is_uri(topics: Column | str) -> Column:
    return signature(topics) == K.TOPIC_URI


def is_set_token_uri(topics: Column | str) -> Column:
    return signature(topics) == K.TOPIC_SET_TOKEN_URI


def is_upgraded(topics: Column | str) -> Column:
    return signature(topics) == K.TOPIC_UPGRADED


def is_minter_added(topics: Column | str) -> Column:
    return signature(topics) == K.TOPIC_MINTER_ADDED


PREDICATES = {
    "is_transfer": is_transfer,
    "is_token_transfer": is_token_transfer,
    "is_nft_transfer": is_nft_transfer,
    "is_approval": is_approval,
    "is_mint_or_burn": is_mint_or_burn,
    "is_withdrawal": is_withdrawal,
    "is_deposit": is_deposit,
    "is_uri": is_uri,
    "is_set_token_uri": is_set_token_uri,
    "is_upgraded": is_upgraded,
    "is_minter_added": is_minter_added,
}


def classify_events(logs: DataFrame) -> DataFrame:
    """Add ``event_type`` and one boolean column per predicate."""
    columns = {"event_type": event_type("topics")}
    columns.update({name: test("topics") for name, test in PREDICATES.items()})
    return logs.withColumns(columns)
