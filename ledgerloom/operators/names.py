"""Primary names of accounts from name-service events."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerloom import constants as K
from ledgerloom.functions.hexnum import hex_body, to_address
from ledgerloom.functions.scalars import has_name_suffix, reverse_name_to_address
from ledgerloom.operators.decode import word, word_to_size
from ledgerloom.operators.events import event_type


def _data_text(data: str = "data"):
    """The string in the first (dynamic) slot of a data field; blank text is null."""
    body = hex_body(data)
    start = word_to_size(word(body, 0)) * 2
    length = word_to_size(F.substring(body, (start + 1).cast("int"), F.lit(64)))
    digits = F.substring(body, (start + 65).cast("int"), (length * 2).cast("int"))
    return F.nullif(F.decode(F.unhex(digits), "UTF-8"), F.lit(""))


def resolve_names(logs: DataFrame, names: DataFrame, primary: DataFrame, registry: str,
                  suffix: str) -> DataFrame:
    """Name changes of accounts (``action`` update) and names seen first (register).

    ``names`` is a snapshot by ``name_hash`` with ``name``, ``resolved_address`` and
    ``known`` (stored already); ``primary`` holds each address's primary name.
    """
    kind = event_type("topics")
    moved = (kind == "nft_transfer") & (F.col("address") == registry)
    name_hash = (
        F.when(kind.isin("addr_changed", "new_resolver", "name_changed"), F.get("topics", 1))
        .when(moved, F.get("topics", 3))
    )
    events = logs.select(
        name_hash.alias("name_hash"), (kind == "name_changed").alias("is_reverse"),
        F.when(kind == "name_changed", _data_text()).alias("new_name"),
        F.when(moved, to_address(F.get("topics", 1))).alias("moved_from"),
    ).filter("name_hash is not null")

    known = events.join(names.select("name_hash", "name", "resolved_address", "known"), "name_hash")
    reverse = known.filter(F.col("is_reverse") & F.col("name").contains(K.REVERSE_SUFFIX)).select(
        reverse_name_to_address("name").alias("address"), F.col("new_name").alias("name"),
        F.lit("update").alias("action"))
    forward = known.filter(
        ~F.col("is_reverse") & has_name_suffix("name", suffix)
        & (F.col("resolved_address") != K.ZERO_ADDRESS))
    primaries = primary.select("address", F.nullif("primary_name", F.lit("")).alias("primary_name"))
    updated = forward.filter("known").select(F.col("resolved_address").alias("address")).join(
        primaries, "address", "left").select(
        "address", F.col("primary_name").alias("name"), F.lit("update").alias("action"))
    fresh = forward.filter("not known").select(
        F.col("resolved_address").alias("address"), "name", F.lit("register").alias("action"))
    left = events.filter("moved_from is not null").select(F.col("moved_from").alias("address")).join(
        primaries, "address", "left").select(
        "address", F.col("primary_name").alias("name"), F.lit("update").alias("action"))
    return reverse.unionByName(updated).unionByName(fresh).unionByName(left).distinct()
