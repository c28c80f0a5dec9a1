"""Token metadata addresses."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

TOKEN = ["contract_address", "token_id"]


def token_uri(tokens: DataFrame, stored: DataFrame, patterns: DataFrame) -> DataFrame:
    """Stored uri, else the contract's pattern with ``{id}`` filled in, else ``-``."""
    known = stored.select(*TOKEN, F.col("token_uri").alias("_stored"))
    pattern = patterns.select("contract_address", F.col("pattern").alias("_pattern"))
    filled = F.replace(F.col("_pattern"), F.lit("{id}"), F.col("token_id"))
    return tokens.join(known, TOKEN, "left").join(pattern, "contract_address", "left").withColumn(
        "token_uri", F.coalesce("_stored", filled, F.lit("-"))).drop("_stored", "_pattern")


def tokens_missing_uri(transfers: DataFrame, inventories: DataFrame) -> DataFrame:
    """Tokens that a party of these transfers holds without a known uri."""
    sides = transfers.select(
        *TOKEN, F.explode(F.array("from_address", "to_address")).alias("holder_address")).distinct()
    missing = inventories.filter(F.col("token_uri") == "-").select(
        *TOKEN, "holder_address", "contract_type")
    return sides.join(missing, [*TOKEN, "holder_address"]).select(*TOKEN, "contract_type").distinct()


def backfill_uris(inventories: DataFrame, missing: DataFrame, snapshot: DataFrame,
                  max_length: int = 255) -> DataFrame:
    """Inventories with the uris of missing tokens filled from a snapshot; uris that are
    absent, blank (``-``) or too long change nothing."""
    usable = snapshot.filter(
        (F.col("token_uri") != "-") & (F.length("token_uri") <= max_length)
    ).select(*TOKEN, F.col("token_uri").alias("_uri"))
    fresh = missing.select(*TOKEN).distinct().join(usable, TOKEN)
    return inventories.join(fresh, TOKEN, "left").withColumn(
        "token_uri", F.coalesce("_uri", "token_uri")).drop("_uri")
