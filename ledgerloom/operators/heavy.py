"""Lookups by a key that a few values may dominate.

A plain join deals all rows of a key to one task. Here a sketch of fixed size names the keys that hold many
rows; their looked-up rows, no more than ``MOST_KEYS`` of them, go to every task, and only rows of the other keys are
dealt out by key. Rows that have been looked up already, and rows without a key, pass the exchange spread by their contents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, MapType, StructType, ArrayType, VariantType

#: Keys that are broadcast at the most, the share of all rows that makes a key one of them, and the counters of the sketch.
MOST_KEYS, LEAST_SHARE, TRACKED = 200, 0.005, 10_000
SPREAD = 1 << 20


def frequent_keys(df: DataFrame, key: str, most: int = MOST_KEYS, share: float = LEAST_SHARE) -> DataFrame:
    """Keys that hold at least ``share`` of the rows, ``most`` at the most; nulls are none of them.

    One pass that combines before its shuffle: every task sends a sketch of ``TRACKED`` counters.
    """
    found = df.agg(F.expr(f"approx_top_k(`{key}`, {most}, {TRACKED})").alias("top"), F.count("*").alias("rows"))
    return found.select(F.inline("top"), "rows").filter(
        F.col("item").isNotNull() & (F.col("count") >= F.col("rows") * share)).select(F.col("item").alias(key))


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind.fields)
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def lookup(df: DataFrame, right: DataFrame, key: str, most: int = MOST_KEYS, share: float = LEAST_SHARE) -> DataFrame:
    """``df`` with the columns of ``right``, which has one row per key; null where there is none (a left join).

    Columns of ``right`` replace those of the same name. Null keys find nothing. An empty table on either side is no
    special case. ``df`` is read twice, the first time for its key alone. Rows equal in every column stay together,
    as a row's place follows from its contents, so that a task that runs again deals it to the same place.
    """
    values = [c for c in right.columns if c != key]
    kept = [c for c in df.columns if c not in values]
    packed = right.select(F.col(key).alias("_key"), F.struct(*values).alias("_found"))
    heavy = frequent_keys(df, key, most, share).select(F.col(key).alias("_key"))
    held = packed.join(F.broadcast(heavy), "_key", "left_semi")
    known = heavy.join(F.broadcast(held), "_key", "left").withColumn("_held", F.lit(True)).withColumnRenamed("_found", "_near")
    marked = df.select(*kept).join(F.broadcast(known), F.col(key) == F.col("_key"), "left").drop("_key")
    settled = F.coalesce("_held", F.lit(False)) | F.col(key).isNull()
    contents = [f.name for f in df.schema.fields if f.name in kept and _hashable(f.dataType)]
    spread = marked.withColumn("_deal", F.when(settled, F.pmod(F.xxhash64(*contents), F.lit(SPREAD)) + 1).otherwise(F.lit(0).cast("bigint")))
    # Always 0, but no constant: Catalyst would take a constant out of the keys that rows are dealt by.
    dealt = packed.withColumn("_deal", F.pmod(F.xxhash64("_key"), F.lit(1).cast("bigint")))
    met = spread.join(dealt, (F.col(key) == F.col("_key")) & (spread["_deal"] == dealt["_deal"]), "left")
    found = F.coalesce("_near", "_found")
    return met.select(*kept, *[found[c].alias(c) for c in values])
