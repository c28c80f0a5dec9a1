"""Table merges. Parquet has no row update, so each returns the whole new table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


def insert_ignore(target: DataFrame, source: DataFrame, keys: Sequence[str],
                  order: Sequence[str | Column] | None = None, stored: Column | None = None) -> DataFrame:
    """The rows of ``source`` to append: one per key, and only of keys the target lacks.

    Of several rows of a key the first by ``order`` is taken; without it the one with the
    smallest digest of its JSON text, which is the same in every run. ``stored`` is a condition
    that prunes the target's scan; it has to hold for every target row with a key of the source.
    """
    keys = list(keys)
    known = (target if stored is None else target.filter(stored)).select(*keys)
    rest = [c for c in source.columns if c not in keys]
    new = source.join(known, keys, "left_anti")
    if not rest:
        return new.distinct()
    rank = F.struct(*order) if order else F.sha2(F.to_json(F.struct(*rest)), 256)
    first = F.min_by(F.struct(*rest), rank).alias("v")
    return new.groupBy(*keys).agg(first).select(*[
        F.col(c) if c in keys else F.col(f"v.{c}").alias(c) for c in source.columns])


def upsert_newest(target: DataFrame, source: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Per key the row with the newest ``ts``; a stored row is replaced by a strictly newer
    one only."""
    keys = list(keys)
    columns = target.columns
    both = target.withColumn("_stored", F.lit(1)).unionByName(
        source.select(*columns).withColumn("_stored", F.lit(0)))
    rest = [c for c in columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(F.col(ts), F.col("_stored"))).alias("v")
    return both.groupBy(*keys).agg(newest).select(*[
        F.col(c) if c in keys else F.col(f"v.{c}").alias(c) for c in columns])


def increment(target: DataFrame, deltas: DataFrame, key: str | Sequence[str], column: str,
              replace_by: str | None = None) -> DataFrame:
    """``column`` plus the key's delta; keys without a delta stay, and deltas of unknown keys
    are ignored, as an UPDATE does. With ``replace_by`` the value of the row that is last by
    that column takes the place of the stored one."""
    keys = [key] if isinstance(key, str) else list(key)
    per_key = deltas.groupBy(*keys).agg(
        (F.max_by(column, replace_by) if replace_by else F.sum(column)).alias("_delta"))
    value = F.coalesce("_delta", column) if replace_by else F.col(column) + F.coalesce("_delta", F.lit(0))
    joined = target.join(per_key, keys, "left").withColumn(column, value)
    return joined.select(*target.columns)


def update_by_query(target: DataFrame, term: Mapping[str, object],
                    assign: Mapping[str, object] | None = None,
                    add: Mapping[str, int] | None = None) -> DataFrame:
    """Set or add to fields of the rows that match every term."""
    match = F.lit(True)
    for name, value in term.items():
        match = match & (F.col(name) == F.lit(value))
    match = F.coalesce(match, F.lit(False))

    def changed(name: str, value: Column) -> Column:
        return F.when(match, value).otherwise(F.col(name))

    changes = {n: changed(n, F.lit(v)) for n, v in (assign or {}).items()}
    changes.update({n: changed(n, F.col(n) + F.lit(v)) for n, v in (add or {}).items()})
    return target.withColumns(changes)


def find_by_term(df: DataFrame, **term: object) -> DataFrame:
    """Rows that match every term."""
    for name, value in term.items():
        df = df.filter(F.col(name) == F.lit(value))
    return df
