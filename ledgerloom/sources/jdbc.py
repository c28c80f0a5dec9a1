"""Tables read from a database by range, and the dumps made of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, url: str, table: str, key: str | None = None, lower: int = 0,
               upper: int = 0, workers: int = 16, **options: str) -> DataFrame:
    """A table scan split into key ranges (needs the driver of the database)."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    if key is not None:
        reader = (
            reader.option("partitionColumn", key).option("lowerBound", str(lower))
            .option("upperBound", str(upper)).option("numPartitions", str(workers)))
    return reader.options(**options).load()


def key_range(df: DataFrame, key: str = "id") -> DataFrame:
    """Smallest and largest key: the bounds of a split scan."""
    return df.agg(F.min(key).alias("lower"), F.max(key).alias("upper"))


def with_account_prefix(df: DataFrame, digits: int = 3) -> DataFrame:
    return df.withColumn("account_prefix", F.substring("account_address", 1, digits))


def dump_account_contracts(df: DataFrame, path: str) -> None:
    """Account and contract pairs as Parquet by address prefix."""
    with_account_prefix(df.select("account_address", "contract_address", "transfer_type")).write.mode(
        "overwrite").partitionBy("account_prefix").parquet(path)


CONTRACT_COLUMNS = (
    "contract_address", "contract_type", "name", "symbol", "decimals", "implementation_address", "verified")


def contracts_since(contracts: DataFrame, since_id: int = 0) -> DataFrame:
    """Contracts added after an id, in dump form (the filter reaches the source)."""
    return contracts.filter(F.col("id") > since_id).select(
        *[c for c in CONTRACT_COLUMNS if c in contracts.columns])


def dump_contracts(contracts: DataFrame, path: str, since_id: int = 0) -> None:
    contracts_since(contracts, since_id).write.mode("overwrite").parquet(path)


def dump_signatures(events: DataFrame, functions: DataFrame, path: str) -> None:
    """Event and function signature tables as Parquet."""
    for df, name in ((functions, "function_signatures"), (events, "event_signatures")):
        df.write.mode("overwrite").parquet(f"{path}/label={name}")
