"""Parquet layouts of the refined tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom import constants as K
from ledgerloom.functions import dates
from ledgerloom.functions.hexnum import any_hex_to_decimal_text, hex_to_decimal_text
from ledgerloom.functions.scalars import block_partition
from ledgerloom.operators.calls import relayout_calls
from ledgerloom.operators.decode import nft_transfers, token_transfers

BLOCKS = "label=blocks"
TRANSACTIONS = "label=transaction_receipts"
LOGS = "label=event_logs"
CALLS = "label=internal_transactions"
TOKEN_TRANSFERS = "label=token_transfers_dt"
NFT_TRANSFERS = "label=nft_transfers_dt"
COUNTS = ("token_transfer_count", "nft_transfer_count")


def _dated(df: DataFrame) -> DataFrame:
    return df.withColumns({
        "year": dates.year("timestamp"), "month": dates.month("timestamp"), "day": dates.day("timestamp")})


def _write(df: DataFrame, path: str, by: list[str], mode: str) -> None:
    """Rows of one output partition meet in few tasks instead of one file per task and
    partition; the rebalance lets AQE split large partitions and merge small ones."""
    df.hint("rebalance", *by).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(
        *by).parquet(path)


def write_refined_by_bnp(blocks: DataFrame, transactions: DataFrame, logs: DataFrame, path: str,
                         mode: str = "append") -> None:
    """The three refined tables by block partition, transactions without their counts."""
    _write(blocks, f"{path}/{BLOCKS}", ["bnp"], mode)
    _write(transactions.drop(*COUNTS), f"{path}/{TRANSACTIONS}", ["bnp"], mode)
    _write(logs, f"{path}/{LOGS}", ["bnp"], mode)


def write_refined_by_date(blocks: DataFrame, transactions: DataFrame, logs: DataFrame, path: str,
                          mode: str = "append") -> None:
    """The three refined tables by UTC year, month and day."""
    by = ["year", "month", "day"]
    _write(_dated(blocks), f"{path}/{BLOCKS}_dt", by, mode)
    _write(_dated(transactions.drop(*COUNTS)), f"{path}/{TRANSACTIONS}_dt", by, mode)
    _write(_dated(logs), f"{path}/{LOGS}_dt", by, mode)


def transfers_for_lake(logs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Token and NFT transfers with their amounts as decimal text and their date columns."""
    tokens = token_transfers(logs).withColumn("amount_bigint", any_hex_to_decimal_text("amount"))
    nfts = nft_transfers(logs).drop("item_index").withColumn(
        "token_count_bigint", hex_to_decimal_text("token_count"))
    return _dated(tokens), _dated(nfts)


def write_transfers_by_date(logs: DataFrame, path: str, mode: str = "append") -> None:
    by = ["year", "month", "day"]
    tokens, nfts = transfers_for_lake(logs)
    _write(tokens, f"{path}/{TOKEN_TRANSFERS}", by, mode)
    _write(nfts, f"{path}/{NFT_TRANSFERS}", by, mode)


def write_internal_tx(calls: DataFrame, path: str, mode: str = "append") -> None:
    _write(calls, f"{path}/{CALLS}", ["bnp"], mode)


def relayout_internal_tx(calls: DataFrame, path: str, mode: str = "append") -> None:
    """Calls in three layouts, from one pass over the input."""
    kept = calls.persist()
    try:
        for suffix, layout in relayout_calls(kept).items():
            key = {"re_bnp": "bnp", "re_fp": "fp", "re_tp": "tp"}[suffix]
            _write(layout, f"{path}/{CALLS}_{suffix}", [key], mode)
    finally:
        kept.unpersist()


def write_transfers_tsv(logs: DataFrame, path: str, mode: str = "append") -> None:
    """Token and NFT transfers as tab-separated files by block partition."""
    bnp = block_partition("block_number").alias("bnp")
    tokens = token_transfers(logs).select(
        "contract_address", "from_address", "to_address", "amount", "timestamp", "block_number",
        "transaction_hash", "display_order", bnp)
    nfts = nft_transfers(logs).select(
        "contract_address", "from_address", "to_address", "token_count", "token_id", "timestamp",
        "block_number", "transaction_hash", "display_order", bnp)
    for df, name in ((tokens, "token_transfers"), (nfts, "nft_transfers")):
        df.hint("rebalance", "bnp").write.mode(mode).option("sep", "\t").partitionBy(
            "bnp").csv(f"{path}/{name}")


def replace_range(df: DataFrame, path: str, lo: int, hi: int, block: str = "block_number") -> None:
    """Replace the block partitions of [lo, hi) by the rows of ``df`` in that range.

    Partitions are whole units here: the range has to start and end on a bnp border.
    A partition without new rows is emptied as well. New rows are written before anything is
    removed: a failure leaves either the old rows or all new ones, and a repeat mends it.
    """
    if lo % K.BLOCKS_PER_PARTITION or hi % K.BLOCKS_PER_PARTITION:
        raise ValueError("the range must start and end on a partition border")
    inside = df.filter((F.col(block) >= lo) & (F.col(block) < hi)).withColumn("bnp", block_partition(block))
    replace_partitions(inside, path, range(lo // K.BLOCKS_PER_PARTITION, hi // K.BLOCKS_PER_PARTITION))


def replace_partitions(df: DataFrame, path: str, partitions: range) -> None:
    """Overwrite the bnp partitions that ``df`` has rows of, then remove those of ``partitions`` it has none of."""
    _write(df, path, ["bnp"], "overwrite")
    # one row per partition of the range
    filled = {str(r.bnp) for r in df.select("bnp").distinct().collect()}
    drop_partitions(df.sparkSession, path, "bnp", [str(b) for b in partitions if str(b) not in filled])


def drop_partitions(spark: SparkSession, path: str, column: str, values: list[str]) -> None:
    """Remove partition folders through the Hadoop file system of the path."""
    for value in values:
        drop_folder(spark, f"{path}/{column}={value}")


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(folder):
        fs.delete(folder, True)


def replay_event_logs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Event-log Parquet back to events, token transfers and NFT transfers."""
    logs = spark.read.parquet(path)
    return logs, token_transfers(logs), nft_transfers(logs)


def create_table_ddl(spark: SparkSession, path: str, table: str, partitioned_by: str | None = None) -> str:
    """A CREATE TABLE statement for Parquet files; ``partitioned_by`` is like ``bnp int``."""
    schema = spark.read.parquet(path).schema
    parts = [p.strip() for p in (partitioned_by or "").split(",") if p.strip()]
    names = {p.split()[0] for p in parts}
    columns = [f"    `{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in names]
    columns += [f"    `{p.split()[0]}` {p.split(None, 1)[1]}" for p in parts]
    partition = f"PARTITIONED BY ({', '.join(p.split()[0] for p in parts)})\n" if parts else ""
    body = ",\n".join(columns)
    return f"CREATE TABLE {table} (\n{body})\nUSING parquet\n{partition}LOCATION '{path}'"
