"""Block statistics, daily history and cumulative burnt fees.

Running results over all blocks never use one ordered partition: they are worked
out inside each block partition (bnp) and joined to a running result over one row
per bnp.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ledgerloom import constants as K
from ledgerloom.functions import dates
from ledgerloom.functions.hexnum import canonical, decimal_to_hex64, hex_to_decimal_text
from ledgerloom.functions.scalars import block_partition, div

_FEE = "decimal(38,0)"


def block_date_map(blocks: DataFrame) -> DataFrame:
    """First and last block of every UTC day with their times."""
    return blocks.groupBy(dates.ymd("timestamp").cast("int").alias("ymd")).agg(
        F.min("number").alias("min_block_number"),
        F.min_by("timestamp", "number").alias("min_block_timestamp"),
        F.max("number").alias("max_block_number"),
        F.max_by("timestamp", "number").alias("max_block_timestamp"),
    )


def bnps_for_dates(date_map: DataFrame, first: int | str, last: int | str) -> DataFrame:
    """Block partitions of the first and the last block of every day in the range."""
    return date_map.filter(F.col("ymd").between(int(first), int(last))).select(
        F.explode(F.array(block_partition("min_block_number"), block_partition("max_block_number")))
        .alias("bnp")).distinct()


def recent(df: DataFrame, n: int, by: str = "number") -> DataFrame:
    """The newest n rows (a top-n, not a full sort)."""
    return df.orderBy(F.desc(by)).limit(n)


def page_after(df: DataFrame, last_id: int, n: int, by: str = "id") -> DataFrame:
    """The next n rows after a key, in key order."""
    return df.filter(F.col(by) > last_id).orderBy(by).limit(n)


def id_window(df: DataFrame, last_id: int, size: int, by: str = "id") -> DataFrame:
    """Rows whose key lies in the window (last_id, last_id + size]."""
    return df.filter((F.col(by) > last_id) & (F.col(by) <= last_id + size))


def avg_block_time(blocks: DataFrame, n: int, divisor: int = 86400) -> DataFrame:
    """Time span of the newest n blocks over ``divisor``, one decimal, as text."""
    span = recent(blocks.select("number", "timestamp"), n).agg(
        (F.max("timestamp") - F.min("timestamp")).alias("span"))
    return span.select(F.format_string(
        "%.1f", F.coalesce(F.col("span") / F.lit(float(divisor)), F.lit(0.0))).alias("avg_block_time"))


def avg_tx_per_block(blocks: DataFrame, n: int) -> DataFrame:
    """Transactions of the newest n blocks over n, five decimals."""
    total = recent(blocks.select("number", "transaction_count"), n).agg(
        F.coalesce(F.sum("transaction_count"), F.lit(0)).alias("total"))
    return total.select(F.round(F.col("total") / F.lit(float(n)), 5).alias("avg_tx_per_block"))


def last_block_timestamp(blocks: DataFrame, n: int = 5) -> DataFrame:
    return recent(blocks.select("number", "timestamp"), n).agg(
        F.coalesce(F.max("timestamp"), F.lit(0)).alias("timestamp"))


def max_block(blocks: DataFrame) -> DataFrame:
    return blocks.agg(F.coalesce(F.max("number"), F.lit(0)).alias("number"))


def latest_block(blocks: DataFrame) -> DataFrame:
    """Number and time (ms) of the newest block."""
    return blocks.agg(
        F.max("number").alias("number"),
        (F.max_by("timestamp", "number").cast("bigint") * 1000).alias("timestamp_ms"))


def min_transfer_block(transfers: DataFrame) -> DataFrame:
    return transfers.agg(F.min("block_number").alias("block_number"))


def daily_tx_history(blocks: DataFrame, days: int | None = None) -> DataFrame:
    """Transactions per UTC day, optionally of the newest ``days`` days only."""
    per_day = blocks.groupBy(dates.format_utc("timestamp", "yyyy-MM-dd").alias("date")).agg(
        F.sum("transaction_count").alias("transactions"))
    return per_day if days is None else recent(per_day, days, by="date")


def daily_burn_history(burns: DataFrame, days: int | None = None) -> DataFrame:
    """Growth of (cumulative fees + burnt balance) from the first to the last block of a day."""
    total = F.col("accumulate_fees").cast(_FEE) + F.col("accumulate_balance").cast(_FEE)
    per_day = burns.groupBy(dates.format_utc("timestamp", "yyyy-MM-dd").alias("date")).agg(
        F.max_by(total, "number").alias("last"), F.min_by(total, "number").alias("first"))
    grown = per_day.select("date", (F.col("last") - F.col("first")).cast(_FEE).alias("burnt"))
    return grown if days is None else recent(grown, days, by="date")


def day_windows(blocks: DataFrame) -> DataFrame:
    """[from, to) epoch bounds of every calendar day between the first and last block."""
    span = blocks.agg(dates.start_of("day", F.min("timestamp")).alias("lo"),
                      dates.start_of("day", F.max("timestamp")).alias("hi"))
    return span.select(F.explode(F.sequence("lo", "hi", F.lit(86400).cast("bigint"))).alias("from_ts")).select(
        dates.format_utc("from_ts", "yyyy-MM-dd").alias("date"),
        "from_ts", (F.col("from_ts") + 86400).alias("to_ts"))


def contiguous_prefix(blocks: DataFrame, last: int) -> DataFrame:
    """Blocks after ``last`` up to the first gap.

    One small row per bnp decides which partitions are complete; only the first
    incomplete one is looked into.
    """
    after = blocks.filter(F.col("number") > last).withColumn("_bnp", div(F.col("number"), K.BLOCKS_PER_PARTITION))
    size = F.lit(K.BLOCKS_PER_PARTITION)
    start = F.greatest(F.col("_bnp") * size, F.lit(last + 1))
    numbers = after.select("_bnp", "number")
    # distinct numbers per bnp by bitmaps, which combine on the map side
    position = F.col("number") - F.col("_bnp") * size + 1
    bits = numbers.groupBy("_bnp", F.bitmap_bucket_number(position).alias("_bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(position))).alias("_count"),
        F.max("number").alias("_max"))
    stats = bits.groupBy("_bnp").agg(F.sum("_count").alias("_count"), F.max("_max").alias("_max"))
    stats = stats.withColumn("_expected", (F.col("_bnp") + 1) * size - start)
    first_bnp = (last + 1) // K.BLOCKS_PER_PARTITION
    order = Window.orderBy("_bnp")
    # Partitions are consecutive from the first one and all before this one are full.
    ranked = stats.withColumns({
        "_gapless": F.col("_bnp") - F.row_number().over(order) + 1 == first_bnp,
        "_open_before": F.coalesce(F.sum((F.col("_count") < F.col("_expected")).cast("int")).over(
            order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
    }).filter(F.col("_gapless") & (F.col("_open_before") == 0))
    full = F.col("_count") == F.col("_expected")

    rank = F.dense_rank().over(Window.partitionBy("_bnp").orderBy("number"))
    # the first incomplete partition at most; without the hint Spark may take the blocks for the smaller side
    partial = numbers.join(F.broadcast(ranked.filter(~full).select("_bnp")), "_bnp").withColumn(
        "_gap", F.col("number") - rank + 1 != start)
    limit = ranked.agg(F.max(F.when(full, F.col("_max"))).alias("_full_to"))
    reach = partial.filter(~F.col("_gap")).agg(F.max("number").alias("_partial_to"))
    bound = limit.crossJoin(reach).select(   # two one-row frames
        F.coalesce(F.greatest("_full_to", "_partial_to"), F.lit(last)).alias("_to"))
    # one value, worked out once however often the prefix is read, and a plain filter of the scan
    return after.drop("_bnp").filter(F.col("number") <= bound.scalar())


def _running_fees(fees: DataFrame, seed: int, balance: int) -> DataFrame:
    """``number, timestamp, fees`` with the running total from ``seed``."""
    rows = fees.withColumn("_bnp", div(F.col("number"), K.BLOCKS_PER_PARTITION))
    per_bnp = rows.groupBy("_bnp").agg(F.sum("fees").cast(_FEE).alias("_fees"))
    before = per_bnp.select("_bnp", F.coalesce(
        F.sum("_fees").over(Window.orderBy("_bnp").rowsBetween(Window.unboundedPreceding, -1)).cast(_FEE),
        F.lit(0).cast(_FEE)).alias("_before"))
    inside = F.sum("fees").over(
        Window.partitionBy("_bnp").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)).cast(_FEE)
    # one row per bnp
    return rows.withColumn("_inside", inside).join(F.broadcast(before), "_bnp").select(
        "number", "fees",
        (F.col("_before") + F.col("_inside") + F.lit(str(seed)).cast(_FEE)).cast(_FEE).alias("accumulate_fees"),
        F.lit(str(balance)).cast(_FEE).alias("accumulate_balance"),
        "timestamp")


def cumulative_burn(blocks: DataFrame, last: int = -1, seed: int = 0, balance: int = 0) -> DataFrame:
    """Half of each block's base fee times gas, and its running total.

    Only blocks that follow ``last`` without a gap count.
    """
    base = F.coalesce(F.col("base_fee_per_gas"), F.lit("0")).cast(_FEE)
    fee = (base * F.col("gas_used").cast("decimal(10,0)")).cast(_FEE)
    half = F.floor(fee * F.lit("0.5").cast("decimal(2,1)")).cast(_FEE)
    fees = contiguous_prefix(blocks.select("number", "timestamp", "base_fee_per_gas", "gas_used"), last)
    return _running_fees(fees.select("number", "timestamp", half.alias("fees")), seed, balance)


def cumulative_burn_from_rewards(blocks: DataFrame, rewards: DataFrame, last: int = -1,
                                 seed: int = 0, balance: int = 0) -> DataFrame:
    """As ``cumulative_burn`` with the burnt fee of the reward row; a block without one ends it."""
    burnt = rewards.select("number", hex_to_decimal_text("burnt_fee").cast(_FEE).alias("fees"))
    # Both sides have a row per block: neither is ever sent whole to every task, whatever size Spark guesses.
    both = blocks.select("number", "timestamp").hint("merge").join(burnt, "number")
    return _running_fees(contiguous_prefix(both, last), seed, balance)


def burns_as_hex(burns: DataFrame) -> DataFrame:
    """Burn rows in stored form, amounts as 64 hex digits."""
    names = ("fees", "accumulate_fees", "accumulate_balance")
    return burns.withColumns({n: decimal_to_hex64(n) for n in names})


def block_rewards(rewards: DataFrame) -> DataFrame:
    """Reward rows in stored form: hex amounts padded, the payout map as JSON."""
    amounts = ("minted", "total_fee", "burnt_fee", "proposer", "stakers", "fund_a", "fund_b")
    changes = {n: canonical(n) for n in amounts if n in rewards.columns}
    changes["rewards"] = F.to_json(F.transform_values("rewards", lambda k, v: canonical(v)))
    return rewards.withColumns(changes)
