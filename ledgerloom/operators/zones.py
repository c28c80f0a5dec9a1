"""Summary rows of stored blocks, from which most questions about whole stretches are answered.

A zone is ``ZONE`` consecutive block numbers: one row with count, first and last block, sums, and 4 KB of bits that tell which
numbers are there. Zones are written next to the blocks whenever a stretch of them is (a zone belongs to the stretch that
holds its numbers, so a rewritten block partition rewrites its zones). Queries read the zones, a few thousand rows for a
chain of any length that has been seen, and go back to the blocks only for zones that a border cuts; their block numbers are a
plain range filter of the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StructType

from ledgerloom.functions import dates
from ledgerloom.functions.scalars import block_partition, div

#: Block numbers of a zone: the bits of one bitmap of Spark's bitmap functions.
ZONE = 32768
_FEE = "decimal(38,0)"


def zone_of(number: Column | str) -> Column:
    return div(F.col(number) if isinstance(number, str) else number, ZONE)


def burnt_fee() -> Column:
    """Half of a block's base fee times gas, as ``blocks.cumulative_burn`` counts it."""
    base = F.coalesce(F.col("base_fee_per_gas"), F.lit("0")).cast(_FEE)
    fee = (base * F.col("gas_used").cast("decimal(10,0)")).cast(_FEE)
    return F.floor(fee * F.lit("0.5").cast("decimal(2,1)")).cast(_FEE)


def summarise(blocks: DataFrame) -> DataFrame:
    """Zones of blocks (``number``, ``timestamp``, ``transaction_count``, ``base_fee_per_gas``, ``gas_used``).

    One shuffle, of one row per zone and task; ``rows`` counts blocks as stored, ``distinct`` their numbers, which differ
    where a block is stored twice. Blocks without a number are left out.
    """
    position = F.col("number") - F.col("zone") * ZONE + 1
    return blocks.filter("number is not null").withColumn("zone", zone_of("number")).groupBy("zone").agg(
        F.count("*").alias("rows"), F.min("number").alias("first"), F.max("number").alias("last"),
        F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts"),
        F.sum("transaction_count").cast("bigint").alias("transactions"), F.sum(burnt_fee()).cast(_FEE).alias("fees"),
        F.bitmap_construct_agg(F.bitmap_bit_position(position)).alias("bits"),
    ).withColumn("distinct", F.bitmap_count("bits"))


def write_zones(blocks: DataFrame, path: str) -> tuple[DataFrame, DataFrame]:
    """Blocks below ``path/blocks``, by block partition, and their zones below ``path/zones``; gives (zones, blocks) as written."""
    blocks.withColumn("bnp", block_partition("number")).hint("rebalance", "bnp").write.mode("overwrite").partitionBy(
        "bnp").parquet(f"{path}/blocks")
    stored = blocks.sparkSession.read.schema(blocks.schema).parquet(f"{path}/blocks")
    summarise(stored).coalesce(1).write.mode("overwrite").parquet(f"{path}/zones")
    return read_zones(blocks.sparkSession, path, blocks.schema)


def read_zones(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(zones, blocks) as ``write_zones`` wrote them; ``schema`` is that of the blocks."""
    return spark.read.parquet(f"{path}/zones"), spark.read.schema(schema).parquet(f"{path}/blocks")


def _absent(bits: Column, position: Column) -> Column:
    """Whether a bit of a bitmap, from 0, is not set."""
    byte = F.conv(F.hex(F.substring(bits, (div(position, 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), (position % 8).cast("int"))) == 0


def missing_numbers(zones: DataFrame, lo: int, hi: int) -> DataFrame:
    """Numbers between ``lo`` and ``hi`` (inclusive) that no block has: from the bits alone, blocks are not read.

    Numbers are generated for zones that lack some.
    """
    spark = zones.sparkSession
    wanted = spark.range(lo // ZONE, hi // ZONE + 1).select(F.col("id").alias("zone"))
    start, end = F.greatest(F.lit(lo), F.col("zone") * ZONE), F.least(F.lit(hi), (F.col("zone") + 1) * ZONE - 1)
    short = wanted.join(zones.select("zone", "distinct", "bits"), "zone", "left").filter(F.coalesce("distinct", F.lit(0)) < ZONE)
    numbers = short.select("zone", "bits", F.explode(F.sequence(start, end)).alias("number"))
    return numbers.filter(F.col("bits").isNull() | _absent(F.col("bits"), F.col("number") - F.col("zone") * ZONE)).select("number")


def gap_free_to(zones: DataFrame, last: int) -> DataFrame:
    """One row, ``number``: the last block after ``last`` before the first gap (``last`` itself if the next one is missing).

    Only the numbers of the zone behind ``last`` and of the first other one that is not full are looked at.
    """
    first = (last + 1) // ZONE
    behind = zones.filter(F.col("zone") >= first).select("zone", "distinct", "bits")
    low = F.greatest(F.col("zone") * ZONE, F.lit(last + 1))
    # of the first zone only a part may be asked for, so its bits are looked at even if others are missing
    full = (F.col("distinct") == ZONE) & (F.col("zone") > first)
    in_step = behind.withColumn("_step", F.row_number().over(Window.orderBy("zone")) - 1 + first)
    broken = in_step.filter((F.col("zone") != F.col("_step")) | ~full | (F.col("zone") == first))
    gaps = broken.filter(F.col("zone") == F.col("_step")).orderBy("zone").limit(2).select(
        "zone", "bits", F.explode(F.sequence(low, (F.col("zone") + 1) * ZONE - 1)).alias("number")).filter(
        _absent(F.col("bits"), F.col("number") - F.col("zone") * ZONE)).agg(F.min("number").alias("gap"))
    jumped = in_step.filter(F.col("zone") != F.col("_step")).agg(
        F.min(F.greatest(F.col("_step") * ZONE, F.lit(last + 1))).alias("jump"))
    ends = in_step.agg(F.max("zone").alias("top"), F.count("*").alias("n"))
    beyond = F.when(F.col("n") == 0, F.lit(last + 1)).otherwise((F.col("top") + 1) * ZONE)
    return gaps.crossJoin(jumped).crossJoin(ends).select(     # three rows of aggregates
        (F.least("gap", "jump", beyond) - 1).cast("bigint").alias("number"))


def gap_free(zones: DataFrame, blocks: DataFrame, last: int) -> DataFrame:
    """Blocks after ``last`` up to the first gap, as ``blocks.contiguous_prefix`` gives them: a range of the scan."""
    return blocks.filter((F.col("number") > last) & (F.col("number") <= gap_free_to(zones, last).scalar()))


def daily_transactions(zones: DataFrame, blocks: DataFrame) -> DataFrame:
    """Transactions per UTC day: sums of the zones that lie in one day, blocks of those that a midnight cuts."""
    day = lambda c: dates.format_utc(c, "yyyy-MM-dd")
    whole = F.col("last_ts").isNotNull() & (day("first_ts") == day("last_ts"))
    inside = zones.filter(whole).select(day("first_ts").alias("date"), "transactions")
    cut = blocks.withColumn("zone", zone_of("number")).join(
        F.broadcast(zones.filter(~F.coalesce(whole, F.lit(False))).select("zone")), "zone", "left_semi")
    return inside.unionByName(cut.select(day("timestamp").alias("date"), F.col("transaction_count").cast("bigint").alias(
        "transactions"))).groupBy("date").agg(F.sum("transactions").alias("transactions"))


def newest(zones: DataFrame, blocks: DataFrame, n: int) -> DataFrame:
    """One row about the newest ``n`` blocks: ``blocks``, ``transactions``, ``first_ts``, ``last_ts``.

    Whole zones from the newest on give their sums as long as they hold fewer than ``n``; of the one behind them the
    newest blocks are read. Numbers must be distinct.
    """
    held = F.sum("rows").over(Window.orderBy(F.desc("zone")).rowsBetween(Window.unboundedPreceding, 0))
    counted = zones.select("zone", "rows", "transactions", "first_ts", "last_ts").withColumn("_held", held)
    whole = counted.filter(F.col("_held") <= n).agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), F.sum("transactions").alias("transactions"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))
    border = counted.filter((F.col("_held") > n) & (F.col("_held") - F.col("rows") < n)).agg(
        F.max("zone").alias("zone"), F.max(n - F.col("_held") + F.col("rows")).alias("more"))
    rank = F.row_number().over(Window.partitionBy("_zone").orderBy(F.desc("number")))
    at = border.select("zone").scalar()
    cut = blocks.filter((F.col("number") >= at * ZONE) & (F.col("number") < (at + 1) * ZONE)).select(
        F.lit(0).alias("_zone"), "number", "timestamp", "transaction_count").withColumn("_rank", rank).filter(
        F.col("_rank") <= border.select("more").scalar()).select(
        F.lit(1).cast("bigint").alias("rows"), F.col("transaction_count").cast("bigint").alias("transactions"),
        F.col("timestamp").alias("first_ts"), F.col("timestamp").alias("last_ts"))
    return whole.unionByName(cut).agg(
        F.sum("rows").alias("blocks"), F.coalesce(F.sum("transactions"), F.lit(0)).alias("transactions"),
        F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


def running_burn(zones: DataFrame, blocks: DataFrame, lo: int, hi: int, seed: int = 0) -> DataFrame:
    """Burnt fees of the blocks [lo, hi] and their running total over all blocks, ``seed`` before the first.

    What came before a zone is a sum over zones; only blocks of the zones that the range meets are read.
    """
    sums = zones.select("zone", F.coalesce(F.sum("fees").over(
        Window.orderBy("zone").rowsBetween(Window.unboundedPreceding, -1)).cast(_FEE), F.lit(0).cast(_FEE)).alias("_before"))
    read = blocks.filter(F.col("number").between(lo // ZONE * ZONE, hi)).select(
        "number", "timestamp", burnt_fee().alias("fees"), zone_of("number").alias("zone"))
    inside = F.sum("fees").over(Window.partitionBy("zone").orderBy("number").rowsBetween(Window.unboundedPreceding, 0))
    return read.withColumn("_inside", inside.cast(_FEE)).filter(F.col("number") >= lo).join(
        F.broadcast(sums.filter(F.col("zone").between(lo // ZONE, hi // ZONE))), "zone").select(
        "number", "timestamp", "fees",
        (F.col("_before") + F.col("_inside") + F.lit(str(seed)).cast(_FEE)).cast(_FEE).alias("accumulate_fees"))
