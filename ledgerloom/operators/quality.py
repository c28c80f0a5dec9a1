"""Gaps, mismatches, lag and duplicate log lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom import constants as K
from ledgerloom.functions.scalars import block_partition, default_gas_price

_BUCKET = 32768          # bits of one bitmap of the bitmap functions


def missing_blocks(blocks: DataFrame, lo: int, hi: int) -> DataFrame:
    """Numbers between lo and hi (inclusive) that no block has.

    Bitmaps of 32768 numbers are built on the map side, so the shuffle carries 4 KB
    per bitmap. Only numbers of incomplete bitmaps are generated and compared.
    """
    spark = blocks.sparkSession
    number = F.col("number")
    inside = blocks.filter(number.between(lo, hi)).select(number.cast("bigint").alias("number"))
    # bitmap buckets start at 1 for the numbers 1..32768; shifting by one starts them at 0
    shifted = inside.select((F.col("number") + 1).alias("n"), "number")
    full = shifted.groupBy(F.bitmap_bucket_number("n").alias("bucket")).agg(
        F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position("n"))).alias("seen"))
    first, last = (lo // _BUCKET) + 1, (hi // _BUCKET) + 1
    buckets = spark.range(first, last + 1).select(F.col("id").alias("bucket"))
    start = F.greatest(F.lit(lo), (F.col("bucket") - 1) * _BUCKET)
    end = F.least(F.lit(hi), F.col("bucket") * _BUCKET - 1)
    short = buckets.join(full, "bucket", "left").withColumns({"start": start, "end": end}).filter(
        F.coalesce("seen", F.lit(0)) < F.col("end") - F.col("start") + 1)
    wanted = short.select(F.explode(F.sequence("start", "end")).alias("number"))
    # only blocks of incomplete bitmaps can matter: one row per bitmap decides that
    near = shifted.withColumn("bucket", F.bitmap_bucket_number("n")).join(
        short.select("bucket"), "bucket", "left_semi").select("number")
    return wanted.join(near, "number", "left_anti")


def of_blocks(rows: DataFrame, numbers: DataFrame, column: str, inside: bool = True) -> DataFrame:
    """Rows whose block is among the ``number`` column of a frame, or is not: a semi or anti join for rows as wide as raw blocks.

    The numbers go to every task as bitmaps, 4 KB per 32768 blocks of the chain, and the rows stay where they are.
    """
    found = numbers.filter(F.col("number").isNotNull()).select(F.col("number").cast("bigint").alias("number"))
    maps = found.groupBy(F.bitmap_bucket_number("number").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("_bits"))
    block = F.col(column).cast("bigint")
    place = F.bitmap_bit_position(block).cast("int")
    octet = F.conv(F.hex(F.substring("_bits", F.shiftright(place, 3) + 1, F.lit(1))), 16, 10).cast("int")
    bit = octet.bitwiseAND(F.call_function("shiftleft", F.lit(1), place.bitwiseAND(F.lit(7))))
    met = rows.withColumn("_bucket", F.bitmap_bucket_number(block)).join(
        F.broadcast(maps), "_bucket", "inner" if inside else "left")
    named = F.coalesce(bit, F.lit(0)) != 0
    return met.filter(named if inside else ~named).select(*rows.columns)


def recent_missing_blocks(blocks: DataFrame, recent: int, skip: int = 5) -> DataFrame:
    """Gaps among the newest blocks, leaving out the ``skip`` newest, which may still be
    out of order."""
    newest = blocks.select("number").orderBy(F.desc("number")).limit(recent)
    settled = newest.orderBy("number").limit(max(recent - skip, 0))
    span = settled.agg(F.min("number").alias("lo"), F.max("number").alias("hi"))
    wanted = span.filter("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("number"))
    return wanted.join(settled, "number", "left_anti")


def mismatched_blocks(blocks: DataFrame, transactions: DataFrame, lo: int | None = None,
                      hi: int | None = None) -> DataFrame:
    """Blocks whose stored transactions are not as many as their header says."""
    if lo is not None and hi is not None:
        blocks = blocks.filter(F.col("number").between(lo, hi))
        transactions = transactions.filter(F.col("block_number").between(lo, hi))
    counted = transactions.groupBy(F.col("block_number").alias("number")).agg(F.count("*").alias("stored"))
    return blocks.select("number", "transaction_count").join(counted, "number", "left").withColumn(
        "stored", F.coalesce("stored", F.lit(0))).filter(F.col("stored") != F.col("transaction_count"))


def set_difference(wanted: DataFrame, present: DataFrame, column: str = "number") -> DataFrame:
    """Distinct values of one frame that the other lacks."""
    return wanted.select(column).distinct().join(present.select(column), column, "left_anti")


def gas_price_exceptions(transactions: DataFrame, price: str | None = None,
                         network: str = "mainnet") -> DataFrame:
    """Transactions whose unit price is not the expected one (by default the schedule's)."""
    expected = F.lit(price) if price is not None else default_gas_price("block_number", network)
    return transactions.filter(F.col("gas_price") != expected)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, "Observation"]:
    """The frame with a row counter that can be read once an action on it has run."""
    from pyspark.sql import Observation

    observation = Observation(name)
    return df.observe(observation, F.count(F.lit(1)).alias("rows")), observation


def pipeline_lag(blocks: DataFrame, burns: DataFrame, transfers: DataFrame, watermark: int,
                 now: int, max_block_age: int = 10, max_burn_lag: int = 60,
                 max_transfer_age: int = 60) -> DataFrame:
    """One row of monitoring values and alerts; every input is reduced to one row first."""
    newest = blocks.orderBy(F.desc("number")).limit(10).agg(
        F.max("timestamp").alias("block_ts"), F.max("number").alias("block_number"))
    burnt = burns.agg(F.max("number").alias("burn_number"))
    moved = transfers.agg(
        F.max("id").alias("max_id"),
        F.coalesce(F.max(F.when(F.col("id") == watermark, F.col("timestamp"))), F.lit(0)).alias("watermark_ts"))
    return newest.crossJoin(burnt).crossJoin(moved).withColumns({
        "blocks_late": F.col("block_ts") < now - max_block_age,
        "burns_late": F.col("block_number") - F.col("burn_number") > max_burn_lag,
        "transfers_late": (F.lit(now) - F.col("watermark_ts") > max_transfer_age)
        & (F.lit(watermark) < F.col("max_id")),
    })


def dedup_log(lines: DataFrame, bnp: str) -> DataFrame:
    """Log lines (column ``value``) of one block partition without their copies.

    Per block: one variant is kept. Lines that differ in a ``time`` field only are
    one variant too. Of two variants the shortest line is kept. Three or more all go
    to partition ``dup-<bnp>`` without their time field. Lines of other partitions
    are dropped; lines that name no block pass through to partition 0.

    Variants are told apart by a digest of the line without its time field. Per block only
    their number and the least length are worked out, from rows without text; the lines then
    meet that small table once, and only shortest lines and doubtful ones go on.
    """
    # the number is what stands between the first colon and the first comma; anything
    # that is no whole number of 64 bits there makes the line one without a block
    head = F.regexp_extract("value", r'^\{"blockNumber":([+-]?[0-9]+)(?:,|$)', 1)
    staged = lines.select("value", head.try_cast("bigint").alias("block"))
    here = block_partition("block") == bnp
    unparsed = staged.filter(F.col("block").isNull() | ((F.col("block") < 0) & here)).select(
        F.lit("0").alias("bnp"), "value")

    stripped = F.regexp_replace("value", '"time":"[^"]*"', "")
    known = staged.filter((F.col("block") >= 0) & here).withColumns({
        "variant": F.unhex(F.sha2(stripped, 256)), "length": F.length("value")})
    variants = known.groupBy("block", "variant").agg(F.min("length").alias("shortest"))
    per_block = variants.groupBy("block").agg(F.count("*").alias("variants"), F.min("shortest").alias("shortest"))
    many = F.col("variants") > 2
    met = known.join(per_block, "block").filter(many | (F.col("length") == F.col("shortest")))
    kept = met.groupBy("block", F.when(many, F.col("variant")).alias("variant")).agg(
        F.min(F.when(many, stripped).otherwise(F.col("value"))).alias("value"))
    doubtful = F.col("variant").isNotNull()
    return kept.select(
        F.when(doubtful, f"dup-{bnp}").otherwise(bnp).alias("bnp"), "value").unionAll(unparsed)


def word_count(texts: DataFrame, column: str = "text") -> DataFrame:
    """Occurrences of every blank-separated word, line by line.

    Blanks at the end of a line make no words; between words they make empty ones.
    """
    lines = texts.select(F.explode(F.split(column, "\\r\\n|\\n|\\r")).alias("line"))
    trimmed = F.rtrim(F.col("line"))
    words = F.when((trimmed == "") & (F.col("line") != ""), F.array().cast("array<string>")).otherwise(
        F.split(trimmed, " "))
    return lines.select(F.explode(words).alias("word")).groupBy("word").agg(
        F.count("*").alias("occurrences"))
