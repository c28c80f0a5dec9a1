"""Raw logs: block and trace lines in files, and the segmented record stream."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ledgerloom import schemas
from ledgerloom.functions import dates, trace_text
from ledgerloom.functions.hexnum import hex_to_int
from ledgerloom.functions.scalars import block_partition


def _pick_bnp(df: DataFrame, bnp: int | tuple[int, int] | None) -> DataFrame:
    """Partition pruning; ``dup-`` partitions never match a number."""
    if bnp is None or "bnp" not in df.columns:
        return df
    lo, hi = bnp if isinstance(bnp, tuple) else (bnp, bnp)
    return df.filter(F.expr("try_cast(bnp as bigint)").between(lo, hi))


def _all_present(struct: Column, names: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [struct[n].isNotNull() for n in names])


def complete_blocks(raw: DataFrame) -> DataFrame:
    """Only blocks with every required field, also in their transactions and logs."""
    def whole_tx(tx: Column) -> Column:
        logs = F.forall(tx["logs"], lambda g: _all_present(g, schemas.REQUIRED_LOG_FIELDS))
        return _all_present(tx, schemas.REQUIRED_TRANSACTION_FIELDS) & logs

    r = F.col("result")
    return raw.filter(
        F.col("blockNumber").isNotNull() & _all_present(r, schemas.REQUIRED_BLOCK_FIELDS)
        & F.forall(r["transactions"], whole_tx))


def _decoded(lines: DataFrame, column: str, schema: str) -> DataFrame:
    """JSON lines as columns. Each line is parsed once: the checks that follow would
    otherwise be pushed below the parsing and repeat it for every field."""
    parsed = F.from_json(column, schema, {"mode": "PERMISSIVE"})
    return lines.select(F.inline(F.array(parsed)))


def parse_blocks(lines: DataFrame, column: str = "value") -> DataFrame:
    """Block lines in a text column; lines that do not decode are dropped."""
    return complete_blocks(_decoded(lines, column, schemas.BLOCK_LOG))


def parse_traces(lines: DataFrame, column: str = "value") -> DataFrame:
    """Trace lines in a text column, each top call kept as JSON text of any depth; lines that do not
    decode are dropped (``decode_counts`` tells how many)."""
    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [x for x in map(trace_text.split_line, batch.column(0).to_pylist()) if x is not None]
            yield pa.RecordBatch.from_arrays(
                [pa.array([n for n, _ in found], pa.int64()), pa.array([t for _, t in found], pa.list_(pa.string()))],
                ["blockNumber", "result"])

    return lines.select(F.col(column).cast("string")).mapInArrow(split, schemas.TRACE_LOG)


def decode_counts(lines: DataFrame, decoded: DataFrame) -> DataFrame:
    """One row: lines read, lines decoded, lines that did not decode."""
    counts = lines.agg(F.count("*").alias("lines")).crossJoin(decoded.agg(F.count("*").alias("decoded")))
    return counts.withColumn("undecoded", F.col("lines") - F.col("decoded"))


def read_block_log(spark: SparkSession, path: str, bnp: int | tuple[int, int] | None = None,
                   spread: int | None = None) -> DataFrame:
    """Block log files (JSON lines, gzip) below ``path``, optionally of some partitions only.

    A gzip file is read by one task. Where files are few and large, ``spread`` deals their lines
    into that many partitions before they are decoded.
    """
    return parse_blocks(_spread(_pick_bnp(spark.read.text(path), bnp), spread))


def read_trace_log(spark: SparkSession, path: str, bnp: int | tuple[int, int] | None = None,
                   spread: int | None = None) -> DataFrame:
    return parse_traces(_spread(_pick_bnp(spark.read.text(path), bnp), spread))


def _spread(lines: DataFrame, partitions: int | None) -> DataFrame:
    return lines if partitions is None else lines.repartition(partitions)


def read_log_lines(spark: SparkSession, path: str, bnp: int | tuple[int, int] | None = None) -> DataFrame:
    """The undecoded lines."""
    return _pick_bnp(spark.read.text(path), bnp)


def write_raw_log(df: DataFrame, path: str, mode: str = "append") -> None:
    """Log lines (``bnp``, ``value``) as gzip text by block partition.

    Lines of one partition meet in few tasks, which AQE splits or merges by size, instead of one
    small file per task and partition.
    """
    df.select("bnp", "value").hint("rebalance", "bnp").write.mode(mode).option("compression", "gzip").partitionBy("bnp").text(path)


def with_hour(lines: DataFrame) -> DataFrame:
    """Block lines with their partition and the UTC hour of their block; bad lines are dropped."""
    head = F.from_json("value", "blockNumber bigint, result struct<timestamp: string>")
    return lines.select("value", F.inline(F.array(head))).filter(
        "blockNumber is not null and result.timestamp is not null").select(
        block_partition("blockNumber").alias("bnp"),
        dates.date_hour(hex_to_int(F.col("result.timestamp"))).alias("dh"),
        "value")


def write_raw_log_hourly(lines: DataFrame, path: str, mode: str = "append") -> None:
    """Block lines as gzip text by block partition and UTC hour, spread as in ``write_raw_log``."""
    with_hour(lines).hint("rebalance", "bnp", "dh").write.mode(mode).option("compression", "gzip").partitionBy("bnp", "dh").text(path)


def rewrite_log(spark: SparkSession, source: str, target: str, files: int) -> None:
    """Copy log lines into another number of files."""
    spark.read.text(source).select("value").repartition(files).write.option(
        "compression", "gzip").text(target)


def kafka_options(servers: str, topics: str, mode: str = "resume", max_records: int | None = None,
                  fail_on_data_loss: bool = True) -> dict:
    """Reader options. With ``resume`` the checkpoint decides and a fresh query starts at
    the newest records. Records that are gone before they were read stop the query, unless
    ``fail_on_data_loss`` is off."""
    starts = {"resume": "latest", "latest": "latest", "earliest": "earliest"}
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topics,
        "startingOffsets": starts[mode],
        "includeHeaders": "true",
        "kafka.max.poll.records": "500",
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if max_records is not None:
        options["maxOffsetsPerTrigger"] = str(max_records)
    return options


def segments_of(records: DataFrame) -> DataFrame:
    """Kafka records (key, value, headers) as segments: headers hold 8-byte numbers."""
    # fixed values: the names of the two headers
    def header(name: str) -> Column:
        found = F.filter("headers", lambda h: h["key"] == name)
        digits = F.hex(F.element_at(found, -1)["value"])
        return F.conv(digits, 16, 10).cast("int")

    extra = [c for c in ("partition", "offset", "timestamp") if c in records.columns]
    return records.select(
        F.col("key").cast("string").cast("bigint").alias("block_number"),
        header("segmentIdx").alias("segment_index"),
        header("totalSegments").alias("total_segments"),
        F.col("value").cast("string").alias("piece"),
        *extra)


def read_block_stream(spark: SparkSession, servers: str, topics: str, mode: str = "resume",
                      max_records: int | None = None) -> DataFrame:
    """Segment stream from Kafka (needs the Kafka connector on the class path)."""
    reader = spark.readStream.format("kafka")
    return segments_of(reader.options(**kafka_options(servers, topics, mode, max_records)).load())


def last_offset_before(segments: DataFrame, block: int) -> DataFrame:
    """Per stream partition the last record below a block number."""
    before = segments.filter(F.col("block_number") < block)
    return before.groupBy("partition").agg(
        F.max_by("block_number", "offset").alias("block_number"), F.max("offset").alias("offset"))
