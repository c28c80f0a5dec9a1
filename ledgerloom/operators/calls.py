"""Call traces: recursive calls to flat rows, address index and shard checks."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ledgerloom.functions import trace_text
from ledgerloom.functions.hexnum import computed_once, hex_body, hex_to_decimal_text, hex_to_int, hex_to_long
from ledgerloom.functions.scalars import block_partition, div, hex_mod

_FLAT = "block_number bigint, index int, call_id int, parent_call_id int, fields string"
# Own fields of a call; the inner calls have been taken out of the text.
_FIELDS = (
    "type string, `from` string, `to` string, value string, gas string, gasUsed string, input string, "
    "output string, time string, error string, reverted struct<contract: string, message: string>"
)


def flatten_calls(traces: DataFrame) -> DataFrame:
    """One row per call. The top call has id 0 and no parent; the others are numbered from
    1 in depth-first order. ``time`` and ``reverted`` are kept on the top call only.

    A trace is cut into flat calls inside its task by one scan of its text: no shuffle, any
    depth, and work in step with the text. ``traces`` has ``blockNumber`` and ``result``, an
    array of JSON texts; a text that is no JSON object gives no rows.
    """
    def flatten(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for number, index, text in zip(*(c.to_pylist() for c in batch.columns)):
                found = trace_text.flat_calls(text) if text is not None else None
                rows += [(number, index, k, parent, flat) for k, (parent, flat) in enumerate(found or ())]
                if len(rows) >= _ROWS:
                    yield _flat_batch(rows)
                    rows = []
            if rows:
                yield _flat_batch(rows)

    tops = traces.select(
        F.col("blockNumber").alias("block_number"), F.posexplode("result").alias("index", "text"))
    rows = computed_once(
        tops.mapInArrow(flatten, _FLAT), ["block_number", "index", "call_id", "parent_call_id"],
        {"n": F.from_json("fields", _FIELDS)})

    def text(name: str) -> Column:
        return F.col(f"n.{name}")

    top = F.col("call_id") == 0
    return rows.select(
        block_partition("block_number").alias("bnp"),
        "block_number", "index", "call_id", "parent_call_id",
        text("type").alias("type"),
        text("from").alias("from_address"),
        text("to").alias("to_address"),
        hex_to_decimal_text(text("value")).alias("value"),
        hex_to_long(text("gas")).alias("gas"),
        hex_to_int(text("gasUsed")).alias("gas_used"),
        text("input").alias("input"),
        text("output").alias("output"),
        F.when(top, text("time")).alias("time"),
        text("error").alias("error"),
        F.when(top, text("reverted")).alias("reverted"),
    )


_ROWS = 20_000


def _flat_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.string())
    names = [part.split()[0] for part in _FLAT.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def index_calls_by_address(calls: DataFrame) -> DataFrame:
    """(address, call) pairs: the sender, and the receiver if it is another address."""
    internal_id = F.concat_ws("_", "block_number", "index", "call_id").alias("internal_tx_id")
    sides = F.when(
        (F.col("from_address") != F.col("to_address")) & (F.length("to_address") > 2),
        F.array("from_address", "to_address")).otherwise(F.array("from_address"))
    return calls.filter(F.length("from_address") > 2).select(
        internal_id, F.explode(sides).alias("account_address"),
        "block_number", F.col("index").alias("transaction_index"), "call_id")


def _shard(address: Column, suffix: int) -> Column:
    """Last ``suffix`` hex digits (0: all after the prefix) modulo 10; -1 if they are no number."""
    digits = F.substring(address, -suffix, suffix) if suffix else hex_body(address)
    width = suffix or 40
    valid = digits.rlike("^[0-9a-fA-F]+$")
    return F.when(valid, hex_mod(digits, width, 10)).otherwise(-1)


def _parties(calls: DataFrame) -> DataFrame:
    return calls.select(F.explode(F.array("from_address", "to_address")).alias("address")).filter(
        F.length("address") > 0)


def _keyed(parties: DataFrame, suffixes: tuple) -> DataFrame:
    keys = F.array(*[
        F.concat(_shard(F.col("address"), s).cast("string"), F.lit(f"_{s}")) for s in suffixes])
    return parties.select("address", F.explode(keys).alias("shard"))


def shard_histogram(calls: DataFrame) -> DataFrame:
    """Call parties per shard, for sharding by the last 2 and the last 3 digits."""
    return _keyed(_parties(calls), (2, 3)).groupBy("shard").agg(F.count("*").alias("rows"))


def shard_distinct(calls: DataFrame) -> DataFrame:
    """Distinct addresses per shard, for the last 2 and 3 digits and the whole address.

    Addresses are made distinct once, before they fan out to their shards.
    """
    return _keyed(_parties(calls).distinct(), (2, 3, 0)).groupBy("shard").agg(
        F.count("*").alias("addresses"))


def relayout_calls(calls: DataFrame) -> dict[str, DataFrame]:
    """The three layouts of the call lake, without calls that have no sender: by thousand
    blocks, by the tail of the sender and by the tail of the receiver."""
    kept = calls.filter("from_address is not null")
    return {
        "re_bnp": kept.withColumn("bnp", div(F.col("block_number"), 1000)),
        "re_fp": kept.drop("bnp").withColumn("fp", F.substring("from_address", 39, 3)),
        "re_tp": kept.drop("bnp").withColumn("tp", F.substring("to_address", 39, 3)),
    }
