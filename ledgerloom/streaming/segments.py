"""Segmented records back to whole lines, in streams and in batches.

A long line arrives as pieces with their index and total. Pieces of one block may
come in any order, twice, or in different micro-batches.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import BooleanType, IntegerType, StringType, StructField, StructType

OUTPUT = "block_number BIGINT, value STRING, complete BOOLEAN, missing ARRAY<INT>"


class _Reassembler(StatefulProcessor):
    """Keeps the pieces of one line until all are there or the time is over.

    The state of a key is the pieces of one line, so its size is that of the line. Of a finished line a mark stays as
    long as its pieces would have, so that a piece that comes once more begins nothing.
    """

    def __init__(self, ttl_seconds: int) -> None:
        self.ttl_ms = ttl_seconds * 1000

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pieces = handle.getMapState(
            "pieces",
            StructType([StructField("segment_index", IntegerType())]),
            StructType([StructField("piece", StringType())]))
        self.finished = handle.getValueState("finished", StructType([StructField("done", BooleanType())]))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        block, total = key
        if self.finished.exists():
            return
        had_pieces = self.pieces.exists()
        for frame in rows:
            for index, piece in zip(frame["segment_index"], frame["piece"]):
                self.pieces.updateValue((int(index),), (piece,))
        found = {k[0]: v[0] for k, v in self.pieces.iterator()}
        if len(found) == total:
            self._clear()
            self.finished.update((True,))
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)
            yield self._row(block, "".join(found[i] for i in sorted(found)), [])
        elif not had_pieces:
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.ttl_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        block, total = key
        found = {k[0] for k, _ in self.pieces.iterator()}
        self._clear()
        if found:
            yield self._row(block, None, [i for i in range(total) if i not in found])

    def _clear(self) -> None:
        self.pieces.clear()
        self.finished.clear()
        for timer in list(self.handle.listTimers()):
            self.handle.deleteTimer(timer)

    @staticmethod
    def _row(block, value, missing) -> pd.DataFrame:
        return pd.DataFrame({
            "block_number": [block], "value": [value], "complete": [value is not None], "missing": [missing]})

    def close(self) -> None:
        pass


def reassemble_segments(stream: DataFrame, ttl_seconds: int = 1200) -> DataFrame:
    """Whole lines of a segment stream; lines still incomplete after ``ttl_seconds`` come out
    once with ``complete`` false and the indexes they miss.

    Lines of one piece, nearly all of them, never touch the state. The query needs the RocksDB state store
    (``control.run_to_end`` and ``control.with_state_store`` set it for the query alone).
    """
    single = stream.filter(F.col("total_segments") == 1).select(
        "block_number", F.col("piece").alias("value"), F.lit(True).alias("complete"),
        F.array().cast("array<int>").alias("missing"))
    parts = stream.filter(F.col("total_segments") > 1).select(
        "block_number", "total_segments", "segment_index", "piece")
    joined = parts.groupBy("block_number", "total_segments").transformWithStateInPandas(
        statefulProcessor=_Reassembler(ttl_seconds), outputStructType=OUTPUT,
        outputMode="Append", timeMode="ProcessingTime")
    return single.unionByName(joined)


def reassemble_batch(segments: DataFrame) -> DataFrame:
    """The same for a finished set of segments, complete and incomplete lines alike."""
    one_each = segments.groupBy("block_number", "total_segments", "segment_index").agg(
        F.max("piece").alias("piece"))
    grouped = one_each.groupBy("block_number", "total_segments").agg(
        F.array_sort(F.collect_list(F.struct("segment_index", "piece"))).alias("parts"))
    complete = F.size("parts") == F.col("total_segments")
    wanted = F.sequence(F.lit(0), F.col("total_segments") - 1)
    return grouped.select(
        "block_number",
        F.when(complete, F.array_join(F.transform("parts", lambda p: p["piece"]), "")).alias("value"),
        complete.alias("complete"),
        F.array_except(wanted, F.transform("parts", lambda p: p["segment_index"])).alias("missing"))


def split_segments(lines: DataFrame, size: int) -> DataFrame:
    """Lines (``block_number``, ``value``) cut into pieces of ``size`` characters."""
    count = F.greatest(F.lit(1), F.ceil(F.length("value") / size).cast("int"))
    pieces = lines.select(
        "block_number", "value", count.alias("total_segments"),
        F.explode(F.sequence(F.lit(0), count - 1)).alias("segment_index"))
    return pieces.select(
        "block_number", "segment_index", "total_segments",
        F.substring("value", F.col("segment_index") * size + 1, F.lit(size)).alias("piece"))
