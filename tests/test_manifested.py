import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.session import scratch_path
from ledgerloom.sources import delimited
from ledgerloom.sources.manifested import export_manifested, manifest_of


def _found(path):
    return {os.path.join(path, f): (sum(1 for _ in open(os.path.join(path, f))), os.path.getsize(os.path.join(path, f)))
            for f in os.listdir(path) if f.startswith("part-") and not f.endswith(".crc")}


def _told(df):
    return {r["path"]: (r["lines"], r["bytes"]) for r in df.collect()}


def test_the_manifest_is_what_lies_there(spark):
    path = scratch_path(spark, "manifested")
    rows = spark.range(1000).select("id", F.when(F.col("id") % 3 > 0, F.concat(F.lit("tä"), "id")).alias("text"))
    told = _told(export_manifested(rows.repartition(3), path, 70))
    assert told == _found(path) and max(n for n, _ in told.values()) == 70 and sum(n for n, _ in told.values()) == 1000
    loaded = delimited.load_delimited(spark, path, "id bigint, text string")
    assert loaded.exceptAll(rows).isEmpty() and loaded.count() == 1000
    more = _told(export_manifested(rows, path, 400, mode="append"))
    assert more == _found(path) == _told(manifest_of(spark, path)) and sum(n for n, _ in more.values()) == 2000
    again = _told(export_manifested(rows.limit(10), path, 400))
    assert again == _found(path) and sum(n for n, _ in again.values()) == 10
    assert not [f for f in os.listdir(path) if f.startswith("_writing")]


def test_an_empty_table(spark):
    path = scratch_path(spark, "manifested")
    assert _told(export_manifested(spark.range(0), path, 5)) == {} == _found(path)


def test_a_failed_export_leaves_what_was_there(spark):
    path = scratch_path(spark, "manifested")
    before = _told(export_manifested(spark.range(20), path, 5))
    bad = spark.range(100).repartition(4).select(F.when(F.col("id") == 77, F.raise_error(F.lit("no"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="no"):
        export_manifested(bad, path, 5)
    assert _told(manifest_of(spark, path)) == before == _found(path)
    assert not [f for f in os.listdir(path) if f.startswith("_writing")]
