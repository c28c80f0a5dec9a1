"""A batch waits for its outputs in a folder, not in the executors' memory."""
import os

from ledgerloom.session import scratch_path
from ledgerloom.streaming import control, jobs
from ledgerloom.streaming.seen import SeenLogs

LOG = "block_number long, transaction_index int, log_index int"


def test_no_batch_is_held_in_memory(spark):
    path, found = scratch_path(spark, "held"), []
    spark.createDataFrame([(1, 0, 0), (1, 0, 0), (2, 0, 5), (3, None, 1)], LOG).write.parquet(f"{path}/input")

    def outputs(batch):
        cached = spark.sparkContext._jsc.getPersistentRDDs().size()
        found.append((batch.storageLevel.useMemory, cached, os.listdir(f"{path}/tables".removeprefix("file://"))))
        return {"logs": batch, "blocks": batch.select("block_number")}

    stream = spark.readStream.schema(LOG).parquet(f"{path}/input")
    control.run_to_end(jobs.run_outputs(stream, outputs, f"{path}/tables", f"{path}/checkpoint",
                                        prepare=SeenLogs(f"{path}/tables")), spark)
    (memory, cached, folders), = found
    assert not memory and cached == 0 and jobs.HELD in folders
    assert sorted(map(tuple, jobs.output_table(f"{path}/tables", "logs").read(spark).collect()), key=str) == [
        (1, 0, 0), (2, 0, 5), (3, None, 1)]
    assert jobs.HELD not in os.listdir(f"{path}/tables".removeprefix("file://"))
