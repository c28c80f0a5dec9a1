"""Continuous jobs: what each micro-batch of block or trace lines writes.

Every job is the batch operators applied to one micro-batch and appended to
``TieredTable`` runs, so a stream over a log ends with the tables a batch run over
the same log makes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

from ledgerloom import constants as K
from ledgerloom.functions.hexnum import (
    block_columns, block_sums, collapse_blocks, is_positive, limb_columns, split_blocks,
)
from ledgerloom.operators import accounts, approvals, calls, decode, holders, refine, search, transfers
from ledgerloom.operators.contracts import with_contract_type
from ledgerloom.sources import lake
from ledgerloom.sources.logs import parse_blocks, parse_traces
from ledgerloom.streaming.tiers import FAN_OUT, Fold, TieredTable

Outputs = Mapping[str, DataFrame]


def block_outputs(raw: DataFrame, network: str = "mainnet") -> Outputs:
    """Refined blocks, transactions and event logs, and the newest block."""
    blocks = refine.refine_blocks(raw)
    return {
        "blocks": blocks,
        "transactions": refine.refine_transactions(raw, network),
        "event_logs": refine.refine_event_logs(raw),
        "latest": blocks.agg(F.max("number").alias("number"), F.max_by("timestamp", "number").alias("timestamp")),
    }


def trace_outputs(flat: DataFrame) -> Outputs:
    """Internal calls and their address index."""
    return {"internal_transactions": flat, "internal_transaction_index": calls.index_calls_by_address(flat)}


def account_outputs(raw: DataFrame, network: str = "mainnet",
                    naming: Callable[[DataFrame], DataFrame] | None = None) -> Outputs:
    """Partial accounts (add up with ``accounts.merge_accounts``), key and proxy updates.

    ``naming`` turns event logs into name changes (``names.resolve_names`` with its snapshots).
    """
    txs, logs = refine.refine_transactions(raw, network), refine.refine_event_logs(raw)
    return {
        "accounts": accounts.classify_accounts(txs, logs),
        "account_keys": refine.account_key_updates(txs),
        "implementations": refine.implementation_updates(logs.filter("transaction_status")),
        "consensus_nodes": accounts.consensus_nodes(refine.refine_blocks(raw)),
        "supply_changes": transfers.supply_change_contracts(logs.filter("transaction_status")),
        **({"names": naming(logs.filter("transaction_status"))} if naming else {}),
    }


# The approval tables of a transfer stream: how a batch is made, and the key that ``approvals.fold`` joins batches by.
APPROVALS = {
    "token_approvals": (approvals.latest_token_approvals, approvals.TOKEN_KEY),
    "nft_approvals": (approvals.latest_nft_approvals, approvals.NFT_KEY),
    "operator_approvals": (approvals.latest_operator_approvals, approvals.OPERATOR_KEY),
}


def transfer_outputs(logs: DataFrame, contracts: DataFrame) -> Outputs:
    """Transfers, burns, deposits, approvals and uri changes of a batch of event logs."""
    tokens = decode.token_transfers(logs)
    nfts = with_contract_type(decode.nft_transfers(logs), contracts)
    return {
        "token_transfers": tokens,
        "nft_transfers": nfts,
        "token_burns": transfers.burns(tokens),
        "nft_burns": transfers.burns(nfts),
        "transfer_counts": transfers.transfer_counts(logs),
        "deposits": transfers.deposit_withdraw_holders(logs, contracts),
        **{name: latest(logs, contracts, position=True) for name, (latest, _) in APPROVALS.items()},
        "uri_changes": transfers.uri_change_events(logs),
    }


def holder_outputs(token_transfers: DataFrame, nft_transfers: DataFrame) -> Outputs:
    """Net deltas of a batch of transfers; the zero and dead addresses hold nothing here."""
    both = token_transfers.select("contract_address", "from_address", "to_address", "timestamp",
                                  F.lit(True).alias("is_token")).unionByName(
        nft_transfers.select("contract_address", "from_address", "to_address", "timestamp",
                             F.lit(False).alias("is_token")))
    return {
        "token_deltas": holders.token_balance_deltas(token_transfers, K.ZERO_OR_DEAD),
        "nft_deltas": holders.nft_balance_deltas(nft_transfers, K.ZERO_OR_DEAD),
        "inventory_moves": holders.nft_inventory_moves(nft_transfers, K.ZERO_OR_DEAD),
        "account_contracts": transfers.account_contracts(both, typed=False, exclude=K.ZERO_ONLY),
    }


def search_outputs(raw: DataFrame, network: str = "mainnet") -> Outputs:
    """Search documents of the transactions."""
    return {"transaction_docs": search.to_search_docs_tx(refine.refine_transactions(raw, network))}


def decoded_blocks(lines: DataFrame, batch_id: int) -> DataFrame:
    return parse_blocks(lines)


def decoded_calls(lines: DataFrame, batch_id: int) -> DataFrame:
    return calls.flatten_calls(parse_traces(lines))


def fold_moves(moves: DataFrame) -> DataFrame:
    """Inventory moves of several batches as one: a token that came and went again has not moved."""
    net = F.sum(F.when(F.col("is_send"), -1).otherwise(1))
    return moves.groupBy(*holders.ITEM_KEY).agg(net.alias("net"), F.max("timestamp").alias("timestamp")).filter(
        "net <> 0").select(*holders.ITEM_KEY, (F.col("net") < 0).alias("is_send"), "timestamp")


#: The folder below the tables that holds a batch, prepared, for as long as its outputs are written.
HELD = "_batch"
#: The column whose range a table's runs keep, by the first of these that it has.
RANGE_KEYS = ("block_number", "number")


def output_table(path: str, name: str, columns: Iterable[str] = RANGE_KEYS, fan_out: int = FAN_OUT,
                 folds: Mapping[str, Fold] | None = None) -> TieredTable:
    """The table of one output of ``run_outputs``."""
    key = next((k for k in RANGE_KEYS if k in set(columns)), None)
    return TieredTable(f"{path}/{name}", key, fan_out, (folds or {}).get(name))


def run_outputs(stream: DataFrame, outputs: Callable[[DataFrame], Outputs], path: str, checkpoint: str,
                prepare: Callable[[DataFrame, int], DataFrame] | None = None, fan_out: int = FAN_OUT,
                folds: Mapping[str, Fold] | None = None) -> DataStreamWriter:
    """A stream writer that appends every output of ``outputs`` below ``path``, as a ``TieredTable``.

    ``prepare`` decodes a batch, or leaves out what came before; its result is written below ``path`` for the
    several outputs, so it is worked out once and no executor holds a batch, whatever its size. It is handed to the
    ``record`` of ``prepare`` where there is one; such a ``prepare`` reads the batch from its source more than once.
    Runs of ``fan_out`` batches merge, by ``folds`` where one is given. Batches run again overwrite what they wrote.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        prepared, folder = prepare(batch, batch_id) if prepare else batch, f"{path}/{HELD}"
        try:
            prepared.write.mode("overwrite").parquet(folder)
            kept = spark.read.schema(prepared.schema).parquet(folder)
            made = {name: (df, output_table(path, name, df.columns, fan_out, folds)) for name, df in outputs(kept).items()}
            for df, table in made.values():
                table.write(df, batch_id)
            if hasattr(prepare, "record"):
                prepare.record(kept, batch_id)
        finally:
            lake.drop_folder(spark, folder)
        for _, table in made.values():
            table.merge(spark, batch_id)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)


def holder_state(transfers_stream: DataFrame, exclude: tuple = K.ZERO_OR_DEAD) -> DataFrame:
    """Running balances as streaming state: in update mode every batch emits the holders it
    changed with their new totals (limb sums by block of digits; ``newest_holders`` reads them)."""
    split = split_blocks(transfers_stream, "amount", "amount")
    needed = [c for c in split.columns if c.startswith("amount__")]
    legs = transfers.explode_legs(split.select(
        "contract_address", "from_address", "to_address", "timestamp", "block_number", *needed))
    return block_sums(legs.filter(~F.col("holder_address").isin(*exclude)), holders.HOLDER_KEY, "amount",
                      F.max("timestamp").alias("timestamp"), F.max("block_number").alias("block_number"), sign="sign")[0]


def newest_holders(changes: DataFrame, batch: str = "batch_id") -> DataFrame:
    """The last totals of every holder from all that ``holder_state`` has emitted, marked with their batch."""
    block, blocks = block_columns("amount")
    state = ["timestamp", "block_number", blocks, *limb_columns("amount")]
    newest = changes.groupBy(*holders.HOLDER_KEY, block).agg(
        F.max_by(F.struct(*state), batch).alias("v")).select(*holders.HOLDER_KEY, block, "v.*")
    return collapse_blocks(newest, holders.HOLDER_KEY, "amount", ["timestamp", "block_number"])


# ---------------------------------------------------------------------------
# Late and repeated records


def late_floor(last_processed: int, start: int = 1, elapsed_seconds: float = 0.0,
               start_valid_seconds: float = K.LATE_START_SECONDS, max_before: int = K.LATE_BLOCKS) -> int:
    """The lowest block still accepted: the start block in the first hours of a run, later
    ``max_before`` blocks behind the newest one."""
    return last_processed - max_before if elapsed_seconds > start_valid_seconds else start


def cut_late(df: DataFrame, floor: int | Column, block: str = "block_number") -> DataFrame:
    return df.filter(F.col(block) >= floor)


def cut_late_by_time(stream: DataFrame, time: str, delay: str = "12 hours") -> DataFrame:
    """The event-time form: operators after this drop records later than the delay."""
    return stream.withWatermark(time, delay)


def suppress_replays(stream: DataFrame, keys: list[str], time: str, delay: str = "12 hours") -> DataFrame:
    """Records seen before within the delay are dropped."""
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


# ---------------------------------------------------------------------------
# Work queues


def enqueue(queue: DataFrame, keys: DataFrame, now: int) -> DataFrame:
    """Add keys with the current time; a key that waits already keeps its time."""
    columns = [c for c in queue.columns if c != "queued_at"]
    new = keys.select(*columns).distinct().withColumn("queued_at", F.lit(now).cast("bigint"))
    return queue.unionByName(new).groupBy(*columns).agg(F.min("queued_at").alias("queued_at"))


def due(queue: DataFrame, now: int, delay: int = 30, count: int = 100) -> DataFrame:
    """The keys that have waited long enough, oldest first, ``count`` at a time."""
    columns = [c for c in queue.columns if c != "queued_at"]
    return queue.filter(F.col("queued_at") <= now - delay).orderBy("queued_at", *columns).limit(count)


def dequeue(queue: DataFrame, done: DataFrame) -> DataFrame:
    columns = [c for c in queue.columns if c != "queued_at"]
    return queue.join(done.select(*columns), columns, "left_anti")


def correction_keys(moved: DataFrame) -> DataFrame:
    """Contract and holder pairs of transfers, to be checked after a while."""
    return moved.select(
        "contract_address", F.explode(F.array("from_address", "to_address")).alias("holder_address")
    ).filter(~F.col("holder_address").isin(*K.ZERO_OR_DEAD)).distinct()


def corrected(ready: DataFrame, stored: DataFrame, authoritative: DataFrame) -> Outputs:
    """Check the holders named by ``ready`` against authoritative balances (absent counts as 0).

    Gives the corrections, and the stored holders after them (none without a positive balance among
    the corrected).
    """
    keys = list(holders.HOLDER_KEY)
    corrections = holders.balance_diff(stored.join(ready.select(*keys), keys, "left_semi"), authoritative)
    joined = stored.join(corrections.select(*keys, "chain_amount"), keys, "left")
    after = joined.withColumn("amount", F.coalesce("chain_amount", "amount")).filter(
        F.col("chain_amount").isNull() | is_positive("amount")).select(*stored.columns)
    return {"corrections": corrections, "holders": after}


def recounted(ready: DataFrame, stored: DataFrame) -> DataFrame:
    """Holder counts of the contracts named by ``ready``; 0 where nothing is held."""
    counted = holders.token_holder_counts(stored.join(ready.select("contract_address"), "contract_address", "left_semi"))
    return ready.select("contract_address").join(counted, "contract_address", "left").withColumn(
        "holder_count", F.coalesce("holder_count", F.lit(0).cast("bigint")))


def correct_due(queue: DataFrame, now: int, stored: DataFrame, authoritative: DataFrame) -> Outputs:
    """``corrected`` for the queue's due holders, and the queue without the keys that were checked."""
    ready = due(queue, now)
    return {**corrected(ready, stored, authoritative), "queue": dequeue(queue, ready)}


def recount_due(queue: DataFrame, now: int, stored: DataFrame, delay: int = 300) -> Outputs:
    """Holder counts of the contracts that have waited ``delay`` seconds, and the queue without them."""
    ready = due(queue, now, delay)
    return {"holder_counts": recounted(ready, stored), "queue": dequeue(queue, ready)}
