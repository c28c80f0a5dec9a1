"""Scheduled jobs: operators put together over block partitions and calendar days."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerloom import constants as K
from ledgerloom.functions import dates
from ledgerloom.functions.hexnum import sum_hex
from ledgerloom.functions.scalars import div
from ledgerloom.operators import (
    accounts, approvals, blocks as block_ops, calls, contracts, decode, holders, quality, refine, transfers,
)
from ledgerloom.operators.contracts import with_contract_type
from ledgerloom.operators.merges import insert_ignore
from ledgerloom.session import scratch_path
from ledgerloom.sources import delimited, lake, logs as log_source, manifested


def refine_range(spark: SparkSession, source: str, target: str, lo: int, hi: int,
                 network: str = "mainnet") -> None:
    """Refine the block and trace logs of partitions lo to hi anew, replacing what was there.

    The blocks are decoded once, into the shared folder, and each table takes its columns from
    there; when all are written that copy goes. Old partitions go only after the new ones are written.
    """
    folder = scratch_path(spark, "refine")
    try:
        log_source.read_block_log(spark, f"{source}/topic=block", (lo, hi)).write.option("compression", "zstd").parquet(folder)
        raw = spark.read.parquet(folder)
        traces = log_source.read_trace_log(spark, f"{source}/topic=trace", (lo, hi))
        for table, label in (
                (refine.refine_blocks(raw), lake.BLOCKS),
                (refine.refine_transactions(raw, network).drop(*lake.COUNTS), lake.TRANSACTIONS),
                (refine.refine_event_logs(raw), lake.LOGS), (calls.flatten_calls(traces), lake.CALLS)):
            lake.replace_partitions(table, f"{target}/{label}", range(lo, hi + 1))
    finally:
        lake.drop_folder(spark, folder)


def due_periods(day: str) -> list[tuple[str, str, str]]:
    """What is to run on a day (yyyyMMdd): daily, and on Mondays and firsts the period before."""
    periods = [("daily", day, day)]
    week, month = dates.previous_week(day), dates.previous_month(day)
    if week:
        periods.append(("weekly", *week))
    if month:
        periods.append(("monthly", *month))
    return periods


def run_calendar(date_map: DataFrame, days: Sequence[str],
                 run: Callable[[str, str, str, DataFrame], None]) -> None:
    """Call ``run(kind, first, last, bnps)`` for every period due on each of the days."""
    for day in days:
        for kind, first, last in due_periods(day):
            run(kind, first, last, block_ops.bnps_for_dates(date_map, first, last))


def restore_missing(blocks: DataFrame, transactions: DataFrame, logs: DataFrame, source: DataFrame,
                    lo: int, hi: int, network: str = "mainnet") -> dict[str, DataFrame]:
    """Rows to append so that blocks lo to hi are whole again.

    Blocks that are missing, or whose transactions are not as many as their header says,
    are taken from ``source`` (raw blocks); rows already stored are left out.
    """
    gaps = quality.missing_blocks(blocks, lo, hi).select("number")
    short = quality.mismatched_blocks(blocks, transactions, lo, hi).select("number")
    raw = quality.of_blocks(source, gaps.unionAll(short), "blockNumber")
    new_blocks = refine.refine_blocks(raw)
    new_txs = refine.refine_transactions(raw, network)
    new_logs = refine.refine_event_logs(raw)
    log_key = ["transaction_hash", "log_index"]
    return {
        "blocks": insert_ignore(blocks, new_blocks, ["number"]),
        "transactions": insert_ignore(transactions, new_txs, ["transaction_hash"]),
        "event_logs": insert_ignore(logs, new_logs, log_key),
    }


def approve_burn_range(logs: DataFrame, contract_types: DataFrame, lo: int, hi: int) -> dict[str, DataFrame]:
    """Approvals and burns of the blocks lo to hi, whether the logs come from the raw log or
    from a table."""
    inside = logs.filter(F.col("block_number").between(lo, hi))
    tokens = decode.token_transfers(inside)
    nfts = with_contract_type(decode.nft_transfers(inside), contract_types)
    return {
        "token_approvals": approvals.latest_token_approvals(inside, contract_types),
        "nft_approvals": approvals.latest_nft_approvals(inside, contract_types),
        "operator_approvals": approvals.latest_operator_approvals(inside, contract_types),
        "token_burns": transfers.burns(tokens),
        "nft_burns": transfers.burns(nfts),
    }


def make_accounts(transactions: DataFrame, logs: DataFrame, code: DataFrame | None = None) -> dict[str, DataFrame]:
    """Accounts and contracts of a range in bulk form: classified, split, typed, formatted.

    ``code`` gives byte code per contract; without it the creating input is used, whose
    constructor carries the code of the contract.
    """
    classified = accounts.classify_accounts(transactions, logs)
    eoa, sca = accounts.split_accounts(classified)
    if code is None:
        code = sca.select(F.col("address").alias("contract_address"), F.col("creator.input").alias("bytecode"))
    types = contracts.contract_types(code)
    rows = accounts.sca_rows(sca, types)
    return {
        "eoa": accounts.eoa_rows(eoa),
        "sca": rows,
        "contracts": rows.select(
            F.col("address").alias("contract_address"), "contract_type",
            F.lit(None).cast("string").alias("name"), F.lit(None).cast("string").alias("symbol"),
            F.lit(0).alias("decimals"), F.lit("0").alias("total_supply")),
    }


def write_accounts(made: dict[str, DataFrame], path: str) -> dict[str, DataFrame]:
    """The bulk files of ``make_accounts`` with their manifests, as the writing tasks report them."""
    return {
        name: manifested.export_manifested(df, f"{path}/{name}", delimited.ROWS_PER_FILE["call_index"])
        for name, df in made.items()
    }


def windows(rows: DataFrame, last: int, size: int, by: str = "id") -> Iterator[tuple[int, int, DataFrame]]:
    """(last id before, last id of, rows of) every window of ``size`` ids after ``last`` that holds rows.

    The next window begins at the next id there is, so gaps of any width cost one look at the
    ids; after each window its end is what a later run goes on from.
    """
    while True:
        following = rows.filter(F.col(by) > last).agg(F.min(by)).first()[0]
        if following is None:
            return
        start, last = following - 1, following - 1 + size
        yield start, last, block_ops.id_window(rows, start, size, by)


#: Windows that one job of ``rebuild_holders`` and ``catch_up_account_contracts`` works out.
WINDOWS_AT_ONCE = 1024


def window_starts(ids: DataFrame, last: int, size: int, most: int, by: str) -> list[int]:
    """The first ids of the next ``most`` windows of ``windows``, told by the lowest and highest id of each stretch of ``size``.

    A look at the ids themselves is needed only where a window ends inside of a stretch, and then at that stretch alone.
    """
    id_ = F.col(by)
    cell = div(id_ - F.pmod(id_, F.lit(size)), size)
    # A window reaches into two stretches at most.
    cells = ids.filter(id_ > last).groupBy(cell.alias("cell")).agg(
        F.min(by).alias("low"), F.max(by).alias("high")).orderBy("cell").limit(2 * most).collect()
    starts: list[int] = []
    for c in cells:
        if c.high <= last or len(starts) == most:
            continue
        first = c.low if c.low > last else ids.filter((id_ > last) & (id_ <= c.high)).agg(F.min(by)).first()[0]
        starts.append(first)
        last = first - 1 + size
    return starts


def numbered_windows(rows: DataFrame, starts: Sequence[int], size: int, by: str) -> DataFrame:
    """The rows of the windows of ``size`` ids that begin at ``starts``, with the number of their ``window``."""
    cells: dict[int, tuple[int | None, int]] = {}
    for k, start in enumerate(starts):
        cells[start // size] = (start, k)
        cells[start // size + 1] = (None, k)
    small = rows.sparkSession.createDataFrame(
        [(cell, *found) for cell, found in cells.items()], "_cell bigint, _border bigint, _k bigint")
    id_ = F.col(by)
    inside = rows.filter(id_.between(starts[0], starts[-1] - 1 + size))
    here = inside.withColumn("_cell", div(id_ - F.pmod(id_, F.lit(size)), size).cast("bigint"))
    before = F.coalesce(id_ < F.col("_border"), F.lit(False))
    return here.join(F.broadcast(small), "_cell").withColumn(
        "window", F.when(before, F.col("_k") - 1).otherwise(F.col("_k"))).drop("_cell", "_border", "_k")


def catch_up_account_contracts(transfers_table: DataFrame, stored: DataFrame, last: int, size: int, folder: str,
                               by: str = "block_number", at_once: int = WINDOWS_AT_ONCE) -> tuple[DataFrame, int]:
    """``stored`` account contracts after all transfers behind ``last``, window by window, and the last id done.

    ``at_once`` windows are worked out by one job, each apart, and followed in their order (``transfers.follow_windows``). The
    table after them is written below ``folder``, from where the next ones take it. So are the ids behind ``last``, which
    tell where windows begin.
    """
    spark = stored.sparkSession
    transfers_table.filter(F.col(by) > last).select(by).distinct().sort(by).write.mode("overwrite").parquet(f"{folder}/ids")
    ids = spark.read.parquet(f"{folder}/ids")
    while starts := window_starts(ids, last, size, at_once, by):
        last = starts[-1] - 1 + size
        pairs = transfers.account_contracts(
            numbered_windows(transfers_table, starts, size, by), typed=False, exclude=K.ZERO_ONLY, within=("window",))
        transfers.merge_account_contracts(stored, transfers.follow_windows(pairs)).write.mode("overwrite").parquet(f"{folder}/{last}")
        stored = spark.read.parquet(f"{folder}/{last}")
    return stored, last


def holder_from_table(token_transfers: DataFrame, lo: int, hi: int, size: int | None = None) -> DataFrame:
    """Balance deltas of stored transfers of the blocks [lo, hi), with ``size`` apart for each ``window`` of as many blocks."""
    inside = token_transfers.filter((F.col("block_number") >= lo) & (F.col("block_number") < hi))
    if size is None:
        return holders.token_balance_deltas(inside, K.ZERO_ONLY)
    window = div(F.col("block_number") - lo, size).alias("window")
    return holders.token_balance_deltas(inside.select("*", window), K.ZERO_ONLY, ["window"])


def rebuild_holders(token_transfers: DataFrame, last: int, size: int, folder: str, at_once: int = WINDOWS_AT_ONCE) -> DataFrame:
    """Balance deltas of all stored transfers behind block ``last``, window by window of ``size`` blocks.

    The deltas of ``at_once`` windows are worked out by one job, as a job for each would take longer to start than to run,
    and written below ``folder``, one part a window, before the next ones are looked at: windows that fail are the only ones
    to run again. Their sums are exact whatever their length.
    """
    spark = token_transfers.sparkSession
    done = []
    for start, end, _ in windows(token_transfers, last, size * at_once, "block_number"):
        path = f"{folder}/{end:020d}"
        holder_from_table(token_transfers, start + 1, end + 1, size).hint("rebalance", "window").write.mode(
            "overwrite").partitionBy("window").parquet(path)
        done.append(spark.read.parquet(path).drop("window"))
    deltas = reduce(DataFrame.unionByName, done) if done else holder_from_table(token_transfers.limit(0), 0, 0)
    return sum_hex(deltas, list(holders.HOLDER_KEY), "amount", "amount", F.max("timestamp").alias("timestamp"),
                   F.max("block_number").alias("block_number"), signed=True)
