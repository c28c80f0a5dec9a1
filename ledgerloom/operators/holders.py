"""Holder balances and NFT inventories.

Deltas aggregate with map-side combine, so a contract or holder with a large
share of all transfers only shuffles one partial row per task. Merges are full
outer joins of two tables with one row per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerloom import constants as K
from ledgerloom.functions.hexnum import (
    add_hex, block_sums, collapse_blocks, collapse_limbs, computed_once, is_positive, is_zero, limb_columns, limb_sums, limbs_sign,
    negate_hex, split_blocks, split_limbs, to_hex64,
)
from ledgerloom.functions.scalars import block_partition
from ledgerloom.operators.transfers import explode_legs

HOLDER_KEY = ("contract_address", "holder_address")
ITEM_KEY = ("contract_address", "holder_address", "token_id")


def _outside(column: str, addresses: Sequence[str]) -> Column:
    return ~F.col(column).isin(*addresses)


def token_balance_deltas(transfers: DataFrame, exclude: Sequence[str] = K.ZERO_ONLY, within: Sequence[str] = ()) -> DataFrame:
    """Net amount per contract and holder with the newest time and block, apart for each value of the columns ``within``.

    The batch rebuild leaves out the zero address only; the continuous form also
    the dead address (``exclude=constants.ZERO_OR_DEAD``). Amounts are what was logged, of any length.
    """
    split = split_blocks(transfers, "amount", "amount")
    needed = [c for c in split.columns if c.startswith("amount__")]
    legs = explode_legs(split.select(
        "contract_address", "from_address", "to_address", "timestamp", "block_number", *within, *needed))
    return collapse_blocks(*block_sums(
        legs.filter(_outside("holder_address", exclude)), [*HOLDER_KEY, *within], "amount",
        F.max("timestamp").alias("timestamp"), F.max("block_number").alias("block_number"), sign="sign"))


def nft_balance_deltas(transfers: DataFrame, exclude: Sequence[str] = K.ZERO_ONLY,
                       collections: Sequence[int] = K.COLLECTION_TYPES,
                       multi_tokens: Sequence[int] = K.MULTI_TOKEN_TYPES) -> DataFrame:
    """Net token count per holder: per contract for collections (token id -1), per token
    for multi-token contracts. Other contract types have no NFT holders."""
    kept = transfers.filter(F.col("contract_type").isin(*collections, *multi_tokens))
    token = F.when(F.col("contract_type").isin(*collections), "-1").otherwise(F.col("token_id"))
    split = split_limbs(kept.withColumn("token_id", token), "count", "token_count").select(
        "contract_address", "contract_type", "token_id", "from_address", "to_address", "timestamp",
        "block_number", *[f"count__p{i}" for i in range(6)])
    legs = explode_legs(split).filter(_outside("holder_address", exclude))
    grouped = legs.groupBy("contract_address", "contract_type", "holder_address", "token_id").agg(
        *limb_sums("count", "sign"),
        F.max("timestamp").alias("timestamp"),
        F.max("block_number").alias("block_number"),
    )
    return collapse_limbs(grouped, "count").withColumnRenamed("count", "token_count")


def nft_inventory_moves(transfers: DataFrame, exclude: Sequence[str] = K.ZERO_ONLY,
                        collections: Sequence[int] = K.COLLECTION_TYPES) -> DataFrame:
    """Tokens that a holder gained (``is_send`` false) or lost in total.

    A token that came and went within one block leaves no trace, neither in the
    net count nor in the time. The legs are dealt by token once; the sums per block and the
    total both find their rows together there. Their tasks are as many as the session's shuffles have: by
    bytes AQE would join them, but what a task holds of its legs is some forty times as large as their exchange.
    """
    kept = transfers.filter(F.col("contract_type").isin(*collections))
    tasks = int(transfers.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = split_limbs(kept, "count", "token_count").select(
        "contract_address", "token_id", "from_address", "to_address", "timestamp", "block_number",
        *[f"count__p{i}" for i in range(6)])
    legs = explode_legs(split).filter(_outside("holder_address", exclude)).repartition(tasks, *ITEM_KEY)
    per_block = legs.groupBy(*ITEM_KEY, "block_number").agg(
        *limb_sums("count", "sign"), F.max("timestamp").alias("timestamp"))
    sums = limb_columns("count")
    total = per_block.filter(limbs_sign("count") != 0).groupBy(*ITEM_KEY).agg(
        *[F.sum(c).alias(c) for c in sums], F.max("timestamp").alias("timestamp"))
    net = total.select(*ITEM_KEY, limbs_sign("count").alias("net"), "timestamp")
    return net.filter("net <> 0").select(*ITEM_KEY, (F.col("net") < 0).alias("is_send"), "timestamp")


def holder_merge(current: DataFrame, deltas: DataFrame, balances: DataFrame | None = None,
                 keys: Sequence[str] = HOLDER_KEY, amount: str = "amount") -> DataFrame:
    """Apply net deltas to stored holdings; one row per key with the ``action`` taken.

    Known key: stored plus delta. A result that is not positive is replaced by the
    authoritative balance if one is given, and deleted if there is none or it is not
    positive either. New key: inserted if positive, else ignored.
    """
    keys = list(keys)
    delta, stored, proof = "_delta", "_stored", "_proof"
    new = deltas.select(*keys, F.col(amount).alias(delta), F.col("timestamp").alias("_ts"),
                        "block_number")
    if balances is not None:
        new = new.join(balances.select(*keys, F.col(amount).alias(proof)), keys, "left")
    else:
        new = new.withColumn(proof, F.lit(None).cast("string"))
    known = current.select(*keys, F.col(amount).alias(stored), F.col("timestamp").alias("_known_ts"))
    summed = add_hex(known.join(new, keys, "full_outer"), "_sum", stored, delta)
    matched = F.col(stored).isNotNull() & F.col(delta).isNotNull()
    settled = F.when(is_positive("_sum"), F.col("_sum")).otherwise(F.coalesce(to_hex64(proof), F.col("_sum")))
    summed = summed.withColumn("_settled", F.when(matched, settled).otherwise(F.col("_sum")))
    action = (
        F.when(F.col(delta).isNull(), "keep")
        .when(F.col(stored).isNull(), F.when(is_positive(delta), "insert").otherwise("ignore"))
        .when(is_positive("_settled"), "update")
        .otherwise("delete")
    )
    # What follows asks for some of the actions; none of it is to be worked out once for each asking.
    return computed_once(summed, [*keys, "_known_ts", "_ts", "block_number"], {
        amount: F.when(F.col(delta).isNull(), F.col(stored)).otherwise(F.col("_settled")), "action": action}).select(
        *keys, amount, F.greatest("_known_ts", "_ts").alias("timestamp"), "block_number", "action")


def nft_holder_merge(current: DataFrame, deltas: DataFrame, balances: DataFrame | None = None) -> DataFrame:
    """Collections: the deltas of one holder are added up first, whatever their token id."""
    staged = split_limbs(deltas, "total", "token_count", signed=True)
    summed = collapse_limbs(
        staged.groupBy(*HOLDER_KEY).agg(
            *limb_sums("total"), F.max("timestamp").alias("timestamp"),
            F.max("block_number").alias("block_number")), "total")
    return holder_merge(current, summed.withColumnRenamed("total", "token_count"), balances,
                        HOLDER_KEY, "token_count")


def multi_token_merge(current: DataFrame, deltas: DataFrame, balances: DataFrame | None = None) -> DataFrame:
    """Multi-token contracts: merge per contract, holder and token."""
    return holder_merge(current, deltas, balances, ITEM_KEY, "token_count")


def apply_merge(merged: DataFrame) -> DataFrame:
    """The holdings that remain after a merge."""
    return merged.filter(F.col("action").isin("keep", "insert", "update")).drop("action")


def holder_count_changes(merged: DataFrame) -> DataFrame:
    """Holders gained and lost per contract in a merge."""
    changed = merged.filter(F.col("action").isin("insert", "delete"))
    gained = F.count(F.when(F.col("action") == "insert", 1))
    lost = F.count(F.when(F.col("action") == "delete", 1))
    return changed.groupBy("contract_address").agg(
        gained.alias("gained"), lost.alias("lost"), (gained - lost).alias("change"))


def inventory_apply(current: DataFrame, moves: DataFrame) -> DataFrame:
    """Inventory after a batch of moves: new receipts are added, then sent tokens removed."""
    keys = list(ITEM_KEY)
    receipts = moves.filter(~F.col("is_send")).select(*keys, "timestamp").dropDuplicates(keys)
    sends = moves.filter(F.col("is_send")).select(*keys).distinct()
    added = receipts.join(current.select(*keys), keys, "left_anti")
    both = current.select(*keys, "timestamp").unionByName(added)
    return both.join(sends, keys, "left_anti")


def holder_counts(nft_holders: DataFrame, inventories: DataFrame) -> DataFrame:
    """Holders per contract; for multi-token contracts one per holder and token,
    without the zero address. A contract in both tables keeps the latter."""
    multi = inventories.filter(
        (F.col("contract_type") == K.TYPE_KIP37) & (F.col("holder_address") != K.ZERO_ADDRESS))
    both = nft_holders.select("contract_address", F.lit(0).alias("multi")).unionAll(
        multi.select("contract_address", F.lit(1).alias("multi")))
    counted = both.groupBy("contract_address").agg(
        F.count("*").alias("all"), F.sum("multi").alias("multi"))
    return counted.select(
        "contract_address",
        F.when(F.col("multi") > 0, F.col("multi")).otherwise(F.col("all")).alias("holder_count"))


def token_holder_counts(holders: DataFrame) -> DataFrame:
    """Rows per contract of a holder table."""
    return holders.groupBy("contract_address").agg(F.count("*").alias("holder_count"))


def balance_diff(stored: DataFrame, authoritative: DataFrame, keys: Sequence[str] = HOLDER_KEY,
                 amount: str = "amount") -> DataFrame:
    """Holdings that differ from the authoritative balance (absent counts as 0): the
    correction and the history entry in one row."""
    truth = authoritative.select(*keys, to_hex64(amount).alias("chain_amount"))
    zero = F.lit("0x" + "0" * 64)
    return (
        stored.select(*keys, to_hex64(amount).alias("db_amount"))
        .join(truth, list(keys), "left")
        .withColumn("chain_amount", F.coalesce("chain_amount", zero))
        .filter(F.col("db_amount") != F.col("chain_amount"))
    )


def txcount_diff(accounts: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Accounts whose stored transaction count differs from the snapshot's."""
    truth = snapshot.select("address", F.col("transactions").alias("chain_count"))
    return (
        accounts.select("address", F.col("transactions").alias("db_count"))
        .join(truth, "address")
        .filter(F.col("db_count") != F.col("chain_count"))
    )


def deposit_balance_fix(pairs: DataFrame, stored: DataFrame, authoritative: DataFrame,
                        blocks: DataFrame) -> DataFrame:
    """Listed (contract, holder, block) pairs with a wrong balance: insert with the block's
    time where nothing is stored, else update."""
    keys = list(HOLDER_KEY)
    zero = F.lit("0x" + "0" * 64)
    db = stored.select(*keys, to_hex64("amount").alias("db_amount"))
    chain = authoritative.select(*keys, to_hex64("amount").alias("chain_amount"))
    wrong = (
        pairs.select(*keys, "block_number").join(db, keys, "left").join(chain, keys, "inner")
        .withColumn("db_amount", F.coalesce("db_amount", zero))
        .filter(F.col("db_amount") != F.col("chain_amount"))
    )
    times = blocks.select(F.col("number").alias("block_number"), F.col("timestamp").alias("block_ts"))
    insert = is_zero("db_amount")
    return wrong.join(times, "block_number", "left").select(
        *keys, "db_amount", "chain_amount",
        F.when(insert, F.coalesce("block_ts", F.lit(0))).alias("timestamp"),
        F.when(insert, "insert").otherwise("update").alias("action"),
    )


def fix_nonpositive(holders: DataFrame, snapshot: DataFrame, keys: Sequence[str] = HOLDER_KEY,
                    amount: str = "amount") -> DataFrame:
    """Holdings stored as negative or zero: deleted if the snapshot has none, else replaced."""
    bad = holders.filter(~is_positive(amount)).select(*keys, F.col(amount).alias("db_amount"))
    truth = snapshot.select(*keys, to_hex64(amount).alias(amount))
    gone = F.col(amount).isNull() | is_zero(amount)
    return bad.join(truth, list(keys), "left").select(
        *keys, "db_amount", F.when(~gone, F.col(amount)).alias(amount),
        F.when(gone, "delete").otherwise("update").alias("action"))


def balance_at(requests: DataFrame, history: DataFrame, keys: Sequence[str] = HOLDER_KEY,
               value: str = "amount") -> DataFrame:
    """The value in force at a block: the newest history entry not after it, else null.

    An as-of join in two levels. Requests and history meet inside one block
    partition (bnp) of a key; what was in force at the start of that partition
    comes from a running pass over one row per key and bnp. No group holds more
    than one key's rows of 100,000 blocks.
    """
    keys = list(keys)
    asked = requests.select(*keys, F.col("block_number"), F.lit(None).cast("string").alias("_value"),
                            F.lit(1).alias("_asked"))
    known = history.select(*keys, F.col("block_number"), F.col(value).alias("_value"),
                           F.lit(0).alias("_asked"))
    bnp = block_partition("block_number").cast("bigint")
    rows = known.unionByName(asked).withColumn("_bnp", bnp)

    by_bnp = rows.groupBy(*keys, "_bnp").agg(
        F.max_by("_value", F.when(F.col("_asked") == 0, F.col("block_number"))).alias("_last"))
    carried = by_bnp.withColumn("_before", F.last("_last", ignorenulls=True).over(
        Window.partitionBy(*keys).orderBy("_bnp").rowsBetween(Window.unboundedPreceding, -1)))
    inside = F.last("_value", ignorenulls=True).over(
        Window.partitionBy(*keys, "_bnp").orderBy("block_number", "_asked")
        .rowsBetween(Window.unboundedPreceding, 0))
    answered = rows.withColumn("_inside", inside).filter(F.col("_asked") == 1)
    return answered.join(carried.select(*keys, "_bnp", "_before"), keys + ["_bnp"]).select(
        *keys, "block_number", F.coalesce("_inside", "_before").alias(value))


def negated(df: DataFrame, amount: str = "amount") -> DataFrame:
    """The rows with the sign of ``amount`` turned, e.g. to take a batch back out."""
    return df.withColumn(amount, negate_hex(amount))
