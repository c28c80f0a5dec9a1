"""The driver's tables in ledger shape.

An order is a block and each of its line items is a transaction with one event:
a transfer of the part's contract from the supplier to the customer. The part key
decides the contract type and so the event layout. Events become approvals,
conversations become call traces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerloom import constants as K
from ledgerloom.functions.hexnum import computed_once, hex_to_decimal_text
from ledgerloom.functions.scalars import display_order
from ledgerloom.streaming.segments import split_segments


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def hexed(value: Column, width: int) -> Column:
    return F.lpad(F.lower(F.hex(value.cast("bigint"))), width, "0")


def address(number: Column) -> Column:
    """Accounts: 0 is the zero address, 1 the dead one, 2 the third burn address."""
    return (
        F.when(number == 1, K.DEAD_ADDRESS).when(number == 2, K.THIRD_BURN_ADDRESS)
        .otherwise(F.concat(F.lit("0x"), hexed(number, 40))))


def contract(number: Column) -> Column:
    return F.concat(F.lit("0xc"), hexed(number, 39))


def epoch(ts: Column) -> Column:
    return F.unix_timestamp(ts.cast("timestamp")).cast("int")


def contract_type(part: Column) -> Column:
    return F.when(part % 7 == 6, K.TYPE_CUSTOM).otherwise((part % 7).cast("int"))


def contracts(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    key = F.col("p_partkey")
    return p.select(
        key.alias("id"),
        contract(key).alias("contract_address"),
        contract_type(key).alias("contract_type"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("symbol"),
        (F.col("p_size") % 19).alias("decimals"),
        F.round(F.col("p_retailprice") * 100).cast("bigint").cast("string").alias("total_supply"),
        (F.col("p_type") == "ECONOMY").alias("verified"),
        F.lit(None).cast("string").alias("implementation_address"),
    )


#: Line items that one task of ``lines`` takes at most, and those that make another task while there are fewer tasks than cores.
LINES_PER_TASK, FEWEST_LINES = 250_000, 25_000


def lines(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with their order's customer and time.

    Spread by order before the join: that is the exchange a join of two large tables
    needs anyway, and a small file of one row group would be a single task without it. What follows makes several times as
    wide rows of them, so tasks are told by rows and not, as they would be, by the bytes of the exchange.
    """
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", epoch(F.col("o_orderdate")).alias("timestamp"))
    items = table(spark, folder, "lineitem")
    count = items.count()
    tasks = max(2, -(-count // LINES_PER_TASK), min(spark.sparkContext.defaultParallelism, -(-count // FEWEST_LINES)))
    return items.repartition(tasks, "l_orderkey").join(orders, "l_orderkey")


#: Where a line item's columns are read: ``F.col``, or the fields of a struct in a list.
At = Callable[[str], Column]


def _amount_digits(extra: int = 0, at: At = F.col) -> Column:
    """Quantity times 2**80 plus the line number, as 64 digits."""
    low = hexed(at("l_linenumber") + extra, 20)
    return F.lpad(F.concat(F.lower(F.hex(at("l_quantity").cast("bigint"))), low), 64, "0")


def _token_digits(extra: int = 0, at: At = F.col) -> Column:
    """2**100 plus a number below 1000, as 64 digits."""
    k = (at("l_orderkey") * 7 + at("l_linenumber")) % 1000 + extra
    return F.lpad(F.concat(F.lit("1"), hexed(k, 25)), 64, "0")


def transaction_hash(at: At = F.col) -> Column:
    return F.concat(F.lit("0x"), hexed(at("l_orderkey") * 8 + at("l_linenumber"), 64))


def transfers(spark: SparkSession, folder: str) -> DataFrame:
    """Every line item as a plain transfer, without the event encoding."""
    return lines(spark, folder).select(
        contract(F.col("l_partkey")).alias("contract_address"),
        contract_type(F.col("l_partkey")).alias("contract_type"),
        address(F.col("l_suppkey")).alias("from_address"),
        address(F.col("o_custkey")).alias("to_address"),
        F.concat(F.lit("0x"), _amount_digits()).alias("amount"),
        "timestamp",
        F.col("l_orderkey").alias("block_number"),
        F.col("l_linenumber").alias("transaction_index"),
        transaction_hash().alias("transaction_hash"),
        display_order("l_orderkey", "l_linenumber", "l_partkey").alias("display_order"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("line_status"),
    )


def nft_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items of NFT contracts as plain transfers of one token each."""
    kinds = K.COLLECTION_TYPES + K.MULTI_TOKEN_TYPES
    one = F.lit("0x" + "1".rjust(64, "0"))
    multi = contract_type(F.col("l_partkey")).isin(*K.MULTI_TOKEN_TYPES)
    return lines(spark, folder).filter(contract_type(F.col("l_partkey")).isin(*kinds)).select(
        contract(F.col("l_partkey")).alias("contract_address"),
        contract_type(F.col("l_partkey")).alias("contract_type"),
        address(F.col("l_suppkey")).alias("from_address"),
        address(F.col("o_custkey")).alias("to_address"),
        F.when(multi, F.concat(F.lit("0x"), _amount_digits())).otherwise(one).alias("token_count"),
        hex_to_decimal_text(F.concat(F.lit("0x"), _token_digits())).alias("token_id"),
        "timestamp", F.col("l_orderkey").alias("block_number"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_returnflag").alias("flag"),
    )


def _topic(value: Column) -> Column:
    return F.concat(F.lit("0x" + "0" * 24), F.substring(value, 3, 40))


def _word(value: Column) -> Column:
    return F.concat(F.lit("0" * 24), F.substring(value, 3, 40))


def _num_word(n: int) -> Column:
    return F.lit(format(n, "064x"))


def _event(at: At) -> tuple[Column, Column]:
    """Topics and data of a line item's event; next to its columns ``at`` knows f, t, kind, amt, amt2, id and id2."""
    flag, status, kind = at("l_returnflag"), at("l_linestatus"), at("kind")
    ft, tt = _topic(at("f")), _topic(at("t"))
    token = kind.isin(K.TYPE_ERC20, K.TYPE_KIP7, K.TYPE_CUSTOM)
    nft = kind.isin(*K.COLLECTION_TYPES)
    topics = (
        F.when(token, F.array(F.lit(K.TOPIC_TRANSFER), ft, tt))
        .when(nft & (flag == "R"), F.array(
            F.lit(K.TOPIC_LEGACY_NFT_TRANSFER), ft, tt, F.concat(F.lit("0x"), at("id"))))
        .when(nft, F.array(F.lit(K.TOPIC_TRANSFER), ft, tt, F.concat(F.lit("0x"), at("id"))))
        .when(flag == "A", F.array(F.lit(K.TOPIC_TRANSFER_SINGLE), ft, ft, tt))
        .when(flag == "N", F.array(F.lit(K.TOPIC_TRANSFER_BATCH), ft, ft, tt))
        .when(status == "F", F.array(F.lit(K.TOPIC_TRANSFER_SINGLE)))
        .otherwise(F.array(F.lit(K.TOPIC_TRANSFER_BATCH))))
    head = F.lit("0x")
    parties = [_word(at("f")), _word(at("f")), _word(at("t"))]
    two = _num_word(2)
    arrays = [two, at("id"), at("id2"), two, at("amt"), at("amt2")]
    data = (
        F.when(token, F.concat(head, at("amt")))
        .when(nft, head)
        .when(flag == "A", F.concat(head, at("id"), at("amt")))
        .when(flag == "N", F.concat(head, _num_word(64), _num_word(160), *arrays))
        .when(status == "F", F.concat(head, *parties, at("id"), at("amt")))
        .otherwise(F.concat(head, *parties, _num_word(160), _num_word(256), *arrays)))
    return topics, data


def _event_parts(at: At) -> dict[str, Column]:
    return {"f": address(at("l_suppkey")), "t": address(at("o_custkey")), "kind": contract_type(at("l_partkey")),
            "amt": _amount_digits(0, at), "amt2": _amount_digits(1, at), "id": _token_digits(0, at), "id2": _token_digits(1, at)}


def alone_in_place(items: DataFrame) -> DataFrame:
    """Line items whose event shares its place in the chain with no other and lacks no part of it.

    Counted over rows as narrow as they are stored, which ``lines`` has dealt by block: nothing is dealt out again.
    """
    place = ["l_orderkey", "l_linenumber", F.col("l_partkey").cast("int")]
    whole = F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull() & F.col("l_partkey").isNotNull()
    return items.filter(whole).withColumn("_shared", F.count("*").over(Window.partitionBy(*place))).filter("_shared = 1").drop("_shared")


def event_logs(spark: SparkSession, folder: str, alone: bool = False) -> DataFrame:
    """Line items as encoded transfer events, in all layouts; with ``alone`` those that share their place with no other."""
    items = lines(spark, folder)
    src = (alone_in_place(items) if alone else items).withColumns(_event_parts(F.col))
    topics, data = _event(F.col)
    status = F.col("l_linestatus")
    # the encoding is worked out once per row, as if read from a file
    return computed_once(src, list(LINE), {"topics": topics, "data": data}).select(
        F.concat(F.lit("0x"), hexed(F.col("l_orderkey"), 64)).alias("block_hash"),
        F.col("l_orderkey").alias("block_number"),
        transaction_hash().alias("transaction_hash"),
        F.col("l_linenumber").alias("transaction_index"),
        (status == "F").alias("transaction_status"),
        contract(F.col("l_partkey")).alias("address"),
        "topics", "data",
        F.col("l_partkey").cast("int").alias("log_index"),
        "timestamp",
        F.lit(False).alias("removed"),
    )


LINE = ("l_orderkey", "l_linenumber", "l_partkey", "l_linestatus", "timestamp")


def blocks(spark: SparkSession, folder: str, counted: bool = False) -> DataFrame:
    """One block per order; ``counted`` adds the header's transaction count."""
    o = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("number"),
        epoch(F.col("o_orderdate")).alias("timestamp"),
        address(F.col("o_custkey")).alias("proposer"),
        F.col("o_totalprice").cast("int").alias("gas_used"),
        (F.col("o_custkey") * 1000003 + 25000000000).cast("string").alias("base_fee_per_gas"),
    )
    if not counted:
        return o
    n = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("number")).agg(
        F.count("*").cast("int").alias("transaction_count"))
    return o.join(n, "number", "left").withColumn(
        "transaction_count", F.coalesce("transaction_count", F.lit(0)))


#: Blocks that one order stands for in ``long_chain``, and the orders whose blocks are missing there.
CHAIN_STRETCH, CHAIN_GAP = 40, 9973


def long_chain(spark: SparkSession, folder: str) -> DataFrame:
    """A chain over several block partitions: ``CHAIN_STRETCH`` blocks for each order, ten seconds apart, without those
    of every order whose key plus one is a multiple of ``CHAIN_GAP``. Times are long: those of a chain of many orders
    do not fit an int, which the queries give only where all times they return do."""
    first = F.col("o_orderkey") * CHAIN_STRETCH
    o = table(spark, folder, "orders").filter((F.col("o_orderkey") + 1) % CHAIN_GAP != 0)
    number = (first + F.col("i")).alias("number")
    return o.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(CHAIN_STRETCH - 1)))).select(
        number, (F.lit(800_000_000) + (first + F.col("i")) * 10).cast("bigint").alias("timestamp"),
        ((F.col("o_custkey") + F.col("i")) % 7).cast("int").alias("transaction_count"),
        F.col("o_totalprice").cast("int").alias("gas_used"),
        (F.col("o_custkey") * 1000003 + 25000000000 + F.col("i")).cast("string").alias("base_fee_per_gas"))


def stored_blocks(spark: SparkSession, folder: str) -> DataFrame:
    """Blocks that have transactions: the others are the gaps of the numbering."""
    return table(spark, folder, "lineitem").select(F.col("l_orderkey").alias("number"))


def _transaction(at: At) -> dict[str, Column]:
    """The columns of a line item's transaction."""
    creates = (at("l_returnflag") == "R") & (at("l_linenumber") == 1)
    prefix = F.when(at("l_partkey") % 2 == 0, K.CREATE_PREFIX).otherwise(K.CREATE2_PREFIX)
    update = at("l_returnflag") == "A"
    return {
        "access_list": F.lit("[]"),
        "block_hash": F.concat(F.lit("0x"), hexed(at("l_orderkey"), 64)),
        "block_number": at("l_orderkey"),
        "contract_address": F.when(creates, contract(at("l_partkey"))),
        "chain_id": F.when(at("l_linestatus") == "F", "0x2019").otherwise(""),
        "from_address": address(at("o_custkey")),
        "input": F.when(creates, F.concat(prefix, hexed(at("l_partkey"), 8)))
        .otherwise(F.concat(F.lit("0xa9059cbb"), hexed(at("l_suppkey"), 64))),
        "gas_price": F.when(at("l_tax") > 0.05, "750000000000").otherwise("25000000000"),
        "status": at("l_linestatus") == "F",
        "to_address": F.when(~creates, contract(at("l_partkey"))),
        "transaction_hash": transaction_hash(at),
        "sender_tx_hash": F.concat(F.lit("0xs"), hexed(at("l_orderkey") * 8 + at("l_linenumber"), 63)),
        "transaction_index": at("l_linenumber"),
        "type": F.when(update, "TxTypeAccountUpdate").otherwise("TxTypeValueTransfer"),
        "type_int": F.when(update, 32).otherwise(8),
        "key": F.when(update & (at("l_linestatus") == "F"), F.concat(F.lit("0x04"), hexed(at("l_suppkey"), 8))),
        "fee_payer": F.when(at("l_tax") > 0.04, "").otherwise(address(at("l_suppkey"))),
        "tx_error": F.when(at("l_discount") > 0.08, 9),
        "value": F.round(at("l_extendedprice") * 100).cast("bigint").cast("string"),
        "code_format": F.lit(None).cast("string"),
        "timestamp": at("timestamp"),
    }


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per line item; the first returned line of an order creates a contract."""
    return lines(spark, folder).select(*[c.alias(n) for n, c in _transaction(F.col).items()])


#: What a line item's transaction and event are made of.
ITEM = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
        "l_returnflag", "l_linestatus", "o_custkey", "timestamp")


def _hexint(value: Column) -> Column:
    return F.concat(F.lit("0x"), F.lower(F.hex(value.cast("bigint"))))


def _raw_transaction(group: Column) -> Column:
    """A transaction as in the log: that of the line item ``chosen``, with the events of all ``items``."""
    t = _transaction(lambda name: group["chosen"][name])

    def event(item: Column) -> Column:
        parts = _event_parts(lambda name: item[name])
        topics, data = _event(lambda name: parts[name] if name in parts else item[name])
        index = item["l_partkey"].cast("int")
        return F.struct(F.hex(index).alias("_o"), data.alias("data"), topics.alias("topics"),
                        contract(item["l_partkey"]).alias("address"), _hexint(index).alias("logIndex"))

    logs = F.transform(F.array_sort(F.transform(group["items"], event)), lambda g: F.struct(
        t["block_hash"].alias("blockHash"), _hexint(t["block_number"]).alias("blockNumber"),
        t["transaction_hash"].alias("transactionHash"),
        _hexint(t["transaction_index"]).alias("transactionIndex"),
        g["address"].alias("address"), g["topics"].alias("topics"), g["data"].alias("data"),
        g["logIndex"].alias("logIndex"), F.lit(False).alias("removed")))
    return F.struct(
        t["block_hash"].alias("blockHash"), _hexint(t["block_number"]).alias("blockNumber"),
        t["chain_id"].alias("chainId"), t["contract_address"].alias("contractAddress"),
        t["from_address"].alias("from"), F.lit("0x5208").alias("gas"),
        _hexint(t["gas_price"]).alias("gasPrice"),
        F.lit("0x5208").alias("gasUsed"), t["input"].alias("input"), logs.alias("logs"),
        F.lit("0x").alias("logsBloom"), F.lit("0x7").alias("nonce"),
        t["sender_tx_hash"].alias("senderTxHash"),
        F.array(F.struct(F.lit("0x1").alias("V"), F.lit("0x2").alias("R"), F.lit("0x3").alias("S"))).alias("signatures"),
        F.when(t["status"], "0x1").otherwise("0x0").alias("status"),
        t["to_address"].alias("to"), t["transaction_hash"].alias("transactionHash"),
        _hexint(t["transaction_index"]).alias("transactionIndex"), t["type"].alias("type"),
        t["type_int"].alias("typeInt"), _hexint(t["value"]).alias("value"),
        t["key"].alias("key"), _hexint(t["tx_error"]).alias("txError"))


def raw_block_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The whole log as JSON lines: one block per order with its transactions and events.

    Line items are dealt out once, by their order and as narrow as they are stored. They are grouped where they lie, and
    hashes, events and JSON, many times as wide, are made of each order's list at the end.
    """
    t = _transaction(F.col)
    # Line items can share a transaction: the greatest by what sets them apart stands for all.
    order = F.struct(F.coalesce(t["contract_address"], t["to_address"]), t["input"], t["value"], t["gas_price"], t["type"],
                     t["status"], F.coalesce(t["tx_error"], F.lit(0)))
    item = F.struct(*ITEM)
    per_tx = lines(spark, folder).filter("l_linenumber is not null").groupBy("l_orderkey", "l_linenumber").agg(
        F.max_by(item, order).alias("chosen"), F.collect_list(item).alias("items"))
    nested = per_tx.groupBy(F.col("l_orderkey").alias("block_number")).agg(
        F.array_sort(F.collect_list(F.struct("l_linenumber", "chosen", "items"))).alias("txs"))
    b = blocks(spark, folder).withColumnRenamed("number", "block_number").join(nested, "block_number")
    hexint = lambda c: _hexint(F.col(c))
    content = F.struct(
        F.concat(F.lit("0x"), F.lower(F.hex(F.col("base_fee_per_gas").cast("bigint")))).alias("baseFeePerGas"),
        F.lit("0x1").alias("blockscore"), F.array(F.col("proposer")).alias("committee"),
        F.lit("0x").alias("extraData"), hexint("gas_used").alias("gasUsed"),
        F.concat(F.lit("0x"), hexed(F.col("block_number"), 64)).alias("hash"),
        F.lit("0x").alias("logsBloom"), hexint("block_number").alias("number"),
        F.concat(F.lit("0x"), hexed(F.col("block_number") + 1, 64)).alias("parentHash"),
        F.col("proposer").alias("proposer"), F.lit("0xr").alias("receiptsRoot"),
        F.col("proposer").alias("reward"), F.lit("0x3e8").alias("size"),
        F.lit("0xs").alias("stateRoot"), hexint("timestamp").alias("timestamp"),
        F.lit("0x0").alias("timestampFoS"), F.lit("0x5").alias("totalBlockScore"),
        F.lit("0xt").alias("transactionsRoot"), F.lit("0x").alias("voteData"),
        F.transform("txs", _raw_transaction).alias("transactions"))
    return b.select(
        "block_number",
        F.to_json(F.struct(F.col("block_number").alias("blockNumber"), content.alias("result"))).alias("value"))


_EVENT_KINDS = ("click", "view", "purchase", "signup", "error")


EVERY_TOPIC = (
    K.TOPIC_TRANSFER, K.TOPIC_APPROVAL, K.TOPIC_APPROVAL_FOR_ALL, K.TOPIC_TRANSFER_SINGLE, K.TOPIC_TRANSFER_BATCH,
    K.TOPIC_URI, K.TOPIC_SET_TOKEN_URI, K.TOPIC_MINTER_ADDED, K.TOPIC_WITHDRAWAL, K.TOPIC_DEPOSIT, K.TOPIC_MINT,
    K.TOPIC_BURN, K.TOPIC_BURN_PAIR, K.TOPIC_ADDR_CHANGED, K.TOPIC_NEW_RESOLVER, K.TOPIC_NAME_CHANGED,
    K.TOPIC_UPGRADED, K.TOPIC_LEGACY_NFT_TRANSFER, "0xother")


def every_kind(spark: SparkSession, folder: str) -> DataFrame:
    """Events as logs of every kind in turn, with none to four topics."""
    first = F.element_at(F.array(*[F.lit(t) for t in EVERY_TOPIC]), (F.col("event_id") % len(EVERY_TOPIC) + 1).cast("int"))
    size = (F.col("event_id") % 5).cast("int")
    return table(spark, folder, "events").select(
        "event_id", F.slice(F.array(first, F.lit("0x1"), F.lit("0x2"), F.lit("0x3")), F.lit(1), size).alias("topics"))


def approval_logs(spark: SparkSession, folder: str, dealt: bool = False) -> DataFrame:
    """Events as approvals: an hour is a block, the event id the transaction.

    click and view approve an amount (in topics and in data), purchase a token,
    signup an operator, error is a deposit or a withdrawal. With ``dealt`` tasks are told by rows, as those of ``lines``
    are: a logged event is many times as wide as a stored one.
    """
    events = table(spark, folder, "events")
    if dealt:
        tasks = -(-events.count() // LINES_PER_TASK)
        events = events.repartition(tasks, "event_id") if tasks > 1 else events
    e = events.withColumns({
        "owner": address(F.col("user_id")),
        "spender": address(F.col("user_id") % 3),
        "part": F.col("user_id") % 14,
        "cents": F.floor(F.col("value")).cast("bigint"),
    })
    kind = F.col("event_type")
    o, s = _topic(F.col("owner")), _topic(F.col("spender"))
    token = F.concat(F.lit("0x"), hexed(F.col("cents") % 5, 64))
    odd = F.col("event_id") % 2 == 1
    topics = (
        F.when(kind == "click", F.array(F.lit(K.TOPIC_APPROVAL), o, s))
        .when(kind == "view", F.array(F.lit(K.TOPIC_APPROVAL)))
        .when(kind == "purchase", F.array(F.lit(K.TOPIC_APPROVAL), o, s, token))
        .when(kind == "signup", F.array(F.lit(K.TOPIC_APPROVAL_FOR_ALL), o, s))
        .when(odd, F.array(F.lit(K.TOPIC_DEPOSIT), o))
        .otherwise(F.array(F.lit(K.TOPIC_WITHDRAWAL))))
    amount = hexed(F.col("cents"), 64)
    data = (
        F.when(kind == "click", F.concat(F.lit("0x"), amount))
        .when(kind == "view", F.concat(F.lit("0x"), _word(F.col("owner")), _word(F.col("spender")), amount))
        .when(kind == "purchase", "0x")
        .when(kind == "signup", F.concat(F.lit("0x"), hexed(F.col("event_id") % 2, 64)))
        .when(odd, F.concat(F.lit("0x"), amount))
        .otherwise(F.concat(F.lit("0x"), _word(F.col("owner")), amount)))
    encoded = computed_once(e, ["event_id", "ts", "part"], {"topics": topics, "data": data})
    hour = F.call_function("div", epoch(F.col("ts")), F.lit(3600))
    return encoded.select(
        hour.cast("bigint").alias("block_number"),
        F.concat(F.lit("0x"), hexed(F.col("event_id"), 64)).alias("transaction_hash"),
        (F.col("event_id") % 1000).cast("int").alias("transaction_index"),
        F.col("event_id").cast("int").alias("log_index"),
        F.lit(True).alias("transaction_status"),
        contract(F.col("part")).alias("address"),
        "topics", "data",
        (hour * 3600).cast("int").alias("timestamp"),
    )


def trace_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as call traces: turn n is called by turn n div 2.

    The JSON text is put together in depth-first order: the path of a turn is its
    binary form, and the step down to the next path says how many brackets close.
    """
    c = table(spark, folder, "conversations").select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"),
        F.when(F.col("turn") == 0, "").otherwise(F.bin("turn")).alias("path"),
        F.when(F.col("role") == "user", "CALL").otherwise("CREATE").alias("kind"),
        F.length("text").alias("chars"))
    nodes = c.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("path", "turn", "kind", "chars"))).alias("n"))
    body = F.expr("""
      array_join(transform(n, (x, i) -> concat(
        '{"type":"', x.kind, '","from":"0x', lpad(lower(hex(conv_id)), 40, '0'),
        '","to":"0x', lpad(lower(hex(x.turn)), 40, '0'),
        '","value":"0x', lower(hex(x.chars)), '","gas":"0x', lower(hex(x.chars * 2)),
        '","input":"0x', lower(hex(x.turn)), '","time":"', x.turn, 'ms"',
        case
          when i + 1 = size(n) then concat(repeat('}]', cast(length(x.path) as int)), '}')
          when length(n[i + 1].path) > length(x.path) then ',"calls":['
          else concat(repeat('}]', length(x.path) - length(n[i + 1].path)), '},')
        end)), '')
    """)
    return nodes.select(
        F.col("conv_id").alias("block_number"),
        F.concat(F.lit('{"blockNumber":'), F.col("conv_id"), F.lit(',"result":['), body, F.lit("]}")).alias("value"))


DEEP_GROUP = 400     # conversations whose turns make one chain
DEEP_TIMES = 3       # calls that each turn makes


def deep_trace_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The turns of a run of conversations as one chain of calls, each made DEEP_TIMES over.

    The chain ends in as many calls side by side as it is deep. Block numbers count the runs.
    """
    c = table(spark, folder, "conversations").select(
        F.call_function("div", F.col("conv_id"), F.lit(DEEP_GROUP)).alias("block_number"),
        F.explode(F.sequence(F.lit(0), F.lit(DEEP_TIMES - 1))).alias("again"),
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"))
    chains = c.groupBy("block_number").agg(
        F.array_sort(F.collect_list(F.struct("conv_id", "turn", "again"))).alias("n"))
    own = "'\"from\":\"0x', lpad(lower(hex(x.conv_id)), 40, '0'), '\",\"gas\":\"0x', lower(hex(x.turn)), '\"'"
    down = F.expr(f"array_join(transform(n, x -> concat('{{', {own}, ',\"calls\":[')), '')")
    wide = F.expr(f"array_join(transform(n, x -> concat('{{', {own}, '}}')), ',')")
    up = F.expr("repeat(']}', size(n))")
    return chains.select("block_number", F.concat(
        F.lit('{"blockNumber":'), "block_number", F.lit(',"result":['), down, wide, up, F.lit("]}")).alias("value"))


def upgrade_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as Upgraded events: the implementation in a topic or in the data."""
    c = table(spark, folder, "customer")
    target = _topic(contract(F.col("c_custkey") + 1))
    in_topic = F.col("c_nationkey") % 2 == 0
    return c.select(
        F.col("c_custkey").alias("block_number"), F.lit(0).alias("transaction_index"),
        F.lit(0).alias("log_index"),
        contract(F.col("c_custkey")).alias("address"),
        F.when(in_topic, F.array(F.lit(K.TOPIC_UPGRADED), target)).otherwise(
            F.array(F.lit(K.TOPIC_UPGRADED))).alias("topics"),
        F.when(in_topic, "0x").otherwise(target).alias("data"),
        F.lit(True).alias("transaction_status"))


REGISTRY = "0x" + "9" * 40
NAME_SUFFIX = ".chain"


def name_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Customers as name-service events, the kind by market segment."""
    c = table(spark, folder, "customer")
    key, kind = F.col("c_custkey"), F.col("c_mktsegment")
    name_hash = F.concat(F.lit("0x"), hexed(key, 64))
    text = F.concat(F.lower("c_name"), F.lit(NAME_SUFFIX))
    blank = F.col("c_nationkey") % 2 == 0
    body = F.concat(
        F.lit("0x" + format(32, "064x")), hexed(F.when(blank, 0).otherwise(F.length(text)), 64),
        F.when(blank, "").otherwise(F.rpad(F.lower(F.hex(F.encode(text, "UTF-8"))), 128, "0")))
    topics = (
        F.when(kind == "AUTOMOBILE", F.array(F.lit(K.TOPIC_ADDR_CHANGED), name_hash))
        .when(kind == "BUILDING", F.array(F.lit(K.TOPIC_NEW_RESOLVER), name_hash))
        .when(kind == "FURNITURE", F.array(
            F.lit(K.TOPIC_TRANSFER), _topic(address(key)), _topic(address(key + 1)), name_hash))
        .when(kind == "HOUSEHOLD", F.array(F.lit(K.TOPIC_NAME_CHANGED), name_hash))
        .otherwise(F.array(F.lit(K.TOPIC_URI), name_hash)))
    return computed_once(c, [], {
        "address": F.when(kind == "FURNITURE", REGISTRY).otherwise(contract(key)),
        "topics": topics, "data": F.when(kind == "HOUSEHOLD", body).otherwise("0x")})


def name_snapshot(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Names by hash and primary names by address."""
    c = table(spark, folder, "customer")
    key, kind = F.col("c_custkey"), F.col("c_mktsegment")
    names = c.select(
        F.concat(F.lit("0x"), hexed(key, 64)).alias("name_hash"),
        F.when(kind == "HOUSEHOLD", F.concat(hexed(key, 40), F.lit(K.REVERSE_SUFFIX)))
        .otherwise(F.concat(F.lower("c_name"), F.lit(NAME_SUFFIX))).alias("name"),
        address(key + 5).alias("resolved_address"),
        (F.col("c_acctbal") > 0).alias("known"))
    primary = c.select(
        address(key).alias("address"),
        F.when(F.col("c_acctbal") > 5000, F.concat(F.lower("c_name"), F.lit(NAME_SUFFIX))).otherwise("")
        .alias("primary_name"))
    return names, primary


def uri_logs(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as uri events by their status."""
    o = table(spark, folder, "orders")
    first = F.when(F.col("o_orderstatus") == "O", K.TOPIC_URI).when(
        F.col("o_orderstatus") == "F", K.TOPIC_SET_TOKEN_URI).otherwise(K.TOPIC_MINTER_ADDED)
    return o.select(
        contract(F.col("o_custkey")).alias("address"),
        F.array(first, F.concat(F.lit("0x"), hexed(F.col("o_orderkey"), 64))).alias("topics"),
        F.lit("0x").alias("data"), epoch(F.col("o_orderdate")).alias("timestamp"),
        F.col("o_orderkey").alias("block_number"))


def segments(spark: SparkSession, folder: str, size: int = 300) -> DataFrame:
    """Documents as log lines cut into pieces of ``size`` characters."""
    docs = table(spark, folder, "documents").select(
        F.col("doc_id").alias("block_number"), F.col("text").alias("value"))
    return split_segments(docs, size)


def log_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as log lines, all in one file of block partition 0.

    A block is an order key; its lines are those of its line items, twice each. Lines
    with the same ship flag differ in their time only, other flags make variants, so
    blocks have one to three variants. Urgent orders add a line that names no block.
    """
    src = table(spark, folder, "lineitem").select(
        F.concat(
            F.lit('{"blockNumber":'), F.col("l_orderkey").cast("string"),
            F.lit(',"result":{"flag":"'), "l_returnflag", F.lit('","time":"'),
            F.col("l_linenumber").cast("string"), F.lit('ms"}}')).alias("value"))
    bad = table(spark, folder, "orders").filter(F.col("o_orderpriority") == "1-URGENT").select(
        F.concat(F.lit("broken "), F.col("o_orderkey").cast("string")).alias("value"))
    return src.unionAll(src).unionAll(bad)


def bytecode(spark: SparkSession, folder: str) -> DataFrame:
    """Contracts with code that pushes the selectors of their type."""
    selectors = dict(K.TYPE_SELECTORS)
    kind = F.col("contract_type")
    code = F.lit("")
    for number, wanted in selectors.items():
        code = F.when(kind == number, "".join(f"63{s}14" for s in wanted)).otherwise(code)
    return contracts(spark, folder).select(
        "contract_address", F.concat(F.lit("0x6080604052"), code, F.lit("00")).alias("bytecode"))


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents spread over tasks: their texts vary in length and come in few row groups."""
    return table(spark, folder, "documents").repartition("doc_id")


def text_bytecode(spark: SparkSession, folder: str) -> DataFrame:
    """Whole document texts as byte code."""
    return documents(spark, folder).select(
        contract(F.col("doc_id")).alias("contract_address"),
        F.concat(F.lit("0x"), F.lower(F.hex(F.encode("text", "UTF-8")))).alias("bytecode"))
