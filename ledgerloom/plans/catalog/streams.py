"""Queries: streams over the driver's tables run to their end, and the scheduled jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerloom import constants as K
from ledgerloom.functions import hexnum
from ledgerloom.operators import accounts, approvals, blocks as B, decode, holders, quality, refine, transfers
from ledgerloom.operators.contracts import with_contract_type
from ledgerloom.plans import adapters as A, jobs
from ledgerloom.plans.catalog.base import (
    BLOCKS, BURNS, COUNTED, MOVES, NFTS, TXS, ZERO, ZERO_OR_DEAD, addr, h64, hx, legs, query, with_,
)
from ledgerloom.plans.catalog.ledger import _ACCOUNTS, _APPROVED
from ledgerloom.plans.catalog.refining import _CALLS, _LOG
from ledgerloom.session import scratch_path
from ledgerloom.sources import lake, logs as L
from ledgerloom.streaming import jobs as S, segments
from ledgerloom.streaming.control import Throttle, run_to_end
from ledgerloom.streaming.seen import SeenLogs
from ledgerloom.streaming.tables import BatchTable
from ledgerloom.streaming.waiting import released


def _replayed(spark, rows, name, files=3):
    """Rows written as ``files`` files and read back as a stream of one file per batch."""
    path = scratch_path(spark, name)
    rows.repartition(files).write.parquet(f"{path}/input")
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/input")
    return stream, path


def _replayed_as_laid(spark, rows, name, batches=3):
    """Rows written by the tasks that made them and read back as a stream of ``batches`` batches, of as many files each.

    For rows that are wide or many, and batches whose order does not matter: ``_replayed`` deals them out again, to so few tasks
    that each takes its share of the whole table. Fewer files than batches are dealt out after all.
    """
    path = scratch_path(spark, name)
    rows.write.parquet(f"{path}/input")
    files = len(spark.read.schema(rows.schema).parquet(f"{path}/input").inputFiles())
    if files < batches:
        return _replayed(spark, spark.read.schema(rows.schema).parquet(f"{path}/input"), name, batches)
    at_once = 1 if files == batches + 1 else -(-files // batches)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", at_once).parquet(f"{path}/input")
    return stream, path


def _appended(stream, path, **options):
    writer = stream.writeStream.format("parquet").outputMode("append").option(
        "path", f"{path}/out").option("checkpointLocation", f"{path}/checkpoint")
    run_to_end(writer, stream.sparkSession)
    return stream.sparkSession.read.schema(stream.schema).parquet(f"{path}/out")


# A log has one place in the chain; line items that share one are left out of the streams that rest on it.
_UNIQUE_MOVES = MOVES.replace("moves AS (", "every_move AS (", 1) + """,
moves AS (SELECT * FROM every_move QUALIFY count(*) OVER (PARTITION BY b, ti, li) = 1)"""


def _unique_logs(spark, folder):
    return A.event_logs(spark, folder, alone=True)


_WHOLE = """SELECT doc_id AS block_number, text AS value FROM documents"""


@query("reassemble_segments", _WHOLE)
def reassemble_segments(spark, folder):
    pieces = A.segments(spark, folder, size=1500)
    stream, path = _replayed(spark, pieces, "segments")
    done = _appended(segments.reassemble_segments(stream), path)
    return done.filter("complete").select("block_number", "value")


@query("reassemble_batch", """
SELECT doc_id AS block_number, CASE WHEN lang <> 'de' OR length(text) <= 300 THEN text END AS value,
  lang <> 'de' OR length(text) <= 300 AS complete,
  CASE WHEN lang <> 'de' OR length(text) <= 300 THEN 0 ELSE 1 END AS missing FROM documents""")
def reassemble_batch(spark, folder):
    german = A.table(spark, folder, "documents").filter("lang = 'de'").select(F.col("doc_id").alias("block_number"))
    pieces = A.segments(spark, folder)
    lost = pieces.filter("segment_index = 1").join(german, "block_number", "left_semi").select(
        "block_number", "segment_index")
    kept = pieces.join(lost, ["block_number", "segment_index"], "left_anti")
    whole = segments.reassemble_batch(kept.unionByName(kept))
    return whole.withColumn("missing", F.size("missing"))


@query("cut_late", "SELECT event_id, user_id FROM events WHERE event_id >= (SELECT max(event_id) FROM events) - 3000")
def cut_late(spark, folder):
    e = A.table(spark, folder, "events").select("event_id", "user_id")
    newest = e.agg(F.max("event_id")).first()[0]
    floor = S.late_floor(newest, elapsed_seconds=30000, max_before=3000)
    return S.cut_late(e, floor, "event_id")


@query("suppress_replays", "SELECT event_id, user_id, event_type FROM events")
def suppress_replays(spark, folder):
    e = A.table(spark, folder, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    stream, path = _replayed(spark, e.unionByName(e), "replays")
    return _appended(S.suppress_replays(stream, ["event_id"], "ts", "60 days"), path).drop("ts")


# Every row of the refined tables by its place: number, hash, and index within the block or transaction.
_PLACES = f"""SELECT DISTINCT 'blocks' AS name, b AS number, '0x' || {hx('b', 64)} AS hash, NULL::BIGINT AS place FROM one
UNION ALL SELECT 'transactions', b, h, ti FROM one UNION ALL SELECT 'event_logs', b, h, li FROM moves"""
_PLACE_COLUMNS = {"blocks": ("number", "hash", None), "transactions": ("block_number", "transaction_hash", "transaction_index"),
                  "event_logs": ("block_number", "transaction_hash", "log_index")}


def _places(name, rows):
    number, digest, place = _PLACE_COLUMNS[name]
    return rows.select(F.lit(name).alias("name"), F.col(number).alias("number"), F.col(digest).alias("hash"),
                       (F.col(place) if place else F.lit(None)).cast("bigint").alias("place"))


@query("stream_blocks", with_(MOVES, _LOG) + _PLACES + """
UNION ALL SELECT 'latest', max(b), NULL, NULL FROM one""")
def stream_blocks(spark, folder):
    stream, path = _replayed_as_laid(spark, A.raw_block_lines(spark, folder).select("value"), "blocks")
    run_to_end(S.run_outputs(stream, S.block_outputs, f"{path}/tables", f"{path}/checkpoint",
                             prepare=S.decoded_blocks, fan_out=2), spark)
    nothing = F.lit(None)
    out = S.output_table(f"{path}/tables", "latest").read(spark).agg(F.max("number").alias("number")).select(
        F.lit("latest").alias("name"), "number", nothing.cast("string").alias("hash"), nothing.cast("bigint").alias("place"))
    for name in _PLACE_COLUMNS:
        out = out.unionByName(_places(name, S.output_table(f"{path}/tables", name).read(spark)))
    return out


@query("stream_traces", with_(_CALLS) + """
SELECT 'calls' AS name, block_number, call_id, type, f AS address, t AS other FROM calls
UNION ALL SELECT 'index', block_number, count(*)::INT, NULL, NULL, NULL
FROM (SELECT block_number, f FROM calls UNION ALL SELECT block_number, t FROM calls WHERE f <> t) GROUP BY block_number""")
def stream_traces(spark, folder):
    """Every call, and the number of index rows of every block."""
    stream, path = _replayed(spark, A.trace_lines(spark, folder).select("value"), "traces")
    run_to_end(S.run_outputs(stream, S.trace_outputs, f"{path}/tables", f"{path}/checkpoint",
                             prepare=S.decoded_calls), spark)
    flat = S.output_table(f"{path}/tables", "internal_transactions").read(spark)
    index = S.output_table(f"{path}/tables", "internal_transaction_index").read(spark)
    none = F.lit(None).cast("string")
    return flat.select(F.lit("calls").alias("name"), "block_number", "call_id", "type", F.col("from_address").alias("address"),
                       F.col("to_address").alias("other")).unionByName(
        index.groupBy("block_number").agg(F.count("*").cast("int").alias("call_id")).select(
            F.lit("index").alias("name"), "block_number", "call_id", none.alias("type"), none.alias("address"), none.alias("other")))


@query("stream_accounts", with_(MOVES, _LOG) + f"""
, senders AS (SELECT {addr('o_custkey')} AS a, count(DISTINCT (b, ti)) AS n FROM moves GROUP BY 1)
SELECT a AS address, n AS transactions FROM senders""".replace("\n, senders", ",\nsenders"))
def stream_accounts(spark, folder):
    stream, path = _replayed_as_laid(spark, A.raw_block_lines(spark, folder).select("value"), "accounts")
    run_to_end(S.run_outputs(stream, S.account_outputs, f"{path}/tables", f"{path}/checkpoint",
                             prepare=S.decoded_blocks), spark)
    merged = accounts.merge_accounts(S.output_table(f"{path}/tables", "accounts").read(spark))
    return merged.filter("transactions > 0").select("address", "transactions")


@query("stream_transfers", with_(_UNIQUE_MOVES, NFTS) + f"""
SELECT 'tokens' AS name, d AS display_order, c AS contract_address, f AS from_address, t AS to_address FROM moves WHERE ct IN (0, 1, 127)
UNION ALL SELECT 'nfts', d, c, f, t FROM nfts
UNION ALL SELECT 'token_burns', d, c, f, t FROM moves WHERE ct IN (0, 1, 127) AND t IN ({BURNS})
UNION ALL SELECT 'nft_burns', d, c, f, t FROM nfts WHERE t IN ({BURNS})""")
def stream_transfers(spark, folder):
    contracts = A.contracts(spark, folder)
    logs = _unique_logs(spark, folder)
    again = logs.filter("block_number % 7 = 0")      # blocks that are sent twice
    stream, path = _replayed_as_laid(spark, logs.unionByName(again), "transfers")
    for _ in range(2):      # the second run finds nothing new
        run_to_end(S.run_outputs(
            stream, lambda batch: S.transfer_outputs(batch, contracts), f"{path}/tables", f"{path}/checkpoint",
            prepare=SeenLogs(f"{path}/tables"), fan_out=2), spark)
    out = None
    for name, label in (("token_transfers", "tokens"), ("nft_transfers", "nfts"),
                        ("token_burns", "token_burns"), ("nft_burns", "nft_burns")):
        part = S.output_table(f"{path}/tables", name).read(spark).select(
            F.lit(label).alias("name"), "display_order", "contract_address", "from_address", "to_address")
        out = part if out is None else out.unionByName(part)
    return out


@query("stream_holders", with_(MOVES, legs("moves", "amt")) + f"""
SELECT c AS contract_address, holder AS holder_address, {h64('sum(a)')} AS amount, max(ts) AS timestamp
FROM legs WHERE holder NOT IN ({ZERO_OR_DEAD}) GROUP BY 1, 2""")
def stream_holders(spark, folder):
    rows = A.transfers(spark, folder).select(
        "contract_address", "from_address", "to_address", "amount", "timestamp", "block_number")
    stream, path = _replayed_as_laid(spark, rows, "holders")

    def outputs(batch):
        return {"token_deltas": holders.token_balance_deltas(batch, K.ZERO_OR_DEAD)}

    def fold(deltas):
        return hexnum.sum_hex(deltas, list(holders.HOLDER_KEY), "amount", "amount", F.max("timestamp").alias("timestamp"),
                              F.max("block_number").alias("block_number"), signed=True)

    folds = {"token_deltas": fold}
    run_to_end(S.run_outputs(stream, outputs, f"{path}/tables", f"{path}/checkpoint", fan_out=2, folds=folds), spark)
    return S.output_table(f"{path}/tables", "token_deltas", folds=folds).totals(spark).drop("block_number")


@query("stream_nft_holders", with_(_UNIQUE_MOVES, NFTS, legs("nfts", "n", "ct", "tok")) + f"""
, kept AS (SELECT * FROM legs WHERE ct IN (2, 4) AND holder NOT IN ({ZERO_OR_DEAD}))
SELECT 'holder' AS part, c AS contract_address, holder AS holder_address, NULL AS token_id, {h64('sum(a)')} AS amount,
  max(ts) AS timestamp FROM kept GROUP BY 2, 3 HAVING sum(a) > 0
UNION ALL SELECT 'item', c, holder, tok::VARCHAR, NULL, max(ts) FROM (
  SELECT c, holder, tok, b, sum(a) AS a, max(ts) AS ts FROM kept GROUP BY ALL HAVING sum(a) <> 0)
GROUP BY 1, 2, 3, 4 HAVING sum(a) > 0""".replace("\n, kept", ",\nkept"))
def stream_nft_holders(spark, folder):
    """Streamed deltas merged into a stored holder table, moves into a stored inventory; both are empty at first."""
    contracts = A.contracts(spark, folder)
    logs = _unique_logs(spark, folder)
    stream, path = _replayed_as_laid(spark, logs.unionByName(logs.filter("block_number % 5 = 0")), "nft-holders")

    def outputs(batch):
        return S.holder_outputs(decode.token_transfers(batch), with_contract_type(decode.nft_transfers(batch), contracts))

    run_to_end(S.run_outputs(stream, outputs, f"{path}/tables", f"{path}/checkpoint", prepare=SeenLogs(f"{path}/tables"),
                             fan_out=2, folds={"inventory_moves": S.fold_moves}), spark)
    deltas = S.output_table(f"{path}/tables", "nft_deltas").read(spark).filter(F.col("contract_type").isin(*K.COLLECTION_TYPES))
    stored = deltas.limit(0).select("contract_address", "holder_address", "token_count", "timestamp")
    held = holders.apply_merge(holders.nft_holder_merge(stored, deltas))
    moves = S.fold_moves(S.output_table(f"{path}/tables", "inventory_moves").read(spark))
    items = holders.inventory_apply(moves.limit(0), moves)
    nothing = F.lit(None).cast("string")
    return held.select(F.lit("holder").alias("part"), "contract_address", "holder_address", nothing.alias("token_id"),
                       F.col("token_count").alias("amount"), "timestamp").unionByName(
        items.select(F.lit("item").alias("part"), "contract_address", "holder_address", "token_id",
                     nothing.alias("amount"), "timestamp"))


@query("stream_late_logs", with_(MOVES) + """,
floors AS (SELECT max(b) FILTER (WHERE b % 5 <> 0) - 3000 AS second, max(b) - 3000 AS third FROM moves
  WHERE ti IS NOT NULL AND li IS NOT NULL),
sent AS (SELECT b, ti, li, CASE WHEN b % 5 <> 0 THEN NULL ELSE second END AS floor FROM moves, floors
  UNION ALL SELECT b, ti, li, third FROM moves, floors),
told AS (SELECT b, ti, li, CASE WHEN b < floor THEN 'late' ELSE 'kept' END AS part FROM sent)
SELECT part, b AS block_number, CASE WHEN part = 'late' THEN count(*) ELSE count(*) FILTER (WHERE ti IS NULL OR li IS NULL)
  + count(DISTINCT (ti, li)) FILTER (WHERE ti IS NOT NULL AND li IS NOT NULL) END AS logs FROM told GROUP BY part, b""")
def stream_late_logs(spark, folder):
    """Every fifth block comes after all others, and everything is sent twice: old ones are late each time, the rest is kept once."""
    logs = A.event_logs(spark, folder)
    late = F.col("block_number") % 5 == 0
    path = scratch_path(spark, "late")
    prepare = SeenLogs(f"{path}/tables", behind=3000, fan_out=2)
    # One run of the stream for each part; a run finds the files of the parts before it again, which it has read.
    for part in (logs.filter(~late), logs.filter(late), logs):
        part.write.mode("append").parquet(f"{path}/input")
        stream = spark.readStream.schema(logs.schema).parquet(f"{path}/input")
        run_to_end(S.run_outputs(stream, lambda batch: {"logs": batch.select("block_number", "transaction_index", "log_index")},
                                 f"{path}/tables", f"{path}/checkpoint", prepare=prepare, fan_out=2), spark)
    kept = S.output_table(f"{path}/tables", "logs").read(spark).groupBy("block_number").agg(F.count("*").alias("logs"))
    cut = prepare.late.read(spark).groupBy("block_number").agg(F.sum("late").alias("logs"))
    return kept.withColumn("part", F.lit("kept")).unionByName(cut.withColumn("part", F.lit("late")))


@query("stream_approvals", with_(_APPROVED) + f"""
SELECT owner AS owner_address, spender AS spender_address, c AS contract_address, b AS block_number, h AS transaction_hash,
  {h64('cents::HUGEINT')} AS amount
FROM (SELECT * FROM e WHERE event_type IN ('click', 'view')
  QUALIFY ROW_NUMBER() OVER (PARTITION BY owner, spender, c ORDER BY b DESC, ti, event_id) = 1) WHERE cents <> 0""")
def stream_approvals(spark, folder):
    """Approvals of all batches folded into the latest per key and applied to an empty stored table."""
    logs = A.approval_logs(spark, folder, dealt=True)
    contracts = A.contracts(spark, folder)
    stream, path = _replayed_as_laid(spark, logs.unionByName(logs.filter("block_number % 3 = 0")), "approvals")

    def outputs(batch):
        return {name: latest(batch, contracts, position=True) for name, (latest, _) in S.APPROVALS.items()}

    run_to_end(S.run_outputs(
        stream, outputs, f"{path}/tables", f"{path}/checkpoint", prepare=SeenLogs(f"{path}/tables"), fan_out=2,
        folds={name: lambda rows, key=key: approvals.fold(rows, key) for name, (_, key) in S.APPROVALS.items()}), spark)
    key = approvals.TOKEN_KEY
    latest = approvals.fold(S.output_table(f"{path}/tables", "token_approvals").read(spark), key)
    stored = latest.drop("action", *["transaction_index", "log_index"]).limit(0)
    return approvals.apply_latest(stored, latest, key).select(
        "owner_address", "spender_address", "contract_address", "block_number", "transaction_hash", "amount")


@query("stream_holder_state", with_(MOVES, legs("moves", "amt")) + f"""
SELECT c AS contract_address, holder AS holder_address, {h64('sum(a)')} AS amount, max(b) AS block_number
FROM legs WHERE holder NOT IN ({ZERO_OR_DEAD}) GROUP BY 1, 2""")
def stream_holder_state(spark, folder):
    rows = A.transfers(spark, folder).select(
        "contract_address", "from_address", "to_address", "amount", "timestamp", "block_number")
    stream, path = _replayed_as_laid(spark, rows, "state")

    def keep(batch, batch_id):
        BatchTable(f"{path}/changes").write(batch.withColumn("batch_id", F.lit(batch_id)), batch_id)

    run_to_end(S.holder_state(stream).writeStream.outputMode("update").foreachBatch(keep).option(
        "checkpointLocation", f"{path}/checkpoint"), spark)
    changes = BatchTable(f"{path}/changes").read(spark)
    return S.newest_holders(changes).drop("timestamp")


@query("stream_search_docs", with_(MOVES, _LOG) + f"""
SELECT one.h AS id, {"strftime(make_timestamp(any_value(ts)::BIGINT * 1000000), '%Y%m')"} AS month
FROM one JOIN moves USING (b, ti, h) GROUP BY one.h""")
def stream_search_docs(spark, folder):
    stream, path = _replayed_as_laid(spark, A.raw_block_lines(spark, folder).select("value"), "docs")
    run_to_end(S.run_outputs(stream, S.search_outputs, f"{path}/tables", f"{path}/checkpoint",
                             prepare=S.decoded_blocks), spark)
    return S.output_table(f"{path}/tables", "transaction_docs").read(spark).select("id", "month")


@query("stream_side_jobs", with_(BLOCKS, COUNTED) + """
SELECT count(*) AS days, sum(tx_count)::BIGINT AS transactions, 1::BIGINT AS runs FROM (
  SELECT ts, sum(tx_count) AS tx_count FROM counted GROUP BY ts)""")
def stream_side_jobs(spark, folder):
    path = scratch_path(spark, "side")
    blocks = A.blocks(spark, folder, counted=True)
    stats = BatchTable(f"{path}/stats")
    runs = []

    def daily(session):
        stats.write(B.daily_tx_history(blocks), len(runs))
        runs.append(1)

    stream, _ = _replayed(spark, A.stored_blocks(spark, folder), "ticks")
    run_to_end(stream.writeStream.foreachBatch(Throttle({"daily": (3600, daily)})).option(
        "checkpointLocation", f"{path}/checkpoint"), spark)
    return stats.read(spark).agg(
        F.count("*").alias("days"), F.sum("transactions").alias("transactions"),
        F.lit(len(runs)).cast("bigint").alias("runs"))


@query("correction_queue", with_(MOVES) + f"""
, pairs AS (SELECT c, h, bool_or(ls = 'F') AS early FROM (SELECT c, f AS h, ls FROM moves UNION ALL SELECT c, t, ls FROM moves)
  WHERE h NOT IN ({ZERO_OR_DEAD}) GROUP BY 1, 2),
queue AS (SELECT c, h, CASE WHEN early THEN 1000 ELSE 1050 END AS q FROM pairs)
SELECT CASE WHEN q <= 1060 - 30 AND row_number() OVER (ORDER BY q, c, h) <= 100 THEN 'due' ELSE 'waiting' END AS part,
  c AS contract_address, h AS holder_address, q::BIGINT AS queued_at FROM queue""".replace("\n, pairs", ",\npairs"))
def correction_queue(spark, folder):
    t = A.transfers(spark, folder)
    empty = S.correction_keys(t).limit(0).withColumn("queued_at", F.lit(0).cast("bigint"))
    queue = S.enqueue(empty, S.correction_keys(t.filter("line_status = 'F'")), 1000)
    queue = S.enqueue(queue, S.correction_keys(t), 1050)
    ready = S.due(queue, 1060)
    waiting = S.dequeue(queue, ready)
    return ready.withColumn("part", F.lit("due")).unionByName(waiting.withColumn("part", F.lit("waiting")))


_DUE = f"""
sums AS (SELECT c, h, sum(a) AS chain, sum(a) FILTER (WHERE ls = 'F') AS db, bool_or(ls = 'F') AS early FROM (
    SELECT c, f AS h, -amt AS a, ls FROM moves UNION ALL SELECT c, t, amt, ls FROM moves)
  WHERE h NOT IN ({ZERO_OR_DEAD}) GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (ORDER BY CASE WHEN early THEN 1000 ELSE 1050 END, c, h) <= 100 AS due FROM sums)"""


@query("correct_due", with_(MOVES, _DUE) + f"""
SELECT 'correction' AS part, c AS contract_address, h AS holder_address, {h64('chain')} AS amount
FROM ranked WHERE due AND early AND db > 0 AND chain <> db
UNION ALL SELECT 'holder', c, h, {h64('CASE WHEN due THEN chain ELSE db END')} FROM ranked
WHERE db > 0 AND (NOT due OR chain = db OR chain > 0)""")
def correct_due(spark, folder):
    """Stored balances of finished lines, checked against those of all lines for the keys that are due."""
    t = A.transfers(spark, folder)
    empty = S.correction_keys(t).limit(0).withColumn("queued_at", F.lit(0).cast("bigint"))
    queue = S.enqueue(empty, S.correction_keys(t.filter("line_status = 'F'")), 1000)
    queue = S.enqueue(queue, S.correction_keys(t), 1050)
    balances = lambda rows: holders.token_balance_deltas(rows, K.ZERO_OR_DEAD).select(
        "contract_address", "holder_address", "amount")
    stored = balances(t.filter("line_status = 'F'")).filter(hexnum.is_positive("amount"))
    done = S.correct_due(queue, 1060, stored, balances(t))
    return done["corrections"].select(
        F.lit("correction").alias("part"), "contract_address", "holder_address",
        F.col("chain_amount").alias("amount")).unionByName(done["holders"].withColumn("part", F.lit("holder")))


@query("recount_due", with_(MOVES, legs("moves", "amt")) + f"""
SELECT c AS contract_address, count(*) AS holder_count FROM (
  SELECT c, holder FROM legs WHERE holder <> '{ZERO}' GROUP BY 1, 2 HAVING sum(a) > 0)
WHERE c IN (SELECT c FROM (SELECT DISTINCT c FROM moves) ORDER BY c LIMIT 100) GROUP BY 1""")
def recount_due(spark, folder):
    t = A.transfers(spark, folder)
    queue = t.select("contract_address").distinct().withColumn("queued_at", F.lit(1000).cast("bigint"))
    stored = holders.token_balance_deltas(t).filter(hexnum.is_positive("amount"))
    early, late = S.recount_due(queue, 1200, stored), S.recount_due(queue, 1300, stored)
    return early["holder_counts"].unionByName(late["holder_counts"])      # nothing is due at first


def _waited(spark, name, keys, parts, delay, outputs):
    """Keys (``parts``: frames with their second) sent through a line in two runs of one stream, the second from its checkpoint.

    Empty records carry the stream's time on, first past the delay of the first part only. ``outputs`` makes rows of
    what a batch releases.
    """
    path = scratch_path(spark, name)
    schema = ", ".join(f"{k} string" for k in keys) + ", at timestamp"

    def send(rows, second):
        rows.select(*keys, F.timestamp_seconds(F.lit(second)).alias("at")).coalesce(1).write.mode("append").parquet(f"{path}/input")

    def tick(second):
        send(spark.range(1).select(*[F.lit(None).cast("string").alias(k) for k in keys]), second)

    def write(batch, batch_id):
        held = batch.persist()
        BatchTable(f"{path}/out").write(outputs(held).withColumn("batch_id", F.lit(batch_id)), batch_id)
        held.unpersist()

    def run():
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{path}/input")
        waited = released(stream.withWatermark("at", "0 seconds"), keys, delay, 1 << 20, time="at", lanes=64)
        run_to_end(waited.writeStream.foreachBatch(write).outputMode("append").option(
            "checkpointLocation", f"{path}/checkpoint"), spark)

    (first, early), (second, late) = parts
    send(first, early)
    send(second, late)
    tick(late)
    run()
    tick(late + delay + 1)
    tick(late + delay + 2)
    run()
    return BatchTable(f"{path}/out").read(spark)


@query("stream_corrections", with_(MOVES, _DUE) + f"""
SELECT 'released' AS part, c AS contract_address, h AS holder_address, NULL AS amount,
  CASE WHEN early THEN 1000 ELSE 1050 END::BIGINT AS queued_at FROM ranked
UNION ALL SELECT 'correction', c, h, {h64('chain')}, 1000 FROM ranked WHERE early AND db > 0 AND chain <> db""")
def stream_corrections(spark, folder):
    """Every holder waits 30 seconds after its first transfer and is then checked."""
    t = A.transfers(spark, folder)
    balances = lambda rows: holders.token_balance_deltas(rows, K.ZERO_OR_DEAD).select(
        "contract_address", "holder_address", "amount")
    stored = balances(t.filter("line_status = 'F'")).filter(hexnum.is_positive("amount")).persist()
    true = balances(t).persist()
    keys = list(holders.HOLDER_KEY)

    def outputs(ready):
        found = S.corrected(ready, stored, true)["corrections"].join(ready, keys)
        return ready.select(F.lit("released").alias("part"), *keys, F.lit(None).cast("string").alias("amount"),
                            "queued_at").unionByName(
            found.select(F.lit("correction").alias("part"), *keys, F.col("chain_amount").alias("amount"), "queued_at"))

    parts = [(S.correction_keys(t.filter("line_status = 'F'")), 1000), (S.correction_keys(t), 1050)]
    try:
        return _waited(spark, "corrections", keys, parts, 30, outputs).drop("batch_id")
    finally:
        stored.unpersist()
        true.unpersist()


@query("stream_recounts", with_(MOVES, legs("moves", "amt")) + f"""
SELECT c AS contract_address, count(*) FILTER (WHERE a > 0 AND holder <> '{ZERO}') AS holder_count
FROM (SELECT c, holder, sum(a) AS a FROM legs GROUP BY 1, 2) GROUP BY 1""")
def stream_recounts(spark, folder):
    """Every contract's holders are counted 300 seconds after its first transfer, once."""
    t = A.transfers(spark, folder)
    stored = holders.token_balance_deltas(t).filter(hexnum.is_positive("amount")).persist()
    half = t.filter("line_status = 'F'").select("contract_address").distinct()
    every = t.select("contract_address").distinct()
    try:
        return _waited(spark, "recounts", ["contract_address"], [(half, 1000), (every, 1050)], 300,
                       lambda ready: S.recounted(ready, stored)).drop("batch_id")
    finally:
        stored.unpersist()


@query("account_contract_catch_up_all", with_(MOVES) + f"""
SELECT a AS account_address, c AS contract_address, max(ts) AS updated_at, max(w) AS last_window FROM (
  SELECT f AS a, c, ts FROM items UNION ALL SELECT t, c, ts FROM items),
  (SELECT 1 AS w) WHERE a <> '{ZERO}' GROUP BY 1, 2""".replace("items", "(SELECT * FROM moves WHERE ct IN (2, 3, 4, 5) AND b > 1000)"))
def account_contract_catch_up_all(spark, folder):
    """Every window behind block 1000, with gaps far wider than a window between the runs of blocks."""
    rows = A.nft_rows(spark, folder).withColumn("is_token", F.lit(False))
    apart = rows.withColumn("block_number", F.col("block_number") + F.call_function(
        "div", F.col("block_number"), F.lit(50_000)) * 10_000_000)
    stored = transfers.account_contracts(apart.limit(0), typed=False).select(
        "account_address", "contract_address", "transfer_type", F.col("timestamp").alias("created_at"),
        F.col("timestamp").alias("updated_at"))
    done, last = jobs.catch_up_account_contracts(apart, stored, 1000, 60_000, scratch_path(spark, "catch-up"))
    beyond = apart.filter(F.col("block_number") > last).limit(1).count()      # nothing is left behind the last window
    return done.select("account_address", "contract_address", "updated_at", F.lit(1 - beyond).alias("last_window"))


@query("account_contract_catch_up", with_(MOVES) + f"""
SELECT a AS account_address, c AS contract_address, max(ts) AS timestamp
FROM (SELECT f AS a, c, ts, b FROM items UNION ALL SELECT t, c, ts, b FROM items)
WHERE a <> '{ZERO}' AND b > 1000 AND b <= 9000 GROUP BY 1, 2""".replace("items", "(SELECT * FROM moves WHERE ct IN (2, 3, 4, 5))"))
def account_contract_catch_up(spark, folder):
    rows = A.nft_rows(spark, folder).withColumn("is_token", F.lit(False))
    window = B.id_window(rows, 1000, 8000, by="block_number")
    return transfers.account_contracts(window, typed=False, exclude=K.ZERO_ONLY).drop("transfer_type")


# ---------------------------------------------------------------------------
# Scheduled jobs


@query("refine_range", with_(MOVES, _LOG, _CALLS) + _PLACES + """
UNION ALL SELECT 'calls', block_number, f, call_id FROM calls""")
def refine_range(spark, folder):
    path = scratch_path(spark, "range")
    lines = A.raw_block_lines(spark, folder).select(
        F.call_function("div", F.col("block_number"), F.lit(K.BLOCKS_PER_PARTITION)).cast("string").alias("bnp"), "value")
    L.write_raw_log(lines, f"{path}/log/topic=block")
    L.write_raw_log(A.trace_lines(spark, folder).select(F.lit("0").alias("bnp"), "value"), f"{path}/log/topic=trace")
    for _ in range(2):      # the second run replaces the first
        jobs.refine_range(spark, f"{path}/log", f"{path}/lake", 0, 100)
    out = None
    for label, name in ((lake.BLOCKS, "blocks"), (lake.TRANSACTIONS, "transactions"), (lake.LOGS, "event_logs")):
        part = _places(name, spark.read.parquet(f"{path}/lake/{label}"))
        out = part if out is None else out.unionByName(part)
    return out.unionByName(spark.read.parquet(f"{path}/lake/{lake.CALLS}").select(
        F.lit("calls").alias("name"), F.col("block_number").alias("number"), F.col("from_address").alias("hash"),
        F.col("call_id").cast("bigint").alias("place")))


_PERIODS = [p for d in ("19960101", "19960102", "19960205", "19960401") for p in jobs.due_periods(d)]


@query("calendar_jobs", with_(BLOCKS) + """
, days AS (SELECT strftime(make_timestamp(ts::BIGINT * 1000000), '%Y%m%d')::INT AS ymd, min(number) * 100 AS lo, max(number) * 100 AS hi
  FROM blocks GROUP BY 1), periods(kind, first, last) AS (VALUES """.replace("\n, days", ",\ndays")
       + ", ".join(f"('{k}', {a}, {b})" for k, a, b in _PERIODS) + """)
SELECT DISTINCT kind, first::VARCHAR AS first, last::VARCHAR AS last, unnest([(lo // 100000)::VARCHAR, (hi // 100000)::VARCHAR]) AS bnp
FROM periods JOIN days ON ymd BETWEEN first AND last""")
def calendar_jobs(spark, folder):
    days = B.block_date_map(A.blocks(spark, folder))
    wide = days.withColumns({n: F.col(n) * 100 for n in ("min_block_number", "max_block_number")})
    runs = []
    jobs.run_calendar(wide, ("19960101", "19960102", "19960205", "19960401"), lambda kind, first, last, bnps: runs.append(
        bnps.select(F.lit(kind).alias("kind"), F.lit(first).alias("first"), F.lit(last).alias("last"), "bnp")))
    out = runs[0]
    for part in runs[1:]:
        out = out.unionByName(part)
    return out


@query("restore_missing", with_(MOVES, _LOG) + """
, gone AS (SELECT DISTINCT b FROM moves WHERE b IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'P')),
thin AS (SELECT b FROM one GROUP BY b HAVING count(*) > 1 AND min(ti) = 1)
SELECT 'blocks' AS name, b AS number, '0x' || lpad(lower(to_hex(b)), 64, '0') AS hash, NULL::BIGINT AS place FROM gone
UNION ALL SELECT 'transactions', b, h, ti FROM one WHERE b IN (SELECT b FROM gone) OR (b IN (SELECT b FROM thin) AND ti = 1)
UNION ALL SELECT DISTINCT 'event_logs', b, h, li FROM moves WHERE b IN (SELECT b FROM gone)""".replace("\n, gone", ",\ngone"))
def restore_missing(spark, folder):
    # Parsed once, into the shared folder, where each use reads the columns it needs; held blocks are many times as large.
    path = scratch_path(spark, "restore")
    L.parse_blocks(A.raw_block_lines(spark, folder)).write.parquet(path)
    raw = spark.read.parquet(path)
    partly = A.table(spark, folder, "orders").filter("o_orderstatus = 'P'").select(F.col("o_orderkey").alias("number"))
    stored = quality.of_blocks(raw, partly, "blockNumber", inside=False)
    txs = refine.refine_transactions(stored).filter("transaction_index <> 1")
    alone = refine.refine_transactions(stored).groupBy("block_number").count().filter("count = 1").select("block_number")
    txs = txs.unionByName(refine.refine_transactions(stored).filter("transaction_index = 1").join(
        alone, "block_number", "left_semi"))
    newest = A.table(spark, folder, "orders").agg(F.max("o_orderkey")).first()[0]
    made = jobs.restore_missing(
        refine.refine_blocks(stored), txs, refine.refine_event_logs(stored), raw, 0, newest)
    out = None
    for name, df in made.items():
        part = _places(name, df)
        out = part if out is None else out.unionByName(part)
    return out


@query("approve_burn_range", with_(_APPROVED, MOVES, NFTS) + f"""
SELECT DISTINCT 'token_approvals' AS name, owner AS a, c AS b, spender AS c FROM e WHERE event_type IN ('click', 'view')
UNION ALL SELECT DISTINCT 'nft_approvals', owner, c, (cents % 5)::VARCHAR FROM e WHERE event_type = 'purchase'
UNION ALL SELECT DISTINCT 'operator_approvals', owner, c, spender FROM e WHERE event_type = 'signup'
UNION ALL SELECT 'token_burns', d, c, t FROM moves WHERE ct IN (0, 1, 127) AND t IN ({BURNS}) AND b >= 2000
UNION ALL SELECT 'nft_burns', d, c, t FROM nfts WHERE t IN ({BURNS}) AND b >= 2000""")
def approve_burn_range(spark, folder):
    columns = ["block_number", "transaction_hash", "transaction_index", "log_index", "address", "topics", "data", "timestamp"]
    logs = A.event_logs(spark, folder).select(*columns).unionByName(A.approval_logs(spark, folder).select(*columns))
    out = None
    third = {"token_approvals": "spender_address", "nft_approvals": "token_id", "operator_approvals": "operator_address"}
    for name, df in jobs.approve_burn_range(logs, A.contracts(spark, folder), 2000, 1 << 40).items():
        part = df.select(F.lit(name).alias("name"), F.col("owner_address" if name in third else "display_order").alias("a"),
                         F.col("contract_address").alias("b"), F.col(third.get(name, "to_address")).alias("c"))
        out = part if out is None else out.unionByName(part)
    return out


@query("make_accounts", with_(MOVES, TXS, _ACCOUNTS) + """
, kinds AS (SELECT a, first IS NOT NULL AS sca FROM seen LEFT JOIN made USING (a)),
failed AS (SELECT created AS a, arg_min(coalesce(err, 0), b * 10 + ti) AS err FROM txs WHERE creates GROUP BY 1)
SELECT 'eoa' AS name, 127 AS contract_type, count(*) AS rows FROM kinds WHERE NOT sca GROUP BY ALL
UNION ALL SELECT n, ct, count(*) FROM (SELECT CASE WHEN err = 0 THEN CASE k WHEN 4 THEN 2 WHEN 6 THEN 127 ELSE k END ELSE 127 END AS ct
  FROM failed JOIN (SELECT DISTINCT c, l_partkey % 7 AS k FROM moves) ON c = a), (VALUES ('sca'), ('contracts')) v(n)
GROUP BY ALL""".replace("\n, kinds", ",\nkinds"))
def make_accounts(spark, folder):
    made = jobs.make_accounts(A.transactions(spark, folder), A.event_logs(spark, folder), A.bytecode(spark, folder))
    out = None
    for name, df in made.items():
        part = df.groupBy(F.lit(name).alias("name"), F.col("contract_type").cast("int").alias("contract_type")).agg(
            F.count("*").alias("rows"))
        out = part if out is None else out.unionByName(part)
    return out


@query("holder_from_table", with_(MOVES, legs("moves", "amt")) + f"""
SELECT c AS contract_address, holder AS holder_address, {h64('sum(a)')} AS amount FROM legs
WHERE holder <> '{ZERO}' AND b >= 0 AND b < 10000 GROUP BY 1, 2""")
def holder_from_table(spark, folder):
    return jobs.holder_from_table(A.transfers(spark, folder), 0, 10000).select(
        "contract_address", "holder_address", "amount")


@query("holder_from_table_all", with_(MOVES, legs("moves", "amt")) + f"""
SELECT c AS contract_address, holder AS holder_address, {h64('sum(a)')} AS amount, max(ts) AS timestamp FROM legs
WHERE holder <> '{ZERO}' GROUP BY 1, 2""")
def holder_from_table_all(spark, folder):
    """All windows of the stored transfers, one after the other."""
    return jobs.rebuild_holders(A.transfers(spark, folder), -1, 4000, scratch_path(spark, "rebuilt")).select(
        "contract_address", "holder_address", "amount", "timestamp")
