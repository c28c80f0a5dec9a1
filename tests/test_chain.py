import json
import random

from pyspark.sql import functions as F

from ledgerloom import constants as K
from ledgerloom.functions import bytecode, dates
from ledgerloom.operators import blocks as B, calls, quality, refine
from ledgerloom.sources import logs as L


def _tx(block, index, logs=(), **extra):
    tx = dict(blockHash="0xb", blockNumber=hex(block), gas="0x10", gasUsed="0xff", logsBloom="0x", nonce="0x1",
              senderTxHash="0xs", signatures=[{"V": "0x1", "R": "0x2", "S": "0x3"}], status="0x1",
              transactionHash=f"0xt{block}-{index}", transactionIndex=hex(index), type="T", typeInt=1,
              logs=list(logs), **{"from": "0xfrom"})
    tx.update(extra)
    return tx


def _log(block, topics, data="0x", index=0):
    return dict(blockHash="0xb", blockNumber=hex(block), transactionHash="0xt", transactionIndex="0x0",
                address="0xc", topics=topics, data=data, logIndex=hex(index))


def _block(number, txs):
    return dict(blockNumber=number, result=dict(
        committee=["0x1"], extraData="0x", gasUsed="0x5", hash="0xh", logsBloom="0x", number=hex(number),
        parentHash="0xp", receiptsRoot="0xr", reward="0xw", size="0x9", stateRoot="0xs", timestamp="0x624988e7",
        timestampFoS="0x0", totalBlockScore="0x1", transactionsRoot="0xt", voteData="0x", transactions=txs))


def test_lines_that_do_not_decode_are_dropped(spark):
    good = _block(87100000, [_tx(87100000, 0, value="0x" + "f" * 40, txError="0x9"), _tx(87100000, 1)])
    no_hash = _block(5, [])
    del no_hash["result"]["hash"]
    bad_tx = _block(6, [_tx(6, 0)])
    del bad_tx["result"]["transactions"][0]["nonce"]
    lines = [json.dumps(b) for b in (good, no_hash, bad_tx)] + ["{broken", "", "[]"]
    raw = L.parse_blocks(spark.createDataFrame([(x,) for x in lines], "value string"))
    blocks = refine.refine_blocks(raw).collect()
    assert [(b.number, b.bnp, b.timestamp, b.transaction_count) for b in blocks] == [(87100000, "871", 1648986343, 2)]
    txs = {t.transaction_index: t for t in refine.refine_transactions(raw).collect()}
    assert txs[0].value == str(int("f" * 40, 16)) and txs[1].value is None
    assert txs[0].gas_price == "750000000000" and txs[0].tx_error == 9 and txs[1].tx_error is None
    assert txs[0].gas == 16 and txs[0].gas_used == 255 and txs[0].status


def test_transfer_counts_and_logs(spark):
    logs = [_log(7, [K.TOPIC_TRANSFER, "a", "b"]), _log(7, [K.TOPIC_TRANSFER, "a", "b", "c"], index=1),
            _log(7, [K.TOPIC_TRANSFER], index=2), _log(7, [], index=3), _log(7, [K.TOPIC_TRANSFER_BATCH], index=4)]
    raw = L.parse_blocks(spark.createDataFrame([(json.dumps(_block(7, [_tx(7, 0, logs, status="0x0")])),)], "value string"))
    row = refine.refine_transactions(raw).first()
    assert (row.token_transfer_count, row.nft_transfer_count) == (1, 2)
    out = refine.refine_event_logs(raw).collect()
    assert len(out) == 5 and not any(r.transaction_status for r in out)


def _tree(rng, depth):
    node = {"type": "CALL", "from": hex(rng.getrandbits(160)), "value": hex(rng.getrandbits(200)), "time": "1ms"}
    if depth and rng.random() < 0.8:
        node["calls"] = [_tree(rng, depth - 1) for _ in range(rng.randint(0, 3))]
    return node


def _numbered(tops):
    rows = []
    for index, top in enumerate(tops):
        counter = [0]

        def walk(node, parent, index=index, counter=counter):
            me = counter[0]
            counter[0] += 1
            rows.append((index, me, parent, node.get("from"), str(int(node["value"], 16)), node["time"] if me == 0 else None))
            for child in node.get("calls") or []:
                walk(child, me)

        walk(top, None)
    return sorted(rows, key=str)


def test_calls_are_numbered_depth_first(spark):
    rng = random.Random(5)
    deep = {"type": "CALL", "from": "0x1", "value": "0x1", "time": "2ms"}
    for _ in range(120):
        deep = {"type": "CALL", "from": "0x2", "value": "0x2", "time": "2ms", "calls": [deep]}
    tops = [_tree(rng, 6) for _ in range(15)] + [deep, {"type": "X", "from": None, "value": "0x0", "time": "t", "calls": None}]
    lines = [json.dumps({"blockNumber": 3, "result": tops}), "nope", json.dumps({"blockNumber": 4, "result": []})]
    flat = calls.flatten_calls(L.parse_traces(spark.createDataFrame([(x,) for x in lines], "value string")))
    got = sorted([(r["index"], r.call_id, r.parent_call_id, r.from_address, r.value, r.time) for r in flat.collect()], key=str)
    assert got == _numbered(tops)


def test_calls_of_any_depth_and_width(spark):
    lines, want = [], {}
    for k, depth in enumerate((480, 520, 2_000, 30_000)):
        chain = "".join(f'{{"from":"0x{d:x}","value":"0x0","calls":[' for d in range(depth)) + "]}" * depth
        lines.append(f'{{"blockNumber":{k},"result":[{chain}]}}')
        want[k] = [(d, d - 1 if d else None, f"0x{d:x}") for d in range(depth)]
    inner = ",".join(f'{{"calls":[],"from":"0x{d:x}"}}' for d in range(1, 16_001))
    lines.append(f'{{"result":[{{"calls" : [{inner}], "from":"0x0"}}], "blockNumber" : 9}}')
    want[9] = [(d, 0 if d else None, f"0x{d:x}") for d in range(16_001)]
    bad = ['{"blockNumber":1,"result":[{"calls":[{]}}]}', '{"blockNumber":1,"result":[{"a":1}', '{"blockNumber":"x","result":[]}',
           '{"blockNumber":1,"result":null}', '{"blockNumber":1,"result":[{"a":}]}', None, "", '{"result":[]}']
    source = spark.createDataFrame([(x,) for x in lines + bad], "value string")
    traces = L.parse_traces(source)
    got = {}
    for r in calls.flatten_calls(traces).select("block_number", "call_id", "parent_call_id", "from_address").collect():
        got.setdefault(r.block_number, []).append((r.call_id, r.parent_call_id, r.from_address))
    assert {k: sorted(v) for k, v in got.items()} == want
    assert tuple(L.decode_counts(source, traces).first()) == (len(lines) + len(bad), len(lines), len(bad))


def test_strings_do_not_open_calls(spark):
    top = {"from": "0x1", "input": '"calls":[{', "error": "a\\\"]}", "reverted": {"contract": "0x2", "message": "calls"},
           "calls": [{"to": "calls", "calls": None}, {"output": "[", "calls": [{"type": "}"}]}]}
    line = json.dumps({"blockNumber": 1, "result": [None, top]})
    rows = calls.flatten_calls(L.parse_traces(spark.createDataFrame([(line,)], "value string"))).orderBy("call_id").collect()
    assert [(r["index"], r.call_id, r.parent_call_id, r.to_address, r.output, r.type) for r in rows] == [
        (1, 0, None, None, None, None), (1, 1, 0, "calls", None, None), (1, 2, 0, None, "[", None), (1, 3, 2, None, None, "}")]
    assert rows[0].reverted.message == "calls" and rows[0].error == top["error"] and rows[0].input == top["input"]


def test_call_index(spark):
    rows = [(1, 0, 0, "0xaaa", "0xbbb"), (1, 0, 1, "0xaaa", "0xaaa"), (1, 0, 2, "0xaaa", None), (1, 0, 3, "0x", "0xbbb"),
            (1, 0, 4, None, "0xbbb"), (1, 0, 5, "0xaaa", "0x")]
    df = spark.createDataFrame(rows, "block_number long, index int, call_id int, from_address string, to_address string")
    got = sorted((r.internal_tx_id, r.account_address) for r in calls.index_calls_by_address(df).collect())
    assert got == [("1_0_0", "0xaaa"), ("1_0_0", "0xbbb"), ("1_0_1", "0xaaa"), ("1_0_2", "0xaaa"), ("1_0_5", "0xaaa")]


def test_gaps_against_brute_force(spark):
    rng = random.Random(6)
    have = set(range(32000, 34000)) | {rng.randint(30000, 140000) for _ in range(3000)}
    df = spark.createDataFrame([(n,) for n in have] + [(33000,)], "number long")
    got = {r.number for r in quality.missing_blocks(df, 31990, 100100).collect()}
    assert got == {n for n in range(31990, 100101) if n not in have}
    assert quality.missing_blocks(df.filter("number < 0"), 5, 7).count() == 3


def test_prefix_against_brute_force(spark):
    for last, gap in ((99990, 100005), (99990, 250000), (199990, 200000), (5, 6), (99990, 99999)):
        numbers = [n for n in range(last + 1, 250010) if n != gap]
        df = spark.createDataFrame([(n,) for n in numbers[:160000]] + [(last - 3,)], "number long")
        end = min(gap - 1, numbers[:160000][-1])
        got = B.contiguous_prefix(df, last).agg(F.count("*"), F.min("number"), F.max("number")).first()
        want = (end - last, last + 1 if end > last else None, end if end > last else None)
        assert tuple(got) == want, (last, gap)


def test_running_fees_over_partitions(spark):
    rng = random.Random(7)
    rows = [(n, 1600000000 + n, str(rng.getrandbits(60)), rng.randint(0, 30000000)) for n in range(99950, 100050)]
    df = spark.createDataFrame(rows, "number long, timestamp int, base_fee_per_gas string, gas_used int")
    out = {r.number: r for r in B.cumulative_burn(df, last=99949, seed=10 ** 25, balance=7).collect()}
    total = 10 ** 25
    for n, _, fee, gas in rows:
        total += int(fee) * gas // 2
        assert int(out[n].fees) == int(fee) * gas // 2 and int(out[n].accumulate_fees) == total
    hexed = B.burns_as_hex(B.cumulative_burn(df, 99949)).filter("number = 99950").first()
    assert int(hexed.fees, 16) == int(rows[0][2]) * rows[0][3] // 2 and len(hexed.fees) == 66


def test_dedup_cases(spark):
    def line(n, flag, time):
        return '{"blockNumber":%s,"x":"%s","time":"%s"}' % (n, flag, time)

    lines = [line(1, "a", "1"), line(1, "a", "1"),
             line(2, "a", "1"), line(2, "a", "22"),
             line(3, "a", "1"), line(3, "bbbb", "1"),
             line(4, "a", "1"), line(4, "b", "1"), line(4, "c", "1"), line(4, "c", "2"),
             line(100001, "a", "1"), "garbage", '{"blockNumber":x,"a":1}']
    got = sorted((r.bnp, r.value) for r in quality.dedup_log(spark.createDataFrame([(x,) for x in lines], "value string"), "0").collect())
    want = [("0", line(1, "a", "1")), ("0", line(2, "a", "1")), ("0", line(3, "a", "1")), ("0", "garbage"),
            ("0", '{"blockNumber":x,"a":1}')]
    want += [("dup-0", '{"blockNumber":4,"x":"%s",}' % f) for f in "abc"]
    assert got == sorted(want)


def _selectors(code):
    text = code[2:].strip()
    parts = [text[i:i + 2] for i in range(0, len(text), 2)]
    found, i = set(), 0
    while i < len(parts):
        if parts[i] == "63" and i + 5 < len(parts):
            found.add("0x" + "".join(parts[i + 1:i + 5]))
            i += 5
        elif parts[i] == "63":
            break
        else:
            i += 1
    return found


def test_selectors_against_brute_force(spark):
    rng = random.Random(8)
    codes = ["0x" + "".join(rng.choice(["63", "00", "60", "36", "3f", "7f"]) for _ in range(rng.randint(0, 60))) for _ in range(300)]
    codes += ["0x", "0x63", "0x6311223344", "0x631122334455", "0x6311223344f", "0x60631122334400", "0x0636311223344aa"]
    df = spark.createDataFrame([(c,) for c in codes], "code string")
    for r in df.select("code", bytecode.function_selectors("code").alias("s")).collect():
        assert set(r.s) == _selectors(r.code), r.code


def test_calendar():
    assert dates.previous_week("20240101") == ("20231225", "20231231")
    assert dates.previous_week("20240102") is None
    assert dates.previous_month("20240301") == ("20240201", "20240229")
    assert dates.days_between("20240228", "20240301") == ["20240228", "20240229", "20240301"]


def test_blocks_are_not_sent_whole_to_tasks(spark):
    """Blocks that an explode makes of few rows look small to Spark; rows per block partition are."""
    few = spark.range(400).select(F.explode(F.sequence(F.lit(0), F.lit(9))).alias("i"), "id").select(
        (F.col("id") * 10 + F.col("i")).alias("number"), F.lit(1).alias("timestamp"), F.lit("0x5").alias("burnt_fee"))
    burnt = B.cumulative_burn_from_rewards(few, few.select("number", "burnt_fee"), last=5)
    plan = burnt._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.splitlines() if "BroadcastHashJoin [" in line or "SortMergeJoin [" in line]
    assert any("SortMergeJoin [number" in line for line in joins)
    assert not any("[number" in line and "BroadcastHashJoin" in line for line in joins)
    assert not any("BuildLeft" in line for line in joins)
    assert burnt.count() == 4000 - 6
