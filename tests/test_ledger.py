import random

from pyspark.sql import functions as F

from ledgerloom import constants as K
from ledgerloom.functions import hexnum as H
from ledgerloom.operators import accounts, approvals, decode, holders, merges, nft_items, transfers, uris
from ledgerloom.plans import jobs
from ledgerloom.session import scratch_path


def hex64(n):
    return "0x" + (("-" if n < 0 else "") + format(abs(n), "x")).rjust(64, "0")


def w(n):
    return format(n, "064x")


def a(n):
    return "0x" + format(n, "040x")


def topic(n):
    return "0x" + w(n)


LOG = ("address string, topics array<string>, data string, block_number long, transaction_index int, log_index int, "
       "timestamp int, transaction_hash string, transaction_status boolean")


def logs(spark, rows):
    full = [("0xc", t, d, 100, 1, i, 50, "0xt", True) for i, (t, d) in enumerate(rows)]
    return spark.createDataFrame(full, LOG)


def batch(ids, amounts, head=()):
    first = 32 * (len(head) + 2)
    second = first + 32 * (len(ids) + 1)
    body = [w(h) for h in head] + [w(first), w(second), w(len(ids)), *map(w, ids), w(len(amounts)), *map(w, amounts)]
    return "0x" + "".join(body)


def test_nft_layouts(spark):
    big = (1 << 256) - 1
    rows = [
        ([K.TOPIC_TRANSFER, topic(1), topic(2), topic(big)], "0x"),
        ([K.TOPIC_LEGACY_NFT_TRANSFER, topic(3), topic(4), topic(9)], "0x"),
        ([K.TOPIC_TRANSFER_SINGLE, topic(0), topic(5), topic(6)], "0x" + w(big) + w(big - 1)),
        ([K.TOPIC_TRANSFER_SINGLE], "0x" + w(0) + w(7) + w(8) + w(11) + w(12)),
        ([K.TOPIC_TRANSFER_SINGLE], "0x" + w(0) + w(7)),
        ([K.TOPIC_TRANSFER_BATCH, topic(0), topic(5), topic(6)], batch([1, 2, 3], [4, 5, big])),
        ([K.TOPIC_TRANSFER_BATCH, topic(0), topic(5), topic(6)], batch([], [])),
        ([K.TOPIC_TRANSFER_BATCH], batch([21], [22], head=(0, 9, 10))),
        ([K.TOPIC_TRANSFER_BATCH, topic(0), topic(5), topic(6)], "0x" + w(64) + w(1 << 200) + w(99999999)),
        ([K.TOPIC_TRANSFER_BATCH, topic(0), topic(5), topic(6)], "0x" + w(64) + w(96) + w(10 ** 9) + w(10 ** 9)),
        ([K.TOPIC_TRANSFER, topic(1), topic(2)], "0x" + w(5)),
    ]
    got = sorted((r.display_order[-5:], r.item_index, r.from_address, r.to_address, r.token_id, r.token_count)
                 for r in decode.nft_transfers(logs(spark, rows)).collect())
    want = [
        ("00000", 0, a(1), a(2), str(big), hex64(1)), ("00001", 0, a(3), a(4), "9", hex64(1)),
        ("00002", 0, a(5), a(6), str(big), hex64(big - 1)), ("00003", 0, a(7), a(8), "11", hex64(12)),
        ("00005", 0, a(5), a(6), "1", hex64(4)), ("00005", 1, a(5), a(6), "2", hex64(5)),
        ("00005", 2, a(5), a(6), "3", hex64(big)), ("00007", 0, a(9), a(10), "21", hex64(22)),
    ]
    assert got == sorted(want)
    tokens = decode.token_transfers(logs(spark, rows)).collect()
    assert [(t.from_address, t.to_address, t.amount) for t in tokens] == [(a(1), a(2), hex64(5))]


def test_deposit_holder_forms(spark):
    rows = [([K.TOPIC_DEPOSIT, topic(5)], "0x" + w(1)), ([K.TOPIC_WITHDRAWAL], "0x" + w(6) + w(1)),
            ([K.TOPIC_DEPOSIT, topic(7), topic(8)], "0x"), ([K.TOPIC_DEPOSIT, topic(7), topic(8), topic(9)], "0x"),
            ([K.TOPIC_TRANSFER, topic(7), topic(8)], "0x" + w(1))]
    types = spark.createDataFrame([("0xc", K.TYPE_KIP7)], "contract_address string, contract_type int")
    got = transfers.deposit_withdraw_holders(logs(spark, rows), types)
    assert sorted(r.holder_address for r in got.collect()) == [a(5), a(6), a(7)]
    assert transfers.deposit_withdraw_holders(logs(spark, rows), types.filter("contract_type = 2")).count() == 0


def _transfers(spark, rows):
    return spark.createDataFrame(
        [("0xc", f, t, hex64(n), ts, b) for f, t, n, ts, b in rows],
        "contract_address string, from_address string, to_address string, amount string, timestamp int, block_number long")


def test_balance_deltas(spark):
    big = (1 << 255) + 12345
    rows = [(K.ZERO_ADDRESS, a(8), big, 10, 1), (a(8), a(9), 5, 11, 2), (a(9), a(9), 7, 30, 3),
            (a(9), K.DEAD_ADDRESS, 1, 12, 4), (a(9), K.ZERO_ADDRESS, 1, 13, 5), (a(9), K.THIRD_BURN_ADDRESS, 1, 14, 6)]
    got = {r.holder_address: (r.amount, r.timestamp, r.block_number)
           for r in holders.token_balance_deltas(_transfers(spark, rows)).collect()}
    assert got == {a(8): (hex64(big - 5), 11, 2), a(9): (hex64(2), 30, 6), K.DEAD_ADDRESS: (hex64(1), 12, 4),
                   K.THIRD_BURN_ADDRESS: (hex64(1), 14, 6)}
    alive = holders.token_balance_deltas(_transfers(spark, rows), K.ZERO_OR_DEAD)
    assert {r.holder_address for r in alive.collect()} == {a(8), a(9), K.THIRD_BURN_ADDRESS}


def test_legs_cancel_out(spark):
    rng = random.Random(9)
    rows = [(a(rng.randint(0, 9)), a(rng.randint(0, 9)), rng.getrandbits(250), 1, 1) for _ in range(500)]
    total = H.sum_hex(holders.token_balance_deltas(_transfers(spark, rows), ("none",)), ["contract_address"], "s",
                      "amount", signed=True)
    assert total.first().s == hex64(0)


def test_holder_merge_actions(spark):
    schema = "contract_address string, holder_address string, amount string, timestamp int"
    current = spark.createDataFrame([("0xc", h, hex64(n), 100) for h, n in
                                     (("keep", 5), ("up", 5), ("gone", 5), ("saved", 5), ("zeroed", 5))], schema)
    deltas = spark.createDataFrame(
        [("0xc", h, hex64(n), ts, 9) for h, n, ts in (("up", 3, 90), ("gone", -9, 200), ("saved", -5, 200),
                                                      ("zeroed", -6, 200), ("new", 4, 7), ("ghost", -4, 7), ("nil", 0, 7))],
        schema + ", block_number long")
    proof = spark.createDataFrame([("0xc", "saved", "0x11"), ("0xc", "zeroed", "0x0"), ("0xc", "up", "0x99")],
                                  "contract_address string, holder_address string, amount string")
    merged = holders.holder_merge(current, deltas, proof)
    got = {r.holder_address: (r.action, r.amount, r.timestamp) for r in merged.collect()}
    assert got["keep"] == ("keep", hex64(5), 100)
    assert got["up"] == ("update", hex64(8), 100)
    assert got["saved"] == ("update", hex64(17), 200)
    assert got["new"] == ("insert", hex64(4), 7)
    assert {h: got[h][0] for h in ("gone", "zeroed", "ghost", "nil")} == {
        "gone": "delete", "zeroed": "delete", "ghost": "ignore", "nil": "ignore"}
    assert {r.holder_address for r in holders.apply_merge(merged).collect()} == {"keep", "up", "saved", "new"}
    assert tuple(holders.holder_count_changes(merged).first()) == ("0xc", 1, 2, -1)


def test_balance_at_against_brute_force(spark):
    rng = random.Random(10)
    history = {(f"h{rng.randint(0, 3)}", rng.randint(0, 500000)): str(i) for i in range(200)}
    asks = [(f"h{rng.randint(0, 4)}", rng.randint(0, 500000)) for _ in range(200)] + list(history)[:20]
    past = spark.createDataFrame([("c", h, b, v) for (h, b), v in history.items()],
                                 "contract_address string, holder_address string, block_number long, amount string")
    asked = spark.createDataFrame([("c", h, b) for h, b in asks], "contract_address string, holder_address string, block_number long")
    got = sorted((r.holder_address, r.block_number, str(r.amount)) for r in holders.balance_at(asked, past).collect())
    want = []
    for h, b in asks:
        older = [(x, v) for (k, x), v in history.items() if k == h and x <= b]
        want.append((h, b, str(max(older)[1]) if older else "None"))
    assert got == sorted(want)


def test_inventory_apply(spark):
    have = spark.createDataFrame([("c", "h", "1", 5), ("c", "h", "2", 5)], "contract_address string, holder_address string, token_id string, timestamp int")
    moves = spark.createDataFrame([("c", "h", "1", True, 9), ("c", "h", "2", False, 9), ("c", "g", "1", False, 9)],
                                  "contract_address string, holder_address string, token_id string, is_send boolean, timestamp int")
    got = sorted(tuple(r) for r in holders.inventory_apply(have, moves).collect())
    assert got == [("c", "g", "1", 9), ("c", "h", "2", 5)]


def _approval(spark, rows):
    return spark.createDataFrame([("0xc", [K.TOPIC_APPROVAL, topic(o), topic(s)], "0x" + w(n), b, t, g, b, f"0x{b}-{t}-{g}", True)
                                  for o, s, n, b, t, g in rows], LOG)


def test_approval_tie_rule(spark):
    rows = [(5, 6, 1, 10, 9, 9), (5, 6, 2, 20, 3, 1), (5, 6, 3, 20, 2, 8), (5, 6, 4, 20, 2, 9), (7, 6, 9, 5, 1, 1), (7, 6, 0, 6, 1, 1)]
    df = _approval(spark, rows)
    first = {r.owner_address: (r.amount, r.action) for r in approvals.latest_token_approvals(df).collect()}
    assert first == {a(5): (hex64(3), "insert"), a(7): (hex64(0), "skip")}
    last = {r.owner_address: r.amount for r in approvals.latest_token_approvals(df, tie="last").collect()}
    assert last[a(5)] == hex64(2)


def test_accounts(spark):
    tx = "block_number long, transaction_index int, transaction_hash string, from_address string, to_address string, contract_address string, input string, timestamp int, tx_error int"
    txs = spark.createDataFrame([(1, 0, "t1", "alice", "bob", None, None, 1, None), (2, 0, "t2", "alice", None, "made", None, 2, 7),
                                 (1, 5, "t0", "carol", None, "made", "0x60", 1, None)], tx)
    rows = [([K.TOPIC_TRANSFER, topic(1), topic(2)], "0x" + w(1)), ([K.TOPIC_UPGRADED, topic(3)], "0x")]
    ok = logs(spark, rows).withColumn("address", F.when(F.col("log_index") == 1, "proxy").otherwise("0xc"))
    failed = logs(spark, [([K.TOPIC_TRANSFER, topic(8), topic(9)], "0x" + w(1))]).withColumn("transaction_status", F.lit(False))
    got = {r.address: r for r in accounts.classify_accounts(txs, ok.unionByName(failed)).collect()}
    assert set(got) == {"alice", "bob", "carol", "made", a(1), a(2)}
    assert got["alice"].transactions == 2 and got["made"].account_type == 1
    assert got["made"].creator.transaction_hash == "t0" and got["made"].creator.input == "0x60"


def test_merges(spark):
    target = spark.createDataFrame([("k1", 5, "old"), ("k2", 5, "old"), ("k3", 5, "old")], "k string, ts int, v string")
    source = spark.createDataFrame([("k1", 5, "tie"), ("k2", 6, "new"), ("k4", 1, "new"), ("k4", 0, "older")], "k string, ts int, v string")
    got = {r.k: r.v for r in merges.upsert_newest(target, source, ["k"], "ts").collect()}
    assert got == {"k1": "old", "k2": "new", "k3": "old", "k4": "new"}
    assert [r.k for r in merges.insert_ignore(target, source, ["k"]).collect()] == ["k4"]
    deltas = spark.createDataFrame([("k1", 2), ("k1", 3), ("k9", 1)], "k string, ts int")
    assert {r.k: r.ts for r in merges.increment(target, deltas, "k", "ts").collect()} == {"k1": 10, "k2": 5, "k3": 5}
    timed = spark.createDataFrame([("k1", 9, 1), ("k1", 2, 7), ("k1", 3, 4)], "k string, ts int, at int")
    assert {r.k: r.ts for r in merges.increment(target, timed, "k", "ts", replace_by="at").collect()} == {"k1": 2, "k2": 5, "k3": 5}
    new = spark.createDataFrame([("k5", 2, "b"), ("k5", 1, "c"), ("k6", 3, "a"), ("k1", 1, "x")], "k string, ts int, v string")
    assert {r.k: (r.ts, r.v) for r in merges.insert_ignore(target, new, ["k"], order=["ts"]).collect()} == {"k5": (1, "c"), "k6": (3, "a")}
    again = [merges.insert_ignore(target, new.repartition(n), ["k"], stored=F.col("k") < "k9").collect() for n in (1, 4)]
    assert sorted(again[0]) == sorted(again[1]) and len(again[0]) == 2


def test_item_upsert(spark):
    schema = "contract_address string, contract_type int, token_id string, total_transfer long"
    stored = spark.createDataFrame([("c", 2, "1", 5), ("c", 2, "9", 1)], schema)
    new = spark.createDataFrame([("c", 2, "1", 2), ("c", 2, "2", 3), ("m", 3, "1", 4)], schema)
    got = {(r.contract_address, r.token_id): r.total_transfer for r in nft_items.upsert_item_transfers(stored, new).collect()}
    assert got == {("c", "1"): 7, ("c", "9"): 1, ("c", "2"): 0, ("m", "1"): 4}


def test_uri_order(spark):
    tokens = spark.createDataFrame([("c", "1"), ("c", "2"), ("d", "1")], "contract_address string, token_id string")
    stored = spark.createDataFrame([("c", "1", "u1")], "contract_address string, token_id string, token_uri string")
    patterns = spark.createDataFrame([("c", "p/{id}/x")], "contract_address string, pattern string")
    got = {(r.contract_address, r.token_id): r.token_uri for r in uris.token_uri(tokens, stored, patterns).collect()}
    assert got == {("c", "1"): "u1", ("c", "2"): "p/2/x", ("d", "1"): "-"}


def test_holders_rebuilt_many_windows_to_a_job(spark, tmp_path):
    draw = random.Random(4)
    blocks = [b for b in range(400) if b % 50 < 20] + [5_000 + k for k in range(30)]
    rows = [(f"c{b % 3}", a(draw.randint(0, 4)), a(draw.randint(0, 4)), hex64(draw.randint(1, 9)), b, b) for b in blocks * 2]
    moved = spark.createDataFrame(
        rows, "contract_address string, from_address string, to_address string, amount string, timestamp int, block_number long")
    want = sorted(map(tuple, holders.token_balance_deltas(moved).collect()))
    held = lambda df: sorted(map(tuple, df.select(*holders.token_balance_deltas(moved).columns).collect()))
    for at_once, jobs_run in ((1, 28), (8, 6), (1024, 1)):
        folder = tmp_path / str(at_once)
        assert held(jobs.rebuild_holders(moved, -1, 10, str(folder), at_once)) == want
        made = sorted(p.name for p in folder.iterdir())
        assert len(made) <= jobs_run and (at_once < 1024 or len(made) == 1)
        # one part for every window that holds rows
        assert len(list(folder.glob("*/window=*"))) >= 19
    assert jobs.rebuild_holders(moved, 1 << 40, 10, str(tmp_path / "none")).count() == 0

def test_catch_up_follows_windows_in_order(spark, monkeypatch):
    """Many windows by one job leave what one window after the other does, whatever their borders and gaps."""
    draw = random.Random(4)
    rows = [(draw.choice("abc"), draw.choice("abc"), draw.choice(["p", "q", None]), draw.random() < 0.5,
             draw.choice([None, *range(6)]), n) for n in [*range(3, 60, 2), *range(500, 540), 9000, 9007] for _ in range(2)]
    t = spark.createDataFrame(rows, "from_address string, to_address string, contract_address string, is_token boolean, "
                                    "timestamp int, block_number bigint")
    start = spark.createDataFrame([("a", "p", 0, 1, 4), ("b", "q", 1, 2, None)],
                                  "account_address string, contract_address string, transfer_type int, created_at int, updated_at int")
    size, want, alone = 7, start, 0
    for alone, (_, last, window) in enumerate(jobs.windows(t, 4, size, "block_number"), 1):
        want = transfers.merge_account_contracts(
            want, transfers.account_contracts(window, typed=False, exclude=K.ZERO_ONLY)).localCheckpoint()
    made = []
    merge = transfers.merge_account_contracts
    monkeypatch.setattr(jobs.transfers, "merge_account_contracts", lambda *a: made.append(1) or merge(*a))
    for at_once in (3, 1024):
        done, end = jobs.catch_up_account_contracts(t, start, 4, size, scratch_path(spark, "catch-up"), at_once=at_once)
        assert end == last
        assert sorted(map(str, done.select(want.columns).collect())) == sorted(map(str, want.collect()))
    assert len(made) == -(-alone // 3) + 1
