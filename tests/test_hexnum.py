import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions import hexnum as H
from ledgerloom.functions import scalars as S

MAX = (1 << 256) - 1


def hex64(n):
    return "0x" + (("-" if n < 0 else "") + format(abs(n), "x")).rjust(64, "0")


def numbers(seed, count):
    rng = random.Random(seed)
    edge = [0, 1, 15, 16, (1 << 24) - 1, 1 << 24, (1 << 60) - 1, 1 << 60, (1 << 63) - 1, 1 << 63,
            (1 << 64) - 1, 1 << 120, (1 << 120) - 1, 1 << 128, MAX - 1, MAX]
    return edge + [rng.getrandbits(rng.randint(1, 256)) for _ in range(count)]


def test_to_decimal_and_back(spark):
    ns = numbers(1, 300)
    rows = [(str(n), hex64(n), format(n, "x")) for n in ns]
    df = spark.createDataFrame(rows, "d string, h string, raw string").select(
        "d", "h",
        H.hex_to_decimal_text("h").alias("a"),
        H.hex_to_decimal_text("raw").alias("b"),
        H.decimal_text_to_hex("d").alias("c"),
        H.decimal_text_to_hex("d", 128).alias("e"),
        H.to_hex64("raw").alias("f"),
    )
    for r in df.collect():
        assert r.a == r.d and r.b == r.d
        assert r.c == r.h and r.f == r.h
        assert r.e == "0x" + format(int(r.d), "x").rjust(128, "0")


def test_low_bits(spark):
    ns = numbers(2, 200)
    df = spark.createDataFrame([(format(n, "x"), "0x" + format(n, "x"), str(n)) for n in ns], "raw string, h string, d string")
    for r in df.select("d", H.hex_to_long("h").alias("l"), H.hex_to_int("raw").alias("i")).collect():
        n = int(r.d)
        low64, low32 = n % (1 << 64), n % (1 << 32)
        assert r.l == (low64 - (1 << 64) if low64 >= 1 << 63 else low64)
        assert r.i == (low32 - (1 << 32) if low32 >= 1 << 31 else low32)


def test_blank_forms(spark):
    df = spark.createDataFrame([("",), ("0x",), ("0x0",), ("000",), ("0x00ff",)], "h string")
    rows = df.select(
        "h", H.hex_to_int("h").alias("i"), H.hex_to_decimal_text("h").alias("d"),
        H.normalize_hex("h", True).alias("n"), H.to_address("h").alias("a"), H.to_hex64("h").alias("x"),
    ).collect()
    assert [r.i for r in rows] == [0, 0, 0, 0, 255]
    assert [r.d for r in rows] == ["0", "0", "0", "0", "255"]
    assert [r.n for r in rows] == ["0x0", "0x0", "0x0", "0x0", "0xff"]
    assert rows[4].a == "0x" + "ff".rjust(40, "0")
    assert rows[0].x == hex64(0)


def test_signed_sums_match_python(spark):
    rng = random.Random(3)
    rows, want = [], {}
    for _ in range(3000):
        key = rng.randint(0, 20)
        n = rng.getrandbits(rng.choice([8, 64, 130, 256])) * rng.choice([-1, 1])
        rows.append((key, hex64(n)))
        want[key] = want.get(key, 0) + n
    rows += [(99, hex64(5)), (99, hex64(-5)), (98, hex64(-1))]
    want.update({99: 0, 98: -1})
    df = spark.createDataFrame(rows, "k int, v string")
    got = {r.k: r for r in H.sum_hex(df, ["k"], "total", "v", F.count("*").alias("n"), signed=True).collect()}
    for key, total in want.items():
        assert got[key].total == hex64(total)
    signed = H.sum_hex(df, ["k"], "total", "v", signed=True).select("k", H.signed_hex_to_decimal_text("total").alias("d"))
    assert {r.k: int(r.d) for r in signed.collect() if abs(want[r.k]) < 1 << 256} == {
        k: v for k, v in want.items() if abs(v) < 1 << 256}


def test_add_negate_compare(spark):
    rows = [(hex64(7), hex64(-9)), (hex64(MAX), hex64(1)), (hex64(5), None), (hex64(0), hex64(0))]
    df = spark.createDataFrame(rows, "a string, b string")
    out = H.add_hex(df, "s", F.col("a"), F.col("b")).select(
        "s", H.negate_hex("s").alias("m"), H.is_positive("s").alias("p"), H.is_zero("s").alias("z")).collect()
    assert [r.s for r in out] == [hex64(-2), hex64(MAX + 1), hex64(5), hex64(0)]
    assert [r.m for r in out] == [hex64(2), hex64(-MAX - 1), hex64(-5), hex64(0)]
    assert [r.p for r in out] == [False, True, True, False]
    assert [r.z for r in out] == [False, False, False, True]


def test_scaled_decimals(spark):
    df = spark.createDataFrame([("1.5",), ("0.000001",), ("0x10",), ("",), ("12",), ("3.1234567891",)], "v string")
    got = [r.x for r in df.select(H.hex_or_decimal("v", 9).alias("x")).collect()]
    assert got == ["1500000000", "1000", "16", "0", "12000000000", "3123456789"]


def test_orders_and_shards(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 1 << 40), rng.randint(0, 5000), rng.randint(0, 5000),
             "0x" + format(rng.getrandbits(160), "040x"), str(rng.getrandbits(200)), rng.randint(0, 36))
            for _ in range(200)]
    df = spark.createDataFrame(rows, "b long, t int, l int, a string, s string, d int")
    got = df.select(
        S.display_order("b", "t", "l").alias("o"), S.block_partition("b").alias("p"),
        S.shard_of_block("b", 7).alias("sb"), S.shard_of_address("a", 10).alias("sa"),
        S.supply_order("s", "d").alias("so"), S.apply_decimals("s", "d").alias("ad"),
    ).collect()
    for (b, t, l, a, s, d), r in zip(rows, got):
        assert r.o == format(b, "012x") + format(t, "05x") + format(l, "05x")
        assert r.p == str(b // 100000) and r.sb == b % 7 + 1
        assert r.sa == int(a, 16) % 10 + 1
        assert r.so == "0x" + format(int(s) * 10 ** (50 - d), "0128x")
        whole, frac = divmod(int(s), 10 ** d)
        assert r.ad == (f"{whole}.{frac:0{d}d}" if d else s)


def test_decimals_to_hex(spark):
    ns = [n for n in numbers(5, 200) if n < 10 ** 38] + [10 ** 38 - 1, (1 << 64) * 3, (1 << 63) + 5]
    df = spark.createDataFrame([(str(n),) for n in ns], "d string")
    for r in df.select("d", H.decimal_to_hex64("d").alias("h")).collect():
        assert r.h == hex64(int(r.d))


def test_sums_past_256_bits(spark):
    """Merged balances keep the digits that a second merge would lose with 64 of them."""
    draw = random.Random(11)
    top = (1 << 256) - 1
    pairs = [(top, top), (2 * top, 1), (2 * top, -top), (-3 * top, 5 * top), ((1 << 299), -(1 << 280)), (0, 0)]
    pairs += [(draw.getrandbits(290) - (1 << 289), draw.getrandbits(270)) for _ in range(40)]
    rows = [(k, hex64(a), hex64(b)) for k, (a, b) in enumerate(pairs)]
    df = H.add_hex(spark.createDataFrame(rows, "k int, a string, b string"), "total", "a", "b")
    got = {r.k: r.total for r in df.collect()}
    assert all(got[k] == hex64(a + b) for k, (a, b) in enumerate(pairs))
    again = H.add_hex(df.withColumn("one", F.lit(hex64(1))), "more", "total", "one").collect()
    assert all(r.more == hex64(sum(pairs[r.k]) + 1) for r in again)
    texts = [0, 16 ** 64, 16 ** 75 - 1, *(abs(a) for a, _ in pairs)]
    out = spark.createDataFrame([(hex(x),) for x in texts], "x string").select(H.hex_to_decimal_text("x").alias("d")).collect()
    assert [int(r.d) for r in out] == texts


def test_numbers_of_any_length(spark):
    """Sums, additions and conversions next to Python's integers, 1 to 1,500 hex digits, both signs, in one column."""
    draw = random.Random(17)
    sizes = [1, 20, 59, 60, 61, 64, 66, 67, 75, 76, 119, 120, 121, 128, 240, 1000, 1500]
    numbers = [draw.getrandbits(4 * draw.choice(sizes)) * draw.choice([1, 1, -1]) for _ in range(1500)]
    numbers += [16 ** n - d for n in sizes for d in (0, 1)] + [-(16 ** n) for n in sizes] + [0, 0]
    rows = [(k % 23, k, hex64(n)) for k, n in enumerate(numbers)]
    # Keys whose long parts cancel out, and a null.
    rows += [(50, 0, hex64(16 ** 400)), (50, 1, hex64(-(16 ** 400))), (51, 0, hex64(16 ** 130 + 5)), (51, 1, hex64(-(16 ** 130))),
             (52, 0, None), (52, 1, hex64(16 ** 90)), (53, 0, hex64(-1)), (53, 1, hex64(16 ** 300)), (54, 0, "0x" + "0" * 500 + "7")]
    want = {}
    for key, _, text in rows:
        want[key] = want.get(key, 0) + (int(text[2:].lstrip("0") or "0", 16) if text else 0)
    df = spark.createDataFrame(rows, "k int, i int, v string").repartition(5)
    got = H.sum_hex(df, ["k"], "total", "v", F.count("*").alias("n"), F.max("i").alias("last"), signed=True).collect()
    assert {r.k: r.total for r in got} == {k: hex64(v) for k, v in want.items()}
    assert {r.k: (r.n, r.last) for r in got} == {
        key: (sum(k == key for k, _, _ in rows), max(i for k, i, _ in rows if k == key)) for key in want}
    decimals = H.sum_hex(df, ["k"], "total", "v", signed=True).select("k", H.signed_hex_to_decimal_text("total").alias("d"))
    assert {r.k: int(r.d) for r in decimals.collect()} == want
    pairs = [(k, hex64(a), hex64(b)) for k, (a, b) in enumerate(zip(numbers, reversed(numbers)))]
    out = H.add_hex(spark.createDataFrame(pairs, "k int, a string, b string"), "s", "a", "b").collect()
    assert {r.k: r.s for r in out} == {k: hex64(a + b) for k, (a, b) in enumerate(zip(numbers, reversed(numbers)))}
    assert out[0].__fields__ == ["k", "a", "b", "s"]


def test_decimal_text_of_very_long_data(spark):
    draw = random.Random(18)
    numbers = [0, 1, 16 ** 75 - 1, 16 ** 75, 16 ** 76 + 3, draw.getrandbits(4000), draw.getrandbits(400_000)]
    df = spark.createDataFrame([(k, hex(n)) for k, n in enumerate(numbers)], "k int, v string")
    got = {r.k: r.d for r in df.select("k", H.any_hex_to_decimal_text("v").alias("d")).collect()}
    import sys
    sys.set_int_max_str_digits(0)
    assert got == {k: str(n) for k, n in enumerate(numbers)}
    short = df.filter("k < 6").select("k", H.hex_to_decimal_text("v").alias("d"))
    assert {r.k: r.d for r in short.collect()} == {k: str(n) for k, n in enumerate(numbers[:6])}


def test_too_many_decimal_digits_raise(spark):
    nines = spark.createDataFrame([("9" * 200,)], "x string")
    with pytest.raises(Exception, match="digits"):
        nines.select(H.decimal_text_to_hex("x")).collect()


def _largest_method(df, capfd):
    capfd.readouterr()
    df.explain("codegen")
    return max(int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capfd.readouterr().out))


def test_carried_sums_are_compiled(spark, capfd):
    """The JVM interprets methods of more than 8,000 bytes, which takes several times as long for every row."""
    df = spark.createDataFrame([("a", hex64(5), hex64(-7))], "k string, v string, x string").repartition(2)
    sums = H.sum_hex(df, ["k"], "v", "v", signed=True)
    wrong = sums.select("k", H.to_hex64("v").alias("v")).filter(F.col("v") != hex64(1))
    assert wrong.collect() == [("a", hex64(5))]
    spark.conf.set("spark.sql.adaptive.enabled", "false")      # the plan with its code is there before a run
    try:
        sums = H.sum_hex(df, ["k"], "v", "v", signed=True)
        assert _largest_method(sums.filter(H.is_positive("v")), capfd) < 8000
        assert _largest_method(sums.select("k", H.to_hex64("v").alias("v")).filter(F.col("v") != hex64(1)), capfd) < 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
