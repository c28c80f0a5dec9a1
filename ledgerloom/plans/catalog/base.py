"""Registry of the queries over the driver's tables, and the SQL they are checked with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerloom import constants as K

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with the SQL that has to give the same rows."""
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} exists already")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


# ---------------------------------------------------------------------------
# SQL fragments that mirror plans.adapters


def hx(number: str, width: int) -> str:
    return f"lpad(lower(to_hex(({number})::BIGINT)), {width}, '0')"


def addr(number: str) -> str:
    return (f"(CASE WHEN {number} = 1 THEN '{K.DEAD_ADDRESS}' WHEN {number} = 2 THEN "
            f"'{K.THIRD_BURN_ADDRESS}' ELSE '0x' || {hx(number, 40)} END)")


def con(number: str) -> str:
    return f"('0xc' || {hx(number, 39)})"


def ctype(part: str) -> str:
    return f"(CASE WHEN {part} % 7 = 6 THEN 127 ELSE {part} % 7 END)::INT"


def h64(number: str) -> str:
    """A HUGEINT in stored form, sign in front of the digits."""
    return (f"('0x' || lpad(CASE WHEN {number} < 0 THEN '-' || lower(to_hex(-({number})::HUGEINT)) "
            f"ELSE lower(to_hex(({number})::HUGEINT)) END, 64, '0'))")


ZERO = K.ZERO_ADDRESS
TWO_80 = 1 << 80
TWO_100 = 1 << 100
BURNS = ", ".join(f"'{a}'" for a in K.BURN_ADDRESSES)
ZERO_OR_DEAD = ", ".join(f"'{a}'" for a in K.ZERO_OR_DEAD)

# Every line item as a transfer, see adapters.transfers and adapters.nft_rows.
MOVES = f"""moves AS (
  SELECT {con('l_partkey')} AS c, {ctype('l_partkey')} AS ct,
    {addr('l_suppkey')} AS f, {addr('o_custkey')} AS t,
    l_quantity::HUGEINT * {TWO_80} + l_linenumber AS amt,
    {TWO_100}::HUGEINT + (l_orderkey * 7 + l_linenumber) % 1000 AS tok,
    CAST(epoch(o_orderdate) AS INT) AS ts, l_orderkey AS b, l_linenumber AS ti, l_partkey AS li,
    '0x' || {hx('l_orderkey * 8 + l_linenumber', 64)} AS h,
    {hx('l_orderkey', 12)} || {hx('l_linenumber', 5)} || {hx('l_partkey', 5)} AS d,
    l_returnflag AS rf, l_linestatus AS ls, l_partkey, l_suppkey, o_custkey, l_discount, l_tax,
    l_extendedprice, l_orderkey, l_linenumber
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

# Token transfers, and NFT transfers with one row per token id.
TOKENS = "tokens AS (SELECT * FROM moves WHERE ct IN (0, 1, 127))"
NFTS = """nfts AS (
  SELECT *, CASE WHEN ct IN (2, 4) THEN 1::HUGEINT ELSE amt END AS n, 0 AS item FROM moves
  WHERE ct IN (2, 3, 4, 5)
  UNION ALL
  SELECT * REPLACE (tok + 1 AS tok), amt + 1 AS n, 1 AS item FROM moves
  WHERE ct IN (3, 5) AND (rf = 'N' OR (rf = 'R' AND ls <> 'F')))"""
# One row per line item of an NFT contract (adapters.nft_rows, without batches).
ITEMS = """items AS (
  SELECT *, CASE WHEN ct IN (2, 4) THEN 1::HUGEINT ELSE amt END AS n FROM moves
  WHERE ct IN (2, 3, 4, 5))"""


def legs(source: str, amount: str, *columns: str) -> str:
    rest = "".join(f", {c}" for c in columns)
    return (f"legs AS (SELECT c, f AS holder, -({amount}) AS a, ts, b{rest} FROM {source} "
            f"UNION ALL SELECT c, t, {amount}, ts, b{rest} FROM {source})")


TXS = f"""txs AS (
  SELECT *, rf = 'R' AND ti = 1 AS creates,
    CASE WHEN rf = 'R' AND ti = 1 THEN c END AS created,
    CASE WHEN NOT (rf = 'R' AND ti = 1) THEN c END AS receiver, t AS sender,
    CASE WHEN rf = 'R' AND ti = 1
      THEN CASE WHEN l_partkey % 2 = 0 THEN '{K.CREATE_PREFIX}' ELSE '{K.CREATE2_PREFIX}' END || {hx('l_partkey', 8)}
      ELSE '0xa9059cbb' || {hx('l_suppkey', 64)} END AS input,
    CASE WHEN l_discount > 0.08 THEN 9 END AS err,
    CASE WHEN l_tax > 0.05 THEN '750000000000' ELSE '25000000000' END AS price
  FROM moves)"""

BLOCKS = f"""blocks AS (
  SELECT o_orderkey AS number, CAST(epoch(o_orderdate) AS INT) AS ts, {addr('o_custkey')} AS proposer,
    trunc(o_totalprice)::INT AS gas_used, o_custkey * 1000003 + 25000000000 AS base_fee
  FROM orders)"""
COUNTED = """counted AS (
  SELECT blocks.*, coalesce(n, 0)::INT AS tx_count FROM blocks
  LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON number = l_orderkey)"""


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
