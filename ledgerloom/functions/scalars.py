"""Ledger scalar functions as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, functions as F

from ledgerloom import constants as K
from ledgerloom.functions.hexnum import as_col, decimal_text_to_hex, hex_body, low_digits, pad_left


def div(value: Column, divisor: int) -> Column:
    """Whole-number division (towards zero)."""
    return F.call_function("div", value, F.lit(divisor))


def display_order(block: Column | str, tx: Column | str, log: Column | str) -> Column:
    """Fixed-width hex text whose text order is chain order."""
    def digits(value: Column | str, width: int) -> Column:
        return pad_left(F.lower(F.hex(as_col(value).cast("bigint"))), width)

    return F.concat(digits(block, 12), digits(tx, 5), digits(log, 5))


def block_partition(block: Column | str) -> Column:
    """The block-number partition (bnp) as text."""
    return div(as_col(block), K.BLOCKS_PER_PARTITION).cast("string")


def supply_order(supply: Column | str, decimals: Column | str) -> Column:
    """Total supply scaled to 50 decimals as 128 hex digits: text order is numeric order."""
    zeros = F.repeat(F.lit("0"), F.lit(50) - as_col(decimals).cast("int"))
    return decimal_text_to_hex(F.concat(as_col(supply).cast("string"), zeros), width=128)


def apply_decimals(raw: Column | str, decimals: Column | str) -> Column:
    """Raw amount (decimal text) with the point set ``decimals`` digits from the right."""
    places = as_col(decimals).cast("int")
    digits = as_col(raw).cast("string")
    padded = F.lpad(digits, F.greatest(F.length(digits), places + 1), F.lit("0"))
    whole = F.substring(padded, F.lit(1), F.length(padded) - places)
    fraction = F.substring(padded, F.length(padded) - places + 1, places)
    return F.when(places > 0, F.concat(whole, F.lit("."), fraction)).otherwise(digits)


def shard_of_block(block: Column | str, shards: int) -> Column:
    return (as_col(block) % shards).cast("int") + 1


def hex_mod(digits: Column, width: int, modulus: int) -> Column:
    """Hex digits modulo a small number, folded 24 bits at a time."""
    padded = low_digits(digits, -(-width // 6) * 6)
    parts = [
        F.conv(F.substring(padded, start, 6), 16, 10).cast("bigint")
        for start in range(1, -(-width // 6) * 6, 6)
    ]
    return reduce(lambda acc, part: (acc * (1 << 24) + part) % modulus, parts[1:], parts[0] % modulus).cast("int")


def shard_of_address(address: Column | str, shards: int) -> Column:
    return hex_mod(hex_body(address), 40, shards) + 1


def default_gas_price(block: Column | str, network: str = "mainnet") -> Column:
    """The unit price in force at a block, as decimal text."""
    number = as_col(block)
    expression: Column | None = None
    for last_block, price in K.GAS_PRICE_STEPS[network]:
        if last_block is None:
            return F.lit(price) if expression is None else expression.otherwise(price)
        condition = number <= last_block
        expression = F.when(condition, price) if expression is None else expression.when(condition, price)
    return expression


def is_burn(to_address: Column | str) -> Column:
    return as_col(to_address).isin(*K.BURN_ADDRESSES)


def is_mint(from_address: Column | str) -> Column:
    return as_col(from_address) == K.ZERO_ADDRESS


def is_zero_or_dead(address: Column | str) -> Column:
    return as_col(address).isin(*K.ZERO_OR_DEAD)


def create_method(input_data: Column | str) -> Column:
    """CREATE or CREATE2 by the first four bytes of the input, else null."""
    prefix = F.substring(as_col(input_data), 1, 10)
    return F.when(prefix == K.CREATE_PREFIX, "CREATE").when(prefix == K.CREATE2_PREFIX, "CREATE2")


def is_create(input_data: Column | str) -> Column:
    return F.coalesce(create_method(input_data).isNotNull(), F.lit(False))


def truncate_text(value: Column | str, limit: int) -> Column:
    return F.substring(as_col(value), 1, limit)


def truncate_symbol(value: Column | str) -> Column:
    return truncate_text(value, 50)


def truncate_uri(value: Column | str) -> Column:
    return truncate_text(value, 255)


def truncate_name(value: Column | str) -> Column:
    return truncate_text(value, 255)


def reverse_name_to_address(name: Column | str) -> Column:
    """``<hex>.addr.reverse`` as an address; null for any other name."""
    text = as_col(name)
    return F.when(
        text.contains(K.REVERSE_SUFFIX),
        F.concat(F.lit("0x"), F.replace(text, F.lit(K.REVERSE_SUFFIX), F.lit(""))),
    )


def has_name_suffix(name: Column | str, suffix: str) -> Column:
    return as_col(name).endswith(suffix)
