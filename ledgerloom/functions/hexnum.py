"""256-bit hex numbers as Spark column expressions.

Amounts are stored as ``0x`` plus 64 hex digits and exceed every Spark numeric
type. They are summed as eleven 24-bit limbs held in BIGINT columns, which keeps
``groupBy().agg(sum)`` with its map-side combine; a limb sum stays inside BIGINT
for 2**39 rows of one key. ``collapse_limbs`` carries the sums back into hex text.
Numbers beyond 264 bits, which any contract can log, become several rows of 60 digits each
(``split_blocks``): their length is data, and one more group key is all that others notice.
A negative number is written with the sign in front of its digits
(``0x000...-1a``), the way stored tables hold it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

LIMB_DIGITS = 6
LIMB_BITS = 4 * LIMB_DIGITS
LIMBS = 11
_MASK = (1 << LIMB_BITS) - 1


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def hex_body(value: Column | str) -> Column:
    """The digits without the ``0x`` prefix."""
    c = as_col(value)
    return F.when(c.startswith("0x"), F.substring(c, 3, 1 << 30)).otherwise(c)


def low_digits(digits: Column, width: int) -> Column:
    """The lowest ``width`` hex digits, zero-padded on the left."""
    return F.substring(F.concat(F.lit("0" * width), digits), -width, width)


def _is_negative(value: Column | str) -> Column:
    return as_col(value).contains("-")


def _magnitude(value: Column | str) -> Column:
    c = as_col(value)
    return F.when(_is_negative(c), F.substring_index(c, "-", -1)).otherwise(hex_body(c))


def _conv(digits: Column) -> Column:
    """Up to 15 hex digits as a non-negative BIGINT."""
    return F.conv(digits, 16, 10).cast("bigint")


def hex_to_long(value: Column | str) -> Column:
    """The low 64 bits as a signed BIGINT; empty text is 0."""
    digits = low_digits(hex_body(value), 16)
    high, low = _conv(F.substring(digits, 1, 8)), _conv(F.substring(digits, 9, 8))
    return F.shiftleft(high, 32).bitwiseOR(low)


def hex_to_int(value: Column | str) -> Column:
    """The low 32 bits as a signed INT; empty text is 0."""
    low = _conv(low_digits(hex_body(value), 8))
    return F.shiftright(F.shiftleft(low, 32), 32).cast("int")


def normalize_hex(value: Column | str, with_prefix: bool = False) -> Column:
    """Without prefix and leading zeros; zero and empty text are ``0``."""
    stripped = F.ltrim(hex_body(value), F.lit("0"))
    digits = F.when(stripped == "", "0").otherwise(stripped)
    return F.concat(F.lit("0x"), digits) if with_prefix else digits


def pad_left(value: Column, width: int) -> Column:
    """Zero-pad to ``width``; longer text is kept whole (lpad would cut it)."""
    return F.lpad(value, F.greatest(F.length(value), F.lit(width)), F.lit("0"))


def to_address(value: Column | str) -> Column:
    """A 32-byte word or any hex number as a 20-byte address."""
    return F.concat(F.lit("0x"), pad_left(normalize_hex(value), 40))


def to_hex64(value: Column | str) -> Column:
    """Canonical ``0x`` + 64 digits of a hex number, sign kept."""
    return _to_hex(value, 64)


def to_hex128(value: Column | str) -> Column:
    return _to_hex(value, 128)


def _to_hex(value: Column | str, width: int) -> Column:
    stripped = F.lower(F.ltrim(_magnitude(value), F.lit("0")))
    signed = F.when(_is_negative(value) & (stripped != ""), F.concat(F.lit("-"), stripped))
    return F.concat(F.lit("0x"), pad_left(signed.otherwise(stripped), width))


def is_zero(value: Column | str) -> Column:
    return F.ltrim(_magnitude(value), F.lit("0")) == ""


def is_positive(value: Column | str) -> Column:
    return ~_is_negative(value) & ~is_zero(value)


def long_to_hex64(value: Column | str) -> Column:
    """A non-negative BIGINT as ``0x`` + 64 digits."""
    return F.concat(F.lit("0x"), F.lpad(F.lower(F.hex(as_col(value))), 64, "0"))


# ---------------------------------------------------------------------------
# Limb sums. The limb work is written as SQL text: it is the same few dozen
# expressions every time, and text is planned much faster than as many calls.

_PAIRS = -(-LIMBS // 2)
_PAIR_DIGITS = 2 * LIMB_DIGITS
_TOP_DIGITS = 64 - (_PAIRS - 1) * _PAIR_DIGITS


# One row of limbs holds up to this many hex digits (300 bits), as sums of 256-bit numbers need them.
MOST_DIGITS = (_PAIRS - 1) * _PAIR_DIGITS + 15
# A longer number is cut into blocks of ten limbs; one that fits into the limbs without a wide top limb is left whole.
BLOCK_DIGITS = (LIMBS - 1) * LIMB_DIGITS
PLAIN_DIGITS = LIMBS * LIMB_DIGITS


def canonical(value: Column | str) -> Column:
    """An unsigned hex number as ``0x`` + 64 digits; a longer one keeps all its digits."""
    c = as_col(value)
    padded = F.concat(F.lit("0x"), pad_left(F.ltrim(hex_body(c), F.lit("0")), 64))
    return F.when((F.octet_length(c) == 66) & c.startswith("0x"), c).otherwise(padded)


def low_word(value: Column | str) -> Column:
    """The low 256 bits as exactly ``0x`` + 64 digits: how a word of event data reads, whatever stands before it."""
    c = as_col(value)
    padded = F.concat(F.lit("0x"), low_digits(hex_body(c), 64))
    return F.when((F.octet_length(c) == 66) & c.startswith("0x"), c).otherwise(padded)


def _pair_names(name: str) -> list[str]:
    return [f"{name}__p{i}" for i in range(_PAIRS)]


def _limb_names(name: str) -> list[str]:
    return [f"{name}__l{i}" for i in range(LIMBS)]


def computed_once(df: DataFrame, kept: Sequence[str], derived: dict[str, Column | str]) -> DataFrame:
    """Select columns plus expressions (SQL text or Columns) that later steps must not
    take apart.

    A filter on a projected column is pushed below the projection with the whole
    expression in its place, once per use. Long expressions that build on each other
    multiply that way; a generator is not passed through. Filters on ``kept`` columns
    still reach the source.
    """
    fields = [(F.expr(e) if isinstance(e, str) else e).alias(name) for name, e in derived.items()]
    return df.select(*[F.col(f"`{c}`") for c in kept], F.inline(F.array(F.struct(*fields))))


def split_limbs(df: DataFrame, name: str, value: Column | str, signed: bool = False) -> DataFrame:
    """Add the hex column ``value`` as BIGINT parts of two limbs each, lowest first.

    Nearly all amounts stay below 96 bits; then one prefix compare settles the
    upper parts. ``signed`` also accepts a minus sign in front of the digits. The top
    part holds whatever is left of a number above 256 bits, as sums of them can be; of a number
    beyond MOST_DIGITS all parts are null (see ``split_blocks`` and ``add_hex``).
    """
    text, minus = f"{name}__text", f"{name}__minus"
    c = as_col(value)
    kept = df.columns
    if signed:
        df = df.withColumns({
            minus: c.contains("-"),
            text: canonical(F.when(c.contains("-"), F.substring_index(c, "-", -1)).otherwise(hex_body(c))),
        })
    else:
        df = df.withColumn(text, canonical(c))
    small = f"startswith(`{text}`, '0x{'0' * (_TOP_DIGITS + (_PAIRS - 3) * _PAIR_DIGITS)}')"
    parts = {}
    for i, label in enumerate(_pair_names(name)):
        if i == _PAIRS - 1:
            digits = f"substr(`{text}`, 3, length(`{text}`) - {2 + i * _PAIR_DIGITS})"
        else:
            digits = f"substr(`{text}`, {-(i + 1) * _PAIR_DIGITS}, {_PAIR_DIGITS})"
        number = f"if(octet_length(`{text}`) <= {2 + MOST_DIGITS}, cast(conv({digits}, 16, 10) as bigint), null)"
        if i >= 2:
            number = f"if({small}, 0L, {number})"
        parts[label] = f"if(`{minus}`, -{number}, {number})" if signed else number
    return computed_once(df, kept, parts)


def limb_sums(name: str, sign: str | None = None) -> list[Column]:
    """Aggregates for ``groupBy().agg(*limb_sums(...))``; finish with ``collapse_limbs``.

    ``sign`` names a column holding 1 or -1.
    """
    out = []
    for i, label in enumerate(_limb_names(name)):
        limb = _limb_of_pair(name, i)
        out.append(F.expr(f"sum({limb} * {sign})" if sign else f"sum({limb})").alias(label))
    return out


def _limb_of_pair(name: str, i: int) -> str:
    pair = f"`{name}__p{i // 2}`"
    if i == LIMBS - 1:
        return pair                     # the top pair holds one limb and the sign
    return f"shiftright({pair}, {LIMB_BITS})" if i % 2 else f"({pair} & {_MASK}L)"


def _carried(parts: Sequence[str]) -> tuple[list[str], str]:
    """Digits of all limbs but the last, and the last with everything carried into it."""
    digits: list[str] = []
    carry = ""
    for part in parts[:-1]:
        total = f"({part}{carry})"
        digits.append(f"({total} & {_MASK}L)")
        carry = f" + shiftright({total}, {LIMB_BITS})"
    return digits, f"({parts[-1]}{carry})"


def limbs_sign(name: str) -> Column:
    """-1, 0 or 1 for the number in the limb columns, without turning them into text."""
    digits, top = _carried([f"`{n}`" for n in _limb_names(name)])
    zero = " | ".join([*digits, top]) + " = 0"
    return F.expr(f"case when {top} < 0 then -1 when {zero} then 0 else 1 end")


def limb_columns(name: str) -> list[str]:
    """The columns that ``limb_sums`` makes; they can be summed again as they are."""
    return _limb_names(name)


def collapse_limbs(df: DataFrame, name: str) -> DataFrame:
    """Replace the limb columns of ``name`` by one signed ``0x`` + 64 digits column.

    The carry goes from limb to limb in columns that build on each other. Written as one expression a limb holds all those below
    it, which is more code than the JVM compiles, and every row is interpreted.
    """
    names = _limb_names(name)
    way, body = f"{name}__way", f"{name}__digits"
    totals = [f"{name}__t{i}" for i in range(LIMBS)]
    kept = [c for c in df.columns if c not in names]
    plain = [f"`{c}`" for c in kept]
    top = f"`{names[0]}`"
    for limb in names[1:]:
        top = f"(`{limb}` + shiftright({top}, {LIMB_BITS}))"
    df = df.selectExpr(*plain, *[f"`{n}`" for n in names], f"if({top} < 0, -1L, 1L) as `{way}`")
    carried = [f"`{way}` * `{names[0]}` as `{totals[0]}`"]
    for i in range(1, LIMBS):
        carried.append(f"`{way}` * `{names[i]}` + shiftright(`{totals[i - 1]}`, {LIMB_BITS}) as `{totals[i]}`")
    df = df.selectExpr(*plain, f"`{way}`", *carried)
    digits, head = [f"(`{t}` & {_MASK}L)" for t in totals], f"`{totals[-1]}`"
    pairs = [
        f"lpad(hex(shiftleft({digits[i + 1]}, {LIMB_BITS}) | {digits[i]}), {_PAIR_DIGITS}, '0')"
        for i in range(0, LIMBS - 1, 2)
    ]
    first = f"if({head} > 65535, hex({head}), lpad(hex({head}), {_TOP_DIGITS}, '0'))"
    df = df.selectExpr(*plain, f"`{way}`", f"lower(concat({', '.join([first, *reversed(pairs)])})) as `{body}`")
    bare = f"ltrim('0', `{body}`)"
    negative = f"lpad(concat('-', {bare}), greatest(64, length({bare}) + 1), '0')"
    return computed_once(df, kept, {name: f"concat('0x', if(`{way}` < 0, {negative}, `{body}`))"})


def split_blocks(df: DataFrame, name: str, value: Column | str, signed: bool = False) -> DataFrame:
    """As ``split_limbs`` for numbers of any length: rows with ``name__block`` 0 for all numbers, and for one
    beyond PLAIN_DIGITS one more for every further BLOCK_DIGITS digits. ``name__blocks`` counts them.

    Group by the block as well, sum as usual, and finish with ``collapse_blocks``.
    """
    block, blocks, piece, place = (f"{name}__{x}" for x in ("block", "blocks", "piece", "place"))
    c = as_col(value)
    kept = df.columns
    minus = c.contains("-") if signed else F.lit(False)
    digits = F.ltrim(F.when(minus, F.substring_index(c, "-", -1)).otherwise(hex_body(c)), F.lit("0"))
    n = F.ceil(F.length(digits) / BLOCK_DIGITS).cast("int")
    # Nearly all numbers are short, which their length tells; only of others the digits are looked at.
    short = c.isNull() | (F.octet_length(c) <= 2 + PLAIN_DIGITS) | (F.length(digits) <= PLAIN_DIGITS)
    cut = F.regexp_extract_all(F.lpad(digits, n * BLOCK_DIGITS, "0"), F.lit(f".{{{BLOCK_DIGITS}}}"), F.lit(0))
    cut = F.when(minus, F.split(F.concat(F.lit("-"), F.array_join(cut, ",-")), ",")).otherwise(cut) if signed else cut
    rows = df.select(
        *[F.col(f"`{k}`") for k in kept], F.when(short, 1).otherwise(n).alias(blocks),
        F.posexplode(F.when(short, F.array(c)).otherwise(cut)).alias(place, piece))
    rows = rows.withColumn(block, F.col(blocks) - 1 - F.col(place)).drop(place)
    return split_limbs(rows, name, piece, signed).drop(piece)


def block_columns(name: str) -> tuple[str, str]:
    """The columns for the number of a block and for the count of blocks: group by one, take the maximum of the other."""
    return f"{name}__block", f"{name}__blocks"


def _carried_text(limbs: Column) -> Column:
    """Signed limbs of any number, lowest first, as signed ``0x`` + at least 64 digits."""
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("bigint").alias("carry"))

    def total(sign: int) -> Column:
        def carry_on(done: Column, limb: Column) -> Column:
            here = done["carry"] + limb * sign
            digits = F.lpad(F.hex(here.bitwiseAND(F.lit(_MASK).cast("bigint"))), LIMB_DIGITS, "0")
            return F.struct(F.concat(digits, done["text"]).alias("text"),
                            F.shiftright(here, LIMB_BITS).alias("carry"))

        return F.aggregate(limbs, start, carry_on)

    def text(done: Column) -> Column:
        return F.lower(F.ltrim(F.concat(F.hex(done["carry"]), done["text"]), F.lit("0")))

    positive = _let(total(1), lambda done: F.when(done["carry"] >= 0, text(done)))
    negative = F.concat(F.lit("-"), _let(total(-1), text))
    return F.concat(F.lit("0x"), pad_left(F.coalesce(positive, negative), 64))


def collapse_blocks(df: DataFrame, keys: Sequence[str], name: str, others: Sequence[str] = ()) -> DataFrame:
    """Rows of one key and block with limb sums as rows of one key with ``name`` as signed hex text.

    ``others`` are columns of block 0, which every number has. Keys with one block stay where they are; only
    those that a long number reached meet once more.
    """
    block, blocks = block_columns(name)
    limbs = _limb_names(name)
    wanted = [*keys, *others, name]
    plain = collapse_limbs(df.filter(F.col(blocks) == 1).drop(block, blocks), name).select(*wanted)
    first = F.when(F.col(block) == 0, F.struct(F.lit(0).alias("_"), *others))
    long = df.filter(F.col(blocks) > 1).groupBy(*keys).agg(
        F.sort_array(F.collect_list(F.struct(
            F.col(block).alias("block"), F.array(*limbs[:-1]).alias("limbs"), F.col(limbs[-1]).alias("over")))).alias("_rows"),
        F.first(first, ignorenulls=True).alias("_first"))

    def of_block(row: Column, k: Column) -> Column:
        """The limbs of a block; what the block before holds beyond its own digits belongs to the lowest."""
        over = F.when(k > 0, F.get("_rows", k - 1)["over"]).otherwise(0)
        return F.concat(F.array(row["limbs"][0] + over), F.slice(row["limbs"], 2, LIMBS - 2))

    every = F.concat(F.flatten(F.transform("_rows", of_block)), F.array(F.element_at("_rows", -1)["over"]))
    long = long.select(*keys, *[F.col("_first")[c].alias(c) for c in others], _carried_text(every).alias(name))
    return plain.unionByName(long)


def sum_hex(df: DataFrame, keys: Sequence[str], name: str, value: Column | str,
            *others: Column, sign: str | None = None, signed: bool = False) -> DataFrame:
    """``groupBy(keys)`` with the exact sum of a hex column of any length and any other (named) aggregates."""
    staged = split_blocks(df, name, value, signed)
    return collapse_blocks(*block_sums(staged, keys, name, *others, sign=sign))


def block_sums(staged: DataFrame, keys: Sequence[str], name: str, *others: Column,
               sign: str | None = None) -> tuple[DataFrame, list[str], str, list[str]]:
    """Limb sums of ``split_blocks`` rows by key and block, with what ``collapse_blocks`` takes besides."""
    block, blocks = block_columns(name)
    grouped = staged.groupBy(*keys, block).agg(*limb_sums(name, sign), F.max(blocks).alias(blocks), *others)
    taken = {*keys, block, blocks, *_limb_names(name)}
    return grouped, list(keys), name, [c for c in grouped.columns if c not in taken]


def add_hex(df: DataFrame, name: str, first: Column | str, second: Column | str) -> DataFrame:
    """Add a column with the exact sum of two signed hex columns of any length (null counts as 0)."""
    a, b, x, y = (f"{name}__{k}" for k in ("a", "b", "x", "y"))
    zero = F.lit("0x" + "0" * 64)
    columns = [f"`{c}`" for c in df.columns]
    df = df.withColumns({x: F.coalesce(as_col(first), zero), y: F.coalesce(as_col(second), zero)})
    df = split_limbs(df, a, x, signed=True)
    df = split_limbs(df, b, y, signed=True)
    sums = []
    for i, label in enumerate(_limb_names(name)):
        sums.append(f"{_limb_of_pair(a, i)} + {_limb_of_pair(b, i)} as `{label}`")
    summed = collapse_limbs(df.selectExpr(*columns, f"`{x}`", f"`{y}`", *sums), name)
    # The parts of a number that is too long for them are null, and so is the sum; then the digits are added.
    return computed_once(summed, [c for c in summed.columns if c not in (x, y, name)],
                         {name: F.coalesce(name, _long_sum(F.col(x), F.col(y)))})


def _long_sum(first: Column, second: Column) -> Column:
    def added(numbers: Column) -> Column:
        n = F.ceil(F.greatest(F.length(numbers[0]["digits"]), F.length(numbers[1]["digits"])) / LIMB_DIGITS).cast("int")

        def limb(number: Column, k: Column) -> Column:
            padded = F.concat(F.lit("0" * LIMB_DIGITS), number["digits"])
            begin = F.length(padded) - (k + 1) * LIMB_DIGITS + 1
            cut = F.substring(padded, F.greatest(begin, F.lit(1)), F.lit(LIMB_DIGITS))
            return F.when(begin > 0, _conv(cut) * number["sign"]).otherwise(0)

        return _carried_text(F.transform(
            F.sequence(F.lit(0), n), lambda k: limb(numbers[0], k) + limb(numbers[1], k)))

    def parted(value: Column) -> Column:
        return F.struct(F.ltrim(_magnitude(value), F.lit("0")).alias("digits"),
                        F.when(_is_negative(value), -1).otherwise(1).alias("sign"))

    return _let(F.array(parted(first), parted(second)), added)


def negate_hex(value: Column | str) -> Column:
    """The number with its sign turned round."""
    digits = F.ltrim(_magnitude(value), F.lit("0"))
    turned = F.when(_is_negative(value) | (digits == ""), digits).otherwise(F.concat(F.lit("-"), digits))
    return F.concat(F.lit("0x"), pad_left(turned, 64))


# ---------------------------------------------------------------------------
# Base conversion. Both directions are linear combinations with constants that
# follow from the bases, then one carry pass.

_WIDE_DIGITS = 15            # hex digits per 60-bit part
_DEC_DIGITS = 19             # decimal digits per column of the result


def hex_to_decimal_text(value: Column | str) -> Column:
    """An unsigned hex number as decimal text; empty text is 0.

    Branches, cheapest first: short text, 60 bits, 120 bits, MOST_DIGITS digits, then any size, whose work grows
    with the cube of the length (``any_hex_to_decimal_text`` is for data that may hold very long ones).
    """
    c = as_col(value)
    full = canonical(c)

    def tail(parts: int) -> Column:
        return F.substring(full, -parts * _WIDE_DIGITS, parts * _WIDE_DIGITS)

    def fits(parts: int) -> Column:
        # A number above 256 bits begins with a digit other than 0.
        return full.startswith("0x" + "0" * (64 - parts * _WIDE_DIGITS))

    short = c.startswith("0x") & (F.octet_length(c) <= 2 + _WIDE_DIGITS)
    return (
        F.when(short, F.conv(F.concat(F.lit("0"), F.substring(c, 3, _WIDE_DIGITS)), 16, 10))
        .when(fits(1), F.conv(tail(1), 16, 10))
        .when(fits(2), _two_part_decimal(tail(2)))
        .when(F.octet_length(full) <= 2 + MOST_DIGITS, _long_decimal(F.substring(full, 3, MOST_DIGITS)))
        .otherwise(_any_decimal(F.substring(full, 3, 1 << 30)))
    )


@F.udf(StringType(), useArrow=True)
def _python_decimal(digits: str | None) -> str | None:
    import sys

    sys.set_int_max_str_digits(0)
    return None if digits is None else str(int(digits, 16))


def any_hex_to_decimal_text(value: Column | str) -> Column:
    """As ``hex_to_decimal_text`` for logged data, which may be as long as a log can be.

    Numbers beyond MOST_DIGITS go through Python in Arrow batches; of all others only nulls do.
    """
    digits = F.ltrim(hex_body(value), F.lit("0"))
    long = (F.octet_length(as_col(value)) > 2 + MOST_DIGITS) & (F.length(digits) > MOST_DIGITS)
    return F.coalesce(_python_decimal(F.when(long, digits)), F.when(~long, hex_to_decimal_text(value)))


def signed_hex_to_decimal_text(value: Column | str) -> Column:
    """As ``hex_to_decimal_text`` for stored balances that may carry a minus sign."""
    c = as_col(value)
    return F.when(
        _is_negative(c), F.concat(F.lit("-"), hex_to_decimal_text(F.substring_index(c, "-", -1)))
    ).otherwise(hex_to_decimal_text(c))


def _wide_parts(digits: Column, parts: int) -> list[Column]:
    """Digits (left-padded text of any length) as 60-bit numbers, lowest first."""
    padded = low_digits(digits, parts * _WIDE_DIGITS)
    return [
        _conv(F.substring(padded, (parts - 1 - i) * _WIDE_DIGITS + 1, _WIDE_DIGITS)).cast("decimal(19,0)")
        for i in range(parts)
    ]


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used."""
    return F.get(F.transform(F.array(value), use), 0)


def _two_part_decimal(digits: Column) -> Column:
    low, high = _wide_parts(digits, 2)
    weight = F.lit(str(1 << 4 * _WIDE_DIGITS)).cast("decimal(19,0)")
    return (high * weight + low).cast("decimal(38,0)").cast("string")


def _long_decimal(digits: Column) -> Column:
    """Any number of up to MOST_DIGITS digits: every base-10**19 column is a sum of parts times constants.

    Written with array functions because the flat form is so much code that the
    JVM would not compile the whole projection; few numbers get here.
    """
    parts = -(-MOST_DIGITS // _WIDE_DIGITS)
    columns = -(-len(str(16 ** MOST_DIGITS)) // _DEC_DIGITS)
    table = ", ".join(
        "array(" + ", ".join(
            f"{(1 << (4 * _WIDE_DIGITS * i)) // 10 ** (_DEC_DIGITS * k) % 10 ** _DEC_DIGITS}BD"
            for i in range(parts)) + ")"
        for k in range(columns))
    factors = F.expr(f"cast(array({table}) as array<array<decimal(19,0)>>)")
    base = F.lit(str(10 ** _DEC_DIGITS)).cast("decimal(20,0)")
    start = F.struct(F.lit("").alias("text"), F.lit(0).cast("decimal(38,0)").alias("carry"))

    def convert(numbers: Column) -> Column:
        def carry_on(done: Column, row: Column) -> Column:
            products = F.zip_with(numbers, row, lambda n, f: (n * f).cast("decimal(38,0)"))
            total = F.aggregate(products, done["carry"], lambda a, x: (a + x).cast("decimal(38,0)"))
            text = F.lpad((total % base).cast("decimal(19,0)").cast("string"), _DEC_DIGITS, "0")
            return F.struct(F.concat(text, done["text"]).alias("text"),
                            F.call_function("div", total, base).cast("decimal(38,0)").alias("carry"))

        return F.aggregate(factors, start, carry_on, lambda done: done["text"])

    return F.ltrim(_let(F.array(*_wide_parts(digits, parts)), convert), F.lit("0"))


_DEC_CHUNK = 9               # decimal digits per part
_HEX_CHUNK = 7               # hex digits that a step takes; nine decimal digits times 28 bits stay below 63 bits


def _any_decimal(digits: Column) -> Column:
    """Digits of any number as decimal text: parts of nine decimal digits, lowest first, take up seven hex digits a step."""
    base = F.lit(10 ** _DEC_CHUNK).cast("bigint")
    none = F.array().cast("array<bigint>")

    def taken(parts: Column, chunk: Column) -> Column:
        def carry_on(done: Column, part: Column) -> Column:
            here = F.shiftleft(part, 4 * _HEX_CHUNK) + done["carry"]
            return F.struct(F.array_append(done["parts"], here % base).alias("parts"),
                            F.call_function("div", here, base).alias("carry"))

        moved = F.aggregate(parts, F.struct(none.alias("parts"), chunk.alias("carry")), carry_on)
        return _let(moved, lambda done: F.when(
            done["carry"] > 0, F.array_append(done["parts"], done["carry"])).otherwise(done["parts"]))

    def convert(padded: Column) -> Column:
        count = F.call_function("div", F.length(padded), F.lit(_HEX_CHUNK)).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), count - 1), lambda k: _conv(
            F.substring(padded, k * _HEX_CHUNK + 1, F.lit(_HEX_CHUNK))))
        parts = F.aggregate(chunks, none, taken)
        return F.array_join(F.transform(F.reverse(parts), lambda p: F.lpad(p.cast("string"), _DEC_CHUNK, "0")), "")

    whole = F.ceil(F.length(digits) / _HEX_CHUNK).cast("int") * _HEX_CHUNK
    return F.ltrim(_let(F.lpad(digits, whole, "0"), convert), F.lit("0"))


_OUT_BITS = 28               # 30 + 28 bits and 15 terms stay below 63 bits


def decimal_text_to_hex(value: Column | str, width: int = 64, max_digits: int = 135) -> Column:
    """Non-negative decimal text as ``0x`` + padded hex digits; more than ``max_digits`` digits raise an error."""
    chunks = -(-max_digits // _DEC_CHUNK)
    places = -(-(10 ** max_digits).bit_length() // _OUT_BITS)
    mask = (1 << _OUT_BITS) - 1
    table = ", ".join(
        "array(" + ", ".join(
            f"{((10 ** (_DEC_CHUNK * j)) >> (_OUT_BITS * k)) & mask}L" for j in range(chunks)) + ")"
        for k in range(places))
    factors = F.expr(f"array({table})")
    zero = F.lit(0).cast("bigint")
    start = F.struct(F.lit("").alias("text"), zero.alias("carry"))

    def split(padded: Column) -> Column:
        return F.transform(F.sequence(F.lit(chunks - 1), F.lit(0)), lambda j: F.substring(
            padded, j * _DEC_CHUNK + 1, F.lit(_DEC_CHUNK)).cast("bigint"))

    def convert(numbers: Column) -> Column:
        def carry_on(done: Column, row: Column) -> Column:
            products = F.zip_with(numbers, row, lambda n, f: n * f)
            total = F.aggregate(products, done["carry"], lambda a, x: a + x)
            digits = F.lpad(F.hex(total.bitwiseAND(F.lit(mask).cast("bigint"))), _OUT_BITS // 4, "0")
            return F.struct(F.concat(digits, done["text"]).alias("text"),
                            F.shiftright(total, _OUT_BITS).alias("carry"))

        return F.aggregate(factors, start, carry_on, lambda done: done["text"])

    digits = F.ltrim(as_col(value), F.lit("0"))
    too_long = F.raise_error(F.concat(F.lit(f"more than {max_digits} digits: "), digits)).cast("string")
    checked = F.when(F.length(digits) > max_digits, too_long).otherwise(digits)
    text = _let(split(low_digits(checked, chunks * _DEC_CHUNK)), convert)
    return F.concat(F.lit("0x"), pad_left(F.lower(F.ltrim(text, F.lit("0"))), width))


def decimal_to_hex64(value: Column | str) -> Column:
    """A non-negative DECIMAL(38,0) as ``0x`` + 64 digits, by two whole-number divisions."""
    number = as_col(value).cast("decimal(38,0)")
    two_64 = F.lit(str(1 << 64)).cast("decimal(20,0)")
    two_32 = F.lit(1 << 32).cast("decimal(10,0)")
    low = number % two_64
    parts = (F.call_function("div", number, two_64), F.call_function("div", low, two_32),
             (low % two_32).cast("bigint"))
    digits = [F.lpad(F.hex(part), width, "0") for part, width in zip(parts, (16, 8, 8))]
    return F.concat(F.lit("0x" + "0" * 32), F.lower(F.concat(*digits)))


def remove_point(value: Column | str, scale: int) -> Column:
    """Decimal text times 10**scale, cut to whole digits, as decimal text."""
    text = as_col(value)
    whole = F.substring_index(text, ".", 1)
    fraction = F.when(text.contains("."), F.substring_index(text, ".", -1)).otherwise("")
    shifted = F.concat(whole, F.substring(F.concat(fraction, F.lit("0" * scale)), 1, scale))
    stripped = F.ltrim(shifted, F.lit("0"))
    return F.when(stripped == "", "0").otherwise(stripped)


def hex_or_decimal(value: Column | str, scale: int) -> Column:
    """``0x`` text as a hex number, anything else as decimal text scaled by 10**scale."""
    text = as_col(value)
    return (
        F.when(text == "", "0")
        .when(text.startswith("0x"), hex_to_decimal_text(text))
        .otherwise(remove_point(text, scale))
    )
