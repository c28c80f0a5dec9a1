"""Function selectors in contract byte code and the contract type they imply."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ledgerloom import constants as K
from ledgerloom.functions.hexnum import as_col


def function_selectors(bytecode: Column | str) -> Column:
    """Distinct 4-byte operands of byte 0x63, read byte by byte.

    Operands of other push bytes are not skipped, and an operand only counts when
    another byte follows it. The code is spaced out into bytes first, so that the
    pattern can only match on byte boundaries.
    """
    spaced = F.regexp_replace(F.trim(F.substring(as_col(bytecode), 3, 1 << 30)), "(..?)", "$1 ")
    found = F.regexp_extract_all(spaced, F.lit("63 ((?:.. ){4})(?=.)"), F.lit(1))
    joined = F.transform(found, lambda s: F.concat(F.lit("0x"), F.replace(s, F.lit(" "), F.lit(""))))
    return F.array_distinct(joined)


def contract_type_of(selectors: Column | str) -> Column:
    """Code of the first type whose selectors are all present, else null.

    The six selector sets are fixed, so they are literals of a CASE and no join.
    """
    found = as_col(selectors)
    result: Column | None = None
    for code, needed in K.TYPE_SELECTORS:
        wanted = F.array(*[F.lit("0x" + s) for s in needed])
        fits = F.size(F.array_except(wanted, found)) == 0
        result = F.when(fits, code) if result is None else result.when(fits, code)
    return result
