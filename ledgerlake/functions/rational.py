"""Exact integer arithmetic beyond 128 bits, as Arrow-batched functions over decimal strings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

Q96, Q192, MAX_TICK = 1 << 96, 1 << 192, 887272
# 2^128 / 1.0001^(2^i / 2) for i = 0 to 19, as the pool contracts round them.
TICK_FACTORS = (
    0xFFFCB933BD6FAD37AA2D162D1A594001, 0xFFF97272373D413259A46990580E213A, 0xFFF2E50F5F656932EF12357CF3C7FDCC,
    0xFFE5CACA7E10E4E61C3624EAA0941CD0, 0xFFCB9843D60F6159C9DB58835C926644, 0xFF973B41FA98C081472E6896DFB254C0,
    0xFF2EA16466C96A3843EC78B326B52861, 0xFE5DEE046A99A2A811C461F1969C3053, 0xFCBE86C7900A88AEDCFFC83B479AA3A4,
    0xF987A7253AC413176F2B074CF7815E54, 0xF3392B0822B70005940C7A398E4B70F3, 0xE7159475A2C29B7443B29C7FA6E889D9,
    0xD097F3BDFD2022B8845AD8F792AA5825, 0xA9F746462D870FDF8A65DC1F90E061E5, 0x70D869A156D2A1B890BB3DF62BAF32F7,
    0x31BE135F97D08FD981231505542FCFA6, 0x9AA508B5B7A84E1C677DE54F3E99BC9, 0x5D6AF8DEDB81196699C329225EE604,
    0x2216E584F5FA1EA926041BEDFE98, 0x48A170391F7DC42444E8FA2,
)
RATIO = StructType([StructField(n, StringType()) for n in ("num", "den", "display")])


def sqrt_at_tick(tick: int) -> int:
    """Square root of the price at a tick, times 2^96, rounded up."""
    q = 1 << 128
    for i, factor in enumerate(TICK_FACTORS):
        if abs(tick) >> i & 1:
            q = factor if i == 0 else q * factor >> 128
    if tick > 0:
        q = ((1 << 256) - 1) // q
    return (q >> 32) + (q & 0xFFFFFFFF > 0)


def scaled(num: int, den: int, digits: int = 18) -> str:
    """num/den rounded down to ``digits`` places, without trailing zeros."""
    whole, part = divmod(num * 10**digits // den, 10**digits)
    text = f"{part:0{digits}d}".rstrip("0")
    return f"{whole}.{text}" if text else str(whole)


def _price(sqrt: int, base_is_0: bool, d0: int, d1: int) -> tuple[int, int]:
    up, down = sqrt * sqrt * 10**d0, Q192 * 10**d1
    return (up, down) if base_is_0 else (down, up)


@F.pandas_udf(StringType())
def mul_div(a: pd.Series, b: pd.Series, c: pd.Series) -> pd.Series:
    """floor(a * b / c) of non-negative decimal strings; null if c is zero or a value is null."""
    return pd.Series([str(int(x) * int(y) // int(z)) if x and y and z and int(z) else None for x, y, z in zip(a, b, c, strict=True)], dtype=object)


@F.pandas_udf(StringType())
def multiply(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([str(int(x) * int(y)) if x and y else None for x, y in zip(a, b, strict=True)], dtype=object)


def _ratio_rows(rows: list[tuple[int, int] | None]) -> pd.DataFrame:
    cols = zip(*[(None, None, None) if r is None or min(r) <= 0 else (str(r[0]), str(r[1]), scaled(*r)) for r in rows], strict=True)
    return pd.DataFrame(dict(zip(RATIO.names, [pd.Series(c, dtype=object) for c in cols] or [[], [], []], strict=True)))


@F.pandas_udf(RATIO)
def sqrt_price(sqrt: pd.Series, base_is_0: pd.Series, d0: pd.Series, d1: pd.Series) -> pd.DataFrame:
    """Price of the base token in the other from sqrtPriceX96 (a decimal string, or hexadecimal after 0x) and both tokens' decimals."""
    return _ratio_rows([_price(int(s, 16 if s.startswith("0x") else 10), bool(b), int(x), int(y)) if s else None for s, b, x, y in zip(sqrt, base_is_0, d0, d1, strict=True)])


@F.pandas_udf(RATIO)
def tick_price(tick: pd.Series, base_is_0: pd.Series, d0: pd.Series, d1: pd.Series) -> pd.DataFrame:
    """The same at a tick; null out of bounds."""
    return _ratio_rows([_price(sqrt_at_tick(int(t)), bool(b), int(x), int(y)) if t == t and abs(t) <= MAX_TICK else None for t, b, x, y in zip(tick, base_is_0, d0, d1, strict=True)])


@F.pandas_udf(RATIO)
def times(n1: pd.Series, d1: pd.Series, n2: pd.Series, d2: pd.Series) -> pd.DataFrame:
    """Product of two ratios; null if one is missing."""
    return _ratio_rows([(int(a) * int(c), int(b) * int(d)) if a and b and c and d else None for a, b, c, d in zip(n1, d1, n2, d2, strict=True)])


#: Turns the order of hexadecimal digits around.
_TURNED = str.maketrans("0123456789abcdef", "fedcba9876543210")


def order_text(num: int, den: int) -> str:
    """Text that sorts positive ratios by exact value, whatever the size of their terms.

    It is the continued fraction: of two ratios the one with the larger first different part is larger where that part's
    number is even, and smaller where it is odd, so that odd parts are written with their digits turned around. A part is
    its length and its hexadecimal digits; the end counts as a part without bound.
    """
    out, odd = [], False
    while den:
        part, rest = divmod(num, den)
        digits = f"{part:x}"
        text = f"{len(digits):x}{digits}" if len(digits) < 15 else f"f{len(digits):08x}{digits}"
        out.append(text.translate(_TURNED) if odd else text)
        num, den, odd = den, rest, not odd
    return "".join([*out, "!" if odd else "~"])


@F.pandas_udf(StringType())
def ratio_order(num: pd.Series, den: pd.Series) -> pd.Series:
    """:func:`order_text` of ratios of decimal strings; null where one is missing."""
    return pd.Series([order_text(int(n), int(d)) if n and d else None for n, d in zip(num, den, strict=True)], dtype=object)
