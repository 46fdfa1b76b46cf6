"""Exact 256-bit integers as columns: three limbs of 26 decimal digits in a struct of decimal(38,0).

Limb sums of up to 10^12 rows cannot overflow, and no Python worker takes part. Sums are in whole-stage code; carries
(``normalise``, and so ``render`` of numbers of 27 digits or more) use ``transform``, which Spark interprets. Numbers
that fit the lowest limb, nearly all, take a branch without it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

DIGITS = 26
LIMB = "decimal(38,0)"
PARTS = ("hi", "mid", "lo")


def _base() -> Column:
    return F.lit("1" + "0" * DIGITS).cast(LIMB)


def limbs(hi: Column, mid: Column, lo: Column) -> Column:
    return F.struct(*[x.cast(LIMB).alias(n) for x, n in zip((hi, mid, lo), PARTS, strict=True)])


def parse(text: Column) -> Column:
    """Limbs of a decimal string of at most 78 digits, a minus sign allowed; null for anything else."""
    minus = text.startswith("-")
    short = F.when(text.rlike(r"^-?[0-9]{1,26}$"), text.cast(LIMB))
    digits = F.lpad(F.regexp_replace(text, "^-", ""), 3 * DIGITS, "0")
    part = lambda k: F.when(minus, -1).otherwise(1).cast(LIMB) * F.substring(digits, 1 + DIGITS * k, DIGITS).cast(LIMB)
    zero = F.lit(0).cast(LIMB)
    return F.when(short.isNotNull(), limbs(zero, zero, short)).when(text.rlike(r"^-?[0-9]{27,78}$"), limbs(part(0), part(1), part(2)))


#: Columns of nine digits each, the lowest first: sums of these are sums of longs, for steps that see every fact.
NINES = tuple(f"__n{k}" for k in range(9))


def in_nines(rows: DataFrame, text: str, minus: Column) -> DataFrame:
    """rows with a decimal text of at most 78 digits as NINES instead, negated where ``minus``; zero for anything else.

    Sums of them hold for up to 9 * 10^9 rows. Numbers of up to 18 digits are read as one long.
    """
    t, keep = F.col(text), [c for c in rows.columns if c != text]
    read = rows.select(*keep, F.when(minus, -1).otherwise(1).cast("bigint").alias("__sign"), F.when(t.rlike("^-?[0-9]{1,18}$"), t.cast("bigint")).alias("__long"), F.when(t.rlike("^-?[0-9]{19,78}$"), t).alias("__wide"))
    digits = F.when(F.col("__wide").isNotNull(), F.lpad(F.regexp_replace("__wide", "^-", ""), 81, "0"))
    read = read.select(*keep, F.when(F.col("__wide").startswith("-"), -F.col("__sign")).otherwise(F.col("__sign")).alias("__sign"), "__long", digits.alias("__wide"))
    part = lambda k: F.when(F.col("__wide").isNotNull(), F.substring("__wide", 73 - 9 * k, 9).cast("bigint"))
    low = {0: F.col("__long") % 10**9, 1: F.expr("__long div 1000000000")}
    return read.select(*keep, *[(F.col("__sign") * F.coalesce(*[x for x in (low.get(k), part(k)) if x is not None], F.lit(0).cast("bigint"))).alias(n) for k, n in enumerate(NINES)])


def nines_text(at: str = "") -> Column:
    """Canonical decimal string of sums of NINES; ``at`` goes before their names."""
    n = [F.col(at + c) for c in NINES]
    short = (F.abs(n[0]) < 10**18) & (F.abs(n[1]) < 10**9)
    for c in n[2:]:
        short = short & (c == 0)
    return F.when(short, (n[1] * 10**9 + n[0]).cast("string")).otherwise(_render(of_nines(dict(zip(NINES, n, strict=True)))))


def of_nines(sums: dict[str, Column]) -> Column:
    """Limbs of sums of NINES, of which those that are not there are zero."""
    times = lambda k, zeros: (sums[NINES[k]].cast(LIMB) * F.lit("1" + "0" * zeros).cast(LIMB)).cast(LIMB) if NINES[k] in sums else F.lit(0).cast(LIMB)
    return limbs(times(6, 2) + times(7, 11) + times(8, 20), times(3, 1) + times(4, 10) + times(5, 19), times(0, 0) + times(1, 9) + times(2, 18))


def of_long(value: Column) -> Column:
    return limbs(F.lit(0), F.lit(0), value)


def bound(x: Column, f: Callable[[Column], Column]) -> Column:
    """f of x, with x computed once however often f uses it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _split(v: Column) -> Column:
    """Carry and remainder of one limb."""
    return bound(v, lambda v: bound(F.pmod(v, _base()), lambda low: F.struct(((v - low) / _base()).cast(LIMB).alias("carry"), low.cast(LIMB).alias("rest"))))


def normalise(x: Column) -> Column:
    """The same number with mid and lo in [0, 10^26); hi carries the sign."""
    return bound(x, lambda x: bound(_split(x["lo"]), lambda lo: bound(_split(x["mid"] + lo["carry"]), lambda mid: limbs(x["hi"] + mid["carry"], mid["rest"], lo["rest"]))))


def negate(x: Column) -> Column:
    return limbs(-x["hi"], -x["mid"], -x["lo"])


def plus(a: Column, b: Column) -> Column:
    return limbs(*[a[p] + b[p] for p in PARTS])


def minus(a: Column, b: Column) -> Column:
    return limbs(*[a[p] - b[p] for p in PARTS])


def where(condition: Column, x: Column) -> Column:
    """x where the condition holds, otherwise zero."""
    return limbs(*[F.when(condition, x[p]).otherwise(0) for p in PARTS])


def sum_(x: Column) -> Column:
    """Exact sum of limbs: an aggregate, or a window function with :func:`over`."""
    return limbs(*[F.coalesce(F.sum(x[p]), F.lit(0)) for p in PARTS])


def over(x: Column, window) -> Column:
    return limbs(*[F.sum(x[p]).over(window) for p in PARTS])


def is_negative(x: Column) -> Column:
    return normalise(x)["hi"] < 0


def is_positive(x: Column) -> Column:
    return bound(normalise(x), lambda n: (n["hi"] >= 0) & ((n["hi"] > 0) | (n["mid"] > 0) | (n["lo"] > 0)))


def _digits(n: Column) -> Column:
    digits = F.concat(n["hi"].cast("string"), *[F.lpad(n[p].cast("string"), DIGITS, "0") for p in ("mid", "lo")])
    return F.regexp_replace(digits, "^0+(?=[0-9])", "")


def render(x: Column) -> Column:
    """Canonical decimal string."""
    small = (x["hi"] == 0) & (x["mid"] == 0) & (F.abs(x["lo"]) < _base())
    return F.when(small, x["lo"].cast("string")).otherwise(_render(x))


def _render(x: Column) -> Column:
    return bound(normalise(x), lambda n: F.when(n["hi"] < 0, F.concat(F.lit("-"), bound(normalise(negate(n)), _digits))).otherwise(_digits(n)))


def from_hex(text: Column) -> Column:
    """Limbs of 0x followed by 1 to 64 hexadecimal digits; null for anything else."""
    digits = F.lpad(F.substring(text, 3, 64), 64, "0")
    words = [F.conv(F.substring(digits, 1 + 8 * k, 8), 16, 10).cast("decimal(10,0)") for k in range(8)]
    sums = []
    for part in range(3):
        terms = [w * F.lit(c).cast("decimal(26,0)") for k, w in enumerate(words) if (c := str((1 << 32 * (7 - k)) // 10 ** (DIGITS * (2 - part)) % 10**DIGITS)) != "0"]
        total = terms[0].cast(LIMB)
        for t in terms[1:]:
            total = (total + t.cast(LIMB)).cast(LIMB)
        sums.append(total)
    return F.when(text.rlike("^0[xX][0-9a-fA-F]{1,64}$"), limbs(*sums))


def hex_text(text: Column) -> Column:
    """Decimal string of 0x followed by 1 to 64 hexadecimal digits; null for anything else. Those of up to 60 bits, nearly all, are converted at once."""
    short = F.when(text.rlike("^0[xX][0-9a-fA-F]{1,15}$"), F.substring(text, 3, 15)).when(text.rlike("^0[xX]0{49}[0-9a-fA-F]{15}$"), F.substring(text, 52, 15))
    return F.coalesce(F.conv(short, 16, 10), _render(from_hex(text)))


def signed_hex_text(text: Column) -> Column:
    """Decimal string of a 64-digit two's-complement word after 0x; shorter ones are not negative."""
    negative = text.rlike("^0[xX][89a-fA-F][0-9a-fA-F]{63}$")
    return F.when(negative, _render(from_hex_signed(text))).otherwise(hex_text(text))


def from_hex_signed(text: Column) -> Column:
    """Limbs of a 64-digit two's-complement word after 0x."""
    modulus = parse(F.lit(str(1 << 256)))
    plain = from_hex(text)
    return F.when(F.substring(text, 3, 1).rlike("[89a-fA-F]") & (F.length(text) == 66), minus(plain, modulus)).otherwise(plain)


def register(spark: SparkSession) -> None:
    """exact_limbs(text) and exact_text(hi, mid, lo) for SQL: temporary functions that stay in the JVM.

    The exact sum of a column of decimal strings is three sums of limbs, which Spark adds up in each task before it
    shuffles; :func:`sql_sum` writes them. exact_carry, exact_low and exact_digits are parts of exact_text.
    """
    base, zero = "CAST('1" + "0" * DIGITS + f"' AS {LIMB})", f"CAST(0 AS {LIMB})"
    fields = f"STRUCT<hi: {LIMB}, mid: {LIMB}, lo: {LIMB}>"
    digits = f"lpad(regexp_replace(t, '^-', ''), {3 * DIGITS}, '0')"
    part = lambda k: f"CAST(CASE WHEN t LIKE '-%' THEN -1 ELSE 1 END * CAST(substring({digits}, {1 + DIGITS * k}, {DIGITS}) AS {LIMB}) AS {LIMB})"
    struct = lambda hi, mid, lo: f"named_struct('hi', {hi}, 'mid', {mid}, 'lo', {lo})"
    three = ", ".join(f"{p} {LIMB}" for p in PARTS)
    high, mid = "hi + exact_carry(mid + exact_carry(lo))", "mid + exact_carry(lo)"
    functions = {
        f"exact_limbs(t STRING) RETURNS {fields}": f"CASE WHEN t RLIKE '^-?[0-9]{{1,{DIGITS}}}$' THEN {struct(zero, zero, f'CAST(t AS {LIMB})')} WHEN t RLIKE '^-?[0-9]{{{DIGITS + 1},{3 * DIGITS}}}$' THEN {struct(part(0), part(1), part(2))} END",
        f"exact_low(v {LIMB}) RETURNS {LIMB}": f"CAST(pmod(v, {base}) AS {LIMB})",
        f"exact_carry(v {LIMB}) RETURNS {LIMB}": f"CAST((v - exact_low(v)) / {base} AS {LIMB})",
        f"exact_digits({three}) RETURNS STRING": f"regexp_replace(concat(CAST({high} AS STRING), lpad(CAST(exact_low({mid}) AS STRING), {DIGITS}, '0'), lpad(CAST(exact_low(lo) AS STRING), {DIGITS}, '0')), '^0+(?=[0-9])', '')",
        f"exact_text({three}) RETURNS STRING": f"CASE WHEN {high} < 0 THEN concat('-', exact_digits(-hi, -mid, -lo)) ELSE exact_digits(hi, mid, lo) END",
    }
    for head, body in functions.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {head} RETURN {body}")


def sql_sum(text: str) -> str:
    """SQL of the exact sum of an expression of decimal strings; null where there are none."""
    return "exact_text(" + ", ".join(f"sum(exact_limbs({text}).{p})" for p in PARTS) + ")"
