"""Column expressions that all jobs share: canonical numbers, identifiers, times, ABI words."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerlake.functions import rational, u256

ADDRESS, HASH = "^0x[0-9a-f]{40}$", "^0x[0-9a-f]{64}$"
PRICE = r"^(0|[1-9][0-9]*)(\.[0-9]+)?$"
# Names under which quote tokens are known.
TOKEN_ALIASES = {"bitcoin": "BTC", "btc": "BTC", "ethereum": "ETH", "ether": "ETH", "eth": "ETH", "tether": "USDT", "usdt": "USDT", "usd-coin": "USDC", "usdc": "USDC"}
UNIT_MS = {"s": 1_000, "m": 60_000, "h": 3_600_000, "d": 86_400_000}
MAX_TICK = 887272


def blank_to_null(text: Column) -> Column:
    trimmed = F.trim(text)
    return F.when(trimmed != "", trimmed)


def canonical_decimal(text: Column) -> Column:
    """Decimal digits without leading zeros; the empty string is zero, anything else that is no number is null."""
    return F.when(text == "", "0").when(text.rlike("^[0-9]+$"), F.regexp_replace(text, "^0+(?=[0-9])", ""))


def nullable_decimal(text: Column) -> Column:
    return canonical_decimal(blank_to_null(text))


def nullable_lower(text: Column) -> Column:
    """Lower-case hash or address; blank is null."""
    return F.lower(blank_to_null(text))


def hex_to_decimal(text: Column) -> Column:
    return u256.hex_text(text)


def hex_to_signed(text: Column) -> Column:
    return u256.signed_hex_text(text)


def epoch_seconds(text: Column) -> Column:
    seconds = text.try_cast("bigint")
    return F.timestamp_seconds(F.when(seconds.between(0, 253402300799), seconds))


def iso_timestamp(text: Column) -> Column:
    return F.try_to_timestamp(text)


def token_decimals(text: Column) -> Column:
    """0 to 255 from decimal or 0x text; null for anything else."""
    number = F.when(text.rlike("^0[xX][0-9a-fA-F]{1,8}$"), F.conv(F.substring(text, 3, 8), 16, 10)).otherwise(text).try_cast("int")
    return F.when(number.between(0, 255), number)


def tx_status(is_error: Column, receipt: Column) -> Column:
    """success, reverted or unknown from an error flag and a receipt status."""
    return F.when((is_error == "1") | (receipt == "0"), "reverted").when((is_error == "0") | (receipt == "1"), "success").otherwise("unknown")


def is_address(text: Column) -> Column:
    return F.coalesce(text.rlike(ADDRESS), F.lit(False))


def is_hash(text: Column) -> Column:
    return F.coalesce(text.rlike(HASH), F.lit(False))


def log_index_of(unique_id: Column, tx_hash: Column) -> Column:
    """n of ``<hash>:log:<n>``, null for any other identifier."""
    head = F.concat(tx_hash, F.lit(":log:"))
    tail = F.substring(unique_id, F.length(head) + 1, F.lit(20))
    return F.when(unique_id.startswith(head) & tail.rlike("^[0-9]+$"), canonical_decimal(tail))


def is_price(text: Column) -> Column:
    return F.coalesce(text.rlike(PRICE), F.lit(False))


def price_order(text: Column) -> Column:
    """Sorts decimal strings by value."""
    whole, part = F.split_part(text, F.lit("."), F.lit(1)), F.split_part(text, F.lit("."), F.lit(2))
    return F.struct(F.lpad(whole, 78, "0").alias("whole"), F.rpad(part, 78, "0").alias("part"))


def token_key(text: Column, aliases: dict[str, str] = TOKEN_ALIASES) -> Column:
    low = F.lower(F.trim(text))
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in aliases.items() for x in kv]), low), low)


def scope_key(*parts: Column) -> Column:
    return F.concat_ws(":", *parts)


def scope_parts(key: Column) -> Column:
    names = ("token", "exchange", "market", "quote", "interval")
    return F.struct(*[F.split_part(key, F.lit(":"), F.lit(k + 1)).alias(n) for k, n in enumerate(names)])


def interval_ms(text: Column) -> Column:
    unit = F.regexp_extract(text, "^([0-9]+)([smhd])$", 2)
    size = F.create_map(*[F.lit(x) for kv in UNIT_MS.items() for x in kv])
    return F.when(unit != "", F.regexp_extract(text, "^([0-9]+)([smhd])$", 1).try_cast("bigint") * F.try_element_at(size, unit))


def any_timestamp(text: Column) -> Column:
    """Epoch milliseconds or ISO text."""
    return F.when(text.rlike("^[0-9]+$"), F.timestamp_millis(text.try_cast("bigint"))).otherwise(F.try_to_timestamp(text))


def add_days(day: Column, n: int) -> Column:
    return F.date_add(day, n)


def days_inclusive(first: Column, last: Column) -> Column:
    return F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<date>"))


def range_code(first: Column, last: Column, today: Column) -> Column:
    """ok, or why a range of days is refused: its order, its future, its length (366 days), its age (10 years)."""
    return (
        F.when(first > last, "ORDER").when(last > today, "FUTURE").when(F.datediff(last, first) + 1 > 366, "TOO_LONG").when(first < F.add_months(today, -120), "TOO_OLD").otherwise("ok")
    )


def fixed_point(raw: Column, decimals: Column) -> Column:
    """raw times 10^-decimals as text, without trailing zeros; raw is a canonical decimal string."""
    minus, digits = raw.startswith("-"), F.regexp_replace(raw, "^-", "")
    wide = F.lpad(digits, F.greatest(F.length(digits), decimals + 1), "0")
    whole, part = F.substring(wide, F.lit(1), F.length(wide) - decimals), F.substring(wide, F.length(wide) - decimals + 1, decimals)
    part = F.regexp_replace(part, "0+$", "")
    text = F.when(part == "", whole).otherwise(F.concat(whole, F.lit("."), part))
    return F.when(minus & (text != "0"), F.concat(F.lit("-"), text)).otherwise(text)


def word(data: Column, k: int) -> Column:
    """The k-th 32-byte word of 0x data, as 0x text; null beyond the end."""
    return F.when(F.length(data) >= 2 + 64 * (k + 1), F.concat(F.lit("0x"), F.substring(data, 3 + 64 * k, 64)))


def has_words(data: Column, n: int) -> Column:
    return F.coalesce(data.rlike(f"^0x[0-9a-fA-F]{{{64 * n}}}$"), F.lit(False))


def word_long(data: Column, k: int) -> Column:
    """A word that fits 63 bits, else null."""
    text = F.substring(data, 3 + 64 * k, 64)
    return F.when(text.rlike("^0{48}0*[0-7]?[0-9a-fA-F]{0,15}$"), F.conv(F.substring(text, 49, 16), 16, 10).try_cast("bigint"))


def abi_text(data: Column) -> Column:
    """Text of a dynamic string (offset 32, valid UTF-8) or of one bytes32 word without its trailing zeros; else null."""
    size = word_long(data, 1)
    fits = (word_long(data, 0) == 32) & (F.length(data) >= 130 + 2 * size) & (size <= 1024)
    dynamic = F.try_validate_utf8(F.decode(F.unhex(F.substring(data, F.lit(131), (2 * size).cast("int"))), "UTF-8"))
    fixed = F.regexp_replace(F.substring(data, 3, 64), "(00)+$", "")
    return F.when(has_words(data, 1), F.decode(F.unhex(fixed), "UTF-8")).when(fits, dynamic)


def abi_arrays(data: Column, limit: int = 32) -> Column:
    """Struct of addresses and amounts from ABI (address[], uint256[]) of equal lengths up to ``limit``; else null."""
    at = lambda w: F.substring(data, (F.lit(3) + w * 2).cast("int"), F.lit(64))
    count = lambda off: F.conv(F.substring(at(off), 49, 16), 16, 10).try_cast("bigint")
    one, two = word_long(data, 0), word_long(data, 1)
    items = lambda off: F.transform(F.sequence(F.lit(1), count(off).cast("int")), lambda k: at(off + k * 32))
    good = (count(one) == count(two)) & count(one).between(1, limit) & (F.length(data) >= 2 + 2 * (two + 32 + 32 * count(two)))
    return F.when(
        good,
        F.struct(F.transform(items(one), lambda w: F.concat(F.lit("0x"), F.lower(F.substring(w, 25, 40)))).alias("addresses"), F.transform(items(two), lambda w: F.concat(F.lit("0x"), w)).alias("amounts")),
    )


def tick(word_: Column) -> Column:
    """int24 in a padded word; null if the padding or the bounds are wrong."""
    text = F.lower(F.substring(word_, 3, 64))
    low = F.conv(F.substring(text, 59, 6), 16, 10).try_cast("int")
    value = F.when(text.rlike("^0{58}[0-7]"), low).when(text.rlike("^f{58}[89a-f]"), low - (1 << 24))
    return F.when(value.between(-MAX_TICK, MAX_TICK), value)


def field_hash(*fields: Column) -> Column:
    """First 32 digits of the SHA-256 of the fields as a JSON array, nulls included."""
    return F.substring(F.sha2(F.to_json(F.array(*[f.cast("string") for f in fields])), 256), 1, 32)


def content_version(lines: Column) -> Column:
    """Aggregate: SHA-256 over the sorted lines of a registry."""
    return F.sha2(F.array_join(F.sort_array(F.collect_list(lines)), "\n"), 256)


def index_or_zero(text: Column) -> Column:
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def selector(call: Column) -> Column:
    return F.lower(F.substring(call, 3, 8))


def call_argument(call: Column, k: int = 0) -> Column:
    """The k-th argument word after the selector, as 0x text."""
    return F.when(F.length(call) >= 10 + 64 * (k + 1), F.concat(F.lit("0x"), F.substring(call, 11 + 64 * k, 64)))


def gas_fee(used: Column, price: Column) -> Column:
    """Product of two decimal strings: one decimal multiplication where it fits, and Arrow-batched beyond."""
    fits = F.coalesce((F.length(used) <= 18) & (F.length(price) <= 19), F.lit(True))
    small = (used.try_cast("decimal(18,0)") * price.try_cast("decimal(19,0)")).cast("decimal(38,0)").cast("string")
    return F.when(fits, small).otherwise(rational.multiply(F.when(~fits, used), F.when(~fits, price)))
