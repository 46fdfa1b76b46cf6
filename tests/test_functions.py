import random

from pyspark.sql import functions as F

from ledgerlake.functions import scalars as s
from ledgerlake.functions import u256


def test_u256_matches_python_integers(spark):
    rng = random.Random(7)
    numbers = [0, 1, -1, 10**26, -(10**26), 2**256 - 1, -(2**255)] + [rng.choice((1, -1)) * rng.getrandbits(rng.choice((8, 90, 200, 255))) for _ in range(200)]
    df = spark.createDataFrame([(i % 5, str(n)) for i, n in enumerate(numbers)], "k int, v string")
    got = {r.k: r.v for r in df.groupBy("k").agg(u256.sum_(u256.parse(F.col("v"))).alias("x")).select("k", u256.render(F.col("x")).alias("v")).collect()}
    assert got == {k: str(sum(n for i, n in enumerate(numbers) if i % 5 == k)) for k in range(5)}
    back = [r.v for r in df.select(u256.render(u256.parse(F.col("v"))).alias("v")).collect()]
    assert back == [str(n) for n in numbers]


def test_hex(spark):
    rng = random.Random(3)
    numbers = [0, 1, 2**64, 2**256 - 1] + [rng.getrandbits(256) for _ in range(50)]
    df = spark.createDataFrame([(hex(n), "0x" + format(n, "064x")) for n in numbers], "h string, w string")
    got = df.select(s.hex_to_decimal(F.col("h")).alias("u"), s.hex_to_signed(F.col("w")).alias("i")).collect()
    assert [r.u for r in got] == [str(n) for n in numbers]
    assert [r.i for r in got] == [str(n - 2**256 if n >> 255 else n) for n in numbers]


def test_scalars(spark):
    word = lambda n: format(n % 2**256, "064x")
    text = "0x" + word(32) + word(5) + b"hello".hex().ljust(64, "0")
    arrays = "0x" + word(64) + word(160) + word(2) + word(0xAA) + word(0xBB) + word(2) + word(7) + word(9)
    one = lambda c: spark.range(1).select(c.alias("v")).first().v
    lit = F.lit
    assert one(s.canonical_decimal(lit("0001000"))) == "1000"
    assert one(s.canonical_decimal(lit(""))) == "0"
    assert one(s.nullable_decimal(lit(" "))) is None
    assert one(s.token_decimals(lit("018"))) == 18
    assert one(s.token_decimals(lit("0x12"))) == 18
    assert one(s.token_decimals(lit("256"))) is None
    assert one(s.tx_status(lit(None).cast("string"), lit(None).cast("string"))) == "unknown"
    assert one(s.log_index_of(lit("0xabc:log:1"), lit("0xabc"))) == "1"
    assert one(s.fixed_point(lit("1803965000000000000"), lit(18))) == "1.803965"
    assert one(s.fixed_point(lit("-5"), lit(2))) == "-0.05"
    assert one(s.interval_ms(lit("5m"))) == 300_000
    assert one(s.token_key(lit(" Ethereum "))) == "ETH"
    assert one(s.abi_text(lit(text))) == "hello"
    assert one(s.abi_text(lit("0x" + b"MKR".hex().ljust(64, "0")))) == "MKR"
    assert one(s.abi_arrays(lit(arrays))["amounts"]) == ["0x" + word(7), "0x" + word(9)]
    assert one(s.tick(lit("0x" + word(-1)))) == -1
    assert one(s.tick(lit("0x" + word(2**25)))) is None
    assert one(s.index_or_zero(lit("call_0"))) == 0
    assert one(s.gas_fee(lit("21000"), lit("100"))) == "2100000"
    assert one(s.any_timestamp(lit("1700000000000"))) == one(s.epoch_seconds(lit("1700000000")))
    assert one(s.range_code(lit("2024-01-02").cast("date"), lit("2024-01-01").cast("date"), lit("2025-01-01").cast("date"))) == "ORDER"
    assert one(s.field_hash(lit("a"), lit(None).cast("string"))) == one(F.substring(F.sha2(lit('["a",null]'), 256), 1, 32))
