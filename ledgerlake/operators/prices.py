"""Candle histories and as-of lookups (survey 2.5 J4-J6, J11, 2.10 M9-M10, 2.11 K13-K14)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.operators import asof
from ledgerlake.operators.identity import last_wins

SCOPE = ["token_key", "exchange", "market", "quote", "interval"]


def as_of(probes: DataFrame, points: DataFrame, key: list[str], mode: str = "nearest", max_distance_ms: int | None = None) -> DataFrame:
    """The point before, after or nearest to each probe in time, see :func:`asof.as_of`."""
    return asof.as_of(probes, points, key, mode, max_distance_ms)


def price_at(probes: DataFrame, points: DataFrame, mode: str = "nearest", max_distance_ms: int | None = None, any_scope: bool = False) -> DataFrame:
    """Price for probes (request, token_key, ts, and the scope unless ``any_scope``).

    With any_scope all scopes of a token are searched; points at one time are ordered by scope key, the smallest first.
    """
    if not any_scope:
        return as_of(probes, points.select(*SCOPE, "ts", "price"), SCOPE, mode, max_distance_ms)
    scoped = points.withColumn("scope", F.concat_ws(":", *SCOPE))
    one = scoped.groupBy("token_key", "ts").agg(F.min(F.struct("scope", "price")).alias("p"))
    return as_of(probes, one.select("token_key", "ts", "p.scope", "p.price"), ["token_key"], mode, max_distance_ms)


def block_at(probes: DataFrame, blocks: DataFrame, lower: int = 0) -> DataFrame:
    """block: the highest with ts at or before the probe's; ``lower`` where there is none or it is below."""
    found = as_of(probes, blocks.select("chain_id", "ts", "number"), ["chain_id"], "before")
    return found.withColumn("block", F.greatest(F.coalesce("point.number", F.lit(lower)), F.lit(lower)).cast("bigint")).drop("point", "point_ts")


def closes(points: DataFrame, interval_ms: int, first_ms: int, end_ms: int) -> DataFrame:
    """Close series: aligned starts in [first, end), positive prices, the last of equal times by ordinal, in order."""
    ms = F.unix_millis("ts")
    kept = points.filter((ms >= first_ms) & (ms < end_ms) & (F.pmod(ms, F.lit(interval_ms)) == 0) & (F.col("price") > 0))
    return last_wins(kept, [*SCOPE, "ts"], ["ordinal"])


def finality(day: Column, today: Column, flag: Column | None = None) -> Column:
    """Whether a daily candle is final: by its flag if the source has one, otherwise if its day is over."""
    return F.coalesce(flag, day < today) if flag is not None else day < today


def missing_days(points: DataFrame, requests: DataFrame) -> DataFrame:
    """day: the days of each request (token_key, first_day, last_day) without a point (token_key, day)."""
    spine = requests.select("token_key", F.explode(F.sequence("first_day", "last_day")).alias("day"))
    return spine.join(points.select("token_key", "day").distinct(), ["token_key", "day"], "left_anti")


def daily_history(points: DataFrame, requests: DataFrame, today: Column) -> DataFrame:
    """One row for each request and source: points, missing days, unfinished candles, and whether it is partial.

    points: token_key, exchange, day, ordinal, price; the last by ordinal counts for a day.
    """
    daily = last_wins(points.select("token_key", "exchange", "day", "ordinal", "price"), ["token_key", "exchange", "day"], ["ordinal"])
    inside = daily.join(requests, "token_key").filter("day between first_day and last_day")
    sums = inside.groupBy("token_key", "exchange", "first_day", "last_day").agg(F.count("*").alias("points"), F.count_if(~finality(F.col("day"), today)).alias("open_candles"), F.min("day").alias("from_day"), F.max("day").alias("to_day"))
    wanted = F.datediff("last_day", "first_day") + 1
    return sums.withColumn("missing", (wanted - F.col("points")).cast("bigint")).withColumn("partial", F.col("missing") > 0)


def union_results(results: dict[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Price results of several sources as one, and their failures (rows with a code) kept apart."""
    both = None
    for source, rows in results.items():
        part = rows.withColumn("source", F.lit(source))
        both = part if both is None else both.unionByName(part, allowMissingColumns=True)
    return both.filter("code is null"), both.filter("code is not null")


def request_summary(results: DataFrame, configured: int | None = None) -> DataFrame:
    """configured (those requested, unless told), requested, succeeded, failed, and status: ok, partial or failed."""
    sums = results.agg(F.count("*").alias("requested"), F.count_if(F.col("code").isNull()).alias("succeeded"), F.count_if(F.col("code").isNotNull()).alias("failed"))
    sums = sums.select((F.col("requested") if configured is None else F.lit(configured).cast("bigint")).alias("configured"), "*")
    return sums.withColumn("status", F.when(F.col("failed") == 0, "ok").when(F.col("succeeded") == 0, "failed").otherwise("partial"))


def unless_all_failed(results: DataFrame, by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Results that stand, and the groups that failed: by, requested and code (the smallest), where every request of one has a code.

    A group with some failures is partial, and stands with them. Without ``by`` all results are one group.
    """
    key = by or []
    sums = results.groupBy(*key).agg(F.count("*").alias("requested"), F.count_if(F.col("code").isNull()).alias("__good"), F.min("code").alias("code"))
    failed = sums.filter("requested > 0 and __good = 0").drop("__good")
    if not key:
        return results.join(failed.select(F.lit(1).alias("__failed")), F.lit(True), "left_anti"), failed
    same = F.lit(True)
    for c in key:
        same = same & results[c].eqNullSafe(failed[c])
    return results.join(failed, same, "left_anti"), failed


def or_raise(results: DataFrame, by: list[str] | None = None) -> DataFrame:
    """:func:`unless_all_failed`, with an error that names a failed group."""
    good, failed = unless_all_failed(results, by)
    bad = failed.limit(1).collect()
    if bad:
        raise ValueError(f"all requests failed: {bad[0].asDict()}")
    return good


def plan_chunks(requests: DataFrame, days: int) -> DataFrame:
    """Requests (token_key, first_day, last_day) cut into chunks of at most ``days`` days."""
    starts = F.sequence("first_day", "last_day", F.make_interval(days=F.lit(days)))
    rows = requests.select("token_key", "last_day", F.posexplode(starts).alias("chunk", "chunk_first"))
    return rows.select("token_key", "chunk", "chunk_first", F.least(F.date_add("chunk_first", days - 1), F.col("last_day")).alias("chunk_last"))


def update(points: DataFrame, fresh: DataFrame, scopes: DataFrame, interval_ms: int) -> tuple[DataFrame, DataFrame]:
    """Points after a price sync, and the scopes' next_from: after the last point, or stalled where nothing came.

    scopes: SCOPE, next_from, to_ts. Only points in [next_from, to_ts) are taken; equal times are overwritten.
    """
    taken = fresh.join(scopes, SCOPE).filter("ts >= next_from and ts < to_ts").drop("next_from", "to_ts")
    both = points.withColumn("__new", F.lit(0)).unionByName(taken.withColumn("__new", F.lit(1)))
    merged = last_wins(both, [*SCOPE, "ts"], ["__new"]).drop("__new")
    last = taken.groupBy(*SCOPE).agg(F.max("ts").alias("last_ts"))
    step = F.timestamp_micros(F.unix_micros("last_ts") + interval_ms * 1000)
    control = scopes.join(last, SCOPE, "left").withColumn("status", F.when(F.col("last_ts").isNull(), "stalled").otherwise("ok"))
    return merged, control.withColumn("next_from", F.when(F.col("last_ts").isNull(), F.col("next_from")).otherwise(F.least(step, F.col("to_ts")))).drop("last_ts")


def recollect(points: DataFrame, fresh: DataFrame, scope: dict[str, str], replace: bool = True) -> DataFrame:
    """Points with one scope replaced by, or merged with, a new collection."""
    mine = F.lit(True)
    for c, v in scope.items():
        mine = mine & (F.col(c) == v)
    new = fresh.filter(mine)
    if replace:
        return points.filter(~mine).unionByName(new)
    return last_wins(points.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1))), [*SCOPE, "ts"], ["__new"]).drop("__new")


def recollect_counts(points: DataFrame, fresh: DataFrame, scope: dict[str, str], replace: bool = True) -> DataFrame:
    """A dry run: fetched, points of the scope that would go (deleted), and fresh ones at times that are not there yet (inserted)."""
    mine = F.lit(True)
    for c, v in scope.items():
        mine = mine & (F.col(c) == v)
    at = lambda rows, new: rows.filter(mine).groupBy("ts").agg(F.count("*").alias("n")).select("ts", "n", F.lit(new).alias("new"))
    by = at(points, 0).unionByName(at(fresh, 1)).groupBy("ts").agg(F.sum(F.col("n") * F.col("new")).alias("f"), F.sum(F.col("n") * (1 - F.col("new"))).alias("o"))
    count = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    return by.agg(count(F.col("f")).alias("fetched"), count(F.col("o") if replace else F.lit(0)).alias("deleted"), count(F.when((F.col("f") > 0) & (F.lit(replace) | (F.col("o") == 0)), 1).otherwise(0)).alias("inserted"))


def reset(points: DataFrame, scopes: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Points and control rows without those of the scopes in ``gone``."""
    return points.join(gone.select(*SCOPE).distinct(), SCOPE, "left_anti"), scopes.join(gone.select(*SCOPE).distinct(), SCOPE, "left_anti")


def coverage(points: DataFrame) -> DataFrame:
    return points.groupBy(*SCOPE).agg(F.min("ts").alias("from_ts"), F.max("ts").alias("to_ts"), F.count("*").alias("points"))


def best_pool(pools: DataFrame) -> DataFrame:
    """The pool of each request: best match rank, then liquidity, volume (both falling) and address; ambiguous if the best rank names several tokens.

    pools: request, rank, token_address, liquidity, volume, pool_address.
    """
    best = pools.join(pools.groupBy("request").agg(F.min("rank").alias("rank")), ["request", "rank"])
    top = best.groupBy("request").agg(F.countDistinct("token_address").alias("tokens"), F.min(F.struct((-F.col("liquidity")).alias("l"), (-F.col("volume")).alias("v"), "pool_address")).alias("p"))
    return top.select("request", F.when(F.col("tokens") == 1, F.col("p.pool_address")).alias("pool_address"), (F.col("tokens") > 1).alias("ambiguous"))


def match_pools(pools: DataFrame, tokens: DataFrame, requests: DataFrame) -> DataFrame:
    """Pools whose base or quote token matches a request's text: rank 1 by symbol, 2 by name, 3 by a prefix of either.

    The sides are joined to tokens by id; requests match by equality on the symbol, the name, or one of their
    prefixes, each an equi-join.
    """
    side = lambda c: pools.select("pool_address", "liquidity", "volume", F.col(c).alias("token_id"))
    rows = side("base_id").unionByName(side("quote_id")).join(tokens, "token_id")
    low = requests.select("request", F.lower(F.trim("text")).alias("t"))
    exact = lambda c, r: rows.join(low, F.lower(F.col(c)) == F.col("t")).select("request", F.lit(r).alias("rank"), "token_address", "liquidity", "volume", "pool_address")
    # symbols and names are short: each gives all its own prefixes
    prefix = lambda c: rows.withColumn("t", F.explode(F.transform(F.sequence(F.lit(1), F.greatest(F.length(c) - 1, F.lit(1))), lambda n: F.lower(F.substring(F.col(c), F.lit(1), n))))).join(low, "t").select("request", F.lit(3).alias("rank"), "token_address", "liquidity", "volume", "pool_address")
    found = exact("symbol", 1).unionByName(exact("name", 2)).unionByName(prefix("symbol")).unionByName(prefix("name"))
    keys = ["request", "token_address", "pool_address"]
    return found.groupBy(*keys).agg(F.min("rank").alias("rank"), F.max("liquidity").alias("liquidity"), F.max("volume").alias("volume"))
