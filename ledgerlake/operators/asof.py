"""As-of lookups that hold for hot keys: points are carried between buckets of time, then one running frame a bucket."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Width of a bucket of timestamps: an hour of one key is what a task sorts.
HOUR = 3_600_000_000


def _carried(points: DataFrame, asked: DataFrame, key: list[str], modes: tuple[str, ...]) -> DataFrame:
    """key, __bucket, __p: for each bucket, the last point of the buckets before it and the first of those after it.

    Points are reduced to two for each bucket by partial aggregates; the window then sees a row a bucket, not a point.
    """
    first = F.max(F.struct((-F.col("__p.__at")).alias("__back"), "__p"))["__p"]  # the largest of those at the first place
    ends = points.groupBy(*key, "__bucket").agg(first.alias("low"), F.max("__p").alias("high"))
    known = ends.unionByName(asked.select(*key, "__bucket").distinct(), allowMissingColumns=True).groupBy(*key, "__bucket").agg(F.max("low").alias("low"), F.max("high").alias("high"))
    other = lambda c, order: F.last(c, ignorenulls=True).over(Window.partitionBy(*key).orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    found = []
    if "before" in modes:
        found.append(other("high", F.col("__bucket").asc()))
    if "after" in modes:
        found.append(other("low", F.col("__bucket").desc()))
    rows = known.select(*key, "__bucket", F.array(*found).alias("__all"))
    return rows.select(*key, "__bucket", F.explode("__all").alias("__p")).filter("__p is not null")


def as_of(probes: DataFrame, points: DataFrame, key: list[str], mode: str = "nearest", max_distance: int | None = None, at: str = "ts", position: Column | None = None, width: int = HOUR, unit: int = 1000, places: DataFrame | None = None) -> DataFrame:
    """Each probe with the point before, after or nearest to it: columns of probes, point_<at>, and point (a struct).

    probes and points: key, ``at`` and any columns. A point at the probe's place is both before and after; of two
    equally near the earlier wins; of points at one place the largest in order of its columns; one further off than
    ``max_distance`` is missing. ``position`` gives the place of ``at`` as a long (microseconds of a timestamp by
    default) and ``width`` the size of a bucket; distances are between places rounded to ``unit`` (milliseconds). ``places``: key and
    ``at`` of all probes, others too, where they can be told at less cost than by computing the probes once more.

    A key is cut into buckets, each with the nearest point from outside carried in, so a hot key is many tasks. Within
    one, points and probes are merged by a running frame: the cost is that of a sort, whatever the number of probes.
    """
    modes = ("before", "after") if mode == "nearest" else (mode,)
    place = (F.unix_micros(at) if position is None else position).alias("__at")
    rest = [c for c in points.columns if c not in {*key, at}]
    extra = [c for c in probes.columns if c not in {*key, at}]
    bucket = F.floor(F.col("__at") / width).cast("bigint").alias("__bucket")
    told = points.select(*key, place, at, *rest).select(*key, bucket, F.struct("__at", at, *rest).alias("__p"))
    asked = probes.select(*key, place, at, *extra).select(*key, bucket, F.col("__at"), F.struct(F.lit(1).alias("__one"), at, *extra).alias("__probe"))
    near = asked if places is None else places.select(*key, place).select(*key, bucket)
    told = told.unionByName(_carried(told, near, key, modes))
    both = told.select("*", F.col("__p.__at").alias("__at")).unionByName(asked, allowMissingColumns=True)
    running = Window.partitionBy(*key, "__bucket").rowsBetween(Window.unboundedPreceding, 0)
    last = lambda order: F.last("__p", ignorenulls=True).over(running.orderBy(order, F.col("__probe").isNotNull(), "__p"))
    if "before" in modes:
        both = both.withColumn("__before", last(F.col("__at").asc()))
    if "after" in modes:
        both = both.withColumn("__after", last(F.col("__at").desc()))
    whole = lambda c: F.floor((F.col(c) + unit // 2) / unit)
    gap = lambda c: F.abs(whole("__at") - whole(f"{c}.__at"))
    if mode == "nearest":
        pick = F.when(F.col("__after").isNull() | (gap("__before") <= gap("__after")), F.col("__before")).otherwise(F.col("__after"))
    else:
        pick = F.col(f"__{mode}")
    found = both.filter("__probe is not null").withColumn("__pick", pick)
    if max_distance is not None:
        found = found.withColumn("__pick", F.when(gap("__pick") <= max_distance, F.col("__pick")))
    point = F.when(F.col("__pick").isNotNull(), F.struct(*[F.col(f"__pick.`{c}`").alias(c) for c in (at, *rest)]))
    return found.select(*key, *[F.col(f"__probe.`{c}`").alias(c) for c in (at, *extra)], F.col(f"__pick.`{at}`").alias(f"point_{at}"), point.alias("point"))
