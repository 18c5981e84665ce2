"""Exact row numbers and running offsets without a single-task window."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tinta.session import cut_lineage

# Digits of the digest that name a bucket, and ranges of an ordered column. Both bound what is broadcast.
HASH_DIGITS = 3
MAX_RANGES = 4096
RANGE_ROWS = 250_000


def shuffle_key(seed: int, row_id: Column) -> Column:
    """Seeded pseudo-random order that every engine computes alike."""
    return F.md5(F.concat(F.lit(f"{seed}|"), row_id.cast("string")))


def keys_at_ranks(keys: DataFrame, ranks: dict[str, Callable[[Column], Column]], digits: int = HASH_DIGITS):
    """One row with, per name, the digest that stands at a rank of all digests in order.

    ``keys`` has one column of hex digests and ``ranks`` maps names to functions of the row count.
    Buckets of the first digits are counted first (16**digits rows at most); only the buckets that
    hold a wanted rank are then sorted. NULL where the rank is 0.
    """
    keyed = keys.toDF("_key").withColumn("_bucket", F.substring("_key", 1, digits))
    sizes = keyed.groupBy("_bucket").count()
    upto = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.partitionBy(F.lit(1))
    wanted = F.array(
        *[F.struct(F.lit(n).alias("name"), rank(F.col("_total")).alias("at")) for n, rank in ranks.items()]
    )
    hit = (
        sizes.withColumn("_end", F.sum("count").over(upto))
        .withColumn("_total", F.sum("count").over(everything))
        .select("_bucket", (F.col("_end") - F.col("count")).alias("_start"), "_end", F.inline(wanted))
        .where("_start < at and at <= _end")
    )
    inside = Window.partitionBy("name").orderBy("_key")
    found = (
        keyed.join(F.broadcast(hit), "_bucket")
        .withColumn("_n", F.row_number().over(inside))
        .where("_start + _n = at")
    )
    return found.agg(*[F.max(F.when(F.col("name") == n, F.col("_key"))).alias(n) for n in ranks])


def running_offset(
    df: DataFrame, order: str, weight: str, range_rows: int = RANGE_ROWS, rows: int | None = None
) -> DataFrame:
    """``order, weight, offset``: the weights of all rows that come before, for unique order values.

    Quantiles of the order column cut it into ranges; the cuts only balance the work, any cuts give
    the exact result. Totals of the ranges are added up over at most ``MAX_RANGES`` rows.
    ``rows`` is the number of rows if the caller knows it.
    """
    ranges = min(MAX_RANGES, -(-(df.count() if rows is None else rows) // range_rows))
    cuts = _cut_points(df, order, ranges) if ranges > 1 else []
    # totals and windows both read this one shuffle
    ranged = df.select(order, weight).withColumn("_range", _range_of(F.col(order), cuts)).repartition("_range")
    totals = ranged.groupBy("_range").agg(F.sum(weight).alias("_sum"))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_range", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_range").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return ranged.join(F.broadcast(starts), "_range").select(
        order,
        weight,
        (F.col("_start") + F.coalesce(F.sum(weight).over(inside), F.lit(0))).alias("offset"),
    )


def _cut_points(df: DataFrame, order: str, buckets: int) -> list:
    """Quantiles of a numeric column; for strings, evenly spaced values of a hash sample of bounded size."""
    if df.schema[order].dataType.typeName() in ("string", "date", "timestamp"):
        size = buckets * 16
        # the smallest hashes of all values are a uniform sample, and the limit bounds what is fetched
        sample = df.select(order).orderBy(F.xxhash64(order)).limit(size)
        values = sorted(row[0] for row in sample.collect() if row[0] is not None)
        return sorted(set(values[:: max(1, len(values) // buckets)][1:]))
    points = [i / buckets for i in range(1, buckets)]
    cuts = df.agg(F.percentile_approx(order, points, 10000)).first()[0]
    return sorted(set(cuts or []))


def _range_of(value: Column, cuts: list) -> Column:
    """Number of cuts up to a value: found among every n-th cut first, then among the n that follow."""
    if not cuts:
        return F.lit(0)
    n = math.isqrt(len(cuts)) + 1
    groups = [cuts[i : i + n] for i in range(0, len(cuts), n)]

    def passed(points: Column) -> Column:
        return F.size(F.filter(points, lambda cut: cut <= value))

    def literals(values: list) -> Column:
        return F.array(*[F.lit(v) for v in values])

    group = passed(literals([g[0] for g in groups]))
    inside = passed(F.element_at(F.array(*[literals(g) for g in groups]), group))
    return F.when(group == 0, 0).otherwise((group - 1) * n + inside)


def row_positions(df: DataFrame, name: str) -> DataFrame:
    """0-based position of every row in file order.

    Read order is only known while scanning, so rows are numbered per scan partition, kept in the
    checkpoint folder, and shifted by the sizes of the partitions before them.
    """
    marked = cut_lineage(df.withColumn("_scan", F.monotonically_increasing_id()))
    partition = F.shiftright("_scan", 33)
    sizes = marked.groupBy(partition.alias("_part")).count()
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    local = F.col("_scan").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        marked.withColumn("_part", partition)
        .join(F.broadcast(starts), "_part")
        .withColumn(name, F.col("_start") + local)
        .drop("_scan", "_part", "_start")
    )
