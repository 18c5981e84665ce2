"""Mixing sources to target weights by a Pfair schedule.

Every source is cut into blocks of documents. With weight ``w``, its block ``j`` (from 0) is released at slot
``floor(j / w)`` and due at ``ceil((j + 1) / w)``; each slot goes to the released block with the earliest deadline. Weights are
taken as exact fractions of their sum and nothing is rounded, so each block of the input keeps its window, and up to any
slot a source with blocks left has had its share give or take less than one block. When a source has no block left, its slots fall
out and the others keep their proportions; every document is placed once.

Every source has its own weight, however many there are: sizes, weights and blocks are tables, joined by source.

Documents are dealt to blocks in the order of a seeded digest. They are numbered without a window over a whole source: digests
are cut into buckets of bounded size, bucket sizes are added up, and rows are numbered inside their bucket. Only rows
equal in every column share a digest.

Defined results: NULL is a source of its own; sources without a weight get the smallest weight given; weights must be positive; empty tables give no rows;
repeated rows stay. Other columns are kept; ``block``, ``in_block``, ``slot``, ``release`` and ``deadline`` are replaced if they exist.
"""

from __future__ import annotations

import heapq
import itertools
import math
from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tinta.session import cut_lineage

ADDED = ("block", "in_block", "slot", "release", "deadline")
# Names that are used on the way; columns of the input with these names are put aside.
OWN = ("_digest", "_bucket", "_row", "_in", "_name", "_at", "_start", "_n", "_weight", "_given", "_source", "_block", "_slot", "_release", "_deadline")


@dataclass(frozen=True)
class Mixing:
    """``block``: documents of a block. ``most_sources``: a schedule of at most so many sources, and of at most 16 blocks for
    each of so many, is sent to every task; a larger one is joined by a shuffle. ``bucket``: rows numbered together, about."""

    block: int = 16
    most_sources: int = 1 << 16
    least_period: int = 1 << 12
    bucket: int = 50_000
    seed: int = 11


def whole_shares(weights: dict, least_period: int) -> tuple[dict, int]:
    """Integers in exactly the proportions of the weights, and their sum, the period, of at least ``least_period``."""
    exact = {k: Fraction(w) for k, w in weights.items()}
    if min(exact.values()) <= 0:
        raise ValueError("weights must be positive")
    unit = math.lcm(*{w.denominator for w in exact.values()})
    whole = {k: w.numerator * (unit // w.denominator) for k, w in exact.items()}
    common = math.gcd(*whole.values())
    times = -(-least_period // (sum(whole.values()) // common))
    shares = {k: a // common * times for k, a in whole.items()}
    return shares, sum(shares.values())


def schedule(shares: list[int], period: int, blocks: list[int]) -> Iterator[tuple]:
    """``source, j, slot, release, deadline`` of all blocks, by slot: earliest deadline first among the released. Sources
    are numbers; slots for which no block is released are passed over."""
    ready = sorted((-(-period // a), i, 0) for i, (a, n) in enumerate(zip(shares, blocks)) if n)
    later: list[tuple] = []  # the next blocks of sources, by release
    slot = 0
    while ready or later:
        if not ready:
            slot = max(slot, later[0][0])
        while later and later[0][0] <= slot:
            _, i, j = heapq.heappop(later)
            heapq.heappush(ready, (-(-(j + 1) * period // shares[i]), i, j))
        deadline, i, j = heapq.heappop(ready)
        yield i, j, slot, j * period // shares[i], deadline
        if j + 1 < blocks[i]:
            heapq.heappush(later, ((j + 1) * period // shares[i], i, j + 1))
        slot += 1


def one_period(shares: dict, period: int) -> list[tuple]:
    """The schedule of sources with as many blocks as their shares."""
    names = sorted(shares, key=lambda x: (x is not None, x or ""))
    own = [shares[x] for x in names]
    return [(names[i], *rest) for i, *rest in schedule(own, period, own)]


def source_weights(docs: DataFrame, source: str, weights: dict | None, power: float) -> DataFrame:
    """``_source, _n, _weight``: every source with its rows and its weight, as the text of a fraction.

    Without ``weights`` they are in proportion to a power of the sizes: 1 keeps the natural mix, 0 is an even one.
    """
    sizes = docs.groupBy(F.col(source).alias("_source")).agg(F.count("*").alias("_n"))
    if weights is None:
        return sizes.withColumn("_weight", F.pow("_n", F.lit(float(power))).cast("string"))
    given = {k: Fraction(w) for k, w in weights.items()}
    kind = docs.schema[source].dataType.simpleString()
    named = docs.sparkSession.createDataFrame([(k, str(w)) for k, w in given.items()], f"_name {kind}, _given string")
    found = sizes.join(named, sizes["_source"].eqNullSafe(named["_name"]), "left")
    return found.select("_source", "_n", F.coalesce("_given", F.lit(str(min(given.values())))).alias("_weight"))


def block_schedule(sizes: DataFrame, settings: Mixing) -> DataFrame:
    """``_source, _block, _slot, _release, _deadline`` of all blocks. The order of blocks is worked out in one task, which
    holds one row per source and passes blocks on as they come."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches) if (batches := list(batches)) else None
        if table is None or not table.num_rows:
            return
        sources = table.column("_source").combine_chunks()
        shares, period = whole_shares(dict(enumerate(table.column("_weight").to_pylist())), settings.least_period)
        blocks = [-(-n // settings.block) for n in table.column("_n").to_pylist()]
        rows = schedule(list(shares.values()), period, blocks)
        while part := list(itertools.islice(rows, 1 << 14)):
            which, *numbers = zip(*part)
            yield pa.RecordBatch.from_arrays(
                [sources.take(pa.array(which)), *(pa.array(x, pa.int64()) for x in numbers)], names=["_source", "_block", "_slot", "_release", "_deadline"]
            )

    kind = sizes.schema["_source"].dataType.simpleString()
    alone = sizes.repartition(1).sortWithinPartitions(F.asc_nulls_first("_source"))
    return alone.mapInArrow(place, f"_source {kind}, _block bigint, _slot bigint, _release bigint, _deadline bigint")


def mix(docs: DataFrame, weights: dict | None = None, source: str = "source", settings: Mixing = Mixing(), power: float = 0.5) -> DataFrame:
    """``docs`` with their block and its slot; ``slot, in_block`` is the training order.

    Without ``weights`` (source to weight) the sizes to the given power are taken.
    """
    docs = docs.drop(*ADDED)
    aside = {c: f"{c} of the input" for c in docs.columns if c.lower() in OWN}
    if aside:
        mixed = mix(docs.withColumnsRenamed(aside), weights, aside.get(source, source), settings, power)
        return mixed.withColumnsRenamed({v: k for k, v in aside.items()})
    sizes = cut_lineage(source_weights(docs, source, weights, power))
    count = sizes.agg(F.count("*"), F.coalesce(F.sum("_n"), F.lit(0)), F.coalesce(F.sum(F.ceil(F.col("_n") / settings.block)), F.lit(0)))
    sources, rows, blocks = count.first()
    table = cut_lineage(block_schedule(sizes, settings))
    if sources <= settings.most_sources and blocks <= 16 * settings.most_sources:
        table = F.broadcast(table)
    numbered = number_rows(docs, source, rows, settings)
    numbered = numbered.withColumns({"block": F.floor(F.col("_row") / settings.block), "in_block": F.col("_row") % settings.block})
    placed = numbered.join(table, numbered[source].eqNullSafe(table["_source"]) & (F.col("block") == F.col("_block")))
    return placed.withColumns({c: F.col(f"_{c}") for c in ADDED[2:]}).select(*docs.columns, *ADDED)


def number_rows(docs: DataFrame, source: str, rows: int, settings: Mixing) -> DataFrame:
    """``_row``: place of a row in its source, from 0, in the order of a digest of the whole row."""
    bits = min(40, max(0, math.ceil(math.log2(max(1, rows / settings.bucket)))))
    digest = F.xxhash64(F.lit(settings.seed), *[F.col(c) for c in docs.columns])
    keyed = docs.withColumn("_digest", digest).withColumn("_bucket", F.shiftrightunsigned("_digest", 64 - bits) if bits else F.lit(0).cast("bigint"))
    sizes = keyed.groupBy(F.col(source).alias("_name"), F.col("_bucket").alias("_at")).count()
    before = Window.partitionBy("_name").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_name", "_at", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(source, "_bucket").orderBy("_digest")
    numbered = keyed.withColumn("_in", F.row_number().over(inside) - 1)
    found = numbered.join(starts, numbered[source].eqNullSafe(starts["_name"]) & (F.col("_bucket") == F.col("_at")))
    return found.withColumn("_row", F.col("_start") + F.col("_in"))


def in_training_order(mixed: DataFrame) -> DataFrame:
    """The documents themselves, sorted by slot over all partitions."""
    return mixed.orderBy("slot", "in_block").drop(*ADDED)
