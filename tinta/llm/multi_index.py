"""Near-duplicate embeddings with an inverted multi-index.

Unit vectors are halved; each half has a codebook of its own, and the pairs of codes form a grid of cells. For a query the codes of both
halves are ordered by a lower bound of the distance to anything in their cell: ``y`` in cell ``i`` lies nearer to centre ``i`` than to
any centre ``k``, so it lies beyond their bisector. Cells are visited in the order of the sum of both squared bounds (the two sequences are walked
together) until the sum passes the stop, and vectors in visited cells are verified in double precision. With ``target_recall`` 1 the stop is the
squared distance of the threshold, and no link is lost; below 1 it is the quantile of the sums at the true pairs of the sample.

Codebooks are fitted on a bounded sample (``IndexSettings.sample``); every vector is indexed and every vector asks. Equal vectors of a label form a class and are
indexed once with their count. A pair is compared from the cell with the smaller number only. Cells that follow each other form blocks of a label; a
vector is sent to a block once, however many of its cells it visits, and which of them is worked out there again. Blocks are cut into tiles of bounded size on
the side of the members and of the visitors. Links are counted per task, and a spanning forest goes out, not the pairs.

Defined results: NULL, empty and zero vectors, vectors with NULL or non-finite components and rows with a NULL label link with nothing; vectors of
different lengths do not link; repeated rows get a row each; an empty table gives no rows. Columns other than ``vec_id, embedding, label`` are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from tinta.llm.components import components
from tinta.llm.group_rows import forest, groups
from tinta.session import cut_lineage, scratch_path

GROUP = ("cell", "a", "b")
# Ranges of cells that a codebook's grid is cut into: a label has as many blocks at most.
RANGES = 64
# Cells that are walked at once, visitors and members that are compared at once.
WALKED = 2_000_000
VISITORS = 512
MEMBERS = 1024


@dataclass(frozen=True)
class IndexSettings:
    """``cell``: classes of a cell, about, in the largest label; ``most_centres`` bounds a codebook. ``block``: classes of a block, about; ``tile``: the most of them in a task, about."""

    threshold: float = 0.93
    target_recall: float = 1.0
    sample: int = 20_000
    cell: int = 64
    most_centres: int = 256
    rounds: int = 10
    block: int = 32_768
    tile: int = 65_536
    seed: int = 5

    @property
    def reach(self) -> float:
        """Squared distance of unit vectors at the threshold."""
        return 2 - 2 * self.threshold


@dataclass
class Codebooks:
    """Centres of the first and the second half, and the stop."""

    halves: tuple[np.ndarray, np.ndarray]
    stop: float

    def split(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.split(units, [self.halves[0].shape[1]], axis=1)

    def bounds(self, units: np.ndarray) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """Per half: codes, and squared lower bounds of the distance to each centre's region."""
        return tuple(_half_bounds(x, c) for x, c in zip(self.split(units), self.halves))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1)[None], 0)


def _half_bounds(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = squared(x, centres)
    apart = np.sqrt(squared(centres, centres))
    np.fill_diagonal(apart, np.inf)
    apart = np.where(apart == 0, np.inf, apart)
    low = np.zeros_like(d)
    for k in range(len(centres)):
        np.maximum(low, (d - d[:, k : k + 1]) / (2 * apart[k][None, :]), out=low)
    return d.argmin(axis=1), low * low


def fit_centres(x: np.ndarray, count: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    """Lloyd's rounds from distinct sampled points; an empty centre stays where it was."""
    points = np.unique(x, axis=0)
    centres = points[rng.permutation(len(points))[:count]]
    for _ in range(rounds):
        nearest = squared(x, centres).argmin(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        held = np.bincount(nearest, minlength=len(centres))
        centres = np.where(held[:, None] > 0, sums / np.maximum(held, 1)[:, None], centres)
    return centres


def fit(vectors: np.ndarray, labels: list, centres: int, s: IndexSettings) -> Codebooks:
    rng = np.random.default_rng(s.seed)
    units = unit_rows(vectors)
    cut = units.shape[1] // 2
    books = Codebooks(tuple(fit_centres(h, centres, s.rounds, rng) for h in (units[:, :cut], units[:, cut:])), s.reach)
    if s.target_recall < 1:
        sums = []
        (first, low), (second, low2) = books.bounds(units)
        _, names = np.unique(np.asarray(labels).astype(str), return_inverse=True)
        for i in range(0, len(units), 512):
            near = (units[i : i + 512] @ units.T >= s.threshold) & (names[i : i + 512, None] == names[None])
            a, b = np.nonzero(near)
            a, b = (a + i)[a + i != b], b[a + i != b]
            sums.append(low[a, first[b]] + low2[a, second[b]])
        every = np.concatenate(sums)
        books.stop = float(np.quantile(every, s.target_recall)) if len(every) else s.reach
    return books


def visited(low: np.ndarray, low2: np.ndarray, stop: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``query, first code, second code`` of all cells on the walk: both sequences in rising order, until their sum passes the stop."""
    order, order2 = np.argsort(low, axis=1, kind="stable"), np.argsort(low2, axis=1, kind="stable")
    a, b = np.take_along_axis(low, order, 1), np.take_along_axis(low2, order2, 1)
    found = []
    for p in range(a.shape[1]):
        open_ = np.flatnonzero(a[:, p] <= stop + 1e-9)
        if not len(open_):
            break
        query, q = np.nonzero(a[open_, p][:, None] + b[open_] <= stop + 1e-9)
        query = open_[query]
        found.append((query, order[query, p], order2[query, q]))
    return tuple(np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64),) * 3


# ---- tables


def keys() -> list[Column]:
    return [F.xxhash64(F.lit(seed), "label", "embedding").alias(f"h{seed}") for seed in (1, 2)]


def linkable() -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    ok = F.col("label").isNotNull() & F.forall("embedding", finite) & F.exists("embedding", lambda x: x != 0)
    return F.coalesce(ok, F.lit(False))


def class_table(rows: DataFrame) -> DataFrame:
    """Stored ``cno, h1, h2, label, dims, vector, size, vec_id``: equal vectors of a label as one."""
    stored = rows.schema["embedding"].dataType.simpleString()
    vector = F.col("embedding").cast(stored if stored in ("array<float>", "array<double>") else "array<double>")
    grouped = rows.where("linkable").groupBy("h1", "h2").agg(
        F.first("label").alias("label"), F.first(vector).alias("vector"), F.count("*").alias("size"), F.min("vec_id").alias("vec_id")
    )
    path = scratch_path(rows.sparkSession, "vectors")
    grouped.select("*", F.size("vector").alias("dims"), F.monotonically_increasing_id().alias("cno")).write.parquet(path)
    return rows.sparkSession.read.parquet(path)


def fit_codebooks(classes: DataFrame, s: IndexSettings) -> dict[int, Codebooks]:
    """Codebooks per vector length in the sample."""
    sample = classes.select("h1", "label", "dims", "vector").orderBy("h1").limit(s.sample).collect()
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 0
    centres = int(min(s.most_centres, max(2, np.ceil((largest / s.cell) ** 0.5))))
    by_dims: dict[int, list] = {}
    for row in sample:
        by_dims.setdefault(row["dims"], []).append(row)
    return {
        d: fit(np.array([r["vector"] for r in rows]), [r["label"] for r in rows], centres, s) for d, rows in by_dims.items()
    }


def matrix(column: pa.ListArray) -> np.ndarray:
    """Rows in double precision."""
    return column.flatten().to_numpy().astype(np.float64).reshape(len(column), -1)


def _later_ranges(book: Codebooks, units: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Own cells and their ranges; ``query, range`` of all later ranges that hold a visited cell."""
    width = len(book.halves[1])
    cells_of, found = len(book.halves[0]) * width, []
    step = max(1, WALKED // cells_of)
    own = np.zeros(len(units), np.int64)
    for begin in range(0, len(units), step):
        (first, low), (second, low2) = book.bounds(units[begin : begin + step])
        own[begin : begin + step] = first * width + second
        query, i, j = visited(low, low2, book.stop)
        found.append(np.unique((begin + query) * RANGES + (i * width + j) * RANGES // cells_of))
    query, range_ = np.divmod(np.concatenate(found) if found else np.zeros(0, np.int64), RANGES)
    part = own * RANGES // cells_of
    later = range_ > part[query]
    return own, part, query[later], range_[later]


def coded(classes: DataFrame, shared) -> DataFrame:
    """``cno, label, dims, code, part, visits``: own cell and its range, and the later ranges that hold visited cells. Unknown lengths have one cell.

    ``shared`` holds the codebooks, which are bounded by the number of centres.
    """

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d in pc.unique(batch.column("dims")).to_pylist():
                part = batch.filter(pc.equal(batch.column("dims"), d))
                n, book = part.num_rows, shared.value.get(d)
                own, ranges, visits, each = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(0, np.int64), np.zeros(n, np.int64)
                if book is not None:
                    own, ranges, query, visits = _later_ranges(book, unit_rows(matrix(part.column("vector"))))
                    each = np.bincount(query, minlength=n)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(each))).astype(np.int32)), pa.array(visits.astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("cno"), part.column("label"), part.column("dims"), pa.array(own), pa.array(ranges.astype(np.int32)), lists],
                    names=["cno", "label", "dims", "code", "part", "visits"],
                )

    kind = classes.schema["label"].dataType.simpleString()
    rows = classes.select("cno", "label", "dims", "vector").mapInArrow(code, f"cno bigint, label {kind}, dims int, code bigint, part int, visits array<int>")
    path = scratch_path(classes.sparkSession, "codes")
    rows.write.parquet(path)
    return classes.sparkSession.read.parquet(path)


def placed(codes: DataFrame, s: IndexSettings) -> DataFrame:
    """``cell, a, b, t, cno, code``: every class in the groups where it is compared; ``cell`` names a block of a label.

    ``b >= 0``: pairs of the tiles ``a`` and ``b`` of a block's members; ``b < 0``: member tile ``a`` with visitor tile ``-b - 1``. ``t`` is the own tile of a
    member in the first kind, and 0 for members and 1 for visitors in the second.
    """
    block = ["label", "dims", "block"]
    blocks = codes.groupBy("label", "dims").agg(F.least(F.ceil(F.count("*") / s.block), F.lit(RANGES)).cast("int").alias("blocks"))
    of = lambda range_: F.floor(range_ * F.col("blocks") / RANGES).cast("int")
    codes = codes.join(blocks, ["label", "dims"]).withColumn("block", of(F.col("part")))
    members = codes.select("cno", "code", *block)
    others = F.filter(F.array_distinct(F.transform("visits", of)), lambda other: other > F.col("block"))
    visitors = codes.select("cno", "code", "label", "dims", F.explode(others).alias("block"))
    tiles = lambda n: F.ceil(n / s.tile).cast("int")
    sizes = members.groupBy(*block).agg(tiles(F.count("*")).alias("km"))
    sizes = sizes.join(visitors.groupBy(*block).agg(tiles(F.count("*")).alias("kv")), block, "left").fillna(0, ["kv"])
    sizes = cut_lineage(sizes.withColumn("cell", F.monotonically_increasing_id()))
    tile = lambda seed, count: F.pmod(F.xxhash64(F.lit(seed), "cno"), count).cast("int")
    upto = lambda count: F.explode(F.sequence(F.lit(0), count - 1))
    held = members.join(sizes, block).withColumn("t", tile(1, F.col("km")))
    among = held.withColumn("o", upto(F.col("km"))).select("cell", F.least("t", "o").alias("a"), F.greatest("t", "o").alias("b"), "t", "cno", "code")
    facing = held.where("kv > 0").withColumn("v", upto(F.col("kv")))
    facing = facing.select("cell", F.col("t").alias("a"), (-F.col("v") - 1).alias("b"), F.lit(0).alias("t"), "cno", "code")
    asking = visitors.join(sizes, block).withColumn("v", tile(2, F.col("kv"))).withColumn("a", upto(F.col("km")))
    asking = asking.select("cell", "a", (-F.col("v") - 1).alias("b"), F.lit(1).alias("t"), "cno", "code")
    return among.unionByName(facing).unionByName(asking)


def linked(x: np.ndarray, code: np.ndarray, book: Codebooks | None, asking: np.ndarray, members: np.ndarray, threshold: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``x`` that are linked: one that asks, and one that is a member of a later cell it visits; with ``same``, or of its own cell.

    Members stand in the order of their cells, and a run of them is compared with the vectors that visit one of its cells.
    """
    norms, found = np.linalg.norm(x, axis=1), []
    members = members[np.argsort(code[members], kind="stable")]
    for begin in range(0, len(asking), VISITORS):
        ask = asking[begin : begin + VISITORS]
        if book is not None:
            width = len(book.halves[1])
            (_, low), (_, low2) = book.bounds(x[ask] / norms[ask][:, None])
        for at in range(0, len(members), MEMBERS):
            run = members[at : at + MEMBERS]
            cells = np.unique(code[run])
            met = cells[None] >= code[ask][:, None] + (not same)
            if book is not None:
                met &= low[:, cells // width] + low2[:, cells % width] <= book.stop + 1e-9
            rows = np.flatnonzero(met.any(axis=1))
            if not len(rows):
                continue
            close = (x[ask[rows]] @ x[run].T) / (norms[ask[rows]][:, None] * norms[run][None]) >= threshold
            i, j = np.nonzero(close)
            kept = met[rows[i], np.searchsorted(cells, code[run[j]])]
            found.append((ask[rows[i[kept]]], run[j[kept]]))
    return tuple(np.concatenate(part) for part in zip(*found)) if found else (np.zeros(0, np.int64),) * 2


def verified(places: DataFrame, classes: DataFrame, s: IndexSettings, shared) -> DataFrame:
    """``cno, links, other``: counts of linked vectors per class, and edges of spanning forests (``other`` not NULL)."""
    rows = places.join(classes.select("cno", "size", "vector"), "cno").repartition(*GROUP).sortWithinPartitions(*GROUP)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, GROUP):
            a, b = group.column("a")[0].as_py(), group.column("b")[0].as_py()
            t = group.column("t").to_numpy()
            left, right = (np.flatnonzero(t == 1), np.flatnonzero(t == 0)) if b < 0 else (np.flatnonzero(t == a), np.flatnonzero(t == b))
            if not len(left) or not len(right):
                continue
            x, code = matrix(group.column("vector")), group.column("code").to_numpy()
            book = shared.value.get(x.shape[1])
            i, j = linked(x, code, book, left, right, s.threshold, b >= 0)
            if a == b:
                once = (code[i] != code[j]) | (i < j)
                i, j = i[once], j[once]
            elif b >= 0:
                i, j = (np.concatenate(both) for both in zip((i, j), linked(x, code, book, right, left, s.threshold, False)))
            if not len(i):
                continue
            cno, size, m = group.column("cno").to_numpy(), group.column("size").to_numpy(), len(t)
            links = (np.bincount(i, size[j], m) + np.bincount(j, size[i], m)).astype(np.int64)
            at = np.flatnonzero(links)
            low, high = forest(i, j, m)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((cno[at], cno[low]))),
                    pa.array(np.concatenate((links[at], np.zeros(len(low), np.int64)))),
                    pa.array(np.concatenate((np.zeros(len(at), np.int64), cno[high])), mask=np.arange(len(at) + len(low)) < len(at)),
                ],
                names=["cno", "links", "other"],
            )

    return cut_lineage(rows.mapInArrow(compare, "cno bigint, links bigint, other bigint"))


def near_vectors(embeddings: DataFrame, s: IndexSettings = IndexSettings()) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every row of ``vec_id, embedding, label``."""
    rows = embeddings.select("vec_id", "embedding", "label", linkable().alias("linkable"), *keys())
    classes = class_table(rows)
    shared = embeddings.sparkSession.sparkContext.broadcast(fit_codebooks(classes, s))
    result = verified(placed(coded(classes, shared), s), classes, s, shared)
    links = result.groupBy("cno").agg(F.sum("links").alias("links"))
    labels = components(result.where("other IS NOT NULL").select(F.col("cno").alias("a"), F.col("other").alias("b")))
    labels = labels.select(F.col("node").alias("cno"), F.col("label").alias("component"))
    named = classes.select("cno", "h1", "h2", "size", "vec_id").join(labels, "cno", "left").join(links, "cno", "left")
    named = cut_lineage(named.withColumn("component", F.coalesce("component", "cno")))
    smallest = named.groupBy("component").agg(F.min("vec_id").alias("smallest"))
    named = named.join(smallest, "component").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("others"), "smallest", F.lit(True).alias("linkable")
    )
    alone = ~F.col("linkable")
    return rows.drop("embedding", "label").join(named, ["h1", "h2", "linkable"], "left").select(
        "vec_id",
        F.when(alone, 0).otherwise(F.col("others")).cast("bigint").alias("n_links"),
        F.when(alone, F.col("vec_id")).otherwise(F.col("smallest")).cast("bigint").alias("component_id"),
        F.when(alone, True).otherwise(F.col("vec_id") == F.col("smallest")).alias("kept"),
    )
