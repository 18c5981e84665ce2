"""Near-duplicate documents: a chosen-path join on word shingles.

1. Documents with one shingle set form a class; classes stand for their documents from here on.
2. In each run a class selects tokens of its set with a shared hash: token ``x`` if ``h(run, x) < first_branches / size``. Every selected
   token opens a path; classes on one path form a bucket. Similar sets select shared tokens, others hardly do.
3. Buckets above a limit are split again: each member extends the path by tokens of its set, drawn from a bottom-k sample, until
   buckets are small. A bucket whose members share most of their extensions is dense: splitting would not divide it, so it is compared as it is.
4. Buckets are compared by brute force. Large dense ones are cut into tiles, and each pair of tiles is a task of its own. A pair that meets in
   several buckets counts in the first of them alone; a task knows this from the buckets of its members, so links are counted
   without a row per pair. Sets travel only for members that have a pair to
   compare whose bottom-k samples look alike.
5. Runs are repeated until a pair at the threshold is found with the target recall.

Per task the links are counted and a spanning forest goes out, so output grows with the documents, not with their pairs.

Recall: a pair of similarity ``s`` shares at least the part ``s`` of what either selects. ``runs_for`` works out how often a pair at the threshold
is lost in a run that splits on and on, and repeats. Verification is exact on 64-bit hashes.

Defined results: words are runs of letters and digits with A-Z in lower case; a text of one to four words is one shingle; a NULL text or one
without words links with nothing and stands alone; documents of a class are linked with each other; repeated rows stay rows; NULL ids
are the largest; an empty table gives no rows. Extra columns are kept by ``deduplicate`` and ignored elsewhere.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tinta.llm.byte_words import _mix, small_batches
from tinta.llm.components import components
from tinta.llm.group_rows import forest, groups
from tinta.llm.set_hashes import set_digest, shingle_sets
from tinta.session import cut_lineage, drop_scratch, scratch_path


GROUP = ("fid", "ti", "tj")
# Cells of a matrix of members and values, and bytes of sets that leave a task at once.
BLOCK_CELLS = 1 << 21
SENT_BYTES = 4 << 20


@dataclass(frozen=True)
class JoinSettings:
    """``limit``: members of a bucket that is not split; ``tile``: classes of a tile; ``alike``: share of the samples that a pair must have in common to be
    verified; ``dense``: share of common
    extensions from which a bucket counts as dense; ``deepest``: levels after which a bucket is compared whatever its size."""

    shingle: int = 5
    threshold: float = 0.8
    target_recall: float = 0.9999
    first_branches: float = 3.0
    branches: float = 2.0
    sample: int = 48
    alike: float = 0.5
    limit: int = 256
    tile: int = 512
    dense: float = 0.4
    deepest: int = 30

    @property
    def runs(self) -> int:
        return runs_for(self)


def lost_in_a_run(s: JoinSettings) -> float:
    """Chance that a pair at the threshold is never together in a bucket of one run, however deep buckets are split.

    Shared selections are at least Poisson with mean ``branches * threshold`` per node, so the chance to be lost below a node
    follows a branching process; it rises with the levels to a fixed point, which ``deepest`` levels come close to from below.
    """
    lost = 0.0
    for _ in range(10_000):
        lost = math.exp(-s.branches * s.threshold * (1 - lost))
    return math.exp(-s.first_branches * s.threshold * (1 - lost))


def runs_for(s: JoinSettings) -> int:
    """Runs after which a pair at the threshold has been together in a bucket with the target recall."""
    return max(1, math.ceil(math.log(1 - s.target_recall) / math.log(lost_in_a_run(s))))


def _run_keys(runs: int) -> np.ndarray:
    return _mix(np.arange(1, runs + 1, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


def _below(share: float) -> np.uint64:
    return np.uint64(min(int(share * 2**64), 2**64 - 1))


def extend(keys: np.ndarray, tokens: np.ndarray, branches: float) -> tuple[np.ndarray, np.ndarray]:
    """``which key, longer path``: the tokens that each path key selects of a set."""
    if len(tokens) <= branches:
        which, at = np.divmod(np.arange(len(keys) * len(tokens)), len(tokens))
    else:
        which, at = np.nonzero(keys[:, None] * tokens[None, :] < _below(branches / len(tokens)))
    return which, _mix(keys[which] ^ _mix(tokens[at]))


# ---- classes


def row_keys() -> list[Column]:
    """Two 64-bit digests that name a row by its id and text."""
    values = [F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.coalesce(F.col("text"), F.lit(""))]
    return [F.xxhash64(F.lit(seed), *values).alias(f"k{seed}") for seed in (1, 2)]


def keyed_rows(docs: DataFrame, s: JoinSettings) -> DataFrame:
    """``doc_id, k1, k2, cls, n`` of every row, stored; ``cls`` names the set of shingles."""
    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(set_digest(t), len(t)) for t in shingle_sets(batch.column("text"), s.shingle)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:3], pa.array([d for d, _ in sets], pa.binary()), pa.array([n for _, n in sets], pa.int32())],
                names=["doc_id", "k1", "k2", "cls", "n"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", *row_keys(), "text").mapInArrow(name, f"doc_id {kind}, k1 bigint, k2 bigint, cls binary, n int")
    path = scratch_path(docs.sparkSession, "keys")
    rows.write.parquet(path)
    return docs.sparkSession.read.parquet(path)


def class_table(keys: DataFrame, folder: str) -> DataFrame:
    """Stored ``cno, cls, size, doc_id, k1, k2, n``: a row per class, with the row that stands for it."""
    spark, path = keys.sparkSession, f"{folder}/classes"
    chosen = keys.where("n > 0").groupBy("cls").agg(
        F.count("*").alias("size"), F.min("doc_id").alias("doc_id"), F.min(F.struct("k1", "k2")).alias("k"), F.first("n").alias("n")
    )
    chosen = chosen.select("cls", "size", "doc_id", "k.k1", "k.k2", "n", F.monotonically_increasing_id().alias("cno"))
    chosen.write.parquet(path)
    return spark.read.parquet(path)


def signatures(docs: DataFrame, s: JoinSettings) -> DataFrame:
    """``cls, paths, sample`` of every different set; the same for all its documents."""
    runs = _run_keys(s.runs)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, list, list] = ([], [], [])
            seen = set()
            for tokens in shingle_sets(batch.column("text"), s.shingle):
                digest = set_digest(tokens)
                if len(tokens) and digest not in seen:
                    seen.add(digest)
                    _, paths = extend(runs, tokens, s.first_branches)
                    for column, value in zip(out, (digest, paths.view(np.int64), tokens[: s.sample].view(np.int64))):
                        column.append(value)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.binary()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.list_(pa.int64()))],
                names=["cls", "paths", "sample"],
            )

    signed = docs.select("text").mapInArrow(sign, "cls binary, paths array<bigint>, sample array<bigint>")
    return signed.groupBy("cls").agg(F.first("paths").alias("paths"), F.first("sample").alias("sample"))


# ---- buckets


def final_buckets(signed: DataFrame, s: JoinSettings, folder: str) -> DataFrame:
    """``fid, cno, members``: buckets to compare. Equal buckets have one id, and ids of larger buckets are smaller."""
    spark = signed.sparkSession
    found: list[DataFrame] = []
    rows = signed.select("cno", F.explode("paths").alias("path"))
    open_ = _with_sizes(rows).where("members > 1")
    for level in range(1, s.deepest + 1):
        path = f"{folder}/paths-{level}"
        open_.write.parquet(path)
        held = spark.read.parquet(path)
        found.append(held.where(F.col("members") <= s.limit))
        large = held.where(F.col("members") > s.limit)
        if not large.limit(1).count():
            break
        if level == s.deepest:
            found.append(large)
            break
        longer = _extended(large, signed, s, f"{folder}/longer-{level}")
        counts = longer.groupBy("path", "child").count()
        pairs = F.sum(F.col("count") * (F.col("count") - 1.0))
        shared = counts.groupBy("path").agg(pairs.alias("pairs"))
        sizes = large.groupBy("path").agg(F.first("members").alias("members"))
        judged = sizes.join(shared, "path", "left").withColumn(
            "dense", F.coalesce("pairs", F.lit(0.0)) >= s.dense * s.branches * F.col("members") * (F.col("members") - 1.0)
        )
        judged = cut_lineage(judged.select("path", "dense"))
        dense = judged.where("dense").select("path")
        found.append(large.join(dense, "path", "left_semi"))
        rows = longer.join(dense, "path", "left_anti").select("cno", F.col("child").alias("path"))
        open_ = _with_sizes(rows).where("members > 1")
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    # the id holds the size, largest first, and a digest of the members
    rank = F.shiftleft(F.lit((1 << 22) - 1) - F.least("members", F.lit((1 << 22) - 1)), 40)
    fid = rank.bitwiseOR(F.col("mark").bitwiseAND(F.lit((1 << 40) - 1)))
    return every.select(fid.alias("fid"), "cno", "members").distinct()


def _with_sizes(rows: DataFrame) -> DataFrame:
    """Rows ``path, cno`` with the members of their path and a digest of them."""
    sizes = rows.groupBy("path").agg(F.count("*").alias("members"), F.bit_xor(F.xxhash64("cno")).alias("mark")).where("members > 1")
    return rows.join(sizes, "path")


def _extended(large: DataFrame, signed: DataFrame, s: JoinSettings, path: str) -> DataFrame:
    """``path, child, cno``: the longer paths of all members, stored because they are counted and split."""
    def grow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parents, children, classes = [], [], []
            for cno, paths, sample in zip(batch.column("cno").to_pylist(), batch.column("paths"), batch.column("sample")):
                keys = paths.values.to_numpy().view(np.uint64)
                which, child = extend(keys | np.uint64(1), sample.values.to_numpy().view(np.uint64), s.branches)
                parents.append(keys[which].view(np.int64))
                children.append(child.view(np.int64))
                classes.append(np.full(len(child), cno))
            if classes:
                arrays = [pa.array(np.concatenate(x).astype(np.int64)) for x in (parents, children, classes)]
                yield pa.RecordBatch.from_arrays(arrays, names=["path", "child", "cno"])

    per_class = large.groupBy("cno").agg(F.collect_list("path").alias("paths"))  # a class has few paths by the branching numbers
    rows = per_class.join(signed.select("cno", "sample"), "cno").mapInArrow(grow, "path bigint, child bigint, cno bigint")
    rows.write.parquet(path)
    return large.sparkSession.read.parquet(path)


# ---- comparison


def tiled(buckets: DataFrame, s: JoinSettings) -> DataFrame:
    """``fid, ti, tj, cno, t``: a member in every pair of tiles that holds its own tile ``t``."""
    tiles = F.ceil(F.col("members") / s.tile).cast("int")
    own = buckets.withColumn("t", F.pmod(F.xxhash64("cno", "fid"), tiles).cast("int"))
    meets = own.withColumn("o", F.explode(F.sequence(F.lit(0), tiles - 1)))
    return meets.select("fid", F.least("t", "o").alias("ti"), F.greatest("t", "o").alias("tj"), "cno", "t")


def common_counts(rows: np.ndarray, values: np.ndarray, m: int) -> np.ndarray:
    """Matrix of how many values each pair of rows has in common, added up over blocks of values, so that only the result is ``m * m``."""
    _, which = np.unique(values, return_inverse=True)
    held = np.bincount(which)[which] > 1 if len(which) else np.zeros(0, bool)  # a value of one row adds nothing
    names, which = np.unique(which[held], return_inverse=True)
    order = np.argsort(which, kind="stable")
    which, of = which[order], rows[held][order]
    common = np.zeros((m, m), np.float32)
    width = min(max(1, len(names)), max(64, BLOCK_CELLS // m))
    for first in range(0, len(names), width):
        b, e = np.searchsorted(which, (first, first + width))
        block = np.zeros((m, width), np.float32)
        block[of[b:e], which[b:e] - first] = 1
        common += block @ block.T
    return common


def list_rows(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Row and value of every element."""
    return np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()


def own_pairs(group: pa.RecordBatch, threshold: float) -> np.ndarray:
    """Matrix of the pairs that are compared in this group: sizes fit, and no bucket before this one holds both."""
    fid, ti, tj = (group.column(c)[0].as_py() for c in GROUP)
    t = group.column("t").to_numpy()
    n = group.column("n").to_numpy().astype(np.float64)
    m = len(t)
    pairs = np.triu(np.ones((m, m), bool), 1)
    if ti != tj:
        pairs = (t == ti)[:, None] & (t == tj)[None, :]
    pairs &= np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :])
    of, fids = list_rows(group.column("fids"))
    before = fids < fid
    return pairs & (common_counts(of[before], fids[before], m) == 0) if before.any() else pairs


def alike(group: pa.RecordBatch, s: JoinSettings) -> np.ndarray:
    """Matrix of the pairs whose samples share enough.

    Of a pair at a threshold of 0.8 the 48 smallest hashes of the union are common with chance 0.8 each, so both samples share fewer than half of them with a
    chance of one in a million; a sample shorter than that is the whole set. Samples hold 16 bits of each hash, so chance hits only add pairs.
    """
    of, sample = list_rows(group.column("sample"))
    n = np.minimum(group.column("n").to_numpy(), s.sample)
    return common_counts(of, sample, group.num_rows) >= s.alike * np.maximum(n[:, None], n[None, :])


def compared(buckets: DataFrame, classes: DataFrame, signed: DataFrame, s: JoinSettings) -> DataFrame:
    """``k1, k2, cno, n, size, fids, places``: classes with a pair to compare, and the groups where that is."""
    fids = buckets.groupBy("cno").agg(F.sort_array(F.collect_list("fid")).alias("fids"))
    short = signed.select("cno", F.transform("sample", lambda x: (x.bitwiseAND(F.lit(0xFFFF)) - F.lit(0x8000)).cast("smallint")).alias("sample"))
    members = classes.select("cno", "n").join(fids, "cno").join(short, "cno")
    rows = tiled(buckets, s).join(members, "cno").repartition(*GROUP).sortWithinPartitions(*GROUP)

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, GROUP):
            pairs = own_pairs(group, s.threshold)
            pairs &= alike(group, s)
            used = pa.array(pairs.any(axis=0) | pairs.any(axis=1))
            yield group.select(["cno", *GROUP, "t"]).filter(used)

    places = rows.mapInArrow(needed, "cno bigint, fid bigint, ti int, tj int, t int")
    places = places.groupBy("cno").agg(F.collect_list(F.struct(*GROUP, "t")).alias("places"))
    return cut_lineage(places.join(fids, "cno").join(classes.select("cno", "k1", "k2", "n", "size"), "cno"))


def overlaps(sets: list[np.ndarray], pairs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``i, j, common`` of the marked pairs."""
    i, j = np.nonzero(pairs)
    m = len(sets)
    if len(i) <= 4 * m:
        return i, j, np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(i, j)], np.int64)
    common = common_counts(np.repeat(np.arange(m), [len(x) for x in sets]), np.concatenate(sets), m)
    return i, j, common[i, j].astype(np.int64)


def verified(docs: DataFrame, wanted: DataFrame, s: JoinSettings) -> DataFrame:
    """``cno, links, other``: counts of linked documents per class, and edges of spanning forests (``other`` not NULL)."""
    named = docs.select(*row_keys(), "text")
    rows = named.join(wanted, ["k1", "k2"]).dropDuplicates(["k1", "k2"])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = list(shingle_sets(batch.column("text"), s.shingle))
            each = batch.column("places").value_lengths().to_numpy()
            of = np.repeat(np.arange(batch.num_rows), each)
            places = batch.column("places").flatten().flatten()
            sent = np.cumsum(np.array([8 * len(x) for x in sets], np.int64)[of]) // SENT_BYTES
            cuts = [0, *(np.flatnonzero(np.diff(sent)) + 1).tolist(), len(of)]
            for b, e in zip(cuts[:-1], cuts[1:]):
                part = of[b:e]
                take = pa.array(part)
                yield pa.RecordBatch.from_arrays(
                    [*[p.slice(b, e - b) for p in places], *[batch.column(c).take(take) for c in ("cno", "n", "size", "fids")], pa.array([sets[i].tobytes() for i in part], pa.binary())],
                    names=["fid", "ti", "tj", "t", "cno", "n", "size", "fids", "tokens"],
                )

    schema = "fid bigint, ti int, tj int, t int, cno bigint, n int, size bigint, fids array<bigint>, tokens binary"
    spread_ = rows.mapInArrow(spread, schema).repartition(*GROUP).sortWithinPartitions(*GROUP)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches, GROUP):
            sets = [np.frombuffer(x, np.uint64) for x in group.column("tokens").to_pylist()]
            i, j, common = overlaps(sets, own_pairs(group, s.threshold))
            n = np.array([len(x) for x in sets])
            link = common >= s.threshold * (n[i] + n[j] - common) - 1e-9
            i, j = i[link], j[link]
            if not len(i):
                continue
            cno, size = group.column("cno").to_numpy(), group.column("size").to_numpy()
            links = np.bincount(i, size[j], len(sets)) + np.bincount(j, size[i], len(sets))
            at = np.flatnonzero(links)
            a, b = forest(i, j, len(sets))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate((cno[at], cno[a]))),
                    pa.array(np.concatenate((links[at].astype(np.int64), np.zeros(len(a), np.int64)))),
                    pa.array(np.concatenate((np.zeros(len(at), np.int64), cno[b])), mask=np.arange(len(at) + len(a)) < len(at)),
                ],
                names=["cno", "links", "other"],
            )

    return cut_lineage(spread_.mapInArrow(compare, "cno bigint, links bigint, other bigint"))


def near_duplicates(docs: DataFrame, s: JoinSettings = JoinSettings()) -> DataFrame:
    """One row per row of ``docs`` (``doc_id, text``).

    ``class_id``: smallest id with the same shingles; ``n_links``: other documents of similarity at or above the threshold;
    ``component_id``: smallest id that links lead to; ``kept``: whether the row stands for its component; ``k1, k2``: digests that name the row.
    """
    small_batches(docs.sparkSession)
    spark = docs.sparkSession
    folder = scratch_path(spark, "chosen-path")
    keys = keyed_rows(docs, s)
    classes = class_table(keys, folder)
    signatures(docs, s).join(classes.select("cls", "cno"), "cls").drop("cls").write.parquet(f"{folder}/signed")
    signed = spark.read.parquet(f"{folder}/signed")
    buckets = cut_lineage(final_buckets(signed, s, folder))
    result = verified(docs, compared(buckets, classes, signed, s), s)
    links = result.groupBy("cno").agg(F.sum("links").alias("links"))
    labels = components(result.where("other IS NOT NULL").select(F.col("cno").alias("a"), F.col("other").alias("b")))
    named = classes.join(labels.withColumnRenamed("node", "cno"), "cno", "left").join(links, "cno", "left")
    named = named.withColumn("label", F.coalesce("label", "cno"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k1", "k2")
    # of a class, the row with the smallest id stands for it
    smallest = keys.where("n > 0").groupBy("cls").agg(F.min(first).alias("first"))
    named = cut_lineage(named.select("cls", "cno", "label", "size", "links").join(smallest, "cls"))
    drop_scratch(spark, folder)  # all that follows reads the stored keys and this checkpoint
    top = named.groupBy("label").agg(F.min("first").alias("top"))
    named = named.join(top, "label").select(
        "cls",
        F.col("first.doc_id").alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links"),
        F.col("top.doc_id").alias("component_id"),
        F.col("top.k1").alias("top1"),
        F.col("top.k2").alias("top2"),
    )
    alone = F.col("n") == 0
    return keys.join(named, "cls", "left").select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, 0).otherwise(F.col("n_links")).cast("bigint").alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        (alone | ((F.col("k1") == F.col("top1")) & (F.col("k2") == F.col("top2")))).alias("kept"),
        "k1",
        "k2",
    )


def deduplicate(docs: DataFrame, s: JoinSettings = JoinSettings()) -> DataFrame:
    """The documents, one of each component; of rows that repeat in full one stays if they have words."""
    kept = near_duplicates(docs, s).where("kept").select("k1", "k2").distinct()
    held = {c.lower() for c in docs.columns}
    k1, k2 = (next(n for n in (f"_k{i}" + "_" * j for j in range(len(held) + 1)) if n not in held) for i in (1, 2))
    named = docs.withColumns(dict(zip((k1, k2), row_keys())))
    stay = named.join(kept.toDF(f"{k1}of", f"{k2}of"), (F.col(k1) == F.col(f"{k1}of")) & (F.col(k2) == F.col(f"{k2}of")), "left_semi")
    return stay.dropDuplicates([k1, k2]).drop(k1, k2)
