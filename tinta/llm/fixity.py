"""Fixity audit of WARC replicas with Merkle trees.

A record's leaf is a digest of its bytes. Records lie in files in the order of their ids, so a range of ids is a range of
offsets; a node covers ``fanout`` neighbouring nodes of the level below and hashes their numbers and digests in order. Three levels
above the leaves stand for one file, the levels beyond for ranges of files, the top is the replica. Two replicas are compared from
the top down: only the children of nodes that differ are read.

Trees are tables (one row per node and level) in the shared folder. They are compared level by level with joins of the open nodes.

Defined results: records with one id form one leaf from their count and sums of digest parts, so their order and number of tasks do not
matter; NULL ids form the leaf ``NULL``, which hangs below the top; NULL urls and bodies are hashed as such, unlike empty
ones; an empty replica has no nodes, and all records of the other are missing. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from tinta.session import cut_lineage, scratch_path

FANOUT = 16
FILE_LEVEL = 3


def warc_record(record_id: Column, url: Column, body: Column) -> Column:
    """Bytes of a response record."""
    body = F.coalesce(body.cast("binary"), F.lit(b""))
    head = F.concat(
        F.lit("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(record_id.cast("string"), F.lit("")),
        F.lit(">\r\nWARC-Target-URI: "),
        F.coalesce(url, F.lit("")),
        F.lit("\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit("\r\n\r\n"),
    )
    return F.concat(head.cast("binary"), body, F.lit(b"\r\n\r\n"))


def leaves(pages: DataFrame) -> DataFrame:
    """``node, digest, records, bytes`` per record id, from ``page_id, url, html``."""
    missing = F.concat(F.col("url").isNull().cast("string"), F.col("html").isNull().cast("string"))
    hashed = pages.select(F.col("page_id").cast("bigint").alias("node"), warc_record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"), missing.alias("missing"))
    hashed = hashed.select("node", F.octet_length("record").cast("bigint").alias("bytes"), F.sha2(F.concat("record", F.col("missing").cast("binary")), 256).alias("hex"))
    # four 60-bit parts, added per id: the sums do not depend on the order of the rows
    parts = [F.sum(F.conv(F.substring("hex", 1 + 16 * i, 15), 16, 10).cast("decimal(20,0)")).cast("string").alias(f"p{i}") for i in range(4)]
    summed = hashed.groupBy("node").agg(F.count("*").alias("records"), F.sum("bytes").alias("bytes"), *parts)
    digest = F.sha2(F.concat_ws(",", F.col("records").cast("string"), "p0", "p1", "p2", "p3").cast("binary"), 256)
    return summed.select("node", digest.alias("digest"), "records", "bytes")


def parent(node: Column, fanout: int, levels: int = 1) -> Column:
    return F.floor(node / F.lit(fanout**levels)).cast("bigint")


def build_tree(pages: DataFrame, name: str, levels: int, fanout: int = FANOUT) -> DataFrame:
    """Tree of a replica as a stored table: ``level, node, digest, records, bytes``.

    Level 0 holds the leaves, ``levels`` the top; ids from ``-fanout**levels`` to below ``fanout**levels`` come under one or two nodes there.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, f"merkle-{name}")
    leaves(pages).write.parquet(f"{path}/level=0")
    for level in range(1, levels + 1):
        below = spark.read.parquet(f"{path}/level={level - 1}")
        child = F.concat_ws(":", F.coalesce(F.col("node").cast("string"), F.lit("null")), "digest")
        ordered = F.transform(F.array_sort(F.collect_list(F.struct("node", child.alias("child")))), lambda c: c["child"])
        up = below.groupBy(parent(F.col("node"), fanout).alias("node")).agg(
            F.sha2(F.array_join(ordered, "\n").cast("binary"), 256).alias("digest"),
            F.sum("records").alias("records"),
            F.sum("bytes").alias("bytes"),
        )
        up.write.parquet(f"{path}/level={level}")
    return spark.read.parquet(path)


def levels_for(pages: list[DataFrame], fanout: int = FANOUT) -> int:
    """Levels until all ids of the replicas come under one node per sign; never below the level of files."""
    most = reduce(DataFrame.unionByName, [p.select(F.max(F.abs(F.col("page_id").cast("decimal(20,0)"))).alias("m")) for p in pages])
    largest, levels = int(most.agg(F.max("m")).first()[0] or 0), FILE_LEVEL
    while fanout**levels <= largest:
        levels += 1
    return levels


def compare(one: DataFrame, other: DataFrame, levels: int, fanout: int = FANOUT) -> DataFrame:
    """Leaves that differ: ``node, status`` and the counts on both sides; only below nodes that differ is anything read."""
    open_nodes: DataFrame | None = None
    for level in range(levels, -1, -1):
        sides = []
        for side, tree in (("a", one), ("b", other)):
            rows = tree.where(F.col("level") == level).select("node", "digest", "records", "bytes")
            if open_nodes is not None:
                up = parent(F.col("node"), fanout)
                rows = rows.join(open_nodes.select(F.col("node").alias("_open")), up.eqNullSafe(F.col("_open")), "left_semi")
            sides.append(rows.select(F.col("node").alias(f"{side}_node"), *[F.col(c).alias(f"{side}_{c}") for c in ("digest", "records", "bytes")]))
        both = sides[0].join(sides[1], F.col("a_node").eqNullSafe(F.col("b_node")), "full_outer")
        differ = both.where(~F.col("a_digest").eqNullSafe(F.col("b_digest")))
        open_nodes = cut_lineage(differ.withColumn("node", F.coalesce("a_node", "b_node")))
    status = (
        F.when(F.col("b_digest").isNull(), "missing")
        .when(F.col("a_digest").isNull(), "extra")
        .when(F.col("a_records") != F.col("b_records"), "count")
        .otherwise("changed")
    )
    return open_nodes.select("node", status.alias("status"), "a_records", "b_records")


def offsets(tree: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``node, file, first_byte, bytes``: where each leaf of a replica lies in its file; a file has few leaves by its definition."""
    inside = Window.partitionBy("file").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
    leaf = tree.where("level = 0").select("node", parent(F.col("node"), fanout, FILE_LEVEL).alias("file"), "bytes")
    return leaf.withColumn("first_byte", F.coalesce(F.sum("bytes").over(inside), F.lit(0)))


def audit(primary: DataFrame, replica: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """``page_id, status, records, replica_records, file, first_byte, bytes`` of every record that differs.

    The place is that in the primary; it is NULL for a record that only the replica has.
    """
    levels = levels_for([primary, replica], fanout)
    one, other = build_tree(primary, "primary", levels, fanout), build_tree(replica, "replica", levels, fanout)
    found = compare(one, other, levels, fanout).select(F.col("node").alias("page_id"), "status", F.col("a_records").alias("records"), F.col("b_records").alias("replica_records"))
    # offsets are needed in the files that hold a difference, nowhere else
    files = found.select(parent(F.col("page_id"), fanout, FILE_LEVEL).alias("_file")).distinct()
    leaf = one.where("level = 0")
    touched = leaf.join(files, parent(leaf["node"], fanout, FILE_LEVEL).eqNullSafe(F.col("_file")), "left_semi")
    at = offsets(touched, fanout)
    return found.join(at, F.col("page_id").eqNullSafe(F.col("node")), "left").drop("node")
