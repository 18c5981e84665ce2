"""Train/validation/test splits and first rows of a split."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tinta.operators.ranking import keys_at_ranks, shuffle_key

SEED = 42
TRAIN_SHARE = 0.70
VALIDATION_SHARE = 0.15


def split_rows(
    df: DataFrame,
    row_id: str,
    seed: int = SEED,
    shares: tuple[float, float, float] = (TRAIN_SHARE, VALIDATION_SHARE, 0.15),
) -> DataFrame:
    """Add ``split`` and the ``shuffle_key`` it follows from: exact 70/15/15 sizes, the rest is test.

    Cut points are the truncated double products, so 90 rows give 62 and not 63 for training. Only
    the ids are counted and sorted; the rows themselves are compared with the two cut digests and
    never shuffled. Ids must be unique.
    """
    if shares != (TRAIN_SHARE, VALIDATION_SHARE, 0.15):
        raise ValueError("only the 70/15/15 split is supported")

    def train_end(total: Column) -> Column:
        return F.floor(total * F.lit(TRAIN_SHARE))

    def validation_end(total: Column) -> Column:
        return train_end(total) + F.floor(total * F.lit(VALIDATION_SHARE))

    key = shuffle_key(seed, F.col(row_id))
    cuts = keys_at_ranks(df.select(key), {"train": train_end, "validation": validation_end})
    last = {name: F.coalesce(cuts.select(name).scalar(), F.lit("")) for name in cuts.columns}
    keyed = df.withColumn("shuffle_key", key)
    split = (
        F.when(F.col("shuffle_key") <= last["train"], "train")
        .when(F.col("shuffle_key") <= last["validation"], "validation")
        .otherwise("test")
    )
    return keyed.withColumn("split", split)


def first_per_split(df: DataFrame, order: list[str | Column], n: int = 3, keys: tuple[str, ...] = ("split",)):
    """First n rows of each split with their 1-based ``example_index``."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("example_index", F.row_number().over(window).cast("bigint")).where(
        F.col("example_index") <= n
    )


def split_counts(df: DataFrame, keys: tuple[str, ...] = ("dataset", "split")) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n_examples"))
