"""Train/test splits of a ratings table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.functions import hashing


def hash_split(ratings: DataFrame, *, seed: int = 0, cut: str = "cd") -> DataFrame:
    """Adds ``split`` = 'train' | 'test' from md5(user:item:seed): about 80% train
    for cut 'cd'. Depends only on the row, never on partitioning, so every run and
    every engine puts each rating on the same side."""
    flag = hashing.hash_train_flag(F.col("user_id"), F.col("item_id"), seed, cut)
    return ratings.withColumn("split", F.when(flag, F.lit("train")).otherwise(F.lit("test")))


def train_test(ratings: DataFrame, *, seed: int = 0, cut: str = "cd") -> tuple[DataFrame, DataFrame]:
    s = hash_split(ratings, seed=seed, cut=cut)
    return (s.where(F.col("split") == "train").drop("split"),
            s.where(F.col("split") == "test").drop("split"))


def with_fold(ratings: DataFrame, folds: int = 3, *, seed: int | str = "fold") -> DataFrame:
    """Adds ``fold`` (int, 0 to folds - 1) by the hash of the (user, item) pair: the folds of a
    cross-validation are the same in every run, however the ratings are partitioned."""
    digest = hashing.pair_digest(F.col("user_id"), F.col("item_id"), seed)
    return ratings.withColumn("fold", (F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % folds).cast("int"))


def random_split(ratings: DataFrame, *, weights=(0.8, 0.2), seed: int = 0) -> list[DataFrame]:
    """MLlib-style random split (rows on each side depend on the partitioning of
    the input; sort or hash-split for reproducible sides)."""
    return ratings.randomSplit(list(weights), seed=seed)
