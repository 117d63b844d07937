"""Deterministic, partitioning-independent hash predicates and orders (md5 based,
so the same rows come out of Spark and of any SQL engine with md5)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pair_digest(user: Column, item: Column, seed: int | str) -> Column:
    """md5 of '<user>:<item>:<seed>'."""
    return F.md5(F.concat(user.cast("string"), F.lit(":"), item.cast("string"), F.lit(f":{seed}")))


def hash_train_flag(user: Column, item: Column, seed: int = 0, cut: str = "cd") -> Column:
    """True for the train side: the first two hex digits of the digest sort below
    ``cut`` ('cd' = 205/256, about 80%)."""
    return F.substring(pair_digest(user, item, seed), 1, 2) < F.lit(cut)


def seeded_order(seed: str, user: Column, item: Column) -> Column:
    """md5('<seed>:<user>:<item>'): a per-user random order of items."""
    return F.md5(F.concat(F.lit(f"{seed}:"), user.cast("string"), F.lit(":"), item.cast("string")))
