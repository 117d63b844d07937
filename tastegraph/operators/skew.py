"""Salted equi-join for keys that may hold a large share of one side.

Keys of ``left`` with more than ``threshold`` rows are split over
``ceil(rows / threshold)`` buckets (``max_salt``: at most so many; no limit by default): each left row takes a
bucket from a hash of its own columns, each matching right row is replicated to
every bucket of its key. Every (left, right) match is produced exactly once, and a
hot key's work is spread over that many tasks instead of one. The heavy-key table
has at most (left rows / threshold) rows, so it stays small next to the inputs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.session import materialized

SALT, BUCKETS = "_salt", "_buckets"
SENT_KEYS = 1 << 20  # heavy keys that are sent to every executor


def heavy_keys(df: DataFrame, on: list[str], *, threshold: int, max_salt: int | None = None) -> DataFrame:
    """on..., _buckets for the keys of ``df`` with more than ``threshold`` rows."""
    n = df.groupBy(*on).agg(F.count(F.lit(1)).alias("_n"))
    buckets = F.ceil(F.col("_n") / F.lit(threshold))
    if max_salt is not None:
        buckets = F.least(buckets, F.lit(max_salt))
    return n.where(F.col("_n") > threshold).select(*on, buckets.cast("int").alias(BUCKETS))


def sent_keys(heavy: DataFrame) -> DataFrame | None:
    """The heavy keys, written once and, while they are at most SENT_KEYS, broadcast; None if there are none. Their number
    is known only when they are counted: planned from the size of their input, a join with them shuffles the other side."""
    heavy = materialized(heavy, "heavy-keys")
    n = heavy.count()
    return None if not n else F.broadcast(heavy) if n <= SENT_KEYS else heavy


def with_buckets(df: DataFrame, heavy: DataFrame | None, on: list[str]) -> DataFrame:
    """df with the buckets of its key (1 for keys that are not heavy)."""
    if heavy is None:
        return df.withColumn(BUCKETS, F.lit(1))
    return df.join(heavy, on, "left").withColumn(BUCKETS, F.coalesce(F.col(BUCKETS), F.lit(1)))


def salted_join(left: DataFrame, right: DataFrame, on: list[str], *, salt_cols: list[str],
                threshold: int = 100_000, max_salt: int | None = None, how: str = "inner",
                partitions: int | None = None, merge: bool = False, sent: bool = False) -> DataFrame:
    """``left.join(right, on, how)`` (inner or left) with hot keys of ``left`` salted.

    ``partitions``: partition both sides explicitly by (key, salt) into that many
    partitions. Use it when the join's output per key is much larger than its
    input (a per-key product): AQE coalesces partitions by input bytes and would
    otherwise merge the salt buckets of a hot key back into one task.
    ``merge``: a sort-merge join, whose rows come out in the order of the key.
    ``sent``: the heavy keys are counted first (``sent_keys``), so no side is shuffled for them."""
    heavy = heavy_keys(left, on, threshold=threshold, max_salt=max_salt)
    heavy = sent_keys(heavy) if sent else heavy
    lb = with_buckets(left, heavy, on)
    lb = lb.withColumn(SALT, F.pmod(F.xxhash64(*[F.col(c) for c in salt_cols]), F.col(BUCKETS)).cast("int"))
    rb = with_buckets(right, heavy, on)
    rb = rb.withColumn(SALT, F.explode(F.sequence(F.lit(0), F.col(BUCKETS) - 1))).drop(BUCKETS)
    if partitions:
        lb = lb.repartition(partitions, *on, SALT)
        rb = rb.repartition(partitions, *on, SALT)
    return lb.join(rb.hint("merge") if merge else rb, on + [SALT], how).drop(SALT, BUCKETS)
