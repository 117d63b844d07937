"""Dense 0-based numbering of a DataFrame in a total order, JVM-side and without
moving the rows into one partition.

The sorted rows are checkpointed (so partition boundaries cannot change between
passes), each row gets (partition id, position in partition) from
``monotonically_increasing_id``, one small aggregate counts the rows per
partition, and a running sum over that table (one row per partition, a proven
bound) gives each partition's offset, which is broadcast back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.session import ensure_checkpoint_dir


def number_rows(df: DataFrame, order: list[Column] | None, name: str) -> DataFrame:
    """df plus ``name`` (long): the row's position in ``order`` (a total order
    gives a deterministic numbering; ``None`` numbers in the current order)."""
    ensure_checkpoint_dir(df.sparkSession)
    ordered = (df.orderBy(*order) if order else df).checkpoint(eager=True)
    tagged = ordered.select("*", F.spark_partition_id().alias("_pid"),
                            F.monotonically_increasing_id().alias("_mid"))
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_pid", (F.sum("_n").over(
        Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_off"))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return (tagged.join(F.broadcast(offsets), "_pid")
            .withColumn(name, F.col("_off") + local)
            .drop("_pid", "_mid", "_off"))
