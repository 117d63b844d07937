"""Item statistics (count, sum, mean) and item-centred ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def item_stats(ratings: DataFrame, *, item_col: str = "item_id", rating_col: str = "rating") -> DataFrame:
    """item_id, n, rating_sum, mean_rating over all raters of each item.

    A plain hash aggregate: partial sums on the map side, so a hot item costs one
    row per map task in the shuffle."""
    return (ratings.groupBy(item_col)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(rating_col).alias("rating_sum"))
            .withColumn("mean_rating", F.col("rating_sum") / F.col("n")))


def user_stats(ratings: DataFrame, *, user_col: str = "user_id", rating_col: str = "rating") -> DataFrame:
    """user_id, n, rating_sum, mean_rating."""
    return (ratings.groupBy(user_col)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(rating_col).alias("rating_sum"))
            .withColumn("mean_rating", F.col("rating_sum") / F.col("n")))


def centre_ratings(ratings: DataFrame, stats: DataFrame | None = None, *,
                   item_col: str = "item_id", rating_col: str = "rating") -> DataFrame:
    """Ratings plus mean_rating of their item and norm_rating = rating - mean.

    ``stats`` is one row per item; the planner broadcasts it when its measured size
    is under the broadcast threshold (AQE) and shuffles otherwise."""
    if stats is None:
        stats = item_stats(ratings, item_col=item_col, rating_col=rating_col)
    means = stats.select(item_col, "mean_rating")
    return (ratings.join(means, item_col)
            .withColumn("norm_rating", F.col(rating_col) - F.col("mean_rating")))
