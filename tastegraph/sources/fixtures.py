"""Preference relations derived by Spark from the driver's TPC-H-ish tables.

Users are customers. Items are classes of parts, whose number grows with the square
root of the part count (so that the co-raters of a pair stay about as many), and
rare items, one for each line number of every 25th part. Ratings come from line
quantities, item metadata from all parts of a class and feedback events from
``events``. A class with a part of size 1 and rare items of line numbers 6 and 7 have
ratings but no metadata: they are not in the catalogue.
Every relation is a lazy DataFrame over the whole input tables, so its work grows
with them. The same derivations, written in DuckDB SQL, open every oracle query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CLASSES = 9  # times the square root of the number of parts
RARE_EVERY, RARE_REST = 25, 3  # parts whose items are rare: p_partkey % 25 = 3
LISTED_LINES = 5  # line numbers whose rare items have metadata


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def class_count(spark: SparkSession, sf_dir: str) -> Column:
    """The number of part classes, as a scalar subquery."""
    parts = table(spark, sf_dir, "part").agg(F.count(F.lit(1)).alias("n"))
    return parts.select((F.lit(CLASSES) * F.ceil(F.sqrt("n"))).cast("long").alias("classes")).scalar()


def _item_id(part: Column, line: Column, classes: Column) -> Column:
    rare = part % RARE_EVERY == RARE_REST
    return F.when(rare, classes + part * 8 + line).otherwise(part % classes)


def _lines(spark: SparkSession, sf_dir: str, by_part: bool = False) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_shipdate",
        (F.col("l_partkey") if by_part else _item_id(F.col("l_partkey"), F.col("l_linenumber"),
                                                     class_count(spark, sf_dir))).alias("item_id"))


def _with_users(spark: SparkSession, sf_dir: str, line: DataFrame) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("user_id"))
    return line.join(orders, line.l_orderkey == orders.o_orderkey)


def _deciding() -> Column:
    """What decides the newest line, and what its rating is made of."""
    return F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_quantity")


def _half_steps(line: str) -> Column:
    return F.ceil(F.col(f"{line}.l_quantity") / F.lit(5.0)).cast("long")


def ratings_then_and_now(spark: SparkSession, sf_dir: str, day: str) -> DataFrame:
    """user_id, item_id, had, old, rating: each rating with what it was on that day (``had``: whether there was one).
    The rows of ``ratings`` and of ``ratings`` before the day, from one pass over the lines."""
    both = _with_users(spark, sf_dir, _lines(spark, sf_dir)).groupBy("user_id", "item_id").agg(
        F.max(_deciding()).alias("newest"), F.max(F.when(F.col("l_shipdate") < F.lit(day), _deciding())).alias("older"))
    return both.select("user_id", "item_id", F.col("older").isNotNull().alias("had"),
                       (_half_steps("older") / F.lit(2.0)).alias("old"), (_half_steps("newest") / F.lit(2.0)).alias("rating"))


def ratings(spark: SparkSession, sf_dir: str, by_part: bool = False, before: str | None = None) -> DataFrame:
    """One rating per (user, item): the newest line of that customer for that item
    (``by_part``: every part is an item; ``before``: as the ratings stood on that day). ``r2`` = 2 * rating is kept as an exact integer
    (ratings are half-steps).

    The newest line is an arg-max aggregate (partial on the map side), not a window,
    so a hot (user, item) key never lands whole in one task. Only what decides the newest line
    or makes the rating travels."""
    line = _lines(spark, sf_dir, by_part)
    if before is not None:
        line = line.where(F.col("l_shipdate") < F.lit(before))
    out = _with_users(spark, sf_dir, line).groupBy("user_id", "item_id").agg(F.max(_deciding()).alias("newest"))
    r2 = _half_steps("newest")
    return out.select(
        "user_id", "item_id",
        (r2 / F.lit(2.0)).alias("rating"),
        r2.alias("r2"),
        F.col("newest.l_shipdate").alias("ts"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Item metadata (item_id, title, genres). A class takes its attributes from all of
    its parts. Nine titles in ten carry a year, one in three a trailing article, one
    item in 17 has the no-genre sentinel."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", F.col("p_size").cast("long"))
    classes, rare = class_count(spark, sf_dir), F.col("p_partkey") % RARE_EVERY == RARE_REST
    common = (part.where(~rare).withColumn("item_id", F.col("p_partkey") % classes).groupBy("item_id")
              .agg(F.min("p_name").alias("p_name"), F.min("p_size").alias("p_size"), F.min("p_type").alias("p_type"))
              .where(F.col("p_size") > 1))
    line = F.explode(F.sequence(F.lit(1).cast("long"), F.lit(LISTED_LINES).cast("long")))
    single = (part.where(rare).withColumn("line", line)
              .select((classes + F.col("p_partkey") * 8 + F.col("line")).alias("item_id"), "p_name", "p_size", "p_type"))
    k = F.col("item_id")
    word = lambda i: F.split_part(F.col("p_name"), F.lit(" "), F.lit(i))
    base = F.when(k % 3 == 0, F.concat(word(2), F.lit(", The"))).otherwise(F.col("p_name"))
    year = F.when(k % 10 == 9, F.lit("")).otherwise(
        F.concat(F.lit(" ("), (F.lit(1950) + F.col("p_size")).cast("string"), F.lit(")")))
    genres = F.when(k % 17 == 0, F.lit("(no genres listed)")).otherwise(
        F.concat(word(1), F.lit("|"), word(2), F.lit("|"), F.col("p_type")))
    return common.unionByName(single).select(
        k, F.concat(base, year).alias("title"), genres.alias("genres"))


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Optional external ids: imdb '' for one item in 7, tmdb null for one in 5,
    no row at all for one in 11."""
    it = items(spark, sf_dir).select("item_id").where(F.col("item_id") % 11 != 0)
    i = F.col("item_id")
    return it.select(
        i,
        F.when(i % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("tt"), i.cast("string"))).alias("imdb"),
        F.when(i % 5 == 0, F.lit(None).cast("long")).otherwise(i * 10).alias("tmdb"),
    )


def _action(event_type: Column, event_id: Column) -> Column:
    return (F.when(event_type == "click", F.lit("like"))
            .when(event_type == "purchase", F.lit("seed"))
            .when(event_type == "error", F.lit("dislike"))
            .when(event_type == "view", F.lit("remove"))
            .when((event_type == "signup") & (event_id % 20 == 0), F.lit("clear"))
            .when(event_type == "signup", F.lit("like")))


def feedback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Preference events (event_id, user_id, item_id, action, ts) from ``events``."""
    ev = table(spark, sf_dir, "events")
    return feedback_from_events(ev)


# the layout of the events table, and how the stream reads it
EVENT_SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double, props string"


def stream_options() -> dict:
    return {"glob": "events.parquet", "schema": EVENT_SCHEMA, "to_events": feedback_from_events}


def feedback_from_events(ev: DataFrame) -> DataFrame:
    return ev.select(
        F.col("event_id"),
        F.col("user_id"),
        F.get_json_object(F.col("props"), "$.k").cast("long").alias("item_id"),
        _action(F.col("event_type"), F.col("event_id")).alias("action"),
        F.col("ts"),
    )
