"""Searchable item catalogue: cleaned titles and years, genre dictionary, item
statistics, optional external links, neighbour lists pruned to the catalogue,
search and paging, and seeded starter profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.functions import hashing, numeric, text
from tastegraph.functions.numbering import number_rows


def clean_items(items: DataFrame, *, drop_sentinel: bool = True) -> DataFrame:
    """item_id, raw_title, title, year (null if none), genres array<string>."""
    return items.select(
        "item_id",
        F.col("title").alias("raw_title"),
        text.clean_title(F.col("title")).alias("title"),
        text.title_year(F.col("title")).alias("year"),
        text.genre_array(F.col("genres"), drop_sentinel=drop_sentinel).alias("genres"),
    )


def item_genres(clean: DataFrame) -> DataFrame:
    """item_id, position (0-based, as listed), genre."""
    return clean.select("item_id", F.posexplode("genres").alias("position", "genre"))


def genre_dictionary(clean: DataFrame) -> DataFrame:
    """genre, genre_id: the distinct genre names in name order, numbered from 0
    (distributed sort and numbering; no single-partition window)."""
    names = item_genres(clean).select("genre").distinct()
    return number_rows(names, [F.col("genre").asc()], "genre_id")


def build_catalog(items: DataFrame, stats: DataFrame, links: DataFrame | None = None, *,
                  min_ratings: int = 3) -> DataFrame:
    """Items with at least ``min_ratings`` ratings: item_id, title, year (0 if
    none), genres, n, mean_rating, mean_rating_1dp, tmdb, imdb.

    Items without stats are dropped (inner join); links are optional (left join),
    a zero/blank id becomes null."""
    clean = clean_items(items)
    st = stats.where(F.col("n") >= min_ratings).select("item_id", "n", "mean_rating")
    cat = clean.join(st, "item_id")
    if links is not None:
        lk = links.select("item_id",
                          F.when(F.col("tmdb") != 0, F.col("tmdb")).alias("tmdb"),
                          F.when(F.col("imdb") != "", F.col("imdb")).alias("imdb"))
        cat = cat.join(lk, "item_id", "left")
    else:
        cat = cat.withColumn("tmdb", F.lit(None).cast("long")).withColumn("imdb", F.lit(None).cast("string"))
    return cat.select(
        "item_id", "title", F.coalesce(F.col("year"), F.lit(0)).alias("year"), "genres", "n",
        "mean_rating", numeric.half_even(F.col("mean_rating"), 1).alias("mean_rating_1dp"),
        "tmdb", "imdb")


def catalog_genre_ids(catalog: DataFrame, dictionary: DataFrame) -> DataFrame:
    """item_id, position, genre, genre_id: the catalogue's genre index lists, flat.
    The dictionary is one row per genre name (a vocabulary)."""
    return item_genres(catalog).join(dictionary, "genre")


def with_genre_ids(catalog: DataFrame, dictionary: DataFrame) -> DataFrame:
    """catalog + genre_ids array<int>: the dictionary index of each listed genre,
    in list order (per item, so the array is as long as the item's genre list)."""
    ids = (catalog_genre_ids(catalog, dictionary)
           .groupBy("item_id")
           .agg(F.array_sort(F.collect_list(F.struct("position", F.col("genre_id").cast("int").alias("g"))))
                .alias("l"))
           .select("item_id", F.transform("l", lambda x: x["g"]).alias("genre_ids")))
    return (catalog.join(ids, "item_id", "left")
            .withColumn("genre_ids", F.coalesce(F.col("genre_ids"), F.array().cast("array<int>"))))


def prune_neighbours(nb: DataFrame, catalog: DataFrame) -> DataFrame:
    """Neighbour rows whose item and neighbour are both in the catalogue (two
    semi-joins); items left without neighbours simply have no rows."""
    ids = catalog.select("item_id")
    kept = nb.join(ids, "item_id", "left_semi")
    return kept.join(ids.withColumnRenamed("item_id", "neighbour_id"), "neighbour_id", "left_semi")


def search_catalog(catalog: DataFrame, q: str = "", genre: str | None = None) -> DataFrame:
    """Catalogue rows whose title contains ``q`` (case-insensitive, trimmed; empty
    matches all) and, if given, that list ``genre``."""
    cond = text.contains_ci(F.col("title"), q)
    if genre is not None:
        cond = cond & F.array_contains(F.col("genres"), genre)
    return catalog.where(cond)


def catalog_page(catalog: DataFrame, q: str = "", genre: str | None = None, *,
                 offset: int = 0, size: int = 54) -> DataFrame:
    """One result page in catalogue order (ratings count desc, id asc) with the
    position of each row and the total number of matches (a scalar subquery)."""
    found = search_catalog(catalog, q, genre)
    total = found.select(F.count(F.lit(1))).scalar()
    page = found.orderBy(F.col("n").desc(), F.col("item_id").asc()).offset(offset).limit(size)
    # the window runs over the page only (at most ``size`` rows, after the limit)
    pos = F.row_number().over(Window.orderBy(F.col("n").desc(), F.col("item_id").asc())) - 1 + offset
    return page.select("*", pos.alias("position"), total.alias("total"))


def seed_profiles(catalog: DataFrame, users: DataFrame, *, pool: int = 260, k: int = 4,
                  seed: str = "0") -> DataFrame:
    """user_id, pick, item_id: ``k`` distinct picks per user from the ``pool`` most
    rated catalogue items, ordered by md5(seed:user:item) (a per-user uniform
    sample without replacement, reproducible and independent of partitioning).

    The pool is one array of at most ``pool`` items (a limit), and every user orders all of it in
    its own row: no user's pool is shuffled. A pool of fewer than k items is taken whole."""
    top = catalog.orderBy(F.col("n").desc(), F.col("item_id").asc()).limit(pool)
    items = top.agg(F.collect_list("item_id").alias("items")).scalar()
    name = F.coalesce(F.col("user_id").cast("string"), F.lit(""))  # as the SQL's concat: no user is a user of no name
    ordered = F.sort_array(F.transform("items", lambda i: F.struct(
        hashing.seeded_order(seed, name, i).alias("order"), i.alias("item_id"))))
    first = users.select("user_id").distinct().withColumn("items", items).select(
        "user_id", F.posexplode(F.slice(ordered, 1, k)).alias("place", "p"))
    return first.select("user_id", (F.col("place") + 1).alias("pick"), "p.item_id")
