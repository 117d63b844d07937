"""The precompute run: ratings -> item stats -> gated, shrunk similarity ->
top-k neighbours -> catalogue -> neighbour lists pruned to the catalogue ->
artefact tables. The similarity table, the most expensive result, is written once
(checkpoint) and read by the neighbour cut."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tastegraph.operators import catalog as cat_ops
from tastegraph.operators import similarity as sim_ops
from tastegraph.operators import stats as stat_ops
from tastegraph.session import ensure_checkpoint_dir
from tastegraph.sources import sinks

# Fixed values of the precompute stage.
MIN_RATINGS_CATALOG = 3
MIN_RATINGS_SIM = 8
MIN_COMMON = 8
SHRINK_LAMBDA = 25
MIN_SIM = 0.05
TOP_NEIGHBOURS = 30


def run(ratings: DataFrame, items: DataFrame, links: DataFrame | None = None, *, out: str | None = None,
        k: int = TOP_NEIGHBOURS) -> dict[str, DataFrame]:
    ensure_checkpoint_dir(ratings.sparkSession)
    stats = stat_ops.item_stats(ratings).checkpoint(eager=True)
    sims = sim_ops.pair_similarity(ratings, min_item=MIN_RATINGS_SIM, min_common=MIN_COMMON,
                                   shrink=SHRINK_LAMBDA, clip=True).checkpoint(eager=True)
    nb = sim_ops.neighbours(sims, k=k, min_sim=MIN_SIM)
    catalog = cat_ops.build_catalog(items, stats, links, min_ratings=MIN_RATINGS_CATALOG).checkpoint(eager=True)
    nb_cat = cat_ops.prune_neighbours(nb, catalog).checkpoint(eager=True)
    genres = cat_ops.genre_dictionary(cat_ops.clean_items(items)).checkpoint(eager=True)
    catalog = cat_ops.with_genre_ids(catalog, genres)
    summary = ratings.sparkSession.range(1).select(
        catalog.select(F.count(F.lit(1))).scalar().alias("movies"),
        nb_cat.select(F.count_distinct("item_id")).scalar().alias("with_neighbours"),
        genres.select(F.count(F.lit(1))).scalar().alias("genres"),
        F.lit(MIN_COMMON).cast("long").alias("min_common"))
    if out:
        sinks.write_artefact(catalog, nb_cat, genres, summary, out)
    return {"stats": stats, "sims": sims, "catalog": catalog, "neighbours": nb_cat, "genres": genres,
            "meta": summary}
