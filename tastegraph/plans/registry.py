"""Named queries: each takes (spark, sf_dir) and returns a lazy DataFrame over the
whole fixture relations. Doubles are rounded once to 6 decimals at the output and
every column is aliased, so results compare one-to-one with the oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph.operators import blend as blend_ops
from tastegraph.operators import catalog as cat_ops
from tastegraph.operators import content as content_ops
from tastegraph.operators import evaluate as eval_ops
from tastegraph.operators import factors as factor_ops
from tastegraph.operators import feedback as fb_ops
from tastegraph.operators import predict as pred_ops
from tastegraph.operators import profiles as prof_ops
from tastegraph.operators import similarity as sim_ops
from tastegraph.operators import split as split_ops
from tastegraph.operators import stats as stat_ops
from tastegraph.plans import batch as batch_plan
# support gates, shrinkage and cut: the fixed values of the artefact stage
from tastegraph.plans.artefact import (MIN_COMMON, MIN_RATINGS_CATALOG, MIN_RATINGS_SIM, MIN_SIM,
                                       SHRINK_LAMBDA, TOP_NEIGHBOURS)
from tastegraph.session import bucketed, materialized, scratch_path
from tastegraph.sources import files, sinks
from tastegraph.sources import fixtures as fx
from tastegraph.streaming import feedback_stream as stream_ops
from tastegraph.streaming import rescore as rescore_ops

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}



def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


def r6(c):
    return F.round(c, 6)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the session's checkpoint folder and read it back: a
    reused intermediate is computed once, its lineage is cut, a lost executor
    cannot force a recompute of everything before it, and later scans are pruned."""
    return materialized(df, "query")


UPDATE_DAY = "2000-07-01"  # about four lines in five are older


# ---- shared sub-plans -------------------------------------------------------

def raw_similarity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sim_ops.pair_similarity(fx.ratings(spark, sf_dir))


def shrunk_similarity(spark: SparkSession, sf_dir: str, ratings: DataFrame | None = None) -> DataFrame:
    r = ratings if ratings is not None else fx.ratings(spark, sf_dir)
    return sim_ops.pair_similarity(r, min_item=MIN_RATINGS_SIM, min_common=MIN_COMMON,
                                   shrink=SHRINK_LAMBDA, clip=True)


def item_neighbours(spark: SparkSession, sf_dir: str, ratings: DataFrame | None = None,
                    k: int = TOP_NEIGHBOURS) -> DataFrame:
    return sim_ops.neighbours(shrunk_similarity(spark, sf_dir, ratings), k=k, min_sim=MIN_SIM)


# ---- J1, J2 -------------------------------------------------------------------

@query("item_stats")
def q_item_stats(spark, sf_dir):
    s = stat_ops.item_stats(fx.ratings(spark, sf_dir))
    return s.select("item_id", "n", "rating_sum", r6(F.col("mean_rating")).alias("mean_rating"))


@query("centred_ratings")
def q_centred_ratings(spark, sf_dir):
    c = stat_ops.centre_ratings(fx.ratings(spark, sf_dir))
    return c.select("user_id", "item_id", "rating", r6(F.col("mean_rating")).alias("mean_rating"),
                    r6(F.col("norm_rating")).alias("norm_rating"))


# ---- J3, J4, J5 ---------------------------------------------------------------

@query("pair_similarity_raw")
def q_pair_similarity_raw(spark, sf_dir):
    s = raw_similarity(spark, sf_dir)
    return s.select("item_i", "item_j", "n_common", r6(F.col("sim")).alias("sim"))


@query("pair_similarity_shrunk")
def q_pair_similarity_shrunk(spark, sf_dir):
    s = shrunk_similarity(spark, sf_dir)
    return s.select("item_i", "item_j", "n_common", r6(F.col("sim")).alias("sim"))


@query("item_neighbours_topk")
def q_item_neighbours_topk(spark, sf_dir):
    return item_neighbours(spark, sf_dir).select(
        "item_id", F.col("rank").cast("long").alias("rank"), "neighbour_id", "sim")


@query("similar_items_topk")
def q_similar_items_topk(spark, sf_dir):
    return sim_ops.similar_items(raw_similarity(spark, sf_dir), k=5).select(
        "item_id", F.col("rank").cast("long").alias("rank"), "neighbour_id", "sim")


@query("pair_similarity_updated")
def q_pair_similarity_updated(spark, sf_dir):
    """The pair table of the ratings as they stood on a day, written, then brought up to date by the ratings
    added and changed since; the rows of pair_similarity_shrunk."""
    # in buckets of (user, item): the two states are compared without an exchange
    both = bucketed(fx.ratings_then_and_now(spark, sf_dir, UPDATE_DAY), "rating-states", ["user_id", "item_id"])
    old = both.where("had").select("user_id", "item_id", F.col("old").alias("rating"))
    new = both.select("user_id", "item_id", "rating")
    sums, stats = (materialize(t) for t in sim_ops.pair_table(old))
    sums, stats = sim_ops.updated_pair_table(sums, stats, old, materialize(sim_ops.rating_changes(old, new)))
    s = sim_ops.similarity_of(sums, stats, min_item=MIN_RATINGS_SIM, min_common=MIN_COMMON, shrink=SHRINK_LAMBDA, clip=True)
    return s.select("item_i", "item_j", "n_common", r6(F.col("sim")).alias("sim"))


@query("pair_similarity_parts")
def q_pair_similarity_parts(spark, sf_dir):
    """Similarity with every part an item: sparse co-ratings, pairs of three or more co-raters."""
    s = sim_ops.pair_similarity(fx.ratings(spark, sf_dir, by_part=True), min_common=3, shrink=SHRINK_LAMBDA, clip=True)
    return s.select("item_i", "item_j", "n_common", r6(F.col("sim")).alias("sim"))


# ---- A1-A3, A5, A6: the fixture through files and back -----------------------------------------

def _csv_path(spark: SparkSession, df: DataFrame, name: str) -> str:
    path = scratch_path(spark, name)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


@query("ratings_csv")
def q_ratings_csv(spark, sf_dir):
    """The ratings, written in the published CSV layout and scanned again."""
    out = fx.ratings(spark, sf_dir).select(
        F.col("user_id").alias("userId"), F.col("item_id").alias("movieId"), "rating",
        F.unix_timestamp(F.col("ts").cast("timestamp")).alias("timestamp"))
    return files.read_ratings(spark, _csv_path(spark, out, "ratings-csv")).select("user_id", "item_id", "rating")


@query("items_csv")
def q_items_csv(spark, sf_dir):
    out = fx.items(spark, sf_dir).select(F.col("item_id").alias("movieId"), "title", "genres")
    return files.read_items(spark, _csv_path(spark, out, "items-csv")).select("item_id", "title", "genres")


@query("links_csv")
def q_links_csv(spark, sf_dir):
    out = fx.links(spark, sf_dir).select(F.col("item_id").alias("movieId"), F.col("imdb").alias("imdbId"),
                                         F.col("tmdb").alias("tmdbId"))
    return files.read_links(spark, _csv_path(spark, out, "links-csv")).select("item_id", "imdb", "tmdb")


@query("ratings_csv_checked")
def q_ratings_csv_checked(spark, sf_dir):
    """A ratings file in which some rows are damaged, by the rating's own values: how many rows are
    accepted, and rejected for which reason."""
    user, item = F.col("user_id").cast("string"), F.col("item_id").cast("string")
    line = (F.when(F.col("rating") == 0.5, F.concat_ws(",", user, item, F.lit("half a star"), F.lit("1")))
            .when(F.col("rating") == 1.0, F.concat_ws(",", user, item))
            .when(F.col("rating") == 1.5, F.concat_ws(",", F.lit(""), item, F.lit("1.5"), F.lit("1")))
            .when(F.col("rating") == 2.0, F.concat_ws(",", user, item, F.lit("2.0"), F.lit("1"), F.lit("more")))
            .otherwise(F.concat_ws(",", user, item, F.col("rating").cast("string"), F.lit("1"))))
    path = scratch_path(spark, "ratings-damaged")
    fx.ratings(spark, sf_dir).select(line.alias("value")).write.text(path)
    accepted, rejected = files.checked_ratings(spark, path, header=False)
    return (accepted.groupBy(F.lit("accepted").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
            .unionByName(rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))))


@query("metrics_csv")
def q_metrics_csv(spark, sf_dir):
    """The metrics of item-CF through the CSV sink and back."""
    path = scratch_path(spark, "metrics-csv")
    sinks.write_metrics_csv(q_rating_metrics(spark, sf_dir), path)
    return spark.read.schema("metric string, value double, detail string").option("header", True).csv(path)


@query("artefact_neighbours")
def q_artefact_neighbours(spark, sf_dir):
    """The neighbour lists of the written artefact (JSON lines), flat again."""
    from tastegraph.plans import artefact
    path = scratch_path(spark, "artefact")
    artefact.run(fx.ratings(spark, sf_dir), fx.items(spark, sf_dir), fx.links(spark, sf_dir), out=path)
    lists = spark.read.schema("item_id long, neighbours array<struct<neighbour_id: long, sim: double>>") \
        .json(f"{path}/neighbours_json")
    return lists.select("item_id", F.posexplode("neighbours").alias("place", "n")).select(
        "item_id", (F.col("place") + 1).cast("long").alias("place"), "n.neighbour_id", "n.sim")


# ---- J8, C14, J13, J17 ---------------------------------------------------------

SEARCH_QUERY = "bolt"
SEARCH_GENRE = "SMALL"
PAGE_OFFSET = 54
PAGE_SIZE = 54


def catalog_of(spark: SparkSession, sf_dir: str, ratings: DataFrame | None = None) -> DataFrame:
    r = ratings if ratings is not None else fx.ratings(spark, sf_dir)
    return cat_ops.build_catalog(fx.items(spark, sf_dir), stat_ops.item_stats(r),
                                 fx.links(spark, sf_dir), min_ratings=MIN_RATINGS_CATALOG)


def catalog_neighbours(spark: SparkSession, sf_dir: str, ratings: DataFrame | None = None,
                       k: int = TOP_NEIGHBOURS) -> tuple[DataFrame, DataFrame]:
    """(catalogue, neighbour lists pruned to it): the precompute artefact."""
    r = ratings if ratings is not None else fx.ratings(spark, sf_dir)
    cat = catalog_of(spark, sf_dir, r)
    return cat, cat_ops.prune_neighbours(item_neighbours(spark, sf_dir, r, k=k), cat)


@query("catalog")
def q_catalog(spark, sf_dir):
    c = catalog_of(spark, sf_dir)
    return c.select("item_id", "title", F.col("year").cast("long").alias("year"), "n",
                    r6(F.col("mean_rating")).alias("mean_rating"), "mean_rating_1dp", "tmdb", "imdb",
                    F.concat_ws("|", "genres").alias("genre_list"))


@query("catalog_titles")
def q_catalog_titles(spark, sf_dir):
    c = cat_ops.clean_items(fx.items(spark, sf_dir))
    return c.select("item_id", "raw_title", "title", F.col("year").cast("long").alias("year"))


@query("genre_dictionary")
def q_genre_dictionary(spark, sf_dir):
    d = cat_ops.genre_dictionary(cat_ops.clean_items(fx.items(spark, sf_dir)))
    return d.select("genre", F.col("genre_id").cast("long").alias("genre_id"))


@query("catalog_genre_ids")
def q_catalog_genre_ids(spark, sf_dir):
    cat = catalog_of(spark, sf_dir)
    d = cat_ops.genre_dictionary(cat_ops.clean_items(fx.items(spark, sf_dir)))
    g = cat_ops.catalog_genre_ids(cat, d)
    return g.select("item_id", F.col("position").cast("long").alias("position"), "genre",
                    F.col("genre_id").cast("long").alias("genre_id"))


@query("catalog_summary")
def q_catalog_summary(spark, sf_dir):
    r = fx.ratings(spark, sf_dir)
    cat, nb = catalog_neighbours(spark, sf_dir, r)
    d = cat_ops.genre_dictionary(cat_ops.clean_items(fx.items(spark, sf_dir)))
    one = spark.range(1)
    return one.select(
        cat.select(F.count(F.lit(1))).scalar().alias("movies"),
        nb.select(F.count_distinct("item_id")).scalar().alias("with_neighbours"),
        d.select(F.count(F.lit(1))).scalar().alias("genres"),
        F.lit(MIN_COMMON).cast("long").alias("min_common"),
        r.select(F.count(F.lit(1))).scalar().alias("ratings"),
    )


@query("neighbours_in_catalog")
def q_neighbours_in_catalog(spark, sf_dir):
    _, nb = catalog_neighbours(spark, sf_dir)
    return nb.select("item_id", F.col("rank").cast("long").alias("rank"), "neighbour_id", "sim")


@query("catalog_search")
def q_catalog_search(spark, sf_dir):
    found = cat_ops.search_catalog(catalog_of(spark, sf_dir), SEARCH_QUERY, SEARCH_GENRE)
    return found.select("item_id", "title", "n")


@query("catalog_page")
def q_catalog_page(spark, sf_dir):
    page = cat_ops.catalog_page(catalog_of(spark, sf_dir), offset=PAGE_OFFSET, size=PAGE_SIZE)
    return page.select("item_id", "title", "n", F.col("position").cast("long").alias("position"),
                       F.col("total").cast("long").alias("total"))


@query("seed_profiles")
def q_seed_profiles(spark, sf_dir):
    users = fx.feedback(spark, sf_dir).select("user_id")
    s = cat_ops.seed_profiles(catalog_of(spark, sf_dir), users)
    return s.select("user_id", F.col("pick").cast("long").alias("pick"), "item_id")


# ---- K1, D12, E9, B12 ------------------------------------------------------------

def prefs_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fb_ops.fold_feedback(fx.feedback(spark, sf_dir))


@query("feedback_state")
def q_feedback_state(spark, sf_dir):
    return prefs_of(spark, sf_dir).select("user_id", "item_id", "state", "since_event")


@query("feedback_counts")
def q_feedback_counts(spark, sf_dir):
    return fb_ops.preference_counts(prefs_of(spark, sf_dir))


@query("picks_newest_first")
def q_picks_newest_first(spark, sf_dir):
    p = fb_ops.picks_newest_first(prefs_of(spark, sf_dir))
    return p.select("user_id", F.col("position").cast("long").alias("position"), "item_id", "since_event")


@query("valid_prefs")
def q_valid_prefs(spark, sf_dir):
    v = fb_ops.valid_prefs(prefs_of(spark, sf_dir), catalog_of(spark, sf_dir))
    return v.select("user_id", "item_id", "state")


# ---- J9 - J12 ------------------------------------------------------------------

def profile_inputs(spark: SparkSession, sf_dir: str, k: int = TOP_NEIGHBOURS):
    """(valid preferences, neighbour lists in the catalogue, catalogue), each cut
    from its lineage once (they are read several times by the scorer)."""
    r = materialize(fx.ratings(spark, sf_dir))
    cat = materialize(catalog_of(spark, sf_dir, r))
    nb = materialize(cat_ops.prune_neighbours(item_neighbours(spark, sf_dir, r, k=k), cat))
    prefs = materialize(fb_ops.valid_prefs(prefs_of(spark, sf_dir), cat))
    return prefs, nb, cat


def profile_catalog(spark: SparkSession, sf_dir: str):
    """(valid preferences, catalogue): what needs no neighbour list."""
    cat = materialize(catalog_of(spark, sf_dir))
    return materialize(fb_ops.valid_prefs(prefs_of(spark, sf_dir), cat)), cat


def _recs_out(recs: DataFrame) -> DataFrame:
    return recs.select("user_id", F.col("rank").cast("long").alias("rank"), "item_id", "cf",
                       "genre_score", "pop", "final", "pct",
                       F.col("genre_only").cast("long").alias("genre_only"))


@query("candidate_scores")
def q_candidate_scores(spark, sf_dir):
    prefs, nb, _ = profile_inputs(spark, sf_dir)
    s = prof_ops.candidate_scores(prefs, nb)
    return s.select("user_id", "item_id", (F.col("cf_u").cast("double") / prof_ops.UNIT).alias("cf"),
                    F.col("n_liked").cast("long").alias("n_liked"),
                    F.col("n_disliked").cast("long").alias("n_disliked"))


@query("genre_affinity")
def q_genre_affinity(spark, sf_dir):
    prefs, cat = profile_catalog(spark, sf_dir)
    a = prof_ops.genre_affinity(prefs, cat)
    return a.select("user_id", "genre", "cnt", r6(F.col("aff")).alias("aff"))


@query("taste_top3")
def q_taste_top3(spark, sf_dir):
    prefs, cat = profile_catalog(spark, sf_dir)
    d = cat_ops.genre_dictionary(cat_ops.clean_items(fx.items(spark, sf_dir)))
    t = prof_ops.taste_top(prefs, cat, d, k=3)
    return t.select("user_id", F.col("rank").cast("long").alias("rank"), "genre", "cnt")


@query("recommendations")
def q_recommendations(spark, sf_dir):
    prefs, nb, cat = profile_inputs(spark, sf_dir)
    return _recs_out(prof_ops.recommend(prefs, nb, cat))


BACKFILL_K = 5


@query("recommendations_backfill")
def q_recommendations_backfill(spark, sf_dir):
    """The same scorer over five-neighbour lists: short candidate lists, so the
    genre backfill fills many users."""
    prefs, nb, cat = profile_inputs(spark, sf_dir, k=BACKFILL_K)
    return _recs_out(prof_ops.recommend(prefs, nb, cat))


@query("recommendation_reasons")
def q_recommendation_reasons(spark, sf_dir):
    prefs, nb, cat = profile_inputs(spark, sf_dir)
    recs = materialize(prof_ops.recommend(prefs, nb, cat))  # read three times by reasons
    return prof_ops.reasons(recs, prefs, nb, cat)


# ---- I1, J6, J7, J14 ----------------------------------------------------------

BLEND_GRID = [("0.2", "0.3", "0.5"), ("0.3", "0.3", "0.4"), ("0.4", "0.3", "0.3")]


def split_and_all(spark: SparkSession, sf_dir: str):
    """(train, test, all ratings) by the md5 hash split, cut from the lineage once."""
    s = materialize(split_ops.hash_split(fx.ratings(spark, sf_dir)))
    return (s.where(F.col("split") == "train").drop("split"),
            s.where(F.col("split") == "test").drop("split"), s.drop("split"))


def split_of(spark: SparkSession, sf_dir: str):
    """(train, test) by the md5 hash split."""
    return split_and_all(spark, sf_dir)[:2]


def cf_predictions(train: DataFrame, test: DataFrame) -> DataFrame:
    sims = sim_ops.pair_similarity(train)
    return pred_ops.predict_item_cf(test, sims, train, n=10)


@query("hash_split")
def q_hash_split(spark, sf_dir):
    return split_ops.hash_split(fx.ratings(spark, sf_dir)).select("user_id", "item_id", "rating", "split")


@query("candidate_pairs")
def q_candidate_pairs(spark, sf_dir):
    """The pairs item-CF predicts: the distinct held-out (user, item) pairs. This
    replaces the users x items cross join that was later cut down to them."""
    _, test = split_of(spark, sf_dir)
    return test.select("user_id", "item_id").distinct()


@query("item_cf_predictions")
def q_item_cf_predictions(spark, sf_dir):
    train, test = split_of(spark, sf_dir)
    p = cf_predictions(train, test)
    return p.select("user_id", "item_id", r6(F.col("prediction")).alias("prediction"), "n_neighbours")


@query("item_cf_predictions_as_written")
def q_item_cf_predictions_as_written(spark, sf_dir):
    """One-sided pair table built from all ratings (held-out ones included), rank
    ties, signed denominator: the first written form, kept as an option."""
    train, test, r = split_and_all(spark, sf_dir)
    sims = sim_ops.pair_similarity(r)
    p = pred_ops.predict_item_cf(test, sims, train, n=10, direction="upper", ties="rank",
                                 denominator="signed")
    return p.select("user_id", "item_id", r6(F.col("prediction")).alias("prediction"), "n_neighbours")


def baseline_components(spark, sf_dir):
    """(train, test, component predictions), the last two in buckets of (user, item): their joins need no
    exchange."""
    train, test = split_of(spark, sf_dir)
    key = ["user_id", "item_id"]
    comps = {"item_mean": pred_ops.predict_item_mean(test, train), "cf": cf_predictions(train, test),
             "user_mean": pred_ops.predict_user_mean(test, train)}
    return train, bucketed(test, "blend-test", key), {n: bucketed(c, f"blend-{n}", key) for n, c in comps.items()}


@query("blend_equal")
def q_blend_equal(spark, sf_dir):
    _, test, comps = baseline_components(spark, sf_dir)
    b = blend_ops.blend({"item_mean": comps["item_mean"], "cf": comps["cf"]}, {"item_mean": "0.5", "cf": "0.5"})
    b = b.join(test.select("user_id", "item_id", F.col("rating").alias("actual_rating")), ["user_id", "item_id"])
    return b.select("user_id", "item_id",
                    F.col("item_mean_prediction").cast("double").alias("item_mean_prediction"),
                    F.col("cf_prediction").cast("double").alias("cf_prediction"),
                    F.col("hybrid_prediction").cast("double").alias("hybrid_prediction"), "actual_rating")


@query("blend_weight_search")
def q_blend_weight_search(spark, sf_dir):
    _, test, comps = baseline_components(spark, sf_dir)
    s = blend_ops.search_weights(comps, test, BLEND_GRID)
    return s.select(F.col("weight_id").cast("long").alias("weight_id"), "w_item_mean", "w_cf", "w_user_mean",
                    r6(F.col("rmse")).alias("rmse"), F.col("n").cast("long").alias("n"),
                    F.col("best").cast("long").alias("best"))


@query("rating_metrics")
def q_rating_metrics(spark, sf_dir):
    train, test = split_of(spark, sf_dir)
    cf = materialize(cf_predictions(train, test))
    m = eval_ops.rating_metrics(cf, test, name="item_cf").unionByName(
        eval_ops.rating_metrics(cf, test, name="item_cf", clamp=(1.0, 5.0)))
    return m.select("metric", r6(F.col("value")).alias("value"), "detail")


@query("ranking_map")
def q_ranking_map(spark, sf_dir):
    train, test = split_of(spark, sf_dir)
    nb = sim_ops.neighbours(
        sim_ops.pair_similarity(train, min_item=MIN_RATINGS_SIM, min_common=MIN_COMMON,
                                shrink=SHRINK_LAMBDA, clip=True), k=TOP_NEIGHBOURS, min_sim=MIN_SIM)
    top = pred_ops.recommend_from_ratings(train, materialize(nb), k=10)
    m = eval_ops.mean_average_precision(top, test)
    return m.select(r6(F.col("map")).alias("map"), F.col("users").cast("long").alias("users"))


# ---- I2 - I14, J15, J16, J18 (MLlib) ---------------------------------------------------------

ALS_FIXED = dict(rank=10, max_iter=10, reg_param=0.17)


@query("genre_index")
def q_genre_index(spark, sf_dir):
    gi = content_ops.genre_index(content_ops.item_genre_rows(fx.items(spark, sf_dir)))
    return gi.select("genre", F.col("genre_index").cast("long").alias("genre_index"), "cnt")


@query("item_multihot")
def q_item_multihot(spark, sf_dir):
    rows = content_ops.item_genre_rows(fx.items(spark, sf_dir))
    m = content_ops.item_multihot(rows, content_ops.genre_index(rows))
    return m.select("item_id", F.col("genre_index").cast("long").alias("genre_index"), "value")


@query("genre_encoder_vectors")
def q_genre_encoder_vectors(spark, sf_dir):
    """The encoder pipeline, fitted, stored and loaded again: its items' vectors in coordinate form."""
    items = fx.items(spark, sf_dir)
    encoder = content_ops.genre_encoder(content_ops.item_genre_rows(items))
    loaded = content_ops.stored(encoder, scratch_path(spark, "genre-encoder"))
    return content_ops.vector_places(content_ops.item_vectors(loaded, items))


@query("als_predictions")
def q_als_predictions(spark, sf_dir):
    train, test = split_of(spark, sf_dir)
    model = factor_ops.fit_factors(train, **ALS_FIXED)
    return factor_ops.score_pairs(model, test)


@query("als_topk")
def q_als_topk(spark, sf_dir):
    train, _ = split_of(spark, sf_dir)
    model = factor_ops.fit_factors(train, **ALS_FIXED)
    return factor_ops.recommend_from_factors(model, 10).select(
        "user_id", F.col("rank").cast("long").alias("rank"), "item_id", "score")


@query("als_folds")
def q_als_folds(spark, sf_dir):
    """The cross-validation fold of each train rating."""
    train, _ = split_of(spark, sf_dir)
    return split_ops.with_fold(train).select("user_id", "item_id", F.col("fold").cast("long").alias("fold"))


@query("als_grid")
def q_als_grid(spark, sf_dir):
    train, _ = split_of(spark, sf_dir)
    _, grid = factor_ops.tune_factors(train)
    return grid


@query("forest_predictions")
def q_forest_predictions(spark, sf_dir):
    train, test = split_of(spark, sf_dir)
    model, feats = content_ops.content_model(train, fx.items(spark, sf_dir))
    return content_ops.score_content(model, feats, test)


@query("forest_reloaded")
def q_forest_reloaded(spark, sf_dir):
    """Each held-out pair that the forest pipeline scores, and whether the stored pipeline, loaded again,
    gives the same prediction."""
    train, test = split_of(spark, sf_dir)
    model, feats = content_ops.content_model(train, fx.items(spark, sf_dir))
    loaded = content_ops.stored(model, scratch_path(spark, "forest-pipeline"))
    again = content_ops.score_content(loaded, feats, test).withColumnRenamed("prediction", "again")
    return (content_ops.score_content(model, feats, test).join(again, ["user_id", "item_id"])
            .select("user_id", "item_id", (F.col("prediction") == F.col("again")).alias("same")))


@query("forest_stump")
def q_forest_stump(spark, sf_dir):
    """The forest as one tree of depth 1 on all features: its best genre and both means have a closed form.
    (Bins enough that MLlib looks for its splits in up to a million ratings, not in a sample of 10,000.)"""
    train, test = split_of(spark, sf_dir)
    model, feats = content_ops.content_model(train, fx.items(spark, sf_dir), num_trees=1, max_depth=1, bootstrap=False,
                                             subsamplingRate=1.0, featureSubsetStrategy="all", maxBins=1000)
    p = content_ops.score_content(model, feats, test)
    return p.select("user_id", "item_id", r6(F.col("prediction")).alias("prediction"))


# ---- facts about the models' outputs that SQL can state ---------------------------------------

@query("als_prediction_pairs")
def q_als_prediction_pairs(spark, sf_dir):
    """The held-out pairs the model scores (user and item both in train), each not negative."""
    p = q_als_predictions(spark, sf_dir)
    return p.select("user_id", "item_id", (F.col("prediction") >= 0).alias("not_negative"))


@query("als_topk_lists")
def q_als_topk_lists(spark, sf_dir):
    """Per user: the length of the list without the user's training items, whether its ranks are
    1..n, its scores fall and no training item is in it."""
    train, _ = split_of(spark, sf_dir)
    model = factor_ops.fit_factors(train, **ALS_FIXED)
    top = materialize(factor_ops.recommend_from_factors(model, 10, seen=train))
    seen = top.join(train.select("user_id", "item_id"), ["user_id", "item_id"], "left_semi")
    bad = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("seen"))
    rows = F.array_sort(F.collect_list(F.struct("rank", "score")))  # ten rows
    return (top.groupBy("user_id").agg(rows.alias("l"), F.count_distinct("item_id").alias("n"))
            .join(bad, "user_id", "left")
            .select("user_id", F.col("n").cast("long").alias("n"),
                    (F.transform("l", lambda x: x["rank"]) == F.sequence(F.lit(1), F.size("l"))).alias("ranked"),
                    F.forall(F.sequence(F.lit(2), F.greatest(F.size("l"), F.lit(2))),
                             lambda i: F.coalesce(F.get("l", i - 1)["score"] <= F.get("l", i - 2)["score"], F.lit(True)))
                    .alias("falling"), F.coalesce("seen", F.lit(0)).cast("long").alias("seen")))


@query("als_topk_by_bounds")
def q_als_topk_by_bounds(spark, sf_dir):
    """Per user: the length of the list found by norm bounds, and whether its scores are those of MLlib's own
    list, which scores all pairs (single-precision products, so to six digits)."""
    train, _ = split_of(spark, sf_dir)
    model = factor_ops.fit_factors(train, **ALS_FIXED)
    ours = factor_ops.recommend_from_factors(model, 10).select("user_id", "rank", "score")
    theirs = factor_ops.mllib_lists(model, 10).select(F.col("uid").cast("long").alias("user_id"), "rank",
                                                      F.col("score").alias("other"))
    near = F.abs(F.col("score") - F.col("other")) <= 1e-6 * F.greatest(F.lit(1.0), F.abs("other"))
    return (ours.join(theirs, ["user_id", "rank"], "full").groupBy("user_id")
            .agg(F.count("score").alias("n"), F.min(F.coalesce(near, F.lit(False))).alias("same")))


@query("als_grid_points")
def q_als_grid_points(spark, sf_dir):
    g = materialize(q_als_grid(spark, sf_dir))
    least = g.agg(F.min("avg_rmse")).scalar()
    return g.select(F.col("rank").cast("long").alias("rank"), F.col("max_iter").cast("long").alias("max_iter"),
                    "reg_param", (F.col("avg_rmse") > 0).alias("positive"),
                    ((F.col("best") == 1) == (F.col("avg_rmse") == least)).alias("best_is_least"),
                    g.agg(F.sum("best")).scalar().cast("long").alias("n_best"))


@query("forest_prediction_pairs")
def q_forest_prediction_pairs(spark, sf_dir):
    """The held-out pairs whose item has metadata, each within the range of the ratings."""
    p = q_forest_predictions(spark, sf_dir)
    return p.select("user_id", "item_id", F.col("prediction").between(0.5, 5.0).alias("in_range"))


@query("metrics_report_counts")
def q_metrics_report_counts(spark, sf_dir):
    """The report's metrics, whether each has a value, and the row count that it names."""
    m = q_metrics_report(spark, sf_dir)
    return m.select("metric", F.col("value").isNotNull().alias("has_value"),
                    F.regexp_extract("detail", r"n=(\d+)", 1).alias("n"))


@query("metrics_report")
def q_metrics_report(spark, sf_dir):
    res = batch_plan.run(fx.ratings(spark, sf_dir), fx.items(spark, sf_dir))
    return res.metrics


# ---- K2, K3 (Structured Streaming) ----------------------------------------------


@query("feedback_stream")
def q_feedback_stream(spark, sf_dir):
    """The fold as a stream (Trigger.AvailableNow over the events file); the same
    rows as feedback_state."""
    cur = stream_ops.run_feedback_stream(spark, sf_dir, **fx.stream_options())
    return cur.select("user_id", "item_id", "state", "since_event")


@query("feedback_stream_recommendations")
def q_feedback_stream_recommendations(spark, sf_dir):
    """Recommendations kept current by re-scoring each micro-batch's touched users;
    after the stream has consumed everything, the same rows as recommendations."""
    r = materialize(fx.ratings(spark, sf_dir))
    cat = materialize(catalog_of(spark, sf_dir, r))
    nb = materialize(cat_ops.prune_neighbours(item_neighbours(spark, sf_dir, r), cat))
    sink = scratch_path(spark, "recs-sink")
    stream_ops.run_feedback_stream(spark, sf_dir, **fx.stream_options(),
                                   on_batch=rescore_ops.rescorer(nb, cat, sink))
    return _recs_out(rescore_ops.current_recommendations(spark, sink))


# ---- D12, G1 -----------------------------------------------------------------------

TARGET_ITEM = 1


@query("profile_summary")
def q_profile_summary(spark, sf_dir):
    """user_id, likes, dislikes, matches (recommendation rows; 0 without likes)."""
    prefs, nb, cat = profile_inputs(spark, sf_dir)
    counts = fb_ops.preference_counts(prefs)
    recs = prof_ops.recommend(prefs, nb, cat).groupBy("user_id").agg(F.count(F.lit(1)).alias("matches"))
    return counts.join(recs, "user_id", "left").select(
        "user_id", "likes", "dislikes", F.coalesce(F.col("matches"), F.lit(0)).cast("long").alias("matches"))


@query("similar_items_for_item")
def q_similar_items_for_item(spark, sf_dir):
    """The five items most similar to one item (either side of the pair), as the
    first written top-5 report."""
    sims = sim_ops.similarity_to(fx.ratings(spark, sf_dir), [TARGET_ITEM])
    s = sim_ops.similar_items(sims, TARGET_ITEM, k=5)
    return s.select("item_id", "neighbour_id", "n_common", "sim")


FLAGSHIP = "recommendations"
