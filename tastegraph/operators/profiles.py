"""Scoring like/dislike profiles against neighbour lists, for every user at once.

For a user with liked set L and disliked set X:
  cf(c)     = sum of sim(l -> c) over liked l, for candidates c not in L or X;
              then minus 1.15 * sim(d -> c) for each disliked d, but only for
              candidates that already have a liked contribution;
  aff[g]    = (liked items listing genre g) / (sum over all genres), 1 if none;
  g(c)      = sum of aff over c's genres;  pop(c) = log10(n_c + 1) / log10(n_max + 1);
  final     = cf + 0.35 g + 0.05 pop.
If fewer than 12 candidates have a cf score, the best (12 - have) catalogue items
that share a genre with the profile (and are not scored, liked or disliked) are
added with cf = 0. The top 24 by final are kept; pct = clamp(round(60 + 39 final /
best), 58, 99), 58 when best <= 0. Users without likes get no rows.

Sums of similarities are exact integers (the neighbour similarity is already
rounded to 6 places; see ``UNIT``), so results do not depend on the order rows
meet in a shuffle. Candidate generation is bounded: each preference row meets at most k
neighbour rows; the backfill never enumerates users x catalogue (see
``_backfill``).
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.functions import numeric
from tastegraph.functions.numbering import number_rows
from tastegraph.operators.skew import salted_join

# Fixed values of the profile scorer.
DISLIKE_WEIGHT = Decimal("1.15")
GENRE_WEIGHT = Decimal("0.35")
POP_WEIGHT = Decimal("0.05")
MAX_RECS = 24
MIN_RECS = 12
PCT_FLOOR, PCT_CEIL, PCT_BASE, PCT_SPAN = 58, 99, 60, 39

# Scores are exact integers in units of 1e-8 (similarities and the 6-place genre
# and popularity terms times the fixed weights fit exactly): long sums are exact,
# independent of shuffle order, and far cheaper than wide-decimal sums.
UNIT = 100_000_000


def _u6(x: Column) -> Column:
    """A value rounded once to 6 places, as an exact long in micro-units."""
    return F.round(F.round(x, 6) * 1_000_000).cast("long")


def _w(x: Decimal) -> int:
    """A fixed weight in hundredths (1.15 -> 115)."""
    return int(x * 100)


def liked_of(prefs: DataFrame) -> DataFrame:
    return prefs.where(F.col("state") == "liked").select("user_id", "item_id")


def disliked_of(prefs: DataFrame) -> DataFrame:
    return prefs.where(F.col("state") == "disliked").select("user_id", "item_id")


def contributions(prefs: DataFrame, nb: DataFrame, *, heavy_item: int = 1_000_000) -> DataFrame:
    """user_id, item_id (candidate), source_id (liked item), sim: one row per liked
    item and neighbour, candidates already liked or disliked removed (anti-join).
    An item liked by very many users is salted (its few neighbour rows are
    replicated per bucket)."""
    liked = liked_of(prefs).withColumnRenamed("item_id", "source_id")
    rows = salted_join(liked, nb.select(F.col("item_id").alias("source_id"),
                                        F.col("neighbour_id").alias("item_id"), "sim"),
                       ["source_id"], salt_cols=["user_id"], threshold=heavy_item)
    return rows.join(prefs.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def candidate_scores(prefs: DataFrame, nb: DataFrame, *,
                     dislike_weight: Decimal = DISLIKE_WEIGHT) -> DataFrame:
    """user_id, item_id, cf_u (exact, in 1e-8 units), n_liked, n_disliked.

    Liked and disliked contributions are one union and one aggregate by
    (user, candidate) (partial on the map side); a candidate must have a liked
    contribution, so a dislike never creates one, and must not be liked or
    disliked itself."""
    liked = liked_of(prefs).withColumnRenamed("item_id", "source_id")
    liked = salted_join(liked, nb.select(F.col("item_id").alias("source_id"),
                                         F.col("neighbour_id").alias("item_id"), "sim"),
                        ["source_id"], salt_cols=["user_id"], threshold=1_000_000)
    liked = liked.select("user_id", "item_id", (_u6(F.col("sim")) * 100).alias("w"),
                         F.lit(1).alias("is_like"))
    dis = salted_join(disliked_of(prefs).withColumnRenamed("item_id", "source_id"),
                      nb.select(F.col("item_id").alias("source_id"),
                                F.col("neighbour_id").alias("item_id"), "sim"),
                      ["source_id"], salt_cols=["user_id"], threshold=1_000_000)
    dis = dis.select("user_id", "item_id", (-_u6(F.col("sim")) * _w(dislike_weight)).alias("w"),
                     F.lit(0).alias("is_like"))
    agg = liked.unionByName(dis).groupBy("user_id", "item_id").agg(
        F.sum("w").alias("cf_u"),
        F.sum("is_like").alias("n_liked"),
        F.count_if(F.col("is_like") == 0).alias("n_disliked"))
    # candidates the user already liked or disliked are dropped after the
    # aggregate: one anti-join row per (user, candidate), not per contribution
    agg = agg.where(F.col("n_liked") > 0)
    return agg.join(prefs.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def genre_counts(prefs: DataFrame, catalog: DataFrame) -> DataFrame:
    """user_id, genre, cnt (liked items listing the genre, repeats counted), total
    (sum of cnt over the user's genres)."""
    liked = liked_of(prefs)
    g = liked.join(catalog.select("item_id", F.explode("genres").alias("genre")), "item_id")
    cnt = g.groupBy("user_id", "genre").agg(F.count(F.lit(1)).alias("cnt"))
    # per-user rows are bounded by the genre vocabulary, so the window is small
    return cnt.withColumn("total", F.sum("cnt").over(Window.partitionBy("user_id")))


def genre_affinity(prefs: DataFrame, catalog: DataFrame) -> DataFrame:
    """user_id, genre, cnt, aff = cnt / total."""
    c = genre_counts(prefs, catalog)
    return c.withColumn("aff", F.col("cnt") / F.col("total"))


def taste_top(prefs: DataFrame, catalog: DataFrame, dictionary: DataFrame, *, k: int = 3) -> DataFrame:
    """user_id, rank, genre, cnt: the k genres liked most often (ties: genre index)."""
    c = genre_counts(prefs, catalog).join(dictionary, "genre")
    w = Window.partitionBy("user_id").orderBy(F.col("cnt").desc(), F.col("genre_id").asc())
    return (c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("user_id", "rank", "genre", "cnt"))


def _popularity(catalog: DataFrame) -> DataFrame:
    """item_id, pop6: log10(n + 1) / log10(n_max + 1) rounded to 6 places (micro-units)."""
    n_max = catalog.select(F.max("n")).scalar()
    pop = F.log10(F.col("n") + 1) / F.log10(n_max + 1)
    return catalog.select("item_id", _u6(pop).alias("pop6"))


def _genre_score(rows: DataFrame, counts: DataFrame, catalog: DataFrame) -> DataFrame:
    """rows (user_id, item_id, ...) + g6: sum of the user's genre affinity over the
    item's genres, as (sum of counts) / total, rounded once to 6 places (micro-units)."""
    totals = counts.select("user_id", "total").distinct()
    ig = rows.select("user_id", "item_id").join(
        catalog.select("item_id", F.explode("genres").alias("genre")), "item_id")
    gs = (ig.join(counts.select("user_id", "genre", "cnt"), ["user_id", "genre"], "left")
          .groupBy("user_id", "item_id").agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("gsum")))
    out = rows.join(gs, ["user_id", "item_id"], "left").join(totals, "user_id", "left")
    g = F.coalesce(F.col("gsum"), F.lit(0)) / F.coalesce(F.col("total"), F.lit(1))
    return out.withColumn("g6", _u6(g)).drop("gsum", "total")


def _final(cf_u: Column) -> Column:
    """final in 1e-8 units: cf + 0.35 g + 0.05 pop, exactly."""
    return cf_u + F.col("g6") * _w(GENRE_WEIGHT) + F.col("pop6") * _w(POP_WEIGHT)


def prepare_catalog(catalog: DataFrame) -> dict[str, DataFrame]:
    """The parts of scoring that depend on the catalogue alone: popularity, and
    the genre signatures with their ranked items. Compute them once (and cut them)
    when the same catalogue scores many batches of users, as the stream does."""
    pop = _popularity(catalog)
    items = catalog.where(F.size("genres") > 0).join(pop, "item_id").select(
        "item_id", "pop6", F.concat_ws("\u0001", F.array_sort("genres")).alias("sig"))
    # rank within a signature from one distributed sort of the catalogue: a
    # signature holding most items never sits whole in one window task
    numbered = number_rows(items, [F.col("sig").asc(), F.col("pop6").desc(), F.col("item_id").asc()], "_g")
    first = numbered.groupBy("sig").agg(F.min("_g").alias("_g0"))
    sig_items = (numbered.join(first, "sig")
                 .withColumn("sig_rank", (F.col("_g") - F.col("_g0") + 1).cast("int")).drop("_g", "_g0"))
    sig_genres = (items.select("sig").distinct()
                  .select("sig", F.explode(F.split("sig", "\u0001")).alias("genre"))
                  .groupBy("sig", "genre").agg(F.count(F.lit(1)).alias("mult")))
    return {"pop": pop, "sig_items": sig_items, "sig_genres": sig_genres}


def _backfill(need: DataFrame, counts: DataFrame, excluded: DataFrame, prepared: dict[str, DataFrame]) -> DataFrame:
    """Genre-only rows for users short of candidates.

    need: user_id, want (= MIN_RECS - have > 0). Items with the same genre list
    (a signature) have the same genre score for a user, so within a signature
    the best items are those with the highest popularity, and its most popular item
    bounds all of them. With x excluded items, the first want + x signatures by that bound hold
    want items that are not excluded, each at least as good as any item of a later signature
    (signatures that tie with the last one stay). In each of them only the first want + (excluded
    items of that signature) items can qualify; those ranks are generated and equi-joined. So a user
    has at most (want + x) * want + x candidates but for ties, whatever the catalogue holds."""
    sig_items, sig_genres = prepared["sig_items"], prepared["sig_genres"]
    items = sig_items.select("item_id", "sig")
    prof = counts.join(need.select("user_id"), "user_id", "left_semi")
    user_sig = (prof.join(sig_genres, "genre")
                .groupBy("user_id", "sig").agg(F.sum(F.col("cnt") * F.col("mult")).alias("gsum"),
                                               F.first("total").alias("total")))
    ex = excluded.join(need.select("user_id"), "user_id", "left_semi")
    ex_sig = (ex.join(items.select("item_id", "sig"), "item_id")
              .groupBy("user_id", "sig").agg(F.count(F.lit(1)).alias("n_ex")))
    excluded_items = ex_sig.groupBy("user_id").agg(F.sum("n_ex").alias("x"))
    tops = sig_items.where(F.col("sig_rank") == 1).select("sig", F.col("pop6"))
    bounded = (user_sig.join(tops, "sig").withColumn("g6", _u6(F.col("gsum") / F.col("total")))
               .withColumn("bound", _final(F.lit(0).cast("long"))).drop("g6", "pop6")
               .join(need.join(excluded_items, "user_id", "left"), "user_id"))
    by_bound = F.rank().over(Window.partitionBy("user_id").orderBy(F.col("bound").desc()))
    reached = (bounded.withColumn("by_bound", by_bound)
               .where(F.col("by_bound") <= F.col("want") + F.coalesce(F.col("x"), F.lit(0))).drop("x", "bound", "by_bound"))
    lim = (reached.join(ex_sig, ["user_id", "sig"], "left")
           .withColumn("lim", F.col("want") + F.coalesce(F.col("n_ex"), F.lit(0))))
    ranks = lim.select("user_id", "sig", "gsum", "total", "want",
                       F.explode(F.sequence(F.lit(1), F.col("lim"))).alias("sig_rank"))
    cand = ranks.join(sig_items, ["sig", "sig_rank"])
    cand = cand.join(ex, ["user_id", "item_id"], "left_anti")
    cand = cand.withColumn("g6", _u6(F.col("gsum") / F.col("total")))
    cand = cand.withColumn("cf_u", F.lit(0).cast("long")).withColumn("final", _final(F.col("cf_u")))
    wu = Window.partitionBy("user_id").orderBy(F.col("final").desc(), F.col("item_id").asc())
    return (cand.withColumn("r", F.row_number().over(wu)).where(F.col("r") <= F.col("want"))
            .select("user_id", "item_id", "cf_u", "g6", "pop6", "final", F.lit(1).alias("genre_only")))


def recommend(prefs: DataFrame, nb: DataFrame, catalog: DataFrame, *, max_recs: int = MAX_RECS,
              min_recs: int = MIN_RECS, backfill: bool = True,
              prepared: dict[str, DataFrame] | None = None, scores: DataFrame | None = None) -> DataFrame:
    """user_id, rank, item_id, cf, genre_score, pop, final, pct, genre_only.
    ``prepared``: the output of ``prepare_catalog(catalog)``, if already computed.
    ``scores``: the output of ``candidate_scores(prefs, nb)``, likewise."""
    scores = candidate_scores(prefs, nb) if scores is None else scores
    counts = genre_counts(prefs, catalog)
    if prepared is None:
        prepared = prepare_catalog(catalog) if backfill else {"pop": _popularity(catalog)}
    pop = prepared["pop"]
    cf_rows = _genre_score(scores.select("user_id", "item_id", "cf_u"), counts, catalog).join(pop, "item_id")
    cf_rows = cf_rows.select("user_id", "item_id", "cf_u", "g6", "pop6", _final(F.col("cf_u")).alias("final"),
                             F.lit(0).alias("genre_only"))
    rows = cf_rows
    if backfill:
        likers = liked_of(prefs).select("user_id").distinct()
        have = scores.groupBy("user_id").agg(F.count(F.lit(1)).alias("have"))
        need = (likers.join(have, "user_id", "left")
                .select("user_id", (F.lit(min_recs) - F.coalesce(F.col("have"), F.lit(0))).alias("want"))
                .where(F.col("want") > 0))
        excluded = scores.select("user_id", "item_id").unionByName(prefs.select("user_id", "item_id"))
        rows = rows.unionByName(_backfill(need, counts, excluded, prepared))
    w = Window.partitionBy("user_id").orderBy(F.col("final").desc(), F.col("item_id").asc())
    top = rows.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= max_recs)
    best = F.max("final").over(Window.partitionBy("user_id")).cast("double") / UNIT
    ratio = (F.col("final").cast("double") / UNIT) / best
    raw_pct = numeric.half_up_integer(F.lit(float(PCT_BASE)) + F.lit(float(PCT_SPAN)) * ratio)
    pct = F.when(best > 0, numeric.clamp(raw_pct, PCT_FLOOR, PCT_CEIL)).otherwise(F.lit(PCT_FLOOR))
    # exact integers -> the nearest double (|value| < 2^53, so one correctly
    # rounded division)
    return top.select("user_id", "rank", "item_id",
                      (F.col("cf_u").cast("double") / UNIT).alias("cf"),
                      (F.col("g6").cast("double") / 1_000_000).alias("genre_score"),
                      (F.col("pop6").cast("double") / 1_000_000).alias("pop"),
                      (F.col("final").cast("double") / UNIT).alias("final"),
                      pct.cast("long").alias("pct"), "genre_only")


def reasons(recs: DataFrame, prefs: DataFrame, nb: DataFrame, catalog: DataFrame) -> DataFrame:
    """user_id, item_id, reason: 'Loved by fans of A & B' (two strongest liked
    contributors), 'Because you liked A' (one), else 'A <genre> pick in your
    wheelhouse' with the candidate's genre of greatest affinity (ties: list order)."""
    kept = recs.select("user_id", "item_id")
    titles = catalog.select(F.col("item_id").alias("source_id"), F.col("title").alias("source_title"))
    con = (contributions(prefs, nb).join(kept, ["user_id", "item_id"], "left_semi")
           .join(titles, "source_id")
           .where(F.col("source_title").isNotNull() & (F.col("source_title") != "")))
    wc = Window.partitionBy("user_id", "item_id").orderBy(F.col("sim").desc(), F.col("source_id").asc())
    top2 = con.withColumn("k", F.row_number().over(wc)).where(F.col("k") <= 2)
    names = top2.groupBy("user_id", "item_id").agg(
        F.max(F.when(F.col("k") == 1, F.col("source_title"))).alias("a"),
        F.max(F.when(F.col("k") == 2, F.col("source_title"))).alias("b"))
    counts = genre_counts(prefs, catalog)
    ig = kept.join(catalog.select("item_id", F.posexplode("genres").alias("position", "genre")), "item_id")
    ig = ig.join(counts.select("user_id", "genre", "cnt"), ["user_id", "genre"], "left")
    wg = Window.partitionBy("user_id", "item_id").orderBy(
        F.coalesce(F.col("cnt"), F.lit(0)).desc(), F.col("position").asc())
    top_genre = (ig.withColumn("k", F.row_number().over(wg)).where(F.col("k") == 1)
                 .select("user_id", "item_id", F.col("genre").alias("top_genre")))
    out = kept.join(names, ["user_id", "item_id"], "left").join(top_genre, ["user_id", "item_id"], "left")
    reason = (F.when(F.col("b").isNotNull(), F.format_string("Loved by fans of %s & %s", "a", "b"))
              .when(F.col("a").isNotNull(), F.format_string("Because you liked %s", "a"))
              .otherwise(F.format_string("A %s pick in your wheelhouse",
                                         F.coalesce(F.col("top_genre"), F.lit("great")))))
    return out.select("user_id", "item_id", reason.alias("reason"))
