"""Item-item similarity over co-raters, neighbour lists and similar-item lookups.

Similarity of items i and j over the users who rated both, with each item's mean
taken over all of its raters:

    sim = S (x - mu_i)(y - mu_j) / ( sqrt(S (x - mu_i)^2) * sqrt(S (y - mu_j)^2) )

and 0 when either factor is 0. Optional, in this order: clip to [-1, 1], shrink by
c / (c + shrink) for c co-raters, drop pairs with fewer than ``min_common``.

Plan shape: the sparse product of the ratings with themselves by user (never a dense
matrix), so the cost is the sum over users of deg^2 / 2. A user's ratings form one
list, ordered by (raters of the item, item). Each item of the list is sent, with the
items after it as two narrow arrays, to the partition of that item, which owns its
pairs: pairs are made and summed there and are not shuffled. The rarer item owns a
pair, so an item at place p of N ratings by popularity has at most N / p raters and
p more popular items: no item gets more than N pairs. Heavy users are salted: their
items are dealt to ``s`` chunks by hash and a list is made for each pair of chunks,
so one user's quadratic block is split over s(s+1)/2 lists and every pair is still
produced exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tastegraph.operators.skew import BUCKETS, heavy_keys, sent_keys, with_buckets
from tastegraph.session import materialized, shuffle_partitions


EXACT = "decimal(38,0)"
SMALL = 1 << 20  # three factors below it and four such products: a sum below 2^62


def _terms(n_i, s_i, n_j, s_j, c, sx, sy, sxy, sxx, syy, m):
    """Numerator and squared norms, all scale factors cancelled; ``m`` is the product of three."""
    num = m(n_i, n_j, sxy) - m(s_i, n_j, sy) - m(s_j, n_i, sx) + m(s_i, s_j, c)
    dx = m(n_i, n_i, sxx) - m(n_i, s_i, sx) * 2 + m(s_i, s_i, c)
    dy = m(n_j, n_j, syy) - m(n_j, s_j, sy) * 2 + m(s_j, s_j, c)
    return num, dx, dy


def _exact_terms(*parts: Column) -> tuple[Column, ...]:
    """``_terms`` as exact integers: in longs where all ten parts are below SMALL, in decimal(38,0)
    elsewhere (up to about 10^9 ratings of each item). Both give the same integer and the
    double nearest to it, which is what is returned."""
    longs = _terms(*[x.cast("long") for x in parts], lambda a, b, z: a * b * z)
    wide = _terms(*[x.cast("decimal(19,0)") for x in parts], lambda a, b, z: ((a * b).cast(EXACT) * z).cast(EXACT))
    small = F.greatest(*[F.abs(x) for x in parts]) < SMALL
    return tuple(F.when(small, x.cast("double")).otherwise(y.cast("double")) for x, y in zip(longs, wide, strict=True))


def _cosine(num: Column, dx: Column, dy: Column) -> Column:
    return F.when((dx > 0) & (dy > 0), num / (F.sqrt(dx) * F.sqrt(dy))).otherwise(F.lit(0.0))


def pair_similarity(ratings: DataFrame, *, min_item: int = 0, min_common: int = 0,
                    shrink: float = 0.0, clip: bool = False, scale: int | None = 2,
                    heavy_degree: int = 20000, max_salt: int | None = None,
                    user_col: str = "user_id", item_col: str = "item_id",
                    rating_col: str = "rating") -> DataFrame:
    """item_i < item_j, n_common, sim.

    ``scale``: ratings times ``scale`` must be integers (2 for half-steps; any other
    rating raises an error); then every sum is an exact long and the result does not
    depend on shuffle order. ``scale=None`` centres each rating on its item's mean before
    the join and sums doubles; what remains within 10^-9 of the mean counts as 0, so an
    item whose ratings are all equal has similarity 0.
    ``min_item``: items with fewer raters are left out before the join (they
    could never reach a useful support). ``heavy_degree``: users with more ratings
    than this are salted into ceil(deg / heavy_degree) buckets (``max_salt``: at most so
    many; no limit by default).
    """
    r, stats = _written(_scaled(ratings, scale, user_col, item_col, rating_col), scale, min_item)
    pairs = _co_sums(r, stats, heavy_degree, max_salt)
    if min_common > 0:
        pairs = pairs.where(F.col("c") >= min_common)

    return _finish(pairs, _sent(stats), scale=scale, clip=clip, shrink=shrink)


BROADCAST_ITEMS = 1 << 22  # item stats (three longs each) that are sent to every executor: about 100 MB


def _sent(stats: DataFrame) -> DataFrame:
    """The written item stats, broadcast while they are counted to be at most BROADCAST_ITEMS, whatever the session's
    threshold: joined with a shuffle, they would send every summed pair twice more."""
    return F.broadcast(stats) if stats.count() <= BROADCAST_ITEMS else stats


def _co_sums(r: DataFrame, stats: DataFrame, heavy_degree: int, max_salt: int | None = None) -> DataFrame:
    """(i < j, c, sx, sy, sxy, sxx, syy) over the users of r (u, item, x) who rated both; stats: (item, n) of
    all items of r. An item's order is (n, item): the rarer item of a pair owns it."""
    spark = r.sparkSession
    rows, item_type, upper, x_type = narrow_types(r)
    n_parts = max(shuffle_partitions(spark), -(-rows // ROWS_A_PART))
    # Only heavy users need their degree: the table of users above heavy_degree has
    # at most rows / heavy_degree entries, so joining it costs no full shuffle of the
    # ratings by user. Users with a single rating need no filter: they give no pair.
    r = r.where(F.col("u").isNotNull() & F.col("item").isNotNull())
    heavy = sent_keys(heavy_keys(r, ["u"], threshold=heavy_degree, max_salt=max_salt))
    # one list for each cell, in the items' order, as plain arrays
    lists = (_lists(r.join(stats.select("item", "n"), "item"), ["n", "item", "x"], heavy, n_parts)
             .select((F.col("a") != F.col("z")).alias("crossed"), *halves(F.col("l.item"), item_type, upper),
                     F.col("l.x").cast(f"array<{x_type}>").alias("xs"), F.col("l.chunk").alias("chunks")))
    # an item of the list with all that come after it: what is shuffled, by the owner
    place = F.col("p")
    after = lambda c: F.slice(c, place + 2, F.size(c))
    above = after(F.col("uppers"))
    owned = (lists.select("crossed", "ids", "uppers", "xs", "chunks", F.posexplode("ids").alias("p", "i"))
             .where(place + 1 < F.size("ids"))
             .select(whole(F.col("i"), F.get("uppers", place), upper).alias("i"), F.get("xs", place).alias("xi"),
                     after(F.col("ids")).alias("js"), F.when(F.exists(above, lambda x: x != 0), above).alias("ujs"), after(F.col("xs")).alias("xjs"),
                     F.when(F.col("crossed"), F.get("chunks", place)).alias("own"),
                     F.when(F.col("crossed"), after(F.col("chunks"))).alias("others"))
             .repartition(n_parts, "i"))
    met = (owned.select("i", "xi", "ujs", "xjs", "own", "others", F.posexplode("js").alias("q", "j"))
           .withColumn("j", whole(F.col("j"), F.get("ujs", F.col("q")), upper))
           .where((F.col("i") != F.col("j")) & (F.col("own").isNull() | (F.get("others", F.col("q")) != F.col("own"))))
           .select("i", "j", F.col("xi").cast(_wide(r)).alias("xi"), F.get("xjs", F.col("q")).cast(_wide(r)).alias("xj")))
    sums = met.groupBy("i", "j").agg(
        F.count(F.lit(1)).alias("c"),
        F.sum("xi").alias("si"), F.sum("xj").alias("sj"),
        F.sum(F.col("xi") * F.col("xj")).alias("sxy"),
        F.sum(F.col("xi") * F.col("xi")).alias("sii"),
        F.sum(F.col("xj") * F.col("xj")).alias("sjj"),
    )
    first = F.col("i") < F.col("j")
    item = dict(r.dtypes)["item"]
    return sums.select(F.least("i", "j").cast(item).alias("i"), F.greatest("i", "j").cast(item).alias("j"), "c",
                       F.when(first, F.col("si")).otherwise(F.col("sj")).alias("sx"),
                       F.when(first, F.col("sj")).otherwise(F.col("si")).alias("sy"), "sxy",
                       F.when(first, F.col("sii")).otherwise(F.col("sjj")).alias("sxx"),
                       F.when(first, F.col("sjj")).otherwise(F.col("sii")).alias("syy"))


def _lists(r: DataFrame, entry: list[Column | str], heavy: DataFrame | None, n_parts: int) -> DataFrame:
    """a, z, l: the entries (the columns ``entry``, then the item's chunk) of each user in order, a list; those of a
    heavy user in a list for each pair of chunks a and z that the items are dealt to."""
    r = with_buckets(r, heavy, ["u"]).withColumn("chunk", F.pmod(F.xxhash64("item"), F.col(BUCKETS)).cast("int"))
    cells = F.transform(F.sequence(F.lit(0), F.col(BUCKETS) - 1), lambda k: F.struct(
        F.least("chunk", k).alias("a"), F.greatest("chunk", k).alias("z")))
    kept = [c for c in r.columns if c not in ("u", BUCKETS, "chunk")]
    rated = (r.select("u", *kept, "chunk", F.explode(cells).alias("cell"))
             .select("u", "cell.a", "cell.z", *kept, "chunk").repartition(n_parts, "u", "a", "z"))
    return rated.groupBy("u", "a", "z").agg(F.sort_array(F.collect_list(F.struct(*entry, "chunk"))).alias("l"))


ROWS_A_PART = 250_000  # ratings a partition of the pair work, at least the session's partitions
WHOLE = [("tinyint", 1 << 7), ("smallint", 1 << 15), ("int", 1 << 31)]


def _wide(r: DataFrame) -> str:
    """The type that the sums of ``x`` are taken in."""
    return dict(r.dtypes)["x"]


HALF = 15  # bits of an id's lower part


def narrow_types(r: DataFrame) -> tuple[int, str, str | None, str]:
    """(rows of r, the narrowest types that hold its items and its x): the lists of co-rated items are the bulk
    of the shuffle. Columns that are not long keep their type. A long item beyond a smallint travels in two parts
    (``halves``): then the types are those of its lower and its upper part, otherwise there is no upper part."""
    types = dict(r.dtypes)
    ends = [f(c).alias(f"{n}_{c}") for c in ("item", "x") for n, f in (("lo", F.min), ("hi", F.max))]
    row = r.agg(F.count(F.lit(1)).alias("rows"), *ends).first()

    def narrow(c: str, bits: int = 0) -> str:
        lo, hi = row[f"lo_{c}"], row[f"hi_{c}"]
        if types[c] != "bigint" or lo is None:
            return types[c]
        return next((t for t, end in WHOLE if -end <= lo >> bits and hi >> bits < end), "bigint")

    split = types["item"] == "bigint" and narrow("item") in ("int", "bigint") and row["lo_item"] is not None
    return row["rows"], "smallint" if split else narrow("item"), narrow("item", HALF) if split else None, narrow("x")


def halves(ids: Column, kind: str, upper: str | None) -> list[Column]:
    """An array of items as ``ids`` and ``uppers``, of the types that ``narrow_types`` gives. Uppers are small or repeat
    wherever ids do not spread over their whole range: in an array of their own they compress (none: they are all 0)."""
    if upper is None:
        return [ids.cast(f"array<{kind}>").alias("ids"), F.lit(None).cast("array<tinyint>").alias("uppers")]
    above = F.transform(ids, lambda x: F.shiftright(x, HALF)).cast(f"array<{upper}>")
    return [F.transform(ids, lambda x: x.bitwiseAND(F.lit((1 << HALF) - 1))).cast(f"array<{kind}>").alias("ids"),
            F.when(F.exists(ids, lambda x: F.shiftright(x, HALF) != 0), above).alias("uppers")]


def whole(lower: Column, upper_part: Column, upper: str | None) -> Column:
    """An item from its two parts (no upper part: 0)."""
    return lower if upper is None else F.shiftleft(F.coalesce(upper_part.cast("bigint"), F.lit(0)), HALF) + lower


def _steps(rating: Column, scale: int) -> Column:
    """The rating in whole steps of 1/scale; any other rating raises an error."""
    steps = rating * F.lit(scale)
    whole = F.round(steps)
    return F.when(steps == whole, whole.cast("long")).when(steps.isNotNull(), F.raise_error(F.concat(
        F.lit(f"rating is not a multiple of 1/{scale}; use scale=None: "), rating.cast("string"))).cast("long"))


def _scaled(ratings: DataFrame, scale, user_col, item_col, rating_col) -> DataFrame:
    x = F.col(rating_col).cast("double") if scale is None else _steps(F.col(rating_col), scale)
    return ratings.select(F.col(user_col).alias("u"), F.col(item_col).alias("item"), x.alias("x"))


def _prepared(ratings: DataFrame, scale, user_col, item_col, rating_col, min_item: int) -> tuple[DataFrame, DataFrame]:
    """(u, item, x) and item stats (item, n, s), both above the support gate. x is the scaled
    rating, or its distance from the item's mean."""
    return _gated(_scaled(ratings, scale, user_col, item_col, rating_col), scale, min_item)


def _gated(r: DataFrame, scale, min_item: int) -> tuple[DataFrame, DataFrame]:
    stats = r.groupBy("item").agg(F.count(F.lit(1)).alias("n"), F.sum("x").alias("s"))
    if min_item > 0:
        stats = stats.where(F.col("n") >= min_item)
    if scale is None:
        mean = stats.select("item", (F.col("s") / F.col("n")).alias("mu"))
        off = F.col("x") - F.col("mu")
        r = r.join(mean, "item").select("u", "item", F.when(
            F.abs(off) > 1e-9 * F.greatest(F.lit(1.0), F.abs("mu")), off).otherwise(F.lit(0.0)).alias("x"))
    elif min_item > 0:
        r = r.join(stats.select("item"), "item", "left_semi")
    return r, stats


def _written(r: DataFrame, scale, min_item: int) -> tuple[DataFrame, DataFrame]:
    """The ratings and the item stats above the support gate, written once: the pair work reads the ratings for
    their range, their heavy users and their lists, and the stats for the items' order (a join that
    also gates the ratings) and for either side of a pair."""
    r = materialized(r, "pair-ratings")
    gated, stats = _gated(r, scale, min_item)
    return gated if scale is None else r, materialized(stats, "pair-items")


def _finish(pairs: DataFrame, stats: DataFrame, *, scale, clip: bool, shrink: float) -> DataFrame:
    """pairs (i, j, c, sx, sy, sxy, sxx, syy) + item stats (item, n, s) -> similarity."""
    c = F.col("c")
    if scale is None:  # the ratings are centred already
        p, sim = pairs, _cosine(F.col("sxy"), F.col("sxx"), F.col("syy"))
    else:
        si = stats.select(F.col("item").alias("i"), F.col("n").alias("n_i"), F.col("s").alias("s_i"))
        sj = stats.select(F.col("item").alias("j"), F.col("n").alias("n_j"), F.col("s").alias("s_j"))
        p = pairs.join(si, "i").join(sj, "j")
        names = ("n_i", "s_i", "n_j", "s_j", "c", "sx", "sy", "sxy", "sxx", "syy")
        terms = p.select("i", "j", "c", *[x.alias(n) for n, x in zip(
            ("num", "dx", "dy"), _exact_terms(*[F.col(k) for k in names]), strict=True)])
        p, sim = terms, _cosine(F.col("num"), F.col("dx"), F.col("dy"))
    if clip:
        sim = F.least(F.greatest(sim, F.lit(-1.0)), F.lit(1.0))
    if shrink and shrink > 0:
        sim = sim * (c.cast("double") / (c + F.lit(float(shrink))))
    return p.select(F.col("i").alias("item_i"), F.col("j").alias("item_j"),
                    F.col("c").alias("n_common"), sim.alias("sim"))


def similarity_to(ratings: DataFrame, items: list[int], *, min_item: int = 0, min_common: int = 0,
                  shrink: float = 0.0, clip: bool = False, scale: int | None = 2,
                  user_col: str = "user_id", item_col: str = "item_id",
                  rating_col: str = "rating") -> DataFrame:
    """The rows of ``pair_similarity`` that involve one of ``items`` (same columns,
    same values), without building the whole pair table: only the raters of the
    target items are joined with their other ratings, so the work is the sum of
    the targets' raters' degrees instead of the sum of all squared degrees."""
    r, stats = _prepared(ratings, scale, user_col, item_col, rating_col, min_item)
    tgt = r.where(F.col("item").isin(list(items))).select("u", F.col("item").alias("t"), F.col("x").alias("xt"))
    other = r.join(tgt.select("u").distinct(), "u", "left_semi").select(
        "u", F.col("item").alias("o"), F.col("x").alias("xo"))
    co = tgt.join(other, "u").where(F.col("t") != F.col("o"))
    # orient each pair as (smaller id, larger id); a pair of two targets is counted once
    lo = F.least("t", "o")
    co = co.where(~(F.col("o").isin(list(items)) & (F.col("t") > F.col("o"))))
    first_is_t = F.col("t") == lo
    pairs = co.select(lo.alias("i"), F.greatest("t", "o").alias("j"),
                      F.when(first_is_t, F.col("xt")).otherwise(F.col("xo")).alias("xa"),
                      F.when(first_is_t, F.col("xo")).otherwise(F.col("xt")).alias("xb")) \
        .groupBy("i", "j").agg(
            F.count(F.lit(1)).alias("c"),
            F.sum("xa").alias("sx"), F.sum("xb").alias("sy"),
            F.sum(F.col("xa") * F.col("xb")).alias("sxy"),
            F.sum(F.col("xa") * F.col("xa")).alias("sxx"),
            F.sum(F.col("xb") * F.col("xb")).alias("syy"))
    if min_common > 0:
        pairs = pairs.where(F.col("c") >= min_common)
    return _finish(pairs, stats, scale=scale, clip=clip, shrink=shrink)


# ---- a stored pair table that is kept up to date --------------------------------------------------

SUMS = ["c", "sx", "sy", "sxy", "sxx", "syy"]


def pair_table(ratings: DataFrame, *, scale: int = 2, heavy_degree: int = 20000) -> tuple[DataFrame, DataFrame]:
    """(sums of every pair of items with a co-rater: i, j, c, sx, sy, sxy, sxx, syy; stats of every item: item,
    n, s), both exact integers: what ``similarity_of`` needs, and what merges by addition."""
    r, stats = _written(_scaled(ratings, scale, "user_id", "item_id", "rating"), scale, 0)
    return _co_sums(r, stats, heavy_degree), stats


def rating_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """user_id, item_id, rating, weight: +1 for each new rating and -1 for each that is gone; a changed one is both."""
    key = ["user_id", "item_id"]
    both = (before.select(*key, F.col("rating").alias("old"))
            .join(after.select(*key, F.col("rating").alias("new")), key, "full"))
    moved = both.where(~F.col("old").eqNullSafe(F.col("new")))
    sides = F.array(F.struct(F.col("old").alias("rating"), F.lit(-1).alias("weight")),
                    F.struct(F.col("new").alias("rating"), F.lit(1).alias("weight")))
    return (moved.select(*key, F.explode(sides).alias("s")).select(*key, "s.rating", "s.weight")
            .where(F.col("rating").isNotNull()))


def _packed(sums: DataFrame) -> tuple[DataFrame, Column, list[Column]]:
    """sums (i, k, j, SUMS) as i, k, other, v, with the sums and a long j in an array ``v`` of the narrowest whole type (what
    is left of j otherwise is in ``other``); then j and the sums read from them."""
    long_j = dict(sums.dtypes)["j"] == "bigint"
    parts = [F.col(n) for n in SUMS]
    if long_j:
        parts += [F.col("j").bitwiseAND(F.lit((1 << HALF) - 1)), F.shiftright("j", HALF)]
    ends = sums.agg(F.min(F.least(*parts)).alias("lo"), F.max(F.greatest(*parts)).alias("hi")).first()
    kind = next((t for t, end in WHOLE if ends["lo"] is not None and -end <= ends["lo"] and ends["hi"] < end), "bigint")
    at = lambda k: F.get("v", F.lit(k)).cast("bigint")
    j = F.shiftleft(at(len(SUMS) + 1), HALF) + at(len(SUMS)) if long_j else F.col("other")
    other = F.lit(None).cast("bigint") if long_j else F.col("j")
    return (sums.select("i", "k", other.alias("other"), F.array(*parts).cast(f"array<{kind}>").alias("v")), j,
            [at(k).alias(n) for k, n in enumerate(SUMS)])


HEAVY_ITEM = 100_000  # ratings of an item; its pairs are dealt to several places beyond that


def updated_pair_table(sums: DataFrame, stats: DataFrame, before: DataFrame, changes: DataFrame, *, scale: int = 2,
                       heavy_degree: int = 20000, heavy_item: int = HEAVY_ITEM) -> tuple[DataFrame, DataFrame]:
    """The pair table of the ratings after ``changes``, from that of the ratings ``before`` them. With R the
    ratings and D the signed changes, the new sums less the old ones are those of D with R, R with D and
    D with D: only the ratings of users who changed something are read.

    A user's known and changed ratings form one list. Each entry goes, with the later ones that it makes a pair with,
    as narrow arrays to the place of its item, and so do the stored sums: there the pairs are made and added, no
    pair of ratings is shuffled. The order, by hash of the item, needs nothing but the item, so either side finds
    the owner of a pair; the pairs of an item with very many ratings are dealt out by the other item."""
    r = _scaled(before, scale, "user_id", "item_id", "rating")
    signed = changes.select(F.col("user_id").alias("u"), F.col("item_id").alias("item"),
                            _steps(F.col("rating"), scale).alias("x"), F.col("weight").cast("long").alias("w"))
    moving = signed.where((F.col("w") != 0) & F.col("u").isNotNull() & F.col("item").isNotNull())
    rows, item_type, upper, x_type = narrow_types(r.select("item", "x").unionByName(moving.select("item", "x")))
    w_type = narrow_types(moving.select("item", F.col("w").alias("x")))[3]
    n_parts = max(shuffle_partitions(before.sparkSession), -(-rows // ROWS_A_PART))
    # an entry without a weight is a rating that stands: it counts once, and makes pairs with changes only
    known = r.where(F.col("item").isNotNull()).join(moving.select("u").distinct(), "u", "left_semi")
    entries = known.withColumn("w", F.lit(None).cast("long")).unionByName(moving)
    all_rows = r.select("u", "item").unionByName(moving.select("u", "item"))
    heavy = sent_keys(heavy_keys(all_rows, ["u"], threshold=heavy_degree))
    many = sent_keys(heavy_keys(all_rows, ["item"], threshold=heavy_item).withColumnRenamed("item", "i"))
    e, b = F.col("e"), F.col(BUCKETS)
    meets = lambda o: ((e["w"].isNotNull() | o["w"].isNotNull()) & (o["item"] != e["item"])
                       & ((F.col("a") == F.col("z")) | (o["chunk"] != e["chunk"])))
    dealt = F.filter("l", lambda o: F.pmod(F.xxhash64(o["item"]), b) == F.col("k"))
    pairs = (_lists(entries, [F.xxhash64("item").alias("h"), "item", "x", "w"], heavy, n_parts)
             .select("a", "z", "l", F.posexplode("l").alias("p", "e"))
             .select(e["item"].alias("i"), e["x"].cast(x_type).alias("xi"), e["w"].cast(w_type).alias("wi"),
                     F.filter(F.slice("l", F.col("p") + 2, F.size("l")), meets).alias("l"))
             .where(F.size("l") > 0))
    owned = (with_buckets(pairs, many, ["i"])
             .withColumn("k", F.explode(F.sequence(F.lit(0), b - 1).cast("array<long>")))
             .withColumn("l", F.when(b == 1, F.col("l")).otherwise(dealt))
             .select("i", "k", "xi", "wi", *halves(F.col("l.item"), item_type, upper),
                     F.col("l.x").cast(f"array<{x_type}>").alias("xs"), F.col("l.w").cast(f"array<{w_type}>").alias("ws")))
    # sums as the owner sees them: its own side first
    mine = F.struct(F.xxhash64("i"), "i") < F.struct(F.xxhash64("j"), "j")
    flipped = ["c", "sy", "sx", "sxy", "syy", "sxx"]
    stored = sums.select(F.when(mine, F.col("i")).otherwise(F.col("j")).alias("i"),
                         F.when(mine, F.col("j")).otherwise(F.col("i")).alias("j"),
                         *[F.when(mine, F.col(n)).otherwise(F.col(m)).alias(n) for n, m in zip(SUMS, flipped, strict=True)])
    stored = with_buckets(stored, many, ["i"]).withColumn("k", F.pmod(F.xxhash64("j"), b))
    stored, j, of = _packed(stored.select("i", "k", "j", *SUMS))
    at = F.col("p")
    met = (owned.unionByName(stored, allowMissingColumns=True).repartition(n_parts, "i", "k")
           .select("i", "k", "other", "v", "xi", "wi", "uppers", "xs", "ws", F.posexplode_outer("ids").alias("p", "id"))
           .withColumn("j", F.coalesce(j, whole(F.col("id"), F.get("uppers", at), upper).cast(dict(sums.dtypes)["j"])))
           .select("i", "k", "j", *of, F.col("xi").cast("long").alias("x"), F.get("xs", at).cast("long").alias("y"), F.when(
               at.isNotNull(), F.coalesce("wi", F.lit(1)).cast("long") * F.coalesce(F.get("ws", at), F.lit(1))).alias("w")))
    w, x, y = F.col("w"), F.col("x"), F.col("y")
    added = met.groupBy("i", "k", "j").agg(*[F.sum(F.coalesce(F.col(n), v)).alias(n) for n, v in zip(
        SUMS, (w, w * x, w * y, w * x * y, w * x * x, w * y * y), strict=True)])
    first = F.col("i") < F.col("j")
    merged = added.where(F.col("c") > 0).select(
        F.least("i", "j").alias("i"), F.greatest("i", "j").alias("j"),
        *[F.when(first, F.col(n)).otherwise(F.col(m)).alias(n) for n, m in zip(SUMS, flipped, strict=True)])
    moved = signed.groupBy("item").agg(F.sum("w").alias("n"), F.sum(F.col("w") * F.col("x")).alias("s"))
    counts = (stats.select("item", "n", "s").unionByName(moved).groupBy("item")
              .agg(F.sum("n").alias("n"), F.sum("s").alias("s")).where(F.col("n") > 0))
    return merged, counts


def similarity_of(sums: DataFrame, stats: DataFrame, *, min_item: int = 0, min_common: int = 0, shrink: float = 0.0,
                  clip: bool = False) -> DataFrame:
    """The rows of ``pair_similarity`` (ratings on a grid) from a pair table."""
    pairs = sums.where(F.col("c") >= min_common) if min_common > 0 else sums
    stats = _sent(materialized(stats.where(F.col("n") >= min_item), "pair-items"))
    return _finish(pairs, stats, scale=2, clip=clip, shrink=shrink)


def symmetrise(sims: DataFrame) -> DataFrame:
    """Both directions of every unordered pair: item_id, neighbour_id, n_common, sim."""
    ends = [F.struct(F.col(x).alias("item_id"), F.col(y).alias("neighbour_id"))
            for x, y in (("item_i", "item_j"), ("item_j", "item_i"))]
    # an explode and not a union, whose two sides would each make the pairs
    return (sims.select(F.explode(F.array(*ends)).alias("e"), "n_common", "sim")
            .select("e.item_id", "e.neighbour_id", "n_common", "sim"))


def neighbours(sims: DataFrame, *, k: int = 30, min_sim: float | None = 0.05,
               digits: int | None = 6, display_digits: int | None = None) -> DataFrame:
    """item_id, rank, neighbour_id, sim: the k strongest neighbours of each item.
    ``display_digits`` rounds the kept values last, after the gate and the cut.

    The similarity is rounded once (``digits``) and the cut is taken on the rounded
    value, then neighbour id ascending, so float noise cannot flip a cut. The bare
    ``rank <= k`` filter on ``row_number`` lets Spark prune each map task's group to
    k rows before the shuffle (WindowGroupLimit)."""
    sym = symmetrise(sims)
    if digits is not None:
        sym = sym.withColumn("sim", F.round("sim", digits))
    if min_sim is not None:
        sym = sym.where(F.col("sim") >= F.lit(min_sim))
    w = Window.partitionBy("item_id").orderBy(F.col("sim").desc(), F.col("neighbour_id").asc())
    sim = F.col("sim") if display_digits is None else F.round("sim", display_digits)
    return (sym.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= k)
            .select("item_id", "rank", "neighbour_id", sim.alias("sim")))


def similar_items(sims: DataFrame, item: int | None = None, *, k: int = 5,
                  digits: int | None = 6) -> DataFrame:
    """The k items most similar to ``item`` (any side of the pair), by similarity
    desc then id. With ``item=None`` the same list for every item at once."""
    if item is not None:
        touching = sims.where((F.col("item_i") == item) | (F.col("item_j") == item))
        other = F.when(F.col("item_i") == item, F.col("item_j")).otherwise(F.col("item_i"))
        s = F.round("sim", digits) if digits is not None else F.col("sim")
        return (touching.select(F.lit(item).cast("long").alias("item_id"),
                                other.alias("neighbour_id"), "n_common", s.alias("sim"))
                .orderBy(F.col("sim").desc(), F.col("neighbour_id").asc())
                .limit(k))
    return neighbours(sims, k=k, min_sim=None, digits=digits)
