"""Hand-worked similarities, properties of the pair table, salting, neighbours."""

import collections
import math

import pytest
from pyspark.sql import functions as F

from tastegraph.operators import similarity as S
from tastegraph.sources import fixtures as fx

from .conftest import SF_SMALL


def ratings_df(spark, rows):
    return spark.createDataFrame(rows, "user_id long, item_id long, rating double")


def sims_dict(df):
    return {(r.item_i, r.item_j): (r.n_common, r.sim) for r in df.collect()}


def test_plus_minus_zero(spark):
    # item means: a=3, b=3, c=3, d=4. b follows a exactly, c mirrors a, d is constant.
    rows = [(1, 1, 1.0), (2, 1, 3.0), (3, 1, 5.0),
            (1, 2, 1.0), (2, 2, 3.0), (3, 2, 5.0),
            (1, 3, 5.0), (2, 3, 3.0), (3, 3, 1.0),
            (1, 4, 4.0), (2, 4, 4.0), (3, 4, 4.0)]
    d = sims_dict(S.pair_similarity(ratings_df(spark, rows)))
    assert d[(1, 2)] == (3, pytest.approx(1.0))
    assert d[(1, 3)] == (3, pytest.approx(-1.0))
    assert d[(1, 4)] == (3, 0.0)  # zero variance -> exactly 0
    assert d[(2, 3)][1] == pytest.approx(-1.0)


def test_mean_over_all_raters_not_co_raters(spark):
    # item 2 has an extra rater (user 3) that shifts its mean to 2; co-raters are 1, 2
    rows = [(1, 1, 1.0), (2, 1, 2.0), (1, 2, 1.0), (2, 2, 2.0), (3, 2, 3.0)]
    d = sims_dict(S.pair_similarity(ratings_df(spark, rows)))
    x = [1 - 1.5, 2 - 1.5]
    y = [1 - 2.0, 2 - 2.0]
    num = sum(a * b for a, b in zip(x, y))
    want = num / (math.sqrt(sum(a * a for a in x)) * math.sqrt(sum(b * b for b in y)))
    assert d[(1, 2)][1] == pytest.approx(want)


def test_shrink_gate_clip_order(spark):
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(1, 12) for i in range(1, 4)]
    r = ratings_df(spark, rows)
    raw = sims_dict(S.pair_similarity(r))
    shr = sims_dict(S.pair_similarity(r, min_common=8, shrink=25, clip=True))
    gated = sims_dict(S.pair_similarity(r, min_common=12, shrink=25, clip=True))
    assert gated == {}
    for k, (c, s) in raw.items():
        c2, s2 = shr[k]
        assert c2 == c == 11
        assert s2 == pytest.approx(max(-1.0, min(1.0, s)) * c / (c + 25))
        assert (s2 > 0) == (s > 0) or s == 0  # shrinkage never flips the sign


@pytest.fixture(scope="module")
def small_pairs(spark):
    r = fx.ratings(spark, SF_SMALL)
    return r, S.pair_similarity(r).toPandas()


def test_properties_on_fixture(spark, small_pairs):
    r, p = small_pairs
    assert (p.sim.abs() <= 1 + 1e-12).all()
    assert (p.item_i < p.item_j).all()
    # scaling every rating by a constant changes no similarity (double path)
    scaled = S.pair_similarity(r.withColumn("rating", F.col("rating") * 3), scale=None).toPandas()
    m = p.merge(scaled, on=["item_i", "item_j"], suffixes=("", "_s"))
    assert len(m) == len(p)
    assert (m.sim - m.sim_s).abs().max() < 1e-9


def test_exact_equals_double_form(spark, small_pairs):
    r, p = small_pairs
    d = S.pair_similarity(r, scale=None).toPandas()
    m = p.merge(d, on=["item_i", "item_j"], suffixes=("", "_d"))
    assert len(m) == len(p)
    assert (m.sim - m.sim_d).abs().max() < 1e-9


def test_salted_equals_unsalted(spark, small_pairs):
    r, p = small_pairs
    salted = S.pair_similarity(r, heavy_degree=5, max_salt=7).toPandas()
    a = p.sort_values(["item_i", "item_j"]).reset_index(drop=True)
    b = salted.sort_values(["item_i", "item_j"]).reset_index(drop=True)
    assert a[["item_i", "item_j", "n_common"]].equals(b[["item_i", "item_j", "n_common"]])
    assert (a.sim - b.sim).abs().max() == 0.0


def test_neighbours_cut_and_order(spark, small_pairs):
    r, _ = small_pairs
    sims = S.pair_similarity(r, min_item=8, min_common=8, shrink=25, clip=True)
    nb = S.neighbours(sims, k=3, min_sim=0.05).toPandas()
    assert nb.groupby("item_id").size().max() <= 3
    assert (nb.sim >= 0.05).all()
    for _, g in nb.groupby("item_id"):
        g = g.sort_values("rank")
        keys = list(zip(-g.sim, g.neighbour_id))
        assert keys == sorted(keys)


def test_similar_items_single_target(spark):
    rows = [(u, i, float(1 + (u * i * 7) % 5)) for u in range(1, 9) for i in range(1, 6)]
    sims = S.pair_similarity(ratings_df(spark, rows))
    one = S.similar_items(sims, 3, k=2).toPandas()
    every = S.similar_items(sims, k=2).toPandas()
    want = every[every.item_id == 3].sort_values("rank")
    assert list(one.neighbour_id) == list(want.neighbour_id)


def test_salted_join_equals_plain_join(spark):
    from tastegraph.operators.skew import salted_join

    left = spark.createDataFrame([(k % 3, i) for i, k in enumerate(range(60))] + [(7, 100)], "k long, a long")
    right = spark.createDataFrame([(0, "x"), (0, "y"), (1, "z"), (5, "w")], "k long, b string")
    plain = sorted(tuple(r) for r in left.join(right, ["k"]).collect())
    salted = sorted(tuple(r) for r in salted_join(left, right, ["k"], salt_cols=["a"], threshold=4,
                                                  max_salt=5).select("k", "a", "b").collect())
    assert plain == salted
    lj = sorted(tuple(r) for r in salted_join(left, right, ["k"], salt_cols=["a"], threshold=4, how="left")
                .select("k", "a", "b").collect())
    assert lj == sorted(tuple(r) for r in left.join(right, ["k"], "left").collect())


def test_cf_prediction_salted_equals_plain(spark):
    from tastegraph.operators import predict as P
    from tastegraph.operators import split as SP

    s = SP.hash_split(fx.ratings(spark, SF_SMALL))
    train, test = s.where("split = 'train'"), s.where("split = 'test'")
    sims = S.pair_similarity(train)
    a = P.predict_item_cf(test, sims, train).toPandas().sort_values(["user_id", "item_id"]).reset_index(drop=True)
    b = P.predict_item_cf(test, sims, train, heavy_targets=3).toPandas().sort_values(
        ["user_id", "item_id"]).reset_index(drop=True)
    assert a.equals(b)


def test_similarity_to_equals_full_table(spark, small_pairs):
    r, p = small_pairs
    for items in ([1], [3, 7, 150]):
        part = S.similarity_to(r, items).toPandas().sort_values(["item_i", "item_j"]).reset_index(drop=True)
        want = p[p.item_i.isin(items) | p.item_j.isin(items)].sort_values(["item_i", "item_j"]).reset_index(drop=True)
        assert part[["item_i", "item_j", "n_common"]].equals(want[["item_i", "item_j", "n_common"]])
        assert (part.sim - want.sim).abs().max() == 0.0
    gated = S.similarity_to(r, [5], min_item=8, min_common=8, shrink=25, clip=True).toPandas()
    full = S.pair_similarity(r, min_item=8, min_common=8, shrink=25, clip=True).toPandas()
    full = full[(full.item_i == 5) | (full.item_j == 5)]
    assert len(gated) == len(full)


def test_symmetric_and_nested_order(spark, small_pairs):
    from tastegraph.sources import sinks

    r, _ = small_pairs
    sims = S.pair_similarity(r, min_item=8, min_common=8, shrink=25, clip=True)
    sym = S.symmetrise(sims).toPandas()
    both = sym.merge(sym, left_on=["item_id", "neighbour_id"], right_on=["neighbour_id", "item_id"])
    assert len(both) == len(sym) and (both.sim_x == both.sim_y).all()
    nb = S.neighbours(sims, k=30, min_sim=0.05)
    flat = nb.toPandas()
    nested = {x.item_id: x.neighbours for x in sinks.nested_neighbours(nb).collect()}
    for item, g in flat.groupby("item_id"):
        want = list(g.sort_values("rank").neighbour_id)
        assert [e.neighbour_id for e in nested[item]] == want


def test_constant_items_have_similarity_zero_without_a_grid(spark):
    """Ratings that are no multiples of a step: items of equal ratings stay at 0."""
    import random

    rng = random.Random(3)
    rows = []
    for u in range(40):
        rows += [(u, 1, 3.1), (u, 2, 0.7), (u, 3, rng.uniform(0, 5)), (u, 4, 2 * rows[-1][2] if rows else 1.0)]
    r = spark.createDataFrame(rows, "user_id long, item_id long, rating double")
    got = {(x.item_i, x.item_j): x.sim for x in S.pair_similarity(r, scale=None).collect()}
    assert got[(1, 2)] == got[(1, 3)] == got[(2, 4)] == 0
    assert 0 < abs(got[(3, 4)]) <= 1 + 1e-9
    one = {(x.item_i, x.item_j): x.sim for x in S.similarity_to(r, [3], scale=None).collect()}
    assert one[(3, 4)] == pytest.approx(got[(3, 4)])


def test_ratings_off_the_grid_raise(spark):
    r = spark.createDataFrame([(1, 1, 3.3), (1, 2, 4.0)], "user_id long, item_id long, rating double")
    with pytest.raises(Exception, match="not a multiple"):
        S.pair_similarity(r).collect()


def test_large_counts_are_exact(spark):
    """Sums far beyond the range of a long product: equal to Python's integers."""
    import math

    n, s = 3_000_000_000, 15_000_000_001
    pairs = spark.createDataFrame([(1, 2, n, s, s, 80 * n, 90 * n, 95 * n)],
                                  "i long, j long, c long, sx long, sy long, sxy long, sxx long, syy long")
    stats = spark.createDataFrame([(1, n, s), (2, n, s)], "item long, n long, s long")
    got = S._finish(pairs, stats, scale=2, clip=False, shrink=0).first().sim
    num = n * n * 80 * n - 2 * s * n * s + n * s * s
    dx, dy = (n * n * k * n - 2 * n * s * s + n * s * s for k in (90, 95))
    assert got == pytest.approx(num / (math.sqrt(dx) * math.sqrt(dy)), rel=1e-12)


def test_pair_table_is_kept_up_to_date(spark):
    """New, changed and withdrawn ratings, a heavy user among them: the table of the ratings after."""
    import random

    rng = random.Random(4)
    stars = [x / 2 for x in range(1, 11)]
    before = {(u, i): rng.choice(stars) for u in range(40) for i in rng.sample(range(25), rng.randint(1, 12))}
    before.update({(99, i): rng.choice(stars) for i in range(20)})
    after = {k: (rng.choice(stars) if rng.random() < 0.3 else v) for k, v in before.items() if rng.random() < 0.85}
    after.update({(u, i): rng.choice(stars) for u in range(30, 55) for i in rng.sample(range(30), 4)})
    after.update({(99, i): rng.choice(stars) for i in range(10, 30)})
    old, new = (ratings_df(spark, [(u, i, x) for (u, i), x in sorted(r.items())]) for r in (before, after))
    changes = S.rating_changes(old, new)
    net = {(r.user_id, r.item_id, r.rating): r.weight for r in changes.collect()}
    assert all((w == 1) == (after.get((u, i)) == x) for (u, i, x), w in net.items())
    for heavy in (3, 20000):
        sums, stats = S.updated_pair_table(*S.pair_table(old), old, changes, heavy_degree=heavy)
        want_sums, want_stats = S.pair_table(new)
        cols = ["i", "j", *S.SUMS]
        assert sorted(map(tuple, sums.select(*cols).collect())) == sorted(map(tuple, want_sums.select(*cols).collect()))
        assert sorted(map(tuple, stats.collect())) == sorted(map(tuple, want_stats.collect()))
    for gates in (dict(), dict(min_item=4, min_common=3, shrink=25, clip=True)):
        assert sims_dict(S.similarity_of(sums, stats, **gates)) == sims_dict(S.pair_similarity(new, **gates))
    same = S.updated_pair_table(sums, stats, new, changes.limit(0))
    assert same[0].count() == want_sums.count()


def test_changes_read_only_the_users_who_changed(spark):
    from .test_plans import plan

    old = fx.ratings(spark, SF_SMALL, before="2000-07-01")
    table = S.pair_table(old)
    text = plan(S.updated_pair_table(*table, old, S.rating_changes(old, fx.ratings(spark, SF_SMALL)))[0], "simple")
    assert "LeftSemi" in text and "CartesianProduct" not in text


def test_longs_and_decimals_give_the_same_doubles(spark):
    """Parts around the switch and far beyond it, against Python's integers."""
    import random

    rng = random.Random(9)
    rows = []
    for top in (3, 1000, S.SMALL - 1, S.SMALL, S.SMALL + 5, 10 ** 9, 10 ** 11):
        rows += [tuple(rng.randint(-top if k > 4 else 1, top) for k in range(10)) for _ in range(20)]
    names = ["a", "b", "c", "d", "e", "f", "g", "h", "i", "j"]
    df = spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names))
    out = df.select(*names, *[x.alias(f"t{k}") for k, x in enumerate(S._exact_terms(*[F.col(n) for n in names]))]).collect()
    for r in out:
        want = S._terms(*[r[n] for n in names], lambda a, b, z: a * b * z)
        assert [r.t0, r.t1, r.t2] == [float(x) for x in want]


def test_pairs_are_made_at_their_owner_and_not_shuffled(spark):
    # items 1 to 40 with few and many raters, one of them twice by a user, one rating null, users and items null
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(60) for i in range(1, 41) if (u * 7 + i * i) % (1 + i % 6) == 0]
    rows += [(3, 5, 2.5), (None, 1, 1.0), (None, 2, 2.0), (4, None, 3.0), (5, 7, None)]
    r = ratings_df(spark, rows)
    by_user = collections.defaultdict(list)
    for u, i, x in rows:
        if u is not None and i is not None:
            by_user[u].append((i, x))
    want = collections.Counter()
    for l in by_user.values():
        want.update((i, j) for i, _ in l for j, _ in l if i < j)
    sxy = collections.Counter()
    for l in by_user.values():
        for i, x in l:
            for j, y in l:
                if i < j and x is not None and y is not None:
                    sxy[i, j] += int(4 * x * y)
    for heavy in (20000, 3):
        sums = S.pair_table(r, heavy_degree=heavy)[0].collect()
        assert {(s.i, s.j): s.c for s in sums} == dict(want)
        assert {(s.i, s.j): s.sxy for s in sums if s.sxy is not None} == dict(sxy)
    from .test_plans import plan

    text = plan(S.pair_table(r)[0], "simple")
    top = text[:text.index("Exchange")]  # from the sums down to the first exchange: the pairs are made and summed there
    assert "Generate posexplode" in top and "partial_sum" in top


def test_both_directions_read_the_pairs_once(spark):
    import contextlib
    import io

    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        S.symmetrise(S.pair_similarity(fx.ratings(spark, SF_SMALL))).explain("simple")
    assert "Union" not in buf.getvalue() and buf.getvalue().count("posexplode(js") == 1


def test_long_ids_travel_in_two_parts(spark):
    ids = [0, 5, 32_767, 32_768, 70_000, 2 ** 33 + 1, -1, -40_000]
    rows = [(u, i, float(1 + (u * k) % 5)) for u in range(4) for k, i in enumerate(ids)]
    r = ratings_df(spark, rows)
    kinds = S.narrow_types(r.select(F.col("item_id").alias("item"), F.col("user_id").alias("x")))
    assert kinds == (32, "smallint", "int", "tinyint")
    flat = spark.createDataFrame([(ids,)], "l array<long>").select(*S.halves(F.col("l"), *kinds[1:3]))
    back = F.transform("ids", lambda x, p: S.whole(x, F.get("uppers", p), kinds[2]))
    assert flat.select(back).first()[0] == ids and dict(flat.dtypes)["ids"] == "array<smallint>"
    low = spark.createDataFrame([([3, 32_767],)], "l array<long>").select(*S.halves(F.col("l"), *kinds[1:3])).first()
    assert list(low.ids) == [3, 32_767] and low.uppers is None  # nothing but zeros
    # the pairs of such items are those of the same items with small ids
    small = ratings_df(spark, [(u, ids.index(i), x) for u, i, x in rows])
    want = {frozenset((ids[i], ids[j])): (c, round(s, 12)) for (i, j), (c, s) in sims_dict(S.pair_similarity(small)).items()}
    got = {frozenset(p): (c, round(s, 12)) for p, (c, s) in sims_dict(S.pair_similarity(r)).items()}
    assert got == want and len(got) == 28


def test_pairs_of_changes_are_not_shuffled(spark):
    from .test_plans import plan

    old = fx.ratings(spark, SF_SMALL, before="2000-07-01")
    table = S.pair_table(old)
    changes = S.rating_changes(old, fx.ratings(spark, SF_SMALL))
    text = plan(S.updated_pair_table(*table, old, changes)[0], "simple")
    top = text[:text.index("Exchange")]  # the pairs of two ratings are made and added below the last exchange only
    assert "Generate posexplode" in top and "partial_sum" in top
    plain = S.updated_pair_table(*table, old, changes)[0].select("i", "j", *S.SUMS)
    dealt = S.updated_pair_table(*table, old, changes, heavy_item=5, heavy_degree=10)[0].select("i", "j", *S.SUMS)
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, dealt.collect()))


def test_changes_with_large_ids_nulls_and_no_weight(spark):
    rows = [(u, i, float(1 + (u * i) % 5)) for u in range(8) for i in (1, 2, 40_000, 2 ** 40, -3)]
    old = ratings_df(spark, rows + [(None, 1, 2.0), (3, None, 2.0), (3, 9, None)])
    changes = spark.createDataFrame([(1, 2, 3.0, -1), (1, 2, 5.0, 1), (2, 2 ** 41, 4.0, 1), (3, 1, 2.0, 0), (4, 1, 2.0, None),
                                     (None, 7, 1.0, 1), (5, None, 1.0, 1)],
                                    "user_id long, item_id long, rating double, weight int")
    before = {(r.user_id, r.item_id): r.rating for r in old.collect()}
    first = before[1, 2]
    changes = changes.withColumn("rating", F.when(F.col("weight") == -1, F.lit(first)).otherwise(F.col("rating")))
    new = old.where(~(F.col("user_id").eqNullSafe(1) & F.col("item_id").eqNullSafe(2))).unionByName(
        ratings_df(spark, [(1, 2, 5.0), (2, 2 ** 41, 4.0)]))
    got = S.updated_pair_table(*S.pair_table(old), old, changes)[0]
    want = S.pair_table(new)[0]
    cols = ["i", "j", *S.SUMS]
    key = lambda t: tuple((x is None, x) for x in t)
    rows_of = lambda df: sorted((tuple(x) for x in df.select(*cols).collect()), key=key)
    # a sum over no rating at all is null in a table made anew, and 0 or null in one that was kept up to date
    assert [tuple(v or 0 for v in t) for t in rows_of(got)] == [tuple(v or 0 for v in t) for t in rows_of(want)]


def test_both_states_of_the_ratings_come_from_one_pass(spark):
    day = "2000-07-01"
    both = fx.ratings_then_and_now(spark, SF_SMALL, day)
    rows = lambda df: sorted(map(tuple, df.collect()))
    assert rows(both.select("user_id", "item_id", "rating")) == rows(fx.ratings(spark, SF_SMALL).select("user_id", "item_id", "rating"))
    was = fx.ratings(spark, SF_SMALL, before=day).select("user_id", "item_id", "rating")
    assert rows(both.where("had").select("user_id", "item_id", "old")) == rows(was)


def test_only_the_deciding_columns_of_a_line_are_read(spark):
    from .test_plans import plan

    text = plan(fx.ratings(spark, SF_SMALL), "simple")
    assert "l_extendedprice" not in text and "l_quantity" in text
