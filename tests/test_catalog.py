"""Title cleaning table, genre lists, catalogue gates, search, seeded picks."""

from pyspark.sql import functions as F

from tastegraph.functions import text
from tastegraph.operators import catalog as C

TITLES = [
    ("Matrix, The (1999)", "The Matrix", 1999),
    ("Toy Story (1995)", "Toy Story", 1995),
    ("Vie en rose, La (2007)  ", "La Vie en rose", 2007),
    ("Untitled", "Untitled", None),
    ("Boot, Das (1981)", "Das Boot", 1981),
    ("Ring, The", "The Ring", None),
    ("Theory, Then (2000)", "Theory, Then", 2000),
    ("Year (12) (2001)", "Year (12)", 2001),
    ("\tTabbed, The (1990)", "The Tabbed", 1990),
]


def test_clean_title_table(spark):
    df = spark.createDataFrame([(t,) for t, _, _ in TITLES], "t string")
    got = df.select(text.clean_title(F.col("t")).alias("c"), text.title_year(F.col("t")).alias("y")).collect()
    assert [(r.c, r.y) for r in got] == [(c, y) for _, c, y in TITLES]


def test_genre_array_drops_sentinel_and_blanks(spark):
    df = spark.createDataFrame([("A|B||(no genres listed)",), ("(no genres listed)",)], "g string")
    got = [r.a for r in df.select(text.genre_array(F.col("g")).alias("a")).collect()]
    assert got == [["A", "B"], []]


def items_stats(spark):
    items = spark.createDataFrame([(1, "Alpha, The (2000)", "X|Y"), (2, "Beta (1990)", "Y"),
                                   (3, "Gamma", "(no genres listed)"), (4, "Delta (1980)", "Z")],
                                  "item_id long, title string, genres string")
    stats = spark.createDataFrame([(1, 5, 3.25), (2, 3, 3.45), (3, 2, 4.0), (4, 9, 2.0)],
                                  "item_id long, n long, mean_rating double")
    links = spark.createDataFrame([(1, "tt1", 10), (2, "", 0)], "item_id long, imdb string, tmdb long")
    return items, stats, links


def test_build_catalog_gates_and_links(spark):
    items, stats, links = items_stats(spark)
    cat = {r.item_id: r for r in C.build_catalog(items, stats, links, min_ratings=3).collect()}
    assert set(cat) == {1, 2, 4}
    assert cat[1].title == "The Alpha" and cat[1].year == 2000 and cat[1].tmdb == 10 and cat[1].imdb == "tt1"
    assert cat[2].tmdb is None and cat[2].imdb is None  # zero / blank ids are absent
    assert cat[4].tmdb is None and cat[4].year == 1980
    assert cat[1].mean_rating_1dp == 3.2  # half to even
    assert cat[2].genres == ["Y"]


def test_search_and_page(spark):
    items, stats, links = items_stats(spark)
    cat = C.build_catalog(items, stats, links, min_ratings=3)
    assert {r.item_id for r in C.search_catalog(cat, "  ALP ").collect()} == {1}
    assert {r.item_id for r in C.search_catalog(cat, "", "Y").collect()} == {1, 2}
    page = C.catalog_page(cat, offset=1, size=1).collect()
    assert [(r.item_id, r.position, r.total) for r in page] == [(1, 1, 3)]


def test_seed_profiles_distinct_and_stable(spark):
    items, stats, links = items_stats(spark)
    cat = C.build_catalog(items, stats, links, min_ratings=3)
    users = spark.createDataFrame([(u,) for u in range(20)], "user_id long")
    a = C.seed_profiles(cat, users, pool=2, k=4).toPandas()
    assert (a.groupby("user_id").item_id.nunique() == 2).all()  # never more than the pool
    assert set(a.item_id) <= {1, 4}  # the two most rated
    b = C.seed_profiles(cat, users.repartition(3), pool=2, k=4).toPandas()
    key = ["user_id", "pick", "item_id"]
    assert a.sort_values(key).reset_index(drop=True).equals(b.sort_values(key).reset_index(drop=True))


def test_number_rows_distributed(spark):
    from tastegraph.functions.numbering import number_rows

    df = spark.range(0, 5000, numPartitions=7).select((F.col("id") * 7919 % 5000).alias("v"))
    got = number_rows(df, [F.col("v").desc()], "k").toPandas().sort_values("k")
    assert list(got.k) == list(range(5000))
    assert list(got.v) == sorted(range(5000), reverse=True)


def test_genre_ids_in_list_order(spark):
    items, stats, links = items_stats(spark)
    cat = C.build_catalog(items, stats, links, min_ratings=3)
    d = C.genre_dictionary(C.clean_items(items))
    ids = {g.genre: g.genre_id for g in d.collect()}
    got = {r.item_id: (r.genres, r.genre_ids) for r in C.with_genre_ids(cat, d).collect()}
    for item, (genres, gids) in got.items():
        assert gids == [ids[g] for g in genres]
    assert got[2][1] == [ids["Y"]]


def test_seed_profiles_draw_evenly_from_a_few_rows_a_user(spark):
    from .test_plans import plan

    cat = spark.createDataFrame([(i, 100 - i) for i in range(20)], "item_id long, n long")
    picks = C.seed_profiles(cat, spark.range(6000).withColumnRenamed("id", "user_id"), pool=10, k=4)
    rows = picks.toPandas()
    assert (rows.groupby("user_id").item_id.nunique() == 4).all() and set(rows.pick) == {1, 2, 3, 4}
    times = rows.groupby("item_id").size()
    assert set(times.index) == set(range(10)) and times.min() > 2200 and times.max() < 2600  # 2400 on average
    text = plan(picks, "simple")
    assert "sequence(0, 9" not in text and "md5" in text  # places are drawn, the pool is not fanned out


def test_seed_profiles_order_the_whole_pool(spark):
    from hashlib import md5

    cat = spark.createDataFrame([(i, 100 - i) for i in range(20)], "item_id long, n long")
    rows = C.seed_profiles(cat, spark.range(50).withColumnRenamed("id", "user_id"), pool=10, k=4).collect()
    got = {}
    for r in sorted(rows, key=lambda r: (r.user_id, r.pick)):
        got.setdefault(r.user_id, []).append(r.item_id)
    assert got == {u: sorted(range(10), key=lambda i: (md5(f"0:{u}:{i}".encode()).hexdigest(), i))[:4] for u in range(50)}
    few = C.seed_profiles(cat.where("item_id < 3"), spark.range(2).withColumnRenamed("id", "user_id"), pool=10, k=4)
    assert few.count() == 6
    no_user = C.seed_profiles(cat, spark.createDataFrame([(None,)], "user_id long"), pool=10, k=2).orderBy("pick").collect()
    assert [r.item_id for r in no_user] == sorted(range(10), key=lambda i: md5(f"0::{i}".encode()).hexdigest())[:2]
