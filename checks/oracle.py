"""Oracle SQL (DuckDB dialect) for every registered query with a SQL twin.

Each string starts from the raw tables (lineitem, orders, part, events) through a
shared CTE prefix that derives the same relations as ``tastegraph.sources.fixtures``,
written independently in SQL (window row_number instead of an arg-max aggregate).
"""

from __future__ import annotations

BASE_CTES = {
    "cls": """cls AS (SELECT CAST(9 * ceil(sqrt(count(*))) AS BIGINT) AS classes FROM part)""",
    "raw": """raw AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, item_id
           ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC,
                    l_quantity DESC, l_extendedprice DESC) AS rn
  FROM (SELECT o_custkey AS user_id,
          CASE WHEN l_partkey % 25 = 3 THEN classes + l_partkey * 8 + l_linenumber
               ELSE l_partkey % classes END AS item_id,
          CAST(ceil(l_quantity / 5.0) AS BIGINT) AS r2, l_shipdate AS ts,
          l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey CROSS JOIN cls))""",
    "r": """r AS (
  SELECT user_id, item_id, r2, CAST(r2 AS DOUBLE) / 2 AS rating, ts FROM raw WHERE rn = 1)""",
    "m": """m AS (
  SELECT item_id, count(*) AS n, CAST(sum(r2) AS BIGINT) AS s, sum(rating) AS rating_sum
  FROM r GROUP BY item_id)""",
    "items": """items AS (
  SELECT item_id,
    concat(CASE WHEN item_id % 3 = 0 THEN concat(split_part(p_name, ' ', 2), ', The') ELSE p_name END,
           CASE WHEN item_id % 10 = 9 THEN '' ELSE concat(' (', CAST(1950 + p_size AS VARCHAR), ')') END) AS title,
    CASE WHEN item_id % 17 = 0 THEN '(no genres listed)'
         ELSE concat(split_part(p_name, ' ', 1), '|', split_part(p_name, ' ', 2), '|', p_type) END AS genres
  FROM (SELECT p_partkey % classes AS item_id, min(p_name) AS p_name, min(p_size) AS p_size, min(p_type) AS p_type
        FROM part CROSS JOIN cls WHERE p_partkey % 25 <> 3 GROUP BY 1 HAVING min(p_size) > 1
        UNION ALL
        SELECT classes + p_partkey * 8 + line, p_name, p_size, p_type
        FROM part CROSS JOIN cls CROSS JOIN range(1, 6) lines(line) WHERE p_partkey % 25 = 3))""",
    "links": """links AS (
  SELECT item_id,
         CASE WHEN item_id % 7 = 0 THEN '' ELSE concat('tt', CAST(item_id AS VARCHAR)) END AS imdb,
         CASE WHEN item_id % 5 = 0 THEN NULL ELSE item_id * 10 END AS tmdb
  FROM items WHERE item_id % 11 <> 0)""",
    "f": """f AS (
  SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
         CASE event_type WHEN 'click' THEN 'like' WHEN 'purchase' THEN 'seed'
              WHEN 'error' THEN 'dislike' WHEN 'view' THEN 'remove'
              WHEN 'signup' THEN CASE WHEN event_id % 20 = 0 THEN 'clear' ELSE 'like' END END AS action,
         ts
  FROM events)""",
}


def with_ctes(*extra: str, select: str) -> str:
    parts = list(BASE_CTES.values()) + list(extra)
    return "WITH " + ",\n".join(parts) + "\n" + select


def pair_cte(name: str = "p", source: str = "r", min_item: int = 0) -> list[str]:
    """Exact-integer co-rating sums per pair (i < j) and the integer numerator and
    norms; ``sim`` is the unshrunk cosine of item-centred ratings."""
    gate = f" WHERE n >= {min_item}" if min_item else ""
    return [
        f"""{name}_m AS (SELECT item_id, count(*) AS n, CAST(sum(r2) AS BIGINT) AS s FROM {source} GROUP BY item_id)""",
        f"""{name}_src AS (SELECT * FROM {source} WHERE item_id IN (SELECT item_id FROM {name}_m{gate}))""",
        f"""{name}_sums AS (
  SELECT a.item_id AS i, b.item_id AS j, count(*) AS c,
         CAST(sum(a.r2) AS BIGINT) AS sx, CAST(sum(b.r2) AS BIGINT) AS sy,
         CAST(sum(a.r2 * b.r2) AS BIGINT) AS sxy, CAST(sum(a.r2 * a.r2) AS BIGINT) AS sxx,
         CAST(sum(b.r2 * b.r2) AS BIGINT) AS syy
  FROM {name}_src a JOIN {name}_src b ON a.user_id = b.user_id AND a.item_id < b.item_id
  GROUP BY a.item_id, b.item_id)""",
        f"""{name}_terms AS (
  SELECT q.i, q.j, q.c,
         mi.n * mj.n * q.sxy - mi.s * mj.n * q.sy - mj.s * mi.n * q.sx + q.c * mi.s * mj.s AS num,
         mi.n * mi.n * q.sxx - 2 * mi.n * mi.s * q.sx + q.c * mi.s * mi.s AS dx,
         mj.n * mj.n * q.syy - 2 * mj.n * mj.s * q.sy + q.c * mj.s * mj.s AS dy
  FROM {name}_sums q JOIN {name}_m mi ON q.i = mi.item_id JOIN {name}_m mj ON q.j = mj.item_id)""",
        f"""{name} AS (
  SELECT i, j, c,
         CASE WHEN dx > 0 AND dy > 0
              THEN CAST(num AS DOUBLE) / (sqrt(CAST(dx AS DOUBLE)) * sqrt(CAST(dy AS DOUBLE)))
              ELSE 0.0 END AS sim
  FROM {name}_terms)""",
    ]


def shrunk_cte(name: str, pairs: str, lam: float = 25.0, min_common: int = 8) -> str:
    return f"""{name} AS (
  SELECT i, j, c, least(greatest(sim, -1.0), 1.0) * (CAST(c AS DOUBLE) / (c + {lam})) AS sim
  FROM {pairs} WHERE c >= {min_common})"""


def neighbour_cte(name: str, sims: str, k: int = 30, min_sim: float = 0.05) -> list[str]:
    return [
        f"""{name}_sym AS (
  SELECT i AS item_id, j AS neighbour_id, round(sim, 6) AS sim FROM {sims}
  UNION ALL SELECT j, i, round(sim, 6) FROM {sims})""",
        f"""{name} AS (
  SELECT * FROM (
    SELECT item_id, neighbour_id, sim,
           row_number() OVER (PARTITION BY item_id ORDER BY sim DESC, neighbour_id) AS rank
    FROM {name}_sym WHERE sim >= {min_sim}) WHERE rank <= {k})""",
    ]


ORACLE: dict[str, str] = {}

ORACLE["item_stats"] = with_ctes(select="""
SELECT item_id, count(*) AS n, sum(rating) AS rating_sum,
       round(sum(rating) / count(*), 6) AS mean_rating
FROM r GROUP BY item_id""")

ORACLE["centred_ratings"] = with_ctes(select="""
SELECT r.user_id, r.item_id, r.rating, round(m.rating_sum / m.n, 6) AS mean_rating,
       round(r.rating - m.rating_sum / m.n, 6) AS norm_rating
FROM r JOIN m ON r.item_id = m.item_id""")

ORACLE["pair_similarity_raw"] = with_ctes(*pair_cte("p"), select="""
SELECT i AS item_i, j AS item_j, c AS n_common, round(sim, 6) AS sim FROM p""")

ORACLE["pair_similarity_shrunk"] = with_ctes(*pair_cte("p", min_item=8), shrunk_cte("ps", "p"), select="""
SELECT i AS item_i, j AS item_j, c AS n_common, round(sim, 6) AS sim FROM ps""")

ORACLE["pair_similarity_updated"] = ORACLE["pair_similarity_shrunk"]

ORACLE["item_neighbours_topk"] = with_ctes(
    *pair_cte("p", min_item=8), shrunk_cte("ps", "p"), *neighbour_cte("nb", "ps"), select="""
SELECT item_id, rank, neighbour_id, sim FROM nb""")

ORACLE["similar_items_topk"] = with_ctes(*pair_cte("p"), select="""
SELECT item_id, rank, neighbour_id, sim FROM (
  SELECT item_id, neighbour_id, sim,
         row_number() OVER (PARTITION BY item_id ORDER BY sim DESC, neighbour_id) AS rank
  FROM (SELECT i AS item_id, j AS neighbour_id, round(sim, 6) AS sim FROM p
        UNION ALL SELECT j, i, round(sim, 6) FROM p)) WHERE rank <= 5""")


CLEAN_CTE = r"""cl AS (
  SELECT item_id, title AS raw_title,
         regexp_replace(regexp_replace(regexp_replace(title, '\s*\((\d{4})\)\s*$', ''), '^\s+|\s+$', '', 'g'),
                        '^(.*),\s+(The|A|An|La|Le|Les|Il|El|Das|Der|Die)$', '\2 \1') AS title,
         CAST(NULLIF(regexp_extract(title, '\s*\((\d{4})\)\s*$', 1), '') AS INTEGER) AS year,
         list_filter(string_split(genres, '|'), lambda g: g <> '' AND g <> '(no genres listed)') AS genres
  FROM items)"""

CAT_CTE = """cat AS (
  SELECT cl.item_id, cl.title, coalesce(cl.year, 0) AS year, cl.genres, m.n, m.rating_sum / m.n AS mean_rating,
         CASE WHEN lk.tmdb <> 0 THEN lk.tmdb END AS tmdb, CASE WHEN lk.imdb <> '' THEN lk.imdb END AS imdb
  FROM cl JOIN m ON cl.item_id = m.item_id LEFT JOIN links lk ON cl.item_id = lk.item_id
  WHERE m.n >= 3)"""

GENRES_CTE = """ig AS (SELECT item_id, unnest(genres) AS genre, unnest(generate_series(0, len(genres) - 1)) AS position FROM cl)"""

DICT_CTE = """gd AS (
  SELECT genre, row_number() OVER (ORDER BY genre) - 1 AS genre_id FROM (SELECT DISTINCT genre FROM ig))"""


def catalog_ctes(with_neighbours: bool = False, k: int = 30) -> list[str]:
    out = [CLEAN_CTE, CAT_CTE, GENRES_CTE, DICT_CTE]
    if with_neighbours:
        out += pair_cte("p", min_item=8) + [shrunk_cte("ps", "p")] + neighbour_cte("nb", "ps", k=k)
        out.append("""nbc AS (
  SELECT * FROM nb WHERE item_id IN (SELECT item_id FROM cat) AND neighbour_id IN (SELECT item_id FROM cat))""")
    return out


ORACLE["catalog"] = with_ctes(*catalog_ctes(), select="""
SELECT item_id, title, CAST(year AS BIGINT) AS year, n, round(mean_rating, 6) AS mean_rating,
       round_even(mean_rating, 1) AS mean_rating_1dp, tmdb, imdb, array_to_string(genres, '|') AS genre_list
FROM cat""")

ORACLE["catalog_titles"] = with_ctes(*catalog_ctes(), select="""
SELECT item_id, raw_title, title, CAST(year AS BIGINT) AS year FROM cl""")

ORACLE["genre_dictionary"] = with_ctes(*catalog_ctes(), select="""
SELECT genre, CAST(genre_id AS BIGINT) AS genre_id FROM gd""")

ORACLE["catalog_genre_ids"] = with_ctes(*catalog_ctes(), select="""
SELECT ig.item_id, CAST(ig.position AS BIGINT) AS position, ig.genre, CAST(gd.genre_id AS BIGINT) AS genre_id
FROM ig JOIN gd ON ig.genre = gd.genre WHERE ig.item_id IN (SELECT item_id FROM cat)""")

ORACLE["catalog_summary"] = with_ctes(*catalog_ctes(with_neighbours=True), select="""
SELECT (SELECT count(*) FROM cat) AS movies,
       (SELECT count(DISTINCT item_id) FROM nbc) AS with_neighbours,
       (SELECT count(*) FROM gd) AS genres,
       CAST(8 AS BIGINT) AS min_common,
       (SELECT count(*) FROM r) AS ratings""")

ORACLE["neighbours_in_catalog"] = with_ctes(*catalog_ctes(with_neighbours=True), select="""
SELECT item_id, rank, neighbour_id, sim FROM nbc""")

ORACLE["catalog_search"] = with_ctes(*catalog_ctes(), select="""
SELECT item_id, title, n FROM cat WHERE contains(lower(title), 'bolt') AND list_contains(genres, 'SMALL')""")

ORACLE["catalog_page"] = with_ctes(*catalog_ctes(), select="""
SELECT item_id, title, n, CAST(position AS BIGINT) AS position, CAST(total AS BIGINT) AS total FROM (
  SELECT item_id, title, n, row_number() OVER (ORDER BY n DESC, item_id) - 1 AS position,
         count(*) OVER () AS total FROM cat)
WHERE position >= 54 AND position < 108""")

ORACLE["seed_profiles"] = with_ctes(*catalog_ctes(), select="""
SELECT user_id, pick, item_id FROM (
  SELECT u.user_id, pool.item_id,
         row_number() OVER (PARTITION BY u.user_id
                            ORDER BY md5(concat('0:', CAST(u.user_id AS VARCHAR), ':', CAST(pool.item_id AS VARCHAR))),
                                     pool.item_id) AS pick
  FROM (SELECT DISTINCT user_id FROM f) u
  CROSS JOIN (SELECT item_id FROM cat ORDER BY n DESC, item_id LIMIT 260) pool)
WHERE pick <= 4""")


# ---- K1 feedback fold: closed form for the state, per-event replay for the
# insertion position (window formulation, independent of the Spark aggregates) ----

FOLD_CTES = [
    """lc AS (SELECT user_id, max(event_id) AS ce FROM f WHERE action = 'clear' GROUP BY user_id)""",
    """fa AS (SELECT f.* FROM f LEFT JOIN lc ON f.user_id = lc.user_id
           WHERE action <> 'clear' AND (ce IS NULL OR event_id > ce))""",
    """fs AS (SELECT *,
        max(CASE WHEN action IN ('dislike','remove','seed') THEN event_id END) OVER (PARTITION BY user_id, item_id) AS se,
        max(CASE WHEN action IN ('like','seed','dislike') THEN event_id END) OVER (PARTITION BY user_id, item_id) AS le
      FROM fa)""",
    """fg AS (SELECT user_id, item_id,
        max(CASE WHEN event_id = se AND action = 'seed' THEN 1 ELSE 0 END) AS init,
        sum(CASE WHEN action = 'like' AND (se IS NULL OR event_id > se) THEN 1 ELSE 0 END) AS nl,
        max(CASE WHEN event_id = le AND action = 'dislike' THEN 1 ELSE 0 END) AS dis
      FROM fs GROUP BY user_id, item_id)""",
    """fstate AS (SELECT user_id, item_id,
        CASE WHEN (init + nl) % 2 = 1 THEN 'liked' ELSE 'disliked' END AS state
      FROM fg WHERE (init + nl) % 2 = 1 OR dis = 1)""",
    """w1 AS (SELECT *,
        sum(CASE WHEN action = 'like' THEN 1 ELSE 0 END)
          OVER (PARTITION BY user_id, item_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS cuml,
        max(CASE WHEN action IN ('seed','dislike','remove') THEN event_id END)
          OVER (PARTITION BY user_id, item_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS anc
      FROM fa)""",
    """w2 AS (SELECT w1.*, x.action AS anc_action, coalesce(x.cuml, 0) AS anc_cuml
      FROM w1 LEFT JOIN w1 x ON x.user_id = w1.user_id AND x.item_id = w1.item_id AND x.event_id = w1.anc)""",
    """w3 AS (SELECT *, CASE WHEN anc_action = 'seed' THEN CASE WHEN (cuml - anc_cuml) % 2 = 0 THEN 1 ELSE 0 END
                          ELSE CASE WHEN (cuml - anc_cuml) % 2 = 1 THEN 1 ELSE 0 END END AS on_after
      FROM w2)""",
    """w4 AS (SELECT *, lag(on_after) OVER (PARTITION BY user_id, item_id ORDER BY event_id) AS on_before FROM w3)""",
    """fsince AS (SELECT user_id, item_id, max(event_id) AS since_event FROM w4
      WHERE on_after = 1 AND coalesce(on_before, 0) = 0 GROUP BY user_id, item_id)""",
    """prefs AS (SELECT s.user_id, s.item_id, s.state,
        CASE WHEN s.state = 'liked' THEN x.since_event END AS since_event
      FROM fstate s LEFT JOIN fsince x ON s.user_id = x.user_id AND s.item_id = x.item_id)""",
]

ORACLE["feedback_state"] = with_ctes(*FOLD_CTES, select="""
SELECT user_id, item_id, state, since_event FROM prefs""")

ORACLE["feedback_counts"] = with_ctes(*FOLD_CTES, select="""
SELECT user_id, count(*) FILTER (WHERE state = 'liked') AS likes,
       count(*) FILTER (WHERE state = 'disliked') AS dislikes
FROM prefs GROUP BY user_id""")

ORACLE["picks_newest_first"] = with_ctes(*FOLD_CTES, select="""
SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY since_event DESC, item_id) AS position,
       item_id, since_event
FROM prefs WHERE state = 'liked'""")

ORACLE["valid_prefs"] = with_ctes(*catalog_ctes(), *FOLD_CTES, select="""
SELECT user_id, item_id, state FROM prefs WHERE item_id IN (SELECT item_id FROM cat)""")


# ---- J9 - J12: profile scoring (brute-force backfill over users x catalogue) ----

def profile_ctes(k: int = 30) -> list[str]:
    return catalog_ctes(with_neighbours=True, k=k) + FOLD_CTES + [
        """vp AS (SELECT user_id, item_id, state FROM prefs WHERE item_id IN (SELECT item_id FROM cat))""",
        """lk AS (SELECT user_id, item_id FROM vp WHERE state = 'liked')""",
        """dk AS (SELECT user_id, item_id FROM vp WHERE state = 'disliked')""",
        """contrib AS (
  SELECT lk.user_id, nbc.neighbour_id AS item_id, lk.item_id AS source_id, nbc.sim
  FROM lk JOIN nbc ON lk.item_id = nbc.item_id
  WHERE NOT EXISTS (SELECT 1 FROM vp WHERE vp.user_id = lk.user_id AND vp.item_id = nbc.neighbour_id))""",
        """sc AS (
  SELECT user_id, item_id, sum(w) AS cf, sum(is_like) AS n_liked, sum(1 - is_like) AS n_disliked FROM (
    SELECT user_id, item_id, CAST(CAST(sim AS DECIMAL(18,6)) AS DECIMAL(24,8)) AS w, 1 AS is_like FROM contrib
    UNION ALL
    SELECT dk.user_id, nbc.neighbour_id, CAST(-(CAST(nbc.sim AS DECIMAL(18,6)) * 1.15) AS DECIMAL(24,8)), 0
    FROM dk JOIN nbc ON dk.item_id = nbc.item_id)
  GROUP BY user_id, item_id HAVING sum(is_like) > 0)""",
        """cg AS (SELECT item_id, unnest(genres) AS genre FROM cat)""",
        """gc AS (SELECT lk.user_id, cg.genre, count(*) AS cnt FROM lk JOIN cg ON lk.item_id = cg.item_id GROUP BY 1, 2)""",
        """gt AS (SELECT user_id, sum(cnt) AS total FROM gc GROUP BY 1)""",
        """popt AS (SELECT item_id,
    CAST(round(log10(n + 1) / log10((SELECT max(n) FROM cat) + 1), 6) AS DECIMAL(18,6)) AS pop6 FROM cat)""",
        """need AS (
  SELECT u.user_id, 12 - coalesce(h.cnt, 0) AS want
  FROM (SELECT DISTINCT user_id FROM lk) u
  LEFT JOIN (SELECT user_id, count(*) AS cnt FROM sc GROUP BY 1) h ON h.user_id = u.user_id
  WHERE 12 - coalesce(h.cnt, 0) > 0)""",
        """bfc AS (
  SELECT need.user_id, c.item_id FROM need JOIN cat c ON len(c.genres) > 0
  WHERE NOT EXISTS (SELECT 1 FROM sc WHERE sc.user_id = need.user_id AND sc.item_id = c.item_id)
    AND NOT EXISTS (SELECT 1 FROM vp WHERE vp.user_id = need.user_id AND vp.item_id = c.item_id)
    AND EXISTS (SELECT 1 FROM cg JOIN gc ON gc.genre = cg.genre
                WHERE cg.item_id = c.item_id AND gc.user_id = need.user_id))""",
        """gsc AS (
  SELECT x.user_id, x.item_id,
         CAST(round(CAST(coalesce(sum(gc.cnt), 0) AS DOUBLE) / CAST(coalesce(max(gt.total), 1) AS DOUBLE), 6)
              AS DECIMAL(18,6)) AS g6
  FROM (SELECT user_id, item_id FROM sc UNION ALL SELECT user_id, item_id FROM bfc) x
  LEFT JOIN cg ON cg.item_id = x.item_id
  LEFT JOIN gc ON gc.user_id = x.user_id AND gc.genre = cg.genre
  LEFT JOIN gt ON gt.user_id = x.user_id
  GROUP BY x.user_id, x.item_id)""",
        """cfr AS (
  SELECT sc.user_id, sc.item_id, sc.cf, gsc.g6, popt.pop6,
         sc.cf + 0.35 * gsc.g6 + 0.05 * popt.pop6 AS final, 0 AS genre_only
  FROM sc JOIN gsc ON gsc.user_id = sc.user_id AND gsc.item_id = sc.item_id
          JOIN popt ON popt.item_id = sc.item_id)""",
        """bfr AS (
  SELECT user_id, item_id, cf, g6, pop6, final, genre_only FROM (
    SELECT b.user_id, b.item_id, CAST(0 AS DECIMAL(24,8)) AS cf, gsc.g6, popt.pop6,
           0.35 * gsc.g6 + 0.05 * popt.pop6 AS final, 1 AS genre_only, need.want,
           row_number() OVER (PARTITION BY b.user_id ORDER BY 0.35 * gsc.g6 + 0.05 * popt.pop6 DESC, b.item_id) AS r
    FROM bfc b JOIN need ON need.user_id = b.user_id
    JOIN gsc ON gsc.user_id = b.user_id AND gsc.item_id = b.item_id
    JOIN popt ON popt.item_id = b.item_id)
  WHERE r <= want)""",
        """recs AS (
  SELECT *, max(final) OVER (PARTITION BY user_id) AS best FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY final DESC, item_id) AS rank
    FROM (SELECT * FROM cfr UNION ALL SELECT * FROM bfr)) WHERE rank <= 24)""",
    ]


RECS_SELECT = """
SELECT user_id, rank, item_id, CAST(cf AS DOUBLE) AS cf, CAST(g6 AS DOUBLE) AS genre_score,
       CAST(pop6 AS DOUBLE) AS pop, CAST(final AS DOUBLE) AS final,
       CASE WHEN CAST(best AS DOUBLE) > 0
            THEN least(greatest(CAST(floor(60.0 + 39.0 * (CAST(final AS DOUBLE) / CAST(best AS DOUBLE)) + 0.5)
                                     AS BIGINT), 58), 99)
            ELSE 58 END AS pct,
       CAST(genre_only AS BIGINT) AS genre_only
FROM recs"""

ORACLE["candidate_scores"] = with_ctes(*profile_ctes(), select="""
SELECT user_id, item_id, CAST(cf AS DOUBLE) AS cf, CAST(n_liked AS BIGINT) AS n_liked,
       CAST(n_disliked AS BIGINT) AS n_disliked FROM sc""")

ORACLE["genre_affinity"] = with_ctes(*profile_ctes(), select="""
SELECT gc.user_id, gc.genre, gc.cnt, round(CAST(gc.cnt AS DOUBLE) / CAST(gt.total AS DOUBLE), 6) AS aff
FROM gc JOIN gt ON gc.user_id = gt.user_id""")

ORACLE["taste_top3"] = with_ctes(*profile_ctes(), select="""
SELECT user_id, rank, genre, cnt FROM (
  SELECT gc.user_id, gc.genre, gc.cnt,
         row_number() OVER (PARTITION BY gc.user_id ORDER BY gc.cnt DESC, gd.genre_id) AS rank
  FROM gc JOIN gd ON gc.genre = gd.genre) WHERE rank <= 3""")

ORACLE["recommendations"] = with_ctes(*profile_ctes(), select=RECS_SELECT)

ORACLE["recommendations_backfill"] = with_ctes(*profile_ctes(k=5), select=RECS_SELECT)

ORACLE["recommendation_reasons"] = with_ctes(*profile_ctes(), """names AS (
  SELECT user_id, item_id, max(CASE WHEN k = 1 THEN title END) AS a, max(CASE WHEN k = 2 THEN title END) AS b
  FROM (SELECT c.user_id, c.item_id, t.title,
               row_number() OVER (PARTITION BY c.user_id, c.item_id ORDER BY c.sim DESC, c.source_id) AS k
        FROM contrib c JOIN cat t ON t.item_id = c.source_id
        WHERE t.title IS NOT NULL AND t.title <> ''
          AND EXISTS (SELECT 1 FROM recs WHERE recs.user_id = c.user_id AND recs.item_id = c.item_id))
  WHERE k <= 2 GROUP BY user_id, item_id)""", """tg AS (
  SELECT user_id, item_id, genre FROM (
    SELECT recs.user_id, recs.item_id, ig.genre,
           row_number() OVER (PARTITION BY recs.user_id, recs.item_id
                              ORDER BY coalesce(gc.cnt, 0) DESC, ig.position) AS k
    FROM recs JOIN ig ON ig.item_id = recs.item_id
    LEFT JOIN gc ON gc.user_id = recs.user_id AND gc.genre = ig.genre) WHERE k = 1)""", select="""
SELECT recs.user_id, recs.item_id,
       CASE WHEN names.b IS NOT NULL THEN 'Loved by fans of ' || names.a || ' & ' || names.b
            WHEN names.a IS NOT NULL THEN 'Because you liked ' || names.a
            ELSE 'A ' || coalesce(tg.genre, 'great') || ' pick in your wheelhouse' END AS reason
FROM recs LEFT JOIN names ON names.user_id = recs.user_id AND names.item_id = recs.item_id
LEFT JOIN tg ON tg.user_id = recs.user_id AND tg.item_id = recs.item_id""")


# ---- I1, J6, J7, J14 ----------------------------------------------------------

SPLIT_CTES = [
    """sp AS (SELECT r.*, CASE WHEN substr(md5(concat(CAST(user_id AS VARCHAR), ':', CAST(item_id AS VARCHAR), ':0')), 1, 2) < 'cd'
                          THEN 'train' ELSE 'test' END AS split FROM r)""",
    """tr AS (SELECT * FROM sp WHERE split = 'train')""",
    """te AS (SELECT * FROM sp WHERE split = 'test')""",
]


def cf_ctes(name: str = "cfp", sims: str = "pt", upper: bool = False, ties_rank: bool = False,
            signed: bool = False) -> list[str]:
    if upper:
        nb = f"""{name}_nb AS (SELECT i AS item_id, j AS neighbour_id, CAST(round(sim, 6) AS DECIMAL(18,6)) AS sim FROM {sims})"""
    else:
        nb = f"""{name}_nb AS (
  SELECT i AS item_id, j AS neighbour_id, CAST(round(sim, 6) AS DECIMAL(18,6)) AS sim FROM {sims}
  UNION ALL SELECT j, i, CAST(round(sim, 6) AS DECIMAL(18,6)) FROM {sims})"""
    ranker = "rank() OVER (PARTITION BY user_id, item_id ORDER BY sim DESC)" if ties_rank else \
        "row_number() OVER (PARTITION BY user_id, item_id ORDER BY sim DESC, neighbour_id)"
    den = "sum(sim)" if signed else "sum(abs(sim))"
    cond = f"{den} <> 0" if signed else f"{den} > 0"
    return [nb, f"""{name}_rows AS (
  SELECT t.user_id, t.item_id, x.item_id AS neighbour_id, CAST(x.rating AS DECIMAL(10,4)) AS nr, n.sim
  FROM (SELECT DISTINCT user_id, item_id FROM te) t JOIN tr x ON t.user_id = x.user_id
  JOIN {name}_nb n ON n.item_id = t.item_id AND n.neighbour_id = x.item_id
  WHERE x.item_id <> t.item_id)""", f"""{name}_top AS (
  SELECT * FROM (SELECT *, {ranker} AS k FROM {name}_rows) WHERE k <= 10)""", f"""{name} AS (
  SELECT user_id, item_id,
         CASE WHEN {cond} THEN CAST(sum(sim * nr) AS DOUBLE) / CAST({den} AS DOUBLE) END AS prediction,
         count(*) AS n_neighbours
  FROM {name}_top GROUP BY user_id, item_id)"""]


ORACLE["hash_split"] = with_ctes(*SPLIT_CTES, select="SELECT user_id, item_id, rating, split FROM sp")

ORACLE["item_cf_predictions"] = with_ctes(*SPLIT_CTES, *pair_cte("pt", source="tr"), *cf_ctes(), select="""
SELECT user_id, item_id, round(prediction, 6) AS prediction, n_neighbours FROM cfp WHERE prediction IS NOT NULL""")

ORACLE["item_cf_predictions_as_written"] = with_ctes(
    *SPLIT_CTES, *pair_cte("p"), *cf_ctes(sims="p", upper=True, ties_rank=True, signed=True), select="""
SELECT user_id, item_id, round(prediction, 6) AS prediction, n_neighbours FROM cfp WHERE prediction IS NOT NULL""")

COMPONENT_CTES = [
    """c_item AS (SELECT te.user_id, te.item_id, CAST(round(m.mu, 6) AS DECIMAL(20,6)) AS p FROM te
  JOIN (SELECT item_id, sum(rating) / count(*) AS mu FROM tr GROUP BY 1) m ON m.item_id = te.item_id)""",
    """c_user AS (SELECT te.user_id, te.item_id, CAST(round(m.mu, 6) AS DECIMAL(20,6)) AS p FROM te
  JOIN (SELECT user_id, sum(rating) / count(*) AS mu FROM tr GROUP BY 1) m ON m.user_id = te.user_id)""",
    """c_cf AS (SELECT user_id, item_id, CAST(round(prediction, 6) AS DECIMAL(20,6)) AS p FROM cfp
  WHERE prediction IS NOT NULL)""",
]

ORACLE["blend_equal"] = with_ctes(*SPLIT_CTES, *pair_cte("pt", source="tr"), *cf_ctes(), *COMPONENT_CTES, select="""
SELECT a.user_id, a.item_id, CAST(a.p AS DOUBLE) AS item_mean_prediction, CAST(b.p AS DOUBLE) AS cf_prediction,
       CAST(0.5 * a.p + 0.5 * b.p AS DOUBLE) AS hybrid_prediction, te.rating AS actual_rating
FROM c_item a JOIN c_cf b ON a.user_id = b.user_id AND a.item_id = b.item_id
JOIN te ON te.user_id = a.user_id AND te.item_id = a.item_id""")

ORACLE["blend_weight_search"] = with_ctes(*SPLIT_CTES, *pair_cte("pt", source="tr"), *cf_ctes(), *COMPONENT_CTES, """w AS (
  SELECT * FROM (VALUES (0, 0.2, 0.3, 0.5), (1, 0.3, 0.3, 0.4), (2, 0.4, 0.3, 0.3)) AS t(weight_id, w1, w2, w3))""",
    """j AS (SELECT a.p AS pa, b.p AS pb, c.p AS pc, CAST(te.rating AS DECIMAL(20,6)) AS y
  FROM c_item a JOIN c_cf b ON a.user_id = b.user_id AND a.item_id = b.item_id
  JOIN c_user c ON c.user_id = a.user_id AND c.item_id = a.item_id
  JOIN te ON te.user_id = a.user_id AND te.item_id = a.item_id)""",
    """s AS (SELECT w.weight_id, w.w1, w.w2, w.w3, count(*) AS n,
         sum(CAST(w.w1 * j.pa + w.w2 * j.pb + w.w3 * j.pc - j.y AS DECIMAL(12,7)) *
             CAST(w.w1 * j.pa + w.w2 * j.pb + w.w3 * j.pc - j.y AS DECIMAL(12,7))) AS sse
  FROM j CROSS JOIN w GROUP BY 1, 2, 3, 4)""", select="""
SELECT CAST(weight_id AS BIGINT) AS weight_id, CAST(w1 AS DOUBLE) AS w_item_mean, CAST(w2 AS DOUBLE) AS w_cf,
       CAST(w3 AS DOUBLE) AS w_user_mean, round(sqrt(CAST(sse AS DOUBLE) / CAST(n AS DOUBLE)), 6) AS rmse,
       CAST(n AS BIGINT) AS n,
       CAST(CASE WHEN row_number() OVER (ORDER BY sqrt(CAST(sse AS DOUBLE) / CAST(n AS DOUBLE)), weight_id) = 1
                 THEN 1 ELSE 0 END AS BIGINT) AS best
FROM s""")

_METRIC_ROWS = """
  SELECT 'rmse' AS metric, sqrt(mse) AS value, detail FROM agg UNION ALL
  SELECT 'mse', mse, detail FROM agg UNION ALL
  SELECT 'n', CAST(n AS DOUBLE), detail FROM agg UNION ALL
  SELECT 'coverage', CAST(n AS DOUBLE) / CAST((SELECT count(*) FROM te) AS DOUBLE), detail FROM agg"""

ORACLE["rating_metrics"] = with_ctes(*SPLIT_CTES, *pair_cte("pt", source="tr"), *cf_ctes(), """e AS (
  SELECT CAST(CAST(round(c.prediction, 6) AS DECIMAL(20,6)) - CAST(te.rating AS DECIMAL(20,6)) AS DECIMAL(12,6)) AS e0,
         CAST(CAST(round(least(greatest(c.prediction, 1.0), 5.0), 6) AS DECIMAL(20,6))
              - CAST(te.rating AS DECIMAL(20,6)) AS DECIMAL(12,6)) AS e1
  FROM cfp c JOIN te ON te.user_id = c.user_id AND te.item_id = c.item_id WHERE c.prediction IS NOT NULL)""",
    """agg AS (
  SELECT 'item_cf' AS detail, count(*) AS n, CAST(sum(e0 * e0) AS DOUBLE) / CAST(count(*) AS DOUBLE) AS mse FROM e
  UNION ALL
  SELECT 'item_cf, clamped to [1.0, 5.0]', count(*), CAST(sum(e1 * e1) AS DOUBLE) / CAST(count(*) AS DOUBLE) FROM e)""",
    select=f"SELECT metric, round(value, 6) AS value, detail FROM ({_METRIC_ROWS})")

ORACLE["ranking_map"] = with_ctes(*SPLIT_CTES, *pair_cte("pt", source="tr", min_item=8), shrunk_cte("pts", "pt"),
                                  *neighbour_cte("nbt", "pts"), """cand AS (
  SELECT x.user_id, n.neighbour_id AS item_id, sum(CAST(n.sim AS DECIMAL(18,6))) AS score
  FROM tr x JOIN nbt n ON n.item_id = x.item_id
  WHERE NOT EXISTS (SELECT 1 FROM tr y WHERE y.user_id = x.user_id AND y.item_id = n.neighbour_id)
  GROUP BY 1, 2)""", """pl AS (
  SELECT * FROM (SELECT user_id, item_id, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
                 FROM cand) WHERE rank <= 10)""", """hits AS (
  SELECT pl.user_id, pl.rank, CASE WHEN te.item_id IS NULL THEN 0 ELSE 1 END AS hit
  FROM pl LEFT JOIN te ON te.user_id = pl.user_id AND te.item_id = pl.item_id)""", """cum AS (
  SELECT *, sum(hit) OVER (PARTITION BY user_id ORDER BY rank ROWS UNBOUNDED PRECEDING) AS c FROM hits)""",
    """aps AS (SELECT user_id, sum(CASE WHEN hit = 1 THEN CAST(c AS DOUBLE) / rank ELSE 0.0 END) AS ps
  FROM cum GROUP BY 1)""", """nrel AS (SELECT user_id, count(*) AS n_rel FROM te GROUP BY 1)""", select="""
SELECT round(avg(ps / n_rel), 6) AS map, count(*) AS users FROM aps JOIN nrel ON aps.user_id = nrel.user_id""")


# ---- I9, I11: genre index (StringIndexer order) and multi-hot coordinates ----

ORACLE["genre_index"] = with_ctes(*catalog_ctes(), select="""
SELECT genre, CAST(row_number() OVER (ORDER BY cnt DESC, genre) - 1 AS BIGINT) AS genre_index, cnt
FROM (SELECT genre, count(*) AS cnt FROM ig GROUP BY genre)""")

ORACLE["item_multihot"] = with_ctes(*catalog_ctes(), """gix AS (
  SELECT genre, row_number() OVER (ORDER BY cnt DESC, genre) - 1 AS genre_index
  FROM (SELECT genre, count(*) AS cnt FROM ig GROUP BY genre))""", select="""
SELECT DISTINCT ig.item_id, CAST(gix.genre_index AS BIGINT) AS genre_index, 1.0::DOUBLE AS value
FROM ig JOIN gix ON ig.genre = gix.genre""")

ORACLE["als_folds"] = with_ctes(*SPLIT_CTES, select="""
SELECT user_id, item_id,
       CAST('0x' || substr(md5(concat(CAST(user_id AS VARCHAR), ':', CAST(item_id AS VARCHAR), ':fold')), 1, 8) AS BIGINT) % 3 AS fold
FROM tr""")

ORACLE["als_topk_by_bounds"] = with_ctes(*SPLIT_CTES, select="""
SELECT user_id, least(10, (SELECT count(DISTINCT item_id) FROM tr)) AS n, true AS same FROM tr GROUP BY user_id""")

ORACLE["ratings_csv_checked"] = with_ctes(select="""
SELECT CASE WHEN rating IN (0.5, 1.0, 2.0) THEN 'malformed' WHEN rating = 1.5 THEN 'no user_id' ELSE 'accepted' END AS reason,
       count(*) AS n
FROM r GROUP BY 1""")

ORACLE["genre_encoder_vectors"] = ORACLE["item_multihot"]

ORACLE["forest_reloaded"] = with_ctes(*SPLIT_CTES, select="""
SELECT user_id, item_id, true AS same FROM te WHERE item_id IN (SELECT item_id FROM items)""")

# the split of the train ratings by one genre that leaves the least squared error, and its two means
ORACLE["forest_stump"] = with_ctes(*SPLIT_CTES, *catalog_ctes(), """lst AS (SELECT DISTINCT item_id, genre FROM ig)""",
    """known AS (SELECT tr.item_id, tr.r2 FROM tr WHERE item_id IN (SELECT item_id FROM items))""",
    """whole AS (SELECT count(*) AS n, sum(r2) AS s FROM known)""",
    """sides AS (SELECT genre, count(*) AS n1, sum(r2) AS s1 FROM known JOIN lst USING (item_id) GROUP BY genre)""",
    """best AS (SELECT genre, s1 / n1 / 2.0 AS with_it, (s - s1) / (n - n1) / 2.0 AS without_it FROM sides, whole
  WHERE n1 < n ORDER BY s1 * s1 / n1 + (s - s1) * (s - s1) / (n - n1) DESC, genre LIMIT 1)""", select="""
SELECT te.user_id, te.item_id, round(CAST(CASE WHEN lst.item_id IS NOT NULL THEN with_it ELSE without_it END AS DOUBLE), 6) AS prediction
FROM te JOIN items ON te.item_id = items.item_id CROSS JOIN best
LEFT JOIN lst ON lst.item_id = te.item_id AND lst.genre = best.genre""")

# K2 / K3: the stream ends in the batch results
ORACLE["feedback_stream"] = ORACLE["feedback_state"]
ORACLE["feedback_stream_recommendations"] = ORACLE["recommendations"]


ORACLE["profile_summary"] = with_ctes(*profile_ctes(), select="""
SELECT c.user_id, c.likes, c.dislikes, CAST(coalesce(x.matches, 0) AS BIGINT) AS matches
FROM (SELECT user_id, count(*) FILTER (WHERE state = 'liked') AS likes,
             count(*) FILTER (WHERE state = 'disliked') AS dislikes FROM vp GROUP BY user_id) c
LEFT JOIN (SELECT user_id, count(*) AS matches FROM recs GROUP BY user_id) x ON x.user_id = c.user_id""")

ORACLE["similar_items_for_item"] = with_ctes(*pair_cte("p"), select="""
SELECT CAST(1 AS BIGINT) AS item_id, CASE WHEN i = 1 THEN j ELSE i END AS neighbour_id, c AS n_common,
       round(sim, 6) AS sim
FROM p WHERE i = 1 OR j = 1
ORDER BY round(sim, 6) DESC, CASE WHEN i = 1 THEN j ELSE i END LIMIT 5""")


ORACLE["candidate_pairs"] = with_ctes(*SPLIT_CTES, select="SELECT DISTINCT user_id, item_id FROM te")

ORACLE["pair_similarity_parts"] = with_ctes("""rp AS (
  SELECT user_id, item_id, r2 FROM (
    SELECT o_custkey AS user_id, l_partkey AS item_id, CAST(ceil(l_quantity / 5.0) AS BIGINT) AS r2,
           row_number() OVER (PARTITION BY o_custkey, l_partkey ORDER BY l_shipdate DESC, l_orderkey DESC,
                              l_linenumber DESC, l_quantity DESC, l_extendedprice DESC) AS rn
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE rn = 1)""",
    *pair_cte("p", source="rp"), shrunk_cte("ps", "p", min_common=3), select="""
SELECT i AS item_i, j AS item_j, c AS n_common, round(sim, 6) AS sim FROM ps""")

# ---- through files and back ---------------------------------------------------------

ORACLE["ratings_csv"] = with_ctes(select="SELECT user_id, item_id, rating FROM r")
ORACLE["items_csv"] = with_ctes(select="SELECT item_id, title, genres FROM items")
ORACLE["links_csv"] = with_ctes(select="SELECT item_id, imdb, tmdb FROM links")
ORACLE["metrics_csv"] = ORACLE["rating_metrics"]
ORACLE["artefact_neighbours"] = ("SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY rank) AS BIGINT) "
                                 "AS place, neighbour_id, sim FROM (" + ORACLE["neighbours_in_catalog"] + ")")

# ---- facts about the MLlib models' outputs -----------------------------------------

ORACLE["als_prediction_pairs"] = with_ctes(*SPLIT_CTES, select="""
SELECT user_id, item_id, true AS not_negative FROM te
WHERE user_id IN (SELECT user_id FROM tr) AND item_id IN (SELECT item_id FROM tr)""")

ORACLE["als_topk_lists"] = with_ctes(*SPLIT_CTES, select="""
SELECT user_id, CAST(least(10, (SELECT count(DISTINCT item_id) FROM tr) - count(*)) AS BIGINT) AS n,
       true AS ranked, true AS falling, CAST(0 AS BIGINT) AS seen
FROM tr GROUP BY user_id HAVING count(*) < (SELECT count(DISTINCT item_id) FROM tr)""")

ORACLE["als_grid_points"] = """
SELECT CAST(rank AS BIGINT) AS rank, CAST(max_iter AS BIGINT) AS max_iter, CAST(0.17 AS DOUBLE) AS reg_param,
       true AS positive, true AS best_is_least, CAST(1 AS BIGINT) AS n_best
FROM (VALUES (5, 6), (5, 12), (10, 6), (10, 12)) AS g(rank, max_iter)
WHERE (SELECT count(*) FROM lineitem) > 0"""

ORACLE["forest_prediction_pairs"] = with_ctes(*SPLIT_CTES, select="""
SELECT user_id, item_id, true AS in_range FROM te WHERE item_id IN (SELECT item_id FROM items)""")

ORACLE["metrics_report_counts"] = with_ctes(*SPLIT_CTES, *pair_cte("pt", source="tr"), *cf_ctes(), """known AS (
  SELECT user_id, item_id FROM te
  WHERE user_id IN (SELECT user_id FROM tr) AND item_id IN (SELECT item_id FROM tr))""",
    """cfn AS (SELECT user_id, item_id FROM cfp WHERE prediction IS NOT NULL)""",
    """both_ AS (SELECT k.user_id, k.item_id FROM known k JOIN cfn c ON c.user_id = k.user_id AND c.item_id = k.item_id)""",
    """counts AS (SELECT (SELECT count(*) FROM known) AS als, (SELECT count(*) FROM cfn) AS cf,
  (SELECT count(*) FROM both_) AS hybrid,
  (SELECT count(*) FROM both_ WHERE item_id IN (SELECT item_id FROM items)) AS best)""", select="""
SELECT metric, has_value, n FROM counts, LATERAL (VALUES
  ('ALS RMSE', true, CAST(als AS VARCHAR)), ('ALS MSE', true, CAST(als AS VARCHAR)), ('ALS MAP', true, ''),
  ('Best Model Rank', true, ''), ('Best Model MaxIter', true, ''), ('Best Model RegParam', true, ''),
  ('Item CF RMSE', true, CAST(cf AS VARCHAR)), ('Hybrid Model RMSE', true, CAST(hybrid AS VARCHAR)),
  ('Best Hybrid Model RMSE', true, CAST(best AS VARCHAR)), ('Best Weights', false, '')) AS t(metric, has_value, n)""")
