"""Feedback fold: ordered like / seed / dislike / remove / clear events -> the
current preference state per (user, item).

Event rules (applied in event order per user):
  like     toggle the like; also clears a dislike
  seed     set the like (a like already set keeps its place), clear the dislike
  dislike  clear the like, set the dislike
  remove   clear the like only
  clear    clear likes and dislikes of every item of the user

One associative aggregate. An item of a user is neutral, liked (since some event) or
disliked, so a run of events is a function on three states: for each of them it tells which
state follows, and since when (``since`` stays null where a like from before the run
is kept). Such functions (transitions) compose, and composition is associative, so events
are composed in parts and the parts in order:

1. events of one user whose ids fall in one interval of ``width`` ids become one transition
   per item. The group is bounded by the interval, whatever the user's share of all events;
   a repeated event counts once; a clear in the interval voids what came before it there.
2. transitions of intervals before the user's last clear are void (one row for each user who
   cleared is joined to the transitions).
3. the transitions of a (user, item) are composed in interval order, in levels of bounded
   size, within one partitioning by (user, item).

``since_event`` of a liked item is the event that started its current liked run
(the like list's insertion order, newest last). The events are never joined with an
aggregate of theirs, and there is no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY = ["user_id", "item_id"]
ACTIONS = ("like", "seed", "dislike", "remove", "clear")
WIDTH = 1 << 16  # event ids of an interval
LEVELS = (1 << 20,)  # intervals composed at once: at most so many rows in a group of a level

NEUTRAL, LIKED, DISLIKED = 0, 1, 2
#: what follows from each starting state; ``since`` is null where an earlier like is kept
TRANSITION = "struct<n:int,n_since:bigint,l:int,l_since:bigint,d:int,d_since:bigint>"


def valid_events(events: DataFrame) -> DataFrame:
    """Events that can change a state: one without a user or id, with an unknown action, or a
    per-item action without an item cannot. A clear needs no item."""
    return (events.select("event_id", "user_id", "item_id", "action")
            .where(F.col("user_id").isNotNull() & F.col("event_id").isNotNull() & F.col("action").isin(*ACTIONS)
                   & (F.col("item_id").isNotNull() | (F.col("action") == "clear"))))


def interval_of(width: int) -> Column:
    """First id of the interval that holds the event."""
    return F.col("event_id") - F.pmod(F.col("event_id"), F.lit(width).cast("long"))


def _after(event: Column, state: Column, since: Column) -> tuple[Column, Column]:
    """State and since after one event."""
    action, was_liked = event["action"], state == LIKED
    then = (F.when(action == "like", F.when(was_liked, NEUTRAL).otherwise(LIKED))
            .when(action == "seed", LIKED).when(action == "dislike", DISLIKED)
            .otherwise(F.when(state == DISLIKED, DISLIKED).otherwise(NEUTRAL)))
    kept = F.when((action == "seed") & was_liked, since).when(then == LIKED, event["event_id"])
    return then, kept


def _struct(parts: list[tuple[Column, Column]]) -> Column:
    return F.struct(*[c.alias(name) for name, pair in zip("nld", parts, strict=True)
                      for name, c in ((name, pair[0]), (f"{name}_since", pair[1]))]).cast(TRANSITION)


def _identity() -> Column:
    null = F.lit(None).cast("long")
    return _struct([(F.lit(s), null) for s in (NEUTRAL, LIKED, DISLIKED)])


def _reset() -> Column:
    null = F.lit(None).cast("long")
    return _struct([(F.lit(NEUTRAL), null)] * 3)


def _composed(first: Column, then: Column) -> Column:
    """``first``, then ``then``."""
    parts = []
    for name in "nld":
        state, since = first[name], first[f"{name}_since"]
        follows = F.when(state == NEUTRAL, then["n"]).when(state == LIKED, then["l"]).otherwise(then["d"])
        # a like that goes on through ``then`` keeps its since
        new = (F.when(state == NEUTRAL, then["n_since"]).when(state == LIKED, F.coalesce(then["l_since"], since))
               .otherwise(then["d_since"]))
        parts.append((follows, F.when(follows == LIKED, new)))
    return _struct(parts)


def interval_transitions(events: DataFrame, width: int = WIDTH) -> DataFrame:
    """user_id, interval, item_id, t: one transition for each item that a user touched in an interval."""
    ev = valid_events(events).withColumn("interval", interval_of(width))
    own = (ev.groupBy("user_id", "interval")
           .agg(F.collect_set(F.struct("event_id", "action", "item_id")).alias("events"))
           .withColumn("clear_id", F.array_max(F.transform(F.filter("events", lambda e: e["action"] == "clear"),
                                                           lambda e: e["event_id"]))))
    # the groups stay where they are: (user, interval, item) lies within (user, interval)
    one = own.select("user_id", "interval", "clear_id", F.explode("events").alias("e"))
    by_item = (one.where(F.col("e.action") != "clear")
               .groupBy("user_id", "interval", F.col("e.item_id").alias("item_id"))
               .agg(F.array_sort(F.collect_list(F.struct("e.event_id", "e.action"))).alias("run"),
                    F.max("clear_id").alias("clear_id")))
    left = F.when(F.col("clear_id").isNull(), F.col("run")).otherwise(
        F.filter("run", lambda e: e["event_id"] > F.col("clear_id")))
    start = F.when(F.col("clear_id").isNull(), _identity()).otherwise(_reset())
    step = lambda t, e: _struct([_after(e, t[n], t[f"{n}_since"]) for n in "nld"])
    return by_item.select("user_id", "interval", "item_id", F.aggregate(left, start, step).alias("t"))


def last_clears(events: DataFrame, width: int = WIDTH) -> DataFrame:
    """user_id, last_clear: the interval of the last clear of each user who cleared."""
    return (valid_events(events).where(F.col("action") == "clear")
            .groupBy("user_id").agg(F.max(interval_of(width)).alias("last_clear")))


def merged_preferences(transitions: DataFrame, clears: DataFrame, width: int = WIDTH) -> DataFrame:
    """user_id, item_id, state ('liked' | 'disliked'), since_event (liked rows) from one transition
    for each user, interval and item, and the users' last clears."""
    # transitions of the clear's own interval know of it already
    rows = (transitions.join(clears, "user_id", "left")
            .where(F.col("last_clear").isNull() | (F.col("interval") >= F.col("last_clear")))
            .select("user_id", "item_id", "interval", "t").repartition(*KEY))

    def composed(df: DataFrame, keys: list[str]) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct("interval", "t")))
        return df.groupBy(*keys).agg(F.aggregate(ordered, _identity(), lambda t, x: _composed(t, x["t"])).alias("t"))

    span = width
    for most in LEVELS:
        span *= most
        wider = F.col("interval") - F.pmod(F.col("interval"), F.lit(span).cast("long"))
        rows = composed(rows.withColumn("wider", wider), [*KEY, "wider"]).withColumnRenamed("wider", "interval")
    last = composed(rows, KEY)
    return (last.where(F.col("t.n") != NEUTRAL)
            .select(*KEY, F.when(F.col("t.n") == LIKED, "liked").otherwise("disliked").alias("state"),
                    F.col("t.n_since").alias("since_event")))


def fold_feedback(events: DataFrame, *, heavy_key: int = WIDTH) -> DataFrame:
    """user_id, item_id, state ('liked' | 'disliked'), since_event (liked rows). ``heavy_key``: event ids
    of an interval, so at most so many events of a user are composed in one group."""
    return merged_preferences(interval_transitions(events, heavy_key), last_clears(events, heavy_key), heavy_key)


def fold_feedback_simple(events: DataFrame) -> DataFrame:
    """The state alone (no insertion position)."""
    return fold_feedback(events).drop("since_event")


def preference_counts(prefs: DataFrame) -> DataFrame:
    """user_id, likes, dislikes."""
    return prefs.groupBy("user_id").agg(
        F.count_if(F.col("state") == "liked").alias("likes"),
        F.count_if(F.col("state") == "disliked").alias("dislikes"))


def picks_newest_first(prefs: DataFrame) -> DataFrame:
    """user_id, position (1 = newest), item_id, since_event of the liked items.

    A user's like list has no size bound, so the positions come from one
    distributed sort of all liked rows (user, newest first) and a per-user
    offset, not from a per-user window."""
    from tastegraph.functions.numbering import number_rows

    liked = prefs.where(F.col("state") == "liked").select("user_id", "item_id", "since_event")
    numbered = number_rows(liked, [F.col("user_id").asc(), F.col("since_event").desc(),
                                   F.col("item_id").asc()], "_g")
    first = numbered.groupBy("user_id").agg(F.min("_g").alias("_g0"))
    return numbered.join(first, "user_id").select(
        "user_id", (F.col("_g") - F.col("_g0") + 1).cast("int").alias("position"), "item_id", "since_event")


def valid_prefs(prefs: DataFrame, catalog: DataFrame) -> DataFrame:
    """Preferences whose item is still in the catalogue (semi-join)."""
    return prefs.join(catalog.select("item_id"), "item_id", "left_semi")
