"""The fold against a brute-force replay, and the stream against the batch fold
for several micro-batch cuts and a restart from the checkpoint."""

import os

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tastegraph.operators import feedback as FB
from tastegraph.sources import fixtures as fx
from tastegraph.streaming import feedback_stream as FS

from .conftest import SF_MID, SF_SMALL


def brute_force(events: pd.DataFrame) -> dict:
    users = {}
    for eid, u, item, action in events.sort_values("event_id")[["event_id", "user_id", "item_id", "action"]] \
            .itertuples(index=False):
        users[u] = FS._apply(users.get(u, {}), int(eid), int(item), action)
    out = {}
    for u, cur in users.items():
        for i, (liked, dis, since) in cur.items():
            if liked:
                out[(u, i)] = ("liked", since)
            elif dis:
                out[(u, i)] = ("disliked", None)
    return out


def as_dict(df):
    return {(r.user_id, r.item_id): (r.state, r.since_event) for r in df.collect()}


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_fold_equals_brute_force(spark, sf):
    ev = fx.feedback(spark, sf)
    assert as_dict(FB.fold_feedback(ev)) == brute_force(ev.toPandas())


def test_hand_sequences(spark):
    rows = [  # (event_id, user, item, action)
        (1, 1, 10, "like"), (2, 1, 10, "like"), (3, 1, 10, "like"),            # on, off, on -> since 3
        (4, 1, 11, "seed"), (5, 1, 11, "seed"),                                # seed twice keeps 4
        (6, 1, 12, "like"), (7, 1, 12, "dislike"),                             # disliked
        (8, 1, 13, "dislike"), (9, 1, 13, "remove"),                           # remove keeps the dislike
        (10, 1, 14, "like"), (11, 1, 14, "seed"), (12, 1, 14, "like"), (13, 1, 14, "like"),  # since 13
        (14, 2, 10, "like"), (15, 2, 11, "dislike"), (16, 2, 10, "clear"), (17, 2, 12, "like"),
        (18, 3, 10, "dislike"), (19, 3, 10, "like"),                           # like clears the dislike
        (20, 4, 10, "like"), (21, 4, 10, "seed"),                              # seed on a like keeps 20
    ]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, item_id long, action string")
    got = as_dict(FB.fold_feedback(ev))
    assert got == {(1, 10): ("liked", 3), (1, 11): ("liked", 4), (1, 12): ("disliked", None),
                   (1, 13): ("disliked", None), (1, 14): ("liked", 13), (2, 12): ("liked", 17),
                   (3, 10): ("liked", 19), (4, 10): ("liked", 20)}
    simple = {(r.user_id, r.item_id): r.state for r in FB.fold_feedback_simple(ev).collect()}
    assert simple == {k: v[0] for k, v in got.items()}


def write_event_files(spark, n_files, folder):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").toPandas().sort_values("event_id")
    chunks = [ev.iloc[i::n_files] for i in range(n_files)] if n_files == 1 else \
        [ev[(ev.event_id * n_files // (ev.event_id.max() + 1)) == k] for k in range(n_files)]
    base = 1_700_000_000
    for k, c in enumerate(chunks):
        path = os.path.join(folder, f"events-{k:03d}.parquet")
        c.to_parquet(path, index=False)
        # files arrive in event order: the file source takes them by modification time
        os.utime(path, (base + k, base + k))
    return ev


@pytest.mark.parametrize("n_files", [1, 3, 7])
def test_stream_equals_batch(spark, scratch, n_files):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    write_event_files(spark, n_files, src)
    cur = FS.run_feedback_stream(spark, src, **{**fx.stream_options(), "glob": "events-*.parquet"}, max_files=1)
    batch = FB.fold_feedback(fx.feedback(spark, SF_SMALL))
    assert as_dict(cur) == as_dict(batch)


def test_stream_restart_and_replay(spark, scratch):
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet").toPandas().sort_values("event_id")
    half = len(ev) // 2
    ev.iloc[:half].to_parquet(os.path.join(src, "events-000.parquet"), index=False)
    os.utime(os.path.join(src, "events-000.parquet"), (1_700_000_000, 1_700_000_000))
    sink, ck = os.path.join(scratch, "sink"), os.path.join(scratch, "ck")
    FS.run_feedback_stream(spark, src, **{**fx.stream_options(), "glob": "events-*.parquet"}, sink=sink, checkpoint=ck)
    # second half plus a replay of already applied events, after a restart from the checkpoint
    pd.concat([ev.iloc[half:], ev.iloc[half - 50:half]]).to_parquet(
        os.path.join(src, "events-001.parquet"), index=False)
    cur = FS.run_feedback_stream(spark, src, **{**fx.stream_options(), "glob": "events-*.parquet"}, sink=sink, checkpoint=ck)
    batch = FB.fold_feedback(fx.feedback(spark, SF_SMALL))
    assert as_dict(cur) == as_dict(batch)
    # the 50 replayed events were dropped and counted per user
    stats = FS.stream_stats(spark, sink).toPandas()
    replayed = ev.iloc[half - 50:half]
    assert stats.late_events.sum() == len(replayed)
    compacted = FS.compact(spark, sink)
    assert compacted.where("item_id is not null").count() == batch.count()
    assert as_dict(FS.current_preferences(spark, sink)) == as_dict(batch)  # read from the compacted table
    assert "_compact" in "".join(FS.current_preferences(spark, sink).inputFiles())
    # events after the compaction are read on top of it
    more = pd.DataFrame({"event_id": [10 ** 9], "ts": [ev.ts.iloc[0]], "user_id": [ev.user_id.iloc[0]],
                         "event_type": ["purchase"], "value": [0.0], "props": ['{"k": 77}']}).astype(ev.dtypes.to_dict())
    more.to_parquet(os.path.join(src, "events-002.parquet"), index=False)
    later = FS.run_feedback_stream(spark, src, **{**fx.stream_options(), "glob": "events-*.parquet"}, sink=sink,
                                   checkpoint=ck)
    assert as_dict(later)[(ev.user_id.iloc[0], 77)] == ("liked", 10 ** 9)


def test_fold_random_sequences(spark):
    """Random event sequences over few users and items (many repeats, toggles,
    clears): the aggregate fold equals the replay."""
    from hypothesis import HealthCheck, given, settings
    from hypothesis import strategies as st

    actions = st.sampled_from(["like", "like", "seed", "dislike", "remove", "clear"])
    seqs = st.lists(st.tuples(st.integers(1, 3), st.integers(1, 4), actions), min_size=1, max_size=60)

    collected = []

    @settings(max_examples=25, deadline=None, suppress_health_check=list(HealthCheck))
    @given(seqs)
    def gen(seq):
        collected.append(seq)

    gen()
    rows = []
    for case, seq in enumerate(collected):
        for k, (u, i, a) in enumerate(seq):
            rows.append((k + 1, case * 10 + u, i, a))
    ev = spark.createDataFrame(rows, "event_id long, user_id long, item_id long, action string")
    assert as_dict(FB.fold_feedback(ev)) == brute_force(ev.toPandas())


def test_dirty_events_change_nothing(spark, scratch):
    rows = [(1, 1, 10, "like"), (2, 1, None, "like"), (3, 1, 11, "bogus"), (4, 1, None, "clear"),
            (5, 1, 12, "seed"), (6, None, 12, "like")]
    ev = spark.createDataFrame(rows, "event_id long, user_id long, item_id long, action string")
    assert as_dict(FB.fold_feedback(ev)) == {(1, 12): ("liked", 5)}


def test_salted_hot_keys_fold_alike(spark):
    """One user with a third of the events and one hot (user, item) key, salted."""
    ev = fx.feedback(spark, SF_SMALL).select("event_id", "user_id", "item_id", "action")
    hot = ev.select("event_id", F.when(F.col("event_id") % 3 == 0, 7).otherwise(F.col("user_id")).alias("user_id"),
                    F.when(F.col("event_id") % 6 == 0, 1).otherwise(F.col("item_id")).alias("item_id"), "action")
    assert as_dict(FB.fold_feedback(hot, heavy_key=5)) == as_dict(FB.fold_feedback(hot)) == brute_force(hot.toPandas())


def hot_events(n=1200, seed=3):
    """Events of a few users and items, a third of them of one user, one third of those of one item."""
    import random

    rng = random.Random(seed)
    rows = []
    for k in range(n):
        user = 7 if k % 3 == 0 else rng.randint(1, 9)
        item = 5 if user == 7 and k % 9 == 0 else rng.randint(1, 12)
        rows.append((k * 3 + 1, user, item, rng.choice(["like", "like", "seed", "dislike", "remove"] * 12 + ["clear"]), None))
    return rows


EVENTS = "event_id long, user_id long, item_id long, action string, ts timestamp"


@pytest.mark.parametrize("width", [1, 7, 64, 1 << 16])
def test_any_cut_into_intervals_composes_alike(spark, width, monkeypatch):
    monkeypatch.setattr(FB, "LEVELS", (3, 5))
    ev = spark.createDataFrame(hot_events(), EVENTS)
    assert as_dict(FB.fold_feedback(ev, heavy_key=width)) == brute_force(ev.toPandas())


def test_events_meet_no_aggregate_of_theirs(spark):
    """Two exchanges of the events, and a join of transitions with clears only."""
    from .test_plans import plan

    text = plan(FB.fold_feedback(fx.feedback(spark, SF_SMALL)), "simple")
    assert sum("Join" in line for line in text.splitlines()) == 1 and "Window" not in text
    assert text.count("Exchange hashpartitioning(user_id") == 3  # events, transitions, clears


def test_stream_in_any_file_order(spark, scratch):
    """Files in shuffled order, two a batch, with events that come again: the batch fold's rows."""
    import random

    rows = hot_events()
    rng = random.Random(11)
    parts = [rows[k::8] + rng.sample(rows, 20) for k in range(8)]  # every file spans all ids
    rng.shuffle(parts)
    src = os.path.join(scratch, "src")
    os.makedirs(src)
    for k, part in enumerate(parts):
        path = os.path.join(src, f"e{k}.parquet")
        pd.DataFrame(part, columns=["event_id", "user_id", "item_id", "action", "ts"]) \
            .astype({"ts": "datetime64[us]"}).to_parquet(path, index=False)
        os.utime(path, (1_700_000_000 + k, 1_700_000_000 + k))
    sink = os.path.join(scratch, "sink")
    seen = []
    got = FS.run_feedback_stream(spark, src, sink=sink, max_files=2, on_batch=lambda df, k: seen.append(
        {r.user_id for r in df.select("user_id").distinct().collect()}))
    ev = spark.createDataFrame(rows, EVENTS)
    want = brute_force(ev.toPandas())
    assert as_dict(got) == want == as_dict(FB.fold_feedback(ev))
    assert len(seen) == 4 and 7 in seen[0]
    last = {r.user_id: r.last_event for r in FS.stream_stats(spark, sink).collect()}
    assert last == {u: max(r[0] for r in rows if r[1] == u) for u in {r[1] for r in rows}}


def test_batches_fold_in_small_intervals_and_again(spark, scratch):
    rows = hot_events(400, 5)
    ev = spark.createDataFrame(rows, EVENTS)
    batches = [rows[300:], rows[100:200], rows[:100], rows[200:300]]
    for k, part in enumerate(batches):
        df = spark.createDataFrame(part, EVENTS)
        FS.fold_batch(spark, scratch, df, k, width=16)
        if k == 2:
            FS.fold_batch(spark, scratch, df, k, width=16)  # a batch that runs again
    FS.fold_batch(spark, scratch, spark.createDataFrame([], EVENTS), 4, width=16)
    assert as_dict(FS.preferences_of(spark, scratch, width=16)) == brute_force(ev.toPandas())
    some = spark.createDataFrame([(7,), (2,), (99,)], "user_id long")
    want = {k: v for k, v in brute_force(ev.toPandas()).items() if k[0] in (7, 2)}
    assert as_dict(FS.preferences_of(spark, scratch, some, width=16)) == want


def test_lists_are_replaced_in_place(spark, scratch):
    from tastegraph.streaming import rescore

    sink = os.path.join(scratch, "lists")
    schema = "user_id long, item_id long, rank int"
    for rows in ([(u, 10 * u + r, r) for u in range(200) for r in (1, 2)], [(5, 99, 1), (6, None, None)], [(5, 98, 1), (300, 1, 1)]):
        lists = spark.createDataFrame(rows, schema)
        rescore.upsert_lists(spark, sink, lists.select("user_id").distinct(), lists)
    stored = spark.read.parquet(sink)
    assert stored.where("user_id = 5").count() == 1 and stored.count() == 2 * 198 + 3  # one list a user is stored
    got = {(r.user_id, r.item_id) for r in rescore.current_recommendations(spark, sink).collect()}
    assert {g for g in got if g[0] in (5, 6, 300)} == {(5, 98), (300, 1)}
    assert len(got) == 2 * 198 + 2


def test_a_batch_is_scored_from_preferences_and_scores_written_once(spark, scratch, monkeypatch):
    from tastegraph.streaming import rescore

    catalog = spark.createDataFrame([(i, f"T{i}", ["a", "b"][: 1 + i % 2], 10 + i) for i in range(1, 9)],
                                    "item_id long, title string, genres array<string>, n long")
    nb = spark.createDataFrame([(i, 1, i % 8 + 1, 0.5) for i in range(1, 9)],
                               "item_id long, rank int, neighbour_id long, sim double")
    snapshot = spark.createDataFrame([(1, 1, "liked"), (1, 2, "disliked"), (2, 3, "liked"), (2, 99, "liked"), (3, None, None)],
                                     "user_id long, item_id long, state string")
    seen, own = {}, rescore.prof_ops.recommend
    monkeypatch.setattr(rescore.prof_ops, "recommend",
                        lambda prefs, *a, **k: seen.update(prefs=prefs, scores=k.get("scores")) or own(prefs, *a, **k))
    sink = os.path.join(scratch, "recs")
    rescore.rescorer(nb, catalog, sink)(snapshot, 0)
    for name in ("prefs", "scores"):
        assert seen[name] is not None
        plan = seen[name]._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan and "Aggregate" not in plan, plan
    prefs = snapshot.where("item_id < 9")
    key = lambda df: sorted((r.user_id, r.rank, r.item_id, r.final) for r in df.collect())
    assert key(rescore.current_recommendations(spark, sink)) == key(own(prefs, nb, catalog))
