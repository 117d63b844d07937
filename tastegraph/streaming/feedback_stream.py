"""The feedback fold as a Structured Streaming job whose state merges in any order.

Events arrive as files (parquet, fixed schema), in any order and cut into any batches. The
state is kept as tables in the sink, one folder for each micro-batch and table:

events       the batch's events, by era (a range of ids that prunes the reads below)
transitions  for every (user, interval of ids) the batch touched, the composed transition of
             each item there (``operators/feedback.py``), by bucket of users
clears       the interval of each touched user's last clear
users        each touched user's last event and number of late or repeated events

A micro-batch writes its events, reads back all events of the intervals it touched, and writes
their transitions anew: a late event changes its own interval alone, a repeated one nothing.
The newest batch's row of a (user, interval, item) holds; the clears take their maximum. A
micro-batch's work is bounded by the events of the intervals that it touches; a user with many
events is many intervals, and no task or group holds a whole user. Each folder is overwritten
when a batch runs again, so a failed batch leaves no trace.

``current_preferences`` composes the transitions. ``compact`` writes that result once; readers then
compose only users with events after it. An optional ``on_batch`` callback receives the
touched users' preferences (used to re-score them); a user left with none has one marker row
(item_id null).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tastegraph import schemas
from tastegraph.operators import feedback as fb_ops
from tastegraph.session import persisted, scratch_path
from tastegraph.sources.files import path_exists

ERA = 1 << 24  # event ids of an era, a folder of the events table
USER_BUCKETS = 64
# Files per micro-batch: bounds each batch even when a large backlog is waiting;
# Trigger.AvailableNow honours it.
MAX_FILES_PER_TRIGGER = 64

TRANSITIONS_SCHEMA = (f"user_id long, interval long, item_id long, t {fb_ops.TRANSITION}, batch long, bucket int")
EVENTS_SCHEMA = "event_id long, user_id long, item_id long, action string, batch long, era long"
CLEARS_SCHEMA = "user_id long, last_clear long, batch long"
USERS_SCHEMA = "user_id long, last_event long, late_events long, batch long"


def _apply(cur: dict, event_id: int, item: int, action: str) -> dict:
    """One event of the fold on a user's {item: [liked, disliked, since]}: the rules in their plain form,
    against which the composed transitions are tested."""
    if action == "clear":
        return {}
    e = cur.get(item, [0, 0, None])
    if action == "like":
        if e[0]:
            e = [0, 0, None]
        else:
            e = [1, 0, event_id]
    elif action == "seed":
        e = [1, 0, e[2] if e[0] else event_id]
    elif action == "dislike":
        e = [0, 1, None]
    elif action == "remove":
        e = [0, e[1], None]
    else:
        return cur
    cur[item] = e
    return cur


def user_bucket(buckets: int = USER_BUCKETS) -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")


def _era() -> Column:
    return F.col("event_id") - F.pmod(F.col("event_id"), F.lit(ERA).cast("long"))


def _read(spark: SparkSession, sink: str, name: str, schema: str) -> DataFrame:
    path = f"{sink.rstrip('/')}/{name}"
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", path).parquet(path)


def _write(df: DataFrame, sink: str, name: str, batch_id: int, *by: str) -> DataFrame:
    path = f"{sink.rstrip('/')}/{name}/batch={batch_id}"
    df.write.mode("overwrite").partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).option("basePath", path).parquet(path)


def fold_batch(spark: SparkSession, sink: str, new: DataFrame, batch_id: int, width: int = fb_ops.WIDTH) -> DataFrame:
    """Merges a micro-batch of events into the state; returns the users it touched. No order is asked
    of the batches, and the events of earlier ones may come again."""
    own = _write(fb_ops.valid_events(new).distinct().withColumn("era", _era()), sink, "events", batch_id, "era")
    low, high = own.agg(F.min("era"), F.max("era")).first()
    if low is None:
        return spark.createDataFrame([], "user_id long")
    touched = own.select("user_id", fb_ops.interval_of(width).alias("interval")).distinct()
    # a batch that ran before and failed left a folder of its own number at most
    log = (_read(spark, sink, "events", EVENTS_SCHEMA).where(F.col("era").between(low, high) & (F.col("batch") <= batch_id))
           .withColumn("interval", fb_ops.interval_of(width)))
    again = log.join(touched, ["user_id", "interval"], "left_semi").drop("interval")
    rows = fb_ops.interval_transitions(again, width).withColumn("bucket", user_bucket())
    _write(rows, sink, "transitions", batch_id, "bucket")
    _write(fb_ops.last_clears(own, width), sink, "clears", batch_id)
    before = _stats(spark, sink, batch_id - 1)
    late = F.count_if(F.col("event_id") <= F.col("last_event"))
    users = (own.join(before, "user_id", "left").groupBy("user_id")
             .agg(F.greatest(F.max("event_id"), F.max("last_event")).alias("last_event"),
                  (late + F.coalesce(F.max("late_events"), F.lit(0))).alias("late_events")))
    return _write(users, sink, "users", batch_id).select("user_id")


def _stats(spark: SparkSession, sink: str, upto: int | None = None) -> DataFrame:
    rows = _read(spark, sink, "users", USERS_SCHEMA)
    if upto is not None:
        rows = rows.where(F.col("batch") <= upto)
    return (rows.groupBy("user_id").agg(F.max("last_event").alias("last_event"), F.max("late_events").alias("late_events")))


def preferences_of(spark: SparkSession, sink: str, users: DataFrame | None = None,
                   width: int = fb_ops.WIDTH) -> DataFrame:
    """user_id, item_id, state, since_event of ``users`` (all if None), composed from the transitions."""
    rows = _read(spark, sink, "transitions", TRANSITIONS_SCHEMA)
    clears = _read(spark, sink, "clears", CLEARS_SCHEMA)
    if users is not None:
        buckets = [r[0] for r in users.select(user_bucket()).distinct().collect()]  # at most USER_BUCKETS
        rows = rows.where(F.col("bucket").isin(buckets)).join(users, "user_id", "left_semi")
        clears = clears.join(users, "user_id", "left_semi")
    newest = rows.groupBy("user_id", "interval", "item_id").agg(F.max_by("t", "batch").alias("t"))
    last = clears.groupBy("user_id").agg(F.max("last_clear").alias("last_clear"))
    return fb_ops.merged_preferences(newest, last, width)


def start_feedback_stream(spark: SparkSession, source_dir: str, sink: str, checkpoint: str, *,
                          glob: str = "*.parquet", max_files: int | None = MAX_FILES_PER_TRIGGER,
                          schema=schemas.FEEDBACK, to_events: Callable[[DataFrame], DataFrame] | None = None,
                          on_batch: Callable[[DataFrame, int], None] | None = None,
                          available_now: bool = True):
    """Folds files of feedback events (``schemas.FEEDBACK``). Files of another layout need
    their ``schema`` and ``to_events``, which maps them to event_id, user_id, item_id, action."""
    reader = (spark.readStream.schema(schema).option("pathGlobFilter", glob))
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    raw = reader.parquet(source_dir)
    events = (to_events(raw) if to_events else raw).select("event_id", "user_id", "item_id", "action")

    def write_batch(df: DataFrame, batch_id: int) -> None:
        session = df.sparkSession
        users = fold_batch(session, sink, df, batch_id)
        if on_batch is not None:
            # one marker row stands for a touched user without preferences
            with persisted(users.join(preferences_of(session, sink, users), "user_id", "left")) as snapshot:
                on_batch(snapshot, batch_id)

    w = events.writeStream.foreachBatch(write_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def _compacted(sink: str) -> str:
    return f"{sink.rstrip('/')}_compact"


def current_preferences(spark: SparkSession, sink: str) -> DataFrame:
    """user_id, item_id, state, since_event: from the last compaction, if there is one, for the users
    without later events, and from the transitions for the others."""
    columns = ["user_id", "item_id", "state", "since_event"]
    if not path_exists(spark, _compacted(sink)):
        return preferences_of(spark, sink).select(*columns)
    tables = spark.read.parquet(_compacted(sink))
    upto = tables.agg(F.max("upto")).first()[0]
    done = tables.where(F.col("upto") == upto).select(*columns)
    users = _read(spark, sink, "users", USERS_SCHEMA).where(F.col("batch") > upto).select("user_id").distinct()
    later = preferences_of(spark, sink, users).select(*columns)
    return done.join(users, "user_id", "left_anti").unionByName(later)


def stream_stats(spark: SparkSession, sink: str) -> DataFrame:
    """user_id, last_event, late_events: each user's newest event, and how many events came at or below
    the newest one of an earlier batch (repeated ones, which change nothing, and late ones, which count)."""
    return _stats(spark, sink)


def compact(spark: SparkSession, sink: str) -> DataFrame:
    """Write everyone's current preferences as one table beside the sink and return it (a marker row
    keeps a table without preferences readable). Readers then compose only later batches' users."""
    upto = _read(spark, sink, "users", USERS_SCHEMA).agg(F.max("batch")).first()[0]
    out = f"{_compacted(sink)}/upto={-1 if upto is None else upto}"
    current_preferences(spark, sink).write.mode("overwrite").parquet(out)
    return spark.read.parquet(out)


def run_feedback_stream(spark: SparkSession, source_dir: str, *, glob: str = "*.parquet",
                        max_files: int | None = MAX_FILES_PER_TRIGGER, sink: str | None = None,
                        checkpoint: str | None = None, schema=schemas.FEEDBACK, to_events=None,
                        on_batch=None) -> DataFrame:
    """Process everything available (Trigger.AvailableNow) and return the current
    preferences. Sink and stream checkpoint default to fresh folders under the
    session's checkpoint folder (shared storage on a cluster)."""
    sink = sink or scratch_path(spark, "feedback-sink")
    checkpoint = checkpoint or scratch_path(spark, "feedback-stream-ckpt")
    q = start_feedback_stream(spark, source_dir, sink, checkpoint, glob=glob, max_files=max_files,
                              schema=schema, to_events=to_events, on_batch=on_batch)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return current_preferences(spark, sink)
