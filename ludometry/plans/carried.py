"""Match updates from new events and carried counters, without the players' histories.

The ordinal of a start or finish is how many there were before it, and its session
how many were opened. So a batch that continues a player's events needs of the
past three counts, the starts that no finish has met yet, and when the last event
was. These are carried as rows that add up: an update appends the rows of its batch,
and a sum over a player's rows is what he brings along.

A player whose batch holds an event before the last one seen is looked up in the
history instead, as late events shift all ordinals after them. Either way a match is
added if it finishes after the last stored one, as in ``gold.update_matches``.

Matches are written first, then the counters, then a note to which state of the
match table and to which batch they belong. A batch that is replayed is known by
its number; if the note fits nothing, the counters are made anew from the history.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ludometry.operators.increment import without
from ludometry.operators.increment import watermark as largest
from ludometry.operators.matches import GROUP, matches
from ludometry.operators.running import HOT_ROWS, RunningTotal, per_key
from ludometry.operators.sessions import EVENT_ORDER, MATCH_FINISH, MATCH_START, opens_session
from ludometry.plans.gold import _merge, match_delta, update_matches, write_statistics
from ludometry.plans.lake import Lake
from ludometry.schemas import CARRIED, MATCH, MATCH_KEY, SILVER_EVENT
from ludometry.sinks.tables import landed
from ludometry.sinks.versions import change_count, extend, prune, publish, read_current, state
from ludometry.sources.tables import discard, folder_names, read_or_empty, stage_events, touch

SESSION, LAST, PENDING = "session", "last", "pending"
NOTE = "_of="
# Changes of the counters after which they are added up in one version.
MOST_CHANGES = 64


def _relevant(events: DataFrame) -> DataFrame:
    """Starts, finishes and session openings; nothing else makes a match."""
    kinds = F.col("event_type").isin(MATCH_START, MATCH_FINISH)
    return (
        events.withColumn("new_session", opens_session())
        .filter(kinds | (F.col("new_session") == 1))
        .select(*GROUP, *EVENT_ORDER, "event_type", "outcome", "new_session")
    )


def _sides(events: DataFrame, before: DataFrame | None, hot_rows: int) -> DataFrame:
    """Starts and finishes with session and ordinal, counted on from carried rows if given."""

    def number(rows: DataFrame, total: RunningTotal) -> DataFrame:
        numbered = total(rows, ["user_id"], EVENT_ORDER, F.col("new_session"), "session_number")
        sides = numbered.filter(
            F.col("event_type").isin(MATCH_START, MATCH_FINISH) & F.col("map_id").isNotNull() & F.col("opponent_id").isNotNull()
        )
        return total(sides, [*GROUP, "event_type"], EVENT_ORDER, F.lit(1), "match_number")

    sides = per_key(events, ["user_id"], number, hot_rows).drop("new_session")
    if before is None:
        return sides
    sessions = before.filter(F.col("kind") == SESSION).groupBy("user_id").agg(F.sum("n").alias("_sessions"))
    counts = before.filter(F.col("kind").isin(MATCH_START, MATCH_FINISH))
    counts = counts.groupBy(*GROUP, F.col("kind").alias("event_type")).agg(F.sum("n").alias("_before"))
    return (
        sides.join(sessions, "user_id", "left")
        .join(counts, [*GROUP, "event_type"], "left")
        .withColumns(
            {
                "session_number": F.col("session_number") + F.coalesce("_sessions", F.lit(0)),
                "match_number": F.col("match_number") + F.coalesce("_before", F.lit(0)),
            }
        )
        .drop("_sessions", "_before")
    )


def _rows(rows: DataFrame, **columns: Column) -> DataFrame:
    """CARRIED rows with the given columns, null in all others."""
    return rows.select(*[columns.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CARRIED.fields])


def pending_starts(carried: DataFrame) -> DataFrame:
    """Starts (MATCH_KEY, session_number, at) that the carried rows leave without a finish."""
    keys = [*MATCH_KEY, "session_number", "at"]
    open_ = carried.filter(F.col("kind") == PENDING).groupBy(*keys).agg(F.sum("n").alias("n"))
    return open_.filter("n > 0").drop("n")


def _change(events: DataFrame, sides: DataFrame, before: DataFrame | None) -> DataFrame:
    """CARRIED rows that relevant events add: counts, last events, starts that stay open or were met."""
    group = {name: F.col(name) for name in GROUP}
    opened = events.groupBy("user_id").agg(F.sum("new_session").alias("n")).filter("n > 0")
    latest = events.groupBy("user_id").agg(F.max(F.struct(*EVENT_ORDER)).alias("latest"))
    counts = sides.groupBy(*GROUP, "event_type").agg(F.count(F.lit(1)).alias("n"))
    finishes = counts.filter(F.col("event_type") == MATCH_FINISH).select(*GROUP, "n")
    starts = sides.filter(F.col("event_type") == MATCH_START).select(
        *MATCH_KEY, "session_number", F.col("timestamp").alias("at"), F.lit(0).alias("_old")
    )
    if before is not None:
        finishes = finishes.unionByName(before.filter(F.col("kind") == MATCH_FINISH).select(*GROUP, "n"))
        starts = starts.unionByName(pending_starts(before).withColumn("_old", F.lit(1)))
    finished = finishes.groupBy(*GROUP).agg(F.sum("n").alias("_finished"))
    met = F.col("match_number") <= F.coalesce("_finished", F.lit(0))
    change = F.when((F.col("_old") == 0) & ~met, 1).when((F.col("_old") == 1) & met, -1)
    pending = starts.join(finished, GROUP, "left").withColumn("n", change).filter("n IS NOT NULL")
    return (
        _rows(opened, user_id=F.col("user_id"), kind=F.lit(SESSION), n=F.col("n"))
        .unionByName(_rows(latest, user_id=F.col("user_id"), kind=F.lit(LAST), at=F.col("latest.timestamp"), event_id=F.col("latest.event_id")))
        .unionByName(_rows(counts, **group, kind=F.col("event_type"), n=F.col("n")))
        .unionByName(
            _rows(
                pending, **group, kind=F.lit(PENDING), n=F.col("n"), at=F.col("at"),
                match_number=F.col("match_number"), session_number=F.col("session_number"),
            )
        )
    )


def added_up(carried: DataFrame) -> DataFrame:
    """The same counters in as few rows as there are."""
    keys = [f.name for f in CARRIED.fields if f.name not in ("at", "event_id", "n")]
    counts = carried.filter(F.col("kind") != LAST).groupBy(*keys, "at").agg(F.sum("n").alias("n")).filter("n <> 0")
    latest = carried.filter(F.col("kind") == LAST).groupBy("user_id").agg(F.max(F.struct("at", "event_id")).alias("latest"))
    return _rows(counts, **{name: F.col(name) for name in [*keys, "at", "n"]}).unionByName(
        _rows(latest, user_id=F.col("user_id"), kind=F.lit(LAST), at=F.col("latest.at"), event_id=F.col("latest.event_id"))
    )


def _continued(sides: DataFrame, before: DataFrame, last: int) -> DataFrame:
    """Matches that finish after ``last``, from sides of a batch and the starts carried to it."""
    is_start, is_finish = F.col("event_type") == MATCH_START, F.col("event_type") == MATCH_FINISH
    open_ = pending_starts(before).select(
        *MATCH_KEY, "session_number", F.col("at").alias("timestamp"), F.lit(MATCH_START).alias("event_type"), F.lit(None).cast("double").alias("outcome")
    )
    paired = sides.select(open_.columns).unionByName(open_).groupBy(*MATCH_KEY).agg(
        F.max(F.when(is_start, F.col("session_number"))).alias("session_number"),
        F.max(F.when(is_start, F.col("timestamp"))).alias("start_timestamp"),
        F.max(F.when(is_finish, F.col("timestamp"))).alias("finish_timestamp"),
        F.max(F.when(is_finish, F.col("outcome"))).alias("outcome"),
    )
    return (
        paired.withColumn("duration", F.col("finish_timestamp") - F.col("start_timestamp"))
        .filter((F.col("duration") >= 0) & (F.col("finish_timestamp") > last))
        .withColumn("is_win", F.when(F.col("outcome") == 1, 1).otherwise(0))
        .select(*MATCH.fieldNames())
    )


def _negative(carried: DataFrame) -> DataFrame:
    """Rows that take carried counters back; the last event stays, being the largest anyway."""
    return carried.filter(F.col("kind") != LAST).withColumn("n", -F.col("n"))


def apply_batch(
    spark: SparkSession,
    lake: Lake,
    batch: DataFrame,
    number: int,
    history: Callable[[], DataFrame],
    hot_rows: int = HOT_ROWS,
    changed: Callable[[DataFrame], None] | None = None,
) -> None:
    """Bring the match table up to date with a batch of staged events.

    ``number`` tells batches apart, and ``history()`` is all events, the batch
    among them; it is called only where the batch alone does not do. ``changed``
    is told of the matches that came and went, as by ``gold.update_matches``.
    """
    stored = read_current(spark, lake.matches, MATCH)
    noted = _note(spark, lake)
    now = state(spark, lake.matches)
    if noted == f"{now}.{number}":
        return  # replayed, and done before
    if stored is None or noted is None or noted.rpartition(".")[0] != now:
        every = history()
        update_matches(every, lake.matches, "full" if stored is None else "watermark", hot_rows, changed=changed)
        _publish(_since_the_beginning(every, hot_rows), lake)
        _write_note(spark, lake, number)
        return
    with landed(_relevant(batch), "batch") as events, landed(events.select("user_id").distinct(), "players") as players:
        # What the batch's players bring along; nothing is shuffled but their rows.
        mine = players.withColumnRenamed("user_id", "_player")
        carried = read_current(spark, lake.carried, CARRIED)
        with landed(carried.join(mine, F.col("user_id") == F.col("_player"), "left_semi"), "carried") as before:
            latest = before.filter(F.col("kind") == LAST).groupBy("user_id").agg(F.max(F.struct("at", "event_id")).alias("_latest"))
            first = events.groupBy("user_id").agg(F.min(F.struct(F.col("timestamp").alias("at"), "event_id")).alias("_first"))
            late = first.join(latest, "user_id").filter("_first <= _latest").select(F.col("user_id").alias("key"))
            with landed(late, "late") as late_players:
                delta, change = _apply(events, before, late_players, stored, history, hot_rows)
                with landed(change, "carried-change") as counted:
                    _merge(delta, stored, lake.matches, changed)
                    extend(counted, lake.carried)
    if change_count(spark, lake.carried) >= MOST_CHANGES:
        _publish(added_up(read_current(spark, lake.carried, CARRIED)), lake)
    _write_note(spark, lake, number)


def _apply(
    events: DataFrame,
    before: DataFrame,
    late: DataFrame,
    stored: DataFrame,
    history: Callable[[], DataFrame],
    hot_rows: int,
) -> tuple[DataFrame, DataFrame]:
    """The matches that relevant events add, and the CARRIED rows; late players' ones from the history."""
    last = largest(stored, "finish_timestamp").first().watermark
    steady, known = without(events, late, "user_id"), without(before, late, "user_id")
    sides = _sides(steady, known, hot_rows)
    delta, change = _continued(sides, known, last), _change(steady, sides, known)
    if late.isEmpty():
        return delta, change
    names = late.select(F.col("key").alias("user_id"))
    past = history().join(names, "user_id", "left_semi")
    change = change.unionByName(_since_the_beginning(past, hot_rows)).unionByName(
        _negative(before.join(names, "user_id", "left_semi"))
    )
    return delta.unionByName(match_delta(past, stored, hot_rows)), change


def _since_the_beginning(events: DataFrame, hot_rows: int) -> DataFrame:
    own = _relevant(events)
    return _change(own, _sides(own, None, hot_rows), None)


def _publish(carried: DataFrame, lake: Lake) -> None:
    publish(carried, lake.carried)
    prune(carried.sparkSession, lake.carried)


def _note(spark: SparkSession, lake: Lake) -> str | None:
    """State of the match table and number of the batch that the counters are of."""
    names = [name for name in folder_names(spark, lake.carried) or [] if name.startswith(NOTE)]
    return names[0][len(NOTE) :] if len(names) == 1 else None


def _write_note(spark: SparkSession, lake: Lake, number: int) -> None:
    for name in folder_names(spark, lake.carried):
        if name.startswith(NOTE):
            discard(spark, f"{lake.carried}/{name}")
    touch(spark, f"{lake.carried}/{NOTE}{state(spark, lake.matches)}.{number}")


def follow_matches(
    spark: SparkSession,
    lake: Lake,
    progress: str | None = None,
    hot_rows: int = HOT_ROWS,
    changed: Callable[[DataFrame], None] | None = None,
) -> DataFrame:
    """Update the match table from the files that Silver gained, and return it.

    ``progress`` is the stream's checkpoint folder, ``lake.gold_progress`` by default.
    """

    def add(batch: DataFrame, number: int) -> None:
        own = batch.sparkSession
        apply_batch(own, lake, stage_events(batch), number, lambda: _all_events(own, lake), hot_rows, changed)

    if folder_names(spark, lake.silver_events) is not None:
        query = (
            spark.readStream.schema(SILVER_EVENT)
            .parquet(lake.silver_events)
            .writeStream.foreachBatch(add)
            .option("checkpointLocation", progress or lake.gold_progress)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    found = read_current(spark, lake.matches, MATCH)
    return spark.createDataFrame([], MATCH) if found is None else found


def run_gold_of_new_files(spark: SparkSession, lake: Lake, hot_rows: int = HOT_ROWS) -> DataFrame:
    """As ``gold.run_gold``, from the files that Silver gained since the last call."""
    return write_statistics(spark, lake, lambda changed: follow_matches(spark, lake, None, hot_rows, changed))


def _all_events(spark: SparkSession, lake: Lake) -> DataFrame:
    return stage_events(read_or_empty(spark, lake.silver_events, SILVER_EVENT))
