"""Order of plays, clocks and running scores of a contest."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import blank_to_null, clock_seconds

PERIOD_SECONDS, OVERTIME_SECONDS, PERIODS = 900, 240, 4


def unnest_plays(documents: DataFrame) -> DataFrame:
    """A row per play with the places of its period, container and self; empty and null arrays give no rows.

    documents has contest_id, ingest_timestamp, teams and periods.
    """
    told = lambda t: F.struct(*[t[n].alias(n) for n in ("teamId", "nameShort", "name6Char", "nameFull")])
    side = lambda home: F.get(F.transform(F.filter("teams", lambda t: t["isHome"] == F.lit(home)), told), F.lit(0))
    head = documents.select("contest_id", "ingest_timestamp", side(True).alias("home"), side(False).alias("away"), F.posexplode("periods").alias("period_at", "period"))
    stats = head.select("contest_id", "ingest_timestamp", "home", "away", "period_at", F.col("period.periodNumber").alias("period_number"), F.col("period.periodDisplay").alias("period_display"), F.posexplode("period.playbyplayStats").alias("stat_at", "stat"))
    plays = stats.select("*", F.posexplode("stat.plays").alias("play_at", "play"))
    return plays.select(
        "contest_id", "ingest_timestamp", "home", "away", "period_at", "stat_at", "play_at", "period_number", "period_display",
        F.col("stat.teamId").alias("stat_team_id"), F.coalesce("play.clock", "stat.clock").alias("raw_clock"),
        F.col("play.playText").alias("play_text"), F.col("play.homeScore").alias("home_score"), F.col("play.visitorScore").alias("visitor_score"),
    )


def number_plays(plays: DataFrame) -> DataFrame:
    """Plays with a text, numbered from 1 within their contest in document order."""
    order = Window.partitionBy("contest_id").orderBy("period_at", "stat_at", "play_at")
    return plays.filter(F.trim("play_text") != "").withColumn("play_seq", F.row_number().over(order))


def fill_backward(value: str, default: str, *keys: str, order: str = "play_seq") -> Column:
    """The value of this row or of the next one that has any."""
    ahead = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    return F.coalesce(F.first(F.col(value), ignorenulls=True).over(ahead), F.lit(default))


def fill_forward(value: str, default: int, *keys: str, order: str = "play_seq") -> Column:
    """The value of this row or of the last one that had any."""
    behind = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.coalesce(F.last(F.col(value), ignorenulls=True).over(behind), F.lit(default))


def look_ahead(value: str, *keys: str, order: str = "play_seq") -> Column:
    """The next value after this row, null if none follows."""
    after = Window.partitionBy(*keys).orderBy(order).rowsBetween(1, Window.unboundedFollowing)
    return F.first(F.col(value), ignorenulls=True).over(after)


def game_seconds(period: Column, left: Column) -> Column:
    """Seconds since the start of the game; overtime periods are shorter."""
    regular = (period - 1) * PERIOD_SECONDS + (PERIOD_SECONDS - left)
    extra = F.lit(PERIODS * PERIOD_SECONDS) + (period - PERIODS - 1) * OVERTIME_SECONDS + (OVERTIME_SECONDS - left)
    return F.when(period <= PERIODS, regular).otherwise(extra)


def with_timeline(plays: DataFrame) -> DataFrame:
    """Numbered plays with filled clocks, game seconds, running scores and the home margin.

    All windows share the contest as their partition key or its prefix, and run
    before any text is taken apart, so that little is sorted.
    """
    plays = plays.withColumn("_clock", blank_to_null(F.trim("raw_clock")))
    plays = plays.withColumns({
        "running_home_score": fill_forward("home_score", 0, "contest_id"),
        "running_visitor_score": fill_forward("visitor_score", 0, "contest_id"),
        "clock_display": fill_backward("_clock", "0:00", "contest_id", "period_number"),
    })
    plays = plays.withColumn("period_seconds_remaining", clock_seconds(F.col("clock_display")))
    plays = plays.withColumn("game_seconds_elapsed", game_seconds(F.col("period_number"), F.col("period_seconds_remaining")))
    return plays.withColumns({
        "game_seconds_remaining_reg": F.greatest(F.lit(0), F.lit(PERIODS * PERIOD_SECONDS) - F.col("game_seconds_elapsed")),
        "home_score_margin": F.col("running_home_score") - F.col("running_visitor_score"),
    }).drop("_clock", "raw_clock", "home_score", "visitor_score", "period_at", "stat_at", "play_at")
