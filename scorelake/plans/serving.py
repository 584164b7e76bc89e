"""Queries over one published generation: filtered pages, situations, leaderboards."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce
from pathlib import Path
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import pages
from ..operators.gold import expected_loss, shot_rates
from ..sources import files
from . import store

ROLES = ("primary_player_name", "secondary_player_name", "caused_by_player_name", "faceoff_winner_player", "faceoff_loser_player")
SORT_KEYS = ("play_seq", "game_seconds_elapsed", "game_seconds_remaining_reg", "period_seconds_remaining", "period_number", "play_id")
TIES = ("contest_id", "play_seq", "play_id")
#: Offset from which on a page is found before it is sorted.
DEEP = 5000
#: Shot results of the retention table, in order, and the results that are shown under another name.
RETENTION = ("SAVE", "WIDE", "HIGH", "HIT POST", "HIT CROSSBAR", "BLOCKED")
SHOWN_AS = {"POST": "HIT POST", "CROSSBAR": "HIT CROSSBAR"}
#: Longest text that is taken for a team's code and not for a part of its name.
CODE_LENGTH = 4


def all_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def any_of(conditions: Iterable[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def _equal(name: str, upper: bool = False) -> Callable[[Any], Column]:
    return lambda v: F.col(name) == F.lit(v.upper() if upper else v)


def _least(name: str) -> Callable[[Any], Column]:
    return lambda v: F.col(name) >= v


def _most(name: str) -> Callable[[Any], Column]:
    return lambda v: F.col(name) <= v


#: Condition of each argument of plays(); an argument that is None, or an empty text or list, sets none.
CONDITIONS: dict[str, Callable[[Any], Column]] = {
    "contest_id": _equal("contest_id"),
    "event_type": _equal("event_type", upper=True),
    "event_types": lambda v: F.col("event_type").isin([x.upper() for x in v]),
    "period_number": _equal("period_number"),
    "min_period": _least("period_number"),
    "max_period": _most("period_number"),
    "player_name": lambda v: any_of(F.col(c).ilike(f"%{v}%") for c in ROLES),
    "team_id": lambda v: (F.col("team_id") == v) | (F.col("caused_by_team_id") == v),
    "possession_team_id": _equal("possession_team_id"),
    "max_period_seconds_remaining": _most("period_seconds_remaining"),
    "min_period_seconds_remaining": _least("period_seconds_remaining"),
    "max_game_seconds_remaining": _most("game_seconds_remaining_reg"),
    "min_game_seconds_remaining": _least("game_seconds_remaining_reg"),
    "shot_result": _equal("shot_result", upper=True),
    "shot_possession_retained": _equal("shot_possession_retained"),
    "is_extra_man_opportunity": _equal("is_extra_man_opportunity"),
    "event_team_margin_min": _least("event_team_margin"),
    "event_team_margin_max": _most("event_team_margin"),
    "home_score_margin_min": _least("home_score_margin"),
    "home_score_margin_max": _most("home_score_margin"),
}


def conditions(**arguments: Any) -> Column:
    """All conditions of the arguments that are set; 0 and False are set."""
    unknown = set(arguments) - set(CONDITIONS)
    if unknown:
        raise TypeError(f"unknown filters: {', '.join(sorted(unknown))}")
    return all_of(CONDITIONS[k](v) for k, v in arguments.items() if v is not None and v != "" and v != [])


def ordered(plays: DataFrame, order_by: str = "play_seq", descending: bool = False) -> DataFrame:
    """A total order by an allowed key (else play_seq), nulls last either way, ties by contest, sequence and id."""
    return pages.in_order(plays, order_by if order_by in SORT_KEYS else "play_seq", TIES, descending)


def rounded_ratio(top: Column, bottom: Column) -> Column:
    return F.round(top.cast("double") / F.nullif(bottom.cast("double"), F.lit(0.0)), 4)


class Catalog:
    """Read access to the generation that is current when the catalog is made; it stays on it.

    Frames are immutable, so one catalog may serve many threads. Views for ad-hoc
    SQL are registered in a session of the catalog's own.
    """

    def __init__(self, spark: SparkSession, tables: dict[str, DataFrame]):
        self.spark, self.tables = spark, dict(tables)
        stats = self.tables["agg_team_game_stats"]
        self.tables["agg_team_game_stats"] = stats.filter("team_short is not null")

    @classmethod
    def open(cls, spark: SparkSession, gold_root: str | Path, silver_root: str | Path | None = None) -> Catalog:
        """Open the published generation; with silver_root also the play table, which stands in for facts that aren't there yet."""
        own = spark.newSession()
        extra = {"silver_plays": store.read_table(own, silver_root)} if silver_root and store.has_table(silver_root) else {}
        try:
            folder = store.generation(gold_root)
        except ValueError:
            if not extra or store.current(gold_root):
                raise
            found = cls.__new__(cls)
            found.spark, found.tables = own, extra | {"fact_plays": extra["silver_plays"]}
        else:
            found = cls(own, extra | {n: own.read.parquet(str(files.join(folder, n))) for n in store.GOLD_TABLES})
        for name, df in found.tables.items():
            df.createOrReplaceTempView(name)
        return found

    def __getattr__(self, name: str) -> DataFrame:
        try:
            return self.__dict__["tables"][name]
        except KeyError:
            raise AttributeError(name) from None

    def sql(self, query: str, parameters: dict[str, Any] | None = None) -> list[dict[str, Any]]:
        return rows_of(self.spark.sql(query, args=parameters or {}))

    def contests(self) -> DataFrame:
        return self.dim_contests.orderBy(F.col("contest_id").asc_nulls_last())

    def has_contest(self, contest_id: int) -> bool:
        return not self.dim_contests.filter(F.col("contest_id") == contest_id).isEmpty()

    def contest_summary(self, contest_id: int) -> DataFrame:
        """The contest with team_stats, an array of its teams' measures; no row if there is no such contest."""
        mine = F.col("contest_id") == contest_id
        stats = self.agg_team_game_stats.filter(mine).groupBy("contest_id").agg(F.sort_array(F.collect_list(F.struct("team_id", *[c for c in self.agg_team_game_stats.columns if c not in ("team_id", "contest_id")]))).alias("team_stats"))
        return self.dim_contests.filter(mine).join(stats, "contest_id", "left")

    def _of_team(self, plays: DataFrame, team: str) -> DataFrame:
        """Plays of a team by code or part of a name, in either role; a code also finds ids written as text."""
        wanted = team.strip()
        as_text = any_of(F.col(c).cast("string") == wanted for c in ("team_id", "caused_by_team_id"))
        if len(wanted) <= CODE_LENGTH:
            short = F.upper("event_team_short") == wanted.upper()
            names = any_of(F.upper(c) == wanted.upper() for c in ("name_short", "name_6char"))
        else:
            short = F.col("event_team_short").ilike(f"%{wanted}%")
            names = any_of(F.col(c).ilike(f"%{wanted}%") for c in ("name_short", "name_full", "name_6char"))
        ids = self.dim_teams.filter(names).select(F.col("team_id").alias("_team")).distinct()
        own = ids.withColumnRenamed("_team", "_own")
        plays = plays.join(own.withColumn("_is_own", F.lit(True)), plays["team_id"] == own["_own"], "left")
        plays = plays.join(ids.withColumn("_is_cause", F.lit(True)), F.col("caused_by_team_id") == F.col("_team"), "left")
        keep = F.coalesce(short, F.lit(False)) | F.coalesce(as_text, F.lit(False)) | F.col("_is_own").isNotNull() | F.col("_is_cause").isNotNull()
        return plays.filter(keep).drop("_own", "_is_own", "_team", "_is_cause")

    def plays(self, *, team: str | None = None, order_by: str = "play_seq", order_desc: bool = False, limit: int | None = 100, offset: int = 0, after: dict[str, Any] | None = None, **filters: Any) -> DataFrame:
        """A page of plays, or all from the offset with a limit of None; the arguments are those of CONDITIONS, and team.

        after: the last row of the page before (its sort key and TIES), in place of
        an offset. From an offset of DEEP on, the place of the page is found first,
        so that only the rows near it are sorted.
        """
        key = order_by if order_by in SORT_KEYS else "play_seq"
        found = self.fact_plays.filter(conditions(**filters))
        if team:
            found = self._of_team(found, team)
        if after:
            found = found.filter(pages.beyond(key, TIES, after, order_desc))
        if limit is not None and offset >= DEEP:
            return pages.page(found, key, TIES, descending=order_desc, offset=offset, limit=limit)
        if limit is None:  # a sort of all rows reads them twice, first for its ranges; so they are made once, before
            return ordered(found.repartition("contest_id", "play_seq"), key, order_desc).offset(offset)
        return ordered(found, key, order_desc).offset(offset).limit(limit)

    def caused_turnovers(self, contest_id: int | None = None, defending_team_down_by: int | None = None, max_period_seconds: int | None = None, min_period: int | None = 4, limit: int = 50) -> DataFrame:
        """Turnovers with a causer. The margin is that of the defending team; 0 for contest or period sets no condition."""
        kept = [F.col("event_type") == "TURNOVER", F.col("caused_by_player_name").isNotNull()]
        if contest_id:
            kept.append(F.col("contest_id") == contest_id)
        if min_period:
            kept.append(F.col("period_number") >= min_period)
        if max_period_seconds is not None:
            kept.append(F.col("period_seconds_remaining") <= max_period_seconds)
        if defending_team_down_by is not None:
            kept.append(F.col("event_team_margin") == defending_team_down_by)
        found = self.fact_plays.filter(all_of(kept)).orderBy("play_seq", "contest_id", "play_id").limit(limit)
        return found.select(
            "play_id", "contest_id", "play_seq", "period_number", "clock_display", "period_seconds_remaining",
            F.col("primary_player_name").alias("turnover_committer"), F.col("event_team_short").alias("turnover_team"), F.col("caused_by_player_name").alias("caused_by_player"),
            "caused_by_team_id", "running_home_score", "running_visitor_score", F.col("event_team_margin").alias("committer_team_margin"),
            (-F.col("event_team_margin")).alias("defending_team_margin"), "play_text",
        )

    def _rated(self) -> DataFrame:
        """Facts with the expected loss of each shot; the rates are those of all contests."""
        shots = self.fact_plays.select("event_type", "shot_result", F.col("shot_possession_retained").alias("kept"), F.lit(1).cast("long").alias("n"))
        rated = self.fact_plays.crossJoin(F.broadcast(shot_rates(shots)))  # one row
        return rated.withColumn("_loss", F.when(F.col("event_type") == "SHOT", expected_loss()).otherwise(0.0))

    @staticmethod
    def _measures() -> list[Column]:
        shot, goal, kept = F.col("event_type") == "SHOT", F.col("event_type") == "GOAL", F.col("shot_possession_retained")
        goals, lost, expected = F.count_if(goal), F.count_if(shot & ~kept), F.coalesce(F.sum("_loss"), F.lit(0.0))
        total = F.count_if(shot | goal)
        return [
            total.alias("total_shots"), goals.alias("goals"), F.count_if(shot & kept).alias("shots_retained"), lost.alias("realized_shots_lost"),
            F.round(expected, 4).alias("normalized_shots_lost"), (goals + lost).alias("realized_shot_possessions_used"), F.round(goals + expected, 4).alias("normalized_shot_possessions_used"),
            rounded_ratio(goals, total).alias("shooting_pct"), rounded_ratio(goals, goals + lost).alias("realized_shooting_efficiency"), rounded_ratio(goals, goals + expected).alias("normalized_shooting_efficiency"),
        ]

    def _scope(self, rows: DataFrame, contest_id: int | None) -> DataFrame:
        return rows if contest_id is None else rows.filter(F.col("contest_id") == contest_id)

    def shooting_overall(self, contest_id: int | None = None) -> DataFrame:
        """One row of pooled measures, with zeros where there is no shot."""
        totals = self._scope(self._rated(), contest_id).filter(F.col("event_type").isin("SHOT", "GOAL")).agg(*self._measures())
        return totals.select(*[F.coalesce(c, F.lit(0).cast(t)).alias(c) for c, t in totals.dtypes])

    def average_efficiency(self, contest_id: int | None = None) -> DataFrame:
        """Mean of the team-game efficiencies, null without any."""
        stats = self._scope(self.agg_team_game_stats, contest_id)
        return stats.agg(*[F.round(F.avg(f"{c}_shooting_efficiency"), 4).alias(f"average_team_game_{c}_efficiency") for c in ("realized", "normalized")])

    def retention(self, contest_id: int | None = None) -> DataFrame:
        """Shots and how many of them were kept, for each of six results, also those without shots, in a fixed order."""
        shown = reduce(lambda c, x: c.when(F.col("shot_result") == x[0], x[1]), SHOWN_AS.items(), F.when(F.lit(False), "")).otherwise(F.col("shot_result"))
        shots = self._scope(self.fact_plays, contest_id).filter("event_type = 'SHOT'").groupBy(shown.alias("shot_result"))
        kept = F.col("shot_possession_retained")
        counts = shots.agg(F.count("*").alias("total_shots"), F.count_if(kept).alias("shots_retained"), F.count_if(~kept).alias("shots_lost"))
        buckets = self.spark.createDataFrame(list(enumerate(RETENTION)), "position int, shot_result string")
        full = buckets.join(counts, "shot_result", "left").fillna(0, ["total_shots", "shots_retained", "shots_lost"])
        return full.withColumn("retention_rate", F.coalesce(rounded_ratio(F.col("shots_retained"), F.col("total_shots")), F.lit(0.0))).orderBy("position").drop("position")

    def top_players(self, min_shots: int = 10, limit: int = 10, contest_id: int | None = None, order_by: str = "realized") -> DataFrame:
        name = F.col("primary_player_name")
        shots = self._scope(self._rated(), contest_id).filter(F.col("event_type").isin("SHOT", "GOAL") & name.isNotNull() & ~name.isin("TEAM", "TM"))
        names = self.dim_teams.select("team_id", "name_short")
        board = shots.join(names, "team_id", "left").groupBy(name.alias("player_name"), "team_id", "name_short").agg(*self._measures(), F.max("event_team_short").alias("_label"))
        board = board.filter(F.col("total_shots") >= min_shots).withColumn("team_name", F.coalesce("name_short", "_label")).drop("name_short", "_label")
        return self._best(board, order_by, "player_name", limit)

    def top_teams(self, limit: int = 10, contest_id: int | None = None, order_by: str = "realized") -> DataFrame:
        plays = self._scope(self._rated(), contest_id).filter("team_id is not null")
        names = self.dim_teams.select("team_id", "name_short", F.col("name_full").alias("team_name_full"))
        label = F.nullif(F.trim("event_team_short"), F.lit(""))
        facts = plays.drop("name_full").join(names, "team_id", "left").groupBy("team_id", "name_short", "team_name_full")
        board = facts.agg(*self._measures(), F.count_distinct("contest_id").alias("games_played"), F.sort_array(F.collect_set(label)).alias("team_short_names"), F.max("event_team_short").alias("_label"))
        board = board.withColumn("team_name", F.coalesce("name_short", "_label", F.col("team_id").cast("string"))).drop("name_short", "_label")
        return self._best(board, order_by, "team_name", limit)

    @staticmethod
    def _best(board: DataFrame, order_by: str, name: str, limit: int) -> DataFrame:
        key = f"{'normalized' if order_by == 'normalized' else 'realized'}_shooting_efficiency"
        best = board.orderBy(F.col(key).desc_nulls_last(), F.col("goals").desc(), F.col("total_shots").desc(), F.col(name).asc_nulls_last(), F.col("team_id").asc_nulls_last()).limit(limit)
        return best.fillna(0.0, [c for c, t in best.dtypes if t == "double"])

    def shooting_summary(self, *, min_player_shots: int = 10, top_players_limit: int = 10, top_teams_limit: int = 10, contest_id: int | None = None, order_by: str = "realized") -> dict[str, Any]:
        overall = rows_of(self.shooting_overall(contest_id))[0] | rows_of(self.average_efficiency(contest_id))[0]
        return {
            "contest_id": contest_id,
            "min_player_shots": min_player_shots,
            "order_by": "normalized" if order_by == "normalized" else "realized",
            "overall": overall,
            "retention_by_shot_result": rows_of(self.retention(contest_id)),
            "top_players": rows_of(self.top_players(min_player_shots, top_players_limit, contest_id, order_by)),
            "top_teams": rows_of(self.top_teams(top_teams_limit, contest_id, order_by)),
        }


def rows_of(df: DataFrame) -> list[dict[str, Any]]:
    """Rows of a bounded result as dicts."""
    return [r.asDict(recursive=True) for r in df.collect()]
