"""Team labels of a contest: from metadata, and learnt from its plays.

Labels are an array of (label, team_id, observed) per contest. It is gathered by
a window over the contest, so that the parsed plays stay in one branch of the
plan, and reduced once per contest to a map from each unambiguous label to its
team and to a pattern of all labels.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import found, found_by, label, spoken_label

#: Fewest letters of a cut-off label.
SHORTEST = 3
#: What follows a label.
BORDER = r"(?=[\s,.(]|$)"


def metadata_labels(short: Column, six: Column, full: Column) -> Column:
    """Labels that a team's names suggest: the names, their initials, and the short name cut off behind each letter from SHORTEST on.

    Each name is made a label once, however many letters it has.
    """

    def suggested(made: Column) -> Column:
        names, name = F.filter(made, lambda n: n != ""), F.coalesce(F.get(made, F.lit(0)), F.lit(""))
        initials = F.transform(names, lambda n: F.regexp_replace(n, r"(\S)\S*\s*", "$1"))
        lengths = F.when(F.length(name) >= SHORTEST, F.sequence(F.lit(SHORTEST), F.length(name))).otherwise(F.array().cast("array<int>"))
        cut = F.transform(lengths, lambda k: F.rtrim(F.substring(name, F.lit(1), k)))
        return F.array_distinct(F.concat(names, initials, cut))

    return once(F.transform(F.array(short, six, full), label), suggested)


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value evaluated once, wherever then has it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


ENTRY = "array<struct<label: string, team_id: bigint, observed: boolean>>"


def entries(labels: Column, team: Column, observed: bool) -> Column:
    """Labels of one team as entries; none without a team."""
    made = F.transform(labels, lambda x: F.struct(x.alias("label"), team.alias("team_id"), F.lit(observed).alias("observed")))
    return F.when(team.isNotNull() & labels.isNotNull(), made).otherwise(F.array()).cast(ENTRY)


def label_map(known: Column) -> Column:
    """Team of each label. What was observed goes before what names suggest; a label of both teams is a label of none."""

    def one(name: Column) -> Column:
        mine = F.filter(known, lambda e: e["label"] == name)
        said = F.filter(mine, lambda e: e["observed"])
        teams = F.array_distinct(F.transform(F.when(F.size(said) > 0, said).otherwise(mine), lambda e: e["team_id"]))
        return F.struct(name, F.when(F.size(teams) == 1, F.get(teams, F.lit(0))))

    return F.map_from_entries(F.transform(label_names(known), one))


def label_names(known: Column) -> Column:
    return F.array_distinct(F.transform(known, lambda e: e["label"]))


def label_pattern(known: Column) -> Column:
    """Pattern of all labels, also the shared ones, so that they are still told from a player's name; longer ones first. Null without any."""
    by_size = F.sort_array(F.transform(label_names(known), lambda n: F.struct((-F.length(n)).alias("size"), n.alias("label"))))
    quoted = F.array_join(F.transform(by_size, lambda x: F.concat(F.lit(r"\Q"), x["label"], F.lit(r"\E"))), "|")
    return F.concat(F.lit("^(?i:((?:"), F.nullif(quoted, F.lit("")), F.lit(rf")\.?){BORDER})"))


def label_at(rest: Column) -> Column:
    """The label at the beginning of rest: the longest that the contest knows, in any letter case, or else one word.

    A known label is taken whole, also where its last word could be a player.
    """
    return F.coalesce(found_by(rest, F.col("team_pattern")), found(rest, rf"^(\w+\.?){BORDER}"))


def once_per_contest(value: Column) -> Column:
    """value, evaluated on the first play of each contest only and given to all its plays."""
    return F.first(F.when(F.col("play_seq") == 1, value), ignorenulls=True).over(Window.partitionBy("contest_id"))


def with_teams(plays: DataFrame) -> DataFrame:
    """Plays (event_type; _rest, from the label on) with teams_by_label and team_pattern of their contest."""
    known = (F.col("stat_team_id") == F.col("home_id")) | (F.col("stat_team_id") == F.col("away_id"))
    plays = plays.withColumn("_spoken", F.when(known, spoken_label(F.col("event_type"), F.col("_rest")))).withColumn("_spoken", label(F.col("_spoken")))
    said = F.when(F.col("_spoken") != "", F.struct(F.col("_spoken").alias("label"), F.col("stat_team_id").alias("team_id"), F.lit(True).alias("observed")))
    plays = plays.withColumn("_said", said).withColumn("_said", F.collect_set("_said").over(Window.partitionBy("contest_id")))
    named = [entries(metadata_labels(*[F.col(f"{side}.{n}") for n in ("nameShort", "name6Char", "nameFull")]), F.col(f"{side}_id"), False) for side in ("home", "away")]
    plays = plays.withColumn("_known", F.when(F.col("play_seq") == 1, F.concat(F.col("_said").cast(ENTRY), *named)))
    maps = {"teams_by_label": once_per_contest(label_map(F.col("_known"))), "team_pattern": once_per_contest(label_pattern(F.col("_known")))}
    return plays.withColumns(maps).drop("_said", "_spoken", "_known")


def lookup(code: Column) -> Column:
    """The team of a label in this row's contest, null if it is unknown or shared."""
    return F.try_element_at("teams_by_label", F.coalesce(label(code), F.lit("")))
