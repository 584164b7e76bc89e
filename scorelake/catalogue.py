"""Registered queries and the SQL that they are held against.

Play-by-play queries run on the driver's event table, turned into nested
documents and parsed again. Their SQL takes the expected values from the events'
attributes and never parses a text.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from .functions.text import clock_seconds, event_type, person_name
from .operators import gold, grams, pages, silver
from .operators.fingerprint import fingerprint
from .operators.scan import scan
from .operators.teams import metadata_labels
from .plans import pipeline, store
from .plans.serving import ROLES, Catalog
from .sources import files, synth
from .sources.documents import snapshot_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: The plays of the event table with their expected values.
EXPECTED = """
WITH ev AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS seq, event_id AS e FROM events
), base AS (
  SELECT user_id AS contest_id, seq, e, event_type AS k, CAST(1 + least(4, (seq - 1) // 16) AS INTEGER) AS period_number,
         (seq - 1) % 16 AS nth, e % 2 = 0 AS is_home, 2 * user_id + 1000 AS home_id, 2 * user_id + 1001 AS away_id,
         CASE WHEN user_id % 4 = 0 THEN 'Lake ' ELSE '' END AS place FROM ev
), timed AS (
  SELECT *, CASE WHEN period_number < 5 THEN 900 - nth * 50 - e % 40 ELSE greatest(0, 240 - (seq - 65) * 6) END AS secs FROM base
), clocked AS (
  SELECT *, coalesce(first_value(CASE WHEN e % 3 <> 0 THEN secs END IGNORE NULLS) OVER (PARTITION BY contest_id, period_number ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS filled,
         sum(CASE WHEN k = 'purchase' AND is_home THEN 1 ELSE 0 END) OVER (PARTITION BY contest_id ORDER BY seq) AS hs,
         sum(CASE WHEN k = 'purchase' AND NOT is_home THEN 1 ELSE 0 END) OVER (PARTITION BY contest_id ORDER BY seq) AS vs,
         first_value(CASE WHEN e % 3 <> 0 THEN 1 END IGNORE NULLS) OVER (PARTITION BY contest_id, period_number ORDER BY seq ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS any_clock FROM timed
), typed AS (
  SELECT *, CASE WHEN k = 'purchase' THEN 'GOAL' WHEN k = 'view' THEN 'SHOT' WHEN k = 'error' AND e % 3 = 0 THEN 'PENALTY' WHEN k = 'error' THEN 'TURNOVER'
                 WHEN k = 'click' AND e % 3 = 0 THEN 'CLEAR' WHEN k = 'click' THEN 'GROUND_BALL' WHEN e % 4 = 0 THEN 'TIMEOUT' ELSE 'FACEOFF' END AS event_type,
         CASE WHEN is_home THEN home_id ELSE away_id END AS team_id, CASE WHEN is_home THEN away_id ELSE home_id END AS opponent_team_id,
         place || CASE WHEN is_home THEN 'H' ELSE 'A' END || contest_id AS event_team_short FROM clocked
), possessed AS (
  SELECT *, CASE WHEN event_type IN ('GOAL', 'SHOT', 'TURNOVER', 'FACEOFF', 'GROUND_BALL', 'CLEAR') THEN team_id END AS possession_team_id FROM typed
), taken AS (
  SELECT contest_id, bool_or(is_home) AS hal_home, bool_or(NOT is_home) FILTER (WHERE contest_id % 10 = 0) AS hal_away, bool_or(NOT is_home) FILTER (WHERE contest_id % 10 <> 0) AS ian_away
  FROM typed WHERE event_type = 'GROUND_BALL' AND e % 7 = 0 GROUP BY contest_id
), roster AS (
  SELECT contest_id, CASE WHEN hal_home AND hal_away THEN 0 WHEN hal_home THEN 1 WHEN hal_away THEN 2 END AS hal, CASE WHEN ian_away THEN 2 END AS ian FROM taken
), ahead AS (
  SELECT *, first_value(possession_team_id IGNORE NULLS) OVER (PARTITION BY contest_id, period_number ORDER BY seq ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_possession FROM possessed
), plays AS (
  SELECT contest_id || '_' || seq AS play_id, contest_id, CAST(seq AS INTEGER) AS play_seq, '20260101T000000Z' AS ingest_timestamp, period_number,
    CASE WHEN period_number < 5 THEN 'P' || period_number ELSE 'OT' END AS period_display,
    CASE WHEN any_clock IS NULL THEN '0:00' ELSE (filled // 60) || ':' || lpad(CAST(filled % 60 AS VARCHAR), 2, '0') END AS clock_display,
    CAST(filled AS INTEGER) AS period_seconds_remaining,
    CAST(CASE WHEN period_number <= 4 THEN (period_number - 1) * 900 + 900 - filled ELSE 3600 + 240 - filled END AS INTEGER) AS game_seconds_elapsed,
    CAST(greatest(0, 3600 - CASE WHEN period_number <= 4 THEN (period_number - 1) * 900 + 900 - filled ELSE 3600 + 240 - filled END) AS INTEGER) AS game_seconds_remaining_reg,
    event_type, team_id, event_team_short, is_home AS event_team_is_home, opponent_team_id, possession_team_id,
    CASE event_type WHEN 'GOAL' THEN 'Kim ' || e % 7 || ' Able' WHEN 'SHOT' THEN 'Kim ' || e % 7 || ' Able' WHEN 'PENALTY' THEN 'Kim ' || e % 7 || ' Cole'
                    WHEN 'TURNOVER' THEN CASE WHEN e % 8 = 2 THEN 'TEAM' ELSE 'Kim ' || e % 7 || ' Dane' END
                    WHEN 'GROUND_BALL' THEN CASE WHEN e % 7 <> 0 THEN 'Kim ' || e % 7 || ' Ford' WHEN is_home OR contest_id % 10 = 0 THEN 'Hal Hale' ELSE 'Ian Ives' END END AS primary_player_name,
    CASE WHEN event_type = 'GOAL' AND e % 10 = 0 THEN 'Bo Bond Jr' WHEN event_type = 'GOAL' AND e % 5 = 0 THEN 'Bo Bond' WHEN event_type = 'SHOT' AND e % 7 = 5 THEN 'Gus Gale' END AS secondary_player_name,
    CASE WHEN event_type = 'TURNOVER' AND e % 4 < 2 THEN 'Eli Eads' END AS caused_by_player_name,
    CASE WHEN event_type = 'TURNOVER' AND e % 4 < 2 THEN opponent_team_id END AS caused_by_team_id,
    CASE WHEN event_type = 'GOAL' THEN 'GOAL' WHEN event_type = 'SHOT' THEN ['WIDE', 'HIGH', 'POST', 'CROSSBAR', 'BLOCKED', 'SAVE', NULL][CAST(e % 7 + 1 AS INTEGER)] END AS shot_result,
    CASE WHEN event_type = 'SHOT' THEN coalesce(possession_team_id = next_possession, false) END AS shot_possession_retained,
    CASE WHEN event_type = 'FACEOFF' AND coalesce(hal, -1) <> 0 AND (hal IS NOT NULL OR ian IS NOT NULL) THEN
      CASE WHEN coalesce(hal, 3 - ian) = 3 - coalesce(ian, 3 - hal) THEN CASE WHEN is_home = (coalesce(hal, 3 - ian) = 1) THEN 'Hal Hale' ELSE 'Ian Ives' END END END AS faceoff_winner_player,
    CASE WHEN event_type = 'FACEOFF' AND coalesce(hal, -1) <> 0 AND (hal IS NOT NULL OR ian IS NOT NULL) THEN
      CASE WHEN coalesce(hal, 3 - ian) = 3 - coalesce(ian, 3 - hal) THEN CASE WHEN is_home = (coalesce(hal, 3 - ian) = 1) THEN 'Ian Ives' ELSE 'Hal Hale' END END END AS faceoff_loser_player,
    CASE WHEN event_type = 'FACEOFF' THEN false END AS is_faceoff_violation,
    CASE WHEN event_type = 'PENALTY' THEN 'SLASHING' END AS penalty_type, CAST(CASE WHEN event_type = 'PENALTY' THEN 90 END AS INTEGER) AS penalty_duration_seconds,
    CASE WHEN event_type = 'PENALTY' THEN e % 4 = 0 END AS is_extra_man_opportunity,
    CASE WHEN event_type = 'CLEAR' THEN CASE WHEN e % 2 = 0 THEN 'GOOD' ELSE 'FAILED' END END AS clear_result,
    CAST(hs AS INTEGER) AS running_home_score, CAST(vs AS INTEGER) AS running_visitor_score, CAST(hs - vs AS INTEGER) AS home_score_margin,
    CAST(CASE WHEN is_home THEN hs - vs ELSE vs - hs END AS INTEGER) AS event_team_margin, e, home_id, away_id
  FROM ahead LEFT JOIN roster USING (contest_id)
), teams AS (
  SELECT *, CASE WHEN (team_id - 1000) // 2 % 4 = 0 THEN 'Lake ' ELSE '' END || code AS name_short FROM (
    SELECT DISTINCT unnest([home_id, away_id]) AS team_id, unnest(['H' || contest_id, 'A' || contest_id]) AS code, CASE WHEN contest_id % 2 = 0 THEN '#112233' END AS color FROM plays)
), rates AS (
  SELECT shot_result, 1 - count(*) FILTER (WHERE shot_possession_retained) / count(*) AS rate FROM plays WHERE event_type = 'SHOT' AND shot_result IS NOT NULL GROUP BY 1
), overall AS (
  SELECT 1 - count(*) FILTER (WHERE shot_possession_retained) / count(*) AS rate FROM plays WHERE event_type = 'SHOT'
), rated AS (
  SELECT plays.*, CASE WHEN event_type = 'SHOT' THEN coalesce(rates.rate, overall.rate) ELSE 0 END AS loss FROM plays LEFT JOIN rates USING (shot_result) CROSS JOIN overall
), scored AS (
  SELECT *, event_type = 'SHOT' AS shot, event_type = 'GOAL' AS goal FROM rated
)
"""
_PLAYS = "play_id, contest_id, play_seq, ingest_timestamp, period_number, period_display, clock_display, period_seconds_remaining, game_seconds_elapsed, game_seconds_remaining_reg, event_type, team_id, event_team_short, event_team_is_home, opponent_team_id, possession_team_id, primary_player_name, secondary_player_name, caused_by_player_name, caused_by_team_id, shot_result, shot_possession_retained, faceoff_winner_player, faceoff_loser_player, is_faceoff_violation, penalty_type, penalty_duration_seconds, is_extra_man_opportunity, clear_result, running_home_score, running_visitor_score, home_score_margin, event_team_margin"
_MEASURES = """count(*) FILTER (WHERE shot OR goal) AS total_shots, count(*) FILTER (WHERE goal) AS goals, count(*) FILTER (WHERE shot AND shot_possession_retained) AS shots_retained,
  count(*) FILTER (WHERE shot AND NOT shot_possession_retained) AS realized_shots_lost, round(sum(loss), 4) AS normalized_shots_lost,
  count(*) FILTER (WHERE goal OR (shot AND NOT shot_possession_retained)) AS realized_shot_possessions_used, round(count(*) FILTER (WHERE goal) + sum(loss), 4) AS normalized_shot_possessions_used,
  coalesce(round(count(*) FILTER (WHERE goal) / nullif(count(*) FILTER (WHERE shot OR goal), 0), 4), 0) AS shooting_pct,
  coalesce(round(count(*) FILTER (WHERE goal) / nullif(count(*) FILTER (WHERE goal OR (shot AND NOT shot_possession_retained)), 0), 4), 0) AS realized_shooting_efficiency,
  coalesce(round(count(*) FILTER (WHERE goal) / nullif(count(*) FILTER (WHERE goal) + sum(loss), 0), 4), 0) AS normalized_shooting_efficiency"""


def query(sql: str | None = None) -> Callable:
    """Register a query under its function's name, with its SQL."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows from which on another task is worth its while where a row makes much work of few bytes.
TASK_ROWS = 100_000


#: Rows of a part where a table is laid out anew.
PART_ROWS = 1_000_000


def spread(rows: DataFrame) -> DataFrame:
    """rows in a task per TASK_ROWS, where a small file would be one task's work, or a few."""
    tasks = -(-rows.count() // TASK_ROWS)
    return rows.repartition(tasks) if tasks > 1 else rows


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return synth.event_documents(read(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type"))


def tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The four tables of the generation that the event table gives."""
    docs = documents(spark, sf_dir)
    plays = silver.plays_of(docs)
    dim_teams, dim_contests = gold.dimensions(silver.contests_of(docs))
    return {"dim_teams": dim_teams, "dim_contests": dim_contests, "fact_plays": gold.fact_plays(plays, dim_teams), "agg_team_game_stats": gold.team_game_stats(plays, dim_teams)}


def lake(spark: SparkSession) -> str:
    """A new folder in the place that the cluster shares: spark.checkpoint.dir, or else the session's warehouse."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{shared.rstrip('/')}/scorelake-{uuid.uuid4().hex}"


def tidy(spark: SparkSession, root: str, *names: str) -> None:
    """Delete what a result doesn't read any more; raw: snapshot files."""
    for name in names:
        if name.startswith("raw"):
            synth.remove_folder(spark, f"{root}/{name}")
        else:
            files.remove(files.place(f"{root}/{name}"))


def catalog(spark: SparkSession, sf_dir: str) -> Catalog:
    return Catalog(spark, tables(spark, sf_dir))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables(spark, sf_dir)["agg_team_game_stats"]


@query(EXPECTED + f"SELECT {_PLAYS} FROM plays")
def silver_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of the parsed plays but the text they come from."""
    return silver.plays_of(documents(spark, sf_dir)).drop("play_text")


@query(EXPECTED + f"SELECT {_PLAYS} FROM plays")
def stored_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots as JSON files, read by a manifest, stored, half of the contests replaced; the play table as it is then."""
    root = lake(spark)
    snapshots = snapshot_table(spark, synth.write_parts(documents(spark, sf_dir), f"{root}/raw")).coalesce(spark.sparkContext.defaultParallelism).persist(StorageLevel.DISK_ONLY)
    table = f"{root}/silver_plays"
    store.replace_keys(spark, table, silver.silver_plays(spark, snapshots), "contest_id", None)
    again = snapshots.filter("contest_id % 2 = 0")
    if not again.isEmpty():
        store.replace_keys(spark, table, silver.silver_plays(spark, again), "contest_id", again.select("contest_id"))
    snapshots.unpersist()
    tidy(spark, root, "raw")
    return store.read_table(spark, table).drop("play_text")


@query(EXPECTED + f"SELECT {_PLAYS}, color, 'Club ' || code AS name_full FROM plays JOIN teams USING (team_id)")
def published_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole batch plan over JSON snapshots; facts of the published generation."""
    root = lake(spark)
    manifest = synth.write_parts(documents(spark, sf_dir), f"{root}/raw")
    pipeline.run(spark, manifest, f"{root}/tables")
    tidy(spark, root, "raw", "tables/silver_plays", "tables/silver_contests", "tables/play_counts")
    return Catalog.open(spark, f"{root}/tables/gold").fact_plays.drop("play_text")


@query(EXPECTED + f"SELECT {_PLAYS} FROM plays WHERE contest_id = 3")
def stored_contest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays of one contest out of a stored table of all; statistics rule out all files but its own."""
    table = f"{lake(spark)}/silver_plays"
    store.replace_keys(spark, table, silver.plays_of(documents(spark, sf_dir)), "contest_id", None, files=8)
    return store.read_table(spark, table, where={"contest_id": 3}).drop("play_text")


@query(EXPECTED + f"""SELECT {_PLAYS.replace("ingest_timestamp", "CASE WHEN contest_id % 3 = 0 THEN '20260202T000000Z' ELSE ingest_timestamp END AS ingest_timestamp")},
  'Game ' || contest_id || CASE WHEN contest_id % 3 = 0 THEN ' (again)' ELSE '' END AS title, 'Club ' || code AS name_full FROM plays JOIN teams USING (team_id)""")  # fmt: skip
def refreshed_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch plan twice; between its runs a third of the contests get a second snapshot with another title."""
    root, docs = lake(spark), documents(spark, sf_dir)
    first = synth.write_parts(docs, f"{root}/raw")
    pipeline.run(spark, first, f"{root}/tables")
    again = docs.filter("contest_id % 3 = 0").withColumns({"ingest_timestamp": F.lit("20260202T000000Z"), "title": F.concat("title", F.lit(" (again)"))})
    pipeline.run(spark, [first, synth.write_parts(again, f"{root}/raw-again")], f"{root}/tables")
    tidy(spark, root, "raw", "raw-again", "tables/silver_plays", "tables/silver_contests", "tables/play_counts")
    found = Catalog.open(spark, f"{root}/tables/gold")
    return found.fact_plays.join(found.dim_contests.select("contest_id", "title"), "contest_id").drop("play_text", "color")


@query("SELECT l_suppkey AS contest_id, l_orderkey, l_linenumber, CASE WHEN l_suppkey % 10 = 0 THEN -l_quantity ELSE l_quantity END AS quantity FROM lineitem")
def maintained_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines stored by supplier, a tenth of the suppliers replaced one batch after another; small files merged, old ones deleted, the rest verified."""
    table = f"{lake(spark)}/lines"
    lines = read(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("contest_id"), "l_orderkey", "l_linenumber", F.col("l_quantity").alias("quantity"))
    store.replace_keys(spark, table, lines, "contest_id", None)
    tenth = lines.filter("contest_id % 10 = 0").withColumn("quantity", -F.col("quantity"))
    keys = sorted(r[0] for r in tenth.select("contest_id").distinct().collect())  # suppliers
    for k in range(3):
        store.replace_keys(spark, table, tenth.filter((F.col("contest_id") / 10) % 3 == k), "contest_id", [x for x in keys if x // 10 % 3 == k])
    store.compact(spark, table, "contest_id", least=2)
    store.vacuum(table, keep_seconds=0)
    if damaged := store.verify(spark, table):
        raise ValueError(f"files differ from what was written: {damaged}")
    return store.read_table(spark, table)


@query(EXPECTED + "SELECT contest_id, '20260101T000000Z' AS ingest_timestamp, 'Game ' || contest_id AS title, 'final' AS status, home_id || ':' || place || 'H' || contest_id || ',' || away_id || ':' || place || 'A' || contest_id AS teams FROM (SELECT DISTINCT contest_id, home_id, away_id, place FROM base)")
def silver_contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contests with their teams, as text."""
    shown = F.array_join(F.transform("teams", lambda t: F.concat(t["team_id"].cast("string"), F.lit(":"), t["name_short"])), ",")
    return silver.contests_of(documents(spark, sf_dir)).withColumn("teams", shown)


@query(EXPECTED + "SELECT team_id, name_short, 'Club ' || code AS name_full, code || 'X' AS name_6char, lower(code) AS seoname, color FROM teams")
def dim_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest metadata of each team."""
    return gold.dimensions(silver.contests_of(documents(spark, sf_dir)))[0]


@query(EXPECTED + "SELECT DISTINCT contest_id, 'Game ' || contest_id AS title, 'final' AS status FROM plays")
def dim_contests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest metadata of each contest."""
    return gold.dimensions(silver.contests_of(documents(spark, sf_dir)))[1]


@query(EXPECTED + f"SELECT {_PLAYS}, color, 'Club ' || code AS name_full FROM plays JOIN teams USING (team_id)")
def fact_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plays with colour and full name of their team."""
    return tables(spark, sf_dir)["fact_plays"].drop("play_text")


@query(EXPECTED + """, picked AS (
  SELECT contest_id, opponent_team_id AS team_id, count(*) AS n FROM plays WHERE event_type = 'FACEOFF' AND e % 4 = 1 GROUP BY ALL
), own AS (
  SELECT contest_id, team_id, count(*) FILTER (WHERE shot OR goal) AS total_shots, count(*) FILTER (WHERE goal) AS goals, count(*) FILTER (WHERE shot AND shot_possession_retained) AS shots_retained,
    count(*) FILTER (WHERE shot AND NOT shot_possession_retained) AS realized_shots_lost, round(sum(loss) FILTER (WHERE shot), 4) AS normalized_shots_lost,
    count(*) FILTER (WHERE shot_result = 'SAVE') AS saves_faced, count(*) FILTER (WHERE event_type = 'GROUND_BALL') AS gb, count(*) FILTER (WHERE event_type = 'TURNOVER') AS turnovers,
    count(*) FILTER (WHERE clear_result = 'GOOD') AS clears_good, count(*) FILTER (WHERE clear_result = 'FAILED') AS clears_failed, count(*) FILTER (WHERE event_type = 'PENALTY') AS penalties,
    CAST(sum(penalty_duration_seconds) AS BIGINT) AS penalty_seconds FROM scored GROUP BY ALL
), stats AS (
  SELECT coalesce(own.contest_id, picked.contest_id) AS contest_id, coalesce(own.team_id, picked.team_id) AS team_id, own.* EXCLUDE (contest_id, team_id, gb),
    coalesce(gb, 0) + coalesce(n, 0) AS ground_balls FROM own FULL JOIN picked ON own.contest_id = picked.contest_id AND own.team_id = picked.team_id
), used AS (SELECT *, goals + realized_shots_lost AS realized_shot_possessions_used, round(goals + normalized_shots_lost, 4) AS normalized_shot_possessions_used FROM stats)
SELECT used.*, coalesce(round(goals / nullif(total_shots, 0), 4), 0) AS shooting_pct, coalesce(round(goals / nullif(realized_shot_possessions_used, 0), 4), 0) AS realized_shooting_efficiency,
  coalesce(round(goals / nullif(normalized_shot_possessions_used, 0), 4), 0) AS normalized_shooting_efficiency, name_short AS team_short FROM used JOIN teams USING (team_id)
""")  # fmt: skip
def team_game_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of each team in each contest."""
    return flagship(spark, sf_dir)


@query(EXPECTED + f"SELECT {_PLAYS} FROM plays WHERE event_type IN ('SHOT', 'GOAL') AND period_number >= 2 AND period_seconds_remaining <= 600 AND event_team_margin BETWEEN -3 AND 3 AND (primary_player_name ILIKE '%kim 3%' OR secondary_player_name ILIKE '%kim 3%') ORDER BY game_seconds_elapsed DESC NULLS LAST, contest_id, play_seq, play_id LIMIT 60 OFFSET 20")
def plays_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of filtered plays in a total order; the limit is the page."""
    page = catalog(spark, sf_dir).plays(event_types=["shot", "goal"], min_period=2, max_period_seconds_remaining=600, event_team_margin_min=-3, event_team_margin_max=3, player_name="kim 3", order_by="game_seconds_elapsed", order_desc=True, limit=60, offset=20)
    return page.drop("play_text", "color", "name_full")


@query(EXPECTED + f"SELECT {_PLAYS} FROM plays WHERE event_team_short = 'H3' OR team_id = 1006 OR caused_by_team_id = 1006 ORDER BY play_seq, contest_id, play_id LIMIT 500")
def plays_of_team_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of the plays of a team by its code, in either role."""
    return catalog(spark, sf_dir).plays(team="h3", limit=500).drop("play_text", "color", "name_full")


@query(EXPECTED + f"SELECT {_PLAYS} FROM plays JOIN teams USING (team_id) WHERE 'Club ' || code ILIKE '%club h1%' OR caused_by_team_id IN (SELECT team_id FROM teams WHERE 'Club ' || code ILIKE '%club h1%') ORDER BY play_seq, contest_id, play_id LIMIT 500")
def plays_of_team_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of the plays of all teams with a text in their names."""
    return catalog(spark, sf_dir).plays(team="club h1", limit=500).drop("play_text", "color", "name_full")


@query(EXPECTED + f"SELECT {_PLAYS} FROM plays WHERE event_team_short = 'H3' OR team_id = 1006 OR caused_by_team_id = 1006 ORDER BY play_seq, contest_id, play_id")
def all_plays_of_team_code(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All plays of a team by its code, in either role."""
    return catalog(spark, sf_dir).plays(team="h3", limit=None).drop("play_text", "color", "name_full")


@query(EXPECTED + f"SELECT {_PLAYS} FROM plays JOIN teams USING (team_id) WHERE 'Club ' || code ILIKE '%club h1%' OR caused_by_team_id IN (SELECT team_id FROM teams WHERE 'Club ' || code ILIKE '%club h1%') ORDER BY play_seq, contest_id, play_id")
def all_plays_of_team_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All plays of all teams with a text in their names."""
    return catalog(spark, sf_dir).plays(team="club h1", limit=None).drop("play_text", "color", "name_full")


@query(EXPECTED + f"SELECT {_PLAYS} FROM plays WHERE primary_player_name ILIKE '%im 3 a%' OR secondary_player_name ILIKE '%im 3 a%' OR caused_by_player_name ILIKE '%im 3 a%' OR faceoff_winner_player ILIKE '%im 3 a%' OR faceoff_loser_player ILIKE '%im 3 a%'")
def plays_by_part_of_a_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All plays with a part of a player's name, by a stored index of trigrams; files of other contests aren't opened."""
    root = lake(spark)
    store.replace_keys(spark, f"{root}/plays", silver.plays_of(documents(spark, sf_dir)), "contest_id", None)
    plays = store.read_table(spark, f"{root}/plays")
    store.replace_keys(spark, f"{root}/grams", grams.index_of(plays, list(ROLES), "contest_id"), "gram", None)
    index = store.read_table(spark, f"{root}/grams", keys=("gram", grams.wanted(plays, "im 3 a")))
    return grams.search(plays, index, list(ROLES), "contest_id", "im 3 a").drop("play_text")


@query("SELECT p_partkey, p_name FROM part WHERE p_name ILIKE '%a_n%ed%' OR p_type ILIKE '%a_n%ed%' OR p_name ILIKE '%red%' OR p_type ILIKE '%red%'")
def parts_by_part_of_a_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts by pieces of their names and types; one pattern has wildcards within, and too few letters for the index."""
    parts = read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type")
    index = grams.index_of(parts, ["p_name", "p_type"], "p_partkey")
    found = [grams.search(parts, index, ["p_name", "p_type"], "p_partkey", x) for x in ("a_n%ed", "red")]
    return found[0].union(found[1]).select("p_partkey", "p_name").distinct()


@query(EXPECTED + """SELECT play_id, contest_id, play_seq, period_number, clock_display, period_seconds_remaining, primary_player_name AS turnover_committer, event_team_short AS turnover_team,
  caused_by_player_name AS caused_by_player, caused_by_team_id, running_home_score, running_visitor_score, event_team_margin AS committer_team_margin, -event_team_margin AS defending_team_margin
FROM plays WHERE event_type = 'TURNOVER' AND caused_by_player_name IS NOT NULL AND period_number >= 4 AND event_team_margin = 1 ORDER BY play_seq, contest_id, play_id LIMIT 50""")  # fmt: skip
def caused_turnovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turnovers caused by teams that are one goal down, from the fourth period on."""
    return catalog(spark, sf_dir).caused_turnovers(defending_team_down_by=1).drop("play_text")


@query(EXPECTED + f"SELECT {_MEASURES} FROM scored WHERE shot OR goal")
def shooting_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pooled shooting measures."""
    return catalog(spark, sf_dir).shooting_overall()


@query(EXPECTED + """SELECT b.shot_result, coalesce(total_shots, 0) AS total_shots, coalesce(shots_retained, 0) AS shots_retained, coalesce(total_shots - shots_retained, 0) AS shots_lost, coalesce(round(shots_retained / total_shots, 4), 0) AS retention_rate
FROM (VALUES ('SAVE'), ('WIDE'), ('HIGH'), ('HIT POST'), ('HIT CROSSBAR'), ('BLOCKED')) b(shot_result) LEFT JOIN (
  SELECT CASE shot_result WHEN 'POST' THEN 'HIT POST' WHEN 'CROSSBAR' THEN 'HIT CROSSBAR' ELSE shot_result END AS shot_result, count(*) AS total_shots, count(*) FILTER (WHERE shot_possession_retained) AS shots_retained
  FROM plays WHERE event_type = 'SHOT' GROUP BY 1) c USING (shot_result)""")  # fmt: skip
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Retention of six shot results, also of those without shots."""
    return catalog(spark, sf_dir).retention()


@query(EXPECTED + f"SELECT primary_player_name AS player_name, team_id, name_short AS team_name, {_MEASURES} FROM scored JOIN teams USING (team_id) WHERE shot OR goal GROUP BY ALL HAVING count(*) >= 3 ORDER BY realized_shooting_efficiency DESC, goals DESC, total_shots DESC, player_name, team_id LIMIT 25")
def top_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The players that need fewest possessions for a goal; the limit is the board."""
    return catalog(spark, sf_dir).top_players(min_shots=3, limit=25)


@query(EXPECTED + f"""SELECT team_id, 'Club ' || code AS team_name_full, {_MEASURES}, count(DISTINCT contest_id) AS games_played, array_to_string(list_sort(list(DISTINCT event_team_short)), ',') AS team_short_names, name_short AS team_name
FROM scored JOIN teams USING (team_id) GROUP BY team_id, name_short, code ORDER BY normalized_shooting_efficiency DESC, goals DESC, total_shots DESC, team_name, team_id LIMIT 25""")  # fmt: skip
def top_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The teams that need fewest expected possessions for a goal; the limit is the board."""
    return catalog(spark, sf_dir).top_teams(limit=25, order_by="normalized").withColumn("team_short_names", F.array_join("team_short_names", ","))


@query("SELECT doc_id, CAST(count(*) AS BIGINT) AS words, CAST(count(DISTINCT w) AS BIGINT) AS different, min(w) AS first_word FROM (SELECT doc_id, unnest(string_split_regex(trim(text), '[ \\n]+')) AS w FROM documents WHERE text IS NOT NULL) GROUP BY doc_id")
def words_of_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words by unnesting."""
    words = read(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split(F.trim("text"), "[ \n]+")).alias("at", "w"))
    return words.groupBy("doc_id").agg(F.count("*").alias("words"), F.count_distinct("w").alias("different"), F.min("w").alias("first_word"))


@query("SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) AS k FROM orders) WHERE k = 1")
def latest_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest row of each key."""
    return gold.keep_latest(read(spark, sf_dir, "orders"), "o_custkey", ["o_orderkey", "o_orderdate", "o_totalprice"], time="o_orderdate", source="o_orderkey")


@query("""SELECT c.n_name AS customer_nation, s.n_name AS supplier_nation, count(*) AS lines, sum(l_quantity) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
LEFT JOIN nation c ON c_nationkey = c.n_nationkey LEFT JOIN nation s ON s_nationkey = s.n_nationkey GROUP BY ALL""")  # fmt: skip
def nations_trade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One dimension in two roles."""
    t = lambda n: read(spark, sf_dir, n)
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    for key, name in (("c_nationkey", "customer_nation"), ("s_nationkey", "supplier_nation")):
        lines = lines.join(t("nation").select(F.col("n_nationkey").alias(f"_{key}"), F.col("n_name").alias(name)), F.col(key) == F.col(f"_{key}"), "left")
    return lines.groupBy("customer_nation", "supplier_nation").agg(F.count("*").alias("lines"), F.sum("l_quantity").alias("quantity"))


@query("SELECT l_returnflag, l_linestatus, count(*) AS lines, count(*) FILTER (WHERE l_quantity > a.q) AS above, sum(CASE WHEN l_quantity > a.q THEN l_quantity END) AS above_quantity FROM lineitem CROSS JOIN (SELECT avg(l_quantity) AS q FROM lineitem) a GROUP BY ALL")
def above_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conditional aggregates against a scalar."""
    lines = read(spark, sf_dir, "lineitem")
    mean = lines.agg(F.avg("l_quantity").alias("q"))
    above = F.col("l_quantity") > F.col("q")
    return lines.crossJoin(F.broadcast(mean)).groupBy("l_returnflag", "l_linestatus").agg(F.count("*").alias("lines"), F.count_if(above).alias("above"), F.sum(F.when(above, F.col("l_quantity"))).alias("above_quantity"))


@query("SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) OR c_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 1)")
def customers_to_visit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semi and anti joins under a disjunction."""
    customers, orders, nations = (read(spark, sf_dir, n) for n in ("customer", "orders", "nation"))
    idle = customers.join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")
    near = customers.join(nations.filter("n_regionkey = 1"), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey", "c_name")
    return idle.unionByName(near).distinct()


@query("SELECT 'order' AS kind, o_orderkey AS key, o_totalprice AS price, CAST(NULL AS DOUBLE) AS quantity FROM orders UNION ALL SELECT 'line', l_orderkey, NULL, l_quantity FROM lineitem")
def orders_and_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Union by name with missing columns."""
    orders = read(spark, sf_dir, "orders").select(F.lit("order").alias("kind"), F.col("o_orderkey").alias("key"), F.col("o_totalprice").alias("price"))
    lines = read(spark, sf_dir, "lineitem").select(F.lit("line").alias("kind"), F.col("l_orderkey").alias("key"), F.col("l_quantity").alias("quantity"))
    return orders.unionByName(lines, allowMissingColumns=True)


@query("(SELECT l_orderkey, l_partkey FROM lineitem WHERE l_quantity < 30 EXCEPT ALL SELECT l_orderkey, l_partkey FROM lineitem WHERE l_discount < 0.05) UNION ALL (SELECT l_orderkey, l_partkey FROM lineitem WHERE l_discount < 0.05 EXCEPT ALL SELECT l_orderkey, l_partkey FROM lineitem WHERE l_quantity < 30)")
def symmetric_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of either side that the other lacks, with their number."""
    lines = read(spark, sf_dir, "lineitem")
    few, cheap = (lines.filter(c).select("l_orderkey", "l_partkey") for c in ("l_quantity < 30", "l_discount < 0.05"))
    return few.exceptAll(cheap).unionAll(cheap.exceptAll(few))


@query("SELECT p_partkey, 'Kim ' || p_size || ' ' || p_brand AS person, CASE WHEN p_size % 2 = 0 THEN p_size * 60 + 5 ELSE 0 END AS seconds, CASE p_size % 3 WHEN 0 THEN 'GOAL' WHEN 1 THEN 'GOALIE_CHANGE' ELSE 'UNKNOWN' END AS kind FROM part")
def parsed_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names, clocks and event types on generated text."""
    size = F.col("p_size").cast("string")
    raw = F.concat(F.lit("  "), F.col("p_brand"), F.lit("  ,  Kim "), size)
    clock = F.when(F.col("p_size") % 2 == 0, F.concat(size, F.lit(":05"))).otherwise(size)
    text = F.when(F.col("p_size") % 3 == 0, "GOAL by X Kim.").when(F.col("p_size") % 3 == 1, "Kim at goalie for X.").otherwise("goal by X Kim.")
    return read(spark, sf_dir, "part").select("p_partkey", person_name(raw).alias("person"), clock_seconds(clock).alias("seconds"), event_type(text).alias("kind"))


@query("""SELECT c_custkey, array_to_string(list_sort(list_distinct([n, 'B' || left(upper(c_mktsegment), 1) || 'C', upper(c_mktsegment), left(upper(c_mktsegment), 1)] || list_transform(range(3, length(n) + 1), lambda k: rtrim(left(n, CAST(k AS INTEGER)))))), '|') AS labels
FROM (SELECT *, 'BY ' || upper(c_mktsegment) || ' ' || upper(c_name) AS n FROM customer)""")  # fmt: skip
def label_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels that names suggest."""
    full = F.concat(F.lit("By "), F.col("c_mktsegment"), F.lit("  "), F.col("c_name"), F.lit(". "))
    labels = metadata_labels(full, F.col("c_mktsegment"), full)
    names = spread(read(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_name"))
    return names.select("c_custkey", F.array_join(F.sort_array(labels), "|").alias("labels"))


@query("""SELECT event_id, coalesce(last_value(CASE WHEN event_id % 5 = 0 THEN value END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0) AS last_known,
  first_value(CASE WHEN event_type = 'click' THEN event_id END IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_click FROM events""")  # fmt: skip
def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fills and look-ahead over an order, in blocks where a user has many events."""
    events = read(spark, sf_dir, "events").select("event_id", "user_id", "ts", F.when(F.col("event_id") % 5 == 0, F.col("value")).alias("known"), F.when(F.col("event_type") == "click", F.col("event_id")).alias("click"))
    scanned = scan(events, ["user_id"], ["ts", "event_id"], last={"last_known": "known"}, following={"next_click": "click"})
    return scanned.select("event_id", F.coalesce("last_known", F.lit(0.0)).alias("last_known"), "next_click")


@query("""SELECT l_linestatus, l_orderkey, l_linenumber, row_number() OVER w AS place,
  last_value(CASE WHEN l_quantity >= 45 THEN l_orderkey END IGNORE NULLS) OVER (PARTITION BY l_linestatus ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS last_large,
  first_value(CASE WHEN l_returnflag = 'R' THEN l_orderkey END IGNORE NULLS) OVER (PARTITION BY l_linestatus ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS next_returned
FROM lineitem WINDOW w AS (PARTITION BY l_linestatus ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey)""")  # fmt: skip
def scanned_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """W1-W5 where a key holds a large share of all rows: lines by their status, in blocks of 10,000 in the order of shipping."""
    lines = read(spark, sf_dir, "lineitem").select("l_linestatus", "l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_quantity") >= 45, F.col("l_orderkey")).alias("large"), F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")).alias("returned"))
    scanned = scan(lines, ["l_linestatus"], ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"], number="place", last={"last_large": "large"}, following={"next_returned": "returned"}, block=10_000)
    return scanned.select("l_linestatus", "l_orderkey", "l_linenumber", "place", "last_large", "next_returned")


@query("SELECT user_id, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS kinds, count(*) AS n FROM events GROUP BY user_id HAVING n >= 40")
def kinds_of_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct values as a sorted text, groups of a size."""
    return read(spark, sf_dir, "events").groupBy("user_id").agg(F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kinds"), F.count("*").alias("n")).filter("n >= 40")


@query("SELECT o_orderkey, o_orderpriority, o_totalprice FROM orders ORDER BY o_orderpriority DESC NULLS LAST, o_orderkey LIMIT 40 OFFSET 100")
def orders_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page of a total order."""
    return read(spark, sf_dir, "orders").orderBy(F.col("o_orderpriority").desc_nulls_last(), F.col("o_orderkey").asc_nulls_last()).offset(100).limit(40).select("o_orderkey", "o_orderpriority", "o_totalprice")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC NULLS LAST, l_orderkey, l_linenumber, l_partkey LIMIT 50 OFFSET (SELECT count(*) // 2 FROM lineitem)")
def deep_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page in the middle of a total order, found by order statistics; the limit is the page."""
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
    return pages.page(lines, "l_extendedprice", ["l_orderkey", "l_linenumber", "l_partkey"], descending=True, offset=lines.count() // 2, limit=50)


@query(EXPECTED + f"SELECT {_PLAYS} FROM plays ORDER BY game_seconds_elapsed DESC NULLS LAST, contest_id, play_seq, play_id LIMIT 60 OFFSET (SELECT count(*) // 2 FROM plays)")
def plays_page_in_the_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page at an offset of half of all plays of a published generation; the limit is the page."""
    root = lake(spark)
    store.publish(spark, tables(spark, sf_dir), root)
    found = Catalog.open(spark, root)
    return found.plays(order_by="game_seconds_elapsed", order_desc=True, limit=60, offset=found.fact_plays.count() // 2).drop("play_text", "color", "name_full")


@query("SELECT l_returnflag, count(*) AS lines, count(DISTINCT l_orderkey) AS orders FROM lineitem GROUP BY ALL")
def table_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts; the fingerprints of each group as a multiset must agree between two layouts of the table."""
    lines = read(spark, sf_dir, "lineitem")
    mark = fingerprint(lines.columns).alias("mark")
    parts = max(7, -(-lines.count() // PART_ROWS))
    other = lines.repartition(parts, "l_suppkey").groupBy("l_returnflag").agg(mark)
    return lines.groupBy("l_returnflag").agg(F.count("*").alias("lines"), F.count_distinct("l_orderkey").alias("orders"), mark).join(other, ["l_returnflag", "mark"]).drop("mark")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)


__all__ = ["flagship", "oracle_sql", "queries"]
