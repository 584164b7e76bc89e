import asyncio
import json
import random
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from scorelake.plans import store
from scorelake.plans.api import Api
from scorelake.plans.serving import SORT_KEYS, Catalog, conditions, ordered
from scorelake.sources import ingest
from scorelake.streaming.refresh import refresh_plays

from .helpers import document

PLAYS = """play_id string, contest_id long, play_seq int, event_type string, team_id long, event_team_short string, caused_by_team_id long, primary_player_name string, secondary_player_name string,
caused_by_player_name string, faceoff_winner_player string, faceoff_loser_player string, shot_result string, shot_possession_retained boolean, is_extra_man_opportunity boolean, possession_team_id long,
period_number int, period_seconds_remaining int, game_seconds_elapsed int, game_seconds_remaining_reg int, home_score_margin int, event_team_margin int, clock_display string, play_text string, running_home_score int, running_visitor_score int"""
NAMES = [x.split()[0] for x in PLAYS.split(",")]


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    rng, rows = random.Random(4), []
    for i in range(60):
        kind = rng.choice(["SHOT", "GOAL", "TURNOVER"])
        rows.append({"play_id": f"{i % 3}_{i}", "contest_id": i % 3, "play_seq": i // 3, "event_type": kind, "team_id": 1 + i % 2, "event_team_short": "AB"[i % 2], "primary_player_name": rng.choice(["Al Ames", "Bo Byrd", "TEAM"]), "caused_by_player_name": "Cy Cole" if kind == "TURNOVER" and i % 4 else None, "caused_by_team_id": 2 - i % 2 if kind == "TURNOVER" and i % 4 else None, "shot_result": rng.choice(["WIDE", "POST", None]) if kind == "SHOT" else None, "shot_possession_retained": rng.random() < 0.5 if kind == "SHOT" else None, "period_number": 1 + i % 4, "period_seconds_remaining": None if i % 9 == 0 else 30 * (i % 4), "game_seconds_elapsed": i % 5, "game_seconds_remaining_reg": 10 - i % 5, "event_team_margin": i % 3 - 1, "home_score_margin": i % 3 - 1})
    rng.shuffle(rows)
    facts = spark.createDataFrame([tuple(r.get(n) for n in NAMES) for r in rows], PLAYS)
    teams = spark.createDataFrame([(1, "Alpha", "ALPHA", "Alpha College"), (2, "Beta", "BETA", "Beta College")], "team_id long, name_short string, name_6char string, name_full string")
    contests = spark.createDataFrame([(c, f"G{c}", "final") for c in (2, 0, 1)], "contest_id long, title string, status string")
    stats = spark.createDataFrame([(0, 1, 0.5, 0.4, "Alpha"), (0, 2, 0.25, 0.3, None), (1, 1, 0.75, 0.5, "Alpha")], "contest_id long, team_id long, realized_shooting_efficiency double, normalized_shooting_efficiency double, team_short string")
    folder = tmp_path_factory.mktemp("gold")
    store.publish(spark, dict(zip(store.GOLD_TABLES, (teams, contests, facts, stats), strict=True)), folder)
    return folder, rows


@pytest.mark.parametrize("key", SORT_KEYS)
@pytest.mark.parametrize("down", [False, True])
def test_pages_join_to_the_whole_order_with_nulls_last(spark, root, key, down):
    plays = Catalog.open(spark, root[0]).fact_plays
    whole = [r.play_id for r in ordered(plays, key, down).collect()]
    pages = [r.play_id for k in range(0, 60, 25) for r in ordered(plays, key, down).offset(k).limit(25).collect()]
    assert pages == whole and len(set(whole)) == 60
    if key == "period_seconds_remaining":
        assert [r[key] for r in ordered(plays, key, down).collect()][-1] is None


def test_filters(spark, root):
    found, rows = Catalog.open(spark, root[0]), root[1]
    count = lambda **x: found.plays(limit=500, **x).count()
    assert count(event_type="shot") == sum(r["event_type"] == "SHOT" for r in rows)
    assert count(event_types=["goal", "TURNOVER"], min_period=2) == sum(r["event_type"] != "SHOT" and r["period_number"] >= 2 for r in rows)
    assert count(shot_possession_retained=False) == sum(r["shot_possession_retained"] is False for r in rows)
    assert count(contest_id=0, event_type="") == 20 and count(player_name="cole") == sum(r["caused_by_player_name"] is not None for r in rows)
    mine = lambda r, t: r["team_id"] == t or r["caused_by_team_id"] == t
    assert count(team="b") == sum(r["event_team_short"] == "B" for r in rows)
    assert count(team="BETA") == count(team="2") == count(team_id=2) == count(team="beta college") == sum(mine(r, 2) for r in rows)
    with pytest.raises(TypeError, match="unknown"):
        conditions(colour="red")
    assert [r.play_id for r in found.plays(order_by="nonsense").collect()] == [r.play_id for r in found.plays().collect()]


def test_situations_and_summary(spark, root):
    found, rows = Catalog.open(spark, root[0]), root[1]
    got = found.caused_turnovers(defending_team_down_by=1, min_period=0).collect()
    assert len(got) == sum(r["event_type"] == "TURNOVER" and r["caused_by_player_name"] is not None and r["event_team_margin"] == 1 for r in rows) and all(r.defending_team_margin == -1 for r in got)
    s = found.shooting_summary(min_player_shots=1)
    shots = [r for r in rows if r["event_type"] != "TURNOVER"]
    o = s["overall"]
    assert o["total_shots"] == len(shots) == o["goals"] + o["shots_retained"] + o["realized_shots_lost"]
    assert o["average_team_game_realized_efficiency"] == 0.625
    assert [r["shot_result"] for r in s["retention_by_shot_result"]] == ["SAVE", "WIDE", "HIGH", "HIT POST", "HIT CROSSBAR", "BLOCKED"]
    assert s["retention_by_shot_result"][0]["total_shots"] == 0
    assert {p["player_name"] for p in s["top_players"]} == {"Al Ames", "Bo Byrd"} and {t["team_name"] for t in s["top_teams"]} == {"Alpha", "Beta"}
    none = found.shooting_summary(contest_id=99)["overall"]
    assert none["total_shots"] == 0 and none["shooting_pct"] == 0.0 and none["average_team_game_realized_efficiency"] is None


def test_api(spark, root):
    api = Api(spark, root[0])
    assert api.get("/api/health") == (200, {"status": "ok"}) and api.get("/nowhere")[0] == 404 and api.get("/")[0] == 200
    assert [c["contest_id"] for c in api.get("/api/contests")[1]] == [0, 1, 2]
    assert api.get("/api/contests/9/summary")[0] == 404 and len(api.get("/api/contests/0/summary")[1]["team_stats"]) == 1
    status, plays = api.get("/api/plays", {"limit": "5", "event_type": "goal"})
    assert status == 200 and len(plays) == 5 and all(p["event_team_id"] == p["team_id"] for p in plays)
    assert len(api.get("/api/contests/1/plays", {"limit": 500})[1]) == 20
    for bad in ({"limit": 0}, {"limit": 501}, {"offset": -1}, {"period_number": 11}, {"limit": None}):
        assert api.get("/api/plays", bad)[0] == 422
    assert api.get("/api/shooting-efficiency", {"contest_id": 77})[0] == 404 and api.get("/api/shooting-efficiency", {"order_by": "x"})[0] == 422
    sent = []

    async def send(x):
        sent.append(x)

    asyncio.run(api.asgi({"type": "http", "path": "/api/plays", "query_string": b"limit=3&event_types=goal&event_types=shot"}, None, send))
    assert sent[0]["status"] == 200 and len(json.loads(sent[1]["body"])) == 3


def test_graph(spark, root):
    api = Api(spark, root[0])
    ask = lambda q, **v: api.graph(q, v)
    assert len(ask('{ plays(filter: {limit: 5, eventType: "shot"}, limit: 2) { playId } }')["data"]["plays"]) == 2
    assert ask("{ contest(id: 9) { title } }") == {"data": {"contest": None}}
    assert "limit" in ask("{ plays(filter: {limit: 5}, limit: 900) { playId } }")["errors"][0]["message"]
    got = ask("query Q($id: Int!, $all: Boolean = false) { one: contest(id: $id) { ...head teamStats { teamId teamShort contestId } title @include(if: $all) } contests { __typename ... on Contest { contestId } } } fragment head on Contest { contestId status }", id=1)["data"]
    assert set(got["one"]) == {"contestId", "status", "teamStats"} and got["one"]["teamStats"][0]["contestId"] == 1 and len(got["contests"]) == 3 and got["contests"][0]["__typename"] == "Contest"
    rest = api.get("/api/plays", {"limit": "7", "event_type": "goal", "min_period": "1"})[1]
    assert [p["playId"] for p in ask('{ plays(eventType: "goal", limit: 7, minPeriod: 1) { playId eventTeamId } }')["data"]["plays"]] == [p["play_id"] for p in rest]
    for bad in ("{ nothing }", "{ contests }", "{ contests { nothing } }", "{ contests(x: 1) { title } }", "mutation { contests { title } }", "{ contests { title }", "query($a: Int!) { contest(id: $a) { title } }", "{ contests { ...none } }", "{ contest { title } }", "{ }", ""):
        assert ask(bad)["data"] is None and ask(bad)["errors"][0]["message"]


def test_requests_from_other_origins(spark, root):
    api, sent = Api(spark, root[0]), []

    async def send(x):
        sent.append(x)

    async def receive():
        return {"type": "http.request", "body": json.dumps({"query": "query($n: Int) { plays(limit: $n) { playId } }", "variables": {"n": 3}}).encode()}

    scope = {"type": "http", "path": "/graphql", "query_string": b"", "headers": [(b"origin", b"http://x.test"), (b"access-control-request-headers", b"content-type")]}
    asyncio.run(api.asgi(scope | {"method": "OPTIONS"}, receive, send))
    headers = dict(sent[0]["headers"])
    assert sent[0]["status"] == 200 and headers[b"access-control-allow-origin"] == b"http://x.test" and b"POST" in headers[b"access-control-allow-methods"] and headers[b"access-control-allow-headers"] == b"content-type"
    asyncio.run(api.asgi(scope | {"method": "POST"}, receive, send))
    assert len(json.loads(sent[3]["body"])["data"]["plays"]) == 3 and dict(sent[2]["headers"])[b"access-control-allow-origin"] == b"http://x.test"


def test_many_threads_read_one_catalog(spark, root):
    found = Catalog.open(spark, root[0])
    with ThreadPoolExecutor(8) as pool:
        got = list(pool.map(lambda c: found.fact_plays.filter(F.col("contest_id") == c % 3).count(), range(24)))
    assert got == [20] * 24


def test_stream_replaces_contests(spark, tmp_path):
    make = lambda n: document(1, [(None, "9:00", "Turnover by LV Al Ames.")] * n)
    from datetime import datetime, timezone
    for year, n in ((2030, 2), (2031, 3)):
        ingest.ingest(1, tmp_path / "raw", lambda _, n=n: make(n), now=lambda year=year: datetime(year, 1, 1, tzinfo=timezone.utc))
        refresh_plays(spark, tmp_path / "raw", tmp_path / "plays", tmp_path / "check", files=2).awaitTermination(120)
        assert store.read_table(spark, tmp_path / "plays").count() == n


def test_team_filters_without_a_page_return_all_plays(spark, root):
    found = Catalog.open(spark, root[0])
    for team, own in (("alpha", 1), ("beta c", 2)):
        whole = [r.play_id for r in found.plays(team=team, limit=None).collect()]
        wanted = {r["play_id"] for r in root[1] if own in (r["team_id"], r["caused_by_team_id"])}
        assert set(whole) == wanted and len(whole) == len(wanted) and [r.play_id for r in found.plays(team=team, limit=7).collect()] == whole[:7]


def test_all_plays_are_made_once_before_they_are_sorted(spark):
    """A sort samples its rows for ranges and then reads them again; parsing must not be done twice for it."""
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    plays = spark.range(1000).select(F.col("id").alias("contest_id"), F.lit(1).alias("play_seq"), F.col("id").cast("string").alias("play_id"))
    tables = {"fact_plays": plays.mapInArrow(counted, plays.schema), "agg_team_game_stats": spark.createDataFrame([], "team_short string")}
    found = [r.contest_id for r in Catalog(spark, tables).plays(limit=None).collect()]
    assert found == list(range(1000)) and made.value == 1000
