import json

import pytest
from pyspark.sql import functions as F

from scorelake.operators import gold
from scorelake.plans import pipeline, store
from scorelake.plans.serving import Catalog
from scorelake.sources import ingest, synth
from scorelake.sources.documents import latest_snapshots, pending_snapshots

from .helpers import document

PLAYS = "play_id string, contest_id long, ingest_timestamp string, team_id long, event_team_short string, opponent_team_id long, event_type string, play_text string, shot_result string, shot_possession_retained boolean, clear_result string, penalty_duration_seconds int"
TEAMS = "team_id long, name_short string, name_6char string, name_full string, color string"


def plays(spark, *rows):
    full = [{"play_id": str(i), "contest_id": 1, "ingest_timestamp": "t", "team_id": 1, "event_team_short": "A", "opponent_team_id": 2} | r for i, r in enumerate(rows)]
    names = [x.split()[0] for x in PLAYS.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], PLAYS)


def shot(result, kept, **more):
    return {"event_type": "SHOT", "shot_result": result, "shot_possession_retained": kept} | more


def test_rates_are_those_of_all_contests_and_empty_measures_stay_null(spark):
    df = plays(spark, shot("WIDE", True), shot("WIDE", False, contest_id=2), shot(None, False), {"event_type": "GOAL", "shot_result": "GOAL"}, {"event_type": "TURNOVER", "team_id": 2})
    teams = spark.createDataFrame([(1, "Ay ", "AY", "Ay U", "#1")], TEAMS)
    got = {(r.contest_id, r.team_id): r for r in gold.team_game_stats(df, teams).collect()}
    one, two = got[1, 1], got[1, 2]
    assert (one.total_shots, one.goals, one.shots_retained, one.realized_shots_lost) == (3, 1, 1, 1)
    assert one.normalized_shots_lost == pytest.approx(0.5 + 0.6667, abs=1e-4) and one.team_short == "Ay"
    assert (two.normalized_shots_lost, two.normalized_shot_possessions_used, two.penalty_seconds) == (None, None, None)
    assert (two.normalized_shooting_efficiency, two.shooting_pct, two.team_short) == (0.0, 0.0, "A")


def test_no_shots_lose_half(spark):
    _, overall = gold.loss_rates(plays(spark, {"event_type": "GOAL"}))
    assert overall.first().default_rate == 0.5


def test_counts_of_parts_add_up(spark):
    team = {"event_team_short": "Lake", "play_text": "Shot by Lake Al."}
    kinds = [shot("WIDE", True), shot("WIDE", False), shot(None, False), shot("SAVE", True), {"event_type": "GOAL", "shot_result": "GOAL"}, {"event_type": "GROUND_BALL"}, {"event_type": "PENALTY", "penalty_duration_seconds": 30}]
    faceoff = {"event_type": "FACEOFF", "play_text": "Faceoff Al vs Bo won by Lake, Ground ball pickup by Coast Bo.", "event_team_short": "Lake"}
    rows = [team | k | {"contest_id": c, "team_id": 1 + (i + c) % 2, "opponent_team_id": 2 - (i + c) % 2} for c in range(9) for i in range(c + 3) for k in kinds[: i + 1]]
    rows += [faceoff | {"contest_id": c} for c in range(4) for _ in range(c)]
    df = plays(spark, *rows)
    teams = spark.createDataFrame([(1, "Lake", "LAKE", "Lake U", None), (2, "Coast", "COAST", "Coast U", None)], TEAMS)
    whole, counts = gold.team_game_stats(df, teams), gold.play_counts(df)
    parts = gold.play_counts(df.filter("contest_id < 4")).unionByName(gold.play_counts(df.filter("contest_id >= 4")))
    again = gold.play_counts(df.limit(40)).unionByName(gold.play_counts(df.offset(40))).groupBy(*gold.PROFILE).agg(F.sum("n").alias("n"))
    assert counts.agg(F.sum("n")).first()[0] == len(rows) and counts.count() < len(rows)
    want = sorted(map(str, whole.collect()))
    assert sorted(map(str, gold.stats_of(parts, teams).collect())) == want == sorted(map(str, gold.stats_of(again, teams).collect()))
    picked = {(r.contest_id, r.team_id): r.ground_balls for r in whole.filter("contest_id < 4").collect()}
    own = {(r.contest_id, r.team_id): r["n"] for r in df.filter("event_type = 'GROUND_BALL'").groupBy("contest_id", "team_id").agg(F.count("*").alias("n")).collect()}
    assert all(picked[c, 2] == own.get((c, 2), 0) + c for c in range(1, 4))
    assert gold.embedded_ground_balls(df, teams).filter("team_id = 2 AND event_team_short = 'COAST'").count() == 6


def test_statistics_parse_plays_once(spark):
    df = plays(spark, shot("WIDE", True)).repartition(2)
    stats = gold.team_game_stats(df, spark.createDataFrame([(1, "A", "A", "A", None)], TEAMS))
    stats.collect()
    final = stats._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("RoundRobinPartitioning") == 1 and "ReusedExchange" in final


def test_bad_keys_are_refused(spark):
    for rows in ([(1, "a"), (1, "b")], [(None, "a")]):
        with pytest.raises(ValueError, match="team_id"):
            gold.validate_key(spark.createDataFrame(rows, "team_id long, n string"), "team_id", "dim_teams")


def table(spark, *rows):
    return spark.createDataFrame(list(rows), "contest_id long, v string")


def test_replacing_keys_keeps_the_others_and_refuses_strangers(spark, tmp_path):
    store.replace_keys(spark, tmp_path, table(spark, (1, "a"), (2, "b")), "contest_id", None)
    store.replace_keys(spark, tmp_path, table(spark, (2, "c"), (3, "d")), "contest_id", [2, 3])
    read = lambda: sorted(map(tuple, store.read_table(spark, tmp_path).collect()))
    assert read() == [(1, "a"), (2, "c"), (3, "d")]
    with pytest.raises(ValueError, match="isn't replaced"):
        store.replace_keys(spark, tmp_path, table(spark, (1, "x")), "contest_id", [2])
    assert read() == [(1, "a"), (2, "c"), (3, "d")]


def test_tables_without_a_commit_are_refused(spark, tmp_path):
    table(spark, (1, "a")).write.parquet(str(tmp_path / "t"))
    with pytest.raises(ValueError):
        store.read_table(spark, tmp_path / "t")
    with pytest.raises(ValueError):
        store.has_table(tmp_path / "t")
    (tmp_path / "t" / store.POINTER).write_text('{"version": "../x"}')
    with pytest.raises(ValueError, match="names no version"):
        store.current(tmp_path / "t")
    with pytest.raises(ValueError, match="at least one"):
        store.clustered(table(spark, (1, "a")), "contest_id", files=0)


def generation(spark, goals):
    teams = spark.createDataFrame([(1, "A")], "team_id long, name_full string")
    contests = spark.createDataFrame([(7, "G", "final")], "contest_id long, title string, status string")
    facts = spark.createDataFrame([("7_1", 7, 1)], "play_id string, contest_id long, team_id long")
    stats = spark.createDataFrame([(7, 1, goals, "A")], "contest_id long, team_id long, goals long, team_short string")
    return dict(zip(store.GOLD_TABLES, (teams, contests, facts, stats), strict=True))


def test_publication_is_atomic_and_readers_stay_on_their_generation(spark, tmp_path, monkeypatch):
    first = store.publish(spark, generation(spark, 1), tmp_path)
    reader = Catalog.open(spark, tmp_path)
    monkeypatch.setattr(store, "point_to", lambda *a: (_ for _ in ()).throw(OSError("disk")))
    with pytest.raises(OSError):
        store.publish(spark, generation(spark, 2), tmp_path)
    monkeypatch.undo()
    assert store.generation(tmp_path) == first and not list(tmp_path.glob(".staging*"))
    store.publish(spark, generation(spark, 3), tmp_path)
    assert reader.agg_team_game_stats.first().goals == 1
    assert Catalog.open(spark, tmp_path).sql("SELECT goals FROM agg_team_game_stats WHERE contest_id = :c", {"c": 7}) == [{"goals": 3}]
    with pytest.raises(ValueError, match="has the tables"):
        store.publish(spark, {"dim_teams": table(spark, (1, "a"))}, tmp_path)
    (store.generation(tmp_path) / "dim_teams" / store.COMMIT).unlink()
    with pytest.raises(ValueError, match="not committed"):
        Catalog.open(spark, tmp_path)


def test_ingest_is_idempotent_and_keeps_an_audit(tmp_path):
    payload = document(5, [(None, "9:00", "Turnover by X.")])
    assert ingest.ingest(5, tmp_path, lambda _: payload) == "STORED_NEW_VERSION"
    assert ingest.ingest(5, tmp_path, lambda _: dict(reversed(payload.items()))) == "UNCHANGED"
    assert ingest.ingest(6, tmp_path, lambda _: {"data": {}}) == "INVALID"
    lines = (tmp_path / ingest.MANIFEST).read_text().splitlines()
    assert [json.loads(x)["status"] for x in lines] == ["STORED_NEW_VERSION", "UNCHANGED", "INVALID"]
    assert [s[0] for s in latest_snapshots(tmp_path / ingest.MANIFEST)] == [5]
    (tmp_path / ingest.MANIFEST).write_text("no json\n" + "\n".join(lines))
    assert ingest.last_hash(tmp_path / ingest.MANIFEST, 5)
    with pytest.raises(ValueError):
        latest_snapshots(tmp_path / ingest.MANIFEST)
    with pytest.raises(FileNotFoundError):
        latest_snapshots(tmp_path / "none")


def test_ingest_command(tmp_path, capsys):
    (tmp_path / "5.json").write_text(json.dumps(document(5, [(None, "9:00", "Turnover by X.")])))
    for want in ("STORED_NEW_VERSION", "UNCHANGED"):
        ingest.main(["--contest-id", "5", "--url", f"file://{tmp_path}/{{contest_id}}.json", "--folder", str(tmp_path / "raw")])
        assert json.loads(capsys.readouterr().out) == {"contest_id": 5, "status": want}


def test_only_touched_files_are_written_anew(spark, tmp_path):
    root = f"file:{tmp_path}/t"  # by Spark's file systems
    store.replace_keys(spark, root, table(spark, *[(i, "a") for i in range(40)]), "contest_id", None, files=4)
    before = set(store._files(store.current(root)))
    store.replace_keys(spark, root, table(spark, (3, "b")), "contest_id", [3], files=1)
    after = set(store._files(store.current(root)))
    assert len(before) == 4 and len(before & after) == 3 and len(after) == 4
    rows = {r.contest_id: r.v for r in store.read_table(spark, root).collect()}
    assert rows == {i: "b" if i == 3 else "a" for i in range(40)}
    store.replace_keys(spark, root, table(spark, (3, "b")).filter("false"), "contest_id", range(40), files=1)
    assert store.read_table(spark, root).count() == 0
    assert store.files_for(0) == 1 and store.files_for(10_000_000) == 16 and store.files_for(4_000_000_000) == 1000


def test_pending_snapshots(spark):
    shots = [(1, "a", "p"), (2, "b", "q")]
    present = spark.createDataFrame([(1, "a"), (2, "a")], "contest_id long, ingest_timestamp string")
    assert pending_snapshots(spark, shots, present) == [(2, "b", "q")]
    assert pending_snapshots(spark, shots, None) == shots == pending_snapshots(spark, shots, present, full_refresh=True)


def test_pipeline_refreshes_only_what_changed(spark, tmp_path, monkeypatch):
    docs = [document(c, [(None, "9:00", "GOAL by LV Al Ames."), (None, "8:00", "Shot by LV Al Ames WIDE.")]) for c in (1, 2)]
    for c, d in enumerate(docs, 1):
        ingest.ingest(c, tmp_path / "raw", lambda _, d=d: d)
    manifest = tmp_path / "raw" / ingest.MANIFEST
    monkeypatch.setenv("SCORELAKE_WRITE_FILES", "2")
    pipeline.run(spark, manifest, tmp_path / "lake", plans=tmp_path / "plans", metrics=tmp_path / "m.json")
    assert json.loads((tmp_path / "m.json").read_text())["gold"] > 0 and (tmp_path / "plans" / "fact_plays.md").exists()
    tables = [tmp_path / "lake" / n for n in ("silver_plays", "silver_contests", "play_counts")]
    before = [store.current(t) for t in tables]
    pipeline.run(spark, manifest, tmp_path / "lake")
    assert [store.current(t) for t in tables] == before
    docs[1]["data"]["playbyplay"]["title"] = "Renamed"
    docs[1]["data"]["playbyplay"]["periods"][0]["playbyplayStats"].pop()
    from datetime import datetime, timezone
    ingest.ingest(2, tmp_path / "raw", lambda _: docs[1], now=lambda: datetime(2030, 1, 1, tzinfo=timezone.utc))
    pipeline.run(spark, manifest, tmp_path / "lake")
    for t in tables:
        entry = store._entry(t, store.latest(t))
        assert entry["keys"] == [2] and all(set(f["keys"]) == {2} for f in entry["added"].values())  # no row of contest 1 was touched
    found = Catalog.open(spark, tmp_path / "lake" / "gold", tmp_path / "lake" / "silver_plays")
    assert {r.contest_id: r.n for r in found.fact_plays.groupBy("contest_id").agg(F.count("*").alias("n")).collect()} == {1: 2, 2: 1}
    assert found.contest_summary(2).first().title == "Renamed" and len(found.contest_summary(2).first().team_stats) == 1
    assert found.contest_summary(9).isEmpty() and not found.has_contest(9)


def test_generator_is_exact_and_deterministic(spark):
    counts = synth.contest_counts(5000, 7)
    assert sum(counts) == 5000 and counts == synth.contest_counts(5000, 7) != synth.contest_counts(5000, 8)
    assert all(200 <= c <= 300 for c in counts)
    docs = synth.load_documents(spark, 1000, 3)
    n = docs.select(F.explode("periods").alias("p")).select(F.size("p.playbyplayStats").alias("n")).agg(F.sum("n")).first()[0]
    assert n == 1000
