"""Load tests: generate and validate snapshots, run the batch plan, and time what readers ask.

    python -m scorelake.plans.load_test generate --root /tmp/load --plays 1000000
    python -m scorelake.plans.load_test validate --root /tmp/load
    python -m scorelake.plans.load_test run-etl --root /tmp/load
    python -m scorelake.plans.load_test run-silver-gold --root /tmp/load
    python -m scorelake.plans.load_test run-serving --root /tmp/load --rounds 5

Every command leaves its figures below the root. Snapshots that are there already
are kept, so a generation that was broken off goes on.
"""

from __future__ import annotations

import argparse
import json
import time
from collections.abc import Callable
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import event_type
from ..operators import gold
from ..session import create_session
from ..sources import files, synth
from ..sources.documents import bounded, latest_snapshots, read_documents
from ..sources.files import Place
from . import pipeline, store
from .serving import Catalog

SUMMARY = "generation.json"


def spoken_plays(documents: DataFrame) -> DataFrame:
    """A row per play with a text: contest, container's team and event type."""
    stats = documents.select("contest_id", "teams", F.explode("periods").alias("p")).select("contest_id", "teams", F.explode("p.playbyplayStats").alias("s"))
    plays = stats.select("contest_id", "teams", F.col("s.teamId").alias("stat_team_id"), F.explode("s.plays").alias("play"))
    return plays.filter(F.trim("play.playText") != "").withColumn("event_type", event_type(F.trim("play.playText")))


def _counts(plays: DataFrame) -> dict[str, int]:
    return {r[0]: r[1] for r in plays.groupBy("event_type").count().collect()}


def _documents(spark: SparkSession, manifest: Place) -> DataFrame:
    return read_documents(spark, latest_snapshots(manifest)).withColumnRenamed("contestId", "contest_id")


def generate(spark: SparkSession, root: Place, plays: int, seed: int = synth.SEED, templates: Place | None = None) -> dict[str, Any]:
    """Write snapshots with `plays` plays in all, from templates (a manifest of real snapshots) if there are any; a root keeps to its first seed and size."""
    root = files.place(root)
    summary = files.join(root, SUMMARY)
    if files.exists(summary):
        before = json.loads(files.text(summary))
        if (before["seed"], before["plays"]) != (seed, plays):
            raise ValueError(f"{root} holds a generation of another seed or size")
    made = synth.templated_documents(_documents(spark, templates), plays, seed) if templates else synth.load_documents(spark, plays, seed)
    files.put(summary, json.dumps({"seed": seed, "plays": plays}))
    manifest = synth.write_folder(made, files.join(root, "raw"))
    out = {"seed": seed, "plays": plays, "contests": len(latest_snapshots(manifest)), "events": _counts(spoken_plays(_documents(spark, manifest)))}
    files.put(summary, json.dumps(out))
    return out


def validate(spark: SparkSession, root: Place, sample: int | None = None) -> dict[str, Any]:
    """Hold the snapshots (or the first `sample`, for a quick look) against the manifest: digests, contests, two teams, known ids, and the number of plays."""
    root = files.place(root)
    manifest = files.join(root, "raw", synth.MANIFEST)
    lines = [json.loads(x) for x in files.text(manifest).splitlines() if x.strip()][:sample]
    listed = spark.createDataFrame([(x["contest_id"], x["sha256"], str(x["file_path"])) for x in lines], "listed_id long, listed_sha string, path string")
    texts = spark.read.option("wholetext", "true").text([x["file_path"] for x in lines])
    read = texts.select(F.col("_metadata.file_path").alias("path"), F.sha2("value", 256).alias("sha"), F.get_json_object("value", "$.data.playbyplay.contestId").cast("long").alias("contest_id"))
    wrong = bounded(listed, len(lines), 512).join(read, "path", "left").filter(~F.coalesce((F.col("sha") == F.col("listed_sha")) & (F.col("contest_id") == F.col("listed_id")), F.lit(False)))
    if bad := wrong.limit(5).collect():
        raise ValueError(f"digest or contest differ: {[r['path'] for r in bad]}")
    chosen = {x["contest_id"] for x in lines}
    documents = read_documents(spark, [s for s in latest_snapshots(manifest) if s[0] in chosen]).withColumnRenamed("contestId", "contest_id")
    if bad := documents.filter(F.size("teams") != 2).limit(5).collect():
        raise ValueError(f"contests without two teams: {[r['contest_id'] for r in bad]}")
    plays = spoken_plays(documents)
    known = F.transform("teams", lambda t: t["teamId"].cast("long"))
    if bad := plays.filter(F.col("stat_team_id").isNotNull() & ~F.array_contains(known, F.col("stat_team_id"))).limit(5).collect():
        raise ValueError(f"plays of unknown teams: {[r['contest_id'] for r in bad]}")
    events = _counts(plays)
    wanted = json.loads(files.text(files.join(root, SUMMARY)))["plays"]
    if sample is None and sum(events.values()) != wanted:
        raise ValueError(f"{sum(events.values())} plays instead of {wanted}")
    return {"contests": len(lines), "plays": sum(events.values()), "events": events}


def run_etl(spark: SparkSession, root: Place) -> dict[str, Any]:
    """The whole batch plan over all snapshots."""
    root, began = files.place(root), time.perf_counter()
    seconds = pipeline.run(spark, files.join(root, "raw", synth.MANIFEST), files.join(root, "tables"), full_refresh=True)
    return {"seconds": seconds, "wall_seconds": time.perf_counter() - began}


def run_silver_gold(spark: SparkSession, root: Place) -> dict[str, Any]:
    """A new generation, in a place of its own, from the play and contest tables that are there."""
    root, began = files.place(root), time.perf_counter()
    target = files.join(root, "gold-again")
    if store.latest(target):
        raise ValueError(f"{target} holds a generation already")
    plays, contests = (store.read_table(spark, files.join(root, "tables", n)) for n in ("silver_plays", "silver_contests"))
    store.publish(spark, gold.gold_tables(plays, *gold.dimensions(contests)), target)
    return {"wall_seconds": time.perf_counter() - began}


#: What a reader asks of one generation, by name.
ASKED = {
    "contest": lambda c, k: c.contest_summary(k),
    "page": lambda c, k: c.plays(limit=50),
    "goals": lambda c, k: c.plays(contest_id=k, event_type="GOAL", limit=50),
    "shooting": lambda c, k: c.shooting_overall(k),
    "players": lambda c, k: c.top_players(min_shots=3),
}


def run_serving(spark: SparkSession, root: Place, rounds: int = 5) -> dict[str, Any]:
    """Each query of ASKED so many times, over contests drawn from the whole generation; quantiles of the milliseconds by query."""
    catalog = Catalog.open(spark, files.join(files.place(root), "tables", "gold"))
    chosen = [r[0] for r in catalog.dim_contests.orderBy(F.xxhash64("contest_id")).limit(rounds).select("contest_id").collect()]
    times = []
    for contest in chosen:
        for name, ask in ASKED.items():
            began = time.perf_counter()
            ask(catalog, contest).collect()
            times.append((name, 1000 * (time.perf_counter() - began)))
    shares = [0.5, 0.95, 0.99]
    told = spark.createDataFrame(times, "name string, ms double").groupBy("name").agg(F.count("*").alias("n"), F.percentile("ms", shares).alias("q"))
    return {r["name"]: {"requests": r["n"], **{f"p{round(100 * x)}_ms": round(v, 1) for x, v in zip(shares, r["q"], strict=True)}} for r in told.collect()}


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    """Run the command that the arguments name and keep its figures below the root."""
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("command", choices=sorted(COMMANDS))
    parser.add_argument("--root", required=True)
    for command, names in COMMANDS.items():
        for name, kind in names[1].items():
            parser.add_argument(f"--{name}", type=kind, help=f"of {command}")
    given = vars(parser.parse_args(arguments))
    function, names = COMMANDS[given["command"]]
    session = spark or create_session("scorelake-load-test")
    try:
        out = function(session, given["root"], **{n: given[n] for n in names if given[n] is not None})
    finally:
        if spark is None:
            session.stop()
    told = json.dumps(out, indent=1)
    files.put(files.join(files.place(given["root"]), f"{given['command']}-result.json"), told)
    print(told)


#: Functions of the commands, with the types of their arguments.
COMMANDS: dict[str, tuple[Callable[..., dict[str, Any]], dict[str, type]]] = {
    "generate": (generate, {"plays": int, "seed": int, "templates": str}),
    "validate": (validate, {"sample": int}),
    "run-etl": (run_etl, {}),
    "run-silver-gold": (run_silver_gold, {}),
    "run-serving": (run_serving, {"rounds": int}),
}


if __name__ == "__main__":
    main()
