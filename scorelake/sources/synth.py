"""Generated play-by-play: from the driver's event table, and for load tests."""

from __future__ import annotations

import random
import uuid
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import files
from .documents import discovery, manifest_lines
from .files import Place
from .ingest import MANIFEST

#: Seed and first contest of load tests, teams that they share, and names of their players.
SEED, FIRST_CONTEST, TEAMS = 20_260_101, 1_000_000_000, 1024
GIVEN = ("Ada", "Ben", "Cal", "Dov", "Eli", "Fay", "Gil", "Hugh", "Ira", "Jem", "Kay", "Lou", "Max", "Ned", "Oli", "Pat")
SURNAMES = ("Aster", "Birch", "Cedar", "Dogwood", "Elm", "Fern", "Gorse", "Hazel", "Iris", "Juniper", "Kelp", "Larch", "Maple", "Nettle", "Oak", "Poplar")
#: Events of which a contest may have more or fewer without losing its sense, in the order in which they go.
LOOSE = ("SHOT", "GROUND_BALL", "TURNOVER", "CLEAR")
#: Plays of a period in the derived contests, and the last period.
PERIOD_PLAYS, LAST_PERIOD = 16, 5


def event_plays(events: DataFrame) -> DataFrame:
    """A play per event: the user is the contest, the event id picks the team and the wording.

    The texts are written so that the SQL oracle can tell the expected parse from
    the event's attributes alone.
    """
    order = Window.partitionBy("user_id").orderBy("ts", "event_id")
    rows = events.withColumn("seq", F.row_number().over(order))
    eid, at = F.col("event_id"), (F.col("seq") - 1) % PERIOD_PLAYS
    period = (1 + F.least(F.lit(LAST_PERIOD - 1), F.floor((F.col("seq") - 1) / PERIOD_PLAYS))).cast("int")
    is_home = eid % 2 == 0
    goal = F.col("event_type") == "purchase"
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scored = lambda home: F.sum(F.when(goal & (is_home if home else ~is_home), 1).otherwise(0)).over(upto).cast("int")
    named = lambda flag: F.when(is_home == flag, short_name(F.col("user_id"), True)).otherwise(short_name(F.col("user_id"), False))
    seconds = F.when(period < LAST_PERIOD, 900 - at * 50 - eid % 40).otherwise(F.greatest(F.lit(0), 240 - (F.col("seq") - 65) * 6))
    rows = rows.withColumns({"_own": named(True), "_other": named(False), "_given": F.concat(F.lit(", Kim "), (eid % 7).cast("string")), "_seconds": seconds})
    own, other, seconds = F.col("_own"), F.col("_other"), F.col("_seconds")
    player = lambda k: F.concat(F.lit(k), F.col("_given"))
    shown = F.concat(F.floor(seconds / 60).cast("string"), F.lit(":"), F.lpad((seconds % 60).cast("string"), 2, "0"))
    clock = F.when(eid % 3 == 0, F.when(eid % 2 == 0, "")).otherwise(F.when(eid % 5 == 1, F.concat(F.lit(" "), shown, F.lit("  "))).otherwise(shown))
    taker = F.when(eid % 7 != 0, player("Ford")).when(is_home | (F.col("user_id") % 10 == 0), "Hale, Hal").otherwise("Ives, Ian")
    shots = F.element_at(F.array(*map(F.lit, (" WIDE.", " HIGH.", " HIT POST.", " HIT CROSSBAR.", " BLOCKED.", ", SAVE Gale, Gus.", "."))), (eid % 7 + 1).cast("int"))
    text = (
        F.when(goal, F.concat(F.lit("GOAL by "), own, F.lit(" "), player("Able"), F.when(eid % 10 == 0, ", Assist by Bond, Bo, Jr").when(eid % 5 == 0, ", Assist by Bond, Bo").otherwise(""), F.lit(".")))
        .when(F.col("event_type") == "view", F.concat(F.lit("Shot by "), own, F.lit(" "), player("Able"), shots))
        .when((F.col("event_type") == "error") & (eid % 3 == 0), F.concat(F.lit("Penalty on "), own, F.lit(" "), player("Cole"), F.lit(" (SLASHING/1:30)"), F.when(eid % 4 == 0, " Extra-man opportunity").otherwise(""), F.lit(".")))
        .when((F.col("event_type") == "error") & (eid % 8 == 2), F.concat(F.lit("Turnover by "), own, F.lit(".")))
        .when(F.col("event_type") == "error", F.concat(F.lit("Turnover by "), own, F.lit(" "), player("Dane"), F.when(eid % 4 < 2, " (caused by Eads, Eli)").otherwise(""), F.lit(".")))
        .when((F.col("event_type") == "click") & (eid % 3 == 0), F.concat(F.lit("Clear attempt by "), own, F.when(eid % 2 == 0, " good.").otherwise(" failed.")))
        .when(F.col("event_type") == "click", F.concat(F.lit("Ground ball pickup by "), own, F.lit(" "), taker, F.lit(".")))
        .when((F.col("event_type") == "signup") & (eid % 4 == 0), F.concat(F.lit("Timeout by "), own, F.lit(".")))
        .otherwise(F.concat(F.lit("Faceoff Hale, Hal vs Ives, Ian won by "), own, F.when(eid % 4 == 1, F.concat(F.lit(", Ground ball pickup by "), other, F.lit(" Moss, Max"))).otherwise(""), F.lit(".")))
    )
    return rows.select(F.col("user_id").alias("contest_id"), "seq", period.alias("period"), clock.alias("clock"), text.alias("text"), F.when(goal, scored(True)).alias("home_score"), F.when(goal, scored(False)).alias("visitor_score"))


def code_of(contest: Column, home: bool) -> Column:
    return F.concat(F.lit("H" if home else "A"), contest.cast("string"))


def short_name(contest: Column, home: bool) -> Column:
    """The code of a derived team; a fourth of the contests have teams of two words."""
    return F.concat(F.when(contest % 4 == 0, "Lake ").otherwise(""), code_of(contest, home))


def team(contest: Column, home: bool) -> Column:
    """Metadata of a derived team."""
    name = code_of(contest, home)
    return F.struct(
        (contest * 2 + (1000 if home else 1001)).cast("string").alias("teamId"), short_name(contest, home).alias("nameShort"), F.concat(F.lit("Club "), name).alias("nameFull"), F.concat(name, F.lit("X")).alias("name6Char"),
        F.lower(name).alias("seoname"), F.when(contest % 2 == 0, "#112233").alias("color"), F.lit(home).alias("isHome"),
    )


def event_documents(events: DataFrame) -> DataFrame:
    """One nested document per contest, in the shape in which snapshots are read."""
    plays = event_plays(events)
    play = F.struct(F.lit(None).cast("string").alias("clock"), F.col("text").alias("playText"), F.col("home_score").alias("homeScore"), F.col("visitor_score").alias("visitorScore"))
    stats = plays.groupBy("contest_id", "period").agg(F.sort_array(F.collect_list(F.struct("seq", F.col("clock").alias("clock"), F.lit(None).cast("long").alias("teamId"), F.array(play).alias("plays")))).alias("stats"))
    display = F.when(F.col("period") < LAST_PERIOD, F.concat(F.lit("P"), F.col("period").cast("string"))).otherwise(F.lit("OT"))
    body = F.transform("stats", lambda s: F.struct(s["clock"].alias("clock"), s["teamId"].alias("teamId"), s["plays"].alias("plays")))
    periods = stats.groupBy("contest_id").agg(F.sort_array(F.collect_list(F.struct(F.col("period").alias("periodNumber"), display.alias("periodDisplay"), body.alias("playbyplayStats")))).alias("periods"))
    contest = F.col("contest_id")
    return periods.select(
        "contest_id", F.lit("20260101T000000Z").alias("ingest_timestamp"), F.concat(F.lit("Game "), contest.cast("string")).alias("title"), F.lit("final").alias("status"),
        F.array(team(contest, True), team(contest, False)).alias("teams"), "periods",
    )


def contest_counts(target: int, seed: int, *, mean: float = 243, sd: float = 19, least: int = 200, most: int = 300) -> list[int]:
    """Plays of each contest, normally distributed within bounds, that add up to target exactly."""
    rng, counts = random.Random(seed), []
    while (left := target - sum(counts)) > most:
        counts.append(min(most, max(least, round(rng.gauss(mean, sd))), max(least, left - least)))
    if left < least and counts:  # too few for a contest of its own: share them out
        spare = [i for i, c in enumerate(counts) for _ in range(most - c)]
        for i in rng.sample(spare, left):
            counts[i] += 1
    elif left:
        counts.append(left)
    return counts


def load_documents(spark: SparkSession, target: int, seed: int) -> DataFrame:
    """Documents with `target` plays in all, deterministic for a seed, for load tests."""
    counts = spark.createDataFrame(list(enumerate(contest_counts(target, seed))), "user_id long, n int")
    kinds = ("view", "view", "click", "click", "error", "signup", "purchase")
    events = counts.select("user_id", F.explode(F.sequence(F.lit(1), "n")).alias("ts"))
    draw = F.pmod(F.xxhash64("user_id", "ts", F.lit(seed)), F.lit(1 << 20))
    events = events.select("user_id", "ts", (F.col("user_id") * 1000 + F.col("ts")).alias("event_id"), F.element_at(F.array(*map(F.lit, kinds)), (draw % len(kinds) + 1).cast("int")).alias("event_type"))
    return event_documents(events).withColumn("contest_id", F.col("contest_id") + FIRST_CONTEST)


def _picked(values: tuple[str, ...], draw: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (F.pmod(draw, F.lit(len(values))) + 1).cast("int"))


def templated_documents(templates: DataFrame, target: int, seed: int) -> DataFrame:
    """Documents with `target` plays in all in the pattern of real ones (contest_id, title, status, teams, periods): resized, with teams and players renamed.

    A contest takes one of the three templates of the nearest size. Plays too many
    go, those of LOOSE events first; plays too few are repeated behind their
    originals, without scores. Labels become the codes of two teams, players the
    same other player throughout a contest.
    """
    from ..operators import silver, timeline
    from ..operators import teams as T

    spark = templates.sparkSession
    base = templates.withColumn("ingest_timestamp", F.lit(""))
    plays = silver.with_sides(timeline.number_plays(timeline.unnest_plays(base)))
    plays = silver.with_names_as_written(silver.with_label(T.with_teams(silver.with_opening(plays))))
    plays = plays.withColumnRenamed("contest_id", "template").withColumns({"side": T.lookup(F.col("_label")), "pickup_side": T.lookup(F.col("_pickup_code")), "loose": F.col("event_type").isin(*LOOSE)})
    sizes = sorted((r["n"], r["template"]) for r in plays.groupBy("template").agg(F.count("*").alias("n")).collect())  # a row per template
    if not sizes:
        raise ValueError("there are no templates with plays")
    rng, rows = random.Random(seed), []
    for i, want in enumerate(contest_counts(target, seed)):
        n, template = rng.choice(sorted(sizes, key=lambda x: abs(x[0] - want))[:3])
        one, two = rng.sample(range(TEAMS), 2)
        rows.append((FIRST_CONTEST + i, template, want, n, one, two))
    contests = spark.createDataFrame(rows, "contest_id long, template long, want int, have int, one long, two long")
    full = plays.join(contests, "template")
    draw = F.xxhash64("contest_id", "period_at", "stat_at", "play_at", F.lit(seed))
    by = Window.partitionBy("contest_id").orderBy(F.col("loose").desc(), draw)
    full = full.withColumns({"nth": F.row_number().over(by), "candidates": F.greatest(F.lit(1), F.count_if("loose").over(Window.partitionBy("contest_id")))})
    extra, goes = F.col("want") - F.col("have"), F.col("have") - F.col("want")
    share = F.floor(extra / F.col("candidates")) + (F.col("nth") <= extra % F.col("candidates")).cast("int")
    copies = F.when((extra > 0) & (F.col("nth") <= F.col("candidates")), share).otherwise(0).cast("int")
    full = full.filter(F.col("nth") > goes).withColumn("copy", F.explode(F.sequence(F.lit(0), copies)))

    code = lambda side: F.when(side == F.col("home_id"), F.format_string("T%03d", "one")).when(side == F.col("away_id"), F.format_string("T%03d", "two"))
    tail = F.coalesce(F.col("_tail"), F.lit(""))
    coded = F.concat(F.lit(" by "), F.col("_pickup_code"), F.lit(" "))
    tail = F.when(code(F.col("pickup_side")).isNotNull(), F.replace(tail, coded, F.concat(F.lit(" by "), code(F.col("pickup_side")), F.lit(" ")))).otherwise(tail)
    before = F.substring(F.col("_text"), F.lit(1), F.length("_text") - F.length("_rest"))
    text = F.when(F.col("_label").isNotNull(), F.concat(before, F.coalesce(code(F.col("side")), F.col("_label")), tail)).otherwise(F.col("_text"))
    for name in silver.NAMES:  # TEAM and the like stay
        bare = F.regexp_replace(F.trim(name), r"\.+$", "")
        other = F.xxhash64("contest_id", F.lower(bare))
        made = F.concat_ws(" ", _picked(GIVEN, other), _picked(SURNAMES, F.shiftright(other, 8)))
        text = F.when(bare.contains(" "), F.replace(text, bare, made)).otherwise(text)
    full = full.withColumn("play_text", text)

    team_of = F.when(F.col("stat_team_id") == F.col("home_id"), F.col("one") + 1).when(F.col("stat_team_id") == F.col("away_id"), F.col("two") + 1)
    score = lambda c: F.when(F.col("copy") == 0, F.col(c)).alias(c)
    stat = F.struct("stat_at", "play_at", "copy", F.col("raw_clock").alias("clock"), team_of.cast("long").alias("teamId"), F.col("play_text").alias("playText"), score("home_score"), score("visitor_score"))
    stats = full.groupBy("contest_id", "one", "two", "period_at", "period_number", "period_display").agg(F.sort_array(F.collect_list(stat)).alias("stats"))
    play = lambda s: F.struct(F.lit(None).cast("string").alias("clock"), s["playText"].alias("playText"), s["home_score"].alias("homeScore"), s["visitor_score"].alias("visitorScore"))
    body = F.transform("stats", lambda s: F.struct(s["clock"].alias("clock"), s["teamId"].alias("teamId"), F.array(play(s)).alias("plays")))
    period = F.struct("period_at", F.col("period_number").alias("periodNumber"), F.col("period_display").alias("periodDisplay"), body.alias("playbyplayStats"))
    periods = stats.groupBy("contest_id", "one", "two").agg(F.sort_array(F.collect_list(period)).alias("all"))

    def named(number: str, home: bool) -> Column:
        short = F.format_string("T%03d", number)
        colour = F.format_string("#%06X", F.pmod(F.xxhash64(number), F.lit(1 << 24)))
        return F.struct((F.col(number) + 1).cast("string").alias("teamId"), short.alias("nameShort"), F.concat(F.lit("Team "), short).alias("nameFull"), short.alias("name6Char"), F.lower(short).alias("seoname"), colour.alias("color"), F.lit(home).alias("isHome"))

    return periods.select(
        "contest_id", F.lit("20260101T000000Z").alias("ingest_timestamp"), F.format_string("Contest %d", "contest_id").alias("title"), F.lit("final").alias("status"),
        F.array(named("one", True), named("two", False)).alias("teams"), F.transform("all", lambda p: F.struct(p["periodNumber"].alias("periodNumber"), p["periodDisplay"].alias("periodDisplay"), p["playbyplayStats"].alias("playbyplayStats"))).alias("periods"),
    )


#: Folders over which the contests of a folder are dealt, so that no listing holds them all.
BUCKETS = 256
_FILE = "contest_id long, ingest_timestamp string, sha256 string, path string"


def _written_by_tasks(rows: DataFrame, part: str) -> DataFrame:
    """Write each value to a file of its own below a folder that all tasks see; a row per file. A task that is repeated writes the same files again.

    Spark's local file system starts a process for the rights of each file and
    folder that it makes, which takes most of the time where files are small.
    """
    buckets = BUCKETS

    def run(batches):
        import hashlib
        import os
        import struct
        import zlib

        import pyarrow as pa

        shape = pa.schema([("contest_id", pa.int64()), *[(n, pa.string()) for n in ("ingest_timestamp", "sha256", "path")]])
        for batch in batches:
            out = []
            for contest, stamp, value in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                folder, body = f"{part}/{(contest or 0) % buckets:04d}/contest_id={contest}/ingest_timestamp={stamp}", f"{value}\n".encode()
                os.makedirs(folder, exist_ok=True)
                sums = struct.pack(">4sI", b"crc\0", 512) + b"".join(struct.pack(">I", zlib.crc32(body[k : k + 512])) for k in range(0, len(body), 512))
                for name, content in ((".document.json.crc", sums), ("document.json", body)):  # checksums as Spark's local files have them
                    with open(fresh := f"{folder}/.{os.getpid()}", "wb") as f:
                        f.write(content)
                    os.replace(fresh, f"{folder}/{name}")
                out.append((contest, stamp, hashlib.sha256(body[:-1]).hexdigest(), f"file:{folder}/document.json"))
            yield pa.RecordBatch.from_pylist([dict(zip(shape.names, x, strict=True)) for x in out], shape)

    return rows.mapInArrow(run, _FILE)


def _written_by_spark(rows: DataFrame, part: Place) -> DataFrame:
    """The same by Spark's writer, in any store."""
    rows.write.partitionBy("contest_id", "ingest_timestamp").text(str(part))
    with discovery(rows.sparkSession):
        written = rows.sparkSession.read.option("recursiveFileLookup", "true").option("wholetext", "true").text(str(part)).select(F.col("_metadata.file_path").alias("path"), F.sha2("value", 256).alias("sha256"))
    return written.select(F.regexp_extract("path", r"contest_id=(\d+)/", 1).cast("long").alias("contest_id"), F.regexp_extract("path", r"ingest_timestamp=([^/]+)/", 1).alias("ingest_timestamp"), "sha256", "path")


def _write_lines(documents: DataFrame, folder: Place, lines: Place) -> None:
    """Write documents as snapshot files below folder, and the manifest's lines as a folder of parts, sorted by contest; neither passes through the driver."""
    spark = documents.sparkSession
    names = [c for c in documents.columns if c not in ("contest_id", "ingest_timestamp")]
    body = F.struct(F.struct(F.struct(F.col("contest_id").alias("contestId"), *names).alias("playbyplay")).alias("data"))
    tag = uuid.uuid4().hex
    part, done = files.join(folder, f"part-{tag}"), files.join(folder, f".written-{tag}")
    rows = documents.select("contest_id", "ingest_timestamp", F.to_json(body).alias("value"))
    found = _written_by_tasks(rows, files.local(part)) if files.local(part) else _written_by_spark(rows, part)
    try:
        found.write.parquet(str(done))  # sorting would write the files a second time
        entry = F.struct("contest_id", "ingest_timestamp", "sha256", "path", F.lit("STORED_NEW_VERSION").alias("status"), F.col("path").alias("file_path"))
        told = spark.read.schema(_FILE).parquet(str(done)).orderBy(F.col("contest_id").asc_nulls_last())
        told.select(F.to_json(entry, {"ignoreNullFields": "false"}).alias("value")).write.text(str(lines))
    finally:
        files.remove(done)


def write_parts(documents: DataFrame, folder: Place) -> Place:
    """Write documents as snapshot files into a new folder, with a manifest in parts; returns the manifest's path."""
    folder = files.place(folder)
    manifest = files.join(folder, MANIFEST)
    _write_lines(documents, folder, manifest)
    return manifest


def write_folder(documents: DataFrame, folder: Place) -> Place:
    """The same with a manifest of one file, to which others may append; returns its path.

    Contests that the manifest lists already are left as they are, so a run that
    was broken off goes on where it stood.
    """
    spark, folder = documents.sparkSession, files.place(folder)
    manifest, lines = files.join(folder, MANIFEST), files.join(folder, f".lines-{uuid.uuid4().hex}")
    present = [manifest] if files.exists(manifest) else []
    if present:
        known = manifest_lines(spark, manifest).select(F.from_json("value", "contest_id string")["contest_id"].cast("long").alias("contest_id"))
        documents = documents.join(known, "contest_id", "left_anti")
    try:
        _write_lines(documents, folder, lines)
        files.put_joined(manifest, [*present, *(files.join(lines, n) for n in files.names(lines) if n.startswith("part-"))])
    finally:
        files.remove(lines)
    return manifest


def remove_folder(spark: SparkSession, folder: Place) -> None:
    """Delete a folder of snapshot files. On local disks that the cluster shares, tasks delete the contests of a bucket each; the driver lists buckets."""
    folder = files.place(folder)
    if there := files.local(folder):
        buckets = [(f"{there}/{p}/{b}",) for p in files.names(Path(there)) if p.startswith("part-") for b in files.names(Path(there, p))]  # BUCKETS for a part

        def run(batches):
            import shutil

            for batch in batches:
                for bucket in batch.column(0).to_pylist():
                    shutil.rmtree(bucket, ignore_errors=True)
                yield batch

        if buckets:
            spark.createDataFrame(buckets, "path string").repartition(min(len(buckets), 4 * spark.sparkContext.defaultParallelism)).mapInArrow(run, "path string").count()
    files.remove(folder)
