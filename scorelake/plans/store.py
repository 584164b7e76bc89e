"""Tables of Parquet files under a numbered log of commits, and generations of tables under another.

A table is a folder with data files and `_log/<number>.json`. A commit names the
files that it adds and removes and the keys that it replaces, and is created only
if nobody has created that number before. A writer that was overtaken looks at the
commits in between: if they replaced other keys and left its files alone, it takes
the next free number; if they rewrote a file that it has rewritten, it starts
again from the new state; if they replaced one of its keys, it raises Conflict.

For each file the log keeps rows, least and greatest values of some columns and,
where they are few, the keys themselves, so that readers and writers leave out
files without opening them. Readers stay on the commit that they have opened:
compaction only adds commits, and vacuum spares what was current of late.

A generation is a folder of four tables that are published together; its log holds
one folder per commit.
"""

from __future__ import annotations

import bisect
import json
import os
import re
import time
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.storagelevel import StorageLevel

from ..operators.fingerprint import fingerprint
from ..sources import files as fs
from ..sources.documents import bounded
from ..sources.files import Place

GOLD_TABLES = ("dim_teams", "dim_contests", "fact_plays", "agg_team_game_stats")
COMMIT, POINTER, VERSIONS, LOG, DATA = "_commit.json", "current.json", "versions", "_log", "data"
#: Rows of a file; of small tables, rows from which on another one of up to SPREAD files is worth its task.
FILE_ROWS, SPREAD_ROWS, SPREAD = 4_000_000, 65_536, 16
#: Columns whose least and greatest values are kept for each file; keys of a file that are listed one by one.
ZONES, LISTED = ("contest_id", "team_id", "period_number"), 1000
#: Files of one tier of sizes that are merged together; each tier's files are so many times as large as the last one's.
MERGED = 8
#: Replaced keys that a commit lists itself; more stay a table beside the log, which the driver never holds.
INLINE = 10_000
#: Commits after which the whole state is written beside the log.
STATE_EVERY = 10


class Conflict(RuntimeError):
    """Somebody else has changed what this writer was about to change."""


@dataclass(frozen=True)
class State:
    """A table as it is after a commit; files: statistics by path, relative to the table."""

    number: int = 0
    schema: str | None = None
    files: dict[str, dict[str, Any]] = field(default_factory=dict)

    def after(self, number: int, entry: dict[str, Any]) -> State:
        left = {f: s for f, s in self.files.items() if f not in set(entry["removed"])}
        return State(number, entry["schema"], left | entry["added"])


def files_for(rows: int) -> int:
    """Number of files for so many rows."""
    return max(1, -(-rows // FILE_ROWS), min(SPREAD, -(-rows // SPREAD_ROWS)))


def clustered(df: DataFrame, key: str, *, files: int | None = None, rows: int | None = None) -> DataFrame:
    """df in a number of files, each a sorted range of the key: `files`, the environment's choice, or as many as the rows need."""
    if files is None:
        chosen = os.environ.get("SCORELAKE_WRITE_FILES")
        files = int(chosen) if chosen else files_for(df.count() if rows is None else rows)
    if files < 1:
        raise ValueError("a table needs at least one file")
    return (df.coalesce(1) if files == 1 else df.repartitionByRange(files, key)).sortWithinPartitions(key)


def write_version(df: DataFrame, folder: Place) -> None:
    """Write df into a new folder and commit it; an existing folder is an error."""
    df.write.mode("errorifexists").parquet(str(folder))
    fs.put(fs.join(folder, COMMIT), json.dumps({"columns": df.columns, "schema": df.schema.json()}))


def committed(folder: Place) -> bool:
    """Whether folder is a commit of a log, or a folder with a commit."""
    return fs.exists(folder if fs.name(folder).endswith(".json") else fs.join(folder, COMMIT))


# The log


def _entry_path(root: Place, number: int) -> Place:
    return fs.join(root, LOG, f"{number:020d}.json")


def log_numbers(root: Place) -> list[int]:
    """Numbers of the commits that are in the log."""
    return sorted(int(n[:-5]) for n in fs.names(fs.join(fs.place(root), LOG)) if re.fullmatch(r"\d{20}\.json", n))


def _entry(root: Place, number: int) -> dict[str, Any]:
    return json.loads(fs.text(_entry_path(root, number)))


def latest(root: Place) -> int:
    """Number of the last commit; 0 without any."""
    return (log_numbers(root) or [0])[-1]


def _append(root: Place, number: int, entry: dict[str, Any]) -> bool:
    """Create a commit; false if its number is taken."""
    try:
        fs.create(_entry_path(root, number), json.dumps(entry | {"time": time.time()}))
    except FileExistsError:
        return False
    return True


def state(root: Place, number: int | None = None) -> State:
    """The table after a commit, the last one by default: the nearest whole state before it, and the commits since then."""
    root = fs.place(root)
    known = log_numbers(root)
    if number is None:
        number = (known or [0])[-1]
    saved = [int(n[:20]) for n in fs.names(fs.join(root, LOG)) if re.fullmatch(r"\d{20}\.state", n) and int(n[:20]) <= number]
    out = State() if saved else _older_state(root)
    if saved:
        body = json.loads(fs.text(fs.join(root, LOG, f"{max(saved):020d}.state")))
        out = State(max(saved), body["schema"], body["files"])
    for n in range(out.number + 1, number + 1):
        if n not in known:
            raise ValueError(f"commit {n} of {root} is gone")
        out = out.after(n, _entry(root, n))
    return out


def _older_state(root: Place) -> State:
    """The state of a table from before there were logs: a pointer to a version folder, which names the files it shares."""
    folder = _pointed(root)
    if folder is None or not committed(folder):
        return State()
    saved = json.loads(fs.text(fs.join(folder, COMMIT)))
    own = [f"{VERSIONS}/{fs.name(folder)}/{n}" for n in fs.names(folder) if n.startswith("part-")]
    return State(0, saved.get("schema"), {f: {} for f in [*saved.get("shared", []), *own]})


def point_to(root: Place, version: str, after: int | None = None) -> None:
    """Make the folder of version the current one, if the log still ends with the commit number after."""
    number = latest(root) if after is None else after
    if not _append(root, number + 1, {"folder": f"{VERSIONS}/{version}"}):
        raise Conflict(f"{root} has got another generation since commit {number}")


def current(root: Place) -> Place | None:
    """The last commit of a table, or the folder of the current generation; None if there never was one. A damaged pointer raises ValueError."""
    root = fs.place(root)
    if number := latest(root):
        folder = _entry(root, number).get("folder")
        return fs.join(root, *folder.split("/")) if folder else _entry_path(root, number)
    return _pointed(root)


def _pointed(root: Place) -> Place | None:
    """The version folder that a pointer of former times names."""
    pointer = fs.join(root, POINTER)
    if not fs.exists(pointer):
        return None
    version = json.loads(fs.text(pointer)).get("version", "")
    if not re.fullmatch("[0-9a-f]{32}", str(version)):
        raise ValueError(f"{pointer} names no version")
    return fs.join(root, VERSIONS, version)


def table_path(root: Place, name: str) -> Place:
    """Folder of a table, or the older one that ends in .parquet if only that is there."""
    root = fs.place(root)
    older, new = fs.join(root, f"{name}.parquet"), fs.join(root, name)
    return older if fs.exists(older) and not fs.exists(new) else new


def migrate_table(root: Place, name: str) -> Place:
    """Rename an older table folder to the name without ending."""
    older, new = table_path(root, name), fs.join(fs.place(root), name)
    if older != new:
        fs.rename(older, new)
    return new


# Reading


def _files(commit: Place) -> list[str]:
    """Files of a table after a commit of its log."""
    return list(state(fs.parent(fs.parent(commit)), int(fs.name(commit)[:-5])).files)


def may_hold(statistics: dict[str, Any], column: str, low: Any, high: Any) -> bool:
    """Whether a file with these statistics can have a value of column from low to high; None sets no bound."""
    if column in statistics.get("zones", {}):
        least, most = statistics["zones"][column]
        if least is None or (low is not None and most < low) or (high is not None and least > high):
            return False
    if column == statistics.get("key") and "keys" in statistics:
        keys = statistics["keys"]
        first = bisect.bisect_left(keys, low) if low is not None else 0
        return first < len(keys) and (high is None or keys[first] <= high)
    return True


def may_hold_any(statistics: dict[str, Any], key: str, keys: list[int]) -> bool:
    """Whether a file can have a row with one of the sorted keys."""
    if "zones" not in statistics or statistics.get("key") != key:
        return True
    least, most = statistics["zones"].get(key, (None, None))
    if least is None:
        return False
    between = keys[bisect.bisect_left(keys, least) : bisect.bisect_right(keys, most)]
    return bool(between) and ("keys" not in statistics or not set(statistics["keys"]).isdisjoint(between))


def _open(spark: SparkSession, root: Place, schema: str | None, files: list[str]) -> DataFrame:
    """Some files of a table, with its schema."""
    saved = StructType.fromJson(json.loads(schema)) if schema else None
    if not files:
        return spark.createDataFrame([], saved)
    return (spark.read.schema(saved) if saved else spark.read).parquet(*[str(fs.join(root, f)) for f in files])


def read_table(spark: SparkSession, root: Place, *, number: int | None = None, where: dict[str, Any] | None = None, keys: tuple[str, Iterable[int]] | None = None) -> DataFrame:
    """A table after a commit, the last one by default; a table without any is refused.

    where: a value, or a pair of least and greatest value (None: no bound), by
    column. keys: the key column and the values of it that are wanted. Files that the statistics rule out aren't opened; the rest is filtered
    row by row.
    """
    root = fs.place(root)
    if not has_table(root):
        raise ValueError(f"{root} holds no committed table")
    now = state(root, number)
    bounds = {c: v if isinstance(v, tuple) else (v, v) for c, v in (where or {}).items()}
    chosen = [f for f, s in now.files.items() if all(may_hold(s, c, *b) for c, b in bounds.items())]
    if keys:
        column, listed = keys[0], sorted({int(k) for k in keys[1]})
        chosen = [f for f in chosen if may_hold_any(now.files[f], column, listed)]
    rows = _open(spark, root, now.schema, chosen)
    if keys:
        rows = rows.join(bounded(spark.createDataFrame([(k,) for k in listed], f"{column} long"), len(listed)), column, "left_semi") if len(listed) > LISTED else rows.filter(F.col(column).isin(listed))
    for c, (low, high) in bounds.items():
        rows = rows.filter(F.col(c) == low) if low == high and low is not None else rows
        if low != high:
            rows = rows.filter(F.lit(True) if low is None else F.col(c) >= low).filter(F.lit(True) if high is None else F.col(c) <= high)
    return rows


def has_table(root: Place) -> bool:
    """Whether there is a committed table; data without any commit raise ValueError."""
    root = fs.place(root)
    if latest(root):
        return True
    folder = current(root)
    if folder is not None:
        return committed(folder)
    if any(n.endswith(".parquet") for n in fs.names(root)):
        raise ValueError(f"{root} holds files without a commit")
    return False


# Writing


def _keys_path(root: Place, keys: dict[str, str]) -> Place:
    return fs.join(root, LOG, keys["table"])


def _key_rows(spark: SparkSession, root: Place, key: str, keys: list[int] | dict[str, str]) -> DataFrame:
    """The keys that a commit has replaced, as rows."""
    if isinstance(keys, dict):
        return spark.read.schema(f"{key} long").parquet(str(_keys_path(root, keys)))
    return bounded(spark.createDataFrame([(k,) for k in keys], f"{key} long"), len(keys))


def _wanted(root: Place, key: str, keys: Iterable[int] | DataFrame | None) -> list[int] | dict[str, str] | None:
    """Keys as a commit has them: sorted in a list, or the name of a new table of them if they are rows and too many."""
    if not isinstance(keys, DataFrame):
        return None if keys is None else sorted({int(k) for k in keys})
    rows = keys.select(F.col(key).cast("long").alias(key)).distinct()
    if len(few := rows.limit(INLINE + 1).collect()) <= INLINE:
        return sorted(r[0] for r in few)
    out = {"table": f"keys-{uuid.uuid4().hex}"}
    rows.write.parquet(str(_keys_path(root, out)))
    return out


def _meet(root: Place, key: str, mine: list[int] | dict[str, str] | None, theirs: list[int] | dict[str, str] | None) -> bool:
    """Whether two commits have replaced the same key; None stands for all."""
    if mine is None or theirs is None:
        return mine != [] and theirs != []
    if isinstance(mine, list) and isinstance(theirs, list):
        return not set(mine).isdisjoint(theirs)
    spark = SparkSession.active()
    return not _key_rows(spark, root, key, mine).join(_key_rows(spark, root, key, theirs), key, "left_semi").isEmpty()


def _statistics(spark: SparkSession, root: Place, folder: str, schema: StructType, key: str) -> dict[str, dict[str, Any]]:
    """Statistics of the files of a folder, by one pass over their key and zone columns and one sum over whole rows."""
    names = [n for n in fs.names(fs.join(root, folder)) if n.startswith("part-")]
    if not names:
        return {}
    zones = [f.name for f in schema.fields if f.name in {*ZONES, key} and f.dataType.typeName() in ("long", "integer")]
    rows = spark.read.schema(schema).parquet(str(fs.join(root, folder))).withColumn("_file", F.col("_metadata.file_name"))
    listed = F.when(F.count_distinct(key) <= LISTED, F.sort_array(F.collect_set(key))) if key in zones else F.lit(None).cast("array<long>")
    bounds = [x for c in zones for x in (F.min(c).alias(f"_least_{c}"), F.max(c).alias(f"_most_{c}"))]
    found = rows.groupBy("_file").agg(F.count("*").alias("_rows"), listed.alias("_keys"), fingerprint(schema.names).alias("_fingerprint"), *bounds)
    out = {f"{folder}/{n}": {"rows": 0, "key": key, "zones": {c: (None, None) for c in zones}, "fingerprint": "0:0"} for n in names}
    for r in found.collect():  # a row per file
        out[f"{folder}/{r['_file']}"] |= {"rows": r["_rows"], "zones": {c: (r[f"_least_{c}"], r[f"_most_{c}"]) for c in zones}, "fingerprint": r["_fingerprint"]} | ({"keys": list(r["_keys"])} if r["_keys"] is not None else {})
    return out


def _written(df: DataFrame, root: Place, key: str, *, files: int | None, rows: int) -> dict[str, dict[str, Any]]:
    """Write df into a new folder of the table; statistics of its files. Nothing counts before it is committed."""
    folder = f"{DATA}/{uuid.uuid4().hex}"
    clustered(df, key, files=files, rows=rows).write.mode("errorifexists").parquet(str(fs.join(root, folder)))
    fs.sync(fs.join(root, folder))
    return _statistics(df.sparkSession, root, folder, df.schema, key)


def _commit(root: Place, base: State, entry: dict[str, Any]) -> int | None:
    """Append entry behind base, or behind commits that don't touch it; None if it must be made anew. Replaced keys that meet raise Conflict."""
    number = base.number + 1
    while not _append(root, number, entry):
        other = _entry(root, number)
        if _meet(root, entry["key"], entry["keys"], other["keys"]):
            raise Conflict(f"commit {number} of {root} has replaced the same {entry['key']}")
        if not set(entry["removed"]).isdisjoint(other["removed"]):
            return None
        number += 1
    if number % STATE_EVERY == 0:
        now = state(root, number)
        fs.put(fs.join(root, LOG, f"{number:020d}.state"), json.dumps({"schema": now.schema, "files": now.files}))
    return number


def replace_keys(spark: SparkSession, root: Place, fresh: DataFrame, key: str, keys: Iterable[int] | DataFrame | None, *, files: int | None = None, cached: bool = False, since: int | None = None, merge: bool = True) -> Place:
    """Replace the rows of some keys (all rows if keys is None) in a new commit of the table. Many keys come as a relation with the key column, so that the driver needn't hold them.

    Every row of fresh must have one of the keys. Only files that hold one of the
    keys are written anew, together with fresh; the others stay. since: the commit
    that the choice of the keys rests on, if that isn't the last one. Another
    writer who has replaced one of the keys since then causes Conflict, and nothing
    is changed. Unless the caller has cached fresh, it is kept on disk meanwhile, as
    both the check and the range sampling read it. merge: after some keys were replaced, bring together small
    files afterwards, if there are many.
    """
    root = fs.place(root)
    base = state(root)
    wanted, number = _wanted(root, key, keys), None
    held = None if cached else fresh.persist(StorageLevel.DISK_ONLY)
    try:
        if since is not None and since < base.number:
            for n in range(since + 1, base.number + 1):
                theirs = _entry(root, n)["keys"]
                if (theirs != [] if theirs is None or wanted is None else _meet(root, key, wanted, theirs)):
                    raise Conflict(f"commit {n} of {root} has replaced the same {key}")
        fresh_rows = fresh.count()
        named = None
        if wanted is not None:
            named = _key_rows(spark, root, key, wanted)
            if not fresh.join(named, key, "left_anti").isEmpty():
                raise ValueError(f"there are rows whose {key} isn't replaced")
        while True:
            rows, count, removed = fresh, fresh_rows, list(base.files)
            if wanted is not None:
                removed = _holding(spark, root, base, key, wanted, named)
                if removed:
                    stays = _open(spark, root, base.schema, removed).join(named, key, "left_anti").select(*fresh.columns)
                    known = [base.files[f].get("rows") for f in removed]
                    rows, count = stays.unionByName(fresh), count + (sum(known) if None not in known else stays.count())
            added = _written(rows, root, key, files=files, rows=count)
            number = _commit(root, base, {"key": key, "keys": wanted, "removed": removed, "added": added, "schema": rows.schema.json()})
            if number is not None:
                break
            fs.remove(fs.join(root, *next(iter(added)).split("/")[:2]))
            base = state(root)
    finally:
        if held is not None:
            held.unpersist(blocking=False)
        if number is None and isinstance(wanted, dict):
            fs.remove(_keys_path(root, wanted))
    if merge and wanted is not None:
        compact(spark, root, key)
    return _entry_path(root, number)


def _holding(spark: SparkSession, root: Place, base: State, key: str, wanted: list[int] | dict[str, str], named: DataFrame) -> list[str]:
    """Files with a row of one of the keys. Statistics rule most of them out; of the others only those without a list of keys are read, and only their key. Of many keys the bounds alone are held against the statistics."""
    if isinstance(wanted, dict):
        bounds = named.agg(F.min(key), F.max(key)).first()
        near = unsure = [f for f, s in base.files.items() if may_hold(s, key, *bounds)]
    else:
        near = [f for f, s in base.files.items() if may_hold_any(s, key, wanted)]
        unsure = [f for f in near if "keys" not in base.files[f]]
    if not unsure:
        return near
    hit = _open(spark, root, base.schema, unsure).select(key, F.col("_metadata.file_name").alias("f")).join(named, key, "left_semi").select("f").distinct()
    found = {r[0] for r in hit.collect()}  # names of files
    return [f for f in near if f not in set(unsure) or fs.name(f) in found]


def _tiers(now: State) -> dict[int, list[str]]:
    """Files by tier: 0 for the largest that are still too small, and so on down."""
    out: dict[int, list[str]] = {}
    for f, s in now.files.items():
        if "rows" in s and s["rows"] * MERGED <= FILE_ROWS:
            out.setdefault(len(f"{s['rows']:o}"), []).append(f)  # digits to the base of eight
    return out


def compact(spark: SparkSession, root: Place, key: str, *, least: int = MERGED) -> int:
    """Merge the files of every tier that has at least `least` of them, until no tier has; returns the merges.

    A row is rewritten once for each tier that it climbs, so the work for it grows
    with the logarithm of a file's size, and a table keeps fewer than `least` files
    of each tier. Small tables are kept in files for their tasks: files that files_for
    gives to the whole table are left alone. Where somebody else was quicker, the
    merge is dropped.
    """
    root, merges = fs.place(root), 0
    while True:
        now = state(root)
        total = sum(s.get("rows", 0) for s in now.files.values())
        full = [fs_ for _, fs_ in sorted(_tiers(now).items()) if len(fs_) >= least]
        if len(now.files) <= files_for(total) or not full:
            return merges
        chosen = full[0]
        rows = sum(now.files[f]["rows"] for f in chosen)
        files = max(1, -(-rows // FILE_ROWS))
        added = _written(_open(spark, root, now.schema, chosen), root, key, files=files, rows=rows)
        if _commit(root, now, {"key": key, "keys": [], "removed": chosen, "added": added, "schema": now.schema}) is None:
            fs.remove(fs.join(root, *next(iter(added)).split("/")[:2]))
            return merges
        merges += 1


def vacuum(root: Place, *, keep_seconds: float = 7 * 86400.0) -> int:
    """Delete data files that no commit of the last keep_seconds needs; returns how many.

    Spared are the files of every state that was current within that time, so
    readers that opened one may go on, and files that are younger, as they may be
    of a writer that hasn't committed yet. Commits before the oldest spared state
    are deleted, too, once a whole state stands in for them.
    """
    root, now = fs.place(root), time.time()
    numbers = log_numbers(root)
    if not numbers:
        return 0
    times = {n: _entry(root, n)["time"] for n in numbers}
    oldest = max([n for n in numbers if times[n] <= now - keep_seconds], default=numbers[0])
    spared = state(root, oldest)
    needed, base = set(spared.files), spared
    for n in (n for n in numbers if n > oldest):
        base = base.after(n, _entry(root, n))
        needed |= set(base.files)
    gone = 0
    for folder in fs.names(fs.join(root, DATA)):
        inside = [f"{DATA}/{folder}/{n}" for n in fs.names(fs.join(root, DATA, folder))]
        stay = [f for f in inside if f in needed]
        old = [f for f in inside if f not in needed and fs.modified(fs.join(root, *f.split("/"))) <= now - keep_seconds]
        if not stay and len(old) == len(inside):
            fs.remove(fs.join(root, DATA, folder))
        else:
            for f in old:
                fs.remove(fs.join(root, *f.split("/")))
        gone += sum(fs.name(f).startswith("part-") for f in old)
    if oldest > numbers[0]:
        fs.put(fs.join(root, LOG, f"{oldest:020d}.state"), json.dumps({"schema": spared.schema, "files": spared.files}))
        for n in (n for n in numbers if n < oldest):
            if isinstance(keys := _entry(root, n).get("keys"), dict):
                fs.remove(_keys_path(root, keys))
            fs.remove(_entry_path(root, n))
            fs.remove(fs.join(root, LOG, f"{n:020d}.state"))
    return gone


def verify(spark: SparkSession, root: Place) -> list[str]:
    """Files of a table whose rows aren't the ones that were written: another number, another sum of hashes, or no file at all."""
    root = fs.place(root)
    now = state(root)
    known = {f: s for f, s in now.files.items() if "fingerprint" in s}
    there = [f for f in known if fs.exists(fs.join(root, *f.split("/")))]
    if not there:
        return list(known)
    rows = _open(spark, root, now.schema, there)
    found = rows.groupBy(F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("f")).agg(F.count("*").alias("n"), fingerprint(rows.columns).alias("p"))
    told = {r["f"]: (r["n"], r["p"]) for r in found.collect()}  # a row per file
    return [f for f, s in known.items() if f not in there or told.get(fs.name(f), (0, "0:0")) != (s["rows"], s["fingerprint"])]


# Generations


def publish(spark: SparkSession, tables: dict[str, DataFrame], root: Place, *, rows: dict[str, int] | None = None, since: int | None = None) -> Place:
    """Publish the four tables of a generation together, or none of them.

    rows: numbers of rows that are known already; a table whose number isn't known
    is kept on disk while it is counted and written, so that it is made once.
    since: the commit that the tables rest on, if that isn't the last one. If
    another generation has been published meanwhile, Conflict is raised.
    """
    if set(tables) != set(GOLD_TABLES):
        raise ValueError(f"a generation has the tables {', '.join(GOLD_TABLES)}")
    root, version = fs.place(root), uuid.uuid4().hex
    after = latest(root) if since is None else since
    staging, folder = fs.join(root, f".staging-{version}"), fs.join(root, VERSIONS, version)
    try:
        for name, df in tables.items():
            key = "team_id" if name == "dim_teams" else "contest_id"
            count, held = (rows or {}).get(name), None
            if count is None:
                held = df.persist(StorageLevel.MEMORY_AND_DISK)
                count = held.count()
            try:
                write_version(clustered(df, key, rows=count), fs.join(staging, name))
            finally:
                if held is not None:
                    held.unpersist(blocking=False)
        for name, df in tables.items():
            written = spark.read.parquet(str(fs.join(staging, name)))
            if set(written.columns) != set(df.columns):
                raise ValueError(f"{name} was written with other columns")
        fs.sync(staging)
        fs.rename(staging, folder)
        try:
            point_to(root, version, after)
        except BaseException:
            fs.remove(folder)
            raise
        return folder
    finally:
        fs.remove(staging)


def generation(root: Place) -> Place:
    """Folder of the current generation; the root itself where there is no pointer. All four tables must be committed."""
    root = fs.place(root)
    folder = current(root) or root
    for name in GOLD_TABLES:
        if not committed(fs.join(folder, name)):
            raise ValueError(f"{fs.join(folder, name)} is not committed")
    return folder
