"""Commits of several writers, files that statistics leave out, compaction, retention and fingerprints."""

import time

import pytest

from scorelake.operators.fingerprint import added, fingerprint
from scorelake.plans import store
from scorelake.sources import files

SCHEMA = "contest_id long, period_number int, v string"


def rows(spark, *values):
    return spark.createDataFrame([(c, p, v) for c, p, v in values], SCHEMA)


def contests(spark, n, v="a"):
    return rows(spark, *[(c, p, v) for c in range(n) for p in (1, 2)])


def held(spark, root, **where):
    return sorted(map(tuple, store.read_table(spark, root, where=where or None).collect()), key=str)


def interleaved(monkeypatch, other):
    """Let other() commit while a replacement has written its files and not yet committed."""
    write, done = store._written, []

    def slow(*arguments, **more):
        out = write(*arguments, **more)
        if not done:
            done.append(1)
            other()
        return out

    monkeypatch.setattr(store, "_written", slow)


@pytest.mark.parametrize("scheme", ["", "file:"])
def test_writers_of_different_keys_both_stay(spark, tmp_path, monkeypatch, scheme):
    root = f"{scheme}{tmp_path}/t"
    store.replace_keys(spark, root, contests(spark, 4), "contest_id", None, files=1)  # one file that both must rewrite
    interleaved(monkeypatch, lambda: store.replace_keys(spark, root, rows(spark, (2, 1, "other")), "contest_id", [2]))
    store.replace_keys(spark, root, rows(spark, (1, 1, "mine")), "contest_id", [1])
    assert held(spark, root) == sorted([(0, 1, "a"), (0, 2, "a"), (1, 1, "mine"), (2, 1, "other"), (3, 1, "a"), (3, 2, "a")])
    assert store.log_numbers(root) == [1, 2, 3]


def test_a_writer_that_shares_no_file_takes_the_next_number(spark, tmp_path, monkeypatch):
    store.replace_keys(spark, tmp_path, contests(spark, 8), "contest_id", None, files=4)
    counted, write = [], store._written
    interleaved(monkeypatch, lambda: store.replace_keys(spark, tmp_path, rows(spark, (7, 1, "other")), "contest_id", [7]))
    inner = store._written
    monkeypatch.setattr(store, "_written", lambda *a, **k: (counted.append(1), inner(*a, **k))[1])
    store.replace_keys(spark, tmp_path, rows(spark, (0, 1, "mine")), "contest_id", [0])
    assert len(counted) == 2 and write is not inner  # each of the two wrote once
    assert held(spark, tmp_path, contest_id=0) == [(0, 1, "mine")] and held(spark, tmp_path, contest_id=7) == [(7, 1, "other")]


def test_writers_of_one_key_conflict(spark, tmp_path, monkeypatch):
    store.replace_keys(spark, tmp_path, contests(spark, 4), "contest_id", None)
    interleaved(monkeypatch, lambda: store.replace_keys(spark, tmp_path, rows(spark, (1, 1, "other")), "contest_id", [1, 2]))
    with pytest.raises(store.Conflict):
        store.replace_keys(spark, tmp_path, rows(spark, (1, 1, "mine")), "contest_id", [1])
    assert held(spark, tmp_path, contest_id=1) == [(1, 1, "other")]
    monkeypatch.undo()
    interleaved(monkeypatch, lambda: store.replace_keys(spark, tmp_path, rows(spark, (3, 1, "other")), "contest_id", [3]))
    with pytest.raises(store.Conflict):
        store.replace_keys(spark, tmp_path, contests(spark, 4, "all"), "contest_id", None)
    monkeypatch.undo()
    with pytest.raises(store.Conflict):  # the choice of the key rests on commit 2
        store.replace_keys(spark, tmp_path, rows(spark, (3, 1, "late")), "contest_id", [3], since=2)
    store.replace_keys(spark, tmp_path, rows(spark, (0, 1, "late")), "contest_id", [0], since=2)
    assert held(spark, tmp_path, contest_id=(0, 0)) == [(0, 1, "late")] and held(spark, tmp_path, contest_id=3) == [(3, 1, "other")]


def test_one_generation_of_two_that_rest_on_the_same(spark, tmp_path):
    def tables(n):
        one = spark.createDataFrame([(7, 1, n)], "contest_id long, team_id long, goals int")
        return dict.fromkeys(store.GOLD_TABLES, one)

    store.publish(spark, tables(1), tmp_path)
    since = store.latest(tmp_path)
    second = store.publish(spark, tables(2), tmp_path, since=since)
    with pytest.raises(store.Conflict):
        store.publish(spark, tables(3), tmp_path, since=since)
    assert store.generation(tmp_path) == second and len(list((tmp_path / store.VERSIONS).iterdir())) == 2


def test_put_if_absent(spark, tmp_path):
    for path in (tmp_path / "a", f"file:{tmp_path}/b", f"viewfs://none/{tmp_path}/c"):
        if str(path).startswith("viewfs"):
            spark.sparkContext._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.none.link./tmp", "file:///tmp")
            if not str(tmp_path).startswith("/tmp/"):
                continue
        files.create(path, "one")
        with pytest.raises(FileExistsError):
            files.create(path, "two")
        assert files.text(path) == "one" and files.names(tmp_path)[-1] == files.name(path)


def test_statistics_leave_out_files(spark, tmp_path):
    store.replace_keys(spark, tmp_path, contests(spark, 40), "contest_id", None, files=8)
    opened = lambda **where: len(store.read_table(spark, tmp_path, where=where).inputFiles())
    assert opened() == 8 and opened(contest_id=17) == 1 and opened(contest_id=99) == 0
    assert opened(contest_id=(0, 9)) < 4 and opened(period_number=(3, None)) == 0 and opened(contest_id=(35, None), period_number=2) <= 2
    assert held(spark, tmp_path, contest_id=17) == [(17, 1, "a"), (17, 2, "a")]
    assert len(held(spark, tmp_path, contest_id=(10, 12), period_number=(None, 1))) == 3
    # a file of scattered keys: its list of keys tells what its bounds can't
    store.replace_keys(spark, tmp_path, rows(spark, (0, 1, "b"), (39, 1, "b")), "contest_id", [0, 39], files=1, merge=False)
    assert opened(contest_id=20) == 1 and held(spark, tmp_path, contest_id=39) == [(39, 1, "b")]


def test_replacement_reads_only_keys_of_files_that_may_hold_them(spark, tmp_path, monkeypatch):
    store.replace_keys(spark, tmp_path, contests(spark, 40), "contest_id", None, files=8)
    read, open_ = [], store._open
    monkeypatch.setattr(store, "_open", lambda s, r, c, f: (read.append(len(f)), open_(s, r, c, f))[1])
    store.replace_keys(spark, tmp_path, rows(spark, (17, 1, "b")), "contest_id", [17], merge=False)
    assert read == [1]
    monkeypatch.setattr(store, "LISTED", 0)  # without lists of keys the bounds still leave out most
    store.replace_keys(spark, tmp_path, rows(spark, (100, 1, "b")), "contest_id", [100], merge=False)
    assert read == [1]


def test_many_small_replacements_leave_few_files(spark, tmp_path):
    n = 60
    store.replace_keys(spark, tmp_path, contests(spark, n), "contest_id", None, files=1)
    first = store.read_table(spark, tmp_path)
    for c in range(n, 2 * n):
        store.replace_keys(spark, tmp_path, rows(spark, (c, 1, "new")), "contest_id", [c])
    now = store.state(tmp_path)
    assert len(now.files) < 2 * store.MERGED and sum(s["rows"] for s in now.files.values()) == 3 * n
    assert store.read_table(spark, tmp_path).count() == 3 * n and first.count() == 2 * n
    assert held(spark, tmp_path, contest_id=n + 7) == [(n + 7, 1, "new")]
    assert store.verify(spark, tmp_path) == []
    assert store.vacuum(tmp_path, keep_seconds=3600) == 0 and first.count() == 2 * n
    old = store.state(tmp_path, 5)
    assert len(old.files) == 5 and store.read_table(spark, tmp_path, number=5).count() == 2 * n + 4
    time.sleep(1.1)
    assert store.vacuum(tmp_path, keep_seconds=1) > 50
    assert held(spark, tmp_path, contest_id=n + 7) == [(n + 7, 1, "new")] and store.read_table(spark, tmp_path).count() == 3 * n
    assert len(store.log_numbers(tmp_path)) == 1
    store.replace_keys(spark, tmp_path, rows(spark, (0, 1, "last")), "contest_id", [0])
    assert store.read_table(spark, tmp_path).count() == 3 * n - 1 and store.verify(spark, tmp_path) == []
    with pytest.raises(ValueError, match="gone"):
        store.state(tmp_path, 4)


def test_merge_is_dropped_where_somebody_was_quicker(spark, tmp_path, monkeypatch):
    store.replace_keys(spark, tmp_path, contests(spark, 2), "contest_id", None, files=1)
    for c in range(10, 20):
        store.replace_keys(spark, tmp_path, rows(spark, (c, 1, "b")), "contest_id", [c], merge=False)
    interleaved(monkeypatch, lambda: store.replace_keys(spark, tmp_path, rows(spark, (12, 1, "c")), "contest_id", [12], merge=False))
    assert store.compact(spark, tmp_path, "contest_id") == 0
    monkeypatch.undo()
    assert store.compact(spark, tmp_path, "contest_id") > 0
    assert held(spark, tmp_path, contest_id=12) == [(12, 1, "c")] and store.read_table(spark, tmp_path).count() == 14


def test_damage_is_found(spark, tmp_path):
    store.replace_keys(spark, tmp_path, contests(spark, 9), "contest_id", None, files=3)
    one, two, three = store.state(tmp_path).files
    assert store.verify(spark, tmp_path) == []
    (tmp_path / one).unlink()
    other = tmp_path / "other"
    rows(spark, (1, 1, "a"), (1, 1, "a")).coalesce(1).write.parquet(str(other))
    (tmp_path / two).parent.joinpath(f".{files.name(two)}.crc").unlink(missing_ok=True)
    next(other.glob("part-*")).replace(tmp_path / two)
    assert set(store.verify(spark, tmp_path)) == {one, two}


def test_fingerprints_count_rows(spark):
    df = contests(spark, 50)
    whole = lambda x: x.agg(fingerprint(x.columns)).first()[0]
    assert whole(df) == whole(df.repartition(7).select("v", "contest_id", "period_number"))
    assert whole(df) == added([whole(df.filter("contest_id < 9")), whole(df.filter("contest_id >= 9"))])
    twice = df.unionByName(df.filter("contest_id = 3")).unionByName(df.filter("contest_id = 3"))
    assert whole(df) != whole(twice) and whole(df.filter("false")) == "0:0"
    nulls = spark.createDataFrame([(None, 1, "a"), (1, None, "a")], "a long, b long, c string")
    assert whole(nulls.limit(1)) != whole(nulls.select("b", "a", "c").toDF("a", "b", "c").limit(1))


def test_tables_from_before_the_log(spark, tmp_path):
    version = "0" * 32
    store.write_version(contests(spark, 3), tmp_path / store.VERSIONS / version)
    files.put(tmp_path / store.POINTER, f'{{"version": "{version}"}}')
    assert store.has_table(tmp_path) and store.read_table(spark, tmp_path, where={"contest_id": 1}).count() == 2
    store.replace_keys(spark, tmp_path, rows(spark, (1, 1, "b")), "contest_id", [1])
    assert held(spark, tmp_path, contest_id=1) == [(1, 1, "b")] and store.read_table(spark, tmp_path).count() == 5
