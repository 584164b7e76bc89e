"""The manifest as a relation."""

import json

import pytest

from scorelake.sources import documents
from scorelake.sources.documents import latest_snapshots, snapshot_table


def line(contest, time, path, status="STORED_NEW_VERSION"):
    return json.dumps({"contest_id": contest, "ingest_timestamp": time, "file_path": path, "status": status, "sha256": None})


@pytest.fixture
def folder(tmp_path):
    raw = tmp_path / "raw"
    (raw / "deep").mkdir(parents=True)
    for name in ("a1.json", "a2.json", "b1.json", "deep/c1.json"):
        (raw / name).write_text("{}")
    lines = [
        line(1, "t1", str(raw / "a1.json")),
        line(1, "t2", f"file:{raw}/a2.json"),
        line(1, "t3", str(raw / "gone.json")),  # the last version that is there counts
        line(1, "t9", str(raw / "a1.json"), "UNCHANGED"),
        "",
        line("2", "t1", "b1.json"),  # relative to the manifest
        line(3, "t1", "elsewhere/deep/none.json"),
        line(4, "t1", "deep/c1.json"),
        line(5, "t1", "/other/root/b1.json"),  # right in its last part
        line(6, "t1", ""),
    ]
    (raw / "m.jsonl").write_text("\n".join(lines) + "\n")
    return raw


def test_last_version_that_exists(spark, folder):
    want = [(1, "t2", f"file:{folder}/a2.json"), (2, "t1", f"{folder}/b1.json"), (4, "t1", f"{folder}/deep/c1.json"), (5, "t1", f"{folder}/b1.json")]
    assert latest_snapshots(folder / "m.jsonl") == want
    assert latest_snapshots(f"file:{folder}/m.jsonl") == [(c, t, p if p.startswith("file:") else f"file:{p}") for c, t, p in want]


def test_a_listing_finds_the_same(spark, folder, monkeypatch):
    monkeypatch.setattr(documents, "_existing", documents._listed)
    assert [s[:2] for s in latest_snapshots(folder / "m.jsonl")] == [(1, "t2"), (2, "t1"), (4, "t1"), (5, "t1")]


def test_order_over_many_lines_and_tasks(spark, folder, monkeypatch):
    lines = [line(k % 50, f"t{k}", str(folder / ("a1.json" if k % 3 else "gone.json"))) for k in range(5000)]
    (folder / "m.jsonl").write_text("\n".join(lines))
    monkeypatch.setattr(documents, "LOOKED_AT", 100)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64k")
    try:
        got = {c: t for c, t, _ in latest_snapshots(folder / "m.jsonl")}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    want = {}
    for k in range(5000):
        if k % 3:
            want[k % 50] = f"t{k}"
    assert got == want


def test_bad_manifests(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        snapshot_table(spark, tmp_path / "none")
    (tmp_path / "m").write_text("{}\nno json\n")
    with pytest.raises(ValueError, match="isn't JSON"):
        snapshot_table(spark, tmp_path / "m")
    (tmp_path / "m").write_text("")
    assert latest_snapshots(tmp_path / "m") == []
