"""Content-addressed storage of raw snapshots with an audit manifest."""

from __future__ import annotations

import argparse
import hashlib
import json
from collections.abc import Callable
from datetime import datetime, timezone
from pathlib import Path
from typing import Any

MANIFEST = "ingest_manifest.jsonl"


def payload_hash(payload: dict[str, Any]) -> str:
    """SHA-256 of the compact JSON with sorted keys; the order of arrays counts."""
    return hashlib.sha256(json.dumps(payload, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def last_hash(manifest: Path, contest_id: int) -> str | None:
    """Hash of the version of a contest that was stored last; lines that are no JSON are passed over."""
    found = None
    if manifest.exists():
        for line in manifest.read_text().splitlines():
            try:
                entry = json.loads(line)
            except json.JSONDecodeError:
                continue
            if entry.get("contest_id") == contest_id and entry.get("status") == "STORED_NEW_VERSION":
                found = entry.get("sha256")
    return found


def fetch_http(contest_id: int, url: str, *, timeout: float = 30.0, opener: Callable[..., Any] | None = None) -> dict[str, Any]:
    """Get a document over HTTP; url has a field {contest_id}. Errors of the server are raised."""
    from urllib.request import urlopen

    with (opener or urlopen)(url.format(contest_id=contest_id), timeout=timeout) as answer:
        return json.load(answer)


def ingest(contest_id: int, folder: str | Path, fetch: Callable[[int], dict[str, Any]], *, now: Callable[[], datetime] = lambda: datetime.now(timezone.utc)) -> str:
    """Fetch a contest and store it if it is new: STORED_NEW_VERSION, UNCHANGED or INVALID.

    A document without teams or periods is not stored. Every attempt leaves a line
    in the manifest.
    """
    folder, payload = Path(folder), fetch(contest_id)
    game = ((payload or {}).get("data") or {}).get("playbyplay") or {}
    stamp, digest = now().strftime("%Y%m%dT%H%M%SZ"), payload_hash(payload)
    path = folder / f"contest_id={contest_id}" / f"ingest_timestamp={stamp}.json"
    if not game.get("teams") or not game.get("periods"):
        status = "INVALID"
    elif last_hash(folder / MANIFEST, contest_id) == digest:
        status = "UNCHANGED"
    else:
        status = "STORED_NEW_VERSION"
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(json.dumps(payload))
    folder.mkdir(parents=True, exist_ok=True)
    entry = {"contest_id": contest_id, "ingest_timestamp": stamp, "sha256": digest, "file_path": str(path) if status == "STORED_NEW_VERSION" else None, "status": status, "game_status": game.get("status"), "periods_count": len(game.get("periods") or [])}
    with (folder / MANIFEST).open("a") as out:
        out.write(json.dumps(entry) + "\n")
    return status


def main(arguments: list[str] | None = None) -> None:
    """Fetch contests and store what is new; prints the outcome of each."""
    parser = argparse.ArgumentParser(description="Fetch contests and store their documents if they are new.")
    parser.add_argument("--contest-id", type=int, required=True, nargs="+")
    parser.add_argument("--url", required=True, help="address of a document with a field {contest_id}")
    parser.add_argument("--folder", default="raw")
    args = parser.parse_args(arguments)
    for contest_id in args.contest_id:
        print(json.dumps({"contest_id": contest_id, "status": ingest(contest_id, args.folder, lambda c: fetch_http(c, args.url))}))


if __name__ == "__main__":
    main()
