import json
import re
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from scorelake.operators import silver
from scorelake.plans import load_test
from scorelake.sources import ingest, synth

from .helpers import document


def figures(capsys, spark, *arguments):
    load_test.main([str(a) for a in arguments], spark)
    return json.loads(capsys.readouterr().out)


def test_commands_of_a_load_test(spark, tmp_path, capsys):
    root = tmp_path / "load"
    made = figures(capsys, spark, "generate", "--root", root, "--plays", 600, "--seed", 7)
    assert made["plays"] == 600 == sum(made["events"].values()) and made["contests"] >= 2
    manifest = root / "raw" / synth.MANIFEST
    lines = manifest.read_text().splitlines()
    manifest.write_text("\n".join(lines[:1]) + "\n")  # as if it had been broken off
    assert figures(capsys, spark, "generate", "--root", root, "--plays", 600, "--seed", 7) == made
    assert manifest.read_text().splitlines()[:1] == lines[:1]
    with pytest.raises(ValueError, match="another seed"):
        load_test.generate(spark, root, 600, 8)
    assert figures(capsys, spark, "validate", "--root", root)["plays"] == 600
    assert figures(capsys, spark, "validate", "--root", root, "--sample", 1)["contests"] == 1
    assert figures(capsys, spark, "run-etl", "--root", root)["seconds"]["silver_plays"] > 0
    assert figures(capsys, spark, "run-silver-gold", "--root", root)["wall_seconds"] > 0
    with pytest.raises(ValueError, match="already"):
        load_test.run_silver_gold(spark, root)
    asked = figures(capsys, spark, "run-serving", "--root", root, "--rounds", 2)
    assert set(asked) == set(load_test.ASKED) and all(x["requests"] == 2 and x["p50_ms"] <= x["p99_ms"] for x in asked.values())
    path = Path(re.sub("^file:/+", "/", json.loads(manifest.read_text().splitlines()[-1])["file_path"]))
    (path.parent / f".{path.name}.crc").unlink()
    path.write_text(path.read_text().replace("final", "Final"))
    with pytest.raises(ValueError, match="digest"):
        load_test.validate(spark, root)


def test_templates_are_resized_and_renamed(spark, tmp_path):
    stats = []
    for i in range(210):
        stats.append((11, "9:00", f"Shot by Lake Valley Al Ames{i % 3} WIDE.") if i % 3 else (22, "8:00", "Turnover by Coast Tech Bo Byrd (caused by Ames1, Al)."))
    stats += [(11, "7:00", ("GOAL by LV Cy Cole, Assist by Al Ames1.", 1, 0)), (None, "6:00", "Faceoff Al Ames1 vs Bo Byrd won by Coast Tech, Ground ball pickup by Lake Valley Al Ames2."), (None, None, "Media timeout")]
    for c in (1, 2):
        ingest.ingest(c, tmp_path / "raw", lambda _, c=c: document(c, stats))
    templates = load_test._documents(spark, tmp_path / "raw" / ingest.MANIFEST)
    made = synth.templated_documents(templates, 950, 3).cache()
    plays = load_test.spoken_plays(made)
    assert plays.count() == 950 and sorted(r[0] for r in made.select(F.size("teams")).distinct().collect()) == [2]
    texts = [r[0] for r in plays.select("play.playText").collect()]
    assert not [t for t in texts if any(x in t for x in ("Ames", "Byrd", "Cole", "Lake", "Coast", "LV"))] and "Media timeout" in texts
    parsed = silver.plays_of(made.select("contest_id", "ingest_timestamp", "teams", "periods"))
    known = parsed.filter("event_type in ('SHOT', 'GOAL', 'TURNOVER')")
    assert known.filter("team_id is null or primary_player_name is null").count() == 0 and known.select("event_team_short").distinct().count() >= 4
    assert parsed.filter("event_type = 'FACEOFF' and faceoff_winner_player is null").count() == 0
    assert synth.templated_documents(templates, 950, 3).exceptAll(made).count() == 0
