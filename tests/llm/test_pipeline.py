import collections

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from scorelake.llm import mixing, queries

from .test_texts import brute_components, brute_quality, shingle_set


def test_stages_pass_documents_on(spark, docs, empty):
    plain = docs.select("doc_id", "text", "lang", "source", "n_chars")
    now = plain
    for name, stage in pipeline.STAGES:
        out = stage(spark, now, "")
        if name != "packing":
            assert out.columns == plain.columns
        before, now = now.collect(), out.cache()
        if name == "quality_rules":
            assert collections.Counter(r.text for r in now.collect()) == collections.Counter(r.text for r in before if brute_quality(r.text)[-1])
        if name == "near_dedup":
            rows = [(r.doc_id, r.text) for r in before]
            assert now.count() == len(set(brute_components(rows, 80)[1])) and all(shingle_set(r.text) for r in now.collect())
    assert {r.doc_id for r in now.collect()} <= {r.doc_id for r in docs.collect()}
    left = empty.select(*plain.columns)
    for _, stage in pipeline.STAGES:
        left = stage(spark, left, "")
    assert left.count() == 0


def test_all_operators_are_registered():
    names = queries.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n != "pipeline") == list(range(1, 14))
    assert set(queries.oracle_sql()) <= set(names)


def folders(spark, run_id):
    from pathlib import Path

    from scorelake.llm.common import shared_folder

    return Path(shared_folder(spark).removeprefix("file:"), f"pipeline-{run_id}")


def test_a_run_goes_on_behind_its_last_complete_stage(spark, docs, tmp_path, monkeypatch):
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(str(tmp_path / "documents.parquet"))
    ran = []

    def counted(name, f, fails=()):
        def stage(spark, docs, sf_dir):
            ran.append(name)
            if name in fails:
                raise OSError("lost")
            return f(spark, docs, sf_dir)

        return name, stage

    stages = pipeline.STAGES
    monkeypatch.setattr(pipeline, "STAGES", [counted(n, f, ("secret_scan",)) for n, f in stages])
    with pytest.raises(OSError):
        pipeline.run(spark, str(tmp_path), "one")
    names = [n for n, _ in stages]
    assert ran == names[:3] and sorted(p.name for p in folders(spark, "one").iterdir()) == ["near_dedup"]  # the first is not needed any more
    monkeypatch.setattr(pipeline, "STAGES", [counted(n, f) for n, f in stages])
    ran.clear()
    out = pipeline.run(spark, str(tmp_path), "one")
    assert ran == names[2:] and [p.name for p in folders(spark, "one").iterdir()] == ["packing"]
    ran.clear()
    assert sorted(map(str, pipeline.run(spark, str(tmp_path), "one").collect())) == sorted(map(str, out.collect())) and not ran
    whole = pipeline.run(spark, str(tmp_path), "two")
    key = lambda df: sorted((r.doc_id, r.start, r.length, r.ids_crc32) for r in df.collect())
    assert key(whole) == key(out) and ran == names


def test_later_stages_equal_plain_versions(spark, docs, tmp_path):
    """Redaction, mixing and packing, each on its own input."""
    import re as rx

    given = docs.select("doc_id", "text", "lang", "source", "n_chars").withColumn("text", F.when(F.col("doc_id") % 5 == 0, F.concat("text", F.lit(" token=Qp44zzT1xW0ccVb88"), "doc_id")).otherwise(F.col("text")))
    stage = dict(pipeline.STAGES)
    clean = {r.doc_id: r.text for r in stage["secret_scan"](spark, given, "").filter("doc_id is not null").collect()}
    for r in given.filter("doc_id is not null").collect():
        assert clean[r.doc_id] == (None if r.text is None else rx.sub(r"token=[A-Za-z0-9+/_.=-]{12,}", "[SECRET]", r.text))
    mixed = collections.Counter(r.doc_id for r in stage["source_mix"](spark, given, "").collect())
    taken = {r.doc_id: (r.taken, r.size) for r in mixing.mix(given.filter("doc_id is not null"), weights=(5, 2, 1), share=1.0, most=3.0).collect()}
    assert mixed and all(n <= 3 for k, n in mixed.items() if k not in (None, 0)) and set(mixed) - {None} <= set(taken)
    pieces = stage["packing"](spark, given, "")
    tokens = pieces.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max("offset").alias("last")).collect()
    assert max(r.n for r in tokens) <= 4096 and pieces.agg(F.sum("length")).first()[0] == pieces.filter("start = 0").agg(F.sum("doc_tokens")).first()[0]
