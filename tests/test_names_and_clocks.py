import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scorelake import catalogue
from scorelake.functions.text import clock_seconds, event_type, label, person_name, shot_result
from scorelake.operators.teams import metadata_labels

NAMES = {
    "Vale, Jo": "Jo Vale",
    "Jo Vale": "Jo Vale",
    "Ash, Jr., Lee": "Lee Ash Jr.",
    "Ash, Lee, Jr.": "Lee Ash Jr.",
    "Ash Jr., Lee": "Lee Ash Jr.",
    "de Witt, Ann": "Ann de Witt",
    "Roe, III, Max": "Max Roe III",
    "Roe, Max, Ann": "Max Ann Roe",
    "Ash, IV": "Ash IV",
    "team": "TEAM",
    " bench ": "BENCH",
    "  Vale   ,  Jo ": "Jo Vale",
    "": None,
    "   ": None,
    None: None,
}


def test_person_names(spark):
    rows = spark.createDataFrame([(k,) for k in NAMES], "raw string").select("raw", person_name(F.col("raw")).alias("name")).collect()
    assert {r.raw: r.name for r in rows} == NAMES


def test_event_types_are_case_sensitive_and_ordered(spark):
    texts = {"GOAL by X A.": "GOAL", "goal by X": "UNKNOWN", "Shot by X": "SHOT", "Ground ball pickup by X": "GROUND_BALL", "A at goalie for X": "GOALIE_CHANGE", "End-of-period 1": "PERIOD_END", "Faceoff A vs B at goalie for": "FACEOFF"}
    rows = spark.createDataFrame(list(texts.items()), "t string, e string").select("e", event_type(F.col("t")).alias("got")).collect()
    assert all(r.e == r.got for r in rows)


def test_shot_results(spark):
    texts = {"GOAL by X A.": "GOAL", "Shot by X A WIDE.": "WIDE", "Shot by X A HIT POST": "POST", "Shot by X A HIT CROSSBAR..": "CROSSBAR", "Shot by X A, SAVE B.": "SAVE", "Shot by X A.": None, "Turnover by X WIDE": None}
    rows = spark.createDataFrame(list(texts.items()), "t string, e string").select("e", shot_result(F.col("t")).alias("got")).collect()
    assert all(r.e == r.got for r in rows)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(0, 5999), min_size=1, max_size=50))
def test_clocks_round_trip(spark, seconds):
    rows = spark.createDataFrame([(f"{s // 60}:{s % 60:02d}", s) for s in seconds], "c string, s int").select("s", clock_seconds(F.col("c")).alias("got")).collect()
    assert all(r.s == r.got for r in rows)


def test_clock_without_colon_is_zero_and_bad_digits_raise(spark):
    df = spark.createDataFrame([("12",), ("",)], "c string").select(clock_seconds(F.col("c")).alias("s"))
    assert [r.s for r in df.collect()] == [0, 0]
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("a:b",)], "c string").select(clock_seconds(F.col("c"))).collect()


def test_labels(spark):
    df = spark.createDataFrame([("  lake  val.. ",)], "t string").select(label(F.col("t")).alias("l"))
    assert df.first().l == "LAKE VAL"


def test_labels_of_short_and_missing_names(spark):
    short = spark.range(1).select(metadata_labels(F.lit(None).cast("string"), F.lit("ab"), F.lit("")).alias("a"), metadata_labels(F.lit("x"), F.lit("x"), F.lit("abc")).alias("b"), metadata_labels(F.lit(" ab  cd. "), F.lit(None).cast("string"), F.lit("Ab cd")).alias("c")).first()
    assert short.a == ["AB", "A"] and short.b == ["X", "ABC", "A"] and short.c == ["AB CD", "AC", "AB", "AB C"]


def test_labels_of_a_small_file_are_many_tasks_work(spark, tmp_path):
    customers = spark.range(250_000).select(F.col("id").alias("c_custkey"), F.lit("AUTO").alias("c_mktsegment"), F.concat(F.lit("C"), F.col("id")).alias("c_name"))
    customers.coalesce(1).write.parquet(str(tmp_path / "customer.parquet"))
    found = catalogue.label_candidates(spark, str(tmp_path))
    assert catalogue.spread(spark.range(250_000).coalesce(1)).rdd.getNumPartitions() == 3
    assert found.rdd.getNumPartitions() == 3 and found.count() == 250_000
