"""Work that grew faster than the tables: steps that were done twice, and expressions that were evaluated wherever they were used."""

import os

import pytest
from pyspark.sql import functions as F

from boutlens.functions import scalars
from boutlens.operators import asof, cards, coverage, derived, paths, scoring
from boutlens.plans import QUERIES
from boutlens.schema import SUMMED
from boutlens.sources import files

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_duration_reads_its_clock_once(spark):
    rows = [(2, "1:30", "3 Rnd (5-5-5)", 390), (1, "0:00", "3 Rnd (5-5-5)", None), (4, "1:00", "3 Rnd (5-5-5)", None), (1, "7:00", "No Time Limit", 420),
            (2, "5:01", "3 Rnd (5-5-5)", None), (None, "1:00", "3 Rnd (5-5-5)", None), (1, None, None, None), (0, "1:00", "3 Rnd (5-5-5)", None), (1, "1:60", "1 Rnd (5)", None)]
    df = spark.createDataFrame(rows, "r int, c string, f string, expected int").withColumn("got", scalars.duration_seconds(F.col("r"), F.col("c"), F.col("f")))
    assert plan_of(df).count("regexp_extract(") <= 4
    assert [r.got for r in df.collect()] == [r[3] for r in rows]


@needs_tables
def test_style_metrics_are_made_once(spark, monkeypatch):
    """A matchup aggregated all perspective rows for its ranks, and once more for its values."""
    made, real = [], asof.entity_metrics
    monkeypatch.setattr(asof, "entity_metrics", lambda df: made.append(1) or real(df))
    df = QUERIES["style_matchup"](spark, SMALL)
    assert made == [1] and df.count() > 0


@needs_tables
def test_evidence_is_neither_gathered_nor_joined_with_itself(spark):
    """Bouts were gathered into arrays, and all paths were made twice to put verdicts beside them."""
    plan = plan_of(QUERIES["evidence_paths"](spark, SMALL))
    assert "collect_list" not in plan and plan.count("Join LeftOuter") == 1 and "lineitem" not in plan


def test_elements_as_rows_have_the_paths_of_an_array(spark):
    rows = spark.createDataFrame([("x", 1, "KO", 2), ("x", 7, None, 3)], "side string, fight_id long, method string, round int")
    whole = rows.groupBy("side").agg(F.collect_list(F.struct("fight_id", "method", "round")).alias("bouts"))
    long = files.long_evidence(whole, ["side"]).filter("field != 'fight_id'")
    got = files.element_evidence(rows, ["side"], "bouts", "fight_id", ("method", "round"))
    assert got.columns == long.columns and sorted(map(str, got.collect())) == sorted(map(str, long.collect()))
    claims = spark.createDataFrame([("x", "bouts.1.round", "2.0"), ("x", "bouts.1.method", "Sub"), ("x", "bouts.7.method", None)], "side string, path string, value string")
    claims = claims.withColumn("claim_id", F.col("path"))
    said = {r.path: r.claim for r in coverage.with_verdicts(got, claims).collect()}
    assert said == {**{r.claim_id: r.status for r in coverage.claim_check(claims, got).collect()}, "bouts.7.round": None}


@pytest.mark.parametrize("listed", [0, 2, 1000])
def test_common_opponents_are_found_among_ids(spark, listed):
    """Results of both sides were carried through a row for each opponent of each pair."""
    met = [(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4), (5, 1), (1, 2), (4, 2)]
    sides = [(f, x, y) for f, (a, b) in enumerate(met) for x, y in ((a, b), (b, a))]
    persp = spark.createDataFrame(sides, "fight_id long, fighter_id long, opponent_id long").withColumns({"event_date": F.lit("2000-01-01").cast("date"), "bout_outcome": F.lit("win")})
    pairs = spark.createDataFrame([*met, (2, 1), (5, 2)], "a_id long, b_id long")
    got = {(r.a_id, r.b_id, r.opponent_id): ([x.fight_id for x in r.a_results], [x.fight_id for x in r.b_results]) for r in paths.common_opponents(pairs, persp, listed).collect()}
    fights = lambda x, y: [f for f, a, b in sides if (a, b) == (x, y)]
    asked = {(r.a_id, r.b_id) for r in pairs.collect()}
    assert got == {(a, b, o): (fights(a, o), fights(b, o)) for a, b in asked for o in range(1, 6) if fights(a, o) and fights(b, o)}


def test_final_aggregates_read_their_rows_once(spark):
    """The rows were joined with what ended the streaks in them."""
    rows = spark.createDataFrame([(1, i, o) for i, o in enumerate(["win", "draw", "win", "no_contest", "win", None], 1)] + [(2, 1, "loss"), (2, 2, "loss")], "fighter_id long, fighter_sequence int, bout_outcome string")
    persp = rows.withColumns({**{f"bout_{c}": F.lit(1) for c in SUMMED}, "event_date": F.lit("2000-01-01").cast("date")})
    df = derived.final_aggregates(persp)
    assert "Join" not in plan_of(df)
    assert {r.fighter_id: (r.fights, r.current_win_streak, r.current_loss_streak) for r in df.collect()} == {1: (6, 2, 0), 2: (2, 0, 2)}


def test_identity_sets_read_each_side_once(spark):
    """Each side was read four times, for distinct counts and two joins."""
    schema = "event_id string, fight_url string, fight_id long"
    urls = spark.createDataFrame([("a", "u1", 1), ("a", "u2", 2), ("b", "u3", 3), ("b", "u3", 4), ("c", None, 5), ("d", "u6", 6)], schema)
    sent = spark.createDataFrame([("a", "u1", 1), ("a", "u2", 2), ("b", "u3", 3), ("b", "u4", 4), ("c", None, 5), ("d", "u6", 6), ("d", "u6", 6)], schema)
    df = cards.identity_sets(urls, sent)
    assert "Join" not in plan_of(df)
    both = {("c", f"{x} repeats a url or an id") for x in ("card", "summary")} | {(e, p) for e in "bc" for p in ("summary missing", "summary without url")}
    assert {tuple(r) for r in df.collect()} == both | {("b", "card repeats a url or an id"), ("d", "summary repeats a url or an id")}


def test_grams_of_outputs_stay_where_they_are(spark):
    """Every gram of every output was shuffled to meet the few protected ones."""
    few = spark.createDataFrame([("a b c d",)], "text_words string")
    outputs = spark.createDataFrame([(1, "x a b c d y"), (2, "a b d")], "id long, text_words string")
    df = coverage.quotes(outputs, coverage.protected_grams(few), "id")
    assert "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString() and "strategy=broadcast" in plan_of(df)
    assert [tuple(r) for r in df.collect()] == [(1, 1)]


def test_words_keep_letters_and_digits_of_any_text(spark):
    import unicodedata

    texts = ["".join(map(chr, range(0x500))), "Éa_b-C9\n\tß İ", "", " ", None]
    got = [r.w for r in spark.createDataFrame([(x,) for x in texts], "x string").select(scalars.words(F.col("x")).alias("w")).collect()]
    plain = lambda x: unicodedata.normalize("NFKD", x).encode("ascii", "ignore").decode().lower()
    assert got == [None if x is None else " ".join("".join(c if c.isalnum() else " " for c in plain(x)).split()) for x in texts]


@needs_tables
def test_a_rebuild_reads_its_contests_once(spark):
    """Contests were made and numbered twice, and the rows of both sides were joined with the meetings."""
    plan = plan_of(QUERIES["rebuild_derived"](spark, SMALL))
    assert plan.count("RelationV2") + plan.count("Relation [") == 4 and plan.count("Join") == 3


@needs_tables
def test_contests_of_forecasts_are_made_once(spark):
    """Forecasts, results by id, results by pair and the market each made the contests anew; texts were aggregated, so sorted twice."""
    for name in ("market_compare", "score_rows"):
        plan = plan_of(QUERIES[name](spark, SMALL))
        assert "l_orderkey" not in plan and "min(" not in plan


def test_a_summary_is_made_once(spark):
    """Both sides of the join with the baseline graded all forecasts."""
    rows = spark.createDataFrame([(r, i < n) for r, n in (("first", 5), ("second", 2)) for i in range(6)], "run_id string, right boolean")
    graded = rows.select("run_id", F.col("right").alias("winner_correct"), F.col("right").alias("method_correct"), F.col("right").alias("round_correct"),
                         F.col("right").alias("exact_correct"), F.lit("RIGHT").alias("status"), F.when(F.col("right"), 0.1).otherwise(0.9).alias("brier"))
    df = scoring.retention_policy(scoring.score_summary(graded).withColumn("cost", F.lit(1.0)), "second")
    assert "Aggregate" not in plan_of(df)
    assert [tuple(r) for r in df.collect()] == [("first", True, True, True, True, True, True)]


def test_the_least_row_of_a_key_is_one(spark):
    rows = [(1, "b"), (1, "a"), (1, "a"), (2, None), (2, "c"), (None, "x"), (None, "w")]
    got = scoring.least_of(spark.createDataFrame(rows, "k int, v string").withColumn("s", F.struct("v")), "s", "k").collect()
    assert {(r.k, r.v, r.n) for r in got} == {(1, "a", 3), (2, None, 2), (None, "w", 2)} and len(got) == 3


def test_white_space_of_names_is_one_blank(spark):
    names = ["A  B", " a\tb ", "A\u00a0B", "x\n\ny", "", "a b", None, "\x0bq\f\rz"]
    df = spark.createDataFrame([(n,) for n in names], "n string").select(F.regexp_replace("n", r"\s+", " ").alias("old"), scoring.single_spaced(F.col("n")).alias("new"))
    assert all(r.old == r.new for r in df.collect())
