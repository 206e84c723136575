"""Merging, checks, scoring, sources and streams on small tables."""

import datetime as dt
import random
from functools import reduce

import pytest
from pyspark.sql import functions as F

from boutlens.operators import coverage, derived, reconcile, scoring, validate
from boutlens.sources import files, tables
from boutlens.sources.pages import extract_pages
from boutlens.streaming import incremental


def test_null_keeps_physical_fields_only(spark):
    stored = spark.createDataFrame([(1, 70, "x"), (2, 71, "y")], "fight_id int, fighter_a_reach_inches int, method_detail string")
    sent = spark.createDataFrame([(1, None, None), (3, 60, "z")], stored.schema)
    got = sorted(map(tuple, reconcile.upsert_contests(stored, sent).collect()))
    assert got == [(1, 70, None), (2, 71, "y"), (3, 60, "z")]


def test_rounds_go_only_when_the_payload_is_complete(spark):
    schema = "fight_id int, round_number int, fighter_id int, knockdowns int"
    stored = spark.createDataFrame([(1, 1, 7, 0), (1, 2, 7, 0)], schema)
    sent = spark.createDataFrame([(1, 1, 7, 5)], schema)
    none = spark.createDataFrame([], "fight_id int")
    whole = spark.createDataFrame([(1,)], "fight_id int")
    assert sorted(map(tuple, reconcile.upsert_rounds(stored, sent, none).collect())) == [(1, 1, 7, 5), (1, 2, 7, 0)]
    assert sorted(map(tuple, reconcile.upsert_rounds(stored, sent, whole).collect())) == [(1, 1, 7, 5)]


def test_profile_is_due_at_exactly_ninety_days(spark):
    at = lambda d: dt.datetime(2024, 4, 1) - dt.timedelta(days=d)
    df = spark.createDataFrame([(1, None), (2, at(90)), (3, at(89))], "fighter_id int, profile_scraped_at timestamp")
    assert sorted(r.fighter_id for r in reconcile.profile_refresh_due(df, "2024-04-01").collect()) == [1, 2]


def test_schedule_replaces_keeps_or_clears(spark):
    pair = "event_id string, fight_id int, card_order int, fighter_a_id int, fighter_b_id int"
    card = spark.createDataFrame([("n", dt.date(2099, 1, 10), 2)], "event_id string, event_date date, source_fight_count int")
    old = spark.createDataFrame([("o", 1, 1, 8, 9)], pair)
    good = spark.createDataFrame([("n", 2, 1, 1, 2), ("n", 3, 2, 3, 4)], pair)
    twice = spark.createDataFrame([("n", 2, 1, 1, 2), ("n", 3, 2, 1, 4)], pair)
    ids = lambda df: sorted(r.fight_id for r in df.collect())
    assert ids(reconcile.replace_schedule(old, card, good, "2024-01-01")) == [2, 3]
    assert ids(reconcile.replace_schedule(old, card, twice, "2024-01-01")) == [1]
    assert ids(reconcile.replace_schedule(old, card.limit(0), good.limit(0), "2024-01-01")) == []


def test_scores_and_brier(spark):
    f = "run_id string, fighter_a string, fighter_b string, predicted_winner string, win_probability double, predicted_method string, predicted_round int, fight_id int, error string"
    r = "fight_id int, fighter_a_name string, fighter_b_name string, winner_name string, result string, method_of_victory string, ending_round int"
    forecast = spark.createDataFrame([("x", "Alpha", "Beta", "Alpha", 0.7, "Submission", 2, None, None)], f)
    grade = lambda *row: scoring.score_rows(forecast, spark.createDataFrame([row], r)).first()
    right = grade(1, "Beta", "Alpha", "Alpha", "completed", "Submission", 2)
    assert right.status == "RIGHT" and right.exact_correct and right.brier == pytest.approx(0.09)
    wrong = grade(1, "Alpha", "Beta", "Beta", "completed", "Submission", 2)
    assert wrong.status == "WRONG" and wrong.method_correct and not wrong.exact_correct and wrong.brier == pytest.approx(0.49)
    assert grade(1, "Alpha", "Beta", None, "draw", None, None).status == "UNSCORED"
    assert grade(1, "Alpha", "Gamma", "Alpha", "completed", None, None).status == "UNMATCHED"
    assert grade(1, "Alpha", "Beta", None, "completed", None, None).status == "PENDING"
    # a method outside the groups, or none, stays ungraded, and so does the whole
    odd = grade(1, "Alpha", "Beta", "Alpha", "completed", "Could Not Continue", 2)
    assert odd.winner_correct and odd.method_correct is None and odd.exact_correct is None and odd.round_correct
    # a rematch without an id, an id with other sides, and a pair whose id changed need a hand
    twice = spark.createDataFrame([(1, "Alpha", "Beta", "Alpha", "completed", "DQ", 1), (2, "Beta", "Alpha", "Beta", "completed", "DQ", 1), (3, "X", "Y", "X", "completed", "DQ", 1)], r)
    sent = spark.createDataFrame([("x", "Alpha", "Beta", "Alpha", 0.7, "DQ", 1, i, None) for i in (None, 2, 3, 9)], f)
    got = {row.fight_id: row for row in scoring.score_rows(sent, twice).collect()}
    assert len(got) == 4 and (got[2].status, got[2].result_id) == ("WRONG", 2)
    assert {k: got[k].conflict for k in (None, 3, 9)} == {None: "several contests of the pair", 3: "participants changed", 9: "contest id changed"}


def test_runs_of_another_card_are_refused(spark):
    reports = spark.createDataFrame([("a", "u1", "2024-01-05", "2024-01-05"), ("b", "u1", "2024-01-06", "2024-01-05"), ("c", "u9", None, "2024-01-01"), ("d", "u1", None, "2024-01-06")], "run_id string, event_url string, event_date string, cutoff string")
    cards = spark.createDataFrame([("u1", "2024-01-05")], "event_url string, event_date string")
    assert {r.run_id: r.problem for r in scoring.report_problems(reports, cards).collect()} == {"b": "another date", "c": "another card", "d": "cutoff after the card"}


def test_runs_with_withheld_forecasts_are_matched(spark):
    schema = "run_id string, pair string, status string, error string, winner_correct boolean, brier double, predicted_winner string"
    rows = [("m", "p", "RIGHT", None, True, 0.1, "P"), ("r", "p", "FAILED", "review: no", None, None, None), ("m", "q", "WRONG", None, False, 0.5, "Q"), ("r", "q", "FAILED", "quota exceeded", None, None, None), ("m", "s", "RIGHT", None, True, 0.1, "S"), ("r", "s", "RIGHT", None, True, 0.2, "S")]
    scored = spark.createDataFrame(rows, schema)
    assert {r.pair: r.withheld for r in scoring.matched_runs(scored, "m", "r").collect()} == {"p": True, "s": False}
    assert {r.pair: [tuple(x) for x in r.picks] for r in scoring.run_matrix(scored).collect()}["p"] == [("m", "P", "RIGHT"), ("r", "WITHHELD", "FAILED")]


def test_picks_and_market(spark):
    rows = [("f", 1, "Allen", 1.0), ("f", 1, "Allen", 1.0), ("f", 2, "Duncan", 0.2), ("f", 3, None, 1.0), ("f", 4, "Allen", 1.0), ("f", 4, "Duncan", 1.0)]
    got = scoring.weighted_picks(spark.createDataFrame(rows, "fight string, source_id int, pick string, weight double"), "fight").collect()
    assert {r.pick: r.weight for r in got} == {"Allen": 1.0, "Duncan": 0.2}
    assert got[0].total == pytest.approx(1.2) and got[0].excluded == 2
    day = dt.date(2024, 1, 2)
    forecast = spark.createDataFrame([("B", "A", "A", 0.6, day)], "fighter_a string, fighter_b string, predicted_winner string, win_probability double, event_date date")
    market = "fighter_a string, fighter_b string, event_date date, line_a int, line_b int, share_a double, share_b double, observed_at timestamp"
    seen = dt.datetime(2024, 1, 1)
    one = scoring.market_compare(forecast, spark.createDataFrame([("A", "B", day, -150, 130, 80.0, 20.0, seen)], market)).first()
    assert one.market_probability == pytest.approx(0.6 / (0.6 + 100 / 230)) and one.model_minus_public == pytest.approx(-0.2)
    late = spark.createDataFrame([("A", "B", day, -150, 130, 80.0, 20.0, dt.datetime(2024, 1, 3)), ("A", "B", day, -150, 130, 80.0, 30.0, seen)], market)
    assert scoring.market_compare(forecast, late).count() == 0


def test_usage_is_null_unless_complete(spark):
    usage = spark.createDataFrame([(1, 3, True, 0.5), (1, 1, True, 0.1), (2, 1, False, None)], "run int, request_count int, usage_complete boolean, estimated_usd double")
    got = {r.run: r for r in scoring.usage_rollup(usage, "run").collect()}
    assert got[1].estimated_usd == pytest.approx(0.6) and got[1].request_count == 4 and got[2].estimated_usd is None


def _valid(spark):
    from tests.test_contests import GRAPH, NAMES, contests

    fights = contests(spark, GRAPH[:1])
    ids = spark.createDataFrame([(1, NAMES["a"]), (3, NAMES["c"])], "fighter_id long, fighter_name string")
    fighters = ids.withColumns({"date_of_birth": F.lit("1990-01-01").cast("date"), "height_inches": F.lit(70), "reach_inches": F.lit(70), "stance": F.lit("O")})
    events = fights.select("event_id", F.lit("http://x/1").alias("event_url"), F.lit(1).alias("source_fight_count"))
    from boutlens.schema import STATS

    # the splits of a valid contest add up
    fill = {f"fighter_{s}_significant_{p}_strikes_{k}": F.col(f"fighter_{s}_significant_strikes_{k}") for s in "ab" for p in ("head", "ground") for k in ("landed", "attempted")}
    totals = {f"fighter_{s}_total_strikes_{k}": F.col(f"fighter_{s}_significant_strikes_{k}") for s in "ab" for k in ("landed", "attempted")}
    fights = fights.withColumns(fill | totals | {"ending_round": F.lit(1), "source_fight_url": F.concat(F.lit("f"), "fight_id")})
    side = lambda a, b: fights.select("fight_id", F.lit(1).alias("round_number"), F.col(f"fighter_{a}_id").alias("fighter_id"), F.col(f"fighter_{b}_id").alias("opponent_id"), *[F.col(f"fighter_{a}_{c}").alias(c) for c in STATS])
    return events, fights, side("a", "b").unionByName(side("b", "a")), fighters


def _status(tables_):
    return {r.check_id: r.status for r in validate.run_checks(validate.checks(*tables_)).collect()}


def test_recent_contests_without_rounds_fail_and_five_samples_are_kept(spark):
    events, fights, rounds, fighters = _valid(spark)
    many = reduce(lambda x, y: x.unionByName(y), [fights.withColumn("fight_id", F.lit(100 + i).cast(fights.schema["fight_id"].dataType)) for i in range(7)])
    old = many.withColumn("event_date", F.lit("1999-12-31").cast("date"))
    for missing, modern, historical in ((many, "FAIL", "PASS"), (old, "PASS", "WARN")):
        found = validate.checks(events, missing, rounds, fighters)
        found = {k: found[k] for k in ("rounds.modern_coverage", "rounds.historical_source_gaps")}
        got = {r.check_id: r for r in validate.run_checks(found).collect()}
        assert (got["rounds.modern_coverage"].status, got["rounds.historical_source_gaps"].status) == (modern, historical)
        held = got["rounds.modern_coverage" if modern == "FAIL" else "rounds.historical_source_gaps"]
        assert held["count"] == fights.count() * 7 and held.samples == [str(100 + i) for i in range(5)]


def test_valid_tables_pass_and_mutations_fail(spark):
    events, fights, rounds, fighters = (t.cache() for t in _valid(spark))
    assert {v for k, v in _status((events, fights, rounds, fighters)).items() if not k.startswith("metadata.")} == {"PASS"}
    bad = fights.withColumns({"result": F.lit("completed"), "winner_fighter_id": F.lit(99), "card_order": F.lit(2), "ending_time": F.lit("1:99")})
    found = _status((events.withColumn("source_fight_count", F.lit(3)), bad, rounds.filter("fighter_id = 1").withColumn("takedowns_landed", F.lit(9)), fighters))
    for check in ("semantics.winner", "keys.fights.winner", "coverage.card_order", "fights.ending_values", "coverage.event_fight_counts",
                  "rounds.two_sided", "rounds.stat_domains", "totals.fight_vs_rounds", "fighter_bout_history.outcomes"):
        assert found[check] == "FAIL", check


def test_schemas_features_and_required_metadata(spark):
    from boutlens.operators.perspectives import perspectives
    from boutlens.schema import TABLES

    events, fights, rounds, fighters = _valid(spark)
    tables_ = {"events": events, "fights": fights, "fight_rounds": rounds, "fighters": fighters}
    got = {r.check_id: r for r in validate.run_checks(validate.schema_checks(tables_, TABLES, perspectives(fights).drop("bout_outcome"))).collect()}
    assert got["schema.tables"].samples == ["upcoming_events", "upcoming_fights"] and "events.event_name" in [c for c in got["schema.columns"].samples] and got["schema.fighter_bout_history_columns"].samples == ["bout_outcome"]
    columns = lambda *names: spark.createDataFrame([(n,) for n in names], "column_name string")
    status = lambda df: validate.run_checks(validate.feature_check(df)).first()
    assert status(columns("prefight_wins")).status == "PASS" and status(columns("prefight_wins", "bout_reversals", "result")).samples == ["bout_reversals", "result"] and status(columns()).status == "WARN"
    found = {r.check_id: r.status for r in validate.run_checks(validate.metadata_checks(tables_ | {"fights": fights.drop("weight_class")}, ("weight_class", "fights.method_of_victory", "events.last_scraped_at"))).collect()}
    assert (found["metadata.weight_class"], found["metadata.fight_method"], found["metadata.fight_method.required"], found["metadata.event_scrape_audit.required"]) == ("FAIL", "PASS", "PASS", "FAIL")


def test_history_that_is_stored_is_held_against_the_contests(spark):
    from boutlens.operators.perspectives import perspectives

    events, fights, rounds, fighters = _valid(spark)
    whole = perspectives(fights.drop("name"))
    for history, broken in ((whole.filter("slot = 'a'"), {"cardinality", "participants"}), (whole.withColumn("opponent_id", F.col("fighter_id")), {"participants", "outcomes"}),
                            (whole.withColumn("bout_outcome", F.lit("draw")), {"outcomes"}), (whole.unionByName(whole.withColumn("fight_id", F.col("fight_id") + 9)), {"cardinality"})):
        found = {k: v for k, v in validate.checks(events, fights, rounds, fighters, history=history).items() if k.startswith("fighter_bout_history")}
        assert {r.check_id.split(".")[1] for r in validate.run_checks(found).collect() if r.status == "FAIL"} >= broken


def test_snapshot_moves_only_when_checks_pass(spark, tmp_path):
    root, df = str(tmp_path), spark.range(3)
    ok = spark.createDataFrame([("c", "PASS")], "check_id string, status string")
    bad = spark.createDataFrame([("c", "FAIL")], "check_id string, status string")
    assert tables.live_run(spark, root) is None
    assert tables.promote_snapshot(spark, {"t": df}, root, "r1", ok) and tables.live_run(spark, root) == "r1"
    assert not tables.promote_snapshot(spark, {"t": df.limit(1)}, root, "r2", bad)
    assert tables.live_run(spark, root) == "r1" and tables.live_tables(spark, root, ("t",))["t"].count() == 3


def test_snapshots_share_parts_and_one_of_two_promotions_wins(spark, tmp_path):
    root, ok = str(tmp_path), spark.createDataFrame([("c", "PASS")], "check_id string, status string")
    df = spark.createDataFrame([(i, i % 4, {"k": i}) for i in range(40)], "id long, g long, m map<string, long>")
    parts = {"t": F.col("g")}
    assert tables.promote_snapshot(spark, {"t": df, "none": df.limit(0)}, root, "r1", ok, parts)
    new = df.withColumn("id", F.when((F.col("g") == 2) & (F.col("id") == 6), 600).otherwise(F.col("id"))).repartition(3)
    assert tables.promote_snapshot(spark, {"t": new, "none": df.limit(0)}, root, "r2", ok, parts)
    written = spark.read.parquet(f"{root}/data/t/run_id=r2")
    assert written.count() == 10 and {r["__part"] for r in written.select("__part").distinct().collect()} == {"p2"}
    live = tables.live_tables(spark, root, ("t", "none"))
    assert sorted(map(str, live["t"].collect())) == sorted(map(str, new.collect())) and live["none"].schema == df.schema and live["none"].count() == 0
    # both of these started from the second promotion
    start = tables.live_number(spark, root)
    assert tables.promote_snapshot(spark, {"t": df}, root, "r3", ok, parts, expected=start) and not tables.promote_snapshot(spark, {"t": new}, root, "r4", ok, parts, expected=start)
    assert tables.live_run(spark, root) == "r3" and sorted(map(str, tables.live_tables(spark, root, ("t",))["t"].collect())) == sorted(map(str, df.collect()))
    with pytest.raises(ValueError):
        tables.promote_snapshot(spark, {"t": df}, root, "r1", ok, parts)
    (tmp_path / "pointer" / "000000009.json").write_text("{not json")
    with pytest.raises(Exception):
        tables.live_run(spark, root)


def test_metrics_and_versions_are_written_beside_what_is_read(spark, tmp_path):
    path = str(tmp_path / "metrics")
    schema = "report_sha256 string, event_date string, path string, brier double"
    files.write_metrics_csv(spark.createDataFrame([], schema), spark.createDataFrame([("a", "2024-01-02", "x", 0.5), ("b", "2024-01-01", "y", 0.25)], schema), path)
    read = lambda: spark.read.option("header", True).schema(schema).csv(path)
    files.write_metrics_csv(read(), spark.createDataFrame([("a", "2024-01-02", "x", 0.75), ("c", "2024-01-03", "z", 1.0)], schema), path)
    assert [tuple(r) for r in read().orderBy("event_date").collect()] == [("b", "2024-01-01", "y", 0.25), ("a", "2024-01-02", "x", 0.75), ("c", "2024-01-03", "z", 1.0)]
    versions = str(tmp_path / "versions")
    first, second = spark.range(300).withColumn("v", F.lit("x")), spark.range(200, 400).withColumn("v", F.lit("x"))
    files.write_versioned_json(first, versions)
    files.write_versioned_json(second, versions)
    stored = files.read_versioned_json(spark, versions)
    assert stored.count() == stored.select("digest").distinct().count() == 400 and stored.filter(F.sha2("value", 256) != F.col("digest")).count() == 0
    assert len(list((tmp_path / "versions").glob("prefix=*"))) <= 256


def test_evidence_paths_and_claims(spark):
    from boutlens.operators import coverage

    schema = "pair string, side string, career struct<fights: int, by: map<string, struct<n: int>>>, bouts array<struct<fight_id: string, who: struct<id: string>, tags: array<string>>>, none struct<x: int>, rows array<struct<y: int>>"
    df = spark.createDataFrame([("p", "a", (3, {"striker": (2,)}), [("f1", ("o1",), ["t"]), ("f2", None, None)], None, [(5,), (6,)])], schema)
    long = files.long_evidence(df, ["pair", "side"])
    got = {r.path: r.value for r in long.collect()}
    assert got == {"career.fights": "3", "career.by.striker.n": "2", "bouts.f1.fight_id": "f1", "bouts.f1.who.id": "o1", "bouts.f1.tags": '["t"]', "bouts.f2.fight_id": "f2", "bouts.f2.tags": None, "rows.0.y": "5", "rows.1.y": "6"}
    assert {(r.section, r.field) for r in long.collect()} >= {("career", "n"), ("bouts", "id"), ("rows", "y")}
    claims = [(1, "bouts.f1.who.id", "o1"), (2, "bouts.f1.who.id", "o2"), (3, "bouts.f9.who.id", "o1"), (4, "career.fights", " 3.0"), (5, "bouts.f2.tags", None), (6, "bouts.f2.tags", "t"), (7, "bouts", "f1")]
    claims = spark.createDataFrame([("p", "a", *c) for c in claims], "pair string, side string, claim_id int, path string, value string")
    status = {r.claim_id: r.status for r in coverage.claim_check(claims, long, ["pair", "side"]).collect()}
    assert status == {1: "supported", 2: "contradicted", 3: "unknown path", 4: "supported", 5: "supported", 6: "contradicted", 7: "unknown path"}


def test_leaks_are_told_by_column_and_table(spark):
    from boutlens.operators.perspectives import AFTER, FINAL, SAFE_FEATURES, leak_audit
    from boutlens.schema import STATS

    leaking = ["fights.winner_name", "fights.fighter_a_knockdowns", "fighter_bout_history.bout_outcome", "referee", "time_format", "event_method_code", " Fights.Result ", "opponent_bout_reversals", "db.fight_rounds.round_number", "archive.fighters.wins", "bout_x."]
    leaking += [*AFTER, *[f"x.{c}" for c in AFTER], *[f"fighters.{c}" for c in FINAL], *[f"fights.fighter_{s}_{c}" for s in "ab" for c in STATS], *[f"fight_rounds.{c}" for c in STATS]]
    safe = ["fighters.knockdowns", "fighters.age", "fights.fighter_a_wins", "fights.weight_class", "events.event_date", "wins", "fights.head_to_head_fight_count", "fighter_a_wins", "prefight_wins", "fighters.result_count", "", *SAFE_FEATURES]
    df = spark.createDataFrame([(c,) for c in [*leaking, *safe, None]], "column_name string")
    got = {r.column_name: r.leaks for r in leak_audit(df).collect()}
    assert all(got[c] for c in leaking) and not any(got[c] for c in safe) and got[None] is False


def test_ledger_counts_only_complete_runs(spark, tmp_path):
    whole = '{"kind":"run","run_id":"r","cutoff":"2024-01-01"}\n{"kind":"prediction","fighter_a":"A","fighter_b":"B","predicted_winner":"A"}\n{"kind":"complete"}\n'
    (tmp_path / "a.jsonl").write_text(whole)
    (tmp_path / "b.jsonl").write_text(whole.rsplit("{", 1)[0].replace('"r"', '"s"'))
    # lines in another order, or a second run line, are no complete run
    one, two, three, _ = whole.split("\n")
    (tmp_path / "c.jsonl").write_text("\n".join([two, one, three]))
    (tmp_path / "d.jsonl").write_text("\n".join([one, three, two]))
    (tmp_path / "e.jsonl").write_text("\n".join([one, one, two, three]))
    assert [r.run_id for r in files.read_ledger(spark, str(tmp_path)).collect()] == ["r"]


def test_text_report(spark):
    text = ("Card | 2024-05-01\r\nEvidence cutoff: strictly before 2024-05-01\r\nSource: http://x/1\r\n\r\nAlpha vs Beta | 3 rounds\r\nPick: Alpha\r\nConfidence: 62%\r\n"
            "Predicted ending: Submission, round 2\r\nScheduled distance assumes 3 rounds\r\nAlpha vs Nobody, said someone\r\nGamma vs Delta\r\nPrediction failed: Timeout: x\r\n"
            "E vs F\r\nPick: E\r\nE vs G\r\nPick: H\r\nConfidence: 70%\r\nPredicted ending: KO/TKO, round 1\r\n\r\n=== POST-CARD RESULTS (managed) ===\r\nX vs Y\r\nPick: X\r\n")  # fmt: skip
    a, b, c, d = files.parse_reports(spark.createDataFrame([(1, text)], "id int, value string")).orderBy("position").collect()
    assert (a.fighter_a, a.fighter_b, a.predicted_winner, a.win_probability, a.predicted_method, a.predicted_round, a.scheduled_rounds) == ("Alpha", "Beta", "Alpha", 0.62, "Submission", 2, 3)
    assert (a.cutoff, a.event_date, a.source, a.problem) == ("2024-05-01", "2024-05-01", "http://x/1", None)
    assert (b.fighter_a, b.error, b.problem) == ("Gamma", "Timeout: x", None)
    assert (c.problem, d.problem) == ("incomplete forecast", "pick is no participant")
    bare = files.parse_reports(spark.createDataFrame([(1, "A vs B\nPick: A\nConfidence: 40%\nPredicted ending: DQ, round 1\n")], "id int, value string")).first()
    assert bare.problem == "no cutoff"


def test_reports_must_agree_with_their_ledger(spark):
    schema = "run_id string, position int, fighter_a string, fighter_b string, predicted_winner string, predicted_method string, predicted_round int, win_probability double, error string"
    seen = spark.createDataFrame([("r", 0, "A", "B", "A", "DQ", 1, 0.62, None), ("r", 1, "C", "D", "C", "DQ", 1, 0.6, None), ("r", 2, "E", "F", None, None, None, None, "x")], schema)
    saved = spark.createDataFrame([("r", 0, "A", "B", "A", "DQ", 1, 0.6203, None), ("r", 1, "C", "D", "D", "DQ", 1, 0.6, None), ("r", 2, "E", "F", None, None, None, None, "x"), ("r", 3, "G", "H", None, None, None, None, "x")], schema)
    assert sorted((r.position, r.problem) for r in files.ledger_disagreements(seen, saved).collect()) == [(1, "predicted_winner"), (3, "count")]


def test_market_file_refuses_unknown_keys(spark, tmp_path):
    (tmp_path / "m.json").write_text('{"fighter_a":"A","fighter_b":"B","line_a":-150,"line_b":130,"share_a":60,"share_b":40}')
    assert files.read_market(spark, str(tmp_path)).count() == 1
    (tmp_path / "n.json").write_text('{"fighter_a":"A","odd":1}')
    with pytest.raises(Exception, match="unknown key"):
        files.read_market(spark, str(tmp_path)).collect()
    (tmp_path / "n.json").write_text('{"fighter_a":"A","fighter_b":"B","line_a":-50,"line_b":130,"share_a":60,"share_b":40}')
    with pytest.raises(Exception, match="out of range"):
        files.read_market(spark, str(tmp_path)).collect()
    with pytest.raises(ValueError, match="weights"):
        files.source_registry(spark.createDataFrame([("a", "x", 11.0, True)], "source_id string, kind string, weight double, active boolean"))


def test_pages_text_and_chapters(spark):
    page = "<table><tr><th>Name</th><th>W</th></tr><tr><td><a href='/x'>A &amp; B</a></td><td>3</td></tr></table><ul><li>Reach: 70</li></ul>"
    rows = extract_pages(spark.createDataFrame([(1, page), (2, None)], "page_id int, html string")).collect()
    assert [(r.kind, r.header, r.cell, r.href) for r in rows] == [("cell", "Name", "A & B", "/x"), ("cell", "W", "3", None), ("item", None, "Reach: 70", None)]
    df = spark.createDataFrame([(1, "0:00 Intro\n1:02:03 - Main\n1:75 no\nother"), (2, "0:00 Only"), (3, "0:10 A\n0:05 B")], "id int, description string")
    assert [tuple(r) for r in coverage.chapters(df, ["id"]).orderBy("number").collect()] == [(1, 1, 0, 3723, "Intro"), (1, 2, 3723, None, "Main")]


PROVIDER = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture
def rocksdb(spark):
    spark.conf.set(PROVIDER, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.unset(PROVIDER)


def streamed_records(spark, folder, batches, delay=None):
    schema = "fighter_id long, fight_id long, event_date date, bout_outcome string"
    (folder / "in").mkdir()
    source = spark.readStream.schema(schema).parquet(f"{folder}/in")

    def keep(df, batch):
        df.withColumn("batch", F.lit(batch)).write.mode("append").parquet(f"{folder}/out")

    for batch in batches:
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        query = incremental.running_record(source, delay).writeStream.outputMode("update").foreachBatch(keep)
        query.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start().awaitTermination(120)
    return spark.read.parquet(f"{folder}/out")


def test_records_of_a_shuffled_stream_are_those_of_a_batch(spark, tmp_path, rocksdb):
    rng = random.Random(3)
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    rows = [(p, 100 * p + k, day(rng.randrange(9)), rng.choice(["win", "loss", "draw", "other", None])) for p in range(4) for k in range(9)]
    wrong = [(*rows[5][:3], "win"), (*rows[20][:3], "loss")]  # corrected later
    order = rng.sample([r for k, r in enumerate(rows) if k not in (5, 20)], len(rows) - 2)
    batches = [order[:12] + wrong, order[12:20], [*order[20:], rows[5], rows[20]]]
    out = streamed_records(spark, tmp_path, batches)
    df = spark.createDataFrame(rows, "fighter_id long, fight_id long, event_date date, bout_outcome string")
    want = derived.prefight_record(df, ("event_date", "fight_id")).select("fighter_id", "fight_id", "event_date", "prior_wins", "prior_losses", "prior_draws")
    assert sorted(map(tuple, incremental.latest_records(out).collect())) == sorted(map(tuple, want.collect()))


def test_settled_contests_leave_the_state(spark, tmp_path, rocksdb):
    day = lambda k: dt.date(2024, 1, 1) + dt.timedelta(days=k)
    batches = [[(1, 10, day(0), "win"), (1, 11, day(5), "loss")], [(2, 20, day(100), "win")], [(1, 12, day(3), "win"), (1, 13, day(101), "win")]]
    got = incremental.latest_records(streamed_records(spark, tmp_path, batches, "30 days")).collect()
    # contest 12 comes after its time; what was counted before stays counted
    assert {(r.fight_id, r.wins, r.losses) for r in got} == {(10, 0, 0), (11, 1, 0), (20, 0, 0), (13, 1, 1)}


def test_incremental_refresh_takes_late_corrections(spark, tmp_path):
    schema, seen = spark.range(1).withColumn("v", F.lit("a")).schema, []
    merge = lambda df, _: seen.extend(map(tuple, df.collect()))
    for value in ("a", "b"):
        spark.createDataFrame([(1, value)], schema).write.mode("append").parquet(str(tmp_path / "in"))
        incremental.incremental_refresh(spark, str(tmp_path / "in"), schema, merge, str(tmp_path / "cp")).awaitTermination(120)
    assert seen == [(1, "a"), (1, "b")]
