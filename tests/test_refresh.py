"""A refresh from end to end on a handful of contests."""

import json

import pytest
from pyspark.sql import functions as F

from boutlens.checkpoints import checkpointed
from boutlens.operators import derived, manifest, reconcile, refresh
from boutlens.schema import STATS
from boutlens.sources import tables
from tests.test_contests import GRAPH, contests

RUN = {"run_id": "r1", "code_version": "c", "started_at": "2024-01-01 00:00:00", "finished_at": "2024-01-01 01:00:00", "url": "http://list", "fetched_at": "2024-01-01 00:30:00"}


def store(spark, rows):
    """Canonical tables of some contests, sound in themselves."""
    made = contests(spark, rows)
    name = F.when(F.col("winner_fighter_id") == F.col("fighter_a_id"), F.col("fighter_a_name")).when(F.col("winner_fighter_id") == F.col("fighter_b_id"), F.col("fighter_b_name"))
    fill = {f"fighter_{s}_significant_{p}_strikes_{k}": F.col(f"fighter_{s}_significant_strikes_{k}") for s in "ab" for p in ("head", "ground") for k in ("landed", "attempted")}
    fill |= {f"fighter_{s}_total_strikes_{k}": F.col(f"fighter_{s}_significant_strikes_{k}") for s in "ab" for k in ("landed", "attempted")}
    fights = made.withColumns(fill | {"winner_name": name, "ending_round": F.lit(1), "source_fight_url": F.concat(F.lit("f"), "name"), "ingest_seq": F.col("fight_id"), "created_at": F.lit(None).cast("timestamp"), "source_event_url": F.lit(None).cast("string")})
    fights = fights.withColumn("fight_id", F.col("name")).drop("name")
    events = fights.select("event_id", F.col("event_id").alias("event_name"), "event_date", F.concat(F.lit("e"), "event_id").alias("event_url"), F.lit(1).alias("source_fight_count"))
    side = lambda a, b: fights.select("fight_id", F.lit(1).alias("round_number"), F.col(f"fighter_{a}_id").alias("fighter_id"), F.col(f"fighter_{b}_id").alias("opponent_id"), *[F.col(f"fighter_{a}_{c}").alias(c) for c in STATS])
    people = fights.select(F.explode(F.array(*[F.struct(F.col(f"fighter_{s}_id").alias("fighter_id"), F.col(f"fighter_{s}_name").alias("fighter_name")) for s in "ab"])).alias("f")).select("f.*").distinct()
    people = people.withColumns({"date_of_birth": F.lit("1990-05-01").cast("date"), "height_inches": F.lit(70), "reach_inches": F.lit(71), "stance": F.lit("O"), "profile_scraped_at": F.lit(None).cast("timestamp")})
    return {"events": events, "fights": fights, "fight_rounds": side("a", "b").unionByName(side("b", "a")), "fighters": people}


def test_rebuilt_tables_stay_as_they_are(spark):
    s = store(spark, GRAPH)
    made, people, report, errors = derived.rebuild_tables(s["events"], s["fights"], s["fight_rounds"], s["fighters"])
    assert errors.count() == 0
    n = {r.counter: r.n for r in report.collect()}
    assert (n["fights_processed"], n["fighters_rebuilt"], n["source_event_urls_changed"], n["winner_ids_changed"], n["profile_fields_hydrated"]) == (9, 5, 9, 0, 72)
    got = {r.fight_id: r for r in made.collect()}
    older = [x for x in GRAPH if "a" in x[2:4]][0][0]
    assert got[older].fighter_a_wins == 0 and got[older].fighter_a_days_since_last_fight is None and got[older].fighter_a_age == 27
    ada = people.filter("fighter_id = 1").first()
    assert (ada.fights, ada.wins, ada.losses, ada.no_contests) == (6, 3, 1, 1)
    again, _, second, _ = derived.rebuild_tables(s["events"], made, s["fight_rounds"], people)
    n = {r.counter: r.n for r in second.collect()}
    assert not any(n[c] for c in ("winner_ids_changed", "source_event_urls_changed", "stats_availability_changed", "card_orders_backfilled", "profile_fields_hydrated"))
    same = sorted(c for c in made.columns if c in again.columns)
    assert sorted(map(str, made.select(same).collect())) == sorted(map(str, again.select(same).collect()))


def test_refresh_promotes_and_refuses(spark, tmp_path):
    base, sent = store(spark, GRAPH[:3]), store(spark, GRAPH[2:5])
    listing = base["events"].unionByName(sent["events"]).select("event_url", "event_date").distinct().withColumn("deferred", F.lit(False))
    pages = spark.createDataFrame([("listing", True), ("event", True), ("fight", True)], "kind string, succeeded boolean")
    first = {k: v for k, v in base.items()}
    root = str(tmp_path)
    ok, report = refresh.refresh(first, sent, listing, pages, RUN, root, rounds_since="1990-01-01")
    bad = [(r.check_id, r["count"], r.samples) for r in report.filter("status = 'FAIL'").collect()]
    assert ok and not bad, bad
    assert tables.live_run(spark, root) == "r1"
    live = tables.live_tables(spark, root, ("fights", "runs", "run_cards"))
    assert live["fights"].count() == 5 and live["runs"].first().status == "completed"
    assert {r.event_url for r in live["run_cards"].filter("noted AND listed = 1").collect()} == {f"e{x[0]}" for x in GRAPH[:5]} and live["runs"].first().cards == 5
    # a contest with other sides rejects its card: the manifest has the error, nothing is promoted
    wrong = dict(sent) | {"fights": sent["fights"].withColumn("fighter_a_id", F.when(F.col("fight_id") == GRAPH[2][0], 99).otherwise(F.col("fighter_a_id")))}
    ok, report = refresh.refresh(first, wrong, listing, pages, RUN | {"run_id": "r2"}, root, rounds_since="1990-01-01")
    assert not ok and tables.live_run(spark, root) == "r1"
    assert "audit.unresolved_errors" in {r.check_id for r in report.filter("status = 'FAIL'").collect()}
    audit = [json.loads(line) for path in (tmp_path / "audit").glob("*.json") for line in path.read_text().splitlines()]
    assert {x["run_id"] for x in audit} == {"r1", "r2"}


def test_rebuilding_what_a_card_touches_equals_a_full_rebuild(spark):
    base, sent = store(spark, GRAPH[:-1]), store(spark, GRAPH[-1:])
    events, fights, rounds, fighters = (base[t] for t in ("events", "fights", "fight_rounds", "fighters"))
    made, people, _, _ = derived.rebuild_tables(events, fights, rounds, fighters)
    merged = checkpointed(reconcile.upsert_contests(made, sent["fights"]))
    cards, all_rounds = checkpointed(events.unionByName(sent["events"])), checkpointed(rounds.unionByName(sent["fight_rounds"]))
    everyone = checkpointed(people.unionByName(sent["fighters"].join(people, "fighter_id", "left_anti"), allowMissingColumns=True))
    full, totals, _, _ = derived.rebuild_tables(cards, merged, all_rounds, everyone)
    part, touched, report, errors, ids = derived.rebuild_touched(cards, merged, all_rounds, everyone, sent["events"])
    rows = lambda df, like: sorted(map(str, df.select(sorted(like.columns)).collect()))
    assert set(full.columns) <= set(part.columns) and rows(part, full) == rows(full, full) and rows(touched, totals) == rows(totals, totals)
    assert errors.count() == 0 and ids.count() == {r.counter: r.n for r in report.collect()}["fights_processed"] < full.count()


def test_incremental_refresh_writes_its_share(spark, tmp_path):
    base, sent = store(spark, GRAPH[:-1]), store(spark, GRAPH[-1:])
    made, people, _, _ = derived.rebuild_tables(base["events"], base["fights"], base["fight_rounds"], base["fighters"])
    root, names = str(tmp_path), tuple(base)
    sound = spark.createDataFrame([("c", "PASS")], "check_id string, status string")
    parts = {t: refresh.bucket(k) for t, k in refresh.PARTS.items()}
    assert tables.promote_snapshot(spark, base | {"fights": made, "fighters": people}, root, "r0", sound, parts)
    live = {k: checkpointed(v) for k, v in tables.live_tables(spark, root, names).items()}
    listing = base["events"].unionByName(sent["events"]).select("event_url", "event_date").distinct().withColumn("deferred", F.lit(False))
    pages = spark.createDataFrame([("listing", True)], "kind string, succeeded boolean")
    ok, report = refresh.refresh(live, sent, listing, pages, RUN, root, incremental=True, rounds_since="1990-01-01")
    assert ok and tables.live_run(spark, root) == "r1", report.filter("status = 'FAIL'").collect()
    now = {k: checkpointed(v) for k, v in tables.live_tables(spark, root, names).items()}
    again, _, _, _ = derived.rebuild_tables(now["events"], now["fights"], now["fight_rounds"], now["fighters"])
    rows = lambda df: sorted(map(str, df.select(sorted(again.columns)).collect()))
    assert now["fights"].count() == len(GRAPH) and rows(now["fights"]) == rows(again)
    held = spark.read.parquet(f"{root}/manifests/run_id=r1").filter("part != ''")
    assert held.filter("table_name = 'fight_rounds' AND run_id = 'r0'").count() > 0 and held.filter("table_name = 'events' AND run_id = 'r1'").count() == 1
    with pytest.raises(ValueError):
        refresh.refresh(base | {"fights": base["fights"].drop("fighter_a_wins")}, sent, listing, pages, RUN | {"run_id": "r2"}, root, incremental=True)


def test_stale_contests_go_only_if_allowed(spark):
    s = store(spark, GRAPH[:2])
    source = s["fights"].select("event_id", F.when(F.col("fight_id") == GRAPH[0][0], "other").otherwise(F.col("fight_id")).alias("fight_id"))
    kept, rounds, refused = reconcile.without_stale(s["fights"], s["fight_rounds"], source, False)
    assert kept.count() == 2 and rounds.count() == 4 and [r.fight_id for r in refused.collect()] == [GRAPH[0][0]]
    kept, rounds, refused = reconcile.without_stale(s["fights"], s["fight_rounds"], source, True)
    assert kept.count() == 1 and rounds.count() == 2 and refused.count() == 0


def test_profiles_have_one_identity(spark):
    rows = [("a", "http://x/f/a", "http://x/f/a/", "a"), ("b", "http://x/f/b", "http://x/f/c", "b"), ("c", "http://x/f/b?y", "http://x/f/c", "c"), ("d", "http://x/f/d", "http://x/f/d", None)]
    df = spark.createDataFrame(rows, "fighter_id string, requested_url string, profile_url string, payload_id string")
    assert {r.fighter_id: r.reason for r in reconcile.profile_identity(df).collect()} == {"b": "page url", "c": "requested url", "d": "payload"}


def test_missing_checkpoint_folder_is_an_error_on_a_cluster():
    from boutlens import checkpoints

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {"spark.checkpoint.dir": None}

    class Frame:
        sparkSession = Session()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoints.checkpointed(Frame())


def test_manifest_rows_fold_to_one_digest(spark):
    doc = "run_id string, status string, code_version string, started_at string, finished_at string, errors array<struct<message: string, resolved: boolean>>, listing struct<url: string, fetched_at: string, event_urls: array<string>, latest_event_date: string>, event_fights map<string, array<string>>, page_counts map<string, int>, feature_columns array<string>"
    row = lambda run, cards, listed, errors=(): (run, "completed", "x", "a", "b", list(errors), ("http://x", "a", listed, None), cards, {}, [])
    many = {f"e{k}": [f"f{k}", f"g{k}"] for k in range(300)}
    other = dict(reversed(list(many.items()))) | {"e7": ["g7", "f7"], "new": None}
    del other["e9"]
    rows = [row("r1", many, ["e0", "e0", "gone"], [("m", True)]), row("r2", dict(reversed(list(many.items()))), None), row("r3", other, []), row("r4", None, None)]
    parts = manifest.from_document(spark.createDataFrame(rows, doc))
    runs = {r.run_id: r for r in parts["runs"].collect()}
    assert runs["r1"].digest == runs["r2"].digest != runs["r3"].digest and runs["r1"].cards == 300 and runs["r1"].errors == 1
    assert (runs["r1"].listed, runs["r2"].listed, runs["r4"].listed, runs["r4"].digest) == (3, 0, 0, None)
    cards = {(r.run_id, r.event_url): (r.listed, r.noted) for r in parts["run_cards"].collect()}
    assert cards["r1", "e0"] == (2, True) and cards["r1", "gone"] == (1, False) and cards["r3", "new"] == (0, True)
    of = lambda run: parts["run_cards"].filter((F.col("run_id") == run) & F.col("noted"))
    assert {tuple(r) for r in manifest.changed_cards(of("r1"), of("r3")).collect()} == {("e7", "differs"), ("e9", "went"), ("new", "came")}
    assert manifest.changed_cards(of("r1"), of("r2")).count() == 0
    assert [tuple(r) for r in parts["run_errors"].collect()] == [("r1", "m", True)]
