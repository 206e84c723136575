"""What a query leaves on disk while it runs: no shuffle files of ended actions, no passes that nothing reads any more."""

import glob
import os
import random
import time

import pytest
from pyspark.sql import functions as F

from boutlens import checkpoints
from boutlens.operators import asof, derived, paths, perspectives, ratings, validate
from boutlens.plans import QUERIES, check_queries
from boutlens.plans.catalog import Tables
from tests.test_contests import contests

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")


def shuffle_files(spark):
    return set(glob.glob(f"{spark.conf.get('spark.local.dir')}/**/shuffle_*", recursive=True))


@pytest.mark.parametrize("keep", ["checkpointed", "written"])
def test_kept_rows_leave_no_shuffle_files(spark, keep):
    """Shuffle files stayed until the driver collected garbage, so those of all steps of a query stood side by side."""
    setting = spark.conf.get(checkpoints.CLEANUP, None)
    before = shuffle_files(spark)
    df = spark.range(1000).withColumn("k", F.col("id") % 7).groupBy("k").agg(F.sum("id").alias("n"))
    kept = getattr(checkpoints, keep)(df)
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(checkpoints.CLEANUP, None) == setting
    assert sorted(kept.collect()) == sorted(df.collect())


def kept_folders(spark):
    return set(os.listdir(spark.sparkContext.getCheckpointDir().removeprefix("file:")))


def test_passes_of_ratings_go_when_the_next_one_stands(spark):
    """Each pass stayed on disk to the end."""
    rows = [(f"m{i}", f"2020-01-{1 + i:02d}", a, b, "completed", "KO/TKO") for i, (a, b) in enumerate(["ab", "bc", "cd", "de", "ea", "ac", "bd", "ce", "da", "eb"])]
    persp = perspectives.perspectives(contests(spark, rows))
    checkpoints.checkpoint_folder(persp)
    before, passes = kept_folders(spark), []
    history = ratings.elo_history(persp, passes=passes)
    assert len(passes) > 4 and len(kept_folders(spark) - before) <= 2
    assert history.count() == 20


def test_what_is_made_alone_leaves_nothing_else(spark):
    before = kept_folders(spark)
    outside = checkpoints.written(spark.range(3))

    def make():
        checkpoints.dropped(checkpoints.written(spark.range(4)))
        inner = checkpoints.alone(lambda: checkpoints.written(spark.range(5)).filter("id > 1"))
        return inner.join(outside, "id", "left_anti")

    df = checkpoints.alone(make)
    assert sorted(r.id for r in df.collect()) == [3, 4] and outside.count() == 3
    assert len(kept_folders(spark) - before) == 2


@needs_tables
def test_states_and_questions_are_written_once(spark, monkeypatch):
    """States were written twice, and what opponents were before their days once more, though it is read once."""
    written, real = [], checkpoints.written
    for module in (checkpoints, asof, ratings):
        monkeypatch.setattr(module, "written", lambda df: written.append(df.columns) or real(df), raising=False)
    before = kept_folders(spark)
    df = QUERIES["style_profile"](spark, SMALL)
    assert sum("until" in c for c in written) == 0 and sum("cohort_sizes" in c for c in written) == 0
    assert len(kept_folders(spark) - before) <= 5 and df.count() > 0


def joins(plan):
    """The outputs of all joins of a plan."""
    kids = plan.children()
    own = [plan.output().mkString(" ")] if plan.nodeName() == "Join" else []
    return own + [x for i in range(kids.size()) for x in joins(kids.apply(i))]


@needs_tables
def test_pairs_carry_no_histories(spark):
    """Rows of pairs went through two shuffles with all contests of an entity."""
    plan = QUERIES["matchup_evidence"](spark, SMALL)._jdf.queryExecution().optimizedPlan()
    assert sum("bouts#" in x and "a_id#" in x for x in joins(plan)) == 1


def plain_chains(edges, start, target, depth):
    """All simple chains, by walking."""
    found, stack = [], [(start, (start,), ())]
    while stack:
        at, seen, fights = stack.pop()
        for w, x, f in edges:
            if w == at and x not in seen and len(fights) < depth:
                if x == target:
                    found.append((*seen, x))
                else:
                    stack.append((x, (*seen, x), (*fights, f)))
    return sorted(found)


@pytest.mark.parametrize("depth", [1, 2, 3, 4, 5])
def test_chains_are_made_and_kept_in_parts(spark, depth):
    """All chains of both halves went through one job, most of which met nothing; now each length has its own, and its sums are kept."""
    draw = random.Random(depth)
    won = [(*draw.sample(range(9), 2), f) for f in range(30)] + [(0, 1, 100), (0, 1, 101)]
    edges = spark.createDataFrame([(*e, 0.5) for e in won], "winner long, loser long, fight_id long, weight double").localCheckpoint()
    asked = [(s, t) for s in range(9) for t in range(9) if s != t]
    pairs = spark.createDataFrame(asked, "start long, target long").localCheckpoint()
    whole = sorted((r.start, r.target, tuple(r.entities)) for r in paths.paths(pairs, edges, depth).collect())
    assert whole == sorted((s, t, c) for s, t in asked for c in plain_chains(won, s, t, depth))
    parts = []
    kept = paths.paths(pairs, edges, depth, lambda df: parts.append(1) or df.groupBy("start", "target").agg(F.count("*").alias("n")))
    assert len(parts) == depth // 2 + 1 and kept.agg(F.sum("n")).first()[0] == len(whole)


def test_checks_run_in_several_jobs(spark, monkeypatch):
    """All checks were one job, so the shuffle files of all stood side by side."""
    jobs, real = [], validate.checkpointed
    monkeypatch.setattr(validate, "checkpointed", lambda df: jobs.append(1) or real(df))
    rows = spark.range(20).select(F.col("id").cast("string").alias("sample"))
    found = {f"check.{i}": (validate.HARD, lambda i=i: rows.filter(F.col("sample") < str(i))) for i in range(10)}
    got = {r.check_id: (r.status, r["count"], r.samples) for r in validate.run_checks(found, at_once=4).collect()}
    assert len(jobs) == 3 and got["check.0"] == ("PASS", 0, []) and got["check.3"] == ("FAIL", 13, ["0", "1", "10", "11", "12"])
    assert got == {r.check_id: (r.status, r["count"], r.samples) for r in validate.run_checks(found, at_once=100).collect()}


@needs_tables
def test_damaged_histories_are_not_written(spark, monkeypatch):
    """Both sides with all counts went through the windows of two sequences that no check reads."""
    written, real = [], check_queries.written
    monkeypatch.setattr(check_queries, "written", lambda df: written.append(df.columns) or real(df))
    history = check_queries.damaged(Tables(spark, SMALL))["history"]
    assert len(written) == 4 and not any("fighter_sequence" in c for c in written)
    assert "Exchange" not in history.select("fight_id", "fighter_id", "bout_knockdowns")._jdf.queryExecution().executedPlan().toString()


@needs_tables
def test_a_rebuild_orders_cards_without_counts(spark, monkeypatch):
    """The counts of both sides went through the windows that order cards, and were kept."""
    kept, real = [], derived.checkpointed
    monkeypatch.setattr(derived, "checkpointed", lambda df: kept.append(df.columns) or real(df))
    t = Tables(spark, SMALL)
    fights = t.contests.withColumns({"winner_name": F.lit(None).cast("string"), "ingest_seq": F.col("fight_id"), "created_at": F.lit(None).cast("timestamp")})
    wide = derived.rebuild_tables(t.cards, fights, t.rounds, t.fighters)[0]
    assert len(kept) == 1 and not any("knockdowns" in c for c in kept[0])
    landed = F.sum("fighter_a_significant_strikes_landed")
    with_rounds = t.contests.join(t.rounds.select("fight_id").distinct(), "fight_id", "left_semi")
    assert wide.agg(landed).first() == with_rounds.agg(landed).first() and wide.count() == t.contests.count()
