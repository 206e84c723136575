"""What shows only on larger tables: keys beyond those of the small ones, and sizes of plans."""

import glob
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from boutlens.operators import derived, paths, ratings
from boutlens.plans import ORACLE, QUERIES, check_queries
from boutlens.plans.catalog import Tables

SMALL = "/root/testdata/sf0.001"
needs_tables = pytest.mark.skipif(not os.path.isdir(SMALL), reason="the driver's tables are not here")


@pytest.fixture(scope="module")
def shifted(spark, tmp_path_factory):
    """The small tables twice: as they are, and with keys as high as those of large ones."""
    folder = str(tmp_path_factory.mktemp("shifted"))
    keys = {"orders": ("o_orderkey",), "lineitem": ("l_orderkey", "l_partkey"), "part": ("p_partkey",)}
    for name, columns in keys.items():
        df = spark.read.parquet(f"{SMALL}/{name}.parquet")
        high = df.withColumns({c: F.col(c) + (1_000_000 if c.endswith("orderkey") else 20_000) for c in columns})
        df.unionByName(high).write.parquet(f"{folder}/{name}.parquet")
    return folder


def same_as_sql(spark, folder, name):
    df = QUERIES[name](spark, folder)
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}/*.parquet'")
    columns = sorted(df.columns)
    expected = con.execute(f"SELECT {', '.join(columns)} FROM ({ORACLE[name]})").fetchall()
    assert len(expected) > 0
    assert sorted(map(str, map(tuple, df.select(*columns).collect()))) == sorted(map(str, expected))


@needs_tables
@pytest.mark.parametrize("name", ["score_rows", "score_summary", "paired_runs", "matched_runs"])
def test_forecasts_of_high_ids_equal_the_sql(spark, shifted, name):
    same_as_sql(spark, shifted, name)


@needs_tables
def test_forecasts_are_graded_whatever_their_ids(spark, shifted):
    """Contests beyond an id of a billion were conflicts all, so large tables were graded in part."""
    f = F.col("fight_id")
    own = QUERIES["score_rows"](spark, shifted).filter((f % 7 != 3) & (f % 31 != 5) & (f > 1_000_000_000))
    got = {r.status: r["count"] for r in own.groupBy("status").count().collect()}
    assert "CONFLICT" not in got and got["RIGHT"] > 0 and got["WRONG"] > 0


def test_card_orders_carry_no_cards(spark):
    """A card of n contests had n lists of its n values."""
    ids = spark.range(4000).select(F.col("id").alias("fight_id"), F.when(F.col("id") < 10, F.col("id") % 3).otherwise(99).alias("event_id"))
    fights = ids.withColumns({
        "card_order": F.lit(None).cast("int"), "ingest_seq": F.when(F.col("event_id") == 99, -F.col("fight_id")), "created_at": F.lit(None).cast("timestamp"),
        "fighter_a_id": F.col("fight_id"), "fighter_b_id": F.when(F.col("event_id") == 0, 0).when(F.col("event_id") == 1, -F.col("fight_id")),
    })
    df = derived.card_order_backfill(fights)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_set" not in plan and "collect_list" not in plan
    got = {r.fight_id: (r.order, r.order_status) for r in df.collect()}
    assert got[10] == (3990, "filled") and got[3999] == (1, "filled")
    assert got[0] == got[9] == (None, "ambiguous") and got[1] == (1, "filled") and got[7] == (3, "filled")
    assert got[2] == got[8] == (None, "ambiguous")  # two sides unknown


def test_a_pass_of_ratings_reads_its_rows_once(spark):
    """Each pass joined the summed rows with themselves, so they were made twice."""
    rows = spark.createDataFrame([(1, 5, 6, 0, 1.0, 1500.0), (1, 6, 5, 0, 0.0, 1600.0), (2, 5, 7, 1, None, 1500.0), (2, 7, 5, 1, None, 1.0)],
                                 "fight_id long, fighter_id long, opponent_id long, day int, score double, used double")
    df = ratings.played(rows)
    assert "Join" not in df._jdf.queryExecution().optimizedPlan().toString()
    got = {(r.fight_id, r.fighter_id): r.change for r in df.collect()}
    p = 1 / (1 + 10 ** (100 / 400))
    assert got == {(1, 5): pytest.approx(32 * (1 - p)), (1, 6): pytest.approx(-32 * (1 - p)), (2, 5): 0.0, (2, 7): 0.0}


@needs_tables
def test_a_rebuild_writes_its_rows_once(spark, monkeypatch):
    """The wide rows of both sides were written too, though the report needs eight of their columns."""
    written = []
    monkeypatch.setattr(derived, "checkpointed", lambda df: written.append(len(df.columns)) or df)
    report = {r.counter: r.n for r in QUERIES["rebuild_tables"](spark, SMALL).collect()}
    assert len(written) == 1 and report["profile_fields_hydrated"] > 0


def joined_rows(plan):
    """The most rows that a join of an executed plan gave."""
    name = plan.nodeName()
    if name == "AdaptiveSparkPlan":
        return joined_rows(plan.executedPlan())
    if "QueryStage" in name:
        return joined_rows(plan.plan())
    most = plan.metrics().apply("numOutputRows").value() if "Join" in name else 0
    kids = plan.children()
    return max([most, *(joined_rows(kids.apply(i)) for i in range(kids.size()))])


@pytest.mark.parametrize("depth", [3, 4])
def test_pairs_carry_no_chains(spark, depth):
    """Each pair met all chains of its start, which led to none of its target's."""
    ids = iter(range(1000, 1_000_000))
    won = [(s, m) for s in range(20) for m in range(100, 120)] + [(m, next(ids)) for m in range(100, 120) for _ in range(10)]
    won += [(m, t) for t in range(200, 220) for m in range(300, 320)] + [(next(ids), m) for m in range(300, 320) for _ in range(10)] + [(110, 310)]
    edges = spark.createDataFrame([(w, x, n, 1.0) for n, (w, x) in enumerate(won)], "winner long, loser long, fight_id long, weight double").localCheckpoint()
    pairs = spark.createDataFrame([(s, t) for s in range(20) for t in range(200, 220)], "start long, target long").localCheckpoint()
    df = paths.paths(pairs, edges, depth).groupBy("start", "target").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
    got = df.collect()
    assert len(got) == 400 and {(r.n, round(r.w, 9)) for r in got} == {(1, round(1 / 9, 9))}
    assert joined_rows(df._jdf.queryExecution().executedPlan()) < 20_000


@needs_tables
def test_rows_of_sides_carry_only_what_is_asked_for(spark):
    """A struct of all columns of a side went through the windows, and the counts of the sides were made before the cards were numbered."""
    t = Tables(spark, SMALL)
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    assert "knockdowns" not in plan(t.persp.select("fight_id", "fighter_id", "bout_outcome", "fighter_sequence"))
    numbered = plan(t.contests).split("Window", 1)  # above the window that numbers cards, and from it on
    assert "knockdowns" in numbered[0] and "knockdowns" not in numbered[1]


@needs_tables
def test_replays_keep_narrow_rows(spark, monkeypatch):
    """All counts of both sides were kept four times, of which the replays need none and the totals five."""
    kept = []
    for name in ("checkpointed", "written"):
        if hasattr(check_queries, name):
            monkeypatch.setattr(check_queries, name, lambda df: kept.append(len(df.columns)) or df)
    check_queries._replays(Tables(spark, SMALL))
    assert kept and max(kept) <= 24 and len(kept) <= 2


@needs_tables
def test_checks_read_the_columns_they_need(spark):
    """Each check read whole rows of a checkpoint."""
    kept = check_queries.damaged(Tables(spark, SMALL))
    for name in ("d_contests", "d_rounds", "history"):
        plan = kept[name].select("fight_id")._jdf.queryExecution().executedPlan().toString()
        assert "ReadSchema: struct<fight_id:bigint>" in plan
