"""Golden values on a small graph of contests, and what adding future rows may not change."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from boutlens.functions import scalars
from boutlens.operators import asof, derived, metrics, paths, perspectives, ratings
from boutlens.schema import STATS

NAMES = {"a": "Ada", "b": "Bo", "c": "Cy", "d": "Dee", "e": "Eli"}
ID = {"a": 1, "b": 2, "c": 3, "d": 4, "e": 5}
# id, date, side A, side B, result, method; side A is the winner of completed ones
GRAPH = [
    ("m1", "2018-03-03", "a", "c", "completed", "Submission"), ("m2", "2018-06-09", "c", "d", "completed", "Decision - Split"),
    ("m3", "2018-09-15", "d", "b", "completed", "KO/TKO"), ("m4", "2019-01-19", "c", "b", "completed", "Decision - Unanimous"),
    ("m5", "2019-04-06", "b", "a", "completed", "KO/TKO"), ("m6", "2019-08-31", "a", "e", "draw", "Decision - Majority"),
    ("m7", "2019-11-02", "e", "a", "no_contest", "Overturned"), ("m8", "2020-02-22", "a", "b", "completed", "Decision - Unanimous"),
    ("m9", "2020-05-30", "a", "c", "completed", "KO/TKO"),
]
CUTOFF = "2021-01-01"


def contests(spark, rows=GRAPH):
    out = []
    for n, (name, day, a, b, result, method) in enumerate(rows):
        stats = {
            "significant_strikes_landed": (20, 10), "significant_strikes_attempted": (40, 40), "takedowns_landed": (2, 1),
            "takedowns_attempted": (4, 5), "submission_attempts": (1, 0),
        }
        row = {
            "fight_id": n + 1, "name": name, "event_id": name, "event_date": dt.date.fromisoformat(day), "card_order": 1, "weight_class": "W",
            "result": result, "winner_fighter_id": ID[a] if result == "completed" else None, "method_of_victory": method,
            "time_format": "3 Rnd (5-5-5)", "ending_round": 3, "ending_time": "5:00", "stats_available": True,
        }
        for s, i, x in (("a", 0, a), ("b", 1, b)):
            row |= {f"fighter_{s}_id": ID[x], f"fighter_{s}_name": NAMES[x]}
            row |= {f"fighter_{s}_{c}": stats.get(c, (0, 0))[i] for c in STATS}
        out.append(row)
    order = list(out[0])
    kinds = {"event_date": "date", "stats_available": "boolean"} | {c: "string" for c in ("name", "event_id", "weight_class", "result", "method_of_victory", "time_format", "ending_time", "fighter_a_name", "fighter_b_name")}
    kinds |= {c: "long" for c in ("fight_id", "winner_fighter_id", "fighter_a_id", "fighter_b_id")}
    schema = ", ".join(f"{c} {kinds.get(c, 'int')}" for c in order)
    return spark.createDataFrame([tuple(r[c] for c in order) for r in out], schema)


@pytest.fixture(scope="module")
def persp(spark):
    return perspectives.perspectives(contests(spark)).cache()


def plain_paths(start, target, depth):
    """Fights and weights of all simple chains of wins, by trying them out."""
    day = dt.date.fromisoformat(CUTOFF)
    edges = [(ID[a], ID[b], n + 1, 2 ** (-(day - dt.date.fromisoformat(d)).days / 1095.75) * (1.1 if m in ("KO/TKO", "Submission") else 1.0))
             for n, (_, d, a, b, result, m) in enumerate(GRAPH) if result == "completed"]
    found = {}

    def go(at, seen, fights, weight):
        for winner, loser, fight, w in edges:
            if winner == at and loser not in seen and len(fights) < depth:
                if loser == target:
                    found[*fights, fight] = weight * w / (len(fights) + 1) ** 2
                else:
                    go(loser, {*seen, loser}, (*fights, fight), weight * w)

    go(start, {start}, (), 1.0)
    return found


def test_paths_both_ways(spark, persp):
    pairs = spark.createDataFrame([(1, 2)], "a_id long, b_id long")
    there, back = plain_paths(1, 2, 3), plain_paths(2, 1, 3)
    assert len(there) > 3 and back
    row = paths.win_paths(pairs, persp, CUTOFF).first()
    assert (row.a_to_b_paths, row.b_to_a_paths, row.conflict) == (len(there), len(back), True)
    assert row.a_to_b_score == pytest.approx(sum(there.values())) and row.b_to_a_score == pytest.approx(sum(back.values()))
    one = paths.win_paths(pairs, persp, CUTOFF, max_depth=1).first()
    assert (one.a_to_b_paths, one.b_to_a_paths) == (len(plain_paths(1, 2, 1)), len(plain_paths(2, 1, 1)))
    start = spark.createDataFrame([(1, 2)], "start long, target long")
    found = paths.strongest_paths(paths.paths(start, paths.win_edges(persp, CUTOFF))).orderBy("rank").collect()
    assert {tuple(r.fights): r.weight for r in found} == pytest.approx(there)
    assert [r.weight for r in found] == sorted((r.weight for r in found), reverse=True)


def test_career(spark, persp):
    fighters = spark.createDataFrame([(i, n, dt.date(1990, 1, 1)) for i, n in ((1, "Ada"), (9, "New"))], "fighter_id long, fighter_name string, date_of_birth date")
    rows = {r.fighter_id: r for r in metrics.career_stats(persp, fighters, CUTOFF).collect()}
    a = rows[1]
    assert (a.record_win, a.record_loss, a.record_draw, a.record_no_contest) == (3, 1, 1, 1)
    assert a.takedown_defense == pytest.approx(1 - 8 / 28) and a.finish_rate_among_wins == pytest.approx(2 / 3)
    assert (a.days_since_last_fight, a.age, a.win_streak) == (216, 31, 2)
    assert rows[9].fights == 0 and "debut" in rows[9].caveats


def test_metrics_count_by_method(spark):
    """Wins and losses by method were left out."""
    rows = [("w1", "2024-01-01", "a", "b", "completed", "KO/TKO"), ("w2", "2024-01-10", "a", "c", "completed", "KO/TKO"), ("w3", "2024-01-20", "a", "d", "completed", None),
            ("l1", "2024-02-01", "b", "a", "completed", "Submission"), ("n1", "2024-03-01", "a", "b", "no_contest", "Overturned")]
    got = metrics.entity_metrics(perspectives.perspectives(contests(spark, rows))).filter("fighter_id = 1").first()
    assert got.wins_by_method == {"KO/TKO": 2, "Unknown": 1} and got.losses_by_method == {"Submission": 1}
    assert (got.fights, got.record_win, got.record_loss, got.record_no_contest, got.submission_losses) == (5, 3, 1, 1, 1) and got.finish_rate_among_wins == pytest.approx(2 / 3)


def test_future_rows_change_nothing(spark, persp):
    later = contests(spark, [*GRAPH, ("m10", CUTOFF, "b", "a", "completed", "KO/TKO"), ("m11", "2022-01-01", "c", "a", "completed", "KO/TKO")])
    more = perspectives.perspectives(later)
    for make in (lambda p: metrics.entity_metrics(perspectives.strict_cutoff(p, CUTOFF)), lambda p: asof.opponent_quality(perspectives.strict_cutoff(p, CUTOFF))):
        assert sorted(map(str, make(persp).collect())) == sorted(map(str, make(more).collect()))


def test_opponent_quality(persp):
    rows = {(r.fight_id, r.fighter_id): r for r in asof.opponent_quality(persp).collect()}
    assert rows[(1, 1)].quality is None and rows[(1, 1)].tier == "unknown"
    assert rows[(2, 4)].quality == pytest.approx(1 / 3)


def test_streaks_and_rest(spark):
    rows = [("w", "2024-01-01", "a", "b", "completed", "KO/TKO"), ("n", "2024-01-10", "a", "c", "no_contest", "Overturned"),
            ("d", "2024-01-20", "a", "d", "draw", "Decision"), ("l", "2024-02-01", "b", "a", "completed", "KO/TKO")]
    p = perspectives.perspectives(contests(spark, rows))
    got = derived.rest_days(derived.prefight_streaks(p)).filter("fighter_id = 1").orderBy("event_date").collect()
    assert [r.prior_win_streak for r in got] == [0, 1, 1, 0] and [r.rest_days for r in got] == [None, 9, 10, 12]
    final = derived.final_aggregates(p).filter("fighter_id = 1").first()
    assert (final.wins, final.losses, final.draws, final.no_contests, final.current_loss_streak) == (1, 1, 1, 1, 1)


def test_elo_equals_a_replay(persp):
    rating, rows = {}, persp.select("event_date", "fighter_id", "opponent_id", "bout_outcome").collect()
    for day in sorted({r.event_date for r in rows}):
        changes = {}
        for r in (r for r in rows if r.event_date == day):
            score = {"win": 1.0, "loss": 0.0, "draw": 0.5}.get(r.bout_outcome)
            if score is not None:
                mine, other = rating.get(r.fighter_id, 1500.0), rating.get(r.opponent_id, 1500.0)
                changes[r.fighter_id] = changes.get(r.fighter_id, 0.0) + 32 * (score - 1 / (1 + 10 ** ((other - mine) / 400)))
        for k, v in changes.items():
            rating[k] = rating.get(k, 1500.0) + v
    got = {r.fighter_id: r.rating for r in ratings.elo_ratings(ratings.elo_history(persp)).collect()}
    assert got == pytest.approx(rating, abs=1e-6)


def test_duration_and_parsers(spark):
    df = spark.createDataFrame([("1 Rnd + OT (12-3)", 2, "2:30"), (None, 1, "1:00"), ("No Time Limit", 1, "10:00"), ("3 Rnd (5-5-5)", 4, "1:00"), ("3 Rnd (5-5-5)", 1, "1:75")], "f string, r int, t string")
    got = [r[0] for r in df.select(scalars.duration_minutes(F.col("r"), F.col("t"), F.col("f"))).collect()]
    assert got == [14.5, None, 10.0, None, None]
    row = spark.sql("SELECT '3 of 7' a, '8 of 7' b, 'x' c, '5\\' 11\"' h, '69\"' r, 'Dec 04, 1991' d").select(
        scalars.parse_of(F.col("a")).alias("a"), scalars.parse_of(F.col("b")).alias("b"), scalars.parse_of(F.col("c")).alias("c"),
        scalars.height_inches(F.col("h")).alias("h"), scalars.reach_inches(F.col("r")).alias("r"), scalars.parse_date(F.col("d")).alias("d"),
    ).first()
    assert tuple(row.a) == (3, 7) and row.b is None and row.c is None
    assert (row.h, row.r, row.d) == (71, 69, dt.date(1991, 12, 4))


def test_unicode_keys(spark):
    df = spark.createDataFrame([("  José  ÁLDO ",), (None,)], "x string").select(scalars.words(F.col("x")).alias("w"), scalars.name_key(F.col("x")).alias("k"))
    assert [tuple(r) for r in df.collect()] == [("jose aldo", "josé áldo"), (None, None)]
