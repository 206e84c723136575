"""Queries over contests: perspectives, derived history, metrics, strength, paths."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..checkpoints import alone, checkpointed, written
from ..functions import scalars
from ..operators import asof, coverage, derived, evidence, metrics, paths, perspectives, ratings
from ..schema import STATS, SUMMED
from ..sources import files, tables
from .catalog import HISTORY_SQL, ONCE, WITH, Tables, query, r6, rounded
from .proxy import rounds_of

CUTOFF = "2000-01-01"
ORDER = f"PARTITION BY fighter_id ORDER BY {HISTORY_SQL}"
BEFORE = f"({ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
DAY = "(event_date - DATE '1970-01-01')"
EARLIER = f"(PARTITION BY fighter_id ORDER BY {DAY} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
N = lambda cond, over="": f"coalesce(sum(CASE WHEN {cond} THEN 1 ELSE 0 END){over}, 0)::BIGINT"
R6 = lambda x: f"round({x}, 6) + 0.0"


@query("perspectives", f"{WITH} SELECT fight_id, event_id, slot, fighter_id, opponent_id, bout_outcome, event_bout_sequence, fighter_sequence,"
       " bout_significant_strikes_landed, opponent_bout_significant_strikes_landed, bout_control_time_seconds FROM persp")  # fmt: skip
def _perspectives(t: Tables) -> DataFrame:
    return t.persp.select("fight_id", "event_id", "slot", "fighter_id", "opponent_id", "bout_outcome", "event_bout_sequence", "fighter_sequence",
                          "bout_significant_strikes_landed", "opponent_bout_significant_strikes_landed", "bout_control_time_seconds")


@query("outcome_case", f"{WITH} SELECT bout_outcome, slot, count(*) AS n FROM persp GROUP BY 1, 2")
def _outcomes(t: Tables) -> DataFrame:
    return t.persp.groupBy("bout_outcome", "slot").agg(F.count("*").alias("n"))


@query("entity_sequence", f"{WITH} SELECT fighter_id, fight_id, fighter_sequence, event_bout_sequence FROM persp")
def _sequence(t: Tables) -> DataFrame:
    return t.persp.select("fighter_id", "fight_id", "fighter_sequence", "event_bout_sequence")


@query("contest_card_join", f"{WITH} SELECT f.fight_id, e.event_name, e.event_date, e.source_fight_count FROM contests f JOIN cards e ON f.event_id = e.event_id", dates=("event_date",))
def _card_join(t: Tables) -> DataFrame:
    return t.contests.select("fight_id", "event_id").join(t.cards, "event_id").select("fight_id", "event_name", "event_date", "source_fight_count")


@query("prefight_record", f"""{WITH} SELECT fight_id, fighter_id, event_date, bout_outcome, {N("bout_outcome = 'win'", f" OVER {BEFORE}")} AS prior_wins,
       {N("bout_outcome = 'loss'", f" OVER {BEFORE}")} AS prior_losses, {N("bout_outcome = 'draw'", f" OVER {BEFORE}")} AS prior_draws FROM persp""", dates=("event_date",))  # fmt: skip
def _record(t: Tables) -> DataFrame:
    cols = ("fight_id", "fighter_id", "event_date", "bout_outcome", "prior_wins", "prior_losses", "prior_draws")
    return derived.prefight_record(t.persp).select(*cols)


@query("prefight_streaks", f"""{WITH}, i AS (SELECT *, sum((bout_outcome IN ('loss', 'draw'))::INT) OVER ({ORDER}) AS w,
       sum((bout_outcome IN ('win', 'draw'))::INT) OVER ({ORDER}) AS l FROM persp),
       s AS (SELECT *, sum((bout_outcome = 'win')::INT) OVER (PARTITION BY fighter_id, w ORDER BY {HISTORY_SQL}) AS ws,
       sum((bout_outcome = 'loss')::INT) OVER (PARTITION BY fighter_id, l ORDER BY {HISTORY_SQL}) AS ls FROM i)
       SELECT fight_id, fighter_id, coalesce(lag(ws) OVER ({ORDER}), 0)::BIGINT AS prior_win_streak,
       coalesce(lag(ls) OVER ({ORDER}), 0)::BIGINT AS prior_loss_streak FROM s""")  # fmt: skip
def _streaks(t: Tables) -> DataFrame:
    return derived.prefight_streaks(t.persp).select("fight_id", "fighter_id", "prior_win_streak", "prior_loss_streak")


@query("rest_days", f"{WITH} SELECT fight_id, fighter_id, event_date - lag(event_date) OVER ({ORDER}) AS rest_days FROM persp")
def _rest(t: Tables) -> DataFrame:
    return derived.rest_days(t.persp).select("fight_id", "fighter_id", "rest_days")


@query("head_to_head", f"""{WITH} SELECT fight_id, row_number() OVER (PARTITION BY least(fighter_a_id, fighter_b_id), greatest(fighter_a_id, fighter_b_id)
       ORDER BY event_date, s, event_id, fight_id) - 1 AS head_to_head_fight_count
       FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY card_order DESC NULLS LAST, fight_id) AS s FROM contests)""")  # fmt: skip
def _met(t: Tables) -> DataFrame:
    return derived.head_to_head(t.contests)


@query("event_start_record", f"""{WITH} SELECT fight_id, fighter_id, {N("bout_outcome = 'win'", f" OVER {EARLIER}")} AS start_wins,
       {N("bout_outcome = 'loss'", f" OVER {EARLIER}")} AS start_losses, {N("bout_outcome = 'draw'", f" OVER {EARLIER}")} AS start_draws,
       {N("bout_outcome = 'no_contest'", f" OVER {EARLIER}")} AS start_no_contests FROM persp""")  # fmt: skip
def _start(t: Tables) -> DataFrame:
    cols = ("fight_id", "fighter_id", "start_wins", "start_losses", "start_draws", "start_no_contests")
    return derived.event_start_record(t.persp).select(*cols)


_AGE = "date_diff('year', date_of_birth, {d}) - (CASE WHEN month({d}) * 100 + day({d}) < month(date_of_birth) * 100 + day(date_of_birth) THEN 1 ELSE 0 END)"


@query("rebuild_derived", f"""{WITH}, h AS (SELECT fight_id AS f, row_number() OVER (PARTITION BY least(fighter_a_id, fighter_b_id), greatest(fighter_a_id, fighter_b_id)
       ORDER BY event_date, s, fight_id) - 1 AS meetings
       FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY card_order DESC, fight_id) AS s FROM contests)),
       w AS (SELECT *, {N("bout_outcome = 'win'", f" OVER {BEFORE}")} AS prior_wins, {N("bout_outcome = 'loss'", f" OVER {BEFORE}")} AS prior_losses,
       {N("bout_outcome = 'draw'", f" OVER {BEFORE}")} AS prior_draws, event_date - lag(event_date) OVER ({ORDER}) AS rest_days FROM persp)
       SELECT w.fight_id, w.fighter_id, prior_wins, prior_losses, prior_draws, rest_days, {_AGE.format(d="event_date")} AS prefight_age,
       e.reach_inches AS prefight_reach_inches, e.stance AS prefight_stance, meetings AS head_to_head_fight_count
       FROM w LEFT JOIN entities e ON w.fighter_id = e.fighter_id JOIN h ON w.fight_id = h.f""")  # fmt: skip
def _rebuild(t: Tables) -> DataFrame:
    df = derived.rebuild_derived(t.contests, t.fighters)
    return df.select("fight_id", "fighter_id", "prior_wins", "prior_losses", "prior_draws", "rest_days", "prefight_age", "prefight_reach_inches", "prefight_stance", "head_to_head_fight_count")


@query("profile_hydration", f"""{WITH} SELECT fight_id, p.fighter_id, {_AGE.format(d="event_date")} AS prefight_age, height_inches AS prefight_height_inches,
       reach_inches AS prefight_reach_inches, stance AS prefight_stance, true AS prefight_profile_imputed
       FROM persp p LEFT JOIN entities e ON p.fighter_id = e.fighter_id""")  # fmt: skip
def _hydrate(t: Tables) -> DataFrame:
    df = derived.profile_hydration(t.persp, t.fighters)
    return df.select("fight_id", "fighter_id", *[f"prefight_{c}" for c in ("age", "height_inches", "reach_inches", "stance", "profile_imputed")])


_OUTCOME_COUNTS = ", ".join(f"count(*) FILTER (WHERE bout_outcome = '{o}') AS {n}" for o, n in (("win", "wins"), ("loss", "losses"), ("draw", "draws"), ("no_contest", "no_contests")))


@query("final_aggregates", f"""{WITH}, l AS (SELECT fighter_id, coalesce(max(fighter_sequence) FILTER (WHERE bout_outcome IN ('loss', 'draw')), 0) AS w,
       coalesce(max(fighter_sequence) FILTER (WHERE bout_outcome IN ('win', 'draw')), 0) AS l FROM persp GROUP BY 1)
       SELECT p.fighter_id, count(*) AS fights, {_OUTCOME_COUNTS},
       count(*) FILTER (WHERE bout_outcome = 'win' AND fighter_sequence > w) AS current_win_streak,
       count(*) FILTER (WHERE bout_outcome = 'loss' AND fighter_sequence > l) AS current_loss_streak,
       {", ".join(f"coalesce(sum(bout_{c}), 0)::BIGINT AS {c}" for c in SUMMED)}, max(event_date) AS last_fight_date
       FROM persp p JOIN l ON p.fighter_id = l.fighter_id GROUP BY 1""", dates=("last_fight_date",))  # fmt: skip
def _final(t: Tables) -> DataFrame:
    return derived.final_aggregates(t.persp)


def _rate(c: str, per: int) -> str:
    ok = f"stats_available AND {c} IS NOT NULL AND fought IS NOT NULL"
    return f"sum({c}) FILTER (WHERE {ok}) * {60 * per}.0::DOUBLE / nullif(sum(fought) FILTER (WHERE {ok}), 0)"


def _ratio(n: str, d: str, defense: bool) -> str:
    ok = f"stats_available AND {n} IS NOT NULL AND {d} IS NOT NULL"
    value = f"sum({n}) FILTER (WHERE {ok})::DOUBLE / nullif(sum({d}) FILTER (WHERE {ok}), 0)"
    return f"1 - {value}" if defense else value


_RECORD = ", ".join(f"count(*) FILTER (WHERE bout_outcome = '{o}') AS record_{o}" for o in ("win", "loss", "draw", "no_contest"))
_METRICS = ", ".join([
    "count(*) AS fights", _RECORD, "count(*) FILTER (WHERE bout_outcome IS NULL) AS unknown_results", "count(*) FILTER (WHERE stats_available) AS stat_fights",
    "count(*) FILTER (WHERE stats_available AND fought IS NOT NULL) AS timed_stat_fights",
    *[f"{R6(_rate(c, per))} AS {n}" for n, c, per in metrics.RATES], *[f"{R6(_ratio(a, b, d))} AS {n}" for n, a, b, d in metrics.RATIOS],
    R6("count(*) FILTER (WHERE bout_outcome = 'win' AND lower(method_of_victory) IN ('ko/tko', 'submission'))::DOUBLE / nullif(count(*) FILTER (WHERE bout_outcome = 'win'), 0)") + " AS finish_rate_among_wins",
    "count(*) FILTER (WHERE bout_outcome = 'loss' AND method_of_victory = 'Submission') AS submission_losses",
])
_VALUES = [n for n, *_ in (*metrics.RATES, *metrics.RATIOS)] + ["finish_rate_among_wins"]


_BY_METHOD = """coalesce(string_agg(method || ': ' || n, ';' ORDER BY method) FILTER (WHERE bout_outcome = 'win'), '') AS wins_by_method,
       coalesce(string_agg(method || ': ' || n, ';' ORDER BY method) FILTER (WHERE bout_outcome = 'loss'), '') AS losses_by_method"""


@query("entity_metrics", f"""{WITH}, m AS (SELECT fighter_id, {_METRICS} FROM persp GROUP BY 1),
       h AS (SELECT fighter_id, {_BY_METHOD} FROM (SELECT fighter_id, bout_outcome, coalesce(method_of_victory, 'Unknown') AS method, count(*) AS n FROM persp GROUP BY 1, 2, 3) GROUP BY 1)
       SELECT m.*, wins_by_method, losses_by_method FROM m JOIN h ON m.fighter_id = h.fighter_id""")  # fmt: skip
def _metrics(t: Tables) -> DataFrame:
    """The counts by method as text, in the order of methods."""
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda x: F.concat(x["key"], F.lit(": "), x["value"].cast("string"))), ";")
    return rounded(metrics.entity_metrics(t.persp), *_VALUES).withColumns({c: text(c) for c in ("wins_by_method", "losses_by_method")})


@query("method_histogram", f"""{WITH} SELECT fighter_id, bout_outcome, coalesce(method_of_victory, 'Unknown') AS method, count(*) AS n FROM persp
       WHERE bout_outcome IN ('win', 'loss') GROUP BY 1, 2, 3""")  # fmt: skip
def _methods(t: Tables) -> DataFrame:
    return metrics.method_histogram(t.persp)


_TREND = {n: _rate(c, per) for n, c, per in metrics.RATES if n in metrics.TREND}
_RECENT = f"""b AS (SELECT *, row_number() OVER (PARTITION BY fighter_id ORDER BY fighter_sequence DESC) AS back FROM {{source}}),
    r AS (SELECT fighter_id, count(*) AS recent_fights, {", ".join(f"{x} AS {n}" for n, x in _TREND.items())} FROM b WHERE back <= 5 GROUP BY 1),
    c AS (SELECT fighter_id, {", ".join(f"{x} AS c_{n}" for n, x in _TREND.items())} FROM b GROUP BY 1)"""


@query("recent_form", f"""{WITH}, {_RECENT.format(source="persp")} SELECT r.fighter_id, recent_fights, {", ".join(f"{R6(n)} AS {n}, {R6(f'{n} - c_{n}')} AS trend_{n}" for n in _TREND)}
       FROM r JOIN c ON r.fighter_id = c.fighter_id""")  # fmt: skip
def _recent(t: Tables) -> DataFrame:
    return rounded(metrics.recent_form(t.persp), *_TREND, *[f"trend_{n}" for n in _TREND])


@query("current_win_streak", f"""{WITH} SELECT fighter_id, max(fighter_sequence) - coalesce(max(fighter_sequence) FILTER (WHERE bout_outcome IS DISTINCT FROM 'win'), 0) AS win_streak
       FROM persp GROUP BY 1""")  # fmt: skip
def _win_streak(t: Tables) -> DataFrame:
    return metrics.current_win_streak(t.persp)


@query("career_stats", f"""{WITH}, known AS (SELECT * FROM persp WHERE event_date < DATE '{CUTOFF}'), {_RECENT.format(source="known")},
       m AS (SELECT fighter_id, {_METRICS}, max(fighter_sequence) - coalesce(max(fighter_sequence) FILTER (WHERE bout_outcome IS DISTINCT FROM 'win'), 0) AS win_streak,
       DATE '{CUTOFF}' - max(event_date) AS days_since_last_fight FROM known GROUP BY 1)
       SELECT e.fighter_id, {_AGE.format(d=f"DATE '{CUTOFF}'")} AS age, coalesce(m.fights, 0) AS fights, record_win, record_loss, stat_fights,
       m.sig_strikes_landed_per_min, m.takedown_defense, recent_fights, {", ".join(f"{R6(f'r.{n} - c_{n}')} AS trend_{n}" for n in _TREND)},
       coalesce(win_streak, 0) AS win_streak, days_since_last_fight,
       concat_ws(',', CASE WHEN m.fights IS NULL THEN 'debut' END, CASE WHEN coalesce(m.fights, 0) < 3 THEN 'thin recent form' END, CASE WHEN date_of_birth IS NULL THEN 'age unknown' END) AS caveats
       FROM entities e LEFT JOIN m ON e.fighter_id = m.fighter_id LEFT JOIN r ON e.fighter_id = r.fighter_id LEFT JOIN c ON e.fighter_id = c.fighter_id""")  # fmt: skip
def _career(t: Tables) -> DataFrame:
    df = metrics.career_stats(t.persp, t.fighters, CUTOFF).withColumn("caveats", F.array_join("caveats", ","))
    values = ["sig_strikes_landed_per_min", "takedown_defense", *[f"trend_{n}" for n in _TREND]]
    return rounded(df, *values).select("fighter_id", "age", "fights", "record_win", "record_loss", "stat_fights", *values, "recent_fights", "win_streak", "days_since_last_fight", "caveats")


@query("round_totals", f"""{WITH} SELECT fight_id, fighter_id, count(*) AS rounds, sum(significant_strikes_landed)::BIGINT AS significant_strikes_landed,
       sum(takedowns_landed)::BIGINT AS takedowns_landed, sum(control_time_seconds)::BIGINT AS control_time_seconds FROM rounds GROUP BY 1, 2""")  # fmt: skip
def _round_totals(t: Tables) -> DataFrame:
    return metrics.round_totals(t.rounds, ("significant_strikes_landed", "takedowns_landed", "control_time_seconds"))


_MET = "string_agg(strftime(event_date, '%Y-%m-%d') || ' ' || fight_id || ' ' || bout_outcome, ';' ORDER BY event_date, fight_id)"


@query("common_opponents", f"""{WITH}, faced AS (SELECT fighter_id, opponent_id, {_MET} AS results FROM persp GROUP BY 1, 2),
       pairs AS (SELECT DISTINCT fighter_a_id AS a_id, fighter_b_id AS b_id FROM contests)
       SELECT a_id, b_id, a.opponent_id, a.results AS a_results, b.results AS b_results
       FROM pairs JOIN faced a ON a.fighter_id = a_id JOIN faced b ON b.fighter_id = b_id AND a.opponent_id = b.opponent_id""")  # fmt: skip
def _common(t: Tables) -> DataFrame:
    text = lambda c: F.array_join(F.transform(c, lambda x: F.concat_ws(" ", x["event_date"].cast("string"), x["fight_id"].cast("string"), x["bout_outcome"])), ";")
    return paths.common_opponents(t.pairs, t.persp).withColumns({c: text(c) for c in ("a_results", "b_results")})


_EDGES = f"""edges AS (SELECT fighter_id AS w, opponent_id AS l, fight_id AS f, pow(2.0::DOUBLE, -(DATE '{CUTOFF}' - event_date) / 1095.75::DOUBLE)
    * CASE WHEN lower(method_of_victory) IN ('ko/tko', 'submission') THEN 1.1::DOUBLE ELSE 1.0::DOUBLE END AS v
    FROM persp WHERE bout_outcome = 'win' AND event_date < DATE '{CUTOFF}')"""


def _met_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Who met whom and how it ended, from both sides and from the first one; written once."""
    persp = written(t.persp.select("fight_id", "fighter_id", "opponent_id", "slot", "event_date", "bout_outcome", "method_of_victory"))
    return persp, persp.filter("slot = 'a'")


@query("win_paths", f"""{WITH}, {_EDGES}, pairs AS (SELECT DISTINCT fighter_a_id AS a_id, fighter_b_id AS b_id FROM contests),
       asked AS (SELECT a_id AS s, b_id AS t FROM pairs UNION SELECT b_id, a_id FROM pairs),
       found AS (SELECT s, t, v AS score FROM asked JOIN edges ON w = s AND l = t
       UNION ALL SELECT s, t, x.v * y.v / 4 FROM asked JOIN edges x ON x.w = s JOIN edges y ON y.w = x.l AND y.l = t WHERE x.l <> t
       UNION ALL SELECT s, t, x.v * y.v * z.v / 9 FROM asked JOIN edges x ON x.w = s JOIN edges y ON y.w = x.l JOIN edges z ON z.w = y.l AND z.l = t
       WHERE x.l <> t AND y.l <> t AND y.l <> s),
       sums AS (SELECT s, t, count(*) AS n, sum(score) AS score FROM found GROUP BY 1, 2)
       SELECT a_id, b_id, coalesce(x.n, 0) AS a_to_b_paths, {R6("coalesce(x.score, 0)")} AS a_to_b_score, coalesce(y.n, 0) AS b_to_a_paths, {R6("coalesce(y.score, 0)")} AS b_to_a_score,
       x.n IS NOT NULL AND y.n IS NOT NULL AS conflict FROM pairs LEFT JOIN sums x ON x.s = a_id AND x.t = b_id LEFT JOIN sums y ON y.s = b_id AND y.t = a_id""")  # fmt: skip
def _win_paths(t: Tables) -> DataFrame:
    persp, met = _met_sides(t)
    return rounded(paths.win_paths(met.select(F.col("fighter_id").alias("a_id"), F.col("opponent_id").alias("b_id")), persp, CUTOFF), "a_to_b_score", "b_to_a_score")


def _chains(depth: int) -> str:
    """All simple chains of so many wins from s to t."""
    e = [f"e{i}" for i in range(depth)]
    joins = " ".join(f"JOIN edges {x} ON {x}.w = {'s' if not i else f'{e[i - 1]}.l'}" + (f" AND {x}.l = t" if i == depth - 1 else "") for i, x in enumerate(e))
    nodes = ["s", *[f"{x}.l" for x in e[:-1]], "t"]
    apart = " AND ".join(f"{x} <> {y}" for i, x in enumerate(nodes) for y in nodes[i + 1 :])
    return f"SELECT s, t, [{', '.join(nodes)}] AS entities, [{', '.join(f'{x}.f' for x in e)}] AS fights, {' * '.join(f'{x}.v' for x in e)} / {depth**2} AS weight FROM asked {joins} WHERE {apart}"


@query("strongest_paths", f"""{WITH}, {_EDGES}, asked AS (SELECT DISTINCT fighter_a_id AS s, fighter_b_id AS t FROM contests WHERE event_date < DATE '{CUTOFF}'),
       found AS ({" UNION ALL ".join(_chains(d) for d in (1, 2, 3, 4))}),
       ranked AS (SELECT *, row_number() OVER (PARTITION BY s, t ORDER BY round(weight, 12) DESC, fights) AS rank FROM found)
       SELECT s AS start, t AS target, rank, array_to_string(entities, '>') AS entities, {R6("weight")} AS weight FROM ranked WHERE rank <= 3""")  # fmt: skip
def _strongest_paths(t: Tables) -> DataFrame:
    """The three heaviest chains of up to four wins between those that met before the cutoff."""
    persp, met = _met_sides(t)
    asked = met.filter(F.col("event_date") < CUTOFF).select(F.col("fighter_id").alias("start"), F.col("opponent_id").alias("target"))
    heaviest = lambda found: paths.strongest_paths(found, 3).drop("rank")
    best = paths.strongest_paths(paths.paths(asked, written(paths.win_edges(persp, CUTOFF)), 4, heaviest), 3)
    return rounded(best, "weight").select("start", "target", "rank", F.array_join(F.col("entities").cast("array<string>"), ">").alias("entities"), "weight")


_QUALITY = "CASE WHEN w + l + d > 0 THEN (w + 0.5::DOUBLE * d + 1) / (w + l + d + 2) END"


@query("opponent_quality", f"""{WITH}, s AS (SELECT fight_id, fighter_id, opponent_id, event_date, bout_outcome, {N("bout_outcome = 'win'", f" OVER {EARLIER}")} AS w,
       {N("bout_outcome = 'loss'", f" OVER {EARLIER}")} AS l, {N("bout_outcome = 'draw'", f" OVER {EARLIER}")} AS d FROM persp),
       daily AS (SELECT fighter_id, event_date, sum(w) OVER x AS w, sum(l) OVER x AS l, sum(d) OVER x AS d, lead(event_date) OVER (PARTITION BY fighter_id ORDER BY event_date) AS until
       FROM (SELECT fighter_id, event_date, count(*) FILTER (WHERE bout_outcome = 'win') AS w, count(*) FILTER (WHERE bout_outcome = 'loss') AS l,
             count(*) FILTER (WHERE bout_outcome = 'draw') AS d FROM persp GROUP BY 1, 2)
       WINDOW x AS (PARTITION BY fighter_id ORDER BY event_date)),
       cuts AS (SELECT e.event_date, quantile_cont(q, 1.0 / 3) AS low, quantile_cont(q, 2.0 / 3) AS high, count(q) AS roster
       FROM (SELECT DISTINCT event_date FROM persp) e LEFT JOIN (SELECT *, {_QUALITY} AS q FROM daily) h
       ON h.event_date < e.event_date AND (h.until IS NULL OR e.event_date <= h.until) GROUP BY 1)
       SELECT p.fight_id, p.fighter_id, p.opponent_id, p.bout_outcome, o.w AS start_wins, o.l AS start_losses, o.d AS start_draws, {R6("o.q")} AS quality, roster,
       CASE WHEN o.q IS NULL THEN 'unknown' WHEN low = high THEN 'mid' WHEN o.q > high THEN 'top' WHEN o.q < low THEN 'low' ELSE 'mid' END AS tier
       FROM s p JOIN (SELECT *, {_QUALITY} AS q FROM s) o ON o.fight_id = p.fight_id AND o.fighter_id = p.opponent_id JOIN cuts ON cuts.event_date = p.event_date""")  # fmt: skip
def _opponents(t: Tables) -> DataFrame:
    persp = checkpointed(t.persp.select("fight_id", "fighter_id", "opponent_id", "event_date", "bout_outcome"))  # read thrice
    return rounded(asof.opponent_quality(persp).drop("event_date"), "quality")


@query("style_midrank", f"""{WITH}, m AS (SELECT fighter_id, {", ".join(f"{x} AS {n}" for n, x in {**{n: _rate(c, p) for n, c, p in metrics.RATES}, **{n: _ratio(a, b, d) for n, a, b, d in metrics.RATIOS}}.items())}
       FROM persp WHERE event_date < DATE '{CUTOFF}' GROUP BY 1),
       long AS (UNPIVOT (SELECT fighter_id, {", ".join(asof.STYLE_KEYS)} FROM m) ON {", ".join(asof.STYLE_KEYS)} INTO NAME metric VALUE value)
       SELECT fighter_id, metric, {R6("value")} AS value, {R6("(rank() OVER (PARTITION BY metric ORDER BY value) - 1 + 0.5::DOUBLE * count(*) OVER (PARTITION BY metric, value)) / count(*) OVER (PARTITION BY metric)")} AS rank
       FROM long""")  # fmt: skip
def _midrank(t: Tables) -> DataFrame:
    return rounded(asof.style_midranks(t.persp, CUTOFF).filter("value IS NOT NULL"), "value", "rank")


_ALL_METRICS = {**{n: _rate(c, p) for n, c, p in metrics.RATES}, **{n: _ratio(x, d, e) for n, x, d, e in metrics.RATIOS}}
_SIDE = ("takedowns_per_15_min", "takedown_defense", "sig_strikes_landed_per_min", "striking_defense", "sub_attempts_per_15_min")
_MIDRANKS = ", ".join(f"CASE WHEN {k} IS NOT NULL THEN (rank() OVER (ORDER BY {k} NULLS LAST) - 1 + 0.5::DOUBLE * count(*) OVER (PARTITION BY {k})) / count({k}) OVER () END AS r_{k}" for k in asof.STYLE_KEYS)
_TAGGED = ", ".join(f"CASE WHEN r_{k} >= 0.75 AND {k} > 0 THEN '{tag}' END" for k, tag in asof.STYLE_TAGS.items())
_ROUNDED = " AND ".join(f"r_{k} >= 0.5 AND {k} > 0" for k in asof.STYLE_TAGS)


@query("style_matchup", f"""{WITH}, m AS (SELECT fighter_id, {", ".join(f"{_ALL_METRICS[k]} AS {k}" for k in asof.STYLE_KEYS)},
       count(*) FILTER (WHERE bout_outcome = 'loss' AND method_of_victory = 'Submission') AS submission_losses FROM persp WHERE event_date < DATE '{CUTOFF}' GROUP BY 1),
       ranked AS (SELECT *, {_MIDRANKS} FROM m),
       sides AS (SELECT fighter_id, concat_ws(',', {_TAGGED}, CASE WHEN {_ROUNDED} THEN 'well-rounded' END) AS tags, {", ".join(f"{R6(c)} AS {c}" for c in _SIDE)}, submission_losses FROM ranked)
       SELECT a_id, b_id, {", ".join(f"{s}.{c} AS {s}_{c}" for s in "ab" for c in ("tags", *_SIDE, "submission_losses"))}
       FROM (SELECT DISTINCT fighter_a_id AS a_id, fighter_b_id AS b_id FROM contests) LEFT JOIN sides a ON a.fighter_id = a_id LEFT JOIN sides b ON b.fighter_id = b_id""")  # fmt: skip
def _matchup(t: Tables) -> DataFrame:
    df = asof.style_matchup(t.pairs, t.persp, CUTOFF)
    return rounded(df, *[f"{s}_{c}" for s in "ab" for c in _SIDE]).withColumns({c: F.array_join(c, ",") for c in ("a_tags", "b_tags")})


@query("elo_ratings")
def _elo(t: Tables) -> DataFrame:
    df = ratings.elo_ratings(ratings.elo_history(t.persp))
    return df.withColumn("rating", F.round("rating", 4))


def _before(t: Tables, rated: bool = False) -> tuple[DataFrame, DataFrame]:
    """The perspective rows, and what each opponent was before the day."""
    persp = written(metrics.needed(t.persp))
    return persp, asof.opponents_before(persp, alone(lambda: asof.states(persp, ratings.elo_history(persp) if rated else None)))


@query("elo_tiers")
def _tiers(t: Tables) -> DataFrame:
    df = _before(t, True)[1].withColumns({"opponent_rating": F.round("rating", 4), "strength": r6("strength")})
    return df.select("fight_id", "fighter_id", "opponent_id", "bout_outcome", "opponent_rating", "opponent_decided", "strength", "strength_cohort_size", "tier")


_SHORT = ("sig_strike_differential_per_min", "takedowns_per_15_min", "takedown_defense")


@query("performance_by_tier")
def _by_tier(t: Tables) -> DataFrame:
    return rounded(asof.performance_by_tier(*_before(t, True)).withColumn("fight_ids", F.array_join("fight_ids", ",")), *_SHORT)


@query("strongest_results")
def _strongest(t: Tables) -> DataFrame:
    return ratings.strongest_results(_before(t, True)[1])


_SUMS = {n: (f"CASE WHEN stats_available AND fought IS NOT NULL THEN {c} END", f"CASE WHEN stats_available AND {c} IS NOT NULL THEN fought END", f"{60 * per}.0::DOUBLE", False) for n, c, per in metrics.RATES}
_SUMS |= {n: (f"CASE WHEN stats_available AND {d} IS NOT NULL THEN {x} END", f"CASE WHEN stats_available AND {x} IS NOT NULL THEN {d} END", "1.0::DOUBLE", defense) for n, x, d, defense in metrics.RATIOS}
_SUMS = {k: _SUMS[k] for k in asof.STYLE_KEYS}


def _value(k: str) -> str:
    x = f"sum({k}__n) OVER u * {_SUMS[k][2]} / nullif(sum({k}__d) OVER u, 0)"
    return f"{'1 - ' if _SUMS[k][3] else ''}{x} AS {k}"


#: Entities after each of their days, and (targets, ranked) as the style of one of them before a day.
_STATES = f"""daily AS (SELECT fighter_id, event_date, {", ".join(f"sum({n}) AS {k}__n, sum({d}) AS {k}__d" for k, (n, d, *_) in _SUMS.items())},
       count(*) FILTER (WHERE stats_available AND fought IS NOT NULL) AS t, arg_max(weight_class, fighter_sequence) AS division FROM {{source}} GROUP BY 1, 2),
       states AS (SELECT fighter_id, event_date, division, sum(t) OVER u AS timed, {", ".join(_value(k) for k in asof.STYLE_KEYS)}, lead(event_date) OVER u AS until FROM daily
       WINDOW u AS (PARTITION BY fighter_id ORDER BY event_date))"""


def _ranks(key: str) -> str:
    """Midranks of targets (key, day, weight_class, timed, metrics) among the states that hold on the day."""
    own = ", ".join(f"count(*) FILTER (WHERE s.timed >= 3 AND s.{k} < t.{k}) + 0.5::DOUBLE * count(*) FILTER (WHERE s.timed >= 3 AND s.{k} = t.{k}) AS n_{k}, count(s.{k}) FILTER (WHERE s.timed >= 3) AS m_{k}" for k in asof.STYLE_KEYS)
    holds = "s.event_date < t.day AND (s.until IS NULL OR t.day <= s.until) AND t.day - s.event_date <= 1096"
    ranks = ", ".join(f"CASE WHEN timed >= 3 AND {k} IS NOT NULL THEN n_{k} / nullif(m_{k}, 0) END AS r_{k}" for k in asof.STYLE_KEYS)
    tags = ", ".join(f"CASE WHEN r_{k} >= 0.75 AND {k} > 0 THEN '{tag}' END" for k, tag in asof.STYLE_TAGS.items())
    return f"""own AS (SELECT t.{key}, count(s.fighter_id) AS c, {own} FROM targets t LEFT JOIN states s ON s.division = t.weight_class AND {holds} GROUP BY ALL),
       few AS (SELECT t.* FROM targets t JOIN own USING ({key}) WHERE c < 8),
       wide AS (SELECT t.{key}, count(s.fighter_id) AS c, {own} FROM few t LEFT JOIN states s ON {holds} GROUP BY ALL),
       placed AS (SELECT *, c >= 8 AS same FROM own WHERE c >= 8 UNION ALL SELECT *, false FROM wide),
       ranked AS (SELECT *, {ranks} FROM targets JOIN placed USING ({key})),
       styled AS (SELECT *, concat_ws(',', {tags}) AS tags, CASE WHEN coalesce({", ".join(f"r_{k}" for k in asof.STYLE_KEYS)}) IS NOT NULL THEN 'measured proxy' ELSE 'insufficient history' END AS status FROM ranked)"""


_LAGS = ", ".join(f"lag({c}) OVER w AS {c}" for c in ("timed", *asof.STYLE_KEYS))
_STYLED = f"""{_STATES.format(source="persp")}, prior AS (SELECT fighter_id AS subject, event_date AS day, {_LAGS} FROM states WINDOW w AS (PARTITION BY fighter_id ORDER BY event_date)),
       targets AS (SELECT fight_id * 2 + (slot = 'b')::INT AS key, fight_id, p.fighter_id, opponent_id, p.event_date AS day, weight_class, prior.* EXCLUDE (subject, day)
                   FROM persp p LEFT JOIN prior ON subject = opponent_id AND prior.day = p.event_date), {_ranks("key")}"""


@query("style_profile", f"""{ONCE}, {_STYLED.replace("states AS (", "states AS MATERIALIZED (")} SELECT fight_id, fighter_id, opponent_id, {", ".join(f"{R6(f'r_{k}')} AS {k}" for k in asof.STYLE_KEYS)}, tags, status, c AS cohort, same,
       coalesce(timed, 0)::BIGINT AS prior_stat_fights FROM styled""")  # fmt: skip
def _style(t: Tables) -> DataFrame:
    df = rounded(_before(t)[1], *asof.STYLE_KEYS).withColumn("tags", F.array_join("tags", ","))
    return df.select("fight_id", "fighter_id", "opponent_id", *asof.STYLE_KEYS, "tags", "status", "cohort", "same", "prior_stat_fights")


_PERFORMANCE = f"""count(*) AS fights, {_RECORD}, count(*) FILTER (WHERE stats_available) AS stat_fights,
    {R6(f"{_rate('bout_significant_strikes_landed', 1)} - {_rate('opponent_bout_significant_strikes_landed', 1)}")} AS sig_strike_differential_per_min,
    {R6(_rate("bout_takedowns_landed", 15))} AS takedowns_per_15_min, {R6(_ratio(*metrics.RATIOS[3][1:]))} AS takedown_defense"""


@query("performance_by_style", f"""{WITH}, {_STYLED}, tagged AS (SELECT fight_id, fighter_id, unnest(string_split(tags, ',')) AS tag FROM styled WHERE tags <> ''),
       got AS (SELECT fighter_id, tag, {_PERFORMANCE}, string_agg(fight_id, ',' ORDER BY fight_id) AS fight_ids FROM persp JOIN tagged USING (fight_id, fighter_id) GROUP BY 1, 2),
       fixed AS (SELECT fighter_id, unnest([{", ".join(f"'{x}'" for x in asof.STYLE_TAGS.values())}]) AS tag FROM (SELECT DISTINCT fighter_id FROM persp))
       SELECT fighter_id, tag, {", ".join(f"coalesce({c}, 0) AS {c}" for c in asof.COUNTS)}, {", ".join(_SHORT)}, coalesce(fight_ids, '') AS fight_ids FROM fixed LEFT JOIN got USING (fighter_id, tag)""")  # fmt: skip
def _by_style(t: Tables) -> DataFrame:
    return rounded(asof.performance_by_style(*_before(t)).withColumn("fight_ids", F.array_join("fight_ids", ",")), *_SHORT)


_THEN = f"SELECT fight_id, fighter_id, {', '.join(f'r_{k} AS x_{k}' for k in asof.STYLE_KEYS)} FROM styled"


@query("similar_contests", f"""{WITH}, known AS (SELECT * FROM persp WHERE event_date < DATE '{CUTOFF}'), {_STYLED.replace("FROM persp", "FROM known")},
       past AS MATERIALIZED ({_THEN}), latest AS (SELECT fighter_id AS key, DATE '{CUTOFF}' AS day, division AS weight_class, timed, {", ".join(asof.STYLE_KEYS)} FROM states WHERE until IS NULL),
       current AS MATERIALIZED (WITH targets AS (SELECT * FROM latest), {_ranks("key")} SELECT key, {", ".join(f"r_{k} AS y_{k}" for k in asof.STYLE_KEYS)} FROM styled),
       asked AS (SELECT DISTINCT fighter_a_id AS fighter_id, fighter_b_id AS next_opponent_id FROM contests),
       pairs AS (SELECT a.*, p.fight_id, {" + ".join(f"(x_{k} IS NOT NULL AND y_{k} IS NOT NULL)::INT" for k in asof.STYLE_KEYS)} AS compared,
                 {" + ".join(f"coalesce(abs(x_{k} - y_{k}), 0)" for k in asof.STYLE_KEYS)} AS gap FROM asked a JOIN current c ON c.key = a.next_opponent_id JOIN past p ON p.fighter_id = a.fighter_id),
       near AS (SELECT *, round(round(1 - gap / compared, 9), 3) AS s FROM pairs WHERE compared >= 3 AND round(1 - gap / compared, 9) >= 0.75),
       top AS (SELECT *, row_number() OVER w AS rank, count(*) OVER (PARTITION BY fighter_id, next_opponent_id) AS comparable FROM near WINDOW w AS (PARTITION BY fighter_id, next_opponent_id ORDER BY s DESC, fight_id))
       SELECT fighter_id, next_opponent_id, rank, comparable, fight_id, compared, s AS similarity FROM top WHERE rank <= 5""")  # fmt: skip
def _similar(t: Tables) -> DataFrame:
    persp = written(metrics.needed(t.persp).filter(F.col("event_date") < CUTOFF))
    state = written(asof.states(persp))
    requests = t.pairs.select(F.col("a_id").alias("fighter_id"), F.col("b_id").alias("next_opponent_id"))
    return asof.similar_contests(requests, asof.opponents_before(persp, state), asof.styles_at(persp, state, CUTOFF)).drop("bout_outcome")


@query("matchup_evidence")
def _evidence(t: Tables) -> DataFrame:
    """Both sides of every pair that met; nested parts as JSON."""
    df = evidence.matchup_evidence(t.persp, t.fighters, t.pairs, CUTOFF)
    scalars_ = ("age", "days_since_last_fight", "win_streak", "current_derived_elo", "average_opponent_prior_elo", "provisional_opponents", "comparable_style_count")
    parts = ("career", "recent", "current_style", "strongest_win_ids", "strongest_loss_ids", "performance_by_tier", "history_by_opponent_style", "similar_to_next_opponent", "bouts")
    return df.select("a_id", "b_id", "side", "fighter_id", "opponent_id", *scalars_, *[F.to_json(c).alias(c) for c in parts])


_BOUT = ("event_date", "opponent_id", "weight_class", "bout_outcome", "method_of_victory", "ending_round")


@query("evidence_paths", f"""{WITH}, known AS (SELECT * FROM persp WHERE event_date < DATE '{CUTOFF}'),
       b AS (UNPIVOT (SELECT fighter_id, fight_id, {", ".join(f"{c}::VARCHAR AS {c}" for c in _BOUT)} FROM known) ON {", ".join(_BOUT)} INTO NAME field VALUE value),
       m AS (SELECT fighter_id, count(*) AS fights, {_RECORD}, max(fighter_sequence) - coalesce(max(fighter_sequence) FILTER (WHERE bout_outcome IS DISTINCT FROM 'win'), 0) AS win_streak,
             DATE '{CUTOFF}' - max(event_date) AS days_since_last_fight FROM known GROUP BY 1),
       c AS (UNPIVOT (SELECT fighter_id, {", ".join(f"{c}::VARCHAR AS {c}" for c in ("fights", "record_win", "record_loss", "win_streak", "days_since_last_fight"))} FROM m)
             ON fights, record_win, record_loss, win_streak, days_since_last_fight INTO NAME field VALUE value),
       paths AS (SELECT fighter_id, 'bouts.' || fight_id || '.' || field AS path, 'bouts' AS section, field, value FROM b
                 UNION ALL SELECT fighter_id, CASE WHEN field IN ('win_streak', 'days_since_last_fight') THEN field ELSE 'career.' || field END,
                 CASE WHEN field IN ('win_streak', 'days_since_last_fight') THEN field ELSE 'career' END, field, value FROM c),
       claims AS (SELECT fighter_id, 'bouts.' || fight_id || '.method_of_victory' AS path, CASE WHEN fight_id % 3 = 0 THEN 'Submission' ELSE method_of_victory END AS claimed FROM persp WHERE fight_id % 5 < 2)
       SELECT p.fighter_id, path, section, field, value, CASE WHEN claimed IS NULL THEN NULL WHEN claimed = value THEN 'supported' ELSE 'contradicted' END AS claim
       FROM paths p LEFT JOIN claims USING (fighter_id, path)""")  # fmt: skip
def _paths_of_evidence(t: Tables) -> DataFrame:
    """Careers and bouts of all entities as stable paths, with the verdict on claims about how a bout ended."""
    persp = written(t.persp.select("fighter_id", "fight_id", "fighter_sequence", *_BOUT))  # read four times, by columns
    known = perspectives.strict_cutoff(persp, CUTOFF)
    records = known.groupBy("fighter_id").agg(
        F.count("*").alias("fights"), *[F.sum(derived.flag(F.col("bout_outcome") == o)).alias(f"record_{o}") for o in ("win", "loss")],
        metrics.streak(), F.datediff(F.lit(CUTOFF).cast("date"), F.max("event_date")).alias("days_since_last_fight"),
    )
    career = F.struct("fights", "record_win", "record_loss").alias("career")
    careers = files.long_evidence(records.select("fighter_id", career, "win_streak", "days_since_last_fight"), ["fighter_id"])
    bouts = lambda *fields: files.element_evidence(known, ["fighter_id"], "bouts", "fight_id", fields).filter("value IS NOT NULL")
    claimed = F.when(F.col("fight_id") % 3 == 0, "Submission").otherwise(F.col("method_of_victory"))
    path = F.concat(F.lit("bouts."), "fight_id", F.lit(".method_of_victory")).alias("path")
    claims = persp.filter("fight_id % 5 < 2").select("fighter_id", path, claimed.alias("value"))
    # all claims are about one field, so only its rows meet them
    judged = coverage.with_verdicts(bouts("method_of_victory"), claims, ["fighter_id"])
    others = bouts(*[c for c in _BOUT if c != "method_of_victory"]).unionByName(careers.filter("value IS NOT NULL"))
    return judged.unionByName(others, allowMissingColumns=True).select("fighter_id", "path", "section", "field", "value", "claim")


@query("safe_features", f"""{WITH} SELECT fight_id, event_id, event_date, weight_class, fighter_id, opponent_id, slot FROM persp""", dates=("event_date",))
def _safe(t: Tables) -> DataFrame:
    return perspectives.safe_features(t.persp)


_ENDED = "'winner_fighter_id', 'method_of_victory', 'stats_available', 'result', 'time_format', 'ending_round', 'ending_time'"


def _counted(table: str, name: str) -> str:
    return f"SELECT '{name}.' || column_name AS column_name, known FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM {table}) ON COLUMNS(*) INTO NAME column_name VALUE known)"


@query("leak_audit", f"""{WITH}, c AS ({_counted("contests", "fights")} UNION ALL {_counted("entities", "fighters")} UNION ALL {_counted("rounds", "fight_rounds")}
       UNION ALL {_counted("(SELECT * EXCLUDE (seconds, clock, fought) FROM persp)", "fighter_bout_history")})
       SELECT column_name, known, column_name LIKE 'fight_rounds.%' OR split_part(column_name, '.', 2) IN ({_ENDED}) OR regexp_matches(column_name, '[.](opponent_)?bout_')
       OR (regexp_matches(column_name, '[.]fighter_[ab]_.*(knockdowns|strikes|takedowns|control|submission_attempts|reversals)')) AS leaks FROM c""")  # fmt: skip
def _leaks(t: Tables) -> DataFrame:
    """Of every column of the tables how many rows know it, and whether it is known only after the contest."""
    found = []
    known = t.persp.drop("name", "opponent_name", "result", "winner_fighter_id")
    for name, df in (("fights", t.contests), ("fighters", t.fighters), ("fight_rounds", t.rounds), ("fighter_bout_history", known)):
        counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
        long = counts.select(F.explode(F.array(*[F.struct(F.lit(f"{name}.{c}").alias("column_name"), F.col(c).alias("known")) for c in df.columns])).alias("x"))
        found.append(long.select("x.*"))
    return perspectives.leak_audit(reduce(DataFrame.unionByName, found))


@query("duration", f"{WITH} SELECT fight_id, {R6('fought / 60.0::DOUBLE')} AS minutes FROM persp WHERE slot = 'a'")
def _duration(t: Tables) -> DataFrame:
    return t.contests.select("fight_id", r6(scalars.duration_minutes(F.col("ending_round"), F.col("ending_time"), F.col("time_format"))).alias("minutes"))


@query("method_group", f"""{WITH} SELECT fight_id, CASE WHEN method_of_victory = 'KO/TKO' THEN 'KO/TKO' WHEN method_of_victory = 'Submission' THEN 'Submission'
       WHEN method_of_victory LIKE 'Decision%' THEN 'Decision' WHEN method_of_victory IN ('DQ', 'Other') THEN method_of_victory END AS method_group, method_of_victory IN ('KO/TKO', 'Submission') AS finish FROM contests""")  # fmt: skip
def _group(t: Tables) -> DataFrame:
    m = F.col("method_of_victory")
    return t.contests.select("fight_id", scalars.method_group(m).alias("method_group"), scalars.is_finish(m).alias("finish"))


@query("parse_of", f"{WITH} SELECT fight_id, fighter_id, bout_takedowns_landed AS landed, bout_takedowns_attempted AS attempted FROM persp WHERE stats_available")
def _of(t: Tables) -> DataFrame:
    text = F.concat_ws(" of ", "bout_takedowns_landed", "bout_takedowns_attempted")
    return t.persp.filter("stats_available").select("fight_id", "fighter_id", scalars.parse_of(text).alias("p")).select("fight_id", "fighter_id", "p.*")


@query("bounded_sql", f"{WITH} SELECT weight_class, count(*) AS n, false AS truncated FROM contests WHERE event_date < DATE '{CUTOFF}' GROUP BY 1")
def _bounded(t: Tables) -> DataFrame:
    known = {"known_fights": t.contests.filter(F.col("event_date") < CUTOFF)}
    return tables.bounded_sql(known, "SELECT weight_class, count(*) AS n FROM known_fights GROUP BY weight_class", 200)


@query("percentile_linear", f"{WITH} SELECT weight_class, {R6('quantile_cont(bout_significant_strikes_landed, 1.0 / 3)')} AS low, {R6('quantile_cont(bout_significant_strikes_landed, 2.0 / 3)')} AS high FROM persp GROUP BY 1")
def _percentile(t: Tables) -> DataFrame:
    rows = t.persp.select("weight_class", "bout_significant_strikes_landed")
    known = asof.quantiles(rows, "bout_significant_strikes_landed", {"low": 1 / 3, "high": 2 / 3}, "weight_class")
    return rounded(known, "low", "high")
