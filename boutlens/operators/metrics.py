"""Aggregates over histories: rates, ratios, records, form. One grouped aggregation gives them all."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import age_on, duration_seconds, is_finish
from ..schema import OUTCOMES
from .derived import flag
from .perspectives import strict_cutoff

TREND = ("sig_strikes_landed_per_min", "sig_strikes_absorbed_per_min", "takedowns_per_15_min", "sub_attempts_per_15_min")
# Name, column and minutes of each rate; name, numerator, denominator and defence of each ratio.
RATES = (
    ("sig_strikes_landed_per_min", "bout_significant_strikes_landed", 1),
    ("sig_strikes_absorbed_per_min", "opponent_bout_significant_strikes_landed", 1),
    ("takedowns_per_15_min", "bout_takedowns_landed", 15),
    ("sub_attempts_per_15_min", "bout_submission_attempts", 15),
    ("opponent_sub_attempts_per_15_min", "opponent_bout_submission_attempts", 15),
)
RATIOS = (
    ("striking_accuracy", "bout_significant_strikes_landed", "bout_significant_strikes_attempted", False),
    ("striking_defense", "opponent_bout_significant_strikes_landed", "opponent_bout_significant_strikes_attempted", True),
    ("takedown_accuracy", "bout_takedowns_landed", "bout_takedowns_attempted", False),
    ("takedown_defense", "opponent_bout_takedowns_landed", "opponent_bout_takedowns_attempted", True),
)


def needed(persp: DataFrame) -> DataFrame:
    """The columns of ``persp`` that metrics, styles and ratings are made of."""
    counts = {c for _, c, _ in RATES} | {c for _, *columns, _ in RATIOS for c in columns}
    kept = ("fight_id", "fighter_id", "opponent_id", "event_date", "fighter_sequence", "weight_class", "bout_outcome", "method_of_victory", "stats_available", "ending_round", "ending_time", "time_format")
    return persp.select(*kept, *sorted(counts))


def with_duration(persp: DataFrame) -> DataFrame:
    """Adds ``fought``, in whole seconds: their sums do not depend on the order of the rows."""
    return persp.withColumn("fought", duration_seconds(F.col("ending_round"), F.col("ending_time"), F.col("time_format")))


def rate_sums(column: str, only: Column | None = None) -> tuple[Column, Column]:
    """What a row adds to a rate's numerator and denominator: rows count that have this column and a valid duration (and fit ``only``)."""
    ok = F.col("stats_available") & F.col(column).isNotNull() & F.col("fought").isNotNull()
    ok = ok if only is None else ok & only
    return F.when(ok, F.col(column)), F.when(ok, F.col("fought"))


def rate_of(n: Column, d: Column, per: int) -> Column:
    return F.try_divide(n * F.lit(60.0 * per), d)


def rate(column: str, per: int, only: Column | None = None) -> Column:
    """Per ``per`` minutes over the rows that have counts, this column and a valid duration (and fit ``only``)."""
    return rate_of(*map(F.sum, rate_sums(column, only)), per)


def ratio_sums(numerator: str, denominator: str, only: Column | None = None) -> tuple[Column, Column]:
    ok = F.col("stats_available") & F.col(numerator).isNotNull() & F.col(denominator).isNotNull()
    ok = ok if only is None else ok & only
    return F.when(ok, F.col(numerator)), F.when(ok, F.col(denominator))


def ratio_of(n: Column, d: Column, defense: bool) -> Column:
    value = F.try_divide(n.cast("double"), d)
    return 1 - value if defense else value


def ratio(numerator: str, denominator: str, defense: bool, only: Column | None = None) -> Column:
    return ratio_of(*map(F.sum, ratio_sums(numerator, denominator, only)), defense)


def metric_sums(only: Column | None = None) -> dict[str, Column]:
    """What a row (that fits ``only``) adds to each sum that the metrics are made of."""
    outcome, method = F.col("bout_outcome"), F.col("method_of_victory")
    count = lambda ok: flag(ok if only is None else ok & only)
    found = {"fights": F.lit(1) if only is None else flag(only), **{f"record_{o}": count(outcome == o) for o in OUTCOMES}}
    found |= {"unknown_results": count(outcome.isNull()), "stat_fights": count(F.col("stats_available")),
              "timed_stat_fights": count(F.col("stats_available") & F.col("fought").isNotNull()),
              "finishes": count((outcome == "win") & is_finish(method)), "submission_losses": count((outcome == "loss") & (method == "Submission"))}
    pairs = {**{name: rate_sums(column, only) for name, column, _ in RATES}, **{name: ratio_sums(n, d, only) for name, n, d, _ in RATIOS}}
    return found | {f"{name}__{i}": c for name, pair in pairs.items() for i, c in zip("nd", pair)}


def metric_columns(only: Column | None = None, of: Callable[[str], Column] | None = None) -> list[Column]:
    """All metrics over the rows that fit ``only``, but the counts by method (:func:`method_columns`); ``of``: their sums, if some are at hand."""
    if of is None:
        sums = metric_sums(only)
        of = lambda name: F.sum(sums[name])
    counts = lambda *names: [of(name).alias(name) for name in names]
    return [
        *counts("fights", *[f"record_{o}" for o in OUTCOMES], "unknown_results", "stat_fights", "timed_stat_fights"),
        *[rate_of(of(f"{name}__n"), of(f"{name}__d"), per).alias(name) for name, _, per in RATES],
        *[ratio_of(of(f"{name}__n"), of(f"{name}__d"), defense).alias(name) for name, *_, defense in RATIOS],
        F.try_divide(of("finishes").cast("double"), of("record_win")).alias("finish_rate_among_wins"), *counts("submission_losses"),
    ]


def by_method() -> Column:
    """A row's outcome and method where it counts by method; a NULL method counts as Unknown."""
    return F.when(F.col("bout_outcome").isin("win", "loss"), F.struct("bout_outcome", F.coalesce("method_of_victory", F.lit("Unknown")).alias("method")))


def method_columns(n: Column) -> list[Column]:
    """wins_by_method and losses_by_method as maps, from rows of (by_method, ``n``) that each have another ``by_method``."""
    cell = lambda kind: F.when(F.col("by_method.bout_outcome") == kind, F.struct(F.col("by_method.method").alias("method"), n.alias("n")))
    return [F.map_from_entries(F.array_sort(F.collect_list(cell(kind)))).alias(name) for kind, name in (("win", "wins_by_method"), ("loss", "losses_by_method"))]


def entity_metrics(persp: DataFrame, *keys: str) -> DataFrame:
    """All metrics of each group of rows (default: of each entity).

    Rows are summed by outcome and method first, so a group holds no more than one row for each of its methods.
    """
    keys = keys or ("fighter_id",)
    sums = metric_sums()
    parts = with_duration(persp).withColumn("by_method", by_method()).groupBy(*keys, "by_method").agg(*[F.sum(c).alias(f"__{name}") for name, c in sums.items()])
    return parts.groupBy(*keys).agg(*metric_columns(of=lambda name: F.sum(f"__{name}")), *method_columns(F.col("__fights")))


def performance_columns() -> list[Column]:
    """The short form: contests, record, counted contests, strike differential, takedown rate and defence."""
    landed, absorbed = rate(RATES[0][1], 1), rate(RATES[1][1], 1)
    outcome = F.col("bout_outcome")
    return [
        F.count("*").alias("fights"), *[F.sum(flag(outcome == o)).alias(f"record_{o}") for o in OUTCOMES],
        F.sum(flag(F.col("stats_available"))).alias("stat_fights"),
        (landed - absorbed).alias("sig_strike_differential_per_min"), rate(RATES[2][1], 15).alias("takedowns_per_15_min"),
        ratio(*RATIOS[3][1:]).alias("takedown_defense"),
    ]


def method_histogram(persp: DataFrame) -> DataFrame:
    """(entity, outcome, method, n) of wins and losses; a NULL method counts as Unknown."""
    kept = persp.filter(F.col("bout_outcome").isin("win", "loss"))
    return kept.groupBy("fighter_id", "bout_outcome", F.coalesce("method_of_victory", F.lit("Unknown")).alias("method")).agg(F.count("*").alias("n"))


def method_maps(persp: DataFrame) -> DataFrame:
    """wins_by_method and losses_by_method as maps, one row per entity."""
    counts = method_histogram(persp)
    made = lambda kind: F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("bout_outcome") == kind, F.struct("method", "n")))))
    return counts.groupBy("fighter_id").agg(made("win").alias("wins_by_method"), made("loss").alias("losses_by_method"))


def backwards(persp: DataFrame) -> DataFrame:
    """Adds ``back``: 1 for an entity's last contest, 2 for the one before."""
    return persp.withColumn("back", F.row_number().over(Window.partitionBy("fighter_id").orderBy(F.col("fighter_sequence").desc())))


def trends(n: int) -> list[Column]:
    """Four rates of the last ``n`` contests, and their difference from the career's."""
    if not 3 <= n <= 5:
        raise ValueError("n must be between 3 and 5")
    recent, found = F.col("back") <= n, [F.sum(flag(F.col("back") <= n)).alias("recent_fights")]
    for name, column, per in RATES:
        if name in TREND:
            found += [rate(column, per, recent).alias(f"recent_{name}"), (rate(column, per, recent) - rate(column, per)).alias(f"trend_{name}")]
    return found


def recent_form(persp: DataFrame, n: int = 5) -> DataFrame:
    """Rates of the last ``n`` contests (3 to 5) and their difference from the career's."""
    df = with_duration(backwards(persp)).groupBy("fighter_id").agg(*trends(n))
    return df.withColumnsRenamed({f"recent_{c}": c for c in TREND})


def streak() -> Column:
    """Wins since the last contest of any other outcome; here a draw or no-contest ends the streak."""
    lost = F.coalesce(F.max(F.when(~F.col("bout_outcome").eqNullSafe(F.lit("win")), F.col("fighter_sequence"))), F.lit(0))
    return (F.max("fighter_sequence") - lost).alias("win_streak")


def current_win_streak(persp: DataFrame) -> DataFrame:
    return persp.groupBy("fighter_id").agg(streak())


def career_stats(persp: DataFrame, fighters: DataFrame, cutoff: str, recent_n: int = 5) -> DataFrame:
    """Every entity as of the cutoff: metrics, recent form, streak, rest, age and caveats. Debutants have a row.

    One aggregation: the last contests are numbered, and their sums are conditional.
    """
    day, known = F.lit(cutoff).cast("date"), strict_cutoff(persp, cutoff)
    rest = F.datediff(day, F.max("event_date")).alias("days_since_last_fight")
    got = with_duration(backwards(known)).groupBy("fighter_id").agg(*metric_columns(), *trends(recent_n), streak(), rest)
    got = got.drop(*[f"recent_{c}" for c in TREND])
    df = fighters.select("fighter_id", age_on(F.col("date_of_birth"), day).alias("age")).join(got, "fighter_id", "left")
    n = F.coalesce("fights", F.lit(0))
    caveats = F.array_compact(F.array(F.when(n == 0, "debut"), F.when(n < 3, "thin recent form"), F.when(F.col("age").isNull(), "age unknown")))
    return df.withColumns({"fights": n, "win_streak": F.coalesce("win_streak", F.lit(0)), "caveats": caveats})


def round_totals(rounds: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Sums per (contest, entity); a sum without any value stays NULL."""
    return rounds.groupBy("fight_id", "fighter_id").agg(F.count("*").alias("rounds"), *[F.sum(c).alias(c) for c in columns])
