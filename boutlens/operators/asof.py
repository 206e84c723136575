"""What was known of opponents and rosters at a point in time: quality, percentiles, styles, similar contests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import alone, checkpointed, written
from ..functions.scalars import quality
from ..joins import small
from . import dominance
from .derived import event_start_record, flag
from .metrics import RATES, RATIOS, entity_metrics, performance_columns, with_duration
from .perspectives import strict_cutoff
from .ratings import START

# The metrics of a style, and the tag of each offensive one.
STYLE_KEYS = ("sig_strikes_landed_per_min", "striking_defense", "takedowns_per_15_min", "takedown_defense", "sub_attempts_per_15_min")
STYLE_TAGS = {
    "sig_strikes_landed_per_min": "high-volume striker", "takedowns_per_15_min": "wrestler",
    "sub_attempts_per_15_min": "submission threat",
}

TIERS = ("higher", "middle", "lower", "unknown")


def roster_cutoffs(persp: DataFrame, lower: float, upper: float) -> DataFrame:
    """(event_date, low, high, roster): interpolated percentiles of all entities' quality before each day.

    The population of a day is never listed. A change of an entity moves one unit from its old quality to its new one; the
    running sums of these moves are the histogram of each day, and the percentiles come from its cumulative counts.
    """
    outcome = F.col("bout_outcome")
    day = persp.groupBy("fighter_id", "event_date").agg(*[F.sum(flag(outcome == o)).alias(o) for o in ("win", "loss", "draw")])
    upto = Window.partitionBy("fighter_id").orderBy("event_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    q = quality(*[F.sum(o).over(upto) for o in ("win", "loss", "draw")])
    states = day.withColumn("q", q)
    states = states.withColumn("old", F.lag("q").over(Window.partitionBy("fighter_id").orderBy("event_date")))
    moves = states.select("event_date", F.col("q"), F.lit(1).alias("n")).unionByName(states.select("event_date", F.col("old").alias("q"), F.lit(-1).alias("n")))
    moves = moves.filter("q IS NOT NULL").groupBy("q", "event_date").agg(F.sum("n").alias("n")).filter("n != 0")
    days = persp.select("event_date").distinct().withColumn("i", F.row_number().over(Window.orderBy("event_date")))
    by_q = Window.partitionBy("q").orderBy("i")
    held = moves.join(days, "event_date").withColumn("held", F.sum("n").over(by_q.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    last = days.agg(F.max("i")).first()[0] or 0
    held = held.withColumn("until", F.coalesce(F.lead("i").over(by_q), F.lit(last))).filter("held > 0 AND until > i")
    # a count that holds after day i is the population of the days up to its next change
    hist = held.select("q", "held", F.explode(F.sequence(F.col("i") + 1, F.col("until"))).alias("i"))
    per_day = Window.partitionBy("i").orderBy("q").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    hist = hist.withColumn("upto", F.sum("held").over(per_day)).withColumn("n", F.sum("held").over(Window.partitionBy("i")))

    def at(f: float) -> Column:
        place = (F.col("n") - 1) * F.lit(f)
        low = F.min(F.when(F.col("upto") > F.floor(place), F.col("q")))
        high = F.min(F.when(F.col("upto") > F.ceil(place), F.col("q")))
        return low + (high - low) * (F.max(place) - F.floor(F.max(place)))

    cuts = hist.groupBy("i").agg(at(lower).alias("low"), at(upper).alias("high"), F.max("n").alias("roster"))
    return days.join(cuts, "i", "left").select("event_date", "low", "high", F.coalesce("roster", F.lit(0)).alias("roster"))


def opponent_quality(persp: DataFrame, lower: float = 1 / 3, upper: float = 2 / 3) -> DataFrame:
    """For each perspective row: the opponent's record and quality of earlier days, and its tier in that day's roster."""
    if not 0 < lower < upper < 1:
        raise ValueError("tiers need 0 < lower < upper < 1")
    start = event_start_record(persp)
    q = quality(F.col("start_wins"), F.col("start_losses"), F.col("start_draws"))
    opponent = start.select("fight_id", F.col("fighter_id").alias("opponent_id"), "start_wins", "start_losses", "start_draws", q.alias("quality"))
    rows = persp.select("fight_id", "fighter_id", "opponent_id", "event_date", "bout_outcome").join(opponent, ["fight_id", "opponent_id"])
    df = rows.join(roster_cutoffs(persp, lower, upper), "event_date")
    tier = (
        F.when(F.col("quality").isNull(), "unknown").when(F.col("low") == F.col("high"), "mid")
        .when(F.col("quality") > F.col("high"), "top").when(F.col("quality") < F.col("low"), "low").otherwise("mid")
    )
    return df.withColumn("tier", tier).drop("low", "high")


def opposition_summary(rated: DataFrame) -> DataFrame:
    """Per entity: average quality, contests of unknown quality, the best win and the record by tier."""
    win = (F.col("bout_outcome") == "win") & F.col("quality").isNotNull()
    best = F.max(F.when(win, F.struct("quality", "event_date", (-F.col("fight_id")).alias("first"))))
    cells = [F.sum(flag((F.col("tier") == t) & (F.col("bout_outcome") == o))).alias(f"{t}_{o}") for t in ("top", "mid", "low", "unknown") for o in ("win", "loss")]
    return rated.groupBy("fighter_id").agg(
        F.avg("quality").alias("average_quality"), F.sum(flag(F.col("quality").isNull())).alias("unknown_quality"), (-best["first"]).alias("best_win"), *cells
    )


#: Distinct values up to which one window for each group places them.
VALUES = 1_000_000


def placed_values(df: DataFrame, value: str, keys: Sequence[str], values: int = VALUES) -> DataFrame:
    """(keys, value, same, less, known): how many rows of ``keys`` have the value, a smaller one, and any; nulls are left out.

    Rows are counted by value first, so a group takes no more than its distinct values. Where these are many, the running count
    goes over ranges of the values' order, and no task holds more than a range or one row for each range.
    """
    counts = checkpointed(df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("same")))
    whole = Window.partitionBy(*keys)
    if counts.count() <= values:
        before = whole.orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
        return counts.withColumns({"less": F.coalesce(F.sum("same").over(before), F.lit(0)), "known": F.sum("same").over(whole)})
    ranged = checkpointed(counts.repartitionByRange(*[F.col(k) for k in keys], F.col(value)).withColumn("__range", F.spark_partition_id()))
    totals = ranged.groupBy(*keys, "__range").agg(F.sum("same").alias("__sum"))
    before = whole.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    names = [f"__k{i}" for i in range(len(keys))]
    bases = totals.select(
        *[F.col(k).alias(n) for k, n in zip(keys, names)], F.col("__range").alias("__at"), F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"),
        F.sum("__sum").over(whole).alias("known"),
    )
    within = Window.partitionBy(*keys, "__range").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    met = reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, names)], F.col("__range") == F.col("__at"))
    placed = ranged.withColumn("__less", F.coalesce(F.sum("same").over(within), F.lit(0))).join(small(bases), met)
    return placed.select(*keys, value, "same", (F.col("__base") + F.col("__less")).alias("less"), "known")


def midrank(df: DataFrame, value: str, name: str, *keys: str, values: int = VALUES) -> DataFrame:
    """Adds the midrank of ``value`` among the rows (of ``keys``) that have one."""
    placed = placed_values(df, value, keys, values)
    rank = (F.col("less") + 0.5 * F.col("same")) / F.col("known")
    return df.join(placed.select(*keys, value, rank.alias(name)), [*keys, value], "left").select(*df.columns, name)


def quantiles(df: DataFrame, value: str, fractions: dict[str, float], *keys: str, values: int = VALUES) -> DataFrame:
    """(keys, a column for each of ``fractions``): exact quantiles of ``value``, between two ranks by linear interpolation.

    The ranks wanted are looked up among the counted values; no group is ever held as a list. Groups without values are left out.
    """
    placed = placed_values(df, value, keys, values)

    def at(f: float) -> Column:
        place = (F.col("known") - 1) * F.lit(f)
        holds = lambda rank: (F.col("less") <= rank) & (rank < F.col("less") + F.col("same"))
        low, high = (F.max(F.when(holds(r), F.col(value))) for r in (F.floor(place), F.ceil(place)))
        return low + (high - low) * F.max(place - F.floor(place))

    return placed.groupBy(*keys).agg(*[at(f).alias(n) for n, f in fractions.items()])


def style_midranks(persp: DataFrame, cutoff: str) -> DataFrame:
    """Midranks of the five style metrics over the whole roster of a cutoff."""
    return midranks_of(style_stats(persp, cutoff))


def style_stats(persp: DataFrame, cutoff: str) -> DataFrame:
    """(fighter_id, the style metrics, submission_losses) before a cutoff, made once: a row for each entity, read several times."""
    return checkpointed(entity_metrics(strict_cutoff(persp, cutoff)).select("fighter_id", *STYLE_KEYS, "submission_losses"))


def midranks_of(stats: DataFrame) -> DataFrame:
    """(fighter_id, metric, value, rank) of :func:`style_stats`."""
    # metrics as rows: each is ranked in a partition of its own
    long = stats.select("fighter_id", *STYLE_KEYS).unpivot(["fighter_id"], list(STYLE_KEYS), "metric", "value")
    return midrank(long, "value", "rank", "metric")


def style_matchup(pairs: DataFrame, persp: DataFrame, cutoff: str, high: float = 0.75) -> DataFrame:
    """Pairs (a_id, b_id) with both sides' tags and each offence against the other's defence."""
    if not 0.5 < high < 1:
        raise ValueError("high must be between 0.5 and 1")
    stats = style_stats(persp, cutoff)
    ranks = midranks_of(stats).groupBy("fighter_id").pivot("metric", list(STYLE_KEYS)).agg(F.first("rank"))
    df = stats.join(ranks.select("fighter_id", *[F.col(k).alias(f"rank_{k}") for k in STYLE_KEYS]), "fighter_id")
    tags = [F.when((F.col(f"rank_{k}") >= high) & (F.col(k) > 0), t) for k, t in STYLE_TAGS.items()]
    round_ = None
    for k in STYLE_TAGS:
        one = (F.col(f"rank_{k}") >= 0.5) & (F.col(k) > 0)
        round_ = one if round_ is None else round_ & one
    keep = ("tags", "takedowns_per_15_min", "takedown_defense", "sig_strikes_landed_per_min", "striking_defense", "sub_attempts_per_15_min", "submission_losses")
    df = checkpointed(df.withColumn("tags", F.array_compact(F.array(*tags, F.when(round_, "well-rounded")))).select("fighter_id", *keep))  # read by both sides
    side = lambda s: df.select(F.col("fighter_id").alias(f"{s}_id"), *[F.col(c).alias(f"{s}_{c}") for c in keep])
    return pairs.select("a_id", "b_id").distinct().join(side("a"), "a_id", "left").join(side("b"), "b_id", "left")


def style_parts() -> dict[str, tuple[Column, Column, float, bool]]:
    """Per style metric: what a row adds to its numerator and denominator, its factor, and whether it is a defence."""
    found = {}
    for name, column, per in RATES:
        ok = F.col("stats_available") & F.col(column).isNotNull() & F.col("fought").isNotNull()
        found[name] = F.when(ok, F.col(column)), F.when(ok, F.col("fought")), 60.0 * per, False
    for name, numerator, denominator, defense in RATIOS:
        ok = F.col("stats_available") & F.col(numerator).isNotNull() & F.col(denominator).isNotNull()
        found[name] = F.when(ok, F.col(numerator)), F.when(ok, F.col(denominator)), 1.0, defense
    return {k: found[k] for k in STYLE_KEYS}


def states(persp: DataFrame, history: DataFrame | None = None) -> DataFrame:
    """(fighter_id, event_date, following, division, decided, timed, the style metrics, and rating if a rating history is given): every
    entity after each of its days, with its next day."""
    parts = style_parts()
    sums = [F.sum(x).alias(f"{k}__{i}") for k, (n, d, *_) in parts.items() for i, x in (("n", n), ("d", d))]
    daily = with_duration(persp).groupBy("fighter_id", "event_date").agg(
        *sums, F.sum(flag(F.col("bout_outcome").isin("win", "loss", "draw"))).alias("decided"),
        F.sum(flag(F.col("stats_available") & F.col("fought").isNotNull())).alias("timed"), F.max_by("weight_class", "fighter_sequence").alias("division"),
    )
    if history is not None:
        daily = daily.join(history.groupBy("fighter_id", "event_date").agg(F.sum("change").alias("change")), ["fighter_id", "event_date"])
    upto = Window.partitionBy("fighter_id").orderBy("event_date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = lambda c: F.sum(c).over(upto)

    def value(k: str, factor: float, defense: bool) -> Column:
        x = F.try_divide(run(f"{k}__n") * F.lit(factor), run(f"{k}__d"))
        return (1 - x if defense else x).alias(k)

    rating = [(F.lit(START) + run("change")).alias("rating")] if history is not None else []
    metrics_ = [value(k, factor, defense) for k, (_, _, factor, defense) in parts.items()]
    following = F.lead("event_date").over(Window.partitionBy("fighter_id").orderBy("event_date")).alias("following")
    return daily.select("fighter_id", "event_date", following, "division", run("decided").alias("decided"), run("timed").alias("timed"), *metrics_, *rating)


def before_day(state: DataFrame) -> DataFrame:
    """``state`` with its columns as of before each day: those of the entity's earlier day; days without one are left out."""
    return state.filter("following IS NOT NULL").drop("event_date").withColumnRenamed("following", "event_date")


def ranked_before(targets: DataFrame, held: DataFrame, measures: dict[str, Column], at_least: int = 8) -> DataFrame:
    """``targets`` (key, day, weight_class, and a column of each measure) with the midranks of the measures among their cohort.

    The cohort are the entities whose state of ``held`` (event_date, until, division, measures) holds on the day and whose last contest
    was in the weight class, if there are ``at_least`` of them, else all. ``measures``: which states count for each measure. Adds a
    column ``rank_<measure>`` and ``size_<measure>``, cohort (how many) and same (whether of the weight class).

    No cohort is ever listed, see :mod:`dominance`: the cohort of the weight class comes first, and the wider one only serves the rows
    that need it.
    """
    names = list(measures)
    counted = held.select("fighter_id", "event_date", "until", F.col("division").alias("weight_class"), *[F.when(ok, F.col(c)).alias(c) for c, ok in measures.items()])

    def placed() -> DataFrame:
        rows = written(targets)  # read four times
        own = written(dominance.counts_holding(counted, rows, ["weight_class"], names))
        return rows.join(own, "key", "left").withColumn("same", F.coalesce(F.col("members") >= at_least, F.lit(False)))

    asked = alone(placed)
    few = asked.filter("NOT same").select("key", "day", *names)
    wide = dominance.counts_holding(counted, few, [], names)
    kept = wide.columns[1:]
    df = asked.join(wide.withColumnsRenamed({c: f"__{c}" for c in kept}), "key", "left")
    df = df.withColumns({c: F.coalesce(F.when(F.col("same"), F.col(c)).otherwise(F.col(f"__{c}")), F.lit(0)) for c in kept}).drop(*[f"__{c}" for c in kept])
    rank = lambda m: F.when(F.col(m).isNotNull(), F.try_divide(F.col(f"below_{m}") + 0.5 * F.col(f"equal_{m}"), F.col(f"size_{m}")))
    df = df.withColumns({f"rank_{m}": rank(m) for m in names}).withColumnRenamed("members", "cohort")
    return df.drop(*[f"{c}_{m}" for m in names for c in ("below", "equal")])


def with_style(ranked: DataFrame) -> DataFrame:
    """``ranked`` (the style metrics, their ranks, timed) with percentiles under the metrics' names, the number of cohort members that
    count for each (``cohort_sizes``), tags and status."""
    reliable = F.coalesce(F.col("timed") >= 3, F.lit(False))
    ranks = {k: F.when(reliable, F.col(f"rank_{k}")) for k in STYLE_KEYS}
    tags = [F.when((ranks[k] >= 0.75) & (F.col(k) > 0), tag) for k, tag in STYLE_TAGS.items()]
    known = F.coalesce(*ranks.values()).isNotNull()
    status = F.when(reliable & known, "measured proxy").otherwise("insufficient history")
    df = ranked.withColumns({"tags": F.array_compact(F.array(*tags)), "status": status, "prior_stat_fights": F.coalesce("timed", F.lit(0))})
    sizes = F.struct(*[F.coalesce(f"size_{k}", F.lit(0)).alias(k) for k in STYLE_KEYS])
    drop = [f"{c}_{k}" for k in STYLE_KEYS for c in ("rank", "size")]
    return df.withColumns(ranks | {"cohort_sizes": sizes}).drop(*drop, "timed")


def style_measures() -> dict[str, Column]:
    return {k: F.col("timed") >= 3 for k in STYLE_KEYS}


def opponents_before(persp: DataFrame, state: DataFrame, active_days: int = 1096, at_least: int = 8) -> DataFrame:
    """For each perspective row what its opponent was before the day: record counts, style, and rating with its tier if
    ``state`` has ratings.

    The style: percentiles, tags and status among the cohort of the day and the contest's weight class. The tier: thirds of the
    ratings of those with three decided contests; unknown below three of the opponent's own.
    """
    rated = "rating" in state.columns
    held = dominance.lasting(state, active_days)
    prior = before_day(state).withColumnsRenamed({"fighter_id": "opponent_id", "event_date": "day"}).drop("division")
    rows = persp.select("fight_id", "fighter_id", "opponent_id", F.col("event_date").alias("day"), "weight_class", "bout_outcome")
    rows = rows.select(F.struct("fight_id", "fighter_id").alias("key"), *rows.columns[2:])
    targets = rows.join(prior, ["opponent_id", "day"], "left")
    measures = style_measures()
    if rated:
        targets = targets.withColumn("rating", F.coalesce("rating", F.lit(START)))
        measures["rating"] = F.col("decided") >= 3
    df = with_style(ranked_before(targets, held, measures, at_least)).withColumn("decided", F.coalesce("decided", F.lit(0)))
    if rated:
        rank = F.when(F.col("decided") >= 3, F.col("rank_rating"))
        tier = F.when(rank.isNull(), "unknown").when(rank > 2 / 3, "higher").when(rank < 1 / 3, "lower").otherwise("middle")
        df = df.withColumns({"strength": rank, "tier": tier, "strength_cohort_size": F.coalesce("size_rating", F.lit(0))}).drop("rank_rating", "size_rating")
    return df.select("key.*", "*").drop("key").withColumnsRenamed({"day": "event_date", "decided": "opponent_decided"})


def styles_at(persp: DataFrame, state: DataFrame, day: str, active_days: int = 1096, at_least: int = 8) -> DataFrame:
    """(fighter_id, percentiles, tags, status, prior_stat_fights, cohort): every entity's style before a day, ranked in the
    division of its last contest."""
    known = strict_cutoff(state, day)
    held = dominance.lasting(known, active_days)
    now = known.filter(F.col("following").isNull() | (F.col("following") >= F.lit(day).cast("date"))).drop("following", "event_date", "rating")
    targets = now.withColumn("day", F.lit(day).cast("date")).withColumnRenamed("division", "weight_class").withColumn("key", F.col("fighter_id"))
    return with_style(ranked_before(targets, held, style_measures(), at_least)).drop("key", "day", "weight_class", "decided")


COUNTS = ["fights", "record_win", "record_loss", "record_draw", "record_no_contest", "stat_fights"]


def performance_by(persp: DataFrame, groups: DataFrame, group: str, names: Sequence[str]) -> DataFrame:
    """Short-form performance of each entity over its contests of each group, with their ids; groups never met have zeros.

    groups: fight_id, fighter_id and the column ``group``; a contest can be in several.
    """
    rows = with_duration(persp).join(groups.select("fight_id", "fighter_id", group), ["fight_id", "fighter_id"])
    ids = F.array_sort(F.collect_set("fight_id")).alias("fight_ids")
    got = rows.groupBy("fighter_id", group).agg(*performance_columns(), ids)
    fixed = persp.select("fighter_id").distinct().withColumn(group, F.explode(F.array(*[F.lit(n) for n in names])))
    full = fixed.join(got, ["fighter_id", group], "left").na.fill(0, COUNTS)
    return full.withColumn("fight_ids", F.coalesce("fight_ids", F.array().cast(got.schema["fight_ids"].dataType)))


def performance_by_style(persp: DataFrame, before: DataFrame) -> DataFrame:
    """Against opponents of each style tag they had before the contest; ``before`` as :func:`opponents_before` gives it."""
    tags = before.select("fight_id", "fighter_id", F.explode("tags").alias("tag"))
    return performance_by(persp, tags, "tag", tuple(STYLE_TAGS.values()))


def performance_by_tier(persp: DataFrame, before: DataFrame) -> DataFrame:
    """Against opponents of each tier they had before the contest."""
    return performance_by(persp, before, "tier", TIERS)


def similar_contests(requests: DataFrame, styled: DataFrame, current: DataFrame, k: int = 5, least: float = 0.75, also: Sequence[str] = ()) -> DataFrame:
    """For each request (fighter_id, next_opponent_id): the past contests whose opponents were most like the next one.

    styled: perspective rows with the opponent's percentiles before the day, of which ``also`` names more columns to return. current:
    fighter_id and percentiles now. Similarity is 1 less the mean absolute difference of percentiles, over three shared metrics or more.
    """
    then = F.array(*[F.col(c) for c in STYLE_KEYS])
    past = styled.select("fighter_id", "fight_id", "bout_outcome", *also, then.alias("then"))
    now = current.select(F.col("fighter_id").alias("next_opponent_id"), F.array(*[F.col(c) for c in STYLE_KEYS]).alias("now"))
    df = requests.select("fighter_id", "next_opponent_id").distinct().join(now, "next_opponent_id").join(past, "fighter_id")
    gaps = F.array_compact(F.zip_with("then", "now", lambda x, y: F.abs(x - y)))
    df = df.withColumn("gaps", gaps).filter(F.size("gaps") >= 3)
    mean = F.aggregate("gaps", F.lit(0.0), lambda acc, x: acc + x) / F.size("gaps")
    # nine digits first, so that sums of another order round alike
    df = df.withColumn("similarity", F.round(1 - mean, 9)).filter(F.col("similarity") >= least).withColumn("similarity", F.round("similarity", 3))
    # no array goes through the sort
    df = df.select("fighter_id", "next_opponent_id", "fight_id", "bout_outcome", *also, F.size("gaps").alias("compared"), "similarity")
    request = Window.partitionBy("fighter_id", "next_opponent_id")
    order = request.orderBy(F.col("similarity").desc(), "fight_id")
    ranked = df.withColumns({"rank": F.row_number().over(order), "comparable": F.count("*").over(request)}).filter(F.col("rank") <= k)
    return ranked.select("fighter_id", "next_opponent_id", "rank", "comparable", "fight_id", "bout_outcome", "compared", "similarity", *also)
