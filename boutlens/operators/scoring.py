"""Grading saved forecasts, comparing runs, and comparing with market and public shares."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import checkpointed
from ..functions.scalars import implied_probability, method_group
from .derived import flag


def single_spaced(c: Column) -> Column:
    """Runs of white space as one blank each; texts that have only single blanks meet no regular expression."""
    other = reduce(Column.__or__, [c.contains(x) for x in ("  ", *"\t\n\x0b\f\r")])
    return F.when(other, F.regexp_replace(c, r"\s+", " ")).otherwise(c)


def unordered(a: Column, b: Column) -> Column:
    """A key of two names that does not depend on their order, their case or their white space."""
    x, y = (F.lower(F.trim(single_spaced(c))) for c in (a, b))
    return F.concat_ws("|", F.least(x, y), F.greatest(x, y))


def least_of(df: DataFrame, value: str, *keys: str) -> DataFrame:
    """The row of the least ``value`` for each of ``keys``, with the number of rows (``n``).

    Few keys have several rows, so rows are sorted once, after the shuffle; an aggregation that holds texts sorts before it too.
    """
    group = Window.partitionBy(*keys)
    numbered = df.withColumns({"__before": F.lag(F.lit(True)).over(group.orderBy(value)), "n": F.count("*").over(group)})
    return numbered.filter("__before IS NULL").drop("__before")


def score_rows(forecasts: DataFrame, results: DataFrame) -> DataFrame:
    """One row per forecast with status RIGHT, WRONG, UNSCORED, PENDING, UNMATCHED, FAILED or CONFLICT, and graded parts.

    forecasts: run_id, fighter_a, fighter_b, predicted_winner, win_probability, predicted_method, predicted_round, fight_id,
    error, and event_date where runs span several cards. results: fight_id, fighter_a_name, fighter_b_name, winner_name,
    result, method_of_victory, ending_round, and event_date likewise. A forecast with an id that is known takes that contest;
    else it takes that of its unordered pair (and date). What must be reconciled by hand is a conflict: an id whose sides
    changed, a pair whose id changed, a pair with several contests and no id. Parts without a known method or round, or a
    method outside the groups, stay ungraded.
    """
    dated = ["event_date"] if "event_date" in forecasts.columns and "event_date" in results.columns else []
    pair = unordered(F.col("fighter_a_name"), F.col("fighter_b_name"))
    fields = ("winner_name", "result", "method_of_victory", "ending_round")
    known = results.select(pair.alias("pair"), *dated, F.struct(F.col("fight_id").alias("id"), *fields).alias("actual"))
    by_id = least_of(known.select(F.col("actual.id").alias("fight_id"), F.struct("pair", "actual").alias("own")), "own", "fight_id").drop("n")
    by_pair = least_of(known.withColumnRenamed("actual", "met"), "met", "pair", *dated).withColumnRenamed("n", "meetings")
    left = forecasts.withColumn("pair", unordered(F.col("fighter_a"), F.col("fighter_b")))
    df = left.join(by_id, "fight_id", "left").join(by_pair, ["pair", *dated], "left")
    named, own, met = F.col("fight_id").isNotNull(), F.col("own").isNotNull(), F.col("met").isNotNull()
    conflict = (
        F.when(named & own & (F.col("own.pair") != F.col("pair")), "participants changed").when(named & ~own & met, "contest id changed")
        .when(~named & (F.col("meetings") > 1), "several contests of the pair")
    )
    df = df.withColumns({"conflict": conflict, "actual": F.when(conflict.isNull(), F.coalesce("own.actual", "met"))})
    result, winner_name = F.col("actual.result"), F.col("actual.winner_name")
    right_winner = F.lower(F.trim("predicted_winner")) == F.lower(F.trim(winner_name))
    status = (
        F.when(F.col("error").isNotNull(), "FAILED").when(F.col("conflict").isNotNull(), "CONFLICT").when(F.col("actual").isNull(), "UNMATCHED")
        .when(result.isin("draw", "no_contest"), "UNSCORED").when((result == "pending") | blank(winner_name), "PENDING")
        .when(right_winner, "RIGHT").otherwise("WRONG")
    )
    df = df.withColumn("status", status)
    scored = F.col("status").isin("RIGHT", "WRONG")
    winner = F.when(scored, F.col("status") == "RIGHT")
    method = F.when(scored, method_group(F.col("predicted_method")) == method_group(F.col("actual.method_of_victory")))
    round_ = F.when(scored, F.col("predicted_round") == F.col("actual.ending_round"))
    exact = F.when(method.isNotNull() & round_.isNotNull(), winner & method & round_)
    p = F.when(winner, F.col("win_probability")).otherwise(1 - F.col("win_probability"))
    graded = {"winner_correct": winner, "method_correct": method, "round_correct": round_, "exact_correct": exact}
    df = df.withColumns({**graded, "brier": F.when(scored, F.pow(1 - p, 2)), "result_id": F.col("actual.id")})
    return df.select("*", *[F.col(f"actual.{c}").alias(c) for c in fields if c not in df.columns]).drop("own", "met", "meetings", "actual")


def blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def report_problems(reports: DataFrame, cards: DataFrame) -> DataFrame:
    """(run_id, problem) of runs that may not be scored: another card's, another date's, or a cutoff after the card.

    reports: run_id, event_url, event_date, cutoff. cards: event_url, event_date, one row for each card with results.
    """
    df = reports.join(cards.select("event_url", F.col("event_date").alias("held")), "event_url", "left")
    problem = (
        F.when(F.col("held").isNull(), "another card").when(F.col("event_date") != F.col("held"), "another date")
        .when(F.col("cutoff").isNull(), "no cutoff").when(F.col("cutoff") > F.col("held"), "cutoff after the card")
    )
    return df.select("run_id", problem.alias("problem")).filter("problem IS NOT NULL")


def score_summary(scored: DataFrame) -> DataFrame:
    """Per run: attempted, published, failed and unscored; correct, scored and accuracy of each part; the Brier score."""
    cols = [
        F.count("*").alias("attempted"), F.sum(flag(F.col("status") != "FAILED")).alias("published"),
        F.sum(flag(F.col("status") == "FAILED")).alias("failed"),
        F.sum(flag(F.col("winner_correct").isNull())).alias("unscored"),
    ]
    for part in ("winner", "method", "round", "exact"):
        c = F.col(f"{part}_correct")
        cols += [F.sum(flag(c)).alias(f"{part}_correct"), F.count(c).alias(f"{part}_scored"), F.avg(c.cast("int")).alias(f"{part}_accuracy")]
    return scored.groupBy("run_id").agg(*cols, F.avg("brier").alias("brier"))


def paired_runs(scored: DataFrame) -> DataFrame:
    """For every two runs, over the contests both have scored: right winners and Brier scores of each, and who was right alone."""
    known = scored.filter(F.col("winner_correct").isNotNull()).select("run_id", "pair", "result_id", "winner_correct", "brier")
    other = known.select(F.col("run_id").alias("other"), "pair", "result_id", F.col("winner_correct").alias("other_correct"), F.col("brier").alias("other_brier"))
    both = known.join(other, ["pair", "result_id"]).filter(F.col("run_id") < F.col("other"))
    mine, theirs = F.col("winner_correct"), F.col("other_correct")
    return both.groupBy("run_id", "other").agg(
        F.count("*").alias("contests"), F.sum(flag(mine)).alias("correct"), F.sum(flag(theirs)).alias("other_correct"),
        F.sum(flag(mine & ~theirs)).alias("only_first"), F.sum(flag(~mine & theirs)).alias("only_second"),
        F.avg("brier").alias("brier"), F.avg("other_brier").alias("other_brier"),
    )


def matched_runs(scored: DataFrame, first: str, second: str) -> DataFrame:
    """Contests that both runs have, and that both scored, or that the second withheld after review: one row each."""
    side = lambda run, name: scored.filter(F.col("run_id") == run).select("pair", *[F.col(c).alias(f"{name}_{c}") for c in ("status", "error", "winner_correct", "brier")])
    both = side(first, "first").join(side(second, "second"), "pair").filter("first_winner_correct IS NOT NULL")
    withheld = F.col("second_error").isNotNull() & (failure_category(F.col("second_error")) == "review withheld")
    return both.withColumn("withheld", withheld).filter("second_winner_correct IS NOT NULL OR withheld")


def run_matrix(scored: DataFrame) -> DataFrame:
    """(pair, picks): per contest what every run said and how that came out, in the order of runs."""
    said = F.struct("run_id", F.coalesce("predicted_winner", F.lit("WITHHELD")).alias("pick"), "status")
    return scored.groupBy("pair").agg(F.array_sort(F.collect_list(said)).alias("picks"))


def assess_variants(scored: DataFrame, costs: DataFrame, baseline: str, **policy) -> DataFrame:
    """Each run (variant) against the baseline: its summary over all contests, over those both scored, and whether it stays.

    ``costs``: run_id, cost. Paired figures are those of :func:`paired_runs`, seen from the baseline.
    """
    summary = score_summary(scored).join(costs, "run_id", "left")
    pairs = paired_runs(scored)
    own = pairs.filter(F.col("run_id") == baseline).select(F.col("other").alias("run_id"), F.col("contests").alias("shared"), (F.col("other_correct") - F.col("correct")).alias("more_right"), (F.col("other_brier") - F.col("brier")).alias("brier_change"))
    turned = pairs.filter(F.col("other") == baseline).select("run_id", F.col("contests").alias("shared"), (F.col("correct") - F.col("other_correct")).alias("more_right"), (F.col("brier") - F.col("other_brier")).alias("brier_change"))
    kept = retention_policy(summary, baseline, **policy)
    return summary.join(own.unionByName(turned), "run_id", "left").join(kept, "run_id", "left")


def retention_policy(summary: DataFrame, baseline: str, min_coverage: float = 1.0, more_winners: int = 2, max_cost: float = 2.0) -> DataFrame:
    """Each run against the baseline: is it worth its cost? ``summary`` has run_id, attempted, published, winner_correct,
    winner_scored, brier and cost. It is kept, for it is read on both sides of a join."""
    summary = checkpointed(summary.select("run_id", "attempted", "published", "winner_correct", "winner_scored", "brier", "cost"))
    base = summary.filter(F.col("run_id") == baseline).select(*[F.col(c).alias(f"b_{c}") for c in ("winner_correct", "winner_scored", "brier", "cost")], F.lit(1).alias("__one"))
    df = summary.filter(F.col("run_id") != baseline).withColumn("__one", F.lit(1)).join(base, "__one")  # the baseline is one row
    parts = {
        "coverage_ok": F.col("published") >= min_coverage * F.col("attempted"), "same_scored": F.col("winner_scored") == F.col("b_winner_scored"),
        "winners_ok": F.col("winner_correct") >= F.col("b_winner_correct") + more_winners, "brier_ok": F.col("brier") < F.col("b_brier"),
        "cost_ok": F.coalesce(F.col("cost") <= max_cost * F.col("b_cost"), F.lit(False)),
    }
    df = df.withColumns(parts)
    keep = F.lit(True)
    for name in parts:
        keep &= F.col(name)
    return df.select("run_id", *parts, keep.alias("retain"))


def failure_reasons(forecasts: DataFrame) -> DataFrame:
    return forecasts.filter("error IS NOT NULL").groupBy("run_id", F.trim(F.substring_index("error", ":", 1)).alias("reason")).agg(F.count("*").alias("n"))


def failure_category(error: Column) -> Column:
    text = F.lower(error)
    return (
        F.when(error.isNull(), "published").when(text.rlike("quota|billing|insufficient|credit"), "billing")
        .when(text.rlike("timeout|interrupt|connection"), "interrupted").when(text.contains("review"), "review withheld").otherwise("other")
    )


def failure_categories(forecasts: DataFrame) -> DataFrame:
    return forecasts.groupBy("run_id", failure_category(F.col("error")).alias("category")).agg(F.count("*").alias("n"))


def usage_rollup(usage: DataFrame, *keys: str) -> DataFrame:
    """Requests, the known part of the cost, and the cost itself, which is NULL unless every row is complete."""
    complete = F.every(F.coalesce("usage_complete", F.lit(False)) & F.col("estimated_usd").isNotNull())
    known = F.coalesce(F.sum("estimated_usd"), F.lit(0.0))
    return usage.groupBy(*keys).agg(F.sum("request_count").alias("request_count"), known.alias("known_usd"), F.when(complete, known).alias("estimated_usd"))


def weighted_picks(signals: DataFrame, *keys: str) -> DataFrame:
    """``signals`` (keys, source_id, pick, weight): each source with exactly one distinct pick adds its weight.

    Returns a row per pick with votes, weight and share, and the number of sources left out.
    """
    source = signals.groupBy(*keys, "source_id").agg(F.collect_set("pick").alias("picks"), F.max("weight").alias("weight"))
    vote = source.withColumn("pick", F.when(F.size("picks") == 1, F.col("picks")[0]))
    total = vote.groupBy(*keys).agg(F.sum(F.when(F.col("pick").isNotNull(), F.col("weight"))).alias("total"), F.sum(flag(F.col("pick").isNull())).alias("excluded"))
    per = vote.filter("pick IS NOT NULL").groupBy(*keys, "pick").agg(F.count("*").alias("votes"), F.sum("weight").alias("weight"))
    return per.join(total, list(keys)).withColumn("share", F.try_divide("weight", "total"))


def market_compare(forecasts: DataFrame, market: DataFrame) -> DataFrame:
    """Forecasts beside the market's probability without margin and the public share; the forecast stays as it is.

    market: fighter_a, fighter_b, event_date, line_a, line_b, share_a, share_b, observed_at. An observation counts if it is
    the only one of its pair and day, was seen before the day, has two valid prices, and shares that add up to 100.
    """
    pa, pb = implied_probability(F.col("line_a")), implied_probability(F.col("line_b"))
    seen = market.filter(F.col("observed_at") < F.col("event_date").cast("timestamp"))
    ok = seen.filter(pa.isNotNull() & pb.isNotNull() & (F.abs(F.col("share_a") + F.col("share_b") - 100) < 1e-9))
    key = unordered(F.col("fighter_a"), F.col("fighter_b"))
    # sides are told apart by name, whatever order the forecast has
    ok = ok.select(key.alias("pair"), "event_date", F.lower(F.trim("fighter_a")).alias("first"), (pa / (pa + pb)).alias("first_market"), (F.col("share_a") / 100).alias("first_share"))
    one = ok.withColumn("n", F.count("*").over(Window.partitionBy("pair", "event_date"))).filter("n = 1")
    df = forecasts.withColumn("pair", key).join(one, ["pair", "event_date"])
    mine = F.lower(F.trim("predicted_winner")) == F.col("first")
    market_p = F.when(mine, F.col("first_market")).otherwise(1 - F.col("first_market"))
    public_p = F.when(mine, F.col("first_share")).otherwise(1 - F.col("first_share"))
    p = F.col("win_probability")
    return df.withColumns({
        "market_probability": market_p, "public_share": public_p, "model_minus_market": p - market_p, "model_minus_public": p - public_p,
        "overlooked": (p > market_p) & (p > public_p),
    }).drop("n", "first", "first_market", "first_share")
