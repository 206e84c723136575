"""Cards to forecast: what is left of them, what is deferred, which contests are left out, what each forecast starts from."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a published forecast must have passed, by the way it was evaluated.
CHECKS = ("schema", "matchup_identity", "scheduled_distance", "historical_references", "cutoff_isolation")
#: Columns of a contest that text analysis may see: no prices, no shares.
PUBLIC = ("fight_id", "event_id", "event_name", "event_date", "fighter_a_name", "fighter_b_name", "weight_class", "aliases")


def played(result: Column, method: Column) -> Column:
    blank = lambda c: c.isNull() | (F.trim(c) == "")
    return ~blank(result) | ~blank(method)


def remaining_contests(rows: DataFrame) -> DataFrame:
    """``rows`` (event_id, fight_id, position, result, method_of_victory, matchup_link) with ``state``: completed, remaining, or
    unclear: neither a result nor a link to the matchup. An id that stands twice on a card is unclear too."""
    twice = rows.groupBy("event_id", "fight_id").agg(F.count("*").alias("__n"))
    done = played(F.col("result"), F.col("method_of_victory"))
    state = F.when(F.col("__n") > 1, "unclear").when(done, "completed").when(F.coalesce("matchup_link", F.lit(False)), "remaining").otherwise("unclear")
    return rows.join(twice, ["event_id", "fight_id"]).withColumn("state", state).drop("__n")


def deferred_cards(listing: DataFrame, rows: DataFrame, today: str) -> DataFrame:
    """``listing`` (event_id, event_date) with ``status``: take, deferred (a card from today on with contests to come), or
    error (a card of the future that is listed as completed)."""
    open_ = remaining_contests(rows).groupBy("event_id").agg(F.max(F.col("state") == "remaining").alias("__open"))
    day = F.lit(today).cast("date")
    status = F.when(F.col("event_date") < day, "take").when(F.coalesce("__open", F.lit(False)), "deferred").when(F.col("event_date") > day, "error").otherwise("take")
    return listing.join(open_, "event_id", "left").withColumn("status", status).drop("__open")


def exclude_contests(contests: DataFrame, requests: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(contests kept, requests with matches): each request, an id or the whole name of a side, must match one contest.

    A request that matches none or several excludes nothing, and its ``matches`` says so.
    """
    norm = lambda c: F.lower(F.trim(F.col(c).cast("string")))
    names = contests.select("fight_id", F.explode(F.array_distinct(F.array(norm("fight_id"), norm("fighter_a_name"), norm("fighter_b_name")))).alias("key"))
    asked = requests.select("request").distinct().withColumn("key", norm("request")).join(names, "key", "left")
    counted = asked.groupBy("request").agg(F.count("fight_id").alias("matches"), F.min("fight_id").alias("fight_id"))
    return contests.join(counted.filter("matches = 1"), "fight_id", "left_anti"), counted


def still_remaining(pairings: DataFrame, fresh: DataFrame) -> DataFrame:
    """``pairings`` with ``still``: whether a fresh snapshot has the contest with the same two sides."""
    keys = ["fight_id", "fighter_a_id", "fighter_b_id"]
    found = fresh.select(*keys).distinct().withColumn("still", F.lit(True))
    return pairings.join(found, keys, "left").withColumn("still", F.coalesce("still", F.lit(False)))


def card_features(card: DataFrame, pairings: DataFrame, today: str, now: str, max_age_hours: int = 48) -> DataFrame:
    """The pairings of complete cards, with the distance and what it rests on, and the card's caveats.

    card: event_id, event_date, source_fight_count, last_scraped_at. pairings: event_id, card_order, scheduled_rounds,
    is_title_bout, ... A card with another number of pairings than its source gives none.
    """
    counts = pairings.groupBy("event_id").agg(F.count("*").alias("__n"))
    age = (F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("last_scraped_at")) / 3600
    caveats = F.array_compact(F.array(F.when(age > max_age_hours, "stale schedule"), F.when(F.col("event_date") == F.lit(today).cast("date"), "card is today")))
    whole = card.join(counts, "event_id").filter("__n = source_fight_count").select("event_id", "event_date", caveats.alias("caveats"))
    known, long = F.col("scheduled_rounds"), (F.col("card_order") == 1) | F.coalesce("is_title_bout", F.lit(False))
    basis = F.when(known.isNotNull(), "source").when(long, "assumed main event or title distance").otherwise("assumed standard distance")
    rounds = F.coalesce(known, F.when(long, 5).otherwise(3))
    return pairings.join(whole, "event_id").withColumns({"scheduled_rounds": rounds, "rounds_basis": basis})


def published_gate(forecasts: DataFrame, checks: Sequence[str] = CHECKS) -> DataFrame:
    """``forecasts`` (error, mode, review_status, checks: map of name to outcome) with ``published``: a failure stands as such,
    a forecast must have passed every check of a deterministic evaluation, or every check of an approved review."""
    passed = F.forall(F.array(*map(F.lit, checks)), lambda c: F.coalesce(F.try_element_at("checks", c), F.lit(False)))
    every = (F.size("checks") > 0) & F.forall(F.map_values("checks"), lambda x: F.coalesce(x, F.lit(False)))
    ok = F.when(F.col("mode") == "deterministic", (F.col("review_status") == "validated") & passed).otherwise((F.col("review_status") == "approved") & every)
    return forecasts.withColumn("published", F.col("error").isNotNull() | F.coalesce(ok, F.lit(False)))


def public_projection(df: DataFrame, allowed: Sequence[str] = PUBLIC) -> DataFrame:
    """The columns that may be passed on; all others are private."""
    return df.select(*[c for c in df.columns if c in allowed])


def replay_cohort(forecasts: DataFrame, fighters: DataFrame) -> DataFrame:
    """A frozen worklist of a report's pairings: names, ids and distance, no picks and no outcomes; ``problem`` where a name
    has not exactly one id, or the distance is not recorded."""
    ids = fighters.groupBy("fighter_name").agg(F.count("*").alias("n"), F.min("fighter_id").alias("id"))
    side = lambda s: ids.select(F.col("fighter_name").alias(f"fighter_{s}"), F.col("n").alias(f"__{s}"), F.col("id").alias(f"fighter_{s}_id"))
    df = forecasts.join(side("a"), "fighter_a", "left").join(side("b"), "fighter_b", "left")
    one = (F.coalesce("__a", F.lit(0)) == 1) & (F.coalesce("__b", F.lit(0)) == 1)
    problem = F.when(~one, "ambiguous identity").when(~F.coalesce(F.col("scheduled_rounds").isin(3, 5), F.lit(False)), "distance not recorded")
    keep = [c for c in ("run_id", "fight_id") if c in forecasts.columns]
    return df.select(*keep, "fighter_a", "fighter_b", "fighter_a_id", "fighter_b_id", "scheduled_rounds", problem.alias("problem"))


def identity_sets(urls: DataFrame, summaries: DataFrame) -> DataFrame:
    """(event_id, problem): cards whose urls and summaries are not one-to-one: a url or id twice, or one that only one has.

    urls: event_id, fight_url, fight_id. summaries: event_id, fight_url, fight_id.
    """

    keys = ["event_id", "fight_url", "fight_id"]
    side = lambda df, card: df.select(*keys, F.lit(card).alias("card"), F.lit(1 - card).alias("summary"))
    # each side is read once; an entry is counted on both, then its url and its id on their card
    entries = side(urls, 1).unionByName(side(summaries, 0)).groupBy(*keys).agg(F.sum("card").alias("card"), F.sum("summary").alias("summary"))
    alone = F.col("event_id").isNull() | F.col("fight_url").isNull() | F.col("fight_id").isNull()
    lone = lambda mine, other: (F.col(mine) > 0) & ((F.col(other) == 0) | alone)
    names = F.array(*[F.struct(F.lit(i).alias("kind"), F.col(c).cast("string").alias("name")) for i, c in enumerate(keys[1:])])
    long = entries.select("event_id", F.explode(names).alias("x"), "card", "summary", lone("card", "summary").alias("lacks"), lone("summary", "card").alias("extra"))
    per = long.groupBy("event_id", "x").agg(F.sum("card").alias("card"), F.sum("summary").alias("summary"), F.max("lacks").alias("lacks"), F.max("extra").alias("extra"))
    twice = lambda c: F.max((F.col(c) > 1) | ((F.col(c) > 0) & F.col("x.name").isNull()))
    cards = per.groupBy("event_id").agg(twice("card").alias("card"), twice("summary").alias("summary"), F.max("lacks").alias("lacks"), F.max("extra").alias("extra"))
    problems = {"card": "card repeats a url or an id", "summary": "summary repeats a url or an id", "lacks": "summary missing", "extra": "summary without url"}
    found = F.array_compact(F.array(*[F.when(F.col(c), p) for c, p in problems.items()]))
    return cards.select("event_id", F.explode(found).alias("problem"))
