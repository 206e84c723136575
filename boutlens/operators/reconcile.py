"""Merging new source data into canonical tables: joins that say which value wins, and reject tables that say why not."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge(stored: DataFrame, incoming: DataFrame, keys: Sequence[str], keep_known: Sequence[str] = (), also: Column | None = None) -> DataFrame:
    """Full outer merge: incoming rows replace stored ones, but in ``keep_known`` a NULL never erases a known value.

    Columns that only one side has are NULL for the other's rows. ``also`` filters the stored rows that nothing replaces.
    """
    cols = [*stored.columns, *(c for c in incoming.columns if c not in stored.columns)]
    new = incoming.select(*keys, F.struct(*[c for c in incoming.columns if c not in keys]).alias("__n"), F.lit(True).alias("__in"))
    old = stored.select(*keys, F.struct(*[c for c in stored.columns if c not in keys]).alias("__o"))
    both = old.join(new, list(keys), "full").withColumn("__in", F.coalesce("__in", F.lit(False)))
    if also is not None:
        both = both.filter(F.col("__in") | also)

    def value(c: str) -> Column:
        if c not in incoming.columns:
            return F.col(f"__o.{c}")
        if c not in stored.columns:
            return F.col(f"__n.{c}")
        replaced = F.coalesce(F.col(f"__n.{c}"), F.col(f"__o.{c}")) if c in keep_known else F.col(f"__n.{c}")
        return F.when(F.col("__in"), replaced).otherwise(F.col(f"__o.{c}"))

    return both.select(*[F.col(c) if c in keys else value(c).alias(c) for c in cols])


def upsert_cards(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """By id, else by url: an incoming card with a known url takes the stored id."""
    known = stored.filter("event_url IS NOT NULL").groupBy("event_url").agg(F.min("event_id").alias("__id"))
    ids = stored.select("event_id", F.lit(True).alias("__same"))
    new = incoming.join(ids, "event_id", "left").join(known, "event_url", "left")
    new = new.withColumn("event_id", F.when(F.col("__same"), F.col("event_id")).otherwise(F.coalesce("__id", "event_id"))).drop("__id", "__same")
    return merge(stored, new.select(*incoming.columns), ["event_id"])


def upsert_contests(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """All fields are replaced, but a NULL never erases a physical field of either side."""
    physical = [f"fighter_{s}_{c}" for s in "ab" for c in ("age", "height_inches", "reach_inches", "stance")]
    return merge(stored, incoming, ["fight_id"], keep_known=physical)


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def upsert_rounds(stored: DataFrame, incoming: DataFrame, complete: DataFrame) -> DataFrame:
    """By (contest, round, entity). Stored rounds that did not come again go only for contests in ``complete`` (fight_id)."""
    keys = ["fight_id", "round_number", "fighter_id"]
    whole = complete.select("fight_id").distinct().withColumn("__whole", F.lit(True))
    old = stored.join(whole, "fight_id", "left")
    merged = merge(old, incoming, keys, also=F.col("__o.__whole").isNull())
    return merged.drop("__whole")


def round_payload_complete(rounds: DataFrame, contests: DataFrame) -> DataFrame:
    """(fight_id, complete): the numbers are 1 .. ending_round, and each round has both sides once."""
    per = rounds.groupBy("fight_id").agg(F.array_sort(F.collect_set("round_number")).alias("numbers"), F.count("*").alias("n"), F.count_distinct("round_number", "fighter_id").alias("distinct"))
    df = contests.select("fight_id", "ending_round").join(per, "fight_id", "left")
    fits = F.col("numbers") == F.sequence(F.lit(1), F.greatest("ending_round", F.lit(1)))
    whole = fits & (F.col("n") == 2 * F.col("ending_round")) & (F.col("distinct") == F.col("n"))
    return df.select("fight_id", F.coalesce(whole, F.lit(False)).alias("complete"))


def stats_authority(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """(fight_id, accepted, reason). stored: fight_id, has_complete; incoming: fight_id, status, structurally_complete.

    Partial data is rejected; complete data must be complete in structure; complete data is never replaced by less.
    """
    df = incoming.join(stored.select("fight_id", "has_complete"), "fight_id", "left")
    reason = (
        F.when(F.col("status") == "partial", "partial source data")
        .when((F.col("status") == "complete") & ~F.col("structurally_complete"), "incomplete rounds")
        .when((F.col("status") != "complete") & F.coalesce("has_complete", F.lit(False)), "would lose complete data")
    )
    return df.select("fight_id", reason.isNull().alias("accepted"), reason.alias("reason"))


def identity_guard(stored: DataFrame, incoming: DataFrame) -> DataFrame:
    """Contests whose stored and incoming sides or urls disagree, or lack a side, with the reason."""
    old = stored.select("fight_id", *[F.col(c).alias(f"__{c}") for c in ("fighter_a_id", "fighter_b_id", "source_fight_url")])
    df = incoming.join(old, "fight_id")
    sides = ~F.coalesce((F.col("fighter_a_id") == F.col("__fighter_a_id")) & (F.col("fighter_b_id") == F.col("__fighter_b_id")), F.lit(False))
    url = F.col("source_fight_url").isNotNull() & F.col("__source_fight_url").isNotNull() & (F.col("source_fight_url") != F.col("__source_fight_url"))
    return df.select("fight_id", F.when(sides, "participants changed").when(url, "url changed").alias("reason")).filter("reason IS NOT NULL")


def profile_identity(profiles: DataFrame) -> DataFrame:
    """(fighter_id, reason) of profiles whose identity is not the same in four places: the id asked for, the id of the page's
    url, the id of the url asked for, and the id in the payload.

    profiles: fighter_id, requested_url, profile_url, payload_id.
    """
    last = lambda c: F.element_at(F.split(F.regexp_replace(F.split(c, r"[?#]")[0], "/+$", ""), "/"), -1)
    reason = F.lit(None).cast("string")
    for name, value in (("payload", F.col("payload_id")), ("page url", last("profile_url")), ("requested url", last("requested_url"))):
        reason = F.coalesce(reason, F.when(~value.cast("string").eqNullSafe(F.col("fighter_id").cast("string")), F.lit(name)))
    return profiles.select("fighter_id", reason.alias("reason")).filter("reason IS NOT NULL")


def upsert_profiles(stored: DataFrame, incoming: DataFrame, now: str) -> DataFrame:
    """Blanks never erase known values; merged rows carry the time."""
    text = [f.name for f in incoming.schema.fields if f.dataType.simpleString() == "string" and f.name != "fighter_id"]
    filled = incoming.withColumns({c: F.nullif(F.trim(c), F.lit("")) for c in text}).withColumn("profile_scraped_at", F.lit(now).cast("timestamp"))
    return merge(stored, filled, ["fighter_id"], keep_known=[c for c in incoming.columns if c != "fighter_id"])


def profile_refresh_due(fighters: DataFrame, now: str, max_age_days: int = 90) -> DataFrame:
    """Never read, or read ``max_age_days`` days ago or longer."""
    old = F.col("profile_scraped_at") <= F.lit(now).cast("timestamp") - F.make_interval(days=F.lit(max_age_days))
    return fighters.filter(F.col("profile_scraped_at").isNull() | old)


def stale_contests(stored: DataFrame, source: DataFrame) -> DataFrame:
    """Stored contests of the cards in ``source`` (event_id, fight_id) that their card no longer lists."""
    cards = source.select("event_id").distinct()
    return stored.join(cards, "event_id", "left_semi").join(source.select("event_id", "fight_id"), ["event_id", "fight_id"], "left_anti")


def without_stale(stored: DataFrame, rounds: DataFrame, source: DataFrame, allowed: bool) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(contests, rounds, refused): stale contests and their rounds go if that is ``allowed``; else they stay and are refused."""
    stale = stale_contests(stored, source).select("fight_id", "event_id")
    if not allowed:
        return stored, rounds, stale
    return stored.join(stale.select("fight_id"), "fight_id", "left_anti"), rounds.join(stale.select("fight_id"), "fight_id", "left_anti"), stale.limit(0)


def atomic_cards(incoming: DataFrame, rejected: DataFrame) -> DataFrame:
    """Incoming contests of the cards without any rejected contest (fight_id)."""
    bad = incoming.join(rejected.select("fight_id").distinct(), "fight_id", "left_semi").select("event_id").distinct()
    return incoming.join(bad, "event_id", "left_anti")


def summary_merge(payload: DataFrame, summaries: DataFrame, fields: Sequence[str] = ("weight_class", "card_order", "event_method_code", "method_of_victory")) -> DataFrame:
    """Fills only missing fields of contest payloads from card rows, by id, else by url."""
    by_id = summaries.select(F.col("fight_id"), *[F.col(f).alias(f"__i_{f}") for f in fields])
    by_url = summaries.filter("source_fight_url IS NOT NULL").select("source_fight_url", *[F.col(f).alias(f"__u_{f}") for f in fields]).dropDuplicates(["source_fight_url"])
    df = payload.join(by_id, "fight_id", "left").join(by_url, "source_fight_url", "left")
    blank = lambda f: F.when(F.trim(F.col(f).cast("string")) != "", F.col(f))
    return df.withColumns({f: F.coalesce(blank(f), F.col(f"__i_{f}"), F.col(f"__u_{f}")) for f in fields}).select(*payload.columns)


def backfill_card_metadata(stored: DataFrame, card_rows: DataFrame) -> DataFrame:
    """Order, division and method from card rows, for cards whose ids agree exactly; others stay."""
    have = stored.groupBy("event_id").agg(F.array_sort(F.collect_set("fight_id")).alias("have"))
    want = card_rows.groupBy("event_id").agg(F.array_sort(F.collect_set("fight_id")).alias("want"))
    cards = have.join(want, "event_id").filter("have = want").select("event_id")
    rows = card_rows.join(cards, "event_id", "left_semi").select("fight_id", *[F.col(c).alias(f"__{c}") for c in ("card_order", "weight_class", "method_of_victory")])
    df = stored.join(rows, "fight_id", "left")
    return df.withColumns({c: F.coalesce(f"__{c}", c) for c in ("card_order", "weight_class", "method_of_victory")}).select(*stored.columns)


def schedule_problems(card: DataFrame, pairings: DataFrame, today: str) -> DataFrame:
    """Why a next card cannot replace the stored one: past date, wrong count, incomplete order, an entity twice."""
    checks = card.join(
        pairings.groupBy("event_id").agg(F.count("*").alias("n"), F.count_distinct("card_order").alias("orders"), F.max("card_order").alias("top")), "event_id", "left"
    )
    twice = pairings.select("event_id", F.explode(F.array("fighter_a_id", "fighter_b_id")).alias("f")).groupBy("event_id", "f").agg(F.count("*").alias("n")).filter("n > 1")
    bad = twice.select("event_id").distinct().withColumn("__twice", F.lit(True))
    df = checks.join(bad, "event_id", "left")
    issues = F.array_compact(F.array(
        F.when(F.col("event_date") < F.lit(today).cast("date"), "past"), F.when(F.coalesce("n", F.lit(0)) != F.col("source_fight_count"), "count"),
        F.when((F.col("orders") != F.col("n")) | (F.col("top") != F.col("n")), "order"), F.when(F.col("__twice"), "entity twice"),
    ))
    return df.select("event_id", issues.alias("issues"))


def replace_schedule(stored: DataFrame, card: DataFrame, pairings: DataFrame, today: str) -> DataFrame:
    """The pairings of the new card if it has no problem, else the stored ones; an empty card clears the schedule."""
    # the card is one row: whether it is flawed is asked once, and one side is returned as it is
    flawed = schedule_problems(card, pairings, today).filter(F.size("issues") > 0).limit(1).count()
    return (stored if flawed else pairings).select(*stored.columns)


def refresh_targets(listing: DataFrame, stored: DataFrame, n: int = 8) -> DataFrame:
    """Cards to read: those missing from ``stored`` and the newest ``n`` of the listing; each once, oldest first (``turn``)."""
    newest = listing.orderBy(F.col("event_date").desc(), "event_url").limit(n)
    missing = listing.join(stored.select("event_url"), "event_url", "left_anti")
    both = missing.select("event_url", "event_date").unionByName(newest.select("event_url", "event_date")).distinct()
    return both.withColumn("turn", F.row_number().over(Window.orderBy("event_date", "event_url")))


def needs_metadata(fights: DataFrame, events: DataFrame, limit: int | None = None) -> DataFrame:
    """Cards with a contest that lacks method, division or order, newest first."""
    bad = fights.filter("method_of_victory IS NULL OR weight_class IS NULL OR card_order IS NULL")
    found = events.join(bad, "event_id", "left_semi").orderBy(F.col("event_date").desc(), "event_id")
    return found if limit is None else found.limit(limit)


def needs_profile(fighters: DataFrame, limit: int | None = None) -> DataFrame:
    found = fighters.filter("profile_url IS NOT NULL AND profile_scraped_at IS NULL").orderBy("fighter_id")
    return found if limit is None else found.limit(limit)


def next_card(schedule: DataFrame, completed: DataFrame, today: str) -> DataFrame:
    """The earliest scheduled card from today on that is not among the completed ones."""
    open_ = schedule.filter(F.col("event_date") >= F.lit(today).cast("date")).join(completed.select("event_url"), "event_url", "left_anti")
    return open_.orderBy("event_date", "event_url").limit(1)


def manifest_diff(source: DataFrame, stored: DataFrame) -> DataFrame:
    """Per card: contests the source lists and the store lacks (missing), and the reverse (extra)."""
    s = source.groupBy("event_id").agg(F.collect_set("fight_id").alias("s"))
    t = stored.groupBy("event_id").agg(F.collect_set("fight_id").alias("t"))
    none = F.array().cast(s.schema["s"].dataType)
    df = s.join(t, "event_id", "full")
    missing = F.size(F.array_except(F.coalesce("s", none), F.coalesce("t", none)))
    extra = F.size(F.array_except(F.coalesce("t", none), F.coalesce("s", none)))
    return df.select("event_id", missing.alias("missing"), extra.alias("extra"), F.col("t").isNull().alias("card_missing"), F.col("s").isNull().alias("card_extra"))


def contest_records(payloads: DataFrame) -> DataFrame:
    """Nested source payloads as wide contest rows: each side's counts and its map of strike splits become columns.

    payloads: fight_id, event_id, fighter_a_id, ..., winner_name, result, ..., fighter_a_stats and fighter_b_stats (structs of
    counts and ``significant_strike_splits`` map<string, struct<landed, attempted>>).
    """
    from ..schema import PARTS, STATS

    cols = {}
    for s in "ab":
        for c in STATS:
            part = next((p for p in PARTS if c.startswith(f"significant_{p}_")), None)
            if part is None:
                cols[f"fighter_{s}_{c}"] = F.col(f"fighter_{s}_stats.{c}")
            else:
                cols[f"fighter_{s}_{c}"] = F.try_element_at(F.col(f"fighter_{s}_stats.significant_strike_splits"), F.lit(part)).getField(c.rsplit("_", 1)[1])
    a, b = F.col("winner_name") == F.col("fighter_a_name"), F.col("winner_name") == F.col("fighter_b_name")
    winner = F.when(F.col("result") == "completed", F.when(a & ~b, F.col("fighter_a_id")).when(b & ~a, F.col("fighter_b_id")))
    return payloads.withColumns({**cols, "winner_fighter_id": winner}).drop("fighter_a_stats", "fighter_b_stats", "rounds")


def no_regression(live: DataFrame, candidate: DataFrame, key: str) -> DataFrame:
    """(lost, added): keys of the live table that the candidate lacks, and new ones."""
    both = live.select(key).distinct().withColumn("l", F.lit(1)).join(candidate.select(key).distinct().withColumn("c", F.lit(1)), key, "full")
    return both.agg(F.count_if(F.col("c").isNull()).alias("lost"), F.count_if(F.col("l").isNull()).alias("added"))
