"""History-derived columns: what was known before each contest, and final aggregates.

All of them are windows over an entity's history, so one shuffle by entity serves them all.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..checkpoints import checkpointed
from ..joins import small
from ..functions.scalars import age_on
from ..schema import OUTCOMES, STATS, SUMMED
from .perspectives import HISTORY, perspectives, sequenced, sides


def entity(order: Sequence[str] = HISTORY) -> WindowSpec:
    """An entity's contests in order."""
    return Window.partitionBy("fighter_id").orderBy(*order)


def before(order: Sequence[str] = HISTORY) -> WindowSpec:
    return entity(order).rowsBetween(Window.unboundedPreceding, -1)


def flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def prefight_record(persp: DataFrame, order: Sequence[str] = HISTORY) -> DataFrame:
    """Adds prior_wins, prior_losses, prior_draws: contests before this one, in bout order."""
    for outcome, name in zip(OUTCOMES, ("wins", "losses", "draws")):
        count = F.coalesce(F.sum(flag(F.col("bout_outcome") == outcome)).over(before(order)), F.lit(0))
        persp = persp.withColumn(f"prior_{name}", count)
    return persp


def prefight_streaks(persp: DataFrame, order: Sequence[str] = HISTORY) -> DataFrame:
    """Adds prior_win_streak and prior_loss_streak: a draw ends both, a no-contest (or unknown) changes nothing."""
    ends = {"win": ("loss", "draw"), "loss": ("win", "draw")}
    out = persp
    upto = entity(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    for kind, breaks in ends.items():
        island = F.sum(flag(F.col("bout_outcome").isin(*breaks))).over(upto)
        out = out.withColumn(f"__{kind}", island)
        run = Window.partitionBy("fighter_id", f"__{kind}").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        out = out.withColumn(f"__n_{kind}", F.sum(flag(F.col("bout_outcome") == kind)).over(run))
        out = out.withColumn(f"prior_{kind}_streak", F.coalesce(F.lag(f"__n_{kind}").over(entity(order)), F.lit(0)))
    return out.drop("__win", "__loss", "__n_win", "__n_loss")


def rest_days(persp: DataFrame, order: Sequence[str] = HISTORY) -> DataFrame:
    """Adds rest_days since the contest before, of any outcome; NULL at the debut."""
    return persp.withColumn("rest_days", F.datediff("event_date", F.lag("event_date").over(entity(order))))


def head_to_head(fights: DataFrame) -> DataFrame:
    """(fight_id, head_to_head_fight_count): earlier meetings of the same two entities."""
    return meetings(sequenced(fights)).select("fight_id", "head_to_head_fight_count")


def meetings(seq: DataFrame) -> DataFrame:
    """Adds head_to_head_fight_count to contests that have their event_bout_sequence."""
    low, high = F.least("fighter_a_id", "fighter_b_id"), F.greatest("fighter_a_id", "fighter_b_id")
    met = Window.partitionBy(low, high).orderBy(*HISTORY)
    return seq.withColumn("head_to_head_fight_count", F.row_number().over(met) - 1)


def day_number(day: Column) -> Column:
    return F.datediff(day, F.lit("1970-01-01").cast("date"))


def event_start_record(persp: DataFrame) -> DataFrame:
    """Adds start_wins, start_losses, start_draws, start_no_contests: contests of earlier days only."""
    earlier = Window.partitionBy("fighter_id").orderBy("__day").rangeBetween(Window.unboundedPreceding, -1)
    df = persp.withColumn("__day", day_number(F.col("event_date")))
    for outcome, name in zip(OUTCOMES, ("wins", "losses", "draws", "no_contests")):
        df = df.withColumn(f"start_{name}", F.coalesce(F.sum(flag(F.col("bout_outcome") == outcome)).over(earlier), F.lit(0)))
    return df.drop("__day")


def final_aggregates(persp: DataFrame) -> DataFrame:
    """One row per entity: contests, record, current streaks, sums of five counts and the last date."""
    outcome, order = F.col("bout_outcome"), F.col("fighter_sequence")
    upto = Window.partitionBy("fighter_id").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a streak is what was counted since the last contest that ended it
    df = persp.withColumns({f"__{kind}": F.sum(flag(outcome == kind)).over(upto) for kind in ("win", "loss")})
    at_end = lambda kind, *ends: F.coalesce(F.max(F.when(outcome.isin(*ends), F.col(f"__{kind}"))), F.lit(0))
    streak = lambda kind, *ends: F.sum(flag(outcome == kind)) - at_end(kind, *ends)
    return df.groupBy("fighter_id").agg(
        F.count("*").alias("fights"),
        *[F.sum(flag(outcome == o)).alias(n) for o, n in zip(OUTCOMES, ("wins", "losses", "draws", "no_contests"))],
        streak("win", "loss", "draw").alias("current_win_streak"), streak("loss", "win", "draw").alias("current_loss_streak"),
        *[F.coalesce(F.sum(f"bout_{c}"), F.lit(0)).alias(c) for c in SUMMED], F.max("event_date").alias("last_fight_date"),
    )


def profile_hydration(persp: DataFrame, fighters: DataFrame) -> DataFrame:
    """Fills prefight_age, height, reach and stance from the latest profile; known values stay. ``imputed`` says so."""
    fields = ("height_inches", "reach_inches", "stance")
    profile = fighters.select("fighter_id", "date_of_birth", *[F.col(c).alias(f"__{c}") for c in fields])
    df = persp.join(profile, "fighter_id", "left").withColumn("__age", age_on(F.col("date_of_birth"), F.col("event_date")))
    filled = F.coalesce("prefight_profile_imputed", F.lit(False)) if "prefight_profile_imputed" in persp.columns else F.lit(False)
    out = {}
    for c in ("age", *fields):
        stored = F.col(f"prefight_{c}") if f"prefight_{c}" in persp.columns else F.lit(None)
        filled |= stored.isNull() & F.col(f"__{c}").isNotNull()
        out[f"prefight_{c}"] = F.coalesce(stored, F.col(f"__{c}"))
    return df.withColumns({**out, "prefight_profile_imputed": filled}).drop("date_of_birth", "__age", *[f"__{c}" for c in fields])


def winner_id(fights: DataFrame) -> DataFrame:
    """Adds winner_fighter_id and winner_error from winner_name: exactly one side for a completed contest, else none."""
    a, b = F.col("winner_name") == F.col("fighter_a_name"), F.col("winner_name") == F.col("fighter_b_name")
    done = F.col("result") == "completed"
    one = F.when(done & a & ~b, F.col("fighter_a_id")).when(done & b & ~a, F.col("fighter_b_id"))
    wrong = (done & one.isNull()) | (~done & F.col("winner_name").isNotNull())
    return fights.withColumn("winner_fighter_id", one).withColumn("winner_error", F.coalesce(wrong, F.lit(True)))


def null_stats_without_rounds(fights: DataFrame, rounds: DataFrame) -> DataFrame:
    """Every count of a contest without round rows becomes NULL; stats_available says which have them."""
    have = rounds.select("fight_id").distinct().withColumn("__has", F.lit(True))
    df = fights.join(have, "fight_id", "left").withColumn("stats_available", F.coalesce("__has", F.lit(False)))
    cols = [c for s in "ab" for c in (f"fighter_{s}_{x}" for x in STATS) if c in fights.columns]
    return df.withColumns({c: F.when(F.col("stats_available"), F.col(c)) for c in cols}).drop("__has")


def same_day_conflicts(persp: DataFrame) -> DataFrame:
    """Entities that stand on more than one card of a day."""
    days = persp.groupBy("event_date", "fighter_id").agg(F.count_distinct("event_id").alias("cards"))
    return days.filter("cards > 1")


def card_order_backfill(fights: DataFrame, load_order: str = "ingest_seq", created: str = "created_at") -> DataFrame:
    """Adds ``order`` and ``order_status`` where a card has no complete card_order.

    A card keeps a complete order 1..n. Otherwise the load order counts if it is complete and unique, then unique created
    times, then the id, but only if no entity stands twice on the card; else the status is ``ambiguous``.

    Whether values are unique shows in the last of their ranks, so no row carries its card's values.
    """
    card = Window.partitionBy("event_id")
    n = F.count("*").over(card)
    places = {"__pc": "card_order", "__pl": load_order, "__pt": created}
    whole = lambda p: (F.count(places[p]).over(card) == n) & (F.max(p).over(card) == n)
    complete = whole("__pc") & (F.min("card_order").over(card) == 1) & (F.max("card_order").over(card) == n)
    side = F.explode(F.array("fighter_a_id", "fighter_b_id")).alias("__side")
    sides = fights.select(F.col("event_id").alias("__card"), side).groupBy("__card").agg(
        (F.count("*") > F.count_distinct("__side") + F.max(F.col("__side").isNull().cast("int"))).alias("__r")
    )
    df = fights.withColumns({p: F.dense_rank().over(card.orderBy(c)) for p, c in places.items()} | {"__pf": F.row_number().over(card.orderBy("fight_id"))})
    df = df.withColumns({"__c": complete, "__l": whole("__pl"), "__t": whole("__pt")}).join(sides, F.col("event_id").eqNullSafe(F.col("__card")))
    order = F.when(F.col("__c"), F.col("card_order")).when(F.col("__l"), F.col("__pl")).when(F.col("__t"), F.col("__pt")).when(~F.col("__r"), F.col("__pf"))
    df = df.withColumn("order", order)
    status = F.when(F.col("order").isNull(), "ambiguous").when(F.col("__c"), "kept").otherwise("filled")
    return df.withColumn("order_status", status).drop("__c", "__l", "__t", "__r", "__card", "__pf", *places)


def rebuild_derived(fights: DataFrame, fighters: DataFrame) -> DataFrame:
    """All history-derived columns of every perspective row; rebuilding a rebuilt table changes nothing.

    Meetings are counted before a contest becomes two rows, so contests are read and numbered once.
    """
    persp = prefight_streaks(prefight_record(rest_days(sides(meetings(sequenced(fights))))))
    return profile_hydration(persp, fighters)


#: Stored columns of a side and what a replay calls them.
REPLAYED = {
    "wins": "prior_wins", "losses": "prior_losses", "draws": "prior_draws", "current_win_streak": "prior_win_streak",
    "current_loss_streak": "prior_loss_streak", "days_since_last_fight": "rest_days",
}


#: Columns of a side that a rebuild makes.
SIDE_COLUMNS = (*REPLAYED, "age", "height_inches", "reach_inches", "stance", "profile_imputed")


def replayed(persp: DataFrame, policy: str = "bout-start") -> DataFrame:
    """``persp`` with the columns of REPLAYED: what was known before a contest, in the bouts' order (``bout-start``), in the
    order of loading (``ingestion``, by ``ingest_seq``), or frozen for a whole card (``event-start``)."""
    order = ("ingest_seq",) if policy == "ingestion" else HISTORY
    df = prefight_streaks(prefight_record(rest_days(persp, order), order), order)
    if policy == "event-start":
        card = Window.partitionBy("fighter_id", "event_id").orderBy(*HISTORY)
        df = df.withColumns({c: F.first(c).over(card) for c in REPLAYED.values()})
    return df


def rebuild_tables(events: DataFrame, fights: DataFrame, rounds: DataFrame, fighters: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(fights, fighters, report, errors): all derived columns made anew from the canonical ones.

    Winner ids from names, source urls, availability and nulled counts, card order where it lacks, profiles, what was known
    before each contest, meetings, and the entities' totals. The report has ten counters, one row each. What must not be
    guessed is in errors (key, problem): an order, a winner, an entity on two cards of a day. A rebuilt store stays as it is.
    """
    # what is counted in a contest joins it when its order and its winner are found: no window carries the counts of both sides
    counts = [c for c in (f"fighter_{s}_{x}" for s in "ab" for x in STATS) if c in fights.columns]
    dated = fights.drop("event_date", *counts).join(events.select("event_id", "event_date", F.col("event_url").alias("__url")), "event_id")
    ordered = card_order_backfill(dated.withColumnsRenamed({"winner_fighter_id": "__winner", "stats_available": "__had"}))
    named = winner_id(ordered.withColumn("winner_name", F.when(F.col("result") == "completed", F.col("winner_name"))))
    made = checkpointed(null_stats_without_rounds(named, rounds))
    errors = made.filter("order_status = 'ambiguous'").select(F.col("event_id").cast("string").alias("key"), F.lit("ambiguous order").alias("problem"))
    errors = errors.unionByName(made.filter("winner_error").select(F.col("fight_id").cast("string").alias("key"), F.lit("winner").alias("problem")))
    slim = made.drop("card_order", "source_event_url", *[f"fighter_{s}_{c}" for s in "ab" for c in REPLAYED], "head_to_head_fight_count")
    slim = slim.withColumnsRenamed({"order": "card_order", "__url": "source_event_url"})
    kept = slim.join(fights.select("fight_id", *counts), "fight_id").withColumns({c: F.when(F.col("stats_available"), F.col(c)) for c in counts}) if counts else slim
    known = replayed(perspectives(kept))
    twice = same_day_conflicts(perspectives(slim)).select(F.concat_ws("/", "fighter_id", "event_date").alias("key"), F.lit("two cards on a day").alias("problem"))
    fields = ("age", "height_inches", "reach_inches", "stance")
    full = profile_hydration(known, fighters)
    hydrated = F.sum(sum(flag(F.col(f"prefight_{c}").isNotNull() & (F.col(f"__old_{c}").isNull())) for c in fields))
    stored = {f"__old_{c}": F.col(f"prefight_{c}") if f"prefight_{c}" in known.columns else F.lit(None) for c in fields}
    sides_ = [f"fighter_{s}_{c}" for s in "ab" for c in ("id", *fields) if f"fighter_{s}_{c}" in slim.columns]
    filled = perspectives(slim.select("fight_id", "event_id", "event_date", "card_order", "result", "winner_fighter_id", *sides_))
    filled = profile_hydration(filled.withColumns(stored), fighters)

    def side(s: str) -> Column:
        columns = [F.col(new).alias(f"fighter_{s}_{old}") for old, new in REPLAYED.items()] + [F.col(f"prefight_{c}").alias(f"fighter_{s}_{c}") for c in fields]
        mine = F.struct(*columns, F.col("prefight_profile_imputed").alias(f"fighter_{s}_profile_imputed"))
        return F.first(F.when(F.col("slot") == s, mine), ignorenulls=True).alias(f"__side_{s}")

    wide = kept.drop(*[f"fighter_{s}_{c}" for s in "ab" for c in (*fields, "profile_imputed")])
    both = full.groupBy("fight_id").agg(side("a"), side("b")).select("fight_id", "__side_a.*", "__side_b.*")
    wide = wide.join(both, "fight_id").join(head_to_head(kept), "fight_id")
    totals = final_aggregates(known)
    people = fighters.drop(*[c for c in totals.columns if c != "fighter_id"]).join(totals, "fighter_id", "left")
    people = people.na.fill(0, [c for c in totals.columns if c not in ("fighter_id", "last_fight_date")])
    had = F.col("__winner") if "winner_fighter_id" in fights.columns else F.lit(None)
    url = fights.select("fight_id", F.col("source_event_url").alias("__old")) if "source_event_url" in fights.columns else fights.select("fight_id", F.lit(None).alias("__old"))
    counted = made.join(url, "fight_id").agg(
        F.count("*").alias("fights_processed"), F.count_if(~F.col("stats_available")).alias("fights_without_round_stats"),
        F.count_if(~F.col("winner_fighter_id").eqNullSafe(had)).alias("winner_ids_changed"), F.count_if(~F.col("__url").eqNullSafe(F.col("__old"))).alias("source_event_urls_changed"),
        F.count_if(~F.col("stats_available").eqNullSafe(F.coalesce("__had", F.lit(False)))).alias("stats_availability_changed"), F.count_if(F.col("card_order").isNull()).alias("card_orders_backfilled"),
        F.count_distinct(F.when(F.col("order_status") == "kept", F.col("event_id"))).alias("events_using_card_order"),
        F.count_distinct(F.when(F.col("order_status") == "filled", F.col("event_id"))).alias("events_using_fallback_order"),
    )
    parts = counted, fighters.agg(F.count("*").alias("fighters_rebuilt")), filled.agg(F.coalesce(hydrated, F.lit(0)).alias("profile_fields_hydrated"))
    report = reduce(DataFrame.unionByName, [row.unpivot([], row.columns, "counter", "n") for row in parts])
    return wide.drop("__winner", "__had", "order_status", "winner_error", "__url"), people, report, errors.unionByName(twice).distinct()


def rebuild_report(stored: DataFrame, rebuilt: DataFrame, keys: list[str], fields: list[str]) -> DataFrame:
    """(field, changes): how many rows of ``rebuilt`` differ from ``stored``, null-safe."""
    joined = rebuilt.alias("n").join(stored.alias("o"), keys)
    counts = joined.agg(*[F.sum((~F.col(f"n.{f}").eqNullSafe(F.col(f"o.{f}"))).cast("long")).alias(f) for f in fields])
    return counts.unpivot([], fields, "field", "changes")


def entities_of(fights: DataFrame) -> DataFrame:
    return fights.select(F.explode(F.array("fighter_a_id", "fighter_b_id")).alias("fighter_id")).distinct()


def rebuild_touched(
    events: DataFrame, fights: DataFrame, rounds: DataFrame, fighters: DataFrame, changed: DataFrame, also: DataFrame | None = None
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, DataFrame]:
    """(fights, fighters, report, errors, touched): what :func:`rebuild_tables` gives, for a store whose other rows are rebuilt already.

    ``changed`` (event_id): cards that are new or differ. ``also`` (fighter_id): entities that changed beside these, by a profile or as a side
    that a contest no longer has. What a contest derives rests on its two entities' own histories, so only the entities of
    changed cards are touched: their contests, with the cards these stand on for the bouts' order, are rebuilt as a store of
    their own, and of the result the touched sides are taken. The rest is neither read into a window nor changed. The report counts the
    rebuilt rows; touched are the ids of the contests read.
    """
    cards = small(checkpointed(changed.select("event_id").distinct()))
    touched = entities_of(fights.join(cards, "event_id", "left_semi"))
    touched = checkpointed((touched if also is None else touched.unionByName(also.select("fighter_id"))).distinct())
    mark = lambda s: small(touched.select(F.col("fighter_id").alias(f"fighter_{s}_id"), F.lit(True).alias(f"__{s}")))
    marked = fights.join(mark("a"), "fighter_a_id", "left").join(mark("b"), "fighter_b_id", "left").na.fill(False, ["__a", "__b"])
    near = small(checkpointed(marked.filter("__a OR __b").select("event_id").unionByName(changed.select("event_id")).distinct()))
    part = checkpointed(marked.join(near, "event_id", "left_semi"))
    ids = checkpointed(part.select("fight_id"))
    own = part.select("fight_id", "__a", "__b", *[F.col(f"fighter_{s}_{c}").alias(f"__{s}_{c}") for s in "ab" for c in SIDE_COLUMNS if f"fighter_{s}_{c}" in fights.columns])
    people = fighters.join(small(checkpointed(entities_of(part).unionByName(touched).distinct())), "fighter_id", "left_semi")
    made, totals, report, errors = rebuild_tables(
        events.join(near, "event_id", "left_semi"), part.drop("__a", "__b"), rounds.join(small(ids), "fight_id", "left_semi"), people
    )
    both = made.join(own, "fight_id")
    taken = {f"fighter_{s}_{c}": F.when(F.col(f"__{s}"), F.col(f"fighter_{s}_{c}")).otherwise(F.col(f"__{s}_{c}")) for s in "ab" for c in SIDE_COLUMNS if f"__{s}_{c}" in own.columns}
    merged = both.withColumns(taken).select(*made.columns)
    rest = fights.join(small(ids), "fight_id", "left_anti")
    all_people = fighters.join(small(touched), "fighter_id", "left_anti").unionByName(totals.join(small(touched), "fighter_id", "left_semi"), allowMissingColumns=True)
    return rest.unionByName(merged, allowMissingColumns=True), all_people, report, errors, ids
