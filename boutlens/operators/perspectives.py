"""From one row for each contest to one for each (contest, entity)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import PREFIGHT, SAFE_FEATURES, STATS

#: The total order of an entity's contests: earlier cards first, and on a card the main event last.
HISTORY = ("event_date", "event_bout_sequence", "event_id", "fight_id")
SIDE = ("name", "age", "height_inches", "reach_inches", "stance", "profile_imputed", *PREFIGHT)


def outcome_case(result: Column, winner: Column, me: Column, other: Column) -> Column:
    """win, loss, draw, no_contest, or NULL if the record does not say."""
    kind = F.lower(F.trim(result))
    return (
        F.when(kind == "draw", "draw")
        .when(kind.isin("no_contest", "no contest", "nc"), "no_contest")
        .when((kind == "completed") & (winner == me), "win")
        .when((kind == "completed") & (winner == other), "loss")
    )


def perspectives(fights: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """Both sides of every contest, with sequences; ``fights`` is read once. Columns that are missing are left out."""
    return sides(sequenced(fights if events is None else fights.join(events.select("event_id", "event_date"), "event_id")))


def sequenced(fights: DataFrame) -> DataFrame:
    """Adds event_bout_sequence, the place of a contest on its card: the main event is last."""
    order = Window.partitionBy("event_id").orderBy(F.col("card_order").desc_nulls_last(), "fight_id")
    return fights.withColumn("event_bout_sequence", F.row_number().over(order))


def sides(df: DataFrame) -> DataFrame:
    """Both sides of every contest of :func:`sequenced`, with the sequence of each entity."""
    has = set(df.columns)

    # each column is chosen by itself, not within a struct of all: what is not asked for is not shuffled
    is_a = F.col("slot") == "a"
    of = lambda a, b: F.when(is_a, a).otherwise(b)
    cols = []
    for prefix, me, other in (("", "a", "b"), ("opponent_", "b", "a")):
        mine = lambda c, me=me, other=other: of(F.col(f"fighter_{me}_{c}"), F.col(f"fighter_{other}_{c}"))
        cols.append(mine("id").alias("opponent_id" if prefix else "fighter_id"))
        cols += [mine(c).alias(f"{prefix}name" if c == "name" else f"{prefix}prefight_{c}") for c in SIDE if {f"fighter_a_{c}", f"fighter_b_{c}"} <= has]
        cols += [mine(c).alias(f"{prefix}bout_{c}") for c in STATS if {f"fighter_a_{c}", f"fighter_b_{c}"} <= has]
    a, b = F.col("fighter_a_id"), F.col("fighter_b_id")
    outcome = of(outcome_case(F.col("result"), F.col("winner_fighter_id"), a, b), outcome_case(F.col("result"), F.col("winner_fighter_id"), b, a))
    shared = [c for c in df.columns if not c.startswith(("fighter_a_", "fighter_b_"))]
    both = df.withColumn("slot", F.explode(F.array(F.lit("a"), F.lit("b")))).select(*shared, "slot", *cols, outcome.alias("bout_outcome"))
    sequence = Window.partitionBy("fighter_id").orderBy(*HISTORY)
    return both.withColumn("fighter_sequence", F.row_number().over(sequence))


def strict_cutoff(df: DataFrame, cutoff: str) -> DataFrame:
    """Rows of days before the cutoff; the whole day itself is excluded."""
    return df.filter(F.col("event_date") < F.lit(cutoff).cast("date"))


def history_of(persp: DataFrame, ids: DataFrame) -> DataFrame:
    """The full history of the entities in ``ids`` (fighter_id)."""
    return persp.join(ids.select("fighter_id").distinct(), "fighter_id", "left_semi")


def resolve_entity(requests: DataFrame, fighters: DataFrame) -> DataFrame:
    """``requests`` (request) with fighter_id and status: an exact id wins, else one entity of that name, else none."""
    by_id = requests.join(fighters.select(F.col("fighter_id").cast("string").alias("request"), F.col("fighter_id").alias("by_id")), "request", "left")
    names = fighters.groupBy(F.lower(F.trim("fighter_name")).alias("key")).agg(F.count("*").alias("n"), F.min("fighter_id").alias("by_name"))
    found = by_id.withColumn("key", F.lower(F.trim("request"))).join(names, "key", "left")
    status = F.when(F.col("by_id").isNotNull() | (F.col("n") == 1), "found").when(F.col("n") > 1, "ambiguous").otherwise("unknown")
    one = F.when(F.col("n") == 1, F.col("by_name"))
    return found.select("request", F.coalesce("by_id", one).alias("fighter_id"), status.alias("status"))


def safe_features(persp: DataFrame) -> DataFrame:
    """The columns known before a contest."""
    return persp.select(*[c for c in SAFE_FEATURES if c in persp.columns])


# Columns that are known only after a contest, whatever their table; and those of an entity after its last one.
AFTER = (
    "winner_fighter_id", "winner_name", "method_of_victory", "method_detail", "event_method_code", "stats_available", "result", "referee", "time_format",
    "ending_round", "ending_time",
)
FINAL = (
    "fights", "wins", "losses", "draws", "no_contests", "current_win_streak", "current_loss_streak", "significant_strikes_landed",
    "significant_strikes_attempted", "takedowns_landed", "takedowns_attempted", "control_time_seconds", "last_fight_date",
)


def leak_audit(columns: DataFrame) -> DataFrame:
    """``columns`` (column_name, with its table before the last dot or without one) with ``leaks``: whether it is known only after
    the contest.

    All of a table of rounds leaks, and everything counted in a bout, how it ended, both sides' statistics, and totals of entities.
    """
    name = F.lower(F.trim("column_name"))
    last = F.substring_index(name, ".", -1)
    dotted = name.contains(".")
    column = F.when(dotted & (last == ""), F.regexp_replace(name, r"\.$", "")).otherwise(last)
    table = F.when(dotted & (last != ""), F.regexp_replace(name, r"\.[^.]*$", "")).otherwise("")
    leaks = (
        table.endswith("fight_rounds") | column.rlike("^(opponent_)?bout_") | column.isin(*AFTER)
        | column.rlike(f"^fighter_[ab]_({'|'.join(STATS)})$") | (table.endswith("fighters") & column.isin(*FINAL))
    )
    return columns.withColumn("leaks", F.coalesce(leaks, F.lit(False)))
