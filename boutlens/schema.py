"""Canonical tables: column lists and Spark types."""

from __future__ import annotations

from pyspark.sql import types as T

# The 22 counts that each side of a contest has.
PARTS = ("head", "body", "leg", "distance", "clinch", "ground")
STATS = (
    "knockdowns", "significant_strikes_landed", "significant_strikes_attempted", "total_strikes_landed",
    "total_strikes_attempted", "takedowns_landed", "takedowns_attempted", "submission_attempts", "reversals",
    "control_time_seconds",
    *(f"significant_{part}_strikes_{kind}" for part in PARTS for kind in ("landed", "attempted")),
)
PREFIGHT = ("wins", "losses", "draws", "current_win_streak", "current_loss_streak", "days_since_last_fight")
PROFILE = ("age", "height_inches", "reach_inches", "stance")
SUMMED = ("significant_strikes_landed", "significant_strikes_attempted", "takedowns_landed", "takedowns_attempted", "control_time_seconds")
OUTCOMES = ("win", "loss", "draw", "no_contest")
RESULTS = ("completed", "draw", "no_contest")

_KIND = {"stance": "string", "name": "string", "id": "string"}


_TYPES = {
    "string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "date": T.DateType(), "timestamp": T.TimestampType(),
    "boolean": T.BooleanType(), "double": T.DoubleType(),
}


def ddl(*columns: str) -> T.StructType:
    """Fields like ``name type [NOT NULL]``; no session is needed."""
    parts = [c.split() for c in columns]
    return T.StructType([T.StructField(p[0], _TYPES[p[1]], p[2:] != ["NOT", "NULL"]) for p in parts])


EVENTS = ddl(
    "event_id string NOT NULL", "event_name string NOT NULL", "event_date date NOT NULL", "event_location string",
    "event_url string", "source_fight_count int", "last_scraped_at timestamp", "created_at timestamp",
    "updated_at timestamp",
)
FIGHTERS = ddl(
    "fighter_id string NOT NULL", "fighter_name string NOT NULL", "fighter_nickname string", "date_of_birth date",
    "height_inches int", "reach_inches int", "stance string", "profile_url string", "profile_scraped_at timestamp",
    *(f"{c} int" for c in ("fights", "wins", "losses", "draws", "no_contests", "current_win_streak", "current_loss_streak")),
    *(f"{c} long" for c in SUMMED), "last_fight_date date", "created_at timestamp", "updated_at timestamp",
)


def side_columns(side: str) -> list[str]:
    p = f"fighter_{side}_"
    return [
        f"{p}id string NOT NULL", f"{p}name string NOT NULL",
        *(f"{p}{c} {_KIND.get(c, 'int')}" for c in PROFILE), f"{p}profile_imputed boolean",
        *(f"{p}{c} int" for c in PREFIGHT), *(f"{p}{c} int" for c in STATS),
    ]


FIGHTS = ddl(
    "fight_id string NOT NULL", "event_id string NOT NULL", "weight_class string", "card_order int",
    "event_method_code string", "stats_available boolean", *side_columns("a"), *side_columns("b"),
    "winner_fighter_id string", "winner_name string", "method_of_victory string", "method_detail string", "result string",
    "referee string", "time_format string", "ending_round int", "ending_time string", "head_to_head_fight_count int",
    "source_event_url string", "source_fight_url string", "last_scraped_at timestamp",
)
ROUNDS = ddl(
    "round_stat_id long", "fight_id string NOT NULL", "round_number int NOT NULL", "fighter_id string NOT NULL",
    "opponent_id string NOT NULL", *(f"{c} int" for c in STATS),
)
UPCOMING_EVENTS = ddl(
    "event_id string NOT NULL", "event_name string NOT NULL", "event_date date NOT NULL", "event_location string",
    "event_url string NOT NULL", "source_fight_count int NOT NULL", "last_scraped_at timestamp NOT NULL",
)
UPCOMING_FIGHTS = ddl(
    "fight_id string NOT NULL", "event_id string NOT NULL", "card_order int NOT NULL", "fighter_a_id string NOT NULL",
    "fighter_b_id string NOT NULL", "fighter_a_name string NOT NULL", "fighter_b_name string NOT NULL",
    "weight_class string", "is_title_bout boolean NOT NULL", "scheduled_rounds int", "source_fight_url string NOT NULL",
)
TABLES = {
    "events": EVENTS, "fighters": FIGHTERS, "fights": FIGHTS, "fight_rounds": ROUNDS,
    "upcoming_events": UPCOMING_EVENTS, "upcoming_fights": UPCOMING_FIGHTS,
}

#: Columns known before a contest begins.
SAFE_FEATURES = (
    "fight_id", "event_id", "event_date", "weight_class", "fighter_id", "opponent_id", "slot",
    *(f"prefight_{c}" for c in PREFIGHT), *(f"opponent_prefight_{c}" for c in PREFIGHT),
    *(f"prefight_{c}" for c in ("age", "reach_inches", "stance")),
    *(f"opponent_prefight_{c}" for c in ("age", "reach_inches", "stance")),
)
