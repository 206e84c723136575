"""The registry of queries: each has a DataFrame form and, where SQL can say it, one SQL text for another engine."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..checkpoints import written
from ..operators.perspectives import perspectives
from ..schema import STATS
from .proxy import derived, with_clause

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
#: What a contest is and how it ended, without counts and clocks.
BOUT = (
    "fight_id", "event_id", "event_date", "card_order", "fighter_a_id", "fighter_b_id", "fighter_a_name", "fighter_b_name", "result",
    "winner_fighter_id", "method_of_victory", "ending_round",
)


@dataclass(frozen=True)
class Tables:
    """The driver's tables and the contest tables derived from them."""

    spark: SparkSession
    sf_dir: str

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def contests(self) -> DataFrame:
        return derived(self.spark, self.sf_dir, "contests")

    @cached_property
    def bouts(self) -> DataFrame:
        """The columns BOUT of the contests, written once: for queries that read them several times."""
        return written(self.contests.select(*BOUT))

    @cached_property
    def fighters(self) -> DataFrame:
        return derived(self.spark, self.sf_dir, "entities")

    @cached_property
    def cards(self) -> DataFrame:
        return derived(self.spark, self.sf_dir, "cards")

    @cached_property
    def rounds(self) -> DataFrame:
        return derived(self.spark, self.sf_dir, "rounds")

    @cached_property
    def persp(self) -> DataFrame:
        return perspectives(self.contests)

    @cached_property
    def pairs(self) -> DataFrame:
        return self.contests.select(F.col("fighter_a_id").alias("a_id"), F.col("fighter_b_id").alias("b_id")).distinct()


def query(name: str, sql: str | None = None, dates: tuple[str, ...] = ()):
    """Registers a function of :class:`Tables` under ``name``; the columns ``dates`` are returned as text."""

    def add(function: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return function(Tables(spark, sf_dir)).withColumns({d: F.col(d).cast("string") for d in dates})

        QUERIES[name] = run
        if sql is not None:
            text = ", ".join(f"CAST({d} AS VARCHAR) AS {d}" for d in dates)
            ORACLE[name] = f"SELECT * REPLACE ({text}) FROM ({sql})" if dates else sql
        return function

    return add


def r6(column: Column | str) -> Column:
    """Six digits, and no negative zero."""
    return F.round(F.col(column) if isinstance(column, str) else column, 6) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def _side(me: str, other: str) -> str:
    stats = ", ".join(f"fighter_{me}_{c} AS bout_{c}, fighter_{other}_{c} AS opponent_bout_{c}" for c in STATS)
    return f"""
        SELECT fight_id, event_id, event_date, weight_class, card_order, event_bout_sequence, '{me}' AS slot,
               fighter_{me}_id AS fighter_id, fighter_{other}_id AS opponent_id, method_of_victory, ending_round, ending_time,
               time_format, stats_available,
               CASE result WHEN 'draw' THEN 'draw' WHEN 'no_contest' THEN 'no_contest'
                    WHEN 'completed' THEN CASE WHEN winner_fighter_id = fighter_{me}_id THEN 'win' WHEN winner_fighter_id = fighter_{other}_id THEN 'loss' END
               END AS bout_outcome, {stats}
        FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY card_order DESC NULLS LAST, fight_id) AS event_bout_sequence FROM contests)"""


HISTORY_SQL = "event_date, event_bout_sequence, event_id, fight_id"
#: The perspective rows with the seconds fought, after the derived tables.
PERSP = f"""persp AS (
    SELECT *, row_number() OVER (PARTITION BY fighter_id ORDER BY {HISTORY_SQL}) AS fighter_sequence,
           CASE WHEN ending_round BETWEEN 1 AND 3 AND seconds < 60 AND clock BETWEEN 0 AND 300 AND clock + 300 * (ending_round - 1) > 0
                THEN clock + 300 * (ending_round - 1) END AS fought
    FROM (SELECT *, split_part(ending_time, ':', 2)::INT AS seconds,
                 split_part(ending_time, ':', 1)::INT * 60 + split_part(ending_time, ':', 2)::INT AS clock
          FROM ({_side('a', 'b')} UNION ALL {_side('b', 'a')})))"""
WITH = with_clause("contests", "entities", "cards", "rounds") + ",\n" + PERSP
#: The same, with each table that is read several times made once, whatever the engine would choose.
ONCE = WITH.replace("contests AS (", "contests AS MATERIALIZED (").replace("rounds AS (", "rounds AS MATERIALIZED (").replace("persp AS (", "persp AS MATERIALIZED (")
