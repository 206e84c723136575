"""Structured Streaming forms: incremental refresh, daily quotas, time-to-live views, running records."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle


def incremental_refresh(spark: SparkSession, path: str, schema: T.StructType, merge: Callable[[DataFrame, int], None], checkpoint: str):
    """Reads files that arrived since the last run and merges each batch; late corrections replace what they correct.

    No watermark is set: it would drop late rows, and a correction may be arbitrarily late.
    """
    stream = spark.readStream.schema(schema).parquet(path)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def daily_quota(usage: DataFrame, limit: float, zone: str = "America/Los_Angeles", time: str = "ts", units: str = "units") -> DataFrame:
    """Units used on each local day and whether the limit is reached; the same for batches and, with a watermark, streams."""
    local = F.to_date(F.from_utc_timestamp(F.col(time), zone))
    return usage.groupBy(local.alias("day")).agg(F.sum(units).alias("used")).withColumn("blocked", F.col("used") >= limit)


def quota_stream(usage: DataFrame, limit: float, zone: str = "America/Los_Angeles", delay: str = "1 hour") -> DataFrame:
    local = F.from_utc_timestamp("ts", zone)
    df = usage.withColumn("local", local).withWatermark("local", delay).groupBy(F.window("local", "1 day"))
    return df.agg(F.sum("units").alias("used")).select(F.to_date("window.start").alias("day"), "used", (F.col("used") >= limit).alias("blocked"))


def ttl_view(entries: DataFrame, now: str) -> DataFrame:
    """The newest entry of each (kind, key), if it has not expired."""
    latest = entries.groupBy("kind", "key").agg(F.max_by(F.struct("value", "expires"), F.struct("created", "value")).alias("e"))
    return latest.select("kind", "key", "e.value", "e.expires").filter(F.col("expires") > F.lit(now).cast("timestamp"))


def never_fetched(wanted: DataFrame, fetched: DataFrame, key: str) -> DataFrame:
    return wanted.join(fetched.select(key).distinct(), key, "left_anti")


def freshness(listing: DataFrame, now: str, max_hours: float = 48, time: str = "fetched_at") -> DataFrame:
    """Age in hours, and whether it is between -1 and ``max_hours``."""
    hours = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(F.col(time).cast("timestamp"))) / 3.6e9
    return listing.withColumn("age_hours", hours).withColumn("fresh", F.col("age_hours").between(-1, max_hours))


RECORD = "fighter_id long, fight_id long, event_date date, wins int, losses int, draws int"


class _Records(StatefulProcessor):
    """An entity's contests in order, as a list; those that nothing can precede any more are only counted.

    The list holds (time in ms, fight_id, event_date, bout_outcome), the value the counts before its first.
    """

    def __init__(self, settles: bool) -> None:
        self.settles = settles

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", "time long, fight_id long, event_date date, bout_outcome string")
        self.base = handle.getValueState("base", "wins int, losses int, draws int")

    def before(self) -> list[int]:
        return list(self.base.get()) if self.base.exists() else [0, 0, 0]

    @staticmethod
    def records(base: list[int], contests: list[tuple]) -> dict[int, tuple]:
        counts, found = list(base), {}
        for _, fight, day, outcome in contests:
            found[fight] = (day, *counts)
            for k, name in enumerate(("win", "loss", "draw")):
                counts[k] += outcome == name
        return found

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        base, held = self.before(), [tuple(x) for x in self.open.get()]
        known = {x[1]: x for x in held}
        for batch in rows:
            for row in batch.itertuples():
                outcome = None if pd.isna(row.bout_outcome) else row.bout_outcome
                known[int(row.fight_id)] = (int(row.time), int(row.fight_id), row.event_date, outcome)
        contests = sorted(known.values(), key=lambda x: x[:2])
        if contests != held:
            self.open.put(contests)
            if self.settles:
                for time in {x[0] for x in contests} - {x[0] for x in held}:
                    self.handle.registerTimer(time + 1)
        old = self.records(base, held)
        out = [(key[0], fight, *record) for fight, record in self.records(base, contests).items() if old.get(fight) != record]
        yield pd.DataFrame(out, columns=["fighter_id", "fight_id", "event_date", "wins", "losses", "draws"])

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs()
        counts, left = self.before(), []
        for x in map(tuple, self.open.get()):
            if x[0] < limit:
                for k, name in enumerate(("win", "loss", "draw")):
                    counts[k] += x[3] == name
            else:
                left.append(x)
        self.base.update(tuple(counts))
        if left:
            self.open.put(left)
        else:
            self.open.clear()
        yield pd.DataFrame([], columns=["fighter_id", "fight_id", "event_date", "wins", "losses", "draws"])

    def close(self) -> None:
        pass


def running_record(stream: DataFrame, delay: str | None = None) -> DataFrame:
    """Record before each contest as new perspective rows (fighter_id, fight_id, event_date, bout_outcome) arrive in any order.

    A contest that comes late, or again with another outcome, gives the records of all contests of its entity that it changes once
    more; the newest record of a contest holds (:func:`latest_records`). Contests of a day are in order of their id.

    Without ``delay`` an entity's contests all stay in state. With it, contests older than the newest day seen by ``delay`` are
    counted and forgotten, and what comes later than that is dropped. The session needs the RocksDB state store.
    """
    time = F.col("event_date").cast("timestamp")
    rows = stream.select("fighter_id", "fight_id", "event_date", "bout_outcome", F.unix_millis(time).alias("time"))
    if delay is not None:
        rows = rows.withColumn("at", time).withWatermark("at", delay)
    mode = "None" if delay is None else "EventTime"
    return rows.groupBy("fighter_id").transformWithStateInPandas(_Records(delay is not None), RECORD, "Update", mode)


def latest_records(records: DataFrame) -> DataFrame:
    """The newest of each contest's records; records: those of :func:`running_record` with the ``batch`` that gave them."""
    kept = F.max_by(F.struct("event_date", "wins", "losses", "draws"), "batch").alias("r")
    return records.groupBy("fighter_id", "fight_id").agg(kept).select("fighter_id", "fight_id", "r.*")
