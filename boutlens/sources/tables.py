"""Canonical tables: reading, schema evolution, cutoff workspaces, and snapshots behind a pointer."""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..checkpoints import checkpointed
from ..operators.perspectives import perspectives, strict_cutoff
from ..schema import TABLES
from .storage import create_once, exists


def scan_tables(spark: SparkSession, root: str, names: tuple[str, ...] = tuple(TABLES)) -> dict[str, DataFrame]:
    """Every table with its current schema; columns that older files lack are NULL."""
    return {n: evolve_schema(spark.read.option("mergeSchema", "true").parquet(f"{root}/{n}"), TABLES[n]) for n in names}


def evolve_schema(df: DataFrame, schema: T.StructType, defaults: dict[str, Column] | None = None) -> DataFrame:
    """``df`` with exactly the fields of ``schema``: missing ones by default (else NULL), booleans stored as 0 and 1 cast."""
    defaults = defaults or {}
    have = set(df.columns)
    value = lambda f: F.col(f.name) if f.name in have else defaults.get(f.name, F.lit(None))
    return df.select(*[F.coalesce(value(f), defaults.get(f.name, F.lit(None))).cast(f.dataType).alias(f.name) for f in schema.fields])


def asof_workspace(tables: dict[str, DataFrame], cutoff: str) -> dict[str, DataFrame]:
    """The history tables before the cutoff; entities keep their id, name and birth alone."""
    events = strict_cutoff(tables["events"], cutoff)
    fights = tables["fights"].join(events.select("event_id", "event_date"), "event_id")
    rounds = tables["fight_rounds"].join(fights.select("fight_id"), "fight_id", "left_semi")
    fighters = tables["fighters"].select("fighter_id", "fighter_name", "date_of_birth")
    return {"events": events, "fights": fights, "fight_rounds": rounds, "fighters": fighters, "fighter_bout_history": perspectives(fights)}


def merge_schedule_identities(fighters: DataFrame, schedule: DataFrame) -> DataFrame:
    """Adds entities that only the schedule knows, without a birth date and without any history."""
    side = lambda s: schedule.select(F.col(f"fighter_{s}_id").alias("fighter_id"), F.col(f"fighter_{s}_name").alias("fighter_name"))
    new = side("a").union(side("b")).groupBy("fighter_id").agg(F.min("fighter_name").alias("fighter_name"))
    return fighters.unionByName(new.join(fighters, "fighter_id", "left_anti"), allowMissingColumns=True)


def ad_hoc(tables: dict[str, DataFrame], query: str) -> DataFrame:
    """A SELECT over the tables as views, which exist while it is analysed and no longer."""
    head = query.lstrip().split(None, 1)[0].lower() if query.strip() else ""
    if head not in ("select", "with"):
        raise ValueError("only SELECT and WITH queries are run")
    spark = next(iter(tables.values())).sparkSession
    for name in tables:
        if spark.catalog.tableExists(name):
            raise ValueError(f"there is a table {name} already")
    try:
        for name, df in tables.items():
            df.createTempView(name)
        return spark.sql(query)
    finally:
        for name in tables:
            spark.catalog.dropTempView(name)


def bounded_sql(tables: dict[str, DataFrame], query: str, row_limit: int = 200) -> DataFrame:
    """An ad-hoc SELECT: at most ``row_limit`` rows, with a column ``truncated`` that says whether there were more."""
    found = ad_hoc(tables, query).limit(row_limit + 1)
    more = found.agg((F.count("*") > row_limit).alias("truncated"), F.lit(1).alias("__one"))
    return found.limit(row_limit).withColumn("__one", F.lit(1)).join(F.broadcast(more), "__one").drop("__one")


def describe_schema(tables: dict[str, DataFrame]) -> DataFrame:
    rows = [(t, i, f.name, f.dataType.simpleString()) for t, df in sorted(tables.items()) for i, f in enumerate(df.schema.fields)]
    spark = next(iter(tables.values())).sparkSession
    return spark.createDataFrame(rows, "table_name string, position int, column_name string, type string")


MANIFEST = "table_name string, part string, rows long, digest string, run_id string"
POINTER = "number long, run_id string, previous string"


def parts_of(tables: dict[str, DataFrame], parts: dict[str, Column]) -> dict[str, DataFrame]:
    """The tables with a text column ``__part``: by an expression of their own, or all in one."""
    return {
        name: df.withColumn("__part", F.concat(F.lit("p"), F.coalesce(parts[name].cast("string"), F.lit(""))) if name in parts else F.lit("p"))
        for name, df in tables.items()
    }


def digests(name: str, df: DataFrame) -> DataFrame:
    """(table_name, part, rows, digest) of what the parts of a table hold, whatever the order of its rows."""
    row = F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns if c != "__part"]))
    one, two = F.xxhash64(F.lit(1), row), F.xxhash64(F.lit(2), row)
    sums = F.concat_ws(":", F.lit(df.drop("__part").schema.simpleString()).cast("string"), F.sum(one.cast("decimal(20)")).cast("string"), F.bit_xor(two).cast("string"))
    return df.groupBy(F.col("__part").alias("part")).agg(F.count("*").alias("rows"), F.sha2(sums, 256).alias("digest")).select(F.lit(name).alias("table_name"), "part", "rows", "digest")


def promote_snapshot(
    spark: SparkSession, tables: dict[str, DataFrame], root: str, run_id: str, report: DataFrame, parts: dict[str, Column] | None = None, expected: int | None = None
) -> bool:
    """Makes a snapshot of the tables under ``run_id`` and then moves the pointer; nothing is written if a check of ``report`` fails.

    ``parts``: by what expression a table is parted; the parts of a table, and so its rows in the manifest, should be a bounded number. Only
    parts whose content the live snapshot lacks are written: the manifest names the run that holds each part, and so shares the
    others. The pointer has a numbered file for each promotion, which is made once: of two promotions that started from the same
    number (``expected``; default: the live one's now) the second to arrive fails, returns False and leaves the pointer as it is.
    """
    if report.filter("status = 'FAIL'").limit(1).count():
        return False
    before, number = _pointer(spark, root)
    if exists(spark, f"{root}/manifests/run_id={run_id}") and spark.read.schema(POINTER).json(f"{root}/pointer").filter(F.col("run_id") == run_id).count():
        raise ValueError(f"{run_id} has been promoted already")
    start = number if expected is None else expected
    parted = parts_of(tables, parts or {})
    found = reduce(DataFrame.unionByName, [digests(n, df) for n, df in parted.items()])
    held = _manifest(spark, root, before).select("table_name", "part", "digest", F.col("run_id").alias("held"))
    manifest = found.join(F.broadcast(held), ["table_name", "part", "digest"], "left")
    manifest = checkpointed(manifest.select("table_name", "part", "rows", "digest", F.coalesce("held", F.lit(run_id)).alias("run_id")))
    for name, df in parted.items():
        new = manifest.filter((F.col("table_name") == name) & (F.col("run_id") == run_id)).select(F.col("part").alias("__part"))
        if not new.isEmpty():
            df.join(F.broadcast(new), "__part", "left_semi").write.mode("overwrite").partitionBy("__part").parquet(_data(root, name, run_id))
    schemas = spark.createDataFrame([(n, "", 0, df.schema.json(), run_id) for n, df in tables.items()], MANIFEST)
    manifest.unionByName(schemas).coalesce(1).write.mode("overwrite").parquet(f"{root}/manifests/run_id={run_id}")
    row = {"number": start + 1, "run_id": run_id, "previous": before}
    return create_once(spark, f"{root}/pointer/{start + 1:09d}.json", json.dumps(row) + "\n")


def _data(root: str, name: str, run_id: str) -> str:
    return f"{root}/data/{name}/run_id={run_id}"


def _manifest(spark: SparkSession, root: str, run_id: str | None) -> DataFrame:
    if run_id is None:
        return spark.createDataFrame([], MANIFEST)
    return spark.read.schema(MANIFEST).parquet(f"{root}/manifests/run_id={run_id}")


def _pointer(spark: SparkSession, root: str) -> tuple[str | None, int]:
    """The run that was promoted last and its number. Only a missing folder means that there is none; a bad file is an error."""
    if not exists(spark, f"{root}/pointer"):
        return None, 0
    pointer = spark.read.schema(POINTER).option("mode", "FAILFAST").json(f"{root}/pointer")
    found = pointer.orderBy(F.col("number").desc()).limit(1).collect()
    return (found[0]["run_id"], found[0]["number"]) if found else (None, 0)


def live_run(spark: SparkSession, root: str) -> str | None:
    """The run that was promoted last, or None."""
    return _pointer(spark, root)[0]


def live_number(spark: SparkSession, root: str) -> int:
    """How many promotions there were: what a run should pass as ``expected`` if it read the tables of this one."""
    return _pointer(spark, root)[1]


def live_tables(spark: SparkSession, root: str, names: tuple[str, ...]) -> dict[str, DataFrame]:
    """The tables of the live snapshot: each part from the run that holds it."""
    run = live_run(spark, root)
    if run is None:
        raise FileNotFoundError("no snapshot has been promoted")
    rows = _manifest(spark, root, run).filter(F.col("table_name").isin(*names)).collect()  # a row for each part
    found = {}
    for name in names:
        schema = next(T.StructType.fromJson(json.loads(r["digest"])) for r in rows if r["table_name"] == name and r["part"] == "")
        holders: dict[str, list[str]] = {}
        for r in rows:
            if r["table_name"] == name and r["part"]:
                holders.setdefault(r["run_id"], []).append(r["part"])
        stored = T.StructType([*schema.fields, T.StructField("__part", T.StringType())])
        read = [spark.read.schema(stored).parquet(_data(root, name, h)).filter(F.col("__part").isin(*p)).drop("__part") for h, p in sorted(holders.items())]
        found[name] = reduce(DataFrame.unionByName, read) if read else spark.createDataFrame([], schema)
    return found
