"""A refresh from end to end: merge what the source sent, rebuild, write the run's manifest, validate, promote."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import checkpointed
from ..sources.files import append_audit
from ..sources.tables import live_number, promote_snapshot
from . import derived, reconcile, validate
from .manifest import build_manifest


def bucket(key: str, n: int = 64) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n))


#: By what the tables of a snapshot are parted: a bounded number of parts each.
PARTS = {"events": "event_id", "fights": "event_id", "fight_rounds": "fight_id", "fighters": "fighter_id", "run_cards": "event_url"}


def refresh(
    base: dict[str, DataFrame], sent: dict[str, DataFrame], listing: DataFrame, pages: DataFrame, run: dict[str, str], root: str,
    initial_load: bool = False, incremental: bool = False, **rules,
) -> tuple[bool, DataFrame]:
    """(promoted, report). base and sent: events, fights, fight_rounds, fighters; what a card sends counts as a whole or not at all.

    A contest whose identity or counts the store refuses rejects its card. The rebuilt tables are validated with the manifest and
    against the base, promoted if nothing fails, and the report is kept beside the snapshots either way. Only parts of tables that
    differ from the live snapshot's are written; a promotion by another run meanwhile makes this one fail.

    ``incremental``: the base is a store that a refresh has rebuilt, so only what the sent cards and profiles touch is rebuilt.
    """
    started_from = live_number(listing.sparkSession, root)
    identity = reconcile.identity_guard(base["fights"], sent["fights"]).select("fight_id", "reason")
    whole = reconcile.round_payload_complete(sent["fight_rounds"], sent["fights"])
    had = base["fight_rounds"].select("fight_id").distinct().withColumn("has_complete", F.lit(True))
    status = F.when(F.col("stats_available"), "complete").otherwise("unavailable")
    asked = sent["fights"].select("fight_id", status.alias("status")).join(whole.withColumnRenamed("complete", "structurally_complete"), "fight_id")
    refused = reconcile.stats_authority(had, asked).filter("NOT accepted").select("fight_id", "reason")
    rejected = checkpointed(identity.unionByName(refused))
    fights = checkpointed(reconcile.atomic_cards(sent["fights"], rejected))
    cards = sent["events"].join(fights.select("event_id").distinct(), "event_id", "left_semi")
    rounds = sent["fight_rounds"].join(fights.select("fight_id"), "fight_id", "left_semi")
    events = reconcile.upsert_cards(base["events"], cards)
    merged = reconcile.upsert_contests(base["fights"], fights)
    all_rounds = reconcile.upsert_rounds(base["fight_rounds"], rounds, whole.filter("complete").select("fight_id"))
    people = reconcile.upsert_profiles(base["fighters"], sent["fighters"], run["finished_at"])
    # all of them are read many times from here on
    events, merged, all_rounds, people = (checkpointed(df) for df in (events, merged, all_rounds, people))
    if incremental:
        if not {f"fighter_{s}_{c}" for s in "ab" for c in derived.REPLAYED} <= set(base["fights"].columns):
            raise ValueError("an incremental refresh needs a base that has been rebuilt")
        sides = derived.entities_of(base["fights"].join(fights.select("fight_id"), "fight_id", "left_semi"))
        changed = cards.select("event_id").unionByName(fights.select("event_id"))
        also = sides.unionByName(sent["fighters"].select("fighter_id"))
        made, people, _, problems, _ = derived.rebuild_touched(events, merged, all_rounds, people, changed, also)
    else:
        made, people, _, problems = derived.rebuild_tables(events, merged, all_rounds, people)
    errors = rejected.select(F.concat_ws(": ", "fight_id", "reason").alias("message")).unionByName(problems.select(F.concat_ws(": ", "key", "problem").alias("message")))
    refreshed = fights.join(events.select("event_id", "event_url"), "event_id").groupBy("event_url").agg(F.collect_list("source_fight_url").alias("fight_urls"))
    tables = {k: checkpointed(v) for k, v in {"events": events, "fights": made, "fight_rounds": all_rounds, "fighters": people}.items()}
    manifest = build_manifest(tables["events"], tables["fights"], refreshed, listing, pages, errors, run, checkpointed)
    args = tables["events"], tables["fights"], tables["fight_rounds"], tables["fighters"]
    found = validate.checks(*args, **rules) | validate.replay_check(tables["fights"]) | validate.aggregate_check(tables["fights"], tables["fighters"])
    audit = validate.manifest_checks(manifest, tables["events"], tables["fights"], run["finished_at"])
    promotion = validate.promotion_checks(tables, None if initial_load else base, initial_load)
    report, ok = validate.validate_snapshot(found, audit, promotion)
    append_audit(report.withColumn("run_id", F.lit(run["run_id"])), f"{root}/audit")
    if not ok:
        return False, report
    parts = {t: bucket(k) for t, k in PARTS.items()}
    noted = {"run_cards": manifest["run_cards"].drop("run_id")}  # so that parts of cards that did not change are shared between runs
    return promote_snapshot(listing.sparkSession, tables | manifest | noted, root, run["run_id"], report, parts=parts, expected=started_from), report
