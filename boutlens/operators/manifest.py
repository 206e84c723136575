"""A run's manifest in rows: one for the run, one for each card, one for each error; digests of cards folded to one.

A manifest is a dict of three tables. ``runs``: run_id, status, code_version, started_at, finished_at, listing (url, fetched_at,
latest_event_date), listed (how many cards the source lists), cards and digest (how many are noted, and the hash of all),
errors (how many), page_counts (map), feature_columns. ``run_cards``: run_id, event_url, listed (how often the source lists it),
noted (whether the run has its contests), urls, digest. ``run_errors``: run_id, message, resolved.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import SAFE_FEATURES

KINDS = ("listing", "event", "fight", "profile")
#: Hexadecimal digits of a card's digest that name its branch of the fold.
BRANCH = 2


def card_digest() -> Column:
    """Of what a card is noted with: its address and its contests in order."""
    return F.sha2(F.to_json(F.struct("event_url", "noted", "urls")), 256)


def branch() -> Column:
    return F.substring(F.sha2("event_url", 256), 1, BRANCH).alias("branch")


def _folded(rows: DataFrame, by: list[str], count: Column) -> DataFrame:
    # sums of the digests' quarters: they don't depend on order, so nothing is gathered
    parts = [F.sum(F.conv(F.substring("digest", 1 + 15 * k, 15), 16, 10).cast("decimal(38,0)")) for k in range(4)]
    made = rows.groupBy(*by).agg(count.alias("cards"), F.sha2(F.concat_ws(" ", count.cast("string"), *[p.cast("string") for p in parts]), 256).alias("digest"))
    return made.withColumn("cards", F.coalesce("cards", F.lit(0).cast("long")))


def branches(cards: DataFrame) -> DataFrame:
    """(run_id, branch, cards, digest): cards of a run by the first digits of the hash of their address."""
    return _folded(cards.select("run_id", branch(), "digest"), ["run_id", "branch"], F.count("*"))


def folded(cards: DataFrame) -> DataFrame:
    """(run_id, cards, digest): the digests of the branches in one."""
    return _folded(branches(cards), ["run_id"], F.sum("cards"))


def changed_cards(old: DataFrame, new: DataFrame) -> DataFrame:
    """(event_url, change): cards of two runs' ``run_cards`` (with or without run_id) that came, went or differ. Only branches whose digests differ are compared."""
    a, b = (branches(side.withColumn("run_id", F.lit(""))).select("branch", F.col("digest").alias(name)) for side, name in ((old, "a"), (new, "b")))
    unequal = a.join(b, "branch", "full").filter(~F.col("a").eqNullSafe(F.col("b"))).select("branch")
    sides = [side.select("event_url", branch(), F.col("digest").alias(name)).join(F.broadcast(unequal), "branch", "left_semi") for side, name in ((old, "a"), (new, "b"))]  # 256 branches
    both = sides[0].drop("branch").join(sides[1].drop("branch"), "event_url", "full").filter(~F.col("a").eqNullSafe(F.col("b")))
    return both.select("event_url", F.when(F.col("a").isNull(), "came").when(F.col("b").isNull(), "went").otherwise("differs").alias("change"))


def card_rows(noted: DataFrame, listed: DataFrame) -> DataFrame:
    """``noted`` (run_id, event_url, urls) beside ``listed`` (run_id, event_url, a row each time it is listed)."""
    counts = listed.groupBy("run_id", "event_url").agg(F.count("*").alias("listed"))
    both = noted.withColumn("noted", F.lit(True)).join(counts, ["run_id", "event_url"], "full")
    both = both.withColumns({"noted": F.coalesce("noted", F.lit(False)), "listed": F.coalesce("listed", F.lit(0).cast("long"))})
    return both.select("run_id", "event_url", "listed", "noted", "urls", card_digest().alias("digest"))


def from_document(manifest: DataFrame) -> dict[str, DataFrame]:
    """The tables of manifests that are one document each (sources.files.MANIFEST)."""
    noted = manifest.select("run_id", F.explode("event_fights").alias("event_url", "urls"))
    cards = card_rows(noted, manifest.select("run_id", F.explode("listing.event_urls").alias("event_url")))
    told = F.struct("listing.url", "listing.fetched_at", "listing.latest_event_date").alias("listing")
    size = lambda c: F.when(F.col(c).isNotNull(), F.size(c).cast("long"))
    runs = manifest.select(
        "run_id", "status", "code_version", "started_at", "finished_at", told, F.coalesce(size("listing.event_urls"), F.lit(0).cast("long")).alias("listed"),
        size("errors").alias("errors"), "page_counts", "feature_columns",
    )
    known = folded(cards.filter("noted"))
    errors = manifest.select("run_id", F.explode("errors").alias("e")).select("run_id", "e.message", "e.resolved")
    return {"runs": runs.join(known, "run_id", "left"), "run_cards": cards, "run_errors": errors}


def build_manifest(
    events: DataFrame, fights: DataFrame, refreshed: DataFrame, listing: DataFrame, pages: DataFrame, errors: DataFrame, run: dict[str, str], cut: Callable[[DataFrame], DataFrame]
) -> dict[str, DataFrame]:
    """Stored cards overlaid with those that were read anew, and how many pages were asked for and came.

    refreshed: event_url, fight_urls (array, as the source lists them). listing: event_url, event_date, deferred. pages: kind
    (listing, event, fight, profile), succeeded. errors: message. run: run_id, code_version, started_at, finished_at, url,
    fetched_at. ``cut`` keeps the cards, which are read for their table and for the fold.
    """
    run_id = F.lit(run["run_id"]).alias("run_id")
    stored = events.filter("event_url IS NOT NULL").select("event_id", "event_url").join(fights.select("event_id", "card_order", "source_fight_url"), "event_id", "left")
    found = F.collect_list(F.when(F.col("source_fight_url").isNotNull(), F.struct("card_order", "source_fight_url")))  # a card's contests
    stored = stored.groupBy("event_url").agg(F.transform(F.array_sort(found), lambda x: x["source_fight_url"]).alias("urls"))
    new = refreshed.select("event_url", F.array_distinct("fight_urls").alias("__new"))
    noted = stored.join(new, "event_url", "full").select(run_id, "event_url", F.coalesce("__new", "urls").alias("urls"))
    taken = listing.filter(~F.coalesce("deferred", F.lit(False)) & F.col("event_url").isNotNull())
    cards = cut(card_rows(noted, taken.select(run_id, "event_url").distinct()))
    failed = cut(errors.select(run_id, "message", F.lit(False).alias("resolved")))
    counts = [c for k in KINDS for c in (F.count_if(F.col("kind") == k).alias(f"{k}_pages_expected"), F.count_if((F.col("kind") == k) & F.col("succeeded")).alias(f"{k}_pages_succeeded"))]
    names = [f"{k}_pages_{x}" for k in KINDS for x in ("expected", "succeeded")]
    known = cards.agg(F.count_if(F.col("listed") > 0).alias("listed"), F.count_if("noted").alias("cards"))
    latest = taken.agg(F.max("event_date").cast("string").alias("latest"))
    digest = folded(cards.filter("noted")).select("digest")
    one = F.lit(1).alias("one")
    parts = [known, latest, pages.agg(*counts), failed.agg(F.count("*").alias("errors")), digest.agg(F.max("digest").alias("digest"))]
    row = reduce(lambda x, y: x.join(y, "one"), [p.select("*", one) for p in parts])  # one row each
    totals = F.map_from_arrays(F.array(*map(F.lit, (*names, "failed_pages"))), F.array(*[F.col(n).cast("int") for n in (*names, "errors")]))
    text = lambda k: F.lit(run[k]).alias(k)
    runs = row.select(
        run_id, F.when(F.col("errors") == 0, "completed").otherwise("failed").alias("status"), text("code_version"), text("started_at"), text("finished_at"),
        F.struct(text("url"), text("fetched_at"), F.col("latest").alias("latest_event_date")).alias("listing"), "listed", "errors",
        totals.alias("page_counts"), F.array(*map(F.lit, SAFE_FEATURES)).alias("feature_columns"), "cards", "digest",
    )
    return {"runs": runs, "run_cards": cards, "run_errors": failed}
