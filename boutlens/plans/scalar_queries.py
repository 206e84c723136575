"""Queries over column expressions and small joins: parsing, names, urls, dates, identities, cards to forecast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import cards, coverage, derived, perspectives, reconcile, scoring
from ..sources import tables
from .catalog import WITH, Tables, query, r6, rounded
from .table_queries import _FORECASTS, _forecasts, _scored

R6 = lambda x: f"round({x}, 6) + 0.0"


@query("parsed_text", """SELECT p_partkey, trim(regexp_replace('  ' || p_name || chr(9) || p_type || '  ', '\\s+', ' ', 'g')) AS cleaned, CASE WHEN p_partkey % 3 <> 0 THEN p_brand END AS known,
       trim(regexp_replace(lower(p_type), '[^a-z0-9]+', '_', 'g'), '_') AS header, CASE WHEN p_partkey % 4 <> 0 THEN p_size END AS n FROM part""")  # fmt: skip
def _text(t: Tables) -> DataFrame:
    k = F.col("p_partkey")
    return t.raw("part").select(
        "p_partkey", scalars.clean(F.concat(F.lit("  "), "p_name", F.lit("\t"), "p_type", F.lit("  "))).alias("cleaned"),
        scalars.known(F.when(k % 3 == 0, "--").otherwise(F.col("p_brand"))).alias("known"), scalars.header_key(F.col("p_type")).alias("header"),
        scalars.parse_count(F.when(k % 4 == 0, F.concat(F.lit("x"), "p_size")).otherwise(F.concat(F.lit(" "), "p_size"))).alias("n"),
    )


@query("url_ids", """SELECT page_id, list_last(string_split(regexp_replace(regexp_extract(url, '^[^?#]*'), '/+$', ''), '/')) AS last,
       CASE WHEN page_id % 3 = 0 THEN lpad(to_hex(page_id), 16, '0') END AS source, CASE WHEN page_id % 3 = 0 THEN lower(lpad(to_hex(page_id), 16, '0')) END AS event FROM
       (SELECT page_id, url FROM pages)""".replace("THEN lpad(to_hex(page_id), 16, '0') END AS source", "THEN lower(lpad(to_hex(page_id), 16, '0')) END AS source"))  # fmt: skip
def _urls(t: Tables) -> DataFrame:
    made = F.concat(F.lit("http://cards.example/event-details/"), F.lower(F.lpad(F.hex("page_id"), 16, "0")), F.when(F.col("page_id") % 3 == 0, "").otherwise("?x=1"))
    return t.raw("pages").select("page_id", scalars.stable_id(F.col("url")).alias("last"), scalars.source_id(made).alias("source"), scalars.event_key(made, "cards.example").alias("event"))


@query("labelled_metadata", """SELECT c_custkey, 'a: ' || c_nationkey AS reach, c_mktsegment AS stance, c_custkey % 5 = 0 AS has_extra FROM customer""")
def _labels(t: Tables) -> DataFrame:
    extra = F.when(F.col("c_custkey") % 5 == 0, "Extra: x").otherwise("no label")
    items = F.array(F.lit("Reach: first"), F.concat(F.lit(" REACH :  a: "), "c_nationkey"), F.concat(F.lit("Stance:"), "c_mktsegment"), extra)
    m = scalars.labelled_metadata(items)
    return t.raw("customer").select("c_custkey", F.try_element_at(m, F.lit("reach")).alias("reach"), F.try_element_at(m, F.lit("stance")).alias("stance"), F.map_contains_key(m, "extra").alias("has_extra"))


@query("normalize_method", """SELECT o_orderkey, CASE o_orderkey % 6 WHEN 0 THEN 'Decision - Unanimous' WHEN 1 THEN 'Submission' WHEN 2 THEN 'Decision - Majority' WHEN 3 THEN o_orderpriority WHEN 4 THEN 'KO/TKO' END AS method FROM orders""")
def _method(t: Tables) -> DataFrame:
    n = F.col("o_orderkey") % 6
    code = F.when(n == 0, " U-DEC ").when(n == 1, "SUB").when(n == 2, "M-DEC").when(n == 3, F.col("o_orderpriority")).when(n == 4, "KO/TKO").otherwise("--")
    return t.raw("orders").select("o_orderkey", scalars.normalize_method(code).alias("method"))


@query("measures", """SELECT p_partkey, CASE WHEN p_partkey % 5 <> 0 THEN 60 + p_size % 12 END AS height, CASE WHEN p_partkey % 7 <> 0 THEN 40 + p_size END AS reach FROM part""")
def _measures(t: Tables) -> DataFrame:
    k, inches = F.col("p_partkey"), F.col("p_size") % 12
    height = F.when(k % 5 == 0, F.concat(F.lit("5' "), inches + 12, F.lit('"'))).otherwise(F.concat(F.lit("5' "), inches, F.lit('"')))
    reach = F.when(k % 7 == 0, "--").otherwise(F.concat(F.col("p_size") + 40, F.lit('"')))
    return t.raw("part").select("p_partkey", scalars.height_inches(height).alias("height"), scalars.reach_inches(reach).alias("reach"))


@query("event_dates", """SELECT o_orderkey, CASE WHEN o_orderkey % 6 < 5 THEN o_orderdate::DATE END AS day, CASE WHEN o_orderkey % 6 = 0 THEN o_orderdate::DATE END AS iso FROM orders""", dates=("day", "iso"))
def _dates(t: Tables) -> DataFrame:
    d, n = F.col("o_orderdate").cast("date"), F.col("o_orderkey") % 6
    text = F.lit("32 Nothing 1995")
    for k, form in enumerate(("yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy", "MM/dd/yyyy", "d MMMM yyyy")):
        text = F.when(n == k, F.date_format(d, form)).otherwise(text)
    return t.raw("orders").select("o_orderkey", scalars.parse_date(text).alias("day"), scalars.iso_date(text).alias("iso"))


@query("rules_of_numbers", f"""SELECT event_id, {R6("1 / (1 + pow(10.0::DOUBLE, (value - user_id) / 400))")} AS expected, {R6("CASE WHEN user_id > 100 THEN 2 ELSE 1 END * (user_id * 3.0::DOUBLE + value * 2) / 1e6")} AS cost,
       CASE WHEN user_id % 3 = 0 THEN 4 WHEN user_id % 3 = 1 AND event_id % 2 = 0 THEN 5 ELSE 3 END AS rounds, CASE WHEN event_id % 10 <> 0 THEN value END AS safe,
       CASE WHEN user_id % 4 = 0 THEN 'complete' WHEN user_id % 4 = 1 THEN 'unavailable' ELSE 'partial' END AS status, strftime(timezone('UTC', timezone('America/New_York', date_trunc('day', ts))), '%Y-%m-%d %H:%M:%S') AS cutoff FROM events""")  # fmt: skip
def _numbers(t: Tables) -> DataFrame:
    u, e, v = F.col("user_id"), F.col("event_id"), F.col("value")
    four = u % 4
    status = scalars.stats_parse_status(F.when(four == 1, 0).otherwise(4), F.lit(2), F.when(four == 2, 5).otherwise(6), F.lit(3), four == 1, four != 3)
    safe = scalars.json_safe(F.when(e % 10 == 0, F.lit(float("inf"))).otherwise(v), "double")
    cost = scalars.usage_cost(u, F.lit(0), v, {"input": 3.0, "cached": 1.0, "output": 2.0}, long_from=100)
    return t.raw("events").select(
        "event_id", r6(scalars.elo_expected(u, v)).alias("expected"), r6(cost).alias("cost"),
        scalars.scheduled_rounds(F.when(u % 3 == 0, 4), F.when(u % 3 == 1, (e % 2 + 1).cast("int")).otherwise(2), F.lit(False)).alias("rounds"), safe.alias("safe"), status.alias("status"),
        F.date_format(scalars.evidence_cutoff(F.to_date("ts"), F.lit("America/New_York")), "yyyy-MM-dd HH:mm:ss").alias("cutoff"),
    )


@query("named_in_titles", """WITH w AS (SELECT conv_id, turn, ' ' || trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')) || ' ' AS w FROM conversations WHERE regexp_matches(text, '^[\\x00-\\x7f]*$'))
       SELECT conv_id, turn, contains(w, ' the ') AS named, contains(w, ' the of ') OR contains(w, ' of the ') OR contains(w, ' the and of ') OR contains(w, ' of and the ') AS paired FROM w""")  # fmt: skip
def _titles(t: Tables) -> DataFrame:
    df = t.raw("conversations").filter(F.col("text").rlike(r"\A[\x00-\x7f]*\z")).withColumn("w", scalars.words(F.col("text")))
    the, of = F.lit("the"), F.lit("of")
    return df.select("conv_id", "turn", scalars.mentions(F.col("w"), the).alias("named"), scalars.paired_title(F.col("w"), the, of).alias("paired"))


@query("code_version", "SELECT s_suppkey, sha256(s_name || chr(10) || s_nationkey) AS version FROM supplier")
def _version(t: Tables) -> DataFrame:
    return t.raw("supplier").select("s_suppkey", scalars.code_version(F.col("s_name"), F.col("s_nationkey").cast("string")).alias("version"))


_REQUESTS = """requests AS (SELECT DISTINCT CASE fighter_id % 4 WHEN 0 THEN fighter_id::VARCHAR WHEN 1 THEN ' ENTITY ' || fighter_id WHEN 2 THEN 'Twin' ELSE 'nobody ' || fighter_id END AS request FROM entities),
    people AS (SELECT fighter_id, CASE WHEN fighter_id % 100 = 2 THEN 'twin' ELSE fighter_name END AS fighter_name FROM entities)"""


@query("resolve_entity", f"""{WITH}, {_REQUESTS} SELECT request, CASE WHEN i.fighter_id IS NOT NULL THEN i.fighter_id WHEN n.n = 1 THEN n.id END AS fighter_id,
       CASE WHEN i.fighter_id IS NOT NULL OR n.n = 1 THEN 'found' WHEN n.n > 1 THEN 'ambiguous' ELSE 'unknown' END AS status
       FROM requests r LEFT JOIN people i ON i.fighter_id::VARCHAR = request LEFT JOIN (SELECT lower(trim(fighter_name)) AS key, count(*) AS n, min(fighter_id) AS id FROM people GROUP BY 1) n ON n.key = lower(trim(request))""")  # fmt: skip
def _resolve(t: Tables) -> DataFrame:
    k = F.col("fighter_id")
    asked = F.when(k % 4 == 0, k.cast("string")).when(k % 4 == 1, F.concat(F.lit(" ENTITY "), k)).when(k % 4 == 2, "Twin").otherwise(F.concat(F.lit("nobody "), k))
    people = t.fighters.select(k, F.when(k % 100 == 2, "twin").otherwise(F.col("fighter_name")).alias("fighter_name"))
    return perspectives.resolve_entity(t.fighters.select(asked.alias("request")).distinct(), people)


@query("fighter_history", f"{WITH} SELECT fight_id, fighter_id, fighter_sequence, bout_outcome FROM persp WHERE fighter_id IN (SELECT fighter_a_id FROM contests WHERE weight_class = 'Brand#11')")
def _history(t: Tables) -> DataFrame:
    ids = t.contests.filter("weight_class = 'Brand#11'").select(F.col("fighter_a_id").alias("fighter_id"))
    return perspectives.history_of(t.persp, ids).select("fight_id", "fighter_id", "fighter_sequence", "bout_outcome")


@query("merge_schedule_identities", f"""{WITH}, s AS (SELECT fighter_a_id AS i, fighter_a_name AS n FROM contests UNION SELECT fighter_b_id + 1000000, fighter_b_name FROM contests)
       SELECT fighter_id, fighter_name, date_of_birth FROM entities UNION ALL SELECT i, min(n), NULL FROM s WHERE i NOT IN (SELECT fighter_id FROM entities) GROUP BY 1""", dates=("date_of_birth",))  # fmt: skip
def _schedule(t: Tables) -> DataFrame:
    people = t.fighters.select("fighter_id", "fighter_name", "date_of_birth")
    return tables.merge_schedule_identities(people, t.contests.withColumn("fighter_b_id", F.col("fighter_b_id") + 1_000_000))


@query("asof_workspace", f"""{WITH} SELECT 'fights' AS table_, count(*) AS n FROM contests WHERE event_date < DATE '1998-01-01' UNION ALL SELECT 'fight_rounds', count(*) FROM rounds
       WHERE fight_id IN (SELECT fight_id FROM contests WHERE event_date < DATE '1998-01-01') UNION ALL SELECT 'events', count(*) FROM cards WHERE event_date < DATE '1998-01-01'""")  # fmt: skip
def _workspace(t: Tables) -> DataFrame:
    given = {"events": t.cards, "fights": t.contests.drop("event_date"), "fight_rounds": t.rounds, "fighters": t.fighters}
    made = tables.asof_workspace(given, "1998-01-01")
    counts = [made[n].agg(F.count("*").alias("n")).select(F.lit(n).alias("table_"), "n") for n in ("fights", "fight_rounds", "events")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


@query("upsert_cards", f"""{WITH}, sent AS (SELECT CASE WHEN day(event_date) % 3 = 0 THEN 'new ' || event_id ELSE event_id END AS event_id, CASE WHEN day(event_date) = 7 THEN event_url || '/other' ELSE event_url END AS event_url,
       'Sent' AS event_name FROM cards WHERE day(event_date) % 2 = 1), placed AS (SELECT CASE WHEN s.event_id IN (SELECT event_id FROM cards) THEN s.event_id ELSE coalesce(c.event_id, s.event_id) END AS event_id, s.event_url, s.event_name
       FROM sent s LEFT JOIN cards c ON c.event_url = s.event_url) SELECT coalesce(p.event_id, c.event_id) AS event_id, coalesce(p.event_url, c.event_url) AS event_url, coalesce(p.event_name, c.event_name) AS event_name
       FROM cards c FULL JOIN placed p ON p.event_id = c.event_id""")  # fmt: skip
def _cards(t: Tables) -> DataFrame:
    day = F.dayofmonth("event_date")
    sent = t.cards.filter(day % 2 == 1).select(
        F.when(day % 3 == 0, F.concat(F.lit("new "), "event_id")).otherwise(F.col("event_id")).alias("event_id"),
        F.when(day == 7, F.concat("event_url", F.lit("/other"))).otherwise(F.col("event_url")).alias("event_url"), F.lit("Sent").alias("event_name"),
    )
    return reconcile.upsert_cards(t.cards.select("event_id", "event_url", "event_name"), sent)


@query("summary_merge", f"""{WITH} SELECT fight_id, CASE WHEN fight_id % 4 = 0 THEN CASE WHEN fight_id % 3 = 0 THEN NULL ELSE 'sent' END ELSE weight_class END AS weight_class,
       CASE WHEN fight_id % 5 = 0 THEN CASE WHEN fight_id % 3 = 0 THEN NULL ELSE 9 END ELSE card_order END AS card_order FROM contests""")  # fmt: skip
def _summary(t: Tables) -> DataFrame:
    f = F.col("fight_id")
    url = F.concat(F.lit("fight "), f)
    payload = t.contests.select(f, url.alias("source_fight_url"), F.when(f % 4 == 0, " ").otherwise(F.col("weight_class")).alias("weight_class"), F.when(f % 5 == 0, None).otherwise(F.col("card_order")).alias("card_order"))
    rows = t.contests.filter(f % 3 != 0).select(F.when(f % 2 == 0, f).otherwise(-f).alias("fight_id"), url.alias("source_fight_url"), F.lit("sent").alias("weight_class"), F.lit(9).alias("card_order"))
    return reconcile.summary_merge(payload, rows, ("weight_class", "card_order")).drop("source_fight_url")


@query("backfill_card_metadata", f"""{WITH}, sent AS (SELECT * FROM contests WHERE fight_id % 400 <> 1), good AS (SELECT event_id FROM contests GROUP BY 1 HAVING count(*) FILTER (WHERE fight_id % 400 = 1) = 0)
       SELECT fight_id, card_order, CASE WHEN event_id IN (SELECT event_id FROM good) THEN 'sent' ELSE weight_class END AS weight_class, method_of_victory FROM contests""")  # fmt: skip
def _backfill(t: Tables) -> DataFrame:
    stored = t.contests.select("fight_id", "event_id", F.lit(None).cast("int").alias("card_order"), "weight_class", "method_of_victory")
    sent = t.contests.filter("fight_id % 400 != 1").select("fight_id", "event_id", "card_order", F.lit("sent").alias("weight_class"), F.lit(None).cast("string").alias("method_of_victory"))
    have = t.contests.select("fight_id", F.col("card_order").alias("o"))
    df = reconcile.backfill_card_metadata(stored, sent).join(have, "fight_id")
    return df.select("fight_id", F.coalesce("card_order", "o").alias("card_order"), "weight_class", "method_of_victory")


@query("winner_id", f"""{WITH} SELECT fight_id, CASE WHEN result = 'completed' AND fight_id % 50 > 1 THEN winner_fighter_id END AS winner_fighter_id,
       CASE WHEN result = 'completed' THEN fight_id % 50 <= 1 ELSE fight_id % 50 = 0 END AS winner_error FROM contests""")  # fmt: skip
def _winner(t: Tables) -> DataFrame:
    name = F.when(F.col("winner_fighter_id") == F.col("fighter_a_id"), F.col("fighter_a_name")).when(F.col("winner_fighter_id") == F.col("fighter_b_id"), F.col("fighter_b_name"))
    sent = F.when(F.col("fight_id") % 50 == 0, "Nobody").when(F.col("fight_id") % 50 == 1, None).otherwise(name)
    return derived.winner_id(t.contests.withColumn("winner_name", sent).drop("winner_fighter_id")).select("fight_id", "winner_fighter_id", "winner_error")


@query("identity_guard", f"""{WITH} SELECT fight_id, CASE WHEN fight_id % 90 IN (1, 3) THEN 'participants changed' ELSE 'url changed' END AS reason FROM contests WHERE fight_id % 90 IN (1, 2, 3)""")
def _identity(t: Tables) -> DataFrame:
    f, n = F.col("fight_id"), F.col("fight_id") % 90
    old = t.contests.select("fight_id", "fighter_a_id", "fighter_b_id", F.concat(F.lit("u"), f).alias("source_fight_url"))
    sent = old.withColumns({"fighter_a_id": F.when(n == 1, F.col("fighter_b_id")).when(n == 3, None).otherwise(F.col("fighter_a_id")), "source_fight_url": F.when(n == 2, "other").when(n == 4, None).otherwise(F.col("source_fight_url"))})
    return reconcile.identity_guard(old, sent)


@query("needs_work", f"""{WITH} SELECT 'metadata' AS kind, event_id AS key FROM cards WHERE event_id IN (SELECT event_id FROM contests WHERE fight_id % 70 = 3)
       UNION ALL SELECT 'profile', fighter_id::VARCHAR FROM entities WHERE fighter_id % 9 = 1 UNION ALL SELECT 'refresh', fighter_id::VARCHAR FROM entities WHERE fighter_id % 9 = 1 OR fighter_id % 9 IN (2, 3)""")  # fmt: skip
def _needs(t: Tables) -> DataFrame:
    bad = t.contests.withColumn("weight_class", F.when(F.col("fight_id") % 70 == 3, None).otherwise(F.col("weight_class")))
    n = F.col("fighter_id") % 9
    ago = F.when(n == 1, None).when(n == 2, "2000-01-01").when(n == 3, "2000-03-03").otherwise("2000-03-04")
    people = t.fighters.withColumns({"profile_scraped_at": ago.cast("timestamp"), "profile_url": F.lit("u")})
    part = lambda kind, df, key: df.select(F.lit(kind).alias("kind"), F.col(key).cast("string").alias("key"))
    found = part("metadata", reconcile.needs_metadata(bad, t.cards), "event_id")
    found = found.unionByName(part("profile", reconcile.needs_profile(people), "fighter_id"))
    return found.unionByName(part("refresh", reconcile.profile_refresh_due(people, "2000-06-01"), "fighter_id"))


@query("remaining_contests", f"""{WITH} SELECT fight_id, CASE WHEN fight_id % 80 = 1 THEN CASE WHEN fight_id % 3 = 0 THEN 'unclear' ELSE 'remaining' END ELSE 'completed' END AS state FROM contests""")
def _remaining(t: Tables) -> DataFrame:
    f = F.col("fight_id")
    open_ = f % 80 == 1
    rows = t.contests.select("event_id", f, F.when(open_, None).otherwise("win").alias("result"), F.when(open_, " ").otherwise(F.col("method_of_victory")).alias("method_of_victory"), (f % 3 != 0).alias("matchup_link"))
    return cards.remaining_contests(rows).select("fight_id", "state")


@query("deferred_cards", f"""{WITH}, o AS (SELECT event_id, bool_or(fight_id % 80 = 1) AS open FROM contests GROUP BY 1)
       SELECT c.event_id, CASE WHEN event_date < DATE '2000-06-01' THEN 'take' WHEN open THEN 'deferred' WHEN event_date > DATE '2000-06-01' THEN 'error' ELSE 'take' END AS status FROM cards c JOIN o ON o.event_id = c.event_id""")  # fmt: skip
def _deferred(t: Tables) -> DataFrame:
    f = F.col("fight_id")
    open_ = f % 80 == 1
    rows = t.contests.select("event_id", f, F.when(open_, None).otherwise("win").alias("result"), F.lit(None).cast("string").alias("method_of_victory"), F.lit(True).alias("matchup_link"))
    return cards.deferred_cards(t.cards.select("event_id", "event_date"), rows, "2000-06-01").select("event_id", "status")


@query("exclude_contests", f"""{WITH}, asked AS (SELECT fight_id::VARCHAR AS r FROM contests WHERE fight_id % 100 = 3 UNION SELECT upper(fighter_a_name) FROM contests WHERE fight_id % 100 = 5),
       names AS (SELECT DISTINCT fight_id, lower(unnest([fight_id::VARCHAR, fighter_a_name, fighter_b_name])) AS k FROM contests),
       hits AS (SELECT r, count(*) AS n, min(fight_id) AS f FROM asked JOIN names ON k = lower(r) GROUP BY 1) SELECT fight_id FROM contests WHERE fight_id NOT IN (SELECT f FROM hits WHERE n = 1)""")  # fmt: skip
def _exclude(t: Tables) -> DataFrame:
    asked = t.contests.filter("fight_id % 100 = 3").select(F.col("fight_id").cast("string").alias("request"))
    asked = asked.union(t.contests.filter("fight_id % 100 = 5").select(F.upper("fighter_a_name").alias("request")))
    return cards.exclude_contests(t.contests.select("fight_id", "fighter_a_name", "fighter_b_name"), asked)[0].select("fight_id")


@query("still_remaining", f"""{WITH} SELECT fight_id, fight_id % 60 NOT IN (1, 2) AS still FROM contests""")
def _still(t: Tables) -> DataFrame:
    n = F.col("fight_id") % 60
    pairs = t.contests.select("fight_id", "fighter_a_id", "fighter_b_id")
    fresh = pairs.filter(n != 1).withColumn("fighter_b_id", F.when(n == 2, -F.col("fighter_b_id")).otherwise(F.col("fighter_b_id")))
    return cards.still_remaining(pairs, fresh).select("fight_id", "still")


@query("card_features", f"""{WITH}, whole AS (SELECT event_id, event_date FROM cards WHERE day(event_date) <> 9)
       SELECT fight_id, CASE WHEN fight_id % 6 = 0 THEN 4 WHEN card_order = 1 OR fight_id % 7 = 0 THEN 5 ELSE 3 END AS scheduled_rounds,
       CASE WHEN fight_id % 6 = 0 THEN 'source' WHEN card_order = 1 OR fight_id % 7 = 0 THEN 'assumed main event or title distance' ELSE 'assumed standard distance' END AS rounds_basis,
       concat_ws(',', CASE WHEN event_date < DATE '2000-05-30' THEN 'stale schedule' END, CASE WHEN event_date = DATE '2000-06-01' THEN 'card is today' END) AS caveats FROM contests JOIN whole USING (event_id, event_date)""")  # fmt: skip
def _features(t: Tables) -> DataFrame:
    f = F.col("fight_id")
    count = F.when(F.dayofmonth("event_date") == 9, F.col("source_fight_count") + 1).otherwise(F.col("source_fight_count"))
    head = t.cards.select("event_id", "event_date", count.alias("source_fight_count"), F.col("event_date").cast("timestamp").alias("last_scraped_at"))
    bouts = t.contests.select("event_id", f, "card_order", F.when(f % 6 == 0, 4).alias("scheduled_rounds"), (f % 7 == 0).alias("is_title_bout"))
    return cards.card_features(head, bouts, "2000-06-01", "2000-06-01").select("fight_id", "scheduled_rounds", "rounds_basis", F.array_join("caveats", ",").alias("caveats"))


@query("published_gate", f"""{WITH}, {_FORECASTS} SELECT run_id, fight_id, error IS NOT NULL OR CASE WHEN run_id = 'second' THEN fight_id % 4 <> 1 ELSE fight_id % 3 <> 1 AND fight_id % 5 <> 2 END AS published FROM forecasts""")
def _gate(t: Tables) -> DataFrame:
    f = F.col("fight_id")
    every = F.map_from_arrays(F.array(*map(F.lit, cards.CHECKS)), F.array(*[(f % 4 != 1) if c == "schema" else F.lit(True) for c in cards.CHECKS]))
    review = F.create_map(F.lit("a"), F.lit(True), F.lit("b"), f % 5 != 2)
    second = F.col("run_id") == "second"
    df = _forecasts(t).withColumns({
        "mode": F.when(second, "deterministic").otherwise("review"), "checks": F.when(second, every).otherwise(review),
        "review_status": F.when(second, "validated").when(f % 3 == 1, "open").otherwise("approved"),
    })
    return cards.published_gate(df).select("run_id", "fight_id", "published")


@query("replay_cohort", f"""{WITH}, {_FORECASTS}, known AS (SELECT fighter_name, count(*) AS n, min(fighter_id) AS id FROM (SELECT fighter_id, CASE WHEN fighter_id % 97 = 5 THEN 'Entity 2' ELSE fighter_name END AS fighter_name FROM entities) GROUP BY 1)
       SELECT f.run_id, f.fight_id, a.id AS fighter_a_id, b.id AS fighter_b_id, CASE WHEN coalesce(a.n, 0) <> 1 OR coalesce(b.n, 0) <> 1 THEN 'ambiguous identity' WHEN f.fight_id % 8 = 1 THEN 'distance not recorded' END AS problem
       FROM forecasts f LEFT JOIN known a ON a.fighter_name = fighter_a LEFT JOIN known b ON b.fighter_name = fighter_b""")  # fmt: skip
def _cohort(t: Tables) -> DataFrame:
    people = t.fighters.withColumn("fighter_name", F.when(F.col("fighter_id") % 97 == 5, "Entity 2").otherwise(F.col("fighter_name")))
    asked = _forecasts(t).withColumn("scheduled_rounds", F.when(F.col("fight_id") % 8 == 1, None).otherwise(3))
    return cards.replay_cohort(asked, people).select("run_id", "fight_id", "fighter_a_id", "fighter_b_id", "problem")


@query("identity_sets", f"""{WITH} SELECT DISTINCT event_id, unnest(['summary missing', 'summary without url']) AS problem FROM contests WHERE fight_id % 90 = 4
       UNION SELECT event_id, 'summary missing' FROM contests WHERE fight_id % 90 = 7 UNION SELECT event_id, unnest(['card repeats a url or an id', 'summary repeats a url or an id']) FROM contests WHERE fight_id % 90 = 8""")  # fmt: skip
def _sets(t: Tables) -> DataFrame:
    f = F.col("fight_id")
    url = F.concat(F.lit("u"), f)
    base = t.contests.select("event_id", url.alias("fight_url"), f)
    urls = base.select("*", F.explode(F.when(f % 90 == 8, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))).drop("col")
    sent = urls.filter(f % 90 != 7).withColumn("fight_id", F.when(f % 90 == 4, -f).otherwise(f))
    return cards.identity_sets(urls, sent)


@query("matched_runs", f"""{WITH}, {_FORECASTS}, x AS (SELECT *, CASE WHEN fight_id % 40 = 1 AND run_id = 'second' AND fight_id % 3 = 0 THEN 'review: withheld' ELSE error END AS e FROM graded)
       SELECT a.pair, b.e IS NOT NULL AND b.e LIKE 'review%' AS withheld, count(*) AS n FROM x a JOIN x b ON a.pair = b.pair AND a.run_id = 'first' AND b.run_id = 'second'
       WHERE a.winner_correct IS NOT NULL AND (b.winner_correct IS NOT NULL OR (b.e IS NOT NULL AND b.e LIKE 'review%')) GROUP BY 1, 2""")  # fmt: skip
def _matched(t: Tables) -> DataFrame:
    f = F.col("contest")
    error = F.when((f % 40 == 1) & (F.col("run_id") == "second") & (f % 3 == 0), "review: withheld").otherwise(F.col("error"))
    df = scoring.matched_runs(_scored(t).withColumn("error", error), "first", "second")
    return df.groupBy("pair", "withheld").agg(F.count("*").alias("n"))


@query("claim_check", """WITH c AS (SELECT o_orderkey AS claim_id, CASE WHEN o_orderkey % 5 = 0 THEN 'a.none' ELSE 'a.total' END AS path, CASE WHEN o_orderkey % 7 = 0 THEN 'x' ELSE ' ' || o_orderkey || '.0' END AS value FROM orders)
       SELECT claim_id, CASE WHEN path = 'a.none' THEN 'unknown path' WHEN value = 'x' THEN 'contradicted' ELSE 'supported' END AS status FROM c""")  # fmt: skip
def _claims(t: Tables) -> DataFrame:
    k = F.col("o_orderkey")
    side = F.concat(F.lit("s"), k)
    claims = t.raw("orders").select(k.alias("claim_id"), side.alias("side"), F.when(k % 5 == 0, "a.none").otherwise("a.total").alias("path"), F.when(k % 7 == 0, "x").otherwise(F.concat(F.lit(" "), k, F.lit(".0"))).alias("value"))
    evidence = t.raw("orders").select(side.alias("side"), F.lit("a.total").alias("path"), k.cast("string").alias("value"))
    return coverage.claim_check(claims, evidence).select("claim_id", "status")


@query("unchecked_categories", """SELECT o_custkey AS review_id, s.side, c.category FROM (SELECT DISTINCT o_custkey FROM orders) r CROSS JOIN (VALUES ('a'), ('b')) s(side) CROSS JOIN (VALUES ('opposition'), ('style_history')) c(category)
       WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_custkey = r.o_custkey AND s.side = CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AND c.category = CASE WHEN o_orderstatus = 'F' THEN 'opposition' ELSE 'style_history' END)""")  # fmt: skip
def _unchecked(t: Tables) -> DataFrame:
    claims = t.raw("orders").select(F.col("o_custkey").alias("review_id"), F.when(F.col("o_orderkey") % 2 == 0, "a").otherwise("b").alias("side"), F.when(F.col("o_orderstatus") == "F", "opposition").otherwise("style_history").alias("category"))
    return coverage.unchecked_categories(claims, claims.select("review_id").distinct())


@query("opposition_summary", f"""{WITH}, e AS (SELECT fight_id, fighter_id, opponent_id, event_date, bout_outcome FROM persp),
       s AS (SELECT p.fight_id, p.fighter_id, p.bout_outcome, p.event_date, count(o.fight_id) FILTER (WHERE o.bout_outcome = 'win') AS w, count(o.fight_id) FILTER (WHERE o.bout_outcome = 'loss') AS l,
             count(o.fight_id) FILTER (WHERE o.bout_outcome = 'draw') AS d FROM e p LEFT JOIN e o ON o.fighter_id = p.opponent_id AND o.event_date < p.event_date GROUP BY ALL),
       q AS (SELECT *, CASE WHEN w + l + d > 0 THEN (w + 0.5::DOUBLE * d + 1) / (w + l + d + 2) END AS q FROM s)
       SELECT fighter_id, {R6("avg(q)")} AS average_quality, count(*) FILTER (WHERE q IS NULL) AS unknown_quality,
       arg_max(fight_id, (q, event_date, -fight_id)) FILTER (WHERE bout_outcome = 'win' AND q IS NOT NULL) AS best_win FROM q GROUP BY 1""")  # fmt: skip
def _opposition(t: Tables) -> DataFrame:
    from ..checkpoints import checkpointed
    from ..operators import asof

    persp = checkpointed(t.persp.select("fight_id", "fighter_id", "opponent_id", "event_date", "bout_outcome"))
    df = asof.opposition_summary(asof.opponent_quality(persp))
    return rounded(df, "average_quality").select("fighter_id", "average_quality", "unknown_quality", "best_win")


@query("rebuild_tables", f"""{WITH} SELECT counter, n FROM (SELECT unnest(['fights_processed', 'fights_without_round_stats', 'winner_ids_changed', 'source_event_urls_changed', 'stats_availability_changed', 'card_orders_backfilled',
       'events_using_card_order', 'events_using_fallback_order', 'fighters_rebuilt', 'profile_fields_hydrated']) AS counter, unnest([count(*), count(*) FILTER (WHERE NOT stats_available),
       count(*) FILTER (WHERE fight_id % 30 = 1 AND result = 'completed'), count(*), count(*) FILTER (WHERE fight_id % 40 = 1), count(*) FILTER (WHERE day(event_date) = 5),
       count(DISTINCT event_id) FILTER (WHERE day(event_date) <> 5), count(DISTINCT event_id) FILTER (WHERE day(event_date) = 5), (SELECT count(*) FROM entities),
       (SELECT sum((date_of_birth IS NOT NULL)::INT + (height_inches IS NOT NULL)::INT + (reach_inches IS NOT NULL)::INT + (stance IS NOT NULL)::INT) FROM persp JOIN entities USING (fighter_id))]) AS n FROM contests)""")  # fmt: skip
def _rebuild(t: Tables) -> DataFrame:
    """The ten counters of a rebuild of tables in which some derived columns are wrong or missing."""
    f = F.col("fight_id")
    name = F.when(F.col("winner_fighter_id") == F.col("fighter_a_id"), F.col("fighter_a_name")).when(F.col("winner_fighter_id") == F.col("fighter_b_id"), F.col("fighter_b_name"))
    fights = t.contests.withColumns({
        "winner_name": name, "ingest_seq": f, "created_at": F.lit(None).cast("timestamp"), "winner_fighter_id": F.when(f % 30 == 1, None).otherwise(F.col("winner_fighter_id")),
        "stats_available": F.when(f % 40 == 1, ~F.col("stats_available")).otherwise(F.col("stats_available")), "card_order": F.when(F.dayofmonth("event_date") == 5, None).otherwise(F.col("card_order")),
    })
    return derived.rebuild_tables(t.cards, fights, t.rounds, t.fighters)[2]
