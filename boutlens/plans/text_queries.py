"""Queries over text, events and pages: passages, quotes, comments, caches, quotas, freshness, page extraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars
from ..operators import coverage
from ..sources import files
from ..sources.pages import extract_pages
from ..streaming import incremental
from .catalog import Tables, query, rounded

R6 = lambda x: f"round({x}, 6) + 0.0"
NOW = "2024-01-20"


@query("eligible_observations", f"""SELECT event_id, user_id FROM (SELECT *, ts + INTERVAL 1 HOUR AS o, ts + INTERVAL 2 HOUR AS f FROM events)
       WHERE ts >= TIMESTAMP '{NOW}' - INTERVAL 10 DAY AND ts < TIMESTAMP '{NOW}' AND o < TIMESTAMP '{NOW}' AND f < TIMESTAMP '{NOW}'""")  # fmt: skip
def _eligible(t: Tables) -> DataFrame:
    hours = lambda n: F.col("ts") + F.make_interval(hours=F.lit(n))
    records = t.raw("events").withColumns({"published_at": F.col("ts"), "observed_at": hours(1), "fetched_at": hours(2)})
    return coverage.eligible_observations(records, NOW, 10).select("event_id", "user_id")


@query("daily_quota", f"""SELECT strftime(timezone('America/Los_Angeles', timezone('UTC', ts)), '%Y-%m-%d') AS day, {R6("sum(value)")} AS used, sum(value) >= 5000 AS blocked FROM events GROUP BY 1""")
def _quota(t: Tables) -> DataFrame:
    df = incremental.daily_quota(t.raw("events"), 5000, units="value")
    return rounded(df.withColumn("day", F.col("day").cast("string")), "used")


@query("ttl_cache", f"""WITH e AS (SELECT event_type AS kind, user_id AS key, props AS value, ts AS created, ts + INTERVAL 2 DAY AS expires FROM events)
       SELECT kind, key, value FROM (SELECT *, row_number() OVER (PARTITION BY kind, key ORDER BY created DESC, value DESC) AS n FROM e) WHERE n = 1 AND expires > TIMESTAMP '{NOW}'""")  # fmt: skip
def _ttl(t: Tables) -> DataFrame:
    e = t.raw("events").select(F.col("event_type").alias("kind"), F.col("user_id").alias("key"), F.col("props").alias("value"), F.col("ts").alias("created"))
    return incremental.ttl_view(e.withColumn("expires", F.col("created") + F.make_interval(days=F.lit(2))), NOW).drop("expires")


@query("freshness", f"""SELECT event_type, count(*) FILTER (WHERE h BETWEEN -1 AND 48) AS fresh, count(*) AS n, {R6("min(h)")} AS newest FROM
       (SELECT event_type, (epoch_us(TIMESTAMP '{NOW}') - epoch_us(ts)) / 3.6e9::DOUBLE AS h FROM events) GROUP BY 1""")  # fmt: skip
def _fresh(t: Tables) -> DataFrame:
    df = incremental.freshness(t.raw("events"), NOW, time="ts")
    return rounded(df.groupBy("event_type").agg(F.count_if("fresh").alias("fresh"), F.count("*").alias("n"), F.min("age_hours").alias("newest")), "newest")


_GRAMS = """(SELECT {key}, unnest(list_distinct(list_transform(range(1, len(w) - 6), lambda i: array_to_string(w[i:i+7], ' ')))) AS gram
    FROM (SELECT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}\\p{{N}}]+'), lambda x: x <> '') AS w FROM {table}) WHERE len(w) >= 8)"""


@query("ngram_overlap", f"""SELECT doc_id, item_id, count(*) AS shared FROM {_GRAMS.format(key="doc_id", table="documents")} a JOIN {_GRAMS.format(key="item_id", table="benchmark")} b ON a.gram = b.gram GROUP BY 1, 2""")
def _overlap(t: Tables) -> DataFrame:
    return coverage.ngram_overlap(t.raw("documents"), t.raw("benchmark"), "doc_id", "item_id")


_MARKET = coverage.MARKET.removeprefix("(?i)").replace("'", "''")
_SENTENCES = "regexp_split_to_array(regexp_replace({text}, '([.!?])\\s+', '\\1' || chr(1), 'g'), '\\n+|' || chr(1))"


@query("market_language", f"""WITH said AS (SELECT conv_id, turn, {{said}} AS text FROM conversations),
       near AS (SELECT *, concat_ws(' ', lag(text) OVER w, text, lead(text) OVER w) AS around FROM said WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
       kept AS (SELECT conv_id, turn, trim(array_to_string(list_filter({_SENTENCES.format(text="text")}, lambda x: NOT regexp_matches(x, '{_MARKET}', 'i')), ' ')) AS text
                FROM near WHERE NOT regexp_matches(around, '{_MARKET}', 'i'))
       SELECT conv_id, turn, text FROM kept WHERE text <> ''""".format(said="CASE WHEN (conv_id + turn) % 11 = 3 THEN text || ' About ' || turn || '0% of' WHEN (conv_id + turn) % 11 = 4 THEN 'the fans. ' || text WHEN (conv_id + turn) % 7 = 2 THEN text || ' The odds moved. Done' ELSE text END"))  # fmt: skip
def _market_language(t: Tables) -> DataFrame:
    """Turns of conversations as segments; some speak of odds, and of shares of fans that are split between two turns."""
    n, text = F.col("conv_id") + F.col("turn"), F.col("text")
    said = F.when(n % 11 == 3, F.concat(text, F.lit(" About "), "turn", F.lit("0% of"))).when(n % 11 == 4, F.concat(F.lit("the fans. "), text))
    said = said.when(n % 7 == 2, F.concat(text, F.lit(" The odds moved. Done"))).otherwise(text)
    return coverage.without_market_language(t.raw("conversations").select("conv_id", "turn", said.alias("text")), ["conv_id"], "turn")


@query("top_comments", """SELECT conv_id, turn, role, rank FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY score DESC, turn) AS rank FROM
       (SELECT *, row_number() OVER (PARTITION BY conv_id, role ORDER BY score DESC, turn) AS n FROM (SELECT conv_id, turn, role, length(text) AS score FROM conversations)) WHERE n = 1) WHERE rank <= 2""")  # fmt: skip
def _top(t: Tables) -> DataFrame:
    comments = t.raw("conversations").withColumn("score", F.length("text"))
    return coverage.top_comments(comments, "conv_id", "role", "score", "turn", 2).select("conv_id", "turn", "role", "rank")


@query("segment_neighbourhood", """SELECT conv_id, turn, hit FROM (SELECT conv_id, turn, hit, max(hit) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS near
       FROM (SELECT conv_id, turn, coalesce(length(text) > 600, false)::INT AS hit FROM conversations)) WHERE near = 1""")  # fmt: skip
def _near(t: Tables) -> DataFrame:
    segments = t.raw("conversations").withColumn("pos", F.col("turn"))
    df = coverage.segment_neighbourhood(segments, ["conv_id"], F.length("text") > 600, before=1, after=2)
    return df.select("conv_id", "turn", "hit")


@query("adjacent_dedup", """SELECT user_id, count(*) AS kept FROM (SELECT user_id, event_type, lag(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b FROM events)
       WHERE event_type IS DISTINCT FROM b GROUP BY 1""")  # fmt: skip
def _adjacent(t: Tables) -> DataFrame:
    pos = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    segments = t.raw("events").select("user_id", pos.alias("pos"), F.col("event_type").alias("text"), F.lit(0.0).alias("start"), F.lit(1.0).alias("duration"))
    return coverage.normalised_segments(segments, ["user_id"]).groupBy("user_id").agg(F.count("*").alias("kept"))


def _described(t: Tables) -> DataFrame:
    """Chapter lines from a user's events, a minute apart; every fifth user's do not rise."""
    n = F.when(F.col("user_id") % 5 == 0, 1).otherwise(F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")))
    events = t.raw("events").withColumn("n", n)
    line = F.concat(F.format_string("%d:%02d:%02d", F.floor(F.col("n") / 60), F.col("n") % 60, F.lit(0)), F.lit(" "), F.col("event_type"))
    lines = F.array_sort(F.collect_list(F.struct("ts", "event_id", line.alias("line"))))
    return events.groupBy("user_id").agg(lines.alias("l")).select("user_id", F.array_join(F.transform("l", lambda x: x["line"]), "\n").alias("description"))


@query("chapters", """SELECT user_id, n AS number, 60 * n AS start_s, lead(60 * n) OVER (PARTITION BY user_id ORDER BY n) AS end_s, event_type AS title
       FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n, count(*) OVER (PARTITION BY user_id) AS c FROM events) WHERE user_id % 5 <> 0 AND c >= 2""")  # fmt: skip
def _chapters(t: Tables) -> DataFrame:
    return coverage.chapters(_described(t), ["user_id"]).withColumnsRenamed({"start": "start_s", "end": "end_s"})


@query("mention_windows", """WITH parts AS (SELECT doc_id, length(text) AS size, string_split(lower(text), 'license') AS p FROM documents WHERE text IS NOT NULL),
       gaps AS (SELECT doc_id, size, unnest(range(len(p) - 1)) AS pos, unnest(list_transform(p[1:len(p) - 1], lambda x: length(x))) AS gap FROM parts),
       spots AS (SELECT doc_id, size, pos, sum(gap) OVER (PARTITION BY doc_id ORDER BY pos) + 7 * pos AS spot FROM gaps),
       ranges AS (SELECT *, greatest(spot - 800, 0) AS lo, least(spot + 2400, size) AS hi FROM spots),
       fresh AS (SELECT *, coalesce(lo > max(hi) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true)::INT AS fresh FROM ranges),
       islands AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY pos) AS island FROM fresh)
       SELECT doc_id, min(lo)::BIGINT AS start_, max(hi)::BIGINT AS end_ FROM islands GROUP BY doc_id, island""")  # fmt: skip
def _windows(t: Tables) -> DataFrame:
    found = coverage.mention_windows(t.raw("documents").filter("text IS NOT NULL"), ["doc_id"], "license")
    return found.select("doc_id", F.col("start").cast("long").alias("start_"), F.col("end").cast("long").alias("end_"))


@query("words")
def _words(t: Tables) -> DataFrame:
    return t.raw("documents").select("doc_id", F.sha2(scalars.words(F.col("text")), 256).alias("words_sha256"), F.sha2(scalars.name_key(F.col("text")), 256).alias("key_sha256"))


@query("sentences", """SELECT doc_id, len(list_filter(regexp_split_to_array(regexp_replace(text, '([.!?])\\s+', '\\1' || chr(1), 'g'), '\\n+|' || chr(1)), lambda x: trim(x) <> '')) AS sentences FROM documents""")
def _sentences(t: Tables) -> DataFrame:
    return t.raw("documents").select("doc_id", F.size(scalars.sentences(F.col("text"))).alias("sentences"))


@query("extract_pages")
def _pages(t: Tables) -> DataFrame:
    return extract_pages(t.raw("pages"))


@query("text_reports", """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderkey % 60 + 45 AS p FROM orders)
       SELECT k AS o_orderkey, '2000-01-02' AS cutoff, 0 AS position, 'Customer ' || c AS fighter_a, 'Order ' || k AS fighter_b,
       CASE WHEN k % 7 = 0 THEN 'TimeoutError: no answer' END AS error,
       CASE WHEN k % 7 <> 0 THEN CASE WHEN k % 11 = 0 THEN 'Nobody' ELSE 'Customer ' || c END END AS predicted_winner,
       CASE WHEN k % 7 <> 0 THEN p / 100.0::DOUBLE END AS win_probability, CASE WHEN k % 7 <> 0 AND k % 5 <> 0 THEN 'Decision' END AS predicted_method,
       CASE WHEN k % 7 <> 0 AND k % 5 <> 0 THEN 3 END AS predicted_round, CASE WHEN k % 7 <> 0 AND k % 2 = 0 THEN 5 END AS scheduled_rounds,
       CASE WHEN k % 7 = 0 THEN NULL WHEN k % 5 = 0 THEN 'incomplete forecast' WHEN k % 11 = 0 THEN 'pick is no participant' WHEN p NOT BETWEEN 50 AND 100 THEN 'probability' END AS problem
       FROM o""")  # fmt: skip
def _reports(t: Tables) -> DataFrame:
    """Text reports written from orders, and read back: some failed, some incomplete, some with impossible picks."""
    k, c = F.col("o_orderkey"), F.concat(F.lit("Customer "), "o_custkey")
    pick = F.concat(F.lit("Pick: "), F.when(k % 11 == 0, "Nobody").otherwise(c), F.lit("\nConfidence: "), k % 60 + 45, F.lit("%\n"),
                    F.when(k % 5 != 0, "Predicted ending: Decision, round 3\n").otherwise(""), F.when(k % 2 == 0, "Scheduled distance assumes 5 rounds.\n").otherwise(""))
    body = F.when(k % 7 == 0, "Prediction failed: TimeoutError: no answer\n").otherwise(pick)
    text = F.concat(F.lit("A card\nEvidence cutoff: strictly before 2000-01-02\n\n"), c, F.lit(" vs Order "), k, F.lit(" | main event\n"), body,
                    F.lit("\n\n=== POST-CARD RESULTS (managed) ===\nA vs B\nPick: A\n"))
    return files.parse_reports(t.raw("orders").select("o_orderkey", text.alias("value"))).drop("event_date", "source", "generated_at")


@query("quote_protection", """WITH p AS (SELECT string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM benchmark WHERE regexp_matches(text, '^[\\x00-\\x7f]*$')),
       g AS (SELECT DISTINCT least(8, len(w)) AS n, unnest(list_transform(range(1, len(w) - least(8, len(w)) + 2), lambda i: array_to_string(w[i:i + least(8, len(w)) - 1], ' '))) AS gram FROM p WHERE len(w) >= 3),
       d AS (SELECT doc_id, string_split(trim(regexp_replace(lower(text), '[^a-z0-9]+', ' ', 'g')), ' ') AS w FROM documents WHERE regexp_matches(text, '^[\\x00-\\x7f]*$')),
       r AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS gram FROM d CROSS JOIN (SELECT DISTINCT n FROM g) WHERE len(w) >= n)
       SELECT doc_id, count(*) AS quotes FROM r WHERE gram IN (SELECT gram FROM g) GROUP BY 1""")  # fmt: skip
def _quotes(t: Tables) -> DataFrame:
    plain = lambda name: t.raw(name).filter(F.col("text").rlike(r"\A[\x00-\x7f]*\z")).withColumn("text_words", scalars.words(F.col("text")))
    return coverage.quotes(plain("documents"), coverage.protected_grams(plain("benchmark")), "doc_id")


@query("written_entries", """SELECT doc_id, source, sha256(coalesce(text, '')) AS content_id, length(text) AS n FROM documents WHERE lang = 'en' AND len(string_split_regex(trim(text), '\\s+')) >= 25""")
def _entries(t: Tables) -> DataFrame:
    docs = t.raw("documents").filter((F.col("lang") == "en") & (F.size(F.split(F.trim("text"), r"\s+")) >= 25))
    return docs.select("doc_id", "source", F.sha2(F.coalesce("text", F.lit("")), 256).alias("content_id"), F.length("text").alias("n"))


@query("first_available_layer", """WITH l AS (SELECT user_id, event_type AS layer, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS turn, value > 10 AS ok, event_type <> 'error' AS allowed FROM events),
       f AS (SELECT user_id, min(turn) FILTER (WHERE ok) AS first FROM l WHERE allowed GROUP BY 1)
       SELECT l.user_id, max(layer) FILTER (WHERE turn = first) AS layer, count(*) FILTER (WHERE first IS NULL OR turn < first) AS failed FROM l JOIN f ON l.user_id = f.user_id WHERE allowed GROUP BY 1""")  # fmt: skip
def _layers(t: Tables) -> DataFrame:
    turn = F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    layers = t.raw("events").select("user_id", F.col("event_type").alias("layer"), turn.alias("turn"), (F.col("value") > 10).alias("ok"), (F.col("event_type") != "error").alias("allowed"))
    return coverage.first_available_layer(layers, ["user_id"]).withColumn("failed", F.size("failed"))


@query("citation_check", """WITH c AS (SELECT o_custkey, o_orderkey AS id, o_orderstatus <> 'P' AS eligible FROM orders)
       SELECT o_custkey, true AS any_, count(*) FILTER (WHERE NOT eligible) AS bad, count(*) FILTER (WHERE NOT eligible) = 0 AS ok FROM c GROUP BY 1""")  # fmt: skip
def _citations(t: Tables) -> DataFrame:
    orders = t.raw("orders").select("o_custkey", F.col("o_orderkey").alias("id"), "o_orderstatus")
    cited = orders.groupBy("o_custkey").agg(F.collect_list("id").alias("ids"))
    return coverage.citation_check(cited, orders.filter("o_orderstatus != 'P'"), ["o_custkey"]).withColumnRenamed("any", "any_")


@query("long_evidence", """SELECT o_orderkey, unnest(['side.priority', 'side.status']) AS path, unnest([o_orderpriority, o_orderstatus]) AS value FROM orders""")
def _evidence(t: Tables) -> DataFrame:
    side = F.struct(F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    return files.long_evidence(t.raw("orders").select("o_orderkey", side.alias("side")), ["o_orderkey"]).select("o_orderkey", "path", "value")
