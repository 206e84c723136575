"""The thin queries of the training-data operators: each applies its operator to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import fill_middle, html_extract, lines, mixing, neardup, packing, quality, spelling, syncmers, tiff, tool_calls, topk, url_filter
from .common import table

Query = Callable[[SparkSession, str], DataFrame]

RULES = (
    ("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, sources, slots = mixing.mix(table(spark, sf_dir, "documents"))
    return mixing.taken(documents, sources, slots).select("doc_id", "size", "source_size", "target", "taken", "source")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), digest=F.crc32("ids"))
    return packed.select("doc_id", "piece", "start", "length", F.col("digest").alias("ids_crc32"), "sequence_id", "offset")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.drop("__key1", "__key2")


def op4_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", html_extract.extract(F.col("html")).alias("text"))
    return pages.withColumn("n_chars", F.length("text").cast("long"))


def op5_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = lines.drop_recurring(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return done.select("doc_id", "line_dedup.*")


def op6_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, threshold=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), "url", RULES)
    return judged.select("page_id", *[f"judged.{c}" for c in ("host", "path", "rule", "verdict")], F.size("judged.strict").alias("strict_hits"), F.size("judged.soft").alias("soft_hits"), "judged.weight")


#: The tools of the query below.
SCHEMAS = (
    ("configure", '{"type":"object","required":["text"],"properties":{"text":{"type":"string"},"turn":{"type":"integer","maximum":0}}}'),
    ("reply", '{"type":"object","required":["text","turn"],"additionalProperties":false,"properties":{"lines":{"type":"integer","maximum":3},'
     '"text":{"type":"string","minLength":40,"maxLength":300},"turn":{"type":"integer","minimum":0,"maximum":5}}}'),
)


def op8_tool_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """System and user turns are calls (of configure and reply), an assistant turn is the result of the turn before it, and
    if it has three lines or more, repeats that turn's call. Every call needs the conversation's opening call and the
    call halfway back to it."""
    turns = table(spark, sf_dir, "conversations")
    turn, text = F.col("turn"), F.coalesce("text", F.lit(""))
    breaks = F.length(text) - F.length(F.replace(text, F.lit("\n")))
    named = lambda turn: F.concat(F.lit("call-"), "conv_id", F.lit("-"), turn)
    half = 2 * F.floor(turn / 4) + F.pmod(turn, F.lit(2))
    arguments = F.to_json(F.struct(text.alias("text"), "turn", (breaks + 1).alias("lines")))
    again = (F.col("role") == "assistant") & (breaks >= 2)
    calls = turns.filter(F.col("role").isin("system", "user") | again).select(
        "conv_id", "turn", named(F.when(again, turn - 1).otherwise(turn)).alias("call_id"),
        F.when(F.col("role") == "system", "configure").otherwise("reply").alias("name"), arguments.alias("arguments"),
        F.array(named(F.lit(0)), named(half)).alias("needs"),
    )
    results = turns.filter(F.col("role") == "assistant").select(
        "conv_id", "turn", named(turn - 1).alias("call_id"), F.col("text").alias("content")
    )
    linked = tool_calls.link_tool_calls(calls, results, spark.createDataFrame(SCHEMAS, "name string, schema string"))
    return linked.select(
        "conv_id", "call_id", "status", "repeats", "level", "position", F.array_join("problems", "; ").alias("problems"),
        F.sha2("json", 256).alias("json_sha256"),
    )


def op9_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.edited_fingerprints(table(spark, sf_dir, "documents"))


def op10_tiff(spark: SparkSession, sf_dir: str) -> DataFrame:
    data = F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    docs = table(spark, sf_dir, "documents").select("doc_id", data.alias("data"))
    n = F.length("data").cast("long")
    padded = F.greatest(F.lit(1), F.ceil(n / 64)) * 64
    payload = F.concat("data", F.unhex(F.repeat(F.lit("00"), (padded - n).cast("int"))))
    media = tiff.with_tiff(docs.select("doc_id", n.alias("n_bytes"), payload.alias("data")), F.col("data"))
    page = tiff.pages(media, "media")
    read = page.select("doc_id", "n_bytes", "media", "tiff_page", "tiff_page.pixels")
    pixels, shape = F.col("pixels"), [F.col(f"tiff_page.{c}").cast("string") for c in ("width", "height")]
    shape = F.concat_ws(":", F.lit("grey8"), *shape, F.array_join(F.col("tiff_page.histogram").cast("array<string>"), ","))
    return read.select(
        "doc_id", "n_bytes", F.length(pixels).cast("long").alias("payload_bytes"),
        F.sha2(pixels, 256).alias("payload_sha256"), F.crc32(F.substring(pixels, -64, 64)).alias("tail_crc32"),
        F.length("media").cast("long").alias("media_bytes"), F.sha2("media", 256).alias("media_sha256"),
        shape.alias("feature"),
    )


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fill_middle.fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    output, form = F.col("fim.output"), F.col("fim.form")
    return done.select(
        "doc_id", "fim.n", "fim.form", "fim.prefix_chars", "fim.middle_chars", F.sha2(output, 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(output, form), 256).alias("restored_sha256"),
    )


def op12_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.best_matches(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("id") % 20 == 0, repeats=True)


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.word_counts(table(spark, sf_dir, "documents"))
    return spelling.spelling_variants(words).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Query] = {
    "op1_mixing": op1_mixing,
    "op2_packing": op2_packing,
    "op3_quality": op3_quality,
    "op4_html": op4_html,
    "op5_lines": op5_lines,
    "op6_neardup": op6_neardup,
    "op7_url_filter": op7_url_filter,
    "op8_tool_calls": op8_tool_calls,
    "op9_syncmers": op9_syncmers,
    "op10_tiff": op10_tiff,
    "op11_fill_middle": op11_fill_middle,
    "op12_topk": op12_topk,
    "op13_spelling": op13_spelling,
}


def _op7_sql() -> str:
    """The same rules and vocabulary; a term counts between other characters than a-z and 0-9."""
    hit = lambda term: f"regexp_matches(u, '(^|[^a-z0-9]){term}($|[^a-z0-9])')::INTEGER"
    strict = " + ".join(hit(t) for t in url_filter.STRICT)
    soft = " + ".join(hit(t) for t in url_filter.SOFT)
    weight = " + ".join(f"{w} * {hit(t)}" for t, w in url_filter.SOFT.items())
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    fits = lambda r: f"((host = '{r[1]}' OR ends_with(host, '.{r[1]}')) AND starts_with(path, '{r[2]}'))"
    rule = " ".join(f"WHEN {fits(r)} THEN '{r[1]}{r[2]}'" for r in ordered)
    verdict = " ".join(f"WHEN {fits(r)} THEN '{r[0]}'" for r in ordered)
    return f"""
        WITH parts AS (
            SELECT page_id, lower(coalesce(url, '')) AS u,
                   translate(coalesce(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
            FROM pages),
        hits AS (SELECT *, {strict} AS strict_hits, {soft} AS soft_hits, ({weight})::DOUBLE AS weight FROM parts)
        SELECT page_id, host, path, CASE {rule} END AS rule,
               CASE {verdict} WHEN strict_hits > 0 OR (soft_hits >= {url_filter.MIN_SOFT} AND weight >= {url_filter.MIN_WEIGHT}) THEN 'block' ELSE 'allow' END AS verdict,
               strict_hits::INTEGER AS strict_hits, soft_hits::INTEGER AS soft_hits, weight
        FROM hits"""


_OP8 = """
    WITH RECURSIVE turns AS (
        SELECT conv_id, turn, role, text, coalesce(text, '') AS body, length(coalesce(text, '')) - length(replace(coalesce(text, ''), chr(10), '')) + 1 AS lines
        FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
    calls AS (
        SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN turn - 1 ELSE turn END AS spot,
               CASE WHEN role = 'system' THEN 'configure' ELSE 'reply' END AS name, body AS text, lines
        FROM turns WHERE role IN ('system', 'user') OR (role = 'assistant' AND lines >= 3)),
    ranked AS (
        SELECT *, count(*) OVER (PARTITION BY conv_id, spot) AS repeats,
               row_number() OVER (PARTITION BY conv_id, spot ORDER BY turn, name, to_json(text)) AS rn
        FROM calls),
    first AS (SELECT * FROM ranked WHERE rn = 1),
    edges AS (
        SELECT DISTINCT f.conv_id, f.spot, o.spot AS needed FROM first f JOIN first o
        ON o.conv_id = f.conv_id AND o.spot <> f.spot AND o.spot IN (0, 2 * floor(f.turn / 4)::BIGINT + ((f.turn % 2) + 2) % 2)),
    paths AS (
        SELECT conv_id, spot, 0 AS level FROM first f
        WHERE NOT EXISTS (SELECT 1 FROM edges e WHERE e.conv_id = f.conv_id AND e.spot = f.spot)
        UNION
        SELECT e.conv_id, e.spot, p.level + 1 FROM edges e JOIN paths p ON p.conv_id = e.conv_id AND p.spot = e.needed),
    levelled AS (
        SELECT f.*, 'call-' || f.conv_id || '-' || f.spot AS call_id, l.level
        FROM first f LEFT JOIN (SELECT conv_id, spot, max(level) AS level FROM paths GROUP BY 1, 2) l ON l.conv_id = f.conv_id AND l.spot = f.spot),
    results AS (
        SELECT conv_id, 'call-' || conv_id || '-' || (turn - 1) AS call_id, arg_min(text, turn) AS content
        FROM (SELECT conv_id, turn, min(text) AS text FROM turns WHERE role = 'assistant' GROUP BY conv_id, turn)
        GROUP BY 1, 2),
    placed AS (
        SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY level NULLS LAST, turn, call_id) - 1 AS position FROM levelled)
    SELECT coalesce(p.conv_id, r.conv_id) AS conv_id, coalesce(p.call_id, r.call_id) AS call_id,
           CASE WHEN p.call_id IS NULL THEN 'orphan' WHEN r.call_id IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
           coalesce(p.repeats, 0) AS repeats, p.level::INTEGER AS level, p.position AS position,
           CASE WHEN p.call_id IS NULL THEN NULL
                WHEN p.name = 'configure' THEN CASE WHEN p.turn > 0 THEN '$.turn: too large' ELSE '' END
                ELSE concat_ws('; ', CASE WHEN p.lines > 3 THEN '$.lines: too large' END, CASE WHEN length(p.text) < 40 THEN '$.text: too short' END,
                               CASE WHEN length(p.text) > 300 THEN '$.text: too long' END, CASE WHEN p.turn < 0 THEN '$.turn: too small' END,
                               CASE WHEN p.turn > 5 THEN '$.turn: too large' END) END AS problems,
           sha256('{"arguments":' || CASE WHEN p.call_id IS NULL THEN 'null' ELSE '{"lines":' || p.lines || ',"text":' || to_json(p.text) || ',"turn":' || p.turn || '}' END
                  || ',"id":"' || coalesce(p.call_id, r.call_id) || '","name":' || coalesce('"' || p.name || '"', 'null')
                  || ',"result":' || coalesce(to_json(r.content)::VARCHAR, 'null') || '}') AS json_sha256
    FROM placed p FULL JOIN results r ON p.conv_id = r.conv_id AND p.call_id = r.call_id"""

_OP11 = r"""
    WITH texts AS (
        SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
               regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS tokens
        FROM documents),
    drawn AS (
        SELECT *, len(tokens) AS n, ('0x' || h[1:8])::UBIGINT AS h1, ('0x' || h[9:16])::UBIGINT AS h2, ('0x' || h[17:24])::UBIGINT AS h3,
               ('0x' || h[25:32])::UBIGINT AS h4 FROM texts),
    cuts AS (
        SELECT *, least(h1 % (n + 1), h2 % (n + 1))::BIGINT AS a, greatest(h1 % (n + 1), h2 % (n + 1))::BIGINT AS b,
               CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM drawn),
    parts AS (
        SELECT *, array_to_string(tokens[1:a], '') AS prefix, array_to_string(tokens[a + 1:b], '') AS middle,
               array_to_string(tokens[b + 1:n], '') AS suffix FROM cuts)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                  ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM parts"""

_OP12 = """
    WITH rows AS (
        SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT q.vec_id AS query_id, q.v AS asked, c.vec_id, coalesce(list_inner_product(q.v, c.v), 0)::BIGINT AS score
        FROM rows q JOIN rows c ON len(q.v) = len(c.v) AND NOT (q.vec_id IS NOT DISTINCT FROM c.vec_id AND q.v = c.v)
        WHERE q.vec_id % 20 = 0),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY query_id, asked ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank FROM scored)
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 20"""

#: CRC-32 by a table of its 256 steps; letters take one byte or two. Near words share what is left without one code point.
_OP13 = r"""
    WITH RECURSIVE bits AS (
        SELECT range AS i, 0 AS k, range AS c FROM range(256)
        UNION ALL SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END FROM bits WHERE k < 8),
    steps AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8),
    found AS (
        SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
    runs AS (SELECT id, run, count(*) AS uses FROM found WHERE length(run) >= 6 GROUP BY id, run),
    bytes AS (
        SELECT *, flatten(list_transform(string_split(id || ':' || run, ''), lambda ch: CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT]
               ELSE [192 + unicode(ch)::BIGINT // 64, 128 + unicode(ch)::BIGINT % 64] END)) AS b FROM runs),
    hashed AS (
        SELECT run, uses, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda c, x: xor(c >> 8, t[1 + (xor(c, x) & 255)])), 4294967295) AS h
        FROM bytes, steps),
    words AS (
        SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, sum(uses)::BIGINT AS n
        FROM hashed GROUP BY 1 HAVING n >= 5 AND length(word) >= 6),
    shorter AS (
        SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
    near AS (
        SELECT a.word, b.word AS other, b.n AS other_n FROM shorter a JOIN shorter b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
        UNION SELECT s.word, w.word, w.n FROM shorter s JOIN words w ON s.rest = w.word
        UNION SELECT w.word, s.word, s.n FROM shorter s JOIN words w ON s.rest = w.word),
    best AS (
        SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS other, max(other_n) AS other_n FROM near GROUP BY word),
    formed AS (
        SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 5 * w.n THEN other END AS form,
               CASE WHEN other_n >= 5 * w.n THEN other_n END AS form_n
        FROM words w LEFT JOIN best USING (word)),
    followed AS (
        SELECT word, word AS root, form FROM formed
        UNION ALL SELECT f.word, g.word, g.form FROM followed f JOIN formed g ON f.form = g.word)
    SELECT word, form, (SELECT root FROM followed f WHERE f.word = formed.word AND f.form IS NULL) AS root, n, n_near, form_n FROM formed"""

ORACLE: dict[str, str] = {"op7_url_filter": _op7_sql(), "op8_tool_calls": _OP8, "op11_fill_middle": _OP11, "op12_topk": _OP12, "op13_spelling": _OP13}
