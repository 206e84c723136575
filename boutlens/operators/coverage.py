"""Third-party text about contests: what may be used, which contest it is about, which passages, and protection of quotes."""

from __future__ import annotations

import html
import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalars import card_preview, event_matches, mentions, paired_title, recap, words
from ..joins import small

# Wording of odds and polls, of causes, and of technique; words that hedge a pick or report another's.
MARKET = (
    r"(?i)tapology|moneyline|betting odds|\bodds\b|\b(?:public|community|fan)\s+(?:picks?|votes?|sentiment|percentages?)\b"
    r"|(?:\d+(?:\.\d+)?\s*(?:%|percent)[^\n]*\b(?:fans?|public|community)\b)"
    r"|(?:\b(?:fans?|public|community)\b[^\n]*\d+(?:\.\d+)?\s*(?:%|percent))"
)
REASON = r"(?i)\b(because|since|due to|whereas|against|but|while)\b"
TECHNICAL = r"(?i)\b(takedown|wrestling|grappling|striking|cardio|pace|jab|kicks?|clinch|reach|footwork|defen[cs]e)\b"
HEDGES = r"(?i)\b(if|could|might|maybe|unless|would|can|not|don't|doesn't|didn't|said|says|picked|predicted)\b"
SELECTS_BEFORE = "(?:i pick|my pick(?: is)?|(?:the )?pick(?: is)?|prediction(?: is)?|i am picking|i m picking|i am taking|i m taking)"
SELECTS_AFTER = "(?:will win|wins this|to win|by (?:decision|submission|ko|tko|knockout))"
SENTENCE = r"(?<=[.!?])\s+|\n+"
#: Characters that a transcript may have in all.
OVERSIZED = 2_000_000


def eligible_observations(records: DataFrame, cutoff: str, lookback_days: int = 30) -> DataFrame:
    """Records published within the lookback and, like their first observation and their fetch, before the cutoff."""
    at = F.lit(cutoff).cast("timestamp")
    since = at - F.make_interval(days=F.lit(lookback_days))
    return records.filter((F.col("published_at") >= since) & (F.col("published_at") < at) & (F.col("observed_at") < at) & (F.col("fetched_at") < at))


def analyst_text(text: Column) -> Column:
    """The sentences of a text without odds or poll wording, joined by blanks."""
    return F.trim(F.array_join(F.filter(F.split(text, SENTENCE), lambda x: ~x.rlike(MARKET)), " "))


def without_market_language(segments: DataFrame, keys: list[str], pos: str = "pos", text: str = "text") -> DataFrame:
    """Segments cut to their sentences without odds or poll wording; a segment goes if such wording stands in it and its
    neighbours together, since captions split it, or if nothing is left."""
    order = Window.partitionBy(*keys).orderBy(pos)
    around = F.concat_ws(" ", F.lag(text).over(order), F.col(text), F.lead(text).over(order))
    df = segments.withColumn("__bad", around.rlike(MARKET)).filter(~F.col("__bad")).drop("__bad")
    return df.withColumn(text, analyst_text(F.col(text))).filter(F.col(text) != "")


def reasoned_comments(comments: DataFrame, cutoff: str, min_score: int = 2, min_words: int = 25) -> DataFrame:
    """Comments with reasons: scored, by a person, not edited after the cutoff, about both sides, and, without odds and
    polls, long enough, technical and causal. ``body`` is cut to that text.

    comments: body, author, score, stickied, created, edited, a_terms, b_terms (arrays of words, see fighter_terms and words).
    """
    latest = F.greatest("created", F.coalesce("edited", "created"))
    person = ~F.coalesce("author", F.lit("")).isin("", "[deleted]", "AutoModerator")
    df = comments.filter((F.col("score") >= min_score) & ~F.coalesce("stickied", F.lit(False)) & person & (latest < F.lit(cutoff).cast("timestamp")))
    df = df.withColumn("body", analyst_text(F.col("body"))).withColumn("__w", words(F.col("body")))
    named = lambda terms: F.exists(terms, lambda x: mentions(F.col("__w"), x))
    long = F.size(F.filter(F.split("body", r"\s+"), lambda x: x != "")) >= min_words
    return df.filter(named("a_terms") & named("b_terms") & long & F.col("body").rlike(TECHNICAL) & F.col("body").rlike(REASON)).drop("__w")


def comment_entries(comments: DataFrame, cutoff: str, k: int = 5, **rules) -> DataFrame:
    """One row for each comment that counts: the best of every author, ``k`` of each thread, with stable ids and a low weight.

    Besides the columns of :func:`reasoned_comments`: thread, comment_id, weight (at most 0.5; others don't count).
    """
    good = reasoned_comments(comments, cutoff, **rules).filter((F.col("weight") > 0) & (F.col("weight") <= 0.5))
    best = top_comments(good, "thread", "author", "score", "comment_id", k)
    ids = F.concat(F.lit("reddit:"), F.lower("author")).alias("source_id"), F.concat(F.lit("reddit:"), "comment_id").alias("content_id")
    return best.select("thread", *ids, "author", "weight", "body", "rank")


def written_entries(entries: DataFrame, cutoff: str, min_words: int = 12) -> DataFrame:
    """One row for each attributed entry of an article: source (host and writer), content id, weight and text.

    entries: url, writer, writer_words, published_at, fetched_at, pick_text, reasons, weight, both (whether it is about both sides).
    """
    at = F.lit(cutoff).cast("timestamp")
    size = F.size(F.filter(F.split(F.trim("reasons"), r"\s+"), lambda x: x != ""))
    ok = (F.col("published_at") < at) & (F.col("fetched_at") < at) & F.col("both") & (F.trim("writer") != "") & (size >= min_words) & F.col("weight").between(0, 10)
    source = F.concat(F.lit("written:"), F.try_parse_url("url", F.lit("HOST")), F.lit(":"), F.replace("writer_words", F.lit(" "), F.lit("-")))
    text = analyst_text(F.trim(F.concat_ws("\n", "pick_text", "reasons")))
    df = entries.filter(ok).withColumn("source_id", source).withColumn("text", text).filter("text != ''")
    return df.withColumn("content_id", F.substring(F.sha2(F.concat("url", "source_id"), 256), 1, 24)).select("source_id", "content_id", "writer", "url", "weight", "text")


def top_comments(comments: DataFrame, thread: str, author: str, score: str, key: str, k: int = 5) -> DataFrame:
    """The ``k`` highest scored comments of each thread, one for each author; ties go by ``key``."""
    one = Window.partitionBy(thread, author).orderBy(F.col(score).desc(), key)
    best = comments.withColumn("__n", F.row_number().over(one)).filter("__n = 1")
    top = Window.partitionBy(thread).orderBy(F.col(score).desc(), key)
    return best.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k).drop("__n")


def match_texts(texts: DataFrame, contests: DataFrame, days: int = 14) -> DataFrame:
    """Text records matched to contests of their date window: contest, card or provisional match.

    texts: text_id, title_words, text_words (title and description), published_date. contests: fight_id, event_id, event_date,
    a_words and b_words (arrays: name and aliases), a_surname and b_surname, label_words and label_pairs (see event_matches);
    all words as functions.words gives them. Recaps match nothing; a preview of some card is a provisional match.

    An index of the texts' words finds what can match: a text that names a contest has the last word of one of the first side's
    names, one that names a card the last word of one of its labels. Only such pairs of the same week are made, as an equi-join
    of words, and verified on the whole texts; previews alone meet every contest of their days. ``text_id`` and ``fight_id`` are unique.
    """
    week = lambda d: F.floor(F.datediff(d, F.lit("1970-01-01").cast("date")) / 7)
    known = texts.filter(~recap(F.col("title_words")))
    weeks = F.explode(F.sequence(week(F.col("published_date")), week(F.date_add("published_date", days)))).alias("__week")
    last = lambda x: F.substring_index(x, " ", -1)
    asked = F.array_distinct(F.concat(
        F.transform("a_words", last), F.array(last(F.col("a_surname"))), F.transform("label_words", last),
        F.coalesce(F.transform("label_pairs", lambda p: last(p[0])), F.array().cast("array<string>")),
    ))
    told = contests.withColumns({c: F.coalesce(c, F.array().cast(contests.schema[c].dataType)) for c in ("a_words", "label_words")})
    told = told.select("fight_id", "event_date", F.explode(asked).alias("__word"), week(F.col("event_date")).alias("__week")).filter("__word != ''")
    said = known.select("text_id", "published_date", F.explode(F.array_distinct(F.split("text_words", " "))).alias("__word"))
    said = said.select("text_id", "published_date", "__word", weeks)
    near = F.datediff("event_date", "published_date").between(0, days)
    found = said.join(told, ["__word", "__week"]).filter(near).select("text_id", "fight_id")
    previews = known.filter(card_preview(F.col("title_words"))).select("text_id", "published_date", weeks)
    any_ = previews.join(contests.select("fight_id", "event_date", week(F.col("event_date")).alias("__week")), "__week").filter(near)
    df = found.unionByName(any_.select("text_id", "fight_id")).distinct().join(known, "text_id").join(contests, "fight_id")
    text = F.col("text_words")
    named = lambda side: F.exists(side, lambda x: mentions(text, x))
    both = (named("a_words") & named("b_words")) | paired_title(text, F.col("a_surname"), F.col("b_surname"))
    card = event_matches(text, F.col("label_words"), F.col("label_pairs"))
    kind = F.when(both, "contest").when(card, "card").when(card_preview(F.col("title_words")), "provisional")
    return df.withColumn("match", kind).filter("match IS NOT NULL").select("text_id", "fight_id", "event_id", "published_date", "match")


def prioritised(matches: DataFrame, cap: int = 12) -> DataFrame:
    """The ``cap`` best matches of each contest: contest over card over provisional, then the newest (published_date)."""
    weight = F.when(F.col("match") == "contest", 3).when(F.col("match") == "card", 2).otherwise(1)
    order = Window.partitionBy("fight_id").orderBy(weight.desc(), F.col("published_date").desc(), "text_id")
    return matches.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= cap)


def matchup_discussed(text_words: Column, a_terms: Column, b_terms: Column, max_gap: int = 1500) -> Column:
    """Whether terms of both sides start within ``max_gap`` characters of each other; terms that both share don't count.

    All in words. Places of both sides are merged in order, so the work grows with their number.
    """

    @F.pandas_udf("boolean")
    def near(texts: pd.Series, left: pd.Series, right: pd.Series) -> pd.Series:
        def one(text: str | None, a, b) -> bool:
            sides = [{x for x in (terms if terms is not None else ()) if x} for terms in (a, b)]
            sides = [s - (sides[0] & sides[1]) for s in sides]
            if text is None or not all(sides):
                return False
            places = []
            for k, terms in enumerate(sides):
                pattern = r"\b(?:" + "|".join(map(re.escape, sorted(terms))) + r")\b"
                places += [(m.start(), k) for m in re.finditer(pattern, text)]
            places.sort()
            return any(k != j and y - x <= max_gap for (x, k), (y, j) in zip(places, places[1:]))

        return pd.Series([one(*row) for row in zip(texts, left, right)], dtype="boolean")

    return near(text_words, a_terms, b_terms)


def explicit_pick(pick: Column, evidence: Column, evidence_words: Column, text_words: Column, sides: Column, aliases: Column, alias_words: Column) -> Column:
    """The evidence stands in the text, picks one of the two sides by a phrase of choice, and neither hedges, nor reports
    another's pick, nor speaks of the market. ``aliases`` of the pick (its name and surname among them), ``alias_words`` in words.
    """
    each = F.zip_with(aliases, alias_words, lambda raw, plain: F.struct(raw.alias("raw"), plain.alias("plain")))

    def chosen(x: Column) -> Column:
        possessive = F.regexp_like(evidence, F.concat(F.lit(r"(?i)\b\Q"), x["raw"], F.lit(r"\E['’]s\b")))
        before = F.regexp_like(evidence_words, F.concat(F.lit(rf"\b{SELECTS_BEFORE}\s+"), x["plain"], F.lit(r"\b")))
        after = F.regexp_like(evidence_words, F.concat(F.lit(r"\b"), x["plain"], F.lit(rf"\s+{SELECTS_AFTER}\b")))
        return (x["plain"] != "") & ~possessive & (before | after)

    quoted = (F.trim(evidence) != "") & text_words.contains(evidence_words)
    return F.coalesce(F.array_contains(sides, pick) & quoted & ~evidence.rlike(MARKET) & ~evidence.rlike(HEDGES) & F.exists(each, chosen), F.lit(False))


def plain_text(text: Column) -> Column:
    """Without tags, with character references decoded."""

    @F.pandas_udf("string")
    def decoded(texts: pd.Series) -> pd.Series:
        return texts.map(lambda x: None if x is None else html.unescape(x))

    return F.trim(decoded(F.regexp_replace(text, "<[^>]+>", "")))


def segment_problems(segments: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, problem) of transcripts that are refused as a whole: a time that is negative or not finite, no text, too much."""
    sound = lambda c: F.col(c).isNotNull() & ~F.isnan(c) & (F.col(c) >= 0) & (F.abs(F.col(c)) != float("inf"))
    size = F.length(plain_text(F.col("text")))
    per = segments.withColumn("__size", size).groupBy(*keys).agg(F.every(sound("start") & sound("duration")).alias("timed"), F.sum("__size").alias("size"))
    problem = F.when(~F.col("timed"), "timing").when(F.coalesce("size", F.lit(0)) == 0, "empty").when(F.col("size") > OVERSIZED, "oversized")
    return per.select(*keys, problem.alias("problem")).filter("problem IS NOT NULL")


def normalised_segments(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Whole segments of the transcripts without problem, tags stripped and references decoded; empty ones, and those equal to
    the one before, go."""
    good = segments.join(segment_problems(segments, keys), keys, "left_anti")
    df = good.withColumn("text", plain_text(F.col("text"))).filter("text != ''")
    before = F.lag("text").over(Window.partitionBy(*keys).orderBy("pos"))
    return df.withColumn("__b", before).filter(~F.col("text").eqNullSafe(F.col("__b"))).drop("__b")


def chapters(descriptions: DataFrame, keys: list[str], text: str = "description") -> DataFrame:
    """(keys, number, start, end, title) of 'h:mm:ss title' lines; two or more, at increasing times, else none.

    Lines with 60 minutes or seconds and more are no chapters; marks before the title go.
    """
    pattern = r"^\s*(?:(\d{1,2}):)?(\d{1,2}):(\d{2})\s+[-|\s]*(.+)$"
    long = descriptions.select(*keys, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("pos", "line")).filter(F.col("line").rlike(pattern))
    part = lambda i: F.coalesce(F.regexp_extract("line", pattern, i).try_cast("int"), F.lit(0))
    long = long.filter((part(2) < 60) & (part(3) < 60))
    long = long.select(*keys, "pos", (part(1) * 3600 + part(2) * 60 + part(3)).alias("start"), F.regexp_extract("line", pattern, 4).alias("title"))
    order, whole = Window.partitionBy(*keys).orderBy("pos"), Window.partitionBy(*keys)
    long = long.withColumns({"number": F.row_number().over(order), "end": F.lead("start").over(order), "__n": F.count("*").over(whole)})
    rising = F.min(F.coalesce((F.col("end") > F.col("start")).cast("int"), F.lit(1))).over(whole)
    return long.withColumn("__r", rising).filter("__n >= 2 AND __r = 1").select(*keys, "number", "start", "end", "title")


def segment_neighbourhood(segments: DataFrame, keys: list[str], hit: Column, before: int = 8, after: int = 24, budget: int | None = None) -> DataFrame:
    """Segments within ``before`` ahead of a hit and ``after`` behind it, until ``budget`` characters are used."""
    order = Window.partitionBy(*keys).orderBy("pos")
    df = segments.withColumn("hit", F.coalesce(hit, F.lit(False)).cast("int"))
    df = df.withColumn("near", F.max("hit").over(order.rowsBetween(-after, before))).filter("near = 1").drop("near")
    if budget is not None:
        used = F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        df = df.withColumn("used", used).filter(F.col("used") <= budget)
    return df


def mention_windows(texts: DataFrame, keys: list[str], phrase: str, text: str = "text", before: int = 800, after: int = 2400) -> DataFrame:
    """(keys, start, end): character windows around each mention, merged where they overlap."""
    parts = F.split(F.lower(text), F.lit(phrase.lower()).cast("string")) if phrase.isalnum() else F.split(F.lower(text), "\\Q" + phrase.lower() + "\\E")
    lengths = F.transform(parts, lambda x: F.length(x))
    long = texts.select(*keys, F.length(text).alias("size"), F.posexplode(F.slice(lengths, F.lit(1), F.size(lengths) - 1)).alias("pos", "gap"))
    order = Window.partitionBy(*keys).orderBy("pos")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    long = long.withColumn("at", F.sum("gap").over(upto) + F.col("pos") * len(phrase))
    long = long.withColumns({"start": F.greatest(F.col("at") - before, F.lit(0)), "end": F.least(F.col("at") + after, F.col("size"))})
    top = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    long = long.withColumn("new", F.coalesce((F.col("start") > top).cast("int"), F.lit(1)))
    long = long.withColumn("island", F.sum("new").over(upto))
    return long.groupBy(*keys, "island").agg(F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def shingle_hashes(text: Column, n: int) -> Column:
    """Hashes of the distinct word ``n``-grams of a text (lower case, runs of letters and digits)."""
    tokens = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def grams(words: Column) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.xxhash64(F.array_join(F.slice(words, i, n), " ")))
        return F.when(F.size(words) >= n, F.array_distinct(each)).otherwise(F.array().cast("array<long>"))

    # bound as a lambda's variable, the words are split once and not for every gram
    return F.transform(F.array(tokens), grams)[0]


def ngram_overlap(texts: DataFrame, protected: DataFrame, key: str, protected_key: str, n: int = 8, text: str = "text") -> DataFrame:
    """(key, protected_key, shared): how many distinct ``n``-grams of a text stand in a protected text.

    Grams of both sides meet by hash; common ones are only counted, never paired within a side.
    """
    a = texts.select(key, F.explode(shingle_hashes(F.col(text), n)).alias("gram"))
    b = protected.select(protected_key, F.explode(shingle_hashes(F.col(text), n)).alias("gram"))
    return a.join(b, "gram").groupBy(key, protected_key).agg(F.count("*").alias("shared"))


def protected_grams(texts: DataFrame, text_words: str = "text_words", n: int = 8) -> DataFrame:
    """(gram): hashes of all runs of ``n`` words of protected texts; of a shorter text, of three words or more, the whole."""
    w = F.filter(F.split(text_words, " "), lambda x: x != "")
    size = F.least(F.lit(n), F.size(w))
    runs = lambda w: F.transform(F.sequence(F.lit(1), F.size(w) - size + 1), lambda i: F.xxhash64(F.array_join(F.slice(w, i, size), " ")))
    grams = F.when(F.size(w) >= 3, F.array_distinct(F.transform(F.array(w), runs)[0]))
    return texts.select(F.explode(grams).alias("gram")).distinct()


def quotes(outputs: DataFrame, protected: DataFrame, key: str, text_words: str = "text_words", sizes: Sequence[int] = (3, 4, 5, 6, 7, 8)) -> DataFrame:
    """(key, quotes): outputs in which a run of 3 to 8 words is a protected gram, and how many such runs they have."""
    w = F.filter(F.split(text_words, " "), lambda x: x != "")

    def of(w: Column, n: int) -> Column:
        each = F.transform(F.sequence(F.lit(1), F.size(w) - (n - 1)), lambda i: F.xxhash64(F.array_join(F.slice(w, i, n), " ")))
        return F.when(F.size(w) >= n, each)

    def runs(w: Column) -> Column:
        return F.array_distinct(F.flatten(F.array_compact(F.array(*[of(w, n) for n in sizes]))))

    grams = outputs.select(key, F.explode(F.transform(F.array(w), runs)[0]).alias("gram"))
    return grams.join(small(protected), "gram", "left_semi").groupBy(key).agg(F.count("*").alias("quotes"))


def redacted(outputs: DataFrame, found: DataFrame, key: str, text: str = "text", notice: str = "[Quotation omitted; see the linked source.]") -> DataFrame:
    """``outputs`` with the texts that quote replaced by a notice."""
    flags = found.select(key, F.lit(True).alias("__q"))
    return outputs.join(flags, key, "left").withColumn(text, F.when(F.col("__q"), F.lit(notice)).otherwise(F.col(text))).drop("__q")


def passages(segments: DataFrame, keys: list[str], about: DataFrame, chaptered: DataFrame, budget: int, before: int = 8, after: int = 24) -> DataFrame:
    """The segments of each transcript that speak of a contest, up to ``budget`` characters, the last one cut.

    segments: keys, pos, text, text_words, start. about: keys, terms (array of words of both sides), specific (the whole text
    is about the contest). chaptered: keys, start, end of the contest's own chapters. Chapters come first; without one the
    segments around mentions; without any mention the whole text, if it is specific.
    """
    spoken = segments.join(about, keys)
    inside = chaptered.select(*keys, F.col("start").alias("__from"), F.coalesce(F.col("end").cast("double"), F.lit(float("inf"))).alias("__to"))
    timed = spoken.groupBy(*keys).agg(F.max("start").alias("__last")).filter("__last > 0").select(*keys)
    within = spoken.join(inside.join(timed, keys, "left_semi"), keys).filter((F.col("start") >= F.col("__from")) & (F.col("start") < F.col("__to"))).drop("__from", "__to")
    rest = spoken.join(within.select(*keys).distinct(), keys, "left_anti")
    order = Window.partitionBy(*keys).orderBy("pos")
    pair = F.concat_ws(" ", "text_words", F.lead("text_words").over(order))
    rest = rest.withColumn("__pair", pair)
    hit = F.exists("terms", lambda x: mentions(F.col("__pair"), x)).cast("int")
    rest = rest.withColumn("__hit", hit).withColumns({"__any": F.max("__hit").over(Window.partitionBy(*keys)), "__near": F.max("__hit").over(order.rowsBetween(-after, before))})
    rest = rest.filter((F.col("__near") == 1) | ((F.col("__any") == 0) & F.col("specific"))).select(*within.columns)
    used = F.coalesce(F.sum(F.length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    df = within.unionByName(rest).withColumn("__used", used).filter(F.col("__used") < budget)
    return df.withColumn("text", F.substring("text", F.lit(1), (F.lit(budget) - F.col("__used")).cast("int"))).drop("__used", "terms", "specific")


def coverage_for(contests: DataFrame, texts: DataFrame, segments: DataFrame, described: DataFrame, cutoff: str, lookback_days: int = 30, cap: int = 12, budget: int = 20_000) -> tuple[DataFrame, DataFrame]:
    """(sources, passages) for every contest: which texts may be used and are about it, and what of them is read.

    contests: as in :func:`match_texts`, and terms (words of both sides). texts: as there, and published_at, observed_at,
    fetched_at. segments: text_id, pos, text, text_words, start, duration. described: text_id, description (with chapters).
    """
    known = eligible_observations(texts, cutoff, lookback_days)
    chosen = prioritised(match_texts(known, contests), cap)
    about = chosen.join(contests.select("fight_id", "terms"), "fight_id").select("fight_id", "text_id", "terms", (F.col("match") == "contest").alias("specific"))
    marks = chapters(described, ["text_id"]).withColumn("__words", words(F.col("title"))).join(about, "text_id")
    marks = marks.filter(F.exists("terms", lambda x: mentions(F.col("__words"), x))).select("fight_id", "text_id", "start", "end")
    wanted = segments.join(about.select("fight_id", "text_id"), "text_id")
    read = passages(wanted, ["fight_id", "text_id"], about, marks, budget)
    size = lambda df, name: df.groupBy("fight_id", "text_id").agg(F.sum(F.length("text")).alias(name))
    sources = chosen.join(size(wanted, "chars"), ["fight_id", "text_id"], "left").join(size(read, "read"), ["fight_id", "text_id"], "left")
    caveat = F.when(F.col("read").isNull(), "no discussion found").when(F.col("read") < F.col("chars"), "selected or cut passages")
    return sources.withColumn("caveat", caveat), read


def first_available_layer(layers: DataFrame, keys: list[str]) -> DataFrame:
    """layers: keys, layer, turn, allowed, ok. The first allowed layer that succeeded, and the failed ones before it."""
    tried = layers.filter("allowed")
    first = tried.groupBy(*keys).agg(F.min(F.when(F.col("ok"), F.col("turn"))).alias("first"))
    df = tried.join(first, keys)
    failed = F.array_sort(F.collect_list(F.when(F.col("first").isNull() | (F.col("turn") < F.col("first")), F.struct("turn", "layer"))))
    return df.groupBy(*keys).agg(F.max(F.when(F.col("turn") == F.col("first"), F.col("layer"))).alias("layer"), F.transform(failed, lambda x: x["layer"]).alias("failed"))


def citation_check(citations: DataFrame, eligible: DataFrame, keys: list[str]) -> DataFrame:
    """citations: keys, ids (array). ok if there is one at least and all are among the eligible (keys, id)."""
    long = citations.select(*keys, F.explode_outer("ids").alias("id"))
    known = eligible.select(*keys, "id", F.lit(True).alias("known")).distinct()
    df = long.join(known, [*keys, "id"], "left")
    return df.groupBy(*keys).agg((F.count("id") > 0).alias("any"), F.sum((F.col("id").isNotNull() & F.col("known").isNull()).cast("int")).alias("bad")).withColumn("ok", F.col("any") & (F.col("bad") == 0))


def claim_check(claims: DataFrame, evidence: DataFrame, keys: Sequence[str] = ("side",)) -> DataFrame:
    """claims: claim_id, keys, path, value (text). evidence: keys, path, value, each path once for its keys. Status supported,
    contradicted or unknown path."""
    have = evidence.select(*keys, "path", F.col("value").alias("stored"), F.lit(True).alias("known"))
    df = claims.join(have, [*keys, "path"], "left")
    status = F.when(F.col("known").isNull(), "unknown path").otherwise(verdict(F.col("value"), F.col("stored")))
    return df.withColumn("status", status).drop("known")


def verdict(value: Column, stored: Column) -> Column:
    number = F.abs(value.try_cast("double") - stored.try_cast("double")) <= 1e-9
    same = (F.trim(value) == F.trim(stored)) | F.coalesce(number, F.lit(False)) | value.eqNullSafe(stored)
    return F.when(F.coalesce(same, F.lit(False)), "supported").otherwise("contradicted")


def with_verdicts(evidence: DataFrame, claims: DataFrame, keys: Sequence[str] = ("side",)) -> DataFrame:
    """``evidence`` with ``claim``: the verdict of :func:`claim_check` on the claim about each path, null where there is none. One join:
    the evidence is neither made nor moved twice."""
    said = claims.select(*keys, "path", F.col("value").alias("__said"), F.lit(True).alias("__claimed"))
    df = evidence.join(said, [*keys, "path"], "left")
    return df.withColumn("claim", F.when(F.col("__claimed"), verdict(F.col("__said"), F.col("value")))).drop("__said", "__claimed")


def unchecked_categories(claims: DataFrame, reviews: DataFrame, categories: Sequence[str] = ("opposition", "style_history")) -> DataFrame:
    """(review_id, side, category) without a claim: every review must check each category for both sides.

    claims: review_id, side, category. reviews: review_id.
    """
    wanted = reviews.select("review_id", F.explode(F.array(F.lit("a"), F.lit("b"))).alias("side")).withColumn("category", F.explode(F.array(*map(F.lit, categories))))
    return wanted.join(claims.select("review_id", "side", "category"), ["review_id", "side", "category"], "left_anti")
