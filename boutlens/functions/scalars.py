"""Column expressions: parsing, times, methods, probabilities. Malformed values become NULL unless a flag is asked for."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Codes of a card's method column and their meaning.
METHOD_CODES = {
    "KO/TKO": "KO/TKO", "SUB": "Submission", "U-DEC": "Decision - Unanimous", "S-DEC": "Decision - Split",
    "M-DEC": "Decision - Majority", "DQ": "DQ", "CNC": "Could Not Continue", "Overturned": "Overturned",
}
DECISION_CODES = ("U-DEC", "S-DEC", "M-DEC", "DEC", "UD", "SD", "MD")
NUMBERED_CARD = r"(?i)^UFC\s+((Vegas|Fight Night)\s+)?\d+$"
GENERAL_LABELS = ("ufc", "ufc fight night", "ufc vegas", "mma")
MISSING = ("", "--", "---", "n/a", "N/A")


def clean(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def known(text: Column) -> Column:
    """NULL for blanks and dashes."""
    value = clean(text)
    return F.when(~value.isin(*MISSING), value)


def parse_of(text: Column) -> Column:
    """'x of y' as struct(landed, attempted); NULL unless both are numbers and x <= y."""
    landed = F.regexp_extract(clean(text), r"^(\d+) of (\d+)$", 1)
    attempted = F.regexp_extract(clean(text), r"^(\d+) of (\d+)$", 2)
    pair = F.struct(landed.try_cast("int").alias("landed"), attempted.try_cast("int").alias("attempted"))
    return F.when((landed != "") & (pair["landed"] <= pair["attempted"]), pair)


def parse_clock(text: Column) -> Column:
    """'m:ss' in seconds; NULL if malformed or seconds are 60 or more."""
    minutes, seconds = _clock(text, 1), _clock(text, 2)
    return F.when(seconds < 60, minutes * 60 + seconds)


def _clock(text: Column, group: int) -> Column:
    return F.regexp_extract(F.coalesce(text, F.lit("")), r"^(\d+):(\d{2})$", group).try_cast("int")


def parse_count(text: Column) -> Column:
    return F.when(clean(text).rlike(r"^\d+$"), clean(text).try_cast("int"))


def stable_id(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(F.split(url, r"[?#]")[0], "/+$", ""), "/"), -1)


def source_id(url: Column) -> Column:
    """The last path segment if it is 16 hexadecimal digits, and nothing follows it."""
    return F.when(url.rlike(r"^https?://[^/?#]+/[^?#]*/[0-9a-f]{16}/?$"), stable_id(url))


def event_key(url: Column, host: str) -> Column:
    return F.when((F.try_parse_url(url, F.lit("HOST")) == host) & url.rlike(r"^https?://[^?#]+/[0-9a-f]{16}$"), stable_id(url))


def labelled_metadata(items: Column) -> Column:
    """A map of 'Key: value' items; later items win."""
    pairs = F.filter(items, lambda x: x.contains(":"))
    entry = lambda x: F.struct(F.lower(F.trim(F.substring_index(x, ":", 1))), F.trim(F.regexp_replace(x, "^[^:]*:", "")))
    entries = F.transform(pairs, entry)
    last = F.filter(entries, lambda x, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda y: y["col1"] == x["col1"]))
    return F.map_from_entries(last)


def normalize_method(code: Column) -> Column:
    mapping = F.create_map(*[F.lit(x) for pair in METHOD_CODES.items() for x in pair])
    return F.coalesce(F.try_element_at(mapping, known(code)), known(code))


def header_key(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(text), r"[^a-z0-9]+", "_"), "^_+|_+$", "")


slugify = header_key


def height_inches(text: Column) -> Column:
    feet = F.regexp_extract(text, r"""^(\d+)' *(\d+)"?$""", 1).try_cast("int")
    inches = F.regexp_extract(text, r"""^(\d+)' *(\d+)"?$""", 2).try_cast("int")
    return F.when(inches < 12, feet * 12 + inches)


def reach_inches(text: Column) -> Column:
    return F.regexp_extract(text, r"""^(\d+)"$""", 1).try_cast("int")


def parse_date(text: Column) -> Column:
    """The first of five formats that fits."""
    formats = ("yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy", "MM/dd/yyyy", "d MMMM yyyy")
    return F.coalesce(*[F.try_to_date(clean(text), f) for f in formats])


def iso_date(text: Column) -> Column:
    """Strict yyyy-MM-dd."""
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))


def round_lengths(time_format: Column) -> Column:
    """Seconds of each round of '3 Rnd (5-5-5)'; NULL without brackets."""
    inside = F.regexp_extract(F.coalesce(time_format, F.lit("")), r"\(([\d-]+)\)", 1)
    return F.when(inside != "", F.transform(F.split(inside, "-"), lambda x: x.try_cast("int") * 60))


def duration_seconds(ending_round: Column, ending_time: Column, time_format: Column) -> Column:
    """Seconds fought: the earlier rounds and the time in the last; NULL if anything does not fit."""
    free = (ending_round == 1) & (time_format == "No Time Limit")
    # bound as a lambda's variable, the clock and the lengths are read once and not wherever they are used
    read = F.struct(
        _clock(ending_time, 1).alias("minutes"), _clock(ending_time, 2).alias("seconds"), round_lengths(time_format).alias("lengths"),
        ending_round.alias("round"), free.alias("free"),
    )

    def total(x: Column) -> Column:
        elapsed = F.when(x["seconds"] < 60, x["minutes"] * 60 + x["seconds"])
        before = F.aggregate(F.slice(x["lengths"], F.lit(1), F.greatest(x["round"] - 1, F.lit(0))), F.lit(0), lambda acc, y: acc + y)
        fits = (x["round"] <= F.size(x["lengths"])) & (elapsed <= F.try_element_at(x["lengths"], F.greatest(x["round"], F.lit(1))))
        known = F.when(x["lengths"].isNotNull(), F.when(fits, elapsed + before)).otherwise(F.when(x["free"], elapsed))
        return F.when(x["round"] >= 1, known)

    return F.get(F.filter(F.transform(F.array(read), total), lambda x: x > 0), F.lit(0))


def duration_minutes(ending_round: Column, ending_time: Column, time_format: Column) -> Column:
    return duration_seconds(ending_round, ending_time, time_format) / F.lit(60.0)


def is_finish(method: Column) -> Column:
    return F.lower(F.coalesce(method, F.lit(""))).isin("ko/tko", "submission")


def method_group(method: Column) -> Column:
    """KO/TKO, Submission, Decision, DQ, Other; NULL for methods that can't be graded, also unknown ones."""
    value = F.upper(F.trim(method))
    return (
        F.when(value.rlike(r"\b(KO|TKO)\b"), "KO/TKO")
        .when((value == "SUB") | value.startswith("SUBMISSION"), "Submission")
        .when(value.contains("DECISION") | value.isin(*DECISION_CODES), "Decision")
        .when(value.isin("DQ", "DISQUALIFICATION"), "DQ")
        .when(value == "OTHER", "Other")
    )


def name_key(name: Column) -> Column:
    """NFKC, case folded, single blanks: Spark has no built-in for the first two."""

    @F.pandas_udf("string")
    def fold(names: pd.Series) -> pd.Series:
        return names.map(lambda x: None if x is None else " ".join(unicodedata.normalize("NFKC", x).casefold().split()))

    return fold(name)


#: ASCII letters in lower case, digits, and blanks for the rest: a table, not a step for each character.
_PLAIN = bytes(ord(chr(i).lower()) if i < 128 and chr(i).isalnum() else 32 for i in range(256))


def words(text: Column) -> Column:
    """Lower-case ASCII words, joined by blanks; accents are dropped."""

    @F.pandas_udf("string")
    def plain(texts: pd.Series) -> pd.Series:
        def one(x: str | None) -> str | None:
            if x is None:
                return None
            kept = unicodedata.normalize("NFKD", x).encode("ascii", "ignore")
            return " ".join(kept.translate(_PLAIN).decode().split())

        return texts.map(one)

    return plain(text)


def pair_key(a: Column, b: Column) -> Column:
    return F.array_sort(F.array(name_key(a), name_key(b)))


def mentions(text_words: Column, phrase_words: Column) -> Column:
    """Both sides are the output of :func:`words`."""
    return (phrase_words != "") & F.concat(F.lit(" "), text_words, F.lit(" ")).contains(F.concat(F.lit(" "), phrase_words, F.lit(" ")))


def paired_title(text_words: Column, left: Column, right: Column) -> Column:
    """Both names side by side in either order, with vs, versus, v, and, x or nothing between."""
    padded = F.concat(F.lit(" "), text_words, F.lit(" "))
    found = F.lit(False)
    for by in (" vs ", " versus ", " v ", " and ", " x ", " "):
        for a, b in ((left, right), (right, left)):
            found |= padded.contains(F.concat(F.lit(" "), a, F.lit(by), b, F.lit(" ")))
    return found & (left != "") & (right != "")


def surname(name: Column) -> Column:
    return F.element_at(F.split(F.trim(name), r"\s+"), -1)


def fighter_terms(name: Column, aliases: Column | None = None) -> Column:
    """What a text may call an entity: its name, its surname if it has four letters or more, and its aliases."""
    own = F.array(F.trim(name), F.when(F.length(surname(name)) >= 4, surname(name)))
    return F.array_compact(F.concat(own, F.coalesce(aliases, F.array().cast("array<string>"))) if aliases is not None else own)


def event_labels(event: Column, aliases: Column | None = None) -> Column:
    """What a text may call a card: its name; of 'prefix: matchup' the matchup, and the prefix if it is a numbered card."""
    prefix, split = F.trim(F.substring_index(event, ":", 1)), event.contains(":")
    rest = F.trim(F.regexp_replace(event, "^[^:]*:", ""))
    own = F.array(event, F.when(split, rest), F.when(split & prefix.rlike(NUMBERED_CARD), prefix))
    return F.array_compact(F.concat(own, F.coalesce(aliases, F.array().cast("array<string>"))) if aliases is not None else own)


def event_matches(text_words: Column, label_words: Column, pair_words: Column) -> Column:
    """Whether a text names the card: by one of its labels (as words), unless that is too general, or by the label's pair.

    ``pair_words`` has for each label an array of its two sides, null where it is no pairing.
    """
    each = F.zip_with(label_words, pair_words, lambda w, p: F.struct(w.alias("w"), p.alias("p")))
    named = lambda x: mentions(text_words, x["w"]) | F.coalesce(paired_title(text_words, x["p"][0], x["p"][1]), F.lit(False))
    return F.coalesce(F.exists(each, lambda x: ~x["w"].isin(*GENERAL_LABELS) & named(x)), F.lit(False))


def card_preview(title_words: Column) -> Column:
    """A title that promises predictions for a card, as opposed to a contest."""
    return title_words.rlike(r"\b(predictions?|picks?|preview|breakdown|betting tips)\b") & title_words.rlike(r"\b(ufc|mma|full card|entire card)\b")


def recap(title_words: Column) -> Column:
    return title_words.rlike(r"\b(recap|results|reaction|watchalong|companion|post fight)\b")


def code_version(*parts: Column) -> Column:
    """A digest of what a run was made with."""
    return F.sha2(F.concat_ws("\n", *parts), 256)


def sentences(text: Column) -> Column:
    return F.filter(F.split(text, r"(?<=[.!?])\s+|\n+"), lambda s: F.trim(s) != "")


def ratio(numerator: Column, denominator: Column) -> Column:
    return F.try_divide(numerator, denominator)


def quality(wins: Column, losses: Column, draws: Column) -> Column:
    """A smoothed share of wins; NULL before the first decided contest."""
    n = wins + losses + draws
    return F.when(n > 0, (wins + F.lit(0.5) * draws + 1) / (n + 2))


def recency_weight(age_days: Column, method: Column, half_life_days: float = 1095.75, finish_multiplier: float = 1.1) -> Column:
    return F.pow(F.lit(2.0), -age_days / F.lit(half_life_days)) * F.when(is_finish(method), finish_multiplier).otherwise(1.0)


def elo_expected(mine: Column, other: Column) -> Column:
    return 1 / (1 + F.pow(F.lit(10.0), (other - mine) / 400))


def age_on(date_of_birth: Column, day: Column) -> Column:
    """Full years; NULL for a birth after the day."""
    years = F.year(day) - F.year(date_of_birth) - F.when(
        (F.month(day) * 100 + F.dayofmonth(day)) < (F.month(date_of_birth) * 100 + F.dayofmonth(date_of_birth)), 1
    ).otherwise(0)
    return F.when(years >= 0, years)


def implied_probability(line: Column) -> Column:
    """Of an American price; NULL between -100 and 100."""
    return F.when(line <= -100, -line / (-line + F.lit(100.0))).when(line >= 100, 100 / (line + F.lit(100.0)))


def evidence_cutoff(day: Column, zone: Column) -> Column:
    """Midnight of a local day as UTC; daylight saving counts."""
    return F.to_utc_timestamp(day.cast("timestamp"), zone)


def scheduled_rounds(stored: Column, card_order: Column, title: Column) -> Column:
    return F.coalesce(stored, F.when((card_order == 1) | title, 5).otherwise(3))


def usage_cost(prompt: Column, cached: Column, output: Column, price: dict[str, float], long_from: int = 200_000, long_factor: float = 2.0) -> Column:
    plain = (prompt - cached) * price["input"] + cached * price["cached"] + output * price["output"]
    return plain / 1e6 * F.when(prompt > long_from, long_factor).otherwise(1.0)


def json_safe(value: Column, kind: str) -> Column:
    """Bytes as hex, non-finite numbers as NULL."""
    if kind == "binary":
        return F.lower(F.hex(value))
    if kind in ("double", "float"):
        return F.when(~F.isnan(value) & (F.abs(value) != float("inf")), value)
    return value


def stats_parse_status(tables: Column, totals: Column, rounds: Column, ending_round: Column, unavailable: Column, aligned: Column) -> Column:
    """complete, unavailable or partial."""
    complete = (tables == 4) & (totals == 2) & (rounds == 2 * ending_round) & aligned
    return F.when(complete, "complete").when(unavailable & (tables == 0), "unavailable").otherwise("partial")


def candidate_rules(probability: Column, round_: Column, distance: Column, method: Column, winner: Column, a: Column, b: Column) -> Column:
    """What a forecast breaks, as an array of names."""
    issues = [
        F.when(~probability.between(0.5, 1.0) | probability.isNull(), "probability"),
        F.when(round_ > distance, "round"),
        F.when((method_group(method) == "Decision") & (round_ != distance), "decision_round"),
        F.when(~((winner == a) | (winner == b)), "winner"),
    ]
    return F.filter(F.array(*issues), lambda x: x.isNotNull())
