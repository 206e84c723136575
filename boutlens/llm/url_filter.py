"""URL filters: a weighted vocabulary of strict and soft terms, counted by one Aho-Corasick pass per URL.

A term counts only where it is bounded: the characters beside it must not be ASCII letters or digits. One strict
term rejects a URL, and so do ``min_soft`` or more different soft terms whose weights sum to ``min_weight``: weak terms
need more company than strong ones. Rules for hosts and path prefixes, where given, come first: the longest that fits
decides; of two as long the one with the longer host, then ``allow``.

Defined results: a null URL, or one without ``://``, has an empty host and path, fits no rule and is judged on its
text alone (null: allowed). Repeated rows are judged alike; extra columns are kept as they are, but for one named
``judged``, which is replaced.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed

# The default vocabulary with weights.
STRICT = ("casino", "escorts", "malware", "phishing", "porn", "spam", "viagra", "warez", "xxx")
SOFT = {
    "adult": 1.0, "bet": 1.0, "bonus": 0.5, "buy": 0.5, "cheap": 1.0, "coupon": 0.5, "crack": 1.0, "dating": 1.0,
    "deal": 0.5, "discount": 0.5, "farm": 0.5, "free": 0.5, "hot": 0.5, "loan": 1.0, "pills": 1.0, "poker": 1.0,
    "sex": 1.5, "torrent": 1.0, "win": 0.5,
}
MIN_SOFT, MIN_WEIGHT = 2, 1.5

HITS = "strict array<string>, soft array<string>, weight double"


@lru_cache(maxsize=8)
def automaton(strict: tuple[str, ...], soft: tuple[tuple[str, float], ...]) -> ahocorasick.Automaton:
    built = ahocorasick.Automaton()
    for term, weight in soft:
        built.add_word(term.lower(), (term.lower(), weight, False))
    for term in strict:
        built.add_word(term.lower(), (term.lower(), 0.0, True))
    built.make_automaton()
    return built


def bounded(text: str, start: int, end: int) -> bool:
    """No ASCII letter or digit stands right before ``start`` or at ``end``."""
    return not (
        (start > 0 and text[start - 1].isascii() and text[start - 1].isalnum())
        or (end < len(text) and text[end].isascii() and text[end].isalnum())
    )


def url_terms(url: Column, strict: Sequence[str] = STRICT, soft: dict[str, float] | None = None) -> Column:
    """The distinct strict and soft terms of a URL, sorted, with the sum of the soft terms' weights."""
    words = tuple(strict), tuple(sorted((SOFT if soft is None else soft).items()))

    @F.pandas_udf(HITS)
    def hits(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        machine = automaton(*words)
        for urls in batches:
            rows = []
            for url in urls:
                found: dict[str, tuple[float, bool]] = {}
                text = (url or "").lower()
                for last, (term, weight, is_strict) in machine.iter(text) if len(machine) else ():
                    if bounded(text, last + 1 - len(term), last + 1):
                        found[term] = weight, is_strict
                rows.append((
                    sorted(t for t, (_, s) in found.items() if s),
                    sorted(t for t, (_, s) in found.items() if not s),
                    float(sum(w for w, s in found.values() if not s)),
                ))
            yield pd.DataFrame(rows, columns=["strict", "soft", "weight"])

    return hits(url)


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z in lower case."""
    rest = F.substring_index(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1), "/", 1)
    host = F.substring_index(F.substring_index(rest, "?", 1), "#", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule (host and path together; then the longer host) that fits, as a struct of rule and verdict."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r))
    none = F.lit(None).cast("string")
    chosen = F.struct(none.alias("rule"), none.alias("verdict"))
    for verdict, domain, prefix in reversed(ordered):
        fits = ((host == domain) | host.endswith("." + domain)) & path.startswith(prefix)
        chosen = F.when(
            fits, F.struct(F.lit(domain + prefix).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(chosen)
    return chosen


def filter_urls(
    df: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = (),
    strict: Sequence[str] = STRICT,
    soft: dict[str, float] | None = None,
    min_soft: int = MIN_SOFT,
    min_weight: float = MIN_WEIGHT,
) -> DataFrame:
    """Adds a struct ``judged`` (host, path, rule, strict, soft, weight, verdict) to every row."""
    text = df[url].cast("string")
    host, path = host_of(text), path_of(text)
    hits = df.select(packed(df.drop("judged")), host.alias("__host"), path.alias("__path"), url_terms(text, strict, soft).alias("__hits"))
    many = (F.size("__hits.soft") >= min_soft) & (F.col("__hits.weight") >= min_weight)
    bad = (F.size("__hits.strict") > 0) | many
    ruled = hits.withColumn("__rule", rule_for(F.col("__host"), F.col("__path"), rules))
    own = F.when(bad, F.lit("block")).otherwise(F.lit("allow"))
    return ruled.select(
        "row.*",
        F.struct(
            F.col("__host").alias("host"), F.col("__path").alias("path"), F.col("__rule.rule").alias("rule"),
            F.col("__hits.strict").alias("strict"), F.col("__hits.soft").alias("soft"),
            F.col("__hits.weight").alias("weight"),
            F.coalesce(F.col("__rule.verdict"), own).alias("verdict"),
        ).alias("judged"),
    )
