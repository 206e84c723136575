"""Contest tables derived from a star schema of orders: neighbouring lines of an order meet as two sides of a contest.

One SQL text serves Spark and any other engine that holds the same tables; the operators themselves are DataFrame code.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schema import STATS


def _stats(q: str, d: str, t: str) -> dict[str, str]:
    """The counts of a side from a line's quantity, discount and tax in whole numbers."""
    landed, attempted = f"({q} + {d})", f"({q} + {d} + {t} + 5)"
    found = {
        "knockdowns": f"{q} % 2", "significant_strikes_landed": landed, "significant_strikes_attempted": attempted,
        "total_strikes_landed": f"{landed} + 5", "total_strikes_attempted": f"{attempted} + 9", "takedowns_landed": t,
        "takedowns_attempted": f"{t} + {d}", "submission_attempts": f"{q} % 3", "reversals": f"{d} % 2",
        "control_time_seconds": f"{q} * 3",
    }
    for kind, x in (("landed", landed), ("attempted", attempted)):
        by = lambda n, x=x: f"CAST(floor({x} / {n}) AS INT)"
        found |= {f"significant_{p}_strikes_{kind}": by(n) for p, n in (("head", 2), ("body", 4), ("distance", 3), ("clinch", 5))}
        found[f"significant_leg_strikes_{kind}"] = f"{x} - {by(2)} - {by(4)}"
        found[f"significant_ground_strikes_{kind}"] = f"{x} - {by(3)} - {by(5)}"
    return found


def _side(side: str, key: str, q: str, d: str, t: str) -> str:
    stats = _stats(q, d, t)
    counts = ", ".join(f"CASE WHEN stats_available THEN CAST({stats[c]} AS INT) END AS fighter_{side}_{c}" for c in STATS)
    return f"{key} AS fighter_{side}_id, concat('Entity ', {key}) AS fighter_{side}_name, {counts}"


_KEYS = "l_linenumber, l_partkey, l_suppkey, l_extendedprice, l_quantity, l_discount, l_tax, l_shipdate, l_returnflag, l_linestatus"
_LEAD = ", ".join(f"lead({c}) OVER w AS b_{c[2:]}" for c in ("l_partkey", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_linestatus"))

CTES = {
    "numbered": f"""
        SELECT *, row_number() OVER w AS rn, {_LEAD} FROM lineitem
        WINDOW w AS (PARTITION BY l_orderkey ORDER BY {_KEYS})""",
    "met": """
        SELECT CAST(n.l_orderkey * 1000 + n.rn AS BIGINT) AS fight_id, CAST(o.o_orderdate AS DATE) AS event_date,
               l_partkey AS a_key, b_partkey AS b_key, CAST(l_quantity AS INT) AS qa, CAST(b_quantity AS INT) AS qb,
               CAST(round(100 * l_discount) AS INT) AS da, CAST(round(100 * b_discount) AS INT) AS db,
               CAST(round(100 * l_tax) AS INT) AS ta, CAST(round(100 * b_tax) AS INT) AS tb,
               CAST(round(l_extendedprice * 100) AS BIGINT) AS cents, l_linestatus = 'F' AS stats_available,
               CASE WHEN l_returnflag = 'R' AND b_returnflag = 'R' AND l_linestatus = 'F' AND b_linestatus = 'F' THEN 'no_contest'
                    WHEN l_quantity = b_quantity THEN 'draw' ELSE 'completed' END AS result,
               CASE WHEN l_quantity >= b_quantity THEN l_returnflag ELSE b_returnflag END AS flag
        FROM numbered n JOIN orders o ON n.l_orderkey = o.o_orderkey
        WHERE n.rn % 2 = 1 AND b_partkey IS NOT NULL AND l_partkey <> b_partkey""",
    "contests": f"""
        SELECT fight_id, CAST(event_date AS STRING) AS event_id, event_date,
               CAST(row_number() OVER (PARTITION BY event_date ORDER BY fight_id) AS INT) AS card_order,
               p_brand AS weight_class, result,
               CASE WHEN result = 'completed' THEN CASE WHEN qa > qb THEN a_key ELSE b_key END END AS winner_fighter_id,
               CASE WHEN result = 'no_contest' THEN 'Overturned' WHEN flag = 'R' THEN 'KO/TKO' WHEN flag = 'A' THEN 'Submission'
                    ELSE 'Decision - Unanimous' END AS method_of_victory,
               '3 Rnd (5-5-5)' AS time_format,
               CASE WHEN flag = 'N' THEN 3 ELSE 1 + qa % 3 END AS ending_round,
               CASE WHEN flag = 'N' THEN '5:00'
                    ELSE concat(CAST(cents % 5 AS STRING), ':', lpad(CAST(cents % 60 AS STRING), 2, '0')) END AS ending_time,
               stats_available, {_side("a", "a_key", "qa", "da", "ta")}, {_side("b", "b_key", "qb", "db", "tb")}
        FROM met JOIN part ON a_key = p_partkey""",
    "entities": """
        SELECT p_partkey AS fighter_id, concat('Entity ', p_partkey) AS fighter_name,
               CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE DATE '1960-01-01' + p_size * 200 END AS date_of_birth,
               60 + p_size % 20 AS height_inches, 50 + p_size AS reach_inches, p_type AS stance FROM part""",
    "cards": """
        SELECT event_id, concat('Card ', event_id) AS event_name, event_date, concat('http://cards.example/', event_id) AS event_url,
               CAST(count(*) AS INT) AS source_fight_count FROM contests GROUP BY event_id, event_date""",
    "rounds": "SELECT * FROM round_rows",
}


def _rounds() -> str:
    """All counts stand in the first round; later ones have zeros."""
    rows = []
    for me, other in (("a", "b"), ("b", "a")):
        counts = ", ".join(f"CASE WHEN r.round_number = 1 THEN fighter_{me}_{c} ELSE 0 END AS {c}" for c in STATS)
        rows.append(
            f"SELECT fight_id, CAST(r.round_number AS INT) AS round_number, fighter_{me}_id AS fighter_id, "
            f"fighter_{other}_id AS opponent_id, {counts} FROM contests "
            "JOIN (SELECT 1 AS round_number UNION ALL SELECT 2 UNION ALL SELECT 3) r ON r.round_number <= ending_round "
            "WHERE stats_available"
        )
    return " UNION ALL ".join(rows)


CTES["rounds"] = _rounds()
NEEDS = {
    "numbered": (), "met": ("numbered",), "contests": ("met",), "entities": (), "cards": ("contests",), "rounds": ("contests",),
}


def with_clause(*names: str) -> str:
    """``WITH`` of the named tables and what they need, in order."""
    needed: list[str] = []

    def add(name: str) -> None:
        for n in NEEDS[name]:
            add(n)
        if name not in needed:
            needed.append(name)

    for name in names:
        add(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in needed)


def _late_counts() -> str:
    """The contests with the counts of their sides made after the cards are numbered: Spark would sort and shuffle rows with all of them."""
    number = "CAST(row_number() OVER (PARTITION BY event_date ORDER BY fight_id) AS INT)"
    text = CTES["contests"].replace(f"{number} AS card_order", "card_order")
    return text.replace("FROM met JOIN part ON a_key = p_partkey", f"FROM (SELECT *, {number} AS card_order FROM (SELECT met.*, p_brand FROM met JOIN part ON a_key = p_partkey))")


def derived(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the derived tables as a DataFrame."""
    text = f"{with_clause(name)} SELECT * FROM {name}".replace(CTES["contests"], _late_counts())
    for source in ("lineitem", "orders", "part"):
        text = text.replace(f"FROM {source}", f"FROM {{{source}}}").replace(f"JOIN {source} ", f"JOIN {{{source}}} ")
    used = {s: spark.read.parquet(f"{sf_dir}/{s}.parquet") for s in ("lineitem", "orders", "part") if f"{{{s}}}" in text}
    return spark.sql(text, **used)


def rounds_of(contests: DataFrame) -> DataFrame:
    """The round rows of contests that are at hand already."""
    return contests.sparkSession.sql(CTES["rounds"].replace("FROM contests", "FROM {contests}"), contests=contests)
