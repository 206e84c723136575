"""Who beat whom: common opponents and chains of wins between two entities."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import checkpointed, dropped, written
from ..functions.scalars import recency_weight
from .perspectives import strict_cutoff


#: Entities with more contests than this are met in rows, not in sets.
LISTED = 2_000


def common_opponents(pairs: DataFrame, persp: DataFrame, listed: int = LISTED) -> DataFrame:
    """For each pair (a_id, b_id), the opponents both have met, with each side's results in order.

    Who is common is found among ids alone: the sets of both sides, or rows where an entity has more than ``listed`` contests. Results are
    made only for what was found.
    """
    asked = pairs.select("a_id", "b_id").distinct()
    counts = persp.groupBy("fighter_id").agg(F.count("*").alias("n"))
    many = checkpointed(counts.filter(F.col("n") > listed).select("fighter_id"))
    rows = None
    if many.limit(1).count():
        large = lambda s: many.select(F.col("fighter_id").alias(f"{s}_id"), F.lit(True).alias(f"__{s}"))
        marked = checkpointed(asked.join(large("a"), "a_id", "left").join(large("b"), "b_id", "left"))
        edges = persp.select("fighter_id", "opponent_id").distinct()
        end = lambda s: edges.withColumnRenamed("fighter_id", f"{s}_id")
        # rows start from the side that is not large
        met = lambda rows, first, then: rows.select("a_id", "b_id").join(end(first), f"{first}_id").join(end(then), [f"{then}_id", "opponent_id"], "left_semi")
        rows = met(marked.filter("__b"), "a", "b").unionByName(met(marked.filter("__a AND __b IS NULL"), "b", "a"))
        asked = marked.filter("__a IS NULL AND __b IS NULL").select("a_id", "b_id")
        persp_few = persp.join(many, "fighter_id", "left_anti")
    else:
        persp_few = persp
    sets = persp_few.groupBy("fighter_id").agg(F.collect_set("opponent_id").alias("met"))
    side = lambda s: sets.select(F.col("fighter_id").alias(f"{s}_id"), F.col("met").alias(f"{s}_met"))
    both = asked.join(side("a"), "a_id").join(side("b"), "b_id")
    found = both.select("a_id", "b_id", F.explode(F.array_intersect("a_met", "b_met")).alias("opponent_id"))
    found = checkpointed(found if rows is None else found.unionByName(rows.select(*found.columns)))
    ends = found.select(F.explode(F.array("a_id", "b_id")).alias("fighter_id"), "opponent_id").distinct()
    entry = F.struct("event_date", "fight_id", "bout_outcome")
    kept = persp.join(ends, ["fighter_id", "opponent_id"], "left_semi")
    results = checkpointed(kept.groupBy("fighter_id", "opponent_id").agg(F.array_sort(F.collect_list(entry)).alias("results")))
    of = lambda s: results.select(F.col("fighter_id").alias(f"{s}_id"), "opponent_id", F.col("results").alias(f"{s}_results"))
    return found.join(of("a"), ["a_id", "opponent_id"]).join(of("b"), ["b_id", "opponent_id"]).select("a_id", "b_id", "opponent_id", "a_results", "b_results")


def win_edges(persp: DataFrame, cutoff: str, half_life_days: float = 1095.75, finish_multiplier: float = 1.1) -> DataFrame:
    """An edge (winner, loser, fight_id, weight) for each win before the cutoff: later and finished ones weigh more."""
    wins = strict_cutoff(persp, cutoff).filter("bout_outcome = 'win'")
    age = F.datediff(F.lit(cutoff).cast("date"), "event_date")
    weight = recency_weight(age, F.col("method_of_victory"), half_life_days, finish_multiplier)
    return wins.select(F.col("fighter_id").alias("winner"), F.col("opponent_id").alias("loser"), "fight_id", weight.alias("weight"))


def steps(edges: DataFrame, forward: bool) -> DataFrame:
    """Edges as steps from ``at`` to ``__next``: from the winner on, or back from the loser."""
    here, there = ("winner", "loser") if forward else ("loser", "winner")
    return edges.select(F.col(here).alias("at"), F.col(there).alias("__next"), F.col("fight_id").alias("__f"), F.col("weight").alias("__w"))


def reached_sets(ends: DataFrame, edges: DataFrame, lengths: list[int], forward: bool) -> DataFrame:
    """(end, reached): the entities that simple chains of ``lengths`` wins from each of ``ends`` (end), or towards it, lead to."""
    step = steps(edges, forward).select("at", "__next").distinct()
    seen = ends.select("end", F.col("end").alias("at"), *[F.lit(None).cast(ends.schema["end"].dataType).alias(f"__{i}") for i in range(1, max(lengths))])
    found = [seen.select("end", "at")] if 0 in lengths else []
    for i in range(1, max(lengths, default=0) + 1):
        passed = [F.col("end"), F.col("at"), *[F.col(f"__{j}") for j in range(1, i - 1)]]
        on = seen.join(step, "at").filter(reduce(lambda x, y: x & y, [F.col("__next") != c for c in passed]))
        seen = on.select("end", F.col("__next").alias("at"), *[(F.col("at") if j == i - 1 else F.col(f"__{j}")).alias(f"__{j}") for j in range(1, max(lengths))])
        if i in lengths:
            found.append(seen.select("end", "at"))
    # rows of two ids go to their end as they are: sets made before the shuffle would hold little more than one id each
    return reduce(DataFrame.unionByName, found).repartition("end").groupBy("end").agg(F.collect_set("at").alias("reached"))


def chains_to(wanted: DataFrame, edges: DataFrame, length: int, forward: bool) -> DataFrame:
    """Simple chains of ``length`` wins from ``end`` to ``goal``, or back, of the rows ``wanted`` (end, goal: each once): end, goal, seen, fights
    (both in the order of the chain) and the product of the weights. The last step goes to the goal alone."""
    step = steps(edges, forward)
    kind = edges.schema["fight_id"].dataType.simpleString()
    chain = wanted.select("end", "goal", F.col("end").alias("at"), F.array("end").alias("seen"), F.array().cast(f"array<{kind}>").alias("fights"), F.lit(1.0).alias("product"))
    grown = lambda c, x: F.concat(c, F.array(x)) if forward else F.concat(F.array(x), c)
    if not length:
        return chain.filter("end = goal").drop("at")
    for i in range(1, length + 1):
        if i < length:
            on = chain.join(step, "at").filter(~F.array_contains("seen", F.col("__next")) & (F.col("__next") != F.col("goal")))
        else:
            on = chain.join(step.withColumn("goal", F.col("__next")), ["at", "goal"]).filter(~F.array_contains("seen", F.col("__next")))
        chain = on.select(
            "end", "goal", F.col("__next").alias("at"), grown(F.col("seen"), F.col("__next")).alias("seen"), grown(F.col("fights"), F.col("__f")).alias("fights"),
            (F.col("product") * F.col("__w")).alias("product"),
        )
    return chain.drop("at")


def paths(pairs: DataFrame, edges: DataFrame, max_depth: int = 3, kept: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """All simple chains from ``start`` to ``target`` of at most ``max_depth`` wins; rematches are edges of their own. No chain is left out.

    Chains grow from both ends, once for each end and not for each pair, and meet in the middle: half of the steps from the
    start and half from the target, where they share no other entity. Where a pair's halves meet is found first, among the sets of
    entities that they reach; chains are made only to there, so no pair carries the chains of its ends.

    Chains of each length of the second half are made by themselves. ``kept`` says what is kept of them (:func:`win_paths` keeps sums,
    the heaviest few of a pair are enough for :func:`strongest_paths`); it is written before the next ones are made.
    """
    if not 1 <= max_depth <= 5:
        raise ValueError("max_depth must be 1..5")
    pairs = written(pairs.select("start", "target").distinct())
    starts, targets = (pairs.select(F.col(c).alias("end")).distinct() for c in ("start", "target"))
    found = []
    for back in range(max_depth // 2 + 1):
        lengths = [d - back for d in (2 * back, 2 * back + 1) if 1 <= d <= max_depth]
        ends = reached_sets(targets, edges, [back], False).select(F.col("end").alias("target"), F.col("reached").alias("__ends"))
        reached = reached_sets(starts, edges, lengths, True).select(F.col("end").alias("start"), F.col("reached").alias("__reached"))
        # a chain that has met the target goes no further
        meet = written(pairs.join(ends, "target").join(reached, "start").select("start", "target", F.explode(F.array_intersect("__ends", "__reached")).alias("at")))
        wanted = lambda c: meet.select(F.col(c).alias("end"), F.col("at").alias("goal")).distinct()  # noqa: B023, E731
        heads = [chains_to(wanted("start"), edges, n, True).withColumn("depth", F.lit(n + back)) for n in lengths]
        head = reduce(DataFrame.unionByName, heads).withColumnsRenamed({"end": "start", "goal": "at"})
        tail = chains_to(wanted("target"), edges, back, False).select(
            F.col("end").alias("target"), F.col("goal").alias("at"), F.col("seen").alias("__seen"), F.col("fights").alias("__fights"), F.col("product").alias("__product"))
        met = head.join(meet.join(tail, ["target", "at"]), ["start", "at"]).filter(F.size(F.array_intersect("seen", "__seen")) == 1)
        part = met.select(
            "start", "target", F.concat("seen", F.slice("__seen", 2, max_depth + 1)).alias("entities"), F.concat("fights", "__fights").alias("fights"),
            (F.col("product") * F.col("__product") / (F.col("depth") * F.col("depth"))).alias("weight"),
        )
        if kept is not None:
            part = written(kept(part))
            dropped(meet)
        found.append(part)
    return reduce(DataFrame.unionByName, found)


def strongest_paths(found: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` heaviest chains of each (start, target), by twelve digits of the weight; ties go by their contests."""
    order = Window.partitionBy("start", "target").orderBy(F.round("weight", 12).desc(), "fights")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def win_paths(pairs: DataFrame, persp: DataFrame, cutoff: str, max_depth: int = 3, half_life_days: float = 1095.75, finish_multiplier: float = 1.1) -> DataFrame:
    """For each pair (a_id, b_id): path counts and weighted scores both ways, and whether they contradict each other."""
    if half_life_days <= 0 or not 1 <= finish_multiplier <= 1.5:
        raise ValueError("half_life_days must be positive and finish_multiplier 1..1.5")
    pairs = pairs.select("a_id", "b_id").distinct()
    both = pairs.select(F.col("a_id").alias("start"), F.col("b_id").alias("target")).union(pairs.select("b_id", "a_id")).distinct()
    sums = lambda found: found.groupBy("start", "target").agg(F.count("*").alias("n"), F.sum("weight").alias("score"))
    found = paths(both, written(win_edges(persp, cutoff, half_life_days, finish_multiplier)), max_depth, sums)  # read for each step
    sums = found.groupBy("start", "target").agg(F.sum("n").alias("n"), F.sum("score").alias("score"))
    ab = sums.select(F.col("start").alias("a_id"), F.col("target").alias("b_id"), F.col("n").alias("a_to_b_paths"), F.col("score").alias("a_to_b_score"))
    ba = sums.select(F.col("target").alias("a_id"), F.col("start").alias("b_id"), F.col("n").alias("b_to_a_paths"), F.col("score").alias("b_to_a_score"))
    df = pairs.join(ab, ["a_id", "b_id"], "left").join(ba, ["a_id", "b_id"], "left").na.fill(0)
    return df.withColumn("conflict", (F.col("a_to_b_paths") > 0) & (F.col("b_to_a_paths") > 0))
