"""Mixing sources to target weights, in DataFrame expressions only.

1. Every source's words, document after document in a pseudorandom order, are cut into blocks of ``block`` words.
2. Targets: the sources share all words by weight; a target stops at ``cap`` times its source's size, and the excess is
   shared again by weight. All targets come from one formula: min(cap * size, level * weight).
3. Every output shard of ``shard`` slots draws its source counts from a multinomial distribution with the sources'
   shares of all slots: each slot draws its source. Over all shards a source's draws differ from its quota by chance;
   those beyond it are void, and what it lacks stands in shards after the last, so each source gets its quota of slots.
4. A source's slots run through a pseudorandom permutation of its blocks (swap-or-not rounds, a new one for each pass),
   so a block is used at most once a pass and at most ``cap`` times in all; slots and blocks are joined by index.

The quota's last slot takes only the words that are missing, so the words taken are the target rounded down, less what
the source's last block lacks of a whole one if the unfinished pass draws that block: less than a block in all.

Defined results: a null or empty text has no words and takes part with size 0; a null source is a source of its own, the
last; repeated rows are documents of their own; rows of equal id are told apart by their text. Without words all
targets are 0 and nothing is taken. Reruns on the same rows give the same result, however they are partitioned.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE, WORD, cut, packed, small, unpacked

BLOCK, SHARD, CAP, ROUNDS, SEED = 128, 1024, 3, 12, 20240101
#: Slots drawn or placed in a task.
SLOTS = 100_000
#: Cells of the unit interval in which a draw looks for its source.
CELLS = 4096


def n_words(text: Column) -> Column:
    """Number of runs of other characters than space and the bytes 9 to 13: a run starts after each such character."""
    plain = F.trim(F.translate(F.coalesce(text, F.lit("")), SPACE, " " * len(SPACE)))
    return F.when(plain == "", F.lit(0)).otherwise(F.size(F.split(plain, " +"))).cast("long")


def uniform(*what: Column | str | int) -> Column:
    """A number in [0, 1) that depends on the arguments alone."""
    parts = [F.lit(x) if isinstance(x, int) else F.col(x) if isinstance(x, str) else x for x in what]
    return F.shiftrightunsigned(F.xxhash64(*parts), 11).cast("double") / F.lit(float(1 << 53))


def below(n: Column, *what: Column | str | int) -> Column:
    return F.least(F.floor(uniform(*what) * n).cast("long"), n - 1)


def permuted(index: Column, n: Column, *key: Column, rounds: int = ROUNDS) -> Column:
    """A pseudorandom permutation of 0 .. n-1 by swap-or-not rounds: each swaps an index with its partner or not."""

    def one(x: Column, r: Column) -> Column:
        partner = F.pmod(below(n, *key, r) - x, n)
        swap = F.xxhash64(*key, r, F.greatest(x, partner)) % 2 == 0
        return F.when(swap, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), index.cast("long"), one)


def running(df: DataFrame, keys: list[str], order: list[str], value: str, name: str, run: Column) -> DataFrame:
    """Adds ``name``: the sum of ``value`` over the rows before, by ``run`` and then ``order``, within ``keys``.

    Runs are summed first, so no window partition holds more than a run or one row for each run.
    """
    df = df.withColumn("__run", run)
    totals = df.groupBy(*keys, "__run").agg(F.sum(value).alias("__sum"))
    before = Window.partitionBy(*keys).orderBy("__run").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(*keys, "__run", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__base"))
    within = Window.partitionBy(*keys, "__run").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = df.withColumn("__within", F.coalesce(F.sum(value).over(within), F.lit(0)))
    return summed.join(totals, [*keys, "__run"]).withColumn(name, F.col("__base") + F.col("__within")).drop("__run", "__base", "__within")


def source_targets(sizes: DataFrame, weight: Callable[[Column], Column] | None = None, cap: float = CAP) -> DataFrame:
    """``sizes`` (source, source_size) with the columns rank, weight and target. One row for each source.

    ``weight`` gives a source's weight from its rank (from 0, by code point, null last); the default is 1, 2, 3, repeating.
    """
    weight = weight or (lambda rank: (rank % 3 + 1).cast("double"))
    ordered = sizes.withColumn("rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    ordered = ordered.withColumn("weight", weight(F.col("rank")))
    # those capped are the first by cap * size / weight, as many as lie below the level that the others then get
    limit = F.col("source_size") * cap
    by = Window.orderBy(F.col("__ratio"), "rank")
    everything = by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    earlier = by.rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum(limit).over(earlier), F.lit(0.0))) / (
        F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0))
    )
    found = ordered.withColumn("__ratio", limit / F.col("weight")).withColumn("__level", level)
    first = F.min(F.when(F.col("__ratio") >= F.col("__level"), F.struct("__ratio", "rank", "__level"))).over(everything)
    found = found.withColumn("__at", F.coalesce(first["__level"], F.lit(0.0)))
    target = F.least(limit.cast("double"), F.col("__at") * F.col("weight"))
    return found.withColumn("target", target).drop("__ratio", "__level", "__at")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weight: Callable[[Column], Column] | None = None,
    block: int = BLOCK,
    shard: int = SHARD,
    cap: int = CAP,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, sources, slots).

    documents: row_key, doc_id, source, size, start (words of its source before it). sources: source, source_size,
    rank, weight, target, blocks, quota (slots), tail (words of the last slot). slots: shard, place (in the shard),
    source, slot, block, words (how many of the block's it takes).
    """
    text = F.col(text_col).cast("string")
    sized = docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_words(text).alias("size"),
        F.xxhash64(F.lit(seed), F.col(id_col), text).alias("row_key"),
    )
    sized = cut(sized)  # one narrow row for each document: the texts are read once
    n = runs(sized.count())
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources = source_targets(sums, weight, cap)
    blocks = F.ceil(F.col("source_size") / block).cast("long")
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.floor(F.col("target")).cast("long") - passes * F.col("source_size")
    last = F.ceil(rest / block).cast("long")
    sources = sources.select(
        "*", blocks.alias("blocks"), (passes * blocks + last).alias("quota"),
        F.when(last > 0, rest - (last - 1) * block).otherwise(block).cast("long").alias("tail"),
    )
    sources = cut(sources)
    documents = running(
        sized.withColumn("source", F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))),
        ["source"], ["row_key", "doc_id"], "size", "start", F.pmod(F.col("row_key"), F.lit(n)),
    )
    documents = documents.withColumn("source", F.when(F.col("source") != "", F.substring("source", 2, 1 << 30)))
    return documents, sources, slots(sources, block, shard, seed)


def runs(rows: int) -> int:
    """Into how many runs ``rows`` are cut for a running sum: as many as rows in each."""
    return max(1, int(rows**0.5))


def slots(sources: DataFrame, block: int, shard: int, seed: int) -> DataFrame:
    """The slots of all shards: see :func:`mix`."""
    spark = sources.sparkSession
    total = int(sources.agg(F.coalesce(F.sum("quota"), F.lit(0))).first()[0])
    shards = -(-total // shard)
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // SLOTS))
    upto = F.sum("quota").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, 0))
    share = sources.select("rank", "quota", "blocks", "tail", upto.alias("upto"))
    share = cut(share)  # one row for each source

    # a slot's draw looks for its source among those that reach into its cell of the unit interval
    def cell(x: Column) -> Column:
        return F.least(F.floor(x * CELLS), F.lit(CELLS - 1)).cast("long")

    low, high = ((F.col("upto") - x) / F.lit(max(1, total)) for x in (F.col("quota"), F.lit(0)))
    edges = share.filter("quota > 0").select("rank", low.alias("low"), F.when(F.col("upto") == total, 2.0).otherwise(high).alias("high"))
    edges = edges.withColumn("cell", F.explode(F.sequence(cell(F.col("low")), cell(F.least(F.col("high"), F.lit(1.0))))))
    drawn = spark.range(0, shards * shard, 1, tasks).select(F.floor(F.col("id") / shard).alias("shard"), uniform(seed, "id").alias("u"))
    drawn = drawn.withColumn("cell", cell(F.col("u"))).join(small(cut(edges)), "cell")
    drawn = drawn.filter((F.col("u") >= F.col("low")) & (F.col("u") < F.col("high")))
    counts = cut(drawn.groupBy("shard", "rank").agg(F.count("*").alias("drawn")))

    # a source's slots before this shard's: a running sum of its draws; then what its quota lacks
    placed = running(counts, ["rank"], ["shard"], "drawn", "before", F.floor(F.col("shard") / runs(shards)))
    placed = placed.repartition(tasks, "shard", "rank")  # narrow rows: the slots are made behind this shuffle
    placed = placed.select("shard", "rank", F.explode(F.sequence(F.col("before"), F.col("before") + F.col("drawn") - 1)).alias("slot"))
    got = counts.groupBy("rank").agg(F.sum("drawn").alias("drawn"))
    lacking = share.join(got, "rank", "left").withColumn("have", F.coalesce("drawn", F.lit(0))).filter("have < quota")
    lacking = lacking.select(F.lit(None).cast("long").alias("shard"), "rank", F.explode(F.sequence(F.col("have"), F.col("quota") - 1)).alias("slot"))
    known = placed.unionByName(lacking).join(small(share), "rank").filter("slot < quota")
    at = permuted(F.col("slot") % F.col("blocks"), F.col("blocks"), F.lit(seed), F.col("rank"), F.floor(F.col("slot") / F.col("blocks")))
    spread = F.coalesce("shard", shards + F.floor(F.col("slot") / shard)).cast("long")
    known = known.select(
        spread.alias("shard"), "rank", "slot", at.alias("block"),
        F.when(F.col("slot") == F.col("quota") - 1, F.col("tail")).otherwise(F.lit(block)).cast("long").alias("words"),
    )
    return known.withColumn("place", F.xxhash64(F.lit(seed), "shard", "rank", "slot"))


def taken(documents: DataFrame, sources: DataFrame, slots: DataFrame, block: int = BLOCK) -> DataFrame:
    """``documents`` with target, source_size and taken: the words that the mix takes of each, repeats counted."""
    # how often each block is taken, and up to which word by its short slot: at most ``cap`` slots name a block
    uses = slots.groupBy("rank", "block").agg(
        F.count("*").alias("uses"), F.sum((F.col("words") < block).cast("long")).alias("short"),
        F.sum(F.when(F.col("words") < block, F.col("words")).otherwise(0)).alias("short_words"),
    )
    stats = sources.select(F.col("source").alias("of"), "rank", "source_size", "target")
    known = cut(documents.join(small(stats), F.col("source").eqNullSafe(F.col("of"))).drop("of"))  # one narrow row each
    start, end = F.col("start"), F.col("start") + F.col("size")
    pieces = known.filter("size > 0").select(
        "row_key", "doc_id", "rank", "start", "size",
        F.explode(F.sequence(F.floor(start / block), F.floor((end - 1) / block))).alias("block"),
    )
    lo, hi = F.greatest(start, F.col("block") * block), F.least(end, (F.col("block") + 1) * block)
    short_end = F.col("block") * block + F.col("short_words")
    words = (hi - lo) * (F.col("uses") - F.col("short")) + F.col("short") * F.greatest(F.least(hi, short_end) - lo, F.lit(0))
    per = pieces.join(uses, ["rank", "block"]).groupBy("rank", "start", "row_key").agg(F.sum(words).alias("taken"))
    full = known.join(per, ["rank", "start", "row_key"], "left")
    return full.select(
        "doc_id", "source", "size", "source_size", "target",
        F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long").alias("taken"),
    )


def mixed_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", block: int = BLOCK, **how
) -> DataFrame:
    """The words that the mix takes, as rows of ``docs``: one row for each document and use.

    The n-th row of a document holds, in its own order and with its white space, the words of those blocks that are
    taken n times or more. Documents without taken words go. A column ``n_chars``, if there is one, is counted anew.
    """
    documents, sources, slots_ = mix(docs, id_col, text_col, source_col, block=block, **how)
    stats = sources.select(F.col("source").alias("of"), "rank")
    known = documents.join(small(stats), F.col("source").eqNullSafe(F.col("of"))).filter("size > 0")
    start, end = F.col("start"), F.col("start") + F.col("size")
    pieces = known.select(
        "row_key", "rank", "start", "size",
        F.explode(F.sequence(F.floor(start / block), F.floor((end - 1) / block))).alias("block"),
    )
    used = pieces.join(slots_.select("rank", "block", "slot", "words"), ["rank", "block"])
    # the slots of a block in order are its uses: whole ones first, the short one last
    nth = F.row_number().over(Window.partitionBy("row_key", "rank", "block", "start").orderBy(F.col("words").desc(), "slot"))
    lo = F.greatest(start, F.col("block") * block) - start
    hi = F.least(end, F.col("block") * block + F.col("words")) - start
    used = used.withColumn("nth", nth).withColumn("lo", lo).withColumn("hi", hi).filter("hi > lo")
    wanted = used.groupBy("row_key", "rank", "start", "nth").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("__spans"))
    # rows of one id and text have one key, also in several sources: its copies are numbered by source, and meet their own spans
    copy = Window.partitionBy("row_key").orderBy("rank", "start")
    numbers = known.select("row_key", "rank", "start", F.row_number().over(copy).alias("__copy"))
    wanted = wanted.join(numbers, ["row_key", "rank", "start"])
    seed = how.get("seed", SEED)
    text = F.col(text_col).cast("string")
    key = F.xxhash64(F.lit(seed), F.col(id_col), text).alias("__key")
    keyed = docs.select(packed(docs), key, text.alias("__text"), F.col(source_col).cast("string").alias("__source"))
    again = known.groupBy("row_key").agg(F.count("*").alias("__copies")).filter("__copies > 1").select("row_key")
    once = keyed.join(small(again), F.col("__key") == F.col("row_key"), "left_anti").withColumn("__copy", F.lit(1))
    more = keyed.join(small(again), F.col("__key") == F.col("row_key"), "left_semi")
    more = more.withColumn("__copy", F.row_number().over(Window.partitionBy("__key").orderBy(F.col("__source").asc_nulls_last())))
    rows = once.unionByName(more).withColumnRenamed("__key", "row_key")
    found = rows.join(wanted.drop("rank", "start"), ["row_key", "__copy"])
    words = F.regexp_extract_all("__text", F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0))

    def joined(w: Column) -> Column:
        piece = lambda s: F.array_join(F.slice(w, s["lo"].cast("int") + 1, (s["hi"] - s["lo"]).cast("int")), "")
        return F.array_join(F.transform("__spans", piece), "")

    # bound as a lambda's variable, the words are found once and not for every span
    made = found.withColumn("__made", F.rtrim(F.transform(F.array(words), joined)[0]))
    changed = {text_col: F.col("__made")}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.length("__made").cast(docs.schema["n_chars"].dataType)
    return unpacked(made, docs.columns, **changed)
