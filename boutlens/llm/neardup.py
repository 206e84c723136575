"""Near-duplicate documents by HyperMinHash.

1. A document's set holds its distinct word shingles as 64-bit hashes. Documents with equal sets form a class at once, by
   one grouped aggregation; everything after works on one text of each class, under the class's number.
2. A hash deals the shingles to BANDS * ROWS buckets; a bucket's register is its smallest hash, compressed to the
   leading-zero count and MANTISSA bits. Buckets that stay empty, as in short texts, are filled by another hash of all
   shingles, and so on: a register belongs to the first round that hits its bucket, so two sets agree on it with the
   chance of their Jaccard similarity at any length. Runs of ROWS registers are banded: documents that agree on a band meet.
3. In a bucket all meet its smallest document, not each other: as many pairs as members. Pairs are estimated from the
   registers, corrected for the chance that unequal minima compress alike; those far below the threshold go. The others
   are verified on the full sets of both texts. Linked documents are joined to components.
4. Buckets that still hold several components get other meeting points, a few times. At the end, for the members of
   different components in a bucket, all pairs that the registers allow are verified, so no link of a bucket is lost.
   A pair at the threshold misses all bands with a probability of (1 - j^ROWS)^BANDS: 3e-6 at 0.8, 7e-9 at 0.85.

Defined results: a text without words (null, empty) has an empty set and is linked with nothing. With fewer words than
a shingle has, the whole sequence is the one shingle. Rows of equal id count as one document, linked by every link of any
of its texts. A null id is linked with nothing, and its component is null. Ids are whole numbers; other columns are not read. Words are parted by the bytes 9 to 13 and 32; A-Z count as
a-z.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, packed, row_key, small, text_batches, unpacked

SHINGLE, THRESHOLD = 5, 80
ROWS, BANDS, MANTISSA = 5, 32, 10
#: Standard errors of the estimate below the threshold at which a pair goes unverified.
MARGIN = 4.5
#: Rounds with other meeting points.
MEETINGS = 1
#: Edges in a task of the search for components, at least.
ROWS_PER_TASK = 100_000
#: Members of a bucket that a task of the last comparison holds of either side.
SPLIT = 256
#: Registers of one byte in the finer sketch of the documents that are still in question at the end; 8 to a number.
FINE = 768

#: Buckets of several rounds that are held at once.
CELLS = 100_000
EMPTY = np.uint64(np.iinfo(np.uint64).max)
LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)  # odd multipliers


class Words(dict):
    """64-bit hashes of words, kept for the next texts."""

    LIMIT = 200_000

    def __missing__(self, word: bytes) -> int:
        if len(self) > self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _B
    return x ^ (x >> np.uint64(29))


def shingles(text: bytes | None, size: int, words: Words) -> np.ndarray:
    """Sorted distinct hashes of the word shingles."""
    found = (text or b"").translate(LOWER).split()  # splits at the bytes 9 to 13 and 32
    if not found:
        return np.empty(0, np.uint64)
    codes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    size = min(size, len(found))
    value = codes[: len(codes) - size + 1] * _A
    for k in range(1, size):
        value = mixed(value + codes[k : len(codes) - size + 1 + k]) * _A
    return np.unique(mixed(value + np.uint64(size)))


def registers(hashes: np.ndarray, buckets: int, mantissa: int = MANTISSA) -> np.ndarray:
    """Per bucket the leading zeros and the next bits of its smallest hash, in 16 bits; ``hashes`` are distinct."""
    low, turn = np.full(buckets, EMPTY), np.zeros(buckets, np.uint64)
    size, done = np.uint64(buckets), 0
    # so many rounds at once that hardly any bucket stays empty, within a megabyte
    rounds = min(-(-8 * buckets // len(hashes)), max(1, CELLS // buckets))
    while (open_ := low == EMPTY).any():
        numbers = np.arange(done, done + rounds, dtype=np.uint64)
        by = mixed(numbers * _A) | np.uint64(1)  # a multiplier for each round
        value = mixed(hashes[None, :] * by[:, None])
        bucket = value % size
        found = np.full((rounds, buckets), EMPTY)
        np.minimum.at(found.ravel(), (bucket + np.arange(rounds, dtype=np.uint64)[:, None] * size).ravel().astype(np.int64), (value - bucket).ravel())
        first = (found < EMPTY).argmax(axis=0)
        low[open_], turn[open_] = found[first, np.arange(buckets)][open_], numbers[first][open_]
        done += rounds
    part, exponent = np.frexp(np.maximum(low, 1).astype(np.float64))
    bits = np.minimum(((part * 2 - 1) * (1 << mantissa)).astype(np.int64), (1 << mantissa) - 1)
    # registers of different rounds agree no more often than by chance
    return (np.clip(64 - exponent, 0, 63) << mantissa | bits).astype(np.uint16) ^ (mixed(turn * _A) >> np.uint64(48)).astype(np.uint16)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ``rows`` rows, so that little is held at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


#: Four registers to a number.
LANES = 4
SKETCH = "id long, text_key long, n_shingles long, set1 long, set2 long, registers array<long>, bands array<long>"


def text_key(text_col: str) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(F.col(text_col).cast("string")).alias("text_key")


def sketches(docs: DataFrame, id_col: str, text_col: str, shingle: int, rows: int, bands: int) -> DataFrame:
    if rows * bands % LANES:
        raise ValueError(f"the number of registers must be a multiple of {LANES}")
    source = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col), F.col(text_col).cast("string").cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        for batch in slices(batches):
            out = []
            with np.errstate(over="ignore"):
                for text in batch.column("text").to_pylist():
                    found = shingles(text, shingle, words)
                    if not len(found):
                        out.append((0, None, None, None, None))
                        continue
                    whole = xxhash.xxh3_128_intdigest(found.tobytes())
                    data = registers(found, rows * bands).tobytes()
                    step = 2 * rows
                    keys = [signed(xxhash.xxh3_64_intdigest(data[k * step : k * step + step], seed=k)) for k in range(bands)]
                    lanes = np.frombuffer(data, "<i8").tolist()
                    out.append((len(found), signed(whole >> 64), signed(whole & (1 << 64) - 1), lanes, keys))
            types = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            columns = zip(*out) if out else [()] * 5
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_key"), *(pa.array(list(c), t) for c, t in zip(columns, types))],
                names=["id", "text_key", "n_shingles", "set1", "set2", "registers", "bands"],
            )

    return source.mapInArrow(run, SKETCH)


def equal_registers(left: Column, right: Column, lanes: int = LANES) -> Column:
    """How many registers of two arrays of ``lanes`` registers to a number are equal."""
    low = sum(1 << (64 // lanes * k) for k in range(lanes))

    def differ(x: Column, y: Column) -> Column:
        # folds each lane onto its lowest bit
        bits, shift = x.bitwiseXOR(y), 32 // lanes
        while shift:
            bits, shift = bits.bitwiseOR(F.shiftrightunsigned(bits, shift)), shift // 2
        return F.bit_count(bits.bitwiseAND(F.lit(low)))

    unequal = F.aggregate(F.zip_with(left, right, differ), F.lit(0), lambda acc, n: acc + n)
    return F.size(left) * lanes - unequal


def chance_equal(n: Column, m: Column, mantissa: int = MANTISSA) -> Column:
    """How likely the registers of two disjoint sets with so many hashes in a bucket are equal: the same zeros, then the
    same bits."""
    power = lambda zeros: F.pow(F.lit(0.5), zeros.cast("double"))
    has = lambda size, z: F.pow(1 - power(z + 1), size) - F.pow(1 - power(z), size)
    both = F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0.0), lambda acc, z: acc + has(n, z) * has(m, z))
    return both / (1 << mantissa)


def estimated(left: Column, right: Column, n: Column, m: Column) -> Column:
    """Collision-corrected Jaccard similarity from two register columns and the set sizes."""
    buckets = F.size(left) * LANES
    chance = chance_equal(*[F.greatest(x / buckets, F.lit(1.0)) for x in (n, m)])
    share = equal_registers(left, right) / buckets
    return F.greatest((share - chance) / (1 - chance), F.lit(0.0))


def least_estimate(registers: int, threshold: int, margin: float) -> float:
    """The estimate below which a pair goes unverified."""
    j = threshold / 100
    return j - margin * (j * (1 - j) / registers) ** 0.5


def verified(pairs: DataFrame, shingle: int, threshold: int) -> DataFrame:
    """The pairs (a, b, ta, tb) with 100 * intersection >= threshold * union on the full sets of both texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        last: tuple[bytes | None, np.ndarray] = (None, np.empty(0, np.uint64))
        with np.errstate(over="ignore"):
            for part in slices(batches):
                keep = []
                for x, y in zip(part.column("ta").to_pylist(), part.column("tb").to_pylist()):
                    if last[0] is None or last[0] != x:  # a meeting point comes with many partners in a row
                        last = (x, shingles(x, shingle, words))
                    a, b = last[1], shingles(y, shingle, words)
                    both = len(np.intersect1d(a, b, assume_unique=True))
                    keep.append(100 * both >= threshold * (len(a) + len(b) - both))
                mask = pa.array(keep, pa.bool_())
                yield pa.RecordBatch.from_arrays([part.column(c).filter(mask) for c in ("a", "b")], names=["a", "b"])

    return pairs.select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of all nodes on ``edges`` (a, b): the smallest node reachable.

    Each round links the larger neighbours of every node to its smallest neighbour, then the smaller ones, until only
    stars are left; the number of rounds grows with the logarithm of the longest path. Edges are narrow rows, and a
    node's neighbours are only ever aggregated.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct())
    parts, before = max(1, edges.count() // ROWS_PER_TASK), None
    fit = lambda df: df.coalesce(parts)  # noqa: E731  few rows don't need a file for each of many partitions
    edges = fit(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = fit(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low")))
        large = fit(both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("low").alias("b")).filter("a != b"))
        large = fit(large.distinct())
        low = fit(large.groupBy("a").agg(F.min("b").alias("low")))
        joined = fit(large.join(low, "a"))
        small_ = joined.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        edges = cut(fit(small_.filter("a != b").distinct()))
        state = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


@dataclass
class Texts:
    """The texts of the classes. ``keys`` (id, the class's number; of and text_key, which row of ``docs`` stands for it); None where every
    id has one row, and a class is named by an id."""

    docs: DataFrame
    keys: DataFrame | None

    def of(self, ids: DataFrame) -> DataFrame:
        """(id, text) of the classes in ``ids``, each once."""
        if self.keys is None:
            return self.docs.join(small(ids.withColumnRenamed("id", "of")), "of", "left_semi").select(F.col("of").alias("id"), "text")
        wanted = self.docs.join(small(cut(self.keys.join(ids, "id", "left_semi"))), ["of", "text_key"])
        return wanted.select("id", "text").dropDuplicates(["id"])  # rows that stand repeatedly in the table are one


def verify(pairs: DataFrame, reps: DataFrame, texts: Texts, shingle: int, threshold: int, least: float) -> DataFrame:
    """The pairs (a, b) that pass the estimate and the exact test."""
    left = reps.select(F.col("id").alias("a"), F.col("registers").alias("ra"), F.col("n_shingles").alias("na"))
    right = reps.select(F.col("id").alias("b"), F.col("registers").alias("rb"), F.col("n_shingles").alias("nb"))
    sized = pairs.join(left, "a").join(right, "b").filter(100 * F.least("na", "nb") >= threshold * F.greatest("na", "nb"))
    estimate = estimated(F.col("ra"), F.col("rb"), F.col("na"), F.col("nb"))
    likely = cut(sized.filter(estimate >= least).select("a", "b"))
    ids = likely.select(F.col("a").alias("id")).unionByName(likely.select(F.col("b").alias("id"))).distinct()
    wanted = texts.of(ids)
    with_b = likely.join(wanted.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    with_a = with_b.join(wanted.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a")
    return cut(verified(with_a, shingle, threshold))


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, threshold: int = THRESHOLD,
    rows: int = ROWS, bands: int = BANDS, margin: float = MARGIN, meetings: int = MEETINGS,
) -> DataFrame:
    """Per row: doc_id, n_shingles, class_id (smallest id with an equal set), component_id, kept."""
    text_batches(docs.sparkSession)
    least = least_estimate(rows * bands, threshold, margin)
    sketch = cut(sketches(docs, id_col, text_col, shingle, rows, bands))
    full = sketch.filter("id IS NOT NULL AND n_shingles > 0")
    sets = ["n_shingles", "set1", "set2"]
    # a class is represented by the smallest of its rows; an id of several rows can have several sets, each in a class of its own
    single = full.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").isEmpty()
    classes = full.groupBy(*sets).agg(F.min(F.struct("id", "text_key")).alias("of"))
    number = F.col("of.id") if single else F.monotonically_increasing_id()
    classes = cut(classes.select(number.alias("node"), *sets, F.col("of.id").alias("class_id"), "of.text_key"))
    member = cut(full.select("id", *sets).join(classes.select(*sets, "class_id"), sets).select("id", "class_id").distinct())
    if single:
        keys, held = None, full.join(classes.select(F.col("node").alias("id")), "id", "left_semi")
    else:
        keys = classes.select(F.col("node").alias("id"), F.col("class_id").alias("of"), "text_key")
        held = full.join(classes.withColumnRenamed("class_id", "id"), [*sets, "id", "text_key"]).dropDuplicates(["node"]).withColumn("id", F.col("node"))
    reps = cut(held.select("id", "n_shingles", "registers", "bands"))
    text = F.col(text_col).cast("string").cast("binary")
    texts = Texts(docs.select(F.col(id_col).cast("long").alias("of"), text_key(text_col), text.alias("text")), keys)

    buckets = reps.select("id", F.posexplode("bands").alias("band", "key"))
    shared = buckets.groupBy("band", "key").agg(F.count("*").alias("members"), F.min("id").alias("meet")).filter("members > 1")
    buckets = cut(buckets.join(shared, ["band", "key"]).select("id", "key", "band", "meet"))
    pairs = buckets.filter("id != meet").select(F.col("meet").alias("a"), F.col("id").alias("b")).distinct()
    tested = cut(pairs)
    same = member.filter("id != class_id").select(F.col("class_id").alias("a"), F.col("id").alias("b"))
    links = verify(tested, reps, texts, shingle, threshold, least)
    found = components(links)
    for meeting in range(1, meetings + 2):
        known = buckets.join(found, F.col("id") == F.col("node"), "left").withColumn("component", F.coalesce("component", "id"))
        known = known.select("id", "key", "band", "component")
        mixed_ = known.groupBy("band", "key").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.min(F.struct(F.xxhash64(F.lit(meeting), "id", "key").alias("h"), F.col("id").alias("meet"), F.col("component").alias("of"))).alias("m"),
        ).filter("low != high")
        known = cut(known.join(mixed_.select("band", "key", "m.meet", "m.of"), ["band", "key"]))
        if meeting <= meetings:
            new = known.filter("component != of").select(F.least("meet", "id").alias("a"), F.greatest("meet", "id").alias("b"))
        else:
            new = allowed_pairs(known, reps, texts, shingle, threshold, margin)
        new = cut(new.distinct().join(tested.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"))
        if not new.limit(1).count():
            continue
        tested = tested.unionByName(new)
        more = verify(new, reps, texts, shingle, threshold, least)
        if more.limit(1).count():
            links = links.unionByName(more)
            found = components(links)
    if keys is not None:  # back from classes to ids
        name = lambda c: keys.select(F.col("id").alias(c), F.col("of").alias(f"{c}_id"))
        links = links.join(name("a"), "a").join(name("b"), "b").select(F.col("a_id").alias("a"), F.col("b_id").alias("b"))
    # the classes' other members come in at the end, as stars
    found = components(links.unionByName(same))
    joined = sketch.join(found, F.col("id") == F.col("node"), "left").join(
        member.groupBy("id").agg(F.min("class_id").alias("class_id")), "id", "left"
    )
    component = F.coalesce("component", "id")
    return joined.select(
        F.col("id").alias("doc_id"), "n_shingles", F.coalesce("class_id", "id").alias("class_id"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"),
    )


def shared_sizes(ids: DataFrame, texts: Texts, shingle: int) -> DataFrame:
    """(id, shared): how many shingles of each text in ``ids`` stand in another one of them too."""
    wanted = texts.of(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        with np.errstate(over="ignore"):
            for part in slices(batches, 64):
                sets = [shingles(t, shingle, words).view(np.int64) for t in part.column("text").to_pylist()]
                at = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
                hashes = np.concatenate(sets) if sets else np.empty(0, np.int64)
                yield pa.RecordBatch.from_arrays([part.column("id").take(pa.array(at, pa.int64())), pa.array(hashes, pa.int64())], names=["id", "hash"])

    held = wanted.mapInArrow(run, "id long, hash long").groupBy("hash").agg(F.count("*").alias("n"), F.min("id").alias("id"))
    alone = held.filter("n = 1").groupBy("id").agg(F.count("*").alias("alone"))
    return ids.join(alone, "id", "left").select("id", F.coalesce("alone", F.lit(0)).alias("alone"))


def fine_sketches(ids: DataFrame, texts: Texts, shingle: int) -> DataFrame:
    """(id, fine): FINE registers of each text in ``ids``, folded to a byte each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        with np.errstate(over="ignore"):
            for batch in slices(batches):
                made = []
                for text in batch.column("text").to_pylist():
                    wide = registers(shingles(text, shingle, words), FINE).astype(np.uint32)
                    made.append(((wide * np.uint32(0x9E3779B1)) >> np.uint32(24)).astype(np.uint8).view("<i8").tolist())
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(made, pa.list_(pa.int64()))], names=["id", "fine"])

    return texts.of(ids).mapInArrow(run, "id long, fine array<long>")


def allowed_pairs(known: DataFrame, reps: DataFrame, texts: Texts, shingle: int, threshold: int, margin: float) -> DataFrame:
    """All pairs of different components within a bucket that a finer sketch and unshared shingles allow to be linked.

    The shingles that a text shares with no other one in question are counted exactly: what two texts have in common is
    at most what either shares with any, so the smaller of these bounds their similarity. The conditions stand in the
    join itself, and a pair comes from the first bucket it shares: only allowed pairs come out, each once.
    """
    ids = cut(known.select("id").distinct())
    shared = cut(shared_sizes(ids, texts, shingle))
    data = reps.join(small(shared), "id").select("id", "n_shingles", (F.col("n_shingles") - F.col("alone")).alias("shared"), "bands")
    # a text with too few shared shingles for any partner is done: a partner has at least as many as both share
    data = data.filter(100 * F.col("shared") >= threshold * F.col("n_shingles"))
    member = known.select("id", "band", "key", "component").join(small(data.select("id")), "id", "left_semi")
    still = member.groupBy("band", "key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"), F.ceil(F.count("*") / SPLIT).alias("parts")
    ).filter("low != high")
    member = cut(member.join(still.select("band", "key", "parts"), ["band", "key"]))
    fine = fine_sketches(cut(member.select("id").distinct()), texts, shingle)
    cols = ("id", "component", "n_shingles", "shared", "bands", "fine")
    wide = member.join(cut(data.join(fine, "id")), "id")
    # a large bucket is cut: each of its parts on the left meets a copy of the others
    own = F.pmod(F.xxhash64("id"), "parts").alias("part")
    a = wide.select("band", "key", own, *[F.col(c).alias(f"{c}_a") for c in cols])
    b = wide.select("band", "key", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1)).alias("part"), *[F.col(c).alias(f"{c}_b") for c in cols])
    both = F.least("shared_a", "shared_b")
    bounded = 100 * both >= threshold * (F.col("n_shingles_a") + F.col("n_shingles_b") - both)
    apart = (F.col("id_a") < F.col("id_b")) & (F.col("component_a") != F.col("component_b"))
    # without the correction an estimate is only higher: nothing that the correction allows is lost
    likely = equal_registers(F.col("fine_a"), F.col("fine_b"), 8) >= FINE * F.lit(least_estimate(FINE, threshold, margin))
    first = F.array_position(F.zip_with("bands_a", "bands_b", lambda x, y: x == y), True) == a["band"] + 1
    met = (a["band"] == b["band"]) & (a["key"] == b["key"]) & (a["part"] == b["part"])
    return a.join(b, met & apart & bounded & likely & first).select(F.col("id_a").alias("a"), F.col("id_b").alias("b"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that stand for their component: one document of each. Rows of a null id stay; of rows with one id
    and equal texts one stays, different texts under one id all stay."""
    judged = near_duplicates(docs, id_col, text_col, **how)
    kept = cut(judged.filter("kept AND doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__n")))
    gone = judged.filter("NOT kept").select(F.col("doc_id").alias("__id")).distinct()
    match = F.col("__of") == F.col("__id")
    rows = docs.select(packed(docs), F.col(id_col).cast("long").alias("__of"), *row_key(F.col(text_col))).join(small(gone), match, "left_anti")
    several = small(kept.filter("__n > 1").select("__id"))
    once, more = rows.join(several, match, "left_anti"), rows.join(several, match, "left_semi").dropDuplicates(["__of", "__key1", "__key2"])
    return unpacked(once.unionByName(more), docs.columns)
