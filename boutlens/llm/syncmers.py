"""Document fingerprints of closed syncmers.

A k-mer of code points is a closed syncmer if its smallest inner s-mer (by hash) stands at the k-mer's first or last
place. Whether a k-mer is chosen depends on its own characters alone, so an edit changes only the anchors that
overlap it. A fingerprint lists every anchor of the whole text in order, in 16 hexadecimal digits each: 40 bits of hash and
24 bits of gap, the code points since the last anchor. Every run of 2k - s - 1 code points holds a closed syncmer, so gaps
are below that number; a shorter text without any has one anchor, of all its characters.

Likeness matches anchors by position: anchors with equal hashes vote for the shift between their places, and the
share of anchors that agree with the best shift (within ``slack``), as a Dice coefficient, is the likeness.

Defined results: a null text is empty; an empty text has an empty fingerprint; two empty ones have likeness 1, an
empty and another 0. Equal texts have equal fingerprints. Repeated rows are documents of their own, which follow each other;
rows of equal id go by a hash of the text, a null id comes after all others. Other columns than the id and the text are
not read. Ids are whole numbers.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, partitions, text_batches

#: k-mers of K code points with inner s-mers of S: about one anchor in 8 code points, and one for sure in 38.
K, S = 24, 9
SLACK = 8

_MULTIPLY, _STEP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)  # odd multipliers


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * _STEP
    return x ^ (x >> np.uint64(29))


def windows(codes: np.ndarray, length: int) -> np.ndarray:
    """A hash of every run of ``length`` values, by doubling: equal runs have equal hashes."""
    total, have, power, done = None, 1, _MULTIPLY, codes
    left, size = length, 0
    while True:
        if left & 1:
            if total is None:
                total, size = done, have
            else:
                n = len(done) - size
                total = total[:n] * power + done[size : size + n] if n > 0 else done[:0]
                size += have
        left >>= 1
        if not left:
            return mixed(total[: max(0, len(codes) - length + 1)])
        n = len(done) - have
        done = done[:n] * power + done[have:] if n > 0 else done[:0]
        power, have = power * power, have * 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have, low = 1, values
    while have * 2 <= width:
        low, have = np.minimum(low[:-have], low[have:]), have * 2
    rest = width - have
    return np.minimum(low[: len(low) - rest], low[rest:]) if rest else low


def whole(text: str) -> tuple[np.ndarray, np.ndarray]:
    """One anchor of all characters; none of an empty text."""
    digest = hashlib.sha256(text.encode("utf-8", "surrogatepass")).digest()[:5]
    return np.array([int.from_bytes(digest, "big")] if text else [], np.uint64), np.zeros(min(len(text), 1), np.int64)


def anchors(text: str, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (40 bits) and places of the closed syncmers; only an empty text has none."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    if len(codes) < k:
        return whole(text)
    with np.errstate(over="ignore"):
        inner = windows(codes, s)
        low, span = sliding_min(inner, k - s + 1), k - s
        n = len(codes) - k + 1
        at = np.flatnonzero((inner[:n] == low[:n]) | (inner[span : span + n] == low[:n]))
        if not len(at):
            return whole(text)
        # the s-mers at both edges and three within tell one k-mer from another
        parts = [inner[at + step] for step in (0, span // 4, span // 2, 3 * span // 4, span)]
        value = parts[0]
        for part in parts[1:]:
            value = mixed(value * _MULTIPLY + part)
    return value >> np.uint64(24), at.astype(np.int64)


def written(hashes: np.ndarray, places: np.ndarray) -> str:
    gaps = np.diff(places, prepend=0).astype(np.uint64)  # below 2k - s - 1
    return ((hashes << np.uint64(24)) | gaps).astype(">u8").tobytes().hex()


def parsed(fingerprint: str) -> tuple[np.ndarray, np.ndarray]:
    values = np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)
    return values >> np.uint64(24), np.cumsum((values & np.uint64((1 << 24) - 1)).astype(np.int64))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], slack: int = SLACK) -> float:
    """Dice coefficient of the anchors that agree with the commonest shift; an anchor counts once."""
    (ha, pa), (hb, pb) = a, b
    if not len(ha) or not len(hb):
        return float(len(ha) == len(hb))
    if len(ha) == len(hb) and np.array_equal(ha, hb) and np.array_equal(pa, pb):
        return 1.0
    # the n-th place of a hash in one text meets its n-th place in the other: no more pairs than anchors
    pairs = []
    for hashes, places in (a, b):
        order = np.lexsort((places, hashes))
        h = hashes[order]
        first = np.r_[True, h[1:] != h[:-1]]
        nth = np.arange(len(h)) - np.maximum.accumulate(np.where(first, np.arange(len(h)), 0))
        pairs.append((h, nth, places[order]))
    (ka, na, xa), (kb, nb, xb) = pairs
    at = np.searchsorted(kb, ka)
    place = at + na
    ok = place < len(kb)
    ok[ok] &= (kb[place[ok]] == ka[ok]) & (nb[place[ok]] == na[ok])
    shifts = np.sort(xb[place[ok]] - xa[ok])
    if not len(shifts):
        return 0.0
    best = (np.searchsorted(shifts, shifts + slack, "right") - np.arange(len(shifts))).max()
    return float(2 * best / (len(ha) + len(hb)))


def fingerprint(text: Column, k: int = K, s: int = S) -> Column:
    @F.pandas_udf("string")
    def make(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: written(*anchors(t or "", k, s)))

    return make(text)


def similarity(a: Column, b: Column, slack: int = SLACK) -> Column:
    """Likeness of two fingerprint columns, 0 to 1; null if either is null."""

    @F.pandas_udf("double")
    def compare(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series(
            [None if p is None or q is None else likeness(parsed(p), parsed(q), slack) for p, q in zip(x, y)],
            dtype="float64",
        )

    return compare(a, b)


#: Parts of the ids' order for each partition.
PARTS = 4


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, h, text, part, after) of all rows and, once more, of each part's successor with ``after`` true.

    Rows go by descending id (nulls last), then ``h`` (a hash of the text), then text. Parts are ranges of ids between
    quantiles, so a part is a bounded share of the rows; an id that spans several quantiles is cut by ``h``. A part's
    successor is the first row of the next part that has rows (after the last: of the first). The texts are shuffled once.
    """
    text_batches(docs.sparkSession)
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    n = PARTS * partitions(spark)
    cuts = rows.agg(F.percentile_approx("id", [i / n for i in range(1, n)], 10 * n)).first()[0] or []
    found = Counter(map(int, cuts))  # n bounds at most
    bounds = F.array(*map(F.lit, sorted(found))).cast("array<long>")
    # how many bounds are not above the id, by halving: part 0 has the highest ids
    steps = F.array(*[F.lit(1 << k) for k in reversed(range(len(found).bit_length()))]).cast("array<int>")
    fits = lambda at, step: F.try_element_at(bounds, at + step) <= F.col("id")
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(fits(at, step), at + step).otherwise(at))
    # the lowest id of a part is cut into as many pieces as it spans quantiles, ids of null into n
    hot = {x: k for x, k in found.items() if k > 1}
    pieces = F.lit(0)
    if hot:
        pieces = F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for pair in hot.items() for x in pair]), F.col("id")), F.lit(0))
    pieces = F.when(F.col("id").isNull(), n).otherwise(pieces)
    piece = F.when(pieces > 0, 1 + F.floor((F.col("h") / F.lit(2.0**64) + 0.5) * pieces)).otherwise(0)
    part = F.when(F.col("id").isNull(), F.lit(len(found) + 1)).otherwise(len(found) - below)
    rows = rows.withColumn("part", part.cast("long") * (2 * n) + piece.cast("long"))
    # the first row of each part: its highest id, then the smallest hash, then the smallest text
    tops = rows.groupBy("part").agg(F.min(F.struct((-F.col("id")).alias("down"), "h")).alias("top")).select(F.col("part").alias("at"), "top.*")
    first = (F.col("part") == F.col("at")) & (F.col("h") == F.col("top_h")) & F.col("down").eqNullSafe(-F.col("id"))
    tops = F.broadcast(tops.withColumnRenamed("h", "top_h"))  # a row for each part: 2 n at most, and those of null ids
    heads = cut(rows.join(tops, first, "left_semi").groupBy("part", "id", "h").agg(F.min("text").alias("text")))
    order = Window.orderBy("part")
    earlier = F.coalesce(F.lag("part").over(order), F.max("part").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    return rows.withColumn("after", F.lit(False)).unionByName(
        heads.select("id", "h", "text", earlier.alias("part"), F.lit(True).alias("after"))
    )


EDITED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)

EDITED_TYPES = {
    "doc_id": pa.int64(), "n_chars": pa.int64(), "edited_sha256": pa.string(), "fingerprint": pa.string(),
    "edited_fingerprint": pa.string(), "near_edited": pa.float64(), "near_next": pa.float64(),
}


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K, s: int = S) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose second half comes from the next document's start."""

    def one(current: tuple, following: tuple) -> tuple:
        doc_id, text, (hashes, places) = current
        half = len(text) // 2
        edited = text[: len(text) - half] + following[1][:half]
        own, changed = (hashes, places), anchors(edited, k, s)
        return (
            doc_id, len(text), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(),
            written(*own), written(*changed), likeness(own, changed), likeness(own, following[2]),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None
        held_part = None
        for batch in batches:
            out = []
            for doc_id, text, part in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "part"))):
                row = (doc_id, text, anchors(text, k, s))
                if held is not None and held_part == part:
                    out.append(one(held, row))
                held, held_part = row, part
            columns = zip(*out) if out else [()] * len(EDITED_TYPES)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, EDITED_TYPES.values())], names=list(EDITED_TYPES)
            )

    parts = with_next(docs, id_col, text_col)
    n = partitions(docs.sparkSession)
    return (
        parts.repartitionByRange(n, "part")
        .sortWithinPartitions("part", "after", F.col("id").desc_nulls_last(), "h", "text")
        .mapInArrow(run, EDITED)
    )
