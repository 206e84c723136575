"""Spelling variants: words that differ by one inserted, deleted or replaced code point.

Two words are such a pair if and only if their common prefix and their common suffix together reach the longer length
less one. With m the longer length, a = two thirds of it (rounded up) and b = m - a, one of three things then holds:
the prefix has a characters or more, or the suffix has, or both have b or more. So words meet by equal keys: their first
a characters, their last a, or their first and last b. A word has keys for its own length and, as the shorter one of a
pair, for the next. A pair counts under the first of its keys.

Words of one key are compared in tiles, dense blocks of their code points: padded matrices, aligned at the left for
prefixes and at the right for suffixes. A tile is at most ``BLOCK`` words by ``BLOCK`` words, fewer if they are long; a key
with more words has a tile for each pair of its blocks, each a row group of its own, so a frequent key is spread over
as many tasks as it has tiles. A tile returns one row for each word that has near ones: their number and the best.

The form of a word is its near word of largest n (ties: smallest in code-point order), where that n is at least ``FACTOR``
times its own; roots follow forms by doubling, and forms grow by that factor, so the rounds are few: about the logarithm
of the logarithm of the largest n.

Defined results: a null text has no words, a null id is an empty one where runs are altered; repeated rows count as often as they
stand there. A table without words gives no rows. Words may have any length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Maximal runs of letters; only A-Z are lower-cased.
RUN = r"[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_LENGTH, MIN_COUNT, FACTOR = 6, 5, 5
#: One run in so many loses a code point.
TYPO = 199
#: Words of a block, code points of a block, and of the pairs that are compared at once.
BLOCK, POINTS, CELLS = 1024, 1 << 21, 1 << 22


def runs(text: Column) -> Column:
    return F.regexp_extract_all(F.translate(text, UPPER, LOWER), F.lit(RUN), F.lit(0))


def altered(run: Column, key: Column, every: int = TYPO) -> Column:
    """``run`` without one code point, where ``every`` divides the CRC-32 of ``key:run``."""
    h = F.crc32(F.concat_ws(":", key, run).cast("binary"))
    at = F.pmod(h, F.char_length(run)).cast("int")
    return F.when(h % every == 0, F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))).otherwise(run)


def word_counts(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = TYPO, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT
) -> DataFrame:
    """(word, n) of the frequent words of all texts: counted where they stand, then summed by word."""
    key = F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit(""))
    found = docs.select(key.alias("key"), F.explode(runs(F.col(f"`{text_col}`").cast("string"))).alias("run"))
    words = found.filter(F.char_length("run") >= min_length).select(altered(F.col("run"), F.col("key"), every).alias("word"))
    counted = words.filter(F.char_length("word") >= min_length).groupBy("word").agg(F.count("*").alias("n"))
    return counted.filter(F.col("n") >= min_count)


def split(m: Column) -> tuple[Column, Column]:
    """(a, b) of the longer length ``m``."""
    a = F.ceil(m * 2 / 3).cast("int")
    return a, m - a


def keyed(words: DataFrame) -> DataFrame:
    """``words`` with their six keys: m (the longer length of the pairs), kind (0 prefix, 1 suffix, 2 both) and key."""
    word, size = F.col("word"), F.char_length("word")
    keys = []
    for m in (size, size + 1):
        a, b = split(m)
        first, last = (lambda n: F.substring(word, F.lit(1), n)), (lambda n: F.substring(word, size - n + 1, n))
        for kind, key in enumerate((first(a), last(a), F.concat(first(b), last(b)))):
            keys.append(F.struct(m.alias("m"), F.lit(kind).alias("kind"), key.alias("key")))
    return words.select("word", "n", F.explode(F.array(*keys)).alias("at")).select("word", "n", "at.*")


def tiled(words: DataFrame, block: int = BLOCK) -> DataFrame:
    """The words by tile: tile (a hash of the key and its two blocks), m, kind, key, left, right and the word's own block.

    A key of p blocks has the tiles left <= right of them, and each word stands in p of them. Keys of one word, or of words
    that are all shorter than m, are left out.
    """
    known = keyed(words)
    sizes = known.groupBy("m", "kind", "key").agg(F.count("*").alias("n_words"), F.max(F.char_length("word")).alias("longest"))
    rows = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(POINTS) / F.col("m")))).cast("long")
    sizes = sizes.filter((F.col("n_words") > 1) & (F.col("longest") == F.col("m"))).withColumn("blocks", F.ceil(F.col("n_words") / rows))
    known = known.join(sizes.drop("longest", "n_words"), ["m", "kind", "key"])
    own = F.pmod(F.xxhash64("word"), F.col("blocks"))
    known = known.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    left, right = F.least("own", "other"), F.greatest("own", "other")
    return known.select(F.xxhash64("m", "kind", "key", left, right).alias("tile"), "m", "kind", "key", left.alias("left"), right.alias("right"), "own", "word", "n")


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lengths, code points aligned at the left, the same at the right), padded with different numbers that are no code points."""
    sizes = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    rows = np.repeat(np.arange(len(words)), sizes)
    places = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left, right = (np.full((len(words), width), pad, np.uint32) for pad in (1 << 30, 1 << 30))
    left[rows, places] = points
    right[rows, width - sizes[rows] + places] = points
    return sizes, left, right


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many numbers at the start of two rows are equal."""
    differs = a != b
    return np.where(differs.any(axis=-1), differs.argmax(axis=-1), a.shape[-1])


def near_pairs(i: np.ndarray, j: np.ndarray, parts: tuple[np.ndarray, np.ndarray, np.ndarray], m: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """Which of the pairs (i, j) of rows are one edit apart and count under their key."""
    sizes, left, right = parts
    short = np.minimum(sizes[i], sizes[j])
    prefix = np.minimum(common(left[i], left[j]), short)
    suffix = np.minimum(common(right[i][:, ::-1], right[j][:, ::-1]), short)
    a = -(-2 * m // 3)
    first = np.where(prefix >= a, 0, np.where(suffix >= a, 1, 2))
    return (np.maximum(sizes[i], sizes[j]) == m) & (prefix + suffix >= m - 1) & (first == kind)


def tile_pairs(bounds: np.ndarray, lefts: np.ndarray, rights: np.ndarray, owns: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) of the rows of each tile: of one block all i < j, of two blocks each row of one with each of the other."""
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        own = owns[lo:hi]
        if lefts[lo] == rights[lo]:
            i, j = np.triu_indices(hi - lo, 1)
        else:
            one, two = np.flatnonzero(own == lefts[lo]), np.flatnonzero(own == rights[lo])
            i, j = np.repeat(one, len(two)), np.tile(two, len(one))
        yield i + lo, j + lo


NEAR = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])


def compared(tiles: pa.Table) -> Iterator[pa.RecordBatch]:
    """:func:`near_of` for tiles of about the same length at a time, so that padding at most doubles the matrices."""
    digits = np.frexp(tiles.column("m").to_numpy())[1]
    for d in np.unique(digits):
        yield near_of(tiles.filter(pa.array(digits == d)))


def near_of(tiles: pa.Table) -> pa.RecordBatch:
    """For each word of whole tiles its near words of that tile: how many, and the one of largest n, then smallest."""
    at = [tiles.column(c).to_numpy() for c in ("tile", "m", "kind", "left", "right", "own", "n")]
    tile, m, kind, left, right, own, n = at
    words = tiles.column("word").to_pylist()
    same = np.logical_and.reduce([x[1:] == x[:-1] for x in (tile, m, kind, left, right)]) if len(words) > 1 else np.empty(0, bool)
    keys = tiles.column("key").to_pylist()
    same &= np.fromiter((a == b for a, b in zip(keys[1:], keys)), bool, len(same))
    bounds = np.concatenate([[0], np.flatnonzero(~same) + 1, [len(words)]])
    width = int(max(map(len, words)))
    parts = matrices(words, width)
    found, held, size = [], [], 0

    def flush() -> None:
        i, j = (np.concatenate(x) for x in zip(*held))
        step = max(1, CELLS // width)
        for s in range(0, len(i), step):
            p, q = i[s : s + step], j[s : s + step]
            hit = near_pairs(p, q, parts, m[p], kind[p])
            found.append((p[hit], q[hit]))

    for i, j in tile_pairs(bounds, left, right, own):
        held.append((i, j))
        size += len(i)
        if size >= CELLS // width:
            flush()
            held, size = [], 0
    if held:
        flush()
    i = np.concatenate([np.concatenate([p, q]) for p, q in found]) if found else np.empty(0, np.int64)
    j = np.concatenate([np.concatenate([q, p]) for p, q in found]) if found else np.empty(0, np.int64)
    # UTF-8 sorts by code point, as Python's strings do
    place = np.empty(len(words), np.int64)
    place[sorted(range(len(words)), key=words.__getitem__)] = np.arange(len(words))
    order = np.lexsort((place[j], -n[j], i))
    i, j = i[order], j[order]
    rows, starts, counts = np.unique(i, return_index=True, return_counts=True)
    best = j[starts]
    columns = [pa.array([words[r] for r in rows]), pa.array(counts), pa.array(n[best]), pa.array([words[b] for b in best])]
    return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, NEAR)], schema=NEAR)


def near_words(tiles: DataFrame, points: int = POINTS) -> DataFrame:
    """(word, near, best_n, best) for each word and tile: ``tiles`` sorted by tile, whole tiles compared at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            tile = batch.column("tile").to_numpy()
            held.append(batch)
            rows += len(batch)
            size += int(batch.column("m").to_numpy().sum())
            if size < points:
                continue
            # the last tile may go on: it waits for the next batch
            table = pa.Table.from_batches(held)
            all_tiles = table.column("tile").to_numpy()
            whole = int(np.searchsorted(all_tiles, tile[-1], "left"))
            if whole:
                yield from compared(table.slice(0, whole))
                rest = table.slice(whole).combine_chunks()
                held, size = rest.to_batches(), int(rest.column("m").to_numpy().sum())
        if held:
            yield from compared(pa.Table.from_batches(held))

    columns = ["tile", "m", "kind", "key", "left", "right", "own", "word", "n"]
    dealt = tiles.select(*columns).repartition("tile").sortWithinPartitions("tile", "m", "kind", "key", "left", "right")
    return dealt.mapInArrow(run, "word string, near long, best_n long, best string")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): each round, the form of the form so far; those that end no longer move."""
    now = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = cut(now.join(then, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        now = moved.select("word", "root")
        if moved.filter("moved").isEmpty():
            return now


def spelling_variants(words: DataFrame, factor: int = FACTOR, block: int = BLOCK) -> DataFrame:
    """``words`` (word, n; each word once) with n_near, form, form_n and root."""
    words = cut(words)
    found = near_words(tiled(words, block))
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best").alias("form")))
    summed = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("best"))
    all_ = words.join(summed, "word", "left")
    is_form = -F.col("best.less") >= factor * F.col("n")
    all_ = cut(all_.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(is_form, F.col("best.form")).alias("form"), F.when(is_form, -F.col("best.less")).alias("form_n")))
    ends = roots(all_.filter("form IS NOT NULL"))
    return all_.join(ends, "word", "left").withColumn("root", F.coalesce("root", "word"))
