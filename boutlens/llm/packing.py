"""Best-fit packing of documents into sequences of bounded length, with bounds that certify each partition.

1. ``tokenize`` turns texts into token ids, each followed by an end id, and cuts only those longer than a sequence: the
   first piece takes the remainder, all others are full.
2. Pieces are dealt to partitions by a hash; each partition packs its own, the longest first, each into the open
   sequence with the least room that still holds it.
3. A dual-feasible-function bound (rounded sums over all thresholds) gives the fewest sequences a partition's
   pieces can need. Where the bound is met, the partition is certified and stays. The partitions with gaps put the
   pieces of their sequences that are not full together, deal them anew and pack again; the new packing holds if it
   has fewer sequences. Where fewer than two partitions have gaps, the certified ones exchange too: each may hold one
   sequence that is not full. This goes on until the bound of all pieces together is met, or nothing was won.

A sequence is numbered by the serial of its first piece, so numbers never collide.

Defined results: a null text is empty and has the end id alone; repeated rows are packed as documents of their own.
An empty table gives no pieces. Special strings of the tokenizer in a text become their ids, as with ``tokenizers``.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import count as counted

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, empty_if_null, text_batches

SEQUENCE, END = 1024, 2
#: Pieces in a partition, on average.
PER_PARTITION = 20_000

# The special string of the vocabulary and its id.
SPECIAL = {"<|endoftext|>": 50256}


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@lru_cache(maxsize=2)
def encoder(path: str):
    """The byte-level BPE of ``byte_bpe_50k.json``, from the same vocabulary written as ranks."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=SPECIAL
    )


@lru_cache(maxsize=1)
def reference_tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def token_ids(text: str, path: str) -> list[int]:
    try:
        return encoder(path).encode(text, allowed_special="all")
    except BaseException as problem:  # its regular expressions give up on very long runs of one kind
        if isinstance(problem, (KeyboardInterrupt, SystemExit)):
            raise
        return reference_tokenizer().encode(text, add_special_tokens=False).ids


def tokenize(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = SEQUENCE, end: int = END,
    path: str | None = None,
) -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids (32 bits each, little-endian)."""
    text_batches(docs.sparkSession)
    path = path or vocabulary_path()
    source = docs.select(F.col(id_col).alias("doc_id"), empty_if_null(docs, text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            taken, piece, start, size, data = [], [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.array([*token_ids(text, path), end], "<u4")
                first = len(ids) % length or length
                edges = [0, *range(first, len(ids) + 1, length)] if len(ids) > length else [0, len(ids)]
                for k, (a, b) in enumerate(zip(edges, edges[1:])):
                    taken.append(i)
                    piece.append(k)
                    start.append(a)
                    size.append(b - a)
                    data.append(ids[a:b].tobytes())
            at = pa.array(taken, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(at), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(size, pa.int64()), pa.array(data, pa.binary()),
                ],
                names=["doc_id", "piece", "start", "length", "ids"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids binary")


def dual_bound(count: np.ndarray, capacity: int) -> int:
    """The largest of the bounds of the dual feasible functions u_t: pieces over capacity - t count as whole sequences,
    those under t as nothing, the others by their size (t = 0: all by size). ``count`` has the pieces of each size."""
    if not count.any():
        return 0
    mass = count * np.arange(capacity + 1)
    upto_count, upto_mass = np.cumsum(count), np.cumsum(mass)
    best = -(-int(mass.sum()) // capacity)
    for t in range(1, capacity // 2 + 1):
        whole = int(upto_count[capacity] - upto_count[capacity - t])
        middle = int(upto_mass[capacity - t] - upto_mass[t - 1])
        best = max(best, whole + -(-middle // capacity))
    # and by thirds: pieces over a half or a third leave room for no more than one or two
    for d in range(2, 6):
        parts = sum(int(n) * ((d + 1) * size // (capacity + 1)) for size, n in enumerate(count) if n)
        best = max(best, -(-parts // d))
    return best


def counts_of(sizes: np.ndarray, capacity: int) -> np.ndarray:
    return np.bincount(sizes, minlength=capacity + 1).astype(np.int64)


def best_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece and the fill of each sequence. Open sequences are kept by the room left."""
    sequence, offset = np.empty(len(sizes), np.int64), np.empty(len(sizes), np.int64)
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # a bit for each room that some open sequence has
    fill: list[int] = []
    for i in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[i])
        fits = rooms >> size
        if fits:
            room = size + (fits & -fits).bit_length() - 1
            where = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            room, where = capacity, len(fill)
            fill.append(0)
        sequence[i], offset[i] = where, fill[where]
        fill[where] += size
        if room > size:
            by_room[room - size].append(where)
            rooms |= 1 << (room - size)
    return sequence, offset, np.array(fill, np.int64)


PLACED = "serial long, length long, sequence_id long, offset long, fill long, part long, gap boolean"


def pack_parts(pieces: DataFrame, parts: int, salt: int, capacity: int) -> DataFrame:
    """Deals (serial, length) to ``parts`` by a hash and packs each part: a bounded number of pieces on average."""

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("serial")
        serials, sizes = table.column("serial").to_numpy(), table.column("length").to_numpy()
        sequence, offset, fill = best_fit_decreasing(sizes, capacity)
        opener = np.empty(len(fill), np.int64)
        opener[sequence[offset == 0]] = serials[offset == 0]
        gap = len(fill) > dual_bound(counts_of(sizes, capacity), capacity)
        columns = [serials, sizes, opener[sequence], offset, fill[sequence], np.full(len(sizes), key[0].as_py()), np.full(len(sizes), gap)]
        return pa.table(columns, names=[c.split()[0] for c in PLACED.split(", ")])

    part = F.pmod(F.xxhash64(F.lit(salt), "serial"), F.lit(parts)).cast("long")
    return pieces.select("serial", "length", part.alias("part")).groupBy("part").applyInArrow(run, PLACED)


def total_bound(pieces: DataFrame, capacity: int) -> int:
    """The bound of all pieces together: one number for each size is collected, ``capacity`` at most."""
    count = np.zeros(capacity + 1, np.int64)
    for length, n in pieces.groupBy("length").agg(F.count("*")).collect():
        count[length] = n
    return dual_bound(count, capacity)


def pack(pieces: DataFrame, capacity: int = SEQUENCE, per_partition: int = PER_PARTITION, rounds: int | None = None) -> DataFrame:
    """``pieces`` (with a unique ``serial`` and a ``length``) with sequence_id and offset added.

    The exchange goes on until the bound is met or a round wins nothing; each round that goes on saves a sequence at least,
    so it ends. ``rounds`` ends it earlier: a caller may prefer a few sequences more.
    """
    loose = pieces.filter(F.col("length") < capacity).select("serial", "length")
    done: list[DataFrame] = []
    settled, before = None, None
    for salt in counted() if rounds is None else range(rounds + 1):
        n = loose.count()
        if not n:
            break
        parts = -(-n // per_partition)
        packed = cut(pack_parts(loose, parts, salt, capacity))
        heads = packed.filter("offset = 0")
        after, gaps = heads.agg(F.count("*"), F.count_distinct(F.when(F.col("gap"), F.col("part")))).first()
        if before is not None and after >= before:
            break  # nothing won: the last packing of these pieces stays
        if done:
            done[-1] = done[-1].filter(settled)
        done.append(packed)
        if parts == 1 or after <= total_bound(loose, capacity):
            break  # nobody to exchange with, or certified as a whole
        settled = F.col("fill") == capacity
        if gaps > 1:
            settled |= ~F.col("gap")
        loose = packed.filter(~settled).select("serial", "length")
        before = heads.filter(~settled).count()
    whole = pieces.filter(F.col("length") >= capacity)
    result = whole.select("*", F.col("serial").alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    if done:
        placed = reduce(DataFrame.unionByName, [d.select("serial", "sequence_id", "offset") for d in done])
        result = result.unionByName(pieces.filter(F.col("length") < capacity).join(placed, "serial"), True)
    return result


def pack_documents(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = SEQUENCE, end: int = END,
    path: str | None = None, digest: Column | None = None,
) -> DataFrame:
    """Per piece: doc_id, piece, serial, start, length, sequence_id, offset and ``digest`` (of the token ids; default:
    the ids themselves). Each text is tokenized once; the pieces are written to the checkpoint folder."""
    pieces = tokenize(docs, id_col, text_col, capacity, end, path)
    pieces = pieces.withColumn("digest", F.col("ids") if digest is None else digest).drop("ids")
    return pack(cut(pieces.withColumn("serial", F.monotonically_increasing_id())), capacity)
