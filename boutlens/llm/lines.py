"""Line dedup with log-template trees of fixed depth.

1. Tokens with digits, ``@`` or ``://`` are variable fields at once. A line goes down a tree by its number of tokens and its
   leading tokens to a leaf. Lines of ``LONG`` tokens and more go down three trees, each by two of three places: the leading
   tokens, those in the middle, and the last ones; so a long line may vary anywhere but in two of these places.
2. Equal lines are counted first, so a leaf holds every line once. Within a leaf lines join the template they agree with in
   ``similar`` of their tokens; where they differ, the template gets a variable field, and what it has left must still agree
   with the next line.
3. Leaves of long lines that hold one line, or in too few documents, are never gathered. A leaf of many lines is dealt to
   parts of a bounded size by a salt; the parts' templates are dealt anew and merged, as long as that shrinks the leaf by a
   tenth. What is left of a leaf that is still large is dealt by content: its places are cut into one block more than a line
   may differ in from its template, so two lines that belong together agree in a whole block, and in the round of this block
   they stand in one part. Above ``PLACES`` blocks (lines of some 40 tokens) as many single places stand for them. Only a
   part that two neighbouring blocks leave larger than a part may be is salted again.
4. Documents are counted for each line and each template. The document with the smallest id keeps its lines of a recurring
   one, in all others they go.

How many documents make a line recurring depends on what it says: ``min_docs`` from three tokens on, one more for two tokens,
for a line without words and for a template with fields found by comparison, five times as many for a single token.

Tokens are compared by hashes of 32 bits in a short line and 16 bits in a long one, of which eight or more must agree; equal
lines are told by 64 bits.

Defined results: a null text stays null; lines without tokens always stay. Rows of equal id are documents of their own for
counting, and all keep a line whose smallest id is theirs. A null id counts as the largest. Other columns are untouched, also
those named like columns made here; only ``line_dedup`` is replaced where ``docs`` has one. Ids are whole numbers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, packed, row_key, small, text_batches, unpacked

MIN_DOCS = 2
#: Tokens of a line that name its leaf, and the share of tokens in which it must agree with a template.
LEADING, SIMILAR = 2, 0.6
#: Tokens from which on a line is long, and from which on a line is compared at all.
LONG, LEAST = 12, LEADING + 2
#: Lines, and bytes of token codes in all, of one part of a leaf.
LINES, BYTES = 1_000, 400_000
#: Rounds by content at most.
PLACES = 16
FIELD = b"<*>"
#: Kinds of lines, in the two lowest bits of their hashes.
EXACT, VAGUE, SINGLE = 0, 1, 2
#: The code of what varies; no token has it.
VARIES = 0
#: Types of the codes of short and long lines.
WIDTHS = {True: np.dtype("<u4"), False: np.dtype("<u2")}


def codes_of(tokens: list[bytes], short: bool) -> np.ndarray:
    values = np.fromiter(map(zlib.crc32, tokens), np.uint32, len(tokens))
    return np.maximum(values.astype(WIDTHS[short]), 1)


FIELD_CODE = {short: int(codes_of([FIELD], short)[0]) for short in WIDTHS}


def is_field(token: bytes) -> bool:
    return b"@" in token or b"://" in token or any(48 <= c <= 57 for c in token)


def masked(line: bytes) -> list[bytes]:
    """The tokens of a line, fields masked."""
    tokens = line.split()
    if any(map(line.__contains__, (b"0", b"1", b"2", b"3", b"4", b"5", b"6", b"7", b"8", b"9", b"@", b"://"))):
        tokens = [FIELD if is_field(t) else t for t in tokens]
    return tokens


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def line_hash(tokens: list[bytes]) -> int:
    """Of a line with tokens; never 0."""
    n = len(tokens)
    kind = SINGLE if n == 1 else VAGUE if n == 2 or tokens.count(FIELD) == n else EXACT
    return signed((xxhash.xxh3_64_intdigest(b" ".join(tokens)) & ~3) | kind) or 4


def leaves(tokens: list[bytes]) -> tuple[int, int, int]:
    """The leaf of a line in each tree, 0 for none; the lowest bit tells leaves of short lines."""
    n = len(tokens)
    if n < LEAST:
        return 0, 0, 0
    if n < LONG:
        return leaf_hash(n, 0, tokens[:LEADING]) | 1, 0, 0
    middle = (n - LEADING) // 2
    places = tokens[:LEADING], tokens[middle : middle + LEADING], tokens[n - LEADING :]
    return tuple(leaf_hash(n, k, places[k - 1] + places[k]) & ~1 for k in range(3))


def leaf_hash(n: int, tree: int, tokens: list[bytes]) -> int:
    # hashes of short texts under different seeds can be equal: the tree and the length stand in what is hashed
    return signed(xxhash.xxh3_64_intdigest(b"%d %d " % (n, tree) + b" ".join(tokens))) or 2


LINE = "line long, lead long, middle long, last long, codes binary"
LINE_TYPE = pa.list_(pa.struct([*((c, pa.int64()) for c in ("line", "lead", "middle", "last")), ("codes", pa.binary())]))


def text_lines(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row with text: its key, its id and an array of its lines: hash, leaves and token codes (0: no tokens)."""
    text = F.col(text_col).cast("string")
    rows = docs.select(*row_key(F.col(id_col), text), F.col(id_col).cast("long").alias("id"), text.cast("binary").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(line: bytes) -> tuple:
            tokens = masked(line)
            if not tokens:
                return 0, 0, 0, 0, None
            n = len(tokens)
            return line_hash(tokens), *leaves(tokens), codes_of(tokens, n < LONG).tobytes() if n >= LEAST else None

        for batch in batches:
            made = [list(map(one, text.split(b"\n"))) for text in batch.column("text").to_pylist()]
            edges = np.cumsum([0, *map(len, made)])
            flat = list(zip(*[x for lines in made for x in lines])) or [()] * 5
            parts = [pa.array(list(c), f.type) for c, f in zip(flat, LINE_TYPE.value_type)]
            whole = pa.StructArray.from_arrays(parts, fields=list(LINE_TYPE.value_type))
            columns = [batch.column(c) for c in ("__key1", "__key2", "id")] + [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), whole)]
            yield pa.RecordBatch.from_arrays(columns, names=["__key1", "__key2", "id", "lines"])

    schema = f"__key1 long, __key2 long, id long, lines array<struct<{LINE.replace(' ', ':').replace(',:', ',')}>>"
    made = rows.filter("text IS NOT NULL").mapInArrow(run, schema)
    last = F.coalesce("id", F.lit((1 << 63) - 1)).alias("id")
    return made.select(F.monotonically_increasing_id().alias("row"), "__key1", "__key2", last, "lines")


def counted(lines: DataFrame) -> DataFrame:
    """Every line with tokens once: its leaves, how many rows hold it and their smallest id."""
    held = F.array_distinct(F.transform("lines", lambda x: F.struct(*[x[c].alias(c) for c in ("line", "lead", "middle", "last")])))
    each = lines.select("id", F.explode(held).alias("x")).select("id", "x.*").filter("line != 0")
    return each.groupBy("line").agg(
        F.count("*").alias("holders"), F.min("id").alias("first"), *[F.min(c).alias(c) for c in ("lead", "middle", "last")]
    )


def merged(codes: np.ndarray, field: int, similar: float) -> list[tuple[np.ndarray, list[int]]]:
    """Templates of lines of one length, a row of ``codes`` each, in the order of rows: (template, its rows)."""
    n = codes.shape[1]
    need = max(LEADING + 1, -int(-similar * n // 1))
    found, left = [], np.arange(len(codes))
    while len(left):
        template = codes[left[0]]
        agree = ((codes[left] == template) & (template != VARIES)).sum(axis=1)
        near = left[1:][agree[1:] >= need]
        rows = [int(left[0])]
        for row in near[np.argsort(-agree[1:][agree[1:] >= need], kind="stable")]:
            same = (codes[row] == template) & (template != VARIES)
            if same.sum() >= need and (template[same] != field).sum() >= 2:
                template = np.where(same, template, VARIES).astype(codes.dtype)
                rows.append(int(row))
        found.append((template, rows))
        left = left[~np.isin(left, rows)]
    return found


MINED = "leaf long, parts long, line long, template long, codes binary"


def mined(lines: DataFrame, similar: float) -> DataFrame:
    """``lines`` (leaf, parts, part, line, codes) with the template of each within its part; alone, a line is its own."""

    def of(group: list[tuple]) -> Iterator[tuple]:
        if len(group) == 1:
            leaf, parts, _, line, own = group[0]
            yield leaf, parts, line, line, own
            return
        short = bool(group[0][0] & 1)
        codes = np.array([np.frombuffer(c, WIDTHS[short]) for *_, c in group])
        for template, rows in merged(codes, FIELD_CODE[short], similar):
            data = template.tobytes()
            name = signed(xxhash.xxh3_64_intdigest(b"%d " % group[0][0] + data)) if len(rows) > 1 else None
            for row in rows:
                leaf, parts, _, line, own = group[row]
                yield leaf, parts, line, line if name is None else name, own if name is None else data

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (*[pa.int64()] * 4, pa.binary())
        names = [c.split()[0] for c in MINED.split(", ")]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*rows), types)], names=names)

        group, out = [], []
        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("leaf", "parts", "part", "line", "codes"))):
                if group and (group[0][0], group[0][2]) != (row[0], row[2]):
                    out += of(group)
                    group = []
                    if len(out) > 2_000:
                        yield batch_of(out)
                        out = []
                group.append(row)
        if group:
            out += of(group)
        if out:
            yield batch_of(out)

    dealt = lines.select("leaf", "parts", "part", "line", "codes").repartition("leaf", "part")
    return dealt.sortWithinPartitions("leaf", "part", "line").mapInArrow(run, MINED)


def salted(salt: int) -> Column:
    """Which of its ``parts`` a line goes to."""
    return F.pmod(F.xxhash64(F.lit(salt), "line"), "parts")


def with_parts(lines: DataFrame, by: tuple[str, ...] = ("leaf",)) -> DataFrame:
    """``lines`` (leaf, line, codes) with ``parts``: into how many their leaf, or group, is dealt."""
    sizes = lines.groupBy(*by).agg(F.count("*").alias("n"), F.sum(F.length("codes")).alias("bytes"))
    parts = F.greatest(F.ceil(F.col("n") / LINES), F.ceil(F.col("bytes") / BYTES)).cast("long")
    large = cut(sizes.select(*by, parts.alias("parts")).filter("parts > 1"))  # only these are looked up
    return lines.join(small(large), [*by], "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))


def blocks(similar: float) -> Column:
    """Into how many blocks the places of a line are cut: one more than those in which it may differ from its template."""
    n = places()
    return F.least(n - F.greatest(F.lit(LEADING + 1), F.ceil(F.lit(similar) * n)) + 1, F.lit(PLACES)).cast("int")


def is_short() -> Column:
    return F.col("leaf").bitwiseAND(F.lit(1)) == 1


def width() -> Column:
    return F.when(is_short(), WIDTHS[True].itemsize).otherwise(WIDTHS[False].itemsize)


def places() -> Column:
    return (F.length("codes") / width()).cast("int")


def block(number: Column, similar: float) -> Column:
    """The codes in a block of a line, from 0; the leading tokens of short lines are the same in their leaf."""
    n, many = places(), blocks(similar)
    first = F.when(is_short(), LEADING).otherwise(0)
    start = first + F.floor(number * (n - first) / many)
    end = first + F.floor((number + 1) * (n - first) / many)
    single = many == PLACES  # the block would be longer than what it stands for
    length = F.when(single, 1).otherwise(end - start)
    return F.substr("codes", (start * width() + 1).cast("int"), (length * width()).cast("int"))


def by_content(lines: DataFrame, number: int, similar: float) -> DataFrame:
    """``lines`` (leaf, line, codes) dealt by one block of their places, large parts by the next one too, then by a salt."""
    this, other = F.lit(number), (F.lit(number) + 1) % blocks(similar)
    parts = with_parts(lines.withColumn("part", F.xxhash64(block(this, similar))), ("leaf", "part"))
    finer = F.when(F.col("parts") > 1, F.xxhash64("part", block(other, similar))).otherwise(F.col("part"))
    parts = with_parts(parts.select("leaf", "line", "codes", finer.alias("part")), ("leaf", "part"))
    return parts.withColumn("part", F.when(F.col("parts") > 1, F.xxhash64("part", salted(number))).otherwise(F.col("part")))


def templates(lines: DataFrame, known: DataFrame, at_least: int, similar: float) -> DataFrame:
    """(line, template) of all lines that share a template with another; a long line can have one in each tree."""
    named = F.struct(*[F.col("x")[c].alias(c) for c in ("line", "lead", "codes")])
    each = lines.select(F.explode("lines").alias("x")).select(named.alias("x")).select("x.*")
    # all short lines are compared; long ones only where their leaf holds several
    short = F.col("lead").bitwiseAND(F.lit(1)) == 1
    few = each.filter(short).groupBy("line").agg(F.first("lead").alias("leaf"), F.first("codes").alias("codes"))
    at = known.filter(~short).select("line", "holders", F.explode(F.array("lead", "middle", "last")).alias("leaf")).filter("leaf != 0")
    open_ = at.groupBy("leaf").agg(F.count("*").alias("n"), F.sum("holders").alias("rows")).filter((F.col("n") > 1) & (F.col("rows") >= at_least))
    at = cut(at.join(small(cut(open_.select("leaf"))), "leaf", "left_semi").select("line", "leaf"))
    wanted = small(cut(at.select("line").distinct()))
    codes = each.filter(~short).join(wanted, "line", "left_semi").groupBy("line").agg(F.first("codes").alias("codes"))
    found = at.join(codes, "line").select("leaf", "line", "codes").unionByName(few.select("leaf", "line", "codes"))
    done: list[DataFrame] = []
    stuck: list[tuple[DataFrame, DataFrame]] = []  # members and lines of leaves that no salt shrinks

    def moved(member: DataFrame | None, got: DataFrame) -> DataFrame:
        step = got.select("leaf", F.col("line").alias("was"), F.col("template").alias("now"))
        if member is None:
            return step.select("leaf", F.col("was").alias("line"), F.col("now").alias("template"))
        met = member.join(step, (member["leaf"] == step["leaf"]) & (member["template"] == step["was"]))
        return cut(met.select(step["leaf"], "line", F.col("now").alias("template")))

    def of_leaves(df: DataFrame, leaves: DataFrame) -> DataFrame:
        return df.join(small(leaves.select("leaf")), "leaf", "left_semi")

    def as_lines(got: DataFrame) -> DataFrame:
        return got.select("leaf", F.col("template").alias("line"), "codes").dropDuplicates(["leaf", "line"])

    member, left, salt = None, with_parts(found), 0
    while True:
        got = cut(mined(left.withColumn("part", salted(salt)), similar))
        member = moved(member, got)
        # leaves in parts go on with their templates as lines
        sizes = got.filter("parts > 1").groupBy("leaf").agg(F.count("*").alias("n"), F.count_distinct("template").alias("m"))
        sizes = cut(sizes.withColumn("shrank", F.expr("10 * m <= 9 * n")))
        again = sizes.filter("shrank")
        done.append(member.join(small(sizes.select("leaf")), "leaf", "left_anti"))
        stuck.append((of_leaves(member, sizes.filter("NOT shrank")), as_lines(of_leaves(got, sizes.filter("NOT shrank")))))
        if not again.limit(1).count():
            break
        member = of_leaves(member, again)
        left, salt = with_parts(as_lines(of_leaves(got, again))), salt + 1
    member, left = (reduce(DataFrame.unionByName, parts) for parts in zip(*stuck))
    left = cut(left)
    rounds = left.agg(F.max(blocks(similar))).first()[0] or 0
    for number in range(rounds):
        open_ = blocks(similar) > number
        got = cut(mined(by_content(left.filter(open_), number, similar), similar))
        changed = got.filter("line != template")
        if not changed.limit(1).count():
            continue
        now = changed.select(F.col("leaf").alias("__leaf"), F.col("line").alias("was"), F.col("template").alias("now"))
        member = member.join(now, (F.col("leaf") == F.col("__leaf")) & (F.col("template") == F.col("was")), "left")
        member = cut(member.select("leaf", "line", F.coalesce("now", "template").alias("template")))
        left = cut(left.filter(~open_).select("leaf", "line", "codes").unionByName(as_lines(got)))
    done.append(member)
    return reduce(DataFrame.unionByName, done).filter("line != template").select("line", "template").distinct()


def recurring(lines: DataFrame, min_docs: int = MIN_DOCS, similar: float = SIMILAR) -> DataFrame:
    """(line, first): lines that recur, themselves or by a template, with the smallest id that holds them."""
    known = cut(counted(lines))
    kind = F.col("line").bitwiseAND(F.lit(3))
    enough = F.when(kind == EXACT, min_docs).when(kind == VAGUE, min_docs + 1).otherwise(5 * min_docs)
    same = known.filter(F.col("holders") >= enough).select("line", "first")
    alike = cut(templates(lines, known, min_docs + 1, similar))
    each = lines.select("row", "id", F.explode("lines.line").alias("line")).join(small(alike), "line")
    firsts = each.select("row", "id", "template").distinct().groupBy("template").agg(F.count("*").alias("holders"), F.min("id").alias("first"))
    general = alike.join(small(cut(firsts.filter(F.col("holders") > min_docs))), "template")
    return same.unionByName(general.select("line", "first"))


def dropped_lines(lines: DataFrame, found: DataFrame) -> DataFrame:
    """Per row key: the numbers of the lines that go, in order."""
    each = lines.select("__key1", "__key2", "id", F.posexplode("lines.line").alias("number", "line"))
    hits = each.join(small(found), "line").filter("id != first")
    return hits.groupBy("__key1", "__key2").agg(F.array_sort(F.collect_set("number")).alias("dropped"))


def with_dropped(docs: DataFrame, id_col: str, text_col: str, min_docs: int, similar: float) -> DataFrame:
    """(row, dropped, text): the rows of ``docs`` as structs, the numbers of their lines that go, and what is left.

    Each text is shuffled once.
    """
    text_batches(docs.sparkSession)
    lines = cut(text_lines(docs, id_col, text_col))  # 4 bytes for each token, 32 for each line
    gone = dropped_lines(lines, cut(recurring(lines, min_docs, similar)))

    @F.pandas_udf("string")
    def left(texts: pd.Series, dropped: pd.Series) -> pd.Series:
        def one(text: str | None, numbers) -> str | None:
            if text is None or numbers is None or not len(numbers):
                return text
            go = set(map(int, numbers))
            return "\n".join([line for k, line in enumerate(text.split("\n")) if k not in go])

        return pd.Series([one(t, n) for t, n in zip(texts, dropped)], dtype="object")

    keyed = docs.select(packed(docs), *row_key(F.col(id_col), F.col(text_col).cast("string")))
    known = keyed.join(gone, ["__key1", "__key2"], "left").withColumn("dropped", F.coalesce("dropped", F.array().cast("array<int>")))
    return known.select("row", "dropped", left(F.col(f"row.`{text_col}`").cast("string"), F.col("dropped")).alias("text"))


def drop_recurring(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, similar: float = SIMILAR
) -> DataFrame:
    """``docs`` with a struct ``line_dedup`` added: text (what is left), lines, dropped (numbers of the lines gone, from 0)."""
    done = with_dropped(docs, id_col, text_col, min_docs, similar)
    count = F.size(F.split(F.col(f"row.`{text_col}`").cast("string"), "\n")).alias("lines")
    kept = [F.col(f"row.`{c}`").alias(c) for c in docs.columns if c != "line_dedup"]
    return done.select(*kept, F.struct("text", count, "dropped").alias("line_dedup"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, similar: float = SIMILAR) -> DataFrame:
    """The rows of ``docs`` with what is left of their texts; rows that lose lines and keep only white space go."""
    done = with_dropped(docs, id_col, text_col, min_docs, similar)
    whole = F.size("dropped") == 0
    kept = done.filter(whole | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    changed = {text_col: F.col("text")}
    if "n_chars" in docs.columns:
        count = F.length("text").cast(docs.schema["n_chars"].dataType)
        changed["n_chars"] = F.when(whole, F.col("row.n_chars")).otherwise(count)
    return unpacked(kept, docs.columns, **changed)
