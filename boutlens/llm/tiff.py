"""Media columns: TIFF files in a binary column.

``decode`` walks the image directories of a file and undoes PackBits, LZW or deflate, strips or tiles, and the
horizontal predictor; ``pages`` emits one row per page of every file. ``encode`` stores bytes as an 8-bit grey
image. Everything works on a few rows at a time inside the tasks; nothing is shuffled.

Defined results: a null or empty file has no pages; a file that is not TIFF, is cut short, or uses a form that is
not decoded gives one row with ``error`` set and null samples. So does an image whose header claims more samples than
its strips or tiles can hold: nothing is made larger than the stored bytes allow. Repeated rows give repeated results.
Other columns are kept; one named like a column that is added is replaced.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T

# Tags, field types and compression codes of the TIFF 6.0 format.
WIDTH, LENGTH, BITS, COMPRESSION, PHOTOMETRIC, STRIP_OFFSETS, SAMPLES, ROWS_PER_STRIP, STRIP_COUNTS = (
    256, 257, 258, 259, 262, 273, 277, 278, 279,
)
X_RESOLUTION, Y_RESOLUTION, PLANAR, RESOLUTION_UNIT, PREDICTOR, TILE_WIDTH, TILE_LENGTH, TILE_OFFSETS, TILE_COUNTS = (
    282, 283, 284, 296, 317, 322, 323, 324, 325,
)
TYPES = {1: "B", 3: "H", 4: "I"}
SHORT, LONG, RATIONAL = 3, 4, 5
#: Fields of 16 bits; those on resolution are fractions, all others here have 32 bits.
SHORTS = (BITS, COMPRESSION, PHOTOMETRIC, SAMPLES, PLANAR, RESOLUTION_UNIT, PREDICTOR)
NONE, LZW, DEFLATE, PACKBITS, OLD_DEFLATE = 1, 5, 8, 32773, 32946

#: How many samples a stored byte can stand for at most: 128 for two bytes; some 4,000 for a code of 12 bits; the format's bound.
GROWTH = {NONE: 1, PACKBITS: 64, LZW: 2800, DEFLATE: 1040, OLD_DEFLATE: 1040}
#: Bytes of samples that a batch of pages holds before it is handed on.
BATCH = 32 << 20

PAGE = (
    "page int, width int, height int, samples_per_pixel int, compression int, pixels binary, histogram array<int>,"
    " error string"
)
PAGE_TYPE = pa.struct([
    *((name, pa.int32()) for name in ("page", "width", "height", "samples_per_pixel", "compression")),
    ("pixels", pa.binary()), ("histogram", pa.list_(pa.int32())), ("error", pa.string()),
])


def unpack_bits(data: bytes) -> bytes:
    out, i = bytearray(), 0
    while i < len(data):
        n = data[i]
        if n < 128:
            out += data[i + 1 : i + 2 + n]
            i += n + 2
        else:
            if n > 128:
                out += data[i + 1 : i + 2] * (257 - n)
            i += 2 if n > 128 else 1
    return bytes(out)


def pack_bits(row: bytes) -> bytes:
    """Runs of at least three equal bytes become repeats, the rest literals of at most 128."""
    out, literal, i = bytearray(), bytearray(), 0

    def flush() -> None:
        for k in range(0, len(literal), 128):
            piece = literal[k : k + 128]
            out.append(len(piece) - 1)
            out.extend(piece)
        literal.clear()

    while i < len(row):
        run = 1
        while run < 128 and i + run < len(row) and row[i + run] == row[i]:
            run += 1
        if run >= 3:
            flush()
            out.extend((257 - run, row[i]))
        else:
            literal.extend(row[i : i + run])
        i += run
    flush()
    return bytes(out)


def un_lzw(data: bytes) -> bytes:
    """Codes of 9 to 12 bits, most significant bit first; the width grows one code early."""
    out, table, width, last = bytearray(), [], 9, b""
    held = bits = 0
    fresh = [bytes((b,)) for b in range(256)] + [b"", b""]
    for byte in data:
        held, bits = (held << 8) | byte, bits + 8
        if bits < width:
            continue
        bits -= width
        code, held = held >> bits, held & ((1 << bits) - 1)
        if code == 257:
            break
        if code == 256:
            table, width, last = list(fresh), 9, b""
            continue
        if not table:
            raise ValueError("LZW data does not start with a clear code")
        if code < len(table):
            entry = table[code]
        elif code == len(table) and last:
            entry = last + last[:1]
        else:
            raise ValueError("LZW code out of range")
        out += entry
        if last:
            table.append(last + entry[:1])
        last = entry
        width = 9 if len(table) < 511 else 10 if len(table) < 1023 else 11 if len(table) < 2047 else 12
    return bytes(out)


def do_lzw(data: bytes) -> bytes:
    codes: list[tuple[int, int]] = [(256, 9)]
    table = {bytes((b,)): b for b in range(256)}
    size, width, word = 258, 9, b""
    for b in data:
        longer = word + bytes((b,))
        if longer in table:
            word = longer
            continue
        codes.append((table[word], width))
        table[longer] = size
        size += 1
        if size == 4094:
            codes.append((256, 12))
            table = {bytes((c,)): c for c in range(256)}
            size, width = 258, 9
        else:
            width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
        word = bytes((b,))
    if word:
        codes.append((table[word], width))
        size += 1
        width = 9 if size < 512 else 10 if size < 1024 else 11 if size < 2048 else 12
    codes.append((257, width))
    held = bits = 0
    out = bytearray()
    for code, n in codes:
        held, bits = (held << n) | code, bits + n
        while bits >= 8:
            bits -= 8
            out.append(held >> bits & 255)
            held &= (1 << bits) - 1
    if bits:
        out.append(held << (8 - bits) & 255)
    return bytes(out)


def expand(data: bytes, how: int, size: int) -> bytes:
    """At least the first ``size`` bytes, if there are so many; of deflate no more than these are made."""
    if how == NONE:
        return data
    if how == PACKBITS:
        return unpack_bits(data)
    if how == LZW:
        return un_lzw(data)
    return zlib.decompressobj().decompress(data, size)


def shrink(data: bytes, how: int, width: int) -> bytes:
    if how == PACKBITS:  # each row on its own
        return b"".join(pack_bits(data[i : i + width]) for i in range(0, len(data), width))
    return data if how == NONE else do_lzw(data) if how == LZW else zlib.compress(data, 1)


def encode(
    payload: bytes,
    width: int = 64,
    compression: int = DEFLATE,
    predictor: int = 1,
    rows_per_strip: int = 1024,
    tile: tuple[int, int] | None = None,
    rows_per_page: int | None = None,
    order: str = "<",
) -> bytes:
    """An 8-bit grey TIFF of ``payload``, whose length must be a positive multiple of ``width``."""
    if not payload or len(payload) % width:
        raise ValueError("the payload must fill whole rows")
    rows = np.frombuffer(payload, np.uint8).reshape(-1, width)
    out = bytearray((b"II" if order == "<" else b"MM") + struct.pack(order + "HI", 42, 0))
    link, per_page = 4, rows_per_page or len(rows)
    for top in range(0, len(rows), per_page):
        image = rows[top : top + per_page]
        wide, high = (tile[1], tile[0]) if tile else (width, rows_per_strip)
        pieces = []
        for y in range(0, len(image), high):
            for x in range(0, width, wide):
                piece = image[y : y + high, x : x + wide]
                if tile:
                    piece = np.pad(piece, ((0, high - piece.shape[0]), (0, wide - piece.shape[1])))
                if predictor == 2:
                    piece = np.diff(piece, axis=1, prepend=np.zeros((len(piece), 1), np.uint8))
                pieces.append(shrink(np.ascontiguousarray(piece).tobytes(), compression, wide))
        starts = []
        for piece in pieces:
            starts.append(len(out))
            out += piece
        out += b"\0" * (len(out) % 2)
        sizes = [len(p) for p in pieces]
        fields = {WIDTH: [width], LENGTH: [len(image)], BITS: [8], COMPRESSION: [compression], PHOTOMETRIC: [1]}
        fields |= {SAMPLES: [1], PREDICTOR: [predictor], RESOLUTION_UNIT: [2], X_RESOLUTION: [72, 1], Y_RESOLUTION: [72, 1]}
        if tile:
            fields |= {TILE_WIDTH: [wide], TILE_LENGTH: [high], TILE_OFFSETS: starts, TILE_COUNTS: sizes}
        else:
            fields |= {STRIP_OFFSETS: starts, ROWS_PER_STRIP: [min(high, len(image))], STRIP_COUNTS: sizes}
        lists = {}
        for tag, values in sorted(fields.items()):
            if len(values) > 1:
                lists[tag] = len(out)
                out += struct.pack(f"{order}{len(values)}I", *values)
        struct.pack_into(order + "I", out, link, len(out))
        out += struct.pack(order + "H", len(fields))
        for tag, values in sorted(fields.items()):
            if tag in SHORTS:  # stands at the left of its place
                out += struct.pack(order + "HHIHH", tag, SHORT, 1, values[0], 0)
            elif tag in (X_RESOLUTION, Y_RESOLUTION):
                out += struct.pack(order + "HHII", tag, RATIONAL, 1, lists[tag])
            else:
                out += struct.pack(order + "HHII", tag, LONG, len(values), lists.get(tag, values[0]))
        link = len(out)
        out += struct.pack(order + "I", 0)
    return bytes(out)


def directory(data: bytes, order: str, at: int) -> tuple[dict[int, tuple[int, ...]], int]:
    (count,) = struct.unpack_from(order + "H", data, at)
    fields = {}
    for i in range(count):
        tag, kind, n = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        if kind in TYPES:
            size = struct.calcsize(order + TYPES[kind]) * n
            place = at + 10 + 12 * i
            if size > 4:
                (place,) = struct.unpack_from(order + "I", data, place)
            fields[tag] = struct.unpack_from(f"{order}{n}{TYPES[kind]}", data, place)
    (following,) = struct.unpack_from(order + "I", data, at + 2 + 12 * count)
    return fields, following


def image(data: bytes, order: str, fields: dict[int, tuple[int, ...]]) -> tuple[int, int, int, int, bytes]:
    first = lambda tag, default=None: fields.get(tag, (default,))[0]
    width, height = first(WIDTH), first(LENGTH)
    samples, how, predictor = first(SAMPLES, 1), first(COMPRESSION, NONE), first(PREDICTOR, 1)
    if width is None or height is None or set(fields.get(BITS, (1,))) != {8}:
        raise ValueError("only images of 8-bit samples are decoded")
    if predictor not in (1, 2):
        raise ValueError(f"predictor {predictor} is not undone")
    planar = first(PLANAR, 1) == 2 and samples > 1
    planes, depth = (samples, 1) if planar else (1, samples)
    tiled = TILE_OFFSETS in fields
    wide, high = (first(TILE_WIDTH), first(TILE_LENGTH)) if tiled else (width, min(first(ROWS_PER_STRIP, height), height))
    starts, sizes = fields[TILE_OFFSETS if tiled else STRIP_OFFSETS], fields[TILE_COUNTS if tiled else STRIP_COUNTS]
    if how not in GROWTH:
        raise ValueError(f"compression {how} is not decoded")
    if min(width, height, samples, wide, high) < 1:
        raise ValueError("an image without samples")
    # a tile is stored whole, though the image may end within it
    if planes * height * width * depth > GROWTH[how] * sum(len(data[a : a + n]) for a, n in zip(starts, sizes)):
        raise ValueError("the file is too short for the samples that it claims")
    out, k = np.zeros((planes, height, width, depth), np.uint8), 0
    for plane in range(planes):
        for y in range(0, height, high):
            for x in range(0, width, wide):
                rows = high if tiled else min(high, height - y)
                raw = data[starts[k] : starts[k] + sizes[k]]
                if len(raw) != sizes[k]:
                    raise ValueError("the file ends early")
                if rows * wide * depth > GROWTH[how] * len(raw):
                    raise ValueError("a strip or tile is too short")
                plain = expand(raw, how, rows * wide * depth)
                if len(plain) < rows * wide * depth:
                    raise ValueError("a strip or tile is too short")
                block = np.frombuffer(plain, np.uint8, rows * wide * depth).reshape(rows, wide, depth)
                if predictor == 2:
                    block = np.cumsum(block, axis=1, dtype=np.uint8)
                out[plane, y : y + high, x : x + wide] = block[: height - y, : width - x]
                k += 1
    pixels = np.moveaxis(out, 0, -1).reshape(height, width, samples) if planar else out[0]
    return width, height, samples, how, pixels.tobytes()


def decode(data: bytes) -> Iterator[tuple[int, int, int, int, int, bytes]]:
    """(page, width, height, samples per pixel, compression, samples by row) of every page."""
    order = {b"II": "<", b"MM": ">"}.get(data[:2])
    if order is None or struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a TIFF file")
    (at,), seen, page = struct.unpack_from(order + "I", data, 4), set(), 0
    while at:
        if at in seen:
            raise ValueError("the directories form a loop")
        seen.add(at)
        fields, at = directory(data, order, at)
        yield (page, *image(data, order, fields))
        page += 1


#: Rows that are encoded or decoded at once.
CHUNK = 128


def with_tiff(df: DataFrame, payload: Column, name: str = "media", keep: Sequence[str] | None = None) -> DataFrame:
    """The columns ``keep`` of ``df`` (default: all) and a column ``name``: bytes that fill whole rows of 64 samples, as TIFF of deflate strips; else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                data = [p.as_py() for p in part.column(part.num_columns - 1)]
                made = pa.array([encode(p) if p and len(p) % 64 == 0 else None for p in data], pa.binary())
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], made], names=schema.names)

    kept = df.select(*[f"`{c}`" for c in (df.columns if keep is None else keep) if c != name]).schema.fields
    schema = T.StructType([*kept, T.StructField(name, T.BinaryType())])
    return df.select(*[f"`{f.name}`" for f in kept], payload.alias("__payload")).mapInArrow(run, schema)


def histogram(pixels: bytes, bins: int = 16) -> list[int]:
    """Shares of the samples by brightness, in thousandths."""
    found = np.bincount(np.frombuffer(pixels, np.uint8) // (256 // bins), minlength=bins)
    return (found * 1000 // max(1, len(pixels))).tolist()


def pages(df: DataFrame, media: str) -> DataFrame:
    """One row per page of the TIFF in ``media``: all columns of ``df`` and a struct ``tiff_page``."""

    def one(data: bytes | None) -> Iterator[dict]:
        page = -1
        try:
            for page, width, height, samples, how, pixels in decode(data) if data else ():
                yield {
                    "page": page, "width": width, "height": height, "samples_per_pixel": samples, "compression": how,
                    "pixels": pixels, "histogram": histogram(pixels), "error": None,
                }
        except (ValueError, KeyError, IndexError, TypeError, struct.error, zlib.error, OverflowError) as problem:
            yield {"page": page + 1, "error": f"{type(problem).__name__}: {problem}"}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                at, found, held = [], [], 0

                def made(part=part) -> pa.RecordBatch:
                    kept = (c.take(pa.array(at, pa.int64())) for c in part.columns[:-1])
                    return pa.RecordBatch.from_arrays([*kept, pa.array(found, PAGE_TYPE)], names=schema.names)

                for i, file in enumerate(part.column(part.num_columns - 1)):
                    for page in one(file.as_py()):
                        at.append(i)
                        found.append(page)
                        held += len(page.get("pixels") or b"")
                        if held > BATCH:
                            yield made()
                            at, found, held = [], [], 0
                if at:
                    yield made()

    kept = df.drop("tiff_page").schema.fields
    schema = T.StructType([*kept, T.StructField("tiff_page", T._parse_datatype_string(PAGE))])
    return df.select(*[f"`{f.name}`" for f in kept], df[media].alias("__file")).mapInArrow(run, schema)
