"""Fill-in-middle: a text is cut in prefix, middle and suffix, and the middle is moved to the end.

Cuts are drawn in units of a text: its tokens, or its code points. A text is held as UTF-8 bytes with a sparse index of
exceptions: of the characters that take more than one byte, the position and the excess bytes up to there. Between two
exceptions code points and bytes run in step, so a cut is turned from one into the other by one search among the
exceptions and a sum; a plain ASCII text has no index at all.

A token is white space (space, bytes 9 to 13) with the run of other characters behind it, or the white space at the end
of a text. The four draws h1 to h4 of a row are the first 8-digit groups of sha256 of ``seed:id``.

- form ``plain``: an empty text, one that contains a sentinel, and those with h3 % 100 >= ``rate``; nothing is moved.
- form ``spm`` if h4 % 100 < ``spm_rate``: <S>suffix<P>prefix<M>middle; else ``psm``: <P>prefix<S>suffix<M>middle.

Defined results: a null text is an empty one; a null id is drawn for as an empty one; repeated rows are cut alike, rows
of one id by the same draws; a part may be empty. Rows depend on nothing but themselves, so nothing is shuffled, and a
lost task is run again with the same result. The columns of the input stay; ``fim`` replaces one of that name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACE, packed

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
RATE, SPM_RATE, SEED = 50, 80, 42
#: Rows that are cut at once.
CHUNK = 128
FIM = "n long, form string, prefix_chars long, middle_chars long, output string"

_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[ord(c) for c in SPACE]] = True
#: Bytes beyond the first one of the character that a byte leads; 0 for ASCII, continuation bytes and none that UTF-8 knows.
_EXCESS = np.zeros(256, np.int64)
_EXCESS[0xC2:0xE0], _EXCESS[0xE0:0xF0], _EXCESS[0xF0:0xF5] = 1, 2, 3


class Exceptions:
    """The multibyte characters of a text: where they stand in bytes and in code points, and the excess bytes up to and with each."""

    def __init__(self, data: np.ndarray) -> None:
        self.bytes = np.flatnonzero(data >= 0xC2)
        excess = _EXCESS[data[self.bytes]]
        self.upto = np.concatenate([[0], np.cumsum(excess)])
        self.chars = self.bytes - self.upto[:-1]
        self.n_chars = len(data) - int(self.upto[-1])

    def to_bytes(self, chars: int) -> int:
        """The byte at which code point number ``chars`` starts."""
        return chars + int(self.upto[np.searchsorted(self.chars, chars)])

    def to_chars(self, at: int) -> int:
        """The number of code points before byte ``at``, which starts a character or ends the text."""
        return at - int(self.upto[np.searchsorted(self.bytes, at)])


def token_ends(data: np.ndarray) -> np.ndarray:
    """The byte behind each token."""
    space = _IS_SPACE[data]
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    return np.append(ends, len(data)) if len(data) else ends


def cut(text: bytes, draws: tuple[int, int, int, int], unit: str, rate: int, spm_rate: int) -> dict:
    """One row of :data:`FIM`, its output as bytes."""
    data = np.frombuffer(text, np.uint8)
    index = Exceptions(data)
    ends = token_ends(data) if unit == "token" else None
    n = index.n_chars if ends is None else len(ends)
    if not text or draws[2] % 100 >= rate or any(s.encode() in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return {"n": n, "form": "plain", "prefix_chars": None, "middle_chars": None, "output": text}
    cuts = sorted((draws[0] % (n + 1), draws[1] % (n + 1)))
    if ends is None:
        chars, at = cuts, [index.to_bytes(c) for c in cuts]
    else:
        at = [int(ends[c - 1]) if c else 0 for c in cuts]
        chars = [index.to_chars(a) for a in at]
    prefix, middle, suffix = text[: at[0]], text[at[0] : at[1]], text[at[1] :]
    spm = draws[3] % 100 < spm_rate
    parts = (SUFFIX, suffix, PREFIX, prefix) if spm else (PREFIX, prefix, SUFFIX, suffix)
    output = b"".join(p.encode() if isinstance(p, str) else p for p in (*parts, MIDDLE, middle))
    return {"n": n, "form": "spm" if spm else "psm", "prefix_chars": chars[0], "middle_chars": chars[1] - chars[0], "output": output}


def draws(id_col: Column, seed: int = SEED) -> Column:
    """The four numbers drawn for an id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def fill_in_middle(
    df: DataFrame, text_col: str = "text", id_col: str = "doc_id", unit: str = "token", rate: int = RATE, spm_rate: int = SPM_RATE, seed: int = SEED
) -> DataFrame:
    """The columns of ``df`` and a struct ``fim``: n (units of the text), form, prefix_chars, middle_chars (code points) and output.

    ``unit`` is ``token`` or ``char``: in what the cuts are drawn. ``rate`` and ``spm_rate`` are percentages.
    """
    if unit not in ("token", "char"):
        raise ValueError("unit is token or char")
    kind = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, CHUNK):
                part = batch.slice(start, CHUNK)
                texts, drawn = part.columns[-2], part.columns[-1].to_pylist()
                made = [cut(t.as_py() or b"", d, unit, rate, spm_rate) for t, d in zip(texts, drawn)]
                yield pa.RecordBatch.from_arrays([*part.columns[:-2], pa.array(made, kind)], names=schema.names)

    raw = T.StructType(T._parse_datatype_string(FIM).fields[:-1]).add("output", T.BinaryType())
    kept = df.drop("fim")
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    given = df.select(packed(kept), text.alias("bytes"), draws(F.col(f"`{id_col}`"), seed).alias("draws"))
    schema = T.StructType([given.schema["row"], T.StructField("fim", raw)])
    made = given.mapInArrow(run, schema)
    fim = F.struct(*[F.col(f"fim.{f.name}").cast("string" if f.name == "output" else f.dataType).alias(f.name) for f in raw])
    return made.select(*[F.col(f"row.`{c}`").alias(c) for c in kept.columns], fim.alias("fim"))


def restored(output: Column, form: Column) -> Column:
    """The text of which ``output`` was made: no part holds a sentinel, so its first ones are those that were put in."""
    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    psm, spm = (F.split(body, f"{s}|{MIDDLE}", 3) for s in (SUFFIX, PREFIX))
    return (
        F.when(form == "psm", F.concat(psm[0], psm[2], psm[1]))
        .when(form == "spm", F.concat(spm[1], spm[2], spm[0]))
        .otherwise(output)
    )
