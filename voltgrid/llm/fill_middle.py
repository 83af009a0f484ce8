"""Fill-in-the-middle with a learned rank index over line boundaries.

A text's boundaries (code points before its first, second, ... line, and its length) are
a growing sequence.  `line_index` fits error-bounded straight segments to all of them
and stores what each boundary is off by; `offset_at` predicts the boundary of a rank by
its segment and corrects it exactly by the stored residual, so a cut costs two look-ups,
however long the text is.  `rearrange` draws two ranks per document from a hash of its
id, cuts there and writes prefix, suffix and middle with their marks; `restore` undoes it.

Defined cases: a null text counts as empty; empty texts, and texts that contain a mark,
stay plain with null lengths; a null id is hashed as an empty string; repeated rows give
repeated results; a text without line ends is one line; an empty table gives an empty
result; the table's own columns stay untouched in ``rest``, so no name can clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship

#: code points that a prediction may be off by, but for rounding
ERROR = 63
#: binary digits behind the point of a slope
SHIFT = 20
INDEX = "struct<n:bigint,segments:array<struct<rank:bigint,offset:bigint,slope:bigint>>,residuals:array<tinyint>>"


@dataclass(frozen=True)
class Marks:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __post_init__(self) -> None:
        for m in self.all:
            if not m or any(m[:i] == m[-i:] for i in range(1, len(m))):
                raise ValueError(f"a mark must not be empty nor begin as it ends: {m!r}")
        if len(set(self.all)) < 3:
            raise ValueError("the three marks must differ")

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


def fit(values: np.ndarray, error: int = ERROR) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """Segments (first rank, offset there, slope) and residuals of an ascending sequence.

    From its first point a segment keeps the range of slopes that pass every further
    point within ``error``; the first point that empties the range begins the next
    segment.  Points are taken in strides that double, so long segments cost few steps.
    """
    if not 0 <= error <= 126:
        raise ValueError("residuals are stored in one byte: the error must be between 0 and 126")
    n, at, room = len(values), 0, error << SHIFT
    segments, predicted = [], np.empty(n, np.int64)
    while at < n:
        low, high, end, stride = 0, 1 << 62, at + 1, 32
        while end < n:
            stop = min(n, end + stride)
            steps = np.arange(end - at, stop - at, dtype=np.int64)
            rise = (values[end:stop] - values[at]) << SHIFT
            lows = np.maximum.accumulate(np.maximum(low, -((room - rise) // steps)))
            highs = np.minimum.accumulate(np.minimum(high, (rise + room) // steps))
            empty = np.flatnonzero(lows > highs)
            taken = int(empty[0]) if len(empty) else stop - end
            if taken:
                low, high = int(lows[taken - 1]), int(highs[taken - 1])
            end += taken
            if len(empty):
                break
            stride *= 2
        slope = (low + high) // 2 if end > at + 1 else 0
        segments.append((at, int(values[at]), slope))
        predicted[at:end] = values[at] + (slope * np.arange(end - at, dtype=np.int64) >> SHIFT)
        at = end
    return segments, (values - predicted).astype(np.int8)


def boundaries(text: np.ndarray) -> np.ndarray:
    """Code points before each line of a text (its UTF-8 bytes), and its length."""
    ends = np.flatnonzero(text == 10) + 1
    if len(text) and (not len(ends) or ends[-1] != len(text)):
        ends = np.append(ends, len(text))
    if len(ends):
        first = (text & 0xC0) != 0x80
        if not first.all():
            ends = np.cumsum(np.add.reduceat(first, np.r_[0, ends[:-1]], dtype=np.int64))
    return np.concatenate([[0], ends]).astype(np.int64)


def line_index(text: Column, error: int = ERROR) -> Column:
    """The index of a text's lines (`INDEX`): their number, the segments, a residual per boundary."""

    @F.arrow_udf(INDEX)
    def index(texts: pa.Array) -> pa.Array:
        texts = texts.cast(pa.large_binary())
        at = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
        counts, segments, segment_ends, residuals, residual_ends = [], [], [0], [], [0]
        for i in range(len(texts)):
            found = boundaries(data[at[i] : at[i + 1]])
            own, off = fit(found, error)
            counts.append(len(found) - 1)
            segments += own
            segment_ends.append(len(segments))
            residuals.append(off)
            residual_ends.append(residual_ends[-1] + len(off))
        columns = [pa.array(c, pa.int64()) for c in zip(*segments, strict=True)] or [pa.array([], pa.int64())] * 3
        lines = pa.StructArray.from_arrays(columns, ["rank", "offset", "slope"])
        off = pa.array(np.concatenate(residuals) if residuals else np.empty(0, np.int8), pa.int8())
        return pa.StructArray.from_arrays(
            [
                pa.array(counts, pa.int64()),
                pa.ListArray.from_arrays(pa.array(segment_ends, pa.int32()), lines),
                pa.ListArray.from_arrays(pa.array(residual_ends, pa.int32()), off),
            ],
            ["n", "segments", "residuals"],
        )

    return index(F.coalesce(text, F.lit("")).cast("binary"))


def offset_at(index: Column, rank: Column) -> Column:
    """Code points before line ``rank`` (from 0; the number of lines gives the length): predicted, then corrected."""
    segment = F.element_at(F.filter(index["segments"], lambda s: s["rank"] <= rank), -1)
    predicted = segment["offset"] + F.shiftright(segment["slope"] * (rank - segment["rank"]), SHIFT)
    return predicted + F.element_at(index["residuals"], (rank + 1).cast("int"))


def draw(id_col: Column, seed: int, number: int) -> Column:
    """The ``number``-th (from 1) 8-digit group of the hex SHA-256 of ``seed:id``, unsigned."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_col.cast("string"), F.lit(""))), 256)
    return F.conv(F.substring(digest, 8 * number - 7, 8), 16, 10).cast("long")


def rearrange(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    seed: int = 7,
    rate: int = 100,
    spm_rate: int = 50,
    marks: Marks = Marks(),
    error: int = ERROR,
) -> DataFrame:
    """(rest, n, form, prefix_chars, middle_chars, output): each document as prefix, suffix and middle.

    ``rate`` percent of the documents are rearranged, ``spm_rate`` percent of these with
    the suffix first; ``rest`` holds the columns of ``docs``.  No shuffle; a row is read,
    cut and written on its own.
    """
    ship(docs.sparkSession)
    own = F.col(f"rest.`{id_col}`")
    text, index, n = F.col("body"), F.col("index"), F.col("index.n")
    marked = F.lit(False)
    for m in marks.all:
        marked = marked | F.contains(text, F.lit(m))
    plain = (text == "") | marked | (draw(own, seed, 3) % 100 >= rate)
    form = F.when(plain, "plain").when(draw(own, seed, 4) % 100 < spm_rate, "spm").otherwise("psm")
    cuts = [draw(own, seed, k) % (n + 1) for k in (1, 2)]
    indexed = (
        docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rest"))
        .withColumn("body", F.coalesce(F.col(f"rest.`{text_col}`").cast("string"), F.lit("")))
        .withColumn("index", line_index(text, error))
        .withColumns({"form": form, "first": F.least(*cuts), "second": F.greatest(*cuts)})
        .withColumns({"start": offset_at(index, F.col("first")), "end": offset_at(index, F.col("second"))})
    )
    start, end = F.col("start").cast("int"), F.col("end").cast("int")
    parts = [F.substring(text, F.lit(1), start), F.substring(text, start + 1, end - start), F.substring(text, end + 1, F.lit(2**31 - 1))]
    p, s, m = (F.lit(x) for x in marks.all)
    cut = F.col("form") != "plain"
    output = (
        F.when(F.col("form") == "psm", F.concat(p, parts[0], s, parts[2], m, parts[1]))
        .when(F.col("form") == "spm", F.concat(s, parts[2], p, parts[0], m, parts[1]))
        .otherwise(text)
    )
    return indexed.select(
        "rest",
        n.alias("n"),
        "form",
        F.when(cut, F.col("start")).alias("prefix_chars"),
        F.when(cut, F.col("end") - F.col("start")).alias("middle_chars"),
        output.alias("output"),
    )


def restore(output: Column, form: Column, marks: Marks = Marks()) -> Column:
    """The text that `rearrange` wrote as ``output``.

    Texts that contain a mark are never cut and no mark overlaps itself, so the first
    place of each mark is the written one.
    """

    def between(first: str, second: str) -> Column:
        body = F.substring(output, F.lit(len(first) + 1), F.length(output))
        one, rest = (F.split_part(body, F.lit(second), F.lit(k)) for k in (1, 2))
        two, middle = (F.split_part(rest, F.lit(marks.middle), F.lit(k)) for k in (1, 2))
        return F.concat(one, middle, two) if first == marks.prefix else F.concat(two, middle, one)

    psm, spm = between(marks.prefix, marks.suffix), between(marks.suffix, marks.prefix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
