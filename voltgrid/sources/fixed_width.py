"""Fixed-width registration files, plain or inside ZIP archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import text
from ..functions.dates import parse_date

Layout = Sequence[tuple[str, int, int]]

LINES_PER_BATCH = 20_000


def read_lines(spark: SparkSession, path: str, encoding: str = "ISO-8859-1") -> DataFrame:
    """Lines as ``value``; files split at line ends, so one large file uses many tasks."""
    return spark.read.option("encoding", encoding).option("header", "false").option("sep", "\u0001").option(
        "quote", ""
    ).option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").schema("value string").csv(path)


def read_zipped_lines(spark: SparkSession, path: str, encoding: str = "latin-1", partitions: int | None = None) -> DataFrame:
    """Lines of the first member of each archive below a path."""
    archives = spark.read.format("binaryFile").load(path).select("path", "content")
    if partitions:
        archives = archives.repartition(partitions, "path")
    return unzip_lines(archives, encoding)


def unzip_lines(archives: DataFrame, encoding: str = "latin-1") -> DataFrame:
    """Lines of the first member of each archive, from rows of ``path`` and ``content``.

    An archive cannot be split, so it is one task's work; lines leave it in
    batches and the text is never held whole.
    """

    def unzip(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for name, content in zip(batch["path"], batch["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    first = archive.namelist()[0]
                    with archive.open(first) as member:
                        lines: list[str] = []
                        for line in io.TextIOWrapper(member, encoding=encoding):
                            lines.append(line.rstrip("\r\n"))
                            if len(lines) >= LINES_PER_BATCH:
                                yield pd.DataFrame({"value": lines, "source_file": name})
                                lines = []
                        if lines:
                            yield pd.DataFrame({"value": lines, "source_file": name})

    return archives.mapInPandas(unzip, "value string, source_file string")


def keep_ev_lines(
    lines: DataFrame, codes: Sequence[str] = S.EV_CODES, min_length: int = S.REGISTRATION_MIN_LENGTH
) -> DataFrame:
    """Drop short lines and other propulsion codes before anything is parsed."""
    start, end = next((s, e) for n, s, e in S.REGISTRATION_LAYOUT if n == "propulsion_code")
    code = F.trim(F.substring("value", start + 1, end - start))
    return lines.where((F.length("value") >= min_length) & code.isin(*codes))


def split_fields(lines: DataFrame, layout: Layout = S.REGISTRATION_LAYOUT) -> DataFrame:
    """Cut trimmed fields out of ``value``; other columns stay."""
    other = [c for c in lines.columns if c != "value"]
    return lines.selectExpr(*other, *(f"trim(substring(value, {s + 1}, {e - s})) AS {n}" for n, s, e in layout))


def parse_registrations(
    lines: DataFrame,
    codes: Sequence[str] = S.EV_CODES,
    layout: Layout = S.REGISTRATION_LAYOUT,
    min_length: int = S.REGISTRATION_MIN_LENGTH,
) -> DataFrame:
    """Typed registrations: dates, numbers, propulsion label, category with blanks as null."""
    df = split_fields(keep_ev_lines(lines, codes, min_length), layout)
    df = df.withColumns({c: parse_date(F.col(c), "ddMMyyyy") for c in S.REGISTRATION_DATE_FIELDS if c in df.columns})
    df = df.withColumns({c: text.starred_number(F.col(c)) for c in S.REGISTRATION_NUMBER_FIELDS if c in df.columns})
    if "ev_category" in df.columns:
        df = df.withColumn("ev_category", text.blank_to_null(F.col("ev_category")))
    return df.withColumn("propulsion", text.label_of(F.col("propulsion_code"), S.PROPULSION_LABELS, "Other"))


def with_file_month(df: DataFrame, source: str = "source_file") -> DataFrame:
    """``year`` and ``month`` from the last six digits of the file name."""
    stamp = F.regexp_extract(F.col(source), r"(\d{6})\D*$", 1)
    return df.withColumns(
        {"year": F.substring(stamp, 1, 4).try_cast("int"), "month": F.substring(stamp, 5, 2).try_cast("int")}
    )
