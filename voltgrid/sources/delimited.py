"""Delimited files: explicit schemas, separators, encodings, bad lines, provenance."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import settings as S
from ..functions import text
from ..functions import geodesy as G
from ..functions.dates import file_name_date
from ..operators import cleaning as C

CORRUPT = "_corrupt_record"
#: the file a row came from, as it is called (Spark's column has it as part of a URL)
FILE_NAME = "url_decode(replace(_metadata.file_name, '+', '%2B'))"
FILE_PATH = "url_decode(replace(_metadata.file_path, '+', '%2B'))"
#: holds the first field after the last column
_SURPLUS = "_surplus_field"


def read_strings(
    spark: SparkSession,
    path: str | Sequence[str],
    columns: Sequence[str] | None = None,
    sep: str = ";",
    encoding: str = "UTF-8",
    skip_bad_lines: bool = True,
    source_file: bool = False,
) -> DataFrame:
    """All columns as text.

    With ``columns`` the header line is skipped and names go by position, which
    is what files with repeated or padded header names need.  Bad lines are
    dropped, or kept with their text in ``_corrupt_record``; lines are parsed
    whole for this, because with column pruning a line would count as good or
    bad depending on the columns a query reads.  Gzip files are read as they
    are.
    """
    if columns is None:
        return read_by_header(spark, path, sep=sep, encoding=encoding, source_file=source_file)
    extra = _SURPLUS if skip_bad_lines else CORRUPT
    fields = ", ".join(f"`{c}` string" for c in [*columns, extra])
    reader = (
        spark.read.option("header", "true")
        .option("sep", sep)
        .option("encoding", encoding)
        .option("columnPruning", "false")
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", "true")
        .schema(fields)
    )
    if skip_bad_lines:
        df = reader.csv(path).where(F.col(_SURPLUS).isNull())
        named = [F.col(f"`{c}`") for c in columns]
        return df.select(*named, *[F.expr(FILE_NAME).alias("source_file")] * source_file)
    df = reader.option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    return df.select("*", F.expr(FILE_NAME).alias("source_file")) if source_file else df


def headers_of(spark: SparkSession, files: Sequence[str], sep: str = ";", encoding: str = "UTF-8") -> dict[tuple[str, ...], list[str]]:
    """Files by the names in their first line: trimmed, without byte-order mark, repeats numbered.

    One job over all files, however many there are: a file's first line is the one with
    the smallest row id in the split that begins it.  The ids alone are compared, so no
    line is sorted; a second look takes the lines with those ids.  Few rows come to the
    driver, one per header, with the names of its files.
    """
    lines = spark.read.option("encoding", encoding).option("sep", "\u0001").option("quote", "").schema("value string").csv(list(files))
    lines = lines.select(
        "value", F.expr(FILE_PATH).alias("file"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("id")
    )
    begun = lines.where("start = 0")
    first_ids = begun.groupBy("file").agg(F.min("id").alias("id"))
    firsts = begun.join(F.broadcast(first_ids), ["file", "id"]).select("file", F.col("value").alias("header"))
    found: dict[tuple[str, ...], list[str]] = {}
    rows = firsts.groupBy("header").agg(F.sort_array(F.collect_list("file")).alias("files")).collect()
    for row in sorted(rows, key=lambda r: r["header"] or ""):
        names = (row["header"] or "").lstrip("\ufeff").split(sep)
        header = C.unique_headers([n.replace("\n", " ").strip().strip('"').strip() for n in names])
        found.setdefault(tuple(header), []).extend(row["files"])
    return found


def read_by_header(
    spark: SparkSession,
    path: str | Sequence[str],
    names: Mapping[str, str] | None = None,
    sep: str = ";",
    encoding: str = "UTF-8",
    source_file: bool = False,
) -> DataFrame:
    """Files whose headers may differ, as text columns joined by name.

    Every file is read with its own header (renamed by ``names``, repeats numbered), files
    with equal headers together; a column that a file lacks is null there.  The number of
    jobs does not grow with the files.
    """
    paths = [path] if isinstance(path, str) else list(path)
    groups: dict[tuple[str, ...], list[str]] = {}
    for header, own in headers_of(spark, paths, sep, encoding).items():
        groups.setdefault(tuple(C.unique_headers([(names or {}).get(c, c) for c in header])), []).extend(own)
    if not groups:  # files without a line
        return spark.createDataFrame([], "source_file string" if source_file else "")
    parts = [
        read_strings(spark, path if len(groups) == 1 else own, list(header), sep, encoding, source_file=source_file)
        for header, own in groups.items()
    ]
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), parts)


def with_spanish_numbers(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Parse the columns that exist as ``1.234,5`` numbers."""
    return df.withColumns({c: text.spanish_number(F.col(c)) for c in columns if c in df.columns})


# --------------------------------------------------------------------------
# road flows
# --------------------------------------------------------------------------
OD_SCHEMA = "date string, origin_zone string, destination_zone string, route_id string, distance_km double, trips double"


def read_clean_od(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Cleaned origin-destination files of many dates; zone and route ids stay text."""
    df = spark.read.option("header", "true").schema(OD_SCHEMA).csv(path)
    return df.withColumn("date", F.try_to_date("date", "yyyy-MM-dd"))


def read_raw_flows(spark: SparkSession, path: str | Sequence[str], kind: str) -> DataFrame:
    """Raw (optionally gzip) flow files of one kind, cleaned by its registered cleaner."""
    sep, cleaner = C.CLEANERS[kind]
    return cleaner(read_by_header(spark, path, sep=sep))


def read_segments(spark: SparkSession, path: str | Sequence[str], sep: str = ";") -> DataFrame:
    """Segment files with the date taken from the first eight characters of the file name."""
    raw = read_by_header(spark, path, sep=sep, source_file=True)
    return C.clean_segments(raw.withColumn("date", file_name_date(name="source_file")).drop("source_file"))


# --------------------------------------------------------------------------
# substations
# --------------------------------------------------------------------------
# fixed values: header names of the distributors' files
_COMMON = {
    "Gestor de red": "grid_operator",
    "Subestación": "substation_id",
    "Capacidad firme disponible (MW)": "capacity_available_mw",
    "Capacidad disponible (MW)": "capacity_available_mw",
    "Capacidad comprometida por cuestiones regulatorias": "capacity_regulatory_mw",
    "Capacidad de acceso firme de demanda ocupada (MW)": "capacity_occupied_mw",
    "Capacidad ocupada (MW)": "capacity_occupied_mw",
    "Capacidad de acceso firme admitida y no evaluada (MW)": "capacity_pending_mw",
    "Nivel de Tensión (kV)": "voltage_kv",
    "Nivel de tensión (kV)": "voltage_kv",
    "Coordenada UTM X": "utm_x",
    "Coordenada UTM Y": "utm_y",
    "Posiciones ocupadas": "positions_occupied",
    "Posiciones libres": "positions_free",
    "Nudo 0*": "node_zero",
    "Comentarios": "comments",
    "Nombre Subestación": "substation_name",
    "Nombre subestación": "substation_name",
}
IBERDROLA_NAMES = {**_COMMON, "Provincia": "province", "Municipio": "municipality"}
VIESGO_NAMES = IBERDROLA_NAMES
ENDESA_NAMES = {
    **_COMMON,
    "Provincia": "province_code",
    "Municipio": "municipality_code",
    "Provincia_1": "province_name",
    "Municipio_1": "municipality_name",
    "Nudo Afeción RdT": "node_rdt_affected",
    "Nudo limitado por Scc": "node_scc_limited",
    "Comunidad Autónoma": "autonomous_community",
}
CAPACITIES = ["voltage_kv", "capacity_available_mw", "capacity_regulatory_mw", "capacity_occupied_mw", "capacity_pending_mw"]


def _substations(spark, path, names, encoding, decimal_only, boxed, source_file) -> DataFrame:
    df = read_by_header(spark, path, names, encoding=encoding, source_file=source_file)
    number = text.decimal_comma_number if decimal_only else text.spanish_number
    df = df.withColumns({c: number(F.col(c)) for c in CAPACITIES if c in df.columns})
    df = with_spanish_numbers(df, ["utm_x", "utm_y"]).withColumns({"x": F.col("utm_x"), "y": F.col("utm_y")})
    df = G.with_lonlat(df)
    return C.in_area(df) if boxed else df


def read_iberdrola(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Grouped thousands everywhere; outside the bounding box is dropped."""
    return _substations(spark, path, IBERDROLA_NAMES, "UTF-8", decimal_only=False, boxed=True, source_file=False)


def read_endesa(spark: SparkSession, path: str | Sequence[str], boxed: bool = False) -> DataFrame:
    """Several files with repeated headers; the file name stays as ``source_file``."""
    return _substations(spark, path, ENDESA_NAMES, "UTF-8", decimal_only=False, boxed=boxed, source_file=True)


def read_viesgo(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Latin-1; capacities have a decimal comma only; rows without id are dropped."""
    df = _substations(spark, path, VIESGO_NAMES, "ISO-8859-1", decimal_only=True, boxed=False, source_file=False)
    return C.drop_null_keys(df, ["substation_id"])


OPERATOR_TAGS = tuple(S.DISTRIBUTOR_NAMES)


def first_rows(df: DataFrame, n: int | None = None, order: Sequence[str] | None = None) -> DataFrame:
    """An optional row limit for previews; off by default, ordered when asked."""
    if n is None:
        return df
    return (df.orderBy(*order) if order else df).limit(n)
