"""Small fixed tables as DataFrames."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession

from .. import settings as S


def _literal(value: object) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    if isinstance(value, float):
        return f"{value!r}D"
    return str(value)


def literal_table(spark: SparkSession, columns: Sequence[str], rows: Iterable[Sequence[object]]) -> DataFrame:
    """A table whose rows are written into the plan."""
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({', '.join(columns)})")


def provinces(spark: SparkSession, key: str = "number") -> DataFrame:
    """``code lat lon name`` by number or by plate letters (at most 52 rows)."""
    rows = [(code if key == "number" else S.PLATE_LETTERS.get(code), lat, lon, name) for code, lat, lon, name in S.PROVINCES]
    return literal_table(spark, ["code", "lat", "lon", "name"], [r for r in rows if r[0] is not None])


def driver_path(spark: SparkSession, year_shift: int = 0) -> DataFrame:
    """Macro drivers by year; ``year_shift`` moves the years for data of another period."""
    return literal_table(spark, ["year", *S.DRIVERS], [(y + year_shift, *v) for y, v in S.DRIVER_PATH.items()])
