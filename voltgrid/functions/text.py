"""Text cleaning and number parsing.  Every parser returns null on bad input."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """Trim; an empty string becomes null."""
    return F.nullif(F.trim(c), F.lit(""))


def to_double(c: Column) -> Column:
    """Cast that gives null instead of an error."""
    return F.trim(c).try_cast("double")


def spanish_number(c: Column) -> Column:
    """``1.234,5`` -> 1234.5 (dot groups thousands, comma marks decimals)."""
    return to_double(F.replace(F.replace(c, F.lit("."), F.lit("")), F.lit(","), F.lit(".")))


def decimal_comma_number(c: Column) -> Column:
    """``12,5`` -> 12.5; dots are kept, so ``1.234,5`` does not parse."""
    return to_double(F.replace(c, F.lit(","), F.lit(".")))


def starred_number(c: Column) -> Column:
    """Drop the first ``*`` and cast."""
    return to_double(F.regexp_replace(c, r"^([^*]*)\*", "$1"))


def code_prefix(c: Column, length: int = 2) -> Column:
    """First characters of a zone code, as text so that leading zeros stay."""
    return F.substring(c.cast("string"), 1, length)


def label_of(c: Column, labels: Mapping[str, str], default: str | None = None) -> Column:
    """Look a code up in a small fixed mapping; unknown or null codes give ``default``."""
    pairs = [F.lit(v) for kv in labels.items() for v in kv]
    found = F.try_element_at(F.create_map(*pairs), c)
    return F.coalesce(found, F.lit(default)) if default is not None else found


def relabel(c: Column, labels: Mapping[str, str]) -> Column:
    """Like :func:`label_of`, but values without an entry stay as they are."""
    return F.coalesce(label_of(c, labels), c)


def mentions_any(c: Column, words: Sequence[str]) -> Column:
    """True where the upper-cased text contains one of the words."""
    return F.upper(F.coalesce(c, F.lit(""))).rlike("|".join(words))


def starts_with_any(c: Column, prefixes: Sequence[str]) -> Column:
    """True where the upper-cased, null-filled text starts with one of the prefixes."""
    return F.upper(F.coalesce(c, F.lit(""))).rlike("^(" + "|".join(prefixes) + ")")


def byte_size_text(n_bytes: Column) -> Column:
    """``1536`` -> ``1.50 KB``; null counts as zero."""
    n = F.coalesce(n_bytes.cast("double"), F.lit(0.0))
    text = F.format_string("%.2f TB", n / F.lit(float(1024**4)))
    for power, unit in ((3, "GB"), (2, "MB"), (1, "KB"), (0, "B")):
        text = F.when(
            n < F.lit(float(1024 ** (power + 1))),
            F.format_string(f"%.2f {unit}", n / F.lit(float(1024**power))),
        ).otherwise(text)
    return text
