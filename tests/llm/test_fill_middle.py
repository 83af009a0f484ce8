"""Fill-in-the-middle: the rank index against its sequence, the operator against plain Python, the query against SQL."""

import hashlib
import re

import duckdb
import numpy as np
import pytest
from conftest import ODD
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from voltgrid.llm import fill_middle, queries


def plain(doc_id, text, seed=7, rate=100, spm_rate=50, marks=("<P>", "<S>", "<M>")):
    text = text or ""
    lines = re.findall(r"[^\n]*\n|[^\n]+", text)
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(lines)
    a, b = sorted(x % (n + 1) for x in h[:2])
    if not text or any(m in text for m in marks) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, m, s = "".join(lines[:a]), "".join(lines[a:b]), "".join(lines[b:])
    if h[3] % 100 < spm_rate:
        return n, "spm", len(p), len(m), marks[1] + s + marks[0] + p + marks[2] + m
    return n, "psm", len(p), len(m), marks[0] + p + marks[1] + s + marks[2] + m


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(1, 90), st.integers(1, 100_000)), max_size=400), st.sampled_from([0, 1, 7, 63, 126]))
def test_segments_are_within_the_error_and_residuals_exact(steps, error):
    values = np.concatenate([[0], np.cumsum(np.array(steps, np.int64))]).astype(np.int64)
    segments, residuals = fill_middle.fit(values, error)
    assert np.abs(residuals.astype(int)).max() <= error + 1
    firsts = [s[0] for s in segments]
    for k, v in enumerate(values.tolist()):
        rank, offset, slope = segments[np.searchsorted(firsts, k, "right") - 1]
        assert offset + (slope * (k - rank) >> fill_middle.SHIFT) + int(residuals[k]) == v


def test_even_lines_need_one_segment_and_long_ones_few():
    assert len(fill_middle.fit(np.arange(0, 4_000_000, 40))[0]) == 1
    random = np.random.default_rng(3)
    values = np.concatenate([[0], np.cumsum(random.integers(60, 100, 50_000))])
    assert len(fill_middle.fit(values)[0]) < 2_500


def test_errors_that_do_not_fit_and_bad_marks_are_refused():
    with pytest.raises(ValueError):
        fill_middle.fit(np.arange(3), 127)
    for marks in (("", "b", "c"), ("aba", "x", "y"), ("<P>", "<P>", "<M>")):
        with pytest.raises(ValueError):
            fill_middle.Marks(*marks)


def test_query_against_sql(spark, small):
    got = queries.QUERIES["op13_fill_middle"](spark, small)
    duckdb.sql(f"CREATE OR REPLACE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    want = duckdb.sql(queries.CHECKS["op13_fill_middle"])
    assert got.columns == want.columns
    assert sorted(map(tuple, got.collect())) == sorted(want.fetchall())
    assert {r.form for r in got.collect()} >= {"psm", "spm"}


TEXTS = [
    (20, "one\n\ntwo\r\nthree"),
    (21, "\n\n\n"),
    (22, "a <P> in it\nb"),
    (23, "line <S\n<M\n" * 40),
    (24, "é数😀\n" * 700 + "end"),
    (25, "x" * 100_000 + "\n" + "short\n" * 300),
    (26, "<S><S>\n"),
    (None, "no id\nat all\n"),
]


@pytest.mark.parametrize(("rate", "spm_rate", "marks"), [(100, 50, ("<P>", "<S>", "<M>")), (60, 0, ("<P>", "<S>", "<M>")), (100, 100, ("PRE:", "[SUF]", "|mid"))])
def test_odd_rows_against_plain_python(spark, clashing, rate, spm_rate, marks):
    rows = clashing.select("*", F.lit("x").alias("output"), F.lit("x").alias("form"), F.lit("x").alias("index"), F.lit("x").alias("body"))
    more = spark.createDataFrame(TEXTS, "doc_id long, text string")
    rows = rows.unionByName(more, allowMissingColumns=True).unionByName(more, allowMissingColumns=True)
    own = fill_middle.Marks(*marks)
    out = fill_middle.rearrange(rows, rate=rate, spm_rate=spm_rate, marks=own)
    got = out.select("rest.doc_id", "n", "form", "prefix_chars", "middle_chars", "output", fill_middle.restore(F.col("output"), F.col("form"), own).alias("back"), "rest.text").collect()
    want = sorted(((d, *plain(d, t, 7, rate, spm_rate, marks)) for d, t in [(r[0], r[1]) for r in ODD] + TEXTS + TEXTS), key=repr)
    assert sorted((tuple(r)[:6] for r in got), key=repr) == want
    assert all(r.back == (r.text or "") for r in got)


def test_empty_table(spark, no_documents):
    assert fill_middle.rearrange(no_documents).isEmpty()
