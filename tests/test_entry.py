"""The driver contract, and some registered queries against their check SQL."""

import shutil
import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[1] / "tools"))

import __spark_entry__ as entry  # noqa: E402
from check_queries import TABLES, canonical, kind  # noqa: E402

FOLDER = Path("/root/testdata/sf0.001")
SAMPLE = [
    "monthly_series_wide",
    "fixed_width_parse",
    "dataset_profile",
    "od_top_flows",
    "registrations_by_province",
    "model_selection",
    "overlay_delta",
    "weight_sensitivity",
    "utm_to_lonlat",
    "fill_thinned",
]


def test_every_check_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(SAMPLE) <= set(entry.oracle_sql())


@pytest.fixture(scope="module")
def duck():
    if not FOLDER.exists():
        pytest.skip("no test tables")
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return connection


def test_entry(spark, duck):
    assert entry.entry(spark).count() == 79


@pytest.mark.parametrize("name", SAMPLE)
def test_query_against_sql(spark, duck, name):
    df = entry.queries()[name](spark, str(FOLDER))
    result = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert {d[0]: kind(str(d[1])) for d in result.description} == dict(df.dtypes)
    assert canonical([tuple(r) for r in df.collect()], df.columns) == canonical(result.fetchall(), columns)


def test_the_rest_loads_without_the_operators_for_training_data(tmp_path):
    """Also where only their package is gone and the pipeline's file still stands there."""
    root = Path(entry.__file__).resolve().parent
    shutil.copytree(root / "voltgrid", tmp_path / "voltgrid", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(root / "__spark_entry__.py", tmp_path)
    (tmp_path / "corpus_pipeline.py").write_text("from voltgrid.llm import language\n")
    told = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()), any(q.startswith('op') and q[2].isdigit() for q in e.queries()))"
    out = subprocess.run([sys.executable, "-c", told], cwd=tmp_path, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) == len(entry.QUERIES) and int(out[1]) == len(entry.CHECKS) and out[2] == "False"
