import sys
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SMALL = Path("/root/testdata/sf0.001")

#: shapes that every operator on documents must cope with
ODD = [
    (3, "Is and the of. " * 30, "en", "src1", 10),
    (1, None, None, None, None),
    (2, "", "en", "src1", 0),
    (4, " \t\n", None, "src2", 3),
    (5, "MIT License, CC BY! Apache License; GNU General Public License", "en", None, 5),
    (6, "été ñandú straße 数据 😀 " * 8, "fr", "src2", 7),
    (7, "une " + "x" * 30_000 + " fin", "fr", "src1", 30_008),
    (8, "Is and the of. " * 30, "en", "src1", 10),
    (9, "12 34 -- !!", "de", "src3", 11),
    (10, "is AND the of. " * 30, "en", "src3", 10),
    (11, "der die das und ist nicht " * 4_000, "de", "src0", 100_000),
    (-4, "el la los las y que " * 9, "es", "src0", 1),
]


@pytest.fixture(scope="session")
def small():
    if not SMALL.exists():
        pytest.skip("no test tables")
    return str(SMALL)


@pytest.fixture(scope="session")
def documents(small):
    rows = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{small}/documents.parquet' ORDER BY doc_id").fetchall()
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture(scope="session")
def clashing(odd):
    """The odd rows with columns named as the operators' own ones."""
    from pyspark.sql import functions as F

    names = "size target taken key bucket rank n rest id length piece part block kept spans fingerprint component_id text_hash vector label word words file found".split()
    return odd.select("*", *[F.lit(k).cast("string").alias(n) for k, n in enumerate(names)])


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


@pytest.fixture
def folder(tmp_path):
    """Writes tables where queries look for them."""

    def write(**tables):
        for name, (schema, rows) in tables.items():
            columns = list(zip(*rows, strict=True)) or [()] * len(schema)
            arrays = [pa.array(c, t) for c, t in zip(columns, (t for _, t in schema), strict=True)]
            pq.write_table(pa.table(arrays, names=[n for n, _ in schema]), tmp_path / f"{name}.parquet")
        return str(tmp_path)

    return write
