import duckdb
import pyarrow as pa
import pytest
from conftest import ODD

from voltgrid.llm import licenses, queries

KIND = [("doc_id", pa.int64()), ("text", pa.string())]


def both(spark, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    df = queries.QUERIES["op4_license_scan"](spark, folder)
    sql = con.execute(f"SELECT {', '.join(df.columns)} FROM ({queries.CHECKS['op4_license_scan']})").fetchall()
    return sorted(map(tuple, df.collect()), key=str), sorted(sql, key=str)


def test_query_against_sql(spark, small):
    got, expected = both(spark, small)
    assert got == expected and any(r[2] for r in got)


def test_texts(spark, folder):
    texts = [
        "MIT License",
        "mit-license; the MIT LICENSE and permission is hereby granted",
        "cc by cc by cc  by, cc/by xcc by cc byx",
        "GNU General Public  License! gnu general public licence",
        "apache apache license license apache.license",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and more",
        "Permission is hereby granted to all",
        "redistribution and use in source and binary forms, with or without modification, are permitted",
        "all rights reserved Kelvin K license mit K",
        "license " * 500 + "mit " * 500 + "license",
        "",
        None,
    ]
    got, expected = both(spark, folder(documents=(KIND, [*enumerate(texts), (3, None), (3, "mit license"), (None, "mit license")])))
    assert got == expected
    rows = {r[0]: r for r in got if r[0] not in (3, None)}
    assert rows[0][2:7] == (1, 0, 0, "mit", "mit") and rows[1][2:7] == (2, 0, 3, "mit", "mit")
    assert rows[2][2] == 4 and rows[4][2:5] == (2, 1, 4)
    assert rows[5][5] == "" and rows[5][6] == "mit" and 0 < rows[5][7] <= 1 and rows[6][6] == ""
    assert rows[7][6] == "bsd" and rows[8][6] == "proprietary" and rows[9][2:5] == (1, 999, 999)
    assert rows[11][1:] == (0, 0, None, None, "", "", 0.0)


def test_odd_rows_and_empty_table(spark, clashing, no_documents):
    rows = {r.doc_id: r for r in licenses.scan(clashing).collect()}
    assert len(rows) == len(ODD) and rows[5].base_labels == "apache,cc-by,gpl,mit" and rows[5].n_base == 4
    assert rows[7].n_words == 3 and rows[1].n_words == 0
    assert licenses.scan(no_documents).isEmpty()


@pytest.mark.parametrize("template", licenses.TEMPLATES)
def test_key_phrases_stand_in_their_templates(template):
    assert f" {template.key} " in f" {template.words} " and any(r[5] for r in template.rows(0))
