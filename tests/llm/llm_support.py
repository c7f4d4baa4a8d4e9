"""What the tests of the corpus operators share."""

from __future__ import annotations

import os

import duckdb
import pytest

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Columns whose names the operators use inside.
CLASHES = "rid long, name string, row string, size long, keys string, level int, digest string, block long"
CLASHING = (7, "n", "r", 1, "k", 2, "d", 3)


def docs_of(spark, texts, schema=SCHEMA, source="web"):
    """Documents with ids 0.. ; a text may be given as (id, text)."""
    rows = []
    for i, t in enumerate(texts):
        key, text = t if isinstance(t, tuple) else (i, t)
        rows.append((key, text, "en", source, len(text or "")))
    return spark.createDataFrame(rows, schema)


def clashing(docs):
    from pyspark.sql import functions as F

    for field, value in zip(CLASHES.split(", "), CLASHING, strict=True):
        docs = docs.withColumn(field.split()[0], F.lit(value))
    return docs


def oracle(sql, tables=("documents", "pages", "benchmark", "labels")):
    con = duckdb.connect()
    for name in tables:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    cursor = con.execute(sql)
    columns = [c[0] for c in cursor.description]
    rows = [dict(zip(columns, r, strict=True)) for r in cursor.fetchall()]
    con.close()
    return columns, rows


def same_as_sql(frame, sql):
    columns, want = oracle(sql)
    assert sorted(columns) == sorted(frame.columns)
    got = [r.asDict() for r in frame.collect()]
    assert sorted(repr([r[c] for c in columns]) for r in got) == sorted(repr([r[c] for c in columns]) for r in want)


@pytest.fixture(scope="session")
def shipped(spark):
    from tallystone.llm.common import ship

    ship(spark)
    return spark
