"""Every query of the driver's contract against its DuckDB SQL, on the smallest tables."""

import pathlib

import duckdb
import pandas as pd
import pytest

import __spark_entry__

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def rows(df: pd.DataFrame) -> list[str]:
    columns = sorted(df.columns)
    return sorted(str([None if pd.isna(x) else x.item() if hasattr(x, "item") else x for x in r]) for r in df[columns].itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(__spark_entry__.queries()))
def test_query(spark, con, name):
    got = __spark_entry__.queries()[name](spark, SF).toPandas()
    if sql := __spark_entry__.oracle_sql().get(name):
        want = con.execute(sql).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert rows(got) == rows(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0


def test_only_the_entry_knows_llm():
    root = pathlib.Path(__spark_entry__.__file__).parent
    for f in root.glob("quillmill/**/*.py"):
        if "llm" not in f.parts:
            assert "quillmill.llm" not in f.read_text() and "corpus_pipeline" not in f.read_text(), f
