"""Every query with SQL gives the same rows as DuckDB on the smallest tables."""

import math
from pathlib import Path

import duckdb
import pytest

from parley.plans.oracles import SQL
from parley.plans.queries import QUERIES

DATA = Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no tables here")


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        c.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 8) + 0.0
    return int(v) if isinstance(v, int) and not isinstance(v, bool) else v


def rows_of(found, names):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([plain(r[i]) for i in order]) for r in found)


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows(spark, db, name):
    df = QUERIES[name](spark, str(DATA))
    cur = db.execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert rows_of(df.collect(), df.columns) == rows_of(cur.fetchall(), names)


def test_flow_gives_both_formats_and_scores_in_range(spark):
    df = QUERIES["conversation_flow"](spark, str(DATA)).collect()
    assert df and all(0 <= r["quality_score"] <= 1 for r in df)
    assert {r["pair_format"] for r in df} <= {"conversational", "qna"}


def test_flow_with_files_of_one_speaker(spark, tmp_path):
    said = "Well this is a long remark about nothing at all. What is it that you want to know here? It is a fine day and the sun is up. We all go out. Why not. Because of many things that we can not say now."
    rows = [(1, t, "assistant", said) for t in range(3)] + [(2, t, ("user", "assistant")[t % 2], said) for t in range(6)] + [(3, t, "user", said) for t in range(2)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").coalesce(1).write.parquet(str(tmp_path / "conversations.parquet"))
    df = QUERIES["conversation_flow"](spark, str(tmp_path))
    c = duckdb.connect()
    c.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    cur = c.execute(SQL["conversation_flow"])
    names, got = [d[0] for d in cur.description], df.collect()
    assert {r["pair_format"] for r in got} == {"conversational", "qna"} and {r["file_id"] for r in got} == {1, 2, 3}
    assert rows_of(got, df.columns) == rows_of(cur.fetchall(), names)
