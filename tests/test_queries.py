"""Each query against its DuckDB SQL on the smallest tables, and invariants of those that SQL does not express."""

import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry
from cellgrid import queries as core

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in os.listdir(SF):
        con.execute(f"CREATE VIEW {name.split('.')[0]} AS SELECT * FROM '{SF}/{name}'")
    return con


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)].astype(object)
    return sorted(map(repr, df.where(df.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_same_rows(spark, duck, name):
    ours = core.queries()[name](spark, SF).toPandas()
    theirs = duck.execute(core.oracle_sql()[name]).fetchdf()
    assert sorted(ours.columns) == sorted(theirs.columns)
    ints = [c for c in ours.columns if pd.api.types.is_numeric_dtype(theirs[c]) and not pd.api.types.is_bool_dtype(theirs[c])]
    assert rows(ours.astype({c: float for c in ints})) == rows(theirs.astype({c: float for c in ints}))


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_suppression_is_greedy(spark):
    from cellgrid.sources import fixtures

    boxes = fixtures.candidates(spark, SF).toPandas().sort_values(["predicted_iou", "ordinal"], ascending=[False, True])
    kept = []
    for b in boxes.itertuples():
        if not any(k.slide == b.slide and k.x < b.x + b.w and b.x < k.x + k.w and k.y < b.y + b.h and b.y < k.y + k.h for k in kept):
            kept.append(b)
    assert {r.ordinal for r in core.queries()["roi_nms"](spark, SF).collect()} == {k.ordinal for k in kept}
