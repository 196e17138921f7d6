"""Every registered query against its DuckDB oracle on the smallest tables,
and the flagship entry."""

import decimal
import math
import re

import duckdb
import pytest

import __spark_entry__ as E
from medstar.sources.tables import TABLES
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def _rows(pdf):
    cols = sorted(pdf.columns)
    return cols, sorted((tuple(_norm(r[c]) for c in cols) for r in pdf.to_dict("records")),
                        key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.columns == ["row_key", "idCard", "genderId", "ageId", "addr", "inTimeId",
                          "inClassId", "mainDocId", "outSickId"]
    assert df.count() > 0


def test_every_query_has_an_oracle_or_is_rows_only():
    assert set(E.oracle_sql()) <= set(E.queries())
    # queries of the training-data package are checked by its own tests
    own = {q for q in E.queries() if not re.match(r"op\d+_|pipeline$", q)}
    assert own <= set(E.oracle_sql())


@pytest.mark.parametrize("name", sorted(E.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    got = _rows(E.queries()[name](spark, SF_SMALL).toPandas())
    want = _rows(con.execute(E.oracle_sql()[name]).df())
    assert got[0] == want[0]
    assert len(got[1]) == len(want[1])
    assert got[1] == want[1]
