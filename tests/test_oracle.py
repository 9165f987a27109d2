"""Every query against its SQL in DuckDB: names, row counts and values."""

import datetime
import math

import pytest

from __spark_entry__ import oracle_sql, queries
from accesslens.catalog import QUERIES
from accesslens.oracle import ORACLE


def _comparable(value):
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    kept = [tuple(_comparable(row[i]) for i in order) for row in rows]
    return sorted(kept, key=lambda row: [(v is None, str(v)) for v in row])


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_oracle(name, spark, duck, sf_dir):
    result = QUERIES[name](spark, sf_dir)
    expected = duck.execute(ORACLE[name])
    columns = [c[0] for c in expected.description]
    assert sorted(result.columns) == sorted(columns)
    assert _rows(result.columns, result.collect()) == _rows(
        columns, expected.fetchall()
    )
