"""Every query with a SQL twin, on the smallest tables, against DuckDB
(row count, column names and an order-insensitive hash of rounded values)."""
import hashlib
import math

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

ORACLE = {k: v for k, v in E.oracle_sql().items() if k not in E._LLM}  # those of llm are tested in tests/llm


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    return repr(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return hashlib.md5("\n".join(lines).encode()).hexdigest()


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF_SMALL)
    rows = df.collect()
    rel = duck.execute(ORACLE[name])
    ocols = [d[0] for d in rel.description]
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert _digest(df.columns, rows) == _digest(ocols, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert df.columns == ["lang", "rank", "token", "freq"]
