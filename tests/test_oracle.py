"""Every query with an oracle statement matches DuckDB on the smallest tables."""

from __future__ import annotations

import pytest

from sample_tables import SF_SMALL

import __spark_entry__ as entry
import oracle_compare as oc

NAMES = sorted(entry.oracle_sql())


@pytest.fixture(scope="module")
def con():
    return oc.duckdb_con(SF_SMALL)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert oc.type_mismatches(df, con.sql(entry.oracle_sql()[name])) == []
    assert len(srows) == len(drows)
    assert oc.digest(df.columns, srows) == oc.digest(dcols, drows)
