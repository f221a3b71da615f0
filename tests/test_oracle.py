"""Every registered query with an oracle must equal its DuckDB SQL on the
smallest driver tables (column names, row count, sorted values)."""

import pytest

import __spark_entry__ as entry
import tools.oracle_check as oc
from tools.oracle_check import compare

# compare float reprs: a value hash sees -0.0 vs 0.0 and Decimal vs double
oc.STRICT = True

from tables_dir import SF_SMALL

ORACLES = entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    res = duck.execute(ORACLES[name])
    drows = res.fetchall()
    dcols = [d[0] for d in res.description]
    assert compare(rows, df.columns, drows, dcols) is None


def test_every_query_has_a_builder():
    assert set(ORACLES) <= set(entry.queries())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() == 4
    assert "column" in df.columns
