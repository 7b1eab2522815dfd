"""Every registered query of the core against its SQL twin over the smallest tables, where they exist."""

import os

import pytest

from driftline.plans import catalog

D = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(D), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in os.listdir(D):
        con.execute(f"create view {t[:-8]} as select * from '{D}/{t}'")
    return con


#: Queries whose right result over these small tables is empty.
EMPTY_HERE = {"row_floor", "silent_users", "snapshot_floor", "spread_baseline", "spread_breaches", "still_live"}

#: What must hold of the results of queries that SQL cannot express.
CHECKS = {
    "p4_blocks": lambda rows: _unique(rows, 2),
    "p4_runs": lambda rows: _unique(rows, 3),
    "p4_links": lambda rows: _all(rows, lambda r: r[3] == 0),
    "blocks_render": lambda rows: _unique(rows, 1),
    "md_parse": lambda rows: _unique(rows, 2),
    "roundtrip": lambda rows: _all(rows, lambda r: r[1] == r[2] and r[4]),
    "page_document": lambda rows: _all(rows, lambda r: r[1].startswith("# ")),
}


def _unique(rows, n):
    assert rows and len({tuple(r[k] for k in (0, *range(1, n))) for r in rows}) == len(rows)


def _all(rows, holds):
    assert rows and all(holds(r) for r in rows)


def canon(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple("~" if r[i] is None else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, duck, name):
    df = catalog.QUERIES[name](spark, D)
    rows = [tuple(r) for r in df.collect()]
    if name in catalog.ORACLES:
        got = duck.execute(catalog.ORACLES[name])
        names = [c[0] for c in got.description]
        assert sorted(names) == sorted(df.columns)
        assert canon(rows, df.columns) == canon(got.fetchall(), names)
        assert rows or name in EMPTY_HERE, "a comparison of nothing with nothing"
    else:
        CHECKS[name](rows)
