"""Driver contract: entry, queries, oracle SQL; a few oracle checks on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from kestrel.sources.tables import DRIVER_TABLES

FAST = ["q03_first_event_per_day", "q07_master_filter", "q16_hourly_delta", "q22_median_mode",
        "q25_sales_consolidation", "q35_stratified_folds"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["customer_name", "customer_segment", "part_name", "supplier_name", "supplier_nation",
                          "order_date", "total_quantity", "total_sales"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    assert set(E.oracle_sql()) <= set(E.queries())
    assert {"q36_forest_cv", "q37_score_holdout"} <= set(E.queries()) - set(E.oracle_sql())


def _norm(rows):
    def n(v):
        if isinstance(v, float):
            return None if math.isnan(v) else repr(v)
        return str(v) if v is not None else None
    return sorted((tuple(n(v) for v in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", FAST)
def test_oracle_agrees_on_small_tables(spark, sf_small, name):
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_small}/{t}.parquet')")
    sdf = E.queries()[name](spark, sf_small)
    cur = con.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(sdf.columns)
    srows = [tuple(r[c] for c in order) for r in sdf.collect()]
    idx = [dcols.index(c) for c in order]
    assert _norm(srows) == _norm([tuple(r[i] for i in idx) for r in drows])
