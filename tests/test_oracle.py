"""Every registered key against its DuckDB oracle (order-insensitive)."""
import pytest

import __spark_entry__ as E
from tests.conftest import SF_SMALL
from tests.oracle_check import compare, duck
from tillroll.plans import oracle, registry

# the keys of this package; other packages that add keys to the entry test their own
KEYS = sorted(registry.queries())


@pytest.fixture(scope="module")
def con():
    return duck(SF_SMALL)


def test_every_key_has_an_oracle():
    assert sorted(oracle.oracle_sql()) == KEYS
    assert set(KEYS) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("key", KEYS)
def test_key_matches_oracle(spark, con, key):
    r = compare(spark, SF_SMALL, key, E.queries()[key], E.oracle_sql().get(key), con)
    assert r["status"] in ("match", "rows-only"), r
    assert r["spark_rows"] > 0


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["full_date", "year", "month", "month_name", "country", "daily_orders",
                          "gross_revenue", "returns_revenue", "net_revenue", "is_q4"]
    assert df.count() > 0


@pytest.mark.parametrize("key", ["avg_order_value", "welch_return_rate", "ols_q4", "staging_clean",
                                 "q4_report_lines", "val_total_price"])
def test_keys_match_with_ansi_off(spark, con, key):
    """Sessions that turn ANSI off (as older runtimes did) get the same results."""
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        r = compare(spark, SF_SMALL, key, E.queries()[key], E.oracle_sql().get(key), con)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    assert r["status"] == "match", r
