"""Plan properties the scale design relies on, checked on a written warehouse."""
import contextlib
import io

import pytest

from tests.conftest import SF_SMALL
from tillroll.operators import marts, sync
from tillroll.operators.staging import staging_clean
from tillroll.operators.star import fact_sales
from tillroll.plans.pipeline import Warehouse
from tillroll.schemas import RAW_COLUMNS
from tillroll.sources import testdata


def physical(df) -> str:
    """The physical plan as ``explain("formatted")`` prints it (after an
    action on ``df`` this is AQE's final plan)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def wh(spark, tmp_path_factory):
    w = Warehouse(spark, str(tmp_path_factory.mktemp("plans") / "wh"))
    w.sync_raw(testdata.retail_lines(spark, SF_SMALL))
    w.rebuild_staging()
    w.build_star()
    return w


def test_staging_is_one_stage_with_pushed_filters(wh):
    plan = physical(staging_clean(wh.raw()))
    assert "Exchange" not in plan
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line]
    assert pushed and all(f in pushed[0] for f in
                          ("IsNotNull(quantity)", "IsNotNull(price)", "GreaterThanOrEqual(price,0.00)"))


def test_fact_build_broadcasts_countries_and_never_shuffles_staging(wh):
    s = wh.star()
    df = fact_sales(wh.staging(), s.dim_country, countries_materialized=True)
    df.collect()
    plan = physical(df)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert "ShuffleExchange" not in plan.replace("BroadcastExchange", "")


def test_sync_anti_join_is_a_shuffle_join(wh):
    raw = wh.raw().select(*RAW_COLUMNS)
    df = sync.new_rows(raw, raw)
    df.collect()
    plan = physical(df)
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert "BroadcastHashJoin LeftAnti" not in plan


def test_marts_read_only_needed_columns(wh):
    s = wh.star()
    plan = physical(marts.revenue_by_month(s.fact, s.dim_date))
    # formatted explain: one block per node; the fact scan's block names its
    # folder in Location and lists the columns it reads in ReadSchema
    blocks = [b for b in plan.split("\n\n") if "Scan parquet" in b and "fact_sales" in b]
    schemas = [ln for b in blocks for ln in b.splitlines() if ln.startswith("ReadSchema")]
    assert schemas and all("invoice" not in ln and "customer_id" not in ln for ln in schemas), plan


def test_revenue_marts_on_rollup_do_not_scan_the_fact(wh):
    s = wh.star()
    files = marts.revenue_by_week(s.daily, s.dim_date).inputFiles()
    assert files and not any("/fact_sales/" in f for f in files)
    assert any("/agg_daily_country/" in f for f in files)


def test_no_cross_joins_in_checks(wh):
    from tillroll.operators import quality
    s = wh.star()
    for df in (quality.star_dim_counts(s.dim_date, s.dim_country, s.dim_product, s.dim_customer),
               quality.dq_fk_orphans(s.fact, s.dim_date, s.dim_country, s.dim_product, s.dim_customer),
               quality.val_reconcile(wh.staging(), wh.raw())):
        plan = physical(df)
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_registered_star_keys_scan_raw_with_their_columns_only(spark):
    """Keys on the star read raw as Parquet, pruned, not as a checkpointed RDD of whole rows."""
    from tillroll.plans import registry
    df = registry.queries()["biz_total_revenue"](spark, SF_SMALL)
    plan = physical(df)
    scans = [ln for b in plan.split("\n\n") if "Scan parquet" in b and "/raw-" in b
             for ln in b.splitlines() if ln.startswith("ReadSchema")]
    assert scans and all("customer_id" not in ln and "total_price" not in ln for ln in scans), plan
    # the only RDD left is the numbered countries
    assert all("country" in ln for b in plan.split("\n\n") if "Scan ExistingRDD" in b
               for ln in b.splitlines() if ln.startswith("Output")), plan
