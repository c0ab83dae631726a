"""Batch pipeline and continuous ingestion over a scratch warehouse."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll.operators import marts, stats
from tillroll.plans.pipeline import Warehouse, run_batch
from tillroll.sources import testdata
from tillroll.sources.csv import write_retail_csv
from tillroll.streaming.ingest import start_ingest


def test_batch_pipeline(spark, tmp_path):
    view = testdata.retail_lines(spark, SF_SMALL)
    root = str(tmp_path / "wh")
    out = run_batch(spark, view, root)
    assert out["new_raw_rows"] == 6000
    assert out["staging_rows"] == 5109
    assert out["profile"]["total_rows"] == 6000
    assert out["validation"]["negative_price_rows"] == 0
    assert out["star_version"] == 1
    assert all(v == 0 for v in out["fk_orphans"].values())
    assert out["visuals"]["published"] and out["visuals"]["next_version"] == 1

    wh = Warehouse(spark, root)
    star = wh.star()
    assert star.fact.select("fact_id").distinct().count() == star.fact.count()
    # a second daily run: only NULL-key lines come back, the gate then sees new rows
    out2 = run_batch(spark, view, root)
    n_null_key = view.where(F.col("quantity").isNull()).count()
    assert out2["new_raw_rows"] == n_null_key
    assert out2["star_version"] == 2
    # same data again without a sync: gate says unchanged
    from tillroll.plans.pipeline import run_visuals
    again = run_visuals(wh, wh.star(), f"{root}/outputs/figures")
    assert again["changed"] is False and again["published"] is False
    kpis = spark.read.option("header", True).csv(f"{root}/outputs/bi/daily_kpis")
    assert kpis.count() == marts.daily_kpis(star.fact, star.dim_date, star.dim_country).count()
    report = spark.read.text(f"{root}/outputs/modeling/q4_stats_tests_report").collect()
    assert report[0].value.startswith("=== TEST 1") and len(report) == 21
    assert [r["term"] for r in out2["ols"]] == ["const", "is_q4", "daily_orders"]
    assert out2["ols_fit"]["n"] == star.dim_date.count()


def test_stream_ingest_available_now(spark, tmp_path):
    view = testdata.retail_lines(spark, SF_SMALL)
    src = tmp_path / "incoming"
    split = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    write_retail_csv(view.where(F.col("invoicedate") < split), str(src / "y1"))
    root = str(tmp_path / "wh")
    q = start_ingest(spark, str(src / "*"), root)
    q.awaitTermination(120)
    wh = Warehouse(spark, root)
    first = wh.raw().count()
    assert first == view.where(F.col("invoicedate") < split).count()
    # a new file arrives with the rest plus an overlap: only unseen lines land
    write_retail_csv(view, str(src / "y2"))
    q = start_ingest(spark, str(src / "*"), root)
    q.awaitTermination(120)
    overlap_null_keys = view.where((F.col("invoicedate") < split) & F.col("quantity").isNull()).count()
    assert wh.raw().count() == view.count() + overlap_null_keys


def test_catalog_sql_matches_dataframes(spark, tmp_path):
    from tillroll.sources import catalog
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.sync_raw(testdata.retail_lines(spark, SF_SMALL))
    wh.rebuild_staging()
    wh.build_star()
    catalog.register_layers(spark, wh)
    assert spark.sql("SELECT COUNT(*) FROM raw.online_retail").first()[0] == 6000
    assert spark.sql("SELECT COUNT(*) FROM staging.online_retail_clean").first()[0] == 5109
    sql = spark.sql("""SELECT d.year, d.month, d.month_name, ROUND(SUM(f.total_price), 2) AS monthly_revenue
        FROM analytics.fact_sales f JOIN analytics.dim_date d ON d.date_key = f.date_key
        GROUP BY d.year, d.month, d.month_name""")
    s = wh.star()
    df = marts.revenue_by_month(s.fact, s.dim_date)
    assert sql.exceptAll(df).count() == 0 and df.exceptAll(sql).count() == 0
    # a new build repoints the analytics tables
    v2 = wh.build_star()
    catalog.register_layers(spark, wh)
    assert v2 == 2
    assert spark.sql("SELECT COUNT(*) FROM analytics.fact_sales").first()[0] == s.fact.count()


def test_replayed_batch_is_skipped(spark, tmp_path):
    view = testdata.retail_lines(spark, SF_SMALL)
    wh = Warehouse(spark, str(tmp_path / "wh"))
    assert wh.sync_raw(view, batch_id="epoch-0") == 6000
    # a replay of the same epoch (e.g. after a driver restart) appends nothing,
    # not even the NULL-key lines that a plain re-run would re-insert
    assert wh.sync_raw(view, batch_id="epoch-0") == 0
    assert wh.raw().count() == 6000
    n_null_key = view.where(F.col("quantity").isNull()).count()
    assert wh.sync_raw(view, batch_id="epoch-1") == n_null_key


def test_incremental_staging_equals_rebuild(spark, tmp_path):
    view = testdata.retail_lines(spark, SF_SMALL)
    split = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    first, rest = view.where(F.col("invoicedate") < split), view.where(F.col("invoicedate") >= split)
    # two daily runs with incremental staging ...
    run_batch(spark, first, str(tmp_path / "inc"), incremental_staging=True)
    b = run_batch(spark, rest, str(tmp_path / "inc"), incremental_staging=True)
    assert b["star_version"] == 2 and b["staging_rows"] == 5109
    # ... give the same staging and star as one load with a full rebuild
    run_batch(spark, view, str(tmp_path / "full"))
    inc, full = Warehouse(spark, str(tmp_path / "inc")), Warehouse(spark, str(tmp_path / "full"))
    assert inc.staging().exceptAll(full.staging()).count() == 0
    assert full.staging().exceptAll(inc.staging()).count() == 0
    cols = [c for c in full.star().fact.columns if c != "fact_id"]
    assert inc.star().fact.select(cols).exceptAll(full.star().fact.select(cols)).count() == 0


def test_rollup_marts_equal_fact_marts(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    wh.sync_raw(testdata.retail_lines(spark, SF_SMALL))
    wh.rebuild_staging()
    wh.build_star()
    s = wh.star()
    pairs = [
        (marts.total_revenue(s.fact), marts.total_revenue(s.daily)),
        (marts.revenue_by_month(s.fact, s.dim_date), marts.revenue_by_month(s.daily, s.dim_date)),
        (marts.revenue_by_week(s.fact, s.dim_date), marts.revenue_by_week(s.daily, s.dim_date)),
        (marts.revenue_by_country(s.fact, s.dim_country), marts.revenue_by_country(s.daily, s.dim_country)),
        (marts.fig_daily_revenue(s.fact, s.dim_date), marts.fig_daily_revenue(s.daily, s.dim_date)),
        (marts.fig_monthly_revenue(s.fact, s.dim_date), marts.fig_monthly_revenue(s.daily, s.dim_date)),
        (marts.fig_top_countries(s.fact, s.dim_country), marts.fig_top_countries(s.daily, s.dim_country)),
        (marts.fig_revenue_breakdown(s.fact), marts.fig_revenue_breakdown(s.daily)),
        (marts.data_signature(s.fact, s.dim_date), marts.data_signature(s.daily, s.dim_date)),
        (marts.daily_kpis(s.fact, s.dim_date, s.dim_country),
         marts.kpis_from_rollup(s.daily, s.dim_date, s.dim_country)),
        (stats.daily_return_rate(s.fact, s.dim_date), stats.daily_return_rate(s.daily, s.dim_date)),
        (stats.daily_revenue(s.fact, s.dim_date), stats.daily_revenue(s.daily, s.dim_date)),
        (marts.avg_order_value(s.fact), marts.avg_order_value(s.invoices)),
        (stats.q4_daily_dataset(s.fact, s.dim_date), stats.q4_daily_dataset(s.order_source(), s.dim_date)),
        (marts.daily_country_rollup(s.fact), s.daily),
        (s.fact.groupBy("date_key", "country_id").agg(F.count_distinct("invoice").alias("n")),
         s.daily.select("date_key", "country_id", F.col("daily_orders").alias("n"))),
        (marts.daily_kpis(s.fact, s.dim_date, s.dim_country), marts.daily_kpis_of_lines(wh.staging()).drop("date_key")),
    ]
    assert not any("/fact_sales/" in f for f in stats.q4_daily_dataset(s.order_source(), s.dim_date).inputFiles())
    for a, b in pairs:
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_cli_batch_and_sql(spark, tmp_path, capsys):
    from tillroll.__main__ import main
    src = str(tmp_path / "src")
    write_retail_csv(testdata.retail_lines(spark, SF_SMALL), src)
    wh = str(tmp_path / "wh")
    main(["batch", "--source", src, "--warehouse", wh])
    out = capsys.readouterr().out
    assert '"new_raw_rows": 6000' in out and '"staging_rows": 5109' in out
    main(["sql", "--warehouse", wh, "SELECT COUNT(*) AS n FROM analytics.fact_sales"])
    assert "5109" in capsys.readouterr().out


def test_rerun_without_new_lines(spark, tmp_path):
    view = testdata.retail_lines(spark, SF_SMALL)
    root = str(tmp_path / "wh")
    run_batch(spark, view, root, null_safe_sync=True)
    wh = Warehouse(spark, root)
    files_before = sorted(wh.raw().inputFiles())
    out = run_batch(spark, view, root, null_safe_sync=True)
    assert out["new_raw_rows"] == 0
    assert sorted(wh.raw().inputFiles()) == files_before      # nothing appended
    assert out["staging_rows"] == 5109 and out["star_version"] == 2
    assert out["visuals"]["changed"] is False and out["visuals"]["published"] is False


def test_stream_ingest_continuous(spark, tmp_path):
    view = testdata.retail_lines(spark, SF_SMALL)
    src = tmp_path / "incoming"
    split = F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    write_retail_csv(view.where(F.col("invoicedate") < split), str(src / "a"))
    root = str(tmp_path / "wh")
    q = start_ingest(spark, str(src / "*"), root, available_now=False, interval="1 second",
                     query_name="raw_ingest_continuous")
    try:
        q.processAllAvailable()
        wh = Warehouse(spark, root)
        assert wh.raw().count() == view.where(F.col("invoicedate") < split).count()
        write_retail_csv(view.where(F.col("invoicedate") >= split), str(src / "b"))
        q.processAllAvailable()
        assert wh.raw().count() == view.count()
        assert q.isActive
    finally:
        q.stop()


def test_cli_ingest(spark, tmp_path, capsys):
    from tillroll.__main__ import main
    src = str(tmp_path / "src")
    write_retail_csv(testdata.retail_lines(spark, SF_SMALL), src)
    wh = str(tmp_path / "wh")
    main(["ingest", "--source", src, "--warehouse", wh])
    assert Warehouse(spark, wh).raw().count() == 6000
    main(["sql", "--warehouse", wh, "SELECT COUNT(DISTINCT load_batch) AS b FROM raw.online_retail"])
    assert "|1 " in capsys.readouterr().out
