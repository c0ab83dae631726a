"""Hand fixture: every cleaning / star rule pinned row by row."""
import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tillroll.operators import marts, quality, sync
from tillroll.operators.staging import expected_staging_filter, staging_clean
from tillroll.operators.star import build_star
from tillroll.sources.csv import read_retail_csv, read_retail_csv_blank_as_null


def _layers(spark, path):
    raw = read_retail_csv(spark, path)
    stg = staging_clean(raw)
    return raw, stg, build_star(stg)


def test_csv_scan_binds_by_position(spark, fixture_csv):
    raw = read_retail_csv(spark, fixture_csv)
    assert raw.columns == ["invoice", "stockcode", "description", "quantity", "invoicedate",
                           "price", "customer_id", "country"]
    rows = raw.collect()
    assert len(rows) == 18
    assert rows[0].invoicedate == dt.datetime(2009, 12, 1, 7, 45)
    assert rows[0].price == Decimal("6.95")
    assert rows[1].description == "  BLUE MUG "          # padding kept on read
    assert rows[6].description is None                    # empty cell -> NULL
    assert rows[12].country == "   "                      # blank kept by the CSV job
    assert rows[13].invoicedate is None
    assert rows[17].invoice is None


def test_blank_as_null_load(spark, fixture_csv):
    rows = read_retail_csv_blank_as_null(spark, fixture_csv).collect()
    assert rows[12].country is None
    assert rows[16].stockcode is None
    assert rows[1].description == "  BLUE MUG "          # not trimmed, only blank -> NULL


def test_staging_rules(spark, fixture_csv):
    raw, stg, _ = _layers(spark, fixture_csv)
    assert stg.count() == 12
    assert expected_staging_filter(raw).count() == 13     # NULL description kept by that rule
    got = {(r.invoice, r.stockcode): r for r in stg.collect() if r.invoice}
    assert got[("100001", "A101")].description == "BLUE MUG"
    assert got[("100001", "A101")].total_price == Decimal("12.60")
    assert got[("C100002", "A100")].total_price == Decimal("-13.90")
    assert got[("100005", "BANK")].description == "BANK CHARGES"   # filtered before trim
    assert ("100003", "M") not in got and ("100004", "BANK") not in got
    assert ("100009", "A103") not in got                  # negative price out
    assert got[("100010", "A103")].total_price == Decimal("0.00")  # zero price in
    assert ("100014", "m") in got                          # case-sensitive M
    assert quality.val_non_product(stg).first()[0] == 1
    assert quality.val_reconcile(stg, raw).first().asDict() == {"staging_rows": 12, "expected_rows": 13}


def test_star_rules(spark, fixture_csv):
    _, stg, star = _layers(spark, fixture_csv)
    assert star.fact.count() == 8
    assert star.dim_country.count() == 2
    assert star.dim_product.count() == 8
    assert star.dim_customer.count() == 3
    assert star.dim_date.count() == 7
    assert marts.total_revenue(star.fact).first()[0] == Decimal("189.45")
    d = {r.full_date: r for r in star.dim_date.collect()}
    assert d[dt.date(2010, 1, 1)].week_of_year == 53 and d[dt.date(2010, 1, 1)].year == 2010
    assert d[dt.date(2010, 1, 3)].day_of_week == 1 and d[dt.date(2010, 1, 3)].day_name == "Sunday"
    assert d[dt.date(2009, 12, 1)].date_key == 20091201 and d[dt.date(2009, 12, 1)].month_name == "December"
    products = {r.stockcode for r in star.dim_product.collect()}
    assert "A106" in products                               # NULL-invoice line still names a product
    assert "" not in products and "  " not in products
    top = marts.top_customers(star.fact, star.dim_customer).collect()
    assert all(r.customer_id is not None for r in top)
    orphans = quality.dq_fk_orphans(star.fact, star.dim_date, star.dim_country, star.dim_product,
                                    star.dim_customer).first()
    assert all(v == 0 for v in orphans)


def test_second_sync_reinserts_null_key_rows(spark, fixture_csv):
    incoming = read_retail_csv(spark, fixture_csv)
    first = sync.new_rows(incoming, incoming.limit(0))
    assert first.count() == 18
    again = sync.new_rows(incoming, first).collect()
    assert len(again) == 4
    assert sorted((r.invoice or "") for r in again) == ["", "100007", "100008", "100013"]
    # null-safe variant: nothing is new the second time
    assert sync.new_rows(incoming, first, null_safe=True).count() == 0
    # prune-by-month gives the same answer
    assert sync.new_rows(incoming, first, prune_by_month=True).count() == 4
    # also where dates are NULL on both sides
    dateless = incoming.withColumn("invoicedate", F.when(F.col("quantity") > 3, F.col("invoicedate")))
    for null_safe in (True, False):
        plain = sync.new_rows(dateless, dateless.limit(9), null_safe=null_safe)
        pruned = sync.new_rows(dateless, dateless.limit(9), null_safe=null_safe, prune_by_month=True)
        assert pruned.exceptAll(plain).count() == 0 and plain.exceptAll(pruned).count() == 0


def test_keep_null_description_option(spark, fixture_csv):
    raw = read_retail_csv(spark, fixture_csv)
    assert staging_clean(raw, keep_null_description=True).count() == 13


def test_union_yearly_by_name(spark, fixture_csv):
    raw = read_retail_csv(spark, fixture_csv)
    a = raw.where(F.year("invoicedate") == 2009)
    b = raw.where((F.year("invoicedate") != 2009) | F.col("invoicedate").isNull()).select(*reversed(raw.columns))
    u = sync.union_yearly([a, b])
    assert u.columns == raw.columns and u.count() == 18


def test_unparsed_cells_are_counted(spark, tmp_path):
    from tillroll.sources.csv import parse_quality
    d = tmp_path / "bad"
    d.mkdir()
    (d / "f.csv").write_text(
        "Invoice,StockCode,Description,Quantity,InvoiceDate,Price,Customer ID,Country\n"
        "1,A,X,2,1/2/2010 10:00,1.00,13085.0,France\n"
        "2,B,Y,3,1/2/2010 10:00,2.00,13085,France\n")
    lines = read_retail_csv(spark, str(d), keep_unparsed=True)
    rows = lines.orderBy("invoice").collect()
    assert rows[0].customer_id is None and rows[0]._unparsed is not None
    assert rows[1].customer_id == 13085 and rows[1]._unparsed is None
    assert tuple(parse_quality(lines).first()) == (2, 1)


def test_change_gate_versions(spark, tmp_path):
    from tillroll.sources import state
    from tillroll.operators import marts
    raw = read_retail_csv(spark, str(tmp_path.parent / "src") if False else _fixture_dir(tmp_path))
    star = build_star(staging_clean(raw))
    path = str(tmp_path / "state")
    sig = marts.data_signature(star.fact, star.dim_date, with_revenue=True)
    g1 = state.change_gate(sig, state.read_state(spark, path)).first()
    assert g1.changed and g1.next_version == 1 and g1.max_date == "2010-10-05" and g1.n_rows == 8
    state.write_state(spark.createDataFrame([g1.asDict()]), path)
    g2 = state.change_gate(sig, state.read_state(spark, path)).first()
    assert not g2.changed and g2.next_version == 1 and g2.previous_version == 1
    edited = star.fact.withColumn("total_price", F.col("total_price") + 1)
    g3 = state.change_gate(marts.data_signature(edited, star.dim_date, with_revenue=True),
                           state.read_state(spark, path)).first()
    assert g3.changed and g3.next_version == 2      # same count, different revenue
    g4 = state.change_gate(marts.data_signature(edited, star.dim_date), state.read_state(spark, path)).first()
    assert not g4.changed                              # the plain signature does not see it


def _fixture_dir(tmp_path):
    from tests.conftest import FIXTURE_CSV
    d = tmp_path / "fx"
    d.mkdir(exist_ok=True)
    (d / "f.csv").write_text(FIXTURE_CSV)
    return str(d)


def test_null_safe_sync_partial_overlap(spark, fixture_csv):
    incoming = read_retail_csv(spark, fixture_csv)
    # existing = the first 2009 lines only (incl. one NULL-free duplicate pair)
    existing = incoming.where(F.col("invoicedate") < F.lit("2009-12-02 00:00:00").cast("timestamp_ntz"))
    n_existing_lines = existing.count()
    plain = sync.new_rows(incoming, existing).count()
    safe = sync.new_rows(incoming, existing, null_safe=True).count()
    # rows 1, 2 and their duplicate (row 15) match; nothing else does
    assert n_existing_lines == 3
    assert plain == 18 - 3 and safe == 18 - 3
    # NULL keys: with null-safe equality a NULL-key line matches itself
    assert sync.new_rows(incoming, incoming, null_safe=True).count() == 0
    assert sync.new_rows(incoming, incoming).count() == 4


def test_yearly_files_read_and_union(spark, tmp_path):
    from tests.conftest import FIXTURE_CSV
    header, *lines = FIXTURE_CSV.strip().splitlines()
    y1 = [ln for ln in lines if "/2009 " in ln]
    y2 = [ln for ln in lines if "/2009 " not in ln]
    d = tmp_path / "yearly"
    d.mkdir()
    (d / "year_2009.csv").write_text("\n".join([header] + y1) + "\n")
    (d / "year_2010.csv").write_text("\n".join([header] + y2) + "\n")
    files = [str(d / "year_2009.csv"), str(d / "year_2010.csv")]
    frames = [read_retail_csv(spark, f) for f in files]
    u = sync.union_yearly(frames)
    assert u.count() == 18 and [f.count() for f in frames] == [len(y1), len(y2)]
    # one glob read gives the same lines (new files are picked up by pattern)
    g = read_retail_csv(spark, str(d / "*.csv"))
    assert g.exceptAll(u).count() == 0 and u.exceptAll(g).count() == 0


def test_corrupt_state_fails_loudly(spark, tmp_path):
    import pytest
    from tillroll.sources import state
    missing = state.read_state(spark, str(tmp_path / "nothing-here"))
    assert missing.count() == 0                        # first run
    bad = tmp_path / "state"
    bad.mkdir()
    (bad / "part-0.json").write_text('{"data_signature": {"max_date": "2011-12-09", "n_rows": "many"}, "version": 3}\n')
    with pytest.raises(Exception):
        state.read_state(spark, str(bad)).collect()
