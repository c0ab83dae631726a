"""Hot keys: one stock code / day holding a third of all lines.

Results are checked against a brute-force pandas computation on the same
small fixture, and the plans are checked for the shape that keeps a hot
key out of a single task (partial aggregation before every exchange,
NULL-key bypass in the sync)."""
import contextlib
import io
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll.operators import marts, sync
from tillroll.plans.registry import Layers


def _explain(df, mode: str) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


@pytest.fixture(scope="module")
def skewed(spark):
    s = Layers(spark, SF_SMALL).star
    fact = s.fact
    n = fact.count()
    hot = fact.where(F.col("stockcode") == fact.select(F.min("stockcode")).first()[0]).limit(1)
    # copies of one line: one product, one day, one customer now hold ~1/3
    copies = hot.select("*", F.explode(F.array_repeat(F.lit(1), n // 2)).alias("_c")).drop("_c")
    return s, fact.unionByName(copies)


def test_top_products_hot_key(spark, skewed):
    s, fact = skewed
    got = [(r.stockcode, r.product_revenue) for r in marts.top_products(fact, s.dim_product).collect()]
    pdf = fact.select("stockcode", "total_price").toPandas()
    exp = (pdf.groupby("stockcode")["total_price"].sum().reset_index()
           .assign(r=lambda d: d.total_price.map(lambda v: Decimal(v).quantize(Decimal("0.01")))))
    exp = exp.sort_values(["r", "stockcode"], ascending=[False, True]).head(10)
    assert got == list(zip(exp.stockcode, exp.r))


def test_daily_kpis_hot_day(spark, skewed):
    s, fact = skewed
    k = marts.daily_kpis(fact, s.dim_date, s.dim_country).toPandas()
    pdf = fact.select("date_key", "country_id", "invoice", "total_price").toPandas()
    exp = pdf.groupby(["date_key", "country_id"]).agg(orders=("invoice", "nunique"),
                                                      net=("total_price", "sum")).reset_index()
    assert len(k) == len(exp)
    assert sorted(k.daily_orders.tolist()) == sorted(exp.orders.tolist())
    assert sum(k.net_revenue) == sum(exp.net)


def test_marts_aggregate_before_exchange(spark, skewed):
    s, fact = skewed
    for df in (marts.revenue_by_month(fact, s.dim_date), marts.top_products(fact, s.dim_product),
               marts.daily_kpis(fact, s.dim_date, s.dim_country)):
        plan = _explain(df, "formatted")
        assert "partial_" in plan, plan


def test_sync_null_keys_bypass_join(spark):
    raw = Layers(spark, SF_SMALL).raw
    plan = _explain(sync.new_rows(raw, raw), "extended")
    optimized = plan.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
    assert "Union" in optimized and "LeftAnti" in optimized


def test_sync_hot_key_copies(spark):
    raw = Layers(spark, SF_SMALL).raw
    n = raw.count()
    one = raw.where(F.col("quantity").isNotNull()).limit(1)
    hot = one.select("*", F.explode(F.array_repeat(F.lit(1), n // 2)).alias("_c")).drop("_c")
    incoming = raw.unionByName(hot)                      # one key holds a third of the batch
    # the hot key exists in raw: every copy is old
    assert sync.new_rows(incoming, raw).count() == raw.where(F.col("quantity").isNull()).count()
    # the hot key is new: every copy is new (the batch is not de-duplicated)
    key = one.first()
    existing = raw.where(~((F.col("invoice") == key.invoice) & (F.col("stockcode") == key.stockcode)
                           & (F.col("invoicedate") == key.invoicedate)))
    n_hot_in_raw = raw.count() - existing.count()
    got = sync.new_rows(incoming, existing).where((F.col("invoice") == key.invoice)
                                                  & (F.col("stockcode") == key.stockcode)
                                                  & (F.col("invoicedate") == key.invoicedate)).count()
    assert got >= n // 2 + 1 and got == n // 2 + n_hot_in_raw


def test_raw_append_spreads_copies_of_one_line(spark, tmp_path):
    from tillroll.plans.pipeline import Warehouse
    raw = Layers(spark, SF_SMALL).raw
    one = raw.limit(1)
    copies = one.select("*", F.explode(F.array_repeat(F.lit(1), 6000)).alias("_c")).drop("_c")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    # AQE would merge these tiny partitions into one; switch that off to see
    # where the range boundaries fall
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        assert wh.sync_raw(copies.unionByName(raw)) == 12000
    finally:
        spark.conf.set(key, before)
    files = [f for f in wh.raw().inputFiles()]
    # the 6000 copies share month and timestamp, yet no single file holds them all
    row = one.first()
    month_files = [f for f in files if f"invoice_month={row.invoicedate.strftime('%Y%m')}/" in f]
    per_file = [spark.read.parquet(f).where((F.col("invoice") == row.invoice)
                                            & (F.col("stockcode") == row.stockcode)).count()
                for f in month_files]
    assert sum(per_file) >= 6000 and max(per_file) < 6000, per_file


@pytest.mark.parametrize("null_safe", [False, True])
def test_sync_hot_key_is_split(spark, null_safe):
    """AQE splits the hot incoming key of the anti join over several tasks."""
    low = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
           "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32k",
           "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5"}
    before = {k: spark.conf.get(k) for k in low}
    raw = Layers(spark, SF_SMALL).raw
    one = raw.where(F.col("quantity").isNotNull()).limit(1)
    # lines of one key, told apart by a column outside it (copies alone would compress to nothing)
    hot = (spark.range(0, 60_000, 1, 16).join(F.broadcast(one)).withColumn("description", F.sha2(F.col("id").cast("string"), 256))
           .select(*raw.columns))
    try:
        for k, v in low.items():
            spark.conf.set(k, v)
        new = sync.new_rows(raw.unionByName(hot), raw, null_safe=null_safe)
        new.collect()
        assert "skew=true" in _explain(new, "simple")
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
