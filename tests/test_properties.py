"""Cross-query invariants on the test tables."""
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from tillroll.operators import marts, quality, sync
from tillroll.plans.registry import Layers


def test_revenue_identities(spark):
    L = Layers(spark, SF_SMALL)
    s = L.star
    total = marts.total_revenue(s.fact).first()[0]
    kpis = marts.daily_kpis(s.fact, s.dim_date, s.dim_country)
    k = kpis.agg(F.sum("net_revenue"), F.sum("gross_revenue"), F.sum("returns_revenue")).first()
    assert round(k[0], 2) == total
    assert kpis.where(F.col("gross_revenue") + F.col("returns_revenue") != F.col("net_revenue")).count() == 0
    assert round(k[1] + k[2], 2) == total
    by_month = marts.revenue_by_month(s.fact, s.dim_date).agg(F.sum("monthly_revenue")).first()[0]
    assert abs(by_month - total) < 0.01 * 200   # per-month rounding only
    bd = {r.type: r.amount for r in marts.fig_revenue_breakdown(s.fact).collect()}
    assert bd["Gross Sales"] + bd["Returns"] == bd["Net Revenue"]


def test_fk_orphans_zero(spark):
    s = Layers(spark, SF_SMALL).star
    r = quality.dq_fk_orphans(s.fact, s.dim_date, s.dim_country, s.dim_product, s.dim_customer).first()
    assert tuple(r) == (0, 0, 0, 0)


def test_second_sync_only_null_keys(spark):
    raw = Layers(spark, SF_SMALL).raw
    again = sync.new_rows(raw, raw)
    n_null_key = raw.where(F.col("quantity").isNull()).count()
    assert again.count() == n_null_key
    assert again.where(F.col("quantity").isNotNull()).count() == 0


def test_star_rebuild_idempotent(spark):
    a = Layers(spark, SF_SMALL).star
    b = Layers(spark, SF_SMALL).star
    for x, y in [(a.dim_date, b.dim_date), (a.dim_country, b.dim_country),
                 (a.dim_product, b.dim_product), (a.fact, b.fact)]:
        assert x.exceptAll(y).count() == 0 and y.exceptAll(x).count() == 0


def test_profile_single_scan_agrees(spark):
    raw = Layers(spark, SF_SMALL).raw
    one = quality.profile_raw(raw).first().asDict()
    assert one["total_rows"] == quality.prof_total_rows(raw).first()[0]
    assert one["null_quantity"] == quality.prof_nulls(raw).first()["null_quantity"]
    assert one["negative_price"] == quality.prof_signs(raw).first()["negative_price"]


def test_dense_number_is_distributed_and_dense(spark):
    from tillroll.operators.keys import dense_number
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).cast("string").alias("k"))
    out = dense_number(df, "k", "kid", num_partitions=7)
    rows = out.collect()
    assert sorted(r.kid for r in rows) == list(range(1, 5001))
    ordered = sorted(rows, key=lambda r: r.k)
    assert [r.kid for r in ordered] == list(range(1, 5001))


def test_dense_number_default_partitions(spark):
    from tillroll.operators.keys import dense_number
    df = spark.range(0, 20000, numPartitions=13).select(F.format_string("k%06d", (F.col("id") * 7919) % 20000).alias("k"))
    rows = dense_number(df, "k", "kid").collect()
    assert [r.kid for r in sorted(rows, key=lambda r: r.k)] == list(range(1, 20001))


def test_cluster_conf_sizes_partitions():
    from tillroll.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, executor_memory_gb=16, executor_cores=4, executors=1000)
    parts = int(c["spark.sql.shuffle.partitions"])
    assert 2 * 4000 <= parts <= 100_000
    # the largest shuffle (30% of the input) lands at about the advisory size per partition
    assert 0.3 * 100 * 1024 ** 4 / parts <= int(c["spark.sql.adaptive.advisoryPartitionSizeInBytes"]) * 1.01
    maps = 100 * 1024 ** 4 / int(c["spark.sql.files.maxPartitionBytes"])
    assert maps <= 250_000
    assert c["spark.sql.adaptive.skewJoin.enabled"] == "true"
