"""Named queries over the test tables: key -> f(spark, sf_dir) -> DataFrame.

Each query builds the layers it needs lazily from the retail view
(raw -> staging -> star) and returns the operator's DataFrame in the
portable output form (``portable``): money as double, dates and
timestamps as ISO strings, the same form as the CSV exports.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, DecimalType, TimestampNTZType, TimestampType

from tillroll.operators import marts, quality, stats, sync
from tillroll.operators.staging import staging_clean
from tillroll.operators import star as star_ops
from tillroll.operators.star import build_star
from tillroll.schemas import CSV_SCHEMA
from tillroll.session import scratch_root
from tillroll.plans.pipeline import Warehouse
from tillroll.sources import csv as csv_src
from tillroll.sources import publish, state, testdata


def portable(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


class Layers:
    """Lazily built layers for one (spark, sf_dir).

    ``raw_view`` is the retail view over the test tables, computed where it
    is read. ``raw`` is the same view written once as Parquet in the shared
    scratch folder, as the pipeline's raw table is: keys that read raw several
    times (the sync reads batch, existing lines and batch months; the fact
    needs staging and the countries in it) scan it instead of re-running the
    five-table join, each scan with its own columns and filters. Keys that
    read raw once use the view directly and pay no materialization.
    """

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    @cached_property
    def raw_view(self) -> DataFrame:
        return testdata.retail_lines(self.spark, self.sf_dir)

    @cached_property
    def raw(self) -> DataFrame:
        path = self.scratch("raw")
        self.raw_view.write.parquet(path)
        return self.spark.read.schema(CSV_SCHEMA).parquet(path)

    @cached_property
    def staging_once(self) -> DataFrame:
        """Staging for keys that read it once."""
        return staging_clean(self.raw_view)

    @cached_property
    def staging(self) -> DataFrame:
        """Staging over the materialized raw (read by several consumers)."""
        return staging_clean(self.raw)

    @cached_property
    def star(self):
        return build_star(self.staging, with_id=False)

    # single dimensions read staging once: no materialized raw, no country
    # numbering unless asked for
    def dim_only(self, build):
        return build(self.staging_once)

    def scratch(self, name: str) -> str:
        return f"{scratch_root(self.spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _raw(fn):
    return lambda L: fn(L.raw_view)


def _stg(fn):
    return lambda L: fn(L.staging_once)


def _fact(fn):
    return lambda L: fn(L.star.fact)


def _fd(fn):
    return lambda L: fn(L.star.fact, L.star.dim_date)


# ---------------------------------------------------------------- I/O-shaped keys

def _union_yearly(L: Layers) -> DataFrame:
    split = F.lit(testdata.YEARLY_SPLIT).cast("timestamp_ntz")
    first = L.raw.where(F.col("invoicedate") < split)
    second = L.raw.where(~(F.col("invoicedate") < split) | F.col("invoicedate").isNull())
    return sync.union_yearly([first, second])


def _sync_new_rows(L: Layers) -> DataFrame:
    existing = L.raw.where(F.col("invoicedate") < F.lit(testdata.EXISTING_BEFORE).cast("timestamp_ntz"))
    return sync.new_rows(L.raw, existing, prune_by_month=True)


def _sync_new_rows_null_safe(L: Layers) -> DataFrame:
    """Some lines have no date, on both sides: null-safe keys match them too."""
    dateless = F.col("quantity").isNull() | (F.col("quantity") % 7 == 0)
    lines = L.raw.withColumn("invoicedate", F.when(~dateless, F.col("invoicedate")))
    before = F.lit(testdata.EXISTING_BEFORE).cast("timestamp_ntz")
    existing = lines.where((F.col("invoicedate") < before) | (F.col("invoicedate").isNull() & (F.col("stockcode") < "5")))
    return sync.new_rows(lines, existing, null_safe=True, prune_by_month=True)


def _scan_csv(L: Layers, blank_as_null: bool) -> DataFrame:
    path = L.scratch("csv-src")
    csv_src.write_retail_csv(L.raw_view, path)
    reader = csv_src.read_retail_csv_blank_as_null if blank_as_null else csv_src.read_retail_csv
    return reader(L.spark, path)


def _change_gate(L: Layers, stored: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """The gate's decision on the fact's signature after a first run, or with
    a state of version 4 stored for the lines that ``stored`` picks."""
    sig = marts.data_signature(L.star.fact, L.star.dim_date)
    if stored is None:
        return state.change_gate(sig, state.read_state(L.spark, L.scratch("gate-state")))
    before = marts.data_signature(stored(L.star.fact), L.star.dim_date)
    path = L.scratch("gate-state")
    state.write_state(before.select(F.col("max_date").cast("string").alias("max_date"), "n_rows",
                                    F.lit(4).cast("long").alias("next_version")), path)
    return state.change_gate(sig, state.read_state(L.spark, path))


def _warehouse_incremental(L: Layers) -> DataFrame:
    """Staging of a warehouse fed by three batches that overlap: two through
    the daily run's route, one that only the stream brought into raw. Equals
    the rule on all lines, whichever route they came."""
    first, second = (F.lit(d).cast("timestamp_ntz") for d in (testdata.YEARLY_SPLIT, testdata.EXISTING_BEFORE))
    wh = Warehouse(L.spark, L.scratch("warehouse"))
    date = F.col("invoicedate")
    wh.sync_raw(L.raw.where((date < second) | date.isNull()), null_safe=True, batch_id="day-1", landed=True)
    wh.stage_missing()
    wh.sync_raw(L.raw.where((date >= first) & (F.pmod(F.hash("invoice"), F.lit(2)) == 0)), null_safe=True, batch_id="epoch-1", landed=True)
    wh.sync_raw(L.raw, null_safe=True, batch_id="day-2", landed=True)
    wh.stage_missing()
    return wh.staging()


def _warehouse_daily_kpis(L: Layers) -> DataFrame:
    """The KPIs of such a warehouse, refreshed by day after each batch."""
    second = F.lit(testdata.EXISTING_BEFORE).cast("timestamp_ntz")
    wh = Warehouse(L.spark, L.scratch("warehouse"))
    date, third = F.col("invoicedate"), F.pmod(F.hash("invoice"), F.lit(3)) == 0
    for batch, lines in (("day-1", (date < second) & ~third), ("day-2", date >= second), ("day-3", F.lit(True))):
        wh.sync_raw(L.raw.where(lines), null_safe=True, batch_id=batch, landed=True)
        wh.stage_missing()
        wh.refresh_daily_kpis()
    return wh.daily_kpis()


def _publish(L: Layers) -> DataFrame:
    root = L.scratch("figures")
    return publish.publish_figure_feeds(L.spark, L.star, root, version=1)


def _welch_rev(L: Layers) -> DataFrame:
    s = stats.daily_revenue(L.star.fact, L.star.dim_date)
    return stats.round_welch(stats.welch_test(s, "revenue", name="daily_revenue"), 4)


def _welch_rate(L: Layers) -> DataFrame:
    s = stats.daily_return_rate(L.star.fact, L.star.dim_date)
    return stats.round_welch(stats.welch_test(s, "return_rate", name="return_rate"), 6)


def _ols(L: Layers) -> DataFrame:
    d = stats.q4_daily_dataset(L.star.fact, L.star.dim_date)
    o = stats.ols_q4(d)
    return o.select("term", *[F.round(c, 4).alias(c) for c in ("coef", "se", "t")],
                    F.round("p", 6).alias("p"))


def _ols_fit(L: Layers) -> DataFrame:
    d = stats.q4_daily_dataset(L.star.fact, L.star.dim_date)
    return stats.ols_q4_fit(d).select("n", F.round("r2", 6).alias("r2"), F.round("adj_r2", 6).alias("adj_r2"))


def _report(L: Layers) -> DataFrame:
    return stats.q4_report(stats.daily_revenue(L.star.fact, L.star.dim_date),
                           stats.daily_return_rate(L.star.fact, L.star.dim_date))


_BUILDERS: dict[str, Callable[[Layers], DataFrame]] = {
    # profiling (raw)
    "prof_total_rows": _raw(quality.prof_total_rows),
    "prof_nulls": _raw(quality.prof_nulls),
    "prof_spacing": _raw(quality.prof_spacing),
    "prof_signs": _raw(quality.prof_signs),
    "prof_cancelled": _raw(quality.prof_cancelled),
    "prof_date_range": _raw(quality.prof_date_range),
    "prof_country_dist": _raw(quality.prof_country_dist),
    "prof_dup_keys": _raw(quality.prof_dup_keys),
    "prof_price_range": _raw(quality.prof_price_range),
    "prof_qty_range": _raw(quality.prof_qty_range),
    "prof_top_abs_qty": _raw(quality.prof_top_abs_qty),
    "prof_top_price": _raw(quality.prof_top_price),
    "prof_negative_price": _raw(quality.prof_negative_price),
    "prof_non_product": _raw(quality.prof_non_product),
    "prof_summary": _raw(quality.profile_raw),
    # sync and staging
    "union_yearly": _union_yearly,
    "sync_new_rows": _sync_new_rows,
    "sync_new_rows_null_safe": _sync_new_rows_null_safe,
    "staging_clean": lambda L: L.staging_once,
    "warehouse_incremental": _warehouse_incremental,
    "warehouse_daily_kpis": _warehouse_daily_kpis,
    "scan_csv_fixture": lambda L: _scan_csv(L, blank_as_null=False),
    "load_blank_as_null": lambda L: _scan_csv(L, blank_as_null=True),
    # staging validation
    "val_row_count": _stg(quality.val_row_count),
    "val_negative_price": _stg(quality.val_negative_price),
    "val_non_product": _stg(quality.val_non_product),
    "val_spacing": _stg(quality.val_spacing),
    "val_total_price": _stg(quality.val_total_price),
    "val_expected_rows": _raw(quality.val_expected_rows),
    "val_returns_kept": _stg(quality.val_returns_kept),
    "val_cancelled_kept": _stg(quality.val_cancelled_kept),
    "val_reconcile": lambda L: quality.val_reconcile(L.staging, L.raw),
    "val_summary": _stg(quality.validate_staging),
    # star schema
    "star_dim_date": lambda L: L.dim_only(star_ops.dim_date),
    "star_dim_country": lambda L: L.dim_only(star_ops.dim_country),
    "star_dim_product": lambda L: L.dim_only(star_ops.dim_product),
    "star_dim_customer": lambda L: L.dim_only(star_ops.dim_customer),
    "star_fact_sales": lambda L: L.star.fact,
    "star_rows_check": lambda L: quality.star_rows_check(L.staging, L.star.fact),
    "star_fact_reconcile": lambda L: quality.star_fact_reconcile(L.staging, L.star.fact),
    "star_dim_counts": lambda L: quality.star_dim_counts(L.star.dim_date, L.star.dim_country,
                                                         L.star.dim_product, L.star.dim_customer),
    "star_net_revenue": _fact(quality.star_net_revenue),
    "dq_fk_orphans": lambda L: quality.dq_fk_orphans(L.star.fact, L.star.dim_date, L.star.dim_country,
                                                     L.star.dim_product, L.star.dim_customer),
    # business questions
    "biz_total_revenue": _fact(marts.total_revenue),
    "rev_by_month": _fd(marts.revenue_by_month),
    "top_products": lambda L: marts.top_products(L.star.fact, L.star.dim_product),
    "top_customers": lambda L: marts.top_customers(L.star.fact, L.star.dim_customer),
    "rev_by_country": lambda L: marts.revenue_by_country(L.star.fact, L.star.dim_country),
    "avg_order_value": _fact(marts.avg_order_value),
    "return_impact": _fact(marts.return_impact),
    "rev_by_week": _fd(marts.revenue_by_week),
    # exports and figure feeds
    "daily_kpis": lambda L: marts.daily_kpis(L.star.fact, L.star.dim_date, L.star.dim_country),
    "data_signature": _fd(marts.data_signature),
    "change_gate": _change_gate,
    "change_gate_unchanged": lambda L: _change_gate(L, stored=lambda fact: fact),
    "change_gate_bumped": lambda L: _change_gate(L, stored=lambda fact: fact.where(F.col("quantity") > 0)),
    "fig_daily_revenue": _fd(marts.fig_daily_revenue),
    "fig_monthly_revenue": _fd(marts.fig_monthly_revenue),
    "fig_top_countries": lambda L: marts.fig_top_countries(L.star.fact, L.star.dim_country),
    "fig_top_products": lambda L: marts.fig_top_products(L.star.fact, L.star.dim_product),
    "fig_revenue_breakdown": _fact(marts.fig_revenue_breakdown),
    "publish_marts": _publish,
    # statistics
    "daily_revenue": _fd(stats.daily_revenue),
    "daily_return_rate": _fd(stats.daily_return_rate),
    "q4_daily_dataset": _fd(stats.q4_daily_dataset),
    "welch_daily_revenue": _welch_rev,
    "welch_return_rate": _welch_rate,
    "ols_q4": _ols,
    "ols_q4_fit": _ols_fit,
    "q4_report_lines": _report,
}


def _wrap(builder):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(builder(Layers(spark, sf_dir)))
    return run


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: _wrap(b) for k, b in _BUILDERS.items()}


FLAGSHIP = "daily_kpis"
