"""Write PLANS.md: the final (post-AQE) physical plan of the main queries.

Usage: python tools/dump_plans.py [sf_dir]   (default /root/testdata/sf0.1)
Builds a scratch warehouse, runs each query once (so AQE settles its
plan), and records the plan tree of ``explain("formatted")``.
"""

from __future__ import annotations

import contextlib
import io
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def tree(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    text = buf.getvalue()
    head = text.split("\n\n\n")[0]
    return "\n".join(line for line in head.splitlines() if line.strip())


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tillroll.operators import marts, quality, stats, sync
    from tillroll.operators.staging import staging_clean
    from tillroll.operators.star import fact_sales
    from tillroll.plans.pipeline import Warehouse
    from tillroll.session import build_session, scratch_root
    from tillroll.sources import testdata

    spark = build_session()
    wh = Warehouse(spark, f"{scratch_root(spark)}/plans-{int(time.time())}")
    view = testdata.retail_lines(spark, sf_dir)
    wh.sync_raw(view)
    wh.rebuild_staging()
    wh.build_star()
    s = wh.star()
    raw = wh.raw().select(*view.columns)
    items = [
        ("staging rebuild (raw -> staging)", staging_clean(wh.raw())),
        ("fact build (staging x size-checked broadcast dim_country)",
         fact_sales(wh.staging(), s.dim_country, countries_materialized=True)),
        ("second sync (anti-join, NULL-key bypass)", sync.new_rows(raw, raw)),
        ("rev_by_month on the day x country rollup", marts.revenue_by_month(s.daily, s.dim_date)),
        ("top_products (aggregate by stockcode, then join dim_product)",
         marts.top_products(s.fact, s.dim_product)),
        ("top_customers", marts.top_customers(s.fact, s.dim_customer)),
        ("avg_order_value (exact distinct count)", marts.avg_order_value(s.fact)),
        ("daily_kpis from the fact", marts.daily_kpis(s.fact, s.dim_date, s.dim_country)),
        ("daily_kpis from the rollup", marts.kpis_from_rollup(s.daily, s.dim_date, s.dim_country)),
        ("profile_raw (one scan)", quality.profile_raw(wh.raw())),
        ("fk orphans", quality.dq_fk_orphans(s.fact, s.dim_date, s.dim_country, s.dim_product,
                                             s.dim_customer)),
        ("Welch test on daily revenue", stats.welch_test(stats.daily_revenue(s.daily, s.dim_date), "revenue")),
        ("OLS moments + closed form", stats.ols_q4(stats.q4_daily_dataset(s.fact, s.dim_date))),
    ]
    out = ["# Physical plans (final, after AQE)", "",
           f"Generated by `tools/dump_plans.py` on `{sf_dir}` over the written warehouse "
           "(local[8]). Each query was run once before `explain(\"formatted\")`, so the "
           "plans show AQE's runtime choices (broadcast conversions, coalesced shuffles).", ""]
    for title, df in items:
        df.collect()
        out += [f"## {title}", "", "```", tree(df), "```", ""]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    with open(path, "w") as f:
        f.write("\n".join(out))
    print(path)
    spark.stop()


if __name__ == "__main__":
    main()
