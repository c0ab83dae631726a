"""Benchmark: the daily batch and the headline queries at one scale factor.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Prints ONE JSON line:
  {"metric": "batch_plus_queries_sec", "value": N, "unit": "sec",
   "queries": {...}, "sf": ...}

Phases (each timed):
  load_raw / rebuild_staging / build_star: the pipeline writes its layers
  to a scratch warehouse (Parquet), as the daily job does;
  <query>: headline queries over the written star, run to completion into
  the no-op sink (all rows produced, nothing collected), cold then warm
  (``<query>_warm``);
  e2e_<key>: registered keys computed from the raw test tables end to end.
``value`` sums the pipeline phases and the cold query runs. ``io_mb`` gives
per phase the MB read by tasks and the shuffle MB written, from Spark's
event log (written to a scratch folder, ``BENCH_EVENTLOG_DIR``).
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    from tillroll.operators import marts, quality, stats, sync
    from tillroll.plans.pipeline import Warehouse
    from tillroll.plans.registry import queries
    from tillroll.session import build_session, scratch_root
    from tillroll.sources import testdata

    # Spark's event log goes to a scratch folder; after the run it gives the
    # bytes read and shuffled per phase (jobs are tagged with the phase name)
    eventlog = os.environ.get("BENCH_EVENTLOG_DIR") or tempfile.mkdtemp(prefix="tillroll-eventlog-")
    os.makedirs(eventlog, exist_ok=True)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2),
                          extra={"spark.driver.memory": "16g",
                                 "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
                                 "spark.eventLog.enabled": "true",
                                 "spark.eventLog.dir": eventlog})
    # scratch warehouse under the session's checkpoint folder (shared storage
    # on a cluster; a local scratch folder only when none is configured)
    scratch = f"{scratch_root(spark)}/bench-{int(time.time())}"
    t: dict[str, float] = {}

    def timed(name, fn):
        spark.sparkContext.setJobDescription(name)
        t0 = time.perf_counter()
        fn()
        t[name] = round(time.perf_counter() - t0, 3)
        spark.sparkContext.setJobDescription(None)

    def run(df):
        df.write.format("noop").mode("overwrite").save()

    wh = Warehouse(spark, f"{scratch}/wh")
    view = testdata.retail_lines(spark, sf_dir)
    timed("load_raw", lambda: wh.sync_raw(view))
    timed("rebuild_staging", lambda: wh.rebuild_staging())
    timed("build_star", lambda: wh.build_star())
    s = wh.star()
    raw, stg = wh.raw(), wh.staging()

    headline = {
        "profile_raw": lambda: quality.profile_raw(raw),
        "validate_staging": lambda: quality.validate_staging(stg),
        "sync_second_run": lambda: sync.new_rows(raw.select(*view.columns), raw.select(*view.columns)),
        # revenue-by-day/country marts read the day x country rollup, as the
        # pipeline does; product / customer / invoice marts read the fact
        "rev_by_month": lambda: marts.revenue_by_month(s.revenue_source(), s.dim_date),
        "top_products": lambda: marts.top_products(s.fact, s.dim_product),
        "top_customers": lambda: marts.top_customers(s.fact, s.dim_customer),
        "rev_by_country": lambda: marts.revenue_by_country(s.revenue_source(), s.dim_country),
        "avg_order_value": lambda: marts.avg_order_value(s.order_source()),
        "rev_by_week": lambda: marts.revenue_by_week(s.revenue_source(), s.dim_date),
        "daily_kpis": lambda: marts.kpis_from_rollup(s.daily, s.dim_date, s.dim_country),
        "daily_kpis_from_fact": lambda: marts.daily_kpis(s.fact, s.dim_date, s.dim_country),
        "q4_daily_dataset": lambda: stats.q4_daily_dataset(s.order_source(), s.dim_date),
        "welch_daily_revenue": lambda: stats.welch_test(stats.daily_revenue(s.revenue_source(), s.dim_date),
                                                        "revenue"),
        "ols_q4": lambda: stats.ols_q4(stats.q4_daily_dataset(s.order_source(), s.dim_date)),
        "fk_orphans": lambda: quality.dq_fk_orphans(s.fact, s.dim_date, s.dim_country, s.dim_product,
                                                    s.dim_customer),
    }
    for name, build in headline.items():
        timed(name, lambda b=build: run(b()))
    for name, build in headline.items():
        timed(f"{name}_warm", lambda b=build: run(b()))

    reg = queries()
    for key in ("daily_kpis", "staging_clean", "sync_new_rows", "rev_by_month", "welch_daily_revenue"):
        timed(f"e2e_{key}", lambda k=key: run(reg[k](spark, sf_dir)))

    value = round(sum(v for k, v in t.items()
                      if not k.endswith("_warm") and not k.startswith("e2e_")), 3)
    app_id = spark.sparkContext.applicationId
    spark.stop()
    io_mb = {k: v for k, v in io_per_phase(eventlog, app_id).items() if k in t}
    print(json.dumps({"metric": "batch_plus_queries_sec", "value": value, "unit": "sec",
                      "queries": t, "sf": sf, "cpus": cpus, "io_mb": io_mb}))


def _event_lines(eventlog_dir: str, app_id: str):
    """Lines of the application's event log: a single file, or Spark 4's
    rolling folder ``eventlog_v2_<app>/events_<n>_<app>[.zstd]``."""
    entries = [os.path.join(eventlog_dir, f) for f in os.listdir(eventlog_dir) if app_id in f]
    files = []
    for e in entries:
        if os.path.isdir(e):
            parts = [f for f in os.listdir(e) if f.startswith("events_")]
            parts.sort(key=lambda f: int(f.split("_")[1]))
            files += [os.path.join(e, f) for f in parts]
        else:
            files.append(e)
    for f in files:
        if f.endswith(".zstd"):
            import io as _io

            import zstandard
            with open(f, "rb") as raw:
                text = _io.TextIOWrapper(zstandard.ZstdDecompressor().stream_reader(raw), encoding="utf-8")
                yield from text
        else:
            with open(f) as fh:
                yield from fh


def io_per_phase(eventlog_dir: str, app_id: str) -> dict:
    """{phase: {"read": MB read by tasks, "shuffle_write": MB}} from the
    event log; empty if the log cannot be read. Jobs run on other threads
    (broadcast builds) carry no phase name, so "read" is a lower bound."""
    try:
        stage_job, job_desc, acc = {}, {}, {}
        for line in _event_lines(eventlog_dir, app_id):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                desc = (ev.get("Properties") or {}).get("spark.job.description")
                job_desc[ev["Job ID"]] = desc
                for sid in ev.get("Stage IDs", []):
                    stage_job[sid] = ev["Job ID"]
            elif kind == "SparkListenerTaskEnd":
                desc = job_desc.get(stage_job.get(ev.get("Stage ID")))
                m = ev.get("Task Metrics") or {}
                if not desc or not m:
                    continue
                a = acc.setdefault(desc, [0, 0])
                a[0] += (m.get("Input Metrics") or {}).get("Bytes Read", 0)
                a[1] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
        return {k: {"read": round(r / 2**20, 2), "shuffle_write": round(w / 2**20, 2)}
                for k, (r, w) in acc.items() if not k.endswith("_warm")}
    except Exception:
        return {}


if __name__ == "__main__":
    main()
