"""Command line: the daily batch, continuous ingestion, SQL over the layers.

  python -m tillroll batch  --source 'in/*.csv' --warehouse wh [--incremental-staging]
                            [--null-safe-sync] [--keep-null-description]
  python -m tillroll ingest --source in/ --warehouse wh [--continuous]
  python -m tillroll sql    --warehouse wh "SELECT ... FROM analytics.fact_sales ..."

On a cluster, submit with spark-submit; master, resources and
spark.checkpoint.dir come from the submit configuration.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession


def _session() -> SparkSession:
    from tillroll.session import RECOMMENDED_CONF, ensure_checkpoint_dir
    b = SparkSession.builder.appName("tillroll")
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def main(argv=None) -> None:
    ap = argparse.ArgumentParser(prog="tillroll")
    sub = ap.add_subparsers(dest="cmd", required=True)
    b = sub.add_parser("batch", help="sync new lines, restage, rebuild the star, publish")
    b.add_argument("--source", required=True, help="CSV file, folder or glob")
    b.add_argument("--warehouse", required=True)
    b.add_argument("--incremental-staging", action="store_true",
                   help="stage the raw batches that staging lacks instead of rebuilding it")
    b.add_argument("--null-safe-sync", action="store_true",
                   help="NULL sync keys match each other (not re-inserted every run)")
    b.add_argument("--keep-null-description", action="store_true",
                   help="keep lines without a description in staging")
    i = sub.add_parser("ingest", help="stream new source files into raw")
    i.add_argument("--source", required=True)
    i.add_argument("--warehouse", required=True)
    i.add_argument("--stage", action="store_true", help="stage every epoch's lines as well")
    i.add_argument("--kpis", action="store_true", help="and bring the daily KPIs up to staging, day by day")
    i.add_argument("--continuous", action="store_true", help="keep polling instead of availableNow")
    q = sub.add_parser("sql", help="run SQL over raw / staging / analytics tables")
    q.add_argument("--warehouse", required=True)
    q.add_argument("statement")
    q.add_argument("--rows", type=int, default=50, help="rows to print")
    for p in (b, i, q):
        p.add_argument("--input-tb", type=float, default=None,
                       help="size the shuffle / scan settings for this much input (cluster runs)")
        p.add_argument("--executors", type=int, default=1000)
        p.add_argument("--executor-cores", type=int, default=4)
        p.add_argument("--executor-memory-gb", type=float, default=16.0)
    a = ap.parse_args(argv)

    spark = _session()
    if a.input_tb:
        from tillroll.session import cluster_conf
        for k, v in cluster_conf(int(a.input_tb * 1024 ** 4), a.executor_memory_gb,
                                 a.executor_cores, a.executors).items():
            spark.conf.set(k, v)
    if a.cmd == "batch":
        from tillroll.plans.pipeline import run_batch
        from tillroll.sources.csv import read_retail_csv
        out = run_batch(spark, read_retail_csv(spark, a.source), a.warehouse,
                        incremental_staging=a.incremental_staging,
                        null_safe_sync=a.null_safe_sync,
                        keep_null_description=a.keep_null_description)
        print(json.dumps(out, default=str, indent=2))
    elif a.cmd == "ingest":
        from tillroll.streaming.ingest import start_ingest
        start_ingest(spark, a.source, a.warehouse, available_now=not a.continuous,
                     stage=a.stage, kpis=a.kpis).awaitTermination()
    else:
        from tillroll.plans.pipeline import Warehouse
        from tillroll.sources.catalog import register_layers
        register_layers(spark, Warehouse(spark, a.warehouse))
        spark.sql(a.statement).show(a.rows, truncate=False)


if __name__ == "__main__":
    main()
