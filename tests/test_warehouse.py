"""The warehouse's logs: broken and repeated runs, concurrent runs, line ids, switches of pointers and views."""
import datetime as dt
import threading
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tillroll.operators import marts
from tillroll.operators.keys import row_numbers, slices
from tillroll.operators.staging import staging_clean
from tillroll.plans import pipeline
from tillroll.plans.pipeline import RAW_TABLE, STAGING_TABLE, Warehouse, run_visuals
from tillroll.schemas import CSV_SCHEMA, RAW_COLUMNS
from tillroll.sources import catalog, publish, storage
from tillroll.sources.csv import write_retail_csv
from tillroll.sources.storage import CommitConflict, CommitLog
from tillroll.streaming.ingest import start_ingest


class Killed(Exception):
    pass


def lines(spark, start, stop):
    """Lines start..stop-1 over some months; every seventh has no quantity, every eleventh no date."""
    rows = []
    for k in range(start, stop):
        when = None if k % 11 == 0 else dt.datetime(2010, 1 + k % 5, 1 + k % 27, k % 24)
        rows.append((f"{1000 + k}", "M" if k % 13 == 0 else f"S{k % 9}", None if k % 17 == 0 else f" item {k % 9}",
                     None if k % 7 == 0 else (-1) ** (k % 4) * (k % 6 + 1), when, Decimal(k % 8) + Decimal("0.25"), k % 3 or None,
                     "France" if k % 2 else "United Kingdom"))
    return spark.createDataFrame(rows, CSV_SCHEMA)


def rows(df, columns=RAW_COLUMNS):
    return Counter(tuple(r) for r in df.select(*columns).collect())


def staged_as_ruled(wh, keep_null_description=False):
    want = staging_clean(wh.raw(), keep_null_description=keep_null_description)
    return rows(wh.staging(), want.columns) == rows(want, want.columns)


def die(*_, **__):
    raise Killed


@pytest.fixture
def wh(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "wh"))


def test_half_written_batch_is_not_there_and_is_replayed(spark, wh, monkeypatch):
    assert wh.sync_raw(lines(spark, 0, 40), batch_id="a") == 40
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", die)
        with pytest.raises(Killed):
            wh.sync_raw(lines(spark, 20, 80), batch_id="b")
    base = wh.path(f"{RAW_TABLE}/load_batch=b")
    left = storage.names(spark, base)
    assert len(left) == 1 and storage.names(spark, f"{base}/{left[0]}")     # files are there, the batch isn't
    assert rows(wh.raw()) == rows(lines(spark, 0, 40))
    again = sum(1 for k in range(20, 40) if k % 7 == 0 or k % 11 == 0)      # a NULL key is new every time
    assert wh.sync_raw(lines(spark, 20, 80), batch_id="b") == 40 + again
    assert len(storage.names(spark, base)) == 1 and storage.names(spark, base) != left
    assert wh.sync_raw(lines(spark, 20, 80), batch_id="b") == 0
    assert wh.raw().where("load_batch = 'b'").count() == 40 + again


def test_no_success_markers(spark, wh):
    conf, key = spark.sparkContext._jsc.hadoopConfiguration(), "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    conf.set(key, "false")
    try:
        assert wh.sync_raw(lines(spark, 0, 50), null_safe=True) == 50
        wh.stage_missing()
        assert wh.sync_raw(lines(spark, 0, 60), null_safe=True) == 10
        wh.stage_missing()
        assert wh.build_star() == 1
    finally:
        conf.unset(key)
    assert wh.raw().count() == 60 and staged_as_ruled(wh)
    assert not any("_SUCCESS" in n for n in storage.names(spark, wh.path(RAW_TABLE)))


def test_empty_first_load(spark, wh):
    assert wh.raw().count() == 0 and wh.staging().count() == 0
    assert wh.sync_raw(lines(spark, 0, 0)) == 0
    assert wh.stage_missing() == 0 and wh.build_star() == 1
    assert wh.raw().count() == 0 and wh.star().fact.count() == 0
    assert wh.sync_raw(lines(spark, 0, 30)) == 30
    assert wh.stage_missing() > 0 and staged_as_ruled(wh)
    assert wh.sync_raw(lines(spark, 0, 0)) == 0 and wh.stage_missing() == 0


def test_staging_follows_raw_whatever_the_route(spark, wh, monkeypatch):
    wh.sync_raw(lines(spark, 0, 40), batch_id="a")
    wh.stage_missing()
    wh.sync_raw(lines(spark, 40, 70), batch_id="stream-epoch-0")     # came by ingest, never staged
    with monkeypatch.context() as m:                                 # and a run that died before it staged
        m.setattr(Warehouse, "_stage", die)
        wh.sync_raw(lines(spark, 70, 90), batch_id="c")
        with pytest.raises(Killed):
            wh.stage_missing()
    assert not staged_as_ruled(wh)
    wh.sync_raw(lines(spark, 90, 100), batch_id="d")
    assert wh.stage_batch("d") > 0 and wh.stage_batch("d") == 0
    assert wh.stage_batch("never-loaded") == 0
    assert wh.stage_missing() > 0
    assert staged_as_ruled(wh)
    assert wh.stage_missing() == 0
    assert sorted(b for e in wh.staged() for b in e["batches"]) == ["a", "c", "d", "stream-epoch-0"]


def test_step_that_died_before_its_entry_is_staged_anew(spark, wh, monkeypatch):
    wh.sync_raw(lines(spark, 0, 40))
    wh.stage_missing()
    wh.sync_raw(lines(spark, 40, 70))
    before = rows(wh.staging(), ["invoice"])
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", die)
        with pytest.raises(Killed):
            wh.stage_missing()
    assert rows(wh.staging(), ["invoice"]) == before
    wh.stage_missing()
    assert staged_as_ruled(wh)


def test_change_of_rule_restages_everything(spark, wh):
    wh.sync_raw(lines(spark, 0, 60))
    wh.stage_missing()
    wh.sync_raw(lines(spark, 60, 90))
    assert wh.stage_missing(keep_null_description=True) == wh.staging().count()
    assert staged_as_ruled(wh, keep_null_description=True) and not staged_as_ruled(wh)


def test_rebuild_killed_midway_leaves_the_old_staging(spark, wh, monkeypatch):
    wh.sync_raw(lines(spark, 0, 60))
    wh.rebuild_staging()
    reader = wh.staging()
    before = rows(reader, reader.columns)
    wh.sync_raw(lines(spark, 60, 90))
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", die)
        with pytest.raises(Killed):
            wh.rebuild_staging()
    assert rows(wh.staging(), reader.columns) == before
    wh.rebuild_staging()
    assert staged_as_ruled(wh)
    assert rows(reader, reader.columns) == before          # a reader that began before still finds its files
    wh.rebuild_staging()
    wh.rebuild_staging()
    assert len([n for n in storage.names(spark, wh.path(STAGING_TABLE)) if n.startswith("generation=")]) <= 3


def test_line_ids_are_unique_and_repeatable(spark, wh):
    for k, (a, b) in enumerate([(0, 50), (30, 90), (90, 120)]):
        wh.sync_raw(lines(spark, a, b).repartition(3), batch_id=f"b{k}")
    ids = [r["id"] for r in wh.raw().select("id").collect()]
    assert len(ids) == len(set(ids)) and min(ids) == 1
    commits = wh.raw_commits()
    assert [(c["first_id"], c["next_id"]) for c in commits] == [(1, 51), (51, 111), (111, 141)]


def test_sync_from_files_that_stay(spark, wh, tmp_path, monkeypatch):
    """Batches picked from Parquet files are read there, not copied, and give the rows that copies of them give."""
    path = str(tmp_path / "lines")
    lines(spark, 0, 400).repartition(4).write.parquet(path)
    lasting = spark.read.schema(CSV_SCHEMA).parquet(path)
    picks = [F.col("country") == "France", F.col("quantity") > 0, F.lit(True)]
    other = Warehouse(spark, str(tmp_path / "other"))
    for k, pick in enumerate(picks):
        other.sync_raw(lasting.where(pick), null_safe=True, batch_id=f"b{k}")

    def no_copy(*_):
        raise AssertionError("a landing")

    with monkeypatch.context() as m:
        m.setattr(pipeline, "scratch_root", no_copy)
        for k, pick in enumerate(picks):
            wh.sync_raw(lasting.where(pick), null_safe=True, batch_id=f"b{k}", landed=True)
    assert rows(wh.raw(), ["load_batch", *RAW_COLUMNS]) == rows(other.raw(), ["load_batch", *RAW_COLUMNS])
    ids = [r["id"] for r in wh.raw().select("id").collect()]
    assert len(ids) == len(set(ids)) == 400 and min(ids) >= 1 and max(ids) < wh.raw_commits()[-1]["next_id"]


def test_months_that_raw_has_not_are_not_compared(spark, wh, monkeypatch):
    wh.sync_raw(lines(spark, 0, 60).where("month(invoicedate) <= 2"), batch_id="old")

    def compared(*_, **__):
        raise Killed

    monkeypatch.setattr(pipeline.sync, "new_rows", compared)
    later = lines(spark, 0, 60).where("month(invoicedate) > 2")
    assert wh.sync_raw(later, batch_id="new") == later.count()
    with pytest.raises(Killed):
        wh.sync_raw(lines(spark, 0, 60), batch_id="both")


def test_slices_of_days(spark):
    counts = {None: 3, "2010-01-01": 1, "2010-01-02": 1000, "2010-01-03": 5, "2010-02-01": 5, "2010-02-02": 486}
    days = spark.createDataFrame(list(counts.items()), "d string, n long").withColumn("d", F.to_date("d"))
    got = slices(days, "d", 15).orderBy("d").collect()
    assert [(r["_first"], r["_slices"]) for r in got] == [(0, 1), (0, 1), (0, 11), (10, 1), (10, 1), (10, 5)]


def test_line_ids_follow_from_the_landed_files(spark, tmp_path):
    """A stage that runs again, over other splits and in another order of tasks, numbers every line as before."""
    path = str(tmp_path / "landed")
    lines(spark, 0, 500).repartition(5).write.parquet(path)
    keep = "spark.sql.files.maxPartitionBytes"
    before, seen = spark.conf.get(keep), []
    try:
        for size in ("128m", "1k", "9k"):
            spark.conf.set(keep, size)
            seen.append({r["invoice"]: r["id"] for r in
                         row_numbers(spark.read.schema(CSV_SCHEMA).parquet(path), "id", 7).repartition(4).collect()})
    finally:
        spark.conf.set(keep, before)
    assert seen[0] == seen[1] == seen[2] and sorted(seen[0].values()) == list(range(7, 507))


def test_two_syncs_at_once_lose_and_double_nothing(spark, wh, monkeypatch):
    other = Warehouse(spark, wh.root)
    write, calls = Warehouse._write_batch, []

    def interrupted(self, *args):
        entry = write(self, *args)
        if self is wh and not calls:
            calls.append(1)
            assert other.sync_raw(lines(spark, 0, 60), null_safe=True, batch_id="other") == 60
        return entry

    monkeypatch.setattr(Warehouse, "_write_batch", interrupted)
    assert wh.sync_raw(lines(spark, 40, 100), null_safe=True, batch_id="mine") == 40
    assert rows(wh.raw()) == rows(lines(spark, 0, 100))
    assert len({r["id"] for r in wh.raw().select("id").collect()}) == 100


def test_two_star_builds_at_once(spark, wh, monkeypatch):
    wh.sync_raw(lines(spark, 0, 60))
    wh.rebuild_staging()
    write, calls = Warehouse._write_star, []

    def interrupted(self, base):
        write(self, base)
        if not calls:
            calls.append(1)
            assert Warehouse(spark, wh.root).build_star() == 1

    monkeypatch.setattr(Warehouse, "_write_star", interrupted)
    with pytest.raises(CommitConflict):
        wh.build_star()
    assert wh.latest_version() == 1
    assert len([n for n in storage.names(spark, wh.path("analytics")) if n.startswith("build=")]) == 1


@pytest.fixture
def starred(spark, wh):
    wh.sync_raw(lines(spark, 0, 60))
    wh.rebuild_staging()
    wh.build_star()
    return wh


def test_publication_killed_midway_leaves_the_old_feeds(spark, starred, monkeypatch):
    root = starred.path("outputs/figures")
    assert run_visuals(starred, starred.star(), root)["published"]
    before = {n: rows(publish.latest(spark, root, n), publish.latest(spark, root, n).columns) for n in publish.FIGURE_FEEDS}
    starred.sync_raw(lines(spark, 60, 100))
    starred.rebuild_staging()
    starred.build_star()
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", die)
        with pytest.raises(Killed):
            run_visuals(starred, starred.star(), root)
    for n, want in before.items():
        now = publish.latest(spark, root, n)
        assert rows(now, now.columns) == want
    out = run_visuals(starred, starred.star(), root)
    assert out["published"] and out["next_version"] == 2
    now = publish.latest(spark, root, "daily_revenue_over_time")
    assert rows(now, now.columns) != before["daily_revenue_over_time"]
    assert run_visuals(starred, starred.star(), root)["changed"] is False


def test_two_runs_cannot_publish_one_version(spark, starred, monkeypatch):
    root = starred.path("outputs/figures")
    first = publish.published_state(spark, root)                 # both runs decide on this state
    monkeypatch.setattr(pipeline.publish, "published_state", lambda *_: first)
    results = [run_visuals(starred, starred.star(), root) for _ in range(2)]
    assert [r["published"] for r in results] == [True, False] and results[1]["conflict"]
    assert CommitLog(spark, root).version() == 1
    for name in publish.FIGURE_FEEDS:
        assert len(storage.names(spark, f"{root}/versioned/{name}")) == 1


def test_create_new_has_one_winner(spark, tmp_path):
    for name, make in (("a", storage.create_new), ("b", storage._rename_new)):
        path = f"file:{tmp_path}/log/{name}.json"
        if name == "a":
            won = []
            threads = [threading.Thread(target=lambda k=k: won.append(make(spark, path, f"{k}"))) for k in range(8)]
            [t.start() for t in threads]
            [t.join() for t in threads]
            assert sorted(won) == [False] * 7 + [True]
        else:
            assert make(spark, path, "first") and not make(spark, path, "second")
            assert (tmp_path / "log" / "b.json").read_text() == "first"
    assert storage.names(spark, f"{tmp_path}/log") and storage.names(spark, f"{tmp_path}/nowhere") == []


def test_unreadable_entry_is_an_error(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "t"))
    assert log.commit({"a": 1}, after=0) == 1
    with pytest.raises(CommitConflict):
        log.commit({"a": 2}, after=0)
    (tmp_path / "t" / "_log" / "00000000000000000002.json").write_text('{"a": ')
    with pytest.raises(ValueError):
        log.entries()


def test_batch_ids_that_are_no_folder_names(spark, wh):
    for bad in ("a/b", "", " ", "../x", "a=b"):
        if bad:
            with pytest.raises(ValueError):
                wh.sync_raw(lines(spark, 0, 1), batch_id=bad)
    assert wh.sync_raw(lines(spark, 0, 5), batch_id="2010") == 5
    assert [r["load_batch"] for r in wh.raw().select("load_batch").distinct().collect()] == ["2010"]


def test_views_switch_without_a_gap(spark, starred, tmp_path):
    catalog.register_layers(spark, starred)
    stop, failed, seen = threading.Event(), [], set()

    def read():
        while not stop.is_set():
            try:
                seen.add(spark.sql("SELECT COUNT(*) FROM raw.online_retail").first()[0])
                spark.sql("SELECT COUNT(*) FROM analytics.fact_sales").first()
            except Exception as e:  # noqa: BLE001 - any failure of a reader is the finding
                failed.append(e)
                return

    reader = threading.Thread(target=read)
    reader.start()
    try:
        for k in range(3):
            starred.sync_raw(lines(spark, 60 + 10 * k, 70 + 10 * k), null_safe=True)
            starred.stage_missing()
            starred.build_star()
            catalog.register_layers(spark, starred)
    finally:
        stop.set()
        reader.join()
    assert not failed, failed
    assert seen <= {60, 70, 80, 90}
    assert spark.sql("SELECT COUNT(*) FROM raw.online_retail").first()[0] == 90
    assert spark.sql("SELECT * FROM staging.online_retail_clean").count() == starred.staging().count()
    tables = [t.name for t in spark.catalog.listTables("raw") if t.name.startswith("online_retail__")]
    assert len(tables) == 2
    # another warehouse takes all names over
    other = Warehouse(spark, str(tmp_path / "other"))
    other.sync_raw(lines(spark, 500, 507), batch_id="7")
    other.stage_missing()
    other.build_star()
    catalog.register_layers(spark, other)
    assert {r[0] for r in spark.sql("SELECT load_batch FROM raw.online_retail").collect()} == {"7"}
    assert spark.sql("SELECT * FROM staging.online_retail_clean").count() == other.staging().count()
    assert spark.sql("SELECT * FROM analytics.fact_sales").count() == other.star().fact.count()


def test_uncommitted_files_do_not_show_in_sql(spark, wh, monkeypatch):
    wh.sync_raw(lines(spark, 0, 40), batch_id="a")
    with monkeypatch.context() as m:
        m.setattr(CommitLog, "commit", die)
        with pytest.raises(Killed):
            wh.sync_raw(lines(spark, 40, 80), batch_id="b")
    catalog.register_layers(spark, wh)
    assert spark.sql("SELECT COUNT(*) FROM raw.online_retail").first()[0] == 40
    assert spark.sql("SELECT COUNT(*) FROM staging.online_retail_clean").first()[0] == 0


def test_stream_epochs_are_staged_and_replayed_once(spark, wh, tmp_path, monkeypatch):
    src, ingest = tmp_path / "in", dict(stage=True, max_files_per_trigger=1)
    write_retail_csv(lines(spark, 0, 40).coalesce(1), str(src / "f0"))
    start_ingest(spark, str(src / "*"), wh.root, **ingest).awaitTermination(120)
    assert staged_as_ruled(wh) and wh.raw().count() == 40
    write_retail_csv(lines(spark, 40, 70).coalesce(1), str(src / "f1"))
    with monkeypatch.context() as m:                    # the epoch reaches raw and dies before it is staged
        m.setattr(Warehouse, "stage_missing", die)
        with pytest.raises(Exception):
            start_ingest(spark, str(src / "*"), wh.root, **ingest).awaitTermination(120)
    assert wh.raw().count() == 70 and not staged_as_ruled(wh)
    write_retail_csv(lines(spark, 70, 100).coalesce(1), str(src / "f2"))
    start_ingest(spark, str(src / "*"), wh.root, **ingest).awaitTermination(120)
    assert rows(wh.raw()) == rows(lines(spark, 0, 100)) and staged_as_ruled(wh)
    full = Warehouse(spark, str(tmp_path / "full"))
    full.sync_raw(lines(spark, 0, 100))
    full.rebuild_staging()
    full.build_star()
    wh.build_star()
    columns = [c for c in full.star().daily.columns]
    assert rows(wh.staging(), ["invoice", "total_price"]) == rows(full.staging(), ["invoice", "total_price"])
    country = F.broadcast(full.star().dim_country)
    assert (rows(wh.star().daily.join(F.broadcast(wh.star().dim_country), "country_id"), columns)
            == rows(full.star().daily.join(country, "country_id"), columns))


def kpis_as_ruled(wh):
    wh.build_star()
    star = wh.star()
    want = marts.daily_kpis(star.fact, star.dim_date, star.dim_country)
    return rows(wh.daily_kpis(), want.columns) == rows(want, want.columns)


def test_stream_epochs_refresh_the_kpis_of_their_days(spark, wh, tmp_path, monkeypatch):
    src, ingest = tmp_path / "in", dict(kpis=True, max_files_per_trigger=1)
    write_retail_csv(lines(spark, 0, 40).coalesce(1), str(src / "f0"))
    start_ingest(spark, str(src / "*"), wh.root, **ingest).awaitTermination(120)
    assert staged_as_ruled(wh) and kpis_as_ruled(wh)
    write_retail_csv(lines(spark, 40, 70).coalesce(1), str(src / "f1"))
    with monkeypatch.context() as m:                    # the epoch is staged and dies before its days are made anew
        m.setattr(marts, "daily_kpis_of_lines", die)
        with pytest.raises(Exception):
            start_ingest(spark, str(src / "*"), wh.root, **ingest).awaitTermination(120)
    assert staged_as_ruled(wh) and not kpis_as_ruled(wh)
    write_retail_csv(lines(spark, 70, 100).coalesce(1), str(src / "f2"))
    start_ingest(spark, str(src / "*"), wh.root, **ingest).awaitTermination(120)
    assert staged_as_ruled(wh) and kpis_as_ruled(wh)
    full = Warehouse(spark, str(tmp_path / "full"))
    full.sync_raw(lines(spark, 0, 100))
    full.rebuild_staging()
    assert full.refresh_daily_kpis() == -1
    columns = full.daily_kpis().columns
    assert rows(wh.daily_kpis(), columns) == rows(full.daily_kpis(), columns)


def test_refresh_makes_only_the_days_with_new_lines(spark, wh, monkeypatch):
    assert wh.refresh_daily_kpis() == 0 and wh.daily_kpis().count() == 0
    wh.sync_raw(lines(spark, 0, 60), batch_id="a")
    wh.stage_missing()
    assert wh.refresh_daily_kpis() == -1 and wh.refresh_daily_kpis() == 0
    more = lines(spark, 60, 90).where("invoicedate < '2010-03-01'")
    wh.sync_raw(more, batch_id="b")
    wh.stage_missing()
    days = {r[0].date() for r in staging_clean(more).select("invoicedate").dropna().collect()}
    assert wh.refresh_daily_kpis() == len(days)
    step = spark.read.parquet(wh.path(f"{pipeline.KPI_TABLE}/{wh.kpi_steps()[-1]['folder']}"))
    assert {r[0] for r in step.select("full_date").collect()} <= days and kpis_as_ruled(wh)
    wh.sync_raw(lines(spark, 0, 0), batch_id="c")       # a batch without lines changes no day
    wh.stage_missing()
    assert wh.refresh_daily_kpis() == 0 and kpis_as_ruled(wh)
    wh.rebuild_staging(keep_null_description=True)      # another rule: all days anew
    assert wh.refresh_daily_kpis() == -1 and len(wh.kpi_steps()) == 1 and kpis_as_ruled(wh)
    monkeypatch.setattr(pipeline, "KPI_STEPS", 1)
    wh.sync_raw(lines(spark, 90, 120), batch_id="d")
    wh.stage_missing(keep_null_description=True)
    assert wh.refresh_daily_kpis() == -1 and kpis_as_ruled(wh)
    left = [n for n in storage.names(spark, wh.path(pipeline.KPI_TABLE)) if n.startswith("step=")]
    assert len(left) == 2                               # the last step, and the one that readers may be in


def test_two_refreshes_at_once(spark, wh, monkeypatch):
    wh.sync_raw(lines(spark, 0, 30), batch_id="a")
    wh.stage_missing()
    made = marts.daily_kpis_of_lines

    def other_first(staging):
        monkeypatch.setattr(marts, "daily_kpis_of_lines", made)
        wh.refresh_daily_kpis()
        return made(staging)

    monkeypatch.setattr(marts, "daily_kpis_of_lines", other_first)
    with pytest.raises(CommitConflict):
        wh.refresh_daily_kpis()
    assert kpis_as_ruled(wh) and wh.refresh_daily_kpis() == 0


def test_raw_reads_only_the_months_and_batches_asked_for(spark, wh):
    wh.sync_raw(lines(spark, 0, 40), batch_id="a")
    wh.sync_raw(lines(spark, 40, 50), batch_id="b")
    files = wh._raw_of(wh.raw_commits(), [201001]).inputFiles()
    assert files and all("invoice_month=201001/" in f for f in wh._raw_of(wh.raw_commits(), [201001])
                         .where("invoice_month = 201001").select(F.input_file_name()).distinct().toPandas().iloc[:, 0])
    assert wh._raw_of(wh.raw_commits(), [199901]).count() == 0
