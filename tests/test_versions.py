"""Loads commit as a whole: what dies in between shows nowhere, and may be done again."""

import os
from dataclasses import replace
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from tillmart.operators import runlog, summary, views
from tillmart.plans import jobs
from tillmart.sources import versions
from tillmart.sources.versions import Version

from tests import golden

AT = datetime(2025, 1, 1, tzinfo=timezone.utc)
LATER = datetime(2025, 1, 2, tzinfo=timezone.utc)
TABLES = "dim_customers dim_products fact_sales fact_rejects daily_sums sales_summary_daily key_highs".split()
STEPS = ["load_dims", "load_facts", "load_sums", "load_summary", "load_checks"]


def state(mart, without=("sale_key",)):
    """All rows of all tables. Keys of facts are unique, but not the same twice."""
    found = {}
    for name in TABLES:
        frame = getattr(mart, name)
        frame = frame.select(sorted(c for c in frame.columns if c not in without))
        found[name] = sorted(map(str, frame.collect()))
    return found


def changed(source):
    """New names and prices, and sales of which some have no customer."""
    unknown = F.when(F.col("sale_id") % 5 == 0, 99).otherwise(F.col("customer_id"))
    return replace(
        source,
        products=source.products.withColumn("unit_price", (F.col("unit_price") + 1).cast("decimal(10,2)")),
        sales=source.sales.withColumn("customer_id", unknown.cast("bigint")).where("sale_id % 7 <> 0"),
    )


class Killed(Exception):
    pass


def test_a_killed_load_changes_nothing_and_can_be_repeated(spark, tmp_path, monkeypatch):
    source, more = golden.source(spark), changed(golden.source(spark))
    root, plain = str(tmp_path / "killed"), str(tmp_path / "plain")
    for folder in (root, plain):
        jobs.run_range(spark, source, folder, "2025-11-29", golden.TODAY, AT)
    before = state(jobs.Mart(spark, root))
    for step in STEPS:
        with monkeypatch.context() as patched:
            done = getattr(jobs, step)

            def dies(*args, **kwargs):
                done(*args, **kwargs)
                raise Killed(step)

            patched.setattr(jobs, step, dies)
            with pytest.raises(Killed):
                jobs.run_range(spark, more, root, "2025-12-01", golden.TODAY, LATER)
        assert state(jobs.Mart(spark, root)) == before, step
    for folder in (root, plain):
        jobs.run_range(spark, more, folder, "2025-12-01", golden.TODAY, LATER)
    wanted = state(jobs.Mart(spark, plain))
    assert state(jobs.Mart(spark, root)) == wanted != before
    assert len(wanted["fact_rejects"]) > 0
    # The same once more, with the same stamp: rejects are replaced with their dates.
    jobs.run_range(spark, more, root, "2025-12-01", golden.TODAY, LATER)
    assert state(jobs.Mart(spark, root)) == wanted
    mart = jobs.Mart(spark, root)
    keys = [r[0] for r in mart.fact_sales.select("sale_key").collect()]
    assert len(keys) == len(set(keys))
    # Folders of the dead loads are gone.
    live = {f"load={load}" for n in versions.numbers(spark, root) for load in versions.read(spark, root, n).parts("fact_sales")}
    assert {n for n in os.listdir(f"{root}/sales") if n.startswith("load=")} <= live
    assert {r["status"] for r in mart.etl_log.collect()} == {"SUCCESS", "FAILED"}


def test_kept_sums_serve_the_views_without_the_facts(spark, root):
    source = golden.source(spark)
    jobs.run_range(spark, source, root, "2025-11-29", golden.TODAY, AT)
    jobs.run_daily(spark, changed(source), root, "2025-12-01", LATER)
    mart = jobs.Mart(spark, root).pinned()
    fact, sums = mart.fact_sales, mart.daily_sums
    for of_sums, of_facts in (
        (summary.summary_of_sums(sums, mart.dim_products), summary.daily_summary(fact, mart.dim_products)),
        (summary.top_product_of_sums(sums, mart.dim_products), summary.top_product_per_day(fact, mart.dim_products)),
        (views.top_products_of_sums(sums, mart.dim_products), views.top_products(fact, mart.dim_products)),
        (views.customer_value_of_sums(sums, mart.dim_customers), views.customer_value(fact, mart.dim_customers)),
    ):
        assert of_sums.columns == of_facts.columns
        assert sorted(of_sums.collect(), key=str) == sorted(of_facts.collect(), key=str)
        assert all(f"{root}/sales/" not in path for path in of_sums.inputFiles())
        assert any(f"{root}/sales/" in path for path in of_facts.inputFiles())
    day = mart.sums_between("2025-12-01", "2025-12-01")
    assert {str(r["sale_date"]) for r in day.collect()} == {"2025-12-01"}
    assert {r["sale_date"] for r in mart.facts_between("2025-12-01", "2025-12-02").collect()} == {
        r["sale_date"] for r in fact.where("sale_date between '2025-12-01' and '2025-12-02'").collect()
    }


def files(root, table):
    return {
        os.path.join(d, f) for d, _, names in os.walk(f"{root}/{table}") for f in names if f.endswith(".parquet")
    }


def test_only_changed_buckets_of_a_dimension_are_written(spark, root):
    source = golden.source(spark)
    jobs.run_daily(spark, source, root, "2025-12-01", AT)
    first = files(root, "dim_customers")
    jobs.run_daily(spark, source, root, golden.TODAY, LATER)
    assert files(root, "dim_customers") == first
    moved = source.customers.withColumn(
        "city", F.when(F.col("customer_id") == 3, "Elsewhere").otherwise(F.col("city"))
    ).where("customer_id <> 5")
    jobs.run_daily(spark, replace(source, customers=moved), root, golden.TODAY, LATER)
    mart = jobs.Mart(spark, root)
    rows = {r["customer_id"]: r for r in mart.dim_customers.collect()}
    assert {i: r["customer_key"] for i, r in rows.items()} == {1: 1, 2: 2, 3: 3, 4: 4}
    assert rows[3]["city"] == "Elsewhere" and rows[3]["updated_at"] > rows[3]["loaded_at"]
    assert rows[1]["updated_at"] == rows[1]["loaded_at"]
    parts = mart.state.parts("dim_customers")
    assert len(parts) == 2 and len(min(parts.values(), key=len)) <= 2
    # A key that left is not given again.
    back = source.customers.withColumn("customer_id", F.when(F.col("customer_id") == 5, 50).otherwise(F.col("customer_id")))
    jobs.run_daily(spark, replace(source, customers=back), root, golden.TODAY, LATER)
    assert {r["customer_id"]: r["customer_key"] for r in mart.dim_customers.collect()}[50] == 6


def test_readers_keep_their_version(spark, root):
    source = golden.source(spark)
    jobs.run_daily(spark, source, root, golden.TODAY, AT)
    pinned, newest = jobs.Mart(spark, root).pinned(), jobs.Mart(spark, root)
    jobs.run_daily(spark, changed(source), root, golden.TODAY, LATER)
    assert pinned.fact_sales.count() == 10 and pinned.fact_rejects.isEmpty()
    assert newest.fact_sales.count() < 10


def test_the_second_of_two_writers_fails(spark, root):
    one, two = jobs.Load(spark, root), jobs.Load(spark, root)
    one.commit()
    with pytest.raises(versions.LoadConflict):
        two.commit()
    assert versions.numbers(spark, root) == [1]


def test_a_load_wants_checked_sums(spark, root):
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        with pytest.raises(RuntimeError, match="ansi"):
            jobs.Load(spark, root)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_parts_replace_parts():
    start = Version().replacing("t", "one", ["a", "b", "c"], [])
    assert start.is_whole("t", "one")
    then = start.replacing("t", "two", ["b"], ["b", "c"])
    assert then.parts("t") == {"one": ["a"], "two": ["b"]} and not then.is_whole("t", "one")
    assert then.replacing("t", "three", [], ["a"]).parts("t") == {"two": ["b"]}
    assert start.parts("t") == {"one": ["a", "b", "c"]} and then.emptied("t").parts("t") == {}


def test_staging_is_one_commit(spark, root, monkeypatch):
    source = golden.source(spark)
    jobs.run_stage_dims(spark, source, root, AT)
    with monkeypatch.context() as patched:
        patched.setattr(versions, "commit", lambda *a: (_ for _ in ()).throw(Killed()))
        for run in (lambda: jobs.run_stage_dims(spark, source, root, AT), lambda: jobs.run_staging(spark, source, root, "Test", 1)):
            with pytest.raises(Killed):
                run()
    mart = jobs.Mart(spark, root)
    assert (mart.stage_customers.count(), mart.stage_products.count(), mart.stage_sales.count()) == (5, 10, 0)
    jobs.run_staging(spark, source, root, "Test", 1)
    jobs.run_stage_dims(spark, source, root, AT)
    assert sorted(r[0] for r in mart.stage_products.select("stage_id").collect()) == list(range(1, 21))
    assert mart.stage_sales.count() == 70


def test_the_run_log_is_compacted(spark, root, monkeypatch):
    """However many updates, a few files; the answers are those of the whole history."""
    monkeypatch.setattr(runlog, "COMPACT_AT", 4)
    path, wanted = f"{root}/log", {}
    assert runlog.read_log(spark, path).count() == 0
    for i in range(7):
        at = datetime(2025, 1, 1, i, tzinfo=timezone.utc)
        log_id = runlog.start_run(spark, path, "job", "task", "2025-01-01", at, rows_loaded=i)
        wanted[log_id] = ("STARTED", i)
        if i % 2:
            runlog.update_run(spark, path, log_id, "FAILED", at, error_message="broke")
            runlog.complete_run(spark, path, log_id, 100 + i, 200 + i, at)
            wanted[log_id] = ("SUCCESS", 100 + i)
    rows = runlog.read_log(spark, path).collect()
    assert {r["log_id"]: (r["status"], r["rows_loaded"]) for r in rows} == wanted
    assert len([f for f in os.listdir(f"{path}/entries") if f.startswith("part-")]) <= 2 * 4
    assert len(os.listdir(f"{path}/snapshot")) <= versions.KEPT + 1
    first = min(wanted)
    runlog.update_run(spark, path, first, "FAILED", LATER)
    assert {r["log_id"]: r["status"] for r in runlog.read_log(spark, path).collect()}[first] == "FAILED"


def executions(spark, rows):
    kinds = "execution_id long, operation_id long, folder_name string, project_name string, package_name string, status int, start_time timestamp_ntz, end_time timestamp_ntz"
    return spark.createDataFrame(rows, kinds)


def test_logs_are_read_by_increment_and_dropped_by_day(spark, root):
    rows = [
        (i, i % 4, f"f{i % 2}", "p", f"k{i % 3}", 7, None if i == 40 else datetime(2025, 1, 1 + i // 6, i % 24), None)
        for i in range(61)
    ]
    source = executions(spark, rows)
    assert jobs.run_log_increment(spark, source.where("execution_id <= 20"), root) == 21
    assert jobs.run_log_increment(spark, source.where("execution_id <= 41"), root) == 21
    assert jobs.run_log_increment(spark, source, root) == 19
    assert jobs.run_log_increment(spark, source, root) == 0
    mart = jobs.Mart(spark, root)
    assert sorted(r["execution_id"] for r in mart.executions_between(None, None).collect()) == list(range(61))
    for day in range(1, 12):
        mine = [r for r in rows if r[6] and r[6].day == day]
        newest = {(r[2], r[4]): r[0] for r in mine}
        got = mart.latest_executions(f"2025-01-{day:02}").collect()
        assert {(r["folder_name"], r["package_name"]): r["execution_id"] for r in got} == newest
    as_of = "2025-01-06 10:00:00"
    old = {r[0] for r in rows if r[6] and r[6] < datetime(2025, 1, 5, 10)}
    assert jobs.run_log_retention(spark, root, as_of, 1) == len(old)
    assert mart.executions_between(None, None).count() == 61
    assert jobs.run_log_retention(spark, root, as_of, 1, dry_run=False) == len(old)
    left = {r["execution_id"] for r in mart.executions_between(None, None).collect()}
    assert left == set(range(61)) - old and len(left) + len(old) == 61
    assert jobs.run_log_retention(spark, root, as_of, 1, dry_run=False) == 0
    # The folders of whole days go with the last version that names them.
    assert jobs.run_log_increment(spark, source.where("1 = 0"), root) == 0
    for i in (61, 62):
        jobs.run_log_increment(spark, executions(spark, [(i, 1, "f", "p", "k", 7, datetime(2025, 1, 20), None)]), root)
    days = {n for load in os.listdir(f"{root}/executions") if load.startswith("load=") for n in os.listdir(f"{root}/executions/{load}")}
    assert not {f"log_date=2025-01-0{d}" for d in range(1, 5)} & days
