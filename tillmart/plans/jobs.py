"""Whole jobs: mart load of a day or a range, staging load, audit after a load."""

from __future__ import annotations

import logging
from collections.abc import Collection
from dataclasses import dataclass
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tillmart import schemas
from tillmart.functions.money import row_count
from tillmart.operators import dims, facts, joblog, quality, runlog, staging, summary
from tillmart.session import require_checked_sums, scratch_dir
from tillmart.sources import adapters, extracts, tables, versions
from tillmart.sources.versions import Version

log = logging.getLogger("tillmart")

# Names under which a load appears in the run log.
JOB_NAME, TASK_NAME = "sales_mart", "load"

# Buckets of a dimension's first load; later loads keep the number they find.
DIM_BUCKETS = 16


@dataclass(frozen=True)
class Source:
    """The three source relations; lazy frames from files or JDBC."""

    customers: DataFrame
    products: DataFrame
    sales: DataFrame

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Source:
        return cls(
            adapters.customers(spark, folder),
            adapters.products(spark, folder),
            adapters.sales(spark, folder),
        )


@dataclass(frozen=True)
class Mart:
    """A stored mart below one folder: as its newest version has it, or a given one."""

    spark: SparkSession
    root: str
    version: Version | None = None

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @property
    def state(self) -> Version:
        return versions.read(self.spark, self.root) if self.version is None else self.version

    def pinned(self) -> Mart:
        """The mart as it is now; loads that commit later do not show."""
        return Mart(self.spark, self.root, self.state)

    def _read(self, name: str, schema, low=None, high=None) -> DataFrame:
        return tables.read_table(self.spark, self.root, name, self.state, schema, low, high)

    @property
    def dim_customers(self) -> DataFrame:
        return self._read("dim_customers", schemas.DIM_CUSTOMERS)

    @property
    def dim_products(self) -> DataFrame:
        return self._read("dim_products", schemas.DIM_PRODUCTS)

    @property
    def fact_sales(self) -> DataFrame:
        return self._read("fact_sales", schemas.FACT_SALES)

    def facts_between(self, start: date | str, end: date | str) -> DataFrame:
        """The facts of a range of dates, from their own folders."""
        return self._read("fact_sales", schemas.FACT_SALES, start, end)

    @property
    def fact_rejects(self) -> DataFrame:
        rows = tables.read_by_row(
            self.spark,
            self.root,
            "fact_rejects",
            self.state,
            schemas.STORED_REJECTS,
            inner=f"sale_date={tables.NO_DATE}",
            column="reject_date",
        )
        return rows.withColumnRenamed("reject_date", "sale_date")

    @property
    def daily_sums(self) -> DataFrame:
        return self.sums_between(None, None)

    def sums_between(self, start: date | str | None, end: date | str | None) -> DataFrame:
        return tables.read_by_row(
            self.spark, self.root, "daily_sums", self.state, schemas.DAILY_SUMS, start, end
        )

    @property
    def sales_summary_daily(self) -> DataFrame:
        return self._read("sales_summary_daily", schemas.SALES_SUMMARY_DAILY)

    @property
    def key_highs(self) -> DataFrame:
        return self._read("key_highs", schemas.KEY_HIGHS)

    @property
    def stage_sales(self) -> DataFrame:
        return self._read("stage_sales", schemas.STAGE_SALES)

    @property
    def stage_customers(self) -> DataFrame:
        return self._read("stage_customers", schemas.STAGE_CUSTOMERS)

    @property
    def stage_products(self) -> DataFrame:
        return self._read("stage_products", schemas.STAGE_PRODUCTS)

    def executions_between(self, start: date | str | None, end: date | str | None) -> DataFrame:
        """Stored executions that began on a range of days, or all of them."""
        return self._read("executions", schemas.EXECUTIONS, start, end)

    def latest_executions(self, day: date | str) -> DataFrame:
        """The newest execution of each package on a day, from the rows kept for it."""
        return joblog.latest_execution(self._read("latest_executions", schemas.EXECUTIONS, day, day), day)

    @property
    def etl_log(self) -> DataFrame:
        return runlog.read_log(self.spark, self.path("etl_log"))


class Load:
    """A load on top of the newest version: it writes aside, and readers see it once it commits.

    A load that is never committed changes nothing; doing it again, with the same stamp too, ends in
    the state of one load.
    """

    def __init__(self, spark: SparkSession, root: str):
        require_checked_sums(spark)
        self.spark, self.root = spark, root
        self.version = versions.read(spark, root)
        self.name = versions.new_load(self.version)

    @property
    def mart(self) -> Mart:
        """The mart as this load leaves it so far."""
        return Mart(self.spark, self.root, self.version)

    def whole(self, table: str, df: DataFrame, schema) -> None:
        """Replace a small table."""
        tables.write_load(schemas.enforce(df, schema), self.root, table, self.name)
        self.version = self.version.replacing(table, self.name, [versions.WHOLE], [versions.WHOLE])

    def more(self, table: str, df: DataFrame, schema) -> None:
        """Add rows to a table that only grows."""
        tables.write_load(schemas.conform(df, schema), self.root, table, self.name)
        self.version = self.version.replacing(table, self.name, [self.name], [])

    def divided(self, table: str, df: DataFrame, column: str, instead: Collection[str]) -> None:
        """Replace parts of a table: those in ``instead`` by those that are written."""
        tables.write_load(df, self.root, table, self.name, column)
        path = tables.load_path(self.root, table, self.name)
        parts = versions.part_names(self.spark, path, column)
        self.version = self.version.replacing(table, self.name, parts, instead)

    def commit(self) -> None:
        self.version = self.version.next()
        versions.commit(self.spark, self.root, self.version)
        versions.clean(self.spark, self.root, tables.FOLDERS)


def now() -> datetime:
    return datetime.now(timezone.utc)


def load_dims(
    source: Source, load: Load | Mart, as_of: datetime, cascade: bool = False
) -> dict[str, int]:
    """Type-1 refresh of both dimensions; keys of known rows stay. Returns the rows of each.

    A dimension lies in buckets of its natural key, and the version keeps a fingerprint of the source
    rows of each. Only buckets whose fingerprint changed are read, joined and written again; the
    files of all others stay. A key is never given twice, even after its row left: the largest
    ones are kept.

    ``cascade`` also empties the fact table, as a cascading truncate would. Given a mart, the refresh
    is a load of its own and commits.
    """
    if isinstance(load, Mart):
        own = Load(load.spark, load.root)
        rows = load_dims(source, own, as_of, cascade)
        own.commit()
        return rows
    rows = {}
    highs = {row["dimension"]: row["highest"] for row in load.mart.key_highs.collect()}
    before = dict(highs)
    for name, schema, frame, natural, key in (
        (
            "dim_customers",
            schemas.DIM_CUSTOMERS,
            extracts.extract_customers(source.customers),
            "customer_id",
            "customer_key",
        ),
        (
            "dim_products",
            schemas.DIM_PRODUCTS,
            extracts.extract_products(source.products),
            "product_id",
            "product_key",
        ),
    ):
        rows[name], highs[name] = _load_dim(
            load, name, schema, frame, natural, key, as_of, highs.get(name, 0)
        )
    if highs != before:
        high_rows = mart_frame(load.spark, list(highs.items()), schemas.KEY_HIGHS)
        load.whole("key_highs", high_rows, schemas.KEY_HIGHS)
    if cascade:
        for table in ("fact_sales", "daily_sums"):
            load.version = load.version.emptied(table)
    return rows


def mart_frame(spark: SparkSession, rows: list, schema) -> DataFrame:
    return spark.createDataFrame(rows, schemas.frame_schema(schema))


def _load_dim(
    load: Load,
    name: str,
    schema,
    frame: DataFrame,
    natural: str,
    key: str,
    as_of: datetime,
    highest: int,
) -> tuple[int, int]:
    """Rows of the dimension, and the largest key ever given."""
    spark = load.spark
    known = load.version.prints.get(name, {})
    buckets = len(known) or DIM_BUCKETS

    def prints(rows: DataFrame) -> dict[str, str]:
        # A row per bucket.
        found = dims.fingerprints(rows, natural, buckets).collect()
        return {str(row["bucket"]): row["print"] for row in found}

    empty = {str(b): "" for b in range(buckets)}
    seen = empty | prints(frame)
    touched = [b for b in seen if seen[b] != known.get(b)]
    if touched:
        bucket = dims.bucket_of(natural, buckets)
        # Everything below comes from rows written once, so a source that changes meanwhile
        # cannot give a row twice or a key to two rows.
        path = scratch_dir(spark, "dim-source")
        frame.where(bucket.isin([int(b) for b in touched])).write.parquet(path)
        rows = spark.read.schema(frame.schema).parquet(path)
        if not quality.duplicate_keys(rows, [natural]).isEmpty():
            raise quality.CheckFailed(f"{natural} repeats in the source of {name}")
        seen |= {b: "" for b in touched}
        seen |= prints(rows)
        existing = None
        if known:
            held = load.version.parts(name)
            old = {k: [b for b in bs if b in touched] for k, bs in held.items()}
            part = Version(0, {name: {k: bs for k, bs in old.items() if bs}}, {name: load.version.sizes[name]})
            existing = tables.read_table(spark, load.root, name, part, schema)
        refreshed = dims.refresh_dim(rows, natural, key, as_of, existing, highest)
        counted = Observation()
        written = schemas.enforce(refreshed, schema).observe(counted, F.max(key).alias("highest"))
        load.divided(name, written.withColumn("bucket", bucket).hint("rebalance", "bucket"), "bucket", touched)
        highest = max(highest, counted.get["highest"] or 0)
        load.version = load.version.with_prints(name, seen)
    return sum(int(p.split(":")[0]) for p in seen.values() if p), highest


def load_facts(
    source: Source, load: Load, start: date | str, end: date | str, as_of: datetime
) -> dict:
    """Replace the facts and the rejects of all dates in the range that have sales.

    One pass over the source writes both, so they cannot disagree; rows are counted as the
    last stage writes them, where a task that runs again counts once. A date left with rejects
    alone loses its facts.
    """
    mart = load.mart
    seen = Observation()
    sales = extracts.sales_between(source.sales, start, end)
    keyed = facts.lookup_keys(sales, mart.dim_customers, mart.dim_products)
    # Files of about equal size per date; AQE splits a date far larger than the rest.
    spread = facts.told_apart(keyed).hint("rebalance", "sale_date").observe(
        seen, row_count().alias("extracted"), F.count_if(F.col("reason").isNull()).alias("accepted")
    )
    tables.write_load(facts.loaded_rows(spread, as_of), load.root, "fact_sales", load.name, "sale_date")
    counts = seen.get
    path = tables.load_path(load.root, "fact_sales", load.name)
    loaded = [p for p in versions.part_names(load.spark, path, "sale_date") if p != tables.NO_DATE]
    rejected: list[str] = []
    if counts["extracted"] > counts["accepted"]:
        stored = load.spark.read.parquet(f"{path}/sale_date={tables.NO_DATE}")
        # A row per date of the range.
        rejected = [str(row[0]) for row in stored.select("reject_date").distinct().collect()]
    dates = {*loaded, *rejected}
    load.version = load.version.replacing("fact_sales", load.name, loaded, dates)
    load.version = load.version.replacing("fact_rejects", load.name, rejected, dates)
    return {
        "extracted": counts["extracted"],
        "accepted": counts["accepted"],
        "loaded": loaded,
        "emptied": sorted({*rejected} - {*loaded}),
    }


def load_sums(load: Load, start: date | str, end: date | str, counts: dict) -> None:
    """Replace the kept daily sums of the dates this load brought, from its facts as they are stored."""
    fresh = Version(
        0,
        {"fact_sales": {load.name: counts["loaded"]}} if counts["loaded"] else {},
        {"fact_sales": {load.name: len(counts["loaded"])}},
    )
    stored = Mart(load.spark, load.root, fresh).fact_sales
    sums = schemas.enforce(summary.daily_sums(stored), schemas.DAILY_SUMS)
    tables.write_load(sums, load.root, "daily_sums", load.name)
    dates = [*counts["loaded"], *counts["emptied"]]
    load.version = load.version.replacing("daily_sums", load.name, counts["loaded"], dates)


def load_summary(load: Load, start: date | str, end: date | str, as_of: datetime, emptied: Collection[str] = ()) -> None:
    """Recompute and upsert the summaries of the range from its kept sums.

    The summaries of ``emptied`` dates, whose facts this load took away, go.
    """
    mart = load.mart
    stamp = F.lit(str(as_of)).cast("timestamp")
    incoming = summary.summary_of_sums(mart.sums_between(start, end), mart.dim_products).withColumns(
        {"loaded_at": stamp, "updated_at": stamp}
    )
    existing = mart.sales_summary_daily
    if emptied:
        existing = existing.where(~F.col("summary_date").cast("string").isin(list(emptied)))
    merged = summary.upsert(existing, incoming, ["summary_date"], keep=["loaded_at"])
    load.whole("sales_summary_daily", merged, schemas.SALES_SUMMARY_DAILY)


def load_checks(load: Load, start: date | str, end: date | str, counts: dict) -> DataFrame:
    """Checks of the range this load replaced, and a warning when it brought nothing."""
    mart = load.mart
    parents = {
        "customer_key": mart.dim_customers.select("customer_key"),
        "product_key": mart.dim_products.select("product_key"),
    }
    summaries = extracts.sales_between(mart.sales_summary_daily, start, end, "summary_date")
    sums = mart.sums_between(start, end)
    checks = quality.check_load(sums, counts["loaded"], summaries, parents, start, counts["accepted"])
    return checks.unionByName(quality.check_any_rows(load.spark, start, counts["accepted"]))


def run_range(
    spark: SparkSession,
    source: Source,
    root: str,
    start: date | str,
    end: date | str,
    as_of: datetime | None = None,
    cascade: bool = False,
) -> dict:
    """Load an inclusive range of dates in one go, without a loop over days.

    The load shows as a whole once its checks have passed, or not at all. Running it again, with
    the same ``as_of`` or another, leaves the same state. A failure is written to the run log with
    its text and raised again.
    """
    mart, at = Mart(spark, root), as_of or now()
    log_path = mart.path("etl_log")
    log_id = runlog.start_run(spark, log_path, JOB_NAME, TASK_NAME, start, now())
    try:
        load = Load(spark, root)
        dim_rows = load_dims(source, load, at, cascade)
        counts = load_facts(source, load, start, end, at)
        if counts["extracted"] == 0:
            log.warning("no sales from %s to %s", start, end)
        rejected = counts["extracted"] - counts["accepted"]
        if rejected:
            log.warning("%d sales without a dimension row are in fact_rejects", rejected)
        load_sums(load, start, end, counts)
        load_summary(load, start, end, at, counts["emptied"])
        checks = quality.raise_on_failure(load_checks(load, start, end, counts))
        load.commit()
    except Exception as error:
        runlog.update_run(
            spark, log_path, log_id, runlog.FAILED, now(), error_message=str(error)
        )
        raise
    runlog.complete_run(spark, log_path, log_id, counts["accepted"], counts["extracted"], now())
    return {
        "log_id": log_id,
        "rows_extracted": counts["extracted"],
        "rows_loaded": counts["accepted"],
        "dim_rows": dim_rows,
        "checks": checks,
    }


def run_daily(
    spark: SparkSession,
    source: Source,
    root: str,
    day: date | str,
    as_of: datetime | None = None,
    cascade: bool = False,
) -> dict:
    """Load one day; the result carries the day's figures, None without a summary."""
    result = run_range(spark, source, root, day, day, as_of, cascade)
    stats = summary.summary_stats(Mart(spark, root).sales_summary_daily, day).first()
    return {**result, "stats": stats.asDict() if stats else None}


def run_staging(
    spark: SparkSession,
    source: Source,
    root: str,
    environment: str,
    batch_id: int,
    day: date | str | None = None,
    as_of: datetime | None = None,
    strict_reference: bool = False,
) -> int:
    """Append all sales (or one day's) to the staging table and return their number.

    Nothing is removed first; loads are told apart by ``batch_id``.
    """
    seen = Observation()
    audited = staging.add_audit_columns(
        extracts.scan_sales(source.sales, day), environment, batch_id, as_of
    )
    rows = staging.to_stage_sales(audited, strict_reference).observe(
        seen, row_count().alias("rows")
    )
    load = Load(spark, root)
    load.more("stage_sales", rows, schemas.STAGE_SALES)
    load.commit()
    return seen.get["rows"]


def run_stage_dims(
    spark: SparkSession, source: Source, root: str, as_of: datetime | None = None
) -> None:
    """Append customers and products to their staging tables with status New, in one commit."""
    load = Load(spark, root)
    for name, schema, frame, build in (
        ("stage_customers", schemas.STAGE_CUSTOMERS, source.customers, staging.to_stage_customers),
        ("stage_products", schemas.STAGE_PRODUCTS, source.products, staging.to_stage_products),
    ):
        last = getattr(load.mart, name).agg(F.max("stage_id")).first()[0] or 0
        load.more(name, build(frame, as_of, last + 1), schema)
    load.commit()


HIGH = "execution_id"


def run_log_increment(spark: SparkSession, executions: DataFrame, root: str) -> int:
    """Store the executions that came since the last increment and return their number.

    The version keeps the largest id stored, so a run reads newer rows only (ids rise with time, and
    a logged execution is final). They lie by the day they began. Of each day the newest execution
    per folder, project and package is kept; only the days of the increment are merged.
    """
    load = Load(spark, root)
    high = load.version.prints.get("executions", {}).get(HIGH)
    day = F.col("start_time").cast("date").alias("log_date")
    newer = executions if high is None else executions.where(F.col(HIGH) > int(high))
    fresh = schemas.conform(newer, schemas.EXECUTIONS)
    seen = Observation()
    rows = fresh.observe(seen, row_count().alias("rows"), F.max(HIGH).alias("high"))
    tables.write_load(rows.select("*", day), root, "executions", load.name, "log_date")
    counted = seen.get
    if not counted["rows"]:
        return 0
    path = tables.load_path(root, "executions", load.name)
    days = versions.part_names(spark, path, "log_date")
    mine = Version(0, {"executions": {load.name: days}}, {"executions": {load.name: len(days)}})
    new = tables.read_table(spark, root, "executions", mine, schemas.EXECUTIONS)
    held = {k: [d for d in ds if d in days] for k, ds in load.version.parts("latest_executions").items()}
    part = Version(
        0,
        {"latest_executions": {k: ds for k, ds in held.items() if ds}},
        {"latest_executions": load.version.sizes.get("latest_executions", {})},
    )
    known = tables.read_table(spark, root, "latest_executions", part, schemas.EXECUTIONS)
    newest = joblog.newest_of_days(known.unionByName(new)).select("*", day)
    load.version = load.version.adding("executions", load.name, days)
    load.divided("latest_executions", newest, "log_date", days)
    load.version = load.version.with_prints("executions", {HIGH: str(counted["high"])})
    load.commit()
    return counted["rows"]


def run_log_retention(
    spark: SparkSession,
    root: str,
    as_of: datetime | str,
    days: int = joblog.RETENTION_DAYS,
    dry_run: bool = True,
) -> int:
    """Drop stored executions past retention, whole days at a time, and return their number.

    Days before the cutoff's are counted without reading a column, and their folders go once no
    kept version names them; only the cutoff's own day is written again. Nothing is dropped in a dry run.
    """
    load = Load(spark, root)
    held = load.version.parts("executions")
    cutoff = datetime.fromisoformat(str(as_of)) - timedelta(days=days)
    edge = str(cutoff.date())
    every = {d for ds in held.values() for d in ds if d != tables.NO_DATE}
    gone = sorted(d for d in every if d < edge)

    def stored(dates: Collection[str]) -> DataFrame:
        parts = {k: [d for d in ds if d in dates] for k, ds in held.items()}
        parts = {k: ds for k, ds in parts.items() if ds}
        part = Version(0, {"executions": parts}, {"executions": load.version.sizes.get("executions", {})})
        return tables.read_table(spark, root, "executions", part, schemas.EXECUTIONS)

    last_day = stored([edge])
    old = joblog.past_retention(last_day, as_of, days)
    dropped = stored(gone).count() + last_day.where(old).count()
    if dry_run or not dropped:
        return dropped
    if edge in every:
        kept = last_day.where(~F.coalesce(old, F.lit(False)))
        load.divided("executions", kept.select("*", F.lit(edge).alias("log_date")), "log_date", [*gone, edge])
    else:
        load.version = load.version.replacing("executions", load.name, [], gone)
    load.version = load.version.replacing("latest_executions", load.name, [], gone)
    load.commit()
    return dropped


@dataclass(frozen=True)
class Logs:
    """Job log relations an audit reads."""

    executions: DataFrame
    messages: DataFrame

    @classmethod
    def from_parquet(cls, spark: SparkSession, folder: str) -> Logs:
        return cls(adapters.executions(spark, folder), adapters.messages(spark, folder))


def run_audit(
    logs: Logs,
    stage: DataFrame,
    day: date | str,
    as_of: datetime | str,
    fail_on_error: bool = True,
) -> dict[str, DataFrame]:
    """Audit after a load: status, message statistics, stage rows, report, retention.

    Raises when a newest execution of the day did not succeed, unless told not to.
    """
    latest = joblog.latest_execution(logs.executions, day)
    failures = quality.check_execution(latest, logs.messages)
    if fail_on_error:
        first = failures.first()
        if latest.isEmpty():
            raise quality.CheckFailed(f"no execution on {day}")
        if first is not None:
            raise quality.CheckFailed(
                f"execution {first.execution_id} ended as {first.status_text}: "
                + "; ".join(first.errors)
            )
    # The messages of the verified executions only, not of other operations.
    messages = joblog.of_operations(logs.messages, latest)
    return {
        "latest_execution": latest,
        "failures": failures,
        "message_type_counts": joblog.message_type_counts(messages),
        "stage_rows": quality.warn_if_empty(stage, day),
        "rows_loaded": quality.check_loaded(stage, day),
        "component_stats": joblog.component_stats(messages),
        "latest_messages": joblog.latest_messages(messages),
        "run_report": joblog.run_report(logs.executions, logs.messages, stage),
        "day_report": joblog.day_report(latest, extracts.rows_of_day(stage, day), day),
        "retention": joblog.purge(logs.executions, as_of),
    }
