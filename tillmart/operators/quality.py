"""Quality checks. Every check is a frame of the same six columns."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.functions.decode import EXECUTION_SUCCEEDED
from tillmart.functions.money import row_count
from tillmart.functions.timefmt import as_date
from tillmart.operators import joblog
from tillmart.sources.extracts import rows_of_day

CHECK_COLUMNS = ["check_name", "severity", "subject_date", "expected", "actual", "passed"]


class CheckFailed(RuntimeError):
    """A check of severity ``error`` did not pass."""


def _check(
    counted: DataFrame,
    name: str,
    expected: Column,
    day: date | str | None,
    passed: Column,
    severity: str = "error",
) -> DataFrame:
    return counted.select(
        F.lit(name).alias("check_name"),
        F.lit(severity).alias("severity"),
        (F.lit(None).cast("date") if day is None else as_date(day)).alias("subject_date"),
        expected.cast("bigint").alias("expected"),
        F.col("actual").cast("bigint").alias("actual"),
        passed.alias("passed"),
    )


def _of_day(table: DataFrame, day: date | str | None, column: str = "sale_date") -> DataFrame:
    return table if day is None else rows_of_day(table, day, column)


def check_count(fact: DataFrame, day: date | str | None, expected: int | DataFrame) -> DataFrame:
    """The fact holds as many rows as were loaded.

    ``expected`` is a number, or a frame whose rows are counted.
    """
    counted = _of_day(fact, day).agg(row_count().alias("actual"))
    if isinstance(expected, DataFrame):
        counted = counted.withColumn(
            "wanted", expected.agg(row_count().alias("wanted")).scalar()
        )
    else:
        counted = counted.withColumn("wanted", F.lit(expected))
    wanted = F.col("wanted")
    return _check(counted, "fact_count", wanted, day, F.col("actual") == wanted)


def _has_null_key() -> Column:
    return F.col("customer_key").isNull() | F.col("product_key").isNull()


def check_null_keys(fact: DataFrame, day: date | str | None) -> DataFrame:
    counted = _of_day(fact, day).agg(F.count_if(_has_null_key()).alias("actual"))
    return _check(counted, "null_keys", F.lit(0), day, F.col("actual") == 0)


def check_facts(keyed: DataFrame, day: date | str | None, expected: Column | None = None) -> DataFrame:
    """Row count and null keys in one pass over rows that went through the key lookup.

    Without ``expected`` every row of ``keyed`` should have both keys; ``expected`` is an
    aggregate over the rows otherwise.
    """
    rows = row_count()
    found = _of_day(keyed, day).agg(
        F.coalesce(rows if expected is None else expected, F.lit(0)).alias("wanted"),
        F.count_if(~_has_null_key()).alias("fact_count"),
        F.count_if(_has_null_key()).alias("null_keys"),
    )
    return _all_equal(found, {"fact_count": F.col("wanted"), "null_keys": F.lit(0)}, day)


def _all_equal(found: DataFrame, wanted: Mapping[str, Column], day: date | str | None) -> DataFrame:
    """One check per column of a single row of figures: it equals the wanted figure."""
    figures = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                figure.cast("bigint").alias("expected"),
                F.col(name).cast("bigint").alias("actual"),
            )
            for name, figure in wanted.items()
        ]
    )
    return found.select(F.inline(figures)).select(
        "check_name",
        F.lit("error").alias("severity"),
        (F.lit(None).cast("date") if day is None else as_date(day)).alias("subject_date"),
        "expected",
        "actual",
        (F.col("expected") == F.col("actual")).alias("passed"),
    )


def check_load(
    sums: DataFrame,
    dates: Collection[str],
    summary: DataFrame,
    parents: Mapping[str, DataFrame],
    day: date | str | None,
    accepted: int,
) -> DataFrame:
    """The checks behind a load, over the daily sums of the facts of its range as they are stored.

    Row count and null keys of the ``dates`` the load wrote; facts whose key has no row in its
    dimension, as a dimension reload can leave behind (a warning: history is kept); dates of the
    load without a summary; summaries of the range without facts. ``summary`` is cut to the range.
    The facts themselves are not read again: every figure adds up from the sums.
    """
    mine = F.col("sale_date").cast("string").isin(list(dates))
    by_customer = F.col("by_customer")
    no_key = F.when(by_customer, F.col("customer_key").isNull()).otherwise(F.col("product_key").isNull())
    figures = sums.agg(
        F.coalesce(F.sum(F.when(mine & ~by_customer, F.col("orders"))), F.lit(0)).alias("fact_count"),
        F.coalesce(F.sum(F.when(mine & no_key, F.col("orders"))), F.lit(0)).alias("null_keys"),
    )
    checks = report(
        _all_equal(figures, {"fact_count": F.lit(accepted), "null_keys": F.lit(0)}, day),
        check_missing_summaries(sums.where(mine), summary, day),
        check_stale_summaries(sums, summary, day),
    )
    orphans = None
    for key, parent in parents.items():
        keyed = sums.where(F.col(key).isNotNull()).groupBy(key).agg(F.sum("orders").alias("rows"))
        alone = keyed.join(parent.select(key), key, "left_anti").select("rows")
        orphans = alone if orphans is None else orphans.unionAll(alone)
    counted = orphans.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("actual"))
    return checks.unionByName(
        _check(counted, "facts_without_parent", F.lit(0), day, F.col("actual") == 0, "warn")
    )


def check_summary(summary: DataFrame, day: date | str) -> DataFrame:
    """The day has a summary row."""
    counted = rows_of_day(summary, day, "summary_date").agg(row_count().alias("actual"))
    return _check(counted, "summary_exists", F.lit(1), day, F.col("actual") > 0)


def null_key_counts(keyed: DataFrame) -> DataFrame:
    """Rows without a customer or product key, per date."""
    return keyed.groupBy("sale_date").agg(F.count_if(_has_null_key()).alias("null_count"))


def missing_summaries(fact: DataFrame, summary: DataFrame) -> DataFrame:
    """Dates that have facts but no summary."""
    return (
        fact.select("sale_date")
        .distinct()
        .join(summary.select(F.col("summary_date").alias("sale_date")), "sale_date", "left_anti")
    )


def check_missing_summaries(
    fact: DataFrame, summary: DataFrame, day: date | str | None = None
) -> DataFrame:
    counted = missing_summaries(fact, summary).agg(row_count().alias("actual"))
    return _check(counted, "missing_summaries", F.lit(0), day, F.col("actual") == 0)


def stale_summaries(fact: DataFrame, summary: DataFrame) -> DataFrame:
    """Dates that have a summary but no facts."""
    dates = fact.select(F.col("sale_date").alias("summary_date")).distinct()
    return summary.select("summary_date").join(dates, "summary_date", "left_anti")


def check_stale_summaries(
    fact: DataFrame, summary: DataFrame, day: date | str | None = None
) -> DataFrame:
    counted = stale_summaries(fact, summary).agg(row_count().alias("actual"))
    return _check(counted, "stale_summaries", F.lit(0), day, F.col("actual") == 0)


def load_verification(
    table: DataFrame, day: date | str, last: str, last_name: str = "last_load_time"
) -> DataFrame:
    """Rows of the day and the largest value of the load marker ``last``."""
    return rows_of_day(table, day).agg(
        row_count().alias("rows_loaded"), F.max(last).alias(last_name)
    )


def check_loaded(table: DataFrame, day: date | str) -> DataFrame:
    """The day has rows."""
    counted = rows_of_day(table, day).agg(row_count().alias("actual"))
    return _check(counted, "rows_loaded", F.lit(1), day, F.col("actual") > 0)


def check_any_rows(spark: SparkSession, day: date | str, loaded: int) -> DataFrame:
    """A load that brought no rows is a warning."""
    counted = spark.range(1).select(F.lit(loaded).alias("actual"))
    return _check(counted, "no_data", F.lit(1), day, F.col("actual") > 0, "warn")


def warn_if_empty(stage: DataFrame, day: date | str) -> DataFrame:
    """As ``check_loaded``, but an empty day is only a warning."""
    counted = rows_of_day(stage, day).agg(row_count().alias("actual"))
    return _check(counted, "stage_rows", F.lit(1), day, F.col("actual") > 0, severity="warn")


def stage_row_count(stage: DataFrame, day: date | str) -> DataFrame:
    counted = rows_of_day(stage, day).agg(row_count().alias("row_count"))
    return counted.select(
        as_date(day).alias("sale_date"),
        "row_count",
        F.when(F.col("row_count") > 0, "ok").otherwise("warn").alias("severity"),
    )


def guard_empty(df: DataFrame) -> bool:
    """True when an extract has no rows and its load should be left out."""
    return df.isEmpty()


def check_execution(latest: DataFrame, messages: DataFrame) -> DataFrame:
    """Latest executions that did not succeed, with up to five of their error messages.

    ``latest`` has one row per execution. The newest errors of an operation are picked
    before they are gathered, so its array stays short however many there are.
    """
    errors = joblog.newest_errors(joblog.of_operations(messages, latest))
    texts = errors.groupBy("operation_id").agg(
        F.sort_array(F.collect_list(F.struct("message_time", "message")), asc=False).alias("_m")
    )
    return (
        latest.where(F.col("status") != EXECUTION_SUCCEEDED)
        .join(texts, "operation_id", "left")
        .select(
            "execution_id",
            "status_text",
            F.coalesce(F.col("_m.message"), F.array().cast("array<string>")).alias("errors"),
        )
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once."""
    return df.groupBy(*keys).agg(row_count().alias("rows")).where(F.col("rows") > 1)


def constraint_violations(
    df: DataFrame,
    name: str,
    primary_key: str | None = None,
    required: Sequence[str] = (),
    foreign_keys: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """Violations per declared constraint of one table: (constraint_name, violations).

    A primary key counts its repeated values, NOT NULL its rows, a foreign key the
    rows without a parent; keys are whole numbers. The table is read once: every row
    gives one (column, value) pair per key column, and the pairs are summed up
    before the shuffle and before the parents join, so a value on a third of all rows
    is a single row there. Nulls of other columns need no groups: they are counted along with
    the pairs of the first key column.
    """
    parents = dict(foreign_keys or {})
    keys = list(dict.fromkeys([*([primary_key] if primary_key else []), *parents]))
    plain = [c for c in dict.fromkeys(required) if c not in keys]
    if not keys:
        nulls = {f"{name}_not_null_{c}": F.count_if(F.col(c).isNull()) for c in plain}
        return _unpivoted(df.agg(*[count.alias(label) for label, count in nulls.items()]), nulls)
    pairs = F.array(
        *[
            F.struct(
                F.lit(key).alias("column"),
                F.col(key).cast("bigint").alias("value"),
                *(
                    (F.col(c).isNull() if key == keys[0] else F.lit(False)).alias(f"_null_{i}")
                    for i, c in enumerate(plain)
                ),
            )
            for key in keys
        ]
    )
    counts = (
        df.select(F.inline(pairs))
        .groupBy("column", "value")
        .agg(
            row_count().alias("rows"),
            *(F.count_if(f"_null_{i}").alias(f"_nulls_{i}") for i in range(len(plain))),
        )
    )
    known = F.lit(True)
    if parents:
        given = None
        for column, parent in parents.items():
            ids = parent.select(
                F.lit(column).alias("column"), F.col(column).cast("bigint").alias("value")
            )
            given = ids if given is None else given.unionByName(ids)
        given = given.distinct().withColumn("known", F.lit(True))
        counts, known = counts.join(given, ["column", "value"], "left"), F.col("known")

    def rows_where(column: str, condition: Column) -> Column:
        hit = (F.col("column") == column) & condition
        return F.coalesce(F.sum(F.when(hit, F.col("rows"))), F.lit(0))

    found: dict[str, Column] = {}
    if primary_key:
        repeated = (F.col("column") == primary_key) & (F.col("rows") > 1)
        found[f"{name}_pk_{primary_key}"] = F.count_if(repeated)
    for column in required:
        found[f"{name}_not_null_{column}"] = (
            F.coalesce(F.sum(f"_nulls_{plain.index(column)}"), F.lit(0))
            if column in plain
            else rows_where(column, F.col("value").isNull())
        )
    for column in parents:
        orphan = F.col("value").isNotNull() & known.isNull()
        found[f"{name}_fk_{column}"] = rows_where(column, orphan)
    return _unpivoted(counts.agg(*[count.alias(label) for label, count in found.items()]), found)


def _unpivoted(figures: DataFrame, labels: Collection[str]) -> DataFrame:
    return figures.unpivot([], list(labels), "constraint_name", "violations")


def report(*checks: DataFrame) -> DataFrame:
    combined = checks[0]
    for frame in checks[1:]:
        combined = combined.unionByName(frame)
    return combined


def raise_on_failure(checks: DataFrame) -> list:
    """Run a report (one row per check) and raise when an error-severity check failed."""
    rows = checks.collect()
    failed = [r for r in rows if r.severity == "error" and not r.passed]
    if failed:
        raise CheckFailed(
            "; ".join(f"{r.check_name}: expected {r.expected}, found {r.actual}" for r in failed)
        )
    return rows
