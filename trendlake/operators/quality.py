"""Table checks. One aggregate pass over the whole table gives one profile row;
all check records are built from that row, so nothing is sampled or collected.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, TimestampType

from trendlake.functions import instant
from trendlake.schemas import CHECK_RECORD, CRITICAL_COLUMNS

# Default thresholds.
MIN_ROW_COUNT = 10
MAX_NULL_PCT = 5.0
MAX_VIEWS = 50_000_000_000
FRESHNESS_HOURS = 48
RANGE_TABLE, RANGE_COLUMN = "clean_statistics", "views"
EXTREMES = ("latest",)  # aggregates that are a greatest value; all others count
STAMP_COLUMNS = ("_processed_at", "_ingestion_timestamp")
ZONED = r":\d{2}(\.\d+)?\s*(Z|z|[+-]\d{1,2}(:?\d{2})?|[A-Za-z][\w/+:-]*)$"  # time text that names its zone


@dataclass(frozen=True)
class Check:
    """Aggregates over the table, and the records built from their results."""

    aggregates: Mapping[str, Column]
    records: Sequence[Column]


def _record(check: str, table: str, passed: Column, message: Column, **fields: Column) -> Column:
    values = {"check": F.lit(check), "table": F.lit(table), "passed": passed, "message": message, **fields}
    return F.struct(
        *(values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in CHECK_RECORD)
    )


def _expected(table: str, columns: Sequence[str] | None) -> Sequence[str]:
    return CRITICAL_COLUMNS.get(table, ()) if columns is None else columns


def _row_count(table: str, minimum: int) -> Check:
    n = F.col("n")
    message = F.concat(F.lit("Row count: "), n, F.lit(f" (min: {minimum})"))
    record = _record("row_count", table, n >= minimum, message, value=n, threshold=F.lit(minimum))
    return Check({"n": F.count(F.lit(1))}, [record])


def _is_missing(df: DataFrame, name: str) -> Column:
    c = F.col(f"`{name}`")
    return c.isNull() | F.isnan(c) if isinstance(df.schema[name].dataType, (FloatType, DoubleType)) else c.isNull()


def _null_pct(df: DataFrame, table: str, columns: Sequence[str], maximum: float) -> Check:
    aggregates, records = {"n": F.count(F.lit(1))}, []
    for i, name in enumerate(columns):
        if name not in df.columns:
            records.append(
                _record("null_pct", table, F.lit(False), F.lit(f"Column '{name}' missing from table"), column=F.lit(name))
            )
            continue
        aggregates[f"null_{i}"] = F.count_if(_is_missing(df, name))
        pct = F.coalesce(F.try_divide(F.col(f"null_{i}"), F.col("n")) * 100, F.lit(0.0))
        message = F.format_string(f"{name.replace('%', '%%')} null%%: %.2f%% (max: {maximum}%%)", pct)
        records.append(
            _record(
                "null_pct", table, pct <= maximum, message,
                column=F.lit(name), value=F.round(pct, 2), threshold=F.lit(maximum),
            )
        )
    return Check(aggregates, records)


def _schema(df: DataFrame, table: str, columns: Sequence[str]) -> Check:
    missing = sorted(set(columns) - set(df.columns))
    listed = ", ".join(f"'{name}'" for name in missing)
    message = f"Missing columns: {{{listed}}}" if missing else "All expected columns present"
    found = F.array(*(F.lit(name) for name in missing))
    return Check({}, [_record("schema", table, F.lit(not missing), F.lit(message), missing_columns=found)])


def _value_range(df: DataFrame, table: str, column: str, maximum: int) -> Check:
    if column not in df.columns:
        return Check({}, [])
    c, negative, extreme = F.col(f"`{column}`"), F.col("negative"), F.col("extreme")
    message = F.concat(
        F.lit(f"{column.capitalize()}: "), negative, F.lit(" negative, "), extreme, F.lit(f" extreme (>{maximum})")
    )
    record = _record(
        "value_range", table, (negative == 0) & (extreme == 0), message,
        column=F.lit(column), negative_count=negative, extreme_count=extreme,
    )
    return Check({"negative": F.count_if(c < 0), "extreme": F.count_if(c > maximum)}, [record])


def _utc_text(ts: Column) -> Column:
    """The instant as UTC text. Reckoned from the epoch without a zone, so the session's does not matter."""
    micros = F.unix_micros(ts)
    seconds, rest = F.floor(micros / 1_000_000), F.pmod(micros, F.lit(1_000_000))
    start = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    whole = (start + F.make_dt_interval(secs=seconds.cast("decimal(18,6)"))).cast("string")
    fraction = F.concat(F.lit("."), F.lpad(rest.cast("string"), 6, "0"))
    return F.concat(whole, F.when(rest == 0, "").otherwise(fraction), F.lit("+00:00"))


def _utc_instant(df: DataFrame, column: str) -> Column:
    """The column as an instant; text and dates without a zone are UTC, whatever the session's zone."""
    raw = F.col(column)
    if isinstance(df.schema[column].dataType, TimestampType):
        return raw
    text = F.trim(raw.cast("string"))
    naive = F.concat(text.try_cast("timestamp_ntz").cast("string"), F.lit("+00:00")).try_cast("timestamp")
    return F.when(text.rlike(ZONED), text.try_cast("timestamp")).otherwise(naive)


def _freshness(df: DataFrame, table: str, hours: int, as_of: dt.datetime | None) -> Check:
    column = next((name for name in STAMP_COLUMNS if name in df.columns), None)
    if column is None:
        message = "No timestamp column found — skipping freshness check (backfill data)"
        return Check({}, [_record("freshness", table, F.lit(True), F.lit(message))])
    raw = F.col(column)
    parsed = _utc_instant(df, column)
    cutoff = instant(as_of) - F.expr(f"INTERVAL {int(hours)} HOURS")
    latest, unparsable = F.col("latest"), F.col("unparsable") > 0
    latest_text, cutoff_text = F.coalesce(_utc_text(latest), F.lit("NaT")), _utc_text(cutoff)
    skipped = F.concat(F.lit("Could not parse timestamps: "), F.col("unparsable"), F.lit(" values — skipping"))
    record = _record(
        "freshness", table,
        # An all-null column has no latest record and fails; unparsable text is skipped.
        unparsable | F.coalesce(latest >= cutoff, F.lit(False)),
        F.when(unparsable, skipped).otherwise(
            F.concat(F.lit("Latest: "), latest_text, F.lit(", Cutoff: "), cutoff_text)
        ),
        latest_record=F.when(~unparsable, latest_text),
        cutoff=F.when(~unparsable, cutoff_text),
    )
    return Check({"latest": F.max(parsed), "unparsable": F.count_if(raw.isNotNull() & parsed.isNull())}, [record])


@dataclass(frozen=True)
class Records:
    """Check records of a table that have been made already."""

    rows: DataFrame


def aggregates_of(checks: Sequence[Check]) -> dict[str, Column]:
    aggregates: dict[str, Column] = {}
    for check in checks:
        aggregates |= check.aggregates
    # With no aggregate (schema only) a count still yields the single row to build from.
    return aggregates or {"n": F.count(F.lit(1))}


def merged(profiles: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The profile of a table from those of its parts (``agg_`` before the names): counts add up, the latest stamp is the
    latest of all."""
    whole = {name: F.max(f"agg_{name}") if name in EXTREMES else F.coalesce(F.sum(f"agg_{name}"), F.lit(0)) for name in aggregates_of(checks)}
    return profiles.agg(*(c.alias(name) for name, c in whole.items()))


def records_of(profile: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """The records of the checks from the one row of their aggregates."""
    return profile.select(F.inline(F.array(*(record for check in checks for record in check.records))))


def _evaluate(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    if not any(check.records for check in checks):
        return df.sparkSession.createDataFrame([], CHECK_RECORD)
    return records_of(df.agg(*(c.alias(name) for name, c in aggregates_of(checks).items())), checks)


def check_row_count(df: DataFrame, table: str, minimum: int = MIN_ROW_COUNT) -> DataFrame:
    return _evaluate(df, [_row_count(table, minimum)])


def check_null_pct(
    df: DataFrame, table: str, columns: Sequence[str] | None = None, maximum: float = MAX_NULL_PCT
) -> DataFrame:
    return _evaluate(df, [_null_pct(df, table, _expected(table, columns), maximum)])


def check_schema(df: DataFrame, table: str, columns: Sequence[str] | None = None) -> DataFrame:
    return _evaluate(df, [_schema(df, table, _expected(table, columns))])


def check_value_range(
    df: DataFrame, table: str, column: str = RANGE_COLUMN, maximum: int = MAX_VIEWS
) -> DataFrame:
    return _evaluate(df, [_value_range(df, table, column, maximum)] if table == RANGE_TABLE else [])


def check_freshness(
    df: DataFrame, table: str, hours: int = FRESHNESS_HOURS, as_of: dt.datetime | None = None
) -> DataFrame:
    return _evaluate(df, [_freshness(df, table, hours, as_of)])


def table_checks(
    df: DataFrame,
    table: str,
    min_rows: int = MIN_ROW_COUNT,
    max_null_pct: float = MAX_NULL_PCT,
    max_value: int = MAX_VIEWS,
    hours: int = FRESHNESS_HOURS,
    as_of: dt.datetime | None = None,
    columns: Sequence[str] | None = None,
) -> list[Check]:
    """All five checks of a table with the columns of ``df``."""
    expected = _expected(table, columns)
    checks = [
        _row_count(table, min_rows),
        _null_pct(df, table, expected, max_null_pct),
        _schema(df, table, expected),
    ]
    if table == RANGE_TABLE:
        checks.append(_value_range(df, table, RANGE_COLUMN, max_value))
    checks.append(_freshness(df, table, hours, as_of))
    return checks


def check_table(df: DataFrame, table: str, **options) -> DataFrame:
    """All five checks in one aggregate pass over the whole table. Options: those of ``table_checks``."""
    return _evaluate(df, table_checks(df, table, **options))


def run_checks(
    spark: SparkSession,
    tables: Mapping[str, DataFrame | str | Callable[[], DataFrame | Records]],
    isolate: bool = False,
    **options,
) -> DataFrame:
    """Check records of several tables, in one frame.

    A table is a DataFrame, a catalog name, or a function that reads it or gives its ``Records``. One that
    cannot be read gives a failed ``read_table`` record and the others go on. With
    ``isolate`` each table's pass runs at once, so that errors found only while
    reading its files are recorded as well.
    """
    results = []
    for name, source in tables.items():
        try:
            df = spark.table(source) if isinstance(source, str) else source() if callable(source) else source
            records = df.rows if isinstance(df, Records) else check_table(df, name, **options)
            if isolate:
                # A handful of records per table: 5 checks, one of them per critical column.
                records = spark.createDataFrame(records.collect(), CHECK_RECORD)
        except Exception as error:  # whatever a loader raises concerns its own table only
            text = str(getattr(error, "java_exception", error))
            failed = _record("read_table", name, F.lit(False), F.lit(text))
            records = spark.range(1).select(F.inline(F.array(failed)))
        results.append(records)
    if not results:
        return spark.createDataFrame([], CHECK_RECORD)
    return reduce(DataFrame.unionByName, results)


def summary(results: DataFrame) -> DataFrame:
    """One row: overall result, counts and the records as JSON. Its size depends on
    the number of checks, not on the data."""
    return results.agg(
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("quality_passed"),
        F.count_if(F.col("passed")).alias("checks_passed"),
        F.count(F.lit(1)).alias("checks_total"),
        F.to_json(F.sort_array(F.collect_list(F.struct(*(f"`{f.name}`" for f in CHECK_RECORD))))).alias("details"),
    )


def alerts(results: DataFrame, subject: str = "Data quality checks FAILED") -> DataFrame:
    """One alert per failed check: the subject and the record as JSON."""
    failed = results.where(~F.col("passed"))
    return failed.select(
        F.lit(subject).alias("subject"),
        F.to_json(F.struct(*(f"`{f.name}`" for f in CHECK_RECORD))).alias("message"),
    )
