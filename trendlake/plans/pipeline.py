"""The whole run: bronze to silver, the quality gate, silver to gold."""

from __future__ import annotations

import datetime as dt
import logging
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from trendlake.operators import gold, quality
from trendlake.operators.clean import add_ratios, cleanse, silver_statistics, stamp, to_canonical
from trendlake.operators.enrich import attach_category, build_lookup
from trendlake.operators.reference import ingest_report, parse_documents, report_alerts, silver_reference
from trendlake.plans.increments import update_gold
from trendlake.plans.profiles import check_partitions
from trendlake.schemas import INGEST_REPORT
from trendlake.session import materialise, path_exists, release
from trendlake.sinks import overwrite_partitions, write_partitioned
from trendlake.sources import read_optional, read_table
from trendlake.streaming.ingest import MERGE_PARTITIONS, merge_latest, publish

log = logging.getLogger(__name__)


class QualityGateError(RuntimeError):
    """The checks failed; ``summary`` is the summary row as a dict."""

    def __init__(self, summary: dict):
        super().__init__(f"{summary['checks_passed']}/{summary['checks_total']} checks passed: {summary['details']}")
        self.summary = summary


def bronze_to_silver(
    raw: DataFrame,
    target: str,
    job_name: str = "bronze_to_silver",
    as_of: dt.datetime | None = None,
    order_by: Sequence[Column] | None = None,
    keep: Sequence[str] = (),
    partition_by: Sequence[str] = ("region",),
    table: str | None = None,
    mode: str = "overwrite",
    run_date: dt.date | None = None,
) -> dict:
    """Clean and write the statistics in one pass over ``raw``; nothing is written for
    no input.

    ``mode="merge"`` keeps what is there: the rows are merged by key into the partitions they
    touch, which must be part of the key, and ``keep`` columns stay in the table, because later
    runs are ordered against them. ``overwrite`` replaces the partitions that occur in ``raw``.
    ``run_date`` is the day API rows trend on. Returns ``rows_read`` and ``rows_written``. ``rows_read`` is a log
    figure: it is observed before a shuffle, so a task that is run again after an
    executor is lost may count twice. ``rows_written`` is exact."""
    if raw.isEmpty():
        log.info("no new records to process")
        return {"rows_read": 0, "rows_written": 0}
    read = Observation(f"read-{uuid.uuid4().hex}")
    counted = raw.observe(read, F.count(F.lit(1)).alias("rows"))
    if mode == "merge":
        staging = f"{target.rstrip('/')}-merge"
        # What an interrupted run had merged is complete; it goes first.
        publish(raw.sparkSession, target, staging, partition_by, table=table)
        incoming = stamp(add_ratios(cleanse(to_canonical(counted, run_date, keep))), job_name, as_of)
        written = merge_latest(incoming, target, staging, order_by=order_by, partition_by=partition_by, table=table)
        return {"rows_read": read.get["rows"], "rows_written": written}
    silver = silver_statistics(counted, job_name, as_of, run_date, order_by=order_by, keep=keep)
    # Gathered by partition first, or every task would leave a file in every partition;
    # adaptive execution splits the large ones.
    written = write_partitioned(silver, target, partition_by, mode, table, rebalance=True)
    return {"rows_read": read.get["rows"], "rows_written": written}


def reference_to_silver(
    docs: DataFrame,
    target: str,
    as_of: dt.datetime | None = None,
    table: str | None = None,
    schema: StructType | None = None,
) -> DataFrame:
    """Write the newest usable document of each region, with every field its items have
    (``schema`` limits them); returns the ingest report."""
    parsed = materialise(parse_documents(docs), "reference")
    # Items are dealt by document and id: as they are, every task would leave a file in every region.
    overwrite_partitions(silver_reference(parsed, as_of, schema), target, table=table, rebalance=True)
    return ingest_report(parsed)


def quality_gate(
    spark: SparkSession, tables: Mapping[str, DataFrame | str], alert_path: str | None = None, **options
) -> dict:
    """Run the checks and return their summary. Raises ``QualityGateError`` unless all
    pass; failed checks are first written as JSON lines to ``alert_path``."""
    results = quality.run_checks(spark, tables, isolate=True, **options)
    found = quality.summary(results).first().asDict()
    if not found["quality_passed"]:
        if alert_path is not None:
            add_alerts(quality.alerts(results), alert_path)
        raise QualityGateError(found)
    return found


def add_alerts(alerts: DataFrame, path: str) -> None:
    """Append the alerts that are not there yet: a run that is repeated raises none twice."""
    if path_exists(alerts.sparkSession, path):
        told = alerts.sparkSession.read.schema("subject string, message string").json(path)
        alerts = alerts.join(told, ["subject", "message"], "left_anti")
    alerts.write.mode("append").json(path)


def silver_to_gold(
    silver: DataFrame,
    reference: DataFrame | None,
    root: str,
    as_of: dt.datetime | None = None,
    database: str | None = None,
) -> dict[str, int]:
    """Build and write the three gold tables; returns rows written per table.

    Each table scans only its columns of the silver Parquet; that is cheaper than
    keeping a 100 TB table's rows in executor storage between the three.
    """
    lookup = None if reference is None else build_lookup(reference)
    enriched = attach_category(silver, lookup)
    # Channel rows leave their range shuffle ordered by region; the other two are rebalanced.
    builders = {
        "trending_analytics": (gold.trending_analytics, True),
        "channel_analytics": (gold.channel_analytics, False),
        "category_analytics": (gold.category_analytics, True),
    }
    written = {}
    for name, (build, rebalance) in builders.items():
        rows = build(enriched)
        table = f"{database}.{name}" if database else None
        written[name] = write_partitioned(gold.stamp(rows, as_of), f"{root}/{name}", rebalance=rebalance, table=table)
        release(rows, "rank", "share")
    return written


def run(
    raw: DataFrame,
    reference_docs: DataFrame | None,
    root: str,
    job_name: str = "pipeline",
    as_of: dt.datetime | None = None,
    order_by: Sequence[Column] | None = None,
    keep: Sequence[str] = (),
    run_date: dt.date | None = None,
    mode: str = "merge",
    partition_by: Sequence[str] = MERGE_PARTITIONS,
    database: str | None = None,
    **checks,
) -> dict:
    """Raw statistics and reference documents to gold under ``root``. Gold is built only
    when every check on silver passes.

    ``raw`` may be one day or everything: by default it is merged into what earlier runs left,
    and running it again changes nothing; checks and gold
    read only the days of silver that changed. Where no rows have come yet, it ends without checks and gold.
    ``database`` registers the tables in the catalog. The
    report on reference documents is in the result (``reference``: how many failed, which required
    columns are missing) and under ``<root>/reports``; failed documents also become alerts.
    """
    spark = raw.sparkSession
    silver_path, reference_path = f"{root}/silver/statistics", f"{root}/silver/reference"
    name = lambda table: f"{database}.{table}" if database else None
    if database:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    statistics = bronze_to_silver(
        raw, silver_path, job_name, as_of, order_by, keep, partition_by, name("clean_statistics"), mode, run_date
    )
    report = {"statistics": statistics}
    by_days = mode == "merge" and set(partition_by) == set(gold.DAY)
    state = f"{root}/state"
    tables = {
        "clean_statistics": lambda: check_partitions(spark, silver_path, state, "clean_statistics", as_of=as_of, **checks)
        if by_days
        else read_table(spark, silver_path)
    }
    if reference_docs is not None:
        ingested = reference_to_silver(reference_docs, reference_path, as_of, name("clean_reference_data"))
        ingested.write.mode("overwrite").parquet(f"{root}/reports/reference")
        ingested = spark.read.schema(INGEST_REPORT).parquet(f"{root}/reports/reference")
        failed = ingested.where(F.col("error").isNotNull())
        found = ingested.agg(
            F.count(F.lit(1)).alias("documents"),
            F.count("error").alias("failed"),
            F.array_distinct(F.flatten(F.collect_set("missing_columns"))).alias("missing_columns"),
        )
        report["reference"] = found.first().asDict()
        if report["reference"]["failed"]:
            log.warning("%s reference documents failed", report["reference"]["failed"])
            add_alerts(report_alerts(failed), f"{root}/alerts")
        if report["reference"]["missing_columns"]:
            log.warning("reference items lack %s", report["reference"]["missing_columns"])
        tables["clean_reference_data"] = lambda: read_table(spark, reference_path)
    if not path_exists(spark, silver_path):
        log.info("no records yet: nothing to check or to build")
        return report | {"quality": None, "gold": {}}
    report["quality"] = quality_gate(spark, tables, f"{root}/alerts", as_of=as_of, **checks)
    reference = read_optional(spark, reference_path)
    if by_days:
        report["gold"] = update_gold(spark, silver_path, reference, root, as_of, database)
    else:
        report["gold"] = silver_to_gold(read_table(spark, silver_path), reference, f"{root}/gold", as_of, database)
    return report
