"""Queries over the flow event log: quality metrics and the latest run.

The event log is a table with a JSON ``details`` text column; fields are
reached with ``get_json_object`` and typed arrays with ``from_json``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

EXPECTATIONS_TYPE = "array<struct<name: string, dataset: string, passed_records: bigint, failed_records: bigint>>"


def latest_update_id(event_log: DataFrame) -> DataFrame:
    """One row: the update id of the newest ``create_update`` event (max_by, no sort)."""
    return (event_log.where(F.col("event_type") == "create_update")
            .agg(F.max_by(F.col("origin.update_id"), F.col("timestamp")).alias("update_id")))


def expectation_metrics(event_log: DataFrame, update_id: str | None = None) -> DataFrame:
    """Passing / failing records per dataset and expectation, summed over one update (the latest by default)."""
    log = event_log.where(F.col("event_type") == "flow_progress")
    if update_id is None:
        log = log.join(latest_update_id(event_log), F.col("origin.update_id") == F.col("update_id"), "left_semi")
    else:
        log = log.where(F.col("origin.update_id") == update_id)
    exp = F.from_json(F.get_json_object("details", "$.flow_progress.data_quality.expectations"), EXPECTATIONS_TYPE)
    rows = log.select(F.explode(exp).alias("e"))
    return (rows.groupBy(F.col("e.dataset").alias("dataset"), F.col("e.name").alias("expectation"))
            .agg(F.sum("e.passed_records").alias("passing_records"),
                 F.sum("e.failed_records").alias("failing_records")))
