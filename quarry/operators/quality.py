"""Data-quality expectations: warn, drop or fail, with per-rule metrics.

An expectation is a SQL predicate.  Its result is three-valued; UNKNOWN (a
NULL comparison) counts as a violation for all three actions, so
``email RLIKE ..`` on a NULL email fails the rule.  Write ``.. OR
operation = 'DELETE'`` to let CDC delete rows pass, as the pipeline lesson
does.

Metrics are computed in the same plan as the data (``DataFrame.observe``),
counted before any row is dropped, and reach the driver as one small row per
action; no extra pass over the data is needed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Rule:
    """``CONSTRAINT name EXPECT (expr) [ON VIOLATION DROP ROW | FAIL UPDATE]``."""
    name: str
    expr: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}")

    @property
    def passed(self) -> Column:
        return F.coalesce(F.expr(self.expr), F.lit(False))


def _fail_guard(rules: Sequence[Rule]) -> Column:
    """TRUE for passing rows; ``raise_error`` naming the first violated rule otherwise."""
    guard = F.lit(True)
    for r in reversed(list(rules)):
        msg = F.lit(f"expectation '{r.name}' violated: {r.expr}")
        guard = F.when(~r.passed, F.raise_error(msg).cast("boolean")).otherwise(guard)
    return guard


def apply(df: DataFrame, rules: Sequence[Rule], observation: Observation | None = None) -> DataFrame:
    """Apply expectations to ``df`` (batch or streaming) in one pass.

    * warn: rows kept, violations counted;
    * drop: violating rows removed (counted);
    * fail: the job aborts on the first violating row (a ``raise_error``
      inside a filter, so column pruning cannot skip it).

    If ``observation`` is given, ``<rule>_passed`` / ``<rule>_failed`` counts
    are attached to it (available after the first action).
    """
    out = df
    if observation is not None and rules:
        aggs = []
        for r in rules:
            aggs += [F.count_if(r.passed).alias(f"{r.name}_passed"),
                     F.count_if(~r.passed).alias(f"{r.name}_failed")]
        out = out.observe(observation, *aggs)
    fails = [r for r in rules if r.action == "fail"]
    if fails:
        out = out.where(_fail_guard(fails))
    drops = [r.passed for r in rules if r.action == "drop"]
    if drops:
        out = out.where(reduce(lambda a, b: a & b, drops))
    return out


def expect(df: DataFrame, rules: Sequence[Rule], name: str = "expectations") -> tuple[DataFrame, Observation]:
    """``expect(df, rules) -> (df', metrics)``: apply rules; counts arrive with the first action.

    ``observed_metrics(obs, rules)`` turns the observation into one dict per rule.
    """
    obs = Observation(name)
    return apply(df, rules, obs), obs


def metrics(df: DataFrame, rules: Sequence[Rule], dataset: str | None = None) -> DataFrame:
    """Per-rule pass/fail counts as a DataFrame (one aggregation pass).

    Columns: dataset, name, action, passed_records, failed_records.  All
    rules are counted in a single aggregate row, which is then turned into
    one row per rule (explode of an array of structs), so the data is read
    once whatever the number of rules.
    """
    aggs = []
    for i, r in enumerate(rules):
        aggs += [F.count_if(r.passed).alias(f"p{i}"), F.count_if(~r.passed).alias(f"f{i}")]
    per_rule = F.array(*[
        F.struct(F.lit(dataset).cast("string").alias("dataset"), F.lit(r.name).alias("name"),
                 F.lit(r.action).alias("action"), F.col(f"p{i}").alias("passed_records"),
                 F.col(f"f{i}").alias("failed_records"))
        for i, r in enumerate(rules)])
    return df.agg(*aggs).select(F.explode(per_rule).alias("m")).select("m.*")


def observed_metrics(observation: Observation, rules: Sequence[Rule], dataset: str | None = None) -> list[dict]:
    """Observation result -> list of {name, dataset, passed_records, failed_records}."""
    got = observation.get
    return [{"name": r.name, "dataset": dataset, "action": r.action,
             "passed_records": int(got.get(f"{r.name}_passed", 0)),
             "failed_records": int(got.get(f"{r.name}_failed", 0))} for r in rules]


def checks_frame(spark, checks: Sequence[tuple[str, object, object]]) -> DataFrame:
    """Assertion results as rows: (check, expected, actual, passed).

    ``checks`` holds already computed small values (counts, column lists,
    type names); expected/actual are rendered as text.
    """
    rows = [(name, str(exp), str(act), exp == act) for name, exp, act in checks]
    return spark.createDataFrame(rows, "check string, expected string, actual string, passed boolean")


def table_checks(df: DataFrame, expected_rows: int | None = None, expected_columns: Sequence[str] | None = None,
                 expected_types: dict | None = None) -> list[tuple[str, object, object]]:
    """Row count, column set and field types of a table versus expectations."""
    out = []
    if expected_rows is not None:
        out.append(("row_count", expected_rows, df.count()))
    if expected_columns is not None:
        out.append(("columns", sorted(expected_columns), sorted(df.columns)))
    for col, typ in (expected_types or {}).items():
        out.append((f"type:{col}", typ, df.schema[col].dataType.simpleString() if col in df.columns else None))
    return out


def threshold_alert(df: DataFrame, value_col: str, threshold: float, key_cols: Sequence[str] = ()) -> DataFrame:
    """Rows with an ``alert`` flag where ``value_col`` exceeds ``threshold``."""
    return df.select(*key_cols, value_col, (F.col(value_col) > threshold).alias("alert"))
