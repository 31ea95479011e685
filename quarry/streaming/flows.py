"""A declarative dataset registry: named tables and views run in dependency order.

This is a user-level job runner, not a planner: each dataset is a Python
function returning a DataFrame; the registry orders them by their declared
inputs, materialises them, applies expectations, and appends event-log rows
(create_update, flow_definition, flow_progress with quality metrics,
user_action) that the observability queries read.

Kinds:
* ``streaming`` table: the function returns a streaming DataFrame; it is
  written with ``trigger(availableNow=True)`` to a parquet sink with its own
  checkpoint, so each input file is read once across runs.
* ``live`` table (materialised view): batch recompute, overwritten each run.
* ``view``: a temp DataFrame inside the run, never persisted.
* ``apply_changes`` target: CDC applied by ``quarry.streaming.cdc``; it is
  updated in place, so downstream datasets may read it only as a batch table.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quarry.operators import quality
from quarry.streaming import cdc, ingest

EVENT_LOG_SCHEMA = ("id string, timestamp timestamp_ntz, event_type string, "
                    "origin struct<update_id:string, flow_name:string, pipeline_name:string>, details string")


@dataclass
class Dataset:
    name: str
    kind: str                       # streaming | live | view | apply_changes
    fn: Callable | None
    inputs: tuple[str, ...]
    expectations: tuple[quality.Rule, ...] = ()
    comment: str | None = None
    cdc: dict = field(default_factory=dict)


class FlowError(RuntimeError):
    pass


def keep_latest(spark: SparkSession, aggregate: DataFrame, root: str, keys: Sequence[str], checkpoint: str) -> None:
    """Run a streaming aggregate in update mode into the newest row per key.

    A micro-batch rewrites only the buckets of the keys it changed, and a
    replayed one replaces its own version; the aggregate's state is bounded by
    its watermark, not by the table.
    """
    def batch_fn(b: DataFrame, i: int) -> None:
        marked = b.withColumn("__batch", F.lit(i)).withColumn(cdc.DELETED, F.lit(False))
        cdc.write_batch(spark, root, marked, f"{checkpoint}#{i}", keys, "__batch")

    ingest.run_foreach_batch(aggregate, batch_fn, checkpoint, output_mode="update")


class FlowGraph:
    """Register datasets with decorators, then ``run()`` an update."""

    def __init__(self, spark: SparkSession, root: str, name: str = "flows", user: str = "flow-user"):
        self.spark, self.root, self.name, self.user = spark, root.rstrip("/"), name, user
        self.datasets: dict[str, Dataset] = {}
        self._views: dict[str, DataFrame] = {}
        self._schemas: dict = {}      # sink schema of each materialised streaming table

    # ---- declaration ----------------------------------------------------
    def _add(self, ds: Dataset) -> None:
        if ds.name in self.datasets:
            raise FlowError(f"dataset {ds.name} declared twice")
        self.datasets[ds.name] = ds

    def table(self, name: str | None = None, inputs: Sequence[str] = (), streaming: bool = False,
              expectations: Sequence[quality.Rule] = (), comment: str | None = None,
              update_by: Sequence[str] = ()):
        """Declare a table; a streaming aggregate is kept by its keys ``update_by`` (update mode)."""
        def deco(fn):
            self._add(Dataset(name or fn.__name__, "aggregate" if update_by else "streaming" if streaming else "live",
                              fn, tuple(inputs), tuple(expectations), comment, cdc={"keys": list(update_by)}))
            return fn
        return deco

    def view(self, name: str | None = None, inputs: Sequence[str] = (),
             expectations: Sequence[quality.Rule] = ()):
        def deco(fn):
            self._add(Dataset(name or fn.__name__, "view", fn, tuple(inputs), tuple(expectations)))
            return fn
        return deco

    def apply_changes(self, target: str, source: str, keys: Sequence[str], sequence_by: str,
                      delete_when: str, except_columns: Sequence[str] = ()) -> None:
        self._add(Dataset(target, "apply_changes", None, (source,),
                          cdc={"keys": list(keys), "sequence_by": sequence_by, "delete_when": delete_when,
                               "except_columns": list(except_columns)}))

    # ---- reading datasets inside functions ------------------------------------------
    def path(self, name: str) -> str:
        return f"{self.root}/tables/{name}"

    def read(self, name: str) -> DataFrame:
        """Batch read of a dataset (the ``LIVE.name`` of a live table)."""
        ds = self.datasets.get(name)
        if ds is None:
            raise FlowError(f"unknown dataset {name}")
        if ds.kind == "view":
            return self._views[name]
        if ds.kind == "apply_changes":
            return cdc.read_target(self.spark, self.path(name))
        if ds.kind == "aggregate":
            return cdc.read_target(self.spark, self.path(name), ["__batch"])
        return self.spark.read.parquet(self.path(name))

    def read_stream(self, name: str) -> DataFrame:
        """Streaming read of a streaming table (``STREAM(LIVE.name)``)."""
        ds = self.datasets.get(name)
        if ds is None:
            raise FlowError(f"unknown dataset {name}")
        if ds.kind == "apply_changes":
            raise FlowError(f"{name} is updated in place by APPLY CHANGES; read it as a batch table")
        if ds.kind == "view":
            v = self._views[name]
            if not v.isStreaming:
                raise FlowError(f"view {name} is not streaming")
            return v
        if ds.kind != "streaming":
            raise FlowError(f"{name} is a live table; read it with read()")
        schema = self._schemas.get(name) or self.spark.read.parquet(self.path(name)).schema
        return self.spark.readStream.schema(schema).parquet(self.path(name))

    # ---- execution --------------------------------------------------------
    def order(self) -> list[str]:
        """Dependency order of the declared datasets (inputs first)."""
        done: list[str] = []
        visiting: set[str] = set()

        def visit(n: str) -> None:
            if n in done:
                return
            if n in visiting:
                raise FlowError(f"cycle through {n}")
            if n not in self.datasets:
                raise FlowError(f"dataset {n} is read but never declared")
            visiting.add(n)
            for i in self.datasets[n].inputs:
                visit(i)
            visiting.discard(n)
            done.append(n)

        for n in self.datasets:
            visit(n)
        return done

    def run(self) -> str:
        """One triggered update: every dataset in order; returns the update id."""
        update_id = uuid.uuid4().hex
        events = [self._event(update_id, "create_update", None, {"create_update": {"cause": "USER_ACTION"}}),
                  self._event(update_id, "user_action", None,
                              {"user_action": {"action": "START", "user_name": self.user}})]
        for name in self.order():
            ds = self.datasets[name]
            events.append(self._event(update_id, "flow_definition", name, {"flow_definition": {
                "output_dataset": name, "input_datasets": list(ds.inputs), "flow_type": ds.kind}}))
            t0 = time.perf_counter()
            metrics = self._materialise(ds)
            seconds = round(time.perf_counter() - t0, 3)
            progress = {"status": "COMPLETED", "seconds": seconds}
            if metrics is not None:
                progress["data_quality"] = {"expectations": metrics}
            events.append(self._event(update_id, "flow_progress", name, {"flow_progress": progress}))
        self._write_events(events)
        return update_id

    def _materialise(self, ds: Dataset) -> list[dict] | None:
        spark = self.spark
        ckpt = f"{self.root}/checkpoints/{ds.name}"
        if ds.kind == "apply_changes":
            src = self.read_stream(ds.inputs[0])
            c = ds.cdc
            cdc.apply_changes(spark, src, self.path(ds.name), c["keys"], c["sequence_by"], c["delete_when"],
                              c["except_columns"], checkpoint=ckpt)
            return []
        df = ds.fn(self)
        rules = ds.expectations
        if ds.kind == "view":
            self._views[ds.name] = quality.apply(df, rules)
            if rules and not df.isStreaming:
                rows = (quality.metrics(df, rules, ds.name)
                        .select("name", "dataset", "passed_records", "failed_records").collect())
                return [r.asDict() for r in rows]
            return None
        if ds.kind == "live":
            obs = Observation(f"dq_{ds.name}") if rules else None
            out = quality.apply(df, rules, obs)
            out.write.mode("overwrite").parquet(self.path(ds.name))
            return quality.observed_metrics(obs, rules, ds.name) if obs else []
        # streaming table
        obs_name = f"dq_{ds.name}"
        out = df
        if rules:
            aggs = []
            for r in rules:
                aggs += [F.count_if(r.passed).alias(f"{r.name}_passed"),
                         F.count_if(~r.passed).alias(f"{r.name}_failed")]
            out = out.observe(obs_name, *aggs)
        out = quality.apply(out, rules)
        self._schemas[ds.name] = out.schema
        if ds.kind == "aggregate":
            keep_latest(spark, out, self.path(ds.name), ds.cdc["keys"], ckpt)
            return []
        batches = ingest.run_available_now(out, self.path(ds.name), ckpt)
        totals = {f"{r.name}_{k}": 0 for r in rules for k in ("passed", "failed")}
        for p in batches:
            got = (p.observedMetrics or {}).get(obs_name)
            for k in totals if got is not None else ():
                totals[k] += int(got[k] or 0)
        return [{"name": r.name, "dataset": ds.name, "passed_records": totals[f"{r.name}_passed"],
                 "failed_records": totals[f"{r.name}_failed"]} for r in rules]

    def _event(self, update_id: str, event_type: str, flow: str | None, details: dict) -> tuple:
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        return (uuid.uuid4().hex, now, event_type, (update_id, flow, self.name), json.dumps(details))

    def _write_events(self, rows: list[tuple]) -> None:
        (self.spark.createDataFrame(rows, EVENT_LOG_SCHEMA).coalesce(1)
         .write.mode("append").parquet(self.event_log_path))

    @property
    def event_log_path(self) -> str:
        return f"{self.root}/system/events"

    def event_log(self) -> DataFrame:
        return self.spark.read.parquet(self.event_log_path)
