"""Expectations on a stream, with quality counts that outlive the driver.

Every micro-batch is written to a folder of its own with the names of the
rules each row breaks, dropped rows included, and its counts are then taken
from what was written and stored under (dataset, batch).  A batch that runs
again after a crash replaces its rows and its counts, so neither is lost nor
counted twice, whatever the driver remembers.

Defined results: a rule whose value is NULL is broken; an empty batch has
counts of zero; a violated ``fail`` rule stops the batch before anything of it
can be read; columns of the stream may not be called ``__broken`` or ``__kept``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import quality
from quarry.streaming import ingest

COUNTS = "expectation string, action string, passing_records bigint, failing_records bigint, dataset string, batch bigint"


def write_batch(batch: DataFrame, batch_id: int, dataset: str, rules: Sequence[quality.Rule], root: str) -> None:
    """Write one micro-batch and its counts, in place of an earlier attempt at it."""
    broken = F.array_compact(F.array(*[F.when(~r.passed, F.lit(r.name)) for r in rules])) if rules \
        else F.array().cast("array<string>")
    drops = [r.name for r in rules if r.action == "drop"]
    kept = ~F.arrays_overlap("__broken", F.array(*map(F.lit, drops))) if drops else F.lit(True)
    out = f"{root}/tables/{dataset}/batch={batch_id}"
    (quality.apply(batch, [r for r in rules if r.action == "fail"])
     .withColumn("__broken", broken).withColumn("__kept", kept).write.mode("overwrite").parquet(out))
    if not rules:
        return
    # from the written rows, so a task that ran twice counts once; one column is read
    spark = batch.sparkSession
    one = (spark.read.schema("__broken array<string>").parquet(out)
           .agg(F.count(F.lit(1)).alias("n"), *[F.count_if(F.array_contains("__broken", r.name)).alias(f"f{i}")
                                                for i, r in enumerate(rules)]))
    per_rule = F.array(*[F.struct(F.lit(r.name).alias("expectation"), F.lit(r.action).alias("action"),
                                  (F.col("n") - F.col(f"f{i}")).alias("passing_records"),
                                  F.col(f"f{i}").alias("failing_records")) for i, r in enumerate(rules)])
    (one.select(F.explode(per_rule).alias("x")).select("x.*")
     .write.mode("overwrite").parquet(f"{root}/counts/dataset={dataset}/batch={batch_id}"))


def load(stream: DataFrame, dataset: str, rules: Sequence[quality.Rule], root: str) -> None:
    """Run ``stream`` until its input is drained, into the table ``dataset`` below ``root``."""
    ingest.run_foreach_batch(stream, lambda b, i: write_batch(b, i, dataset, rules, root), f"{root}/checkpoints/{dataset}")


def read(spark: SparkSession, dataset: str, root: str) -> DataFrame:
    """The rows that no ``drop`` rule removed."""
    return spark.read.parquet(f"{root}/tables/{dataset}").where("__kept").drop("__kept", "__broken", "batch")


def dropped(spark: SparkSession, dataset: str, root: str) -> DataFrame:
    """The removed rows, with the names of the rules they break (``broken``)."""
    return spark.read.parquet(f"{root}/tables/{dataset}").where("NOT __kept").withColumnRenamed("__broken", "broken").drop("__kept", "batch")


def metrics(spark: SparkSession, root: str, since: int = 0) -> DataFrame:
    """Passing and failing records per dataset and rule, over the batches from ``since`` on."""
    return (spark.read.schema(COUNTS).parquet(f"{root}/counts").where(F.col("batch") >= since)
            .groupBy("dataset", "expectation")
            .agg(F.sum("passing_records").alias("passing_records"), F.sum("failing_records").alias("failing_records")))
