"""Reshaping: JSON parsing, explode, array histories, pivots."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def decode_envelope(raw: DataFrame) -> DataFrame:
    """Message-bus record: BINARY key/value -> STRING key/value."""
    return raw.select(F.col("key").cast("string").alias("key"),
                      F.col("value").cast("string").alias("value"),
                      *[c for c in raw.columns if c not in ("key", "value")])


def parse_json_value(raw: DataFrame, schema: StructType | str,
                     column: str = "value") -> DataFrame:
    """Parse a JSON text/binary column with a declared schema; fields become columns.

    Keeps the other envelope columns (``offset`` etc.) next to the parsed
    fields.  A declared schema avoids the extra inference pass over the data.
    """
    text = F.col(column).cast("string")
    keep = [c for c in raw.columns if c not in (column, "key")]
    return (raw.select(*keep, F.from_json(text, schema).alias("json"))
               .select(*keep, "json.*"))


def infer_json_schema(df: DataFrame, column: str = "value") -> str:
    """DDL that fits every JSON value of a column: one distributed aggregate, the types merged.

    Values that are no JSON are left out of the schema (and parse to NULL).
    """
    v = F.try_parse_json(F.col(column).cast("string"))
    found = df.agg(F.schema_of_variant_agg(v).alias("s")).first()["s"]
    if found is None or found == "VOID":
        raise ValueError("no JSON value to infer from")
    return _column_type(found)


def _column_type(variant_type: str) -> str:
    """The column type that holds a VARIANT type: OBJECT as STRUCT, VOID (only nulls seen) as STRING.

    Field names are kept, whatever they are called.
    """
    out, i = [], 0
    while i < len(variant_type):
        name = re.match(r"`(?:[^`]|``)*`\s*:|[^\s<>,:`]+\s*:", variant_type[i:])
        if name:  # a field name up to its colon
            out.append(name[0])
            i += len(name[0])
            continue
        word = re.match(r"[A-Z_]+", variant_type[i:])
        out.append({"OBJECT": "STRUCT", "VOID": "STRING"}.get(word[0], word[0]) if word else variant_type[i])
        i += len(word[0]) if word else 1
    return "".join(out)


def explode_items(df: DataFrame, column: str = "items", alias: str = "item") -> DataFrame:
    """One row per array element (empty/NULL arrays give no rows)."""
    return df.withColumn(alias, F.explode(column))


def event_and_cart_history(events: DataFrame, key: str = "user_id") -> DataFrame:
    """Per user: distinct event names and distinct cart item ids.

    (user, kind, value) triples are made distinct first, across all tasks, so
    a user's list holds each value once and no array of arrays is gathered.
    """
    names = events.select(key, F.lit("event").alias("kind"), F.col("event_name").alias("value"))
    ids = events.select(key, F.lit("item").alias("kind"), F.explode("items.item_id").alias("value"))
    listed = lambda kind: F.array_join(F.sort_array(F.collect_list(
        F.when(F.col("kind") == kind, F.col("value")))), ",")
    return (names.unionByName(ids).distinct().groupBy(key)
            .agg(listed("event").alias("event_history"), listed("item").alias("cart_history")))


def pivot_sum(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence,
              measure: str) -> DataFrame:
    """One column per listed pivot value, ``sum(measure)``; absent cells NULL.

    A conditional sum per value is one aggregation and one shuffle; ``pivot``
    would aggregate (and shuffle) twice.
    """
    return df.groupBy(*keys).agg(*[F.sum(F.when(F.col(pivot_col) == v, F.col(measure))).alias(str(v)) for v in values])


def pivot_count(df: DataFrame, keys: Sequence[str], pivot_col: str, values: Sequence | None = None) -> DataFrame:
    """One column per pivot value, row counts, absent cells NULL; values discovered when not given."""
    if values is None:
        return df.groupBy(*keys).pivot(pivot_col).count()
    return df.groupBy(*keys).agg(*[
        F.nullif(F.count(F.when(F.col(pivot_col) == v, 1)), F.lit(0)).alias(str(v)) for v in values])
