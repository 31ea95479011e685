"""Incremental file ingest (the "auto loader" of the pipelines) on Structured Streaming.

Files in a directory are read once each: the file-stream source records what
it has seen in the query checkpoint, so a re-run only picks up new files
(``trigger(availableNow=True)`` = process everything new, then stop).

JSON is read through the text source and parsed with ``from_json`` so that
every line keeps its provenance (``_metadata.file_path``) and values that do
not fit the schema land in ``_rescued_data`` (a JSON object of the offending
fields, or of the whole line if it cannot be parsed) instead of being lost;
CSV is read as text and cast for the same end.  All parsing runs in the JVM.
"""

from __future__ import annotations

import json
import threading
from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import ArrayType, DataType, MapType, StringType, StructField, StructType, VariantType

from quarry.sources import fs


def land_files(df: DataFrame, path: str, fmt: str = "json", n_files: int = 8,
               order_by: str | None = None, header: bool = True, mode: str = "overwrite") -> str:
    """Write ``df`` as ``n_files`` files, time-ordered when ``order_by`` is given.

    ``repartitionByRange`` puts consecutive ranges of ``order_by`` into
    consecutive files (sampled range bounds, no single-task sort), which is
    how a replayed feed is landed for a streaming test.  Other rows are dealt by
    ``deal``.
    """
    out = df.repartitionByRange(n_files, order_by).sortWithinPartitions(order_by) if order_by \
        else deal(df, n_files)
    # Keep microseconds: the default text timestamp formats stop at millis.
    w = (out.write.mode(mode)
         .option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
         .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
    if fmt == "csv":
        w.option("header", header).csv(path)
    elif fmt == "json":
        w.json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError(fmt)
    return path


def deal(df: DataFrame, n: int) -> DataFrame:
    """``df`` in ``n`` parts by a hash of whole rows.

    A round robin would first sort every input partition by all columns (so that a
    task that runs again deals alike), and spill what a large one holds.
    """
    keys = [f.name for f in df.schema.fields if not _unhashable(f.dataType)]
    return df.repartition(n, *[F.col(f"`{k}`") for k in keys]) if keys else df.repartition(n)


def _unhashable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return any(_unhashable(f.dataType) for f in kind.fields)
    return _unhashable(kind.elementType) if isinstance(kind, ArrayType) else isinstance(kind, (MapType, VariantType))


def infer_schema(spark: SparkSession, path: str, fmt: str = "json", infer_types: bool = True,
                 options: Mapping[str, str] | None = None) -> StructType:
    """Schema of all files now in ``path`` (one distributed batch read).

    A field that only one file has is found.  With ``infer_types=False`` every
    field is STRING, as a stream without column-type inference reads it.
    """
    r = spark.read.options(**(options or {}))
    if fmt == "json":
        return r.option("primitivesAsString", not infer_types).json(path).schema
    if fmt == "csv":
        r = r.option("header", (options or {}).get("header", True)).option("inferSchema", infer_types)
        return r.csv(path).schema
    return r.option("mergeSchema", True).format(fmt).load(path).schema


def apply_hints(schema: StructType, hints: str | Mapping[str, str | DataType]) -> StructType:
    """Override the types of named fields (``"time DOUBLE, id BIGINT"``)."""
    if isinstance(hints, str):
        hint_schema = StructType.fromDDL(hints)
        hints = {f.name: f.dataType for f in hint_schema.fields}
    parsed = {k: (StructType.fromDDL(f"x {v}").fields[0].dataType if isinstance(v, str) else v)
              for k, v in hints.items()}
    fields = [StructField(f.name, parsed.get(f.name, f.dataType), True) for f in schema.fields]
    names = {f.name for f in schema.fields}
    fields += [StructField(k, t, True) for k, t in parsed.items() if k not in names]
    return StructType(fields)


CORRUPT = "_corrupt_record"
NESTED = (StructType, ArrayType, MapType)


def _NOTHING() -> Column:  # noqa: N802
    return F.array().cast("array<struct<key: string, value: string>>")


def _step(path: Column, name: Column) -> Column:
    """The path of a field; a name that is no identifier is quoted, so that no two paths are alike."""
    return F.when(name.rlike("^[A-Za-z_][A-Za-z0-9_]*$"), F.concat(path, F.lit("."), name)).otherwise(
        F.concat(path, F.lit("["), F.to_json(F.array(name)), F.lit("]")))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _misfits(raw: Column, typed: Column, kind: DataType, path: Column) -> Column:
    """Entries ``(path, text)`` of what ``raw`` (VARIANT) holds and ``typed`` does not, over structs, arrays and maps.

    ``raw``, ``typed`` and ``path`` are named several times: bind what is dear to compute.
    """
    def entry(at: Column, value: Column) -> Column:
        return F.struct(at.alias("key"), F.coalesce(F.try_variant_get(value, "$", "string"), F.to_json(value)).alias("value"))

    def lost(value: Column, held: Column, at: Column) -> Column:
        # most values fit, so that is asked first
        return F.when(held.isNull() & value.isNotNull() & ~F.is_variant_null(value), entry(at, value))

    def present(entries: Column) -> Column:
        return F.filter(entries, lambda x: x.isNotNull())

    def below(kind_of: str, body) -> Column:
        return _let(F.try_variant_get(raw, "$", kind_of),
                    lambda x: F.when(x.isNotNull(), body(x)).otherwise(present(F.array(lost(raw, typed, path)))))

    if isinstance(kind, StructType):
        known = [f.name for f in kind.fields]
        plain = [f for f in kind.fields if not isinstance(f.dataType, NESTED)]

        def inside(fields: Column) -> Column:
            unknown = F.transform(F.filter(F.map_entries(fields), lambda e: ~e["key"].isin(known)),
                                  lambda e: entry(_step(path, e["key"]), e["value"]))
            misfits = [lost(fields[f.name], typed[f.name], _step(path, F.lit(f.name))) for f in plain]
            return F.flatten(F.array(unknown, *([present(F.array(*misfits))] if plain else []),
                                     *[field(fields, f) for f in kind.fields if f not in plain]))

        def field(fields: Column, f: StructField) -> Column:
            return _let(fields[f.name], lambda x: _misfits(x, typed[f.name], f.dataType, _step(path, F.lit(f.name))))

        return below("map<string,variant>", inside)
    if isinstance(kind, ArrayType):
        return below("array<variant>", lambda items: F.flatten(F.transform(items, lambda x, i: _misfits(
            x, F.get(typed, i), kind.elementType, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))))
    if isinstance(kind, MapType):
        return below("map<string,variant>", lambda fields: F.flatten(F.transform(F.map_entries(fields), lambda e: _misfits(
            e["value"], F.try_element_at(typed, e["key"]), kind.valueType, _step(path, e["key"])))))
    return present(F.array(lost(raw, typed, path)))


def rescued_column(raw: Column, typed: Column, schema: StructType) -> Column:
    """JSON object of fields that are unknown to ``schema`` or do not fit its type.

    ``typed`` is the line already parsed with ``schema``; the line is parsed
    once more as ``map<string,string>``.  A key is rescued when it is not a
    schema field, or when its raw value is non-null but the typed value came
    out NULL.  Below a field that did parse, its value as VARIANT is compared
    with the typed one, and what does not fit or is unknown is rescued by its
    path (``items[0].qty``).  A line that is no JSON object is rescued whole,
    under ``_corrupt_record``.  NULL when nothing was rescued (or the line is
    blank).  Each way of parsing reads a line once, and a line all of whose keys
    came out typed, without nested values, is not parsed again.
    """
    known = [f.name for f in schema.fields]
    deep = [f for f in schema.fields if isinstance(f.dataType, NESTED)]

    def field(whole: Column, f: StructField) -> Column:
        return F.when(typed[f.name].isNotNull(), _let(whole[f.name], lambda x: _misfits(x, typed[f.name], f.dataType, F.lit(f.name)))
                      ).otherwise(_NOTHING())

    def bad_of(as_map: Column) -> Column:
        unknown = F.map_filter(as_map, lambda k, v: ~k.isin(known))
        misfits = F.filter(F.array(*[
            F.when(typed[f.name].isNull() & as_map[f.name].isNotNull(),
                   F.struct(F.lit(f.name).alias("key"), as_map[f.name].alias("value")))
            for f in schema.fields]), lambda x: x.isNotNull())
        bad = F.map_concat(F.map_from_entries(misfits), unknown)
        if not deep:
            return bad
        # a value that is written as it was read has lost nothing
        changed = reduce(or_, [typed[f.name].isNotNull() & ~F.coalesce(F.to_json(typed[f.name]) == as_map[f.name], F.lit(False)) for f in deep])
        below = F.when(changed, _let(F.try_variant_get(F.try_parse_json(raw), "$", "map<string,variant>"),
                                     lambda whole: F.flatten(F.array(*[field(whole, f) for f in deep])))).otherwise(_NOTHING())
        # a top-level key may be spelled like a path
        return F.map_concat(bad, F.map_from_entries(F.filter(below, lambda e: ~F.coalesce(F.map_contains_key(as_map, e["key"]), F.lit(False)))))

    def rescued(as_map: Column) -> Column:
        return (F.when(as_map.isNull() & (F.trim(raw) != ""), F.to_json(F.struct(raw.alias(CORRUPT))))
                .when(as_map.isNotNull(), _let(bad_of(as_map), lambda bad: F.when(F.size(bad) > 0, F.to_json(bad)))))

    found = _let(F.from_json(raw, "map<string,string>"), rescued)
    if deep or _parser_made(known):
        return found
    # As many keys as typed values: each key is known, comes once and fits.  NULL (no JSON object) is not as many.
    held = reduce(add, [typed[n].isNotNull().cast("int") for n in known], F.lit(0))
    return F.when(~F.coalesce(F.size(F.json_object_keys(raw)) == held, F.lit(False)), found)


def _parser_made(names: Sequence[str]) -> bool:
    """Whether the parser itself fills one of the fields, which then says nothing about the line's keys."""
    return SparkSession.active().conf.get("spark.sql.columnNameOfCorruptRecord") in names


def read_json_stream(spark: SparkSession, path: str, schema: StructType, rescue: bool = True,
                     max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream JSON lines from ``path`` with a fixed schema, provenance and rescue."""
    r = spark.readStream.format("text")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = r.load(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    parsed = lines.select("value", F.from_json("value", schema).alias("j"), "source_file")
    if not rescue:
        return parsed.select("j.*", "source_file")
    return parsed.select("j.*", "source_file",
                         rescued_column(F.col("value"), F.col("j"), schema).alias("_rescued_data"))


def read_csv_stream(spark: SparkSession, path: str, schema: StructType, header: bool = True, rescue: bool = False,
                    max_files_per_trigger: int | None = None, sep: str = ",") -> DataFrame:
    """Stream CSV files with a fixed schema, provenance and (optionally) rescue.

    With ``rescue`` the fields are read as text and cast: a value that does
    not fit its type goes to ``_rescued_data`` by name, and a line with too many
    or too few fields goes there whole, under ``_corrupt_record``.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema.fields] + [StructField(CORRUPT, StringType())])
    r = spark.readStream.schema(text if rescue else schema).option("header", header).option("sep", sep)
    if rescue:
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.csv(path)
    source = F.col("_metadata.file_path").alias("source_file")
    if not rescue:
        return df.select("*", source)
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in schema.fields}
    entry = lambda name, value: F.struct(F.lit(name).alias("key"), value.alias("value"))
    bad = F.filter(F.array(
        *[F.when(typed[f.name].isNull() & F.col(f"`{f.name}`").isNotNull(), entry(f.name, F.col(f"`{f.name}`"))) for f in schema.fields],
        F.when(F.col(CORRUPT).isNotNull(), entry(CORRUPT, F.col(CORRUPT)))), lambda x: x.isNotNull())
    return df.select(*[c.alias(n) for n, c in typed.items()], source,
                     F.when(F.size(bad) > 0, F.to_json(F.map_from_entries(bad))).alias("_rescued_data"))


def cloud_files(spark: SparkSession, path: str, fmt: str = "json", infer_types: bool = True,
                schema: StructType | str | None = None, schema_hints: str | None = None,
                rescue: bool = True, max_files_per_trigger: int | None = None,
                options: Mapping[str, str] | None = None, schema_location: str | None = None) -> DataFrame:
    """``cloud_files(path, fmt, options)``: a bronze stream with provenance columns.

    Adds ``processing_time`` (load time) and ``source_file``.  The schema is
    the last one stored at ``schema_location``; else declared, or inferred from
    all files present (all STRING when ``infer_types`` is off), then adjusted by
    ``schema_hints``, and stored there.  So a restart reads no landed file for
    its schema.
    """
    stored = stored_schema(spark, schema_location) if schema_location else None
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if stored is not None:
        schema = stored
    elif schema is None:
        schema = infer_schema(spark, path, fmt, infer_types, options=options)
    if schema_hints:
        schema = apply_hints(schema, schema_hints)
    if schema_location and schema != stored:
        store_schema(spark, schema_location, schema)
    if fmt == "json":
        df = read_json_stream(spark, path, schema, rescue, max_files_per_trigger)
    elif fmt == "csv":
        df = read_csv_stream(spark, path, schema, (options or {}).get("header", True), rescue,
                             max_files_per_trigger)
    else:
        r = spark.readStream.schema(schema).format(fmt)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.load(path).select("*", F.col("_metadata.file_path").alias("source_file"))
    return df.select(F.current_timestamp().alias("processing_time"), "*")


# ---- schemas that are stored and grow ------------------------------------------

def _schema_numbers(spark: SparkSession, location: str) -> list[int]:
    return sorted(int(n.removesuffix(".json")) for n in fs.list_names(spark, location) if n.endswith(".json") and not n.startswith("_"))


def stored_schema(spark: SparkSession, location: str) -> StructType | None:
    """The last schema stored at ``location``; None before the first."""
    numbers = _schema_numbers(spark, location)
    return StructType.fromJson(json.loads(fs.read_text(spark, f"{location}/{numbers[-1]}.json"))) if numbers else None


def store_schema(spark: SparkSession, location: str, schema: StructType) -> None:
    """Store ``schema`` as the next one; earlier ones stay as a history."""
    numbers = _schema_numbers(spark, location)
    fs.write_text(spark, f"{location}/{numbers[-1] + 1 if numbers else 0}.json", schema.json())


def evolve_schema(spark: SparkSession, location: str, batch: DataFrame) -> list[str]:
    """Extend the stored schema by the fields that ``batch`` rescued and it does not know.

    New fields become STRING columns (the type any value fits; hints say
    more).  Misfits of known fields and fields inside nested values stay
    rescued.  Field names reach the driver, as those of a schema do.
    """
    schema = stored_schema(spark, location)
    keys = batch.select(F.explode(F.map_keys(F.from_json("_rescued_data", "map<string,string>"))).alias("k")).distinct()
    known = {f.name for f in schema.fields} | {CORRUPT}
    deep = tuple(f"{f.name}{c}" for f in schema.fields if isinstance(f.dataType, (StructType, ArrayType, MapType)) for c in ".[")
    new = sorted(r["k"] for r in keys.collect() if r["k"] not in known and not (deep and r["k"].startswith(deep)))
    if new:
        store_schema(spark, location, StructType([*schema.fields, *[StructField(k, StringType(), True) for k in new]]))
    return new


def run_evolving(spark: SparkSession, path: str, sink: str, schema_location: str, checkpoint: str, fmt: str = "json",
                 **reader) -> list[str]:
    """Load all new files into ``sink`` and extend the stored schema by what was rescued; the new fields.

    The schema of a run is fixed at its start, so a new field is rescued in
    the run that meets it and a column from the next run on.  A batch writes
    its own folder, so a batch that runs again replaces its rows.
    """
    stream = cloud_files(spark, path, fmt, schema_location=schema_location, **reader)
    added: list[str] = []

    def write(batch: DataFrame, batch_id: int) -> None:
        out = f"{sink}/batch={batch_id}"
        batch.write.mode("overwrite").parquet(out)
        added.extend(evolve_schema(spark, schema_location, spark.read.parquet(out)))

    run_foreach_batch(stream, write, checkpoint)
    return added


def read_evolved(spark: SparkSession, sink: str) -> DataFrame:
    """All batches of ``run_evolving``; columns a batch did not know are NULL."""
    return spark.read.option("mergeSchema", True).parquet(sink).drop("batch")


def all_strings(schema: StructType) -> StructType:
    return StructType([StructField(f.name, StringType(), True) for f in schema.fields])


class Progress(StreamingQueryListener):
    """Every micro-batch of the queries it hears (``recentProgress`` keeps only the last ones)."""

    def __init__(self) -> None:
        self.batches: dict[str, dict[int, object]] = {}
        self._ended: dict[str, threading.Event] = {}

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:  # noqa: N802
        pass

    def onQueryProgress(self, event) -> None:  # noqa: N802
        p = event.progress
        self.batches.setdefault(str(p.runId), {})[p.batchId] = p

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self._end(str(event.runId)).set()

    def of(self, q: StreamingQuery) -> list:
        """All progress of an ended query, in order; waits for the last event."""
        if not self._end(str(q.runId)).wait(300):
            raise TimeoutError(f"no end event of query {q.runId}")
        return [p for _, p in sorted(self.batches.get(str(q.runId), {}).items())]


@contextmanager
def _session_conf(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """The session with ``conf`` for as long as the block runs."""
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def run_available_now(df: DataFrame, sink_path: str, checkpoint: str, fmt: str = "parquet", output_mode: str = "append",
                      partition_by: Sequence[str] = (), conf: Mapping[str, str] | None = None) -> list:
    """Process all available input, write it to ``sink_path``, stop; the progress of every micro-batch.

    The query starts with the session's settings and ``conf``; the session keeps its own.
    """
    w = (df.writeStream.format(fmt).outputMode(output_mode)
           .option("checkpointLocation", checkpoint).option("path", sink_path)
           .trigger(availableNow=True))
    if partition_by:
        w = w.partitionBy(*partition_by)
    streams, heard = df.sparkSession.streams, Progress()
    streams.addListener(heard)
    try:
        with _session_conf(df.sparkSession, conf or {}):
            q = w.start()
        q.awaitTermination()
        return heard.of(q)
    finally:
        streams.removeListener(heard)


def run_foreach_batch(df: DataFrame, fn, checkpoint: str, output_mode: str = "append",
                      available_now: bool = True) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` per micro-batch until the input is drained."""
    w = df.writeStream.foreachBatch(fn).outputMode(output_mode).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 second")
    q = w.start()
    if available_now:
        q.awaitTermination()
    else:
        q.processAllAvailable()
        q.stop()
    return q


def copy_into(spark: SparkSession, target_path: str, source_path: str, schema: StructType | str,
              fmt: str = "json", checkpoint: str | None = None) -> int:
    """COPY INTO: append the rows of files not loaded before (idempotent on re-run).

    A triggered file stream into a parquet sink: the source checkpoint
    remembers which files were read, and the file sink's own commit log makes
    each micro-batch land exactly once, so a re-run after a failure neither
    loses nor duplicates rows.  Returns the number of rows appended.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    checkpoint = checkpoint or f"{target_path.rstrip('/')}_checkpoint"
    stream = spark.readStream.schema(schema).format(fmt).load(source_path)
    return sum(p.numInputRows or 0 for p in run_available_now(stream, target_path, checkpoint))
