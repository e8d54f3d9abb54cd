"""Incremental file ingest into an append-only table.

Each source file is taken once. New columns widen the table, columns that vanished are NULL, and
values that do not fit a column's type go to a rescue column instead of failing the run.

The stream carries file names, not rows: a Parquet stream needs one schema up front and fails on
type drift, whereas the files of a micro-batch can be read here per schema they were written with.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from itertools import repeat

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.operators.project import lead_columns
from lakestrata.sources import fs
from lakestrata.sources.tables import numbered, publish, published, resume

BATCH = "ingest_batch"
INGEST_TS = "ingest_ts"
SOURCE_FILE = "source_file"
SOURCE_TIME = "source_time"
SOURCE_ROW = "source_row"
RESCUED = "_rescued_data"
CONTROL = (INGEST_TS, SOURCE_FILE, SOURCE_TIME, SOURCE_ROW, RESCUED, BATCH)

# Spark's file source forgets, and would skip, files older than this next to the newest one.
MAX_FILE_AGE = "36500d"

_FILE_LIST = "path string, modificationTime timestamp, length long, content binary"
_SPARK_TYPES = "org.apache.spark.sql.parquet.row.metadata"
FOOTER_READERS = 32
_CONFLICTS = ("CANNOT_MERGE_", "CONFLICTING_PARTITION_COLUMN_NAMES", "CONFLICTING_DIRECTORY_STRUCTURES")


def ingest_files(
    spark: SparkSession,
    source: str,
    target: str,
    checkpoint: str,
    schema_store: str,
    lead: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    max_files: int = 10_000,
) -> None:
    """Take in every new Parquet file below ``source``, in batches of ``max_files``, then return.

    ``key=value`` folders become columns. ``lead`` puts columns first; ``sort_by`` sorts within
    files for min/max skipping. A rerun with no new files changes nothing, and a batch cut short
    is repeated as a whole. A late file is a new file whatever its age. Beside the ingest timestamp
    every row keeps its file, the file's time and its place in the file, which identify it for good.
    """
    require_checkpoint(spark, bool(numbered(spark, target, BATCH)), target, checkpoint)
    names = (
        spark.readStream.format("binaryFile")
        .schema(_FILE_LIST)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .option("maxFilesPerTrigger", max_files)
        .option("maxFileAge", MAX_FILE_AGE)
        .load(source)
        .select("path")
    )

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        if published(session, target, f"{BATCH}={number}"):
            return
        # file names only, at most max_files of them
        paths = sorted(row["path"] for row in batch.collect())
        if not paths:
            return
        _take(session, source, paths, target, schema_store, number, lead, sort_by)

    run_available(names, checkpoint, take)


def ingest_and_archive(
    spark: SparkSession,
    source: str,
    target: str,
    archive: str,
    schema_store: str,
    lead: Sequence[str] = (),
    sort_by: Sequence[str] = (),
    max_files: int = 10_000,
) -> None:
    """As ``ingest_files``, for landing folders that would grow for ever: files leave once they are taken.

    A batch's files are listed in ``target/_taken`` before they are read and moved to
    ``archive/ingest_batch=n`` after it is published, so neither the listing nor what must be
    remembered grows with the files ever taken: there is no checkpoint. A name that is delivered
    again is a new file. A run that is cut short is finished by the next one, which takes each file
    once: a batch that was not yet shown is taken anew from what lies in ``source`` then. Only one run
    at a time may feed a target, always by the same function; files must arrive whole
    (under a name with a leading dot or underscore they are not seen).
    """
    if max_files < 1:
        raise ValueError("max_files must be at least 1")
    taken = f"{target}/_taken"
    for name in fs.list_names(spark, taken):
        number = int(name.removesuffix(".json"))
        if resume(spark, target, f"{BATCH}={number}"):
            _archive(spark, source, archive, taken, number)
        else:
            fs.delete(spark, f"{taken}/{name}")
    number = max(numbered(spark, target, BATCH), default=-1) + 1
    found = {n: s for n, s in fs.stamps(spark, source).items() if n.endswith(".parquet") and not fs.hidden(n)}
    names = sorted(found)
    for start in range(0, len(names), max_files):
        batch = names[start : start + max_files]
        fs.write_text(spark, f"{taken}/{number}.json", json.dumps({n: found[n] for n in batch}))
        _take(spark, source, [f"{source}/{n}" for n in batch], target, schema_store, number, lead, sort_by)
        _archive(spark, source, archive, taken, number)
        number += 1


def _archive(spark: SparkSession, source: str, archive: str, taken: str, number: int) -> None:
    """Move a batch's files away, but none that came under one of their names since; then forget the batch."""
    listed = json.loads(fs.read_text(spark, f"{taken}/{number}.json"))
    there = fs.stamps(spark, source)
    names = [n for n, stamp in listed.items() if there.get(n) == tuple(stamp)]
    with ThreadPoolExecutor(FOOTER_READERS) as pool:
        list(pool.map(lambda n: fs.rename(spark, f"{source}/{n}", f"{archive}/{BATCH}={number}/{n}"), names))
    fs.delete(spark, f"{taken}/{number}.json")


def _take(
    spark: SparkSession, source: str, paths: list[str], target: str, store: str, number: int, lead: Sequence[str], sort_by: Sequence[str]
) -> None:
    """Publish the rows of ``paths`` as batch ``number``."""
    rows = _read_batch(spark, source, paths, store, number).withColumn(INGEST_TS, F.current_timestamp())
    if lead:
        rows = lead_columns(rows, lead)
    if sort_by:
        rows = rows.sortWithinPartitions(*sort_by)
    publish(rows, target, f"{BATCH}={number}")


def require_checkpoint(spark: SparkSession, has_rows: bool, target: str, checkpoint: str) -> None:
    """A new checkpoint counts batches from 0 again, which a target with rows takes for done."""
    if has_rows and not fs.exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{target} has rows but {checkpoint} is new: rebuild into a new target instead")


def run_available(stream: DataFrame, checkpoint: str, work: Callable[[DataFrame, int], None]) -> None:
    """Give everything that is new to ``work``, batch by batch, and return."""
    query = (
        stream.writeStream.foreachBatch(work)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_ingested(spark: SparkSession, target: str, schema_store: str) -> DataFrame:
    """The whole batches so far; the schema comes from the store, no footers are merged."""
    schema = ingested_schema(spark, schema_store)
    whole = [fs.escape_glob(f"{target}/{BATCH}={n}") for n in numbered(spark, target, BATCH)]
    if not whole:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", target).parquet(*whole)


def stream_ingested(spark: SparkSession, target: str, schema_store: str, max_files: int | None = None) -> DataFrame:
    """The table as a stream of its new rows."""
    reader = spark.readStream.schema(ingested_schema(spark, schema_store)).option("maxFileAge", MAX_FILE_AGE)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(target)


def ingested_schema(spark: SparkSession, schema_store: str) -> T.StructType:
    data = stored_schema(spark, schema_store)
    if data is None:
        raise FileNotFoundError(f"nothing was taken in yet: no schema in {schema_store}")
    control = T.StructType(
        [
            T.StructField(RESCUED, T.StringType()),
            T.StructField(SOURCE_FILE, T.StringType()),
            T.StructField(SOURCE_TIME, T.TimestampType()),
            T.StructField(SOURCE_ROW, T.LongType()),
            T.StructField(INGEST_TS, T.TimestampType()),
            T.StructField(BATCH, T.LongType()),
        ]
    )
    return T.StructType([*data, *control])


# --- schema history: one small JSON file per widening ----------------------------------------


def stored_schema(spark: SparkSession, store: str, before: int | None = None) -> T.StructType | None:
    """The newest schema, or the one in force when batch ``before`` began."""
    numbers = sorted(int(n.removesuffix(".json")) for n in fs.list_names(spark, store) if n.endswith(".json"))
    numbers = [n for n in numbers if before is None or n < before]
    if not numbers:
        return None
    return T.StructType.fromJson(json.loads(fs.read_text(spark, f"{store}/{numbers[-1]}.json")))


def widen(known: T.StructType | None, found: T.StructType) -> T.StructType:
    """``known`` plus the columns only ``found`` has; known columns never change."""
    fields = list(known or [])
    names = {f.name.lower() for f in fields}
    for field in found:
        if field.name.lower() not in names:
            names.add(field.name.lower())
            fields.append(T.StructField(field.name, field.dataType, True))
    return T.StructType(fields)


# --- one micro-batch ---------------------------------------------------------------------------


def _read_batch(spark: SparkSession, base: str, paths: list[str], store: str, number: int) -> DataFrame:
    groups = _merge_equal(schema_groups(spark, base, paths))
    before = stored_schema(spark, store, number)
    schema = before
    for found, _ in groups:
        schema = widen(schema, found)
    if schema != before:
        fs.write_text(spark, f"{store}/{number}.json", schema.json())
    rows = None
    for found, members in groups:
        part = _read(spark, base, members, _folder_keys_as_text(found, schema, base, members)).select(
            "*",
            F.col("_metadata.file_path").alias(SOURCE_FILE),
            F.col("_metadata.file_modification_time").alias(SOURCE_TIME),
            F.col("_metadata.row_index").alias(SOURCE_ROW),
        )
        part = fit_schema(part, schema, keep=(SOURCE_FILE, SOURCE_TIME, SOURCE_ROW))
        rows = part if rows is None else rows.unionByName(part)
    return rows


def _folder_keys_as_text(found: T.StructType, schema: T.StructType, base: str, paths: list[str]) -> T.StructType:
    """``found`` with the folder keys that are text in the table read as text: ``code=007`` stays 007."""
    keys = {key for p in paths for key in _folder_keys(base, p)}
    text = {f.name.lower() for f in schema if isinstance(f.dataType, T.StringType)}
    return T.StructType(
        [
            T.StructField(f.name, T.StringType()) if f.name in keys and f.name.lower() in text else f
            for f in found
        ]
    )


def _read(spark: SparkSession, base: str, paths: list[str], schema: T.StructType | None) -> DataFrame:
    reader = spark.read.option("basePath", base)
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", "true")
    return reader.parquet(*(fs.escape_glob(p) for p in paths))


def schema_groups(spark: SparkSession, base: str, paths: list[str]) -> Iterator[tuple[T.StructType, list[str]]]:
    """The files in groups that share a schema.

    Spark merges the footers of all files in one distributed job, which is all the usual batch costs.
    When types conflict, every footer is read once for the types it declares, and each distinct
    declaration (with the folder keys on the way to the file) is one group and one job: their number
    follows the schemas in the batch, not its files.
    """
    try:
        yield _read(spark, base, paths, None).schema, paths
        return
    except (PySparkException, Py4JJavaError) as error:
        if len(paths) == 1 or not _is_conflict(error):
            raise
    alike: dict[tuple, list[str]] = {}
    with ThreadPoolExecutor(FOOTER_READERS) as pool:
        for path, declared in zip(paths, pool.map(declared_types, repeat(spark), paths)):
            alike.setdefault((declared, _folder_keys(base, path)), []).append(path)
    if len(alike) == 1:
        raise ValueError(f"files below {base} declare the same types and can't be read together")
    for group in alike.values():
        yield _read(spark, base, group, None).schema, group


def _is_conflict(error: Exception) -> bool:
    """The conflict may be found inside a task: then only the message names it."""
    return any(c in str(error) for c in _CONFLICTS)


def declared_types(spark: SparkSession, path: str) -> str:
    """The column types in a Parquet file's footer, as text that is equal for files of equal types.

    Only the footer is read, through the session's file systems.
    """
    hadoop, parquet = spark._jvm.org.apache.hadoop.fs.Path, spark._jvm.org.apache.parquet.hadoop
    reader = parquet.ParquetFileReader.open(parquet.util.HadoopInputFile.fromPath(hadoop(path), spark._jsc.hadoopConfiguration()))
    try:
        meta = reader.getFileMetaData()
        return f"{meta.getSchema().toString()}{meta.getKeyValueMetaData().get(_SPARK_TYPES) or ''}"
    finally:
        reader.close()


def _folder_keys(base: str, path: str) -> tuple[str, ...]:
    depth = len(base.rstrip("/").split("/"))
    return tuple(part.split("=", 1)[0] for part in path.split("/")[depth - 1 : -1] if "=" in part)


def _merge_equal(groups: Iterator[tuple[T.StructType, list[str]]]) -> list[tuple[T.StructType, list[str]]]:
    merged: dict[str, tuple[T.StructType, list[str]]] = {}
    for schema, paths in groups:
        merged.setdefault(schema.json(), (schema, []))[1].extend(paths)
    return list(merged.values())


def fit_schema(df: DataFrame, schema: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """``df`` with exactly the columns of ``schema``, the rescue column, and ``keep``.

    A value that does not convert without loss is NULL in its column and kept, as JSON under the
    column's name, in the rescue column.
    """
    have = {f.name.lower(): f for f in df.schema if f.name not in keep}
    columns: list[Column] = []
    lost: list[Column] = []
    for field in schema:
        found = have.get(field.name.lower())
        if found is None:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        value = F.col(f"`{found.name}`")
        if found.dataType == field.dataType:
            columns.append(value.alias(field.name))
            continue
        fitted = _convert(df, value, found.dataType, field.dataType)
        columns.append(fitted.alias(field.name))
        lost.append(F.when(fitted.isNull(), _as_text(value, found.dataType)).alias(field.name))
    if lost:
        rescued = F.nullif(F.to_json(F.struct(*lost)), F.lit("{}"))
    else:
        rescued = F.lit(None).cast("string")
    return df.select(*columns, rescued.alias(RESCUED), *keep)


def _as_text(value: Column, kind: T.DataType) -> Column:
    return F.to_json(value) if isinstance(kind, (T.StructType, T.ArrayType, T.MapType)) else value.cast("string")


def _convert(df: DataFrame, value: Column, have: T.DataType, want: T.DataType) -> Column:
    converted = value.try_cast(want)
    try:
        df.select(converted)
    except PySparkException:  # no conversion exists between these types
        return F.lit(None).cast(want)
    if isinstance(have, T.StringType) or isinstance(want, T.StringType):
        return converted
    return F.when(converted.try_cast(have).eqNullSafe(value), converted)
