"""Batch scans, file and table sinks, and versioned full refresh."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakestrata.session import new_scratch, session_with
from lakestrata.sources import fs


MARKER = "_published"
FILE_BYTES = 128 * 1024 * 1024


def scan_table(spark: SparkSession, name: str) -> DataFrame:
    """A catalog table by its one-, two- or three-part name."""
    return spark.table(name)


def scan_parquet(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet file or a folder tree; ``key=value`` folders become columns."""
    return spark.read.parquet(path)


def sql_over_files(spark: SparkSession, select: str, path: str, tail: str = "") -> DataFrame:
    """SQL straight over files: ``SELECT <select> FROM parquet.`path` <tail>``."""
    quoted = path.replace("`", "``")
    return spark.sql(f"SELECT {select} FROM parquet.`{quoted}` {tail}")


def write_files(df: DataFrame, path: str, files: int | None = None) -> int:
    """Overwrite ``path`` and return the rows written, counted during the write.

    ``files`` asks for that many files, or for as many of about ``FILE_BYTES`` as it takes where those
    would be larger: one task makes one file, and what it takes in must not grow with the data. Sizes
    are only known of written rows, so they go to the scratch folder first, which keeps the work before
    parallel.
    """
    if files is None:
        return _write_counted(df, path)
    if files < 1:
        raise ValueError("files must be at least 1")
    spark = df.sparkSession
    staged = new_scratch(spark, "rows")
    rows = _write_counted(df, staged)
    if fs.size(spark, staged) <= files * FILE_BYTES:
        dealt = spark.read.schema(df.schema).parquet(staged).repartition(files)
    else:
        cut = {"files.maxPartitionBytes": str(FILE_BYTES), "files.openCostInBytes": "0", "files.minPartitionNum": "1"}
        dealt = session_with(spark, **cut).read.schema(df.schema).parquet(staged)
    dealt.write.mode("overwrite").parquet(path)
    fs.delete(spark, staged)
    return rows


def _write_counted(df: DataFrame, path: str) -> int:
    written = Observation()
    df.observe(written, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(path)
    return written.get["rows"]


def replace_table(df: DataFrame, name: str) -> None:
    """Full refresh of a catalog table by Spark's overwrite: a job that fails leaves no table.

    ``refresh_table`` keeps the old one readable.
    """
    df.write.mode("overwrite").format("parquet").saveAsTable(name)


def refresh_table(df: DataFrame, name: str, root: str, keep: int = 2) -> None:
    """Full refresh of the external table ``name``, whose versions lie below ``root``.

    The next version is written whole before the table is pointed at it, one change in the catalog:
    a refresh that fails leaves the old table readable under its name, readers who began before
    finish undisturbed, and ``df`` may itself read the table. Columns that are new are added at the
    end. Where columns have gone, changed their type or their order the table is made again over the
    new version, which is the only moment it is absent. A table that is not external raises.
    """
    spark = df.sparkSession
    before = _external_schema(spark, name)
    folder = next_version(spark, root)
    stage(df, root, folder)
    show(spark, root, folder)
    location = _sql_text(f"{root}/{folder}")
    old = [] if before is None else [(f.name, f.dataType) for f in before]
    now = [(f.name, f.dataType) for f in df.schema]
    if before is not None and now[: len(old)] == old:
        added = [f"{_sql_name(n)} {t.simpleString()}" for n, t in now[len(old):]]
        if added:
            spark.sql(f"ALTER TABLE {name} ADD COLUMNS ({', '.join(added)})")
        spark.sql(f"ALTER TABLE {name} SET LOCATION {location}")
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} USING parquet LOCATION {location}")
    spark.catalog.refreshTable(name)
    drop_versions(spark, root, keep)


def _external_schema(spark: SparkSession, name: str) -> StructType | None:
    if not spark.catalog.tableExists(name):
        return None
    kind = spark.catalog.getTable(name).tableType
    if kind != "EXTERNAL":
        raise ValueError(f"{name} is {kind}, not EXTERNAL: its location can't be swapped")
    return spark.table(name).schema


def _sql_text(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


# --- one published folder per unit of work -----------------------------------------------


def publish(
    df: DataFrame, root: str, folder: str, write: Callable[[DataFrame, str, str], None] | None = None
) -> None:
    """Write ``root/folder`` once and for all; ``write`` is ``stage`` unless another one is given.

    The job writes below ``_staging``, which Spark's readers skip, and a note then fixes the files it
    made. Moving them shows them, and a small marker written last says that the folder is whole. A
    whole folder is left alone, and a move that was cut short goes on with the files of the note: a
    stream that does not look at markers meets each of them once, early or late, never another copy.
    """
    spark = df.sparkSession
    if published(spark, root, folder):
        return
    if not _noted(spark, root, folder):
        (write or stage)(df, root, folder)
        # what lies there without a note was never meant to be seen
        fs.delete(spark, f"{root}/{folder}")
        names = fs.list_files(spark, f"{root}/_staging/{folder}")
        fs.write_text(spark, _note(root, folder), json.dumps(sorted(names)))
    _move(spark, root, folder)


def resume(spark: SparkSession, root: str, folder: str) -> bool:
    """Finish a ``publish`` that was cut short while it moved its files; whether the folder is whole now."""
    if not published(spark, root, folder) and _noted(spark, root, folder):
        _move(spark, root, folder)
    return published(spark, root, folder)


def _note(root: str, folder: str) -> str:
    return f"{root}/_staging/_notes/{folder}.json"


def _noted(spark: SparkSession, root: str, folder: str) -> list[str]:
    """The files that an earlier attempt made, where all of them are still there, moved or not."""
    if not fs.exists(spark, _note(root, folder)):
        return []
    names = json.loads(fs.read_text(spark, _note(root, folder)))
    there = fs.list_files(spark, f"{root}/_staging/{folder}").keys() | fs.list_files(spark, f"{root}/{folder}").keys()
    return names if there.issuperset(names) else []


def _move(spark: SparkSession, root: str, folder: str) -> None:
    staged, shown = f"{root}/_staging/{folder}", f"{root}/{folder}"
    if not fs.exists(spark, shown):
        fs.rename(spark, staged, shown)
    else:
        there = fs.list_files(spark, shown)
        for name in fs.list_files(spark, staged):
            if name not in there:
                fs.rename(spark, f"{staged}/{name}", f"{shown}/{name}")
    fs.write_text(spark, f"{shown}/{MARKER}", "")
    fs.delete(spark, staged)
    fs.delete(spark, _note(root, folder))


def stage(df: DataFrame, root: str, folder: str) -> None:
    """Write a folder that readers do not see yet; what an earlier attempt left there is replaced."""
    df.write.mode("overwrite").parquet(f"{root}/_staging/{folder}")


def show(spark: SparkSession, root: str, folder: str) -> None:
    """Move a staged folder to its place, over what may be there in part, and mark it as whole.

    For folders whose readers look at the marker first.
    """
    fs.delete(spark, f"{root}/{folder}")
    fs.rename(spark, f"{root}/_staging/{folder}", f"{root}/{folder}")
    fs.write_text(spark, f"{root}/{folder}/{MARKER}", "")


def published(spark: SparkSession, root: str, folder: str) -> bool:
    return fs.exists(spark, f"{root}/{folder}/{MARKER}")


def numbered(spark: SparkSession, root: str, key: str) -> list[int]:
    """The numbers ``n`` among the whole ``key=n`` folders of ``root``, ascending."""
    return [n for n in subfolders(spark, root, key) if published(spark, root, f"{key}={n}")]


def subfolders(spark: SparkSession, root: str, key: str) -> list[int]:
    """The numbers ``n`` among the ``key=n`` folders below a folder that is whole itself."""
    prefix = f"{key}="
    return sorted(int(n[len(prefix):]) for n in fs.list_names(spark, root) if n.startswith(prefix))


# --- full refresh ------------------------------------------------------------------------


def full_refresh(df: DataFrame, root: str, keep: int = 2) -> str:
    """Publish ``df`` as the next version of ``root``; older ones beyond ``keep`` are removed.

    Readers of the version before stay undisturbed, and ``df`` may itself read ``root``.
    """
    spark = df.sparkSession
    folder = next_version(spark, root)
    stage(df, root, folder)
    show(spark, root, folder)
    drop_versions(spark, root, keep)
    return f"{root}/{folder}"


def next_version(spark: SparkSession, root: str) -> str:
    return f"version={max(numbered(spark, root, 'version'), default=-1) + 1}"


def drop_versions(spark: SparkSession, root: str, keep: int) -> None:
    """Remove all but the newest ``keep`` versions."""
    if keep < 1:
        raise ValueError("keep must be at least 1")
    for old in numbered(spark, root, "version")[:-keep]:
        fs.delete(spark, f"{root}/version={old}")


def current_version(spark: SparkSession, root: str) -> DataFrame:
    versions = numbered(spark, root, "version")
    if not versions:
        raise FileNotFoundError(f"no published version below {root}")
    return spark.read.parquet(fs.escape_glob(f"{root}/version={versions[-1]}"))
