"""Row changes between two snapshots."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.session import new_scratch

NESTED = (T.ArrayType, T.StructType)


def row_digest(schema: T.StructType, columns: Sequence[str]) -> Column:
    """A 128-bit hash of a row that also tells where its NULLs are.

    Spark's hash skips NULLs, so their places are hashed too, and nested values once more as JSON.
    """
    values: list[Column] = []
    for name in columns:
        value = F.col(f"`{name}`")
        values += [value, value.isNull()]
        if isinstance(schema[name].dataType, NESTED):
            values.append(F.to_json(F.struct(value), {"ignoreNullFields": "false"}))
    return F.struct(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit("b"), *values).alias("b"))


def _named(keys: Sequence[str]) -> list[Column]:
    return [F.col(f"`{k}`").alias(f"_key_{i}") for i, k in enumerate(keys)]


def changed_keys(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``_key_0, _key_1, ...`` of the rows whose digests differ or that one snapshot lacks.

    Only keys and digests are shuffled. Values that differ in form alone (0.0 and -0.0 within a
    list) may count as changed.
    """
    columns = sorted(old.columns)
    sides = [
        side.select(*_named(keys), row_digest(side.schema, columns).alias("_digest"), F.lit(i).alias("_side"))
        for i, side in enumerate((old, new))
    ]
    names = [f"_key_{i}" for i in range(len(keys))]
    of = lambda i: F.max(F.when(F.col("_side") == i, F.col("_digest"))).alias(f"_digest_{i}")
    held = sides[0].unionByName(sides[1]).groupBy(*names).agg(of(0), of(1))
    return held.filter(~F.col("_digest_0").eqNullSafe(F.col("_digest_1"))).select(*names)


def snapshot_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The change feed from ``old`` to ``new``: insert, delete, and both images of an update.

    ``keys`` must be unique in both. NULLs compare as equal, columns are matched by name; two empty
    snapshots have no changes. Keys and row digests of both snapshots meet first; whole rows are
    then read again for the keys that changed, and only those are compared and joined. The changed
    keys are written to the scratch folder, so that Spark knows their size: few of them are
    broadcast, and no unchanged row moves; many are joined by a shuffle. Both snapshots are read
    twice, so they must give the same rows each time.
    """
    columns = list(old.columns)
    if set(columns) != set(new.columns):
        raise ValueError("both snapshots need the same columns")
    spark = old.sparkSession
    path = new_scratch(spark, "changed")
    found = changed_keys(old, new, keys)
    found.write.parquet(path)
    changed = spark.read.schema(found.schema).parquet(path)
    names = found.columns

    def rows(side: DataFrame, as_: str) -> DataFrame:
        row = F.struct(*(F.col(f"`{c}`") for c in columns)).alias(as_)
        whole = side.select(row, *(c.alias(f"{as_}_{n}") for c, n in zip(_named(keys), names)))
        match = reduce(and_, (whole[f"{as_}_{n}"].eqNullSafe(changed[n]) for n in names))
        return whole.join(changed, match, "left_semi")

    match = reduce(and_, (F.col(f"_old_{n}").eqNullSafe(F.col(f"_new_{n}")) for n in names))
    pairs = rows(old, "_old").join(rows(new, "_new"), match, "full_outer").select("_old", "_new")
    differing = pairs.filter(~F.col("_old").eqNullSafe(F.col("_new")))

    def image(kind: str, source: str) -> Column:
        return F.struct(F.lit(kind).alias("change_type"), F.col(source).alias("row"))

    images = (
        F.when(F.col("_old").isNull(), F.array(image("insert", "_new")))
        .when(F.col("_new").isNull(), F.array(image("delete", "_old")))
        .otherwise(F.array(image("update_pre", "_old"), image("update_post", "_new")))
    )
    return differing.select(F.inline(images)).select("change_type", "row.*")
