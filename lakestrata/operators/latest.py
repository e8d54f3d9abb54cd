"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_by: Sequence[str], unique: bool = False
) -> DataFrame:
    """One row per key: greatest ``newest_by``, NULLs last.

    Ties fall to the remaining columns, so the order is total up to identical rows and the
    answer does not depend on partitioning. That makes every column of ``df`` needed: project
    first, or pass ``unique=True`` where ``newest_by`` already tells the rows of a key apart.

    Spark keeps one row per key in every map task before the shuffle (WindowGroupLimit), so a
    hot key costs no more than any other.
    """
    if not newest_by:
        raise ValueError("newest_by must name at least one column")
    fixed = {*keys, *newest_by}
    rest = [] if unique else [f.name for f in df.schema if f.name not in fixed and orderable(f.dataType)]
    order = [F.col(f"`{c}`").desc_nulls_last() for c in [*newest_by, *rest]]
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def orderable(kind: T.DataType) -> bool:
    """Whether values of the type can be sorted and hashed."""
    if isinstance(kind, T.StructType):
        return all(orderable(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))
