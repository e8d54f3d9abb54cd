"""Column names of a table kept apart from an operator's own."""

from __future__ import annotations

from pyspark.sql import DataFrame


def apart(df: DataFrame, *names: str) -> tuple[DataFrame, list[str]]:
    """``df`` with its columns called ``column_0``, ``column_1`` and so on, and what ``names`` are then.

    An operator that carries whole rows works on these, and gives them their names back at the end
    (``toDF(*df.columns)``): so no column can clash with its own, whatever it is called.
    """
    hidden = [f"column_{i}" for i in range(len(df.columns))]
    return df.toDF(*hidden), [hidden[df.columns.index(name)] for name in names]
