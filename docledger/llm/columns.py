"""Columns that travel through an operator unread, whatever their names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def numbered(docs: DataFrame, keep: tuple[str, ...], *own) -> DataFrame:
    """The columns in ``keep`` as __keep0, __keep1 and so on, then the operator's own: names or columns."""
    return docs.select(*(F.col(f"`{c}`").alias(f"__keep{k}") for k, c in enumerate(keep)), *own)


def renamed(rows: DataFrame, keep: tuple[str, ...]) -> DataFrame:
    """Gives the columns their names back. A result may have the same name; the table then has both."""
    names = dict(zip((f"__keep{k}" for k in range(len(keep))), keep, strict=True))
    return rows.toDF(*(names.get(c, c) for c in rows.columns))
