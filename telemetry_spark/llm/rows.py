"""Rows of documents told apart where their id does not do it.

Decisions come back to the documents by id.  An id that several rows share, or none, cannot carry
one; ``shared_ids`` finds these in one narrow aggregation, and only their rows are told apart by
their text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.llm.common import free_name, materialise, quoted

_ORDERED = (T.NumericType, T.StringType, T.BooleanType, T.BinaryType, T.DateType, T.TimestampType, T.TimestampNTZType)


def shared_ids(docs: DataFrame, id_col: str) -> tuple[DataFrame, int]:
    """(_shared): the ids of more than one row, and null if a row has it; and their number."""
    ids = docs.select(quoted(id_col).cast("long").alias("_shared")).groupBy("_shared").agg(F.count(F.lit(1)).alias("rows"))
    found, seen = materialise(ids.where("rows > 1 or _shared is null").select("_shared"), "shared-ids", {"n": F.count(F.lit(1))})
    return found, seen["n"]


def with_id_in(docs: DataFrame, id_col: str, ids: DataFrame, kind: str = "left_semi") -> DataFrame:
    """The rows whose id is among ``ids`` (one column; null equals null), or with ``left_anti`` the others."""
    mark = free_name(docs, "_among")
    among = ids.select(quoted(ids.columns[0]).alias(mark))
    return docs.join(among, quoted(id_col).cast("long").eqNullSafe(quoted(mark)), kind)


def first_rows(docs: DataFrame, keys: list[Column], order: list[Column]) -> DataFrame:
    """One row for each value of ``keys``: the first by ``order``, then by the plain columns in their
    order.  The limit of one row holds in every task before the shuffle, so a hot key is one row a task."""
    place = free_name(docs, "_place")
    plain = [quoted(f.name) for f in docs.schema if isinstance(f.dataType, _ORDERED)]
    ranked = docs.withColumn(place, F.row_number().over(Window.partitionBy(*keys).orderBy(*order, *plain)))
    return ranked.where(quoted(place) == 1).drop(place)
