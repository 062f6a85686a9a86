"""Row functions over documents in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from telemetry_spark.llm.common import ship_package

ROWS = 512


def map_rows(df: DataFrame, rows: Callable[..., Iterable[tuple]], schema: StructType,
             setup: Callable[[], object] | None = None) -> DataFrame:
    """``rows(state, *columns)`` gives the output rows for up to ``ROWS`` input rows, whose
    columns come as Python lists; ``setup()`` makes the state once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        target = to_arrow_schema(schema)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                out = list(rows(state, *[c.to_pylist() for c in part.columns]))
                columns = list(zip(*out)) if out else [()] * len(target)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, type=f.type) for c, f in zip(columns, target)], schema=target)

    ship_package(df.sparkSession)
    return df.mapInArrow(run, schema)
