"""Helpers the operators share: reading tables, writing intermediate tables, free names."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from telemetry_spark.session import scratch_path

WHITESPACE = r"[\x20\x09-\x0D]"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def materialise(df: DataFrame, name: str, metrics: dict[str, Column] | None = None) -> tuple[DataFrame, dict]:
    """``df`` written to the shared checkpoint folder and read again, with ``metrics``
    observed on the write.  Lineage ends at the files, so a lost executor re-reads them."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    observed: dict = {}
    if metrics:
        seen = Observation()
        df.observe(seen, *[c.alias(k) for k, c in metrics.items()]).write.parquet(path)
        observed = seen.get
    else:
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), observed


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the first of ``name_1``, ``name_2``... that ``df`` has no column of."""
    taken = {c.lower() for c in df.columns}
    out, k = name, 0
    while out.lower() in taken:
        k += 1
        out = f"{name}_{k}"
    return out


def quoted(name: str) -> Column:
    """A top-level column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package (a zip of its sources, served by Spark), so that their
    Python workers can import it wherever the driver was started."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    target = os.path.join(tempfile.mkdtemp(prefix="package-"), "telemetry_spark.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(target)
    _SHIPPED.add(context.applicationId)
