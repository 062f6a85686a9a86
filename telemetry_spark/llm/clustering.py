"""Centroid clustering: Lloyd's algorithm over vectors cut into column blocks.

Vectors become integers, so that every distance and every sum is exact, and are stored once as
slices: some thousand rows by one block of columns.  A round is one job:

1. a task over slices computes the exact partial squared distances of its rows to the centroids'
   entries in its own columns;
2. the partial distances of a group of rows are added over the blocks, by key, and the nearest
   centroid is taken (ties: the smaller number);
3. the labels return to the slices, and every shard sums its own columns by cluster.  The driver
   receives clusters x columns sums and makes the next centroids of them.

The slices are read back dealt by group and kept (memory, then disk; a lost part is read from the
files again), so a round shuffles the partial distances (clusters x blocks numbers a row) and one
label a row, never the vectors.  No group of rows is larger than ``rows``; how often a vector
repeats plays no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from telemetry_spark.llm.common import materialise, quoted, ship_package, table
from telemetry_spark.llm.vectors import finite, matrix

LIMIT = 2 ** 26      # integer entries beyond this could not be squared and added in 64 bits

_LONGS = pa.list_(pa.int64())
_SLICES = pa.schema({"group": pa.int64(), "block": pa.int32(), "n": pa.int32(), "entries": pa.binary(), "ids": _LONGS})
_PARTIAL = pa.schema({"group": pa.int64(), "n": pa.int32(), "partial": pa.binary()})
_LABELS = pa.schema({"group": pa.int64(), "labels": pa.binary(), "distances": pa.binary()})
_SUMS = pa.schema({"cluster": pa.int32(), "block": pa.int32(), "n": pa.int64(), "sums": _LONGS})
_FOUND = pa.schema({"id": pa.int64(), "cluster": pa.int32(), "distance": pa.int64()})


def cut_columns(width: int, blocks: int) -> list[slice]:
    edges = np.linspace(0, width, min(blocks, width) + 1).astype(int)
    return [slice(int(a), int(b)) for a, b in zip(edges, edges[1:])]


def partial_distances(entries: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    """Squared distances within one block of columns, rows by centroids, exact."""
    return np.stack([((entries - c) ** 2).sum(axis=1) for c in centroids], axis=1)


def _table(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _slicing(width: int, columns: list[slice], rows: int):
    def sliced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = TaskContext.get().partitionId() << 32
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                entries = matrix(part.column(1), width, np.int64)
                ids = part.column(0).to_pylist()
                yield _table(_SLICES, [
                    [group] * len(columns), list(range(len(columns))), [len(ids)] * len(columns),
                    [np.ascontiguousarray(entries[:, c]).tobytes() for c in columns],
                    [ids if b == 0 else None for b in range(len(columns))]])
                group += 1

    return sliced


def _measuring(centroids: np.ndarray, columns: list[slice]):
    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for group, block, n, entries in zip(*[c.to_pylist() for c in batch.columns[:4]]):
                own = columns[block]
                partial = partial_distances(np.frombuffer(entries, np.int64).reshape(n, -1), centroids[:, own])
                yield _table(_PARTIAL, [[group], [n], [partial.tobytes()]])

    return measured


def _nearest(rows: pa.Table) -> pa.Table:
    """The blocks of one group added, and the nearest centroid of each row."""
    n = rows["n"][0].as_py()
    total = sum(np.frombuffer(p.as_py(), np.int64) for p in rows["partial"]).reshape(n, -1)
    near = total.argmin(axis=1)
    return pa.Table.from_batches([_table(_LABELS, [
        [rows["group"][0].as_py()], [near.astype(np.int32).tobytes()], [total[np.arange(n), near].tobytes()]])])


def _summing(clusters: int):
    """Every shard's sums of its own columns, by cluster."""

    def summed(slices: pa.Table, labels: pa.Table) -> pa.Table:
        near = np.frombuffer(labels["labels"][0].as_py(), np.int32)
        out = []
        for block, n, entries in zip(slices["block"].to_pylist(), slices["n"].to_pylist(), slices["entries"]):
            values = np.frombuffer(entries.as_py(), np.int64).reshape(n, -1)
            for k in np.unique(near):
                mine = near == k
                out.append((int(k), block, int(mine.sum()), values[mine].sum(axis=0).tolist()))
        return pa.Table.from_batches([_table(_SUMS, list(zip(*out)))])

    return summed


def _listing(slices: pa.Table, labels: pa.Table) -> pa.Table:
    """The rows of a group with their label and distance."""
    ids = next(i for i in slices["ids"].to_pylist() if i is not None)
    near, far = np.frombuffer(labels["labels"][0].as_py(), np.int32), np.frombuffer(labels["distances"][0].as_py(), np.int64)
    return pa.Table.from_batches([_table(_FOUND, [ids, near, far])])


def _moved(sums: DataFrame, centroids: np.ndarray, columns: list[slice]) -> np.ndarray:
    """New centroids: floor of sum over count in whole numbers, an empty cluster's stays."""
    each = sums.select("cluster", "block", "n", F.posexplode("sums").alias("place", "entry"))
    rows = each.groupBy("cluster", "block", "place").agg(
        F.sum("n").alias("n"), F.sum(F.col("entry").cast("decimal(38,0)")).alias("entry")).collect()
    out = centroids.copy()
    for r in rows:    # clusters x columns of them
        out[r["cluster"], columns[r["block"]].start + r["place"]] = int(r["entry"]) // r["n"]
    return out


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, width: int, scale: int) -> DataFrame:
    """(id, x): rows with exactly ``width`` entries, none null or non-finite, as floor(scale * entry)."""
    rows = vectors.select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).cast("array<double>").alias("v"))
    kept = rows.where(F.expr(f"size(v) = {width} and {finite('v', LIMIT / scale)}"))
    return kept.select("id", F.expr(f"transform(v, e -> cast(floor({scale} * e) as bigint))").alias("x"))


def lloyd(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", width: int = 64, clusters: int = 8,
          rounds: int = 10, scale: int = 1024, seed: int = 3, blocks: int = 4, rows: int = 4096) -> tuple[DataFrame, list[list[int]]]:
    """((id, cluster, distance) of every kept vector, the final centroids).

    Kept are vectors with exactly ``width`` entries, none null or non-finite; every entry becomes
    floor(scale * entry).  Centroids start as the ``clusters`` kept vectors whose SHA-256 of
    ``<seed>:<id>`` is smallest (equal ids: the smaller vector first).  After ``rounds`` rounds the
    vectors are assigned once more.  Defined results: a null id is kept and clustered but never
    starts a centroid; repeated rows count each, and equal starting centroids leave the larger
    number empty, which then stays where it is; with fewer vectors there are fewer centroids; no
    kept vector, or no id, gives no rows; an entry of 2^26 / scale or more cannot be squared and
    added in a long, and its vector is left out like a non-finite one; columns but the two are not
    read.  An empty cluster keeps its centroid."""
    ship_package(vectors.sparkSession)
    columns = cut_columns(width, blocks)
    kept = kept_vectors(vectors, id_col, vector_col, width, scale)
    order = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")), 256)
    start = kept.where("id is not null").orderBy(order, "x").limit(clusters).collect()
    if not start:
        return vectors.sparkSession.createDataFrame([], from_arrow_schema(_FOUND)), []
    centroids = np.array([r["x"] for r in start], np.int64)
    stored, seen = materialise(kept.mapInArrow(_slicing(width, columns, rows), from_arrow_schema(_SLICES)), "vector-slices",
                               {"n": F.count(F.lit(1))})
    # one shuffle for all rounds: afterwards only partial distances and labels move
    parts = max(1, min(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), seen["n"]))
    slices = stored.repartition(parts, "group").persist(StorageLevel.MEMORY_AND_DISK)

    def assigned(at: np.ndarray) -> DataFrame:
        partial = slices.mapInArrow(_measuring(at, columns), from_arrow_schema(_PARTIAL))
        return partial.groupBy("group").applyInArrow(_nearest, from_arrow_schema(_LABELS))

    def with_slices(labels: DataFrame, function, schema: pa.Schema) -> DataFrame:
        return slices.groupBy("group").cogroup(labels.groupBy("group")).applyInArrow(function, from_arrow_schema(schema))

    for _ in range(rounds):
        moved = _moved(with_slices(assigned(centroids), _summing(len(centroids)), _SUMS), centroids, columns)
        if (moved == centroids).all():
            break        # every further round would repeat this one
        centroids = moved
    found, _ = materialise(with_slices(assigned(centroids), _listing, _FOUND), "clusters")
    slices.unpersist()
    return found, centroids.tolist()


def centroid_digest(centroid: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, centroid)).encode()).hexdigest()


def cluster_report(vectors: DataFrame, id_col: str = "vec_id", **options) -> DataFrame:
    """Per kept vector: cluster, distance, its cluster's and the whole inertia, the digest of its centroid."""
    found, centroids = lloyd(vectors, id_col=id_col, **options)
    per = {r["cluster"]: int(r["s"]) for r in
           found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    own, digest = F.lit(None).cast("long"), F.lit(None).cast("string")
    for k, c in enumerate(centroids):    # as many as there are clusters
        own = F.when(F.col("cluster") == k, F.lit(per.get(k, 0)).cast("long")).otherwise(own)
        digest = F.when(F.col("cluster") == k, F.lit(centroid_digest(c))).otherwise(digest)
    return found.select(
        F.col("id").alias(id_col), "cluster", "distance", own.alias("cluster_inertia"),
        F.lit(sum(per.values())).cast("long").alias("inertia"), digest.alias("centroid_sha256"))


def op12_sharded_lloyd(spark, sf_dir):
    return cluster_report(table(spark, sf_dir, "embeddings"))


def oracle(rounds: int = 10, clusters: int = 8, width: int = 64, scale: int = 1024, seed: int = 3) -> str:
    """The same in SQL, one pair of statements a round over unnested entries."""
    bound = LIMIT / scale
    parts = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS place, vec_id,
    [CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT) FOR e IN embedding] AS x
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {width}
    AND len([e FOR e IN embedding IF e IS NOT NULL AND isfinite(e) AND abs(CAST(e AS DOUBLE)) < {bound}]) = {width})""",
             "entries AS MATERIALIZED (SELECT place, unnest(x) AS entry, generate_subscripts(x, 1) AS d FROM kept)",
             f"""c0 AS MATERIALIZED (
  SELECT cluster, unnest(x) AS entry, generate_subscripts(x, 1) AS d FROM (
    SELECT CAST(row_number() OVER (ORDER BY sha256('{seed}:' || CAST(vec_id AS VARCHAR)), x) - 1 AS INTEGER) AS cluster, x
    FROM kept WHERE vec_id IS NOT NULL) WHERE cluster < {clusters})"""]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS MATERIALIZED (
  SELECT place, CAST(min(struct_pack(distance := distance, cluster := cluster)).cluster AS INTEGER) AS cluster,
    CAST(min(distance) AS BIGINT) AS distance
  FROM (SELECT place, cluster, sum((e.entry - c.entry) * (e.entry - c.entry)) AS distance
        FROM entries e JOIN c{r} c USING (d) GROUP BY place, cluster) GROUP BY place)""")
        if r < rounds:
            parts.append(f"""c{r + 1} AS MATERIALIZED (
  SELECT c.cluster, c.d, COALESCE(m.entry, c.entry) AS entry FROM c{r} c LEFT JOIN (
    SELECT cluster, d, CAST((sum(entry) - ((sum(entry) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS entry
    FROM entries JOIN a{r} USING (place) GROUP BY cluster, d) m USING (cluster, d))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT k.vec_id, a.cluster, a.distance, CAST(sum(a.distance) OVER (PARTITION BY a.cluster) AS BIGINT) AS cluster_inertia,
  CAST(sum(a.distance) OVER () AS BIGINT) AS inertia, s.digest AS centroid_sha256
FROM a{rounds} a JOIN kept k USING (place) JOIN (
  SELECT cluster, sha256(string_agg(CAST(entry AS VARCHAR), ',' ORDER BY d)) AS digest FROM c{rounds} GROUP BY cluster) s
  USING (cluster)"""
