"""Approximate nearest neighbours with a permutation index.

Pivots are drawn from the table; a vector is represented by its ``prefix`` nearest pivots in their
order.  It is posted, with that order, in the inverted file of each of them.  A query visits the
files of its own nearest pivots; what it meets there is ranked by footrule distance (how far the
pivots' places in the two orders lie apart, a pivot missing from a prefix counts as at its end), and
what ranks within the footrule reach is reranked by the Euclidean distance of the vectors.

How many files a query visits and how far the reach goes is not guessed: a bounded sample of queries
is answered by brute force first (one pass over the table), and both are set to the smallest values
at which ``target`` of those true neighbours are found.  Easy tables get short searches and hard
ones long searches, at every size; nothing cuts the number of candidates.

Equal vectors are one node that carries its smallest ``k + 1`` ids, and equal queries are asked
once.  Files are dealt into blocks of residents and visitors, so a hot pivot is many groups.  A pair
is judged in the first file in which it meets, so a group returns nothing but ``k + 1`` rows a
visitor.  Visitors that found fewer rows than there are (a file may be nearly empty) visit every
file without a reach.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telemetry_spark.llm.common import materialise, quoted, ship_package, table
from telemetry_spark.llm.embedding_dedup import usable
from telemetry_spark.llm.vectors import lists, matrix

PIVOT_BYTES = 64 << 20      # of the broadcast pivots


@dataclass
class Pivots:
    points: np.ndarray
    prefix: int

    def order(self, vectors: np.ndarray, length: int) -> np.ndarray:
        """The nearest ``length`` pivots of each vector, nearest first, ties by number."""
        p = self.points
        square = (vectors * vectors).sum(axis=1)[:, None] - 2 * vectors @ p.T + (p * p).sum(axis=1)
        return np.argsort(square, axis=1, kind="stable")[:, :length].astype(np.int32)


def places(orders: np.ndarray, pivots: int) -> np.ndarray:
    """Where each pivot stands in each order; a missing one stands at the end."""
    out = np.full((len(orders), pivots), orders.shape[1], np.int16)
    np.put_along_axis(out, orders, np.broadcast_to(np.arange(orders.shape[1], dtype=np.int16), orders.shape), axis=1)
    return out


def footrule(where: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The footrule distances of one order (a prefix) to residents with the given ``places``."""
    return np.abs(where[:, order] - np.arange(len(order), dtype=np.int16)).sum(axis=1, dtype=np.int64)


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    return np.sqrt(((vectors - query) ** 2).sum(axis=1))


def _nodes(rows: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """One row per distinct vector: a number, its smallest ``k + 1`` ids, whether it is asked for."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("id"))
    few = rows.select("id", "vector").withColumn("_place", place).where(F.col("_place") <= k + 1)
    node = few.groupBy("vector").agg(F.sort_array(F.collect_list("id")).alias("ids"))    # k + 1 at most
    wanted = asked.select(F.col("vector").alias("_asked")).distinct()
    return node.join(wanted, node["vector"] == wanted["_asked"], "left").select(
        F.monotonically_increasing_id().alias("node"), F.size("vector").alias("width"), "vector", "ids",
        F.col("_asked").isNotNull().alias("asked"))


def _drawn(nodes: DataFrame, n: int, wanted: int, width: int, seed: int) -> np.ndarray:
    """About ``wanted`` vectors by hash, never more."""
    share = min(1.0, 2.0 * wanted / max(1, n))
    order = F.xxhash64("vector", F.lit(seed))
    few = nodes.where(F.pmod(order, F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    rows = few.orderBy(order, "node").limit(wanted).select("vector").collect()
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, :len(r["vector"])] = r["vector"]
    return out


def _nearest(best: list, k: int) -> list:
    """The ``k`` smallest of (score, id, ...) rows."""
    best.sort(key=lambda row: row[:2])
    return best[:k]


def calibrate(nodes: DataFrame, shared, width: int, k: int, sample: int, target: float, seed: int) -> tuple[int, int]:
    """(files to visit, footrule reach) with which ``target`` of the sampled queries' neighbours are found."""
    pivots: Pivots = shared.value
    asked = nodes.where("asked")
    questions = _drawn(asked, asked.count(), sample, width, seed)
    orders = pivots.order(questions, len(pivots.points))

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list] = [[] for _ in questions]
        for batch in batches:
            vectors = matrix(batch.column(1), width)
            for q, question in enumerate(questions):
                apart = distances(vectors, question)
                near = np.argsort(apart, kind="stable")[:k + 1]
                best[q] = _nearest(best[q] + [(apart[i], int(batch.column(0)[int(i)].as_py()), vectors[i]) for i in near], k + 1)
        rows = [(q, s, i, v) for q, found in enumerate(best) for s, i, v in found]
        pivots: Pivots = shared.value
        where = pivots.order(np.array([r[3] for r in rows]).reshape(-1, width), pivots.prefix)
        yield pa.RecordBatch.from_arrays([
            pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.float64()),
            pa.array([r[2] for r in rows], pa.int64()), lists(where, pa.int32())], names=["q", "score", "node", "order"])

    found = nodes.select("node", "vector").mapInArrow(searched, "q int, score double, node long, order array<int>")
    rank = F.row_number().over(Window.partitionBy("q").orderBy("score", "node"))
    truth = found.withColumn("_rank", rank).where(F.col("_rank") <= k + 1).collect()    # sample x (k + 1) rows
    met = []
    for r in truth:
        where = places(np.array([r["order"]]), len(pivots.points))
        meets = int((where[0, orders[r["q"]]] < pivots.prefix).argmax())
        met.append((meets + 1, int(footrule(where, orders[r["q"], :pivots.prefix])[0])))
    files = sorted(m for m, _ in met)[min(len(met) - 1, math.ceil((1 + target) / 2 * len(met)))]
    reach = sorted(f if m <= files else np.inf for m, f in met)[min(len(met) - 1, math.ceil(target * len(met)))]
    return files, int(reach) if np.isfinite(reach) else pivots.prefix * (pivots.prefix + 1)


_POSTED = "width int, pivot int, visitor boolean, node long, vector {vector}, ids array<long>, order array<int>"
_FOUND = "node long, id long, score double"


def _posting(shared, width: int, files: int):
    """Rows of the inverted files: every vector under its prefix, every visitor under its files."""

    def posted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots: Pivots = shared.value
        length = max(files, pivots.prefix)
        for whole in batches:
            for at in range(0, whole.num_rows, 1024):
                batch = whole.slice(at, 1024)
                orders = pivots.order(matrix(batch.column("vector"), width), length)
                parts = [(np.arange(len(orders)), orders[:, :pivots.prefix], False)]
                asked = np.nonzero(batch.column("asked").to_numpy(zero_copy_only=False))[0]
                if len(asked):
                    parts.append((asked, orders[asked, :files], True))
                for rows, under, visitor in parts:
                    each = pa.array(np.repeat(rows, under.shape[1]))
                    known = lists(orders if visitor else orders[:, :pivots.prefix], pa.int32())
                    yield pa.RecordBatch.from_arrays([
                        batch.column("width").take(each), pa.array(under.ravel(), pa.int32()), pa.array([visitor] * len(each)),
                        batch.column("node").take(each), batch.column("vector").take(each), batch.column("ids").take(each),
                        known.take(each)],
                        names=["width", "pivot", "visitor", "node", "vector", "ids", "order"])

    return posted


def _meeting(pivots: int, prefix: int, reach: int, k: int):
    def met(rows: pa.Table) -> pa.Table:
        visitor = rows["visitor"].to_numpy()
        home, seek = np.nonzero(~visitor)[0], np.nonzero(visitor)[0]
        out: list[tuple] = []
        if len(home) and len(seek):
            width, pivot = rows["width"][0].as_py(), rows["pivot"][0].as_py()
            vectors = matrix(rows["vector"], width)
            ids = rows["ids"].to_pylist()
            where = places(np.array(rows["order"].take(pa.array(home)).to_pylist()), pivots)
            nodes = rows["node"].to_numpy()
            for s in seek:
                order = np.array(rows["order"][int(s)].as_py())
                before = order[:int((order == pivot).argmax())]
                # a resident posted under an earlier pivot of this visitor is met there
                fresh = ~(where[:, before] < prefix).any(axis=1) & (footrule(where, order[:prefix]) <= reach)
                near = home[fresh]
                apart = distances(vectors[near], vectors[s])
                if len(near) > k + 1:
                    least = np.partition(apart, k)[k]
                    near, apart = near[apart <= least], apart[apart <= least]
                each = [(d, i) for d, r in zip(apart.tolist(), near) for i in ids[r]]
                out.extend((nodes[s], i, d) for d, i in _nearest(each, k + 1))
        node, ident, score = zip(*out) if out else ((), (), ())
        return pa.table({"node": pa.array(node, pa.int64()), "id": pa.array(ident, pa.int64()), "score": pa.array(score, pa.float64())})

    return met


def _search(nodes: DataFrame, shared, width: int, files: int, reach: int, k: int, block: int, only: DataFrame | None = None) -> DataFrame:
    """(node, found): the nearest ``k + 1`` (score, id) of every visitor, its own rows included."""
    pivots: Pivots = shared.value
    prefix, count = pivots.prefix, len(pivots.points)
    asked = nodes if only is None else nodes.drop("asked").join(only.withColumn("asked", F.lit(True)), "node", "left").withColumn(
        "asked", F.coalesce("asked", F.lit(False)))
    kind = dict(nodes.dtypes)["vector"]
    post = _posting(shared, width, files)
    posted, _ = materialise(asked.select("node", "width", "vector", "ids", "asked").mapInArrow(post, _POSTED.format(vector=kind)), "postings")
    file = ["width", "pivot"]
    sizes = posted.groupBy(*file).agg(
        F.ceil(F.count_if(~F.col("visitor")) / F.lit(block)).alias("homes"),
        F.ceil(F.count_if("visitor") / F.lit(block)).alias("seeks")).where("homes > 0 and seeks > 0")
    sizes, _ = materialise(sizes, "posting-sizes")      # stored, so that the join can split a hot file
    dealt = posted.join(sizes, file)
    own = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("long")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    columns = [*file, "visitor", "node", "vector", "ids", "order"]
    home = dealt.where("not visitor").select(*columns, own("homes").alias("home"), every("seeks").alias("seek"))
    seek = dealt.where("visitor").select(*columns, every("homes").alias("home"), own("seeks").alias("seek"))
    met = home.unionByName(seek).groupBy(*file, "home", "seek").applyInArrow(_meeting(count, prefix, reach, k), _FOUND)
    rank = F.row_number().over(Window.partitionBy("node").orderBy("score", "id"))
    best = met.withColumn("_rank", rank).where(F.col("_rank") <= k + 1)
    return best.groupBy("node").agg(F.sort_array(F.collect_list(F.struct("score", "id"))).alias("found"))    # k + 1 at most


def nearest_neighbours(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", query: str = "{id} % 100 = 0",
                       k: int = 10, prefix: int = 16, sample: int = 64, target: float = 0.97, pivots: int | None = None,
                       block: int = 1024, seed: int = 11) -> DataFrame:
    """(query_id, rank, <id_col>, score): the ``k`` nearest rows found for every row whose id fits ``query``.

    Nearness is the Euclidean distance in double precision, ties go to the smaller id; a query's
    own row is no candidate, all others are (all of them, if there are no more than ``k``).  Null,
    empty and zero vectors, those with a null or non-finite entry and rows with a null id take no
    part; vectors of different lengths are never compared.  Repeated rows: each is a candidate, and
    each asks; a row drops itself only.  An empty table gives no rows; columns but the two are not read.

    The pivots are about sqrt(n) drawn vectors (or ``pivots``), as many as fit ``PIVOT_BYTES`` at
    most; all vectors are indexed.  ``sample`` queries calibrate the search to find ``target`` of
    their neighbours (see the module)."""
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.select(quoted(id_col).cast("long").alias("id"), quoted(vector_col).alias("vector"))
    rows = rows.where(F.expr(f"id is not null and {usable('vector')}"))
    asked = rows.where(F.expr(query.format(id="id")))
    nodes, seen = materialise(_nodes(rows, asked, k), "nodes", {
        "n": F.count(F.lit(1)), "width": F.max("width"), "asked": F.count_if("asked")})
    out = f"query_id long, rank int, `{id_col}` long, score double"
    if not seen["asked"]:
        return spark.createDataFrame([], out)
    n, width = seen["n"], seen["width"]
    wanted = max(1, min(pivots or max(32, math.isqrt(n)), PIVOT_BYTES // (8 * width), n))
    points = _drawn(nodes, n, wanted, width, seed)
    model = Pivots(points, min(prefix, len(points)))
    shared = spark.sparkContext.broadcast(model)
    files, reach = calibrate(nodes, shared, width, k, sample, target, seed)
    found, _ = materialise(_search(nodes, shared, width, files, reach, k, block), "neighbours")
    # visitors that met fewer rows than their width has visit every file, without a reach
    there = nodes.groupBy("width").agg(F.sum(F.size("ids")).alias("there"))
    short = nodes.where("asked").join(there, "width").join(found, "node", "left").where(
        F.coalesce(F.size("found"), F.lit(0)) < F.least(F.lit(k + 1), F.col("there"))).select("node")
    short, missing = materialise(short, "short", {"n": F.count(F.lit(1))})
    if missing["n"]:
        whole = _search(nodes, shared, width, len(points), 2 ** 31 - 1, k, block, only=short)
        found = found.join(short, "node", "left_anti").unionByName(whole)
    answers = nodes.where("asked").select("node", F.col("vector").alias("_vector")).join(found, "node")
    each = asked.join(answers, asked["vector"] == answers["_vector"]).select("id", "found")
    mine = F.expr("array_position(found, named_struct('score', 0D, 'id', id))")     # 0: beyond the k + 1 smallest
    others = F.expr(f"slice(filter(found, (x, i) -> i + 1 <> _mine), 1, {k})")
    ranked = each.withColumn("_mine", mine).select("id", F.posexplode(others).alias("_place", "_found"))
    return ranked.select(F.col("id").alias("query_id"), (F.col("_place") + 1).cast("int").alias("rank"),
                         F.col("_found.id").alias(id_col), F.col("_found.score").alias("score"))


def op11_permutation_index(spark, sf_dir):
    return nearest_neighbours(table(spark, sf_dir, "embeddings"))
