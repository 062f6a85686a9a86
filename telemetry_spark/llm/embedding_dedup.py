"""Near duplicates among embeddings with an inverted multi-index.

Vectors are brought to unit length and cut in two halves; each half has a codebook of its own,
and the pairs of codewords form the grid of cells.  Every vector lives in the cell of its nearest
codewords.  A query visits cells in the order of a lower bound of the distance to anything in
them (multi-sequence traversal): per half, a vector whose nearest codeword is c lies beyond the
plane between c and the query's own codeword, and the squared distances of the halves add up.
Unit vectors of cosine t are sqrt(2 - 2t) apart, so the traversal may stop at the first cell whose
bound is larger: recall is then complete, not estimated.  The bound holds from either vector of a
pair, so a vector is copied only to visited cells numbered above its own.  What meets in a cell is
verified by the cosine in double precision.

Grids have 1, 4, 16... cells.  The vectors of a label use the smallest grid whose cells hold
``residents`` of them on average, so a label with a third of all rows has a fine grid and a label of
few has one cell.  Equal vectors are one node with a weight, so copies cost nothing; a cell's
residents and its visitors are dealt into blocks, and a pair of blocks is one matrix product that
returns weighted link counts and a spanning forest, never pairs.

The codebooks are fitted on about ``sample`` vectors (by hash, of 64 MB at most) and have at least
16 of them a codeword: beyond 4^10 cells a label, cells hold more and have more blocks.  Every vector is
indexed and queried.  Only the codebooks are broadcast.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.llm.common import materialise, quoted, ship_package, table
from telemetry_spark.llm.components import connected_components
from telemetry_spark.llm.vectors import matrix

SLACK = 1e-9              # of the bound, for rounding
TWINS = 1e-5              # codewords nearer than this are not told apart: rounding would outgrow the slack
INDEXED = 4096            # entries of a vector the index looks at; a bound over some entries holds for all
FIT_BYTES = 64 * 2**20    # of the sampled vectors
A_WORD = 16               # sampled vectors a codeword


def unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square over- or underflows."""
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt((scaled * scaled).sum(axis=1, keepdims=True))


def fit_codebook(points: np.ndarray, words: int, rounds: int = 12, seed: int = 3) -> np.ndarray:
    """Lloyd's algorithm from distinct sampled points."""
    distinct = np.unique(points, axis=0)
    words = min(words, len(distinct))
    book = distinct[np.random.default_rng(seed).choice(len(distinct), words, replace=False)]
    for _ in range(rounds):
        near = ((points * points).sum(1)[:, None] - 2 * points @ book.T + (book * book).sum(1)).argmin(axis=1)
        book = np.array([points[near == k].mean(axis=0) if (near == k).any() else book[k] for k in range(words)])
    return book


class MultiIndex:
    def __init__(self, first: np.ndarray, second: np.ndarray, cosine: float):
        self.books = (first, second)
        self.reach = 2.0 - 2.0 * cosine + SLACK
        # distances between the codewords of a half
        self.apart = [np.sqrt(np.maximum(((b[:, None] - b[None]) ** 2).sum(axis=2), 0)) for b in self.books]

    def bounds(self, points: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each half: the nearest codeword, and the squared lower bounds to all cells."""
        cut, out = self.books[0].shape[1], []
        for half, book, apart in zip((points[:, :cut], points[:, cut:]), self.books, self.apart):
            square = np.maximum((half * half).sum(1)[:, None] - 2 * half @ book.T + (book * book).sum(1), 0)
            own = square.argmin(axis=1)
            gap = apart[own]
            plane = (square - square[np.arange(len(half)), own][:, None]) / (2 * np.maximum(gap, TWINS))
            out.append((own, np.where(gap > TWINS, np.maximum(plane - SLACK, 0), 0.0) ** 2))
        return out

    def visits(self, first: np.ndarray, second: np.ndarray):
        """Cells (i, j) by rising bound first[i] + second[j], while it is within reach."""
        a, b = np.argsort(first, kind="stable"), np.argsort(second, kind="stable")
        heap, pushed = [(first[a[0]] + second[b[0]], 0, 0)], {(0, 0)}
        while heap:
            bound, i, j = heapq.heappop(heap)
            if bound > self.reach:
                return
            yield int(a[i]), int(b[j])
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(a) and y < len(b) and (x, y) not in pushed:
                    pushed.add((x, y))
                    heapq.heappush(heap, (first[a[x]] + second[b[y]], x, y))


def usable(vector: str) -> str:
    """SQL: a vector that can be compared (not null, no null or non-finite part, not zero)."""
    return (f"({vector} is not null and size({vector}) > 0"
            f" and forall({vector}, x -> x is not null and not isnan(x) and abs(x) < double('inf'))"
            f" and exists({vector}, x -> x <> 0))")


def indexed(vectors: np.ndarray, width: int) -> np.ndarray:
    """The entries of unit vectors that the index sees, filled up with zeros."""
    out = np.zeros((len(vectors), width))
    seen = min(width, vectors.shape[1])
    out[:, :seen] = unit(vectors)[:, :seen]
    return out


def _fit(nodes: DataFrame, n: int, width: int, largest: int, residents: int, sample: int, cosine: float) -> list[MultiIndex]:
    """Grids of 1, 4, 16... cells, up to the one the ``largest`` label needs."""
    sample = max(A_WORD, min(sample, FIT_BYTES // (8 * width)))
    draw = F.pmod(F.xxhash64("node", F.lit(5)), F.lit(1 << 40)) < int(min(1.0, sample / n) * (1 << 40)) + 1
    drawn = nodes.where(draw).select(F.slice("vector", 1, width).cast("array<double>").alias("vector"))
    points = matrix(drawn.limit(2 * sample).toArrow()["vector"], width)   # twice the expected number, never reached
    points = points[points.any(axis=1)]
    points = unit(points) if len(points) else np.zeros((1, width))
    cut, grids = max(1, width // 2), []
    while True:
        words = 2 ** len(grids)
        grids.append(MultiIndex(*(fit_codebook(half, words) if half.shape[1] else np.zeros((1, 0))
                                  for half in (points[:, :cut], points[:, cut:])), cosine))
        if words * words * residents >= largest or 2 * words * A_WORD > max(sample, 2 * A_WORD):
            return grids


def _deal(shared: Broadcast, width: int):
    """Every node in its own cell, and as a visitor in the cells above it that it must see."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grids = shared.value
        for rows in batches:
            levels = np.minimum(rows["level"].to_numpy(), len(grids) - 1)
            lengths = rows["width"].to_numpy()
            own, at, cells = np.zeros(rows.num_rows, np.int64), [], []
            for level, length in set(zip(levels.tolist(), lengths.tolist())):
                if level == 0:
                    continue
                grid, here = grids[level], np.nonzero((levels == level) & (lengths == length))[0]
                across = len(grid.books[1])
                for part in np.array_split(here, -(-len(here) * max(length, width, across) // 2**21)):
                    vectors = matrix(rows["vector"].take(pa.array(part)), length)
                    (own_a, bound_a), (own_b, bound_b) = grid.bounds(indexed(vectors, width))
                    own[part] = own_a * across + own_b
                    for k, row in enumerate(part.tolist()):
                        above = [c for i, j in grid.visits(bound_a[k], bound_b[k]) if (c := i * across + j) > own[row]]
                        at += [row] * len(above)
                        cells += above
            place = np.concatenate([np.arange(rows.num_rows), np.array(at, np.int64)])
            cell = np.concatenate([own, np.array(cells, np.int64)])
            visitor = np.arange(len(place)) >= rows.num_rows
            batch = max(1, 2**22 // int(max(lengths, default=1)))
            for k in range(0, len(place), batch):
                copied = rows.take(pa.array(place[k:k + batch]))
                yield pa.RecordBatch.from_arrays(
                    [*copied.columns, pa.array(cell[k:k + batch]), pa.array(visitor[k:k + batch])],
                    names=[*rows.schema.names, "cell", "visitor"])

    return dealt


def spanning_roots(linked: np.ndarray, names: np.ndarray) -> np.ndarray:
    """For each node of a symmetric link matrix the smallest of ``names`` in its component."""
    root, unseen = names.copy(), np.ones(len(names), bool)
    for start in np.argsort(names, kind="stable"):
        if not unseen[start]:
            continue
        unseen[start], todo = False, [start]
        while todo:
            new = np.nonzero(linked[todo.pop()] & unseen)[0]
            unseen[new] = False
            root[new] = names[start]
            todo += new.tolist()
    return root


_GROUP = ("label", "width", "cell", "first", "second")
_LINKED = pa.schema([("node", pa.int64()), ("id", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def _compare(cosine: float):
    """Two blocks of a cell against each other, or one against itself."""

    def compared(rows: pa.Table) -> pa.Table:
        nodes, ids, weights = (rows[c].to_numpy() for c in ("node", "id", "weight"))
        vectors = unit(matrix(rows["vector"], rows["width"][0].as_py()))
        home = rows["home"].to_numpy()
        here, there = np.nonzero(home)[0], np.nonzero(~home)[0]
        alone = rows["first"][0].as_py() == rows["second"][0].as_py()
        if not len(here) or not (alone or len(there)):
            return _LINKED.empty_table()
        linked = np.zeros((len(rows), len(rows)), bool)
        other = here if alone else there
        for part in np.array_split(here, -(-len(here) // 512)):
            near = vectors[part] @ vectors[other].T >= cosine
            linked[np.ix_(part, other)] = near
            linked[np.ix_(other, part)] = near.T
        np.fill_diagonal(linked, False)
        some = np.nonzero(linked.any(axis=1))[0]
        linked = linked[np.ix_(some, some)]
        links = np.array([weights[some[row]].sum() for row in linked], np.int64)
        return pa.table([nodes[some], ids[some], links, spanning_roots(linked, nodes[some])], schema=_LINKED)

    return compared


def embedding_links(vectors: DataFrame, cosine: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str | None = "label", residents: int = 4096, block: int = 4096, sample: int = 16_384) -> DataFrame:
    """(id, n_links, component_id, kept) for every row of ``vectors``.

    Vectors are compared within a label only (all together if ``label_col`` is None) and linked
    from the given cosine on.  A null, empty or zero vector, one with a null or non-finite part, and one
    with a null label have no links.  Vectors of different lengths are never linked.  Repeated
    rows link each other like any equal vectors; rows of one id with different vectors are vectors
    each by itself; ids are integers, and a null id is its own, null
    component; other columns are not read; an empty table gives no rows.

    ``residents`` is the number of nodes a cell has on average, at most; blocks hold ``block`` rows, or
    fewer of long vectors (16 MB)."""
    ship_package(vectors.sparkSession)
    label = quoted(label_col).cast("string") if label_col else F.lit("")
    kind = vectors.select(quoted(vector_col)).schema[0].dataType
    exact = "array<float>" if isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.FloatType) else "array<double>"
    rows = vectors.select(quoted(id_col).cast("long").alias("id"), label.alias("label"),
                          quoted(vector_col).cast(exact).alias("vector"))
    good = F.expr(f"id is not null and label is not null and {usable('vector')}")
    nodes = rows.where(good).groupBy("label", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("weight"))
    nodes, seen = materialise(
        nodes.select(F.monotonically_increasing_id().alias("node"), "id", "label", F.size("vector").alias("width"), "vector", "weight"),
        "vectors", {"n": F.count(F.lit(1)), "width": F.max("width")})
    if not seen["n"]:
        return _shown(rows.select("id", F.lit(0).alias("n_links"), F.col("id").alias("component")), id_col)
    # the smallest level with 4^level cells of ``residents`` nodes
    level = F.greatest(F.lit(0), F.ceil(F.log2(F.col("nodes") / F.lit(residents)) / 2)).cast("int")
    labels, most = materialise(nodes.groupBy("label", "width").agg(F.count(F.lit(1)).alias("nodes")).withColumn("level", level),
                               "labels", {"largest": F.max("nodes")})
    width = min(seen["width"], INDEXED)
    grids = vectors.sparkSession.sparkContext.broadcast(_fit(nodes, seen["n"], width, most["largest"], residents, sample, cosine))
    dealt = nodes.join(labels.select("label", "width", "level"), ["label", "width"])
    schema = T.StructType([*dealt.schema, T.StructField("cell", T.LongType()), T.StructField("visitor", T.BooleanType())])
    dealt, _ = materialise(dealt.mapInArrow(_deal(grids, width), schema), "cells")
    rows_a_block = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(16 * 2**20) / (8 * F.col("width")))))
    sizes = dealt.groupBy("label", "width", "cell").agg(
        F.ceil(F.count_if(~F.col("visitor")) / rows_a_block).alias("residents"),
        F.ceil(F.count_if("visitor") / rows_a_block).alias("visitors")).where("residents > 0")
    sizes, _ = materialise(sizes, "cell-sizes")   # so that the join can split a hot cell
    placed = dealt.join(sizes, ["label", "width", "cell"]).select(
        "label", "width", "cell", "node", "id", "vector", "weight", "residents", "visitors", "visitor",
        F.expr("if(visitor, residents + pmod(xxhash64(node), greatest(visitors, 1)), pmod(xxhash64(node), residents))").alias("own"))
    # residents meet all blocks of their cell, their own too; visitors meet the residents
    met = placed.withColumn("other", F.explode(F.expr("sequence(0L, if(visitor, residents, residents + visitors) - 1)"))).select(
        "label", "width", "cell", "node", "id", "vector", "weight", F.least("own", "other").alias("first"),
        F.greatest("own", "other").alias("second"), (F.col("own") <= F.col("other")).alias("home"))
    linked, _ = materialise(
        met.groupBy(*_GROUP).applyInArrow(_compare(cosine), "node long, id long, links long, root long"), "vector-links")
    component = connected_components(linked.where("node <> root"), "node", "root").withColumnRenamed("node", "member")
    links = linked.groupBy("node").agg(F.sum("links").alias("links"), F.min("id").alias("id"))
    links, _ = materialise(
        links.join(component, F.col("node") == F.col("member"), "left").select(
            "node", "links", "id", F.coalesce("component", "node").alias("tree")), "node-links")
    least, _ = materialise(links.groupBy("tree").agg(F.min("id").alias("component")), "least-ids")
    settled = (
        nodes.select("node", "id", "label", "vector", "weight").join(links.join(least, "tree").select("node", "links", "component"), "node", "left")
        .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                F.coalesce("component", "id").alias("component")))
    # rows that are in no node keep to themselves
    found = rows.join(settled, ["label", "vector"], "left").select(
        "id", F.expr("if(id is null, 0, coalesce(n_links, 0))").alias("n_links"),
        F.expr("if(id is null, null, coalesce(component, id))").alias("component"))
    return _shown(found, id_col)


def _shown(found: DataFrame, id_col: str) -> DataFrame:
    return found.select(F.col("id").alias(id_col), F.col("n_links").cast("long").alias("n_links"),
                        F.col("component").alias("component_id"), F.col("id").eqNullSafe(F.col("component")).alias("kept"))


def op7_embedding_dedup(spark, sf_dir):
    return embedding_links(table(spark, sf_dir, "embeddings"))
