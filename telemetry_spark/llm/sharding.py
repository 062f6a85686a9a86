"""Minimax contiguous partition of documents into shards.

Atomic groups are the documents of one text, ordered by the SHA-256 of the text, and a
shard is a contiguous range of that order.  A document's shard then follows from its own
digest and the ``shards - 1`` cuts, without a join, and a group is never split.

The smallest feasible capacity is found by binary search; a capacity is checked greedily:
walk the groups, close a shard when the next group would exceed the capacity.  The shards are
then cut within that capacity, each as near to an even share as the rest allows.  A group
larger than the capacity stands alone in its shard (nothing can make its shard smaller, and the other
shards still come out even).  The walk needs running sums, which are kept hierarchically
so that neither the driver nor a task ever holds all groups: the order is summed by digest
prefix, 4096 ways, and only some prefixes are divided further.

First come prefixes of several groups above an even share (fewer than ``shards``), until a
group that large is a prefix of its own.  Then the search runs twice: with every prefix as one
indivisible group (upper bound: contiguous pieces of groups can only do better) and with
prefixes that can be cut anywhere (lower bound).  ``PROBES`` capacities between the bounds are
walked, and the prefixes their cuts enter are divided.  When no cut enters one, the bounds have
met.  One collection so never brings the driver more than shards x 4096 rows, whatever the
number of documents and however large a group is.

Slots are gapless from 0 in each shard: documents fall into lanes (as many as the table needs) by a hash of their id,
lanes are offset by counts, and inside a lane the order is the id, so that a shard with one
huge group is numbered by many tasks.

Defined results: a null text is empty (size 8, crc32 of nothing) and grouped with empty
texts; repeated rows get slots of their own; an empty table gives no rows; fewer groups than
shards leave shards empty.
"""

from __future__ import annotations

import math
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telemetry_spark.llm.common import materialise, quoted, table

OVERHEAD = 8
DIGITS = 3          # hexadecimal digits a level: 4096 prefixes
PROBES = 16         # capacities walked at once; their cuts enter at most PROBES x (shards - 1) prefixes
FINER = 2           # digits more for those, so that PROBES x 16 ** FINER = 4096


def sized_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, size, text_crc32, digest) for every document; the texts are read here only."""
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    return docs.select(
        quoted(id_col).alias("id"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.sha2(text, 256).alias("digest"),
    )


class Prefix:
    """Groups whose digests begin alike: total size, and whether they are one group."""

    __slots__ = ("key", "size", "single")

    def __init__(self, key: str, size: int, single: bool):
        self.key, self.size, self.single = key, size, single


def _summed(rows: DataFrame, digits: int, within: list[str], shards: int) -> list[Prefix]:
    """The prefixes ``digits`` digits longer than the given ones, which are disjoint, in order."""
    most = shards * 16 ** DIGITS
    assert len(within) * 16 ** digits <= most
    if within == [""]:
        rows = rows.withColumn("parent", F.lit(""))
    else:
        wanted = rows.sparkSession.createDataFrame([(k,) for k in within], "parent string")
        lengths = sorted({len(k) for k in within})
        starts = F.array(*[F.substring("digest", 1, n) for n in lengths])
        rows = rows.withColumn("parent", F.explode(starts)).join(F.broadcast(wanted), "parent", "left_semi")
    found = (
        rows.groupBy(F.col("digest").substr(F.lit(1), F.length("parent") + digits).alias("key"))
        .agg(F.sum("size").alias("size"), (F.min("digest") == F.max("digest")).alias("single"))
        .collect()  # at most 16 ** digits rows for each parent
    )
    assert len(found) <= most
    return sorted((Prefix(r["key"], int(r["size"]), bool(r["single"])) for r in found), key=lambda p: p.key)


def greedy_cuts(prefixes: list[Prefix], capacity: int, divisible: bool) -> list[tuple[int, int]]:
    """Ends of the shards in a greedy walk: (index of the prefix the shard ends in or
    before, size of that prefix already used).  ``divisible``: prefixes of several groups
    can be cut anywhere, else they are atomic."""
    cuts: list[tuple[int, int]] = []
    held = 0
    for i, p in enumerate(prefixes):
        if divisible and not p.single:
            used = 0
            while held + (p.size - used) > capacity:
                used += capacity - held
                cuts.append((i, used))
                held = 0
            held += p.size - used
        elif held + p.size <= capacity:
            held += p.size
        else:
            if held:
                cuts.append((i, 0))
            held = p.size
            if p.size > capacity:
                if not p.single:    # several groups, which must not pass for one
                    return cuts + [(i, 0)] * len(prefixes)
                if i + 1 < len(prefixes):
                    cuts.append((i + 1, 0))
                held = 0
    return cuts


def even_cuts(prefixes: list[Prefix], capacity: int, shards: int) -> list[int]:
    """Starts of the shards after the first, no shard above the capacity (but for a lone group
    that is larger): each ends as near as it can to an even share of what is left, as long as
    the rest still fits into the shards left."""
    n = len(prefixes)
    sizes = [p.size for p in prefixes]
    before = [0, *accumulate(sizes)]
    reach, end = [0] * n, n          # the furthest end of a shard that starts here
    needed, giants = [0] * (n + 1), [0] * (n + 1)
    rest = [0] * (n + 1)             # sizes to come, without groups that stand alone
    for i in range(n - 1, -1, -1):
        while end > i + 1 and before[end] - before[i] > capacity:
            end -= 1
        reach[i] = end
        needed[i] = 1 + needed[end]
        alone = sizes[i] > capacity
        giants[i], rest[i] = giants[i + 1] + alone, rest[i + 1] + (0 if alone else sizes[i])
    cuts, at, left = [], 0, shards
    while at < n and left > 1:
        share = rest[at] / max(1, left - giants[at])
        ends = [j for j in range(at + 1, reach[at] + 1) if needed[j] <= left - 1]
        at = min(ends, key=lambda j: abs(before[j] - before[at] - share))
        left -= 1
        if at < n:
            cuts.append(at)
    return cuts


def smallest_capacity(prefixes: list[Prefix], shards: int, divisible: bool) -> int:
    lo, hi = 0, max(1, sum(p.size for p in prefixes))   # lo is infeasible, hi feasible
    while hi - lo > 1:
        mid = (lo + hi) // 2
        if mid and len(greedy_cuts(prefixes, mid, divisible)) < shards:
            hi = mid
        else:
            lo = mid
    return hi


def find_cuts(rows: DataFrame, shards: int) -> list[str]:
    """At most ``shards - 1`` digest prefixes, in order; shard k begins at cut k."""
    prefixes = _summed(rows, DIGITS, [""], shards)
    if not prefixes:
        return []
    total = sum(p.size for p in prefixes)
    while True:
        inside = {i for i, p in enumerate(prefixes) if not p.single and p.size * shards > total}
        digits = DIGITS
        if not inside:
            low = smallest_capacity(prefixes, shards, divisible=True)
            high = smallest_capacity(prefixes, shards, divisible=False)
            probes = {low + (high - low) * j // PROBES for j in range(PROBES)}
            inside = {i for c in probes for i, used in greedy_cuts(prefixes, c, True) if used and not prefixes[i].single}
            digits = FINER
        if not inside:      # the walk at ``low`` cuts no prefix, so ``high`` is the same
            return [prefixes[i].key for i in even_cuts(prefixes, high, shards)]
        finer = _summed(rows, digits, [prefixes[i].key for i in sorted(inside)], shards)
        prefixes = sorted([p for i, p in enumerate(prefixes) if i not in inside] + finer, key=lambda p: p.key)


def shard_of(digest: Column, cuts: list[str]) -> Column:
    """The number of cuts at or before a digest."""
    return F.lit(0) if not cuts else F.size(F.filter(F.array(*[F.lit(c) for c in cuts]), lambda c: c <= digest))


def shard_documents(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text",
                    lane_rows: int = 4_000_000) -> DataFrame:
    """(id, size, text_crc32, shard, slot) for every document.

    A null text counts as empty; texts may be of any length; equal texts stay together; slots follow
    the id within a lane of about ``lane_rows`` rows, ties (repeated rows) in any order; a null id is a row like any
    other; other columns are not read; an empty table gives no rows."""
    rows, seen = materialise(sized_documents(docs, id_col, text_col), "shard-sizes", {"n": F.count(F.lit(1))})
    lanes = max(256, math.ceil(seen["n"] / lane_rows))     # a single shard may hold most rows
    cuts = find_cuts(rows, shards)
    dealt = rows.select(
        "id", "size", "text_crc32", shard_of(F.col("digest"), cuts).cast("int").alias("shard"),
        F.pmod(F.xxhash64("id", "digest"), F.lit(lanes)).cast("int").alias("lane"),
    )
    # shards x lanes rows
    counts = dealt.groupBy("shard", "lane").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("shard", "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    inside = Window.partitionBy("shard", "lane").orderBy("id", "text_crc32", "size")
    numbered = dealt.withColumn("position", F.row_number().over(inside))
    return numbered.join(starts, ["shard", "lane"]).select(
        F.col("id").alias(id_col), "size", "text_crc32", "shard", (F.col("start") + F.col("position") - 1).alias("slot"))


def op8_minimax_shards(spark, sf_dir):
    dealt = shard_documents(table(spark, sf_dir, "documents"))
    return dealt.select(
        "doc_id", "size", F.col("text_crc32").cast("long").alias("text_crc32"), F.lit("bytes").alias("law"),
        "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
