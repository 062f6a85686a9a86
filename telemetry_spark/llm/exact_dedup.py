"""Exact duplicates by skew-safe combining.

Texts are equal when identical after deleting every ASCII white-space character.  Of equal
texts the row with the most code points in its original text stays, then the smallest id.

Stages, each grouping on the digest *and* the full normalised content, so equal digests of
different contents never merge:

1. local: every task combines its own rows (the map side of the first aggregation);
2. salted: the task winners of one digest meet on up to ``salts`` reducers;
3. global: the at most ``salts`` salt winners of each content meet.

A third of all rows with one text thus costs one row per task, then ``salts`` rows.  The
winner is carried as one fixed-width number (length, whether there is an id, reversed id), so that every stage
is a hash aggregation with constant-size state.  The decision returns to the documents
through a join on SHA-256, MD5 and length of the content; only these narrow columns are
shuffled there, and adaptive execution splits a hot digest (the document side has one row
per document and the other one row per content).

Defined results: a null text counts as empty and all empty texts are one group; rows that
repeat an id with an equal text share the decision; an empty table gives no rows; columns
other than id and text are not read.  Ids are integers; a null id loses ties, but the longest
text stays even if its id is null: then ``keep_id`` is null and the group's rows without an id
are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.llm.common import WHITESPACE, free_name, materialise, quoted, table
from telemetry_spark.llm.rows import first_rows, shared_ids, with_id_in

ID_SPAN = 2**63


def normalised(text: Column) -> Column:
    return F.regexp_replace(text, WHITESPACE + "+", "")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row per document: id, content and its digests."""
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    rows = docs.select(quoted(id_col).cast("long").alias("id"), F.length(text).alias("points"), normalised(text).alias("content"))
    return rows.select(
        "id", "points", "content",
        F.sha2("content", 256).alias("sha"), F.md5("content").alias("md5"), F.octet_length("content").alias("n_bytes"),
    )


def content_winners(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 8) -> DataFrame:
    """One row per distinct content: its digests, the id that stays and the group's size."""
    rows = _keyed(docs, id_col, text_col).select(
        "sha", "md5", "n_bytes", "content",
        # longest text first, then the smallest id: 2^64 .. 2^65 - 1, none is 0
        F.expr(f"cast(cast(points as decimal(10,0)) * {4 * ID_SPAN}BD + coalesce({3 * ID_SPAN - 1}BD - id, 0BD)"
               " as decimal(38,0))").alias("rank"),
        F.pmod(F.spark_partition_id(), F.lit(salts)).alias("salt"),
    )
    content = ["sha", "md5", "n_bytes", "content"]
    salted = rows.groupBy(*content, "salt").agg(
        F.max("rank").alias("rank"), F.count(F.lit(1)).alias("rows"))
    merged = salted.groupBy(*content).agg(
        F.max("rank").alias("rank"), F.sum("rows").alias("group_size"))
    return merged.select(
        "sha", "md5", "n_bytes", "group_size",
        F.expr(f"if(rank % {4 * ID_SPAN}BD = 0BD, null, cast({3 * ID_SPAN - 1}BD - rank % {4 * ID_SPAN}BD as bigint))").alias("keep_id"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 8) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row of ``docs``."""
    winners = content_winners(docs, id_col, text_col, salts)
    rows = _keyed(docs, id_col, text_col).select("id", "sha", "md5", "n_bytes")
    joined = rows.join(winners, ["sha", "md5", "n_bytes"])
    return joined.select(
        F.col("id").alias(id_col), "keep_id", F.col("group_size").cast("long").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.col("sha").alias("text_sha256"),
    )


def surviving_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", salts: int = 8) -> DataFrame:
    """One row of ``docs`` for each content, with all its columns: the longest original text, then the
    smallest id (none comes last), then the first by its columns.

    A winner whose id is on no other row is chosen by its id, so copies are dropped before texts are
    compared again.  Ids that several rows share, and rows without one, are told apart by content: of
    rows repeated with their id one stays, and an id that wins with one text keeps no other by it.
    Null texts count as empty, and all empty texts are one content; no rows give no rows; columns of
    any name stay as they are."""
    winners, _ = materialise(content_winners(docs, id_col, text_col, salts), "contents")
    shared, several = shared_ids(docs, id_col)
    alone = with_id_in(winners, "keep_id", shared, "left_anti")
    kept = with_id_in(docs, id_col, alone.select("keep_id"))
    if not several:
        return kept
    mark = {c: free_name(docs, f"_{c}") for c in ("sha", "md5", "n_bytes", "points", "content", "winner")}
    text = F.coalesce(quoted(text_col).cast("string"), F.lit(""))
    digests = [mark["sha"], mark["md5"], mark["n_bytes"]]
    rows = with_id_in(docs, id_col, shared).withColumn(mark["content"], normalised(text))
    rows = rows.select(*[quoted(c) for c in docs.columns], F.length(text).alias(mark["points"]),
                       F.sha2(mark["content"], 256).alias(mark["sha"]), F.md5(mark["content"]).alias(mark["md5"]),
                       F.octet_length(mark["content"]).alias(mark["n_bytes"]))
    longest = first_rows(rows, [*map(quoted, digests), quoted(id_col)], [quoted(mark["points"]).desc(), quoted(text_col)])
    won = winners.select(F.col("sha").alias(mark["sha"]), F.col("md5").alias(mark["md5"]),
                         F.col("n_bytes").alias(mark["n_bytes"]), F.col("keep_id").alias(mark["winner"]))
    same = quoted(id_col).cast("long").eqNullSafe(won[mark["winner"]])
    for c in digests:
        same = same & (longest[c] == won[c])
    return kept.unionByName(longest.join(won, same, "left_semi").select(*[quoted(c) for c in docs.columns]))


def op9_exact_dedup(spark, sf_dir):
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH n AS (
  SELECT doc_id, length(coalesce(text, '')) AS points,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
  FROM documents
), w AS (
  SELECT doc_id, sha256(content) AS text_sha256,
         first_value(doc_id) OVER (PARTITION BY content ORDER BY points DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY content) AS group_size
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""
