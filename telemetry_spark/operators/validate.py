"""Acceptance checks: layer counts, duplicate keys and the four reconciliation checks.

All counts a check needs come from one aggregate over a tagged union of the layers (plus
the duplicate keys of Silver, found by a partial aggregate), so a run costs one job
instead of one job per count.  Results are appended to the audit store first; only then
does a failed check raise, naming every failed check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

LAYERS = ("bronze", "silver", "rejects", "gold_fact")
VALIDATION_COLUMNS = ("run_id", "check_name", "passed", "actual", "expected", "checked_at")


def duplicate_keys(df: DataFrame, keys: tuple[str, ...], by: tuple[str, ...] = ()) -> DataFrame:
    """One row per key (NULLs equal) that occurs more than once."""
    return df.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(*by, *keys)


def duplicate_key_count(df: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    return duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("duplicate_keys"))


def suspect_blocks(df: DataFrame, id_col: str) -> DataFrame:
    """Blocks of 32,768 ids (``bitmap_bucket_number``) with fewer distinct ids than rows.  A task
    sends one bitmap of 4 KB for each block it has rows of, so rows that lie by id cost about a bit
    of shuffle an id."""
    block, bit = f"bitmap_bucket_number(`{id_col}`)", f"bitmap_bit_position(`{id_col}`)"
    return df.where(f"`{id_col}` IS NOT NULL").selectExpr(f"{block} AS _block", f"{bit} AS _bit").groupBy("_block").agg(
        F.expr("bitmap_count(bitmap_construct_agg(_bit))").alias("_ids"), F.count(F.lit(1)).alias("_rows")
    ).where("_ids < _rows").select("_block")


def duplicate_keys_by_bitmap(df: DataFrame, keys: tuple[str, ...], suspects: DataFrame) -> DataFrame:
    """:func:`duplicate_keys` where the first key alone tells most rows apart.  ``suspects`` are the
    stored :func:`suspect_blocks` of that key: a key that occurs twice has its id in one of them, or no
    id.  Only those rows are grouped, so a clean table moves bitmaps instead of keys.  (Stored, so that
    the join is planned by their measured bytes, eight a block.)"""
    block = F.expr(f"bitmap_bucket_number(`{keys[0]}`)")
    doubtful = df.select(*keys).where(F.col(keys[0]).isNotNull()).join(suspects, block == F.col("_block"), "left_semi")
    return duplicate_keys(doubtful.unionByName(df.select(*keys).where(F.col(keys[0]).isNull())), keys)


def layer_counts(bronze: DataFrame, silver: DataFrame, rejects: DataFrame, fact: DataFrame) -> DataFrame:
    """(layer, rows) for the four layers, duplicates kept (UNION ALL of four counts)."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("layer"), "rows")
        for name, df in zip(LAYERS, (bronze, silver, rejects, fact))
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _tag(df: DataFrame, tag: str, by: tuple[str, ...], stamp: str | None = None) -> DataFrame:
    at = F.col(stamp) if stamp else F.lit(None).cast("timestamp")
    return df.select(*by, F.lit(tag).alias("_tag"), at.alias("_at"))


def check_counts(bronze: DataFrame, silver: DataFrame, rejects: DataFrame, fact: DataFrame,
                 dates: DataFrame, keys: tuple[str, ...], by: tuple[str, ...] = (),
                 stamp: str | None = None) -> DataFrame:
    """One row (per ``by`` group) with every count the checks need, from one aggregate;
    with ``stamp``, also the latest value of that Bronze column as ``_at``."""
    tagged = (
        _tag(bronze, "bronze", by, stamp)
        .unionByName(_tag(silver, "silver", by))
        .unionByName(_tag(rejects, "rejects", by))
        .unionByName(_tag(fact, "gold_fact", by))
        .unionByName(_tag(duplicate_keys(silver, keys, by), "dup", by))
        .unionByName(_tag(dates, "dates", by))
    )
    aggs = [F.count_if(F.col("_tag") == t).alias(t) for t in ("bronze", "silver", "rejects", "gold_fact", "dup", "dates")]
    aggs.append(F.max("_at").alias("_at"))
    return tagged.groupBy(*by).agg(*aggs) if by else tagged.agg(*aggs)


def checks_from_counts(counts: DataFrame, run_id: Column, checked_at: Column) -> DataFrame:
    """The four checks as rows (run_id, check_name, passed, actual, expected, checked_at)."""
    rows = F.expr(
        "stack(4,"
        " 'bronze_reconciles_to_silver_and_rejects', bronze = silver + rejects, bronze, silver + rejects,"
        " 'silver_key_is_unique', dup = 0, dup, 0L,"
        " 'gold_fact_matches_silver', gold_fact = silver, gold_fact, silver,"
        " 'gold_dimensions_are_populated', dates > 0, dates, 1L"
        ") AS (check_name, passed, actual, expected)"
    )
    return counts.select(run_id.alias("run_id"), checked_at.alias("checked_at"), rows).select(*VALIDATION_COLUMNS)


def validation_results(bronze, silver, rejects, fact, dates, keys, run_id: str, checked_at: str) -> DataFrame:
    counts = check_counts(bronze, silver, rejects, fact, dates, keys)
    return checks_from_counts(counts, F.lit(run_id), F.lit(checked_at).cast("timestamp"))


def validation_results_per_run(bronze, silver, rejects, fact, dates, keys) -> DataFrame:
    """Checks for every run found in the data (``_run_id``), stamped with the run's ingest
    time.  Every input frame must carry ``_run_id``; Bronze also ``_ingested_at``."""
    counts = check_counts(bronze, silver, rejects, fact, dates, keys, by=("_run_id",), stamp="_ingested_at")
    return checks_from_counts(counts, F.col("_run_id"), F.col("_at"))


def raise_on_failure(results: DataFrame) -> list[dict]:
    """Fail loudly, naming every failed check; returns the checks (a handful of rows)."""
    checks = [r.asDict() for r in results.collect()]
    failed = [c for c in checks if not c["passed"]]
    if failed:
        raise RuntimeError("not accepted: " + "; ".join(
            f"{c['check_name']} (found {c['actual']}, expected {c['expected']})" for c in failed))
    return checks
