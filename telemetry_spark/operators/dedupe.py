"""Deterministic duplicate detection, one plan at every size.

Semantics: rows sharing a key (NULLs compare equal, as in ``GROUP BY``) are ranked by a
unique order key; the first row is kept and every later row is a duplicate.  This is
``row_number() OVER (PARTITION BY key ORDER BY order) > 1``.

A window would hash the whole table on the key and sort each key's rows in one task, so a
hot key -- a replayed file, or every row whose key failed to parse, which all share
(NULL, NULL) -- lands in one task.  Instead:

1. The order of a row is one fixed-width number, a decimal of two longs: where its split starts in
   all landed files laid end to end, and its sequence.  Bronze stores both, so the order costs
   nothing.  Of rows that only know (file name, split offset, sequence) the file names are ranked
   first, a table of one row a file that one task orders, and the rows are scanned twice more.
2. ``groupBy(key).agg(count, min(order))`` keeps the keys seen more than once.  Both are
   fixed-width, so this is a hash aggregate whose map side combines: a hot key costs one row
   per input partition before the shuffle.
3. The readings are left-joined with those keys, without a hint: adaptive execution broadcasts
   the table if its measured bytes allow it; beyond that it is a shuffle join in which the
   partitions of a hot key are split (the other side has one row per key).

Nothing runs while the plan is built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

ORDER = "_order"
FILE_DIGITS, OFFSET_DIGITS, SEQUENCE_DIGITS = 7, 12, 19  # 38 in all, the widest decimal


def with_order(df: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """``df`` with its place as one decimal: (position, sequence), any two longs from 0 on, or (file
    name, split offset, sequence), of which more than 10^7 files or an offset of 10^12 and more
    raise instead of wrapping round."""
    cols = [f"`{c}`" for c in df.columns]
    number = lambda c, digits: f"cast({c} as decimal({digits},0))"
    if len(order) == 2:
        position, sequence = order
        packed = f"{number(f'`{position}`', 19)} * 1{'0' * 19}BD + {number(f'`{sequence}`', 19)}"
        return df.selectExpr(*cols, f"cast({packed} as decimal(38,0)) AS {ORDER}")
    file, offset, sequence = order
    names = df.select(F.col(f"`{file}`").alias("_name")).distinct()
    numbers = names.select("_name", F.row_number().over(Window.orderBy("_name")).alias("_number"))
    packed = (
        f"{number('_number', FILE_DIGITS)} * 1{'0' * (OFFSET_DIGITS + SEQUENCE_DIGITS)}BD"
        f" + {number(f'`{offset}`', OFFSET_DIGITS)} * 1{'0' * SEQUENCE_DIGITS}BD"
        f" + {number(f'`{sequence}`', SEQUENCE_DIGITS)}"
    )
    return df.join(numbers, F.expr(f"`{file}` <=> _name")).selectExpr(*cols, f"cast({packed} as decimal(38,0)) AS {ORDER}")


def duplicated_keys(ordered: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Keys with more than one row and the order of their first row."""
    return (
        ordered.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_n"), F.min(ORDER).alias("_first"))
        .where("_n > 1")
        .drop("_n")
    )


def flag_duplicates(df: DataFrame, keys: tuple[str, ...], order: tuple[str, ...], flag: str = "_is_duplicate",
                    join_hint: str | None = None) -> DataFrame:
    """``df`` with a non-NULL boolean ``flag``: True for every row after the first of its key.

    ``join_hint`` names a join strategy for the last step (``shuffle_merge`` to see the plan of
    tables too large to broadcast); by default adaptive execution decides."""
    ordered = with_order(df, order)
    renamed = [f"_dk_{k}" for k in keys]
    first = duplicated_keys(ordered, keys).withColumnsRenamed(dict(zip(keys, renamed)))
    if join_hint:
        first = first.hint(join_hint)
    same = " AND ".join(f"`{k}` <=> `{r}`" for k, r in zip(keys, renamed))
    cols = [f"`{c}`" for c in df.columns]
    return ordered.join(first, F.expr(same), "left").selectExpr(*cols, f"coalesce({ORDER} > _first, false) AS `{flag}`")
