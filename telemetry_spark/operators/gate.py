"""The Silver quality gate: typing, duplicate ranking, row rules, reasons and routing.

Typing uses ``try_cast`` / ``try_to_timestamp``: an unparsable value becomes NULL and the
matching rule names the row, instead of the ANSI cast raising for the whole job.  Every
rule is a native boolean (one struct field per rule); the rejection reason is derived
from those flags, so rule counts never have to re-split reason text.

A line that did not fit its header (``_raw_line``, where landing keeps it) is rejected as
``ragged_line``, before the reasons the rules find in its missing fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telemetry_spark.functions.rules import DUPLICATE_FLAG, REASON_SEPARATOR, flags_struct_sql, q, reason_sql, text
from telemetry_spark.model import TelemetryModel
from telemetry_spark.operators.dedupe import flag_duplicates
from telemetry_spark.session import ensure_utc
from telemetry_spark.sources.landing import RAW_LINE

RAW_ID, RAW_TS = "raw_reading_id", "raw_timestamp"
POSITION = "_position"
ORDER_COLUMNS = ("_source_file", "_block_start", "_row_seq")
RAGGED = "ragged_line"
LINEAGE = ("_source_file", "_ingested_at", "_run_id", "_block_start", "_row_seq")
FLAGS = "_flags"
REASON = "rejection_reason"
REJECT_ONLY = (RAW_ID, RAW_TS, FLAGS, REASON, RAW_LINE)  # what accepted Silver does not carry


def typed_columns_sql(model: TelemetryModel) -> list[str]:
    id_src, ts_src = model.id_source, model.ts_source
    id_dst, ts_dst = model.columns[0][1], model.columns[1][1]
    return [
        f"{q(id_src)} AS {RAW_ID}",
        f"{q(ts_src)} AS {RAW_TS}",
        f"try_cast({q(id_src)} AS BIGINT) AS {q(id_dst)}",
        f"try_to_timestamp({q(ts_src)}) AS {q(ts_dst)}",
        *[f"try_cast({q(src)} AS DOUBLE) AS {q(dst)}" for src, dst in model.columns[2:]],
        *[q(c) for c in LINEAGE],
    ]


def typed_projection(bronze: DataFrame, model: TelemetryModel) -> DataFrame:
    """Raw key strings kept beside the typed key; sensors renamed to Silver names as double;
    the model's equipment id as a literal.  One model describes one unit: the duplicate key and
    the equipment dimension know no other.  ``_position`` and ``_raw_line`` come along where Bronze
    has them."""
    ensure_utc(bronze.sparkSession)
    unit = F.lit(model.equipment.equipment_id).alias("equipment_id")
    landed = [c for c in (RAW_LINE, POSITION) if c in bronze.columns]
    return bronze.select(*[F.expr(e) for e in typed_columns_sql(model)], unit, *landed)


def order_columns(typed: DataFrame) -> tuple[str, ...]:
    """What the file order of a row is read from."""
    return (POSITION, ORDER_COLUMNS[-1]) if POSITION in typed.columns else ORDER_COLUMNS


def key_columns(model: TelemetryModel) -> tuple[str, str]:
    return model.columns[0][1], model.columns[1][1]


def with_duplicate_flag(typed: DataFrame, model: TelemetryModel, **dedupe_options) -> DataFrame:
    return flag_duplicates(typed, key_columns(model), order_columns(typed), flag=DUPLICATE_FLAG, **dedupe_options)


def apply_gate(bronze: DataFrame, model: TelemetryModel, **dedupe_options) -> DataFrame:
    """Typed rows + ``_flags`` (one boolean per rule) + ``rejection_reason`` ('' = accepted).
    ``dedupe_options`` go to :func:`flag_duplicates`."""
    typed = typed_projection(bronze, model)
    return judged(with_duplicate_flag(typed, model, **dedupe_options), model)


def judged(flagged: DataFrame, model: TelemetryModel) -> DataFrame:
    """Typed rows with their duplicate flag -> the gate's columns."""
    keep = [q(c) for c in flagged.columns if c not in (DUPLICATE_FLAG, POSITION)]
    with_flags = flagged.selectExpr(*keep, f"{flags_struct_sql(model)} AS {FLAGS}")
    reason = reason_sql(model.rule_names, FLAGS + ".")
    if RAW_LINE in flagged.columns:
        ragged = f"CASE WHEN {RAW_LINE} IS NOT NULL THEN {text(RAGGED)} END"
        reason = f"concat_ws({text(REASON_SEPARATOR)}, {ragged}, nullif({reason}, ''))"
    return with_flags.selectExpr(*keep, FLAGS, f"{reason} AS {REASON}")


def accepted(gated: DataFrame) -> DataFrame:
    """Silver: rows no rule names, without raw keys, flags or reason."""
    cols = [c for c in gated.columns if c not in REJECT_ONLY]
    return gated.where(f"{REASON} = ''").select(*cols)


def rejected(gated: DataFrame) -> DataFrame:
    """Rejects: rows with at least one reason; raw keys and the reason are kept."""
    cols = [c for c in gated.columns if c != FLAGS]
    return gated.where(f"{REASON} <> ''").select(*cols)


def flag_columns(model: TelemetryModel) -> list[Column]:
    """The per-rule flags of a gated frame as top-level boolean columns."""
    return [F.col(f"{FLAGS}.{n}").alias(n) for n in model.rule_names]
