"""One declarative model of the telemetry contract.

Everything the pipeline needs to know about a feed lives here: the source
columns and their Silver names, the column groups, the ordered row rules, the
anomaly rules, the expected event window, the nominal cadence, the equipment
and the known failure intervals.  The rest of the package compiles this model
into Spark ``Column`` expressions and DataFrame plans, so a threshold or a
sensor is declared once and never re-typed in SQL text or Python row code.

Two presets exist:

* :func:`compressor` -- the published contract of the compressor air-production
  unit feed (2020 readings, 10 s cadence, four published failure intervals);
* :func:`events_feed` -- the same contract re-parameterised for the feed that
  :mod:`telemetry_spark.sources.feed` derives from the driver ``events`` table
  (January 2024 readings, 360 expected readings a day, five test intervals).
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Rule:
    """A named row-level quality rule.

    ``kind`` is one of

    * ``unparsed``      -- the typed value of ``columns[0]`` is NULL;
    * ``outside_window``-- ``columns[0]`` is non-NULL and not in [window_start, window_end);
    * ``any_null``      -- any member of ``columns`` is NULL;
    * ``outside_range`` -- any member is outside [low, high] (ends inclusive);
    * ``not_allowed``   -- any member is not one of ``allowed``;
    * ``below``         -- ``columns[0] < low``;
    * ``duplicate``     -- the row is not the first row of its key.

    Group rules fold their members with OR under SQL three-valued logic: a NULL
    member does not fire the rule, another bad member still does.
    """

    name: str
    kind: str
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    allowed: tuple[float, ...] = ()


@dataclass(frozen=True)
class AnomalyRule:
    """A named condition on one accepted reading (strict comparisons).

    ``kind``: ``above`` (col > threshold), ``abs_diff_above``
    (abs(columns[0] - columns[1]) > threshold) or ``equals`` (col = threshold).
    """

    name: str
    kind: str
    columns: tuple[str, ...]
    threshold: float


@dataclass(frozen=True)
class Interval:
    """A known failure interval; both ends inclusive."""

    failure_event_id: int
    start_ts: str
    end_ts: str
    failure_type: str
    severity: str
    notes: str | None


@dataclass(frozen=True)
class Equipment:
    equipment_id: str
    equipment_name: str
    equipment_type: str
    operating_context: str


@dataclass(frozen=True)
class TelemetryModel:
    # (source column, silver column) in contract order; the first two are the key.
    columns: tuple[tuple[str, str], ...]
    pressure: tuple[str, ...]
    binary: tuple[str, ...]
    rules: tuple[Rule, ...]
    anomalies: tuple[AnomalyRule, ...]
    window_start: str
    window_end: str
    expected_readings_per_day: int
    equipment: Equipment
    intervals: tuple[Interval, ...]
    index_aliases: tuple[str, ...] = ("", "_c0", "Unnamed: 0")
    watch_rate_pct: float = 3.0
    critical_rate_pct: float = 10.0
    # daily measures: (output name, silver column, aggregate, decimals)
    daily_averages: tuple[tuple[str, str, str, int], ...] = field(default_factory=tuple)

    # ---- derived views of the contract -------------------------------------------------
    @property
    def source_columns(self) -> tuple[str, ...]:
        return tuple(src for src, _ in self.columns)

    @property
    def rename(self) -> dict[str, str]:
        return dict(self.columns)

    @property
    def id_source(self) -> str:
        return self.columns[0][0]

    @property
    def ts_source(self) -> str:
        return self.columns[1][0]

    @property
    def sensor_sources(self) -> tuple[str, ...]:
        return tuple(src for src, _ in self.columns[2:])

    @property
    def sensors(self) -> tuple[str, ...]:
        """Silver names of the sensor columns, in contract order."""
        return tuple(dst for _, dst in self.columns[2:])

    @property
    def rule_names(self) -> tuple[str, ...]:
        return tuple(r.name for r in self.rules)

    @property
    def anomaly_names(self) -> tuple[str, ...]:
        return tuple(a.name for a in self.anomalies)

    def with_(self, **changes) -> "TelemetryModel":
        return replace(self, **changes)


# ---------------------------------------------------------------------------------------
# The published contract.  These names, bounds, thresholds, intervals and
# equipment strings must equal the published ones for results to agree; they are stated
# here once, in contract order.
# ---------------------------------------------------------------------------------------

# Source CSV column -> Silver column, contract order (note the source spelling "DV_eletric").
CONTRACT_COLUMNS = (
    ("index", "reading_id"),
    ("timestamp", "event_ts"),
    ("TP2", "tp2"),
    ("TP3", "tp3"),
    ("H1", "h1"),
    ("DV_pressure", "dv_pressure"),
    ("Reservoirs", "reservoirs"),
    ("Oil_temperature", "oil_temperature"),
    ("Motor_current", "motor_current"),
    ("COMP", "comp"),
    ("DV_eletric", "dv_electric"),
    ("Towers", "towers"),
    ("MPG", "mpg"),
    ("LPS", "lps"),
    ("Pressure_switch", "pressure_switch"),
    ("Oil_level", "oil_level"),
    ("Caudal_impulses", "caudal_impulses"),
)
PRESSURE_COLUMNS = ("tp2", "tp3", "h1", "dv_pressure", "reservoirs")
BINARY_COLUMNS = ("comp", "dv_electric", "towers", "mpg", "lps", "pressure_switch", "oil_level")
SENSOR_COLUMNS = tuple(dst for _, dst in CONTRACT_COLUMNS[2:])

# Row rules in their published order; the order is the order of names in rejection_reason.
QUALITY_RULES = (
    Rule("invalid_reading_id", "unparsed", ("reading_id",)),
    Rule("invalid_timestamp", "unparsed", ("event_ts",)),
    Rule("timestamp_outside_expected_window", "outside_window", ("event_ts",)),
    Rule("missing_required_sensor", "any_null", SENSOR_COLUMNS),
    Rule("pressure_out_of_range", "outside_range", PRESSURE_COLUMNS, low=-2.0, high=20.0),
    Rule("oil_temperature_out_of_range", "outside_range", ("oil_temperature",), low=-30.0, high=150.0),
    Rule("motor_current_out_of_range", "outside_range", ("motor_current",), low=-1.0, high=50.0),
    Rule("invalid_binary_signal", "not_allowed", BINARY_COLUMNS, allowed=(0.0, 1.0)),
    Rule("negative_caudal_impulses", "below", ("caudal_impulses",), low=0.0),
    Rule("duplicate_reading", "duplicate", ("reading_id", "event_ts")),
)

# Anomaly reasons in their published order.
ANOMALY_RULES = (
    AnomalyRule("high_oil_temperature", "above", ("oil_temperature",), 100.0),
    AnomalyRule("high_motor_current", "above", ("motor_current",), 12.0),
    AnomalyRule("reservoir_pressure_mismatch", "abs_diff_above", ("tp3", "reservoirs"), 1.5),
    AnomalyRule("low_pressure_switch_active", "equals", ("lps",), 1.0),
    AnomalyRule("low_oil_level_signal", "equals", ("oil_level",), 1.0),
)

# Daily averages and maxima: (output column, silver column, aggregate, decimals).
DAILY_MEASURES = (
    ("avg_tp2_bar", "tp2", "avg", 4),
    ("avg_tp3_bar", "tp3", "avg", 4),
    ("avg_reservoirs_bar", "reservoirs", "avg", 4),
    ("avg_oil_temperature_c", "oil_temperature", "avg", 3),
    ("max_oil_temperature_c", "oil_temperature", "max", 3),
    ("avg_motor_current_a", "motor_current", "avg", 3),
    ("max_motor_current_a", "motor_current", "max", 3),
)

COMPRESSOR_EQUIPMENT = Equipment(
    "metro_apu_01", "Metro train Air Production Unit", "compressor", "Porto Metro, Portugal"
)

# The four published failure intervals (id, start, end, type, severity, notes).
COMPRESSOR_INTERVALS = (
    Interval(1, "2020-04-18 00:00:00", "2020-04-18 23:59:59", "Air leak", "High stress", None),
    Interval(2, "2020-05-29 23:30:00", "2020-05-30 06:00:00", "Air leak", "High stress",
             "Maintenance reported 2020-05-30"),
    Interval(3, "2020-06-05 10:00:00", "2020-06-07 14:30:00", "Air leak", "High stress",
             "Maintenance 2020-06-08 16:00"),
    Interval(4, "2020-07-15 14:30:00", "2020-07-15 19:00:00", "Air leak", "High stress",
             "Maintenance 2020-07-16 00:00"),
)

COMPRESSOR_WINDOW = ("2020-01-01 00:00:00", "2021-01-01 00:00:00")
COMPRESSOR_READINGS_PER_DAY = 8640  # one reading every 10 s

# Test parameters of the feed derived from the driver `events` table (January 2024).
# Intervals 3 and 4 overlap on purpose; 5 is inverted on purpose and never matches.
FEED_INTERVALS = (
    Interval(1, "2024-01-05 00:00:00", "2024-01-05 23:59:59", "Air leak", "High stress", None),
    Interval(2, "2024-01-10 23:30:00", "2024-01-11 06:00:00", "Air leak", "High stress",
             "Maintenance reported 2024-01-11"),
    Interval(3, "2024-01-15 10:00:00", "2024-01-17 14:30:00", "Air leak", "High stress",
             "Maintenance 2024-01-18 16:00"),
    Interval(4, "2024-01-17 12:00:00", "2024-01-18 19:00:00", "Air leak", "High stress",
             "Maintenance 2024-01-19 00:00"),
    Interval(5, "2024-01-20 12:00:00", "2024-01-19 19:00:00", "Air leak", "High stress",
             "Inverted interval"),
)
FEED_WINDOW = ("2024-01-01 00:00:00", "2025-01-01 00:00:00")
FEED_READINGS_PER_DAY = 360


def compressor() -> TelemetryModel:
    """The published contract of the compressor feed."""
    return TelemetryModel(
        columns=CONTRACT_COLUMNS,
        pressure=PRESSURE_COLUMNS,
        binary=BINARY_COLUMNS,
        rules=QUALITY_RULES,
        anomalies=ANOMALY_RULES,
        window_start=COMPRESSOR_WINDOW[0],
        window_end=COMPRESSOR_WINDOW[1],
        expected_readings_per_day=COMPRESSOR_READINGS_PER_DAY,
        equipment=COMPRESSOR_EQUIPMENT,
        intervals=COMPRESSOR_INTERVALS,
        daily_averages=DAILY_MEASURES,
    )


def events_feed() -> TelemetryModel:
    """The same contract with the window, cadence and intervals of the derived feed."""
    return compressor().with_(
        window_start=FEED_WINDOW[0],
        window_end=FEED_WINDOW[1],
        expected_readings_per_day=FEED_READINGS_PER_DAY,
        intervals=FEED_INTERVALS,
    )
