"""telemetry_spark: telemetry quality and equipment-health analytics on Spark.

Raw CSV readings are landed as all-string Bronze with lineage, typed and gated by ten
named row rules into Silver and rejects, modelled into a star schema (calendar,
equipment and failure-interval dimensions, a reading fact with interval lookup and
explainable anomaly reasons, daily KPIs, a dashboard view), summarised into BI measures,
and reconciled by acceptance checks that are stored and fail loudly.

Layout:
    model.py      the declarative contract (columns, rules, anomalies, window, cadence,
                  equipment, intervals) and its presets
    sources/      CSV landing, the feed derived from the driver tables, layered storage
    functions/    rule, calendar, rounding and literal-table expressions
    operators/    gate, duplicate detection, interval lookup, gold, quality, validation, BI
    plans/        the end-to-end pipeline, the registered queries and their oracle SQL
"""

__version__ = "0.1.0"
