"""Land raw readings CSV as an all-string Bronze frame with lineage.

* header on, no schema inference, single-line records: every field stays a string and
  no extra pass over the data is spent inferring types;
* the unnamed leading index column some exports carry ("", "_c0", "Unnamed: 0") takes the
  contract's id name, unless that column already exists;
* columns are selected by name, so extra columns are dropped and order does not matter;
* a line with more or fewer fields than its header says nothing certain about any field: its fields
  are NULL and the line itself is kept in ``_raw_line``, by which the gate rejects it;
* lineage: source file, the byte offset of the split, ingest time, run id and a row sequence.
  ``_position`` is where the split starts in all files of the landing laid end to end in the order
  of their names, so (position, sequence) is the file order of a row in two numbers, which the
  duplicate rule uses to keep the first copy deterministically.  Both are stored in Bronze, so a
  recomputation after executor loss cannot reorder rows.

A folder lands in one of two ways.  :func:`land_csv` is for files with one header; Spark maps the
files of a read by position, from the header of the first, so a file whose header differs is an
error.  :func:`land_by_name` is for any mixture of headers: :func:`header_catalog` finds the header
of every file on the executors, and one scan of all files takes each line's fields by the places
that its file's header gives them.  Nothing is read file by file from the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from telemetry_spark.functions.rules import text
from telemetry_spark.model import TelemetryModel

RAW_LINE = "_raw_line"
LINEAGE_COLUMNS = ("_source_file", "_ingested_at", "_run_id", "_block_start", "_row_seq")


def _named(path: str) -> str:
    if not path or not path.strip():
        raise ValueError("name a file or folder of CSV readings")
    return path


def read_csv_strings(spark: SparkSession, path: str) -> DataFrame:
    """All columns as strings under the files' header, ``_raw_line`` on lines that do not fit it."""
    reader = spark.read.format("csv").options(header="true", inferSchema="false", multiLine="false", enforceSchema="false")
    columns = reader.load(_named(path)).schema
    # fields are counted before columns are pruned
    return reader.options(columnNameOfCorruptRecord=RAW_LINE, columnPruning="false").schema(columns.add(RAW_LINE, "string")).load(path)


def file_positions(spark: SparkSession, path: str) -> DataFrame:
    """(file, starts_at, length): the listing of a landing, with the bytes of all files before each
    in the order of their names.  No content is read; one row a file is ordered in one task."""
    listed = spark.read.format("binaryFile").load(_named(path)).select(F.col("_metadata.file_path").alias("_file"), "length")
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    return listed.select("_file", F.coalesce(F.sum("length").over(before), F.lit(0).cast("long")).alias("_starts_at"),
                         F.col("length").alias("_length"))


def header_catalog(spark: SparkSession, path: str, model: TelemetryModel) -> DataFrame:
    """One row a file: (_file, _starts_at, _length, _header, _fields, _places).

    The header is the first line of the split that starts at byte 0.  Lines that name every column
    of the contract but the id are all that reaches the aggregate, so it handles about one line a
    file; a file without such a line has NULL there.  ``_places`` gives for each contract column its
    field's number from 0, -1 if the header lacks it.  Header names hold no commas or line ends."""
    lines = spark.read.text(_named(path)).select(
        F.col("_metadata.file_path").alias("_at"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"), "value")
    names = " AND ".join(f"contains(value, {text(c)})" for c in model.source_columns if c != model.id_source)
    headers = lines.where("_block = 0").where(names).groupBy("_at").agg(F.min_by("value", "_line").alias("_header"))
    places = [f"cast(array_position(_fields, {text(c)}) - 1 AS int)" for c in model.source_columns]
    aliases = ", ".join(text(a) for a in model.index_aliases)
    at = model.source_columns.index(model.id_source)
    places[at] = f"CASE WHEN {places[at]} < 0 AND _fields[0] IN ({aliases}) THEN 0 ELSE {places[at]} END"
    listed = file_positions(spark, path)
    return listed.join(headers, listed["_file"] == headers["_at"], "left").drop("_at").withColumn(
        "_fields", F.expr(r"""transform(split(ltrim('\ufeff', _header), ',', -1), f -> trim(BOTH '"' FROM f))""")
    ).withColumn("_places", F.expr(f"CASE WHEN _fields IS NOT NULL THEN array({', '.join(places)}) END"))


def catalog_width(catalog: DataFrame, model: TelemetryModel) -> int:
    """The fields of the widest header; raises if a file lacks contract columns, naming one."""
    bad = "_length > 0 AND coalesce(array_contains(_places, -1), true)"
    seen = catalog.agg(F.max(F.size("_fields")).alias("width"), F.min(F.expr(f"CASE WHEN {bad} THEN _file END")).alias("file"))
    row = seen.first()
    if row["file"] is not None:
        contract_columns(read_csv_strings(catalog.sparkSession, row["file"]), model)    # names what it lacks
        raise ValueError(f"{row['file']} has no header line with the columns of the contract")
    if not row["width"]:
        raise ValueError("the landing holds no CSV file with a header")
    return row["width"]


def _with_lineage(frame: DataFrame, columns: list, run_id: str) -> DataFrame:
    """Contract columns plus lineage; ``frame`` has ``_starts_at`` and the lineage of its scan."""
    return frame.select(
        *columns, RAW_LINE, "_source_file", F.current_timestamp().alias("_ingested_at"), F.lit(str(run_id)).alias("_run_id"),
        "_block_start", "_row_seq", (F.col("_starts_at") + F.col("_block_start")).alias("_position"))


def _scan_lineage() -> list:
    return [F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_block_start").alias("_block_start"),
            F.monotonically_increasing_id().alias("_row_seq")]


def contract_columns(frame: DataFrame, model: TelemetryModel) -> dict[str, str]:
    """Contract name -> the frame's name of that column."""
    here = {name: name for name in frame.columns if name != RAW_LINE}
    if frame.columns[0] in model.index_aliases:
        here.setdefault(model.id_source, frame.columns[0])
    lacking = [name for name in model.source_columns if name not in here]
    if lacking:
        files = frame.inputFiles()
        raise ValueError(f"{files[0] if files else 'the source'} has no column {', '.join(lacking)}")
    return {name: here[name] for name in model.source_columns}


def land_csv(spark: SparkSession, path: str, model: TelemetryModel, run_id: str) -> DataFrame:
    """The Bronze frame of a CSV file, or of a folder whose files have one header (lazy; nothing is
    read beyond that header)."""
    frame = read_csv_strings(spark, path)
    fits = F.col(RAW_LINE).isNull()
    columns = [F.when(fits, F.col(f"`{here}`")).alias(name) for name, here in contract_columns(frame, model).items()]
    rows = frame.select(*columns, RAW_LINE, *_scan_lineage())
    files = file_positions(spark, path)
    return _with_lineage(rows.join(files, rows["_source_file"] == files["_file"]),
                         [F.col(f"`{c}`") for c in model.source_columns], run_id)


def land_by_name(spark: SparkSession, path: str, model: TelemetryModel, run_id: str, catalog: DataFrame,
                 width: int | None = None) -> DataFrame:
    """The Bronze frame of a folder whose files may have a header each.  ``catalog`` is its stored
    :func:`header_catalog`, ``width`` the fields of the widest header (default: asked of it)."""
    width = width or catalog_width(catalog, model)
    fields = [f"_f{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*fields, RAW_LINE)])
    reader = spark.read.format("csv").schema(schema).options(
        header="true", enforceSchema="true", multiLine="false", columnNameOfCorruptRecord=RAW_LINE, columnPruning="false")
    rows = reader.load(_named(path)).select(F.array(*fields).alias("_values"), RAW_LINE, *_scan_lineage())
    joined = rows.join(catalog.select("_file", "_starts_at", "_places", F.size("_fields").alias("_width")),
                       rows["_source_file"] == F.col("_file"))
    # the scan marks lines that are not as wide as the widest header; right is as wide as the own
    commas = f"""regexp_count(regexp_replace({RAW_LINE}, '"[^"]*"', ''), ',') + 1"""
    marked = joined.withColumn(RAW_LINE, F.expr(
        f"CASE WHEN {RAW_LINE} IS NULL AND _width < {width} THEN array_join(_values, ',', '')"
        f" WHEN {commas} <> _width THEN {RAW_LINE} END"))
    columns = [F.expr(f"CASE WHEN {RAW_LINE} IS NULL THEN get(_values, _places[{i}]) END").alias(c)
               for i, c in enumerate(model.source_columns)]
    return _with_lineage(marked.select(*columns, RAW_LINE, "_source_file", "_block_start", "_row_seq", "_starts_at"),
                         [F.col(f"`{c}`") for c in model.source_columns], run_id)


def landing_check(bronze: DataFrame, expected_rows: DataFrame | int | None = None) -> DataFrame:
    """One row: landed rows, expected rows, and whether Bronze is non-empty and complete.

    ``expected_rows`` is a count published with the source, or a one-column frame that
    counts the source another way (both are single aggregates, no driver round trip).
    """
    if expected_rows is None or isinstance(expected_rows, int):
        landed = bronze.agg(F.count(F.lit(1)).alias("landed_rows"))
        expected = F.col("landed_rows") if expected_rows is None else F.lit(expected_rows).cast("long")
        out = landed.withColumn("expected_rows", expected)
    else:
        # both counts in one aggregate over a tagged union: one job, no join
        tagged = bronze.select(F.lit(1).alias("_l"), F.lit(0).alias("_e")).unionByName(
            expected_rows.select(F.lit(0).alias("_l"), F.lit(1).alias("_e"))
        )
        out = tagged.agg(
            F.sum("_l").cast("long").alias("landed_rows"), F.sum("_e").cast("long").alias("expected_rows")
        )
    return out.select(
        "landed_rows",
        "expected_rows",
        ((F.col("landed_rows") > 0) & (F.col("landed_rows") == F.col("expected_rows"))).alias("passed"),
    )


def assert_landed(check: DataFrame) -> int:
    """Raise unless the landing check passed; returns the landed row count."""
    row = check.first()
    return require_rows(row["landed_rows"], row["expected_rows"])


def require_rows(landed: int, expected: int | None = None) -> int:
    if not landed:
        raise RuntimeError("the source holds no readings: Bronze would be empty")
    if expected is not None and landed != expected:
        raise RuntimeError(f"the source was announced with {expected} readings, {landed} were landed")
    return landed
