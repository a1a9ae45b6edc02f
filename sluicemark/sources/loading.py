"""Load files into a declared schema by column name, with provenance and error detail.

``parse_files`` keeps every record of the files next to the place it came from and the first
bad column it holds; ``loaded_rows`` keeps the rows a table takes, and
``operators.reports.load_report`` counts both sides.
"""

from __future__ import annotations

import datetime as dt
from functools import reduce
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.functions.dates import ntz
from sluicemark.functions.records import csv_field_position, json_value_position
from sluicemark.session import staged
from sluicemark.sources.files import CSV, PROVENANCE, CsvFormat, reader_format

FILE, BLOCK, ROW = "_file", "_block", "_row"
BAD_COLUMN, BAD_TEXT, BAD_PLACE = "_bad_column", "_bad_text", "_bad_place"
_WHOLE = "_whole_record"
# A backlog of new files is taken in micro-batches of at most this many files.
FILES_PER_BATCH = 10_000
# A stream takes a file whatever its date is; the list of files seen lies in the checkpoint and with the driver.
OLDEST_FILE = "36500d"


def _stage_name(stage: str) -> Column:
    """File path below the stage folder, as the file system spells it."""
    path = F.col("_metadata.file_path")
    spelled = F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)
    return F.substring_index(spelled, stage.rstrip("/") + "/", -1)


def _data_fields(schema: T.StructType) -> list[T.StructField]:
    provenance = {f.name for f in PROVENANCE}
    return [T.StructField(f.name, f.dataType) for f in schema.fields if f.name.lower() not in provenance]


def _reader(spark: SparkSession, streaming: int):
    """Batch reader, or that of a stream of micro-batches of ``streaming`` files."""
    return spark.readStream.options(maxFilesPerTrigger=streaming, maxFileAge=OLDEST_FILE) if streaming else spark.read


def _place(stage: str, streaming: int) -> list[Column]:
    # Row numbers exist in batch scans only; a stream reports no line numbers.
    row = F.lit(None).cast("long") if streaming else F.monotonically_increasing_id()
    return [_stage_name(stage).alias(FILE), F.col("_metadata.file_block_start").alias(BLOCK), row.alias(ROW)]


def _null_text(name: str) -> Column:
    return F.lit(None).cast("string").alias(name)


def _refused(whole: Column, columns: list[Column]) -> Column:
    """The record's text where the parser refused it.

    The hash, worked out for refused records only, makes every column part of the read: a parser
    that skips a column does not see its bad values.
    """
    everything_read = F.abs(F.hash(F.lit(0), *columns).cast("long")) >= 0
    return F.when(whole.isNotNull(), F.when(everything_read, whole))


def _first_wrong(parsed_text: Column, names: list[tuple[str, T.StructField]]) -> Column:
    """Name of the first field whose text does not cast; ``transform`` parses the text once."""
    def check(record: Column) -> Column:
        return F.coalesce(
            *[
                F.when(record[own].isNotNull() & record[own].try_cast(f.dataType).isNull(), F.lit(f.name))
                for own, f in names
                if isinstance(f.dataType, T.AtomicType)
            ],
            F.lit(None).cast("string"),
        )

    return F.transform(F.array(parsed_text), check)[0]


def _scan_parquet(spark: SparkSession, stage: str, path: str | list[str], fields: list[T.StructField], streaming: int) -> DataFrame:
    # A declared schema matches names without regard to case in every file, widens numbers
    # and fills columns a file lacks with null; only the declared columns are read.
    rows = _reader(spark, streaming).schema(T.StructType(fields)).format("parquet").load(path)
    return rows.select(
        *[f"`{f.name}`" for f in fields], *_place(stage, streaming), _null_text(BAD_COLUMN), _null_text(BAD_TEXT), F.lit(None).cast("long").alias(BAD_PLACE)
    )


def _csv_layouts(spark: SparkSession, path: str | list[str]) -> list[list[str]]:
    """The csv files of a path grouped by their header line; one small row per file is collected."""
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias(FILE),
        F.col("_metadata.file_block_start").alias(BLOCK),
        F.monotonically_increasing_id().alias(ROW),
    )
    headers = lines.where(F.col(BLOCK) == 0).groupBy(FILE).agg(F.min_by("value", ROW).alias("header"))
    layouts: dict[str, list[str]] = {}
    for row in headers.collect():
        layouts.setdefault(row["header"], []).append(unquote(row[FILE]))
    return list(layouts.values())


def _csv_header(spark: SparkSession, path: str | list[str], fields: list[T.StructField], streaming: int, csv: CsvFormat) -> list[str]:
    try:
        return spark.read.options(**csv.read()).csv(path).columns
    except AnalysisException as error:
        # A stream may start before its first file; files must then have the declared columns.
        if streaming and error.getCondition() in ("UNABLE_TO_INFER_SCHEMA", "PATH_NOT_FOUND"):
            return [f.name for f in fields]
        raise


def _assert_lines_close_quotes(spark: SparkSession, path: str | list[str], csv: CsvFormat) -> None:
    """Error for a quoted line break in files that are read line by line, which would shorten the record."""
    quotes = F.char_length("value") - F.char_length(F.replace("value", F.lit(csv.quote), F.lit("")))
    found = spark.read.text(path).where(quotes % 2 == 1).select("value", "_metadata.file_path").first()
    if found is not None:
        raise ValueError(f"a quote is left open at the end of a line in {found['file_path']}: {found['value'][:200]}")


def _scan_csv(
    spark: SparkSession, stage: str, path: str | list[str], fields: list[T.StructField], streaming: int, csv: CsvFormat
) -> DataFrame:
    header = _csv_header(spark, path, fields, streaming, csv)
    if not csv.multiline and not streaming:
        _assert_lines_close_quotes(spark, path, csv)
    wanted = {f.name.lower(): f for f in fields}
    own = {c.lower(): c for c in header}

    def kind(column: str) -> T.DataType:
        field = wanted.get(column.lower())
        return field.dataType if field is not None and isinstance(field.dataType, T.AtomicType) else T.StringType()

    schema = T.StructType([T.StructField(c, kind(c)) for c in header] + [T.StructField(_WHOLE, T.StringType())])
    # enforceSchema=False makes a file with another header an error instead of shifted values.
    permissive = {"enforceSchema": False, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _WHOLE}
    rows = _reader(spark, streaming).schema(schema).format("csv").options(**csv.read(), **permissive).load(path)

    def value(field: T.StructField) -> Column:
        if field.name.lower() not in own:
            return F.lit(None).cast(field.dataType)
        column = F.col(f"`{own[field.name.lower()]}`")
        return column if isinstance(field.dataType, T.AtomicType) else F.from_json(column, field.dataType)

    whole = F.col(_WHOLE)
    texts = F.from_csv(whole, ", ".join(f"c{i} string" for i in range(len(header))), {k: str(v) for k, v in csv.written().items()})
    names = [(f"c{i}", wanted[c.lower()]) for i, c in enumerate(header) if c.lower() in wanted]
    found = rows.select(
        *[value(f).alias(f.name) for f in fields],
        *_place(stage, streaming),
        F.when(whole.isNotNull(), _first_wrong(texts, names)).alias(BAD_COLUMN),
        _refused(whole, [F.col(f"`{c}`") for c in header]).alias(BAD_TEXT),
    )
    declared = F.array(*[F.lit(wanted[c.lower()].name if c.lower() in wanted else None).cast("string") for c in header])
    at = lambda index: csv_field_position(F.col(BAD_TEXT), index, csv.sep, csv.quote, csv.escape)
    # A record without a bad value has too many fields, so the first of those is at fault, or too few, so its end is.
    place = F.when(F.col(BAD_COLUMN).isNotNull(), at(F.array_position(declared, F.col(BAD_COLUMN)) - 1)).otherwise(
        F.coalesce(at(F.lit(len(header))), F.length(BAD_TEXT).cast("long") + 1)
    )
    return found.withColumn(BAD_PLACE, F.when(F.col(BAD_TEXT).isNotNull(), place))


def _json_lines(spark: SparkSession, stage: str, path: str | list[str], streaming: int) -> DataFrame:
    return _reader(spark, streaming).format("text").load(path).select("value", *_place(stage, streaming))


def _json_spellings(lines: DataFrame, fields: list[T.StructField]) -> list[dict[str, T.StructField]]:
    """How the lines spell the declared names, as layers of names that differ by more than case."""
    by_lower = {f.name.lower(): f for f in fields}
    key = lines.select(F.explode(F.json_object_keys("value")).alias("key"))
    found = key.where(F.lower("key").isin(list(by_lower))).distinct()
    layers: list[dict[str, T.StructField]] = [{}]
    for name in sorted(row["key"] for row in found.collect()):  # spellings of declared names only
        field = by_lower[name.lower()]
        layer = next((layer for layer in layers if field not in layer.values()), None)
        if layer is None:
            layers.append(layer := {})
        layer[name] = field
    return layers


def _json_schema(layer: dict[str, T.StructField]) -> T.StructType:
    spelled = [T.StructField(name, field.dataType) for name, field in layer.items()]
    return T.StructType([*spelled, T.StructField(_WHOLE, T.StringType())])


def _json_rows(
    rows: DataFrame, records: list, layers: list[dict[str, T.StructField]], fields: list[T.StructField], place: list
) -> DataFrame:
    """Declared columns out of one parsed record per layer, with the fault of refused records."""
    def value(field: T.StructField) -> Column:
        held = [record[name] for record, layer in zip(records, layers) for name, f in layer.items() if f is field]
        return F.coalesce(*held) if held else F.lit(None).cast(field.dataType)

    whole = F.coalesce(*[record[_WHOLE] for record in records])
    everything = [record[name] for record, layer in zip(records, layers) for name in layer]
    texts = F.from_json(whole, T.MapType(T.StringType(), T.StringType()))
    names = [item for layer in layers for item in layer.items()]
    found = rows.select(
        *[value(f).alias(f.name) for f in fields],
        *place,
        F.when(whole.isNotNull(), _first_wrong(texts, names)).alias(BAD_COLUMN),
        _refused(whole, everything).alias(BAD_TEXT),
    )
    return found.withColumn(BAD_PLACE, F.when(F.col(BAD_TEXT).isNotNull(), json_value_position(F.col(BAD_TEXT), F.col(BAD_COLUMN))))


def _parse_json_lines(lines: DataFrame, fields: list[T.StructField]) -> DataFrame:
    layers = _json_spellings(lines, fields)
    parsed = lines.where(F.trim("value") != "")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _WHOLE}
    for i, layer in enumerate(layers):
        record = F.from_json("value", _json_schema(layer), options)
        # The one-element explode is a barrier: without it Catalyst copies the parse into every
        # filter on a parsed column.
        parsed = parsed.select("*", F.explode(F.array(record)).alias(f"_layer{i}"))
    return _json_rows(parsed, [F.col(f"_layer{i}") for i in range(len(layers))], layers, fields, [FILE, BLOCK, ROW])


class _Row:
    """Columns of the frame itself, addressed as those of a record."""

    def __getitem__(self, name: str) -> Column:
        return F.col(f"`{name}`")


def _scan_json(spark: SparkSession, stage: str, path: str | list[str], fields: list[T.StructField]) -> DataFrame:
    """Typed JSON scan; a first pass over the text finds how the files spell the declared names."""
    lines = _json_lines(spark, stage, path, streaming=0)
    layers = _json_spellings(lines, fields)
    if len(layers) > 1:
        return _parse_json_lines(lines, fields)
    rows = spark.read.schema(_json_schema(layers[0])).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=_WHOLE)
    return _json_rows(rows, [_Row()], layers, fields, _place(stage, streaming=0))


def raw_files(
    spark: SparkSession,
    stage: str,
    prefix: str,
    file_format: str,
    schema: T.StructType,
    streaming: int = 0,
    csv_header: str = "shared",
    csv: CsvFormat = CSV,
    paths: list[str] | None = None,
) -> DataFrame:
    """Rows of a scan; in a stream json stays text lines, for ``parse_raw`` to read per micro-batch.

    ``streaming`` is the number of files of a micro-batch, 0 for a batch scan.  ``paths`` takes these files instead of
    all under ``stage/prefix``.
    """
    fields, reader = _data_fields(schema), reader_format(file_format)
    path = paths or f"{stage}/{prefix}"
    if reader == "parquet":
        return _scan_parquet(spark, stage, path, fields, streaming)
    if reader == "json":
        return _json_lines(spark, stage, path, streaming) if streaming else _scan_json(spark, stage, path, fields)
    if csv_header == "per_file" and not streaming:
        layouts = _csv_layouts(spark, path)
        return reduce(DataFrame.unionByName, [_scan_csv(spark, stage, own, fields, 0, csv) for own in layouts])
    return _scan_csv(spark, stage, path, fields, streaming, csv)


def parse_raw(raw: DataFrame, file_format: str, schema: T.StructType) -> DataFrame:
    """One micro-batch of a ``raw_files`` stream as ``parse_files`` gives it."""
    return _parse_json_lines(raw, _data_fields(schema)) if reader_format(file_format) == "json" else raw


def parse_files(
    spark: SparkSession,
    stage: str,
    prefix: str,
    file_format: str,
    schema: T.StructType,
    csv_header: str = "shared",
    csv: CsvFormat = CSV,
    paths: list[str] | None = None,
) -> DataFrame:
    """All records of the files under ``stage/prefix``, columns matched by name ignoring case.

    Columns the files lack are null, columns the schema lacks are dropped.  ``_file``,
    ``_block`` and ``_row`` say where a record came from; ``_bad_text`` is the text of a record
    the parser refused, ``_bad_column`` the column at fault, if one is, and ``_bad_place`` where in the text the fault begins, from 1.  Csv files share one
    header unless ``csv_header`` is ``"per_file"``, which reads the header of each file first.
    """
    return raw_files(spark, stage, prefix, file_format, schema, csv_header=csv_header, csv=csv, paths=paths)


def loaded_rows(parsed: DataFrame, scan_time: dt.datetime | None = None, on_error: str = "abort") -> DataFrame:
    """Rows for the table: data columns, then file name and scan start time.

    ``on_error="abort"`` fails the job at the first bad record; ``"continue"`` leaves bad
    records out (the load report counts them).
    """
    if on_error not in ("abort", "continue"):
        raise ValueError(f"on_error must be 'abort' or 'continue', not {on_error!r}")
    scan_time = scan_time or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    bad = F.col(BAD_TEXT).isNotNull()
    if on_error == "continue":
        kept = parsed.where(~bad)
    else:
        message = F.concat(F.lit("bad record in "), F.col(FILE), F.lit(": "), F.col(BAD_TEXT))
        kept = parsed.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True))
    data = [c for c in parsed.columns if c not in (FILE, BLOCK, ROW, BAD_COLUMN, BAD_TEXT, BAD_PLACE)]
    return kept.select(
        *[f"`{c}`" for c in data], F.col(FILE).alias("metadata_filename"), ntz(scan_time).alias("metadata_ingest_time")
    )


def load_files(
    spark: SparkSession,
    stage: str,
    prefix: str,
    file_format: str,
    schema: T.StructType,
    scan_time: dt.datetime | None = None,
    on_error: str = "abort",
    csv_header: str = "shared",
    csv: CsvFormat = CSV,
) -> DataFrame:
    """Rows of the files under ``stage/prefix`` in the declared schema, with provenance."""
    parsed = parse_files(spark, stage, prefix, file_format, schema, csv_header=csv_header, csv=csv)
    return loaded_rows(parsed, scan_time, on_error)


def listed_files(spark: SparkSession, stage: str, prefix: str) -> DataFrame:
    """(file, path) of the files under ``stage/prefix``, listed without being read; no rows if there is no such path."""
    try:
        listed = spark.read.format("binaryFile").load(f"{stage}/{prefix}")
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], f"{FILE} string, path string").withColumnRenamed(FILE, "file")
    return listed.select(_stage_name(stage).alias("file"), F.col("_metadata.file_path").alias("path"))


def same_file(path: str) -> str:
    """A listed path as readers take it."""
    return unquote(path)


def _unseen(spark: SparkSession, table: str, stage: str, prefix: str) -> list[str]:
    """Files under ``stage/prefix`` that no row of the table comes from.

    Names are compared on the executors.  What comes to the driver are paths, which the driver's own file listing of the scan
    holds as well.  ``plans.loads`` keeps a history instead of reading the table's names.
    """
    known = spark.table(table).select(F.col("metadata_filename").alias("file")).distinct()
    return [same_file(row["path"]) for row in listed_files(spark, stage, prefix).join(known, "file", "left_anti").select("path").collect()]


def load_into_table(
    spark: SparkSession,
    table: str,
    stage: str,
    prefix: str,
    file_format: str,
    truncate: bool = False,
    scan_time: dt.datetime | None = None,
    on_error: str = "abort",
    csv_header: str = "shared",
    csv: CsvFormat = CSV,
    force: bool = False,
    paths: list[str] | None = None,
) -> dict[str, int]:
    """Load the files into a table by column name; returns rows_parsed, rows_loaded and errors_seen.

    A table with provenance knows which files its rows come from; those are not loaded again unless ``force`` is set.
    ``truncate`` replaces the table's rows and loads every file; the rows are staged first, so a load that aborts
    leaves the table as it was.  The counts ride on the write.  ``paths`` loads just these files, whatever the table holds.
    """
    schema = spark.table(table).schema
    keeps_history = PROVENANCE.names[0] in [n.lower() for n in schema.names]
    if paths is None and keeps_history and not (truncate or force):
        paths = _unseen(spark, table, stage, prefix)
    if paths == []:
        return {"rows_parsed": 0, "rows_loaded": 0, "errors_seen": 0}
    seen = Observation()
    parsed = parse_files(spark, stage, prefix, file_format, schema, csv_header=csv_header, csv=csv, paths=paths)
    bad = F.count_if(F.col(BAD_TEXT).isNotNull())
    counted = parsed.observe(seen, F.count(F.lit(1)).alias("rows_parsed"), (F.count(F.lit(1)) - bad).alias("rows_loaded"), bad.alias("errors_seen"))
    rows = loaded_rows(counted, scan_time, on_error)
    aligned = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in schema])
    # An overwrite removes the old files before it writes, so it starts only once all rows have been read and taken.
    (staged(aligned) if truncate else aligned).write.insertInto(table, overwrite=truncate)
    return seen.get
