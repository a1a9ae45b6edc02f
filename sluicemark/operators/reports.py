"""Per-file load report and its summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluicemark.sources.loading import BAD_COLUMN, BAD_PLACE, BAD_TEXT, BLOCK, FILE, ROW


def load_report(parsed: DataFrame, header_lines: int = 0, error_limit: int = 1) -> DataFrame:
    """One row per file of ``loading.parse_files``: counts and the first bad record.

    Records are counted per file block on the map side; only block totals meet per file, so a
    file of any size is never gathered.  ``first_error_line`` is the record's number in its
    file plus ``header_lines``.  ``first_error_character`` is the place in that record's text, from 1, where the faulty field
    begins; of a record with too few fields or cut off it is the place after its end.
    """
    bad = F.col(BAD_TEXT).isNotNull()
    first_bad = F.min_by(F.struct(ROW, BAD_COLUMN, BAD_TEXT, BAD_PLACE), F.when(bad, F.col(ROW)))
    blocks = parsed.groupBy(FILE, BLOCK).agg(
        F.min(ROW).alias("_first_row"),
        F.count(F.lit(1)).alias("_parsed"),
        F.count_if(bad).alias("_errors"),
        first_bad.alias("_bad_record"),
    )
    earlier = Window.partitionBy(FILE).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    numbered = blocks.withColumn(
        "_line",
        F.coalesce(F.sum("_parsed").over(earlier), F.lit(0)) + F.col("_bad_record")[ROW] - F.col("_first_row") + 1 + header_lines,
    )
    files = numbered.groupBy(FILE).agg(
        F.sum("_parsed").alias("rows_parsed"),
        F.sum("_errors").alias("error_seen"),
        F.min_by(F.struct("_line", "_bad_record"), F.when(F.col("_errors") > 0, F.col(BLOCK))).alias("_first"),
    )
    bad_column, bad_text = F.col("_first._bad_record")[BAD_COLUMN], F.col("_first._bad_record")[BAD_TEXT]
    return files.select(
        F.col(FILE).alias("file"),
        F.when(F.col("error_seen") > 0, "ERROR").otherwise("LOADED").alias("status"),
        "rows_parsed",
        (F.col("rows_parsed") - F.col("error_seen")).alias("rows_loaded"),
        F.lit(error_limit).cast("long").alias("error_limit"),
        "error_seen",
        F.when(
            F.col("error_seen") > 0,
            F.when(bad_column.isNull(), F.concat(F.lit("malformed record: "), bad_text)).otherwise(
                F.concat(F.lit("value not recognized: "), bad_text)
            ),
        ).alias("first_error"),
        F.when(F.col("error_seen") > 0, F.col("_first._line")).alias("first_error_line"),
        F.col("_first._bad_record")[BAD_PLACE].alias("first_error_character"),
        bad_column.alias("first_error_column_name"),
    )


def error_positions(parsed: DataFrame) -> DataFrame:
    """Every refused record: file, its text, the column at fault and where in the text the fault begins."""
    names = {FILE: "file", BAD_TEXT: "record", BAD_COLUMN: "column_name", BAD_PLACE: "error_character"}
    return parsed.where(F.col(BAD_TEXT).isNotNull()).select(*[F.col(old).alias(new) for old, new in names.items()])


def load_summary(report: DataFrame) -> DataFrame:
    """Totals over a load report; an empty report gives zeros and an empty list.

    The list holds names of faulty files only, fewer than the files Spark has already listed.
    """
    faulty = F.sort_array(F.collect_list(F.when(F.col("error_seen") > 0, F.col("file"))))

    def total(column: str):
        return F.coalesce(F.sum(column), F.lit(0)).cast("long")

    return report.agg(
        F.count(F.lit(1)).alias("total_files"),
        total("rows_parsed").alias("total_rows_parsed"),
        total("rows_loaded").alias("total_rows_loaded"),
        total("error_seen").alias("total_errors_seen"),
        faulty.alias("files_with_errors"),
    )
