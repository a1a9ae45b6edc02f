from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from sluicemark.operators.reports import load_report, load_summary
from sluicemark.session import new_database
from sluicemark.sources.files import CsvFormat
from sluicemark.sources.loading import load_files, load_into_table, parse_files

SCHEMA = (
    T.StructType()
    .add("id", T.LongType())
    .add("name", T.StringType())
    .add("amount", T.DoubleType())
    .add("metadata_filename", T.StringType())
    .add("metadata_ingest_time", T.TimestampNTZType())
)
AT = dt.datetime(2024, 2, 1)


def put(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text)


def test_csv_by_name_ignoring_case_and_order(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "AMOUNT,extra,Id\n1.5,x,7\n,y,8\n")
    found = load_files(spark, str(tmp_path), "in", "csv", SCHEMA, AT).collect()
    assert [tuple(r) for r in sorted(found)] == [(7, None, 1.5, "in/a.csv", AT), (8, None, None, "in/a.csv", AT)]


def test_csv_files_with_different_headers_are_refused(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "id,name\n1,a\n")
    put(tmp_path / "in", "b.csv", "name,id\nb,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        load_files(spark, str(tmp_path), "in", "csv", SCHEMA, AT).collect()


def test_csv_headers_per_file(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "id,name\n1,a\n")
    put(tmp_path / "in", "b one.csv", "NAME,amount,ID\nb,2.5,2\nc,,3\n")
    put(tmp_path / "in", "c.csv", "id,name\n4,d,extra\n5,e\n")
    parsed = parse_files(spark, str(tmp_path), "in", "csv", SCHEMA, csv_header="per_file")
    assert {r["file"].split("/")[-1]: (r["rows_loaded"], r["error_seen"]) for r in load_report(parsed, 1).collect()} == {
        "a.csv": (1, 0), "b one.csv": (2, 0), "c.csv": (1, 1),
    }
    kept = load_files(spark, str(tmp_path), "in", "csv", SCHEMA, AT, "continue", csv_header="per_file")
    assert sorted(tuple(r)[:3] for r in kept.collect()) == [(1, "a", None), (2, "b", 2.5), (3, "c", None), (5, "e", None)]


def test_json_by_name_with_nested_values(spark, tmp_path):
    schema = T.StructType.fromDDL("id int, tags array<string>, deep struct<a:int>")
    put(tmp_path / "in", "a.json", '{"ID": 1, "Tags": ["x", "y"], "DEEP": {"a": 3}, "more": 1}\n\n{"id": null}\n')
    found = load_files(spark, str(tmp_path), "in", "json", schema, AT).collect()
    assert [tuple(r)[:3] for r in found] == [(1, ["x", "y"], (3,)), (None, None, None)]


def test_parquet_widens_fills_and_drops(spark, tmp_path):
    spark.sql("SELECT 1 AS ID, 'x' AS extra").write.parquet(str(tmp_path / "in"))
    spark.sql("SELECT 2.5D AS amount, 'b' AS Name, 2 AS id").write.mode("append").parquet(str(tmp_path / "in"))
    found = load_files(spark, str(tmp_path), "in", "parquet", SCHEMA, AT).orderBy("id").collect()
    assert [tuple(r)[:3] for r in found] == [(1, None, None), (2, "b", 2.5)]


def test_json_spellings_may_differ_between_records(spark, tmp_path):
    put(tmp_path / "in", "a.json", '{"ID": 1, "Name": "a"}\n{"id": 2, "NAME": "b"}\n{"Id": 3}\n')
    found = load_files(spark, str(tmp_path), "in", "json", SCHEMA, AT).collect()
    assert [tuple(r)[:2] for r in found] == [(1, "a"), (2, "b"), (3, None)]


def test_bad_values_in_columns_nobody_selects_are_seen(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "id,name,amount,extra\n1,a,1.0,x\n2,b,oops,x\n3,c,1.0\n")
    put(tmp_path / "js", "a.json", '{"id": 1, "amount": 1.5}\n{"id": 2, "amount": "oops"}\n')
    for prefix, kind, good in (("in", "csv", [1]), ("js", "json", [1])):
        kept = load_files(spark, str(tmp_path), prefix, kind, SCHEMA, AT, "continue")
        assert [r["id"] for r in kept.select("id").collect()] == good
        assert kept.count() == 1
        with pytest.raises(Exception, match="bad record"):
            load_files(spark, str(tmp_path), prefix, kind, SCHEMA, AT).select("name").collect()


def test_bad_values_abort_or_are_left_out(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "id,name,amount\n1,a,1.0\nx,b,2.0\n3,c,oops\n")
    with pytest.raises(Exception, match="bad record in in/a.csv: x,b,2.0"):
        load_files(spark, str(tmp_path), "in", "csv", SCHEMA, AT).collect()
    kept = load_files(spark, str(tmp_path), "in", "csv", SCHEMA, AT, on_error="continue")
    assert [r["id"] for r in kept.collect()] == [1]
    with pytest.raises(ValueError):
        load_files(spark, str(tmp_path), "in", "csv", SCHEMA, AT, on_error="skip")


def test_report_names_the_first_bad_record(spark, tmp_path):
    put(tmp_path / "in", "file1.csv", "id,name,amount\n1,a,1.0\n2,b,2.0\n")
    put(tmp_path / "in", "file2.csv", "id,name,amount\n1,a,1.0\n2,b,oops\nx,c,3.0\n4,d\n")
    report = load_report(parse_files(spark, str(tmp_path), "in", "csv", SCHEMA), header_lines=1)
    first, second = [r.asDict() for r in report.orderBy("file").collect()]
    assert (first["file"], first["status"], first["rows_parsed"], first["rows_loaded"], first["error_seen"]) == ("in/file1.csv", "LOADED", 2, 2, 0)
    assert first["first_error"] is None and first["first_error_line"] is None
    assert (second["status"], second["rows_parsed"], second["rows_loaded"], second["error_seen"]) == ("ERROR", 4, 1, 3)
    assert (second["first_error_line"], second["first_error_column_name"]) == (3, "amount")
    assert "oops" in second["first_error"] and second["error_limit"] == 1


def test_report_of_malformed_json(spark, tmp_path):
    put(tmp_path / "in", "a.json", '{"id": 1}\n{"id": \n{"id": "q"}\n')
    row = load_report(parse_files(spark, str(tmp_path), "in", "json", SCHEMA)).first()
    assert (row["rows_parsed"], row["error_seen"], row["first_error_line"], row["first_error_column_name"]) == (3, 2, 2, None)
    assert row["first_error"].startswith("malformed record")


def test_report_line_over_many_splits(spark, tmp_path):
    lines = [f"{i},n{i},{i}.0" for i in range(3000)]
    lines[2500] = "2500,n2500,bad"
    put(tmp_path / "in", "a.csv", "\n".join(["id,name,amount", *lines]) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", 4096)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        parsed = parse_files(spark, str(tmp_path), "in", "csv", SCHEMA, csv=CsvFormat(multiline=False))
        assert parsed.select("_block").distinct().count() > 5
        row = load_report(parsed, header_lines=1).first()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert (row["rows_parsed"], row["error_seen"], row["first_error_line"]) == (3000, 1, 2502)


REPORT = "file string, status string, rows_parsed long, rows_loaded long, error_limit long, error_seen long"


def test_summary_of_two_files_one_file_and_none(spark):
    both = spark.createDataFrame([("file1.csv", "LOADED", 1000, 1000, 1, 0), ("file2.csv", "ERROR", 500, 400, 1, 1)], REPORT)
    assert tuple(load_summary(both).first()) == (2, 1500, 1400, 1, ["file2.csv"])
    assert tuple(load_summary(both.where("error_seen = 0")).first()) == (1, 1000, 1000, 0, [])
    assert tuple(load_summary(both.limit(0)).first()) == (0, 0, 0, 0, [])


def test_load_into_table_appends_and_truncates(spark, tmp_path):
    put(tmp_path / "in", "a.csv", "name,id\na,1\nb,2\n")
    target = f"{new_database(spark, 't')}.loaded"
    spark.createDataFrame([], SCHEMA).write.saveAsTable(target)
    load_into_table(spark, target, str(tmp_path), "in", "csv")
    load_into_table(spark, target, str(tmp_path), "in", "csv")
    assert spark.table(target).count() == 2  # the file has been loaded
    load_into_table(spark, target, str(tmp_path), "in", "csv", force=True)
    assert spark.table(target).count() == 4
    load_into_table(spark, target, str(tmp_path), "in", "csv", truncate=True, scan_time=AT)
    assert [tuple(r) for r in spark.table(target).orderBy("id").collect()] == [(1, "a", None, "in/a.csv", AT), (2, "b", None, "in/a.csv", AT)]
