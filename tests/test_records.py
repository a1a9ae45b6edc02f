"""Places of faults in csv and json records, and one-pass landings."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluicemark.functions.dates import ntz
from sluicemark.functions.records import csv_field_position, json_value_position
from sluicemark.operators.reports import error_positions, load_report
from sluicemark.sources.files import CsvFormat
from sluicemark.sources.loading import parse_files
from sluicemark.sources.records import landed_and_refused, records_from_payload, refused_records

SCHEMA = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("note", T.StringType()), T.StructField("amount", T.DoubleType())])


@pytest.mark.parametrize(
    "text, index, place",
    [
        ("1,2,3", 0, 1), ("1,2,3", 2, 5), ('1,"a,b",3', 2, 9), ('1,"a""x,y",3', 2, 12), ('"a\nb",c', 1, 7), (",,", 2, 3), ("1,2", 2, None), ('"' + "x" * 50_000 + '",z', 1, 50_004),
        ("é,中,3", 2, 5), ('a"b,c', 1, 5), ('"a"b,c', 1, 6), ("", 0, 1), ("", 1, None),
    ],
)
def test_csv_places(spark, text, index, place):
    assert spark.createDataFrame([(text, index)], "t string, i int").select(csv_field_position(F.col("t"), F.col("i"))).first()[0] == place


def test_csv_places_with_another_escape(spark):
    df = spark.createDataFrame([("1;'a\\';b';x",)], "t string")
    assert df.select(csv_field_position(F.col("t"), F.lit(2), ";", "'", "\\")).first()[0] == 11


@pytest.mark.parametrize(
    "text, key, place",
    [
        ('{"a":1,"b":"x"}', "b", 12), ('{"a": {"b": 2}, "B" :  [3]}', "b", 24), ('{"a":"\\"b\\":1","b":2}', "b", 20), ('{"x":["b"],"b":null}', "b", 16), ('{"a":1', "b", 7), ('{"a":"b', None, 8),
        ('{"a":1}', "b", None), ('{"é":1,"b":{}}', "b", 12), ("", "b", None),
    ],
)
def test_json_places(spark, text, key, place):
    assert spark.createDataFrame([(text, key)], "t string, k string").select(json_value_position(F.col("t"), F.col("k"))).first()[0] == place


def test_report_names_the_place(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,note,amount\n1,"x, ""y"",\nz",oops\n2,b,3\n')
    (tmp_path / "b.csv").write_text("id,note,amount\n1,a,2\n2,b,3,extra\n")
    (tmp_path / "c.csv").write_text("id,note,amount\n1,short\n")
    found = {r.file: (r.first_error_character, r.first_error_column_name) for r in load_report(parse_files(spark, str(tmp_path), "*.csv", "csv", SCHEMA), 1).collect()}
    assert found == {"a.csv": (17, "amount"), "b.csv": (7, None), "c.csv": (8, None)}
    (tmp_path / "d.json").write_text('{"id":1,"note":"\\"amount\\":3","AMOUNT":"oops"}\n{"id":2,"note":"cut\n')
    places = {r.column_name: r.error_character for r in error_positions(parse_files(spark, str(tmp_path), "d.json", "json", SCHEMA)).collect()}
    assert places == {"amount": 40, None: 20}
    (tmp_path / "e.csv").write_text("amount;id;note\nnone;1;'a;b'\n")
    report = load_report(parse_files(spark, str(tmp_path), "e.csv", "csv", SCHEMA, csv=CsvFormat(sep=";", quote="'"))).first()
    assert (report.first_error_character, report.first_error_column_name) == (1, "amount")


def test_landed_and_refused_in_one_reading(spark):
    record = T.StructType.fromDDL("k long, s string")
    rows = [(1, '[{"k":1,"s":"a"},{"k":"x"}]'), (2, '[{"k":2'), (3, None), (4, "[]"), (5, "null"), (6, '[{"s":"b"}, 7]')]
    payloads = spark.createDataFrame(rows, "id long, p string")
    stamp = ntz(dt.datetime(2024, 1, 1))
    whole = landed_and_refused(payloads, "p", record, stamp, ["id"])
    landed = records_from_payload(payloads, "p", record, stamp, ["id"], on_error="continue")
    refused = refused_records(payloads, "p", record, ["id"])
    assert sorted(whole.where("refused IS NULL").drop("refused").collect(), key=str) == sorted(landed.collect(), key=str)
    assert sorted(whole.where("refused IS NOT NULL").select("id", "refused").collect(), key=str) == sorted(refused.collect(), key=str)
    assert whole.where("refused IS NOT NULL AND (k IS NOT NULL OR scrape_ts IS NOT NULL)").count() == 0
