"""Faults that used to change results without an error."""

import gzip

from pyspark.sql import functions as F

from parceltide.operators.ordinal import write_ranked
from parceltide.sources import files


def test_ranks_with_several_files_per_task(spark, folder):
    spark.conf.set("spark.sql.files.maxRecordsPerFile", "50")
    try:
        rows = spark.range(1000).withColumn("g", F.col("id") % 2)
        ranked = write_ranked(rows, "g", ["id"], f"{folder}/ranked").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxRecordsPerFile")
    assert all(r["group_rank"] == r["id"] // 2 and r["group_size"] == 500 for r in ranked)


def test_csv_columns_are_found_by_name_in_every_file(spark, folder):
    """Files with other column orders, fewer or more columns, another case of blanks, or no line at all."""
    files_of = {
        "a.csv": "parcel_id,event_type,event_timestamp,hub_id\nA,pickup,2024-01-01T00:00:00,H1\n",
        "b c.csv": "event_type, parcel_id ,event_timestamp\npickup,B,2024-01-02T00:00:00\n",
        "d.csv": "\n\nhub_id,extra,event_timestamp,parcel_id,event_type\nH3,x,2024-01-03T00:00:00,D,scan\n",
        "e.csv": "",
    }
    for name, text in files_of.items():
        with open(f"{folder}/{name}", "w", encoding="utf-8") as out:
            out.write(text)
    with gzip.open(f"{folder}/f.csv.gz", "wt") as out:
        out.write("event_timestamp,parcel_id,event_type\n2024-01-04T00:00:00,F,scan\n")
    rows = files.scan_events(spark, folder).select("parcel_id", "event_type", "hub_id").collect()
    assert [tuple(r) for r in rows] == [("A", "pickup", "H1"), ("B", "pickup", ""), ("D", "scan", "H3"), ("F", "scan", "")]
    text = {r["parcel_id"]: r["hub_id"] for r in files.read_csv_text(spark, folder).collect()}
    assert text == {"A": "H1", "B": None, "D": "H3", "F": None}
    assert {k: len(v) for k, v in files.files_by_header(spark, folder).items()}[None] == 1


def test_plan_defaults_follow_each_file(spark, folder):
    """Weather is clear where a file has no such column, and empty where it leaves the value out."""
    for name, header, row in (
            ("a", "parcel_id,planned_pickup,planned_delivery", "A,2024-01-01T00:00:00,2024-01-01T05:00:00"),
            ("b", "weather_condition,planned_delivery,planned_pickup,parcel_id", ",2024-01-01T05:00:00,2024-01-01T00:00:00,B")):
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as out:
            out.write(f"{header}\n{row}\n")
    rows = {r["parcel_id"]: r for r in files.scan_planned(spark, folder).collect()}
    assert rows["A"]["weather_condition"] == "clear" and rows["B"]["weather_condition"] == ""
    assert rows["B"]["planned_delivery"].hour == 5 and rows["A"]["arrival"]["file"] != rows["B"]["arrival"]["file"]


def test_empty_csv_files_are_empty_tables(spark, folder):
    open(f"{folder}/a.csv", "w").close()
    assert files.scan_planned(spark, folder).count() == files.scan_events(spark, folder).count() == 0
    assert [t.count() for t in files.scan_training(spark, folder, folder)] == [0, 0]
