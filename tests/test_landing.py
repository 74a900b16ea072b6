"""Incremental landing: the sum of all runs is a full read, whatever dies on the way."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from starmill.plans import silver
from starmill.plans.contracts import RAW
from starmill.sinks.records import Records, subfolders
from starmill.sources.files import ARRIVED_AT, INGESTED_AT, SOURCE_FILE, scan_csv
from starmill.streaming.landing import Landing, land_new_files

SCHEMA = RAW["category"]


def drop(folder, name, *lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(["category_code,category_name", *lines]) + "\n")


@pytest.fixture
def landing(tmp_path):
    return Landing(f"{tmp_path}/landed", SCHEMA)


def landed(spark, landing):
    return sorted((tuple(r) for r in landing.read(spark).select(*SCHEMA.names).collect()), key=str)


def dying(publish, before):
    def run(batch, number):
        if before:
            # Rows are down, the record is not.
            batch.write.parquet(f"{before}/rows/__batch={number}/__attempt=lost")
        else:
            publish(batch, number)
        raise RuntimeError("died")

    return run


def test_runs_add_up_to_a_full_read(spark, tmp_path, landing):
    inbox = tmp_path / "inbox"
    drop(inbox, "1.csv", "a,one", "b,  two ", "b,  two ")
    land_new_files(spark, f"{inbox}/*.csv", landing)
    drop(inbox, "2.csv", "c,three", ",")
    drop(inbox, "0.csv", "d,four")
    for before in (landing.root, None):
        with pytest.raises(StreamingQueryException):
            land_new_files(spark, f"{inbox}/*.csv", landing, dying(landing.publish, before))
        drop(inbox, "3.csv" if before else "4.csv", "e,five")
    land_new_files(spark, f"{inbox}/*.csv", landing)
    land_new_files(spark, f"{inbox}/*.csv", landing)
    full = scan_csv(spark, f"{inbox}/*.csv", SCHEMA)
    assert landed(spark, landing) == sorted((tuple(r) for r in full.collect()), key=str) and full.count() == 8
    lineage = landing.read(spark).select(SOURCE_FILE, INGESTED_AT, ARRIVED_AT).distinct().collect()
    assert {r[0].rsplit("/", 1)[1] for r in lineage} == {f"{i}.csv" for i in range(5)} and all(r[1] and r[2] for r in lineage)


def test_nothing_landed(spark, landing):
    frame = landing.read(spark)
    assert frame.collect() == [] and frame.columns == [*SCHEMA.names, SOURCE_FILE, INGESTED_AT, ARRIVED_AT]


def test_a_batch_counts_once(spark, landing):
    rows = spark.createDataFrame([("a", "one")], SCHEMA).selectExpr(
        "*", f"'f' AS {SOURCE_FILE}", f"current_timestamp() AS {INGESTED_AT}", f"current_timestamp() AS {ARRIVED_AT}"
    )
    for _ in range(3):
        landing.publish(rows, 0)
    landing.publish(rows, 1)
    assert landed(spark, landing) == [("a", "one")] * 2


def test_attempts_that_never_count_are_deleted(spark, landing):
    assert landing.drop_superseded(spark) == 0
    rows = spark.createDataFrame([("a", "one")], SCHEMA).selectExpr(
        "*", f"'f' AS {SOURCE_FILE}", f"current_timestamp() AS {INGESTED_AT}", f"current_timestamp() AS {ARRIVED_AT}"
    )
    for number, lost in ((0, 2), (1, 0), (2, 1)):
        for attempt in range(lost):
            rows.write.parquet(f"{landing.root}/rows/__batch={number}/__attempt=lost{attempt}")
        if number < 2:
            landing.publish(rows, number)
    for deleted in (2, 0):
        assert landing.drop_superseded(spark) == deleted
        assert landed(spark, landing) == [("a", "one")] * 2
    assert subfolders(spark, f"{landing.root}/rows/__batch=2") == ["__attempt=lost0"]  # its run may still record it
    landing.publish(rows, 2)
    assert landing.drop_superseded(spark) == 1 and landed(spark, landing) == [("a", "one")] * 3


def test_a_micro_batch_is_bounded(spark, tmp_path, landing):
    for i in range(5):
        drop(tmp_path / "inbox", f"{i}.csv", f"{i},x")
    land_new_files(spark, f"{tmp_path}/inbox/*.csv", landing, files_at_once=2)
    assert landing.records(spark).numbers() == [0, 1, 2] and len(landed(spark, landing)) == 5


def test_the_last_arrival_wins_over_file_names(spark):
    rows = [("1", "1", "old", "z.csv", 1), ("1", "1", "new", "a.csv", 2), ("1", "1", "tie", "b.csv", 2), ("2", "1", "only", "a.csv", None)]
    df = spark.createDataFrame(rows, f"order_id string, item_seq string, quantity string, {SOURCE_FILE} string, at int")
    df = df.withColumn(ARRIVED_AT, F.timestamp_seconds("at")).withColumn(INGESTED_AT, F.current_timestamp()).drop("at")
    assert sorted(r.quantity for r in silver.latest_arrivals(df).collect()) == ["only", "tie"]


def test_records_are_whole_and_taken_once(spark, tmp_path):
    records = Records(spark, f"{tmp_path}/records")
    assert records.latest() is None and records.numbers() == []
    assert records.frame("number long, a string").collect() == []
    records.add(3, {"a": "x"})
    with pytest.raises(FileExistsError):
        records.add(3, {"a": "y"})
    records.add(10, {"a": "z", "list": [1]})
    assert records.latest() == {"number": 10, "a": "z", "list": [1]} and records.get(3)["a"] == "x"
    assert sorted(map(tuple, records.frame("number long, a string").collect())) == [(3, "x"), (10, "z")]
