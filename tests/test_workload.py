"""Derived relations follow their tables."""

import shutil

import pyarrow.parquet as pq

from starmill.workload import raw

TABLES = "/root/testdata/sf0.001"


def test_a_changed_table_is_derived_anew(spark, tmp_path):
    for name in ("customer", "nation"):
        shutil.copy(f"{TABLES}/{name}.parquet", tmp_path)
    first = raw.bronze(spark, str(tmp_path), "customers")
    assert raw.bronze(spark, str(tmp_path), "customers").inputFiles() == first.inputFiles()
    fewer = spark.read.parquet(f"{TABLES}/customer.parquet").limit(7).toPandas()
    fewer.to_parquet(tmp_path / "customer.parquet")
    second = raw.bronze(spark, str(tmp_path), "customers")
    assert second.count() == 7 and first.count() == 150


def _lines(spark, folder):
    """Three lines of two orders in two ship months, and an order without lines."""
    spark.sql(
        "SELECT * FROM VALUES (1L, 10L), (2L, 11L), (3L, 12L) AS t(o_orderkey, o_custkey)"
    ).selectExpr("*", "TIMESTAMP'1996-01-02 00:00:00' AS o_orderdate").write.parquet(f"{folder}/orders.parquet")
    spark.sql(
        "SELECT * FROM VALUES (1L, 1, '1996-02-03'), (1L, 2, '1996-03-04'), (2L, 1, '1996-02-05'), (9L, 1, '1996-02-05')"
        " AS t(l_orderkey, l_linenumber, day)"
    ).selectExpr(
        "l_orderkey", "l_linenumber", "5L AS l_partkey", "7L AS l_suppkey", "3D AS l_quantity", "12.34D AS l_extendedprice",
        "0.05D AS l_discount", "0.02D AS l_tax", "'N' AS l_returnflag", "CAST(day AS TIMESTAMP) AS l_shipdate",
    ).write.parquet(f"{folder}/lineitem.parquet")


def test_order_lines_move_before_they_become_text(spark, tmp_path):
    _lines(spark, tmp_path)
    rows = raw.order_items(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    moved = plan[plan.index("Exchange hashpartitioning") :]
    assert "lpad" in plan and "lpad" not in moved
    got = rows.where("order_id = '2'").first().asDict()
    assert got["dt"] == "1996-01-02" and got["order_ts"] == "1996-01-02 02:07:05" and got["batch"] == "1996-02"
    assert got["quantity"] == "Three" and got["unit_price"] == "12.34" and got["tax_amount"] == "0.24680004"
    assert rows.count() == 3


def test_each_batch_lands_as_one_file_of_its_rows(spark, tmp_path):
    _lines(spark, tmp_path)
    files = raw.landing(spark, str(tmp_path), "order_items")
    landed = spark.read.option("header", True).csv(files).select("order_id", "item_seq", "_metadata.file_path").collect()
    batches = {(r["order_id"], r["item_seq"]): r["file_path"] for r in landed}
    assert len(set(batches.values())) == 2 and len(landed) == 3
    assert "batch=1996-02/" in batches["1", "1"] and batches["1", "1"] == batches["2", "1"]
    assert "batch=1996-03/" in batches["1", "2"]


def test_lines_are_moved_to_their_batch_before_they_become_text(spark, tmp_path):
    _lines(spark, tmp_path)
    rows = raw.item_texts(raw.by_batch(raw.order_lines(spark, str(tmp_path))))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(batch" in plan and "lpad" not in plan[plan.index("hashpartitioning(batch") :]


def test_bronze_items_are_stored_in_row_groups_that_scans_can_divide(spark, monkeypatch):
    monkeypatch.setattr(raw, "_written", {})
    monkeypatch.setattr(raw, "ROW_GROUPS", {"parquet.block.size": str(32 << 10)})
    stored = raw.bronze(spark, TABLES, "order_items")
    groups = [pq.ParquetFile(f.removeprefix("file://")).num_row_groups for f in stored.inputFiles()]
    assert stored.count() > 5_000 and min(groups) > 1


def test_landing_files_are_packed_and_leave_no_shuffle_files(spark, tmp_path, shuffles_left):
    _lines(spark, tmp_path)
    files = raw.landing(spark, str(tmp_path), "order_items")
    assert not shuffles_left()
    landed = spark.read.option("header", True).csv(files)
    assert landed.count() == 3
    for name in landed.inputFiles():
        assert open(name.removeprefix("file://"), "rb").read(2) == b"\x1f\x8b"
