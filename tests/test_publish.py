"""Publication: repeatable, refused on drift, invisible when a check fails."""

from concurrent.futures import ThreadPoolExecutor

import pytest

from pyspark.sql import functions as F, types as T

from starmill.operators.quality import QualityError, key_report
from starmill.operators.schema import SchemaDrift
from starmill.plans.contracts import Contract
from starmill.sinks.records import Records
from starmill.sinks.tables import discard, is_published, publish, published, stage, switch
from starmill.sources.files import REJECTED, scan_csv, with_audit

CONTRACT = Contract("things", T.StructType().add("id", "long").add("grp", "integer"), ("id",))


def _things(spark, count):
    return spark.range(count).select("id", (F.col("id") % 3).cast("int").alias("grp"))


def _unique(table):
    return key_report(table, CONTRACT.name, CONTRACT.grain)


def test_overwrite_is_repeatable_and_old_versions_go(spark, database):
    assert not is_published(spark, database, "things")
    for count in (5, 5, 7):
        publish(_things(spark, count), database, CONTRACT, _unique)
    assert is_published(spark, database, "things")
    assert spark.table(f"{database}.things").count() == 7
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 3  # the view, its version, the one before
    publish(_things(spark, 7), database, CONTRACT, _unique, keep=0)
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 2


def test_a_table_with_a_similar_name_is_left_alone(spark, database):
    log = Contract("things__log", CONTRACT.schema, ("id",))
    publish(_things(spark, 4), database, log)
    for keep in (1, 1, 0):
        publish(_things(spark, 5), database, CONTRACT, keep=keep)
    assert spark.table(f"{database}.things__log").count() == 4
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 4


def test_what_a_killed_run_left_does_not_count_as_the_version_before(spark, database):
    publish(_things(spark, 5), database, CONTRACT)
    reader = spark.table(f"{database}.things")
    # Written after the published version, never pointed at.
    spark.range(1).write.saveAsTable(f"{database}.things__{10**19 - 1:020d}")
    publish(_things(spark, 7), database, CONTRACT)
    assert reader.count() == 5 and spark.table(f"{database}.things").count() == 7
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 3


def test_a_failed_check_leaves_the_old_rows(spark, database):
    publish(_things(spark, 5), database, CONTRACT, _unique)
    bad = _things(spark, 5).unionByName(_things(spark, 1))
    with pytest.raises(QualityError, match="1 violations"):
        publish(bad, database, CONTRACT, _unique)
    assert spark.table(f"{database}.things").count() == 5
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 2


def test_a_running_query_survives_the_next_refresh(spark, database):
    publish(_things(spark, 5), database, CONTRACT)
    reader = spark.table(f"{database}.things")
    publish(_things(spark, 7), database, CONTRACT)
    assert reader.count() == 5


def test_changed_schema_is_refused(spark, database):
    publish(_things(spark, 5), database, CONTRACT)
    with pytest.raises(SchemaDrift, match="grp: agreed int, got bigint"):
        publish(_things(spark, 5).withColumn("grp", F.col("grp").cast("long")), database, CONTRACT)
    assert dict(spark.table(f"{database}.things").dtypes)["grp"] == "int"


def test_a_table_may_be_refreshed_from_itself(spark, database):
    publish(_things(spark, 5), database, CONTRACT)
    publish(spark.table(f"{database}.things").where("id < 3"), database, CONTRACT)
    assert spark.table(f"{database}.things").count() == 3


def test_partitioned_layout_prunes(spark, database):
    publish(_things(spark, 30), database, CONTRACT, _unique, partition_by=("grp",))
    table = spark.table(f"{database}.things")
    assert table.columns == ["id", "grp"] and table.count() == 30
    plan = table.where("grp = 1")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(grp" in plan


def test_tables_are_switched_at_once(spark, database):
    other = Contract("others", CONTRACT.schema, ("id",))
    assert published(spark, database) == {}
    switch(spark, database, [stage(_things(spark, n), database, c) for c, n in ((CONTRACT, 5), (other, 6))])
    first = stage(_things(spark, 50), database, CONTRACT)
    assert {n: df.count() for n, df in published(spark, database).items()} == {"things": 5, "others": 6}
    with pytest.raises(QualityError):
        stage(_things(spark, 5).unionByName(_things(spark, 1)), database, other, _unique)
    assert spark.table(f"{database}.things").count() == 5
    discard(spark, database, [first])
    switch(spark, database, [stage(_things(spark, 7), database, CONTRACT)])
    assert {n: df.count() for n, df in published(spark, database).items()} == {"things": 7, "others": 6}


def test_a_switch_in_between_is_kept(spark, database, monkeypatch):
    """Two refreshes of different tables take the same record number; the second one tries again."""
    other = Contract("others", CONTRACT.schema, ("id",))
    staged, add, raced = stage(_things(spark, 5), database, CONTRACT), Records.add, []

    def racing(self, number, record):
        if not raced:
            raced.append(True)
            publish(_things(spark, 6), database, other)
        return add(self, number, record)

    monkeypatch.setattr(Records, "add", racing)
    switch(spark, database, [staged])
    assert {n: df.count() for n, df in published(spark, database).items()} == {"things": 5, "others": 6}


def test_lines_that_do_not_fit_are_kept_whole(spark, database, tmp_path):
    lines = ["id,grp", "1,1", "2", "3,3,more", "x,4", '"5",5', '"6,6', ",7"]
    (tmp_path / "things.csv").write_text("\n".join(lines) + "\n")
    contract = Contract("things", T.StructType([*CONTRACT.schema.fields, *[T.StructField(n, t) for n, t in (("_source_file", T.StringType()), ("_ingested_at", T.TimestampType()))]]))
    publish(with_audit(scan_csv(spark, f"{tmp_path}/things.csv", CONTRACT.schema, rejects=True)), database, contract, hidden=(REJECTED,))
    table, rejects = spark.table(f"{database}.things"), spark.table(f"{database}.things_rejects")
    assert table.columns == contract.columns
    assert sorted(r[REJECTED] for r in rejects.collect()) == sorted(["2", "3,3,more", "x,4", '"6,6'])
    assert sorted((r.id or -1, r.grp or -1) for r in table.collect()) == [(-1, -1), (-1, 4), (-1, 7), (1, 1), (2, -1), (3, 3), (5, 5)]
    assert all(r["_source_file"].endswith("things.csv") for r in rejects.collect())


def test_writers_at_once_lose_no_record(spark, tmp_path):
    folder, writers, each = f"{tmp_path}/records", 8, 12

    def write(writer: int) -> list[int]:
        records, taken = Records(spark, folder), []
        while len(taken) < each:
            last = records.latest() or {"number": -1, "seen": []}
            try:
                records.add(last["number"] + 1, {"seen": [*last["seen"], writer]})
                taken.append(last["number"] + 1)
            except FileExistsError:
                continue
        return taken

    with ThreadPoolExecutor(writers) as pool:
        taken = list(pool.map(write, range(writers)))
    records = Records(spark, folder)
    assert sorted(n for own in taken for n in own) == records.numbers() == list(range(writers * each))
    by = {n: w for w, own in enumerate(taken) for n in own}
    for n in records.numbers():
        assert records.get(n)["seen"] == [by[m] for m in range(n + 1)]
    assert {p.name for p in tmp_path.joinpath("records").iterdir()} == {f"{n:020d}.json" for n in by}
