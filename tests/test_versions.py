import threading
import time

import pytest
from pyspark.sql import functions as F

from barloom.sinks import catalog, replace_table, versions
from tests.helpers import plan


def _rows(spark, n, value):
    return spark.range(n).select(F.lit(value).alias("v"), (F.col("id") % 3 + 2020).alias("Year"))


@pytest.fixture
def database(spark, tmp_path, request):
    name = "versions_" + str(abs(hash(request.node.name)))[:9]
    catalog.create_database(spark, name, str(tmp_path / "db"))
    return name


def test_readers_see_old_or_new_and_never_none(spark, database):
    name = f"{database}.t"
    replace_table(_rows(spark, 60, 0), name)
    seen, failed, stop = [], [], threading.Event()

    def read():
        while not stop.is_set():
            try:
                found = spark.table(name).groupBy("v").count().collect()
                seen.append(tuple((r.v, r["count"]) for r in found))
            except Exception as error:  # noqa: BLE001
                failed.append(error)

    readers = [threading.Thread(target=read) for _ in range(3)]
    for r in readers:
        r.start()
    for value in range(1, 6):
        replace_table(_rows(spark, 60, value), name, keep=3)
        time.sleep(0.2)
    stop.set()
    for r in readers:
        r.join()
    assert not failed, failed[0]
    # Always one whole version, and several of them over time.
    assert {len(s) for s in seen} == {1} and {s[0][1] for s in seen} == {60}
    assert len({s[0][0] for s in seen}) > 1


def test_a_started_reader_can_finish(spark, database):
    name = f"{database}.t"
    before = replace_table(_rows(spark, 30, 1), name)
    after = replace_table(_rows(spark, 40, 2), name)
    assert (before.count(), after.count()) == (30, 40)


def test_old_versions_go_with_their_files(spark, database, tmp_path):
    name = f"{database}.t"
    for value in range(4):
        replace_table(_rows(spark, 9, value), name, keep=1)
    kept = versions(spark, name)
    assert len(kept) == 2 and spark.table(name).first().v == 3
    # The first version had the plain folder, which is free again.
    assert sorted(p.name for p in (tmp_path / "db").iterdir()) == sorted(v.split(".")[1] for v in kept)


def test_a_failed_write_changes_nothing(spark, database, tmp_path):
    name = f"{database}.t"
    replace_table(_rows(spark, 9, 1), name)
    broken = _rows(spark, 9, 2).withColumn("v", F.raise_error(F.lit("no")).cast("int"))
    with pytest.raises(Exception, match="no"):
        replace_table(broken, name)
    assert spark.table(name).where("v = 1").count() == 9
    assert len(versions(spark, name)) == 1
    assert [p.name for p in (tmp_path / "db").iterdir()] == ["t"]


def test_columns_may_change_and_partitions_are_pruned(spark, database):
    name = f"{database}.t"
    replace_table(_rows(spark, 9, 1), name)
    replace_table(_rows(spark, 9, 1).withColumn("w", F.lit("x")), name)
    assert spark.table(name).columns == ["v", "w", "Year"]
    assert "PartitionFilters: [isnotnull(Year" in plan(spark.table(name).where("Year = 2021"))
    assert replace_table(_rows(spark, 0, 1), name).count() == 0


def test_a_plain_table_is_not_switched(spark, database):
    name = f"{database}.t"
    catalog.save_table(_rows(spark, 9, 1), name)
    with pytest.raises(ValueError, match="plain table"):
        replace_table(_rows(spark, 9, 2), name)
    assert spark.table(name).count() == 9


def test_views_are_altered_in_place(spark, database, monkeypatch):
    name = f"{database}.v"
    said = []
    sql = type(spark).sql
    monkeypatch.setattr(type(spark), "sql", lambda self, text, *a, **b: (said.append(text), sql(self, text, *a, **b))[1])
    assert catalog.create_view(spark, name, "SELECT 1 AS a").collect() == [(1,)]
    assert catalog.create_view(spark, name, "SELECT 2 AS b, 3 AS c").collect() == [(2, 3)]
    assert [s.split()[0] for s in said] == ["CREATE", "ALTER"]


def test_names_that_begin_alike_are_kept_apart(spark, database):
    replace_table(_rows(spark, 3, 1), f"{database}.t")
    replace_table(_rows(spark, 3, 2), f"{database}.t_other")
    assert len(versions(spark, f"{database}.t")) == 1
