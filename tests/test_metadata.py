import pytest
from pyspark.sql import functions as F

import barloom
from barloom import schemas
from barloom.sinks import catalog, current_version, replace_table
from tests.helpers import plan, rows


@pytest.fixture
def database(spark, tmp_path, request):
    name = "metadata_" + str(abs(hash(request.node.name)))[:9]
    catalog.create_database(spark, name, str(tmp_path / "db"))
    return name


def _fundamentals(spark, years=(2019, 2021, None, 2020)):
    data = [(f"T{i}", None, 2e9 + i, *[20.0] * 7, y) for i, y in enumerate(years * 3)]
    return spark.createDataFrame(data, schemas.STOCK_FUNDAMENTALS)


@pytest.mark.parametrize("save", [replace_table, catalog.save_table])
def test_latest_year_comes_from_the_partitions(spark, database, save):
    name = f"{database}.f"
    save(_fundamentals(spark), name)
    assert barloom.latest_partition(spark, name) == 2021
    assert rows(barloom.stored_latest_year(spark, name)) == rows(barloom.latest_year(spark.table(name)))


def test_partitions_without_rows_are_passed_over(spark, database):
    name = f"{database}.f"
    catalog.save_table(_fundamentals(spark), name)
    spark.sql(f"ALTER TABLE {name} ADD PARTITION (Year = 2050)")
    assert barloom.latest_partition(spark, name) == 2021
    replace_table(_fundamentals(spark, (None,)), f"{database}.g")
    assert barloom.latest_partition(spark, f"{database}.g") is None
    assert barloom.stored_top_performers(spark, f"{database}.g").count() == 0
    replace_table(_fundamentals(spark, ()), f"{database}.h")
    assert rows(barloom.stored_latest_year(spark, f"{database}.h")) == [(None,)]


def test_other_keys_of_a_partition(spark, database):
    df = spark.createDataFrame([(1, 2020, 12), (1, 2021, 3), (1, None, 30)], "v int, Year long, Month long")
    replace_table(df, f"{database}.p", keys=["Year", "Month"])
    found = [barloom.latest_partition(spark, f"{database}.p", k) for k in ("Year", "Month")]
    assert found == [2021, 30]


def test_counts_and_years_read_no_data_column(spark, database):
    name = f"{database}.f"
    replace_table(_fundamentals(spark), name)
    counts = barloom.stored_row_counts(spark, {"one": name, "two": name})
    assert rows(counts) == [("one", 12), ("two", 12)]
    assert plan(counts).count("ReadSchema: struct<>") == 2
    year = spark.table(current_version(spark, name)).where(F.col("Year") == 2021).limit(1).select(F.lit(1))
    assert "ReadSchema: struct<>" in plan(year)


def test_top_performers_read_one_partition(spark, database):
    name = f"{database}.f"
    replace_table(_fundamentals(spark), name)
    got = barloom.stored_top_performers(spark, name, n=2)
    assert "(Year" in plan(got) and "= 2021)" in plan(got) and "Subquery" not in plan(got)
    assert [tuple(r) for r in got.collect()] == [
        tuple(r) for r in barloom.top_performers(spark.table(name), n=2).collect()
    ]


def test_current_version_of_a_replaced_table_and_of_other_views(spark, database):
    name = f"{database}.f"
    for _ in range(2):
        replace_table(_fundamentals(spark), name)
    assert current_version(spark, name).startswith(f"{database}.f__v")
    catalog.create_view(spark, f"{database}.v", f"SELECT Ticker FROM {name}")
    with pytest.raises(ValueError, match="does not show a version"):
        current_version(spark, f"{database}.v")
