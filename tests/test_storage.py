import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from barloom import schemas
from barloom.sinks import catalog, lake, scratch_dir
from barloom.sources import files
from tests.helpers import plan, rows

SCHEMA = "Ticker string, Date date, Year bigint, Month bigint"


def _dated(spark, days):
    data = [
        ("A", d, d.year if d else None, d.month if d else None) for d in days
    ]
    return spark.createDataFrame(data, SCHEMA)


DAYS = [dt.date(2023, 1, 5), dt.date(2023, 2, 6), dt.date(2024, 1, 7), None]


def test_partitioned_write_and_prune(spark, tmp_path):
    path = lake.write_partitioned(_dated(spark, DAYS), str(tmp_path / "t"), ["Year", "Month"])
    assert os.path.isdir(f"{path}/Year=2023/Month=2")
    assert os.path.isdir(f"{path}/Year=__HIVE_DEFAULT_PARTITION__")
    back = files.read_parquet(spark, path)
    assert {(r.Year, r.Month) for r in back.collect()} == {
        (2023, 1), (2023, 2), (2024, 1), (None, None),
    }
    text = plan(back.where("Year >= 2024 and Month = 1"))
    assert "PartitionFilters: [isnotnull(Year" in text


def test_static_overwrite_replaces_all_and_dynamic_only_what_it_has(spark, tmp_path):
    path = str(tmp_path / "t")
    lake.write_partitioned(_dated(spark, DAYS), path, ["Year"])
    lake.write_partitioned(
        _dated(spark, [dt.date(2024, 3, 1)] * 2), path, ["Year"], lake.OVERWRITE_TOUCHED
    )
    counts = dict(rows(spark.read.parquet(path).groupBy("Year").count()))
    assert counts == {None: 1, 2023: 2, 2024: 2}
    lake.write_partitioned(_dated(spark, [dt.date(2024, 3, 1)]), path, ["Year"])
    lake.write_partitioned(_dated(spark, [dt.date(2024, 3, 1)]), path, ["Year"])
    assert dict(rows(spark.read.parquet(path).groupBy("Year").count())) == {2024: 1}


def test_a_directory_gets_few_files(spark, tmp_path):
    df = _dated(spark, DAYS[:3] * 400).repartition(40)
    path = lake.write_partitioned(df, str(tmp_path / "t"), ["Year"])
    assert len([f for f in os.listdir(f"{path}/Year=2023") if f.endswith(".parquet")]) == 1


@pytest.mark.parametrize("typing, expected", [("STRINGS", "string"), ("AUTO", "bigint")])
@pytest.mark.parametrize("declared", [True, False])
def test_external_table(spark, tmp_path, typing, expected, declared):
    dated = _dated(spark, DAYS).withColumn("Date", F.col("Date").cast("string"))
    path = lake.write_partitioned(dated, str(tmp_path / "t"), ["Year", "Month"])
    catalog.create_database(spark, "ext", str(tmp_path / "db"))
    catalog.create_database(spark, "ext", str(tmp_path / "db"))
    schema = schemas.PRICES_EXTERNAL if declared else None
    table = catalog.register_external(spark, "ext.t", path, ["Year", "Month"], schema, typing)
    types = dict(table.dtypes)
    assert types["Year"] == types["Month"] == expected
    assert ("Close" in types) == declared
    years = {r[0] for r in table.selectExpr("try_cast(Year as bigint)").collect()}
    assert years == {2023, 2024, None}
    assert catalog.row_count(spark, "ext.t") == 4
    if declared:
        assert {r.Close for r in table.collect()} == {None}
    text = plan(table.selectExpr("Ticker", "cast(Year as bigint) as Y").where("Y = 2024"))
    assert "PartitionFilters: [isnotnull(Year" in text
    catalog.drop_table(spark, "ext.t")
    assert spark.read.parquet(path).count() == 4


def test_unknown_key_typing(spark, tmp_path):
    with pytest.raises(ValueError):
        catalog.register_external(spark, "ext.u", str(tmp_path), ["Year"], None, "GUESS")


def test_saved_table_and_view(spark, tmp_path):
    catalog.create_database(spark, "saved", str(tmp_path / "db"))
    catalog.save_table(_dated(spark, DAYS), "saved.t")
    table = catalog.save_table(_dated(spark, DAYS[:3]), "saved.t")
    assert table.count() == 3
    assert "PartitionFilters: [isnotnull(Year" in plan(table.where("Year = 2023"))
    view = catalog.create_view(spark, "saved.v", "SELECT Year, count(*) AS n FROM saved.t GROUP BY Year")
    assert rows(view) == [(2023, 2), (2024, 1)]
    catalog.create_view(spark, "saved.v", "SELECT max(Year) AS y FROM saved.t")
    assert rows(spark.table("saved.v")) == [(2024,)]


def test_raw_landing_cleans_headers(spark, tmp_path):
    df = spark.createDataFrame([("A", 1.5)], "Ticker string, `Adj. Close` double")
    path = lake.write_raw(df, str(tmp_path), "prices")
    assert path.endswith("/raw/prices")
    assert spark.read.parquet(f"{path}/*.parquet").columns == ["Ticker", "Adj_Close"]
    some = files.read_parquet(spark, path, schemas.PRICES)
    assert rows(some.select("Adj_Close", "Close")) == [(1.5, None)]
    assert "ReadSchema: struct<Adj_Close:double>" in plan(some.select("Adj_Close"))


def test_csv_export(spark, tmp_path):
    df = spark.createDataFrame(
        [("A, Inc", None, 1.5)], "Ticker string, `Shares (Basic)` bigint, `Adj. Close` double"
    )
    path = lake.export_csv(df, str(tmp_path / "csv"))
    back = spark.read.csv(path, header=True)
    assert rows(back) == [("A, Inc", None, "1.5")]
    assert back.columns == ["Ticker", "Shares_Basic", "Adj_Close"]


def _deliver(tmp_path, name, text):
    (tmp_path / name).write_text(text)
    return str(tmp_path)


def test_csv_columns_are_matched_by_name(spark, tmp_path):
    root = _deliver(
        tmp_path,
        "us-shareprices-daily.csv",
        "Date;Ticker;Extra;Adj. Close;Volume\n"
        "05/01/2024;A;x;1.5;7\n"
        "not a date;B;y;zzz;\n",
    )
    df = files.read_prices(spark, root, date_format="dd/MM/yyyy")
    assert df.drop("Extra").schema == schemas.PRICES_RAW
    assert sorted(r.Extra for r in df.collect()) == ["x", "y"]
    a, b = df.orderBy("Ticker").collect()
    assert (a.Ticker, a.Date, a.Adj_Close, a.Volume) == ("A", "2024-01-05", 1.5, 7)
    assert (b.Date, b.Adj_Close, b.Volume, b.Close) == ("not a date", None, None, None)
    path = f"{root}/us-shareprices-daily.csv"
    few = files.read_csv(spark, path, schemas.PRICES, date_format="dd/MM/yyyy", keep_all=False)
    assert few.schema == schemas.PRICES


def test_statement_variants(spark, tmp_path):
    head = "Ticker;Report Date;Revenue;Net Income;Pretax Income (Loss), Adj.\n"
    _deliver(tmp_path, "us-income-annual.csv", head + "A;2023-12-31;10;1;2\n")
    root = _deliver(tmp_path, "de-income-quarterly.csv", head + "B;2023-03-31;20;1;2\n")
    assert files.read_income(spark, root).first().Ticker == "A"
    other = files.read_income(spark, root, variant="quarterly", market="de")
    assert rows(other) == [("B", dt.date(2023, 3, 31), 20.0, 1.0, 2.0)]
    with pytest.raises(ValueError, match="unknown statement"):
        files.read_statement(spark, root, "ratings")


def test_scratch_is_below_the_checkpoint_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    first, second = scratch_dir(spark), scratch_dir(spark)
    assert first.startswith(base) and first != second


def test_scratch_needs_shared_storage_on_a_cluster(monkeypatch):
    class Conf:
        def get(self, name, default):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session())
    Context.master = "local[2]"
    assert scratch_dir(Session())


def test_raw_headers_are_found_by_clean_name(spark, tmp_path):
    raw = spark.createDataFrame([("A", 1.4)], "Ticker string, `Adj. Close` double")
    raw.write.parquet(str(tmp_path / "raw"))
    back = files.read_parquet(spark, str(tmp_path / "raw"), schemas.PRICES)
    assert back.schema == schemas.PRICES and back.first().Adj_Close == 1.4
    other = spark.createDataFrame([(1,)], "x int")
    other.write.parquet(str(tmp_path / "other"))
    with pytest.raises(ValueError, match="none of the declared"):
        files.read_parquet(spark, str(tmp_path / "other"), schemas.PRICES)


def test_text_keys_stay_text_when_types_are_inferred(spark, tmp_path):
    df = spark.createDataFrame([(1, "us"), (2, "de")], "v int, Market string")
    path = lake.write_partitioned(df, str(tmp_path / "m"), ["Market"])
    catalog.create_database(spark, "keys", str(tmp_path / "db"))
    table = catalog.register_external(spark, "keys.t", path, ["Market"], None, "AUTO")
    assert dict(table.dtypes)["Market"] == "string" and table.count() == 2
    lake.write_partitioned(df.withColumn("v", F.col("v") + 1), path, ["Market"])
    again = catalog.register_external(spark, "keys.t", path, ["Market"], None, "AUTO")
    assert sorted(r.v for r in again.collect()) == [2, 3]


def test_a_source_by_year_is_saved_as_it_lies(spark, tmp_path, monkeypatch):
    def moved(*_):
        raise AssertionError("rows are moved")

    path = lake.write_partitioned(_dated(spark, DAYS[:3] * 400), str(tmp_path / "t"), ["Year"])
    catalog.create_database(spark, "asis", str(tmp_path / "db"))
    monkeypatch.setattr(catalog, "clustered", moved)
    table = catalog.save_table(spark.read.parquet(path), "asis.t", cluster=False)
    assert table.count() == 1200 and len(table.inputFiles()) <= 4
    with pytest.raises(AssertionError, match="moved"):
        catalog.save_table(spark.read.parquet(path), "asis.u")
