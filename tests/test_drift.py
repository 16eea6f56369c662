import datetime as dt
import decimal

import pytest
from pyspark.sql import types as T

from barloom import schemas
from barloom.sources import drift, files, read_drifting
from tests.helpers import plan, rows


def _write(spark, path, ddl, *data):
    spark.createDataFrame(list(data), ddl).coalesce(1).write.mode("append").parquet(str(path))


def test_files_are_grouped_by_their_footer(spark, tmp_path):
    _write(spark, tmp_path / "t", "Ticker string, v int", ("A", 1))
    _write(spark, tmp_path / "t", "Ticker string, v int", ("B", 2))
    _write(spark, tmp_path / "t", "Ticker string, v bigint", ("C", 2**40))
    assert sorted(len(f) for _, f in drift.footers(spark, str(tmp_path / "t"))) == [1, 2]


def test_headers_types_and_columns_are_brought_together(spark, tmp_path):
    path = tmp_path / "t"
    _write(spark, path, "Ticker string, `Adj. Close` double, Volume bigint", ("A", 1.5, 2**40))
    _write(spark, path, "ticker string, adj_close decimal(10,2), volume int", ("B", decimal.Decimal("2.25"), 7))
    _write(spark, path, "Ticker string, Volume smallint, `New (x)` string", ("C", 3, "x"))
    _write(spark, path, "Volume tinyint, Ticker string, Adj_Close float", (1, "D", 0.5))
    got = read_drifting(spark, str(path), keys=["Ticker"])
    by = {r.Ticker: r for r in got.select("Ticker", "Adj_Close", "Volume", "New_x").collect()}
    assert dict(got.dtypes) == {"Ticker": "string", "Adj_Close": "double", "Volume": "bigint", "New_x": "string"}
    assert {t: tuple(r)[1:] for t, r in by.items()} == {
        "A": (1.5, 2**40, None), "B": (2.25, 7, None), "C": (None, 3, "x"), "D": (0.5, 1, None)
    }
    declared = read_drifting(spark, str(path / "*.parquet"), schemas.PRICES, ["Ticker"])
    assert declared.schema == schemas.PRICES and declared.count() == 4
    assert "ReadSchema: struct<Volume:bigint>" in plan(declared.select("Volume"))


def test_a_file_without_a_key_is_refused_by_name(spark, tmp_path):
    path = tmp_path / "t"
    _write(spark, path, "Ticker string, Date date", ("A", dt.date(2024, 1, 1)))
    _write(spark, path, "Symbol string, Date date", ("B", dt.date(2024, 1, 1)))
    with pytest.raises(ValueError, match=r"part-.*lack the keys \['Ticker'\]"):
        read_drifting(spark, str(path), schemas.PRICES, schemas.PRICE_KEYS)
    assert read_drifting(spark, str(path)).count() == 2
    with pytest.raises(ValueError, match=r"lacks the keys \['Volume'\]"):
        files.read_parquet(spark, str(path), schemas.PRICES, keys=["Volume"])


def test_a_type_that_would_be_cut_is_refused(spark, tmp_path):
    path = tmp_path / "t"
    _write(spark, path, "Ticker string, Volume double", ("A", 1.5))
    with pytest.raises(ValueError, match="Volume: double to bigint"):
        read_drifting(spark, str(path), schemas.PRICES)


def test_partition_keys_of_directories(spark, tmp_path):
    path = tmp_path / "t"
    _write(spark, path / "Year=2020", "v int", (1,))
    _write(spark, path / "Year=2021", "v bigint", (2,))
    assert rows(read_drifting(spark, str(path)).select("v", "Year")) == [(1, 2020), (2, 2021)]


@pytest.mark.parametrize(
    "a, b, expected",
    [
        ("int", "bigint", "bigint"),
        ("bigint", "double", "double"),
        ("float", "bigint", "double"),
        ("date", "timestamp", "timestamp"),
        ("date", "int", "string"),
        ("string", "double", "string"),
        ("decimal(10,2)", "decimal(8,4)", "decimal(12,4)"),
        ("decimal(10,2)", "bigint", "decimal(22,2)"),
        ("decimal(38,2)", "decimal(38,10)", "double"),
        ("decimal(10,2)", "float", "double"),
        ("decimal(10,2)", "date", "string"),
    ],
)
def test_least_common_types(a, b, expected):
    a, b, expected = (T.StructType.fromDDL(f"c {k}")["c"].dataType for k in (a, b, expected))
    assert drift.wider(a, b) == drift.wider(b, a) == expected
