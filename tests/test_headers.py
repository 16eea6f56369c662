import pytest
from hypothesis import given
from hypothesis import strategies as st

from barloom.functions import check_unique, clean_header, clean_headers, project
from barloom import schemas


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Pretax Income (Loss), Adj.", "Pretax_Income_Loss_Adj"),
        ("Adj. Close", "Adj_Close"),
        ("Shares (Basic)", "Shares_Basic"),
        ("Company Name", "Company_Name"),
        ("Ticker", "Ticker"),
        (" Report Date ", "Report_Date"),
    ],
)
def test_known_headers(raw, clean):
    assert clean_header(raw) == clean


@given(st.text())
def test_cleaning_twice_equals_once(name):
    try:
        once = clean_header(name)
    except ValueError:
        return
    assert clean_header(once) == once


def test_empty_header_is_refused():
    with pytest.raises(ValueError):
        clean_header("(.)")


def test_collision_is_refused(spark):
    with pytest.raises(ValueError, match="collide"):
        clean_headers(spark.createDataFrame([(1, 2)], "`a.b` int, `a b` int"))
    with pytest.raises(ValueError, match="collide"):
        check_unique(["Year", "year"])


def test_dotted_header_is_usable_after_cleaning(spark):
    df = clean_headers(spark.createDataFrame([(1.5,)], "`Adj. Close` double"))
    assert df.select("Adj_Close").first()[0] == 1.5


def test_projection_fills_and_casts(spark):
    df = spark.createDataFrame([("A", "2024-01-02", 7, "x"), ("B", "soon", 8, "y")],
                               "ticker string, Date string, Volume int, other string")
    out = project(df, schemas.PRICES)
    assert out.schema == schemas.PRICES
    first, second = out.orderBy("Ticker").collect()
    assert str(first.Date) == "2024-01-02" and first.Volume == 7 and first.Close is None
    assert second.Date is None
