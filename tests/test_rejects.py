import datetime as dt

import barloom
from barloom import schemas
from barloom.plans import pipeline
from barloom.sources import all_rejects, deliver_prices, deliver_statement, files, reject_counts
from tests.helpers import rows

PRICES = (
    "Date;Ticker;Extra;Adj. Close;Volume;Close\n"
    "05/01/2024;A;x;1.5;7;2\n"
    "not a date;B;y;zzz;;\n"
    "06/01/2024;C;x;1,5;12.5; \n"
    "07/01/2024;D;x;1;7;2;9;9\n"
    "08/01/2024;E\n"
    '"";F;"a;b";" 3 ";1e3;NaN\n'
)
INCOME = "Ticker;Report Date;Revenue;Net Income\nA;31/12/2023;10;1\nB;31/02/2023;ten;1\n;;;\n"
FORMAT = {"date_format": "dd/MM/yyyy"}


def _root(tmp_path, **texts):
    for name, text in texts.items():
        (tmp_path / f"us-{name.replace('_', '-')}.csv").write_text(text)
    return str(tmp_path)


def _cells(delivery):
    return rows(delivery.rejects.select("column", "value", "reason"))


def test_cells_and_rows_are_rejected_with_their_text(spark, tmp_path):
    root = _root(tmp_path, shareprices_daily=PRICES)
    got = deliver_prices(spark, root, **FORMAT)
    assert _cells(got) == sorted(
        [
            (None, "07/01/2024;D;x;1;7;2;9;9", "other number of fields"),
            (None, "08/01/2024;E", "other number of fields"),
            ("Adj_Close", "1,5", "not a double"),
            ("Adj_Close", "zzz", "not a double"),
            ("Date", "not a date", "not a date"),
            ("Volume", "12.5", "not a bigint"),
            ("Volume", "1e3", "not a bigint"),
        ],
        key=lambda r: (r[0] is not None, r),
    )
    assert {r.file.rsplit("/", 1)[1] for r in got.rejects.collect()} == {"us-shareprices-daily.csv"}
    record = got.rejects.where("column = 'Volume' and value = '12.5'").first().record
    assert record == "06/01/2024;C;x;1,5;12.5; "


def test_rows_are_those_of_the_plain_reader(spark, tmp_path):
    root = _root(tmp_path, shareprices_daily=PRICES, income_annual=INCOME)
    plain = files.read_prices(spark, root, **FORMAT)
    got = deliver_prices(spark, root, **FORMAT).rows
    assert got.schema == plain.schema
    keep = ["Ticker", "Date", "Adj_Close", "Extra"]
    known = "Ticker in ('A', 'B', 'C', 'D', 'E')"
    assert rows(got.where(known).select(*keep)) == rows(plain.where(known).select(*keep))
    padded = got.where("Ticker = 'F'").first()
    assert (padded.Adj_Close, padded.Extra, padded.Volume) == (3.0, "a;b", None)
    income = deliver_statement(spark, root, "income", **FORMAT)
    assert rows(income.rows) == rows(files.read_income(spark, root, **FORMAT))


def test_blank_cells_are_no_rejects(spark, tmp_path):
    root = _root(tmp_path, income_annual=INCOME)
    got = deliver_statement(spark, root, "income", **FORMAT)
    assert _cells(got) == [("Report_Date", "31/02/2023", "not a date"), ("Revenue", "ten", "not a double")]
    assert got.rows.count() == 3


def test_staged_text_is_parsed_once(spark, tmp_path):
    root = _root(tmp_path, income_annual=INCOME)
    got = deliver_statement(spark, root, "income", stage=str(tmp_path / "stage"), **FORMAT)
    (tmp_path / "us-income-annual.csv").write_text("Ticker\nZ\n")
    assert {r.Ticker for r in got.rows.collect()} == {"A", "B", None}
    assert got.rejects.count() == 2


def test_counts_and_empty_deliveries(spark, tmp_path):
    root = _root(tmp_path, income_annual=INCOME, shareprices_daily="Ticker;Date\n")
    found = {
        "income": deliver_statement(spark, root, "income", **FORMAT),
        "prices": deliver_prices(spark, root, **FORMAT),
    }
    assert rows(reject_counts(all_rejects(found))) == [
        ("income", "Report_Date", "not a date", 1),
        ("income", "Revenue", "not a double", 1),
    ]
    assert found["prices"].rows.schema == schemas.PRICES_RAW and found["prices"].rows.count() == 0


def test_a_run_counts_what_it_rejected_and_forgets_it_with_the_next(spark, tmp_path):
    source = tmp_path / "source"
    source.mkdir()
    empty = "Ticker;Report Date\n"
    _root(source, income_annual=INCOME, balance_annual=empty, cashflow_annual=empty, shareprices_daily=PRICES)
    lake = str(tmp_path / "lake")
    found = pipeline.deliveries(spark, str(source), **FORMAT)
    pipeline.extract_deliveries(lake, found)
    for mode in pipeline.PARTITION_KEYS:
        barloom.run_transform(spark, lake, mode)
    counts = dict(rows(barloom.load(spark, lake, "rejects1", str(tmp_path / "db")).quality))
    assert counts["Rejected income.Revenue: not a double"] == 1
    assert counts["Rejected prices.Volume: not a bigint"] == 2
    assert counts["Rejected prices: other number of fields"] == 2
    assert counts["Rejected price dates"] == 1
    pipeline.extract(lake, **{name: d.rows for name, d in found.items()})
    counts = dict(rows(barloom.load(spark, lake, "rejects2", str(tmp_path / "db2")).quality))
    assert not [c for c in counts if c.startswith("Rejected ") and c != "Rejected price dates"]
    assert dt.date(2023, 12, 31) in {r[0] for r in found["income"].rows.select("Report_Date").collect()}
