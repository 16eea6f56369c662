import random

import pytest
from pyspark.sql import functions as F

import barloom
from barloom.plans.reports import ANNUAL_ORDER, MONTHLY_ORDER
from barloom.sinks import ordered_between, ordered_head, save_ordered
from tests.helpers import plan, rows


def _report(spark, size=4000):
    rng = random.Random(6)
    years = [None, *range(2000, 2024)]
    data = [(rng.choice([None, *"ABCDEFG"]), rng.choice(years), rng.choice([None, 1, 2, 12]), i) for i in range(size)]
    return spark.createDataFrame(data, "Ticker string, Year long, Month long, v int").repartition(5)


def _scanned(df):
    """Rows that the scans of an executed query gave."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    node = node.executedPlan() if "AdaptiveSparkPlan" in node.nodeName() else node
    found, todo = 0, [node]
    while todo:
        node = todo.pop()
        if node.nodeName().startswith("Scan parquet"):
            found += node.metrics().apply("numOutputRows").value()
        children = node.children()
        todo += [children.apply(i) for i in range(children.size())]
    return found


@pytest.mark.parametrize("n", [0, 1, 50, 700, 9999])
def test_head_equals_the_sorted_report(spark, tmp_path, n):
    report = _report(spark)
    path = save_ordered(report, str(tmp_path / "o"), [*MONTHLY_ORDER, "v"], files=12)
    expected = report.orderBy(F.desc("Year"), F.desc("Month"), "Ticker", "v").limit(n)
    assert [tuple(r) for r in ordered_head(spark, path, n).collect()] == [tuple(r) for r in expected.collect()]


def test_head_reads_few_files_and_rows(spark, tmp_path):
    report = _report(spark, 20_000)
    path = save_ordered(report, str(tmp_path / "o"), [*ANNUAL_ORDER, "v"], files=40)
    head = ordered_head(spark, path, 50)
    assert len(head.inputFiles()) == 1
    assert _scanned(head) < 2_000
    assert [tuple(r) for r in head.collect()] == [
        tuple(r) for r in barloom.newest_first(report).orderBy(F.desc("Year"), "Ticker", "v").limit(50).collect()
    ]


def test_ranges_read_their_row_groups(spark, tmp_path):
    report = _report(spark, 20_000)
    path = save_ordered(report, str(tmp_path / "o"), ANNUAL_ORDER, files=10, row_group=4_096)
    since = ordered_between(spark, path, low=2022)
    assert len(since.inputFiles()) <= 3
    assert "PushedFilters: [IsNotNull(Year), GreaterThanOrEqual(Year,2022)]" in plan(since)
    assert rows(since) == rows(report.where("Year >= 2022"))
    assert _scanned(since) < 5_000
    assert rows(ordered_between(spark, path, 2005, 2006)) == rows(report.where("Year between 2005 and 2006"))
    assert rows(ordered_between(spark, path)) == rows(report.where("Year is not null"))
    assert ordered_between(spark, path, low=3000).count() == 0


def test_saving_again_and_empty_reports(spark, tmp_path):
    path = save_ordered(_report(spark), str(tmp_path / "o"), ANNUAL_ORDER, files=3)
    reader = ordered_head(spark, path, 10_000)
    save_ordered(_report(spark, 0), path, ANNUAL_ORDER, files=3)
    assert reader.count() == 4_000
    empty = ordered_head(spark, path, 5)
    assert empty.count() == 0 and empty.columns == ["Ticker", "Year", "Month", "v"]
    assert ordered_between(spark, path, low=1).count() == 0
    with pytest.raises(ValueError, match="no ordered table"):
        ordered_head(spark, str(tmp_path / "none"), 5)


def test_equal_rows_share_a_file(spark, tmp_path):
    same = spark.range(5_000).select(F.lit(2020).cast("long").alias("Year"), F.lit("A").alias("Ticker"))
    path = save_ordered(same.repartition(7), str(tmp_path / "o"), ANNUAL_ORDER, files=8)
    assert ordered_head(spark, path, 4_999).count() == 4_999
    assert len(ordered_head(spark, path, 1).inputFiles()) == 1
