from barloom.session import get_session
from tests.helpers import plan


def test_given_shuffle_partitions_reach_the_plan(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        df = get_session().range(1000).selectExpr("id % 7 as k").groupBy("k").count()
        assert ", 37)" in plan(df).partition("hashpartitioning(k")[2].partition("\n")[0]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
