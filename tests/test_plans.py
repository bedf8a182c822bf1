"""Plans keep their shape: few shuffles, pruned scans, early limits, no products."""

import re

from pyspark.sql import functions as F

from tests.oracle import plan_text
from ticketspark.catalog import QUERIES
from ticketspark.catalog import fixtures as fx
from ticketspark.operators import aggregate, clean, joins


def shuffles(text):
    return len(re.findall(r"Exchange (hash|range|SinglePartition|RoundRobin)", text))


def scanned(text):
    return re.findall(r"FileScan parquet \[([^\]]*)\]", text)


def test_features_need_one_shuffle_for_counting_and_one_for_series(spark, data):
    text = plan_text(QUERIES["f4_daily_rolling_features"](spark, data))
    assert shuffles(text) == 2
    assert [re.sub(r"#\d+L?", "", s) for s in scanned(text)] == ["o_orderdate,o_orderpriority"]


def test_counts_combine_before_the_shuffle(spark, data):
    text = plan_text(QUERIES["d1_daily_count"](spark, data))
    assert shuffles(text) == 1 and "partial_count" in text
    assert len(scanned(text)[0].split(",")) == 2


def test_pivot_is_one_aggregate(spark, data):
    assert shuffles(plan_text(QUERIES["d4_pivot_count"](spark, data))) == 1


def test_cleaning_is_narrow(spark, data):
    assert shuffles(plan_text(QUERIES["b12_clean_events"](spark, data))) == 0


def test_worst_days_limit_before_the_shuffle(spark, data):
    text = plan_text(QUERIES["f12_worst_days"](spark, data))
    assert re.search(r"WindowGroupLimit.*Partial", text)


def test_top_n_is_not_a_full_sort(spark, data):
    assert "TakeOrderedAndProject" in plan_text(QUERIES["s2_top_n"](spark, data))


def test_filters_reach_the_scan(spark, data):
    df = clean.crop_dates(fx.tickets(spark, data), "1997-01-01", "1998-01-01").where("agency = '2-HIGH'")
    text = plan_text(df.select("ticket_id"), "formatted")
    assert "EqualTo(o_orderpriority,2-HIGH)" in text


def test_attached_key_table_leaves_the_large_side_in_place(spark, data):
    big = fx.table(spark, data, "lineitem").select("l_orderkey", "l_suppkey", "l_quantity")
    text = plan_text(aggregate.group_mean(big, "l_suppkey", "l_quantity", "m"))
    assert "BroadcastHashJoin" in text and shuffles(text) == 0


def test_salted_join_spreads_a_hot_key(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(4000).select("id", F.lit(1).alias("k"))
        out = joins.salted_join(big, big.select("k").distinct().withColumn("v", F.lit(2)), ["k"])
        used = out.select(F.spark_partition_id().alias("p")).distinct().count()
        assert out.count() == 4000
        assert used > 1 or spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled") == "true"
        assert "_salt" in plan_text(out)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
