"""The physical plans we rely on: pruning, push-down, few exchanges, split hot keys."""

from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from tierline import VersionedTable
from tierline.operators import cleaning, dml, joins, rollup

SF = "/root/testdata/sf0.001"
SPLIT_SOON = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20000",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20000",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


@contextmanager
def settings(spark, values):
    before = {k: spark.conf.get(k, None) for k in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


@pytest.fixture
def hot(spark, folder):
    """A third of the rows share one key."""
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k")
    spark.range(0, 120000, 1, 8).select(key, F.sha2(F.col("id").cast("string"), 256).alias("v")).write.parquet(
        f"{folder}/hot"
    )
    spark.range(50000).select(F.col("id").alias("k"), F.lit("new").alias("v")).write.parquet(f"{folder}/few")
    return spark.read.parquet(f"{folder}/hot"), spark.read.parquet(f"{folder}/few")


@pytest.mark.parametrize("shape", ["semi", "inner", "merge", "merge unique"])
def test_hot_keys_are_split(spark, hot, shape):
    big, few = hot
    made = {
        "semi": lambda: joins.keep_known_keys(big, "k", few, "k"),
        "inner": lambda: joins.inner_join(big, few.select(F.col("k").alias("q")), "k", "q"),
        "merge": lambda: dml.merge(big, few, ["k"]),
        "merge unique": lambda: dml.merge(big, few, ["k"], unique=True),
    }[shape]
    with settings(spark, SPLIT_SOON):
        assert "skew=true" in final_plan(made())


def test_table_merge_with_a_hot_target_key(spark, folder, hot):
    big, few = hot
    table = VersionedTable(spark, f"{folder}/t")
    table.replace(big)
    with settings(spark, SPLIT_SOON):
        commit = table.merge(few, "k")
    matched = big.join(few.select("k"), "k", "left_semi").count()
    assert commit.metrics["updated"] == matched
    assert table.read().filter("k = 7").select("v").distinct().count() == 1
    assert table.read().count() == big.count() + commit.metrics["inserted"]


def test_rollup_has_one_exchange_after_partial_sums(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    text = plan(rollup.monthly_rollup(events, "ts", ["user_id"], ["value"]))
    assert text.count("Exchange") == 1 and "partial_sum" in text
    assert "props" not in text.split("ReadSchema")[1]


def test_filters_reach_the_scan(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan(cleaning.keep_positive(orders, "o_totalprice"))
    assert "GreaterThan(o_totalprice,0.0)" in text


def test_filters_reach_the_scan_of_a_table(spark, table):
    table.replace(spark.read.parquet(f"{SF}/orders.parquet"), partition_by=["o_orderstatus"])
    text = plan(table.read().filter("o_orderstatus = 'F' and o_orderkey = 5").select("o_totalprice"))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text
    assert "EqualTo(o_orderkey,5)" in text and "o_custkey" not in text


def test_small_known_keys_are_broadcast_by_size(spark):
    customers = spark.read.parquet(f"{SF}/customer.parquet")
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    text = final_plan(joins.keep_known_keys(customers, "c_custkey", orders, "o_custkey"))
    assert "BroadcastHashJoin" in text and "LeftSemi" in text


def test_no_python_in_the_plans(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    text = plan(dml.merge(orders, orders, ["o_orderkey"]))
    assert "Python" not in text and "Pandas" not in text


def test_latest_rows_are_not_sorted_in_whole(spark):
    events = spark.read.parquet(f"{SF}/events.parquet")
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        found = dml.latest_per_key(events, ["user_id"], ["ts"])
        single = plan(found).split("Union")[1].split("max_by")[0]
    assert "ShuffledHashJoin" in single and "SortMergeJoin" not in plan(found)
    sorts = [line for line in single.splitlines() if " Sort " in line or " SortAggregate" in line]
    assert not any("props" in line for line in sorts)


def test_latest_row_of_a_hot_key(spark, folder):
    rows = spark.range(0, 200000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id", F.sha2(F.col("id").cast("string"), 256).alias("v")
    )
    found = dml.latest_per_key(rows, ["k"], ["id"])
    assert found.filter("k = 7").first()["id"] == 199998 and found.count() == rows.select("k").distinct().count()


def test_rows_without_a_match_are_dropped_before_the_shuffle(spark, folder):
    spark.range(0, 200000, 1, 8).select((F.col("id") * 7).alias("k"), F.col("id").cast("string").alias("s"), F.lit("x" * 50).alias("v")).write.parquet(f"{folder}/t")
    target = spark.read.parquet(f"{folder}/t")
    keys = target.filter("k % 49 = 0 and k < 70000").select("k", "s").unionByName(spark.range(100).select((F.col("id") * 7 + 3).alias("k"), F.lit(None).cast("string").alias("s")))
    count = keys.count()
    for on in (["k"], ["k", "s"]):
        likely = joins.likely_keys(target, keys, on, count)
        assert likely.columns == target.columns
        matches = target.join(keys.select(*on).distinct(), on, "left_semi").count()
        assert matches <= likely.count() <= matches + 0.04 * 200000
        assert likely.join(keys.select(*on).distinct(), on, "left_semi").count() == matches
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "1000", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}):
        joined = joins.likely_keys(target, keys, ["k"], count).join(keys.select(F.col("k").alias("q")), F.col("k") == F.col("q"))
        text = final_plan(joined)
        below = text[text.index("SortMergeJoin"):] if "SortMergeJoin" in text else text
        assert "BroadcastHashJoin" in below and below.index("Exchange hashpartitioning") < below.index("BroadcastHashJoin")
    assert not joins.can_filter(target.select(F.col("k").cast("double").alias("k")), ["k"], 10)
    assert not joins.can_filter(target, ["k"], joins.MOST_WORDS * 64) and not joins.can_filter(target, ["k"], 0)


def test_merge_uses_the_filter_for_a_source_beyond_broadcast(spark, folder, monkeypatch):
    table = VersionedTable(spark, f"{folder}/m")
    rows = spark.range(0, 50000, 1, 4).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    table.replace(rows)
    used = []
    likely = joins.likely_keys
    monkeypatch.setattr(joins, "likely_keys", lambda *a: used.append(a[3]) or likely(*a))
    changes = spark.range(49000, 51000).select(F.col("id").alias("k"), F.lit("new").alias("v"))
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "1000"}):
        commit = table.merge(changes, "k")
    assert used == [2000] and (commit.metrics["updated"], commit.metrics["inserted"]) == (1000, 1000)
    assert table.read().groupBy("v").count().orderBy("v").collect() == [("new", 2000), ("old", 49000)]
    table.merge(changes, "k")
    assert used == [2000]


def scanned_rows(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_row_groups_without_the_value_are_not_read(spark, folder):
    rows = spark.range(0, 100000, 1, 1).select(F.xxhash64("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("s")).repartition(8)
    plain, found = VersionedTable(spark, f"{folder}/p"), VersionedTable(spark, f"{folder}/f", find_by=["k", "s"])
    for t in (plain, found):
        t.replace(rows)
    row = rows.first()
    for condition in (F.col("k") == row.k, F.col("s") == row.s, F.col("k").isin(row.k, 5)):
        assert plain.read().filter(condition).collect() == found.read().filter(condition).collect() == [row]
        assert scanned_rows(found.read().filter(condition)) <= 3 * 12500 < scanned_rows(plain.read().filter(condition))


def test_values_of_columns_are_counted_one_column_at_a_time(spark):
    from tierline.plans.queries import QUERIES

    found = QUERIES["profile_sketches"](spark, SF)
    assert "Expand" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert all(r.distinct_near and r.quantiles_near for r in found.collect())
