import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierline.functions import date_parts, map_codes, whole_number
from tierline.operators import cleaning, joins, rollup


def test_names_are_normalised(spark):
    raw = spark.createDataFrame([(1, 2, 3)], ["SALE PRICE", "EASE-MENT", "ZIP CODE"])
    named = cleaning.normalise_names(raw, {"EASE-MENT": "EASEMENT"})
    assert named.columns == ["SALE_PRICE", "EASEMENT", "ZIP_CODE"]


def test_clashing_names_are_refused(spark):
    raw = spark.createDataFrame([(1, 2)], ["SALE PRICE", "SALE_PRICE"])
    with pytest.raises(ValueError, match="clash"):
        cleaning.normalise_names(raw)


@pytest.mark.parametrize(
    ("text", "number"),
    [
        (" -  ", None), ("", None), (None, None), ("0", 0), ("1", 1), (" 42 ", 42), ("12.5", 12),
        ("12.", 12), ("-7", -7), ("3000000000", None), ("1e3", None), ("12a", None), ("1.2.3", None),
    ],
)
def test_price_cast(spark, text, number):
    df = spark.createDataFrame([(text,)], "p string")
    assert cleaning.cast_whole_number(df, "p").first().p == number


def test_price_cast_of_numbers(spark):
    df = spark.createDataFrame([(12.9, 1 << 40)], "d double, l long")
    out = df.select(
        whole_number(F.col("d"), df.schema["d"].dataType).alias("d"),
        whole_number(F.col("l"), df.schema["l"].dataType).alias("l"),
    )
    assert tuple(out.first()) == (12, None)


def test_unknown_and_null_codes_give_null(spark):
    df = spark.createDataFrame([(1,), (9,), (None,)], "c int")
    got = [r[0] for r in df.select(map_codes({1: "one"}, F.col("c"))).collect()]
    assert got == ["one", None, None]


def test_keep_positive_drops_null_zero_and_nan(spark):
    df = spark.createDataFrame([(None,), (0.0,), (-1.0,), (float("nan"),), (2.0,)], "v double")
    assert rows(cleaning.keep_positive(df, "v")) == [(2.0,)]


def test_date_parts_of_text_and_garbage(spark):
    df = spark.createDataFrame([("2024-03-01T10:00:00",), ("garbage",), (None,)], "t string")
    parts = df.select(*date_parts(F.col("t"), df.schema["t"].dataType))
    assert [tuple(r) for r in parts.collect()] == [(2024, 3), (None, None), (None, None)]


def test_derived_columns_come_first(spark):
    df = spark.createDataFrame([(1, "2024-03-01")], "id int, t string")
    assert cleaning.date_parts_first(df, "t").columns == ["year", "month", "id", "t"]


def test_empty_like_reads_nothing(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    empty = cleaning.empty_like(df)
    assert empty.schema == df.schema and empty.count() == 0
    assert "FileScan" not in empty._jdf.queryExecution().executedPlan().toString()


def test_profile(spark):
    df = spark.createDataFrame([(1, None), (2, "b"), (None, None)], "a int, b string")
    got = {r.column_name: r for r in cleaning.column_profile(df).collect()}
    assert (got["a"].row_count, got["a"].null_count, got["a"].min_value, got["a"].max_value) == (3, 1, "1", "2")
    assert (got["b"].null_count, got["b"].distinct_estimate) == (2, 1)


def test_semi_join_ignores_nulls(spark):
    left = spark.createDataFrame([(1,), (2,), (None,), (1,)], "z int")
    right = spark.createDataFrame([(1,), (None,), (1,)], "ZIP int")
    assert rows(joins.keep_known_keys(left, "z", right, "ZIP")) == [(1,), (1,)]


def test_inner_join_keeps_repeats_and_drops_right_key(spark):
    sales = spark.createDataFrame([(1, "a"), (1, "b"), (3, "c"), (None, "d")], "ZIP int, s string")
    tax = spark.createDataFrame([(1, 10), (1, 20), (2, 30), (None, 40)], "zipcode int, n int")
    out = joins.inner_join(sales, tax, "ZIP", "zipcode")
    assert out.columns == ["ZIP", "s", "n"]
    assert rows(out) == [(1, "a", 10), (1, "a", 20), (1, "b", 10), (1, "b", 20)]


def test_match_keys_keeps_both_sides(spark):
    target = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    source = spark.createDataFrame([(2,), (3,), (3,), (None,)], "k int")
    assert rows(joins.match_keys(target, source, ["k"])) == [(1, 2, 0), (2, 1, 1), (3, 0, 2)]


def test_rollup_is_not_confused_by_a_year_column(spark):
    df = spark.createDataFrame(
        [(1999, 1, "2024-01-05", "d", 2.0), (1999, 1, "2024-01-06", "d", 3.0), (1999, 1, "bad", "d", 4.0)],
        "year int, month int, t string, dev string, v double",
    )
    assert rows(rollup.monthly_rollup(df, "t", ["dev"], ["v"])) == [
        (None, None, "d", 4.0), (2024, 1, "d", 5.0),
    ]


def test_row_count(spark):
    assert rollup.row_count(spark.range(7)).first().record_count == 7


def test_profile_by_sketches(spark, folder):
    from datetime import date

    from tierline import VersionedTable
    from tierline.operators import profile

    schema = "i int, s string, d date, empty double, tags map<string, int>"
    make = lambda lo, hi: spark.createDataFrame(
        [(i, None if i % 4 == 0 else "ab"[i % 2] + str(i % 3), date(2024, 1, 1 + i % 28), None, {}) for i in range(lo, hi)], schema
    )
    table = VersionedTable(spark, f"{folder}/t")
    table.create(schema)
    assert table.profile().collect() == [] or {r["rows"] for r in table.profile().collect()} == {0}
    for lo in range(0, 3000, 1000):
        table.append(make(lo, lo + 1000))
    found = {r["column"]: r for r in table.profile(quantiles=(0.0, 0.5, 1.0)).collect()}
    whole = {r["column"]: r for r in profile.profile(table.read(), (0.0, 0.5, 1.0)).collect()}
    assert set(found) == set(whole) == {"i", "s", "d", "empty"}
    for r in (found, whole):
        assert abs(r["i"]["distinct"] - 3000) < 100 and r["i"]["nulls"] == 0 and r["i"]["rows"] == 3000
        assert r["i"]["quantiles"][0] == 0 and r["i"]["quantiles"][2] == 2999 and abs(r["i"]["quantiles"][1] - 1500) < 60
        assert r["s"]["nulls"] == 750 and r["s"]["distinct"] == 6 and r["s"]["quantiles"] is None
        assert sum(x["count"] for x in r["s"]["frequent"] if x["item"]) <= 2250 and r["d"]["quantiles"][0] == 1704067200.0
        assert (r["empty"]["nulls"], r["empty"]["distinct"], r["empty"]["quantiles"], r["empty"]["frequent"]) == (3000, 0, None, None)
    assert table.profile(1).count() in (0, 4) and {r["rows"] for r in table.profile(2).collect()} == {2000}
