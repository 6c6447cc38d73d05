import csv
import os

import pytest
from conftest import drop_json, rows
from pyspark.sql import functions as F

from tierline import Workspace
from tierline.plans import iot, property
from tierline.plans.run import run
from tierline.sources import storage
from tierline.sources.schemas import SchemaMismatch


def event(i, moment="2024-01-05 10:00:00", **more):
    return {
        "id": i, "user_id": 1, "device_id": 2, "num_steps": 10, "miles_walked": 0.5,
        "calories_burnt": 2.5, "timestamp": moment, **more,
    }


@pytest.fixture
def flow(spark, folder):
    source = f"{folder}/in"
    drop_json(source, "part-00001", [event(1), event(300000), event(300000)])
    drop_json(source, "part-00002", [event(2, "2024-02-01 00:00:00"), event(3, "garbage")])
    ws = Workspace(spark, f"{folder}/tables")
    state = {"checkpoint": f"{folder}/ck", "schema_location": f"{folder}/schema"}
    return ws, source, state


def test_device_flow(spark, flow):
    ws, source, state = flow
    run([
        lambda: iot.load_devices(ws, source),
        lambda: iot.bronze(ws, source, **state),
        lambda: iot.silver(ws, erase_ids=[300000]),
        lambda: iot.gold(ws),
        lambda: iot.daily_maintenance(ws),
    ])
    assert spark.table("iot_devices").count() == 5
    assert spark.sql("SELECT count(*) c FROM iot_stream_bronze").first().c == 5
    silver = ws.table(iot.SILVER)
    assert silver.read().columns[:2] == ["year", "month"] and silver.read().count() == 3
    assert [r.operation for r in silver.history().orderBy("version").collect()] == [
        "CREATE", "MERGE", "REPLACE", "DELETE", "CLUSTER",
    ]
    assert silver.read(version=1).filter("id = 300000").count() == 2
    assert spark.table(iot.GOLD).columns == iot.GOLD_COLUMNS
    assert rows(spark.table(iot.GOLD).select("id", "year", "month", "num_steps")) == [
        (1, 2024, 1, 10), (2, 2024, 2, 10), (3, None, None, 10),
    ]
    assert ws.table(iot.GOLD).commit().partition_by == ["year", "month"]


def test_restore_undoes_the_delete_and_gold_still_runs(spark, flow):
    ws, source, state = flow
    iot.bronze(ws, source, **state)
    iot.silver(ws, erase_ids=[300000], restore_to=1)
    silver = ws.table(iot.SILVER)
    assert "year" not in silver.read().columns
    assert silver.read().filter("id = 300000").count() == 2
    assert [r.version for r in silver.history().filter("operation = 'RESTORE'").collect()] == [4]
    gold = iot.gold(ws)
    assert gold.filter("id = 300000").first().num_steps == 20


def test_the_latest_row_is_that_of_the_latest_readable_moment(spark, flow):
    ws, source, state = flow
    iot.bronze(ws, source, **state)
    iot.silver(ws)
    lines = [event(1, "2024-02-03 00:00:00", num_steps=77), event(1, "n/a", num_steps=1), event(1, "garbage", num_steps=2)]
    drop_json(source, "part-00003", lines)
    iot.bronze(ws, source, **state)
    iot.silver(ws, latest_by="timestamp")
    (found,) = ws.table(iot.SILVER).read().filter("id = 1").collect()
    assert (found.num_steps, found.month) == (77, 2)


def test_device_flow_starts_over(spark, flow):
    ws, source, state = flow
    iot.load_devices(ws, source)
    iot.bronze(ws, source, **state)
    iot.cleanup(ws, source, *state.values())
    assert not any(storage.exists(spark, x) for x in (source, *state.values(), ws.path(iot.BRONZE)))
    assert not spark.catalog.tableExists(f"{ws.database}.{iot.DEVICES}")
    drop_json(source, "part-00001", [event(7)])
    assert iot.bronze(ws, source, **state).read().count() == 1


def test_silver_takes_later_files(spark, flow):
    ws, source, state = flow
    iot.bronze(ws, source, **state)
    iot.silver(ws)
    drop_json(source, "part-00003", [event(1, num_steps=99), event(9, extra="x")])
    iot.bronze(ws, source, **state)
    iot.silver(ws, latest_by="timestamp")
    found = {r.id: r for r in ws.table(iot.SILVER).read().collect()}
    assert found[1].num_steps == 99 and found[9].extra == "x" and found[9].year == 2024


SALES = [
    ["", "BOROUGH", "ADDRESS", "ZIP CODE", "EASE-MENT", "SALE PRICE"],
    [0, 1, "a", 10001, "", "100"],
    [1, 2, "b", 10001, "", "200"],
    [2, 3, "c", 10002, "", " -  "],
    [3, 4, "d", 10002, "", "0"],
    [4, 5, "e", 0, "", "5"],
    [5, 9, "f", "", "", "1"],
    [6, "", "g", 10003, "", "3000000000"],
    [7, 1, "h", 10004, "", "7"],
]
TAX = [["zipcode", "agi_stub", "N1"]]
TAX += [[10001, stub, stub * 10.0] for stub in range(1, 7)]
TAX += [[0, 1, 5.0], [10099, 1, 5.0], [10004, 7, 70.0], [10002, 1, 9.0]]


@pytest.fixture
def sales(spark, folder):
    for name, lines in (("sales", SALES), ("tax", TAX)):
        with open(f"{folder}/{name}.csv", "w", newline="") as out:
            csv.writer(out).writerows(lines)
    ws = Workspace(spark, f"{folder}/tables")
    run([
        lambda: property.bronze(ws, f"{folder}/sales.csv"),
        lambda: property.silver(ws),
        lambda: property.gold(ws, f"{folder}/tax.csv"),
    ])
    return ws


def test_property_tiers(spark, sales):
    assert spark.table("ny_bronze").columns == [
        "BOROUGH", "ADDRESS", "ZIP_CODE", "EASEMENT", "SALE_PRICE",
    ]
    prices = [r.SALE_PRICE for r in spark.table("ny_bronze").orderBy("ADDRESS").collect()]
    assert prices == [100, 200, None, 0, 5, 1, None, 7]
    assert rows(spark.table("ny_silver").select("ADDRESS", "BOROUGH")) == [
        ("a", "Manhattan"), ("b", "Bronx"), ("f", None), ("h", "Manhattan"),
    ]
    assert spark.table("ny_silver").filter("ZIP_CODE = 0").isEmpty()
    assert sales.table("ny_silver").read(version=0).filter("ZIP_CODE = 0").count() == 1
    assert rows(spark.table("irs").select("zipcode").distinct()) == [(10001,), (10004,)]
    gold = spark.table("ny_gold")
    assert gold.columns == property.GOLD_COLUMNS and gold.count() == 13
    assert rows(gold.filter("ZIP_CODE = 10004").select("SALE_PRICE", "NUM_RETURNS", "ADJ_GROSS_INCOME")) == [
        (7, 70.0, None),
    ]
    brackets = rows(gold.filter("ADDRESS = 'a'").select("ADJ_GROSS_INCOME"))
    assert len(brackets) == 6 and ("200,000+",) in brackets


def test_steps_in_sessions_of_their_own(spark, sales, folder):
    root = f"{folder}/apart"
    property.bronze(Workspace(spark.newSession(), root, "tierline_apart"), f"{folder}/sales.csv")
    property.silver(Workspace(spark.newSession(), root, "tierline_apart"))
    property.gold(Workspace(spark.newSession(), root, "tierline_apart"), f"{folder}/tax.csv")
    assert spark.newSession().sql("SELECT * FROM tierline_apart.ny_gold").count() == 13


def test_one_name_in_two_databases(spark, folder):
    one, two = (Workspace(spark, f"{folder}/{n}", f"tierline_{n}") for n in ("one", "two"))
    one.save("x", spark.range(3).withColumn("p", F.lit("01")), partition_by=["p"])
    two.save("x", spark.range(5))
    other = spark.newSession()
    assert rows(other.table("tierline_one.x").select("p").distinct()) == [("01",)]
    assert other.table("tierline_one.x").count() == 3 and other.table("tierline_two.x").count() == 5
    one.table("x").delete("id = 1")
    assert one.register("x").count() == 2
    one.table("x").append(spark.range(1).selectExpr("id", "'2' p", "7 more"), evolve=True)
    assert rows(one.register("x")) == [(0, "01", None), (0, "2", 7), (2, "01", None)]
    with pytest.raises(SchemaMismatch):
        two.save("x", spark.range(2).selectExpr("cast(id as string) id"))
    for ws in (one, two):
        ws.drop(["x"])
        assert not spark.catalog.tableExists(f"{ws.database}.x")


def test_cleanup_stays_below_the_root(spark, sales, folder):
    outside = f"{folder}/outside"
    os.makedirs(outside)
    with pytest.raises(ValueError, match="not below"):
        sales.drop([], [outside])
    with pytest.raises(ValueError, match="not below"):
        sales.drop([], [f"{sales.root}/../outside"])
    property.cleanup(sales)
    assert os.path.exists(outside) and not storage.exists(spark, sales.path("ny_gold"))
    assert not spark.catalog.tableExists("ny_silver")
    property.cleanup(sales)


def test_external_table_keeps_its_files(spark, folder):
    spark.range(5).write.parquet(f"{folder}/files")
    ws = Workspace(spark, f"{folder}/ws", database="tierline_test")
    ws.use()
    try:
        assert ws.external_table("five", f"{folder}/files").count() == 5
        assert ws.external_table("five", f"{folder}/files").count() == 5
        spark.sql("DROP TABLE IF EXISTS five")
        assert spark.read.parquet(f"{folder}/files").agg(F.sum("id")).first()[0] == 10
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE tierline_test CASCADE")


def test_gold_that_follows_silver(spark, flow):
    ws, source, state = flow
    iot.bronze(ws, source, **state)
    iot.silver(ws)
    names = ["id", "year", "month", "num_steps", "miles_walked", "device_id"]
    assert rows(iot.gold(ws, incremental=True).select(*names)) == [
        (1, 2024, 1, 10, 0.5, 2), (2, 2024, 2, 10, 0.5, 2), (3, None, None, 10, 0.5, 2), (300000, 2024, 1, 20, 1.0, 2),
    ]
    drop_json(source, "part-00003", [event(1, "2024-03-01 00:00:00", num_steps=7, d={"x": 1}), event(4)])
    drop_json(source, "part-00004", [event(2, "2024-02-02 00:00:00", num_steps=11, d={"x": 1, "y": 2})])
    iot.bronze(ws, source, **state)
    iot.silver(ws, latest_by="timestamp", erase_ids=[300000])
    kept = rows(iot.gold(ws, incremental=True).select(*iot.GOLD_COLUMNS))
    assert spark.table(iot.GOLD).columns == iot.GOLD_COLUMNS and len(kept) == 4
    ws.spark.sql(f"DROP VIEW {iot.GOLD}")
    assert rows(iot.gold(ws)) == kept
    assert spark.table(iot.SILVER).filter("d.y = 2").count() == 1
    iot.cleanup(ws)
    assert not spark.catalog.tableExists(iot.SUMS)
