import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierline import VersionedTable, Workspace
from tierline.sources.catalog import maintain


def files(table):
    return table._manifest(table.commit().parts)


@pytest.fixture
def numbers(spark):
    wide = F.sha2(F.col("id").cast("string"), 256).alias("text")
    return spark.range(0, 20000, 1, 8).select((F.col("id") * 7919 % 20000).alias("id"), wide)


def test_compact_keeps_rows_and_leaves_one_file(spark, table, numbers):
    table.replace(numbers)
    before = rows(table.read().agg(F.count("*"), F.sum("id"), F.min("text")))
    assert table.commit().files == 8
    commit = table.compact()
    assert commit.operation == "COMPACT" and table.commit().files == 1
    assert rows(table.read().agg(F.count("*"), F.sum("id"), F.min("text"))) == before
    assert table.compact() is None


def test_compact_leaves_large_files_alone(spark, folder, numbers):
    table = VersionedTable(spark, f"{folder}/t", target_file_bytes=400_000)
    table.replace(numbers.coalesce(1))
    big = {r.path for r in files(table).collect()}
    for _ in range(3):
        table.append(numbers.limit(10))
    table.compact()
    assert big < {r.path for r in files(table).collect()} and table.commit().files == 2
    assert table.read().count() == 20030


def test_compact_with_partitions(spark, table, numbers):
    parted = numbers.withColumn("p", F.col("id") % 2)
    table.create(parted.schema, partition_by=["p"])
    for _ in range(3):
        table.append(parted)
    assert table.commit().files == 6
    table.compact()
    assert table.commit().files == 2 and table.read().count() == 60000


def test_auto_compact(spark, folder, numbers):
    table = VersionedTable(spark, f"{folder}/t", auto_compact=3)
    table.create(numbers.schema)
    for _ in range(5):
        table.append(numbers.coalesce(1))
    operations = [r.operation for r in table.history().collect()]
    assert "COMPACT" in operations and table.commit().files < 5
    assert table.read().count() == 100000


def test_cluster_cuts_the_files_of_a_lookup(spark, folder, numbers):
    table = VersionedTable(spark, f"{folder}/t", target_file_bytes=150_000)
    table.replace(numbers)
    total = rows(table.read().agg(F.count("*"), F.sum("id")))
    table.cluster("id")
    count = table.commit().files
    assert count > 4
    assert table._matching_files(table.commit(), 300, 300).count() == 1
    assert table.lookup(300).count() == 1 and table.lookup(300, 309).count() == 10
    assert rows(table.read().agg(F.count("*"), F.sum("id"))) == total
    assert table.cluster("id") is None


def test_cluster_again_takes_only_new_files(spark, folder, numbers):
    table = VersionedTable(spark, f"{folder}/t", target_file_bytes=150_000)
    table.replace(numbers)
    table.cluster("id")
    old = {r.path for r in files(table).collect()}
    table.append(numbers.filter("id < 50").withColumn("id", F.col("id") + 50000))
    commit = table.cluster("id")
    assert old < {r.path for r in files(table).collect()}
    assert commit.metrics["files_rewritten"] < 9 and table.lookup(50001).count() == 1
    table.cluster("id", full=True)
    assert table.read().count() == 20050


def test_cluster_spreads_one_hot_key(spark, folder, numbers):
    table = VersionedTable(spark, f"{folder}/t", target_file_bytes=100_000)
    table.replace(numbers.withColumn("id", F.when(F.col("id") > 3000, 5).otherwise(F.col("id"))))
    table.cluster("id")
    largest = files(table).agg(F.max("rows")).first()[0]
    assert largest < 20000 / table.commit().files * 2
    assert table.lookup(5).count() == 17000


def test_cluster_in_partitions_with_nulls(spark, folder):
    data = spark.range(1000).select(
        F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), (F.col("id") % 3).alias("p")
    )
    table = VersionedTable(spark, f"{folder}/t", target_file_bytes=2000)
    table.replace(data, partition_by=["p"])
    table.cluster("k")
    assert table.read().count() == 1000 and table.lookup(11, 19).count() == 9
    with pytest.raises(ValueError):
        table.cluster("p")


@pytest.mark.parametrize(
    ("kind", "low", "high", "count"),
    [
        ("timestamp", "2024-01-02 00:00:00", "2024-01-02 23:59:59", 24),
        ("timestamp_ntz", "2024-01-02 00:00:00", "2024-01-02 23:59:59", 24),
        ("date", "2024-01-02", "2024-01-03", 48),
        ("string", "2024-01-02", "2024-01-03", 24),
        ("double", 10.5, 12.0, 2),
        ("decimal(10,2)", 10, 12, 3),
    ],
)
def test_lookup_by_key_type(spark, folder, kind, low, high, count):
    hours = spark.range(24 * 20)
    moment = F.timestamp_seconds(F.lit(1704067200) + F.col("id") * 3600)
    key = F.col("id") if kind in ("double", "decimal(10,2)") else moment
    table = VersionedTable(spark, f"{folder}/t", target_file_bytes=1000)
    table.replace(hours.select(key.cast(kind).alias("k")))
    table.cluster("k")
    if kind not in ("string", "double", "decimal(10,2)"):
        low, high = F.lit(low).cast(kind), F.lit(high).cast(kind)
        low, high = (spark.range(1).select(low, high).first())
    before = spark.conf.get("spark.sql.session.timeZone")
    assert table.lookup(low, high).count() == count
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        assert table.lookup(low, high).count() == count
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_merge_uses_the_key_ranges(spark, folder, numbers):
    table = VersionedTable(spark, f"{folder}/t", target_file_bytes=150_000)
    table.replace(numbers)
    table.cluster("id")
    commit = table.merge(spark.createDataFrame([(300, "new"), (99999, "far")], "id long, text string"), "id")
    assert commit.metrics["files_rewritten"] == 1
    assert (commit.metrics["updated"], commit.metrics["inserted"]) == (1, 1)
    assert table.lookup(300).first().text == "new" and table.read().count() == 20001
    table.merge(spark.createDataFrame([(None, "n")], "id long, text string"), "id")
    assert table.read().count() == 20002


def test_maintain_several_tables(spark, folder, numbers):
    ws = Workspace(spark, folder)
    for name in ("one", "two"):
        ws.table(name).replace(numbers)
    maintain(ws, {"one": "id", "two": "text"})
    assert ws.table("one").commit().cluster_by == "id"
    assert ws.table("two").commit().cluster_by == "text"


def test_sized_writes_without_partitions(spark, folder, numbers):
    table = VersionedTable(spark, f"{folder}/t", size_writes=True)
    table.replace(numbers.repartition(16))
    assert table.commit().files == 1


def test_small_sized_files_come_several_from_a_task(spark, folder, numbers, monkeypatch):
    table = VersionedTable(spark, f"{folder}/t", target_file_bytes=8192, size_writes=True)
    with monkeypatch.context() as patched:
        patched.setattr("tierline.sources.versioned.work_folder", lambda spark, name: f"{folder}/work-{name}")
        commit = table.replace(numbers.repartition(16))
    tasks = {r.path.split("part-")[1].split("-")[0] for r in files(table).collect()}
    assert commit.files > 50 and len(tasks) <= 8
    assert 8192 / 2 < commit.bytes / commit.files < 8192 * 2
    assert rows(table.read()) == rows(numbers)
    table.overwrite(numbers.limit(0))
    assert table.read().count() == 0


def test_packed_rows_are_ordered_in_ranges_that_fit_unpacked(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", target_file_bytes=200_000, auto_compact=None)
    table.replace(spark.range(0, 200000, 1, 4).select("id", *[F.lit(i).alias(f"c{i}") for i in range(9)]).coalesce(4))
    assert table.commit().bytes < 4 * 200_000 + 200_000
    table.cluster("id")
    spread = files(table).agg(F.max("rows")).first()[0]
    assert spread * 88 < 3 * 2 * 200_000
    assert table.lookup(77).count() == 1 and table.read().count() == 200000


def test_shuffles_grow_with_the_data_for_one_job_only(spark, folder):
    table = VersionedTable(spark, f"{folder}/t", target_file_bytes=1000)
    names = ["spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"]
    before = [spark.conf.get(n) for n in names]
    with pytest.raises(ZeroDivisionError), table._sized(spark.range(1), 100_000):
        assert [spark.conf.get(n) for n in names] == ["100", "1000"]
        1 / 0
    assert [spark.conf.get(n) for n in names] == before
    with table._sized(spark.range(1), 0):
        assert spark.conf.get(names[0]) == before[0]


def test_compaction_keeps_the_order(spark, folder, numbers):
    table = VersionedTable(spark, f"{folder}/t", target_file_bytes=200_000)
    table.replace(numbers)
    table.cluster("id")
    for i in range(6):
        table.append(numbers.filter(f"id % 60 = {i}"))
    table.compact()
    found = files(table).collect()
    assert sum(r.clustered for r in found) >= len(found) - 1
    assert table.commit().cluster_by == "id" and table.lookup(77).count() == 1


def test_the_daily_job_keeps_lookups_cheap(spark, folder, numbers):
    ws = Workspace(spark, f"{folder}/daily", target_file_bytes=100_000, auto_compact=3)
    table = ws.table("t")
    table.create(numbers.schema)
    opened = []
    for i in range(6):
        table.append(numbers.filter(f"id % 6 = {i}"))
        maintain(ws, {"t": "id"})
        commit = ws.table("t").commit()
        opened.append(ws.table("t")._matching_files(commit, 600, 600).count())
        assert ws.table("t").lookup(600 + i).count() == 1
    assert max(opened) <= 3 and ws.table("t").read().count() == 20000


def test_partition_values_read_back_as_written(spark, folder):
    values = ["", None, " ", "a/b", "__HIVE_DEFAULT_PARTITION__", "\x01", "\x01x", "007", "1e3", "a=b%2F", "ü:*", "NULL", "true"]
    df = spark.createDataFrame([(i, v, "z") for i, v in enumerate(values)] * 2, "i int, p string, q string")
    table = VersionedTable(spark, f"{folder}/odd")
    table.replace(df, partition_by=["p", "q"])
    want = sorted([(i, v or "", v is None) for i, v in enumerate(values)] * 2)
    read = lambda t: sorted((r.i, r.p or "", r.p is None) for r in t.read().collect())
    assert read(table) == want
    table.delete("i = 3")
    table.update("i = 5", {"q": "''"})
    table.merge(spark.createDataFrame([(100, "", "")], "i int, p string, q string"), "i")
    table.compact()
    table.cluster("i")
    assert read(table) == sorted([r for r in want if r[0] != 3] + [(100, "", False)])
    assert sorted((r.p, r.q) for r in table.lookup(100).collect()) == [("", "")]
    assert {r.q for r in table.read().filter("i = 5").collect()} == {""}
    assert "PartitionFilters: []" not in table.read().filter("p = ''")._jdf.queryExecution().executedPlan().verboseString(1000)
    assert [r.change for r in table.diff(0, 1).filter("p = 'a/b'").collect()] == ["delete"]
