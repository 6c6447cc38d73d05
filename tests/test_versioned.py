import time

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tierline import VersionedTable
from tierline.sources import storage
from tierline.sources.schemas import SchemaMismatch
from tierline.sources.versioned import ConcurrentWrite

DATA = [(i, "ab"[i % 2], float(i)) for i in range(20)]
SCHEMA = "id long, p string, v double"


@pytest.fixture
def filled(spark, table):
    table.create(SCHEMA, partition_by=["p"])
    table.append(spark.createDataFrame(DATA, SCHEMA))
    return table


def names_of(table):
    commit = table.commit()
    return {r.path for r in table._manifest(commit.parts).collect()} if commit.parts else set()


def test_every_step_is_a_version(spark, filled):
    filled.delete("id = 3")
    filled.update("id = 4", {"v": "v * 10"})
    filled.merge(spark.createDataFrame([(5, "a", 50.0), (99, "b", 99.0)], SCHEMA), "id")
    filled.restore(1)
    filled.overwrite(filled.read().filter("id < 2"))
    filled.replace(filled.read().select("id"))
    history = {r.version: r for r in filled.history().collect()}
    assert [history[v].operation for v in range(8)] == [
        "CREATE", "APPEND", "DELETE", "UPDATE", "MERGE", "RESTORE", "OVERWRITE", "REPLACE",
    ]
    assert history[2].metrics["deleted"] == 1 and history[2].metrics["rows"] == 19
    assert history[2].metrics["rows_before"] == 20
    assert history[3].metrics["updated"] == 1
    assert (history[4].metrics["updated"], history[4].metrics["inserted"]) == (1, 1)
    assert filled.read(0).count() == 0 and filled.read(0).columns == ["id", "p", "v"]
    assert {tuple(r) for r in filled.read(1).collect()} == {tuple(r) for r in DATA}
    assert filled.read(2).filter("id = 3").isEmpty() and filled.read(1).filter("id = 3").count() == 1
    assert filled.read(3).filter("id = 4").first().v == 40.0
    assert filled.read(4).filter("id in (5, 99)").agg(F.sum("v")).first()[0] == 149.0
    assert filled.read(5).count() == 20 and filled.read(6).count() == 2
    assert filled.read().columns == ["id"]
    with pytest.raises(ValueError, match="no version"):
        filled.read(42)


def test_read_by_moment(filled):
    moments = []
    for key in (1, 2):
        moments.append(filled.commit().committed_at)
        time.sleep(0.01)
        filled.delete(f"id = {key}")
    assert filled.read(as_of=moments[0]).count() == 20
    assert filled.read(as_of=moments[1]).count() == 19
    assert filled.read(as_of="2999-01-01").count() == 18
    with pytest.raises(ValueError, match="no version at"):
        filled.read(as_of="1999-01-01")


def test_delete_rewrites_only_files_with_a_hit(filled):
    before = names_of(filled)
    filled.delete("id = 3")
    after = names_of(filled)
    assert len(before - after) == 1 and before & after
    again = names_of(filled)
    filled.delete("id = 4")
    assert len(again - names_of(filled)) == 1
    assert filled.read().count() == 18


def test_delete_without_a_hit_makes_no_version(filled):
    assert filled.delete("id = 1000") is None and filled.version == 1


def test_delete_of_unknown_keeps_the_row(spark, table):
    table.replace(spark.createDataFrame([(None, 1), (1, 2)], "a int, b int"))
    table.delete("a = 1")
    assert rows(table.read()) == [(None, 1)]


def test_delete_all_then_append(spark, filled):
    filled.delete("true")
    assert filled.read().count() == 0 and filled.commit().parts == []
    filled.merge(spark.createDataFrame(DATA[:3], SCHEMA), "id")
    assert filled.read().count() == 3


def test_restore_brings_schema_and_layout_back(spark, filled):
    filled.replace(filled.read().withColumn("year", F.lit(2024)), partition_by=["year"])
    filled.restore(1)
    assert filled.read().columns == ["id", "p", "v"]
    assert filled.commit().partition_by == ["p"]
    filled.append(spark.createDataFrame([(100, "a", 1.0)], SCHEMA))
    assert filled.read().count() == 21


def test_merge_rewrites_only_matched_files(spark, filled):
    before = names_of(filled)
    filled.merge(spark.createDataFrame([(2, "a", -1.0)], SCHEMA), "id")
    assert before & names_of(filled)
    assert filled.read().filter("id = 2").first().v == -1.0 and filled.read().count() == 20


def test_merge_can_move_a_row_to_another_partition(spark, filled):
    filled.merge(spark.createDataFrame([(2, "b", -1.0)], SCHEMA), "id")
    assert filled.read().filter("id = 2").collect()[0].p == "b" and filled.read().count() == 20


def test_merge_with_new_and_missing_columns(spark, filled):
    source = spark.createDataFrame([(2, "x"), (77, "y")], "id long, extra string")
    with pytest.raises(SchemaMismatch, match="lacks"):
        filled.merge(source, "id")
    filled.merge(source, "id", evolve=True)
    found = {r.id: r for r in filled.read().collect()}
    assert (found[2].v, found[2].extra) == (2.0, "x")
    assert (found[77].v, found[77].extra) == (None, "y") and found[3].extra is None
    assert len(found) == 21


def test_merge_reads_its_own_table(filled):
    doubled = filled.read().filter("id < 3").withColumn("v", F.col("v") * 2)
    filled.merge(doubled, "id")
    assert filled.read().agg(F.sum("v")).first()[0] == sum(range(20)) + 3


def test_schema_is_enforced(spark, filled):
    for wrong in ("id long, p string, v string", "id long, p string, v double, w int"):
        bad = spark.createDataFrame([], wrong)
        with pytest.raises(SchemaMismatch):
            filled.append(bad)
    filled.append(spark.createDataFrame([(50, 1.5)], "id int, v float"))
    row = filled.read().filter("id = 50").first()
    assert (row.p, row.v) == (None, 1.5) and filled.version == 2


def test_schema_grows(spark, filled):
    filled.append(spark.createDataFrame([(50, "n")], "id long, extra string"), evolve=True)
    assert filled.read().columns == ["id", "p", "v", "extra"]
    assert filled.read().filter("extra is null").count() == 20
    with pytest.raises(SchemaMismatch):
        filled.append(spark.createDataFrame([], "id long, extra int"), evolve=True)
    assert filled.read(1).columns == ["id", "p", "v"]


def test_unpublished_write_is_never_read(spark, filled):
    filled._write(spark.createDataFrame(DATA, SCHEMA), ["p"], None)
    assert filled.read().count() == 20


def test_second_writer_of_a_version_fails(spark, filled):
    other = VersionedTable(spark, filled.root)
    stale = other.commit()
    filled.delete("id = 1")
    with pytest.raises(ConcurrentWrite):
        other._publish(other._next(stale, "APPEND", stale.parts))
    assert filled.read().count() == 19


def test_odd_folder_and_partition_names(spark, folder):
    table = VersionedTable(spark, f"{folder}/my table+%41")
    data = [(1, "a b"), (2, "x/%y"), (3, None), (4, "{q}[z]*?"), (5, "p+q"), (6, "01")]
    table.replace(spark.createDataFrame(data, "id int, p string"), partition_by=["p"])
    table.delete("id = 1")
    table.update("id = 2", {"id": "20"})
    assert rows(table.read()) == rows(spark.createDataFrame([(20, "x/%y"), *data[2:]], "id int, p string"))


def test_diff_reads_only_changed_files(spark, filled):
    filled.delete("id = 3")
    filled.append(spark.createDataFrame([(30, "a", 1.0)], SCHEMA))
    assert rows(filled.diff(1, 3)) == [("delete", 1, 3, "b", 3.0), ("insert", 1, 30, "a", 1.0)]
    assert rows(filled.diff(3, 1)) == [("delete", 1, 30, "a", 1.0), ("insert", 1, 3, "b", 3.0)]
    assert filled.diff(2, 2).count() == 0


def test_diff_across_a_new_schema(spark, filled):
    filled.append(spark.createDataFrame([(30, "x")], "id long, extra string"), evolve=True)
    assert rows(filled.diff(1, 2)) == [("insert", 1, 30, None, None, "x")]


def test_appended_since_survives_compaction(spark, filled):
    filled.append(spark.createDataFrame([(30, "a", 1.0)], SCHEMA))
    filled.compact()
    filled.append(spark.createDataFrame([(31, "a", 1.0)], SCHEMA))
    assert rows(filled.appended_since(1).select("id")) == [(30,), (31,)]
    assert filled.appended_since(-1).count() == 22
    filled.delete("id in (3, 30)")
    assert rows(filled.appended_since(1).select("id")) == [(31,)]
    filled.update("id = 4", {"p": "'new'"})
    filled.append(spark.createDataFrame([(32, "a", 1.0)] * 2, SCHEMA))
    assert rows(filled.appended_since(1).select("id")) == [(31,), (32,), (32,), (4,)]
    assert filled.appended_since(-1).count() == 22


def test_stream_batches_are_added_once(spark, filled):
    batch = spark.createDataFrame([(30, "a", 1.0)], SCHEMA)
    assert filled.append(batch, stream=("s", 0)) is not None
    assert filled.append(batch, stream=("s", 0)) is None
    assert filled.append(batch, stream=("other", 0)) is not None
    filled.restore(1)
    assert filled.append(batch, stream=("s", 0)) is None
    assert filled.append(batch, stream=("s", 1)) is not None


def test_storage_never_overwrites(spark, folder):
    storage.create_text(spark, f"{folder}/x/a.txt", "one")
    with pytest.raises(storage.AlreadyExists):
        storage.create_text(spark, f"{folder}/x/a.txt", "two")
    assert storage.read_text(spark, f"{folder}/x/a.txt") == "one"
    assert storage.list_names(spark, f"{folder}/none") == []


def test_left_over_files_are_read_by_folder(spark, filled):
    gone = []
    for i in (3, 40, 5, 41, 17):
        if i == 40:
            filled.append(spark.createDataFrame([(40, "a", 1.0), (41, "b", 1.0)], SCHEMA).coalesce(1))
        filled.delete(f"id = {i}")
        gone.append(i)
        subset = [p for p in filled.commit().parts if not p.tag]
        assert len(subset) <= 1 and all(p.removed and p.folders for p in subset)
        there = set(range(20)) | ({40, 41} if 40 in gone else set())
        assert sorted(r.id for r in filled.read().collect()) == sorted(there - set(gone))
    assert filled.read(2).count() == 19 and filled.read(3).count() == 21
    assert set(rows(filled.diff(1, filled.version).select("change", "id"))) == {("delete", i) for i in (3, 5, 17)}


def test_files_of_which_every_row_goes_are_dropped_without_a_job(spark, table):
    table.replace(spark.range(20).selectExpr("id", "id % 2 p"), partition_by=["p"])
    before = len(storage.list_names(spark, table.data))
    commit = table.delete("p = 1")
    assert commit.metrics["files_rewritten"] == 0 and commit.metrics["files_dropped"] > 0
    assert commit.metrics["deleted"] == 10 and commit.added is None
    assert len(storage.list_names(spark, table.data)) == before
    assert sorted(r.id for r in table.read().collect()) == list(range(0, 20, 2))
    assert table.delete("p = 0").metrics["deleted"] == 10 and table.read().count() == 0
    assert table.delete("p = 0") is None and table.commit().files == 0
    table.restore(0)
    assert table.read().count() == 20


def test_delete_by_a_frame_of_keys(spark, folder):
    table = VersionedTable(spark, f"{folder}/keys", target_file_bytes=4000)
    table.replace(spark.range(3000).selectExpr("id", "sha2(cast(id as string), 256) v").repartition(6))
    table.cluster("id")
    files = table.commit().files
    keys = spark.createDataFrame([(5,), (7,), (5,), (None,), (10**9,)], "id int")
    commit = table.delete_keys(keys.filter("id < 100 or id is null"), "id")
    assert commit.metrics["deleted"] == 2 and commit.metrics["files_rewritten"] == 1 < files
    assert table.read().count() == 2998 and table.read().filter("id in (5, 7)").isEmpty()
    assert table.delete_keys(keys, "id") is None


def test_a_commit_file_without_text_was_never_published(spark, filled, folder):
    version = filled.version
    open(filled._commit_path(version + 1).removeprefix("file:"), "w").close()
    again = VersionedTable(spark, f"{folder}/table")
    assert again.version == version and again.read().count() == 20
    assert again.delete("id = 3").version == version + 1
    assert VersionedTable(spark, f"{folder}/table").read().count() == 19


def test_removed_files_are_not_scanned(spark, filled):
    filled.delete("id = 3")
    live = filled.commit().files
    assert filled.read().select("_metadata.file_path").distinct().count() == live
    assert filled._manifest(filled.commit().parts).count() == live
