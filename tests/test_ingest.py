import hashlib
import os
import shutil
from datetime import datetime
from decimal import Decimal

import pytest
from conftest import drop_json, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierline import VersionedTable, Workspace
from tierline.operators import rollup
from tierline.sources.files import file_inventory, json_schema, read_csv, read_json
from tierline.sources.schemas import SchemaMismatch, SchemaStore
from tierline.streaming import ingest


def reading(i, **more):
    return {"id": i, "num_steps": i * 10, "timestamp": "2024-01-01 00:00:00", **more}


class Stream:
    def __init__(self, spark, folder):
        self.spark, self.source = spark, f"{folder}/in"
        self.table = VersionedTable(spark, f"{folder}/bronze")
        self.state = {"checkpoint": f"{folder}/checkpoint", "schema_location": f"{folder}/schema"}

    def drain(self, **options):
        ingest.start_stream(self.table, self.source, **self.state, **options).awaitTermination()
        return self.table.read() if self.table.exists else None


@pytest.fixture
def stream(spark, folder):
    return Stream(spark, folder)


def test_gzip_json_is_read(spark, folder):
    drop_json(f"{folder}/in", "a", [reading(1), "not json", reading(2)])
    assert read_json(spark, f"{folder}/in", "id long").filter("id is not null").count() == 2
    assert json_schema(spark, f"{folder}/in").fieldNames() == ["id", "num_steps", "timestamp"]


def test_csv_header_and_types(spark, folder):
    with open(f"{folder}/a.csv", "w") as out:
        out.write(",ZIP CODE,SALE PRICE\n0,10001, -  \n1,10002,5\n")
    df = read_csv(spark, f"{folder}/a.csv")
    assert df.columns == ["_c0", "ZIP CODE", "SALE PRICE"]
    assert dict(df.dtypes)["ZIP CODE"] == "int" and dict(df.dtypes)["SALE PRICE"] == "string"
    assert read_csv(spark, f"{folder}/a.csv", "a int, b int, c string").columns == ["a", "b", "c"]


def test_inventory_lists_files(spark, folder):
    drop_json(f"{folder}/in/deep", "a", [reading(1)])
    drop_json(f"{folder}/in", "b", [reading(1)])
    found = file_inventory(spark, f"{folder}/in").collect()
    assert len(found) == 2 and all(r.length > 0 and r.modificationTime for r in found)
    assert file_inventory(spark, f"{folder}/in", "b*").count() == 1


def test_copy_into_loads_each_file_once(spark, folder, table):
    drop_json(f"{folder}/in", "a", [reading(1), reading(1)])
    table.create(json_schema(spark, f"{folder}/in"))
    assert ingest.copy_into(table, f"{folder}/in").metrics["inserted"] == 2
    assert ingest.copy_into(table, f"{folder}/in") is None
    drop_json(f"{folder}/in", "b with space", [reading(2)])
    assert ingest.copy_into(table, f"{folder}/in").metrics["inserted"] == 1
    assert table.read().count() == 3
    table.restore(1)
    assert ingest.copy_into(table, f"{folder}/in").metrics["inserted"] == 1


def test_copy_into_can_grow_the_schema(spark, folder, table):
    drop_json(f"{folder}/in", "a", [reading(1, extra="x")])
    table.create("id long")
    ingest.copy_into(table, f"{folder}/in", evolve=True)
    assert rows(table.read().select("id", "extra")) == [(1, "x")]


def test_stream_goes_on_from_its_checkpoint(stream):
    drop_json(stream.source, "a", [reading(1), reading(2)])
    assert stream.drain().count() == 2
    assert stream.drain().count() == 2
    drop_json(stream.source, "b", [reading(3)])
    drop_json(stream.source, "c", [reading(3)])
    assert rows(stream.drain().select("id")) == [(1,), (2,), (3,), (3,)]
    assert {r.operation for r in stream.table.history().collect()} == {"CREATE", "STREAM APPEND"}


def test_stream_of_no_rows_makes_no_table(stream):
    drop_json(stream.source, "a", ["", "  "])
    assert stream.drain() is None


def test_broken_lines_are_kept_before_there_is_a_schema(stream):
    drop_json(stream.source, "a", ["not json"])
    assert rows(stream.drain()) == [("not json",)]
    drop_json(stream.source, "b", [reading(1)])
    assert rows(stream.drain().select("id", "_rescued")) == [(None, "not json"), (1, None)]


def test_schema_is_kept_and_grows_without_losing_a_value(stream, spark):
    drop_json(stream.source, "a", [reading(1)])
    stream.drain()
    store = SchemaStore(spark, stream.state["schema_location"])
    assert store.load().fieldNames() == ["id", "num_steps", "timestamp"]
    drop_json(stream.source, "b", [reading(2, extra="new"), reading(3)])
    assert rows(stream.drain().select("id", "extra")) == [(1, None), (2, "new"), (3, None)]
    assert store.load().fieldNames()[-1] == "extra"
    assert stream.table.read(1).columns == ["id", "num_steps", "timestamp"]


def test_wrong_types_and_broken_lines_are_kept_as_text(stream):
    drop_json(stream.source, "a", [reading(1)])
    stream.drain()
    drop_json(stream.source, "b", [reading(2) | {"num_steps": "many"}, "{broken", "[1]", reading(3) | {"num_steps": 0.5}])
    found = rows(stream.drain().select("id", "num_steps", "_rescued"))
    assert found == [
        (None, None, "[1]"), (None, None, "{broken"), (1, 10, None),
        (2, None, '{"num_steps":"many"}'), (3, None, '{"num_steps":"0.5"}'),
    ]
    drop_json(stream.source, "c", [reading(4)])
    assert rows(stream.drain().filter("id = 4").select("num_steps", "_rescued")) == [(40, None)]


def test_new_fields_within_objects_and_lists_are_kept(stream):
    drop_json(stream.source, "a", [{"d": {"x": 1}, "l": [{"y": 1}], "n": None}])
    stream.drain()
    lines = [{"d": {"x": 2, "z": 3}}, {"l": [{"y": 1}, {"y": 2, "w": "v"}]}, {"d": {"x": 5}, "l": [{"y": 6}], "n": None}, {"d": 7}]
    drop_json(stream.source, "b", lines)
    found = [r[0] for r in stream.drain().select("_rescued").collect() if r[0]]
    assert sorted(found) == ['{"d":"7"}', '{"d":"{\\"x\\":2,\\"z\\":3}"}', '{"l":"[{\\"y\\":1},{\\"y\\":2,\\"w\\":\\"v\\"}]"}']


def test_copy_into_refuses_what_does_not_fit(spark, folder, table):
    table.create("id long, num_steps long, timestamp string")
    drop_json(f"{folder}/in", "a", [reading(1)])
    ingest.copy_into(table, f"{folder}/in")
    for i, line in enumerate((reading(2, extra=1), reading(2) | {"num_steps": 0.5}, "{broken")):
        drop_json(f"{folder}/in{i}", "b", [reading(3), line])
        with pytest.raises(SchemaMismatch):
            ingest.copy_into(table, f"{folder}/in{i}")
    assert table.version == 1 and table.read().count() == 1
    for i in range(3):
        ingest.copy_into(table, f"{folder}/in{i}", evolve=True)
    assert table.read().columns == ["id", "num_steps", "timestamp", "extra", "_rescued"]
    assert table.read().count() == 7 and table.read().filter("_rescued is not null").count() == 2


def test_stream_files_follow_the_size_of_the_table(spark, folder):
    table = VersionedTable(spark, f"{folder}/bronze", target_file_bytes=20_000, size_writes=True)
    drop_json(f"{folder}/in", "a", [{"id": i, "text": hashlib.sha256(bytes([i % 256, i // 256])).hexdigest()} for i in range(4000)])
    state = {"checkpoint": f"{folder}/checkpoint", "schema_location": f"{folder}/schema"}
    ingest.start_stream(table, f"{folder}/in", **state).awaitTermination()
    assert table.commit().files > 3


def test_stream_without_growth_refuses_new_fields(stream):
    drop_json(stream.source, "a", [reading(1)])
    stream.drain()
    drop_json(stream.source, "b", [reading(2, extra="new")])
    with pytest.raises(Exception, match="schema lacks"):
        stream.drain(evolve=False)
    assert stream.table.read().count() == 1
    assert stream.drain().count() == 2


def test_replayed_batch_is_skipped(stream, folder):
    drop_json(stream.source, "a", [reading(1)])
    stream.drain()
    # As if the process had died after the table's commit and before the stream's own.
    shutil.move(f"{folder}/checkpoint/commits/0", f"{folder}/moved_0")
    shutil.move(f"{folder}/checkpoint/commits/.0.crc", f"{folder}/moved_0.crc")
    assert stream.drain().count() == 1
    drop_json(stream.source, "b", [reading(2)])
    assert stream.drain().count() == 2


def test_one_batch_per_file(stream):
    for name in "abc":
        drop_json(stream.source, name, [reading(ord(name))])
    stream.drain(maxFilesPerTrigger="1")
    assert stream.table.version == 3 and stream.table.read().count() == 3


def test_running_stream_and_old_files_left_out(stream):
    drop_json(stream.source, "a", [reading(1)])
    query = ingest.start_stream(
        stream.table, stream.source, drain=False, since="2999-01-01 00:00:00", **stream.state
    )
    try:
        query.processAllAvailable()
        assert not stream.table.exists
    finally:
        query.stop()


def test_continuous_stream(stream):
    drop_json(stream.source, "a", [reading(1)])
    query = ingest.start_stream(stream.table, stream.source, drain=False, **stream.state)
    try:
        query.processAllAvailable()
        drop_json(stream.source, "b", [reading(2)])
        query.processAllAvailable()
        assert stream.table.read().count() == 2
    finally:
        query.stop()


def test_running_count_that_goes_on(spark, folder):
    drop_json(f"{folder}/in", "a", [reading(1), reading(2)])
    query = ingest.running_count(ingest.stream_lines(spark, f"{folder}/in"), "going", f"{folder}/ck", drain=False)
    try:
        query.processAllAvailable()
        drop_json(f"{folder}/in", "b", [reading(3)])
        query.processAllAvailable()
        assert spark.table("going").first().record_count == 3
    finally:
        query.stop()


def test_merge_new_after_changes_in_bronze(spark, folder):
    bronze, silver = (VersionedTable(spark, f"{folder}/{n}") for n in ("bronze", "silver"))
    for t in (bronze, silver):
        t.create("id long, v string")
    add = lambda *r: bronze.append(spark.createDataFrame(list(r), "id long, v string"))
    add((1, "a"), (2, "b"))
    ingest.merge_new(silver, bronze, ["id"])
    add((3, "c"), (4, "secret"))
    bronze.delete("id in (2, 4)")
    add((5, "e"))
    ingest.merge_new(silver, bronze, ["id"])
    assert rows(silver.read()) == [(1, "a"), (2, "b"), (3, "c"), (5, "e")]
    bronze.update("id = 1", {"v": "'new'"})
    ingest.merge_new(silver, bronze, ["id"])
    assert rows(silver.read()) == [(1, "new"), (2, "b"), (3, "c"), (5, "e")]
    add((6, "f"))
    ingest.merge_new(silver, bronze, ["id"])
    assert silver.read().count() == 5


def test_running_count(spark, folder):
    drop_json(f"{folder}/in", "a", [reading(1), reading(2)])
    lines = ingest.stream_lines(spark, f"{folder}/in")
    ingest.running_count(lines, "seen", f"{folder}/ck").awaitTermination()
    assert spark.table("seen").first().record_count == 2


def test_merge_new_takes_only_what_was_added(spark, folder):
    bronze, silver = (VersionedTable(spark, f"{folder}/{n}") for n in ("bronze", "silver"))
    for t in (bronze, silver):
        t.create("id long, v string, at int")
    add = lambda *r: bronze.append(spark.createDataFrame(list(r), "id long, v string, at int"))
    add((1, "a", 1), (2, "b", 1))
    ingest.merge_new(silver, bronze, ["id"])
    add((2, "c", 2), (2, "d", 3), (3, "e", 2))
    bronze.compact()
    with pytest.raises(ValueError, match="several source rows"):
        ingest.merge_new(silver, bronze, ["id"])
    commit = ingest.merge_new(silver, bronze, ["id"], order_by=["at"])
    assert (commit.metrics["updated"], commit.metrics["inserted"]) == (1, 1)
    assert rows(silver.read().select("id", "v")) == [(1, "a"), (2, "d"), (3, "e")]
    assert ingest.merge_new(silver, bronze, ["id"]) is None


def test_merge_new_starts_over_with_a_new_table(spark, folder):
    ws = Workspace(spark, f"{folder}/tables")
    schema = "id long, v string"
    ws.table("silver").create(schema)
    for value in ("old", "new"):
        ws.table("bronze").replace(spark.createDataFrame([], schema))
        ws.table("bronze").append(spark.createDataFrame([(1, value)], schema))
        ingest.merge_new(ws.table("silver"), ws.table("bronze"), ["id"])
        ws.drop(["bronze"])
    assert rows(ws.table("silver").read()) == [(1, "new")]


def test_copy_into_remembers_files_through_an_overwrite(spark, folder, table):
    drop_json(f"{folder}/in", "a", [reading(1), reading(2)])
    table.create(json_schema(spark, f"{folder}/in"))
    ingest.copy_into(table, f"{folder}/in")
    table.overwrite(table.read().filter("id = 1"))
    assert ingest.copy_into(table, f"{folder}/in") is None


BROKEN = [
    '{"id": 2} lost text', '{"id": 3}{"id": 4}', '{"id": 3},{"id": 4}', '{"id": 5}] lost }', '{"id": 5}} lost', '{"id": 6},"v":{"id": 7}',
    '{"id": 8, "id": 9}', '{"id": 1, "d": {"a": 1, "a": 2}}', '{"id": 10', '{"id": 11}, null', 'null', '"x"', '{"id": 1}]', '{"id": 1}\t}',
]


def test_lines_with_more_than_one_object_are_kept_whole(stream):
    drop_json(stream.source, "a", [{"id": 1, "d": {"a": 1}}])
    stream.drain()
    drop_json(stream.source, "b", [*BROKEN, ' {"id": 12} ', "{'id': 13}", '{"id": null}'])
    found = rows(stream.drain().select("id", "_rescued"))
    assert sorted(r[1] for r in found if r[1]) == sorted(BROKEN)
    assert sorted(r[0] for r in found if r[0]) == [1, 12, 13] and len(found) == len(BROKEN) + 4


def test_copy_into_refuses_every_broken_line(spark, folder, table):
    table.create("id long, d struct<a: long>")
    for i, line in enumerate(BROKEN):
        drop_json(f"{folder}/in{i}", "a", [{"id": 1}, line])
        with pytest.raises(SchemaMismatch):
            ingest.copy_into(table, f"{folder}/in{i}")
    assert table.version == 0


def test_a_batch_with_misfits_leaves_one_folder(stream, folder):
    drop_json(stream.source, "a", [reading(1)])
    stream.drain()
    drop_json(stream.source, "b", [reading(2) | {"num_steps": "many"}])
    stream.drain()
    drop_json(stream.source, "c", [reading(3) | {"num_steps": "few"}])
    stream.drain()
    drop_json(stream.source, "d", [reading(4, extra=1) | {"num_steps": 0.5}, "broken"])
    assert rows(stream.drain().select("id", "extra", "_rescued")) == [
        (None, None, "broken"), (1, None, None), (2, None, '{"num_steps":"many"}'), (3, None, '{"num_steps":"few"}'),
        (4, 1, '{"num_steps":"0.5"}'),
    ]
    assert len(os.listdir(f"{folder}/bronze/data")) == 4
    assert stream.table.version == 4


def test_misfits_are_written_once_when_there_is_a_place_for_them(stream, monkeypatch):
    drop_json(stream.source, "a", [reading(1), "broken"])
    stream.drain()
    writes = []
    write = VersionedTable._write
    monkeypatch.setattr(VersionedTable, "_write", lambda self, *a, **k: writes.append(1) or write(self, *a, **k))
    drop_json(stream.source, "b", [reading(2) | {"num_steps": "many"}, "{"])
    assert stream.drain().count() == 4 and len(writes) == 1


def test_schema_grows_within_objects_lists_and_maps(stream, spark):
    drop_json(stream.source, "a", [{"i": 1, "d": {"x": 1, "e": {"f": 1}}, "l": [{"y": 1}]}])
    stream.drain(evolve="nested")
    lines = [
        {"i": 2, "d": {"x": 2, "z": "n", "e": {"g": [1]}}}, {"i": 3, "l": [{"y": 1}, {"y": 2, "w": "v"}, None]},
        {"i": 4, "d": 7, "n": {"o": 1}}, {"i": 5, "d": {"x": "t", "z": "m"}}, {"i": 6, "l": []},
    ]
    drop_json(stream.source, "b", lines)
    found = stream.drain(evolve="nested")
    assert found.schema.simpleString() == (
        "struct<d:struct<e:struct<f:bigint,g:array<bigint>>,x:bigint,z:string>,i:bigint,l:array<struct<y:bigint,w:string>>,n:struct<o:bigint>,_rescued:string>"
    )
    flat = found.select("i", "d.x", "d.z", "d.e.f", "d.e.g", F.col("l.w").alias("w"), "n.o", "_rescued")
    assert rows(flat) == [
        (1, 1, None, 1, None, [None], None, None), (2, 2, "n", None, [1], None, None, None), (3, None, None, None, None, [None, "v", None], None, None),
        (4, None, None, None, None, None, 1, '{"d":"7"}'), (5, None, "m", None, None, None, None, '{"d":"{\\"x\\":\\"t\\",\\"z\\":\\"m\\"}"}'),
        (6, None, None, None, None, [], None, None),
    ]
    before, after = 1, stream.table.version
    assert stream.table.diff(before, after).filter("change = 'delete'").count() == 0
    assert rows(stream.table.read(1).select("d.x", "d.e.f")) == [(1, 1)]


def test_frames_grow_and_narrower_ones_fit(spark, table):
    make = lambda values, schema: spark.createDataFrame(values, schema)
    table.replace(make([(1, (1,), {"k": (1,)})], "i int, d struct<x: int>, m map<string, struct<a: int>>"))
    wider = make([(2, (2, "z"), {"k": (1, 2)})], "i int, d struct<x: int, z: string>, m map<string, struct<a: int, b: int>>")
    with pytest.raises(SchemaMismatch, match="fields of d"):
        table.append(wider)
    table.append(wider, evolve=True)
    table.append(make([(3, {"k": (3,)}, (3,))], "i int, m map<string, struct<a: tinyint>>, d struct<x: tinyint>"))
    assert rows(table.read().select("i", "d.x", "d.z", F.col("m")["k"]["b"].alias("b"))) == [(1, 1, None, None), (2, 2, "z", 2), (3, 3, None, None)]
    with pytest.raises(SchemaMismatch, match="d.x"):
        table.append(make([(4, ("no",))], "i int, d struct<x: string>"))


def test_variants_keep_every_digit(stream):
    drop_json(stream.source, "a", [{"id": 1, "amount": 1, "d": {"x": 1}}])
    stream.drain(rescue="variant")
    drop_json(stream.source, "b", ['{"id":2,"amount":1234567890123456789012345678901234.25,"d":{"x":1,"y":[0.1]}}', "broken", '{"id":3,"new":{"k":1}}'])
    found = stream.drain(rescue="variant", evolve=True)
    assert dict(found.dtypes)["_rescued"] == "variant"
    get = lambda path, kind: ingest.rescued(F.col("_rescued"), path, kind)
    values = found.select("id", get("$.amount", "decimal(38,2)").cast("string"), get("$.d.y[0]", "double"), get("$", "string"), get("$.d.y", "int"), "new.k")
    assert rows(values) == [
        (None, None, None, "broken", None, None), (1, None, None, None, None, None),
        (2, "1234567890123456789012345678901234.25", 0.1, '{"amount":1234567890123456789012345678901234.25,"d":{"x":1,"y":[0.1]}}', None, None),
        (3, None, None, None, None, 1),
    ]
    drop_json(stream.source, "c", ["again"])  # a table goes on as it began
    assert stream.drain().filter("id is null").count() == 2
    with pytest.raises(ValueError):
        ingest._Lines(None, T.StructType(), None, True, "", "nothing")


def test_fields_of_any_name(stream):
    names = ["value", "__line", "__row", "lost", "fields", "row", "a.b", "_new", "Value "]
    drop_json(stream.source, "a", [{n: i for i, n in enumerate(names)}])
    stream.drain()
    drop_json(stream.source, "b", [{n: "t" for n in names}, {"value": 7}])
    found = stream.drain()
    assert set(found.columns) == {*names, "_rescued"}
    assert sorted(r["value"] for r in found.collect() if r["value"] is not None) == [0, 7]
    assert found.filter("_rescued is not null").count() == 1


def test_load_in_chunks(spark, folder, table):
    for i in range(30):
        drop_json(f"{folder}/in", f"f{i:02}", [reading(i)])
    table.create(json_schema(spark, f"{folder}/in"))
    listed = []
    load = ingest._load
    ingest._load = lambda table, files, *a: listed.append(files.count()) or load(table, files, *a)
    try:
        ingest.copy_into(table, f"{folder}/in", chunk_files=10)
    finally:
        ingest._load = load
    assert sum(listed) == 30 and max(listed) < 30 and table.version == len(listed) > 1
    assert table.read().count() == 30 and ingest.copy_into(table, f"{folder}/in", chunk_files=10) is None
    drop_json(f"{folder}/more", "a", [reading(1)])
    drop_json(f"{folder}/more", "b", ["broken"])
    with pytest.raises(SchemaMismatch):
        ingest.copy_into(table, f"{folder}/more", chunk_files=1)
    ingest.copy_into(table, f"{folder}/more", chunk_files=1, evolve=True)
    assert table.read().count() == 32


def test_sums_follow_a_table(spark, folder):
    silver, gold = (VersionedTable(spark, f"{folder}/{n}") for n in ("silver", "gold"))
    schema = "id long, at timestamp_ntz, k string, n long, d decimal(10,2)"

    def put(*values):
        return spark.createDataFrame([(i, at and datetime.fromisoformat(at), k, n, d and Decimal(d)) for i, at, k, n, d in values], schema)

    def check():
        found = ingest.rollup_new(gold, silver, "at", ["k"], ["n", "d"])
        anew = rollup.monthly_rollup(silver.read(), "at", ["k"], ["n", "d"])
        assert rows(found.drop("record_count")) == rows(anew) and found.schema["d"].dataType == anew.schema["d"].dataType
        assert sum(r["record_count"] for r in found.collect()) == silver.read().count()
        assert gold.read().count() == anew.count()

    silver.replace(put((1, "2024-01-01", "a", 1, "0.10"), (2, "2024-01-02", None, None, "0.20"), (3, None, "b", 3, None), (3, None, "b", 3, None)))
    check()
    silver.merge(put((1, "2024-02-01", "a", 5, "0.30"), (4, "2024-01-09", "a", None, None)), "id")
    check()
    version = gold.version
    check()
    assert gold.version == version
    silver.delete("k = 'b'")
    silver.update("id = 2", {"n": "7"})
    check()
    silver.restore(1)
    check()
    silver.delete("true")
    check()
    other = VersionedTable(spark, f"{folder}/other")
    other.replace(put((9, "2025-01-01", "z", 1, "1.00")))
    assert rows(ingest.rollup_new(gold, other, "at", ["k"], ["n", "d"]).select("k", "n", "record_count")) == [("z", 1, 1)]


def test_running_sums_go_on_from_their_state(spark, folder):
    table = VersionedTable(spark, f"{folder}/sums")
    schema = "at timestamp_ntz, k string, n long"

    def run(lines):
        drop_json(f"{folder}/in", f"f{len(os.listdir(f'{folder}/in')) if os.path.exists(f'{folder}/in') else 0}", lines)
        arriving = spark.readStream.schema(schema).json(f"{folder}/in")
        query = ingest.running_rollup(arriving, table, "at", "1 hour", ["k"], ["n"], checkpoint=f"{folder}/ck", delay="2 hours")
        query.awaitTermination()

    def at(hour, minute=0):
        return f"2024-01-01 {hour:02}:{minute:02}:00"

    run([{"at": at(1, 5), "k": "a", "n": 1}, {"at": at(1, 59), "k": "a", "n": 2}, {"at": at(2), "k": None, "n": 5}, {"at": None, "k": "a", "n": 9}])
    states = [name for _, _, names in os.walk(f"{folder}/ck/state") for name in names]
    assert any(name.endswith(".zip") or "changelog" in name for name in states), states
    read = lambda: rows(table.read().select(F.hour("window_start"), "k", "n", "record_count"))
    assert read() == [(1, "a", 3, 2), (2, None, 5, 1)]
    assert dict(table.read().dtypes)["window_start"] == "timestamp_ntz"
    run([{"at": at(1, 30), "k": "a", "n": 10}, {"at": at(2, 1), "k": None, "n": None}, {"at": at(20), "k": "b", "n": 1}])
    assert read() == [(1, "a", 13, 3), (2, None, 5, 2), (20, "b", 1, 1)]
    run([{"at": at(1, 31), "k": "a", "n": 100}, {"at": at(20, 5), "k": "b", "n": 1}])  # too late for the first window
    assert read() == [(1, "a", 13, 3), (2, None, 5, 2), (20, "b", 2, 2)]
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")
