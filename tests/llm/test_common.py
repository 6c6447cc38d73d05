import pyarrow as pa

from tierline.llm import common


def test_batches_are_bounded_in_bytes(spark):
    docs = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('some words ', 800) text")

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows]), pa.array([batch.nbytes])], ["n", "size"])

    found = common.map_arrow(docs, sizes, "n bigint, size bigint").collect()
    assert sum(r["n"] for r in found) == 3000
    assert max(r["size"] for r in found) < 1.1 * common.BATCH_BYTES


def test_settings_of_sizes():
    assert [common._bytes(x) for x in ("67108864b", "64m", "4194304", "1kb", "2G")] == [1 << 26, 1 << 26, 1 << 22, 1 << 10, 1 << 31]
    assert common._bytes("-1") == common._bytes("0") == float("inf")
