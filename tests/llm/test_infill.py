import hashlib
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from text_cases import awkward, empty, prose, read, shuffled

from tierline.llm import infill


def plain(doc_id, text, marks=("<P>", "<S>", "<M>"), rate=50):
    """The columns, written as they are stated."""
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[k : k + 8], 16) for k in (0, 8, 16, 24)]
    unit = re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(unit)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (unit[:a], unit[a:b], unit[b:]))
    if not text or any(m in text for m in marks) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    p, s, m = marks
    if h[3] % 100 < 80:
        return n, "spm", len(prefix), len(middle), f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", len(prefix), len(middle), f"{p}{prefix}{s}{suffix}{m}{middle}"


def check(docs, **options):
    marks = options.get("marks", infill.MARKS)
    out = infill.filled_in(docs, **options)
    found = out.withColumn("again", infill.restored(F.col("output"), F.col("form"), marks)).collect()
    wanted = [(r["doc_id"], *plain(r["doc_id"], r["text"], marks, options.get("rate", 50)), r["text"] or "") for r in docs.collect()]
    assert sorted(map(tuple, found), key=repr) == sorted(wanted, key=repr)
    return found


def test_against_plain_version(spark):
    found = check(shuffled(read(spark, "documents", "/root/testdata/sf0.01")))
    assert {r["form"] for r in found} == {"plain", "spm", "psm"}


def test_awkward_rows(spark):
    docs = awkward(spark)
    check(docs, rate=100)
    nothing = [r for r in infill.filled_in(docs).collect() if r["doc_id"] in (2, 3)]
    assert [(r["n"], r["form"], r["output"]) for r in nothing] == [(0, "plain", "")] * 2
    assert infill.filled_in(empty(docs)).count() == 0


def test_marks_in_texts_and_white_space_at_the_ends(spark):
    texts = ["a <P> b", "x<S>", "<M>", "<P", "P>", "<<S", "a<", " lead", "trail \n", "\x0b\x1c\x85\xa0　x", "one", "<S <P", "é\x00\xff <M"]
    rows = [(i * 100 + k, x) for i, x in enumerate(texts) for k in range(12)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = check(docs, rate=100)
    assert {r["form"] for r in found if r["doc_id"] < 300} == {"plain"}
    assert all(r["form"] != "plain" for r in found if r["doc_id"] >= 300)
    check(docs, rate=100, marks=("␞1", "␞2", "␞3"))


def test_very_long_text_and_many_rows_of_one_chunk(spark):
    long = "\n".join(prose(i, 500) for i in range(1200))
    assert len(long) > 2 << 20
    docs = spark.createDataFrame([(1, long), (4, long), (7, long + " "), *((i, "x") for i in range(10, 3000))], "doc_id bigint, text string")
    check(docs, rate=100)


def test_ambiguous_marks_are_refused(spark):
    docs = awkward(spark)
    for marks in (("", "a", "b"), ("ab", "b", "c"), ("<P", "P<", "x"), ("aba", "x", "y"), ("a", "a", "b")):
        with pytest.raises(ValueError):
            infill.filled_in(docs, marks=marks)


def test_units_and_pieces():
    column = pa.array([b"  a b\n", b"", b" ", b"xyz"], pa.binary())
    lists = infill.units(column)
    assert lists.to_pylist() == [[b"  a", b" b", b"\n"], [], [b" "], [b"xyz"]]
    first, second = pa.array([1, 0, 0, 0]), pa.array([2, 0, 1, 0])
    assert [x.to_pylist() for x in infill.pieces(lists, first, second)] == [[b"  a", b"", b"", b""], [b" b", b"", b" ", b""], [b"\n", b"", b"", b"xyz"]]
