import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F
from text_cases import awkward, empty, prose, read, shuffled

from tierline.llm import quality


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    repeated = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    n = len(words)
    symbols = sum(text.count(c) for c in "#*$%&|<>")
    return n, sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(repeated), n < 50 or 100 * len(repeated) > 50 * n


def check(docs):
    found = quality.quality(docs).collect()
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    wanted = sorted(((r["doc_id"], *plain(r["text"])) for r in docs.collect()), key=repr)
    assert sorted(((r["doc_id"], *(r[c] for c in columns)) for r in found), key=repr) == wanted
    assert not any(r["kept"] and r["base_failed"] for r in found)
    return found


def test_counts_against_plain_version(spark):
    check(shuffled(read(spark, "documents")))


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = check(docs)
    assert not any(r["kept"] for r in found if r["doc_id"] in (2, 3, 4, 9, 12))
    rows = [
        (1, "a b c a b c a b c", "x"), (2, "a a a a", None), (3, "\n\n a \n a\n a ", "x"), (4, "# $$ <b>\r\n# $$ <b>", ""),
        (5, " lead and trail ", "x"), (6, "a b c\na b c", "x"), (7, "a b \U0001f600é\x0bq", "x"), (8, "a b", "y"),
    ]
    check(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    assert quality.quality(empty(docs)).count() == 0


def test_junk_goes_and_clean_documents_stay(spark):
    sf = "/root/testdata/sf0.01"
    found = {r["doc_id"]: r for r in quality.quality(read(spark, "documents", sf)).filter("not base_failed").collect()}
    labels = {r["doc_id"]: r["quality"] for r in read(spark, "labels", sf).collect()}
    clean = [r["kept"] for i, r in found.items() if labels.get(i) == 1]
    junk = [r["kept"] for i, r in found.items() if labels.get(i) == 0]
    assert sum(clean) / len(clean) > 0.98 and sum(junk) / len(junk) < 0.2


def plain_distance(p, q):
    part = lambda a, b: a * math.log2(2 * a / (a + b)) if a else 0.0
    return math.sqrt(max(sum(part(a, b) + part(b, a) for a, b in zip(p, q)) / 2, 0))


def test_distance(spark):
    rows = [([0.5, 0.5, 0.0], [0.5, 0.5, 0.0]), ([1.0, 0.0, 0.0], [0.0, 1.0, 0.0]), ([0.2, 0.3, 0.5], [0.1, 0.1, 0.8]), ([0.0] * 3, [0.3, 0.3, 0.4])]
    df = spark.createDataFrame(rows, "p array<double>, q array<double>")
    found = [r[0] for r in df.select(quality.distance(F.col("p"), F.col("q"))).collect()]
    assert found == pytest.approx([plain_distance(p, q) for p, q in rows])
    assert found[:2] == [0.0, 1.0]


def test_classes_and_references(spark):
    rows = [(1, "Ab c, 12#é"), (2, ""), (3, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r[0]: r[1] for r in df.select("doc_id", quality.class_counts(F.col("text"))).collect()}
    assert found == {1: [2, 2, 1, 2, 1, 1, 1], 2: [0] * 7, 3: [0] * 7}
    docs = spark.createDataFrame([(i, prose(i, 90), "x") for i in range(20)], "doc_id bigint, text string, lang string")
    features = quality.features(docs)
    words = Counter(w.lower() for r in docs.collect() for w in r["text"].split())
    common = features.agg(F.sum(F.aggregate(F.slice("commons", 2, quality.COMMON), F.lit(0).cast("bigint"), lambda t, x: t + x))).first()[0]
    assert common == sum(n for _, n in words.most_common(quality.COMMON))
    reference = quality.references(features).first()
    assert sum(reference["ref_classes"]) == pytest.approx(1) and sum(reference["ref_commons"]) == pytest.approx(1)


def test_no_python_in_the_plan(spark):
    plan = quality.quality(awkward(spark))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow|MapPartitions", plan)


def test_commonest_words_are_counted_exactly(spark):
    # Thousands of words once, and twenty that are a little commoner, the last ones in ties.
    rare = [f"w{i}" for i in range(60_000)]
    often = [f"z{i:02}" for i in range(20) for _ in range(3 if i < 10 else 2)]
    words = rare[:30_000] + often[:25] + rare[30_000:] + often[25:]
    rows = [(i, " ".join(words[i::40]), "x") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, ref string").repartition(4)
    (found,) = quality.common_words(docs).collect()
    assert found["common"] == [f"z{i:02}" for i in range(quality.COMMON)]
