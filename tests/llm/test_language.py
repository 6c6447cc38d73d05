import zlib

import numpy as np
from text_cases import awkward, empty, read, shuffled

from tierline.llm import language


def test_held_out_accuracy(spark):
    docs = read(spark, "documents", "/root/testdata/sf0.01")
    found = {r["doc_id"]: r for r in language.languages(docs).collect()}
    rows = docs.collect()
    assert len(found) == len(rows)
    out = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2]
    assert {i for i, r in found.items() if r["held_out"]} == {r["doc_id"] for r in out}
    assert np.mean([found[r["doc_id"]]["lang_pred"] == r["lang"] for r in out]) > 0.98
    assert all(0 <= r["score"] <= 1 for r in found.values())


def test_held_out_labels_are_not_used(spark):
    docs = read(spark, "documents")
    changed = docs.withColumn("lang", language.F.when(language.fold(docs["doc_id"], 4) == 2, "zz").otherwise(docs["lang"]))
    as_rows = lambda df: sorted(map(tuple, df.collect()))
    assert as_rows(language.languages(docs)) == as_rows(language.languages(shuffled(changed)))


def test_filters_hold_every_kept_ngram_and_little_else(spark):
    rows = [("aa bb cc dd " * 50, "x"), ("aa ee ff gg " * 50, "y")]
    filters = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    grams, at = language.ngrams(["aa", "bb", "ee", "qq"])
    shares = filters.shares(grams, at)
    assert filters.names == ["x", "y"]
    assert (shares > 0.99).tolist() == [[True, True], [True, False], [False, True], [False, False]]
    other, at = language.ngrams([" ".join(f"w{chr(97 + i % 26)}{chr(97 + i // 26)}z" for i in range(600))])
    assert filters.shares(other, at).max() < 0.01


def test_more_languages_than_a_mask_has_bits(spark):
    rows = [(i, f"{chr(0x4E00 + 9 * i)}{chr(0x4E01 + 9 * i)} " * 30, f"l{i:03}") for i in range(70)]
    found = language.languages(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    for r in found.filter("not held_out").collect():
        assert r["lang_pred"] == f"l{r['doc_id']:03}"


def test_awkward_rows(spark):
    docs = awkward(spark)
    found = language.languages(docs).collect()
    assert len(found) == docs.count()
    by_id = {r["doc_id"]: r for r in found}
    for i in (2, 3, 4, 12):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[1]["lang_pred"] == "xx"
    assert language.languages(empty(docs)).count() == 0
    none = docs.withColumn("lang", language.F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in language.languages(none).collect()} == {"und"}
